"""The pipeline stage by stage on the smallest tables, and the contract columns of the queries."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallymark.llm import mixing, queries, secrets, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_keep_their_promises(spark, tmp_path):
    docs, tables = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        tables.append(docs)
        assert i == 4 or docs.columns == columns, name
    kept, unique, clean, mixed = [t.collect() for t in tables[:4]]
    verdicts = {r["doc_id"]: r["kept"] for r in queries.queries()["op7_quality_rules"](spark, SF).collect()}
    assert {r["doc_id"] for r in kept} == {d for d, ok in verdicts.items() if ok}
    groups = simhash.near_duplicates(tables[0]).collect()
    assert {r["doc_id"] for r in unique} == {r["component_id"] for r in groups} and len(unique) == len({r["doc_id"] for r in unique})
    before = {r["doc_id"]: r["text"] for r in unique}
    assert {r["doc_id"] for r in clean} == set(before)
    for r in clean:
        assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        assert secrets.base_spans(before[r["doc_id"]]) or r["text"] == before[r["doc_id"]]
    words = lambda rows, key: Counter({k: sum(len(WORD.findall(r["text"])) for r in g) for k, g in by(rows, key).items()})
    sizes, got = words(clean, "doc_id"), words(mixed, "doc_id")
    assert all(got[d] <= 3 * sizes[d] for d in got)
    source, drawn = words(clean, "source"), words(mixed, "source")
    names = mixing.order(list(source))
    for n, goal in zip(names, mixing.targets([source[n] for n in names], mixing.cycle()(names))):
        assert abs(drawn[n] - goal) <= 2 * 256
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, packed = Counter(), Counter()
    for r in mixed:
        want.update((r["doc_id"], i) for i in tokenizer.encode(r["text"], add_special_tokens=False).ids + [1])
    filled = defaultdict(int)
    for r in tables[4].collect():
        packed.update((r["doc_id"], i) for i in np.frombuffer(r["ids"], "<u4").tolist())
        filled[r["sequence_id"]] += r["length"]
    assert packed == want and all(filled[k] == 2048 for k in range(len(filled) - 1))


def by(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[r[key]].append(r)
    return groups


CONTRACT = {
    "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_chat_formatting": "conv_id turn new_role action cost segment",
    "op3_simhash_near_dedup": "doc_id fingerprint component_id",
    "op4_token_counts": "doc_id n_tokens",
    "op5_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op8_url_filters": "page_id blocked kind pattern since",
    "op9_license_scans": "doc_id license coverage places",
    "op10_mixing": "doc_id size source_size target taken",
    "op11_ranked_lexical_search": "item_id rank doc_id score",
    "op12_conversation_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_line_dedup": "doc_id n_lines n_dropped kept_sha256",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_queries_return_their_columns(spark, name):
    made = queries.queries()[name](spark, SF)
    assert set(CONTRACT[name].split()) <= set(made.columns)


def test_every_query_is_here():
    assert set(queries.queries()) == set(CONTRACT)
