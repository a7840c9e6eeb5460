"""Line dedup, conversation prefix trie and ranked lexical search against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallymark.llm import lexical, lines, trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- line dedup


def deduped(rows, min_length=40, min_documents=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    at = lambda i: -(1 << 63) if i is None else i
    holders = defaultdict(set)
    for i, text in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_length:
                holders[key(x)].add(at(i))
    keeper = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_documents}
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if keeper.get(key(x), at(i)) == at(i)]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


SHARED = "This Line stands in MANY documents, word for word, é and all."


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = [(i, f"line {i} is the document's own, and long enough to count\n  {SHARED}\t\r\nshort\n{SHARED.upper() if i % 3 else SHARED}\n") for i in range(30)]
    pool = [f"a pooled line, number {k}, that is rather longer than forty" for k in range(12)]
    made += [(100 + i, "\n".join(rng.choices(pool, k=rng.randrange(9)))) for i in range(40)]
    made += [(7, SHARED), (7, SHARED), (None, SHARED + "\nnull id"), (None, None), (200, ""), (201, None), (202, "\n\n"), (203, "x" * 39), (204, SHARED.replace("é", "É"))]
    made += [(300, "\n".join([SHARED] * 5000 + ["end"])), (301, "y" * 300_000), (302, (" " * 50_000 + "z") * 3)]
    return made + made[:3]


def test_line_dedup_by_brute_force(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, lines.line_dedup(df).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    assert got == deduped(texts)


def test_line_dedup_limits(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(map(tuple, lines.line_dedup(df, min_length=3, min_documents=2).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    assert got == deduped(texts, 3, 2)


def test_line_dedup_keeps_other_columns(spark, texts):
    rows = [(text, i, "r", 1, 2, 3, "k", 9) for i, text in texts]
    df = spark.createDataFrame(rows, "text string, doc_id long, row string, h1 int, t1 int, id int, dropped string, n_lines int")
    out = lines.line_dedup(df)
    assert out.columns == ["text", "doc_id", "row", "h1", "t1", "id", "dropped", "n_lines", "n_dropped"]
    assert {(r["row"], r.h1, r.t1, r.id, r.dropped) for r in out.collect()} == {("r", 1, 2, 3, "k")}
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str) == deduped(texts)


def test_line_dedup_of_nothing(spark, empty):
    assert lines.line_dedup(empty).collect() == []


def test_line_dedup_runs_no_python(spark, texts):
    df = lines.line_dedup(spark.createDataFrame(texts, "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- prefix trie


def built(turns):
    """Turns as (conv, turn, role, text), in order of turn: the node of each prefix."""
    seqs = defaultdict(list)
    for conv, turn, role, text in sorted((t for t in turns if t[0] is not None), key=lambda t: (t[0], t[1] is not None, t[1] or 0)):
        seqs[conv].append((role or "", text or ""))
    return seqs


def brute_trie(seqs):
    members, ends = defaultdict(list), defaultdict(list)
    ids = {(): 0}
    at = {}
    for conv in sorted(seqs):
        node, members[0] = 0, [*members[0], conv]
        for turn in seqs[conv]:
            node = at.setdefault((node, turn), len(at) + 1)
            members[node].append(conv)
        ends[node].append(conv)
    parent = {child: (node, turn) for (node, turn), child in at.items()}
    kids = Counter(p for p, _ in parent.values())
    leaves, saved, depth = Counter(), Counter(), {0: 0}
    for node in members:
        path, up = [], node
        while up:
            path.append(up)
            up = parent[up][0]
        depth[node] = len(path)
        cost = (len(members[node]) - 1) * len(parent[node][1][1].encode()) if node else 0
        for v in [*path, 0]:
            leaves[v] += node not in kids
            saved[v] += cost
    del ids
    digest = lambda cs: hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest()
    return sorted(
        ((min(members[v]), depth[v], min(members[parent[v][0]]) if v else None, len(members[v]), kids[v], leaves[v], saved[v], digest(ends[v])) for v in members),
        key=str,
    ) if seqs else []


def made_trie(spark, df, members=None):
    turns = trie.positions(df, "conv_id", "turn", "role", "text")
    members = turns.select("conv").distinct() if members is None else members
    nodes, ends = trie.prefix_trie(turns, members)
    out = nodes.join(trie.listed_digests(ends), ["n1", "n2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256))
    )
    return sorted(map(tuple, out.collect()), key=str)


TURNS = "conv_id long, turn int, role string, text string"


def chats(rng, convs, length, words):
    made = []
    for conv in convs:
        made += [(conv, t, "user" if t % 2 == 0 else "assistant", rng.choice(words)) for t in range(rng.randrange(length))]
    return made


def test_short_conversations_by_brute_force(spark):
    rng = random.Random(3)
    turns = chats(rng, range(60), 9, ["a", "b", "né", ""]) + [(70, 0, "user", "a"), (71, None, None, None), (71, 0, None, ""), (None, 0, "user", "a"), (-4, 5, "user", "a")]
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, TURNS).repartition(3)
    assert made_trie(spark, df) == brute_trie(built(turns))


def test_long_conversations_are_cut_and_grafted(spark):
    rng = random.Random(4)
    trunk = [("user", f"turn {k}") for k in range(150)]
    turns = []
    for conv in range(14):
        keep = rng.choice([0, 1, 15, 16, 17, 31, 32, 48, 64, 65, 128, 150])
        seq = trunk[:keep] + [("user", rng.choice("xy")) for _ in range(rng.choice([0, 1, 3, 16, 40]))]
        turns += [(conv, t, role, text) for t, (role, text) in enumerate(seq)]
    rng.shuffle(turns)
    assert made_trie(spark, spark.createDataFrame(turns, TURNS).repartition(7)) == brute_trie(built(turns))


def test_equal_turns_all_count(spark):
    turns = [(1, 0, "user", "same")] * 40 + [(2, 0, "user", "same")] * 39 + [(3, None, "user", "same")]
    assert made_trie(spark, spark.createDataFrame(turns, TURNS).repartition(4)) == brute_trie(built(turns))


def test_conversations_without_turns_end_at_the_root(spark):
    members = spark.createDataFrame([(5,), (9,), (2,)], "conv long")
    nothing = spark.createDataFrame([], TURNS)
    want = hashlib.sha256(b"2,5,9").hexdigest()
    assert made_trie(spark, nothing, members) == [(2, 0, None, 3, 0, 1, 0, want)]
    assert made_trie(spark, nothing, members.limit(0)) == []


def test_digests_cross_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 20)
    turns = [(c, 0, "user", "hot" if c % 3 else "cold") for c in range(500)]
    assert made_trie(spark, spark.createDataFrame(turns, TURNS).repartition(6)) == brute_trie(built(turns))


def test_the_query_rebuilds_conversations(spark, tmp_path):
    from tallymark.llm import queries

    rng = random.Random(8)
    turns = chats(rng, [*range(23), 41, 43, -7], 12, ["a", "b", "c"])
    spark.createDataFrame(turns, TURNS).withColumn("pos", F.lit(1)).write.parquet(f"{tmp_path}/conversations.parquet")
    own = built(turns)
    seqs = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        seqs[c] = own.get(base, [])[:h] + own[c][h:]
    got = queries.op12_conversation_prefix_trie(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(seqs)


# --- ranked lexical search


def ranked(docs, items, top=50):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, words in asked.items():
        scored = []
        for i, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(1, n_terms)
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def library():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)] + ["É", "é", "straße", "x" * 100, "X" * 100, "naïve", "2024"]
    odds = [1 / (k + 1) for k in range(len(words))]
    docs = [(i, rng.choice([" ", "-", "\x00", ", "]).join(rng.choices(words, odds, k=rng.randrange(60)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(120)] + [(None, "w1 w2 w3"), (5000, None), (5001, ""), (5002, "... !"), docs[7], docs[7]]
    docs.append((6000, " ".join(rng.choices(words, odds, k=50_000))))
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 25)))) for k in range(25)]
    items += [(50, docs[3][1]), (51, None), (52, "nothing here"), (None, "W1 W250"), (53, "w1"), (53, "w9 w8"), (54, "w5 w5 w5"), items[2]]
    return docs, items


DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def searched(spark, docs, items, **given):
    return lexical.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), **given)


def test_search_by_brute_force(spark, library):
    assert sorted(map(tuple, searched(spark, *library).collect()), key=str) == ranked(*library)


@pytest.mark.parametrize("top", [1, 7, 1000])
def test_search_with_small_shards_and_blocks(spark, library, monkeypatch, top):
    for name, value in (("SHARD_BITS", 5), ("LEAF_BITS", 1), ("WIDTH", 2), ("BLOCK", 40), ("PIECE", 64)):
        monkeypatch.setattr(lexical, name, value)
    assert sorted(map(tuple, searched(spark, *library, top=top).collect()), key=str) == ranked(*library, top)


def test_search_of_nothing(spark, library):
    docs, items = library
    assert searched(spark, docs, items[:0]).collect() == []
    assert searched(spark, docs[:0], items).collect() == []
    assert searched(spark, [(1, None), (2, "..")], items).collect() == []


def test_search_reads_only_its_columns(spark, library):
    docs, items = library
    more = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], DOCS + ", item long, doc long, score long")
    extra = spark.createDataFrame([(*d, 1, 2) for d in items], ITEMS + ", term long, rank long")
    out = lexical.search(more, extra)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.schema["rank"].dataType.simpleString() == "int"
    assert sorted(map(tuple, out.collect()), key=str) == ranked(docs, items)


def test_treap_opens_less_than_everything():
    import numpy as np

    rng = np.random.default_rng(1)
    height, n = 13, 1 << 13
    rows, cols = np.divmod(rng.choice(64 * n, 60_000, replace=False), n)
    impacts = np.where(rng.random(60_000) < 0.001, 10_000, 10) + rng.integers(0, 10, 60_000)
    treap, asked = lexical.Treap(rows, cols, impacts, height), []
    at = treap.at
    treap.at = lambda level, r, c: (asked.append(len(c)) if level == 0 else None, at(level, r, c))[1]
    best: list = []
    lexical.descend(treap, lexical.Paths(np.arange(5, 12), height), np.arange(n), height, 5, best)
    dense = np.zeros((64, n), dtype=np.int64)
    dense[rows, cols] = impacts
    scores = dense[5:12].sum(axis=0)
    assert sorted(best, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(scores)), reverse=True)[:5]
    assert sum(asked) < n / 4
