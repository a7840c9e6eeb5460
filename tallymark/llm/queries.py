"""One query per operator over its whole table, and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import chat, fingerprints, lexical, licenses, lines, mixing, packing
from tallymark.llm import quality as quality_rules
from tallymark.llm import secrets as secret_scans
from tallymark.llm import simhash, token_counts, trie, urls
from tallymark.llm.common import cut, table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def registered(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


@registered
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    bands = quality_rules.fit(documents, table(spark, sf_dir, "labels"))
    return quality_rules.quality(documents, bands).drop("text")


@registered
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("secrets")
    base = F.filter(spans, lambda x: x["kind"] != "novel")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    return secret_scans.secrets(documents).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex", "novel")],
        F.sha2(secret_scans.listing(base), 256).alias("base_sha256"),
        secret_scans.listing(spans).alias("spans"),
    )


@registered
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(documents, shingle=3, radius=2)
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@registered
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    pieces = packing.pack(documents, public_tokenizers.path("word_bpe_49k.json"), length=2048)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@registered
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken(mixing.mix(documents, mixing.cycle((5, 2, 1)), most=3.0))


@registered
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@registered
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


@registered
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = token_counts.zipf_scores(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(documents, scores).drop("text")


#: Fetch days, and entries of a dated list, made from the table itself.
_PAGES = "SELECT page_id, url, (page_id * 37) % 400 AS fetched FROM pages"
_HOSTS = """
SELECT host, min(page_id) AS m, CASE WHEN regexp_extract(host, '^[^.]*[.](.*[.].*[.].*)$', 1) = '' THEN host
  ELSE regexp_extract(host, '^[^.]*[.](.*[.].*[.].*)$', 1) END AS domain
FROM (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host FROM pages) p
WHERE host <> '' GROUP BY host
"""
_ENTRIES = """
SELECT 'host' AS kind, host AS pattern, m % 300 AS changed, 'add' AS action FROM hosts WHERE m % 4 = 1
UNION ALL SELECT 'host', host, m % 300 + 30 + m % 60, 'remove' FROM hosts WHERE m % 4 = 1
UNION ALL SELECT 'host', host, m % 300 + 120, 'add' FROM hosts WHERE m % 8 = 1
UNION ALL SELECT 'domain', domain, m % 200, 'add' FROM hosts WHERE m % 5 = 2
UNION ALL SELECT 'domain', domain, m % 200 + 90, 'remove' FROM hosts WHERE m % 5 = 2
UNION ALL SELECT 'prefix', concat(host, '/en'), m % 350, 'add' FROM hosts WHERE m % 3 = 0
"""


@registered
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "pages").select("page_id", "url").createOrReplaceTempView("pages")
    captures = spark.sql(_PAGES)
    entries = spark.sql(f"WITH hosts AS ({_HOSTS}) {_ENTRIES}")
    return urls.filter_urls(captures, entries, bucket=64, at="fetched")


_ORACLES["op8_url_filters"] = f"""
WITH hosts AS ({_HOSTS}), entries AS ({_ENTRIES}), captures AS ({_PAGES}),
once AS (SELECT kind, pattern, changed, max(action) AS action FROM entries GROUP BY kind, pattern, changed),
changes AS (SELECT * FROM (SELECT *, coalesce(lag(action) OVER (PARTITION BY kind, pattern ORDER BY changed), 'remove') AS was FROM once) t
  WHERE action <> was),
spans AS (SELECT * FROM (SELECT kind, pattern, action, changed AS since, lead(changed) OVER (PARTITION BY kind, pattern ORDER BY changed) AS until FROM changes) t
  WHERE action = 'add'),
asked AS (SELECT *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
  regexp_extract(url, '^[^:]*://[^/?#]*(/[^?#]*)', 1) AS path FROM captures),
hits AS (SELECT page_id, min(row(CASE s.kind WHEN 'host' THEN 1 WHEN 'domain' THEN 2 ELSE 3 END, s.pattern, s.kind, s.since)) AS hit
  FROM asked a JOIN spans s ON s.since <= a.fetched AND (s.until IS NULL OR a.fetched < s.until) AND (
    s.kind = 'host' AND a.host = s.pattern
    OR s.kind = 'domain' AND (a.host = s.pattern OR suffix(a.host, '.' || s.pattern))
    OR s.kind = 'prefix' AND (a.host || a.path = s.pattern OR starts_with(a.host || a.path, s.pattern || '/')))
  GROUP BY page_id)
SELECT c.page_id, c.url, c.fetched, hit IS NOT NULL AS blocked, hit[3] AS kind, hit[2] AS pattern, hit[4] AS since
FROM captures c LEFT JOIN hits USING (page_id)
"""


@registered
def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    place = lambda x: F.concat_ws(":", x["name"], x["start"], x["end"])
    found = licenses.scan(documents)
    return found.select("doc_id", *licenses.best(), F.array_join(F.transform("licenses", place), ",").alias("places"))


@registered
def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(documents, table(spark, sf_dir, "benchmark").select("item_id", "text"), top=50)


_TERM = "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ORACLES["op11_ranked_lexical_search"] = f"""
WITH words AS (SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), {_TERM})) AS term FROM documents),
counts AS (SELECT d, doc_id, term, count(*) AS tf FROM words GROUP BY d, doc_id, term),
sizes AS (SELECT d, sum(tf)::BIGINT AS n FROM counts GROUP BY d),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), {_TERM})) AS term FROM benchmark),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term) t, total),
scores AS (SELECT item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (d), total GROUP BY item_id, d, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) r WHERE rank <= 50
"""


@registered
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = cut(trie.positions(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"))
    sizes = own.groupBy("conv").agg(F.count("*").alias("n"))
    every = sizes.withColumns({"h": F.crc32(F.col("conv").cast("string").cast("binary")) % 9, "base": F.expr("conv - conv % 5")})
    lent = F.least("h", F.coalesce("base_n", F.lit(0))).alias("lent")
    convs = cut(every.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left").select("conv", "base", "h", lent))
    turn = ("a", "b", "size")
    first = own.where("pos < 9").withColumnRenamed("conv", "base").join(convs.where("lent > 0"), "base").where("pos < lent")
    rest = own.join(convs, "conv").where("pos >= h").withColumn("pos", F.expr("pos - h + lent"))
    turns = first.select("conv", "pos", *turn).union(rest.select("conv", "pos", *turn))
    nodes, ends = trie.prefix_trie(turns, convs.select("conv"))
    digests = trie.listed_digests(ends).withColumnRenamed("sha256", "ends_sha256")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return nodes.join(digests, ["n1", "n2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256")
    )


#: CRC-32 of a decimal number's bytes, a bit at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, y: xor(b >> 1, (b & 1) * 3988292384))), 4294967295::BIGINT)"""
_ORACLES["op12_conversation_prefix_trie"] = f"""
WITH own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
convs AS (SELECT *, {_CRC} % 9 AS h FROM own),
built AS (SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(c.turns, h + 1, len(c.turns))) AS turns
  FROM convs c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
steps AS (SELECT conv_id, len(turns) AS n, d AS depth, list_slice(turns, 1, d) AS prefix, CASE WHEN d > 0 THEN list_slice(turns, 1, d - 1) END AS above
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built) t),
nodes AS (SELECT prefix, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM steps GROUP BY prefix, depth),
kids AS (SELECT above AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
known AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
  CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(n.prefix[-1].text) ELSE 0 END AS saved FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix),
sums AS (SELECT list_slice(prefix, 1, d) AS prefix, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM known) t GROUP BY 1)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, k.ends_sha256
FROM known k JOIN sums s ON s.prefix = k.prefix LEFT JOIN known p ON p.prefix = k.above
"""


@registered
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.line_dedup(documents, min_length=40, min_documents=5).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_ORACLES["op13_line_dedup"] = f"""
WITH split AS (SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
keyed AS (SELECT d, doc_id, len(all_lines) AS n_lines, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key
  FROM (SELECT *, unnest(all_lines) AS line, unnest(range(0, len(all_lines))) AS i FROM split) t),
often AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, n_lines, count(keeper) FILTER (doc_id <> keeper) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (key) GROUP BY d, doc_id, n_lines
"""
