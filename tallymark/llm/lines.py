"""Line dedup: lines that many documents share stay in only one of them. Built-in column expressions throughout."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import written
from tallymark.llm.fingerprints import let

SPACE = " \t\n\x0b\x0c\r"
#: Stands for a null id, which is below all others.
NO_ID = -(1 << 63)


def hashes(value: Column, name: str) -> list[Column]:
    """128 bits: at 10^12 different lines, two of them share a hash with a chance of about 10^-15."""
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit(1), value).alias(f"{name}2")]


def split_lines(body: Column) -> Column:
    return F.split(body, "\n", -1)


def keyed_lines(rows: DataFrame, min_length: int) -> DataFrame:
    """id, t1, t2 (hash of the text), pos and h1, h2 (hash of the key) of each line whose key is long enough."""
    lowered = F.translate("body", ascii_uppercase, ascii_lowercase)
    exploded = rows.select("id", "t1", "t2", F.posexplode(split_lines(lowered)).alias("pos", "line"))
    keyed = exploded.withColumn("key", F.btrim("line", F.lit(SPACE))).where(F.length("key") >= min_length)
    return keyed.select("id", "t1", "t2", "pos", *hashes(F.col("key"), "h"))


def repeated(keyed: DataFrame, min_documents: int) -> DataFrame:
    """h1, h2 and keeper, the largest id, of the keys that are in enough documents.

    Distinct documents are counted by key and id first, so a line of a third of all documents is no hot group.
    """
    counted = keyed.groupBy("h1", "h2").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
    return counted.where(F.col("n") >= min_documents).select("h1", "h2", "keeper")


def line_dedup(documents: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = 40, min_documents: int = 5) -> DataFrame:
    """``documents`` without the lines that many documents share, and n_lines (before) and n_dropped.

    A line's key is the line without white space at its ends and with A-Z in lower case. A key of at least
    ``min_length`` code points that at least ``min_documents`` documents hold loses all its lines except in the
    document with the largest id; all other lines stay, in their order. A null or empty text has one empty line and
    comes out empty. Rows with the same id are one document when documents are counted, but keep their own texts; null
    ids are one document, below all others. Repeated rows stay repeated. Texts may have any length: only hashes and
    positions are grouped by line, and only positions by document. Other columns pass through, unless they are named
    like an added one. An empty table gives an empty one.

    The keys to drop are written out, so that Spark knows their size and broadcasts them only if they are few; else
    both sides are shuffled, and the adaptive skew join splits a line that is everywhere.
    """
    others = [F.col(f"`{c}`") for c in documents.columns if c not in (text, "n_lines", "n_dropped")]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    rows = documents.select(F.struct(*others).alias("row"), key.alias("id"), body.alias("body"), *hashes(body, "t"))
    keyed = keyed_lines(rows, min_length)
    drop = written(repeated(keyed, min_documents), "line-keys")
    hits = keyed.join(drop, ["h1", "h2"]).where(F.col("id") != F.col("keeper"))
    places = hits.groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("dropped"))
    joined = rows.join(places, ["id", "t1", "t2"], "left")

    def without(all_lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("dropped"))
        return F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")

    kept = F.when(F.col("dropped").isNull(), F.col("body")).otherwise(let(split_lines(F.col("body")), without))
    n_lines = (F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1).cast("long")
    n_dropped = F.coalesce(F.size("dropped"), F.lit(0)).cast("long")
    made = joined.select("row", kept.alias("kept"), n_lines.alias("n_lines"), F.when(F.col("dropped").isNull(), 0).otherwise(n_dropped).cast("long").alias("n_dropped"))
    out = [F.col("kept").alias(c) if c == text else F.col(f"row.`{c}`") for c in documents.columns if c not in ("n_lines", "n_dropped")]
    return made.select(*out, "n_lines", "n_dropped")
