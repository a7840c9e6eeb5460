"""Near-duplicates by SimHash: fingerprints within a few bits, compared bit-sliced.

Two fingerprints within ``radius`` bits agree on one of any ``radius + 1`` groups of bits, so they meet in a bucket
of equal bits. A bucket with too many members is split again by groups of its remaining bits, which loses no pair and
ends at the latest when few bits remain. Inside a bucket, plane k holds bit k of all members as one long integer. A
member is compared with all others at once: each plane, flipped where the member's bit is set, is added to vertical
carry-save counters, and the block is left as soon as every counter has passed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, add_columns, cut, flat_map, written
from tallymark.llm.graph import components

BITS = 64
#: Members of a bucket that are compared in one task; larger buckets are split.
BUCKET = 4096


# --- fingerprints


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: bit k is set if it is set in over half of the shingles' XXH64."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, block, ones = xxhash.xxh64_intdigest, 1 << 16, np.zeros(BITS, np.int64)
    for at in range(0, n, block):
        size = min(block, n - at)
        hashes = np.fromiter((digest(b" ".join(words[i : i + shingle]), seed) for i in range(at, at + size)), "<u8", size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``documents`` with ``fp``, the fingerprint as a signed long; a null text counts as one without words: zero."""

    def add(cols: Lists) -> Lists:
        made = np.array([fingerprint(x or b"", shingle) for x in cols[text]], "<u8")
        return {"fp": made.view("<i8").tolist()}

    return add_columns(documents, [text], add, "fp long")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- comparison inside a bucket


def _planes(members: np.ndarray, mask: int) -> list[tuple[int, int]]:
    """(bit, plane) for the bits on which members of a bucket may differ."""
    bits = np.unpackbits(members.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return [(k, int.from_bytes(packed[k].tobytes(), "little")) for k in range(BITS) if not mask >> k & 1]


def compare(members: np.ndarray, mask: int, radius: int) -> Iterator[tuple[int, int]]:
    """Index pairs i < j of members (distinct, unsigned 64 bits) within ``radius`` bits of each other."""
    count, width = len(members), radius.bit_length()
    full, planes = (1 << count) - 1, _planes(members, mask)
    start = (1 << width) - 1 - radius  # so that a counter overflows at radius + 1
    first = [full if start >> k & 1 else 0 for k in range(width)]
    for i, value in enumerate(members[:-1].tolist()):
        over, counters = (1 << (i + 1)) - 1, list(first)  # what stands before i has been compared
        for k, plane in planes:
            carry = plane ^ full if value >> k & 1 else plane
            for c in range(width):
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            over |= carry
            if over == full:
                break
        near = full & ~over
        while near:
            low = near & -near
            yield i, low.bit_length() - 1
            near ^= low


def forest(members: np.ndarray, mask: int, radius: int) -> list[tuple[int, int]]:
    """(member, smaller member) links that join what is linked in a bucket: fewer links than members."""
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, j in compare(members, mask, radius):
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [(i, r) for i in range(len(members)) if (r := root(i)) != i]


def _compare_buckets(radius: int):
    """Links of all buckets of a partition, whose rows come sorted by bucket."""

    def links(mask: int, members: np.ndarray, out: Lists) -> None:
        for i, j in forest(members.view("<u8"), mask & (1 << BITS) - 1, radius):
            out["a"].append(int(members[i]))
            out["b"].append(int(members[j]))

    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        rest = np.empty((0, 3), "<i8")
        for last, cols in _with_last(batches):
            rows = np.concatenate([rest, np.array([cols["mask"], cols["key"], cols["fp"]], "<i8").reshape(3, -1).T])
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]) if len(rows) else np.array([], int)
            ends = np.r_[starts[1:], len(rows)].astype(int)
            whole = len(starts) if last else max(0, len(starts) - 1)
            out: Lists = {"a": [], "b": []}
            for s, e in zip(starts[:whole], ends[:whole], strict=True):
                if e - s > 1:
                    links(int(rows[s, 0]), np.ascontiguousarray(rows[s:e, 2]), out)
            rest = rows[starts[whole] :] if whole < len(starts) else rows[:0]
            yield out

    return run


def _with_last(batches: Iterator[Lists]) -> Iterator[tuple[bool, Lists]]:
    held = next(batches, None)
    for batch in batches:
        yield False, held
        held = batch
    if held is not None:
        yield True, held


# --- buckets


def _parts(mask: int, n: int) -> list[int]:
    """``mask`` with each of ``n`` equal groups of its unset bits set in turn."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    return [mask | sum(1 << k for k in group) for i in range(n) if (group := free[i * len(free) // n : (i + 1) * len(free) // n])]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def links(distinct: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that join all within ``radius`` bits.

    Pairs that other links already join may be left out, never one that is needed to reach a fingerprint.
    """
    rows = _bucketed(distinct.select(F.lit(0).cast("long").alias("mask"), "fp"), [0], radius)
    found = None
    while True:
        hot = cut(rows.groupBy("mask", "key").count().where(F.col("count") > bucket).drop("count"))
        more = not hot.isEmpty()
        calm = rows.join(hot, ["mask", "key"], "left_anti") if more else rows
        sorted_rows = calm.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        made = flat_map(sorted_rows, _compare_buckets(radius), "a long, b long")
        found = made if found is None else found.union(made)
        if not more:
            return found
        masks = [r["mask"] % (1 << BITS) for r in hot.select("mask").distinct().collect()]
        rows = cut(_bucketed(rows.join(hot, ["mask", "key"]), masks, radius))


def _bucketed(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Each row once for every finer mask of its own one; there are (radius + 1) to the power of the depth at most."""
    array = lambda mask: F.array(*[F.lit(_signed(part)).cast("long") for part in _parts(mask, radius + 1)])
    finer = F.create_map(*[c for mask in masks for c in (F.lit(_signed(mask)).cast("long"), array(mask))])
    split = rows.select(F.explode(finer[F.col("mask")]).alias("mask"), "fp")
    return split.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


# --- the operator


def near_duplicates(
    documents: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """One row per document: its id, text_key (XXH64 of the text), fp, root and component_id.

    Documents link if their fingerprints differ in at most ``radius`` bits; ``root`` is the smallest fingerprint that
    a document reaches over links, ``component_id`` the smallest id (null ids count only if there is no other). Exact
    copies meet in one row per fingerprint before anything is compared, so their number costs nothing. A null text is
    a text without words; those all have fingerprint zero and link like any other. Repeated rows stay. Extra columns
    are not read. An empty table gives an empty one.
    """
    body = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("body"))
    keyed = body.select("id", F.xxhash64("body").alias("text_key"), "body")
    prints = cut(fingerprints(keyed, "body", shingle).select("id", "text_key", "fp"))
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("first")))
    nodes = components(links(distinct, radius, bucket))
    joined = nodes.join(distinct, nodes.node == distinct.fp).select("node", "root", "first")
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = joined.select("node", "root").join(least, "root")
    named = distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id")
    )
    named = written(named, "groups")  # both sides are then shuffled for the join alone, which Spark can split where a fingerprint is hot
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "text_key", "fp", "root", "component_id")


def keep_one(documents: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with one row of each group of near-duplicates: that of the smallest id, then of the smallest text key."""
    groups = near_duplicates(documents, shingle, radius, id_col, text)
    chosen = groups.groupBy("root").agg(F.min_by(F.struct(F.col(id_col).alias("id"), F.col("text_key").alias("key")), F.struct(F.col(id_col).isNull(), id_col, "text_key")).alias("one"))
    key = lambda i, k: [F.coalesce(i.cast("long"), F.lit(0)).alias("__id"), F.xxhash64(i.isNull(), k).alias("__key")]
    one = chosen.select(*key(F.col("one.id"), F.col("one.key")))
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    keyed = documents.select(row, *key(F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text}`"))))
    kept = keyed.join(one, ["__id", "__key"])  # plain keys, so that repeated rows are dropped where the join leaves them
    return kept.dropDuplicates(["__id", "__key"]).select("row.*")
