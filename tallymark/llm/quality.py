"""Quality rules: compression bands over whole documents and fixed chunks, beside plain counts.

Text that repeats itself compresses far better than prose, and random text hardly at all. Short texts
compress worse than long ones, so the accepted ratios depend on the length. A document is rejected if its
own ratio leaves the band of its length, if too large a share of its full chunks leave the chunk band, or if its
shape (all letters alike) compresses too badly for its length, as symbol noise does. ``fit`` draws the bands
around all documents that are labelled good.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import SPACES, Lists, add_columns, written

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
ADDED = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "ratio": "double",
    "shape_ratio": "double",
    "n_chunks": "long",
    "bad_chunks": "long",
    "kept": "boolean",
}
#: Letters and all bytes outside ASCII become one letter, digits one digit; symbols and white space stay.
SHAPE = bytes(97 if chr(b).isalpha() or b > 127 else 48 if chr(b).isdigit() else b for b in range(256))


@dataclass(frozen=True)
class Bands:
    """Limits of raw bytes over compressed bytes.

    ``whole``: (bytes, least ratio, greatest ratio), in rising order; between these sizes the limits are interpolated
    over the logarithm of the size, beyond the first and the last they stay. ``shape``: (bytes, least ratio) likewise
    for the text with all letters alike. A text below ``shortest`` bytes is too short to judge. Chunks hold ``chunk``
    bytes; a shorter rest is only judged as part of the whole. More than ``chunk_share`` of the chunks outside
    ``chunk_band`` reject a text.
    """

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 1.0, 2.5),
        (1024, 1.15, 3.0),
        (4096, 1.35, 3.5),
        (16384, 1.45, 4.0),
        (65536, 1.5, 5.0),
    )
    shape: tuple[tuple[float, float], ...] = ((128, 1.4), (320, 2.2), (1024, 2.8), (4096, 3.2))
    shortest: int = 128
    chunk: int = 2048
    chunk_band: tuple[float, float] = (1.35, 3.5)
    chunk_share: float = 0.5
    level: int = 3


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a five-word window found twice or more; compared exactly, by rank and not by hash."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    codes, used = ids[:n], len(seen)
    for k in range(1, WINDOW):
        if used > (1 << 62) // len(seen):  # the next word no longer fits: number the windows so far
            unique, codes = np.unique(codes, return_inverse=True)
            used = len(unique)
        codes = codes * len(seen) + ids[k : k + n]
        used *= len(seen)
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    if counts.max() < 2:
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[inverse] > 1)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text.translate(None, SPACES).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def ratios(text: bytes, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple[float, float, list[float]] | None:
    """Ratios of the whole text, of its shape, and of its full chunks; None for a text too short to judge."""
    if len(text) < bands.shortest:
        return None
    ratio = lambda x: len(x) / len(zstd.compress(x))
    view = memoryview(text)
    chunks = [ratio(view[i : i + bands.chunk]) for i in range(0, len(text) - bands.chunk + 1, bands.chunk)]
    return ratio(text), ratio(text.translate(SHAPE)), chunks


def limit(nodes: tuple[tuple[float, ...], ...], column: int, size: int) -> float:
    """A column of limits at a size, interpolated over its logarithm."""
    return float(np.interp(np.log2(size), np.log2([x[0] for x in nodes]), [x[column] for x in nodes]))


def outside(chunks: list[float], bands: Bands) -> int:
    low, high = bands.chunk_band
    return sum(not low <= x <= high for x in chunks)


def in_bands(size: int, measured: tuple[float, float, list[float]] | None, bands: Bands) -> bool:
    if measured is None:
        return True
    whole, shape, chunks = measured
    fits = limit(bands.whole, 1, size) <= whole <= limit(bands.whole, 2, size) and shape >= limit(bands.shape, 1, size)
    return fits and outside(chunks, bands) <= bands.chunk_share * len(chunks)


def base_failed(made: tuple[int, int, int, int, int]) -> bool:
    return made[0] < 10 or 100 * made[4] > 20 * made[0]


def quality(documents: DataFrame, bands: Bands = Bands(), text: str = "text") -> DataFrame:
    """All columns of ``documents`` and the verdict of the rules for each row.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio and shape_ratio (null for a
    text too short to judge), n_chunks, bad_chunks and kept; columns of these names in the input are replaced. A null
    text counts as empty: no words, so it fails the base rules. Rows are judged one by one: repeated rows get equal
    verdicts, an empty table gives an empty one. Nothing is shuffled, and memory holds one batch.
    """

    def judge(cols: Lists) -> Lists:
        zstd = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
        rows = []
        for body in cols[text]:
            raw = body or b""
            made, measured = counts(raw), ratios(raw, bands, zstd)
            failed = base_failed(made)
            whole, shape, chunks = measured or (None, None, [])
            kept = not failed and in_bands(len(raw), measured, bands)
            rows.append((*made, failed, whole, shape, len(chunks), outside(chunks, bands), kept))
        return dict(zip(ADDED, map(list, zip(*rows, strict=True)) if rows else [[] for _ in ADDED], strict=True))

    return add_columns(documents, [text], judge, ", ".join(f"{k} {v}" for k, v in ADDED.items()))


# --- bands around labelled documents

#: Fewer good documents than this, and the bands stay as they are; also the least a size group holds.
ENOUGH = 100
#: Sizes up to which fitted limits go on rising as between the two largest groups.
LONGEST = 1 << 30


def group_count(rows: int) -> int:
    return min(16, max(2, rows // ENOUGH))


def middle_line(at: np.ndarray, middle: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and heights of the line through the groups' middles, from the least size to the longest texts."""
    slope = (middle[-1] - middle[-2]) / (at[-1] - at[-2]) if len(at) > 1 else 0.0
    start = (middle[1] - middle[0]) / (at[1] - at[0]) if len(at) > 1 else 0.0
    ends = np.array([min(least, at[0]) - 0.01, *at, max(np.log2(LONGEST), at[-1] + 1)])
    return ends, np.array([middle[0] + start * (ends[0] - at[0]), *middle, middle[-1] + max(slope, 0.0) * (ends[-1] - at[-1])])


def limits(ends: np.ndarray, line: np.ndarray, bounds: list[np.ndarray], slack: float) -> list[tuple[float, float, float]]:
    """(bytes, low, high) along a line, from the quantiles of each group's distances from it."""
    wide = [(1 + slack) * np.asarray(b) for b in (bounds[0], *bounds, bounds[-1])]
    return [(float(2**e), float(m + low), float(m + high)) for e, m, (low, high) in zip(ends, line, wide, strict=True)]


def curve(sizes: np.ndarray, values: np.ndarray, share: float, slack: float) -> list[tuple[float, float, float]]:
    """(bytes, low, high) around ``values`` by groups of similar size, so that about ``share`` lies beyond each limit.

    The limits are quantiles of the distance from the middle line, moved out by ``slack`` times themselves. Past the
    largest group the middle line goes on with its last slope, since longer texts keep compressing a little better.
    This is what ``fit`` does over tables, for arrays.
    """
    x = np.log2(sizes)
    groups = np.array_split(np.argsort(x, kind="stable"), group_count(len(x)))
    at, same = np.unique([math.fsum(x[g]) / len(g) for g in groups], return_inverse=True)
    groups = [np.concatenate([g for g, k in zip(groups, same, strict=True) if k == i]) for i in range(len(at))]
    ends, line = middle_line(at, np.array([np.median(values[g]) for g in groups]), x.min())
    apart = values - np.interp(x, ends, line)
    return limits(ends, line, [np.quantile(apart[g], [share, 1 - share]) for g in groups], slack)


def numbered(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with ``position``, their number from 0 in the order of ``by``.

    They are sorted by ranges and written; the driver gets the number of rows of each partition. ``by`` should tell rows
    apart, so that many equal values do not meet in one task.
    """
    stored = written(rows.orderBy(*by).withColumn("position", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("position", 33)  # as Spark numbers them: the partition, then the row in it
    moves, at = [], 0
    for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        moves.append((r["part"], at - (r["part"] << 33)))
        at += r["n"]
    moved = rows.sparkSession.createDataFrame(moves, "__part long, __move long")
    placed = stored.join(F.broadcast(moved), part == F.col("__part"))
    return placed.withColumn("position", F.col("position") + F.col("__move")).drop("__part", "__move")


def quantiles(rows: DataFrame, asked: dict[int, tuple[float, ...]]) -> dict[int, np.ndarray]:
    """The asked quantiles of ``value`` for each ``key``, from all rows and linear between neighbours.

    ``place`` tells equal values apart. The driver gets two values a quantile, and the size of each key.
    """
    stored = numbered(rows, "key", "value", "place")
    sizes = sorted((r["key"], r["n"]) for r in stored.groupBy("key").agg(F.count("*").alias("n")).collect())
    starts, at = {}, 0
    for key, n in sizes:
        starts[key] = (at, n)
        at += n
    spots = {k: starts[k][0] + (starts[k][1] - 1) * np.array(shares) for k, shares in asked.items()}
    wanted = sorted({int(f(x)) for spot in spots.values() for x in spot for f in (np.floor, np.ceil)})
    found = {r["position"]: r["value"] for r in stored.where(F.col("position").isin(wanted)).select("position", "value").collect()}
    heights = [found[p] for p in wanted]
    return {k: np.interp(spot, wanted, heights) for k, spot in spots.items()}


def fit(
    documents: DataFrame,
    labels: DataFrame,
    bands: Bands = Bands(),
    share: float = 0.002,
    slack: float = 0.4,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Bands:
    """``bands`` with the limits of whole texts, shapes and chunks drawn around all documents that are labelled good.

    Good is an id with the label 1 and no other. Documents that fail the base rules or are too short to judge are left
    out. All documents are measured where they lie, so no text is shuffled to its label; medians and quantiles are
    picked by their place among the sorted measures of all good documents, and the driver gets some numbers for each of
    at most 16 groups of similar size. ``share`` of the documents may lie beyond each limit, which is then moved out by
    ``slack`` of its distance. Null ids, labels and texts are left out; repeated rows count each; with fewer than
    ``ENOUGH`` good documents, and so for empty tables, ``bands`` are returned unchanged. Only the named columns are
    read.
    """
    one = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).groupBy("id")
    good = one.agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low = 1 AND high = 1 AND id IS NOT NULL").select("id")
    rows = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body")).where("id IS NOT NULL AND body IS NOT NULL")
    rows = rows.withColumn("place", F.xxhash64("id", "body"))

    def measure(cols: Lists) -> Lists:
        zstd = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
        out: Lists = {"x": [], "whole": [], "shape": [], "middle": []}
        for raw in cols["body"]:
            found = None if base_failed(counts(raw)) else ratios(raw, bands, zstd)
            whole, shape, chunks = found or (None, None, [])
            x = None if found is None else float(np.log2(len(raw)))
            for name, value in zip(out, (x, whole, shape, float(np.median(chunks)) if chunks else None), strict=True):
                out[name].append(value)
        return out

    made = add_columns(rows, ["body"], measure, "x double, whole double, shape double, middle double", drop=("body",))
    made = written(made.where("whole IS NOT NULL"), "measured")  # once, though a sort reads its rows twice
    seen = numbered(made.join(good.hint("merge"), "id", "left_semi"), "x", "place", "id")
    total = seen.count()
    if total < ENOUGH:
        return bands
    n = group_count(total)
    least, over = divmod(total, n)  # the first groups hold one more, as of np.array_split
    edge = over * (least + 1)
    group = F.expr(f"CAST(IF(position < {edge}, position DIV {least + 1}, {over} + (position - {edge}) DIV {least}) AS INT)")
    seen = seen.withColumn("group", group)
    exact = F.sum(F.col("x").cast("decimal(20,15)"))  # the same in any order
    sums = seen.groupBy("group").agg(F.count("*").alias("n"), exact.alias("x"), F.min("x").alias("least"), F.count("middle").alias("long")).orderBy("group").collect()
    at, same = np.unique([float(r["x"] / r["n"]) for r in sums], return_inverse=True)  # groups of one size are one
    seen = seen.withColumn("group", F.element_at(F.array(*[F.lit(int(k)) for k in same]), F.col("group") + 1))
    k = len(at)

    stacked = seen.selectExpr("place", f"stack(3, group, whole, {k} + group, shape, {2 * k}, middle) AS (key, value)").where("value IS NOT NULL")
    asked = {i: (0.5,) for i in range(2 * k)}
    enough_long = sum(r["long"] for r in sums) >= ENOUGH
    found = quantiles(stacked, asked | ({2 * k: (share, 0.5, 1 - share)} if enough_long else {}))
    shortest = min(r["least"] for r in sums)
    lines = {name: middle_line(at, np.concatenate([found[first + i] for i in range(k)]), shortest) for name, first in (("whole", 0), ("shape", k))}

    def apart(cols: Lists) -> Lists:
        return {name: (np.array(cols[name], float) - np.interp(np.array(cols["x"], float), *lines[name])).tolist() for name in lines}

    distant = add_columns(seen.select("place", "group", "x", "whole", "shape"), ["x", *lines], apart, "whole double, shape double", drop=("x",))
    stacked = distant.selectExpr("place", f"stack(2, group, whole, {k} + group, shape) AS (key, value)")
    bounds = quantiles(stacked, {i: (share, 1 - share) for i in range(2 * k)})
    whole, shape = (limits(*lines[name], [bounds[first + i] for i in range(k)], slack) for name, first in (("whole", 0), ("shape", k)))
    band = bands.chunk_band
    if enough_long:
        low, centre, high = found[2 * k]
        band = (float((low - centre) * (1 + slack) + centre), float((high - centre) * (1 + slack) + centre))
    return replace(bands, whole=tuple(whole), shape=tuple((s, low) for s, low, _ in shape), chunk_band=band)
