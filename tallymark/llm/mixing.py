"""Mixing sources to target weights: blocks of fixed length, drawn per output shard, joined by index.

The words of a source, in the order of its documents' ids and text hashes, are cut into blocks. An output shard holds a
fixed number of slots; how many of them each source gets is a multinomial draw, conditioned on the whole mix meeting the
targets. It is drawn as from an urn that holds a ball for every slot of every source: a pseudorandom permutation says
which ball each slot of the mix takes, so a shard draws its own counts, of any size of mix, without knowing the others.
Ball j of a source is mapped to a block by a pseudorandom permutation of the source's indices, a fresh one each time
all have been used. Slots and blocks meet in a join by (source, index).
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, add_columns, flat_map, written
from tallymark.llm.streams import Marks, placed

ROUNDS = 4
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# --- targets


def order(sources: list[str | None]) -> list[str | None]:
    """Sources by code point, null last."""
    return sorted(sources, key=lambda x: (x is None, x or ""))


def cycle(weights: tuple[float, ...] = (5, 2, 1)) -> Callable[[list[str | None]], list[float]]:
    """Weights that repeat over the sources in their order."""
    return lambda sources: [weights[i % len(weights)] for i in range(len(sources))]


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the sum of ``sizes`` by weight; what exceeds ``most`` times a source's size goes to the others."""
    made, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        for i in free:
            made[i] = left * weights[i] / total
        full = {i for i in free if made[i] > most * sizes[i]}
        if not full:
            break
        for i in full:
            made[i] = most * sizes[i]
        left -= sum(made[i] for i in full)
        free -= full
    return made


# --- draws


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. size - 1 at ``index``: a Feistel network, walked until it falls in range."""
    half = max(1, math.ceil(max(1, (size - 1).bit_length()) / 2))
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key * ROUNDS + r) & mask)
        return left << np.uint64(half) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= size).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    z = x + np.uint64((key * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


@dataclass(frozen=True)
class Plan:
    """Slots of each source in the whole mix, its blocks, slots a shard, and the seed."""

    slots: tuple[int, ...]
    blocks: tuple[int, ...]
    shard: int
    seed: int

    @property
    def total(self) -> int:
        return sum(self.slots)

    @property
    def shards(self) -> int:
        return -(-self.total // self.shard)

    def taken(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Source of each slot of a shard, and which of its source's slots it is."""
        low, high = shard * self.shard, min((shard + 1) * self.shard, self.total)
        ball = permuted(np.arange(low, high, dtype=np.int64), self.total, self.seed)
        ends = np.cumsum(np.array(self.slots, np.int64))
        source = np.searchsorted(ends, ball, side="right")
        return source, ball - (ends[source] - np.array(self.slots, np.int64)[source])

    def draw(self, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source, block and turn (how often all its source's blocks have been used) of each slot of a shard."""
        source, j = self.taken(shard)
        size = np.array(self.blocks, np.int64)[source]
        turn, block = j // size, np.zeros(len(j), np.int64)
        for s, t in np.unique(np.stack([source, turn]), axis=1).T.tolist():
            mine = np.flatnonzero((source == s) & (turn == t))
            key = (self.seed * 1_000_003 + s) * 1_000_003 + t + 1
            block[mine] = permuted(j[mine] - t * self.blocks[s], self.blocks[s], key)
        return source, block, turn


# --- the operator


#: Columns of a mix that carried ones may be named like; those come along as ``<name>_carried``.
RESERVED = frozenset(
    "doc_id source body part row size start base place source_index source_size target blocks shard slot block turn from_word words order1 order2 order3".split()
)


def carried_as(name: str) -> str:
    return f"{name}_carried" if name in RESERVED else name


def sized(documents: DataFrame, id_col: str, text: str, source: str, carry: tuple[str, ...]) -> DataFrame:
    """doc_id, source, body if carried, part, row (in it), size in words, start in its source and partition.

    Rows are sorted by source, id and a hash of the text over all partitions, so their places do not depend on how the
    files were read; rows that agree in all three are equal. A last number that only spreads them over partitions.
    """
    named = {"doc_id": F.col(f"`{id_col}`").cast("long"), "source": F.col(f"`{source}`").cast("string"), "body": F.col(f"`{text}`")}
    named |= {carried_as(c): F.col(f"`{c}`") for c in carry if c not in (id_col, text, source)}
    named |= {"order1": F.xxhash64(F.col(f"`{text}`")), "order2": F.xxhash64(F.lit(1), F.col(f"`{text}`"))}
    body = documents.select(*[v.alias(k) for k, v in named.items()])

    def count(cols: Lists) -> Lists:
        return {"size": [len((x or b"").split()) for x in cols["body"]]}

    counted = add_columns(body, ["body"], count, "size long", () if carry else ("body",))
    keys = ("source", "doc_id", "order1", "order2", "order3")
    ranged = counted.withColumn("order3", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def begin() -> Callable[[Lists], Lists]:
        marks, rows = Marks(), itertools.count()

        def add(cols: Lists) -> Lists:
            return {
                "part": [marks.part] * len(cols["size"]),
                "row": [next(rows) for _ in cols["size"]],
                "start": [marks.start(s, n) for s, n in zip(cols["source"], cols["size"], strict=True)],
            }

        return add

    return add_columns(ranged, ["source", "size"], begin, "part int, row long, start long", ("order1", "order2", "order3"), per_task=True)


@dataclass(frozen=True)
class Mix:
    """A drawn mix: documents with their place in their source, the slots, and what the sources shall give.

    documents: doc_id, source, part, row, size, start, base (its place in its source is base + start), carried columns.
    sources: source, source_index, source_size, target, blocks; one row per source.
    slots: shard, slot, source_index, block, turn; one row per block of the mix.
    """

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    block: int

    def placed(self) -> DataFrame:
        """The documents with place, their first word's index in their source, and the columns of the sources."""
        own = self.sources.withColumnRenamed("source", "__source")
        joined = self.documents.join(own, self.documents["source"].eqNullSafe(own["__source"])).drop("__source")
        return joined.withColumn("place", F.col("base") + F.col("start"))


def mix(
    documents: DataFrame,
    weights: Callable[[list[str | None]], list[float]],
    most: float = 3.0,
    block: int = 128,
    shard: int = 4096,
    seed: int = 7,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: tuple[str, ...] = (),
) -> Mix:
    """Draw a mix of ``documents`` with as many words as they have, in which each source meets its target.

    ``weights`` gives a weight for each source of an ordered list (see ``order``). Targets stop at ``most`` times the
    source's size. A block of a source is used at most ``most`` times, rounded up; with a whole number no document is
    taken more often than that. The last block of a source may be short, so a source's words are within about one
    block of its target. The same rows give the same mix, however they are stored and read.

    The sources are the mix's configuration: the driver holds a row for each, and each shard's draw two numbers. A null
    source is a source, a null text has no words, a source without words has a target of zero, repeated rows count
    each, and an empty table gives an empty mix. Only the named columns are read. To get the mix as text, ``carry`` the
    text column, and others that shall come along; one named like a column of the mix comes as ``<name>_carried``.
    """
    spark = documents.sparkSession
    stored = written(sized(documents, id_col, text, source, carry), "sizes")
    sums = {r["source"]: r["n"] for r in stored.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    names = order(list(sums))
    sizes = [sums[x] for x in names]
    goal = targets(sizes, weights(names), most)
    blocks = [-(-n // block) for n in sizes]
    slots = [min(math.floor(most * b), round(t * b / n)) if n else 0 for t, b, n in zip(goal, blocks, sizes, strict=True)]
    plan = Plan(tuple(slots), tuple(blocks), shard, seed)
    rows = [(x, i, n, t, b) for i, (x, n, t, b) in enumerate(zip(names, sizes, goal, blocks, strict=True))]
    sources = spark.createDataFrame(rows, "source string, source_index int, source_size long, target double, blocks long")
    slots_table = written(_slots(spark, plan), "slots")  # of unknown size until it is written
    return Mix(placed(stored, "source", "size", "bases"), sources, slots_table, block)


def _slots(spark, plan: Plan) -> DataFrame:
    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        for cols in batches:
            for shard in cols["id"]:
                source, block, turn = plan.draw(shard)
                n = len(source)
                yield {"shard": [shard] * n, "slot": np.arange(n), "source_index": source, "block": block, "turn": turn}

    tasks = max(1, min(plan.shards, max(spark.sparkContext.defaultParallelism, plan.total // 1_000_000)))
    return flat_map(spark.range(0, plan.shards, 1, tasks), run, "shard long, slot long, source_index int, block long, turn long")


def taken(mix: Mix) -> DataFrame:
    """doc_id, size, source_size, target and taken: the words of each document in the mix, repeats counted.

    One row per row of the documents. The uses of a block are counted before they meet the pieces of the documents in
    it, which are at most as many as its words.
    """
    uses = mix.slots.groupBy("source_index", "block").agg(F.count("*").alias("uses"))
    last = F.expr(f"(place + size - 1) div {mix.block}")
    spans = F.when(F.col("size") > 0, F.sequence(F.expr(f"place div {mix.block}"), last))
    pieces = mix.placed().withColumn("block", F.explode_outer(spans))
    low = F.greatest(F.col("block") * mix.block, F.col("place"))
    high = F.least((F.col("block") + 1) * mix.block, F.col("place") + F.col("size"))
    used = pieces.join(uses, ["source_index", "block"], "left").withColumn("words", (high - low) * F.col("uses"))
    same = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    summed = used.groupBy("part", "row").agg(*same, F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"))
    return summed.drop("part", "row")


def mixed_text(mix: Mix) -> DataFrame:
    """The mix as text, one row for each piece of a document in each slot that draws its block.

    Columns: shard, slot, turn, doc_id, source, body (the piece), from_word, words and the carried columns. A piece runs
    up to the first word of the next one, so the pieces of a document, put together, are the document.
    """
    placed = mix.placed().where("size > 0").select(*[c for c in mix.documents.columns if c not in ("part", "row", "base", "start")], "source_index", "place")
    block, names = mix.block, placed.columns
    added = {"block": "long", "from_word": "long", "words": "long"}
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema] + [f"{k} {v}" for k, v in added.items()])
    strings = [f.name for f in placed.schema if f.dataType.simpleString() == "string" and f.name != "body"]

    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        for cols in batches:
            for name in strings:
                cols[name] = [None if x is None else x.decode("utf-8", "replace") for x in cols[name]]
            out: Lists = {k: [] for k in [*names, *added]}
            for row in zip(*(cols[k] for k in names), strict=True):
                doc = dict(zip(names, row, strict=True))
                body, place, size = doc["body"], doc["place"], doc["size"]
                starts = [m.start() for m in WORD.finditer(body)]
                for b in range(place // block, (place + size - 1) // block + 1):
                    low, high = max(b * block, place) - place, min((b + 1) * block, place + size) - place
                    cut = body[starts[low] if low else 0 : starts[high] if high < size else len(body)]
                    made = doc | {"body": cut.decode("utf-8", "replace"), "block": b, "from_word": low, "words": high - low}
                    for k, v in made.items():
                        out[k].append(v)
            yield out

    # the slots grow with the mix, so they are never sent whole
    slots = mix.slots.hint("merge")
    return flat_map(placed, run, ddl).join(slots, ["source_index", "block"]).drop("place", "source_index", "size")
