"""Ranked lexical search over a K2-treap of the term-document grid.

Rows of the grid are terms, columns documents, and a cell holds the term's impact on the document's score. A quadtree
over it keeps only cells that are not empty, each with the largest impact below it: one sorted array of Morton codes
and one of maxima a level. An item descends from the root along the paths of all its rows jointly: for a range of
documents, the maxima of the cells its rows pass through add up to a bound, the range with the best bound is split
next, and ranges whose bound cannot reach the item's worst place any more are never opened.

The grid is cut into shards of ``SHARD`` documents, one treap each, built and asked inside a task; an item's places go on
from shard to shard, so later shards open less. Postings are made and written once, because scores need counts over all
documents. Only rows that items ask for are indexed; every document is.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, cut, flat_map, written

#: Documents of a shard, 2 to this power.
SHARD_BITS = 13
#: Ranges of 2 to this power documents are scored, not split.
LEAF_BITS = 3
#: Ranges that are opened together.
WIDTH = 16
#: Terms asked by a block of items, about; a block's terms travel with the tasks.
BLOCK = 1 << 16
#: Bytes of a text that are split at once.
PIECE = 1 << 20
#: Longer terms are known by a hash.
LONG = 64
#: Stands for a null id, which comes after all others.
NO_ID = (1 << 63) - 1

_SPACE = 32
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else _SPACE for c in range(256))


# --- terms


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    plain = (text or b"").translate(_TABLE)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE) if len(plain) - start > PIECE else -1
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def known_as(term: bytes) -> bytes:
    return term if len(term) <= LONG else b" " + blake2b(term, digest_size=24).digest()


def asked_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item, term: the distinct terms of each item."""

    def split(batches: Iterator[Lists]) -> Iterator[Lists]:
        for batch in batches:
            for item, body in zip(batch["item"], batch["body"], strict=True):
                found = sorted({known_as(t) for piece in terms(body) for t in piece})
                yield {"item": [item] * len(found), "term": found}

    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("item"), F.col(f"`{text}`").cast("string").alias("body"))
    return flat_map(rows, split, "item long, term binary").distinct()


def postings(documents: DataFrame, id_col: str, text: str, slots: dict[bytes, int]) -> DataFrame:
    """doc, n, slots, tfs of every document: its terms in all, and those of ``slots`` with their counts."""

    def count(batches: Iterator[Lists]) -> Iterator[Lists]:
        for batch in batches:
            out: Lists = {"doc": batch["doc"], "n": [], "slots": [], "tfs": []}
            for body in batch["body"]:
                n, found = 0, Counter()
                for piece in terms(body):
                    n += len(piece)
                    for term, tf in Counter(piece).items():
                        at = slots.get(term if len(term) <= LONG else known_as(term))
                        if at is not None:
                            found[at] += tf
                out["n"].append(n)
                out["slots"].append(list(found.keys()))
                out["tfs"].append(list(found.values()))
            yield out

    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("body"))
    return flat_map(rows, count, "doc long, n long, slots array<int>, tfs array<int>")


# --- the treap


def spread(x: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2^32, each followed by a zero."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """Impact maxima of a grid's non-empty quadrants; ``levels[s]`` has cells of 2^s rows and columns."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, height: int):
        codes = (spread(rows) << np.uint64(1)) | spread(cols)
        order = np.argsort(codes)
        codes, maxima = codes[order], impacts[order]
        self.levels = [(codes, maxima)]
        for _ in range(height):
            above = codes >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(above) else np.empty(0, int)
            codes, maxima = above[starts], np.maximum.reduceat(maxima, starts) if len(starts) else maxima
            self.levels.append((codes, maxima))

    def at(self, level: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Maxima of the cells at ``cols`` (first axis) and row paths ``rows`` (second axis, spread); 0 where empty."""
        codes, maxima = self.levels[level]
        asked = spread(cols)[:, None] | rows[None, :]
        place = np.searchsorted(codes, asked)
        place[place == len(codes)] = 0
        return np.where(codes[place] == asked, maxima[place], 0)


class Paths:
    """An item's rows at every level of the treap, with how many of them share a cell."""

    def __init__(self, rows: np.ndarray, height: int):
        self.levels = []
        for s in range(height + 1):
            cells, times = np.unique(rows >> s, return_counts=True)
            self.levels.append((spread(cells) << np.uint64(1), times))


def descend(treap: Treap, paths: Paths, ids: np.ndarray, height: int, top: int, best: list[tuple[int, int]]) -> None:
    """Puts the item's places among ``ids`` into ``best``, a heap of (score, -id) of at most ``top``.

    ``ids`` ascend, so a range's first id tells whether it can win a tie.
    """
    n = len(ids)

    def beaten(bound: int, first: int) -> bool:
        return bound <= 0 or len(best) == top and (bound, -int(ids[first])) <= best[0]

    rows, times = paths.levels[height]
    bound = int((treap.at(height, rows, np.zeros(1, int)) * times).sum())
    open_: list[tuple[int, int, int]] = [(-bound, 0, height)]  # bound, first document, level
    while open_:
        bound, first, level = heapq.heappop(open_)
        if beaten(-bound, first):
            if bound == 0 or -bound < best[0][0]:
                return
            continue
        firsts = [first]
        while open_ and len(firsts) < WIDTH and open_[0][2] == level and not beaten(-open_[0][0], open_[0][1]):
            firsts.append(heapq.heappop(open_)[1])
        at = np.array(firsts)
        if level <= LEAF_BITS:
            cols = (at[:, None] + np.arange(1 << level)[None, :]).ravel()
            cols = cols[cols < n]
            rows, times = paths.levels[0]
            scores = (treap.at(0, rows, cols) * times).sum(axis=1)
            for k in np.flatnonzero(scores >= max(1, best[0][0] if len(best) == top else 1)):
                found = (int(scores[k]), -int(ids[cols[k]]))
                if len(best) < top:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        else:
            level -= 1
            halves = (at[:, None] + np.array([0, 1 << level])[None, :]).ravel()
            halves = halves[halves < n]
            rows, times = paths.levels[level]
            bounds = (treap.at(level, rows, halves >> level) * times).sum(axis=1)
            for b, first in zip(bounds.tolist(), halves.tolist(), strict=True):
                if not beaten(b, first):
                    heapq.heappush(open_, (-b, first, level))


# --- search


def weights(n_documents: int, frequencies: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * int(f) + 1))) for f in frequencies], dtype=np.int64)


def _places(found: DataFrame, asked: dict[int | None, list[int]], weight: np.ndarray, rank: np.ndarray, n_documents: int, n_terms: int, top: int) -> DataFrame:
    """item, doc, score: the best of every task's documents for each item of a block."""
    row_bits = max(1, int(len(weight) - 1).bit_length())
    height = max(SHARD_BITS, row_bits)

    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        best = {item: [] for item in asked}
        paths = {item: Paths(np.sort(rank[slots]), height) for item, slots in asked.items()}
        shard: list[tuple] = []

        def ask() -> None:
            shard.sort(key=lambda row: row[0])
            ids = np.array([row[0] for row in shard], dtype=np.int64)
            sizes = np.array([row[1] for row in shard], dtype=np.int64)
            lengths = np.array([len(row[2]) for row in shard])
            cols = np.repeat(np.arange(len(shard)), lengths)
            slots = np.concatenate([np.asarray(row[2], dtype=np.int64) for row in shard])
            tfs = np.concatenate([np.asarray(row[3], dtype=np.int64) for row in shard])
            m = 50 + (50 * sizes * n_documents) // n_terms
            impacts = weight[slots] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[cols]))
            some = impacts > 0
            treap = Treap(rank[slots[some]], cols[some], impacts[some], height)
            if some.any():
                for item, path in paths.items():
                    descend(treap, path, ids, height, top, best[item])
            shard.clear()

        for batch in batches:
            for doc, n, slots, tfs in zip(batch["doc"], batch["n"], batch["slots"], batch["tfs"], strict=True):
                if slots:
                    shard.append((NO_ID if doc is None else doc, n, slots, tfs))
                if len(shard) == 1 << SHARD_BITS:
                    ask()
        if shard:
            ask()
        rows = [(item, None if doc == -NO_ID else -doc, score) for item, places in best.items() for score, doc in places]
        yield {name: list(values) for name, values in zip(("item", "doc", "score"), zip(*rows, strict=True) if rows else ([], [], []), strict=True)}

    return flat_map(found, run, "item long, doc long, score long")


def search(documents: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best documents with a score above 0.

    Terms are runs of digits, ASCII letters (in lower case) and characters above U+007F, of whole texts. A document's
    score sums w * (10^9 tf div (1000 tf + 20 m)) over the item's terms, once each, in 64-bit integers, with
    w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 50 + 50 n N div L; N counts the documents with a term, L all
    terms, n those of the document, df the documents that hold the term. The result is exact. Equal scores are ranked
    by ascending id, null last. A null or empty text has no term; long ones are split piece by piece. Every row is a
    document, so repeated rows take a place each; rows with the same item id are one item. Empty tables on either
    side give no rows. Other columns are not read.

    Items go in blocks that ask about ``BLOCK`` terms, so what tasks and the driver hold does not grow with the items,
    nor with the documents; each block reads the documents once. A task returns at most ``top`` rows an item.
    """
    asked = written(asked_terms(items, item_id, item_text), "asked-terms")
    blocks = -(-asked.count() // BLOCK)
    found = [_block(documents, asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), top, id_col, text) for b in range(blocks)]
    places = documents.sparkSession.createDataFrame([], "item long, doc long, score long")
    for one in found:
        places = places.union(one)
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    part = Window.partitionBy("item", F.pmod(F.xxhash64("doc"), F.lit(64))).orderBy(*order)
    few = places.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top).drop("rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(id_col), "score")


def _block(documents: DataFrame, asked: DataFrame, top: int, id_col: str, text: str) -> DataFrame:
    by_item: dict[int | None, list[int]] = {}
    slots: dict[bytes, int] = {}
    for item, term in asked.collect():
        by_item.setdefault(item, []).append(slots.setdefault(bytes(term), len(slots)))
    found = cut(postings(documents, id_col, text, slots))
    n_documents, n_terms = found.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequencies = np.zeros(len(slots), dtype=np.int64)
    for slot, df in found.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*")).collect():
        frequencies[slot] = df
    rank = np.empty(len(slots), dtype=np.int64)  # terms that are about as common lie in neighbouring rows
    rank[np.argsort(-frequencies, kind="stable")] = np.arange(len(slots))
    return _places(found, by_item, weights(n_documents, frequencies), rank, n_documents, max(1, n_terms), top)
