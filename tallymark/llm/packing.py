"""Mixture-controlled packing: deficit round-robin over queues of documents fills every sequence.

Each source is a queue of tokens with a weight. Every round (one sequence, or several where a queue's share of one would
be less than a token) grants each queue its share; what cannot be served in whole tokens is carried on as a deficit,
to the next queue and to the next round, so that over time each queue gets its weight exactly. A queue that runs dry
leaves its share to the others. Deficits carried this way have a closed form: with the queues in the order in which
they end, what all queues before one have got in any number of rounds follows from the totals and weights alone. A
document finds its sequences from its place in its queue, every partition cuts its own documents, with the deficits
carried across partitions, and nothing is shuffled but one row per partition and source.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, flat_map, written
from tallymark.llm.streams import Marks
from tallymark.llm.tokens import TextEncoder, WordEncoder, shared

PIECES = (
    "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, `offset` long, ids binary"
)


# --- the round-robin


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 0, 1, ..., count - 1 of each entry: the entry's index, and the number."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


class Schedule:
    """The rounds of all queues until every queue is empty; four numbers a queue, whatever their number."""

    def __init__(self, totals: list[int], weights: list[int], window: int):
        n, all_ = len(totals), sum(totals)
        order = sorted(range(n), key=lambda q: (Fraction(totals[q], weights[q]), q))
        t, w = [totals[q] for q in order], [weights[q] for q in order]
        tokens, shares = [0, *accumulate(t)], [0, *accumulate(w)]
        left = [shares[-1] - x for x in shares[:-1]] + [1]
        #: Every queue's share of a round is a token at least, so what it has got never falls.
        self.window, self.round = window, window * max(1, -(-shares[-1] // window))
        kind = np.int64 if (all_ + self.round) * max(1, shares[-1]) < 1 << 62 else object
        self.rank = np.argsort(np.array(order, np.int64), kind="stable")
        self.tokens, self.shares, self.left = (np.array(x, kind) for x in (tokens, shares, left))
        #: Tokens given when each queue ends, rounded down; and the time of its end in tokens a weight.
        self.ends = np.array([tokens[i] + t[i] * left[i] // w[i] for i in range(n)], kind)
        self.times = np.array([x / y for x, y in zip(t, w, strict=True)], float)

    def ahead(self, q: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Tokens that all queues before the ``q``-th to end have got after so many rounds."""
        given = rounds * self.round
        ended = np.searchsorted(self.ends, given, "left")
        before = self.tokens[ended]
        some = before + (self.shares[q] - self.shares[ended]) * (given - before) // self.left[ended]
        return np.where(q <= ended, self.tokens[q], some)

    def given(self, q: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        return self.ahead(q + 1, rounds) - self.ahead(q, rounds)

    def _round_of(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The round that serves the token ``at`` of a queue: near where an even flow would, then exactly."""
        time = at / (self.shares[q + 1] - self.shares[q])
        ended = np.minimum(np.searchsorted(self.times, time.astype(float)), len(self.times) - 1)
        found = np.maximum(((self.tokens[ended] + time * self.left[ended]) // self.round).astype(np.int64) - 1, 0)
        found = found.astype(self.tokens.dtype)
        while (late := self.given(q, found) > at).any():
            found = found - late
        while (early := self.given(q, found + 1) <= at).any():
            found = found + early
        return found

    def pieces(self, queues: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """row, position in the queue, tokens, window and offset in it, for the pieces of runs of tokens of queues.

        Runs have at least one token; the pieces of a run follow each other in the order of their positions.
        """
        q, starts = self.rank[queues], starts.astype(self.tokens.dtype)
        stops = starts + lengths
        first = self._round_of(q, starts)
        rows, k = spread((self._round_of(q, stops - 1) - first + 1).astype(np.int64))
        q, k = q[rows], first[rows] + k
        a, b, c, d = self.ahead(q, k), self.ahead(q, k + 1), self.ahead(q + 1, k), self.ahead(q + 1, k + 1)
        low, high = np.maximum(c - a, starts[rows]), np.minimum(d - b, stops[rows])
        place = k * self.round + (b - a) + (low - (c - a))  # among all tokens of all queues
        windows = np.where(high > low, (place + high - low - 1) // self.window - place // self.window + 1, 0)
        again, i = spread(windows.astype(np.int64))  # a round of several windows is cut where they end
        rows, low, high, place = rows[again], low[again], high[again], place[again]
        window = place // self.window + i
        begin = np.maximum(window * self.window, place)
        size = np.minimum((window + 1) * self.window, place + high - low) - begin
        return rows, low + begin - place, size, window, begin - window * self.window


# --- the operator


def tokenized(documents: DataFrame, tokenizer: str, end_id: int | None, by_word: bool, id_col: str, text: str, source: str) -> DataFrame:
    """part, doc_id, source, start (in its source and partition), n and ids of each document, in stored order."""
    body = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").alias("body"))

    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        make = WordEncoder if by_word else TextEncoder
        encoder, marks = shared((make.__name__, tokenizer), lambda: make(tokenizer)), Marks()
        tail, width = b"" if end_id is None else np.array([end_id], encoder.dtype).tobytes(), encoder.dtype.itemsize
        for cols in batches:
            ids = [x + tail for x in encoder.texts([x or b"" for x in cols["body"]])]
            sizes = [len(x) // width for x in ids]
            sources = [None if x is None else x.decode("utf-8", "replace") for x in cols["source"]]
            yield {
                "part": [marks.part] * len(ids),
                "doc_id": cols["doc_id"],
                "source": sources,
                "start": [marks.start(s, n) for s, n in zip(sources, sizes, strict=True)],
                "n": sizes,
                "width": [width] * len(ids),
                "ids": ids,
            }

    return flat_map(body, run, "part int, doc_id long, source string, start long, n long, width int, ids binary")


def pack(
    documents: DataFrame,
    tokenizer: str,
    length: int = 2048,
    targets: dict[str | None, float] | None = None,
    end_id: int | None = 1,
    resolution: int = 1024,
    by_word: bool = True,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per piece of a document in a sequence: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. All tokens of all documents are
    packed; a document is cut wherever a sequence ends. Sequences are full but for the last one.

    ``targets`` weighs the sources; None takes their shares of all tokens, so all run out together. Weights are
    rounded to ``resolution`` parts. A source of less than one part, or without a target, queues in one common queue
    for the rest, which takes partition by partition what they hold. The driver holds one row for each of the at most
    ``resolution`` or ``len(targets)`` other queues.

    ``by_word`` is for tokenizers that split at white space and drop it. A null or empty text has the end token only,
    or no row if ``end_id`` is None; a null source is a source; repeated rows are packed each; an empty table gives an
    empty one. Only the three named columns are read.
    """
    stored = written(tokenized(documents, tokenizer, end_id, by_word, id_col, text, source), "tokens")
    sums = stored.groupBy("source").agg(F.sum("n").alias("n")).where("n > 0")
    total = sums.agg(F.sum("n")).first()[0] or 0
    if targets is None:
        large = [(r["source"], r["n"], r["n"]) for r in sums.where(F.col("n") * resolution >= total).collect()]
    else:
        wanted = [x for x in targets if x is not None]
        asked = F.col("source").isin(wanted) | (F.col("source").isNull() if None in targets else F.lit(False))
        large = [(r["source"], r["n"], targets[r["source"]]) for r in sums.where(asked).collect() if targets[r["source"]] > 0]
    large.sort(key=lambda x: (x[0] is None, x[0] or ""))
    rest = total - sum(x[1] for x in large)
    share = sum(x[2] for x in large) or 1
    parts = [x[2] / share * (1 - (rest / total if targets is None and total else 0)) for x in large] + ([rest / total] if rest else [])
    weights = [max(1, round(resolution * x)) for x in parts]
    totals = [x[1] for x in large] + ([rest] if rest else [])
    schedule = Schedule(totals, weights, length)

    names = documents.sparkSession.createDataFrame([(x[0], i) for i, x in enumerate(large)], "__name string, queue int")
    names = written(names, "queues")  # joined by its true size
    queued = stored.join(names, stored["source"].eqNullSafe(names["__name"]), "left").drop("__name")
    return _cut(placed_in_queues(queued.withColumn("queue", F.coalesce("queue", F.lit(len(large))))), schedule)


def placed_in_queues(rows: DataFrame) -> DataFrame:
    """``rows`` with ``base``, the place in its queue of the start of their source's documents in their partition.

    A queue takes what each partition holds of it in turn, source by source. Sizes are summed per partition and source
    first: one running sum sees a row per partition, the other the sources of one partition.
    """
    sums = rows.groupBy("part", "queue", "source").agg(F.sum("n").alias("n"))
    parts = sums.groupBy(F.col("part").alias("__part"), F.col("queue").alias("__queue")).agg(F.sum("n").alias("n"))
    upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("__part", "__queue", upto(Window.partitionBy("__queue").orderBy("__part")).alias("__before"))
    inside = sums.select("part", "queue", F.col("source").alias("__source"), upto(Window.partitionBy("part", "queue").orderBy(F.col("source").asc_nulls_last())).alias("__inside"))
    bases = inside.join(parts, (F.col("part") == F.col("__part")) & (F.col("queue") == F.col("__queue")))
    bases = written(bases.select("__part", "__source", (F.col("__before") + F.col("__inside")).alias("base")), "bases")
    return rows.join(bases, (rows["part"] == bases["__part"]) & rows["source"].eqNullSafe(bases["__source"])).drop("__part", "__source")


def _cut(rows: DataFrame, schedule: Schedule) -> DataFrame:
    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        for cols in batches:
            place, n = (np.array(cols[k], np.int64) for k in ("place", "n"))
            row, at, size, window, offset = schedule.pieces(np.array(cols["queue"], np.int64), place, n)
            start = (at - place[row]).astype(np.int64)
            wide = [np.frombuffer(x, f"<u{w}").astype("<u4").tobytes() for x, w in zip(cols["ids"], cols["width"], strict=True)]
            names = [None if x is None else x.decode("utf-8", "replace") for x in cols["source"]]
            row, size, low = row.tolist(), size.tolist(), start.tolist()
            yield {
                "doc_id": [cols["doc_id"][r] for r in row],
                "source": [names[r] for r in row],
                "start": low,
                "length": size,
                "doc_tokens": [cols["n"][r] for r in row],
                "sequence_id": window.tolist(),
                "offset": offset.tolist(),
                "ids": [wide[r][4 * x : 4 * (x + k)] for r, x, k in zip(row, low, size, strict=True)],
            }

    ready = rows.where("n > 0").select("doc_id", "source", "queue", (F.col("base") + F.col("start")).alias("place"), "n", "width", "ids")
    return flat_map(ready, run, PIECES)
