"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A sketch is a few rows of cells. Every paragraph digest is XORed into one cell of each row, which also counts it. The
difference of two sketches holds only the digests in which the texts differ; a cell with exactly one of them shows it,
it is taken out of its other cells, and so on until nothing is left. If digests remain, they were too many for the
sketch, and larger sketches are made. All of this is built-in column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of cells; each digest lies in one cell of each.
ROWS = 3
#: Cells of the sketch that serves as fingerprint; it opens differences of about two thirds as many paragraphs.
CELLS = 24
#: Code points from which a paragraph is cut.
WIDTH = 512
#: Peeling ends after so many rounds; a sketch that is not open then counts as failed.
ROUNDS = 12
#: Retries deal the digests by hash into groups of about this many, with a sketch each, so that their cost grows in
#: proportion to the text; the cells of a group's sketch in each retry.
GROUP = 20
RETRIES = (54, 108, 216)
MOST_BUCKETS = 4096


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


# --- digests and sketches


def digests(text: Column, width: int = WIDTH) -> Column:
    """Distinct digests of a text's paragraphs: its lines, long ones cut every ``width`` code points.

    A digest is 48 bits of XXH64 and 16 check bits made from them, so that a cell can tell a digest from a mixture.
    An empty text has none.
    """
    parts = F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{width}}}"), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda x: let(F.shiftrightunsigned(F.xxhash64(x), 16), _checked)))


def _checked(high: Column) -> Column:
    return F.shiftleft(high, 16).bitwiseOR(F.xxhash64(high).bitwiseAND(F.lit(0xFFFF).cast("long")))


def _is_digest(key: Column) -> Column:
    return _checked(F.shiftrightunsigned(key, 16)) == key


def _cell(key: Column, row: int, size: Column) -> Column:
    """Cell of a digest in a row of ``size`` cells, numbered through all rows."""
    return F.pmod(F.xxhash64(key, F.lit(row)), size) + size * row


def sketch(keys: Column, cells: Column) -> Column:
    """count and key of every cell; ``cells`` is rounded up to whole rows."""
    return let(_row(cells), lambda size: _sketch(keys, size))


def _sketch(keys: Column, size: Column) -> Column:
    def row(r: int) -> Column:
        placed = F.transform(keys, lambda k: F.struct(_cell(k, r, size).alias("at"), k.alias("key")))

        def cells_of(found: Column) -> Column:
            def cell(i: Column) -> Column:
                inside = F.filter(found, lambda x: x["at"] == i)
                return let(inside, lambda x: F.struct(F.size(x).alias("count"), F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a.bitwiseXOR(y["key"])).alias("key")))

            return F.transform(F.sequence(size * r, size * (r + 1) - 1), cell)

        return let(placed, cells_of)

    return F.concat(*[row(r) for r in range(ROWS)])


def _row(cells: Column) -> Column:
    return F.greatest(F.ceil(cells / ROWS), F.lit(2)).cast("long")


def as_text(sketch_: Column) -> Column:
    """Two hexadecimal digits for the count modulo 256 and sixteen for the key of each cell."""
    two = lambda c: F.lpad(F.hex(F.pmod(c, F.lit(256)).cast("long")), 2, "0")
    return F.lower(F.array_join(F.transform(sketch_, lambda x: F.concat(two(x["count"]), F.lpad(F.hex(x["key"]), 16, "0"))), ""))


def subtract(a: Column, b: Column) -> Column:
    """Cell by cell: counts subtracted, keys XORed."""
    pair = lambda x, y: F.struct((x["count"] - y["count"]).alias("count"), x["key"].bitwiseXOR(y["key"]).alias("key"))
    return F.zip_with(a, b, pair)


def peel(difference: Column) -> Column:
    """open, left, right: whether every cell came out empty, and the digests of the first and the second text only."""
    return let(difference, lambda cells: let((F.size(cells) / ROWS).cast("long"), lambda size: _peel(cells, size)))


def _peel(difference: Column, size: Column) -> Column:
    empty = F.array().cast("array<bigint>")

    def pure(cells: Column) -> Column:
        """Digests that lie alone in a cell, with their count and cells."""
        places = lambda k: [_cell(k, r, size).alias(f"c{r}") for r in range(ROWS)]
        alone = F.filter(cells, lambda x: (F.abs(x["count"]) == 1) & _is_digest(x["key"]))
        return F.transform(F.array_distinct(alone), lambda x: F.struct(x["count"].alias("count"), x["key"].alias("key"), *places(x["key"])))

    def without(cells: Column, found: Column) -> Column:
        def clean(x: Column, i: Column) -> Column:
            here = F.filter(found, lambda p: (p["c0"] == i) | (p["c1"] == i) | (p["c2"] == i))
            taken = lambda h: F.struct(
                (x["count"] - F.aggregate(h, F.lit(0), lambda a, p: a + p["count"])).alias("count"),
                F.aggregate(h, x["key"], lambda a, p: a.bitwiseXOR(p["key"])).alias("key"),
            )
            return let(here, taken)

        return F.transform(cells, clean)

    def side(found: Column, sign: int) -> Column:
        return F.transform(F.filter(found, lambda p: p["count"] == sign), lambda p: p["key"])

    def step(state: Column, _: Column) -> Column:
        def go(found: Column) -> Column:
            after = F.struct(
                without(state["cells"], found).alias("cells"),
                F.concat(state["left"], side(found, 1)).alias("left"),
                F.concat(state["right"], side(found, -1)).alias("right"),
            )
            return F.when(F.size(found) > 0, after).otherwise(state)

        return let(pure(state["cells"]), go)

    start = F.struct(difference.alias("cells"), empty.alias("left"), empty.alias("right"))
    ended = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    clear = lambda s: ~F.exists(s["cells"], lambda x: (x["count"] != 0) | (x["key"] != 0))
    return let(ended, lambda s: F.struct(clear(s).alias("open"), s["left"].alias("left"), s["right"].alias("right")))


def differing(a: Column, b: Column, cells: int = CELLS) -> Column:
    """left, right: digests that only one of two digest arrays has, recovered from sketches; larger ones on failure.

    If even the largest sketch fails, which takes digests that share all cells, the arrays themselves are compared.
    """

    def opened(x: Column, y: Column, size: int) -> Column:
        return peel(subtract(sketch(x, F.lit(size)), sketch(y, F.lit(size))))

    def in_groups(size: int, groups: Column) -> Column:
        own = lambda keys, g: F.filter(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(ROWS)), groups) == g)
        parts = F.transform(F.sequence(F.lit(0), groups - 1), lambda g: let(own(a, g), lambda x: let(own(b, g), lambda y: opened(x, y, size))))
        side = lambda ps, name: F.flatten(F.transform(ps, lambda p: p[name]))
        whole = lambda ps: F.struct(F.forall(ps, lambda p: p["open"]).alias("open"), side(ps, "left").alias("left"), side(ps, "right").alias("right"))
        return let(parts, whole)

    groups = F.ceil((F.size(a) + F.size(b) + 1) / GROUP).cast("long")
    tries = [opened(a, b, cells)] + [let(groups, lambda g, size=size: in_groups(size, g)) for size in RETRIES]
    found = [let(t, lambda p: F.when(p["open"], F.struct(p["left"].alias("left"), p["right"].alias("right")))) for t in tries]
    exact = F.struct(F.array_except(a, b).alias("left"), F.array_except(b, a).alias("right"))
    return F.coalesce(*found, exact)


def likeness(a: Column, b: Column, cells: int = CELLS) -> Column:
    """Shared paragraphs over all paragraphs of both texts, from the differing ones; two texts without any are alike."""

    def share(d: Column) -> Column:
        apart = F.size(d["left"]) + F.size(d["right"])
        both = F.size(a) + F.size(b)
        return F.when(both == 0, F.lit(1.0)).otherwise((both - apart) / (both + apart))

    return let(differing(a, b, cells), share)


# --- each document and the next one


def with_next(documents: DataFrame, order: str, lead: list[str], tie: str) -> DataFrame:
    """``documents`` with next_<c> for the columns ``lead`` of the next row by descending ``order``; the last is followed
    by the first.

    ``order`` is cut into ranges at values that occur in it, so that each range is a window of its own. The first row
    of a range is also sent to the range before it, as a guest that only lends its columns. Null is the least value;
    equal values are ordered by ``tie``.
    """
    key = F.coalesce(F.col(order), F.lit(-(1 << 63)).cast("long"))
    n = min(MOST_BUCKETS, 3 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = [i / n for i in range(1, n)] + [1.0]
    found = documents.agg(F.percentile_approx(key, at).alias("p"), F.max(key).alias("m")).first()
    bounds = sorted({*(found["p"] or []), found["m"]} - {None})
    if not bounds:
        return documents.withColumns({f"next_{c}": F.col(c) for c in lead}).limit(0)

    def bucket(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("__key") <= bounds[middle], bucket(low, middle)).otherwise(bucket(middle + 1, high))

    own, last = F.col("__own"), len(bounds) - 1
    place = lambda b, guest, wrap: F.struct(b.alias("bucket"), F.lit(guest).alias("guest"), F.lit(wrap).alias("wrap"))
    first = F.col("__key").isin(bounds) if last < 64 else F.col("__key") == F.element_at(F.array(*map(F.lit, bounds)), own + 1)
    guest = F.when(first, place(F.when(own == last, F.lit(0)).otherwise(own + 1), True, False))
    spread = F.filter(F.array(place(own, False, False), guest), lambda x: x.isNotNull())
    rows = documents.withColumn("__key", key).withColumn("__own", bucket(0, last)).withColumn("__at", F.explode(spread))
    wrapped = F.col("__at.guest") & (own == last)
    window = Window.partitionBy("__at.bucket").orderBy(wrapped, F.col("__key").desc(), F.col(tie))
    led = rows.withColumns({f"next_{c}": F.lead(c).over(window) for c in lead})
    return led.where(~F.col("__at.guest")).drop("__key", "__own", "__at")


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """One row per document: id, n_chars, fingerprint, and those of its edited text, with both likenesses.

    The edited text is the first half of the document, rounded up, and then as many code points of the next document
    by descending id as were cut off (or all it has). Columns: the id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. A null text counts as empty, and an empty text as one without
    paragraphs; equal texts have equal fingerprints. Equal ids are ordered by a hash of their text, null ids come
    last, a single document is its own successor, an empty table gives an empty one. Other columns are not read.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), body.alias("body"))
    keyed = rows.withColumn("keys", digests(F.col("body"))).withColumn("tie", F.xxhash64("body"))
    led = with_next(keyed, "id", ["body", "keys"], "tie")
    n = F.length("body")
    half = (n / 2).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), n - half), F.substring("next_body", F.lit(1), half))
    made = led.select("id", n.cast("long").alias("n_chars"), "keys", "next_keys", edited.alias("edited"))
    made = made.select("id", "n_chars", "keys", "next_keys", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("edited")).alias("edited_keys"))
    keys, new, following = F.col("keys"), F.col("edited_keys"), F.col("next_keys")
    return made.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        as_text(sketch(keys, F.lit(cells))).alias("fingerprint"),
        as_text(sketch(new, F.lit(cells))).alias("edited_fingerprint"),
        likeness(keys, new, cells).alias("near_edited"),
        likeness(keys, following, cells).alias("near_next"),
    )
