"""Conversation prefix trie by van Emde Boas recursion.

Sequences are cut at half depth. The prefix before the cut gets a name, a 128-bit hash of the name of its forest and
its own content; it belongs to the upper trie, and what follows belongs to the forest of that name. Both halves are cut
again in the same way until single turns are left, all pieces of a depth at once, and equal pieces of a forest are one
node. So a prefix has one name however long the conversations around it are. Afterwards totals are grafted upward: for
heights 1, 2, 4 and so on, the total of each lower forest is added along the path of the upper piece that it hangs on.

A conversation lies in rows of at most ``STRETCH`` turns. Cuts inside a row are column expressions, cuts above are joins
of (conversation, block) keys, so the rounds grow with the logarithm of the longest conversation and no row, group or
task holds a whole one. Work and storage are in proportion to the turns times that logarithm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, cut, flat_map

#: Turns in one row, a power of two.
STRETCH = 16
#: Name of the empty prefix.
ROOT = 0
#: Bytes of listed ids that one row of a digest's input holds.
CHUNK = 1 << 16


def _pair(f1: Column, f2: Column, *content: Column) -> tuple[Column, Column]:
    return F.xxhash64(f1, f2, *content), F.xxhash64(F.lit(1), f1, f2, *content)


# --- turns in order


def positions(turns: DataFrame, conv: str, order: str, role: str, text: str) -> DataFrame:
    """conv, pos, a, b, size: the place of every turn in its conversation, a hash of role and text, the text's bytes.

    Turns are ordered by ``order``, null first; equal ones by the hash, so every run gives the same order, and repeated
    rows all count. A null role or text is empty; rows without a conversation are left out. Rows are
    sorted by range, numbered inside their range, and then moved by the counts of the ranges before, so a conversation
    with a third of all rows lies in many tasks.
    """
    who, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    a, b = F.xxhash64(who, said), F.xxhash64(F.lit(1), who, said)
    rows = turns.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{order}`").cast("long").alias("at"), a.alias("a"), b.alias("b"), F.octet_length(said).cast("long").alias("size"))
    placed = rows.where(F.col("conv").isNotNull()).withColumn("tie", F.monotonically_increasing_id())
    ranged = cut(placed.repartitionByRange("conv", "at", "a", "b", "tie").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("conv", "part").orderBy("at", "a", "b")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    moved = counts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("moved"))
    numbered = ranged.withColumn("local", F.row_number().over(inside) - 1).join(moved, ["conv", "part"])
    return numbered.select("conv", (F.col("local") + F.col("moved")).alias("pos"), "a", "b", "size")


# --- names


def _stretches(turns: DataFrame) -> DataFrame:
    """conv, j, syms: at most ``STRETCH`` turns a row."""
    turn = F.struct("pos", "a", "b", "size")
    grouped = turns.groupBy("conv", F.expr(f"pos div {STRETCH}").alias("j")).agg(F.sort_array(F.collect_list(turn)).alias("syms"))
    return cut(grouped.select("conv", "j", F.transform("syms", lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"))).alias("syms"), F.transform("syms", lambda s: s["size"]).alias("sizes")))


def _with_forests(stretches: DataFrame) -> DataFrame:
    """``stretches`` with f1, f2, the name of the prefix before them, and e1, e2, that of the prefix up to their end if
    they are full."""
    full = F.size("syms") == STRETCH
    root, none = F.lit(ROOT).cast("long"), F.lit(None).cast("long")
    last = stretches.agg(F.max("j")).first()[0] or 0
    if last == 0:
        e1, e2 = _pair(root, root, *_pair(root, root, F.col("syms")))
        return stretches.withColumns({"f1": root, "f2": root, "e1": F.when(full, e1), "e2": F.when(full, e2)})
    c1, c2 = _pair(root, root, F.col("syms"))
    blocks = [cut(stretches.where(full).select("conv", F.col("j").alias("left"), c1.alias("c1"), c2.alias("c2")))]
    height = int(last + 1).bit_length()
    for _ in range(height - 1):  # content of blocks twice as long
        side = lambda c, s: F.max(F.when(F.col("left") % 2 == s, F.col(c)))
        halves = blocks[-1].groupBy("conv", F.expr("left div 2").alias("left")).agg(F.count("*").alias("n"), *[side(c, s).alias(f"{c}{s}") for c in ("c1", "c2") for s in (0, 1)])
        c1, c2 = _pair(F.col("c10"), F.col("c20"), F.col("c11"), F.col("c21"))
        blocks.append(cut(halves.where("n = 2").select("conv", "left", c1.alias("c1"), c2.alias("c2"))))
    named = stretches.where("j = 0").select("conv", F.lit(0).cast("long").alias("i"), root.alias("f1"), root.alias("f2"), none.alias("e1"), none.alias("e2"))
    for level in reversed(blocks):  # each block is cut at half depth
        cut1, cut2 = _pair(F.col("f1"), F.col("f2"), F.col("c1"), F.col("c2"))
        found = named.withColumn("left", F.col("i") * 2).join(level, ["conv", "left"], "left")
        halved = found.withColumns({"k1": F.when(F.col("c1").isNotNull(), cut1), "k2": F.when(F.col("c1").isNotNull(), cut2)})
        part = lambda i, *cols: F.struct(i.alias("i"), *[F.col(c).alias(n) for c, n in zip(cols, ("f1", "f2", "e1", "e2"), strict=True)])
        upper = part(F.col("left"), "f1", "f2", "k1", "k2")
        lower = F.when(F.col("k1").isNotNull(), part(F.col("left") + 1, "k1", "k2", "e1", "e2"))
        named = cut(halved.select("conv", F.explode(F.filter(F.array(upper, lower), lambda x: x.isNotNull())).alias("p")).select("conv", "p.*"))
    return stretches.join(named.withColumnRenamed("i", "j"), ["conv", "j"])


def _paths(stretches: DataFrame) -> DataFrame:
    """conv, j, path: parent's name, own name and text size of the node of every turn."""
    rows = _with_forests(stretches).withColumnsRenamed({"f1": "x0", "f2": "y0", "e1": f"x{STRETCH}", "e2": f"y{STRETCH}"})
    half = STRETCH // 2
    while half:  # cut every piece at half depth; past a row's end the names are not used
        cuts = {}
        for at in range(0, STRETCH, 2 * half):
            cuts[f"x{at + half}"], cuts[f"y{at + half}"] = _pair(F.col(f"x{at}"), F.col(f"y{at}"), F.slice("syms", at + 1, half))
        rows, half = rows.withColumns(cuts), half // 2
    node = lambda d: F.struct(*[F.col(f"{c}{d - k}").alias(n) for n, c, k in (("p1", "x", 1), ("p2", "y", 1), ("n1", "x", 0), ("n2", "y", 0))], F.get("sizes", F.lit(d - 1)).alias("size"))
    path = F.slice(F.array(*[node(d) for d in range(1, STRETCH + 1)]), F.lit(1), F.size("syms"))
    return cut(rows.select("conv", "j", path.alias("path")))


# --- nodes and totals


def prefix_trie(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes, and for every conversation the node it ends at.

    ``turns``: conv, pos (from 0, without gaps), a, b, size, as ``positions`` makes them. ``members``: conv, every
    conversation once, also those without turns. Nodes: n1, n2 (name), p1, p2 (parent's name, null for the root),
    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (sum over the subtree of
    (n_convs - 1) times the size of the last turn). Ends: conv, n1, n2. Without members there are no nodes; if no
    conversation has a turn, the root is the only node, and a leaf. Other columns are not read.
    """
    paths = _paths(_stretches(turns))
    steps = paths.select("conv", "j", F.posexplode("path").alias("at", "s")).select("conv", (F.col("j") * STRETCH + F.col("at") + 1).alias("depth"), "s.*")
    own = steps.groupBy("n1", "n2", "p1", "p2", "depth", "size").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    top = members.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(F.lit(ROOT).cast("long").alias("n1"), F.lit(ROOT).cast("long").alias("n2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), zero.alias("size"), "conv_id", "n_convs")
    nodes = cut(own.unionByName(top))
    kids = nodes.where("depth > 0").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("n_children"))
    known = nodes.join(kids, ["n1", "n2"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    start = known.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("size")}).drop("size")
    total = grafted(cut(start), paths)
    parents = total.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return total.join(parents, ["p1", "p2"], "left"), _ends(paths, members)


_SUMS = ("n_leaves", "saved_tokens")
_KEPT = ("p1", "p2", "depth", "conv_id", "n_convs", "n_children")


def grafted(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """``nodes`` with n_leaves and saved_tokens summed over subtrees."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    add_up = [F.sum(c).alias(c) for c in _SUMS]
    height = 1
    while height < deepest:  # forests of this height hang on upper pieces of the same height
        hung = nodes.where((F.col("depth") - 1) % (2 * height) == height)
        forests = hung.groupBy("p1", "p2", (F.col("depth") - 1).alias("end")).agg(*add_up, F.min("conv_id").alias("conv"))
        first = F.expr(f"(end - {height}) div {STRETCH}")
        rows = forests.withColumn("j", F.explode(F.sequence(first, F.expr(f"(end - 1) div {STRETCH}")))).join(paths, ["conv", "j"])
        low = F.greatest(F.col("end") - height - F.col("j") * STRETCH, F.lit(0)).cast("int") + 1
        along = rows.select(F.explode(F.slice("path", low, F.lit(min(height, STRETCH)))).alias("s"), *_SUMS).select("s.n1", "s.n2", *_SUMS)
        both = nodes.unionByName(along, allowMissingColumns=True)
        nodes = cut(both.groupBy("n1", "n2").agg(*[F.max(c).alias(c) for c in _KEPT], *add_up))
        height *= 2
    rest = nodes.where("depth = 1").select(F.lit(ROOT).cast("long").alias("n1"), F.lit(ROOT).cast("long").alias("n2"), *_SUMS)
    both = nodes.unionByName(rest, allowMissingColumns=True)
    return cut(both.groupBy("n1", "n2").agg(*[F.max(c).alias(c) for c in _KEPT], *add_up))


def _ends(paths: DataFrame, members: DataFrame) -> DataFrame:
    last = paths.groupBy("conv").agg(F.max("j").alias("j"))
    node = F.element_at("path", -1)
    ended = paths.join(last, ["conv", "j"]).select("conv", node["n1"].alias("n1"), node["n2"].alias("n2"))
    root = F.lit(ROOT).cast("long")
    return members.join(ended, "conv", "left").select("conv", *[F.coalesce(c, root).alias(c) for c in ("n1", "n2")])


def listed_digests(ends: DataFrame) -> DataFrame:
    """n1, n2, sha256: of the ascending conversations that end at each node, in decimal, joined by commas.

    Ids are sorted by node and id over many tasks and joined to chunks there; a node's chunks then pass one after the
    other through one digest, which holds nothing but its state.
    """

    def chunks(batches: Iterator[Lists]) -> Iterator[Lists]:
        at, ids, size = None, [], 0

        def made() -> Lists:
            return {"n1": [at[0]], "n2": [at[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]}

        for batch in batches:
            for n1, n2, conv in zip(batch["n1"], batch["n2"], batch["conv"], strict=True):
                if ids and ((n1, n2) != at or size >= CHUNK):
                    yield made()
                    ids, size = [], 0
                at = (n1, n2)
                ids.append(conv)
                size += len(str(conv)) + 1
        if ids:
            yield made()

    def digests(batches: Iterator[Lists]) -> Iterator[Lists]:
        at, state = None, None
        for batch in batches:
            out: Lists = {"n1": [], "n2": [], "sha256": []}
            for n1, n2, ids in zip(batch["n1"], batch["n2"], batch["ids"], strict=True):
                if (n1, n2) == at:
                    state.update(b",")
                else:
                    if state:
                        for c, v in zip(out, (*at, state.hexdigest()), strict=True):
                            out[c].append(v)
                    at, state = (n1, n2), hashlib.sha256()
                state.update(ids)
            yield out
        if state:
            yield {"n1": [at[0]], "n2": [at[1]], "sha256": [state.hexdigest()]}

    ranged = ends.repartitionByRange("n1", "n2", "conv").sortWithinPartitions("n1", "n2", "conv")
    parts = flat_map(ranged.select("n1", "n2", "conv"), chunks, "n1 long, n2 long, first long, ids string")
    return flat_map(parts.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "first"), digests, "n1 long, n2 long, sha256 string")
