"""URL filters: lists whose entries come and go, and captures judged by the entries active when they were fetched.

Dated additions and removals become validity intervals. A capture asks for its host, every domain above it and every
path prefix, each at its fetch time. Intervals are cut at the borders of time buckets, so that captures and intervals
meet in a join by key and bucket; one that is asked for all the time is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What an entry matches, in the order in which a verdict names it.
KINDS = ("host", "domain", "prefix")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
PATH = r"^[^:]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def keys(url: Column) -> Column:
    """kind and pattern of every entry that would match a URL; none for a URL without a host."""
    labels, parts = F.split(host(url), r"\."), F.split(F.regexp_extract(url, PATH, 1), "/")
    n, m = F.size(labels), F.size(parts)
    key = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: key("domain", F.array_join(F.slice(labels, i, n), ".")))
    steps = F.filter(F.sequence(F.lit(1), m), lambda i: (i > 1) & (F.element_at(parts, i) != ""))
    prefixes = F.transform(steps, lambda i: key("prefix", F.concat(host(url), F.array_join(F.slice(parts, 1, i), "/"))))
    return F.when(host(url) != "", F.concat(F.array(key("host", host(url))), domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """kind, pattern, since, until (exclusive; null: still active) from dated entries (kind, pattern, changed, action).

    ``action`` is add or remove. Repeated additions and removals change nothing; at one time a removal comes last.
    Entries with a null in any of the four columns, or another action or kind, are no entries.
    """
    known = entries.where(F.col("action").isin("add", "remove") & F.col("kind").isin(*KINDS)).select("kind", "pattern", "changed", "action").dropna()
    # at one time the last action counts: "remove" sorts after "add"
    at_once = known.groupBy("kind", "pattern", "changed").agg(F.max("action").alias("action"))
    own = Window.partitionBy("kind", "pattern").orderBy("changed")
    changes = at_once.withColumn("__was", F.coalesce(F.lag("action").over(own), F.lit("remove"))).where("action <> __was")
    spans = changes.select("kind", "pattern", "action", F.col("changed").alias("since"), F.lead("changed").over(own).alias("until"))
    return spans.where("action = 'add'").drop("action")


def filter_urls(captures: DataFrame, entries: DataFrame, bucket: int, url: str = "url", at: str = "at") -> DataFrame:
    """``captures`` with blocked, kind, pattern and since of the entry active at the fetch time, the first by ``KINDS``
    and then by pattern.

    ``at`` and ``changed`` are whole numbers (of days or seconds), and ``bucket`` so many of them: about as long as an
    entry stays. A null URL or time, or a URL without a host, is not blocked. The verdict depends on URL and time alone,
    so repeated captures share it; columns of these names in the captures are replaced. With no entries nothing is
    blocked; no captures give no rows.
    """
    rows = captures.drop("blocked", "kind", "pattern", "since")
    asked = rows.select(F.col(f"`{url}`").alias("__url"), F.col(f"`{at}`").cast("long").alias("__at")).dropna().distinct()
    probes = asked.withColumn("key", F.explode(keys(F.col("__url")))).withColumn("bucket", F.expr(f"__at div {bucket}"))
    fetched = F.col(f"`{at}`").cast("long")
    earliest, latest = (F.lit(x or 0) for x in captures.agg(F.min(fetched), F.max(fetched)).first())
    # only the time of the captures is cut at buckets, however long an entry was active before and after
    begin, end = F.greatest("since", earliest), F.least(F.coalesce(F.col("until") - 1, latest), latest)
    spans = intervals(entries).withColumns({"__begin": begin, "__end": end}).where("__begin <= __end")
    cut = spans.withColumn("bucket", F.explode(F.sequence(F.expr(f"__begin div {bucket}"), F.expr(f"__end div {bucket}"))))
    same = (
        (probes["key.kind"] == cut["kind"]) & (probes["key.pattern"] == cut["pattern"]) & (probes["bucket"] == cut["bucket"])
        & (cut["since"] <= probes["__at"]) & (probes["__at"] <= cut["__end"])
    )
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    hits = probes.join(cut, same).select("__url", "__at", F.struct(rank.alias("rank"), "pattern", "kind", "since").alias("__hit"))
    first = hits.groupBy("__url", "__at").agg(F.min("__hit").alias("__hit"))
    joined = rows.join(first, (rows[url] == first["__url"]) & (rows[at].cast("long") == first["__at"]), "left")
    made = [F.col("__hit").isNotNull().alias("blocked"), *[F.col(f"__hit.{c}").alias(c) for c in ("kind", "pattern", "since")]]
    return joined.select(*[rows[c] for c in rows.columns], *made)
