"""URL filters by dated lists: an as-of join of captures with validity intervals.

List entries are added and removed at known times.  They become intervals in which a
pattern is on a list; a capture is judged by the entries active when it was fetched.  A
pattern is a host, which also covers its subdomains, or a host with a path, which covers
what lies below it.  A capture looks up the few keys its URL can match, so the join is an
equality of keys and time slices.  Slices also split the captures of a frequent host.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.sources.tables import materialize

#: Length of a time slice; intervals and captures meet within one.
SLICE_SECONDS = 30 * 86_400


def url_host(url: Column) -> Column:
    """Host in lower case, without user and port; empty when the URL has no scheme."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_path(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def _slice(at: Column) -> Column:
    return F.floor(F.unix_seconds(at) / SLICE_SECONDS).cast("int")


def list_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from entries (list, pattern, action, at).

    ``action`` is add or remove; rows with a null or another action are ignored.  Of
    actions at one time a removal counts.  ``valid_to`` is null while nothing follows.
    Repeated entries change nothing.  A pattern with very many entries is cut into time
    slices, so no task holds its history.
    """
    known = entries.filter(F.col("action").isin("add", "remove")).dropna(
        subset=["list", "pattern", "at"]
    )
    changes = known.groupBy("list", "pattern", "at").agg(F.max("action").alias("action"))
    changes = changes.withColumn("slice", _slice(F.col("at")))
    later = (
        changes.groupBy("list", "pattern", "slice")
        .agg(F.min("at").alias("first_at"))
        .withColumn(
            "after", F.lead("first_at").over(Window.partitionBy("list", "pattern").orderBy("slice"))
        )
        .drop("first_at")
    )
    inside = Window.partitionBy("list", "pattern", "slice").orderBy("at")
    return (
        changes.withColumn("next_at", F.lead("at").over(inside))
        .join(later, ["list", "pattern", "slice"])
        .filter("action = 'add'")
        .select(
            "list",
            "pattern",
            F.col("at").alias("valid_from"),
            F.coalesce("next_at", "after").alias("valid_to"),
        )
    )


def _keys(url: Column, labels: int, depth: int) -> Column:
    """Keys a URL can match: host suffixes of up to ``labels`` parts, paths of up to ``depth``."""
    host, path = url_host(url), url_path(url)
    parts = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels)))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    below = F.transform(
        F.filter(
            F.sequence(F.lit(0), F.least(F.size(segments), F.lit(depth))), lambda n: n > 0
        ),
        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, n), "/")),
    )
    return F.array_distinct(F.concat(suffixes, below))


def judge_captures(
    captures: DataFrame, entries: DataFrame, allow_lists: Collection[str] = ("allow",)
) -> DataFrame:
    """Every row of ``captures`` (url, fetched_at, ...) with ``lists`` and ``blocked``.

    ``lists`` are the names of the lists with an active entry that covers the URL, in
    order.  A capture is blocked by any list but those in ``allow_lists``, which overrule
    the others.  A null URL or time, and a URL without a host, match nothing.  Rows that
    repeat are judged alike.  Other columns are kept.
    """
    intervals = materialize(list_intervals(entries), "url-intervals")
    pattern = F.col("pattern")
    # no key longer than the longest pattern can match, however long the URL
    longest = intervals.agg(
        F.max(F.size(F.split(F.substring_index(pattern, "/", 1), r"\."))),
        F.max(F.size(F.split(pattern, "/")) - 1),
    ).first()
    labels, depth = (x or 0 for x in longest)
    asked = (
        captures.select(F.col("url").alias("_url"), F.col("fetched_at").alias("_at"))
        .dropna()
        .distinct()
    )
    asked = materialize(asked.withColumn("_slice", _slice(F.col("_at"))), "url-captures")
    end = asked.agg(F.max("_slice")).first()[0]
    names = "array<string>"
    if end is None:
        return captures.withColumns({"lists": F.array().cast(names), "blocked": F.lit(False)})
    first = _slice(F.col("valid_from"))
    last = F.least(F.coalesce(_slice(F.col("valid_to")), F.lit(end)), F.lit(end))
    sliced = intervals.filter(first <= end).withColumn(
        "_slice", F.explode(F.sequence(first, F.greatest(last, first)))
    )
    looked = asked.withColumn("pattern", F.explode(_keys(F.col("_url"), labels, depth)))
    active = (F.col("_at") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to"))
    )
    found = (
        looked.join(sliced, ["pattern", "_slice"])
        .filter(active)
        .groupBy("_url", "_at")
        .agg(F.sort_array(F.collect_set("list")).alias("_lists"))
    )
    met = captures.join(
        found,
        (captures["url"] == found["_url"]) & (captures["fetched_at"] == found["_at"]),
        "left",
    ).drop("_url", "_at")
    lists = F.coalesce("_lists", F.array().cast(names))
    allowed = F.array(*[F.lit(x) for x in allow_lists]).cast(names)
    return met.withColumn("lists", lists).drop("_lists").withColumn(
        "blocked", (F.size("lists") > 0) & ~F.arrays_overlap("lists", allowed)
    )
