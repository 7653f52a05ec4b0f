"""URL filtering against dated lists, as they stood when each page was fetched.

Dated entries add or remove a pattern; ordered by date they become intervals in which the pattern
is active.  A capture looks up its host and the domains above it, in the month it was fetched,
and keeps the intervals that hold its fetch time: an as-of join by equal keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.llm.frames import checkpointed
from tierwise.llm.skew import heavy_keys, spread_join

HOST, DOMAIN = "host", "domain"
#: Intervals are dealt into periods of so many days, so a pattern with a long history meets a
#: capture only with what was active around its fetch time.
PERIOD_DAYS = 30
#: Rows (entry and period) that are broadcast; beyond, captures and entries are shuffled.
BROADCAST_ROWS = 100_000
_DAY = 86_400
_FOUND_HOST, _FOUND_AT = "__tierwise_host", "__tierwise_at"


def host_of(url: Column) -> Column:
    """The host of a URL with a scheme, in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``pattern, kind, category, valid_from, valid_to`` from ``entries`` with ``action, dated``.

    An ``add`` is active from its date up to the next entry of the same pattern, kind and
    category, or for ever (null).  Of entries with one date the ``remove`` comes last.  Entries
    with a null pattern, kind or date, or an unknown action or kind, have no effect; a null
    category is one of its own.  Repeated entries count once.
    """
    known = (
        entries.select(F.lower("pattern").alias("pattern"), "kind", "category", "action", "dated")
        .where("pattern is not null and dated is not null and action in ('add', 'remove')")
        .where(F.col("kind").isin(HOST, DOMAIN))
        .distinct()
    )
    order = Window.partitionBy("pattern", "kind", "category").orderBy("dated", "action")
    return (
        known.withColumn("valid_to", F.lead("dated").over(order))
        .where("action = 'add' and (valid_to is null or valid_to > dated)")
        .select("pattern", "kind", "category", F.col("dated").alias("valid_from"), "valid_to")
    )


def _period(moment: Column) -> Column:
    return F.floor(F.unix_timestamp(moment) / (PERIOD_DAYS * _DAY)).cast("long")


def active_entries(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``_host, _at, pattern, kind, category`` for each host and fetch time, and entry active then."""
    moments = captures.select(host_of(F.col(url)).alias("_host"), F.col(at).alias("_at")).where(
        "_host is not null and _at is not null"
    ).distinct()
    intervals = validity_intervals(entries)
    latest = F.broadcast(moments.agg(F.max("_at").alias("_latest")))  # one row
    spread = intervals.join(latest, F.col("valid_from") <= F.col("_latest")).withColumn(
        "_period", F.explode(F.sequence(_period(F.col("valid_from")), _period(F.least("_latest", F.coalesce("valid_to", "_latest")))))
    )
    labels = F.split("_host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit(DOMAIN).alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")),
    )
    own = F.array(F.struct(F.lit(HOST).alias("kind"), F.col("_host").alias("pattern")))
    keyed = moments.select("_host", "_at", _period(F.col("_at")).alias("_period"), F.inline(F.concat(own, above)))
    periods = checkpointed(spread.drop("_latest"))
    # What is sent is counted: one row for each entry and period that it was active in.
    if periods.count() <= BROADCAST_ROWS:
        met = keyed.join(F.broadcast(periods), ["kind", "pattern", "_period"])
    else:
        # A domain such as "com" is above a large share of all captures.
        key = F.concat_ws(" ", "kind", F.col("_period").cast("string"), "pattern").alias("_key")
        keyed, periods = keyed.select("_host", "_at", key), periods.select("*", key)
        heavy = heavy_keys(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")), "_key", "_n")
        met = spread_join(keyed, periods, "_key", heavy, ["_host", "_at"])
    return met.where("valid_from <= _at and (valid_to is null or _at < valid_to)").select(
        "_host", "_at", "pattern", "kind", "category"
    )


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` with ``host``, ``n_active``, ``categories`` and ``blocked``, one row each.

    A capture is blocked if an entry is active at its fetch time for its host (``host``) or for
    its host or a domain above it (``domain``).  ``categories`` lists the active ones once, in
    order, joined by commas.  Without a host or a fetch time nothing matches.  Columns of the
    input with one of the four names are replaced.
    """
    found = active_entries(captures, entries, url, at).groupBy("_host", "_at").agg(
        F.count(F.lit(1)).alias("n_active"), F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories")
    )
    # Columns of the input keep their names beside these.
    found = found.withColumnsRenamed({"_host": _FOUND_HOST, "_at": _FOUND_AT})
    rows = captures.drop("host", "n_active", "categories", "blocked").withColumn("host", host_of(F.col(url)))
    known = F.col("host").isNotNull() & F.col(at).isNotNull()
    looked = rows.where(known)
    looked = looked.join(found, (looked["host"] == found[_FOUND_HOST]) & (looked[at] == found[_FOUND_AT]), "left")
    # Rows that cannot match are not sent to one task by their null.
    rest = rows.where(~known).withColumns({"n_active": F.lit(None).cast("long"), "categories": F.lit(None).cast("string")})
    joined = looked.drop(_FOUND_HOST, _FOUND_AT).unionByName(rest)
    return joined.withColumns(
        {
            "n_active": F.coalesce("n_active", F.lit(0)).cast("long"),
            "categories": F.coalesce("categories", F.lit("")),
            "blocked": F.coalesce(F.col("n_active") > 0, F.lit(False)),
        }
    )
