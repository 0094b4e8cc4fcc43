"""URL filters by dated lists: a temporal join of captures with list entries.

List histories (an entry is added, removed, added again) become validity intervals; each
capture is joined with the entries for its host, its parent domains and its path
prefixes that were valid at the time of its fetch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Lists of at most so many intervals are sent to every executor; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def _canonical(entry: Column) -> Column:
    """An entry as URLs are looked up: the host in lower case and without end dots, the path as it is."""
    host = F.rtrim(F.lower(F.substring_index(entry, "/", 1)), F.lit("."))
    return F.when(F.contains(entry, F.lit("/")), F.concat(host, F.lit("/"), F.regexp_replace(entry, "^[^/]*/", ""))).otherwise(host)


def validity_intervals(events: DataFrame) -> DataFrame:
    """(entry, valid_from, valid_to) of each ``entry`` from its (entry, action, at) history.

    ``action`` is ``add`` or ``remove``. An addition holds from its time until the next
    removal, exclusive, or for ever (null). Hosts are
    compared in lower case, paths as they are. Additions to an entry that is valid, and removals of one
    that is not, change nothing; of events at one time the removal comes first.
    Events with a null field or another action are left out.
    """
    e = events.select(_canonical(F.col("entry").cast("string")).alias("entry"), "action", "at").dropna().filter(F.col("action").isin("add", "remove")).distinct()
    w = W.partitionBy("entry").orderBy("at", F.desc("action"))
    e = e.withColumn("before", F.lag("action").over(w)).filter(~F.col("before").eqNullSafe(F.col("action")))
    e = e.withColumn("valid_to", F.lead("at").over(w))
    e = e.filter((F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at"))))
    return e.select("entry", F.col("at").alias("valid_from"), "valid_to")


def _authority(url: Column) -> Column:
    """What stands between ``//`` and the path, without user names: all after the last ``@``."""
    whole = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)", 1)
    return F.substring_index(whole, "@", -1)


def url_host(url: Column) -> Column:
    """Lower-case host of a URL without user name, port and end dots; null where there is none.

    An address in brackets keeps them. Of several ``@`` the last one ends the user name, and a
    backslash ends the host as a slash does, which is how browsers read both.
    """
    at = _authority(url)
    inside = F.regexp_extract(at, r"^(\[[^\]]*\])", 1)
    host = F.lower(F.when(inside != "", inside).otherwise(F.rtrim(F.substring_index(at, ":", 1), F.lit("."))))
    return F.when(host != "", host)


def entry_keys(url: Column) -> Column:
    """List entries that would match a URL: host, its parent domains, host with each path prefix, whose case counts."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    domains = F.when(host.startswith("["), F.array(host)).otherwise(domains)
    path = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\]*[/\\]([^?#]*)", 1)
    steps = F.filter(F.split(path, r"[/\\]"), lambda s: s != "")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat_ws("/", host, F.array_join(F.slice(steps, 1, i), "/")))
    prefixes = F.when(F.size(steps) > 0, prefixes).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, prefixes))).otherwise(F.array().cast("array<string>"))


def match_captures(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(page_id, host, fetched_at, n_active, entry, blocked) of every capture.

    ``n_active`` counts the entries for the capture's URL that were valid at its time,
    ``entry`` is the longest of them (ties: the first in order), and ``blocked`` says
    whether there is any. A null or malformed URL or a null time matches nothing. Rows that
    repeat an id are one capture each. Other columns are ignored. Empty tables of captures
    give an empty result; an empty list blocks nothing.

    A host may hold any share of the captures: a list that is counted as small is joined
    where the captures lie, a larger one by an inner join that Spark may split.
    """
    c = captures.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).alias("fetched_at"))
    c = c.withColumn("host", url_host(F.col("url")))
    intervals = validity_intervals(events)
    small = intervals.limit(broadcast_rows + 1).count() <= broadcast_rows
    keyed = c.select("url", "fetched_at").distinct().withColumn("entry", F.explode(entry_keys(F.col("url"))))
    hit = (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    active = keyed.join(F.broadcast(intervals) if small else intervals, "entry").filter(hit)
    best = active.groupBy("url", "fetched_at").agg(F.countDistinct("entry").alias("n_active"), F.min(F.struct(-F.length("entry"), "entry")).alias("first"))
    best = best.select("url", "fetched_at", "n_active", F.col("first.entry").alias("entry"))
    out = c.join(best, ["url", "fetched_at"], "left")
    return out.select("page_id", "host", "fetched_at", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), "entry", F.col("entry").isNotNull().alias("blocked"))
