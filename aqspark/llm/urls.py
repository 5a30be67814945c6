"""URL filter lists with dates: every capture is judged by the entries that were active when it was fetched.

A dated entry adds a pattern to a list or removes it. Entries become validity intervals, half open, that end at the next entry for the same pattern and list; an add that
is never followed is open. Captures are joined as of their fetch time: by a key of their URL and the time bucket, then by the interval.

Kinds of patterns: ``host`` (the host itself), ``domain`` (the host or any host below it) and ``prefix`` (host and whole path segments). Hosts are compared in lower case, the rest of a prefix as it is; a slash at its end counts for nothing. At one instant a
removal beats an addition, and repeated entries count once. A URL that is null, empty or without a host, or a null fetch time, matches nothing, and
the capture is not blocked; entries with a null pattern or date match nothing. Repeated captures get a row each. Empty entries block nothing; an empty table of captures gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from aqspark.llm.common import small_side, stage

#: Width of a time bucket. A long interval has a row per bucket, so a crowded pattern is split by time.
BUCKET_DAYS = 32
_SITE = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _SITE + r"([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SITE + r"[^/?#]*([^?#]*)", 1)


def _bucket(time: Column, days: int) -> Column:
    return F.floor(F.unix_date(time.cast("date")) / days).cast("int")


def intervals(entries: DataFrame, days: int = BUCKET_DAYS) -> DataFrame:
    """``list``, ``kind``, ``pattern``, ``valid_from`` and ``valid_to`` (null: open) from ``list``, ``kind``, ``pattern``, ``action`` and ``dated``."""
    key = ["list", "kind", "pattern"]
    name, rest = (F.regexp_extract("pattern", "(?s)^([^/]*)(.*?)/?$", k) for k in (1, 2))
    known = entries.where("pattern IS NOT NULL AND dated IS NOT NULL").withColumn("pattern", F.when(F.col("kind") == "prefix", F.concat(F.lower(name), rest)).otherwise(F.lower("pattern")))
    one = known.groupBy(*key, "dated").agg(F.min((F.col("action") == "add").cast("int")).alias("added")).withColumn("bucket", _bucket(F.col("dated"), days))
    # the next entry lies in the same bucket or is the first of a later one, so a window holds one bucket of a pattern
    firsts = one.groupBy(*key, "bucket").agg(F.min("dated").alias("first"))
    later = firsts.select(*key, "bucket", F.lead("first").over(W.partitionBy(*key).orderBy("bucket")).alias("later"))
    inside = one.withColumn("next", F.lead("dated").over(W.partitionBy(*key, "bucket").orderBy("dated")))
    same = [inside[c].eqNullSafe(later[c]) for c in [*key, "bucket"]]
    joined = inside.join(later, same).where("added = 1")
    return joined.select(*[inside[c] for c in key], F.col("dated").alias("valid_from"), F.coalesce("next", "later").alias("valid_to"))


def keys(url: Column) -> Column:
    """All (kind, pattern) that can match a URL."""
    name, labels, steps = host(url), F.split(host(url), r"\."), F.split(path(url), "/")
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: pair("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: pair("prefix", F.concat(name, F.array_join(F.slice(steps, F.lit(1), i), "/"))))
    return F.when(name != "", F.array_distinct(F.concat(F.array(pair("host", name)), domains, prefixes)))


def judge(captures: DataFrame, entries: DataFrame, capture_id: str, url: str = "url", fetched: str = "fetched_at", days: int = BUCKET_DAYS) -> DataFrame:
    """``id``, ``host``, ``fetched_at``, ``matches`` (structs of list, kind, pattern, valid_from; sorted) and ``blocked`` per capture."""
    rows = captures.select(F.col(capture_id).alias("id"), F.col(url).alias("url"), F.col(fetched).alias("fetched_at"))
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "captures")
    last = rows.agg(F.max(_bucket(F.col("fetched_at"), days))).first()[0]
    valid = intervals(entries, days)
    end = F.least(F.coalesce(_bucket(F.col("valid_to"), days), F.lit(last)), F.lit(last)).cast("int")
    start = _bucket(F.col("valid_from"), days)
    active = stage(valid.where(start <= end).withColumn("bucket", F.explode(F.sequence(start, end))), "active")
    asked = rows.where("fetched_at IS NOT NULL").select("at", "fetched_at", _bucket(F.col("fetched_at"), days).alias("bucket"), F.explode(keys(F.col("url"))).alias("key")).select("at", "fetched_at", "bucket", "key.*")
    held = asked.join(small_side(active), ["kind", "pattern", "bucket"]).where("valid_from <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to)")
    matches = held.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("list", "kind", "pattern", "valid_from"))).alias("matches"))
    return rows.join(matches, "at", "left").select("id", host(F.col("url")).alias("host"), "fetched_at", "matches", F.col("matches").isNotNull().alias("blocked"))
