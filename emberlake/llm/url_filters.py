"""URL filters whose lists change with time: every capture is judged by the entries in force when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 30
OPEN_END = "9999-12-31 00:00:00"


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port or trailing dot; null if the url has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.rtrim(F.trim(host), F.lit(".")), F.lit(""))


def url_keys(url: Column) -> Column:
    """What an entry may name to match a url: the host, its parent domains of two labels or more, and the url without
    query and fragment. Null urls have no keys; a url without a host has only itself."""
    labels = F.split(host_of(url), "\\.")
    last = F.greatest(F.size(labels) - 1, F.lit(1))
    domains = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    own = F.array(F.regexp_extract(url, r"^[^?#]*", 0))
    return F.when(url.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(own, F.coalesce(domains, F.array().cast("array<string>")))))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, key, verdict, valid_from, valid_to): an entry holds until the same list's next one for its key.

    ``entries`` has list_name, key, verdict and listed_at. Of entries dated alike the last by verdict counts; those
    without key or date never hold. The newest one holds on.
    """
    dated = (entries.where("key IS NOT NULL AND listed_at IS NOT NULL").groupBy("list_name", "key", "listed_at")
             .agg(F.max("verdict").alias("verdict")))
    following = F.lead("listed_at").over(Window.partitionBy("list_name", "key").orderBy("listed_at"))
    return dated.select("list_name", "key", "verdict", F.col("listed_at").alias("valid_from"),
                        F.coalesce(following, F.lit(OPEN_END).cast("timestamp")).alias("valid_to"))


def filter_urls(captures: DataFrame, entries: DataFrame, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Every row of ``captures`` (page_id, url, fetched_at) with blocked, list_name, matched_key, listed_at, n_active.

    An as-of join: intervals and captures meet on key and on a period of ``bucket_days``, so a key with a long history
    isn't compared entry by entry, and a key with many captures is an ordinary skewed join that adaptive execution can
    split. Of the entries in force the most specific decides: the longest key, then the newest, then list name and
    verdict. A capture without url or time, or that no entry matches, isn't blocked and has nulls. Rows come back as
    often as they came; further columns of ``captures`` are left out.
    """
    rows = captures.select("page_id", "url", "fetched_at")
    ends = rows.agg(F.min("fetched_at"), F.max("fetched_at")).first()
    period = lambda time: F.floor(F.unix_timestamp(time) / (bucket_days * 86400))
    # Periods before the first and after the last capture can't match anything.
    first, last = (F.lit(t).cast("timestamp") for t in (ends[0], ends[1]))
    spans = (validity_intervals(entries).where((F.col("valid_from") <= last) & (F.col("valid_to") > first))
             .withColumn("period", F.explode(F.sequence(period(F.greatest("valid_from", first)), period(F.least("valid_to", last))))))
    keyed = rows.where("fetched_at IS NOT NULL").distinct().select(
        "page_id", "url", "fetched_at", period(F.col("fetched_at")).alias("period"), F.explode(url_keys(F.col("url"))).alias("key"))
    in_force = keyed.join(spans, ["key", "period"]).where("valid_from <= fetched_at AND fetched_at < valid_to")
    rank = F.struct(F.length("key").alias("n"), F.col("valid_from").alias("listed_at"), F.col("list_name"), F.col("verdict"), F.col("key"))
    decided = (in_force.groupBy("page_id", "url", "fetched_at").agg(F.max(rank).alias("best"), F.count("*").alias("n_active"))
               .select(F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("fetched_at").alias("f"), "best", "n_active"))
    joined = rows.join(decided, rows["page_id"].eqNullSafe(F.col("p")) & rows["url"].eqNullSafe(F.col("u")) & (rows["fetched_at"] == F.col("f")), "left")
    return joined.select(
        "page_id", "url", "fetched_at", F.coalesce(F.col("best.verdict") == "block", F.lit(False)).alias("blocked"),
        F.col("best.list_name").alias("list_name"), F.col("best.key").alias("matched_key"),
        F.col("best.listed_at").alias("listed_at"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """``pages`` has no fetch times, so each gets one in 2023 or 2024 that its id determines."""
    seconds = F.conv(F.substring(F.md5(F.concat(F.lit("fetch:"), F.col("page_id").cast("string"))), 1, 7), 16, 10).cast("long") % (731 * 86400)
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1672531200) + seconds).alias("fetched_at"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Two lists about the hosts in ``pages``, as far as no list is given: entries and their dates follow from the names.

    About a third of the hosts is blocked, a third of these released later and some blocked again; every eighth domain
    above a host is blocked by a second list, and one in eight plain urls is allowed again.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    domains = hosts.where(F.size(F.split("host", "\\.")) > 2).select(F.expr("substring(host, instr(host, '.') + 1)").alias("host")).distinct()
    plain = pages.where("url IS NOT NULL").select(F.regexp_extract("url", r"^[^?#]*", 0).alias("key")).distinct()

    def draw(salt: str, key: str) -> Column:
        return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(key))), 1, 7), 16, 10).cast("long")

    def entries(df: DataFrame, key: str, name: str, salt: str, verdict: str, keep: Column) -> DataFrame:
        return df.where(keep).select(F.lit(name).alias("list_name"), F.col(key).alias("key"), F.lit(verdict).alias("verdict"),
                                     F.timestamp_seconds(F.lit(1672531200) + draw(salt, key) % (731 * 86400)).alias("listed_at"))

    blocked = draw("host:", "host") % 3 == 0
    return (entries(hosts, "host", "hosts", "on:", "block", blocked)
            .unionByName(entries(hosts, "host", "hosts", "off:", "allow", blocked & (draw("off:", "host") % 3 == 0)))
            .unionByName(entries(hosts, "host", "hosts", "again:", "block", blocked & (draw("again:", "host") % 9 == 0)))
            .unionByName(entries(domains, "host", "domains", "on:", "block", draw("domain:", "host") % 8 == 0))
            .unionByName(entries(plain, "key", "urls", "on:", "allow", draw("url:", "key") % 8 == 0)))
