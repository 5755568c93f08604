"""Boilerplate lines by how many of a site's pages carry them, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RATIO = 0.3
#: Pages that carry a line at least, however small the host is: a line on two pages may be a copy.
LEAST_CARRIERS = 3
#: A host with more than this part of all pages is dealt into as many parts as it has such shares: at most so many hosts are large.
SHARES = 4096
#: Elements without visible text, block elements that break lines, and references that are decoded.
HIDDEN = r"(?is)<!--.*?-->|<head\b.*?</head\s*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
BREAKS = r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|hr|tr|table|section|article|header|footer|nav|aside|main|form|blockquote|pre|dd|dt|dl|figure|figcaption)\b[^>]*>"
#: HIDDEN with its first character in front, so that other characters are passed over at once.
HIDDEN_AT = f"(?is)<(?:{HIDDEN.removeprefix('(?is)<').replace('|<', '|')})"
#: Runs of blanks that are not one space already.
BLANKS = r"[ \t\r\f\x0B]{2,}|[\t\r\f\x0B]"
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&"))
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """Lower-case host of an address; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def visible_lines(html: Column) -> Column:
    """The non-empty lines of a page's visible text, white space made single spaces."""
    shown = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN_AT, ""), BREAKS, "\n"), "<[^>]*>", "")
    for name, sign in REFERENCES:
        shown = F.replace(shown, F.lit(name), F.lit(sign))
    lines = F.transform(F.split(F.regexp_replace(shown, BLANKS, " "), "\n"), lambda x: F.trim(x))  # once a page: no run of blanks crosses a line
    return F.filter(lines, lambda x: x != "")


def site_lines(pages: DataFrame, host: str = "host", lines: str = "lines", ratio: float = RATIO, least_carriers: int = LEAST_CARRIERS) -> DataFrame:
    """``(host, boilerplate)``: for each host the lines on more than ``ratio`` of its pages and on ``least_carriers`` pages at least.

    Lines are counted once a page and partly before the shuffle, so a line on every page of a large host is no hot key. A host
    has at most (mean distinct lines of its pages) / ratio such lines.
    """
    known = pages.where(F.col(host).isNotNull())
    totals = known.groupBy(host).agg(F.count(F.lit(1)).alias("pages"))
    seen = (
        known.select(host, F.explode(F.array_distinct(lines)).alias("line"))
        .groupBy(host, "line")
        .agg(F.count(F.lit(1)).alias("seen"))
        .where(F.col("seen") >= least_carriers)
    )
    often = seen.join(totals, host).where(F.col("seen") > ratio * F.col("pages"))
    return often.groupBy(host).agg(F.collect_set("line").alias("boilerplate"))


def large_hosts(hosts: DataFrame, shares: int = SHARES) -> DataFrame:
    """``(host, parts)`` of the hosts with more than one of ``shares`` shares of all rows, at most ``shares`` rows."""
    totals = hosts.where("host IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    share = F.greatest(F.lit(1.0), F.lit((hosts.count() or 1) / shares))
    return totals.where(F.col("pages") > share).select("host", F.ceil(F.col("pages") / share).cast("int").alias("parts"))


def drop_site_lines(pages: DataFrame, ratio: float = RATIO, least_carriers: int = LEAST_CARRIERS, shares: int = SHARES) -> DataFrame:
    """``(page_id, url, host, n_lines, n_dropped, text)``: every page without the boilerplate lines of its host.

    Every occurrence of such a line goes. Null html has no lines; a page without a host stays whole, as does one of a host with fewer
    than ``least_carriers`` pages; repeated rows count as pages of their own. Other columns are not looked at.
    """
    hosted = host_of(F.col("url")).alias("host")
    lined = pages.select("page_id", "url", hosted, visible_lines(F.col("html")).alias("lines"))
    large = F.broadcast(large_hosts(pages.select(hosted), shares))  # at most ``shares`` rows
    parts = F.coalesce("parts", F.lit(1))
    dealt = lined.join(large, "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), parts).cast("int")).drop("parts")
    # only a large host's list is copied, once for each of its parts
    site = site_lines(lined, ratio=ratio, least_carriers=least_carriers).join(large, "host", "left")
    site = site.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    joined = dealt.join(site, ["host", "part"], "left")
    bad = F.coalesce("boilerplate", F.array().cast("array<string>"))
    kept = F.filter("lines", lambda x: ~F.array_contains(bad, x))
    return joined.select(
        "page_id", "url", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(kept)).cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("text"),
    )
