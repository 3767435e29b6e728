"""Not-modified revisits resolved to the responses they refer to.

A revisit record holds no body: it says that the page was as before. It belongs to
the latest full response of the same canonical URL captured strictly earlier. Its
validators have to agree with that response's, and of its headers only those that
a not-modified answer may renew replace the stored ones.

The as-of join is two windows. Time is cut into slices: inside a slice of a URL the
last response is carried along; across slices only each slice's last response is.
A URL with most captures is thus many groups, and the second window has at most one
row per slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from larder.llm.common import table
from larder.plans.lineage import pin

#: Headers that a not-modified answer renews, in lower case.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


@dataclass(frozen=True)
class RevisitRules:
    slices: int = 64
    permitted: tuple[str, ...] = PERMITTED


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, ports 80 and 443, fragment, trailing slashes and utm parameters go; the host is lower-cased, the query sorted.

    User info, the case of the path and of the query, percent escapes and dot segments
    stay as they are. Null stays null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www[0-9]*\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike("^utm_")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _strip_weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def validators_agree(revisit: Column, response: Column) -> Column:
    """True or false by the strongest validator both have: body digest, entity tag (weakly), last-modified; null if there is none."""
    same = lambda name, clean=lambda x: x: F.when(
        revisit[name].isNotNull() & response[name].isNotNull(), clean(revisit[name]) == clean(response[name])
    )
    return F.coalesce(same("digest"), same("etag", _strip_weak), same("last_modified"))


def merged_headers(stored: Column, fresh: Column, permitted: tuple[str, ...] = PERMITTED) -> Column:
    """Stored headers with the permitted fresh ones over them; names in lower case, the last of equal names wins."""
    lower = lambda m: F.aggregate(
        F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))), F.create_map().cast("map<string,string>"),
        lambda out, e: F.map_concat(F.map_filter(out, lambda k, _: k != F.lower(e["key"])), F.create_map(F.lower(e["key"]), e["value"])),
    )
    new = F.map_filter(lower(fresh), lambda k, _: k.isin(*permitted))
    old = F.map_filter(lower(stored), lambda k, _: ~F.map_contains_key(new, k))
    return F.map_concat(old, new)


def latest_earlier(responses: DataFrame, moments: DataFrame, slices: int) -> DataFrame:
    """(key, at, found): for each distinct (key, at) of ``moments`` the ``row`` of the latest response strictly before.

    ``responses``: key, at, row. Of responses at one moment the largest row counts. Rows
    with a null key or moment find nothing and are not returned.
    """
    known = responses.filter("key is not null and at is not null").groupBy("key", "at").agg(F.max("row").alias("row"))
    asked = moments.filter("key is not null and at is not null").select("key", "at").distinct()
    line = pin(known.withColumn("is_response", F.lit(1)).unionByName(asked.withColumn("is_response", F.lit(0)), allowMissingColumns=True))
    low, high = line.agg(F.min("at"), F.max("at")).first()
    width = max(1, (high - low) // slices + 1) if low is not None else 1
    line = line.withColumn("slice", F.floor((F.col("at") - F.lit(low or 0)) / width))
    inside = Window.partitionBy("key", "slice").orderBy("at", "is_response").rowsBetween(Window.unboundedPreceding, -1)
    near = line.withColumn("near", F.last("row", ignorenulls=True).over(inside)).filter("is_response = 0")
    ends = pin(line.groupBy("key", "slice").agg(F.max_by("row", F.when(F.col("row").isNotNull(), F.col("at"))).alias("last")))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = pin(ends.select(F.col("key").alias("_k"), F.col("slice").alias("_s"), F.last("last", ignorenulls=True).over(before).alias("carry")))
    both = pin(near.select("key", "at", "slice", "near")).join(carried, (F.col("key") == F.col("_k")) & (F.col("slice") == F.col("_s")), "left")
    return both.select("key", "at", F.coalesce("near", "carry").alias("found"))


def resolve_revisits(captures: DataFrame, rules: RevisitRules = RevisitRules()) -> DataFrame:
    """Every revisit of ``captures`` with the response it stands for.

    ``captures``: record_id, kind (response or revisit), url, at (long), digest, etag,
    last_modified, headers. Gives record_id, url, at, outcome, response_id, headers:
    ``resolved`` with the merged headers, ``changed`` if the validators disagree,
    ``unproven`` if the two share none, ``orphan`` without an earlier response (also for
    null URLs and times). Only ``resolved`` rows have headers, all but orphans a
    response_id. Repeated revisits are each resolved. Other columns, whatever their
    names, aren't looked at.
    """
    needed = ("record_id", "kind", "at", "digest", "etag", "last_modified", "headers")
    keyed = captures.select(*needed, canonical_url(F.col("url")).alias("key"))
    own = F.struct("at", "record_id", "digest", "etag", "last_modified", F.map_entries("headers").alias("headers"))
    responses = keyed.filter("kind = 'response'").select("key", "at", own.alias("row"))
    revisits = keyed.filter("kind = 'revisit'")
    found = pin(latest_earlier(responses, revisits, rules.slices)).select(F.col("key").alias("_k"), F.col("at").alias("_at"), "found")
    joined = revisits.join(found, (F.col("key") == F.col("_k")) & (F.col("at") == F.col("_at")), "left")
    agree = validators_agree(F.struct("digest", "etag", "last_modified"), F.col("found"))
    outcome = F.when(F.col("found").isNull(), "orphan").when(agree, "resolved").when(agree.isNull(), "unproven").otherwise("changed")
    stored = F.map_from_entries(F.col("found.headers"))
    return joined.withColumn("outcome", outcome).select(
        "record_id", F.col("key").alias("url"), "at", "outcome", F.col("found.record_id").alias("response_id"),
        F.when(F.col("outcome") == "resolved", merged_headers(stored, F.col("headers"), rules.permitted)).alias("headers"),
    )


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of ``pages``: each page as a full response, and just before it a revisit that claims its entity tag.

    The revisit is right exactly if the page was the same at its URL's capture before.
    """
    tag = F.md5(F.coalesce("html", F.lit("")))
    common = {"url": F.col("url"), "digest": F.lit(None).cast("string"), "etag": tag, "last_modified": F.lit(None).cast("string")}
    text = lambda c: F.col(c).cast("string")
    full = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.length(F.coalesce("html", F.lit(""))).cast("string"),
        F.lit("Date"), text("page_id"), F.lit("ETag"), tag,
    )
    brief = F.create_map(F.lit("Content-Length"), F.lit("0"), F.lit("Date"), F.concat(F.lit("not-modified "), text("page_id")), F.lit("ETag"), F.concat(F.lit("W/"), tag))
    kind = lambda name, at, headers, etag: pages.select(
        F.col("page_id").alias("record_id"), F.lit(name).alias("kind"), at.alias("at"), headers.alias("headers"), *[x.alias(k) for k, x in (common | {"etag": etag}).items()]
    )
    at = F.col("page_id") * 2
    return kind("response", at, full, tag).unionByName(kind("revisit", at - 1, brief, F.concat(F.lit("W/"), tag)))


def page_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return _report(resolve_revisits(page_captures(table(spark, folder, "pages"))))


def _report(made: DataFrame) -> DataFrame:
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return made.select(F.col("record_id").alias("page_id"), "url", "outcome", F.col("response_id").alias("response_page_id"), F.array_join(lines, "\n").alias("headers"))


#: Where a quarter of the pages of ``ruled_captures`` lie.
HOT_URL = "https://hot.example.net/front"


def ruled_captures(pages: DataFrame) -> DataFrame:
    """Captures of ``pages`` that meet every rule: each page as a response, and one revisit of its URL.

    The first four digits of the URL's MD5 decide: a quarter of the pages lie at one hot
    URL; which validators the revisit claims and which of them are wrong; which the
    response has; and by how many pages the revisit is late (0: it comes before its page).
    A last-modified time holds for 16 pages.
    """
    digit = lambda k: F.substring(F.md5(F.coalesce("url", F.lit(""))), k, 1)
    html, page = F.coalesce("html", F.lit("")), F.col("page_id").cast("string")
    d = pages.select(
        F.when(digit(1) < "4", F.lit(HOT_URL)).otherwise(F.col("url")).alias("url"), "page_id", page.alias("page"),
        digit(2).alias("claim"), digit(3).alias("has"), F.conv(digit(4), 16, 10).cast("long").alias("late"),
        F.sha1(html).alias("d"), F.md5(html).alias("e"), F.concat(F.lit("day "), F.floor(F.col("page_id") / 16).cast("string")).alias("m"),
        F.length(html).cast("string").alias("size"),
    )
    claims = lambda right, wrong, value: F.when(F.col("claim").isin(*right), value).when(F.col("claim").isin(*wrong), F.concat(value, F.lit("x")))
    present = lambda *pairs: F.map_filter(F.create_map(*[x if not isinstance(x, str) else F.lit(x) for x in pairs]), lambda _, v: v.isNotNull())
    weak = claims("0123af", "89d", F.concat(F.lit("W/"), F.col("e")))
    full = d.select(
        F.col("page_id").alias("record_id"), F.lit("response").alias("kind"), "url", (F.col("page_id") * 2).alias("at"),
        F.when(F.col("has").isin(*"0123456789abd"), F.col("d")).alias("digest"), F.when(F.col("has").isin(*"0123456789abc"), F.col("e")).alias("etag"),
        F.when(F.col("has").isin(*"0123456789abe"), F.col("m")).alias("last_modified"),
        present("Content-Type", F.lit("text/html"), "Content-Length", F.col("size"), "Date", F.col("page"), "ETag", F.col("e"),
                "cache-control", F.lit("no-cache"), "X-Page", F.col("page")).alias("headers"),
    )
    brief = d.select(
        F.col("page_id").alias("record_id"), F.lit("revisit").alias("kind"), "url", (F.col("page_id") * 2 + F.col("late") * 2 - 1).alias("at"),
        claims("45d", "ae", F.col("d")).alias("digest"), weak.alias("etag"), claims("67", "c", F.col("m")).alias("last_modified"),
        present("Content-Length", F.lit("0"), "DATE", F.concat(F.lit("not-modified "), F.col("page")), "Etag", weak, "X-Page", F.lit("none"),
                "Cache-Control", F.when(F.col("late") < 8, F.concat(F.lit("max-age="), F.col("page"))),
                "Expires", F.when(F.col("late") % 2 == 1, F.col("page"))).alias("headers"),
    )
    return full.unionByName(brief)


def ruled_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return _report(resolve_revisits(ruled_captures(table(spark, folder, "pages"))))
