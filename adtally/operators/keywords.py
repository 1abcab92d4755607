"""Keyword reports: page views, pairs, reach and first-match performance.

A pack is a DataFrame with one ``keyword`` column, joined whatever its size: Spark picks the join.
Where the place of a word within its request matters, the rows are stored once with a number; the
words alone are exploded, meet the pack in a semi join and return to their row by its number, so that
no keyword array is ever a key or crosses a shuffle. Packs are only tested for membership, so repeated
words are harmless; they are not made distinct, because a join whose pack side is a plain shuffle is
one whose hot keyword the adaptive plan can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.keywords import UNKNOWN
from adtally.functions.labels import os_class_pv
from adtally.session import materialize


def _count_in_pack(rows: DataFrame, pack: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = rows.groupBy(*keys).agg(F.count("*").alias("pv"))
    return counts.join(pack.select("keyword"), "keyword", "left_semi").select(*keys, "pv")


def keyword_pv(bids: DataFrame, pack: DataFrame) -> DataFrame:
    """Occurrences of each pack word per system; other systems are left out."""
    words = bids.select(os_class_pv(F.col("os")).alias("system"), F.explode("keywords").alias("keyword"))
    return _count_in_pack(words.where("system <> '-'"), pack, ["system", "keyword"])


def channel_keyword_pv(bids: DataFrame, pack: DataFrame) -> DataFrame:
    """Occurrences of each pack word per system and channel; blanks are left out."""
    words = bids.where("channel <> ''").select(
        os_class_pv(F.col("os")).alias("system"), "channel", F.explode("keywords").alias("keyword")
    )
    return _count_in_pack(
        words.where("system <> '-' and keyword <> ''"), pack, ["system", "channel", "keyword"]
    )


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows with a number ``row``, stored, so that a later read sees the same numbers."""
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), *rows.columns), name)


def _found(rows: DataFrame, words: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """(row, at, keyword) of every keyword that is in ``words`` within equal ``scope`` columns."""
    each = rows.select("row", *scope, F.posexplode("keywords").alias("at", "keyword"))
    return each.join(words.select(*scope, "keyword"), [*scope, "keyword"], "left_semi").select("row", "at", "keyword")


def keyword_pairs(bids: DataFrame, pack: DataFrame) -> DataFrame:
    """Ordered pairs (a before b) of different pack words within one request, counted.

    Only pack words are paired: they are found first and put together per request again. The pairs of
    a request are streamed by two explodes into the map-side combine; no array of pairs is built.
    """
    rows = _numbered(bids.select("keywords"), "keyword-rows")
    found = _found(rows, pack.where("keyword <> ''"))
    kept = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "keyword"))).alias("words"))
    words = kept.select(F.col("words.keyword").alias("words"))
    heads = words.select("words", F.posexplode("words").alias("at", "a"))
    rest = F.slice("words", F.col("at") + 2, F.size("words"))
    pairs = heads.select("a", F.explode(rest).alias("b")).where("a <> b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def keyword_relations(pairs: DataFrame) -> DataFrame:
    """Neighbours of every keyword with the pair count of both directions and the total.

    The join that adds the total meets at most one row per pair of words, however many requests
    there were.
    """
    both = pairs.select(
        F.inline(F.array(
            F.struct(F.col("a").alias("keyword"), F.col("b").alias("neighbour"), "n"),
            F.struct(F.col("b").alias("keyword"), F.col("a").alias("neighbour"), "n"),
        ))
    )
    links = both.groupBy("keyword", "neighbour").agg(F.sum("n").alias("n"))
    totals = links.groupBy("keyword").agg(F.sum("n").alias("total"))
    return links.join(totals, "keyword")


def relation_fragments(relations: DataFrame) -> DataFrame:
    """(keyword, part, neighbour, fragment): pieces of ``"keyword":{"relation":{neighbour: n, …},"total":n}``.

    In the order of keyword, part and neighbour the fragments of a keyword make its text, however
    many neighbours it has; no row holds more than one of them.
    """
    stored = materialize(relations, "relations")
    ends = stored.groupBy("keyword").agg(F.min("neighbour").alias("first"), F.max("total").alias("total"))
    comma = F.when(F.col("neighbour") != F.col("first"), ",").otherwise("")
    entry = F.concat(comma, _json_text("neighbour"), F.lit(":"), F.col("n").cast("string"))
    entries = stored.join(ends.select("keyword", "first"), "keyword").select(
        "keyword", F.lit(1).alias("part"), "neighbour", entry.alias("fragment")
    )
    nothing = F.lit(None).cast("string").alias("neighbour")
    heads = ends.select("keyword", F.lit(0).alias("part"), nothing, F.concat(_json_text("keyword"), F.lit(':{"relation":{')).alias("fragment"))
    tails = ends.select("keyword", F.lit(2).alias("part"), nothing, F.concat(F.lit('},"total":'), F.col("total").cast("string"), F.lit("}")).alias("fragment"))
    return heads.unionByName(entries).unionByName(tails)


def _json_text(name: str):
    """The value as a JSON text, with its quotes."""
    whole = F.to_json(F.struct(F.col(name).alias("k")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def reach(rows: DataFrame, pack: DataFrame, platform: str) -> DataFrame:
    """Requests with at least one pack word per channel and hour."""
    stored = _numbered(rows.where("channel <> ''").select("channel", "hour", "keywords"), "reach-rows")
    hits = stored.select("row", "channel", "hour").join(_found(stored, pack).select("row"), "row", "left_semi")
    counts = hits.groupBy("channel", "hour").agg(F.count("*").alias("count"))
    return counts.select(F.lit(platform).alias("platform"), "channel", "hour", "count")


DELIVERY_SUMS = ["impression", "click", "price", "bidprice"]
REPORT_KEYS = ["keyword", "ad_id", "platform"]


def _delivery_sums(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in DELIVERY_SUMS])


def _hour_rows(sums: DataFrame) -> DataFrame:
    """Report rows: cost and bid cut to whole units."""
    return sums.select(
        "d", "h", *REPORT_KEYS, "impression", "click",
        F.col("price").cast("bigint").alias("cost"), F.col("bidprice").cast("bigint").alias("bid"),
    )


def valid_deliveries(deliveries: DataFrame) -> DataFrame:
    return deliveries.where("request_time <> 0")


def first_match_report(deliveries: DataFrame, pack: DataFrame) -> DataFrame:
    """Performance by the first pack word of each delivery, one pack for all ads."""
    return _matched_report(_delivery_rows(deliveries), pack)


def active_ads(deliveries: DataFrame) -> DataFrame:
    """Ads with a delivery, per hour."""
    return deliveries.select("d", "h", "ad_id").distinct()


def keyword_hour_report(
    deliveries: DataFrame, ad_pack: DataFrame, scope: str = "hour"
) -> DataFrame:
    """Performance by first matching keyword, ad and platform for every hour.

    ``scope="hour"`` matches against the words of all ads active in the hour, ``scope="ad"``
    against the words of the delivery's own ad.
    """
    if scope not in ("hour", "ad"):
        raise ValueError(f"unknown scope {scope!r}")
    rows = _delivery_rows(deliveries)
    if scope == "ad":
        return _matched_report(rows, ad_pack, ["ad_id"])
    hour_words = active_ads(rows).join(ad_pack, "ad_id").select("d", "h", "keyword").distinct()
    return _head_first_report(rows, hour_words, ["d", "h"])


def _delivery_rows(deliveries: DataFrame) -> DataFrame:
    """Valid deliveries with a number, stored: they are read once."""
    rows = valid_deliveries(deliveries).withColumnRenamed("source", "platform")
    return _numbered(rows.select("d", "h", "ad_id", "platform", "keywords", *DELIVERY_SUMS), "deliveries")


def _matched_report(rows: DataFrame, words: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Report by the first keyword of each stored row that is in ``words``; numbers and words cross the shuffles."""
    first = _found(rows, words, scope).groupBy("row").agg(F.min_by("keyword", "at").alias("keyword"))
    labelled = rows.drop("keywords").join(first, "row", "left").fillna(UNKNOWN, subset=["keyword"])
    return _hour_rows(_delivery_sums(labelled, ["d", "h", *REPORT_KEYS]))


def _head_first_report(rows: DataFrame, words: DataFrame, scope: Sequence[str]) -> DataFrame:
    """The same report where most rows match with their first keyword: later ones are only looked up for rows that do not.

    First keywords meet the (distinct) words alone. What they match is added up at once; the other rows keep their number,
    and only their further keywords cross the shuffles.
    """
    heads = rows.select("row", "d", "h", "ad_id", "platform", *DELIVERY_SUMS, F.get("keywords", F.lit(0)).alias("keyword"))
    hit = F.col("hit").isNotNull()
    tried = heads.join(words.select(*scope, "keyword", F.lit(True).alias("hit")), [*scope, "keyword"], "left").select(
        "d", "h", F.when(hit, F.col("keyword")).alias("keyword"), "ad_id", "platform", F.when(~hit, F.col("row")).alias("row"), *DELIVERY_SUMS
    )
    sums = materialize(_delivery_sums(tried, ["d", "h", *REPORT_KEYS, "row"]), "first-keywords")
    missed = sums.where("row is not null").drop("keyword")
    # Arrays cross no shuffle here either: rows are exploded before they meet those that missed.
    each = rows.select("row", *scope, F.posexplode("keywords").alias("at", "keyword")).where("at > 0")
    later = each.join(missed.select("row"), "row", "left_semi").join(words, [*scope, "keyword"], "left_semi")
    first = later.groupBy("row").agg(F.min_by("keyword", "at").alias("keyword"))
    rest = missed.join(first, "row", "left").fillna(UNKNOWN, subset=["keyword"])
    both = sums.where("row is null").unionByName(rest).drop("row")
    return _hour_rows(_delivery_sums(both, ["d", "h", *REPORT_KEYS]))
