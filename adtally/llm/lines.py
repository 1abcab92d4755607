"""Line dedup by distinct-site spread.

A line is boilerplate when it occurs on at least ``MIN_SITES`` distinct sites. Each line's sites go
into a HyperLogLog sketch per line hash; sketches of the map tasks merge in the aggregate, so a line
in a third of all documents is one small sketch per task. Lines whose estimate is so near the limit
that the sketch could err (``band``) get an exact distinct count, over their own rows only.

Of a boilerplate line the first occurrence stays: in the smallest document id that holds it, the
first line there. All others go, so that no content is lost with its copies.

Blank lines are never boilerplate. A null text stays null and has no lines, an empty text has one
empty line. A null site counts as the site '' and a null id as the largest. Repeated rows get the
same result; columns of any name pass through. Lines are compared whole, by a 64-bit hash, whatever
their length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import columns_of, own_prefix, quoted
from adtally.session import materialize

MIN_SITES = 5
LOG_K = 10


def band(min_sites: int, log_k: int = LOG_K) -> tuple[float, float]:
    """Estimates within six standard errors of the limit, and within one site of it, are not trusted."""
    error = max(1.0, 6 * 1.04 / math.sqrt(2 ** log_k) * min_sites)
    return min_sites - error, min_sites + error


def _key(prefix: str = "_") -> list[Column]:
    """A document row is known by its id and text; equal rows get equal results."""
    return [F.col("doc_id").alias(f"{prefix}id"), F.xxhash64("text").alias(f"{prefix}text")]


def lines_of(documents: DataFrame, site: str) -> DataFrame:
    """Stored (_id, _text, site, at, line) of every line that is not blank; ``line`` is a hash."""
    rows = documents.select(
        *_key(), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split("text", "\n", -1)).alias("at", "line"),
    )
    return materialize(
        rows.where(F.col("line").rlike(r"[^ \t\n\x0B\f\r]")).withColumn("line", F.xxhash64("line")), "lines"
    )


def spread(lines: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """(line, sites, first): estimated distinct sites and the smallest document id."""
    sketches = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(log_k)).alias("sketch"), F.min("_id").alias("first"))
    return sketches.select("line", F.hll_sketch_estimate("sketch").cast("double").alias("sites"), "first")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """(line, first) of the lines on at least ``min_sites`` sites."""
    low, high = band(min_sites, log_k)
    wide = materialize(spread(lines, log_k).where(F.col("sites") >= low), "wide-lines")
    # Stored by itself, so that Spark knows that it is small and leaves the lines where they are.
    near = materialize(wide.where(F.col("sites") <= high).select("line", "first"), "near-lines")
    pairs = lines.join(near, "line").groupBy("line", "site").agg(F.first("first").alias("first"))
    exact = pairs.groupBy("line").agg(F.count("*").alias("sites"), F.first("first").alias("first"))
    sure = wide.where(F.col("sites") > high).select("line", "first")
    return materialize(sure.union(exact.where(F.col("sites") >= min_sites).select("line", "first")), "boilerplate")


def without_boilerplate(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """All columns of ``documents`` with the remaining text, and ``n_lines`` and ``n_removed`` behind ``own_prefix``."""
    own = own_prefix(documents)
    lines = lines_of(documents, site)
    hits = lines.join(boilerplate(lines, min_sites), "line").groupBy("_id", "_text", "line").agg(
        F.first("first").alias("first"), F.min("at").alias("least"), F.collect_set("at").alias("places")
    )
    # In the first document of a line its first occurrence stays.
    gone = F.when(F.col("_id").eqNullSafe(F.col("first")), F.array_remove("places", F.col("least"))).otherwise(F.col("places"))
    drops = hits.groupBy("_id", "_text").agg(F.flatten(F.collect_list(gone)).alias("drop"))
    keyed = documents.select(*columns_of(documents), *_key(own))
    drop, parts = f"{own}drop", f"{own}lines"
    joined = keyed.join(
        drops.toDF(f"{own}drop_id", f"{own}drop_text", drop),
        F.col(f"{own}id").eqNullSafe(F.col(f"{own}drop_id")) & (F.col(f"{own}text") == F.col(f"{own}drop_text")), "left",
    )
    split = joined.withColumn(parts, F.split("text", "\n", -1))
    n = F.coalesce(F.when(F.col("text").isNotNull(), F.size(parts)), F.lit(0))
    removed = F.coalesce(F.size(drop), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(drop))
    text = F.array_join(F.transform(left, lambda at: F.get(F.col(parts), at)), "\n")
    rest = F.when(removed > 0, text).otherwise(F.col("text")).alias("text")
    kept = [rest if c == "text" else F.col(quoted(c)) for c in documents.columns]
    return split.select(*kept, n.cast("long").alias(f"{own}n_lines"), removed.cast("long").alias(f"{own}n_removed"))


def line_report(documents: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, text_sha256) of every document; a null text has the digest of an empty one."""
    documents = documents.select("doc_id", "text", "source")
    cleaned, own = without_boilerplate(documents), own_prefix(documents)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select(
        "doc_id", F.col(f"{own}n_lines").alias("n_lines"), F.col(f"{own}n_removed").alias("n_removed"), digest.alias("text_sha256")
    )


def deduped(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The documents with their remaining text and its ``n_chars``; those of which nothing is left are gone."""
    cleaned = without_boilerplate(documents, site, min_sites)
    removed = F.col(f"{own_prefix(documents)}n_removed")
    rest = cleaned.where((removed == 0) | F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    chars = F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast(dict(documents.dtypes)["n_chars"])
    return rest.withColumn("n_chars", chars).select(*columns_of(documents))


SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS site, text FROM documents),
split AS (SELECT rid, doc_id, site, string_split(text, chr(10)) AS parts FROM docs WHERE text IS NOT NULL),
lines AS (
  SELECT rid, doc_id, site, place, parts[place] AS line
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS place FROM split)),
boiler AS (
  SELECT line, min(doc_id) AS first FROM lines WHERE regexp_matches(line, '[^ \t\n\v\f\r]')
  GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
marked AS (
  SELECT lines.*, boiler.line IS NOT NULL AND NOT (lines.doc_id IS NOT DISTINCT FROM first
    AND row_number() OVER (PARTITION BY rid, lines.line ORDER BY place) = 1) AS gone
  FROM lines LEFT JOIN boiler ON lines.line = boiler.line),
cleaned AS (
  SELECT rid, count(*) AS n, count(*) FILTER (gone) AS removed, string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS rest
  FROM marked GROUP BY rid)
SELECT doc_id, coalesce(n, 0) AS n_lines, coalesce(removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS text_sha256
FROM docs LEFT JOIN cleaned USING (rid)
"""
