"""Secrets: patterns propose candidates, and how widely a candidate is held tells a copied example from a live one.

Base kinds (assign, access, hex) are always reported. A candidate is live when at most ``MAX_OWNERS`` owners in the whole
corpus hold it, in at most ``MAX_REPOSITORIES`` repositories: a token that many owners share is an example from a manual,
and so is one that a single owner copies into everything; a token of one owner in a few places is likely to
open something. A long mixed token that no base kind names is added as ``owned`` when it is live. ``n_live`` counts
the live spans, and both counts are given for each.

The counts are exact: distinct (hash, owner) and (hash, repository) rows, then rows per hash. Both
steps combine before they shuffle, so a token in a third of all documents is one row per owner or
repository and task. Candidates are stored once (``materialize``) with a row number, since a later
run of the same plan could number rows otherwise; texts are not carried.

A null or empty text has no candidates. A null owner or repository counts as one owner or
repository. A repeated row gives a repeated row; other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import whole_text
from adtally.llm.spans import counted, ordered, places, with_spans
from adtally.session import materialize

NAMES = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
ASSIGN = NAMES + r"[\"']?\x20*[:=]\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]"
PATTERNS = {
    "assign": f"{ASSIGN}{VALUE}++",
    "access": "AKIA[A-Z0-9]++",
    "hex": "(?<![0-9a-f])[0-9a-f]{32,}+",
    "owned": "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
}
BASE = ("assign", "access", "hex")
#: An added token has a small letter, a capital and a digit, and like any live one at most so many owners and repositories.
MAX_OWNERS, MAX_REPOSITORIES = 2, 10


def _candidates(kind: str) -> Column:
    """Spans of the kind that hold, with the secret itself as their value."""
    spans = F.col(f"_{kind}")
    if kind == "assign":
        named = F.transform(spans, lambda s: s.withField("value", F.regexp_replace(s["value"], f"^{ASSIGN}", "")))
        spans = F.filter(named, lambda s: F.length(s["value"]) >= 8)
    elif kind == "access":
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= 16)
    elif kind == "owned":
        spans = F.filter(spans, lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))
    return F.transform(spans, lambda s: s.withField("score", F.lit(0)))


def candidate_spans(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(row, doc_id, owner, repository, spans) of every document, stored; a span is (start, end, kind, hash)."""
    texts = documents.select(
        "doc_id", F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"),
        whole_text().alias("text"),
    )
    found = with_spans(texts, "text", {f"_{k}": p for k, p in PATTERNS.items()}, {"_access": "AKIA"})
    spans = ordered({kind: _candidates(kind) for kind in PATTERNS})
    hashed = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
        F.sha2(s["value"].cast("binary"), 256).alias("hash"),
    ))
    rows = found.select("doc_id", "owner", "repository", spans.alias("spans"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", hashed.alias("spans"))
    return materialize(rows, "secret-candidates")


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repositories): how many distinct owners and repositories hold each candidate."""
    each = candidates.select("owner", "repository", F.explode("spans.hash").alias("hash"))
    pairs = each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    repositories = pairs.groupBy("hash", "owner").agg(F.count("*").alias("held"))
    by_owner = repositories.groupBy("hash").agg(F.count("*").alias("owners"))
    by_repository = pairs.groupBy("hash", "repository").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("repositories"))
    return by_owner.join(by_repository, "hash")


def judged(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, spans): each candidate with its counts and whether it is live; widely held tokens are left out."""
    each = candidates.select("row", F.explode("spans").alias("span"))
    counted = each.select("row", "span", F.col("span.hash").alias("hash")).join(counts, "hash")
    live = (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)
    kept = counted.where(F.col("span.kind").isin(*BASE) | live)
    span = F.struct(
        "span.start", "span.rank", "span.end", "span.kind", "hash", "owners", "repositories", live.alias("live"),
    )
    return kept.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("judged"))


def secret_spans(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(doc_id, spans) of every document; a span is (start, end, kind, hash, owners, repositories, live)."""
    candidates = candidate_spans(documents, owner, repository)
    spans = judged(candidates, ownership(candidates))
    joined = candidates.select("row", "doc_id").join(spans, "row", "left")
    none = F.array().cast(spans.schema["judged"].dataType)
    return joined.select("doc_id", F.coalesce("judged", none).alias("spans"))


def _joined(name: str) -> Column:
    return F.array_join(F.transform("spans", lambda s: s[name].cast("string")), ",").alias(name)


def secret_report(documents: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of their places, all places, live ones, and for
    each place how many owners and repositories hold its secret."""
    found = secret_spans(documents)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [counted("spans", kind) for kind in BASE]
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return found.select(
        "doc_id", *counts, F.sha2(places(base).cast("binary"), 256).alias("base_sha256"),
        places(F.col("spans")).alias("spans"), live.alias("n_live"),
        _joined("owners"), _joined("repositories"),
    )


def _sql_kind(kind: str, pattern: str, secret: str, valid: str) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT rid, {list(PATTERNS).index(kind)} AS rank, '{kind}' AS kind, start, start + length(value) AS stop, {secret} AS secret
    FROM (
      SELECT rid, found[i] AS value,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
      FROM (SELECT rid, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps FROM docs)))
    WHERE {valid}"""


_NAMED = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?"""
_SECRET = "regexp_replace(value, '^" + _NAMED.replace("'", "''") + "', '')"

SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '\x01') AS owner,
    coalesce(doc_id::VARCHAR, '\x01') AS repository, coalesce(text, '') AS text FROM documents),
spans AS ({_sql_kind("assign", _NAMED + "[A-Za-z0-9+/_.=-]+", _SECRET, f"length({_SECRET}) >= 8")}
UNION ALL {_sql_kind("access", "AKIA[A-Z0-9]+", "value", "length(value) >= 16")}
UNION ALL {_sql_kind("hex", "[0-9a-f]{32,}", "value", "TRUE")}
UNION ALL {_sql_kind("owned", "[A-Za-z0-9+/_-]{20,}", "value", "regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')")}),
owners AS (
  SELECT secret, count(DISTINCT owner) AS o, count(DISTINCT repository) AS r FROM spans JOIN docs USING (rid) GROUP BY secret),
kept AS (
  SELECT *, kind || ':' || start || ':' || stop AS place, o <= {MAX_OWNERS} AND r <= {MAX_REPOSITORIES} AS live
  FROM spans JOIN owners USING (secret) WHERE rank < 3 OR (o <= {MAX_OWNERS} AND r <= {MAX_REPOSITORIES})),
byrow AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
    count(*) FILTER (live) AS l, string_agg(place, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(place, ',' ORDER BY start, rank) AS spans, string_agg(o::VARCHAR, ',' ORDER BY start, rank) AS owners,
    string_agg(r::VARCHAR, ',' ORDER BY start, rank) AS repositories
  FROM kept GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(l, 0) AS n_live,
  coalesce(owners, '') AS owners, coalesce(repositories, '') AS repositories
FROM docs LEFT JOIN byrow USING (rid)
"""
