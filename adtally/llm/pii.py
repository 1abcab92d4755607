"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Everything is DataFrame functions. Base kinds (email, ip, card, phone) are reported whenever their
pattern and check hold; the added kinds (iban, ssn) when their score reaches ``LEAST_SCORE``. A card
needs a Luhn sum, an IBAN the remainder 1 modulo 97, a social security number a possible area and a
word nearby that speaks of one. Scores are whole per cents.

A null or empty text has no spans. A repeated row gives a repeated row; other columns are not used.
A long text is searched whole: patterns give nothing back (possessive), so that none takes time that
grows with the square of a run of letters or digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import whole_text
from adtally.llm.spans import counted, has_context, ordered, places, with_spans

#: Characters of an account number by country, as the public register of such numbers gives them.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18,
    "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31,
    "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def iban_pattern() -> str:
    """Country, check digits and the rest of the country's length; a blank may stand before any character."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    parts = [f"(?:{'|'.join(countries)})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{length - 4}}}" for length, countries in sorted(by_length.items())]
    return f"(?:{'|'.join(parts)})"


LOCAL = "[A-Za-z0-9._%+-]"
#: A start within a run of the same characters can only match where an earlier start did, save right after a match.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Z0-9]){iban_pattern()}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
BASE = ("email", "ip", "card", "phone")
#: Score without and gain with a word nearby, and the words.
SCORES = {
    "email": (80, 15, "mail|contact|write|reach"),
    "ip": (60, 25, "ip|host|server|address"),
    "card": (85, 10, "card|visa|credit|pay"),
    "phone": (70, 20, "phone|tel|call|mobile|fax"),
    "iban": (85, 10, "iban|bank|account|konto"),
    "ssn": (30, 50, "ssn|social security|tax id"),
}
LEAST_SCORE = 50
OCTET = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether every second digit from the right doubled gives a sum that ends in 0."""
    def add(sofar: Column, digit: Column) -> Column:
        twice = digit.cast("int") * 2
        value = F.when(sofar["odd"], F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit.cast("int"))
        return F.struct((sofar["sum"] + value).alias("sum"), (~sofar["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(F.split(F.reverse(digits), ""), start, add, lambda end: end["sum"] % 10 == 0)


def mod97(compact: Column) -> Column:
    """Remainder of an account number: its first four characters moved to the end, A as 10 to Z as 35."""
    moved = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

    def add(sofar: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (sofar * 10 + code - 48) % 97).otherwise((sofar * 100 + code - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), add)


def _alone(span: Column, chars: str) -> Column:
    return ~span["before"].rlike(f"[{chars}]$") & ~span["after"].rlike(f"^[{chars}]")


def _valid(kind: str, span: Column) -> Column:
    value = span["value"]
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        compact = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(_alone(span, "A-Za-z0-9"), mod97(compact) == 1).otherwise(False)
    if kind == "ssn":
        return ~value.rlike("^(?:000|666|9)|-00-|-0000$") & _alone(span, "0-9-")
    return F.lit(True)


def _scored(kind: str) -> Column:
    score, gain, words = SCORES[kind]
    valid = F.filter(F.col(f"_{kind}"), lambda s: _valid(kind, s))
    scored = F.transform(valid, lambda s: s.withField("score", F.when(has_context(s, words), score + gain).otherwise(score)))
    return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= LEAST_SCORE)


def pii_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, text, spans) of every document; a span is (start, end, kind, value, score)."""
    texts = documents.select("doc_id", whole_text().alias("text"))
    found = with_spans(texts, "text", {f"_{k}": p for k, p in PATTERNS.items()}, {f"_{k}": n for k, n in NEEDS.items()})
    return found.select("doc_id", "text", ordered({kind: _scored(kind) for kind in PATTERNS}).alias("spans"))


def redacted(found: DataFrame) -> DataFrame:
    """(doc_id, text) with each reported span replaced by its kind in brackets.

    Where spans overlap, the one that starts first is replaced and the rest of the other is removed with it.
    """
    def cut(sofar: Column, span: Column) -> Column:
        kept = F.substring(F.col("text"), (sofar["place"] + 1).cast("int"), (span["start"] - sofar["place"]).cast("int"))
        mark = F.concat(F.lit("["), span["kind"], F.lit("]"))
        fresh = span["start"] >= sofar["place"]
        return F.struct(
            F.greatest(sofar["place"], span["end"]).alias("place"),
            F.when(fresh, F.concat(sofar["parts"], F.array(kept, mark))).otherwise(sofar["parts"]).alias("parts"),
        )

    start = F.struct(F.lit(0).cast("long").alias("place"), F.array().cast("array<string>").alias("parts"))
    rest = lambda end: F.concat(F.array_join(end["parts"], ""), F.substring(F.col("text"), (end["place"] + 1).cast("int"), F.length("text")))
    return found.select("doc_id", F.aggregate("spans", start, cut, rest).alias("text"))


def pii_report(documents: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of their places, all places, all scores."""
    found = pii_spans(documents).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [counted("spans", kind) for kind in BASE]
    scores = F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",")
    return found.select(
        "doc_id", *counts, F.sha2(places(base).cast("binary"), 256).alias("base_sha256"),
        places(F.col("spans")).alias("spans"), scores.alias("scores"),
    )


def _sql_kind(kind: str, pattern: str, valid: str) -> str:
    score, gain, words = SCORES[kind]
    rank = list(PATTERNS).index(kind)
    return f"""
    SELECT rid, {rank} AS rank, '{kind}' AS kind, start, start + length(value) AS stop, value, before, after,
      {score} + CASE WHEN regexp_matches(lower(before || ' ' || after), '{words}') THEN {gain} ELSE 0 END AS score
    FROM (
      SELECT rid, found[i] AS value, right(gaps[i], 48) AS before, left(gaps[i + 1], 48) AS after,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
      FROM (SELECT rid, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps FROM docs)))
    WHERE {valid}"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
  CASE WHEN (length({_DIGITS}) - i) % 2 = 0 THEN {_DIGITS}[i]::INT
  ELSE ({_DIGITS}[i]::INT * 2) // 10 + ({_DIGITS}[i]::INT * 2) % 10 END)) % 10 = 0"""
_COMPACT = "replace(value, ' ', '')"
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(string_split({_COMPACT}[5:] || {_COMPACT}[1:4], ''),
  lambda c: CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
  lambda a, b: CASE WHEN b < 10 THEN (a * 10 + b) % 97 ELSE (a * 100 + b) % 97 END) = 1"""

#: The patterns here give back and look at nothing around them; the results must be the same.
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({_sql_kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE")}
UNION ALL {_sql_kind("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(value, '.'), lambda x: x::HUGEINT)) <= 255")}
UNION ALL {_sql_kind("card", r"[0-9](?:[ -]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}")}
UNION ALL {_sql_kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")}
UNION ALL {_sql_kind("iban", r"\b" + iban_pattern(), f"NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AND {_MOD97}")}
UNION ALL {_sql_kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "NOT regexp_matches(value, '^(?:000|666|9)|-00-|-0000$') AND NOT regexp_matches(before, '[0-9-]$') AND NOT regexp_matches(after, '^[0-9-]')")}),
kept AS (SELECT *, kind || ':' || start || ':' || stop AS place FROM spans WHERE rank < 4 OR score >= {LEAST_SCORE}),
byrow AS (
  SELECT rid, count(*) FILTER (kind = 'email') AS e, count(*) FILTER (kind = 'ip') AS i,
    count(*) FILTER (kind = 'card') AS c, count(*) FILTER (kind = 'phone') AS p,
    string_agg(place, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
    string_agg(place, ',' ORDER BY start, rank) AS spans, string_agg(score::VARCHAR, ',' ORDER BY start, rank) AS scores
  FROM kept GROUP BY rid)
SELECT doc_id, coalesce(e, 0) AS n_email, coalesce(i, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(p, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM docs LEFT JOIN byrow USING (rid)
"""
