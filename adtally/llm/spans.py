"""Places of pattern matches as DataFrame expressions.

Spark has no function that returns the offsets of all matches. ``regexp_extract_all`` gives the
matches and ``split`` the texts between them; a running sum of both lengths gives the places, in
code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Matches are added up in chunks of this many, so that a text with very many stays cheap.
CHUNK = 256
#: Characters kept on either side of a match.
CONTEXT = 48
SPAN = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def with_spans(df: DataFrame, text: str, patterns: dict[str, str], needs: dict[str, str] | None = None) -> DataFrame:
    """Add a column per kind with (start, end, value, before, after) of each leftmost match.

    Matches do not overlap within a kind. ``before`` and ``after`` are up to ``CONTEXT`` characters
    of the text between this match and its neighbours. A pattern must not match the empty text;
    ``needs`` may name a plain text without which a kind cannot occur. ``text`` must not be null.
    """
    needs, kept = needs or {}, df.columns
    none = F.array().cast("array<string>")
    found = {
        f"_{kind}_found": F.when(F.contains(F.col(text), F.lit(needs.get(kind, ""))), _extract(text, pattern)).otherwise(none)
        for kind, pattern in patterns.items()
    }
    df = df.select(*kept, *[column.alias(name) for name, column in found.items()])
    gaps = {
        f"_{kind}_gaps": F.when(F.size(f"_{kind}_found") > 0, F.split(F.col(text), pattern, -1)).otherwise(none)
        for kind, pattern in patterns.items()
    }
    df = df.select(*kept, *found, *[column.alias(name) for name, column in gaps.items()])
    spans = [_places(f"_{kind}_found", f"_{kind}_gaps").alias(kind) for kind in patterns]
    return df.select(*kept, *spans)


def _extract(text: str, pattern: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))


def _places(found_name: str, gaps_name: str) -> Column:
    found, gaps, empty = F.col(found_name), F.col(gaps_name), F.array().cast(SPAN)

    def one(sofar: Column, at: Column) -> Column:
        gap, value = F.get(gaps, at), F.get(found, at)
        start = sofar["place"] + F.length(gap)
        end = start + F.length(value)
        row = F.struct(
            start.alias("start"), end.alias("end"), value.alias("value"),
            F.right(gap, F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, at + 1), F.lit(CONTEXT)).alias("after"),
        )
        return F.struct(end.alias("place"), F.concat(sofar["rows"], F.array(row)).alias("rows"))

    def chunk(sofar: Column, first: Column) -> Column:
        last = F.least(first + F.lit(CHUNK - 1), F.size(found) - 1)
        return F.aggregate(
            F.sequence(first, last),
            F.struct(sofar["place"].alias("place"), empty.alias("rows")),
            one,
            lambda part: F.struct(
                part["place"].alias("place"), F.concat(sofar["done"], F.array(part["rows"])).alias("done")
            ),
        )

    start = F.struct(F.lit(0).cast("long").alias("place"), F.array().cast(f"array<{SPAN}>").alias("done"))
    firsts = F.sequence(F.lit(0), F.size(found) - 1, F.lit(CHUNK))
    return F.when(F.size(found) > 0, F.aggregate(firsts, start, chunk, lambda all_: F.flatten(all_["done"]))).otherwise(empty)


def places(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def ordered(kinds: dict[str, Column]) -> Column:
    """One array of all kinds, by start and then by the order of ``kinds``."""
    def of(rank: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            s["value"].alias("value"), s["score"].alias("score"),
        ))

    ranked = [of(rank, kind, spans) for rank, (kind, spans) in enumerate(kinds.items())]
    return F.array_sort(F.concat(*ranked))


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def has_context(span: Column, words: str) -> Column:
    """Whether one of the words (a pattern of lower-case words) stands near the span."""
    return F.lower(F.concat_ws(" ", span["before"], span["after"])).rlike(words)
