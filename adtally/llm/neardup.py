"""Near-duplicates by bottom-k sketches from one hash function.

A document is the set of its distinct ``size``-word shingles, and its sketch the ``KEPT`` smallest
hashes of the set. Documents with equal sets are one class from the start, with its smallest id as
representative; links are sought between classes only.

1. Inverted lists of the ``FIRST`` smallest values of each class give pairs and their overlaps. Two sets
   with a similarity of 0.8 share fewer than two of these with a chance under 1e-9.
2. A value in more than ``HOT`` classes (a passage that many documents hold, a large group of near
   copies) gives no pairs in step 1. Classes with such a value are looked at again with all ``KEPT``
   values. A class of which enough values are in short lists (``_cold_enough``) still shares two of them
   with every partner, so its hot values are not needed.
3. The others consist of hot values mostly. In each hot list the class whose values are most widely
   held is the pivot, and every member is paired with the pivot alone: a large group of near
   copies gives one pair per member.
4. Pairs of unlike sizes go; for the others the sketch of the union estimates the similarity, and those
   far below the limit go. The rest are confirmed on the full sets of shingle hashes.
5. Groups of which members are still apart from the pivot's component are looked at by full sets. Values
   are ranked from rare to common over all such groups; two sets as similar as asked share one of the first
   fifth of theirs (``ranked``). What only one class holds counts for the rank but needs no list, so
   pages of one template with a fifth or more of their own have none. Short lists give pairs as in step 1, for step 4.
6. Only classes that share such a value with very many others go on: those apart are compared with the
   others of their pivot's group, block by block, and a link for each component that one joins comes out. Of two sets
   as similar, the smaller has a ninth of its values for itself at most, so others than these meet these only.

Components are found by label rounds over the confirmed links (``components``). Full sets are made
only for classes in likely pairs and of step 3. No list is cut off, and no step collects one without a
bound or sends links to the driver. Step 6 is the only one whose work grows with a product: classes that
are apart times those of their group, of those with hardly any values that are not common.

A document without words or text has no shingle and is linked with nothing. A null id has no
component and is kept. Repeated rows of an id are linked by their texts like any others, and each row
gets the component of its own text. Long texts count whole; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import columns_of, own_prefix, python_tasks, raw_texts, worker_cache
from adtally.llm.components import components
from adtally.llm.hashing import hashed_words, mixed
from adtally.session import materialize

SIMILAR = 80
FIRST, KEPT = 16, 64
HOT = 32
SHARED = 2
#: A class with so many cold values shares two of them with every partner: more than 33 of 64 values
#: of a set are missing in the other with a chance under 1e-9.
COLD = 36
#: A pair with an estimate below this is five standard deviations off a similarity of 0.8.
LEAST_ESTIMATE = 0.55
#: Two sketches with that estimate share 35 values, and 34 hot ones unless they share two in short
#: lists, so each may leave aside pivots of so many.
ASIDE = 16
#: Rows and bytes of full sets in a block of step 5, and values compared at once.
BLOCK_ROWS, BLOCK_BYTES, BLOCK_VALUES = 1000, 8 << 20, 4096

def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 63-bit shingle hashes; fewer words than ``size`` are one shingle."""
    words, _, _ = hashed_words(text or b"")
    if not len(words):
        return np.zeros(0, np.int64)
    size = min(size, len(words))
    n = len(words) - size + 1
    shingles = np.full(n, size, np.uint64)
    for at in range(size):
        shingles = mixed(shingles * np.uint64(0x9E3779B97F4A7C15) + words[at:at + n])
    return np.unique(shingles >> np.uint64(1)).astype(np.int64)


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def signatures(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, text, n, class, sketch); the class is a digest of the whole set, null without shingles, ``text`` a hash."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("near-duplicates")
        for batch in batches:
            sets = [shingle_set(text, size) for text in raw_texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([s[:KEPT] for s in sets], pa.list_(pa.int64())),
            ], ["doc_id", "text", "n", "class", "sketch"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    return rows.mapInArrow(sketch, "doc_id bigint, text bigint, n bigint, class binary, sketch array<bigint>")


def _postings(classes: DataFrame, n: int) -> DataFrame:
    return classes.select("key", F.explode(F.slice("sketch", 1, n)).alias("value"))


def _list_pairs(postings: DataFrame, held: DataFrame, least: int = SHARED) -> DataFrame:
    """Pairs that share at least so many lists of at most ``HOT`` members."""
    short = held.where(F.col("held").between(2, HOT)).select("value")
    lists = postings.join(short, "value").groupBy("value").agg(F.array_sort(F.collect_list("key")).alias("members"))
    heads = lists.select("members", F.posexplode("members").alias("at", "a"))
    pairs = heads.select("a", F.explode(F.slice("members", F.col("at") + 2, F.lit(HOT))).alias("b")).where("a != b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= least).select("a", "b")


def _cold_enough() -> Column:
    """A whole set of n values lacks at most 0.2 n of its own in a partner; of a sketch see ``COLD``."""
    return F.col("cold") >= F.when(F.col("n") <= KEPT, F.col("n") * (100 - SIMILAR) / 100 + SHARED).otherwise(COLD)


def _sketch_matrix(column: pa.ListArray, filler: int) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    matrix = np.full((len(sizes), KEPT), filler, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    matrix[row, at] = column.values.to_numpy()[offsets[0]:offsets[-1]]
    return matrix


def estimates(mine: pa.ListArray, theirs: pa.ListArray) -> np.ndarray:
    """Share of common values among the smallest ``KEPT`` of the union."""
    top = np.iinfo(np.int64).max
    both = np.sort(np.concatenate([_sketch_matrix(mine, top), _sketch_matrix(theirs, top - 1)], 1), 1)
    common = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] < top - 1)
    rank = np.cumsum(np.concatenate([np.ones((len(both), 1), bool), both[:, 1:] != both[:, :-1]], 1), 1)
    union = np.where(both < top - 1, rank, 0).max(1, initial=0)
    kept = np.maximum(np.minimum(union, KEPT), 1)
    return (common & (rank[:, 1:] <= kept[:, None])).sum(1) / kept


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that sizes and the sketch of the union leave over, stored."""
    sizes = classes.select("key", "n")
    for side in ("a", "b"):
        pairs = pairs.join(sizes.toDF(side, f"n_{side}"), side)
    pairs = pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILAR).select("a", "b")
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("key").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(estimates(batch.column(2), batch.column(3)) >= LEAST_ESTIMATE)
            yield batch.select(["a", "b"]).filter(keep)

    rows = pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(likely, "a bigint, b bigint")
    return materialize(rows, "likely-pairs")


def _full_sets(wanted: DataFrame, documents: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(key, rep, shingles) of the wanted classes, stored."""
    named = wanted.distinct().join(classes, "key").select("key", "class", "rep")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, size) for text in raw_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["class", "shingles"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("rep"), "text").join(named.select("rep").distinct(), "rep", "left_semi")
    sets = texts.select("text").mapInArrow(full, "class binary, shingles binary").dropDuplicates(["class"])
    return materialize(sets.join(named, "class").select("key", "rep", "shingles"), "full-sets")


def _confirmed(likely: DataFrame, sets: DataFrame) -> DataFrame:
    """Stored links (a, b, rep_a, rep_b) whose full sets are similar enough."""
    for side in ("a", "b"):
        likely = likely.join(sets.select(F.col("key").alias(side), F.col("shingles").alias(f"set_{side}"), F.col("rep").alias(f"rep_{side}")), side)

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for mine, theirs in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                one, two = np.frombuffer(mine, np.int64), np.frombuffer(theirs, np.int64)
                common = len(one) + len(two) - len(np.union1d(one, two))
                keep.append(100 * common >= SIMILAR * (len(one) + len(two) - common))
            yield batch.select(["a", "b", "rep_a", "rep_b"]).filter(pa.array(keep, pa.bool_()))

    links = likely.select("a", "b", "rep_a", "rep_b", "set_a", "set_b").mapInArrow(similar, "a bigint, b bigint, rep_a bigint, rep_b bigint")
    return materialize(links, "links")


def overlaps(mine: list[np.ndarray], theirs: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of incidence matrices over a slice of the values at a time."""
    owner = np.repeat(np.arange(len(mine) + len(theirs)), [len(s) for s in (*mine, *theirs)])
    values, column, held = np.unique(np.concatenate([*mine, *theirs]), return_inverse=True, return_counts=True)
    used = held[column] > 1
    owner, column = owner[used], column[used]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    fresh = np.concatenate(([0], np.cumsum(np.diff(column) > 0))) if len(column) else column
    result = np.zeros((len(mine), len(theirs)), np.float32)
    for first in range(0, int(fresh[-1]) + 1 if len(fresh) else 0, BLOCK_VALUES):
        a, b = np.searchsorted(fresh, [first, first + BLOCK_VALUES])
        part = np.zeros((len(mine) + len(theirs), BLOCK_VALUES), np.float32)
        part[owner[a:b], fresh[a:b] - first] = 1
        result += part[:len(mine)] @ part[len(mine):].T
    return result.astype(np.int64)


def _compared(table: pa.Table) -> pa.Table:
    """A link for each member that is apart and each other component that it reaches in this block."""
    sets = [np.frombuffer(s, np.int64) for s in table.column("shingles").to_pylist()]
    apart = table.column("apart").to_numpy()
    component, rep = table.column("component").to_numpy(), table.column("rep").to_numpy()
    mine, theirs = np.flatnonzero(apart), np.flatnonzero(~apart)
    found: list[tuple[int, int]] = []
    if len(mine) and len(theirs):
        common = overlaps([sets[i] for i in mine], [sets[i] for i in theirs])
        sizes = np.array([len(s) for s in sets])
        union = sizes[mine][:, None] + sizes[theirs][None, :] - common
        near = (100 * common >= SIMILAR * union) & (component[mine][:, None] != component[theirs][None, :])
        one, two = np.nonzero(near)
        _, each = np.unique(np.stack([one, component[theirs][two]]), axis=1, return_index=True)
        found = list(zip(rep[mine][one[each]].tolist(), rep[theirs][two[each]].tolist(), strict=True))
    return pa.table({"rep_a": pa.array([a for a, _ in found], pa.int64()), "rep_b": pa.array([b for _, b in found], pa.int64())})


def ranked(sets: DataFrame, size: Column) -> DataFrame:
    """Stored (key, n, own, value, held): the first values of each set, from rare to common, that another set may share.

    ``own`` is how many of its ``n`` values the set has for itself, and ``held`` how many sets have the value. Sets
    with a similarity of ``SIMILAR`` percent share one of the first ``n - ceil(n SIMILAR / 100) + 1`` in one common order.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(data, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), key)), pa.array(values)], ["key", "value"])

    values = sets.select("key", "shingles").mapInArrow(each, "key bigint, value bigint")
    counts = values.groupBy("value").agg(F.count("*").alias("held")).where("held > 1")
    shared = values.join(materialize(counts, "shared-shingles"), "value").join(sets.select("key", size.alias("n")), "key")
    by_key = Window.partitionBy("key")
    own = F.col("n") - F.count("*").over(by_key)
    first = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1
    place = F.row_number().over(by_key.orderBy("held", "value"))
    rows = shared.select("key", "n", own.alias("own"), "value", "held", place.alias("place"))
    return materialize(rows.where(F.col("own") + F.col("place") <= first).drop("place"), "first-shingles")


def _still_apart(members: DataFrame, pivots: DataFrame, links: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (rep_a, rep_b) of members that no link has brought to the component of their group's pivot."""
    joined = components(links.select("rep_a", "rep_b").toDF("a", "b"))
    held = members.join(pivots, "value").groupBy("key", "pivot").agg(F.count("*").alias("values"))
    by_key = Window.partitionBy("key")
    aside = F.sum("values").over(by_key.orderBy("values", "pivot").rowsBetween(Window.unboundedPreceding, 0))
    kept = held.withColumn("aside", aside).withColumn("all", F.sum("values").over(by_key))
    groups = kept.where(F.col("aside") > F.floor(F.col("all") * ASIDE / KEPT)).select("key", "pivot")
    named = sets.select("key", "rep", F.length("shingles").alias("bytes")).join(joined, F.col("rep") == F.col("node"), "left")
    named = named.select("key", "bytes", F.coalesce("component", "rep").alias("component"))
    rows = groups.join(named, "key").join(named.select(F.col("key").alias("pivot"), F.col("component").alias("main")), "pivot")
    rows = materialize(rows.withColumn("apart", F.col("component") != F.col("main")), "groups")
    open_groups = rows.where("apart").select("pivot").distinct()
    rows = rows.join(open_groups, "pivot", "left_semi")
    keys = rows.groupBy("key").agg(F.first("component").alias("component"), F.max("apart").alias("apart"))
    first = ranked(sets.join(keys.select("key"), "key", "left_semi"), (F.length("shingles") / 8).cast("bigint"))
    lists = first.groupBy("value").agg(F.count("*").alias("held"))
    near = _list_pairs(first.select("key", "value"), lists, 1)
    for side in ("a", "b"):
        near = near.join(keys.select(F.col("key").alias(side), F.col("component").alias(f"c_{side}"), F.col("apart").alias(f"apart_{side}")), side)
    near = near.where("c_a != c_b and (apart_a or apart_b)").select("a", "b")
    found = _confirmed(_likely(near, classes), sets).select("rep_a", "rep_b")
    common = lists.where(F.col("held") > HOT).select("value")
    # Of n values a ninth may be a set's own if it is the smaller one of a pair.
    least = 2 * F.col("n") * SIMILAR <= (F.col("n") - F.col("own")) * (100 + SIMILAR)
    deep = first.join(common, "value", "left_semi").groupBy("key").agg(F.first(least).alias("shares"))
    return found.union(_block_links(rows.join(deep, "key"), sets))


def _block_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the rows that are apart with all others of their group, or with those that share most values."""
    rows = rows.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("kind")).where("kind or shares or apart")
    mine = F.col("apart") & (F.col("shares") == F.col("kind"))
    rows = rows.select("pivot", "kind", "key", "bytes", "component", mine.alias("apart"), (F.col("kind") | F.col("shares")).alias("other"))
    rows = materialize(rows.where("apart or other"), "common-groups")

    def blocks(which: Column) -> Column:
        most = F.greatest(F.count(F.when(which, 1)) / BLOCK_ROWS, F.sum(F.when(which, F.col("bytes"))) / BLOCK_BYTES)
        return F.greatest(F.lit(1), F.ceil(most)).cast("int")

    counted = rows.groupBy("pivot", "kind").agg(
        F.count(F.when(F.col("apart"), 1)).alias("n_apart"), blocks(F.col("apart")).alias("mine"), blocks(F.col("other")).alias("theirs")
    ).where("n_apart > 0").drop("n_apart")
    rows = rows.join(counted, ["pivot", "kind"])
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = rows.where("apart").select("pivot", "kind", own("mine").alias("mine"), every("theirs").alias("theirs"), "key", "component", F.lit(True).alias("apart"))
    two = rows.where("other").select("pivot", "kind", every("mine").alias("mine"), own("theirs").alias("theirs"), "key", "component", F.lit(False).alias("apart"))
    pairs = one.unionByName(two).join(sets, "key")
    return materialize(pairs.groupBy("pivot", "kind", "mine", "theirs").applyInArrow(_compared, "rep_a bigint, rep_b bigint").distinct(), "late-links")


def links_of(documents: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Confirmed links (rep_a, rep_b) between classes; enough to join all that belong together."""
    first = _postings(classes, FIRST)
    held = first.groupBy("value").agg(F.count("*").alias("held"))
    shared = materialize(held.where("held > 1"), "shared-values")
    pairs = _list_pairs(first, shared)
    hot = shared.where(F.col("held") > HOT)
    if hot.isEmpty():
        likely = _likely(pairs, classes)
        sets = _full_sets(likely.select(F.explode(F.array("a", "b")).alias("key")), documents, classes, size)
        return _confirmed(likely, sets).select("rep_a", "rep_b")

    again = first.join(hot, "value", "left_semi").select("key").distinct()
    every = materialize(_postings(classes.join(again, "key", "left_semi"), KEPT), "hot-postings")
    counts = materialize(every.groupBy("value").agg(F.count("*").alias("held")), "hot-values")
    cold = F.count(F.when(F.col("held") <= HOT, 1))
    # How widely a class's values are held: near copies of a text hold it more than each other.
    kinds = every.join(counts, "value").groupBy("key").agg(cold.alias("cold"), F.sum("held").alias("spread"))
    kinds = kinds.join(classes.select("key", "n"), "key")
    mostly = materialize(kinds.where(~_cold_enough()).select("key", "spread"), "mostly-hot")
    widely = counts.where(F.col("held") > HOT).select("value")
    values = classes.join(mostly, "key").select("key", "spread", F.explode(F.slice("sketch", 1, KEPT)).alias("value"))
    members = materialize(values.join(widely, "value"), "hot-members")
    top = F.max(F.struct("spread", "key"))
    pivots = materialize(members.groupBy("value").agg(top.alias("top")).select("value", F.col("top.key").alias("pivot")), "pivots")
    to_pivot = members.join(pivots, "value").select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).where("a != b")
    likely = _likely(pairs.union(_list_pairs(every, counts)).union(to_pivot).distinct(), classes)
    wanted = likely.select(F.explode(F.array("a", "b")).alias("key")).union(mostly.select("key"))
    sets = _full_sets(wanted, documents, classes, size)
    links = _confirmed(likely, sets).select("rep_a", "rep_b")
    return links.union(_still_apart(members, pivots, links, sets, classes))


def memberships(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, text, n_shingles, component_id, kept) of every document row; ``text`` is a hash."""
    python_tasks(documents.sparkSession)
    signed = materialize(signatures(documents, size), "sketches")
    known = signed.where("class is not null and doc_id is not null")
    same = known.groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # Pairs carry a short key; should two classes get the same one, both are compared.
    classes = materialize(same.withColumn("key", F.xxhash64("class")), "classes")
    links = links_of(documents, classes, size)
    # An id that represents two classes joins them: it is one document.
    joined = components(links.toDF("a", "b"))
    final = classes.join(joined, F.col("rep") == F.col("node"), "left").select(
        "class", F.coalesce("component", "rep").alias("component_id")
    )
    rows = signed.select("doc_id", "text", "n", "class").join(final, "class", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select(
        "doc_id", "text", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def near_duplicates(documents: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document row."""
    return memberships(documents, size).drop("text")


def one_of_each(documents: DataFrame, size: int = 5) -> DataFrame:
    """The documents that stay, with all their columns. A row goes by its id and text: other texts of its id may stay."""
    own = own_prefix(documents)
    gone = memberships(documents, size).where("not kept").select("doc_id", "text").distinct().toDF(f"{own}id", f"{own}text")
    same = (F.col("doc_id").cast("long") == F.col(f"{own}id")) & (F.xxhash64("text") == F.col(f"{own}text"))
    return documents.join(gone, same, "left_anti").select(*columns_of(documents))


#: Four-word shingles; every pair of sets that share one is compared, and all that a set reaches is listed.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS s FROM d),
docs AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN sha256(array_to_string(s, chr(10))) END AS class, s FROM sets),
classes AS (SELECT class, min(doc_id) AS rep, any_value(n) AS n, any_value(s) AS s FROM docs WHERE class IS NOT NULL GROUP BY class),
held AS (SELECT rep, n, unnest(s) AS v FROM classes),
pairs AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS common, any_value(a.n + b.n) AS n
  FROM held a JOIN held b ON a.v = b.v AND a.rep < b.rep GROUP BY a.rep, b.rep),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT rep AS node, rep AS root FROM classes UNION SELECT b, root FROM reached JOIN ways ON node = a),
lowest AS (SELECT node, min(root) AS component FROM reached GROUP BY node)
SELECT doc_id, docs.n AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM docs LEFT JOIN classes USING (class) LEFT JOIN lowest ON node = rep
"""
