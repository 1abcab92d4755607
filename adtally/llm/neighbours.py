"""Nearest neighbours by inner product: vantage-point trees per shard, searched by blocks of queries.

Vectors are parted into bands of nearly equal length and each band has a tree over their directions, so
that the lengths take no part in the distances and one long vector does not move the others. A vector
``x`` beats the k-th score ``s`` of a query ``q`` only if the cosine of their angle is ``s / (|q| |x|)``
or more. A node knows the longest and the shortest of its vectors, which gives the least cosine and so
the largest distance of directions that still counts; where the cosine would have to exceed one, the
node is left out, which is exact. A node splits its vectors at the median distance from one of them; a
search goes to the nearer half first and to the other one only if the least distance that the triangle
inequality allows is within ``factor`` times that largest distance. Factor 1 is exact; less prunes more.
Bands are searched from the longest vectors down, and all queries of a block walk the trees together.

Vectors are dealt to shards by number, never by value, so that many equal vectors do not meet in one
shard; a shard and a block of queries have a bounded size. The trees of a shard are built once and stored
with it, and no shard is copied: a task holds one and reads the stored blocks of queries one after the other. Blocks
are stored with a limit for each query, its k-th score in one shard, below which no other shard needs to look.
Every block gets its nearest in every shard, and the best of all shards remain. Candidates that the matrix product finds near the
limit are scored anew by a running sum in the order of the components, so that equal vectors tie.

Null or zero vectors and those with a null or non-finite component take no part, nor do rows with a
null id; vectors of different lengths are never compared. A repeated row is a candidate as often as it
occurs, and for its twins too. An empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import python_tasks
from adtally.session import materialize

NEAREST, EVERY = 20, 20
#: Measured with equal and unequal lengths (see README): uniform directions, the hardest case for pruning.
FACTOR = 0.2
#: Vectors of a band are at least this share of the band's longest.
BAND = 0.9
SHARD_ROWS, SHARD_BYTES, BLOCK, LEAF = 8192, 64 << 20, 2048, 256
CLOSE = 1e-9


@dataclass
class Node:
    """A leaf has members; an inner node a vantage point, its halves and their distance from it."""

    members: np.ndarray
    longest: float
    shortest: float
    vantage: np.ndarray | None = None
    inner: Node | None = None
    outer: Node | None = None
    inner_most: float = 0.0
    outer_least: float = 0.0
    middle: float = 0.0


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths; scaled first, so that no square is lost or overflows."""
    largest = np.abs(vectors).max(1, initial=0.0)
    scaled = vectors / largest[:, None]
    lengths = np.sqrt((scaled ** 2).sum(1))
    return scaled / lengths[:, None], largest * lengths


def bands(lengths: np.ndarray) -> list[np.ndarray]:
    """Members of every band, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    falling, found, start = -lengths[order], [], 0
    while start < len(order):
        end = max(start + 1, int(np.searchsorted(falling, BAND * falling[start], side="right")))
        found.append(order[start:end])
        start = end
    return found


def build(points: np.ndarray, lengths: np.ndarray, members: np.ndarray, rng: np.random.Generator) -> Node:
    node = Node(members, float(lengths[members].max()), float(lengths[members].min()))
    if len(members) <= LEAF:
        return node
    node.vantage = points[members[rng.integers(len(members))]]
    distance = np.sqrt(((points[members] - node.vantage) ** 2).sum(1))
    half = len(members) // 2
    order = np.argpartition(distance, half)
    inner, outer = order[:half], order[half:]
    node.inner, node.outer = build(points, lengths, members[inner], rng), build(points, lengths, members[outer], rng)
    node.inner_most, node.outer_least, node.middle = float(distance[inner].max()), float(distance[outer].min()), float(np.median(distance))
    return node


@dataclass
class Shard:
    """Vectors with their trees, one per band of lengths, those of the longest first."""

    vectors: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    trees: list[Node]

    @classmethod
    def of(cls, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> Shard:
        points, lengths = directions(vectors)
        rng = np.random.default_rng(11)
        return cls(vectors, ids, rows, [build(points, lengths, members, rng) for members in bands(lengths)])


@dataclass
class Block:
    """Queries, and for each a score that its nearest reach."""

    queries: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    least: np.ndarray


class Search:
    """The nearest of one shard to one block of queries."""

    def __init__(self, shard: Shard, block: Block, k: int, factor: float):
        self.vectors, self.ids, self.rows, self.trees = shard.vectors, shard.ids, shard.rows, shard.trees
        self.queries, self.own, self.least, self.k, self.factor = block.queries, block.rows, block.least, k, factor
        queries = block.queries
        self.asked, self.reach = directions(queries)
        # The k best so far of every query, best first.
        self.score = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1)
        self.visited = 0

    def run(self) -> None:
        for tree in self.trees:
            self.visit(tree, np.arange(len(self.queries)))

    def kth(self, some: np.ndarray) -> np.ndarray:
        """The score that a candidate must reach."""
        return np.maximum(self.score[some, -1], self.least[some])

    def cosine(self, node: Node, some: np.ndarray) -> np.ndarray:
        """The least cosine with which a vector of the node reaches the k-th score, less a slack for rounding."""
        score = self.kth(some) / self.reach[some]
        return np.where(score > 0, score / node.longest, score / node.shortest) * (1 - CLOSE) - CLOSE

    def limit(self, node: Node, some: np.ndarray) -> np.ndarray:
        """The distance of directions within which the triangle inequality must leave a node to be visited."""
        return self.factor * np.sqrt(2 - 2 * np.clip(self.cosine(node, some), -1, 1)) + CLOSE

    def visit(self, node: Node, some: np.ndarray) -> None:
        some = some[~(self.cosine(node, some) > 1)]
        if not len(some):
            return
        if node.vantage is None:
            self.compare(node.members, some)
            return
        distance = np.sqrt(((self.asked[some] - node.vantage) ** 2).sum(1))
        near = distance < node.middle
        self.visit(node.inner, some[near])
        self.visit(node.outer, some[~near])
        self.visit(node.outer, some[near & (node.outer_least - distance <= self.limit(node.outer, some))])
        self.visit(node.inner, some[~near & (distance - node.inner_most <= self.limit(node.inner, some))])

    def compare(self, members: np.ndarray, some: np.ndarray) -> None:
        self.visited += len(members) * len(some)
        product = self.queries[some] @ self.vectors[members].T
        close = product >= (self.kth(some) - CLOSE * np.maximum(1, np.abs(product).max(1)))[:, None]
        close &= self.rows[members][None, :] != self.own[some][:, None]
        one, two = np.nonzero(close)
        if not len(one):
            return
        exact = (self.queries[some[one]] * self.vectors[members[two]]).cumsum(1)[:, -1]
        touched = np.unique(one)
        held = self.found[some[touched]] >= 0
        query = np.concatenate([one, np.repeat(touched, self.k)[held.ravel()]])
        score = np.concatenate([exact, self.score[some[touched]][held]])
        which = np.concatenate([members[two], self.found[some[touched]][held]])
        order = np.lexsort((self.rows[which], self.ids[which], -score, query))
        query, score, which = query[order], score[order], which[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        top = rank < self.k
        self.score[some[query[top]], rank[top]] = score[top]
        self.found[some[query[top]], rank[top]] = which[top]


def usable(embeddings: DataFrame) -> DataFrame:
    """Stored (row, vec_id, dim, vector) of the vectors that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", vector.alias("vector")).where("vec_id is not null and vector is not null")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(sound & F.exists("vector", lambda x: x != 0))
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("vector").alias("dim"), "vector"), "vectors")


def nearest_of(shard: Shard, block: Block, k: int, factor: float) -> pa.RecordBatch:
    found = Search(shard, block, k, factor)
    found.run()
    query, place = np.nonzero(found.found >= 0)
    which = found.found[query, place]
    columns = [block.rows[query], block.ids[query], shard.rows[which], shard.ids[which], found.score[query, place]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_row", "query_id", "row", "vec_id", "score"])


def stored_rows(files: list[str]) -> Iterator[tuple]:
    """The rows of stored Parquet files, one at a time."""
    for file in files:
        store, path = pa.fs.FileSystem.from_uri(file)
        with store.open_input_file(path) as data:
            for batch in pq.ParquetFile(data).iter_batches(batch_size=1):
                yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def nearest(embeddings: DataFrame, is_query: Column, k: int = NEAREST, factor: float = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of every query row, its own left out."""
    python_tasks(embeddings.sparkSession)
    rows = usable(embeddings).withColumn("query", is_query)
    width = F.greatest(F.lit(1), F.least(F.lit(SHARD_ROWS), F.floor(F.lit(SHARD_BYTES) / (8 * F.col("dim")))))
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(F.col("query"), 1)).alias("q"))
    counts = counts.where("q > 0").select(
        "dim", F.ceil(F.col("n") / width).cast("int").alias("shards"), F.ceil(F.col("q") / BLOCK).cast("int").alias("blocks")
    )
    sized = rows.join(counts, "dim")
    own = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    sized = sized.withColumn("vec_id", F.col("vec_id").cast("long"))

    def arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        return vectors, table.column("vec_id").to_numpy(), table.column("row").to_numpy()

    def stored(key: tuple, value: Shard | Block) -> pa.Table:
        dim, number = (pa.array([part.as_py()], pa.int32()) for part in key)
        return pa.table({"dim": dim, "number": number, "data": pa.array([pickle.dumps(value)], pa.binary())})

    def planted(key: tuple, table: pa.Table) -> pa.Table:
        return stored(key, Shard.of(*arrays(table)))

    kind = "dim int, number int, data binary"
    dealt = sized.select("dim", own("shards").alias("shard"), "row", "vec_id", "vector")
    shards = materialize(dealt.groupBy("dim", "shard").applyInArrow(planted, kind), "shards")
    first = materialize(shards.where("number = 0"), "first-shards").inputFiles()

    def limited(key: tuple, table: pa.Table) -> pa.Table:
        queries, ids, rows = arrays(table)
        block = Block(queries, ids, rows, np.full(len(ids), -np.inf))
        for dim, number, data in stored_rows(first):
            if (dim, number) == (key[0].as_py(), 0):
                found = Search(pickle.loads(data), block, k, factor)
                found.run()
                block.least = found.score[:, -1]
        return stored(key, block)

    asked = sized.where("query").select("dim", own("blocks").alias("block"), "row", "vec_id", "vector")
    blocks = materialize(asked.groupBy("dim", "block").applyInArrow(limited, kind), "query-blocks").inputFiles()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                shard = pickle.loads(data)
                for other, _, queries in stored_rows(blocks):
                    if other == dim:
                        yield nearest_of(shard, pickle.loads(queries), k, factor)

    # A task per shard: small in bytes, they are large in work.
    tasks = max(1, shards.count())
    found = shards.repartition(tasks, "dim", "number").mapInArrow(
        search, "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def neighbour_report(embeddings: DataFrame) -> DataFrame:
    """The nearest of every row whose id is divisible by ``EVERY``."""
    return nearest(embeddings, F.col("vec_id") % EVERY == 0)
