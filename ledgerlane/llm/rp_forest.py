"""Largest inner products: a forest of random-projection trees searched through one priority queue."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import stored

# Distinct vectors the trees are grown on, at most; every row is indexed.
FIT_ROWS = 65_536
TREES = 16
LEAF_ROWS = 256
# Leaves a query opens, as a share of all leaves of the forest. Neighbours of near isotropic vectors lie in a
# share of the leaves, not in a number of them, so recall holds while the index grows.
OPEN_SHARE = 0.1
# Index rows, and queries, that one task compares with one another; queries it holds scores of at once.
BLOCK_ROWS = 16_384
STEP_QUERIES = 256
# Candidates kept above k, since block products may round otherwise than the exact sum.
SPARE = 12

KEY = ("k1", "k2")


@dataclass
class Forest:
    """Flat trees: node i sends x right if x @ normal[i] > offset[i]; children below 0 are leaves."""

    normal: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray
    norm: float

    @property
    def leaves(self) -> int:
        return len(self.sizes)

    @property
    def width(self) -> int:
        return self.normal.shape[1] - 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """One more coordinate gives all rows one length, so largest product is least angle."""
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree: rows x trees."""
        x = self.lifted(x)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.broadcast_to(np.arange(len(x))[:, None], at.shape)
        while (inner := at >= 0).any():
            nodes, rows = at[inner], row[inner]
            side = np.einsum("ij,ij->i", x[rows], self.normal[nodes]) > self.offset[nodes]
            at[inner] = np.where(side, self.right[nodes], self.left[nodes])
        return -1 - at

    @cached_property
    def levels(self) -> list[np.ndarray]:
        """Inner nodes of all trees by depth."""
        out, level = [], np.unique(self.roots[self.roots >= 0])
        while len(level):
            out.append(level)
            below = np.concatenate([self.left[level], self.right[level]])
            level = below[below >= 0]
        return out

    def open(self, x: np.ndarray, leaves: int) -> np.ndarray:
        """Which leaves each query opens: queries x leaves.

        A node's priority is the least margin on its path: how deep the query lies on that side. It never
        rises towards the leaves, so one queue over all trees yields leaves in order of their own
        priorities, and the first `leaves` of them are found for a block of queries at once.
        """
        x = np.hstack([x, np.zeros((len(x), 1))])
        # Offsets belong to rows of full length, so the query is set to that length.
        scale = np.linalg.norm(x, axis=1)[:, None] / max(self.norm, 1e-300)
        margins = x / scale @ self.normal.T - self.offset
        worst = np.full((len(x), len(self.left)), -np.inf)
        of_leaf = np.full((len(x), self.leaves), -np.inf)
        for level in self.levels:
            for side, sign in ((self.left, 1), (self.right, -1)):
                value = np.maximum(worst[:, level], sign * margins[:, level])
                child = side[level]
                inner = child >= 0
                worst[:, child[inner]] = value[:, inner]
                of_leaf[:, -1 - child[~inner]] = value[:, ~inner]
        opened = np.zeros(of_leaf.shape, bool)
        np.put_along_axis(opened, np.argpartition(of_leaf, leaves - 1, axis=1)[:, :leaves], True, axis=1)
        return opened


def grow(sample: np.ndarray, norm: float, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 7) -> Forest:
    """Trees over the sample: each node splits at the median along the line through two of its rows."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1] + 1
    forest = Forest(np.zeros((0, width)), np.zeros(0), np.zeros(0, int), np.zeros(0, int),
                    np.zeros(0, int), np.zeros(0, int), norm)
    x = forest.lifted(sample)
    normal, offset, left, right, sizes, roots = [], [], [], [], [], []

    def split(rows: np.ndarray) -> int:
        if len(rows) > leaf_rows:
            a, b = x[rng.choice(rows, 2, replace=False)]
            line = a - b
            along = x[rows] @ line
            middle = float(np.median(along))
            goes = along > middle
            if goes.any() and not goes.all():
                length = np.linalg.norm(line)
                node = len(normal)
                normal.append(line / length)
                offset.append(middle / length)
                left.append(0)
                right.append(0)
                left[node] = split(rows[~goes])
                right[node] = split(rows[goes])
                return node
        sizes.append(len(rows))
        return -len(sizes)

    for _ in range(trees):
        roots.append(split(np.arange(len(x))))
    return Forest(np.array(normal).reshape(-1, width), np.array(offset), np.array(left, int),
                  np.array(right, int), np.array(roots, int), np.array(sizes, int), norm)


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


_ITEM_SQL = "k1 long, k2 int, vector array<double>, leaves array<int>"
_QUERY_SQL = "k1 long, k2 int, vector array<double>, opened binary"


def _placed(forest: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each index row once, with its leaf in every tree."""
    for batch in batches:
        leaves = forest.route(_matrix(batch.column("vector"), forest.width)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*KEY, "vector")), pa.array(list(leaves), pa.list_(pa.int32()))],
            names=[*KEY, "vector", "leaves"],
        )


def _asked(forest: Forest, leaves: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each query once, with one bit for each leaf of the forest."""
    for batch in batches:
        x = _matrix(batch.column("vector"), forest.width)
        opened = [row.tobytes() for first in range(0, len(x), STEP_QUERIES)
                  for row in np.packbits(forest.open(x[first : first + STEP_QUERIES], leaves), axis=1)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*KEY, "vector")), pa.array(opened, pa.binary())],
            names=[*KEY, "vector", "opened"],
        )


_PAIRS = "q1 long, q2 int, k1 long, k2 int, near double"


def _compared(width: int, n_leaves: int, keep: int, queries: pa.Table, items: pa.Table) -> pa.Table:
    """Best items of each query in a block: products with all rows of a leaf that it opens, each pair once."""
    query, item, near = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
    if len(queries) and len(items):
        x = _matrix(items.column("vector"), width)
        leaves = np.array(items.column("leaves").to_pylist(), np.int32)
        asked = _matrix(queries.column("vector"), width)
        bits = np.frombuffer(b"".join(queries.column("opened").to_pylist()), np.uint8).reshape(len(queries), -1)
        for first in range(0, len(asked), STEP_QUERIES):
            opened = np.unpackbits(bits[first : first + STEP_QUERIES], axis=1, count=n_leaves).astype(bool)
            met = np.zeros((len(opened), len(x)), bool)
            for tree in range(leaves.shape[1]):
                met |= opened[:, leaves[:, tree]]
            scores = np.where(met, asked[first : first + STEP_QUERIES] @ x.T, -np.inf)
            best = np.argpartition(-scores, keep - 1, axis=1)[:, :keep] if keep < len(x) else np.broadcast_to(
                np.arange(len(x)), scores.shape)
            found = np.take_along_axis(scores, best, axis=1)
            row, place = np.nonzero(found > -np.inf)
            query.append(first + row)
            item.append(best[row, place])
            near.append(found[row, place])
    query, item = np.concatenate(query), np.concatenate(item)
    q1, q2 = (queries.column(k).to_numpy()[query] for k in KEY)
    k1, k2 = (items.column(k).to_numpy()[item] for k in KEY)
    return pa.table([pa.array(v) for v in (q1, q2, k1, k2, np.concatenate(near))], names=["q1", "q2", *KEY, "near"])


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, p: s + p
    )


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, vector) that can take part: ids, finite components, not all zero."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return rows.filter(
        F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)
    ).distinct()


def search(vectors: DataFrame, is_query: Column, k: int = 20, seed: int = 7) -> DataFrame:
    """Each query's k nearest found by inner product: query_id, rank, vec_id, score.

    Equal vectors form a class that is indexed once with its k + 1 least ids (no more can be
    answers), so copies are no hot leaf. Trees grow on at most FIT_ROWS classes in the order of
    their hash; every class is then routed into every tree. A query class opens one share of all leaves, at every
    size, through one queue over all trees; whatever lies in them is compared exactly, blocks of at most about
    BLOCK_ROWS classes and queries at a time, each pair once. Scores are double sums of the original components in
    their order; ties go to the smaller vec_id; a query's own id is no candidate. With fewer candidates
    than k, all that were found are returned; up to LEAF_ROWS classes lie in one leaf, and all are
    (recall: see README). Of vectors of different lengths the shorter count as filled up with zeros. Rows that
    cannot take part (see `usable`) are neither queries nor candidates. An empty table gives no rows; other
    columns are ignored.
    """
    rows = stored(
        usable(vectors).withColumns({"k1": F.xxhash64("vector"), "k2": F.hash("vector")}), "vectors"
    )
    first = Window.partitionBy(*KEY).orderBy("vec_id")
    items = stored(
        rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min_by("vector", "vec_id").alias("vector")),
        "classes",
    )
    seen = items.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
        F.max(F.sqrt(_product(F.col("vector"), F.col("vector")))).alias("norm"),
    ).first()
    width = seen["width"] or 0
    sample = items.orderBy(*KEY).limit(FIT_ROWS).select("vector").toArrow().column("vector")
    forest = grow(_matrix(sample, width) if width else np.zeros((0, 1)), seen["norm"] or 0.0, seed=seed)

    asked = rows.filter(is_query)
    queries = stored(asked.select(*KEY).distinct().join(items.select(*KEY, "vector"), [*KEY]), "queries")
    item_blocks = max(1, -(-seen["n"] // BLOCK_ROWS))
    query_blocks = max(1, -(-queries.count() // BLOCK_ROWS))

    def block(of: int) -> Column:
        return F.pmod(F.xxhash64(*KEY), F.lit(of)).cast("int")

    def every(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    opened = max(1, math.ceil(OPEN_SHARE * forest.leaves))
    placed_queries = (
        queries.select(*KEY, "vector").mapInArrow(partial(_asked, forest, opened), _QUERY_SQL)
        .withColumn("query_block", block(query_blocks)).withColumn("item_block", every(item_blocks))
    )
    placed_items = (
        items.select(*KEY, "vector").mapInArrow(partial(_placed, forest), _ITEM_SQL)
        .withColumn("item_block", block(item_blocks)).withColumn("query_block", every(query_blocks))
    )
    both = ("query_block", "item_block")
    pairs = placed_queries.groupBy(*both).cogroup(placed_items.groupBy(*both)).applyInArrow(
        partial(_compared, forest.width, forest.leaves, k + 1 + SPARE), _PAIRS
    )

    best = Window.partitionBy("q1", "q2").orderBy(F.desc("near"), "k1", "k2")
    pairs = pairs.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1 + SPARE)
    asked_vectors = queries.select(
        F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("vector").alias("query_vector")
    )
    answers = (
        pairs.join(items, [*KEY]).join(asked_vectors, ["q1", "q2"])
        .select("q1", "q2", F.struct(_product(F.col("query_vector"), F.col("vector")).alias("score"),
                                     F.col("ids").alias("ids")).alias("answer"))
        .groupBy("q1", "q2").agg(F.collect_list("answer").alias("answers"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select(F.col("vec_id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2"))
        .join(answers, ["q1", "q2"])
        .select("query_id", F.explode("answers").alias("a"))
        .select("query_id", F.col("a.score").alias("score"), F.explode("a.ids").alias("vec_id"))
        .filter(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
