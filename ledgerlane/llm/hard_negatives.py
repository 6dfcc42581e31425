"""Hard negatives by integer inner product, from R-trees packed by sort and tile.

Vectors are cut into tiles along the two coordinates that spread most; each tile is packed as one tree
whose boxes (least and greatest value of every coordinate) bound the inner product with an anchor
coordinate by coordinate. A queue opens boxes by their greatest possible score; boxes outside an anchor's
score window, or whose bound is strictly below the k-th score found, stay closed. Two rounds: first each
anchor's positives, then the negatives in the window that each positive's score opens.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import stored

# Vectors that a tile holds, about, and anchors that are searched for together.
TILE_ROWS = 16_384
ANCHOR_ROWS = 32_768
# Cuts between tiles are taken from at most this many vectors, with this many to a tile at least.
FIT_ROWS = 16_384
FIT_LEAST = 16
# Vectors in a leaf, children of a box, and coordinates that a tile is sorted by, one after the other.
LEAF_ROWS = 256
FANOUT = 8
SORTED_BY = 3


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
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


# --- The tree ------------------------------------------------------------------------------------


def packed_order(x: np.ndarray, leaf_rows: int = LEAF_ROWS) -> np.ndarray:
    """Sort-tile-recursive order: slabs of equal counts along one coordinate, each cut along the next."""
    by = np.argsort(-x.std(axis=0), kind="stable")[:SORTED_BY] if len(x) else np.zeros(0, int)

    def tiled(rows: np.ndarray, by: np.ndarray) -> list[np.ndarray]:
        rows = rows[np.argsort(x[rows, by[0]], kind="stable")]
        leaves = -(-len(rows) // leaf_rows)
        slabs = max(1, int(np.ceil(leaves ** (1 / len(by)))))
        if len(by) == 1 or slabs == 1:
            return [rows]
        size = -(-leaves // slabs) * leaf_rows
        return [part for k in range(0, len(rows), size) for part in tiled(rows[k : k + size], by[1:])]

    return np.concatenate(tiled(np.arange(len(x)), by)) if len(by) else np.arange(len(x))


@dataclass
class Tree:
    """Rows in packed order. Boxes are numbered level by level, leaves first; the last one is the root."""

    x: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray  # first row of a leaf, first child of another box
    after: np.ndarray
    leaves: int

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with anything in each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


def grow(x: np.ndarray, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> Tree:
    """A tree over rows that stand in packed order."""
    first = np.arange(0, len(x), leaf_rows)
    after = np.append(first[1:], len(x))
    lows = [np.minimum.reduceat(x, first, axis=0)]
    highs = [np.maximum.reduceat(x, first, axis=0)]
    firsts, afters, base = [first], [after], 0
    while len(lows[-1]) > 1:
        n = len(lows[-1])
        at = np.arange(0, n, fanout)
        lows.append(np.minimum.reduceat(lows[-1], at, axis=0))
        highs.append(np.maximum.reduceat(highs[-1], at, axis=0))
        firsts.append(base + at)
        afters.append(base + np.append(at[1:], n))
        base += n
    return Tree(x, np.concatenate(lows), np.concatenate(highs), np.concatenate(firsts), np.concatenate(afters),
                len(first))


class Search:
    """One anchor in one tree; scores of an opened leaf are kept for its other windows."""

    def __init__(self, tree: Tree, anchor: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.tree, self.anchor = tree, anchor
        self.least, self.most = least.tolist(), most.tolist()
        self.scores: dict[int, np.ndarray] = {}

    def best(self, k: int, allowed: np.ndarray, ids: list[list[int]], own: tuple[int, np.ndarray] | None,
             low: float = -np.inf, high: float = np.inf) -> list[tuple[float, int]]:
        """The k best (-score, id) in the window among allowed rows; ties to the smaller id."""
        tree, found = self.tree, []
        queue: list[tuple[float, int]] = []

        def offer(box: int) -> None:
            if self.most[box] >= low and self.least[box] <= high:
                heapq.heappush(queue, (-min(self.most[box], high), box))

        offer(len(tree.first) - 1)
        while queue:
            bound, box = heapq.heappop(queue)
            kth = -found[k - 1][0] if len(found) >= k else -np.inf
            if -bound < kth:
                break
            i, j = int(tree.first[box]), int(tree.after[box])
            if box >= tree.leaves:
                for child in range(i, j):
                    offer(child)
                continue
            if box not in self.scores:
                self.scores[box] = tree.x[i:j] @ self.anchor
            scores = self.scores[box]
            hits = np.flatnonzero(allowed[i:j] & (scores >= max(low, kth)) & (scores <= high))
            if not len(hits):
                continue
            # A hit is a class of equal vectors; besides the anchor's own, no more than k of the best are needed.
            if len(hits) > 2 * k:
                edge = np.partition(scores[hits], len(hits) - k - 1)[len(hits) - k - 1]
                hits = hits[scores[hits] >= edge]
            for hit in hits.tolist():
                same = own is not None and np.array_equal(tree.x[i + hit], own[1])
                found += [(-scores[hit], v) for v in ids[i + hit] if not (same and v == own[0])]
            found = sorted(found)[:k]
        return found


# --- Tiles ---------------------------------------------------------------------------------------


@dataclass
class Tiles:
    """Slabs along one coordinate, each cut along a second one; a tile of many rows has several parts."""

    width: int
    along: tuple[int, int]
    slabs: np.ndarray
    cuts: list[np.ndarray]
    numbers: np.ndarray  # first tile of each slab
    parts: np.ndarray | None = None  # how many parts each tile has
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def of(self, x: np.ndarray) -> np.ndarray:
        slab = np.searchsorted(self.slabs, x[:, self.along[0]], side="right")
        out = np.zeros(len(x), np.int64)
        for s in np.unique(slab):
            rows = slab == s
            out[rows] = self.numbers[s] + np.searchsorted(self.cuts[s], x[rows, self.along[1]], side="right")
        return out


def fit_tiles(sample: np.ndarray, rows: int, width: int) -> Tiles:
    wanted = min(-(-rows // TILE_ROWS), max(1, len(sample) // FIT_LEAST))
    if wanted <= 1:
        return Tiles(width, (0, 0), np.zeros(0), [np.zeros(0)], np.zeros(1, np.int64))
    spread = np.argsort(-sample.std(axis=0), kind="stable")
    along = int(spread[0]), int(spread[min(1, width - 1)])
    n_slabs = int(np.ceil(np.sqrt(wanted)))

    def quantiles(values: np.ndarray, n: int) -> np.ndarray:
        return np.unique(np.quantile(values, np.arange(1, n) / n)) if len(values) else np.zeros(0)

    slabs = quantiles(sample[:, along[0]], n_slabs)
    slab = np.searchsorted(slabs, sample[:, along[0]], side="right")
    cuts = [quantiles(sample[slab == s, along[1]], -(-wanted // n_slabs)) for s in range(len(slabs) + 1)]
    counts = [len(c) + 1 for c in cuts]
    return Tiles(width, along, slabs, cuts, np.cumsum([0, *counts[:-1]]))


_BOXES = pa.schema([("tile", pa.int64()), ("n", pa.int64()), ("low", pa.list_(pa.float64())),
                    ("high", pa.list_(pa.float64()))])
_BOXES_SQL = "tile long, n long, low array<double>, high array<double>"


def _boxes(tiles: Tiles, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("vector"), tiles.width)
        tile = tiles.of(x)
        names = np.unique(tile)
        yield pa.RecordBatch.from_arrays([
            pa.array(names), pa.array([int((tile == t).sum()) for t in names], pa.int64()),
            pa.array([x[tile == t].min(axis=0) for t in names], pa.list_(pa.float64())),
            pa.array([x[tile == t].max(axis=0) for t in names], pa.list_(pa.float64())),
        ], schema=_BOXES)


def _joined_boxes(table: pa.Table) -> pa.Table:
    low, high = (np.array(table.column(c).to_pylist()) for c in ("low", "high"))
    return pa.Table.from_pydict({
        "tile": table.column("tile").slice(0, 1), "n": [sum(table.column("n").to_pylist())],
        "low": [low.min(axis=0)], "high": [high.max(axis=0)],
    }, schema=_BOXES)


def _placed(tiles: Tiles, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class in its tile's part."""
    before = np.cumsum(tiles.parts) - tiles.parts
    for batch in batches:
        tile = tiles.of(matrix(batch.column("vector"), tiles.width))
        part = before[tile] + batch.column("spread").to_numpy() % tiles.parts[tile]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), *(batch.column(c) for c in ("vector", "label", "ids"))],
            names=["part", "vector", "label", "ids"],
        )


def _routed(tiles: Tiles, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each anchor with the parts of all tiles that can hold scores of one of its windows."""
    before = np.cumsum(tiles.parts) - tiles.parts
    boxes = Tree(np.zeros((0, tiles.width)), tiles.low, tiles.high, np.zeros(0), np.zeros(0), 0)
    every = [np.arange(b, b + n) for b, n in zip(before.tolist(), tiles.parts.tolist(), strict=True)]
    for batch in batches:
        windows = batch.column("windows").to_pylist()
        reach = [[]] * len(windows)
        for k in range(0, len(windows), 1024):
            least, most = boxes.bounds(matrix(batch.column("vector").slice(k, 1024), tiles.width))
            for i, (lo, hi) in enumerate(zip(least, most, strict=True), k):
                open_to = np.zeros(len(lo), bool)
                for low, high in (_edges(w) for w in windows[i]):
                    open_to |= (hi >= low) & (lo <= high)
                reach[i] = np.concatenate([every[t] for t in np.flatnonzero(open_to)] or [np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("anchor", "vec_id", "label", "vector", "windows")),
             pa.array(reach, pa.list_(pa.int64()))],
            names=["anchor", "vec_id", "label", "vector", "windows", "parts"],
        )


def _edges(window: dict) -> tuple[float, float]:
    """A window without edges holds all scores."""
    low, high = window["low"], window["high"]
    return (-np.inf if low is None else low), (np.inf if high is None else high)


_FOUND = pa.schema([("anchor", pa.int64()), ("high", pa.int64()), ("found", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "anchor long, high long, found long, score long"


def _searched(width: int, k: int, same_label: bool, anchors: pa.Table, items: pa.Table) -> pa.Table:
    out: dict[str, list] = {c: [] for c in _FOUND.names}
    if len(anchors) and len(items):
        x = matrix(items.column("vector"), width)
        order = packed_order(x)
        tree = grow(x[order])
        taken = items.take(pa.array(order))
        labels, ids = taken.column("label").to_numpy(), taken.column("ids").to_pylist()
        asked = matrix(anchors.column("vector"), width)
        described = anchors.select(["anchor", "vec_id", "label", "windows"]).to_pylist()
        by_label: dict[int, np.ndarray] = {}
        for start in range(0, len(asked), 256):
            least, most = tree.bounds(asked[start : start + 256])
            for k_row, anchor in enumerate(described[start : start + 256]):
                label = anchor["label"]
                if label not in by_label:
                    by_label[label] = (labels == label) == same_label
                own = (anchor["vec_id"], asked[start + k_row]) if same_label else None
                search = Search(tree, asked[start + k_row], least[k_row], most[k_row])
                for window in anchor["windows"]:
                    low, high = _edges(window)
                    for less, found in search.best(k, by_label[label], ids, own, low, high):
                        for name, value in zip(_FOUND.names, (anchor["anchor"], window["high"], found, -int(less)),
                                               strict=True):
                            out[name].append(value)
    return pa.Table.from_pydict(out, schema=_FOUND)


# --- Rows ----------------------------------------------------------------------------------------


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """Distinct (vec_id, label, vector) that take part, components as whole numbers floor(scale * x)."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.select("vec_id", F.col("label").cast("long").alias("label"), x.cast("array<double>").alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
        .select("vec_id", "label",
                F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("double")).alias("vector"))
        .distinct()
    )


def _search(anchors: DataFrame, classes: DataFrame, tiles: Tiles, k: int, same_label: bool) -> DataFrame:
    """(anchor, high, found, score): of each anchor and window the k best of each part, then of all."""
    n_blocks = max(1, -(-anchors.count() // ANCHOR_ROWS))
    items = classes.mapInArrow(partial(_placed, tiles), "part long, vector array<double>, label long, ids array<long>")
    items = items.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    routed = anchors.mapInArrow(
        partial(_routed, tiles),
        "anchor long, vec_id long, label long, vector array<double>, windows array<struct<low: long, high: long>>, "
        "parts array<long>",
    )
    routed = routed.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)).cast("int"))
    asked = routed.withColumn("part", F.explode("parts")).drop("parts")
    found = asked.groupBy("part", "block").cogroup(items.groupBy("part", "block")).applyInArrow(
        partial(_searched, tiles.width, k, same_label), _FOUND_SQL
    )
    order = Window.partitionBy("anchor", "high").orderBy(F.desc("score"), "found")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `vectors` has vec_id, label and embedding. Scores are inner products of floor(scale * component). An
    anchor's positives are its first other rows of its label, higher scores first, ties to the smaller
    vec_id; for each positive, the first rows of another label follow whose score lies between
    least_percent per cent of the positive's score and that score. Anchors without a positive, and positives
    without such a row (always if the score is negative), give no rows.

    Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part. Rows equal in
    vec_id, label and vector are one row; other rows that share a vec_id are rows of their own. Of vectors of
    different lengths the shorter count as filled up with zeros. Scores must be below 2**53, else the job
    stops with a ValueError. Equal vectors of one label form a class that is held once with its least ids (no more
    can be answers), so copies do not fill a tile. Other columns are ignored; an empty table gives no rows.

    Every class is compared unless a box excludes it; the work grows with anchors times classes where
    boxes exclude little, as with vectors that point everywhere.
    """
    spark = vectors.sparkSession
    rows = stored(scaled(vectors, scale), "vectors")
    kept = max(positives, negatives) + 1
    first = Window.partitionBy("vector", "label").orderBy("vec_id")
    classes = stored(
        rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= kept)
        .groupBy("vector", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("spread", F.pmod(F.xxhash64("vector", "label"), F.lit(1 << 40))),
        "classes",
    )
    seen = classes.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
        F.max(F.array_max(F.transform("vector", F.abs))).alias("largest"),
    ).first()
    width = seen["width"] or 0
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not width:
        return spark.createDataFrame([], result)
    if (seen["largest"] or 0) ** 2 * width >= 2**53:
        raise ValueError("components are too large: scores must stay below 2**53")
    sample = classes.orderBy("spread", "vector", "label").limit(FIT_ROWS).select("vector").toArrow()
    tiles = fit_tiles(matrix(sample.column("vector"), width), seen["n"], width)
    # One row for each tile; tiles are bounded by the sample.
    boxes = classes.mapInArrow(partial(_boxes, tiles), _BOXES_SQL).groupBy("tile").applyInArrow(
        lambda table: _joined_boxes(table), _BOXES_SQL).orderBy("tile").collect()
    n_tiles = int(tiles.numbers[-1]) + len(tiles.cuts[-1]) + 1
    tiles.parts, tiles.low, tiles.high = np.zeros(n_tiles, np.int64), np.zeros((n_tiles, width)), np.zeros((n_tiles, width))
    for box in boxes:
        tiles.parts[box["tile"]] = -(-box["n"] // (2 * TILE_ROWS))
        tiles.low[box["tile"]], tiles.high[box["tile"]] = box["low"], box["high"]

    asked = stored(
        rows.filter(is_anchor).select(F.monotonically_increasing_id().alias("anchor"), "vec_id", "label", "vector"),
        "anchors",
    )
    no_edge = F.lit(None).cast("long")
    everything = F.array(F.struct(no_edge.alias("low"), no_edge.alias("high")))
    best = stored(
        _search(asked.withColumn("windows", everything), classes, tiles, positives, True)
        .select("anchor", F.col("found").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # Whole scores: 100 * score >= least_percent * p from this one on.
    p = F.col("positive_score")
    low = F.expr(f"({least_percent} * positive_score + 99) div 100")
    windows = best.filter(p >= 0).groupBy("anchor").agg(
        F.collect_set(F.struct(low.alias("low"), p.alias("high"))).alias("windows")
    )
    found = _search(
        asked.join(windows, "anchor").select("anchor", "vec_id", "label", "vector", "windows"),
        classes, tiles, negatives, False,
    )
    return (
        best.join(found.withColumnRenamed("high", "positive_score"), ["anchor", "positive_score"])
        .join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("found").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"))
    )
