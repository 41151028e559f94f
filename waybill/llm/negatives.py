"""Hard negatives by an exact search of a multiway hyperplane tree with range tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.sources.sinks import scratch_folder, staged

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between so many hundredths of its positive's and the whole of it.
LOW, HIGH = 80, 100
#: Rows drawn to choose split points, children of a split, and drawn rows a leaf has at most.
SAMPLE, ARITY, LEAF = 4096, 16, 64
#: Anchors that one pass searches for: their vectors and results so far go to every task.
ANCHORS = 8192
#: Scores a task holds at once.
CELLS = 1 << 21
#: Distances are kept apart by so much of the largest norm more than rounding can shift them.
SLACK = 1e-6
#: From this norm on, scores are Python's whole numbers. Bounds beyond any score of either kind.
HUGE = 2.0**53
TOP, HUGE_TOP = 1 << 62, 1 << 4096
_DECIMAL = pa.decimal128(38, 0)


# -- vectors ------------------------------------------------------------------------------


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, point): rows with an id, a label and a finite vector; components scaled.

    A component x becomes floor(256 * x). A label is moved on by one, modulo ten, where the id
    is divisible by seven. Fully equal rows count once.
    """
    double = F.transform("embedding", lambda x: x.cast("double"))
    scaled = F.transform("v", lambda x: x * 256.0)
    finite = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), double.alias("v"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").filter(finite)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # From 2**52 on a double is whole already, and may be more than a long can hold.
    floor = F.transform(scaled, lambda y: F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y))
    return rows.dropDuplicates().select("vec_id", moved.alias("label"), floor.alias("point"))


def _columns(table: pa.RecordBatch | pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, ids and labels of a table of one chunk."""
    column = table.column("point")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return points(column, width), table.column("vec_id").to_numpy(), table.column("label").to_numpy()


def points(column: pa.Array, width: int) -> np.ndarray:
    """Arrays of numbers as a matrix; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows: 64-bit, or Python's where those overflow."""
    most = a.shape[1] * np.abs(a).max(initial=0) * np.abs(x).max(initial=0)
    if most < 2.0**53:
        return (a @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(a).dot(whole(x).T)


def as_floats(scores: np.ndarray) -> np.ndarray:
    """Whole numbers of any size as doubles; those beyond are infinite."""
    if scores.dtype != object:
        return scores.astype(float)
    largest = int(np.finfo(float).max)
    signed = [float(v) if abs(v) <= largest else float("inf") * (1 if v > 0 else -1) for v in scores.ravel()]
    return np.array(signed).reshape(scores.shape)


# -- the tree -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Split points of all nodes, and where each child leads.

    Points are seen on a sphere of radius ``reach``: one more component fills each norm up, so
    inner products with an anchor, which has none of it, fall as distances grow. ``children``
    of a node are nodes, or leaves as -1 - leaf. ``low`` and ``high`` hold, for each node, the
    distances from each split point to the rows below each child.
    """

    reach: float
    splits: list[np.ndarray]
    children: list[list[int]]
    leaves: int
    low: np.ndarray
    high: np.ndarray

    def filled(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.reach**2 - (x * x).sum(1), 0.0))

    def distances(self, node: int, x: np.ndarray, fill: np.ndarray) -> np.ndarray:
        """From every row to the node's split points, which lie on the sphere."""
        p = self.splits[node]
        squares = (x * x).sum(1) + fill * fill
        near = squares[:, None] + self.reach**2 - 2 * (x @ p.T + np.outer(fill, self.filled(p)))
        return np.sqrt(np.maximum(near, 0.0))

    def descend(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The leaf of each row, and the range tables of these rows alone."""
        low, high = np.full_like(self.low, np.inf), np.full_like(self.high, -np.inf)
        leaf, fill = np.zeros(len(x), np.int32), self.filled(x)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            far = self.distances(node, x[rows], fill[rows])
            nearest = far.argmin(1)
            for j, child in enumerate(self.children[node]):
                mine = nearest == j
                if not mine.any():
                    continue
                k = far.shape[1]
                low[node, :k, j], high[node, :k, j] = far[mine].min(0), far[mine].max(0)
                if child < 0:
                    leaf[rows[mine]] = -1 - child
                else:
                    waiting.append((child, rows[mine]))
        return leaf, low, high

    def surviving(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """For each anchor and leaf, whether scores from ``least`` to ``most`` may lie in it.

        Scores between the two lie in an annulus around the anchor. A sibling goes if, for some
        split point, its range of distances misses all that the triangle inequality allows.
        """
        squares = (anchors * anchors).sum(1) + self.reach**2
        inner = np.sqrt(np.maximum(squares - 2 * most, 0.0)) - SLACK * self.reach
        outer = np.sqrt(np.maximum(squares - 2 * least, 0.0)) + SLACK * self.reach
        alive = np.zeros((len(anchors), self.leaves), bool)
        waiting = [(0, np.arange(len(anchors)))]
        while waiting:
            node, rows = waiting.pop()
            far = self.distances(node, anchors[rows], np.zeros(len(rows)))
            k = far.shape[1]
            for j, child in enumerate(self.children[node]):
                below = np.maximum(far - outer[rows, None], inner[rows, None] - far)
                beyond = (self.high[node, :k, j] < below) | (self.low[node, :k, j] > far + outer[rows, None])
                some = rows[~beyond.any(1)]
                if not len(some):
                    continue
                if child < 0:
                    alive[some, -1 - child] = True
                else:
                    waiting.append((child, some))
        return alive


def spread_points(x: np.ndarray, fill: np.ndarray, k: int) -> np.ndarray:
    """Rows chosen one after another, each the farthest from those before it."""
    full = np.column_stack([x, fill])
    chosen, nearest = [0], ((full - full[0]) ** 2).sum(1)
    while len(chosen) < min(k, len(x)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((full - full[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def grown(sample: np.ndarray, reach: float, *, arity: int = ARITY, leaf: int = LEAF) -> Tree:
    """A tree over the drawn rows; its range tables are still empty."""
    splits: list[np.ndarray] = []
    children: list[list[int]] = []
    tree = Tree(reach, splits, children, 1, np.zeros((0, 0, 0)), np.zeros((0, 0, 0)))
    leaves = 0
    waiting = [(None, 0, sample)]
    while waiting:
        parent, j, x = waiting.pop(0)
        node = len(splits)
        if parent is not None:
            children[parent][j] = node
        fill = tree.filled(x)
        splits.append(x[spread_points(x, fill, arity)])
        children.append([])
        nearest = tree.distances(node, x, fill).argmin(1)
        for j in range(len(splits[node])):
            mine = x[nearest == j]
            if len(mine) > leaf and len(mine) < len(x):
                children[node].append(node)
                waiting.append((node, j, mine))
            else:
                children[node].append(-1 - leaves)
                leaves += 1
    shape = (len(splits), arity, arity)
    return replace(tree, leaves=leaves, low=np.full(shape, np.inf), high=np.full(shape, -np.inf))


def indexed(rows: DataFrame, tree: Tree, width: int, scratch: str) -> tuple[DataFrame, Tree]:
    """Every row with its leaf, sorted by it into written files, and the tree with its ranges.

    The ranges are joined from one table a task; a leaf of any size spreads over many files.
    """
    leafed = "vec_id long, label long, point array<double>, leaf int"

    def descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, _, _ = tree.descend(points(batch.column("point"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = tree.low.copy(), tree.high.copy()
        for batch in batches:
            _, a, b = tree.descend(points(batch.column("point"), width))
            low, high = np.minimum(low, a), np.maximum(high, b)
        at = np.flatnonzero(low.ravel() <= high.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(low.ravel()[at]), pa.array(high.ravel()[at])], names=["at", "low", "high"])

    placed = rows.mapInArrow(descend, leafed).repartitionByRange("leaf", "vec_id").sortWithinPartitions("leaf", "vec_id")
    placed = staged(placed, scratch, "leaves")
    found = placed.select("point").mapInArrow(ranges, "at long, low double, high double")
    met = found.groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    low, high = tree.low.copy(), tree.high.copy()
    at = met.column("at").to_numpy()
    low.ravel()[at], high.ravel()[at] = met.column("low").to_numpy(), met.column("high").to_numpy()
    return placed, replace(tree, low=low, high=high)


# -- the search ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Search:
    """Anchors of one pass and, for each, the windows of scores that are asked for.

    ``least`` and ``most`` (anchors x windows) bound the scores; ``same`` says whether rows of
    the anchor's label are wanted or all others; the best ``k`` of each window are kept.
    """

    tree: Tree
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    least: np.ndarray
    most: np.ndarray
    same: bool
    k: int

    def alive(self) -> np.ndarray:
        """For each anchor and leaf, whether any of the anchor's windows may have rows there."""
        out = np.zeros((len(self.ids), self.tree.leaves), bool)
        for w in range(self.least.shape[1]):
            some = np.flatnonzero(self.least[:, w] <= self.most[:, w])
            bounds = (as_floats(x[some, w]) for x in (self.least, self.most))
            out[some] |= self.tree.surviving(self.vectors[some], *bounds)
        return out

    def bounded(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Search:
        """The same search; where ``k`` of the given rows lie in a window, they raise its least score."""
        best = _Best(self.least.copy(), self.k)
        self._leaf(np.arange(len(self.ids)), x, ids, labels, best)
        return replace(self, least=best.least)

    def run(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alive, width = self.alive(), self.vectors.shape[1]
        best = _Best(self.least.copy(), self.k)
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            x, ids, labels = _columns(batch, width)
            cuts = np.flatnonzero(np.diff(leaf)) + 1
            for rows in np.split(np.arange(len(leaf)), cuts):
                if len(rows):
                    self._leaf(np.flatnonzero(alive[:, leaf[rows[0]]]), x[rows], ids[rows], labels[rows], best)
        yield best.table()

    def _leaf(self, anchors: np.ndarray, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, best: _Best) -> None:
        step = max(1, CELLS // len(x))
        for at in range(0, len(anchors), step):
            mine = anchors[at : at + step]
            scores = products(self.vectors[mine], x)
            match = (self.labels[mine, None] == labels) == self.same
            if self.same:
                match &= self.ids[mine, None] != ids
            for w in range(self.least.shape[1]):
                fits = match & (scores >= best.least[mine, w, None]) & (scores <= self.most[mine, w, None])
                a, b = np.nonzero(fits)
                best.add(mine[a], w, ids[b], scores[a, b])


class _Best:
    """The best rows of each anchor's windows so far; a full window raises its bound."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least, k
        self.kept = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, least.dtype)] for _ in range(least.shape[1])]

    def add(self, anchor: np.ndarray, window: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(anchor):
            return
        a, i, s = (np.concatenate(x) for x in zip(self.kept[window], (anchor, ids, scores.astype(self.least.dtype)), strict=True))
        order = np.lexsort((i, -s, a))
        a, i, s = a[order], i[order], s[order]
        first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        nth = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
        last = nth == self.k - 1
        self.least[a[last], window] = np.maximum(self.least[a[last], window], s[last])
        keep = nth < self.k
        self.kept[window] = [a[keep], i[keep], s[keep]]

    def table(self) -> pa.RecordBatch:
        a, i, s = (np.concatenate(x) for x in zip(*self.kept, strict=True))
        w = np.repeat(np.arange(len(self.kept)), [len(k[0]) for k in self.kept])
        score = pa.array([Decimal(v) for v in s], _DECIMAL) if s.dtype == object else pa.array(s).cast(_DECIMAL)
        columns = [pa.array(a, pa.int64()), pa.array(w, pa.int32()), pa.array(i, pa.int64()), score]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "window", "vec_id", "score"])


def _searched(leaves: DataFrame, search: Search) -> DataFrame:
    """(anchor, window, vec_id, score, rank) of the best rows of every window."""
    found = leaves.mapInArrow(search.run, "anchor long, window int, vec_id long, score decimal(38,0)")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= search.k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES, scratch: str | None = None
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor (rows where ``anchor``, an expression of vec_id, holds) and each of its best
    ``positives`` rows of the same label, the best ``negatives`` rows of other labels whose score
    is ``LOW`` to ``HIGH`` hundredths of the positive's. Scores are inner products of the scaled
    vectors; ties go to the smaller vec_id. A negative positive's score leaves no such row.

    The tree's split points come from ``SAMPLE`` rows; all rows are put into its leaves and
    make its ranges. Anchors are searched for in blocks of ``ANCHORS``, each against all rows:
    a block's vectors go to every task, tasks skip the leaves that the ranges rule out and return
    a few rows for each window. The scores of the drawn rows give each search its first bounds.

    Rows with a null id, label or vector or a component that is null or not finite (scaled, too)
    take no part; fully equal rows count once, and rows that share an id otherwise are rows of
    their own, which are no positives of each other. Shorter vectors count as ending in zeros.
    Scores up to 10**38 are compared exactly; those that no long holds are returned as the
    nearest. No rows or no anchors give no rows.
    """
    spark = vectors.sparkSession
    scratch = scratch or scratch_folder(spark)
    rows = staged(usable_vectors(vectors), scratch, "usable")
    norm = F.aggregate("point", F.lit(0.0), lambda total, x: total + x * x)
    facts = rows.agg(F.max(F.size("point")).alias("width"), F.max(norm).alias("norm")).first()
    result = f"{scratch}/negatives"
    spark.createDataFrame([], _NEGATIVES).write.parquet(result)
    width = max(facts["width"] or 0, 1)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "point").limit(SAMPLE)
    sample = _columns(drawn.toArrow(), width)
    if not len(sample[0]):
        return spark.read.schema(_NEGATIVES).parquet(result)
    reach = float(np.sqrt(facts["norm"])) or 1.0
    leaves, tree = indexed(rows, grown(sample[0], reach), width, scratch)
    top, kind = (HUGE_TOP, object) if facts["norm"] >= HUGE else (TOP, np.int64)

    anchors = rows.filter(anchor)
    blocks = -(-anchors.count() // ANCHORS)
    block = F.pmod(F.xxhash64("vec_id", "label", "point"), F.lit(max(blocks, 1))).alias("block")
    anchors = staged(anchors.select("*", block), scratch, "anchors")
    for number in range(blocks):
        x, ids, labels = _columns(anchors.filter(F.col("block") == number).toArrow(), width)
        if not len(ids):
            continue
        all_scores = np.full((len(ids), 1), top, kind)
        near = Search(tree, ids, labels, x, -all_scores, all_scores, True, positives).bounded(*sample)
        met = _searched(leaves, near).toArrow()
        at = met.column("anchor").to_numpy(), met.column("rank").to_numpy() - 1
        score, positive = np.full((len(ids), positives), -1, kind), np.zeros((len(ids), positives), np.int64)
        score[at], positive[at] = [int(v) for v in met.column("score").to_pylist()], met.column("vec_id").to_numpy()
        # A window without a positive, or below zero, is empty: its least is above its most.
        least, most = np.where(score >= 0, -(-LOW * score // HIGH), top), np.where(score >= 0, score, -top)
        far = Search(tree, ids, labels, x, least, most, False, negatives).bounded(*sample)
        where = np.nonzero(score >= 0)
        pairs = pa.table({
            "anchor": where[0], "window": where[1].astype(np.int32), "anchor_id": ids[where[0]], "positive_id": positive[where],
            "positive_score": pa.array([Decimal(int(v)) for v in score[where]], _DECIMAL),
        })
        part = _searched(leaves, far).join(spark.createDataFrame(pairs), ["anchor", "window"])
        longs = (
            F.greatest(F.least(c, F.lit((1 << 63) - 1)), F.lit(-(1 << 63))).cast("long") for c in ("positive_score", "score")
        )
        names = "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id")
        part.select(*names, *(c.alias(n) for c, n in zip(longs, ("positive_score", "negative_score")))).write.mode("append").parquet(result)
    return spark.read.schema(_NEGATIVES).parquet(result)


_NEGATIVES = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """``hard_negatives`` of whole ``embeddings`` for every row whose id is divisible by 100."""
    return hard_negatives(spark.read.parquet(f"{folder}/embeddings.parquet"), F.expr("vec_id % 100 = 0"))


# Every anchor's inner product with every row.
OP12_SQL = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
    CAST(list_sum([a.v[i] * x.v[i] for i in range(1, least(len(a.v), len(x.v)) + 1)]) AS BIGINT) AS score
  FROM good a, good x WHERE a.vec_id % 100 = 0 AND x.vec_id <> a.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER nearest AS INTEGER) AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW nearest AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER nearest <= 5
"""
