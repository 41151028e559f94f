"""Approximate nearest neighbours on shifted Hilbert curves."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.common import numbered
from waybill.sources.sinks import scratch_folder, staged

CURVES = 24
#: So many bits tell near copies apart as far as single precision does.
DIMENSIONS, BITS = 8, 24
#: A query sees at least so many rows on either side of each curve, and so many times the
#: square root of the number of distinct vectors.
REACH, GROWTH = 1024, 8
#: Scores that a block holds at once, and how far rounding may part equal ones.
CELLS, ROUNDING = 1 << 22, 1e-12


def _transposed(points: np.ndarray, bits: int) -> np.ndarray:
    """Integer points (0 to 2**bits - 1 a side) by the bits of their places on the Hilbert curve.

    Gray-code steps from the highest bit down undo each cell's rotation and reflection;
    the transposed bits, read across the axes, are the place.
    """
    x = points.astype(np.int64).copy()
    n, axes = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(axes):
            set_ = (x[:, i] & q) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[:, -1] & q, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    return x


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points on the Hilbert curve, up to 63 bits in all."""
    x = _transposed(points, bits)
    place = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(x.shape[1]):
            place = place << 1 | x[:, i] >> b & 1
    return place


def places(points: np.ndarray, bits: int) -> np.ndarray:
    """The same places with any number of bits, a row of bytes each, highest first."""
    x = _transposed(points, bits)
    down = np.arange(bits - 1, -1, -1)[None, :, None]
    return np.packbits((x[:, None, :] >> down & 1).astype(np.uint8).reshape(len(x), -1), axis=1)


def reach_of(n: int) -> int:
    """Rows that a query sees on either side of each curve among ``n`` distinct vectors."""
    return max(REACH, math.ceil(GROWTH * math.sqrt(n)))


def _curve(width: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """The projection and the shift of a curve, the same wherever they are made."""
    draw = np.random.default_rng([width, curve])
    axes = min(DIMENSIONS, width)
    return np.linalg.qr(draw.normal(size=(width, axes)))[0], draw.random(axes)


def _distinct(vectors: DataFrame, keep: int) -> DataFrame:
    """(embedding, ids): each usable vector once, with the least ``keep`` of its ids.

    The window's limit is applied before the shuffle too, so a vector that a third of all
    rows share sends a few rows from each task.
    """
    double = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = vectors.select("vec_id", double.alias("embedding")).filter("embedding IS NOT NULL AND vec_id IS NOT NULL")
    some = some.filter(usable & F.exists("embedding", lambda x: x != 0)).withColumn("hash", F.xxhash64("embedding"))
    nth = F.dense_rank().over(Window.partitionBy("hash", "embedding").orderBy("vec_id"))
    few = some.withColumn("nth", nth).filter(F.col("nth") <= keep)
    return few.groupBy("hash", "embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _place(x: np.ndarray, curve: int) -> np.ndarray:
    """Places of unit vectors on a curve."""
    width = x.shape[1]
    projection, shift = _curve(width, curve)
    # Projections spread by about 1 / sqrt(width): three of these fill half the cube.
    y = (x @ projection) * np.sqrt(width) / 7 + 0.5 + (shift - 0.5) / 7
    return places(np.clip(y * (1 << BITS), 0, (1 << BITS) - 1), BITS)


def _on_curves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            lengths = part.column("embedding").value_lengths().to_numpy()
            flat = part.column("embedding").flatten().to_numpy()
            starts = np.concatenate(([0], np.cumsum(lengths)))
            for width in np.unique(lengths):
                rows = np.flatnonzero(lengths == width)
                x = _unit(flat[(starts[rows][:, None] + np.arange(width)).ravel()].reshape(len(rows), width))
                keys, wanted = part.column("rep").take(pa.array(rows)), part.column("asked").take(pa.array(rows))
                n = len(rows)
                for curve in range(CURVES):
                    place = pa.array([p.tobytes() for p in _place(x, curve)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, width, np.int32)), pa.array(np.full(n, curve, np.int32)), place, keys, wanted],
                        names=["width", "curve", "place", "rep", "asked"],
                    )


def _best(block: pa.Table, k: int) -> pa.Table:
    """(query, rep): the ``k`` rows of a block nearest to each of its probes, ties to the smaller id."""
    probe, reps = block.column("probe").to_numpy(), block.column("rep").to_numpy()
    flat = pa.concat_arrays([c.flatten() for c in block.column("embedding").chunks]).to_numpy()
    x = _unit(flat.reshape(len(reps), -1).astype(np.float64))
    others, own, probes, ids = x[~probe], reps[~probe], x[probe], reps[probe]
    take = min(k, len(own))
    query, found = [ids[:0]], [own[:0]]
    step = max(1, CELLS // max(len(own), 1))
    for at in range(0, len(ids) if take else 0, step):
        score = probes[at : at + step] @ others.T
        score[ids[at : at + step, None] == own[None, :]] = -np.inf
        least = np.partition(score, len(own) - take, axis=1)[:, len(own) - take]
        for i in range(len(score)):
            top = np.flatnonzero(score[i] >= least[i] - ROUNDING)
            sure = score[i][top] > least[i] + ROUNDING
            top = np.concatenate((top[sure], top[~sure][np.argsort(own[top[~sure]])][: take - sure.sum()]))
            query.append(np.repeat(ids[at + i], len(top)))
            found.append(own[top])
    return pa.table({"query": np.concatenate(query), "rep": np.concatenate(found)})


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, *, reach: int | None = None, scratch: str | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found by cosine for rows where ``queries``.

    Every distinct vector is placed on ``CURVES`` Hilbert curves, each through another random
    projection and shifted by a random part of the cube. A curve is range-sorted and cut into
    blocks of twice ``reach`` rows; a query is compared with its own block and, by copying
    the query alone, with the nearer neighbouring one. A block scores all its rows in double
    precision on the original vectors; the ``k`` best of each curve are merged and scored once
    more. ``reach`` follows the number of distinct vectors unless it is given (``reach_of``):
    the work per query grows with the root of the table, so that recall falls slowly on
    vectors without structure. Places are fine enough to sort near copies too, and equal places are ordered by a
    hash that differs by curve, so that each curve shows a query other rows of a dense group.
    Only places are sorted; the vectors travel once, to the blocks.

    Equal vectors are searched once; their least ids stand for them, which is enough for any
    answer, so groups of copies are neither compared nor expanded. Vectors that are null,
    zero or hold null or non-finite components take no part, nor do null ids. Only vectors of
    equal length are compared; components of any magnitude, tiny and huge ones included. Ties go to the smaller id. With fewer candidates there are
    fewer ranks; rows that repeat an id and vector count once, and no vectors give no rows.
    """
    scratch = scratch or scratch_folder(vectors.sparkSession)
    usable = _distinct(vectors, k + 1)
    groups = usable.select(F.col("ids")[0].alias("rep"), "ids", "embedding", "hash")
    groups = staged(groups, scratch, "vectors")
    reach = reach or reach_of(groups.count())
    doubled = F.transform("embedding", lambda x: x.cast("double"))
    members = vectors.filter(queries).select("vec_id", doubled.alias("embedding")).withColumn("hash", F.xxhash64("embedding"))
    members = members.join(groups.select("rep", "hash", "embedding"), ["hash", "embedding"])
    members = staged(members.select(F.col("vec_id").alias("query_id"), "rep").distinct(), scratch, "queries")
    asked = members.select("rep").distinct().withColumn("asked", F.lit(True))
    flagged = groups.join(asked, "rep", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    placed = flagged.select("rep", "asked", "embedding").mapInArrow(
        _on_curves, "width int, curve int, place binary, rep long, asked boolean"
    )
    placed = staged(placed, scratch, "curves").withColumn("tie", F.xxhash64("curve", "rep"))
    ranked = numbered(placed, ["width", "curve"], ["place", "tie", "rep"], scratch, "sorted")
    block = F.floor(F.col("rank") / (2 * reach))
    nearer = F.when(F.col("rank") % (2 * reach) < reach, block - 1).otherwise(block + 1)
    spot = lambda at, probe: F.struct(at.alias("block"), F.lit(probe).alias("probe"))
    spots = F.when(F.col("asked"), F.array(spot(block, False), spot(block, True), spot(nearer, True)))
    spots = F.inline(spots.otherwise(F.array(spot(block, False))))
    # Single-precision input is sent as such: the doubles made of it hold no more.
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    sent = groups.select("rep", F.col("embedding").cast("array<float>" if single else "array<double>"))
    rows = ranked.select("width", "curve", "rep", spots).join(sent, "rep")

    def best(table: pa.Table) -> pa.Table:
        return _best(table, k)

    near = rows.groupBy("width", "curve", "block").applyInArrow(best, "query long, rep long")
    near = near.distinct().filter("query <> rep")
    itself = asked.select(F.col("rep").alias("query"), "rep")
    pairs = staged(near.unionByName(itself).distinct(), scratch, "pairs")
    # Powers of two, in two steps, bring the largest component near 1: no digit changes and no
    # product leaves a double's range.
    most = F.array_max(F.transform("embedding", F.abs))
    even = groups.withColumn("half", F.floor(F.log2(most) / 2)).withColumn("rest", F.floor(F.log2(most)) - F.col("half"))
    once, again = (F.pow(F.lit(2.0), -F.col(c).cast("double")) for c in ("half", "rest"))
    even = even.withColumns({"once": once, "again": again})
    even = even.withColumn("embedding", F.transform("embedding", lambda x: x * F.col("once") * F.col("again")))
    left = even.select(F.col("rep").alias("query"), F.col("embedding").alias("a"))
    right = even.select("rep", "ids", F.col("embedding").alias("b"))
    both = pairs.join(left, "query").join(right, "rep")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    cosine = dot("a", "b") / (F.sqrt(dot("a", "a")) * F.sqrt(dot("b", "b")))
    scored = both.select("query", F.explode("ids").alias("vec_id"), cosine.alias("score"))
    found = members.withColumnRenamed("rep", "query").join(scored, "query").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest found for every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 50 == 0)
