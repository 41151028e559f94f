"""Quality classifier: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import mapped, per_batch, values
from waybill.sources.sinks import scratch_folder, staged

FEATURES = 256
GAMMA = 0.5
RIDGE = 1.0
FOLDS = 4
ACCEPT = 0.7
#: Features and targets are rounded to this step, so that sums of products are exact in
#: double precision and do not depend on the order of rows, up to 2**29 of them.
STEP = 2.0**-12
#: Width of the bins in which raw scores are counted for the calibration.
BIN = 1 / 512
LOW, HIGH = -1.0, 2.0

_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A),
    "space": (0x20, 0x09, 0x0B, 0x0C, 0x0D), "line": (0x0A,), "symbol": b"#*$%&|<>@^~=_+\\/{}[]",
    "stop": b".,;:?", "shout": b"!", "beyond": range(0x80, 0x100),
}
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _TABLE[list(_members), _i] = 1


def statistics(raw: bytes | None) -> list[float]:
    """What is measured of a whole text, each value of about unit scale; all 0 if blank."""
    raw = raw or b""
    tokens = raw.split()
    n, size = len(tokens), len(raw)
    if not n:
        return [0.0] * N_STATISTICS
    histogram = np.zeros(256)
    for at in range(0, size, 1 << 20):
        histogram += np.bincount(np.frombuffer(raw, np.uint8, min(1 << 20, size - at), at), minlength=256)
    shares = histogram @ _TABLE / size
    p = histogram[histogram > 0] / size
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    distinct = len(set(tokens))
    repeats = sum(map(bytes.__eq__, tokens, tokens[1:])) / n
    pairs = len(set(zip(tokens, tokens[1:]))) / max(1, n - 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    line_sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    return [
        log1p(n) / 4, float(lengths.mean()) / 8, float(lengths.std()) / 8, log(distinct) / log(n + 1),
        distinct / n, repeats * 4, pairs * 2, float(-(p * np.log2(p)).sum()) / 2,
        2 * len(set(lines)) / len(lines), log1p(float(line_sizes.mean())) / 3, log1p(len(lines)) / 3,
        *np.sqrt(shares).tolist(),
        float((lengths <= 3).mean()) * 2, float((lengths > 15).mean()) * 4,
    ]


N_STATISTICS = 0
N_STATISTICS = len(statistics(b"some words"))


@dataclass(frozen=True)
class Model:
    center: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray  # one column per fold left out, then of all
    levels: np.ndarray  # calibrated value of each bin

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos((x - self.center) / self.scale @ self.frequencies + self.phases)
        return np.round(np.column_stack([z, np.ones(len(z))]) / STEP) * STEP


def bins(raw: np.ndarray) -> np.ndarray:
    return ((np.clip(raw, LOW, HIGH) - LOW) / BIN).astype(np.int64)


def isotonic(n: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Pooled adjacent violators over bins; empty bins lie on the line between their neighbours."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(n):
        blocks.append([positive[i], n[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a, b = blocks[-2:]
            blocks[-2:] = [[a[0] + b[0], a[1] + b[1], a[2], b[3]]]
    if not blocks:
        return np.full(len(n), 0.5)
    at = np.array([x for b in blocks for x in b[2:]])
    level = np.repeat([b[0] / b[1] for b in blocks], 2)
    return np.interp(np.arange(len(n)), at, level)


def measured(docs: DataFrame, scratch: str) -> DataFrame:
    """(doc_id, stats) of every row, written once; whole texts are read only here."""

    def run(batch):
        return zip(batch.column("doc_id").to_pylist(), map(statistics, values(batch)))

    types = {"doc_id": pa.int64(), "stats": pa.list_(pa.float64())}
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(mapped(narrow, per_batch(run, types), "doc_id long, stats array<double>"), scratch, "statistics")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, N_STATISTICS)


def _totals(rows: DataFrame, model: Model) -> dict[int, np.ndarray]:
    """By fold, the sums of z z' and z y: a matrix per task, added up in two steps."""
    size = FEATURES + 1

    def part(batches: Iterable[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z, fold = model.features(_matrix(batch)), batch.column("fold").to_numpy()
            y = np.round(batch.column("target").to_numpy() / STEP) * STEP
            for k in np.unique(fold):
                zk = z[fold == k]
                new = np.column_stack([zk.T @ zk, zk.T @ y[fold == k]])
                sums[k] = sums.get(k, 0) + new
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(k) for k in sums]), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                names=["fold", "sums"],
            )

    def add(batches: Iterable[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("fold").to_pylist(), batch.column("sums"), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw.as_py())
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fold", "sums"]
            )

    schema = "fold long, sums binary"
    summed = rows.select("stats", "fold", "target").mapInArrow(part, schema)
    few = summed.repartition(FOLDS, "fold").mapInArrow(add, schema)
    out: dict[int, np.ndarray] = {}
    for row in few.collect():
        total = np.frombuffer(row["sums"]).reshape(size, size + 1)
        out[row["fold"]] = out.get(row["fold"], 0) + total
    return out


def _solve(total: np.ndarray, ridge: float) -> np.ndarray:
    gram = total[:, :-1] + ridge * np.eye(len(total))
    return np.linalg.solve(gram, total[:, -1])


def fit(rows: DataFrame, *, gamma: float = GAMMA, ridge: float = RIDGE, seed: int = 7) -> Model:
    """From (stats, target, fold). Nothing but sums over all rows reaches the driver.

    Each fold is calibrated by weights that were fitted without it, since scores of rows
    that took part in the fit are too sure. No rows give a model that answers 0.5.
    """
    at = [F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(N_STATISTICS)]
    at += [F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(N_STATISTICS)]
    scaled = rows.agg(*at).first()
    moments = np.array([0.0 if v is None else v for v in scaled]).round(9)
    center, spread = moments[:N_STATISTICS], moments[N_STATISTICS:]
    draw = np.random.default_rng(seed)
    width = np.sqrt(2 * gamma / N_STATISTICS)
    model = Model(
        center, np.maximum(spread, 0.05), draw.normal(scale=width, size=(N_STATISTICS, FEATURES)),
        draw.uniform(0, 2 * np.pi, FEATURES), np.zeros((FEATURES + 1, FOLDS + 1)), np.zeros(0),
    )
    totals = _totals(rows, model)
    n_bins = int((HIGH - LOW) / BIN) + 1
    if not totals:
        return Model(*list(model.__dict__.values())[:5], np.full(n_bins, 0.5))
    every = sum(totals.values())
    weights = np.column_stack([_solve(every - totals.get(k, 0), ridge) for k in range(FOLDS)] + [_solve(every, ridge)])
    model = Model(*list(model.__dict__.values())[:4], weights, model.levels)

    def unseen(batches: Iterable[pa.RecordBatch]):
        n, positive = np.zeros(n_bins), np.zeros(n_bins)
        for batch in batches:
            raw = model.features(_matrix(batch)) @ weights
            at = bins(raw[np.arange(len(raw)), batch.column("fold").to_numpy()])
            n += np.bincount(at, minlength=n_bins)
            positive += np.bincount(at, batch.column("target").to_numpy(), minlength=n_bins)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([found, n[found], positive[found]], names=["bin", "n", "positive"])

    counted = rows.select("stats", "fold", "target").mapInArrow(unseen, "bin long, n double, positive double")
    table = counted.groupBy("bin").agg(F.sum("n"), F.sum("positive")).collect()
    n, positive = np.zeros(n_bins), np.zeros(n_bins)
    for at, count, good in table:
        n[at], positive[at] = count, round(good, 6)
    return Model(*list(model.__dict__.values())[:5], isotonic(n, positive))


def scored(stats: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            raw = model.features(_matrix(batch)) @ model.weights[:, -1]
            at = (np.clip(raw, LOW, HIGH) - LOW) / BIN
            score = np.interp(at - 0.5, np.arange(len(model.levels)), model.levels)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")


def crc_part(key: Column, n: int) -> Column:
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def classify(docs: DataFrame, labels: DataFrame, *, accept: float = ACCEPT, scratch: str | None = None) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs``, learned from ``labels`` (doc_id, quality).

    Scores lie in 0 to 1 and come from statistics of the whole text alone. A null or blank
    text has its own statistics (all 0) and a score like any other. Several labels of one id
    count as their mean; null labels and ids are left out of the fit, and rows that repeat an
    id are each scored. Without any usable label every score is 0.5.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    stats = measured(docs, scratch)
    marked = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.avg("quality").alias("target")
    )
    marked = marked.select(F.col("doc_id").cast("long").alias("doc_id"), "target")
    fold = crc_part(F.concat_ws("/", F.lit("fold"), "doc_id"), FOLDS).cast("long").alias("fold")
    rows = staged(stats.join(marked, "doc_id").select("stats", "target", fold), scratch, "labelled")
    found = scored(stats, fit(rows))
    return found.withColumn("predicted", (F.col("score") >= accept).cast("int"))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held_out = crc_part(F.col("doc_id"), 4) == 2
    found = classify(docs, labels.filter(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")
