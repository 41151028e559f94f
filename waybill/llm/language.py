"""Language identification by string kernels, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.common import per_batch, values
from waybill.llm.quality import crc_part
from waybill.sources.sinks import scratch_folder, staged

ORDERS = (1, 2, 3)
SLOTS = 1 << 13
LANDMARKS = 96
SAMPLE = 2000
#: Hexadecimal digits of the draw by which a language's rows are counted beforehand.
DIGITS = 3
RIDGE = 0.05
UNKNOWN = "und"
_SPREAD = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def presence(raw: bytes | None, segment: int = 1 << 20) -> np.ndarray:
    """Which n-grams of 1 to 3 bytes the whole text has, hashed to ``SLOTS`` bits a length.

    Letters are lower-cased where one byte holds them; a presence says nothing of how
    often, so neither length nor repetition of a text counts.
    """
    out = np.zeros((len(ORDERS), SLOTS), bool)
    lowered = (raw or b"").lower()
    for at in range(0, len(lowered), segment):
        end = min(len(lowered), at + segment + ORDERS[-1] - 1)
        view = np.frombuffer(lowered, np.uint8, end - at, at).astype(np.uint32)
        code = np.zeros(len(view), np.uint32)
        for i, n in enumerate(ORDERS):
            code = (code[: len(view) - n + 1] << np.uint32(8)) | view[n - 1 :] if len(view) >= n else view[:0]
            out[i, (code * np.uint32(_SPREAD[i])) >> np.uint32(32 - 13)] = True
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Blended spectrum kernel: cosines of the presence vectors, averaged over the lengths."""
    total = np.zeros((len(x), len(landmarks)))
    for i in range(len(ORDERS)):
        a, b = x[:, i].astype(np.float32), landmarks[:, i].astype(np.float32)
        norms = np.sqrt(np.outer(a.sum(axis=1), b.sum(axis=1)))
        total += a @ b.T / np.maximum(norms, 1)
    return total / len(ORDERS)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # presence of each, packed
    weights: np.ndarray  # of each landmark's kernel value, then of a constant, by language

    def scores(self, x: np.ndarray) -> np.ndarray:
        return kernel(x, unpacked(self.landmarks)) @ self.weights[:-1] + self.weights[-1]


def unpacked(grams: np.ndarray) -> np.ndarray:
    return np.unpackbits(grams, axis=1).reshape(len(grams), len(ORDERS), SLOTS)


def sample(docs: DataFrame, most: int) -> DataFrame:
    """At most ``most`` documents of each language, those whose id has the least hash.

    Counts by the hash's first digits tell how far to look, so that a language of any size
    sends little more than its sample to the task that ranks it; rows meet those counts by
    language and digits, which spreads a large language too.
    """
    drawn = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    ids = docs.select("doc_id", "lang", drawn.alias("draw"), F.substring(drawn, 1, DIGITS).alias("part"))
    parts = ids.groupBy("lang", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")
    parts = parts.withColumn("before", before).filter(F.col("before") < most)
    near = ids.join(parts.select("lang", "part"), ["lang", "part"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    near = near.withColumn("nth", nth).filter(F.col("nth") <= most)
    chosen = near.select(F.col("doc_id").alias("drawn_id"), "nth")
    chosen = chosen.groupBy("drawn_id").agg(F.min("nth").alias("nth"))
    return docs.join(chosen, docs["doc_id"] == chosen["drawn_id"]).select("lang", "text", "nth")


def fit(labelled: DataFrame, scratch: str, *, most: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """From (doc_id, text, lang): at most ``most`` documents of a language.

    ``landmarks`` of each language span the Nyström space. Kernel values against them are
    made in tasks, whose normal equations are summed; the driver solves a system as large
    as the number of landmarks.
    """

    def packed(batch):
        columns = (batch.column(c).to_pylist() for c in ("lang", "nth"))
        for lang, nth, raw in zip(*columns, values(batch), strict=True):
            yield lang, nth, np.packbits(presence(raw)).tobytes()

    types = {"lang": pa.string(), "nth": pa.int32(), "grams": pa.binary()}
    drawn = sample(labelled, most).mapInArrow(per_batch(packed, types), "lang string, nth int, grams binary")
    drawn = staged(drawn, scratch, "sample")
    base = drawn.filter(F.col("nth") <= landmarks).orderBy("lang", "nth", "grams").collect()
    languages = sorted({r["lang"] for r in base})
    if not languages:
        return Model([], np.zeros((0, 0), np.uint8), np.zeros((0, 0)))
    marks = np.stack([np.frombuffer(r["grams"], np.uint8) for r in base])
    spread = unpacked(marks)
    own = kernel(spread, spread)
    value, vector = np.linalg.eigh(own)
    root = vector[:, value > 1e-6] / np.sqrt(value[value > 1e-6])

    def normal(batches: Iterable[pa.RecordBatch]):
        total = 0
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                grams = np.stack([np.frombuffer(g.as_py(), np.uint8) for g in part.column("grams")])
                x = unpacked(grams)
                z = np.column_stack([kernel(x, spread) @ root, np.ones(len(x))])
                lang = np.array(part.column("lang").to_pylist())
                y = np.where(lang[:, None] == np.array(languages), 1.0, -1.0)
                total = total + z.T @ np.column_stack([z, y])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = drawn.select("lang", "grams").mapInArrow(normal, "sums binary")
    total = sum(np.frombuffer(r["sums"]) for r in parts.toLocalIterator())
    size = root.shape[1] + 1
    total = total.reshape(size, -1)
    beta = np.linalg.solve(total[:, :size] + RIDGE * np.eye(size), total[:, size:])
    return Model(languages, marks, np.vstack([root @ beta[:-1], beta[-1:]]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): one-versus-rest scores as shares, from whole texts."""

    def run(batch):
        ids = batch.column("doc_id").to_pylist()
        waiting: list[tuple] = []

        def answer():
            raw = model.scores(np.stack([p for _, p in waiting]))
            share = np.exp(4 * (raw - raw.max(axis=1, keepdims=True)))
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            for (key, _), at, row in zip(waiting, best, share, strict=True):
                yield key, model.languages[at], float(row[at])
            waiting.clear()

        for key, raw in zip(ids, values(batch), strict=True):
            if not model.languages or not has_letter(raw and raw.decode()):
                yield key, UNKNOWN, 0.0
                continue
            waiting.append((key, presence(raw)))
            if len(waiting) == 256:
                yield from answer()
        if waiting:
            yield from answer()

    types = {"doc_id": pa.int64(), "lang_pred": pa.string(), "score": pa.float64()}
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(per_batch(run, types), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, learn: Column, *, scratch: str | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) per row, learned from the rows of ``docs`` where ``learn``.

    A null text or one without a letter is ``und`` with score 0, and so is every text if no
    row can be learned from. Rows without a language or an id are not learned from; rows that
    repeat an id are each predicted. Ties go to the language that sorts first.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    usable = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    labelled = docs.filter(learn & usable).select("doc_id", "text", "lang")
    return predict(docs, fit(labelled, scratch))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held_out = crc_part(F.col("doc_id"), 5) == 0
    found = identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
