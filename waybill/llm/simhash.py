"""Near-duplicates by SimHash, found through balls of half the radius."""

from __future__ import annotations

from itertools import accumulate, chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.common import id_type, mapped, per_batch, row_key, values
from waybill.llm.components import components
from waybill.sources.sinks import scratch_folder, staged

SHINGLE = 3
RADIUS = 2
SEED = 42
CHUNK = 1 << 15


def fingerprint(raw: bytes | None, width: int = SHINGLE) -> int:
    """The text's 64 bits as a signed integer; 0 if it has no words.

    A bit is set if more than half of the shingles' XXH64 values have it. A text of fewer
    words than ``width`` has one shingle, all of it.
    """
    tokens = (raw or b"").lower().split()
    if not tokens:
        return 0
    width = min(width, len(tokens))
    n = len(tokens) - width + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = tokens[at : at + CHUNK + width - 1]
        joined = b" ".join(part)
        ends = list(accumulate(map(len, part), lambda a, b: a + b + 1))
        starts = chain((0,), (e + 1 for e in ends))
        found = [xxhash.xxh64_digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :])]
        bits = np.unpackbits(np.frombuffer(b"".join(found), np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, row, bits) of every row, from its whole text; ``row`` is a key of the text."""

    def run(batch):
        keys = (batch.column(c).to_pylist() for c in ("doc_id", "row"))
        return zip(*keys, (fingerprint(t, width) for t in values(batch)))

    narrow = docs.select("doc_id", row_key().alias("row"), "text")
    types = {"doc_id": _arrow(narrow), "row": pa.int64(), "bits": pa.int64()}
    return mapped(narrow, per_batch(run, types), f"doc_id {id_type(narrow)}, row long, bits long")


def _arrow(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of different ``bits`` that connect whatever lies within ``radius``.

    Every distinct fingerprint emits all variants within half the radius. Two fingerprints
    are within the radius exactly if they share a variant, and all that share one are within
    the radius of each other, so the least of them is linked to the rest: no pair of a group
    is emitted beside these, and their connected components are those of all links. A
    variant has as many members as a ball has points (65 for radius 2), however many
    documents there are; copies count as one fingerprint.
    """
    if radius % 2:
        raise ValueError("the radius must be even: two halves meet in the middle")
    masks = [sum(1 << b for b in bits) for k in range(radius // 2 + 1) for bits in combinations(range(64), k)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    each = prints.select("bits").distinct().select(
        "bits", F.explode(F.array(*map(F.lit, masks))).alias("mask")
    ).select("bits", F.col("bits").bitwiseXOR(F.col("mask")).alias("variant"))
    least = F.min("bits").over(Window.partitionBy("variant"))
    met = each.select("bits", least.alias("b")).filter("bits <> b").distinct()
    return met.filter(F.bit_count(F.col("bits").bitwiseXOR(F.col("b"))) <= radius).select(
        F.col("bits").alias("a"), "b"
    )


def near_duplicates(
    docs: DataFrame, *, width: int = SHINGLE, radius: int = RADIUS, scratch: str | None = None
) -> DataFrame:
    """(doc_id, row, bits, root, component_id) per row of ``docs``: the least id reachable over
    links. ``root`` tells components apart that have one name because an id repeats.

    Null and blank texts have fingerprint 0 and are linked like any other. A null id takes
    part in links but never names a component unless all its members are null; rows that
    repeat an id are kept, each with its own fingerprint. Texts of any length are hashed in parts.
    Other columns are ignored; an empty table gives no rows.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    prints = staged(fingerprints(docs, width), scratch, "fingerprints")
    each = prints.groupBy("bits").agg(F.min("doc_id").alias("least"))
    found = staged(links(prints, radius), scratch, "links")
    roots = components(found, scratch).withColumnRenamed("node", "bits")
    member = roots.join(each, "bits")
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = member.join(named, "root").select("bits", "root", "component_id")
    classes = each.join(linked, "bits", "left").select(
        "bits",
        F.coalesce("root", "bits").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # Written, both sides of the join are plain shuffles and a hot fingerprint can be split.
    classes = staged(classes, scratch, "classes")
    return prints.join(classes, "bits").select("doc_id", "row", "bits", "root", "component_id")


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of ``classes``, all columns kept.

    It is the row of the least id; a row without an id stands for a component only if all its
    members have none. Among rows that repeat this id the key of the text decides, and equal
    texts under one id stand for each other. An id whose texts lie in several components stays
    once in each.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    chosen = classes.groupBy("root").agg(F.min(rank).alias("least"))
    chosen = chosen.select(F.col("least.doc_id").alias("kept_id"), F.col("least.row").alias("kept_row"))
    key = F.xxhash64(docs["text"])
    standing = docs.join(
        chosen, docs["doc_id"].eqNullSafe(chosen["kept_id"]) & (key == chosen["kept_row"]), "left_semi"
    )
    nth = F.row_number().over(Window.partitionBy("doc_id", row_key()).orderBy("text"))
    place = "_nth" + "_" * max((len(c) for c in docs.columns), default=0)
    return standing.withColumn(place, nth).filter(F.col(place) == 1).drop(place)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
