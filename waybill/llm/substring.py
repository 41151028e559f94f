"""Removal of passages that an earlier document holds too, by Rabin-Karp windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.common import mapped, mixed, per_batch, rolling, row_key, values, word_hashes
from waybill.sources.sinks import scratch_folder, staged

WINDOW = 50
#: Odd bases of the window hash, its check and the anchors.
_BASE, _CHECK, _ANCHOR = (
    np.uint64(b) for b in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
)


def _anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` words, the least hash among its runs of half its length.

    Equal windows have equal anchors, and neighbouring windows mostly share one.
    """
    least = rolling(hashes, width // 2 + 1, _ANCHOR)
    span = width - width // 2
    n = len(hashes) - width + 1
    size = 1
    while size < span:  # minima over 1, 2, 4 ... and then span places
        step = min(size, span - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return least[:n].view(np.int64)


def _windows(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and check of every window: 96 bits of two independent rolling hashes."""
    first = rolling(hashes, width, _BASE).view(np.int64)
    check = rolling(mixed(hashes, 1), width, _CHECK) >> np.uint64(33)
    return first, check.astype(np.int64)


def summaries(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, row, n_words, whole, anchors): the text's key, the words' count, SHA-256 and
    window anchors."""

    def run(batch):
        keys = zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), strict=True)
        for key, raw in zip(keys, values(batch), strict=True):
            tokens = (raw or b"").split()
            found = []
            if len(tokens) >= width:
                found = np.unique(_anchors(word_hashes(raw), width))
            yield *key, len(tokens), hashlib.sha256(b" ".join(tokens)).hexdigest(), found

    types = {
        "doc_id": pa.int64(), "row": pa.int64(), "n_words": pa.int64(), "whole": pa.string(),
        "anchors": pa.list_(pa.int64()),
    }
    return mapped(
        _texts(docs), per_batch(run, types), "doc_id long, row long, n_words long, whole string, anchors array<long>"
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text")


def candidate_windows(suspects: DataFrame, width: int = WINDOW) -> DataFrame:
    """(hash, check, doc_id, row, at) of the windows whose anchor is among ``shared``."""

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            keys, rows, shared = (batch.column(c) for c in ("doc_id", "row", "shared"))
            for i, raw in enumerate(values(batch)):
                hashes = word_hashes(raw)
                wanted = shared[i].values.to_numpy()
                at = np.flatnonzero(np.isin(_anchors(hashes, width), wanted))
                first, check = _windows(hashes, width)
                key, row = (np.full(len(at), c[i].as_py()) for c in (keys, rows))
                yield pa.RecordBatch.from_arrays(
                    [first[at], check[at], key, row, at], names=["hash", "check", "doc_id", "row", "at"]
                )

    narrow = suspects.select("doc_id", "row", "text", "shared")
    return mapped(narrow, run, "hash long, check long, doc_id long, row long, at long")


def repeated_spans(docs: DataFrame, *, width: int = WINDOW, scratch: str | None = None) -> dict[str, DataFrame]:
    """The maximal intervals of words that windows seen in an earlier document cover.

    ``summaries`` has every row, ``copies`` (doc_id, row) those whose whole word sequence stands
    under a smaller id (all of it goes), ``spans`` (doc_id, row, spans, text) the others that lose
    words, each span from its first word to beyond its last. ``row`` is a key of the text.

    A window is removed if a smaller ``doc_id`` has the same words, judged on the input.
    Windows are anchored at the least hash of their half-length runs; a window whose anchor
    occurs in one document only occurs there only, so it is counted without a shuffle. All
    others are counted in Spark by their 95-bit hash. Least ids are aggregated before each
    shuffle, written and joined back, so a passage in a third of all rows is split by
    adaptive execution. Rows that repeat an id with different texts are judged each for itself
    and take nothing from each other; equal rows fare alike. A null id is never earlier or later
    than another, so its row keeps all words. Null and blank texts have no words. A text of any
    length is hashed a megabyte at a time; its hashes, 8 bytes a word, are held by one task.
    An empty table gives no rows; other columns are ignored.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    base = staged(summaries(docs, width), scratch, "summaries")
    long = base.filter((F.col("n_words") >= width) & F.col("doc_id").isNotNull())
    first = long.groupBy("whole").agg(F.min("doc_id").alias("first_id"))
    first = staged(first, scratch, "first")
    judged = long.join(first, "whole").select(
        "doc_id", "row", "anchors", (F.col("doc_id") > F.col("first_id")).alias("copy")
    )
    judged = staged(judged, scratch, "judged")
    copies = judged.filter("copy").select("doc_id", "row").distinct()
    anchors = judged.filter("NOT copy").select("doc_id", "row", F.explode("anchors").alias("anchor"))
    met = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    met = staged(met.filter("lo < hi").select("anchor"), scratch, "shared")
    shared = anchors.join(met, "anchor").groupBy("doc_id", "row").agg(F.collect_set("anchor").alias("shared"))
    suspects = staged(_texts(docs).join(shared, ["doc_id", "row"]), scratch, "suspects")
    windows = candidate_windows(suspects, width)
    seen = windows.groupBy("hash", "check").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    seen = staged(seen.filter("lo < hi").select("hash", "check", "lo"), scratch, "repeated")
    hits = windows.join(seen, ["hash", "check"]).filter("doc_id > lo").select("doc_id", "row", "at")
    order = Window.partitionBy("doc_id", "row").orderBy("at")
    apart = F.col("at") - F.lag("at").over(order) > width
    islands = hits.distinct().withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
    islands = islands.withColumn("island", F.sum("apart").over(order))
    spans = islands.groupBy("doc_id", "row", "island").agg(
        F.min("at").alias("start"), (F.max("at") + width).alias("end")
    )
    each = F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    spans = spans.groupBy("doc_id", "row").agg(each)
    spans = suspects.select("doc_id", "row", "text").join(spans, ["doc_id", "row"])
    return {"summaries": base, "copies": copies, "spans": spans}


def _cut(raw: bytes, spans: list[dict]) -> list[bytes]:
    tokens = raw.split()
    kept, at = [], 0
    for span in spans:
        kept += tokens[at : span["start"]]
        at = span["end"]
    return kept + tokens[at:]


def remaining(spans: DataFrame) -> DataFrame:
    """(doc_id, row, n_kept, kept): what is left of the texts in ``spans``, words joined by a space."""

    def run(batch):
        ids, rows, cuts = (batch.column(c) for c in ("doc_id", "row", "spans"))
        for i, raw in enumerate(values(batch)):
            kept = _cut(raw, cuts[i].as_py())
            yield ids[i].as_py(), rows[i].as_py(), len(kept), b" ".join(kept).decode()

    types = {"doc_id": pa.int64(), "row": pa.int64(), "n_kept": pa.int64(), "kept": pa.string()}
    return mapped(spans, per_batch(run, types), "doc_id long, row long, n_kept long, kept string")


def outcome(found: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, row, n_kept, kept) of every document that loses words, once an id and text."""
    none = found["copies"].select("doc_id", "row", F.lit(0).cast("long").alias("n_kept"), F.lit("").alias("kept"))
    return remaining(found["spans"]).unionByName(none).dropDuplicates(["doc_id", "row"])


def without_repeats(docs: DataFrame, *, width: int = WINDOW, scratch: str | None = None) -> DataFrame:
    """``docs`` with the repeated words taken out of their texts; other rows stay untouched.

    A text that loses words has its remaining ones joined by one space. A document that
    loses all of them goes, since nothing of it is left. Nulls, repeated ids and long texts: see
    ``repeated_spans``.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    rest = outcome(repeated_spans(docs, width=width, scratch=scratch))
    rest = rest.select(F.col("doc_id").alias("changed_id"), F.col("row").alias("changed_row"), "n_kept", "kept")
    same = (docs["doc_id"] == rest["changed_id"]) & (F.xxhash64(docs["text"]) == rest["changed_row"])
    joined = docs.join(rest, same, "left")
    joined = joined.filter(rest["n_kept"].isNull() | (rest["n_kept"] > 0))
    text = F.coalesce(rest["kept"], docs["text"]).alias("text")
    return joined.select(*(text if c == "text" else docs[c] for c in docs.columns))


def op8_substring(spark: SparkSession, folder: str) -> DataFrame:
    """Words kept and removed of every document, and the SHA-256 of those kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = repeated_spans(docs)
    left = outcome(found).select("doc_id", "row", "n_kept", F.sha2("kept", 256).alias("sha"))
    kept = F.coalesce("n_kept", "n_words")
    return found["summaries"].join(left, ["doc_id", "row"], "left").select(
        "doc_id", "n_words", (F.col("n_words") - kept).alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256")
    )
