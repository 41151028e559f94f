"""Benchmark decontamination by a prefix-filtered join of shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.common import mixed, rolling, values, word_hashes
from waybill.sources.sinks import scratch_folder, staged

WINDOW, SHINGLE = 10, 3
#: Bits of the filter that goes to every task: 16 a key, between these powers of two (8 MB).
LEAST_BITS, MOST_BITS = 16, 26
#: Bytes that part words, as spaces; A to Z as a to z. Bytes of other letters are words' own.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_BASE = np.uint64(0xD1342543DE82EF95)


def plain_text(raw: bytes | None) -> bytes:
    """The text with only its words and spaces: equal words are equal bytes."""
    return (raw or b"").translate(_PLAIN)


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    return mixed(rolling(hashes, width, _BASE), width).view(np.int64)


def item_windows(benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, shingles) of every run of ``window`` words; a shorter item is one run.

    ``shingles`` are hashes of each ``shingle`` words that follow each other, or of the whole
    run if it is shorter. Items without words, null ones among them, have no windows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column("item_id").to_pylist(), values(batch), strict=True):
                text = plain_text(raw)
                words = text.split()
                if not words:
                    continue
                size = min(window, len(words))
                width = min(shingle, size)
                found = _shingles(word_hashes(text), width)
                starts = range(len(words) - size + 1)
                for at in range(0, len(starts), 4096):
                    some = starts[at : at + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(some), pa.string()),
                            pa.array([b" ".join(words[i : i + size]).decode() for i in some]),
                            pa.array([found[i : i + size - width + 1] for i in some], pa.list_(pa.int64())),
                        ],
                        names=["item_id", "words", "shingles"],
                    )

    narrow = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return narrow.mapInArrow(run, "item_id string, words string, shingles array<long>")


class KeyFilter:
    """A set of 64-bit keys as bits of bounded size: lets every key pass, and few others.

    The set only spares rows the join behind it, so what it lets pass too much costs time,
    never correctness.
    """

    def __init__(self, keys: DataFrame):
        n = keys.count()
        self.bits = min(max((16 * n).bit_length(), LEAST_BITS), MOST_BITS)
        place = F.shiftrightunsigned("key", 64 - self.bits)
        one = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
        filled = keys.select(place.alias("place")).select((F.col("place") / 64).cast("int").alias("word"), one.alias("one"))
        words = filled.groupBy("word").agg(F.bit_or("one").alias("bits")).toArrow()
        table = np.zeros(1 << (self.bits - 6), np.int64)
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        self.table = np.unpackbits(table.view(np.uint8), bitorder="little") if self.bits <= 20 else table

    def passing(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys that may be in the set."""
        place = keys.view(np.uint64) >> np.uint64(64 - self.bits)
        if self.bits <= 20:
            return np.flatnonzero(self.table[place])
        return np.flatnonzero(self.table[place >> np.uint64(6)] >> (place & np.uint64(63)).astype(np.int64) & 1)


def shingle_counts(docs: DataFrame, wanted: KeyFilter, widths: list[int]) -> DataFrame:
    """(key, n): how often each shingle that passes the filter occurs, by batch of rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for raw in values(batch):
                hashes = word_hashes(plain_text(raw))
                for width in widths:
                    keys = _shingles(hashes, width)
                    held.append(keys[wanted.passing(keys)])
            key, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def places(docs: DataFrame, wanted: KeyFilter, widths: list[int], window: int) -> DataFrame:
    """(doc_id, n_words, found) per row; ``found`` lists where a shingle may begin a prefix:
    its key, the place of its first word, and the words around it that a window can reach."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            held: list[tuple] = []
            size = 0
            for i, raw in enumerate(values(batch)):
                text = plain_text(raw)
                hashes = word_hashes(text)
                found, words = [], None
                for width in widths:
                    keys = _shingles(hashes, width)
                    for at in wanted.passing(keys).tolist():
                        words = words or text.split()
                        before = max(0, at - window + width)
                        around = b" ".join(words[before : at + window]).decode()
                        found.append({"key": int(keys[at]), "at": at, "before": at - before, "around": around})
                held.append((ids[i].as_py(), len(hashes), found))
                size += 1 + len(found)
                if size > 4096:
                    yield _record(held)
                    held, size = [], 0
            yield _record(held)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, _PLACES)


_FOUND = pa.list_(
    pa.struct({"key": pa.int64(), "at": pa.int32(), "before": pa.int32(), "around": pa.string()}.items())
)
_PLACES = "doc_id long, n_words long, found array<struct<key: long, at: int, before: int, around: string>>"


def _record(held: list[tuple]) -> pa.RecordBatch:
    columns = zip(*held, strict=True) if held else [[], [], []]
    types = (pa.int64(), pa.int64(), _FOUND)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_words", "found"]
    )


def prefixes(windows: DataFrame, counts: DataFrame, scratch: str) -> DataFrame:
    """(words, size, key, offset): each distinct window with the shingle it is looked up by.

    Shingles are ordered by rarity in the documents, then by hash. A document holds a window
    only if it holds all of its shingles, so with all of them required the necessary prefix is
    the first one in that order. A window with a shingle that no document holds has no match.
    """
    distinct = windows.select("words", "shingles").dropDuplicates(["words"])
    each = distinct.select("words", F.posexplode("shingles").alias("offset", "key"))
    rare = each.join(counts, "key", "left").select("words", "key", "offset", F.coalesce("n", F.lit(0)).alias("n"))
    first = rare.groupBy("words").agg(F.min(F.struct("n", "key", "offset")).alias("first")).filter("first.n > 0")
    size = F.size(F.split("words", " ")).alias("size")
    return staged(first.select("words", size, "first.key", "first.offset"), scratch, "prefixes")


def _matched() -> tuple[Column, Column]:
    """Whether a window lies around a place, by bounds first and then word by word."""
    begin = F.col("before") - F.col("offset")
    bounds = (begin >= 0) & (F.col("at") - F.col("offset") + F.col("size") <= F.col("n_words"))
    around = F.split("around", " ")
    same = F.array_join(F.slice(around, F.greatest(begin, F.lit(0)) + 1, F.col("size")), " ") == F.col("words")
    return bounds, same


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE, scratch: str | None = None
) -> dict[str, DataFrame]:
    """Where windows of benchmark items occur in documents.

    ``rows`` has (row, doc_id, n_words) for every row of ``docs``, ``hits`` (row, start, size)
    each run of words that is some window, and ``items`` (row, item_id) each item with one.

    Words are runs of digits, letters a to z (A to Z lower-cased) and characters beyond ASCII.
    The documents are read twice, in place: once to count the benchmark's shingles, once to
    find each window's rarest. Only those places travel, with the few words around them, and
    are joined with the windows by key, in whatever way the written table's size allows. A
    match must hold the bounds of length and position and then every word. Null and empty texts
    have no words; documents that repeat an id or have none are rows of their own; items that
    repeat an id are one item with all their windows; an item without an id has no name to
    report but its words count as hit.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    windows = staged(item_windows(benchmark, window=window, shingle=shingle), scratch, "windows")
    keys = windows.select(F.explode("shingles").alias("key")).distinct()
    sizes = windows.select(F.least(F.size(F.split("words", " ")), F.lit(shingle)).alias("width")).distinct()
    widths = sorted(r["width"] for r in sizes.collect())
    counts = staged(shingle_counts(docs, KeyFilter(keys), widths), scratch, "counts")
    chosen = prefixes(windows, counts, scratch)
    rows = places(docs, KeyFilter(chosen.select("key").distinct()), widths, window)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), scratch, "places")
    found = rows.filter(F.size("found") > 0).select("row", "n_words", F.inline("found"))
    bounds, same = _matched()
    start = (F.col("at") - F.col("offset")).alias("start")
    matches = found.join(chosen, "key").filter(bounds).filter(same).select("row", start, "size", "words")
    matches = staged(matches, scratch, "matches")
    names = windows.filter("item_id IS NOT NULL").select("words", "item_id").distinct()
    items = matches.select("row", "words").distinct().join(names, "words").select("row", "item_id").distinct()
    hits = matches.select("row", "start", "size").distinct()
    return {"rows": rows.drop("found"), "hits": hits, "items": items}


def hit_words(hits: DataFrame) -> DataFrame:
    """(row, n_hit): words inside some run, each once however many runs cover it."""
    order = Window.partitionBy("row").orderBy("start", "size")
    end = F.col("start") + F.col("size")
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(reached, F.lit(0))))
    return hits.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, scratch: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``; see
    ``contamination``. The hash is of the item ids, sorted as strings and joined by commas. An
    empty benchmark leaves every document clean, and no documents give no rows."""
    found = contamination(docs, benchmark, scratch=scratch)
    listed = F.array_sort(F.collect_set("item_id")).alias("items")
    items = found["items"].groupBy("row").agg(listed)
    joined = found["rows"].join(hit_words(found["hits"]), "row", "left").join(items, "row", "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    n_items = F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long")
    names = F.coalesce(F.array_join("items", ","), F.lit(""))
    return joined.select(
        "doc_id", "n_words", hit.alias("n_hit"), n_items.alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """``decontaminated`` for whole ``documents`` against whole ``benchmark``."""
    docs, benchmark = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    return decontaminated(docs, benchmark)


# Every window of every item, compared with every run of as many words of every document.
OP13_SQL = r"""
WITH plain AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM item WHERE len(w) > 0),
started AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS start FROM sized),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[start:start + size - 1], ' ') AS words FROM started),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS start FROM plain, sizes),
said AS (SELECT row, size, start, array_to_string(w[start:start + size - 1], ' ') AS words FROM runs),
met AS (SELECT DISTINCT row, start, size, item_id FROM said JOIN windows USING (size, words)),
hit AS (SELECT row, count(DISTINCT place) AS n_hit
  FROM (SELECT row, unnest(range(start, start + size)) AS place FROM met) GROUP BY row),
named AS (SELECT row, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM met GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM plain LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""
