"""What the operators share: whole texts out of Arrow batches, hashes, row keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.sources.sinks import staged

#: The bytes that end a word: space and the controls 0x09 to 0x0D.
SPACE = r"[ \x09-\x0D]+"
#: Bytes of rows that a Python worker is sent at once; a longer row comes alone.
BATCH_BYTES = 1 << 19
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def values(batch: pa.RecordBatch, name: str = "text", step: int = 128) -> Iterator[bytes | None]:
    """The column's values as UTF-8, a slice at a time; a batch may hold long texts."""
    column = batch.column(name)
    for at in range(0, len(column), step):
        yield from column.slice(at, step).cast(pa.large_binary()).to_pylist()


def id_type(docs: DataFrame, name: str = "doc_id") -> str:
    return docs.schema[name].dataType.simpleString()


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of some ``BATCH_BYTES``, however long the rows are.

    Spark's own limit is 10,000 rows, which the worker and the JVM beside it hold several times
    over. It is a setting of the session and stays; one that the session already has is kept.
    """
    conf = df.sparkSession.conf
    if conf.get(_LIMIT, None) is None:
        conf.set(_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def per_batch(fn, types: dict[str, pa.DataType]):
    """``fn(batch)`` gives tuples; the result is a function for ``mapped``."""
    schema = pa.schema(types)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block: list[tuple] = []
            for row in fn(batch):
                block.append(row)
                if len(block) == 2048:
                    yield _record(block, schema)
                    block = []
            if block:
                yield _record(block, schema)

    return run


def _record(block: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*block), schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def words(text: str | Column = "text") -> Column:
    """The words of a text as an array; empty for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def row_key() -> Column:
    """64 bits of the text that tell rows apart which repeat an id or have none."""
    return F.xxhash64("text")


def bucket(key: Column, n: int) -> Column:
    """One of ``n`` even parts by the key's MD5, which other SQL engines compute as well."""
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % n).cast("int")


# -- vectorised word hashes -------------------------------------------------------------

_WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spreads every bit of the hash over all 64 (a finaliser of two multiplications)."""
    h = h + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(raw: bytes, segment: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word, in order. Works on about ``segment`` bytes at once."""
    parts, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + segment)
        while end < len(raw) and not _SEPARATOR[raw[end]]:
            end += 1
        parts.append(_hashes(np.frombuffer(raw, np.uint8, end - at, at))[1])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def text_hashes(texts: list[bytes], segment: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words of the texts and the hashes of all their words, text after text.

    Short texts are hashed together, about ``segment`` bytes at once.
    """
    sizes, parts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(texts):
        end, held = at + 1, len(texts[at])
        while end < len(texts) and held + len(texts[end]) < segment:
            held += len(texts[end]) + 1
            end += 1
        if end == at + 1:
            parts.append(word_hashes(texts[at]))
            sizes.append(np.array([len(parts[-1])]))
        else:
            starts, found = _hashes(np.frombuffer(b"\n".join(texts[at:end]), np.uint8))
            ends = np.cumsum([len(t) + 1 for t in texts[at:end]])
            sizes.append(np.diff(np.searchsorted(starts, ends), prepend=0))
            parts.append(found)
        at = end
    return np.concatenate(sizes), np.concatenate(parts)


def _hashes(view: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start, and their hashes."""
    edge = np.diff(np.concatenate(([1], _SEPARATOR[view].view(np.int8), [1])))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up = powers(_WORD_BASE, len(view))
    down = powers(inverse(_WORD_BASE), len(view))
    total = np.concatenate(([np.uint64(0)], np.cumsum((view + np.uint64(1)) * up)))
    lengths = (ends - starts).astype(np.uint64)
    return starts, mixed((total[ends] - total[starts]) * down[starts] + lengths)


def rolling(hashes: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of every window of ``width`` words, modulo 2**64."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers(base, len(hashes)))))
    return mixed((total[width:] - total[:-width]) * powers(inverse(base), n))


# -- ranks -------------------------------------------------------------------------------


def numbered(df: DataFrame, group: list[str], order: list[str], scratch: str, name: str) -> DataFrame:
    """``df`` with ``rank``, counted from 0 within each group in the order given.

    Rows are range-sorted by group and order, so a group of any size spreads over many
    tasks; each task's rows are counted and the counts before it added. The sorted rows are
    written first: a task that is run again must find them in the same places. Fully equal
    rows are numbered in any order. Nulls sort first and form a group of their own.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    ranged = staged(ranged.withColumn("_place", place), scratch, name)
    ranged = ranged.withColumn("_part", F.shiftright("_place", 33))
    counts = ranged.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_part")) - F.col("_n")
    starts = counts.select(
        *(F.col(c).alias(f"_{c}") for c in group), F.col("_part").alias("_of"), "_first", before.alias("_before")
    )
    same = ranged["_part"] == starts["_of"]
    for c in group:
        same &= ranged[c].eqNullSafe(starts[f"_{c}"])
    rank = F.col("_place") - F.col("_first") + F.col("_before")
    return ranged.join(starts, same).select(*df.columns, rank.alias("rank"))
