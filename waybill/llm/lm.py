"""Stupid-backoff language model over the corpus itself."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import mixed, text_hashes, values
from waybill.sources.sinks import scratch_folder, staged

ORDER = 2
#: The longest model of the query, which gives the scores by ``ORDER`` too.
LONGEST = 3
BACKOFF = 0.4
#: Ids that follow each other form blocks of so many.
BLOCK = 4096
#: Bytes of text for each part of the count tables, and the least number of parts.
PART, LEAST = 8 << 20, 64
#: A block of more bytes is parted; so many parted blocks at most are broadcast.
BYTES, FEW = 24 << 20, 100_000
#: N-grams a task holds before it sends on the blocks that it has left.
HELD = 8_000_000
#: Bytes of text that travel together.
PACK = 1 << 20
_BASE = np.uint64(0x8EBC6AF09C88C6E3)
#: Under this key the words of the whole corpus are counted.
_WORDS = np.uint64(0)
#: The first of the blocks of rows without an id.
_FIRST = -(1 << 62)


def _grams(sizes: np.ndarray, hashes: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``order`` words, the first words of the n-grams and their hashes, never 0.

    ``hashes`` are the words of texts of ``sizes`` words; no n-gram reaches over an end.
    """
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    out, run = [], hashes
    for n in range(1, order + 1):
        if n > 1:
            run = run[:-1] * _BASE + hashes[n - 1 :]
            at = np.flatnonzero(text[: len(run)] == text[n - 1 :]) if len(run) else np.zeros(0, np.int64)
        else:
            at = np.arange(len(run))
        out.append((at.astype(np.int32), np.maximum(mixed(run[at], n), np.uint64(1))))
    return out


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    at = np.argsort(key, kind="stable")
    key, count = key[at], count[at]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _packed(numbers: np.ndarray) -> bytes:
    """The numbers' bytes, all lowest ones first, compressed: planes of zeros vanish."""
    planes = numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _numbers(packed: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    planes = pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _steps(key: np.ndarray) -> bytes:
    """Sorted n-grams as their differences."""
    return _packed(np.diff(key, prepend=np.uint64(0)))


def _keys(steps: bytes) -> np.ndarray:
    return np.cumsum(_numbers(steps, np.uint64), dtype=np.uint64)


def _pieces(key: np.ndarray, count: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Sorted n-grams cut by their leading bits into the parts of the count tables."""
    part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    for p in np.unique(part):
        a, b = np.searchsorted(part, [p, p + 1])
        yield int(p), _steps(key[a:b]), _packed(count[a:b].astype(np.uint32))


def block_counts(docs: DataFrame, parts: int, order: int = ORDER) -> DataFrame:
    """(part, block, grams, counts): n-grams counted by block, before any shuffle.

    A frequent n-gram thereby comes once from each block, however many rows hold it.
    """

    def counted(block: int, words: int, grams: list[np.ndarray]) -> pa.RecordBatch:
        key, count = np.unique(np.concatenate(grams), return_counts=True)
        key, count = np.insert(key, 0, _WORDS), np.insert(count, 0, words)
        part, keys, counts = zip(*_pieces(key, count, parts), strict=True)
        columns = [pa.array(part, pa.int32()), pa.array([block] * len(part), pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["part", "block", "grams", "counts"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[np.ndarray]]] = {}
        n = 0
        for block, _, texts in _runs(batches):
            sizes, hashes = text_hashes(texts)
            words, grams = held.pop(block, (0, []))
            new = [found for _, found in _grams(sizes, hashes, order)]
            held[block] = words + len(hashes), grams + new
            n += sum(map(len, new))
            while n > HELD:
                left = next(iter(held))
                words, grams = held.pop(left)
                n -= sum(map(len, grams))
                yield counted(left, words, grams)
        for block, (words, grams) in held.items():
            yield counted(block, words, grams)

    return docs.select("block", "doc_id", "text").mapInArrow(run, "part int, block long, grams binary, counts binary")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[int | None], list[bytes]]]:
    """(block, ids, texts) of neighbouring rows of one block, about ``PACK`` bytes at once."""
    of, ids, texts, size = None, [], [], 0
    for batch in batches:
        rows = zip(batch.column("block").to_pylist(), batch.column("doc_id").to_pylist(), values(batch), strict=True)
        for block, key, raw in rows:
            if ids and (block != of or size > PACK):
                yield of, ids, texts
                ids, texts, size = [], [], 0
            of = block
            ids.append(key)
            texts.append(raw or b"")
            size += len(texts[-1])
    if ids:
        yield of, ids, texts


def packed_texts(docs: DataFrame) -> DataFrame:
    """(block, ids, sizes, texts): the texts of neighbouring rows of a block, compressed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts in _runs(batches):
            raw = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
            columns = [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([raw], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "sizes", "texts"])

    schema = "block long, ids array<long>, sizes array<long>, texts binary"
    return docs.select("block", "doc_id", "text").mapInArrow(run, schema)


def _unpacked(packs: pa.Table) -> Iterator[tuple[list[int | None], list[bytes]]]:
    for ids, sizes, raw in zip(packs.column("ids"), packs.column("sizes"), packs.column("texts"), strict=True):
        sizes = sizes.as_py()
        whole = pa.decompress(raw.as_py(), decompressed_size=sum(sizes), codec="zstd", asbytes=True)
        ends = np.cumsum(sizes)
        yield ids.as_py(), [whole[e - n : e] for e, n in zip(ends, sizes, strict=True)]


def totals(counted: DataFrame) -> DataFrame:
    """(block, part, counts): how often each n-gram of a block occurs outside it.

    Counts of one part of the table are added up and answered to the blocks that hold the
    n-gram. They stand in the order of the block's distinct n-grams in that part, which the
    block finds again in its texts, so the n-grams themselves are not sent back.
    """

    def answer(table: pa.Table) -> pa.Table:
        blocks = np.array(table.column("block").to_pylist())
        keys = [_keys(x.as_py()) for x in table.column("grams")]
        counts = [_numbers(x.as_py(), np.uint32).astype(np.int64) for x in table.column("counts")]
        key, count = _merged(keys, counts)
        order = np.argsort(blocks, kind="stable")
        cuts = np.flatnonzero(np.diff(blocks[order])) + 1
        told = []
        for mine in np.split(order, cuts):
            own, n = _merged([keys[i] for i in mine], [counts[i] for i in mine])
            told.append((int(blocks[mine[0]]), _packed(count[np.searchsorted(key, own)] - n)))
        block, outside = zip(*told, strict=True)
        part = table.column("part")[0].as_py()
        columns = [pa.array(block, pa.int64()), pa.array([part] * len(told), pa.int32()), pa.array(outside, pa.binary())]
        return pa.table(columns, names=["block", "part", "counts"])

    return counted.groupBy("part").applyInArrow(answer, "block long, part int, counts binary")


def _others(grams: list[tuple[np.ndarray, np.ndarray]], of: np.ndarray, times: np.ndarray, told: np.ndarray) -> list[np.ndarray]:
    """For each n-gram of a block's texts, its count in all other documents.

    ``of`` has the text of each word and ``times`` how many documents have that text; ``told``
    counts the distinct n-grams outside the block, in their order. Range by range of the
    n-grams, one stable sort brings equal ones together, text by text.
    """
    out = [np.empty(len(key), np.int64) for _, key in grams]
    heads = [(key >> np.uint64(60)).astype(np.uint8) for _, key in grams]
    done = 0
    for head in range(16):
        mine = [np.flatnonzero(h == head) for h in heads]
        key = np.concatenate([g[i] for (_, g), i in zip(grams, mine, strict=True)])
        text = np.concatenate([of[at[i]] for (at, _), i in zip(grams, mine, strict=True)])
        if not len(key):
            continue
        order = np.argsort(key, kind="stable")
        key, text = key[order], text[order]
        edge = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(edge)
        total = told[done : done + len(first)] + np.add.reduceat(times[text], first)
        done += len(first)
        edge[1:] |= text[1:] != text[:-1]
        own = np.flatnonzero(edge)
        length = np.diff(own, append=len(key))
        gram = np.searchsorted(first, own, side="right") - 1
        count = np.empty(len(key), np.int64)
        count[order] = np.repeat(total[gram] - length, length)
        ends = np.cumsum([len(i) for i in mine])
        for found, i, part in zip(out, mine, np.split(count, ends[:-1]), strict=True):
            found[i] = part
    return out


def _scored(packs: pa.Table, told: pa.Table, order: int) -> pa.Table:
    ids, places, known = [], [], {}
    sizes, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for keys, texts in _unpacked(packs):
        new = []
        for key, raw in zip(keys, texts, strict=True):
            mark = hashlib.blake2b(raw, digest_size=16).digest()
            if mark not in known:
                known[mark] = len(known)
                new.append(raw)
            ids.append(key)
            places.append(known[mark])
        for parts, found in zip((sizes, hashes), text_hashes(new), strict=True):
            parts.append(found)
    sizes, hashes, places = np.concatenate(sizes), np.concatenate(hashes), np.array(places, np.int64)
    times = np.bincount(places, minlength=len(sizes))
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    grams = _grams(sizes, hashes, order)
    parts = sorted(zip(told.column("part").to_pylist(), told.column("counts"), strict=True), key=lambda x: x[0])
    told = np.concatenate([_numbers(x.as_py(), np.int64) for _, x in parts])
    words = int(told[0] + (sizes * times).sum())
    others = _others(grams, of, times, told[1:])
    starts = [at for at, _ in grams]
    del grams, told, hashes

    def summed(x: np.ndarray) -> np.ndarray:
        return np.bincount(of, x, len(sizes))[places]

    def whole(x: np.ndarray) -> np.ndarray:
        return np.bincount(of[x], minlength=len(sizes))[places]

    p = np.maximum(others[0], 0.5) / np.maximum(words - sizes, 1)[of]
    totals, misses = [summed(np.log(p))], [np.zeros(len(places), np.int64)]
    backed, context = np.zeros(len(of), bool), others[0]
    for n in range(1, order):
        at, seen = starts[n], others[n]
        met = seen > 0
        p[at + n] = np.where(met, seen / np.maximum(context[at], 1), BACKOFF * p[at + n])
        backed[at + n] = ~met
        totals.append(summed(np.log(p)))
        misses.append(whole(backed))
        context = np.zeros(len(of), np.int64)
        context[at] = seen
    per_row = [ids, sizes[places], np.stack(totals, 1).tolist(), np.stack(misses, 1).tolist(), whole(others[0] == 0)]
    return pa.table([pa.array(c, t) for c, t in zip(per_row, _TYPES.values(), strict=True)], names=list(_TYPES))


_TYPES = {
    "doc_id": pa.int64(), "n_words": pa.int64(), "log_probs": pa.list_(pa.float64()),
    "backed_off": pa.list_(pa.int64()), "n_unseen": pa.int64(),
}


def by_order(docs: DataFrame, *, order: int = ORDER, block: Column | None = None) -> DataFrame:
    """(doc_id, n_words, log_probs, backed_off, n_unseen) per row of ``docs``.

    The arrays have one item for the model of each order from 1 to ``order``; see ``score``.
    """
    block = (F.floor(F.col("doc_id") / BLOCK) if block is None else block).cast("long")
    lost = F.count_if(block.isNull())
    size, lost = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), lost).first()
    spread = F.lit(_FIRST) + F.pmod(F.xxhash64("text"), F.lit(-(-lost // BLOCK) or 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(block, spread).alias("block"))
    rows = _parted(rows)
    counted = block_counts(rows, max(LEAST, -(-size // PART)), order)
    told = totals(counted)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scored(left, right, order)

    schema = "doc_id long, n_words long, log_probs array<double>, backed_off array<long>, n_unseen long"
    return packed_texts(rows).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


def _parted(rows: DataFrame) -> DataFrame:
    """``rows`` with blocks of more than ``BYTES`` parted by id and text.

    Equal rows stay together, since a block scores a text once however many rows have it.
    """
    spark = rows.sparkSession
    size = F.sum(F.octet_length("text"))
    heavy = rows.groupBy(F.col("block").alias("_of")).agg(F.ceil(size / BYTES).alias("_parts")).filter("_parts > 1")
    heavy = staged(heavy, scratch_folder(spark), "heavy")
    n = heavy.count()
    if not n:
        return rows
    part = F.pmod(F.xxhash64("doc_id", "text"), "_parts")
    block = F.when(F.col("_parts").isNull(), F.col("block")).otherwise(F.xxhash64("block", part))
    joined = rows.join(F.broadcast(heavy) if n <= FEW else heavy, rows["block"] == heavy["_of"], "left")
    return joined.select("doc_id", "text", block.alias("block"))


def _told(order: int, suffix: str = "") -> list[Column]:
    log_prob = F.get("log_probs", F.lit(order - 1))
    return [
        log_prob.alias(f"log_prob{suffix}"),
        (log_prob / F.nullif("n_words", F.lit(0))).alias(f"score{suffix}"),
        F.get("backed_off", F.lit(order - 1)).alias(f"n_backed_off{suffix}"),
    ]


def score(docs: DataFrame, *, order: int = ORDER, block: Column | None = None) -> DataFrame:
    """(doc_id, n_words, log_prob, score, n_backed_off, n_unseen) per row of ``docs``.

    Each text is scored by the n-grams of all other rows: a word's probability is the
    longest n-gram's count over its context's, or ``BACKOFF`` times that of the next shorter
    one; a word seen nowhere else counts half. ``score`` is the mean logarithm a word.

    ``block`` groups rows whose n-grams are counted together before the shuffle and whose
    texts are scored together; by default ids that follow each other. It should hold a few
    thousand rows and lie together in the files; results do not depend on it. A block of more
    than ``BYTES``, such as an id that many rows repeat or very long texts, is parted by id
    and text; a single text is never parted. Count tables are cut by hash into parts of
    bounded size. Null and blank texts have no words, log_prob 0 and a null score; rows
    without a block (a null id) are spread over
    blocks of their own by their text; rows that repeat an id are documents of their own, so
    copies support each other.
    """
    found = by_order(docs, order=order, block=block)
    return found.select("doc_id", "n_words", *_told(order), "n_unseen")


def op7_lm(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of ``score`` by bigrams, and by trigrams with the suffix ``_3``."""
    found = by_order(spark.read.parquet(f"{folder}/documents.parquet"), order=LONGEST)
    return found.select("doc_id", "n_words", *_told(ORDER), "n_unseen", *_told(LONGEST, f"_{LONGEST}"))
