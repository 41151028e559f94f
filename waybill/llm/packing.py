"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import mapped, numbered, per_batch, values
from waybill.sources.sinks import scratch_folder, staged

VOCABULARY = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
CAPACITY = 2048
CACHE = 1_000_000
# Texts of these characters take the fast path.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]*")
_GAPS = re.compile(" \\s")


class Encoder(dict):
    """Token ids as little-endian 32-bit bytes; as a dict, the ids of words after a space.

    Where no white space follows a space, the vocabulary's units never reach past the next
    space, so words are encoded one by one and the first ``CACHE`` distinct ones remembered;
    frequent ones come early. Texts that hold an added token, such as ``<|endoftext|>``, go to
    the tokenizer as it was loaded. The fast path takes the same vocabulary as ranks, which encode a
    short text several times faster; the tests hold both against each other.
    """

    def __init__(self, whole: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(whole)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Ranks know no added tokens: a text that holds one is left to the tokenizer.
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)").search
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.short = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
        ).encode_ordinary

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = array("I", self.short(" " + word)).tobytes()
        if len(self) < CACHE and len(word) < 64:
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or self.added(text):
            return self.whole(text)
        if _GAPS.search(text):
            return array("I", self.short(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.short(first)).tobytes() + b"".join(map(self.__getitem__, rest))


@lru_cache(maxsize=1)
def encoder(whole: str, ranks: str) -> Encoder:
    """One per Python worker."""
    return Encoder(whole, ranks)


def pieces(
    docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: tuple[str, str] | None = None, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and a final 0.

    Documents longer than ``capacity`` are cut; all pieces but the first are full. A null
    text counts as empty: one piece of length 1. ``vocabulary`` names the tokenizer's file
    and the file of its ranks; both must be at the same place on every executor.
    """
    files = vocabulary or tuple(map(public_tokenizers.path, VOCABULARY))

    def run(batch):
        known = encoder(*files)
        for key, raw in zip(batch.column("doc_id").to_pylist(), values(batch), strict=True):
            ids = known.encode((raw or b"").decode()) + bytes(4)
            n = len(ids) // 4
            at, end = 0, n % capacity or capacity
            for piece in range(-(-n // capacity)):
                part = ids[at * 4 : end * 4]
                yield (key, piece, at, end - at, zlib.crc32(part), *((part,) if with_ids else ()))
                at, end = end, end + capacity

    types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        types["ids"], schema = pa.binary(), f"{schema}, ids binary"
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mapped(narrow, per_batch(run, types), schema)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Copies by length of the fullest feasible bin that holds the largest length.

    Bit s of ``reach`` says that some available lengths sum to s. Lengths come in powers of
    two copies, longest first; walking back from the fullest sum gives the combination.
    """
    top = max(counts)
    slack = capacity - top
    mask = (1 << (slack + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= slack), reverse=True):
        left = min(counts[length] - (length == top), slack // length)
        take = 1
        while left > 0 and not reach >> slack & 1:
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= reach << (length * take) & mask
            left, take = left - take, take * 2
        if reach >> slack & 1:
            break
    found = Counter({top: 1})
    rest = reach.bit_length() - 1
    for before, length, take in reversed(steps):
        if not before >> rest & 1:
            found[length] += take
            rest -= length * take
    return dict(found)


@dataclass(frozen=True)
class Plan:
    """For each length, runs of ranks and where they go; sorted by ``key``."""

    key: np.ndarray  # length * 2**40 + first rank of the run
    rank: np.ndarray
    sequence: np.ndarray  # of the run's first piece
    copies: np.ndarray  # of this length in each of the run's sequences
    offset: np.ndarray  # of the first copy

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 40) + rank, "right") - 1
        nth = rank - self.rank[at]
        return self.sequence[at] + nth // self.copies[at], self.offset[at] + nth % self.copies[at] * length


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Minimum bin slack over a histogram of lengths.

    The fullest combination is taken as often as the counts allow, so each round uses up
    some length and the rounds follow ``capacity``, not the number of pieces.
    """
    left = {int(k): int(v) for k, v in counts.items() if v}
    done: Counter[int] = Counter()
    sequence, runs = 0, []
    while left:
        bin_ = fullest(left, capacity)
        times = min(left[x] // c for x, c in bin_.items())
        offset = 0
        for length, copies in bin_.items():
            runs.append(((length << 40) + done[length], done[length], sequence, copies, offset))
            offset += length * copies
            done[length] += copies * times
            left[length] -= copies * times
            if not left[length]:
                del left[length]
        sequence += times
    runs.sort()
    return Plan(*np.array(runs, np.int64).reshape(-1, 5).T)


def pack(cut: DataFrame, *, capacity: int = CAPACITY, scratch: str | None = None) -> DataFrame:
    """``cut`` (doc_id, piece, length and other columns) with sequence_id and offset.

    Only the histogram of lengths, at most ``capacity`` numbers, reaches the driver, and
    only the plan made of it is sent to the tasks. Pieces find their place by their rank
    among those of equal length. No pieces give no rows; ties of equal length are ordered by
    doc_id and piece, null ids first.
    """
    scratch = scratch or scratch_folder(cut.sparkSession)
    cut = staged(cut, scratch, "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counts and max(counts) > capacity:
        raise ValueError(f"a piece is longer than {capacity}")
    made = plan(counts, capacity)
    ranked = numbered(cut, ["length"], ["doc_id", "piece"], scratch, "by-length")

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = made.place(length, rank)
            rest = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(sequence), pa.array(offset)], names=[*rest.schema.names, "sequence_id", "offset"]
            )

    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, schema)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(pieces(spark.read.parquet(f"{folder}/documents.parquet")))
