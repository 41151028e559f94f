"""Alignment of two tokenizers over the corpus, by words or by windows between whitespace anchors."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as SqlWindow
from pyspark.sql import functions as F

from waybill.llm.common import per_batch, values
from waybill.llm.packing import _GAPS as GAPS
from waybill.llm.packing import _PLAIN as PLAIN
from waybill.llm.packing import VOCABULARY, Encoder
from waybill.sources.sinks import scratch_folder, staged

PIECES = "piece_bpe_32k.model"
#: Words and windows after which a worker sets a new memory up and keeps the last one beside it,
#: and the most ids that a remembered one has.
MEMO, REMEMBERED = 200_000, 64
#: Texts that are encoded together.
TOGETHER = 64
_MARK = "▁"
#: Groups as text, their number, and the links as 64-bit numbers.
Window = tuple[str, int, bytes]
#: Tokens of either side, groups as text, their number, links: of a word or a whole text.
Spelt = tuple[int, int, str, int, bytes]
#: A word that either side does not spell back.
_UNSPELT: Spelt = (0, 0, "", 0, b"")
#: Added to the ids of the second side where both stand in one key.
_OTHER = np.int32(1 << 24)


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write a byte as the character of that number if it is visible
    there, and the others, in order, as those from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """The bytes of a vocabulary's tokens, their lengths and which begin with a space."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = tokens
        self.sizes, self.names = [len(t) for t in tokens], [str(i) for i in range(len(tokens))]
        self.lengths = np.array(self.sizes, np.int64)
        self.spaced = np.array([t[:1] == b" " for t in tokens])

    def spell(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def align(a: list[int], b: list[int], a_side: Side, b_side: Side) -> Window:
    """One window's groups as text, their number, and every link as b * 2**32 + a.

    Walks both sequences in step: a token links to each one of the other side whose bytes it
    overlaps, and a group ends where both sides do.
    """
    size_a, size_b, name_a, name_b = a_side.sizes, b_side.sizes, a_side.names, b_side.names
    groups, links = [], []
    i = j = 0
    x, y = a[0], b[0]
    end_a, end_b, text_a, text_b = size_a[x], size_b[y], name_a[x], name_b[y]
    while True:
        links.append((y << 32) + x)
        if end_a < end_b:
            i += 1
            x = a[i]
            end_a, text_a = end_a + size_a[x], f"{text_a},{name_a[x]}"
        elif end_b < end_a:
            j += 1
            y = b[j]
            end_b, text_b = end_b + size_b[y], f"{text_b},{name_b[y]}"
        else:
            groups.append(f"{text_a}|{text_b}")
            i, j = i + 1, j + 1
            if i == len(a):
                return ";".join(groups), len(groups), array("q", links).tobytes()
            x, y = a[i], b[j]
            end_a, end_b, text_a, text_b = end_a + size_a[x], end_b + size_b[y], name_a[x], name_b[y]


class Aligner:
    """Both tokenizers and the windows aligned so far; one per Python worker."""

    def __init__(self, whole: str, ranks: str, pieces: str):
        import sentencepiece

        self.encoder = Encoder(whole, ranks)
        # The strings of special tokens are plain text here, on the fast path as well.
        self.encoder.tokenizer.encode_special_tokens = True
        self.encoder.added = lambda text: None
        byte_of = _byte_of()
        known = self.encoder.tokenizer
        size = known.get_vocab_size(with_added_tokens=True)
        tokens = (known.id_to_token(i) or "" for i in range(size))
        self.a = Side([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in tokens])
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b = Side([self._piece(i) for i in range(self.model.get_piece_size())])
        # Whether no piece reaches from a word into the next one.
        known = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.apart = not any(re.search(f"[^{_MARK}]{_MARK}", piece) for piece in known)
        # Words and windows met lately, and those met before: the ones that come back stay.
        self.memo: dict[str, Spelt] | dict[bytes, Window] = {}
        self.earlier: dict[str, Spelt] | dict[bytes, Window] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(_MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """All tokens of space + text on both sides, or nothing where either does not spell it.

        Plain texts are encoded from the ranks, which are faster and equal the tokenizer there;
        their tokens are runs of the text's own bytes, so only their length needs a look.
        """
        found: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, pieces in zip(texts, self.model.encode(texts, num_threads=1), strict=True):
            spaced = " " + text
            said, plain = spaced.encode(), PLAIN.fullmatch(text)
            ids = self.encoder.short(spaced) if plain else self._whole(spaced)
            a, b = np.array(ids, np.int32), np.array(pieces, np.int32)
            spelt = self.a.lengths[a].sum() == len(said) and (plain or self.a.spell(ids) == said)
            found.append((a, b) if spelt and self.b.spell(pieces) == said else None)
        return found

    def _whole(self, text: str) -> list[int]:
        return self.encoder.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def rows(self, texts: list[str]) -> list[Spelt | None]:
        """Each text aligned, or nothing where either side does not spell it.

        Where single spaces part a plain text, no token of either side reaches past a space, so
        both end there and the text's groups and links are those of its words, which come back
        far more often than texts do. All other texts are encoded whole.
        """
        parted = [t.split(" ") if self.apart and PLAIN.fullmatch(t) and not GAPS.search(f" {t} ") else None for t in texts]
        found = [words and [*map(self.memo.get, words)] for words in parted]
        missing = {w for words, known in zip(parted, found) if known and None in known for w, e in zip(words, known) if e is None}
        learnt = self._learn([*missing]) if missing else {}
        whole = iter(self.encode([t for t, words in zip(texts, parted) if words is None]))
        done: list[Spelt | None] = []
        for words, known in zip(parted, found):
            if words is None:
                sides = next(whole)
                windows = sides and [(0, 0, *w) for w in self.windows(*sides)]
                counts = (len(sides[0]), len(sides[1])) if sides else (0, 0)
            else:
                windows = [e or learnt[w] for w, e in zip(words, known)] if None in known else known
                windows = None if _UNSPELT in windows else windows
                counts = None
            if windows is None:
                done.append(None)
                continue
            n_a, n_b, groups, sizes, links = zip(*windows)
            counts = counts or (sum(n_a), sum(n_b))
            done.append((*counts, ";".join(groups), sum(sizes), b"".join(links)))
        return done

    def _learn(self, words: list[str]) -> dict[str, Spelt]:
        """Words that were not met lately, each aligned with the space before it."""
        found = {w: e for w in words if (e := self.earlier.get(w))}
        fresh = [w for w in words if w not in found]
        for word, pieces in zip(fresh, self.model.encode(fresh, num_threads=1), strict=True):
            spaced = f" {word}"
            said, ids = spaced.encode(), self.encoder.short(spaced)
            spelt = sum(map(self.a.sizes.__getitem__, ids)) == len(said) and self.b.spell(pieces) == said
            found[word] = (len(ids), len(pieces), *align(ids, pieces, self.a, self.b)) if spelt else _UNSPELT
        self.memo.update((w, e) for w, e in found.items() if e[0] + e[1] <= REMEMBERED)
        self._turn()
        return found

    def _turn(self) -> None:
        if len(self.memo) >= MEMO:
            self.memo, self.earlier = {}, self.memo

    def windows(self, a: np.ndarray, b: np.ndarray) -> list[Window]:
        """The aligned windows between anchors: shared ends before a token of either side
        that begins with a space, and the end of the text."""
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        at = np.searchsorted(ends_b, ends_a)
        anchored = ends_b[at] == ends_a
        anchored[:-1] &= self.a.spaced[a[1:]]
        anchored &= self.b.spaced[b[np.minimum(at + 1, len(b) - 1)]]
        anchored[-1] = True
        cuts = np.flatnonzero(anchored)
        raw_a, raw_b = a.tobytes(), (b + _OTHER).tobytes()
        to_a, to_b = ((cuts + 1) * 4).tolist(), ((at[cuts] + 1) * 4).tolist()
        from_a, from_b = [0, *to_a], [0, *to_b]
        keys = [raw_a[i:j] + raw_b[k:m] for i, j, k, m in zip(from_a, to_a, from_b, to_b)]
        found = [*map(self.memo.get, keys)]
        if None in found:
            for n, window in enumerate(found):
                if window is None:
                    ids = a[from_a[n] // 4 : to_a[n] // 4], b[from_b[n] // 4 : to_b[n] // 4]
                    found[n] = self._recalled(keys[n], *ids)
            self._turn()
        return found

    def _recalled(self, key: bytes, a: np.ndarray, b: np.ndarray) -> Window:
        """A window that was not met lately."""
        window = self.earlier.get(key) or align(a.tolist(), b.tolist(), self.a, self.b)
        if len(key) <= REMEMBERED * 4:
            self.memo[key] = window
        return window


@lru_cache(maxsize=1)
def aligner(whole: str, ranks: str, pieces: str) -> Aligner:
    return Aligner(whole, ranks, pieces)


def aligned(docs: DataFrame, *, vocabularies: tuple[str, str, str] | None = None, with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times[, groups]) per row.

    ``pairs`` holds the row's distinct linked id pairs, b * 2**32 + a, and ``times`` how many
    links hold each. Rows are told apart by nothing but their text: repeated or null ids get a
    row each. Null and empty texts, and texts that either tokenizer does not spell back, have
    no tokens: zeros, no pairs and an empty hash. A text is one sequence at any length; only its
    words or windows are remembered, about twice ``MEMO`` of up to ``REMEMBERED`` ids. ``vocabularies``
    names the byte-level tokenizer, its ranks and the piece model, at one place on all executors.
    """
    files = vocabularies or tuple(map(public_tokenizers.path, (*VOCABULARY, PIECES)))
    nothing = (0, 0, 0, 0, "", [], [])

    def run(batch):
        both, ids = aligner(*files), batch.column("doc_id").to_pylist()
        for at, raws in enumerate(batched(values(batch), TOGETHER)):
            texts = [(raw or b"").decode() for raw in raws]
            spelt = iter(both.rows([t for t in texts if t]))
            for key, text in zip(ids[at * TOGETHER :], texts):
                found = next(spelt) if text else None
                if found is None:
                    yield (key, *nothing, *(("",) if with_groups else ()))
                    continue
                n_a, n_b, groups, n_groups, raw = found
                links = np.frombuffer(raw, np.int64)
                pairs, times = np.unique(links, return_counts=True)
                sha = hashlib.sha256(groups.encode()).hexdigest()
                row = (key, n_a, n_b, n_groups, len(links), sha, pairs, times)
                yield (*row, groups) if with_groups else row

    types = {
        "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
        "groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64()),
    }
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
        " pairs array<long>, times array<long>"
    )
    if with_groups:
        types["groups"], schema = pa.string(), f"{schema}, groups string"
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(per_batch(run, types), schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): corpus-wide links of each id pair, and whether no pair of its B id has
    more. ``links`` has pair and times; a B id has at most as many pairs as A has ids."""
    counted = links.groupBy("pair").agg(F.sum("times").alias("n"))
    most = F.max("n").over(SqlWindow.partitionBy(F.shiftright("pair", 32)))
    return counted.withColumn("best", F.col("n") == most)


def alignment(docs: DataFrame, *, vocabularies: tuple[str, str, str] | None = None, scratch: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    Texts are tokenised and aligned once, in place; rows send on only their distinct pairs, whose
    corpus-wide counts are summed before the shuffle. Counts, which grow with the corpus, come back
    by a shuffled join at every size, whose hot pairs adaptive execution splits. See ``aligned`` for nulls, blanks and repeated ids; ties for the
    highest count all count as best; an empty table gives no rows.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    rows = aligned(docs, vocabularies=vocabularies).withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows, scratch, "aligned")
    each = F.explode(F.arrays_zip("pairs", "times")).alias("link")
    links = rows.select("row", each).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    counts = staged(pair_counts(links), scratch, "pairs")
    sums = links.join(counts.hint("shuffle_hash"), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """``alignment`` of whole ``documents`` with the public byte-level and piece vocabularies."""
    return alignment(spark.read.parquet(f"{folder}/documents.parquet"))
