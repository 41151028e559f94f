"""Alignment, hard negatives and decontamination against plain Python and SQL."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from waybill.llm import alignment, decontamination, negatives

DATA = Path("/root/testdata/sf0.001")
ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
# Extra columns whose names the operators use themselves.
CLASH = ["row", "pair", "times", "best", "rank", "score", "leaf", "key", "words", "size", "found", "block", "anchor"]


def with_clashes(df):
    return df.select("*", *(F.lit("x").alias(c) for c in CLASH))


# -- alignment ----------------------------------------------------------------------------

TEXTS = [
    (1, "The quick brown fox, the quick brown fox."),
    (1, "The quick brown fox, the quick brown fox."),
    (1, "another text under the same id"),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "  two  spaces\n\nand\ttabs \u00a0 here "),
    (6, "<|endoftext|> <s> </s> <unk> <0x41> stay plain"),
    (7, "a\u2581b is spelt otherwise"),
    (8, "Stra\u00dfe na\u00efve \u4f60\u597d\u4e16\u754c \U0001f642\U0001f642 e\u0301 \ufeffx"),
    (9, "x" * 3000),
    (10, "lorem ipsum dolor " * 3000),
    (None, "nobody's text"),
]


def tokens_of(text):
    """Both sides as (id, bytes), by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    to_byte = {_shown(b): b for b in range(256)}
    out = []
    for x in text:
        if not x:
            out.append(([], []))
            continue
        a = [(i, bytes(to_byte[c] for c in known.id_to_token(i))) for i in known.encode(" " + x, add_special_tokens=False).ids]
        pieces = [(i, model.id_to_piece(i)) for i in model.encode(x)]
        b = [(i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("\u2581", " ").encode()) for i, p in pieces]
        same = all(b"".join(raw for _, raw in side) == (" " + x).encode() for side in (a, b))
        out.append((a, b) if same else ([], []))
    return out


def _shown(b: int) -> str:
    """The character by which a byte-level vocabulary shows a byte, found out by encoding it."""
    from tokenizers.pre_tokenizers import ByteLevel

    if b < 0x80:
        return ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0]
    if b < 0xC0:
        return ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(bytes([0xC2, b]).decode())[0][0][1]
    if b >= 0xF8 or b in (0xC0, 0xC1, 0xF5, 0xF6, 0xF7):
        return chr(b)
    follow = {0xE0: [0xA0, 0x80], 0xF0: [0x90, 0x80, 0x80], 0xF4: [0x80, 0x80, 0x80]}
    rest = follow.get(b) or [0x80] * (1 if b < 0xE0 else 2 if b < 0xF0 else 3)
    return ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(bytes([b, *rest]).decode())[0][0][0]


def test_alignment_of_unlike_texts(spark):
    docs = with_clashes(spark.createDataFrame(TEXTS, "doc_id long, text string"))
    short = docs.filter("doc_id IS NULL OR doc_id < 10")
    found = sorted(map(repr, ([r["doc_id"], *(r[c] for c in ALIGNED)] for r in alignment.alignment(short).collect())))
    kept = [t for t in TEXTS if t[0] != 10]
    want = plain.alignment(tokens_of([t for _, t in kept]))
    assert found == sorted(repr([key, *row]) for (key, _), row in zip(kept, want, strict=True))
    blank = {r["doc_id"]: r for r in alignment.aligned(docs, with_groups=True).collect()}
    assert all(blank[i]["n_a"] == blank[i]["n_links"] == 0 and blank[i]["groups_sha256"] == "" for i in (2, 3, 7))
    assert blank[10]["n_groups"] > 3000 and blank[4]["n_a"] > 0
    assert alignment.alignment(docs.limit(0)).collect() == []


def test_alignment_of_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet' ORDER BY length(text) LIMIT 120").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: tuple(r[c] for c in ALIGNED) for r in alignment.alignment(docs).collect()}
    want = plain.alignment(tokens_of([t for _, t in rows]))
    assert found == {key: row for (key, _), row in zip(rows, want, strict=True)}


def test_alignment_does_not_depend_on_its_memory(spark, monkeypatch):
    files = tuple(map(public_tokenizers.path, (*alignment.VOCABULARY, alignment.PIECES)))
    texts = [t for _, t in TEXTS if t and "\u2581" not in t]

    def all_windows():
        both = alignment.Aligner(*files)
        return [[w[:2] for w in both.windows(*sides)] for sides in both.encode(texts)]

    want = all_windows()
    monkeypatch.setattr(alignment, "MEMO", 3)
    assert all_windows() == want


def test_alignment_encodes_a_word_once(spark):
    files = tuple(map(public_tokenizers.path, (*alignment.VOCABULARY, alignment.PIECES)))
    both, rng = alignment.Aligner(*files), random.Random(4)
    encoded, short = [], both.encoder.short
    both.encoder.short = lambda text: encoded.append(text) or short(text)
    known = ["word", "it's", "don't\n\nstop", "x\ty", "caf\u00e9", "<|endoftext|>", "<s>", "1,234.5", "\u00a1"]
    texts = [" ".join(rng.choices(known, k=30)) for _ in range(40)]
    found = both.rows(texts) + both.rows(texts)
    assert sorted(encoded) == sorted(f" {w}" for w in known)
    # Spaces together, at an end or beside other white space: whole texts, as all were once.
    texts += ["", " ", "a  b", " a", "a ", "a \nb", "a\n b", "\n", "\u65e5 a", "a\u00a0b c"]
    parts = [both.rows([t])[0] for t in texts if t]
    both.apart = False
    assert parts == both.rows([t for t in texts if t]) and found == parts[:40] * 2


# -- hard negatives -----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def mined(spark, rows, **settings):
    frame = with_clashes(spark.createDataFrame([(k, v, x) for k, x, v in rows], VECTORS))
    found = negatives.hard_negatives(frame, F.expr("vec_id % 100 = 0"), **settings)
    return sorted(map(tuple, found.collect()))


def clustered(n, width, clusters, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width)) * 3
    near = centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, width)) * 0.05
    return [(i, int(rng.integers(0, 10)), v.tolist()) for i, v in enumerate(near)]


@pytest.mark.parametrize("kind", ["clustered", "copies", "ties"])
def test_hard_negatives(spark, kind):
    rows = clustered(1500, 8, 12, 3)
    if kind == "copies":
        rows = [(i, x, rows[0][2] if i % 3 == 0 else v) for i, x, v in rows]
    if kind == "ties":
        rows = [(i, x, [round(c / 2) * 2 / 256 for c in v]) for i, x, v in rows]
    want = plain.hard_negatives(rows)
    assert want and mined(spark, rows) == want


def test_hard_negatives_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(100, 1, None), (200, None, [1.0, 2.0]), (300, 1, [nan, 1.0]), (301, 1, [inf, 1.0]), (302, 1, [None, 1.0]),
           (None, 1, [1.0, 1.0]), (400, 2, []), (500, 3, [0.0, 0.0]), (600, 4, [-1.0, -1.0])]
    good = [(i, i % 3, [float(i % 5), 1.0 + i % 2]) for i in range(60)]
    padded = [(k, x, None if v is None else v + [0.0] * (2 - len(v))) for k, x, v in odd]
    assert mined(spark, odd + good + good) == plain.hard_negatives(padded + good)
    assert mined(spark, []) == mined(spark, [(7, 1, [1.0])]) == mined(spark, [(100, 1, [])]) == []


def test_hard_negatives_of_large_numbers(spark):
    rng = random.Random(5)
    rows = [(i, i % 3, [rng.uniform(1, 2) * 10.0**9 for _ in range(4)]) for i in range(150)]
    want = plain.hard_negatives(rows)
    most = (1 << 63) - 1
    assert mined(spark, rows) == [(*w[:4], min(w[4], most), min(w[5], most)) for w in want]
    assert mined(spark, [(0, 1, [1e200]), (1, 1, [1e200]), (2, 2, [1e-200]), (3, 2, [1e307])]) == []


def test_anchors_in_blocks_and_leaves_ruled_out(spark, monkeypatch):
    rows = clustered(4000, 6, 40, 9)
    want = plain.hard_negatives(rows)
    monkeypatch.setattr(negatives, "ANCHORS", 9)
    assert mined(spark, rows) == want
    x = np.floor(256 * np.array([v for _, _, v in rows]))
    reach = float(np.sqrt((x * x).sum(1).max()))
    tree = negatives.grown(x[:1000], reach)
    leaf, low, high = tree.descend(x)
    tree = negatives.replace(tree, low=low, high=high)
    anchors = x[::100]
    scores = anchors @ x.T
    best = np.sort(scores, 1)[:, -20]
    alive = tree.surviving(anchors, best, scores.max(1))
    for i in range(len(anchors)):
        assert alive[i, leaf[scores[i] >= best[i]]].all()
    assert alive.mean() < 0.7 and tree.leaves > 20


# -- decontamination ----------------------------------------------------------------------


def checked(spark, rows, items):
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    benchmark = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    found = decontamination.decontaminated(docs, benchmark)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted(map(repr, ([r[c] for c in columns] for r in found.collect())))
    want = []
    for key, n, hit, names in plain.decontaminate(rows, items):
        count = len(names.split(",")) if names else 0
        want.append([key, n, hit, count, plain.hashlib.sha256(names.encode()).hexdigest(), hit > 0])
    assert got == sorted(map(repr, want))
    return want


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def test_decontamination(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 80)))) for i in range(150)]
    rows += [(1000 + i, f"start {i}, {PASSAGE.upper()}! end {i}") for i in range(80)]
    rows += [(1, PASSAGE), (None, PASSAGE), (2, None), (3, ""), (4, "?! ..."), (5, "alpha BETA"), (5, "alpha-beta"), (6, "alpha gamma beta")]
    rows += [(7, "solo " * 30), (8, "na\u00efve \u00c9cole"), (9, ("filler " * 5000) + PASSAGE + " solo")]
    rows += [(10, "one two three four five six seven eight nine. ten"), (10, "one two three four five six seven eight nine")]
    items = [(1, PASSAGE), (2, " ".join(PASSAGE.split()[2:])), (10, "Alpha, beta."), (9, "solo"), (3, None), (4, "..."), (None, "w1 w2")]
    items += [(11, "na\u00efve \u00c9cole"), (12, "na\u00efve \u00e9cole"), (13, " ".join(rows[0][1].split()[:10])), (1, "w3 w4 w5")]
    items += [(14, " ".join(["w7"] * 10)), (15, PASSAGE + " never said")]
    want = checked(spark, rows, items)
    assert sum(w[-1] for w in want) > 90
    checked(spark, rows[:20], [(1, None)])
    assert decontamination.decontaminated(*(spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))).collect() == []


@pytest.mark.parametrize("n", [5, 100_000])
def test_key_filter_never_loses_a_key(spark, n):
    keys = spark.range(n).select(F.xxhash64("id").alias("key"))
    passing = decontamination.KeyFilter(keys).passing
    held = np.array([r["key"] for r in keys.collect()])
    assert len(passing(held)) == n
    assert len(passing(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 10_000))) < 1000
