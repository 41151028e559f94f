"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waybill.llm import language, lm, mixing, neighbours, packing, quality, rules, sharding, simhash, substring
from waybill.llm.packing import pack, pieces

LONG = "lorem ipsum dolor sit amet " * 4000
ROWS = [
    (1, "a plain text of some words, seen twice here.", "en", "s", 1),
    (1, "a plain text of some words, seen twice here.", "en", "s", 1),
    (2, "a plain text of some words, seen twice here.", "en", "s", 1),
    (3, None, "en", "s", None),
    (4, "", None, None, 0),
    (5, " \t\n", "de", None, 3),
    (6, LONG, "de", "t", len(LONG)),
    (7, LONG, "de", "t", len(LONG)),
    (None, "nobody knows whose this is", "en", None, 1),
    (8, None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["rank", "score", "size", "bits", "shard", "position", "kept", "spans", "block", "words", "votes", "_nth", "root"]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    return plain.select("*", *(F.lit("x").alias(c) for c in CLASH))


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (6, 0), (7, 0), (2, 1)], "doc_id long, quality int")


OPERATORS = {
    "quality": lambda d, x: quality.classify(d, x),
    "sharding": lambda d, x: sharding.shard(d, sharding.even_tree()),
    "rules": lambda d, x: rules.judge(d),
    "simhash": lambda d, x: simhash.near_duplicates(d),
    "mixing": lambda d, x: mixing.curriculum(d, expand=False),
    "lm": lambda d, x: lm.score(d),
    "packing": lambda d, x: pack(pieces(d)),
    "language": lambda d, x: language.identify(d, F.lit(True)),
    "summaries": lambda d, x: substring.repeated_spans(d)["summaries"],
}


@pytest.fixture(scope="module")
def found(docs, labels):
    known = {}

    def get(name):
        if name not in known:
            known[name] = OPERATORS[name](docs, labels).collect()
        return known[name]

    return get


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(found, none, labels, name):
    rows = found(name)
    assert len([r for r in rows if name != "packing" or r["piece"] == 0]) == len(ROWS)
    assert OPERATORS[name](none, labels.limit(0)).collect() == []


def test_blank_texts(found):
    def of(name, column):
        return {r[column] for r in found(name) if r["doc_id"] in (3, 4, 8)}

    assert of("simhash", "component_id") == {3}
    assert of("rules", "kept") == {False}
    assert of("language", "lang_pred") == {"und"}
    assert of("packing", "length") == {1}
    assert of("lm", "log_prob") == {0.0}
    assert len(of("quality", "score")) == 1


def test_repeated_passages_in_copies(docs):
    left = substring.without_repeats(docs).collect()
    assert {r["text"] for r in left if r["doc_id"] in (6, 7)} == {LONG}
    assert len(left) == len(ROWS) - 1


def test_no_labels_give_one_score(docs, labels):
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_stages_keep_columns(docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(docs.sparkSession, table, str(tmp_path))
            assert stage is corpus_pipeline.pack_sequences or out.columns == docs.columns
            assert (out.count() == 0) == (table is not docs)


def test_one_of_copies_stays(docs):
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs)).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 3, 6]


PASSAGE = " ".join(f"p{i}" for i in range(60))
OTHER = " ".join(f"o{i}" for i in range(100))


@pytest.mark.parametrize(
    "given, left",
    [
        ([(1, PASSAGE), (2, PASSAGE), (2, OTHER)], [(1, PASSAGE), (2, OTHER)]),
        ([(1, PASSAGE), (2, "x " + PASSAGE), (2, OTHER)], [(1, PASSAGE), (2, "x"), (2, OTHER)]),
        ([(2, PASSAGE), (2, OTHER + " " + PASSAGE)], [(2, PASSAGE), (2, OTHER + " " + PASSAGE)]),
        ([(1, PASSAGE), (2, OTHER + " " + PASSAGE), (2, OTHER + " " + PASSAGE)], [(1, PASSAGE), (2, OTHER), (2, OTHER)]),
        ([(None, PASSAGE), (1, PASSAGE), (None, OTHER)], [(None, PASSAGE), (1, PASSAGE), (None, OTHER)]),
    ],
)
def test_repeated_ids_lose_only_what_repeats(spark, given, left):
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in given], SCHEMA)
    key = lambda r: (r[0] or 0, r[1])
    found = substring.without_repeats(docs).select("doc_id", "text").collect()
    assert sorted(map(tuple, found), key=key) == sorted(left, key=key)


def test_one_id_with_several_texts(spark):
    near = OTHER + " and one more word"
    rows = [(1, PASSAGE), (2, PASSAGE), (2, OTHER), (2, OTHER), (None, PASSAGE), (None, LONG), (None, LONG), (3, near)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    classes = simhash.near_duplicates(docs)
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_one(docs, classes).collect()]
    prints = {t: r["bits"] for r in classes.collect() for t in (PASSAGE, OTHER, near) if r["row"] == _key(spark, t)}
    together = (prints[OTHER] ^ prints[near]).__and__((1 << 64) - 1).bit_count() <= 2
    want = [(1, PASSAGE), (2, OTHER), (None, LONG)] + ([] if together else [(3, near)])
    assert sorted(kept, key=str) == sorted(want, key=str)


def _key(spark, text):
    return spark.createDataFrame([(text,)], "text string").select(F.xxhash64("text")).first()[0]


@pytest.mark.parametrize("same", [4096, 2])
def test_a_mix_gives_each_row_its_own_copies(spark, monkeypatch, same):
    monkeypatch.setattr(mixing, "SAME", same)
    rows = [(None, "a b c", "en", "s", 1), (None, "d e", "en", "s", 1), (None, "f", "en", "t", 1), (None, "", "en", "t", 1)]
    rows += [(5, "g h i j", "en", "u", 1)] * 9 + [(5, "k", "en", "u", 1), (5, "g h i j", "en", None, 1), (6, None, None, "u", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("positions", F.lit(0))
    told = {}
    for r in mixing.curriculum(docs, expand=False).collect():
        told[r["source"]] = told.get(r["source"], 0) + r["taken"]
    mixed = mixing.mixed_documents(docs)
    given = {}
    for r in mixed.collect():
        given[r["source"]] = given.get(r["source"], 0) + len((r["text"] or "").split())
    assert mixed.columns == docs.columns
    assert {s: n for s, n in told.items() if n} == {s: n for s, n in given.items() if n}
    assert mixing.mixed_documents(docs.limit(0)).collect() == []


def test_vectors_of_any_magnitude(spark):
    """Cosines of tiny and huge vectors equal those of the same vectors scaled to one."""
    shapes = [[3.0, 4.0], [4.0, 3.0], [1.0, 0.0], [0.0, -2.0]]
    scales = [2.0**-1060, 2.0**-664, 1.0, 2.0**700, 2.0**1021]
    rows = [(i * 4 + j, [x * s for x in shape]) for i, s in enumerate(scales) for j, shape in enumerate(shapes)]
    rows += [(100, [1e-200, 0.0]), (101, [1e200, 0.0]), (102, [5e-324, 0.0]), (103, [1e308, 1e-308])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, F.lit(True)).collect()
    assert len(found) == 5 * len(rows) and all(-1.0000001 <= r["score"] <= 1.0000001 for r in found)
    by = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 12)) for r in found}
    assert [by[0, k] for k in range(1, 6)] == [(4, 1.0), (8, 1.0), (12, 1.0), (16, 1.0), (1, 0.96)]
    assert [by[2, k] for k in range(1, 6)] == [(v, 1.0) for v in (6, 10, 14, 18, 100)]
    assert by[101, 1] == (2, 1.0) and by[102, 1] == (2, 1.0)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [1.0, None]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0, 0.0]), (9, []), (10, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    found = neighbours.nearest(vectors, F.lit(True)).collect()
    got = {}
    for r in sorted(found):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 10, 2], 1: [0, 10, 2], 2: [0, 1, 10], 10: [0, 1, 2]}
    assert neighbours.nearest(vectors.limit(0), F.lit(True)).collect() == []


def test_equal_sizes_and_ids_are_told_apart_by_place_only(spark):
    same = spark.createDataFrame([(1, "one two three", None, None, 1)] * 6, SCHEMA)
    slots = sharding.shard(same, sharding.even_tree()).collect()
    assert sorted(r["slot"] for r in slots) == list(range(6))
    packed = packing.pack(packing.pieces(same)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == 6
