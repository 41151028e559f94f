"""Each operator against plain Python, held-out labels or an exact round trip."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import plain
from waybill.llm import catalog, common, lm, mixing, neighbours, packing, quality, sharding, simhash, substring
from waybill.llm.common import numbered, text_hashes, word_hashes
from waybill.llm.components import components

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def rows():
    found = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{DATA}/documents.parquet' ORDER BY 1")
    return found.fetchall()


@pytest.fixture(scope="module")
def result(spark):
    known = {}

    def get(name):
        if name not in known:
            known[name] = catalog.queries()[name](spark, str(DATA)).toPandas()
        return known[name]

    return get


def test_simhash(rows, result):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in result("op5_simhash").itertuples()}
    assert found == plain.simhash([r[:2] for r in rows])


def test_substring(rows, result):
    found = {r.doc_id: tuple(r)[2:] for r in result("op8_substring").itertuples()}
    assert found == plain.substring([r[:2] for r in rows])


def test_rules(rows, result):
    found = result("op3_rules").set_index("doc_id")
    for key, text, *_ in rows:
        row = found.loc[key]
        stats = plain.rule_statistics(text)
        assert stats == tuple(row[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]])
        assert row.base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert not (row.base_failed and row.kept)
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/labels.parquet'").fetchall()
    judged = [(q, found.loc[d].kept) for d, q in labels if not found.loc[d].base_failed]
    assert all(kept == bool(q) for q, kept in judged)


def test_language_model(rows, result):
    want = plain.backoff([r[:2] for r in rows])
    found = result("op7_lm").set_index("doc_id")
    for key, (n, log_prob) in want.items():
        assert found.loc[key].n_words == n
        assert found.loc[key].log_prob == pytest.approx(log_prob, rel=1e-9)


def test_language_model_of_trigrams(spark, rows, result):
    tokens = {key: plain.words(text) for key, text, *_ in rows}
    grams = lambda w, n: Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    counts = {n: sum((grams(w, n) for w in tokens.values()), Counter()) for n in (1, 2, 3)}
    found = result("op7_lm").set_index("doc_id")
    alone = lm.score(spark.read.parquet(f"{DATA}/documents.parquet"), order=3).toPandas().set_index("doc_id")
    total = sum(map(len, tokens.values()))
    for key, w in tokens.items():
        own = {n: grams(w, n) for n in (1, 2, 3)}
        others = lambda g: counts[len(g)][g] - own[len(g)][g]  # noqa: E731, B023
        log_prob, backed = 0.0, 0
        for i in range(len(w)):
            factor, first = 1.0, max(0, i - 2)
            backed += i > 0 and not others(tuple(w[first : i + 1]))
            while first < i and not others(tuple(w[first : i + 1])):
                factor, first = factor * 0.4, first + 1
            gram = tuple(w[first : i + 1])
            p = others(gram) / others(gram[:-1]) if first < i else max(others(gram), 0.5) / max(total - len(w), 1)
            log_prob += math.log(factor * p)
        row = found.loc[key]
        assert row.log_prob_3 == pytest.approx(log_prob, rel=1e-9) == alone.loc[key].log_prob
        assert row.n_backed_off_3 == backed == alone.loc[key].n_backed_off


def test_language_model_does_not_depend_on_blocks(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    some = lm.score(docs, block=F.col("doc_id") % 3).toPandas().set_index("doc_id").log_prob
    other = lm.score(docs, order=2).toPandas().set_index("doc_id").log_prob
    assert np.allclose(some.sort_index(), other.sort_index())


def test_lm_spreads_rows_without_an_id(spark, monkeypatch):
    texts = ["a b c", "b c d", "a b c", "", None, "c d e a b", "e", "b c"] * 3
    docs = spark.createDataFrame([(None if i % 4 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    columns = ["n_words", "log_prob", "n_backed_off", "n_unseen"]
    found = lambda d: sorted(map(tuple, d.select(*columns).collect()))
    whole = found(lm.score(docs, block=F.lit(0)))
    monkeypatch.setattr(lm, "BLOCK", 3)
    assert len(whole) == len(texts)
    assert np.allclose(found(lm.score(docs)), whole)


def test_lm_parts_blocks_of_many_bytes(spark, monkeypatch):
    """One id on a third of all rows, equal rows among them, and texts of 20,000 words."""
    rng = np.random.default_rng(3)
    made = lambda n, top: " ".join(f"w{x}" for x in rng.integers(0, top, n))
    rows = [(7, made(60, 40)) for _ in range(80)] + [(7, "same words here")] * 40
    rows += [(1000 * i, made(50, 60)) for i in range(230)] + [(i, made(20_000, 3000)) for i in range(8, 18)]
    want = sorted(plain.backoff(list(enumerate(t for _, t in rows))).values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (lm.BYTES, 20_000):
        monkeypatch.setattr(lm, "BYTES", size)
        found = sorted(map(tuple, lm.score(docs).select("n_words", "log_prob").collect()))
        assert [n for n, _ in found] == [n for n, _ in want]
        assert np.allclose(found, want)
    monkeypatch.setattr(lm, "FEW", 0)
    assert np.allclose(sorted(map(tuple, lm.score(docs).select("n_words", "log_prob").collect())), want)


def test_text_hashes_equal_those_of_each_text():
    texts = [b"", b"a b", b" \n ", b"c" * 50, b" a  b c ", b"", b"a"]
    for segment in (1, 8, 1 << 18):
        sizes, hashes = text_hashes(texts, segment)
        apart = [word_hashes(t) for t in texts]
        assert sizes.tolist() == [len(x) for x in apart]
        assert hashes.tolist() == np.concatenate(apart).tolist()


def test_mixing_against_sql(result):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = sorted(con.execute(catalog.oracle_sql()["op6_mixing"]).fetchall())
    got = result("op6_mixing")[["doc_id", "size", "source_size", "target", "taken", "copies", "position"]]
    got, want = (sorted(tuple(None if v != v else v for v in r) for r in t) for t in (got.itertuples(index=False, name=None), want))
    assert got == want


def test_mixing_positions_by_integration_and_bisection(rows, result):
    """Each source's rate is summed in small steps and its demand inverted by halving."""
    found = result("op6_mixing").set_index("doc_id")
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None]
    for nth, source in enumerate(names):
        start, finish = mixing.RAMPS[nth % 3]
        steps = 20_000
        rate = start + (finish - start) * (np.arange(steps) + 0.5) / steps
        demand = np.concatenate(([0.0], np.cumsum(rate))) / rate.sum()
        own = sorted((hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]) for r in rows if r[3] == source)
        upto = 0
        for _, doc in own:
            r = found.loc[doc]
            middle = upto + r["size"] / 2
            upto += r["size"]
            assert r.copies == sum(middle + k * r.source_size < r.target for k in range(5))
            if not r.copies:
                assert r.position != r.position
                continue
            low, high = 0, steps
            while high - low > 1:
                half = (low + high) // 2
                low, high = (half, high) if demand[half] <= middle / r.target else (low, half)
            assert low / steps - 1e-6 <= r.position <= high / steps + 1e-6


def test_mixing_meets_targets(rows, result):
    found = result("op6_mixing").assign(source=[dict((r[0], r[3]) for r in rows)[d] for d in result("op6_mixing").doc_id])
    assert (found.taken <= 3 * found["size"]).all()
    by = found.groupby("source").agg({"taken": "sum", "target": "first", "size": "max", "source_size": "first"})
    assert ((by.taken - by.target).abs() <= by["size"] / 2).all()
    assert (by.target <= 3 * by.source_size + 1e-6).all()
    assert by.target.sum() == pytest.approx(by.source_size.sum())


def test_sharding_against_plain_tree(spark, rows, result):
    """Every row's shard, also in trees of unequal weights, recomputed from XXH64 values."""
    found = result("op2_sharding").set_index("doc_id")
    tree = sharding.even_tree()
    grown = sharding.grown_tree(tree)
    for r in rows:
        assert found.shard[r[0]] == plain.tree_shard(str(r[0]), tree)
        assert found.grown_shard[r[0]] == plain.tree_shard(str(r[0]), grown)
    uneven = {"a": {"a0": {0: 3.0, 1: 0.0}, "a1": {2: 0.5}}, "b": {"b0": {3: 1.0, 4: 1.5, 5: 0.25}}}
    keys = spark.range(500).select(F.col("id").cast("string").alias("key"))
    for key, got in keys.select("key", sharding.descend(F.col("key"), uneven)).collect():
        assert got == plain.tree_shard(key, uneven)


def test_sharding(rows, result):
    found = result("op2_sharding")
    texts = {r[0]: r[1] for r in rows}
    for r in found.itertuples():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert found.shard.between(0, 23).all() and len(found) == len(rows)
    assert ((found.grown_shard == found.shard) | (found.grown_shard == 24)).all()
    for _, group in found.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))


def test_weights_confine_movement(spark):
    ids = spark.range(5000).withColumn("key", F.col("id").cast("string"))
    tree = sharding.even_tree()
    heavier = {r: {k: dict(s) for k, s in racks.items()} for r, racks in tree.items()}
    heavier["region-0"]["rack-0-0"][0] = 3.0
    found = ids.select(
        sharding.descend(F.col("key"), tree).alias("a"), sharding.descend(F.col("key"), heavier).alias("b")
    ).toPandas()
    moved = found[found.a != found.b]
    assert len(moved) and (moved.b < 12).all()  # into the region that grew
    inside = moved[(moved.a >= 4) & (moved.a < 12)]
    assert (inside.b < 4).all()  # and there into the rack that grew
    assert found.b.value_counts()[0] > 2 * found.b.value_counts()[20]


def test_packing_is_an_exact_round_trip(spark, rows):
    cut = packing.pieces(spark.read.parquet(f"{DATA}/documents.parquet"), with_ids=True)
    found = packing.pack(cut).toPandas().sort_values(["doc_id", "piece"])
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r[0]: r[1] or "" for r in rows}
    for key, group in found.groupby("doc_id"):
        ids = [*tokenizer.encode(texts[key], add_special_tokens=False).ids, 0]
        assert b"".join(group.ids) == np.array(ids, "<u4").tobytes()
        assert list(group.start) == [0, *group.length.cumsum()[:-1]]
        assert (group.length[1:] == 2048).all()
    for r in found.itertuples():
        assert zlib.crc32(r.ids) == r.ids_crc32
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert found.groupby("sequence_id").length.sum().max() <= 2048
    assert found.sequence_id.nunique() <= -(-found.length.sum() // 2048) + 1


@pytest.mark.parametrize(
    "text", ["", " ", "don't we'll  x\n\n y ²³ ½", "a \x1c b 日本語", "<|endoftext|> hi", "a   b\n c", " \nx", "_a 12b é\t\tq"]
)
def test_fast_encoder_equals_the_tokenizer(text):
    files = tuple(map(public_tokenizers.path, packing.VOCABULARY))
    known = packing.Encoder(*files)
    assert known.encode(text) == known.whole(text) == known.encode(text)


@pytest.mark.parametrize("text", ["<|endoftext|> hi", "a <|endoftext|>", "x<|endoftext|>\n y", "<|endoftext|", "two  words é"])
def test_encoder_equals_the_tokenizer_as_loaded(spark, text):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = loaded.encode(text, add_special_tokens=False).ids
    known = packing.Encoder(*map(public_tokenizers.path, packing.VOCABULARY))
    assert known.encode(text) == np.array(want, "<u4").tobytes()
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    piece = packing.pieces(docs, with_ids=True).first()
    assert (piece.ids, piece.length) == (np.array([*want, 0], "<u4").tobytes(), len(want) + 1)


def test_fullest_bin():
    assert sum(k * v for k, v in packing.fullest({7: 3, 5: 2, 2: 1}, 16).items()) == 16
    assert packing.fullest({9: 2}, 10) == {9: 1}
    assert packing.fullest({1: 100}, 10) == {1: 10}


def test_neighbours_recall(spark, result):
    found = result("op4_neighbours")
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.array(vectors.embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = vectors.vec_id.to_numpy()
    for query, group in found.groupby("query_id"):
        score = x @ x[ids == query][0]
        score[ids == query] = -2
        want = ids[np.lexsort((ids, -score.round(12)))[:5]]
        assert list(group.sort_values("rank").vec_id) == list(want)


def test_neighbours_beyond_one_block(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1500, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, F.col("vec_id") % 100 == 0, reach=100).toPandas()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for query, group in found.groupby("query_id"):
        score = x @ x[query]
        score[query] = -2
        hits += len(set(group.vec_id) & set(np.argsort(-score)[:5]))
    assert hits / 75 >= 0.9


@pytest.mark.parametrize("noise", [1e-2, 1e-4])
def test_neighbours_in_a_group_of_near_copies(spark, noise):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(3000, 16))
    x[::3] = x[0] + noise * draw.normal(size=(1000, 16))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, F.col("vec_id") % 60 == 0, reach=100).toPandas()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for query, group in found.groupby("query_id"):
        score = x @ x[query]
        score[query] = -2
        hits += len(set(group.vec_id) & set(np.argsort(-score)[:5]))
    assert hits / 250 >= 0.95


def test_neighbours_reach_follows_the_table(spark, monkeypatch):
    assert neighbours.reach_of(10_256) == 1024
    assert [neighbours.reach_of(4**i * 250_000) for i in range(3)] == [4000, 8000, 16_000]
    x = np.random.default_rng(5).normal(size=(3000, 32))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "REACH", 10)
    found = neighbours.nearest(vectors, F.col("vec_id") % 60 == 0).toPandas()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    score = x[::60] @ x.T
    want = {60 * i: set(np.argsort(-s)[1:6]) for i, s in enumerate(score)}
    assert sum(len(set(g.vec_id) & want[q]) for q, g in found.groupby("query_id")) / 250 >= 0.95


def test_hilbert_steps_to_neighbours():
    points = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    place = neighbours.hilbert(points, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = catalog.queries()["op1_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = found.filter("held_out").join(labels, "doc_id").toPandas()
    assert (held.predicted == held.quality).mean() >= 0.95
    assert held.score.between(0, 1).all()


def test_isotonic_is_monotone_and_keeps_the_mean():
    n = np.array([0, 4, 2, 0, 4, 1, 0])
    positive = np.array([0, 2, 0, 0, 3, 1, 0])
    level = quality.isotonic(n, positive)
    assert (np.diff(level) >= 0).all()
    assert (level * n).sum() == pytest.approx(positive.sum())


def test_language_on_held_out_rows(rows, result):
    found = result("op10_language").set_index("doc_id")
    langs = {r[0]: r[2] for r in rows}
    held = found[found.held_out]
    assert np.mean([langs[d] == p for d, p in held.lang_pred.items()]) >= 0.95


def test_components_of_a_long_chain(spark, tmp_path):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 99), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges, str(tmp_path)).collect()}
    assert found == {i: 0 for i in range(41)} | {99: 99, 100: 99}


def test_links_at_every_distance(spark):
    bits = [0, 1, 3, 7 << 10, 1 << 63, -1]
    prints = spark.createDataFrame([(b if b < 1 << 63 else b - (1 << 64),) for b in bits], "bits long")
    found = {tuple(sorted((r.a, r.b))) for r in simhash.links(prints).collect()}
    parents = {x for pair in found for x in pair}
    assert parents == {0, 1, 3, -(1 << 63)}


def test_numbered_counts_within_groups(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id")
    found = numbered(df, ["g"], ["id"], str(tmp_path), "n").toPandas()
    assert (found["rank"] == found.id // 3).all()


def test_word_hashes_do_not_depend_on_segments():
    raw = " ab\tcd  ab é\n".encode() * 9
    assert (word_hashes(raw, 7) == word_hashes(raw)).all()
    assert len(np.unique(word_hashes(raw))) == 3


@pytest.mark.parametrize(
    ("module", "call"),
    [
        (quality, lambda docs, to: quality.measured(docs, to)),
        (simhash, lambda docs, to: simhash.fingerprints(docs)),
        (substring, lambda docs, to: substring.summaries(docs)),
        (substring, lambda docs, to: substring.remaining(docs.withColumns({"row": F.lit(0), "spans": F.expr("array(struct(0 AS start, 1 AS end))")}))),
        (packing, lambda docs, to: packing.pieces(docs)),
    ],
    ids=["quality", "simhash", "substring", "remaining", "packing"],
)
def test_workers_are_sent_bounded_batches(spark, monkeypatch, tmp_path, module, call):
    limit, setting, per_batch = 2 * common.BATCH_BYTES, "spark.sql.execution.arrow.maxBytesPerBatch", common.per_batch

    def watched(fn, types):
        def run(batch):
            if batch.nbytes > limit:
                raise ValueError(f"a batch of {batch.nbytes} bytes")
            yield from fn(batch)

        return per_batch(run, types)

    monkeypatch.setattr(module, "per_batch", watched)
    spark.conf.unset(setting)
    docs = spark.range(200, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ")), 20_000).alias("text")
    )
    assert call(docs, str(tmp_path)).count() >= 200
    call(docs, str(tmp_path)).write.format("noop").mode("overwrite").save()


def test_windows_do_not_depend_on_batches(spark):
    docs = spark.range(300, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("row"),
        F.expr("array_join(transform(sequence(id % 7, id % 7 + 119), i -> concat('w', i)), ' ')").alias("text"),
    )
    anchors = substring.summaries(docs).select("doc_id", F.col("anchors").alias("shared"))
    setting, found = "spark.sql.execution.arrow.maxBytesPerBatch", []
    for size in ("1000", str(common.BATCH_BYTES), None):
        spark.conf.unset(setting)
        if size:
            spark.conf.set(setting, size)
        windows = substring.candidate_windows(docs.join(anchors, "doc_id"))
        assert spark.conf.get(setting) == (size or str(common.BATCH_BYTES))  # a session's own is kept
        found.append(sorted(map(tuple, windows.collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 300 * 71


def test_pipeline_against_plain_python(spark, rows):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    one = stage["simhash near-dedup"](spark, docs, str(DATA))
    classes = plain.simhash([r[:2] for r in rows])
    assert sorted(r.doc_id for r in one.select("doc_id").collect()) == sorted(d for d, c in classes.items() if d == c[1])
    cut = stage["substring dedup"](spark, docs, str(DATA)).toPandas()
    removed = plain.substring([r[:2] for r in rows])
    assert set(cut.doc_id) == {d for d, r in removed.items() if not r[0] or r[1] < r[0]}
    for r in cut.itertuples():
        assert len(plain.words(r.text)) == removed[r.doc_id][0] - removed[r.doc_id][1]
        assert r.n_chars == len(r.text)


def test_pipeline_runs(result):
    assert result("pipeline").groupby("sequence_id").length.sum().max() <= 2048
