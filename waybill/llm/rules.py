"""Quality rules by weak supervision: rules vote, expectation-maximisation weighs them."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import words
from waybill.sources.sinks import scratch_folder, staged

WINDOW = 3
SYMBOLS = "#*$%&|<>"
ROUNDS = 20
KEEP = 0.5
#: The first share of good texts, and a rule's first accuracies on good and bad ones. They
#: also count as ``PRIOR`` votes beside those of the data.
SHARE, ON_GOOD, ON_BAD, PRIOR = 0.85, 0.95, 0.3, 10.0
#: A rule is never sure, and on good texts never worse than chance.
LEAST, MOST = 0.01, 0.999


@dataclass(frozen=True)
class Rule:
    """Two conditions on the statistics of a text; a rule abstains if neither holds."""

    name: str
    good: str
    bad: str

    @property
    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END").alias(self.name)


RULES = (
    Rule("length", "n_words >= 80", "n_words < 30"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 9 * n_words", "word_chars NOT BETWEEN 2 * n_words AND 14 * n_words"),
    Rule("symbols", "50 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    Rule("density", "200 * n_symbols <= word_chars", "15 * n_symbols > word_chars"),
    Rule("marked_words", "50 * n_marked <= n_words", "3 * n_marked > n_words"),
    Rule("lines", "20 * n_dup_lines <= n_lines", "4 * n_dup_lines > n_lines"),
    Rule("repetition", "10 * n_repeat_words <= n_words", "3 * n_repeat_words > n_words"),
    Rule("variety", "n_distinct >= 5 * sqrt(n_words)", "n_distinct < 2.5 * sqrt(n_words)"),
    Rule("capitals", "8 * n_upper <= word_chars", "2 * n_upper > word_chars"),
    Rule("sentences", "n_stops BETWEEN n_words / 60 AND n_words / 2", "n_shouts * 5 > n_words"),
    Rule("short_words", "n_short BETWEEN n_words / 10 AND n_words * 7 / 10", "n_short < n_words / 40"),
)


def _without(characters: str) -> Column:
    text = F.coalesce("text", F.lit(""))
    return F.length(F.translate(text, characters, ""))


def statistics(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """What the rules look at, from whole texts, a row per row of ``docs``.

    ``n_repeat_words`` counts words in windows of ``window`` words found twice or more:
    window hashes are sorted with their places, and the places with an equal neighbour
    cover up to ``window`` words each. Texts without such a window skip the sort.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.length(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    marked = F.filter("words", lambda w: F.translate(w, SYMBOLS, "") != w)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    counted = docs.select(
        "doc_id", words().alias("words"), lines.alias("lines"), _without(" \t\n\x0b\x0c\r").alias("word_chars"),
        (size - _without(SYMBOLS)).alias("n_symbols"), (size - _without(upper)).alias("n_upper"),
        (size - _without(".")).alias("n_stops"), (size - _without("!")).alias("n_shouts"),
    )
    counted = counted.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("words")
    grams = F.expr(
        f"CASE WHEN size(hashes) >= {window} THEN transform(sequence(0, size(hashes) - {window}),"
        f" i -> xxhash64({', '.join(f'hashes[i + {k}]' for k in range(window))})) ELSE array() END"
    )
    counted = counted.withColumn("grams", grams)
    counted = counted.withColumn("again", F.size(F.array_distinct("grams")) < F.size("grams"))
    ordered = F.expr("CASE WHEN again THEN array_sort(transform(grams, (g, i) -> struct(g AS g, i AS i))) END")
    counted = counted.withColumn("ordered", ordered)
    places = F.expr(
        "CASE WHEN again THEN array_sort(transform(filter(ordered, (x, i) ->"
        " x.g <=> get(ordered, i - 1).g OR x.g <=> get(ordered, i + 1).g), x -> x.i)) END"
    )
    counted = counted.withColumn("places", places)
    covered = F.expr(
        f"CASE WHEN again THEN aggregate(places, struct(0 AS n, {-window} AS last),"
        f" (a, p) -> struct(a.n + least({window}, p - a.last) AS n, p AS last), a -> a.n) ELSE 0 END"
    )
    return counted.select(
        "doc_id", *(c.cast("long").alias(name) for name, c in {
            "n_words": n, "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"),
            "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "n_repeat_words": covered,
            "n_lines": F.size("lines"), "n_distinct": F.size(F.array_distinct("hashes")), "n_upper": F.col("n_upper"),
            "n_marked": F.size(marked), "n_stops": F.col("n_stops"), "n_shouts": F.col("n_shouts"),
            "n_short": F.size(F.filter("words", lambda w: F.length(w) <= 3)),
        }.items())
    )


def _posterior(share: float, accuracy: dict[str, tuple[float, float]]) -> Column:
    """The probability that a text is good, given its votes.

    ``accuracy`` holds how often a rule that votes is right on good and on bad texts. Most
    rules see one fault, so a vote against a text says far more than one for it.
    """
    total = F.lit(log(share / (1 - share)))
    for name, (good, bad) in accuracy.items():
        vote = F.when(F.col(name) == 1, log(good / (1 - bad))).when(F.col(name) == -1, log((1 - good) / bad))
        total = total + vote.otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def estimate(
    votes: DataFrame, names: list[str], scratch: str, rounds: int = ROUNDS
) -> tuple[float, dict[str, tuple[float, float]]]:
    """The share of good texts and each rule's accuracies, by expectation-maximisation.

    Votes are counted by pattern once, at most 3 to the number of rules, and each round is a
    sum over patterns of which a single row reaches the driver. No votes leave the start.
    """
    patterns = staged(votes.groupBy(*names).agg(F.count("*").alias("n")), scratch, "patterns")
    share, accuracy = SHARE, dict.fromkeys(names, (ON_GOOD, ON_BAD))
    for _ in range(rounds):
        p = _posterior(share, accuracy)
        weighed = patterns.withColumn("good", F.col("n") * p).withColumn("bad", F.col("n") - F.col("good"))
        sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
        for c in names:
            for kind, right in (("good", 1), ("bad", -1)):
                weight = F.col(kind)
                sums.append(F.sum(F.when(F.col(c) == right, weight).otherwise(0.0)).alias(f"right_{kind}_{c}"))
                sums.append(F.sum(F.when(F.col(c) != 0, weight).otherwise(0.0)).alias(f"cast_{kind}_{c}"))
        row = weighed.agg(*sums).first()
        if not row["n"]:
            break

        def mean(kind: str, c: str, first: float, least: float) -> float:
            found = (row[f"right_{kind}_{c}"] + PRIOR * first) / (row[f"cast_{kind}_{c}"] + PRIOR)  # noqa: B023
            return round(min(MOST, max(least, found)), 9)

        before = (share, accuracy)
        share = round(min(MOST, max(0.5, (row["good"] + PRIOR * SHARE) / (row["n"] + PRIOR))), 9)
        accuracy = {c: (mean("good", c, ON_GOOD, 0.5), mean("bad", c, ON_BAD, LEAST)) for c in names}
        if before == (share, accuracy):
            break
    return share, accuracy


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, keep: float = KEEP, scratch: str | None = None) -> DataFrame:
    """The statistics with ``base_failed``, ``posterior`` and ``kept`` per row of ``docs``.

    Texts of fewer than 50 words, or with more than half of their words repeated, fail
    beforehand, and so do null and blank ones; they vote like the others. Otherwise a text
    is kept if its posterior probability of being good reaches ``keep``. The estimate is over
    all rows; rows that repeat an id count each. An empty table gives no rows.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    names = [r.name for r in rules]
    stats = statistics(docs)
    votes = staged(stats.select("*", *(r.vote for r in rules)), scratch, "votes")
    share, accuracy = estimate(votes, names, scratch)
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    found = votes.select("*", failed.alias("base_failed"), _posterior(share, accuracy).alias("posterior"))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))


def op3_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = judge(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )
