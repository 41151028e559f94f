"""Mixing sources to target weights by a curriculum that changes over the training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.common import row_key
from waybill.sources.sinks import scratch_folder, staged

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
#: A source's rate at the start and the end of the training, one pair per weight.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: Hexadecimal digits of the order's hash that split a source into parts.
DIGITS = 3
#: Placed rows of one id, source and text that go to one task at most.
SAME = 4096
WORD = r"[^ \x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, row, size): the words of every whole text, 0 for a null one; ``row`` is
    a key of the text."""
    count = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", row_key().alias("row"), count.alias("size"))


def shares(sized: DataFrame, weights=WEIGHTS, most: float = MOST, ramps=RAMPS) -> DataFrame:
    """(source, source_size, target, start, finish), one row a source.

    Sources take ``weights`` in turn, in code point order with null last. Their targets
    share all words by weight; none exceeds ``most`` times its source, and what is above
    goes to the others by weight. Sorted by size for the weight, a source is at its bound if
    that lies under the level the rest would get; the first that isn't settles the level.
    The sums run over one row a source in one task: meant for up to some million sources.
    """
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (nth % len(xs)) + 1)
    each = each.select(
        "*", pick(weights).alias("weight"), pick([a for a, _ in ramps]).alias("start"),
        pick([b for _, b in ramps]).alias("finish"), (F.col("source_size") * F.lit(most)).alias("bound"),
    )
    by_ratio = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    used = F.coalesce(F.sum("bound").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(every).cast("double")
    each = each.withColumn("full", F.col("bound") / F.col("weight") <= (total - used) / open_)
    held = F.sum(F.when(F.col("full"), F.col("bound")).otherwise(0.0)).over(every)
    rest = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every)
    level = (total - held) * F.col("weight") / F.nullif(rest, F.lit(0.0))
    target = F.when(F.col("full"), F.col("bound")).otherwise(level)
    return each.select("source", "source_size", target.alias("target"), "start", "finish")


def moment(demand: Column, start: Column, finish: Column) -> Column:
    """When a source's cumulative demand reaches this share of its target, from 0 to 1.

    The rate runs in a line from ``start`` to ``finish``; its integral, scaled to 1 at the
    end, is a parabola, which is inverted in a form that holds for equal rates too.
    """
    area = demand * (start + finish) / 2
    return 2 * area / (start + F.sqrt(start * start + 2 * (finish - start) * area))


def _placed(docs: DataFrame, weights, most: float, ramps, scratch: str) -> DataFrame:
    """``curriculum`` by document, in no order, with the key of each text."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    key = _keyed("source")
    sized = sizes(docs).select("*", order.alias("draw"), key.alias("key"), F.substring(order, 1, DIGITS).alias("part"))
    sized = staged(sized, scratch, "sizes")
    parts = sized.groupBy("key", "part").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("part")) - F.col("n")
    parts = parts.select("key", "part", before.alias("before"))
    told = shares(sized, weights, most, ramps).withColumn("key", key).drop("source")
    inside = Window.partitionBy("key", "part").orderBy("draw", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sized.withColumn("upto", F.sum("size").over(inside))
    run = run.join(parts, ["key", "part"]).join(told, "key")
    middle = F.col("before") + F.col("upto") - F.col("size") / 2
    rounds = F.ceil((F.col("target") - middle) / F.nullif("source_size", F.lit(0)))
    copies = F.greatest(F.coalesce(rounds, F.lit(0)), F.lit(0)).cast("int")
    run = run.select("*", middle.alias("middle"), copies.alias("copies"))
    demand = lambda k: (F.col("middle") + k * F.col("source_size")) / F.col("target")
    at = lambda k: moment(demand(k), F.col("start"), F.col("finish"))
    places = F.transform(F.sequence(F.lit(0), F.col("copies") - 1), at)
    none = F.array().cast("array<double>")
    placed = run.select(
        "doc_id", "source", "row", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        F.when(F.col("copies") > 0, places).otherwise(none).alias("positions"),
    )
    return staged(placed, scratch, "placed")


def _keyed(column: str) -> Column:
    """A key that is never null, different for a null and for any value."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def curriculum(
    docs: DataFrame, *, weights=WEIGHTS, most: float = MOST, ramps=RAMPS, expand: bool = True, scratch: str | None = None
) -> DataFrame:
    """Training positions of ``docs``, range-sorted by position.

    A source's documents follow each other in the order of a hash of their ids, again from
    the front when they are used up, until its target is met: a copy is taken if its middle
    lies before the target, so the words taken differ from the target by half a document at
    most. ``expand`` gives a row (doc_id, copy, position and the columns below) per copy;
    otherwise there is a row per document with ``positions``, an array that may be empty.

    Columns: doc_id, source, size, source_size, target, taken. Null and blank texts have
    size 0 and take part with no words; null sources are one source; rows that repeat an id
    stand side by side and are placed each for itself; an empty table gives no rows.
    A source is split by the first digits of the hash, whose sums are added up beforehand,
    so no task needs all rows of a large source.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    placed = _placed(docs, weights, most, ramps, scratch).drop("row")
    if not expand:
        return placed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")
    each = placed.select("*", F.posexplode("positions").alias("copy", "position")).drop("positions")
    return each.orderBy("position", "doc_id", "copy")


def mixed_documents(docs: DataFrame, *, scratch: str | None = None) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, in training order.

    Rows find their positions by id, source and a key of the text, nulls included. Rows that
    agree in these share their positions, and one of them is given out for all. Such a group is
    joined in parts of ``SAME`` placed rows, so one of any size spreads over tasks. Null and
    blank texts have no words and come as often as their places lie before the target; an empty
    table gives no rows.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    fresh = lambda c: f"_{c}" + "_" * max(map(len, docs.columns))
    keys = {fresh("id"): _keyed("doc_id"), fresh("source"): _keyed("source")}
    same = [*keys, fresh("text")]
    nth, times, part, places, place = map(fresh, ("nth", "times", "part", "places", "place"))
    taken = _placed(docs, WEIGHTS, MOST, RAMPS, scratch).filter(F.size("positions") > 0).select(
        *(key.alias(name) for name, key in keys.items()), F.col("row").alias(same[-1]), F.col("positions").alias(places)
    )
    groups = taken.groupBy(*same).agg(F.count("*").alias(times), F.max(places).alias(places))
    groups = staged(groups, scratch, "groups")
    shown = docs.withColumns({**keys, same[-1]: row_key()})
    # Most keys have one row. The others are few or none, so their table is written apart: the
    # planner broadcasts it by its size or merges it.
    single = shown.join(groups.filter(F.col(times) == 1).drop(times), same)
    many = staged(groups.filter(F.col(times) > 1).drop(places), scratch, "many")
    parts = F.ceil(F.col(times) / SAME).cast("int")
    first = F.row_number().over(Window.partitionBy(*same).orderBy("text"))
    one = shown.join(many, same).withColumn(nth, first).filter(F.col(nth) == 1).drop(nth)
    one = one.withColumn(part, F.explode(F.sequence(F.lit(0), parts - 1))).drop(times)
    dealt = taken.join(many, same).withColumn(part, F.pmod(F.xxhash64(places), parts).cast("int")).drop(times)
    columns = [*docs.columns, *same, places]
    both = single.select(*columns).unionByName(one.join(dealt, [*same, part]).select(*columns))
    each = both.withColumn(place, F.explode(places))
    return each.orderBy(place, *same).select(*docs.columns)


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's share of the mix, its copies and the position of the first."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    placed = curriculum(docs, expand=False)
    return placed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.size("positions").alias("copies"), F.get("positions", F.lit(0)).alias("position"),
    )


OP6_SQL = """
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS draw,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), each AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         [1.5::DOUBLE, 1.0::DOUBLE, 0.5::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS start,
         [0.5::DOUBLE, 1.0::DOUBLE, 1.5::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS finish
  FROM sized GROUP BY source
), bounded AS (
  SELECT *, source_size * 3.0::DOUBLE AS bound, (sum(source_size) OVER ())::DOUBLE AS total FROM each
), judged AS (
  SELECT *, bound / weight <= (total - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_bound
  FROM bounded
), told AS (
  SELECT source, source_size, start, finish, CASE WHEN at_bound THEN bound ELSE
         (total - sum(CASE WHEN at_bound THEN bound ELSE 0.0 END) OVER ()) * weight
         / nullif(sum(CASE WHEN at_bound THEN 0.0 ELSE weight END) OVER (), 0.0) END AS target
  FROM judged
), run AS (
  SELECT doc_id, size, source, sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0::DOUBLE AS middle
  FROM sized
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
       CASE WHEN copies > 0 THEN 2 * area / (start + sqrt(start * start + 2 * (finish - start) * area)) END AS position
FROM (
  SELECT *, middle / target * (start + finish) / 2 AS area, CAST(greatest(coalesce(
         ceil((target - middle) / nullif(source_size, 0)), 0), 0) AS INTEGER) AS copies
  FROM run JOIN told ON run.source IS NOT DISTINCT FROM told.source
)
"""
