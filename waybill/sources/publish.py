"""Publication of a month: every attempt in its own folder, a ledger that says which counts.

An attempt writes all its tables and files into a folder no other attempt uses. The last
thing it does is to append one record to the ledger, in one file that is renamed into place.
Readers ask the ledger for the newest record of a month and read that attempt's folder, so
they see all of the earlier run or all of the later one; an attempt that fails changes
nothing that anyone reads. Folders of superseded and failed attempts stay until ``expire``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.labels import month_of_file
from waybill.functions.numeric import text
from waybill.sources import sinks

# Fixed value: the name of the table whose file tells a month.
EXECUTIVE = "executive_summary_kpis"
LEDGER = (
    "label string, run string, finished timestamp, summary string,"
    " total_records bigint, clean_records bigint, quarantined_records bigint"
)


class MissingOutput(FileNotFoundError):
    """A month whose outputs were never published."""


@dataclass(frozen=True)
class Attempt:
    """One run of one month: writers into its folder."""

    spark: SparkSession
    out: str
    label: str
    run: str

    @property
    def folder(self) -> str:
        return f"{self.out}/runs/{self.label}/{self.run}"

    def table(self, df: DataFrame, name: str, *, rebalance: bool = False) -> DataFrame:
        """A Parquet table; gives what was written. ``rebalance`` exchanges the rows into files
        of the advisory size, and sorts each task's rows for it: use it where a filter leaves each
        task little and the rows are few, for it moves and spills several times their size."""
        return sinks.staged(df.hint("rebalance") if rebalance else df, self.folder, name)

    def path(self, name: str, kind: str) -> str:
        return f"{self.folder}/outputs/{name}_{self.label}.{kind}"

    def kpi(self, df: DataFrame, name: str) -> str:
        """A KPI table (a few hundred rows at most) as one CSV file; its path."""
        return sinks.write_csv(df, self.path(name, "csv"))

    def report(self, df: DataFrame, name: str) -> str:
        return sinks.write_json(df, self.path(name, "json"))

    def commit(self, counts: DataFrame | None = None) -> None:
        """From here on, this is the month. ``counts`` has the audit's one row."""
        row = counts if counts is not None else self.spark.range(1)
        numbers = ("total_records", "clean_records", "quarantined_records")
        record = row.select(
            F.lit(self.label).alias("label"),
            F.lit(self.run).alias("run"),
            F.current_timestamp().alias("finished"),
            F.lit(self.path(EXECUTIVE, "csv")).alias("summary"),
            *(F.col(n) if n in row.columns else F.lit(None).cast("bigint").alias(n) for n in numbers),
        )
        append(record, self.out)


def begin(spark: SparkSession, out: str, label: str) -> Attempt:
    """Writes nothing yet."""
    return Attempt(spark, out, label, f"{spark.sparkContext.applicationId}-{os.urandom(4).hex()}")


def append(records: DataFrame, out: str) -> None:
    """Append records of finished attempts as one file."""
    records.coalesce(1).write.mode("append").json(f"{out}/ledger")


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """All records; none where nothing was published yet."""
    try:
        return spark.read.schema(LEDGER).json(f"{out}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def current(records: DataFrame) -> DataFrame:
    """The newest record of each month; of those finished at once, the greatest run."""
    newest = "row_number() OVER (PARTITION BY label ORDER BY finished DESC, run DESC) AS newest"
    return records.selectExpr("*", newest).filter("newest = 1").drop("newest")


def committed(spark: SparkSession, out: str, label: str) -> Attempt:
    """The attempt that counts for a month."""
    found = current(ledger(spark, out).filter(F.col("label") == label)).first()
    if found is None:
        raise MissingOutput(f"no output for {label} in {out}; run that month first")
    return Attempt(spark, out, label, found["run"])


def read_table(spark: SparkSession, out: str, name: str, label: str) -> DataFrame:
    """A Parquet table of a published month."""
    return spark.read.parquet(f"{committed(spark, out, label).folder}/{name}")


def latest_month(spark: SparkSession, out: str, default: str) -> DataFrame:
    """The month published last, or ``default``; of those finished at the same time, the
    latest month."""
    month = month_of_file("summary", EXECUTIVE)
    newest = current(ledger(spark, out)).agg(F.expr(f"max(struct(finished, {month} AS month)).month AS month"))
    return newest.selectExpr(f"coalesce(month, {text(default)}) AS month")


def expire(spark: SparkSession, out: str, label: str) -> int:
    """Remove the folders of all attempts at a month but the one that counts; how many. Not
    to be called while one is running."""
    kept = committed(spark, out, label)
    files, place = sinks._located(spark, f"{out}/runs/{label}")
    old = [s.getPath() for s in files.listStatus(place) if s.getPath().getName() != kept.run]
    for path in old:
        files.delete(path, True)
    return len(old)
