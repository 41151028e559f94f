"""Row order of finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sorted_small(table: DataFrame, *order) -> DataFrame:
    """Sort a finished table of at most a few hundred rows in one partition.

    A global sort would first sample its input, which runs the aggregation below it
    twice; here that aggregation keeps its own parallelism and runs once.
    """
    return table.repartition(1).sortWithinPartitions(*order)
