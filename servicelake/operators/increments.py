"""Facts that follow the changes of a keyed table (M4, A3): signed counts that are added up, never recounted.

The performance fact needs, of all requests, only how many there are in each
group by day, closed or not, breach or not.  Such counts can be taken away as
well as added, so a change (old row, new row) counts as one less and one more,
and medians and ninetieth percentiles stay exact.  Each change set is a folder
of the state, named by its id: adding it again replaces the folder by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelake.operators import sla

COUNT = "_n"


def signed_histogram(changes: DataFrame, enrich: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The histogram of the new rows of ``changes`` less that of the replaced ones; ``enrich`` derives a row's measures."""
    more = sla.performance_histogram(enrich(changes.where("new IS NOT NULL").select("new.*")))
    less = sla.performance_histogram(enrich(changes.where("old IS NOT NULL").select("old.*")))
    return added_up(more.unionByName(less.withColumn(COUNT, -F.col(COUNT))))


def added_up(histogram: DataFrame) -> DataFrame:
    """Counts by all other columns, without those that come to nothing."""
    total = F.sum(COUNT).cast("bigint")
    return histogram.groupBy(*[c for c in histogram.columns if c != COUNT]).agg(total.alias(COUNT)).where(F.col(COUNT) != 0)


def add(state: str, change_id: str, delta: DataFrame) -> None:
    """Add a change set to the state; the same id counts once, however often it is added."""
    delta.write.mode("overwrite").parquet(f"{state.rstrip('/')}/change={change_id}")


def histogram(spark: SparkSession, state: str) -> DataFrame:
    """What all change sets of a state come to."""
    return added_up(spark.read.parquet(state).drop("change"))


def folded(spark: SparkSession, state: str, to: str) -> str:
    """A new state at ``to`` with one set instead of many; the old one stays as it is."""
    add(to, "folded", histogram(spark, state))
    return to


def performance(spark: SparkSession, state: str) -> DataFrame:
    """The performance fact, from the state alone: groups x 731 days at most, however many requests there are."""
    return sla.performance_of(histogram(spark, state))


def follow(table, source: DataFrame, change_id: str, state: str, enrich: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Merge ``source`` into a keyed table, the greater row of a key staying, and let the state follow; returns the changes.

    Run again with the same id it ends in the same table and state, wherever it
    was interrupted but for the moment that ``operators.keyed`` names.
    """
    changes = table.merge(source, change_id, latest=True)
    add(state, change_id, signed_histogram(changes, enrich))
    return changes
