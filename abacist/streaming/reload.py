"""Late web rows, taken up as files arrive: the days they touch are staged and rolled up again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.plans.web_warehouse import STAGING_SCHEMA, WAREHOUSE_SCHEMA, rollup
from abacist.session import materialise
from abacist.sources.reload import replace_partitions
from abacist.sources.tables import conform, ensure_table


def reload_batch(batch: DataFrame, staging: str, warehouse: str) -> None:
    """Add a batch to staging and rebuild the warehouse days it touches.

    Staged rows are distinct, so a batch that is delivered or replayed twice changes nothing. Only the
    partitions of the batch's days are read and replaced.
    """
    spark = batch.sparkSession
    fresh = materialise(conform(batch, STAGING_SCHEMA).distinct())
    days = [r[0] for r in fresh.select("date").distinct().collect()]
    if not days:
        return
    touched = F.col("date").isin(days)
    # written out before the overwrite, because a table cannot be overwritten while it is read
    merged = materialise(spark.table(staging).where(touched).unionByName(fresh).distinct())
    replace_partitions(merged, staging)
    replace_partitions(conform(rollup(spark.table(staging).where(touched)), WAREHOUSE_SCHEMA), warehouse)


def follow(
    spark: SparkSession, source: DataFrame, staging: str, warehouse: str, checkpoint: str,
    paths: Sequence[str | None] = (None, None),
) -> None:
    """Take up everything that has arrived since the last run, then stop."""
    ensure_table(spark, staging, STAGING_SCHEMA, ["date"], paths[0])
    ensure_table(spark, warehouse, WAREHOUSE_SCHEMA, ["date"], paths[1])
    run = (
        source.writeStream.foreachBatch(lambda batch, _: reload_batch(batch, staging, warehouse))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    run.awaitTermination()
