"""Driver base table: one row per driver with race, pit-stop, lap and constructor features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import exact_mean, exact_sum, safe_divide, total_parts
from abacist.operators.aggregates import freq_encode
from abacist.operators.prep import bucket, fill_zero, label_at_least, null_flags
from abacist.operators.relational import star_left


def result_features(results: DataFrame, constructors: Sequence) -> DataFrame:
    """All result features and the constructor pivot of a driver in one aggregation.

    What would be six grouped tables joined on the driver is one pass with conditional counts.
    """
    return results.groupBy("driverId").agg(
        exact_sum("points").alias("TotalDriverPoints"),
        F.round(exact_mean("laps"), 2).alias("avgLaps"),
        F.round(exact_mean("milliseconds"), 2).alias("avgFinalTime"),
        F.round(exact_mean("fastestLapSpeed"), 2).alias("avgFastestLapSpeed"),
        F.count(F.when(F.col("statusId") == 1, F.col("raceId"))).alias("finishedRace"),
        F.count_if(F.col("fastestLapTime").isNull()).alias("fastestLapTime_NA"),
        F.count_if(F.col("milliseconds").isNull()).alias("finalMilliseconds_NA"),
        F.count_if(F.col("rank") <= 5).alias("fastestLapRank_5"),
        F.count("raceId").alias("NbrOfRace"),
        *[F.count_if(F.col("constructorId") == F.lit(c)).alias(f"constructor_{c}") for c in constructors],
    )


def pit_features(pit_stops: DataFrame) -> DataFrame:
    return pit_stops.groupBy("driverId").agg(
        F.round(exact_mean("milliseconds"), 2).alias("avgPitStopDuration"), F.count("stop").alias("NbrOfStops")
    )


def lap_features(races: DataFrame, lap_times: DataFrame, year: int = 2018) -> DataFrame:
    """Years since the driver's first race in the data and mean lap time.

    Laps are reduced per driver and race before the race year is joined on.
    """
    plain, rest = total_parts("milliseconds")
    per_race = lap_times.groupBy("driverId", "raceId").agg(
        plain.alias("ms"), rest.alias("rest"), F.count("milliseconds").alias("laps")
    )
    total = F.coalesce(F.sum("ms").cast("double"), F.lit(0.0)) + F.coalesce(exact_sum("rest"), F.lit(0.0))
    return per_race.join(races.select("raceId", "year"), "raceId").groupBy("driverId").agg(
        F.max(F.lit(year) - F.col("year")).alias("raceYearDiff"),
        safe_divide(F.when(F.sum("laps") > 0, total), F.sum("laps")).alias("avgLapTime"),
    )


def driver_basetable(
    drivers: DataFrame, results: DataFrame, pit_stops: DataFrame, races: DataFrame, lap_times: DataFrame,
    constructors: Sequence, year: int = 2018,
) -> DataFrame:
    base = freq_encode(drivers.withColumnRenamed("nationality", "driverNationality"), "driverNationality")
    made = null_flags(result_features(results, constructors), ["avgFinalTime", "avgFastestLapSpeed"])
    joined = star_left(
        base, [pit_features(pit_stops), lap_features(races, lap_times, year), fill_zero(made)], "driverId"
    )
    flagged = null_flags(joined, ["avgPitStopDuration", "NbrOfStops", "raceYearDiff", "avgLapTime"])
    late = ["avgPitStopDuration", "NbrOfStops", "raceYearDiff", "avgLapTime"]
    filled = fill_zero(flagged, late)
    return (
        fill_zero(
            filled.withColumn("ratioStops", safe_divide("NbrOfStops", "NbrOfRace"))
            .withColumn("target", label_at_least("finishedRace", 1))
            .withColumn("stopCat", bucket("ratioStops", [0, 1, 2]))
        ).drop("finishedRace", "avgFinalTime", "avgFinalTime_NA")
    )
