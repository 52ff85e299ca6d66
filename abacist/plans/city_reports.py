"""Eleven city statistics reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.operators.aggregates import remerge_sum
from abacist.operators.relational import fanout_mean, join_on_value, less_than_any, order, semi


def accidents_per_month(accidents: DataFrame) -> DataFrame:
    return order(accidents.groupBy("Month").agg(F.count("Id").alias("accidents")), ("accidents", True))


def accidents_per_weekday(accidents: DataFrame) -> DataFrame:
    return order(accidents.groupBy("Weekday").agg(F.count("Id").alias("accidents")), ("accidents", True))


def serious_by_part_of_day(accidents: DataFrame) -> DataFrame:
    """Parts of the day whose accidents with serious injuries number fewer than those with mild ones."""
    serious = accidents.where(F.col("Serious_Injuries") > 0).groupBy("Part_of_the_day").agg(
        F.count("Id").alias("accidents"), F.sum("Victims").alias("victims")
    )
    mild = accidents.where(F.col("Mild_Injuries") > 0).agg(F.count("Id").alias("n"))
    return less_than_any(serious, "accidents", mild, "n")


def mean_deaths_by_age(deaths: DataFrame, accidents: DataFrame) -> DataFrame:
    """Mean deaths per age over the district join; a district counts once per qualifying accident."""
    big = accidents.where(F.col("Vehicles_involved") > 2)
    return order(fanout_mean(big, deaths, "District_Name", "Age", "Number", "mean_deaths"), ("mean_deaths", True))


def births_at_stations(births: DataFrame, stations: DataFrame) -> DataFrame:
    """Births by gender in places with a station; each station of a place counts the births again.

    Both sides are collapsed per place, so places with many births and stations are not multiplied out.
    """
    place = ["district_name", "neighborhood_name"]
    sites = stations.groupBy(*place).agg(F.count(F.lit(1)).alias("sites"))
    sums = births.groupBy(*place, "gender").agg(F.sum("Number").alias("n"))
    joined = sums.join(sites, place).groupBy("gender").agg(F.sum(F.col("n") * F.col("sites")).alias("number"))
    return order(joined, ("number", True))


def districts_with_immigrants_and_deaths(immigrants: DataFrame, deaths: DataFrame, immigrants_over: int = 1000, deaths_over: int = 100) -> DataFrame:
    """Districts with many immigrants and many deaths, brought together again on the immigrant total.

    Districts with equal totals match each other, as the report defines it.
    """
    i = immigrants.where(F.col("Number") > immigrants_over).groupBy("District_Name").agg(F.sum("Number").alias("immigrants"))
    d = deaths.where(F.col("Number") > deaths_over).groupBy("District_Name").agg(F.sum("Number").alias("deaths"))
    both = i.join(d, "District_Name").select("immigrants", "deaths")
    return join_on_value(i, both, "immigrants").select("District_Name", "immigrants", "deaths")


def unemployment_by_gender(unemployment: DataFrame) -> DataFrame:
    return unemployment.groupBy("Gender").agg(F.sum("Number").alias("count"))


def names_before_1930(babies: DataFrame, frequent: DataFrame) -> DataFrame:
    """Names of the early decades with gender; the total is per name, whatever the gender."""
    early = frequent.where(F.col("Decade").contains("Before")).select(F.col("Name").alias("early_name"))
    kept = semi(babies, early, {"Name": "early_name"})
    return order(remerge_sum(kept, "Name", ["Gender"], "Frequency", "frequency_sum"), ("frequency_sum", True))


def neighbourhoods_with_underground(population: DataFrame, transports: DataFrame) -> DataFrame:
    served = transports.where(F.col("Transport").contains("Underground")).select(F.col("District_Name").alias("served"))
    return semi(population, served, {"District_Name": "served"}).groupBy("District_Name").agg(
        F.count("Neighborhood_Name").alias("neighbourhoods")
    )


def transport_counts(transports: DataFrame) -> DataFrame:
    return order(transports.groupBy("Transport").agg(F.count("Transport").alias("count")), ("count", False))


def stations_with_air_quality(quality: DataFrame, stations: DataFrame) -> DataFrame:
    cols = ["Station", "Longitude", "Latitude"]
    return quality.select(*cols).intersect(stations.select(*cols))


def run_city_reports(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All reports by name, from the city tables by name."""
    return {
        "accidents_per_month": accidents_per_month(t["accidents"]),
        "accidents_per_weekday": accidents_per_weekday(t["accidents"]),
        "serious_by_part_of_day": serious_by_part_of_day(t["accidents"]),
        "mean_deaths_by_age": mean_deaths_by_age(t["deaths"], t["accidents"]),
        "births_at_stations": births_at_stations(t["births"], t["stations"]),
        "districts_with_immigrants_and_deaths": districts_with_immigrants_and_deaths(t["immigrants"], t["deaths"]),
        "unemployment_by_gender": unemployment_by_gender(t["unemployment"]),
        "names_before_1930": names_before_1930(t["babies"], t["frequent_names"]),
        "neighbourhoods_with_underground": neighbourhoods_with_underground(t["population"], t["transports"]),
        "transport_counts": transport_counts(t["transports"]),
        "stations_with_air_quality": stations_with_air_quality(t["air_quality"], t["stations"]),
    }
