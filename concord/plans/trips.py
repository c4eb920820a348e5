"""Trip records to daily, hourly and zone marts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.sources.sinks import replace_partitions, write_parquet, write_tables

# The accepted trip length in seconds and the reporting month.
SECONDS = (60, 10800)
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-31"


def _start():
    return F.col("trip_start_timestamp").cast("timestamp_ntz")


def quality(first_day: str = FIRST_DAY, last_day: str = LAST_DAY):
    """The predicate a usable trip meets; both days are included."""
    return (
        F.col("trip_id").isNotNull()
        & F.col("trip_start_timestamp").isNotNull()
        & (F.col("fare") >= 0)
        & (F.col("trip_miles") >= 0)
        & F.col("trip_seconds").between(*SECONDS)
        & _start().cast("date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    )


def clean_trips(trips: DataFrame, first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> DataFrame:
    """Usable trips with typed times, filled charges, total, day, hour and weekend flag."""
    charge = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("tips", "tolls", "extras")}
    return trips.where(quality(first_day, last_day)).select(
        "trip_id",
        "taxi_id",
        _start().alias("trip_start_timestamp"),
        F.col("trip_end_timestamp").cast("timestamp_ntz").alias("trip_end_timestamp"),
        "trip_seconds",
        "trip_miles",
        "fare",
        *[value.alias(c) for c, value in charge.items()],
        (F.col("fare") + charge["tips"] + charge["tolls"] + charge["extras"]).alias("total_amount"),
        "payment_type",
        "company",
        "pickup_community_area",
        "dropoff_community_area",
        _start().cast("date").alias("trip_date"),
        F.hour(_start()).alias("hour_of_day"),
        F.dayofweek(_start()).isin(1, 7).alias("is_weekend"),  # 1 is Sunday, 7 is Saturday
    )


def daily_metrics(clean: DataFrame) -> DataFrame:
    """Count, revenue, averages and weekend split by day."""
    return clean.groupBy("trip_date").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("fare").alias("avg_fare"),
        F.avg("trip_miles").alias("avg_trip_miles"),
        F.avg("trip_seconds").alias("avg_trip_seconds"),
        F.count_if("is_weekend").alias("weekend_trips"),
        F.count_if(~F.col("is_weekend")).alias("weekday_trips"),
    )


def hourly_demand(clean: DataFrame) -> DataFrame:
    """Count, revenue and average fare by day and hour."""
    return clean.groupBy("trip_date", "hour_of_day").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("fare").alias("avg_fare"),
    )


def zone_performance(clean: DataFrame) -> DataFrame:
    """Count, revenue and averages by pickup area, trips without an area left out."""
    return (
        clean.where(F.col("pickup_community_area").isNotNull())
        .groupBy("pickup_community_area")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.sum("total_amount").alias("total_revenue"),
            F.avg("fare").alias("avg_fare"),
            F.avg("trip_miles").alias("avg_trip_miles"),
        )
    )


def marts(clean: DataFrame) -> dict[str, DataFrame]:
    """The exported tables by name, the marts in their report order."""
    return {
        "trips_clean": clean,
        "daily_metrics": daily_metrics(clean).orderBy("trip_date"),
        "hourly_demand": hourly_demand(clean).orderBy("trip_date", "hour_of_day"),
        "zone_performance": zone_performance(clean).orderBy(
            F.desc("trip_count"), "pickup_community_area"
        ),
    }


def stage_counts(trips: DataFrame, first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> DataFrame:
    """Rows of every stage and the range of days, from one scan of the raw trips.

    The trips are counted per (usable, day, hour, area) cell first; the mart row counts are
    the distinct keys among those cells.
    """
    usable = F.coalesce(quality(first_day, last_day), F.lit(False))
    cells = (
        trips.select(
            usable.alias("usable"),
            F.when(usable, _start().cast("date")).alias("day"),
            F.when(usable, F.hour(_start())).alias("hour"),
            F.when(usable, F.col("pickup_community_area")).alias("area"),
        )
        .groupBy("usable", "day", "hour", "area")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    zero = F.lit(0).cast("bigint")
    stages = cells.agg(
        F.coalesce(F.sum("n"), zero).alias("trips"),
        F.coalesce(F.sum(F.when(F.col("usable"), F.col("n"))), zero).alias("trips_clean"),
        F.count_distinct("day").alias("daily_metrics"),
        F.count_distinct("day", "hour").alias("hourly_demand"),
        F.count_distinct("area").alias("zone_performance"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )
    names = ["trips", "trips_clean", "daily_metrics", "hourly_demand", "zone_performance"]
    return stages.unpivot(["first_day", "last_day"], names, "stage", "row_count").select(
        "stage", "row_count", "first_day", "last_day"
    )


def write_marts(trips: DataFrame, folder: str, **window: str) -> dict[str, DataFrame]:
    """Write the clean trips once, by day, and build all marts from the written table."""
    spark = trips.sparkSession
    clean = clean_trips(trips, **window)
    write_parquet(clean, f"{folder}/trips_clean", "trip_date")
    stored = spark.read.parquet(f"{folder}/trips_clean").select(*clean.columns)
    tables = {name: df for name, df in marts(stored).items() if name != "trips_clean"}
    write_tables(tables, folder, write_parquet)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in marts(stored)}


# Increments -----------------------------------------------------------------------------

CELL = ("trip_date", "hour_of_day", "pickup_community_area", "is_weekend")
_SUMS = {"revenue": "total_amount", "fare": "fare", "miles": "trip_miles", "seconds": "trip_seconds"}


def day_sums(clean: DataFrame) -> DataFrame:
    """Counts and sums by day, hour and area, from which every mart can be added up."""
    sums = [F.sum(c).alias(f"{name}_sum") for name, c in _SUMS.items()]
    return clean.groupBy(*CELL).agg(F.count(F.lit(1)).alias("trips"), *sums)


def load_days(trips: DataFrame, folder: str, first_day: str, last_day: str) -> None:
    """Load some days, both included, into the stored trips and sums; all other days stay as they are.

    Days of the window that have no usable trip (any more) are removed.
    """
    spark = trips.sparkSession
    start, end = date.fromisoformat(first_day), date.fromisoformat(last_day)
    days = [(start + timedelta(n)).isoformat() for n in range((end - start).days + 1)]
    clean = clean_trips(trips, first_day, last_day)
    replace_partitions(clean, f"{folder}/trips_clean", "trip_date", days)
    stored = spark.read.parquet(f"{folder}/trips_clean").select(*clean.columns)
    loaded = stored.where(F.col("trip_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    replace_partitions(day_sums(loaded), f"{folder}/day_sums", "trip_date", days)


def merged_marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The marts of all days loaded so far, added up from the stored sums; no trip is read."""
    cells = spark.read.schema(
        "hour_of_day int, pickup_community_area bigint, is_weekend boolean, trips bigint, "
        "revenue_sum double, fare_sum double, miles_sum double, seconds_sum bigint, trip_date date"
    ).parquet(f"{folder}/day_sums")

    def mean(name: str, column: str):
        return (F.sum(f"{name}_sum") / F.sum("trips")).alias(column)

    count, revenue = F.sum("trips").alias("trip_count"), F.sum("revenue_sum").alias("total_revenue")
    fare, miles = mean("fare", "avg_fare"), mean("miles", "avg_trip_miles")

    def on(weekend: bool):
        return F.coalesce(F.sum(F.when(F.col("is_weekend") == weekend, F.col("trips"))), F.lit(0).cast("bigint"))

    return {
        "daily_metrics": cells.groupBy("trip_date").agg(
            count, revenue, fare, miles, mean("seconds", "avg_trip_seconds"),
            on(True).alias("weekend_trips"), on(False).alias("weekday_trips"),
        ),
        "hourly_demand": cells.groupBy("trip_date", "hour_of_day").agg(count, revenue, fare),
        "zone_performance": cells.where(F.col("pickup_community_area").isNotNull())
        .groupBy("pickup_community_area").agg(count, revenue, fare, miles),
    }
