"""Daily weather per station: derivation, filling, rolling and weekly views, range means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterloom.functions.calendar import SEASONS_EN, SEASONS_PT, month_start, season, week_ending_sunday
from meterloom.functions.numeric import ratio
from meterloom.operators.joins import attach

MEASURES = ("tmax", "tmin", "humidity", "rain", "uv")

# Temperature and humidity assumed without measurements.
DEFAULT_TEMPERATURE, DEFAULT_HUMIDITY = 20.0, 70.0
SEASON_DEFAULTS = {
    "inverno": (12.0, 80.0),
    "primavera": (20.0, 70.0),
    "verão": (28.0, 60.0),
    "outono": (18.0, 75.0),
}


def derive(weather: DataFrame) -> DataFrame:
    """``temperature`` and ``humidity``; which rule applies depends on the columns the source has."""
    has = weather.columns
    if "tmax" in has and "tmin" in has:
        temperature = (F.col("tmax") + F.col("tmin")) / 2
    elif "tmax" in has:
        temperature = F.col("tmax")
    else:
        temperature = F.lit(DEFAULT_TEMPERATURE)
    humidity = F.col("humidity") if "humidity" in has else F.lit(DEFAULT_HUMIDITY)
    return weather.withColumns({"temperature": temperature, "humidity": humidity})


def fill(weather: DataFrame, columns=MEASURES) -> DataFrame:
    """Forward fill, then backward fill, per station."""
    order = W.partitionBy("station_id").orderBy("date")
    before = order.rowsBetween(W.unboundedPreceding, 0)
    after = order.rowsBetween(0, W.unboundedFollowing)
    return weather.withColumns(
        {
            c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after))
            for c in columns
        }
    )


def rolling(weather: DataFrame) -> DataFrame:
    """Centred mean over 30 rows of the two temperatures; NULL where the frame is not full."""
    frame = W.partitionBy("station_id").orderBy("date").rowsBetween(-15, 14)
    mean = lambda c: F.when(F.count(c).over(frame) == 30, F.avg(c).over(frame)).alias(f"{c}_avg30")
    return weather.select("station_id", "date", "tmax", "tmin", mean("tmax"), mean("tmin"))


def weekly(weather: DataFrame) -> DataFrame:
    """Weeks ending on Sunday between a station's first and last: rain sum (0 if empty), UV mean (NULL if empty)."""
    weeks = weather.groupBy("station_id", week_ending_sunday(F.col("date")).alias("week")).agg(
        F.coalesce(F.sum("rain"), F.lit(0.0)).alias("rain"), F.avg("uv").alias("uv")
    )
    order = W.partitionBy("station_id").orderBy("week")
    # a week is followed by the empty ones up to the next week with data
    last_empty = F.coalesce(F.date_sub(F.lead("week").over(order), 7), F.col("week"))
    spread = weeks.withColumn("_until", last_empty).withColumn(
        "_week", F.explode(F.sequence("week", "_until", F.expr("interval 7 days")))
    )
    own = F.col("_week") == F.col("week")
    return spread.select(
        "station_id",
        F.col("_week").alias("week"),
        F.when(own, F.col("rain")).otherwise(0.0).alias("rain"),
        F.when(own, F.col("uv")).alias("uv"),
    )


def summary(weather: DataFrame, by: list[str]) -> DataFrame:
    return weather.groupBy(*by).agg(
        F.avg("tmax").alias("mean_tmax"),
        F.avg("tmin").alias("mean_tmin"),
        F.max("tmax").alias("highest_tmax"),
        F.min("tmin").alias("lowest_tmin"),
        F.sum("rain").alias("total_rain"),
        F.count_if(F.col("rain") > 0).alias("rainy_days"),
        ratio(F.count_if(F.col("rain") > 0) * 100.0, F.count(F.lit(1))).alias("rainy_pct"),
        F.max("rain").alias("max_rain"),
        F.avg("humidity").alias("mean_humidity"),
        F.min("humidity").alias("min_humidity"),
        F.max("humidity").alias("max_humidity"),
        F.avg("uv").alias("mean_uv"),
        F.max("uv").alias("max_uv"),
    )


def by_calendar_month(weather: DataFrame) -> DataFrame:
    return weather.groupBy(F.month("date").alias("month")).agg(
        F.avg("tmax").alias("mean_tmax"),
        F.avg("tmin").alias("mean_tmin"),
        F.sum("rain").alias("total_rain"),
        F.avg("humidity").alias("mean_humidity"),
    )


def by_season(weather: DataFrame) -> DataFrame:
    """All four seasons in order; one without data keeps its row."""
    stats = weather.groupBy(season(F.month("date"), SEASONS_EN).alias("season")).agg(
        F.avg("tmax").alias("mean_tmax"),
        F.avg("tmin").alias("mean_tmin"),
        F.sum("rain").alias("total_rain"),
        F.avg("humidity").alias("mean_humidity"),
        F.count(F.lit(1)).alias("n_days"),
    )
    return in_season_order(stats, SEASONS_EN)


def in_season_order(stats: DataFrame, names=SEASONS_PT) -> DataFrame:
    """``stats`` has a row per season at most, as has the fixed list it is joined to."""
    spine = stats.sparkSession.createDataFrame(
        [(i + 1, n) for i, n in enumerate(names)], "season_order int, season string"
    )
    return spine.join(stats, "season", "left")


def month_days(weather: DataFrame) -> DataFrame:
    """One row per station and month holding its days (at most 31) as an array of sums and counts."""
    per_day = derive(weather).groupBy("station_id", "date").agg(
        F.sum("temperature").alias("t"),
        F.count("temperature").alias("nt"),
        F.sum("humidity").alias("h"),
        F.count("humidity").alias("nh"),
    )
    return per_day.groupBy("station_id", month_start(F.col("date")).alias("month_start")).agg(
        F.collect_list(F.struct("date", "t", "nt", "h", "nh")).alias("_days")
    )


def with_range_means(scenarios: DataFrame, weather: DataFrame) -> DataFrame:
    """Mean temperature and humidity of the station between ``first_date`` and ``simulation_date``.

    A range never leaves its month. So the weather is packed to one row per station and month, the join is a
    plain equi join, and the range is cut out of the packed days: no nested loop, no fan-out, no second pass
    over the scenarios. The packed weather, which does not grow with meters, is measured and goes to the scenarios where
    they lie: (station, month) is a few hundred values for any number of meters, and nothing is dealt out by it. Beyond the
    limit for that, the join is a shuffled one. A range without any weather day takes the fixed defaults.
    """
    joined = attach(scenarios, month_days(weather), ["station_id", "month_start"], "left")
    in_range = F.filter("_days", lambda d: d["date"].between(F.col("first_date"), F.col("simulation_date")))
    cut = joined.withColumn("_days", in_range)
    zero = F.struct(*[F.lit(0.0).alias(f) for f in ("t", "nt", "h", "nh")])
    add = lambda a, d: F.struct(*[(a[f] + F.coalesce(d[f], F.lit(0))).alias(f) for f in ("t", "nt", "h", "nh")])
    found = F.size("_days") > 0
    summed = cut.select(*[c for c in cut.columns if c != "_days"], found.alias("_found"), F.aggregate("_days", zero, add).alias("_sum"))
    mean = lambda f, default: F.when(F.col("_found"), ratio(F.col(f"_sum.{f}"), F.col(f"_sum.n{f}"))).otherwise(default)
    return summed.withColumns(
        {"temperature": mean("t", DEFAULT_TEMPERATURE), "humidity": mean("h", DEFAULT_HUMIDITY)}
    ).drop("_found", "_sum")


def with_season_defaults(df: DataFrame) -> DataFrame:
    """Temperature and humidity by season, for when there is no weather source at all."""
    *named, (_, rest) = SEASON_DEFAULTS.items()
    out = {}
    for i, name in enumerate(("temperature", "humidity")):
        chain = F
        for label, values in named:
            chain = chain.when(F.col("season") == label, values[i])
        out[name] = chain.otherwise(rest[i])
    return df.withColumns(out)
