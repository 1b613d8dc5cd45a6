"""Hourly readings to daily summaries to a city report. Events stand in for readings: type = city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import amount, as_double, floating, round_half_up
from millrace.functions.semi import hourly_rows
from millrace.operators.aggregate import price_stats
from millrace.plans.registry import query
from millrace.plans.tables import table


# Labels and their thresholds.
def weather_label(rain: Column, mean_temp: Column) -> Column:
    """Label of a day from its rounded figures; a null figure passes no threshold."""
    return F.when(rain > 5, "Rainy").when(mean_temp > 30, "Hot").when(mean_temp < 5, "Cold").otherwise("Mild")


def daily_summary(hourly: DataFrame, digits: int | None = None) -> DataFrame:
    """One row per city and day; all cities in one job. Rain over only-null readings is 0, as pandas sums.

    Readings may have any digits. With ``digits``, those that they have at most, figures are those of the decimal numbers, so
    that ties are rounded by what was written, not by the double next to it.
    """
    columns = "temperature", "precipitation", "windspeed", "humidity"
    t, rain, wind, damp = (floating(c) if digits is None else amount(c, digits) for c in columns)
    daily = hourly.groupBy("city", F.to_date("datetime").alias("date")).agg(
        t.rounded_mean(2).alias("avg_temp_c"),
        round_half_up(as_double(F.max("temperature")), 2).alias("max_temp_c"),
        round_half_up(as_double(F.min("temperature")), 2).alias("min_temp_c"),
        F.coalesce(rain.rounded_sum(2), F.lit(0.0)).alias("total_precip_mm"),
        wind.rounded_mean(2).alias("avg_windspeed"),
        damp.rounded_mean(1).alias("avg_humidity"),
    )
    return daily.withColumn("weather_label", weather_label(F.col("total_precip_mm"), F.col("avg_temp_c")))


def city_report(daily: DataFrame) -> DataFrame:
    """Second-level figures per city, and how many days had each label."""
    labels = {f"{label.lower()}_days": label for label in ("Rainy", "Hot", "Cold", "Mild")}
    return daily.groupBy("city").agg(
        amount("avg_temp_c").rounded_mean(1).alias("avg_temp"),
        round_half_up(as_double(F.max("max_temp_c")), 1).alias("max_temp"),
        round_half_up(as_double(F.min("min_temp_c")), 1).alias("min_temp"),
        amount("total_precip_mm").rounded_sum(1).alias("total_rain"),
        *[F.count_if(F.col("weather_label") == label).alias(name) for name, label in labels.items()],
    )


def _readings(spark, sf_dir) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("city"),
        F.col("ts").alias("datetime"),
        F.col("value").alias("temperature"),
        F.when(k < 10, k / 20).otherwise(0.0).alias("precipitation"),
        (k * 0.5).alias("windspeed"),
        k.cast("double").alias("humidity"),
    )


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_DAILY = f"""daily AS (
  SELECT city, date, CAST(round(CAST(t / n AS DECIMAL(28,10)), 2) AS DOUBLE) AS avg_temp_c, max_temp_c, min_temp_c, total_precip_mm,
         CAST(round(CAST(w / n AS DECIMAL(28,10)), 2) AS DOUBLE) AS avg_windspeed,
         CAST(round(CAST(h / n AS DECIMAL(28,10)), 1) AS DOUBLE) AS avg_humidity,
         CASE WHEN total_precip_mm > 5 THEN 'Rainy' WHEN round(CAST(t / n AS DECIMAL(28,10)), 2) > 30 THEN 'Hot'
              WHEN round(CAST(t / n AS DECIMAL(28,10)), 2) < 5 THEN 'Cold' ELSE 'Mild' END AS weather_label
  FROM (SELECT event_type AS city, CAST(ts AS DATE) AS date, COUNT(*) AS n,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS t, max(value) AS max_temp_c, min(value) AS min_temp_c,
               CAST(SUM(CAST(CASE WHEN {_K} < 10 THEN {_K} / 20.0 ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS total_precip_mm,
               CAST(SUM({_K} * 5) AS DOUBLE) / 10 AS w, CAST(SUM({_K}) AS DOUBLE) AS h
        FROM events GROUP BY 1, 2))"""


@query("daily_summary", "AGG-09 F-DT-02 F-CND-02 SET-02 UDF-02 F-MATH-02", f"WITH {_DAILY} SELECT * FROM daily")
def _(spark, sf_dir):
    return daily_summary(_readings(spark, sf_dir), digits=4)


@query(
    "weather_report",
    "AGG-18",
    f"""WITH {_DAILY} SELECT city,
        CAST(round(CAST(CAST(SUM(CAST(avg_temp_c AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS DECIMAL(28,10)), 1) AS DOUBLE) AS avg_temp,
        CAST(round(CAST(max(max_temp_c) AS DECIMAL(18,2)), 1) AS DOUBLE) AS max_temp,
        CAST(round(CAST(min(min_temp_c) AS DECIMAL(18,2)), 1) AS DOUBLE) AS min_temp,
        CAST(round(SUM(CAST(total_precip_mm AS DECIMAL(18,2))), 1) AS DOUBLE) AS total_rain,
        COUNT(*) FILTER (weather_label = 'Rainy') AS rainy_days, COUNT(*) FILTER (weather_label = 'Hot') AS hot_days,
        COUNT(*) FILTER (weather_label = 'Cold') AS cold_days, COUNT(*) FILTER (weather_label = 'Mild') AS mild_days
        FROM daily GROUP BY city""",
)
def _(spark, sf_dir):
    return city_report(daily_summary(_readings(spark, sf_dir), digits=4))


def _city_documents(spark, sf_dir) -> DataFrame:
    """One document per event: its city with three hours of parallel readings."""
    hour = "timestampadd(HOUR, i, ts)"
    hours = f"transform(sequence(0, 2), i -> date_format({hour}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"))"
    doc = f"""to_json(map(event_type, struct(struct(
        {hours} AS time,
        array(value, value + 1, value + 2) AS temperature_2m,
        array(0.0D, 0.25D, 0.5D) AS precipitation,
        array(cast(user_id AS double), null, 1.5D) AS windspeed_10m,
        array(10.0D, 20.0D, 30.0D) AS relativehumidity_2m) AS hourly)))"""
    return table(spark, sf_dir, "events").select(F.expr(doc).alias("doc"))


@query(
    "json_arrays_zip",
    "SRC-13 F-ARR-01 F-JSON-03",
    """SELECT event_type AS city, ts + to_hours(i) AS datetime, value + i AS temperature, i * 0.25::DOUBLE AS precipitation,
       CASE i WHEN 0 THEN CAST(user_id AS DOUBLE) WHEN 2 THEN 1.5 END AS windspeed, CAST(10 * (i + 1) AS DOUBLE) AS humidity
       FROM events, (SELECT unnest([0, 1, 2]) AS i)""",
)
def _(spark, sf_dir):
    return hourly_rows(_city_documents(spark, sf_dir), "doc")


@query(
    "daily_summary_from_json",
    "SRC-13 AGG-09 F-DT-02 SET-02",
    """WITH h AS (SELECT event_type AS city, ts + to_hours(i) AS datetime, CAST(value AS DECIMAL(18,2)) + i AS t,
                        CAST(0.25 * i AS DECIMAL(18,2)) AS p, 10 * (i + 1) AS d,
                        CASE i WHEN 0 THEN CAST(user_id AS DECIMAL(18,2)) WHEN 2 THEN 1.5 END AS w
                 FROM events, (SELECT unnest([0, 1, 2]) AS i)),
       g AS (SELECT city, CAST(datetime AS DATE) AS date, COUNT(*) AS n, CAST(SUM(t) AS DOUBLE) AS t, max(t) AS mx, min(t) AS mn,
                    CAST(SUM(p) AS DOUBLE) AS p, CAST(SUM(w) AS DOUBLE) AS w, COUNT(w) AS nw, CAST(SUM(d) AS DOUBLE) AS d FROM h GROUP BY 1, 2)
       SELECT city, date, CAST(round(CAST(t / n AS DECIMAL(28,10)), 2) AS DOUBLE) AS avg_temp_c, CAST(mx AS DOUBLE) AS max_temp_c,
              CAST(mn AS DOUBLE) AS min_temp_c, p AS total_precip_mm,
              CAST(round(CAST(w / nullif(nw, 0) AS DECIMAL(28,10)), 2) AS DOUBLE) AS avg_windspeed,
              CAST(round(CAST(d / n AS DECIMAL(28,10)), 1) AS DOUBLE) AS avg_humidity,
              CASE WHEN p > 5 THEN 'Rainy' WHEN round(CAST(t / n AS DECIMAL(28,10)), 2) > 30 THEN 'Hot'
                   WHEN round(CAST(t / n AS DECIMAL(28,10)), 2) < 5 THEN 'Cold' ELSE 'Mild' END AS weather_label FROM g""",
)
def _(spark, sf_dir):
    return daily_summary(hourly_rows(_city_documents(spark, sf_dir), "doc"), digits=4)


# ---------------------------------------------------------------- ticks: event type = symbol, value = price


def ticks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tick_id"), F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("ts").alias("timestamp")
    )


STATS_SQL = """SELECT event_type AS symbol, COUNT(*) AS n_rows, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS avg_price,
       min(value) AS min_price, max(value) AS max_price FROM events GROUP BY event_type ORDER BY event_type"""


@query("symbol_stats", "AGG-08 SRT-01", STATS_SQL)
def _(spark, sf_dir):
    return price_stats(ticks(spark, sf_dir), "symbol", "price", digits=2).orderBy("symbol")


@query(
    "symbol_stats_fine",
    "AGG-08 F-MATH-02",
    """SELECT event_type AS symbol, COUNT(*) AS n_rows, CAST(SUM(p) AS DOUBLE) / COUNT(p) AS avg_price,
       CAST(min(p) AS DOUBLE) AS min_price, CAST(max(p) AS DOUBLE) AS max_price
       FROM (SELECT event_type, CAST(event_id % 100003 AS DECIMAL(18,6)) * CAST(0.000001 AS DECIMAL(7,6)) AS p FROM events) GROUP BY event_type""",
)
def _(spark, sf_dir):
    """Prices of millionths: a mean in cents would be 0."""
    fine = ticks(spark, sf_dir).withColumn("price", F.col("tick_id") % 100003 / F.lit(1e6))
    return price_stats(fine, "symbol", "price", digits=6)


@query(
    "symbol_means_any_digits",
    "AGG-08 AGG-11 AGG-15",
    """WITH p AS (SELECT event_type AS symbol, unnest([value / 7, value * 1e10 / 3, value * 1e-9 / 11]) AS x, unnest([1, 2, 3]) AS scale FROM events),
       t AS (SELECT symbol, scale, sum(round_even(x, 0)::HUGEINT) AS ones, count(x) AS n,
                    sum((round_even(x * 1152921504606846976.0, 0) - round_even(x, 0) * 1152921504606846976.0)::HUGEINT) AS rest FROM p GROUP BY 1, 2)
       SELECT symbol, scale, (ones::DOUBLE + rest::DOUBLE / 1152921504606846976.0) / n AS mean FROM t""",
)
def _(spark, sf_dir):
    """Means of sevenths, of some ten thousand millions, and of millionths of thousandths: no number of digits fits them all."""
    p = F.col("price")
    scaled = F.array(*[F.struct(F.lit(n).alias("scale"), v.alias("x")) for n, v in ((1, p / 7), (2, p * F.lit(1e10) / 3), (3, p * F.lit(1e-9) / 11))])
    values = ticks(spark, sf_dir).select("symbol", F.inline(scaled))
    return values.groupBy("symbol", "scale").agg(floating("x").mean().alias("mean"))


@query(
    "rows_per_load",
    "AGG-12 SRT-01",
    "SELECT date_trunc('hour', ts) AS load_time, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY 1",
)
def _(spark, sf_dir):
    hour = F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz").alias("load_time")
    return ticks(spark, sf_dir).groupBy(hour).agg(F.count(F.lit(1)).alias("n")).orderBy("load_time")
