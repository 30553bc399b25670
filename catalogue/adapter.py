"""Transit tables derived from the star-schema tables (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.functions.text import roman_in_parens
from punctualis.operators.joins import with_scalar
from punctualis.schemas import DISTRICTS
from punctualis.session import tune

VERSIONS = ("2024-01-01", "2024-01-15")
SERVICE_DATES = ("2024-01-05", "2024-01-06")


def _versions():
    return F.explode(F.array(*[F.lit(v).cast("timestamp_ntz") for v in VERSIONS])).alias("load_timestamp")


def _modes():
    return F.explode(F.array(*[F.lit(m) for m in "AMT"])).alias("mode")


def _mode_of(key):
    return F.element_at(F.array(*[F.lit(m) for m in "AMT"]), (key % 3 + 1).cast("int"))


def _tag(prefix: str, key) -> F.Column:
    return F.concat(F.lit(prefix), key.cast("string"))


class Feed:
    """Lazy transit tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def stops(self) -> DataFrame:
        k = F.col("s_suppkey")
        name = F.when(k % 50 != 49, F.concat(F.lit("Stop "), (k % 40).cast("string")))
        base = self.raw("supplier").select(
            _tag("S", k).alias("stop_id"),
            _tag("C", k).alias("stop_code"),
            name.alias("stop_name"),
            F.when(k % 2 == 0, F.lit("platform")).alias("stop_desc"),
            (F.lit(49.97) + (k * 37 % 140) / F.lit(1000.0)).alias("stop_lat"),
            (F.lit(19.80) + (k * 53 % 400) / F.lit(1000.0)).alias("stop_lon"),
            _modes(),
        )
        return base.select("*", _versions())

    def routes_scd2(self) -> DataFrame:
        k = F.col("p_partkey")
        turn = F.lit("2024-01-10").cast("timestamp_ntz")
        start, none = F.lit("1900-01-01").cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz")
        version = lambda suffix, a, b, cur: F.struct(
            F.concat(_tag("L", k), F.lit(suffix)).alias("route_short_name"), a.alias("valid_from"), b.alias("valid_to"), F.lit(cur).alias("is_current")
        )
        versions = F.when(k % 2 == 0, F.array(version("", start, turn, False), version("n", turn, none, True))).otherwise(
            F.array(version("", start, none, True))
        )
        routes = self.raw("part").select(_tag("R", k).alias("route_id"), _modes(), versions.alias("v"))
        return routes.select("route_id", "mode", F.inline("v"))

    def trips(self) -> DataFrame:
        k = F.col("o_orderkey")
        parts = self.raw("part").agg(F.min("p_partkey").alias("low"), F.count("p_partkey").alias("parts"))
        return with_scalar(self.raw("orders"), parts).select(
            _tag("T", k).alias("trip_id"), _tag("R", F.col("low") + k % F.col("parts")).alias("route_id"), _tag("V", k % 2).alias("service_id"),
            F.col("o_orderpriority").alias("trip_headsign"), _mode_of(k).alias("mode"), _versions(),
        )

    def visits(self) -> DataFrame:
        """One row per order and line, for any table built on them from one shuffle.

        The test is always true. It names all columns and the partition, so that no use drops columns or rows before the shuffle and
        Spark finds the same one everywhere.
        """
        rows = self.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_suppkey").alias("supp"), F.min("l_partkey").alias("part"), F.sum("l_quantity").alias("dist")
        )
        return rows.withColumn("_in", F.spark_partition_id()).filter(F.hash("supp", "part", "dist", "_in") >= -(2**31)).drop("_in")

    def stop_times(self) -> DataFrame:
        order, line = F.col("l_orderkey"), F.col("l_linenumber")
        two = lambda x: F.lpad(x.cast("string"), 2, "0")
        clock = F.concat(two(order % 26), F.lit(":"), two(order % 38 + 3 * line))
        base = self.visits().select(
            _tag("T", order).alias("trip_id"), _tag("S", F.col("supp")).alias("stop_id"), line.alias("stop_sequence"),
            F.concat(clock, F.lit(":00")).alias("arrival_time"), F.concat(clock, F.lit(":30")).alias("departure_time"),
            F.col("dist").alias("shape_dist_traveled"), _mode_of(order).alias("mode"),
        )
        return base.select("*", _versions())

    def calendar(self) -> DataFrame:
        """Weekday service V0 and daily service V1, one week per version."""
        k = F.col("o_orderkey")
        services = self.raw("orders").select(_tag("V", k % 2).alias("service_id"), _mode_of(k).alias("mode")).distinct()
        daily = F.when(F.col("service_id") == "V0", 0).otherwise(1)
        first = F.col("load_timestamp") == F.lit(VERSIONS[0]).cast("timestamp_ntz")
        days = ["monday", "tuesday", "wednesday", "thursday", "friday"]
        return services.select("*", _versions()).select(
            "service_id", *[F.lit(1).alias(d) for d in days], daily.alias("saturday"), daily.alias("sunday"),
            F.when(first, "20240101").otherwise("20240115").alias("start_date"), F.when(first, "20240107").otherwise("20240121").alias("end_date"),
            "mode", "load_timestamp",
        )

    def calendar_dates(self) -> DataFrame:
        """V0 does not run on Wednesday the 3rd and runs on Sunday the 7th."""
        v0 = self.calendar().filter((F.col("service_id") == "V0") & (F.col("start_date") == "20240101"))
        changes = F.array(
            F.struct(F.lit("20240103").alias("date"), F.lit(2).alias("exception_type")),
            F.struct(F.lit("20240107").alias("date"), F.lit(1).alias("exception_type")),
        )
        return v0.select("service_id", "mode", "load_timestamp", F.inline(changes))

    def customer_calendar(self) -> DataFrame:
        """One service per customer: weekday flags from the bits of the key, period from the nation."""
        k, n = F.col("c_custkey"), F.col("c_nationkey")
        flag = lambda i: F.shiftright(k, i).bitwiseAND(F.lit(1)).cast("int")
        days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
        ymd = lambda d: F.date_format(d, "yyyyMMdd")
        start = F.date_add(F.lit("2023-12-20").cast("date"), n)
        return self.raw("customer").select(
            _tag("V", k).alias("service_id"), *[flag(i).alias(d) for i, d in enumerate(days)],
            ymd(start).alias("start_date"), ymd(F.date_add(start, (k % 30).cast("int"))).alias("end_date"), _mode_of(k).alias("mode"), _versions(),
        )

    def customer_exceptions(self) -> DataFrame:
        """Exceptions from orders: date from the order key, type 1 or 2; one per service and date."""
        k = F.col("o_orderkey")
        day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 40).cast("int")), "yyyyMMdd")
        per_day = self.raw("orders").select("o_custkey", day.alias("date"), k.alias("k")).groupBy("o_custkey", "date").agg(F.min("k").alias("k"))
        return per_day.select(
            _tag("V", F.col("o_custkey")).alias("service_id"), "date", (F.col("k") % 2 + 1).cast("int").alias("exception_type"),
            _mode_of(F.col("o_custkey")).alias("mode"), _versions(),
        )

    def _polls(self) -> DataFrame:
        """Two predictions per visit and service date; the second is the final one."""
        order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("part")
        seconds = (order % 26) * 3600 + (order % 38 + 3 * line) * 60
        late = part * 13 % 900 - 300
        midnight = F.explode(F.array(*[F.unix_timestamp(F.lit(d).cast("timestamp_ntz")) for d in SERVICE_DATES]))
        base = self.visits().select("*", midnight.alias("midnight"))
        final = F.col("midnight") + seconds + late - 3600
        polls = F.array(
            F.struct((final - 60).alias("t"), (F.col("midnight") + seconds - 3600 - 1200).alias("poll")),
            F.struct(final.alias("t"), final.alias("poll")),
        )
        return base.select("*", F.inline(polls)).withColumn("poll", F.floor(F.col("poll") / 60) * 60)

    def trip_updates(self) -> DataFrame:
        order, line, t = F.col("l_orderkey"), F.col("l_linenumber"), F.col("t")
        blank = (order * 7 + line) % 101 == 0
        seventh = (order + line) % 7 == 0
        return self._polls().select(
            _tag("T", order).alias("trip_id"), _tag("S", F.col("supp")).alias("stop_id"), line.alias("stop_sequence"),
            F.when(~blank & ~seventh, t).alias("arrival"), F.when(~blank, t + F.when(seventh, 0).otherwise(30)).alias("departure"),
            F.lit(0).alias("schedule_relationship"), F.timestamp_seconds("poll").cast("timestamp_ntz").alias("load_timestamp"),
            _mode_of(order).alias("mode"),
        )

    def vehicle_positions(self) -> DataFrame:
        order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("part")
        copies = F.explode(F.sequence(F.lit(0), F.when(part % 5 == 0, 1).otherwise(0)))
        rows = self._polls().filter(F.col("t") - F.col("poll") < 60).select("*", copies.alias("copy"))
        return rows.select(
            _tag("B", order % 500 + F.col("copy")).alias("id"), (F.lit(49.97) + (part % 140) / F.lit(1000.0)).alias("latitude"),
            (F.lit(19.80) + (part % 400) / F.lit(1000.0)).alias("longitude"), (part % 360).cast("double").alias("bearing"),
            (part % 20).cast("double").alias("speed"), ((order + line) % 3).cast("int").alias("current_status"),
            line.alias("current_stop_sequence"), F.timestamp_seconds("poll").cast("timestamp_ntz").alias("load_timestamp"),
            _tag("T", order).alias("trip_id"), _mode_of(order).alias("mode"),
        )

    def districts(self) -> DataFrame:
        """District list as an inline relation; the number comes from the roman numeral."""
        rows = self.spark.createDataFrame(DISTRICTS, "district_name string, latitude double, longitude double")
        return rows.select(roman_in_parens("district_name").alias("district_number"), "*")

    def _district_of(self, key):
        names = F.array(*[F.lit(d[0]) for d in DISTRICTS])
        return F.element_at(names, (key % len(DISTRICTS) + 1).cast("int"))

    def hourly_weather(self) -> DataFrame:
        v = F.col("value")
        hours = self.raw("events").groupBy(
            self._district_of(F.col("user_id")).alias("district_name"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")
        ).agg(
            (F.floor(F.sum(F.round(v * 100).cast("long")) / F.count(F.lit(1))) / 100).alias("temperature_2m"), F.round(F.max(v), 2).alias("wind_speed_10m"),
            F.count(F.lit(1)).cast("double").alias("relative_humidity_2m"), F.round(F.min(v), 2).alias("precipitation"),
            (F.max("event_id") % 100).cast("int").alias("weather_code"), F.round(F.max(v) + 1000, 2).alias("pressure_msl"),
            F.min("event_id").cast("double").alias("cloud_cover"), F.max("event_id").cast("double").alias("visibility"),
        )
        return hours.withColumn("is_day", F.hour("timestamp").between(6, 17))

    def delays(self) -> DataFrame:
        """Delay rows for the statistics, from the event stream."""
        e, u = F.col("event_id"), F.col("user_id")
        late = (F.floor("value") - 20).cast("long")
        return self.raw("events").select(
            _tag("T", u).alias("trip_id"), _tag("S", e % 100).alias("stop_id"), _tag("Stop ", u % 30).alias("stop_name"),
            F.col("event_type").alias("trip_headsign"), (e % 25).cast("int").alias("stop_sequence"), F.col("ts").alias("actual_arrival"),
            _tag("L", u % 20).alias("route_short_name"), F.timestamp_add("MINUTE", -late, F.col("ts")).alias("planned_arrival"),
            F.col("event_type").alias("mode"), F.date_format("ts", "yyyyMMdd").alias("event_date"), F.col("ts").alias("load_timestamp"),
            F.date_trunc("day", "ts").cast("timestamp_ntz").alias("schedule_timestamp"),
            F.when(e % 97 != 0, late).alias("delay"),
        )

    # composite marts over the derived tables

    def expanded_calendar(self) -> DataFrame:
        from punctualis.plans.calendar import expand_calendar

        return expand_calendar(self.calendar(), self.calendar_dates())

    def schedule(self, all_services: bool = False) -> DataFrame:
        from punctualis.plans.schedule import build_trips_schedule

        return build_trips_schedule(
            self.stop_times(), self.trips(), self.stops(), self.routes_scd2(), self.expanded_calendar(), all_services
        )

    def served_schedule(self) -> DataFrame:
        """The schedule of the dates that the updates reach, all that delays and vectors can match."""
        from punctualis.plans.delays import planned_days
        from punctualis.plans.schedule import build_trips_schedule

        return build_trips_schedule(
            self.stop_times(), self.trips(), self.stops(), self.routes_scd2(), self.expanded_calendar(), planned_days=planned_days(self.trip_updates())
        )

    def delay_mart(self) -> DataFrame:
        from punctualis.plans.delays import build_delays

        return build_delays(self.trip_updates(), self.served_schedule())

    def vectors(self, strict_text_hour: bool = False) -> DataFrame:
        from punctualis.plans.delays import build_delay_vectors

        return build_delay_vectors(self.trip_updates(), self.served_schedule(), strict_text_hour)
