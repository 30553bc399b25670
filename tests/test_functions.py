import math

from pyspark.sql import functions as F

from punctualis.functions import geo, text, times


def one(spark, row, ddl, *cols):
    return tuple(spark.createDataFrame([row], ddl).select(*cols).first())


def test_timetable_time_past_midnight(spark):
    got = one(
        spark, ("25:10:00", "23:59:30", "bad"), "a string, b string, c string",
        times.normalize_time("a"), times.normalize_time("a", pad=True), times.normalize_time("b"), times.gtfs_seconds("a"),
        times.is_night("a"), times.is_night("c"), times.gtfs_seconds("c"),
    )
    assert got == ("1:10:00", "01:10:00", "23:59:30", 90600, True, False, None)


def test_minute_boundaries_clamp_and_null(spark):
    a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    minutes = times.minutes_between(a, b)
    assert one(spark, ("2024-01-01 10:00:59", "2024-01-01 10:01:00"), "a string, b string", minutes) == (1,)
    assert one(spark, ("2024-01-01 10:05:00", "2024-01-01 10:01:00"), "a string, b string", minutes, times.at_least_zero(minutes)) == (-4, 0)
    assert one(spark, (None, "2024-01-01 10:01:00"), "a string, b string", times.at_least_zero(minutes)) == (None,)


def test_local_time_across_dst(spark):
    before, after = 1774745999, 1774746000  # 2026-03-29 00:59:59 and 01:00:00 UTC
    got = one(spark, (before, after), "a long, b long", times.epoch_to_local("a").cast("string"), times.epoch_to_local("b").cast("string"))
    assert got == ("2026-03-29 01:59:59", "2026-03-29 03:00:00")


def test_local_time_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, (1704067200,), "a long", times.epoch_to_local("a").cast("string")) == ("2024-01-01 01:00:00",)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_half_hour_ties_go_to_even(spark):
    slot = times.round_half_hour(F.col("a").cast("timestamp_ntz"))
    for moment, want in {"10:15:00": "10:00", "10:15:00.000001": "10:30", "10:45:00": "11:00", "23:46:00": "00:00"}.items():
        assert one(spark, (f"2024-01-01 {moment}",), "a string", slot) == (want,)


def test_elapsed_wraps_once(spark):
    got = one(spark, (86000, 100), "a int, b int", times.elapsed_wrap(F.col("a"), F.col("b")), times.elapsed_wrap(F.col("b"), F.col("a")))
    assert got == (500, 85900)


def test_roman_numbers(spark):
    cases = {"(I)": 1, "Nowa Huta (XVIII)": 18, "a ( XIX ) b": 19, "(XLIV)": 44, "(XCIX)": 99, "none": None, "(abc)": None, "(": None, "()": None, "(IXC)": 109, "(CD)": 600}
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    got = {r[0]: r[1] for r in df.select("name", text.roman_in_parens("name")).collect()}
    assert got == cases


def test_names(spark):
    got = one(
        spark, ("Łagiewniki-Borek Fałęcki (IX)", "Prądnik Biały (IV)", "Ünïcode"), "a string, b string, c string",
        text.strip_diacritics("a"), text.strip_diacritics(text.slug("b")), text.strip_diacritics_nfkd("c"), text.strip_diacritics_nfkd("b"),
    )
    assert got == ("Łagiewniki-Borek Fałecki (IX)", "Pradnik_Biały", "Unicode", "Pradnik Biały (IV)")


def test_export_file_names(spark):
    paths = ["/x/T_2024-01-05.parquet", "/x/T_20240105T101112Z.parquet", "/x/T.PARQUET", "/x/A_B_2024-13-45.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(text.table_of("p"), text.date_of("p").cast("string"))
    assert [tuple(r) for r in df.collect()] == [("T", "2024-01-05"), ("T", None), ("T", None), ("A_B", None)]


def test_distance(spark):
    km, m = one(spark, (0.0, 0.0, 0.0, 90.0), "a double, b double, c double, d double", geo.haversine_km("a", "b", "c", "d"), geo.haversine_m("a", "b", "c", "d"))
    assert math.isclose(km, math.pi / 2 * 6371) and math.isclose(m, math.pi / 2 * 6371008.8)


def test_vector_id_and_key(spark):
    import hashlib

    got = one(spark, ("T1", "20240105", 3, None), "t string, d string, a int, b int", text.vector_id(F.col("t"), F.col("d"), F.col("a"), F.col("b")),
              text.trip_key(F.col("t"), F.lit(None).cast("string"), F.col("d"), F.lit("A")))
    assert got == (hashlib.md5(b"T1202401053END").hexdigest(), "T1_nan_20240105_A")
