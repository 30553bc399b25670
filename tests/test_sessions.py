import datetime
import random

import pytest
from pyspark.sql import functions as F

from punctualis.operators.prefix import sessionize_resets
from punctualis.plans import report as rp
from punctualis.plans import sessions as ss
from punctualis.sources import committed as ct

SCHEMA = "trip_id string, mode string, stop_sequence int, stop_id string, delay long, load_timestamp timestamp_ntz, n int"
DAY0 = datetime.datetime(2024, 1, 1)


def log(seed, days=9):
    """Trips whose position mostly rises, also over midnight and over days without a fall; NULL positions, times, trips and modes."""
    pick, rows = random.Random(seed), []
    for trip, mode in (("a", "A"), ("a", "M"), ("b", "A"), (None, "A"), ("c", None), ("slow", "A")):
        at, seq = DAY0 + datetime.timedelta(minutes=pick.randrange(600)), 1
        while at < DAY0 + datetime.timedelta(days=days):
            slow = trip == "slow"
            rows.append((trip, mode, None if pick.random() < 0.05 else seq, f"S{seq}", pick.randrange(-60, 600), None if pick.random() < 0.03 else at, len(rows)))
            at += datetime.timedelta(minutes=pick.choice([7, 300, 1500] if not slow else [2000, 4000]))
            seq = max(1, seq + pick.choice([0, 1, 1, 1, -4] if not slow else [1]))
    pick.shuffle(rows)
    return rows


def whole_sessions(sessions, first, last):
    """Rows of the sessions that have a row between the days."""
    inside = {(r.trip_id, r.mode, r.session_id) for r in sessions if r.load_timestamp and first <= str(r.load_timestamp.date()) <= last}
    return sorted((r.n, r.session_id) for r in sessions if (r.trip_id, r.mode, r.session_id) in inside)


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_and_report_equal_the_whole_log(spark, tmp_path, seed):
    root, rows = str(tmp_path / "s"), log(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    # rows of all days in every batch, so most come late; the second one is repeated
    for batch, part in ((0, 0), (1, 1), (1, 1), (2, 2)):
        ss.add_rows(df.where(F.col("n") % 3 == part), root, ("log", batch))
    assert ct.read(spark, f"{root}/log").count() == len(rows)
    everything = sessionize_resets(df).collect()
    stops = spark.createDataFrame([(f"S{s}", 50.0 + s, 19.0, DAY0 + datetime.timedelta(days=d)) for s in range(30) for d in range(9)], "stop_id string, stop_lat double, stop_lon double, load_timestamp timestamp_ntz")
    for first, last in (("2024-01-03", "2024-01-04"), ("2024-01-01", "2024-01-09"), ("2025-01-01", "2025-01-02")):
        got = ss.sessions_between(spark, root, first, last)
        assert sorted((r.n, r.session_id) for r in got.collect()) == whole_sessions(everything, first, last)
        full = rp.segment_report(df, stops, first, last).collect()
        assert sorted(map(repr, ss.stored_report(spark, root, stops, first, last).collect())) == sorted(map(repr, full))
        assert bool(full) == (first < "2025")


def test_a_report_reads_its_days_alone(spark, tmp_path):
    root = str(tmp_path / "s")
    rows = [("t", "A", s, f"S{s}", 5, DAY0 + datetime.timedelta(days=d, minutes=s), 0) for d in range(40) for s in range(1, 6)]
    ss.add_rows(spark.createDataFrame(rows, SCHEMA), root)
    read = ss.sessions_between(spark, root, "2024-01-10", "2024-01-11")
    assert {f.split("/d=")[1].split("/")[0] for f in read.inputFiles() if "/log/" in f} == {"2024-01-10", "2024-01-11"}
    assert read.count() == 10 and {r.session_id for r in read.collect()} == {9, 10}
    # a session without a fall reaches into the next day, which is read as well
    ss.add_rows(spark.createDataFrame([("u", "A", 1, "S1", 5, DAY0 + datetime.timedelta(days=10, hours=23), 0), ("u", "A", 2, "S2", 5, DAY0 + datetime.timedelta(days=11, hours=1), 0)], SCHEMA), root)
    read = ss.sessions_between(spark, root, "2024-01-10", "2024-01-11")
    assert {f.split("/d=")[1].split("/")[0] for f in read.inputFiles() if "/log/" in f} == {"2024-01-10", "2024-01-11", "2024-01-12"}
    assert sorted((r.trip_id, r.stop_sequence) for r in read.collect() if r.trip_id == "u") == [("u", 1), ("u", 2)] and read.count() == 12


def test_summaries_follow_a_batch_that_was_cut_short(spark, tmp_path, monkeypatch):
    root, df = str(tmp_path / "s"), spark.createDataFrame(log(5, days=3), SCHEMA)
    with monkeypatch.context() as patch:
        patch.setattr(ct, "replace_parts", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            ss.add_rows(df, root, ("log", 0))
    ss.add_rows(df, root, ("log", 0))
    got = ss.sessions_between(spark, root, "2024-01-01", "2024-01-03")
    assert sorted((r.n, r.session_id) for r in got.collect()) == whole_sessions(sessionize_resets(df).collect(), "2024-01-01", "2024-01-03")
    ss.add_rows(df.limit(0), root, ("log", 1))
    assert ct.read(spark, f"{root}/log").count() == df.count()
