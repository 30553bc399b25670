import pytest
from pyspark.sql import functions as F

from punctualis.operators import scd2
from punctualis.sources import committed as ct

SCHEMA = "k bigint, v string, load_timestamp timestamp_ntz"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some(spark, rows):
    return spark.createDataFrame([(k, v) for k, v, _ in rows], "k bigint, v string").withColumn(
        "load_timestamp", F.coalesce(*[F.when(F.col("k").eqNullSafe(F.lit(k)) & (F.col("v") == v), F.lit(t).cast("timestamp_ntz")) for k, v, t in rows])
    )


def test_append_replace_and_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ct.read(spark, path) is None and ct.newest(spark, path) is None
    a, b = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([("c", 3)], "v string, k int")
    assert ct.append(a, path, batch=("s", 0)) and not ct.append(a, path, batch=("s", 0)) and ct.append(b, path, batch=("s", 1)) and ct.append(b, path, batch=("other", 0))
    assert rows_of(ct.read(spark, path)) == [(1, "a"), (2, "b"), (3, "c"), (3, "c")]
    ct.replace(ct.read(spark, path).where("k > 1").distinct(), path)  # reads what it replaces
    assert rows_of(ct.read(spark, path)) == [(2, "b"), (3, "c")]
    assert not ct.append(b, path, batch=("s", 1))
    before = rows_of(ct.read(spark, path))
    assert ct.expire(spark, path) > 0 and rows_of(ct.read(spark, path)) == before and not list(tmp_path.glob("t/versions/0*1"))
    ct.replace(a.limit(0), path)
    assert ct.read(spark, path).count() == 0


@pytest.mark.parametrize("step", ["_described", "_write_manifest", "_claim", "data"])
@pytest.mark.parametrize("change", ["append", "replace", "merge"])
def test_a_writer_that_dies_leaves_the_old_rows(spark, tmp_path, monkeypatch, step, change):
    path = str(tmp_path / "t")
    old, new = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a"), (2, "b")], [(2, "x"), (3, "c")]))
    act = {"append": lambda: ct.append(new, path, batch=("s", 1)), "replace": lambda: ct.replace(new, path), "merge": lambda: ct.merge(new, path, ["k"], batch=("s", 1))}[change]
    want = {"append": [(1, "a"), (2, "b"), (2, "x"), (3, "c")], "replace": [(2, "x"), (3, "c")], "merge": [(1, "a"), (2, "x"), (3, "c")]}[change]
    ct.append(old, path, key="k")

    def die(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        if step == "data":
            m.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", die)
        else:
            m.setattr(ct, step, die)
        with pytest.raises(RuntimeError):
            act()
    assert rows_of(ct.read(spark, path)) == [(1, "a"), (2, "b")]
    assert act() and rows_of(ct.read(spark, path)) == want
    if change != "replace":
        assert not act() and rows_of(ct.read(spark, path)) == want


def test_beaten_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,)], "k int")
    ct.append(a, path)
    stale = ct.current(spark, path)
    ct.append(a, path)
    with pytest.raises(ct.Conflict):
        ct.publish(b, path, ct._none, base=stale)
    assert ct.publish(b, path, ct._all, base=stale, again=True)
    assert rows_of(ct.read(spark, path)) == [(1,), (1,), (2,)]


def test_exports_do_not_read_the_target(spark, tmp_path):
    path, copy = str(tmp_path / "t"), str(tmp_path / "copy")
    first = [(1, "a", "2024-01-01 10:00:00"), (2, "b", "2024-01-02 10:00:00"), (None, "n", None)]
    assert ct.export_days(some(spark, first), path)
    for folder in (tmp_path / "t" / "data").iterdir():  # what is not read can't be missed
        folder.rename(tmp_path / ("gone" + folder.name))
    assert not ct.export_days(some(spark, first), path) and not ct.export_new(some(spark, first), path)
    for folder in tmp_path.glob("gone*"):
        folder.rename(tmp_path / "t" / "data" / folder.name[4:])
    kept = {r.file for r in ct.manifest(spark, path).where("part = '2024-01-01'").collect()}
    second = [first[0], (2, "changed", "2024-01-02 10:00:00"), (None, "n", None), (None, "m", None), (5, "e", "2024-01-05 00:00:00")]
    assert ct.export_new(some(spark, second), path)
    assert rows_of(ct.read(spark, path).select("k", "v")) == sorted(((k, v) for k, v, _ in second), key=repr)
    assert kept <= {r.file for r in ct.manifest(spark, path).collect()} and str(ct.newest(spark, path)) == "2024-01-05 00:00:00"
    assert ct.copy_days(spark, path, copy) and not ct.copy_days(spark, path, copy)
    ct.export_days(some(spark, [*second, (9, "late", "2024-01-01 11:00:00")]), path)
    assert ct.copy_days(spark, path, copy) and rows_of(ct.read(spark, copy)) == rows_of(ct.read(spark, path))


def test_missing_rows_are_loaded_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a", "2024-01-01 10:00:00"), (2, "b", "2024-01-02 10:00:00"), (None, "n", None)]
    assert ct.load_missing(some(spark, rows), path) and not ct.load_missing(some(spark, rows), path)
    more = some(spark, [*rows, (3, "c", "2024-01-02 11:00:00")])
    twice = more.unionByName(more.where("k = 1"))
    assert ct.load_missing(twice, path) and not ct.load_missing(twice, path)
    assert rows_of(ct.read(spark, path).drop("d")) == rows_of(twice)


def test_one_changed_key_writes_one_file(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(4000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v")).repartitionByRange(40, "k")
    ct.append(big, path, key="k")
    files = {r.file for r in ct.manifest(spark, path).collect()}
    assert len(files) == 40
    change = spark.createDataFrame([(1234, "new")], "k bigint, v string")
    assert ct.merge(change, path, ["k"])
    left = {r.file for r in ct.manifest(spark, path).collect()}
    assert len(files - left) == 1 and ct.read(spark, path).count() == 4000 and ct.read(spark, path).where("v = 'new'").count() == 1
    assert ct.merge(spark.createDataFrame([(None, "none"), (-7, "new too")], "k bigint, v string"), path, ["k"])
    assert ct.merge(spark.createDataFrame([(None, "none again")], "k bigint, v string"), path, ["k"])
    assert len(files - {r.file for r in ct.manifest(spark, path).collect()}) == 1
    assert rows_of(ct.read(spark, path).where("k is null or k < 0").select("v")) == [("new too",), ("none again",)]


def test_versions_by_file_equal_the_whole_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    load = lambda at, change: spark.range(1000).where(f"id % 13 <> {change}").select(
        F.when(F.col("id") != 5, F.col("id")).alias("k"), F.when(F.col("id") == 400 + change, "moved").otherwise(F.col("id").cast("string")).alias("v"), F.lit(at).cast("timestamp_ntz").alias("load_timestamp"))
    loads = [load("2024-01-01", 1), load("2024-02-01", 2), load("2024-02-01", 2), load("2024-03-01", 3)]
    whole = scd2.scd2_empty(loads[0])
    for n, staged in enumerate(loads):
        whole = spark.createDataFrame(scd2.scd2_merge(whole, staged, ["k"]).collect(), whole.schema)
        before = {r.file for r in ct.manifest(spark, path).collect()}
        assert ct.merge_versions(staged, path, ["k"]) == (n != 2)
        assert rows_of(ct.read(spark, path).select(whole.columns)) == rows_of(whole)
        if n == 0:
            ct.replace(ct.read(spark, path).repartitionByRange(20, "k"), path)
        if n == 1:
            after = {r.file for r in ct.manifest(spark, path).collect()}
            assert 1 <= len(before & after) >= 17


def test_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    ct.append(some(spark, [(1, "a", "2024-01-01 10:00:00")]), path, ts="load_timestamp")
    got = ct.list_tables(spark, {"t": path, "none": str(tmp_path / "none")}).collect()
    assert (got[0].rows, got[0].files, str(got[0].newest)) == (1, 1, "2024-01-01 10:00:00") and got[0].bytes > 0 and got[1].rows == 0
