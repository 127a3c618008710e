"""Atomic replacement, snapshots that share files, stored aggregates kept up to date by partition."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tessera as ts
from tessera.operators import incremental, versions, views
from tessera.operators.tables import overwrite_all, table_layout, table_properties
from tessera.session import unique_name

MONTH = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH", 86_400_000))


def months(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, d date")


def day(m, d=5):
    return dt.date(2024, m, d)


def keys(df):
    return sorted(r["k"] for r in df.collect())


def local(uri):
    return uri.split(":", 1)[-1] if uri.startswith("file:") else uri


def data_files(*folders):
    return sorted(f for folder in folders for d, _, names in os.walk(local(folder)) for f in names
                  if f.endswith((".parquet", ".orc")) and "/_" not in d)


@pytest.fixture()
def plain(spark, table_name, scratch):
    ts.write_table(spark.range(10).select(F.col("id").cast("int").alias("k")), table_name, path=scratch("plain"))
    return table_name


@pytest.fixture()
def parted(spark, scratch):
    name = unique_name("parted")
    ts.write_table(months(spark, (1, day(1)), (2, day(2)), (3, day(3)), (4, None)), name, partitioning=MONTH,
                   path=scratch("parted"))
    return name


# ----------------------------------------------------------- killed between steps

class Killed(Exception):
    pass


def dies(*_, **__):
    raise Killed


def replace_all(spark, plain, parted):
    ts.write_table(spark.range(90, 95).select(F.col("id").cast("int").alias("k")), plain)
    return plain, list(range(10)), list(range(90, 95))


def replace_parts(spark, plain, parted):
    ts.write_table(months(spark, (8, day(2)), (9, day(7))), parted)
    return parted, [1, 2, 3, 4], [8, 9]


def replace_one(spark, plain, parted):
    ts.replace_partition(months(spark, (7, day(2))), parted, day(2))
    return parted, [1, 2, 3, 4], [1, 3, 4, 7]


def empty_one(spark, plain, parted):
    ts.replace_partition(months(spark).limit(0), parted, None)
    return parted, [1, 2, 3, 4], [1, 2, 3]


CASES = {"all": (replace_all, "plain", list(range(10)), list(range(90, 95))),
         "parts": (replace_parts, "parted", [1, 2, 3, 4], [8, 9]),
         "one": (replace_one, "parted", [1, 2, 3, 4], [1, 3, 4, 7]),
         "emptied": (empty_one, "parted", [1, 2, 3, 4], [1, 2, 3])}


@pytest.mark.parametrize("case", sorted(CASES))
def test_killed_before_the_commit(spark, plain, parted, monkeypatch, case):
    write, which, old, new = CASES[case]
    name = {"plain": plain, "parted": parted}[which]
    with monkeypatch.context() as m:
        m.setattr(versions, "create_text", dies)
        with pytest.raises(Killed):
            write(spark, plain, parted)
    assert keys(spark.table(name)) == keys(ts.read_table(spark, name)) == old
    write(spark, plain, parted)
    assert keys(spark.table(name)) == new


@pytest.mark.parametrize("case", sorted(CASES))
def test_killed_after_the_commit(spark, plain, parted, monkeypatch, case):
    write, which, old, new = CASES[case]
    name = {"plain": plain, "parted": parted}[which]
    with monkeypatch.context() as m:
        m.setattr(versions, "apply", dies)
        with pytest.raises(Killed):
            write(spark, plain, parted)
        assert keys(spark.table(name)) == old          # the catalog still names the old files, all there
    assert keys(ts.read_table(spark, name)) == new     # a reader of the library carries it out
    assert keys(spark.table(name)) == new
    home = versions.begin(spark, name).home
    assert data_files(home, home + "__versions") == data_files(*versions.in_use(spark, name))   # nothing is left over


@pytest.mark.parametrize("step", [1, 2, 3])
def test_killed_within_the_catalog_changes(spark, parted, monkeypatch, step):
    calls = []

    class Some:
        """A session whose catalog goes away at the n-th change."""

        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            if text.startswith("ALTER"):
                calls.append(text)
                if len(calls) > step:
                    raise Killed
            return spark.sql(text)

    real = versions.apply
    with monkeypatch.context() as m:
        m.setattr(versions, "apply", lambda s, table, record: real(Some(), table, record))
        with pytest.raises(Killed):
            ts.write_table(months(spark, (8, day(2)), (9, day(7))), parted)
    assert keys(ts.read_table(spark, parted)) == [8, 9] == keys(spark.table(parted))
    assert versions.recover(spark, parted) == versions.recover(spark, parted)


# --------------------------------------------------------------------- two writers

@pytest.mark.parametrize("managed", [False, True])
def test_of_two_writers_one_fails(spark, table_name, scratch, managed):
    ts.write_table(spark.range(10), table_name, path=None if managed else scratch("two"))

    def first(staging):
        spark.range(100, 103).write.insertInto(staging)
        ts.write_table(spark.range(50, 52), table_name)    # a second writer, quicker
    with pytest.raises(ts.ConcurrentWrite):
        overwrite_all(spark, table_name, first)
    assert sorted(r[0] for r in spark.table(table_name).collect()) == [50, 51]
    base = versions.begin(spark, table_name)
    assert data_files(base.home, base.home + "__versions") == data_files(base.location)


def test_many_writers_leave_one_version_each(spark, parted):
    errors, won = [], []

    def write(m):
        for k in range(3):
            try:
                ts.replace_partition(months(spark, (10 * m + k, day(m))), parted, day(m))
                won.append(m)
            except ts.ConcurrentWrite as e:
                errors.append(e)
    threads = [threading.Thread(target=write, args=(m,)) for m in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) + len(errors) == 9 and won
    assert versions.begin(spark, parted).version == len(won)
    assert len(keys(ts.read_table(spark, parted))) == 4


def test_append_beside_other_writers(spark, plain):
    base = versions.begin(spark, plain)
    ts.write_table(spark.range(20, 22).select(F.col("id").cast("int").alias("k")), plain, mode="append")
    assert versions.appended(spark, base) == base.version + 2      # two appends: both stay
    assert len(keys(spark.table(plain))) == 12
    base = versions.begin(spark, plain)
    ts.write_table(spark.range(3).select(F.col("id").cast("int").alias("k")), plain)
    with pytest.raises(ts.ConcurrentWrite):
        versions.appended(spark, base)                             # its rows went to files that were replaced


def test_records_are_few(spark, plain, monkeypatch):
    monkeypatch.setattr(versions, "RECORDS", 3)
    for _ in range(6):
        versions.commit(spark, versions.begin(spark, plain), "append")
    base = versions.begin(spark, plain)
    assert base.version == 6 and len(os.listdir(local(base.home) + "__log")) <= 4 * 2   # with checksums
    assert keys(spark.table(plain)) == list(range(10))


def test_a_new_table_in_an_old_folder(spark, plain, scratch):
    path = table_layout(spark, plain)["location"]
    versions.publish(spark, versions.begin(spark, plain), "overwrite", location=scratch("nowhere"))
    spark.sql(f"DROP TABLE {plain}")
    ts.write_table(spark.range(3), plain, path=path, mode="append")
    assert ts.read_table(spark, plain).count() == 13     # the folder's files, and no record of the old table


def test_comment_changes_keep_replaced_partitions(spark, table_name, scratch):
    df = spark.sql("SELECT 1 AS k, named_struct('x', 1) AS s, DATE'2024-01-05' AS d UNION ALL SELECT 2, named_struct('x', 2), DATE'2024-02-05'")
    ts.write_table(df, table_name, partitioning=MONTH, path=scratch("nest"))
    ts.replace_partition(df.where("k = 2").withColumn("k", F.lit(5)), table_name, day(2))
    inner = T.StructType([T.StructField("x", T.IntegerType(), True, {"comment": "new"})])
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", inner), T.StructField("d", T.DateType())])
    ts.update_table_schema(spark, table_name, schema)
    assert keys(spark.table(table_name)) == [1, 5]
    ts.replace_partition(df.where("k = 2"), table_name, day(2))
    assert keys(spark.table(table_name)) == [1, 2]


def test_rewrite_after_replacement(spark, parted):
    ts.replace_partition(months(spark, (7, day(2))), parted, day(2))
    wider = T.StructType([T.StructField("k", T.LongType()), T.StructField("d", T.DateType())])
    before = versions.begin(spark, parted)
    ts.update_table_schema(spark, parted, wider)
    assert keys(spark.table(parted)) == [1, 3, 4, 7]
    assert not data_files(before.home, before.home + "__versions")


# ----------------------------------------------------------------------- snapshots

def test_snapshot_outlives_its_base(spark, parted, scratch):
    path = scratch("snaplist")
    before = sorted(f for f in data_files(versions.begin(spark, parted).home))
    snap = unique_name("snap")
    assert ts.create_snapshot(spark, parted, snap, path=path)
    home = versions.begin(spark, parted).home
    assert data_files(home, home + "__versions") == before         # nothing was copied
    assert set(versions.references(spark, home).values()) == {1}
    ts.write_table(months(spark, (50, day(1)), (51, day(9))), parted, mode="append")
    ts.replace_partition(months(spark, (60, day(2))), parted, day(2))
    assert keys(ts.read_table(spark, snap)) == keys(spark.table(snap)) == [1, 2, 3, 4]
    assert ts.expire_partitions(spark, parted, dt.datetime(2024, 5, 1))
    ts.write_table(months(spark, (70, day(1))), parted)
    assert keys(spark.table(parted)) == [70] and keys(spark.table(snap)) == [1, 2, 3, 4]
    assert keys(ts.read_table(spark, snap, between=(day(2, 1), day(3, 28)))) == [2, 3]
    plan = ts.read_table(spark, snap, between=(day(2, 1), day(3, 28)))._jdf.queryExecution().executedPlan().toString()
    assert "d__month" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    ts.update_table_schema(spark, parted, expiration_time=1)
    ts.expire_tables(spark, 2)
    assert not spark.catalog.tableExists(parted) and keys(spark.table(snap)) == [1, 2, 3, 4]
    views.drop_snapshot(spark, snap)
    assert not data_files(home, home + "__versions", path)


def test_two_snapshots_share_files(spark, plain):
    one, two = unique_name("s1"), unique_name("s2")
    home = versions.begin(spark, plain).home
    ts.create_snapshot(spark, plain, one)
    ts.write_table(spark.table(plain).limit(0), plain, mode="append")
    ts.create_snapshot(spark, plain, two)
    assert versions.references(spark, home) == {home: 2}
    ts.write_table(spark.range(3).select(F.col("id").cast("int").alias("k")), plain)
    ts.drop_snapshot(spark, one)
    assert keys(spark.table(two)) == list(range(10))
    ts.drop_snapshot(spark, two)
    assert not data_files(home) and keys(spark.table(plain)) == [0, 1, 2]


def test_dropped_snapshot_leaves_the_base(spark, parted):
    snap = unique_name("snap")
    ts.create_snapshot(spark, parted, snap)
    ts.drop_snapshot(spark, snap)
    assert keys(spark.table(parted)) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="not a snapshot"):
        ts.drop_snapshot(spark, parted)


def test_snapshot_of_nothing_and_of_views(spark, table_name, scratch):
    ts.create_table(spark, table_name, spark.range(1).schema, path=scratch("empty"))
    snap, view, copied = unique_name("snap"), unique_name("v"), unique_name("copied")
    ts.create_snapshot(spark, table_name, snap)
    ts.write_table(spark.range(5), table_name, mode="append")
    assert spark.table(snap).count() == 0
    ts.create_view(spark, view, f"SELECT id FROM {table_name} WHERE id > 2")
    ts.create_snapshot(spark, view, copied)
    ts.create_snapshot(spark, snap, unique_name("again"))
    ts.write_table(spark.range(1), table_name)
    assert sorted(r[0] for r in spark.table(copied).collect()) == [3, 4]


def test_snapshot_keeps_tags(spark, table_name, scratch):
    df = spark.sql("SELECT 1 AS k, cast('1.5' as decimal(38,18)) AS p")
    ts.write_table(df, table_name, encode_decimals=True, path=scratch("tags"), description="priced")
    snap = unique_name("snap")
    ts.create_snapshot(spark, table_name, snap)
    assert ts.read_table(spark, snap).schema["p"].dataType == T.DecimalType(38, 18)
    assert table_properties(spark, snap)["tessera.snapshot_of"] == table_name


# -------------------------------------------------------------- stored aggregates

HOUR = ts.PartitionSpec("t", "timestamp", ts.TimePartitioning("HOUR"))
MEASURES = {"n": ts.Measure("count"), "n_v": ts.Measure("count", "v"), "s": ts.Measure("sum", "cast(v as decimal(18,2))"),
            "lo": ts.Measure("min", "v"), "hi": ts.Measure("max", "v"), "mean": ts.Measure("avg", "v")}


def hours(spark, rows):
    return spark.createDataFrame(rows, "g string, v double, t timestamp_ntz")


def hour(h, m=0):
    return dt.datetime(2024, 3, 1, h, m)


def whole(spark, base, keys, where=None):
    rows = spark.table(base).where(where or "true")
    out = rows.groupBy(*[F.expr(e).alias(k) for k, e in keys.items()]).agg(*[m.whole().alias(k) for k, m in MEASURES.items()])
    return sorted(map(str, out.collect()))


def test_incremental_view_follows_its_source(spark, table_name, scratch):
    base = unique_name("src")
    first = [("a", 1.0, hour(1)), ("b", 2.0, hour(1)), ("a", 3.5, hour(2)), (None, None, hour(3)), ("b", -1.0, None)]
    ts.write_table(hours(spark, first), base, partitioning=HOUR, path=scratch("src"))
    by = {"g": "g", "positive": "v > 0"}
    view = lambda: sorted(map(str, spark.table(table_name).collect()))
    assert ts.create_incremental_view(spark, table_name, base, keys=by, measures=MEASURES, path=scratch("view"))
    assert not ts.create_incremental_view(spark, table_name, base, keys=by, measures=MEASURES)
    assert view() == whole(spark, base, by)
    nothing = ts.refresh_incremental_view(spark, table_name)
    assert (nothing.changed, nothing.dropped, nothing.unchanged, nothing.merged) == ([], [], 4, False)

    steps = [
        (lambda: ts.write_table(hours(spark, [("a", 10.0, hour(2, 30)), ("c", 1.0, hour(9))]), base, mode="append"), 2, 0),
        (lambda: ts.replace_partition(hours(spark, [("a", 0.5, hour(1))]), base, hour(1)), 1, 0),
        (lambda: ts.replace_partition(hours(spark, [("z", 7.0, None)]), base, None), 1, 0),
        (lambda: ts.replace_partition(hours(spark, []), base, hour(2)), 0, 1),
        (lambda: ts.write_table(hours(spark, [("q", 1.0, hour(5)), ("q", None, hour(6))]), base), 2, 4),
    ]
    for change, n_changed, n_dropped in steps:
        change()
        done = ts.refresh_incremental_view(spark, table_name)
        assert (len(done.changed), len(done.dropped), done.merged) == (n_changed, n_dropped, True)
        assert view() == whole(spark, base, by)


def test_refresh_reads_changed_partitions_only(spark, table_name, scratch):
    base = unique_name("src")
    ts.write_table(hours(spark, [("a", float(h), hour(h)) for h in range(12)]), base, partitioning=HOUR, path=scratch("src"))
    ts.create_incremental_view(spark, table_name, base, keys={"g": "g"}, measures=MEASURES)
    ts.write_table(hours(spark, [("a", 1.0, hour(4))]), base, mode="append")
    ts.replace_partition(hours(spark, [("b", 1.0, hour(7))]), base, hour(7))
    done = ts.refresh_incremental_view(spark, table_name)
    assert done.changed == ["t__hour=2024-03-01 04%3A00%3A00", "t__hour=2024-03-01 07%3A00%3A00"] and done.unchanged == 10
    rows = incremental.changed_rows(spark, table_name, done.changed)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "t__hour" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    read = {os.path.dirname(r[0]) for r in rows.select("_metadata.file_path").distinct().collect()}
    assert len(read) == 2 and rows.count() == 3


def test_refresh_that_dies_is_made_good(spark, table_name, scratch, monkeypatch):
    base = unique_name("src")
    ts.write_table(hours(spark, [("a", 1.0, hour(1))]), base, partitioning=HOUR, path=scratch("src"))
    ts.create_incremental_view(spark, table_name, base, keys={"g": "g"}, measures=MEASURES)
    old = sorted(map(str, spark.table(table_name).collect()))
    ts.write_table(hours(spark, [("a", 5.0, hour(1)), ("b", 5.0, hour(2))]), base, mode="append")
    with monkeypatch.context() as m:
        m.setattr(incremental, "overwrite_all", dies)
        with pytest.raises(Killed):
            ts.refresh_incremental_view(spark, table_name)
    assert sorted(map(str, spark.table(table_name).collect())) == old
    done = ts.refresh_incremental_view(spark, table_name)
    assert (done.changed, done.merged) == ([], True)
    ts.write_table(hours(spark, [("a", 5.0, hour(1))]), base, mode="append")
    with monkeypatch.context() as m:
        m.setattr(versions, "create_text", dies)
        with pytest.raises(Killed):
            ts.refresh_incremental_view(spark, table_name)
    ts.refresh_materialized_view(spark, table_name)
    assert sorted(map(str, spark.table(table_name).collect())) == whole(spark, base, {"g": "g"})


def test_incremental_view_of_a_plain_table(spark, plain, scratch):
    view, total = unique_name("v"), unique_name("t")
    m = {"n": ts.Measure("count"), "s": ts.Measure("sum", "k")}
    ts.create_incremental_view(spark, view, plain, keys={"odd": "k % 2"}, measures=m, where="k > 3")
    ts.create_incremental_view(spark, total, plain, keys={}, measures=m, where="k > 100")
    assert sorted(map(tuple, spark.table(view).collect())) == [(0, 3, 18), (1, 3, 21)]
    assert list(map(tuple, spark.table(total).collect())) == [(0, None)]
    ts.write_table(spark.range(200, 203).select(F.col("id").cast("int").alias("k")), plain, mode="append")
    for v in (view, total):
        ts.refresh_incremental_view(spark, v)
    assert sorted(map(tuple, spark.table(view).collect())) == [(0, 5, 420), (1, 4, 222)]
    assert list(map(tuple, spark.table(total).collect())) == [(3, 603)]


def test_measures_are_checked(spark, plain):
    with pytest.raises(ValueError, match="not one of"):
        ts.create_incremental_view(spark, unique_name("v"), plain, keys={}, measures={"m": ts.Measure("median", "k")})
    with pytest.raises(ValueError, match="round twice"):
        ts.create_incremental_view(spark, unique_name("v"), plain, keys={},
                                   measures={"m": ts.Measure("avg", "cast(k as decimal(10,2))")})
    with pytest.raises(ValueError, match="not an incremental view"):
        ts.refresh_incremental_view(spark, plain)
