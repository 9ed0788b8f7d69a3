"""Stored tables, loads and exports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import checks
from ledgerloom.sources import readers, tables
from ledgerloom.streaming.copy import continuous_copy, read_copy

TYPES = "k int, day timestamp_ntz, v string"


def at(y, m, d):
    return dt.datetime(y, m, d)


@pytest.fixture
def months(spark, database):
    name = f"{database}.t"
    data = [(1, at(2024, 1, 5), "a"), (2, at(2024, 1, 9), "b"), (3, at(2024, 2, 5), "c"), (4, at(2024, 3, 1), "d"), (5, None, "n")]
    tables.write_partitioned(spark.createDataFrame(data, TYPES), name, "day", "MONTH")
    return name


def with_part(df):
    return df.withColumn("part_day", F.date_format("day", "yyyy-MM"))


def stored(spark, name):
    return sorted((r.k, r.v) for r in spark.table(name).collect())


def files_of(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def test_replace_by_values(spark, months):
    fresh = with_part(spark.createDataFrame([(7, at(2024, 1, 5), "x"), (8, at(2024, 4, 1), "y"), (9, None, "m")], TYPES))
    before = files_of(spark, months)
    for times in (1, 2):
        tables.replace_by_values(fresh, months, "day")
        # A NULL value replaces nothing, so the row without a day is added each time.
        assert stored(spark, months) == [(2, "b"), (3, "c"), (4, "d"), (5, "n"), (7, "x"), (8, "y")] + [(9, "m")] * times
    untouched = [f for f in before if "2024-02" in f or "2024-03" in f]
    assert set(untouched) <= files_of(spark, months)


def test_replace_by_values_empties_a_partition(spark, months):
    moved = spark.createDataFrame([(3, at(2024, 5, 5), "moved")], TYPES)
    tables.replace_by_values(with_part(moved), months, "k")
    assert stored(spark, months) == [(1, "a"), (2, "b"), (3, "moved"), (4, "d"), (5, "n")]


def test_replace_by_values_unpartitioned(spark, database):
    name = f"{database}.plain"
    tables.write(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"), name)
    tables.replace_by_values(spark.createDataFrame([(1, "n"), (3, "m")], "k int, v string"), name, "k")
    assert stored(spark, name) == [(1, "n"), (2, "c"), (3, "m")]


def test_merge_moves_rows_between_partitions(spark, months):
    before = files_of(spark, months)
    new = with_part(spark.createDataFrame([(3, at(2024, 1, 20), "moved"), (6, at(2024, 1, 21), "new")], TYPES))
    for _ in range(2):
        tables.merge(new, months, "k")
        assert stored(spark, months) == [(1, "a"), (2, "b"), (3, "moved"), (4, "d"), (5, "n"), (6, "new")]
    assert {f for f in before if "2024-03" in f} <= files_of(spark, months)
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {months}").collect()]
    assert "part_day=2024-02" not in parts


def test_merge_by_version(spark, database):
    name = f"{database}.v"
    tables.write(spark.createDataFrame([(1, 5, "t"), (2, 5, "t")], "k int, ver int, v string"), name)
    tables.merge(spark.createDataFrame([(1, 4, "n"), (2, 6, "n"), (3, 1, "n")], "k int, ver int, v string"), name, "k", "ver")
    assert stored(spark, name) == [(1, "t"), (2, "n"), (3, "n")]


def test_overwrite_partitions_keeps_the_others(spark, months):
    tables.overwrite_partitions(with_part(spark.createDataFrame([(9, at(2024, 2, 1), "z")], TYPES)), months)
    assert stored(spark, months) == [(1, "a"), (2, "b"), (4, "d"), (5, "n"), (9, "z")]


def test_replace_slice_keeps_rows_outside(spark, months):
    fresh = spark.createDataFrame([(8, at(2024, 1, 7), "x")], TYPES)
    for _ in range(2):
        tables.replace_slice(fresh, months, "day", "MONTH", dt.date(2024, 1, 6), dt.date(2024, 3, 1))
        assert stored(spark, months) == [(1, "a"), (4, "d"), (5, "n"), (8, "x")]
    tables.replace_slice(fresh.where("false"), months, "day", "MONTH", dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert stored(spark, months) == [(4, "d"), (5, "n")]


def test_read_slice_prunes_partitions(spark, months):
    df = tables.read_slice(spark, months, dt.date(2024, 1, 8), dt.date(2024, 3, 1))
    assert sorted(r.k for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "part_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(day" in plan


def test_required_partition_filter(spark, database):
    name = f"{database}.guarded"
    df = spark.createDataFrame([(1, at(2024, 1, 5), "a")], TYPES)
    tables.update_table(df, name, "truncate", "day", "DAY", partition_expiry_days=30, partition_filter=True)
    with pytest.raises(ValueError):
        tables.read_slice(spark, name)
    with pytest.raises(ValueError):
        readers.require_slice(df, "day", dt.date(2024, 1, 1), None)
    assert tables.read_slice(spark, name, dt.date(2024, 1, 1), dt.date(2024, 2, 1)).count() == 1


def test_update_table_modes(spark, database):
    name, df = f"{database}.u", spark.createDataFrame([(1, at(2024, 1, 5), "a")], TYPES)
    tables.update_table(df, name, "truncate")
    tables.update_table(df, name, "append")
    assert stored(spark, name) == [(1, "a"), (1, "a")]
    for mode in ("truncate_partition", "unknown"):
        with pytest.raises(ValueError):
            tables.update_table(df, name, mode)


def test_expiry(spark, months):
    assert tables.expire_partitions(spark, months, 31, dt.date(2024, 3, 2)) == 1
    assert stored(spark, months) == [(3, "c"), (4, "d"), (5, "n")]
    tables.set_table_expiry(spark, months, 10, dt.date(2024, 3, 1))
    assert not tables.expire_table(spark, months, dt.date(2024, 3, 10))
    assert tables.expire_table(spark, months, dt.date(2024, 3, 11)) and not tables.exists(spark, months)


def test_conform_for_ingest(spark):
    df = spark.createDataFrame(
        [(1, 1.5, True, dt.date(2024, 1, 2), "né", None), (None, float("nan"), None, None, None, None)],
        "i smallint, f float, b boolean, d date, s string, t timestamp_ntz",
    )
    out = tables.conform_for_ingest(df)
    assert [f.dataType for f in out.schema] == [
        T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType(), T.StringType(), T.TimestampNTZType(),
    ]
    first, second = out.collect()
    assert first.d == at(2024, 1, 2) and first.t == at(1970, 1, 1) and first.s == "né"
    assert second.d == at(1970, 1, 1) and second.i is None and second.b is None
    assert tables.conform_for_ingest(df, fill_epoch=False).collect()[1].d is None


def test_export_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b")], "k int, v string")
    assert tables.export(df, str(tmp_path), "x", "csv").endswith("/x.csv")
    assert tables.export(df, str(tmp_path), "x.json", "json").endswith("/x.json")
    assert readers.load_csv_text(spark, f"{tmp_path}/x.csv").first().v == "a,b"
    with pytest.raises(ValueError):
        tables.export(df, str(tmp_path), "x", "xlsx")


GRID = 'Report,,\n,,\n"No, id",Name,Note\n1,Ann,\n2,"Bo, jr",x\n3,Cy\n'


def test_load_grid(spark, tmp_path, rows):
    path = tmp_path / "grid.csv"
    path.write_text(GRID)
    df = readers.load_grid(spark, str(path), header_row=3)
    assert df.columns == ["No, id", "Name", "Note"]
    assert rows(df) == [("1", "Ann", None), ("2", "Bo, jr", "x"), ("3", "Cy", None)]
    kept = readers.load_grid(spark, str(path), header_row=3, blank_to_null=False)
    assert rows(kept)[0] == ("1", "Ann", "")
    part = readers.load_grid(spark, str(path), header_row=1, columns=(2, 3), rows=(3, 4))
    assert part.columns == ["Name", "Note"] and rows(part) == [("Ann", None)]
    with pytest.raises(ValueError):
        readers.load_grid(spark, str(path), header_row=99)


def test_run_sql(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("SELECT :x + 1 AS y")
    assert readers.run_sql(spark, path=str(path), args={"x": 2}).first().y == 3
    with pytest.raises(ValueError):
        readers.run_sql(spark)


def test_file_inventory(spark, rows):
    sheet = readers.KEPT_KINDS[0]
    data = [
        (1, "f1", "plan", sheet, True, False), (2, "f2", "plan", sheet, True, False), (3, "f3", "results-1-2", sheet, True, False),
        (4, "f4", "Untitled spreadsheet 2", sheet, True, False), (5, "f5", "my results-1-2", sheet, True, False),
        (6, "f6", "a.pdf", "application/pdf", True, False), (7, "f7", "b.pdf", "application/pdf", False, False),
        (8, "f8", "c.txt", "text/plain", True, False), (9, "f9", "gone", sheet, True, True), (10, "f10", "", sheet, True, False),
    ]
    df = spark.createDataFrame(data, "seq int, file_id string, name string, mime_type string, owned boolean, trashed boolean")
    assert rows(readers.file_inventory(df)) == [("a.pdf", "f6"), ("my results-1-2", "f5"), ("plan", "f2")]


def test_list_files(spark, tmp_path):
    (tmp_path / "a1.txt").write_text("12345")
    (tmp_path / "b1.txt").write_text("1")
    assert [(r.name, r.length) for r in readers.list_files(spark, str(tmp_path), "a").collect()] == [("a1.txt", 5)]


def test_ingest_and_schema_changes(spark, database):
    name = f"{database}.i"
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2))], "k int, day date")
    tables.ingest(df, name, "truncate", "day")
    tables.ingest(df, name, "append", "day")
    assert spark.table(name).count() == 2
    assert tables.table_schema(spark, name) == [("k", "bigint"), ("day", "timestamp_ntz"), ("part_day", "string")]
    tables.truncate(spark, name)
    assert spark.table(name).isEmpty()
    tables.drop(spark, name)
    tables.drop(spark, name)
    with pytest.raises(ValueError):
        tables.ingest(df, name, "merge")


def test_seed_and_stack(spark, database, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("k,v\n1,a\n2,b\n")
    tables.seed(spark, str(path), f"{database}.s1")
    tables.ctas(spark, f"{database}.s2", f"SELECT k, true AS extra FROM {database}.s1")
    stacked = tables.stack_tables(spark, [f"{database}.s1", f"{database}.s2"])
    assert stacked.columns == ["k", "v", "extra"] and stacked.count() == 4


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "")], "k int, v string")
    assert not checks.check_query(checks.expect_not_null(df, "v"))
    assert checks.check_query(checks.expect_some_null(df, "k"))
    assert not checks.check_query(checks.expect_some_null(df.where("k = 1"), "k"))
    assert [tuple(r) for r in checks.expect_unique(df, "k").collect()] == [(1, 2)]
    assert not checks.is_blank(df).first()[0]
    assert checks.is_blank(df.where("k IS NULL")).first()[0] and checks.is_blank(df.where("false")).first()[0]


def test_streamed_copy_takes_late_rows_and_skips_replayed_ones(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for days in ({1: 20, 3: 20}, {2: 1, 3: 20}, {None: 1}):  # the second delivery is older
        data = [(k, at(2024, 1, day)) for k, day in days.items()]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        continuous_copy(spark, source, schema, target, state, ["k"]).awaitTermination()
    copied = read_copy(spark, schema, target).collect()
    assert sorted((r.k for r in copied), key=str) == [1, 2, 3, None]


def test_merge_drops_partitions_that_lost_their_last_row(spark, database, rows):
    name, fields = f"{database}.moved", "k string, version int, part string"
    tables.write(spark.createDataFrame([("k1", 10, "P"), ("k2", 1, "Q")], fields), name, partition_by=["part"])
    tables.merge(spark.createDataFrame([("k1", 5, "Q"), ("k2", 2, "R")], fields), name, "k", "version")
    assert rows(spark.table(name).select("k", "version", "part")) == [("k1", 10, "P"), ("k2", 2, "R")]


def test_load_grid_keeps_line_breaks_in_cells(spark, tmp_path, rows):
    path = tmp_path / "grid.csv"
    path.write_text('title\na,b\n1,"x\ny"\n2,\n')
    assert rows(readers.load_grid(spark, str(path), header_row=2)) == [("1", "x\ny"), ("2", None)]
