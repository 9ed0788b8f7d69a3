"""Stored changes that are cut off, compaction of what is new, keyed streams, and sheets read by many tasks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import readers, tables
from ledgerloom.streaming.copy import continuous_copy, read_copy

FIELDS = "k string, version int, part string"


def stored(spark, database, data):
    name = f"{database}.t"
    tables.write(spark.createDataFrame(data, FIELDS), name, partition_by=["part"])
    return name


@pytest.mark.parametrize("cut", ["overwrite_partitions", "drop_partitions"])
def test_next_merge_finishes_one_that_was_cut_off(spark, database, rows, monkeypatch, cut):
    name = stored(spark, database, [("k1", 1, "it's P"), ("k2", 1, "Q"), ("k3", 1, "Q"), ("k4", 1, None)])
    moved = spark.createDataFrame([("k1", 2, "R"), ("k4", 2, "R")], FIELDS)

    def stops(*_):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(tables, cut, stops)
        with pytest.raises(RuntimeError, match="cut off"):
            tables.merge(moved, name, "k", "version")
    assert tables.table_property(spark, name, tables.SWAP)
    tables.merge(spark.createDataFrame([("k2", 5, "Q")], FIELDS), name, "k", "version")
    assert rows(spark.table(name)) == [("k1", 2, "R"), ("k2", 5, "Q"), ("k3", 1, "Q"), ("k4", 2, "R")]
    assert tables.table_property(spark, name, tables.SWAP) is None
    assert not tables.finish_swap(spark, name)


def test_replacement_by_values_is_finished_too(spark, database, rows, monkeypatch):
    name = stored(spark, database, [("a", 1, "P"), ("b", 1, "Q")])
    with monkeypatch.context() as m:
        m.setattr(tables, "drop_partitions", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.replace_by_values(spark.createDataFrame([("a", 2, "Q")], FIELDS), name, "k")
    tables.compact_table(spark, name, "k", "version")
    assert rows(spark.table(name)) == [("a", 2, "Q"), ("b", 1, "Q")]


def files(spark, name):
    return {r.f for r in spark.table(name).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_compaction_touches_only_what_is_new(spark, database, rows):
    name = stored(spark, database, [(f"k{i}", 1, f"p{i % 6}") for i in range(60)] + [("k0", 2, "p0")])
    tables.compact_table(spark, name, "k", "version")
    assert spark.table(name).count() == 60
    before = files(spark, name)
    # k1 is in p1: a newer version goes to p4; k2 is in p2: an older version goes to p5
    tables.write(spark.createDataFrame([("k1", 2, "p4"), ("k2", 0, "p5"), ("new", 1, "p5")], FIELDS), name, "append", ["part"])
    appended = files(spark, name) - before
    tables.compact_table(spark, name, "k", "version")
    after = files(spark, name)
    of = lambda p, among: {f for f in among if f"part={p}/" in f}
    assert all(of(p, after) == of(p, before) for p in ("p0", "p2", "p3"))
    assert of("p4", after) == of("p4", before | appended)  # it has lost no row
    assert not of("p1", after) & before and not of("p5", after) & (before | appended)
    found = {r.k: (r.version, r.part) for r in spark.table(name).collect()}
    assert len(found) == spark.table(name).count() == 61
    assert found["k1"] == (2, "p4") and found["k2"] == (1, "p2") and found["new"] == (1, "p5") and found["k0"] == (2, "p0")
    again = files(spark, name)
    tables.compact_table(spark, name, "k", "version")
    assert files(spark, name) == again


def test_keyed_copy_reads_no_earlier_batch(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "k long, v string"
    struct = spark.createDataFrame([], schema).schema
    counts = []
    for number in range(5):
        data = [(k, f"b{number}") for k in range(number * 10, number * 10 + 20)] + [(None, f"b{number}")] * 2
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        query = continuous_copy(spark, source, struct, target, state, ["k"])  # started again from the checkpoint each time
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        plan = query._jsq.explainInternal(False)
        assert plan.count("FileScan") <= 2 and target not in plan
        counts.append((sum(p["numInputRows"] for p in progress), progress[-1]["stateOperators"][0]["numRowsTotal"]))
    # each delivery is read once a branch, the keys and the rows without one, however much was copied before
    assert len({n for n, _ in counts}) == 1 and [t for _, t in counts] == [20, 30, 40, 50, 60]
    copied = read_copy(spark, struct, target)
    assert copied.count() == 60 + 10 and copied.where("k is not null").groupBy("k").count().where("count > 1").count() == 0
    assert copied.where("v = 'b4' AND k < 50").count() == 0


def sheet(rng, n):
    cell = lambda: rng.choice(["", "a", "plain text", 'say ""hi""', "b,c", "line\nbreak", "x\r\ny\n\n", '"', "5\" pipe", "é中", " "])
    lines = []
    for _ in range(n):
        cells = []
        for _ in range(rng.randrange(1, 5)):
            c = cell()
            cells.append(f'"{c.replace(chr(34), chr(34) * 2)}"' if any(x in c for x in ",\n") or c.startswith('"') or rng.random() < 0.2 else c)
        lines.append(",".join(cells) if rng.random() < 0.9 else "")
    return "\n".join(lines)


@pytest.mark.parametrize("split", ["900", "128m"])
def test_rows_of_a_sheet_do_not_depend_on_its_splits(spark, tmp_path, split):
    rng = random.Random(int(split.strip("m")))
    expected = []
    for number in range(2):
        text = sheet(rng, 500) + ("\n" if number else "") + ('\nopen,"never closed\nto the,end' if number else "")
        path = tmp_path / f"s{number}.csv"
        path.write_bytes(text.encode())
        expected += [(path.name, n, cells) for n, cells in enumerate(csv.reader(io.StringIO(text, newline="")), 1) if cells]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = readers.grid_rows(spark, str(tmp_path))
        got = sorted((r.file.rsplit("/", 1)[1], r.row, r.cells) for r in found.collect())
        tasks = spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == sorted(expected) and (tasks > 15) == (split == "900")


def test_partitions_by_the_names_of_files(spark, tmp_path):
    data = [("a b", 1), ("a/b=c", 2), ("50%+", 3), ("é", 4), (None, 5), ("a b", 6)]
    path = str(tmp_path / "parted")
    spark.createDataFrame(data, "p string, v int").repartition(1).write.partitionBy("p").parquet(path)
    listed = {r.p: r.files for r in readers.list_partitions(spark, path, "p").collect()}
    assert listed == dict.fromkeys({p for p, _ in data}, 1)
