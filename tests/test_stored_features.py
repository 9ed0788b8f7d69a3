"""Stored histories, reports of one scan, words in a table, quantile states and interleaved layouts."""

import datetime as dt
import random
import re
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks, messages
from ledgerloom.operators import incremental as inc
from ledgerloom.session import settings
from ledgerloom.sources import tables

DAY = [dt.date(2024, 1, d) for d in range(1, 8)]


def files(spark, name, where):
    return {r.f for r in spark.table(name).where(where).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_history_reads_and_writes_open_rows_only(spark, database, rows):
    name = f"{database}.h"
    snap = lambda **kv: spark.createDataFrame(list(kv.items()), "k string, v string")
    tables.record_history(snap(a="1", b="1", c="1"), name, "k", DAY[0], close_missing=True)
    tables.record_history(snap(a="2", b="1"), name, "k", DAY[1], close_missing=True)
    closed = files(spark, name, f"part_valid = '{DAY[1]}'")
    for _ in range(2):
        tables.record_history(snap(a="2", b="3", c="4"), name, "k", DAY[2], close_missing=True)
    assert closed and files(spark, name, f"part_valid = '{DAY[1]}'") == closed
    expected = [("a", "1", DAY[0], DAY[1]), ("a", "2", DAY[1], None), ("b", "1", DAY[0], DAY[2]), ("b", "3", DAY[2], None), ("c", "1", DAY[0], DAY[1]), ("c", "4", DAY[2], None)]
    assert rows(tables.read_history(spark, name)) == sorted(expected, key=repr)
    # a second snapshot of a day adds to what the first one closed; then everything is closed
    tables.record_history(snap(a="2", c="4"), name, "k", DAY[2], close_missing=True)
    assert tables.read_history(spark, name).where(F.col("valid_to") == DAY[2]).count() == 2
    tables.record_history(snap().limit(0), name, "k", DAY[3], close_missing=True)
    assert spark.table(name).where(f"{tables.HISTORY} = 'open'").count() == 0
    on = lambda day: {r.k: r.v for r in tables.read_history(spark, name, day).collect()}
    assert [on(d) for d in DAY[:4]] == [dict(a="1", b="1", c="1"), dict(a="2", b="1"), dict(a="2", c="4"), {}]
    plan = tables.read_history(spark, name, DAY[2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((part_valid" in plan


def test_one_scan_for_all_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(1, "a"), (1, None), (None, ""), (2, "a"), (2, "b")]
    spark.createDataFrame(data, "k int, v string").write.parquet(path)
    df = spark.read.parquet(path)
    made = {
        "nulls": checks.nulls("k"), "surplus": checks.surplus("k"), "pairs": checks.surplus(["k", "v"]), "no null": checks.no_null("v"),
        "broken": checks.broken(F.col("k") > 1), "blank": checks.all_blank(["k", "v"]),
    }
    report = checks.table_report(df, made)
    assert {r.check: r.violations for r in report.collect()} == {"nulls": 1, "surplus": 2, "pairs": 0, "no null": 0, "broken": 3, "blank": 0}
    assert [r.check for r in report.collect() if r.passed] == ["pairs", "no null", "blank"]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    none = {r.check: r.violations for r in checks.table_report(df.limit(0), made).collect()}
    assert none == {"nulls": 0, "surplus": 0, "pairs": 0, "no null": 1, "broken": 0, "blank": 1}


def test_words_in_a_table_find_what_one_pattern_finds(spark):
    rng = random.Random(3)
    words = ["Der", "great value", "5%", "a.b", "für", "%", "x_1", "über alles", "c++", "(x)", "\\d", "no-one", "É"]
    parts = ["der", "DER", "great", "value", "5", "%", "a", ".", "b", "axb", "für", "xfür", "Über", "alles", " ", " ", "-", "no", "one", "c++", "(x)", "\\d", "d", "x_1", "é", "\n"]
    texts = [(i % 40, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 7)))) for i in range(400)] + [(50, None), (51, None), (51, "der"), (None, "5%"), (None, "q")]
    df = spark.createDataFrame(texts, "owner int, text string")
    table = lambda w: spark.createDataFrame([(x,) for x in w], "word string")
    got = lambda d: {r.owner: r.flag for r in d.collect()}
    for chosen in ([w] for w in words):
        assert got(messages.keyword_flags(df, "owner", "text", table(chosen), "flag")) == got(messages.keyword_flag(df, "owner", "text", chosen, "flag")), chosen
    assert got(messages.keyword_flags(df, "owner", "text", table([*words, None, ""]), "flag")) == got(messages.keyword_flag(df, "owner", "text", words, "flag"))
    assert set(got(messages.keyword_flags(df, "owner", "text", table([None]), "flag")).values()) == {False, None}


def test_phrases_meet_texts_in_one_join(spark):
    rng = random.Random(5)
    signs = ["der", "und", "x_1", "ü", "σ", "%", ".", ". ", " ", " ", "-", "\n", "(", "\\"]
    made = lambda most: "".join(rng.choice(signs) for _ in range(rng.randrange(1, most)))
    texts = [(i % 90, made(14)) for i in range(300)] + [(100, "a" * 300_000 + "-" * 300_000), (101, " " * 300_000 + "Der UND"), (102, None), (None, "der und der.")]
    df = spark.createDataFrame(texts, "owner int, text string")
    table = lambda w: spark.createDataFrame([(x,) for x in w], "word string")

    def plain(words):
        found = {}
        for owner, text in texts:
            hit = None if text is None else any(re.search(rf"\b{re.escape(w)}\b", text.lower(), re.ASCII) for w in words)
            found[owner] = max(filter(lambda x: x is not None, (hit, found.get(owner))), default=None)
        return found

    short = ["der und", "und", "der. der", "x_1%der", " ", "%", "der ", " x_1", "-der-"]
    longer = ["der und der", "der und der.", " der und", ". der-und", "x_1üder.", "σ und% "] + [made(8) for _ in range(9)]
    for words, joins in ((short, 1), (longer, 3), (short + longer, 3)):
        flagged = messages.keyword_flags(df, "owner", "text", table(words), "flag")
        assert flagged._jdf.queryExecution().optimizedPlan().toString().count("Join") == joins  # texts are searched for longer words only
        assert {r.owner: r.flag for r in flagged.collect()} == plain(words)
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            assert {r.owner: r.flag for r in messages.keyword_flags(df, "owner", "text", table(words), "flag").collect()} == plain(words)
    for word in [*short, *longer[:4]]:
        assert {r.owner: r.flag for r in messages.keyword_flags(df, "owner", "text", table([word]), "flag").collect()} == plain([word]), word


def test_quantiles_of_merged_states(spark):
    rng = random.Random(4)
    data = [(d, float(rng.gauss(0, 10)), rng.randrange(1000)) for d in range(20) for _ in range(300)]
    df = spark.createDataFrame(data, "day int, x double, n int")
    for column in ("x", "n"):
        states = inc.agg_state(df, "day", column, quantiles=True).withColumn("half", F.col("day") % 2)
        found = inc.finish_states(inc.merge_states(states, "half"), (0.25, 0.5)).collect()
        for r in found:
            values = [v[1 if column == "x" else 2] for v in data if v[0] % 2 == r.half]
            for share, q in ((0.25, r["q25"]), (0.5, r["q50"])):
                assert abs(sum(v <= q for v in values) / len(values) - share) < 0.03
    empty = inc.agg_state(spark.createDataFrame([(1, None)], "day int, n int"), "day", "n", quantiles=True)
    assert inc.finish_states(inc.merge_states(empty, "day")).first()["q50"] is None


def test_interleaved_layout_skips_files_on_every_column(spark, database):
    rng = random.Random(5)
    data = [(i, rng.randrange(10**6), rng.random() if i % 50 else None, dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(1000))) for i in range(20_000)]
    df = spark.createDataFrame(data, "id int, a int, b double, day date")
    name = f"{database}.z"
    tables.write_interleaved(df, name, ["a", "b"], files=64)
    assert spark.table(name).count() == 20_000 and spark.table(name).agg(F.sum("id")).first()[0] == sum(range(20_000))
    groups = [pq.ParquetFile(urlparse(f).path).metadata.row_group(0) for f in files(spark, name, "true")]
    for at, low, high in ((1, 300_000, 310_000), (2, 0.3, 0.31)):
        stats = [g.column(at).statistics for g in groups]
        met = sum(s.min <= high and s.max >= low for s in stats)
        assert met <= len(groups) / 3, (at, met, len(groups))
    tables.write_interleaved(df, f"{database}.one", ["day"])
    tables.write_interleaved(df.limit(0), f"{database}.none", ["a", "day"])
    assert spark.table(f"{database}.one").count() == 20_000 and spark.table(f"{database}.none").count() == 0
    with pytest.raises(ValueError, match="one to ten"):
        tables.write_interleaved(df, name, [])


def test_range_ids_count_reached_bounds(spark):
    df = spark.createDataFrame([(v,) for v in [None, -5, 0, 1, 2, 3, 9, 100]], "v int")
    found = {r.v: r.n for r in df.select("v", tables.range_id(F.col("v"), [1, 2, 9]).alias("n")).collect()}
    assert found == {None: 0, -5: 0, 0: 0, 1: 1, 2: 2, 3: 2, 9: 3, 100: 3}


def edge_rows(spark, data):
    """Edges (owner, follower, day of January) as a snapshot."""
    never = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    rows = [(dt.date(2024, 1, d), o, f, dt.datetime(2024, 1, d, 5), True, False, "follow") for o, f, d in data]
    df = spark.createDataFrame(rows, "date_key date, owner_id int, follower_id string, followed_at timestamp_ntz, following_status boolean, is_auto_follow boolean, note string")
    return df.withColumn("unfollowed_at", never)


def test_edge_history_shuffles_only_the_snapshot(spark, database, monkeypatch):
    name = f"{database}.edges"
    history = lambda: sorted((r.owner_id, r.follower_id, r.date_key.day, r.note) for r in spark.table(name).collect())
    tables.record_edges(edge_rows(spark, [(1, "a", 10), (2, "b", 11), (3, "c", 12)]), name, dt.datetime(2024, 1, 13))
    live = spark.table(tables.live_edges(spark, name)[1])
    second = edge_rows(spark, [(1, "a", 10), (3, "c", 14), (4, "d", 14)])
    with monkeypatch.context() as m:  # cut off before the new live edges are in force
        m.setattr(tables, "write_bucketed", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.record_edges(second, name, dt.datetime(2024, 1, 15))
    plan = tables.live_changes(live, second, dt.datetime(2024, 1, 15), ("owner_id", "follower_id"))._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in plan and join.count("Exchange") == 1 and plan.count("SortMergeJoin") == 1
    tables.record_edges(second, name, dt.datetime(2024, 1, 15))
    expected = [(1, "a", 10, "follow"), (2, "b", 11, "follow"), (3, "c", 12, "follow"), (2, "b", 11, "unfollow"), (3, "c", 14, "follow"), (4, "d", 14, "follow")]
    assert history() == sorted(expected)
    for _ in range(2):  # of several changes of an edge a run emits the newest, the next one the other
        tables.record_edges(second, name, dt.datetime(2024, 1, 15))
        assert history() == sorted([*expected, (3, "c", 12, "unfollow")])
    earlier = files(spark, name, f"{tables.RUN} = '2024-01-13'")
    tables.record_edges(edge_rows(spark, [(1, "a", 10)]), name, dt.datetime(2024, 1, 16), since=dt.date(2024, 1, 16))
    assert files(spark, name, f"{tables.RUN} = '2024-01-13'") == earlier
    now = spark.table(tables.live_edges(spark, name)[1])
    assert {(r.owner_id, r.note) for r in now.collect()} == {(1, "follow")}
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 2
