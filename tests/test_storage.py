"""Loads, stored tables, history and reports."""

import datetime as dt
import pathlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltworks.config import shared_dir
from siltworks.sources import loads, stored
from siltworks.sources.registry import Registry, SourceGroup, SourceTable, add_lineage, source_freshness


def test_csv_lines_are_good_or_rejected_whatever_is_selected(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,amount\n1,"x, y",2.5\n2,z,bad\n3,w\n,q,1\n5,v,4,9\n')
    good, bad = loads.load_csv(spark, str(tmp_path), "id int, name string, amount double")
    assert [tuple(r) for r in good.orderBy("name").collect()] == [(None, "q", 1.0), (1, "x, y", 2.5)]
    assert sorted(r[0] for r in good.select("name").collect()) == ["q", "x, y"]
    assert good.select("id").count() == 2
    assert sorted(r[0] for r in bad.collect()) == ["2,z,bad", "3,w", "5,v,4,9"]


def test_rejected_lines_come_out_as_they_landed(spark, tmp_path):
    for name, lines in (("a", ['1,"x, y",2.5', '2," z ""q""", bad', "", '  3 ,"open', 'ü;é']), ("b", ['4, b ,4.5', '"7","w","1e2"', '8,x,y,z'])):
        (tmp_path / f"{name}.csv").write_text("\n".join(["id,name,amount", *lines]) + "\n")
    good, bad = loads.load_csv(spark, str(tmp_path), "id int, name string, amount double")
    assert sorted(r[0] for r in bad.collect()) == sorted(['2," z ""q""", bad', '  3 ,"open', 'ü;é', '8,x,y,z'])
    assert sorted(tuple(r) for r in good.collect()) == [(1, "x, y", 2.5), (4, " b ", 4.5), (7, "w", 100.0)]
    assert sorted(r[0] for r in good.select("amount").collect()) == [2.5, 4.5, 100.0]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text("")
    good, bad = loads.load_csv(spark, str(tmp_path / "c"), "id int")
    assert good.count() == bad.count() == 0


def test_seed_with_blanks_in_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("state_code, state_name\nAL, Alabama\nWY, Wyoming\n")
    got = loads.load_seed(spark, str(tmp_path / "s.csv"), "state_code string, state_name string")
    assert [tuple(r) for r in got.orderBy("state_code").collect()] == [("AL", "Alabama"), ("WY", "Wyoming")]


class FakeSession:
    """Just the two things shared_dir asks a session for."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_comes_from_the_session():
    a, b = (shared_dir(FakeSession("/shared/x/", "yarn")) for _ in range(2))
    assert a.startswith("/shared/x/siltworks/") and a != b
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession(None, "yarn"))
    assert "siltworks-" in shared_dir(FakeSession(None, "local[2]"))


def files(path):
    """Data files with their times, by partition folder."""
    out = {}
    for f in sorted(pathlib.Path(path).rglob("*.parquet")):
        out.setdefault(f.parent.name, []).append((f.name, f.stat().st_mtime_ns))
    return out


def test_merge_rewrites_only_the_partitions_of_its_keys(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        stored.read_table(spark, path)
    stored.merge_into(path, spark.range(200).selectExpr("id", "'old' as v"), ["id"], buckets=16)
    before = files(path)
    assert len(before) == 16 and all(name.startswith("key_of_16=") for name in before)
    out = stored.merge_into(path, spark.sql("select * from values (3, 'new'), (500, 'added') as t(id, v)"), ["id"])
    assert out.columns == ["id", "v"] and out.count() == 201
    assert rows(out.where("v <> 'old'")) == [(3, "new"), (500, "added")]
    changed = [name for name, found in files(path).items() if found != before[name]]
    assert 1 <= len(changed) <= 2
    unchanged = files(path)
    assert stored.merge_into(path, spark.range(0).selectExpr("id", "'x' as v"), ["id"]).count() == 201 and files(path) == unchanged


def test_merge_with_changed_columns(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    stored.merge_into(path, old, ["id"], buckets=4)
    new = spark.createDataFrame([(2, "B", 1), (3, "c", 1), (None, "m", 1)], "id long, v string, n int")
    assert rows(stored.merge_into(path, new, ["id"])) == [(None, "m", 1), (None, "n", None), (1, "a", None), (2, "B", 1), (3, "c", 1)]
    before = files(path)
    with pytest.raises(ValueError, match="schema changed"):
        stored.merge_into(path, old, ["id"], on_schema_change="fail")
    assert files(path) == before and stored.read_table(spark, path).count() == 5
    slim = stored.merge_into(path, spark.createDataFrame([(9,)], "id int"), ["id"], on_schema_change="sync_all_columns")
    assert slim.columns == ["id"] and slim.count() == 6
    stored.refresh(old, str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not partitioned by a key"):
        stored.merge_into(str(tmp_path / "plain"), old, ["id"])


def test_a_failed_merge_leaves_the_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    stored.merge_into(path, spark.range(40).selectExpr("id", "1 as v"), ["id"], buckets=4)
    before = files(path)
    with pytest.raises(Exception, match="no good"):
        stored.merge_into(path, spark.range(40).selectExpr("id", "if(id = 7, raise_error('no good'), 2) as v"), ["id"])
    assert files(path) == before and stored.read_table(spark, path).where("v = 1").count() == 40


def test_high_water_mark(spark, tmp_path):
    path = str(tmp_path / "h")
    first = spark.createDataFrame([(1, 10), (2, 20)], "id int, ts int")
    stored.append_newer(path, first, "ts")
    before = files(path)
    more = spark.createDataFrame([(2, 20), (3, 15), (4, 30)], "id int, ts int")
    assert sorted(r["id"] for r in stored.append_newer(path, more, "ts").collect()) == [1, 2, 4]
    assert set(before["h"]) <= set(files(path)["h"])
    wider = spark.createDataFrame([(5, 40, "n")], "id int, ts int, note string")
    assert sorted((r["id"], r["note"]) for r in stored.append_newer(path, wider, "ts").collect() if r["id"] > 3) == [(4, None), (5, "n")]
    narrow = spark.createDataFrame([(6, 50)], "id int, ts int")
    assert stored.append_newer(path, narrow, "ts").columns == ["id", "ts", "note"]
    out = stored.append_newer(path, spark.createDataFrame([(7, 60)], "id int, ts int"), "ts", "sync_all_columns")
    assert out.columns == ["id", "ts"] and out.count() == 6 and stored.high_water_mark(spark, path) == 60
    with pytest.raises(ValueError, match="schema changed"):
        stored.append_newer(path, wider, "ts", "fail")
    empty = spark.createDataFrame([], "id int, ts int")
    assert stored.append_newer(path, empty, "ts").count() == 6
    assert stored.newer_rows(more, empty, "ts").count() == 3


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "bigint"])
def test_the_mark_comes_from_file_statistics(spark, tmp_path, kind):
    path = str(tmp_path / "m")
    times = "cast(id as bigint)" if kind == "bigint" else f"cast(timestampadd(DAY, id, timestamp_ntz'2024-01-01 10:00:00') as {kind})"
    stored.append_newer(path, spark.range(10).selectExpr("id", f"{times} as ts"), "ts")
    plan = stored.marks_plan(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(_mark)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    out = stored.append_newer(path, spark.range(5, 15).selectExpr("id", f"{times} as ts"), "ts")
    assert sorted(r[0] for r in out.select("id").collect()) == list(range(15))


def test_evolve_policies(spark):
    old = spark.createDataFrame([(1, "x")], "id int, gone string")
    new = spark.createDataFrame([(2, 5)], "id int, added int")
    assert stored.evolve(old, new, "sync_all_columns").columns == ["id", "added"]
    assert stored.evolve(old, new, "append_new_columns").columns == ["id", "gone", "added"]
    with pytest.raises(ValueError):
        stored.evolve(old, new, "fail")
    with pytest.raises(ValueError):
        stored.evolve(old, new, "guess")


def test_snapshot_over_three_runs(spark, rows):
    def batch(*r):
        return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in r], "k int, v string, u timestamp_ntz")

    one = stored.snapshot(None, batch((1, "a", 1), (2, "b", 1)), ["k"], "u")
    two = stored.snapshot(one, batch((1, "A", 3), (1, "aa", 2), (2, "b", 1), (3, "c", 3)), ["k"], "u")
    three = stored.snapshot(two, batch((2, "late", 1), (3, "C", 5)), ["k"], "u")
    got = rows(three.select("k", "v", F.dayofmonth("valid_from"), F.dayofmonth("valid_to")))
    assert got == [(1, "A", 3, None), (1, "a", 1, 3), (2, "b", 1, None), (3, "C", 5, None), (3, "c", 3, 5)]


def test_stored_history_touches_current_rows_only(spark, tmp_path, rows):
    def batch(*r):
        return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in r], "k int, v string, u timestamp_ntz")

    path = str(tmp_path / "h")
    for run, b in (("r1", batch((1, "a", 1), (2, "b", 1))), ("r2", batch((1, "A", 3), (1, "aa", 2), (2, "b", 1), (3, "c", 3)))):
        stored.snapshot_into(path, b, ["k"], "u", run)
    closed = files(path)["closed_in=r2"]
    out = stored.snapshot_into(path, batch((2, "late", 1), (3, "C", 5)), ["k"], "u", "r3")
    assert rows(out.select("k", "v", F.dayofmonth("valid_from"), F.dayofmonth("valid_to"))) == [
        (1, "A", 3, None), (1, "a", 1, 3), (2, "b", 1, None), (3, "C", 5, None), (3, "c", 3, 5)]
    assert files(path)["closed_in=r2"] == closed
    for run in ("r2", "current"):
        with pytest.raises(ValueError, match="in use"):
            stored.snapshot_into(path, batch((9, "x", 9)), ["k"], "u", run)


def test_clustered_files_prune(spark, tmp_path):
    stored.write_clustered(spark.range(10_000).withColumn("g", F.col("id") / 100), str(tmp_path / "c"), ["g"], None)
    assert spark.read.parquet(str(tmp_path / "c")).where("g between 5 and 6").count() == 101


def test_each_key_of_a_clustered_table_prunes(spark, tmp_path):
    """A filter on a tenth of either key meets under 40 % of the files, by their statistics."""
    path = str(tmp_path / "z")
    rows = spark.range(20_000).selectExpr("cast(pmod(hash(id), 1000) as int) as a", "cast(pmod(hash(id, 1), 1000) as string) as s", "id")
    rows = rows.unionAll(spark.sql("select null, null, -1"))
    stored.write_clustered(rows, path, ["a", "s"], files=64)
    assert spark.read.parquet(path).count() == 20_001
    for column, low, high in (("a", 300, 399), ("s", "300", "399")):
        met = every = 0
        for f in pathlib.Path(path).glob("*.parquet"):
            group = pq.ParquetFile(f).metadata.row_group(0)
            at = [group.column(i).path_in_schema for i in range(group.num_columns)].index(column)
            known = group.column(at).statistics
            every += 1
            met += not known.has_min_max or (known.min <= high and known.max >= low)
        assert every > 40 and met < 0.4 * every, (column, met, every)


def test_registry(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, at timestamp_ntz").write.parquet(path)
    table = SourceTable("Things", path, loaded_at="at", warn_after=(1, "day"), error_after=(2, "day"), columns=("ID",), data_owner="OWN")
    r = Registry(SourceGroup("g", source_system="SYS", data_owner="GROUP", data_class="SECRET", tables=(table, SourceTable("bad", path, columns=("no",)))))
    out = add_lineage(r.read(spark, "G", "things"), r, "g", "THINGS", dt.datetime(2024, 1, 5), "at").first()
    assert (out["_source_system"], out["_source_table"], out["_data_owner"], out["_data_classification"]) == ("SYS", "THINGS", "OWN", "SECRET")
    assert "_source_file" not in out.asDict() and out["_source_loaded_at"] == dt.datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        r.read(spark, "g", "bad")
    with pytest.raises(ValueError):
        Registry(SourceGroup("g", tables=(table, table)))
    for day, status in ((1, "pass"), (2, "warn"), (9, "error")):
        assert source_freshness(spark, r, dt.datetime(2024, 1, day, 1)).first()["status"] == status


def test_only_a_missing_path_means_no_table(spark, tmp_path):
    assert stored._stored(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception):
        stored._stored(spark, "nosuchscheme://x/t")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, rows, capsys):
    a = spark.range(2000).selectExpr("id % 500 as k", "id as v")
    b = spark.range(500).selectExpr("id as k", "id * 2 as w")
    plain = rows(a.join(b, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = stored.write_bucketed(a, "silt_test_a", str(tmp_path / "a"), ["k"], 8)
        stored.write_bucketed(b, "silt_test_b", str(tmp_path / "b"), ["k"], 8)
        spark.sql("drop table silt_test_b")  # a table outside the warehouse: its files stay
        right = stored.open_bucketed(spark, "silt_test_b", str(tmp_path / "b"), ["k"], 8)
        out = left.join(right, "k")
        out.explain()
        text = capsys.readouterr().out
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert rows(out) == plain
        with pytest.raises(ValueError, match="1 keys"):
            stored.write_bucketed(a.withColumn("k", F.expr("if(v % 2 = 0, 0L, v)")), "silt_test_c", str(tmp_path / "c"), ["k"], 64)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("silt_test_a", "silt_test_b"):
            spark.sql(f"drop table if exists {name}")
