"""Composed plans on small college tables."""

import datetime as dt
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from siltworks.bindings import ORACLE, QUERIES, models
from siltworks.bindings.base import Tables
from siltworks.config import RunConfig
from siltworks.functions.keys import surrogate_key
from siltworks.operators import joins
from siltworks.plans import events, identity, star_schema
from siltworks.plans.golden import golden_records, is_active, seeks_degree
from tests.agree import differences

CFG = RunConfig(run_time=dt.datetime(2024, 1, 1), as_of=dt.date(2024, 1, 1), institution_code="X")
NEW = "source_id string, email string, first_name string, last_name string, birth_date date, created_on timestamp_ntz, other_id string"
OLD = "source_id string, email string, first_name string, last_name string, birth_date date"
B = dt.date(2000, 1, 1)


def new(spark, *rows):
    return spark.createDataFrame([(i, m, f, "L", B, None, o) for i, m, f, o in rows], NEW)


def old(spark, *rows):
    return spark.createDataFrame([(i, m, f, "L", B) for i, m, f in rows], OLD)


@pytest.fixture(scope="module")
def first(spark):
    n = new(spark, ("10", " Ann@X.edu", "Ann", "900"), ("20", "bob@x.edu", "Bob", None), ("30", None, "Cy", None), ("40", "fam@x.edu", "D", None),
            ("41", "FAM@x.edu", "E", None))
    o = old(spark, ("1", "ann@x.edu ", "Ann"), ("1", "ann@x.edu ", "Ann"), ("20", "bob@x.edu", "Bob"), ("3", None, "Zed"), ("30", "other@x.edu", "Cy"),
            ("7", "fam@x.edu", "F"))
    return identity.resolve_identities(n, o, CFG).cache()


def test_identity_rows(first):
    got = {(r["source_system"], r["source_id"], r["match_method"], str(r["match_confidence"]), r["is_primary_source"]) for r in first.collect()}
    assert got == {
        ("WORKDAY", "10", "SYSTEM_OF_RECORD", "1.00", True), ("WORKDAY", "20", "SYSTEM_OF_RECORD", "1.00", True),
        ("WORKDAY", "30", "SYSTEM_OF_RECORD", "1.00", True), ("WORKDAY", "40", "SYSTEM_OF_RECORD", "1.00", True),
        ("WORKDAY", "41", "SYSTEM_OF_RECORD", "1.00", True), ("SLATE", "900", "WORKDAY_OTHER_IDS_PARSE", "0.95", False),
        ("JENZABAR_CX", "1", "EMAIL_MATCH", "0.95", False), ("JENZABAR_CX", "20", "WORKDAY_REFERENCE_ID_MATCH", "0.98", False),
        ("JENZABAR_CX", "30", "WORKDAY_REFERENCE_ID_MATCH", "0.98", False),
        ("JENZABAR_CX", "3", "SYSTEM_OF_RECORD", "1.00", True), ("JENZABAR_CX", "7", "EMAIL_MATCH", "0.95", False)}
    assert first.groupBy(*identity.IDENTITY_KEY).count().where("count > 1").count() == 0
    assert first.select("scd_id").distinct().count() == first.count()
    master = {(r["source_system"], r["source_id"], r["match_method"]): r["master_id"] for r in first.collect()}
    assert master["JENZABAR_CX", "7", "EMAIL_MATCH"] == master["WORKDAY", "40", "SYSTEM_OF_RECORD"]
    assert master["JENZABAR_CX", "1", "EMAIL_MATCH"] == master["WORKDAY", "10", "SYSTEM_OF_RECORD"]


def test_shared_email_may_link_to_each_owner(spark):
    n = new(spark, ("40", "fam@x.edu", "D", None), ("41", "fam@x.edu", "E", None))
    o = old(spark, ("7", "fam@x.edu", "F"))
    both = identity.resolve_identities(n, o, CFG, shared_email="all")
    assert both.where("source_system = 'JENZABAR_CX'").select("master_id").distinct().count() == 2


def test_second_run_keeps_ids_and_closes_changed_rows(spark, first):
    later = RunConfig(run_time=dt.datetime(2024, 2, 1), as_of=dt.date(2024, 2, 1), institution_code="X")
    n = new(spark, ("05", "new@x.edu", "New", None), ("10", " Ann@X.edu", "Anna", "900"), ("20", "bob@x.edu", "Bob", None), ("30", None, "Cy", None),
            ("40", "fam@x.edu", "D", None), ("41", "FAM@x.edu", "E", None))
    o = old(spark, ("1", "ann@x.edu ", "Ann"), ("20", "bob@x.edu", "Bob"), ("3", None, "Zed"), ("30", "other@x.edu", "Cy"), ("7", "fam@x.edu", "F"))
    second = identity.resolve_identities(n, o, later, previous=first).cache()
    before = {(r["source_system"], r["source_id"], r["match_method"]): r["master_id"] for r in first.collect()}
    for r in second.collect():
        key = (r["source_system"], r["source_id"], r["match_method"])
        assert r["master_id"] == before.get(key, r["master_id"])
    added = second.where("source_id = '05'").first()
    assert added["master_id"] > max(before.values()) and added["is_current"]
    ann = second.where("source_system = 'WORKDAY' and source_id = '10'").orderBy("effective_date").collect()
    assert [(r["tracked_first_name"], r["is_current"], r["end_date"]) for r in ann] == [
        ("Ann", False, later.run_time), ("Anna", True, None)]
    assert ann[0]["scd_id"] != ann[1]["scd_id"]
    third = identity.resolve_identities(n, o, later, previous=second)
    assert third.count() == second.count()


def test_a_migrated_person_keeps_the_master_id(spark, first):
    later = RunConfig(run_time=dt.datetime(2024, 2, 1), as_of=dt.date(2024, 2, 1), institution_code="X")
    n = new(spark, ("3", "zed@x.edu", "Zed", None), ("10", "ann@x.edu", "Ann", "900"), ("11", "ann2@x.edu", "Other", "900"))
    o = old(spark, ("1", "ann@x.edu ", "Ann"), ("3", None, "Zed"), ("8", "zed@x.edu", "Z"))
    second = identity.resolve_identities(n, o, later, previous=first).cache()
    was = first.where("source_system = 'JENZABAR_CX' and source_id = '3'").first()["master_id"]
    now = {(r["source_system"], r["source_id"]): r for r in second.where("is_current").collect()}
    assert now["WORKDAY", "3"]["master_id"] == now["JENZABAR_CX", "3"]["master_id"] == now["JENZABAR_CX", "8"]["master_id"] == was
    assert not now["JENZABAR_CX", "3"]["is_primary_source"] and now["WORKDAY", "3"]["is_primary_source"]
    closed = second.where("source_system = 'JENZABAR_CX' and source_id = '3' and not is_current").collect()
    assert [(r["is_primary_source"], r["end_date"]) for r in closed] == [(True, later.run_time)]
    assert identity.source_rows_per_master(second).first()["under_several_masters"] == 0
    assert identity.resolve_identities(n, o, later, previous=second).count() == second.count()


def test_a_row_that_moves_to_another_person_is_closed_there(spark):
    later = RunConfig(run_time=dt.datetime(2024, 2, 1), as_of=dt.date(2024, 2, 1), institution_code="X")
    n = new(spark, ("1", "a@x.edu", "A", None), ("2", "b@x.edu", "B", None))
    before = identity.resolve_identities(n, old(spark, ("7", "a@x.edu", "S")), CFG)
    after = identity.resolve_identities(n, old(spark, ("7", "b@x.edu", "S")), later, previous=before)
    got = [(r["master_id"][-1], r["is_current"]) for r in after.where("source_id = '7'").orderBy("master_id").collect()]
    assert got == [("1", False), ("2", True)]


def test_names_link_where_asked_for(spark):
    n, o = new(spark, ("1", "a@x.edu", "Ann", None)), old(spark, ("7", "b@x.edu", " ann "), ("8", None, None))
    links = identity.match_links(n, o, ("id", "email", "name"))
    assert [(r["legacy_id"], r["new_id"], r["rule"]) for r in links.collect()] == [("7", "1", "name")]
    assert identity.match_links(n, o).count() == 0


def test_golden_record_prefers_the_new_system(spark, first):
    n = spark.createDataFrame([("10", "Ann", "N", "ann@x.edu", dt.date(2000, 5, 5), True), ("30", "Cy", "N", None, None, None)],
                              "source_id string, first_name string, last_name string, email string, birth_date date, is_graduated boolean")
    o = spark.createDataFrame([("1", "Old", "O", "old@x.edu", dt.date(1990, 1, 1)), ("3", None, "Z", None, None)],
                              "source_id string, first_name string, last_name string, email string, birth_date date")
    got = {(r["new_id"], r["legacy_id"]): r for r in golden_records(first, n, o, CFG.as_of).collect()}
    ann = got["10", "1"]
    assert (ann["full_name"], ann["calculated_age"], ann["is_independent_student"], ann["data_quality_flag"]) == ("Ann N", 24, True, "COMPLETE")
    assert ann["in_both_systems"] and ann["is_graduated"] and ann["_source_system"] == "INTEGRATED"
    assert got[None, "3"]["data_quality_flag"] == "MISSING_NAME" and got[None, "3"]["legacy_only"]


def test_legacy_status_rules(spark):
    df = spark.createDataFrame([("A", "BA", True), ("W", "BA", None), (None, None, True)], "s string, d string, g boolean")
    got = df.select(is_active(F.col("s")), seeks_degree(F.col("d"), F.col("g"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (False, False)]


def test_email_choice(spark, rows):
    def d(*a):
        return dt.date(*a) if a else None

    df = spark.createDataFrame([
        (1, 1, "E", d(2020, 1, 1), d(), "Open@x.edu "), (2, 1, "E", d(2023, 1, 1), d(2025, 1, 1), "future@x.edu"),
        (3, 2, "E", d(2020, 1, 1), d(2023, 1, 1), "past@x.edu"), (4, 3, "E", d(2020, 1, 1), d(), "nomail"), (5, 3, "E", d(2019, 1, 1), d(), "a b@x.edu"),
        (6, 4, "E", d(2020, 1, 1), d(), "one@x.edu"), (7, 4, "E", d(), d(), "nobegin@x.edu"), (8, 5, "H", d(2020, 1, 1), d(), "type@x.edu"),
        (9, 6, "E", d(2020, 1, 1), d(2024, 1, 1), "today@x.edu")],
        "address_number int, person_id int, address_type_code string, begin_date date, end_date date, address_line_1 string")
    # a trailing blank is a blank, so the first text is no email
    kinds = spark.createDataFrame([("E", "Y"), ("H", "N")], "aa string, email string")
    got = events.pick_emails(df, kinds, dt.date(2024, 1, 1)).select("person_id", "email_address")
    assert rows(got) == [(1, "future@x.edu"), (4, "nobegin@x.edu"), (6, "today@x.edu")]


def test_events_with_ties_and_bad_times(spark):
    df = spark.createDataFrame([("a", "R", "2024-01-01", "930"), ("a", "W", "2024-01-02", "0930"), ("b", "R", "2024-01-01", "930"),
                                ("b", "D", "2024-01-01", "0930"), ("c", "R", "2024-01-01", "2530"), ("d", "R", "2024-01-01", "100")],
                               "cw_no string, stat string, sys_date string, tm string").withColumn("beg_date", F.col("sys_date").cast("date"))
    work = spark.createDataFrame([("a", "F"), ("b", "F"), ("c", "F"), ("d", "F"), ("e", "F")], "cw_no string, stat string")
    got = {r["cw_no"]: r for r in events.enrich_course_work(work, df).collect()}
    assert (got["a"]["first_event_type"], got["a"]["latest_event_type_final"]) == ("R", "W")
    assert got["b"]["is_event_timestamp_ambiguous"] and got["b"]["latest_event_type_final"] == "F"
    assert got["c"]["first_event_timestamp"] is None and got["e"]["first_event_type"] is None
    assert got["d"]["latest_event_timestamp"] == dt.datetime(2024, 1, 1, 1, 0)
    assert events.bad_event_times(df).count() == 1


def test_events_are_dealt_once_unless_a_key_is_hot(spark, rows, capsys):
    """One shuffle for both aggregations where no key is hot, two of combined rows else; the result is the same."""
    made = ["date'2024-01-01' + cast(id % 7 as int) as d", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, cast(id % 5 as int)) as t", "concat('s', id % 3) as stat"]
    even = spark.range(4000).selectExpr("concat('k', id % 1300) as k", *made)
    hot = even.unionAll(spark.range(4000).selectExpr("'k7' as k", *made)).unionAll(spark.range(20).selectExpr("cast(null as string) as k", *made))
    for df, shuffles in ((even, 1), (hot, 2)):
        out = events.first_last_events(df, "k", "stat", "d", "t", ["stat"])
        capsys.readouterr()
        out.explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == shuffles
        want = spark.sql("""select k, min(e).stat, min(e).t, max(e).stat, max(e).t, count(*) > count(distinct e.d, e.t)
            from (select k, struct(d, t, stat) as e from {df}) group by k""", df=df)
        assert rows(out) == rows(want)


def test_fact_finds_events_of_its_rows_only(spark, rows, capsys):
    """Course work with its events, or with registrations that are looked up after students and sections: the same fact."""
    day = dt.date(2024, 1, 1)
    work = spark.createDataFrame([(f"w{i}", f"p{i % 4}", 2024, "Q1", "S 1", "UNDG", f"C{i % 3}", "cat", 1, "A", "F", 10, "B", day, day) for i in range(12)] + [
        (None, "p1", 2024, "Q1", "S 1", "UNDG", "C1", "cat", 1, "A", "F", 10, "B", day, day)],
        "cw_no string, id string, yr int, sess string, subsess string, prog string, crs_no string, cat string, sec int, grd string, grdg string, hrs int, stat string, "
        "beg_date date, end_date date")
    regs = spark.createDataFrame([(f"w{i % 9}", "RWD"[i % 3], day, day, f"{9 + i % 2}30") for i in range(25)] + [(None, "R", day, day, "930")],
                                 "cw_no string, stat string, beg_date date, sys_date date, tm string")
    key = [surrogate_key(F.col(c)) for c in ("x", "y")]
    students = spark.createDataFrame([("p0", "UNDG"), ("p1", "UNDG"), ("p1", "UNDG"), ("p2", "GRAD")], "x string, y string").select(
        F.col("x").alias("student_code"), F.col("y").alias("student_program_level"), key[0].alias("student_key"))
    sections = spark.createDataFrame([("C0", 1), ("C1", 1), ("C2", 2)], "x string, y int").selectExpr(
        "x as course_section_course_number", "y as course_section_section_number", "'cat' as course_section_catalog", "'UNDG' as course_section_program_level",
        "'S 1' as course_section_subsess", "'Q1' as course_section_sess", "2024 as course_section_year", "md5(x) as course_section_key",
        "if(x = 'C1', null, md5('f')) as course_section_faculty_key")
    terms = spark.createDataFrame([("Q1", 2024, "UNDG", "S 1", "t")], "term_sess string, term_year int, term_program_level string, term_subsess string, term_key string")
    grades = spark.createDataFrame([("A", "F", "g")], "grade_code string, grade_category string, grade_key string")
    dates = spark.createDataFrame([(day, 20240101)], "date_actual date, date_key int")
    tables = (students, sections, terms, grades, dates, CFG.run_time)
    late = star_schema.enrollment_fact(work, *tables, registrations=regs, tie=["stat"])
    assert rows(late) == rows(star_schema.enrollment_fact(events.enrich_course_work(work, regs, ["stat"]), *tables))
    got = {r["enrollment_source_serial"]: r for r in late.collect()}
    assert late.count() == 8 and set(got) == {"w0", "w1", "w4", "w9", None}
    assert got["w1"]["enrollment_course_section_key"] == hashlib.md5(b"C1").hexdigest() and got["w1"]["enrollment_faculty_key"] is None
    assert got["w0"]["enrollment_stu_key"] == hashlib.md5(b"p0").hexdigest() and got["w9"]["enrollment_first_stat"] is None


def college(spark, folder, lines: str):
    """Small given tables: lines and orders and parts that come twice, keys that are null."""
    day = "timestamp_ntz'1998-01-15' + make_dt_interval(cast({} as int))"
    tables = {
        "region": "select cast(id as int) as r_regionkey, concat('R', id) as r_name from range(3)",
        "nation": "select cast(id as int) as n_nationkey, concat('N', id) as n_name, cast(id % 3 as int) as n_regionkey from range(10)",
        "customer": "select id as c_custkey, concat('c', id) as c_name, cast(id % 10 as int) as c_nationkey, 1000.0D * id as c_acctbal, 'M' as c_mktsegment from range(9)",
        "supplier": "select id as s_suppkey, concat('s', id) as s_name, cast(id * 4 as int) as s_nationkey, 1.0D as s_acctbal from range(6)",
        "part": """select id % 13 as p_partkey, concat('p', id) as p_name, concat('B', id % 3) as p_brand, element_at(array('SMALL', 'LARGE', 'PROMO'), cast(1 + id % 3 as int)) as p_type,
            cast(id * 3 as int) as p_size, 1.0D as p_retailprice from range(15) union all select null, 'n', 'B1', 'SMALL', 1, 1.0D""",
        "orders": f"""select if(id = 40, 39, id) as o_orderkey, id % 9 as o_custkey, element_at(array('O', 'F', 'P'), cast(1 + id % 3 as int)) as o_orderstatus, 1.0D * id as o_totalprice,
            {day.format("id * 9")} as o_orderdate, concat(id % 5, '-X') as o_orderpriority from range(41) union all select null, 1, 'O', 1.0D, timestamp_ntz'1998-01-15', '1-X'""",
        "lineitem": f"""select l_orderkey, l_partkey, id % 6 as l_suppkey, cast(1 + id % 4 as int) as l_linenumber, 1.0D * (id % 50) as l_quantity, 1.0D as l_extendedprice, 0.0D as l_discount,
            (id % 9) / 100.0D as l_tax, substr('RAN', cast(1 + id % 3 as int), 1) as l_returnflag, 'F' as l_linestatus, {day.format("id % 300")} as l_shipdate from ({lines})"""}
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    con = duckdb.connect()
    for name in tables:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("hot", [False, True])
def test_courses_are_dealt_once_unless_one_is_hot(spark, tmp_path, capsys, hot):
    """The fact against its SQL; sections, courses and course work meet where lines were dealt by course, without another shuffle."""
    even = "select id, if(id = 7, null, id % 41) as l_orderkey, if(id = 8, null, id * 7 % 13) as l_partkey from range(500)"
    con = college(spark, tmp_path, even if not hot else f"{even} union all select id, id % 41, 5 from range(300)")
    name, own = "model_fact_enrollment", "spark.sql.requireAllClusterKeysForCoPartition"
    was, limit = spark.conf.get(own), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for most in ("-1", limit):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            out = QUERIES[name](spark, str(tmp_path))
            capsys.readouterr()
            out.explain()
            dealt = re.findall(r"Exchange hashpartitioning\((.*), 8\), (\w+)", capsys.readouterr().out)
            wide = [by for by, _ in dealt if by.startswith(("crs_no", "course_section_course_number", "course_number")) and "," in by]
            assert bool(wide) == hot and sum("concat(C" in by and why == "REPARTITION_BY_NUM" for by, why in dealt) == (0 if hot else 2)
            assert differences(spark, con, name, QUERIES[name], ORACLE[name], str(tmp_path)) == []
            assert spark.conf.get(own) == was and (out.sparkSession.conf.get(own) == was) == hot
            assert out.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == most
        for table in ("cw_rec", "sec_rec"):
            t = Tables(spark, str(tmp_path))
            plain, by_course = models.raw(t, table), models.raw(t, table, True)
            assert plain.columns == by_course.columns and plain.count() > 100
            assert plain.exceptAll(by_course).count() == by_course.exceptAll(plain).count() == 0
            capsys.readouterr()
            by_course.explain()
            assert "isnotnull(l_partkey" in capsys.readouterr().out.partition("REPARTITION_BY_NUM")[2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_tables_counted_as_small_are_copied(spark, capsys):
    df, limit = spark.range(100).selectExpr("id as k", "if(id = 3, null, 'x') as v"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, copied in ((1 << 20, True), (100, False)):
            spark.range(100).join(joins.copied_if_small(df, most).select("k"), F.col("id") == F.col("k")).explain()
            assert ("BroadcastHashJoin" in capsys.readouterr().out) == copied
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert joins.copied_if_small(df.limit(0)).count() == 0


def test_terms_of_days(spark):
    def term(level, beg, end):
        return ("Q1", "S 1", 2024, level, "2024A", beg and dt.date(2024, *beg), end and dt.date(2024, *end))

    raw = spark.createDataFrame([term("GRAD", (1, 1), (1, 10)), term("UNDG", (1, 1), (1, 10)), term("GRAD", (1, 5), (1, 20)), term("PREP", (2, 1), None)],
                                "sess string, subsess string, yr int, prog string, acyr string, beg_date date, end_date date")
    terms = star_schema.term_dimension(raw, CFG.as_of, CFG.run_time)
    assert {r["term_code"] for r in terms.collect()} == {"Q1S-12024GRAD", "Q1S-12024UNDG", "Q1S-12024PREP"}
    days = spark.sql("select explode(sequence(date'2023-12-31', date'2024-02-02')) as dt")
    for rule, sixth in (("priority", "UNDG"), ("name", "GRAD")):
        got = {r["date_actual"]: r for r in star_schema.date_dimension_with_terms(days, terms, CFG.as_of, rule).collect()}
        assert len(got) == 34
        levels = [got[dt.date(2024, 1, x)]["primary_term_program_level"] for x in (1, 6, 15, 25)]
        assert levels == ["UNDG", sixth, "GRAD", None]
    day = got[dt.date(2024, 1, 6)]
    assert day["is_weekend"] and day["date_key"] == 20240106 and not got[dt.date(2024, 1, 8)]["is_weekend"]


def test_null_title_line_gives_null_title(spark):
    df = spark.createDataFrame([("C1", "cat", "a", None, "c", "d", "p", None)], "course_number string, catalog_code string, title_line_1 string, "
                               "title_line_2 string, title_line_3 string, department_code string, program_code string, status_date date")
    assert star_schema.course_dimension(df, CFG.run_time).first()["course_title"] is None
