"""Dimensions and the enrollment fact.

Text keys are hashes of the natural key, so a fact can be keyed without reading
stored ids.  Dimension joins carry no broadcast hint: Spark broadcasts those it
has found small.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import dates as d
from siltworks.functions.flags import is_open
from siltworks.functions.keys import surrogate_key
from siltworks.operators.joins import join_days_in_ranges
from siltworks.operators.windows import first_per_key
from siltworks.plans.events import enrich_course_work

# Order in which program levels claim a date range.
LEVEL_ORDER = ("UNDG", "GRAD")

# Columns of the lookup tables (code, description, further ones).
LOOKUPS = {
    "major": ("major", {"major": "major_code", "txt": "major_descr"}),
    "degree": ("deg", {"deg": "degree_code", "txt": "degree_descr"}),
    "dept": ("dept", {"dept": "dept_code", "txt": "dept_descr"}),
    "ethnicity": ("ethnic", {"ethnic": "ethnicity_code", "txt": "ethnicity_descr"}),
    "grade": ("grd", {"grd": "grade_code", "txt": "grade_descr", "ctgry": "grade_category", "pts": "grade_pts"}),
}


def _track(begin: Column, end: Column, active: Column, run_time) -> list[Column]:
    stamp = F.lit(run_time).cast("timestamp_ntz")
    return [begin.cast("date").alias("source_active_date"), end.cast("date").alias("source_inactive_date"),
            active.alias("is_active"), F.lit(True).alias("is_current"),
            stamp.alias("creation_timestamp"), stamp.alias("last_modified_timestamp")]


def lookup_dimension(df: DataFrame, kind: str, run_time: dt.datetime) -> DataFrame:
    """major, degree, dept, ethnicity or grade: active while there is no end date."""
    code, names = LOOKUPS[kind]
    end = F.col("inactive_date")
    return df.select(surrogate_key(F.col(code)).alias(f"{kind}_key"),
                     *[F.col(a).alias(b) for a, b in names.items()],
                     *_track(F.col("active_date"), end, end.isNull(), run_time))


def term_dimension(calendar: DataFrame, as_of, run_time: dt.datetime) -> DataFrame:
    """Terms keyed by session, subsession, year and program; null parts make the code null."""
    sess, sub = F.trim("sess"), F.trim(F.replace(F.col("subsess"), F.lit(" "), F.lit("-")))
    yr, prog = F.col("yr").cast("string"), F.trim("prog")
    label = [F.lit("Session: "), sess, F.lit(" Year: "), yr, F.lit(" Subsession: "), sub, F.lit(" Program: "), prog]
    end = F.col("end_date")
    return calendar.select(
        surrogate_key(sess, sub, yr, prog).alias("term_key"),
        F.concat(sess, sub, yr, prog).alias("term_code"), F.concat(*label).alias("term_descr"),
        F.col("acyr").alias("term_acad_yr"), F.col("sess").alias("term_sess"), F.col("yr").alias("term_year"),
        F.col("subsess").alias("term_subsess"), F.col("prog").alias("term_program_level"),
        F.col("acyr").alias("term_award_yr"), F.col("acyr").alias("term_fiscal_yr"),
        F.col("beg_date").cast("date").alias("term_beg_date"), end.cast("date").alias("term_end_date"),
        *_track(F.col("beg_date"), end, is_open(end, as_of), run_time))


def _level(order) -> Column:
    rank = F.lit(len(order))
    for i, level in reversed(list(enumerate(order))):
        rank = F.when(F.col("term_program_level") == level, i).otherwise(rank)
    return rank


def date_dimension_with_terms(days: DataFrame, terms: DataFrame, as_of, day_rule: str = "priority") -> DataFrame:
    """One row per day with its calendar parts and one primary term.

    A range held by several terms goes to the first program level; so does a day
    in several ranges.  With ``day_rule='name'`` the second pick sorts levels by
    their names instead.
    """
    dated = terms.where("term_beg_date is not null and term_end_date is not null")
    ranges = first_per_key(dated, ["term_beg_date", "term_end_date"], [_level(LEVEL_ORDER), F.col("term_key")])
    cols = ["term_key", "term_code", "term_descr", "term_acad_yr", "term_sess", "term_year", "term_subsess",
            "term_program_level"]
    joined = join_days_in_ranges(days.select("dt"), "dt", ranges.select(*cols, "term_beg_date", "term_end_date"),
                                 "term_beg_date", "term_end_date")
    level = {"priority": _level(LEVEL_ORDER), "name": F.col("term_program_level").asc_nulls_last()}[day_rule]
    picked = first_per_key(joined, ["dt"], [
        level, F.col("term_beg_date").desc_nulls_first(), F.col("term_end_date").asc_nulls_last(), F.col("term_key")])
    x = F.col("dt")
    return picked.select(
        F.date_format(x, "yyyyMMdd").cast("int").alias("date_key"), x.alias("date_actual"),
        d.day_of_week(x, iso=False).alias("day_of_week_num"), d.day_name(x).alias("day_of_week_name"),
        F.left(d.day_name(x), F.lit(3)).alias("day_of_week_abbr"), F.dayofmonth(x).alias("day_of_month"),
        F.dayofyear(x).alias("day_of_year"), F.weekofyear(x).alias("week_of_year"), F.month(x).alias("month_num"),
        d.month_name(x).alias("month_name"), F.left(d.month_name(x), F.lit(3)).alias("month_abbr"),
        F.quarter(x).alias("quarter_num"), F.concat(F.lit("Q"), F.quarter(x).cast("string")).alias("quarter_name"),
        F.year(x).alias("year_num"), F.dayofweek(x).isin(1, 7).alias("is_weekend"),
        (x == F.lit(as_of).cast("date")).alias("is_current_date"), d.academic_year(x).alias("academic_year"),
        F.col("term_key").isNotNull().alias("is_in_term"), *[F.col(c).alias(f"primary_{c}") for c in cols],
        d.fiscal_year(x).alias("fiscal_year_num"), d.fiscal_quarter(x).alias("fiscal_quarter_num"),
        d.fiscal_month(x).alias("fiscal_month_num"), d.fiscal_period(x).alias("fiscal_period_name"))


def _title() -> Column:
    """Three title lines; a null line makes the title null."""
    return F.concat(F.col("title_line_1"), F.lit(" "), F.col("title_line_2"), F.lit(" "), F.col("title_line_3"))


def course_dimension(courses: DataFrame, run_time: dt.datetime, key=("course_number",)) -> DataFrame:
    """Courses; ``key`` may add the catalog to reach the grain of the rows."""
    return courses.select(
        surrogate_key(*[F.col(k) for k in key]).alias("course_key"), F.col("course_number").alias("course_code"),
        _title().alias("course_title"), F.col("catalog_code").alias("course_catalog"),
        F.col("program_code").alias("course_program_level"), F.col("department_code").alias("course_dept"),
        *_track(F.col("status_date"), F.lit(None), F.lit(True), run_time))


def faculty_dimension(faculty: DataFrame, people: DataFrame, departments: DataFrame, run_time: dt.datetime) -> DataFrame:
    j = faculty.join(people, F.col("faculty_id") == F.col("person_id"))
    j = j.join(departments.select("dept_code"), F.col("primary_department_code") == F.col("dept_code"))
    return j.select(
        surrogate_key(F.col("faculty_id")).alias("faculty_key"), F.col("faculty_id").alias("faculty_code"),
        F.col("last_name").alias("faculty_lastname"), F.col("first_name").alias("faculty_firstname"),
        F.col("middle_name").alias("faculty_middlename"), F.col("title").alias("faculty_prefix"),
        F.col("suffix").alias("faculty_suffix"), F.col("title_code").alias("faculty_rank"),
        F.col("dept_code").alias("faculty_dept"), *_track(F.col("status_date"), F.lit(None), F.lit(True), run_time))


def section_dimension(courses: DataFrame, sections: DataFrame, faculty: DataFrame, departments: DataFrame,
                      as_of, run_time: dt.datetime) -> DataFrame:
    """Sections with course, faculty and department; rows lacking one of them drop out."""
    course = courses.select("course_number", "catalog_code", _title().alias("course_title"),
                            "program_code", "department_code")
    j = sections.join(course, ["course_number", "catalog_code"])
    j = j.join(faculty.select("faculty_code", "faculty_key"), F.col("primary_faculty_id") == F.col("faculty_code"))
    j = j.join(departments.select("dept_code"), F.col("department_code") == F.col("dept_code"))
    end = F.col("end_date")
    return j.select(
        surrogate_key(*[F.col(c) for c in ("course_number", "section_number", "academic_year", "term_code")])
        .alias("course_section_key"),
        F.col("course_number").alias("course_section_course_number"),
        F.col("section_number").alias("course_section_section_number"), "course_title", "section_title",
        F.col("catalog_code").alias("course_section_catalog"), F.col("dept_code").alias("course_section_dept"),
        F.col("term_code").alias("course_section_sess"), F.col("academic_year").alias("course_section_year"),
        F.col("subsession_code").alias("course_section_subsess"),
        F.col("program_code").alias("course_section_program_level"),
        F.col("current_registered_count").alias("course_section_reg_number"),
        F.col("status_code").alias("course_section_status"), F.col("faculty_key").alias("course_section_faculty_key"),
        *_track(F.col("begin_date"), end, is_open(end, as_of), run_time))


def student_dimension(profiles: DataFrame, people: DataFrame, programs: DataFrame, majors: DataFrame,
                      ethnicities: DataFrame, standings: DataFrame, run_time: dt.datetime,
                      key=("person_id", "program_code")) -> DataFrame:
    """Students per program; the key covers person and program, the grain of the rows."""
    j = profiles.join(people, "person_id")
    j = j.join(programs.withColumnRenamed("student_id", "person_id"), "person_id")
    j = j.join(majors.select("major_code"), F.col("major_1_code") == F.col("major_code"))
    j = j.join(ethnicities.select("ethnicity_code"), "ethnicity_code")
    j = j.join(standings.select("acst", F.col("txt").alias("standing")), F.col("academic_standing_code") == F.col("acst"))
    return j.select(
        surrogate_key(*[F.col(k) for k in key]).alias("student_key"), F.col("person_id").alias("student_code"),
        F.col("last_name").alias("student_lastname"), F.col("first_name").alias("student_firstname"),
        F.col("middle_name").alias("student_middlename"), F.col("title").alias("student_prefix"),
        F.col("suffix").alias("student_suffix"), F.col("major_code").alias("student_major"),
        F.col("birth_date").alias("student_dob"), F.col("gender_code").alias("student_gender"),
        F.col("residence_country").alias("student_country"), F.col("ethnicity_code").alias("student_ethnicity"),
        F.col("degree_grant_date").alias("student_grad_date"), F.col("standing").alias("student_acad_stat"),
        F.col("program_code").alias("student_program_level"),
        *_track(F.col("record_added_date"), F.lit(None), F.lit(True), run_time))


def gender_dimension(seed: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Active genders of the seed."""
    return seed.where("is_active").select(
        surrogate_key(F.col("gender_code")).alias("gender_key"), "gender_code", "gender_name", "gender_category",
        "is_active", "sort_order", F.lit(run_time).cast("timestamp_ntz").alias("_loaded_at"),
        F.lit("SEED").alias("_source_system"), F.lit("PUBLIC").alias("_data_classification"),
        F.lit("COMMON").alias("_data_owner"))


def _packed(key: str) -> Column:
    """A surrogate key, 32 hex digits, as its 16 bytes: what a fact carries from one shuffle to the next."""
    return F.unhex(key).alias(key)


def _unpacked(key: str) -> Column:
    return F.lower(F.hex(key))


def enrollment_fact(course_work: DataFrame, students: DataFrame, sections: DataFrame, terms: DataFrame,
                    grades: DataFrame, dates: DataFrame, run_time: dt.datetime, section_by_term: bool = True,
                    grade_category: str = "grdg", registrations: DataFrame | None = None, tie: list[str] = ()) -> DataFrame:
    """Enrollments keyed to student, section, term, grade and two dates.

    Student and section must be there, the others may be missing.  Sections are
    matched on year and session too unless ``section_by_term`` is off.  Course work comes with its
    first and last event, or ``registrations`` have them (``enrich_course_work``): then only rows that
    have a student and a section look for their events.
    """
    s = students.select(F.col("student_code").alias("id"), F.col("student_program_level").alias("prog"), _packed("student_key"))
    on = {"course_section_course_number": "crs_no", "course_section_section_number": "sec",
          "course_section_catalog": "cat", "course_section_program_level": "prog", "course_section_subsess": "subsess"}
    if section_by_term:
        on |= {"course_section_sess": "sess", "course_section_year": "yr"}
    c = sections.select(*[F.col(a).alias(b) for a, b in on.items()], _packed("course_section_key"), _packed("course_section_faculty_key"))
    t = terms.select(F.col("term_sess").alias("sess"), F.col("term_year").alias("yr"),
                     F.col("term_program_level").alias("prog"), F.col("term_subsess").alias("subsess"), "term_key")
    g = grades.select(F.col("grade_code").alias("grd"), F.col("grade_category").alias(grade_category), "grade_key")

    def day(name):
        return dates.select(F.col("date_actual").alias(f"__{name}"), F.col("date_key").alias(name))

    w = course_work.join(c, list(on.values())).join(s, ["id", "prog"])
    if registrations is not None:
        w = enrich_course_work(w, registrations, tie)
    w = w.withColumn("__first_day", F.col("first_event_timestamp").cast("date"))
    w = w.withColumn("__latest_day", F.col("latest_event_timestamp").cast("date"))
    j = w.join(t, ["sess", "yr", "prog", "subsess"], "left").join(g, ["grd", grade_category], "left")
    j = j.join(day("first_day"), "__first_day", "left").join(day("latest_day"), "__latest_day", "left")
    return j.select(
        F.col("cw_no").alias("enrollment_source_serial"), _unpacked("student_key").alias("enrollment_stu_key"),
        _unpacked("course_section_key").alias("enrollment_course_section_key"),
        F.col("term_key").alias("enrollment_term_key"),
        _unpacked("course_section_faculty_key").alias("enrollment_faculty_key"),
        F.col("grade_key").alias("enrollment_grade_key"), F.col("hrs").alias("enrollment_hours"),
        F.col("stat").alias("enrollment_status"), F.col("prog").alias("enrollment_program_level"),
        F.col("first_event_type").alias("enrollment_first_stat"), F.col("first_day").alias("enrollment_first_date_key"),
        F.col("latest_event_type_final").alias("enrollment_latest_stat"),
        F.col("latest_day").alias("enrollment_latest_date_key"),
        F.col("beg_date").cast("date").alias("source_active_date"),
        F.col("end_date").cast("date").alias("source_inactive_date"), F.lit("Y").alias("is_current"),
        F.lit(run_time).cast("timestamp_ntz").alias("creation_timestamp"))
