"""Current contact per person and first / last event per record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions import dates, flags, text
from siltworks.operators.joins import hot_keys
from siltworks.operators.windows import first_per_key


def pick_emails(addresses: DataFrame, address_types: DataFrame, as_of) -> DataFrame:
    """One email per person: open-ended before ending ones, then the newest begin date.

    ``addresses`` is staged; ``address_types`` (aa, email) marks email kinds with Y.
    """
    kinds = address_types.where(F.col("email") == "Y").select(F.col("aa").alias("address_type_code"))
    raw = F.col("address_line_1")
    rows = addresses.where(text.is_email(raw) & flags.is_open(F.col("end_date"), as_of))
    rows = rows.join(kinds, "address_type_code").withColumn("email_address", F.lower(F.trim(raw)))
    best = first_per_key(rows, ["person_id"], [
        F.col("end_date").isNotNull(), F.col("begin_date").desc_nulls_first(), F.col("address_number").desc()])
    return best.select("person_id", "email_address", "address_type_code", "begin_date", "end_date")


def first_last_events(events: DataFrame, key: str, kind: str, day: str, moment: str, tie: list[str] = ()) -> DataFrame:
    """First and last event per key, ordered by day, moment, tie columns and kind (nulls last).

    Two partial aggregations instead of three windows, so a key with very many events
    never meets in one task.  Where a sketch finds no such key (one job), events are dealt by
    key once, as few columns, for both and for a join by key.  Events of a key that share day
    and moment make its times ambiguous.
    """
    tie = [c for c in tie if c != kind]
    events = events.select(*dict.fromkeys([key, kind, day, moment, *tie]))
    if not hot_keys(events, [key], int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))):
        events = events.repartition(key)

    def place(column):
        """Missing values sort after present ones."""
        return [F.col(column).isNull().alias(f"no_{column}"), F.col(column).alias(column)]

    def at(pick):
        return F.struct(*place(day), *place(moment), F.col(pick).alias("pick"))

    pick = F.struct(*[F.col(c).alias(f"tie_{c}") for c in tie], F.col(kind).alias("kind"))
    times = events.groupBy(key, day, moment).agg(
        F.count("*").alias("__n"), F.min(pick).alias("__low"), F.max(pick).alias("__high"))
    out = times.groupBy(key).agg(F.min(at("__low")).alias("first"), F.max(at("__high")).alias("last"),
                                 (F.max("__n") > 1).alias("is_event_timestamp_ambiguous"))
    return out.select(
        key, F.col("first.pick.kind").alias("first_event_type"), F.col(f"first.{moment}").alias("first_event_timestamp"),
        F.col("last.pick.kind").alias("latest_event_type_from_reg"),
        F.col(f"last.{moment}").alias("latest_event_timestamp"), "is_event_timestamp_ambiguous")


def enrich_course_work(course_work: DataFrame, registrations: DataFrame, tie: list[str] = ()) -> DataFrame:
    """Course work with its first and last registration event.

    Registrations are raw (cw_no, stat, beg_date, sys_date, tm).  Where times are
    ambiguous the record's own status is the last event.
    """
    events = registrations.where("cw_no is not null").withColumn("event_timestamp", dates.event_timestamp(F.col("sys_date"), F.col("tm")))
    found = first_last_events(events, "cw_no", "stat", "beg_date", "event_timestamp", tie)
    final = F.when(F.col("is_event_timestamp_ambiguous"), F.col("stat")).otherwise(F.col("latest_event_type_from_reg"))
    return course_work.join(found, "cw_no", "left").withColumn("latest_event_type_final", final)


def bad_event_times(registrations: DataFrame) -> DataFrame:
    """Events whose day and clock digits are no time."""
    moment = dates.event_timestamp(F.col("sys_date"), F.col("tm"))
    return registrations.where(moment.isNull() & F.col("sys_date").isNotNull() & F.col("tm").isNotNull())


def registration_summary(registrations: DataFrame, tie: list[str] = ()) -> DataFrame:
    """Counts, dates and last status per course work, from staged registrations."""
    newest = F.struct(F.col("event_date"), *[F.col(c) for c in tie])
    return registrations.where("course_work_number is not null").groupBy("course_work_number").agg(
        F.count("*").alias("total_registration_events"),
        F.min("event_date").alias("first_event_date"),
        F.max("event_date").alias("latest_event_date"),
        F.max("system_date").alias("latest_system_date"),
        F.max_by("registration_status_code", F.when(F.col("event_date").isNotNull(), newest))
        .alias("latest_registration_status"),
        F.count_distinct("registration_status_code").alias("unique_status_count"))


def course_registrations(enriched: DataFrame, registrations: DataFrame, tie: list[str] = ()) -> DataFrame:
    """Enriched course work with its registration summary, one row per course work."""
    summary = registration_summary(registrations, tie)
    joined = enriched.join(summary, F.col("cw_no") == F.col("course_work_number"), "left")
    n = F.coalesce("total_registration_events", F.lit(0))
    return joined.select(
        F.col("cw_no").alias("course_work_number"), F.col("id").alias("student_id"),
        F.col("yr").alias("academic_year"), F.col("sess").alias("term_code"), F.col("subsess").alias("subsession_code"),
        F.col("prog").alias("program_code"), F.col("crs_no").alias("course_number"), F.col("cat").alias("catalog_code"),
        F.col("sec").alias("section_number"), F.col("grd").alias("final_grade"), F.col("midsess_grd").alias("midsession_grade"),
        F.col("hrs").alias("credit_hours"), F.col("clock_hrs").alias("clock_hours"),
        F.col("beg_date").cast("date").alias("begin_date"), F.col("end_date").cast("date").alias("end_date"),
        F.col("stat").alias("course_work_status"), "latest_registration_status",
        n.alias("total_registration_events"), "first_event_date", "latest_event_date", "latest_system_date",
        "first_event_type", "first_event_timestamp", F.col("latest_event_type_final").alias("latest_event_type"),
        "latest_event_timestamp", (n > 1).alias("has_multiple_registration_attempts"))
