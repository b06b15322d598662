"""One master id per person over two systems, with history.

``new`` is the system of record, ``legacy`` the one being replaced; both have
(source_id, email, first_name, last_name, birth_date), ``new`` also created_on
and other_id (an id of a third system).  A person is a ``new`` id, or a legacy id
that no match rule links to one.  Every source row stands under one current master id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.config import MASTER_ID_PREFIX, RunConfig, keep, shared_dir
from siltworks.functions.keys import master_id, row_hash
from siltworks.functions.text import email_normalise
from siltworks.operators.joins import lookup
from siltworks.operators.windows import first_per_key, global_row_number

# System, role and match names stored with each identity row.
NEW, LEGACY, ADMISSIONS = "WORKDAY", "JENZABAR_CX", "SLATE"
STUDENT, PROSPECT, PERSON = "STUDENT", "PROSPECT", "PERSON"
SYSTEM_OF_RECORD = "SYSTEM_OF_RECORD"
EMAIL_MATCH = "EMAIL_MATCH"
REFERENCE_ID_MATCH = "WORKDAY_REFERENCE_ID_MATCH"
NAME_MATCH = "NAME_BIRTH_DATE_MATCH"
OTHER_IDS_PARSE = "WORKDAY_OTHER_IDS_PARSE"

# Match rules, strongest first, with the confidence and the name they are stored under.
RULES = {"id": (0.98, REFERENCE_ID_MATCH), "email": (0.95, EMAIL_MATCH), "name": (0.85, NAME_MATCH)}
DEFAULT_RULES = ("id", "email")

IDENTITY_KEY = ["master_id", "role_type", "source_system", "source_id"]
SOURCE_KEY = ["role_type", "source_system", "source_id"]
ATTRIBUTES = ["email", "first_name", "last_name", "birth_date"]


def one_row_per_id(df: DataFrame) -> DataFrame:
    """A source id with several rows (two programs) counts once."""
    order = [F.col(c).asc_nulls_last() for c in df.columns if c != "source_id"]
    return first_per_key(df.where("source_id is not null"), ["source_id"], order)


def _evidence(df: DataFrame, rule: str) -> DataFrame:
    """What a rule compares, as one value per source id; null where a row has nothing to compare."""
    names = [F.nullif(F.lower(F.trim(c)), F.lit("")) for c in ("first_name", "last_name")]
    whole = F.when(names[0].isNotNull() & names[1].isNotNull() & F.col("birth_date").isNotNull(),
                   F.to_json(F.array(*names, F.col("birth_date").cast("string"))))
    value = {"id": F.col("source_id"), "email": email_normalise(F.col("email")), "name": whole}[rule]
    return df.select("source_id", value.alias("evidence")).where("evidence is not null")


def match_links(new: DataFrame, legacy: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """The one person of the new system each linked legacy id belongs to (legacy_id, new_id, rule, confidence).

    The strongest rule decides; where several persons share the evidence, the lowest of their ids.
    Owners of a value are reduced by a partial aggregation, so a shared one is one row.
    """
    if unknown := set(rules) - set(RULES):
        raise ValueError(f"rules are some of {sorted(RULES)}, not {sorted(unknown)}")
    found = []
    for rule in rules:
        owners = _evidence(new, rule).groupBy("evidence").agg(F.min("source_id").alias("new_id"))
        claims = _evidence(legacy, rule).withColumnRenamed("source_id", "legacy_id")
        pairs = lookup(claims, owners, ["evidence"], "inner")  # an email may stand in very many legacy rows
        found.append(pairs.select("legacy_id", "new_id", F.lit(rule).alias("rule"),
                                  F.lit(RULES[rule][0]).cast("decimal(3,2)").alias("confidence")))
    return first_per_key(reduce(DataFrame.unionAll, found), ["legacy_id"], [F.desc("confidence"), F.col("new_id")])


def persons(new: DataFrame, legacy: DataFrame, links: DataFrame) -> DataFrame:
    """Every person once, under the id of the system that leads for them."""
    legacy_only = legacy.join(links, legacy["source_id"] == links["legacy_id"], "left_anti")
    return new.withColumn("source_system", F.lit(NEW)).unionByName(
        legacy_only.withColumn("source_system", F.lit(LEGACY)), allowMissingColumns=True)


def number_persons(people: DataFrame, links: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Add ``master_id``.

    Stored persons keep theirs.  A person new in the leading system takes over the lowest id
    stored for a legacy row linked to them; the others are numbered after the highest.
    """
    order = ["source_id", "source_system"]
    if previous is None:
        numbered = global_row_number(people, order, "__n")
        return numbered.withColumn("master_id", master_id(F.col("__n"))).drop("__n")
    leads = previous.where(F.col("is_primary_source") & F.col("is_current") & (F.col("role_type") == STUDENT))
    stored = leads.groupBy("source_system", "source_id").agg(F.min("master_id").alias("__stored"))
    moved = links.join(stored.where(F.col("source_system") == LEGACY), links["legacy_id"] == stored["source_id"])
    moved = moved.groupBy(F.lit(NEW).alias("source_system"), F.col("new_id").alias("source_id")).agg(
        F.min("__stored").alias("__inherited"))
    known = people.join(stored, ["source_system", "source_id"], "left").join(moved, ["source_system", "source_id"], "left")
    known = known.withColumn("master_id", F.coalesce("__stored", "__inherited")).drop("__stored", "__inherited")
    top = previous.agg(F.max(F.substring("master_id", len(MASTER_ID_PREFIX) + 1, 20).cast("bigint"))).scalar()
    numbered = global_row_number(known.where("master_id is null").drop("master_id"), order, "__n")
    numbered = numbered.withColumn("master_id", master_id(F.col("__n") + F.coalesce(top, F.lit(0)))).drop("__n")
    return known.where("master_id is not null").unionByName(numbered)


def _rows(df: DataFrame, role: str, system: str, source_id, primary: bool, confidence: float, method: str,
          effective) -> DataFrame:
    return df.select(
        "master_id", F.lit(role).alias("role_type"), F.lit(system).alias("source_system"),
        source_id.cast("string").alias("source_id"), F.lit(primary).alias("is_primary_source"),
        F.lit(confidence).cast("decimal(3,2)").alias("match_confidence"), F.lit(method).alias("match_method"),
        F.col("email").alias("tracked_email"), F.col("first_name").alias("tracked_first_name"),
        F.col("last_name").alias("tracked_last_name"), effective.cast("timestamp_ntz").alias("effective_date"))


def identity_rows(people: DataFrame, legacy: DataFrame, links: DataFrame, cfg: RunConfig,
                  shared_email: str = "first") -> DataFrame:
    """Current identity rows: each source row once, under one person.

    ``people`` are the numbered persons.  'all' adds, for an email shared by several persons of
    the new system, the legacy row under each of them; only then may a row stand under several.
    """
    if shared_email not in ("first", "all"):
        raise ValueError("shared_email is 'first' or 'all'")
    run = F.lit(cfg.run_time).cast("timestamp_ntz")
    new = people.where(F.col("source_system") == NEW)
    legacy_only = people.where(F.col("source_system") == LEGACY)
    owned = links.join(new.select(F.col("source_id").alias("new_id"), "master_id"), "new_id")

    def linked(rule):
        pairs = owned.where(F.col("rule") == rule)
        if rule == "id":  # both rows have the id; the leading system's attributes are tracked
            return new.join(pairs.select(F.col("legacy_id").alias("source_id")), "source_id")
        return legacy.join(pairs.select(F.col("legacy_id").alias("source_id"), "master_id"), "source_id")

    rows = [
        _rows(new, STUDENT, NEW, F.col("source_id"), True, 1.00, SYSTEM_OF_RECORD,
              F.coalesce(F.col("created_on").cast("timestamp_ntz"), run)),
        _rows(legacy_only, STUDENT, LEGACY, F.col("source_id"), True, 1.00, SYSTEM_OF_RECORD, run),
        _rows(new.where("other_id is not null"), PROSPECT, ADMISSIONS, F.col("other_id"), False, 0.95,
              OTHER_IDS_PARSE, run),
        *[_rows(linked(rule), STUDENT, LEGACY, F.col("source_id"), False, *RULES[rule], run) for rule in RULES],
    ]
    if shared_email == "all":
        mail = email_normalise(F.col("email"))
        owners = new.select(mail.alias("__mail"), "master_id").where("__mail is not null")
        each = legacy.withColumn("__mail", mail).join(owners, "__mail")
        rows.append(_rows(each, STUDENT, LEGACY, F.col("source_id"), False, *RULES["email"], run))
    key = SOURCE_KEY if shared_email == "first" else IDENTITY_KEY
    return first_per_key(reduce(DataFrame.unionByName, rows), key,
                         [F.col("match_confidence").desc(), F.col("match_method"), F.col("master_id")])


def with_scd(rows: DataFrame, cfg: RunConfig) -> DataFrame:
    """Hashes, validity and the version key."""
    rows = rows.withColumns({
        "institution_code": F.lit(cfg.institution_code),
        "entity_type": F.lit(PERSON),
        "row_hash": row_hash(*[F.col(f"tracked_{c}") for c in ATTRIBUTES[:3]]),
        "end_date": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
    })
    parts = ["institution_code", "entity_type", "master_id", "role_type", "source_system", "source_id"]
    return rows.withColumn("scd_id", row_hash(*[F.col(c) for c in parts], _time_text("effective_date")))


def _time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def resolve_identities(new: DataFrame, legacy: DataFrame, cfg: RunConfig, previous: DataFrame | None = None,
                       shared_email: str = "first", folder: str | None = None, rules=DEFAULT_RULES) -> DataFrame:
    """Next state of the identity table.

    First run: all rows.  Later runs: rows whose tracked attributes or match changed close
    their stored version and open another one; a stored row whose source row now stands
    under another person is closed; the rest stays as stored.  Steps that several others
    read are written once to ``folder`` (by default a new shared one).
    """
    folder = folder or shared_dir(new.sparkSession)
    new = keep(one_row_per_id(new), f"{folder}/new")
    legacy = keep(one_row_per_id(legacy), f"{folder}/legacy")
    links = keep(match_links(new, legacy, rules), f"{folder}/links")
    people = keep(number_persons(persons(new, legacy, links), links, previous), f"{folder}/people")
    rows = with_scd(identity_rows(people, legacy, links, cfg, shared_email), cfg)
    if previous is None:
        return rows
    rows = keep(rows, f"{folder}/rows")
    current = previous.where("is_current")
    before = current.select(*IDENTITY_KEY, F.struct("row_hash", "is_primary_source", "match_method").alias("__before"))
    now = F.struct("row_hash", "is_primary_source", "match_method")
    changed = rows.join(before, IDENTITY_KEY, "left").where(~F.col("__before").eqNullSafe(now))
    changed = keep(changed.withColumn("__seen", F.col("__before").isNotNull()).drop("__before"), f"{folder}/changed")
    run = F.lit(cfg.run_time).cast("timestamp_ntz")
    opened = changed.withColumn("effective_date", F.when(F.col("__seen"), run).otherwise(F.col("effective_date")))
    opened = with_scd(opened.drop("__seen"), cfg).select(*previous.columns)
    moved = current.select(*IDENTITY_KEY).join(rows, IDENTITY_KEY, "left_anti").join(
        rows.select(*SOURCE_KEY).distinct(), SOURCE_KEY, "left_semi")
    closing = changed.where("__seen").select(*IDENTITY_KEY).unionByName(moved.select(*IDENTITY_KEY)).distinct()
    stored = previous.join(closing.withColumn("__closes", F.lit(True)), IDENTITY_KEY, "left")
    ends = F.col("is_current") & F.coalesce("__closes", F.lit(False))
    stored = stored.withColumns({
        "end_date": F.when(ends, run).otherwise(F.col("end_date")),
        "is_current": F.col("is_current") & ~ends,
    })
    return stored.select(*previous.columns).unionByName(opened)


def source_rows_per_master(identities: DataFrame) -> DataFrame:
    """How many source rows are current, and how many of them under more than one master id."""
    per_row = identities.where("is_current").groupBy(*SOURCE_KEY).agg(
        (F.min("master_id") != F.max("master_id")).alias("several"))
    return per_row.agg(F.count("*").alias("source_rows"), F.count_if("several").alias("under_several_masters"))
