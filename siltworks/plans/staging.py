"""Raw table to staged table: names, types, flags, key filter and lineage from one spec."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import flags, text

KINDS = {
    "text": lambda c: c,
    "date": lambda c: c.cast("date"),
    "try_date": lambda c: text.try_cast(c, "date"),
    "timestamp": lambda c: c.cast("timestamp_ntz"),
    "try_timestamp": lambda c: text.try_cast(c, "timestamp_ntz"),
    "money": lambda c: c.cast("decimal(15,2)"),
    "yes_no": flags.yes_no,
    "one_zero": flags.one_zero,
    "one_or_false": flags.one_or_false,
    "blank_to_null": text.blank_to_null,
    "email": text.email_normalise,
}


@dataclass(frozen=True)
class Stage:
    """How a raw table becomes a staged one.

    ``columns`` maps a source column to its business name or to (name, kind);
    ``keys`` are source columns that must not be null.
    """

    columns: Mapping[str, str | tuple[str, str]]
    keys: tuple[str, ...] = ()
    extra: Mapping[str, Column] = field(default_factory=dict)

    def outputs(self) -> dict[str, tuple[str, str]]:
        return {a: (b, "text") if isinstance(b, str) else b for a, b in self.columns.items()}


def stage(df: DataFrame, spec: Stage, lineage: Mapping[str, Column] | None = None) -> DataFrame:
    """Staged rows; the key filter and the column list reach the scan."""
    out = [KINDS[kind](F.col(a)).alias(b) for a, (b, kind) in spec.outputs().items()]
    out += [c.alias(n) for n, c in spec.extra.items()]
    rows = df.dropna(subset=list(spec.keys)) if spec.keys else df
    staged = rows.select(*out)
    return staged.withColumns(dict(lineage)) if lineage else staged


# Columns of the college tables that the later plans read.
COLLEGE = {
    "id_rec": Stage({"id": "person_id", "firstname": "first_name", "lastname": "last_name",
                     "middlename": "middle_name", "title": "title", "suffix": "suffix",
                     "add_date": ("record_added_date", "date")}, ("id",)),
    "profile_rec": Stage({"id": "person_id", "birth_date": ("birth_date", "date"), "sex": "gender_code",
                          "ethnic_code": "ethnicity_code", "hispanic": ("is_hispanic", "yes_no"),
                          "res_ctry": "residence_country"}, ("id",)),
    "prog_enr_rec": Stage({"id": "student_id", "prog": "program_code", "deg": "degree_code",
                           "major1": "major_1_code", "acst": "academic_standing_code",
                           "currenr": "current_enrollment_status", "enr_date": ("enrollment_date", "date"),
                           "adm_date": ("admission_date", "date"),
                           "deg_grant_date": ("degree_grant_date", "date")}, ("id",)),
    "aa_rec": Stage({"aa_no": "address_number", "id": "person_id", "aa": "address_type_code",
                     "beg_date": ("begin_date", "date"), "end_date": ("end_date", "date"),
                     "line1": "address_line_1"}, ("id",)),
    "crs_rec": Stage({"crs_no": "course_number", "cat": "catalog_code", "title1": "title_line_1",
                      "title2": "title_line_2", "title3": "title_line_3", "dept": "department_code",
                      "prog": "program_code", "stat_date": ("status_date", "date")}, ("crs_no",)),
    "sec_rec": Stage({"crs_no": "course_number", "cat": "catalog_code", "yr": "academic_year", "sess": "term_code",
                      "sec_no": "section_number", "subsess": "subsession_code", "title": "section_title",
                      "fac_id": "primary_faculty_id", "reg_num": "current_registered_count", "stat": "status_code",
                      "beg_date": ("begin_date", "date"), "end_date": ("end_date", "date")},
                     ("crs_no", "yr", "sess", "sec_no")),
    "fac_rec": Stage({"id": "faculty_id", "title": "title_code", "dept": "primary_department_code",
                      "stat_date": ("status_date", "date")}, ("id",)),
    "reg_rec": Stage({"cw_no": "course_work_number", "beg_date": ("event_date", "date"), "tm": "event_time",
                      "sys_date": ("system_date", "date"), "stat": "registration_status_code"}, ("cw_no",)),
}
