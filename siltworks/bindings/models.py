"""The composed models, on college tables derived from the given ones.

``RAW`` derives the raw tables in SQL that both engines read: people from customer
and supplier, courses from part, sections and course work from lineitem, terms and
addresses from orders.  It only shapes inputs; blanks, nulls, ties, overlaps and
orphans come from the values of other columns.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from siltworks.bindings.base import AS_OF_SQL, CFG, RUN_SQL, Tables, query
from siltworks.config import keep, own_session, shared_dir
from siltworks.functions.text import regex_capture
from siltworks.operators.joins import copied_if_small, hot_keys
from siltworks.plans import events, golden, identity, star_schema
from siltworks.plans.calendar import recursive_dates
from siltworks.plans.staging import COLLEGE, stage
from siltworks.sources import loads

col = F.col

PROGRAM = "case when p_size > 25 then 'GRAD' else 'UNDG' end"
MAIL = ("case when c_mktsegment = 'MACHINERY' then null when c_mktsegment = 'AUTOMOBILE' "
        "then concat('Family', cast(c_nationkey as string), '@Home.edu') else concat({0}'user', cast(c_custkey as string), '@mail.edu') end")

RAW = {
    "aa_table": """select distinct aa, case when aa = 'PERM' then 'N' else 'Y' end as email from (
        select case o_orderpriority when '1-URGENT' then 'EML' when '2-HIGH' then 'EM2' else 'PERM' end as aa from {orders})""",
    "aa_rec": """select o_orderkey as aa_no, o_custkey as id,
        case o_orderpriority when '1-URGENT' then 'EML' when '2-HIGH' then 'EM2' else 'PERM' end as aa,
        case when o_totalprice > 400000 then null else o_orderdate end as beg_date,
        case o_orderstatus when 'O' then null when 'F' then o_orderdate + interval '400' day else timestamp '2003-01-01 00:00:00' end as end_date,
        case when o_totalprice < 40000 then 'no mail' when o_totalprice < 80000 then concat('a b', cast(o_orderkey as string), '@mail.edu')
          else concat('User', cast(o_orderkey as string), '@Mail.edu') end as line1 from {orders}""",
    "cw_rec": """select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as cw_no, o_custkey as id,
        cast(year(o_orderdate) as int) as yr, concat('Q', cast(quarter(o_orderdate) as string)) as sess,
        case when l_linenumber > 3 then 'S 2' else 'S 1' end as subsess, """ + PROGRAM + """ as prog,
        concat('C', cast(p_partkey as string)) as crs_no, p_brand as cat, l_linenumber as sec,
        case when hrs < 15 then 'A' when hrs < 35 then 'N' else 'R' end as grd, case when tax > 0.04 then 'F' else 'O' end as grdg, hrs,
        'B' as midsess_grd, hrs * 15 as clock_hrs, o_orderstatus as stat, cast(o_orderdate as date) as beg_date,
        cast(o_orderdate as date) + 90 as end_date
      from (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_tax) as tax,
          min(cast(l_quantity as int)) as hrs from {lineitem} group by l_orderkey, l_linenumber)
      join {orders} on l_orderkey = o_orderkey join {part} on l_partkey = p_partkey""",
    "reg_rec": """select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as cw_no, l_returnflag as stat,
        cast(date_trunc('year', l_shipdate) as date) as beg_date, cast(date_trunc('month', l_shipdate) as date) as sys_date,
        case when l_returnflag = 'R' and l_quantity < 10 then '2570' else cast(l_linenumber * 100 + cast(round(l_tax * 100) as int) as string) end as tm
      from {lineitem}""",
    "acad_cal_rec": """select distinct concat('Q', cast(q as string)) as sess, sub as subsess, yr, prog, concat(cast(yr as string), 'A') as acyr,
        beg as beg_date, case when prog = 'PREP' and q = 4 then null else beg + 110 end as end_date
      from (select cast(quarter(o_orderdate) as int) as q, cast(year(o_orderdate) as int) as yr, case when o_orderpriority < '3' then 'S 1' else 'S 2' end as sub,
          case o_orderstatus when 'O' then 'UNDG' when 'F' then 'GRAD' else 'PREP' end as prog,
          cast(date_trunc('quarter', o_orderdate) as date) + case when o_orderstatus = 'P' then 30 else 0 end as beg from {orders})""",
    "major_table": """select c_mktsegment as major, concat('Major ', c_mktsegment) as txt, date '1990-01-01' as active_date,
        case when avg(c_acctbal) > 4500 then date '1999-12-31' end as inactive_date from {customer} group by c_mktsegment""",
    "deg_table": """select p_brand as deg, concat('Degree ', p_brand) as txt, date '1990-01-01' as active_date,
        case when max(p_size) < 50 then date '1999-12-31' end as inactive_date from {part} group by p_brand""",
    "dept_table": """select p_type as dept, concat('Dept ', p_type) as txt, date '1990-01-01' as active_date,
        cast(null as date) as inactive_date from {part} where p_type <> 'PROMO' group by p_type""",
    "ethnic_table": """select r_name as ethnic, concat('Group ', r_name) as txt, date '1990-01-01' as active_date,
        case when r_regionkey > 3 then date '1999-12-31' end as inactive_date from {region}""",
    "grd_table": """select l_returnflag as grd, l_linestatus as ctgry, concat('Grade ', l_returnflag) as txt, cast(min(l_quantity) as int) as pts,
        date '1990-01-01' as active_date, cast(null as date) as inactive_date from {lineitem}
        where not (l_returnflag = 'N' and l_linestatus = 'F') group by l_returnflag, l_linestatus""",
    "acad_stat_table": "select distinct n_regionkey as acst, concat('Standing ', cast(n_regionkey as string)) as txt from {nation}",
    "crs_rec": """select concat('C', cast(p_partkey as string)) as crs_no, p_brand as cat, p_name as title1, nullif(p_type, 'ECONOMY') as title2,
        concat('size ', cast(p_size as string)) as title3, p_type as dept, """ + PROGRAM + """ as prog, date '1994-01-01' as stat_date from {part}""",
    "sec_rec": """select concat('C', cast(l_partkey as string)) as crs_no, p_brand as cat, yr, sess, l_linenumber as sec_no,
        case when l_linenumber > 3 then 'S 2' else 'S 1' end as subsess, concat('Section ', cast(l_linenumber as string)) as title,
        concat('S', cast(min(l_suppkey) as string)) as fac_id, cast(count(*) as int) as reg_num, 'OPEN' as stat, min(beg) as beg_date,
        case when max(l_quantity) > 45 then null else min(beg) + 90 end as end_date
      from (select l_partkey, l_linenumber, l_suppkey, l_quantity, cast(year(o_orderdate) as int) as yr, concat('Q', cast(quarter(o_orderdate) as string)) as sess,
          cast(date_trunc('quarter', o_orderdate) as date) as beg from {lineitem} join {orders} on l_orderkey = o_orderkey)
      join {part} on l_partkey = p_partkey group by l_partkey, p_brand, yr, sess, l_linenumber""",
    "fac_rec": """select concat('S', cast(s_suppkey as string)) as id, 'PROF' as title, case when s_nationkey < 8 then 'SMALL' when s_nationkey < 16 then 'LARGE' else 'PROMO' end as dept,
        date '1993-01-01' as stat_date from {supplier}""",
    "id_rec": """select cast(c_custkey as string) as id, concat('F', cast(c_nationkey as string)) as firstname, c_name as lastname, nullif(c_mktsegment, 'BUILDING') as middlename,
        'Mx' as title, cast(null as string) as suffix, date '1992-01-01' as add_date from {customer}
      union all select concat('S', cast(s_suppkey as string)), concat('F', cast(s_nationkey as string)), s_name, null, 'Dr', 'PhD', date '1991-01-01' from {supplier}""",
    "profile_rec": """select cast(c_custkey as string) as id, date '1970-01-01' + cast(floor(c_acctbal) as int) as birth_date, case when c_acctbal > 5000 then 'F' else 'M' end as sex,
        case when c_nationkey = 7 then 'UNLISTED' else r_name end as ethnic_code, case when c_nationkey < 10 then 'Y' when c_nationkey < 20 then 'N' end as hispanic,
        n_name as res_ctry from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "prog_enr_rec": """select cast(c_custkey as string) as id, prog, case when c_acctbal > 0 then 'BA' end as deg, c_mktsegment as major1, n_regionkey as acst,
        case when c_nationkey < 12 then 'A' when c_nationkey < 18 then 'C' else 'W' end as currenr, date '1995-01-01' as enr_date, date '1994-06-01' as adm_date,
        case when c_acctbal > 9000 then date '2000-06-30' end as deg_grant_date
      from (select 'UNDG' as prog, * from {customer} union all select 'GRAD' as prog, * from {customer} where c_acctbal > 4000) as c
      join {nation} on c_nationkey = n_nationkey""",
    "new_students": """select case when c_mktsegment = 'BUILDING' then concat('W', cast(c_custkey as string)) else cast(c_custkey as string) end as source_id,
        """ + MAIL.format("' ', ") + """ as email, concat('F', cast(c_nationkey as string)) as first_name, c_name as last_name,
        case when c_nationkey = 3 then null else date '1980-01-01' + c_nationkey * 300 end as birth_date,
        case when c_mktsegment = 'HOUSEHOLD' then null else timestamp '2000-05-05 08:00:00' end as created_on,
        case when c_mktsegment = 'FURNITURE' then concat('Tax/9; Slate Person ID/', cast(c_custkey + 70000 as string), '; x') else 'Tax/9' end as other_ids,
        c_acctbal > 5000 as is_active, case when c_nationkey < 5 then true end as is_graduated, concat('City', cast(c_nationkey as string)) as city
      from {customer} where c_acctbal > 3000""",
    "legacy_students": """select cast(c_custkey as string) as source_id, """ + MAIL.format("") + """ as email,
        nullif(concat('L', cast(c_nationkey as string)), 'L4') as first_name, c_name as last_name, date '1981-01-01' + c_nationkey * 300 as birth_date,
        case when c_nationkey < 12 then 'A' when c_nationkey < 18 then 'W' end as enrollment_status, 'P1' as program_code,
        date '1997-01-01' as first_entry_date
      from {customer} where c_acctbal < 6000""",
}
TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def raw(t, name: str, by_course: bool = False, **given):
    """Rows of a raw table; ``by_course`` deals order lines by course number before they meet parts, by that number
    too, which is one to one with the part's key: the rows then stay where they meet sections and courses.

    All those meet in one task, so its partitions are as many as asked for, not merged by the bytes of one input.
    """
    text = RAW[name]
    if by_course:
        line, part = (f"concat('C', cast({p}_partkey as string))" for p in "lp")
        head, rest = text.split("from (", 1)
        lines, tail = rest.split("join {part} on l_partkey = p_partkey")
        known = raw_rows(t, f"select * from ({lines}", given).where("l_partkey is not null")  # else all without a part meet in one task
        given["lines"] = known.repartition(partitions(t), F.expr(line))
        text = f"{head}from {{lines}} join {{part}} on {line} = {part}{tail.replace('group by l_partkey', f'group by {line}')}"
    return raw_rows(t, text, given)


def raw_rows(t, text: str, given: dict):
    used = {n: given[n] if n in given else getattr(t, n) for n in (*TABLE_NAMES, "lines") if f"{{{n}}}" in text}
    return t.spark.sql(text, **used)


def partitions(t) -> int:
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


def no_hot_key(t, table, key: str) -> bool:
    return not hot_keys(table, [key], partitions(t))


def course_work(t, by_course: bool = False):
    """Order lines are dealt by order once, to be grouped and to meet their order, unless an order has very many."""
    lines = t.lineitem
    if no_hot_key(t, lines, "l_orderkey"):
        lines = lines.repartition("l_orderkey")
    return raw(t, "cw_rec", by_course, lineitem=lines)


def raw_sql(name: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", RAW[name])


def ctes(*names: str) -> str:
    return "with " + ",\n".join(f"{n} as ({raw_sql(n)})" for n in names)


def staged(t, name: str):
    return stage(raw(t, name), COLLEGE[name])


# --- contact and events --------------------------------------------------------------------

@query("model_emails", ctes("aa_rec", "aa_table") + f"""
select id as person_id, lower(trim(line1)) as email_address, aa as address_type_code, cast(beg_date as date) as begin_date, cast(end_date as date) as end_date
from (select *, row_number() over (partition by id order by case when end_date is null then 0 else 1 end, beg_date desc nulls first, aa_no desc) as email_rank
  from aa_rec join aa_table using (aa) where email = 'Y' and line1 like '%@%' and line1 not like '% %' and (end_date is null or end_date >= {AS_OF_SQL}))
where email_rank = 1""")
def _(t):
    return events.pick_emails(staged(t, "aa_rec"), raw(t, "aa_table"), CFG.as_of)


# First and latest event are the least and greatest of (date, time, status); an unknown time counts as the latest.
ENRICHED = """reg as (select *, try_strptime(concat(cast(sys_date as varchar), lpad(tm, 4, '0')), '%Y-%m-%d%H%M') as ets from reg_rec),
ends as (select cw_no, arg_min({'s': stat, 't': ets}, (beg_date, ets, stat)) as lo, arg_max({'s': stat, 't': ets}, (beg_date, ets, stat)) as hi from reg group by cw_no),
twice as (select cw_no from reg group by cw_no, beg_date, ets having count(*) > 1),
enriched as (select c.*, lo.s as first_event_type, lo.t as first_event_timestamp, hi.s as latest_event_type_from_reg, hi.t as latest_event_timestamp,
    case when ends.cw_no is not null then c.cw_no in (from twice) end as is_event_timestamp_ambiguous,
    if(c.cw_no in (from twice), c.stat, hi.s) as latest_event_type_final
  from cw_rec c left join ends on ends.cw_no = c.cw_no)"""


def enriched(t):
    return events.enrich_course_work(course_work(t), raw(t, "reg_rec"), ["stat"])


@query("model_event_enrich", ctes("cw_rec", "reg_rec") + ",\n" + ENRICHED + " select * from enriched")
def _(t):
    return enriched(t)


@query("model_registrations", ctes("cw_rec", "reg_rec") + ",\n" + ENRICHED + """,
summary as (select cw_no, count(*) as total_registration_events, min(beg_date) as first_event_date, max(beg_date) as latest_event_date,
  max(sys_date) as latest_system_date, arg_max(stat, (beg_date, stat)) as latest_registration_status from reg_rec group by 1)
select e.cw_no as course_work_number, id as student_id, yr as academic_year, sess as term_code, subsess as subsession_code, prog as program_code, crs_no as course_number,
  cat as catalog_code, sec as section_number, grd as final_grade, midsess_grd as midsession_grade, hrs as credit_hours, clock_hrs as clock_hours,
  beg_date as begin_date, end_date, stat as course_work_status, latest_registration_status,
  coalesce(total_registration_events, 0) as total_registration_events, first_event_date, latest_event_date, latest_system_date, first_event_type, first_event_timestamp,
  latest_event_type_final as latest_event_type, latest_event_timestamp, coalesce(total_registration_events, 0) > 1 as has_multiple_registration_attempts
from enriched e left join summary s on e.cw_no = s.cw_no""")
def _(t):
    return events.course_registrations(enriched(t), staged(t, "reg_rec"), ["registration_status_code"])


# --- identity and golden record ---------------------------------------------------------------

_MAIL = "nullif(lower(trim(email)), '')"
IDENTITY = f"""
new as (select *, {_MAIL} as mail, nullif(regexp_extract(other_ids, 'Slate Person ID/([0-9]+)', 1), '') as other_id from new_students),
legacy as (select *, {_MAIL} as mail from legacy_students),
owners as (select mail, min(source_id) as new_id from new where mail is not null group by mail),
links as (select l.source_id, coalesce(n.source_id, o.new_id) as new_id, n.source_id is not null as by_id
  from legacy l left join new n on n.source_id = l.source_id left join owners o on o.mail = l.mail),
ids as (select *, concat('DTU_PERSON_', lpad(cast(row_number() over (order by source_id, s) as varchar), 9, '0')) as master_id
  from (select source_id, 'WORKDAY' as s from new union all select source_id, 'JENZABAR_CX' from links where new_id is null)),
best as (
  select master_id, 'STUDENT' as role_type, s as source_system, ids.source_id, true as is_primary_source, 1.00 as match_confidence, 'SYSTEM_OF_RECORD' as match_method,
    coalesce(n.email, l.email) as email, coalesce(n.first_name, l.first_name) as first_name, coalesce(n.last_name, l.last_name) as last_name, coalesce(n.created_on, {RUN_SQL}) as effective_date
  from ids left join new n on s = 'WORKDAY' and n.source_id = ids.source_id left join legacy l on s = 'JENZABAR_CX' and l.source_id = ids.source_id
  union all select master_id, 'STUDENT', 'JENZABAR_CX', k.source_id, false, if(by_id, 0.98, 0.95), if(by_id, 'WORKDAY_REFERENCE_ID_MATCH', 'EMAIL_MATCH'),
    if(by_id, n.email, l.email), if(by_id, n.first_name, l.first_name), if(by_id, n.last_name, l.last_name), {RUN_SQL}
  from links k join ids on s = 'WORKDAY' and ids.source_id = k.new_id join new n on n.source_id = k.new_id join legacy l on l.source_id = k.source_id
  union all select min(master_id), 'PROSPECT', 'SLATE', other_id, false, 0.95, 'WORKDAY_OTHER_IDS_PARSE',
    arg_min(struct_pack(v := email), master_id).v, arg_min(struct_pack(v := first_name), master_id).v, arg_min(struct_pack(v := last_name), master_id).v, {RUN_SQL}
  from new join ids using (source_id) where s = 'WORKDAY' and other_id is not null group by other_id),
identities as (select 'SILT' as institution_code, 'PERSON' as entity_type, master_id, role_type, source_system, source_id, is_primary_source,
  cast(match_confidence as decimal(3,2)) as match_confidence, match_method, email as tracked_email, first_name as tracked_first_name, last_name as tracked_last_name,
  md5(concat_ws('||', coalesce(email, ''), coalesce(first_name, ''), coalesce(last_name, ''))) as row_hash, effective_date, cast(null as timestamp) as end_date, true as is_current,
  md5(concat_ws('||', 'SILT', 'PERSON', master_id, role_type, source_system, source_id, strftime(effective_date, '%Y-%m-%d %H:%M:%S'))) as scd_id from best)"""


def new_students(t):
    return raw(t, "new_students").withColumn("other_id", regex_capture(col("other_ids"), "Slate Person ID/([0-9]+)"))


def identities(t):
    cols = ["source_id", "email", "first_name", "last_name", "birth_date"]
    legacy = raw(t, "legacy_students").select(*cols)
    twice = legacy.unionAll(legacy)  # two programs per person
    return identity.resolve_identities(new_students(t).select(*cols, "created_on", "other_id"), twice, CFG)


@query("model_identity", ctes("new_students", "legacy_students") + "," + IDENTITY + " select * from identities")
def _(t):
    return identities(t)


@query("identity_one_master", ctes("new_students", "legacy_students") + "," + IDENTITY + """
select count(*) as source_rows, count(*) filter (masters > 1) as under_several_masters
from (select count(distinct master_id) as masters from identities where is_current group by role_type, source_system, source_id)""")
def _(t):
    return identity.source_rows_per_master(identities(t))


@query("model_golden_record", ctes("new_students", "legacy_students") + "," + IDENTITY + f""",
map as (select master_id, max(case when source_system = 'WORKDAY' then source_id end) as new_id, max(case when source_system = 'JENZABAR_CX' then source_id end) as legacy_id,
  max(case when source_system = 'WORKDAY' then is_primary_source end) as nl, max(case when source_system = 'JENZABAR_CX' then is_primary_source end) as ll
  from identities where role_type = 'STUDENT' and is_current group by 1),
j as (select master_id, new_id, legacy_id, case when nl then 'WORKDAY' when ll then 'JENZABAR_CX' else 'UNKNOWN' end as primary_source_system,
  coalesce(n.first_name, o.first_name) as first_name, coalesce(n.last_name, o.last_name) as last_name, coalesce(n.birth_date, o.birth_date) as birth_date,
  coalesce(n.email, o.email) as email, coalesce(n.is_active, o.enrollment_status in ('A', 'C', 'E'), case when o.source_id is not null then false end) as is_active,
  coalesce(cast(n.created_on as date), o.first_entry_date) as first_entry_date, n.city, o.program_code as legacy_program_code,
  o.enrollment_status as legacy_enrollment_status, coalesce(n.is_graduated, false) as is_graduated
  from map left join new n on new_id = n.source_id left join legacy o on legacy_id = o.source_id)
select *, trim(concat(first_name || ' ' || last_name)) as full_name_raw, trim(first_name || ' ' || last_name) as full_name, cast(2001 - year(birth_date) as integer) as calculated_age, 2001 - year(birth_date) >= 24 as is_independent_student,
  email is not null as has_email, case when first_name is null then 'MISSING_NAME' when email is null then 'MISSING_EMAIL' when birth_date is null then 'MISSING_DOB' else 'COMPLETE' end as data_quality_flag,
  case when new_id is not null and legacy_id is not null then 'INTEGRATED' when new_id is not null then 'WORKDAY' else 'JENZABAR_CX' end as _source_system,
  new_id is not null and legacy_id is not null as in_both_systems, new_id is not null and legacy_id is null as new_only, new_id is null and legacy_id is not null as legacy_only
from j""".replace("trim(concat(first_name || ' ' || last_name)) as full_name_raw, ", ""))
def _(t):
    new = new_students(t).withColumn("first_entry_date", col("created_on").cast("date")).drop("created_on", "other_ids", "other_id")
    legacy = raw(t, "legacy_students").withColumn("is_active", golden.is_active(col("enrollment_status")))
    return golden.golden_records(
        identities(t), new, legacy, CFG.as_of, false_if_unknown=["is_graduated"],
        names={"program_code": "legacy_program_code", "enrollment_status": "legacy_enrollment_status"})


# --- dimensions ----------------------------------------------------------------------------------

TRACK = f"true as is_current, {RUN_SQL} as creation_timestamp, {RUN_SQL} as last_modified_timestamp"
_NULLTOK = "'_dbt_utils_surrogate_key_null_'"


def key_sql(*parts: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(cast({p} as varchar), {_NULLTOK})" for p in parts) + "))"


_SUB = "trim(replace(subsess, ' ', '-'))"
DIM_TERM = f"""dim_term as (select {key_sql("trim(sess)", _SUB, "yr", "trim(prog)")} as term_key,
  trim(sess) || {_SUB} || yr || trim(prog) as term_code, 'Session: ' || trim(sess) || ' Year: ' || yr || ' Subsession: ' || {_SUB} || ' Program: ' || trim(prog) as term_descr,
  acyr as term_acad_yr, sess as term_sess, yr as term_year, subsess as term_subsess, prog as term_program_level, acyr as term_award_yr, acyr as term_fiscal_yr,
  beg_date as term_beg_date, end_date as term_end_date, beg_date as source_active_date, end_date as source_inactive_date,
  end_date is null or end_date >= {AS_OF_SQL} as is_active, {TRACK} from acad_cal_rec)"""


def terms(t):
    return star_schema.term_dimension(raw(t, "acad_cal_rec"), CFG.as_of, CFG.run_time)


@query("model_dim_term", ctes("acad_cal_rec") + ",\n" + DIM_TERM + " select * from dim_term")
def _(t):
    return terms(t)


_LEVEL = "case term_program_level when 'UNDG' then 0 when 'GRAD' then 1 else 2 end"
# A day belongs to the least of its ranges by (level, latest begin, earliest end, key), a range to the least of its terms.
DIM_DATE = f"""ranges as (select unnest(arg_min(t, ({_LEVEL}, term_key))) from dim_term t
    where term_beg_date is not null and term_end_date is not null group by term_beg_date, term_end_date),
days as (select unnest(generate_series(min(o_orderdate) - interval 20 day, max(o_orderdate) + interval 200 day, interval 1 day))::date as dt from orders),
primary_terms as (select dt, arg_min(r, ({_LEVEL}, date '9999-12-31' - term_beg_date, term_end_date, term_key)) as term
    from days join ranges r on dt between term_beg_date and term_end_date group by dt),
picked as (select dt, unnest(term) from days left join primary_terms using (dt)),
dim_date as (select strftime(dt, '%Y%m%d')::integer as date_key, dt as date_actual, (dayofweek(dt) + 1)::integer as day_of_week_num, left(dayname(dt), 3) as day_of_week_name,
  left(dayname(dt), 3) as day_of_week_abbr, day(dt)::integer as day_of_month, dayofyear(dt)::integer as day_of_year, week(dt)::integer as week_of_year, month(dt)::integer as month_num,
  left(monthname(dt), 3) as month_name, left(monthname(dt), 3) as month_abbr, quarter(dt)::integer as quarter_num, 'Q' || quarter(dt) as quarter_name, year(dt)::integer as year_num,
  dayofweek(dt) in (0, 6) as is_weekend, dt = {AS_OF_SQL} as is_current_date,
  case when month(dt) >= 8 then concat(year(dt), '-', year(dt) + 1) else concat(year(dt) - 1, '-', year(dt)) end as academic_year,
  term_key is not null as is_in_term, term_key as primary_term_key, term_code as primary_term_code, term_descr as primary_term_descr, term_acad_yr as primary_term_acad_yr,
  term_sess as primary_term_sess, term_year as primary_term_year, term_subsess as primary_term_subsess, term_program_level as primary_term_program_level,
  (year(dt) + case when month(dt) >= 7 then 1 else 0 end)::integer as fiscal_year_num, ((month(dt) + 5) % 12 // 3 + 1)::integer as fiscal_quarter_num,
  ((month(dt) + 5) % 12 + 1)::integer as fiscal_month_num, concat('FY', year(dt) + case when month(dt) >= 7 then 1 else 0 end, '-Q', (month(dt) + 5) % 12 // 3 + 1) as fiscal_period_name
  from picked)"""


def calendar_days(t):
    bounds = t.orders.agg(F.date_sub(F.min("o_orderdate"), 20).alias("lo"), F.date_add(F.max("o_orderdate"), 200).alias("hi"))
    return recursive_dates(bounds, col("lo"), col("hi"))


def dim_date(t):
    return star_schema.date_dimension_with_terms(calendar_days(t), terms(t), CFG.as_of)


@query("model_dim_date", ctes("acad_cal_rec") + ",\n" + DIM_TERM + ",\n" + DIM_DATE + " select * from dim_date")
def _(t):
    return dim_date(t)


_TITLE = "title1 || ' ' || title2 || ' ' || title3"


@query("model_dim_course", ctes("crs_rec") + f"""
select {key_sql('crs_no', 'cat')} as course_key, crs_no as course_code, {_TITLE} as course_title, cat as course_catalog, prog as course_program_level, dept as course_dept,
  stat_date as source_active_date, cast(null as date) as source_inactive_date, true as is_active, {TRACK} from crs_rec""")
def _(t):
    return star_schema.course_dimension(staged(t, "crs_rec"), CFG.run_time, ("course_number", "catalog_code"))


def departments(t):
    return star_schema.lookup_dimension(raw(t, "dept_table"), "dept", CFG.run_time)


def faculty(t):
    return star_schema.faculty_dimension(staged(t, "fac_rec"), staged(t, "id_rec"), departments(t), CFG.run_time)


@query("model_dim_faculty", ctes("fac_rec", "id_rec", "dept_table") + f"""
select {key_sql('f.id')} as faculty_key, f.id as faculty_code, lastname as faculty_lastname, firstname as faculty_firstname, middlename as faculty_middlename,
  i.title as faculty_prefix, suffix as faculty_suffix, f.title as faculty_rank, d.dept as faculty_dept, stat_date as source_active_date, cast(null as date) as source_inactive_date,
  true as is_active, {TRACK} from fac_rec f join id_rec i on f.id = i.id join dept_table d on f.dept = d.dept""")
def _(t):
    return faculty(t)


DIM_SECTION = f"""dim_section as (select {key_sql('s.crs_no', 'sec_no', 'yr', 'sess')} as course_section_key, s.crs_no as course_section_course_number, sec_no as course_section_section_number,
  {_TITLE} as course_title, s.title as section_title, s.cat as course_section_catalog, d.dept as course_section_dept, sess as course_section_sess, yr as course_section_year,
  subsess as course_section_subsess, c.prog as course_section_program_level, reg_num as course_section_reg_number, s.stat as course_section_status, {key_sql('f.id')} as course_section_faculty_key,
  s.beg_date as source_active_date, s.end_date as source_inactive_date, s.end_date is null or s.end_date >= {AS_OF_SQL} as is_active, {TRACK}
  from crs_rec c join sec_rec s on c.crs_no = s.crs_no and c.cat = s.cat join fac_rec f on s.fac_id = f.id join id_rec i on f.id = i.id
  join dept_table fd on f.dept = fd.dept join dept_table d on c.dept = d.dept)"""


def sections(t, by_course: bool = False):
    """Faculty is stored first, so that its size is known before sections would be dealt by it."""
    people = copied_if_small(keep(faculty(t).select("faculty_code", "faculty_key"), f"{shared_dir(t.spark)}/faculty"))
    rows = stage(raw(t, "sec_rec", by_course), COLLEGE["sec_rec"])
    return star_schema.section_dimension(staged(t, "crs_rec"), rows, people, departments(t), CFG.as_of, CFG.run_time)


@query("model_dim_section", ctes("crs_rec", "sec_rec", "fac_rec", "id_rec", "dept_table") + ",\n" + DIM_SECTION + " select * from dim_section")
def _(t):
    return sections(t)


DIM_STUDENT = f"""dim_student as (select {key_sql('p.id', 'e.prog')} as student_key, p.id as student_code, lastname as student_lastname, firstname as student_firstname,
  middlename as student_middlename, title as student_prefix, suffix as student_suffix, major as student_major, birth_date as student_dob, sex as student_gender,
  res_ctry as student_country, ethnic as student_ethnicity, deg_grant_date as student_grad_date, a.txt as student_acad_stat, e.prog as student_program_level,
  add_date as source_active_date, cast(null as date) as source_inactive_date, true as is_active, {TRACK}
  from profile_rec p join id_rec i on p.id = i.id join prog_enr_rec e on e.id = p.id join major_table on major1 = major join ethnic_table on ethnic = ethnic_code
  join acad_stat_table a on e.acst = a.acst)"""


def students(t):
    majors = star_schema.lookup_dimension(raw(t, "major_table"), "major", CFG.run_time)
    groups = star_schema.lookup_dimension(raw(t, "ethnic_table"), "ethnicity", CFG.run_time)
    return star_schema.student_dimension(staged(t, "profile_rec"), staged(t, "id_rec"), staged(t, "prog_enr_rec"), majors, groups,
                                         raw(t, "acad_stat_table"), CFG.run_time)


_STUDENT_TABLES = ("profile_rec", "id_rec", "prog_enr_rec", "major_table", "ethnic_table", "acad_stat_table")


@query("model_dim_student", ctes(*_STUDENT_TABLES) + ",\n" + DIM_STUDENT + " select * from dim_student")
def _(t):
    return students(t)


_LOOKUP_TABLES = {"major": ("major_table", "major"), "degree": ("deg_table", "deg"), "dept": ("dept_table", "dept"),
                  "ethnicity": ("ethnic_table", "ethnic"), "grade": ("grd_table", "grd")}


@query("model_lookup_dims", ctes(*[n for n, _ in _LOOKUP_TABLES.values()]) + " union all ".join(
    f"\nselect '{k}' as kind, {key_sql(c)} as lookup_key, {c} as code, txt as descr, active_date as source_active_date, inactive_date as source_inactive_date, "
    f"inactive_date is null as is_active, {TRACK} from {n}" for k, (n, c) in _LOOKUP_TABLES.items()))
def _(t):
    out = None
    for kind, (name, _code) in _LOOKUP_TABLES.items():
        dim = star_schema.lookup_dimension(raw(t, name), kind, CFG.run_time)
        first = dim.columns[:3]
        dim = dim.select(F.lit(kind).alias("kind"), col(first[0]).alias("lookup_key"), col(first[1]).alias("code"), col(first[2]).alias("descr"),
                         "source_active_date", "source_inactive_date", "is_active", "is_current", "creation_timestamp", "last_modified_timestamp")
        out = dim if out is None else out.unionByName(dim)
    return out


@query("model_dim_gender", f"""
select md5(s_name) as gender_key, s_name as gender_code, concat('Name ', s_nationkey) as gender_name, case when s_nationkey < 10 then 'Binary' else 'Unknown' end as gender_category,
  true as is_active, s_nationkey as sort_order, {RUN_SQL} as _loaded_at, 'SEED' as _source_system, 'PUBLIC' as _data_classification, 'COMMON' as _data_owner
from supplier where s_acctbal > 0""")
def _(t):
    """A seed file in the shape of the gender seed, written from supplier."""
    folder = shared_dir(t.spark)
    kind = F.when(col("s_nationkey") < 10, "Binary").otherwise("Unknown")
    seed = t.supplier.select(col("s_name").alias("gender_code"), F.concat(F.lit("Name "), col("s_nationkey").cast("string")).alias("gender_name"),
                             kind.alias("gender_category"), (col("s_acctbal") > 0).alias("is_active"), col("s_nationkey").alias("sort_order"))
    seed.write.mode("overwrite").option("header", True).csv(folder)
    read = loads.load_seed(t.spark, folder, "gender_code string, gender_name string, gender_category string, is_active boolean, sort_order int")
    return star_schema.gender_dimension(read, CFG.run_time)


# --- fact ----------------------------------------------------------------------------------------------

_FACT_TABLES = ("cw_rec", "reg_rec", "acad_cal_rec", "crs_rec", "sec_rec", "fac_rec", "dept_table", "grd_table", *_STUDENT_TABLES)


@query("model_fact_enrollment", ctes(*dict.fromkeys(_FACT_TABLES)) + ",\n" + ",\n".join(
    [ENRICHED, DIM_TERM, DIM_DATE, DIM_SECTION, DIM_STUDENT]) + f"""
select cw_no as enrollment_source_serial, student_key as enrollment_stu_key, course_section_key as enrollment_course_section_key, term_key as enrollment_term_key,
  course_section_faculty_key as enrollment_faculty_key, case when g.grd is not null then {key_sql('g.grd')} end as enrollment_grade_key, hrs as enrollment_hours, stat as enrollment_status, prog as enrollment_program_level,
  first_event_type as enrollment_first_stat, h.date_key as enrollment_first_date_key, latest_event_type_final as enrollment_latest_stat, i.date_key as enrollment_latest_date_key,
  beg_date as source_active_date, end_date as source_inactive_date, 'Y' as is_current, {RUN_SQL} as creation_timestamp
from enriched a join dim_student on cast(id as varchar) = student_code and prog = student_program_level
join dim_section c on crs_no = course_section_course_number and sec = course_section_section_number and cat = course_section_catalog and prog = course_section_program_level
  and subsess = course_section_subsess and sess = course_section_sess and yr = course_section_year
left join dim_term on sess = term_sess and yr = term_year and prog = term_program_level and subsess = term_subsess
left join grd_table g on a.grd = g.grd and grdg = g.ctgry
left join dim_date h on first_event_timestamp::date = h.date_actual left join dim_date i on latest_event_timestamp::date = i.date_actual""")
def _(t):
    """Where no course is hot, course work, sections and courses are dealt by course once and meet there; joins of rows
    dealt by fewer columns than they are joined on are a setting, given to a session of its own.

    Terms and days are stored first, so that their size is known before course work would be dealt by them.
    """
    by_course = no_hot_key(t, t.lineitem, "l_partkey")
    if by_course:
        t = Tables(own_session(t.spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}), t.folder)
    folder = shared_dir(t.spark)
    grades = star_schema.lookup_dimension(raw(t, "grd_table"), "grade", CFG.run_time)
    known = keep(terms(t), f"{folder}/terms")
    days = star_schema.date_dimension_with_terms(calendar_days(t), known, CFG.as_of)
    days = keep(days.select("date_actual", "date_key"), f"{folder}/days")
    work = course_work(t, by_course).withColumn("id", col("id").cast("string"))
    return star_schema.enrollment_fact(work, students(t), sections(t, by_course), known, grades, days, CFG.run_time,
                                       registrations=raw(t, "reg_rec"), tie=["stat"])
