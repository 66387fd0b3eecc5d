"""Field-operations tables derived from the TPC-H-ish test parquet.

The reference ships no data, so every domain table is a deterministic
projection of the read-only test tables (see FIXTURES.md).  Each recipe
is portable SQL text: Spark evaluates it through ``spark.sql`` with the
input DataFrames bound as ``{name}`` arguments, and the DuckDB oracle
inlines the same text as CTEs.  Sharing the text means the oracle checks
the pipelines, not two transcriptions of the inputs.

All recipes scale with the test tables (no fixed literal inputs except
the 4-row field metadata dimension).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# The test tables' columns (TESTDATA.md), declared so that no footer is read
# to plan a query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}

# ``{ts}`` marks a timestamp literal: TIMESTAMP_NTZ in Spark, TIMESTAMP in DuckDB.
# Recipes.  ``{name}`` is a table (raw or another recipe); ``{{``/``}}``
# are literal braces.
RECIPES: dict[str, str] = {
    "staff_master": """
select s_suppkey as id, concat('E',lpad(cast(s_suppkey as string),6,'0')) as emp_id,
 concat('T',lpad(cast(s_suppkey as string),6,'0')) as tech_id,
 case s_suppkey % 4 when 0 then 'Ann' when 1 then 'Bob' when 2 then 'Cy' else 'Dee' end as first_name,
 case when s_suppkey % 13 = 12 then null else concat('Last',cast(s_suppkey % 9 as string)) end as last_name,
 n_name as state, case when s_suppkey % 17 = 16 then null else concat('City_',cast(s_suppkey % 7 as string)) end as city,
 r_name as zone, concat('Team_',cast(s_suppkey % 5 as string)) as team,
 case when s_suppkey % 3 = 0 then 'Tech' else 'Lead' end as title,
 concat('555-',lpad(cast(s_suppkey as string),4,'0')) as mobile,
 concat('AM',cast(n_nationkey % 5 as string)) as assoc_manager_tid, concat('M',cast(r_regionkey as string)) as manager_tid,
 case r_regionkey when 0 then 'Eastern' when 1 then 'Central' when 2 then 'Mountain' when 3 then 'Hawaii' else 'Other' end as time_zone,
 s_suppkey % 10 <> 9 as is_active
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "siebel_srs": """
select l_orderkey*8+l_linenumber as sr_id, concat('E',lpad(cast(l_suppkey as string),6,'0')) as siebel_id,
 case when l_partkey % 97 = 0 then null else cast(1 + l_partkey % 15 as int) end as severity, o_orderdate as open_date,
 case when l_shipdate >= o_orderdate then l_shipdate end as closed_date,
 cast(l_suppkey % 5 as int) as assoc_manager_id, cast(l_suppkey % 3 as int) as manager_id
from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "project_activities": """
select event_id as id, user_id % 100 as staff_id, ts - interval '9496' day as created_at,
 case event_type when 'click' then 'Activity' when 'view' then 'Time Task' else 'Note' end as record_type
from {events}""",
    "employees": """
select id, first_name, last_name from {staff_master}""",
    "new_hires": """
select c_custkey as id, c_name as req_num, concat('Cand ',cast(c_custkey % 50 as string)) as name,
 case c_custkey % 3 when 0 then 'Driver' when 1 then 'Installer' else 'HR Partner' end as position, c_mktsegment as department,
 case c_custkey % 3 when 0 then 'Open' when 1 then 'Filled' else 'Hold' end as req_status,
 case c_custkey % 2 when 0 then 'Joined' else 'Pending' end as hire_status, concat('Z',cast(c_custkey % 4 as string)) as zone,
 case when c_custkey % 4 = 0 then null else c_custkey % 120 end as old_emp_id,
 case when c_custkey % 11 = 0 then null else c_custkey % 100 end as manager_id
from {customer}""",
    "staff_staging": """
select case when id % 5 = 4 then concat('X', emp_id) else emp_id end as emp_id,
 case when id % 6 = 0 then 'MOVED' else zone end as zone, case when id % 8 = 0 then null else team end as team,
 case when id % 9 = 0 then 'Chief' else title end as title, first_name as firstname, last_name as lastname, mobile
from {staff_master}""",
    "van_allocation_history": """
select van_number, emp_id, start_date,
 cast(lead(start_date) over (partition by van_number order by start_date) - interval '1' day as date) as end_date,
 van_number % 7 <> 6 as is_active
from (select o_custkey % 50 as van_number, cast(o_orderdate as date) as start_date, min(o_orderkey % 100) as emp_id
      from {orders} group by o_custkey % 50, cast(o_orderdate as date)) g""",
    "van_mileage": """
select l_orderkey, l_linenumber, l_suppkey % 60 as van_number, cast(l_shipdate as date) as mileage_date,
 l_quantity as miles, cast(-1 as bigint) as emp_id
from {lineitem}""",
    "project_data": """
select p_partkey as site, p_name, p_brand, case when p_partkey % 10 = 0 then null else p_size end as p_size, p_retailprice
from {part}""",
    "project_metadata": """
select * from (values ('Brand','Brand name','p_brand'),('Size','Part size','p_size'),
 ('Price','Retail price','p_retailprice'),('Ghost','Not a column','p_nope')) m(field_name,field_display_name,column_name)""",
    "project_execution_json": """
select event_id as id, user_id as staff_id, concat('T',lpad(cast(user_id as string),6,'0')) as tech_id,
 case when event_type = 'error' then '[{{"field_name":"other","value":"1"}}]'
      when event_type = 'signup' then '[{{"field_name":"comm_rack_inspection_date","value":null}}]'
      else concat('[{{"field_name":"k","value":"',cast(event_id as string),'"}},{{"field_name":"comm_rack_inspection_date","value":"',
                  substr(cast(ts as string),1,19),'"}}]') end as project_data
from {events}""",
    "site_master": """
select concat('S',lpad(cast(s_suppkey as string),6,'0')) as site, r_name as zone, n_name as state,
 case s_suppkey % 3 when 0 then 'Express' when 1 then 'Super' else 'Depot' end as store_type
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "project_definition": """
select p_partkey as id,
 case when p_partkey % 53 = 7 then 'weekly' when p_partkey % 59 = 8 then cast(null as string)
      else case p_partkey % 5 when 0 then 'one-time' when 1 then 'monthly' when 2 then 'quarterly'
                              when 3 then 'half-yearly' else 'yearly' end end as recurrence,
 case when p_partkey % 97 = 0 then 'Global'
      else case p_partkey % 6 when 0 then 'Zone' when 1 then 'Zone' when 2 then 'State' when 3 then 'Store Type'
                              when 4 then 'Specified Sites' else 'Nowhere' end end as scope,
 case when p_partkey % 6 = 4 and p_partkey % 4 = 0 then ''
      else case p_partkey % 6 when 0 then 'ASIA' when 1 then 'ASIA,EUROPE' when 2 then 'NATION_1, NATION_2,NATION_3'
                              when 3 then 'Express,Depot'
                              when 4 then concat('S',lpad(cast(p_partkey % 120 as string),6,'0'),',S000001,S000001,S999999') end end as scope_data,
 case p_partkey % 3 when 0 then date '2024-01-30' when 1 then date '2024-01-31' else date '2023-12-31' end as start_date,
 date '2024-12-31' as end_date,
 case when p_partkey % 2 = 0 then cast(null as int) else cast(p_partkey % 4 as int) end as cycle_index,
 case when p_partkey % 2 = 0 then cast(null as date) else date '2024-05-01' end as cycle_start_date,
 case when p_partkey % 2 = 0 then cast(null as date)
      else case p_partkey % 3 when 0 then date '2024-05-30' when 1 then date '2024-05-31' else date '2024-02-29' end end as cycle_end_date
from {part}""",
    "project_execution_cycles": """
select id as project_id, 'S000001' as site,
 case when id % 7 = 3 then (case when recurrence = 'one-time' then 1 else coalesce(cycle_index, 0) + 1 end) else 9 end as cycle_index,
 case when id % 2 = 0 then 'pending' else 'done' end as execution_status
from {project_definition}""",
    "fts_job_master": """
select cast(row_number() over (order by event_type) as bigint) as id, event_type as name, {ts} '2024-01-01 00:00:00' as created_at,
 case event_type when 'click' then 15 when 'view' then 2 when 'error' then 1 when 'signup' then 1 else 3 end as interval_value,
 case event_type when 'click' then 'minute' when 'view' then 'hour' when 'error' then 'day' when 'signup' then 'week' else 'month' end as interval_unit
from (select distinct event_type from {events}) e""",
    "job_events": """
select event_id as event_seq, event_type as name, ts as started_at, ts + interval '90' second as ended_at,
 case when event_id % 7 = 0 then 'FAILED' else 'SUCCESS' end as status,
 case when event_id % 7 = 0 then concat('err ',cast(event_id as string)) end as error_message
from {events}""",
    "source_columns": """
select concat('t', cast(l_orderkey as string)) as table_name, concat('c', cast(l_linenumber as string)) as column_name,
 l_linenumber as ordinal_position,
 case l_returnflag when 'R' then 'int8' when 'A' then 'varchar' else 'text' end as data_type,
 case when l_returnflag = 'A' then cast(l_quantity as int) end as max_length,
 case l_linestatus when 'O' then 'YES' else 'NO' end as is_nullable,
 case when l_discount >= 0.08 then 'now()' end as column_default
from {lineitem}""",
    "target_columns": """
select case when l_orderkey % 13 = 0 then concat('x', cast(l_orderkey as string)) else concat('t', cast(l_orderkey as string)) end as table_name,
 case when l_partkey % 7 = 0 then concat('d', cast(l_linenumber as string)) else concat('c', cast(l_linenumber as string)) end as column_name,
 l_linenumber as ordinal_position,
 case when l_suppkey % 5 = 0 then 'text' else case l_returnflag when 'R' then 'int8' when 'A' then 'varchar' else 'text' end end as data_type,
 case when l_suppkey % 4 = 1 then 80 else (case when l_returnflag = 'A' then cast(l_quantity as int) end) end as max_length,
 case when l_suppkey % 6 = 2 then 'YES' else (case l_linestatus when 'O' then 'YES' else 'NO' end) end as is_nullable,
 case when l_suppkey % 9 = 3 then cast(null as string) else (case when l_discount >= 0.08 then 'now()' end) end as column_default
from {lineitem}""",
    "datatype_sheet": """
select p_partkey as row_id, p_type as dev_datatype, case when p_partkey % 5 = 0 then null else p_type end as qa_datatype,
 case when p_partkey % 3 = 0 then 'text' else p_type end as prod_datatype,
 case when p_partkey % 10 = 0 then null else p_type end as staging_datatype
from {part}""",
    "recipients": """
select cast(floor(c_custkey / 40) as bigint) as message_id, c_custkey as position,
 case when c_custkey % 40 < 22 then 'To' when c_custkey % 40 < 33 then 'Cc' else 'Bcc' end as type,
 case c_custkey % 3 when 0 then concat('Last',cast(c_custkey % 11 as string),', First')
                    when 1 then concat('First Last',cast(c_custkey % 11 as string))
                    else concat('Mono',cast(c_custkey % 11 as string)) end as name,
 concat('c',cast(c_custkey as string),'@example.com') as address
from {customer}""",
}

# Staging rows that repeat: some exactly, some with another zone.
RECIPES["staff_staging_repeated"] = """
select * from {staff_staging} union all select * from {staff_staging} where team = 'Team_1'
union all select emp_id, 'AAA' as zone, team, title, firstname, lastname, mobile from {staff_staging} where team = 'Team_2'
union all select emp_id, zone, team, 'Zz' as title, firstname, lastname, mobile from {staff_staging} where team = 'Team_3'"""

# Allocations whose open end is written as the usual last day.
RECIPES["van_allocation_open"] = """
select van_number, emp_id, start_date, coalesce(end_date, date '9999-12-31') as end_date, is_active
from {van_allocation_history}"""

# Mileage and allocations to the second; allocations of a van overlap.
RECIPES["van_mileage_seconds"] = """
select l_orderkey, l_linenumber, van_number, cast(mileage_date as {ts}) + interval '1' second * (l_orderkey * 7919 % 86400) as mileage_ts,
 miles, emp_id
from {van_mileage}"""
RECIPES["van_allocation_seconds"] = """
select van_number, emp_id, cast(start_date as {ts}) + interval '1' second * ((van_number * 3571 + emp_id * 911) % 86400) as start_ts,
 cast(end_date as {ts}) + interval '1' second * (van_number % 4 * 200000 + emp_id * 617 % 86400) as end_ts, is_active
from {van_allocation_history}"""

# Searches of several kinds, one per supplier: parts of numbers and names, wildcards, no text.
RECIPES["search_requests"] = """
select s_suppkey as search_id,
 case s_suppkey % 40 when 0 then '' when 1 then null when 2 then 'DEE' when 3 then '_2_' when 4 then 'nn  zz' when 5 then '%'
 else case s_suppkey % 4 when 0 then concat('#', lpad(cast(s_suppkey % 9 as string), 7, '0'))
                         when 1 then concat('tomer%', cast(s_suppkey as string), ' nobody')
                         when 2 then concat('00', cast(s_suppkey * 7 % 1000 as string), ' last', cast(s_suppkey % 97 as string))
                         else concat(cast(s_suppkey as string), '_ \\#x') end end as search_text,
 case when s_suppkey % 3 = 0 then 'Open' end as pos_status, case when s_suppkey % 8 = 1 then 'Joined' end as join_status,
 case when s_suppkey % 40 < 6 then concat('Z', cast(s_suppkey % 4 as string)) end as zone
from {supplier}"""

# Field JSON that others wrote: forged brands, wrong sizes, a field of no column and one of no metadata.
RECIPES["project_tampered"] = """
select site, p_name, p_brand, p_size, p_retailprice,
 concat('[{{"field_name":"Brand","value":"', case when site % 4 = 0 then 'forged' else p_brand end,
        '"}},{{"field_name":"Size","value":', case when site % 5 = 1 then '-1' when site % 7 = 0 or p_size is null then 'null' else cast(p_size as string) end,
        '}},{{"field_name":"Ghost","value":"x"}},{{"field_name":"Unknown","value":1}}]') as field_info
from {project_data}"""

# Interval units in other spellings, and one that is none.
RECIPES["fts_job_master_spellings"] = """
select id, name, created_at, interval_value,
 case name when 'click' then 'mins' when 'view' then ' Hrs ' when 'error' then 'D' when 'signup' then 'fortnight' else 'mon' end as interval_unit
from {fts_job_master}"""

# Ends of logged runs by log id: some with a NULL status, some twice, some of no run.
RECIPES["job_ends"] = """
select concat(cast(id as string), ':', cast(event_id as string)) as log_id,
 case when event_id % 12 = 0 then null when event_id % 5 = 0 then 'FAILED' else 'SUCCESS' end as status,
 ts + interval '75' second as ended_at, case when event_id % 5 = 0 then 'late' end as error_message
from {events} join {fts_job_master} on event_type = name where event_id % 3 = 0
union all
select concat(cast(id as string), ':', cast(event_id as string)) as log_id, 'SUCCESS' as status,
 ts + interval '95' second as ended_at, cast(null as string) as error_message
from {events} join {fts_job_master} on event_type = name where event_id % 33 = 0
union all
select concat('none:', cast(event_id as string)) as log_id, 'SUCCESS' as status, ts as ended_at, 'lost' as error_message
from {events} where event_id % 100 = 7"""

# A job master created on a month end with calendar units, so slot dates
# clamp to shorter months and month/year slots count 30 / 365.25 days.
RECIPES["fts_job_master_calendar"] = """
select cast(row_number() over (order by event_type) as bigint) as id, event_type as name,
 {ts} '2023-01-31 06:00:00' as created_at,
 case event_type when 'click' then 1 when 'view' then 2 when 'error' then 1 when 'signup' then 3 else 7 end as interval_value,
 case event_type when 'click' then 'month' when 'view' then 'months' when 'error' then 'year' when 'signup' then 'week'
                 else 'day' end as interval_unit
from (select distinct event_type from {events}) e"""

# Execution JSON whose field times fall on the 2024 daylight-saving changes:
# events (January 2024) shifted to cover 2024-03-10 (clocks skip an hour)
# and 2024-11-03 (an hour repeats) in the staff members' zones.
for _suffix, _days in (("spring", 69), ("fall", 307)):
    RECIPES[f"project_execution_json_{_suffix}"] = RECIPES["project_execution_json"].replace(
        "substr(cast(ts as string),1,19)", f"substr(cast(ts + interval '{_days}' day as string),1,19)")

_NAME = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def dependencies(name: str) -> list[str]:
    return [d for d in _NAME.findall(RECIPES[name]) if d != "ts"]


def _closure(names) -> list[str]:
    """Recipes needed for ``names``, in dependency order."""
    out: list[str] = []

    def visit(n):
        if n in RAW_TABLES or n in out:
            return
        for d in dependencies(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def duckdb_with(names) -> str:
    """``WITH`` clause defining the recipes ``names`` (and their inputs) for DuckDB."""
    parts = []
    for n in _closure(names):
        body = RECIPES[n]
        body = _NAME.sub(lambda m: "timestamp" if m.group(1) == "ts" else m.group(1), body)
        body = body.replace("{{", "{").replace("}}", "}").replace("{ts}", "timestamp")
        parts.append(f"{n} AS ({body.strip()})")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


class Fixtures:
    """Lazily built domain tables for one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def dim(self, name: str, max_bytes: int = 8 << 20) -> DataFrame:
        """A dimension, with a broadcast hint if the tables it is made from are
        small by the optimizer's estimate (each of its rows comes from one of
        theirs); no job runs."""
        raw = {r for n in _closure([name]) for r in dependencies(n) if r in RAW_TABLES}
        size = sum(int(self.raw(r)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for r in raw)
        return F.broadcast(self[name]) if size <= max_bytes else self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name in RAW_TABLES:
            return self.raw(name)
        if name not in self._cache:
            args = {d: self[d] for d in dependencies(name)}
            text = RECIPES[name].replace("{ts}", "timestamp_ntz")
            self._cache[name] = self.spark.sql(text, **args)
        return self._cache[name]
