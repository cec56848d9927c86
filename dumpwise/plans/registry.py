"""Registered report queries over the test catalogue, each with a DuckDB oracle.

Every query reads the whole derived catalogue (``sources.fixtures``) of an
``sf_dir`` and runs one report operator on it; its oracle is an independent
SQL formulation over the same Parquet. Times are shown the way the report
sink writes them (text), so both engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from dumpwise.operators import accounting, consistency, datasets, documents, incidents, lookup, replicas
from dumpwise.operators import space_usage as su
from dumpwise.sinks import TS_MILLIS_UTC, TS_SECONDS, render
from dumpwise.sources.fixtures import WINDOW_END, WINDOW_START, FixtureCatalog, duckdb_with

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# How a query gets its catalogue from ``sf_dir``: derived views by default; the benchmark
# swaps in a written dump (``fixtures.DumpCatalog``) to time the reports alone.
CATALOG: Callable[[SparkSession, str], FixtureCatalog] = FixtureCatalog


def register(name: str, oracle: str | None, text_cols: tuple[str, ...] = ()):
    """Register a query and its oracle.

    ``text_cols``: integer columns that may hold NULLs, compared as text on both
    sides (in pandas a nullable integer column is float64 from Spark but Int64
    from DuckDB, so equal values would hash apart), as times are.
    """
    def wrap(fn: Query) -> Query:
        if text_cols:
            def query(spark: SparkSession, sf_dir: str) -> DataFrame:
                df = fn(spark, sf_dir)
                return df.withColumns({c: F.col(c).cast("string") for c in text_cols})
            QUERIES[name] = query
        else:
            QUERIES[name] = fn
        if oracle is not None:
            if text_cols:
                casts = ", ".join(f"cast({c} as varchar) as {c}" for c in text_cols)
                ORACLES[name] = f"select * replace ({casts}) from (\n{oracle}\n) q"
            else:
                ORACLES[name] = oracle
        return fn
    return wrap


def _seconds(col: str) -> str:
    return f"cast(trunc({col} / 1000.0) as bigint)"


def _ts_seconds(col: str) -> str:
    return f"strftime(epoch_ms({col}), '%Y-%m-%d %H:%M:%S')"


def _ts_millis(col: str) -> str:
    return f"(strftime(epoch_ms({col}), '%Y-%m-%dT%H:%M:%S.%g') || 'Z')"


def _det_path(scope: str, name: str) -> str:
    digest = f"md5({scope} || ':' || {name})"
    return (f"('/' || case when {scope} like 'user%' or {scope} like 'group%' then replace({scope}, '.', '/') "
            f"else {scope} end || '/' || substr({digest}, 1, 2) || '/' || substr({digest}, 3, 2) || '/' || {name})")


def _ordered_list(col: str, order: str, rule: str, account: str) -> str:
    return (f"coalesce(string_agg({col}, ',' order by {order} nulls first, {rule} nulls first, "
            f"{account} nulls first), '')")


# --- R6 lost files ---------------------------------------------------------------------------

@register("lost_files", duckdb_with(["rses", "contents_history", "bad_replicas"], f"""
select b.scope as fscope, b.name as fname, h.scope as scope, h.name as name, r.rse as rse,
       b.account as account, {_seconds('b.updated_at')} as updated_at
from bad_replicas b
join contents_history h on b.scope = h.child_scope and b.name = h.child_name
join rses r on b.rse_id = r.id
where b.state = 'L' and h.did_type = 'D'
  and {_seconds('b.created_at')} >= {WINDOW_START} and {_seconds('b.created_at')} < {WINDOW_END}
"""))
def q_lost_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return incidents.lost_files(c.bad_replicas, c.contents_history, c.rses, WINDOW_START, WINDOW_END)


# --- R5 suspicious files ---------------------------------------------------------------------

@register("suspicious_files", duckdb_with(["rses", "rse_protocols", "replicas", "bad_replicas"], f"""
select distinct r.rse as rse, b.scope as scope, b.name as name,
       case when rep.path is null then
         coalesce(p.scheme, 'null') || '://' || coalesce(p.hostname, 'null') || coalesce(p.prefix, 'null')
         || '/' || case when b.scope like 'user%' or b.scope like 'group%' then replace(b.scope, '.', '/') else b.scope end
         || '/' || substr(md5(b.scope || ':' || b.name), 1, 2) || '/' || substr(md5(b.scope || ':' || b.name), 3, 2)
         || '/' || b.name
       end as path
from bad_replicas b
join rse_protocols p on b.rse_id = p.rse_id
join replicas rep on b.scope = rep.scope and b.name = rep.name and b.rse_id = rep.rse_id
join rses r on b.rse_id = r.id
where b.state = 'S' and p.write_lan = '1'
  and {_seconds('b.created_at')} >= {WINDOW_START} and {_seconds('b.created_at')} < {WINDOW_END}
"""))
def q_suspicious_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return incidents.suspicious_files(c.bad_replicas, c.replicas, c.rses, c.rse_protocols, WINDOW_START, WINDOW_END)


# --- R4 replicas per storage element ---------------------------------------------------------

@register("replicas_per_rse", duckdb_with(["rses", "replicas"], f"""
select r.rse as rse, p.scope as scope, p.name as name, p.adler32 as adler32, p.bytes as bytes,
       {_ts_seconds('p.created_at')} as created_at,
       coalesce(p.path, {_det_path('p.scope', 'p.name')}) as path,
       {_ts_seconds('p.updated_at')} as updated_at, p.state as state,
       {_ts_seconds('p.accessed_at')} as accessed_at, {_ts_seconds('p.tombstone')} as tombstone,
       coalesce(c.copies, 0) as copies
from replicas p
join rses r on p.rse_id = r.id
left join (select scope, name, count(*) as copies from replicas where state = 'A' group by scope, name) c
  on p.scope = c.scope and p.name = c.name
"""), text_cols=('bytes',))
def q_replicas_per_rse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return render(replicas.replicas_per_rse(c.replicas, c.rses), TS_SECONDS)


# --- R1 / R2 dataset consistency -------------------------------------------------------------

@register("consistency_datasets", duckdb_with(["rses", "dslocks", "dids"], f"""
select g.rse as rse, g.scope as scope, g.name as name, g.accounts as accounts, coalesce(d.bytes, 0) as bytes,
       g.created_at as created_at, g.accessed_at as accessed_at, g.rule_ids as rule_ids, n.n as "count",
       g.updated_at as updated_at
from (
  select r.rse, l.scope, l.name,
         {_ordered_list('l.account', 'l.created_at', 'l.rule_id', 'l.account')} as accounts,
         {_ordered_list('l.rule_id', 'l.created_at', 'l.rule_id', 'l.account')} as rule_ids,
         min(l.created_at) as created_at, max(l.accessed_at) as accessed_at, max(l.updated_at) as updated_at
  from dslocks l join rses r on l.rse_id = r.id
  where l.state = 'O'
  group by r.rse, l.scope, l.name
) g
join dids d on g.scope = d.scope and g.name = d.name
join (
  select scope, name, count(*) as n
  from (select distinct l.scope, l.name, r.rse from dslocks l join rses r on l.rse_id = r.id where l.state = 'O')
  group by scope, name
) n on g.scope = n.scope and g.name = n.name
"""), text_cols=('accessed_at',))
def q_consistency_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return consistency.consistency_datasets(c.dslocks, c.rses, c.dids)


@register("consistency_datasets_full", duckdb_with(["rses", "dslocks"], """
select r.rse as rse, l.scope as scope, l.name as name
from dslocks l join rses r on l.rse_id = r.id
where l.state = 'O' and l.name not like '%_dis%' and l.name not like '%_sub%'
"""))
def q_consistency_datasets_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return consistency.consistency_datasets_full(c.dslocks, c.rses)


# --- R3 datasets per storage element ---------------------------------------------------------

@register("datasets_per_rse", duckdb_with(["rses", "dslocks", "collection_replicas"], f"""
select r.rse as rse, c.scope as scope, c.name as name,
       case when {_ordered_list('l.account', 'l.created_at', 'l.rule_id', 'l.account')} = '' then 'None'
            else {_ordered_list('l.account', 'l.created_at', 'l.rule_id', 'l.account')} end as account,
       coalesce(max(c.available_bytes), 0) as bytes,
       {_ts_millis('min(c.created_at)')} as created_at,
       {_ts_millis('max(c.updated_at)')} as updated_at,
       {_ts_millis('max(c.accessed_at)')} as accessed_at,
       {_ordered_list('l.rule_id', 'l.created_at', 'l.rule_id', 'l.account')} as rule_id,
       max(c.state) as state
from collection_replicas c
left join dslocks l on c.scope = l.scope and c.name = l.name and c.rse_id = l.rse_id
join rses r on c.rse_id = r.id
where c.did_type = 'D'
group by r.rse, c.scope, c.name
"""))
def q_datasets_per_rse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return render(datasets.datasets_per_rse(c.collection_replicas, c.dslocks, c.rses), TS_MILLIS_UTC)


# --- R7 global accounting --------------------------------------------------------------------
# The oracles state the rules in SQL's own terms: attributes by filtered maxima, one owner per file
# from its parents, and one pass of FILTER aggregates over the storage classes.

_SQL_ACCOUNTED = """
attributes as (
  select r.id, r.rse, r.rse_type,
         greatest(max(m.value) filter (m.key = 'type'), max('-2') filter (m.key = 'tier')) as type,
         greatest(max(m.value) filter (m.key = 'tier'), max('-2') filter (m.key = 'type')) as tier
  from rses r join rse_metadata m on r.id = m.rse_id
  where m.key in ('type', 'tier')
  group by all
),
accounted as (
  select id, rse, rse_type, tier from attributes
  where (type = 'DATADISK' and tier <> '3') or rse = 'CERN-PROD_TZDISK' or rse_type = 'TAPE'
)"""

_SQL_CLASSIFIED = """
classified as (
  select p.scope, p.name, coalesce(p.bytes, 0) as bytes, a.rse,
         case when p.tombstone is null then 'primary' else 'secondary' end as type,
         a.rse_type, a.tier, coalesce(p.accessed_at, 0) as accessed_at
  from replicas p join accounted a on p.rse_id = a.id
)"""

_SQL_OWNED = """
parents as (
  select child_scope, child_name, coalesce(scope, 'no_scope') as s, coalesce(name, 'no_name') as n
  from contents where did_type = 'D' and child_type = 'F'
),
owners as (
  select child_scope, child_name, min({'key': s || ':' || n, 's': s, 'n': n}) filter (s <> 'panda') as o
  from parents group by child_scope, child_name
),
owned as (
  select c.scope as fscope, c.name as fname, c.rse, any_value(coalesce(w.o.s, 'no_scope')) as dscope,
         any_value(coalesce(w.o.n, 'no_name')) as dname, max(c.bytes) as bytes, max(c.type) as type,
         max(c.rse_type) as rse_type, max(c.tier) as tier, max(c.accessed_at) as accessed_at
  from classified c left join owners w on c.scope = w.child_scope and c.name = w.child_name
  where w.child_scope is null or w.o is not null
  group by c.scope, c.name, c.rse
)"""


# Written out, not taken from the operator: storage classes and their conditions.
_SQL_CLASSES = {
    "prim_t0": "rse_type = 'DISK' and tier = '0' and type = 'primary'",
    "prim_t1": "rse_type = 'DISK' and tier = '1' and type = 'primary'",
    "prim_t2": "rse_type = 'DISK' and tier = '2' and type = 'primary'",
    "secs_t0": "rse_type = 'DISK' and tier = '0' and type = 'secondary'",
    "secs_t1": "rse_type = 'DISK' and tier = '1' and type = 'secondary'",
    "secs_t2": "rse_type = 'DISK' and tier = '2' and type = 'secondary'",
    "tape_t0": "rse_type = 'TAPE' and tier = '0'",
    "tape_t1": "rse_type = 'TAPE' and tier = '1'",
}


def _sql_usage() -> str:
    cols, any_class = [], []
    for short, cond in _SQL_CLASSES.items():
        any_class.append(f"({cond})")
        for name, extra in (("", ""), ("accessed_", " and accessed_at is not null")):
            cols.append(f"count(fname) filter ({cond}{extra}) as {short}_{name}files")
            cols.append(f"cast(coalesce(sum(bytes) filter ({cond}{extra}), 0) as bigint) as {short}_{name}bytes")
    return (f"usage as (\n  select dscope, dname, max(accessed_at) as accessed_at, {', '.join(cols)}\n"
            f"  from owned where {' or '.join(any_class)} group by dscope, dname\n)")


def _sql_factors() -> str:
    cols = ["u.dscope as scope", "u.dname as name",
            "case when d.scope is null then null "
            "when (case when u.accessed_at > d.accessed_at then u.accessed_at else d.accessed_at end) > 0 "
            "then (case when u.accessed_at > d.accessed_at then u.accessed_at else d.accessed_at end) end "
            "as accessed_at",
            "d.created_at as created_at", "coalesce(d.length, 0) as length", "coalesce(d.bytes, 0) as bytes"]
    for measure in ("files", "accessed_files", "bytes", "accessed_bytes"):
        for short in _SQL_CLASSES:
            cols.append(f"u.{short}_{measure} as {accounting._report_name(short, measure)}")
    for short in _SQL_CLASSES:
        cols.append(f"case when d.length is null or d.length = 0 then null else u.{short}_files / d.length end "
                    f"as {accounting._report_name(short, 'repl_factor')}")
    cols += [f"d.{m} as {m}" for m in accounting.METADATA] + ["coalesce(d.events, 0) as events"]
    return f"""
factors as (
  select {', '.join(cols)}
  from usage u left join (
    select scope, name, coalesce(length, 0) as length, coalesce(bytes, 0) as bytes,
           {', '.join(accounting.METADATA)}, coalesce(events, 0) as events, created_at,
           coalesce(accessed_at, 0) as accessed_at
    from dids
  ) d on u.dscope = d.scope and u.dname = d.name
)"""


_ACC_VIEWS = ["rses", "rse_metadata", "replicas", "contents", "dids"]


def _acc_oracle(steps: list[str], body: str) -> str:
    return duckdb_with(_ACC_VIEWS, ", " + ",".join(steps) + "\n" + body)


@register("accounted_rses", duckdb_with(["rses", "rse_metadata"], f", {_SQL_ACCOUNTED}\nselect * from accounted"))
def q_accounted_rses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return accounting.accounted_rses(c.rses, c.rse_metadata)


@register("classified_replicas", _acc_oracle([_SQL_ACCOUNTED, _SQL_CLASSIFIED], "select * from classified"))
def q_classified_replicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return accounting.prepared_replicas(c.replicas, c.rses, c.rse_metadata)[0]


@register("attribute_to_dataset", _acc_oracle([_SQL_ACCOUNTED, _SQL_CLASSIFIED, _SQL_OWNED], "select * from owned"))
def q_attribute_to_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    classified, unique = accounting.prepared_replicas(c.replicas, c.rses, c.rse_metadata)
    return accounting.attribute_to_dataset(classified, c.contents, unique)


@register("storage_class_usage",
          _acc_oracle([_SQL_ACCOUNTED, _SQL_CLASSIFIED, _SQL_OWNED, _sql_usage()], "select * from usage"))
def q_storage_class_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    classified, unique = accounting.prepared_replicas(c.replicas, c.rses, c.rse_metadata)
    return accounting.storage_class_usage(accounting.attribute_to_dataset(classified, c.contents, unique))


_GLOBAL_ORACLE = _acc_oracle([_SQL_ACCOUNTED, _SQL_CLASSIFIED, _SQL_OWNED, _sql_usage(), _sql_factors()],
                             "select * from factors")


@register("replication_factors", _GLOBAL_ORACLE, text_cols=('accessed_at', 'created_at'))
def q_replication_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    classified, unique = accounting.prepared_replicas(c.replicas, c.rses, c.rse_metadata)
    owned = accounting.attribute_to_dataset(classified, c.contents, unique)
    return accounting.replication_factors(accounting.storage_class_usage(owned), c.dids)


@register("global_accounting", _GLOBAL_ORACLE, text_cols=('accessed_at', 'created_at'))
def q_global_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return accounting.global_accounting(c.replicas, c.rses, c.rse_metadata, c.contents, c.dids)


# --- R8 accounting documents -----------------------------------------------------------------

# The report date stamped on the test documents.
REPORT_DATE = "2026-12-01"


# Project and datatype prefixes that are their own label.
_PROJECT_PREFIXES = "^(user|archive|data07|sit|group|cond)"
_DATATYPE_PREFIXES = "^(DAOD|HIST|DESD|DPD|RDO|NTUP|DNTUP|D2ESD|D2AOD)"


def _sql_grouped(project: str, datatype: str) -> str:
    """The grouped datatype by precedence: project labels, then the datatype's prefix, then its RAW ending."""
    return f"""case
      when {project} in ('transient', 'panda', 'hc_test') then {project}
      when regexp_matches({project}, '{_PROJECT_PREFIXES}') then regexp_extract({project}, '{_PROJECT_PREFIXES}')
      when regexp_matches({datatype}, '{_DATATYPE_PREFIXES}') then regexp_extract({datatype}, '{_DATATYPE_PREFIXES}')
      when {datatype} like 'DRAW%' or {datatype} like '%RAW' then 'RAW'
      else coalesce({datatype}, 'no_name') end"""


def _sql_documents() -> str:
    from dumpwise.operators.documents import FACTOR_ROLLUPS, ROLLUPS
    cols = ["f.*"]
    for measures in (("files", "accessed_files"), ("bytes", "accessed_bytes")):
        for group, parts in ROLLUPS.items():
            for m in measures:
                cols.append(" + ".join(f"{k}_{m}_{t}" for k, t in parts) + f" as {group}_{m}")
    for group in FACTOR_ROLLUPS:
        cols.append(" + ".join(f"{k}_repl_factor_{t}" for k, t in ROLLUPS[group]) + f" as {group}_repl_factor")
    cols.append(f"'{REPORT_DATE}' as timestamp")
    cols.append(f"upper(sha1('{REPORT_DATE}' || '_' || coalesce(scope, 'null') || '_' || coalesce(name, 'null')))"
                " as id")
    cols.append(f"{_sql_grouped('project', 'datatype')} as datatype_grouped")
    return f"select {', '.join(cols)} from factors f"


@register("accounting_documents",
          _acc_oracle([_SQL_ACCOUNTED, _SQL_CLASSIFIED, _SQL_OWNED, _sql_usage(), _sql_factors()], _sql_documents()),
          text_cols=('accessed_at', 'created_at'))
def q_accounting_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    report = accounting.global_accounting(c.replicas, c.rses, c.rse_metadata, c.contents, c.dids)
    return documents.accounting_documents(report, REPORT_DATE)



# --- R10 / R11 report lookup -----------------------------------------------------------------
# The dated report table: the replica inventory, each row stamped with the day of its last
# update (reports of many dates and elements, as a report directory holds them).

AS_OF = "1998-06-30"
SLICE_DATE = "1997-03-15"


def _dated_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    inv = replicas.replicas_per_rse(c.replicas, c.rses)
    return render(inv.withColumn("date", F.date_format("updated_at", "yyyy-MM-dd")), TS_SECONDS)


_SQL_DATED = f"""
dated as (
  select r.rse as rse, p.scope as scope, p.name as name, p.adler32 as adler32, p.bytes as bytes,
         {_ts_seconds('p.created_at')} as created_at,
         coalesce(p.path, {_det_path('p.scope', 'p.name')}) as path,
         {_ts_seconds('p.updated_at')} as updated_at, p.state as state,
         {_ts_seconds('p.accessed_at')} as accessed_at, {_ts_seconds('p.tombstone')} as tombstone,
         coalesce(c.copies, 0) as copies, strftime(epoch_ms(p.updated_at), '%Y-%m-%d') as date
  from replicas p
  join rses r on p.rse_id = r.id
  left join (select scope, name, count(*) as copies from replicas where state = 'A' group by scope, name) c
    on p.scope = c.scope and p.name = c.name
)"""


@register("latest_reports", duckdb_with(["rses", "replicas"], f""", {_SQL_DATED}
select d.* from dated d
join (select rse, max(date) as newest from dated
      where cast(date as date) between date '{AS_OF}' - interval 13 day and date '{AS_OF}' group by rse) n
  on d.rse = n.rse and d.date = n.newest
"""), text_cols=('bytes',))
def q_latest_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.latest_reports(_dated_inventory(spark, sf_dir), AS_OF)


@register("latest_reports_of_element", duckdb_with(["rses", "replicas"], f""", {_SQL_DATED}
select * from dated where rse = 'RSE_3' and date = (
  select max(date) from dated where rse = 'RSE_3'
  and cast(date as date) between date '{AS_OF}' - interval 13 day and date '{AS_OF}')
"""), text_cols=('bytes',))
def q_latest_reports_of_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.latest_reports(_dated_inventory(spark, sf_dir), AS_OF, rse="RSE_3")


@register("report_slice", duckdb_with(["rses", "replicas"], f""", {_SQL_DATED}
select * from dated where date = '{SLICE_DATE}'
"""), text_cols=('bytes',))
def q_report_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.report_slice(_dated_inventory(spark, sf_dir), SLICE_DATE)


# Whole reports by date: lost files stamped with the day of their last update, and the full
# listing stamped with the day of the lock.

def _dated_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    lost = incidents.lost_files(c.bad_replicas, c.contents_history, c.rses, WINDOW_START, WINDOW_END)
    return lost.withColumn("date", F.date_format(F.timestamp_seconds("updated_at"), "yyyy-MM-dd"))


_SQL_DATED_LOST = f"""
lost as (
  select b.scope as fscope, b.name as fname, h.scope as scope, h.name as name, r.rse as rse, b.account as account,
         {_seconds('b.updated_at')} as updated_at
  from bad_replicas b
  join contents_history h on b.scope = h.child_scope and b.name = h.child_name and h.did_type = 'D'
  join rses r on b.rse_id = r.id
  where b.state = 'L' and {_seconds('b.created_at')} >= {WINDOW_START} and {_seconds('b.created_at')} < {WINDOW_END}
),
dated as (select *, strftime(make_timestamp(updated_at * 1000000), '%Y-%m-%d') as date from lost)"""
LOST_AS_OF = "1996-07-01"


@register("latest_lost_files", duckdb_with(["rses", "contents_history", "bad_replicas"], f""", {_SQL_DATED_LOST}
select * from dated where date = (
  select max(date) from dated
  where cast(date as date) between date '{LOST_AS_OF}' - interval 13 day and date '{LOST_AS_OF}')
"""))
def q_latest_lost_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.latest_reports(_dated_lost(spark, sf_dir), LOST_AS_OF, rse_col=None)


def _dated_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full listing, a name's rows dated by a day that its text decides (many dates, several rows each)."""
    c = CATALOG(spark, sf_dir)
    full = consistency.consistency_datasets_full(c.dslocks, c.rses)
    return full.withColumn("date", F.concat(F.lit("1998-06-"), F.lpad((F.length("name") + 10).cast("string"), 2, "0")))


_SQL_DATED_LISTING = """
dated as (
  select r.rse as rse, l.scope as scope, l.name as name,
         '1998-06-' || lpad(cast(length(l.name) + 10 as varchar), 2, '0') as date
  from dslocks l join rses r on l.rse_id = r.id
  where l.state = 'O' and l.name not like '%_dis%' and l.name not like '%_sub%'
)"""


@register("latest_full_listing", duckdb_with(["rses", "dslocks"], f""", {_SQL_DATED_LISTING}
select * from dated where date = (select max(date) from dated
  where cast(date as date) between date '{AS_OF}' - interval 13 day and date '{AS_OF}')
"""))
def q_latest_full_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = _dated_inventory(spark, sf_dir)
    return lookup.latest_reports(inventory, AS_OF, rse="*", full=_dated_listing(spark, sf_dir))


@register("full_listing_slice", duckdb_with(["rses", "dslocks"], f""", {_SQL_DATED_LISTING}
select * from dated where date = (select min(date) from dated)
"""))
def q_full_listing_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = _dated_listing(spark, sf_dir)
    first = listing.agg(F.min("date")).first()[0] or SLICE_DATE
    return lookup.report_slice(_dated_inventory(spark, sf_dir), first, rse="*", full=listing)


# --- R12 / R13 site space usage --------------------------------------------------------------

_SQL_TOKENS = r"""
docs as (select doc_id, text, json_valid(text) as ok from space_reports),
pairs as (
  select doc_id, unnest(json_keys(text)) as token, unnest(json_extract(text, '$.*')) as v,
         unnest(range(len(json_keys(text)))) as nth
  from docs where ok and json_type(text) = 'OBJECT'
),
entries as (select doc_id, token, arg_max(v, nth) as v from pairs group by doc_id, token),
objs as (select * from entries where regexp_full_match(token, '^([A-Z0-9]+([_-][A-Z0-9]+)*)$') and json_type(v) = 'OBJECT')"""


def _sql_long(path: str) -> str:
    """The integer at ``path`` if 64 bits hold it."""
    return (f"coalesce(try_cast(json_extract_string(v, '{path}') as bigint), "
            f"try_cast(cast(json_extract(v, '{path}') as double) as bigint))")


def _sql_is_int(path: str) -> str:
    t = f"json_type(v, '{path}')"
    return (f"({t} in ('BIGINT', 'UBIGINT') or ({t} = 'DOUBLE' and "
            f"floor(cast(json_extract(v, '{path}') as double)) = cast(json_extract(v, '{path}') as double)))")


def _sql_items_strings(path: str) -> str:
    return (f"(len(list_filter(cast(json_extract(v, '{path}') as json[]), lambda x: coalesce(json_type(x), 'NULL') <> 'VARCHAR')) = 0)")


# Written out, not taken from the operator's schema.
_STRINGS = ("status", "status_message")
_INTEGERS = ("total_space", "used_space", "num_files", "time_stamp")
_FIELDS = ("status", "status_message", "total_space", "used_space", "num_files", "time_stamp", "list_of_paths")


def _sql_space_usage() -> str:
    cols = ["doc_id", "token"]
    for f in _FIELDS:
        p = f"$.{f}"
        if f in _STRINGS:
            cols.append(f"case when json_type(v, '{p}') = 'VARCHAR' then json_extract_string(v, '{p}') end as {f}")
        elif f in _INTEGERS:
            cols.append(f"case when {_sql_is_int(p)} then {_sql_long(p)} end as {f}")
        else:
            cols.append(f"case when json_type(v, '{p}') = 'ARRAY' and {_sql_items_strings(p)} "
                        f"then cast(json_extract(v, '{p}') as varchar) end as {f}")
    return duckdb_with(["space_reports"], f", {_SQL_TOKENS}\nselect {', '.join(cols)} from objs")


def _sql_violations() -> str:
    parts = [
        "select doc_id, cast(null as varchar) as token, 'invalid_json' as rule from docs where not ok",
        "select doc_id, null, 'root_not_object' from docs where ok and json_type(text) <> 'OBJECT'",
        "select doc_id, token, 'bad_token_name' from entries "
        "where not regexp_full_match(token, '^([A-Z0-9]+([_-][A-Z0-9]+)*)$')",
        "select doc_id, token, 'value_not_object' from entries "
        "where regexp_full_match(token, '^([A-Z0-9]+([_-][A-Z0-9]+)*)$') and json_type(v) <> 'OBJECT'",
    ]
    for f in _FIELDS:
        if f == "num_files":
            continue  # optional
        parts.append(f"select doc_id, token, 'missing_{f}' from objs where json_type(v, '$.{f}') is null")
    for f in _FIELDS:
        p = f"$.{f}"
        ok = (f"json_type(v, '{p}') = 'VARCHAR'" if f in _STRINGS else
              _sql_is_int(p) if f in _INTEGERS else f"json_type(v, '{p}') = 'ARRAY'")
        parts.append(f"select doc_id, token, 'type_{f}' from objs where json_type(v, '{p}') is not null and not ({ok})")
        if f in _INTEGERS:
            parts.append(f"select doc_id, token, 'range_{f}' from objs where {ok} and {_sql_long(p)} is null")
    parts.append("select doc_id, token, 'enum_status' from objs where json_type(v, '$.status') is not null and "
                 "not coalesce(json_type(v, '$.status') = 'VARCHAR' and "
                 "json_extract_string(v, '$.status') in ('online', 'offline'), false)")
    parts.append(f"select doc_id, token, 'item_type_list_of_paths' from objs where "
                 f"json_type(v, '$.list_of_paths') = 'ARRAY' and not {_sql_items_strings('$.list_of_paths')}")
    return duckdb_with(["space_reports"], f", {_SQL_TOKENS}\n" + "\nunion all\n".join(parts))


@register("space_usage", _sql_space_usage(), text_cols=('total_space', 'used_space', 'num_files', 'time_stamp'))
def q_space_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    rows = su.space_usage(c["space_reports"])
    return rows.withColumn("list_of_paths", F.to_json("list_of_paths"))


@register("space_usage_violations", _sql_violations())
def q_space_usage_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = CATALOG(spark, sf_dir)
    return su.space_usage_violations(c["space_reports"])
