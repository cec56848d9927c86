"""Catalogue tables derived from the driver's TPC-H-like Parquet (test data).

The reference ships no data, so its ten input tables are views over
``lineitem`` and ``supplier``. One SQL text serves both engines: Spark runs it
with the Parquet frames bound as parameters, the DuckDB oracle inlines it as
CTEs. ``@MS@`` is the ship date as epoch ms, ``@FS@ @FN@`` name a file and
``@DS@ @DN@`` a dataset.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from dumpwise.session import prepare
from dumpwise.sources.catalog import SCHEMAS, conform

_MACROS = {
    "@FS@": "case when l_partkey%7=0 then 'user.u'||cast(l_partkey%3 as string)||'.x' "
            "when l_partkey%7=1 then 'group.g1' else 'mc16_13TeV' end",
    "@FN@": "'f'||cast(l_partkey as string)",
    "@DS@": "case when l_orderkey%6=0 then 'panda' when l_orderkey%6=1 then 'user.u1.y' "
            "when l_orderkey%6=2 then 'data18_13TeV' else 'mc16_13TeV' end",
    "@DN@": "'ds'||cast(l_orderkey as string)||case when l_orderkey%10=0 then '_dis1' "
            "when l_orderkey%10=1 then '_sub1' else '' end",
}
_MS = {"spark": "unix_millis(cast(l_shipdate as timestamp))", "duckdb": "epoch_ms(l_shipdate)"}

VIEWS: dict[str, str] = {
    "rses": """
select cast(s_suppkey as string) as id,
       case when s_suppkey=5 then 'CERN-PROD_TZDISK' else 'RSE_'||cast(s_suppkey as string) end as rse,
       case when s_suppkey%4=0 then 'TAPE' else 'DISK' end as rse_type
from {supplier}""",
    "rse_metadata": """
select cast(s_suppkey as string) as rse_id, 'type' as key,
       case when s_suppkey%4=0 then 'DATATAPE' when s_suppkey%5=0 then 'SCRATCHDISK' else 'DATADISK' end as value
from {supplier}
union all
select cast(s_suppkey as string), 'tier', cast((s_suppkey+s_nationkey)%4 as string) from {supplier} where s_suppkey%9<>8""",
    "rse_protocols": """
select cast(s_suppkey as string) as rse_id, case when k=0 then 'root' else 'davs' end as scheme,
       'h'||cast(s_suppkey as string)||'.site.org' as hostname, '/data'||cast(k as string) as prefix,
       case when k=1 and s_suppkey%3=0 then '0' else '1' end as write_lan
from {supplier}, (values (0),(1)) t(k) where k=0 or s_suppkey%2=0""",
    "replicas": """
select @FS@ as scope, @FN@ as name, cast(l_suppkey as string) as rse_id,
       case when l_partkey%11=0 then null else l_partkey*1000 end as bytes,
       substr(md5(cast(l_partkey as string)),1,8) as adler32,
       case when (l_partkey+l_suppkey)%5=0 then '/nondet/'||cast(l_partkey as string) end as path,
       case when min(l_returnflag)='N' then 'U' else 'A' end as state,
       min(@MS@) as created_at, max(@MS@) as updated_at,
       case when min(l_returnflag)='A' then max(@MS@) end as accessed_at,
       case when max(l_linestatus)='O' then max(@MS@) end as tombstone
from {lineitem} group by l_partkey, l_suppkey""",
    "contents": """
select distinct @DS@ as scope, @DN@ as name, 'D' as did_type, @FS@ as child_scope, @FN@ as child_name,
       case when l_linenumber=7 then 'D' else 'F' end as child_type
from {lineitem} where l_returnflag<>'R' and l_partkey%31<>0 and (l_partkey%37<>0 or l_orderkey%6=0)""",
    "contents_history": """
select distinct @DS@ as scope, @DN@ as name, case when l_linenumber=1 then 'C' else 'D' end as did_type,
       @FS@ as child_scope, @FN@ as child_name
from {lineitem}""",
    "bad_replicas": """
select @FS@ as scope, @FN@ as name, cast(l_suppkey as string) as rse_id,
       case when l_linestatus='F' then 'L' else 'S' end as state, 'acc'||cast(l_linenumber as string) as account,
       @MS@ as created_at, @MS@+1000*l_linenumber as updated_at
from {lineitem} where l_returnflag='R'""",
    "dslocks": """
select @DS@ as scope, @DN@ as name, cast(l_suppkey as string) as rse_id, 'acc'||cast(l_linenumber as string) as account,
       case when l_returnflag='R' then 'S' else 'O' end as state, l_partkey*1000 as bytes, @MS@+l_partkey as created_at,
       case when l_linenumber%2=0 then @MS@ end as accessed_at,
       md5(cast(l_orderkey as string)||'_'||cast(l_partkey as string)||'_'||cast(l_suppkey as string)||'_'||cast(l_linenumber as string)) as rule_id,
       @MS@+2 as updated_at
from {lineitem} where l_linenumber<=4""",
    "collection_replicas": """
select @DS@ as scope, @DN@ as name, cast(l_suppkey as string) as rse_id,
       case when l_orderkey%8=7 then 'C' else 'D' end as did_type,
       case when l_orderkey%13=0 then null else cast(sum(l_partkey*1000) as bigint) end as available_bytes,
       case when min(l_returnflag)='A' then 'A' else 'U' end as state, min(@MS@) as created_at,
       max(case when l_linenumber%2=0 then @MS@ end) as accessed_at, max(@MS@) as updated_at
from {lineitem} group by l_orderkey, l_suppkey""",
    "dids": """
select @DS@ as scope, @DN@ as name,
       case when l_orderkey%19=0 then 0 when l_orderkey%29=0 then null else count(*) end as length,
       case when l_orderkey%13=0 then null else cast(sum(l_partkey*1000) as bigint) end as bytes,
       case when l_orderkey%5=0 then null else count(*)*100 end as events,
       case l_orderkey%14 when 1 then 'DAOD_PHYS' when 2 then 'HIST_X' when 3 then 'DESD_A' when 4 then 'DPD_1'
            when 5 then 'RDO_2' when 6 then 'NTUP_3' when 7 then 'DRAW_Z' when 8 then 'DNTUP_4' when 9 then 'D2ESD_5'
            when 10 then 'D2AOD_6' when 11 then 'CALIB_RAW' when 12 then 'AOD' when 13 then 'EVNT' end as datatype,
       'merge' as prod_step, cast(l_orderkey as string) as run_number,
       case l_orderkey%23 when 0 then null when 1 then 'panda' when 2 then 'user.a' when 3 then 'archive1'
            when 4 then 'data07x' when 5 then 'sit1' when 6 then 'hc_test' when 7 then 'group.b' when 8 then 'cond_c'
            when 9 then 'transient' else 'mc16_13TeV' end as project,
       'physics' as stream_name, 'v1' as version, 'c'||cast(l_orderkey%3 as string) as campaign,
       min(@MS@) as created_at, case when l_orderkey%3=0 then null else max(@MS@) end as accessed_at
from {lineitem} where l_orderkey%17<>0 group by l_orderkey""",
    # Site space-usage documents, one per supplier; suppkey % 26 picks a broken variant (15..25 and 0 are valid).
    "space_reports": """
select s_suppkey as doc_id,
       case s_suppkey % 26
         when 1 then '{bad ' || k
         when 2 then '[' || k || ']'
         when 3 then '{"site' || k || '": {' || st || ', ' || msg || ', ' || tot || ', ' || used || ', ' || ts || ', ' || paths || '}, "A__B": {}, "_A": 1}'
         when 4 then '{"SITE' || k || '": ' || k || '}'
         when 5 then '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', ' || tot || ', ' || used || ', ' || nf || ', ' || paths || '}}'
         when 6 then '{"SITE' || k || '_DATADISK": {"status": "down", ' || msg || ', ' || tot || ', ' || used || ', ' || ts || ', ' || paths || '}}'
         when 7 then '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', "total_space": "5", ' || used || ', ' || ts || ', ' || paths || '}}'
         when 8 then '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', "total_space": 1.5, ' || used || ', ' || ts || ', ' || paths || '}}'
         when 9 then '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', "total_space": 1.0, "used_space": 1e3, "num_files": -1, "extra": true, ' || ts || ', "list_of_paths": []}}'
         when 10 then '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', ' || tot || ', ' || used || ', ' || ts || ', "list_of_paths": "x"}}'
         when 11 then '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', ' || tot || ', ' || used || ', ' || ts || ', "list_of_paths": ["x", 1]}}'
         when 12 then '{"SITE' || k || '_DATADISK": {"status": 5, "total_space": true, ' || used || ', "time_stamp": null, "list_of_paths": [null]}}'
         when 13 then '{"SITE' || k || '_DATADISK": {"status": "down"}, "SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', ' || tot || ', ' || used || ', ' || ts || ', ' || paths || '}}'
         when 14 then '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', "total_space": 99999999999999999999, "used_space": 9223372036854775807, "num_files": 9223372036854775808, ' || ts || ', ' || paths || '}}'
         else '{"SITE' || k || '_DATADISK": {' || st || ', ' || msg || ', ' || tot || ', ' || used || ', ' || nf || ', ' || ts || ', ' || paths || '}, '
              || '"SITE' || k || '-SCRATCHDISK": {' || st || ', ' || msg || ', ' || tot || ', ' || used || ', ' || ts || ', ' || paths || '}}'
       end as text
from (
  select s_suppkey, cast(s_suppkey as string) as k,
         '"status": "' || case when s_nationkey % 3 = 0 then 'offline' else 'online' end || '"' as st,
         '"status_message": "report ' || cast(s_suppkey as string) || '"' as msg,
         '"total_space": ' || cast(s_suppkey * 1000000 as string) as tot,
         '"used_space": ' || cast(s_suppkey * 1000 + s_nationkey as string) as used,
         '"num_files": ' || cast(s_nationkey * 10 as string) as nf,
         '"time_stamp": ' || cast(1447936989 + s_suppkey as string) as ts,
         '"list_of_paths": ["/data/' || cast(s_suppkey as string) || '/", "/scratch/' || cast(s_nationkey as string) || '/"]' as paths
  from {supplier}
) s""",
}

# The incident window used by the test queries (seconds), 1996-01-01 to 1997-01-01.
WINDOW_START = 820454400
WINDOW_END = 852076800


def view_sql(view: str, dialect: str) -> str:
    """The view text for ``spark`` (``{table}`` parameters) or ``duckdb`` (plain table names)."""
    text = VIEWS[view]
    for macro, expr in _MACROS.items():
        text = text.replace(macro, expr)
    text = text.replace("@MS@", _MS[dialect])
    if dialect == "spark":
        # Literal braces (JSON text) must not read as frame parameters.
        text = text.replace("{", "{{").replace("}", "}}")
        text = text.replace("{{lineitem}}", "{lineitem}").replace("{{supplier}}", "{supplier}")
    if dialect == "duckdb":
        text = text.replace("{lineitem}", "lineitem").replace("{supplier}", "supplier")
    return text.strip()


def duckdb_with(views: list[str], body: str) -> str:
    """A DuckDB statement that defines the given views as CTEs, then runs ``body``."""
    ctes = ",\n".join(f"{v} as (\n{view_sql(v, 'duckdb')}\n)" for v in views)
    return f"with {ctes}\n{body.strip()}"


class FixtureCatalog:
    """Lazy catalogue views over ``<sf_dir>/{lineitem,supplier}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)  # epoch conversions of the ship date assume UTC
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/lineitem.parquet")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/supplier.parquet")

    def __getitem__(self, view: str) -> DataFrame:
        if view not in self._cache:
            text = view_sql(view, "spark")
            params = {}
            if "{lineitem}" in text:
                params["lineitem"] = self.lineitem
            if "{supplier}" in text:
                params["supplier"] = self.supplier
            df = self.spark.sql(text, **params)
            self._cache[view] = conform(df, view) if view in SCHEMAS else df
        return self._cache[view]

    def __getattr__(self, view: str) -> DataFrame:
        if view in SCHEMAS:
            return self[view]
        raise AttributeError(view)


def materialize(spark: SparkSession, sf_dir: str, dump_dir: str) -> list[str]:
    """Write every derived view as a Parquet table ``<dump_dir>/<view>`` (a daily dump)."""
    catalog = FixtureCatalog(spark, sf_dir)
    for view in VIEWS:
        catalog[view].write.mode("overwrite").parquet(f"{dump_dir.rstrip('/')}/{view}")
    return list(VIEWS)


class DumpCatalog:
    """The same views read back from a written dump (``materialize``)."""

    def __init__(self, spark: SparkSession, dump_dir: str):
        self.spark = prepare(spark)
        self.dump_dir = dump_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, view: str) -> DataFrame:
        if view not in self._cache:
            df = self.spark.read.parquet(f"{self.dump_dir}/{view}")
            self._cache[view] = conform(df, view) if view in SCHEMAS else df
        return self._cache[view]

    def __getattr__(self, view: str) -> DataFrame:
        if view in SCHEMAS:
            return self[view]
        raise AttributeError(view)
