"""Catalogue dump tables: schemas and loading.

A dump is a directory per date holding one table directory each
(``<root>/<date>/<table>``). The format is a parameter: the catalogue exports
Avro (needs the external spark-avro package on the cluster), Parquet is the
preferred at-rest format. Column names are lower-cased on load because dumps
mix ``RSE_ID`` and ``rse_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L = T.StringType(), T.LongType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "dslocks": _schema(("scope", S), ("name", S), ("rse_id", S), ("account", S), ("state", S), ("bytes", L),
                       ("created_at", L), ("accessed_at", L), ("rule_id", S), ("updated_at", L)),
    "rses": _schema(("id", S), ("rse", S), ("rse_type", S)),
    "rse_metadata": _schema(("rse_id", S), ("key", S), ("value", S)),
    "rse_protocols": _schema(("rse_id", S), ("scheme", S), ("hostname", S), ("prefix", S), ("write_lan", S)),
    "replicas": _schema(("scope", S), ("name", S), ("rse_id", S), ("bytes", L), ("adler32", S), ("path", S),
                        ("state", S), ("created_at", L), ("updated_at", L), ("accessed_at", L), ("tombstone", L)),
    "collection_replicas": _schema(("scope", S), ("name", S), ("rse_id", S), ("did_type", S), ("available_bytes", L),
                                   ("state", S), ("created_at", L), ("accessed_at", L), ("updated_at", L)),
    "contents": _schema(("scope", S), ("name", S), ("did_type", S), ("child_scope", S), ("child_name", S),
                        ("child_type", S)),
    "contents_history": _schema(("scope", S), ("name", S), ("did_type", S), ("child_scope", S), ("child_name", S)),
    "bad_replicas": _schema(("scope", S), ("name", S), ("rse_id", S), ("state", S), ("account", S),
                            ("created_at", L), ("updated_at", L)),
    "dids": _schema(("scope", S), ("name", S), ("length", L), ("bytes", L), ("events", L), ("datatype", S),
                    ("prod_step", S), ("run_number", S), ("project", S), ("stream_name", S), ("version", S),
                    ("campaign", S), ("created_at", L), ("accessed_at", L)),
}

TABLES = tuple(SCHEMAS)


def _converted(name: str, have: T.DataType, want: T.DataType) -> Column:
    """Column ``name`` as the schema's type, for types whose values keep their meaning; else an error.

    A timestamp becomes epoch milliseconds, the unit of every time in a dump.
    """
    c = F.col(f"`{name}`")
    if isinstance(want, T.LongType):
        if isinstance(have, T.TimestampType):
            return F.unix_millis(c)
        if isinstance(have, T.IntegralType):
            return c.cast(want)
        if isinstance(have, T.DecimalType) and have.scale == 0 and have.precision <= 18:
            return c.cast(want)
    if isinstance(want, T.StringType) and isinstance(have, (T.StringType, T.IntegralType)):
        return c.cast(want)
    if isinstance(have, T.NullType):
        return c.cast(want)
    raise TypeError(f"column {name!r} is {have.simpleString()}, expected {want.simpleString()}")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Lower-case the columns and project them to the table schema.

    Raises if a schema column is missing, is there twice in different case, or
    has a type whose values would change their meaning. Extra columns are
    dropped, so the scan only reads what the schema names (and Catalyst prunes
    further).
    """
    schema = SCHEMAS[table]
    lower: dict[str, list[str]] = {}
    for c in df.columns:
        lower.setdefault(c.lower(), []).append(c)
    missing = [f.name for f in schema.fields if f.name not in lower]
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}; has {df.columns}")
    twice = [lower[f.name] for f in schema.fields if len(lower[f.name]) > 1]
    if twice:
        raise ValueError(f"table {table!r} has columns that differ only in case: {twice}")
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        src = lower[f.name][0]
        same = src == f.name and have[src] == f.dataType
        cols.append(F.col(f.name) if same else _converted(src, have[src], f.dataType).alias(f.name))
    return df.select(cols)


def load_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if options:
        reader = reader.options(**options)
    try:
        df = reader.load(path)
    except Exception as e:  # a reader package missing from the cluster, e.g. Avro
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find data source" in str(e):
            raise RuntimeError(f"reader format {fmt!r} is not available in this Spark session; add its package "
                               f"(for Avro: the spark-avro module) or export the dump as Parquet") from e
        raise
    return conform(df, table)


def load_tables(spark: SparkSession, dump_dir: str, tables: Iterable[str] | None = None, fmt: str = "parquet",
                options: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Lazily bound frames for ``<dump_dir>/<table>``, one per requested table."""
    return {t: load_table(spark, f"{dump_dir.rstrip('/')}/{t}", t, fmt, options) for t in (tables or TABLES)}
