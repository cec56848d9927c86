"""Global accounting (R7): per-dataset usage by storage class with replication factors.

Chain: ``accounted_rses`` (R7a) -> ``classified_replicas`` (R7b) ->
``attribute_to_dataset`` (R7c) -> ``storage_class_usage`` (R7d) ->
``replication_factors`` (R7e). ``global_accounting`` composes them.

Scale notes. The replica table is the big input; storage elements and their
attributes are dimensions (broadcast after a size check). The largest join is
replicas to dataset contents on the file: a file can sit in many datasets. The
owner of a file depends only on the file, so contents are first reduced to one
owner per file (a partially aggregated ``min_by``), and the replica join
becomes one-to-one instead of fanning out per (file, element). The later
(file, element) grouping then reuses that join's partitioning. All eight
storage classes are counted in **one** conditional aggregation per dataset
(partial + final), never eight filtered aggregations and a union.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpwise.plans.hot import HOT_ROWS, hot_keys, is_hot
from dumpwise.plans.joins import Profile, join_dimension, profile

# Attribute keys, padding of a missing attribute, storage element types,
# replica kinds, and the element kept whatever its attributes.
KEY_TYPE = "type"
KEY_TIER = "tier"
MISSING = "-2"
DISK = "DISK"
TAPE = "TAPE"
PRIMARY = "primary"
SECONDARY = "secondary"
SPECIAL_RSE = "CERN-PROD_TZDISK"
DEFAULT_ELIGIBLE = f"(type = 'DATADISK' AND tier != '3') OR rse = '{SPECIAL_RSE}' OR rse_type = '{TAPE}'"

# A file in no dataset, and the dataset scope never chosen as owner.
NO_SCOPE = "no_scope"
NO_NAME = "no_name"
IGNORED_SCOPE = "panda"

# Storage classes (short name, replica kind or None for any, element type, tier).
CLASSES = (
    ("prim_t0", PRIMARY, DISK, "0"),
    ("prim_t1", PRIMARY, DISK, "1"),
    ("prim_t2", PRIMARY, DISK, "2"),
    ("secs_t0", SECONDARY, DISK, "0"),
    ("secs_t1", SECONDARY, DISK, "1"),
    ("secs_t2", SECONDARY, DISK, "2"),
    ("tape_t0", None, TAPE, "0"),
    ("tape_t1", None, TAPE, "1"),
)
# Report names of the class kinds.
LONG_KIND = {"prim": "primary", "secs": "secondary", "tape": "tape"}

METADATA = ("datatype", "prod_step", "run_number", "project", "stream_name", "version", "campaign")


def _report_name(short: str, measure: str) -> str:
    """``prim_t0`` + ``accessed_files`` -> ``primary_accessed_files_t0``."""
    kind, tier = short.split("_")
    return f"{LONG_KIND[kind]}_{measure}_{tier}"


def accounting_columns() -> list[str]:
    """The 54 report columns, in file order (position is the text file's contract)."""
    files = [_report_name(c[0], m) for c in CLASSES for m in ("files", "accessed_files")]
    sizes = [_report_name(c[0], m) for c in CLASSES for m in ("bytes", "accessed_bytes")]
    factors = [_report_name(c[0], "repl_factor") for c in CLASSES]
    return ["scope", "name", "accessed_at", "created_at", "length", "bytes", *files, *sizes, *factors,
            *METADATA, "events"]


def accounted_rses(rses: DataFrame, rse_metadata: DataFrame, eligible: str | Column = DEFAULT_ELIGIBLE) -> DataFrame:
    """Storage elements with their ``type`` and ``tier`` attributes, kept by ``eligible``.

    Each ``type``/``tier`` row contributes its value to its own attribute and
    the text ``-2`` to the other; the largest text wins, so a missing attribute
    reads ``-2`` and real values beat the padding. Elements without either key
    are absent. Columns: ``id, rse, rse_type, tier``.
    """
    attrs = rse_metadata.filter(F.col("key").isin(KEY_TYPE, KEY_TIER))
    # Both sides are dimension tables (no fact involved): the planner picks the strategy.
    joined = rses.join(attrs, rses["id"] == attrs["rse_id"])
    pivot = joined.groupBy("id", "rse", "rse_type").agg(
        F.max(F.when(F.col("key") == KEY_TYPE, F.col("value")).otherwise(F.lit(MISSING))).alias("type"),
        F.max(F.when(F.col("key") == KEY_TIER, F.col("value")).otherwise(F.lit(MISSING))).alias("tier"),
    )
    keep = F.expr(eligible) if isinstance(eligible, str) else eligible
    return pivot.filter(keep).select("id", "rse", "rse_type", "tier")


def classified_replicas(replicas: DataFrame, accounted: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Replicas on accounted elements: primary (no tombstone) or secondary, NULL bytes/access as 0.

    ``broadcast``: the result of an earlier size check of ``accounted``
    (``profile``); ``None`` checks it here. Columns: ``scope, name, bytes, rse,
    type, rse_type, tier, accessed_at``.
    """
    reps = replicas.select(
        "scope", "name", "rse_id",
        F.coalesce(F.col("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        F.when(F.col("tombstone").isNull(), F.lit(PRIMARY)).otherwise(F.lit(SECONDARY)).alias("type"),
        F.coalesce(F.col("accessed_at"), F.lit(0)).cast("bigint").alias("accessed_at"),
    )
    elements = accounted.select(F.col("id").alias("rse_id"), "rse", "rse_type", "tier")
    return join_dimension(reps, elements, "rse_id", small=broadcast).select(
        "scope", "name", "bytes", "rse", "type", "rse_type", "tier", "accessed_at")


def _file_parents(contents: DataFrame) -> DataFrame:
    return contents.filter((F.col("did_type") == "D") & (F.col("child_type") == "F")).select(
        F.col("child_scope").alias("fscope"), F.col("child_name").alias("fname"),
        F.coalesce(F.col("scope"), F.lit(NO_SCOPE)).alias("dscope"),
        F.coalesce(F.col("name"), F.lit(NO_NAME)).alias("dname"),
    )


def _owner_key(dscope: Column, dname: Column) -> Column:
    # Owner = smallest "scope:name" text (binary order); ignored scopes never qualify.
    return F.when(dscope != IGNORED_SCOPE, F.concat(dscope, F.lit(":"), dname))


def dataset_owners(contents: DataFrame) -> DataFrame:
    """One row per file with a parent dataset: ``fscope, fname, owner`` (struct dscope, dname).

    ``owner`` is NULL when every parent has the ignored scope: such files leave the accounting.
    """
    parents = _file_parents(contents)
    return parents.groupBy("fscope", "fname").agg(
        F.min_by(F.struct("dscope", "dname"), _owner_key(F.col("dscope"), F.col("dname"))).alias("owner"))


_REPLICA_MAX = ("bytes", "type", "rse_type", "tier", "accessed_at")


def _with_owner(reps: DataFrame, owners: DataFrame) -> DataFrame:
    """Replica rows with their file's owner; files whose parents all have the ignored scope go."""
    joined = reps.join(owners.withColumn("has_parent", F.lit(True)), ["fscope", "fname"], "left").filter(
        F.col("has_parent").isNull() | F.col("owner").isNotNull())
    return joined.select(
        "fscope", "fname", "rse", *_REPLICA_MAX,
        F.coalesce(F.col("owner.dscope"), F.lit(NO_SCOPE)).alias("dscope"),
        F.coalesce(F.col("owner.dname"), F.lit(NO_NAME)).alias("dname"),
    )


def _merged(reps: DataFrame, keys: list[str], unique_rse_names: bool) -> DataFrame:
    """One row per ``keys``: the maxima of the replica attributes."""
    if not unique_rse_names:
        return reps.groupBy(*keys).agg(*[F.max(c).alias(c) for c in _REPLICA_MAX])
    return reps.groupBy(*keys, "rse_type", "tier").agg(
        F.max("bytes").alias("bytes"),
        F.max(F.col("type") == SECONDARY).alias("_secondary"),
        F.max("accessed_at").alias("accessed_at"),
    ).withColumn("type", F.when(F.col("_secondary"), F.lit(SECONDARY)).otherwise(F.lit(PRIMARY)))


def attribute_to_dataset(classified: DataFrame, contents: DataFrame, unique_rse_names: bool = False,
                         split_hot_files: bool | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One owning dataset per (file, element): the smallest ``scope:name`` among its parents.

    A file in no dataset belongs to ``no_scope:no_name``; a file whose parents
    all have the ignored scope is dropped. Per (file, element) the replica
    attributes are maxima. Columns: ``fscope, fname, rse, dscope, dname, bytes,
    type, rse_type, tier, accessed_at``.

    ``unique_rse_names=True`` (pass it only when checked, see ``rse_names_unique``)
    lets an element's type and tier be grouping keys: they then depend on the
    element name alone, the maxima left are fixed-width (bytes, access time, a
    secondary flag) and the grouping runs as a hash aggregate instead of a
    sort-based one over all replicas.

    Files with ``hot_rows`` replica rows or more (found by a sketch over the file
    keys) have their rows merged per element *before* the owner join: a partial
    aggregate with its own exchange, exact as the owner depends on the file
    alone, after which a file has one row per element. All others group after
    the join and reuse its partitioning, without any more shuffle.
    ``split_hot_files=True`` sends all files the first way, ``False`` none.
    """
    reps = classified.select(F.col("scope").alias("fscope"), F.col("name").alias("fname"), "rse", *_REPLICA_MAX)
    owners, file, out = dataset_owners(contents), ["fscope", "fname"], ["fscope", "fname", "rse", "dscope", "dname", *_REPLICA_MAX]

    def before(some: DataFrame, their: DataFrame) -> DataFrame:
        return _with_owner(_merged(some, [*file, "rse"], unique_rse_names), their).select(*out)

    def after(some: DataFrame) -> DataFrame:
        return _merged(_with_owner(some, owners), [*file, "rse", "dscope", "dname"], unique_rse_names).select(*out)

    if split_hot_files:
        return before(reps, owners)
    hot = hot_keys(reps, file, hot_rows) if split_hot_files is None else []
    if not hot:
        return after(reps)
    split = is_hot(file, hot)  # never NULL: a hash
    theirs = contents.filter(is_hot(["child_scope", "child_name"], hot))
    return before(reps.filter(split), dataset_owners(theirs)).unionByName(after(reps.filter(~split)))


def rse_names_unique(accounted: DataFrame) -> bool:
    """Whether every accounted element name belongs to one element (one small job on the dimension)."""
    return profile(accounted.select("rse"), "rse").unique


def prepared_replicas(replicas: DataFrame, rses: DataFrame, rse_metadata: DataFrame,
                      eligible: str | Column = DEFAULT_ELIGIBLE,
                      elements: Profile | None = None) -> tuple[DataFrame, bool]:
    """R7a + R7b with one small check job (size and name uniqueness) on the element table.

    The accounted elements are at most one row per element, so the element
    table's size bounds theirs, and names unique there stay unique among them:
    checking the plain table (one scan) suffices. Returns the classified
    replicas and whether element names are unique.
    """
    accounted = accounted_rses(rses, rse_metadata, eligible)
    small, unique = elements or profile(rses, "rse")
    return classified_replicas(replicas, accounted, small), unique


def _class_predicate(kind: str | None, rse_type: str, tier: str) -> Column:
    cond = (F.col("rse_type") == rse_type) & (F.col("tier") == tier)
    return cond if kind is None else cond & (F.col("type") == kind)


def storage_class_usage(owned: DataFrame, accessed_means_positive: bool = False) -> DataFrame:
    """Per dataset: files, accessed files, bytes and accessed bytes in each storage class,
    and the latest access over its classed replicas.

    Replicas in no class (other tiers, a missing tier, other element types) do
    not count, and a dataset with only such replicas has no row. By default a
    replica counts as accessed when its (zero-filled) access time is not NULL,
    i.e. always, as in the original report; ``accessed_means_positive=True``
    counts only replicas with an access time > 0.
    Columns: ``dscope, dname, accessed_at`` and ``<class>_{files,bytes,accessed_files,accessed_bytes}``.
    """
    accessed = F.col("accessed_at") > 0 if accessed_means_positive else F.col("accessed_at").isNotNull()
    preds = {short: _class_predicate(kind, t, tier) for short, kind, t, tier in CLASSES}
    classed = owned.filter(functools.reduce(operator.or_, preds.values()))
    aggs = []
    for short, pred in preds.items():
        aggs += [
            F.count(F.when(pred, F.col("fname"))).alias(f"{short}_files"),
            F.coalesce(F.sum(F.when(pred, F.col("bytes"))), F.lit(0)).alias(f"{short}_bytes"),
            F.count(F.when(pred & accessed, F.col("fname"))).alias(f"{short}_accessed_files"),
            F.coalesce(F.sum(F.when(pred & accessed, F.col("bytes"))), F.lit(0)).alias(f"{short}_accessed_bytes"),
        ]
    return classed.groupBy("dscope", "dname").agg(F.max("accessed_at").alias("accessed_at"), *aggs)


def replication_factors(usage: DataFrame, dids: DataFrame) -> DataFrame:
    """Attach dataset metadata and divide class file counts by the dataset length.

    ``accessed_at`` is the later of usage and DID access (NULL if the DID is
    missing), kept only when > 0. A factor is NULL when the DID is missing or
    its length is 0. Columns: ``accounting_columns()``.
    """
    meta = dids.select(
        F.col("scope").alias("d_scope"), F.col("name").alias("d_name"),
        F.coalesce(F.col("length"), F.lit(0)).cast("bigint").alias("d_length"),
        F.coalesce(F.col("bytes"), F.lit(0)).cast("bigint").alias("d_bytes"),
        *METADATA,
        F.coalesce(F.col("events"), F.lit(0)).cast("bigint").alias("d_events"),
        F.col("created_at").alias("d_created_at"),
        F.coalesce(F.col("accessed_at"), F.lit(0)).cast("bigint").alias("d_accessed_at"),
    )
    joined = usage.join(meta, (usage["dscope"] == meta["d_scope"]) & (usage["dname"] == meta["d_name"]), "left")
    latest = F.when(F.col("accessed_at").isNotNull() & F.col("d_accessed_at").isNotNull(),
                    F.greatest(F.col("accessed_at"), F.col("d_accessed_at")))
    out = {
        "scope": F.col("dscope"),
        "name": F.col("dname"),
        "accessed_at": F.when(latest > 0, latest),
        "created_at": F.col("d_created_at"),
        "length": F.coalesce(F.col("d_length"), F.lit(0)),
        "bytes": F.coalesce(F.col("d_bytes"), F.lit(0)),
    }
    for measure in ("files", "accessed_files", "bytes", "accessed_bytes"):
        for short, *_ in CLASSES:
            out[_report_name(short, measure)] = F.col(f"{short}_{measure}")
    for short, *_ in CLASSES:
        out[_report_name(short, "repl_factor")] = F.try_divide(F.col(f"{short}_files"), F.col("d_length"))
    for m in METADATA:
        out[m] = F.col(m)
    out["events"] = F.coalesce(F.col("d_events"), F.lit(0))
    return joined.select([out[c].alias(c) for c in accounting_columns()])


def global_accounting(replicas: DataFrame, rses: DataFrame, rse_metadata: DataFrame, contents: DataFrame,
                      dids: DataFrame, eligible: str | Column = DEFAULT_ELIGIBLE, accessed_means_positive: bool = False,
                      cut_lineage: bool = False, split_hot_files: bool | None = None,
                      elements: Profile | None = None) -> DataFrame:
    """The accounting report: one row per dataset, 54 columns (``accounting_columns()``).

    ``cut_lineage=True`` writes the per-(file, element) owner table, the
    largest intermediate, as a reliable checkpoint into the session's shared
    checkpoint folder (``spark.checkpoint.dir``), so executors lost afterwards
    never send Spark back to the replica and contents scans.
    File order (scope, name) is applied by the ordered sink.
    """
    classified, unique = prepared_replicas(replicas, rses, rse_metadata, eligible, elements)
    owned = attribute_to_dataset(classified, contents, unique, split_hot_files)
    if cut_lineage:
        from dumpwise.session import checkpoint_dir

        checkpoint_dir(owned.sparkSession)
        owned = owned.checkpoint(eager=True)
    return replication_factors(storage_class_usage(owned, accessed_means_positive), dids)
