"""Merkle dataset manifest (operator 12).

Every row is a leaf: the sha256 of its fields, each with its length. Per group
(language) the leaves ascend by id; eight consecutive nodes make a parent until
one is left, the group's subroot; the subroots, ordered by group, likewise make
the root. Each row gets its proof (the siblings on its way up) and the root
folded again from a leaf that may have been tampered with.

One level is one window: nodes lie in chunks of 8^2, ``lag`` 1-7 and ``lead`` 1-7
of the hash, masked by the slot in the run and by the run's length, are the
siblings, and the first child of every run hashes the parent. Places are counted
without a window over a whole group: rows are dealt by ranges of (group, id), a
row's place is its number in the range plus the rows of its group in earlier
ranges, so a group with any share of the rows is spread over the tasks. Proofs
come down the tree by joins on the parent's place, each level an eighth of the
one below; only the leaves' level has as many rows as the table, and no text
is moved.

Cases: a null field is ``-``; a null group is a group of its own and the first; a
null id comes first and is never tampered with; rows of one id are ordered by
their leaf, equal rows share all but their place; a null text stays null when
tampered with; a lone leaf is its group's subroot and a lone subroot the root;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumpwise.llm.common import partitions, staged

FAN = 8
CHUNK = FAN**2  # nodes of one window group, a multiple of the run length
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    """Length in bytes, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return _hash(*map(_field, fields))


def _placed(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place`` (from 0) and ``total`` in their group, in the given order; staged."""
    n = partitions(rows.sparkSession)
    salt = F.monotonically_increasing_id()  # spreads equal rows; their order does not matter
    dealt = rows.withColumn("salt", salt).repartitionByRange(n, group, *order, "salt").sortWithinPartitions(group, *order, "salt").drop("salt")
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = staged(dealt.select("*", F.spark_partition_id().alias("range"), low.alias("nth")), name)
    parts = dealt.groupBy(group, "range").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(group, "range", (earlier - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy(group)).alias("total"))
    return dealt.join(parts, [group, "range"]).withColumn("place", F.col("nth") + F.col("shift")).drop("range", "nth", "shift")


def _with_siblings(nodes: DataFrame, group: str) -> DataFrame:
    """``left`` and ``right``: the hashes of the run's other nodes, before and behind the node."""
    w = Window.partitionBy(group, F.floor(F.col("place") / CHUNK)).orderBy("place")
    slot = F.col("place") % FAN
    run = F.least(F.lit(FAN), F.col("total") - (F.col("place") - slot))
    left = [F.when(slot >= k, F.lag("hash", k).over(w)).otherwise("") for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("hash", k).over(w)).otherwise("") for k in range(1, FAN)]
    return nodes.withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def _parents(nodes: DataFrame, group: str) -> DataFrame:
    """The next level: first children hash their runs; a group that is down to one node keeps it."""
    made = F.when(F.col("total") > 1, _hash("hash", "right")).otherwise(F.col("hash"))
    first = nodes.where(F.col("place") % FAN == 0)
    return first.select(group, F.floor(F.col("place") / FAN).alias("place"), F.ceil(F.col("total") / FAN).alias("total"), made.alias("hash"))


def _tree(leaves: DataFrame, group: str, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels with siblings, the leaves' first (each staged), and (group, hash) of what remains."""
    largest = leaves.agg(F.max("total")).first()[0] or 0
    levels, nodes = [], leaves
    while largest > 1:
        levels.append(staged(_with_siblings(nodes, group), f"{name}-{len(levels)}"))
        nodes, largest = _parents(levels[-1], group), -(-largest // FAN)
    return levels, nodes.select(group, "hash")


def _step() -> Column:
    """A node's own entry of the proof: none where its group is already down to one node."""
    empty = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    return F.when(F.col("total") > 1, F.array(F.struct("left", "right"))).otherwise(empty)


def _descend(levels: list[DataFrame], group: str, top: DataFrame, carried: list[str]) -> DataFrame:
    """Rows of the lowest level with ``path`` up to the top; ``top`` has (group, path, *carried)."""
    up = top.withColumn("parent", F.lit(0).cast("long"))
    for k in range(len(levels) - 1, -1, -1):
        above = up.withColumnRenamed("path", "rest")
        here = levels[k].withColumn("parent", F.floor(F.col("place") / FAN)).join(above, [group, "parent"])
        kept = [c for c in levels[k].columns if c not in ("left", "right", "total", "place")] if k == 0 else [group]
        up = here.select(*kept, F.col("place").alias("parent"), F.concat(_step(), "rest").alias("path"), *carried)
    return up


def manifest(rows: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
             tampered: Column | None = None) -> DataFrame:
    """One row per row of ``rows``: leaf, subroot, root, digest of the proof, and the root folded from the (tampered) leaf.

    ``tampered`` marks the rows whose text loses its capitals A-Z before the root is folded again.
    """
    if tampered is None:
        tampered = F.crc32(F.col(id_col).cast("string")) % 3 == 0
    lowered = F.translate(F.col(text_col), UPPER, LOWER)
    marked = F.coalesce(tampered, F.lit(False))
    group = F.coalesce(F.concat(F.lit("+"), F.col(group_col)), F.lit(""))  # null first, else bytewise
    leaves = rows.select(
        F.col(id_col).alias("doc_id"), group.alias("g"), leaf_hash([F.col(c) for c in fields]).alias("hash"),
        F.when(marked, leaf_hash([lowered if c == text_col else F.col(c) for c in fields])).alias("changed"),
    )
    leaves = _placed(staged(leaves, "merkle-leaves"), "g", ["doc_id", "hash"], "merkle-placed")
    levels, subroots = _tree(leaves, "g", "merkle-level")
    subroots = subroots.withColumn("one", F.lit("root"))
    groups = _placed(subroots.withColumnRenamed("hash", "subroot"), "one", ["g"], "merkle-groups")
    upper, root = _tree(groups.withColumn("hash", F.col("subroot")), "one", "merkle-upper")
    none = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    top = root.select("one", F.col("hash").alias("root"), none.alias("path"))
    tops = _descend(upper, "one", top, ["root"]) if upper else groups.join(top, "one")
    tops = tops.select("g", "subroot", "root", "path")
    proofs = _descend(levels, "g", tops, ["subroot", "root"]) if levels else leaves.join(tops, "g")
    leaf = F.coalesce("changed", "hash")
    folded = F.aggregate("path", leaf, lambda below, x: _hash(x["left"], below, x["right"]))
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    out = proofs.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(levels: int = 8, upper: int = 3) -> str:
    """DuckDB SQL over ``documents``, for at most 8^levels rows of a language and 8^upper languages."""
    value = lambda c: f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end"
    leaf = lambda text: "sha256(" + " || ".join(value(text if c == "text" else c) for c in FIELDS) + ")"
    bit = "case when (d & 1) = 1 then xor(d >> 1, 3988292384) else d >> 1 end"
    crc = f"""xor(list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
        lambda a, b: list_reduce([xor(a, b)] || list_transform(range(8), lambda i: i::bigint), lambda d, i: {bit})), 4294967295)"""
    parts = [
        f"base as (select doc_id, '+' || lang as g, {leaf('text')} as leaf, {leaf(f'lower_text')} as low, coalesce({crc} % 3 = 0, false) as bad"
        f" from (select *, translate(text, '{UPPER}', '{LOWER}') as lower_text from documents))",
        "d0 as (select doc_id, coalesce(g, '') as g, leaf, case when bad then low else leaf end as fold, '' as proof,"
        " row_number() over (partition by coalesce(g, '') order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by coalesce(g, '')) as total from base)",
        "n0 as (select g, place, total, leaf as hash from d0)",
    ]

    def climb(d: str, n: str, k: int, group: str, keep: str) -> None:
        """Level k: runs as lists, parents, and the fold and proof of the rows one level further."""
        parts.append(f"{n}r{k} as (select {group}, place // 8 as up, any_value(total) as total, list(hash order by place) as hs from {n}{k} group by all)")
        parts.append(f"{n}{k + 1} as (select {group}, up as place, (total + 7) // 8 as total, case when total > 1 then sha256(array_to_string(hs, '')) else hs[1] end as hash from {n}r{k})")
        left, right = "array_to_string(hs[1:d.place % 8], '')", "array_to_string(hs[d.place % 8 + 2:], '')"
        parts.append(
            f"{d}{k + 1} as (select {keep}, case when r.total > 1 then sha256({left} || fold || {right}) else fold end as fold, proof || case when r.total > 1 then {left} || {right} else '' end as proof,"
            f" r.up as place from {d}{k} d join {n}r{k} r on d.{group} = r.{group} and d.place // 8 = r.up)"
        )

    for k in range(levels):
        climb("d", "n", k, "g", "doc_id, d.g, leaf")
    parts.append(f"s as (select g, hash as subroot, 1 as one, row_number() over (order by g) - 1 as place, count(*) over () as total from n{levels})")
    parts.append("m0 as (select one, place, total, subroot as hash from s)")
    parts.append(f"e0 as (select doc_id, leaf, subroot, fold, proof, s.place, one from d{levels} join s using (g))")
    for k in range(upper):
        climb("e", "m", k, "one", "doc_id, leaf, subroot, d.one")
    parts.append(f"t as (select hash as root from m{upper})")
    return (
        "with " + ",\n".join(parts)
        + f"\nselect doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, fold as folded_root, fold = root as verified from e{upper}, t"
    )
