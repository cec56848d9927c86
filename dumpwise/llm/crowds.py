"""Near pairs of crowded groups: hash buckets or cells too large for one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dumpwise.llm.common import partitions, staged, table_groups
from dumpwise.llm.graph import roots

Near = Callable[[pa.Array, pa.Array], np.ndarray]


def crowded_edges(rows: DataFrame, key: str, value: str, near: Near, tile: int) -> DataFrame:
    """Edges ``a, b`` that connect the near pairs of each group of ``rows`` (columns ``key``, ``class_id``, ``value``).

    ``near(left, right)`` says which pairs of two Arrow arrays of values are near
    (a boolean matrix). Every member is compared with its group's pivot, the member
    of the smallest class. Those near it are tied to it and are not compared among
    each other; the others are compared with all members, in tiles of about ``tile``
    rows, each pair of tiles one piece of work. Only connecting edges leave a piece.
    A group of n members of which r are not near the pivot costs n + n * r
    comparisons, whatever its size, and no task holds more than two tiles.
    """
    n = partitions(rows.sparkSession)
    pivots = rows.groupBy(key).agg(F.min("class_id").alias("pivot"), F.min_by(value, "class_id").alias("pivot_value"))

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, pivot_values, values = batch.column(0).to_numpy(), batch.column(3), batch.column(4)
            tied = np.zeros(batch.num_rows, bool)
            for k in np.unique(keys):
                at = np.flatnonzero(keys == k)
                tied[at] = near(pivot_values.slice(int(at[0]), 1), values.take(pa.array(at)))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(tied), values], names=["key", "class_id", "pivot", "tied", "value"])

    kind = T.StructType([T.StructField("key", T.LongType()), T.StructField("class_id", T.LongType()), T.StructField("pivot", T.LongType()),
                         T.StructField("tied", T.BooleanType()), T.StructField("value", rows.schema[value].dataType)])
    met = rows.join(pivots, key).select(key, "class_id", "pivot", "pivot_value", value)
    members = staged(met.mapInArrow(tie, kind), "crowd-members")
    to_pivot = members.where("tied and class_id <> pivot").select(F.col("class_id").alias("a"), F.col("pivot").alias("b"))

    tiles_of = lambda test: F.ceil(F.count_if(test) / tile).cast("long")
    tiles = members.groupBy("key").agg(tiles_of(~F.col("tied")).alias("loose"), tiles_of(F.col("tied")).alias("fast")).where("loose > 0")
    # tiles of loose members come first; each meets itself and every later tile
    spread = lambda count: F.pmod(F.xxhash64("class_id"), F.greatest(F.col(count), F.lit(1)))
    last = F.when(F.col("tied"), F.col("loose")).otherwise(F.col("loose") + F.col("fast")) - 1
    placed = members.join(tiles, "key").withColumn("tile", F.when(F.col("tied"), F.col("loose") + spread("fast")).otherwise(spread("loose")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    work = placed.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "class_id", "value")

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in table_groups(batches, 3):
            ids, side, values = piece["class_id"].to_numpy(), piece["tile"].to_numpy(), piece["value"].combine_chunks()
            left, right = (np.flatnonzero(side == piece[c][0].as_py()) for c in ("i", "j"))
            if not len(left) or not len(right):
                continue
            a, b = np.nonzero(near(values.take(pa.array(left)), values.take(pa.array(right))))
            root = np.array(roots(len(ids), zip(left[a].tolist(), right[b].tolist())))
            moved = np.flatnonzero(root != np.arange(len(ids)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["a", "b"])

    found = work.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(connect, "a long, b long")
    return to_pivot.unionByName(found)
