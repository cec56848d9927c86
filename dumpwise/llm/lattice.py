"""Embedding near-duplicates by lattice hashing (operator 7).

Links vectors with cosine >= 0.9 (double precision).

1. Equal vectors form a class; from here on a class counts once.
2. In each of several tables a unit vector is projected by random Gaussians to
   blocks of 8 numbers, each block decoded to its nearest point of the E8 lattice
   (scale ``SCALE``); the points are the home cell. The PROBES next-best cells are
   reached by the root vector with the largest projection on the decoding error.
   A vector stands in its home cell and visits its probe cells.
3. In a cell, residents are compared with everyone there by cosine; the cell
   hands on only enough edges to connect the pairs found. A cell of more than
   ``CELL`` rows does the same in tiles, in many tasks (``crowds``).
4. The components of these edges are verification groups: all pairs of a group are
   compared exactly, in tiles of TILE vectors, each pair of tiles one piece of
   work. So no pair is ever a row, no group is capped, and links that hashing
   missed inside a group are found as well.

With 8 tables of 2 blocks and 4 probes a pair at cosine 0.9 exactly meets with
probability 0.94, one at 0.93 with 0.99. Blocks grow with the logarithm of the
number of vectors, so that cells stay small, and tables with the blocks, so that
the recall holds (a test measures it for every shape).

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different length do not link; rows with null id
link with nothing and are kept; repeated rows are copies of each other; an id may
name several vectors, it only labels them; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwise.llm.common import mix64, partitions, staged, table_groups
from dumpwise.llm.crowds import crowded_edges
from dumpwise.llm.graph import components
from dumpwise.llm.graph import roots as roots_of

THRESHOLD = 0.9
SCALE = 2.0
PROBES = 4
CELL = 4000
TILE = 2000
RUN = 4096
# Tables for each number of blocks: with PROBES probes one table finds a pair at cosine 0.9 with probability 0.29, 0.10 and 0.033.
TABLES = {2: 8, 3: 28, 4: 90}


def _root_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    ends = [np.eye(8)[i] * s + np.eye(8)[j] * t for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    halves = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(ends + halves)


ROOTS = _root_vectors()


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with even sum: round, and where the sum is odd round the worst coordinate the other way."""
    point = np.rint(x)
    error = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
    worst = np.abs(error[odd]).argmax(axis=1)
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 shifted by one half."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def shape_for(n: int) -> tuple[int, int]:
    """(tables, blocks per table) for n vectors: about 2**9 cells per block are in use. Above 2**36 vectors cells grow instead of blocks."""
    blocks = min(max(TABLES), max(min(TABLES), math.ceil(math.log2(max(2, n)) / 9)))
    return TABLES[blocks], blocks


def cell_keys(units: np.ndarray, table: int, blocks: int, probes: int = PROBES) -> np.ndarray:
    """Keys of the home cell (column 0) and the probe cells of unit vectors in one table."""
    n, dim = units.shape
    project = np.random.default_rng([table, dim]).normal(size=(dim, 8 * blocks)) / SCALE
    x = (units @ project).reshape(n, blocks, 8)
    home = np.stack([nearest_e8(x[:, b]) for b in range(blocks)], axis=1)
    gain = ((x - home).reshape(-1, 8) @ ROOTS.T).reshape(n, -1)
    best = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
    cells = np.repeat(home[:, None], probes + 1, axis=1)
    rows = np.arange(n)
    for p in range(probes):
        block, root = np.divmod(best[:, p], len(ROOTS))
        cells[rows, p + 1, block] += ROOTS[root]
    doubled = np.rint(cells * 2).astype(np.int64).view(np.uint64).reshape(n, probes + 1, -1)
    key = np.full((n, probes + 1), table * 1_000_003 + dim, np.uint64)
    for k in range(doubled.shape[2]):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + doubled[:, :, k])
    return key.view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as a matrix of unit vectors in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # scaled by the largest component first, so that squares neither overflow nor vanish
    values = values / np.abs(values).max(axis=1)[:, None]
    return values / np.sqrt((values**2).sum(axis=1))[:, None]


def _near(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Which pairs of vectors of equal length have a cosine that may reach the threshold."""
    return _matrix(left) @ _matrix(right).T >= THRESHOLD - 1e-9


def _cell_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect the pairs found in each cell."""
    for cell in table_groups(batches, 1):
        ids, home = cell["class_id"].to_numpy(), cell["home"].to_numpy()
        if len(ids) < 2 or not home.any():
            continue
        units = _matrix(cell["vector"].combine_chunks())
        residents = np.flatnonzero(home)
        i, j = np.nonzero(units[residents] @ units.T >= THRESHOLD - 1e-9)
        roots = np.array(roots_of(len(ids), zip(residents[i].tolist(), j.tolist())))
        tied = np.flatnonzero((roots != np.arange(len(ids))) & (ids != ids[roots]))
        if len(tied):
            yield pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[roots[tied]])], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece of work and class: vectors linked directly, and the smallest class it is linked to by a chain."""
    for piece in table_groups(batches, 3):
        piece = piece.sort_by("class_id")
        ids, copies, tile = (piece[c].to_numpy() for c in ("class_id", "copies", "tile"))
        units = _matrix(piece["vector"].combine_chunks())
        i, j = piece["i"][0].as_py(), piece["j"][0].as_py()
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        linked = units[left] @ units[right].T >= THRESHOLD
        if i == j:
            linked = np.triu(linked, 1)
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, left, linked @ copies[right])
        np.add.at(n, right, linked.T @ copies[left])
        a, b = np.nonzero(linked)
        # enough edges to connect what is linked: each row's first partner on either side, and the pairs between them
        roots = roots_of(len(ids), zip(left[a].tolist(), right[b].tolist()))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(ids[np.array(roots)]), piece["tiles"].combine_chunks()], names=["class_id", "linked", "root", "tiles"])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cell_rows: int = CELL, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    n = partitions(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(F.coalesce(x, F.lit(0.0))))
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0.0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    grouped = rows.where("usable").groupBy("vector").agg(F.min("vec_id").alias("label"), F.count(F.lit(1)).alias("copies"))
    # a number of its own for every vector; ids are only labels, one may name several vectors
    classes = staged(grouped.withColumn("class_id", F.monotonically_increasing_id()), "lattice-classes")
    tables, blocks = shape_for(classes.count())

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            for dim in np.unique(lengths):
                same = batch.filter(pa.array(lengths == dim))
                for first in range(0, same.num_rows, RUN):
                    part = same.slice(first, RUN)
                    units = _matrix(part.column(1))
                    for t in range(tables):
                        keys = cell_keys(units, t, blocks)
                        for k in range(keys.shape[1]):
                            yield pa.RecordBatch.from_arrays([pa.array(keys[:, k].copy()), part.column(0), pa.array(np.full(len(keys), k == 0))], names=["cell", "class_id", "home"])

    placed = staged(classes.select("class_id", "vector").mapInArrow(cells, "cell long, class_id long, home boolean"), "lattice-cells")
    shared = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("inhabited"), F.min("class_id").alias("first"), F.max("class_id").alias("last"))
    shared = staged(shared.where("inhabited and first < last").select("cell", "n"), "lattice-shared")
    filled = lambda test: placed.join(shared.where(test), "cell").join(classes.select("class_id", "vector"), "class_id").select("cell", "class_id", "home", "vector")
    small = filled(F.col("n") <= cell_rows)
    edges = small.repartition(n, "cell").sortWithinPartitions("cell", "class_id").mapInArrow(_cell_edges, "a long, b long")
    if shared.where(F.col("n") > cell_rows).limit(1).count():
        # probe cells of one vector may coincide with each other; once is enough
        crowd = filled(F.col("n") > cell_rows).select("cell", "class_id", "vector").dropDuplicates(["cell", "class_id"])
        edges = edges.unionByName(crowded_edges(crowd, "cell", "vector", _near, min(cell_rows, tile)))
    groups = staged(components(edges), "lattice-groups")

    tiles = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / tile).cast("long").alias("tiles")).withColumnRenamed("component", "group")
    placed = groups.join(tiles, F.col("component") == F.col("group")).join(classes, F.col("node") == F.col("class_id"))
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("class_id"), F.col("tiles"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    work = placed.select("group", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "tiles", "class_id", "copies", "vector")
    found = work.repartition(n, "group", "i", "j").sortWithinPartitions("group", "i", "j").mapInArrow(_verified, "class_id long, linked long, root long, tiles long")
    found = staged(found, "lattice-verified")
    linked = found.groupBy("class_id").agg(F.sum("linked").alias("linked"), F.min("root").alias("root"))
    cut = found.where("tiles > 1")
    if cut.limit(1).count():
        chained = components(cut.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
        linked = linked.join(chained, F.col("class_id") == F.col("node"), "left").withColumn("root", F.coalesce("component", "root")).drop("node", "component")
    linked = linked.join(classes.select("class_id", "label"), "class_id")
    named = linked.groupBy("root").agg(F.min("label").alias("component_id"))
    linked = linked.join(named, "root").select("class_id", "linked", "component_id")
    per_class = classes.select("class_id", "label", "copies", F.col("vector").alias("v")).join(linked, "class_id", "left").select(
        "v", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component_id", "label").alias("component_id"))
    done = rows.where("usable").join(per_class, F.col("vector") == F.col("v")).select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    rest = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
