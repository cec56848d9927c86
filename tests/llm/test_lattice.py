from __future__ import annotations

import itertools

import numpy as np
import pytest

from dumpwise.llm import lattice as L

SF = "/root/testdata/sf0.1"


def brute(rows):
    """Links by the full cosine matrix, components by flooding."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = {k: set() for k in range(len(rows))}
    for dim in {len(v) for (_, v), o in zip(rows, ok) if o}:
        at = [k for k, o in enumerate(ok) if o and len(rows[k][1]) == dim]
        x = np.array([rows[k][1] for k in at], np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, j in np.argwhere(x @ x.T >= 0.9):
            if i != j:
                near[at[i]].add(at[j])
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out.append((rows[k][0], len(near[k]), min(rows[m][0] for m in seen)))
    return sorted(out)


def run(spark, rows, kind="float", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in L.near_duplicates(df, **options).collect())


def test_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)) * 2
    p = L.nearest_e8(x)
    assert np.all((p * 2).astype(int) % 2 == (p[:, :1] * 2).astype(int) % 2) and np.all(p.sum(axis=1) % 2 == 0)
    own = ((x - p) ** 2).sum(axis=1)
    assert all((((x - p - r) ** 2).sum(axis=1) >= own - 1e-9).all() for r in L.ROOTS)
    assert len(L.ROOTS) == 240 and np.allclose((L.ROOTS**2).sum(axis=1), 2)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    u = rng.normal(size=(3000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(axis=1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    for cosine, least in ((0.9, 0.9), (0.93, 0.97), (0.98, 0.999)):
        v = cosine * u + np.sqrt(1 - cosine**2) * w
        met = np.zeros(len(u), bool)
        for t in range(8):
            a, b = L.cell_keys(u, t, 2), L.cell_keys(v, t, 2)
            met |= (a[:, :1] == b).any(axis=1) | (a == b[:, :1]).any(axis=1)
        assert met.mean() >= least, (cosine, met.mean())


@pytest.mark.parametrize("n", [2**18, 2**18 + 1, 2**27 + 1, 2**36 + 1])
def test_recall_of_every_shape(n):
    tables, blocks = L.shape_for(n)
    rng = np.random.default_rng(5)
    u, w = rng.normal(size=(2, 1000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w -= (w * u).sum(axis=1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    met = np.zeros((2, len(u)), bool)
    for t in range(tables):
        a = L.cell_keys(u, t, blocks)
        for k, cosine in enumerate((0.9, 0.93)):
            left = np.flatnonzero(~met[k])
            b = L.cell_keys(cosine * u[left] + np.sqrt(1 - cosine**2) * w[left], t, blocks)
            met[k, left] = (a[left, :1] == b).any(axis=1) | (a[left] == b[:, :1]).any(axis=1)
    assert met[0].mean() >= 0.9 and met[1].mean() >= 0.97, (tables, blocks, met.mean(axis=1))


def cluster(rng, n, spread, dim=16):
    base = rng.normal(size=dim)
    return [(base + rng.normal(size=dim) * spread).astype(np.float32).tolist() for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"tile": 5}, {"cell_rows": 1, "tile": 7}])
def test_matches_brute_force(spark, options):
    rng = np.random.default_rng(9)
    vectors = list(itertools.chain.from_iterable(cluster(rng, n, s) for n, s in ((30, 0.05), (12, 0.15), (1, 0.1), (5, 0.0), (40, 0.02))))
    rows = list(enumerate(vectors)) + [(900, None), (901, []), (902, [0.0] * 16), (903, [None] * 16), (904, [float("nan")] * 16), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    got, want = run(spark, rows, **options), brute(rows)
    found, true = sum(n for _, n, _ in got), sum(n for _, n, _ in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and found >= 0.95 * true
    assert [g for g in got if g[0] >= 900] == [w for w in want if w[0] >= 900]


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    extra = [(100_000 + k, [x * 1.5 + 0.001 for x in v]) for k, (_, v) in enumerate(rows[:200])]
    assert run(spark, rows + extra) == brute([(i, np.array(v, np.float32).tolist()) for i, v in rows + extra])


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1e-30, 0.0]), (1, [1e-30, 0.0]), (2, [1e30, 1e29])], "double") == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]
    rows = L.near_duplicates(spark.createDataFrame([(None, [1.0], 3), (4, [1.0], 3)], "vec_id long, embedding array<float>, copies int")).collect()
    assert sorted(map(tuple, rows), key=str) == [(4, 0, 4, True), (None, 0, None, True)]


def test_an_id_may_name_several_vectors(spark):
    rng = np.random.default_rng(8)
    v, w, x = (rng.normal(size=16).astype(np.float32).tolist() for _ in range(3))
    near = (np.array(v, np.float32) * 1.5 + 0.01).tolist()
    rows = [(5, v), (5, w), (9, w), (11, v), (12, near), (5, near), (3, x), (12, x)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert (11, 3, 5) in got and (9, 1, 5) in got
