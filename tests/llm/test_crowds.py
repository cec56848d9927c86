from __future__ import annotations

import random

import numpy as np
import pytest

from dumpwise.llm import ngram_join as J
from dumpwise.llm.crowds import crowded_edges
from dumpwise.llm.graph import roots


def nearness():
    """Numbers at most 1 apart, packed as text (a local function, so that it travels to the workers by value)."""

    def near(left, right):
        a, b = (np.array([int(x) for x in column.to_pylist()]) for column in (left, right))
        return np.abs(a[:, None] - b[None, :]) <= 1

    return near


@pytest.mark.parametrize("tile", [1, 7, 1000])
def test_components_of_crowds(spark, tile):
    rng = random.Random(3)
    rows = [(key, 100 * key + i, str(rng.randrange(60))) for key in (1, 2) for i in range(50)] + [(3, 300 + i, "5") for i in range(40)] + [(4, 400, "1")]
    df = spark.createDataFrame(rows, "cell long, class_id long, value string")
    got = [tuple(r) for r in crowded_edges(df, "cell", "value", nearness(), tile).collect()]
    where = {c: k for k, (_, c, _) in enumerate(rows)}
    want = [(i, j) for i, (x, _, a) in enumerate(rows) for j, (y, _, b) in enumerate(rows) if x == y and abs(int(a) - int(b)) <= 1]
    assert roots(len(rows), [(where[a], where[b]) for a, b in got]) == roots(len(rows), want)
    assert all(where[a] != where[b] for a, b in got)
    # all members of the third group are near its pivot: one edge each and no tiles
    assert sum(300 <= a < 400 for a, _ in got) == 39


def test_templated_texts_below_the_threshold_do_not_become_one_group(spark):
    rng = random.Random(11)
    template = " ".join(f"t{i}" for i in range(60))
    own = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(25))
    texts = [f"{template} {own()}" for _ in range(120)]
    near_copies = [f"{texts[7]} extra", f"{texts[90]} extra"]
    docs = list(enumerate([*texts, *near_copies]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in J.jaccard_join(df, bucket=20).collect()}
    assert got == {i: {7: (1, 7), 120: (1, 7), 90: (1, 90), 121: (1, 90)}.get(i, (0, i)) for i, _ in docs}


def test_empty_crowds(spark):
    df = spark.createDataFrame([], "cell long, class_id long, value string")
    assert crowded_edges(df, "cell", "value", nearness(), 5).collect() == []
