"""Components with hubs and long chains, and joins of hot keys, against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import common, components
from tablewright.llm.common import join_counted, stage
from tablewright.llm.components import connected_components


def plain_roots(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            one, two = root(a), root(b)
            parent[max(one, two)] = min(one, two)
    return {x: root(x) for x in parent}


def graphs():
    dice = random.Random(3)
    hub = [(5000, i) for i in range(900)]  # the hub has the greatest number, so labels travel through it
    chain = [(10_000 + i, 10_001 + i) for i in range(60)]
    loose = [(dice.randint(20_000, 20_300), dice.randint(20_000, 20_300)) for _ in range(120)]
    return {
        "hub": hub,
        "two hubs": hub + [(6000, 2000 + i) for i in range(700)] + [(6000, 17)],
        "chain": chain,
        "all": [*hub, *chain, *loose, (7, 7), (None, 3), (4, None), *loose[:9]],
        "none": [],
    }


@pytest.mark.parametrize("hot", [5, 500])
@pytest.mark.parametrize("name", sorted(graphs()))
def test_components(spark, monkeypatch, name, hot):
    monkeypatch.setattr(common, "HOT", hot)
    edges = graphs()[name]
    random.Random(1).shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4))
    assert {r.node: r.root for r in found.collect()} == plain_roots(edges)


def test_join_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 10)
    rows = [(1, i) for i in range(300)] + [(k, -k) for k in range(2, 40)] + [(None, 0), (99, 1)]
    counts = Counter(k for k, _ in rows)
    table = stage(spark.createDataFrame([(k, f"v{k}", counts[k]) for k in [*range(1, 40), 500]], "k int, v string, n long"))
    found = join_counted(stage(spark.createDataFrame(rows, "k int, i int")), table, ["k"], "n").select("k", "i", "v").collect()
    assert Counter(map(tuple, found)) == Counter((k, i, f"v{k}") for k, i in rows if k is not None and k < 40)


@pytest.mark.parametrize("seed", range(20))
def test_stars_of_a_block(seed):
    dice = np.random.default_rng(seed)
    a, b = dice.integers(-40, 40, (2, dice.integers(1, 80)))
    node, root = components._stars(a, b)
    want = plain_roots(list(zip(a.tolist(), b.tolist(), strict=True)))
    found = dict(zip(node.tolist(), root.tolist(), strict=True))
    assert {**{r: r for r in root.tolist()}, **found} == want


def test_small_graphs_take_few_tables_and_tasks(spark, monkeypatch):
    """No task for each shuffle partition, and no round that only finds that the last one has changed nothing."""
    edges = [(2 * i, 2 * i + 1) for i in range(1000)]
    random.Random(5).shuffle(edges)
    tables = []

    def counted(df, label):
        tables.append((label, stage(df, label)))
        return tables[-1][1]

    monkeypatch.setattr(components, "stage", counted)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("97", "false"), strict=True):
            spark.conf.set(k, v)
        found = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(60))
        assert {r.node: r.root for r in found.collect()} == plain_roots(edges)
        assert [label for label, _ in tables] == ["links", "edges", "labels", "lower"]
        assert max(len(t.inputFiles()) for label, t in tables if label != "links") <= spark.sparkContext.defaultParallelism
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    edges = graphs()["all"]
    for block in (1, 7):
        monkeypatch.setattr(components, "BLOCK", block)
        batches = spark.createDataFrame(edges, "a long, b long").dropna().toArrow().to_batches()
        made = [pair for b in components._united(iter(batches)) for pair in zip(*b.to_pydict().values(), strict=True)]
        assert plain_roots(made) == plain_roots(edges)
