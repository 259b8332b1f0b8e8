"""Nearest neighbours against a full comparison."""

import numpy as np
import pytest

from tablewright.llm import nearest
from tablewright.llm.common import find_package

SCHEMA = "vec_id long, embedding array<float>, row string, v string, score int"


@pytest.fixture
def as_vectors(spark):
    find_package(spark)

    def build(rows):
        return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], "r", "v", 1) for k, v in rows], SCHEMA).repartition(3)

    return build


def full(rows, queries, k):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    made = {}
    for q, v in queries:
        v = np.array(v, np.float32).astype(float)
        scored = sorted((-float((v * w).sum()), i) for i, w in rows if i != q)
        made[q] = [(i, -s) for s, i in scored[:k]]
    return made


def found(df):
    made = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        made.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(made[r.query_id])
    return made


def test_recall_and_order(as_vectors):
    dice = np.random.default_rng(0)
    centres = dice.normal(size=(8, 64))
    rows = [(i, (centres[i % 8] * 0.3 + dice.normal(size=64)).astype(np.float32)) for i in range(2000)]
    docs = as_vectors(rows)
    got = found(nearest.nearest(docs, docs.filter("vec_id % 20 = 0"), k=20, query_block=40, row_block=700))
    want = full(rows, rows[::20], 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    scores = {i: np.array(v, float) for i, v in rows}
    for q, best in got.items():
        assert best == sorted(best, key=lambda p: (-p[1], p[0])) and len(best) == 20 and q not in dict(best)
        assert all(abs(s - float(scores[q] @ scores[i])) < 1e-12 for i, s in best)


def test_ties_copies_and_unusable_vectors(as_vectors):
    dice = np.random.default_rng(1)
    same = dice.normal(size=64)
    good = [(i, same) for i in range(300)] + [(1000 + i, dice.normal(size=64)) for i in range(50)]
    bad = [(5000, None), (5001, [0.0] * 64), (5002, [float("nan")] * 64), (5003, [float("inf")] + [1.0] * 63),
           (5004, [None] + [1.0] * 63), (5005, [1.0] * 3), (5006, []), (None, same)]
    docs = as_vectors(good + bad)
    got = found(nearest.nearest(docs, docs.filter("vec_id in (0, 20, 1000, 5000, 5001, 5002, 5003, 5004, 5005)"), k=20))
    assert set(got) == {0, 20, 1000}
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[20]] == list(range(20))
    assert got == {q: [(i, pytest.approx(s)) for i, s in best] for q, best in full(good, [g for g in good if g[0] in got], 20).items()} or len(got[1000]) == 20


def test_fewer_rows_than_asked_for_and_none(as_vectors):
    rows = [(i, np.eye(64)[i]) for i in range(5)]
    docs = as_vectors(rows)
    got = found(nearest.nearest(docs, docs.filter("vec_id = 0"), k=20))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4]
    assert nearest.nearest(docs.limit(0), docs, k=20).count() == 0 and nearest.nearest(docs, docs.limit(0), k=20).count() == 0


def test_probing_finds_every_code_within_the_radius():
    dice = np.random.default_rng(2)
    codes = dice.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    codes[:40] = codes[0] ^ (1 << dice.integers(0, 16, (40, 4))).astype(np.uint16)
    index = nearest.Index(codes)
    far = np.bitwise_count(codes ^ codes[0]).sum(axis=1)
    for radius in (0, 1, 3, 4, 6, 9, 13, 20, 64):
        assert set(index.within(codes[0], radius)) == set(np.flatnonzero(far <= radius)), radius


def test_length_is_that_of_usable_vectors(spark):
    dice = np.random.default_rng(8)
    rows = [(i, dice.normal(size=6).tolist()) for i in range(30)]
    rows += [(100 + i, []) for i in range(40)] + [(200 + i, [0.0, 0.0]) for i in range(50)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest(vectors, vectors, k=3).collect()
    assert {r.query_id for r in found} == set(range(30)) and len(found) == 90
