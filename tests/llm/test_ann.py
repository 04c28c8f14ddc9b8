import numpy as np
from quarry.llm import ann


def test_recall_and_order(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    recall = []
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -9
        want = np.lexsort((np.arange(1500), -s))[:20]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 21)) and all(abs(v - s[k]) < 1e-12 for _, k, v in own)
        recall.append(len({k for _, k, _ in own} & set(want.tolist())) / 20)
    assert len(got) == 75 and np.mean(recall) >= 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (3, [0.5, 0.5]), (60, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, v int, score int")
    got = {}
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got[0] == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 0.5), (4, 20, 0.0), (5, 60, -1.0)]
    assert got[20] == [(1, 3, 1.0), (2, 0, 0.0), (3, 1, 0.0), (4, 2, 0.0), (5, 60, 0.0)]
    assert set(got) == {0, 20, 60}
    assert ann.nearest(df.limit(0)).collect() == []


def test_many_copies(spark):
    """A third of the rows hold one vector: ties go to the smaller ids."""
    rng = np.random.default_rng(1)
    rows = [(k, [1.0, 0.0, 0.0, 0.0] if k % 3 == 0 else [float(c) for c in rng.normal(size=4) / 9]) for k in range(900)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("query_id = 60").orderBy("rank").collect()
    assert [r.vec_id for r in got] == [k for k in range(0, 900, 3) if k != 60][:20]


def _recall(spark, x):
    n = len(x)
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in range(0, n, 20):
        s = x @ x[q]
        s[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-s)[:20].tolist())) / 20)
    return np.mean(recall)


def test_recall_of_varying_lengths(spark):
    """Long vectors win by inner product, also from outside the nearest share by angle."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for sigma in (0.25, 0.5, 1.0, 2.0):
        assert _recall(spark, x * np.exp(sigma * rng.normal(size=(4000, 1)))) >= 0.95
