"""Whitening against a plain computation over the distinct points."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybeat.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, weight int, n string, dims int"


def frame(spark, vectors):
    return spark.createDataFrame([(*v, "clash", 1, "clash", 3) for v in vectors], SCHEMA)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    mixing = rng.normal(size=(20, 20))
    rows = [(i, (rng.normal(size=20) @ mixing).astype(np.float32).tolist()) for i in range(400)]
    same = rows[7][1]
    return rows + [(1000 + i, same) for i in range(200)] + [(None, rows[3][1]), (5, rows[5][1]), (5, rows[6][1])]


def plain(vectors, by_count=False):
    x = [tuple(int(np.floor(float(c) * 64)) + 1_000_000 for c in v) for _, v in vectors]
    weights = Counter(x)
    points = np.array(list(weights))
    weight = np.array(list(weights.values())) if by_count else np.ones(len(points), dtype=int)
    n, sums = int(weight.sum()), [sum(int(a) * int(w) for a, w in zip(c, weight)) for c in points.T]
    centred = points - np.array(sums) / n
    values, axes = np.linalg.eigh((centred * weight[:, None]).T @ centred / n)
    return x, n, sums, values[::-1], axes[:, ::-1]


@pytest.mark.parametrize("by_count", [False, True])
def test_against_plain(spark, vectors, by_count):
    x, n, sums, values, axes = plain(vectors, by_count)
    found = whitening.by_component(whitening.whiten(frame(spark, vectors).repartition(3), 16, by_count)).collect()
    assert len(found) == 16 * len(vectors)
    assert {r.n for r in found} == {n}
    assert {r.identity_error for r in found}.pop() < 1e-9 and len({r.identity_error for r in found}) == 1
    signs = {}
    wanted = Counter()
    for (i, _), point in zip(vectors, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(point, sums))
        white = (np.array([a - s / n for a, s in zip(point, sums)]) @ axes[:, :16]) / np.sqrt(values[:16])
        for c, w in enumerate(white, 1):
            wanted[(i, c, deviation, round(abs(w), 5))] += 1
    got = Counter((r.vec_id, r.component, r.deviation, round(abs(r.whitened), 5)) for r in found)
    assert sum((got & wanted).values()) > 0.999 * sum(wanted.values())  # the rest is rounded the other way
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        signs.setdefault(r.component, set())
    one = {(r.component, r.whitened) for r in found if r.vec_id is not None and r.vec_id >= 1000}
    assert len(one) == 16  # equal points, equal results


def test_signs_and_reruns_agree(spark, vectors):
    first = whitening.by_component(whitening.whiten(frame(spark, vectors))).collect()
    second = whitening.by_component(whitening.whiten(frame(spark, vectors).repartition(7))).collect()
    key = lambda r: (repr(r.vec_id), r.component, r.deviation)
    for a, b in zip(sorted(first, key=key), sorted(second, key=key)):
        assert key(a) == key(b) and a.whitened == pytest.approx(b.whitened, abs=1e-8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [1.0, None]), (5, [-inf, 0.0])]
    assert whitening.whiten(frame(spark, bad)).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0
    # One point alone has no variance; an empty vector has no component; lengths are fitted apart.
    rows = bad + [(6, [1.0, 2.0]), (7, [1.0, 2.0]), (8, []), (9, [1.0]), (10, [2.0]), (11, [-1.0])]
    found = whitening.by_component(whitening.whiten(frame(spark, rows))).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in found] == [
        (6, 1, 1, 0), (6, 2, 1, 0), (7, 1, 1, 0), (7, 2, 1, 0), (9, 1, 3, 32**2 * 2**2 * 1), (10, 1, 3, 256**2), (11, 1, 3, 320**2),
    ]
    assert all(r.whitened is None and r.explained == 0 and r.identity_error is None for r in found[:4])
    assert sum(r.whitened for r in found[4:]) == pytest.approx(0) and found[4].explained == pytest.approx(1)


def test_far_values(spark):
    """Exact deviations where products leave 64 bits, and null where digits run out."""
    rows = [(1, [1e9, -3.0]), (2, [-1e9, 5.0]), (3, [0.5, 7.0]), (4, [3e38, 0.0])]
    table = frame(spark, rows[:3])
    x, n, sums, _, _ = plain([(i, np.float32(v)) for i, v in rows[:3]])
    wanted = {i: sum((n * a - s) ** 2 for a, s in zip(p, sums)) for (i, _), p in zip(rows, x)}
    found = {r.vec_id: int(r.deviation) for r in whitening.whiten(table).collect()}
    assert found == wanted
    far = whitening.by_component(whitening.whiten(frame(spark, rows)))
    assert far.filter(F.col("deviation").isNull()).count() == 8
