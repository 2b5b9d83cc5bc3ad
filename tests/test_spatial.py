"""Points within a distance and regions, against brute force."""

import numpy as np
import pytest

from sthalam.operators import spatial as P

SCHEMA = "point_id bigint, latitude double, longitude double, leaf string, km string"


def brute(points, km):
    ok = [(k, a, b) for k, a, b in points if k is not None and a is not None and b is not None]
    return {(min(p, q), max(p, q)) for i, (p, a, b) in enumerate(ok) for q, c, d in ok[i + 1 :] if p != q and P.great_circle_km(np.array(a), np.array(b), np.array(c), np.array(d)) <= km}


def test_pairs_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAF_PLACES", 40)
    r = np.random.default_rng(1)
    centres = r.uniform([8, 70], [35, 95], (6, 2))
    points = [(i, *(centres[i % 6] + r.normal(0, 0.02, 2)).round(3).tolist()) for i in range(700)]
    points += [(900 + i, 20.0, 80.0) for i in range(30)] + [(950, None, 80.0), (951, 20.0, None), (None, 20.0, 80.0), (952, float("nan"), 80.0)]
    d = spark.createDataFrame([(*p, "x", "y") for p in points], SCHEMA)
    got = [(x["point_id_a"], x["point_id_b"]) for x in P.pairs_within(d, 1.5, box=(6, 38, 68, 98)).collect()]
    want = brute([p for p in points if p[1] is None or p[1] == p[1]], 1.5)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000


@pytest.mark.parametrize("rows", [[], [(1, 10.0, 70.0, "", "")], [(1, 10.0, 70.0, "", ""), (1, 10.0, 70.0, "", "")]])
def test_no_pairs(spark, rows):
    assert P.pairs_within(spark.createDataFrame(rows, SCHEMA), 5).count() == 0


def test_close_pairs_exact():
    r = np.random.default_rng(2)
    for n in (0, 1, 2, 25, 300):
        v = r.uniform(0, 1, (n, 3))
        got = {(min(i, j), max(i, j)) for a, b in P.close_pairs(v, 0.2) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
        assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if ((v[i] - v[j]) ** 2).sum() <= 0.04}


def inside(y, x, ring):
    odd = False
    for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) <= x:
            odd = not odd
    return odd


def test_regions(spark):
    r = np.random.default_rng(3)
    star = [(10 + (3 if k % 2 else 7) * np.sin(k * np.pi / 6), 80 + (3 if k % 2 else 7) * np.cos(k * np.pi / 6)) for k in range(12)]
    regions = [("star", [(float(a), float(b)) for a, b in star]), ("box", [(5.0, 75.0), (5.0, 81.0), (12.0, 81.0), (12.0, 75.0)])]
    points = [(i, *r.uniform([0, 70], [20, 90]).tolist()) for i in range(500)] + [(600, None, 80.0)]
    d = spark.createDataFrame([(*p, "x", "y") for p in points], SCHEMA)
    got = {(x["point_id"], x["region"]) for x in P.regions_of(d, regions).collect()}
    assert got == {(k, n) for k, y, x in points if y is not None for n, ring in regions if inside(y, x, ring)} and len(got) > 100
    assert P.regions_of(d.limit(0), regions).count() == 0
