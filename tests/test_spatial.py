from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lotline.operators import spatial as S


def area(t):
    return abs((t[1][0] - t[0][0]) * (t[2][1] - t[0][1]) - (t[1][1] - t[0][1]) * (t[2][0] - t[0][0])) / 2


def test_ear_clipping_keeps_the_area():
    rng = random.Random(4)
    for n in (3, 5, 8, 20):
        for turn in (1, -1):
            ring = [(math.cos(a) * r, math.sin(a) * r) for a, r in ((2 * math.pi * k / n * turn, rng.uniform(0.3, 2)) for k in range(n))]
            whole = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
            assert sum(map(area, S.ear_clip(ring))) == pytest.approx(whole)
    assert S.ear_clip([(0, 0), (1, 0)]) == []
    assert S.ear_clip([]) == []
    assert sum(map(area, S.ear_clip([(0, 0), (1, 0), (2, 0), (2, 0), (2, 2), (0, 2)]))) == pytest.approx(4)


def test_cells_tile_the_plane():
    rng = np.random.default_rng(2)
    xy = np.r_[rng.random((300, 2)), np.full((400, 2), 0.5)]
    tree = S.CellTree(xy, 16)
    p = rng.random((200, 2)) * 2 - 0.5
    box, cell = tree.of_boxes(p, p)
    assert len(box) == len(p)
    assert (cell[np.argsort(box)] == tree.of_points(p)).all()


def test_triangle_tree_against_all_pairs():
    rng = np.random.default_rng(3)
    tri = (rng.random((150, 1, 2)) + rng.random((150, 3, 2)) * 0.2).reshape(-1, 6)
    xy = rng.random((400, 2))
    p, t = S.TriangleTree(tri).probe(xy)
    got = set(zip(p.tolist(), t.tolist(), strict=True))
    want = set()
    for j, c in enumerate(tri.reshape(-1, 3, 2)):
        for i, q in enumerate(xy):
            s = [(c[(k + 1) % 3][0] - c[k][0]) * (q[1] - c[k][1]) - (c[(k + 1) % 3][1] - c[k][1]) * (q[0] - c[k][0]) for k in range(3)]
            if all(v >= 0 for v in s) or all(v <= 0 for v in s):
                want.add((i, j))
    assert got == want


def test_near_points(spark, monkeypatch):
    rng = random.Random(5)
    pts = [(f"p{k}", -74 + rng.random() * 0.01, 40.7 + rng.random() * 0.01) for k in range(300)] + [("hot", -73.995, 40.705)] * 200
    pts += [("none", None, 40.0), ("nan", float("nan"), 40.7), ("half", -74.0, None)]
    places = [(f"b{k}", -74 + rng.random() * 0.01, 40.7 + rng.random() * 0.01) for k in range(200)] + [(f"c{k}", -73.995, 40.705) for k in range(50)]
    places += [(None, -74.0, 40.7), ("x", None, None), ("b0", -74.5, 40.2)]
    p = spark.createDataFrame(pts, "id string, x double, y double")
    q = spark.createDataFrame(places, "place string, x double, y double").withColumnRenamed("extra", "extra")
    want = set()
    for _, x, y in pts:
        for b, bx, by in places:
            if None not in (x, y, b, bx, by) and x == x and S.haversine(y, x, by, bx) <= 60:
                want.add((x, y, b))
    for triangles, points in ((S.UNIT_TRIANGLES, S.UNIT_POINTS), (40, 40)):  # the second cuts cells and blocks
        monkeypatch.setattr(S, "UNIT_TRIANGLES", triangles)
        monkeypatch.setattr(S, "UNIT_POINTS", points)
        got = S.near_points(p, q, 60).collect()
        assert {(r.x, r.y, r.place) for r in got} == want
        assert len(got) == len(want)
    assert S.near_points(p.limit(0), q, 60).count() == 0
    assert S.near_points(p, q.limit(0), 60).count() == 0


def test_regions_share_boundaries(spark):
    square = lambda x: [(x, 0.0), (x + 1.0, 0.0), (x + 1.0, 1.0), (x, 1.0)]
    rings = [("b", square(1.0)), ("a", square(0.0)), ("hole", [(5.0, 5.0), (6.0, 5.0)]), (None, square(0.0)), ("l", [(10.0, 0.0), (12.0, 0.0), (12.0, 1.0), (11.0, 1.0), (11.0, 2.0), (10.0, 2.0)])]
    regions = spark.createDataFrame([(r, [dict(x=x, y=y) for x, y in ring]) for r, ring in rings], "region string, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(0.5, 0.5), (0.5, 0.5), (1.0, 0.5), (1.5, 0.5), (9.0, 9.0), (11.5, 1.5), (10.5, 1.5), (11.0, 1.0)], "x double, y double")
    first = {(r.x, r.y): r.region for r in S.containing_regions(pts, regions).collect()}
    assert first == {(0.5, 0.5): "a", (1.0, 0.5): "a", (1.5, 0.5): "b", (10.5, 1.5): "l", (11.0, 1.0): "l"}
    every = S.containing_regions(pts, regions, "all").where("x = 1.0 and y = 0.5").collect()
    assert {r.region for r in every} == {"a", "b"}


def test_holes_and_several_polygons(spark):
    square = lambda x, y, s: [dict(x=x + a * s, y=y + b * s) for a, b in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]
    rows = [("a", square(0.0, 0.0, 10.0), [square(2.0, 2.0, 2.0), square(6.0, 5.0, 3.0)]), ("a", square(20.0, 0.0, 1.0), None), ("bad", [dict(x=0.0, y=0.0), dict(x=1.0, y=1.0), dict(x=1.0, y=0.0), dict(x=0.0, y=1.0)], None), ("half", [dict(x=0.0, y=None)] * 3, []), ("out", square(0.0, 30.0, 1.0), [square(50.0, 50.0, 1.0)])]
    p = "array<struct<x:double,y:double>>"
    regions = spark.createDataFrame(rows, f"region string, ring {p}, holes array<{p}>")
    rng = random.Random(6)
    pts = [(rng.uniform(-1, 11), rng.uniform(-1, 11)) for _ in range(400)] + [(2.0, 3.0), (4.0, 4.0), (20.5, 0.5), (10.0, 10.0), (3.0, 2.0), (6.0, 6.0)]
    inside = lambda x, y: (0 <= x <= 10 and 0 <= y <= 10 and not (2 < x < 4 and 2 < y < 4) and not (6 < x < 9 and 5 < y < 8)) or (20 <= x <= 21 and 0 <= y <= 1)
    got = {(r.x, r.y) for r in S.containing_regions(spark.createDataFrame(pts, "x double, y double"), regions.where("region = 'a'")).collect()}
    assert got == {q for q in pts if inside(*q)}
    errors = {r.region: r.error for r in S.bad_regions(regions).collect()}
    assert set(errors) == {"bad", "half"} or set(errors) == {"bad", "half", "out"}
    assert S.containing_regions(spark.createDataFrame(pts, "x double, y double"), regions).count() == len(got)


def test_no_point_falls_between_triangles():
    """Points on and beside slanted shared edges of big coordinates lie in at least one triangle."""
    rng = random.Random(8)
    ring = [(-73.0 - math.cos(2 * math.pi * k / 17) * r, 40.0 + math.sin(2 * math.pi * k / 17) * r) for k, r in ((k, rng.uniform(0.2, 1)) for k in range(17))]
    tri = np.array(S.ear_clip(ring)).reshape(-1, 6)
    pts = []
    for t in tri.reshape(-1, 3, 2):
        for i in range(3):
            for _ in range(40):
                w = rng.random()
                pts.append(t[i] * w + t[(i + 1) % 3] * (1 - w))
    edges = {tuple(sorted((tuple(a), tuple(b)))) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)}
    inner = [k for k, q in enumerate(pts) if tuple(sorted((tuple(tri.reshape(-1, 3, 2)[k // 120][k // 40 % 3]), tuple(tri.reshape(-1, 3, 2)[k // 120][(k // 40 + 1) % 3])))) not in edges]
    p, _ = S.TriangleTree(tri).probe(np.array(pts))
    assert len(inner) > 500
    assert set(inner) <= set(p.tolist())


def test_cells_grow_with_the_data(spark, monkeypatch):
    """Far more cells than 4,096 for as many units of points, and no pair is lost."""
    monkeypatch.setattr(S, "UNIT_POINTS", 1)
    pts = spark.range(6000).selectExpr("-74 + (id % 80) * 0.001 as x", "40.5 + floor(id / 80) * 0.001 as y")
    places = spark.createDataFrame([("a", -73.97, 40.52), ("b", -73.99, 40.51)], "place string, x double, y double")
    assert {r.place for r in S.near_points(pts, places, 5).collect()} == {"a", "b"}
