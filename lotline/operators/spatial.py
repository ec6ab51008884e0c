"""Points near other points or inside regions.

Regions are polygons cut into triangles by ear clipping; a disc around a point is a region too (a hexagon around it,
its triangles from one clipped template). Triangles are distributed through two bounding-volume hierarchies: an upper
one, whose leaves are cells of the plane and become the units of work, and one over the triangles of a cell. Candidate
triangles are tested exactly and assignments that several triangles or regions share are made once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.session import cut, ship

EARTH_M = 6_371_000.0
#: Rows drawn from each side to place the cuts of the upper hierarchy, and for each cell; they shape the balance, never the result.
SAMPLE_ROWS, SAMPLE_PER_CELL = 20_000, 4
#: The most cells, for what the driver draws and sends; beyond it, cells get blocks of triangles and points instead.
MAX_CELLS = 131_072
#: Points probed at a time in one unit, so that candidate pairs are tested and dropped in slices.
SLICE = 32_768
#: Triangles and points aimed at for one unit of work.
UNIT_TRIANGLES, UNIT_POINTS = 24_000, 150_000
TRIANGLE = "ax double, ay double, bx double, by double, cx double, cy double"
CORNERS = ["ax", "ay", "bx", "by", "cx", "cy"]


def _crosses(a, b, c, d) -> bool:
    """Whether two segments meet in a point inside both."""
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    s1, s2, s3, s4 = side(a, b, c), side(a, b, d), side(c, d, a), side(c, d, b)
    return (s1 > 0) != (s2 > 0) and (s3 > 0) != (s4 > 0) and 0 not in (s1, s2, s3, s4)


def with_holes(outer: list[tuple[float, float]], holes: list[list[tuple[float, float]]]) -> list[tuple[float, float]]:
    """One ring for a polygon with holes: each hole is cut open and joined to the ring by a bridge walked both ways.

    Holes are joined from the right; a bridge goes to the nearest corner that can be seen.
    """
    turn = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True))
    ring = list(outer) if turn(outer) > 0 else list(outer)[::-1]
    inner = [list(h) if turn(h) < 0 else list(h)[::-1] for h in holes if len(h) >= 3]
    for n, hole in enumerate(sorted(inner, key=lambda h: -max(h)[0])):
        rest = [h for h in sorted(inner, key=lambda h: -max(h)[0])[n:]]
        start = max(range(len(hole)), key=lambda i: hole[i])
        at = hole[start]
        edges = [(r[i - 1], r[i]) for r in [ring, *rest] for i in range(len(r))]
        for k in sorted(range(len(ring)), key=lambda i: (ring[i][0] - at[0]) ** 2 + (ring[i][1] - at[1]) ** 2):
            if not any(_crosses(at, ring[k], a, b) for a, b in edges):
                break
        else:
            raise ValueError("a hole lies outside its polygon")
        ring = [*ring[: k + 1], *hole[start:], *hole[: start + 1], *ring[k:]]
    return ring


def ear_clip(ring: list[tuple[float, float]]) -> list[tuple[tuple[float, float], ...]]:
    """Triangles of a simple polygon; repeated and collinear corners are dropped, fewer than three give none."""
    pts = [p for i, p in enumerate(ring) if p != ring[i - 1]] if len(ring) > 1 else list(ring)
    cross = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    if sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:] + pts[:1], strict=True)) < 0:
        pts.reverse()
    out = []
    while len(pts) >= 3:
        for i in range(len(pts)):
            a, b, c = pts[i - 1], pts[i], pts[(i + 1) % len(pts)]
            turn = cross(a, b, c)
            if turn == 0:  # a corner on a line adds no area
                del pts[i]
                break
            inside = (p for p in pts if p not in (a, b, c))
            if turn > 0 and not any(cross(a, b, p) >= 0 and cross(b, c, p) >= 0 and cross(c, a, p) >= 0 for p in inside):
                out.append((a, b, c))
                del pts[i]
                break
        else:
            raise ValueError("the polygon crosses itself")
    return out


def haversine(lat1, lon1, lat2, lon2):
    """Metres on a sphere of radius 6,371,000 m, for arrays in degrees."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


class CellTree:
    """The upper hierarchy: median cuts of a sample into cells that tile the plane."""

    def __init__(self, xy: np.ndarray, cells: int) -> None:
        self.axis: list[int] = []
        self.at: list[float] = []
        self.kids: list[tuple[int, int]] = []
        self.leaves = 0
        self._grow(xy, cells)

    def _grow(self, xy: np.ndarray, cells: int) -> int:
        me = len(self.axis)
        self.axis.append(-1)
        self.at.append(0.0)
        self.kids.append((self.leaves, -1))
        if cells > 1 and len(xy) > 1:
            axis = int(np.argmax(np.ptp(xy, axis=0)))
            value = float(np.median(xy[:, axis]))
            low = xy[:, axis] < value
            if not low.any():  # the median is the least value: cut above it
                above = xy[:, axis] > value
                value = float(xy[above, axis].min()) if above.any() else value
                low = ~above if above.any() else low
            if low.any():
                self.axis[me], self.at[me] = axis, value
                self.kids[me] = (self._grow(xy[low], cells // 2), self._grow(xy[~low], cells - cells // 2))
                return me
        self.leaves += 1
        return me

    def arrays(self):
        return np.array(self.axis), np.array(self.at), np.array(self.kids)

    def of_points(self, xy: np.ndarray) -> np.ndarray:
        axis, at, kids = self.arrays()
        node = np.zeros(len(xy), np.int64)
        while (live := axis[node] >= 0).any():
            n = node[live]
            right = xy[live, axis[n]] >= at[n]
            node[live] = np.where(right, kids[n, 1], kids[n, 0])
        return kids[node, 0]

    def of_boxes(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(box, cell) of every cell that a box touches."""
        axis, at, kids = self.arrays()
        box, node, out = np.arange(len(lo)), np.zeros(len(lo), np.int64), []
        while box.size:
            leaf = axis[node] < 0
            out.append((box[leaf], kids[node[leaf], 0]))
            box, node = box[~leaf], node[~leaf]
            left = lo[box, axis[node]] < at[node]
            right = hi[box, axis[node]] >= at[node]
            box, node = np.r_[box[left], box[right]], np.r_[kids[node[left], 0], kids[node[right], 1]]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class TriangleTree:
    """The lower hierarchy over the triangles of one cell: boxes over a space-filling order."""

    WIDTH = 4

    def __init__(self, tri: np.ndarray, exact: bool = True) -> None:
        """``exact``: triangles that share an edge compute the same number for it, with opposite sign, so that no point
        on it or beside it falls between them."""
        self.exact = exact
        x, y = tri[:, 0::2], tri[:, 1::2]
        lo, hi = np.c_[x.min(1), y.min(1)], np.c_[x.max(1), y.max(1)]
        mid = (lo + hi) / 2
        span = np.ptp(mid, axis=0)
        q = ((mid - mid.min(0)) / np.where(span > 0, span, 1) * 65535).astype(np.uint64)
        self.order = np.argsort(_spread(q[:, 0]) | (_spread(q[:, 1]) << np.uint64(1)), kind="stable")
        self.tri = tri[self.order]
        self.lo, self.hi = [lo[self.order]], [hi[self.order]]
        while len(self.lo[-1]) > 1:
            at = np.arange(0, len(self.lo[-1]), self.WIDTH)
            self.lo.append(np.minimum.reduceat(self.lo[-1], at))
            self.hi.append(np.maximum.reduceat(self.hi[-1], at))

    def probe(self, xy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, triangle) of the points in or on a triangle."""
        p, node = np.arange(len(xy)), np.zeros(len(xy), np.int64)
        for level in range(len(self.lo) - 1, -1, -1):
            hit = ((xy[p] >= self.lo[level][node]) & (xy[p] <= self.hi[level][node])).all(1)
            p, node = p[hit], node[hit]
            if level:
                p = np.repeat(p, self.WIDTH)
                node = (node[:, None] * self.WIDTH + np.arange(self.WIDTH)).ravel()
                there = node < len(self.lo[level - 1])
                p, node = p[there], node[there]
        t, x, y = self.tri[node], xy[p, 0], xy[p, 1]

        def side(i: int, j: int) -> np.ndarray:
            ax, ay, bx, by = t[:, i], t[:, i + 1], t[:, j], t[:, j + 1]
            if not self.exact:
                return (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            swap = (ax > bx) | ((ax == bx) & (ay > by))
            ax, bx = np.where(swap, bx, ax), np.where(swap, ax, bx)
            ay, by = np.where(swap, by, ay), np.where(swap, ay, by)
            s = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            return np.where(swap, -s, s)

        s = np.c_[side(0, 2), side(2, 4), side(4, 0)]
        inside = (s >= 0).all(1) | (s <= 0).all(1)
        return p[inside], self.order[node[inside]]


def _spread(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


def _numpy(t: pa.Table | pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([t.column(n).to_numpy() if isinstance(t, pa.Table) else t.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1) if t.num_rows else np.empty((0, len(names)))


def _clipped(row: dict) -> list[tuple[tuple[float, float], ...]]:
    corners = lambda ring: [(p["x"], p["y"]) for p in ring]
    outer, holes = corners(row["ring"]), [corners(h) for h in row.get("holes") or []]
    if any(v is None or v != v for ring in [outer, *holes] for p in ring for v in p):
        raise ValueError("a corner lacks a coordinate")
    return ear_clip(with_holes(outer, holes) if holes and len(outer) >= 3 else outer)


def _polygons(regions: DataFrame) -> DataFrame:
    return regions.select("region", "ring", *(["holes"] if "holes" in regions.columns else [])).where("region is not null and ring is not null")


def triangles_of(regions: DataFrame) -> DataFrame:
    """(region, corners) from (region string, ring array<struct<x,y>>[, holes array<array<struct<x,y>>>]).

    A region of several polygons has several rows. NULL regions and rings with no area give none; a polygon that cannot
    be cut (its ring crosses itself, a hole lies outside, a corner is missing) gives none either and is told by ``bad_regions``.
    """
    ship(regions.sparkSession)

    def clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = [], []
            for row in b.to_pylist():
                try:
                    made = _clipped(row)
                except ValueError:
                    continue
                for tri in made:
                    ids.append(row["region"])
                    rows.append([v for p in tri for v in p])
            a = np.array(rows, float).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), *[pa.array(a[:, i]) for i in range(6)]], names=["region", *CORNERS])

    return _polygons(regions).mapInArrow(clip, f"region string, {TRIANGLE}")


def bad_regions(regions: DataFrame) -> DataFrame:
    """(region, error) of each polygon that cannot be cut into triangles."""
    ship(regions.sparkSession)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                try:
                    _clipped(row)
                except ValueError as e:
                    out.append((row["region"], str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in range(2)], names=["region", "error"])

    return _polygons(regions).mapInArrow(tell, "region string, error string")


def disc_triangles(centres: DataFrame, metres: float) -> DataFrame:
    """(region, corners, cx0, cy0): a hexagon around each centre (region, x, y) that holds its whole disc."""
    ring = [(math.cos(math.pi / 3 * k), math.sin(math.pi / 3 * k)) for k in range(6)]
    template = np.array(ear_clip(ring)).reshape(-1, 6)
    out = metres * 1.002 / math.cos(math.pi / 6)  # a little more, for the bend of the parallels
    deg = math.degrees(out / EARTH_M)

    ship(centres.sparkSession)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xy = _numpy(b, ["x", "y"])
            wide = deg / np.cos(np.radians(np.minimum(np.abs(xy[:, 1]) + deg, 89.0)))
            k = len(template)
            a = np.repeat(xy, k, axis=0)[:, [0, 1] * 3] + np.tile(template, (len(xy), 1)) * np.stack([np.repeat(wide, k), np.full(len(xy) * k, deg)] * 3, axis=1)
            ids = b.column("region").take(pa.array(np.repeat(np.arange(len(xy)), k)))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(a[:, i]) for i in range(6)], pa.array(np.repeat(xy[:, 0], k)), pa.array(np.repeat(xy[:, 1], k))], names=["region", *CORNERS, "cx0", "cy0"])

    return centres.select("region", "x", "y").mapInArrow(place, f"region string, {TRIANGLE}, cx0 double, cy0 double")


def probe_points(points: DataFrame, triangles: DataFrame, metres: float | None = None, shape: tuple[int, DataFrame] | None = None) -> DataFrame:
    """(x, y, region[, metres]) for distinct points in a region; with ``metres`` only within it of the region's centre.

    ``points`` (x, y) are made distinct first, so a place that holds a third of all rows is probed once. Each point
    lies in one cell, each triangle goes to the cells it touches, so every pair meets in exactly one unit of work.
    There are as many cells as the data asks for, up to MAX_CELLS; those that the sample shows to be heavy (many regions
    at one place, or more data than cells) are cut into blocks of triangles and of points.
    ``shape`` gives the number of triangles and points (x, y) to draw their sample from, where these are known more cheaply.
    """
    ship(points.sparkSession)
    spots = cut(points.select(F.col("x").cast("double"), F.col("y").cast("double")).where("x is not null and y is not null and not isnan(x) and not isnan(y)").distinct())
    fields = ["region", *CORNERS] + (["cx0", "cy0"] if metres is not None else [])
    triangles = triangles.select(*fields)
    out = "x double, y double, region string" + (", metres double" if metres is not None else "")
    spark = points.sparkSession

    n_t, n_p = shape[0] if shape else triangles.count(), spots.count()
    if not n_t or not n_p:
        return spark.createDataFrame([], out)
    cells = int(min(MAX_CELLS, max(12, n_t // UNIT_TRIANGLES, n_p // UNIT_POINTS)))
    wanted = max(SAMPLE_ROWS, SAMPLE_PER_CELL * cells)
    draw = lambda df, n: np.array([tuple(r) for r in df.sample(min(1.0, wanted / n), seed=7).limit(2 * wanted).collect()], float).reshape(-1, 2)
    middles = shape[1] if shape else triangles.select((F.col("ax") + F.col("bx") + F.col("cx")) / 3, (F.col("ay") + F.col("by") + F.col("cy")) / 3)
    st = draw(middles, n_t)
    sp = draw(spots, n_p)
    tree = CellTree(np.r_[st, sp] if len(st) + len(sp) else np.zeros((1, 2)), cells)
    share = lambda xy, n: np.bincount(tree.of_points(xy), minlength=tree.leaves) * (n / max(1, len(xy))) if len(xy) else np.zeros(tree.leaves)
    t_blocks = np.maximum(1, np.ceil(share(st, n_t) / (4 * UNIT_TRIANGLES))).astype(int)
    p_blocks = np.maximum(1, np.ceil(share(sp, n_p) / (4 * UNIT_POINTS))).astype(int)

    def send(cell: np.ndarray, own: np.ndarray, other: np.ndarray, mark: np.ndarray):
        """Row numbers and units: a row goes to its own block of the cell, once for each block of the other side.

        ``mark`` comes from the row's content alone, so a task that runs again sends it to the same units.
        """
        reps = other[cell]
        row = np.repeat(np.arange(cell.size), reps)
        k = np.arange(row.size) - np.repeat(np.cumsum(reps) - reps, reps)
        return row, cell[row], (mark[row] % own[cell[row]]), k

    def cut_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = _numpy(b, CORNERS)
            x, y = a[:, 0::2], a[:, 1::2]
            if not len(a):
                continue
            box, cell = tree.of_boxes(np.c_[x.min(1), y.min(1)], np.c_[x.max(1), y.max(1)])
            mark = np.zeros(len(a), np.int64)
            if (t_blocks > 1).any():
                mark = np.array([zlib.crc32(r.encode()) for r in b.column("region").to_pylist()], np.int64)
            row, cell, own, other = send(cell, t_blocks, p_blocks, mark[box])
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(box[row])).columns, pa.array(cell), pa.array(own), pa.array(other)], names=[*fields, "cell", "tb", "pb"])

    def cut_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xy = _numpy(b, ["x", "y"])
            if not len(xy):
                continue
            cell = tree.of_points(xy)
            bits = xy.copy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            row, cell, own, other = send(cell, p_blocks, t_blocks, ((bits[:, 0] ^ (bits[:, 1] >> np.uint64(7))) >> np.uint64(40)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(row)).columns, pa.array(cell), pa.array(other), pa.array(own)], names=["x", "y", "cell", "tb", "pb"])

    def meet(pts: pa.Table, tris: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in out.split(", ")]
        xy, a = _numpy(pts, ["x", "y"]), _numpy(tris, CORNERS)
        codes = tris.column("region").combine_chunks().dictionary_encode() if tris.num_rows else pa.array([], pa.string()).dictionary_encode()
        parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(xy) and len(a):
            tree, own, centre = TriangleTree(a, metres is None), codes.indices.to_numpy(), _numpy(tris, ["cx0", "cy0"]) if metres is not None else None
            for k in range(0, len(xy), SLICE):
                p, t = tree.probe(xy[k : k + SLICE])
                p, region, d = p + k, own[t], np.zeros(len(p))
                if metres is not None:
                    at = centre[t]
                    d = haversine(xy[p, 1], xy[p, 0], at[:, 1], at[:, 0])
                    near = d <= metres
                    p, region, d = p[near], region[near], d[near]
                # a region's triangles share edges: each (point, region) once, at its least distance
                order = np.lexsort((d, region, p))
                p, region, d = p[order], region[order], d[order]
                first = np.ones(len(p), bool)
                first[1:] = (p[1:] != p[:-1]) | (region[1:] != region[:-1])
                parts.append((p[first], region[first], d[first]))
        p, region, d = (np.concatenate(x) for x in zip(*parts, strict=True))
        cols = [pa.array(xy[p, 0]), pa.array(xy[p, 1]), codes.dictionary.take(pa.array(region, pa.int64()))]
        return pa.Table.from_arrays(cols + ([pa.array(d)] if metres is not None else []), names=names)

    unit = "cell bigint, tb bigint, pb bigint"
    kinds = ", ".join(f"{f} {'string' if f == 'region' else 'double'}" for f in fields)
    left = spots.mapInArrow(cut_points, f"x double, y double, {unit}").groupBy("cell", "tb", "pb")
    right = triangles.mapInArrow(cut_triangles, f"{kinds}, {unit}").groupBy("cell", "tb", "pb")
    found = left.cogroup(right).applyInArrow(meet, out)
    # blocks of one cell may hold triangles of the same region
    if (t_blocks > 1).any():
        found = found.groupBy("x", "y", "region").agg(F.min("metres").alias("metres")) if metres is not None else found.distinct()
    return found


def near_points(points: DataFrame, places: DataFrame, metres: float) -> DataFrame:
    """(x, y, place, metres) for distinct points within ``metres`` of a place (place string, x, y in degrees).

    Rows with a NULL or NaN coordinate on either side, or a NULL place, have no partner. A place with several rows
    counts with its nearest. Ties all come out. Extra columns are ignored.
    """
    ok = "x is not null and y is not null and not isnan(x) and not isnan(y)"
    centres = cut(places.select(F.col("place").alias("region"), F.col("x").cast("double"), F.col("y").cast("double")).where(f"region is not null and {ok}").distinct())
    shape = (4 * centres.count(), centres.select("x", "y"))  # a hexagon has four triangles
    return probe_points(points, disc_triangles(centres, metres), metres, shape).withColumnRenamed("region", "place")


def containing_regions(points: DataFrame, regions: DataFrame, shared_boundary: str = "first") -> DataFrame:
    """(x, y, region) of distinct points in or on a polygon (region, ring array<struct<x,y>>[, holes]); see ``triangles_of``.

    A point on the boundary of several regions (or in overlapping ones) goes to the first region id, or with
    ``shared_boundary="all"`` to each. The edge of a hole belongs to the region. Points in no region don't come out.
    """
    found = probe_points(points, triangles_of(regions))
    return found if shared_boundary == "all" else found.groupBy("x", "y").agg(F.min("region").alias("region"))
