"""Points near other points, and the region that holds a point.

Points become unit vectors; a k-d tree over a bounded sample of the distinct places gives the partitions, halo copies of the
places within the radius of a splitting plane make each partition complete, and each partition answers with a k-d tree of
its own by chord length. The sample decides only how even the partitions are, never which pairs are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Radius of the sphere in kilometres (fixed value).
EARTH_KM = 6371.0
#: Places in the sample that the partitions are cut by: about so many, more where there are many partitions (SAMPLE_PER_LEAF for each), MOST_SAMPLED at most.
SPLIT_SAMPLE, SAMPLE_PER_LEAF, MOST_SAMPLED = 16_384, 4, 2_000_000
#: Distinct places that a partition is meant to hold.
LEAF_PLACES = 4_096
#: Places in a leaf of a partition's own tree.
BUCKET = 24
#: Edges that are sent to every executor, at most; about 40 bytes each.
MAX_EDGES = 500_000


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], axis=1)


def great_circle_km(lat_a: np.ndarray, lon_a: np.ndarray, lat_b: np.ndarray, lon_b: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat_a), np.radians(lat_b)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon_b - lon_a) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(1, h)))


def haversine(lat_a, lon_a, lat_b, lon_b):
    """Great-circle kilometres of four columns, inside code generation."""
    a, b = F.radians(lat_a), F.radians(lat_b)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon_b - lon_a) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def near_centres(points: DataFrame, centres: DataFrame, km: float) -> DataFrame:
    """`points` (lat, lon, …) joined with those of `centres` (cy, cx, …) at most `km` away, with the distance `away`; `km` is at most 78.

    An equi-join on cells of one degree, of which a centre takes the nine around it: within the latitudes of 45 degrees either side of
    the equator a degree is 78 kilometres at least.
    """
    if km > 78:
        raise ValueError("cells of one degree reach no farther than 78 km")
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    c = centres.withColumn("__y", F.explode(F.transform(around, lambda i: F.floor("cy") + i))).withColumn("__x", F.explode(F.transform(around, lambda i: F.floor("cx") + i)))
    p = points.withColumn("__y", F.floor("lat")).withColumn("__x", F.floor("lon"))
    away = haversine(F.col("lat"), F.col("lon"), F.col("cy"), F.col("cx"))
    return p.join(c, ["__y", "__x"]).withColumn("away", away).where(F.col("away") <= km).drop("__y", "__x")


class SplitTree:
    """Axis-parallel cuts of space into `leaves` partitions, from sample vectors."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.axis, self.at, self.child = [], [], []
        self.leaves = 0
        self._grow(sample, max(1, leaves))

    def _grow(self, s: np.ndarray, leaves: int) -> int:
        """The node's number; leaves are negative: -1 - leaf."""
        if leaves > 1 and len(s) > 1:
            axis = int(np.argmax(np.ptp(s, axis=0)))
            left = leaves // 2
            at = float(np.quantile(s[:, axis], left / leaves))
            low = s[:, axis] < at
            if low.any() and not low.all():
                k = len(self.axis)
                self.axis.append(axis)
                self.at.append(at)
                self.child.append([0, 0])
                self.child[k] = [self._grow(s[low], left), self._grow(s[~low], leaves - left)]
                return k
        self.leaves += 1
        return -self.leaves

    def place(self, v: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, whether at home) of every vector and of its copies in leaves within `reach` of it."""
        rows, leaves, homes = [], [], []
        todo = [(0 if self.axis else -1, np.arange(len(v)), np.ones(len(v), bool))]
        while todo:
            node, row, home = todo.pop()
            if not len(row):
                continue
            if node < 0:
                rows.append(row)
                leaves.append(np.full(len(row), -1 - node))
                homes.append(home)
                continue
            d = v[row, self.axis[node]] - self.at[node]
            for low in (True, False):
                own = (d < 0) if low else (d >= 0)
                near = own | (np.abs(d) <= reach)
                todo.append((self.child[node][0 if low else 1], row[near], (home & own)[near]))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return join(rows, np.int64), join(leaves, np.int64), join(homes, bool)


def close_pairs(v: np.ndarray, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i, j (each pair once) of vectors at most `reach` apart, by a k-d tree joined with itself level by level."""
    n = len(v)
    if n < 2:
        return
    order = np.arange(n)
    depth = max(0, int(np.ceil(np.log2(n / BUCKET)))) if n > BUCKET else 0
    bounds = [np.array([0, n])]
    for _ in range(depth):
        edges = bounds[-1]
        nxt = [0]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            m = (a + b) // 2
            if b - a > 1:
                part = order[a:b]
                axis = int(np.argmax(np.ptp(v[part], axis=0)))
                order[a:b] = part[np.argpartition(v[part, axis], m - a)]
            nxt += [m, b]
        bounds.append(np.array(nxt))
    w = v[order]
    boxes = []
    for edges in bounds:
        starts = np.minimum(edges[:-1], n - 1)
        boxes.append((np.minimum.reduceat(w, starts), np.maximum.reduceat(w, starts)))
    a = b = np.zeros(1, np.int64)
    for level in range(1, depth + 1):
        kids = [(2 * a, 2 * b), (2 * a, 2 * b + 1), (2 * a + 1, 2 * b + 1)]
        mixed = a != b
        a = np.concatenate([*(x for x, _ in kids), (2 * a + 1)[mixed]])
        b = np.concatenate([*(y for _, y in kids), (2 * b)[mixed]])
        low, high = boxes[level]
        gap = np.maximum(0, np.maximum(low[a] - high[b], low[b] - high[a]))
        keep = (gap**2).sum(axis=1) <= reach**2
        a, b = a[keep], b[keep]
    edges = bounds[-1]
    size = np.diff(edges)
    widest = int(size.max())
    step = max(1, 2_000_000 // (widest * widest))
    grid_i, grid_j = (x.ravel() for x in np.meshgrid(np.arange(widest), np.arange(widest), indexing="ij"))
    for k in range(0, len(a), step):
        x, y = a[k : k + step], b[k : k + step]
        ok = (grid_i < size[x][:, None]) & (grid_j < size[y][:, None]) & ((x != y)[:, None] | (grid_i < grid_j))
        i, j = (edges[x][:, None] + grid_i)[ok], (edges[y][:, None] + grid_j)[ok]
        near = ((w[i] - w[j]) ** 2).sum(axis=1) <= reach**2
        if near.any():
            yield order[i[near]], order[j[near]]


def pairs_within(points: DataFrame, km: float, *, key: str = "point_id", lat: str = "latitude", lon: str = "longitude", box: tuple[float, float, float, float] = (-90, 90, -180, 180)) -> DataFrame:
    """(`key`_a, `key`_b, km) of all pairs of points at most `km` apart on the sphere, `key`_a < `key`_b, each pair once.

    Points with a null or non-finite coordinate, a null key, or outside `box` (lat from, lat to, lon from, lon to) are left out.
    Points of the same place are pairs at 0 km. Repeated keys give no pair with themselves. Other columns aren't read. An empty
    table gives an empty one. Places are made distinct first, so many copies of a place cost one query; only the pairs that
    must come out are expanded, by joins on the place that AQE can split.
    """
    spark = points.sparkSession
    a, b, k = F.col(f"`{lat}`"), F.col(f"`{lon}`"), F.col(f"`{key}`")
    p = points.select(k.alias("k"), a.cast("double").alias("lat"), b.cast("double").alias("lon"))
    p = p.where(F.col("k").isNotNull() & F.col("lat").between(box[0], box[1]) & F.col("lon").between(box[2], box[3]))
    p = p.select("k", (F.col("lat") + 0.0).alias("lat"), (F.col("lon") + 0.0).alias("lon")).distinct()
    places = p.select("lat", "lon").distinct()
    #: (a sum over all places, and the sample, in one job each; both results are bounded)
    n = places.count()
    leaves = -(-n // LEAF_PLACES)
    wanted = min(max(SPLIT_SAMPLE, SAMPLE_PER_LEAF * leaves), MOST_SAMPLED)
    drawn = places.where(F.pmod(F.xxhash64("lat", "lon"), F.lit(2**32)) < int(min(1.0, wanted / max(n, 1)) * 2**32))
    sample = drawn.toPandas().sort_values(["lat", "lon"]) if leaves > 1 else pd.DataFrame({"lat": [], "lon": []})
    tree = SplitTree(unit_vectors(sample["lat"].to_numpy(float), sample["lon"].to_numpy(float)), leaves)
    reach = 2 * np.sin(min(km / EARTH_KM, np.pi) / 2) * (1 + 1e-9) + 1e-12

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            la, lo = t["lat"].to_numpy(), t["lon"].to_numpy()
            row, leaf, home = tree.place(unit_vectors(la, lo), reach)
            yield pd.DataFrame({"leaf": leaf, "home": home, "lat": la[row], "lon": lo[row]})

    def within(t: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The pairs of one leaf, a chunk at a time."""
        la, lo, home = t["lat"].to_numpy(), t["lon"].to_numpy(), t["home"].to_numpy()
        for i, j in close_pairs(unit_vectors(la, lo), reach):
            swap = (la[i] > la[j]) | ((la[i] == la[j]) & (lo[i] > lo[j]))
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            i, j = i[home[i]], j[home[i]]
            d = great_circle_km(la[i], lo[i], la[j], lo[j])
            ok = d <= km
            i, j = i[ok], j[ok]
            yield pd.DataFrame({"lat_a": la[i], "lon_a": lo[i], "lat_b": la[j], "lon_b": lo[j], "km": d[ok]})

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The pairs of each leaf in turn; a partition's rows come sorted by leaf, so only one leaf's places are held."""
        held: list[pd.DataFrame] = []
        for t in batches:
            cuts = np.flatnonzero(np.diff(t["leaf"].to_numpy())) + 1
            for k, part in enumerate(np.split(np.arange(len(t)), cuts)):
                rows = t.iloc[part]
                if held and (k or held[-1]["leaf"].iloc[0] != rows["leaf"].iloc[0]):
                    yield from within(pd.concat(held))
                    held = []
                if len(rows):
                    held.append(rows)
        if held:
            yield from within(pd.concat(held))

    parts = places.mapInPandas(spread, "leaf bigint, home boolean, lat double, lon double").repartition("leaf").sortWithinPartitions("leaf")
    near = parts.mapInPandas(local, "lat_a double, lon_a double, lat_b double, lon_b double, km double")
    pa = p.select(F.col("k").alias("ka"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"))
    pb = p.select(F.col("k").alias("kb"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"))
    apart = near.join(pa, ["lat_a", "lon_a"]).join(pb, ["lat_b", "lon_b"]).where("ka <> kb")
    same = pa.join(pb, (F.col("lat_a") == F.col("lat_b")) & (F.col("lon_a") == F.col("lon_b"))).where("ka < kb").withColumn("km", F.lit(0.0))
    both = apart.select("ka", "kb", "km").unionByName(same.select("ka", "kb", "km"))
    out = both.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b"), "km")
    return out


def regions_of(points: DataFrame, regions: list[tuple[str, list[tuple[float, float]]]], *, key: str = "point_id", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(`key`, region) for every region whose polygon, given as (lat, lon) corners, holds the point; even-odd rule in the plane of degrees.

    The edges are swept upwards in latitude: between two neighbouring corner latitudes the set of edges that a horizontal line
    meets is fixed, so a batch's points are sorted by latitude, and each slab's points meet only that slab's edges. A point on a
    lower or left edge belongs to the region, on an upper or right edge not. Points with null coordinates or a null key are left
    out; a point in no region has no row; overlapping regions give a row each. `regions` has at most MAX_EDGES edges, which is
    checked, since every executor gets them; other columns aren't read; an empty table gives an empty one. There is no shuffle.
    """
    edges = [(i, *a, *b) for i, (_, ring) in enumerate(regions) for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a[0] != b[0]]
    if len(edges) > MAX_EDGES:
        raise ValueError(f"{len(edges)} edges are too many for every executor; split the regions")
    names = np.array([n for n, _ in regions], object)
    e = np.array(edges, float).reshape(-1, 5)
    up = e[:, 1] <= e[:, 3]
    low_y, low_x = np.where(up, e[:, 1], e[:, 3]), np.where(up, e[:, 2], e[:, 4])
    high_y, high_x = np.where(up, e[:, 3], e[:, 1]), np.where(up, e[:, 4], e[:, 2])
    region = e[:, 0].astype(int)
    stops = np.unique(np.concatenate([low_y, high_y])) if len(e) else np.zeros(0)
    kind = points.schema[key].dataType.simpleString()

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            t = t.sort_values("lat", kind="stable")
            y, x = t["lat"].to_numpy(), t["lon"].to_numpy()
            cut = np.searchsorted(y, stops, side="left")
            rows, found = [], []
            by_start = np.argsort(low_y, kind="stable")
            entered, active = 0, np.zeros(0, int)
            for s in range(len(stops) - 1):
                while entered < len(by_start) and low_y[by_start[entered]] <= stops[s]:
                    active = np.append(active, by_start[entered])
                    entered += 1
                active = active[high_y[active] > stops[s]]
                a, b = cut[s], cut[s + 1]
                if a == b or not len(active):
                    continue
                at = low_x[active] + (y[a:b, None] - low_y[active]) * ((high_x - low_x)[active] / (high_y - low_y)[active])
                i, j = np.nonzero(at <= x[a:b, None])
                hit, times = np.unique(np.stack([i + a, region[active][j]]), axis=1, return_counts=True)
                rows.append(hit[0][times % 2 == 1])
                found.append(hit[1][times % 2 == 1])
            if rows:
                r = np.concatenate(rows)
                yield pd.DataFrame({key: t["k"].to_numpy()[r], "region": names[np.concatenate(found)]})

    p = points.select(F.col(f"`{key}`").alias("k"), F.col(f"`{lat}`").cast("double").alias("lat"), F.col(f"`{lon}`").cast("double").alias("lon")).dropna()
    return p.mapInPandas(sweep, f"`{key}` {kind}, region string")
