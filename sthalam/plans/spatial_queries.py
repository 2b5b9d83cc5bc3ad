"""Queries over points and regions, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sthalam.operators.spatial import pairs_within, regions_of
from sthalam.session import table

KM, BOX = 0.25, (6.0, 38.0, 68.0, 98.0)
#: Diamonds over the plane of degrees: name, centre (lat, lon), half height, half width.
DIAMONDS = [(f"zone_{i:02d}", 8.5 + 2.3 * i, 71.25 + (7 * i) % 24, 2.75 + i % 3, 3.5 + i % 4) for i in range(12)]


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs_within(table(spark, folder, "pincodes"), KM, box=BOX).select("point_id_a", "point_id_b")


def p4_regions(spark: SparkSession, folder: str) -> DataFrame:
    rings = [(name, [(y - h, x), (y, x + w), (y + h, x), (y, x - w)]) for name, y, x, h, w in DIAMONDS]
    return regions_of(table(spark, folder, "pincodes"), rings)


def p4_zone_counts(spark: SparkSession, folder: str) -> DataFrame:
    return p4_regions(spark, folder).groupBy("region").agg(F.count("*").alias("points"))


P4_SQL = f"""
WITH p AS (SELECT point_id, latitude y, longitude x FROM pincodes WHERE latitude BETWEEN {BOX[0]} AND {BOX[1]} AND longitude BETWEEN {BOX[2]} AND {BOX[3]})
SELECT a.point_id AS point_id_a, b.point_id AS point_id_b FROM p a JOIN p b ON a.point_id < b.point_id AND b.y BETWEEN a.y - 0.003 AND a.y + 0.003
WHERE 2 * 6371.0 * asin(sqrt(least(1, pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2)))) <= {KM}
"""
_ZONES = ", ".join(f"('{n}', {y}, {x}, {h}, {w})" for n, y, x, h, w in DIAMONDS)
REGIONS_SQL = f"""
SELECT point_id, z.n AS region FROM pincodes JOIN (VALUES {_ZONES}) z(n, y, x, h, w) ON abs(latitude - z.y) / z.h + abs(longitude - z.x) / z.w < 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p4_found": p4_found, "p4_regions": p4_regions, "p4_zone_counts": p4_zone_counts}


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4_SQL, "p4_regions": REGIONS_SQL, "p4_zone_counts": f"SELECT region, count(*) AS points FROM ({REGIONS_SQL}) GROUP BY region"}
