"""Readers and writers of the files that address runs use."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sthalam.functions import text as T


def read_bureau(spark: SparkSession, path: str) -> DataFrame:
    """Bureau rows (address, state_code, zip) from a CSV with the columns ADDRESS, State code, ZIP; all text, blanks cut off."""
    d = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return d.select(F.trim("ADDRESS").alias("address"), F.upper(F.trim("State code")).alias("state_code"), F.trim("ZIP").alias("zip"))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Project listings whose name has five letters or more in match form; dotted headers become plain ones; `ord` follows the file."""
    d = spark.read.option("header", True).option("multiLine", True).csv(path)
    d = d.toDF(*(c.strip().removeprefix("projectData.").lower() for c in d.columns)).withColumn("ord", F.monotonically_increasing_id())
    return d.where(F.length(T.norm_name(F.col("projectname"))) >= 5)


def read_localities(spark: SparkSession, merged: str, posts: str) -> DataFrame:
    """(pincode, locality, city, level, source) from the merged file if it exists, else from the post-office list, whose header may
    have a blank after "Location"."""
    if _exists(spark, merged):
        return spark.read.option("header", True).csv(merged)
    d = spark.read.option("header", True).csv(posts)
    d = d.toDF(*(c.strip() for c in d.columns))
    return d.select(F.trim("pincode").alias("pincode"), T.clean_locality(F.col("Location")).alias("locality"), F.col("district").alias("city"), F.lit("post_office").alias("level"), F.lit("india_post").alias("source")).distinct()


def read_pin_points(spark: SparkSession, path: str) -> DataFrame:
    """(pin, latitude, longitude, district, offices) from one JSON object keyed by pin; coordinates of nought are null."""
    kind = "MAP<STRING, STRUCT<latitude: DOUBLE, longitude: DOUBLE, district: STRING, offices: ARRAY<STRING>>>"
    d = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("pin", "x")).select("pin", "x.*")
    there = (F.col("latitude") != 0) & (F.col("longitude") != 0)
    return d.withColumn("latitude", F.when(there, F.col("latitude"))).withColumn("longitude", F.when(there, F.col("longitude")))


def read_geocodes(spark: SparkSession, path: str) -> DataFrame:
    """(query, lat, lon, name, kind, state, postcode, at) of every cached hit, in the hits' order; no service is asked."""
    kind = "MAP<STRING, ARRAY<STRUCT<lat: STRING, lon: STRING, name: STRING, addresstype: STRING, address: MAP<STRING, STRING>>>>"
    d = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("query", "hits")).select("query", F.posexplode("hits").alias("at", "h"))
    return d.select("query", F.expr("try_cast(h.lat AS DOUBLE)").alias("lat"), F.expr("try_cast(h.lon AS DOUBLE)").alias("lon"), "h.name", F.col("h.addresstype").alias("kind"), F.col("h.address")["state"].alias("state"), F.col("h.address")["postcode"].alias("postcode"), "at")


BUILDING_TYPES = ["apartment", "residential_complex", "building", "commercial_complex", "tower", "mall"]


def map_buildings(d: DataFrame, city: str, least: float = 0.5) -> DataFrame:
    """(name, shown): building names of a place table (city, entity_type, confidence, name, society_name, building_name) for one city,
    sure enough and no streets; a confidence that is no number counts as nought; of one name the longest spelling."""
    ok = (F.lower(F.trim("city")) == city.lower()) & F.lower("entity_type").isin(BUILDING_TYPES) & (F.coalesce(F.expr("try_cast(confidence AS DOUBLE)"), F.lit(0.0)) >= least)
    long = d.where(ok).select(F.explode(F.array("name", "society_name", "building_name")).alias("shown")).where("shown IS NOT NULL")
    long = long.withColumn("name", T.norm_name(F.col("shown"))).where((F.length("name") >= 5) & ~F.col("name").rlike(r"\b(ROAD|HIGHWAY|FLYOVER|JUNCTION|CIRCLE|SQUARE)\b"))
    return long.groupBy("name").agg(F.max_by("shown", F.struct(F.length("shown"), "shown")).alias("shown"))


def map_localities(d: DataFrame, city: str) -> DataFrame:
    """(name, shown): localities of a place table (city, locality, sub_locality, neighbourhood) for one city."""
    long = d.where(F.lower(F.trim("city")) == city.lower()).select(F.explode(F.array("locality", "sub_locality", "neighbourhood")).alias("shown")).where("shown IS NOT NULL")
    return long.withColumn("name", T.match_text(T.clean_locality(F.col("shown")))).where(F.length("name") >= 4).groupBy("name").agg(F.max_by("shown", F.struct(F.length("shown"), "shown")).alias("shown"))


def read_folder(spark: SparkSession, folder: str, columns: tuple[str, ...] = ("Name", "Address1", "Address2", "Telephone", "Mobile")) -> DataFrame:
    """Rows of all tab-separated files of a folder (.xls, .xlsx, .csv by name), with `source_file`; the byte-order mark tells UTF-16 LE or BE, else
    UTF-8; blank rows go, short rows are filled, the first line is the header."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", "*.{xls,xlsx,csv}").load(folder)
    mark = F.hex(F.substring(F.col("content"), 1, 2))
    text = F.when(mark == "FFFE", F.decode("content", "UTF-16")).when(mark == "FEFF", F.decode("content", "UTF-16")).otherwise(F.decode("content", "UTF-8"))
    lines = b.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.posexplode(F.split(F.regexp_replace(text, "^﻿", ""), r"\r\n|\r|\n")).alias("line", "row"))
    cells = F.split("row", "\t")
    d = lines.where("line > 0 AND trim(row) <> ''").select("source_file", "line", *(F.coalesce(F.trim(F.regexp_replace(F.get(cells, F.lit(i)), '^"|"$', "")), F.lit("")).alias(c) for i, c in enumerate(columns)))
    return d


def limited_path(path: str, limit: int | None) -> str:
    """Where a run over the first rows writes, so that it never replaces the full output."""
    if not limit:
        return path
    root, ext = os.path.splitext(path)
    return f"{root}_limit{limit}{ext}"


def write_csv(df: DataFrame, path: str, *, limit: int | None = None, order: str | None = None) -> str:
    """Header and rows, nulls as empty texts; a limited run goes to its own path, which must not exist yet."""
    out = df.orderBy(order) if order else df
    target = limited_path(path, limit)
    (out.limit(limit) if limit else out).na.fill("").write.option("header", True).mode("errorifexists" if limit else "overwrite").csv(target)
    return target


def replace_with_backup(df: DataFrame, path: str) -> None:
    """Rewrites a local folder that `df` may itself read: first to a new folder, then by two renames; the first version stays as
    a backup once and for all."""
    new, backup = f"{path}.new", f"{path}.backup"
    df.write.mode("overwrite").option("header", True).csv(new)
    if os.path.exists(backup):
        shutil.rmtree(path)
    else:
        os.rename(path, backup)
    os.rename(new, path)


def numbered(df: DataFrame, order: str) -> DataFrame:
    """`df` with row_id 1, 2, ... in the order of a column, by counts of each partition and not in one task."""
    s = df.orderBy(order).withColumn("__p", F.spark_partition_id())
    counts = s.groupBy("__p").count()
    before = counts.withColumn("__b", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__b")
    return s.join(F.broadcast(before), "__p").withColumn("row_id", F.col("__b") + F.row_number().over(Window.partitionBy("__p").orderBy(order))).drop("__p", "__b")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
