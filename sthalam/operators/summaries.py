"""Group summaries, merges, samples and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def commonest(df: DataFrame, key: list[str], value: str, order: Column) -> DataFrame:
    """(`key`..., value, n): each key's commonest value; of equals the one seen first by `order`. Null values don't count."""
    each = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("n"), F.min(order).alias("__o"))
    return each.groupBy(*key).agg(F.max_by(F.struct(value, "n"), F.struct(F.col("n"), (-F.col("__o")).alias("o"))).alias("__t")).select(*key, F.col(f"__t.{value}").alias(value), F.col("__t.n").alias("n"))


def longest(df: DataFrame, key: list[str], value: str, order: Column) -> DataFrame:
    """(`key`..., value): each key's longest value; of equals the one seen first."""
    return df.where(F.col(value).isNotNull()).groupBy(*key).agg(F.max_by(value, F.struct(F.length(value).alias("l"), (-order).alias("o"))).alias(value))


def learned_pairs(df: DataFrame, thing: str, place: str, least: int, share: float) -> DataFrame:
    """(thing, place, n): pairs seen `least` times that hold `share` of their place's rows."""
    n = df.where(F.col(thing).isNotNull() & F.col(place).isNotNull()).groupBy(thing, place).agg(F.count("*").alias("n"))
    return n.withColumn("__all", F.sum("n").over(Window.partitionBy(place))).where((F.col("n") >= least) & (F.col("n") / F.col("__all") >= share)).drop("__all")


def merge_sources(first: DataFrame, second: DataFrame, key: list[str], value: str, names: tuple[str, str] = ("first", "second")) -> DataFrame:
    """(`key`..., value, source): the full outer merge of two keyed lists; the first one's spelling stays, source says who has it."""
    a = first.groupBy(*key).agg(F.min(value).alias("__a"))
    b = second.groupBy(*key).agg(F.min(value).alias("__b"))
    source = F.when(F.col("__a").isNull(), names[1]).when(F.col("__b").isNull(), names[0]).otherwise("both")
    return a.join(b, key, "full").select(*key, F.coalesce("__a", "__b").alias(value), source.alias("source"))


def filled(c: str) -> Column:
    return F.coalesce(F.length(F.trim(F.col(f"`{c}`").cast("string"))) > 0, F.lit(False))


def fill_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, filled, total, share) in one pass over the table; 0 for an empty one."""
    one = df.agg(F.count("*").alias("total"), *(F.count_if(filled(c)).alias(f"__{i}") for i, c in enumerate(columns)))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"__{i}").alias("filled")) for i, c in enumerate(columns))))
    return one.select("total", rows.alias("r")).select("r.column_name", "r.filled", "total", F.when(F.col("total") > 0, F.round(100.0 * F.col("r.filled") / F.col("total"), 4)).otherwise(0.0).alias("share"))


def per_stratum(df: DataFrame, stratum: str, key: str, most: int, seed: str) -> DataFrame:
    """At most `most` rows of each stratum, in the order of a hash of key and seed; the cap is what is asked for.

    Two steps: the first ranks within parts of a stratum, so that a stratum of any size is never one task; only `most` of each part
    reach the second.
    """
    h = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    d = df.withColumn("__h", h).withColumn("__p", F.substring(F.col("__h"), 1, 2))
    d = d.withColumn("__n", F.row_number().over(Window.partitionBy(stratum, "__p").orderBy("__h"))).where(F.col("__n") <= most)
    return d.withColumn("__n", F.row_number().over(Window.partitionBy(stratum).orderBy("__h"))).where(F.col("__n") <= most).drop("__h", "__p", "__n")


def precision_rollup(df: DataFrame, stratum: str, correct: Column, wrong: Column) -> DataFrame:
    """(stratum, correct, wrong, precision) of each stratum and, with `ALL`, of the whole; null where nothing is decided."""
    r = df.withColumn("__s", F.col(stratum)).rollup("__s").agg(F.grouping("__s").alias("g"), F.count_if(correct).alias("correct"), F.count_if(wrong).alias("wrong"))
    decided = F.col("correct") + F.col("wrong")
    return r.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("__s")).alias("stratum"), "correct", "wrong", F.when(decided > 0, F.round(F.col("correct") / decided, 6)).alias("precision"))


def counters() -> list[Column]:
    """Aggregates over a parsed table: total, matched, located, zip_missing, state_missing and the bins high, middle and low of the confidence."""
    n = lambda x, name: F.count_if(F.coalesce(x, F.lit(False))).alias(name)
    c = F.col("confidence")
    return [F.count("*").alias("total"), n(F.col("dotcom_matched") == "Yes", "matched"), n(F.col("location_matched") == "Yes", "located"), n(~filled("zip"), "zip_missing"), n(~filled("state_code"), "state_missing"), n(c >= 0.8, "high"), n((c >= 0.6) & (c < 0.8), "middle"), n(c < 0.6, "low")]
