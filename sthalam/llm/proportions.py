"""A sample whose category shares are given, by systematic unequal-probability sampling."""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sthalam.session import cut_lineage

#: Groups into which the rows of one category are dealt, so that neither ordering nor summing is one task.
BUCKETS = 512
SEED = 20_260_923
UNMATCHED = "unmatched"


def latest_rules(parsed: DataFrame, key: str = "row_id", rule: str = "dotcom_match_rule", at: str = "parsed_at") -> DataFrame:
    """(`key`, category): of each key the row with the latest time (a null time is the earliest; of equal times the greater rule).

    The rule is taken without outer blanks and in lower case; null or blank is `unmatched`. Rows with a null key are left out.
    """
    clean = F.lower(F.regexp_replace(F.col(f"`{rule}`"), r"^\s+|\s+$", ""))
    category = F.when(F.length(clean) > 0, clean).otherwise(F.lit(UNMATCHED))
    t = parsed.select(F.col(f"`{key}`").alias(key), F.col(f"`{at}`").alias("t"), category.alias("category")).where(F.col(key).isNotNull())
    return t.groupBy(key).agg(F.max(F.struct(F.col("t").isNotNull().alias("known"), "t", "category")).alias("last")).select(key, F.col("last.category").alias("category"))


def required_rows(targets: list[tuple[str, float, int | None]], size: int) -> dict[str, int]:
    """The rows each category needs: the larger of its minimum and its share of `size`, rounded up (in decimal figures, so that
    0.1 of 70 is 7)."""
    share = {name: (Decimal(repr(round(float(s or 0), 12))) * size).to_integral_value(ROUND_CEILING) for name, s, _ in targets}
    return {name: max(int(share[name]), int(least or 0)) for name, _, least in targets}


class Proportioned:
    """`rows` (key, category) sampled towards `targets` (category, share, least); `fraction` of the rows, rounded down.

    Each category's rows get the inclusion probability needed / available, at most 1. In the order of categories, and within a
    category in random (hashed) order, the probabilities are summed up: first within buckets, then over the buckets of all
    partitions. A row is selected where the running sum crosses an integer beyond one random start, so each category gets its
    expected number rounded down or up. Where that is less than needed and rows are left, the next rows in the random order
    repair it. Categories without a target aren't sampled; a target with too few rows gets all of them and is reported.
    Targets are a fixed small list: they are collected, more than MAX_TARGETS of them are refused.
    """

    MAX_TARGETS = 1_000

    def __init__(self, rows: DataFrame, targets: DataFrame, fraction: tuple[int, int] = (1, 10), key: str = "row_id", seed: int = SEED):
        self.key, self.seed = key, seed
        self.rows = cut_lineage(rows.select(F.col(f"`{key}`").alias(key), "category", F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), F.lit(BUCKETS)).cast("int").alias("bucket")))
        self.counts = cut_lineage(self.rows.groupBy("category", "bucket").count())
        t = [tuple(r) for r in targets.select(F.col("match_rule"), "target_share", "min_rows").dropDuplicates(["match_rule"]).where("match_rule IS NOT NULL").limit(self.MAX_TARGETS + 1).collect()]
        if len(t) > self.MAX_TARGETS:
            raise ValueError("too many targets")
        total = self.counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
        self.size = total * fraction[0] // fraction[1]
        self.need = required_rows(t, self.size)
        self.targets = rows.sparkSession.createDataFrame([(n, float(s or 0), int(m or 0), self.need[n]) for n, s, m in t], "category string, target_share double, min_rows bigint, needed bigint")

    def report(self) -> DataFrame:
        """(match_rule, target_share, min_rows, needed, available, selected, short): one row for each target."""
        there = self.counts.groupBy("category").agg(F.sum("count").alias("available"))
        got = self.sample().groupBy("category").agg(F.count("*").alias("selected"))
        r = self.targets.join(there, "category", "left").join(got, "category", "left").na.fill(0, ["available", "selected"])
        return r.select(F.col("category").alias("match_rule"), "target_share", "min_rows", "needed", "available", "selected", (F.col("selected") < F.col("needed")).alias("short"))

    def sample(self) -> DataFrame:
        """(`key`, category, weight): the selected rows; the weight is one over the inclusion probability."""
        share = F.least(F.lit(1.0), F.col("needed") / F.col("available"))
        cells = self.counts.join(F.broadcast(self.targets), "category").withColumn("available", F.sum("count").over(Window.partitionBy("category")))
        # one row for each target and bucket, MAX_TARGETS x BUCKETS at most: a bounded table, whatever the number of rows
        upto = Window.orderBy("category", "bucket").rowsBetween(Window.unboundedPreceding, -1)
        within = Window.partitionBy("category").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("p", share).withColumn("sum_before", F.coalesce(F.sum(F.col("p") * F.col("count")).over(upto), F.lit(0.0))).withColumn("rank_before", F.coalesce(F.sum("count").over(within), F.lit(0)))
        cells = cells.select("category", "bucket", "p", "needed", "sum_before", "rank_before")
        start = F.lit((self.seed * 2_654_435_761 % 2**32) / 2**32)
        order = Window.partitionBy("category", "bucket").orderBy(F.xxhash64(F.lit(self.seed + 1), self.key), self.key)
        r = self.rows.withColumn("i", F.row_number().over(order)).join(F.broadcast(cells), ["category", "bucket"])
        end = F.col("sum_before") + F.col("i") * F.col("p") + start
        # the sums are rounded, so that neighbouring rows see the same bound and no crossing is lost or doubled
        crossed = F.floor(F.round(end, 6)) > F.floor(F.round(end - F.col("p"), 6))
        r = r.withColumn("rank", F.col("rank_before") + F.col("i")).withColumn("hit", (F.col("p") >= 1) | crossed)
        r = cut_lineage(r.select(self.key, "category", "bucket", "rank", "hit", "p", "needed"))
        lack = r.groupBy("category").agg((F.first("needed") - F.sum(F.col("hit").cast("bigint"))).alias("lack"))
        misses = r.where("NOT hit").groupBy("category", "bucket").agg(F.count("*").alias("n"))
        before = misses.withColumn("miss_before", F.coalesce(F.sum("n").over(within), F.lit(0))).join(lack, "category").where("lack > miss_before").select("category", "bucket", "lack", "miss_before")
        misses_in = Window.partitionBy("category", "bucket").orderBy("rank")
        spare = r.where("NOT hit").join(F.broadcast(before), ["category", "bucket"]).withColumn("m", F.col("miss_before") + F.row_number().over(misses_in)).where("m <= lack")
        return r.where("hit").select(self.key, "category", "p").unionByName(spare.select(self.key, "category", "p")).select(self.key, "category", (1 / F.col("p")).alias("weight"))
