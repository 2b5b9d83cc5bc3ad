"""Containers of fixed capacity filled by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sthalam.session import cut_lineage

#: Groups into which the rows of one length are dealt for ranking, so that a common length isn't one task.
RANK_BUCKETS = 256


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of each packing pattern.

    Lengths are placed longest first, each into the packs that are shortest so far, as long as it fits there; the counts of
    patterns are updated as a whole, so the work follows the number of distinct lengths and not that of items. Only where the
    shortest pack has no room is a new one opened. Each step fills one pattern up or splits one, so there are at most about
    twice as many patterns as `capacity`, however many items there are.
    """
    open_packs: dict[int, list[list]] = defaultdict(list)  # room left -> [count, lengths]
    rooms: list[int] = []  # of open packs, most room first
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(room: int, count: int, lengths: tuple[int, ...]) -> None:
        if room == 0:
            done.append((count, lengths))
            return
        if not open_packs[room]:
            heapq.heappush(rooms, -room)
        open_packs[room].append([count, lengths])

    for length in sorted((k for k, n in histogram.items() if n > 0), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        left = histogram[length]
        while left:
            if rooms and -rooms[0] >= length:
                room = -rooms[0]
                count, lengths = open_packs[room].pop()
                if not open_packs[room]:
                    heapq.heappop(rooms)
                n = min(count, left)
                if count > n:
                    put(room, count - n, lengths)
                put(room - length, n, (*lengths, length))
                left -= n
            else:  # no pack has room: as many new ones as this length alone needs
                each = min(capacity // length, left)
                n = left // each
                put(capacity - each * length, n, (length,) * each)
                left -= n * each
    return done + [(c, lengths) for packs in open_packs.values() for c, lengths in packs]


def fill_containers(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = 2048) -> DataFrame:
    """(key, part, tokens, container_id, start): every item of `sizes` in containers of `capacity`.

    An item longer than the capacity is split into full parts, each its own container, and a rest that is packed like any
    other; nothing else is split. An item of size 0 or null has one row with part 0, tokens 0 and a null container. `start` is the part's
    place in its container. Repeated keys and null keys are items of their own; items of equal key and size are
    exchangeable. Other columns aren't read. An empty table gives an empty one.

    Only the histogram (at most `capacity` rows) and the patterns' places reach the driver; both are bounded by the capacity.
    """
    spark = sizes.sparkSession
    items = cut_lineage(sizes.select(F.col(f"`{key}`").alias("__key"), F.coalesce(F.col(f"`{size}`").cast("bigint"), F.lit(0)).alias("__size")))
    full = F.expr(f"CAST(__size DIV {capacity} AS BIGINT)")
    rest = items.select("__key", full.alias("__part"), (F.col("__size") % capacity).alias("__tokens")).where("__tokens > 0")
    whole = items.where(F.col("__size") >= capacity).select("__key", F.explode(F.sequence(F.lit(0), full - 1)).alias("__part"), F.lit(capacity).cast("bigint").alias("__tokens"))
    none = items.where("__size = 0").select("__key", F.lit(0).cast("bigint").alias("__part"), F.lit(0).cast("bigint").alias("__tokens"))
    parts = rest.unionByName(whole).withColumn("__b", F.expr(f"pmod(xxhash64(__key, __part), {RANK_BUCKETS})").cast("int"))

    counts = cut_lineage(parts.groupBy("__tokens", "__b").count())
    histogram = {r["__tokens"]: r["n"] for r in counts.groupBy("__tokens").agg(F.sum("count").alias("n")).collect()}
    places, used, first = [], defaultdict(int), 0
    for n, lengths in sorted(pack_histogram(histogram, capacity), key=lambda x: (x[1], x[0])):
        at = 0
        for length in lengths:
            places.append((length, used[length], used[length] + n, first - used[length], at))
            used[length] += n
            at += length
        first += n
    place = spark.createDataFrame(places, "p_tokens bigint, p_from bigint, p_to bigint, p_shift bigint, p_start bigint")

    before = F.sum("count").over(Window.partitionBy("__tokens").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("__tokens").alias("o_tokens"), F.col("__b").alias("o_b"), F.coalesce(before, F.lit(0)).alias("o_before"))
    in_bucket = F.row_number().over(Window.partitionBy("__tokens", "__b").orderBy("__key", "__part")) - 1
    ranked = parts.withColumn("__in", in_bucket).join(offsets, (F.col("__tokens") == F.col("o_tokens")) & (F.col("__b") == F.col("o_b")))
    ranked = ranked.withColumn("__rank", F.col("__in") + F.col("o_before"))
    # the places are at most about capacity^2 / smallest length numbers, whatever the number of items
    packed = ranked.join(F.broadcast(place), (F.col("__tokens") == F.col("p_tokens")) & (F.col("__rank") >= F.col("p_from")) & (F.col("__rank") < F.col("p_to")))
    out = packed.select(F.col("__key").alias(key), F.col("__part").alias("part"), F.col("__tokens").alias("tokens"), (F.col("__rank") + F.col("p_shift")).alias("container_id"), F.col("p_start").alias("start"))
    return out.unionByName(none.select(F.col("__key").alias(key), F.col("__part").alias("part"), F.col("__tokens").alias("tokens"), F.lit(None).cast("bigint").alias("container_id"), F.lit(None).cast("bigint").alias("start")))


def fill_report(containers: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: containers, tokens, unused room, the least possible number of containers, and the share of room used."""
    used = containers.where("container_id IS NOT NULL")
    r = used.groupBy("container_id").agg(F.sum("tokens").alias("t")).agg(F.count("*").alias("containers"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"), F.coalesce(F.max("t"), F.lit(0)).alias("fullest"))
    return r.select("containers", "tokens", (F.col("containers") * capacity - F.col("tokens")).alias("unused"), F.ceil(F.col("tokens") / capacity).alias("least_containers"), "fullest", F.when(F.col("containers") > 0, F.round(F.col("tokens") / (F.col("containers") * capacity), 6)).alias("share_used"))
