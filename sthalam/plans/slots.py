"""Rows with two addresses: each parsed on its own, side by side in the result."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sthalam.functions import text as T
from sthalam.functions import words as W
from sthalam.plans.parse import parse_addresses
from sthalam.plans.project_match import Dimensions

PARSED = ["building_number", "building_name", "dotcom_matched", "dotcom_match_rule", "location_matched", "landmark", "locality", "locality_source", "city", "district", "confidence"]


def labelled_building(text: Column) -> Column:
    """The value after Building:, Society: or Complex:, in that order, of two letters or more."""
    one = lambda word: F.trim(F.regexp_extract(text, rf"(?i)\b{word}\s*(?:name)?\s*[:\-]\s*([^,;|]{{2,60}})", 1))
    return F.coalesce(*(F.when(F.length(one(w)) >= 2, one(w)) for w in ("building", "society", "complex")))


def weak_building(name: Column) -> Column:
    return F.coalesce(F.trim(name) == "", F.lit(True)) | (F.length(F.trim(name)) <= 2) | name.rlike(r"(?i)^\s*(wing|plot|flat|room|shop|floor|block)\b")


def with_label(parsed: DataFrame, buildings: DataFrame | None = None) -> DataFrame:
    """The parsed rows, with a labelled building in place of any but a matched one that agrees with it.

    Where the name changes, what hangs on it is done again: it counts as matched no longer unless it is the matched project's, and as a known building if it is
    one of `buildings` (name, in match form). The column `relabelled` tells the rows.
    """
    label = labelled_building(F.col("address"))
    a, b = T.norm_name(label), T.norm_name(F.col("building_name"))
    aligned = F.coalesce(a.contains(b) | b.contains(a), F.lit(False)) & (b != "")
    takes = label.isNotNull() & (weak_building(F.col("building_name")) | ~aligned | (F.col("dotcom_matched") != "Yes"))
    d = parsed.withColumn("relabelled", F.coalesce(takes, F.lit(False))).withColumn("__lost", F.col("relabelled") & (F.col("dotcom_matched") == "Yes") & ~aligned)
    d = d.withColumn("building_name", F.when(F.col("relabelled"), T.title_building(label)).otherwise(F.col("building_name")))
    d = d.withColumn("dotcom_matched", F.when(F.col("__lost"), "No").otherwise(F.col("dotcom_matched"))).withColumn("dotcom_match_rule", F.when(F.col("__lost"), None).otherwise(F.col("dotcom_match_rule"))).drop("__lost")
    if buildings is None:
        return d
    known = buildings.select(F.col("name").alias("__n")).distinct().withColumn("__osm", F.lit(True))
    d = d.withColumn("__n", T.match_text(F.col("building_name"))).join(known, "__n", "left")
    return d.withColumn("location_matched", F.when(F.col("relabelled"), F.when(F.col("__osm"), "Yes").otherwise("No")).otherwise(F.col("location_matched"))).drop("__n", "__osm")


def rescored(parsed: DataFrame, pin_city: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """The parsed rows (with their zip and state_code) with the confidence of what they tell now, by the city (pin, pin_city) and state (pin, state) of their pin."""
    d = parsed.withColumn("__pin", T.pin_in(F.col("address"), F.col("zip"))).join(pin_city.select(F.col("pin").alias("__pin"), "pin_city"), "__pin", "left")
    d = d.join(states.select(F.col("pin").alias("__pin"), "state"), "__pin", "left") if states is not None else d.withColumn("state", F.lit(None).cast("string"))
    same = T.norm_name(F.col("building_name")) == T.norm_name(F.col("locality"))
    score = T.confidence(F.col("__pin").rlike("^[1-9][0-9]{5}$"), F.col("pin_city").isNotNull(), T.state_evidence(F.col("state_code"), F.col("state")), T.city_key(F.col("city")) == F.col("pin_city"), F.col("city"), F.col("building_name"), F.col("dotcom_match_rule"), F.col("location_matched") == "Yes", same, F.col("locality_source"), F.col("locality"), F.col("building_number"), F.col("landmark"))
    return d.withColumn("confidence", score).drop("__pin", "pin_city", "state")


def parse_two_slots(rows: DataFrame, dims: Dimensions, *, key: str = "row_id", slots: tuple[str, str] = ("Address1", "Address2"), states: DataFrame | None = None, buildings: DataFrame | None = None, default_state: str = W.DEFAULT_STATE) -> DataFrame:
    """`rows` with the parsed columns of both addresses, suffixes _1 and _2; an empty address has empty columns. The key must be unique.

    The state of a slot is that of its address's pin (`states`: pin, state), else `default_state`. A labelled building replaces another one, and the row is scored again.
    """
    long = rows.select(F.col(key).alias("k"), F.posexplode(F.array(*slots)).alias("slot", "address")).withColumn("id", F.concat_ws("|", "k", "slot"))
    long = long.withColumn("pin", T.pin_in(F.col("address")))
    long = long.join(states.select("pin", "state"), "pin", "left") if states is not None else long.withColumn("state", F.lit(None).cast("string"))
    asked = long.select("id", "address", F.coalesce("state", F.lit(default_state)).alias("state_code"), F.lit(None).cast("string").alias("zip"))
    p = rescored(with_label(parse_addresses(asked, dims, key="id", states=states, buildings=buildings), buildings), dims.pin_city, states)
    p = p.join(long.select("id", "k", "slot"), "id")
    there = F.length(F.trim("address")) > 0
    wide = p.groupBy("k").agg(*(F.max(F.when((F.col("slot") == s) & there, F.col(c))).alias(f"{c}_{s + 1}") for s in (0, 1) for c in PARSED))
    return rows.join(wide.withColumnRenamed("k", key), key, "left")


def slot_stats(wide: DataFrame, slots: int = 2) -> DataFrame:
    """(slot, rows, parsed, named, matched, located): counters of each slot of a two-address result, and in the row `either` the rows of which some slot counts."""
    yes = lambda x: F.coalesce(x, F.lit(False))
    tests = {"parsed": lambda k: F.col(f"confidence_{k}").isNotNull(), "named": lambda k: yes(F.length(F.trim(F.col(f"building_name_{k}"))) > 0), "matched": lambda k: yes(F.col(f"dotcom_matched_{k}") == "Yes"), "located": lambda k: yes(F.col(f"location_matched_{k}") == "Yes")}
    every = range(1, slots + 1)
    row = lambda name, test: F.struct(F.lit(name).alias("slot"), *(test(t).alias(n) for n, t in tests.items()))
    each = F.array(*(row(str(k), lambda t, k=k: t(k)) for k in every), row("either", lambda t: reduce(lambda x, y: x | y, (t(k) for k in every))))
    return wide.select(F.inline(each)).groupBy("slot").agg(F.count("*").alias("rows"), *(F.count_if(n).alias(n) for n in tests))


def fill_by_model(parsed: DataFrame, load: Callable[[], Callable[[list[str]], list[list[dict]]]], known: DataFrame, least: float = 0.6) -> DataFrame:
    """Empty buildings and localities filled by a token-classification model; off unless called.

    `load` builds the model once for each worker; called with texts it returns, for each, spans with score, entity_group (BUILDING or
    LOCALITY) and word. Spans below `least` don't count, the longest of a kind is taken, and a locality must be one of `known` (name, in match form).
    """
    kind = "struct<building: string, locality: string>"

    @F.pandas_udf(kind)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        best = lambda found, group: max((s["word"] for s in found if s["entity_group"] == group and s["score"] >= least), key=len, default=None)
        for s in batches:
            found = model([x or "" for x in s])
            yield pd.DataFrame({"building": [best(f, "BUILDING") for f in found], "locality": [best(f, "LOCALITY") for f in found]})

    d = parsed.withColumn("s", spans(F.col("address"))).withColumn("name", T.match_text(F.col("s.locality")))
    d = d.join(known.select("name").distinct().withColumn("ok", F.lit(True)), "name", "left")
    clean = F.initcap(F.regexp_replace(F.regexp_replace("s.building", "##", ""), "^[0-9]+ *", ""))
    take = F.coalesce(F.trim("locality") == "", F.lit(True)) & F.coalesce("ok", F.lit(False))
    d = d.withColumn("locality_source", F.when(take, "ner").otherwise(F.col("locality_source"))).withColumn("locality", F.when(take, F.initcap("s.locality")).otherwise(F.col("locality")))
    empty = F.coalesce(F.trim("building_name") == "", F.lit(True)) & (F.length(clean) >= 4)
    return d.withColumn("building_name", F.when(empty, clean).otherwise(F.col("building_name"))).drop("s", "name", "ok")
