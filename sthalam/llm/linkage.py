"""Rows and records of the same project, without a common key, by collective linkage over a graph of candidates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sthalam.llm.address_parts import _ROMAN, SUFFIX, Gazetteer, _brand_before
from sthalam.llm.canonical import city_text, one_slip
from sthalam.llm.same_place import agree, deletion_forms, settled_parts
from sthalam.session import cut_lineage

#: Share of a node's heaviest edge below which an edge is pruned.
PRUNE = 0.6
#: Least confidence of a match.
CONFIDENCE = 0.5
#: What its own attributes, the like nodes on the one side and those on the other count for in an edge's similarity.
OWN, BESIDE_ROW, BESIDE_RECORD = 0.6, 0.2, 0.2
#: Change below which the similarities are stable, and rounds that are made at most: each round's changes are at most
#: BESIDE_ROW + BESIDE_RECORD of the last one's, so the bound is met after six.
STABLE, ROUNDS = 0.01, 8


def project_parts(name: str | None, g: Gazetteer) -> tuple[str | None, str | None, str | None, str | None]:
    """(brand, compact name, ending, phase) of a project's typed name."""
    tokens = [t for t in "".join(c if c.isalnum() else " " for c in (name or "").upper()).split() if t]
    brand = None
    for k, t in enumerate(tokens[:2]):
        found, glued = g.brands.find(t), _brand_before(t, g)
        if found or glued:
            brand = found or glued
            tokens = ([] if found else [t[len(glued) :]]) + tokens[k + 1 :]
            break
    words, ending, phase = [], None, None
    if brand and (not tokens or tokens[0] in SUFFIX or tokens[0] in ("PHASE", "PH")):  # nothing but the first word is the name
        brand, words = None, [brand]
    for k, t in enumerate(tokens):
        if t in ("PHASE", "PH") and k + 1 < len(tokens) and tokens[k + 1] in _ROMAN:
            phase = _ROMAN[tokens[k + 1]]
            ending = f"PHASE {phase}"
            break
        if t in SUFFIX and words:
            ending = SUFFIX[t]
            break
        words.append(t)
    return brand, "".join(words) or None, ending, phase


def record_nodes(catalogue: DataFrame, mapped: DataFrame, g: Gazetteer) -> DataFrame:
    """(rec_id, name, brand, ending, phase, city, locality): what each catalogue record tells; `mapped` has its locality_id or -1."""
    names = {i: " ".join(k) for k, places in g.by_name.items() for i in places}
    towns = {i: c for places in g.by_name.values() for i, (c, _) in places.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = []
            for rec, name, city, pin, loc in zip(t["rec_id"], t["p"], t["c"], t["pin"], t["loc"], strict=True):
                brand, word, ending, phase = project_parts(name, g)
                place = int(loc) if loc == loc and loc is not None and loc >= 0 else None
                town = g.cities.find(city) if isinstance(city, str) else None
                town = town or towns.get(place) or (g.area.get(pin[:3]) if isinstance(pin, str) else None)
                rows.append((rec, word, brand, ending, phase, town, names.get(place)))
            yield pd.DataFrame(rows, columns=["rec_id", "name", "brand", "ending", "phase", "city", "locality"], dtype=object)

    c = catalogue.select("rec_id", F.col("projectname").alias("p"), F.upper(city_text(F.col("city"))).alias("c"), F.trim("pincode").alias("pin")).where("rec_id IS NOT NULL AND p IS NOT NULL")
    c = c.join(mapped.select("rec_id", F.col("locality_id").alias("loc")), "rec_id", "left")
    return c.mapInPandas(run, "rec_id bigint, name string, brand string, ending string, phase string, city string, locality string").where("name IS NOT NULL")


ATTRIBUTES = ["name", "brand", "ending", "phase", "locality", "city"]
#: Letters at either end of a name that are a rare attribute together with its first word and locality.
END_LETTERS = 3


def _rare_keys() -> Column:
    """Hashes of (first word, locality, an end of the name) of a node: attributes that few nodes share, which meet also where a name has several slips."""
    ends = [F.substring("name", 1, END_LETTERS), F.expr(f"right(name, {END_LETTERS})")]
    told = F.col("brand").isNotNull() & F.col("locality").isNotNull()
    return F.when(told, F.array(*(F.xxhash64(F.lit(side), F.col("brand"), F.col("locality"), e) for side, e in enumerate(ends)))).otherwise(F.array().cast("array<bigint>"))


def _candidates(mn: DataFrame, rn: DataFrame) -> DataFrame:
    """(m, r): the pairs of nodes that share a rare attribute: a deletion form of the name in one city, or in any where one of them
    tells no city, or one of the rare keys. Only hashes and ids are exploded and shuffled.

    A name that every city has is a group for each city; without a city a node meets the few nodes of the other side that have its name.
    """
    city, none = F.col("city").isNotNull(), F.col("city").isNull()
    forms = lambda d, k, *by: d.select(k, *by, F.explode(deletion_forms(F.col("name"))).alias("form")).select(k, F.xxhash64(*by, "form").alias("key"))
    rare = lambda d, k: d.select(k, F.explode(_rare_keys()).alias("key"))
    legs = [(forms(mn.where(city), "m", "city"), forms(rn.where(city), "r", "city")), (forms(mn.where(none), "m"), forms(rn, "r")), (forms(mn.where(city), "m"), forms(rn.where(none), "r")), (rare(mn, "m"), rare(rn, "r"))]
    met = [a.join(b, "key").select("m", "r") for a, b in legs]
    return reduce(DataFrame.unionByName, met).distinct()


def collective_links(rows: DataFrame, catalogue: DataFrame, mapped: DataFrame, g: Gazetteer) -> DataFrame:
    """(row_id, rec_id, confidence): all pairs of a row and a catalogue record whose project the row's own address lies in.

    Rows that tell the same (name, first word, ending, phase, locality, city of a building) are one node, as are records; so copies and hot projects weigh nothing.
    Nodes meet where they share a rare attribute (see `_candidates`). An edge needs names at most two slips apart, of which the second one must be
    made up for by a first word and locality in common; it weighs the rarity of the attributes shared, out of those that both sides tell, and contradicting
    cities, localities, first words or phases leave no edge. Meta-blocking prunes each
    node's edges below PRUNE of its heaviest. Then an edge's similarity is mixed with those of the edges beside it, from like-named rows of the
    city to the same record and from the same row to the project's other listings, until no similarity changes by more than STABLE.
    A node that tells no city takes part only with the one city its best edges lead to. Streets, rows without a parsed name, null keys and empty tables give no links; other columns aren't read.
    """
    node = F.unhex(F.md5(F.concat_ws("\u0001", *(F.coalesce(F.col(c), F.lit("\u0002")) for c in ATTRIBUTES))))
    p = settled_parts(rows.select("row_id", "address", "zip"), g).where("family = 'B'").select("row_id", *ATTRIBUTES, node.alias("m"))
    r = record_nodes(catalogue, mapped.select("rec_id", "locality_id"), g).select("rec_id", *ATTRIBUTES, node.alias("r"))
    p, r = cut_lineage(p), cut_lineage(r)
    mn, rn = (cut_lineage(d.select(k, *ATTRIBUTES).distinct()) for d, k in ((p, "m"), (r, "r")))

    both = cut_lineage(mn.select(*ATTRIBUTES).unionByName(rn.select(*ATTRIBUTES)))
    total = max(1, both.count())
    weighed = rn
    for c in ("name", "brand", "ending", "locality", "city"):
        rarity = both.where(F.col(c).isNotNull()).groupBy(c).agg((F.log(F.lit(total + 1.0) / F.count("*")) + 0.05).alias(f"w_{c}"))
        weighed = weighed.join(rarity, c, "left")
    weighed = cut_lineage(weighed)
    left = mn.select("m", *(F.col(c).alias(f"{c}_m") for c in ATTRIBUTES))
    right = weighed.select("r", *(F.col(c).alias(f"{c}_r") for c in ATTRIBUTES), "w_name", "w_brand", "w_ending", "w_locality", "w_city")
    met = cut_lineage(_candidates(mn, rn)).join(right, "r").join(left, "m").where(agree("city", "m", "r") & agree("locality", "m", "r") & agree("brand", "m", "r") & agree("phase", "m", "r"))
    slips = F.when(F.col("name_m") == F.col("name_r"), 0).when(one_slip(F.col("name_m"), F.col("name_r")), 1).when(F.levenshtein(F.col("name_m"), F.col("name_r")) <= 2, 2)
    made_up = F.coalesce((F.col("brand_m") == F.col("brand_r")) & (F.col("locality_m") == F.col("locality_r")), F.lit(False)) & (F.least(F.length("name_m"), F.length("name_r")) >= 2 * END_LETTERS)
    met = cut_lineage(met.withColumn("slips", slips).where((F.col("slips") <= 1) | ((F.col("slips") == 2) & made_up)))
    same = lambda c: F.col(f"{c}_m") == F.col(f"{c}_r")
    w = lambda c: F.coalesce(F.col(f"w_{c}"), F.lit(0.0))
    got = F.element_at(F.array(F.lit(1.0), F.lit(0.7), F.lit(0.4)), F.col("slips") + 1) * w("name")
    most = w("name")
    for c in ("brand", "ending", "locality", "city"):
        got = got + F.when(same(c), w(c)).otherwise(0.0)
        most = most + F.when(F.col(f"{c}_m").isNotNull() & F.col(f"{c}_r").isNotNull(), w(c)).otherwise(0.0)
    edges = met.withColumn("weight", got).withColumn("own", got / most)
    tops = edges.groupBy("m").agg(F.max("weight").alias("top_m"))
    tops_r = edges.groupBy("r").agg(F.max("weight").alias("top_r"))
    edges = edges.join(tops, "m").join(tops_r, "r").where((F.col("weight") >= PRUNE * F.col("top_m")) | (F.col("weight") >= PRUNE * F.col("top_r")))
    city = F.coalesce("city_r", "city_m")
    edges = cut_lineage(edges.select("m", "r", F.xxhash64("r", "name_m", city).alias("at_record"), F.xxhash64("m", "name_r", city).alias("at_row"), "city_m", city.alias("city"), "weight", "own", F.col("own").alias("now")))
    for _ in range(ROUNDS):
        beside_row = edges.groupBy("at_record").agg(F.avg("now").alias("like_row"))
        beside_record = edges.groupBy("at_row").agg(F.avg("now").alias("like_record"))
        mixed = edges.join(beside_row, "at_record").join(beside_record, "at_row")
        new = OWN * F.col("own") + BESIDE_ROW * F.col("like_row") + BESIDE_RECORD * F.col("like_record")
        moved = cut_lineage(mixed.select("m", "r", "at_record", "at_row", "city_m", "city", "weight", "own", new.alias("next"), F.abs(new - F.col("now")).alias("moved")))
        most_moved = moved.agg(F.max("moved").alias("x")).first()["x"] or 0.0
        edges = moved.withColumnRenamed("next", "now").drop("moved")
        if most_moved <= STABLE:
            break
    best = edges.where("city_m IS NULL").groupBy("m", "city").agg(F.max("now").alias("s"), F.max("weight").alias("top")).groupBy("m").agg(F.max_by("city", F.struct("s", "top", "city")).alias("best_city"))
    edges = edges.join(best, "m", "left").where("city_m IS NOT NULL OR city <=> best_city")
    kept = edges.where(F.col("now") >= CONFIDENCE).select("m", "r", F.round("now", 4).alias("confidence"))
    # written here, so that what is sent to every worker is bounded as in the steps before
    return cut_lineage(kept.join(p.select("row_id", "m"), "m").join(r.select("rec_id", "r"), "r").groupBy("row_id", "rec_id").agg(F.max("confidence").alias("confidence")))
