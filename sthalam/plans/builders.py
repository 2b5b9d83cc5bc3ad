"""Tables that runs need: the merged list of localities, pins for the catalogue's sub-localities, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sthalam.functions import text as T
from sthalam.functions import words as W
from sthalam.operators import summaries as S
from sthalam.operators.matching import fuzzy_pairs
from sthalam.operators.spatial import haversine, near_centres

#: How far each way of finding a pin is to be relied on (fixed values), best first.
METHODS = {"no_postal_code": "", "office_exact": "high", "combo_learned": "high", "office_fuzzy": "medium", "geocode_postcode": "medium", "geocode_nearest_po": "low", "city_default": "very_low", "unresolved": ""}
NO_POSTAL_CODE = ["dubai", "abu dhabi", "sharjah", "ajman", "fujairah", "ras al khaimah", "umm al quwain"]
BROAD_PLACES = ["city", "state", "country", "county", "state_district", "town", "region"]


def merge_localities(sheet: DataFrame, posts: DataFrame) -> DataFrame:
    """(pincode, locality, source) of a sheet and a post-office list (each: pincode, locality); pins are six figures; the sheet's spelling stays."""
    key = lambda d: d.where(F.trim("pincode").rlike("^[0-9]{6}$")).select(F.trim("pincode").alias("pincode"), T.match_text(T.clean_locality(F.col("locality"))).alias("name"), T.clean_locality(F.col("locality")).alias("locality")).where("name <> ''")
    return S.merge_sources(key(sheet), key(posts), ["pincode", "name"], "locality", ("listing_sheet", "post_list")).select("pincode", "locality", "source").orderBy("pincode", "locality")


def office_key(c):
    """An office's or sub-locality's name without post-office marks and brackets, in match form."""
    return T.match_text(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", " "), r"(?i)\b[SBHG]\.? ?[OP]\.?(?= *$)|\bG\.P\.O\.?", " "))


def catalogue_pins(catalogue: DataFrame, points: DataFrame, learned: DataFrame, geocodes: DataFrame | None = None) -> DataFrame:
    """(city_key, sub, pincode, all_pincodes, pincode_source, pincode_confidence): every pair of city and sub-locality of the catalogue once.

    In this order: cities without postal codes; an office of that name within CITY_RADIUS_KM of the city's pins; pins learned from parsed
    rows (`learned`: sub, pin, n); offices nearly so called (ratio 90, six letters); a geocoded hit's postcode or the nearest point to it (`geocodes`: sub, lat, lon,
    postcode, at, and, if known, name and addresstype; broad areas and hits that are the city itself don't count, and the first one that is of use does); the pin nearest to the
    city's centre. Each step sees only what those before it left. A pair's pins in the districts of the city's own records are preferred to others, and a nearly so called office must be in one.
    """
    pairs = catalogue.where("city IS NOT NULL AND sublocation IS NOT NULL").groupBy(T.city_key(F.col("city")).alias("city_key"), office_key(F.col("sublocation")).alias("sub")).agg(F.count("*").alias("rows")).where("city_key <> '' AND sub <> ''")
    good = points.where("latitude <> 0 AND longitude <> 0 AND pin IS NOT NULL")
    geo = good.groupBy("pin").agg(F.min(F.struct("latitude", "longitude")).alias("g")).select("pin", F.col("g.latitude").alias("lat"), F.col("g.longitude").alias("lon"))
    centre = catalogue.select(T.city_key(F.col("city")).alias("city_key"), F.col("pincode").alias("pin")).join(geo, "pin").groupBy("city_key").agg(F.percentile_approx("lat", 0.5).alias("cy"), F.percentile_approx("lon", 0.5).alias("cx"))
    region = near_centres(geo, centre, W.CITY_RADIUS_KM).select("city_key", "pin", "lat", "lon").distinct()
    # districts that the city's records touch
    of_pin = points.where("pin IS NOT NULL AND district IS NOT NULL").groupBy("pin").agg(F.min("district").alias("district")) if "district" in points.columns else geo.select("pin", F.lit("").alias("district"))
    core = catalogue.select(T.city_key(F.col("city")).alias("city_key"), F.col("pincode").alias("pin")).join(of_pin, "pin").select("city_key", "district").distinct().join(of_pin, "district").select("city_key", "pin", F.lit(True).alias("core"))
    office = points.where("offices IS NOT NULL AND pin IS NOT NULL").select("pin", F.explode("offices").alias("o")).select("pin", office_key(F.col("o")).alias("office")).where("office <> ''").distinct().join(region.select("city_key", "pin"), "pin")

    def answer(d: DataFrame, how: str, core_only: bool = False) -> DataFrame:
        """Each pair's pins, those in the city's districts if there are any."""
        x = d.select("city_key", "sub", "pin").join(core, ["city_key", "pin"], "left")
        x = x.groupBy("city_key", "sub").agg(F.array_sort(F.collect_set(F.when(F.col("core"), F.col("pin")))).alias("own"), F.array_sort(F.collect_set("pin")).alias("any"))
        x = x.where(F.size("own") > 0) if core_only else x
        return x.select("city_key", "sub", F.when(F.size("own") > 0, F.col("own")).otherwise(F.col("any")).alias("pins"), F.lit(how).alias("how"))

    none = pairs.where(F.col("city_key").isin(NO_POSTAL_CODE)).select("city_key", "sub", F.array().cast("array<string>").alias("pins"), F.lit("no_postal_code").alias("how"))
    left = pairs.join(none, ["city_key", "sub"], "left_anti")
    found = none
    exact = answer(left.join(office.withColumnRenamed("office", "sub"), ["city_key", "sub"]), "office_exact")
    found, left = found.unionByName(exact), left.join(exact, ["city_key", "sub"], "left_anti")
    learned = learned.withColumn("__all", F.sum("n").over(Window.partitionBy("sub"))).where(F.col("n") >= W.LEARNED_SHARE * F.col("__all"))
    by_rows = learned.where(F.col("n") >= W.LEARNED_COUNT).join(region.select("city_key", "pin"), "pin")
    known = answer(left.join(by_rows, ["city_key", "sub"]), "combo_learned")
    found, left = found.unionByName(known), left.join(known, ["city_key", "sub"], "left_anti")
    letters = lambda c: F.regexp_replace(c, " ", "")
    a = left.select("city_key", "sub", letters("sub").alias("a")).where("length(a) >= 6")
    b = office.select("city_key", "pin", letters("office").alias("b")).where("length(b) >= 6")
    fuzzy = answer(fuzzy_pairs(a, b, ["city_key"], 90.0), "office_fuzzy", core_only=True)
    found, left = found.unionByName(fuzzy), left.join(fuzzy, ["city_key", "sub"], "left_anti")
    if geocodes is not None:
        told = {c: F.col(c) if c in geocodes.columns else F.lit(None).cast("string") for c in ("name", "addresstype")}
        hits = left.join(geocodes.select("sub", "lat", "lon", "postcode", "at", *(c.alias(f"h_{n}") for n, c in told.items())), "sub")
        hits = hits.where(~F.coalesce(F.lower("h_addresstype").isin(BROAD_PLACES), F.lit(False)) & ~F.coalesce(T.city_key(F.col("h_name")) == F.col("city_key"), F.lit(False)))
        # of a pair's hits the first that has a known postcode or a point near enough
        known = hits.join(geo.select(F.col("pin").alias("postcode"), F.lit(True).alias("known")), "postcode", "left").where("known").select("city_key", "sub", "at", F.col("postcode").alias("pin"), F.lit(0).alias("way"), F.lit(0.0).alias("km"))
        placed = hits.withColumnRenamed("lat", "y").withColumnRenamed("lon", "x").join(region, "city_key")
        placed = placed.withColumn("km", haversine(F.col("y"), F.col("x"), F.col("lat"), F.col("lon"))).where(F.col("km") <= W.CITY_RADIUS_KM + 15).select("city_key", "sub", "at", "pin", F.lit(1).alias("way"), "km")
        first = known.unionByName(placed).groupBy("city_key", "sub").agg(F.min(F.struct("at", "way", "km", "pin")).alias("f")).select("city_key", "sub", "f.way", "f.pin")
        coded = answer(first.where("way = 0"), "geocode_postcode")
        found, left = found.unionByName(coded), left.join(coded, ["city_key", "sub"], "left_anti")
        nearest = first.where("way = 1").select("city_key", "sub", "pin")
        nearest = answer(nearest, "geocode_nearest_po")
        found, left = found.unionByName(nearest), left.join(nearest, ["city_key", "sub"], "left_anti")
    middle = region.join(centre, "city_key").groupBy("city_key").agg(F.min_by("pin", F.struct(haversine(F.col("lat"), F.col("lon"), F.col("cy"), F.col("cx")), F.col("pin"))).alias("usual"))
    left = left.join(middle, "city_key", "left")
    rest = left.select("city_key", "sub", F.when(F.col("usual").isNotNull(), F.array("usual")).otherwise(F.array().cast("array<string>")).alias("pins"), F.when(F.col("usual").isNotNull(), "city_default").otherwise("unresolved").alias("how"))
    r = found.unionByName(rest)
    return r.select("city_key", "sub", F.get("pins", F.lit(0)).alias("pincode"), F.array_join("pins", ";").alias("all_pincodes"), F.col("how").alias("pincode_source"), T.lookup(METHODS, F.col("how")).alias("pincode_confidence"))


def with_pins(catalogue: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every catalogue row with its pair's pincode, all_pincodes, pincode_source and pincode_confidence in place of its own; a row without city or sub-locality has none."""
    own = ["pincode", "all_pincodes", "pincode_source", "pincode_confidence"]
    c = catalogue.drop(*own).withColumn("__c", T.city_key(F.col("city"))).withColumn("__s", office_key(F.col("sublocation")))
    return c.join(resolved.select(F.col("city_key").alias("__c"), F.col("sub").alias("__s"), *own), ["__c", "__s"], "left").drop("__c", "__s")


def pair_stats(rows: DataFrame) -> DataFrame:
    """(pincode_source, rows, pairs): rows and distinct pairs of city and sub-locality for each way of finding a pin."""
    return rows.groupBy(F.coalesce("pincode_source", F.lit("none")).alias("pincode_source")).agg(F.count("*").alias("rows"), F.count_distinct(F.struct(T.city_key(F.col("city")), office_key(F.col("sublocation")))).alias("pairs"))


def merge_stats(merged: DataFrame, level: str | None = None) -> DataFrame:
    """(source, n), with `level` for each level too: how many localities only the one list, only the other, and both have."""
    return merged.groupBy("source", *([level] if level else [])).agg(F.count("*").alias("n"))


REVIEW = ["row_id", "address", "zip", "building_name", "locality", "city", "dotcom_match_rule", "verdict", "notes"]


def review_sample(parsed: DataFrame, most: int = 50, seed: str = "20260923") -> DataFrame:
    """The REVIEW columns of at most `most` matched rows of each rule, with blank verdict and notes."""
    matched = parsed.where("dotcom_matched = 'Yes'").withColumn("dotcom_match_rule", F.lower(F.trim("dotcom_match_rule"))).dropDuplicates(["row_id"])
    s = S.per_stratum(matched, "dotcom_match_rule", "row_id", most, seed)
    return s.withColumn("verdict", F.lit("")).withColumn("notes", F.lit("")).select(*REVIEW)


def reviewed(sheet: DataFrame) -> DataFrame:
    """The rows of a filled review sheet whose verdict is correct, wrong or unsure, in any case."""
    return sheet.withColumn("verdict", F.lower(F.trim("verdict"))).where(F.col("verdict").isin("correct", "wrong", "unsure"))


def audit_sample(rows: DataFrame, n: int, address: str = "address", zip_code: str = "zip", key: str = "row_id", seed: int = 0) -> DataFrame:
    """(`key`, address, text, dropped): `n` rows, in the order of a hash of key and seed, before and after the cleaning."""
    from sthalam.plans.parse import prepare

    picked = rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)
    return prepare(picked, address, zip_code).select(key, F.col(address).alias("address"), "text", "dropped")


def run_report(parsed: DataFrame, seconds: float | None = None, states: DataFrame | None = None) -> str:
    """The counters, fill rates and confidence bins of a parsed table, as text: one pass over the table, one small result, and the counts of each rule and source.

    With `states` (pin, state) also how many rows' states agree with that of their pin, and the first twenty that don't.
    """
    columns = ["building_number", "building_name", "landmark", "locality", "city", "district"]
    n = lambda x, name: F.count_if(F.coalesce(x, F.lit(False))).alias(name)
    r = parsed.agg(*S.counters(), *(n(S.filled(x), x) for x in columns)).first()
    share = lambda x: f"{100 * r[x] / r['total']:.1f}%" if r["total"] else "0.0%"
    lines = [f"rows: {r['total']}", f"matched: {r['matched']} ({share('matched')})", f"zip missing: {r['zip_missing']}"]
    lines += [f"{x}: {r[x]} ({share(x)})" for x in columns] + [f"confidence {x}: {r[x]} ({share(x)})" for x in ("high", "middle", "low")]
    for c in ("dotcom_match_rule", "locality_source"):
        lines += [f"{c} {x[c] or 'none'}: {x['count']}" for x in parsed.groupBy(c).count().orderBy(F.desc("count"), c).limit(50).collect()]
    if states is not None:
        j = parsed.join(states.select(F.col("pin").alias("zip"), "state"), "zip", "left").withColumn("e", T.state_evidence(F.col("state_code"), F.col("state")))
        e = j.agg(n(F.col("e") == 1, "agree"), n(F.col("e") == -1, "differ")).first()
        lines += [f"state agrees: {e['agree']}", f"state differs: {e['differ']}"]
        lines += [f"  {x['row_id']}: {x['state_code']}, pin {x['zip']} is in {x['state']}" for x in j.where("e = -1").orderBy("row_id").limit(20).select("row_id", "state_code", "zip", "state").collect()] if "row_id" in parsed.columns else []
    if seconds:
        lines.append(f"rows per second: {r['total'] / seconds:.1f}")
    return "\n".join(lines) + "\n"
