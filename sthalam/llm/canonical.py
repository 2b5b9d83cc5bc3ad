"""Freely typed values mapped to a canonical list by a prefix-filter set-similarity join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sthalam.session import cut_lineage

#: Least Jaccard similarity of two values' token sets: one changed, lost, added or exchanged letter in a stem of five or more.
SIMILARITY = 0.3
#: Short forms of the words that end a locality's name (fixed values), and those words.
SHORT = {"lyt": "layout", "clny": "colony", "ngr": "nagar", "pm": "puram", "extn": "extension", "ext": "extension", "gdns": "gardens", "gdn": "gardens", "garden": "gardens"}
KINDS = ["nagar", "gardens", "halli", "pete", "layout", "vihar", "extension", "wadi", "colony", "puram"]
#: What people type when they have no value (fixed values).
PLACEHOLDERS = ["", "0", "na", "n a", "nil", "none", "null", "not known", "unknown", "other", "others", "unspecified", "not available"]


def plain(c: Column) -> Column:
    """Lower case, what isn't a letter or figure as one blank, no outer blanks."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def locality_text(c: Column) -> Column:
    """A typed locality without what stands beside the name: brackets, what follows a comma, post-office marks, "near", "off",
    directions and stages; short forms written out; null for a placeholder."""
    x = F.regexp_replace(F.lower(c), r"\([^)]*\)|,.*$", " ")
    x = plain(F.regexp_replace(x, r"\b([sbhg])\.\s*([op])\b\.?", " "))
    x = F.regexp_replace(x, r"^(off|near|nr|opp|opposite|behind|beside|at|by)\s+", "")
    x = F.regexp_replace(x, r"\s+(stage|phase|sector|block)\s+\w+$", "")
    x = F.regexp_replace(x, r"\s+(east|west|north|south|main|cross)$", "")
    short = F.create_map(*(F.lit(x) for kv in SHORT.items() for x in kv))
    x = F.array_join(F.transform(F.split(x, " "), lambda w: F.coalesce(F.element_at(short, w), w)), " ")
    return F.when(x.isin(PLACEHOLDERS), None).otherwise(x)


def city_text(c: Column) -> Column:
    """A typed city without "City", "Urban", "Dist." and the like; null for a placeholder."""
    x = F.regexp_replace(plain(c), r"\s+(city|urban|rural|dist|district|town|municipality)$", "")
    return F.when(x.isin(PLACEHOLDERS), None).otherwise(x)


def compact(c: Column) -> Column:
    return F.regexp_replace(c, " ", "")


#: The word for a kind of locality at the end of a value, blank or no blank before it.
KIND_END = rf"^.{{2,}}?({'|'.join(KINDS)})$"


def name_tokens(stem: Column, kind: Column) -> Column:
    """The runs of three letters of the stem, with marks at both ends, and its kind as a token.

    Threes are rare enough to tell values apart: the words of a prefix hold some ten thousand different ones, against several hundred pairs.
    """
    padded = F.concat(F.lit("^^"), stem, F.lit("$$"))
    threes = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))
    return F.array_distinct(F.concat(threes, F.when(kind != "", F.array(F.concat(F.lit("kind:"), kind))).otherwise(F.array().cast("array<string>"))))


def similar_values(left: DataFrame, right: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(left_id, right_id, jaccard) of all values of `left` (id, tokens) and `right` (id, tokens) at least `similarity` alike.

    Exact: tokens are ordered by how many values of both sides have them, the rarest first, and the values meet on the tokens of
    their prefixes only, of which two that are alike must share one; sizes and the position of the shared token bound the
    overlap before the sets are compared. Ids with null or empty tokens meet nothing. Repeated ids are taken once.

    Nothing is capped. The values are the distinct ones on both sides (copies are joined back afterwards by the caller), so a value
    that holds a third of all rows is one row here.
    """
    sides = left.select(F.lit(0).alias("side"), F.col("id"), "tokens").unionByName(right.select(F.lit(1).alias("side"), F.col("id"), "tokens"))
    sides = sides.where(F.size("tokens") > 0).dropDuplicates(["side", "id"])
    each = sides.select("side", "id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    rarity = each.groupBy("token").agg(F.count("*").alias("often"))
    ranked = each.join(rarity, "token").groupBy("side", "id", "n").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("order"))
    ranked = cut_lineage(ranked.select("side", "id", "n", F.col("order.token").alias("tokens")))
    prefix = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    heads = ranked.select("side", "id", "n", "tokens", F.posexplode(F.slice("tokens", F.lit(1), prefix.cast("int"))).alias("at", "token"))
    a = heads.where("side = 0").select("token", F.col("id").alias("left_id"), F.col("n").alias("na"), F.col("at").alias("pa"), F.col("tokens").alias("ta"))
    b = heads.where("side = 1").select("token", F.col("id").alias("right_id"), F.col("n").alias("nb"), F.col("at").alias("pb"), F.col("tokens").alias("tb"))
    t = similarity - 1e-9
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))  # what can still be shared from here on
    first = (F.slice("ta", F.lit(1), F.col("pa")), F.slice("tb", F.lit(1), F.col("pb")))
    met = a.join(b, "token").where((F.col("na") >= t * F.col("nb")) & (F.col("nb") >= t * F.col("na")))
    met = met.where(~F.arrays_overlap(*first))  # each pair only at its first shared token
    met = met.where(rest * (1 + t) >= t * (F.col("na") + F.col("nb")))
    shared = F.size(F.array_intersect("ta", "tb"))
    return met.withColumn("jaccard", shared / (F.col("na") + F.col("nb") - shared)).where(F.col("jaccard") >= t).select("left_id", "right_id", "jaccard")


def one_slip(a: Column, b: Column) -> Column:
    """Whether two stems are equal or differ in one letter changed, lost or added, or two neighbours exchanged."""
    i = F.length(F.regexp_extract(F.concat_ws("\u0001", a, b), r"^(\p{L}*)[^\u0001]*\u0001\1", 1))
    swapped = F.concat(F.substring(a, F.lit(1), i), F.substring(a, i + 2, F.lit(1)), F.substring(a, i + 1, F.lit(1)), F.substring(a, i + 3, F.length(a)))
    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & (swapped == b))


def map_localities(records: DataFrame, localities: DataFrame) -> DataFrame:
    """(rec_id, locality_id, jaccard): the locality meant by each record's typed `sublocation` and `city`.

    One row for each `rec_id` of `records` (rec_id, sublocation, city, pincode, all_pincodes, projectname) with a `sublocation` that isn't
    null (rows that repeat a rec_id count as one record, whose best row holds); -1 with a null similarity where the list (locality_id, locality, city, pincode) has none. Of the list's entries at least
    SIMILARITY alike, those remain whose kind doesn't differ and whose stem is one slip away; a known city must be the record's.
    Where the city isn't known, the record's pins, then the city that the pins' first three figures stand for, then the city of
    another listing of the same project name and locality decide. Ties: the more alike, then the one with a shared pin, then the lower id. Blank values
    and placeholders have none. Empty tables give empty results; other columns aren't read.
    """
    entry = localities.select(F.col("locality_id"), locality_text(F.col("locality")).alias("name"), city_text(F.col("city")).alias("city"), F.trim("pincode").alias("pin")).where("locality_id IS NOT NULL AND name IS NOT NULL")
    by_pin = entry.where("city IS NOT NULL AND length(pin) >= 3").groupBy(F.substring("pin", 1, 3).alias("area"), "city").count().groupBy("area").agg(F.max_by("city", F.struct("count", "city")).alias("area_city"))
    listed = entry.groupBy("locality_id", "name").agg(F.max("city").alias("own_city"), F.sort_array(F.collect_set("pin")).alias("pins"))
    listed = listed.withColumn("area", F.substring(F.get("pins", F.lit(0)), 1, 3))
    listed = listed.join(F.broadcast(by_pin), "area", "left").select("locality_id", "name", F.coalesce("own_city", "area_city").alias("l_city"), "pins")  # as many areas as first three figures: at most 1,000
    by_pin, listed = cut_lineage(by_pin), cut_lineage(listed)
    cities = listed.where("l_city IS NOT NULL").select(F.col("l_city").alias("id")).distinct()

    pins = F.filter(F.split(F.concat_ws(";", "pincode", "all_pincodes"), r"\s*;\s*"), lambda p: p != "")
    r = records.where("sublocation IS NOT NULL").select("rec_id", "sublocation", "city", F.array_distinct(pins).alias("r_pins"), compact(plain(F.col("projectname"))).alias("project"))

    # each typed spelling is cleaned once, however many records have it
    spelt = cut_lineage(r.where("city IS NOT NULL").select("city").distinct().select("city", city_text(F.col("city")).alias("typed")).where("typed IS NOT NULL"))
    bag = lambda d: d.select("id", name_tokens(compact(F.col("id")), F.lit("")).alias("tokens"))
    near = similar_values(bag(spelt.select(F.col("typed").alias("id")).distinct()), bag(cities), 0.2).where(one_slip(compact(F.col("left_id")), compact(F.col("right_id"))))
    city_of = near.groupBy("left_id").agg(F.max_by("right_id", F.struct("jaccard", "right_id")).alias("r_city")).withColumnRenamed("left_id", "typed")
    city_of = cut_lineage(spelt.join(city_of, "typed").select("city", "r_city"))

    # localities: each distinct stem and kind once; what is worked out of a name is kept, since later steps would work it out again
    named = cut_lineage(r.select("sublocation").distinct().select("sublocation", locality_text(F.col("sublocation")).alias("name")).where("name IS NOT NULL"))
    split = lambda d: d.withColumn("squeezed", compact(F.col("name"))).withColumn("kind", F.regexp_extract("squeezed", KIND_END, 1))
    whole = lambda d: cut_lineage(split(d).withColumn("stem", F.expr("substring(squeezed, 1, length(squeezed) - length(kind))")).withColumn("form", F.concat_ws("|", "stem", "kind")))
    named, listed = whole(named), whole(listed)
    r = r.join(named.select("sublocation", "form"), "sublocation", "left")
    forms = lambda d: d.where("stem <> ''").select(F.col("form").alias("id"), "stem", "kind").distinct().select("id", name_tokens(F.col("stem"), F.col("kind")).alias("tokens"))
    alike = similar_values(forms(named), forms(listed))
    part = lambda c, k: F.substring_index(c, "|", k)
    alike = alike.where(one_slip(part(F.col("left_id"), 1), part(F.col("right_id"), 1)))
    kind_a, kind_b = part(F.col("left_id"), -1), part(F.col("right_id"), -1)
    alike = cut_lineage(alike.where((kind_a == "") | (kind_b == "") | (kind_a == kind_b)))

    choice = alike.withColumnRenamed("left_id", "form").join(listed.select(F.col("form").alias("right_id"), "locality_id", "l_city", "pins"), "right_id").drop("right_id")
    r = r.join(city_of, "city", "left")
    r = cut_lineage(r.withColumn("area", F.substring(F.get("r_pins", F.lit(0)), 1, 3)).join(F.broadcast(by_pin), "area", "left"))
    known = r.where("r_city IS NOT NULL").groupBy("project", "form").agg(F.max("r_city").alias("elsewhere"), F.countDistinct("r_city").alias("towns")).where("towns = 1").drop("towns")
    r = r.join(known, ["project", "form"], "left")
    c = r.join(choice, "form", "left")
    shared = F.coalesce(F.arrays_overlap("pins", "r_pins"), F.lit(False))
    # without a usable city of its own, what stands behind a candidate decides; with one, only that city's do
    behind = F.when(F.col("r_city").isNotNull(), F.lit(0)).when(shared, 3).when(F.col("l_city") == F.col("area_city"), 2).when(F.col("l_city") == F.col("elsewhere"), 1).otherwise(0)
    fits = F.col("locality_id").isNotNull() & (F.col("r_city").isNull() | F.col("l_city").isNull() | (F.col("l_city") == F.col("r_city")))
    score = F.when(fits, F.struct(behind.alias("behind"), F.col("jaccard"), shared.cast("int").alias("pin"), (-F.col("locality_id")).alias("low"), F.col("locality_id").alias("found")))
    best = c.groupBy("rec_id").agg(F.max(score).alias("best"))
    return best.select("rec_id", F.coalesce("best.found", F.lit(-1).cast("bigint")).alias("locality_id"), F.col("best.jaccard").alias("jaccard"))


def unmatched_values(records: DataFrame, mapped: DataFrame) -> DataFrame:
    """(sublocation, records): the typed values without a counterpart and how many records have them."""
    lost = mapped.where("locality_id = -1").select("rec_id").distinct()
    return records.where("sublocation IS NOT NULL").join(lost, "rec_id", "left_semi").groupBy(F.lower(F.trim("sublocation")).alias("sublocation")).agg(F.count("*").alias("records"))
