"""Which catalogue record an address lies in, by name, locality and pin, and which rule says so."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from sthalam.functions import text as T
from sthalam.functions import words as W
from sthalam.operators import matching as M
from sthalam.operators.spatial import haversine
from sthalam.session import cut_lineage

#: Kinds of a candidate in the order in which one is preferred to another (fixed values).
KINDS = ["exact", "collapsed", "fuzzy_strong", "fuzzy", "partial", "glued", "building_name"]


@dataclass
class Dimensions:
    """The lists that addresses are matched to, each as a table."""

    records: DataFrame  # rec_id, city_key, name, sub, base, brand, generic, phases, shown, shown_sub, alone
    names: DataFrame  # city_key, name
    fragments: DataFrame  # city_key, run, name
    pin_forms: DataFrame  # pin, form
    place_pins: DataFrame  # city_key, base, pin
    pin_city: DataFrame  # pin, pin_city
    pin_geo: DataFrame  # pin, lat, lon
    localities: DataFrame  # pin, locality, norm, ord
    cities: DataFrame  # city_key, city


def place_pins(catalogue: DataFrame) -> DataFrame:
    """(city_key, base, pin): the pins that sure records give for a city's sub-locality, each once."""
    c = catalogue.where("city IS NOT NULL AND sublocation IS NOT NULL")
    sure = c.where("pincode_confidence IN ('high', 'medium')") if "pincode_confidence" in c.columns else c
    pins = sure.select(T.city_key(F.col("city")).alias("city_key"), T.locality_base(T.match_text(F.col("sublocation"))).alias("base"), F.explode(F.split("all_pincodes", ";")).alias("pin"))
    return pins.withColumn("pin", F.trim("pin")).where("pin <> ''").distinct()


def dimensions(catalogue: DataFrame, localities: DataFrame, points: DataFrame | None = None) -> Dimensions:
    """All dimension tables from a catalogue (rec_id, projectname, city, sublocation, all_pincodes, pincode_confidence), a list of
    localities (pincode, locality, city, source) and, if there are any, points (pin, latitude, longitude)."""
    c = catalogue.where("projectname IS NOT NULL AND city IS NOT NULL AND sublocation IS NOT NULL")
    r = c.select("rec_id", T.city_key(F.col("city")).alias("city_key"), T.match_text(F.col("projectname")).alias("name"), T.match_text(F.col("sublocation")).alias("sub"), F.col("projectname").alias("shown"), F.trim("sublocation").alias("shown_sub"))
    r = r.where("name <> '' AND sub <> '' AND city_key <> ''")
    r = r.groupBy("city_key", "name", "sub").agg(F.min(F.struct("rec_id", "shown", "shown_sub")).alias("f")).select("city_key", "name", "sub", "f.*")
    r = r.withColumn("base", T.locality_base(F.col("sub"))).withColumn("brand", F.get(T.tokens(F.col("name")), F.lit(0))).withColumn("generic", T.generic_name(F.col("name"))).withColumn("phases", T.phase_numbers(F.col("name")))
    r = r.withColumn("alone", F.count("*").over(Window.partitionBy("city_key", "name")) == 1)
    place = place_pins(c)
    n = T.match_text(T.clean_locality(F.col("locality")))
    forms = localities.select(F.trim("pincode").alias("pin"), F.explode(F.array_distinct(F.array(n, T.locality_base(n)))).alias("form")).where(F.length("form") >= 3).distinct()
    by_city = localities.where("city IS NOT NULL AND source <> 'post_list'").groupBy(F.trim("pincode").alias("pin"), T.city_key(F.col("city")).alias("k")).count()
    pin_city = by_city.groupBy("pin").agg(F.max(F.struct("count", "k")).alias("t")).select("pin", F.col("t.k").alias("pin_city"))
    spark = catalogue.sparkSession
    geo = spark.createDataFrame([], "pin string, lat double, lon double") if points is None else points.where("latitude <> 0 AND longitude <> 0 AND pin IS NOT NULL").groupBy("pin").agg(F.min(F.struct("latitude", "longitude")).alias("g")).select("pin", F.col("g.latitude").alias("lat"), F.col("g.longitude").alias("lon"))
    listed = localities.select(F.trim("pincode").alias("pin"), F.trim("locality").alias("locality"), n.alias("norm")).where(F.length("norm") >= 4).distinct()
    cities = c.groupBy(T.city_key(F.col("city")).alias("city_key"), F.trim("city").alias("city")).count().groupBy("city_key").agg(F.max_by("city", F.struct("count", "city")).alias("city"))
    r = cut_lineage(r)
    names = cut_lineage(r.select("city_key", "name").distinct())
    # a fragment must be a name of its own: no place, and two words that not every project has
    places = r.select("city_key", F.explode(F.array("sub", "base")).alias("run")).distinct()
    generic = F.array(*(F.lit(x) for x in W.GENERIC_WORDS))
    own = F.size(F.filter(T.tokens(F.col("run")), lambda w: (F.length(w) >= 4) & ~F.array_contains(generic, w))) >= 2
    fragments = M.unique_fragments(names, scope=("city_key",)).where(own).join(places, ["city_key", "run"], "left_anti")
    return Dimensions(r, names, *map(cut_lineage, (fragments, forms, place, pin_city, geo, listed, cities)))


def written_in(text: Column, form: Column) -> Column:
    """Whether a name stands in a text as whole words; of eight letters or more also with blanks inside or missing."""
    letters = F.regexp_replace(form, " ", "")
    loose = F.concat(F.lit("(?:^|[^A-Z0-9])"), F.regexp_replace(letters, "(.)(?=.)", "$1 ?"), F.lit("(?:$|[^A-Z0-9])"))
    exact = F.concat(F.lit(" "), text, F.lit(" ")).contains(F.concat(F.lit(" "), form, F.lit(" ")))
    return (F.length(form) >= 3) & F.regexp_replace(text, " ", "").contains(letters) & (exact | ((F.length(letters) >= 8) & F.rlike(text, loose)))


@F.pandas_udf(BooleanType())
def _near_window(text: pd.Series, letters: pd.Series, size: pd.Series) -> pd.Series:
    """Whether a run of about `size` words is 92 or more alike to `letters`."""

    def one(t: str | None, c: str | None, n: int) -> bool:
        if not t or not c or len(c) < 8:
            return False
        w = t.split()
        return any(M.indel_ratio(c, x) >= 92 for k in {max(1, n - 1), n, n + 1} for i in range(len(w) - k + 1) if abs(len(x := "".join(w[i : i + k])) - len(c)) <= 0.16 * len(c))

    return pd.Series([one(*x) for x in zip(text, letters, size, strict=True)], dtype=bool)


def candidates(a: DataFrame, dims: Dimensions) -> DataFrame:
    """(id, city_key, name, kind, span): the project names that an address may tell, each by its best kind.

    `a` has (id, city_key, text, building). Exact runs of words; a brand's word with the compact name anywhere; runs from a brand's word that score
    92 or more; fragments that only one name has; long names glued into the text; and the parsed building itself.
    """
    kind = lambda d, k, span: d.select("id", "city_key", "name", F.lit(k).alias("kind"), span.alias("span"))
    base = a.select("id", "city_key", "text")
    starts = M.first_words(dims.names, scope=("city_key",)).unionByName(M.first_words(dims.fragments, "run", ("city_key",))).distinct()
    runs = cut_lineage(M.word_runs(base, "id", F.col("text"), 1, 8, ("city_key",), starts))
    exact = runs.where((F.col("size") >= 2) | (F.length("run") >= 8)).join(dims.names.withColumn("run", F.col("name")), ["city_key", "run"])
    letters = F.regexp_replace("text", " ", "")
    inside = cut_lineage(M.contained_names(base, "id", letters, dims.names, scope=("city_key",)))
    brand = dims.names.withColumn("brand", F.get(T.tokens(F.col("name")), F.lit(0))).where(~F.col("brand").isin(W.BRAND_STOP))
    collapsed = inside.join(brand, ["city_key", "name"]).join(base.select("id", "text"), "id").where(F.array_contains(T.tokens(F.col("text")), F.col("brand")))
    glued = inside.where(F.length(F.regexp_replace("name", " ", "")) >= 12)
    n_words = lambda c: F.size(T.tokens(F.col(c)))
    windows = runs.where("size BETWEEN 2 AND 6").withColumn("brand", F.substring_index("run", " ", 1))
    pool = brand.where(n_words("name") >= 2)
    near = M.near_pairs(windows.select("city_key", "brand", F.col("run").alias("a")), pool.select("city_key", "brand", F.col("name").alias("b")), ["city_key", "brand"], 92.0)
    near = windows.join(near.where(F.abs(n_words("b") - n_words("a")) <= 1).withColumn("run", F.col("a")), ["city_key", "brand", "run"])
    figures = lambda c: F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0))
    strong = (F.col("score") >= 93) & (figures(F.col("a")) == figures(F.col("b")))
    fuzzy = near.select("id", "city_key", F.col("b").alias("name"), F.when(strong, "fuzzy_strong").otherwise("fuzzy").alias("kind"), F.col("a").alias("span"))
    partial = runs.where("size BETWEEN 2 AND 6").join(dims.fragments, ["city_key", "run"])
    own = a.select("id", "city_key", T.match_text(F.col("building")).alias("name")).join(dims.names, ["city_key", "name"])
    every = kind(exact, "exact", F.col("run"))
    for d in (kind(collapsed, "collapsed", F.col("name")), fuzzy, kind(partial, "partial", F.col("run")), kind(glued, "glued", F.col("name")), kind(own, "building_name", F.col("name"))):
        every = every.unionByName(d)
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    return every.groupBy("id", "city_key", "name").agg(F.min(F.struct(rank.alias("o"), (-F.length("span")).alias("l"), "kind", "span")).alias("b")).select("id", "city_key", "name", "b.kind", "b.span")


def match_projects(addresses: DataFrame, dims: Dimensions) -> DataFrame:
    """(id, rec_id, project, sublocation, city_key, rule, reason): one row for each address; nulls and a reason where nothing matches.

    `addresses` has (id, address, zip, city, locality, building), the last three as far as they are known. A candidate is dropped where
    its phases contradict the address's or where it is named only as a landmark. It is accepted with its sub-locality written in the
    address or parsed from it (`project_locality`, with the pin as well `project_locality_pincode`), by the pin alone where the name is
    exact enough (`project_pincode`), or as the city's only project of its name within NEARBY_KM of the address's pin
    (`project_unique_nearby`). The best rule wins, then the longer name, then the earlier record. Other columns aren't read.
    """
    pin = T.pin_in(F.col("address"), F.col("zip"))
    a = addresses.select("id", F.coalesce("address", F.lit("")).alias("address"), pin.alias("pin"), T.city_key(F.col("city")).alias("own_city"), T.match_text(F.col("locality")).alias("locality"), F.col("building"))
    a = a.join(dims.cities.select(F.col("city_key").alias("own_city"), F.lit(True).alias("known")), "own_city", "left").join(dims.pin_city, "pin", "left")
    a = a.withColumn("city_key", F.coalesce(F.when(F.col("known"), F.col("own_city")), F.col("pin_city"))).withColumn("text", T.match_text(F.col("address")))
    a = cut_lineage(a.select("id", "pin", "city_key", "text", "locality", "building"))
    found = cut_lineage(candidates(a.where("city_key IS NOT NULL"), dims))
    c = found.join(a.select("id", "pin", "text", "locality"), "id").join(dims.records, ["city_key", "name"])
    first = F.get(T.tokens(F.col("span")), F.lit(0))
    conflict = T.phases_conflict(F.col("phases"), T.phase_numbers(F.col("text")))
    c = c.where(~conflict & ~T.named_as_landmark(T.tokens(F.col("text")), first))
    pf, pp = dims.pin_forms, dims.place_pins
    by_form = pf.select("pin", F.col("form").alias("base")).withColumn("pin_form", F.lit(True))
    by_sub = pf.select("pin", F.col("form").alias("sub")).withColumn("pin_sub", F.lit(True))
    c = c.join(by_form, ["pin", "base"], "left").join(by_sub, ["pin", "sub"], "left").join(pp.withColumn("pin_place", F.lit(True)), ["city_key", "base", "pin"], "left")
    pin_ok = F.coalesce("pin_form", F.lit(False)) | F.coalesce("pin_sub", F.lit(False)) | F.coalesce("pin_place", F.lit(False))
    rest = T.unglue(F.regexp_replace(F.replace(F.concat(F.lit(" "), F.col("text"), F.lit(" ")), F.concat(F.lit(" "), F.col("name"), F.lit(" ")), F.lit(" | ")), r"\s+", " "))
    letters = F.regexp_replace("sub", " ", "")
    parsed = F.coalesce((F.col("locality") == F.col("sub")) | (F.col("locality") == F.col("base")) | (F.regexp_replace("locality", " ", "") == letters), F.lit(False))
    c = c.withColumn("pin_ok", pin_ok).withColumn("rest", rest).withColumn("parsed", parsed)
    c = c.withColumn("written", F.coalesce(written_in(F.col("rest"), F.col("sub")) | written_in(F.col("rest"), F.col("base")), F.lit(False)))
    c = cut_lineage(c)
    sure, unsure = c.where("written OR parsed"), c.where("NOT (written OR parsed)")
    unsure = unsure.withColumn("written", _near_window(F.col("rest"), letters, F.size(T.tokens(F.col("sub")))))
    c = sure.unionByName(unsure).withColumn("loc_ok", F.col("written") | F.col("parsed"))
    here, there = dims.pin_geo.select("pin", F.col("lat").alias("y"), F.col("lon").alias("x")), dims.pin_geo.withColumnRenamed("pin", "p2")
    km = c.where("NOT loc_ok AND NOT pin_ok AND alone").select("id", "rec_id", "city_key", "base", "pin").join(here, "pin").join(pp.withColumnRenamed("pin", "p2"), ["city_key", "base"]).join(there, "p2")
    km = km.groupBy("id", "rec_id").agg(F.min(haversine(F.col("y"), F.col("x"), F.col("lat"), F.col("lon"))).alias("km"))
    c = c.join(km, ["id", "rec_id"], "left")
    nearby = F.col("alone") & F.col("kind").isin("exact", "collapsed") & ~F.col("generic") & F.coalesce(F.col("km") <= W.NEARBY_KM, F.lit(False))
    rule = F.when(F.col("loc_ok") & F.col("pin_ok"), "project_locality_pincode").when(F.col("loc_ok"), "project_locality").when(F.col("pin_ok"), "project_pincode").when(nearby, "project_unique_nearby")
    needs = F.col("kind").isin("fuzzy", "building_name", "glued") | F.col("generic")
    c = c.withColumn("rule", rule).withColumn("needs", needs & ~F.col("loc_ok") & rule.isNotNull())
    rank = T.lookup({k: str(v) for k, v in W.RULE_RANK.items()}, F.col("rule")).cast("int")
    good = F.when(F.col("rule").isNotNull() & ~F.col("needs"), F.struct(rank.alias("rank"), F.length("name").alias("l"), (-F.col("rec_id")).alias("o"), "rec_id", "shown", "shown_sub", "rule"))
    best = c.groupBy("id").agg(F.max(good).alias("b"), F.bool_or("needs").alias("generic_only"))
    any_name = found.select("id").distinct().withColumn("named", F.lit(True))
    out = a.select("id", "city_key").join(best, "id", "left").join(any_name, "id", "left")
    reason = F.when(F.col("b").isNotNull(), F.lit(None)).when(F.col("city_key").isNull(), "no_city").when(F.col("named").isNull(), "no_project").when(F.col("generic_only"), "generic_pincode_only").otherwise("subloc_mismatch")
    return out.select("id", "b.rec_id", F.col("b.shown").alias("project"), F.col("b.shown_sub").alias("sublocation"), "city_key", "b.rule", reason.alias("reason"))
