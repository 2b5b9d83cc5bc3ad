"""Address rows that denote the same door, by a set-containment join over the parts of their addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sthalam.llm.address_parts import Gazetteer, address_parts
from sthalam.llm.canonical import one_slip
from sthalam.session import cut_lineage

#: Share of the poorer address's token weight that the fuller one must contain.
CONTAINED = 0.6
ATTRIBUTES = ["door", "wing", "family", "name", "brand", "ending", "phase", "locality", "city", "pin"]
#: Parts that are tokens of their own. Their values come from fixed lists, letters and six-figure pins, so the table of their rarities is bounded.
PARTS_OF_LISTS = ["wing", "brand", "ending", "phase", "locality", "city", "pin"]


def deletion_forms(word: Column) -> Column:
    """The word and the word without each of its letters; two words one slip apart share one of these."""
    return F.array_distinct(F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))))


def agree(c: str, a: str = "a", b: str = "b") -> Column:
    """Whether a part doesn't contradict: both sides tell the same, or one tells none."""
    return F.col(f"{c}_{a}").isNull() | F.col(f"{c}_{b}").isNull() | (F.col(f"{c}_{a}") == F.col(f"{c}_{b}"))


def canonical_names(spelt: DataFrame) -> DataFrame:
    """(city, family, name, canonical): the spellings of buildings' and streets' names in a city that stand for a commoner one, one slip
    away: with the same first word, kind of street or locality and no other one; a spelling that isn't rare (more than two rows) only for one
    at least twice as common. `spelt` has (city, family, name, brand, ending, locality, n); spellings that stay have no row.

    Spellings meet on hashes of their deletion forms within a city; only ids travel there, and what they stand for is joined and checked after.
    """
    each = spelt.where("name IS NOT NULL AND city IS NOT NULL").withColumn("way", F.when(F.col("family") == "S", F.col("ending")))
    known = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(F.col("n"), F.col(c))))[c].alias(c)
    merged = each.groupBy("city", "family", "name", "brand", "way", "locality").agg(F.sum("n").alias("n"))
    names = merged.groupBy("city", "family", "name").agg(F.sum("n").alias("n"), known("brand"), known("way"), known("locality"))
    names = cut_lineage(names.withColumn("id", F.xxhash64("city", "family", "name")))
    forms = names.select("id", "city", "family", F.explode(deletion_forms(F.col("name"))).alias("form")).select("id", F.xxhash64("city", "family", "form").alias("form"))
    met = forms.withColumnRenamed("id", "id_a").join(forms.withColumnRenamed("id", "id_b"), "form").where("id_a <> id_b").select("id_a", "id_b").distinct()
    side = lambda s: names.select(*(F.col(c).alias(f"{c}_{s}") for c in names.columns))
    near = met.join(side("a"), "id_a").join(side("b"), "id_b").where("city_a = city_b AND family_a = family_b AND name_a <> name_b")
    commoner = (F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("name_b") < F.col("name_a")))
    near = near.where(commoner & ((F.col("n_a") <= 2) | (F.col("n_b") >= 2 * F.col("n_a"))))
    speaks = (F.col("brand_a") == F.col("brand_b")) | (F.col("way_a") == F.col("way_b")) | (F.col("locality_a") == F.col("locality_b"))
    near = near.where(agree("brand") & agree("way") & agree("locality") & F.coalesce(speaks, F.lit(False)) & one_slip(F.col("name_a"), F.col("name_b")))
    best = near.groupBy(F.col("city_a").alias("city"), F.col("family_a").alias("family"), F.col("name_a").alias("name"))
    return best.agg(F.max_by("name_b", F.struct("n_b", "name_b")).alias("canonical"))


def settled_parts(rows: DataFrame, g: Gazetteer, key: str = "row_id") -> DataFrame:
    """The parts of every row that has a name or a door, the name canonical in its city.

    A city that only the row's zip tells, or nothing, gives way to the only city whose texts have the same name and first word. What changes is
    worked out over the distinct spellings and joined back; the planner sends it to every worker only where its measured size allows.
    """
    parts = cut_lineage(address_parts(rows, g, key=key).where(f"{key} IS NOT NULL AND (name IS NOT NULL OR door IS NOT NULL)").withColumn("sure", F.coalesce(F.col("told") == "text", F.lit(False))).drop("told", "locality_id"))
    spelt = cut_lineage(parts.where("name IS NOT NULL").groupBy("family", "name", "sure", "city", "brand", "ending", "locality").agg(F.count("*").alias("n")))
    only = spelt.where("sure").groupBy("family", "name").agg(F.min("city").alias("low"), F.max("city").alias("high")).where("low = high").select("family", "name", F.col("low").alias("only_city"))
    spelt = cut_lineage(spelt.join(only, ["family", "name"], "left").withColumn("own", F.col("city")).withColumn("city", F.when(F.col("sure"), F.col("city")).otherwise(F.coalesce("only_city", "city"))).drop("only_city"))
    better = canonical_names(spelt)
    change = spelt.select("family", "name", "sure", "own", "city").distinct().join(better, ["city", "family", "name"], "left").where("canonical IS NOT NULL OR NOT (city <=> own)")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    change = cut_lineage(change.select("family", "name", "sure", blank("own").alias("own"), F.col("city").alias("new_city"), "canonical", F.lit(True).alias("changed")))
    named = parts.withColumn("own", blank("city")).join(change, ["family", "name", "sure", "own"], "left")
    return named.withColumn("city", F.when(F.col("changed"), F.col("new_city")).otherwise(F.col("city"))).withColumn("name", F.coalesce("canonical", "name")).drop("own", "sure", "new_city", "canonical", "changed")


def _rarities(sets: DataFrame) -> tuple[int, DataFrame]:
    """How many distinct sets there are, and (part, value, n) of the values of PARTS_OF_LISTS among them."""
    values = F.explode(F.array(*(F.struct(F.lit(c).alias("part"), F.col(c).alias("value")) for c in PARTS_OF_LISTS))).alias("t")
    return sets.count(), cut_lineage(sets.select(values).select("t.part", "t.value").where("value <> ''").groupBy("part", "value").agg(F.count("*").alias("n")))


def _weighed(sets: DataFrame, rarities: tuple[int, DataFrame]) -> DataFrame:
    """`sets` with w_place and a w_ column for each of PARTS_OF_LISTS: how rare each token is among all distinct sets."""
    total, often = rarities
    rarity = lambda n: F.log((F.lit(total) + 1.0) / n) + 0.1
    for c in PARTS_OF_LISTS:
        own = often.where(F.col("part") == c).select(F.col("value").alias(c), rarity(F.col("n")).alias(f"w_{c}"))
        sets = sets.join(own, c, "left")
    return sets.withColumn("w_place", rarity(F.col("at_place")))


def _containment() -> Column:
    """Share of the poorer set's weight that the other one holds, of sides _a and _b."""
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    place = F.when(F.col("name_a").isNotNull() & F.col("name_b").isNotNull(), F.least("w_place_a", "w_place_b")).otherwise(0.0)
    both, a, b = place, F.when(F.col("name_a").isNotNull(), F.col("w_place_a")).otherwise(0.0), F.when(F.col("name_b").isNotNull(), F.col("w_place_b")).otherwise(0.0)
    for c in PARTS_OF_LISTS:
        both = both + F.when(F.col(f"{c}_a") == F.col(f"{c}_b"), zero(F.col(f"w_{c}_a"))).otherwise(0.0)
        a, b = a + zero(F.col(f"w_{c}_a")), b + zero(F.col(f"w_{c}_b"))
    return F.when(F.least(a, b) > 0, both / F.least(a, b)).otherwise(1.0)


def _only_one(linked: DataFrame, poor: Column, owner: Column) -> DataFrame:
    """The links of each poor set that lead to one owner only."""
    w = Window.partitionBy("__poor")
    x = linked.withColumn("__poor", poor).withColumn("__owner", owner)
    return x.withColumn("__low", F.min("__owner").over(w)).withColumn("__high", F.max("__owner").over(w)).where("__low = __high").drop("__poor", "__owner", "__low", "__high")


def door_links(rows: DataFrame, g: Gazetteer, *, key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(`key`, form) of every row with a door, and (form_a, form_b, containment): the links between different forms of one door.

    A form is a set of tokens: the name at its door, wing, first word, ending, phase, locality, city and pin, each weighing its rarity over
    all distinct sets. Each set is indexed by its rarest token that whatever doesn't contradict it must hold: the name at the door with
    the city where it tells one (never more frequent than without), the name at the door where it tells no city, and for a set without
    a name the rarer of its locality and pin at the door. Fuller sets probe with each of their tokens of these kinds, so a set with a city meets the sets
    that leave the city out, and the common tokens of a city or zip are never a key. A met pair is kept where the poorer's weight is contained to CONTAINED
    and no part contradicts: door, wing, name, city, locality, first word, phase, and for streets the kind. Where one leaves out the wing, or the
    name, it is linked only if all that contain it are of one wing, or of one name, wing and city.

    Rows without a door, null keys and null or empty addresses have no form. A key that occurs in several rows has the least of its forms.
    Copies of a text are one set of the join. Other columns aren't read; an empty table gives empty ones.
    """
    p = settled_parts(rows, g, key).where("door IS NOT NULL")
    p = cut_lineage(p.select(F.col(key).alias("k"), *ATTRIBUTES))
    # a form's id follows from its parts, so it isn't shuffled beside them
    form = F.unhex(F.md5(F.concat_ws("\u0001", *(F.coalesce(F.col(c), F.lit("\u0002")) for c in ATTRIBUTES))))
    members = p.groupBy("k").agg(F.min(form).alias("form"))
    sets = cut_lineage(p.select(*ATTRIBUTES).distinct())
    rarity = _rarities(sets)

    # only sets that share their door and name with another one, or have no name, can be linked
    place = Window.partitionBy("door", "family", "name")
    near = sets.where("name IS NOT NULL").withColumn("at_place", F.count("*").over(place)).where("at_place > 1")
    near = cut_lineage(_weighed(near.withColumn("form", form), rarity))
    columns = ["form", "tokens", *PARTS_OF_LISTS, *(f"w_{c}" for c in ("place", *PARTS_OF_LISTS))]
    counted = sum((F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0) for c in PARTS_OF_LISTS), F.lit(1))
    near = near.withColumn("tokens", counted).withColumn("with_city", F.coalesce("city", F.lit("")))
    one = lambda d, s: d.select("door", "family", "name", "at_city", *(F.col(c).alias(f"{c}_{s}") for c in columns))
    index = one(near.withColumn("at_city", F.col("with_city")), "a")
    probe = one(near.withColumn("at_city", F.explode(F.array_distinct(F.array("with_city", F.lit(""))))), "b")
    fuller = F.col("city_a").isNull() & F.col("city_b").isNotNull() | (F.struct("tokens_b", "form_b") > F.struct("tokens_a", "form_a"))
    met = index.join(probe, ["door", "family", "name", "at_city"]).where(fuller).withColumn("name_a", F.col("name")).withColumn("name_b", F.col("name"))
    met = met.where(agree("locality") & agree("brand") & agree("phase") & ((F.col("family") == "B") | agree("ending")))
    met = met.where((F.col("wing_a") == "") | (F.col("wing_b") == "") | (F.col("wing_a") == F.col("wing_b")))
    met = met.withColumn("containment", _containment()).where(F.col("containment") >= CONTAINED).select("form_a", "form_b", "wing_a", "wing_b", "containment")
    met = cut_lineage(met)
    open_wing = F.col("wing_a") != F.col("wing_b")
    bare = F.when(F.col("wing_a") == "", F.col("form_a")).otherwise(F.col("form_b"))
    links = met.where(~open_wing).unionByName(_only_one(met.where(open_wing), bare, F.greatest("wing_a", "wing_b"))).select("form_a", "form_b", "containment")

    nameless = sets.where("name IS NULL AND (locality IS NOT NULL OR pin IS NOT NULL)")
    if not nameless.isEmpty():
        links = links.unionByName(_nameless_links(sets.withColumn("form", form), cut_lineage(nameless.withColumn("form", form)), rarity))
    links = cut_lineage(links)
    return members.withColumnRenamed("k", key), links


def _nameless_links(sets: DataFrame, nameless: DataFrame, rarities: tuple[int, DataFrame]) -> DataFrame:
    """(form_a, form_b, containment) of the sets without a name and the fuller ones with a name that contain them."""
    at = F.explode(F.array_compact(F.array(F.concat(F.lit("l:"), "door", F.lit("|"), "locality"), F.concat(F.lit("p:"), "door", F.lit("|"), "pin")))).alias("token")
    asked = nameless.select("form", at)
    probe = sets.where("name IS NOT NULL").select("form", at).join(asked.select("token").distinct(), "token", "left_semi")
    often = probe.groupBy("token").agg(F.count("*").alias("n"))
    rarest = asked.join(often, "token").groupBy("form").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    met = rarest.select(F.col("form").alias("form_a"), "token").join(probe.withColumnRenamed("form", "form_b"), "token").select("form_a", "form_b")
    met = cut_lineage(met)
    some = met.select(F.col("form_a").alias("form")).unionByName(met.select(F.col("form_b").alias("form"))).distinct()
    some = cut_lineage(_weighed(sets.join(some, "form", "left_semi").withColumn("at_place", F.lit(1)), rarities))
    sided = lambda s: some.select(*(F.col(c).alias(f"{c}_{s}") for c in ("form", *ATTRIBUTES, "w_place", *(f"w_{x}" for x in PARTS_OF_LISTS))))
    met = met.join(sided("a"), "form_a").join(sided("b"), "form_b").where(agree("locality") & agree("city") & agree("brand") & agree("phase"))
    met = met.where(((F.col("wing_a") == "") | (F.col("wing_a") == F.col("wing_b"))) & (F.col("family_a").isNull() | (F.col("family_a") == F.col("family_b"))))
    met = met.withColumn("containment", _containment()).where(F.col("containment") >= CONTAINED)
    owner = F.concat_ws("|", "family_b", "name_b", "wing_b", "city_b")
    return _only_one(met, F.col("form_a"), owner).select("form_a", "form_b", "containment")


def same_doors(rows: DataFrame, g: Gazetteer, *, key: str = "row_id") -> DataFrame:
    """(`key`_a, `key`_b, containment), `key`_a < `key`_b: all pairs of rows whose own address is the same door, each once.

    The rows of linked forms and the rows of one form (containment 1) are paired when all is found; see `door_links` for what is linked
    and for nulls, copies and empty tables. All pairs are the result that is asked for; who needs the classes only takes `door_links`.
    """
    members, links = door_links(rows, g, key=key)
    members = cut_lineage(members)
    a, b = members.select(F.col(key).alias("ka"), F.col("form").alias("form_a")), members.select(F.col(key).alias("kb"), F.col("form").alias("form_b"))
    # the links are few beside the rows: written, their size is known, and while it is small the rows needn't be shuffled to meet them
    across = cut_lineage(links.join(a, "form_a").select("ka", "form_b", "containment")).join(b, "form_b").select("ka", "kb", "containment")
    within = a.join(b, F.col("form_a") == F.col("form_b")).where("ka < kb").select("ka", "kb", F.lit(1.0).alias("containment"))
    return across.unionByName(within).select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b"), "containment")
