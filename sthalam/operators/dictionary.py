"""Names of projects, buildings and places looked up in texts, from the exact to the fuzzy, each step for what those before it left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sthalam.functions import words as W
from sthalam.functions.text import tokens
from sthalam.operators import matching as M
from sthalam.session import cut_lineage


def letters(c: Column) -> Column:
    return F.regexp_replace(c, " ", "")


def longest_name(names: DataFrame, name: str = "name") -> int:
    """Words of the longest name, one for an empty list: so far runs of words must go, no farther."""
    return max(1, names.agg(F.max(F.size(tokens(F.col(name))))).first()[0] or 1)


def scoped_else_global(rows: DataFrame, names: DataFrame, *, scope: str, key: str, value: str, out: str) -> DataFrame:
    """`rows` with `out`: the `value` that `names` (`scope`, `key`, `value`) has for the row's key in its scope, or, where no name is of that scope
    at all (or the row's is null), for its key in any scope; the least of several values. Rows keep their number; a null key has none."""
    here = names.groupBy(scope, key).agg(F.min(value).alias("__here"))
    known = here.where(F.col(scope).isNotNull()).select(scope).distinct().withColumn("__known", F.lit(True))
    anywhere = here.groupBy(key).agg(F.min("__here").alias("__any"))
    j = rows.join(known, scope, "left").join(here, [scope, key], "left").join(anywhere, key, "left")
    return j.withColumn(out, F.when(F.col("__known"), F.col("__here")).otherwise(F.col("__any"))).drop("__known", "__here", "__any")


def branded(names: DataFrame, least: int = 1) -> DataFrame:
    """`names` (…, name) with their first word as `brand`, but for everyday words and brands of fewer than `least` letters."""
    first = F.get(tokens(F.col("name")), F.lit(0))
    return names.withColumn("brand", first).where((F.length("brand") >= least) & ~F.col("brand").isin(W.BRAND_STOP))


#: Share of the names above which a word counts as common: it comes last among the words that a name is looked up by. There are few such words.
COMMON_SHARE = 0.005


def _told(texts: DataFrame, text: str, common: list[str], cover: float) -> DataFrame:
    """`texts` (…, brand, `text`) with other (their words but the brand, each once), told (their length as a row of words), profile and keys: those of `other`, of which
    whatever holds `cover` of the letters and shares the brand must hold one; an empty one where the brand alone may be enough."""
    each = F.array_distinct(tokens(F.col(text)))
    other = F.array_remove(each, F.col("brand"))
    rare = F.transform(other, lambda w: F.struct(w.isin(common).alias("common"), (-F.length(w)).alias("l"), w.alias("w")))
    d = texts.withColumn("other", F.transform(F.sort_array(rare), lambda x: x["w"])).withColumn("told", F.length(F.array_join(each, " ")))
    rest = lambda i: F.length("brand") + F.aggregate(F.slice("other", i + 1, F.size("other") + 1), F.lit(0), lambda n, w: n + F.length(w) + 1)
    enough = lambda n: n >= F.col("told") * cover - 1e-6
    keys = F.filter("other", lambda w, i: enough(rest(i)))
    keys = F.when(enough(F.length("brand")), F.array(F.lit(""))).otherwise(keys)
    return d.withColumn("keys", keys).withColumn("profile", M.profile(F.array_join(each, " ")))


def token_set_pairs(runs: DataFrame, names: DataFrame, on: list[str], cutoff: float) -> DataFrame:
    """(`on`…, a, b) of `runs` (`on`…, a) and `names` (`on`…, b), both each once: all pairs that may score `cutoff` or more by token set, and few others. `on` holds brand, the first word of both.

    Such a pair has, of one side's letters, so large a share in common words that one of that side's keys is among them (an equi-join on rare words); or
    all its words are near as they stand: then the lengths differ by few letters (an equi-join on the length), and so do the letters and pairs of letters, which are counted as bits before a pair goes on.
    """
    spare = 1 - cutoff / 100
    cover = cutoff / (200 - cutoff)
    words = names.select("b", F.explode(F.array_distinct(tokens(F.col("b")))).alias("w"))
    often = words.groupBy("w").count().where(F.col("count") >= F.greatest(F.lit(2.0), F.lit(COMMON_SHARE * names.count())))
    common = [r["w"] for r in often.collect()]
    x, y = cut_lineage(_told(runs, "a", common, cover)), cut_lineage(_told(names, "b", common, cover))
    at = lambda d, c, words: d.select(*on, c, F.explode(words).alias("word"))
    any_word = F.concat("other", F.array(F.lit("")))
    shared = at(x, "a", "keys").join(at(y, "b", any_word), [*on, "word"]).select(*on, "a", "b").unionByName(at(x, "a", any_word).join(at(y, "b", "keys"), [*on, "word"]).select(*on, "a", "b"))
    side = lambda d, c, s: (*on, c, F.col("told").alias(f"told_{s}"), *(F.col(f"profile.{p}").alias(f"{p}_{s}") for p in ("letters", "more", "twos")))
    # |told_a - told_b| <= spare (told_a + told_b), solved for the run's length
    ways = F.sequence(F.ceil(F.col("told") * (1 - spare) / (1 + spare) - 1e-6).cast("int"), F.floor(F.col("told") * (1 + spare) / (1 - spare) + 1e-6).cast("int"))
    near = x.select(*side(x, "a", "a")).join(y.select(*side(y, "b", "b"), F.explode(ways).alias("told_a")), [*on, "told_a"])
    most = (F.col("told_a") + F.col("told_b")) * spare + 1e-6
    differ = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    near = near.where((differ("letters") + differ("more") <= most) & (differ("twos") <= 3 * most)).select(*on, "a", "b")
    return shared.unionByName(near).distinct()


def fuzzy_names(texts: DataFrame, names: DataFrame, *, scope: tuple[str, ...] = (), cutoff: float = 88.0, words: tuple[int, int] = (2, 8), chars: int = 6, brand_letters: int = 1, shared_word: int = 0) -> DataFrame:
    """(id, name, score): the name that scores best, `cutoff` or more by token set, with a run of words of `texts` (id, `scope`…, text) that begins with its first word.

    Runs of `words` words and `chars` letters or more; of equal scores the later run, then the longer. With `shared_word`, run and name must have a word of so many letters
    in common. Runs are made distinct before they are scored, so a text delivered over and over is scored once, and with the names that `token_set_pairs` leaves.
    """
    n = branded(names.select(*scope, "name").distinct(), brand_letters)
    runs = M.word_runs(texts, "id", F.col("text"), *words, scope, n.select(*scope, F.col("brand").alias("word")).distinct()).where(F.length("run") >= chars)
    runs = cut_lineage(runs.withColumn("brand", F.get(tokens(F.col("run")), F.lit(0))))
    pairs = token_set_pairs(runs.select(*scope, "brand", F.col("run").alias("a")).distinct(), cut_lineage(n.withColumnRenamed("name", "b")), [*scope, "brand"], cutoff)
    if shared_word:
        long = lambda c: F.filter(tokens(F.col(c)), lambda w: F.length(w) >= shared_word)
        # the first word is in common; only where it is short the others are looked at
        pairs = pairs.where((F.length("brand") >= shared_word) | F.arrays_overlap(long("a"), long("b")))
    scored = M.scored_pairs(pairs, "token_set").where(F.col("score") >= cutoff)
    best = scored.groupBy(*scope, F.col("a").alias("run")).agg(F.max(F.struct("score", "b")).alias("t"))
    hits = runs.join(best, [*scope, "run"])
    return hits.groupBy("id").agg(F.max(F.struct(F.col("t.score"), "at", "size", F.col("t.b").alias("name"))).alias("t")).select("id", "t.name", "t.score")


def known_names(texts: DataFrame, names: DataFrame, *, scope: tuple[str, ...] = (), allow_fuzzy: bool = True) -> DataFrame:
    """(id, name, how): the project that each of `texts` (id, `scope`…, text) names: the longest exact run of words, else (`exact` too) the longest
    name of ten letters or more whose letters stand anywhere in the text with its first word a word of its own, else (`fuzzy`) the best by token set at 88."""
    n = names.select(*scope, "name").distinct()
    exact = cut_lineage(M.longest_match(texts, "id", F.col("text"), n, scope=scope, most=max(2, longest_name(n))).select("id", "name"))
    left = cut_lineage(texts.join(exact, "id", "left_anti"))
    inside = M.contained_names(left, "id", letters(F.col("text")), n, scope=scope).join(left.select("id", "text"), "id")
    inside = inside.where(F.array_contains(tokens(F.col("text")), F.get(tokens(F.col("name")), F.lit(0))))
    glued = cut_lineage(inside.groupBy("id").agg(F.max(F.struct(F.length("name").alias("l"), "name")).alias("t")).select("id", "t.name"))
    found = exact.unionByName(glued).withColumn("how", F.lit("exact"))
    if not allow_fuzzy:
        return found
    fuzzy = fuzzy_names(left.join(glued, "id", "left_anti"), n, scope=scope)
    return found.unionByName(fuzzy.select("id", "name", F.lit("fuzzy").alias("how")))


def backfilled_names(texts: DataFrame, names: DataFrame, *, scope: tuple[str, ...] = ()) -> DataFrame:
    """(id, name, score): as `fuzzy_names`, but stricter: a score of 90, runs of eight letters, and a word of four letters in common."""
    return fuzzy_names(texts, names, scope=scope, cutoff=90.0, chars=8, shared_word=4)


def known_buildings(texts: DataFrame, names: DataFrame, allow_fuzzy: bool = True) -> DataFrame:
    """(id, name, how): the known building in each of `texts` (id, text) of five letters or more: the longest exact run of words, else the longest whose letters, eight or more,
    stand anywhere in the text, else the best by token set at 88 over runs of two to seven words."""
    t, n = texts.where(F.length("text") >= 5), names.select("name").distinct()
    exact = M.longest_match(t, "id", F.col("text"), n, least=1, most=longest_name(n), min_chars=1).select("id", "name", F.lit("exact").alias("how"))
    left = t.join(exact, "id", "left_anti")
    inside = M.contained_names(left, "id", letters(F.col("text")), n, least=8).groupBy("id").agg(F.max(F.struct(F.length("name").alias("l"), "name")).alias("t")).select("id", "t.name", F.lit("glued").alias("how"))
    found = exact.unionByName(inside)
    if not allow_fuzzy:
        return found
    fuzzy = fuzzy_names(left.join(inside, "id", "left_anti"), n, words=(2, 7), brand_letters=4)
    return found.unionByName(fuzzy.select("id", "name", F.lit("fuzzy").alias("how")))


def written_places(texts: DataFrame, places: DataFrame, *, scope: tuple[str, ...] = (), least: int = 3, spaced: int = 8) -> DataFrame:
    """(id, name): every one of `places` (`scope`…, name) of `least` letters or more that stands in one of `texts` (id, `scope`…, text) as whole
    words, those of `spaced` letters or more also with blanks inside or missing. Runs of words go as far as the longest name has words, or letters where blanks may be inside."""
    p = places.select(*scope, "name").distinct().withColumn("c", letters(F.col("name"))).where(F.length("name") >= least)
    most = max(longest_name(p), 4)
    runs = M.word_runs(texts, "id", F.col("text"), 1, most, scope).withColumn("c", letters(F.col("run")))
    return runs.join(p, [*scope, "c"]).where((F.col("run") == F.col("name")) | (F.length("c") >= spaced)).select("id", "name").distinct()


def best_place(texts: DataFrame, places: DataFrame, registered: DataFrame, *, scope: tuple[str, ...] = ()) -> DataFrame:
    """(id, name): of the places written in each text (id, `scope`…, pin, text), but for those inside a longer one, one that `registered` (pin, name) knows for the row's pin, then the longest."""
    hits = M.without_nested(cut_lineage(written_places(texts, places, scope=scope)), "id").join(texts.select("id", "pin"), "id")
    hits = hits.join(registered.select("pin", "name").distinct().withColumn("ok", F.lit(True)), ["pin", "name"], "left")
    return hits.groupBy("id").agg(F.max(F.struct(F.coalesce("ok", F.lit(False)).alias("ok"), F.length("name").alias("l"), "name")).alias("t")).select("id", "t.name")


def longest_place(texts: DataFrame, places: DataFrame, *, scope: tuple[str, ...] = ()) -> DataFrame:
    """(id, name): the longest place written in each text."""
    return written_places(texts, places, scope=scope).groupBy("id").agg(F.max(F.struct(F.length("name").alias("l"), "name")).alias("t")).select("id", "t.name")


def respelt(values: DataFrame, places: DataFrame, *, scope: str = "city_key") -> DataFrame:
    """(`scope`, value, name): the listed spelling of each distinct value (`scope`, value): the equal one, else, for eight letters or more, the one that scores 92 or more without blanks."""
    v = values.select(scope, "value").where("value IS NOT NULL").distinct()
    p = places.select(scope, "name").distinct()
    same = v.join(p.withColumn("value", F.col("name")), [scope, "value"]).select(scope, "value", "name")
    left = v.join(same, [scope, "value"], "left_anti").withColumn("a", letters(F.col("value"))).where("length(a) >= 8")
    p = p.withColumn("b", letters(F.col("name")))
    near = left.join(M.near_pairs(left, p, [scope], 92.0), [scope, "a"]).join(p, [scope, "b"])
    return same.unionByName(near.groupBy(scope, "value").agg(F.max_by("name", F.struct("score", "name")).alias("name")))


def near_places(texts: DataFrame, places: DataFrame, *, on: str = "pin", cutoff: float = 82.0) -> DataFrame:
    """(id, name, score): of the places that share `on` with a text (id, `on`, phrases), the one that scores best, `cutoff` or more, with one of its phrases of four letters or more."""
    a = texts.select("id", on, F.explode("phrases").alias("a")).where("length(a) >= 4").withColumn("a", F.upper("a"))
    scored = M.fuzzy_pairs(a.select(on, "a").distinct(), places.select(on, "name").distinct().withColumn("b", F.upper("name")), [on], cutoff)
    hits = a.join(scored, [on, "a"])
    return hits.groupBy("id").agg(F.max(F.struct("score", F.length("name").alias("l"), "name")).alias("t")).select("id", "t.name", "t.score")


def named_area(texts: DataFrame, places: DataFrame, blocked: DataFrame) -> DataFrame:
    """(id, name): the longest place of two words or more in each text (id, text, locality), as it stands or, of ten letters or more, without its blanks; none of `blocked` (name), none with a street word, not the row's locality."""
    streets = F.array(*(F.lit(w) for w in W.STREET_TOKENS))
    p = places.select("name").distinct().where((F.size(tokens(F.col("name"))) >= 2) & ~F.arrays_overlap(tokens(F.col("name")), streets)).join(blocked.select("name").distinct(), "name", "left_anti")
    hits = written_places(texts, p, spaced=10).join(texts.select("id", "locality"), "id").where(~F.coalesce(F.col("locality") == F.col("name"), F.lit(False)))
    return hits.groupBy("id").agg(F.max(F.struct(F.length("name").alias("l"), "name")).alias("t")).select("id", "t.name")


def common_localities(places: DataFrame) -> DataFrame:
    """(name): the names too common to stand for a building: fixed ones, and the listed ones of two words at most and four letters or more."""
    fixed = places.sparkSession.createDataFrame([(x,) for x in W.COMMON_LOCALITIES], "name string")
    return fixed.unionByName(places.select("name").where((F.size(tokens(F.col("name"))) <= 2) & (F.length("name") >= 4))).distinct()


def whole_flags(rows: DataFrame, names: DataFrame, value: str, out: str) -> DataFrame:
    """`rows` with `out`: Yes where the value is one of `names` (name) letter for letter, else No."""
    n = names.select(F.col("name").alias(value)).where("name IS NOT NULL").distinct().withColumn("__ok", F.lit(True))
    return rows.join(n, value, "left").withColumn(out, F.when(F.col("__ok"), "Yes").otherwise("No")).drop("__ok")
