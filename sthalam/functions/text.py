"""Cleaning and normalising as column expressions; everything here stays inside code generation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sthalam.functions import words as W

NO_WORDS = "array<string>"


def lookup(table: dict[str, str], key: Column) -> Column:
    """The value of `key`, null where there is none."""
    return F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value worked out once, however often `f` uses it: inside lambdas the planner shares no common parts."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def tokens(c: Column) -> Column:
    """The words between blanks; none for an empty text."""
    return F.filter(F.split(squeeze(c), " "), lambda w: w != "")


def norm_name(c: Column) -> Column:
    """Upper-case letters and figures with single blanks."""
    return squeeze(F.regexp_replace(F.upper(c), "[^A-Z0-9 ]+", " "))


def compact(c: Column) -> Column:
    return F.regexp_replace(norm_name(c), " ", "")


def split_figures(c: Column) -> Column:
    """A blank between figures and letters."""
    return squeeze(F.regexp_replace(F.regexp_replace(norm_name(c), "([0-9])([A-Z])", "$1 $2"), "([A-Z])([0-9])", "$1 $2"))


def expand(c: Column, table: dict[str, str] | None = None) -> Column:
    """Each word's long form; other words as they are."""
    t = W.ABBREVIATIONS if table is None else table
    return F.array_join(F.transform(tokens(c), lambda w: F.coalesce(lookup(t, F.upper(w)), w)), " ")


def match_text(c: Column) -> Column:
    """norm_name with the short forms that matter for matching written out."""
    return expand(norm_name(c), W.MATCH_ABBREVIATIONS)


def unglue(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, f"({W.GLUE_WORDS})", " $1 "))


def locality_match_text(c: Column) -> Column:
    return unglue(match_text(c))


def locality_base(c: Column) -> Column:
    return F.regexp_replace(c, r" +(PHASE|STAGE|SECTOR|BLOCK) +([IVX]+|[0-9]+)$", "")


def city_key(c: Column) -> Column:
    k = F.lower(norm_name(c))
    return F.coalesce(lookup(W.CITY_ALIASES, k), k)


def phase_numbers(c: Column) -> Column:
    """The numbers after PHASE, STAGE, BLOCK or TOWER, Roman ones as figures, each once."""
    hits = F.regexp_extract_all(match_text(c), F.lit(r"(?:PHASE|STAGE|BLOCK|TOWER) ([0-9]+|[IV]+)(?: |$)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(hits, lambda h: F.coalesce(lookup(W.ROMAN, h), h))))


def phases_conflict(a: Column, b: Column) -> Column:
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def drop_repeats(c: Column, geo: list[str] | None = None) -> Column:
    """Without words that repeat the word kept before them, and place words kept once."""
    places = F.array(*(F.lit(g) for g in (W.GEO_TOKENS if geo is None else geo)))
    keep = lambda acc, w: F.when((F.size(acc) > 0) & (F.upper(F.get(acc, F.size(acc) - 1)) == F.upper(w)), acc).when(F.array_contains(places, F.upper(w)) & F.exists(acc, lambda x: F.upper(x) == F.upper(w)), acc).otherwise(F.concat(acc, F.array(w)))
    return F.array_join(F.aggregate(tokens(c), F.array().cast(NO_WORDS), keep), " ")


def protect_ordinals(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)\b([0-9]+) *(ST|ND|RD|TH)\b", "$1ORD$2")


def restore_ordinals(c: Column) -> Column:
    return reduce(lambda x, s: F.regexp_replace(x, rf"(?i)\b([0-9]+)ORD{s}\b", f"$1{s.lower()}"), ("ST", "ND", "RD", "TH"), c)


def clean_locality(c: Column) -> Column:
    """Without post-office marks and brackets; null where fewer than three letters beside city words remain."""
    x = squeeze(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\) *$", " "), r"(?i)\b[SBHG]\.? ?[OP]\.?(?: *$| +(?=\())|\bG\.? *$", " "))
    bare = lambda x: F.regexp_replace(F.upper(x), r"BANGALORE|BENGALURU|KARNATAKA|INDIA|[^A-Z]", "")
    return let(x, lambda x: F.when(F.length(bare(x)) >= 3, x))


def named_as_landmark(words: Column, first: Column) -> Column:
    """Whether `first` is among the words, and a landmark word stands within three words before each mention."""
    marks = F.array(*(F.lit(w) for w in W.LANDMARK_WORDS))
    at = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.get(words, i - 1) == first)
    before = lambda i: F.slice(words, F.greatest(i - 3, F.lit(1)), F.least(i - 1, F.lit(3)))
    return (F.size(words) > 0) & (F.size(at) > 0) & F.forall(at, lambda i: F.arrays_overlap(before(i), marks))


def generic_name(norm: Column) -> Column:
    """One word only, or fewer than five letters beside words that many projects have."""
    w = tokens(norm)
    generic = F.array(*(F.lit(x) for x in W.GENERIC_WORDS))
    own = F.filter(w, lambda x: ~F.array_contains(generic, x) & ~x.rlike("^[0-9]+$"))
    return (F.size(w) < 2) | (F.aggregate(own, F.lit(0), lambda s, x: s + F.length(x)) < 5)


def rejected_name(norm: Column) -> Column:
    """Whether a building name is no name: empty, with a firm's or broken word, all short words, or a bare ending."""

    def broken(w: Column) -> Column:
        has = lambda words: F.arrays_overlap(w, F.array(*(F.lit(x) for x in words)))
        return has(W.REJECT_WORDS) | F.forall(w, lambda x: F.length(x) <= 3) | ((F.size(w) == 2) & F.get(w, F.lit(0)).rlike("^[0-9]+$")) | ((F.size(w) == 1) & has(W.SUFFIX_WORDS)) | ((F.get(w, F.lit(1)) == "LAYOUT") & (F.length(F.get(w, F.lit(0))) <= 3))

    return F.coalesce(norm == "", F.lit(True)) | let(tokens(norm), broken)


def valid_building(norm: Column) -> Column:
    """Two words and six letters at least, no street word, no area unless it ends like a building, five words at most unless so."""
    w = tokens(norm)
    ends = norm.rlike(rf"(?:^| )(?:{W.BUILDING_SUFFIX})$")
    stop = F.arrays_overlap(w, F.array(*(F.lit(x) for x in W.BUILDING_STOP)))
    area = norm.rlike(rf" (?:{'|'.join(W.LOCALITY_SUFFIXES)})$")
    return (F.size(w) >= 2) & (F.length(norm) >= 6) & ~stop & (ends | ~area) & (ends | (F.size(w) <= 5))


def pin_in(text: Column, zip_code: Column | None = None) -> Column:
    """The row's own zip, else the first pin in the text."""
    found = F.nullif(F.regexp_extract(text, r"(?:^|[^0-9A-Za-z_])([1-9][0-9]{5})(?:$|[^0-9A-Za-z_])", 1), F.lit(""))
    return found if zip_code is None else F.coalesce(F.nullif(F.trim(zip_code), F.lit("")), found)


def landmarks_in(norm: Column) -> Column:
    """Every phrase of up to five words after a landmark word, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(norm, F.lit(r"(?:^| )(?:NEAR|OPPOSITE|BEHIND|BESIDE|NEXT TO|IN FRONT OF|ADJACENT TO) ((?:[A-Z0-9]+ ){0,4}[A-Z0-9]+)"), F.lit(1)))


def building_number(text: Column) -> Column:
    """The number after NO, else after a unit word, else at the start; not a pin and not six figures or more."""
    t = F.upper(text)
    forms = [r"\bNO\.? *([0-9]+[A-Z]?(?:[/-][0-9]+[A-Z]?)?)\b", r"\b(?:FLAT|FLT|HOUSE|PLOT|DOOR|SHOP|APT|APARTMENT|ROOM|UNIT|OFFICE) *(?:NO\.?|NUMBER)? *[:#.-]? *([A-Z]{0,3}[0-9]+[A-Z]?(?:[/-][0-9]+[A-Z]?)?)", r"^([A-Z]{1,3}-?[0-9]+[A-Z]?)(?: |,|$)", r"^([0-9]{1,4}(?:/[0-9]+)?)(?: |,|$)"]
    one = lambda p: F.nullif(F.regexp_extract(t, p, 1), F.lit(""))
    good = lambda c: F.when(~c.rlike("[0-9]{6}"), c)
    return F.coalesce(*(good(one(p)) for p in forms))


def building_by_ending(norm: Column) -> Column:
    """Up to five words and the word that ends a building's name."""
    # the first match begins with a word, so inside of words none is tried
    return F.nullif(F.regexp_extract(norm, rf"(?<![A-Z0-9])((?:[A-Z0-9]++ ){{1,5}}(?:{W.BUILDING_SUFFIX}))(?: |$)", 1), F.lit(""))


def place_names_agree(a: Column, b: Column, cutoff: float = 0.85) -> Column:
    """Equal keys, one within the other, or an edit distance that the cutoff allows."""
    x, y = city_key(a), city_key(b)
    longest = F.greatest(F.length(x), F.length(y))
    return (x != "") & (y != "") & ((x == y) | x.contains(y) | y.contains(x) | (F.levenshtein(x, y) <= F.floor((1 - cutoff) * longest + 1e-9)))


def state_name(code: Column) -> Column:
    """The state of a code in any case; null for an unknown code."""
    return lookup(W.STATES, F.upper(F.trim(code)))


def state_code(name: Column) -> Column:
    """The first code, in the order of the list, whose state is called so."""
    first: dict[str, str] = {}
    for code, state in W.STATES.items():
        first.setdefault(state.lower(), code)
    return lookup(first, F.lower(F.trim(name)))


def state_evidence(own: Column, known: Column) -> Column:
    """What the row's own state and that of its pin tell, both codes: 1 agree, -1 differ, 0 only the pin tells it, null neither or only the row."""
    a, b = state_name(own), state_name(known)
    return F.when(b.isNull(), F.lit(None).cast("int")).when(a.isNull(), 0).when(F.coalesce(place_names_agree(a, b), F.lit(False)), 1).otherwise(-1)


def _cased(w: Column) -> Column:
    return F.lower(w) != F.upper(w)


def title_locality(c: Column) -> Column:
    """Words in small letters with a capital, others as they are."""
    return F.array_join(F.transform(tokens(c), lambda w: F.when(_cased(w) & (w == F.lower(w)), F.initcap(w)).otherwise(w)), " ")


def title_building(c: Column) -> Column:
    """Words all in capitals or all in small letters with one capital, mixed ones as they are."""
    return F.array_join(F.transform(tokens(c), lambda w: F.when(_cased(w) & ((w == F.lower(w)) | (w == F.upper(w))), F.initcap(w)).otherwise(w)), " ")


def trim_landmark(text: Column, city: Column, district: Column) -> Column:
    """A landmark up to the first mention, after its sixth letter, of the city, district, country or a state; the whole of it where less than three letters would be left."""
    up = F.upper(text)
    stops = [F.upper(F.trim(city)), F.upper(F.trim(district)), *(F.lit(x) for x in W.LANDMARK_STOPS)]
    ats = [F.when((F.length(x) > 0) & (F.position(x, up) > 6), F.position(x, up)) for x in stops]
    cut = F.trim(F.substring(text, F.lit(1), F.coalesce(F.array_min(F.array_compact(F.array(*ats))) - 1, F.length(text))), F.lit(" ,.-"))
    return F.when(F.length(F.trim(text)) > 0, F.when(F.length(cut) >= 3, cut).otherwise(text))


def locality_phrases(text: Column, most: int = 8) -> Column:
    """The parts between commas and semicolons of five letters or more, then the first and last four and three words, each once, `most` of them."""
    parts = F.filter(F.transform(F.split(text, "[,;]"), lambda x: F.trim(x, F.lit(" ,.-"))), lambda x: F.length(x) >= 5)
    none = F.array().cast(NO_WORDS)
    ends = lambda w, n: F.when(F.size(w) >= n, F.array(F.array_join(F.slice(w, 1, n), " "), F.array_join(F.slice(w, F.greatest(F.size(w) - n + 1, F.lit(1)), F.lit(n)), " "))).otherwise(none)
    runs = let(tokens(text), lambda w: F.filter(F.concat(ends(w, 4), ends(w, 3)), lambda x: F.length(x) >= 6))
    return F.slice(F.array_distinct(F.concat(parts, runs)), 1, most)


def precise_locality(locality: Column, building: Column) -> Column:
    """The area phrase at the end of what a parser took for the locality, of four words at most, without words of the building's name; null where it ends in no area word."""
    among = lambda words: F.array(*(F.lit(x) for x in words))
    bare = norm_name(F.regexp_replace(F.upper(restore_ordinals(locality)), r"\b(?:BANGALORE|BENGALURU|KARNATAKA|INDIA)\b", " "))
    words = tokens(F.regexp_replace(bare, r"( [0-9]+)+$|^[0-9]+$", ""))
    barrier = lambda x: F.array_contains(among(W.STREET_TOKENS), x) | x.rlike("[0-9]")
    last = lambda w: F.coalesce(F.array_max(F.transform(w, lambda x, i: F.when(barrier(x), i + 1).otherwise(0))), F.lit(0))
    ends = lambda x: x.rlike(f"(?:{'|'.join(W.AREA_SUFFIXES)})$")
    own = tokens(norm_name(F.coalesce(building, F.lit(""))))

    def without_own(phrase: Column) -> Column:
        """Without the words at its start that the building's name has, but for the last one."""
        first = F.array_min(F.filter(F.transform(phrase, lambda x, i: F.when(F.array_contains(own, x), F.lit(None)).otherwise(i)), lambda i: i.isNotNull()))
        return F.slice(phrase, F.least(F.coalesce(first, F.size(phrase)), F.size(phrase) - 1) + 1, F.size(phrase))

    def of_tail(tail: Column) -> Column:
        first = F.array_min(F.filter(F.transform(tail, lambda x, i: F.when(ends(x), i + 1)), lambda i: i.isNotNull()))
        phrase = F.slice(tail, F.greatest(first - 3, F.lit(1)), F.least(first, F.lit(4)))
        kept = let(phrase, without_own)
        return F.when((F.size(tail) > 0) & ends(F.coalesce(F.get(tail, F.size(tail) - 1), F.lit(""))), let(kept, lambda k: F.when(F.exists(k, lambda x: F.length(x) >= 4), F.initcap(F.array_join(k, " ")))))

    return let(let(words, lambda w: F.slice(w, last(w) + 1, F.size(w))), of_tail)


def confidence(pin: Column, pin_known: Column, state: Column, city_agrees: Column, city: Column, building: Column, rule: Column, osm: Column, same_as_locality: Column, locality_source: Column, locality: Column, number: Column, landmark: Column) -> Column:
    """The weights of all evidence, between 0 and 1. `state`: 1 agrees, -1 differs, 0 only the pin tells it, null unknown."""
    say = lambda c: F.coalesce(c, F.lit(False))
    there = lambda c: F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))
    add = lambda c, w: F.when(c, F.lit(w)).otherwise(F.lit(0.0))
    cast = lambda t: {k: str(v) for k, v in t.items()}
    by_rule = F.coalesce(lookup(cast(W.RULE_WEIGHT), rule).cast("double"), F.lit(0.12))
    own = F.when(there(rule), by_rule).when(say(osm), 0.12).when(say(same_as_locality), 0.04).otherwise(0.06)
    by_source = F.coalesce(lookup(cast(W.SOURCE_WEIGHT), locality_source).cast("double"), F.lit(0.05))
    s = add(say(pin), 0.18) + add(say(pin) & say(pin_known), 0.07)
    s = s + F.when(state == 1, 0.15).when(state == -1, -0.12).when(state == 0, 0.05).otherwise(0.0)
    s = s + F.when(say(city_agrees), 0.10).when(there(city), 0.04).otherwise(0.0)
    s = s + F.when(there(building), 0.22 + own).otherwise(0.0) + F.when(there(locality), by_source).otherwise(0.0)
    s = s + add(there(number), 0.04) + add(there(landmark), 0.04)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 3)
