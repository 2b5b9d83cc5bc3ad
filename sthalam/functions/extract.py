"""Names of buildings and areas inside a normalised address, as column expressions; each gives null where it finds none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sthalam.functions import text as T
from sthalam.functions import words as W

WORD = "[A-Z][A-Z0-9]+"


def _first(norm: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(norm, pattern, 1), F.lit(""))


def _among(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def longest_of(found: Column) -> Column:
    """The longest of some texts, of equals the first; null for none."""
    best = F.aggregate(found, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    return F.nullif(best, F.lit(""))


def phrases_ending(norm: Column, ends: list[str], least: int, most: int) -> Column:
    """For each word of `ends` the phrase of it and the `least` to `most` plain words straight before it; a plain word begins with a letter and has two signs or more."""
    def found(w: Column) -> Column:
        def phrase(i: Column) -> Column:
            lead = F.slice(w, F.greatest(i - most, F.lit(1)), F.least(i - 1, F.lit(most)))
            return F.concat(_plain_end(lead), F.slice(w, i, F.lit(1)))

        at = F.filter(F.transform(w, lambda x, i: F.when(F.array_contains(_among(ends), x), i + 1)), lambda i: i.isNotNull())
        return F.transform(F.filter(F.transform(at, phrase), lambda x: F.size(x) > least), lambda x: F.array_join(x, " "))

    return T.let(T.tokens(norm), found)


def _plain_end(words: Column) -> Column:
    """The plain words at the end of some words."""
    return T.let(words, lambda lead: F.slice(lead, F.coalesce(F.array_max(F.transform(lead, lambda x, k: F.when(x.rlike(f"^{WORD}$"), 0).otherwise(k + 1))), F.lit(0)) + 1, F.size(lead)))


def _plain_start(words: Column) -> Column:
    """The plain words at the start of some words."""
    return T.let(words, lambda follow: F.slice(follow, F.lit(1), F.coalesce(F.array_min(F.filter(F.transform(follow, lambda x, k: F.when(~x.rlike(f"^{WORD}$"), k)), lambda k: k.isNotNull())), F.size(follow))))


def _unless(name: Column, words: list[str]) -> Column:
    return F.when(~F.arrays_overlap(T.tokens(name), _among(words)), name)


def same_place(name: Column, locality: Column) -> Column:
    """Whether a name is the locality's, written with or without blanks."""
    return F.coalesce(T.compact(name) == T.compact(locality), F.lit(False))


def trimmed_building(name: Column) -> Column:
    """A building's name from after the last street word or unit number before it, up to its ending; null where that is no name."""
    n = F.regexp_replace(T.norm_name(name), r"^(?:(?:FLAT|HOUSE|UNIT|DOOR|PLOT|SHOP|NO|BLOCK|TOWER|WING)(?: NO)? ?[A-Z]?[0-9]*[A-Z]? )+", "")
    upto = lambda n: F.coalesce(F.nullif(F.regexp_extract(n, rf"^(.*?(?:^| )(?:{W.BUILDING_SUFFIX}))(?: |$)", 1), F.lit("")), n)
    tail = lambda u: F.regexp_replace(u, r"^.*(?:^| )(?:CROSS|MAIN|ROAD|BLOCK|FLOOR|STAGE|PHASE|SECTOR|[0-9]+(?:ST|ND|RD|TH)) ", "")
    kept = T.let(T.let(n, upto), lambda u: T.let(tail(u), lambda t: F.when(F.length(t) >= 4, t).otherwise(u)))
    return T.let(kept, lambda k: F.when(~F.coalesce(T.rejected_name(k), F.lit(True)), k))


def compound_building(norm: Column) -> Column:
    """The longest single word that ends in VILLA, NILAYA and the like."""
    return longest_of(F.filter(T.tokens(norm), lambda x: x.rlike(f"^{WORD}(?:{'|'.join(W.COMPOUND_ENDS)})$")))


def layout_building(norm: Column) -> Column:
    """The last one to three words before LAYOUT that are no street words, units or short pieces."""
    plain = rf"(?:(?!(?:{'|'.join(W.BUILDING_STOP)}) ){WORD} )"
    hits = F.regexp_extract_all(norm, F.lit(rf"(?:^| )({plain}{{1,3}}LAYOUT)(?= |$)"), F.lit(1))
    return F.get(hits, F.size(hits) - 1)


def landmark_building(norm: Column) -> Column:
    """A landmark's name that ends like a building."""
    return _first(norm, rf"(?:^| )(?:NEAR|BEHIND|OPPOSITE|BESIDE|NEXT TO) ((?:{WORD} ){{1,4}}(?:{W.BUILDING_SUFFIX}))(?: |$)")


def one_word_layout(norm: Column, locality: Column) -> Column:
    hit = _first(norm, r"(?:^| )([A-Z][A-Z0-9]{4,20} LAYOUT)(?: |$)")
    return F.when(~same_place(hit, locality), hit)


def before_bldg(norm: Column) -> Column:
    there = norm.contains("BLDG") | norm.contains("BUILDING")
    return F.when(there, _unless(_first(norm, rf"((?:{WORD} ){{0,3}}{WORD}) (?:BLDG|BUILDING)(?: |$)"), W.BUILDING_STOP))


def residence(norm: Column) -> Column:
    return F.when(norm.contains("RESIDENCE"), _first(norm, rf"((?:{WORD} ){{1,4}}RESIDENCE)(?: |$)"))


def society(norm: Column, locality: Column) -> Column:
    """The longest colony, nagar or garden of up to four words before its ending that isn't the locality."""
    hit = longest_of(F.filter(phrases_ending(norm, W.SOCIETY_ENDS, 1, 4), lambda x: ~F.arrays_overlap(T.tokens(x), _among(W.BUILDING_STOP))))
    return F.when(~same_place(hit, locality), hit)


def single_area(norm: Column) -> Column:
    """The longest single word, of five letters to twenty before its ending, that ends like an area, else a two-word layout."""
    one = longest_of(F.filter(T.tokens(norm), lambda x: x.rlike(f"^[A-Z][A-Z0-9]{{4,20}}(?:{'|'.join(W.SINGLE_AREA_ENDS)})$")))
    return F.coalesce(one, longest_of(F.filter(phrases_ending(norm, ["LAYOUT"], 1, 1), lambda x: x.rlike("^[A-Z]{2,10} "))))


def enclave(norm: Column, locality: Column) -> Column:
    """The first enclave, estate or township with up to three words before it that isn't the locality."""
    hit = F.get(phrases_ending(norm, W.ENCLAVE_ENDS, 1, 3), F.lit(0))
    return F.when(~same_place(hit, locality), hit)


def before_floor(norm: Column, locality: Column) -> Column:
    """The two to six words before GROUND FLOOR or 2ND FLOOR, the first such phrase that has no street word, isn't the locality and
    ends like a building or has a word of five letters."""
    floor = lambda w: F.filter(F.transform(w, lambda x, i: F.when((x == "FLOOR") & F.coalesce(F.get(w, i - 1).rlike("^(?:GROUND|[0-9]+(?:ST|ND|RD|TH))$"), F.lit(False)), i)), lambda i: i > 1)
    phrases = T.let(T.tokens(norm), lambda w: F.transform(floor(w), lambda i: _plain_end(F.slice(w, F.greatest(i - 6, F.lit(1)), F.least(i - 1, F.lit(6))))))
    good = lambda x: (F.size(x) >= 2) & ~F.arrays_overlap(x, _among(W.BUILDING_STOP)) & ~F.coalesce(F.array_join(x, "") == T.compact(locality), F.lit(False)) & (F.array_join(x, " ").rlike(rf"(?:^| )(?:{W.BUILDING_SUFFIX})$") | F.exists(x, lambda y: F.length(y) >= 5))
    return F.array_join(F.get(F.filter(phrases, good), F.lit(0)), " ")


def after_unit(norm: Column) -> Column:
    """The last name of two to seven plain words after a unit and its number that has no street word and ends like a building or has five words at most."""
    units = _among(["FLAT", "FLATNO", "HOUSE", "HNO", "NO", "APT", "APARTMENT", "UNIT", "ROOM", "OFFICE", "PLOT"])
    number = lambda w: F.filter(F.transform(w, lambda x, i: F.when(F.array_contains(units, x) & F.coalesce(F.get(w, i + 1).rlike("[0-9]"), F.lit(False)), i + 2)), lambda i: i.isNotNull())
    phrases = T.let(T.tokens(norm), lambda w: F.transform(number(w), lambda i: _plain_start(F.slice(w, i + 1, F.lit(7)))))
    streets = _among([*W.STREET_TOKENS, *W.BUILDING_STOP])
    ends = lambda x: F.array_join(x, " ").rlike(rf"(?:^| )(?:{W.BUILDING_SUFFIX})$")
    good = lambda x: (F.size(x) >= 2) & ~F.arrays_overlap(x, streets) & (ends(x) | (F.size(x) <= 5))
    return T.let(F.filter(phrases, good), lambda hits: F.array_join(F.get(hits, F.size(hits) - 1), " "))


def sanitised_building(name: Column, norm: Column) -> Column:
    """A parser's building: its trimmed name where that is a building's, else what the name up to a city word holds of a building, else that itself if it is one of six words at most."""
    cleaned = trimmed_building(name)
    upto = F.trim(F.regexp_replace(T.norm_name(name), r"(?<=^.{6,400}?) ?(?:BANGALORE|BENGALURU|KARNATAKA|INDIA)(?: .*)?$", ""))
    inner = trimmed_building(F.coalesce(T.building_by_ending(upto), after_unit(upto)))
    return F.coalesce(F.when(T.valid_building(cleaned), cleaned), F.when(T.valid_building(inner), inner), F.when(T.valid_building(upto) & (F.size(T.tokens(upto)) <= 6), upto))


def locality_like(name: Column, locality: Column, listed: Column) -> Column:
    """Whether a name is the locality's, a common one's, or (`listed`) that of a listed one of two words at most."""
    n = T.norm_name(name)
    return F.coalesce(n == T.norm_name(locality), F.lit(False)) | n.isin(W.COMMON_LOCALITIES) | (F.coalesce(listed, F.lit(False)) & (F.size(T.tokens(n)) <= 2))


def locality_as_building(norm: Column, locality: Column) -> Column:
    """The locality itself where it stands in the text, ends like an area and has no street word."""
    n = T.norm_name(locality)
    ends = n.rlike(f"(?:{'|'.join(W.LOCALITY_ENDS)})$")
    return F.when(ends & F.concat(F.lit(" "), norm, F.lit(" ")).contains(F.concat(F.lit(" "), n, F.lit(" "))), _unless(n, ["MAIN", "CROSS", "ROAD", "BLOCK", "FLOOR", "STAGE", "PHASE", "SECTOR"]))


def first_building(norm: Column) -> Column:
    """What the text itself names: by its ending, a compound word, after the unit, a layout."""
    after = T.let(after_unit(norm), lambda a: F.when(T.valid_building(a), a))
    return F.coalesce(trimmed_building(T.building_by_ending(norm)), compound_building(norm), after, layout_building(norm))


def fallback_building(norm: Column, locality: Column, named_area: Column | None = None) -> Column:
    """struct(value, source): what still stands for a building where none was named, and which way it was found; `named_area` is a listed place in the text, if one was looked for."""
    ways = {"landmark": landmark_building(norm), "one_word_layout": one_word_layout(norm, locality), "bldg": before_bldg(norm), "residence": residence(norm), "society": society(norm, locality), "locality": locality_as_building(norm, locality), "named_area": F.lit(None).cast("string") if named_area is None else named_area, "single_area": single_area(norm), "enclave": enclave(norm, locality), "before_floor": before_floor(norm, locality)}
    return F.struct(F.coalesce(*ways.values()).alias("value"), F.coalesce(*(F.when(c.isNotNull(), F.lit(n)) for n, c in ways.items())).alias("source"))
