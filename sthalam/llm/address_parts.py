"""The own postal address of a free text, taken apart into door, building or street, locality, city and pin."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sthalam.llm.canonical import KINDS, SHORT, city_text, locality_text
from sthalam.session import cut_lineage

#: Words that begin a further address beside the own one (fixed values).
FURTHER = r"\b(?:NATIVE|ALSO AT|OLD ADD(?:RESS|R)?|PREV(?:IOUS)? ADD(?:RESS)?|WORKS AT|R/O|PERM(?:ANENT)? ADD(?:RESS)?|RES ADD)\b|\bOFFICE ?:"
#: Words that begin a landmark, and public places that serve as one (fixed values).
NEAR = r"\b(?:NEAR|NR|OPP|OPPOSITE|BEHIND|NEXT TO|BESIDE|ADJ TO)\b\.?"
PLACES = r"(?:GOVT SCHOOL|WATER TANK|POST OFFICE|BUS STAND|RAILWAY STATION|PARK|SCHOOL|TEMPLE|LAKE|HOSPITAL|MARKET|MOSQUE|CHURCH)"
#: Ends of building names, by their short forms (fixed values).
SUFFIX = {"RESI": "RESIDENCY", "RESIDENCY": "RESIDENCY", "ENCL": "ENCLAVE", "ENCLAVE": "ENCLAVE", "HABITAT": "HABITAT", "HEIGHTS": "HEIGHTS", "HTS": "HEIGHTS", "TOWER": "TOWERS", "TOWERS": "TOWERS", "TWRS": "TOWERS", "TWR": "TOWERS", "APARTMENT": "APARTMENTS", "APARTMENTS": "APARTMENTS", "APTS": "APARTMENTS", "APT": "APARTMENTS", "APPT": "APARTMENTS", "GARDENS": "GARDENS", "GDNS": "GARDENS", "GARDEN": "GARDENS"}
#: Kinds of streets, by their short forms (fixed values).
STREET = {"STREET": "STREET", "ST": "STREET", "STR": "STREET", "STRT": "STREET", "ROAD": "ROAD", "RD": "ROAD", "RAOD": "ROAD", "LANE": "LANE", "LN": "LANE", "MARG": "MARG", "MRG": "MARG", "CROSS": "CROSS", "CRS": "CROSS", "X": "CROSS"}
#: Last words of the names of houses (fixed values).
HOUSES = {"NIVAS", "BHAVAN", "SADAN", "KUTIR", "VILLA"}
FIRM = r"(?:TRADERS|FOODS|ENTERPRISES|LOGISTICS|INDUSTRIES|STORES|AGENCIES|SERVICES|SOLUTIONS|TECHNOLOGIES|ASSOCIATES|COMPANY|CO)"

_EMAIL = re.compile(r"(?:\b(?:E-?MAIL|MAIL)(?: ID)?\b[: ]*)?[\w.+-]+ ?(?:@|\(AT\)|\[AT\]) ?[\w-]+(?: ?\. ?\w+| DOT \w+)+")
_CUE = r"\b(?:METER|KHATA|SY|SURVEY|RR|CONSUMER|ACCOUNT|A/C|PAN|EPIC|AADHAA?R|UID|PASSPORT|DL|ID PROOF|VOTER ID|CALL|CELL|PHONE|TEL|MOB(?:ILE)?|CONTACT|PH|WHATSAPP)\b(?: NO\b)?[.: ]*"
_TAGGED = re.compile(_CUE + r"(?:\+?91[ -]?)?(?:NO:)?(?:\d{4}[ -]\d{4}[ -]\d{4}|\d{5}[ -]\d{5}|\(\d{2}\) ?\d{8}|\d{3}-\d{8}|[A-Z]{2}\d{2} ?\d{11}|[A-Z]{0,6}\d{4,}[A-Z]?)(?![\d/])")
_LONG = re.compile(r"\+91[ -]?\d{5}[ -]?\d{5}|\b\d{4}[ -]\d{4}[ -]\d{4}\b|\b\d{5}[ -]\d{5}\b|\b\d{7,}\b|\b[A-Z]{5}\d{4}[A-Z]\b|\b[A-Z]{1,3}\d{7}\b|\b[A-Z]{2}\d{2} ?\d{11}\b")
_FLOOR = re.compile(r"\b(?:\d+(?:ST|ND|RD|TH)|GROUND|FIRST|SECOND|THIRD|FOURTH|TOP) (?:FLOOR|FLR)\b|\bSHOP ?@ ?CORNER\b")
_FIRM = re.compile(rf"(?:\b(?:M/S|C/O|CARE OF|KIND ATTN:?|ATTN:?) *)?(?:M/S )?\b\w+ (?:\w+ )?{FIRM}\b(?: (?:PVT LTD|LTD|LLP|PRIVATE LIMITED))?|(?:\b(?:M/S|C/O|ATTN:?) *)(?:\w+ ){{1,3}}?(?:PVT LTD|LTD|LLP)\b")
#: A text without any of these words can't match the pattern of that name, which is then not tried.
_CUES = {
    "further": {"NATIVE", "ALSO", "OLD", "PREV", "PREVIOUS", "WORKS", "R/O", "PERM", "PERMANENT", "RES", "OFFICE"},
    "tagged": {"METER", "KHATA", "SY", "SURVEY", "RR", "CONSUMER", "ACCOUNT", "A/C", "PAN", "EPIC", "AADHAR", "AADHAAR", "UID", "PASSPORT", "DL", "ID", "VOTER", "CALL", "CELL", "PHONE", "TEL", "MOB", "MOBILE", "CONTACT", "PH", "WHATSAPP"},
    "floor": {"FLOOR", "FLR", "CORNER"},
    "firm": {"TRADERS", "FOODS", "ENTERPRISES", "LOGISTICS", "INDUSTRIES", "STORES", "AGENCIES", "SERVICES", "SOLUTIONS", "TECHNOLOGIES", "ASSOCIATES", "COMPANY", "CO", "LTD", "LLP", "LIMITED"},
    "person": {"S/O", "W/O", "D/O", "H/O", "C/O", "CARE", "SON", "WIFE", "DAUGHTER", "ATTN", "OWNER", "MR", "MS", "MRS", "SHRI", "SMT", "DR"},
    "near": {"NEAR", "NR", "OPP", "OPPOSITE", "BEHIND", "NEXT", "BESIDE", "ADJ"},
}
_WORD = re.compile(r"[A-Z]+(?:/[A-Z]+)?")
_MANY = re.compile(r"\d{5}[ -]?\d\d|\d{4}[ -]\d{4}|[A-Z]\d{4}|[A-Z]\d\d \d{5}")
_WHO = r"(?:LATE )?(?:[A-Z] [A-Z]{3,}|[A-Z]{2,}(?: [A-Z])? (?!(?:FLAT|FLT|HOUSE|PLOT|DOOR|BLOCK|UNIT|APT)\b)[A-Z]{3,})"
_TITLE = r"(?:MR|MS|MRS|SHRI|SMT|DR)\b\.? *"
_PERSON = re.compile(rf"\b(?:[SWDHC]/O\b\.?|CARE OF|SON OF|WIFE OF|DAUGHTER OF|KIND ATTN:?|ATTN:?|OWNER:?)[: ]*(?:{_TITLE})?{_WHO}|\b{_TITLE}{_WHO}")
_NEAR_PLACE = re.compile(rf"{NEAR} *{PLACES}\b")
_NEAR_BRAND = re.compile(rf"{NEAR} *([A-Z]+)(?: [A-Z]{{5,}}| [A-Z]{{2,5}} [A-Z]{{2,4}}\b)")
_NEAR_OTHER = re.compile(rf"{NEAR} *(?:[A-Z]{{12,}}|[A-Z]+ [A-Z]+)")
_FURTHER = re.compile(FURTHER)
_PIN = re.compile(r"(?<![\d/])[1-9]\d{2} ?\d{3}(?![\d/])")
#: (word that must stand in the text, pattern, group of the wing, group of the number), tried in this order.
_DOORS = [(word, re.compile(p), wing, number) for word, p, wing, number in (
    ("WING", r"\bFLA?T\.?(?: NO\.?)? ?(\d+[A-Z]?) ([A-Z]{1,2}) WING\b", 2, 1),
    ("TOWER", r"\bFLA?T\.?(?: NO\.?)? ?(\d+[A-Z]?) TOWER ([A-Z]{1,2})\b", 2, 1),
    ("BLOCK", r"\bBLOCK ([A-Z]{1,2}) FLAT (\d+[A-Z]?)\b", 1, 2),
    ("F", r"\bF NO\.? ?([A-Z]{1,2})/(\d+[A-Z]?)\b", 1, 2),
    ("BLOCK", r"\b(\d+[A-Z]?) ?, ?([A-Z]{1,2}) BLOCK\b", 2, 1),
    ("BLOCK", r"\b(\d+[A-Z]?) ([A-Z]{1,2}) BLOCK\b", 2, 1),
    (None, r"\b(?:FLAT|FLT|APT|UNIT)\b\.?(?: NO\b\.?)? ?(\d+[A-Z]?)\b", 0, 1),
    (None, r"(?<![\w/])F[- ]?(\d{2,5})\b(?![/-])", 0, 1),  # F is short for flat, as in "F NO"; no wing has that letter
    (None, r"(?<![\w/])((?<![A-Z] )X|[A-EG-WYZ])[- ]?(\d{2,5})\b(?![/-])", 1, 2),  # X after a word is short for cross
    (None, r"(?:\b(?:HOUSE NO|H NO|D\.? ?NO|DOOR NO|PLOT NO|NO)\b|#)[. ]*(\d+[A-Z]?(?:/\d+[A-Z]?)?)\b", 0, 1),
    (None, r"(?:^|[|,;] *|  )(\d{1,5}[A-Z]?(?:/\d+[A-Z]?)?)(?![\w/])", 0, 1),
    (None, r"(?<![\w/])(\d{1,5}[A-Z]?(?:/\d+[A-Z]?)?)(?![\w/])", 0, 1),
)]
_KIND = {w.upper(): w.upper() for w in KINDS} | {a.upper(): b.upper() for a, b in SHORT.items()}
_FIXED = {w for w in (*SUFFIX, *STREET, *_KIND, "MAIN", "PHASE") if len(w) >= 4}
_GLUED = re.compile(rf"^(\w{{2,}}?)({'|'.join(sorted((k for k in _KIND), key=len, reverse=True))})$")
_CLEAN, _FILL, _CLAUSE, _PUNCT = re.compile(r"[^\w@#&/.,;:()\[\]+| -]"), re.compile(r"#{2,}|\*{2,}"), re.compile(r"[,;]|  +"), re.compile(r"[^A-Z0-9|^ ]+")
_ROMAN = {"I": "1", "II": "2", "III": "3", "IV": "4", "1": "1", "2": "2", "3": "3", "4": "4"}


def deletions(word: str) -> set[str]:
    """The word and what is left of it when one letter is lost: two words one slip apart share one of these."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def one_slip_apart(a: str, b: str) -> bool:
    """Equal, or one letter changed, lost or added, or two neighbours exchanged."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x == y[1:] or x[1:] == y or (x[:2] == y[1::-1] and x[2:] == y[2:])


class Names:
    """A fixed list of names that finds a word's name even with one slip; an exact name wins, then the one of the only choice."""

    #: Words whose answers are kept; beyond it they are worked out again.
    KEPT = 300_000

    def __init__(self, names: set[str], least: int = 5):
        self.names, self.least = names, least
        self.known: dict[str, list[str]] = {}
        self.by: dict[str, set[str]] = {}
        for n in sorted(names):
            if len(n) >= least:
                for d in deletions(n):
                    self.by.setdefault(d, set()).add(n)

    def all(self, word: str) -> list[str]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            found = self.known[word] = self._all(word)
        return found

    def _all(self, word: str) -> list[str]:
        if word in self.names:
            return [word]
        if len(word) < self.least:
            return []
        return sorted({n for d in deletions(word) for n in self.by.get(d, ()) if one_slip_apart(n, word)})

    def find(self, word: str) -> str | None:
        return next(iter(self.all(word)), None)


class Gazetteer:
    """The lists that the parser knows: localities (stem and kind, with their cities, ids and pins), cities, first words of project names."""

    def __init__(self, spelt: list[tuple[int, str, str | None, str | None]], brands: set[str]):
        # names of several words are held by their compact spelling and looked for in as many words as the longest has
        localities = [(i, n, c and c.replace(" ", ""), p) for i, n, c, p in spelt]
        self.cities = Names({c for _, _, c, _ in localities if c})
        self.city_words = max((len(c.split()) for _, _, c, _ in spelt if c), default=1)
        self.brands = Names(brands)
        self.brand_sizes = sorted({len(b) for b in brands}, reverse=True)
        self.by_name: dict[tuple[str, str], dict[int, tuple[str | None, set[str]]]] = {}
        self.area: dict[str, str] = {}
        areas: dict[str, dict[str, int]] = {}
        towns: dict[int, str] = {}
        for i, _, c, _ in localities:
            if c:
                towns[i] = c
        for i, name, city, pin in localities:
            if pin and city:
                areas.setdefault(pin[:3], {}).setdefault(city, 0)
                areas[pin[:3]][city] += 1
            m = _GLUED.match(name.replace(" ", ""))
            entry = self.by_name.setdefault((m[1], _KIND[m[2]]) if m else (name.replace(" ", ""), ""), {}).setdefault(i, (towns.get(i), set()))
            if pin:
                entry[1].add(pin)
        self.area = {a: max(sorted(c), key=c.get) for a, c in areas.items()}
        for places in self.by_name.values():
            for i, (city, pins) in list(places.items()):
                places[i] = (city or next((self.area[p[:3]] for p in sorted(pins) if p[:3] in self.area), None), pins)
        self.stems = {k: Names({s for s, kind in self.by_name if kind == k}) for k in {*_KIND.values(), ""}}
        words = [(len(n.split()), bool(_GLUED.match(n.replace(" ", "")))) for _, n, _, _ in spelt]
        self.plain_words = max((k for k, kind in words if not kind), default=0)  # of localities without a kind at their end
        self.stem_words = max((k for k, kind in words if kind), default=1)  # a stem may also stand in one piece more than it is listed with

    def localities(self, stem: str, kind: str) -> list[tuple[str, str]]:
        return [(found, kind) for found in self.stems[kind].all(stem)]


def _kind_at(tokens: list[str], i: int, g: Gazetteer) -> tuple[int, list[tuple[str, str]]] | None:
    """(first token, localities one slip away) of a listed locality that ends at token i: glued, or with its stem in one or more pieces."""
    t = tokens[i]
    kind = _KIND.get(t)
    if kind:
        for n in range(1, g.stem_words + 1):
            if i < n or not tokens[i - n].isalpha():
                break
            found = g.localities("".join(tokens[i - n : i]), kind)
            if found:
                return i - n, found
    m = None if kind else _GLUED.match(t)
    if m:
        found = g.localities(m[1], _KIND[m[2]])
        if found:
            return i, found
        if i and len(m[1]) < 6 and tokens[i - 1].isalpha():
            found = g.localities(tokens[i - 1] + m[1], _KIND[m[2]])
            if found:
                return i - 1, found
    for n in range(g.plain_words, 0, -1):  # names without a word for their kind, the longest first
        if n <= i + 1 and all(x.isalpha() for x in tokens[i - n + 1 : i + 1]):
            found = g.localities("".join(tokens[i - n + 1 : i + 1]), "")
            if found:
                return i - n + 1, found
    return None


def take_apart(address: str | None, zip_code: str | None, g: Gazetteer) -> dict[str, str | None]:
    """The parts of one address: door, wing, family (B building, S street), name, brand, ending, phase, locality, locality_id, city, where the city is told (text or zip), pin.

    `name` is the compact spelling without the brand; a part that isn't there is null. A null or blank address has no parts.
    """
    out: dict[str, str | None] = dict.fromkeys(PARTS)
    text = _CLEAN.sub(" ", (address or "").upper())
    if not text.strip():
        return out
    said = set(_WORD.findall(text))
    says = lambda what: not said.isdisjoint(_CUES[what])
    if says("further"):
        cut = _FURTHER.search(text)
        if cut:
            text = text[: cut.start()]
    text = _FILL.sub(" ", text)
    if "@" in text or "(AT)" in text or "[AT]" in text:
        text = _EMAIL.sub(" | ", text)
    text = text.replace("_", " ")
    if says("tagged"):
        text = _TAGGED.sub(" | ", text)
    if _MANY.search(text):
        text = _LONG.sub(" | ", text)
    if says("floor"):
        text = _FLOOR.sub(" | ", text)
    if says("firm"):
        text = _FIRM.sub(" | ", text)
    if says("person") or "/O" in text:
        text = _PERSON.sub(" | ", text)
    if says("near"):
        text = _NEAR_PLACE.sub(" | ", text)
        text = _NEAR_BRAND.sub(lambda m: " | " if g.brands.find(m[1]) else m[0], text)
        text = _NEAR_OTHER.sub(" | ", text)

    pins = _PIN.findall(text)
    if pins:
        out["pin"] = pins[-1].replace(" ", "")
        text = _PIN.sub(" | ", text)
    z = (zip_code or "").strip().removesuffix(".0")
    z = z if len(z) == 6 and z.isascii() and z.isdigit() and z[0] != "0" else None
    for word, pattern, wing, number in _DOORS:
        m = pattern.search(text) if word is None or word in said else None
        if m:
            out["wing"], out["door"] = (m[wing] if wing else ""), m[number]
            text = f"{text[: m.start()]} ^ {text[m.end() :]}"
            break
    text = _PUNCT.sub(" ", _CLAUSE.sub(" | ", text))
    tokens = text.split()
    for k in range(len(tokens) - 2, -1, -1):  # "R OAD", "NA GAR": a fixed word in two pieces
        both = tokens[k] + tokens[k + 1]
        if both in _FIXED and tokens[k] not in _FIXED and tokens[k + 1] not in _FIXED:
            tokens[k : k + 2] = [both]

    # listed localities, then cities, become marks in the row of tokens
    places: list[list[tuple[str, str]]] = []
    i = len(tokens) - 1
    while i >= 0:
        hit = _kind_at(tokens, i, g) if tokens[i].isalpha() else None
        if hit:
            places.append(hit[1])
            tokens[hit[0] : i + 1] = ["|"]
            i = hit[0]
        i -= 1
    city = None
    for n in range(g.city_words, 0, -1):
        for k in range(len(tokens) - n + 1):
            t = tokens[k] if n == 1 else "".join(tokens[k : k + n])
            if t.isalpha() and t not in _KIND:
                found = g.cities.find(t)
                if found:
                    city, tokens[k : k + n] = city or found, ["|"] * n
    near_pin = out["pin"] or z
    if places:
        # of several that are one slip away, and of several of one name, the city and then the pin decide
        options = {(name, i): (c, held) for name in places[0] for i, (c, held) in g.by_name[name].items()}
        fit = [o for o, (c, _) in options.items() if city is None or c is None or c == city]
        if near_pin and len(fit) > 1:
            fit = [o for o in fit if near_pin in options[o][1]] or [o for o in fit if options[o][0] == g.area.get(near_pin[:3])] or fit
        if len({name for name, _ in fit}) == 1:
            out["locality"] = " ".join(fit[0][0]).strip()
        if len(fit) == 1:
            out["locality_id"] = str(fit[0][1])
            city = city or options[fit[0]][0]
    told = city or (g.area.get(out["pin"][:3]) if out["pin"] else None)
    out["city"] = told or (g.area.get(z[:3]) if z else None)
    out["told"] = "text" if told else "zip" if out["city"] else None
    out["pin"] = out["pin"] or z

    runs: list[tuple[bool, list[str]]] = []  # (right after the door, tokens)
    after, run = False, []
    for t in [*tokens, "|"]:
        if t in "|^":
            if run:
                runs.append((after, run))
                after, run = False, []
            after = after and t == "|" or t == "^"
        elif t.isalpha() or t in _ROMAN or t.isdigit():
            run.append(t)
    # a street: its kind, with the words before it
    for _, run in runs:
        k = next((k for k, t in enumerate(run) if t in STREET and k and run[k - 1].isalpha()), None)
        if k is not None:
            main = run[k - 1] in ("MAIN", "MN")
            words = [t for t in run[: k - main] if t.isalpha()]
            house = next((n for n, t in enumerate(words) if t in HOUSES), None)  # a house's name may stand before its street
            words = words if house is None else words[house + 1 :]
            name = "".join(words)  # all words since the door, the separator or the house's name
            if len(name) >= 2:
                out.update(family="S", name=name, ending=("MAIN " if main else "") + STREET[run[k]])
                return out
    # a building: the words with a known first word, else those after the door, else any before a suffix
    best: tuple[int, int] | None = None
    for n, (after, run) in enumerate(runs):
        words = [t for t in run if t.isalpha() and len(t) > 1]
        if not words:
            continue
        lead = next((k for k, t in enumerate(run) if g.brands.find(t) or _brand_before(t, g)), None)
        suffix = any(t in SUFFIX or t in ("PHASE", "PH") for t in run)
        rank = 3 if lead is not None else 2 if after and suffix else 1 if after or suffix else 0
        if best is None or rank > best[0]:
            best = (rank, n)
    if best is None:
        return out
    run = runs[best[1]][1]
    for k, t in enumerate(run):
        found, glued = g.brands.find(t), _brand_before(t, g)
        if found or glued:
            rest = run[k + 1 :]
            if found and not glued and (not rest or rest[0] in SUFFIX or rest[0] in ("PHASE", "PH")):  # nothing but the first word is the name
                run = [found, *rest]
                break
            out["brand"] = found or glued
            run = ([] if found else [t[len(glued) :]]) + rest
            break
    words: list[str] = []
    for k, t in enumerate(run):  # a name is all words up to its ending
        if t in ("PHASE", "PH") and k + 1 < len(run) and run[k + 1] in _ROMAN:
            out["phase"] = _ROMAN[run[k + 1]]
            out["ending"] = f"PHASE {out['phase']}"
            break
        if t in SUFFIX and words:
            out["ending"] = SUFFIX[t]
            break
        if words and (t in _KIND or t.isdigit()):  # a locality that isn't listed: its stem is no part of the name
            words = words[:-1] if t in _KIND and len(words) > 1 else words
            break
        if t.isalpha() and not (len(t) == 1 and not words):
            words.append(t)
    name = "".join(words)
    if len(name) >= 2:
        out.update(family="B", name=name)
    return out


def _brand_before(token: str, g: Gazetteer) -> str | None:
    """The longest first word that is glued before a longer token; what is left must be two letters or more."""
    return next((token[:n] for n in g.brand_sizes if len(token) >= n + 2 and token[:n] in g.brands.names), None)


PARTS = ("door", "wing", "family", "name", "brand", "ending", "phase", "locality", "locality_id", "city", "told", "pin")
#: Entries of the list of localities, at most; the list is fixed and every worker gets it.
MAX_LIST = 200_000
#: Share of the distinct project names that a first word must begin to count as a brand.
BRAND_SHARE = 0.002


def gazetteer(localities: DataFrame, catalogue: DataFrame) -> Gazetteer:
    """The lists from the fixed table of localities (its size is checked) and the first words that begin BRAND_SHARE of the catalogue's distinct names.

    There can be at most 1 / BRAND_SHARE such words, whatever the catalogue's size. Listings of one name count once, endings and figures don't tell
    names apart, and a word that no name follows is none. Nor is a name glued to its first word: a word that begins with another that as many names follow.
    """
    rows = localities.select("locality_id", F.upper(locality_text(F.col("locality"))).alias("n"), F.upper(city_text(F.col("city"))).alias("c"), F.trim("pincode").alias("p")).where("locality_id IS NOT NULL AND n IS NOT NULL").distinct().limit(MAX_LIST + 1).collect()
    if len(rows) > MAX_LIST:
        raise ValueError("the list of localities is too long for every worker")
    w = F.split(F.trim(F.regexp_replace(F.upper("projectname"), r"[^\p{L}\p{N}]+", " ")), " ")
    own = F.filter(F.slice(w, 2, 100_000), lambda x: x.rlike(r"\p{L}") & ~x.isin(*SUFFIX, "PHASE", "PH", *_ROMAN))
    first = cut_lineage(catalogue.select(F.get(w, F.lit(0)).alias("w"), F.array_join(own, "").alias("own")).where("length(w) >= 2 AND own <> ''").distinct())
    total = first.count()
    names = {r["w"]: r["count"] for r in first.groupBy("w").count().where(F.col("count") >= max(1, BRAND_SHARE * total)).collect()}
    glued = lambda x: any(names.get(x[:n], 0) >= names[x] for n in range(2, len(x) - 1))
    brands = {x for x in names if not glued(x)}
    return Gazetteer([tuple(r) for r in sorted(rows, key=str)], brands)


def address_parts(rows: DataFrame, g: Gazetteer, *, key: str = "row_id", address: str = "address", zip_code: str = "zip") -> DataFrame:
    """(`key`, the PARTS) of every row, each address once where it is read; other columns aren't read."""
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{p} string" for p in PARTS)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            parts = [take_apart(a, z, g) for a, z in zip(t.column("a").to_pylist(), t.column("z").to_pylist(), strict=True)]
            columns = zip(*map(dict.values, parts), strict=True) if parts else [[]] * len(PARTS)
            yield pa.RecordBatch.from_arrays([t.column("k"), *(pa.array(c, pa.string()) for c in columns)], schema=arrow)

    return rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{address}`").alias("a"), F.col(f"`{zip_code}`").cast("string").alias("z")).mapInArrow(run, schema)
