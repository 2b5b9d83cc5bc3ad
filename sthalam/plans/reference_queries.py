"""Queries over the whole tables for scans, cleaning, matching, summaries and reports, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sthalam.functions import extract as X
from sthalam.functions import text as T
from sthalam.functions import words as W
from sthalam.operators import dictionary as D
from sthalam.operators import matching as M
from sthalam.operators import summaries as S
from sthalam.operators.spatial import near_centres
from sthalam.plans import parse as P
from sthalam.plans.parse import parse_addresses, prepare
from sthalam.plans.project_match import Dimensions, dimensions, match_projects, place_pins
from sthalam.plans.slots import slot_stats, with_label
from sthalam.session import spread, table

#: Names that make a brand in the queries: the operator's own default of 15 is met by no brand of the small tables.
FEW = 5
Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- the same expressions in SQL
def s_squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def s_norm(x: str) -> str:
    return s_squeeze(f"regexp_replace(upper({x}), '[^A-Z0-9 ]+', ' ', 'g')")


def s_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def s_map(t: dict[str, str]) -> str:
    return f"map({s_list(t)}, {s_list(t.values())})"


def s_words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def s_expand(x: str, t: dict[str, str]) -> str:
    return f"array_to_string(list_transform({s_words(x)}, lambda w: coalesce(list_extract(map_values({s_map(t)}), list_position(map_keys({s_map(t)}), upper(w))), w)), ' ')"


def s_city(x: str) -> str:
    k = f"lower({s_norm(x)})"
    return f"coalesce(list_extract({s_list(W.CITY_ALIASES.values())}, list_position({s_list(W.CITY_ALIASES)}, {k})), {k})"


def s_match(x: str) -> str:
    return s_expand(s_norm(x), W.MATCH_ABBREVIATIONS)


def combo(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "combo_demog")


def catalogue(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "dotcom_catalogue")


def parsed(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "combo_demog_parsed")


def pins(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pincode_locality_merged")


# --- scans, projections, filters
@query("SELECT row_id, trim(address) AS address, upper(trim(state_code)) AS state_code, trim(zip) AS zip FROM combo_demog WHERE address IS NOT NULL AND trim(address) <> ''")
def q01_scan_project_filter(s, d):
    return combo(s, d).where("address IS NOT NULL AND trim(address) <> ''").select("row_id", F.trim("address").alias("address"), F.upper(F.trim("state_code")).alias("state_code"), F.trim("zip").alias("zip"))


@query(f"SELECT row_id, {s_norm('address')} AS norm, {s_squeeze(chr(10).join(['regexp_replace(regexp_replace(' + s_norm('address') + ', ', chr(39) + '([0-9])([A-Z])' + chr(39) + ', ' + chr(39) + chr(92) + '1 ' + chr(92) + '2' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + '), ' + chr(39) + '([A-Z])([0-9])' + chr(39) + ', ' + chr(39) + chr(92) + '1 ' + chr(92) + '2' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')']))} AS spaced FROM combo_demog")
def q02_norm_text(s, d):
    return combo(s, d).select("row_id", T.norm_name(F.col("address")).alias("norm"), T.split_figures(F.col("address")).alias("spaced"))


@query(f"SELECT row_id, {s_expand(s_norm('address'), W.ABBREVIATIONS)} AS full_words, {s_match('address')} AS for_matching FROM combo_demog")
def q03_abbrev_expand(s, d):
    return combo(s, d).select("row_id", T.expand(T.norm_name(F.col("address"))).alias("full_words"), T.match_text(F.col("address")).alias("for_matching"))


@query(f"SELECT row_id, array_to_string(list_reduce(list_transform({s_words(s_norm('address'))}, lambda w: [w]), lambda a, w: CASE WHEN a[-1] = w[1] OR (list_contains({s_list(W.GEO_TOKENS)}, w[1]) AND list_contains(a, w[1])) THEN a ELSE list_concat(a, w) END, CAST([] AS VARCHAR[])), ' ') AS once FROM combo_demog WHERE address IS NOT NULL")
def q04_dedupe_tokens(s, d):
    return combo(s, d).where("address IS NOT NULL").select("row_id", T.drop_repeats(T.norm_name(F.col("address"))).alias("once"))


def s_all(x: str, pattern: str, new: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{new}', 'g')"


@query(f"SELECT row_id, len(regexp_extract_all(address, '{P.MAIL}')) AS emails, len(regexp_extract_all(address, '{P.PHONE}')) AS phones, {s_all(s_all('address', P.MAIL, ' '), P.PHONE, ' ')} AS rest FROM combo_demog WHERE address IS NOT NULL")
def q05_email_phone_strip(s, d):
    a = F.col("address")
    size = lambda p: F.size(P.found_all(a, p)).cast("bigint")
    return combo(s, d).where("address IS NOT NULL").select("row_id", size(P.MAIL).alias("emails"), size(P.PHONE).alias("phones"), P.without_contacts(a).alias("rest"))


_SLASH = s_all(s_all(s_all("address", "[#*._-]{{3,}}".replace("{{", "{").replace("}}", "}"), " "), "(?i)(^|[^A-Z0-9])/([^A-Z0-9/]|$)", r"\1, \2"), "(?i)(^|[^A-Z0-9])/([^A-Z0-9/]|$)", r"\1, \2")


@query(f"SELECT row_id, trim({s_all(s_all(_SLASH, r'[;|\n\r\t]+|\s{2,}|,', ', '), r'(?:\s*,\s*)+', ', ')}, ' ,.-') AS even FROM combo_demog WHERE address IS NOT NULL")
def q06_junk_separators(s, d):
    return combo(s, d).where("address IS NOT NULL").select("row_id", P.even_separators(P.without_marks(F.col("address"))).alias("even"))


@query("SELECT row_id, coalesce(nullif(trim(zip), ''), nullif(regexp_extract(address, '(?:^|[^0-9A-Za-z_])([1-9][0-9]{5})(?:$|[^0-9A-Za-z_])', 1), '')) AS pin FROM combo_demog")
def q07_pincode_extract(s, d):
    return combo(s, d).select("row_id", T.pin_in(F.col("address"), F.col("zip")).alias("pin"))


_CARE = P.CARE_OF.replace("(?=", "(?:")  # what follows the name is read, not only looked at; the name is the same


@query(f"SELECT row_id, regexp_extract(address, '{_CARE}', 1) AS care_of, regexp_extract(address, '{P.FIRM}', 1) AS firm FROM combo_demog WHERE address IS NOT NULL")
def q08_care_of_org(s, d):
    a = F.col("address")
    return combo(s, d).where("address IS NOT NULL").select("row_id", P.care_of_in(a).alias("care_of"), P.firm_in(a).alias("firm"))


@query(f"SELECT row_id, array_to_string(list_sort(list_distinct(regexp_extract_all({s_expand(s_norm('address'), W.ABBREVIATIONS)}, '(?:^| )(?:NEAR|OPPOSITE|BEHIND|BESIDE|NEXT TO|IN FRONT OF|ADJACENT TO) ((?:[A-Z0-9]+ ){{0,4}}[A-Z0-9]+)', 1))), '; ') AS landmarks FROM combo_demog WHERE address IS NOT NULL")
def q09_landmarks(s, d):
    return combo(s, d).where("address IS NOT NULL").select("row_id", F.array_join(F.array_sort(T.landmarks_in(T.expand(T.norm_name(F.col("address"))))), "; ").alias("landmarks"))


_GUARDED = r"regexp_replace(upper(address), '\b([0-9]+) *(ST|ND|RD|TH)\b', '\1ORD\2', 'g')"
_BACK = reduce(lambda x, e: rf"regexp_replace({x}, '\b([0-9]+)ORD{e}\b', '\1{e.lower()}', 'g')", ("ST", "ND", "RD", "TH"), _GUARDED)


@query(f"SELECT row_id, {_GUARDED} AS guarded, {_BACK} AS back FROM combo_demog WHERE address IS NOT NULL")
def q10_ordinals(s, d):
    g = T.protect_ordinals(F.upper("address"))
    return combo(s, d).where("address IS NOT NULL").select("row_id", g.alias("guarded"), T.restore_ordinals(g).alias("back"))


@query(f"""WITH city AS (SELECT {s_city('city')} AS k, any_value(1) AS x FROM pincode_locality_merged WHERE city IS NOT NULL GROUP BY 1),
pin AS (SELECT pin, max(struct_pack(n := n, c := k)).c AS by_pin FROM (SELECT trim(pincode) AS pin, {s_city('city')} AS k, count(*) AS n FROM pincode_locality_merged WHERE city IS NOT NULL GROUP BY 1, 2) GROUP BY pin)
SELECT rec_id, coalesce(city.k, pin.by_pin) AS city_key, CASE WHEN city.k IS NOT NULL THEN 'own' WHEN pin.by_pin IS NOT NULL THEN 'pin' END AS told_by FROM dotcom_catalogue c LEFT JOIN city ON city.k = {s_city('c.city')} LEFT JOIN pin ON pin.pin = trim(c.pincode)""")
def q11_city_resolver(s, d):
    p = pins(s, d).where("city IS NOT NULL").select(F.trim("pincode").alias("pin"), T.city_key(F.col("city")).alias("k"))
    city = p.select(F.col("k").alias("own")).distinct()
    by_pin = p.groupBy("pin", "k").count().groupBy("pin").agg(F.max(F.struct("count", "k")).alias("t")).select("pin", F.col("t.k").alias("by_pin"))
    c = catalogue(s, d).select("rec_id", T.city_key(F.col("city")).alias("own"), F.trim("pincode").alias("pin"))
    known = c.join(city.withColumn("ok", F.lit(True)), "own", "left").join(by_pin, "pin", "left")
    own = F.when(F.col("ok"), F.col("own"))
    return known.select("rec_id", F.coalesce(own, F.col("by_pin")).alias("city_key"), F.when(own.isNotNull(), "own").when(F.col("by_pin").isNotNull(), "pin").alias("told_by"))


def s_phases(x: str) -> str:
    return f"list_sort(list_distinct(list_transform(regexp_extract_all({s_match(x)}, '(?:PHASE|STAGE|BLOCK|TOWER) ([0-9]+|[IV]+)(?: |$)', 1), lambda h: coalesce(list_extract({s_list(W.ROMAN.values())}, list_position({s_list(W.ROMAN)}, h)), h))))"


@query(f"SELECT rec_id, array_to_string({s_phases('projectname')}, ',') AS phases, len({s_phases('projectname')}) > 0 AND NOT list_has_any({s_phases('projectname')}, ['1']) AS conflicts_with_first FROM dotcom_catalogue WHERE projectname IS NOT NULL")
def q12_phase_guard(s, d):
    p = T.phase_numbers(F.col("projectname"))
    return catalogue(s, d).where("projectname IS NOT NULL").select("rec_id", F.array_join(p, ",").alias("phases"), T.phases_conflict(p, F.array(F.lit("1"))).alias("conflicts_with_first"))


@query(f"""WITH b AS (SELECT string_split({s_norm('projectname')}, ' ')[1] AS brand FROM dotcom_catalogue GROUP BY 1 HAVING count(*) >= {FEW} AND NOT list_contains({s_list(W.BRAND_STOP)}, brand) AND brand <> ''),
t AS (SELECT row_id, {s_words(s_norm('address'))} AS w FROM combo_demog WHERE address IS NOT NULL), m AS (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM t)
SELECT row_id, brand, bool_and(list_has_any(w[greatest(i - 3, 1):i - 1], {s_list(W.LANDMARK_WORDS)})) AS as_landmark FROM m JOIN b ON brand = w[i] GROUP BY row_id, brand""")
def q13_landmark_guard(s, d):
    b = M.brands_of(catalogue(s, d).select(T.norm_name(F.col("projectname")).alias("name")), FEW).select("brand")
    t = combo(s, d).where("address IS NOT NULL").select("row_id", T.tokens(T.norm_name(F.col("address"))).alias("w"))
    hits = t.select("row_id", "w", F.explode(F.array_distinct("w")).alias("brand")).join(b, "brand").dropDuplicates(["row_id", "brand"])
    return hits.select("row_id", "brand", T.named_as_landmark(F.col("w"), F.col("brand")).alias("as_landmark"))


def s_has(words, w: str = "w") -> str:
    return f"list_has_any({w}, {s_list(words)})"


@query(f"""WITH n AS (SELECT rec_id, {s_norm('projectname')} AS n, {s_words(s_norm('projectname'))} AS w FROM dotcom_catalogue WHERE projectname IS NOT NULL)
SELECT rec_id, (n = '' OR {s_has(W.REJECT_WORDS)} OR len(list_filter(w, lambda x: length(x) > 3)) = 0 OR (len(w) = 2 AND regexp_matches(w[1], '^[0-9]+$')) OR (len(w) = 1 AND {s_has(W.SUFFIX_WORDS)}) OR coalesce(w[2] = 'LAYOUT' AND length(w[1]) <= 3, false)) AS rejected,
len(w) >= 2 AND length(n) >= 6 AND NOT {s_has(W.BUILDING_STOP)} AND (regexp_matches(n, '(?:^| )(?:{W.BUILDING_SUFFIX})$') OR NOT regexp_matches(n, ' (?:{'|'.join(W.LOCALITY_SUFFIXES)})$')) AND (regexp_matches(n, '(?:^| )(?:{W.BUILDING_SUFFIX})$') OR len(w) <= 5) AS valid,
(len(w) < 2 OR coalesce(list_sum(list_transform(list_filter(w, lambda x: NOT list_contains({s_list(W.GENERIC_WORDS)}, x) AND NOT regexp_matches(x, '^[0-9]+$')), lambda x: length(x))), 0) < 5) AS generic FROM n""")
def q14_reject_valid(s, d):
    n = T.norm_name(F.col("projectname"))
    return catalogue(s, d).where("projectname IS NOT NULL").select("rec_id", F.coalesce(T.rejected_name(n), F.lit(False)).alias("rejected"), T.valid_building(n).alias("valid"), T.generic_name(n).alias("generic"))


@query(f"""WITH a AS (SELECT DISTINCT city AS typed, {s_city('city')} AS x FROM dotcom_catalogue WHERE city IS NOT NULL), b AS (SELECT DISTINCT trim(city) AS listed, {s_city('city')} AS y FROM pincode_locality_merged WHERE city IS NOT NULL)
SELECT typed, listed FROM a JOIN b ON left(x, 1) = left(y, 1) WHERE x <> '' AND y <> '' AND (x = y OR contains(x, y) OR contains(y, x) OR levenshtein(x, y) <= floor(0.15 * greatest(length(x), length(y)) + 1e-9))""")
def q15_place_match(s, d):
    head = lambda c: F.substring(T.city_key(F.col(c)), 1, 1)
    a = catalogue(s, d).where("city IS NOT NULL").select(F.col("city").alias("typed")).distinct().withColumn("head", head("typed"))
    b = pins(s, d).where("city IS NOT NULL").select(F.trim("city").alias("listed")).distinct().withColumn("head", head("listed"))
    return a.join(b, "head").where(T.place_names_agree(F.col("typed"), F.col("listed"))).select("typed", "listed")


CENTRES_SQL = """c AS (SELECT substr(pin, 1, 3) AS area, (min(latitude) + max(latitude)) / 2 AS cy, (min(longitude) + max(longitude)) / 2 AS cx FROM pincodes WHERE latitude BETWEEN 6 AND 38 AND longitude BETWEEN 68 AND 98 AND pin IS NOT NULL GROUP BY 1)"""


def _centres(s, d):
    p = table(s, d, "pincodes").where("latitude BETWEEN 6 AND 38 AND longitude BETWEEN 68 AND 98 AND pin IS NOT NULL")
    middle = lambda c: (F.min(c) + F.max(c)) / 2
    return p, p.groupBy(F.substring("pin", 1, 3).alias("area")).agg(middle("latitude").alias("cy"), middle("longitude").alias("cx"))


def _within(s, d, km: float):
    p, c = _centres(s, d)
    p = p.select("point_id", "pin", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return near_centres(p, c, km).withColumn("km", F.round("away", 6))


_AWAY = "round(2 * 6371.0 * asin(sqrt(least(1, pow(sin(radians(cy - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(cy)) * pow(sin(radians(cx - longitude) / 2), 2)))), 6)"


@query(f"WITH {CENTRES_SQL}, w AS (SELECT point_id, area, {_AWAY} AS km FROM pincodes, c WHERE latitude BETWEEN 6 AND 38 AND longitude BETWEEN 68 AND 98 AND pin IS NOT NULL) SELECT area, count(*) AS points, max(km) AS farthest_km FROM w WHERE km <= {W.CITY_RADIUS_KM} GROUP BY area")
def q16_radius_join(s, d):
    return _within(s, d, W.CITY_RADIUS_KM).groupBy("area").agg(F.count("*").alias("points"), F.max("km").alias("farthest_km"))


@query(f"WITH {CENTRES_SQL}, w AS (SELECT point_id, area, {_AWAY} AS km FROM pincodes, c WHERE latitude BETWEEN 6 AND 38 AND longitude BETWEEN 68 AND 98 AND pin IS NOT NULL) SELECT area, min(struct_pack(km := km, p := point_id)).p AS point_id, min(km) AS km FROM w WHERE km <= 55 GROUP BY area")
def q17_nearest_point(s, d):
    return _within(s, d, 55.0).groupBy("area").agg(F.min_by("point_id", F.struct("km", "point_id")).alias("point_id"), F.min("km").alias("km"))


_PIN_CITY = f"pin AS (SELECT pin, max(struct_pack(n := n, c := k)).c AS pin_city FROM (SELECT trim(pincode) AS pin, {s_city('city')} AS k, count(*) AS n FROM pincode_locality_merged WHERE city IS NOT NULL AND source <> 'post_list' GROUP BY 1, 2) GROUP BY pin)"


def pin_city(s, d) -> DataFrame:
    """(pin, pin_city): the commonest city of a pin in the listing's rows."""
    k = pins(s, d).where("city IS NOT NULL AND source <> 'post_list'").groupBy(F.trim("pincode").alias("pin"), T.city_key(F.col("city")).alias("k")).count()
    return k.groupBy("pin").agg(F.max(F.struct("count", "k")).alias("t")).select("pin", F.col("t.k").alias("pin_city"))


@query(f"WITH {_PIN_CITY} SELECT row_id, pin_city FROM combo_demog LEFT JOIN pin ON pin = trim(zip)")
def q18_broadcast_lookup(s, d):
    # the list of pins has a fixed size of about a thousand rows
    return combo(s, d).select("row_id", F.trim("zip").alias("pin")).join(F.broadcast(pin_city(s, d)), "pin", "left").select("row_id", "pin_city")


@query(f"""WITH n AS (SELECT {s_city('city')} AS k, {s_norm('projectname')} AS n, min(projectname) AS shown FROM dotcom_catalogue WHERE projectname IS NOT NULL GROUP BY 1, 2), g AS (SELECT n, min(shown) AS shown FROM n GROUP BY 1)
SELECT row_id, parsed_at, CASE WHEN c.k IS NOT NULL THEN n.shown ELSE g.shown END AS canonical FROM combo_demog_parsed p LEFT JOIN (SELECT DISTINCT k FROM n WHERE k IS NOT NULL) c ON c.k = {s_city('p.city')} LEFT JOIN n ON n.k = {s_city('p.city')} AND n.n = {s_norm('p.building_name')} LEFT JOIN g ON g.n = {s_norm('p.building_name')}""")
def q19_scoped_else_global(s, d):
    names = catalogue(s, d).where("projectname IS NOT NULL").select(T.city_key(F.col("city")).alias("k"), T.norm_name(F.col("projectname")).alias("n"), "projectname")
    p = parsed(s, d).select("row_id", "parsed_at", T.city_key(F.col("city")).alias("k"), T.norm_name(F.col("building_name")).alias("n"))
    return D.scoped_else_global(p, names, scope="k", key="n", value="projectname", out="canonical").select("row_id", "parsed_at", "canonical")


# --- dictionary matches
_RUNS = "SELECT row_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS run FROM (SELECT row_id, w, i, unnest(range({least}, least({most}, len(w) - i + 1) + 1)) AS k FROM (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM t))"


@query(f"""WITH t AS (SELECT row_id, {s_words(s_match('address'))} AS w FROM combo_demog WHERE address IS NOT NULL), n AS (SELECT DISTINCT {s_match('projectname')} AS run FROM dotcom_catalogue WHERE projectname IS NOT NULL), r AS ({_RUNS.format(least=2, most=10)})
SELECT row_id, max(struct_pack(k := k, l := -i, run := run)).run AS name, -max(struct_pack(k := k, l := -i, run := run)).l - 1 AS at FROM r SEMI JOIN n USING (run) WHERE length(run) >= 5 GROUP BY row_id""")
def q20_ngram_exact_longest(s, d):
    names = catalogue(s, d).where("projectname IS NOT NULL").select(T.match_text(F.col("projectname")).alias("name"))
    return M.longest_match(combo(s, d).where("address IS NOT NULL"), "row_id", T.match_text(F.col("address")), names)


@query(f"""WITH n AS (SELECT DISTINCT {s_norm('projectname')} AS name FROM dotcom_catalogue WHERE projectname IS NOT NULL), b AS (SELECT name, string_split(name, ' ')[1] AS brand, replace(name, ' ', '') AS c FROM n),
t AS (SELECT row_id, {s_words(s_norm('address'))} AS w, replace({s_norm('address')}, ' ', '') AS ct FROM combo_demog WHERE address IS NOT NULL)
SELECT DISTINCT row_id, name FROM (SELECT row_id, ct, unnest(w) AS word FROM t) JOIN b ON brand = word WHERE length(c) >= 10 AND contains(ct, c)""")
def q21_contains_blocked(s, d):
    n = catalogue(s, d).where("projectname IS NOT NULL").select(T.norm_name(F.col("projectname")).alias("name")).distinct()
    # found by their first letters at every offset; the brand must also stand as a word of its own
    t = combo(s, d).where("address IS NOT NULL").select("row_id", T.norm_name(F.col("address")).alias("a"))
    hits = M.contained_names(t.select("row_id", "a"), "row_id", F.regexp_replace("a", " ", ""), n)
    return hits.join(t, "row_id").where(F.array_contains(T.tokens(F.col("a")), F.get(T.tokens(F.col("name")), F.lit(0)))).select("row_id", "name").distinct()


@query(f"""WITH n AS (SELECT DISTINCT {s_norm('projectname')} AS name, replace({s_norm('projectname')}, ' ', '') AS c FROM dotcom_catalogue WHERE projectname IS NOT NULL), t AS (SELECT row_id, replace({s_norm('address')}, ' ', '') AS ct FROM combo_demog WHERE address IS NOT NULL),
o AS (SELECT row_id, ct, unnest(range(1, length(ct) - 10)) AS i FROM t WHERE length(ct) >= 12)
SELECT row_id, name, min(i) AS at FROM o JOIN n ON substr(ct, i, 6) = left(c, 6) WHERE length(c) >= 12 AND substr(ct, i, length(c)) = c GROUP BY row_id, name""")
def q22_glued_prefix(s, d):
    n = catalogue(s, d).where("projectname IS NOT NULL").select(T.norm_name(F.col("projectname")).alias("name"))
    hits = M.contained_names(combo(s, d).where("address IS NOT NULL"), "row_id", T.compact(F.col("address")), n, least=12)
    return hits.select("row_id", "name", F.col("at").cast("bigint").alias("at"))


_PARTS = f"""n AS (SELECT DISTINCT {s_match('projectname')} AS name FROM dotcom_catalogue WHERE projectname IS NOT NULL), t AS (SELECT name AS row_id, {s_words('name')} AS w FROM n WHERE len({s_words('name')}) >= 3), r AS ({_RUNS.format(least=2, most=6)}),
u AS (SELECT r.run, min(r.row_id) AS name FROM r JOIN t USING (row_id) WHERE r.k < len(t.w) AND length(replace(r.run, ' ', '')) >= 12 GROUP BY r.run HAVING count(DISTINCT r.row_id) = 1)"""


@query(f"WITH {_PARTS} SELECT run, name FROM u ANTI JOIN (SELECT name AS run FROM n) USING (run)")
def q23_partial_unique(s, d):
    return M.unique_fragments(catalogue(s, d).where("projectname IS NOT NULL").select(T.match_text(F.col("projectname")).alias("name")), least=2).select("run", "name")


@query(f"""WITH n AS (SELECT DISTINCT {s_city('city')} AS k, {s_norm('projectname')} AS n, string_split({s_norm('projectname')}, ' ')[1] AS brand FROM dotcom_catalogue WHERE projectname IS NOT NULL AND city IS NOT NULL)
SELECT x.k AS city_key, x.n AS name_a, y.n AS name_b, CAST(levenshtein(x.n, y.n) AS INTEGER) AS distance FROM n x JOIN n y ON x.k = y.k AND x.brand = y.brand AND x.n < y.n WHERE abs(length(x.n) - length(y.n)) <= 2 AND levenshtein(x.n, y.n) <= 2""")
def q24_fuzzy_blocked(s, d):
    n = catalogue(s, d).where("projectname IS NOT NULL AND city IS NOT NULL").select(T.city_key(F.col("city")).alias("city_key"), T.norm_name(F.col("projectname")).alias("n")).distinct()
    n = n.withColumn("brand", F.coalesce(F.get(T.tokens(F.col("n")), F.lit(0)), F.lit("")))
    a, b = n.withColumnRenamed("n", "name_a"), n.withColumnRenamed("n", "name_b")
    p = a.join(b, ["city_key", "brand"]).where((F.col("name_a") < F.col("name_b")) & (F.abs(F.length("name_a") - F.length("name_b")) <= 2))
    return p.withColumn("distance", F.levenshtein("name_a", "name_b")).where("distance <= 2").select("city_key", "name_a", "name_b", "distance")


@query()
def q24b_indel_scores(s, d):
    """Project names of a city and first word that score 92 or more; the score has no SQL, it is tested against brute force."""
    n = catalogue(s, d).where("projectname IS NOT NULL AND city IS NOT NULL").select(T.city_key(F.col("city")).alias("city_key"), T.norm_name(F.col("projectname")).alias("a")).distinct()
    n = n.withColumn("brand", F.coalesce(F.get(T.tokens(F.col("a")), F.lit(0)), F.lit("")))
    return M.fuzzy_pairs(n, n.withColumnRenamed("a", "b"), ["city_key", "brand"], 92.0).where("a < b")


_LOCALITIES = f"l AS (SELECT DISTINCT {s_match('locality')} AS run FROM pincode_locality_merged WHERE locality IS NOT NULL)"


@query(f"""WITH {_LOCALITIES}, t AS (SELECT row_id, {s_words(s_match('address'))} AS w FROM combo_demog WHERE address IS NOT NULL), r AS ({_RUNS.format(least=1, most=6)}), h AS (SELECT DISTINCT row_id, run FROM r SEMI JOIN l USING (run) WHERE length(run) >= 4)
SELECT row_id, run AS locality FROM h WHERE NOT EXISTS (SELECT 1 FROM h o WHERE o.row_id = h.row_id AND length(o.run) > length(h.run) AND contains(' ' || o.run || ' ', ' ' || h.run || ' '))""")
def q25_nested_hit_removal(s, d):
    l = pins(s, d).where("locality IS NOT NULL").select(T.match_text(F.col("locality")).alias("run")).distinct()  # noqa: E741
    runs = M.word_runs(combo(s, d).where("address IS NOT NULL"), "row_id", T.match_text(F.col("address")), 1, D.longest_name(l, "run"), leads=M.first_words(l, "run")).where(F.length("run") >= 4)
    hits = runs.join(l, "run").select("row_id", F.col("run").alias("locality")).distinct()
    return M.without_nested(hits, "row_id", "locality")


@query(f"""WITH {_PIN_CITY}, st AS (SELECT state, max(struct_pack(n := n, c := c)).c AS state_city FROM (SELECT upper(trim(state_code)) AS state, lower(trim(city)) AS c, count(*) AS n FROM combo_demog_parsed WHERE city IS NOT NULL AND state_code IS NOT NULL GROUP BY 1, 2) GROUP BY state)
SELECT row_id, parsed_at, coalesce(nullif(trim(city), ''), pin_city, state_city) AS city, CASE WHEN nullif(trim(city), '') IS NOT NULL THEN 'parsed' WHEN pin_city IS NOT NULL THEN 'pin' WHEN state_city IS NOT NULL THEN 'state' END AS told_by FROM combo_demog_parsed p LEFT JOIN pin ON pin = trim(p.zip) LEFT JOIN st ON st.state = upper(trim(p.state_code))""")
def q26_cascade_first_nonnull(s, d):
    p = parsed(s, d)
    by_state = p.where("city IS NOT NULL AND state_code IS NOT NULL").groupBy(F.upper(F.trim("state_code")).alias("state"), F.lower(F.trim("city")).alias("c")).count().groupBy("state").agg(F.max(F.struct("count", "c")).alias("t")).select("state", F.col("t.c").alias("state_city"))
    j = p.withColumn("pin", F.trim("zip")).withColumn("state", F.upper(F.trim("state_code"))).join(pin_city(s, d), "pin", "left").join(by_state, "state", "left")
    return j.select("row_id", "parsed_at", M.first_known(parsed=F.col("city"), pin=F.col("pin_city"), state=F.col("state_city")).alias("x")).select("row_id", "parsed_at", F.col("x.value").alias("city"), F.col("x.source").alias("told_by"))


# --- summaries
@query(f"""WITH a AS (SELECT trim(pincode) AS pin, {s_match('locality')} AS name, min(trim(locality)) AS locality FROM pincode_locality_merged WHERE source IN ('listing_sheet', 'both') GROUP BY 1, 2), b AS (SELECT trim(pincode) AS pin, {s_match('locality')} AS name, min(trim(locality)) AS locality FROM pincode_locality_merged WHERE source IN ('post_list', 'both') GROUP BY 1, 2)
SELECT coalesce(a.pin, b.pin) AS pin, coalesce(a.name, b.name) AS name, coalesce(a.locality, b.locality) AS locality, CASE WHEN a.pin IS NULL THEN 'post_list' WHEN b.pin IS NULL THEN 'listing_sheet' ELSE 'both' END AS source FROM a FULL JOIN b ON a.pin = b.pin AND a.name = b.name""")
def q27_upsert_merge(s, d):
    p = pins(s, d).select(F.trim("pincode").alias("pin"), T.match_text(F.col("locality")).alias("name"), F.trim("locality").alias("locality"), "source")
    return S.merge_sources(p.where("source IN ('listing_sheet', 'both')"), p.where("source IN ('post_list', 'both')"), ["pin", "name"], "locality", ("listing_sheet", "post_list"))


@query(f"WITH e AS (SELECT {s_match('sublocation')} AS name, trim(sublocation) AS shown, count(*) AS n, min(rec_id) AS o FROM dotcom_catalogue WHERE sublocation IS NOT NULL GROUP BY 1, 2) SELECT name, max(struct_pack(n := n, o := -o, s := shown)).s AS shown, max(n) AS n FROM e GROUP BY name")
def q28_mode_display(s, d):
    c = catalogue(s, d).where("sublocation IS NOT NULL").select(T.match_text(F.col("sublocation")).alias("name"), F.trim("sublocation").alias("shown"), "rec_id")
    return S.commonest(c, ["name"], "shown", F.col("rec_id"))


@query(f"SELECT replace({s_norm('projectname')}, ' ', '') AS name, max(struct_pack(l := length(projectname), o := -rec_id, s := projectname)).s AS projectname FROM dotcom_catalogue WHERE projectname IS NOT NULL GROUP BY 1")
def q29_longest_repr(s, d):
    return S.longest(catalogue(s, d).withColumn("name", T.compact(F.col("projectname"))), ["name"], "projectname", F.col("rec_id"))


@query(f"WITH b AS (SELECT string_split({s_norm('projectname')}, ' ')[1] AS brand FROM dotcom_catalogue WHERE projectname IS NOT NULL) SELECT brand, count(*) AS names FROM b WHERE brand <> '' AND NOT list_contains({s_list(W.BRAND_STOP)}, brand) GROUP BY brand HAVING count(*) >= {FEW}")
def q30_having_brand(s, d):
    return M.brands_of(catalogue(s, d).select(T.norm_name(F.col("projectname")).alias("name")), FEW)


@query(f"WITH n AS (SELECT locality, zip, count(*) AS n FROM combo_demog_parsed WHERE locality IS NOT NULL AND zip IS NOT NULL GROUP BY 1, 2) SELECT locality, zip, n FROM (SELECT *, sum(n) OVER (PARTITION BY zip) AS a FROM n) WHERE n >= {W.LEARNED_COUNT} AND n / a >= {W.LEARNED_SHARE}")
def q31_learned_share(s, d):
    return S.learned_pairs(parsed(s, d), "locality", "zip", W.LEARNED_COUNT, W.LEARNED_SHARE)


@query(f"SELECT {s_city('city')} AS city_key, regexp_replace({s_match('sublocation')}, ' +(PHASE|STAGE|SECTOR|BLOCK) +([IVX]+|[0-9]+)$', '') AS base, array_to_string(list_sort(list(DISTINCT pin)), ';') AS pins FROM (SELECT city, sublocation, trim(unnest(string_split(all_pincodes, ';'))) AS pin FROM dotcom_catalogue WHERE pincode_confidence IN ('high', 'medium') AND city IS NOT NULL AND sublocation IS NOT NULL) WHERE pin <> '' GROUP BY 1, 2")
def q32_set_union_key(s, d):
    return place_pins(catalogue(s, d)).groupBy("city_key", "base").agg(F.array_join(F.array_sort(F.collect_set("pin")), ";").alias("pins"))


FILLED = ["building_number", "building_name", "landmark", "locality", "locality_source", "city", "district", "dotcom_match_rule"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (length(trim({c})) > 0) AS filled, count(*) AS total, round(100.0 * count(*) FILTER (length(trim({c})) > 0) / count(*), 4) AS share FROM combo_demog_parsed" for c in FILLED))
def q33_fill_report(s, d):
    return S.fill_report(parsed(s, d), FILLED)


@query("SELECT count(*) AS total, count(*) FILTER (dotcom_matched = 'Yes') AS matched, count(*) FILTER (location_matched = 'Yes') AS located, count(*) FILTER (nullif(trim(zip), '') IS NULL) AS zip_missing, count(*) FILTER (nullif(trim(state_code), '') IS NULL) AS state_missing, count(*) FILTER (confidence >= 0.8) AS high, count(*) FILTER (confidence >= 0.6 AND confidence < 0.8) AS middle, count(*) FILTER (confidence < 0.6) AS low FROM combo_demog_parsed")
def q33b_run_counters(s, d):
    return parsed(s, d).agg(*S.counters())


@query("SELECT coalesce(locality_source, '') AS locality_source, coalesce(lower(trim(dotcom_match_rule)), '') AS rule, count(*) AS n FROM combo_demog_parsed GROUP BY 1, 2")
def q33c_group_counts(s, d):
    return parsed(s, d).groupBy(F.coalesce("locality_source", F.lit("")).alias("locality_source"), F.coalesce(F.lower(F.trim("dotcom_match_rule")), F.lit("")).alias("rule")).agg(F.count("*").alias("n"))


def s_case(t: dict, x: str, other: float) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in t.items()) + f" ELSE {other} END"


_HAS = lambda c: f"coalesce(length(trim({c})) > 0, false)"


_STATES = f"st AS (SELECT pin, max(struct_pack(n := n, s := s)).s AS state FROM (SELECT trim(zip) AS pin, upper(trim(state_code)) AS s, count(*) AS n FROM combo_demog WHERE regexp_matches(trim(zip), '^[1-9][0-9]{{5}}$') AND list_contains({s_list(W.STATES)}, upper(trim(state_code))) GROUP BY 1, 2) GROUP BY pin)"


def pin_states(s, d) -> DataFrame:
    """(pin, state): the commonest known state code of a pin's bureau rows."""
    r = combo(s, d).select(F.trim("zip").alias("pin"), F.upper(F.trim("state_code")).alias("s")).where(F.col("pin").rlike("^[1-9][0-9]{5}$") & F.col("s").isin(*W.STATES))
    return r.groupBy("pin", "s").count().groupBy("pin").agg(F.max(F.struct("count", "s")).alias("t")).select("pin", F.col("t.s").alias("state"))


def s_state(x: str) -> str:
    return f"list_extract({s_list(W.STATES.values())}, list_position({s_list(W.STATES)}, upper(trim({x}))))"


def s_evidence(own: str, known: str) -> str:
    a, b = s_city(s_state(own)), s_city(s_state(known))
    return f"CASE WHEN {b} IS NULL THEN NULL WHEN {a} IS NULL THEN 0 WHEN {a} = {b} OR contains({a}, {b}) OR contains({b}, {a}) OR levenshtein({a}, {b}) <= floor(0.15 * greatest(length({a}), length({b})) + 1e-9) THEN 1 ELSE -1 END"


@query(f"""WITH {_PIN_CITY}, {_STATES}, p AS (SELECT *, lower(trim(dotcom_match_rule)) AS rule, regexp_matches(coalesce(trim(zip), ''), '^[1-9][0-9]{{5}}$') AS is_pin FROM combo_demog_parsed LEFT JOIN pin ON pin.pin = trim(zip) LEFT JOIN st ON st.pin = trim(zip)), e AS (SELECT *, {s_evidence('state_code', 'state')} AS evidence FROM p)
SELECT row_id, parsed_at, evidence, round(CAST(greatest(0, least(1, CASE WHEN is_pin THEN 0.18 ELSE 0 END + CASE WHEN is_pin AND pin_city IS NOT NULL THEN 0.07 ELSE 0 END + CASE evidence WHEN 1 THEN 0.15 WHEN -1 THEN -0.12 WHEN 0 THEN 0.05 ELSE 0 END + CASE WHEN coalesce({s_city('city')} = pin_city, false) THEN 0.1 WHEN {_HAS('city')} THEN 0.04 ELSE 0 END
+ CASE WHEN {_HAS('building_name')} THEN 0.22 + CASE WHEN {_HAS('rule')} THEN {s_case(W.RULE_WEIGHT, 'rule', 0.12)} WHEN coalesce(location_matched = 'Yes', false) THEN 0.12 WHEN coalesce({s_norm('building_name')} = {s_norm('locality')}, false) THEN 0.04 ELSE 0.06 END ELSE 0 END
+ CASE WHEN {_HAS('locality')} THEN {s_case(W.SOURCE_WEIGHT, 'locality_source', 0.05)} ELSE 0 END + CASE WHEN {_HAS('building_number')} THEN 0.04 ELSE 0 END + CASE WHEN {_HAS('landmark')} THEN 0.04 ELSE 0 END)) AS DOUBLE), 3) AS rescored FROM e""")
def q34_confidence_score(s, d):
    p = parsed(s, d).withColumn("pin", F.trim("zip")).join(F.broadcast(pin_city(s, d)), "pin", "left").join(pin_states(s, d), "pin", "left")  # a pin has six figures
    agrees = T.city_key(F.col("city")) == F.col("pin_city")
    p = p.withColumn("evidence", T.state_evidence(F.col("state_code"), F.col("state")))
    c = T.confidence(F.col("pin").rlike("^[1-9][0-9]{5}$"), F.col("pin_city").isNotNull(), F.col("evidence"), agrees, F.col("city"), F.col("building_name"), F.lower(F.trim("dotcom_match_rule")), F.col("location_matched") == "Yes", T.norm_name(F.col("building_name")) == T.norm_name(F.col("locality")), F.col("locality_source"), F.col("locality"), F.col("building_number"), F.col("landmark"))
    return p.select("row_id", "parsed_at", "evidence", c.alias("rescored"))


_RANK = s_case(W.RULE_RANK, "lower(trim(dotcom_match_rule))", 0)


@query(f"SELECT row_id, rule, confidence FROM (SELECT row_id, lower(trim(dotcom_match_rule)) AS rule, confidence, row_number() OVER (PARTITION BY row_id ORDER BY {_RANK} DESC, length(building_name) DESC NULLS LAST, parsed_at DESC) AS i FROM combo_demog_parsed) WHERE i = 1")
def q35_rule_rank_top1(s, d):
    rule = F.lower(F.trim("dotcom_match_rule"))
    rank = F.coalesce(T.lookup({k: str(v) for k, v in W.RULE_RANK.items()}, rule).cast("int"), F.lit(0))
    best = F.max(F.struct(rank.alias("rank"), F.coalesce(F.length("building_name"), F.lit(-1)).alias("l"), "parsed_at", rule.alias("rule"), "confidence")).alias("b")
    return parsed(s, d).groupBy("row_id").agg(best).select("row_id", F.col("b.rule").alias("rule"), F.col("b.confidence").alias("confidence"))


_STRATUM = "coalesce(nullif(lower(trim(dotcom_match_rule)), ''), 'none')"


@query(f"SELECT rule, row_id, parsed_at FROM (SELECT *, {_STRATUM} AS rule, row_number() OVER (PARTITION BY {_STRATUM} ORDER BY md5('20260923|' || row_id || '|' || epoch_us(parsed_at))) AS i FROM combo_demog_parsed) WHERE i <= 50")
def q36_stratified_sample(s, d):
    p = parsed(s, d).withColumn("rule", F.coalesce(F.nullif(F.lower(F.trim("dotcom_match_rule")), F.lit("")), F.lit("none"))).withColumn("key", F.concat_ws("|", "row_id", F.unix_micros(F.col("parsed_at").cast("timestamp"))))
    return S.per_stratum(p, "rule", "key", 50, "20260923").select("rule", "row_id", "parsed_at")


@query("SELECT CASE WHEN grouping(r) = 1 THEN 'ALL' ELSE r END AS stratum, count(*) FILTER (dotcom_matched = 'Yes' AND location_matched = 'Yes') AS correct, count(*) FILTER (dotcom_matched = 'Yes' AND location_matched = 'No') AS wrong, CASE WHEN count(*) FILTER (dotcom_matched = 'Yes' AND location_matched IN ('Yes', 'No')) > 0 THEN round(count(*) FILTER (dotcom_matched = 'Yes' AND location_matched = 'Yes') / count(*) FILTER (dotcom_matched = 'Yes' AND location_matched IN ('Yes', 'No')), 6) END AS precision FROM (SELECT *, coalesce(locality_source, 'none') AS r FROM combo_demog_parsed) GROUP BY ROLLUP (r)")
def q37_precision_rollup(s, d):
    yes = F.coalesce(F.col("dotcom_matched") == "Yes", F.lit(False))
    p = parsed(s, d).withColumn("r", F.coalesce("locality_source", F.lit("none")))
    return S.precision_rollup(p, "r", yes & (F.col("location_matched") == "Yes"), yes & (F.col("location_matched") == "No"))


_SLOT_1, _SLOT_2 = {"building_name": "building_name", "dotcom_matched": "dotcom_matched", "location_matched": "location_matched", "confidence": "confidence"}, {"building_name": "locality", "dotcom_matched": "location_matched", "location_matched": "dotcom_matched", "confidence": "nullif(confidence, 0.5)"}
_SLOT_TESTS = {"parsed": "{confidence} IS NOT NULL", "named": "coalesce(length(trim({building_name})) > 0, false)", "matched": "coalesce({dotcom_matched} = 'Yes', false)", "located": "coalesce({location_matched} = 'Yes', false)"}


def _slot_sql(name: str, how) -> str:
    return f"SELECT '{name}' AS slot, count(*) AS rows, " + ", ".join(f"count(*) FILTER ({how(t)}) AS {n}" for n, t in _SLOT_TESTS.items()) + " FROM combo_demog_parsed"


@query(" UNION ALL ".join([_slot_sql("1", lambda t: t.format(**_SLOT_1)), _slot_sql("2", lambda t: t.format(**_SLOT_2)), _slot_sql("either", lambda t: f"({t.format(**_SLOT_1)}) OR ({t.format(**_SLOT_2)})")]))
def q38_slot_stats(s, d):
    """The slot counters over the parsed rows, with other columns of them in the place of a second address."""
    return slot_stats(parsed(s, d).select(*(F.expr(e).alias(f"{c}_{k}") for k, t in ((1, _SLOT_1), (2, _SLOT_2)) for c, e in t.items())))


def s_title_building(x: str) -> str:
    return f"array_to_string(list_transform({s_words(s_squeeze(x))}, lambda w: CASE WHEN lower(w) <> upper(w) AND (w = lower(w) OR w = upper(w)) THEN upper(left(w, 1)) || lower(substr(w, 2)) ELSE w END), ' ')"


def s_label(word: str) -> str:
    x = rf"trim(regexp_extract(address, '(?i)\b{word}\s*(?:name)?\s*[:\-]\s*([^,;|]{{2,60}})', 1))"
    return f"CASE WHEN length({x}) >= 2 THEN {x} END"


@query(rf"""WITH a AS (SELECT row_id, parsed_at, building_name AS bn, dotcom_matched AS dm, address || CASE row_id % 3 WHEN 0 THEN '; Building Name: ' || coalesce(building_name, 'NEW ONE') WHEN 1 THEN '; Society - ' || coalesce(locality, 'OTHER ONE') ELSE '' END AS address FROM combo_demog_parsed WHERE address IS NOT NULL),
l AS (SELECT *, coalesce({s_label('building')}, {s_label('society')}, {s_label('complex')}) AS label FROM a), n AS (SELECT *, {s_norm('label')} AS x, {s_norm('bn')} AS y FROM l),
t AS (SELECT *, coalesce((contains(x, y) OR contains(y, x)) AND y <> '', false) AS aligned, coalesce(trim(bn) = '', true) OR length(trim(bn)) <= 2 OR regexp_matches(bn, '(?i)^\s*(wing|plot|flat|room|shop|floor|block)\b') AS weak FROM n),
k AS (SELECT *, label IS NOT NULL AND (weak OR NOT aligned OR coalesce(dm <> 'Yes', false)) AS takes FROM t)
SELECT row_id, parsed_at, takes AS relabelled, CASE WHEN takes THEN {s_title_building('label')} ELSE bn END AS building_name, CASE WHEN takes AND dm = 'Yes' AND NOT aligned THEN 'No' ELSE dm END AS dotcom_matched FROM k""")
def q39_label_override(s, d):
    """The label override, over the parsed rows with a label written behind two addresses in three."""
    name = lambda c, other: F.coalesce(F.col(c), F.lit(other))
    label = F.when(F.col("row_id") % 3 == 0, F.concat(F.lit("; Building Name: "), name("building_name", "NEW ONE"))).when(F.col("row_id") % 3 == 1, F.concat(F.lit("; Society - "), name("locality", "OTHER ONE"))).otherwise("")
    p = parsed(s, d).where("address IS NOT NULL").withColumn("address", F.concat("address", label))
    return with_label(p).select("row_id", "parsed_at", "relabelled", "building_name", "dotcom_matched")


@query("SELECT kind, lower(trim(v)) AS value, count(*) AS n FROM (SELECT 'projectname' AS kind, projectname AS v FROM dotcom_catalogue UNION ALL SELECT 'city', city FROM dotcom_catalogue UNION ALL SELECT 'sublocation', sublocation FROM dotcom_catalogue) WHERE v IS NOT NULL AND trim(v) <> '' GROUP BY 1, 2")
def q40_unpivot(s, d):
    long = catalogue(s, d).unpivot(["rec_id"], ["projectname", "city", "sublocation"], "kind", "v")
    return long.where("v IS NOT NULL AND trim(v) <> ''").groupBy("kind", F.lower(F.trim("v")).alias("value")).agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY event_type")
def q41_json(s, d):
    return table(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.from_json("props", "k bigint")["k"]).alias("k"))


@query("SELECT unnest(offices) AS office, count(DISTINCT pin) AS pins FROM pincodes WHERE offices IS NOT NULL AND pin IS NOT NULL GROUP BY 1")
def q41b_office_pins(s, d):
    return table(s, d, "pincodes").where("offices IS NOT NULL AND pin IS NOT NULL").select(F.explode("offices").alias("office"), "pin").groupBy("office").agg(F.count_distinct("pin").alias("pins"))


@query(f"WITH {_PIN_CITY} SELECT row_id, parsed_at, city, pin_city FROM combo_demog_parsed JOIN pin ON pin = trim(zip) WHERE city IS NOT NULL AND {s_city('city')} <> pin_city ORDER BY row_id, parsed_at LIMIT 20")
def q42_mismatch_topn(s, d):
    p = parsed(s, d).withColumn("pin", F.trim("zip")).join(F.broadcast(pin_city(s, d)), "pin").where(F.col("city").isNotNull() & (T.city_key(F.col("city")) != F.col("pin_city")))
    return p.select("row_id", "parsed_at", "city", "pin_city").orderBy("row_id", "parsed_at").limit(20)


@query(f"""WITH {_LOCALITIES}, t AS (SELECT row_id, {s_words(s_match('address'))} AS w FROM combo_demog WHERE address IS NOT NULL), r AS ({_RUNS.format(least=1, most=4)}), c AS (SELECT replace(run, ' ', '') AS c, min(run) AS locality FROM l GROUP BY 1)
SELECT row_id, max(struct_pack(n := length(locality), l := locality)).l AS locality FROM r JOIN c ON c.c = replace(r.run, ' ', '') WHERE length(c.c) >= 8 GROUP BY row_id""")
def q43_whole_word(s, d):
    l = pins(s, d).where("locality IS NOT NULL").select(T.match_text(F.col("locality")).alias("locality")).distinct()  # noqa: E741
    c = l.groupBy(F.regexp_replace("locality", " ", "").alias("c")).agg(F.min("locality").alias("locality")).where(F.length("c") >= 8)
    runs = M.word_runs(combo(s, d).where("address IS NOT NULL"), "row_id", T.match_text(F.col("address")), 1, 4).withColumn("c", F.regexp_replace("run", " ", ""))
    return runs.join(c, "c").groupBy("row_id").agg(F.max_by("locality", F.struct(F.length("locality"), "locality")).alias("locality"))


def _dims(s, d) -> Dimensions:
    return dimensions(catalogue(s, d), pins(s, d), table(s, d, "pincodes"))


@query()
def q44_project_match(s, d):
    """Which record an address lies in and by which rule; no SQL, golden cases and invariants are tested."""
    a = combo(s, d).select(F.col("row_id").alias("id"), "address", "zip", *(F.lit(None).cast("string").alias(c) for c in ("city", "locality", "building")))
    return match_projects(a, _dims(s, d))


@query()
def q46_parse(s, d):
    """The whole parse of the bureau rows; no SQL, golden cases are tested."""
    districts = table(s, d, "pincodes").where("pin IS NOT NULL AND district IS NOT NULL").groupBy("pin").agg(F.min("district").alias("district"))
    return parse_addresses(spread(combo(s, d)), _dims(s, d), districts=districts, states=pin_states(s, d))


@query()
def q47_prepare(s, d):
    """The cleaned texts and what was taken out of them; no SQL, golden cases are tested."""
    return prepare(spread(combo(s, d))).select("row_id", "text", "parser_text", "pin", "care_of", "organisation", "landmarks", "segments", "dropped")


_ENDS = rf"(?:{W.BUILDING_SUFFIX})"
_GOOD = lambda x: f"CASE WHEN NOT regexp_matches({x}, '[0-9]{{6}}') THEN {x} END"
_NUMBER = [r"\bNO\.? *([0-9]+[A-Z]?(?:[/-][0-9]+[A-Z]?)?)\b", r"\b(?:FLAT|FLT|HOUSE|PLOT|DOOR|SHOP|APT|APARTMENT|ROOM|UNIT|OFFICE) *(?:NO\.?|NUMBER)? *[:#.-]? *([A-Z]{0,3}[0-9]+[A-Z]?(?:[/-][0-9]+[A-Z]?)?)", r"^([A-Z]{1,3}-?[0-9]+[A-Z]?)(?: |,|$)", r"^([0-9]{1,4}(?:/[0-9]+)?)(?: |,|$)"]


def s_one(pattern: str, x: str = "n") -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', 1), '')"


def s_longest(x: str) -> str:
    return f"list_reduce({x}, lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END, '')"


def s_unless(x: str, words) -> str:
    return f"CASE WHEN NOT list_has_any(string_split({x}, ' '), {s_list(words)}) THEN {x} END"


def s_phrases(ends, least: int, most: int) -> str:
    lead = f"w[greatest(i - {most}, 1):i - 1]"
    bad = f"coalesce(list_max(list_transform({lead}, lambda x, k: CASE WHEN regexp_matches(x, '^{X.WORD}$') THEN 0 ELSE k END)), 0)"
    at = f"list_filter(range(1, len(w) + 1), lambda i: list_contains({s_list(ends)}, w[i]))"
    return f"list_filter(list_transform({at}, lambda i: array_to_string(list_concat(({lead})[{bad} + 1:], w[i:i]), ' ')), lambda x: len(string_split(x, ' ')) > {least})"


@query(f"""WITH t AS (SELECT row_id, upper(address) AS a, {s_norm('address')} AS n, {s_words(s_norm('address'))} AS w FROM combo_demog WHERE address IS NOT NULL)
SELECT row_id, coalesce({', '.join(_GOOD(s_one(p, 'a')) for p in _NUMBER)}) AS number, {s_one(f'((?:[A-Z0-9]+ ){{1,5}}{_ENDS})(?: |$)')} AS by_ending, nullif({s_longest(f"list_filter(w, lambda x: regexp_matches(x, '^{X.WORD}(?:{'|'.join(W.COMPOUND_ENDS)})$'))")}, '') AS compound,
{s_one(f'(?:^| )(?:NEAR|BEHIND|OPPOSITE|BESIDE|NEXT TO) ((?:{X.WORD} ){{1,4}}{_ENDS})(?: |$)')} AS landmark, {s_one('(?:^| )([A-Z][A-Z0-9]{4,20} LAYOUT)(?: |$)')} AS one_word_layout, {s_unless(s_one(f'((?:{X.WORD} ){{0,3}}{X.WORD}) (?:BLDG|BUILDING)(?: |$)'), W.BUILDING_STOP)} AS before_bldg, {s_one(f'((?:{X.WORD} ){{1,4}}RESIDENCE)(?: |$)')} AS residence,
nullif({s_longest(f"list_filter({s_phrases(W.SOCIETY_ENDS, 1, 4)}, lambda x: NOT list_has_any(string_split(x, ' '), {s_list(W.BUILDING_STOP)}))")}, '') AS society, {s_phrases(W.ENCLAVE_ENDS, 1, 3)}[1] AS enclave, {s_phrases([e for e in W.AREA_PHRASE_ENDS if ' ' not in e], 0, 3)}[-1] AS area FROM t""")
def q45_building_extractors(s, d):
    t = combo(s, d).where("address IS NOT NULL").select("row_id", F.upper("address").alias("a"), T.norm_name(F.col("address")).alias("n"))
    n, none = F.col("n"), F.lit(None).cast("string")
    area = T.let(X.phrases_ending(n, [e for e in W.AREA_PHRASE_ENDS if " " not in e], 0, 3), lambda o: F.get(o, F.size(o) - 1))
    ways = {"number": T.building_number(F.col("a")), "by_ending": T.building_by_ending(n), "compound": X.compound_building(n), "landmark": X.landmark_building(n), "one_word_layout": X.one_word_layout(n, none), "before_bldg": X.before_bldg(n), "residence": X.residence(n), "society": X.society(n, none), "enclave": X.enclave(n, none), "area": area}
    return t.select("row_id", *(c.alias(k) for k, c in ways.items()))


@query(f"WITH a AS (SELECT DISTINCT trim(zip) AS pin FROM combo_demog WHERE zip IS NOT NULL), b AS (SELECT DISTINCT trim(pincode) AS pin FROM pincode_locality_merged WHERE pincode IS NOT NULL) (SELECT pin, 'both' AS held_by FROM (SELECT pin FROM a INTERSECT SELECT pin FROM b)) UNION ALL (SELECT pin, 'rows' FROM (SELECT pin FROM a EXCEPT SELECT pin FROM b)) UNION ALL (SELECT pin, 'list' FROM (SELECT pin FROM b EXCEPT SELECT pin FROM a))")
def q48_set_ops(s, d):
    a = combo(s, d).where("zip IS NOT NULL").select(F.trim("zip").alias("pin")).distinct()
    b = pins(s, d).where("pincode IS NOT NULL").select(F.trim("pincode").alias("pin")).distinct()
    tag = lambda x, t: x.withColumn("held_by", F.lit(t))
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "rows")).unionByName(tag(b.subtract(a), "list"))


@query("SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def q49_event_hours(s, d):
    return table(s, d, "events").groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT row_id, min(loaded_at) AS first_load, count(*) AS deliveries FROM (SELECT min(row_id) OVER (PARTITION BY address, zip) AS row_id, loaded_at FROM combo_demog WHERE address IS NOT NULL) GROUP BY row_id")
def q50_distinct_deliveries(s, d):
    return combo(s, d).where("address IS NOT NULL").groupBy("address", "zip").agg(F.min("row_id").alias("row_id"), F.min("loaded_at").alias("first_load"), F.count("*").alias("deliveries")).select("row_id", "first_load", "deliveries")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
