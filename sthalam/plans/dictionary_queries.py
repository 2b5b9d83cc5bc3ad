"""Queries of dictionary lookups, states, titles, phrases, flags, reviews and their counts, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sthalam.functions import extract as X
from sthalam.functions import text as T
from sthalam.functions import words as W
from sthalam.operators import dictionary as D
from sthalam.operators import matching as M
from sthalam.plans import builders as B
from sthalam.plans.reference_queries import _PIN_CITY, _RUNS, _STATES, catalogue, combo, parsed, pin_city, pin_states, pins, s_city, s_evidence, s_list, s_match, s_norm, s_squeeze, s_state, s_title_building, s_words

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _names(s, d) -> DataFrame:
    return catalogue(s, d).where("projectname IS NOT NULL").select(T.match_text(F.col("projectname")).alias("name")).where("name <> ''").distinct()


def _places(s, d) -> DataFrame:
    return pins(s, d).where("locality IS NOT NULL").select(T.match_text(F.col("locality")).alias("name")).where("name <> ''").distinct()


def _texts(s, d) -> DataFrame:
    return combo(s, d).where("address IS NOT NULL").select(F.col("row_id").alias("id"), T.match_text(F.col("address")).alias("text"), F.trim("zip").alias("pin"))


_N = f"n AS (SELECT DISTINCT {s_match('projectname')} AS name FROM dotcom_catalogue WHERE projectname IS NOT NULL AND {s_match('projectname')} <> '')"
_L = f"l AS (SELECT DISTINCT {s_match('locality')} AS name FROM pincode_locality_merged WHERE locality IS NOT NULL AND {s_match('locality')} <> '')"
_T = f"t AS (SELECT row_id, trim(zip) AS pin, {s_words(s_match('address'))} AS w, {s_match('address')} AS text FROM combo_demog WHERE address IS NOT NULL)"


@query(f"""WITH {_N}, {_L}, w AS (SELECT unnest({s_list(W.VOCABULARY)}) AS word UNION ALL SELECT x FROM (SELECT unnest({s_words('name')}) AS x FROM n UNION ALL SELECT unnest({s_words('name')}) FROM l) WHERE length(x) >= 5 UNION ALL SELECT replace(name, ' ', '') FROM l)
SELECT DISTINCT word FROM w WHERE length(word) >= 4 AND regexp_matches(word, '^[A-Za-z]+$')""")
def q51_vocabulary(s, d):
    return M.vocabulary(_names(s, d), _places(s, d))


_WRITTEN = f"r AS ({_RUNS.format(least=1, most=4)}), h AS (SELECT DISTINCT row_id, l.name FROM r JOIN l ON replace(l.name, ' ', '') = replace(r.run, ' ', '') WHERE length(l.name) >= 3 AND (r.run = l.name OR length(replace(l.name, ' ', '')) >= 8))"


@query(f"""WITH {_L}, {_T}, {_WRITTEN}, k AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM h o WHERE o.row_id = h.row_id AND length(o.name) > length(h.name) AND contains(' ' || o.name || ' ', ' ' || h.name || ' '))),
g AS (SELECT DISTINCT trim(pincode) AS pin, {s_match('locality')} AS name FROM pincode_locality_merged WHERE locality IS NOT NULL)
SELECT k.row_id, max(struct_pack(ok := g.pin IS NOT NULL, l := length(k.name), n := k.name)).n AS locality FROM k JOIN t USING (row_id) LEFT JOIN g ON g.pin = t.pin AND g.name = k.name GROUP BY k.row_id""")
def q52_best_place(s, d):
    known = pins(s, d).where("locality IS NOT NULL").select(F.trim("pincode").alias("pin"), T.match_text(F.col("locality")).alias("name"))
    return D.best_place(_texts(s, d), _places(s, d), known).select(F.col("id").alias("row_id"), F.col("name").alias("locality"))


@query(f"WITH {_L}, {_T}, {_WRITTEN} SELECT row_id, max(struct_pack(l := length(name), n := name)).n AS locality FROM h GROUP BY row_id")
def q53_longest_place(s, d):
    return D.longest_place(_texts(s, d), _places(s, d)).select(F.col("id").alias("row_id"), F.col("name").alias("locality"))


_EXACT = f"r AS ({_RUNS.format(least=2, most=10)}), e AS (SELECT row_id, max(struct_pack(k := k, l := -i, run := run)).run AS name FROM r SEMI JOIN n ON n.name = r.run WHERE length(run) >= 5 GROUP BY row_id)"
_GLUED = "g AS (SELECT t.row_id, max(struct_pack(l := length(n.name), n := n.name)).n AS name FROM (SELECT row_id, text, w, unnest(list_distinct(w)) AS word FROM t ANTI JOIN e USING (row_id)) t JOIN n ON string_split(n.name, ' ')[1] = t.word WHERE length(replace(n.name, ' ', '')) >= 10 AND contains(replace(t.text, ' ', ''), replace(n.name, ' ', '')) GROUP BY t.row_id)"


@query(f"WITH {_N}, {_T}, {_EXACT}, {_GLUED} SELECT row_id, name, 'exact' AS how FROM e UNION ALL SELECT row_id, name, 'exact' FROM g")
def q54_known_names(s, d):
    return D.known_names(_texts(s, d), _names(s, d), allow_fuzzy=False).withColumnRenamed("id", "row_id")


@query()
def q54b_known_names_fuzzy(s, d):
    """The dispatcher with its fuzzy step; the token-set score has no SQL, it is tested against brute force."""
    return D.known_names(_texts(s, d), _names(s, d)).withColumnRenamed("id", "row_id")


@query()
def q55_backfilled_names(s, d):
    """The strict fuzzy step for rows without an exact name; tested against brute force."""
    t, n = _texts(s, d), _names(s, d)
    return D.backfilled_names(t.join(D.known_names(t, n, allow_fuzzy=False), "id", "left_anti"), n).withColumnRenamed("id", "row_id")


@query(f"""WITH {_N}, {_T}, r AS ({_RUNS.format(least=1, most=10)}), e AS (SELECT row_id, max(struct_pack(k := k, l := -i, run := run)).run AS name FROM r SEMI JOIN n ON n.name = r.run WHERE row_id IN (SELECT row_id FROM t WHERE length(text) >= 5) GROUP BY row_id),
o AS (SELECT row_id, c, unnest(range(1, length(c) - 6)) AS i FROM (SELECT row_id, replace(text, ' ', '') AS c FROM t ANTI JOIN e USING (row_id) WHERE length(text) >= 5) WHERE length(c) >= 8), b AS (SELECT name, replace(name, ' ', '') AS c FROM n WHERE length(replace(name, ' ', '')) >= 8)
SELECT row_id, name, 'exact' AS how FROM e UNION ALL SELECT row_id, max(struct_pack(l := length(name), n := name)).n, 'glued' FROM o JOIN b ON substr(o.c, i, 6) = left(b.c, 6) WHERE substr(o.c, i, length(b.c)) = b.c GROUP BY row_id""")
def q56_known_buildings(s, d):
    return D.known_buildings(_texts(s, d), _names(s, d), allow_fuzzy=False).withColumnRenamed("id", "row_id")


@query()
def q57_respelt(s, d):
    """The listed spelling of typed sub-localities of a city; the score has no SQL, it is tested against brute force."""
    typed = catalogue(s, d).select(T.city_key(F.col("city")).alias("city_key"), T.match_text(F.col("sublocation")).alias("value")).where("city_key IS NOT NULL AND value <> ''")
    listed = pins(s, d).where("city IS NOT NULL AND locality IS NOT NULL").select(T.city_key(F.col("city")).alias("city_key"), T.match_text(F.col("locality")).alias("name"))
    return D.respelt(typed, listed)


_W = s_words(s_squeeze("address"))
_PHRASE_SQL = f"""list_concat(list_filter(list_transform(string_split_regex(address, '[,;]'), lambda x: trim(x, ' ,.-')), lambda x: length(x) >= 5), list_filter(list_concat(CASE WHEN len({_W}) >= 4 THEN [array_to_string({_W}[1:4], ' '), array_to_string({_W}[-4:], ' ')] ELSE [] END, CASE WHEN len({_W}) >= 3 THEN [array_to_string({_W}[1:3], ' '), array_to_string({_W}[-3:], ' ')] ELSE [] END), lambda x: length(x) >= 6))"""


@query(f"WITH p AS (SELECT row_id, {_PHRASE_SQL} AS p FROM combo_demog WHERE address IS NOT NULL) SELECT row_id, array_to_string(list_filter(p, lambda x, i: list_position(p, x) = i)[1:8], ' | ') AS phrases FROM p")
def q58_locality_phrases(s, d):
    return combo(s, d).where("address IS NOT NULL").select("row_id", F.array_join(T.locality_phrases(F.col("address")), " | ").alias("phrases"))


@query()
def q59_near_places(s, d):
    """The pin's locality that is most like a phrase of the address; the score has no SQL, it is tested against brute force."""
    t = combo(s, d).where("address IS NOT NULL").select(F.col("row_id").alias("id"), F.trim("zip").alias("pin"), T.locality_phrases(F.col("address")).alias("phrases"))
    return D.near_places(t, pins(s, d).where("locality IS NOT NULL").select(F.trim("pincode").alias("pin"), F.trim("locality").alias("name"))).withColumnRenamed("id", "row_id")


@query(f"WITH {_STATES} SELECT row_id, {s_state('state_code')} AS own_state, coalesce(state, '{W.DEFAULT_STATE}') AS by_pin, {s_evidence('state_code', 'state')} AS evidence FROM combo_demog LEFT JOIN st ON pin = trim(zip)")
def q60_states(s, d):
    r = combo(s, d).select("row_id", "state_code", F.trim("zip").alias("pin")).join(pin_states(s, d), "pin", "left")
    return r.select("row_id", T.state_name(F.col("state_code")).alias("own_state"), F.coalesce("state", F.lit(W.DEFAULT_STATE)).alias("by_pin"), T.state_evidence(F.col("state_code"), F.col("state")).alias("evidence"))


@query(f"WITH {_PIN_CITY}, {_STATES} SELECT count(*) AS rows, count(*) FILTER (pin_city IS NOT NULL) AS in_list, count(*) FILTER ({s_evidence('state_code', 'state')} = 1) AS state_agrees, count(*) FILTER ({s_evidence('state_code', 'state')} = -1) AS state_differs FROM combo_demog LEFT JOIN pin ON pin.pin = trim(zip) LEFT JOIN st ON st.pin = trim(zip)")
def q61_state_counters(s, d):
    r = combo(s, d).select("state_code", F.trim("zip").alias("pin")).join(pin_states(s, d), "pin", "left").join(F.broadcast(pin_city(s, d)), "pin", "left").withColumn("e", T.state_evidence(F.col("state_code"), F.col("state")))
    return r.agg(F.count("*").alias("rows"), F.count("pin_city").alias("in_list"), F.count_if(F.col("e") == 1).alias("state_agrees"), F.count_if(F.col("e") == -1).alias("state_differs"))


_TITLE_L = f"array_to_string(list_transform({s_words(s_squeeze('locality'))}, lambda w: CASE WHEN lower(w) <> upper(w) AND w = lower(w) THEN upper(left(w, 1)) || lower(substr(w, 2)) ELSE w END), ' ')"


@query(f"SELECT row_id, parsed_at, {s_title_building('building_name')} AS building_name, {_TITLE_L} AS locality FROM combo_demog_parsed")
def q62_titles(s, d):
    return parsed(s, d).select("row_id", "parsed_at", T.title_building(F.col("building_name")).alias("building_name"), T.title_locality(F.col("locality")).alias("locality"))


_STOPS = ["upper(trim(city))", "upper(trim(district))", *(f"'{x}'" for x in W.LANDMARK_STOPS)]
_UPTO = "trim(substr(long, 1, coalesce(least(" + ", ".join(f"CASE WHEN length({x}) > 0 AND position({x} IN upper(long)) > 6 THEN position({x} IN upper(long)) END" for x in _STOPS) + ") - 1, length(long))), ' ,.-')"


@query(f"WITH p AS (SELECT *, landmark || ' ' || coalesce(city, 'India') AS long FROM combo_demog_parsed) SELECT row_id, parsed_at, CASE WHEN length(trim(long)) > 0 THEN CASE WHEN length({_UPTO}) >= 3 THEN {_UPTO} ELSE long END END AS landmark FROM p")
def q63_trim_landmark(s, d):
    long = F.concat("landmark", F.lit(" "), F.coalesce("city", F.lit("India")))
    return parsed(s, d).select("row_id", "parsed_at", T.trim_landmark(long, F.col("city"), F.col("district")).alias("landmark"))


@query(f"WITH {_L}, b AS (SELECT unnest({s_list(W.COMMON_LOCALITIES)}) AS name UNION SELECT name FROM l WHERE len({s_words('name')}) <= 2 AND length(name) >= 4) SELECT row_id, parsed_at, coalesce({s_norm('building_name')} = {s_norm('p.locality')}, false) OR list_contains({s_list(W.COMMON_LOCALITIES)}, {s_norm('building_name')}) OR (b.name IS NOT NULL AND len({s_words(s_norm('building_name'))}) <= 2) AS locality_like FROM combo_demog_parsed p LEFT JOIN b ON b.name = {s_norm('building_name')} WHERE building_name IS NOT NULL")
def q64_locality_like(s, d):
    block = D.common_localities(_places(s, d)).withColumn("listed", F.lit(True))
    p = parsed(s, d).where("building_name IS NOT NULL").withColumn("name", T.norm_name(F.col("building_name"))).join(block, "name", "left")
    return p.select("row_id", "parsed_at", X.locality_like(F.col("building_name"), F.col("locality"), F.col("listed")).alias("locality_like"))


@query(f"WITH b AS (SELECT DISTINCT projectname AS name FROM dotcom_catalogue WHERE projectname IS NOT NULL) SELECT row_id, parsed_at, CASE WHEN name IS NOT NULL THEN 'Yes' ELSE 'No' END AS flag FROM combo_demog_parsed LEFT JOIN b ON name = building_name")
def q65_whole_flags(s, d):
    return D.whole_flags(parsed(s, d), catalogue(s, d).select(F.col("projectname").alias("name")), "building_name", "flag").select("row_id", "parsed_at", "flag")


def s_office(x: str) -> str:
    return s_match(rf"regexp_replace(regexp_replace({x}, '\([^)]*\)', ' ', 'g'), '(?i)\b[SBHG]\.? ?[OP]\.? *$|\bG\.P\.O\.?', ' ', 'g')")


@query(f"SELECT coalesce(pincode_source, 'none') AS pincode_source, count(*) AS rows, count(DISTINCT (coalesce({s_city('city')}, '-'), coalesce({s_office('sublocation')}, '-'))) AS pairs FROM dotcom_catalogue GROUP BY 1")
def q66_pair_stats(s, d):
    return B.pair_stats(catalogue(s, d))


@query("SELECT source, level, count(*) AS n FROM pincode_locality_merged GROUP BY 1, 2")
def q67_merge_stats(s, d):
    return B.merge_stats(pins(s, d), "level")


_MATCHED = "SELECT row_id, rule, address, zip, building_name, locality, city FROM (SELECT *, lower(trim(dotcom_match_rule)) AS rule, row_number() OVER (PARTITION BY row_id ORDER BY parsed_at) AS i, count(*) OVER (PARTITION BY row_id) AS c FROM combo_demog_parsed WHERE dotcom_matched = 'Yes') WHERE c = 1"


@query(f"SELECT rule AS dotcom_match_rule, row_id, building_name, '' AS verdict FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY md5('20260923|' || row_id)) AS i FROM ({_MATCHED})) WHERE i <= 50")
def q68_review_sample(s, d):
    once = parsed(s, d).where("dotcom_matched = 'Yes'").groupBy("row_id").count().where("count = 1").select("row_id")
    return B.review_sample(parsed(s, d).join(once, "row_id", "left_semi")).select("dotcom_match_rule", "row_id", "building_name", "verdict")


@query("SELECT verdict, count(*) AS n FROM (SELECT lower(trim(v)) AS verdict FROM (SELECT CASE row_id % 5 WHEN 0 THEN ' Correct' WHEN 1 THEN 'WRONG' WHEN 2 THEN 'unsure ' WHEN 3 THEN 'maybe' END AS v FROM combo_demog_parsed)) WHERE verdict IN ('correct', 'wrong', 'unsure') GROUP BY 1")
def q69_reviewed(s, d):
    r = F.col("row_id") % 5
    return B.reviewed(parsed(s, d).withColumn("verdict", F.when(r == 0, " Correct").when(r == 1, "WRONG").when(r == 2, "unsure ").when(r == 3, "maybe"))).groupBy("verdict").agg(F.count("*").alias("n"))


_STREETLESS = f"len({s_words('l.name')}) >= 2 AND NOT list_has_any({s_words('l.name')}, {s_list(W.STREET_TOKENS)}) AND NOT list_contains({s_list(W.COMMON_LOCALITIES)}, l.name)"


@query(f"WITH {_L}, {_T}, r AS ({_RUNS.format(least=1, most=4)}) SELECT row_id, max(struct_pack(l := length(l.name), n := l.name)).n AS name FROM r JOIN l ON replace(l.name, ' ', '') = replace(r.run, ' ', '') WHERE (r.run = l.name OR length(replace(l.name, ' ', '')) >= 10) AND {_STREETLESS} GROUP BY row_id")
def q70_named_area(s, d):
    """The longest listed place in an address, as a building of last resort; blocked are the fixed common names only, since every place of this list has two words."""
    t = _texts(s, d).select("id", "text", F.lit(None).cast("string").alias("locality"))
    return D.named_area(t, _places(s, d), s.createDataFrame([(x,) for x in W.COMMON_LOCALITIES], "name string")).withColumnRenamed("id", "row_id")


@query()
def q71_audit(s, d):
    """Two hundred rows before and after the cleaning; the order is a hash that SQL doesn't have."""
    return B.audit_sample(combo(s, d), 200)


@query()
def q72_catalogue_pins(s, d):
    """Every catalogue row with the pin found for its pair of city and sub-locality; the steps are tested on a fixture."""
    learned = parsed(s, d).where("locality IS NOT NULL AND zip IS NOT NULL").groupBy(B.office_key(F.col("locality")).alias("sub"), F.trim("zip").alias("pin")).agg(F.count("*").alias("n"))
    found = B.catalogue_pins(catalogue(s, d), s.read.parquet(f"{d}/pincodes.parquet"), learned)
    return B.with_pins(catalogue(s, d), found).select("rec_id", "pincode", "all_pincodes", "pincode_source", "pincode_confidence")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
