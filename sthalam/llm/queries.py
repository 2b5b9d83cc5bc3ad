"""Queries of this folder's operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sthalam.llm.address_parts import Gazetteer, gazetteer
from sthalam.llm.canonical import map_localities, unmatched_values
from sthalam.llm.linkage import collective_links
from sthalam.llm.packing import fill_containers, fill_report
from sthalam.llm.pair_bpe import encode_corpus
from sthalam.llm.pii_crf import personal_spans
from sthalam.llm.proportions import Proportioned, latest_rules
from sthalam.llm.same_place import same_doors
from sthalam.llm.truncation import truncated, truncation_report
from sthalam.session import spread, table

CAPACITY = 2048


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return personal_spans(spread(table(spark, folder, "combo_demog"))).select("row_id", "kind").distinct()


def p1_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return personal_spans(spread(table(spark, folder, "combo_demog")), redact=True)


def _proportioned(spark: SparkSession, folder: str) -> Proportioned:
    return Proportioned(latest_rules(table(spark, folder, "combo_demog_parsed")), table(spark, folder, "sample_targets"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _proportioned(spark, folder).report().where("short").select("match_rule")


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    return _proportioned(spark, folder).report()


def p2_sample(spark: SparkSession, folder: str) -> DataFrame:
    return _proportioned(spark, folder).sample()


def _lists(spark: SparkSession, folder: str) -> Gazetteer:
    return gazetteer(table(spark, folder, "pincode_locality_merged"), table(spark, folder, "dotcom_catalogue"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_doors(spread(table(spark, folder, "combo_demog")), _lists(spark, folder)).select("row_id_a", "row_id_b")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return map_localities(table(spark, folder, "dotcom_catalogue"), table(spark, folder, "pincode_locality_merged")).select("rec_id", "locality_id")


def p5_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return unmatched_values(table(spark, folder, "dotcom_catalogue"), p5_found(spark, folder))


def p6_links(spark: SparkSession, folder: str) -> DataFrame:
    return collective_links(spread(table(spark, folder, "combo_demog")), table(spark, folder, "dotcom_catalogue"), p5_found(spark, folder), _lists(spark, folder))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_links(spark, folder).select("row_id", "rec_id")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(spread(table(spark, folder, "documents")))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    sizes = encode_corpus(spread(table(spark, folder, "documents")), out="n_tokens", lengths_only=True)
    return fill_containers(sizes, capacity=CAPACITY)


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return fill_report(p8_containers(spark, folder), CAPACITY)


_P2 = """
WITH last AS (SELECT row_id, max(struct_pack(k := parsed_at IS NOT NULL, t := parsed_at, r := coalesce(nullif(lower(trim(dotcom_match_rule)), ''), 'unmatched'))).r AS r FROM combo_demog_parsed WHERE row_id IS NOT NULL GROUP BY row_id),
size AS (SELECT count(*) // 10 AS n FROM last), have AS (SELECT r, count(*) AS available FROM last GROUP BY r),
need AS (SELECT match_rule, target_share, min_rows, greatest(min_rows, CAST(ceil(CAST(target_share AS DECIMAL(18, 9)) * n) AS BIGINT)) AS needed, coalesce(available, 0) AS available FROM sample_targets CROSS JOIN size LEFT JOIN have ON r = match_rule)
"""
P2_SQL = _P2 + "SELECT match_rule FROM need WHERE available < needed"
P2_REPORT_SQL = _P2 + "SELECT match_rule, target_share, min_rows, needed, available, least(available, needed) AS selected, available < needed AS short FROM need"


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncated(spread(table(spark, folder, "documents"))).where("truncated").select("doc_id")


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    return truncation_report(truncated(spread(table(spark, folder, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_redacted": p1_redacted, "p2_found": p2_found, "p2_report": p2_report, "p2_sample": p2_sample, "p3_found": p3_found, "p5_found": p5_found, "p5_unmatched": p5_unmatched, "p6_found": p6_found, "p6_links": p6_links, "p7_ids": p7_ids, "p8_containers": p8_containers, "p8_report": p8_report, "p9_found": p9_found, "p9_report": p9_report}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_SQL, "p2_report": P2_REPORT_SQL}
