"""The queries of this subpackage, one for each operator, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchday.llm import (
    chat_format, collocations, decontaminate, html_text, jaccard_join, pseudonyms, quality, secret_scan, sentencepiece_stream,
    substring_dedup, target_resample, token_records, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_token_records": token_records.op5_token_records,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_html_text": html_text.op7_html_text,
    "op8_sentencepiece": sentencepiece_stream.op8_sentencepiece,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_pseudonyms": pseudonyms.op10_pseudonyms,
    "op11_target_resample": target_resample.op11_target_resample,
    "op12_chat_format": chat_format.op12_chat_format,
    "op13_collocations": collocations.op13_collocations,
}
ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": url_filter.ORACLE_SQL,
    "op2_secret_scan": secret_scan.ORACLE_SQL,
    "op4_substring_dedup": substring_dedup.ORACLE_SQL,
    "op6_quality_rules": quality.ORACLE_SQL,
    "op11_target_resample": target_resample.ORACLE_SQL,
    "op12_chat_format": chat_format.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
