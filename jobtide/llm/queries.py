"""Registered queries of the text operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobtide.llm.dac import op8_token_files
from jobtide.llm.decontaminate import SQL as BENCHMARK_SQL
from jobtide.llm.decontaminate import op1_decontaminate
from jobtide.llm.extract import op10_main_text
from jobtide.llm.infill import SQL as INFILL_SQL
from jobtide.llm.infill import op13_infill
from jobtide.llm.language import op2_language
from jobtide.llm.near import op7_near_duplicates
from jobtide.llm.packing import op5_packing
from jobtide.llm.pii import op4_pii
from jobtide.llm.resampling import SQL as RESAMPLING_SQL
from jobtide.llm.resampling import op12_resampling
from jobtide.llm.sharding import op6_sharding
from jobtide.llm.spotsigs import SQL as SPOT_SQL
from jobtide.llm.spotsigs import op3_spotsigs
from jobtide.llm.toxicity import op11_toxicity
from jobtide.llm.urls import SQL as URL_SQL
from jobtide.llm.urls import op9_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language": op2_language,
    "op3_spotsigs": op3_spotsigs,
    "op4_pii": op4_pii,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_token_files": op8_token_files,
    "op9_urls": op9_urls,
    "op10_main_text": op10_main_text,
    "op11_toxicity": op11_toxicity,
    "op12_resampling": op12_resampling,
    "op13_infill": op13_infill,
}

ORACLE: dict[str, str] = {
    "op1_decontaminate": BENCHMARK_SQL,
    "op3_spotsigs": SPOT_SQL,
    "op9_urls": URL_SQL,
    "op12_resampling": RESAMPLING_SQL,
    "op13_infill": INFILL_SQL,
}
