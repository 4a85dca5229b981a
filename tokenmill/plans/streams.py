"""Checkable streaming queries (M1, M2): the stream result against its batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.config import EOT_TEXT, HEADER_END_TEXT, HEADER_START_TEXT
from tokenmill.functions.arrays import join_tokens
from tokenmill.functions.text import word_pattern
from tokenmill.operators import chat as C
from tokenmill.plans.registry import register
from tokenmill.streaming import jobs

TRX = word_pattern(C.DEFAULT_TEMPLATE.specials)

STREAM_ENCODE_SQL = f"""
SELECT conv_id, turn, role, CAST(len(a) AS BIGINT) AS n_tokens, array_to_string(a, ' ') AS tokens
FROM (SELECT conv_id, turn, role, ['{HEADER_START_TEXT}', role, '{HEADER_END_TEXT}']
             || regexp_extract_all(text, '{TRX}') || ['{EOT_TEXT}'] AS a FROM conversations)
"""


@register("stream_encode", "M1 (availableNow stream == batch)", STREAM_ENCODE_SQL)
def stream_encode(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.stream_encode(spark, sf, glob="conversations.parquet")
    return out.select("conv_id", "turn", "role", "n_tokens", join_tokens("toks").alias("tokens"))


STREAM_LOG_SQL = """
SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, event_type AS run,
       round(avg(value / 100), 6) AS mean_value, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2
"""


@register("stream_run_log", "M2 (watermark + tumbling window)", STREAM_LOG_SQL)
def stream_run_log(spark: SparkSession, sf: str) -> DataFrame:
    # complete mode: the snapshot of every window, comparable with the batch SQL
    out = jobs.stream_run_log(spark, sf, glob="events.parquet", mode="complete")
    return out.select("window_start", "run", F.round("mean_value", 6).alias("mean_value"), "n")


@register("stream_run_log_append", "M2 (append: windows that the watermark has passed)", """
WITH w AS (SELECT date_trunc('day', ts) AS d, event_type AS run, avg(value / 100) AS m, count(*) AS n
           FROM events GROUP BY 1, 2), t AS (SELECT max(ts) AS last FROM events)
SELECT CAST(epoch(d) AS BIGINT) AS window_start, run, round(m, 6) AS mean_value, CAST(n AS BIGINT) AS n
FROM w, t WHERE d + INTERVAL 1 DAY <= date_trunc('second', last) - INTERVAL 1 HOUR
""")
def stream_run_log_append(spark: SparkSession, sf: str) -> DataFrame:
    out = jobs.stream_run_log(spark, sf, glob="events.parquet")
    return out.select("window_start", "run", F.round("mean_value", 6).alias("mean_value"), "n")
