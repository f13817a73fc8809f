"""Trace logs: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The fields of a trace line.
TRACE_SCHEMA = """
    event string, timestamp timestamp, question string, contract string, model string,
    stop_reason string, latency_ms bigint, tool string, sql string,
    raw_args map<string,string>, rows bigint, data array<map<string,string>>,
    lineage_source array<string>
"""

# The same with result records of any depth, whose values keep their types.
TYPED_TRACE_SCHEMA = TRACE_SCHEMA.replace("array<map<string,string>>", "variant")


def read_trace(spark: SparkSession, path: str, schema: str = TRACE_SCHEMA) -> DataFrame:
    """Trace lines under an explicit schema, so that no pass is spent on inferring one."""
    return spark.read.schema(schema).json(path)
