"""Batch ingest of extract responses: read, validate, encode, check the error share, append."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from crmflow.functions.values import encode_nested
from crmflow.operators.quality import require_threshold, validate_batch
from crmflow.registry import OBJECTS, sink_schema, table_path
from crmflow.sources.readers import read_envelopes
from crmflow.sources.writers import append_raw


def ingest(
    spark: SparkSession,
    responses: dict[str, str],
    base: str,
    at: Column,
    enabled: Iterable[str] | None = None,
    rules=None,
    max_error_percent: float | None = None,
    multi_line: bool = True,
    disposition: str = "WRITE_APPEND",
    on_bad: str = "dlq",
) -> list[str]:
    """Append the responses (object name -> path) to their raw tables; returns the tables written.

    Invalid rows are kept and marked. With ``max_error_percent`` an object above it stops the run
    before anything of that object is visible; the share is taken from the staged rows, so a response is read once.
    """
    written = []
    for name, path in responses.items():
        if enabled is not None and name not in set(enabled):
            continue
        records = read_envelopes(spark, path, name, at, multi_line=multi_line)
        checked = validate_batch(records, at, rules=rules)
        gate = None if max_error_percent is None else partial(_gate, max_error_percent)
        rows = encode_nested(checked, skip=["_validation_errors"])
        out = table_path(base, name)
        append_raw(rows, out, sink_schema(name), OBJECTS[name].cluster_by, disposition, on_bad, audit=gate)
        written.append(out)
    return written


def _gate(max_error_percent: float, staged: DataFrame) -> None:
    require_threshold(staged.withColumnRenamed("_is_valid", "is_valid"), max_error_percent)
