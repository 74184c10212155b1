"""Attempts at a micro-batch: a stored ledger of failures, back-off, and the rows that make a batch fail.

A batch that fails is tried again, later each time. Failures are stored, so a restarted job goes on
counting. After the last attempt the batch is halved by a hash of its rows, again and again on the failing
halves only, until the rows that raise stand alone; the rest is processed, and the policy says what becomes
of them: 'dlq' sends them to the dead letters, 'continue' leaves them out, 'fail' ends the job. Where no
half fails, rows are not the cause and the job ends.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from crmflow.session import reliable
from crmflow.sources.generations import Generations
from crmflow.sources.writers import FAILURE_POLICIES

# Attempts and seconds before the second one.
MAX_ATTEMPTS, RETRY_SECONDS = 3, 5.0
_PART = "__part"

Work = Callable[[DataFrame, int], None]
FAILURES = (PySparkException, Py4JJavaError)


@dataclass
class Attempts:
    spark: SparkSession
    path: str
    attempts: int = MAX_ATTEMPTS
    delay: float = RETRY_SECONDS
    policy: str = "dlq"
    sleep: Callable[[float], None] = time.sleep

    def __post_init__(self):
        if self.policy not in FAILURE_POLICIES:
            raise ValueError(f"unknown policy {self.policy}")
        self._ledger = Generations(self.spark, self.path)

    def failures(self, source: str, batch_id: int) -> list[dict]:
        """What went wrong with a batch so far, oldest first."""
        return ((self._ledger.current()[1] or {}).get("failures") or {}).get(f"{source}/{batch_id}", [])

    def _failed(self, source: str, batch_id: int, error: Exception) -> int:
        entry = {"at": time.time(), "error": reason(error)[:500]}

        def added(content):
            failures = (content or {}).get("failures", {})
            own = failures.get(f"{source}/{batch_id}", [])
            return {"failures": {**failures, f"{source}/{batch_id}": [*own, entry]}}

        stored = self._ledger.update(added)
        self._ledger.clean(lambda _: (), "_none")
        return len(stored["failures"][f"{source}/{batch_id}"])

    def run(self, work: Work, probe: Callable[[DataFrame], None], reject: Callable[[DataFrame, int], None],
            batch: DataFrame, batch_id: int, source: str = "") -> None:
        """``work`` on the batch. ``probe`` evaluates rows without storing anything; ``reject`` stores letters.

        ``work`` must replace what an earlier try of the same batch wrote.
        """
        failed, last = len(self.failures(source, batch_id)), None
        while failed < self.attempts:
            try:
                work(batch, batch_id)
                return
            except FAILURES as error:
                failed = self._failed(source, batch_id, error)
                if failed < self.attempts:
                    self.sleep(self.delay * 2 ** (failed - 1))
                last = error
        if self.policy == "fail":
            raise RuntimeError(f"batch {batch_id} failed {failed} times") from last
        rows = reliable(batch.withColumn(_PART, row_hash(batch)))
        poison = isolate(rows, lambda part: probe(part.drop(_PART)))
        if poison is None:
            raise RuntimeError(f"batch {batch_id} failed {failed} times, and no row of it alone is the cause") from last
        poison = reliable(poison)
        work(rows.join(poison.select(_PART).distinct(), _PART, "left_anti").drop(_PART), batch_id)
        if self.policy == "dlq":
            reject(poison.drop(_PART), batch_id)


def reason(error: Exception) -> str:
    """The first line of what went wrong at the bottom of a chain of causes."""
    text = str(error)
    cause = getattr(error, "java_exception", None)
    while cause is not None:
        text, cause = cause.toString(), cause.getCause()
    return (text.strip().splitlines() or [type(error).__name__])[0]


def row_hash(df: DataFrame):
    """A hash of the row's plain columns; maps go by their entries."""
    return F.xxhash64(*[
        F.to_json(c) if df.schema[c].dataType.typeName() in ("map", "struct", "array") else F.col(c) for c in df.columns])


def isolate(rows: DataFrame, probe: Callable[[DataFrame], None]) -> DataFrame | None:
    """Rows that fail alone, by halving on the bits of ``__part``; None if the whole does not fail.

    Of a failing part the first half is probed, and the second only if the first fails too: else the second must
    hold the cause. So one poison row costs a probe a level, each over half the rows of the one before. Rows of one
    hash stay together, and rows that fail only together go together. Needs rows at rest.
    """
    if not _fails(rows, probe):
        return None
    total = rows.count()
    parts, found = [F.lit(True)], []
    for bit in range(64):
        failing = []
        for part in parts:
            # From the level on where parts are about one row, see whether there is anything to halve.
            if 2 ** (bit + 2) >= total and rows.where(part).select(_PART).distinct().limit(2).count() < 2:
                found.append(part)
                continue
            ones = F.shiftrightunsigned(_PART, bit).bitwiseAND(F.lit(1)) == 1
            first, second = part & ~ones, part & ones
            if not _fails(rows.where(first), probe):
                failing.append(second)
            elif _fails(rows.where(second), probe):
                failing += [first, second]
            else:
                failing.append(first)
        parts = failing
    alone = [part for part in found + parts if _fails(rows.where(part), probe)]
    if not alone:
        return rows.where(found[0] if found else parts[0])
    chosen = alone[0]
    for part in alone[1:]:
        chosen = chosen | part
    return rows.where(chosen)


def _fails(rows: DataFrame, probe: Callable[[DataFrame], None]) -> bool:
    try:
        probe(rows)
    except FAILURES:
        return True
    return False
