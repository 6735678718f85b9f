"""The order of events: what follows what, and which steps are not allowed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.operators.scans import in_ranges, running


def steps(events: DataFrame, line: str, order: list[str], state: str, keep: list[str], ranges: int | None = None) -> DataFrame:
    """Each event with the event before it on its line: the columns line, order, state, keep and their values before.

    ``order`` tells the events of a line apart. The first event of a line has NULLs before. Events of one line may be any
    number: they are cut into ranges, see ``scans``. Events without line, order or state are left out.
    """
    columns = [*dict.fromkeys([line, *order, state, *keep])]
    rows = events.select(*columns).where(F.col(state).isNotNull())
    rows = rows.withColumn("_event", F.struct(*[c for c in columns if c != line]))
    found = running(in_ranges(rows, [line], order, ranges), [line], order, previous={"_before": "_event"})
    return found.select(*columns, *[F.col(f"_before.{c}").alias(f"previous_{c}") for c in columns if c != line])


def _pairs(stepped: DataFrame, allowed: list[tuple], state: str) -> DataFrame:
    """The allowed transitions as rows; a first state is allowed after None."""
    kind = stepped.schema[state].dataType.simpleString()
    return stepped.sparkSession.createDataFrame(allowed, f"previous_{state} {kind}, {state} {kind}")


def illegal_steps(stepped: DataFrame, allowed: list[tuple], state: str) -> DataFrame:
    """The rows of ``steps`` whose pair (state before, state) is not in ``allowed``, with both events.

    ``allowed`` is an argument, so its size is known; (None, s) allows s as the first state of a line.
    """
    pairs = _pairs(stepped, allowed, state).distinct()
    before = f"previous_{state}"
    same = stepped[before].eqNullSafe(pairs[before]) & (stepped[state] == pairs[state])
    return stepped.join(F.broadcast(pairs), same, "left_anti")


def transition_counts(stepped: DataFrame, allowed: list[tuple], state: str) -> DataFrame:
    """(state before, state, step_count, legal), one row per pair that occurs. NULL before marks the first of a line."""
    pairs = _pairs(stepped, allowed, state).distinct().toDF("_a", "_b").withColumn("_known", F.lit(True))
    before = f"previous_{state}"
    counts = stepped.groupBy(before, state).agg(F.count(F.lit(1)).alias("step_count"))
    joined = counts.join(F.broadcast(pairs), F.col(before).eqNullSafe(F.col("_a")) & (F.col(state) == F.col("_b")), "left")
    return joined.select(before, state, "step_count", F.coalesce("_known", F.lit(False)).alias("legal"))
