"""Filter chains that also count the rows left after each step."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.functions.numbers import percent

Stage = tuple[str, Column]


def _cumulative(stages: Sequence[Stage]) -> list[Stage]:
    """Each stage with the conjunction of all conditions up to it; NULL counts as failed."""
    conditions = [F.coalesce(cond, F.lit(False)) for _, cond in stages]
    return [(name, reduce(and_, conditions[: i + 1])) for i, (name, _) in enumerate(stages)]


def apply_stages(df: DataFrame, stages: Sequence[Stage], observation: Observation | None = None) -> DataFrame:
    """Keep the rows that pass every stage.

    With an ``observation`` the counts per stage are gathered by whatever action
    reads the result, instead of by one count per stage.
    """
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            *[F.count_if(cond).alias(name) for name, cond in _cumulative(stages)],
        )
    return df.filter(reduce(and_, [cond for _, cond in stages]))


def stage_counts(df: DataFrame, stages: Sequence[Stage], keys: Sequence[Column]) -> DataFrame:
    """Rows after each stage and after key dedupe, removed rows and retained percent, from one scan.

    Columns: ``step`` (0 = input), ``stage``, ``rows_left``, ``rows_removed``, ``retained_pct``.
    """
    passed = _cumulative(stages)
    all_passed = passed[-1][1]
    totals = df.agg(
        F.count(F.lit(1)).alias("input"),
        *[F.count_if(cond).alias(name) for name, cond in passed],
        F.count_distinct(F.when(all_passed, F.struct(*keys))).alias("after_dedupe"),
    )
    names = ["input", *[name for name, _ in stages], "after_dedupe"]
    lines = F.array(*[
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(name).alias("rows_left"),
            (F.col(names[max(i - 1, 0)]) - F.col(name)).alias("rows_removed"),
            percent(F.col(name), F.col("input"), 2).alias("retained_pct"),
        )
        for i, name in enumerate(names)
    ])
    return totals.select(F.inline(lines))
