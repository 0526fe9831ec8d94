"""The three shapes all checks are made of, and the suite that runs many checks in one scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.joins import with_one_row
from siltstone.operators.project import row_condition as keep

Expr = str | Column


def as_expr(e: Expr) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def as_value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def expression_is_true(
    df: DataFrame, expression: Expr, test_condition: str | None = None,
    group_by: Sequence[str] | None = None, row_condition: Expr | None = None, aggregate: bool = False,
) -> DataFrame:
    """Rows (or groups) for which the expression is false; unknown counts as true.

    ``test_condition`` is put behind the expression, for instance ``"> 10"``.
    """
    rows = keep(df, row_condition)
    if not (aggregate or group_by):
        if test_condition:
            return rows.withColumn("_e", as_expr(expression)).where(f"not (_e {test_condition})").drop("_e")
        return rows.where(~as_expr(expression))
    grouped = rows.groupBy(*(group_by or [])).agg(as_expr(expression).alias("expression"))
    return grouped.where(f"not (expression {test_condition or '= true'})")


def between(value: Column, low=None, high=None, strictly: bool = False) -> Column:
    if low is None and high is None:
        raise ValueError("give a lower bound, an upper bound or both")
    tests = []
    if low is not None:
        tests.append(value > as_value(low) if strictly else value >= as_value(low))
    if high is not None:
        tests.append(value < as_value(high) if strictly else value <= as_value(high))
    return reduce(lambda a, b: a & b, tests)


def expression_between(
    df: DataFrame, expression: Expr, min_value=None, max_value=None, group_by: Sequence[str] | None = None,
    row_condition: Expr | None = None, strictly: bool = False, aggregate: bool = False,
) -> DataFrame:
    """Rows (or groups, with the observed value) whose expression is outside the bounds."""
    rows = keep(df, row_condition)
    if not (aggregate or group_by):
        return rows.where(~between(as_expr(expression), min_value, max_value, strictly))
    observed = rows.groupBy(*(group_by or [])).agg(as_expr(expression).alias("observed"))
    return outside(observed, min_value, max_value, strictly)


def outside(observed: DataFrame, low=None, high=None, strictly: bool = False) -> DataFrame:
    return observed.where(~between(F.col("observed"), low, high, strictly))


def equal_expression(
    df: DataFrame, expression: Expr, compare: DataFrame | None = None, compare_expression: Expr | None = None,
    group_by: Sequence[str] | None = None, compare_group_by: Sequence[str] | None = None,
    row_condition: Expr | None = None, compare_row_condition: Expr | None = None,
    tolerance: float = 0.0, tolerance_percent: float | None = None,
) -> DataFrame:
    """Groups whose aggregate differs between two tables by more than the tolerance."""
    other = df if compare is None else compare
    by = list(group_by or [])
    other_by = list(compare_group_by or by)
    condition = row_condition if compare_row_condition is None else compare_row_condition
    a = keep(df, row_condition).groupBy(*by).agg(as_expr(expression).alias("expression"))
    b = keep(other, condition).groupBy(*[F.col(o).alias(g) for g, o in zip(by, other_by, strict=True)]).agg(
        as_expr(expression if compare_expression is None else compare_expression).alias("compare_expression")
    )
    both = a.join(b, by, "full") if by else with_one_row(a, b)
    mine, theirs = F.col("expression"), F.col("compare_expression")
    gap = F.abs(F.coalesce(mine, F.lit(0)) - F.coalesce(theirs, F.lit(0)))
    measured = both.withColumns({
        "expression_difference": gap,
        "expression_difference_percent": F.try_divide(gap.cast("double"), mine.cast("double")),
    })
    if tolerance_percent:
        return measured.where(F.col("expression_difference_percent") > tolerance_percent)
    return measured.where(F.col("expression_difference") > tolerance)


@dataclass(frozen=True)
class Check:
    """One entry of a suite.

    ``row`` is a predicate every row must meet, ``measure`` a single aggregate
    call as SQL text with the condition ``holds`` on its value; both are folded
    into one aggregate over the table.  ``frame`` is a ready frame of failures.
    """

    name: str
    row: Expr | None = None
    measure: str | None = None
    holds: Callable[[Column], Column] | None = None
    where: str | None = None
    frame: DataFrame | None = None
    fail_calc: str = "count(*)"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"

    def status(self) -> Column:
        return (
            F.when(F.expr(f"failures {self.error_if}"), "error")
            .when(F.expr(f"failures {self.warn_if}"), "warn").otherwise("pass")
        )


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, failures, status) for every check; row and aggregate checks share one scan."""
    shared = [c for c in checks if c.frame is None]
    parts: list[DataFrame] = []
    if shared:
        measures = []
        for i, c in enumerate(shared):
            if c.measure is not None:
                call = f"{c.measure} filter (where {c.where})" if c.where else c.measure
                measures.append(F.expr(call).alias(f"_{i}"))
            else:
                failed = ~as_expr(c.row)
                measures.append(F.count_if(failed & F.expr(c.where) if c.where else failed).alias(f"_{i}"))
        counts = [
            F.coalesce((~c.holds(F.col(f"_{i}"))).cast("bigint"), F.lit(0).cast("bigint"))
            if c.measure is not None else F.col(f"_{i}")
            for i, c in enumerate(shared)
        ]
        rows = [F.struct(F.lit(c.name).alias("check"), n.alias("failures")) for c, n in zip(shared, counts, strict=True)]
        parts.append(df.agg(*measures).select(F.inline(F.array(*rows))))
    for c in checks:
        if c.frame is not None:
            n = F.coalesce(F.expr(c.fail_calc).cast("bigint"), F.lit(0).cast("bigint"))
            parts.append(c.frame.agg(n.alias("failures")).select(F.lit(c.name).alias("check"), "failures"))
    result = reduce(lambda a, b: a.unionByName(b), parts)
    verdict = reduce(
        lambda acc, c: acc.when(F.col("check") == c.name, c.status()), checks, F.when(F.lit(False), F.lit(""))
    )
    return result.withColumn("status", verdict)


def enforce(summary: DataFrame) -> None:
    """Raise when a check of the summary is in error."""
    broken = summary.where("status = 'error'").collect()  # at most one row per check
    if broken:
        raise AssertionError("; ".join(f"{r['check']}: {r['failures']}" for r in broken))
