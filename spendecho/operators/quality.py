"""Declared data checks and the build-blocking suite."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions import ratio
from ..schemas import PRECISION_GATE
from ..sources.observed import observed
from .joins import orphans


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str  # not_null, unique, accepted_values, between, length_between, relationship
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    where: str | None = None
    parent: str | None = None
    parent_column: str | None = None


class QualityError(RuntimeError):
    """A declared check failed; the message lists the failures."""


def _literal(value) -> str:
    return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def failure_sql(check: Check) -> str:
    """The condition of a failing row. NULL passes every kind but not_null."""
    c = f"`{check.column}`"
    if check.kind == "not_null":
        return f"{c} IS NULL"
    if check.kind == "accepted_values":
        failed = f"{c} NOT IN ({', '.join(_literal(v) for v in check.values)})"
    elif check.kind == "between":
        failed = f"{c} NOT BETWEEN {check.low} AND {check.high}"
    elif check.kind == "length_between":
        failed = f"length({c}) NOT BETWEEN {check.low} AND {check.high}"
    else:
        raise ValueError(check.kind)
    return f"({check.where}) AND {failed}" if check.where else failed


def _report_rows(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check from a single row of counters n0, n1, ..."""
    rows = ", ".join(
        f"named_struct('table_name', '{c.table}', 'column_name', '{c.column}', "
        f"'check_name', '{c.kind}', 'n_failed', CAST(n{i} AS BIGINT))"
        for i, c in enumerate(checks)
    )
    return counts.selectExpr(f"inline(array({rows}))")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    return df.filter(failure_sql(check))


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, NULLs ignored."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks of a table in one pass over its columns."""
    counters = [F.expr(f"count_if({failure_sql(c)}) AS n{i}") for i, c in enumerate(checks)]
    return _report_rows(df.agg(*counters), checks)


WHOLE_TABLE = ("unique", "relationship")  # kinds that need more than one row at a time


class Watch:
    """Row checks counted by the job that writes the rows.

        watch = Watch()
        df = watch.on(df, checks)            also for rows on their way into another table
        df.write...                          once
        watch.counts()                       failures per check

    `where` limits checks to some rows of a frame that several tables are cut from.
    A frame that is read more than once would be counted more than once: write it."""

    def __init__(self):
        self.seen: list[tuple[Observation, list[Check]]] = []

    def on(self, df: DataFrame, checks: list[Check], where: str | None = None) -> DataFrame:
        mine = [c for c in checks if c.kind not in WHOLE_TABLE]
        if not mine:
            return df
        seen, limit = Observation(), f"({where}) AND " if where else ""
        self.seen.append((seen, mine))
        return df.observe(seen, *[F.expr(f"count_if({limit}({failure_sql(c)}))").alias(f"n{i}") for i, c in enumerate(mine)])

    def counts(self) -> dict[Check, int]:
        return {c: observed(seen, f"n{i}") for seen, mine in self.seen for i, c in enumerate(mine)}


def counted_rows(spark: SparkSession, counted: dict[Check, int]) -> DataFrame:
    """Counted checks as rows of the report."""
    rows = [(c.table, c.column, c.kind, n) for c, n in counted.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, check_name string, n_failed long")


def unique_check(df: DataFrame, check: Check) -> DataFrame:
    counted = duplicate_keys(df, check.column).agg(F.count("*").alias("n0"))
    return _report_rows(counted, [check])


def keyed_checks(df: DataFrame, checks: list[Check], unique: Check) -> DataFrame:
    """Row checks and one uniqueness check in one pass: failures are added up per
    key on the way to counting the keys."""
    counters = [F.expr(f"count_if({failure_sql(c)})").alias(f"n{i}") for i, c in enumerate(checks)]
    per_key = df.groupBy(unique.column).agg(F.count("*").alias("_rows"), *counters)
    totals = [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(checks))]
    repeated = F.count_if(F.col(unique.column).isNotNull() & (F.col("_rows") > 1)).alias(f"n{len(checks)}")
    return _report_rows(per_key.agg(*totals, repeated), [*checks, unique])


def relationship_check(df: DataFrame, check: Check, parent: DataFrame) -> DataFrame:
    counted = orphans(df, check.column, parent, check.parent_column).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n0")
    )
    return _report_rows(counted, [check])


def quality_report(
    tables: dict[str, DataFrame], checks: list[Check], counted: dict[Check, int] | None = None
) -> DataFrame:
    """One row per check: table, column, check, number of failures. Checks that are
    `counted` (see `Watch`) cost no scan."""
    parts: list[DataFrame] = []
    known = {c: n for c, n in (counted or {}).items() if c in checks}
    if known:
        parts.append(counted_rows(next(iter(tables.values())).sparkSession, known))
    left = [c for c in checks if c not in known]
    for name in dict.fromkeys(c.table for c in left):
        mine = [c for c in left if c.table == name]
        df = tables[name]
        simple = [c for c in mine if c.kind not in WHOLE_TABLE]
        unique = [c for c in mine if c.kind == "unique"]
        if unique and simple:
            parts.append(keyed_checks(df, simple, unique[0]))
        elif simple:
            parts.append(row_checks(df, simple))
        parts += [unique_check(df, c) for c in (unique[1:] if simple else unique)]
        parts += [
            relationship_check(df, c, tables[c.parent]) for c in mine if c.kind == "relationship"
        ]
    return reduce(DataFrame.unionByName, parts)


def require_clean(report: DataFrame) -> None:
    """Raise when any check failed. The report has one row per declared check."""
    failed = report.filter(F.col("n_failed") > 0).collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.n_failed}" for r in failed]
        raise QualityError("; ".join(lines))


def scored_resolutions(facts: DataFrame, staged_feedback: DataFrame) -> DataFrame:
    labels = staged_feedback.select("feedback_id", "true_campaign_id")
    return (
        facts.filter(F.col("resolved_campaign_id").isNotNull())
        .select("feedback_id", "resolved_campaign_id")
        .join(labels, "feedback_id")
    )


def resolution_precision(facts: DataFrame, staged_feedback: DataFrame) -> DataFrame:
    """Share of resolved rows whose campaign is the labelled one. A missing
    label counts as wrong; NULL when nothing is resolved."""
    right = F.count_if(F.col("resolved_campaign_id") == F.col("true_campaign_id"))
    scored = scored_resolutions(facts, staged_feedback)
    return scored.agg(ratio(right, F.count("*")).alias("precision"))


def precision_failures(
    facts: DataFrame, staged_feedback: DataFrame, gate: float = PRECISION_GATE
) -> DataFrame:
    """Empty when precision reaches the gate."""
    return resolution_precision(facts, staged_feedback).filter(F.col("precision") < gate)


def resolution_quality(
    facts: DataFrame, staged_feedback: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """Exact match, precision, specificity and ids that no campaign has.

    Exact match: resolved equals label (both empty counts) over all rows.
    Specificity: unresolved share of the rows without a label.
    """
    rows = facts.select("feedback_id", "resolved_campaign_id").join(
        staged_feedback.select("feedback_id", "true_campaign_id"), "feedback_id"
    )
    resolved, label = F.col("resolved_campaign_id"), F.col("true_campaign_id")
    unknown = orphans(facts, "resolved_campaign_id", campaigns, "campaign_id")
    n_unknown = unknown.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).scalar()
    measures = rows.agg(
        F.count("*").alias("n_rows"),
        ratio(F.count_if(resolved.eqNullSafe(label)), F.count("*"), 6).alias("exact_match"),
        ratio(
            F.count_if(resolved == label), F.count_if(resolved.isNotNull()), 6
        ).alias("precision"),
        ratio(
            F.count_if(resolved.isNull() & label.isNull()), F.count_if(label.isNull()), 6
        ).alias("specificity"),
    )
    return measures.withColumn("hallucinated_ids", n_unknown.cast("bigint"))
