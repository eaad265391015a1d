"""Data-quality checks with warn and error severities.

Every check yields the number of failing rows (or failing groups) of one model.
``run_checks`` returns the report as a lazy DataFrame, one row per check:
row-level checks of one model (not NULL, accepted range, NULL-free lookup) share a
single aggregate over that model, so each model is scanned once for all of them;
uniqueness checks with the same key types share one grouped count (partial
aggregation before the shuffle, so a hot value moves one row per task). One action evaluates the whole
report; ``enforce`` collects it (one row per check, bounded by the suite's size)
and raises when an error-severity check failed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN = "warn"
ERROR = "error"

ROW_LEVEL = ("not_null", "accepted_range")
KINDS = ("not_null", "unique", "unique_combination_of_columns", "accepted_range", "relationships")


class CheckFailed(RuntimeError):
    def __init__(self, failed: list[dict]):
        self.failed = failed
        names = ", ".join(f"{r['check_name']} ({r['failures']})" for r in failed)
        super().__init__(f"{len(failed)} error-severity check(s) failed: {names}")


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    columns: tuple[str, ...]
    severity: str = ERROR
    min_value: float | None = None
    max_value: float | None = None
    parent: str | None = None  # relationships: parent model
    parent_column: str | None = None
    name: str | None = None  # singular checks carry their own name

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown check kind {self.kind!r}")
        if self.severity not in (WARN, ERROR):
            raise ValueError(f"unknown severity {self.severity!r}")

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        return f"{self.kind}__{self.model}__{'__'.join(self.columns)}"

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def failing_condition_sql(check: Check) -> str:
    """Row-level predicate (SQL text) that is true for a failing row."""
    c = _q(check.columns[0])
    if check.kind == "not_null":
        return f"{c} IS NULL"
    if check.kind == "accepted_range":
        # NOT (x >= lo AND x <= hi): a NULL value is neither pass nor fail.
        terms = ["TRUE"]
        if check.min_value is not None:
            terms.append(f"{c} >= {float(check.min_value)!r}D")
        if check.max_value is not None:
            terms.append(f"{c} <= {float(check.max_value)!r}D")
        return f"NOT ({' AND '.join(terms)})"
    raise ValueError(f"{check.kind} is not a row-level check")


def failing_condition(check: Check) -> Column:
    """Row-level predicate that is true for a failing row."""
    return F.expr(failing_condition_sql(check))


def failing_rows(check: Check, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The rows (or groups) that make ``check`` fail."""
    df = frames[check.model]
    if check.kind in ROW_LEVEL:
        return df.where(failing_condition(check))
    if check.kind == "unique":
        c = check.columns[0]
        return df.where(F.col(c).isNotNull()).groupBy(c).count().where(F.col("count") > 1)
    if check.kind == "unique_combination_of_columns":
        return df.groupBy(*check.columns).count().where(F.col("count") > 1)
    if check.kind == "relationships":
        # Distinct parent keys: the anti join's non-preserved side stays unique per
        # key; a hot key on the fact side is split by AQE.
        parent = frames[check.parent].select(F.col(check.parent_column).alias("__parent_key")).distinct()
        return df.join(parent, F.col(check.columns[0]) == F.col("__parent_key"), "left_anti")
    raise ValueError(check.kind)


def with_status(report: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == WARN, F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return report.withColumn("status", status)


UNIQUENESS = ("unique", "unique_combination_of_columns")


def _uniqueness_entry_sql(check: Check, idx: int) -> str:
    """SQL for the (check index, key) entry of one row under one uniqueness check;
    NULL when the row does not take part (a NULL value under ``unique``). The key
    keeps the columns' own types (fields c0, c1, ...), so nothing is converted to
    text before the shuffle."""
    fields = ", ".join(f"'c{j}', {_q(c)}" for j, c in enumerate(check.columns))
    entry = f"named_struct('check_idx', {idx}, 'key', named_struct({fields}))"
    if check.kind == "unique":
        return f"CASE WHEN {_q(check.columns[0])} IS NOT NULL THEN {entry} END"
    return entry


def _repeated_keys(items: list[tuple[int, Check]], frames: Mapping[str, DataFrame]) -> DataFrame:
    """One ``check_idx`` row per key repeated under a uniqueness check.

    Checks whose keys have the same column types share one shuffle: every model
    emits one (check, key) row per row and check, and a grouped count finds the keys
    seen more than once (combined map-side, so a value holding a third of a table
    moves one row per task). Keys keep their native types, so the shuffle carries
    e.g. two longs for a (user, movie) key rather than their text; there is one
    shuffle per distinct key signature (a handful for the whole suite).
    """
    by_signature: dict[tuple, dict[str, list[tuple[int, Check]]]] = defaultdict(lambda: defaultdict(list))
    for i, ch in items:
        types = dict(frames[ch.model].dtypes)
        by_signature[tuple(types[c] for c in ch.columns)][ch.model].append((i, ch))
    repeated = []
    for by_model in by_signature.values():
        parts = []
        for model, group in by_model.items():
            # One SQL expression per model (one round trip to build, one generator).
            entries = ", ".join(_uniqueness_entry_sql(ch, i) for i, ch in group)
            parts.append(
                frames[model]
                .selectExpr(f"explode(array({entries})) AS __e")
                .where("__e IS NOT NULL")
                .selectExpr("__e.check_idx AS check_idx", "__e.key AS key")
            )
        emitted = parts[0]
        for part in parts[1:]:
            emitted = emitted.unionByName(part)
        repeated.append(emitted.groupBy("check_idx", "key").count().where(F.col("count") > 1).select("check_idx"))
    out = repeated[0]
    for part in repeated[1:]:
        out = out.unionByName(part)
    return out


def _row_level_counts(by_model: dict[str, list[tuple[int, Check]]], frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(check_idx, n)`` of the row-level checks of all models.

    Every model becomes its number and one boolean per check; the union is counted by one aggregate per model, combined
    map-side, in one shuffle of one row per task and model. No row is multiplied."""
    width = max(map(len, by_model.values()))
    parts = []
    for m, (model, items) in enumerate(by_model.items()):
        fails = [f"{failing_condition_sql(ch)} AS f{j}" for j, (_, ch) in enumerate(items)]
        fails += [f"FALSE AS f{j}" for j in range(len(items), width)]
        parts.append(frames[model].selectExpr(f"{m} AS m", *fails))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    counts = rows.groupBy("m").agg(*[F.count_if(f"f{j}").alias(f"n{j}") for j in range(width)])
    # Back to one row per check: (m, j) names it.
    numbers = ", ".join(
        f"named_struct('m', {m}, 'check_idx', {i}, 'n', n{j})" for m, items in enumerate(by_model.values()) for j, (i, _) in enumerate(items)
    )
    return counts.selectExpr("m AS of", f"explode(array({numbers})) AS x").where("x.m = of").selectExpr("x.check_idx", "x.n")


def run_checks(checks: Iterable[Check], frames: Mapping[str, DataFrame]) -> DataFrame:
    """Lazy report: check_name, kind, model, column_name, severity, failures, status.

    Row-level checks are counted by one aggregate per model, all in one shuffle. Every repeated key (uniqueness
    checks) and orphan (relationships) emits its check's index, and these are counted together. The
    counts meet the check list in one tiny aggregate, which gives every check a row without a join.
    """
    checks = list(checks)
    if not checks:
        raise ValueError("no checks to run")
    spark = frames[checks[0].model].sparkSession
    parts: list[DataFrame] = []
    by_model: dict[str, list[tuple[int, Check]]] = defaultdict(list)
    uniqueness: list[tuple[int, Check]] = []
    for i, ch in enumerate(checks):
        if ch.kind in ROW_LEVEL:
            by_model[ch.model].append((i, ch))
        elif ch.kind in UNIQUENESS:
            uniqueness.append((i, ch))
        else:
            parts.append(failing_rows(ch, frames).selectExpr(f"{i} AS check_idx"))
    if uniqueness:
        parts.append(_repeated_keys(uniqueness, frames))
    counted = [_row_level_counts(by_model, frames)] if by_model else []
    if parts:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        # Failure markers are counted by a hash aggregate (combined map-side).
        counted.append(found.groupBy("check_idx").agg(F.count(F.lit(1)).alias("n")))
    # The check list (one row per declared check, zero failures) and the per-check
    # counts meet in one tiny aggregate: every check gets a row, and no join is
    # needed to attach the descriptive columns.
    meta = spark.createDataFrame(
        [(i, c.check_name, c.kind, c.model, c.column_name, c.severity, 0) for i, c in enumerate(checks)],
        "check_idx int, check_name string, kind string, model string, column_name string, severity string, n bigint",
    )
    # Only the counts, at most one row per check, meet the check list.
    for part in counted:
        meta = meta.unionByName(part.selectExpr(
            "CAST(check_idx AS INT) AS check_idx", "CAST(NULL AS STRING) AS check_name", "CAST(NULL AS STRING) AS kind",
            "CAST(NULL AS STRING) AS model", "CAST(NULL AS STRING) AS column_name", "CAST(NULL AS STRING) AS severity",
            "CAST(n AS BIGINT) AS n",
        ))
    report = meta.groupBy("check_idx").agg(
        *[F.max(c).alias(c) for c in ("check_name", "kind", "model", "column_name", "severity")],
        F.sum("n").cast("bigint").alias("failures"),
    ).drop("check_idx")
    return with_status(report)


def enforce(report: DataFrame | list[dict]) -> list[dict]:
    """Collect the report (one row per check), unless that is done, and raise if an error check failed."""
    rows = report if isinstance(report, list) else [r.asDict() for r in report.collect()]
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        raise CheckFailed(failed)
    return rows
