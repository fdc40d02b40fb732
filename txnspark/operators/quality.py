"""Data-quality checks (QC-01 .. QC-25, QC-28): each returns the violating rows, an empty frame passes.

SQL three-valued logic holds: a condition that is NULL neither passes nor fails a filter, so NULLs pass unless the
check says otherwise. Checks that compare neighbours use ``adjacent_pairs`` and need no window over a whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.functions.dates import add_interval
from txnspark.functions.scalar import slugify
from txnspark.operators.windows import adjacent_pairs, repeat


def _expr(c: str | Column) -> Column:
    return F.expr(c) if isinstance(c, str) else c


# --- rules ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A check of single rows: those with ``violated`` fail it (NULL passes)."""

    violated: Column

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.where(self.violated)


@dataclass(frozen=True)
class KeyRule:
    """A check of key values: those that more than ``more_than`` of the ``counted`` rows hold fail it. NULLs are equal."""

    keys: tuple[str, ...]
    counted: Column
    more_than: int
    columns: tuple[str, ...]  # names of the keys, and of the count if wanted, in the violations

    def __call__(self, df: DataFrame) -> DataFrame:
        named = [_expr(k).alias(n) for k, n in zip(self.keys, self.columns, strict=False)]
        grouped = df.where(self.counted).groupBy(*named).agg(F.count(F.lit(1)).alias("_n"))
        held = grouped.where(F.col("_n") > self.more_than)
        return held.select(*[F.col(n) for n in self.columns[: len(self.keys)]], *[F.col("_n").alias(n) for n in self.columns[len(self.keys) :]])


def range_rule(column: str, min_value=None, max_value=None, inclusive: bool = True) -> RowRule:
    """Outside the range."""
    c = _expr(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < _literal(min_value) if inclusive else c <= _literal(min_value))
    if max_value is not None:
        bad = bad | (c > _literal(max_value) if inclusive else c >= _literal(max_value))
    return RowRule(bad)


def true_rule(expression: str, column: str | None = None) -> RowRule:
    """Fails a SQL condition; with a column the text is the rest of the condition."""
    return RowRule(~F.expr(f"{column} {expression}" if column else expression))


def not_null_rule(column: str) -> RowRule:
    """Without a value."""
    return RowRule(_expr(column).isNull())


def length_rule(column: str, value: int) -> RowRule:
    """Text of another length."""
    return RowRule(F.length(_expr(column)) != value)


def equal_rule(actual: str, expected: str, null_safe: bool = False) -> RowRule:
    """Two columns differ; with ``null_safe`` NULL equals only NULL."""
    a, b = F.col(actual), F.col(expected)
    return RowRule(~a.eqNullSafe(b) if null_safe else a != b)


def values_rule(column: str, values: Sequence) -> KeyRule:
    """Values outside the list."""
    return KeyRule((column,), ~_expr(column).isin(*values), 0, ("value_field", "n_records"))


def forbidden_rule(column: str, values: Sequence) -> KeyRule:
    """Values on the list."""
    return KeyRule((column,), _expr(column).isin(*values), 0, ("value_field",))


def unique_rule(column: str) -> KeyRule:
    """Non-null values that occur more than once."""
    return KeyRule((column,), _expr(column).isNotNull(), 1, ("unique_field", "n_records"))


def unique_combination_rule(columns: Sequence[str]) -> KeyRule:
    """Combinations that occur more than once; NULLs are equal."""
    return KeyRule(tuple(columns), F.lit(True), 1, tuple(columns))


def _literal(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


# --- row rules -----------------------------------------------------------------------------------------------------


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """QC-01: rows outside the range."""
    return range_rule(column, min_value, max_value, inclusive)(df)


def values_between(df: DataFrame, column: str, min_value=None, max_value=None, strictly: bool = False) -> DataFrame:
    """QC-21: rows outside a one- or two-sided range."""
    return accepted_range(df, column, min_value, max_value, inclusive=not strictly)


def value_lengths_equal(df: DataFrame, column: str, value: int) -> DataFrame:
    """QC-22: rows whose text has another length."""
    return length_rule(column, value)(df)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """QC-06: rows that fail a SQL condition; with a column the text is the rest of the condition."""
    return true_rule(expression, column)(df)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """QC-18: rows without a value."""
    return not_null_rule(column)(df)


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    """QC-11: empty texts, by default after trimming."""
    text = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.withColumn(column, text).where(F.col(column) == "")


def assert_equal(df: DataFrame, actual: str, expected: str, null_safe: bool = False) -> DataFrame:
    """QC-23: rows in which two columns differ; with ``null_safe`` NULL equals only NULL."""
    return equal_rule(actual, expected, null_safe)(df)


# --- value sets ----------------------------------------------------------------------------------------------------


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """QC-19: distinct values (with their count) outside the list."""
    return values_rule(column, values)(df)


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """QC-09: distinct values that are on the forbidden list."""
    return forbidden_rule(column, values)(df)


def unique(df: DataFrame, column: str) -> DataFrame:
    """QC-17: non-null values that occur more than once."""
    return unique_rule(column)(df)


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """QC-16: combinations that occur more than once; NULLs are equal."""
    return unique_combination_rule(columns)(df)


# --- aggregates ----------------------------------------------------------------------------------------------------


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """QC-02: groups without any value."""
    return df.groupBy(*group_by).agg(F.count(_expr(column)).alias("filler_column")).where(F.col("filler_column") == 0)


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """QC-10: groups with exactly one distinct value. Minimum = maximum says so without a distinct count."""
    c = _expr(column)
    ends = df.groupBy(*group_by).agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
    return ends.where(F.col("_lo") == F.col("_hi")).select(*group_by, F.lit(1).cast("bigint").alias("filler_column"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    """QC-12: groups whose share of values lies outside the bounds."""
    share = F.count(_expr(column)).cast("double") / F.count(F.lit(1)).cast("double")
    out = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return out.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field_: str,
    part: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    as_of: Column | None = None,
) -> DataFrame:
    """QC-13: groups whose newest value is older than ``interval`` parts before ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else as_of
    threshold = add_interval(part, -interval, now)
    newest = F.max(_expr(field_))
    if ignore_time_component:
        threshold, newest = threshold.cast("date"), newest.cast("date")
    out = df.groupBy(*group_by).agg(newest.alias("most_recent"))
    return out.withColumn("threshold", threshold).where(F.col("most_recent") < F.col("threshold"))


# --- two frames ----------------------------------------------------------------------------------------------------


def relationships(df: DataFrame, column: str, to: DataFrame, field_: str) -> DataFrame:
    """QC-20: foreign keys without a parent; NULL keys pass."""
    return relationships_where(df, column, to, field_).select(F.col("id").alias("from_field"))


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field_: str,
    from_condition: str = "true",
    to_condition: str = "true",
) -> DataFrame:
    """QC-14: child rows without a parent.

    Children are counted per key before the join and written out again after it, so a hot key crosses the network
    as one row per task.
    """
    child = df.where(from_condition).select(_expr(column).alias("id")).where(F.col("id").isNotNull())
    parent = to.where(to_condition).select(_expr(field_).alias("id")).where(F.col("id").isNotNull()).distinct()
    counted = child.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    orphans = counted.join(parent, "id", "left_anti")
    return repeat(orphans, "_n").select("id", F.lit(None).cast(parent.schema["id"].dataType).alias("right_id"))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field_: str) -> DataFrame:
    """QC-03: (value, count) pairs found on one side only. One shuffle: both sides are counted together."""
    sides = df.select(_expr(column).alias(column), F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(
        to.select(_expr(field_), F.lit(0), F.lit(1))
    )
    counted = sides.groupBy(column).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    differing = counted.where(F.col("_a") != F.col("_b"))
    return (
        differing.withColumn("num_rows", F.explode(F.array("_a", "_b")))
        .where(F.col("num_rows") > 0)
        .select(column, "num_rows")
    )


def equality(df: DataFrame, compare: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """QC-05: distinct rows found on one side only, tagged by side. One shuffle instead of two set differences."""
    names = list(columns or df.columns)
    sides = df.select(*names, F.lit(True).alias("_a")).union(compare.select(*names, F.lit(False)))
    seen = sides.groupBy(*names).agg(F.bool_or("_a").alias("_in_a"), F.bool_and("_a").alias("_only_a"))
    side = F.when(F.col("_only_a"), "a_minus_b").when(~F.col("_in_a"), "b_minus_a")
    return seen.withColumn("which_diff", side).where(F.col("which_diff").isNotNull()).select("which_diff", *names)


def equality_failures(violations: DataFrame) -> DataFrame:
    """Failure count of QC-05: rows plus the imbalance between the two sides."""
    balance = F.sum(F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1))
    return violations.agg((F.count(F.lit(1)) + F.coalesce(F.abs(balance), F.lit(0))).alias("failures"))


def _counts(df: DataFrame, compare: DataFrame, group_by: Sequence[str], a: str, b: str) -> DataFrame:
    left = df.groupBy(*group_by).agg(F.count(F.lit(1)).alias(a)).select(
        *[F.col(c).alias(f"{c}_a") for c in group_by], a, F.lit(1).alias("_one_a")
    )
    right = compare.groupBy(*group_by).agg(F.count(F.lit(1)).alias(b)).select(
        *[F.col(c).alias(f"{c}_b") for c in group_by], b, F.lit(1).alias("_one_b")
    )
    on = F.col("_one_a") == F.col("_one_b")
    for c in group_by:
        on = on & (F.col(f"{c}_a") == F.col(f"{c}_b"))
    keys = [k for c in group_by for k in (f"{c}_a", f"{c}_b")]
    return left.join(right, on, "full").select(*keys, a, b)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """QC-04: row counts side by side; failures are the sum of ``diff_count`` (a one-sided group has NULL)."""
    counts = _counts(df, compare, group_by, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """QC-07: row counts side by side; failures are the sum of ``row_count_delta`` (equal counts weigh 1)."""
    counts = _counts(df, compare, group_by, "count_our_model", "count_comparison_model")
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, F.lit(1)).otherwise(F.lit(0))
    return counts.withColumn("row_count_delta", delta.cast("bigint"))


def sum_failures(violations: DataFrame, column: str) -> DataFrame:
    """AGG-13: failure count of QC-04 / QC-07."""
    return violations.agg(F.coalesce(F.sum(F.coalesce(F.col(column), F.lit(0))), F.lit(0)).cast("bigint").alias("failures"))


def columns_match_set(df: DataFrame, columns: Sequence[str], transform: Callable[[str], str] = str.upper) -> set[str]:
    """QC-24: column names found on one side only, after case folding. Empty means equal."""
    return {transform(c) for c in df.columns} ^ {transform(c) for c in columns}


# --- neighbours ----------------------------------------------------------------------------------------------------


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """QC-08: ranges that are empty, inverted or NULL, or that do not follow the ``gaps`` rule to the next range."""
    follows = {
        "not_allowed": (lambda a, b: a == b, "equal_to"),
        "allowed": (lambda a, b: a <= b, "less_than_or_equal_to"),
        "required": (lambda a, b: a < b, "less_than"),
    }
    if gaps not in follows:
        raise ValueError(f"gaps must be one of {sorted(follows)}, got {gaps!r}")
    gap_rule, gap_words = follows[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"

    keys = ["partition_by_col"] if partition_by else []
    parts = [_expr(partition_by).alias("partition_by_col")] if partition_by else []
    ranges = df.select(*parts, _expr(lower).alias("lower_bound"), _expr(upper).alias("upper_bound"))
    lo, hi, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("_next")
    sound = F.coalesce(lo <= hi if zero_length_range_allowed else lo < hi, F.lit(False))

    def is_last(following: Column) -> Column:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(following[k])
        return following.isNull() | ~same

    def follows_rule(next_lower: Column, last: Column) -> Column:
        return F.coalesce(gap_rule(hi, next_lower), last, F.lit(False))

    def report(rows: DataFrame, next_lower: Column, last: Column) -> DataFrame:
        return rows.select(
            *keys,
            "lower_bound",
            "upper_bound",
            next_lower.alias("next_lower_bound"),
            last.alias("is_last_record"),
            sound.alias(f"lower_bound_{length_words}_upper_bound"),
            follows_rule(next_lower, last).alias(f"upper_bound_{gap_words}_next_lower_bound"),
        )

    def next_lower(following: Column) -> Column:
        return F.when(~is_last(following), following["lower_bound"])

    broken = adjacent_pairs(
        ranges,
        [*keys, "lower_bound", "upper_bound"],
        lambda following: ~(sound & follows_rule(next_lower(following), is_last(following))),
    )
    return report(broken, next_lower(nxt), is_last(nxt))


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    part: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """QC-15: values that are not their predecessor plus ``interval`` (date parts when ``part`` is given)."""
    values = df.where(F.col(column).isNotNull()).select(*group_by, column)

    def breaks(earlier: Column, later: Column) -> Column:
        if part:
            return later.cast("timestamp") != add_interval(part, interval, earlier).cast("timestamp")
        return later != earlier + interval

    def same_group(nxt: Column) -> Column:
        same = nxt.isNotNull()
        for g in group_by:
            same = same & F.col(g).eqNullSafe(nxt[g])
        return same

    jumps = adjacent_pairs(
        values, [*group_by, column], lambda nxt: same_group(nxt) & breaks(F.col(column), nxt[column])
    )
    return jumps.select(
        *[F.col("_next")[g].alias(g) for g in group_by],
        F.col("_next")[column].alias(column),
        F.col(column).alias(f"previous_{slugify(column)}"),
    )


# --- runner --------------------------------------------------------------------------------------------------------


@dataclass
class Check:
    """One check of a frame.

    ``test`` maps the (filtered) frame to its violations: a ``RowRule``, a ``KeyRule`` or any function. ``failures`` maps
    violations to a one-row frame with column ``failures`` (default: their count). Thresholds are texts such as ``"> 0"``
    or ``">=10"`` (QC-25).
    """

    name: str
    test: Callable[[DataFrame], DataFrame]
    severity: str = "warn"
    where: str | None = None
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    failures: Callable[[DataFrame], DataFrame] | None = field(default=None)

    def violations(self, df: DataFrame) -> DataFrame:
        return self.test(df.where(self.where) if self.where else df)

    def status(self) -> Column:
        """Status by the column ``failures``."""
        if self.severity not in ("warn", "error"):
            raise ValueError(f"severity must be 'warn' or 'error', got {self.severity!r}")
        status = F.when(F.expr(f"failures {self.warn_if}"), "warn").otherwise("pass")
        if self.severity == "error":
            status = F.when(F.expr(f"failures {self.error_if}"), "error").otherwise(status)
        return status

    def outcome(self, df: DataFrame) -> DataFrame:
        bad = self.violations(df)
        counted = self.failures(bad) if self.failures else bad.agg(F.count(F.lit(1)).alias("failures"))
        return _outcomes(counted.select(F.col("failures").cast("bigint").alias("n0")), [self])


def _outcomes(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row of failure counts n0, n1, .. to one row per check."""
    numbered = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"n{i}").alias("failures")) for i in range(len(checks))])
    of = {what: F.lit(None).cast("string") for what in ("check", "severity", "status")}
    for i, c in enumerate(checks):
        values = {"check": F.lit(c.name), "severity": F.lit(c.severity), "status": c.status()}
        of = {what: F.when(F.col("_i") == i, values[what]).otherwise(of[what]) for what in of}
    rows = counts.select(F.explode(numbered).alias("c")).select("c.*")
    return rows.select(of["check"].alias("check"), "failures", of["severity"].alias("severity"), of["status"].alias("status"))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """QC-25: one row per check: name, failures, severity, status.

    The checks are sorted by kind. All row rules are counted by one aggregate over one scan. All key rules share one scan
    and one shuffle: a row is written out once per rule that counts it, as (rule, key), the keys are counted, and the
    violated ones are counted per rule. Only checks of other kinds, or with a failure count of their own, read the frame
    again, one by one.
    """
    kinds: dict[type | None, list[Check]] = {RowRule: [], KeyRule: [], None: []}
    for c in checks:
        kinds[type(c.test) if type(c.test) in kinds and not c.failures else None].append(c)
    parts = [c.outcome(df) for c in kinds[None]]
    if rows := kinds[RowRule]:
        counts = df.agg(*[F.count_if(_within(c) & c.test.violated).alias(f"n{i}") for i, c in enumerate(rows)])
        parts.append(_outcomes(counts, rows))
    if keyed := kinds[KeyRule]:
        parts.append(_run_key_rules(df, keyed))
    return reduce(DataFrame.union, parts)


def _within(check: Check) -> Column:
    return F.expr(check.where) if check.where else F.lit(True)


def _run_key_rules(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    def named(i: int, rule: KeyRule) -> Column:
        # Keys of any type travel as text, which is different for different values of one type.
        key = F.array(*[_expr(k).cast("string") for k in rule.keys])
        return F.struct(F.lit(i).alias("rule"), key.alias("key"))

    entries = F.array(*[F.when(_within(c) & c.test.counted, named(i, c.test)) for i, c in enumerate(checks)])
    spread = df.select(F.explode(entries).alias("e")).where(F.col("e").isNotNull()).select("e.*")
    keys = spread.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"))
    more_than = F.element_at(F.array(*[F.lit(c.test.more_than) for c in checks]), F.col("rule") + 1)
    bad = [F.count_if((F.col("rule") == i) & (F.col("n") > more_than)).alias(f"n{i}") for i in range(len(checks))]
    return _outcomes(keys.agg(*bad), checks)
