"""Drift between a reference and a current table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekgrid.functions.columns import ratio, zero_if_null
from weekgrid.functions.running import running_totals
from weekgrid.functions.tails import chi_square_tail, kolmogorov_tail
from weekgrid.session import stored

THRESHOLD, P_VALUE = 0.1, 0.05
FEW, SMALL = 5, 1000


def sample(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows in the order of md5 of the seed and their key: repeatable on any
    cluster, and in any system that has md5."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)


def sided(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both tables as one, ``side`` 0 for the reference."""
    return reference.select(*columns, F.lit(0).alias("side")).unionByName(current.select(*columns, F.lit(1).alias("side")))


def value_counts(rows: DataFrame, numeric: list[str], categorical: list[str], side: str = "side") -> DataFrame:
    """(column, value, text, ref, cur, bucket): row counts per distinct value of every
    column, numbers in ``value`` and categories in ``text``, NULLs left out.

    One scan serves all columns and tests. The counts are stored in ranges of
    (column, value, text), so no column has to fit a task.
    """
    def cell(c, value, text):
        return F.struct(F.lit(c).alias("column"), value.cast("double").alias("value"), text.cast("string").alias("text"))

    none = F.lit(None)
    cells = [cell(c, F.col(c), none) for c in numeric] + [cell(c, none, F.col(c)) for c in categorical]
    counts = (
        rows.where(F.col(side).isin(0, 1)).select(F.col(side).alias("side"), F.inline(F.array(*cells)))
        .where("value IS NOT NULL OR text IS NOT NULL")
        .groupBy("column", "value", "text")
        .agg(F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur"))
    )
    ranged = counts.repartitionByRange("column", "value", "text").withColumn("bucket", F.spark_partition_id())
    return stored(ranged, "value-counts")


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), F.count("*").alias("n_values")
    )


def _reference_spread(counts: DataFrame) -> DataFrame:
    """Totals per column with the reference deviation, from the value counts
    alone: the tables are not scanned again."""
    value, weight = F.col("value"), F.col("ref")
    means = counts.groupBy("column").agg(ratio(F.sum(weight * value), F.sum(weight)).alias("mean"))
    basis = F.broadcast(_totals(counts).join(means, "column"))
    away = value - F.col("mean")
    return (
        counts.join(basis, "column")
        .groupBy("column", "n_ref", "n_cur", "n_values")
        .agg(F.sqrt(ratio(F.sum(weight * away * away), F.sum(weight))).alias("sd"))
    )


def _js_term(p: Column, q: Column) -> Column:
    """Half of p ln(p/m) with m the mean of p and q; zero where p is zero."""
    return F.when(p > 0, 0.5 * p * F.log(2.0 * p / (p + q))).otherwise(F.lit(0.0))


def _js_distance() -> Column:
    p = F.col("ref") / F.col("n_ref")
    q = F.col("cur") / F.col("n_cur")
    return F.sqrt(F.greatest(F.sum(_js_term(p, q) + _js_term(q, p)), F.lit(0.0)))


def _chi_square() -> Column:
    """Sum of (current - expected)^2 / expected, expected by the reference shares;
    infinite where the current side has a value that the reference lacks."""
    expected = F.col("ref") * F.col("n_cur") / F.col("n_ref")
    away = F.col("cur") - expected
    return F.sum(F.when(expected > 0, away * away / expected).when(F.col("cur") > 0, float("inf")).otherwise(0.0))


def _proportion() -> Column:
    """Squared z of the difference of two shares, of columns with two values."""
    n, m = F.col("n_ref"), F.col("n_cur")
    both = (F.col("ref") + F.col("cur")) / (n + m)
    gap = F.col("ref") / n - F.col("cur") / m
    return F.max(zero_if_null(ratio(gap * gap, both * (1 - both) * (1 / n + 1 / m))))


def _numeric_scores(counts: DataFrame) -> DataFrame:
    """(column, n_ref, n_cur, n_values, sd, area, js, ks, chi, share) of numeric columns."""
    counts = counts.where("value IS NOT NULL").drop("text")
    totals = F.broadcast(_reference_spread(counts))  # one row per column
    steps = running_totals(counts, ["column"], "value", ["ref", "cur"]).join(totals, "column")
    gap = F.abs(F.col("ref_upto") / F.col("n_ref") - F.col("cur_upto") / F.col("n_cur"))
    area = F.sum(zero_if_null(gap * (F.col("next_value") - F.col("value"))))
    return steps.groupBy("column", "n_ref", "n_cur", "n_values", "sd").agg(
        area.alias("area"), _js_distance().alias("js"), F.max(gap).alias("ks"), _chi_square().alias("chi"), _proportion().alias("share")
    )


def _categorical_scores(counts: DataFrame) -> DataFrame:
    counts = counts.where("text IS NOT NULL")
    totals = F.broadcast(_totals(counts))  # one row per column
    return counts.join(totals, "column").groupBy("column", "n_ref", "n_cur", "n_values").agg(
        _js_distance().alias("js"), _chi_square().alias("chi"), _proportion().alias("share")
    )


def _by_distance(scores: DataFrame, few: Column, threshold: float) -> DataFrame:
    score = F.col("js") if "area" not in scores.columns else F.when(few, F.col("js")).otherwise(
        F.col("area") / F.greatest(F.col("sd"), F.lit(0.001))
    )
    method = F.when(few, "jensen_shannon").otherwise("wasserstein")
    return scores.select("column", method.alias("method"), score.alias("score"), (score >= threshold).alias("drifted"))


def _by_test(scores: DataFrame, few: Column, p_value: float) -> DataFrame:
    two = F.col("n_values") == 2
    near = F.when(few & two, F.col("share")).when(few, F.col("chi"))
    degrees = F.when(two, 1).otherwise(F.col("n_values") - 1)
    tail = chi_square_tail(near, degrees)
    if "ks" in scores.columns:
        statistic = F.coalesce(near, F.col("ks"))
        tail = F.when(few, tail).otherwise(kolmogorov_tail(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
    else:
        statistic = near
    method = F.when(few & two, "proportion").when(few, "chi_square").otherwise("kolmogorov_smirnov")
    return scores.select(
        "column", method.alias("method"), tail.alias("score"), (tail < p_value).alias("drifted"), statistic.alias("statistic")
    )


def _few(scores: DataFrame, few_values: int) -> Column:
    return F.col("n_values") <= few_values if "area" in scores.columns else F.lit(True)


def tests(
    rows: DataFrame, numeric_columns: list[str], categorical_columns: list[str], p_value: float = P_VALUE, few_values: int = FEW
) -> DataFrame:
    """(column, method, score, drifted, statistic) of two-sample tests; ``score`` is the
    p-value and a column has drifted where it is below ``p_value``.

    Numbers are compared by Kolmogorov and Smirnov's test with its asymptotic tail;
    categories, and numbers of at most ``few_values`` distinct values, by a chi-square
    test against the reference shares, or by the difference of proportions where
    there are two values.
    """
    counts = value_counts(rows, numeric_columns, categorical_columns)
    both = [_numeric_scores(counts), _categorical_scores(counts)]
    found = [_by_test(s, _few(s, few_values), p_value) for s in both]
    return found[0].unionByName(found[1])


def columns_report(
    rows: DataFrame, numeric_columns: list[str], categorical_columns: list[str], small: int = SMALL,
    threshold: float = THRESHOLD, p_value: float = P_VALUE, few_values: int = FEW,
) -> DataFrame:
    """(column, method, score, drifted) of every column of a table with ``side``.

    Columns for which both sides have at most ``small`` values are compared by
    ``tests``, larger ones by distances; 0 takes distances always. All come from one
    table of counts, so from one scan.
    """
    counts = value_counts(rows, numeric_columns, categorical_columns)
    tested = F.greatest("n_ref", "n_cur") <= small
    parts = []
    for scores in (_numeric_scores(counts), _categorical_scores(counts)):
        few = _few(scores, few_values)
        parts += [
            _by_distance(scores.where(~tested), few, threshold),
            _by_test(scores.where(tested), few, p_value).drop("statistic"),
        ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def numeric(
    reference: DataFrame, current: DataFrame, columns: list[str], threshold: float = THRESHOLD, few_values: int = FEW
) -> DataFrame:
    """Wasserstein distance over the reference deviation per column.

    Both empirical distributions are accumulated over distinct values in ranges,
    so no column is sorted in one task. A column of at most ``few_values`` distinct
    values is compared by Jensen-Shannon distance instead.
    """
    scores = _numeric_scores(value_counts(sided(reference, current, columns), columns, []))
    return _by_distance(scores, _few(scores, few_values), threshold)


def categorical(
    reference: DataFrame, current: DataFrame, columns: list[str], threshold: float = THRESHOLD
) -> DataFrame:
    """Jensen-Shannon distance of the value shares per column."""
    scores = _categorical_scores(value_counts(sided(reference, current, columns), [], columns))
    return _by_distance(scores, F.lit(True), threshold)


def report(columns_report: DataFrame, warn: float = 0.30, crit: float = 0.50) -> DataFrame:
    """One row: how many columns drifted, their share and the severity."""
    row = columns_report.agg(
        F.count("*").alias("n_columns"), F.count_if("drifted").alias("n_drifted")
    ).withColumn("drift_share", zero_if_null(ratio(F.col("n_drifted"), F.col("n_columns"))))
    severity = F.when(F.col("drift_share") >= crit, "critical").when(
        F.col("drift_share") >= warn, "warning"
    )
    return row.withColumn("severity", severity.otherwise("ok"))
