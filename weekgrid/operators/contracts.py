"""Data contracts: rules over a table, evaluated in one aggregate pass.

A rule is a small object; a suite is a list of rules. All row rules of a suite
become columns of a single aggregate. A uniqueness rule needs a grouping by its
key and adds one job stage of its own. NULLs are ignored by value rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weekgrid.operators.gold import COLUMNS as GOLD_COLUMNS

FLOATS = (T.FloatType, T.DoubleType)
INTS = (T.ShortType, T.IntegerType, T.LongType)
MARKDOWNS = [f"markdown{i}" for i in range(1, 6)]


class ContractViolation(Exception):
    """A strict run found a failing rule."""


@dataclass(frozen=True)
class Rule:
    kind: str
    columns: tuple[str, ...]
    params: str = ""
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    types: tuple = field(default=())

    def broken(self) -> Column | None:
        """True where a row breaks the rule; None if the rule is not about rows."""
        if self.kind == "not_null":
            return F.col(self.columns[0]).isNull()
        if self.kind == "between":
            c = F.col(self.columns[0])
            tests = []
            if self.low is not None:
                tests.append(c < self.low)
            if self.high is not None:
                tests.append(c > self.high)
            return tests[0] if len(tests) == 1 else tests[0] | tests[1]
        if self.kind == "in_set":
            return ~F.col(self.columns[0]).isin(*self.values)
        return None

    def schema_verdict(self, df: DataFrame) -> bool | None:
        """Verdict of a rule about the schema, else None."""
        if self.kind == "columns_match":
            return set(df.columns) == set(self.columns)
        if self.kind == "exists":
            return self.columns[0] in df.columns
        if self.kind == "type_in":
            return isinstance(df.schema[self.columns[0]].dataType, self.types)
        return None


def columns_match(*names: str) -> Rule:
    return Rule("columns_match", tuple(names))


def exists(name: str) -> Rule:
    return Rule("exists", (name,))


def between(name: str, low: float | None = None, high: float | None = None) -> Rule:
    if low is None and high is None:
        raise ValueError("between needs a bound")
    return Rule("between", (name,), f"[{low}, {high}]", low=low, high=high)


def not_null(name: str) -> Rule:
    return Rule("not_null", (name,))


def unique(*names: str) -> Rule:
    return Rule("unique", tuple(names))


def in_set(name: str, *values) -> Rule:
    return Rule("in_set", (name,), ",".join(map(str, values)), values=values)


def type_in(name: str, types: tuple) -> Rule:
    return Rule("type_in", (name,), ",".join(t().simpleString() for t in types), types=types)


SALES = [
    columns_match("store", "dept", "date", "weekly_sales", "isholiday"),
    between("weekly_sales", 0.0),
    between("store", 1, 45),
    not_null("date"),
    not_null("weekly_sales"),
    unique("store", "dept", "date"),
    type_in("weekly_sales", FLOATS),
    type_in("store", INTS),
]
FEATURES = [
    columns_match(
        "store", "date", "temperature", "fuel_price", *MARKDOWNS, "cpi", "unemployment", "isholiday"
    ),
    not_null("cpi"),
    not_null("unemployment"),
    unique("store", "date"),
    type_in("cpi", FLOATS),
    type_in("unemployment", FLOATS),
    *[r for m in MARKDOWNS for r in (not_null(m), between(m, 0.0), type_in(m, FLOATS))],
]
STORES = [
    columns_match("store", "type", "size"),
    between("store", 1, 45),
    type_in("store", INTS),
    unique("store"),
    in_set("type", "A", "B", "C"),
]
GOLD = [
    columns_match(*GOLD_COLUMNS),
    not_null("weekly_sales"),
    between("weekly_sales", 0.0),
    *[
        exists(c)
        for c in ("sales_log", "sin_week", "lag_1_log", "rolling_4_wk_log_sales_avg", "cpi_lag_3_month")
    ],
    unique("store", "dept", "date"),
    between("store_size", 0.0),
    between("fuel_price", 0.0),
    between("cpi", 0.0),
    between("unemployment", 0.0, 100.0),
    *[between(m, 0.0) for m in MARKDOWNS],
    between("total_markdown", 0.0),
    between("month", 1, 12),
    between("week_of_year", 1, 53),
    between("sin_week", -1.0, 1.0),
    between("cos_week", -1.0, 1.0),
    between("rolling_4_wk_log_sales_avg", 0.0),
    between("sales_last_year", 0.0),
    in_set("store_type", "A", "B", "C"),
    not_null("isholiday"),
    in_set("isholiday", 0, 1),
]


def run(df: DataFrame, name: str, rules: list[Rule], strict: bool = False) -> DataFrame:
    """(table, rule, column, params, element_count, unexpected_count, success).

    A rule naming a column the table lacks fails without being evaluated. With
    ``strict`` the report is computed at once and a failing rule raises.
    """
    absent = {r for r in rules if not set(r.columns) <= set(df.columns)}
    row_rules = [r for r in rules if r not in absent and r.broken() is not None]
    row = df.agg(
        F.count("*").alias("n"),
        *[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(row_rules)],
    )
    place = {r: f"r{i}" for i, r in enumerate(row_rules)}

    def line(rule: Rule, bad: Column, success: Column) -> Column:
        return F.struct(
            F.lit(name).alias("table"),
            F.lit(rule.kind).alias("rule"),
            F.lit(",".join(rule.columns)).alias("column"),
            F.lit(rule.params).alias("params"),
            F.col("n").alias("element_count"),
            bad.alias("unexpected_count"),
            success.alias("success"),
        )

    lines = []
    for rule in rules:
        if rule in place:
            bad = F.col(place[rule])
            lines.append(line(rule, bad, bad == 0))
            continue
        verdict = rule.schema_verdict(df) if rule.kind == "columns_match" or rule not in absent else False
        if verdict is not None:
            lines.append(line(rule, F.lit(0).cast("bigint"), F.lit(bool(verdict))))
    report = row.select(F.inline(F.array(*lines))) if lines else None
    for rule in rules:
        if rule.kind != "unique" or rule in absent:
            continue
        per_key = df.groupBy(*rule.columns).agg(F.count("*").alias("c"))
        found = per_key.agg(
            F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("bad"),
        )
        part = found.select(F.inline(F.array(line(rule, F.col("bad"), F.col("bad") == 0))))
        report = part if report is None else report.unionByName(part)
    if strict:
        failing = [r["rule"] + " " + r["column"] for r in report.where("NOT success").take(20)]
        if failing:
            raise ContractViolation(f"{name}: {'; '.join(failing)}")
    return report


def verdict(reports: list[DataFrame]) -> DataFrame:
    """(table, rules, failed_rules, success) per table."""
    whole = reports[0]
    for more in reports[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("table").agg(
        F.count("*").alias("rules"),
        F.count_if(~F.col("success")).alias("failed_rules"),
        F.bool_and("success").alias("success"),
    )
