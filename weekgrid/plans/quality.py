"""Data contract queries."""

from __future__ import annotations


from weekgrid.operators import contracts
from weekgrid.plans.profile import typed_features
from weekgrid.plans.registry import query
from weekgrid.plans.shared import panel
from weekgrid.sources.panel import table



def row(table_name, rule, column, params, n, bad):
    return (
        f"SELECT '{table_name}' AS \"table\", '{rule}' AS rule, '{column}' AS column, '{params}' AS params,"
        f" {n} AS element_count, {bad} AS unexpected_count, {bad} = 0 AS success"
    )


def between_sql(name, source, column, low, high):
    test = " OR ".join(
        t for t in (f"{column} < {low}" if low is not None else "", f"{column} > {high}" if high is not None else "") if t
    )
    return row(name, "between", column, f"[{low}, {high}]", "count(*)", f"count(*) FILTER ({test})") + f" FROM {source}"


def suite_sql(name, source, rules):
    """A suite as SQL: one line per rule; schema rules hold on these tables."""
    lines = []
    for r in rules:
        column = ",".join(r.columns)
        first = r.columns[0]
        if r.kind == "between":
            lines.append(between_sql(name, source, first, r.low, r.high))
            continue
        if r.kind == "unique":
            n, bad = "sum(c)::BIGINT", "coalesce(sum(c) FILTER (c > 1), 0)::BIGINT"
            origin = f"(SELECT count(*) AS c FROM {source} GROUP BY {column})"
        else:
            n, origin = "count(*)", source
            bad = {
                "not_null": f"count(*) - count({first})",
                "in_set": f"count(*) FILTER ({first} NOT IN ({', '.join(map(repr, r.values))}))",
            }.get(r.kind, "0::BIGINT")
        lines.append(row(name, r.kind, column, r.params, n, bad) + f" FROM {origin}")
    return "\nUNION ALL\n".join(lines)


@query("dq_silver_sales", suite_sql("sales", "sales", contracts.SALES))
def dq_silver_sales(spark, sf_dir):
    return contracts.run(panel(spark, sf_dir).silver_sales, "sales", contracts.SALES)


@query("dq_silver_features", suite_sql("features", "features", contracts.FEATURES))
def dq_silver_features(spark, sf_dir):
    return contracts.run(panel(spark, sf_dir).silver_features, "features", contracts.FEATURES)


@query("dq_silver_stores", suite_sql("stores", "stores", contracts.STORES))
def dq_silver_stores(spark, sf_dir):
    return contracts.run(panel(spark, sf_dir).silver_stores, "stores", contracts.STORES)


@query("dq_gold", suite_sql("gold", "gold", contracts.GOLD))
def dq_gold(spark, sf_dir):
    return contracts.run(panel(spark, sf_dir).stored_gold, "gold", contracts.GOLD)


@query(
    "dq_value_bounds",
    "\nUNION ALL\n".join(
        [
            between_sql("raw_sales", "raw_sales", "weekly_sales", 0.0, None),
            between_sql("raw_sales", "raw_sales", "store", 1, 20),
            between_sql("raw_sales", "raw_sales", "dept", 2, None),
        ]
    ),
)
def dq_value_bounds(spark, sf_dir):
    """Bounds on the uncleaned sales, where returns break them."""
    rules = [
        contracts.between("weekly_sales", 0.0),
        contracts.between("store", 1, 20),
        contracts.between("dept", 2),
    ]
    return contracts.run(panel(spark, sf_dir).sales, "raw_sales", rules)


@query(
    "dq_not_null",
    "\nUNION ALL\n".join(
        row("raw_features", "not_null", c, "", "count(*)", f"count(*) - count({e})") + " FROM raw_features"
        for c, e in [
            ("date", "date"),
            ("cpi", "try_cast(cpi AS DOUBLE)"),
            ("unemployment", "try_cast(unemployment AS DOUBLE)"),
            ("markdown1", "try_cast(markdown1 AS DOUBLE)"),
        ]
    ),
)
def dq_not_null(spark, sf_dir):
    rules = [contracts.not_null(c) for c in ("date", "cpi", "unemployment", "markdown1")]
    return contracts.run(typed_features(spark, sf_dir), "raw_features", rules)


@query(
    "dq_compound_unique",
    row("lineitem", "unique", "l_orderkey,l_linenumber", "", "sum(c)::BIGINT", "coalesce(sum(c) FILTER (c > 1), 0)::BIGINT")
    + " FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)",
)
def dq_compound_unique(spark, sf_dir):
    return contracts.run(
        table(spark, sf_dir, "lineitem"), "lineitem", [contracts.unique("l_orderkey", "l_linenumber")]
    )


@query(
    "dq_column_unique",
    "\nUNION ALL\n".join(
        row("orders", "unique", k, "", "sum(c)::BIGINT", "coalesce(sum(c) FILTER (c > 1), 0)::BIGINT")
        + f" FROM (SELECT count(*) AS c FROM orders GROUP BY {k})"
        for k in ("o_orderkey", "o_custkey")
    ),
)
def dq_column_unique(spark, sf_dir):
    rules = [contracts.unique("o_orderkey"), contracts.unique("o_custkey")]
    return contracts.run(table(spark, sf_dir, "orders"), "orders", rules)


@query(
    "dq_in_set",
    "\nUNION ALL\n".join(
        [
            row("stores", "in_set", "type", "A,B", "count(*)", "count(*) FILTER (type NOT IN ('A', 'B'))") + " FROM stores",
            row("stores", "in_set", "store", "1,2,3", "count(*)", "count(*) FILTER (store NOT IN (1, 2, 3))")
            + " FROM stores",
        ]
    ),
)
def dq_in_set(spark, sf_dir):
    rules = [contracts.in_set("type", "A", "B"), contracts.in_set("store", 1, 2, 3)]
    return contracts.run(panel(spark, sf_dir).silver_stores, "stores", rules)


@query(
    "dq_suite_report",
    """SELECT 'raw_sales' AS "table", 8::BIGINT AS rules,
              (SELECT CAST(count(*) FILTER (weekly_sales < 0) > 0 AS BIGINT) FROM raw_sales) AS failed_rules,
              (SELECT count(*) FILTER (weekly_sales < 0) = 0 FROM raw_sales) AS success
       UNION ALL SELECT 'sales', 8, 0, true
       UNION ALL SELECT 'features', 21, 0, true
       UNION ALL SELECT 'stores', 5, 0, true""",
)
def dq_suite_report(spark, sf_dir):
    """Verdict per table; the uncleaned sales must fail on negative weeks."""
    p = panel(spark, sf_dir)
    return contracts.verdict(
        [
            contracts.run(p.sales, "raw_sales", contracts.SALES),
            contracts.run(p.silver_sales, "sales", contracts.SALES),
            contracts.run(p.silver_features, "features", contracts.FEATURES),
            contracts.run(p.silver_stores, "stores", contracts.STORES),
        ]
    )


# A table that breaks each schema rule: doubled rows, no date, the store as text, a
# column under another name. The lines below are written out by hand.
BROKEN_RULES = [
    contracts.columns_match("store", "dept", "date", "weekly_sales", "isholiday"),
    contracts.columns_match("store", "dept", "weekly_sales", "holiday"),
    contracts.exists("date"),
    contracts.exists("dept"),
    contracts.type_in("store", contracts.INTS),
    contracts.type_in("dept", contracts.INTS),
    contracts.between("weekly_sales", 0.0),
    contracts.unique("store", "dept"),
    contracts.not_null("date"),
]
BROKEN_SQL = """
    SELECT 'broken' AS "table", rule, "column", params, 2 * n AS element_count, bad AS unexpected_count, success
    FROM (SELECT count(*) AS n FROM sales),
    LATERAL (VALUES
        ('columns_match', 'store,dept,date,weekly_sales,isholiday', '', 0::BIGINT, false),
        ('columns_match', 'store,dept,weekly_sales,holiday', '', 0::BIGINT, true),
        ('exists', 'date', '', 0::BIGINT, false),
        ('exists', 'dept', '', 0::BIGINT, true),
        ('type_in', 'store', 'smallint,int,bigint', 0::BIGINT, false),
        ('type_in', 'dept', 'smallint,int,bigint', 0::BIGINT, true),
        ('between', 'weekly_sales', '[0.0, None]', 0::BIGINT, true),
        ('unique', 'store,dept', '', 2 * n, false),
        ('not_null', 'date', '', 0::BIGINT, false)) AS r(rule, "column", params, bad, success)"""


def broken_report(spark, sf_dir):
    sales = panel(spark, sf_dir).silver_sales
    broken = sales.selectExpr("cast(store AS string) AS store", "dept", "weekly_sales", "isholiday AS holiday")
    return contracts.run(broken.unionByName(broken), "broken", BROKEN_RULES)


@query("dq_broken_schema", BROKEN_SQL)
def dq_broken_schema(spark, sf_dir):
    return broken_report(spark, sf_dir)


@query(
    "dq_broken_verdict",
    """SELECT 'broken' AS "table", CAST(9 AS BIGINT) AS rules, CAST(5 AS BIGINT) AS failed_rules, false AS success
       FROM sales GROUP BY ALL HAVING count(*) > 0""",
)
def dq_broken_verdict(spark, sf_dir):
    """Five of the nine rules fail, so the table does."""
    return contracts.verdict([broken_report(spark, sf_dir)])
