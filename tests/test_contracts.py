import pytest

from weekgrid.operators import contracts


@pytest.fixture()
def table(spark):
    rows = [(1, "A", 5.0), (1, "B", None), (2, "X", -1.0)]
    return spark.createDataFrame(rows, "store int, type string, v double")


def outcome(df, *rules):
    return {(r["rule"], r["column"]): (r["unexpected_count"], r["success"]) for r in contracts.run(df, "t", list(rules)).collect()}


def test_every_rule_kind(table):
    got = outcome(
        table,
        contracts.columns_match("store", "type", "v"),
        contracts.exists("v"),
        contracts.exists("absent"),
        contracts.between("v", 0.0),
        contracts.not_null("v"),
        contracts.in_set("type", "A", "B"),
        contracts.unique("store"),
        contracts.unique("store", "type"),
        contracts.type_in("store", contracts.INTS),
        contracts.type_in("v", contracts.INTS),
    )
    assert got == {
        ("columns_match", "store,type,v"): (0, True),
        ("exists", "v"): (0, True),
        ("exists", "absent"): (0, False),
        ("between", "v"): (1, False),
        ("not_null", "v"): (1, False),
        ("in_set", "type"): (1, False),
        ("unique", "store"): (2, False),
        ("unique", "store,type"): (0, True),
        ("type_in", "store"): (0, True),
        ("type_in", "v"): (0, False),
    }


def test_rule_on_absent_column_fails_without_error(table):
    assert outcome(table, contracts.between("absent", 0.0), contracts.not_null("store")) == {
        ("between", "absent"): (0, False),
        ("not_null", "store"): (0, True),
    }


def test_missing_column_breaks_column_match(table):
    assert outcome(table, contracts.columns_match("store", "type", "v", "more"))[
        ("columns_match", "store,type,v,more")
    ] == (0, False)


def test_strict_raises(table):
    with pytest.raises(contracts.ContractViolation, match="between v"):
        contracts.run(table, "t", [contracts.between("v", 0.0)], strict=True)


def test_clean_tables_pass_their_contracts(small_panel, small_gold):
    reports = [
        contracts.run(small_panel.silver_sales, "sales", contracts.SALES, strict=True),
        contracts.run(small_panel.silver_features, "features", contracts.FEATURES, strict=True),
        contracts.run(small_panel.silver_stores, "stores", contracts.STORES, strict=True),
        contracts.run(small_gold, "gold", contracts.GOLD, strict=True),
    ]
    assert all(r["success"] for r in contracts.verdict(reports).collect())
