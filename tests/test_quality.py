import pytest

from clientele.operators import quality
from clientele.operators.quality import Rule


@pytest.fixture(scope="module")
def broken(spark):
    rows = [("a", "Mass", "p1"), ("a", "Gold", "p1"), (None, "Gold", "zz"), ("b", None, None), ("c", "Rare", "zz")]
    return spark.createDataFrame(rows, "k string, segment string, parent string")


@pytest.fixture(scope="module")
def parents(spark):
    return spark.createDataFrame([("p1",)], "p string")


def test_single_rules(broken, parents):
    assert quality.not_null(broken, "k").count() == 1
    assert [tuple(r) for r in quality.unique(broken, "k").collect()] == [("a", 2)]
    bad = {r["segment"]: r["n"] for r in quality.accepted_values(broken, "segment", ["Mass"]).collect()}
    assert bad == {"Gold": 2, "Rare": 1}
    assert [tuple(r) for r in quality.relationships(broken, "parent", parents, "p").collect()] == [("zz", 2)]


def test_suite_counts_each_kind(broken, parents):
    rules = [
        Rule("unique", "t", "k"), Rule("not_null", "t", "k"), Rule("not_null", "t", "segment"),
        Rule("accepted_values", "t", "segment", ("Mass",)), Rule("relationships", "t", "parent", parent=("p", "p")),
        Rule("accepted_values", "t", "parent", ("p1", "zz")),
    ]
    report = {r["regle"]: r["violations"] for r in quality.run_suite({"t": broken, "p": parents}, rules).collect()}
    assert [report[r.name] for r in rules] == [1, 1, 1, 2, 2, 0]


def test_suite_is_complete_and_clean(bank):
    rules = quality.suite_rules()
    assert len(rules) == 93
    report = quality.run_suite(bank.tested())
    assert report.count() == 93 and report.filter("violations > 0").isEmpty()


def test_expectations_see_blank_and_out_of_bounds(spark):
    nba = spark.createDataFrame([("a", " "), ("b", None), ("c", "x")], "customer_id string, next_best_action string")
    assert quality.expect(nba, quality.blank("next_best_action")).count() == 2
    risk = spark.createDataFrame([(-0.1,), (0.0,), (100.0,), (100.1,)], "risque_composite double")
    assert quality.expect(risk, quality.outside_bounds("risque_composite", 0, 100)).count() == 2


def test_validation(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    report = quality.validate(df, "t", ["a", "b"])
    assert (report.rows, report.null_pct) == (2, 25.0)
    with pytest.raises(ValueError):
        quality.validate(df, "t", ["a", "missing"])
    with pytest.raises(ValueError):
        quality.validate(df.filter("a > 5"), "t")


def test_schema_report_never_raises(bank):
    tables = bank.sources()
    tables.pop("offers")
    tables["loans"] = tables["loans"].drop("purpose")
    tables["cards"] = tables["cards"].filter("false")
    found = {r["table_name"]: r["erreurs"] for r in quality.check_schema(tables).collect()}
    assert found["offers"] == "table absente" and "purpose" in found["loans"] and found["cards"] == "table vide"
    assert found["customers"] == "" and len(found) == 10


def test_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5, 100)], "v double")
    assert quality.iqr_outliers(df, "v").first()["nb_aberrants"] == 1


def test_outliers_of_several_columns_leave_unknown_values_out(spark):
    nan = float("nan")
    a = spark.createDataFrame([(float(x),) for x in range(20)] + [(nan,), (None,), (500.0,)], "v double")
    none = spark.createDataFrame([(None,)], "w double")
    found = {r.colonne: r.nb_aberrants for r in quality.outliers_of({"a": (a, "v"), "none": (none, "w")}).collect()}
    assert found == {"a": 1, "none": 0}


def test_lineage_keeps_the_latest_row(spark, tmp_path):
    path = str(tmp_path / "lineage")
    for n in (3, 5):
        quality.record_lineage(quality.lineage({"t": spark.range(n)}, "s"), path)
    quality.record_lineage(quality.lineage_rows(spark, {"u": 7}, "s", is_synthetic=True), path)
    found = {r["table_name"]: (r["row_count"], r["is_synthetic"]) for r in quality.read_lineage(spark, path).collect()}
    assert found == {"t": (5, False), "u": (7, True)}


def test_duplicates_and_nulls(spark):
    loans = spark.createDataFrame([("L1", None), ("L1", 1), ("L2", None)], "loan_id string, x int")
    assert quality.dup_profile({"loans": loans}).first()["doublons"] == 1
    row = quality.null_profile({"loans": loans}).first()
    assert (row["colonne"], row["nulls"], row["pct"]) == ("x", 2, 66.7)


def test_salary_conflicts_ignore_case(spark):
    accounts = spark.createDataFrame([("A1", "C", False), ("A2", "C", True), ("A3", "C", None)],
                                     "account_id string, customer_id string, salary_domiciled_flag boolean")
    txn = spark.createDataFrame([("A1", "Monthly SALARY"), ("A2", "salary"), ("A3", "salary")], "account_id string, txn_type string")
    assert [r["account_id"] for r in quality.salary_flag_conflicts(accounts, txn).collect()] == ["A1"]
