"""No row is lost for a NULL flag, group, value or column order."""

import decimal

import pytest
from pyspark.sql import functions as F

from clientele.functions.ordered import exact_quantiles, hash_rank, prefix_sums
from clientele.operators import semantic, serve, staging, synth
from clientele.plans.refresh import current_version, open_gold
from clientele.plans.warehouse import Warehouse
from clientele.sources.bank_tables import ROW_SOURCES, bank_table
from clientele.sources.readers import read_table
from clientele.sources.schemas import COLUMNS

DATA = "/root/testdata/sf0.001"


def test_rows_with_a_null_flag_count_as_observed(spark):
    def tables(name):
        rows = bank_table(spark, DATA, name)
        if name != "customers":
            return rows
        return rows.withColumn("is_synthetic", F.expr("if(substring(customer_id, 9, 1) in ('0', '3'), null, is_synthetic)"))

    warehouse = Warehouse(tables)
    given = tables("customers")
    assert given.filter("is_synthetic is null").count() > 0
    assert warehouse.table("customers").count() == given.count()
    real, made = warehouse.twins("customers")
    assert real.count() + made.count() == given.count()


def test_staging_takes_a_null_flag_as_observed(spark):
    rows = spark.createDataFrame([(1, None), (2, True), (3, False)], "id int, is_synthetic boolean")
    assert [r.is_synthetic for r in staging.tag_real(rows).orderBy("id").collect()] == [False, True, False]


def test_derived_tables_use_every_given_row(spark):
    sizes = {t: spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("customer", "orders", "lineitem", "events", "nation", "region")}
    rows = {t: bank_table(spark, DATA, t).count() for t in ROW_SOURCES}
    assert rows["customers"] == sizes["customer"] and rows["transactions"] == sizes["lineitem"]
    assert rows["loans"] == rows["offers"] == sizes["orders"] and rows["interactions"] + rows["complaints"] == sizes["events"]
    assert rows["branches"] == sizes["nation"] and rows["channels"] == sizes["region"] == 5
    customers = bank_table(spark, DATA, "customers").select("customer_id")
    for t in ("accounts", "cards", "loans", "transactions"):
        assert bank_table(spark, DATA, t).join(customers, "customer_id", "left_anti").isEmpty()


def test_groups_without_a_name_are_groups(spark):
    rows = spark.createDataFrame([(None, float(i)) for i in range(5)] + [("a", 1.0), ("a", 3.0)], "g string, v double")
    median = {r.g: r.m for r in exact_quantiles(rows, "v", {"m": 0.5}, ["g"]).collect()}
    assert median == {None: 2.0, "a": 2.0}
    counts = rows.withColumn("n", F.lit(1))
    assert prefix_sums(counts, "v", ["n"], ["g"]).agg(F.max("cum_n")).first()[0] == 5
    ranked = hash_rank(rows.withColumn("h", F.col("v").cast("long")), "h", "v", ["g"])
    assert sorted(r["rank"] for r in ranked.filter("g is null").collect()) == [1, 2, 3, 4, 5]


def test_nan_is_a_missing_value(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    assert exact_quantiles(rows, "v", {"m": 0.5}).first()["m"] == 2.0
    assert synth.ks_2samp(rows, rows, "v").first()["n_a"] == 2


def test_large_decimals_stay_apart(spark):
    values = [decimal.Decimal(f"90071992547409{x}") for x in ("30.01", "31.01", "32.02")]
    rows = spark.createDataFrame([(v,) for v in values], "v decimal(25,2)")
    assert exact_quantiles(rows, "v", {"m": 0.5}).first()["m"] == float(values[1])


@pytest.mark.parametrize("text", [
    "FROM t INSERT OVERWRITE DIRECTORY '/tmp/never' USING csv SELECT *",
    "WITH x AS (SELECT 1 AS a) INSERT OVERWRITE DIRECTORY '/tmp/never' USING csv SELECT * FROM x", "DROP VIEW t", "SET a = b",
])
def test_only_queries_run(spark, text):
    with pytest.raises(ValueError, match="only SELECT"):
        serve.query(spark, {"t": spark.range(3)}, text)


def test_queries_may_begin_with_comments_and_leave_no_view_behind(spark):
    spark.range(7).createOrReplaceTempView("t")
    for text in ("-- all\nSELECT count(*) AS n FROM t", "(SELECT count(*) AS n FROM t)", "WITH x AS (SELECT * FROM t) SELECT count(*) AS n FROM x -- end"):
        assert serve.query(spark, {"t": spark.range(3)}, text).first()["n"] == 3
    assert spark.table("t").count() == 7
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("_")] == []


def test_csv_columns_are_read_by_name(spark, tmp_path):
    columns = [c for c in COLUMNS["branches"]]
    rows = spark.createDataFrame([tuple(f"{c}-1" for c in columns)], columns)
    rows.select("district", F.lit("x").alias("more"), *[c for c in columns if c != "district"]).write.option("header", True).csv(f"{tmp_path}/branches")
    read = read_table(spark, str(tmp_path), "branches", "csv")
    assert read.columns == columns and read.first().asDict() == {c: f"{c}-1" for c in columns}


def test_nothing_is_published_before_the_first_run(spark, tmp_path):
    assert current_version(spark, str(tmp_path)) is None
    with pytest.raises(ValueError, match="nothing published"):
        open_gold(spark, str(tmp_path), "customer_360")


def test_spine_spans_the_data(spark):
    stamps = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2020-02-27 05:00:00'), (timestamp_ntz'2020-03-01 01:00:00') AS t(s)")
    assert [str(r[0]) for r in semantic.spine_over(stamps, "s").orderBy(F.col("date_day")).collect()] == [
        "2020-02-27", "2020-02-28", "2020-02-29", "2020-03-01"]
    assert semantic.spine_over(stamps.limit(0), "s").count() == 0
