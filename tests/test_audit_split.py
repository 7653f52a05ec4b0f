import pytest
from pyspark.sql import functions as F

from tierwise.functions.quantiles import exact_quantiles
from tierwise.operators import audit, split


def test_schema_errors_name_the_target_first(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="target"):
        audit.validate_schema(df, "y", ["z"])
    with pytest.raises(ValueError, match="z"):
        audit.validate_schema(df, "a", ["b", "z"])
    audit.validate_schema(df, "a", ["b"])


def test_booleans_are_categories_in_audits_and_numbers_as_features(spark):
    df = spark.createDataFrame([(1, True, "x", 2.0)], "a int, flag boolean, s string, d double")
    assert audit.numeric_columns(df) == ["a", "d"]
    assert audit.feature_types(df) == (["a", "flag", "d"], ["s"])


def test_audit_of_empty_and_all_null_columns(spark):
    empty = spark.createDataFrame([], "a double, y int")
    assert audit.missing_percent(empty).where("missing_percent is not null").count() == 0
    assert audit.duplicate_rows(empty).first()[0] == 0
    nulls = spark.createDataFrame([(None, 1), (None, 0), (float("nan"), 0)], "a double, y int")
    rows = {r["column"]: r for r in audit.iqr_outliers(nulls).collect()}
    assert rows["a"]["q1"] is None and rows["a"]["outlier_count"] == 0
    assert {r["column"]: r["missing"] for r in audit.missing_percent(nulls).collect()} == {"a": 3, "y": 0}
    assert audit.audit_report(nulls, "y", ["y"]).where("section = 'iqr' and name = 'y'").count() == 0


def test_null_class_is_counted_and_default_rules_apply(spark):
    df = spark.createDataFrame(
        [(130.0, "12", 0), (50.0, "abc", 1), (-1.0, "95", None), (40.0, None, 0)], "age double, bmi string, y int"
    )
    classes = {r["class"]: r["count"] for r in audit.class_distribution(df, "y").collect()}
    assert classes == {None: 1, 0: 2, 1: 1}
    broken = {r["rule"]: r["violations"] for r in audit.domain_violations(df).collect()}
    assert broken == {"age_out_of_range": 2, "bmi_out_of_range": 1, "glucose_out_of_range": 0}


def test_quantiles_by_narrowing_equal_the_direct_way(spark):
    df = spark.range(20_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000003)) / 7.0).alias("wide"),
        F.when(F.col("id") % 3 > 0, F.lit(5.0)).otherwise(F.col("id") % 11).alias("ties"),
        F.when(F.col("id") % 4 > 0, F.col("id").cast("double")).alias("gaps"),
        F.lit(None).cast("double").alias("nothing"),
    )
    columns, probs = ["wide", "ties", "gaps", "nothing"], [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    assert exact_quantiles(df, columns, probs, small=50) == exact_quantiles(df, columns, probs)


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    once = split.stratified_split(df, "y", "key", 0.2, 0.15, 42)
    sizes = {(r["split"], r["class"]): r["count"] for r in split.split_summary(once, "y").collect()}
    assert sizes == {
        ("test", 0): 180, ("valid", 0): 135, ("train", 0): 585,
        ("test", 1): 20, ("valid", 1): 15, ("train", 1): 65,
    }
    again = split.stratified_split(df.repartition(7), "y", "key", 0.2, 0.15, 42)
    assert once.exceptAll(again).isEmpty()
    other = split.stratified_split(df, "y", "key", 0.2, 0.15, 43)
    assert not once.exceptAll(other).isEmpty()
    assert split.train_and_valid(once).count() == 800


def test_split_sizes_are_checked(spark):
    df = spark.range(10).selectExpr("id as key", "cast(id % 2 as int) as y")
    for test, val in ((0.0, 0.2), (1.0, 0.2), (0.2, 0.0), (0.5, 0.5)):
        with pytest.raises(ValueError):
            split.stratified_split(df, "y", "key", test, val, 1)


def test_assigning_a_split_shuffles_nothing(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id as key", "cast(user_id % 2 as int) as y")
    for made in (
        split.stratified_split(df, "y", "key", 0.2, 0.15, 42),
        split.stratified_folds(df, "y", "key", 5, 42),
    ):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan


def test_many_classes_are_split_as_few_are(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id as key", "if(id % 40 = 0, null, id % 39) as y")
    few = [split.stratified_split(df, "y", "key", 0.2, 0.15, 5), split.stratified_folds(df, "y", "key", 4, 5)]
    monkeypatch.setattr(split, "MAX_CLASSES", 10)
    many = [split.stratified_split(df, "y", "key", 0.2, 0.15, 5), split.stratified_folds(df, "y", "key", 4, 5)]
    for a, b in zip(few, many):
        assert a.columns == b.columns and sorted(a.collect(), key=lambda r: r["key"]) == sorted(b.collect(), key=lambda r: r["key"])


def test_duplicate_rows_by_digest(spark):
    rows = [(1, None, "a", [1.0]), (None, 1, "a", [1.0]), (1, None, "a", [1.0]), (1, None, "a", [1.0]), (2, 2, None, None), (2, 2, None, None), (3, 3, "b", [0.0]), (3, 3, "b", [-0.0])]
    df = spark.createDataFrame(rows, "a int, `b c` int, t string, v array<double>")
    want = df.count() - df.distinct().count()
    assert audit.duplicate_rows(df).first()[0] == want >= 3
    assert audit.duplicate_rows(df.limit(0)).first()[0] == 0
    assert audit.duplicate_rows(df.distinct()).collect()[0]["duplicate_rows"] == 0
    plan = audit.duplicate_rows(df.select("a", "t").distinct())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no digest stands twice, so no row is shuffled
