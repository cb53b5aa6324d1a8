import pytest
from pyspark.sql import functions as F

from marketmarts.functions import classify


def _roles(spark, titles):
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    r = classify.role(F.col("title"))
    return [(x[0], x[1]) for x in df.select(r.role_canonical, r.role_family).collect()]


def test_role_rules_first_hit_wins(spark):
    out = _roles(spark, ["Lead Cloud Data Engineer", "HTML Engineer", "Product Manager", "Data Engineer",
                         "Sr. ML Engineer", "MLOps Engineer", "Generative AI Engineer", "BI analyst", None])
    assert out == [
        ("senior_data_engineer", "data_engineering"),
        ("ml_engineer", "ml_engineering"),  # pattern has no left boundary
        ("other", "other"),
        ("data_engineer", "data_engineering"),
        ("ml_engineer", "ml_engineering"),
        ("mlops_engineer", "ml_engineering"),
        ("ai_engineer", "ai_engineering"),
        ("other", "other"),
        ("other", "other"),
    ]


@pytest.mark.parametrize(
    "title,years,expected",
    [
        ("Senior Manager", None, "senior"),
        ("Lead Data Engineer", None, "principal"),
        ("實習 工程師", None, "intern"),
        ("資料工程師實習生", None, "mid"),
        ("資深 工程師", 1, "senior"),
        ("Data Engineer", None, "mid"),
        ("Data Engineer", 0, "junior"),
        ("Data Engineer", 1, "junior"),
        ("Data Engineer", 2, "mid"),
        ("Data Engineer", 3, "mid"),
        ("Data Engineer", 4, "senior"),
        ("Data Engineer", 6, "senior"),
        ("Data Engineer", 7, "principal"),
        ("Head of Data", 9, "manager"),
        ("Jr. Analyst", 9, "junior"),
    ],
)
def test_seniority(spark, title, years, expected):
    df = spark.createDataFrame([(title, years)], "title string, years int")
    assert df.select(classify.seniority(F.col("title"), F.col("years"))).first()[0] == expected


@pytest.mark.parametrize(
    "name,expected",
    [
        ("Foo Co., Ltd.", "Foo"),
        ("TSMC", "Taiwan Semiconductor Manufacturing"),
        ("  tsmc ", "Taiwan Semiconductor Manufacturing"),
        ("台積電", "Taiwan Semiconductor Manufacturing"),
        ("TSMC Ltd.", "TSMC"),
        ("The Company Store", "The  Store"),
        ("Inc.", "Inc."),
        ("", "unknown"),
        (None, "unknown"),
        ("Taiwan Semiconductor Manufacturing Co.", "Taiwan Semiconductor Manufacturing Co"),
        ("Acme Corporation", "Acme"),
        ("Beta corp.", "Beta"),
    ],
)
def test_company_canonical(spark, name, expected):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.select(classify.canonical_company(F.col("name"))).first()[0] == expected
