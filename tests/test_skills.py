import pytest
from pyspark.sql import functions as F

from marketmarts.functions import skills
from marketmarts.functions.fixed_values import SKILL_TAXONOMY
from marketmarts.operators.checks import taxonomy_violations


def _extract(spark, text, hints, match="substring"):
    df = spark.createDataFrame([(text, hints)], "text string, hints array<string>")
    df = skills.with_haystack(df, F.col("text"))
    return df.select(skills.extract(F.col("_hay"), F.col("hints"), match)).first()[0]


def test_known_terms_are_extracted(spark):
    out = _extract(
        spark,
        "Looking for a Senior Data Engineer with Python, Spark and Kafka experience, "
        "plus a familiarity with AWS and Snowflake.",
        ["dbt"],
    )
    for expected in ("python", "spark", "kafka", "aws", "snowflake", "dbt"):
        assert expected in out
    assert out == sorted(set(out))


def test_substring_vs_token_boundaries(spark):
    text = "Heavy javascript stack, no Java required."
    assert _extract(spark, text, [], "substring") == ["java"]
    assert _extract(spark, "Heavy javascript stack.", [], "substring") == ["java"]
    assert _extract(spark, "Heavy javascript stack.", [], "token") == []
    assert _extract(spark, text, [], "token") == ["java"]


def test_substring_hits_inside_words(spark):
    assert _extract(spark, "Scalable storage on trusted hardware.", []) == ["data_warehouse", "rag", "rust", "scala"]
    assert _extract(spark, "Scalable storage on trusted hardware.", [], "token") == []


def test_punctuated_surfaces_never_match_text(spark):
    assert _extract(spark, "scikit-learn and a/b testing", []) == []
    assert _extract(spark, "scikit-learn and a/b testing", [], "token") == ["experimentation", "scikit-learn"]


def test_hints(spark):
    assert _extract(spark, "", ["go"]) == []
    assert _extract(spark, "", ["golang"]) == ["go"]
    assert _extract(spark, "Go services", []) == ["go"]
    assert _extract(spark, None, [" DBT ", "", None, "A/B testing", "excel"]) == ["dbt", "experimentation"]
    assert _extract(spark, None, None) == []


def test_unicode_text_is_not_erased(spark):
    # Chinese characters are word characters, so they do not become spaces.
    assert _extract(spark, "熟悉python與spark", []) == ["python", "spark"]
    assert _extract(spark, "熟悉 python 與 spark", [], "token") == ["python", "spark"]
    assert _extract(spark, "熟悉python與spark", [], "token") == []


def test_taxonomy_is_consistent(spark):
    assert len(SKILL_TAXONOMY) > 30
    index = skills.surface_index()
    for canonical, surfaces in SKILL_TAXONOMY.items():
        assert surfaces
        for s in surfaces:
            assert index[s.lower()] == canonical
    tax = skills.taxonomy_frame(spark)
    assert tax.count() == 82
    assert tax.select("skill").distinct().count() == 48
    assert taxonomy_violations(tax).count() == 0
    first = tax.first()
    assert first.surface_len == max(len(s) for ss in SKILL_TAXONOMY.values() for s in ss)


def test_surface_join_equals_testing_every_surface(spark):
    import random

    from marketmarts.functions import skills
    from marketmarts.functions.text import word_haystack_py

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 5)))
    surfaces = {" ".join(word() for _ in range(rnd.choice([1, 1, 1, 2, 3]))) for _ in range(11_000)} | {"C++", "a/b", "", "É"}
    table = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sorted(surfaces))], "skill string, surface string")
    texts = [(i, " ".join(rnd.choice([word(), word().upper(), ", ", "c++"]) for _ in range(rnd.randint(0, 40)))) for i in range(30)]
    texts += [(98, None), (99, ""), (7, "abc")]
    df = spark.createDataFrame(texts, "id long, text string")
    for match in skills.MATCH_MODES:
        out = skills.join_surfaces(df, table, "id", "text", match)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        want = []
        for i, t in texts:
            hay = word_haystack_py(t or "")
            for k, s in enumerate(sorted(surfaces)):
                pat = word_haystack_py(s) if match == "token" else s.lower()
                if pat.strip() and pat in hay:
                    want.append((i, f"s{k}", s.lower()))
        assert sorted(tuple(r) for r in out.collect()) == sorted(want) and want
    assert skills.join_surfaces(df, table.limit(0), "id", "text").count() == 0
    with pytest.raises(ValueError):
        skills.join_surfaces(df, table, "id", "text", "fuzzy")
