"""Golden cases of the text functions and plain functions."""

from pyspark.sql import functions as F

from lexmill.functions import plain
from lexmill.functions import text as T
from lexmill.functions.udfs import clean_aliases_udf, lenient_json_udf, primary_type_udf


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_normalize(spark):
    assert one(spark, T.normalize(F.col("v")), v="  Big  \t Data ") == "big data"
    assert one(spark, T.equivalence_key(F.col("v")), v="scikit-learn_ X") == "scikit learn x"
    assert one(spark, T.strip_punctuation(F.col("v")), v="C++ / C#, (x) Node.js!") == "c++ c# x node.js"
    assert one(spark, T.char_ngrams(F.col("v")), v="ab") == ["ab"]
    assert one(spark, T.char_ngrams(F.col("v")), v="a bcb") == ["a_b", "_bc", "bcb"]


def test_atomicity(spark):
    reasons = lambda v: one(spark, T.atomicity_reasons(F.col("v")), v=v)
    assert reasons("React/Angular") == ["slash"]
    assert reasons("Core Java") == ["contextual_prefix"]
    assert reasons("Advanced Python 3, and (x) 64 bit") == ["comma", "parentheses", "and", "contextual_prefix", "version_like"]
    assert reasons("Kafka") == []


def test_rewrite_decisions(spark):
    decide = lambda v: tuple(one(spark, T.rewrite_decision(F.col("v")), v=v))
    assert decide("Data Analysis and Visualization")[:2] == ("split_on_and", ["Data Analysis", "Visualization"])
    assert decide("React/Angular")[:2] == ("split_on_slash", ["React", "Angular"])
    assert decide("Generative Adversarial Networks (GAN)") == ("remove_parentheses", ["Generative Adversarial Networks"], "GAN")
    assert decide("C/C++")[0] == "needs_exception"
    assert decide("Kafka")[:2] == ("keep", ["Kafka"])


def test_tags_and_slugs(spark):
    split = lambda v: tuple(one(spark, T.skill_and_tag(F.col("v")), v=v))
    assert split("Docker [Containerization]") == ("Docker", "Containerization")
    assert split("AWS [Cloud_Platforms]") == ("AWS", "Cloud Platforms")
    assert split("Docker") == ("Docker", None)
    assert one(spark, T.status_slug(F.col("v")), v=" Ready!! now ") == "ready_now"
    assert one(spark, T.status_slug(F.col("v")), v="--") == "unknown"
    assert one(spark, T.date_prefix(F.col("v")), v="2024-01-02T03") == "2024-01-02"
    assert one(spark, T.is_acronym_like(F.col("v")), v="TDD") is True
    assert one(spark, T.is_acronym_like(F.col("v")), v="Docker") is False
    assert one(spark, T.acronym(F.col("v")), v="Test-driven Development") == "tdd"


def test_aliases(spark):
    clean = lambda aliases, canonical: plain.clean_aliases(aliases, canonical)
    assert clean(["docker dive"], "dive") == ["docker dive"]
    assert clean(["alias1", "alias2", "alias1/alias2"], "Sample Canonical") == ["alias1", "alias2"]
    assert clean(["test-driven development", "Test Driven Development TDD", "test driven development (TDD)"], "TDD") == ["test driven development"]
    assert clean(None, "x") == []
    got = one(spark, clean_aliases_udf(F.col("a"), F.col("c")), a=["a_b", "a-b", "AWS (Amazon)"], c="x")
    assert got == ["a b", "AWS (Amazon)"]


def test_lenient_json(spark):
    assert plain.lenient_json("```json\n{\"a\": 1}\n```") == {"a": 1}
    assert plain.lenient_json("so: [1, 2] done") == [1, 2]
    assert plain.lenient_json("nothing") is None and plain.lenient_json(None) is None
    assert plain.lenient_rows('<think>x</think>[{"a": True}, {"b": None}, {"c":') == [{"a": True}, {"b": None}]
    assert plain.alias_answer('{"x": 1} {"is_alias": false}') == {"is_alias": False}
    assert plain.primary_type({"Type": ["", {"name": "Tool"}]}) == "Tool"
    assert plain.functional_roles(["A", "a", " B "]) == ["A", "B"]
    assert one(spark, lenient_json_udf(F.col("v")), v="x {\"b\": 1, \"a\": 2}") == '{"a": 2, "b": 1}'
    assert one(spark, primary_type_udf(F.col("v")), v='{"primary_type": "Library"}') == "Library"
