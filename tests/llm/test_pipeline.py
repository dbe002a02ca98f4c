"""The corpus pipeline against brute force, and the SQL of the queries that have some."""

import os
import random
from fractions import Fraction

import corpus_pipeline
import pytest

from lexmill.llm import queries
from tests.llm.test_dedup import SPLIT, brute_components, brute_removed
from tests.llm.test_models import TONGUES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, corpus, make):
    rng = random.Random(12)
    junk = [(2000 + i, " ".join(w.upper() + rng.choice(["!!", "###"]) for w in make(rng, 40).split())) for i in range(40)]
    passage = make(rng, 60)
    good = [(3000 + i, make(rng, rng.randint(20, 90)) + (" " + passage if i % 9 == 0 else "")) for i in range(80)]
    rows = [(d, t, rng.choice(["aa", "aa", None]), "s", len(t or "")) for d, t in corpus if d != 707] + [(d, t, "bb", "s", len(t)) for d, t in junk + good]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 0, 0) for d, _ in junk[:25]] + [(d, 1, 0) for d, _ in good[:50]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").cache()
    names = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], tables).cache())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_duplicates", "substring_dedup", "best_fit_packing"]
    assert all(d.columns == names for d in seen[:5])
    rows = [sorted(((r["doc_id"], r["text"]) for r in d.collect()), key=repr) for d in seen[:5]]
    assert not {d for d, _ in rows[1]} & set(range(2000, 2040)) and len({d for d, _ in rows[1]} & set(range(3000, 3080))) >= 75
    assert all(len(SPLIT.findall(t)) >= 10 for _, t in rows[1])
    keep = {d for d, n, c in brute_components(rows[2], 5, Fraction(4, 5)) if d == c or not n}
    assert rows[3] == [r for r in rows[2] if r[0] in keep] and len(rows[3]) < len(rows[2])
    cut = {d: (n, gone) for d, n, gone, _ in brute_removed(rows[3], 50)}
    assert any(gone for _, gone in cut.values())
    for d, t in rows[4]:
        assert len(SPLIT.findall(t or "")) == cut[d][0] - cut[d][1]
    packed = seen[5].collect()
    assert {r["doc_id"] for r in packed} == {d for d, _ in rows[4]}
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in corpus_pipeline.run(spark, tables).collect()) == sorted((r["doc_id"], r["piece"], r["length"]) for r in packed)


def test_language_stage_rejects(spark):
    """Gibberish and texts of an unlearned language go; clean ones stay."""
    rng = random.Random(21)
    text = lambda parts: " ".join(rng.choice(parts) + rng.choice(parts) for _ in range(rng.randint(30, 80)))
    rows = [(i, text(TONGUES[t]), t) for i in range(600) for t in [rng.choice("abc") * 2]]
    rows += [(5000 + i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(400)), None) for i in range(40)]
    rows += [(6000 + i, text(["xar", "yolu", "zik", "qom", "bepi", "jva"]), None) for i in range(40)]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t)) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").cache()
    kept = [r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").select("doc_id").collect()]
    assert sum(d < 5000 for d in kept) >= 580
    assert sum(5000 <= d < 6000 for d in kept) <= 2 and sum(d >= 6000 for d in kept) <= 2
    without = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    assert corpus_pipeline.language_id(spark, without, "").count() == len(rows)


def test_odd_tables(spark, tmp_path, nothing):
    """Empty tables and columns of clashing names go through all stages."""
    names = ["tk", "gone", "hits", "kept", "probability", "n_words", "score", "lang_pred", "base_failed", "node", "row", "length"]
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    rng = random.Random(3)
    text = lambda t: " ".join(rng.choice(TONGUES[t]) + rng.choice(TONGUES[t]) for _ in range(60))
    rows = [(i, text(t), t, "s", 1, *(f"{n}{i}" for n in names)) for i in range(60) for t in [rng.choice("ab") * 2]]
    rows += [(70 + i, rows[0][1], "aa", "s", 1, *(f"{n}{70 + i}" for n in names)) for i in range(3)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    for where, docs in (("some", spark.createDataFrame(rows, kind)), ("none", spark.createDataFrame([], kind))):
        folder = str(tmp_path / where)
        docs.write.parquet(f"{folder}/documents.parquet")
        (labels if where == "some" else labels.limit(0)).write.parquet(f"{folder}/labels.parquet")
        for name, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, folder)
            assert docs.schema.simpleString() == spark.createDataFrame([], kind).schema.simpleString(), name
        got = docs.collect()
        assert all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names) and (len(got) > 40) == (where == "some")
        assert len({r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}) == len({r["doc_id"] for r in got})


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    want = con.sql(queries.ORACLE[name])
    got = queries.queries()[name](spark, sf).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
