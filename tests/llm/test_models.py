"""Quality rules, language ID and language-model scoring."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lexmill.llm import langid, lm, quality

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def test_base_counts(documents, corpus):
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in quality.judge(documents, None).collect())
    want = []
    for doc, text in corpus:
        text = text or ""
        w = SPLIT.findall(text)
        c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        cover = [False] * len(w)
        for i in range(len(w) - 4):
            if c[tuple(w[i : i + 5])] > 1:
                cover[i : i + 5] = [True] * 5
        lines = [x for x in text.split("\n") if SPLIT.search(x)]
        failed = len(w) < 10 or 100 * sum(cover) > 20 * len(w)
        want.append((doc, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), sum(cover), failed, not failed))
    assert got == sorted(want)


def test_quality_model(spark, make):
    rng = random.Random(8)
    good = [(i, make(rng, 60)) for i in range(200)]
    bad = [(1000 + i, " ".join(w.upper() + rng.choice(["!!", "$$$", "###"]) for w in make(rng, 60).split())) for i in range(200)]
    docs = spark.createDataFrame(good + bad + [(5000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 1000)) for d, _ in good[:80] + bad[:80]] + [(None, 1), (7, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.judge(docs, model).collect()
    right = [r["kept"] == (r["doc_id"] < 1000) for r in rows if not r["base_failed"]]
    assert np.mean(right) > 0.97 and all(0 <= r["probability"] <= 1 for r in rows)
    assert quality.train(docs, labels.filter("quality = 1")) is None and quality.train(docs.limit(0), labels) is None
    assert quality.judge(docs.limit(0), model).count() == 0
    many = docs.unionByName(spark.range(5000).selectExpr("1L as doc_id", "concat('some words that are good ', id) as text")).unionByName(spark.createDataFrame([(2, make(rng, 60_000))], "doc_id long, text string"))
    assert quality.train(many, labels, sample_rows=100) is not None
    kept = quality.judge(docs.selectExpr("doc_id", "text", "1 as kept"), model, carry=True)
    assert kept.columns[:2] == ["doc_id", "text"] and kept.schema["kept"].dataType.simpleString() == "boolean"


TONGUES = {"aa": ["the", "thing", "whine", "and", "of", "wher"], "bb": ["der", "schü", "ung", "keit", "öst", "pf"], "cc": ["que", "ción", "los", "ñar", "ado", "ezo"]}


def test_quality_trains_on_whole_texts(spark):
    """Texts of 1 MB whose last words alone show their class, and a bound of features that takes some rows only."""
    rng = random.Random(2)
    common = " ".join(f"w{rng.randrange(300)}" for _ in range(200_000))
    rows = [(i, common[: 1_000_000 - rng.randrange(1000)] + " " + " ".join([("fine" if i % 2 else "junk") + str(rng.randrange(5)) for _ in range(3000)]), i % 2) for i in range(24)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert {r["doc_id"]: r["kept"] for r in quality.judge(docs, model).collect()} == {i: bool(y) for i, _, y in rows}
    assert quality.train(docs, labels, most_features=1) is None


def test_fit_equals_plain_gradient_descent():
    rng = np.random.default_rng(4)
    n, width = 80, 12
    x = rng.random((n, width)) * (rng.random((n, width)) < 0.5)
    y = (x[:, 0] + 0.3 * rng.random(n) > x[:, 1] + 0.1).astype(np.int64)
    rows = [(np.flatnonzero(r).astype("<i4"), r[r > 0].astype("<f4")) for r in x]
    penalty = 0.05
    model = quality.fit(rows, y, penalty=penalty, rounds=300)
    order = np.random.default_rng(11).permutation(n)
    used = order[max(1, n // 4) :]
    scale = 1 / np.sqrt((x[used] ** 2).sum(axis=0) / len(used) + 1e-8)
    z, t = x[used] * scale, y[used]
    weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean()))
    w, b = np.zeros(width), 0.0
    for _ in range(20_000):
        pull = weight * (1 / (1 + np.exp(-(z @ w + b))) - t) / len(t)
        w, b = w - 0.5 * (z.T @ pull + penalty * w), b - 0.5 * pull.sum()
    assert np.allclose(model.weights.reshape(-1)[:width], w * scale, atol=2e-3) and abs(model.bias - b) < 2e-3


def test_language_id(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(TONGUES[t]) + rng.choice(TONGUES[t]) for _ in range(rng.randint(4, 60))), t, "s") for i in range(400) for t in [rng.choice("abc") * 2]]
    rows += [(900, None, "aa", "s"), (901, " 12 !! ", "bb", "s"), (902, "the thing of and", None, "s"), (None, "der keit ung", "bb", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = {r["doc_id"]: r for r in langid.identify(df).collect()}
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d in got if d is not None)
    held = [(got[d]["lang_pred"], t) for d, _, t, _ in rows[:400] if got[d]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.97 and len(held) > 50
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[902]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(df.limit(0)).count() == 0
    long = " ".join(rng.choice(TONGUES["aa"]) + rng.choice(TONGUES["aa"]) for _ in range(60_000))
    odd = spark.createDataFrame([(1, "² ½ ① Ⅷ", "aa", "s"), (2, long, None, "s"), (3, "ª", None, "s"), (2, long, None, "s")], df.schema)
    found = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(odd, langid.train(df)).collect())
    assert [f[1] for f in found] == ["und", "aa", "aa", found[3][1]] and found[3][1] != "und" and found[1][2] > 0.8 and found[1] == found[2]
    many = spark.range(9000).selectExpr("1000L as doc_id", "concat('the thing of and ', id) as text", "'aa' as lang", "'s' as lang_pred")
    assert langid.train(df.unionByName(many), sample_rows=500) is not None  # rows of one id are cut before they are collected
    assert {r["lang_pred"] for r in langid.identify(df.withColumn("lang", df["lang"].substr(9, 1))).collect()} <= {"und", ""}


def test_filter_levels():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 6000, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    levels = rng.integers(1, 6, len(keys))
    data, size = lm.filter_block(keys, levels, 10)
    assert size == levels.sum() * 10  # bits an entry
    got = lm.probed(keys, data, size)
    assert (got >= levels).all() and (got == levels).mean() > 0.9
    other = lm.probed(rng.integers(0, 2**63, 5000, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1), data, size)
    assert (other == 0).mean() > 0.95
    assert lm.level_of(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4] and lm.count_of(np.array([0, 1, 2])).tolist() == [0.0, 1.0, 2.5]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_model(words):
    """Unigram probability, bigram probability and counts of token lists by plain loops."""
    c, pairs, follow = Counter(), Counter(), {}
    for w in words:
        c.update(w)
        pairs.update(zip(["</s>", *w], w))
    for v, w in pairs:
        follow.setdefault(v, []).append(w)
    n, v = sum(c.values()), len(c)
    middle = lambda k: 1.5 * 2 ** (k.bit_length() - 1) - 0.5 if k else 0.0
    one = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    stored = {a: sum(middle(pairs[a, b]) for b in bs) for a, bs in follow.items()}

    def two(a, b):
        if a not in follow:
            return one(b)
        t, s = len(follow[a]), stored[a]
        return middle(pairs[a, b]) / (t + s) + t / (t + s) * one(b)

    return one, two, c, n


def test_model_is_a_distribution(corpus):
    one, two, c, _ = brute_model([SPLIT.findall(low(t)) + ["</s>"] for _, t in corpus[:40]])
    for v in ["</s>", *list(c)[:30], "never seen"]:
        assert math.isclose(sum(two(v, w) for w in [*c, "the unseen"]), 1, rel_tol=1e-9)


@pytest.mark.parametrize("limits", [{}, {"hot": 40}, {"hot": 40, "spread": 5, "filter_bits": 64}, {"filter_bits": 64}, {"hot": 300, "filter_bits": 64, "bits_per_entry": 40}], ids=str)
def test_scores(documents, corpus, limits):
    words = [(d, SPLIT.findall(low(t)) + ["</s>"]) for d, t in corpus]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    one, two, c, n = brute_model([w for d, w in words if not held(d)])
    got = sorted((r["doc_id"], r["n_tokens"], r["base_score"], r["n_known"], r["train_tokens"], r["held_out"], r["score"]) for r in lm.score_documents(documents, **limits).collect())
    want = sorted((d, len(w), sum(math.log10(one(x)) for x in w), sum(c[x] > 0 for x in w), n, held(d), sum(math.log10(two(a, b)) for a, b in zip(["</s>", *w], w))) for d, w in words)
    for g, w in zip(got, want, strict=True):
        assert g[:2] + g[3:6] == w[:2] + w[3:6] and math.isclose(g[2], w[2], rel_tol=1e-9)
        # Only chance hits of the filter differ, fewer where entries have more bits: each raises the score by 4 at most.
        assert w[6] - 1e-6 <= g[6] <= w[6] + 8 + (0.002 if "bits_per_entry" in limits else 0.05) * g[1]


@pytest.mark.parametrize("hot", [40, 1 << 17])
def test_scores_do_not_depend_on_how_the_filter_is_asked(documents, hot):
    sent, asked = (sorted((r["doc_id"], r["score"]) for r in lm.score_documents(documents, hot=hot, spread=10, filter_bits=n).collect()) for n in (1 << 28, 0))
    assert all(a[0] == b[0] and math.isclose(a[1], b[1], rel_tol=1e-12) for a, b in zip(sent, asked, strict=True))


def test_scores_of_nothing(nothing, spark):
    assert lm.score_documents(nothing).count() == 0
    only_held = spark.createDataFrame([(d, "a b") for d in range(40) if zlib.crc32(str(d).encode()) % 5 == 1], "doc_id long, text string")
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == 0.0 for r in lm.score_documents(only_held).collect())


def test_partitions_are_bounded_at_any_size(spark):
    from lexmill.llm import scratch

    assert scratch.partitions(7) == 7 and scratch.partitions(1 << 24) == scratch.MOST_PARTITIONS == 8192
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with scratch.sized(spark, 100 << 40):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_kernel_ridge_equals_the_explicit_one():
    """With all texts as landmarks the Nystrom model is kernel ridge regression on the centred features, solved by its own kernel matrix."""
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(words, 12)) for words in (["der", "und", "ich", "nicht"], ["the", "and", "not", "is"], ["le", "et", "pas", "je"]) for _ in range(12)]
    labels = [k for k in ("de", "en", "fr") for _ in range(12)]
    bits = np.concatenate([b.copy() for _, b in langid.presence(__import__("pyarrow").array(texts))])
    model = langid.fit(np.packbits(bits.astype(bool), axis=1), labels, landmarks=len(texts), ridge=1e-2)
    unit = bits / np.sqrt(bits.sum(axis=1, keepdims=True))
    kernel = (unit @ unit.T).astype(np.float64)
    n = len(texts)
    centre = np.eye(n) - 1 / n
    target = np.where(np.array(labels)[:, None] == np.array(model.languages)[None, :], 1.0, -1.0)
    dual = np.linalg.solve(centre @ kernel @ centre + 1e-2 * n * np.eye(n), centre @ target)
    want = centre @ kernel @ centre @ dual + target.mean(axis=0)
    got = model.scores(bits)
    assert np.allclose(got, want, atol=5e-3) and (got.argmax(axis=1) == want.argmax(axis=1)).all()


def test_language_model_and_limit_come_from_all_labelled_rows(spark):
    """Rows beyond ``sample_rows`` teach a language and lower the limit; the sums of tasks give the fit on all rows at once."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(TONGUES[t]) + rng.choice(TONGUES[t]) for _ in range(30)), t) for i in range(300) for t in [rng.choice("abc") * 2]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = langid.train(df, sample_rows=5)
    assert model.languages == ["aa", "bb", "cc"]
    own = [(t, k) for d, t, k in rows if zlib.crc32(str(d).encode()) % 4 != 2]
    bits = np.concatenate([b.copy() for _, b in langid.presence(__import__("pyarrow").array([t for t, _ in own]))])
    first = langid.basis(np.packbits(bits[:9].astype(bool), axis=1))
    sums = langid.Sums(first.white.shape[1])
    sums.add(first.features(bits), [k for _, k in own])
    x, target = first.features(bits), np.where(np.array([k for _, k in own])[:, None] == np.array(["aa", "bb", "cc"])[None, :], 1.0, -1.0)
    beta = np.linalg.solve((x - x.mean(0)).T @ (x - x.mean(0)) + 1e-3 * len(x) * np.eye(x.shape[1]), (x - x.mean(0)).T @ (target - target.mean(0)))
    assert np.allclose(langid.solved(first, sums, 1e-3).scores(bits), (x - x.mean(0)) @ beta + target.mean(0), atol=1e-3)
    held = [(d, s) for d, s in langid.predict(df, langid.train(df), carry=True).filter("lang_pred = lang").select("doc_id", "score").collect() if zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(held) > 50 and langid.least_score(df, langid.train(df), share=0.0) == pytest.approx(min(s for _, s in held), abs=1e-6)
