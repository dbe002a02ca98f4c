"""Jaccard join and substring dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from lexmill.llm import jaccard, substring

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k, t):
    sets = [shingles(x, k) for _, x in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= t * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    low = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = root(i)
            low[r] = doc if low[r] is None else min(low[r], doc)
    return sorted((doc, len(sets[i]), low[root(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("k,t,rare", [(3, "9/10", 8), (3, "9/10", 1), (5, "4/5", 2)])
def test_components(spark, documents, corpus, k, t, rare):
    got = jaccard.near_duplicate_components(documents, k, t, rare_max=rare).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(corpus, k, Fraction(t))


def test_dense_family(spark):
    """Many near copies of one text: chains of links among copies that don't link with the original."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.sample(range(60), rng.randint(0, 4)):
            w[at] = f"e{rng.randint(0, 3)}"
        rows.append((i, " ".join(w)))
    got = jaccard.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, "9/10", rare_max=2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows, 3, Fraction(9, 10))


def test_null_ids_and_empty_table(spark, nothing):
    rows = [(None, "a b c d e f"), (9, "a b c d e f"), (None, "q r s t"), (4, None)]
    got = jaccard.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, "9/10").collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(None, 4, 9), (9, 4, 9), (None, 2, None), (4, 0, 4)}
    assert jaccard.near_duplicate_components(nothing).count() == 0


def bitmap(tokens, bits=20):
    marks = np.zeros(1 << bits, dtype=bool)
    marks[(tokens >> np.uint64(64 - bits)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little")


def test_frequent_cells(spark, documents, corpus):
    df = defaultdict(int)
    for _, text in corpus:
        for token in set(np.concatenate([t for t in jaccard._rows(jaccard.pa.array([text or ""]), 3)]).tolist()):
            df[token] += 1
    for bits, rare in ((26, 2), (12, 1), (26, 10**6)):
        want = bitmap(np.array([t for t, n in df.items() if n > rare], dtype=np.uint64), bits)
        assert (jaccard.frequent_cells(documents, 3, rare, bits) == want).all()


def test_hot_nodes_are_looked_up(spark):
    rows = [(i, "one text that has very many copies") for i in range(3000)] + [(5000 + i, f"other text number {i} of all the rest") for i in range(30)]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, "9/10").collect()}
    assert got == {(d, 0 if d < 3000 else d) for d, _ in rows}


def test_index_entries_cover_pairs():
    """Every pair over the threshold shares an entry that the join looks at, for any frequent class."""
    rng = np.random.default_rng(3)
    universe = rng.integers(0, 2**63, 400, dtype=np.int64).astype(np.uint64)
    t = Fraction(4, 5)
    for trial in range(300):
        make = jaccard._Prefix(t, bitmap(rng.choice(universe, rng.integers(0, 300), replace=False)))
        x = set(rng.choice(universe, rng.integers(4, 80), replace=False).tolist())
        y = set(x)
        for _ in range(rng.integers(0, 1 + len(x) // 6)):
            y.discard(rng.choice(list(y)))
            y.add(int(rng.choice(universe)))
        both = len(x & y)
        if Fraction(both, len(x | y)) < t:
            continue
        (ex, _, gx), (ey, _, gy) = (make.entries(np.array(sorted(s), dtype=np.uint64)) for s in (x, y))
        room = gx + gy
        fits = [e for e in set(ex.tolist()) & set(ey.tolist()) if e & 63 == 63 or (room > -1e-3 and (e & 63) == make.level(max(room, 0.0)))]
        assert fits, (trial, len(x), len(y), both)


@pytest.mark.parametrize("t", [Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)])
def test_index_entries_cover_small_sets(t):
    """n frequent tokens against the same and one more, also where all of them fall into one hash class."""
    rng = np.random.default_rng(9)
    pool = np.unique(rng.integers(0, 2**63, 6000, dtype=np.int64).astype(np.uint64))
    make = jaccard._Prefix(t, bitmap(pool))
    place = jaccard.tx.mix(pool) >> np.uint64(32)
    for n in range(4, 21):
        if Fraction(n, n + 1) < t:
            continue
        for part in (pool, *(pool[place & np.uint64(mask) == 0] for mask in (1, 3, 7, 15))):
            for _ in range(40):
                y = rng.choice(part, n + 1, replace=False)
                (ex, _, gx), (ey, _, gy) = (make.entries(np.sort(s)) for s in (y[:n], y))
                assert any((e & 63) == make.level(gx + gy) for e in set(ex.tolist()) & set(ey.tolist())), (n, len(part))


def brute_removed(rows, n):
    first = {}
    words = [SPLIT.findall(t or "") for _, t in rows]
    for (doc, _), w in zip(rows, words):
        for i in range(len(w) - n + 1):
            if doc is not None:
                first[tuple(w[i : i + n])] = min(doc, first.get(tuple(w[i : i + n]), doc))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if doc is not None and first[tuple(w[i : i + n])] < doc:
                gone[i : i + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [50, 7])
def test_repeated_passages(documents, corpus, window):
    got = substring.repeated_passages(documents, window).collect()
    assert sorted(map(tuple, got), key=repr) == brute_removed(corpus, window)


def test_passages_odd_rows(spark, nothing):
    p = " ".join(f"x{i}" for i in range(60))
    rows = [(None, p), (5, p), (5, "other " + p), (6, "pre " + p + " post"), (2, None), (None, None), (7, p)]
    got = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()
    assert sorted(map(tuple, got), key=repr) == brute_removed(rows, 50)
    assert substring.repeated_passages(nothing).count() == 0


def test_without_repeated_passages(spark):
    p = " ".join(f"x{i}" for i in range(60))
    df = spark.createDataFrame([(1, p, "a"), (2, f"pre\n{p} post", "b"), (3, "  short  text ", "c")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["text"], r["lang"]) for r in substring.without_repeated_passages(df).collect()}
    assert got == {1: (p, "a"), 2: ("pre post", "b"), 3: ("  short  text ", "c")}


def test_unlike_members_of_one_combination(spark):
    """Texts that share all frequent shingles and differ in rare ones by a little more than may be: none is a link."""
    rng = random.Random(31)
    shared = " ".join(f"b{i}" for i in range(102))
    rows = [(i, f"{shared} " + " ".join(f"own{i}x{k}" for k in range(6 + i % 2))) for i in range(60)]
    rows += [(1000 + i, f"{shared} " + " ".join(f"own{i}y{k}" for k in range(rng.choice([1, 4, 5])))) for i in range(40)]
    got = jaccard.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, "9/10", rare_max=2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows, 3, Fraction(9, 10))


def test_shuffles_are_sized_from_the_input(spark):
    from lexmill.llm.scratch import SHUFFLED_BYTES, sized

    key = "spark.sql.shuffle.partitions"
    now = int(spark.conf.get(key))
    with sized(spark, SHUFFLED_BYTES):
        assert int(spark.conf.get(key)) == now
    with pytest.raises(ValueError), sized(spark, 1000 * SHUFFLED_BYTES + 1):
        assert int(spark.conf.get(key)) == 1001
        raise ValueError
    assert int(spark.conf.get(key)) == now
