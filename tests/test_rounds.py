"""Algorithms in rounds and ranges against serial versions: cycles, splits, merging, medians, numbering, pairs."""

import itertools
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.functions.plain import best_ratio
from lexmill.operators import cycles, graph, matching, ranges, similarity, vectors
from lexmill.sources import pycode


# --- strong components -----------------------------------------------------------------------------------------------


def tarjan(edges):
    """Node -> smallest node of its strong component, for nodes on a cycle."""
    out, index, low, stack, on, result = {}, {}, {}, [], set(), {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
        out.setdefault(b, [])

    def visit(v):
        index[v] = low[v] = len(index)
        stack.append(v)
        on.add(v)
        for w in out[v]:
            if w not in index:
                visit(w)
                low[v] = min(low[v], low[w])
            elif w in on:
                low[v] = min(low[v], index[w])
        if low[v] == index[v]:
            own = []
            while not own or own[-1] != v:
                own.append(stack.pop())
                on.discard(own[-1])
            if len(own) > 1 or (v, v) in edges:
                result.update(dict.fromkeys(own, min(own)))

    for v in out:
        if v not in index:
            visit(v)
    return result


NESTED = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (5, 6), (6, 3), (6, 7), (7, 8), (8, 9), (9, 7), (10, 10), (10, 11), (0, 1), (11, 12)]


@pytest.mark.parametrize("edges", [NESTED, [], [(1, 2), (2, 3)], [(k, (k * 7 + 3) % 23) for k in range(23)] + [(k, (k * 5 + 1) % 23) for k in range(0, 23, 3)]])
def test_strong_components(spark, edges):
    df = spark.createDataFrame([*edges, *edges[:2], (None, 1), (1, None)], "a int, b int").repartition(3)
    want = tarjan(set(edges))
    assert {r["node"]: r["component"] for r in cycles.strong_components(df).collect()} == want
    on = {(a, b, want[a]) for a, b in edges if a in want and want[a] == want.get(b)}
    assert {tuple(r) for r in cycles.cycle_edges(df).collect()} == on


def test_strong_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = {(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(55)}
    got = {r["node"]: r["component"] for r in cycles.strong_components(spark.createDataFrame(list(edges), "a string, b string")).collect()}
    assert got == tarjan(edges)


def test_long_rings_and_chains_take_few_rounds(spark, monkeypatch):
    """A ring, a chain into a hub that leads back to its last part, and a chain to nowhere; 300 links each."""
    written, put = [], cycles.Written.put
    monkeypatch.setattr(cycles.Written, "put", lambda self, name, df: written.append(name) or put(self, name, df))
    ring = [(k, (k + 1) % 300) for k in range(300)]
    back = [(k, k + 1) for k in range(1000, 1300)] + [(1300, 9000), (9000, 1150), (9000, 150), (9000, 9001), (9000, 9000)]
    edges = ring + back + [(k, k + 1) for k in range(5000, 5300)]
    got = {r["node"]: r["component"] for r in cycles.strong_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{k: 0 for k in range(300)}, **{k: 1150 for k in range(1150, 1301)}, 9000: 1150}
    assert len(written) < 60  # three times the length of the ring before


def test_import_cycles_of_files(spark):
    sources = {"r/a.py": "import p.b\nimport os", "r/p/b.py": "from p.c import x", "r/p/c.py": "import a", "r/p/__init__.py": "import q", "r/q.py": "import p", "r/d.py": "import a"}
    df = spark.createDataFrame(list(sources.items()), "file string, source string")
    got = {tuple(r) for r in pycode.import_cycles(pycode.facts(df), df, "r").collect()}
    assert got == {("r/a.py", "r/p/b.py", "r/a.py"), ("r/p/b.py", "r/p/c.py", "r/a.py"), ("r/p/c.py", "r/a.py", "r/a.py"), ("r/p/__init__.py", "r/q.py", "r/p/__init__.py"), ("r/q.py", "r/p/__init__.py", "r/p/__init__.py")}


def test_diagram_is_written(spark, tmp_path):
    edges = spark.createDataFrame([("b", "c"), ("a", "b"), ("a", "b")], "a string, b string")
    pycode.write_diagram(edges, str(tmp_path / "d"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "d").glob("part-*")))
    assert text == 'graph TD\n    "a" --> "b"\n    "b" --> "c"\n'


# --- splits ----------------------------------------------------------------------------------------------------------


def serial_splits(edges, most):
    """component -> list of splits, by the rule of one node after the other."""
    weight = {}
    for a, b, w in edges:
        if a != b:
            weight[a, b] = weight[b, a] = max(w, weight.get((a, b), w))
    near = {}
    for a, b in weight:
        near.setdefault(a, set()).add(b)
    out, seen = {}, set()
    for start in sorted(near):
        if start in seen:
            continue
        comp, todo = {start}, [start]
        while todo:
            for o in near[todo.pop()] - comp:
                comp.add(o)
                todo.append(o)
        seen |= comp
        if len(comp) <= most:
            out[start] = [comp]
            continue
        left, found = set(comp), []
        while left:
            seed = max(left, key=lambda t: (len(near[t] & left), t))
            own = [seed, *sorted(near[seed] & left, key=lambda o: (-weight[seed, o], o))[: most - 1]]
            for t in sorted(left.difference(own)):
                if len(own) < most and any(t in near[o] for o in own):
                    own.append(t)
            left.difference_update(own)
            if len(own) > 1:
                found.append(set(own))
        out[start] = found
    return out


def graphs():
    rng = random.Random(31)
    dense = [(f"d{rng.randrange(60):02d}", f"d{rng.randrange(60):02d}", rng.randrange(5)) for _ in range(260)]
    path = [(f"p{k:03d}", f"p{k + 1:03d}", k % 3) for k in range(30)]
    hubs = [(f"h{k % 4}", f"x{rng.randrange(90):02d}", k % 7) for k in range(160)]
    ring = [(f"r{k:02d}", f"r{(k * 11 + 1) % 24:02d}", 1) for k in range(24)] + [(f"r{k:02d}", f"r{(k + 1) % 24:02d}", 2) for k in range(24)]
    return {"dense": dense, "path": path, "hubs": hubs, "ring": ring}


@pytest.mark.parametrize(("name", "most", "fold"), [("dense", 10, 0), ("hubs", 4, 0), ("hubs", 4, 40), ("ring", 3, 0), ("path", 3, 0)])
def test_splits_in_rounds_equal_the_serial_ones(spark, name, most, fold):
    edges = graphs()[name]
    got = {}
    for r in graph.clusters(spark.createDataFrame(edges, "a string, b string, weight int"), most, fold).collect():
        got.setdefault(r["component"], {}).setdefault(r["split"], set()).add(r["term"])
    assert {c: [s[k] for k in sorted(s)] for c, s in got.items()} == serial_splits(edges, most)
    assert all(sorted(s) == list(range(len(s))) for s in got.values())


# --- merging ---------------------------------------------------------------------------------------------------------


def serial_merge(known, offered, by_input):
    seen, out = set(known), set()
    for g, c, aliases, pos in sorted(offered, key=lambda x: x[3] if by_input else (x[0], x[1], x[3])):
        if c in seen:
            out.add((g, c, None, False))
            continue
        out.add((g, c, None, True))
        for a in aliases:
            out.add((g, c, a, a not in seen))
        seen |= {c, *aliases}
    return out


@pytest.mark.parametrize("by_input", [False, True])
def test_merge_in_rounds_equals_the_serial_fold(spark, by_input):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    offered = [(rng.choice("ab"), rng.choice(words), rng.sample(words, rng.randint(0, 3)), k) for k in range(120)]
    offered += [("z", f"chain {k}", [f"chain {k + 1}"], 200 + k) for k in range(9)]  # each takes the next one's name
    existing = spark.createDataFrame([("w1", "w2"), ("w3", None)], "canonical string, alias string")
    df = spark.createDataFrame(offered, "grp string, canonical string, aliases array<string>, pos int").repartition(3)
    got = matching.merged_candidates(existing, df, by_input).collect()
    assert {(r["grp"], r["canonical"], r["alias"], r["kept"]) for r in got} == serial_merge({"w1", "w2", "w3"}, offered, by_input)
    assert matching.settled.rounds <= 10  # the chain of nine and one for the rest
    assert all((r["reason"] is None) == r["kept"] for r in got)


def test_merge_of_nothing_and_nulls(spark):
    kind = "grp string, canonical string, aliases array<string>, pos int"
    existing = spark.createDataFrame([], "canonical string, alias string")
    assert matching.merged_candidates(existing, spark.createDataFrame([], kind)).collect() == []
    got = matching.merged_candidates(existing, spark.createDataFrame([("g", None, ["a"], 0), (None, "x", None, 1), ("g", "y", [None, "x"], 2)], kind)).collect()
    assert {(r["canonical"], r["alias"], r["kept"]) for r in got} == {("x", None, True), ("y", None, True), ("y", None, True), ("y", "x", False)}


# --- closest spelling ------------------------------------------------------------------------------------------------


def test_closest_by_letters_equals_all_pairs(spark):
    rng = random.Random(12)
    keys = sorted({"".join(rng.choice("abcdefghij -") for _ in range(rng.randint(1, 16))).strip() or "x" for _ in range(250)})
    keys += ["long" * 20 + "a", "long" * 20 + "bcd"]
    names = sorted({"".join(c for c in k if rng.random() > 0.1) + rng.choice(["", "a", "zz"]) for k in keys} - {""})
    rows = [("g", 0, k, i, None, None) for i, k in enumerate(keys)]
    terms = matching.alias_map(spark.createDataFrame(rows, "grp string, grp_pos int, canonical string, canonical_pos int, alias string, alias_pos int"))
    todo = spark.createDataFrame([(n, n) for n in names], "name string, low string").unionByName(spark.createDataFrame([("", "")], "name string, low string"))
    for threshold, share in ((0.85, 0.05), (0.6, 0.6)):
        got = {(r["name"], r["canonical"], r["ratio"]) for r in matching._closest(todo, terms, threshold).collect()}
        want = {(n, keys[b[0]], round(b[1], 3)) for n in names if (b := best_ratio(n, keys, threshold))}
        assert got == want and len(want) > 50
        assert matching.closest_candidates(todo, terms, threshold).count() < share * len(names) * len(keys)


# --- ranges ----------------------------------------------------------------------------------------------------------


def test_numbers_over_ranges_are_even(spark):
    names = [f"Customer#{k:09d}" for k in range(4000)]
    df = spark.createDataFrame([(n,) for n in names], "component string").repartition(5)
    rows = ranges._ranged(df, ["component"], "test")
    sizes = [r["count"] for r in rows.groupBy("part").count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    got = {r["component"]: r["number"] for r in ranges.numbered_in_order(df, ["component"]).collect()}
    assert got == {n: k + 1 for k, n in enumerate(names)}
    ids = {r["node"]: r["id"] for r in graph.numbered(spark.createDataFrame([(k, k % 3) for k in range(9)], "node int, component int"), "c").collect()}
    assert ids == {k: f"c-{k % 3 + 1:04d}" for k in range(9)}


def test_weighted_medians(spark):
    rng = random.Random(3)
    rows = [(g, round(rng.gauss(0, 3), 1)) for g in ("a", "b", "c", None) for _ in range(rng.choice([1, 2, 333, 400]))] + [("d", None), ("e", 1.0), ("e", 2.0), ("hot", 0.5)] + [("hot", x / 10) for x in range(901)]
    hist = spark.createDataFrame(rows, "g string, x double").groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    got = {r["g"]: (r["size"], r["median"]) for r in ranges.weighted_medians(hist, ["g"]).collect()}
    by = {}
    for g, x in rows:
        if x is not None:
            by.setdefault(g, []).append(x)
    assert got == {g: (len(v), statistics.median(v)) for g, v in by.items()}
    whole = ranges.weighted_medians(hist.groupBy("x").agg(F.sum("n").alias("n")), []).collect()
    every = [x for v in by.values() for x in v]
    assert [(r["size"], r["median"]) for r in whole] == [(len(every), statistics.median(every))]


# --- co-occurrence ---------------------------------------------------------------------------------------------------


def test_pairs_of_large_documents_by_blocks(spark):
    rng = random.Random(1)
    rows = [(d, f"i{rng.randrange(40)}") for d in range(5) for _ in range(d * 20)] + [(9, None), (None, "x"), (None, "y"), (7, "alone")]
    df = spark.createDataFrame(rows, "doc int, item string")
    want = Counter()
    for d in {d for d, i in rows if d is not None}:
        want.update(itertools.combinations(sorted({i for x, i in rows if x == d and i is not None}), 2))
    for block in (3, 7, 1000):
        assert {(r["a"], r["b"]): r["weight"] for r in graph.cooccurrence(df, block=block).collect()} == want


def test_one_large_document_takes_many_tasks(spark):
    df = spark.range(3000).select(F.lit(1).alias("doc"), F.col("id").alias("item"))
    assert graph.cooccurrence(df, block=200).count() == 3000 * 2999 // 2


# --- vectors ---------------------------------------------------------------------------------------------------------


def clustered(rng, n, dims=8):
    """Vectors around a few centers, with copies, opposite ones and zeros."""
    centers = rng.normal(size=(6, dims)) * 5
    rows = centers[rng.integers(6, size=n)] + 0.2 * rng.normal(size=(n, dims))
    rows[:40] = rows[0]
    rows[40:44] = -rows[0]
    rows[44] = 0
    return rows


def test_vectors_around_pivots_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    vec = clustered(rng, 400)
    grp = rng.integers(5, size=400)
    grp[7] = 99  # alone in its group
    v = spark.createDataFrame([(i, vec[i].tolist(), int(grp[i])) for i in range(400)], "id long, vec array<double>, grp int").repartition(4)
    got = {r["id"]: r for r in similarity.dense_nearest(v, v, broadcast_bytes=0, part_rows=25).collect()}
    u = vectors.unit(vec)
    score = u @ u.T
    np.fill_diagonal(score, -np.inf)
    own = np.where(grp[:, None] == grp[None, :], score, -np.inf)
    assert sorted(got) == list(range(400))
    for i in range(400):
        r = got[i]
        assert abs(r["best_score"] - score[i].max()) < 1e-9 and abs(score[i, r["best_id"]] - score[i].max()) < 1e-9
        if i == 7:
            assert r["best_in_group"] is None and r["in_group_score"] is None
        else:
            assert abs(r["in_group_score"] - own[i].max()) < 1e-9 and grp[r["best_in_group"]] == grp[i]


def test_vector_join_skips_partitions(spark):
    rng = np.random.default_rng(10)
    vec = clustered(rng, 500)
    rows = spark.createDataFrame([(f"t{i:03d}", vec[i].tolist()) for i in range(500)], "term string, vec array<double>").repartition(4)
    got = {(r["left"], r["right"]): r["score"] for r in vectors.similar(rows, 0.97, part_rows=20).collect()}
    u = vectors.unit(vec)
    score = u @ u.T
    want = {(f"t{i:03d}", f"t{j:03d}") for i in range(500) for j in range(i + 1, 500) if score[i, j] >= 0.97 - 1e-9}
    assert set(got) == want and len(want) > 5000
    pivots = vectors.choose_pivots(rows, "term", 20)
    home = vectors.placed(rows.withColumn("scope", F.lit(0)), pivots)
    parts = vectors.partitions_of(home, 20)
    asked = vectors.visits(home.select("term", "scope", "vec", F.lit(float(np.arccos(0.97))).alias("reach")), parts, pivots)
    assert asked.count() < 0.5 * 500 * parts.agg(F.sum("chunks")).first()[0]
    assert parts.agg(F.max("chunks")).first()[0] >= 2  # the copies fill several chunks


def test_best_places_hold_blocks_alone():
    """Nearest targets over many blocks equal one product, in a bounded part of its memory; ties go to the smaller id."""
    import tracemalloc

    rng = np.random.default_rng(5)
    t = vectors.unit(rng.integers(-3, 4, (30_000, 6)).astype(float))
    q_id = np.arange(0, 30_000, 15)
    tracemalloc.start()
    groups = rng.integers(0, 3, 30_000)
    got = similarity._nearest_rows(q_id, t[q_id], groups[q_id], np.arange(30_000), t, groups)
    assert tracemalloc.get_traced_memory()[1] < 80 << 20  # before: 512 x 30,000 scores, twice, and copies of all targets
    tracemalloc.stop()
    for k in range(0, len(q_id), 97):
        s = np.einsum("ij,j->i", t, t[q_id[k]])
        s[q_id[k]] = -np.inf
        own = np.where(groups == groups[q_id[k]], s, -np.inf)
        assert abs(got[1][k] - s.max()) < 1e-12 and abs(s[got[0][k]] - s.max()) < 1e-12
        assert abs(got[3][k] - own.max()) < 1e-12 and abs(own[got[2][k]] - own.max()) < 1e-12


def test_candidates_need_no_window(spark):
    """Names of a record are grouped once; the first spelling counts, and its tag is the first technical one, else the first met."""
    from lexmill.operators import discovery

    kind = "file string, line_number int, parse_error boolean, is_error boolean, source_url string, scraped_at string, unmapped_skills array<string>, technical_skills array<string>"
    rows = [("f", 1, False, False, "u", "2024-01-02T00", ["Go [x]", "sql", " ", "Rust"], ["GO [y_z]", "go [w]", "Sql"]), ("f", 2, False, True, "u", None, ["c"], None), ("f", 3, False, False, None, None, None, ["go"])]
    got = discovery.candidates(spark.createDataFrame(rows, kind))
    assert {(r["line_number"], r["pos"], r["name"], r["tag"]) for r in got.collect()} == {(1, 0, "Go", "y z"), (1, 1, "sql", None), (1, 3, "Rust", None), (3, 0, "go", None)}
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
