"""Operators against brute force and golden cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import anomaly, discovery, governance, graph, matching, rules, similarity
from lexmill.operators.components import connected_components
from lexmill.sources import stores

STORE = [
    ("Languages", 0, "Python", 0, "python3", 0), ("Languages", 0, "Python", 0, "cpython", 1), ("Languages", 0, "JavaScript", 1, "js", 0),
    ("Languages", 0, "JavaScript", 1, "ecmascript", 1), ("Languages", 0, "C++", 2, "cpp", 0), ("Cloud Computing", 1, "AWS", 0, "amazon web services", 0),
    ("Cloud Computing", 1, "Kubernetes", 1, "k8s", 0), ("AI Data Science", 2, "TensorFlow", 0, "tf", 0),
]
KIND = "grp string, grp_pos int, canonical string, canonical_pos int, alias string, alias_pos int"


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame(STORE, KIND)


def store(spark, *rows):
    return spark.createDataFrame([(g, 0, c, 0, a, i) for g, c, al in rows for i, a in enumerate(al or [None])], KIND)


def ids(findings):
    return sorted(r["rule_id"] for r in findings.collect())


def test_match_tiers(spark, terms):
    names = ["Python", "k8s", "TENSORFLOW", "LangChain", "JavaScriptt", "Advanced Python Programming", "Languages", None]
    got = {r["name"]: (r["canonical"], r["match_type"], r["confidence"]) for r in matching.match(spark.createDataFrame([(n,) for n in names], "name string"), terms).collect()}
    assert got["Python"] == ("python", "exact", 1.0) and got["k8s"][:2] == ("kubernetes", "exact") and got["TENSORFLOW"][:2] == ("tensorflow", "exact")
    assert "LangChain" not in got and got["JavaScriptt"][1] == "fuzzy" and got["JavaScriptt"][2] >= 0.85
    assert got["Advanced Python Programming"] == ("python", "containment", 0.80) and got["Languages"][1:] == ("group_exact", 1.0)


def test_closest_of_nearly_equal_ratios(spark):
    """Two keys whose ratios differ by less than the rounding: the closer one wins."""
    name = "".join(chr(0x4E00 + i) for i in range(1500))
    keys = spark.createDataFrame([("xyz" + name[3:], "far", 0), ("xy" + name[2:], "near", 1), ("x" * 700, "none", 2)], "key string, canonical string, pos int")
    todo = spark.createDataFrame([(name, name)], "name string, low string")
    assert [(r["canonical"], r["ratio"]) for r in matching._closest(todo, keys, 0.85).collect()] == [("near", 0.999)]


def test_rules(spark):
    pairs = spark.createDataFrame([("NumPy", "numba")], "canonical string, alias string")
    t = store(spark, ("Libraries", "NumPy", ["numba"]), ("Libraries", "Numba", None))
    assert {"L1-003", "L1-008", "L1-011"} <= set(ids(rules.all_findings(t, pairs)))
    assert ids(rules.non_atomic(store(spark, ("Languages", "Core Java", None), ("Languages", "Java", None), ("x", "TCP/IP", None)))) == ["L1-006"]
    assert ids(rules.duplicate_canonicals(store(spark, ("D", "azure sql database", None), ("D", "Azure SQL Database", None)))) == ["L1-002"]
    assert ids(rules.alias_multiplicity(store(spark, ("ML", "A", ["ann"]), ("ML", "B", ["ANN"])))) == ["L1-004"]
    assert ids(rules.self_groups(store(spark, ("Data Engineering", "Data Engineering", ["x"]), ("Data Engineering", "ETL", None)))) == ["L1-012"]
    assert ids(rules.rewritten_findings(store(spark, ("x", "TCP/IP", None)))) == ["L1R-006"]
    s = rules.suffix_overlaps(store(spark, ("Web", "Framework", None), ("Web", "UI Toolkit", ["react framework"]))).first()
    assert (s["alias"], s["matched"]) == ("react framework", "Framework")


def test_rewritten_terms(spark):
    got = rules.rewritten_terms(store(spark, ("AI", "Data Analysis and Visualization", ["dav"]), ("AI", "Networks (GAN)", None))).collect()
    assert {(r["canonical"], r["alias"]) for r in got} == {("Data Analysis", "dav"), ("Visualization", None), ("Networks", "GAN")}


def test_merge(spark, terms):
    offered = spark.createDataFrame([("A", "Power BI", ["pbi"], 0), ("B", "PBI", [], 1), ("C", "js", [], 2), ("D", "New", ["cpp", "nu"], 3)], "grp string, canonical string, aliases array<string>, pos int")
    got = {(r["canonical"], r["alias"]): r["kept"] for r in matching.merged_candidates(terms, offered).collect()}
    assert got == {("Power BI", None): True, ("Power BI", "pbi"): True, ("PBI", None): False, ("js", None): False, ("New", None): True, ("New", "cpp"): False, ("New", "nu"): True}


def test_similar_pairs_brute_force(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcd ") for _ in range(rng.randint(1, 9))).strip() for _ in range(120)} - {""})
    got = {(r["left"], r["right"]): r["score"] for r in similarity.trigram_edges(spark.createDataFrame([(w,) for w in words], "term string"), 0.5).collect()}

    def grams(w):
        k = " ".join(w.split()).replace(" ", "_")
        return {k[i : i + 3] for i in range(len(k) - 2)} or {k}

    want = {}
    for a, b in itertools.combinations(words, 2):
        x, y = grams(a), grams(b)
        s = len(x & y) / (len(x) ** 0.5 * len(y) ** 0.5)
        if s >= 0.5:
            want[a, b] = round(s, 6)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


@pytest.mark.parametrize("partitions", [1, 7])
def test_components(spark, partitions):
    rng = random.Random(3)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    up = {n: n for e in edges for n in e}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a int, b int").repartition(partitions)).collect()}
    alone = {n for n in up if all(n not in e or e[0] == e[1] for e in edges)}
    assert got == {n: root(n) for n in up if n not in alone}
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_clusters(spark):
    star = [("hub", f"n{i:02d}", 0.9) for i in range(14)]
    got = graph.clusters(spark.createDataFrame(star, "a string, b string, weight double"), most=10).collect()
    assert {r["term"] for r in got} == {"hub", *(f"n{i:02d}" for i in range(9))}
    hub = graph.over_generic(spark.createDataFrame(star[:4], "a string, b string, weight double")).collect()
    assert [r["node"] for r in hub] == ["hub"]


def test_outliers(spark):
    nodes = spark.createDataFrame([(f"s{i}", 2 ** (i % 4 + 1), "g", "S") for i in range(20)] + [("big", 5000, "g", "S"), ("none", 0, "g", "S"), ("lone", 9, "h", "S")], "skill string, total_count bigint, grp string, super_grp string")
    rows = {r["skill"]: r for r in anomaly.group_outliers(nodes).collect()}
    assert rows["big"]["verdict"] == "likely_false_positive" and "none" not in rows and rows["lone"]["group_z"] is None
    flat = spark.createDataFrame([("a", 3, "g", "S"), ("b", 3, "g", "S")], "skill string, total_count bigint, grp string, super_grp string")
    assert anomaly.group_outliers(flat).count() == 0


def record(spark, tmp_path, *rows):
    import json

    (tmp_path / "a.jsonl").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n\n")
    return stores.read_records(spark, str(tmp_path))


def test_records_and_candidates(spark, tmp_path):
    r = record(
        spark, tmp_path,
        {"title": "t", "source_url": "u1", "scraped_at": "2024-03-04T00", "technical_skills": ["LangGraph [AI Data Science]", "Solo"], "extraction_quality": {"unmapped_skills": ["LangGraph", "LangGraph [Other Group]"]}},
        "{broken", {"title": "e", "is_error": True, "technical_skills": ["X"]},
    )
    counts = stores.record_counts(r).first()
    assert (counts["records"], counts["parse_errors"], counts["skipped"]) == (1, 1, 1)
    got = [(c["name"], c["tag"], c["day"], c["line_number"]) for c in discovery.candidates(r).orderBy("pos").collect()]
    assert got == [("LangGraph", "AI Data Science", "2024-03-04", 1), ("Solo", None, "2024-03-04", 1)]


MENTION = "name string, tag string, source string, day string, ord long"


def test_queue_batches(spark):
    rows = [("Tech Design", "A", f"u{i}", f"2024-01-0{i + 1}", i) for i in range(3)] + [("tech design", "B", "u9", None, 3)]
    first, second = (spark.createDataFrame(x, MENTION) for x in (rows[:2], rows[2:]))
    one = discovery.new_queue(discovery.queue_delta(first), threshold=4, most_sources=3)
    assert one.first()["status"] == "pending"
    two = discovery.merge_queue(one, discovery.queue_delta(second), threshold=4, most_sources=3).first()
    assert two["key"] == "tech_design" and two["seen_count"] == 4 and two["status"] == "ready_for_promotion"
    assert two["sources"] == ["u0", "u1", "u2"] and [(t["tag"], t["n"]) for t in two["tags"]] == [("A", 3), ("B", 1)]


def test_queue_stream_equals_batches(spark, tmp_path):
    from lexmill.streaming.discovery_queue import queue_stream

    rng = random.Random(1)
    batches = [[(f"Skill {rng.randint(0, 6)}", rng.choice(["A", "B", None]), f"u{rng.randint(0, 20)}", f"2024-01-{rng.randint(1, 28):02d}", b * 100 + i) for i in range(40)] for b in range(3)]
    state = None
    for b, rows in enumerate(batches):
        df = spark.createDataFrame(rows, MENTION)
        df.coalesce(1).write.parquet(str(tmp_path / "in" / f"b{b}"))
        delta = discovery.queue_delta(df)
        state = discovery.new_queue(delta, 15, 5) if state is None else discovery.merge_queue(state, delta, 15, 5)
    stream = spark.readStream.schema(MENTION).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = queue_stream(stream, 15, 5).writeStream.format("memory").queryName("queue_out").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    last = {r["key"]: r for r in spark.sql("select key, max_by(struct(*), seen_count) s from queue_out group by key").select("key", "s.*").drop("key").withColumn("key", F.lower(F.replace("display_name", F.lit(" "), F.lit("_")))).collect()}
    import json

    for r in state.collect():
        s = last[r["key"]]
        assert (s["seen_count"], s["first_seen"], s["last_seen"], s["status"]) == (r["seen_count"], r["first_seen"], r["last_seen"], r["status"])
        assert json.loads(s["tags"]) == {t["tag"]: t["n"] for t in r["tags"]} and len(json.loads(s["sources"])) == len(r["sources"])


def test_queue_stream_goes_on_from_a_batch_queue_and_its_checkpoint(spark, tmp_path):
    """Batch 0 as a batch queue, batch 1 streamed, a restart, batch 2 streamed: the queue of all three."""
    import json

    from lexmill.streaming.discovery_queue import queue_stream

    rng = random.Random(5)
    batches = [[(f"Skill {rng.randint(0, 5)}", rng.choice(["A", "B", "C", None]), f"u{rng.randint(0, 30)}", f"2024-02-{rng.randint(1, 28):02d}", b * 100 + i) for i in range(50)] for b in range(3)]
    start = discovery.new_queue(discovery.queue_delta(spark.createDataFrame(batches[0], MENTION)), 20, 5)
    want = start
    for b in (1, 2):
        df = spark.createDataFrame(batches[b], MENTION)
        want = discovery.merge_queue(want, discovery.queue_delta(df), 20, 5)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(MENTION).parquet(str(tmp_path / "in"))
        out = queue_stream(stream, 20, 5, queue=start).writeStream.foreachBatch(lambda d, i: d.write.mode("append").parquet(str(tmp_path / "out")))
        q = out.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).groupBy("key").agg(F.max_by(F.struct("*"), "seen_count").alias("s")).select("s.*").collect()
    got = {r["key"]: r for r in rows}
    for r in want.collect():
        s = got[r["key"]]
        assert (s["seen_count"], s["display_name"], s["first_seen"], s["last_seen"], s["status"]) == (r["seen_count"], r["display_name"], r["first_seen"], r["last_seen"], r["status"])
        assert json.loads(s["tags"]) == {t["tag"]: t["n"] for t in r["tags"]} and json.loads(s["sources"]) == list(r["sources"])


def test_review(spark, terms):
    delta = "key string, display_name string, seen_count bigint, first_seen string, last_seen string, tags array<struct<tag:string,n:bigint>>, sources array<string>, status string"
    ready = "ready_for_promotion"
    q = spark.createDataFrame([("argo", "Argo", 9, "a", "b", [("X", 2), ("Y", 8)], ["u"], ready), ("js", "JS", 9, "a", "b", [], [], ready), ("languages", "Languages", 9, "a", "b", [], [], ready), ("p", "P", 1, "a", "b", [], [], "pending")], delta)
    known = rules.alias_map(terms).select("key", "canonical")
    got = {r["key"]: (r["action"], r["suggested_group"]) for r in discovery.review(q, known, terms.select(F.col("grp").alias("name"))).collect()}
    assert got == {"argo": ("approve", "Y"), "js": ("alias_of:javascript", ""), "languages": ("reject", "")}
    approved, alias, counters = discovery.applied(discovery.review(q, known, terms.select(F.col("grp").alias("name"))))
    assert approved.collect() == [("Y", "Argo")] and alias.collect() == [("javascript", "JS")]
    assert tuple(counters.first()) == (1, 1, 1, 0)


def test_governance(spark):
    kind = "cluster_id string, term string, action string, target_canonical string, split_candidates array<string>, ecosystem string, abstraction_level string, graph_safety string, confidence string"
    rows = [("1", "a", "MERGE_AS_ALIAS", "b", None, "different ecosystems", "Same", "", "HIGH"), ("1", "b", "SPLIT_INTO_MULTIPLE_CANONICALS", None, None, "", "", "", "HIGH"), ("1", "c", "KEEP_DISTINCT", None, None, "", "", "", "LOW"), ("1", "d", "KEEP_DISTINCT", None, None, "", "", "", "HIGH")]
    members = spark.createDataFrame([("1", t) for t in "abcd"], "cluster_id string, term string")
    got = {r["term"]: (r["effective_action"], r["violations"]) for r in governance.governed(spark.createDataFrame(rows, kind), members, spark.createDataFrame([("z",)], "canonical string")).collect()}
    assert got["a"] == ("KEEP_DISTINCT", ["ecosystem_mismatch"]) and got["b"][1] == ["split_candidates_required"]
    assert got["c"][1] == ["low_confidence_containment"] and got["d"] == ("KEEP_DISTINCT", [])
    assert [governance.exit_code(*x) for x in ((True, True, True), (False, True, True), (False, True, False), (False, False, False))] == [3, 4, 2, 0]
    c = spark.createDataFrame([("Computer Vision", "Technology", None, None, "0.6", None), ("x", "General", None, None, "High", None)], "term string, primary_type string, ontological_nature string, abstraction_level string, confidence string, status string")
    out = {r["term"]: tuple(r)[1:] for r in governance.normalised_classes(c).collect()}
    assert out["Computer Vision"] == ("Concept", "Computer Vision", "Domain", "MEDIUM", "active") and out["x"][3:] == ("HIGH", "active")


def test_stores(spark, tmp_path):
    import json

    path = tmp_path / "s.json"
    path.write_text(json.dumps({"B": {"x": ["2", "1"], "y": []}, "A": {"z": ["q"]}}))
    rows = stores.read_store(spark, str(path))
    assert [(r["grp"], r["canonical"], r["alias"]) for r in rows.orderBy("grp_pos", "canonical_pos", "alias_pos").collect()] == [("B", "x", "2"), ("B", "x", "1"), ("B", "y", None), ("A", "z", "q")]
    assert {r["grp"]: r["entries"] for r in stores.nest_store(rows).collect()} == {"A": {"z": ["q"]}, "B": {"x": ["2", "1"], "y": []}}
    bad = spark.createDataFrame([('{"g": {"c": ["", 3], "d": 4}, "h": 1}',)], "value string")
    assert sorted(r["location"] for r in stores.schema_breaches(bad).collect()) == ["group:g.canonical:c.alias:0", "group:g.canonical:c.alias:1", "group:g.canonical:d", "group:h"]
    q = spark.createDataFrame([("a", "ready now"), ("b", None)], "key string, status string")
    stores.write_by_status(q, str(tmp_path / "q"))
    assert {p.name for p in (tmp_path / "q").glob("slug=*")} == {"slug=ready_now", "slug=unknown"}


def test_dense_nearest_blocks(spark):
    rng = random.Random(0)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)], i % 3) for i in range(60)]
    v = spark.createDataFrame(rows, "id long, vec array<double>, grp int")
    small = {r["id"]: tuple(r) for r in similarity.dense_nearest(v, v).collect()}
    dealt = {r["id"]: tuple(r) for r in similarity.dense_nearest(v, v, broadcast_bytes=0, part_rows=17).collect()}
    assert {k: (x[2], x[4]) for k, x in small.items()} == {k: (x[2], x[4]) for k, x in dealt.items()}


def test_replies(spark):
    from lexmill.operators import replies

    rows = [("1", '{"decisions": [{"term": "a", "action": "SPLIT", "split_candidates": ["x", "y"], "reasoning": {"ecosystem": "Same"}}, 3]}'), ("2", "no json"), ("3", '{"decisions": 4}'), ("4", None)]
    made, found = replies.decisions(spark.createDataFrame(rows, "cluster_id string, reply string"))
    assert [(r["term"], r["split_candidates"], r["ecosystem"]) for r in made.collect()] == [("a", ["x", "y"], "Same")]
    assert sorted(r["location"] for r in found.collect()) == ["cluster:1|term:<invalid_row>", "cluster:2", "cluster:3", "cluster:4"]
    rows = [("Kafka", '{"classification": {"ontological_nature": "Concept"}, "confidence": "low"}'), ("LAMP", '{"primary_type": "composite stack"}'), ("Tools", '{"ontological_nature": "CATEGORY"}'), ("x", "[1]")]
    kept, found = replies.classes(spark.createDataFrame(rows, "term string, reply string"))
    assert [r["ontological_nature"] for r in governance.normalised_classes(kept).collect()] == ["Concept"]
    told = [("a", '{"classification": {"functional_roles": ["X", " x", 3, "y"]}, "is_versioned": "yes", "is_contextual": true}'), ("b", '{"functional_roles": "one"}'), ("c", "{}")]
    rows = {r["term"]: r for r in governance.normalised_classes(replies.classes(spark.createDataFrame(told, "term string, reply string"))[0]).collect()}
    assert list(rows["a"]["functional_roles"]) == ["X", "y"] and rows["a"]["is_versioned"] and rows["a"]["is_contextual"] and not rows["a"]["is_marketing_language"]
    assert list(rows["b"]["functional_roles"]) == ["one"] and list(rows["c"]["functional_roles"]) == []
    assert sorted((r["rule_id"], r["location"]) for r in found.collect()) == [("L4-001", "term:x"), ("L4-003", "term:Kafka"), ("L4-004", "term:LAMP"), ("L4-005", "term:Tools")]


def test_folded_values(spark):
    from lexmill.functions import scores

    df = spark.createDataFrame([({"Confidence ": "HIGH", "confidence": "LOW", "X": "1"},)], "m map<string,string>")
    got = df.select(scores.folded_value(F.col("m"), "none", "confidence").alias("a"), scores.folded_value(F.col("m"), "x").alias("b"), scores.folded_value(F.col("m"), "q").alias("c")).first()
    assert got["a"] in ("HIGH", "LOW") and got["b"] == "1" and got["c"] is None
