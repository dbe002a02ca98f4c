"""Stages, providers, source facts, settings and the driver contract."""

import json

import pytest
from pyspark.sql import functions as F

from lexmill.__main__ import main

from lexmill.config import Config
from lexmill.plans.pipeline import STAGES, Run, Settings, digest, file_backed, model_arbiter, model_classifier, needed, reply_arbiter, reply_classifier, settled, settled_terms
from lexmill.operators import anomaly, discovery, governance, graph, rules, similarity
from lexmill.plans.queue import Discovery
from lexmill.sources import providers, pycode, stores

KIND = "grp string, grp_pos int, canonical string, canonical_pos int, alias string, alias_pos int"


def terms(spark, *rows):
    return spark.createDataFrame([(g, 0, c, 0, a, i) for g, c, al in rows for i, a in enumerate(al or [None])], KIND)


def test_run_resume_and_exit_code(spark, tmp_path):
    t = terms(spark, ("Web", "React/Angular", ["ui lib"]), ("Web", "React", None), ("Web", "Vector Index", None), ("Web", "Vector Indexing", None), ("Web", "Vector Indexes", None))
    run = Run(spark, t, str(tmp_path / "run"), Settings(threshold=0.6))
    out = run.run()
    assert set(out) == {n for names, _ in STAGES.values() for n in names} and run.done() == set(STAGES)
    assert {r["canonical"] for r in out["terms"].collect()} >= {"React", "Angular", "Vector Index"}
    assert {r["term"] for r in out["clusters"].collect()} >= {"Vector Index", "Vector Indexing"}
    assert run.exit_code() in (2, 4) and "## blocking" in run.markdown()
    again = Run(spark, t, str(tmp_path / "run"), Settings(threshold=0.6))
    assert again.done() == set(STAGES) and needed(6, again.done()) == []
    assert Run(spark, t.limit(2), str(tmp_path / "run"), Settings(threshold=0.6)).done() == set()
    assert needed(3, set()) == [0, 1, 2, 3] and needed(5, {0, 4}) == [1, 2, 5]


def test_file_backed_decisions(spark):
    decisions = spark.createDataFrame([("KAFKA", "Concept")], "term string, ontological_nature string")
    give = file_backed(decisions, "term", governance.heuristic_classes)
    got = {r["term"]: r["ontological_nature"] for r in give(spark.createDataFrame([("Kafka",), ("tcp",)], "term string")).collect()}
    assert got == {"Kafka": "Concept", "tcp": "Protocol"}


def test_settled(spark):
    df = spark.createDataFrame([(9,)], "x int")
    out, rounds = settled(lambda d: d.select(F.greatest(F.col("x") - 4, F.lit(0)).alias("x")), df, 6)
    assert out.first()["x"] == 0 and rounds == 4


def test_providers(spark):
    rows = spark.createDataFrame([("a",), ("bb",), ("a",), (None,)], "t string")
    got = {r["t"]: r["vec"] for r in providers.embedded(rows, "t", lambda: lambda texts: [[float(len(x))] for x in texts], 1).collect()}
    assert got == {"a": [1.0], "bb": [2.0]}
    cache = spark.createDataFrame([("0cc175b9c0f1b6a831c399e269772661", "old")], "prompt_md5 string, answer string")
    asked = providers.answered(rows.filter("t is not null").distinct().withColumn("k", F.col("t")), "k", "t", lambda: lambda p: p.upper(), cache)
    assert {(r["k"], r["answer"]) for r in asked.collect()} == {("a", "old"), ("bb", "BB")}

    def post(url, payload, timeout):
        if len(payload["input"]) > 1:
            raise ValueError("too many")
        return {"data": [{"index": 0, "embedding": [1.0]}]}

    assert providers.http_embedder("http://x", post=post)(["p", "q"]) == [[1.0], [1.0]]
    assert providers.http_chat("http://x", post=lambda url, body, timeout: {"choices": [{"message": {"content": "ok"}}]})("p") == "ok"
    assert providers.available(["org/m"], "m") and not providers.available([], "m")


def test_source_facts(spark, tmp_path):
    (tmp_path / "a.py").write_text("import os\nfrom b import c\ndef used():\n    return 1\ndef dead():\n    return used()\n")
    (tmp_path / "bad.py").write_text("def (:")
    rows = pycode.facts(pycode.read_sources(spark, str(tmp_path)))
    assert {r["name"] for r in rows.filter("kind = 'chunk'").collect()} == {"used", "dead"}
    assert [r["name"] for r in pycode.uncalled(rows).collect()] == ["dead"]
    assert rows.filter("kind = 'error'").count() == 1 and pycode.import_groups(rows).count() == 3
    assert pycode.diagram_lines(pycode.import_edges(rows)).filter("value like '%-->%'").count() == 2


def test_config(tmp_path):
    (tmp_path / "s.yaml").write_text("discovery:\n  fuzzy_threshold: 0.85  # share\n  paths:\n    queue: q/out\nname: 'x y'\n")
    c = Config(str(tmp_path / "s.yaml"))
    assert c.get("discovery.fuzzy_threshold") == 0.85 and c.get("name") == "x y" and c.get("discovery.none", 3) == 3
    assert c.path("discovery.paths.queue") == str(tmp_path / "q/out")


def test_resume_looks_at_pairs_and_providers(spark, tmp_path):
    t = terms(spark, ("Libraries", "NumPy", ["numba", "Python 3", "ndarray"]), ("Libraries", "Numba tools", None))
    folder = str(tmp_path / "run")
    pairs = spark.createDataFrame([("NumPy", "numba")], "canonical string, alias string")
    run = Run(spark, t, folder, pairs=pairs)
    run.run(0)
    assert {r["alias"] for r in run.table("terms").filter("canonical = 'NumPy'").collect()} == {"ndarray"}
    assert Run(spark, t, folder, pairs=pairs).done() == {0} and Run(spark, t, folder).done() == set()
    assert Run(spark, t, folder, pairs=spark.createDataFrame([("NumPy", "other")], "canonical string, alias string")).done() == set()
    replies = spark.createDataFrame([("cluster-0001", "{}")], "cluster_id string, reply string")
    a, b = (Settings(arbiter=reply_arbiter(r)) for r in (replies, replies.limit(0)))
    assert Run(spark, t, folder, a, pairs).mark != Run(spark, t, folder, b, pairs).mark != Run(spark, t, folder, pairs=pairs).mark
    assert digest(t) == digest(t.repartition(3)) != digest(t.limit(1))


def test_replies_govern_the_run(spark, tmp_path):
    t = terms(spark, ("Web", "Vector Index", None), ("Web", "Vector Indexing", None), ("Web", "Vector Indexes", None))
    good = '{"decisions": [{"term": "Vector Indexes", "action": "MERGE_AS_ALIAS", "target_canonical": "Vector Index", "confidence": "HIGH"}, {"term": "Vector Index", "action": "SPLIT_INTO_MULTIPLE_CANONICALS", "confidence": "HIGH"}]}'
    classes = [("Vector Index", '{"classification": {"ontological_nature": "Concept", "functional_roles": []}, "confidence": "HIGH"}'), ("Vector Indexing", '{"classification": {"functional_roles": {"a": 1}}}')]

    def run(name, cluster_reply, class_replies):
        s = Settings(threshold=0.6, arbiter=reply_arbiter(spark.createDataFrame([("cluster-0001", cluster_reply)], "cluster_id string, reply string")), classifier=reply_classifier(spark.createDataFrame(class_replies, "term string, reply string")))
        r = Run(spark, t, str(tmp_path / name), s)
        r.run()
        return r

    first = run("good", good, classes[:1])
    assert {(d["term"], d["effective_action"]) for d in first.table("decisions").collect()} == {("Vector Indexes", "MERGE_AS_ALIAS"), ("Vector Index", "KEEP_DISTINCT")}
    assert [f["rule_id"] for f in first.table("decision_findings").collect()] == ["L3-002"] and first.exit_code() in (2, 4)
    assert "L3-002" in {r["value"] for r in first.table("report").filter("kind = 'rule'").collect()}
    second = run("broken", "no json", classes)
    assert {f["rule_id"] for f in second.findings().collect()} >= {"L3-001", "L4-002"} and second.exit_code() == 3


def test_files_of_pairs_and_exceptions(spark, tmp_path):
    (tmp_path / "pairs.json").write_text('{"NumPy": "numba", "a \\"q\\"": "b", "NumPy": "numeric"}')
    assert {tuple(r) for r in stores.read_pairs(spark, str(tmp_path / "pairs.json")).collect()} == {("NumPy", "numeric"), ('a "q"', "b")}
    (tmp_path / "e.json").write_text('{"atomicity_exceptions": [{"term_normalized": "TCP/IP ", "reason_code": "x"}, {"notes": "none"}]}')
    assert [tuple(r) for r in stores.read_exceptions(spark, str(tmp_path / "e.json")).collect()] == [("tcp/ip", "x", None)]
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "canonical string, alias string")
    new = spark.createDataFrame([("b", "z"), ("c", "w"), ("", "q")], "canonical string, alias string")
    assert {tuple(r) for r in rules.merged_pairs(old, new).collect()} == {("a", "x"), ("b", "z"), ("c", "w")}
    log = spark.createDataFrame([("r1", 1, "a"), ("r2", 2, "b"), ("r2", 2, "c")], "run_id string, at int, what string")
    assert {r["what"] for r in stores.latest_report(log).collect()} == {"b", "c"}


def test_small_operators(spark):
    e = spark.createDataFrame([("A", "b", 3.0), ("A", "c", 3.0), ("b", "c", 1.0)], "a string, b string, weight double")
    assert [tuple(r) for r in graph.neighbours(e, 1).orderBy("node").collect()] == [("A", 1, "b", 3.0), ("b", 1, "A", 3.0), ("c", 1, "A", 3.0)]
    flags = graph.hub_flags(e, spark.createDataFrame([(" a",)], "name string"))
    assert {(r["a"], r["b"], r["suspect"]) for r in flags.collect()} == {("A", "b", True), ("A", "c", True), ("b", "c", False)}
    comp = spark.createDataFrame([(f"n{i}", f"{c}{i // 2}") for i, c in enumerate("xxyyaazz")], "node string, component string")
    order = sorted({r["component"] for r in comp.collect()})
    want = {(r["node"], f"cluster-{order.index(r['component']) + 1:04d}") for r in comp.collect()}
    assert {tuple(r) for r in graph.numbered(comp, "cluster").collect()} == want
    t = terms(spark, *[("G", f"c{i}", None) for i in range(8)], ("H", "only", None))
    assert {tuple(r) for r in discovery.group_context(t).collect()} == {("G", "c0, c1, c2, c3, c4, c5, ... (8 total)"), ("H", "only (1 total)")}
    batch = spark.createDataFrame([("Kafka",), ("Rust",)], "skill string")
    replies = spark.createDataFrame([(" kafka", 0, "Tools"), ("KAFKA", 1, "Other")], "skill string, pos int, grp string")
    assert {tuple(r) for r in discovery.matched_replies(batch, replies).collect()} == {("Kafka", "Tools"), ("Rust", None)}
    assert discovery.batches(batch.union(batch), 1).count() == 2
    state = spark.createDataFrame([("a", "h1"), ("b", "h2")], "key string, input_hash string")
    assert [r["key"] for r in discovery.live_state(state, "h2").collect()] == ["b"]
    nodes = spark.createDataFrame([("A", 5, 2.0), ("b", 9, -3.0), ("c", 1, None)], "skill string, total_count int, z double")
    assert [(r["skill"], r["rank"]) for r in anomaly.top_outliers(nodes, "z").orderBy("rank").collect()] == [("b", 1), ("A", 2)]
    labels = spark.createDataFrame([("a ", "hub")], "name string, label string")
    assert {(r["skill"], r["label"]) for r in anomaly.with_labels(nodes, labels).collect()} == {("A", "hub"), ("b", None), ("c", None)}


def test_discovery_folder(spark, tmp_path):
    store = tmp_path / "store.json"
    store.write_text('{"Languages": {"Python": ["python3"], "JavaScript": []}, "Cloud": {"AWS": ["amazon web services"]}}')
    lines = [{"title": f"Job {i}", "source_url": f"u{i}", "scraped_at": "2024-01-0%dT00:00:00" % (i + 1), "is_error": False, "technical_skills": ["ArgoCD [Dev_Ops]", "python3"], "extraction_quality": {"unmapped_skills": ["ArgoCD", "Cloud"]}} for i in range(4)]
    records = tmp_path / "in.jsonl"
    records.write_text("\n".join(map(json.dumps, lines)) + "\n\n{broken\n")
    folder = str(tmp_path / "work")
    assert main(["discover", str(records), folder, "--store", str(store), "--threshold", "6"]) == 0
    steps = Discovery(spark, folder, 6)
    entry = steps.table("queue").filter("key = 'argocd'").first()
    assert (entry["seen_count"], entry["status"], entry["first_seen"], entry["last_seen"]) == (4, "pending", "2024-01-01", "2024-01-04")
    assert steps.table("queue").count() == 1
    got = steps.discover(str(records), stores.read_store(spark, str(store)))
    assert got == {"records": 4, "parse_errors": 1, "skipped": 0, "matched": 2, "novel": 1}
    assert steps.table("queue").first()["status"] == "ready_for_promotion" and steps.table("queue").first()["seen_count"] == 8
    assert main(["audit", str(records), folder]) == 0
    assert steps.table("occurrences").filter("skill = 'argocd'").orderBy("nth").first()["line_number"] == 1
    assert {r["skill"]: r["n_files"] for r in steps.table("audit").collect()}["argocd"] == 1
    review = steps.review(stores.read_store(spark, str(store)))
    assert [(r["display_name"], r["action"], r["suggested_group"]) for r in review.collect()] == [("ArgoCD", "approve", "Dev Ops")]
    assert steps.apply() == {"approved": 1, "aliased": 0, "rejected": 0, "skipped": 0}
    assert steps.table("queue").first()["status"] == "approved" and steps.table("approved").first()["canonical"] == "ArgoCD"


def test_dense_edges(spark):
    rows = [("alpha one", [1.0, 0.0]), ("alpha two", [1.0, 0.1]), ("alpha far", [0.0, 1.0]), ("zzz", [1.0, 0.0]), ("no vector", None)]
    v = spark.createDataFrame([r for r in rows if r[1]], "term string, vec array<double>")
    t = spark.createDataFrame([(r[0],) for r in rows], "term string")
    want = [("alpha one", "alpha two", round(1 / 1.01**0.5, 6), "high_collision")]
    for size in (1 << 20, 0):
        assert [tuple(r) for r in similarity.dense_edges(t, v, broadcast_bytes=size, part_rows=2).collect()] == want
    near = spark.createDataFrame([(1, 5, 0.9, 6, 0.95), (2, 5, 0.5, 6, 0.9), (3, 5, 0.5, 6, 0.5)], "id int, best_id int, best_score double, best_in_group int, in_group_score double")
    assert [tuple(r) for r in similarity.alias_verdicts(near).orderBy("id").collect()] == [(1, True, 5), (2, True, 6), (3, False, None)]


def test_model_agents(spark):
    def post(url, payload, timeout):
        if url.endswith("/embedding") and "content" in payload:
            return {"embedding": [float(len(payload["content"]))]}
        raise OSError("no such endpoint")

    assert providers.http_embedder("http://x", post=post)(["p", "qq"]) == [[1.0], [2.0]]
    good = json.dumps({"classification": {"ontological_nature": "Concept", "primary_type": None, "functional_roles": [], "abstraction_level": "Domain"}})
    chat = lambda: lambda p: good if "last answer" in p or "fine" in p else "nonsense"
    rows = spark.createDataFrame([("fine",), ("odd",)], "t string")
    asked = rows.withColumn("p", F.col("t"))
    got = {r["t"]: r["answer"] for r in providers.answered(asked, "t", "p", chat, sound=providers.is_class_reply, repair=providers.class_prompt).collect()}
    assert got == {"fine": good, "odd": good} and not providers.is_class_reply("[]") and providers.is_class_reply('{"type": "category"}')
    skills = spark.createDataFrame([("Kafka",), ("Rust",), ("Old",)], "skill string")
    contexts = spark.createDataFrame([("Tools", "Git (1 total)")], "grp string, context string")
    answer = lambda: lambda p: json.dumps([{"skill": s.upper(), "assigned_group": "Tools", "reasoning": "r"} for s in json.loads(p.splitlines()[-1]) if s != "Rust"])
    done = spark.createDataFrame([("Old",)], "skill string")
    assert {(r["skill"], r["assigned_group"]) for r in providers.assigned_groups(skills, contexts, answer, 1, done).collect()} == {("Kafka", "Tools"), ("Rust", None)}
    t = terms(spark, ("Tools", "Apache Kafka", ["kafka mq"]), ("Tools", "Git", None))
    asked = spark.createDataFrame([("Kafka", "Tools"), ("Rust", "Tools")], "skill string, grp string")
    alias = lambda: lambda p: '{"is_alias": true, "alias_of": "apache kafka"}' if '"Kafka"' in p else '{"is_alias": true, "alias_of": "Unheard of"}'
    assert [tuple(r) for r in providers.semantic_aliases(asked, t, alias).collect()] == [("Kafka", "Tools", "Apache Kafka")]
    first = providers.audited_pairs(t, lambda: lambda p: " No ", None, "h1")
    assert [tuple(r) for r in first.collect()] == [("Apache Kafka", "kafka mq", "no", "h1")]
    again = providers.audited_pairs(t, lambda: lambda p: "yes", first, "h1")
    assert [r["answer"] for r in again.collect()] == ["no"]
    assert [r["answer"] for r in providers.audited_pairs(t, lambda: lambda p: "yes", first, "h2").collect()] == ["yes"]


def test_prompts_show_every_canonical_and_group(spark):
    t = terms(spark, *(("Tools", f"Canon {k:03d}", [f"also {k}"]) for k in range(500)))
    asked = spark.createDataFrame([("x1", "Tools"), ("x2", "Tools"), ("x3", "Tools")], "skill string, grp string")

    def chat(p):
        for skill, name in (("x1", "Canon 499"), ("x2", "Canon 250"), ("x2", "Canon 007")):
            if f'"{skill}"' in p and f'"{name} (aliases: also {int(name[-3:])})"' in p:
                return json.dumps({"is_alias": True, "alias_of": name})
        return '{"is_alias": false}'

    got = providers.semantic_aliases(asked, t, lambda: chat, shown=60).collect()
    assert {(r["skill"], r["alias_of"]) for r in got} == {("x1", "Canon 499"), ("x2", "Canon 007")}
    groups = spark.createDataFrame([(f"Group {k:04d}", "c") for k in range(2100)], "grp string, context string")
    want = {"a": "Group 2050", "b": "NEW: Other", "c": "Group 0003"}

    def give(p):
        shown = [g for g in want.values() if f"- {g}:" in p]
        skills = json.loads(p.splitlines()[-1])
        return json.dumps([{"skill": s, "assigned_group": want[s] if want[s] in shown else "NEW: Other", "reasoning": ""} for s in skills])

    got = providers.assigned_groups(spark.createDataFrame([("a",), ("b",), ("c",)], "skill string"), groups, lambda: give, 2, per_prompt=300)
    assert {r["skill"]: r["assigned_group"] for r in got.collect()} == want


def test_audit_names_all_files_and_matches(spark, tmp_path):
    t = terms(spark, ("Web", "React", ["reactjs"]))
    rows = [("React", f"f{k:02d}.jsonl", 1, 0, f"Job {k % 4}") for k in range(50)] + [("novel thing", "g.jsonl", 2, 0, None), ("REACTJS", "f00.jsonl", 9, 1, "Job 9")]
    got = {r["skill"]: r for r in discovery.audit(spark.createDataFrame(rows, "name string, file string, line_number int, pos int, title string"), t).collect()}
    r = got["react"]
    assert (r["occurrence_count"], r["n_files"], list(r["titles"]), r["canonical"], r["match_type"]) == (50, 50, ["Job 0", "Job 1", "Job 2"], "react", "exact")
    assert list(r["files"]) == [f"f{k:02d}.jsonl" for k in range(50)] and got["novel thing"]["canonical"] is None and got["reactjs"]["canonical"] == "react"


def test_record_lines_over_splits_of_a_file(spark, tmp_path):
    rng = __import__("random").Random(7)
    lines = {}
    for f in ("a.jsonl", "b.jsonl"):
        lines[f] = [rng.choice(["", "x" * rng.randint(1, 300), '{"title": "t%d"}' % k, "  "]) for k in range(400)]
        (tmp_path / f).write_bytes("".join(x + rng.choice(["\n", "\r\n"]) for x in lines[f]).encode())
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1500")
    try:
        rows = stores.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        assert sorted(map(tuple, rows.collect())) == sorted((f, k + 1, x) for f, xs in lines.items() for k, x in enumerate(xs))
        assert {(r["file"], r["line_number"]) for r in stores.read_records(spark, str(tmp_path)).filter("not parse_error").collect()} == {(f, k + 1) for f, xs in lines.items() for k, x in enumerate(xs) if x.startswith("{")}
    finally:
        spark.conf.set(key, before)
    hashes = {r["file"].split("/")[-1]: r["sha256"] for r in stores.content_hash(spark, str(tmp_path)).collect()}
    assert hashes == {f: __import__("hashlib").sha256((tmp_path / f).read_bytes()).hexdigest() for f in lines}


def test_an_interrupted_replacement_keeps_the_queue(spark, tmp_path):
    steps = Discovery(spark, str(tmp_path / "q"))
    steps._replace("queue", spark.range(3))
    (tmp_path / "q" / "queue").rename(tmp_path / "q" / "_queue_old")  # as a crash between the renames leaves it
    assert steps.table("queue").count() == 3
    steps._replace("queue", steps.table("queue").filter("id > 0"))
    assert steps.table("queue").count() == 2 and {p.name for p in (tmp_path / "q").iterdir()} == {"queue"}


def test_settled_terms_equal_the_full_loop(spark):
    """Entries that take several rounds, two that come out alike in the second, and many that stay as they are."""
    t = terms(spark, ("Web", "React/Angular and Vue", ["ui, lib", "x"]), ("Web", "Vue", ["vue.js"]), ("Web", "Angular, Ember", None), ("Web", "Ember (EM)", ["e"]), ("Data", "Vue", ["other"]), *(("Data", f"Plain {chr(97 + k)}", [f"alias {chr(97 + k)}"]) for k in range(20)))
    rows = lambda d: {(r["grp"], r["canonical"], r["alias"]) for r in d.collect()}
    now, want = t, None
    for n in range(5):
        new = rules.rewritten_terms(now).select("grp", "canonical", "alias", "alias_pos").distinct()
        new = spark.createDataFrame(new.collect(), new.schema)
        if rows(new) == want:
            break
        now, want = new.withColumns({"grp_pos": F.lit(0), "canonical_pos": F.lit(0)}), rows(new)
    whole = lambda d: rules.rewritten_terms(d.withColumns({"grp_pos": F.lit(0), "canonical_pos": F.lit(0)}))
    got, read = settled_terms(whole, t)
    assert rows(got) == want
    assert len(read) > 1 and read[0] == t.count() and all(n < read[0] / 2 for n in read[1:])


def test_models_are_looked_up_before_a_run():
    def get(url, timeout):
        if url.endswith("/v1/models"):
            return {"data": [{"id": "org/embed-a"}, {"id": "b"}]}
        raise OSError("none")

    assert providers.model_names("http://h/", get) == ["b", "org/embed-a"]
    providers.verify("http://h", "embed-a", lambda: 1 / 0, get)
    with pytest.raises(RuntimeError, match="no model"):
        providers.verify("http://h", "c", lambda: None, get)

    def silent(url, timeout):
        raise OSError("down")

    asked = []
    providers.verify("http://h", "c", lambda: asked.append(1), silent)
    providers.verify("http://h", None, lambda: asked.append(2), get)
    assert asked == [1, 2] and providers.model_names("http://h", silent) is None


def test_clean_with_a_model_and_one_stage_again(spark, tmp_path):
    def chat(p):
        if "similar terms" in p:
            terms_asked = json.loads(p.splitlines()[0].split(": ", 1)[1])
            return json.dumps({"decisions": [{"term": t, "action": "KEEP_DISTINCT", "confidence": "HIGH", "reasoning": {}} for t in terms_asked]})
        return json.dumps({"classification": {"ontological_nature": "Concept", "primary_type": "x", "functional_roles": ["r"], "abstraction_level": "Method"}, "confidence": "HIGH", "is_contextual": True})

    t = terms(spark, ("Web", "Vector Index", ["vi"]), ("Web", "Vector Indexing", None), ("Web", "Vector Indexes", None))
    settings = Settings(threshold=0.6, arbiter=model_arbiter(lambda: chat, "m"), classifier=model_classifier(lambda: chat, "m"))
    run = Run(spark, t, str(tmp_path / "run"), settings)
    with pytest.raises(RuntimeError, match="needs stages"):
        run.only(3)
    out = run.run()
    assert {r["effective_action"] for r in out["decisions"].collect()} == {"KEEP_DISTINCT"} and out["decisions"].count() == 3
    records = {r["canonical"]: r for r in out["class_records"].collect()}
    assert records["Vector Index"]["aliases"] == ["vi"] and records["Vector Index"]["tags"] == ["Web"] and records["Vector Index"]["is_contextual"]
    assert list(records["Vector Index"]["classification"]["functional_roles"]) == ["r"]
    assert set(run.only(3)) == {"decisions", "decision_findings"}
