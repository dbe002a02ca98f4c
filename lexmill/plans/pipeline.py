"""The governed clean-up as seven stages over DataFrames, with resume by content and an exit code.

Stages: 0 pre-clean, 1 similarity, 2 clusters, 3 arbitration, 4 classification, 5 graph checks, 6 report.  Each stage's
tables are written as Parquet under the run folder with a manifest of the input's digest and the settings, and a stage
whose manifest is the same is read back, not run again.  The digest covers the term table, the block list, the
exceptions, the settings and what the providers read.  Providers give decisions, or decisions and findings; the default
ones are heuristics, file-backed ones join a table of decisions and fall back on the heuristics, and reply-backed ones
read model replies as text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import governance, graph, replies, rules, similarity
from lexmill.operators.components import Written, cut
from lexmill.sources import providers

#: [OR-01] stage -> (tables it makes, stages it needs)
STAGES: dict[int, tuple[tuple[str, ...], tuple[int, ...]]] = {
    0: (("findings", "terms", "suffixes", "rewritten_findings"), ()),
    1: (("edges", "advisories"), (0,)),
    2: (("clusters",), (1,)),
    3: (("decisions", "decision_findings"), (0, 2)),
    4: (("classes", "class_records", "class_findings"), (0,)),
    5: (("graph_findings",), (1, 2, 4)),
    6: (("review", "summary", "report"), (0, 1, 3, 4, 5)),
}

Given = DataFrame | tuple[DataFrame, DataFrame]
Arbiter = Callable[[DataFrame], Given]
Classifier = Callable[[DataFrame], Given]


def digest(rows: DataFrame) -> str:
    """[SS-06, SS-07] SHA-256 over the sums of 60-bit parts of each row's SHA-256: the same for the same rows in any order."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)]), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.sum(F.conv(F.substring(F.col("h"), 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string").alias(f"p{i}")
    got = rows.select(row.alias("h")).agg(F.count(F.lit(1)).cast("string").alias("n"), *[part(i) for i in range(4)]).first()
    return hashlib.sha256("|".join(str(v) for v in got).encode()).hexdigest()


def identity(provider: Callable) -> str:
    """What a provider is, for the manifest: the digest of what it reads, else its name."""
    return getattr(provider, "mark", None) or f"{provider.__module__}.{provider.__qualname__}"


@dataclass
class Settings:
    threshold: float = 0.85
    high: float = 0.93
    most_cluster: int = 10
    over_generic: float = 0.70
    phantom: float = 0.90
    arbiter: Arbiter = field(default=governance.heuristic_arbitration, repr=False)
    classifier: Classifier = field(default=governance.heuristic_classes, repr=False)
    embedder: Callable[[DataFrame], DataFrame] | None = field(default=None, repr=False)  # (term) -> (term, vec)


def file_backed(decisions: DataFrame, key: str, fallback: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """[IO-13] Decisions looked up by normalised ``key``; terms that have none go to ``fallback``."""

    def give(rows: DataFrame) -> DataFrame:
        made = fallback(rows)
        norm = lambda c: F.lower(F.trim(c))
        known = decisions.select(norm(F.col(key)).alias("__key"), *[F.col(c).alias(f"__{c}") for c in made.columns if c in decisions.columns and c != key])
        joined = made.join(known, norm(F.col(key)) == F.col("__key"), "left")
        return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if f"__{c}" in known.columns else F.col(c) for c in made.columns])

    give.mark = f"file|{key}|{digest(decisions)}|{identity(fallback)}"
    return give


def reply_arbiter(given: DataFrame) -> Arbiter:
    """[IO-13, L3-001] Decisions from replies (cluster_id, reply); those of clusters at hand, and findings on broken replies."""

    def give(members: DataFrame) -> Given:
        asked = given.join(members.select("cluster_id").distinct(), "cluster_id", "left_semi")
        return replies.decisions(asked)

    give.mark = f"replies|{digest(given)}"
    return give


def reply_classifier(given: DataFrame) -> Classifier:
    """[IO-13, L4-001..L4-005] Classes from replies (term, reply) to the terms at hand, and findings."""

    def give(terms: DataFrame) -> Given:
        return replies.classes(given.join(terms.select("term").distinct(), "term", "left_semi"))

    give.mark = f"replies|{digest(given)}"
    return give


def model_arbiter(make: Callable[[], providers.Chat], mark: str) -> Arbiter:
    """[UD-01, UD-05] Decisions of a model that is asked for each cluster; ``mark`` names it in the manifest."""

    def give(members: DataFrame) -> Given:
        asked = members.groupBy("cluster_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))  # of one cluster
        prompt = F.pandas_udf(lambda terms: pd.Series([providers.cluster_prompt(list(t)) for t in terms]), "string")
        got, _ = cut(providers.answered(asked.withColumn("prompt", prompt("terms")), "cluster_id", "prompt", make), "replies")
        return replies.decisions(got.select("cluster_id", F.col("answer").alias("reply")))

    give.mark = f"model|{mark}"
    return give


def model_classifier(make: Callable[[], providers.Chat], mark: str) -> Classifier:
    """[UD-05] Classes of a model that is asked for each term, and once more where its answer has no sound shape."""

    def give(terms: DataFrame) -> Given:
        prompt = F.pandas_udf(lambda t: pd.Series([providers.class_prompt(x) for x in t]), "string")
        asked = terms.select("term").distinct().withColumn("prompt", prompt("term"))
        got, _ = cut(providers.answered(asked, "term", "prompt", make, sound=providers.is_class_reply, repair=lambda p, a: f"{p}\nYour last answer didn't have this shape; correct it:\n{a}"), "replies")
        return replies.classes(got.select("term", F.col("answer").alias("reply")))

    give.mark = f"model|{mark}"
    return give


def needed(last: int, done: set[int]) -> list[int]:
    """[OR-03] Stages to run for ``last``, those done left out, in order."""
    todo: set[int] = set()

    def add(stage: int) -> None:
        if stage not in todo and stage not in done:
            todo.add(stage)
            for before in STAGES[stage][1]:
                add(before)

    add(last)
    return sorted(todo)


class Run:
    """[OR-02..OR-04, SS-06] One run over a term table (grp, canonical, alias, with places)."""

    def __init__(self, spark: SparkSession, terms: DataFrame, folder: str, settings: Settings | None = None, pairs: DataFrame | None = None, exceptions: DataFrame | None = None):
        self.spark, self.input, self.folder, self.settings = spark, terms, folder.rstrip("/"), settings or Settings()
        self.pairs, self.exceptions = pairs, exceptions
        read = [digest(t) if t is not None else "-" for t in (terms, pairs, exceptions)]
        self.mark = "|".join([*read, str(self.settings), *(identity(p) if p else "-" for p in (self.settings.arbiter, self.settings.classifier, self.settings.embedder))])

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def done(self) -> set[int]:
        """Stages whose manifest has this input and these settings."""
        out = set()
        for stage in STAGES:
            try:
                if self.spark.read.text(self._path(f"_manifest_{stage}"), wholetext=True).first()["value"].strip() == self.mark:
                    out.add(stage)
            except Exception as e:  # a path that isn't there has its own error class
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        return out

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def _keep(self, stage: int, **tables: DataFrame) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(self._path(name))
        self.spark.createDataFrame([(self.mark,)], "value string").coalesce(1).write.mode("overwrite").text(self._path(f"_manifest_{stage}"))

    def only(self, stage: int) -> dict[str, DataFrame]:
        """[OR-03] Run one stage again on the tables of the folder; those that it needs must be there."""
        missing = set(STAGES[stage][1]) - self.done()
        if missing:
            raise RuntimeError(f"stage {stage} needs stages {sorted(missing)} first")
        getattr(self, f"stage{stage}")()
        return {name: self.table(name) for name in STAGES[stage][0]}

    def run(self, last: int = 6, workers: int = 2) -> dict[str, DataFrame]:
        """Run what is needed up to ``last``; stage 4 runs beside stages 1 to 3."""
        todo = needed(last, self.done())
        if 0 in todo:
            self.stage0()
        with ThreadPoolExecutor(max(2, workers)) as pool:
            beside = [pool.submit(self.stage4)] if 4 in todo else []
            for stage in (1, 2, 3):
                if stage in todo:
                    getattr(self, f"stage{stage}")()
            for f in beside:
                f.result()
        for stage in (5, 6):
            if stage in todo:
                getattr(self, f"stage{stage}")()
        return {name: self.table(name) for stage in range(last + 1) if stage in self.done() for name in STAGES[stage][0]}

    def stage0(self) -> None:
        findings = rules.all_findings(self.input, self.pairs, self.exceptions)
        rewritten = rules.without_auto_dropped(rules.rewritten_terms(self.input, self.pairs, self.exceptions))
        self._keep(0, findings=findings, terms=rewritten, suffixes=rules.suffix_overlaps(rewritten), rewritten_findings=rules.rewritten_findings(rewritten))

    def stage1(self) -> None:
        terms, s = self.table("terms"), self.settings
        names = terms.select(F.col("canonical").alias("term")).distinct()
        if s.embedder is None:
            edges = similarity.trigram_edges(names, s.threshold, s.high)
        else:
            edges = similarity.dense_edges(names, s.embedder(names), s.threshold, s.high)
        self._keep(1, edges=edges, advisories=similarity.alias_advisories(terms, s.threshold, s.high))

    def _edges(self) -> DataFrame:
        return self.table("edges").select(F.col("left").alias("a"), F.col("right").alias("b"), F.col("score").alias("weight"))

    def stage2(self) -> None:
        rows = graph.clusters(self._edges(), self.settings.most_cluster).withColumn("component", F.concat_ws("#", "component", F.col("split").cast("string")))
        self._keep(2, clusters=graph.numbered(rows.select(F.col("term").alias("node"), "component"), "cluster").select(F.col("id").alias("cluster_id"), F.col("node").alias("term")))

    def stage3(self) -> None:
        members = self.table("clusters")
        given, broken = _parted(self.settings.arbiter(members))
        made = governance.governed(given, members, self.table("terms").select("canonical").distinct())
        made.write.mode("overwrite").parquet(self._path("decisions"))
        refused = governance.violation_findings(self.table("decisions"))
        self._keep(3, decision_findings=refused if broken is None else refused.unionByName(broken))

    def stage4(self) -> None:
        names = self.table("terms").select(F.col("canonical").alias("term")).distinct()
        given, broken = _parted(self.settings.classifier(names))
        none = self.table("findings").limit(0)
        classes = governance.normalised_classes(given)
        records = governance.class_records(classes, self.table("terms"))
        self._keep(4, classes=classes, class_records=records, class_findings=none if broken is None else broken)

    def stage5(self) -> None:
        levels = self.table("classes").select("term", F.col("abstraction_level").alias("level"))
        members = self.table("clusters").select(F.col("cluster_id").alias("cluster"), "term")
        self._keep(5, graph_findings=graph.graph_findings(self._edges(), members, levels, self.settings.over_generic, self.settings.phantom))

    def stage6(self) -> None:
        review = governance.review_queue(self.table("decisions"), self.table("classes"), self.table("suffixes"), self.table("advisories"))
        every = self.findings()
        self._keep(6, review=review, summary=rules.findings_summary(every), report=rules.findings_by(every))

    def findings(self) -> DataFrame:
        """[SO-02] Findings of the stages 0, 3 and 4; those of the graph stay apart."""
        return self.table("findings").unionByName(self.table("decision_findings")).unionByName(self.table("class_findings"))

    def exit_code(self) -> int:
        """[GV-13] 3 for a reply that couldn't be read, 4 for a blocking graph finding, 2 for any other blocking one, else 0."""
        every = self.findings()
        unread = not every.filter(F.col("rule_id").isin("L3-001", "L4-001", "L4-002")).isEmpty()
        return governance.exit_code(unread, not every.filter("blocking").isEmpty(), not self.table("graph_findings").filter("blocking").isEmpty())

    def proposed_changes(self) -> dict[str, DataFrame]:
        """[GV-14, AG-25, ST-05]"""
        changed = F.col("blocked") | ~F.col("requested_action").eqNullSafe(F.col("effective_action"))
        return {
            "blocking": self.findings().filter("blocking").orderBy("rule_id", "location"),
            "arbitration": self.table("decisions").filter(changed).orderBy("cluster_id", "term"),
            "classification": self.table("classes").filter("status = 'under_review'").orderBy("term"),
            "graph": self.table("graph_findings").orderBy("rule_id", "term"),
            "review": self.table("review").orderBy("stage", "term"),
        }

    def markdown(self, rows: int = 50) -> str:
        """[IO-18] Counts of each section and its first ``rows`` rows."""
        out = ["# Proposed changes", ""]
        for name, df in self.proposed_changes().items():
            out += [f"## {name} ({df.count()})", ""]
            out += ["- " + "; ".join(f"{k}: {v}" for k, v in r.asDict().items() if v is not None) for r in df.limit(rows).collect()] + [""]
        return "\n".join(out)


def _parted(given: Given) -> tuple[DataFrame, DataFrame | None]:
    return given if isinstance(given, tuple) else (given, None)


def settled(step: Callable[[DataFrame], DataFrame], rows: DataFrame, most: int = 5) -> tuple[DataFrame, int]:
    """[SS-08] Apply ``step`` until its rows stay the same, ``most`` times at most."""
    for n in range(1, most + 1):
        new = step(rows)
        if new.exceptAll(rows).isEmpty() and rows.exceptAll(new).isEmpty():
            return new, n
        rows = new
    return rows, most


def settled_terms(step: Callable[[DataFrame], DataFrame], terms: DataFrame, most: int = 5) -> tuple[DataFrame, list[int]]:
    """[SS-08] What ``step`` makes of (grp, canonical, alias, alias_pos) applied up to ``most`` times, and the rows it read each time.

    ``step`` takes entries apart and merges those of a group that come out alike, and says of each row its
    ``source_canonical``; an entry's result depends on it and on those that it is merged with alone.  So an entry that
    came out as it went in, fed by nothing but itself, is left alone until another one comes out under its name.  Each
    round takes the entries that changed, gave something away or got something, and those whose names they came out
    under; the state is written after each.
    """
    tables = Written(terms.sparkSession)
    columns = ["grp", "canonical", "alias", "alias_pos"]
    named = lambda df: df.withColumn("key", T.normalize(F.col("canonical")))
    at = ["grp", "key"]
    active = tables.put("active", named(terms.select(*columns)).distinct())
    rest = tables.put("rest", active.limit(0))
    read: list[int] = []
    for _ in range(most):
        out = tables.put("out", named(step(active.select(*columns)).select(*columns, "source_canonical")))
        hit = tables.put("hit", rest.join(out.select(*at).distinct(), at, "left_semi"))
        if not hit.isEmpty():
            active = tables.put("active", active.unionByName(hit))
            out = tables.put("out", named(step(active.select(*columns)).select(*columns, "source_canonical")))
        read.append(active.count())
        digest_of = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("canonical", "alias").cast("decimal(38,0)")).alias("h"))
        source = T.normalize(F.col("source_canonical"))
        before = active.select(*at, "canonical", "alias").distinct().groupBy(*at).agg(*digest_of)
        after = out.select(*at, "canonical", "alias").distinct().groupBy(*at).agg(F.count(F.lit(1)).alias("n2"), F.sum(F.xxhash64("canonical", "alias").cast("decimal(38,0)")).alias("h2"))
        unlike = before.join(after, at, "full_outer").filter(~(F.col("n").eqNullSafe(F.col("n2")) & F.col("h").eqNullSafe(F.col("h2")))).select(*at)
        moved = out.filter(source != F.col("key"))
        changed = unlike.unionByName(moved.select(*at)).unionByName(moved.select("grp", source.alias("key"))).distinct()
        changed = tables.put("changed", changed)
        kept = out.select(*columns, "key").distinct()
        rest = tables.put("rest", rest.join(hit.select(*at).distinct(), at, "left_anti").unionByName(kept.join(changed, at, "left_anti")))
        active = tables.put("active", kept.join(changed, at, "left_semi"))
        if active.isEmpty():
            break
    tables.close("rest", "active")
    return rest.unionByName(active).select(*columns), read
