"""Heuristic arbitration and classification, and the rules that govern model decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.functions import text as T
from lexmill.operators.rules import finding

# Word lists that decide the results, in order of precedence.
HEURISTIC_PREFIXES = ("core ", "advanced ", "backend ", "frontend ")
HEURISTIC_CLASSES = (
    (("algorithm", "regression", "tree", "network", "boost"), "Algorithm", "Method", "Machine Learning Model"),
    (("protocol", "http", "tcp", "oauth", "oidc"), "Protocol", "Method", "Protocol"),
    (("framework", "spring", "django", "react", "angular"), "Software Artifact", "Concrete", "Framework"),
    (("library", "numpy", "pandas", "sdk"), "Software Artifact", "Concrete", "Library"),
    (("architecture", "design", "method", "pattern"), "Concept", "Method", "Architecture Style"),
)
HEURISTIC_DOMAINS = ("databases", "tools", "software engineering", "security", "frontend development")
MARKETING = ("next-gen", "enterprise-grade", "state-of-the-art")
NATURE_MARKERS = (
    ("Protocol", ("protocol", "http", "https", "tcp", "udp", "grpc", "mqtt", "dns", "smtp", "imap", "ldap", "oauth", "openid")),
    ("Standard / Specification", ("standard", "specification", "spec", "rfc", "iso", "ieee")),
    ("Algorithm", ("algorithm", "search", "sort", "clustering", "regression", "classification", "optimization", "pathfinding", "gradient")),
    ("Human Skill", ("leadership", "communication", "mentoring", "collaboration", "negotiation", "presentation", "stakeholder")),
    ("Concept", ("concept", "methodology", "workflow", "process", "practice", "strategy", "governance", "analysis")),
)
CONCRETE_MARKERS = ("framework", "library", "sdk", "api", "tool", "platform", "service", "database", "runtime", "engine")
METHOD_MARKERS = ("workflow", "method", "practice", "pattern")
DOMAIN_NAMES = ("computer vision", "machine learning", "deep learning", "natural language processing", "data science", "data engineering", "artificial intelligence")


def inferred_nature(primary_type: Column, canonical: Column) -> Column:
    """[FN-32]"""
    text = F.lower(F.concat_ws(" ", primary_type, canonical))
    out = F.when(F.lit(False), "")
    for nature, words in NATURE_MARKERS:
        out = out.when(S.any_of(text, words), nature)
    return out.otherwise("Software Artifact")


def inferred_level(nature: Column, primary_type: Column, canonical: Column) -> Column:
    """[FN-33]"""
    text = F.lower(F.concat_ws(" ", primary_type, canonical))
    return (
        F.when(nature.isin("Algorithm", "Standard / Specification", "Protocol"), "Method")
        .when(nature.isin("Concept", "Human Skill"), "Domain")
        .when(S.any_of(text, CONCRETE_MARKERS), "Concrete")
        .when(S.any_of(text, METHOD_MARKERS), "Method")
        .otherwise("Concrete")
    )


def is_domain(canonical: Column, primary_type: Column) -> Column:
    """[FN-34]"""
    name = F.lower(T.trimmed(canonical))
    return name.isin(*DOMAIN_NAMES) | (F.lower(T.trimmed(primary_type)).isin("technology", "general") & name.endswith("vision"))


def named_nature(value: Column) -> Column:
    """[FN-35] The enumerated nature that a free text names, else null."""
    text = F.lower(T.trimmed(value))
    out = F.when(F.lit(False), "")
    for nature in S.NATURES:
        out = out.when(text == nature.lower(), nature)
    return out.when(text.contains("standard") | text.contains("specification"), "Standard / Specification").when(text.contains("skill"), "Human Skill").when(text.contains("protocol"), "Protocol").when(text.contains("algorithm"), "Algorithm").when(text.contains("concept"), "Concept")


def heuristic_classes(terms: DataFrame) -> DataFrame:
    """[UD-04, IO-13] Classification of a column ``term`` by ordered word lists."""
    n = T.normalize(F.col("term"))
    nature, level, kind = (F.when(F.lit(False), "") for _ in range(3))
    for words, a, b, c in HEURISTIC_CLASSES:
        hit = S.any_of(n, words)
        nature, level, kind = nature.when(hit, a), level.when(hit, b), kind.when(hit, c)
    domain = n.isin(*HEURISTIC_DOMAINS)
    context = F.lit(False)
    for p in HEURISTIC_PREFIXES:
        context = context | n.startswith(p)
    return terms.select(
        "term",
        nature.when(domain, "Concept").otherwise("Software Artifact").alias("ontological_nature"),
        kind.alias("primary_type"),
        level.when(domain, "Domain").otherwise("Concrete").alias("abstraction_level"),
        context.alias("is_contextual"),
        T.has_version(F.col("term")).alias("is_versioned"),
        S.any_of(n, MARKETING).alias("is_marketing_language"),
        F.when(context, "MEDIUM").otherwise("HIGH").alias("confidence"),
        F.when(context, "under_review").otherwise("active").alias("status"),
    )


FLAGS = ("is_contextual", "is_versioned", "is_marketing_language")
MOST_ROLES = 8


def distinct_roles(roles: Column, most: int = MOST_ROLES) -> Column:
    """[FN-36] The first spelling of each text of a list, without empty ones, at most ``most``; an empty list for null."""
    texts = F.filter(F.transform(F.coalesce(roles, F.array().cast("array<string>")), lambda r: F.trim(r)), lambda r: r.isNotNull() & (r != ""))
    low = F.transform(texts, lambda r: F.lower(r))
    return F.slice(F.filter(texts, lambda r, i: F.array_position(low, F.lower(r)) == i + 1), 1, most)


def normalised_classes(rows: DataFrame) -> DataFrame:
    """[GV-08, GV-09, FN-27..FN-29, FN-36] Valid enumerations from (term, ontological_nature, primary_type, abstraction_level, confidence, status) as given.

    Functional roles (a list) and the flags is_contextual, is_versioned and is_marketing_language are carried where ``rows``
    has them: roles once each, flags as booleans, false where nothing sensible is given.
    """
    more = {f: S.boolean(F.col(f).cast("string")).alias(f) for f in FLAGS} | {"functional_roles": distinct_roles(F.col("functional_roles")).alias("functional_roles")}
    more = {name: made for name, made in more.items() if name in rows.columns}
    kind = F.coalesce(F.nullif(T.trimmed(F.col("primary_type")), F.lit("")), F.col("term"))
    level = F.initcap(T.trimmed(F.col("abstraction_level")))
    given = rows.select("term", kind.alias("kind"), named_nature(F.col("ontological_nature")).alias("named"), F.when(level.isin(*S.LEVELS), level).alias("level"), S.confidence(F.col("confidence")).alias("confidence"), F.col("status").alias("said"), *more.values())
    # One step after the other: as one expression the generated code outgrows what the JVM compiles.
    told = given.withColumn("nature", F.coalesce("named", inferred_nature(F.col("kind"), F.col("term")))).withColumn("domain", is_domain(F.col("term"), F.col("kind")))
    told = told.withColumn("level", F.coalesce("level", inferred_level(F.col("nature"), F.col("kind"), F.col("term"))))
    domain = F.col("domain")
    return told.select(
        "term",
        F.when(domain, "Concept").otherwise(F.col("nature")).alias("ontological_nature"),
        F.when(domain, F.col("term")).otherwise(F.col("kind")).alias("primary_type"),
        F.when(domain, "Domain").otherwise(F.col("level")).alias("abstraction_level"),
        "confidence",
        S.status(F.col("said"), F.col("confidence")).alias("status"),
        *more,
    )


def class_records(classes: DataFrame, terms: DataFrame) -> DataFrame:
    """[GV-09] The second version's records of classified canonicals: aliases, the group as tag, classification, status, confidence.

    A canonical of several groups has a record in each; one without a class has none.  Roles and flags that ``classes``
    doesn't have are empty and false.
    """
    for name, default in (*((f, F.lit(False)) for f in FLAGS), ("functional_roles", F.array().cast("array<string>"))):
        if name not in classes.columns:
            classes = classes.withColumn(name, default)
    names = terms.filter("canonical is not null").groupBy("grp", "canonical").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))  # of one canonical
    what = F.struct("ontological_nature", "primary_type", "functional_roles", "abstraction_level").alias("classification")
    rows = names.join(classes.withColumnRenamed("term", "canonical"), "canonical")
    return rows.select("canonical", "aliases", F.array("grp").alias("tags"), what, "status", "confidence", *FLAGS)


def heuristic_arbitration(members: DataFrame) -> DataFrame:
    """[UD-03] Decisions for (cluster_id, term): split at a slash, mark a contextual prefix anywhere, else keep."""
    term, n = F.col("term"), T.normalize(F.col("term"))
    tokens = T.explicit_tokens(term)
    split = term.contains("/") & (F.size(tokens) > 1)
    context = S.any_of(n, HEURISTIC_PREFIXES)
    rest = F.when(term.contains(" "), F.expr("substring(term, locate(' ', term) + 1)")).otherwise(term)
    none = F.lit(None).cast("string")
    return members.select(
        "cluster_id",
        "term",
        F.when(split, "SPLIT_INTO_MULTIPLE_CANONICALS").when(context, "MARK_AS_CONTEXTUAL").otherwise("KEEP_DISTINCT").alias("action"),
        F.when(~split & context, rest).otherwise(none).alias("target_canonical"),
        F.when(split, F.array_sort(tokens)).alias("split_candidates"),
        F.when(split, "Unknown").when(context, "Same").otherwise("Unknown").alias("ecosystem"),
        F.when(~split & context, "Same").otherwise("Unknown").alias("abstraction_level"),
        F.when(split, "Split preferred over merge for composite terms.").when(context, "Mapping preserves canonical graph clarity.").otherwise("Precision-first default.").alias("graph_safety"),
        F.when(~split & context, "MEDIUM").otherwise("HIGH").alias("confidence"),
    )


def governed(decisions: DataFrame, members: DataFrame, canonicals: DataFrame) -> DataFrame:
    """[GV-01..GV-03, L3-002] Violations, blocked and effective_action of decisions.

    Known canonicals among the split candidates are found by a join on the exploded candidates; any violation, and low
    confidence, keeps the term distinct.
    """
    own = members.select("cluster_id", "term", F.lit(True).alias("in_cluster")).distinct()
    known = canonicals.select(T.normalize(F.col("canonical")).alias("c")).distinct()
    keyed = decisions.withColumn("did", F.struct("cluster_id", "term"))
    overlap = keyed.select("did", F.explode("split_candidates").alias("x")).select("did", T.normalize(F.col("x")).alias("c")).join(known, "c", "left_semi").select("did", F.lit(True).alias("overlaps")).distinct()
    rows = keyed.join(own, ["cluster_id", "term"], "left").join(overlap, "did", "left")
    action, conf = F.col("action"), F.col("confidence")
    parts = F.transform("split_candidates", T.normalize)
    tokens = T.explicit_tokens(F.col("term"))
    split = action == "SPLIT_INTO_MULTIPLE_CANONICALS"
    has = F.size(F.coalesce(parts, F.array().cast("array<string>"))) > 0
    says = lambda column, word: F.coalesce(T.normalize(F.col(column)).contains(word), F.lit(False))
    tests = (
        ("term_not_in_cluster", F.col("in_cluster").isNull()),
        ("invalid_action", ~F.coalesce(action.isin(*S.ACTIONS), F.lit(False))),
        ("invalid_confidence", ~F.coalesce(conf.isin(*S.CONFIDENCES), F.lit(False))),
        ("missing_target_canonical", action.isin("MERGE_AS_ALIAS", "MARK_AS_CONTEXTUAL") & (F.trim(F.coalesce("target_canonical", F.lit(""))) == "")),
        ("ecosystem_mismatch", (action == "MERGE_AS_ALIAS") & says("ecosystem", "different")),
        ("abstraction_mismatch", (action == "MERGE_AS_ALIAS") & says("abstraction_level", "different")),
        ("split_requires_high_confidence", split & (F.coalesce(conf, F.lit("")) != "HIGH")),
        ("split_candidates_required", split & ~has),
        ("split_duplicate_targets", split & has & (F.size(F.array_distinct(parts)) < F.size(parts))),
        ("split_candidate_blank", split & has & F.exists(parts, lambda p: p == "")),
        ("split_not_explicit_token_decomposition", split & has & F.exists(parts, lambda p: (p != "") & ~F.array_contains(tokens, p))),
        ("split_candidate_not_atomic", split & has & F.exists(parts, lambda p: (p != "") & (F.size(T.atomicity_reasons(p)) > 0))),
        ("split_target_already_exists_requires_explicit_mapping", split & F.coalesce("overlaps", F.lit(False))),
        ("split_graph_impact_unsafe", split & says("graph_safety", "unsafe")),
        ("split_abstraction_mismatch", split & says("abstraction_level", "different")),
        ("low_confidence_containment", F.coalesce(conf == "LOW", F.lit(False))),
    )
    found = F.array_sort(F.filter(F.array(*[F.when(t, F.lit(n)) for n, t in tests]), lambda x: x.isNotNull()))
    out = rows.withColumn("violations", found)
    return out.select(
        "cluster_id",
        "term",
        action.alias("requested_action"),
        F.when(F.size("violations") > 0, "KEEP_DISTINCT").otherwise(action).alias("effective_action"),
        "target_canonical",
        "split_candidates",
        F.when(conf.isin(*S.CONFIDENCES), conf).otherwise("LOW").alias("confidence"),
        (F.size("violations") > 0).alias("blocked"),
        "violations",
    )


def violation_findings(decisions: DataFrame) -> DataFrame:
    """[L3-002] A blocking finding for each governed decision with violations."""
    at = F.concat(F.lit("cluster:"), "cluster_id", F.lit("|term:"), "term")
    rows = decisions.filter("blocked")
    return finding(rows, "L3-002", True, at, F.coalesce("requested_action", F.lit("")), F.array_join("violations", ","), "manual_review", "decision breaks the rules of governance")


def review_queue(decisions: DataFrame, classes: DataFrame, suffixes: DataFrame | None = None, advisories: DataFrame | None = None) -> DataFrame:
    """[SO-01, SO-06, ST-04, PD-11] (term, stage, issue, proposed_action, confidence) for people to look at, without repeats."""
    row = lambda df, term, stage, issue, action: df.select(F.col(term).alias("term"), F.lit(stage).alias("stage"), F.lit(issue).alias("issue"), action.alias("proposed_action"), F.lit("LOW").alias("confidence"))
    out = row(decisions.filter("confidence = 'LOW'"), "term", 3, "LOW confidence arbitration", F.col("requested_action"))
    out = out.unionByName(row(classes.filter("status = 'under_review'"), "term", 4, "classification under review", F.col("ontological_nature")))
    if suffixes is not None:
        out = out.unionByName(row(suffixes, "alias", 3, "alias ends in a canonical", F.concat(F.lit("remove_alias:"), "matched")))
    if advisories is not None:
        out = out.unionByName(row(advisories, "alias", 3, "alias resembles a canonical", F.concat(F.lit("review:"), "target_canonical")))
    return out.distinct().orderBy("stage", "term", "issue", "proposed_action")


def exit_code(parse_error: bool, blocking: bool, graph: bool) -> int:
    """[GV-13]"""
    return 3 if parse_error else 4 if graph else 2 if blocking else 0
