"""Integrity rules over the long term table (grp, canonical, alias, with places) as set-based findings.

Each rule gives rows (rule_id, blocking, location, observed_value, normalized_value, proposed_action, reason).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.functions import text as T

FINDING = ("rule_id", "blocking", "location", "observed_value", "normalized_value", "proposed_action", "reason")
LISTED = 10

# Names that are atomic although they don't look it.
ATOMIC_EXCEPTIONS = ("tcp/ip", "pl/sql", "google cloud pub/sub", "ibm z/os", "ibm z/vse", "ibm z/vm", "os/390")


def finding(rows: DataFrame, rule: str, blocking: bool, location: Column, observed: Column, normal: Column, action: str, reason: str) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule_id"), F.lit(blocking).alias("blocking"), location.alias("location"), observed.alias("observed_value"), normal.alias("normalized_value"), F.lit(action).alias("proposed_action"), F.lit(reason).alias("reason"))


def _places(rows: DataFrame, key: Column, limit: int | None = LISTED) -> DataFrame:
    """(norm, n, location): occurrences of a normalised term, their first ``limit`` places sorted and joined.

    Places are counted and ranked before any is collected, so a term of very many places gathers no more than it shows.
    """
    each = rows.groupBy(key.alias("norm"), S.location(F.col("grp"), F.col("canonical")).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    total = each.groupBy("norm").agg(F.sum("n").alias("n"))
    if limit:
        nth = F.row_number().over(Window.partitionBy("norm").orderBy("at"))
        each = each.withColumn("nth", nth).filter(F.col("nth") <= limit)
    shown = each.groupBy("norm").agg(F.array_join(F.array_sort(F.collect_list("at")), ", ").alias("location"))
    return total.join(shown, "norm")


def canonicals(terms: DataFrame) -> DataFrame:
    """Distinct (grp, canonical) but those equal to their own group, which L1-012 removes."""
    return terms.select("grp", "canonical").distinct().filter(T.normalize(F.col("grp")) != T.normalize(F.col("canonical")))


def aliases(terms: DataFrame) -> DataFrame:
    return terms.filter(F.col("alias").isNotNull() & (T.normalize(F.col("grp")) != T.normalize(F.col("canonical"))))


def duplicate_canonicals(terms: DataFrame) -> DataFrame:
    """[L1-002, JN-01]"""
    rows = _places(canonicals(terms), T.normalize(F.col("canonical")), None).filter("n > 1")
    return finding(rows, "L1-002", True, F.col("location"), F.col("norm"), F.col("norm"), "merge_duplicates", "canonical occurs more than once")


def alias_collisions(terms: DataFrame) -> DataFrame:
    """[L1-003, JN-03] Aliases that equal a canonical; both sides aggregated before the join."""
    a = _places(aliases(terms), T.normalize(F.col("alias"))).select("norm", F.col("location").alias("at"))
    c = _places(canonicals(terms), T.normalize(F.col("canonical"))).select("norm", "location")
    rows = a.join(c, "norm").select("norm", F.concat_ws(" | ", "at", "location").alias("location"))
    return finding(rows, "L1-003", True, F.col("location"), F.col("norm"), F.col("norm"), "remove_alias", "alias equals a canonical")


def alias_multiplicity(terms: DataFrame) -> DataFrame:
    """[L1-004, JN-02] Aliases of more than one canonical."""
    keyed = aliases(terms).select(T.normalize(F.col("alias")).alias("norm"), T.normalize(F.col("canonical")).alias("target"), "grp", "canonical")
    several = keyed.groupBy("norm").agg(F.count_distinct("target").alias("targets")).filter("targets > 1")
    rows = several.join(_places(keyed, F.col("norm")), "norm")
    return finding(rows, "L1-004", True, F.col("location"), F.col("norm"), F.col("norm"), "choose_canonical", "alias maps to several canonicals")


def group_collisions(terms: DataFrame) -> DataFrame:
    """[L1-005, JN-04] Group names that equal a canonical of another group."""
    groups = terms.select(F.col("grp").alias("name")).distinct().select("name", T.normalize(F.col("name")).alias("norm"))
    rows = groups.join(_places(canonicals(terms), T.normalize(F.col("canonical")), None), "norm")
    return finding(rows, "L1-005", True, F.col("location"), F.col("name"), F.col("norm"), "rename_canonical", "group name equals a canonical")


def non_atomic(terms: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """[L1-006, PD-06] Canonicals that break atomicity and are no exception."""
    rows = canonicals(terms).withColumn("norm", T.normalize(F.col("canonical"))).filter(F.size(T.atomicity_reasons(F.col("canonical"))) > 0)
    rows = rows.filter(~F.col("norm").isin(*ATOMIC_EXCEPTIONS))
    if exceptions is not None:
        rows = rows.join(exceptions.select(T.normalize(F.col("term_normalized")).alias("norm")), "norm", "left_anti")
    return finding(rows, "L1-006", True, S.location(F.col("grp"), F.col("canonical")), F.col("canonical"), F.col("norm"), "rewrite", "canonical isn't atomic")


def versioned_aliases(terms: DataFrame) -> DataFrame:
    """[L1-007]"""
    rows = aliases(terms).filter(T.has_version(F.col("alias")))
    return finding(rows, "L1-007", False, S.location(F.col("grp"), F.col("canonical")), F.col("alias"), T.normalize(F.col("alias")), "remove_alias", "alias holds a version")


def hard_blocked(terms: DataFrame, pairs: DataFrame) -> DataFrame:
    """[L1-008, PD-05, IO-15] Aliases on the block list (canonical, alias); see ``merged_pairs`` for lists with repeated canonicals."""
    keyed = pairs.select(T.normalize(F.col("canonical")).alias("c"), T.normalize(F.col("alias")).alias("a"))
    rows = aliases(terms).join(keyed, (T.normalize(F.col("canonical")) == F.col("c")) & (T.normalize(F.col("alias")) == F.col("a")), "left_semi")
    return finding(rows, "L1-008", True, S.location(F.col("grp"), F.col("canonical")), F.col("alias"), T.normalize(F.col("alias")), "remove_alias", "pair is blocked")


def repeated_aliases(terms: DataFrame) -> DataFrame:
    """[L1-009, WN-01] Second and later occurrences of an alias within one canonical."""
    nth = F.row_number().over(Window.partitionBy("grp", "canonical", T.normalize(F.col("alias"))).orderBy("alias_pos"))
    rows = aliases(terms).withColumn("nth", nth).filter("nth > 1")
    return finding(rows, "L1-009", False, S.location(F.col("grp"), F.col("canonical")), F.col("alias"), T.normalize(F.col("alias")), "remove_alias", "alias is repeated")


def without_rewrite(terms: DataFrame) -> DataFrame:
    """[L1-010] Non-atomic canonicals for which no rewrite is safe."""
    rows = canonicals(terms).filter(T.rewrite_decision(F.col("canonical"))["action"] == "needs_exception")
    return finding(rows, "L1-010", False, S.location(F.col("grp"), F.col("canonical")), F.col("canonical"), T.normalize(F.col("canonical")), "needs_exception", "no deterministic rewrite")


def aliases_of_canonicals(terms: DataFrame) -> DataFrame:
    """Distinct aliases that equal a canonical of any group, their own left out."""
    names = canonicals(terms).select(T.normalize(F.col("canonical")).alias("norm")).distinct()
    keyed = aliases(terms).select("grp", "canonical", "alias", T.normalize(F.col("alias")).alias("norm")).distinct()
    return keyed.join(names, "norm", "left_semi").filter(F.col("norm") != T.normalize(F.col("canonical")))


def auto_dropped(terms: DataFrame) -> DataFrame:
    """[L1-011, JN-06]"""
    rows = aliases_of_canonicals(terms)
    return finding(rows, "L1-011", False, S.location(F.col("grp"), F.col("canonical")), F.col("alias"), F.col("norm"), "remove_alias", "alias equals another canonical")


def without_auto_dropped(terms: DataFrame) -> DataFrame:
    """[JN-06] The term table after aliases that equal any canonical have gone."""
    names = canonicals(terms).select(T.normalize(F.col("canonical")).alias("norm")).distinct()
    return terms.join(names, T.normalize(F.col("alias")) == F.col("norm"), "left_anti")


def self_groups(terms: DataFrame) -> DataFrame:
    """[L1-012] Canonicals that equal their own group."""
    rows = terms.select("grp", "canonical").distinct().filter(T.normalize(F.col("grp")) == T.normalize(F.col("canonical")))
    return finding(rows, "L1-012", False, S.location(F.col("grp"), F.col("canonical")), F.col("canonical"), T.normalize(F.col("canonical")), "remove_canonical", "canonical equals its group")


def suffix_overlaps(terms: DataFrame) -> DataFrame:
    """[JN-07, WN-05] (grp, canonical, alias, matched): the longest other canonical of the group that ends an alias at a word.

    The word suffixes of each alias are exploded, so the theta join is an equi-join.
    """
    a = aliases(terms).select("grp", "canonical", "alias", T.normalize(F.col("alias")).alias("norm")).distinct()
    words = F.split("norm", " ")
    tails = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))
    exploded = a.select("grp", "canonical", "alias", F.explode(tails).alias("tail"))
    other = canonicals(terms).select("grp", F.col("canonical").alias("matched"), T.normalize(F.col("canonical")).alias("tail"))
    hits = exploded.join(other, ["grp", "tail"]).filter(F.col("tail") != T.normalize(F.col("canonical")))
    first = F.row_number().over(Window.partitionBy("grp", "canonical", "alias").orderBy(F.desc(F.length("tail")), "matched"))
    return hits.withColumn("nth", first).filter("nth = 1").select("grp", "canonical", "alias", "matched")


def redundant_tokens(terms: DataFrame) -> DataFrame:
    """[JN-22, SM-07, FN-03] Every pair of names of a group of which one ends in the other, as a word or in parentheses."""
    names = canonicals(terms).select("grp", "canonical").unionByName(aliases(terms).select("grp", F.col("alias").alias("canonical"))).distinct()
    keyed = names.select("grp", "canonical", T.weak_normalize(F.col("canonical")).alias("norm"))
    words = F.split("norm", " ")
    tails = F.transform(F.sequence(F.lit(2), F.size(words)), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))
    inner = F.regexp_extract("norm", r"\(([^()]*)\)$", 1)
    several = F.when(F.size(words) > 1, F.concat(tails, F.array(inner))).otherwise(F.array(inner))
    long = keyed.select("grp", "canonical", F.explode(F.array_distinct(F.filter(several, lambda x: x != ""))).alias("norm"))
    return long.join(keyed.select("grp", "norm", F.col("canonical").alias("ends_in")), ["grp", "norm"]).select("grp", "canonical", "ends_in")


def all_findings(terms: DataFrame, pairs: DataFrame | None = None, exceptions: DataFrame | None = None) -> DataFrame:
    """[SO-02, ST-03] Union of the rules, each a lazy branch."""
    made = [duplicate_canonicals(terms), alias_collisions(terms), alias_multiplicity(terms), group_collisions(terms), non_atomic(terms, exceptions), versioned_aliases(terms), repeated_aliases(terms), without_rewrite(terms), auto_dropped(terms), self_groups(terms)]
    if pairs is not None:
        made.append(hard_blocked(terms, pairs))
    return reduce(DataFrame.unionByName, made)


def blank_names(terms: DataFrame) -> DataFrame:
    """[L1-001] Groups, canonicals and aliases of a term table that are no text or blank; an absent alias is none."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    known = lambda c: F.coalesce(c, F.lit(""))
    at = S.location(known("grp"), known("canonical"))
    row = lambda rows, where, reason: finding(rows, "L1-001", True, where, F.lit(""), F.lit(""), "fix_source", reason)
    names = terms.select("grp", "canonical").distinct()
    out = row(names.filter(blank("grp")), at, "group must not be blank").unionByName(row(names.filter(blank("canonical")), at, "canonical must not be blank"))
    listed = terms.filter("alias is not null").select("grp", "canonical", "alias").distinct().filter(blank("alias"))
    return out.unionByName(row(listed, F.concat(at, F.lit(".alias:"), F.col("alias")), "alias must be non-blank text"))


def rewritten_findings(terms: DataFrame) -> DataFrame:
    """[JN-05, T41] The checks on a rewritten store, as L1R-00x; the list of exceptions isn't applied."""
    none = canonicals(terms).filter(F.size(T.atomicity_reasons(F.col("canonical"))) > 0)
    atomic = finding(none, "L1-006", False, S.location(F.col("grp"), F.col("canonical")), F.col("canonical"), T.normalize(F.col("canonical")), "rewrite", "canonical isn't atomic")
    made = [blank_names(terms), duplicate_canonicals(terms), alias_collisions(terms), alias_multiplicity(terms), group_collisions(terms), atomic, repeated_aliases(terms)]
    return reduce(DataFrame.unionByName, made).withColumn("rule_id", F.regexp_replace("rule_id", "^L1-", "L1R-"))


def merged_pairs(old: DataFrame, new: DataFrame) -> DataFrame:
    """[SO-08, IO-15] Block lists (canonical, alias) merged: one alias for a canonical, the new list's before the old one's."""
    both = old.select("canonical", "alias", F.lit(0).alias("age")).unionByName(new.select("canonical", "alias", F.lit(1).alias("age")))
    both = both.filter("canonical <> '' and alias <> ''")
    return both.groupBy("canonical").agg(F.max_by("alias", F.struct("age", "alias")).alias("alias"))


def findings_summary(findings: DataFrame) -> DataFrame:
    """[AG-01, AG-02, FN-40] Counts by rule and in all (rule_id null), one pass with grouping sets."""
    return findings.rollup("rule_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("blocking").alias("errors"), F.count_if(~F.col("blocking")).alias("warnings"))


def findings_by(findings: DataFrame, examples: int = 3) -> DataFrame:
    """[AG-02, FN-40] (kind, value, n, examples): counts by rule, severity, action and reason, with the first few observed values."""
    kinds = {"rule": F.col("rule_id"), "severity": S.severity(F.col("blocking")), "action": F.col("proposed_action"), "reason": F.col("reason")}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()]))
    each = findings.select(pairs.alias("p"), "observed_value").groupBy("p.kind", "p.value", "observed_value").agg(F.count(F.lit(1)).alias("n"))
    total = each.groupBy("kind", "value").agg(F.sum("n").alias("n"))
    nth = F.row_number().over(Window.partitionBy("kind", "value").orderBy("observed_value"))
    shown = each.withColumn("nth", nth).filter(F.col("nth") <= examples).groupBy("kind", "value").agg(F.array_join(F.array_sort(F.collect_list("observed_value")), " | ").alias("examples"))
    return total.join(shown, ["kind", "value"])


def top_locations(findings: DataFrame, k: int = 10) -> DataFrame:
    """[AG-02, ST-08]"""
    return findings.groupBy("location").count().orderBy(F.desc("count"), "location").limit(k)


def removed_aliases(terms: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """[L1-007, L1-008, GV-07] Distinct (grp, canonical, alias) that the rewritten store leaves out: versions and blocked pairs."""
    rows = aliases(terms).select("grp", "canonical", "alias").distinct()
    out = rows.filter(T.has_version(F.col("alias")))
    if pairs is not None:
        keyed = pairs.select(T.normalize(F.col("canonical")).alias("c"), T.normalize(F.col("alias")).alias("a"))
        out = out.unionByName(rows.join(keyed, (T.normalize(F.col("canonical")) == F.col("c")) & (T.normalize(F.col("alias")) == F.col("a")), "left_semi"))
    return out.distinct()


def rewritten_terms(terms: DataFrame, pairs: DataFrame | None = None, exceptions: DataFrame | None = None) -> DataFrame:
    """[GV-05, GV-06, GV-07, SO-03, CJ-08, CJ-09, L1-007, L1-008] (grp, canonical, alias, alias_pos, source_canonical, action) after rewriting.

    Aliases that hold versions or are blocked go.  A canonical that is no exception becomes the parts of its decision;
    its aliases, and the content of parentheses, go to the first part, taken apart as far as is safe and without the
    canonical's own acronym; entries of a group that come out alike are merged, the first spelling of an alias stays.
    """
    from lexmill.functions.udfs import atomic_aliases_udf

    terms = terms.join(removed_aliases(terms, pairs).withColumn("removed", F.lit(True)), ["grp", "canonical", "alias"], "left")
    terms = terms.withColumn("alias", F.when(F.col("removed").isNull(), F.col("alias"))).drop("removed")
    decision = T.rewrite_decision(F.col("canonical"))
    excepted = T.normalize(F.col("canonical")).isin(*ATOMIC_EXCEPTIONS)
    base = terms.filter(T.normalize(F.col("grp")) != T.normalize(F.col("canonical")))
    if exceptions is not None:
        more = exceptions.select(T.normalize(F.col("term_normalized")).alias("more")).distinct()
        base = base.join(more, T.normalize(F.col("canonical")) == F.col("more"), "left")
        excepted = excepted | F.col("more").isNotNull()
    keep = F.struct(F.lit("keep").alias("action"), F.array("canonical").alias("parts"), F.lit(None).cast("string").alias("alias"))
    base = base.withColumn("d", F.when(excepted, keep).otherwise(decision)).drop("more")
    parts = F.when(F.col("d.action") == "needs_exception", F.array("canonical")).otherwise(F.col("d.parts"))
    names = base.select("grp", "canonical", "d").distinct().select("grp", F.col("canonical").alias("source_canonical"), F.col("d.action").alias("action"), F.posexplode(parts).alias("part", "canonical"), F.col("d.alias").alias("extra"))
    old = base.filter("alias is not null").select("grp", F.col("canonical").alias("source_canonical"), "alias", "alias_pos")
    first = names.filter("part = 0")
    kept = first.join(old, ["grp", "source_canonical"]).select("grp", "canonical", "alias", "alias_pos", "source_canonical", "action")
    added = first.filter("extra is not null").select("grp", "canonical", F.col("extra").alias("alias"), F.lit(1 << 30).alias("alias_pos"), "source_canonical", "action")
    every = kept.unionByName(added).withColumn("atoms", atomic_aliases_udf(F.col("alias"), F.col("canonical")))
    every = every.select("grp", "canonical", F.posexplode("atoms").alias("atom", "alias"), "alias_pos", "source_canonical", "action")
    every = every.filter(~T.equivalence_key(F.col("alias")).isin("") & (T.equivalence_key(F.col("alias")) != T.equivalence_key(F.col("canonical"))))
    nth = F.row_number().over(Window.partitionBy("grp", T.normalize(F.col("canonical")), T.equivalence_key(F.col("alias"))).orderBy("source_canonical", "alias_pos", "atom", "alias"))
    every = every.withColumn("nth", nth).filter("nth = 1").drop("nth", "atom")
    return names.select("grp", "canonical", "source_canonical", "action").join(every.select("grp", "canonical", "source_canonical", "alias", "alias_pos"), ["grp", "canonical", "source_canonical"], "left")


def duplicate_report(keywords: DataFrame, normal: bool) -> DataFrame:
    """[AG-06] One row total, unique_terms, surplus, duplicated of a column ``keyword``."""
    key = T.normalize(F.col("keyword")) if normal else F.col("keyword")
    return keywords.groupBy(key.alias("k")).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("unique_terms"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("surplus"), F.count_if(F.col("count") > 1).alias("duplicated"))


def resolved_duplicates(terms: DataFrame) -> DataFrame:
    """[SO-07, WN-03] Of canonicals that are alike the one with most aliases stays (ties: group, name); repeated alias terms all go."""
    listed = aliases(terms).withColumn("norm", T.normalize(F.col("alias")))
    again = listed.groupBy("norm").count().filter("count > 1").select("norm")
    clean = listed.join(again, "norm", "left_anti")
    sizes = terms.groupBy("grp", "canonical").agg(F.count("alias").alias("n"))
    order = Window.partitionBy(T.normalize(F.col("canonical"))).orderBy(F.desc("n"), F.lower("grp"), F.lower("canonical"))
    kept = sizes.withColumn("nth", F.row_number().over(order)).filter("nth = 1").select("grp", "canonical")
    return kept.join(clean.select("grp", "canonical", "alias"), ["grp", "canonical"], "left")


def reverse_index(terms: DataFrame) -> DataFrame:
    """[CJ-04] term -> sorted places (group, canonical, kind)."""
    rows = canonicals(terms).select(T.normalize(F.col("canonical")).alias("term"), "grp", "canonical", F.lit("canonical").alias("kind"))
    rows = rows.unionByName(aliases(terms).select(T.normalize(F.col("alias")).alias("term"), "grp", "canonical", F.lit("alias").alias("kind")))
    return rows.groupBy("term").agg(F.array_sort(F.collect_set(F.struct("grp", "canonical", "kind"))).alias("places"))


def alias_map(terms: DataFrame) -> DataFrame:
    """[CJ-03] key -> canonical in lower case; of several the last in store order."""
    pos = F.struct("grp_pos", "canonical_pos", F.coalesce("alias_pos", F.lit(-1)).alias("alias_pos"))
    own = terms.select(F.lower("canonical").alias("key"), F.lower("canonical").alias("canonical"), F.struct("grp_pos", "canonical_pos", F.lit(-1).alias("alias_pos")).alias("pos"))
    other = terms.filter("alias is not null").select(F.lower("alias").alias("key"), F.lower("canonical").alias("canonical"), pos.alias("pos"))
    return own.unionByName(other).groupBy("key").agg(F.max_by("canonical", "pos").alias("canonical"), F.min("pos").alias("pos"))
