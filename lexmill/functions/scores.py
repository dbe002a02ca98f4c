"""Numeric, conditional and enumeration functions as Column -> Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Enumerations of decisions and classifications.
NATURES = ("Software Artifact", "Concept", "Algorithm", "Standard / Specification", "Protocol", "Human Skill")
LEVELS = ("Concrete", "Domain", "Method")
CONFIDENCES = ("HIGH", "MEDIUM", "LOW")
ACTIONS = ("MERGE_AS_ALIAS", "KEEP_DISTINCT", "MARK_AS_CONTEXTUAL", "SPLIT_INTO_MULTIPLE_CANONICALS", "REMOVE_CANONICAL")


def z_score(value: Column, center: Column, spread: Column) -> Column:
    """[FN-22] Null where the spread is 0 or null."""
    return F.try_divide(value - center, F.nullif(spread, F.lit(0.0)))


def suspicion(global_z: Column, group_z: Column, alpha: float = 0.4, beta: float = 0.6) -> Column:
    """[FN-23]"""
    return F.coalesce(alpha * F.abs(global_z) + beta * F.abs(group_z), F.abs(global_z))


def verdict(global_z: Column, group_z: Column, threshold: float = 2.0) -> Column:
    """[FN-24]"""
    far, near = F.abs(global_z) >= threshold, F.abs(group_z) >= threshold
    return (
        F.when(group_z.isNull() & far, "suspect_global_only")
        .when(group_z.isNull(), "normal")
        .when(far & near, "likely_false_positive")
        .when(far, "legitimate_hub")
        .when(near, "group_anomaly")
        .otherwise("normal")
    )


def dashboard_class(local_z: Column, group_z: Column, threshold: float = 2.0) -> Column:
    """[PD-15]"""
    return F.when(local_z >= threshold + 1, "false_positive").when((local_z >= threshold) | (F.coalesce(group_z, F.lit(0.0)) >= 2.5), "investigate").otherwise("legitimate")


def gaussian(x: Column, mean: Column, deviation: Column) -> Column:
    """[FN-25]"""
    return F.exp(-0.5 * F.pow((x - mean) / deviation, 2)) / (deviation * F.sqrt(2 * F.pi()))


def band(score: Column, high: float = 0.93) -> Column:
    """[FN-26] On the unrounded score."""
    return F.when(score > high, "high_collision").otherwise("possible_conflict")


def confidence(value: Column) -> Column:
    """[FN-27] HIGH, MEDIUM or LOW from text that holds one of them, or from a number; MEDIUM for anything else."""
    text, number = F.upper(F.trim(value)), F.try_to_number(F.trim(value), F.lit("99999.999999")).cast("double")
    named = F.when(text.contains("HIGH"), "HIGH").when(text.contains("MEDIUM"), "MEDIUM").when(text.contains("LOW"), "LOW")
    return F.coalesce(named, F.when(number >= 0.8, "HIGH").when(number >= 0.5, "MEDIUM").when(number.isNotNull(), "LOW"), F.lit("MEDIUM"))


def status(value: Column, level: Column) -> Column:
    """[FN-28] active or under_review as given, else by the confidence."""
    text = F.lower(F.trim(value))
    return F.when(text.isin("active", "under_review"), text).when(level == "LOW", "under_review").otherwise("active")


def boolean(value: Column, default: bool = False) -> Column:
    """[FN-29] From yes/no words and numbers given as text."""
    text = F.lower(F.trim(value))
    return F.when(text.isin("true", "yes", "1", "y"), True).when(text.isin("false", "no", "0", "n"), False).otherwise(default)


def folded_value(payload: Column, *keys: str) -> Column:
    """[FN-30] The value under the first of ``keys`` that a string map has, whatever the case of its keys."""
    entries = F.map_entries(payload)
    return F.coalesce(*[F.get(F.filter(entries, lambda e: F.lower(F.trim(e["key"])) == k), 0)["value"] for k in keys])


def severity(blocking: Column) -> Column:
    """[FN-40]"""
    return F.when(blocking, "error").otherwise("warning")


def safe_int(value: Column) -> Column:
    """[FN-41] 0 where text is no integer."""
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def health(value: Column, good: float, fair: float, rising: bool) -> Column:
    """[FN-42] good, warning or critical; ``rising`` if larger is better."""
    if rising:
        return F.when(value >= good, "good").when(value >= fair, "warning").otherwise("critical")
    return F.when(value <= good, "good").when(value <= fair, "warning").otherwise("critical")


def location(group: Column, canonical: Column) -> Column:
    """[FN-43]"""
    return F.concat(F.lit("group:"), group, F.lit(".canonical:"), canonical)


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    """Whether ``text`` contains any of ``words``."""
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words))
