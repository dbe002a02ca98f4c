
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results must equal.
CONTEXT_PREFIXES = ("core ", "advanced ", "basic ", "modern ", "enterprise ", "backend ", "frontend ")
VERSION_PATTERN = r"(?i)\b(v\d+|\d+\.\d+|\d{4}|\d+\s*bit|es\d+|python\s*\d+)\b"
AND_PATTERN = r"(?i)\band\b"
PARENS = r"\(([^)]+)\)"
SPLIT_BLOCKERS = ("slash", "comma", "and", "parentheses")


def trimmed(c: Column) -> Column:
    """Without white space at either end (all Unicode white space, not blanks alone)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize(c: Column) -> Column:
    """[FN-01, FN-02] Lower case, trimmed, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def weak_normalize(c: Column) -> Column:
    """[FN-03] Lower case and trimmed; inner white space stays."""
    return trimmed(F.lower(c))


def equivalence_key(c: Column) -> Column:
    """[FN-04] Normalised, with hyphens and underscores as blanks."""
    return normalize(F.translate(c, "-_", "  "))


def strip_punctuation(c: Column) -> Column:
    """[FN-05] Lower case letters, digits, #, + and . with single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9\s#+.]", ""), r"\s+", " "))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """[FN-06] The set of character n-grams of a normalised term, blanks as underscores; a shorter term is its own gram."""
    key = F.replace(c, F.lit(" "), F.lit("_"))
    grams = F.transform(F.sequence(F.lit(1), F.length(key) - (n - 1)), lambda i: F.substring(key, i, F.lit(n)))
    return F.when(F.length(key) < n, F.filter(F.array(key), lambda x: x != "")).otherwise(F.array_distinct(grams))


def parenthetical_split(c: Column) -> Column:
    """[FN-07] struct(base, alias): text without any (...) and the first content; null if either is empty."""
    base = trimmed(F.regexp_replace(c, PARENS, ""))
    alias = trimmed(F.regexp_extract(c, PARENS, 1))
    return F.when(c.rlike(PARENS) & (base != "") & (alias != ""), F.struct(base.alias("base"), alias.alias("alias")))


def explicit_tokens(c: Column) -> Column:
    """[FN-08] The set of normalised parts between / , + & and the word "and", parentheses as blanks."""
    parts = F.split(F.translate(normalize(c), "()", "  "), r"[/,+&]|\band\b")
    return F.array_distinct(F.filter(F.transform(parts, normalize), lambda x: x != ""))


def split_on(c: Column, pattern: str) -> Column:
    """[FN-09] Trimmed non-empty parts."""
    return F.filter(F.transform(F.split(c, pattern), trimmed), lambda x: x != "")


def acronym(c: Column) -> Column:
    """[FN-10] First letters of the alphanumeric words, lower case."""
    return F.lower(F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"([a-zA-Z0-9]+)"), F.lit(1)), lambda w: F.substring(w, 1, 1)), ""))


def is_acronym_like(c: Column) -> Column:
    """[FN-11] 2 to 12 letters and digits, at least two letters, all letters upper case."""
    t = trimmed(c)
    letters = F.regexp_replace(t, r"[^\p{L}]", "")
    return F.length(t).between(2, 12) & t.rlike(r"^[\p{L}\p{Nd}]+$") & (F.length(letters) >= 2) & ~letters.rlike(r"[^\p{Lu}]")


def skill_and_tag(c: Column) -> Column:
    """[FN-14] struct(name, tag): a trailing [Group_Name] is the tag, underscores as blanks; else tag is null."""
    pattern = r"(?s)^(.*?)\s*\[([^\]]+)\]\s*$"
    has = c.contains("[") & c.rlike(pattern)  # most names have no bracket, which is quicker to see
    tag = trimmed(F.replace(F.regexp_extract(c, pattern, 2), F.lit("_"), F.lit(" ")))
    return F.struct(trimmed(F.when(has, F.regexp_extract(c, pattern, 1)).otherwise(c)).alias("name"), F.when(has, tag).alias("tag"))


def queue_key(c: Column) -> Column:
    """[FN-15]"""
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def date_prefix(c: Column) -> Column:
    """[FN-16] First ten characters, null for shorter text."""
    return F.when(F.length(c) >= 10, F.substring(c, 1, 10))


def truncated(c: Column, limit: int = 240) -> Column:
    """[FN-17] At most ``limit`` characters, the last three dots where text was cut."""
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, limit - 3), F.lit("...")))


def status_slug(c: Column) -> Column:
    """[FN-18] Runs outside [a-z0-9_] as one underscore, none at the ends; "unknown" if nothing is left."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(trimmed(c)), r"[^a-z0-9_]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("unknown"))


def text_hash(c: Column) -> Column:
    """[FN-19]"""
    return F.md5(c)


def has_version(c: Column) -> Column:
    """[PD-02]"""
    return normalize(c).rlike(VERSION_PATTERN)


def has_context_prefix(c: Column) -> Column:
    """[PD-03]"""
    n = normalize(c)
    out = F.lit(False)
    for p in CONTEXT_PREFIXES:
        out = out | n.startswith(p)
    return out


def atomicity_reasons(c: Column) -> Column:
    """[PD-01] Reason codes in fixed order; an empty array for an atomic term."""
    tests = (
        ("slash", c.contains("/")),
        ("comma", c.contains(",")),
        ("parentheses", c.contains("(") | c.contains(")")),
        ("and", normalize(c).rlike(AND_PATTERN)),
        ("contextual_prefix", has_context_prefix(c)),
        ("version_like", has_version(c)),
    )
    return F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in tests]), lambda x: x.isNotNull())


def is_safe_split(parts: Column) -> Column:
    """[PD-04] At least two parts of two characters or more, no two equal when normalised, none to be split further."""
    plain = lambda p: ~F.arrays_overlap(atomicity_reasons(p), F.array(*map(F.lit, SPLIT_BLOCKERS)))
    return (F.size(parts) >= 2) & F.forall(parts, lambda p: (F.length(p) >= 2) & plain(p)) & (F.size(F.array_distinct(F.transform(parts, normalize))) == F.size(parts))


def rewrite_decision(c: Column) -> Column:
    """[GV-04] struct(action, parts, alias): parentheses before slash, "and" and comma; needs_exception where none is safe."""
    paren, reasons = parenthetical_split(c), atomicity_reasons(c)
    none = F.lit(None).cast("string")
    out = F.when(F.array_contains(reasons, "parentheses") & paren.isNotNull(), _decision("remove_parentheses", F.array(paren["base"]), paren["alias"]))
    for reason, action, pattern in (("slash", "split_on_slash", "/"), ("and", "split_on_and", AND_PATTERN), ("comma", "split_on_comma", ",")):
        parts = split_on(c, pattern)
        out = out.when(F.array_contains(reasons, reason) & is_safe_split(parts), _decision(action, parts, none))
    return out.when(F.size(reasons) > 0, _decision("needs_exception", F.array().cast("array<string>"), none)).otherwise(_decision("keep", F.array(c), none))


def _decision(action: str, parts: Column, alias: Column) -> Column:
    return F.struct(F.lit(action).alias("action"), parts.alias("parts"), alias.alias("alias"))
