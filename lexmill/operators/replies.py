"""Model replies as text: well-formed parts become rows, the others findings, all through VARIANT built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.functions import text as T
from lexmill.operators import governance
from lexmill.operators.rules import finding

DECISION = ("term", "action", "target_canonical", "confidence")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _text(v: str, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def decisions(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """[L3-001, IO-13, UD-01] (decisions, findings) of replies (cluster_id, reply).

    A reply must be an object whose ``decisions`` is a list of objects; each breach is a blocking finding, and the rest
    of the reply still counts.
    """
    rows = replies.select("cluster_id", "reply", F.try_parse_json("reply").alias("v"))
    listed = F.try_variant_get("v", "$.decisions", "variant")
    good = F.coalesce(_kind(F.col("v")).startswith("OBJECT") & _kind(listed).startswith("ARRAY"), F.lit(False))
    at = F.concat(F.lit("cluster:"), "cluster_id")
    broken = finding(rows.filter(~good), "L3-001", True, at, F.substring(F.coalesce("reply", F.lit("")), 1, 240), F.lit(""), "manual_review", "reply isn't an object with a list of decisions")
    each = rows.filter(good).select("cluster_id", F.explode(F.try_variant_get("v", "$.decisions", "array<variant>")).alias("d"))
    is_object = F.coalesce(_kind(F.col("d")).startswith("OBJECT"), F.lit(False))
    odd = finding(each.filter(~is_object), "L3-001", True, F.concat(at, F.lit("|term:<invalid_row>")), F.to_json("d"), F.lit(""), "manual_review", "decision isn't an object")
    reason = lambda name: _text("d", f"$.reasoning.{name}").alias(name)
    made = each.filter(is_object).select("cluster_id", *[_text("d", f"$.{c}").alias(c) for c in DECISION], F.try_variant_get("d", "$.split_candidates", "array<string>").alias("split_candidates"), reason("ecosystem"), reason("abstraction_level"), reason("graph_safety"))
    return made, broken.unionByName(odd)


def classes(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """[L4-001..L4-005] (raw classes for ``governance.normalised_classes``, findings) of replies (term, reply).

    Values may stand at the top or under ``classification``.  COMPOSITE_STACK and CATEGORY are no classes but findings;
    neither is a reply that breaks the schema: functional roles that are no list, flags that are no booleans, or a
    nature, level or confidence given as anything but text or a number.
    """
    rows = replies.select("term", "reply", F.try_parse_json("reply").alias("v"))
    good = F.coalesce(_kind(F.col("v")).startswith("OBJECT"), F.lit(False))
    at, norm = F.concat(F.lit("term:"), "term"), T.normalize(F.col("term"))
    broken = finding(rows.filter(~good), "L4-001", True, at, F.substring(F.coalesce("reply", F.lit("")), 1, 240), norm, "manual_review", "reply isn't an object")
    pick = lambda name: F.coalesce(_text("v", f"$.classification.{name}"), _text("v", f"$.{name}")).alias(name)
    texts = lambda path: F.transform(F.filter(F.try_variant_get("v", path, "array<variant>"), lambda r: _kind(r) == "STRING"), lambda r: F.try_variant_get(r, "$", "string"))
    one = lambda path: F.when(_kind(F.try_variant_get("v", path, "variant")) == "STRING", F.array(_text("v", path)))
    roles = F.coalesce(*[x for path in ("$.classification.functional_roles", "$.functional_roles") for x in (texts(path), one(path))]).alias("functional_roles")
    raw = rows.filter(good).select("term", _text("v", "$.type").alias("type"), pick("ontological_nature"), pick("primary_type"), pick("abstraction_level"), pick("confidence"), pick("status"), roles, *map(pick, governance.FLAGS))
    kind = F.upper(F.replace(F.trim(F.coalesce("type", "ontological_nature", "primary_type", F.lit(""))), F.lit(" "), F.lit("_")))
    special = kind.isin("COMPOSITE_STACK", "CATEGORY")
    composite = finding(raw.filter(kind == "COMPOSITE_STACK"), "L4-004", False, at, F.col("term"), norm, "split", "term names several technologies")
    category = finding(raw.filter(kind == "CATEGORY"), "L4-005", False, at, F.col("term"), norm, "move_to_groups", "term names a category")
    kind_of = lambda name: F.coalesce(_kind(F.try_variant_get("v", f"$.classification.{name}", "variant")), _kind(F.try_variant_get("v", f"$.{name}", "variant")))
    plain = lambda name: F.coalesce(~kind_of(name).rlike("^(OBJECT|ARRAY)"), F.lit(True))
    sound = plain("ontological_nature") & plain("abstraction_level") & plain("confidence")
    sound = sound & F.coalesce(kind_of("functional_roles").rlike("^(ARRAY|VOID|STRING)"), F.lit(True))
    for flag in ("is_contextual", "is_versioned", "is_marketing_language"):
        sound = sound & F.coalesce(kind_of(flag).rlike("^(BOOLEAN|VOID|STRING|BIGINT|DECIMAL|DOUBLE)"), F.lit(True))
    shaped = rows.filter(good).select("term", "reply", sound.alias("sound"))
    odd = finding(shaped.filter(~F.col("sound")), "L4-002", True, at, F.substring("reply", 1, 240), norm, "manual_review", "classification breaks the schema")
    kept = raw.filter(~special).drop("type").join(shaped.filter("sound").select("term").distinct(), "term", "left_semi")
    low = finding(kept.filter(S.confidence(F.col("confidence")) == "LOW"), "L4-003", False, at, F.col("term"), norm, "manual_review", "classification of low confidence")
    return kept, broken.unionByName(odd).unionByName(composite).unionByName(category).unionByName(low)
