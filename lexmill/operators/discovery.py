"""Candidates from records, the incremental discovery queue, its audit, review and application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import matching
from lexmill.operators.components import cut
from lexmill.operators.ranges import numbered_in_order


def candidates(records: DataFrame) -> DataFrame:
    """[WN-02, JN-20, FN-14, FN-16] (file, line_number, pos, name, tag, source, day): one row for each name of a record.

    Unmapped skills come first, then technical ones; the first spelling of a name counts.  Its tag is the first
    technical tag of that name, else the first tag met.
    """
    live = records.filter(~F.col("parse_error") & ~F.col("is_error"))
    empty = F.array().cast("array<string>")
    n = F.size(F.coalesce("unmapped_skills", empty))
    raw = F.concat(F.coalesce("unmapped_skills", empty), F.coalesce("technical_skills", empty))
    rows = live.select("file", "line_number", "source_url", "scraped_at", n.alias("n"), F.posexplode(raw).alias("pos", "raw"))
    rows = rows.withColumn("s", T.skill_and_tag(F.col("raw"))).select("file", "line_number", "pos", (F.col("pos") >= F.col("n")).alias("technical"), F.col("s.name").alias("name"), F.col("s.tag").alias("tag"), F.col("source_url").alias("source"), T.date_prefix(F.col("scraped_at")).alias("day")).filter("name <> ''")
    hint = F.min_by("tag", F.when(F.col("technical") & F.col("tag").isNotNull(), F.col("pos")))
    any_tag = F.min_by("tag", F.when(F.col("tag").isNotNull(), F.col("pos")))
    first = F.min(F.struct("pos", "name", "source", "day")).alias("first")
    out = rows.groupBy("file", "line_number", F.lower("name").alias("low")).agg(first, F.coalesce(hint, any_tag).alias("tag"))
    return out.select("file", "line_number", "first.pos", "first.name", "tag", "first.source", "first.day")


def queue_delta(mentions: DataFrame, fallback_day: str = "1970-01-01", most_sources: int = 10) -> DataFrame:
    """[AG-03, FN-15] One row for each key of mentions (name, tag, source, day, ord): counts, days, tag counts, sources in order.

    Tags are counted in a first group-by, so a hot key is pre-aggregated before its rows meet.  Of the sources the first
    ``2 * most_sources`` are kept, of which a merge with a queue that has ``most_sources`` still finds as many new ones.
    """
    keyed = mentions.select(T.queue_key(F.col("name")).alias("key"), "name", "tag", "source", F.coalesce("day", F.lit(fallback_day)).alias("day"), "ord")
    base = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("seen_count"), F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.min_by("name", "ord").alias("display_name"))
    tags = keyed.filter("tag is not null and tag <> ''").groupBy("key", "tag").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("tag", "n"))).alias("tags"))
    srcs = keyed.filter("source is not null and source <> ''").groupBy("key", "source").agg(F.min("ord").alias("o"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("o", "source"))
    srcs = srcs.withColumn("nth", nth).filter(F.col("nth") <= 2 * most_sources).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("o", "source"))).alias("s"))
    none_t = F.array().cast("array<struct<tag:string,n:bigint>>")
    out = base.join(tags, "key", "left").join(srcs, "key", "left")
    return out.select("key", "display_name", "seen_count", "first_seen", "last_seen", F.coalesce("tags", none_t).alias("tags"), F.coalesce(F.transform("s", lambda x: x["source"]), F.array().cast("array<string>")).alias("sources"))


def queue_status(status: Column, seen: Column, threshold: int) -> Column:
    """[SS-02] pending becomes ready at the threshold and never goes back."""
    return F.when((status == "pending") & (seen >= threshold), "ready_for_promotion").otherwise(status)


def new_queue(delta: DataFrame, threshold: int = 5, most_sources: int = 10) -> DataFrame:
    out = delta.withColumn("sources", F.slice("sources", 1, most_sources))
    return out.withColumn("status", queue_status(F.lit("pending"), F.col("seen_count"), threshold))


def merge_queue(state: DataFrame, delta: DataFrame, threshold: int = 5, most_sources: int = 10) -> DataFrame:
    """[SS-01] State and delta joined in full: counts and tags add up, days widen, sources append up to the cap."""
    s, d = state.alias("s"), delta.alias("d")
    both = s.join(d, F.col("s.key") == F.col("d.key"), "full_outer")
    zero = F.lit(0).cast("bigint")
    seen = F.coalesce("s.seen_count", zero) + F.coalesce("d.seen_count", zero)
    none_t, none_s = F.array().cast("array<struct<tag:string,n:bigint>>"), F.array().cast("array<string>")
    tags = F.concat(F.coalesce("s.tags", none_t), F.coalesce("d.tags", none_t))
    names = F.array_sort(F.array_distinct(F.transform(tags, lambda t: t["tag"])))
    total = F.transform(names, lambda t: F.struct(t.alias("tag"), F.aggregate(F.filter(tags, lambda x: x["tag"] == t), zero, lambda a, x: a + x["n"]).alias("n")))
    old = F.coalesce("s.sources", none_s)
    fresh = F.array_except(F.coalesce("d.sources", none_s), old)
    sources = F.concat(old, F.slice(fresh, F.lit(1), F.greatest(F.lit(most_sources) - F.size(old), F.lit(0))))
    return both.select(
        F.coalesce("s.key", "d.key").alias("key"),
        F.coalesce("s.display_name", "d.display_name").alias("display_name"),
        seen.alias("seen_count"),
        F.least("s.first_seen", "d.first_seen").alias("first_seen"),
        F.greatest("s.last_seen", "d.last_seen").alias("last_seen"),
        total.alias("tags"),
        sources.alias("sources"),
        queue_status(F.coalesce("s.status", F.lit("pending")), seen, threshold).alias("status"),
    )


def status_counts(queue: DataFrame) -> DataFrame:
    """[AG-04, PD-09]"""
    return queue.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def best_tag(tags: Column) -> Column:
    """[AG-15] Tag of the largest count; ties go to the first in the array."""
    ranked = F.transform(tags, lambda t, i: F.struct(t["n"].alias("n"), (-i).alias("neg"), t["tag"].alias("tag")))
    return F.when(F.size(tags) > 0, F.array_max(ranked)["tag"])


def top_tags(tags: Column, k: int = 3) -> Column:
    """[AG-16]"""
    ranked = F.array_sort(F.transform(tags, lambda t: F.struct((-t["n"]).alias("neg"), t["tag"].alias("tag"))))
    return F.transform(F.slice(ranked, 1, k), lambda x: x["tag"])


def audit(occurrences: DataFrame, terms: DataFrame | None = None, fuzzy_threshold: float = 0.85, titles: int = 3) -> DataFrame:
    """[AG-05, ST-07, IO-05] One row for each name of (name, file, line_number, pos, title), most occurrences first.

    skill, occurrence_count, display_name (the first spelling), canonical, match_type and confidence of its match in
    ``terms`` (null without one), the first ``titles`` different titles in order of occurrence, and all files in order of
    name.  ``occurrence_rows`` has every occurrence.
    """
    at = F.struct("file", "line_number", "pos")
    keyed = occurrences.withColumn("skill", F.lower("name"))
    rows = keyed.groupBy("skill").agg(F.count(F.lit(1)).alias("occurrence_count"), F.min_by("name", at).alias("display_name"))
    files = keyed.filter("file is not null").select("skill", "file").distinct().groupBy("skill").agg(F.array_sort(F.collect_list("file")).alias("files"))  # names of files, each once
    first = keyed.filter("title is not null and title <> ''").groupBy("skill", "title").agg(F.min(at).alias("at"))
    nth = F.row_number().over(Window.partitionBy("skill").orderBy("at", "title"))  # Spark takes the first ones before it shuffles
    first = first.withColumn("nth", nth).filter(F.col("nth") <= titles).groupBy("skill").agg(F.array_sort(F.collect_list(F.struct("nth", "title"))).alias("t"))
    out = rows.join(files, "skill", "left").join(first, "skill", "left")
    if terms is None:
        out = out.withColumns({"canonical": F.lit(None).cast("string"), "match_type": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    else:
        out, _ = cut(out, "audited")
        found = matching.match(out.select(F.col("display_name").alias("name")), terms, fuzzy_threshold)
        out = out.join(found.withColumnRenamed("name", "display_name"), "display_name", "left")
    none = F.array().cast("array<string>")
    out = out.withColumns({"files": F.coalesce("files", none), "titles": F.coalesce(F.transform("t", lambda x: x["title"]), none)}).withColumn("n_files", F.size("files"))
    return out.select("skill", "occurrence_count", "display_name", "canonical", "match_type", "confidence", "titles", "n_files", "files").orderBy(F.desc("occurrence_count"), "skill")


def audit_totals(audited: DataFrame, records: DataFrame) -> DataFrame:
    """[AG-05] One row: records read and skipped, different names, and how many of them match a term."""
    read = records.agg(F.count_if(~F.col("parse_error") & ~F.col("is_error")).alias("total_records_scanned"), F.count_if(~F.col("parse_error") & F.col("is_error")).alias("skipped_error_records"))
    names = audited.agg(F.count(F.lit(1)).alias("total_unique_skills"), F.count("canonical").alias("taxonomy_matched"), F.count_if(F.col("canonical").isNull()).alias("novel"))
    return read.crossJoin(names)  # one row each


def occurrence_rows(occurrences: DataFrame) -> DataFrame:
    """[AG-05] Every occurrence with its skill and its number within it, in order of file, line and place.

    Ranks are over ranges of that order, so that the occurrences of a frequent name take many tasks.
    """
    kept = [c for c in occurrences.columns if c not in ("skill", "nth")]
    rows = numbered_in_order(occurrences.select(F.lower("name").alias("skill"), *kept), ["skill", "file", "line_number", "pos"], "number")
    rows, _ = cut(rows, "numbered")
    first = rows.groupBy(F.col("skill").alias("__of")).agg(F.min("number").alias("__first"))
    joined = rows.join(first, F.col("skill").eqNullSafe(F.col("__of")))
    return joined.select("skill", (F.col("number") - F.col("__first") + 1).cast("int").alias("nth"), *kept)


def review(queue: DataFrame, aliases: DataFrame, groups: DataFrame, assignments: DataFrame | None = None, semantic: DataFrame | None = None) -> DataFrame:
    """[JN-14, GV-10, PD-09] Ready entries with their default action.

    ``aliases`` (key, canonical), ``groups`` (name), ``assignments`` (skill, llm_group), ``semantic`` (skill, alias_of).
    A known alias comes before a semantic one, that before a rejected group, that before a group name.
    """
    spark = queue.sparkSession
    assignments = assignments if assignments is not None else spark.createDataFrame([], "skill string, llm_group string")
    semantic = semantic if semantic is not None else spark.createDataFrame([], "skill string, alias_of string")
    rows = queue.filter("status = 'ready_for_promotion'").withColumn("low", F.lower("display_name"))
    rows = rows.join(aliases.select(F.lower("key").alias("low"), F.col("canonical").alias("known")), "low", "left")
    rows = rows.join(semantic.select(F.lower("skill").alias("low"), "alias_of"), "low", "left")
    rows = rows.join(assignments.select(F.lower("skill").alias("low"), "llm_group"), "low", "left")
    rows = rows.join(groups.select(F.lower("name").alias("low"), F.lit(True).alias("is_group")).distinct(), "low", "left")
    action = (
        F.when(F.col("known").isNotNull(), F.concat(F.lit("alias_of:"), "known"))
        .when(F.col("alias_of").isNotNull(), F.concat(F.lit("alias_of:"), "alias_of"))
        .when(F.col("llm_group").startswith("REJECT:") | F.col("is_group"), "reject")
        .otherwise("approve")
    )
    return rows.select("key", "display_name", "seen_count", F.coalesce(best_tag(F.col("tags")), F.lit("")).alias("suggested_group"), F.slice("sources", 1, 5).alias("sources"), action.alias("action"))


def applied(reviewed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """[GV-11, AG-17, JN-15] (approved canonicals, aliases to add, counters); an alias equal to its target adds nothing."""
    target = F.regexp_extract("action", r"^alias_of:(.*)$", 1)
    approved = reviewed.filter("action = 'approve'").select(F.col("suggested_group").alias("grp"), F.col("display_name").alias("canonical"))
    alias = reviewed.filter(F.col("action").startswith("alias_of:")).select(target.alias("canonical"), F.col("display_name").alias("alias"))
    counters = reviewed.agg(F.count_if(F.col("action") == "approve").alias("approved"), F.count_if(F.col("action").startswith("alias_of:")).alias("aliased"), F.count_if(F.col("action") == "reject").alias("rejected"), F.count_if(~F.col("action").isin("approve", "reject") & ~F.col("action").startswith("alias_of:")).alias("skipped"))
    return approved, alias.filter(F.lower("alias") != F.lower("canonical")), counters


def consolidated_groups(rows: DataFrame) -> DataFrame:
    """[AG-24] (suggested_group, skills): NEW: groups by name without regard to case, first spelling kept; rows (pos, skill, assigned)."""
    new = rows.filter(F.upper("assigned").startswith("NEW:")).select("pos", "skill", F.trim(F.substring("assigned", 5, 1 << 20)).alias("name"))
    return new.groupBy(F.lower("name").alias("k")).agg(F.min_by("name", "pos").alias("suggested_group"), F.array_join(F.array_sort(F.collect_list("skill")), ", ").alias("skills")).drop("k")


def assignment_section(assigned: Column, known: Column) -> Column:
    """[GV-12]"""
    return F.when(assigned.isNull() | (F.trim(assigned) == ""), "failed").when(F.upper(assigned).startswith("REJECT"), "rejected").when(F.upper(assigned).startswith("NEW:"), "new").when(known, "existing").otherwise("new")


def group_context(terms: DataFrame, shown: int = 6) -> DataFrame:
    """[CJ-07] (grp, context): the first ``shown`` canonicals of a group and how many it has."""
    names = terms.groupBy("grp", "canonical").agg(F.min("canonical_pos").alias("pos"))
    total = names.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy("grp").orderBy("pos", "canonical"))
    first = names.withColumn("nth", nth).filter(F.col("nth") <= shown).groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("nth", "canonical"))).alias("f"))
    text = F.concat(F.array_join(F.transform("f", lambda x: x["canonical"]), ", "), F.when(F.col("n") > shown, F.concat(F.lit(", ..."))).otherwise(""), F.lit(" ("), F.col("n").cast("string"), F.lit(" total)"))
    return total.join(first, "grp").select("grp", text.alias("context"))


def batches(skills: DataFrame, size: int = 20) -> DataFrame:
    """[UD-06] (batch, place, skill): distinct skills dealt in order into batches of ``size`` for one prompt each."""
    names = skills.select("skill").filter("skill is not null").distinct().withColumn("low", F.lower("skill"))
    k = numbered_in_order(names, ["low", "skill"]).withColumn("k", F.col("number") - 1)
    return k.select(F.floor(F.col("k") / size).cast("string").alias("batch"), (F.col("k") % size).alias("place"), "skill")


def matched_replies(batch: DataFrame, replies: DataFrame) -> DataFrame:
    """[JN-18] Reply rows joined back to the skills that were asked, without regard to case; skills without one have nulls.

    Of several replies for a skill the first (``pos``) counts.
    """
    keyed = replies.withColumn("k", F.lower(F.trim("skill")))
    nth = F.row_number().over(Window.partitionBy("k").orderBy("pos"))
    first = keyed.withColumn("nth", nth).filter("nth = 1").drop("nth", "skill", "pos")
    return batch.withColumn("k", F.lower(F.trim("skill"))).join(first, "k", "left").drop("k")


def live_state(state: DataFrame, input_hash: str) -> DataFrame:
    """[SS-07] Rows of an audit's checkpoint that belong to this input; a stale state counts for nothing."""
    return state.filter(F.col("input_hash") == input_hash)


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """[JN-16, JN-17, SS-03..SS-05] What a resumed run has still to do."""
    return todo.join(done.select(key).distinct(), key, "left_anti")
