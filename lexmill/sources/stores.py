"""Reading, flattening and writing of taxonomy stores, record lines and reports."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators.components import cut

STORE = "map<string,map<string,array<string>>>"


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """[IO-01, IO-02, CJ-01] Long term table of a nested JSON store, with places; malformed groups and aliases are left out.

    Columns grp, grp_pos, canonical, canonical_pos, alias, alias_pos (the last two null for a canonical without aliases).
    """
    return flatten_store(spark.read.text(path, wholetext=True).select("value"))


def flatten_store(documents: DataFrame, column: str = "value") -> DataFrame:
    raw = F.from_json(F.col(column), F.lit("map<string,string>"))
    groups = documents.select(F.posexplode(F.map_entries(raw)).alias("grp_pos", "g")).select("grp_pos", F.col("g.key").alias("grp"), F.from_json("g.value", F.lit("map<string,string>")).alias("m"))
    names = groups.filter("m is not null").select("grp_pos", "grp", F.posexplode(F.map_entries("m")).alias("canonical_pos", "c"))
    names = names.select("grp_pos", "grp", "canonical_pos", F.col("c.key").alias("canonical"), F.from_json("c.value", F.lit("array<string>")).alias("aliases"))
    return names.select("grp", "grp_pos", "canonical", "canonical_pos", F.posexplode_outer("aliases").alias("alias_pos", "alias"))


def nest_store(terms: DataFrame) -> DataFrame:
    """[CJ-02] One row grp, entries map<canonical, aliases> from a long term table; groups, canonicals and aliases in order."""
    aliases = terms.groupBy("grp", "canonical").agg(F.array_sort(F.collect_list(F.when(F.col("alias").isNotNull(), F.struct("alias_pos", "alias")))).alias("a"))
    rows = aliases.select("grp", "canonical", F.transform("a", lambda x: x["alias"]).alias("aliases"))
    return rows.groupBy("grp").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("canonical", "aliases")))).alias("entries"))


def sorted_store(terms: DataFrame) -> DataFrame:
    """[ST-01] Rows (grp, canonical, aliases) sorted without regard to case at three levels."""
    rows = terms.groupBy("grp", "canonical").agg(F.collect_list("alias").alias("aliases"))
    order = lambda a, b: F.when(F.lower(a) < F.lower(b), -1).when(F.lower(a) > F.lower(b), 1).otherwise(0)
    return rows.select("grp", "canonical", F.array_sort("aliases", order).alias("aliases")).orderBy(F.lower("grp"), F.lower("canonical"), "grp", "canonical")


def schema_breaches(documents: DataFrame, column: str = "value") -> DataFrame:
    """[L1-001] Rows (location, reason) where a store isn't object of objects of arrays of non-blank strings."""
    root = F.try_parse_json(column)
    kind = lambda c: F.schema_of_variant(c)
    roots = documents.select(F.lit("root").alias("location"), kind(root).alias("kind"))
    bad_root = roots.filter(F.col("kind").isNull() | ~F.col("kind").startswith("OBJECT")).select("location", F.lit("root must be an object").alias("reason"))
    spark = documents.sparkSession
    explode = lambda df: df.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    ok = documents.select(root.alias("v")).filter(kind(F.col("v")).startswith("OBJECT"))
    groups = explode(ok).select(F.col("key").alias("grp"), F.col("value").alias("v"))
    bad_group = groups.filter(~kind(F.col("v")).startswith("OBJECT")).select(F.concat(F.lit("group:"), "grp").alias("location"), F.lit("group must be an object").alias("reason"))
    names = explode(groups.filter(kind(F.col("v")).startswith("OBJECT"))).select("grp", F.col("key").alias("canonical"), F.col("value").alias("v"))
    at = F.concat(F.lit("group:"), "grp", F.lit(".canonical:"), "canonical")
    bad_list = names.filter(~kind(F.col("v")).startswith("ARRAY")).select(at.alias("location"), F.lit("aliases must be an array").alias("reason"))
    blank = names.filter(F.trim("canonical") == "").select(at.alias("location"), F.lit("canonical must not be blank").alias("reason"))
    aliases = explode(names.filter(kind(F.col("v")).startswith("ARRAY"))).select("grp", "canonical", "pos", F.col("value").alias("v"))
    no_text = (kind(F.col("v")) != "STRING") | (F.trim(F.try_variant_get("v", "$", "string")) == "")
    bad_alias = aliases.filter(no_text).select(F.concat(at, F.lit(".alias:"), F.col("pos").cast("string")).alias("location"), F.lit("alias must be non-blank text").alias("reason"))
    return bad_root.unionByName(bad_group).unionByName(bad_list).unionByName(blank).unionByName(bad_alias)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """[IO-15] (canonical, alias) of a JSON object; of a canonical that is written twice the last counts."""
    text = spark.read.text(path, wholetext=True)
    entries = F.regexp_extract_all("value", F.lit(r'"((?:[^"\\]|\\.)*)"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(0))
    each = text.select(F.posexplode(entries).alias("pos", "e")).select("pos", F.from_json(F.concat(F.lit("{"), "e", F.lit("}")), F.lit("map<string,string>")).alias("m"))
    rows = each.select("pos", F.explode("m").alias("canonical", "alias"))
    return rows.groupBy("canonical").agg(F.max_by("alias", "pos").alias("alias"))


def read_exceptions(spark: SparkSession, path: str) -> DataFrame:
    """[IO-14] (term_normalized, reason_code, notes) of an exceptions file; rows without a term are left out."""
    kind = "atomicity_exceptions array<struct<term_normalized: string, reason_code: string, notes: string>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", F.lit(kind))["atomicity_exceptions"]).alias("e")).select("e.*")
    return rows.withColumn("term_normalized", T.normalize(F.col("term_normalized"))).filter("term_normalized <> ''")


def latest_report(rows: DataFrame) -> DataFrame:
    """[IO-16] Of an append-only log (run_id, at, ...) the rows of the latest run."""
    last = rows.agg(F.max(F.struct("at", "run_id")).alias("l")).select("l.run_id")
    return rows.join(F.broadcast(last), "run_id", "left_semi")  # one row


RECORD = "title string, source_url string, scraped_at string, is_error boolean, technical_skills array<string>, extraction_quality struct<unmapped_skills: array<string>>, _corrupt string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """[IO-03, IO-05] (file, line_number, line) of all lines of one file or of a folder's *.jsonl; files are split, lines aren't.

    A split of a file is read by one task in order, so a line's place in its split is known there; the lines of the splits
    before it, counted for each split, give its number in the file.  The lines are written once and read from there.
    """
    reader = spark.read if path.endswith(".jsonl") else spark.read.option("pathGlobFilter", "*.jsonl")
    meta = F.col("_metadata")
    lines = reader.text(path).select(meta["file_name"].alias("file"), meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines, _ = cut(lines, "lines")
    splits = lines.groupBy("path", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("start")) - F.col("n")  # a row for each split
    splits = splits.select("path", "start", "first", before.alias("before"))
    number = (F.col("before") + F.col("at") - F.col("first") + 1).cast("int")
    return lines.join(splits, ["path", "start"]).select("file", number.alias("line_number"), "line")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """[IO-03, IO-04, IO-05] Lines of one file or of a folder's *.jsonl with file name and line number, parsed; blank lines are left out.

    ``parse_error`` marks lines that are no object.
    """
    lines = numbered_lines(spark, path).filter(F.trim("line") != "")
    record = F.from_json("line", F.lit(RECORD), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.select("file", "line_number", record.alias("r")).select("file", "line_number", F.col("r._corrupt").isNotNull().alias("parse_error"), "r.title", "r.source_url", "r.scraped_at", F.coalesce("r.is_error", F.lit(False)).alias("is_error"), "r.technical_skills", F.col("r.extraction_quality.unmapped_skills").alias("unmapped_skills"))


def record_counts(records: DataFrame) -> DataFrame:
    """[AG-18] Numbers of records, parse errors and skipped error records."""
    return records.agg(F.count_if(~F.col("parse_error") & ~F.col("is_error")).alias("records"), F.count_if("parse_error").alias("parse_errors"), F.count_if(~F.col("parse_error") & F.col("is_error")).alias("skipped"))


def write_by_status(queue: DataFrame, path: str) -> None:
    """[IO-08, CJ-06] One folder for each status slug; folders of other statuses go."""
    queue.withColumn("slug", T.status_slug(F.col("status"))).write.mode("overwrite").partitionBy("slug").json(path)


def write_json_lines(rows: DataFrame, path: str, append: bool = False) -> None:
    """[IO-07, IO-16]"""
    rows.write.mode("append" if append else "overwrite").json(path)


def csv_summary(audited: DataFrame) -> DataFrame:
    """[IO-09] The columns of the summary of an audit: name, count, match, first titles and all files."""
    return audited.select(
        F.col("display_name").alias("skill_name"),
        F.col("occurrence_count").alias("total_count"),
        F.coalesce("canonical", F.lit("")).alias("taxonomy_match"),
        F.coalesce("match_type", F.lit("")).alias("match_type"),
        F.coalesce(F.col("confidence").cast("string"), F.lit("")).alias("confidence"),
        F.array_join("titles", " | ").alias("top_job_titles"),
        F.array_join("files", " | ").alias("jsonl_files"),
    )


def write_csv_summary(audited: DataFrame, path: str) -> None:
    """[IO-09] The summary as CSV, most occurrences first."""
    csv_summary(audited.orderBy(F.desc("occurrence_count"), "skill")).write.mode("overwrite").option("header", True).csv(path)


HASH_STEP = 8192
STREAMED = ("file:", "hdfs:", "s3:", "gs:")  # what pyarrow opens as a stream


def content_hash(spark: SparkSession, path: str) -> DataFrame:
    """[IO-10] file and its SHA-256.  Files are listed by Spark and hashed as streams, ``HASH_STEP`` bytes at a time.

    Where a file's store is one that only Spark opens, its content is read as one value, which a file of 2 GB is too large for.
    """
    from pyarrow import fs

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for file in pdf["file"]:
                system, name = fs.FileSystem.from_uri(file)
                digest = hashlib.sha256()
                with system.open_input_stream(name) as stream:
                    while part := stream.read(HASH_STEP):
                        digest.update(part)
                out.append(digest.hexdigest())
            yield pdf.assign(sha256=out)

    files = spark.read.format("binaryFile").load(path)
    streamed = F.lit(False)
    for scheme in STREAMED:
        streamed |= F.col("path").startswith(scheme)
    hashed = files.filter(streamed).select(F.col("path").alias("file")).mapInPandas(run, "file string, sha256 string")
    return hashed.unionByName(files.filter(~streamed).select(F.col("path").alias("file"), F.sha2("content", 256).alias("sha256")))


def report_json(payload: dict) -> str:
    """[IO-06] Sorted keys, indent 2, newline at the end."""
    return json.dumps(payload, sort_keys=True, indent=2, ensure_ascii=False) + "\n"


def read_universe(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """[IO-19] (nodes, edges) of a graph document."""
    kind = "nodes map<string, struct<total_count: bigint, group: string, super_group: string, senior_count: bigint>>, links array<struct<source: string, target: string, weight: bigint>>"
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", F.lit(kind)).alias("d"))
    nodes = doc.select(F.explode("d.nodes").alias("skill", "n")).select("skill", "n.total_count", F.col("n.group").alias("grp"), F.col("n.super_group").alias("super_grp"), "n.senior_count")
    return nodes, doc.select(F.explode("d.links").alias("l")).select(F.col("l.source").alias("a"), F.col("l.target").alias("b"), "l.weight")
