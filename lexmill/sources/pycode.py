"""Python sources as rows: files, chunks, imports, definitions and calls."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.components import connected_components
from lexmill.operators.cycles import cycle_edges

SKIPPED = r"/(\.git|\.venv|venv|node_modules|__pycache__|build|dist)/"


def read_sources(spark: SparkSession, root: str) -> DataFrame:
    """[IO-20] (file, source) of all .py files below ``root`` but those in skipped folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.py").load(root)
    return files.filter(~F.col("path").rlike(SKIPPED)).select(F.col("path").alias("file"), F.decode("content", "UTF-8").alias("source"))


def facts(sources: DataFrame) -> DataFrame:
    """[CJ-10, GR-08] (file, kind, name, first, last, text): chunks of functions and classes, imports, definitions, calls.

    A file that doesn't parse gives one row of kind "error".
    """

    def of(file: str, source: str) -> Iterator[tuple]:
        try:
            tree = ast.parse(source)
        except (SyntaxError, ValueError) as e:
            yield file, "error", type(e).__name__, 0, 0, str(e)
            return
        for node in tree.body:
            if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                yield file, "chunk", node.name, node.lineno, node.end_lineno, ast.get_source_segment(source, node)
        for node in ast.walk(tree):
            if isinstance(node, ast.Import):
                for a in node.names:
                    yield file, "import", a.name, node.lineno, node.lineno, None
            elif isinstance(node, ast.ImportFrom) and node.module:
                yield file, "import", node.module, node.lineno, node.lineno, None
            elif isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
                yield file, "def", node.name, node.lineno, node.end_lineno, None
            elif isinstance(node, ast.Call) and isinstance(node.func, ast.Name):
                yield file, "call", node.func.id, node.lineno, node.lineno, None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [r for f, s in zip(pdf["file"], pdf["source"]) for r in of(f, s or "")]
            yield pd.DataFrame(rows, columns=["file", "kind", "name", "first", "last", "text"])

    return sources.select("file", "source").mapInPandas(run, "file string, kind string, name string, first int, last int, text string")


def uncalled(rows: DataFrame) -> DataFrame:
    """[SO-04] Functions that are defined but never called by name."""
    return rows.filter("kind = 'def'").select("name").distinct().join(rows.filter("kind = 'call'").select("name"), "name", "left_anti")


def import_edges(rows: DataFrame) -> DataFrame:
    """[GR-08] (a, b): files and the modules they import."""
    return rows.filter("kind = 'import'").select(F.col("file").alias("a"), F.col("name").alias("b")).distinct()


def module_names(files: DataFrame, root: str = "") -> DataFrame:
    """(file, module): the dotted names by which the files below ``root`` are imported; a package goes by its folder."""
    path = F.regexp_replace(F.substring("file", len(root) + 1, 1 << 20), "^/+", "") if root else F.col("file")
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"\.py$", ""), "/", "."), r"(^|\.)__init__$", "")
    return files.select("file", name.alias("module")).filter("module <> ''").distinct()


def file_imports(rows: DataFrame, files: DataFrame, root: str = "") -> DataFrame:
    """[GR-08] (a, b): files that import a module which is one of ``files`` (file), and that file."""
    targets = module_names(files, root).select(F.col("file").alias("to"), F.col("module").alias("b"))
    return import_edges(rows).join(targets, "b").select("a", F.col("to").alias("b")).distinct()


def import_cycles(rows: DataFrame, files: DataFrame, root: str = "") -> DataFrame:
    """[GR-08] (a, b, component): imports between files that lie on a cycle, named by the smallest file of the knot."""
    return cycle_edges(file_imports(rows, files, root))


def import_groups(rows: DataFrame) -> DataFrame:
    """Files and modules connected by imports."""
    return connected_components(import_edges(rows))


def diagram_lines(edges: DataFrame) -> DataFrame:
    """[GR-09] (value): the lines of a diagram of edges (a, b), the head in front of the edges in order."""
    lines = edges.select("a", "b").distinct().select(F.lit(1).alias("k"), "a", "b", F.format_string('    "%s" --> "%s"', "a", "b").alias("value"))
    head = edges.sparkSession.createDataFrame([(0, "", "", "graph TD")], "k int, a string, b string, value string")
    return head.unionByName(lines).orderBy("k", "a", "b").select("value")


def write_diagram(edges: DataFrame, path: str) -> None:
    """[GR-09] The diagram as text files below ``path``, sorted by ranges; read in order of their names they are one text."""
    diagram_lines(edges).write.mode("overwrite").text(path)
