"""The discovery of new terms as steps over a folder: discover, audit, review, apply."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import discovery, matching, rules
from lexmill.sources import stores


class Discovery:
    """[OR-06, SS-01, SS-02] Queue, audit, review and approved terms of one folder, each table replaced as a whole.

    The queue is written beside the old one and then takes its place, so a lost run leaves the old queue.
    """

    def __init__(self, spark: SparkSession, folder: str, threshold: int = 5, most_sources: int = 10, fuzzy: float = 0.85):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.threshold, self.most_sources, self.fuzzy = threshold, most_sources, fuzzy

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _system(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _places(self, name: str):
        """Where a table, the one that will replace it, and the one that it replaced are."""
        jvm = self.spark._jvm.org.apache.hadoop.fs.Path
        return jvm(self._path(name)), jvm(self._path(f"_{name}_new")), jvm(self._path(f"_{name}_old"))

    def _has(self, name: str) -> bool:
        """Whether there is a table; one that an interrupted replacement has put aside is put back."""
        now, _, old = self._places(name)
        system = self._system(now)
        if not system.exists(now) and system.exists(old):
            system.rename(old, now)
        return system.exists(now)

    def _replace(self, name: str, rows: DataFrame) -> None:
        """Write, put the old table aside, rename, delete: at each step the old table or the new one is whole.

        ``rows`` may be made from the table that they replace.
        """
        self._has(name)
        now, new, old = self._places(name)
        system = self._system(now)
        rows.write.mode("overwrite").parquet(new.toString())
        system.delete(old, True)
        if system.exists(now):
            system.rename(now, old)
        system.rename(new, now)
        system.delete(old, True)

    def table(self, name: str) -> DataFrame:
        self._has(name)
        return self.spark.read.parquet(self._path(name))

    def discover(self, records_path: str, terms: DataFrame) -> dict[str, int]:
        """[AG-18, SO-05] Candidates that match no term go to the queue; counts of records, matched and new names."""
        records = stores.read_records(self.spark, records_path)
        found = discovery.candidates(records)
        matched = matching.match(found.select("name"), terms, self.fuzzy).select("name").distinct()
        fresh = found.join(matched, "name", "left_anti")
        at = F.concat_ws("|", "file", F.lpad(F.col("line_number").cast("string"), 12, "0"), F.lpad(F.col("pos").cast("string"), 6, "0"))
        delta = discovery.queue_delta(fresh.select("name", "tag", "source", "day", at.alias("ord")), most_sources=self.most_sources)
        queue = discovery.merge_queue(self.table("queue"), delta, self.threshold, self.most_sources) if self._has("queue") else discovery.new_queue(delta, self.threshold, self.most_sources)
        self._replace("queue", queue)
        stores.write_by_status(self.table("queue"), self._path("queue_by_status"))
        counts = stores.record_counts(records).first().asDict()
        return counts | {"matched": matched.count(), "novel": fresh.select(F.lower("name")).distinct().count()}

    def audit(self, records_path: str, terms: DataFrame | None = None) -> dict[str, int]:
        """[AG-05, IO-09] Every occurrence of every name, its summary with the match in ``terms``, that as CSV, and the totals."""
        records = stores.read_records(self.spark, records_path)
        rows = discovery.candidates(records).join(records.select("file", "line_number", "title"), ["file", "line_number"])
        self._replace("occurrences", discovery.occurrence_rows(rows))
        self._replace("audit", discovery.audit(rows, terms, self.fuzzy))
        stores.write_csv_summary(self.table("audit"), self._path("audit_csv"))
        return discovery.audit_totals(self.table("audit"), records).first().asDict()

    def review(self, terms: DataFrame, assignments: DataFrame | None = None, semantic: DataFrame | None = None) -> DataFrame:
        """[GV-10] Ready entries with their default action, for people to change."""
        known = rules.alias_map(terms).select("key", "canonical")
        groups = terms.select(F.col("grp").alias("name")).distinct()
        self._replace("review", discovery.review(self.table("queue"), known, groups, assignments, semantic))
        return self.table("review")

    def apply(self, reviewed: DataFrame | None = None) -> dict[str, int]:
        """[GV-11, AG-17] Approved terms and aliases; entries with a decision leave the ready ones."""
        rows = reviewed if reviewed is not None else self.table("review")
        approved, aliases, counters = discovery.applied(rows)
        self._replace("approved", approved)
        self._replace("aliases", aliases)
        settled = F.when(F.col("action") == "approve", "approved").when(F.col("action").startswith("alias_of:"), "aliased").when(F.col("action") == "reject", "rejected")
        done = rows.select("key", settled.alias("settled"))
        queue = self.table("queue").join(done, "key", "left")
        self._replace("queue", queue.withColumn("status", F.coalesce("settled", "status")).drop("settled"))
        return counters.first().asDict()
