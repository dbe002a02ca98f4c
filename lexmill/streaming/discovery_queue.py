"""The discovery queue as a stream: the same state as merging batches one by one."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from lexmill.functions import text as T

OUT = "key string, display_name string, seen_count long, first_seen string, last_seen string, tags string, sources string, status string"
ENTRY = "display_name string, seen_count long, first_seen string, last_seen string, status string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class QueueEntry(StatefulProcessor):
    """One entry of the queue.  Its tags are a map of which only the counts that change are written, its sources a list that is appended to."""

    def __init__(self, threshold: int, most_sources: int):
        self.threshold, self.most_sources = threshold, most_sources

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entry = handle.getValueState("entry", ENTRY)
        self.tags = handle.getMapState("tags", "tag string", "n long")
        self.sources = handle.getListState("sources", "source string")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        for r in initialState.itertuples():
            self.entry.update((r.display_name, int(r.seen_count), r.first_seen, r.last_seen, r.status))
            for tag, n in json.loads(r.tags).items():
                self.tags.updateValue((tag,), (int(n),))
            if listed := [(s,) for s in json.loads(r.sources)]:
                self.sources.put(listed)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        name, seen, first, last, status = self.entry.get() if self.entry.exists() else (None, 0, None, None, "pending")
        opened, fresh, more = None, {}, {}
        for pdf in rows:
            seen += len(pdf)
            days = pdf["day"]
            first, last = min(filter(None, (first, days.min()))), max(filter(None, (last, days.max())))
            lead = pdf.loc[pdf["ord"].idxmin()]
            if opened is None or lead["ord"] < opened[0]:
                opened = (lead["ord"], lead["name"])
            for tag, n in pdf["tag"].dropna().value_counts().items():
                if tag:
                    more[tag] = more.get(tag, 0) + int(n)
            for o, s in zip(pdf["ord"], pdf["source"]):
                if s and (s not in fresh or o < fresh[s]):
                    fresh[s] = int(o)
        for tag, n in more.items():
            old = self.tags.getValue((tag,)) if self.tags.containsKey((tag,)) else (0,)
            self.tags.updateValue((tag,), (old[0] + n,))
        listed = [s for (s,) in self.sources.get()]
        added = [s for s in sorted(fresh, key=fresh.get) if s not in listed][: max(0, self.most_sources - len(listed))]
        if added:
            self.sources.appendList([(s,) for s in added])
        if status == "pending" and seen >= self.threshold:
            status = "ready_for_promotion"
        self.entry.update((name or opened[1], int(seen), first, last, status))
        count = {k[0]: v[0] for k, v in self.tags.iterator()}
        row = (key[0], name or opened[1], int(seen), first, last, json.dumps(count, sort_keys=True), json.dumps(listed + added), status)
        yield pd.DataFrame([row], columns=[c.split()[0] for c in OUT.split(", ")])

    def close(self) -> None:
        pass


def initial_state(queue: DataFrame) -> DataFrame:
    """A batch queue as the state that a stream starts with."""
    tags = F.to_json(F.map_from_entries("tags"))
    return queue.select("key", "display_name", "seen_count", "first_seen", "last_seen", tags.alias("tags"), F.to_json("sources").alias("sources"), "status")


def queue_stream(mentions: DataFrame, threshold: int = 5, most_sources: int = 10, fallback_day: str = "1970-01-01", queue: DataFrame | None = None) -> DataFrame:
    """[SS-01, SS-02] Updated entries (OUT; tags and sources as JSON) of a stream of (name, tag, source, day, ord).

    ``queue`` is a batch queue to start from; entries that no batch touches stay as they are and aren't given again.  All
    parts of the state are commutative but the order of sources, which is that of ``ord`` within a batch.  No watermark is
    needed, since an entry lives as long as the queue.  The state needs the RocksDB provider, which is set here.
    """
    mentions.sparkSession.conf.set(PROVIDER, ROCKS)
    keyed = mentions.select(T.queue_key(F.col("name")).alias("key"), "name", "tag", "source", F.coalesce("day", F.lit(fallback_day)).alias("day"), "ord")
    start = initial_state(queue).groupBy("key") if queue is not None else None
    return keyed.groupBy("key").transformWithStateInPandas(QueueEntry(threshold, most_sources), OUT, "Update", "None", start)
