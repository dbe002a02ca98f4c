"""Matching of candidate names against the taxonomy in tiers, and candidate merging."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.plain import best_ratio
from lexmill.operators.components import Written, cut
from lexmill.operators.rules import alias_map


def _best(rows: DataFrame) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("name").orderBy("pos", "canonical"))
    return rows.withColumn("nth", nth).filter("nth = 1").drop("nth", "pos")


def match(names: DataFrame, terms: DataFrame, threshold: float = 0.85, fuzzy: bool = True) -> DataFrame:
    """[JN-10, SM-06, SM-08] (name, canonical, match_type, confidence) of the distinct names that match.

    Tiers: group name, alias, alias without punctuation, closest spelling, longest-standing canonical contained; only
    names that a tier leaves over go on to the next and dearer one.  The first in store order wins ties.
    """
    todo = names.select("name").filter("name is not null").distinct().withColumn("low", F.lower("name"))
    keys = alias_map(terms)
    out = []

    def tier(rows: DataFrame, kind: str, confidence) -> None:
        nonlocal todo
        found = rows.select("name", "canonical", F.lit(kind).alias("match_type"), (F.lit(confidence) if isinstance(confidence, float) else confidence).alias("confidence"))
        out.append(found)
        todo = todo.join(found.select("name"), "name", "left_anti")

    groups = terms.select(F.lower("grp").alias("low")).distinct()
    tier(todo.join(groups, "low").withColumn("canonical", F.col("low")), "group_exact", 1.0)
    tier(todo.join(keys.select(F.col("key").alias("low"), "canonical"), "low"), "exact", 1.0)
    bare = keys.select(T.strip_punctuation(F.col("key")).alias("bare"), "canonical", "pos")
    tier(_best(todo.withColumn("bare", T.strip_punctuation(F.col("low"))).join(bare, "bare").select("name", "canonical", "pos")), "normalized", 0.95)
    if fuzzy:
        closest, _ = cut(_closest(todo, keys, threshold), "closest")  # written: it is read twice and dear
        tier(closest, "fuzzy", F.col("ratio"))
    names_of = terms.select(F.lower("canonical").alias("canonical"), F.struct("grp_pos", "canonical_pos").alias("pos")).groupBy("canonical").agg(F.min("pos").alias("pos")).filter(F.length("canonical") >= 3)
    tier(_best(_contained(todo, names_of)), "containment", 0.80)
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result


def _trigrams(text) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3))))


def _contained(todo: DataFrame, names: DataFrame) -> DataFrame:
    """(name, canonical, pos) of canonicals inside a name: an equi-join on the rarest trigram of each canonical, then the test."""
    grams = names.select("canonical", "pos", F.explode(_trigrams(F.col("canonical"))).alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    anchor = grams.join(often, "gram").groupBy("canonical", "pos").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    asked = todo.filter(F.length("low") > 3).select("name", "low", F.explode(_trigrams(F.col("low"))).alias("gram"))
    hits = asked.join(anchor, "gram").filter(F.col("low").contains(F.col("canonical")) & (F.col("low") != F.col("canonical")))
    return hits.select("name", "canonical", "pos")


SHORT = 64  # letters up to which two letters of the prefix make one key
CLOSEST = "name string, key string, exact double, ratio double"
HELD = 1 << 16  # entries that a task holds at once


def _pair_keys(ranked: list[tuple], overlap: int, together: int) -> Iterator[str]:
    """Keys of the prefix of a bag of letters (rarest first) that must hold ``together`` of ``overlap`` common ones."""
    prefix = ranked[: len(ranked) - overlap + together]
    if together == 1:
        yield from (f"{c}{n}" for _, c, n in prefix)
    else:
        yield from (f"{a}{i}{b}{j}" for (_, a, i), (_, b, j) in combinations(prefix, 2))


def _bag(text: str, often: dict[str, int]) -> list[tuple]:
    """The letters of a text, each with how often it came before, from rare to frequent ones."""
    seen: dict[str, int] = {}
    out = []
    for c in text:
        seen[c] = n = seen.get(c, 0) + 1
        out.append((often.get(c, 0) / (n * n), c, n))
    return sorted(out)


def _overlap(a: int, b: int, threshold: float) -> int:
    """Letters that two texts of these lengths must share for a ratio of ``threshold``."""
    return max(1, math.ceil(threshold * (a + b) / 2 - 1e-9))


def closest_candidates(todo: DataFrame, keys: DataFrame, threshold: float) -> DataFrame:
    """(name, low, key) of all pairs whose ratio can reach ``threshold``, by an index of letters.

    A ratio of t needs t (a + b) / 2 common letters of a + b.  With letters ordered from rare to frequent, two bags that
    share that many share two letters (one, of long texts) among the first that may be missing from each; those and the
    key's length are joined for equality.  A name asks for every length of a key that its own allows.
    """
    spark = todo.sparkSession
    letters = keys.select(F.explode(F.split("key", "")).alias("c")).filter("c <> ''").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    often = {r["c"]: r["n"] for r in letters.collect()}  # as many rows as letters of the alphabet, Unicode's at most
    lengths = sorted(r[0] for r in keys.select(F.length("key")).distinct().collect())  # as many as lengths of keys
    shared = spark.sparkContext.broadcast((often, lengths))
    reach = lambda n: math.ceil(threshold * n / (2 - threshold) - 1e-9)  # noqa: E731  least length that n letters can match

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often, _ = shared.value
        for pdf in batches:
            rows = []
            for key in pdf["key"]:
                n = len(key)
                together = 2 if n <= SHORT and _overlap(reach(n), n, threshold) > 1 else 1
                rows += [(key, n, k) for k in _pair_keys(_bag(key, often), _overlap(reach(n), n, threshold), together)]
                if len(rows) >= HELD:
                    yield pd.DataFrame(rows, columns=["key", "len", "entry"])
                    rows = []
            yield pd.DataFrame(rows, columns=["key", "len", "entry"])

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often, lengths = shared.value
        for pdf in batches:
            rows = []
            for name, low in zip(pdf["name"], pdf["low"]):
                bag, n = _bag(low, often), len(low)
                for m in lengths[bisect_left(lengths, reach(n)) :]:
                    if reach(m) > n:
                        break
                    together = 2 if m <= SHORT and _overlap(reach(m), m, threshold) > 1 else 1
                    rows += [(name, low, m, k) for k in _pair_keys(bag, _overlap(n, m, threshold), together)]
                    if len(rows) >= HELD:
                        yield pd.DataFrame(rows, columns=["name", "low", "len", "entry"])
                        rows = []
            yield pd.DataFrame(rows, columns=["name", "low", "len", "entry"])

    left = todo.filter("low <> ''").select("name", "low").mapInPandas(asked, "name string, low string, len int, entry string")
    right = keys.select("key").filter("key <> ''").distinct().mapInPandas(entries, "key string, len int, entry string")
    return left.join(right, ["len", "entry"]).select("name", "low", "key").distinct()


def _closest(todo: DataFrame, keys: DataFrame, threshold: float) -> DataFrame:
    """(name, canonical, ratio): the key of best SequenceMatcher ratio; candidates come from the index of letters."""
    ordered = keys.select("key", "canonical", "pos")

    def ratio(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [best_ratio(low, [key], threshold) for low, key in zip(pdf["low"], pdf["key"])]
            keep = [g is not None for g in got]
            yield pdf.loc[keep, ["name", "key"]].assign(exact=[g[1] for g in got if g], ratio=[round(g[1], 3) for g in got if g])

    scored = closest_candidates(todo, ordered, threshold).mapInPandas(ratio, CLOSEST).join(ordered, "key")
    nth = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("exact"), "pos", "key"))
    return scored.withColumn("nth", nth).filter("nth = 1").select("name", "canonical", "ratio")


def settled(offered: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which candidates (place, own) are accepted where a term of ``terms`` (place, term) is taken by the first accepted holder.

    A candidate goes if an accepted one before it holds its own term.  So of the candidates left, the first holder of a
    term is safe from that term, and one whose own term an accepted one before it holds is lost; each round settles both
    kinds for all terms at once.  There are at most as many rounds as the longest chain of candidates that wait for each
    other.  Gives (place, own, accepted) and (term, first): the place of the first accepted holder.
    """
    tables = Written(offered.sparkSession)
    wait = tables.put("wait", offered.select("place", "own"))
    held = tables.put("held", terms.select("place", "term"))
    taken = tables.put("taken", held.select("term", F.col("place").alias("first")).limit(0))
    done = tables.put("done", wait.withColumn("accepted", F.lit(True)).limit(0))
    settled.rounds = 0
    while not wait.isEmpty():
        settled.rounds += 1
        front = held.groupBy(F.col("term").alias("own")).agg(F.min("place").alias("front"))
        judged = wait.join(front, "own", "left").join(taken.withColumnRenamed("term", "own"), "own", "left")
        lost = F.col("first") < F.col("place")
        judged = tables.put("judged", judged.select("place", "own", F.when(lost, False).when(F.col("front").isNull() | (F.col("front") >= F.col("place")), True).alias("accepted")))
        done = tables.put("done", done.unionByName(judged.filter("accepted is not null")))
        new = held.join(judged.filter("accepted").select("place"), "place", "left_semi").select("term", F.col("place").alias("first"))
        taken = tables.put("taken", taken.unionByName(new).groupBy("term").agg(F.min("first").alias("first")))
        wait = tables.put("wait", judged.filter("accepted is null").select("place", "own"))
        held = tables.put("held", held.join(wait.select("place"), "place", "left_semi"))
    tables.close("done", "taken")
    return done, taken


def merged_candidates(existing: DataFrame, offered: DataFrame, by_input: bool = False) -> DataFrame:
    """[JN-12, JN-13] (grp, canonical, alias, kept, reason): candidates against the store and against earlier candidates.

    ``offered`` has grp, canonical, aliases (array) and pos, which differs from row to row.  The order is group, canonical
    and ``pos``, or ``pos`` alone with ``by_input``.  A candidate goes if its canonical is a term of the store or of an
    accepted earlier candidate, an alias likewise.  Candidates are settled in rounds (``settled``), so that no chain of
    shared terms is folded in one task.  A candidate without a canonical is none; a null alias is kept.
    """
    known = existing.select(T.normalize(F.col("canonical")).alias("term")).unionByName(existing.filter("alias is not null").select(T.normalize(F.col("alias")).alias("term"))).distinct()
    place = F.struct("pos") if by_input else F.struct("grp", "canonical", "pos")
    rows = offered.filter("canonical is not null").select("grp", "canonical", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), place.alias("place"), T.normalize(F.col("canonical")).alias("own"))
    rows, _ = cut(rows, "offered")
    stored = known.withColumnRenamed("term", "own")
    open_ = rows.join(stored, "own", "left_anti")
    words = open_.select("place", F.explode(F.concat(F.array("canonical"), "aliases")).alias("w")).select("place", T.normalize(F.col("w")).alias("term")).filter("term is not null").distinct()
    done, taken = settled(open_.select("place", "own"), words)
    clash = "canonical collides with existing term"
    judged = rows.join(done.select("place", "accepted"), "place", "left").withColumn("kept", F.coalesce("accepted", F.lit(False)))
    heads = judged.select("grp", "canonical", F.lit(None).cast("string").alias("alias"), "kept", F.when(~F.col("kept"), clash).alias("reason"))
    named = judged.filter("kept").select("grp", "canonical", "place", F.explode("aliases").alias("alias")).withColumn("term", T.normalize(F.col("alias")))
    named = named.join(known.withColumn("stored", F.lit(True)), "term", "left").join(taken, "term", "left")
    bad = F.coalesce("stored", F.lit(False)) | F.coalesce(F.col("first") < F.col("place"), F.lit(False))
    aliases = named.select("grp", "canonical", "alias", (~bad).alias("kept"), F.when(bad, "alias collides with existing term").alias("reason"))
    return heads.unionByName(aliases)
