"""Model providers: protocols, an HTTP client used within partitions, and caches by text hash.

No network is needed to import or test this module; the client is a plain callable that workers make for themselves.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.operators.components import cut
from lexmill.operators.ranges import numbered_in_order


class Embedder(Protocol):
    """[UD-02]"""

    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class Chat(Protocol):
    """[UD-01]"""

    def __call__(self, prompt: str) -> str: ...


def post_json(url: str, payload: dict, timeout: float = 120.0) -> dict:
    request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.loads(answer.read())


def http_embedder(base_url: str, model: str | None = None, post: Callable[..., dict] = post_json, timeout: float = 120.0, paths: tuple[str, ...] = ("/v1/embeddings", "/embeddings"), last: str = "/embedding") -> Embedder:
    """[IO-11] The whole batch at the first of ``paths`` that answers, then text by text there, then text by text at ``last``.

    Rows come back in order of their index and must be as many as asked.
    """
    named = {"model": model} if model else {}
    ask_at = lambda path, payload: post(f"{base_url.rstrip('/')}{path}", payload | named, timeout=timeout)

    def listed(path: str, given: list[str] | str, n: int) -> list[list[float]]:
        rows = ask_at(path, {"input": given})["data"]
        vectors = [r["embedding"] for r in sorted(rows, key=lambda r: r.get("index", 0))]
        if len(vectors) != n:
            raise ValueError(f"{len(vectors)} vectors for {n} texts")
        return vectors

    def plain(text: str) -> list[float]:
        for payload in ({"content": text}, {"input": text}):
            try:
                answer = ask_at(last, payload)
                row = answer[0] if isinstance(answer, list) else answer
                vector = row["embedding"] if "embedding" in row else row["data"][0]["embedding"]
                return vector[0] if vector and isinstance(vector[0], list) else vector
            except (OSError, ValueError, KeyError, IndexError, TypeError):
                continue
        raise ConnectionError(f"no embedding endpoint of {base_url} answered")

    def call(texts: list[str]) -> list[list[float]]:
        if not texts:
            return []
        ways = [lambda p=p: listed(p, texts, len(texts)) for p in paths] + [lambda p=p: [listed(p, t, 1)[0] for t in texts] for p in paths]
        for way in ways:
            try:
                return way()
            except (OSError, ValueError, KeyError, TypeError):  # URL errors are OSErrors
                continue
        return [plain(t) for t in texts]

    return call


def http_chat(base_url: str, model: str | None = None, paths: tuple[str, ...] = ("/v1/chat/completions", "/api/v1/chat", "/v1/completions"), post: Callable[..., dict] = post_json, timeout: float = 120.0) -> Chat:
    """[IO-12] The first of ``paths`` that answers."""

    def call(prompt: str) -> str:
        last: Exception | None = None
        for path in paths:
            body = {"prompt": prompt} if path.endswith("/completions") and "chat" not in path else {"messages": [{"role": "user", "content": prompt}]}
            try:
                choice = post(f"{base_url.rstrip('/')}{path}", body | ({"model": model} if model else {}), timeout=timeout)["choices"][0]
                return choice.get("text") or choice["message"]["content"]
            except (urllib.error.URLError, KeyError, IndexError) as e:
                last = e
        raise ConnectionError(f"no endpoint of {base_url} answered") from last

    return call


def get_json(url: str, timeout: float = 120.0) -> dict:
    with urllib.request.urlopen(url, timeout=timeout) as answer:
        return json.loads(answer.read())


def available(models: list[str], wanted: str) -> bool:
    """[UD-09]"""
    return any(m == wanted or m.split("/")[-1] == wanted for m in models)


def model_names(base_url: str, get: Callable[..., dict] = get_json, timeout: float = 120.0, paths: tuple[str, ...] = ("/v1/models", "/models")) -> list[str] | None:
    """[UD-09] Names of the models that a server lists, from all of ``paths`` that answer; None if none does."""
    names: set[str] = set()
    heard = False
    for path in paths:
        try:
            got = get(f"{base_url.rstrip('/')}{path}", timeout=timeout)
        except (OSError, ValueError):
            continue
        heard = True
        rows = (got.get("data") or got.get("models") or []) if isinstance(got, dict) else got if isinstance(got, list) else []
        names |= {n for r in rows if isinstance(n := (r.get("id") or r.get("name")) if isinstance(r, dict) else r, str)}
    return sorted(names) if heard else None


def verify(base_url: str, model: str | None, probe: Callable[[], object], get: Callable[..., dict] = get_json, timeout: float = 120.0) -> None:
    """[UD-09] Before a run: the model must be listed; where the server lists none, or no model is named, ``probe`` must get an answer."""
    names = model_names(base_url, get, timeout) if model else None
    if names is not None:
        if not available(names, model):
            raise RuntimeError(f"no model {model!r} at {base_url}; there are {names}")
        return
    probe()


def embedded(rows: DataFrame, column: str, make: Callable[[], Embedder], batch: int = 64) -> DataFrame:
    """[UD-02, SM-09] (column, vec) of the distinct texts of ``column``; one client a partition, asked in batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for pdf in frames:
            texts = pdf[column].tolist()
            vectors = [v for i in range(0, len(texts), batch) for v in client(texts[i : i + batch])]
            yield pd.DataFrame({column: texts, "vec": vectors})

    return rows.select(column).filter(F.col(column).isNotNull()).distinct().mapInPandas(run, f"`{column}` string, vec array<double>")


def answered(rows: DataFrame, key: str, prompt: str, make: Callable[[], Chat], cache: DataFrame | None = None, sound: Callable[[str], bool] | None = None, repair: Callable[[str, str], str] | None = None) -> DataFrame:
    """[UD-05..UD-08, SS-09] (key, prompt_md5, answer); prompts whose hash is in ``cache`` (prompt_md5, answer) aren't asked again.

    An answer that isn't ``sound`` is asked for once more with the prompt that ``repair`` makes of it; the first answer
    stays if the second isn't sound either.
    """
    asked = rows.select(key, F.col(prompt).alias("prompt"), F.md5(prompt).alias("prompt_md5"))
    todo = asked.join(cache.select("prompt_md5"), "prompt_md5", "left_anti") if cache is not None else asked

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()

        def ask(text: str) -> str:
            first = client(text)
            if sound is None or repair is None or sound(first):
                return first
            second = client(repair(text, first))
            return second if sound(second) else first

        for pdf in frames:
            yield pd.DataFrame({"prompt_md5": pdf["prompt_md5"], "answer": [ask(p) for p in pdf["prompt"]]})

    new = todo.select("prompt", "prompt_md5").distinct().mapInPandas(run, "prompt_md5 string, answer string")
    every = new.unionByName(cache.select("prompt_md5", "answer")) if cache is not None else new
    return asked.join(every, "prompt_md5").select(key, "prompt_md5", "answer")


def is_class_reply(text: str) -> bool:
    """[UD-05] Whether a model's text is a classification, or names a kind of term that has none."""
    from lexmill.functions.plain import lenient_json

    got = lenient_json(text)
    if not isinstance(got, dict):
        return False
    if isinstance(got.get("type"), str) and got["type"].strip().upper() in ("COMPOSITE_STACK", "CATEGORY"):
        return True
    inner = got.get("classification")
    return isinstance(inner, dict) and all(k in inner for k in ("ontological_nature", "primary_type", "functional_roles", "abstraction_level"))


def cluster_prompt(terms: list[str]) -> str:
    """[UD-01] What a model is asked for the terms of a cluster."""
    shape = {"decisions": [{"term": "text", "action": "|".join(S.ACTIONS), "target_canonical": "text or null", "split_candidates": ["text"], "confidence": "|".join(S.CONFIDENCES), "reasoning": {"ecosystem": "text", "abstraction_level": "text", "graph_safety": "text"}}]}
    return f"Say for each of these similar terms what should become of it: {json.dumps(terms)}\nAnswer with one JSON object of this shape and nothing else:\n{json.dumps(shape)}"


def class_prompt(term: str, previous: str | None = None) -> str:
    """[UD-05] What a model is asked for the classification of a term, and for the repair of an answer."""
    shape = {"term": term, "classification": {"ontological_nature": "|".join(S.NATURES), "primary_type": "text or null", "functional_roles": ["text"], "abstraction_level": "|".join(S.LEVELS)}, "status": "active|under_review", "confidence": "|".join(S.CONFIDENCES), "is_contextual": False, "is_versioned": False, "is_marketing_language": False}
    ask = f"Classify the term {json.dumps(term)}. Answer with one JSON object of this shape and nothing else:\n{json.dumps(shape)}"
    return ask if previous is None else f"{ask}\nYour last answer didn't have this shape; correct it:\n{previous}"


def group_prompt(skills: list[str], contexts: list[str]) -> str:
    """[UD-06] The prompt for one batch of skills and the groups there are."""
    groups = "\n".join(f"- {c}" for c in contexts)
    return f"Groups:\n{groups}\n\nGive each skill its group, NEW: and a name, or REJECT: and a reason. Answer with a JSON array of objects with skill, assigned_group, reasoning.\n{json.dumps(skills)}"


def _pages(rows: DataFrame, order: list[str], per_page: int, line: str, keys: list[str]) -> DataFrame:
    """(keys, page, lines): the column ``line`` in order, ``per_page`` to a page; pages are counted within each of ``keys``."""
    numbered, _ = cut(numbered_in_order(rows, [*keys, *order]), "pages")
    if keys:
        numbered = numbered.join(numbered.groupBy(*keys).agg(F.min("number").alias("first")), keys)
    else:
        numbered = numbered.withColumn("first", F.lit(1))
    page = F.floor((F.col("number") - F.col("first")) / per_page).alias("page")
    made = numbered.select(*keys, page, F.struct("number", F.col(line).alias("line")).alias("l"))
    lines = made.groupBy(*keys, "page").agg(F.array_sort(F.collect_list("l")).alias("ls"))  # of one page
    return lines.select(*keys, "page", F.transform("ls", lambda x: x["line"]).alias("lines"))


def assigned_groups(skills: DataFrame, contexts: DataFrame, make: Callable[[], Chat], size: int = 20, done: DataFrame | None = None, per_prompt: int = 500) -> DataFrame:
    """[UD-06, JN-18, JN-17, FN-38] (skill, assigned_group, reasoning) of skills without a row in ``done``, asked in batches.

    ``contexts`` (grp, context) are the groups.  A prompt shows ``per_prompt`` of them, so each batch is asked once for each
    page of groups, and of the answers for a skill the first that names a group there is counts, else the first.  Replies
    join back by the skill's name without regard to case; a skill that no reply names has a null group.
    """
    from lexmill.functions import udfs
    from lexmill.operators import discovery

    todo = discovery.remaining(skills.select("skill"), done, "skill") if done is not None else skills.select("skill")
    batch = discovery.batches(todo, size)
    pages = _pages(contexts.select("grp", F.concat_ws(": ", "grp", "context").alias("line")), ["grp", "line"], per_prompt, "line", [])
    pages = pages.unionByName(pages.sparkSession.createDataFrame([(0, [])], "page long, lines array<string>")).groupBy("page").agg(F.max("lines").alias("lines"))
    asked = batch.groupBy("batch").agg(F.array_sort(F.collect_list("skill")).alias("skills"))  # of one batch
    prompts = F.pandas_udf(lambda s, g: pd.Series([group_prompt(list(x), list(y)) for x, y in zip(s, g)]), "string")
    asked = asked.crossJoin(pages).select(F.struct("batch", "page").alias("k"), prompts("skills", "lines").alias("prompt"))  # every batch for every page of groups
    answers = answered(asked, "k", "prompt", make)
    rows = answers.select("k.page", F.posexplode(udfs.lenient_rows_udf(F.col("answer"))).alias("place", "row"))
    value = lambda name: F.get_json_object("row", f"$.{name}").alias(name)
    rows = rows.select("page", "place", value("skill"), value("assigned_group"), value("reasoning"))
    known = contexts.select(F.lower(F.trim("grp")).alias("low")).distinct().withColumn("known", F.lit(0))
    rows = rows.withColumn("low", F.lower(F.trim("assigned_group"))).join(known, "low", "left")
    pos = F.struct(F.coalesce("known", F.lit(1)).alias("new"), "page", "place").alias("pos")
    return discovery.matched_replies(todo.distinct(), rows.select(pos, "skill", "assigned_group", "reasoning"))


def dedup_prompt(skill: str, group: str, canonicals: list[str]) -> str:
    """[UD-07] The prompt that asks whether a skill is another name of a canonical of its group."""
    return f"Is {json.dumps(skill)} another name of one of these terms of {json.dumps(group)}? {json.dumps(canonicals)}\nAnswer with one JSON object with is_alias, alias_of, confidence, reasoning."


def semantic_aliases(assigned: DataFrame, terms: DataFrame, make: Callable[[], Chat], known: DataFrame | None = None, shown: int = 200, cache: DataFrame | None = None) -> DataFrame:
    """[UD-07, JN-16, FN-39] (skill, grp, alias_of) of skills (skill, grp) that a model takes for another name of a canonical.

    Skills that ``known`` (skill) already has as aliases aren't asked.  All canonicals of the group are shown with their
    aliases, ``shown`` to a prompt; of several prompts' answers the first in order of the canonicals counts, and one that
    names none of the group's canonicals counts for nothing.
    """
    from lexmill.functions import udfs
    from lexmill.operators import discovery

    todo = discovery.remaining(assigned.select("skill", "grp"), known, "skill") if known is not None else assigned.select("skill", "grp")
    names = terms.filter("canonical is not null").groupBy("grp", "canonical").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))  # of one canonical
    line = F.when(F.size("aliases") > 0, F.concat("canonical", F.lit(" (aliases: "), F.array_join("aliases", ", "), F.lit(")"))).otherwise(F.col("canonical"))
    pages = _pages(names.select("grp", "canonical", line.alias("line")), ["canonical"], shown, "line", ["grp"])
    prompts = F.pandas_udf(lambda s, g, n: pd.Series([dedup_prompt(a, b, list(c)) for a, b, c in zip(s, g, n)]), "string")
    asked = todo.distinct().join(pages, "grp").withColumn("prompt", prompts("skill", "grp", "lines")).withColumn("k", F.struct("skill", "grp", "page"))
    got = answered(asked, "k", "prompt", make, cache).select("k.skill", "k.grp", "k.page", udfs.alias_answer_udf(F.col("answer")).alias("alias_of"))
    own = names.select("grp", F.lower("canonical").alias("low"), F.col("canonical").alias("alias_of")).distinct()
    found = got.withColumn("low", F.lower("alias_of")).drop("alias_of").join(own, ["grp", "low"])
    return found.groupBy("skill", "grp").agg(F.min_by("alias_of", F.struct("page", "alias_of")).alias("alias_of"))


def audited_pairs(terms: DataFrame, make: Callable[[], Chat], state: DataFrame | None = None, input_hash: str = "") -> DataFrame:
    """[UD-08, SS-07, SO-08] (canonical, alias, answer, input_hash): each alias judged once; rows of ``state`` for this input stand.

    ``state`` has the columns of the result; its rows of another input are dropped.
    """
    from lexmill.operators import discovery

    pairs = terms.filter("alias is not null").select("canonical", "alias").distinct()
    live = discovery.live_state(state, input_hash).select("canonical", "alias", "answer") if state is not None else None
    todo = pairs.join(live.select("canonical", "alias"), ["canonical", "alias"], "left_anti") if live is not None else pairs
    ask = F.concat(F.lit('May "'), "alias", F.lit('" stand for "'), "canonical", F.lit('" everywhere? Answer yes or no.'))
    asked = todo.withColumn("prompt", ask).withColumn("k", F.struct("canonical", "alias"))
    got = answered(asked, "k", "prompt", make).select("k.canonical", "k.alias", F.lower(F.trim("answer")).alias("answer"))
    return (got.unionByName(live) if live is not None else got).withColumn("input_hash", F.lit(input_hash))
