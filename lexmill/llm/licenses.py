"""License scan: fixed phrases, and an exact set-similarity join of license templates with the text blocks of documents.

A template's tokens are its distinct words, ordered by how often they occur in all documents, the rarest first.  It meets
a block if the block holds at least ``threshold`` of its tokens.  Then the two share one of the first tokens of the
template, as many as may be missing and one more (the prefix filter), the block holds enough tokens at all (length), and
what is left of both after the first common token is enough (position).  What passes the filters is counted exactly.

Blocks are half-overlapping windows of 2, 4, 8 ... times two words; a template is held against those of the smallest size
whose half holds all its words.  So a text that repeats a template lies whole in one block, and no block is more than four
times as long as the template, where scattered words would meet it by chance.

A template whose tokens are a part of another's goes where both are met in blocks that overlap: "cc by 4 0" is no license
of its own in "cc by nc 4 0".
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import text as tx
from lexmill.llm.scratch import shielded, widened

_U = np.uint64
THRESHOLD = "19/20"
MOST_TEMPLATE_WORDS = 1 << 20  # the templates are sent to every task

# Phrases whose words make a base match, with their labels.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Usual wordings of license notices, with labels.  Of wordings below 20 words all must be met, so those that
# differ in a version or a clause alone don't meet each other.
TEMPLATES = (
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("agpl-3", "gnu affero general public license as published by the free software foundation either version 3 of the license"),
    ("apache-2", "apache license version 2"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("artistic-2", "under the terms of the artistic license 2 0"),
    ("bsd-2", "licensed under the bsd 2 clause license"),
    ("bsd-3", "licensed under the bsd 3 clause license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("cc0", "creative commons cc0 1 0 universal"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("epl-2", "eclipse public license version 2 0"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl-2-1", "gnu lesser general public license version 2 1"),
    ("lgpl-3", "gnu lesser general public license version 3"),
    ("mit", "under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mozilla public license version 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "licensed under the zlib license"),
)

WORD = np.zeros(256, dtype=np.uint8) + 0x20
for _lo, _hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    WORD[_lo : _hi + 1] = np.arange(_lo, _hi + 1)
WORD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def plain_words(text: str) -> list[str]:
    """Words of a template or phrase, as those of documents are found."""
    return WORD[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes().decode().split() if text else []


def _hashes(words: Sequence[str]) -> np.ndarray:
    raw, offsets = tx.string_buffer(pa.array(list(words), pa.string()))
    return tx.run_hashes(tx.BYTE[raw], offsets[:-1], offsets[1:])


@dataclass
class Vocabulary:
    """The distinct words of templates and phrases: sorted hashes, and the words themselves to hold matches against."""

    words: list[bytes]
    hashes: np.ndarray

    @staticmethod
    def of(texts: Sequence[str]) -> Vocabulary:
        words = sorted({w for t in texts for w in plain_words(t)})
        hashes = _hashes(words)
        order = np.argsort(hashes)
        return Vocabulary([words[i].encode() for i in order], hashes[order])

    def codes(self, raw: np.ndarray, words: tx.Words) -> np.ndarray:
        """For each word its number in the vocabulary, else -1; equal hashes are checked by their bytes."""
        if not len(self.hashes) or not len(words.hashes):
            return np.full(len(words.hashes), -1, dtype=np.int32)
        at = np.minimum(np.searchsorted(self.hashes, words.hashes), len(self.hashes) - 1).astype(np.int32)
        at[self.hashes[at] != words.hashes] = -1
        found = np.flatnonzero(at >= 0)
        sizes = np.array([len(w) for w in self.words])
        at[found[(words.ends - words.starts)[found] != sizes[at[found]]]] = -1
        found = found[at[found] >= 0]
        for length in np.unique(sizes[at[found]]):
            own = found[sizes[at[found]] == length]
            table = np.frombuffer(b"".join(w.ljust(length)[:length] for w in self.words), dtype=np.uint8).reshape(-1, length)
            unlike = (raw[words.starts[own][:, None] + np.arange(length)] != table[at[own]]).any(axis=1)
            at[own[unlike]] = -1
        return at


@dataclass
class Template:
    label: str
    tokens: np.ndarray  # distinct, rarest first
    need: int  # tokens that a block must hold
    half: int  # half the words of a block


class Index:
    """Templates by the tokens of their prefixes."""

    def __init__(self, templates: Sequence[tuple[str, str]], vocabulary: Vocabulary, counts: dict[int, int], threshold: str):
        number = {w: i for i, w in enumerate(vocabulary.words)}
        self.templates: list[Template] = []
        self.rank = np.empty(len(vocabulary.words), dtype=np.int64)
        order = sorted(range(len(vocabulary.words)), key=lambda i: (counts.get(i, 0), vocabulary.words[i]))
        self.rank[order] = np.arange(len(order))
        for label, text in templates:
            words = plain_words(text)
            tokens = sorted({number[w.encode()] for w in words}, key=lambda i: self.rank[i])
            if tokens:
                need = math.ceil(Fraction(threshold) * len(tokens))
                self.templates.append(Template(label, np.array(tokens), max(need, 1), max(2, 1 << (len(words) - 1).bit_length())))
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, x in enumerate(self.templates):
            for place, token in enumerate(x.tokens[: len(x.tokens) - x.need + 1]):
                self.prefix.setdefault(int(token), []).append((t, place))
        sets = [set(x.tokens.tolist()) for x in self.templates]
        self.wider = {t: {u for u, other in enumerate(sets) if own < other} for t, own in enumerate(sets)}
        self.starting = np.zeros(len(vocabulary.words), dtype=bool)
        self.starting[list(self.prefix)] = True

    def matches(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first word of the block, common tokens) of all blocks of one text that meet a template."""
        out, seen = [], set()
        known = codes[codes >= 0]
        begun = known[self.starting[known]]
        for token in np.unique(begun):
            at = np.flatnonzero(codes == token)
            for t, place in self.prefix[int(token)]:
                x = self.templates[t]
                for k in np.unique(np.concatenate([at // x.half, np.maximum(at // x.half - 1, 0)])).tolist():
                    if (t, k) in seen:
                        continue
                    seen.add((t, k))
                    block = codes[k * x.half : (k + 2) * x.half]
                    held = np.unique(block[block >= 0])
                    after = int((self.rank[held] > self.rank[token]).sum())
                    if len(held) < x.need or 1 + place + min(len(x.tokens) - place - 1, after) < x.need:  # length, position
                        continue
                    common = int(np.isin(x.tokens, held, assume_unique=True).sum())
                    if common >= x.need:
                        out.append((t, k * x.half, common))
        return [m for m in out if not any(o[0] in self.wider[m[0]] and self._overlap(o, m) for o in out)]

    def _overlap(self, a: tuple[int, int, int], b: tuple[int, int, int]) -> bool:
        return a[1] < b[1] + 2 * self.templates[b[0]].half and b[1] < a[1] + 2 * self.templates[a[0]].half


def _vocabulary(templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]) -> Vocabulary:
    texts = [t for _, t in (*templates, *phrases)]
    if sum(len(plain_words(t)) for t in texts) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words; scan with a part of them at a time")
    return Vocabulary.of(texts)


def _coded(column: pa.Array, vocabulary: Vocabulary) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, first word of each row, codes of all words) for blocks of rows."""
    raw, offsets = tx.string_buffer(column)
    for lo, hi in tx.row_blocks(offsets):
        part = WORD[raw[offsets[lo] : offsets[hi]]]
        words = tx.words_of(part, offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, words.ptr, vocabulary.codes(part, words)


def token_counts(documents: DataFrame, vocabulary: Vocabulary) -> dict[int, int]:
    """Occurrences of the vocabulary's words in all documents: one row for each task and word, and as many as words to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.words) + 1, dtype=np.int64)
        for batch in batches:
            for _, _, _, codes in _coded(batch.column(0), vocabulary):
                total += np.bincount(codes + 1, minlength=len(total))
        found = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[1:][found])], names=["token", "n"])

    counted = documents.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in counted.collect()}  # at most MOST_TEMPLATE_WORDS


def _phrase_places(codes: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of ``phrase`` stand consecutively."""
    if not len(phrase) or len(codes) < len(phrase):
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(codes[: len(codes) - len(phrase) + 1] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[codes[at + k] == phrase[k]]
    return at


MATCHES = "array<struct<label: string, template: int, first_word: long, common: int, containment: double>>"


def scan(
    documents: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
    threshold: str = THRESHOLD,
    carry: bool = False,
) -> DataFrame:
    """Every row's words, places of ``phrases``, and blocks that meet a template at ``threshold`` (a fraction).

    Gives doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the largest containment that meets
    the threshold, 1 with a phrase, else 0) and ``matches``, one entry for each template and block.  Null and empty texts
    have no words and no labels; rows of a doc_id are scanned each; without rows there are none.  With ``carry`` the other
    columns stay (those of the names above are replaced).
    """
    vocabulary = _vocabulary(templates, phrases)
    index = Index(templates, vocabulary, token_counts(documents, vocabulary), threshold)
    number = {w: i for i, w in enumerate(vocabulary.words)}
    wanted = [(label, np.array([number[w.encode()] for w in plain_words(text)], dtype=np.int32)) for label, text in phrases]
    added = (("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"), ("base_labels", "string"), ("labels", "string"), ("score", "double"), ("matches", MATCHES))
    documents = documents.drop(*[n for n, _ in added])
    base, _ = shielded(documents if carry else documents.select("doc_id", "text"), "doc_id", "text")
    schema = widened(base.schema, *((f"__{n}", kind) for n, kind in added))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("common", pa.int32()), ("containment", pa.float64())]))]

    def row_of(codes: np.ndarray) -> tuple:
        places = [(label, _phrase_places(codes, p)) for label, p in wanted]
        starts = np.concatenate([p for _, p in places]) if places else np.zeros(0, dtype=np.int64)
        own = {label for label, p in places if len(p)}
        met = [
            {"label": x.label, "template": t, "first_word": at, "common": common, "containment": common / len(x.tokens)}
            for t, at, common in sorted(index.matches(codes))
            for x in (index.templates[t],)
        ]
        ends = (int(starts.min()), int(starts.max())) if len(starts) else (None, None)
        score = max([1.0 if own else 0.0, *(m["containment"] for m in met)])
        return len(codes), len(starts), *ends, ",".join(sorted(own)), ",".join(sorted(own | {m["label"] for m in met})), score, met

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, ptr, codes in _coded(batch.column(batch.schema.names.index("text")), vocabulary):
                made = [row_of(codes[ptr[i] : ptr[i + 1]]) for i in range(hi - lo)]
                cols = [pa.array(x, kind) for x, kind in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, *cols], names=[*batch.schema.names, *(f"__{n}" for n, _ in added)])

    out = base.mapInArrow(run, schema)
    kept = [(new, old) for new, old in zip(base.columns, documents.columns if carry else ["doc_id", "text"]) if carry or old != "text"]
    return out.select(*[F.col(new).alias(old) for new, old in kept], *[F.col(f"__{n}").alias(n) for n, _ in added])
