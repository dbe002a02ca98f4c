"""Fill-in-the-middle: a text is cut at two places between tokens and its parts are put into another order.

The matcher never holds the tokens of a text.  A first pass counts them; a second one advances a lazy iterator over the
matches to the two places and stops there.  What a row needs besides its text is two offsets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.scratch import shielded, widened

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
PLAIN, PSM, SPM = "plain", "psm", "spm"


def count_units(text: str, unit: re.Pattern) -> int:
    """The first pass: how many tokens the text has."""
    return sum(1 for _ in unit.finditer(text))


def places(text: str, unit: re.Pattern, first: int, second: int) -> tuple[int, int]:
    """The second pass: where ``first`` and ``second`` (not smaller) tokens end, from one walk of the match iterator.

    A token starts where the one before ends, so after a rank's last token there is nothing to look up.
    """
    walk = unit.finditer(text)
    at = [0, 0]
    for k, steps in enumerate((first, second - first)):
        last = None
        for last in islice(walk, steps):
            pass
        at[k] = last.end() if last is not None else at[0]
    return at[0], at[1]


def arranged(text: str, form: str, cut: tuple[int, int]) -> str:
    p, s, m = MARKS
    if form == PSM:
        return "".join((p, text[: cut[0]], s, text[cut[1] :], m, text[cut[0] : cut[1]]))
    if form == SPM:
        return "".join((s, text[cut[1] :], p, text[: cut[0]], m, text[cut[0] : cut[1]]))
    return text


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of "seed:doc_id"; a null id draws as the word null."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(documents: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, carry: bool = False) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) of every row: ``rate`` percent transformed, ``spm_rate`` of
    them suffix first.

    A null text is an empty one.  Empty texts and texts that hold one of the marks stay plain, whatever the draw; a plain
    row's counts are null.  Rows that repeat a doc_id draw alike.  With ``carry`` all other columns of ``documents`` stay
    (columns of the names above are replaced, text among them goes on); an empty table gives an empty result.
    """
    added = (("n", "long"), ("form", "string"), ("output", "string"), ("prefix_chars", "long"), ("middle_chars", "long"))
    documents = documents.drop(*[n for n, _ in added])
    base, restore = shielded(documents if carry else documents.select("doc_id", "text"), "doc_id", "text")
    h = draws(F.col("doc_id"), seed)
    marked = F.lit(False)
    for mark in MARKS:
        marked |= F.col("text").contains(mark)
    text = F.coalesce("text", F.lit(""))
    form = F.when((text == "") | marked | (F.pmod(h[2], F.lit(100)) >= rate), PLAIN).when(F.pmod(h[3], F.lit(100)) < spm_rate, SPM).otherwise(PSM)
    rows = base.select("*", h[0].alias("__h1"), h[1].alias("__h2"), form.alias("__form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = re.compile(UNIT)
        for batch in batches:
            own = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in ("__h1", "__h2", "__form")]
            named = [n for n in batch.schema.names if n not in ("__h1", "__h2", "__form")]
            col = {n: batch.column(n) for n in ("text", "__h1", "__h2", "__form")}
            lo, size = 0, 0
            made: list[tuple] = []
            for i in range(len(batch)):
                value = col["text"][i].as_py() or ""
                kind, n = col["__form"][i].as_py(), count_units(value, unit)
                if kind == PLAIN:
                    made.append((n, kind, value, None, None))
                else:
                    a, b = sorted((col["__h1"][i].as_py() % (n + 1), col["__h2"][i].as_py() % (n + 1)))
                    cut = places(value, unit, a, b)
                    made.append((n, kind, arranged(value, kind, cut), cut[0], cut[1] - cut[0]))
                size += len(value)
                if size >= 1 << 22 or i + 1 == len(batch):  # outputs go on in blocks of some MB
                    cols = [pa.array(x, kind) for x, kind in zip(zip(*made), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*(c.slice(lo, i + 1 - lo) for c in own), *cols], names=[*named, *(f"__{n}" for n, _ in added)])
                    lo, size, made = i + 1, 0, []

    out = rows.mapInArrow(run, widened(base.schema, *((f"__{n}", kind) for n, kind in added)))
    kept = [(new, old) for new, old in zip(base.columns, documents.columns if carry else ["doc_id", "text"]) if carry or old != "text"]
    return out.select(*[F.col(new).alias(old) for new, old in kept], *[F.col(f"__{n}").alias(n) for n, _ in added])


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.

    No part holds a mark, and no mark ends with another's beginning, so the first occurrence of each is the mark itself.
    """
    p, s, m = MARKS

    def between(start: str, end: str | None) -> Column:
        from_ = F.locate(start, output) + len(start)
        rest = F.substring(output, from_, F.length(output))
        return F.substring_index(rest, end, 1) if end else rest

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
