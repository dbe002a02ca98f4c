"""Fill-in-the-middle, phrase collocations and license scan against brute force."""

import hashlib
import random
import re
from collections import Counter
from math import ceil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexmill.llm import fim, licenses, phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- fill-in-the-middle ----------------------------------------------------------------------------------------------


def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if text == "" or any(m in text for m in fim.MARKS) or h[2] % 100 >= 50:
        return n, "plain", text, None, None
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h[3] % 100 < 80:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


@pytest.fixture(scope="module")
def odd(spark, corpus):
    more = ["x", " ", "a <P> b c d", "<S", "<M>", "<<S a b <", "P> a <P", "\x1c \x85 é日本\U0001f600 z", "\n\n a\n\n"]
    rows = [(i, t, "x", 3) for i, t in corpus] + [(2000 + 20 * k + d, t, None, 1) for k, t in enumerate(more) for d in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string, output string, __n int").repartition(4)


def test_fill_in_middle_equals_brute_force(odd):
    made = fim.fill_in_middle(odd).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = made.collect()
    texts = Counter((r["doc_id"], r["text"]) for r in odd.collect())
    forms = Counter()
    want = Counter((i, *brute_fim(i, t), t or "") for (i, t), n in texts.items() for _ in range(n))
    assert Counter(tuple(r[c] for c in ("doc_id", "n", "form", "output", "prefix_chars", "middle_chars", "back")) for r in got) == want
    forms.update(r["form"] for r in got)
    assert min(forms[x] for x in ("plain", "psm", "spm")) > 5


def test_fill_in_middle_carries_columns_and_takes_odd_tables(spark, odd, nothing):
    carried = fim.fill_in_middle(odd, carry=True)
    assert carried.columns == ["doc_id", "text", "__n", "n", "form", "output", "prefix_chars", "middle_chars"] and carried.count() == odd.count()
    assert {r["__n"] for r in carried.collect()} == {1, 3}
    assert fim.fill_in_middle(nothing).collect() == []
    nulls = fim.fill_in_middle(spark.createDataFrame([(None, "a b c"), (None, None), (1, None)], "doc_id int, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n"]) for r in nulls) == [(0, 0), (0, 3), (1, 0)]


def test_matcher_stops_at_the_second_place():
    unit = re.compile(fim.UNIT)
    text = " a  b\tc d "
    ends = [0] + [m.end() for m in unit.finditer(text)]
    assert fim.count_units(text, unit) == len(ends) - 1 == 5
    for i in range(6):
        for j in range(i, 6):
            assert fim.places(text, unit, i, j) == (ends[i], ends[j])


# --- phrase collocations ---------------------------------------------------------------------------------------------


def brute_phrases(rows, most, least, share, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + m])) for m in range(1, most + 1) for i in range(len(words) - m + 1))
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in often.items():
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        inside = (b for (g, x), b in often.items() if g == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1)))
        if not any(100 * b >= share * a for b in inside):
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for r, (s, a, p, x, y) in enumerate(sorted(found)[:top])}


def tangled(rng, n):
    """Texts of few words with shared beginnings, odd bytes, tabs, cuts and repeats."""
    words = ["a", "b", "A\x00", "a\x1f", "é", "ß-x", "the", "The", "of", "日本", "rare%d", "\xa0"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words).replace("%d", str(rng.randrange(99))) + rng.choice([" ", " ", "  ", "\t ", ". ", ",", "\n", " \x0b"]) for _ in range(rng.randint(0, 40)))
        out.append((rng.choice(["en", "de", None, ""]), text))
    return [*out, ("en", None), (None, ""), ("en", "of the a b " * 400), *[("de", "one two three four five six seven")] * 9, ("en", "x" * 5000)]


@pytest.mark.parametrize(("most", "least", "share", "top", "block"), [(5, 6, 100, 1000, 1 << 20), (3, 3, 60, 7, 64), (5, 4, 100, 40, 300)])
def test_collocations_equal_brute_force(spark, most, least, share, top, block):
    rows = tangled(random.Random(block), 120)
    docs = spark.createDataFrame([(i, t, g, 1, "z") for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string").repartition(3)
    got = phrases.collocations(docs, most, least, share, top, block)
    assert {tuple(r) for r in got.collect()} == brute_phrases(rows, most, least, share, top)


def test_long_text_in_stretches_counts_every_suffix_once():
    rng = random.Random(5)
    text = " ".join(rng.choice(["a", "bb", "ccc.", "d" * 50, "e,f"]) for _ in range(3000))
    whole = Counter()
    for piece in re.split(r"[.,]", text):
        w = piece.split()
        whole.update(tuple(w[i : i + 4]) for i in range(len(w)))
    for block in (40, 256, 1 << 20):
        found = Counter()
        for s in phrases.stretches(pa.array(["x", text, None, ""]), 4, block):
            data = bytes(s.bytes)
            words = [data[s.at[i] : s.at[i + 1] - 1].decode() for i in range(len(s.starts))]
            for i in range(s.own):
                end = next((j for j in range(i + 1, len(words)) if s.breaks[j]), len(words))
                found[tuple(words[i : min(end, i + 4)])] += 1
        assert found == whole + Counter({("x",): 1})


def test_stack_joins_prefixes_across_ranges():
    rows = sorted((w for w in ("a b c ", "a b ", "a b d e ", "a c ", "b a ", "b a c ")), reverse=True)
    stack = phrases.Stack(4, 3)
    found = []
    for at in range(0, len(rows), 2):
        part = rows[at : at + 2]
        found += stack.read(pa.array(["en"] * len(part)), pa.array(part), __import__("numpy").array([2] * len(part)))
    found += stack.rest()
    # Whole counts of 3 or more, what began with the first suffix, and what was on the stack at the end.
    assert ("en", "b a ", 4) in found and ("en", "a b ", 6) in found and ("en", "b a c ", 2) in found and ("en", "a ", 8) in found
    assert ("en", "a c ", 2) not in found


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, l, r = 10**13 + 7, 10**15 + 11, 3 * 10**13 + 1, 2 * 10**13 + 3
    made = spark.createDataFrame([("en", "x y", a), ("en", "x", l), ("en", "y", r)], "lang string, phrase string, n long")
    got = phrases.scored(made, spark.createDataFrame([("en", n)], "lang string, total long")).collect()
    assert [(x["score"], x["l"], x["r"]) for x in got] == [(1000 * a * n // (l * r), l, r)]


def test_collocations_of_nothing(nothing):
    assert phrases.collocations(nothing).collect() == []


# --- license scan ----------------------------------------------------------------------------------------------------


def brute_licenses(text, threshold=0.95):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(label, i) for label, p in licenses.BASE_PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    met = []
    for label, t in licenses.TEMPLATES:
        tokens, half = set(t.split()), max(2, 2 ** ceil(__import__("math").log2(len(t.split()))))
        for at in range(0, max(len(words), 1), half):
            held = len(tokens & set(words[at : at + 2 * half]))
            if held * 20 >= 19 * len(tokens):
                met.append((label, tokens, at, at + 2 * half, held / len(tokens)))
    met = [m for m in met if not any(m[1] < o[1] and o[2] < m[3] and m[2] < o[3] for o in met)]
    base = {label for label, _ in places}
    at = [i for _, i in places]
    return (
        len(words),
        len(places),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {m[0] for m in met})),
        max([1.0 if base else 0.0, *(m[4] for m in met)]),
    )


@pytest.fixture(scope="module")
def licensed(make):
    rng = random.Random(23)
    rows = []
    for k, (_, text) in enumerate(licenses.TEMPLATES * 3):
        words = text.upper().split() if k % 2 else text.split()
        if k % 3 == 1:
            words.pop(rng.randrange(len(words)))
        if k % 3 == 2:
            rng.shuffle(words)
        rows.append((k, make(rng, rng.randint(0, 60)) + rng.choice(["\n", " - "]) + rng.choice([" ", ", ", "/\n * "]).join(words) + ". " + make(rng, rng.randint(0, 60))))
    rows += [(500, None), (501, ""), (502, " .,\n"), (503, "mit license under the"), (504, "UNDER the MIT-license, under The mit License"), (505, "cc by nc " * 50)]
    rows += [(506, "Licensed under CC BY-NC 4.0."), (507, "é the ß gnu " * 3000 + "Licensed under the GNU General Public License, version 3."), (507, "Licensed under the GNU Affero General Public License version 3")]
    rows += [(508, "apache\x7flicense\x00version`2"), (509, "apache license version é2")]
    return rows


def test_license_scan_equals_brute_force(spark, licensed):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in licensed], "doc_id long, text string, n_words int, matches string").repartition(3)
    got = licenses.scan(docs).collect()
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert Counter((r["doc_id"], *(r[c] for c in cols)) for r in got) == Counter((i, *brute_licenses(t)) for i, t in licensed)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 507}
    assert by[506]["labels"] == "cc-by-nc" and by[504]["n_base"] == 2 and by[500]["labels"] == "" and by[500]["score"] == 0.0
    assert {r["labels"] for r in got if r["doc_id"] == 507} == {"gpl-3", "agpl-3"}
    assert all(m["containment"] >= 0.95 and m["first_word"] < r["n_words"] for r in got for m in r["matches"])


def test_license_filters_lose_nothing_at_lower_thresholds(spark, licensed):
    docs = spark.createDataFrame(licensed, "doc_id long, text string")
    templates = [(str(k), t) for k, (_, t) in enumerate(licenses.TEMPLATES)]
    for threshold in ("1/2", "4/5", "1/1"):
        got = {(r["doc_id"], m["template"], m["first_word"], m["common"]) for r in licenses.scan(docs, templates, (), threshold).collect() for m in r["matches"]}
        up, down = map(int, threshold.split("/"))
        want = set()
        for i, text in licensed:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
            met = []
            for k, (_, t) in enumerate(templates):
                tokens, half = set(t.split()), max(2, 1 << (len(t.split()) - 1).bit_length())
                for at in range(0, max(len(words), 1), half):
                    held = len(tokens & set(words[at : at + 2 * half]))
                    if held * down >= up * len(tokens):
                        met.append((k, tokens, at, at + 2 * half, held))
            want |= {(i, m[0], m[2], m[4]) for m in met if not any(m[1] < o[1] and o[2] < m[3] and m[2] < o[3] for o in met)}
        assert got == want, threshold


def test_license_scan_carries_columns_and_takes_nothing(spark, nothing, licensed):
    assert licenses.scan(nothing).collect() == []
    docs = spark.createDataFrame([(i, t, {"a": 1}) for i, t in licensed[:5]], "doc_id long, text string, labels map<string,int>")
    assert licenses.scan(docs, carry=True).columns[:3] == ["doc_id", "text", "n_words"]
    assert licenses.scan(docs, templates=(), phrases=()).filter("labels <> ''").count() == 0


def test_queries_return_the_contract(spark):
    sf = "/root/testdata/sf0.001"
    made = {n: queries.queries()[n](spark, sf) for n in ("op11_fill_in_middle", "op12_phrase_collocations", "op13_license_scan")}
    assert {n: df.dtypes for n, df in made.items()} == {
        "op11_fill_in_middle": [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")],
        "op12_phrase_collocations": [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")],
        "op13_license_scan": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_base", "bigint"), ("first_word", "bigint"), ("last_word", "bigint"), ("base_labels", "string"), ("labels", "string"), ("score", "double")],
    }
