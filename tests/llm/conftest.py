import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ter", "un", "vo", "pra", "sel") for b in ("n", "ta", "ri", "s", "dom", "ek", "u", "wen")]


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def make():
    return prose


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): originals, exact and near copies, shared passages, odd and empty texts, a long one, repeated rows."""
    rng = random.Random(17)
    rows, base = [], [prose(rng, rng.randint(60, 200)) for _ in range(25)]
    passage = prose(rng, 70)
    for i, text in enumerate(base):
        rows.append((i * 10 + 3, text))
    for i in range(30):
        words = base[i % 6].split(" ")
        for _ in range(rng.choice([0, 1, 2, 4, 8])):
            words[rng.randrange(len(words))] = rng.choice(["edit", "CHANGED", "novel"]) + str(rng.randint(0, 9))
        rows.append((300 + i, " ".join(words)))
    for i in range(12):
        rows.append((500 + i, prose(rng, rng.randint(5, 60)) + "\n" + passage + "\t" + prose(rng, rng.randint(0, 40))))
    rows += [(700, None), (701, ""), (702, " \n\t "), (703, "one"), (704, "One"), (705, "two words"), (706, "a\x1cb \x0b c\x85d é日本 <|endoftext|>x  y"), (707, prose(rng, 30_000)), (708, base[0].upper())]
    rows += [(303, rows[28][1]), (800, passage), (801, passage + " " + passage)]
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with extra columns, some of names that operators use themselves."""
    rows = [(i, t, "en", "s", len(t or ""), 1, "x") for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node int, rank string").repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
