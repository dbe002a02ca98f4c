"""BPE and packing."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lexmill.llm import bpe, packing

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(2)
    bits = ["a", "b", " ", "  ", "\n", "th", "'s", "'LL", "é", "ß", "1", "42", ".", "!!", "\t", "<|endoftext|>", " the", "日本", "\x1c", "\x85", " ", "😀", "qzx", "<|"]
    return ["", " ", "a" * 700, "   x ", "trail   "] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)]


def test_encode_and_decode_as_the_library(library):
    import pyarrow as pa

    texts, encode = odd_texts(), bpe.Encoder(bpe.Vocabulary(PATH), cache_pieces=500)
    for lo, hi, ids, ptr in encode.blocks(pa.array(texts), limit=2000):
        for i in range(hi - lo):
            want = library.encode(texts[lo + i], add_special_tokens=False).ids
            assert ids[ptr[i] : ptr[i + 1]].tolist() == want == encode.encode(texts[lo + i]).tolist()
            assert encode.vocabulary.decode(want).decode() == library.decode(want, skip_special_tokens=False)
    for ids in ([200, 201, 50256, 64], [0], []):
        assert encode.vocabulary.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_exact_merging_without_tiktoken(library):
    voc = bpe.Vocabulary(PATH)
    voc._merger = None
    words = [w for t in odd_texts()[5:200] for w in t.split(" ") if w and "<|" not in w]
    ids = voc.encode_pieces([" " + w for w in words])
    assert ids == [library.encode(" " + w, add_special_tokens=False).ids for w in words]
    long = ("abcab" * 90).encode()
    assert voc.merge(long) == voc.merge_long(long)


def test_round_trip(documents, corpus, library, nothing):
    got = sorted(map(tuple, bpe.round_trip(documents, PATH).collect()))
    want = []
    for doc, text in corpus:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(nothing, PATH).count() == 0
    assert bpe.encode_column(documents, PATH).filter("doc_id = 703").first()["token_ids"] == library.encode("one").ids


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in room if r >= n]
        if fit:
            room.remove(min(fit))
        room.append((min(fit) if fit else capacity) - n)
    return len(room)


def test_pack_documents(spark, documents, corpus, library, nothing):
    rows = packing.pack_documents(spark, documents, lambda: bpe.encoder(PATH), 512).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = {}
    for doc, text in corpus:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        first = (len(ids) - 1) % 512 + 1
        cuts = [0, *range(first, len(ids) + 1, 512)]
        want.setdefault(doc, []).extend((k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    assert check_packing(rows, 512) <= best_fit([r["length"] for r in rows], 512)
    assert packing.pack_documents(spark, nothing, lambda: bpe.encoder(PATH)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 64, 300])
    counts = {rng.randint(1, capacity): rng.randint(1, 500) for _ in range(rng.randint(1, 60))}
    plan = packing.packing_plan(counts, capacity)
    rows, seen = [], {}
    for p in plan.itertuples():
        for rank in range(p.lo, p.hi):
            rows.append({"sequence_id": p.base + rank - p.lo, "offset": p.offset, "length": p.length})
            assert (p.length, rank) not in seen
            seen[p.length, rank] = 1
    assert len(seen) == sum(counts.values()) and all((length, n - 1) in seen for length, n in counts.items())
    assert check_packing(rows, capacity) <= best_fit([n for n, k in counts.items() for _ in range(k)], capacity)


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_plan_of_the_test_documents(name):
    """The one plan, with what the exact complements close, against best fit and the least possible number."""
    import glob

    import pyarrow.parquet as pq

    path = f"/root/testdata/{name}/documents.parquet"
    if not glob.glob(path):
        pytest.skip("no test data")
    lengths = []
    encode = bpe.Encoder(bpe.Vocabulary(PATH))
    for batch in pq.ParquetFile(path).iter_batches(batch_size=500, columns=["text"]):
        for _, _, _, ptr in encode.blocks(batch.column(0)):
            for n in (np.diff(ptr) + 1).tolist():
                lengths += [2048] * ((n - 1) // 2048) + [(n - 1) % 2048 + 1]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.Plan(counts, 2048)
    assert plan.sequences <= best_fit(lengths, 2048) and plan.sequences - sum(lengths) / 2048 < 2
    rows = {}
    for length, lo, hi, base, offset in plan.rows:
        for i in range(hi - lo):
            rows.setdefault(base + i, []).append(length)
    assert len(rows) == plan.sequences and sum(sum(r) == 2048 for r in rows.values()) == sum(plan.closed.values())
    assert plan.closed[2] > 0.02 * plan.sequences and plan.closed[3] > 0.05 * plan.sequences


def test_pair_sums_follow_the_counts():
    rng = random.Random(5)
    left = np.zeros(41, dtype=np.int64)
    for _ in range(25):
        left[rng.randint(1, 40)] = rng.randint(1, 3)
    sums = packing.Sums(left, 40)
    while left.any():
        for total in range(41):
            pairs = [(a, total - a) for a in range(1, 41) if a <= total and a >= total - a > 0 and left[a] >= 1 + (2 * a == total) and left[total - a]]
            assert sums.number[total] == len(pairs) and sums.pair(total) == (min(pairs) if pairs else None)
        length = int(rng.choice(np.flatnonzero(left)))
        sums.take(length, rng.randint(1, int(left[length])))


def test_pack_keeps_columns_and_refuses_bad_lengths(spark):
    df = spark.createDataFrame([(1, 5, "a", 7, "k"), (1, 5, "a", 7, "k"), (2, 3, None, 8, None)], "id int, length int, offset string, rank int, kept string")
    rows = packing.pack(df, "length", 8).collect()
    assert len(rows) == 3 and check_packing(rows, 8) == 2 and set(rows[0].asDict()) == {"id", "length", "rank", "kept", "offset", "sequence_id"}
    assert sorted(r["rank"] for r in rows) == [7, 7, 8]
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(9,)], "length int"), "length", 8)


def test_long_pieces_stay_out_of_the_cache(library):
    import pyarrow as pa

    rng = random.Random(4)
    long = ["".join(rng.choice("abcdeé日") for _ in range(n)) for n in (1025, 5000, 3000)]
    texts = [long[0], "a " + long[1] + " b", long[1] + " " + long[2] + "  x", "plain words here", long[2], "<|endoftext|>" + long[0]]
    encode = bpe.Encoder(bpe.Vocabulary(PATH), cache_bytes=200)
    for _, _, ids, ptr in encode.blocks(pa.array(texts)):
        for i, text in enumerate(texts):
            assert ids[ptr[i] : ptr[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    assert all(len(p) <= bpe.LONG_PIECE for p in encode._slot)
