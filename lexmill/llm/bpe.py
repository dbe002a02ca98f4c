"""Byte-level BPE by speculation and verification.

Greedy longest match proposes the tokens of a word.  The proposal is *the* BPE encoding exactly if every token encodes
to itself and every adjacent pair is compatible, i.e. no merge across the boundary would have come before the merges
that built the two tokens.  Compatibility is checked for all distinct pairs of a batch at once with array operations;
only words with a failing pair are merged step by step.  Texts are cut at spaces that follow a non-space (always a
boundary of the pre-tokeniser), and each distinct piece is encoded once per worker while it stays in a bounded cache.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lexmill.llm.scratch import widened

# The pre-tokeniser's pattern of byte-level BPE vocabularies of this kind.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = np.int64(1) << 60
BLOCK_BYTES = 8 << 20
CACHE_PIECES = 900_000
CACHE_BYTES = 48 << 20  # of the pieces' texts; ids weigh no more than them
LONG_PIECE = 1 << 10  # longer pieces are encoded each time


def byte_letters() -> dict[str, int]:
    """Letter -> byte of the printable alphabet in which byte-level vocabularies are written."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Tokens and merges of a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        names = {name: i for name, i in spec["model"]["vocab"].items()}
        self.token = {bytes(letters[c] for c in name): i for name, i in names.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.token.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for raw, i in self.token.items():
            self.bytes_of[i] = raw
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.decimal = [str(i).encode() for i in range(size)]
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = names[a + b]
            self.merges[names[a], names[b]] = (rank, whole)
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, names[a], names[b]
        self.size = size
        keys = np.array([a * size + b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.byte_id = [self.token[bytes([b])] for b in range(256)]
        self.prefix = {raw[:k]: -1 for raw in self.token for k in range(1, len(raw))} | self.token
        pairs = np.flatnonzero(self.left >= 0)
        self.whole = np.ones(size, dtype=bool)  # tokens that encode to themselves
        self.whole[pairs] = self.compatible(self.left[pairs], self.right[pairs], top=False)
        for i in sorted(pairs, key=lambda i: self.rank[i]):
            self.whole[i] &= self.whole[self.left[i]] & self.whole[self.right[i]]
        self._known = np.zeros(0, dtype=np.int64)
        self._known_ok = np.zeros(0, dtype=bool)
        self._merger = self._ranked_merger()

    def _ranked_merger(self):
        """The merge loop of tiktoken, where ids follow the merge order; its results are verified like any proposal."""
        if any(i != self.rank[i] + 256 for i in self.token.values() if self.rank[i] >= 0):
            return None
        try:
            import tiktoken
        except ImportError:
            return None
        return tiktoken.Encoding("own", pat_str=PRETOKEN, mergeable_ranks=self.token, special_tokens={})._core_bpe.encode_single_piece

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, top: bool = True) -> np.ndarray:
        """Whether no merge crosses the boundary of tokens ``a`` and ``b``.  ``top=False`` leaves out the merge of a and b themselves."""
        ok = np.ones(len(a), dtype=bool)
        live, x, x_gone = np.arange(len(a)), a.copy(), np.full(len(a), NEVER)
        while len(live):
            sub, y, y_gone = np.arange(len(live)), b[live], np.full(len(live), NEVER)
            while len(sub):
                r = self.merge_rank(x[sub], y)
                if not top:
                    r = np.where((x[sub] == a[live[sub]]) & (y == b[live[sub]]), NEVER, r)
                hit = (r < x_gone[sub]) & (r <= y_gone) & (r < NEVER) & (r > self.rank[x[sub]]) & (r > self.rank[y])
                ok[live[sub[hit]]] = False
                go = ~hit & (self.left[y] >= 0)
                sub, y_gone, y = sub[go], self.rank[y[go]], self.left[y[go]]
            go = ok[live] & (self.right[x] >= 0)
            live, x_gone, x = live[go], self.rank[x[go]], self.right[x[go]]
        return ok

    def pairs_ok(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Compatibility of adjacent pairs; each distinct pair is worked out once while it is remembered."""
        codes, back = np.unique(a * self.size + b, return_inverse=True)
        at = np.searchsorted(self._known, codes)
        seen = np.zeros(len(codes), dtype=bool)
        inside = at < len(self._known)
        seen[inside] = self._known[at[inside]] == codes[inside]
        ok = np.zeros(len(codes), dtype=bool)
        ok[seen] = self._known_ok[at[seen]]
        new = codes[~seen]
        if len(new):
            ok[~seen] = self.compatible(new // self.size, new % self.size)
            if len(self._known) + len(new) > 4_000_000:
                self._known, self._known_ok = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
            where = np.searchsorted(self._known, new)
            self._known, self._known_ok = np.insert(self._known, where, new), np.insert(self._known_ok, where, ok[~seen])
        return ok[back]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, i, n, prefix = [], 0, len(word), self.prefix
        while i < n:
            j = end = i + 1
            best = self.byte_id[word[i]]
            while j < n:
                j += 1
                found = prefix.get(word[i:j])
                if found is None:
                    break
                if found >= 0:
                    best, end = found, j
            out.append(best)
            i = end
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging, lowest rank first."""
        parts = [self.byte_id[b] for b in word]
        merges = self.merges
        while len(parts) > 1:
            best = min(((merges[p][0], p) for p in zip(parts, parts[1:]) if p in merges), default=None)
            if best is None:
                break
            pair, out, i = best[1], [], 0
            whole = merges[pair][1]
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(whole)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        out = [self.propose(w) for w in words]
        bad = self._failing(out)
        if self._merger is not None:
            for i in bad:
                out[i] = self._merger(words[i])
            bad = bad[self._failing([out[i] for i in bad])]
        for i in bad:
            out[i] = self.merge_long(words[i]) if len(words[i]) > 200 else self.merge(words[i])
        return out

    def _failing(self, out: list[list[int]]) -> np.ndarray:
        """Which of the token lists aren't exact encodings."""
        lens = np.fromiter(map(len, out), dtype=np.int64, count=len(out))
        flat = np.fromiter((i for ids in out for i in ids), dtype=np.int64, count=int(lens.sum()))
        row = np.repeat(np.arange(len(out)), lens)
        bad = np.zeros(len(out), dtype=bool)
        bad[row[~self.whole[flat]]] = True
        inner = row[1:] == row[:-1]
        at = np.flatnonzero(inner)
        bad[row[at[~self.pairs_ok(flat[at], flat[at + 1])]]] = True
        return np.flatnonzero(bad)

    def merge_long(self, word: bytes) -> list[int]:
        """Exact merging of a long word with a heap, so that time stays near linear."""
        import heapq

        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.merges[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or (ids[i], ids[j]) != p:
                continue
            ids[i], ids[j] = self.merges[p][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (q := (ids[a], ids[after[a]])) in self.merges:
                    heapq.heappush(heap, (self.merges[q][0], a, q))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces of text that end at pre-token boundaries."""
        collecting = gc.isenabled()
        gc.disable()  # millions of small lists without cycles
        try:
            return self._encode_pieces(pieces)
        finally:
            if collecting:
                gc.enable()

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        find = regex.compile(PRETOKEN).findall
        index: dict[str, int] = {}
        spans: list[list[int] | int] = []
        for piece in pieces:
            body = piece[1:] if piece[:1] == " " else piece
            if body.isalpha():
                spans.append(index.setdefault(piece, len(index)))
            elif piece[-1:] in (",", ".") and body[:-1].isalpha():
                spans.append([index.setdefault(piece[:-1], len(index)), index.setdefault(piece[-1], len(index))])
            else:
                spans.append([index.setdefault(t, len(index)) for t in find(piece)])
        ids = self.encode_words([w.encode() for w in index])
        return [ids[s] if isinstance(s, int) else [i for k in s for i in ids[k]] for s in spans]

    def decode(self, ids: list[int]) -> bytes:
        """The text of ``ids`` in UTF-8, special tokens included; invalid sequences become U+FFFD."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        try:
            raw.decode("utf-8")
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", errors="replace").encode()


class Encoder:
    """Encodes string columns through a cache of pieces, bounded in number and bytes.

    A piece without blanks may be a whole text; those of more than ``LONG_PIECE`` characters never enter the cache.
    """

    def __init__(self, vocabulary: Vocabulary, cache_pieces: int = CACHE_PIECES, cache_bytes: int = CACHE_BYTES):
        self.vocabulary, self.cache_pieces, self.cache_bytes = vocabulary, cache_pieces, cache_bytes
        self._special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self._cut = re.compile(r"(?<=\S) ")
        self._clear()

    def _clear(self) -> None:
        self._slot: dict[str, int] = {}
        self._held = 0
        self._flat, self._n_flat = np.zeros(1 << 16, dtype=np.uint32), 0
        self._off = np.zeros(1 << 14, dtype=np.int64)

    def forget(self) -> None:
        """Drop what was remembered of texts; the vocabulary stays."""
        self._clear()
        self.vocabulary._known, self.vocabulary._known_ok = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)

    def _full(self) -> bool:
        return len(self._slot) > self.cache_pieces or self._held > self.cache_bytes

    def _slots(self, pieces: list[str]) -> np.ndarray:
        got = list(map(self._slot.get, pieces))
        if None in got:
            missing = list(dict.fromkeys(p for p, s in zip(pieces, got) if s is None))
            for at in range(0, len(missing), 50_000):
                part = missing[at : at + 50_000]
                ids = self.vocabulary.encode_pieces(part)
                flat = np.fromiter((i for x in ids for i in x), dtype=np.uint32)
                n, need = len(self._slot), self._n_flat + len(flat)
                while need > len(self._flat):
                    self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
                while n + len(part) + 1 > len(self._off):
                    self._off = np.concatenate([self._off, np.zeros_like(self._off)])
                self._flat[self._n_flat : need] = flat
                self._off[n + 1 : n + len(part) + 1] = self._n_flat + np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
                self._n_flat = need
                self._held += sum(map(len, part))
                self._slot.update(zip(part, range(n, n + len(part))))
            got = list(map(self._slot.get, pieces))
        return np.array(got, dtype=np.int64)

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = self._off[slots + 1] - self._off[slots]
        ends = np.cumsum(lens)
        n = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self._off[slots] - (ends - lens), lens) + np.arange(n)
        return self._flat[at], lens

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text of any length, in segments."""
        parts = self._special.split(text) if self._special else [text]
        out = []
        for part in parts:
            if part in self.vocabulary.special:
                out.append(np.array([self.vocabulary.special[part]], dtype=np.uint32))
                continue
            cuts = [0, *(m.start() for m in self._cut.finditer(part)), len(part)]
            for at in range(0, len(cuts) - 1, 1_000_000):
                own = cuts[at : at + 1_000_001]
                out += self._segment([part[a:b] for a, b in zip(own, own[1:]) if b > a])
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)

    def _segment(self, pieces: list[str]) -> Iterator[np.ndarray]:
        """Ids of consecutive pieces: short ones through the cache, long ones directly."""
        short: list[str] = []
        for piece in [*pieces, None]:
            if piece is not None and len(piece) <= LONG_PIECE:
                short.append(piece)
                continue
            if short:
                if self._full():
                    self._clear()
                yield self._gather(self._slots(short))[0]
                short = []
            if piece is not None:
                yield np.array(self.vocabulary.encode_pieces([piece])[0], dtype=np.uint32)

    def _fast(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        ptr = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        ptr -= ptr[0]
        pieces, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        odd = np.array([not p or p[-1].isspace() or len(p) > LONG_PIECE for p in pieces], dtype=bool)
        special = np.array([any(s in p for s in self.vocabulary.special) for p in pieces], dtype=bool) if any("<" in p for p in pieces) else np.zeros(len(pieces), dtype=bool)
        first, last = ptr[:-1], ptr[1:] - 1
        long = np.array([len(p) > LONG_PIECE for p in pieces], dtype=bool)
        if long.any():  # their texts are slow, so what stands in for them doesn't count
            pieces = ["" if far else p for p, far in zip(pieces, long)]
        flag = odd[index]
        flag[last] = long[index[last]]
        flag |= special[index]
        slow = np.add.reduceat(flag, first) > 0
        if self._special is not None and any(" " in s for s in self.vocabulary.special):
            slow[:] = True
        slots = self._slots([" " + p for p in pieces])[index]
        heads = [pieces[i] for i in index[first]]
        slots[first] = self._slots(heads)
        ids, lens = self._gather(slots)
        counts = np.add.reduceat(lens, first)
        if not slow.any():
            return ids, np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(counts)
        parts = [self.encode(texts[i].as_py()) if slow[i] else ids[ends[i] - counts[i] : ends[i]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def blocks(self, column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row, ids, ptr) for blocks of rows; row i of a block has ids[ptr[i]:ptr[i+1]].  Nulls are empty."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.fill_null("")
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lo = 0
        while lo < len(column):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
            if self._full():
                self._clear()
            if hi == lo + 1 and sizes[lo] > limit:
                ids = self.encode(column[lo].as_py())
                yield lo, hi, ids, np.array([0, len(ids)])
            else:
                ids, ptr = self._fast(column.slice(lo, hi - lo))
                yield lo, hi, ids, ptr
            lo = hi


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker for the vocabulary file at ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(Vocabulary(path))
    return _encoders[path]


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document: encoded, then decoded from the ids alone.

    Null and empty texts have no tokens.  Repeated rows are rows of their own; other columns play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        voc = encode.vocabulary
        for batch in batches:
            for lo, hi, ids, ptr in encode.blocks(batch.column(1)):
                hashes, decoded = [], []
                for a, b in zip(ptr, ptr[1:]):
                    own = ids[a:b].tolist()
                    hashes.append(hashlib.sha256(b",".join(map(voc.decimal.__getitem__, own))).hexdigest())
                    decoded.append(hashlib.sha256(voc.decode(own)).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(ptr), pa.int64()), pa.array(hashes), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    key = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_column(documents: DataFrame, path: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """``documents`` with an array of token ids added (an existing column of that name is replaced)."""
    base = documents.drop(out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for lo, hi, ids, ptr in encode.blocks(batch.column(batch.schema.names.index(text_col))):
                part = batch.slice(lo, hi - lo)
                lists = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, out_col])

    return base.mapInArrow(run, widened(base.schema, (out_col, "array<int>")))
