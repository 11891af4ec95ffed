"""Byte-pair encoding and decoding by forced-boundary splitting.

A merge joins neighbouring bytes only inside a token of the vocabulary. So a
pair of bytes that occurs inside no token can never be joined: between them
lies a certain cut. The 65,536 pairs are tested once against the vocabulary;
a text is then cut at its pieces (the split pattern of the tokenizer) and at
every forced boundary, the fragments are encoded independently, each distinct
one once, and their ids are concatenated in text order.

A fragment's merges go by rank, then place. Long fragments use a heap over a
linked list, so one of n bytes takes n log n steps however long it is.

The special tokens of the file are found in a text first and stand for
themselves. The vocabulary file is read by the driver and broadcast (a few MB,
at most ``MAX_FILE`` bytes); texts are handled in slices and the memory of
known fragments is bounded.

Defined cases: a null text counts as empty and has no ids; texts of any length
are encoded whole; decoding bytes that are not UTF-8 gives the replacement
character, as usual; repeated rows get equal ids; an empty table gives no
rows; other columns are carried through by the caller's select.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quiver.llm.common import slices

# Fixed value: the public split pattern of byte-level vocabularies.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# First and last code points, in order, of letters and numbers that
# are newer than the tokenizers' character tables (Unicode 16), which take them
# as neither.
NEWER = """
0558-0558 058B-058C 088F-088F 0C5C-0C5C 0CDC-0CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD
A7E2-A7E2 A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9
11DF1-11DF1 1246F-1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F
2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""

MAX_FILE = 64 << 20
#: Fragments remembered between slices, and the longest one remembered.
REMEMBERED, MEMO_BYTES = 1 << 19, 64
#: Fragments of at most so many bytes are merged by scans instead of a heap.
SCANNED = 24
#: Text bytes encoded at a time.
SLICE = 2 << 20


# No merge; the part of a merge that is the new id.
_NONE, _ID = 1 << 63, (1 << 32) - 1


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files:
    itself where it is printable, else the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def allowed_pairs(tokens: list[bytes]) -> np.ndarray:
    """256 x 256 truth values: does a pair of bytes occur inside a token?"""
    inside = np.zeros((256, 256), bool)
    for token in tokens:
        codes = np.frombuffer(token, np.uint8)
        inside[codes[:-1], codes[1:]] = True
    return inside


class Vocabulary:
    """Ids, merges and certain cuts of a byte-level vocabulary file."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        byte_of = _byte_of()

        def raw(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ids = {raw(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.base = [ids[bytes([b])] for b in range(256)]
        #: Pair of ids -> rank of their merge and the id that it makes.
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges[ids[a], ids[b]] = rank << 32 | ids[a + b]
        self.inside = allowed_pairs(list(ids))
        known = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        parts = [known.get(i, b"") for i in range(max(known) + 1)]
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        names = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.memo: dict[bytes, list[int]] = {}

    def fragment(self, piece: bytes) -> list[int]:
        """Ids of one fragment: merges by rank, the leftmost first."""
        known = self.memo.get(piece)
        if known is not None:
            return known
        n = len(piece)
        ids = [self.base[b] for b in piece]
        ids = self._scanned(ids) if n <= SCANNED else self._heaped(ids)
        if n <= MEMO_BYTES:
            if len(self.memo) >= REMEMBERED:
                self.memo.clear()
            self.memo[piece] = ids
        return ids

    def _scanned(self, ids: list[int]) -> list[int]:
        """Merge a short fragment: the best pair by a scan, again and again."""
        get = self.merges.get
        found = [get(p, _NONE) for p in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == _NONE:
                break
            i = found.index(best)
            ids[i] = best & _ID
            del ids[i + 1], found[i]
            # Only the pairs next to the merged one have changed.
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), _NONE)
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), _NONE)
        return ids

    def _heaped(self, ids: list[int]) -> list[int]:
        """Merge a long fragment: a heap by rank and place over a linked list."""
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, *p) for i, p in enumerate(zip(ids, ids[1:])) if (m := get(p, _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = best & _ID, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if 0 <= left and right < n and (m := get((ids[left], ids[right]), _NONE)) != _NONE:
                    heapq.heappush(heap, (m, left, ids[left], ids[right]))
        return [k for k in ids if k >= 0]

    def pieces(self, text: str) -> list[str]:
        """The split pattern's matches, special tokens apart."""
        if self.specials is None or not self.specials.search(text):
            return split(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += split(text[at:found.start()])
            out.append(found.group())
            at = found.end()
        return out + split(text[at:])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, starts)``: the ids of text ``i`` are ``ids[starts[i]:starts[i + 1]]``."""
        number: dict[str, int] = {}
        per_text = [np.fromiter(
            (number.setdefault(p, len(number)) for p in self.pieces(t)), np.int64
        ) if t else np.empty(0, np.int64) for t in texts]
        counts, made = self._encode_pieces(list(number))
        codes = np.concatenate([*per_text, np.empty(0, np.int64)])
        ids = gather(made, np.concatenate([[0], np.cumsum(counts)])[:-1], counts, codes)
        sizes = np.array([int(counts[c].sum()) for c in per_text], np.int64)
        return ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and all the ids."""
        raw = [p.encode() for p in pieces]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        whole = b"".join(raw)
        codes = np.frombuffer(whole, np.uint8)
        # A fragment ends with its piece or before a byte that cannot follow.
        cut = np.ones(len(codes), bool)
        if len(codes):
            cut[:-1] = ~self.inside[codes[:-1], codes[1:]]
            cut[ends - 1] = True
        at = np.flatnonzero(cut) + 1
        fragment, bounds = self.fragment, [0, *at.tolist()]
        encoded = [fragment(whole[s:e]) for s, e in zip(bounds, bounds[1:])]
        sizes = np.array([len(e) for e in encoded], np.int64)
        made = np.fromiter((i for e in encoded for i in e), np.int64, count=int(sizes.sum()))
        counts = np.bincount(np.searchsorted(ends, at), weights=sizes, minlength=len(pieces)).astype(np.int64)
        special = [k for k, p in enumerate(pieces) if p in self.special]
        if special:
            # Their own id in place of the ids of their characters.
            starts = np.concatenate([[0], np.cumsum(counts)])
            keep = np.ones(len(made), bool)
            for k in special:
                made[starts[k]] = self.special[pieces[k]]
                keep[starts[k] + 1:starts[k + 1]] = False
                counts[k] = 1
            made = made[keep]
        return counts, made

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return gather(self.bytes, self.starts[:-1], self.lengths, ids).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


_newer = "".join("-".join(chr(int(end, 16)) for end in span.split("-")) for span in NEWER.split())
_is_newer = regex.compile(f"[{_newer}]").search
_plain = regex.compile(PIECES).findall
_dated = regex.compile(
    r"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[%s]]+| ?[\p{N}--[%s]]+| ?(?:[^\s\p{L}\p{N}]|[%s])+|\s+(?!\S)|\s+"
    % (_newer, _newer, _newer)
).findall


def split(text: str) -> list[str]:
    """The matches of the split pattern."""
    return _dated(text) if not text.isascii() and _is_newer(text) else _plain(text)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[c]:starts[c] + lengths[c]]`` of all ``codes``, one after the other."""
    size = lengths[codes]
    ends = np.cumsum(size)
    shift = np.repeat(starts[codes] - ends + size, size)
    return values[shift + np.arange(len(shift))]


@lru_cache(maxsize=2)
def _loaded(shared: Any) -> Vocabulary:
    return Vocabulary(shared.value)


def _shared(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        file = f.read(MAX_FILE + 1)
    if len(file) > MAX_FILE:
        raise ValueError(f"{path} has more than {MAX_FILE} bytes")
    return spark.sparkContext.broadcast(file)


def encoder(spark: SparkSession, path: str):
    """A column function ``text -> array of ids`` for the vocabulary file at ``path``."""
    shared = _shared(spark, path)

    def encode(texts: pa.Array) -> pa.Array:
        vocabulary, parts = _loaded(shared), []
        for begin, rows in slices(texts, limit=SLICE):
            ids, starts = vocabulary.encode(texts.slice(begin, rows).to_pylist())
            parts.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return F.arrow_udf(encode, "array<int>")


def decoder(spark: SparkSession, path: str):
    """A column function ``array of ids -> text`` (null: null)."""
    shared = _shared(spark, path)

    def decode(ids: pa.Array) -> pa.Array:
        vocabulary = _loaded(shared)
        return pa.array(
            [None if i is None else vocabulary.decode(np.array(i, np.int64)) for i in ids.to_pylist()], pa.string()
        )

    return F.arrow_udf(decode, "string")


def digester(spark: SparkSession, path: str):
    """A column function ``text -> struct(n_tokens, ids_sha256, decoded_sha256)``:
    encodes, decodes the ids again and returns only the digests of both."""
    shared = _shared(spark, path)

    def digests(texts: pa.Array) -> pa.Array:
        vocabulary = _loaded(shared)
        counts, of_ids, of_text = [], [], []
        for begin, rows in slices(texts, limit=SLICE):
            ids, starts = vocabulary.encode(texts.slice(begin, rows).to_pylist())
            for s, e in zip(starts[:-1], starts[1:]):
                own = ids[s:e]
                counts.append(len(own))
                of_ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(vocabulary.decode(own).encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return F.arrow_udf(digests, "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
