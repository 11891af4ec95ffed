"""Toxicity's work on words: the same as word by word and row by row, for all words at once."""

import pickle
import time
import zlib

import numpy as np
import pyarrow as pa

from quiver.llm import toxicity
from quiver.llm.common import words_of

ODD = [
    "", "a", "ab", "Abc", "(Hello!)", "__init__", "x_y", "--", "_", "don't", "3.14,", "naïve", "«Привет»", "ΟΔΟΣ", "ΣΑΣ.", "ΑΣ'Α",
    "İstanbul", "STRASSE", "Straße", "ǅ", "日本語。", "日本語テキスト", "ét́", "👍👍", "​zero", "½x", "x²", "a\x00b", "\x1c\x1fq\x7f",
    "é" * 3, "Ж" * 40, "w" * 64, "w" * 65, "W" * 500 + ".", "_" * 200, "é" * 300,
]


def by_word(words):
    """The buckets, a word at a time."""
    out = np.empty((len(words), 4), np.int64)
    for i, word in enumerate(words):
        word = toxicity._EDGES.sub("", word.lower())
        out[i, 0] = zlib.crc32(word.encode()) % toxicity.BUCKETS
        for k in (3, 4, 5):
            part = f"{k}:{word[:k]}" if len(word) >= k else word
            out[i, k - 2] = zlib.crc32(part.encode()) % toxicity.BUCKETS
    return out


def random_words(n, seed=1):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdeXYZ019_.,'-!éßΣσςИж中👍"))
    return ["".join(rng.choice(letters, size)) for size in rng.integers(1, 14, n)]


def test_buckets_are_those_of_single_words():
    for words in (ODD, random_words(3000), [""], ["", "..."], []):
        found = pa.array(words, pa.large_string())
        assert (toxicity._buckets(found) == by_word(words)).all()
        assert (toxicity._buckets(found[1:]) == by_word(words[1:])).all()


def test_words_are_hashed_together():
    words = [f"Word{i}s," for i in range(60_000)]
    found = pa.array(words, pa.large_string())

    def seconds(f, x):
        begin = time.process_time()
        f(x)
        return time.process_time() - begin

    assert min(seconds(toxicity._buckets, found) for _ in range(3)) < seconds(by_word, words) / 2


def test_additions_to_unpickled_arrays():
    rng = np.random.default_rng(3)
    start = rng.random((30_000, 12)).astype(np.float32)
    at, values = rng.integers(0, 50, 400), rng.random((400, 12)).astype(np.float32)
    wanted = start.copy()
    np.add.at(wanted, at, values)
    # A model reaches its task pickled.
    found = pickle.loads(pickle.dumps(start))
    toxicity._added(found, at, pickle.loads(pickle.dumps(values)))
    assert (found == wanted).all()


def test_maxima_and_counts_of_each_row():
    texts = ["a b c a", "", None, "b", "c c c b d e a", "  ", "e d"]
    vocabulary, codes, starts = words_of(pa.array(texts), lower=False)
    rng = np.random.default_rng(5)
    size = {w: (w, toxicity.DIM, toxicity.FILTERS) for w in toxicity.WIDTHS}
    model = {
        "filters": {w: rng.normal(0, 1, size[w]).astype(np.float32) for w in toxicity.WIDTHS},
        "bias": {w: rng.normal(-1, 1, toxicity.FILTERS).astype(np.float32) for w in toxicity.WIDTHS},
    }
    vectors = rng.normal(0, 1, (len(vocabulary), toxicity.DIM)).astype(np.float32)
    pooled, where = toxicity._pooled(model, codes, starts, vectors, positions=True)
    assert (pooled == toxicity._pooled(model, codes, starts, vectors)).all()
    for r in range(len(texts)):
        words = vectors[codes[starts[r]:starts[r + 1]]]
        for k, w in enumerate(toxicity.WIDTHS):
            cols = slice(k * toxicity.FILTERS, (k + 1) * toxicity.FILTERS)
            acts = [
                model["bias"][w] + sum(words[p + o] @ model["filters"][w][o] for o in range(w) if p + o < len(words))
                for p in range(len(words))
            ]
            wanted = np.maximum(np.max(acts, axis=0), 0) if acts else np.zeros(toxicity.FILTERS)
            assert np.allclose(pooled[r, cols], wanted, atol=1e-4)
            for f in np.flatnonzero(wanted > 0):
                assert where[r, cols][f] - starts[r] == np.argmax([a[f] for a in acts])

    batch = pa.RecordBatch.from_pydict({"toxic": pa.array([0, 1, 0, 1, 0, 1, 1], pa.int32()), "text": texts, "lang": ["x", "y", None, "x", "z", "x", "y"]})
    found = next(toxicity._counter(["x", "y"])(iter([batch]))).to_pylist()
    wanted = {}
    for row in batch.to_pylist():
        own = by_word(sorted(set((row["text"] or "").split()))).reshape(-1, 4)
        kinds = {int(row["toxic"]): own, **({2 + "xy".index(row["lang"]): own[:, 0]} if row["lang"] in ("x", "y") else {})}
        for kind, buckets in kinds.items():
            for b in set(buckets.reshape(-1).tolist()):
                wanted[kind, b] = wanted.get((kind, b), 0) + 1
    assert {(r["kind"], r["bucket"]): r["n"] for r in found} == wanted
