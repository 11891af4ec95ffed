"""Language identification by hierarchical discrimination.

First the language family is predicted, then, inside it, one-versus-one
linear support vector machines separate the related languages (by votes,
ties by summed margins). Features are hashed character n-grams (1 to 4, with
word boundaries) and whole words, as shares of all features of the text, so
a text's margin is the mean over its words of per-word margins: those are
computed once per distinct word of a batch, for all its words together.

Training runs in one task on a bounded sample: about ``PER_LANG`` whole texts
of each language, the ones with the smallest hashes of ``doc_id``, and no more
texts of a language once ``TRAIN_BYTES`` bytes of it are read (its first text
is always learnt, however long). More than ``MAX_LANGS`` languages are an
error.

Defined cases: a null text or one without a letter is ``und`` with score 0;
languages without a known family form one of their own; with no labelled
row everything is ``und``; a null ``doc_id`` may be learnt from; repeated rows
get equal answers.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import drawn, released, segment_ids, slices, within_bytes, words_of

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "tk", "tt", "ug", "uz"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "semitic": ["am", "ar", "he", "mt"],
    "austronesian": ["id", "jv", "ms", "su", "tl"],
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

BUCKETS = 1 << 13
PER_LANG = 500
TRAIN_BYTES = 16 << 20
MAX_LANGS = 200
STEPS, PENALTY = 150, 1e-3
UNKNOWN = "und"


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang.split("-")[0].lower(), lang)


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    """For every code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, count=0x110000)


def _features(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, starts, letters)``: the hash buckets of word ``i``'s
    n-grams and of the word itself are ``buckets[starts[i]:starts[i + 1]]``;
    ``letters`` tells whether it has one."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, bool)
    lower = pc.utf8_lower(vocabulary.cast(pa.large_string()))
    edges = [pa.scalar(c, pa.large_string()) for c in ("<", ">", "")]
    words = pc.binary_join_element_wise(edges[0], lower, *edges[1:])
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.asarray(pc.utf8_length(words), dtype=np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(points))
    buckets, owners = [], []
    with np.errstate(over="ignore"):
        grams = np.zeros(len(points), np.uint64)
        for n in range(1, 5):
            following = np.zeros(len(points), np.uint64)
            following[:max(0, len(points) - n + 1)] = points[n - 1:]
            grams = (grams + following + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
            whole = left >= n
            buckets.append((grams[whole] >> np.uint64(51)).astype(np.int64))
            owners.append(owner[whole])
        # The whole word: its characters weighted by powers of their place.
        place = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
        weight = np.uint64(0xD6E8FEB86659FD93) ** place.astype(np.uint64)
        own = np.add.reduceat(points * weight, ends - sizes)
        own = (own ^ (own >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((own >> np.uint64(51)).astype(np.int64))
        owners.append(np.arange(len(sizes)))
    order = np.argsort(np.concatenate(owners), kind="stable")
    counts = np.bincount(np.concatenate(owners), minlength=len(sizes))
    letters = np.zeros(len(sizes), bool)
    letters[owner[_is_letter()[points.astype(np.int64)]]] = True
    return np.concatenate(buckets)[order], np.concatenate([[0], np.cumsum(counts)]), letters


def _svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear SVM (squared hinge, L2 penalty) by accelerated gradient; the
    last weight is the bias. ``y`` is -1 or 1; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    rate = 1.0 / (2 * float((weight * (x * x).sum(axis=1)).sum()) + PENALTY)
    w = np.zeros(x.shape[1], x.dtype)
    look = w.copy()
    for t in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ look))
        grad = -2 * x.T @ (weight * slack * y) + PENALTY * look
        new = look - rate * grad
        look = new + t / (t + 3) * (new - w)
        w = new
    return w


def train(texts: pa.Array, langs: list[str]) -> dict:
    vocabulary, codes, starts = words_of(texts, lower=False)
    buckets, at, _ = _features(vocabulary)
    x = np.zeros((len(langs), BUCKETS), np.float32)
    for r in range(len(langs)):
        words, times = np.unique(codes[starts[r]:starts[r + 1]], return_counts=True)
        if len(words):
            size = at[words + 1] - at[words]
            own = np.arange(size.sum()) + np.repeat(at[words] - np.cumsum(size) + size, size)
            x[r] = np.bincount(buckets[own], weights=np.repeat(times, size), minlength=BUCKETS)
            x[r] /= x[r].sum()
    # Features are scaled to unit spread; the scale is folded into the weights.
    scale = 1 / (x.std(axis=0) + 1e-4)
    x *= scale
    names = np.array(langs)
    families = np.array([family(v) for v in langs])

    def pairwise(labels: np.ndarray, rows: np.ndarray) -> list[tuple[str, str, int]]:
        out = []
        for a, b in combinations(sorted(set(labels[rows].tolist())), 2):
            at = rows & ((labels == a) | (labels == b))
            w = _svm(x[at], np.where(labels[at] == a, 1, -1).astype(np.float32))
            weights.append(np.append(w[:-1] * scale, w[-1]))
            out.append((a, b, len(weights) - 1))
        return out

    weights: list[np.ndarray] = []
    every = np.ones(len(langs), bool)
    model = {"family": (sorted(set(families.tolist())), pairwise(families, every)), "inside": {}}
    for f in model["family"][0]:
        own = families == f
        model["inside"][f] = (sorted(set(names[own].tolist())), pairwise(names, own))
    model["weights"] = np.array(weights).T if weights else np.zeros((BUCKETS + 1, 0))
    return model


def _decide(classes: list[str], pairs: list[tuple[str, str, int]], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winner of the one-versus-one votes and its confidence, per row."""
    rows = len(margins)
    if len(classes) == 1:
        return np.zeros(rows, np.int64), np.ones(rows)
    votes = np.zeros((rows, len(classes)))
    sums = np.zeros((rows, len(classes)))
    for a, b, k in pairs:
        i, j = classes.index(a), classes.index(b)
        m = margins[:, k]
        votes[:, i] += m >= 0
        votes[:, j] += m < 0
        sums[:, i] += np.tanh(m)
        sums[:, j] -= np.tanh(m)
    winner = (votes + sums / (10 * len(classes))).argmax(axis=1)
    least = np.full(rows, np.inf)
    for a, b, k in pairs:
        i, j = classes.index(a), classes.index(b)
        least = np.where(winner == i, np.minimum(least, margins[:, k]), least)
        least = np.where(winner == j, np.minimum(least, -margins[:, k]), least)
    return winner, 1 / (1 + np.exp(-np.clip(3 * least, -30, 30)))


def identify(model: dict, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    rows = len(texts)
    out, score = np.full(rows, UNKNOWN, dtype=object), np.zeros(rows)
    if not model:
        return out.tolist(), score
    vocabulary, codes, starts = words_of(texts, lower=False)
    weights = model["weights"]
    buckets, at, letters = _features(vocabulary)
    counts = np.diff(at)
    per_word = np.zeros((len(counts), weights.shape[1]))
    if len(counts):
        for k in range(weights.shape[1]):
            per_word[:, k] = np.add.reduceat(weights[buckets, k], at[:-1])
    owner = segment_ids(starts)
    total = np.maximum(1, np.bincount(owner, weights=counts[codes], minlength=rows))
    margins = np.stack(
        [np.bincount(owner, weights=per_word[codes, k], minlength=rows) / total + weights[-1, k]
         for k in range(weights.shape[1])], axis=1,
    ) if weights.shape[1] else np.zeros((rows, 0))
    known = np.bincount(owner, weights=letters[codes], minlength=rows) > 0
    families, sure = _decide(*model["family"], margins)
    for f, name in enumerate(model["family"][0]):
        at = np.flatnonzero(known & (families == f))
        if len(at):
            classes, _ = model["inside"][name]
            lang, inner = _decide(*model["inside"][name], margins[at])
            out[at] = [classes[k] for k in lang]
            score[at] = sure[at] * inner
    return out.tolist(), score


def _trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = within_bytes(batches, "lang", TRAIN_BYTES)
    if table.num_rows:
        model = train(table.column("text").combine_chunks(), table.column("lang").to_pylist())
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})


def fit(docs: DataFrame, learn: Column | None = None) -> dict:
    """Train on the texts and non-null ``lang`` of ``docs``; ``learn`` limits
    the rows that may be learnt from."""
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    if learn is not None:
        usable = usable.where(learn)
    usable = usable.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not sizes:
        return {}
    sample = drawn(usable, "lang", {r["lang"]: r["n"] for r in sizes}, PER_LANG, seed=5)
    sample = sample.repartition(1).sortWithinPartitions("_mark", "lang", "text")
    row = sample.mapInArrow(_trainer, "model binary").first()
    return pickle.loads(row["model"]) if row else {}


def identifier(spark, model: dict):
    """A column function ``text -> struct(lang, score)``."""
    shared = spark.sparkContext.broadcast(model)

    def answer(texts: pa.Array) -> pa.Array:
        langs: list[str] = []
        scores: list[float] = []
        for part in slices(texts):
            more, sure = identify(shared.value, texts.slice(*part))
            langs += more
            scores += sure.tolist()
        released()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return F.arrow_udf(answer, "struct<lang: string, score: double>")
