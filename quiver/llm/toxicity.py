"""Toxicity: a convolutional text classifier, trained in numpy.

Words are lower-cased and freed of surrounding punctuation. A word's vector
is the mean of hashed embeddings of the word and its prefixes of 3 to 5
letters, so inflected forms share weight. Filters of several widths run over
the word vectors of the whole text; their maxima over the text feed a
logistic output. Embeddings start from the smoothed log-odds of each hash
bucket in the training rows (first dimension; the others at random), then
everything is trained by Adagrad.

Thresholds are calibrated per language: a quarter of the rows, by a hash of
``doc_id`` and text, is set aside, the language of a text is guessed from its
words alone (naive Bayes over the same hash buckets), and for each guessed
language the probability that best separates the labels is mapped to a score
of 0.7.

Every labelled row that may be learnt from is used, with its whole text:

1. The document frequencies of the buckets, per class and per language, are
   summed over all tasks: at most ``BUCKETS`` rows per class and language.
2. The rows are dealt to shards of about ``SHARD_ROWS`` rows. Each shard trains
   the model that starts from these counts on all its rows, at most
   ``TRAIN_BYTES`` bytes of text at a time, and the trained models are averaged in
   a tree of tasks, an embedding over the shards that have changed it.
3. The rows set aside are scored, and counted by guessed language, label and
   step of the logit; the thresholds come from these counts.

Only the averaged model and the counts (a few MB, whatever the input) reach the
driver. With more than ``MAX_LANGS`` languages among the labelled rows there is
one threshold for all of them.

Defined cases: null and empty texts are scored as a text without words;
repeated rows get equal scores; without labels of both classes every score
is 0; columns are taken by name, others are ignored.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import released, segment_ids, slices, staged, unstaged, words_of

BUCKETS, DIM = 1 << 15, 12
WIDTHS, FILTERS = (1, 2, 3), 8
SHARD_ROWS = 4000
TRAIN_BYTES = 4 << 20
EPOCHS, RATE = 5, 0.05
# Models that a task averages; languages with a threshold of their own; steps
# of the logit in a unit, for the thresholds.
FAN_IN, MAX_LANGS, STEPS = 16, 64, 256
CUT = 0.7
CHUNK = 1 << 16

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_ASCII_EDGES = "".join(c for c in map(chr, range(128)) if not c.isalnum())
# CRC-32 of each byte; words of more bytes are hashed one by one.
_CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC_TABLE = np.where(_CRC_TABLE & 1, (_CRC_TABLE >> 1) ^ np.uint32(0xEDB88320), _CRC_TABLE >> 1)
LONG_WORD = 64


def _bare(vocabulary: pa.Array) -> pa.Array:
    """The words lower-cased and freed of surrounding punctuation."""
    other = pc.invert(pc.string_is_ascii(vocabulary))
    bare = pc.ascii_trim(pc.ascii_lower(vocabulary), characters=_ASCII_EDGES)
    lowered = [word.lower() for word in vocabulary.filter(other).to_pylist()]
    if not lowered:
        return bare
    return pc.replace_with_mask(bare, other, pa.array([w if w.isalnum() else _EDGES.sub("", w) for w in lowered], bare.type))


def _crc32(words: pa.Array, prefix: bytes = b"") -> np.ndarray:
    """``zlib.crc32(prefix + word)`` of large strings, taken a byte of all words at a time."""
    start = zlib.crc32(prefix)
    out = np.full(len(words), start, np.uint32)
    sizes = np.asarray(pc.binary_length(words), np.int64)
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = zlib.crc32(words[i].as_py().encode(), start)
    order = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))
    if not len(order):
        return out
    # Longest first: the words that have a byte left are always the first ones.
    order = order[np.argsort(-sizes[order], kind="stable")]
    offsets, data = (np.frombuffer(b, t) for b, t in zip(words.buffers()[1:], (np.int64, np.uint8)))
    begins = offsets[words.offset:][order]
    left = np.searchsorted(-sizes[order], -np.arange(sizes[order[0]]), side="left")
    state = np.full(len(order), ~np.uint32(start))
    for at, n in enumerate(left):
        state[:n] = _CRC_TABLE[(state[:n] ^ data[begins[:n] + at]) & 0xFF] ^ (state[:n] >> 8)
    out[order] = ~state
    return out


def _buckets(vocabulary: pa.Array) -> np.ndarray:
    """Four hash buckets per word: the word and its prefixes of 3, 4, 5 letters."""
    words = _bare(vocabulary)
    letters = np.asarray(pc.utf8_length(words), np.int64)
    out = np.empty((len(words), 4), np.int64)
    out[:, 0] = _crc32(words) % BUCKETS
    for k in (3, 4, 5):
        part = _crc32(pc.utf8_slice_codeunits(words, 0, k), f"{k}:".encode()) % BUCKETS
        out[:, k - 2] = np.where(letters >= k, part, out[:, 0])
    return out


def _vectors(embeddings: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Mean of the four embeddings of each word."""
    total = embeddings.take(buckets[:, 0], axis=0)
    for k in (1, 2, 3):
        total += embeddings.take(buckets[:, k], axis=0)
    total /= 4
    return total


def _added(param: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """``np.add.at(param, at, values)`` on rows of a contiguous float32 array,
    by one index a number. Unpickled arrays have a type object of their own,
    with which numpy takes its slow path: a view has the common one."""
    width = param.shape[1]
    index = (at[:, None] * width + np.arange(width)).reshape(-1)
    np.add.at(param.reshape(-1).view(np.float32), index, values.reshape(-1).view(np.float32))


def _pooled(model: dict, codes: np.ndarray, starts: np.ndarray, vectors: np.ndarray, positions: bool = False):
    """Maxima of every filter over each row's words (and where they lie)."""
    rows = len(starts) - 1
    pooled = np.zeros((rows, len(WIDTHS) * FILTERS), np.float32)
    where = np.zeros(pooled.shape, np.int64)
    tables = {w: [vectors @ model["filters"][w][o] for o in range(w)] for w in WIDTHS}
    row = 0
    while row < rows:
        # Whole rows up to about CHUNK words at a time.
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + CHUNK, side="right")) - 1)
        end = min(end, rows)
        lo, hi = starts[row], starts[end]
        full = np.flatnonzero(np.diff(starts[row:end + 1])) + row
        if len(full):
            here = codes[lo:hi]
            owner = segment_ids(starts[row:end + 1])
            for at, w in enumerate(WIDTHS):
                act = tables[w][0].take(here, axis=0)
                act += model["bias"][w]
                for o in range(1, w):
                    more = tables[w][o].take(here[o:], axis=0)
                    # A window ends with its row.
                    more[owner[o:] != owner[:-o]] = 0
                    act[:-o] += more
                cols = slice(at * FILTERS, (at + 1) * FILTERS)
                if positions:
                    # A filter's values side by side; a maximum below 0 moves nothing.
                    act = np.ascontiguousarray(act.T)
                    for r in full:
                        s, e = starts[r] - lo, starts[r + 1] - lo
                        best = act[:, s:e].argmax(axis=1)
                        where[r, cols] = best + starts[r]
                        pooled[r, cols] = act[np.arange(FILTERS), best + s]
                else:
                    pooled[full, cols] = np.maximum.reduceat(act, starts[full] - lo)
        row = end
    np.maximum(pooled, 0, out=pooled)
    return (pooled, where) if positions else pooled


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _guess(model: dict, buckets: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of each row's likeliest language, from its words."""
    table = model["lang_words"]
    rows = len(starts) - 1
    if len(model["langs"]) < 2 or len(codes) == 0:
        return np.zeros(rows, np.int64)
    owner = segment_ids(starts)
    total = np.stack([np.bincount(owner, weights=t[buckets[:, 0]][codes], minlength=rows) for t in table], axis=1)
    return total.argmax(axis=1)


def _calibrated(p: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Monotone map of probabilities that sends ``cut`` to ``CUT``."""
    low = p / np.maximum(cut, 1e-9) * CUT
    high = CUT + (p - cut) / np.maximum(1 - cut, 1e-9) * (1 - CUT)
    return np.clip(np.where(p < cut, low, high), 0, 1)


def _probabilities(model: dict, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Probability of the toxic class and guessed language of each text."""
    vocabulary, codes, starts = words_of(texts, lower=False)
    buckets = _buckets(vocabulary)
    pooled = _pooled(model, codes, starts, _vectors(model["embeddings"], buckets))
    return _sigmoid(pooled @ model["out"] + model["out_bias"]), _guess(model, buckets, codes, starts)


def score_texts(model: dict, texts: pa.Array) -> np.ndarray:
    if not model:
        return np.zeros(len(texts))
    p, guess = _probabilities(model, texts)
    return _calibrated(p, model["cuts"][guess])


def _logit(p: np.ndarray) -> np.ndarray:
    """Step of the logit that a probability falls into."""
    p = np.clip(np.asarray(p, np.float64), 1e-13, 1 - 1e-13)
    return np.floor(np.log(p / (1 - p)) * STEPS).astype(np.int64)


def _best_cut(counted: dict[int, list[int]]) -> float:
    """The middle of the gap at which the most labels agree. ``counted``:
    rows of label 0 and of label 1 by step of the logit."""
    steps = np.array(sorted(counted))
    n = np.array([counted[s] for s in steps.tolist()])
    # Rows below a cut count as 0, the others as 1.
    right = np.concatenate([[0], np.cumsum(n[:, 0])]) + np.concatenate([np.cumsum(n[::-1, 1])[::-1], [0]])
    ends = np.concatenate([[0.0], _sigmoid((steps + 1) / STEPS)])
    begins = np.concatenate([_sigmoid(steps / STEPS), [1.0]])
    best = np.flatnonzero(right == right.max())
    k = best[(begins - ends)[best].argmax()]
    return float(np.clip((begins[k] + ends[k]) / 2, 0.02, 0.98))


def _counter(names: list[str]):
    """Document frequencies of a task's rows: ``(kind, bucket, n)``; kinds 0
    and 1 are the classes, 2 and above the languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2 + len(names), BUCKETS), np.int64)
        place = {name: 2 + k for k, name in enumerate(names)}
        for batch in batches:
            for part in slices(batch.column("text"), limit=TRAIN_BYTES):
                rows = batch.slice(*part)
                vocabulary, codes, starts = words_of(rows.column("text"), lower=False)
                buckets = _buckets(vocabulary)
                labels, langs = rows.column("toxic").to_pylist(), rows.column("lang").to_pylist()
                for r in range(rows.num_rows):
                    own = codes[starts[r]:starts[r + 1]]
                    # A bucket that repeats is raised by one all the same.
                    own = buckets[own if len(own) <= len(buckets) else np.unique(own)]
                    n[int(labels[r])][own.reshape(-1)] += 1
                    if langs[r] in place:
                        n[place[langs[r]]][own[:, 0]] += 1
        kind, bucket = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({"kind": kind.astype(np.int32), "bucket": bucket.astype(np.int32), "n": n[kind, bucket]})
        released()

    return count


def _initial(counts: dict[int, np.ndarray], n: np.ndarray, names: list[str], seed: int = 7) -> dict:
    """The model before training, from the counts of all rows."""
    rng = np.random.default_rng(seed)
    none = np.zeros(BUCKETS)
    seen = np.stack([counts.get(0, none), counts.get(1, none)])
    words = np.stack([counts.get(2 + k, none) for k in range(len(names))]) if names else np.zeros((1, BUCKETS))
    n = n + 1.0
    odds = np.log((seen[1] + 0.5) / n[1]) - np.log((seen[0] + 0.5) / n[0])
    trust = np.minimum(1, seen.sum(axis=0) / 8)
    model = {
        "embeddings": rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32),
        "filters": {w: rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS},
        "bias": {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
        "out": np.full(len(WIDTHS) * FILTERS, 0.1, np.float32),
        "out_bias": np.float32(-1.0),
        "langs": names or ["und"],
        "lang_words": np.log((words + 0.1) / (words.sum(axis=1, keepdims=True) + 0.1 * BUCKETS)),
    }
    model["embeddings"][:, 0] = np.clip(odds * trust, -4, 4) / 2
    for w in WIDTHS:
        model["filters"][w][:, 0, :] += 0.5 / w
    return model


def train(model: dict, grads: dict, texts: pa.Array, labels: np.ndarray, rng: np.random.Generator) -> None:
    """Train ``model`` in place on all rows of a chunk; ``grads`` are the sums
    of squared gradients so far."""
    vocabulary, codes, starts = words_of(texts, lower=False)
    buckets = _buckets(vocabulary)
    fit = np.arange(len(labels))

    def step(name, param, grad, at=None):
        if name not in grads:
            grads[name] = np.zeros_like(param)
        cache = grads[name]
        if at is None:
            cache += grad * grad
            param -= RATE * grad / (np.sqrt(cache) + 1e-6)
        else:
            _added(cache, at, grad * grad)
            _added(param, at, -RATE * grad / (np.sqrt(cache[at]) + 1e-6))

    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for begin in range(0, len(fit), 50):
            batch = fit[begin:begin + 50]
            local = np.concatenate([codes[starts[r]:starts[r + 1]] for r in batch])
            # The chunk's words that the batch holds, and their places among them.
            held = np.zeros(len(buckets), bool)
            held[local] = True
            own = np.flatnonzero(held)
            local = (np.cumsum(held) - 1)[local]
            at = np.concatenate([[0], np.cumsum([starts[r + 1] - starts[r] for r in batch])])
            vectors = _vectors(model["embeddings"], buckets[own])
            pooled, where = _pooled(model, local, at, vectors, positions=True)
            error = (_sigmoid(pooled @ model["out"] + model["out_bias"]) - labels[batch]) / len(batch)
            d_pooled = np.outer(error, model["out"]) * (pooled > 0)
            step("out", model["out"], (pooled.T @ error).astype(np.float32))
            model["out_bias"] -= np.float32(RATE * error.sum())
            for k, w in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                d, pos = d_pooled[:, cols].astype(np.float32), where[:, cols]
                ends = at[1:, None]
                d_filter = np.zeros((w, FILTERS, DIM), np.float32)
                for o in range(w):
                    inside = (pos + o < ends) & (d != 0)
                    r, f = np.nonzero(inside)
                    if not len(r):
                        continue
                    word = local[pos[r, f] + o]
                    g = d[r, f][:, None]
                    _added(d_filter[o], f, g * vectors[word])
                    grad = g * model["filters"][w][o][:, f].T / 4
                    for c in range(4):
                        step("embeddings", model["embeddings"], grad, buckets[own[word], c])
                step(f"filters{w}", model["filters"][w], d_filter.transpose(0, 2, 1))
                step(f"bias{w}", model["bias"][w], d.sum(axis=0))


def _params(model: dict) -> dict[str, np.ndarray]:
    """The dense parameters by name."""
    named = {"out": model["out"]}
    for w in WIDTHS:
        named[f"filters{w}"], named[f"bias{w}"] = model["filters"][w], model["bias"][w]
    return named


def _trainer(shared):
    """Trains a shard: ``model`` is the sum of changes and their weights."""

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        model, grads, rows, rng = pickle.loads(pickle.dumps(start)), {}, 0, np.random.default_rng(7)
        held: list[pa.RecordBatch] = []
        size = 0

        def learn():
            chunk = pa.Table.from_batches(held).combine_chunks()
            train(model, grads, chunk.column("text").combine_chunks(), np.asarray(chunk.column("toxic"), np.float64), rng)
            return chunk.num_rows

        for batch in batches:
            for begin, n in slices(batch.column("text"), limit=TRAIN_BYTES):
                part = batch.slice(begin, n)
                held.append(part)
                size += part.column("text").nbytes
                if size >= TRAIN_BYTES:
                    rows += learn()
                    held, size = [], 0
        if held:
            rows += learn()
        if rows:
            moved = (grads["embeddings"].sum(axis=1, keepdims=True) > 0) if "embeddings" in grads else np.zeros((BUCKETS, 1), bool)
            change = {
                "rows": rows, "moved": (moved * rows).astype(np.float64), "out_bias": rows * float(model["out_bias"] - start["out_bias"]),
                "embeddings": rows * (model["embeddings"] - start["embeddings"]),
                **{k: rows * (v - _params(start)[k]) for k, v in _params(model).items()},
            }
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(change)], pa.binary())})
        released()

    return trained


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sum of the changes of a task's models."""
    total: dict = {}
    for batch in batches:
        for blob in batch.column("model"):
            change = pickle.loads(blob.as_py())
            total = {k: total[k] + v for k, v in change.items()} if total else change
    if total:
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(total)], pa.binary())})
    released()


def _averaged(model: dict, total: dict) -> dict:
    """``model`` with the mean of the changes."""
    rows = total["rows"]
    model["embeddings"] += (total["embeddings"] / np.maximum(total["moved"], 1)).astype(np.float32)
    model["out_bias"] += np.float32(total["out_bias"] / rows)
    for k, v in _params(model).items():
        v += (total[k] / rows).astype(np.float32)
    return model


def _judge(shared):
    """``(guess, toxic, step, n)`` of a task's rows."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch.column("text")):
                rows = batch.slice(*part)
                p, guess = _probabilities(model, rows.column("text"))
                yield pa.RecordBatch.from_pydict({
                    "guess": guess.astype(np.int32), "toxic": np.asarray(rows.column("toxic"), np.int32), "step": _logit(p),
                })
        released()

    return judged


def _cuts(counts: list, langs: int) -> np.ndarray:
    """Threshold of each guessed language, from ``(guess, toxic, step, n)``."""
    per: dict[int, dict[int, list[int]]] = {k: {} for k in range(-1, langs)}
    for r in counts:
        # -1: all languages together.
        for k in (-1, r["guess"]):
            per[k].setdefault(r["step"], [0, 0])[r["toxic"]] += r["n"]

    def rows(counted):
        return [sum(n[label] for n in counted.values()) for label in (0, 1)]

    overall = _best_cut(per[-1]) if per[-1] else 0.5
    enough = [min(rows(per[k])) > 0 and sum(rows(per[k])) >= 30 for k in range(langs)]
    return np.array([_best_cut(per[k]) if enough[k] else overall for k in range(langs)])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> dict:
    """Train on all of ``labels (doc_id, toxic)`` and the texts of ``docs``.

    ``learn``: condition on ``doc_id`` of rows that may be learnt from.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int"))
    usable = usable.where("doc_id IS NOT NULL").distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    if learn is not None:
        usable, texts = usable.where(learn), texts.where(learn)
    mark = F.xxhash64(F.lit(3), "doc_id", "text")
    # Labels grow with the texts: no plan that holds for a few of them alone.
    rows = staged(texts.join(usable.hint("merge"), "doc_id").select("toxic", "text", "lang", mark.alias("mark")), "toxicity-rows")
    held = F.pmod(F.shiftright("mark", 32), F.lit(4)) == 0
    sizes = {r["toxic"]: r["n"] for r in rows.where(~held).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        unstaged(rows)
        return {}
    fitted = rows.where(~held)
    names = sorted(r["lang"] for r in fitted.where("lang IS NOT NULL").select("lang").distinct().limit(MAX_LANGS + 1).collect())
    names = names if len(names) <= MAX_LANGS else []
    counts: dict[int, np.ndarray] = {}
    counted = fitted.select("toxic", "text", "lang").mapInArrow(_counter(names), "kind int, bucket int, n bigint")
    # At most BUCKETS rows per class and language.
    for r in counted.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r["kind"], np.zeros(BUCKETS))[r["bucket"]] = r["n"]
    model = _initial(counts, np.array([sizes[0], sizes[1]], np.float64), names)

    shared = spark.sparkContext.broadcast(model)
    shards = -(-sum(sizes.values()) // SHARD_ROWS)
    dealt = fitted.repartition(shards, F.xxhash64("mark")).sortWithinPartitions("mark", "toxic").select("toxic", "text")
    models = dealt.mapInArrow(_trainer(shared), "model binary")
    while shards > 1:
        shards = -(-shards // FAN_IN)
        models = models.repartition(shards).mapInArrow(_summed, "model binary")
    model = _averaged(model, pickle.loads(models.first()["model"]))
    shared.unpersist()

    shared = spark.sparkContext.broadcast(model)
    judged = rows.where(held).select("toxic", "text").mapInArrow(_judge(shared), "guess int, toxic int, step bigint")
    # A row per language, label and step of the logit.
    counts = judged.groupBy("guess", "toxic", "step").agg(F.count(F.lit(1)).alias("n")).collect()
    model["cuts"] = _cuts(counts, len(model["langs"]))
    shared.unpersist()
    unstaged(rows)
    return model


def scorer(spark, model: dict):
    """A column function ``text -> score`` (0 to 1)."""
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        parts = [score_texts(shared.value, texts.slice(*part)) for part in slices(texts)]
        released()
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return F.arrow_udf(score, "double")
