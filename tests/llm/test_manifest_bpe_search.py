"""Merkle manifest, byte-pair encoding and reversed search: against brute force, and odd inputs."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quiver.llm import bpe, merkle
from quiver.llm.queries import QUERIES, vocabulary_path
from quiver.llm.reversed_search import Heaps, search, terms_of

SF = "/root/testdata/sf0.001"


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row):
    parts = []
    for name in merkle.FIELDS:
        value = row[name]
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return _h("".join(parts))


def _climb(nodes):
    """Levels of a tree over ``nodes``, from its leaves to its one top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def _brute(rows, forged):
    """Expected rows of the manifest, one tree in memory."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (own, _climb([x[2] for x in own])) for s, own in ((s, sorted(groups[s], key=lambda x: x[:3])) for s in names)}
    crown = _climb([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        own, levels = trees[s]
        for i, (_, _, leaf, r) in enumerate(own):
            cur = _leaf({**r, "text": forged(r)}) if forged(r) is not None else leaf
            proof = ""
            for tree, at in ((levels, i), (crown, k)):
                for nodes in tree[:-1]:
                    run = nodes[at - at % 3:at - at % 3 + 3]
                    proof += "".join(run[:at % 3] + run[at % 3 + 1:])
                    cur = _h("".join(run[:at % 3] + [cur] + run[at % 3 + 1:]))
                    at //= 3
            out.append((r["doc_id"], leaf, levels[-1][0], crown[-1][0], _h(proof), cur, cur == crown[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("sizes", [(1,), (1500, 1, 28, 5)])
def test_manifest_equals_one_tree(spark, sizes):
    rows = [
        {"doc_id": 100 * k + i, "source": None if k == 1 else f"s{k}é", "lang": "en" if i % 2 else None,
         "n_chars": i, "text": f"line {i}\nmore" if i % 3 else None}
        for k, n in enumerate(sizes) for i in range(n)
    ]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    forged = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", ""))

    def plain(r):
        return r["text"].replace("\n", "") if r["doc_id"] % 2 == 0 and r["text"] is not None else None

    got = Counter(tuple(r) for r in merkle.manifest(docs, forged).collect())
    assert got == _brute(rows, plain)


def test_manifest_of_odd_rows(odd, none):
    rows = [r.asDict() for r in odd.collect()]
    got = Counter(tuple(r) for r in merkle.manifest(odd).collect())
    assert got == _brute(rows, lambda r: None) and all(x[-1] for x in got)
    assert merkle.manifest(none).collect() == []
    assert merkle.versions(none, F.lit("x")).collect() == []


def test_versions_copy_only_ancestors(spark):
    docs = spark.range(40).selectExpr(
        "id AS doc_id", "concat('s', id % 3) AS source", "'en' AS lang", "id AS n_chars", "concat('text ', id) AS text"
    )
    forged = F.when(F.col("doc_id") < 6, F.lit("forged"))
    copies = defaultdict(list)
    for r in merkle.versions(docs, forged).collect():
        copies[r.doc_id].append(r)
    folded = {r.doc_id: r for r in merkle.manifest(docs, forged).collect()}
    assert set(copies) == set(range(6))
    for doc, nodes in copies.items():
        inside = sorted((r for r in nodes if not r.over), key=lambda r: r.level)
        # 14 or 13 leaves a source: three levels; three sources: one more.
        assert [r.level for r in inside] == [1, 2, 3] and [r.idx for r in inside] == [doc // 3 // 3, 0, 0]
        assert {r.source for r in inside} == {f"s{doc % 3}"}
        top = next(r for r in nodes if r.over)
        assert top.digest == folded[doc].folded_root and not folded[doc].verified
    assert all(r.verified for d, r in folded.items() if d >= 6)


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(vocabulary_path(), "rb") as f:
        return bpe.Vocabulary(f.read())


def _same(vocabulary, library, texts):
    ids, starts = vocabulary.encode(texts)
    for k, e in enumerate(library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        own = ids[starts[k]:starts[k + 1]]
        assert own.tolist() == e.ids, texts[k]
        assert vocabulary.decode(own) == library.decode(e.ids, skip_special_tokens=False)


def test_encoding_equals_the_library(vocabulary, library):
    every = [chr(c) for c in [*range(0x3000), *range(0xA000, 0xAC00), *range(0x10000, 0x12800, 9), *range(0x1DF00, 0x1E000), 0x323B5, 0x3D001]]
    _same(vocabulary, library, [f"{c}'ll a{c} 1{c}'s \n{c}" for c in every])
    rng = random.Random(5)
    pool = every[:0x500] + [" ", "\n", "\t", "'", "　", " "] * 80 + ["<|endoftext|>"] * 9 + ["'ll", " the"] * 40
    _same(vocabulary, library, ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(5000)])
    _same(vocabulary, library, [
        None, "", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|", "a" * 50000,
        " " * 5000 + "x", "ab" * 20000, "é" * 30000, "\u0000\u0001",
    ])


def test_cuts_are_between_bytes_that_no_token_joins(vocabulary):
    assert 0.9 < 1 - vocabulary.inside.mean() < 1
    inside = bpe.allowed_pairs([b"abc", b"d"])
    assert inside.sum() == 2 and inside[ord("a"), ord("b")] and inside[ord("b"), ord("c")]
    rng = random.Random(2)
    for _ in range(300):
        piece = bytes(rng.choices(b"abcdefgh THE\xc3\xa9\xe2\x80\x99", k=rng.randint(1, 40)))
        ids = [vocabulary.base[b] for b in piece]
        assert vocabulary._scanned(list(ids)) == vocabulary._heaped(list(ids))


def test_decoding_any_ids(vocabulary, library):
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert vocabulary.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_columns(spark, odd, none, library):
    path = vocabulary_path()
    rows = odd.withColumn("ids", bpe.encoder(spark, path)(F.col("text"))).withColumn(
        "again", bpe.decoder(spark, path)(F.col("ids"))
    ).withColumn("d", bpe.digester(spark, path)(F.col("text"))).collect()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.again == (r.text or "") and r.d.n_tokens == len(ids)
        assert r.d.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.d.decoded_sha256 == _h(r.text or "")
    assert none.select(bpe.encoder(spark, path)(F.col("text"))).collect() == []


def test_op12_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op12_forced_boundaries"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranking(docs, items, k):
    bags = [(d, Counter(_terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, df = sum(n for *_, n in bags), Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item, text in items:
        scores = []
        for d, bag, n in bags:
            m = 10 + 90 * n * len(bags) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in set(_terms(text)) if t in bag
            )
            if score > 0:
                scores.append((-score, d is None, d or 0))
        for rank, (score, null, d) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if null else d, -score] += 1
    return out


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_search_equals_brute_force(spark, odd, none, limit):
    rng = random.Random(4)
    words = ["Cat", "dog", "Ünï", "x1", "zwölf", "a-b", "\u0085q", "red", "blue", "ÄÖ"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(300)]
    docs += [(None, "red red"), (None, None), (7, "cat cat"), (7, "cat cat"), (8, "word " * 30000), (9, "")]
    items = [(1, "cat dog"), (2, "Ünï, RED; red"), (3, None), (4, "nowhere"), (5, " ".join(words)), (5, "q"), (None, "x1")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS rank", "'s' AS score").repartition(4)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = Counter(tuple(r) for r in search(d, i, 5, limit).collect())
    assert got == _ranking(docs, items, 5)
    assert search(none, i).collect() == [] and search(odd, i.limit(0)).collect() == []


def test_heaps_keep_the_best_whatever_the_order():
    rng = np.random.default_rng(1)
    scores = rng.integers(0, 6, (500, 3))
    want = None
    for seed in range(4):
        order = np.random.default_rng(seed).permutation(500)
        heaps = Heaps(3, 7)
        for part in np.array_split(order, 9):
            heaps.offer(part, np.zeros(len(part), bool), scores[part])
        got = list(zip(heaps.item, heaps.score, heaps.doc))
        assert want is None or got == want
        want = got


def test_terms_of_slices():
    texts = pa.array(["no", None, "It's ÉTÉ_2", "", "x y Z"])
    vocabulary, codes, starts = terms_of(texts.slice(1))
    words = vocabulary.to_pylist()
    assert [[words[c] for c in codes[s:e]] for s, e in zip(starts[:-1], starts[1:])] == [
        [], ["it", "s", "ÉtÉ", "2"], [], ["x y z"],
    ]
