"""Near duplicates, classifiers, pages, urls, the pipeline."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quiver.llm import langid, toxicity
from quiver.llm.common import table
from quiver.llm.components import components
from quiver.llm.host_reputation import judge
from quiver.llm.html_blocks import extract_main_text, main_text
from quiver.llm.near_dup import fewest_matches, near_duplicates
from quiver.llm.queries import RULES, op9_bayes_minhash

SF = "/root/testdata/sf0.001"


def brute(rows, width, percent):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in rows}
    sets = {i: {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()) for i, w in words.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_match_brute_force(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op9_bayes_minhash(spark, SF).collect()}
    assert got == brute(rows, 2, 80)
    out = near_duplicates(odd)
    assert out.count() == 8 and out.where("doc_id = 4 AND component_id = 3 AND NOT kept").count() == 2
    assert near_duplicates(none).count() == 0


A, B = "the quick brown fox jumps over the lazy dog today", "nothing of this is like the other text at all now"


def test_rows_that_share_an_id_or_have_none_keep_their_texts(spark):
    rows = [(3, A), (5, A), (5, B), (9, B), (None, A), (None, A), (None, None), (7, ""), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS kept", "'x' AS n")
    verdicts = near_duplicates(docs, keyed=True)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in verdicts.collect())
    assert got == Counter({
        (3, 3, True): 1, (5, 3, False): 1, (5, 5, True): 1, (9, 5, False): 1, (None, 3, False): 2,
        (None, None, True): 1, (7, 7, True): 2,
    })
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert left.columns == docs.columns
    texts = Counter(r.text for r in left.collect())
    assert texts[A] == texts[B] == 1 and texts[None] == 1 and texts[""] == 2
    # Copies without an id: one of them stays.
    copies = spark.createDataFrame([(None, A)] * 4 + [(None, B)], "doc_id bigint, text string")
    assert Counter(r.text for r in corpus_pipeline.drop_near_duplicates(spark, copies, SF).collect()) == {A: 1, B: 1}
    same = spark.createDataFrame([(1, A)] * 3, "doc_id bigint, text string")
    assert corpus_pipeline.drop_near_duplicates(spark, same, SF).count() == 1


def test_outsiders_meet_members_block_by_block(spark, monkeypatch):
    import quiver.llm.near_dup as module

    monkeypatch.setattr(module, "BLOCK", 3)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, width=2).collect()}
    assert got == brute(list(enumerate(texts)), 2, 80)


def test_limits_and_components(spark):
    assert all(0 < m < 0.8 * n for n, m in fewest_matches(0.8, 1e-6))
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a bigint, b bigint")
    assert Counter(r.component for r in components(chain).collect()) == {1: 40, 100: 2}
    assert components(chain.limit(0)).count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_components_of_a_long_chain_take_few_rounds(spark, shuffled):
    names = list(range(1024))
    if shuffled:
        random.Random(3).shuffle(names)
    links = spark.createDataFrame([(names[i], names[i + 1]) for i in range(1023)], "a bigint, b bigint")
    rounds = []
    assert Counter(r.component for r in components(links, rounds).collect()) == {0: 1024}
    assert len(rounds) <= 25


def test_toxicity_learns_and_handles_odd_rows(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = toxicity.fit(docs, labels, crc != 1)
    score = toxicity.scorer(spark, model)
    held = docs.join(labels, "doc_id").where(crc == 1).select("toxic", (score("text") >= toxicity.CUT).cast("int").alias("p"))
    right = held.agg(F.avg((F.col("toxic") == F.col("p")).cast("int")).alias("a")).first().a
    assert right > 0.85
    assert all(0 <= r.s <= 1 for r in odd.select(score("text").alias("s")).collect())
    assert none.select(score("text")).count() == 0
    assert toxicity.fit(docs, labels.limit(0)) == {}


def test_language_by_family(spark, odd, none):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = langid.fit(docs, crc != 2)
    identify = langid.identifier(spark, model)
    held = docs.where(crc == 2).select("lang", identify("text").alias("f"))
    assert held.agg(F.avg((F.col("lang") == F.col("f.lang")).cast("int")).alias("a")).first().a > 0.95
    found = {r.doc_id: r.f for r in odd.where("doc_id < 3").select("doc_id", identify("text").alias("f")).collect()}
    assert found[1].lang == found[2].lang == "und" and found[1].score == 0
    assert langid.fit(none) == {} and langid.identify({}, pa.array(["a"]))[0] == ["und"]


def test_main_text(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1>"
        "<p>One <b>two</b><br>three</p><aside>side</aside><div class='comments'><p>me too</p></div><p>four</article>"
        "<div class=sidebar>more</div><footer>&copy; x</footer><script>'</p>'"
    )
    assert main_text(page) == "A & B One two three four"
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert main_text("<p>" + "x " * 100000 + "</p>") == ("x " * 100000).strip()
    out = spark.createDataFrame([(1, page), (2, None)], "id int, html string").select("id", extract_main_text("html").alias("t"))
    assert [r.t for r in out.orderBy("id").collect()] == ["A & B One two three four", ""]


def test_rules_and_reputation(spark):
    urls = {
        1: ("http://Example.NET/en/1?x", "example.net/en/", "allow"), 2: ("https://a.b.net/x", "net/", "block"),
        3: ("x://example.com/de/y", "example.com/de/", "block"), 4: ("http://q.org/fr/", "org/fr/", "allow"),
        5: (None, None, "allow"), 6: ("no scheme", None, "allow"), 7: ("http://good.com#net/", None, "allow"),
    }
    rows = [(i, u, None) for i, (u, _, _) in urls.items()]
    rows += [(100 + i, f"http://bad.com/{i}", None) for i in range(200)] + [(400 + i, f"http://good.com/{i}", None) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    labels = spark.createDataFrame([(100 + i, 0, 1) for i in range(100)] + [(400 + i, 1, 0) for i in range(100)] + [(None, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: (r.rule, r.verdict) for r in judge(pages, labels, RULES).collect()}
    assert {i: got[i] for i in urls} == {i: (r, v) for i, (_, r, v) in urls.items()}
    assert got[250] == (None, "block") and got[550] == (None, "allow") and len(got) == len(rows)
    assert judge(pages.limit(0), labels, RULES).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    groups = brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in groups.items() if i == c}
    clash = docs.withColumn("size", F.lit(7)).withColumn("shard", F.lit("s"))
    mixed = corpus_pipeline.mix_sources(spark, clash, SF)
    assert mixed.columns == clash.columns and mixed.where("size <> 7 OR shard <> 's'").count() == 0
    out = corpus_pipeline.run(spark, SF)
    slots = defaultdict(list)
    for r in out.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
