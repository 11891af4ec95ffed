"""Registered queries of the training-data operators: ``opN_<name>`` and SQL.

Each query applies one operator to its whole table and derives the result
columns from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.llm import bpe, langid, merkle, toxicity
from quiver.llm.common import table
from quiver.llm.exact_stream import stream_dedup
from quiver.llm.host_reputation import document_in_url, judge
from quiver.llm.html_blocks import extract_main_text
from quiver.llm.kd_shards import kd_shards
from quiver.llm.licenses import scan
from quiver.llm.mixing import plan_mix
from quiver.llm.near_dup import near_duplicates
from quiver.llm.reversed_search import search
from quiver.llm.spaced_seeds import leaks


#: Mix of op2 and of the pipeline: weights by code-point order of the sources,
#: the part of all words that the mix takes, and the most repeats of a source.
MIX = {"weight_cycle": (3.0, 1.0, 2.0), "share": 1.5, "max_repeats": 2.0}
SHARDS = 8


def op1_spaced_seeds(spark, sf_dir):
    """Documents that hold a passage of ``benchmark``: a row per document and item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])


#: Rules of op3, as (verdict, host/path).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op3_host_reputation(spark, sf_dir):
    """Verdict on the url of every row of ``pages``."""
    # Labels are of documents; a page's url holds the number of its document.
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), RULES, document_in_url(F.col("url")))


def op2_hypergeometric_mix(spark, sf_dir):
    """Words that the mix takes of every document of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return plan_mix(docs, **MIX, shards=SHARDS).select(
        "doc_id", "size", "source_size", "target", (F.size("draws") * F.col("size")).alias("taken")
    )


def op8_license_digest(spark, sf_dir):
    """Canonical digest of every text of ``documents``, and the licence that it is."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_bayes_minhash(spark, sf_dir):
    """Near-duplicate groups of ``documents`` over two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op10_kd_shards(spark, sf_dir):
    """``documents`` in shards of near-equal bytes; equal texts share a shard."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return kd_shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _remainder(n: int):
    """crc32 of the doc_id's text modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def learnt_for_toxicity():
    """Rows whose toxicity label may be learnt."""
    return _remainder(3) != 1


def op4_family_svm(spark, sf_dir):
    """Language of every text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    identify = langid.identifier(spark, langid.fit(docs, _remainder(4) != 2))
    found = docs.select("doc_id", (_remainder(4) == 2).alias("held_out"), identify(F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op5_line_blocks(spark, sf_dir):
    """Main text of every row of ``pages``."""
    pages = table(spark, sf_dir, "pages")
    out = pages.select("page_id", "url", extract_main_text(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op6_text_cnn(spark, sf_dir):
    """Toxicity score of every text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learnt_for_toxicity())
    scored = docs.select(
        "doc_id", (_remainder(3) == 1).alias("held_out"), toxicity.scorer(spark, model)(F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int"))


def op7_exact_stream(spark, sf_dir):
    """Exact dedup of ``documents`` by streaming state; the largest doc_id of equal texts stays."""
    out = stream_dedup(spark, f"{sf_dir}/documents.parquet")
    return out.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_path_copying(spark, sf_dir):
    """Proof of every row of ``documents`` in the tree over all sources, and
    the root that it folds to once line ends are taken out of every other text."""
    forged = F.when(_remainder(2) == 0, F.translate("text", "\n", ""))
    return merkle.manifest(table(spark, sf_dir, "documents"), forged)


def vocabulary_path():
    """The public vocabulary that op12 encodes with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_forced_boundaries(spark, sf_dir):
    """Digests of the ids of every text of ``documents``, and of what they decode to."""
    found = bpe.digester(spark, vocabulary_path())(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("found")).select("doc_id", "found.*")


def op13_reversed_search(spark, sf_dir):
    """The ten best ``documents`` of every item of ``benchmark``."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _shrunk_sql(name: str, groups: str) -> str:
    """CTEs ``name_s`` (strength of the prior) and ``name`` (posterior) of the
    groups ``(..., n, good, prior)``."""
    off = "(good / n - prior)"
    return f"""
        {name}_s AS (
            SELECT CASE WHEN rho > 0 THEN least(greatest(1 / rho - 1, 2.0), 1000.0) ELSE 1000.0 END AS s FROM (
                SELECT coalesce(sum(n * {off} * {off} / (prior * (1 - prior)) - 1) / nullif(sum(n - 1), 0), 0) AS rho
                FROM {groups} WHERE n > 0 AND prior > 0 AND prior < 1
            )
        ), {name} AS (
            SELECT *, s * prior + good AS a, s * (1 - prior) + n - good AS b FROM {groups}, {name}_s
        )"""


ORACLE_SQL = {
    "op3_host_reputation": f"""
        WITH read AS (
            SELECT page_id, url, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM pages
        ), keyed AS (
            SELECT *, nullif(regexp_extract(path, '^[^?#]*/[^/0-9?#]*([0-9]{{1,18}})[^/0-9?#]*/?$', 1), '')::BIGINT AS label_id,
                   string_split(host, '.') AS labels
            FROM read
        ), known AS (
            SELECT doc_id, (coalesce(quality, 1) = 1 AND coalesce(toxic, 0) = 0)::INT AS ok
            FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL
        ), counted AS (
            SELECT host, any_value(labels) AS labels, count(ok)::DOUBLE AS n, coalesce(sum(ok), 0)::DOUBLE AS good
            FROM keyed LEFT JOIN known ON doc_id = label_id GROUP BY host
        ), depth AS (
            SELECT *, CASE WHEN len(labels) > 2 AND length(labels[-1]) = 2
                           AND labels[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS k
            FROM counted
        ), hosts AS (
            SELECT host, n, good, array_to_string(labels[greatest(1, len(labels) - k + 1):], '.') AS suffix,
                   array_to_string(labels[greatest(1, len(labels) - k):], '.') AS domain
            FROM depth
        ), share AS (SELECT coalesce(sum(good) / nullif(sum(n), 0), 0.5) AS prior, sum(n) AS all_n FROM hosts),
        suffix_groups AS (
            SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(prior) AS prior FROM hosts, share GROUP BY suffix
        ), {_shrunk_sql("suffixes", "suffix_groups")},
        domain_groups AS (
            SELECT h.domain, h.suffix, sum(h.n) AS n, sum(h.good) AS good, any_value(u.a / (u.a + u.b)) AS prior
            FROM hosts h JOIN suffixes u ON u.suffix = h.suffix GROUP BY h.domain, h.suffix
        ), {_shrunk_sql("domains", "domain_groups")},
        host_groups AS (
            SELECT h.host, h.n, h.good, d.a / (d.a + d.b) AS prior
            FROM hosts h JOIN domains d ON d.domain = h.domain AND d.suffix = h.suffix
        ), {_shrunk_sql("rated", "host_groups")},
        bounds AS (
            SELECT host, round(a / (a + b), 9) AS posterior_mean,
                   round(a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 9) AS upper
            FROM rated
        ), rules(verdict, rule, rule_host, rule_path) AS (
            VALUES {", ".join(f"('{v}', '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in RULES)}
        ), fitting AS (
            SELECT page_id, url, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM (SELECT DISTINCT page_id, url, host, path FROM read) r
            JOIN rules ON (r.host = rule_host OR ends_with(r.host, '.' || rule_host)) AND starts_with(r.path, rule_path)
            GROUP BY page_id, url
        )
        SELECT r.page_id, r.host, r.path, f.rule, posterior_mean, upper,
               coalesce(f.verdict, CASE WHEN all_n > 0 AND upper < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
        FROM read r JOIN bounds b ON b.host = r.host CROSS JOIN share
        LEFT JOIN fitting f ON f.page_id IS NOT DISTINCT FROM r.page_id AND f.url = r.url
    """,
    "op7_exact_stream": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    # Levels below 99 are of a source's tree, those from 100 of the tree over the sources.
    "op11_path_copying": """
        WITH RECURSIVE rows AS (
            SELECT *, coalesce('=' || source, '') AS g,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   list_reduce(list_prepend(4294967295::BIGINT, flatten([
                       [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])),
                       lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END
                   ) % 2 AS odd_crc
            FROM documents
        ), leaves AS (
            SELECT doc_id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY g) AS n,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN odd_crc = 1 AND text IS NOT NULL
                        THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
                   END AS forged
            FROM rows
        ), tree AS (
            SELECT g, 0 AS l, i, n, leaf AS h FROM leaves
            UNION ALL
            SELECT g, l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1
            GROUP BY g, l, i // 3, n
        ), subroots AS (
            SELECT g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1
        ), crown AS (
            SELECT 100 AS l, i, n, h FROM subroots
            UNION ALL
            SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE n > 1
            GROUP BY l, i // 3, n
        ), nodes AS (
            SELECT g, l, i, n, h FROM tree WHERE n > 1
            UNION ALL
            SELECT g.g, c.l, c.i, c.n, c.h FROM crown c CROSS JOIN (SELECT DISTINCT g FROM leaves) g WHERE c.n > 1
        ), steps AS (
            SELECT g, l, i // 3 AS run, i AS own, k.h AS h,
                   coalesce((SELECT string_agg(s.h, '' ORDER BY s.i) FROM nodes s
                             WHERE s.g = k.g AND s.l = k.l AND s.i // 3 = k.i // 3 AND s.i < k.i), '') AS before,
                   coalesce((SELECT string_agg(s.h, '' ORDER BY s.i) FROM nodes s
                             WHERE s.g = k.g AND s.l = k.l AND s.i // 3 = k.i // 3 AND s.i > k.i), '') AS behind
            FROM nodes k
        ), climb AS (
            SELECT v.doc_id, v.leaf, v.g, 0 AS l, v.i, coalesce(v.forged, v.leaf) AS h, '' AS proof, false AS done
            FROM leaves v
            UNION ALL
            SELECT c.doc_id, c.leaf, c.g,
                   CASE WHEN s.g IS NOT NULL THEN c.l + 1 ELSE 100 END,
                   CASE WHEN s.g IS NOT NULL THEN c.i // 3 ELSE r.i END,
                   CASE WHEN s.g IS NOT NULL THEN sha256(s.before || c.h || s.behind) ELSE c.h END,
                   c.proof || coalesce(s.before || s.behind, ''),
                   s.g IS NULL AND c.l >= 100
            FROM climb c JOIN subroots r ON r.g = c.g
            LEFT JOIN steps s ON s.g = c.g AND s.l = c.l AND s.own = c.i
            WHERE NOT c.done
        )
        SELECT c.doc_id, c.leaf, s.h AS subroot, t.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root,
               c.h = t.h AS verified
        FROM climb c JOIN subroots s ON s.g = c.g CROSS JOIN (SELECT h FROM crown WHERE n = 1) t
        WHERE c.done
    """,
    "op13_reversed_search": """
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL
        ), sizes AS (
            SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0
        ), counts AS (
            SELECT doc_id, n, term, count(*)::BIGINT AS tf
            FROM (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs) GROUP BY ALL
        ), items AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM counts, sizes GROUP BY term, n_docs
        ), scores AS (
            SELECT item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM items JOIN weights USING (term) JOIN counts USING (term), sizes GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}

QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op") and callable(fn)}
