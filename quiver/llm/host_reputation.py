"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (good: quality 1 and not toxic) are counted per host.
Each level is shrunk to the one above it by a beta-binomial prior: suffixes
to the share of good pages over all labels, registered domains to their
suffix, hosts to their domain. The strength of a level's prior (in pages) is
estimated by moments from the spread of its groups' shares around their
parents', and kept within ``STRENGTH``. A host is blocked if even the upper
bound of its posterior (normal, ``Z`` standard deviations) stays under
``LEAST``; hosts without labels stand on their domain's or suffix's share.

A label belongs to the pages whose key (``page_id``, or the caller's column)
equals its ``doc_id``; a page with a null key has no label.

Rules ``host/path`` come first: a rule fits its host and all subdomains if
the url's path starts with the rule's path; the longest rule wins.

Everything is DataFrame code. Pages reach their host's verdict by a join of
two written tables, so AQE can split a host with many pages; the rules are
a short list given by the caller.

Defined cases: a null url or one without ``://`` has empty host and path
and is judged as the empty host; a page with several labels counts each;
null labels are left out; without labels every host is allowed; repeated
pages are judged alike; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import staged

STRENGTH = (2.0, 1000.0)
Z = 1.645
LEAST = 0.5
MAX_RULES = 10_000
# Second-level names under which domains are registered.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]


def url_host(url: Column) -> Column:
    return F.translate(
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz",
    )


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_labels(host: Column) -> Column:
    """Number of labels of the host's suffix: two under a country code with a
    second level (``co.uk``), else one."""
    parts = F.split(host, r"\.")
    country = (F.size(parts) > 2) & (F.length(F.element_at(parts, -1)) == 2)
    second = F.when(F.size(parts) > 1, F.element_at(parts, -2))
    return F.when(country & second.isin(SECOND_LEVEL), F.lit(2)).otherwise(F.lit(1))


def _last_labels(host: Column, n: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -n)


def host_levels(hosts: DataFrame) -> DataFrame:
    """Add ``domain`` and ``suffix`` to ``host``."""
    n = suffix_labels(F.col("host"))
    return hosts.withColumn("suffix", _last_labels(F.col("host"), n)).withColumn(
        "domain", _last_labels(F.col("host"), n + 1)
    )


def _strength(groups: DataFrame) -> float:
    """Prior strength by moments of ``groups (n, good, prior)``.

    With strength s, the squared deviation of a group's share has mean
    p (1 - p) (1 + (n - 1) rho) / n, rho = 1 / (s + 1).
    """
    usable = groups.where("n > 0 AND prior > 0 AND prior < 1").withColumn("off", F.col("good") / F.col("n") - F.col("prior"))
    seen, room = usable.agg(
        F.sum(F.col("n") * F.col("off") * F.col("off") / (F.col("prior") * (1 - F.col("prior"))) - 1), F.sum(F.col("n") - 1)
    ).first()
    lo, hi = STRENGTH
    rho = seen / room if room else 0.0
    return min(max(1 / rho - 1, lo), hi) if rho > 0 else hi


def _shrunk(groups: DataFrame) -> DataFrame:
    """Posterior ``alpha`` and ``beta`` of ``groups (..., n, good, prior)``."""
    strength = F.lit(_strength(groups))
    return groups.withColumns({
        "alpha": strength * F.col("prior") + F.col("good"),
        "beta": strength * (1 - F.col("prior")) + F.col("n") - F.col("good"),
    })


def document_in_url(url: Column) -> Column:
    """The number in the last part of a url's path, or null."""
    number = F.regexp_extract(F.coalesce(url_path(url), F.lit("")), r"^[^?#]*/[^/0-9?#]*([0-9]{1,18})[^/0-9?#]*/?(?:[?#]|$)", 1)
    return F.nullif(number, F.lit("")).cast("bigint")


def reputations(pages: DataFrame, labels: DataFrame, labelled_by: Column | None = None) -> DataFrame:
    """``(host, labelled, good, posterior_mean, upper, blocked)`` per host."""
    known = labels.where("quality IS NOT NULL OR toxic IS NOT NULL").select(
        F.col("doc_id").alias("label_id"),
        ((F.coalesce("quality", F.lit(1)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("ok"),
    )
    key = F.col("page_id") if labelled_by is None else labelled_by
    seen = pages.select(key.alias("label_id"), url_host(F.col("url")).alias("host"))
    counted = seen.join(known, "label_id", "left").groupBy("host").agg(
        F.count("ok").cast("double").alias("n"), F.coalesce(F.sum("ok"), F.lit(0)).cast("double").alias("good")
    )
    hosts = staged(host_levels(counted), "hosts")
    # Two sums and three strengths are all that comes to the driver.
    n, good = hosts.agg(F.sum("n"), F.sum("good")).first()
    share = good / n if n else 0.5
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    mean = F.col("alpha") / (F.col("alpha") + F.col("beta"))
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(share))
    above = staged(_shrunk(suffixes).select("suffix", mean.alias("prior")), "suffixes")
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(above, "suffix")
    above = staged(_shrunk(domains).select("domain", "suffix", mean.alias("prior")), "domains")
    rated = _shrunk(hosts.join(above, ["domain", "suffix"]))
    size = F.col("alpha") + F.col("beta")
    spread = F.sqrt(F.col("alpha") * F.col("beta") / (size * size * (size + 1)))
    upper = F.round(mean + Z * spread, 9)
    return rated.select(
        "host", F.col("n").cast("bigint").alias("labelled"), F.col("good").cast("bigint").alias("good"),
        F.round(mean, 9).alias("posterior_mean"), upper.alias("upper"),
        (F.lit(bool(n)) & (upper < LEAST)).alias("blocked"),
    )


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], labelled_by: Column | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, posterior_mean, upper)``;
    ``rules``: ``(verdict, "host/path")``; ``labelled_by``: the label's
    ``doc_id`` of a page, its ``page_id`` by default."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules are supported")
    spark = pages.sparkSession
    listed = F.broadcast(spark.createDataFrame(
        [(v, r, r.split("/", 1)[0], "/" + r.split("/", 1)[1]) for v, r in rules],
        "rule_verdict string, rule string, rule_host string, rule_path string",
    ))
    hosts = reputations(pages, labels, labelled_by)
    parts = F.split("host", r"\.")
    ends = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: _last_labels(F.col("host"), k)
    )).alias("rule_host")).distinct()
    fitting = ends.join(listed, "rule_host").groupBy("host").agg(F.collect_list(F.struct(
        F.length("rule").alias("size"), "rule", "rule_path", "rule_verdict"
    )).alias("rules"))  # at most as many as there are rules
    verdicts = staged(hosts.join(fitting, "host", "left"), "host-verdicts")
    read = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    met = read.join(verdicts, "host")
    best = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    return met.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        "posterior_mean", "upper",
    )
