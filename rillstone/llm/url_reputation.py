"""URL filter: host reputation by empirical Bayes, under explicit rules.

Labelled page outcomes are counted by host, registered domain and public suffix. The rate of bad pages
at each level is shrunk towards its parent's by a beta-binomial prior, whose strength comes from the
spread among the level's members. A host is blocked where its beta posterior lies above the limit with
at least CONFIDENCE, that is, where the posterior's lower quantile of that confidence exceeds the limit;
the limit stands for MARGIN times the odds of a bad page anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, attach, for_python, written


@dataclass(frozen=True)
class Rule:
    """Fits host and its subdomains where the url's path starts with path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Rules of the registered query.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
#: Odds of a bad page, as a multiple of those of all pages, above which a host is bad, and how sure that must be.
MARGIN, CONFIDENCE = 1.0, 0.7
#: The intra-class correlation that a level is given before its members are seen, and so many members' weight for it:
#: a few members do not make a prior that knows no spread.
RHO, RHO_MEMBERS = 0.1, 20
#: Second labels under which countries register domains.
SECOND = ("ac", "co", "com", "edu", "gov", "net", "org")
TWO_LABELS = rf"[^.]\.(?:{'|'.join(SECOND)})\.[a-z]{{2}}$"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _strength(level: DataFrame) -> tuple[float, float]:
    """The rate of bad pages over a level's members and the strength, in pages, of the prior among them.

    The moment estimate of the beta-binomial's intra-class correlation rho is averaged with RHO by
    members; the strength is 1/rho - 1. Two numbers go to the driver.
    """
    x = level.filter("n > 0").agg(F.sum("bad").alias("b"), F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("sq"), F.count("*").alias("m"), F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("bb")).first()
    if not x.m:
        return 0.5, 1 / RHO - 1
    p = (x.b + 1) / (x.n + 2)
    spread = x.bb - 2 * p * x.b + p * p * x.n
    below = p * (1 - p) * (x.n - x.sq / x.n - (x.m - 1))
    rho = (spread - p * (1 - p) * (x.m - 1)) / below if below > 0 else 0.0
    return p, 1 / ((x.m * min(max(rho, 0.0), 0.9) + RHO_MEMBERS * RHO) / (x.m + RHO_MEMBERS)) - 1


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - sum(np.log(x + k) for k in range(8))


def beta_above(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Probability that a beta variable of a and b exceeds the limit: its incomplete integral, by continued fraction."""
    flip = limit > (a + 1) / (a + b + 2)  # the fraction converges fast below the mean
    p, q, x = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - limit, limit)
    tiny = 1e-300
    keep = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(x), 1 / keep(1 - (p + q) * x / (p + 1))
    h = d.copy()
    for m in range(1, 400):
        for top in (m * (q - m) * x / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * x / ((p + 2 * m) * (p + 2 * m + 1))):
            d, c = 1 / keep(1 + top * d), keep(1 + top / c)
            h *= d * c
        if np.all(np.abs(d * c - 1) < 1e-14):
            break
    front = np.exp(_log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * np.log(x) + q * np.log1p(-x)) / p
    return np.where(flip, front * h, 1 - front * h)


def _posteriors(batches: Iterator[pa.RecordBatch], limit: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(beta_above(a, b, limit))], names=[*batch.schema.names, "above"])


def parents(host: Column) -> tuple[Column, Column]:
    """The registered domain and the public suffix of a host, without user and port; an address is its own domain."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    ip = name.rlike(r"^\d+\.\d+\.\d+\.\d+$|^\[")
    two = name.rlike(TWO_LABELS)
    last = lambda n: F.substring_index(name, ".", -n)
    return F.when(ip, name).when(two, last(3)).otherwise(last(2)), F.when(ip, F.lit("")).when(two, last(2)).otherwise(last(1))


def reputation(pages: DataFrame, outcomes: DataFrame, margin: float = MARGIN) -> DataFrame:
    """host, n_labelled, n_bad, mean, above: of every host of pages (page_id, host).

    above: the posterior probability that the host is worse than the limit. outcomes: page_id, bad (0
    or 1; null counts for nothing); several of one page all count.
    """
    for_python(pages.sparkSession)
    seen = outcomes.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.count("*").alias("k"), F.sum("bad").alias("b"))
    hosts = written(
        pages.join(seen, "page_id", "left").groupBy("host").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("bad")),
        "hosts",
    )
    domain, suffix = parents(F.col("host"))
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    (p0, k_s), (_, k_d), (_, k_h) = map(_strength, (suffixes, domains, hosts))

    def shrunk(k: float, prior: Column) -> Column:
        return (F.col("bad") + k * prior) / (F.col("n") + k)

    top = written(suffixes.select("suffix", shrunk(k_s, F.lit(p0)).alias("p_s")), "suffixes")
    mid = written(attach(domains, top, ["suffix"], "inner").select("domain", "suffix", shrunk(k_d, F.col("p_s")).alias("p_d")), "domains")
    low = attach(hosts, mid, ["domain", "suffix"], "inner")
    a, b = F.col("bad") + k_h * F.col("p_d"), F.col("n") - F.col("bad") + k_h * (1 - F.col("p_d"))
    low = low.select("host", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), (a / (a + b)).alias("mean"), a.alias("a"), b.alias("b"))
    limit = margin * p0 / (1 - p0 + margin * p0)
    schema = "host string, n_labelled long, n_bad long, mean double, a double, b double, above double"
    return low.mapInArrow(lambda it: _posteriors(it, limit), schema).drop("a", "b")


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, margin: float = MARGIN, confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url).

    A null url has an empty host and path. Pages without a host and hosts without outcomes have
    their parents' rates. Repeated rows are all returned; empty tables give an empty result; other
    columns are ignored, whatever their names. A url of any length is taken whole.
    """
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    blocked = written(reputation(base.select("page_id", "host"), outcomes, margin).filter(F.col("above") >= confidence).select("host", F.lit(True).alias("bad_host")), "blocked")
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_host"), "block").otherwise("allow")
    return attach(base, blocked, ["host"]).select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the labels whose doc_id is the page's id: bad if toxic or of low quality."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    return judge(pages, labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad")))


def _strength_sql(level: str, k: str) -> str:
    return f"""
      SELECT coalesce(max(p), 0.5) AS p0, coalesce(max(1 / ((m * least(greatest(CASE WHEN below > 0 THEN (s - pq * (m - 1)) / below ELSE 0.0 END, 0.0), 0.9) + {RHO_MEMBERS} * {RHO}) / (m + {RHO_MEMBERS})) - 1), 1 / {RHO} - 1) AS {k}
      FROM (SELECT p, p * (1 - p) AS pq, bb - 2 * p * b + p * p * al AS s, m, p * (1 - p) * (al - sq / al - (m - 1)) AS below
            FROM (SELECT (sum(bad) + 1)::DOUBLE / (sum(n) + 2) AS p, sum(bad)::DOUBLE AS b, sum(n)::DOUBLE AS al, sum(n::DOUBLE * n) AS sq, count(*)::DOUBLE AS m, sum(bad::DOUBLE * bad / n) AS bb
                  FROM {level} WHERE n > 0 HAVING count(*) > 0))"""


#: The posterior is integrated in steps of 0.01 of the rate's log odds to both sides of the limit.
ORACLE = rf"""
WITH base AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
seen AS (SELECT doc_id AS page_id, count(*) AS k, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS b FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, coalesce(sum(k), 0)::BIGINT AS n, coalesce(sum(b), 0)::BIGINT AS bad FROM base LEFT JOIN seen USING (page_id) GROUP BY host),
nm AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS nm FROM h),
hosts AS (SELECT host, n, bad, CASE WHEN ip THEN nm ELSE array_to_string(string_split(nm, '.')[-CASE WHEN two THEN 3 ELSE 2 END:], '.') END AS domain,
                 CASE WHEN ip THEN '' ELSE array_to_string(string_split(nm, '.')[-CASE WHEN two THEN 2 ELSE 1 END:], '.') END AS suffix
          FROM (SELECT *, regexp_matches(nm, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$|^\[') AS ip, regexp_matches(nm, '{TWO_LABELS}') AS two FROM nm)),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM domains GROUP BY suffix),
ks AS ({_strength_sql("suffixes", "k_s")}), kd AS ({_strength_sql("domains", "k_d")}), kh AS ({_strength_sql("hosts", "k_h")}),
ps AS (SELECT suffix, (bad + k_s * p0) / (n + k_s) AS p_s FROM suffixes, ks),
pd AS (SELECT domain, suffix, (bad + k_d * p_s) / (n + k_d) AS p_d FROM domains JOIN ps USING (suffix), kd),
ph AS (SELECT host, bad + k_h * p_d AS a, n - bad + k_h * (1 - p_d) AS b, ln({MARGIN} * ks.p0 / (1 - ks.p0)) AS u FROM hosts JOIN pd USING (domain, suffix), kh, ks),
grid AS (SELECT host, sgn, a * -ln(1 + exp(-v)) + b * -ln(1 + exp(v)) AS lw, CASE WHEN k = 0 THEN 0.5 ELSE 1.0 END AS half
         FROM (SELECT host, a, b, sgn, k, u + sgn * k * 0.01::DOUBLE AS v FROM ph, (SELECT unnest([-1, 1]) AS sgn), (SELECT unnest(range(4000)) AS k))),
blocked AS (SELECT host, sum(CASE WHEN sgn > 0 THEN half * exp(lw - top) END) / sum(half * exp(lw - top)) >= {CONFIDENCE} AS bad_host FROM (SELECT *, max(lw) OVER (PARTITION BY host) AS top FROM grid) GROUP BY host),
ruled AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM base)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN bad_host THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN blocked USING (host)
"""
