"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Every document has a vector of transformed statistics: log mean word length, root of the symbols a
character, root of the share of repeated words, log words. For each language and source the mean and
covariance of the half of documents with the least determinant are sought by concentration steps:
distances from the present estimate, the nearest half, its mean and covariance, and again. The steps
start at medians and at quartiles and go on while a determinant falls; the least one is kept. Every
group's estimate, whatever its size, is then shrunk towards the pooled one of its language, with the
weight of SHRINK documents, and that towards the pooled one of all. Documents whose squared Mahalanobis
distance exceeds CUTOFF are rejected.

The nearest half is found from counts of distances in bins, so that no group is sorted or gathered;
the documents of the bin in which it ends count by the share of it that is missing, so that copies
do not enter as a whole. Estimates hold a ridge, FLOORS, the standard deviations that are harmless in
each statistic: most documents have no symbol at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach, words, written

SYMBOLS = r"[#*$%&|<>]"
P = 4
FLOORS = (0.12, 0.03, 0.15, 1.2)
#: Upper 1e-6 point of chi-square with 4 degrees of freedom; documents that the pooled estimate weighs in a group's.
CUTOFF, SHRINK = 33.4, 50
#: Base rules: least words, greatest percentage of repeated words, words of a repeated window.
MIN_WORDS, MAX_REPEAT, WINDOW = 10, 20, 5

#: The vector, the bin of a squared distance; read by Spark and by other engines alike.
VECTOR = (
    "ln((word_chars + 1e0) / (n_words + 1e0))",
    "sqrt(n_symbols / (word_chars + 1e0))",
    "sqrt(n_repeat_words / (n_words + 1e0))",
    "ln(n_words + 1e0)",
)
MEDIAN_BIN = "CAST(floor(32 * x{i}) AS INT)"
FINE_BIN = "CAST(floor(128 * ln(1e0 + least(d2, 1e9))) AS INT)"
#: What moments are made of.
PRODUCTS = (*[f"x{i}" for i in range(P)], *[f"x{i} * x{j}" for i in range(P) for j in range(i + 1)])
#: What brings the covariance of the nearest half of normal vectors to that of all, quantiles at which the starts lie, least fall of the log determinant's half.
HALF_CONSISTENCY, STARTS, FALL = 2.109, (0.5, 0.25, 0.75), 1e-4


def repeated_words(w: Column) -> Column:
    """Words of the array that lie in a window of five words found twice or more in it."""

    def covered(hashes: Column) -> Column:
        found = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(found, lambda s: _let(F.sort_array(F.array_distinct(F.flatten(F.zip_with(s, F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))))), spans))

    def spans(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda x, y: x + y)

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    some = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(w) > WINDOW, some).otherwise(0).cast("bigint")


def _let(value: Column, body) -> Column:
    """body of value, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"), repeated_words(w).alias("n_repeat_words"))
    out = documents.select(
        "doc_id", "lang", "source", _let(words(text), of_words).alias("_w"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    ).select("doc_id", "lang", "source", "_w.*", "n_symbols", "n_dup_lines")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _grouped(stats: DataFrame) -> DataFrame:
    """Adds g, the language and source, and lang_name, the language; nulls are values of their own."""
    name = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit("-"))
    return stats.withColumn("lang_name", name("lang")).withColumn("g", F.concat_ws("\n", "lang_name", name("source")))


CELLS = [(i, j) for i in range(P) for j in range(i + 1)]
M, C, ROOT = [f"m{i}" for i in range(P)], [f"c{i}{j}" for i, j in CELLS], [f"l{i}{j}" for i, j in CELLS]
LOG_DET = " + ".join(f"ln(l{i}{i})" for i in range(P))


def cholesky_sql(source: str, keys: str) -> str:
    """keys, m, c and l<i><j>, the lower triangle of the root of c + FLOORS squared, of the relation source."""
    q = source
    for j in range(P):
        for i in range(j, P):
            cell = f"c{i}{j}" + (f" + {FLOORS[i] ** 2!r}" if i == j else "")
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            q = f"(SELECT *, {f'sqrt({cell}{less})' if i == j else f'({cell}{less}) / l{j}{j}'} AS l{i}{j} FROM {q} AS q{i}{j})"
    return f"SELECT {keys}, {', '.join(M + C + ROOT)} FROM {q} AS q"


def distance_sql() -> str:
    """Squared Mahalanobis distance of x<i> from m<i> by the triangle l<i><j>."""
    z: list[str] = []
    for i in range(P):
        z.append(f"((x{i} - m{i}{''.join(f' - l{i}{k} * {z[k]}' for k in range(i))}) / l{i}{i})")
    return " + ".join(f"{x} * {x}" for x in z)


def start_sql(vectors: str) -> str:
    """g, start, m, c: quantiles of each statistic, from counts in bins, and four times the harmless deviations."""
    bins = " UNION ALL ".join(f"SELECT g, {i} AS dim, {MEDIAN_BIN.format(i=i)} AS bin, count(*) AS n FROM {vectors} GROUP BY g, {MEDIAN_BIN.format(i=i)}" for i in range(P))
    upto = f"SELECT g, dim, bin, sum(n) OVER (PARTITION BY g, dim ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY g, dim) AS total FROM ({bins}) AS b"
    each = " UNION ALL ".join(f"SELECT g, dim, {q!r}e0 AS start, min(bin) AS bin FROM ({upto}) AS u WHERE upto >= {q!r}e0 * total GROUP BY g, dim" for q in STARTS)
    means = ", ".join(f"min(CASE WHEN dim = {i} THEN (bin + 0.5e0) / 32 END) AS m{i}" for i in range(P))
    cells = ", ".join(f"{(16 * FLOORS[i] ** 2 if i == j else 0.0)!r}e0 AS c{i}{j}" for i, j in CELLS)
    return f"SELECT g, start, {means}, {cells} FROM ({each}) AS e GROUP BY g, start"


def step_sql(near: str, keys: str) -> str:
    """keys, m, c, l of the nearest half of near (keys, x<i>, d2), by bins of the distance; keys begin with g, start."""
    sums = ", ".join(f"sum({x}) AS s{k}" for k, x in enumerate(PRODUCTS))
    per_bin = f"SELECT {keys}, {FINE_BIN} AS bin, count(*) AS n, {sums} FROM {near} GROUP BY {keys}, {FINE_BIN}"
    upto = f"SELECT *, sum(n) OVER (PARTITION BY g, start ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY g, start) AS total FROM ({per_bin}) AS b"
    half = f"least(floor((total + {P + 1}) / 2e0), total)"
    inside = f"SELECT *, least(greatest(({half} - upto + n) / (n * 1e0), 0e0), 1e0) AS w FROM ({upto}) AS u"
    means = f"SELECT {keys}, {', '.join(f'sum(w * s{k}) / sum(w * n) AS e{k}' for k in range(len(PRODUCTS)))} FROM ({inside}) AS i WHERE w > 0 GROUP BY {keys}"
    cov = [f"{HALF_CONSISTENCY!r} * {'greatest(' * (i == j)}(e{P + k} - e{i} * e{j}){', 0e0)' * (i == j)} AS c{i}{j}" for k, (i, j) in enumerate(CELLS)]
    return cholesky_sql(f"(SELECT {keys}, {', '.join(f'e{i} AS m{i}' for i in range(P))}, {', '.join(cov)} FROM ({means}) AS e)", keys)


def shrunk_sql(source: str) -> str:
    """g, m, c, l of source (g, lang_name, n, m, c): each group's estimate shrunk to its language's, and that to all."""
    level = lambda over, x: f"(sum(n * ({x})) OVER ({over}) / sum(n) OVER ({over}))"
    by, pooled = "PARTITION BY lang_name", []
    for name, over in (("a", by), ("b", "")):
        pooled += [f"{level(over, f'm{i}')} AS {name}m{i}" for i in range(P)]
        pooled += [f"{level(over, f'c{i}{j} + m{i} * m{j}')} - {level(over, f'm{i}')} * {level(over, f'm{j}')} AS {name}c{i}{j}" for i, j in CELLS]
    q = f"SELECT *, sum(n) OVER ({by}) AS total, {', '.join(pooled)} FROM {source} AS s"
    mixed = lambda x: f"(n * {x} + {SHRINK}e0 * (total * a{x} + {SHRINK}e0 * b{x}) / (total + {SHRINK}e0)) / (n + {SHRINK}e0) AS {x}"
    return cholesky_sql(f"(SELECT g, {', '.join(map(mixed, M + C))} FROM ({q}) AS p)", "g")


def estimates(vectors: DataFrame) -> DataFrame:
    """g, m, c, l of vectors (g, lang_name, x<i>, a written table): mean, covariance and its root of each group.

    Concentration steps go on from all starts while a determinant falls; the least of each group is
    kept. There is a row a group and start.
    """
    spark = vectors.sparkSession
    cells = [*M, *C, *ROOT]
    start = spark.sql(cholesky_sql(f"({start_sql('{v}')})", "g, start"), v=vectors)
    best, falls = written(start.withColumn("det", F.lit(float("inf"))), "start"), True
    few = best.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # the same at every step
    while falls:
        near = vectors.join(F.broadcast(best) if few else best, "g").selectExpr("g", "start", *[f"x{i}" for i in range(P)], f"{distance_sql()} AS d2")
        now = spark.sql(step_sql("{near}", "g, start"), near=near).withColumn("det", F.expr(LOG_DET))
        both = now.select("g", "start", F.struct("det", *cells).alias("now")).join(best.select("g", "start", F.struct("det", *cells).alias("then")), ["g", "start"])
        both = written(both.withColumn("falls", F.expr(f"now.det < then.det - {FALL}")), "estimates")
        best = both.select("g", "start", F.when(F.col("falls"), F.col("now")).otherwise(F.col("then")).alias("b")).select("g", "start", "b.*")
        falls = not both.filter("falls").isEmpty()
    least = best.groupBy("g").agg(F.min(F.struct("det", "start", *cells)).alias("b"))
    sizes = vectors.groupBy("g", "lang_name").agg(F.count("*").alias("n"))
    own = sizes.join(least.select("g", *[F.col(f"b.{c}").alias(c) for c in (*M, *C)]), "g")
    return written(spark.sql(shrunk_sql("{own}"), own=own), "estimates")


def verdicts(stats: DataFrame) -> DataFrame:
    """stats (of statistics()) with d2 and kept.

    Null languages and sources are values of their own. Documents that fail the base rules take no
    part in the estimates. Repeated rows count each; an empty table gives an empty result.
    """
    table = written(stats, "stats")
    good = _grouped(table.filter("NOT base_failed")).select("*", *[F.expr(x).alias(f"x{i}") for i, x in enumerate(VECTOR)])
    params = estimates(written(good.select("g", "lang_name", *[f"x{i}" for i in range(P)]), "vectors"))
    good = attach(good, params, ["g"], "inner").withColumn("d2", F.expr(distance_sql()))
    good = good.select(*table.columns, "d2", (F.col("d2") <= CUTOFF).alias("kept"))
    return good.unionByName(table.filter("base_failed").select("*", F.lit(None).cast("double").alias("d2"), F.lit(False).alias("kept")))


OUT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def judge(documents: DataFrame) -> DataFrame:
    """The statistics and verdict of every row of documents (doc_id, text, lang, source).

    A null text has no words and fails the base rules. A very long text is one row's array of words. Other
    columns are ignored, whatever their names.
    """
    return verdicts(statistics(documents)).select(*OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    xs, cells = ", ".join(f"x{i}" for i in range(P)), ", ".join(M + C + ROOT)
    name = lambda c: f"coalesce('+' || {c}, '-')"
    near = f"(SELECT g, start, step, det AS old, {xs}, {distance_sql()} AS d2 FROM v JOIN est USING (g))"
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tok AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
gram AS (SELECT rid, i, word || chr(10) || lead(word, 1) OVER o || chr(10) || lead(word, 2) OVER o || chr(10) || lead(word, 3) OVER o || chr(10) || lead(word, 4) OVER o AS gram FROM tok WINDOW o AS (PARTITION BY rid ORDER BY i)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM gram WHERE gram IS NOT NULL) WHERE c > 1),
rep AS (SELECT rid, sum(k) AS k FROM (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS k FROM dup) GROUP BY rid),
st AS (SELECT rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
              (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
              (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(k, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rep USING (rid)),
s AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM st),
v AS MATERIALIZED (SELECT rid, {name("lang")} AS lang_name, {name("lang")} || chr(10) || {name("source")} AS g, {", ".join(f"{x} AS x{i}" for i, x in enumerate(VECTOR))} FROM s WHERE NOT base_failed),
first AS MATERIALIZED ({cholesky_sql(f"({start_sql('v')})", "g, start")}),
est AS (SELECT 0 AS step, g, start, {cells}, 'infinity'::DOUBLE AS det FROM first
        UNION ALL SELECT step + 1, g, start, {cells}, det FROM (SELECT *, {LOG_DET} AS det FROM ({step_sql(near, "g, start, step, old")})) WHERE det < old - {FALL}),
least_det AS (SELECT g, arg_min(t, (det, start)) AS t FROM (SELECT g, start, last(det ORDER BY step) AS det, last({{{", ".join(f"'{c}': {c}" for c in M + C)}}} ORDER BY step) AS t FROM est GROUP BY g, start) GROUP BY g),
own AS (SELECT g, lang_name, n, {", ".join(f"t.{c} AS {c}" for c in M + C)} FROM least_det JOIN (SELECT g, lang_name, count(*) AS n FROM v GROUP BY g, lang_name) USING (g)),
params AS ({shrunk_sql("own")}),
verdict AS (SELECT rid, {distance_sql()} <= {CUTOFF} AS good FROM v JOIN params USING (g))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(good, false) AS kept FROM s LEFT JOIN verdict USING (rid)
"""


ORACLE = _oracle()
