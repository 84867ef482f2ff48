"""Embedding near-dedup by product quantisation.

Equal vectors are one class. Unit vectors of classes fall into the inverted list of their nearest coarse
centroid; their residuals are coded by the nearest centroid in each of SUBSPACES parts. Every class is
also a query. The lists that it probes follow from geometry: a vector at distance r can lie nearer to
another centroid than to the query's own only if the step to it crosses the plane between the two, and
only if that list's radius reaches the query. With sigmas None a list is probed if a step of the
greatest distance straight to the plane would cross it: then no pair is missed. By default a step counts
for SIGMAS standard deviations of what a random step of that length has along one line; recall is
measured against brute force in the tests. There is no cap on probes. In a list, tables of the query's products with the parts' centroids give its product
with every code; the length of what a code leaves out bounds the error; pairs that the bound lets
through are compared by their cosine in double precision.

Centroids are fitted to a sample of at most SAMPLE vectors of each number of dimensions; all are indexed.
Vectors travel as they are stored, to their own list with their code, and to each list they probe. Long
lists and many queries are dealt out in blocks of BLOCK by BLOCK. A block returns counts, and of links
only enough to connect what they connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, for_python, written
from .components import components

COSINE = 0.95
#: Vectors that centroids are fitted to; most lists; parts, centroids of each; vectors in a block.
SAMPLE, LISTS, SUBSPACES, CODES, BLOCK = 20_000, 4096, 16, 256, 2048
ROUNDS, SEED, ROWS = 8, 7, 1024
#: Deviations, of the part that a random step has along one line, that probes allow for; None: the whole step.
SIGMAS = 2.5
#: What rounding may add to a distance.
EPS = 1e-6


def _units(flat: np.ndarray, dim: int) -> np.ndarray:
    """Vectors of length 1 in double precision, of finite ones that are not zero."""
    x = flat.astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows from centroids, less the rows' own squares."""
    return (centroids * centroids).sum(1) - 2 * x @ centroids.T


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row; ROWS rows at once."""
    return np.concatenate([np.argmin(_distances(x[i : i + ROWS], centroids), 1) for i in range(0, len(x), ROWS)]) if len(x) else np.zeros(0, np.int64)


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = _nearest(x, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centroids))
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


class Index:
    """Coarse centroids and the centroids of each part of the residuals; its lists are numbered from base on."""

    def __init__(self, sample: np.ndarray, lists: int, base: int, cosine: float, sigmas: float | None):
        rng = np.random.default_rng(SEED)
        share = 1.0 if sigmas is None else min(1.0, sigmas / np.sqrt(sample.shape[1]))
        self.base, self.reach = base, float(np.sqrt(max(0.0, 2 - 2 * cosine))) * share
        self.coarse = _means(sample, lists, rng)
        self.width = -(-sample.shape[1] // SUBSPACES)
        rest = self.parts(sample - self.coarse[_nearest(sample, self.coarse)])
        self.books = [_means(np.ascontiguousarray(rest[:, m]), CODES, rng) for m in range(SUBSPACES)]

    def parts(self, x: np.ndarray) -> np.ndarray:
        pad = self.width * SUBSPACES - x.shape[1]
        return np.pad(x, ((0, 0), (0, pad))).reshape(len(x), SUBSPACES, self.width)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, the length of what they leave out, and the distance from the list's centroid."""
        rest = self.parts(x - self.coarse[lists])
        codes = np.stack([_nearest(rest[:, m], b) for m, b in enumerate(self.books)], 1).astype(np.uint8)
        left = rest - np.stack([b[codes[:, m]] for m, b in enumerate(self.books)], 1)
        return codes, np.sqrt((left * left).sum((1, 2))), np.sqrt((rest * rest).sum((1, 2)))

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """The own list of each row, the lists that it has to probe and its distances from their centroids."""
        d = _distances(x, self.coarse) + (x * x).sum(1, keepdims=True)
        own = np.argmin(d, 1)
        c = self.coarse[own]
        apart = np.sqrt(np.maximum(_distances(c, self.coarse) + (c * c).sum(1, keepdims=True), 0))
        near = d - d[np.arange(len(x)), own][:, None] <= 2 * self.reach * apart + EPS
        rows, lists = np.nonzero(near)
        cut = np.flatnonzero(np.diff(rows)) + 1
        return own, np.split(lists, cut), np.split(np.sqrt(np.maximum(d[rows, lists], 0)), cut)

    def products(self, q: np.ndarray, codes: np.ndarray, list_: int) -> np.ndarray:
        """Of each query with each coded vector of a list, by table lookup."""
        qs = self.parts(q)
        out = np.repeat((q @ self.coarse[list_])[:, None].astype(np.float32), len(codes), 1)
        for m, book in enumerate(self.books):
            out += (qs[:, m] @ book.T).astype(np.float32)[:, codes[:, m]]
        return out


ROUTED = "rid long, copies long, dim int, vec binary, list int, code binary, left float, radius double, probes array<struct<list:int,far:double>>"


def _route(batches: Iterator[pa.RecordBatch], indexes: dict[int, Index]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in ROUTED.split(", ")]
    probe = pa.list_(pa.struct([("list", pa.int32()), ("far", pa.float64())]))
    for batch in batches:
        lengths = np.asarray(batch.column("embedding").value_lengths())
        for dim in np.unique(lengths).tolist():
            for at in range(0, len(some := np.flatnonzero(lengths == dim)), ROWS):
                rows = batch.take(pa.array(some[at : at + ROWS]))
                flat = rows.column("embedding").flatten().to_numpy(zero_copy_only=False)
                index = indexes[dim]
                x = _units(flat, dim)
                own, lists, far = index.probes(x)
                codes, left, radius = index.encode(x, own)
                found = [[{"list": index.base + a, "far": b} for a, b in zip(i.tolist(), d.tolist(), strict=True)] for i, d in zip(lists, far, strict=True)]
                columns = [
                    rows.column("rid"), rows.column("copies"), pa.array([dim] * len(x), pa.int32()), pa.array([v.tobytes() for v in flat.reshape(-1, dim)], pa.binary()), pa.array((own + index.base).astype(np.int32)),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left.astype(np.float32)), pa.array(radius), pa.array(found, probe),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of n nodes is connected with by edges a, b."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _block(key: tuple, table: pa.Table, indexes: dict[int, Index], radius: dict[int, float], cosine: float, kind: type) -> pa.Table:
    """Of a block: numbers of vectors linked with each vector (b null), and links that connect what links connect.

    A link counts for the query, and for the member if that does not probe the query's list, where it would find it itself.
    """
    dim = table.column("dim")[0].as_py()
    index = indexes[dim]
    x = _units(np.frombuffer(b"".join(table.column("vec").to_pylist()), kind), dim)
    codes = table.column("code")
    member = codes.is_valid().to_numpy()
    rid, copies = table.column("rid").to_numpy(), table.column("copies").to_numpy()
    ms, qs = np.flatnonzero(member), np.flatnonzero(~member)
    code = np.frombuffer(b"".join(codes.drop_null().to_pylist()), np.uint8).reshape(len(ms), SUBSPACES)
    left = table.column("left").to_numpy()[ms].astype(np.float32)
    home = table.column("home").fill_null(-1).to_numpy().astype(np.int64)
    probes = table.column("probes").take(pa.array(ms)).combine_chunks()
    probed, far = (probes.flatten().field(i).to_numpy() for i in range(2))
    limit = np.array([radius.get(p, -np.inf) for p in probed.tolist()]) + _reach(cosine)  # a list without members finds nothing
    known = ((np.repeat(np.arange(len(ms)), probes.value_lengths().to_numpy()) << 32) + probed)[far <= limit]
    counts = np.zeros(table.num_rows, np.int64)
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(qs) if len(ms) else 0, 256):
        q = qs[at : at + 256]
        near = index.products(x[q], code, key[0].as_py() - index.base) + left >= cosine - 1e-4
        for a, b in zip(*(np.array_split(i, max(1, len(i) // 100_000)) for i in np.nonzero(near)), strict=True):
            a, place, b = q[a], b, ms[b]
            hit = (np.einsum("ij,ij->i", x[a], x[b]) >= cosine) & (rid[a] != rid[b])
            a, place, b = a[hit], place[hit], b[hit]
            alone = ~np.isin((place << 32) + home[a], known)
            counts += np.bincount(a, copies[b], len(counts)).astype(np.int64) + np.bincount(b[alone], copies[a[alone]], len(counts)).astype(np.int64)
            hits.append((a, b))
    some = np.flatnonzero(counts)
    a, b = (np.concatenate([h[i] for h in hits]) if hits else np.zeros(0, np.int64) for i in range(2))
    nodes, of = np.unique(rid, return_inverse=True)  # a vector may be a member and a query
    label = _labels(len(nodes), of[a], of[b])
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.table({
        "a": pa.array(np.append(rid[some], nodes[linked])), "b": pa.array([*[None] * len(some), *nodes[label[linked]].tolist()], pa.int64()),
        "n": pa.array(np.append(counts[some], np.zeros(len(linked), np.int64))),
    })


def _reach(cosine: float) -> float:
    """The distance of vectors of length 1 that link, at most."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine))) + EPS


def _usable(embedding: Column) -> Column:
    """Whether a vector has a direction: finite components, not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, sigmas: float | None = SIGMAS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of embeddings (vec_id, embedding).

    Vectors that are null or zero, or hold null or non-finite components, link with nothing; vectors of
    unlike lengths do not link. Repeated rows are vectors of their own. A null vec_id is no component_id
    unless there is no other, and then not kept. An empty table gives an empty result. Other columns
    are ignored, whatever their names.
    """
    spark = embeddings.sparkSession
    for_python(spark, 2000)
    kind = np.float32 if embeddings.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64
    if kind is np.float64:
        embeddings = embeddings.withColumn("embedding", F.col("embedding").cast("array<double>"))
    hashes = (F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    table = embeddings.select("vec_id", _usable(F.col("embedding")).alias("usable"), *hashes, "embedding")
    known = written(table.select(F.monotonically_increasing_id().alias("rid"), "*"), "vectors")
    classes = known.filter("usable").groupBy("h1", "h2").agg(F.min("rid").alias("rid"), F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.min_by("embedding", "rid").alias("embedding"))
    classes = written(classes.withColumn("dim", F.size("embedding")), "classes")
    indexes: dict[int, Index] = {}
    base = 0
    for dim, n in sorted((r.dim, r["count"]) for r in classes.groupBy("dim").count().collect()):  # a row a number of dimensions
        sample = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("h1", "h2")).limit(SAMPLE).select("embedding").toArrow()  # of bounded size
        indexes[dim] = Index(_units(sample.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False), dim), int(min(LISTS, max(1, n**0.5))), base, cosine, sigmas)
        base += len(indexes[dim].coarse)
    shared = spark.sparkContext.broadcast(indexes)
    routed = written(classes.select("rid", "copies", "embedding").mapInArrow(lambda it: _route(it, shared.value), ROUTED), "routed")
    members = routed.select("list", "rid", "copies", "dim", "vec", "code", "left", "probes")
    probing = routed.select(F.explode("probes").alias("p"), F.col("list").alias("home"), "rid", "copies", "dim", "vec").select("p.list", "p.far", "home", "rid", "copies", "dim", "vec")
    radius = written(routed.groupBy("list").agg(F.max("radius").alias("radius"), F.count("*").alias("m")), "radius")  # a row a list
    radii = spark.sparkContext.broadcast({r.list: r.radius for r in radius.select("list", "radius").collect()})  # the same: at most LISTS of each number of dimensions
    queries = attach(probing, radius, ["list"], "inner").filter(F.col("far") <= F.col("radius") + _reach(cosine)).drop("far", "radius", "m")
    sizes = radius.join(queries.groupBy("list").agg(F.count("*").alias("q")), "list")
    sizes = written(sizes.select("list", F.ceil(F.col("m") / BLOCK).cast("int").alias("mb"), F.ceil(F.col("q") / BLOCK).cast("int").alias("qb")), "sizes")

    def dealt(rows: DataFrame, member: bool) -> DataFrame:
        mine, other = ("mb", "qb") if member else ("qb", "mb")
        rows = attach(rows, sizes, ["list"], "inner").withColumn("own", F.pmod(F.xxhash64("rid"), F.col(mine)).cast("int")).withColumn("of", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        i, j = ("own", "of") if member else ("of", "own")
        absent = {"code": "binary", "left": "float", "probes": "array<struct<list:int,far:double>>", "home": "int"}
        code = [F.col(c) if (c == "home") != member else F.lit(None).cast(t).alias(c) for c, t in absent.items()]
        return rows.select("list", F.col(i).alias("i"), F.col(j).alias("j"), "rid", "copies", "dim", "vec", *code)

    blocks = dealt(members, True).unionByName(dealt(queries, False)).groupBy("list", "i", "j")
    found = written(blocks.applyInArrow(lambda key, t: _block(key, t, shared.value, radii.value, cosine, kind), "a long, b long, n long"), "found")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("n"))
    top = components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "rid")
    of_class = classes.select("h1", "h2", "rid", "copies", "least").join(counts, "rid", "left").join(top, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    of_class = written(of_class.select("h1", "h2", "component", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "of-class")
    least = written(of_class.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    of_class = attach(of_class, least, ["component"], "inner").select("h1", "h2", "n_links", "component_id", F.lit(True).alias("usable"))
    out = known.select("vec_id", "usable", "h1", "h2").join(of_class, ["usable", "h1", "h2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("n_links").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs; for small tables.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
good AS (SELECT rid, e FROM v WHERE len(list_filter(e, lambda x: isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.rid AS x, b.rid AS y FROM good a JOIN good b ON a.rid <> b.rid AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}::DOUBLE),
r AS (SELECT x AS rid, x AS o FROM l UNION SELECT r.rid, l.y FROM r JOIN l ON r.o = l.x),
c AS (SELECT r.rid, min(vec_id) AS component_id FROM r JOIN v ON v.rid = r.o GROUP BY r.rid),
n AS (SELECT x AS rid, count(*) AS k FROM l GROUP BY x)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(vec_id = coalesce(component_id, vec_id), false) AS kept FROM v LEFT JOIN c USING (rid) LEFT JOIN n USING (rid)
"""
