"""Approximate nearest neighbours: inverted file, product-quantised residuals, exact reranking.

Vectors are scaled to unit length, so the cosine is an inner product. Coarse centroids and the residual
codebooks are fitted on a bounded sample (``SAMPLE`` vectors); every vector is indexed as its list and one byte
per sub-space. A query scans its best lists (as many as hold ``target`` of the sample's true neighbours) with a table of sub-space products (asymmetric: the query
is not quantised), the best ``rerank`` survivors are rescored on the original vectors in double precision. Where that
cut may have lost a neighbour (see ``_unsure``), as in a dense group whose members have the same codes, the query
is scored exactly against all vectors.

Lists are dealt into shards of about ``BLOCK`` codes, a longer list over several. Queries are dealt into blocks of
about ``QUERIES`` by their nearest list, lists of one direction together, so that a block probes few lists; only codes
of lists that a block probes go to it. A task has one block and one shard, scans all lists that a query probes in it and
hands on its best ``rerank``. So a list with a third of all vectors is many tasks, what is handed on does not follow the
number of lists, and a task holds ``BLOCK`` codes, ``QUERIES`` vectors and ``QUERIES`` times ``rerank`` survivors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, local_rows

SAMPLE = 20_000
BLOCK = 50_000
QUERIES = 1000
SEED = 5


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def even(rows: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest part to 0.5..1: exact, and no square overflows or vanishes."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def unit(rows: np.ndarray) -> np.ndarray:
    rows = even(np.asarray(rows, np.float64))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    k = min(k, len(x))
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centers)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        some = counts > 0
        centers[some] = sums[some] / counts[some, None]
        if (~some).any():
            centers[~some] = x[rng.choice(len(x), int((~some).sum()))]
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    half = (centers**2).sum(1) / 2
    return np.concatenate([np.argmax(x[a : a + 4096] @ centers.T - half, axis=1) for a in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


@dataclass
class Index:
    centroids: np.ndarray  # lists x dimensions
    books: np.ndarray  # sub-spaces x 256 x width
    dims: int

    def _parts(self, x: np.ndarray) -> np.ndarray:
        m, _, width = self.books.shape
        pad = np.zeros((len(x), m * width - self.dims))
        return np.hstack([x, pad]).reshape(len(x), m, width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lists = nearest(x, self.centroids)
        parts = self._parts(x - self.centroids[lists])
        codes = np.stack([nearest(parts[:, j], self.books[j]) for j in range(len(self.books))], axis=1)
        return lists, codes.astype(np.uint8)

    def probe(self, q: np.ndarray, probes: int) -> np.ndarray:
        return np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")[:, :probes]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """queries x sub-spaces x 256 inner products."""
        return np.einsum("qmw,mcw->qmc", self._parts(q), self.books)


def fit(sample: np.ndarray, n_lists: int, width: int = 4, rounds: int = 8) -> Index:
    rng = np.random.default_rng(SEED)
    centroids = kmeans(sample, n_lists, rounds, rng)
    dims = sample.shape[1]
    m = -(-dims // width)
    index = Index(centroids, np.zeros((m, 256, width)), dims)
    parts = index._parts(sample - centroids[nearest(sample, centroids)])
    for j in range(m):
        book = kmeans(parts[:, j], 256, rounds, rng)
        index.books[j, : len(book)] = book
        index.books[j, len(book) :] = book[0]
    return index


def probes_for(index: Index, sample: np.ndarray, k: int, target: float) -> int:
    """Lists to scan so that ``target`` of the sample's true neighbours lie in them.

    Neighbours within the sample are farther than those within all vectors, which makes this careful.
    """
    some = sample[:: max(1, len(sample) // 500)]
    home = nearest(sample, index.centroids)
    near = np.argsort(-(some @ sample.T), axis=1, kind="stable")[:, 1 : k + 1]
    order = index.probe(some, len(index.centroids))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :].repeat(len(some), 0), 1)
    needed = np.take_along_axis(place, home[near], 1).ravel() + 1
    return int(np.quantile(needed, target, method="higher")) if len(needed) else 1


def _query_blocks(index: Index, homes: dict[int, int]) -> list[tuple[int, int, int]]:
    """(list, first block, blocks) for the queries of each list: small lists of one direction share a block."""
    axis = np.linalg.svd(index.centroids - index.centroids.mean(0), full_matrices=False)[2][0]
    out, block, held = [], 0, 0
    for x in sorted(homes, key=lambda x: float(index.centroids[x] @ axis)):
        if held and held + homes[x] > QUERIES:
            block, held = block + 1, 0
        parts = -(-homes[x] // QUERIES)
        out.append((x, block, parts))
        block, held = (block + parts, 0) if parts > 1 else (block, held + homes[x])
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _unsure(scored: DataFrame, k: int, rerank: int) -> DataFrame:
    """Queries of ``scored`` (query_id, id, near, score, full) whose k-th best may be beaten by what the cut dropped.

    What was dropped has at most the quantised score of the last survivor. It is taken to be underrated by no more than
    the survivors' mean and three of their standard deviations. A k-th best of 1 is only equalled, by copies with larger ids.
    """
    each = scored.groupBy("query_id").agg(F.max("full").alias("full"), F.min("near").alias("last"), F.avg(F.col("score") - F.col("near")).alias("error"), F.stddev_pop(F.col("score") - F.col("near")).alias("spread"), F.sort_array(F.collect_list("score"), asc=False).alias("best"))
    kth = F.when(F.size("best") >= k, F.col("best")[k - 1])
    return each.where(F.col("full") & F.coalesce((kth < 1 - 1e-12) & (F.col("last") + F.col("error") + 3 * F.col("spread") >= kth), F.lit(True))).select("query_id")


def nearest_of_all(ids: np.ndarray, v: np.ndarray, asked: list, k: int, block: int = 128):
    """(query, ids, scores) of the ``k`` nearest rows of a batch to each of ``asked`` (query, vector), by exact scores."""
    most = (k + 1) * int(np.unique(ids, return_counts=True)[1].max())  # a repeated id counts once, the query's own not at all
    v = even(v)
    size, rows = np.sqrt((v * v).sum(1)), unit(v)
    for a in range(0, len(asked), block):
        part = asked[a : a + block]
        rough = unit(np.stack([q for _, q in part])) @ rows.T
        least = np.partition(rough, len(ids) - most, axis=1)[:, len(ids) - most] if len(ids) > most else np.full(len(part), -np.inf)
        for (query, q), near, bound in zip(part, rough, least):
            (q,) = even(q[None, :])
            some = np.flatnonzero(near >= bound - 1e-9)  # products of matrices round differently
            score = (v[some] * q).sum(1) / (np.sqrt((q * q).sum()) * size[some])
            order = np.lexsort((ids[some], -score))
            some, score = some[order], score[order]
            keep = ids[some] != query
            some, score = some[keep], score[keep]
            first = np.sort(np.unique(ids[some], return_index=True)[1])[:k]
            yield query, ids[some[first]], score[first]


def search(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
           target: float = 0.98, rerank: int = 200, scratch: Scratch | None = None) -> DataFrame:
    """The ``k`` nearest of each query by cosine: (query_id, rank, ``id_col``, score), nearest first, ties to smaller ids.

    ``queries`` are rows like ``vectors``; a row with the query's own id is no candidate. Null ids and vectors that
    are null, zero or have null or non-finite components take no part; neither do vectors whose length is
    not the most common one (the larger of equally common). Repeated ids count once with their best score. A query
    with fewer than ``k`` candidates in its lists, or one that ``rerank`` survivors do not settle, is scored against
    all vectors.
    Empty tables give no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "ann")
    clean = lambda df, name: df.select(F.col(id_col).cast("long").alias(name), F.col(vector_col).alias("v")).where(F.col(name).isNotNull() & usable(F.col("v")))
    rows, asked = clean(vectors, "id"), clean(queries, "query_id")
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    schema = f"query_id long, rank int, {id_col} long, score double"
    if not lengths:
        return local_rows(spark, [], schema)
    dims, total = lengths[0]["dims"], lengths[0]["count"]
    rows, asked = rows.where(F.size("v") == dims), asked.where(F.size("v") == dims)
    n_sample = max(256, min(SAMPLE, 8_000_000 // dims))
    share = min(1.0, 1.5 * n_sample / total)
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 24)) < int(share * (1 << 24))).orderBy(F.xxhash64("id", F.lit(SEED + 1))).limit(n_sample).select("v").toPandas()
    if not len(drawn):
        drawn = rows.limit(n_sample).select("v").toPandas()
    n_lists = max(1, min(4096, int(math.sqrt(total))))
    sample = unit(_matrix(drawn["v"]))
    fitted = fit(sample, n_lists)
    probes = probes_for(fitted, sample, k, target)
    index = spark.sparkContext.broadcast(fitted)

    def encode(batches):
        for pdf in batches:
            if len(pdf):
                lists, codes = index.value.encode(unit(_matrix(pdf["v"])))
                yield pd.DataFrame({"id": pdf["id"], "list": lists.astype(np.int32), "code": [c.tobytes() for c in codes]})

    codes = scratch.keep(rows.mapInPandas(encode, "id long, list int, code binary"), "codes")
    counts = {r["list"]: r["count"] for r in codes.groupBy("list").count().collect()}  # a row per list
    pieces = {x: -(-n // BLOCK) for x, n in counts.items()}
    shards = max(1, -(-total // BLOCK))
    shape = F.broadcast(local_rows(spark, list(pieces.items()), "list int, pieces int"))
    stride = 40503  # odd: neighbouring lists and pieces land in different shards

    def probe(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            q = unit(_matrix(pdf["v"]))
            probed = index.value.probe(q, probes)
            places = [sorted({(x * stride + piece) % shards for x in lists for piece in range(pieces.get(x, 0))}) for lists in probed.tolist()]
            yield pd.DataFrame({"query_id": pdf["query_id"], "home": probed[:, 0].astype(np.int32), "lists": list(probed.astype(np.int32)), "shards": places, "q": [row.tobytes() for row in q]})

    wanted = scratch.keep(asked.mapInPandas(probe, "query_id long, home int, lists array<int>, shards array<long>, q binary"), "wanted")
    homes = {r["home"]: r["count"] for r in wanted.groupBy("home").count().collect()}  # a row per list
    asks = local_rows(spark, _query_blocks(fitted, homes), "home int, first int, parts int")
    wanted = wanted.join(F.broadcast(asks), "home").withColumn("ask", F.col("first") + F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")).drop("home", "first", "parts")
    piece = F.pmod(F.xxhash64("id"), F.col("pieces"))
    needed = wanted.select(F.col("ask").alias("ask"), F.explode("lists").alias("list")).distinct()
    left = codes.join(shape, "list").withColumn("shard", F.pmod(F.col("list") * stride + piece, F.lit(shards)).cast("long")).join(needed, "list").select("shard", "ask", "id", "list", "code")
    right = wanted.select(F.col("ask").alias("ask"), "query_id", "lists", "q", F.explode("shards").alias("shard"))

    def scan(codes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "id": [], "near": []}
        if len(codes) and len(queries):
            codes = codes.sort_values(["list", "id"], kind="stable")
            ids, lists = codes["id"].to_numpy(), codes["list"].to_numpy()
            edges = np.flatnonzero(np.diff(lists, prepend=-1))
            ends = np.append(edges[1:], len(lists))
            span = {int(lists[a]): (int(a), int(b)) for a, b in zip(edges, ends)}
            c = np.frombuffer(b"".join(codes["code"]), np.uint8).reshape(len(ids), -1)
            places = np.arange(c.shape[1], dtype=np.int32)[None, :] * 256 + c
            for query, mine, q in zip(queries["query_id"], queries["lists"], queries["q"]):
                q = np.frombuffer(q)
                table = index.value.tables(q[None, :]).ravel()
                found = [(span[x], float(q @ index.value.centroids[x])) for x in mine.tolist() if x in span]
                near = np.concatenate([base + table[places[a:b]].sum(1) for (a, b), base in found]) if found else np.zeros(0)
                which = np.concatenate([ids[a:b] for (a, b), _ in found]) if found else np.zeros(0, np.int64)
                near, which = near[which != query], which[which != query]
                if len(near) > rerank:
                    least = np.partition(near, len(near) - rerank)[len(near) - rerank]
                    near, which = near[near >= least], which[near >= least]
                    some = np.lexsort((which, -near))[:rerank]
                    near, which = near[some], which[some]
                out["query_id"].append(np.full(len(which), query))
                out["id"].append(which)
                out["near"].append(near)
        return pd.DataFrame({n: np.concatenate(x) if x else np.zeros(0) for n, x in out.items()}).astype({"query_id": "int64", "id": "int64"})

    by = ["shard", "ask"]
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(scan, "query_id long, id long, near double")
    from pyspark.sql import Window

    # A query has at most shards x rerank survivors.
    first = near.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), "id"))).where(F.col("r") <= rerank)
    full = F.max(F.col("r") == rerank)
    pairs = scratch.keep(first.groupBy("query_id", "id").agg(F.max("near").alias("near"), full.alias("full")), "survivors")

    def exact(batches):
        for pdf in batches:
            if len(pdf):
                a, b = even(_matrix(pdf["q"])), even(_matrix(pdf["v"]))
                score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
                yield pd.DataFrame({"query_id": pdf["query_id"], "id": pdf["id"], "near": pdf["near"], "full": pdf["full"], "score": score})

    theirs = asked.dropDuplicates(["query_id"]).select("query_id", F.col("v").alias("q"))
    met = pairs.join(rows, "id").join(theirs, "query_id").select("query_id", "id", "near", "full", "q", "v")
    met = met.mapInPandas(exact, "query_id long, id long, near double, full boolean, score double")
    met = scratch.keep(met.groupBy("query_id", "id").agg(F.max("near").alias("near"), F.max("full").alias("full"), F.max("score").alias("score")), "scored")
    found = met.select("query_id", "id", "score")
    enough = min(k, total - 1)
    few = theirs.join(pairs.groupBy("query_id").agg(F.count("*").alias("c")), "query_id", "left").where(F.coalesce("c", F.lit(0)) < enough).select("query_id")
    short = theirs.join(few.union(_unsure(met, enough, rerank)).distinct(), "query_id", "left_semi")
    short = scratch.keep(short.select("query_id", "q"), "short")
    n_short = short.count()
    for b in range(math.ceil(n_short / 500)):  # a stated set, in blocks of about 500, against all rows
        part = short.where(F.pmod(F.xxhash64("query_id"), F.lit(math.ceil(n_short / 500))) == b).collect()
        held = spark.sparkContext.broadcast([(r["query_id"], np.asarray(r["q"], np.float64)) for r in part])

        def all_rows(batches, held=held):
            for pdf in batches:
                if len(pdf):
                    out = list(nearest_of_all(pdf["id"].to_numpy(), _matrix(pdf["v"]), held.value, k))
                    if out:
                        yield pd.DataFrame({"query_id": np.repeat([q for q, _, _ in out], [len(x) for _, x, _ in out]), "id": np.concatenate([x for _, x, _ in out]), "score": np.concatenate([x for _, _, x in out])})

        found = found.union(rows.mapInPandas(all_rows, "query_id long, id long, score double"))
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")).cast("int")
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
