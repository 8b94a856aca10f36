"""Approximate nearest neighbours over balanced posting lists.

* Fit (bounded sample, on the driver): balanced centroids by repeated median
  bisection and size-penalised refinement, a neighbour graph over the
  centroids, and the distance ratio that gives ``TARGET_RECALL`` on sample
  queries.
* Index: every vector goes to its nearest lists; one near a boundary is
  replicated to each list whose centroid is at most ``1 + BOUNDARY`` times as
  far as the nearest (``REPLICAS`` at most).  Lists are stored as blocks of
  bounded bytes, so a hot list is many rows.
* Search: the centroid graph is searched in memory; a query visits the lists
  within the fitted ratio of its nearest centroid.  Each (query chunk, block)
  pair is one matrix product; a task keeps each query's best candidates over
  its blocks, and a limited window merges the tasks.

Nearness is the largest inner product in double precision.  The lists use
Euclidean distance after appending ``sqrt(max_norm^2 - norm^2)`` (0 for a
query), which orders vectors exactly as the inner product does.

Equal vectors are searched once.  A class keeps its ``k + 1`` smallest ids:
equal vectors score alike and ties go to smaller ids, so no other member can
be among the ``k`` found for any query.  Every member still gets its answer.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component take no part, nor do rows without id, nor vectors whose
dimension is not the most frequent one.  Rows repeating an id count once (the
smallest vector).  An empty table or no queries give no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import cut, table

MAX_SAMPLE = 32_768         # vectors the centroids are fitted on
MAX_LISTS = 1_024
LIST_ROWS = 400             # rows aimed at in a list, before replication
REPLICAS, BOUNDARY = 8, 0.25
TARGET_RECALL = 0.97
BLOCK_BYTES = 2 << 20
DEGREE = 24
ROWS = 2_048                # vectors that search the graph together


def bisect(x: np.ndarray, parts: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Row numbers in ``parts`` groups of equal size, cut at medians along the line between two means."""
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        i = int(np.argmax([len(g) for g in groups]))
        g = groups.pop(i)
        a, b = x[rng.choice(g, 2, replace=False)]
        for _ in range(4):
            side = ((x[g] - a) ** 2).sum(1) < ((x[g] - b) ** 2).sum(1)
            if side.all() or not side.any():
                break
            a, b = x[g[side]].mean(0), x[g[~side]].mean(0)
        order = g[np.argsort(x[g] @ (b - a), kind="stable")]
        groups += [order[:len(order) // 2], order[len(order) // 2:]]
    return groups


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None, :] - 2 * x @ c.T, 0)


def fit_centroids(x: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(x) // 2 or 1))
    c = np.stack([x[g].mean(0) for g in bisect(x, lists, rng)])
    parts = np.array_split(x, 1 + len(x) // ROWS)
    scale = np.concatenate([squared(p, c).min(1) for p in parts]).mean() / max(len(x) / lists, 1)
    load = np.zeros(lists)
    for _ in range(5):
        own = np.concatenate([(squared(p, c) + 0.2 * scale * load).argmin(1) for p in parts])
        load = np.bincount(own, minlength=lists).astype(float)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(load[:, None] > 0, total / np.maximum(load, 1)[:, None], c)
    return c


class Graph:
    """Neighbour graph over the centroids, searched best-first for many points at once."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        n = len(centroids)
        d = squared(centroids, centroids)
        ahead: list[set[int]] = []
        back: list[list[int]] = [[] for _ in range(n)]
        for i in range(n):
            chosen: list[int] = []
            for j in np.argsort(d[i], kind="stable")[1:4 * DEGREE]:
                if len(chosen) < DEGREE // 2 and all(d[i, j] <= d[k, j] for k in chosen[:6]):
                    chosen.append(int(j))
            chosen += [int(j) for j in np.argsort(d[i], kind="stable")[1:1 + DEGREE // 4]]
            ahead.append({*chosen, (i + 1) % n} - {i})      # the ring keeps the graph connected
            for j in ahead[i]:
                back[j].append(i)
        # links back, the nearest first, as far as DEGREE allows
        links = [x | set(sorted(set(y) - x, key=lambda j, i=i: d[i, j])[:max(0, DEGREE - len(x))]) for i, (x, y) in enumerate(zip(ahead, back))]
        width = max([1, *(len(x) for x in links)])
        self.links = np.array([sorted(x) + [i] * (width - len(x)) for i, x in enumerate(links)])
        self.entry = int(d.sum(1).argmin())

    def nearest(self, q: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``breadth`` centroids found nearest to each row of ``q``, and their squared distances."""
        n, m = len(q), len(self.c)
        breadth = min(breadth, m)
        norm = (self.c ** 2).sum(1)
        own = (q ** 2).sum(1)
        ids = np.full((n, breadth), self.entry)
        dist = np.full((n, breadth), np.inf)
        dist[:, 0] = own + norm[self.entry] - 2 * q @ self.c[self.entry]
        todo = np.zeros((n, breadth), bool)
        todo[:, 0] = True
        seen = np.zeros((n, m), bool)
        seen[:, self.entry] = True
        active = np.arange(n)
        while len(active):
            at = np.where(todo[active], dist[active], np.inf).argmin(1)
            todo[active, at] = False
            near = self.links[ids[active, at]]
            new = ~seen[active[:, None], near]
            new &= np.concatenate([np.ones((len(near), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
            seen[active[:, None], near] = True
            d = own[active, None] + norm[near] - 2 * np.einsum("nd,nkd->nk", q[active], self.c[near])
            d = np.where(new, np.maximum(d, 0), np.inf)
            all_d = np.concatenate([dist[active], d], axis=1)
            all_i = np.concatenate([ids[active], near], axis=1)
            all_t = np.concatenate([todo[active], new], axis=1)
            best = np.argpartition(all_d, breadth - 1, axis=1)[:, :breadth]
            rows = np.arange(len(active))[:, None]
            dist[active], ids[active], todo[active] = all_d[rows, best], all_i[rows, best], all_t[rows, best]
            todo[active] &= np.isfinite(dist[active])
            active = active[todo[active].any(1)]
        order = np.argsort(dist, axis=1, kind="stable")
        rows = np.arange(n)[:, None]
        return ids[rows, order], dist[rows, order]


class Index:
    """Centroids with their graph, the norm bound and the fitted distance ratio."""

    def __init__(self, sample: np.ndarray, total: int, max_norm: float, k: int):
        self.max_norm, self.dim = max_norm, sample.shape[1]
        x = self.lift(sample)
        lists = min(MAX_LISTS, max(1, round(total / LIST_ROWS)))
        self.graph = Graph(fit_centroids(x, lists))
        self.ratio, self.breadth = self._calibrate(sample, x, k)

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.max_norm ** 2 - (x ** 2).sum(1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def _calibrate(self, sample, x, k):
        """The squared-distance ratio whose lists hold TARGET_RECALL of the sample queries' neighbours."""
        m, self.floor = len(self.graph.c), 1e-300
        if m == 1 or len(sample) <= k + 1:
            return np.inf, m
        ask = np.unique(np.linspace(0, len(sample) - 1, min(256, len(sample))).astype(int))
        scores = sample[ask] @ sample.T
        scores[np.arange(len(ask)), ask] = -np.inf
        truth = np.argpartition(-scores, k, axis=1)[:, :k]
        homes, _ = self.assign(x)
        q = np.concatenate([sample[ask], np.zeros((len(ask), 1))], axis=1)
        ids, dist = self.graph.nearest(q, m)
        self.floor = max(float(np.median(dist[:, 0])), 1e-300)
        far = np.full((len(ask), m), np.inf)        # ratio at which a query reaches each list
        np.put_along_axis(far, ids, dist / np.maximum(dist[:, :1], self.floor), axis=1)
        member = np.zeros((len(sample), m), bool)
        for j in range(homes.shape[1]):
            ok = homes[:, j] >= 0
            member[np.flatnonzero(ok), homes[ok, j]] = True
        needed = np.sort(np.where(member[truth], far[:, None, :], np.inf).min(2).ravel())
        ratio = float(needed[min(len(needed) - 1, int(np.ceil(TARGET_RECALL * len(needed))))]) * (1 + 1e-9)
        return ratio, int(min(m, 1.25 * (far <= ratio).sum(1).max() + 4))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists of each lifted vector, -1 where there are fewer; ``ROWS`` vectors at a time."""
        if len(x) > ROWS:
            parts = [self.assign(x[at:at + ROWS]) for at in range(0, len(x), ROWS)]
            return tuple(np.concatenate(p) for p in zip(*parts))
        ids, dist = self.graph.nearest(x, min(len(self.graph.c), 2 * REPLICAS))
        ids, dist = ids[:, :REPLICAS], dist[:, :REPLICAS]
        near = dist <= dist[:, :1] * (1 + BOUNDARY) ** 2 + 1e-12
        return np.where(near, ids, -1), dist

    def probe(self, q: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
        """Lists within the ratio, and in any case the nearest ones that hold ``least`` rows together
        (a query that sits on a centroid counts as far from it as a usual one)."""
        q = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        ids, dist = self.graph.nearest(q, self.breadth)
        if self.breadth < len(sizes) and (sizes[ids].sum(1) < least).any():
            ids, dist = self.graph.nearest(q, len(sizes))
        before = np.cumsum(sizes[ids], axis=1) - sizes[ids]
        within = dist <= np.maximum(dist[:, :1], self.floor) * self.ratio + 1e-12
        return np.where(within | (before < least), ids, -1)


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), dim)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): one row per id whose vector takes part."""
    v = F.col("vec")
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0)).alias("vec"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                   & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
                   & F.exists(v, lambda x: x != 0)))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for each row for which ``is_query`` (a column over ``vec_id``) holds."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = cut(usable(vectors, id_col, vec_col))
    dims = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0]["d"]
    rows = rows.where(F.size("vec") == dim)
    # a class per distinct vector: named by its smallest id, keeping the k + 1 smallest ids
    first = Window.partitionBy("vec").orderBy("vec_id")
    classes = cut(rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
                  .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                  .select(F.col("ids")[0].alias("cid"), "ids", "vec"))
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(norm2)).alias("norm")).first()
    sample = matrix(classes.orderBy(F.xxhash64("cid")).limit(MAX_SAMPLE).select("vec").toArrow().column(0).combine_chunks(), dim)
    index = spark.sparkContext.broadcast(Index(sample, facts["n"], facts["norm"], k))   # MAX_LISTS centroids at most
    # queries: every asking row, by the class of its vector
    asks = rows.where(is_query(F.col("vec_id"))).join(classes.select("cid", "vec"), "vec").select("vec_id", "cid")
    asks = cut(asks)
    asked = asks.select("cid").distinct().join(classes.select("cid", "vec"), "cid")

    def to_lists(sizes=None):
        def run(batches):
            ix = index.value
            for b in batches:
                for at in range(0, b.num_rows, ROWS):
                    part = b.slice(at, ROWS)
                    x = matrix(part.column(1), dim)
                    lists = ix.assign(ix.lift(x))[0] if sizes is None else ix.probe(x, sizes, REPLICAS * (k + 1))
                    row, col = np.nonzero(lists >= 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lists[row, col].astype(np.int64)), part.column(0).take(pa.array(row)),
                         part.column(1).take(pa.array(row))], ["list", "cid", "vec"])
        return run

    kind = "list long, cid long, vec array<double>"
    chunk = max(32, BLOCK_BYTES // (8 * dim))

    def chunks(members: DataFrame, tag: str) -> DataFrame:
        """Members of each list in chunks of about ``chunk`` rows, packed as binary columns of one row."""
        sizes = members.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("c"))   # MAX_LISTS rows at most
        return (members.join(F.broadcast(sizes), "list")
                .groupBy("list", F.pmod(F.xxhash64("cid"), "c").alias("salt"))
                .agg(F.collect_list(F.struct("cid", "vec")).alias("rows"))
                .select("list", F.col("rows")["cid"].alias(f"{tag}_ids"), F.flatten(F.col("rows")["vec"]).alias(f"{tag}_vecs")))

    members = cut(classes.select("cid", "vec").mapInArrow(to_lists(), kind))
    sizes = np.zeros(len(index.value.graph.c), np.int64)
    for r in members.groupBy("list").count().collect():     # MAX_LISTS rows at most
        sizes[r["list"]] = r["count"]
    lists = chunks(members, "b")
    wanted = chunks(cut(asked.mapInArrow(to_lists(sizes), kind)), "q")

    def score(batches):
        # the best k + 1 classes of each query over all blocks of the task, replicas counted once
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for i in range(b.num_rows):
                q_ids, q, b_ids, x = (np.asarray(b.column(j)[i].values) for j in range(4))
                s = q.reshape(len(q_ids), dim) @ x.reshape(len(b_ids), dim).T
                keep = min(k + 1, len(b_ids))
                least = -np.partition(-s, keep - 1, axis=1)[:, keep - 1]        # ties with the last one stay
                for j, qid in enumerate(q_ids.tolist()):
                    known = best.get(qid)
                    full = known is not None and len(known[0]) > k
                    at = np.flatnonzero(s[j] >= (max(least[j], known[0][-1]) if full else least[j]))
                    if not len(at):
                        continue
                    found_s, found_c = (s[j, at], b_ids[at]) if known is None else (np.append(known[0], s[j, at]), np.append(known[1], b_ids[at]))
                    order = np.lexsort((found_c, -found_s))
                    _, once = np.unique(found_c[order], return_index=True)
                    order = order[np.sort(once)][:k + 1]
                    best[qid] = found_s[order], found_c[order]
        qids = list(best)
        for at in range(0, len(qids), 1024):
            part = qids[at:at + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part, [len(best[i][0]) for i in part])), pa.array(np.concatenate([best[i][1] for i in part])),
                                              pa.array(np.concatenate([best[i][0] for i in part]))], ["qid", "cid", "score"])

    found = (wanted.join(lists, "list").select("q_ids", "q_vecs", "b_ids", "b_vecs")
             .mapInArrow(score, "qid long, cid long, score double"))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    # replicas of a candidate: at most REPLICAS rows of it; rank enough rows, then keep one of each
    top = (found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= REPLICAS * (k + 1))
           .groupBy("qid", "cid").agg(F.max("score").alias("score")))
    answer = (top.join(classes.select("cid", "ids"), "cid")
              .groupBy("qid").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
              .select("qid", F.flatten(F.transform("found", lambda f: F.transform(
                  f["ids"], lambda i: F.struct((-f["score"]).alias("less"), i.alias("vec_id"))))).alias("all"))
              .select("qid", F.slice(F.array_sort("all"), 1, k + 1).alias("all")))
    named = asks.withColumnRenamed("vec_id", "query_id").join(answer, asks["cid"] == answer["qid"])
    return (named.select("query_id", F.posexplode(F.slice(
                F.filter("all", lambda a: a["vec_id"] != F.col("query_id")), 1, k)).alias("p", "a"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("a")["vec_id"].alias("vec_id"),
                    (-F.col("a")["less"]).alias("score")))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0, 20)


QUERIES = {"op1_ann": op1_ann}
SQL: dict[str, str] = {}
