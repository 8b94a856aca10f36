"""Hard negatives: rows of other labels that score almost as high as an anchor's positives, found exactly by cover trees.

Components are floored multiples (``SCALE``), so scores are integers and exact.
For each anchor the positives are its best rows of the same label; the
negatives of a positive are the best rows of other labels whose score lies in
the window from ``LOW`` to ``HIGH`` hundredths of the positive's score.

* Vectors are augmented by ``sqrt(max_norm^2 - norm^2)``, which puts all on one
  sphere; an anchor has 0 there, so its inner products stay.  The top tier of
  the cover tree is fitted on a bounded sample (pivots, farthest first) and
  deals every row to the nearest pivot's cell.  Each cell is stored in blocks of
  bounded size, each with its own cover tree: the members of a node lie within
  half its parent's covering radius.
* A node's members score within ``|q| * reach`` of its centre (``reach``: the
  largest distance of a member from the centre, without the augmented
  component, in which an anchor is 0).  An anchor visits the cells, and descends
  best first into the nodes, whose interval meets a window of its own and can
  still beat the rows found; every row met is verified with its exact score.
  Sample rows give the first thresholds.
* Equal vectors of one label are one class that keeps its ``k + 1`` smallest
  ids: equal rows score alike and ties go to smaller ids.  Anchors of a class are
  searched once and are spread over several keys where there are many.

Search work is anchors times the blocks that are not excluded; on vectors that
are uniform on a sphere nothing can be excluded.

Defined results: rows with a null id or label, a null vector, a null or
non-finite component, another dimension than the most frequent one (ties: the
smaller), or whose squared integer norm reaches 2^62 (scores would not fit a
long) take no part.  Rows repeating an id count once (the smallest label, then
vector).  A negative positive score has an empty window.  An anchor without
positives or negatives gives no rows, nor does an empty table.  Extra columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import cut, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: LOW * positive <= 100 * negative <= HIGH * positive.
LOW, HIGH = 80, 100
SAMPLE, PIVOTS = 4096, 64       # rows the top tier is fitted on, and its cells at most
BLOCK, LEAF = 2048, 16          # rows of a block's tree, members that are not split further
CHUNK = 256                     # anchors that meet a block together
SLOTS = 128                     # keys that a cell's blocks are dealt over, all cells together
SPREAD = 10_000                 # anchors of one class per key
NEVER = np.iinfo(np.int64).min


def usable(rows: DataFrame, label: Column, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, label, vec): one row per id that takes part, integer components."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE))
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return (rows.where(v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (norm2 < 2.0 ** 62))
            .groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec"))


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(vectors.flatten(), np.int64).reshape(len(vectors), dim)


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def lifted(x: np.ndarray, norm: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(norm ** 2 - (x ** 2).sum(1), 0))[:, None]], axis=1)


def exact(x: np.ndarray, norm: float) -> np.ndarray:
    """Doubles where every inner product is exact in doubles, else integers."""
    return x.astype(np.float64) if norm ** 2 < 2.0 ** 52 else x


def apart(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - c) ** 2).sum(1))


def farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``x``, each the farthest from those before it: the top levels of a cover tree."""
    rows, d = [0], apart(x, x[0])
    while len(rows) < n and d.max() > 0:
        rows.append(int(d.argmax()))
        d = np.minimum(d, apart(x, x[rows[-1]]))
    return np.array(rows)


class Tree:
    """A cover tree over the rows of a block.

    Node ``i`` has the entries ``start[i]`` to ``start[i + 1]``: the centre's
    ``row``, the ``node`` of its members (-1: none), their ``reach`` and whether
    the centre is ``new``, that is met here first.
    """

    FIELDS = {"start": np.int64, "row": np.int64, "node": np.int64, "reach": np.float64, "new": np.int64}

    def __init__(self, **arrays):
        self.__dict__.update(arrays)

    @classmethod
    def grow(cls, x: np.ndarray, norm: float) -> Tree:
        up, flat = lifted(x, norm), x.astype(np.float64)
        root = int(apart(up, up.mean(0)).argmin())
        todo = [(root, np.delete(np.arange(len(x)), root))]
        start, row, node, reach, new = [0], [], [], [], []
        for centre, members in todo:            # grows while it is read
            parts = cls._cover(up, centre, members)
            if centre == root and len(start) == 1:
                parts.insert(0, (root, members[:0], True))
            for c, inside, first in parts:
                row.append(c)
                new.append(int(first))
                node.append(len(todo) if len(inside) else -1)
                reach.append(float(apart(flat[inside], flat[c]).max()) * (1 + 1e-9) + 1e-9 * norm if len(inside) else 0.0)
                if len(inside):
                    todo.append((c, inside))
            start.append(len(row))
        values = (start, row, node, reach, new)
        return cls(**{k: np.array(v, t) for (k, t), v in zip(cls.FIELDS.items(), values)})

    @staticmethod
    def _cover(up: np.ndarray, centre: int, members: np.ndarray) -> list[tuple[int, np.ndarray, bool]]:
        """(centre, its members, met first) for balls of half the covering radius."""
        none = members[:0]
        d = apart(up[members], up[centre])
        if len(members) <= LEAF or d.max() == 0:
            return [(int(m), none, True) for m in members]
        half = d.max() / 2
        out = [(centre, members[d <= half], False)] if (d <= half).any() else []
        rest = members[d > half][np.argsort(-d[d > half], kind="stable")]
        p = up[rest]
        n2 = (p ** 2).sum(1)
        near = n2[:, None] + n2[None, :] - 2 * p @ p.T <= half ** 2
        alive = np.ones(len(rest), bool)
        for i in range(len(rest)):
            if alive[i]:
                ball = alive & near[i]
                alive[ball] = False
                ball[i] = alive[i] = False
                out.append((int(rest[i]), rest[ball], True))
        return out

    def search(self, x, ids, counts, q, size, lows, highs, k, first) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window the best ``k`` rows (scores, rows) that count, ties to smaller ``ids``.

        ``counts`` marks the rows that may be found, ``first`` has the scores of
        the root's entries, ``size`` is the length of ``q``.
        """
        low = list(lows)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
        heap = [(-np.inf, np.inf, 0)]
        while heap:
            less, under, at = heapq.heappop(heap)
            if -less < min(low):
                break                           # best first: nothing better is left
            if not any(-less >= a and under_ok(under, b) for a, b in zip(low, highs)):
                continue
            span = slice(self.start[at], self.start[at + 1])
            row = self.row[span]
            score = first if at == 0 else (x[row] @ q)
            may = counts[row] & (self.new[span] == 1)
            for w, top in enumerate(highs):
                pick = np.flatnonzero(may & (score >= low[w]) & (score <= top))
                if not len(pick):
                    continue
                s = np.concatenate([found[w][0], score[pick].astype(np.int64)])
                r = np.concatenate([found[w][1], row[pick]])
                if len(s) > k:
                    order = np.lexsort((ids[r], -s))[:k]
                    s, r = s[order], r[order]
                if len(s) == k:
                    low[w] = max(low[w], int(s.min()))
                found[w] = s, r
            inner = self.node[span] >= 0
            if inner.any():
                mid, wide = score[inner], size * self.reach[span][inner]
                for hi, lo, n in zip(mid + wide, mid - wide, self.node[span][inner]):
                    if any(hi >= a and under_ok(lo, b) for a, b in zip(low, highs)):
                        heapq.heappush(heap, (-hi, lo, int(n)))
        return found


def under_ok(lowest: float, top: float) -> bool:
    """Whether an interval from ``lowest`` up (infinite: unknown) reaches down to ``top``."""
    return lowest <= top or lowest == np.inf


class Top:
    """The top tier: pivots, sample rows for first thresholds and, once known, each cell's reach and slots."""

    def __init__(self, sample: np.ndarray, labels: np.ndarray, norm: float, total: int):
        self.norm, self.dim = norm, sample.shape[1]
        self.sample, self.labels = exact(sample, norm), labels
        up = lifted(sample, norm)
        self.pivots = farthest_first(up, max(1, min(PIVOTS, total // BLOCK)))
        self.up = up[self.pivots]
        self.reach = self.slots = None

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each row and the distance to it without the augmented component."""
        up = lifted(x, self.norm)
        d = (up ** 2).sum(1)[:, None] + (self.up ** 2).sum(1)[None, :] - 2 * up @ self.up.T
        own = d.argmin(1)
        return own, apart(up[:, :-1], self.up[own, :-1])

    def tightened(self, scores: np.ndarray, label: int, same: bool, low: int, high: int, k: int) -> int:
        """A lower bound of the k-th best score in the window, from the sample's scores."""
        ok = ((self.labels == label) == same) & (scores >= low) & (scores <= high)
        s = scores[ok]
        return max(low, int(np.partition(s, len(s) - k)[len(s) - k])) if len(s) >= k else low

    def visits(self, mid: np.ndarray, size: float, lows: list[int], highs: list[int]) -> np.ndarray:
        """Cells whose interval meets a window; ``mid``: the pivots' scores."""
        wide = size * (self.reach * (1 + 1e-9) + 1e-9 * self.norm)
        ok = np.zeros(len(mid), bool)
        for a, b in zip(lows, highs):
            ok |= (mid + wide >= a) & (mid - wide <= b)
        return np.flatnonzero(ok & (self.slots > 0))


def floors(positive: np.ndarray) -> np.ndarray:
    """The smallest integer score of the windows."""
    return -((-LOW * positive) // 100)


def tops(positive: np.ndarray) -> np.ndarray:
    return (HIGH * positive) // 100


def searched(asks: DataFrame, blocks: DataFrame, top, same: bool, k: int) -> DataFrame:
    """(qid, window, cid, score): per block the best ``k`` classes in each window of each asking class.

    ``asks``: (qid, label, vec, windows), where a window is a positive's score,
    or null for one without bounds.
    """
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Top = top.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                if not part.num_rows:
                    continue
                q = matrix(part.column("vec"), t.dim)
                size = lengths(q)
                q = exact(q, t.norm)
                seen, mids = q @ t.sample.T, q @ t.sample[t.pivots].T
                row, cell, lows, highs = [], [], [], []
                for i, (label, wins) in enumerate(zip(part.column("label").to_pylist(), part.column("windows").to_pylist())):
                    if wins is None:
                        high = [np.iinfo(np.int64).max]
                        low = [t.tightened(seen[i], label, same, NEVER, high[0], k)]
                    else:
                        w = np.array(wins, np.int64)
                        high = tops(w).tolist()
                        low = [t.tightened(seen[i], label, same, a, z, k) for a, z in zip(floors(w).tolist(), high)]
                    for c in t.visits(mids[i], size[i], low, high):
                        for s in range(t.slots[c]):
                            row.append(i), cell.append((int(c), s)), lows.append(low), highs.append(high)
                if row:
                    take = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c for c, _ in cell], pa.int32()), pa.array([s for _, s in cell], pa.int32()), take.column("qid"), take.column("label"),
                         take.column("vec"), take.column("windows"), pa.array(lows, pa.list_(pa.int64())), pa.array(highs, pa.list_(pa.int64()))],
                        ["cell", "slot", "qid", "label", "vec", "windows", "lows", "highs"])

    routed = cut(asks.mapInArrow(route, "cell int, slot int, qid long, label long, vec array<long>, windows array<long>, lows array<long>, highs array<long>"))
    sizes = routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))        # PIVOTS rows at most
    chunks = (routed.join(F.broadcast(sizes), "cell")
              .groupBy("cell", "slot", F.pmod(F.xxhash64("qid"), "parts").alias("part"))
              .agg(F.collect_list(F.struct("qid", "label", "vec", "windows", "lows", "highs")).alias("q"))
              .select("cell", "slot", *(F.col("q")[c].alias(f"q_{c}") for c in ("qid", "label", "windows", "lows", "highs")),
                      F.flatten(F.col("q")["vec"]).alias("q_vec")))
    both = chunks.join(blocks, ["cell", "slot"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Top = top.value
        for b in batches:
            for i in range(b.num_rows):
                col = lambda c: b.column(c)[i]
                arr = lambda c: np.asarray(col(c).values)  # noqa: E731, B023
                cids, labels = arr("cids"), arr("labels")
                x = exact(arr("vecs").reshape(len(cids), t.dim), t.norm)
                qids, q_labels = arr("q_qid"), arr("q_label")
                whole = arr("q_vec").reshape(len(qids), t.dim)
                q, size = exact(whole, t.norm), lengths(whole)
                tree = Tree(**{f: arr(f) for f in Tree.FIELDS})
                first = q @ x[tree.row[:tree.start[1]]].T
                out: list[tuple] = []
                for j, (wins, lows, highs) in enumerate(zip(col("q_windows").as_py(), col("q_lows").as_py(), col("q_highs").as_py())):
                    found = tree.search(x, cids, (labels == q_labels[j]) == same, q[j], size[j], lows, highs, k, first[j])
                    for w, (s, r) in enumerate(found):
                        if len(s):
                            out.append((np.full(len(s), qids[j]), [None if wins is None else wins[w]] * len(s), cids[r], s))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([o[0] for o in out])), pa.array([w for o in out for w in o[1]], pa.int64()),
                         pa.array(np.concatenate([o[2] for o in out])), pa.array(np.concatenate([o[3] for o in out]))],
                        ["qid", "window", "cid", "score"])

    return both.mapInArrow(score, "qid long, window long, cid long, score long")


def best_rows(found: DataFrame, classes: DataFrame, k: int, by: list[str]) -> DataFrame:
    """(by, best): the first ``k`` (score, vec_id) of what the blocks found."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "cid")
    top = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    return (top.join(classes.select("cid", "ids"), "cid").groupBy(*by).agg(F.collect_list(F.struct("score", "ids")).alias("f"))
            .select(*by, F.slice(F.array_sort(F.flatten(F.transform("f", lambda f: F.transform(
                f["ids"], lambda i: F.struct((-f["score"]).alias("less"), i.alias("vec_id")))))), 1, k).alias("best")))


def mine(rows: DataFrame, is_anchor: Callable[[Column], Column], label: Column, positives: int = POSITIVES,
         negatives: int = NEGATIVES, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows for which ``is_anchor`` (of ``vec_id``) holds."""
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    valid = cut(usable(rows, label, id_col, vec_col))
    dims = valid.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0]["d"]
    valid = valid.where(F.size("vec") == dim)
    same = Window.partitionBy("vec", "label").orderBy("vec_id")
    keep = max(positives + 1, negatives)
    classes = cut(valid.withColumn("r", F.row_number().over(same)).where(F.col("r") <= keep)
                  .groupBy("vec", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                  .select(F.col("ids")[0].alias("cid"), "ids", "label", "vec"))
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(norm2)).alias("norm")).first()
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("label", "vec").toArrow().combine_chunks()
    tier = Top(matrix(sample["vec"].combine_chunks(), dim), np.asarray(sample["label"]), facts["norm"], facts["n"])
    first = spark.sparkContext.broadcast(tier)              # SAMPLE rows at most

    def deal(batches):
        t: Top = first.value
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                if part.num_rows:
                    cell, far = t.cells(matrix(part.column("vec"), dim))
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(far), *part.columns], ["cell", "far", "cid", "label", "vec"])

    dealt = cut(classes.select("cid", "label", "vec").mapInArrow(deal, "cell int, far double, cid long, label long, vec array<long>"))
    cells = dealt.groupBy("cell").agg(F.max("far").alias("reach"), F.count(F.lit(1)).alias("n")).collect()     # PIVOTS rows at most
    tier.reach, tier.slots = np.zeros(len(tier.pivots)), np.zeros(len(tier.pivots), int)
    parts = {}
    for r in cells:
        parts[r["cell"]] = blocks = -(-r["n"] // BLOCK)
        tier.reach[r["cell"]] = r["reach"]
        tier.slots[r["cell"]] = min(blocks, max(1, round(SLOTS * r["n"] / facts["n"])))
    top = spark.sparkContext.broadcast(tier)
    many = F.create_map(*(F.lit(int(v)) for c, n in parts.items() for v in (c, n)))[F.col("cell")]
    slots = F.create_map(*(F.lit(int(v)) for c in parts for v in (c, tier.slots[c])))[F.col("cell")]

    def grow(batches):
        t: Top = top.value
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                x = np.asarray(row.column("vecs")[0].values).reshape(len(row.column("cids")[0]), dim)
                tree = Tree.grow(x, t.norm)
                yield pa.RecordBatch.from_arrays([*row.columns, *(pa.array([getattr(tree, f)]) for f in Tree.FIELDS)], [*row.schema.names, *Tree.FIELDS])

    packed = (dealt.groupBy("cell", F.pmod(F.xxhash64("cid"), many).alias("block")).agg(F.collect_list(F.struct("cid", "label", "vec")).alias("m"))
              .select("cell", F.pmod("block", slots).cast("int").alias("slot"), F.col("m")["cid"].alias("cids"), F.col("m")["label"].alias("labels"),
                      F.flatten(F.col("m")["vec"]).alias("vecs")))
    blocks = cut(packed.mapInArrow(grow, "cell int, slot int, cids array<long>, labels array<long>, vecs array<long>, "
                                         "start array<long>, row array<long>, node array<long>, reach array<double>, new array<long>"))

    anchors = valid.where(is_anchor(F.col("vec_id")))
    counted = anchors.groupBy("vec", "label").agg(F.ceil(F.count(F.lit(1)) / SPREAD).cast("int").alias("keys"))
    asking = cut(counted.join(classes, ["vec", "label"]).select(F.col("cid").alias("qid"), "label", "vec", "keys"))
    salt = F.explode(F.sequence(F.lit(0), F.col("keys") - 1)).alias("salt")
    spread = F.pmod(F.xxhash64("vec_id"), F.col("keys")).cast("int").alias("salt")
    # few classes have more than one key; an anchor finds its class by (vector, label, salt)
    salted = anchors.join(counted.where("keys > 1"), ["vec", "label"], "left").select("vec_id", "vec", "label", F.coalesce(spread, F.lit(0)).alias("salt"))
    named = cut(salted.join(asking.select("qid", "vec", "label", salt), ["vec", "label", "salt"]).select(F.col("vec_id").alias("anchor_id"), "qid", "salt"))

    k = positives + 1
    found = searched(asking.select("qid", "label", "vec", F.lit(None).cast("array<long>").alias("windows")), blocks, top, True, k)
    good = cut(best_rows(found, classes, k, ["qid"]).join(asking.select("qid", "label", "vec", "keys"), "qid"))
    windows = F.array_distinct(F.transform("best", lambda p: -p["less"]))
    wanted = good.select("qid", "label", "vec", F.filter(windows, lambda w: w >= 0).alias("windows")).where(F.size("windows") > 0)
    bad = cut(best_rows(searched(wanted, blocks, top, False, negatives), classes, negatives, ["qid", "window"]))

    answer = (good.select("qid", "keys", F.explode(F.transform("best", lambda p: -p["less"])).alias("window")).distinct()
              .join(bad, ["qid", "window"]).groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("window", "best"))).alias("bad"))
              .join(good.select("qid", "best", "keys"), "qid").select("qid", "best", "bad", salt))
    own = named.join(answer, ["qid", "salt"])
    pairs = own.select("anchor_id", "bad", F.explode(F.slice(F.filter("best", lambda p: p["vec_id"] != F.col("anchor_id")), 1, positives)).alias("p"))
    return (pairs.select("anchor_id", "p", F.posexplode(F.try_element_at("bad", -F.col("p")["less"])).alias("i", "n"))
            .select("anchor_id", F.col("p")["vec_id"].alias("positive_id"), (F.col("i") + 1).cast("int").alias("rank"), F.col("n")["vec_id"].alias("negative_id"),
                    (-F.col("p")["less"]).alias("positive_score"), (-F.col("n")["less"]).alias("negative_score")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(100)) == 0, label)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}
SQL = {"op13_hard_negatives": """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5"""}
