"""Quality rules: boosted trees over document statistics.

Every document gets exact counts (words, symbols, repeated lines, repeated
five-word windows) and a vector of ratios derived from them.  Gradient-boosted
trees are fitted with Newton steps on the ratios of a bounded sample of
labelled documents; chosen ratios are constrained to lower the score only.
The trees are flattened into numpy node arrays, so that a batch of documents
walks all trees at once, one level per step.

Defined results: a null or empty text has no words, fails the base rule and is
rejected.  Repeated rows are judged one by one.  With no usable labels (empty
table, null or single-class labels) the base rule alone decides.  Extra
columns pass through.  Texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, fresh, table

#: Most labelled documents the trees are fitted on (chosen by a hash of doc_id).
MAX_TRAIN = 20_000
#: A document is kept from this probability of good quality on.
THRESHOLD = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratio names and the direction in which each may move the score (0: free).
FEATURES = (("log_words", 0), ("mean_word", 0), ("symbol_share", -1), ("dup_line_share", -1),
            ("repeat_share", -1), ("upper_share", -1), ("digit_share", -1), ("punct_share", 0),
            ("shout_share", -1), ("distinct_share", 0), ("line_words", 0), ("ends_share", 0))
MONOTONE = tuple(d for _, d in FEATURES)

_SPACE = np.array([9, 10, 11, 12, 13, 32])
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_PUNCT = np.frombuffer(b".,;:!?'\"()-", np.uint8)
_ENDS = np.frombuffer(b".!?", np.uint8)


def repeated_positions(ids: np.ndarray, n_distinct: int, window: int = 5) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    m = len(ids) - window + 1
    if m < 2:
        return 0
    key = ids[:m].astype(np.int64)
    top = max(n_distinct, 1)
    for k in range(1, window):
        if top * max(n_distinct, 1) >= 2 ** 62:     # renumber before the key would overflow
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            top = int(key.max()) + 1
        key = key * n_distinct + ids[k:m + k]
        top *= max(n_distinct, 1)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(m, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[list[int], list[float]]:
    """The five exact counts and the ratios of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()                 # bytes split on exactly the six ASCII white-space bytes
    n = len(words)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(hist[128:192].sum())
    chars = points - int(hist[_SPACE].sum())
    symbols = int(hist[_SYMBOLS].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    rep = repeated_positions(ids, len(number))
    d, c = max(n, 1), max(chars, 1)
    ratios = [float(np.log1p(n)), chars / d, symbols / d, dup / max(len(lines), 1), rep / d,
              float(hist[65:91].sum()) / c, float(hist[48:58].sum()) / c, float(hist[_PUNCT].sum()) / d,
              float(hist[33]) / d, len(number) / d, n / max(len(lines), 1), float(hist[_ENDS].sum()) / d]
    return [n, chars, symbols, dup, rep], ratios


def with_counts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus one struct column: the counts as longs, ``ratios`` as an array."""
    name = fresh("counts")
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]
                        + [T.StructField("ratios", T.ArrayType(T.DoubleType()))])

    def make():
        def work(texts: pa.Array) -> list:
            rows = [text_counts(t.as_py()) for t in texts]
            return [[dict(zip(COUNTS, c), ratios=r) for c, r in rows]]
        return work

    return append(docs, [text_col], [(name, kind)], make), name


@dataclass
class Trees:
    """Flattened trees; leaves point to themselves.  ``root`` has each tree's first node."""
    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        node = np.repeat(self.root[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(go, self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x))) if len(x) else np.zeros(0)


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: tuple[int, ...] = MONOTONE, n_trees: int = 40,
              depth: int = 3, rate: float = 0.25, bins: int = 48, l2: float = 1.0,
              min_rows: int = 10) -> Trees:
    """Newton boosting on the log loss with histogram splits.

    A split on a constrained feature is taken only if the children's values
    are ordered that way; the middle of both values then bounds all that lies
    below, so the whole tree is monotone in the feature.
    """
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(k)], axis=1)
    mean = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(n, base)
    feat, thr, left, right, val, roots = [], [], [], [], [], []

    def node() -> int:
        i = len(feat)
        for a, v in ((feat, 0), (thr, 0.0), (left, i), (right, i), (val, 0.0)):
            a.append(v)
        return i

    def best_split(rows, g, h, lo, hi):
        best = (1e-9, None)
        gs, hs = g[rows].sum(), h[rows].sum()
        whole = gs * gs / (hs + l2)
        for j in range(k):
            if not len(cuts[j]):
                continue
            m = len(cuts[j]) + 1
            gj = np.cumsum(np.bincount(code[rows, j], g[rows], m))[:-1]
            hj = np.cumsum(np.bincount(code[rows, j], h[rows], m))[:-1]
            nj = np.cumsum(np.bincount(code[rows, j], minlength=m))[:-1]
            vl = np.clip(-gj / (hj + l2), lo, hi)
            vr = np.clip(-(gs - gj) / (hs - hj + l2), lo, hi)
            gain = gj ** 2 / (hj + l2) + (gs - gj) ** 2 / (hs - hj + l2) - whole
            ok = (nj >= min_rows) & (len(rows) - nj >= min_rows)
            if monotone[j]:
                ok &= (vr - vl) * monotone[j] >= 0
            gain = np.where(ok, gain, -1.0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (j, i, vl[i], vr[i]))
        return best[1]

    def grow(i, rows, g, h, lo, hi, level):
        split = best_split(rows, g, h, lo, hi) if level < depth and len(rows) >= 2 * min_rows else None
        if split is None:
            val[i] = rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), lo, hi))
            margin[rows] += val[i]
            return
        j, b, vl, vr = split
        feat[i], thr[i] = j, float(cuts[j][b])
        go = code[rows, j] <= b
        mid = (vl + vr) / 2
        bounds = [(lo, hi), (lo, hi)]
        if monotone[j] > 0:
            bounds = [(lo, mid), (mid, hi)]
        elif monotone[j] < 0:
            bounds = [(mid, hi), (lo, mid)]
        a = left[i] = node()
        grow(a, rows[go], g, h, *bounds[0], level + 1)
        b2 = right[i] = node()
        grow(b2, rows[~go], g, h, *bounds[1], level + 1)

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(node())
        grow(roots[-1], np.arange(n), p - y, p * (1 - p), -np.inf, np.inf, 0)
    return Trees(np.array(roots), np.array(feat), np.array(thr), np.array(left), np.array(right),
                 np.array(val), base, depth)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Trees | None:
    """Trees from at most ``max_train`` labelled documents (a hash of doc_id picks them);
    None without two classes.  Several labels of a document are averaged and rounded."""
    wanted = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.round(F.avg("quality")).cast("double").alias("__y"))
              .orderBy(F.xxhash64(F.col("doc_id")), "doc_id").limit(max_train))
    # at most max_train ids and labels: a bounded broadcast
    own = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    counted, name = with_counts(own)
    got = counted.select("doc_id", "__y", F.col(name)["ratios"].alias("x")) \
        .orderBy("doc_id", "x").limit(max_train).collect()
    y = np.array([r["__y"] for r in got])
    if len(y) < 2 or y.min() == y.max():
        return None
    return fit_trees(np.array([r["x"] for r in got]), y)


def judge(docs: DataFrame, trees: Trees | None, threshold: float = THRESHOLD,
          text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus one struct column: counts, ``base_failed``, ``probability``, ``kept``."""
    name = fresh("quality")
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]
                        + [T.StructField("base_failed", T.BooleanType()),
                           T.StructField("probability", T.DoubleType()),
                           T.StructField("kept", T.BooleanType())])

    def make():
        def work(texts: pa.Array) -> list:
            rows = [text_counts(t.as_py()) for t in texts]
            x = np.array([r for _, r in rows]).reshape(len(rows), len(FEATURES))
            p = trees.probability(x) if trees is not None else np.ones(len(rows))
            out = []
            for (c, _), q in zip(rows, p):
                failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
                out.append(dict(zip(COUNTS, c), base_failed=failed, probability=float(q),
                                kept=bool(not failed and q >= threshold)))
            return [out]
        return work

    return append(docs, [text_col], [(name, kind)], make), name


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, q = judge(docs, train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *(F.col(q)[c].alias(c) for c in
                                     (*COUNTS, "base_failed", "kept", "probability")))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drops the documents that the rules reject."""
    judged, q = judge(docs, train(docs, table(spark, sf_dir, "labels")))
    return judged.where(F.col(q)["kept"]).select(*docs.columns)


QUERIES = {"op7_quality_rules": op7_quality_rules}
SQL: dict[str, str] = {}
