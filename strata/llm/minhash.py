"""Near-duplicate documents by b-bit MinHash.

* A document's set: the distinct hashes of its five-word shingles.  Documents
  with equal sets are one class; classes are what is compared.
* Signature: ``HASHES`` minima of which the low ``BITS`` bits are kept, packed
  into a few words.  Bands of full minima give candidate buckets: at a
  similarity of 0.75 a pair shares no bucket with probability about 5e-6.
* Buckets of up to ``SMALL`` classes pair all members.  In a larger one the
  member that most others meet (the largest sum of bucket sizes) is the
  centre, and each member is paired with it only.  What is then outside the
  centre's component is compared with all members that have this centre, chunk
  by chunk on full sets, so no link between different texts is lost and only
  links leave a task.
* Candidates whose collision-corrected estimate is under ``LEAST`` (six standard
  deviations below the threshold) fall away; the rest are confirmed on full sets.

Defined results: a null or wordless text has the empty set, stands alone and
keeps its own id.  A text under five words is one shingle.  Repeated rows and
ids are members of their sets' classes; a row without id takes part and is
kept only if its whole group has no id.  ``kept`` speaks of the id; the pipeline
stage decides by row and leaves one of each group, also of rows that share an
id or have none.  An empty table gives no rows.  Extra columns are ignored.
Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, cut, fresh, lean, release, table
from strata.llm.components import components

SHINGLE = 5
HASHES, BANDS, BITS = 128, 32, 4
SMALL = 16
#: Sets compared with as many others in one step.
CHUNK = 128
LEAST = 0.5
#: Links: LINK[0] * intersection >= LINK[1] * union.
LINK = (100, 75)

_RNG = np.random.default_rng(20240229)
_MULT = _RNG.integers(1, 2 ** 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(0, 2 ** 63, HASHES, dtype=np.uint64)
_STEP = [np.uint64(pow(0x9E3779B97F4A7C15, k, 2 ** 64)) for k in range(1, SHINGLE + 1)]
_CACHE = 500_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _CACHE:
            self.clear()
        self[word] = h
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(split)
    if not n:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(words.__getitem__, split), np.uint64, n)
    size = min(n, k)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total += own[i:n - size + 1 + i] * _STEP[i]
    return np.unique(mixed(total))


def minima(items: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 512):
        np.minimum(out, ((items[at:at + 512, None] ^ _FLIP) * _MULT).min(axis=0), out=out)
    return out


def packed(mins: np.ndarray, bits: int = BITS) -> bytes:
    """The low bits (after mixing) of every minimum, side by side."""
    low = (mixed(mins) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    each = 8 // bits
    return sum((low[i::each].astype(np.uint16) << (bits * i)) for i in range(each)).astype(np.uint8).tobytes()


def estimate(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Collision-corrected similarity of packed signatures (rows of bytes), by bit counts."""
    x = (a ^ b).view(np.uint64)
    shift = 1
    while shift < bits:                 # or of each field's bits into its lowest one
        x = x | (x >> np.uint64(shift))
        shift *= 2
    field = int("0" * (bits - 1) + "1", 2)
    mask = np.uint64(sum(field << (bits * i) for i in range(64 // bits)))
    same = 1 - np.bitwise_count(x & mask).sum(axis=1) / HASHES
    chance = 2.0 ** -bits
    return (same - chance) / (1 - chance)


def text_key() -> Column:
    """Equal for equal texts only; null for a null text."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def smallest() -> Column:
    """The first (doc_id, tk) of rows: ids before none, then by id and text."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("tk")))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, n, node, sig, bands): per row the text's digest, the set's size, digest, packed signature and band hashes."""
    fields = [("n", T.LongType()), ("node", T.BinaryType()), ("sig", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))]

    def make():
        words = WordHashes()
        lanes = np.arange(1, BANDS + 1, dtype=np.uint64)

        def work(texts: pa.Array) -> list:
            n, node, sig, bands = [], [], [], []
            for t in texts:
                s = shingles(t.as_py(), words)
                n.append(len(s))
                if not len(s):
                    node.append(None), sig.append(None), bands.append(None)
                    continue
                m = minima(s)
                rows = m.reshape(BANDS, -1)
                h = lanes.copy()
                for i in range(rows.shape[1]):
                    h = mixed(h * _STEP[1] + rows[:, i])
                node.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig.append(packed(m))
                bands.append(h.view(np.int64))
            return [n, node, sig, bands]
        return work

    return append(docs.select("doc_id", text_key().alias("tk"), "text"), ["text"], fields, make).drop("text")


def among(ids: DataFrame, doc: str, key: str) -> Callable[..., Column]:
    """A condition on (id, text key): false where ``ids`` surely has no such row, so that few texts are shuffled; a join decides."""
    from strata.llm.line_dedup import may_hold      # that module builds on this one
    held = may_hold(ids.select(F.xxhash64(doc, key)), ids.sparkSession)
    return lambda d, k: held(F.xxhash64(d, k))


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose estimated similarity reaches LEAST."""
    sig = classes.select("node", "sig")
    both = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        for x in batches:
            if x.num_rows:
                a, b = (np.frombuffer(b"".join(x.column(i).to_pylist()), np.uint8).reshape(x.num_rows, -1) for i in (2, 3))
                yield x.filter(pa.array(estimate(a, b) >= LEAST)).select(["a", "b"])

    return both.mapInArrow(lean(run), "a binary, b binary")


def sets_of(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, hashes): full sets, read again from the texts of the classes' first documents."""
    ids = cut(classes.join(nodes.distinct(), "node").select(F.col("first").alias("__id"), F.col("tk").alias("__tk"), "node"))
    wanted = among(ids, "__id", "__tk")

    def make():
        words = WordHashes()

        def work(texts: pa.Array) -> list:
            return [[shingles(t.as_py(), words).tobytes() for t in texts]]
        return work

    # an id, or none, may stand for several texts: only the class's own text counts
    rows = (docs.select("doc_id", "text", text_key().alias("tk")).where(wanted("doc_id", "tk"))
            .join(ids, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tk") == F.col("__tk"))))
    return (append(rows.select("text", "node"), ["text"], [("hashes", T.BinaryType())], make)
            .select("node", "hashes").dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are links on full sets."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b").select("a", "b", "ha", "hb"))

    def run(batches):
        for x in batches:
            keep = []
            for a, b in zip(x.column(2), x.column(3)):
                a, b = (np.frombuffer(c.as_buffer(), np.uint64) for c in (a, b))
                inter = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(LINK[0] * inter >= LINK[1] * (len(a) + len(b) - inter))
            yield x.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(lean(run), "a binary, b binary")


def across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members (centre, node, root, home) outside their centre's component and any with that centre."""
    outside = F.col("root") != F.col("home")
    mixed_ = members.where(outside).groupBy("centre").agg(F.count(F.lit(1)).alias("out"))
    sizes = cut(members.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")).join(mixed_.select("centre"), "centre"))
    part = cut(members.join(sizes, "centre").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("chunks")))
               .join(sets, "node"))

    def chunks(rows: DataFrame, tag: str) -> DataFrame:
        return cut(rows.groupBy("centre", "salt").agg(F.collect_list(F.struct("node", "root", "hashes")).alias("m"))
                   .select("centre", F.col("m")["node"].alias(f"{tag}_node"), F.col("m")["root"].alias(f"{tag}_root"),
                           F.col("m")["hashes"].alias(f"{tag}_set")))

    both = chunks(part.where(outside), "x").join(chunks(part, "y"), "centre").drop("centre")

    def run(batches):
        for rows in batches:
            for r in rows.to_pylist():
                ys = [np.frombuffer(y, np.uint64) for y in r["y_set"]]
                universe, place = np.unique(np.concatenate(ys), return_inverse=True)
                size = np.array([len(y) for y in ys])
                starts = np.concatenate([[0], np.cumsum(size)[:-1]])
                a, b = [], []
                for node, root, raw in zip(r["x_node"], r["x_root"], r["x_set"]):
                    x = np.frombuffer(raw, np.uint64)
                    at = np.minimum(np.searchsorted(universe, x), len(universe) - 1)
                    mark = np.zeros(len(universe), np.int64)
                    mark[at[universe[at] == x]] = 1
                    inter = np.add.reduceat(mark[place], starts)
                    for i in np.flatnonzero(LINK[0] * inter >= LINK[1] * (len(x) + size - inter)):
                        if r["y_root"][i] != root:
                            a.append(node)
                            b.append(r["y_node"][i])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return both.mapInArrow(lean(run), "a binary, b binary")


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tk, n, node) of all documents, and (node, root, root_first) of the classes that are linked."""
    rows = cut(sketches(docs))
    classes = cut(rows.where(F.col("node").isNotNull()).groupBy("node")
                  .agg(smallest().alias("f"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
                  .select("node", F.col("f")["doc_id"].alias("first"), F.col("f")["tk"].alias("tk"), "sig", "bands"))
    spread = classes.select("node", F.explode("bands").alias("h"))
    shared = cut(spread.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1))
    members = cut(spread.join(shared, "h"))
    small = (members.where(F.col("size") <= SMALL).groupBy("h").agg(F.sort_array(F.collect_list("node")).alias("m"))
             .select(F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(
                 F.slice(F.col("m"), i + 2, SMALL), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p"))
             .select("p.a", "p.b"))
    release(docs.sparkSession)
    large = members.where(F.col("size") > SMALL)
    crowd = cut(large.select("h", "node").join(large.groupBy("node").agg(F.sum("size").alias("score")), "node"))
    centres = cut(crowd.groupBy("h").agg(F.max(F.struct("score", "node")).alias("c")).select("h", F.col("c")["node"].alias("centre")))
    around = cut(crowd.select("h", "node").join(centres, "h").select("centre", "node").distinct())
    star = around.where(F.col("node") != F.col("centre")).select(*ordered(F.col("node"), F.col("centre")))
    pairs = cut(likely(cut(small.union(star).distinct()), classes))
    sets = cut(sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).union(around.select("node")),
                       docs, classes))
    linked = cut(confirmed(pairs, sets))
    own = classes.select("node", "first")
    labels = cut(components(own, linked))
    if not around.isEmpty():
        root = labels.select("node", "root")
        members = cut(around.join(root, "node", "left")
                      .join(root.select(F.col("node").alias("centre"), F.col("root").alias("home")), "centre", "left")
                      .select("centre", "node", F.coalesce("root", "node").alias("root"), F.coalesce("home", "centre").alias("home")))
        more = cut(across(members, sets))
        if not more.isEmpty():
            labels = cut(components(own, linked.union(more)))
    release(docs.sparkSession)
    return rows, labels.select("node", "root", "root_first")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, labels = near_duplicates(table(spark, sf_dir, "documents"))
    return with_components(rows, labels).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


def with_components(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with ``component_id`` and ``kept``; a class without links is its own component."""
    alone = cut(rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("own"))
                .join(labels, "node", "left").select("node", F.coalesce("root_first", "own").alias("component")))
    return (rows.join(alone, "node", "left")
            .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates one row stays, of the smallest id (none comes last), by text."""
    rows, labels = near_duplicates(docs)
    row, word, met = fresh("row"), fresh("text"), fresh("met")
    classes = cut(rows.where(F.col("node").isNotNull()).groupBy("node").agg(smallest().alias("f"))
                  .join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "f"))
    stays = classes.groupBy("root").agg(F.min("f").alias("stay"))
    stay = cut(classes.join(stays, "root").select("node", "stay"))
    keep = F.col("doc_id").eqNullSafe(F.col("stay")["doc_id"]) & (F.col("tk") == F.col("stay")["tk"])
    texts = (rows.join(stay, "node").groupBy(F.col("doc_id").alias(row), F.col("tk").alias(word), keep.alias("keep"))
             .agg(F.count(F.lit(1)).alias("n")))
    odd = cut(texts.where(~F.col("keep") | (F.col("n") > 1)))
    # text_key of a null text is null: such a row is in no group
    flagged = docs.withColumn(met, among(odd, row, word)("doc_id", text_key()))
    touched = flagged.where(met).drop(met)
    same = [F.col("doc_id").eqNullSafe(F.col(row)), text_key() == F.col(word)]
    out = flagged.where(~F.col(met)).drop(met).unionByName(touched.join(odd.select(row, word), same, "left_anti"))
    again = odd.where("keep").select(row, word)
    if again.isEmpty():
        return out
    one = touched.join(again, same).dropDuplicates([row, word]).drop(row, word)
    return out.unionByName(one)


QUERIES = {"op6_minhash": op6_minhash}
SQL: dict[str, str] = {}
