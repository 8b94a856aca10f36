"""Removal of long byte strings that occur more than once, by suffix sorting.

Texts are UTF-8 bytes; a string is ``LENGTH`` bytes and starts anywhere in any
document.  Equal strings meet in one shard without moving the corpus:

* In each string the smallest of its ``ANCHOR``-byte hashes is its anchor, so
  equal strings have equal anchors at equal places.  Neighbouring strings that
  share an anchor form a segment.  Anchors met once in the corpus are done
  with; a Bloom filter of fixed size over the others thins the second scan
  (a false hit costs a row, nothing else).
* Segments equal in all bytes (by 128-bit hash) are one class, counted with
  partial sums: all strings of a class met twice go.
* Only different segments with one anchor need their bytes.  They are read
  from one document each and dealt to shards by anchor; a shard orders its
  suffixes by induction (``induced.py``, whose queues spill to disk), and
  neighbours whose common prefix reaches ``LENGTH`` bytes go.
* An anchor with more than ``HOT`` different segments would be a hot shard; its
  strings meet by 128-bit hash instead, in packed arrays.

Every byte covered by a string that goes is removed; strings are judged on the
input.  Defined results: null is empty text; rows that repeat id and text are
documents of their own, so all they share goes; a null id is kept.  Any text
length; an empty table gives no rows.  Extra columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, cut, fresh, partitions, release, table
from strata.llm.induced import suffix_order
from strata.llm.line_dedup import LAST, batches_of_docs, bloom, bloom_places, raws
from strata.llm.minhash import mixed

LENGTH, ANCHOR = 200, 64
HOT = 512
SHARD_BYTES = 4 << 20
_BLOCK = 1 << 22
_BYTES = np.random.default_rng(20240301).integers(0, 2 ** 63, 256, dtype=np.uint64)
_POWER = 0x9E3779B97F4A7C15


def segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash and place, first and last start of each run of strings that share an anchor."""
    out = [np.zeros((4, 0), np.int64)]
    width = LENGTH - ANCHOR + 1
    for begin in range(0, max(len(data) - LENGTH + 1, 0), _BLOCK):
        h = _BYTES[data[begin:begin + _BLOCK + LENGTH - 1]]
        m, power = 1, _POWER
        while m < ANCHOR:
            h = h[:-m] * np.uint64(power) + h[m:]
            m, power = 2 * m, power * power % 2 ** 64
        h = mixed(h)
        # 40 bits of hash, then the place: the smallest is the left-most smallest hash
        low = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
        m = 1
        while 2 * m <= width:
            low = np.minimum(low[:-m], low[m:])
            m *= 2
        if m < width:
            low = np.minimum(low[:len(low) - (width - m)], low[width - m:])
        place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        p = place[first]
        out.append(np.stack([h[p].view(np.int64), p + begin, first + begin, last + begin]))
    return tuple(np.concatenate(out, axis=1))


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(h): hashes of anchors that more than one segment has."""
    buckets = 4 * partitions(docs.sparkSession)

    def send(batches):
        held, n = [], 0

        def rows():
            h = np.concatenate(held).view(np.uint64)
            h, count = np.unique(h, return_counts=True)
            bucket = (mixed(h) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(ends))
            pick = [order[ends[i]:ends[i + 1]] for i in full]
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([h[x].tobytes() for x in pick], pa.binary()),
                                               pa.array([(count[x] > 1).tobytes() for x in pick], pa.binary())], ["bucket", "h", "again"])

        for b in batches_of_docs(batches):
            for t in raws(b.column(0)):
                h = segments(np.frombuffer(t, np.uint8))[0]
                held.append(h)
                n += len(h)
            if n > 4_000_000:
                yield rows()
                held, n = [], 0
        if n:
            yield rows()

    def meet(key, group):
        h = np.concatenate([np.frombuffer(c.as_buffer(), np.uint64) for c in group.column("h")])
        again = np.concatenate([np.frombuffer(c.as_buffer(), bool) for c in group.column("again")])
        order = np.argsort(h, kind="stable")
        h, again = h[order], again[order]
        twice = again.copy()
        twice[1:] |= h[1:] == h[:-1]
        return pa.table({"h": pa.array(np.unique(h[twice]).view(np.int64))})

    return docs.select("text").mapInArrow(send, "bucket int, h binary, again binary").groupBy("bucket").applyInArrow(meet, "h long")


def occurrences(keyed: DataFrame, anchors: DataFrame) -> DataFrame:
    """(h, s1, s2, doc, t, a, p, b): every segment whose anchor may be met again."""
    filter_ = keyed.sparkSession.sparkContext.broadcast(bloom(anchors))     # of fixed size

    def run(batches):
        bits = filter_.value
        for batch in batches_of_docs(batches):
            cols = [[] for _ in range(8)]
            for d, text, t in zip(batch.column(0).to_pylist(), raws(batch.column(1)), batch.column(2).to_pylist()):
                h, p, a, b = segments(np.frombuffer(text, np.uint8))
                ok = np.ones(len(h), bool)
                for at in bloom_places(h.view(np.uint64)):
                    ok &= (bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
                for i in np.flatnonzero(ok):
                    s = xxhash.xxh3_128_digest(text[a[i]:b[i] + LENGTH], int(p[i] - a[i]))
                    s1, s2 = np.frombuffer(s, np.int64)
                    for c, v in zip(cols, (h[i], s1, s2, LAST if d is None else d, t, a[i], p[i], b[i])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in cols], ["h", "s1", "s2", "doc", "t", "a", "p", "b"])

    return keyed.mapInArrow(run, "h long, s1 long, s2 long, doc long, t long, a long, p long, b long")


RANGES = "array<struct<lo:long,hi:long>>"


def ranges_of(hit: np.ndarray) -> list[dict]:
    """Runs of true values: first and last."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"lo": int(a), "hi": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]


def sorted_shard(key, group):
    """Strings of the shard's single segments that occur in another segment, by suffix order."""
    rows = {}
    for s1, s2, c, data in zip(*(group.column(x).to_pylist() for x in ("s1", "s2", "c", "data"))):
        rows[s1, s2] = (c, np.frombuffer(data, np.uint8))
    keys = list(rows)
    size = np.array([len(rows[k][1]) for k in keys])
    text = np.concatenate([rows[k][1] for k in keys])
    begin = np.cumsum(size) - size
    start = np.zeros(len(text), bool)
    for b, n in zip(begin, size):
        start[b:b + n - LENGTH + 1] = True
    order = suffix_order(text, LENGTH)
    order = order[start[order]]
    strings = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    same = np.zeros(len(order), bool)
    for at in range(1, len(order), 1 << 14):
        b = order[at:at + (1 << 14)]
        same[at:at + len(b)] = (strings[order[at - 1:at - 1 + len(b)]] == strings[b]).all(axis=1)
    hit = np.zeros(len(text), bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    out = []
    for (s1, s2), b, n in zip(keys, begin, size):
        if rows[s1, s2][0] == 1:
            own = hit[b:b + n - LENGTH + 1]
            if own.any():
                out.append((s1, s2, ranges_of(own)))
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    return pa.table({"s1": pa.array([o[0] for o in out], pa.int64()), "s2": pa.array([o[1] for o in out], pa.int64()),
                     "ranges": pa.array([o[2] for o in out], kind)})


def with_bytes(chosen: DataFrame, keyed: DataFrame) -> DataFrame:
    """(h, s1, s2, c, v, data): the chosen segments with their bytes, from one document each."""
    places = (chosen.groupBy(F.col("at")["doc"].alias("doc"), F.col("at")["t"].alias("t"))
              .agg(F.collect_list(F.struct("h", "s1", "s2", "c", "v", F.col("at")["a"].alias("a"), F.col("at")["b"].alias("b"))).alias("own")))
    rows = keyed.withColumn("doc", F.coalesce("doc_id", F.lit(int(LAST)))).join(places, ["doc", "t"]).select("text", "own")

    def run(batches):
        for batch in batches_of_docs(batches, 128):
            out = []
            for text, own in zip(raws(batch.column(0)), batch.column(1).to_pylist()):
                out += [(o["h"], o["s1"], o["s2"], o["c"], o["v"], text[o["a"]:o["b"] + LENGTH]) for o in own]
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 5 + [pa.binary()])],
                                             ["h", "s1", "s2", "c", "v", "data"])

    return rows.mapInArrow(run, "h long, s1 long, s2 long, c long, v long, data binary")


STRING = np.dtype([("w1", "<i8"), ("w2", "<i8"), ("s1", "<i8"), ("s2", "<i8"), ("i", "<i4"), ("single", "?"), ("again", "?")])
HIT = np.dtype([("s1", "<i8"), ("s2", "<i8"), ("i", "<i4")])
#: Strings a task hashes before it compares and sends them.
HELD_STRINGS = 200_000


def met(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings in order, where each distinct one begins, and which of these more than one segment has."""
    p = p[np.lexsort((p["s2"], p["s1"], p["w2"], p["w1"]))]
    string, segment = np.ones(len(p), bool), np.ones(len(p), bool)
    string[1:] = (p["w1"][1:] != p["w1"][:-1]) | (p["w2"][1:] != p["w2"][:-1])
    segment[1:] = string[1:] | (p["s1"][1:] != p["s1"][:-1]) | (p["s2"][1:] != p["s2"][:-1])
    first = np.flatnonzero(string)
    return p, first, np.logical_or.reduceat(p["again"], first) | (np.add.reduceat(segment.astype(np.int64), first) > 1)


def hits_of(p: np.ndarray, first: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Places of strings met twice, in segments that occur once."""
    p = p[np.repeat(twice, np.diff(np.append(first, len(p)))) & p["single"]]
    out = np.zeros(len(p), HIT)
    for k in HIT.names:
        out[k] = p[k]
    return out


def dealt(rows: np.ndarray, by: str, buckets: int) -> list[tuple[int, bytes]]:
    """The rows of each bucket, packed."""
    bucket = (mixed(np.ascontiguousarray(rows[by]).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(int(b), rows[order[ends[b]:ends[b + 1]]].tobytes()) for b in np.flatnonzero(np.diff(ends))]


def hot_ranges(rows: DataFrame) -> DataFrame:
    """As ``sorted_shard`` for the segments of hot anchors, by the hashes of their strings.

    Strings travel as packed arrays.  A task settles the strings it meets twice and sends one
    of each, marked, so a string that many segments have costs its bucket a record per send.
    """
    buckets = 4 * partitions(rows.sparkSession)
    kind = "hit boolean, bucket int, data binary"

    def packed(hit: bool, parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([hit] * len(parts), pa.bool_()), pa.array([b for b, _ in parts], pa.int32()),
                                           pa.array([d for _, d in parts], pa.binary())], ["hit", "bucket", "data"])

    def run(batches):
        held, n = [], 0

        def send():
            p, first, twice = met(np.concatenate(held))
            yield packed(True, dealt(hits_of(p, first, twice), "s1", buckets))
            one = p[first]
            one["again"] = twice
            yield packed(False, dealt(one, "w1", buckets))

        for batch in batches_of_docs(batches, 512):
            for s1, s2, c, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
                p = np.zeros(len(data) - LENGTH + 1, STRING)
                w = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[k:k + LENGTH]) for k in range(len(p))]), np.int64)
                p["w1"], p["w2"], p["s1"], p["s2"], p["i"], p["single"] = w[::2], w[1::2], s1, s2, np.arange(len(p)), c == 1
                held.append(p)
                n += len(p)
            if n > HELD_STRINGS:
                yield from send()
                held, n = [], 0
        if held:
            yield from send()

    def meet(key, group):
        p = np.concatenate([np.frombuffer(c.as_buffer(), STRING) for c in group.column("data")])
        parts = dealt(hits_of(*met(p)), "s1", buckets)
        return pa.table({"bucket": pa.array([b for b, _ in parts], pa.int32()), "data": pa.array([d for _, d in parts], pa.binary())})

    def join(key, group):
        p = np.unique(np.concatenate([np.frombuffer(c.as_buffer(), HIT) for c in group.column("data")]))
        first = np.flatnonzero(np.concatenate([[True], (p["s1"][1:] != p["s1"][:-1]) | (p["s2"][1:] != p["s2"][:-1])]))
        ranges = []
        for own in np.split(p["i"], first[1:]):
            edge = np.flatnonzero(np.diff(own) > 1)
            ranges.append([{"lo": int(a), "hi": int(b)} for a, b in zip(own[np.append(0, edge + 1)], own[np.append(edge, len(own) - 1)])])
        return pa.table({"s1": pa.array(p["s1"][first].copy()), "s2": pa.array(p["s2"][first].copy()),
                         "ranges": pa.array(ranges, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))})

    sent = cut(rows.select("s1", "s2", "c", "data").mapInArrow(run, kind))
    found = sent.where(~F.col("hit")).select("bucket", "data").groupBy("bucket").applyInArrow(meet, "bucket int, data binary")
    return (sent.where("hit").select("bucket", "data").union(found).groupBy("bucket")
            .applyInArrow(join, f"s1 long, s2 long, ranges {RANGES}"))


def removed_strings(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``source`` (doc_id, text) with the text's hash ``t``, and per (doc, t) the byte ranges that go."""
    keyed = source.withColumn("t", F.xxhash64("text"))
    spark = source.sparkSession
    found = cut(occurrences(keyed, cut(repeated_anchors(source))))
    classes = cut(found.groupBy("h", "s1", "s2").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc", "t", "a", "b")).alias("at")))
    groups = cut(classes.groupBy("h").agg(F.count(F.lit(1)).alias("v"), F.min("c").alias("least"))
                 .where((F.col("v") > 1) & (F.col("least") == 1)))
    rows = cut(with_bytes(cut(classes.join(groups.select("h", "v"), "h")), keyed))
    cold = rows.where(F.col("v") <= HOT)
    shards = max(partitions(spark), 1 + cold.count() * (LENGTH + ANCHOR) // SHARD_BYTES)
    decided = (cold.select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), "s1", "s2", "c", "data")
               .groupBy("shard").applyInArrow(sorted_shard, f"s1 long, s2 long, ranges {RANGES}"))
    hot = rows.where(F.col("v") > HOT)
    if not hot.isEmpty():
        decided = decided.union(hot_ranges(hot))
    whole = classes.where(F.col("c") > 1).select("s1", "s2", F.array(F.struct(
        F.lit(0).cast("long").alias("lo"), (F.col("at")["b"] - F.col("at")["a"]).alias("hi"))).alias("ranges"))
    decided = cut(decided.union(whole))
    release(spark)
    hits = (found.join(decided, ["s1", "s2"])
            .select("doc", "t", F.explode(F.transform("ranges", lambda r: F.struct(
                (r["lo"] + F.col("a")).alias("lo"), (r["hi"] + F.col("a") + LENGTH).alias("hi")))).alias("r"))
            .groupBy("doc", "t").agg(F.collect_list("r").alias("ranges")))
    return keyed, hits


def dedup(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` plus one struct column: n_bytes, n_removed, spans removed (byte offsets), kept bytes' sha256."""
    name, other = fresh("repeats"), {c: fresh(c) for c in ("doc", "t", "hash", "part")}
    _, hits = removed_strings(docs.select("doc_id", "text"))
    hits = hits.select(F.col("doc").alias(other["doc"]), F.col("t").alias(other["t"]), "ranges").withColumnRenamed("ranges", ranges := fresh("ranges"))
    held = (docs.withColumn(other["hash"], F.xxhash64("text"))
            .join(hits, (F.coalesce("doc_id", F.lit(int(LAST))) == F.col(other["doc"])) & (F.col(other["hash"]) == F.col(other["t"])), "left")
            .withColumn(other["part"], F.when(F.col(ranges).isNotNull(), F.col("text"))))
    kind = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                         T.StructField("spans", T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])))])

    def make():
        def work(texts: pa.Array, found: pa.Array) -> list:
            out = []
            for x, r in zip(raws(texts), found.to_pylist()):
                if r is None:
                    out.append(None)
                    continue
                text = np.frombuffer(x, np.uint8)
                cover = np.zeros(len(text) + 1, np.int64)
                np.add.at(cover, [e["lo"] for e in r], 1)
                np.add.at(cover, [e["hi"] for e in r], -1)
                gone = np.cumsum(cover[:-1]) > 0
                out.append({"n_removed": int(gone.sum()), "kept_sha256": hashlib.sha256(text[~gone].tobytes()).hexdigest(),
                            "spans": [{"lo": e["lo"], "hi": e["hi"] + 1} for e in ranges_of(gone)]})
            return [out]
        return work

    # only texts that lose a string go through Python
    done = append(held, [other["part"], ranges], [(name, kind)], make)
    text = F.coalesce("text", F.lit(""))
    return done.withColumn(name, F.struct(
        F.octet_length(text).cast("long").alias("n_bytes"), F.coalesce(F.col(name)["n_removed"], F.lit(0)).alias("n_removed"),
        F.coalesce(F.col(name)["kept_sha256"], F.sha2(text.cast("binary"), 256)).alias("kept_sha256"),
        F.coalesce(F.col(name)["spans"], F.array().cast(RANGES)).alias("spans"))).drop(ranges, *other.values()), name


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, name = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    r = F.col(name)
    return done.select("doc_id", r["n_bytes"].alias("n_bytes"), r["n_removed"].alias("n_removed"),
                       F.size(r["spans"]).cast("long").alias("n_spans"), r["kept_sha256"].alias("kept_sha256"))


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
SQL: dict[str, str] = {}
