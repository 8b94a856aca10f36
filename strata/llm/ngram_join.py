"""Exact Jaccard join of documents on five-word shingles through a token-group matrix.

Documents with equal sets are one class.  Classes that share two minimum
hashes form a group, so similar ones mostly fall into one; a crowded group is
split by class.  The matrix has a column per token and lists the groups whose
token union holds it.

* Sets of similarity 0.8 share a token of both prefixes (tokens ordered by
  rarity, then hash), so the matrix keeps the unions of the members' prefixes.
  It travels as packed (token, group) arrays, a few rows per task.  Rarity comes
  from a sketch of fixed size over all classes; it orders tokens, it decides nothing.
* Groups meet in the columns.  The columns they share bound the overlap of any
  two members: shared prefix tokens, plus what the longer rest can hold.  With
  the sizes that excludes most pairs of groups before a full set is read.
* A column of more than ``SMALL`` groups pairs each with one centre only.
  Groups with members outside the component that most have around the centre
  are then paired with all others around it, by the same bound, so no link is
  lost; such pairs are opened in chunks of groups.
* A qualifying pair of groups is opened query by query: the overlap of a member
  with the other group's union bounds it again, and what passes is compared
  member by member on full sets.  Links inside what is already connected are not
  looked for: components need one path, not all pairs.
* Full sets are read again for groups that meet; a Bloom filter of fixed size
  over the texts wanted thins that scan, an exact join decides.

Defined results: a null or wordless text has the empty set, stands alone and
keeps its own id.  Rows that repeat an id or a set are members of their sets'
classes; a row without id takes part and lends its component no id unless all
its rows have none.  An empty table gives no rows.  Extra columns are ignored.
Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, cut, partitions, release, table
from strata.llm.components import components, joined_up
from strata.llm.line_dedup import bloom, bloom_places, word_hashes
from strata.llm.minhash import _STEP, SHINGLE, mixed, with_components

#: Links: LINK[0] * intersection >= LINK[1] * union.
LINK = (100, 80)
BOTH = sum(LINK)
CELL_BITS, GROUP_BITS = 22, 20      # cells of the rarity sketch and of the group sketch
RARITY_BITS = 7
HASH_BITS = 64 - RARITY_BITS
GROUP = 32                          # classes of a group that are opened together
CHUNK = 128                         # classes around a centre that are compared with as many in one step
SMALL = 8                           # groups of a column that are paired at once
SPREAD = 4096                       # counts of a token's cell per bucket it is dealt to
BLOCK_BYTES = 6                     # bytes of a group's name: two groups of one name are one group
STEP_BYTES = 1 << 20
PARTS = 16
_FLIP, _MULT = np.uint64(0x7F4A7C15D1B54A33), np.uint64(0xD6E8FEB86659FD93)


def batch_shingles(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    own, start = word_hashes(data)
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    n = np.bincount(text, minlength=len(texts))
    width = np.minimum(n, SHINGLE)
    each = np.where(n > 0, n - width + 1, 0)
    ends = np.cumsum(each)
    at = np.arange(ends[-1]) + np.repeat(np.cumsum(n) - n - (ends - each), each)
    wide = np.repeat(width, each)
    total = wide.astype(np.uint64)
    for i in range(SHINGLE):
        inside = i < wide
        total += np.where(inside, own[np.where(inside, at + i, 0)] * _STEP[i], np.uint64(0))
    h = mixed(total)
    for a, b in zip(ends - each, ends):
        yield np.unique(h[a:b])


def read_texts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8 bytes) in steps of bounded size or one text; null is empty."""
    texts, at, size = [], 0, 0
    for i, x in enumerate(column.cast(pa.binary())):
        t = x.as_py() or b""
        if texts and size + len(t) > STEP_BYTES:
            yield at, texts
            texts, at, size = [], i, 0
        texts.append(t)
        size += len(t)
    if texts:
        yield at, texts


def prefix_length(n: int) -> int:
    return n - -(-LINK[1] * n // LINK[0]) + 1


def key_of(s: np.ndarray) -> int:
    """What the members of a group have in common: the minimum of two permutations of the tokens."""
    return int(mixed(s[:1] * _STEP[0] + ((s ^ _FLIP) * _MULT).min())[0])


def group_names(key: np.ndarray, node: np.ndarray, crowding: np.ndarray) -> np.ndarray:
    """A class's group: its key, and in a crowded one also a share of the classes."""
    share = share_of(node, crowding[key >> np.uint64(64 - GROUP_BITS)])
    return mixed(key + share * _STEP[1]) >> np.uint64(64 - 8 * BLOCK_BYTES)


def head(node: bytes) -> int:
    return int.from_bytes(node[:8], "little")


def described(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, node, key, th) of all documents, and in further rows (part, counts) each task's sketches."""
    cells = (1 << CELL_BITS) + (1 << GROUP_BITS)
    step = -(-cells // PARTS)

    def run(batches):
        seen, total = set(), np.zeros(step * PARTS, np.uint32)
        for b in batches:
            n, node, key, th = [], [], [], []
            for _, texts in read_texts(b.column(1)):
                for t, s in zip(texts, batch_shingles(texts)):
                    n.append(len(s))
                    th.append(xxhash.xxh3_64_intdigest(t))
                    if not len(s):
                        node.append(None), key.append(0)
                        continue
                    d = xxhash.xxh3_128_digest(s.tobytes())
                    node.append(d), key.append(key_of(s))
                    if d not in seen:
                        seen.add(d)
                        np.add.at(total, (s >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
                        total[(1 << CELL_BITS) + (key[-1] >> (64 - GROUP_BITS))] += 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(np.array(key, np.uint64).view(np.int64)),
                                              pa.array(np.array(th, np.uint64).view(np.int64)), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], NAMES)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        counts = [squeeze(total[i * step:(i + 1) * step].tobytes()) for i in range(PARTS)]
        blank = [pa.nulls(PARTS, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*blank, pa.array(range(PARTS), pa.int32()), pa.array(counts, pa.binary())], NAMES)

    NAMES = ["doc_id", "n", "node", "key", "th", "part", "counts"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, node binary, key long, th long, part int, counts binary")


def sketches(parts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tasks' sketches added up: counts by token cell and by group cell (PARTS rows, of fixed size)."""
    def add(key, group):
        total = 0
        for c in group.column("counts"):
            total = total + np.frombuffer(zstandard.ZstdDecompressor().decompress(c.as_py()), np.uint32).astype(np.int64)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([np.minimum(total, 2 ** 32 - 1).astype("<u4").tobytes()], pa.binary())})

    got = parts.groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    whole = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in sorted(got, key=lambda r: r["part"])]) if got else np.zeros(0, "<u4")
    return whole[:1 << CELL_BITS], whole[1 << CELL_BITS:(1 << CELL_BITS) + (1 << GROUP_BITS)]


def spread_of(counts: np.ndarray, each: int) -> np.ndarray:
    """Bits of the share into which a cell's rows are dealt: none, unless it holds far more than a usual one."""
    typical = int(np.median(counts)) if len(counts) else 0
    return np.ceil(np.log2(np.maximum(1, (counts.astype(np.int64) - 4 * max(typical, 1)) / each))).astype(np.uint8)


def share_of(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return x & ((np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1))


def cell_of(token: np.ndarray) -> np.ndarray:
    return ((token & np.uint64((1 << HASH_BITS) - 1)) >> np.uint64(HASH_BITS - CELL_BITS)).astype(np.int64)


def planes(x: np.ndarray, width: int) -> bytes:
    return x.view(np.uint8).reshape(len(x), 8)[:, :width].T.tobytes()


def packed(token: np.ndarray, group: np.ndarray) -> bytes:
    """Postings byte column by byte column, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(planes(token, 8) + planes(group, BLOCK_BYTES))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(flat) // (8 + BLOCK_BYTES)
    out = []
    for at, width in ((0, 8), (8 * n, BLOCK_BYTES)):
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = flat[at:at + width * n].reshape(width, n).T
        out.append(x.view(np.uint64).ravel())
    return out[0], out[1]


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (a, b) and how often each occurs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return a[at], b[at], np.diff(np.append(at, len(a)))


def matrix_rows(docs: DataFrame, shared, buckets: int) -> DataFrame:
    """(bucket, data): the token-group matrix, packed: prefix tokens of each task's distinct classes."""

    def run(batches):
        rarity, spread, crowding, _ = shared.value
        seen, tokens, groups, held = set(), [], [], 0

        def flush():
            t, g, _ = distinct_pairs(np.concatenate(tokens), np.concatenate(groups))
            bucket = (mixed(t + share_of(g, spread[cell_of(t)]) * _STEP[2]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(ends))
            data = [packed(t[order[ends[i]:ends[i + 1]]], g[order[ends[i]:ends[i + 1]]]) for i in full]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

        for b in batches:
            for _, texts in read_texts(b.column(0)):
                for s in batch_shingles(texts):
                    if not len(s) or (d := xxhash.xxh3_128_digest(s.tobytes())) in seen:
                        continue
                    seen.add(d)
                    t = (rarity[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(HASH_BITS)) | (s >> np.uint64(RARITY_BITS))
                    t.sort()
                    t = t[:prefix_length(len(s))]
                    t = t[t >> np.uint64(HASH_BITS) > 0]        # a cell with one class has no partner in it
                    tokens.append(t)
                    groups.append(np.repeat(group_names(np.array([key_of(s)], np.uint64), np.array([head(d)], np.uint64), crowding), len(t)))
                    held += len(t)
                if held > 1_000_000:
                    yield flush()
                    tokens, groups, held = [], [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "bucket int, data binary")


def meetings(rows: DataFrame, shared) -> DataFrame:
    """Per bucket: (a, b, n) for groups that share n small columns, and (token, a) for the groups of a large one."""

    def run(key, part):
        _, spread, _, small = shared.value
        t, g = (np.concatenate(x) for x in zip(*(unpacked(c.as_py()) for c in part.column("data"))))
        t, g, _ = distinct_pairs(t, g)
        start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        m = np.diff(np.append(start, len(t)))
        large = np.repeat((m > small) | (spread[cell_of(t[start])] > 0), m)
        at, rest = np.flatnonzero(~large), (np.repeat(start + m, m) - np.arange(len(t)) - 1)[~large]
        a, b = [g[:0]], [g[:0]]
        for d in range(1, small):
            at, rest = at[rest >= d], rest[rest >= d]
            a.append(g[at]), b.append(g[at + d])
        a, b, n = distinct_pairs(np.concatenate(a), np.concatenate(b))
        crowd_t, crowd_g = t[large], g[large]
        col = lambda *x: pa.array(np.concatenate(x).view(np.int64))
        return pa.table([pa.concat_arrays([pa.nulls(len(a), pa.int64()), col(crowd_t)]), col(a, crowd_g),
                         pa.concat_arrays([col(b), pa.nulls(len(crowd_g), pa.int64())]), pa.array(np.concatenate([n, np.zeros(len(crowd_g), np.int64)]))],
                        ["token", "a", "b", "n"])

    return rows.groupBy("bucket").applyInArrow(run, "token long, a long, b long, n long")


def grouped(classes: DataFrame, shared) -> DataFrame:
    """``classes`` (node, key, ...) with the name of each one's group."""
    def make():
        crowding = shared.value[2]

        def work(nodes: pa.Array, keys: pa.Array) -> list:
            heads = np.array([head(d.as_py()) for d in nodes], np.uint64)
            return [pa.array(group_names(np.asarray(keys).view(np.uint64), heads, crowding).view(np.int64))]
        return work
    return append(classes, ["node", "key"], [("group", T.LongType())], make)


def sets_of(docs: DataFrame, wanted: DataFrame, places: DataFrame, shared) -> DataFrame:
    """(place, part, nodes, sets) of the groups in (group, place, parts); ``wanted`` has the text digests ``th`` of their classes."""
    spark = docs.sparkSession
    filter_ = spark.sparkContext.broadcast(bloom(wanted))       # of fixed size

    def run(batches):
        crowding = shared.value[2]
        seen, bits = set(), filter_.value
        for b in batches:
            for _, texts in read_texts(b.column(0)):
                th = np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts))
                ok = np.ones(len(th), bool)
                for at in bloom_places(th):
                    ok &= (bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
                pick = [i for i in np.flatnonzero(ok) if th[i] not in seen and not seen.add(th[i])]
                name, node, sets = [], [], []
                if pick:
                    for s in batch_shingles([texts[i] for i in pick]):
                        if len(s):
                            raw = s.tobytes()
                            d = xxhash.xxh3_128_digest(raw)
                            name.append(group_names(np.array([key_of(s)], np.uint64), np.array([head(d)], np.uint64), crowding)[0])
                            node.append(d), sets.append(raw)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(name, np.uint64).view(np.int64)), pa.array(node, pa.binary()), pa.array(sets, pa.binary())],
                                                 ["group", "node", "hashes"])

    rows = docs.select("text").mapInArrow(run, "group long, node binary, hashes binary")
    return (rows.join(places, "group").dropDuplicates(["group", "node"])
            .groupBy("place", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"))
            .agg(F.collect_list(F.struct("node", "hashes")).alias("m"))
            .select("place", "part", F.col("m")["node"].alias("nodes"), F.col("m")["hashes"].alias("sets")))


def opened(pairs: DataFrame, sets: DataFrame, inner_known: bool = False) -> DataFrame:
    """(a, b): links between members of the paired places, as many as connect what is connected.

    ``inner_known``: each place is also paired with itself, so that two places
    need only the links between what is connected inside them.
    """
    def side(tag: str) -> DataFrame:
        return sets.select(F.col("place").alias(tag), *(F.col(c).alias(f"{tag}_{c}") for c in ("part", "nodes", "sets")))

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where((F.col("a") != F.col("b")) | (F.col("a_part") <= F.col("b_part")))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = open_group(*(batch.column(c)[i].as_py() for c in range(5)))
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    other = (F.col("a") != F.col("b")) | (F.col("a_part") != F.col("b_part"))
    return (both.select("a_nodes", "a_sets", "b_nodes", "b_sets", (other & F.lit(inner_known)).alias("inside"))
            .mapInArrow(run, "a binary, b binary"))


def open_group(queries: list[bytes], q_sets: list[bytes], nodes: list[bytes], sets: list[bytes], inside: bool = False) -> tuple[list[bytes], list[bytes]]:
    """Links between queries and members of a group, leaving out those that are connected already, with ``inside`` also
    by links among the queries or among the members."""
    known = [x for side in ((queries, q_sets), (nodes, sets)) for x in zip(*open_group(*side, *side))] if inside else []
    ys = [np.frombuffer(y, np.uint64) for y in sets]
    union, place = np.unique(np.concatenate(ys), return_inverse=True)
    size = np.array([len(y) for y in ys])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    parent = {d: d for d in (*queries, *nodes)}

    def root(d):
        while parent[d] != d:
            parent[d] = d = parent[parent[d]]
        return d

    for x, y in known:
        parent[root(y)] = root(x)
    a, b = [], []
    for q, raw in zip(queries, q_sets):
        x = np.frombuffer(raw, np.uint64)
        at = np.minimum(np.searchsorted(union, x), len(union) - 1)
        at = at[union[at] == x]
        if BOTH * len(at) < LINK[1] * (len(x) + int(size.min())):
            continue                            # its overlap with the union is too small for any member
        mark = np.zeros(len(union), np.int64)
        mark[at] = 1
        inter = np.add.reduceat(mark[place], starts)
        for i in np.flatnonzero(LINK[0] * inter >= LINK[1] * (len(x) + size - inter)):
            s, t = root(q), root(nodes[i])
            if s != t:
                parent[t] = s
                a.append(q), b.append(nodes[i])
    return a, b


def fits(a: str, b: str, shared: Column | None) -> Column:
    """Whether the sizes of groups a and b, and the overlap bound where ``shared`` counts their common columns, allow a link."""
    c = lambda tag, name: F.col(f"{tag}_{name}")
    out = (LINK[0] * c(b, "most") >= LINK[1] * c(a, "least")) & (LINK[0] * c(a, "most") >= LINK[1] * c(b, "least"))
    if shared is not None:
        out &= BOTH * (shared + F.greatest(c(a, "rest"), c(b, "rest"))) >= LINK[1] * (c(a, "least") + c(b, "least"))
    return out


def could_link(pairs: DataFrame, facts: DataFrame, shared: Column | None) -> DataFrame:
    """The pairs (a, b) that ``fits`` leaves."""
    def side(tag: str) -> DataFrame:
        return facts.select(F.col("group").alias(tag), *(F.col(c).alias(f"{tag}_{c}") for c in ("least", "most", "rest", "crowds")))

    return pairs.join(side("a"), "a").join(side("b"), "b").where(fits("a", "b", shared)).select("a", "b").distinct()


def links_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, node) of all documents, and (node, root, root_first) of the classes that are linked."""
    spark = docs.sparkSession
    all_rows = cut(described(docs))
    rows = all_rows.where(F.col("part").isNull()).select("doc_id", "n", "node", "key", "th")
    counts, crowds = sketches(all_rows.where(F.col("part").isNotNull()).select("part", "counts"))
    if not len(counts):
        counts, crowds = np.zeros(1 << CELL_BITS, np.uint32), np.zeros(1 << GROUP_BITS, np.uint32)
    rarity = np.where(counts < 2, 0, np.minimum(2 * np.log2(np.maximum(counts, 2)), (1 << RARITY_BITS) - 1)).astype(np.uint8)
    shared = spark.sparkContext.broadcast((rarity, spread_of(counts, SPREAD), spread_of(crowds, GROUP), SMALL))
    found = cut(meetings(matrix_rows(docs, shared, 8 * partitions(spark)), shared))
    release(spark)
    classes = cut(grouped(rows.where(F.col("node").isNotNull()).groupBy("node")
                          .agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("key").alias("key"), F.min("th").alias("th")), shared))
    rest = F.floor(F.col("n") * LINK[1] / LINK[0])
    crowd = found.where(F.col("token").isNotNull()).select("token", F.col("a").alias("group"))
    sizes = crowd.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    crowd = cut(crowd.join(sizes, "token"))
    facts = cut(classes.groupBy("group").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(rest).alias("rest"), F.count(F.lit(1)).alias("classes"))
                .join(crowd.groupBy("group").agg(F.count(F.lit(1)).alias("crowds"), F.sum("size").alias("score")), "group", "left").fillna(0, ["crowds", "score"]))
    release(spark)
    met = cut(found.where(F.col("token").isNull()).groupBy("a", "b").agg(F.sum("n").alias("n")))
    small = could_link(met, facts, F.col("n") + F.least("a_crowds", "b_crowds"))
    # large columns: one centre each, the group that meets most others
    seats = crowd.join(facts.where("crowds > 0").select("group", "score"), "group")
    centres = cut(seats.groupBy("token").agg(F.max(F.struct("score", "group")).alias("c")).select("token", F.col("c")["group"].alias("centre")))
    around = cut(crowd.select("token", "group").join(centres, "token").select("centre", "group").distinct())
    star = could_link(around.where(F.col("group") != F.col("centre")).select(F.least("centre", "group").alias("a"), F.greatest("centre", "group").alias("b")), facts, None)
    inner = facts.where("classes > 1").select(F.col("group").alias("a"), F.col("group").alias("b"))
    pairs = cut(small.union(star).distinct().union(inner))
    meet = pairs.select(F.col("a").alias("group")).union(pairs.select("b")).distinct()
    places = facts.join(meet, "group", "left_semi").select("group", F.col("group").alias("place"), F.ceil(F.col("classes") / GROUP).alias("parts"))
    sets = sets_for(docs, places, classes, shared)
    release(spark)
    own = classes.select("node", "first")
    linked = cut(opened(pairs, sets, True))
    labels = cut(components(own, linked))
    release(spark)
    if not around.isEmpty():
        again = cut(outside(classes, labels, crowd, around, met, facts, pairs))
        if not again.isEmpty():
            chunks, places = in_chunks(again, around, facts)
            more = cut(between(cut(opened(chunks, sets_for(docs, places, classes, shared))), labels))
            release(spark)
            labels = cut(joined_up(labels, own, more))
    release(spark)
    return rows.select("doc_id", "n", "node"), labels.select("node", "root", "root_first")


def sets_for(docs: DataFrame, places: DataFrame, classes: DataFrame, shared) -> DataFrame:
    """The full sets of the groups in ``places``."""
    places = cut(places)
    return cut(sets_of(docs, classes.join(places, "group", "left_semi").select("th"), places, shared))


def between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links (a, b) as links between components that are still apart, each once."""
    def root(tag: str) -> DataFrame:
        return labels.select(F.col("node").alias(tag), F.col("root").alias(f"r{tag}"))

    ra, rb = F.coalesce("ra", "a"), F.coalesce("rb", "b")
    return (links.join(root("a"), "a", "left").join(root("b"), "b", "left").where(ra != rb)
            .select(F.least(ra, rb).alias("a"), F.greatest(ra, rb).alias("b")).distinct())


def in_chunks(pairs: DataFrame, around: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of groups as pairs of chunks, and (group, place, parts): the groups around a centre in chunks of about ``CHUNK`` classes."""
    classes = around.join(facts.select("group", "classes"), "group")
    centres = classes.groupBy("centre").agg(F.sum("classes").alias("weight"))
    main = (around.join(centres, "centre").groupBy("group").agg(F.max(F.struct("weight", "centre")).alias("c"))
            .select("group", F.xxhash64(F.col("c")["centre"], F.pmod(F.xxhash64("group"), F.ceil(F.col("c")["weight"] / CHUNK))).alias("place"), F.lit(1).alias("parts")))
    places = cut(main.join(pairs.select(F.col("a").alias("group")).union(pairs.select("b")).distinct(), "group", "left_semi"))
    named = lambda tag: places.select(F.col("group").alias(tag), F.col("place").alias(f"p{tag}"))
    both = pairs.join(named("a"), "a").join(named("b"), "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
    return cut(both), places


def outside(classes: DataFrame, labels: DataFrame, crowd: DataFrame, around: DataFrame, met: DataFrame, facts: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs (a, b) of groups of one large column that may still link two components and were not opened yet.

    A centre's home is the component that most classes around it have.  Two
    groups wholly at home are connected; a group that is not meets the others
    around its centre, where the bound of the columns both have still holds.
    """
    columns = crowd.groupBy("group").agg(F.sort_array(F.collect_list("token")).alias("columns"))       # part of one group's prefixes
    roots = cut(classes.join(columns.select("group"), "group", "left_semi").select("node", "group").join(labels.select("node", "root"), "node", "left")
                .groupBy("group", F.coalesce("root", "node").alias("root")).agg(F.count(F.lit(1)).alias("n")))
    home = (around.join(roots, "group").groupBy("centre", "root").agg(F.sum("n").alias("n"))
            .groupBy("centre").agg(F.max(F.struct("n", "root")).alias("h")).select("centre", F.col("h")["root"].alias("home")))
    inside = roots.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    loose = around.join(inside, "group").join(home, "centre").where((F.col("low") != F.col("home")) | (F.col("high") != F.col("home"))).select("group").distinct()
    partners = met.select(F.col("a").alias("group"), "n").union(met.select("b", "n")).groupBy("group").agg(F.max("n").alias("small"))
    seats = cut(columns.join(inside, "group").join(facts.select("group", "least", "most", "rest"), "group").join(partners, "group", "left")
                .select("group", "columns", "least", "most", "rest", F.coalesce("small", F.lit(0)).alias("small"),
                        F.when(F.col("low") == F.col("high"), F.col("low")).alias("root")))
    near = around.join(seats, "group")

    def side(rows: DataFrame, tag: str) -> DataFrame:
        return rows.select("centre", *(F.col(c).alias(f"{tag}_{c}") for c in seats.columns))

    x, y = side(near.join(cut(loose), "group", "left_semi"), "x"), side(near, "y")
    both = F.size(F.array_intersect("x_columns", "y_columns"))
    may = ((F.col("x_group") != F.col("y_group")) & F.coalesce(F.col("x_root") != F.col("y_root"), F.lit(True))
           & fits("x", "y", both + F.least("x_small", "y_small")) & (both > 0))
    pairs = (x.join(y, (x["centre"] == y["centre"]) & may)
             .select(F.least("x_group", "y_group").alias("a"), F.greatest("x_group", "y_group").alias("b"), both.alias("columns")).distinct())
    return could_link(pairs.join(met, ["a", "b"], "left"), facts, F.col("columns") + F.coalesce("n", F.lit(0))).join(done, ["a", "b"], "left_anti")


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, labels = links_of(table(spark, sf_dir, "documents"))
    return with_components(rows, labels).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


QUERIES = {"op12_ngram_join": op12_ngram_join}
SQL: dict[str, str] = {}
