"""Near-duplicate lines removed by an exact set-similarity join.

A line's tokens are the distinct hashes of its five-word shingles (ASCII
letters in lower case; a shorter line is one token), ordered by rarity: by a
sketch of corpus counts of fixed size, then by hash, a total order that is the
same everywhere.  Two lines with a Jaccard similarity of 0.75 or more share a
token of both prefixes; the shared token's positions and both sizes bound the
overlap, and what passes is verified on full sets.  A line goes if an earlier
one, by (doc_id, line number), is equal or that similar to it.

* Equal lines are one class; a map task sends each class once.
* Postings travel as packed arrays, a few rows per task.
* A line goes if any earlier one matches, so a token's classes are compared
  with its earliest one first; only classes still open then meet the others: all
  earlier ones of a small token, and those of a large one chunk by chunk, where
  a task reports at most one match per class and chunk.  A token of many classes
  is dealt over several buckets by class.
* Full sets are read again for candidates only; a Bloom filter of fixed size
  thins that scan, an exact join decides.  Each comes with a sign of 512 bits:
  pairs whose signs differ in too many bits fall away before sets are shuffled.

Defined results: lines without a word stay.  A null text stays null.  Rows
that repeat id and text are one document and get the same result; a null id
comes last.  Extra columns pass through.  Texts are read whole; any input may
be empty.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, cut, fresh, give_back, lean, partitions, release, table
from strata.llm.minhash import _STEP, SHINGLE, mixed

#: Similar: MATCH[0] * intersection >= MATCH[1] * union.
MATCH = (100, 75)
CELL_BITS = 20              # cells of the rarity sketch
SMALL = 16                  # classes of a token that are paired at once
SPREAD = 4096               # counts of a token's cell per bucket it is dealt to
CHUNK = 256
BLOOM_BITS = 26
WINDOW = 1 << 16            # bytes hashed together: what they need stays in a core's cache
LAST = np.iinfo(np.int64).max


def spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | (data - np.uint8(9) < 5)


#: Masks of the first 0 to 8 bytes of a little-endian word; words of more bytes than _LONG are hashed one by one.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG = 64


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word, eight bytes of all words at a time; ``WINDOW`` bytes of text together, cut between words."""
    if len(data) > WINDOW:
        parts, at = [], 0
        while at < len(data):
            end = at + WINDOW
            if end < len(data):         # after the last space of the window, or after the word that fills it
                space = np.flatnonzero(spaces(data[max(at, end - 512):end]))
                if len(space):
                    end = max(at, end - 512) + int(space[-1]) + 1
                else:
                    while end < len(data) and not spaces(data[end:end + 1])[0]:
                        end += 1
            own, start = _word_hashes(data[at:end])
            parts.append((own, start + at))
            at = end
        return tuple(np.concatenate(x) for x in zip(*parts))
    return _word_hashes(data)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = spaces(data)
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[::2], edge[1::2]
    n = end - start
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))      # the eight bytes from each place on
    h = mixed((eight[start] & _FIRST_BYTES[np.minimum(n, 8)]) + n.astype(np.uint64) * _STEP[0])
    more, at = np.flatnonzero(n > 8), 8
    while len(more):
        if at == _LONG:
            h[more] = [xxhash.xxh3_64_intdigest(data[start[i]:end[i]]) for i in more]
            break
        rest = n[more] - at
        h[more] = mixed(h[more] * _STEP[1] + (eight[start[more] + at] & _FIRST_BYTES[np.minimum(rest, 8)]))
        more, at = more[rest > 8], at + 8
    return h, start


def tokens_of(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of lines that all have a word, and the line of each."""
    data = np.frombuffer(b"\n".join(lines).lower(), np.uint8)
    own, start = word_hashes(data)
    size = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
    first = np.searchsorted(start, np.cumsum(size) - size)              # each line's first word
    n = np.diff(np.append(first, len(own)))
    total = np.full(len(own), SHINGLE, np.uint64)                       # of the shingle from each word on, within its line or not
    for i in range(SHINGLE):
        total[:len(own) - i] += own[i:] * _STEP[i]
    keep = np.ones(len(own), bool)
    for k in range(1, SHINGLE):
        at = first + n - k
        keep[at[at > first]] = False
    short = np.flatnonzero(n < SHINGLE)
    if len(short):
        at, width = first[short], n[short]
        whole = width.astype(np.uint64)
        for i in range(SHINGLE - 1):
            inside = i < width
            whole += np.where(inside, own[np.where(inside, at + i, 0)] * _STEP[i], np.uint64(0))
        total[at] = whole
    return mixed(total[keep]), np.repeat(np.arange(len(lines)), np.maximum(n - SHINGLE, 0) + 1)


#: Bits of a sort key: line of the batch, rarity, hash.
LINE_BITS, RARITY_BITS = 13, 6
TOKEN_BITS = 64 - LINE_BITS
HASH_BITS = TOKEN_BITS - RARITY_BITS


def ordered_tokens(h: np.ndarray, line: np.ndarray, rarity: np.ndarray, n: int):
    """Tokens by (line, rarity, hash) without repeats: token, line, position, size per line."""
    key = rarity[h >> np.uint64(64 - CELL_BITS)].astype(np.uint64) << np.uint64(HASH_BITS)
    key |= h >> np.uint64(64 - HASH_BITS)
    key |= line.astype(np.uint64) << np.uint64(TOKEN_BITS)
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    key = key[new]
    line = (key >> np.uint64(TOKEN_BITS)).astype(np.int64)
    size = np.bincount(line, minlength=n)
    position = np.arange(len(key)) - (np.cumsum(size) - size)[line]
    return key & np.uint64((1 << TOKEN_BITS) - 1), line, position, size


def cell_of(token: np.ndarray) -> np.ndarray:
    return (token & np.uint64((1 << HASH_BITS) - 1)) >> np.uint64(HASH_BITS - CELL_BITS)


def prefix_length(size: np.ndarray) -> np.ndarray:
    return size - -(-MATCH[1] * size // MATCH[0]) + 1


def class_id(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line)


def batches_of_docs(batches, rows: int = 128):
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def worded(line: bytes) -> bool:
    return bool(line) and not line.isspace()


def raws(column) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def sketch(docs: DataFrame) -> np.ndarray:
    """Counts over the shingles of all distinct lines of each task, added up by cell of the hash."""
    cells, ranges = 1 << CELL_BITS, 16
    step = cells // ranges

    def count(batches):
        seen, total, held = set(), np.zeros(cells, np.int64), []
        for b in batches_of_docs(batches):
            lines = []
            for t in raws(b.column(0)):
                for x in t.split(b"\n"):
                    if (c := class_id(x)) not in seen:
                        seen.add(c)
                        if worded(x):
                            lines.append(x)
            if lines:
                h, _ = tokens_of(lines)
                held.append((h >> np.uint64(64 - CELL_BITS)).astype(np.int32))
                if sum(map(len, held)) >= cells:        # counting costs a pass over all cells
                    total += np.bincount(np.concatenate(held), minlength=cells)
                    held = []
        if held:
            total += np.bincount(np.concatenate(held), minlength=cells)
        yield pa.RecordBatch.from_arrays([pa.array(range(ranges), pa.int32()),
                                          pa.array([total[i * step:(i + 1) * step].astype("<u4").tobytes() for i in range(ranges)], pa.binary())],
                                         ["part", "counts"])

    def add(key, group):
        total = np.zeros(step, np.int64)
        for c in group.column("counts"):
            total += np.frombuffer(c.as_buffer(), "<u4")
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = docs.select("text").mapInArrow(lean(count), "part int, counts binary")
    got = parts.groupBy("part").applyInArrow(add, "part int, counts binary").collect()   # 16 rows, 8 MB in all
    total = np.zeros(cells, np.int64)
    for r in got:
        total[r["part"] * step:(r["part"] + 1) * step] = np.frombuffer(r["counts"], np.int64)
    return total


POSTING = np.dtype([("token", "<u8"), ("cid", "<u8"), ("doc", "<i8"), ("line", "<u4"), ("size", "<u4"), ("pos", "<u4"), ("sign", "<u4")])


#: Columns of hashes, which do not shrink.
AS_THEY_ARE = {"cid", "sign", "check", "text"}


def squeezed(columns: dict[str, np.ndarray]) -> bytes:
    """Columns, all but hashes byte by byte, compressed: places and sizes are mostly small numbers."""
    flat = (np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1) for c in columns.values())
    return zstandard.ZstdCompressor(level=1).compress(b"".join((x if k in AS_THEY_ARE else x.T).tobytes() for k, x in zip(columns, flat)))


def packed(p: np.ndarray) -> bytes:
    p = p[np.argsort(p["doc"], kind="stable")]
    return squeezed({k: p[k] for k in p.dtype.names})


def column(flat: np.ndarray, kind: np.dtype, name: str) -> np.ndarray:
    """A column of what ``squeezed`` made, from its bytes."""
    n, own = len(flat) // kind.itemsize, kind[name]
    at = n * sum(kind[k].itemsize for k in kind.names[:kind.names.index(name)])
    flat = flat[at:at + n * own.itemsize]
    return (flat if name in AS_THEY_ARE else np.ascontiguousarray(flat.reshape(own.itemsize, n).T)).view(own).ravel()


def opened(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)


def unpacked(data: bytes, kind: np.dtype = POSTING) -> np.ndarray:
    flat = opened(data)
    p = np.empty(len(flat) // kind.itemsize, kind)
    for k in kind.names:
        p[k] = column(flat, kind, k)
    return p


def postings(docs: DataFrame, shared, buckets: int) -> DataFrame:
    """(bucket, data): packed postings of the prefix tokens of each task's distinct lines."""

    def run(batches):
        rarity, spread, _ = shared.value
        first, lines, cids, docs_, numbers = {}, [], [], [], []
        out: list[tuple] = []               # buckets and columns of postings
        held = 0

        def flush():
            nonlocal lines, cids, docs_, numbers
            h, line = tokens_of(lines)
            key, line, pos, size = ordered_tokens(h, line, rarity, len(lines))
            # one bit per token, added mod 2: sets differ in at least as many tokens as their signs in bits
            sign = np.bitwise_xor.reduceat(np.uint32(1) << (key & np.uint64(31)).astype(np.uint32), np.cumsum(size) - size)
            inside = pos < prefix_length(size)[line]
            key, line, pos = key[inside], line[inside], pos[inside]
            cid, doc, number = (np.array(x, t) for x, t in zip((cids, docs_, numbers), ("<u8", "<i8", "<u4")))
            of = cid[line]
            bucket = mixed(key + of % spread[cell_of(key)] * _STEP[1]) % np.uint64(buckets)
            out.append((bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32), key, of, doc[line], number[line],
                        size[line].astype(np.uint32), pos.astype(np.uint32), sign[line]))
            lines, cids, docs_, numbers = [], [], [], []

        for b in batches_of_docs(batches):
            for doc, t in zip(b.column(0).to_pylist(), raws(b.column(1))):
                doc = LAST if doc is None else doc
                for i, x in enumerate(t.split(b"\n")):
                    c = class_id(x)
                    old, new = first.get(c), (doc, i)
                    if old is None or new < old:
                        # a class met again earlier (rows are in no order) is posted again; the bucket keeps the earliest
                        first[c] = new
                        if worded(x):
                            lines.append(x)
                            cids.append(c), docs_.append(doc), numbers.append(i)
                            if len(lines) == 1 << LINE_BITS or i & 4095 == 4095:
                                held += len(lines)
                                flush()
            if held > 50_000:           # bounded memory: send what has gathered
                yield packed_rows(out)
                out, held = [], 0
        if lines:
            flush()
        if out:
            yield packed_rows(out)

    def packed_rows(out):
        bucket, *columns = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(ends))
        columns = {k: c[order] for k, c in zip(POSTING.names, columns)}
        data = [squeezed({k: c[ends[i]:ends[i + 1]] for k, c in columns.items()}) for i in full]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "bucket int, data binary")


def bound_holds(a, b) -> np.ndarray:
    """Length and positional filter and the bound from the signs, for postings of one token."""
    sa, sb = a["size"].astype(np.int64), b["size"].astype(np.int64)
    pa_, pb = a["pos"].astype(np.int64), b["pos"].astype(np.int64)
    most = 1 + np.minimum(sa - pa_ - 1, sb - pb - 1) + np.minimum(pa_, pb)
    differ = np.bitwise_count(a["sign"] ^ b["sign"]).astype(np.int64)
    return ((MATCH[0] * np.minimum(sa, sb) >= MATCH[1] * np.maximum(sa, sb)) & (MATCH[0] * most >= MATCH[1] * (sa + sb - most))
            & ((MATCH[0] + MATCH[1]) * differ <= (MATCH[0] - MATCH[1]) * (sa + sb)))


def met(data: list[bytes], spread: np.ndarray) -> np.ndarray:
    """A bucket's packed postings without the tokens that occur once: those have no partner."""
    flats = [opened(x) for x in data]
    whole = lambda name: np.concatenate([column(f, POSTING, name) for f in flats])
    token = whole("token")
    order = np.argsort(token)
    token = token[order]
    same = token[1:] == token[:-1]
    pick = order[np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (spread[cell_of(token)] > 1)]
    p = np.empty(len(pick), POSTING)
    for k in POSTING.names:
        p[k] = whole(k)[pick]
    return p


def paired(p: np.ndarray, spread: np.ndarray, small: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket's postings: rows (later, earlier) of small tokens that pass the bounds, each pair once, whether the
    earlier is a token's earliest, and the postings of large tokens."""
    # most tokens are met once: only the others are put in order
    order = np.argsort(p["token"])
    token = p["token"][order]
    same = token[1:] == token[:-1]
    p = p[order[np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (spread[cell_of(token)] > 1)]]
    if not len(p):
        return p, p, np.zeros(0, bool), p
    p = p[np.lexsort((p["line"], p["doc"], p["cid"], p["token"]))]
    new = np.ones(len(p), bool)
    new[1:] = (p["token"][1:] != p["token"][:-1]) | (p["cid"][1:] != p["cid"][:-1])
    p = p[new]                                              # the earliest posting of each class
    p = p[np.lexsort((p["cid"], p["line"], p["doc"], p["token"]))]
    start = np.flatnonzero(np.concatenate([[True], p["token"][1:] != p["token"][:-1]]))
    m = np.diff(np.concatenate([start, [len(p)]]))
    large = np.repeat((m > small) | (spread[cell_of(p["token"][start])] > 1), m)
    begin = np.repeat(start, m)
    at, rest = np.flatnonzero(~large), (begin + np.repeat(m, m) - np.arange(len(p)) - 1)[~large]     # rows, and how many of their token follow
    key, later, earlier = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
    for d in range(1, small):
        at, rest = at[rest >= d], rest[rest >= d]
        if not len(at):
            break
        i = at[bound_holds(p[at], p[at + d])]
        # a pair met again stays once, first as one with the token's earliest
        key = np.concatenate([key, mixed(p["cid"][i + d]) + p["cid"][i]])
        later, earlier = np.concatenate([later, i + d]), np.concatenate([earlier, i])
        order = np.lexsort((earlier != begin[earlier], key))
        once = order[np.concatenate([[True], key[order][1:] != key[order][:-1]])] if len(order) else order
        key, later, earlier = key[once], later[once], earlier[once]
    return p[later], p[earlier], earlier == begin[earlier], p[large]


def candidates(posted: DataFrame, shared) -> DataFrame:
    """Rows of two kinds: a pair (later, earlier) of a small token, or (token, later) of a large one; all with the later's place."""

    def run(key, group):
        _, spread, small = shared.value
        a, b, lead, crowd = paired(met(group.column("data").to_pylist(), spread), spread, small)
        give_back()
        col = lambda x: pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))
        return pa.table(
            [pa.concat_arrays([pa.nulls(len(a), pa.int64()), col(np.ascontiguousarray(crowd["token"]))]),
             col(np.concatenate([a["cid"], crowd["cid"]])),
             pa.concat_arrays([col(np.ascontiguousarray(b["cid"])), pa.nulls(len(crowd), pa.int64())]),
             pa.concat_arrays([pa.array(lead), pa.nulls(len(crowd), pa.bool_())]),
             *(col(np.concatenate([a[k], crowd[k]])) for k in ("doc", "line", "size", "sign"))],
            ["token", "later", "earlier", "lead", "doc", "line", "size", "sign"])

    return posted.groupBy("bucket").applyInArrow(
        run, "token long, later long, earlier long, lead boolean, doc long, line long, size long, sign long")


def bloom_places(cid: np.ndarray) -> list[np.ndarray]:
    h = mixed(cid)
    return [(h >> np.uint64(s)) & np.uint64((1 << BLOOM_BITS) - 1) for s in (0, 20, 38)]


def bloom(ids: DataFrame) -> np.ndarray:
    """A Bloom filter (8 MB of bits) over the ids; tasks send filled pieces only."""
    bits, piece = 1 << BLOOM_BITS, 1 << 16

    def fill(batches):
        own = np.zeros(bits // 8, np.uint8)
        for b in batches:
            for at in bloom_places(np.asarray(b.column(0)).view(np.uint64)):
                np.bitwise_or.at(own, at >> np.uint64(3), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
        step = piece // 8
        rows = [i for i in range(bits // piece) if own[i * step:(i + 1) * step].any()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([own[i * step:(i + 1) * step].tobytes() for i in rows], pa.binary())],
                                         ["part", "bits"])

    def join(key, group):
        out = np.zeros(piece // 8, np.uint8)
        for c in group.column("bits"):
            out |= np.frombuffer(c.as_buffer(), np.uint8)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([out.tobytes()], pa.binary())})

    whole = np.zeros(bits // 8, np.uint8)
    for r in ids.mapInArrow(lean(fill), "part int, bits binary").groupBy("part").applyInArrow(join, "part int, bits binary").collect():
        whole[r["part"] * piece // 8:(r["part"] + 1) * piece // 8] = np.frombuffer(r["bits"], np.uint8)
    return whole


def may_hold(ids: DataFrame, spark: SparkSession):
    """A function on a column of digests: false where the digest is surely not among ``ids``."""
    filter_ = spark.sparkContext.broadcast(bloom(ids))      # of fixed size

    @F.arrow_udf(T.BooleanType())
    def held(digest: pa.Array) -> pa.Array:
        bits, ok = filter_.value, np.ones(len(digest), bool)
        for at in bloom_places(np.asarray(digest).view(np.uint64)):
            ok &= (bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
        return pa.array(ok)

    return held


#: Words of a class's sign, which has a bit per token, added mod 2.
SIGN = [f"s{k}" for k in range(8)]


def signs_of(h: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """The words of the signs of sets that begin at ``start``; two sets differ in at least as many tokens as their signs in bits."""
    bit, lane = np.uint64(1) << (h & np.uint64(63)), (h >> np.uint64(6)) & np.uint64(len(SIGN) - 1)
    return [np.bitwise_xor.reduceat(np.where(lane == k, bit, np.uint64(0)), start).view(np.int64) for k in range(len(SIGN))]


FIRST = np.dtype([("cid", "<u8"), ("check", "<u8"), ("doc", "<i8"), ("line", "<i8"), ("text", "<i8")])
#: Columns of what one scan of the texts yields: sets of classes; packed first places of lines by bucket; lines that repeat one of their task.
SET = ["cid", "n", *SIGN, "hashes"]
LINES = ["bucket", "data", "doc", "text", "line"]


def first_buckets(spark: SparkSession) -> int:
    return 4 * partitions(spark)


def scanned(keyed: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts read again: SET of the classes wanted and a few others, once per task that meets the class, and LINES of all
    lines; ``keyed`` has doc_id, text and the text's hash."""
    spark = keyed.sparkSession
    buckets = first_buckets(spark)
    filter_ = spark.sparkContext.broadcast(bloom(ids))      # of fixed size
    kinds = {"cid": pa.int64(), "n": pa.int64(), **{k: pa.int64() for k in SIGN}, "hashes": pa.binary(),
             "bucket": pa.int32(), "data": pa.binary(), "doc": pa.int64(), "text": pa.int64(), "line": pa.int64()}

    def rows(count: int, /, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cols[k], t) if k in cols else pa.nulls(count, t) for k, t in kinds.items()], list(kinds))

    def run(batches):
        seen, bits = set(), filter_.value
        best: dict[int, tuple] = {}
        for b in batches_of_docs(batches):
            doc, text, line = [], [], []
            lines, cids = [], []
            for d, x, h in zip(b.column(0).to_pylist(), raws(b.column(1)), b.column(2).to_pylist()):
                d = LAST if d is None else d
                for i, s in enumerate(x.split(b"\n")):
                    if not worded(s):
                        continue
                    c = class_id(s)
                    lines.append(s)
                    cids.append(c)
                    old, new = best.get(c), (d, i, h, xxhash.xxh3_64_intdigest(s, 1))
                    if old is None:
                        best[c] = new
                        continue
                    if new[:3] == old[:3]:
                        continue            # the same document again
                    if new < old:
                        best[c], new = new, old
                    doc.append(new[0]), line.append(new[1]), text.append(new[2])
            if doc:
                yield rows(len(doc), doc=doc, text=text, line=line)
            cid = np.array(cids, np.uint64)
            ok = np.ones(len(cid), bool)
            for at in bloom_places(cid):
                ok &= (bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
            pick = [i for i in np.flatnonzero(ok) if cids[i] not in seen and not seen.add(cids[i])]
            if not pick:
                continue
            h, line = tokens_of([lines[i] for i in pick])
            order = np.lexsort((h, line))
            h, line = h[order], line[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
            h, line = h[new], line[new]
            ends = np.searchsorted(line, np.arange(len(pick) + 1))
            yield rows(len(pick), cid=cid[pick].view(np.int64), n=np.diff(ends), **dict(zip(SIGN, signs_of(h, ends[:-1]))),
                       hashes=[h[ends[k]:ends[k + 1]].tobytes() for k in range(len(pick))])
        f = np.array([(c, v[3], v[0], v[1], v[2]) for c, v in best.items()], FIRST)
        bucket = (mixed(f["cid"].copy()) % np.uint64(buckets)).astype(np.int64)
        parts = [(int(i), packed(f[bucket == i])) for i in np.unique(bucket)]
        yield rows(len(parts), bucket=[i for i, _ in parts], data=[p for _, p in parts])

    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return keyed.mapInArrow(lean(run), ", ".join(f"{k} {names[t]}" for k, t in kinds.items()))


def passing(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs whose sizes and signs do not rule out that they are similar."""
    side = lambda name, tag: signs.select(F.col("cid").alias(name), *(F.col(k).alias(tag + k) for k in ("n", *SIGN)))
    differ = sum((F.bit_count(F.col("x" + k).bitwiseXOR(F.col("y" + k))) for k in SIGN), F.lit(0))
    least, most = F.least("xn", "yn"), F.greatest("xn", "yn")
    return (pairs.join(side("later", "x"), "later").join(side("earlier", "y"), "earlier")
            .where((MATCH[0] * least >= MATCH[1] * most) & ((MATCH[0] + MATCH[1]) * differ <= (MATCH[0] - MATCH[1]) * (F.col("xn") + F.col("yn"))))
            .select("later", "earlier"))


def only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """(cid, hashes) of ``ids`` and a few others, each once; few sets are shuffled."""
    wanted = may_hold(ids, ids.sparkSession)
    return sets.where(wanted("cid")).select("cid", "hashes").dropDuplicates(["cid"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    sets = only(sets, pairs.select(F.explode(F.array("later", "earlier")).alias("cid")).distinct())
    both = (pairs.join(sets.select(F.col("cid").alias("later"), F.col("hashes").alias("x")), "later")
            .join(sets.select(F.col("cid").alias("earlier"), F.col("hashes").alias("y")), "earlier").select("later", "x", "y"))

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(1), b.column(2)):
                x, y = (np.frombuffer(c.as_buffer(), np.uint64) for c in (x, y))
                i = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(MATCH[0] * i >= MATCH[1] * (len(x) + len(y) - i))
            yield b.filter(pa.array(keep, pa.bool_())).select(["later"])

    return both.mapInArrow(lean(run), "later long")


def chunked(crowd: DataFrame, open_: DataFrame, known: DataFrame) -> DataFrame:
    """(token, x, y): chunks of the open classes of each token beside chunks of all its classes, with what is known of them."""
    want = open_.select("token").distinct()
    sizes = cut(crowd.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")).join(want, "token"))
    part = cut(crowd.select("token", "later", "doc", "line").join(sizes, "token")
               .withColumn("salt", F.pmod(F.xxhash64("later"), F.col("chunks"))))
    known = known.withColumnRenamed("cid", "later")
    more = [c for c in known.columns if c != "later"]

    def chunks(rows: DataFrame, tag: str) -> DataFrame:
        return cut(rows.join(known, "later").groupBy("token", "salt")
                   .agg(F.collect_list(F.struct("later", "doc", "line", *more)).alias(tag)).select("token", tag))

    xs = chunks(part.join(open_.select("token", "later").distinct(), ["token", "later"], "left_semi"), "x")
    return xs.join(chunks(part, "y"), "token")


def place(e) -> tuple:
    return e["doc"], e["line"], e["later"]


def near(crowd: DataFrame, open_: DataFrame, signs: DataFrame) -> DataFrame:
    """(token, later, open): open classes with an earlier one of the token that sizes and signs do not rule out, and those earlier ones."""

    def columns(lists: pa.ListArray) -> tuple[np.ndarray, ...]:
        """Ends of the lists, then of all their members: class, document, line, size and sign."""
        v = lists.flatten()
        own = {k: np.asarray(v.field(v.type.get_field_index(k))) for k in ("later", "doc", "line", "n", *SIGN)}
        sign = np.stack([own[k].view(np.uint64) for k in SIGN], axis=1)
        return np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]), own["later"], own["doc"], own["line"], own["n"], sign

    def run(batches):
        for b in batches:
            (xe, *xs), (ye, *ys) = columns(b.column(1)), columns(b.column(2))
            for i, token in enumerate(b.column(0).to_pylist()):
                later, doc, line, n, sign = (c[xe[i]:xe[i + 1], None] for c in xs)
                later_, doc_, line_, n_, sign_ = (c[None, ye[i]:ye[i + 1]] for c in ys)
                before = (doc_ < doc) | (doc_ == doc) & ((line_ < line) | (line_ == line) & (later_ < later))
                differ = np.bitwise_count(sign ^ sign_).sum(axis=2, dtype=np.int64)
                ok = (before & (MATCH[0] * np.minimum(n, n_) >= MATCH[1] * np.maximum(n, n_))
                      & ((MATCH[0] + MATCH[1]) * differ <= (MATCH[0] - MATCH[1]) * (n + n_)))
                own, other = later[ok.any(axis=1), 0], later_[0, ok.any(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own) + len(other), token)), pa.array(np.concatenate([own, other])),
                     pa.array(np.arange(len(own) + len(other)) < len(own))], ["token", "later", "open"])

    return (chunked(crowd, open_, signs).mapInArrow(lean(run), "token long, later long, open boolean")
            .groupBy("token", "later").agg(F.max("open").alias("open")))


def among(crowd: DataFrame, open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Classes of ``open_`` that match an earlier class with the same large token, compared chunk by chunk."""
    both = chunked(crowd, open_, cut(only(sets, crowd.select(F.col("later").alias("cid")).distinct()))).drop("token")

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ys = sorted(r["y"], key=place)
                sets_ = [np.frombuffer(y["hashes"], np.uint64) for y in ys]
                universe, at_ = np.unique(np.concatenate(sets_), return_inverse=True)
                size = np.array([len(s) for s in sets_])
                starts = np.concatenate([[0], np.cumsum(size)[:-1]])
                out = []
                for e in r["x"]:
                    x = np.frombuffer(e["hashes"], np.uint64)
                    at = np.minimum(np.searchsorted(universe, x), len(universe) - 1)
                    mark = np.zeros(len(universe), np.int64)
                    mark[at[universe[at] == x]] = 1
                    inter = np.add.reduceat(mark[at_], starts)
                    ok = np.flatnonzero(MATCH[0] * inter >= MATCH[1] * (len(x) + size - inter))
                    if any(place(ys[i]) < place(e) for i in ok[:1]):
                        out.append(e["later"])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["later"])

    return both.mapInArrow(lean(run), "later long")


def similar_to_earlier(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cid): the classes of lines that are similar to a class that occurs earlier; and the LINES of all texts."""
    spark = docs.sparkSession
    counts = sketch(docs)
    rarity = np.minimum(np.log2(np.maximum(counts, 1)), (1 << RARITY_BITS) - 1).astype(np.uint8)
    typical = max(int(np.median(counts)), 1)
    spread = np.maximum(1, (counts - 4 * typical) // SPREAD).astype(np.uint64)
    shared = spark.sparkContext.broadcast((rarity, spread, SMALL))
    release(spark)
    found = cut(candidates(postings(docs, shared, 8 * partitions(spark)), shared))
    release(spark)
    small = cut(found.where(F.col("token").isNull()).groupBy("later", "earlier").agg(F.max("lead").alias("lead")))
    crowd = cut(found.where(F.col("token").isNotNull()).groupBy("token", "later")
                .agg(F.min(F.struct("doc", "line", "size", "sign")).alias("o")).select("token", "later", "o.*"))
    first = cut(crowd.groupBy("token").agg(F.min(F.struct("doc", "line", "later", "size", "sign")).alias("f"))
                .select("token", F.col("f")["later"].alias("earlier"), F.col("f")["size"].alias("n"), F.col("f")["sign"].alias("s")))
    star = cut(crowd.join(first, "token").where(F.col("later") != F.col("earlier")))
    differ = F.bit_count(F.col("sign").bitwiseXOR(F.col("s")))
    near_first = star.where((MATCH[0] + MATCH[1]) * differ <= (MATCH[0] - MATCH[1]) * (F.col("size") + F.col("n")))
    ids = small.select(F.col("later").alias("cid")).union(small.select("earlier")).union(crowd.select("later"))
    scan = cut(scanned(docs.withColumn("t", F.xxhash64("text")), cut(ids.distinct())))
    sets, sent = scan.where(F.col("cid").isNotNull()).select(SET), scan.where(F.col("cid").isNull()).select(LINES)
    signs = cut(sets.drop("hashes").dropDuplicates(["cid"]))
    del found, first
    release(spark)
    # step 1: with the earliest class of each token
    lead = cut(passing(small.where("lead").select("later", "earlier").union(near_first.select("later", "earlier")).distinct(), signs))
    gone = cut(verified(lead, sets).distinct())
    release(spark)
    # step 2: only what is still open, with the others
    rest = cut(passing(small.where(~F.col("lead")).join(gone, "later", "left_anti").select("later", "earlier"), signs))
    if not rest.isEmpty():
        gone = cut(gone.union(verified(rest, sets)).distinct())
        release(spark)
    open_ = cut(star.join(gone, "later", "left_anti"))
    if not open_.isEmpty():
        left = cut(near(crowd.join(open_.select("token").distinct(), "token", "left_semi"), open_, signs))
        release(spark)
        if not left.isEmpty():
            gone = gone.union(among(crowd.join(left, ["token", "later"], "left_semi"), left.where("open"), sets)).distinct()
    return gone.select(F.col("later").alias("cid")), sent


def removals(sent: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc, text, line): the lines that go, from the LINES of all texts."""
    buckets = first_buckets(sent.sparkSession)

    def to_bucket(batches):
        for b in batches:
            c = np.asarray(b.column(0)).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((mixed(c) % np.uint64(buckets)).astype(np.int32)), b.column(0)], ["bucket", "cid"])

    def decide(key, sent_rows, gone_rows):
        blobs = [unpacked(c.as_py(), FIRST) for c in sent_rows.column("data")]
        f = np.concatenate(blobs) if blobs else np.zeros(0, FIRST)
        f = f[np.lexsort((f["text"], f["line"], f["doc"], f["check"], f["cid"]))]
        again = np.zeros(len(f), bool)
        again[1:] = (f["cid"][1:] == f["cid"][:-1]) & (f["check"][1:] == f["check"][:-1])
        twin = again.copy()                     # the same document in two tasks: not a later line
        for k in ("doc", "line", "text"):
            twin[1:] &= f[k][1:] == f[k][:-1]
        bad = np.asarray(gone_rows.column("cid")).view(np.uint64) if gone_rows.num_rows else np.zeros(0, np.uint64)
        out = f[(again & ~twin) | np.isin(f["cid"], bad)]
        return pa.table({"doc": pa.array(out["doc"].copy()), "text": pa.array(out["text"].copy()), "line": pa.array(out["line"].copy())})

    decided = (sent.where(F.col("bucket").isNotNull()).select("bucket", "data").groupBy("bucket")
               .cogroup(gone.mapInArrow(lean(to_bucket), "bucket int, cid long").groupBy("bucket"))
               .applyInArrow(decide, "doc long, text long, line long"))
    return sent.where(F.col("bucket").isNull()).select("doc", "text", "line").union(decided)


def dedup_lines(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` plus two columns: the text left and the numbers of the lines removed (null: none)."""
    out, cut_lines, t = fresh("text"), fresh("removed"), fresh("hash")
    doc, text = fresh("doc"), fresh("t")
    source = docs.select("doc_id", "text")
    gone, sent = similar_to_earlier(source)
    gone = cut(gone)
    release(docs.sparkSession)
    lines = cut(removals(sent, gone).groupBy(F.col("doc").alias(doc), F.col("text").alias(text))
                .agg(F.collect_set("line").alias(cut_lines)))
    release(docs.sparkSession)
    key = [F.coalesce(F.col("doc_id"), F.lit(int(LAST))), F.xxhash64("text")]
    loses = may_hold(lines.select(F.xxhash64(doc, text)), docs.sparkSession)
    flagged = docs.withColumn(t, loses(F.xxhash64(*key)))
    # only texts that may lose a line are shuffled, the join decides
    touched = flagged.where(t).join(lines.hint("shuffle_hash"), (key[0] == F.col(doc)) & (key[1] == F.col(text)), "left").drop(doc, text, t)
    whole = flagged.where(~F.col(t)).withColumns({cut_lines: F.lit(None).cast(lines.schema[cut_lines].dataType), out: F.col("text")}).drop(t)

    def make():
        def work(texts: pa.Array, removed: pa.Array) -> list:
            done = []
            for x, r in zip(texts, removed):
                if not r.is_valid:
                    done.append(x.as_py())
                    continue
                skip = set(r.as_py())
                done.append("\n".join(s for i, s in enumerate(x.as_py().split("\n")) if i not in skip))
            return [done]
        return work

    return append(touched, ["text", cut_lines], [(out, T.StringType())], make).unionByName(whole), out, cut_lines


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, text, removed = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col(text).alias("text"), F.coalesce(F.size(removed), F.lit(0)).cast("long").alias("n_removed"),
                       F.sort_array(removed).alias("removed_lines"))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document without the lines that repeat earlier ones, and its new length."""
    done, text, _ = dedup_lines(docs)
    return done.select(*(F.col(text).alias("text") if c == "text" else
                         F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else F.col(c)
                         for c in docs.columns))


QUERIES = {"op10_line_dedup": op10_line_dedup}
SQL: dict[str, str] = {}
