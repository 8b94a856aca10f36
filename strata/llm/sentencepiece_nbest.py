"""N-best SentencePiece segmentation and its inverse.

A text is a lattice of pieces whose path score is the sum of the pieces'
scores.  No piece of the model spans a word start, so the lattice is a chain
of chunks.  In a chunk, forward Viterbi scores are the exact heuristic of a
backward A* search, which therefore expands only what belongs to the best
paths; the paths of the whole text come from a heap over the chunks' losses.
A worker remembers the results of chunks it has met.

Scores are summed exactly (the model's are whole numbers).  Paths of equal
score come in the order of discovery, which depends on the text alone.  A
character that no piece covers is spelled in byte pieces at a score below all
others.  Decoding joins pieces and bytes, turns the meta symbol into a space
and drops the one that encoding puts in front.

Defined results: a null or empty text has one path without pieces, score 0.
A text with fewer than n paths returns them all.  The meta symbol in a text
decodes to a space.  Repeated rows are encoded one by one; texts of any length
are read whole; extra columns pass through.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, fresh, table

N_BEST = 3
META = "▁"
CHUNKS = re.compile(r" *[^ ]+| +")
#: Chunks a worker remembers; half of them, the older ones, are dropped beyond it.
CACHE_CHUNKS = 1_200_000


class Lattice:
    """Pieces, scores and byte pieces of a model; finds the best paths of a chunk."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int] | None, unknown: int, n: int):
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.scores = {p: s for p, (_, s) in pieces.items()}
        self.byte_ids, self.unknown, self.n = byte_ids, unknown, n
        self.longest = max(map(len, pieces), default=1)
        # children and, where a piece ends, its score
        self.root: dict = {}
        for piece, score in self.scores.items():
            children = self.root
            for ch in piece[:-1]:
                children = children.setdefault(ch, [{}, None])[0]
            children.setdefault(piece[-1], [{}, None])[1] = score
        self.least = min(self.scores.values(), default=0.0) - 10.0

    def spelled(self, ch: str) -> tuple[list[int], float]:
        if self.byte_ids is None:
            return [self.unknown], self.least
        ids = [self.byte_ids[b] for b in ch.encode("utf-8", "surrogatepass")]
        return ids, self.least * len(ids)

    def piece_score(self, piece: str) -> float:
        return self.scores[piece] if piece in self.scores else self.spelled(piece)[1]

    def piece_ids(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else self.spelled(piece)[0]

    def forward(self, chunk: str) -> tuple[list[float], list[float], list[int]]:
        """Viterbi: the best and second-best score to every position, and where the best comes from."""
        none, size, root = float("-inf"), len(chunk), self.root
        best, second, origin = [none] * (size + 1), [none] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        for start in range(size):
            first, other = best[start], second[start]
            children, end = root, start
            for ch in chunk[start:start + self.longest]:
                hit = children.get(ch)
                end += 1
                if hit is None:
                    if end > start + 1 or ch in self.scores:
                        break
                    hit = None, self.spelled(ch)[1]
                elif hit[1] is None and end == start + 1 and ch not in self.scores:
                    hit = hit[0], self.spelled(ch)[1]
                children, s = hit
                if s is not None:
                    v = first + s
                    if v > best[end]:
                        second[end] = best[end]
                        best[end] = v
                        origin[end] = start
                    elif v > second[end]:
                        second[end] = v
                    v = other + s
                    if v > second[end]:
                        second[end] = v
                if children is None:
                    break
        return best, second, origin

    def one_best(self, chunk: str) -> tuple[list[int], float, float]:
        """Ids and score of the best path, and what the second one loses."""
        best, second, origin = self.forward(chunk)
        ids, end = [], len(chunk)
        while end:
            start = origin[end]
            ids[:0] = self.piece_ids(chunk[start:end])
            end = start
        return ids, best[-1], best[-1] - second[-1]

    def best(self, chunk: str) -> list[tuple[float, list[int]]]:
        """At most n paths of a chunk, best first."""
        size = len(chunk)
        score, _, _ = self.forward(chunk)
        into: list[list[tuple[int, float, str]]] = [[]]
        for end in range(1, size + 1):
            pieces = (chunk[start:end] for start in range(max(0, end - self.longest), end))
            into.append([(end - len(p), self.piece_score(p), p) for p in pieces if p in self.scores or len(p) == 1])
        # backward A*: what is done costs g, what is left costs exactly score[at]
        heap = [(-score[size], 0, size, 0.0, None)]
        order, found = 1, []
        while heap and len(found) < self.n:
            _, _, at, done, path = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids += self.piece_ids(path[0])
                    path = path[1]
                found.append((done, ids))
                continue
            for start, s, piece in into[at]:
                heapq.heappush(heap, (-(done + s + score[start]), order, start, done + s, (piece, path)))
                order += 1
        return found


def combined(losses: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n smallest sums that take one loss of each list (each sorted, from 0): sum and places."""
    zero = (0,) * len(losses)
    heap, seen, out = [(0.0, zero)], {zero}, []
    while heap and len(out) < n:
        total, at = heapq.heappop(heap)
        out.append((total, at))
        for i, k in enumerate(at):
            if k + 1 < len(losses[i]):
                after = at[:i] + (k + 1,) + at[i + 1:]
                if after not in seen:
                    seen.add(after)
                    heapq.heappush(heap, (total - losses[i][k] + losses[i][k + 1], after))
    return out


class Remembered(dict):
    """Chunk without the space that leads it -> (ids as bytes, score, loss of the second path)."""

    def __init__(self, lattice: Lattice):
        super().__init__()
        self.lattice, self.old = lattice, {}

    def __missing__(self, chunk: str):
        got = self.old.get(chunk)
        if got is None:
            ids, score, loss = self.lattice.one_best(META + chunk.replace(" ", META))
            got = (np.array(ids, "<u4").tobytes(), score, loss)
        if len(self) >= CACHE_CHUNKS // 2:
            self.old = dict(self)
            self.clear()
        self[chunk] = got
        return got


class Codec:
    def __init__(self, path: str, n: int):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        surface = [b""] * size
        pieces, byte_ids = {}, [0] * 256
        for i in range(size):
            p = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(p[3:-1], 16)] = i
                surface[i] = bytes([int(p[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[p] = (i, float(model.get_score(i)))
                surface[i] = p.replace(META, " ").encode()
        if any(META in p.lstrip(META) for p in pieces):
            raise ValueError("a piece spans a word start")
        self.lattice = Lattice(pieces, byte_ids if any(map(model.is_byte, range(size))) else None, model.unk_id(), n)
        self.known = Remembered(self.lattice)
        self.n = n
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.size = np.array([len(s) for s in surface])
        self.start = np.cumsum(self.size) - self.size

    def encode(self, text: str | None) -> list[tuple[float, np.ndarray]]:
        """The n best paths of a text: score and ids."""
        if not text:
            return [(0.0, np.zeros(0, "<u4"))]
        plain = text[0] != " " and text[-1] != " " and "  " not in text
        chunks = text.split(" ") if plain else [c[1:] for c in CHUNKS.findall(" " + text)]
        best, scores, losses = zip(*map(self.known.__getitem__, chunks))
        total = sum(scores)
        loss = np.array(losses)
        # the n - 1 chunks that lose least can alone differ in the n best paths
        near = np.argsort(loss, kind="stable")[:self.n - 1]
        near = near[np.isfinite(loss[near])]
        paths = [[(best[i], 0.0)] + [(np.array(ids, "<u4").tobytes(), scores[i] - s) for s, ids in
                                     self.lattice.best(META + chunks[i].replace(" ", META))[1:]] for i in near]
        out = []
        for lost, at in combined([[x for _, x in p] for p in paths], self.n):
            own = best
            if any(at):
                own = list(best)
                for i, p, k in zip(near, paths, at):
                    own[i] = p[k][0]
            out.append((total - lost, np.frombuffer(b"".join(own), "<u4")))
        return out

    def decode(self, ids: np.ndarray) -> str:
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)
        text = self.bytes[at].tobytes().decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def codec(path: str, n: int) -> Codec:
    return Codec(path, n)


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


PATH = [("rank", T.IntegerType()), ("score", T.DoubleType()), ("n_pieces", T.LongType()), ("ids_crc32", T.LongType()),
        ("round_trip", T.BooleanType())]


def encode(docs: DataFrame, n: int = N_BEST, model: str | None = None, text_col: str = "text",
           with_ids: bool = True) -> tuple[DataFrame, str]:
    """``docs`` plus an array of the n best paths: rank, score, pieces, CRC-32 of the ids, whether
    decoding gives the text back, and (``with_ids``) the ids."""
    name, path = fresh("paths"), model or piece_model()
    fields = PATH + ([("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    kind = T.ArrayType(T.StructType([T.StructField(a, t) for a, t in fields]))

    def make():
        own = codec(path, n)

        def work(texts: pa.Array) -> list:
            out = []
            for t in texts:
                text = t.as_py()
                rows = []
                for k, (score, ids) in enumerate(own.encode(text)):
                    row = {"rank": k + 1, "score": score, "n_pieces": len(ids), "ids_crc32": zlib.crc32(ids.tobytes()),
                           "round_trip": own.decode(ids) == (text or "").replace(META, " ")}
                    if with_ids:
                        row["ids"] = ids.astype(np.int32)
                    rows.append(row)
                out.append(rows)
            return [out]
        return work

    return append(docs, [text_col], [(name, kind)], make), name


def decode(rows: DataFrame, ids_col: str = "ids", model: str | None = None) -> tuple[DataFrame, str]:
    """``rows`` plus the text of their ids (null for null)."""
    name, path = fresh("text"), model or piece_model()

    def make():
        own = codec(path, N_BEST)

        def work(ids: pa.Array) -> list:
            return [[None if i.as_py() is None else own.decode(np.array(i.as_py(), np.int64)) for i in ids]]
        return work

    return append(rows, [ids_col], [(name, T.StringType())], make), name


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, paths = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
    return out.select("doc_id", F.explode(paths).alias("p")).select("doc_id", "p.*")


QUERIES = {"op3_sentencepiece": op3_sentencepiece}
SQL: dict[str, str] = {}
