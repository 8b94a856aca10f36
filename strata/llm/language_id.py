"""Language identification by cross-parsing entropy.

One suffix automaton per language, for every language there is, is built over
a bounded sample of its labelled text.  A document is parsed greedily into longest phrases that occur in a
language's sample; few phrases mean a short description, so the language with
the smallest ``phrases * log2(sample length) / characters`` wins.

Parsing is vectorised: a batch of texts is cut into blocks of ``BLOCK``
characters (a phrase ends at a block's end), and all blocks step through the
dense transition tables of a group of languages together; a group's tables are
bounded, and with more than one group each batch of texts is parsed against one
after the other.  Every character of every text is parsed.

Defined results: ``und`` with score 0 for a null text or one without a
letter, and for all rows when there is no labelled text to learn from.
Repeated rows are predicted one by one; ties go to the language first in
alphabetical order.  Extra columns pass through.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import append, fresh, table

#: Bounds of what is learned from: documents per language, characters of one document.
MAX_DOCS, WINDOW = 96, 600
#: Cells of the tables of one group of languages; a language by itself may have more.
CELLS = 80_000_000
BLOCK = 256
#: Characters parsed at once, with one group of languages and with several, whose tables are built for each batch.
BATCH_CHARS, LONG_BATCH_CHARS = 2_000_000, 16_000_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def letters_of(text: str | None) -> np.ndarray:
    """Lower-case code points; each run of anything but letters becomes one space."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = _letters()[points]
    keep = alpha.copy()
    keep[1:] |= alpha[:-1]              # the first non-letter after a letter stays as the space
    return np.where(alpha, points, 32)[keep]


def suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions (states x width, -1: none) of the automaton of all factors of ``codes``."""
    link, length, nexts = [-1], [0], [{}]
    last = 0
    for c in codes:
        cur = len(nexts)
        length.append(length[last] + 1)
        nexts.append({})
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                length.append(length[p] + 1)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    out = np.full((len(nexts), width), -1, np.int32)
    for s, t in enumerate(nexts):
        for c, d in t.items():
            out[s, c] = d
    return out


class Model:
    """Languages and their samples; the tables are built where they are used."""

    def __init__(self, samples: dict[str, list[str]]):
        self.samples = tuple((k, "\n".join(samples[k])) for k in sorted(samples))

    def parser(self) -> Parser | None:
        return _parser(self.samples) if self.samples else None


class Tables:
    """The automata of some languages' samples as one dense table."""

    def __init__(self, texts: list[np.ndarray]):
        alphabet = np.unique(np.concatenate(texts + [np.array([32], np.uint32)]))
        self.alphabet, pad = alphabet, len(alphabet) + 1      # len(alphabet): any other letter
        self.width, self.pad = len(alphabet) + 2, pad
        tables, starts, at = [], [], 0
        for t in texts:
            trans = suffix_automaton(np.searchsorted(alphabet, t).tolist(), self.width)
            # the last state is "no phrase open": every character from it, and every missing transition,
            # begins a phrase, written as the complement of the state after it
            closed = at + len(trans)
            begin = ~np.where(trans[0] >= 0, trans[0] + at, closed)
            table_ = np.where(trans >= 0, trans + at, begin[None, :])
            table_ = np.concatenate([table_, begin[None, :]]).astype(np.int32)
            table_[:, pad] = closed
            tables.append(table_)
            starts.append(closed)
            at += len(table_)
        self.table = np.concatenate(tables).ravel()
        self.starts = np.array(starts, np.int32)

    def phrases(self, docs: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """Phrases of the parses, documents x languages."""
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        flat = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
        place = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        code = np.where(self.alphabet[place] == flat, place, len(self.alphabet)).astype(np.int32)
        grid = np.full((first[-1], BLOCK), self.pad, np.int32)
        start = np.repeat(first[:-1] * BLOCK - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        grid.ravel()[np.arange(len(flat)) + start] = code
        grid = np.ascontiguousarray(grid.T)
        state = np.repeat(self.starts[:, None], first[-1], axis=1)
        phrases = np.zeros(state.shape, np.int32)
        for column in grid:
            step = self.table.take(state * self.width + column[None, :])
            begun = step >> 31
            phrases -= begun
            state = step ^ begun
        owner = np.repeat(np.arange(len(docs)), blocks)
        return np.stack([np.bincount(owner, p, len(docs)) for p in phrases], axis=1)


class Parser:
    """Languages in groups whose tables fit ``CELLS``; the tables of a single group are kept."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        texts = [letters_of(t) for _, t in samples]
        self.langs = [k for k, _ in samples]
        self.bits = np.log2(np.array([max(len(t), 2) for t in texts]))
        self.groups: list[list[np.ndarray]] = [[]]
        alphabet, states = {32}, 0
        for t in texts:
            alphabet, states = alphabet | set(np.unique(t).tolist()), states + 2 * len(t) + 2
            if self.groups[-1] and states * (len(alphabet) + 2) > CELLS:
                self.groups.append([])
                alphabet, states = {32, *np.unique(t).tolist()}, 2 * len(t) + 2
            self.groups[-1].append(t)
        self.kept = Tables(self.groups[0]) if len(self.groups) == 1 else None
        self.batch_chars = BATCH_CHARS if self.kept else LONG_BATCH_CHARS

    def costs(self, docs: list[np.ndarray]) -> np.ndarray:
        """Bits per character, documents x languages."""
        sizes = np.array([len(d) for d in docs])
        total = np.concatenate([(self.kept or Tables(g)).phrases(docs, sizes) for g in self.groups], axis=1)
        return total * self.bits[None, :] / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out, batch, where, held = [("und", 0.0)] * len(texts), [], [], 0

        def flush():
            for i, cost in zip(where, self.costs(batch)):
                best = int(cost.argmin())
                rest = np.delete(cost, best)
                out[i] = (self.langs[best], float(1 - cost[best] / (cost[best] + rest.min())) if len(rest) else 1.0)

        for i, t in enumerate(texts):
            d = letters_of(t)
            if not len(d):
                continue
            batch.append(d)
            where.append(i)
            held += len(d)
            if held > self.batch_chars:
                flush()
                batch, where, held = [], [], 0
        if batch:
            flush()
        return out


@lru_cache(maxsize=2)
def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(samples)


def train(docs: DataFrame) -> Model:
    """Learns from rows with a non-null ``lang`` and text; the caller picks the rows.

    A bounded sample: per language the ``MAX_DOCS`` documents first by a hash,
    a window of ``WINDOW`` characters of each (at a place given by the hash).
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "n")
    picked = (rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"), F.length("text").alias("n"), "text")
              .select("lang", "doc_id", "h", "n", F.substring(
                  F.col("text"), (F.pmod("h", F.greatest(F.col("n") - WINDOW, F.lit(1))) + 1).cast("int"),
                  F.lit(WINDOW)).alias("t"))
              .withColumn("r", F.row_number().over(order)).where(F.col("r") <= MAX_DOCS))
    samples: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["r"])):
        samples.setdefault(r["lang"], []).append(r["t"])
    return Model(samples)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus one struct column (``lang``, ``score``)."""
    name = fresh("lang")
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def make():
        parser = model.parser()

        def work(texts: pa.Array) -> list:
            got = parser.predict(texts.to_pylist()) if parser else [("und", 0.0)] * len(texts)
            return [[{"lang": a, "score": min(1.0, max(0.0, b))} for a, b in got]]
        return work

    return append(docs, [text_col], [(name, kind)], make), name


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
    out, name = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                      F.col(name)["lang"].alias("lang_pred"), F.col(name)["score"].alias("score"))


QUERIES = {"op5_language_id": op5_language_id}
SQL: dict[str, str] = {}
