"""Best-fit packing by minimum bin slack.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (``capacity`` rows at most, whatever the
input) is needed to plan the bins: for each bin the longest length left is
taken and a bitset subset-sum dynamic programme over the lengths still
available finds the fullest feasible rest.  That combination is removed as
often as the counts allow.  Pieces get their place by rank among the pieces
of their length: a rank inside the partition, written with the piece, plus
the counts of the partitions before it.  No pieces are gathered anywhere.

Defined results: a null or empty text is one piece holding the end token.
Repeated rows are packed one by one.  An empty table gives no rows.  A text of
any length is tokenised whole, word by word (white space separates words in
this vocabulary and leaves no token).  Extra columns are not returned.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import append, cut, table

CAPACITY = 4096
END = 1
#: Words whose ids a worker remembers; beyond it, the memory starts anew.
CACHE_WORDS = 700_000
#: New words encoded together, and what stands between them: one token of a character that words hardly hold.
JOINED = 100
MARK = " \x01 "
#: The tokenizer parts a letter from a stop and lowers letters itself: done before, fewer words differ.  Lowering first could
#: change what a combining mark makes of a letter, or make a special token.
STOP, KEEP_CASE = r"([A-Za-z])([.,;:!?])(\s|$)", r"\pM|<\|"


class WordIds:
    """Ids of texts by way of their distinct words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        if len(mark) != 1:
            raise ValueError(f"{path}: the mark between words is not one token")
        self.mark = mark[0]
        names = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(names.values()) + 1, bool)
        self.closes[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Ids of new words, ``JOINED`` of them encoded as one text.

        A word of letters is one run of the tokenizer's own splitting, and never none; so
        where a text has as many ends of runs as words, they part them.  Between other words
        stands a mark.
        """
        letters = [w for w in words if w.isalpha()]
        others = [w for w in words if not w.isalpha()]
        for same, plain in ((letters, True), (others, False)):
            for at in range(0, len(same), 20_000):
                self._learn_part(same[at:at + 20_000], plain)

    def _learn_part(self, words: list[str], plain: bool) -> None:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        between = " " if plain else MARK
        parts, sizes = [], []
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        for own, e in zip(groups, encode([between.join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            last = np.flatnonzero(self.closes[ids] if plain else ids == self.mark)
            if plain and len(last) == len(own):
                parts.append(ids)
                sizes.append(np.diff(last, prepend=-1))
            elif not plain and len(last) == len(own) - 1:
                parts.append(np.delete(ids, last))
                sizes.append(np.diff(np.concatenate([[-1], last, [len(ids)]])) - 1)
            else:                           # a letter that becomes two, or a word that holds the mark's character
                each = [x.ids for x in encode(own, add_special_tokens=False)]
                parts.append(np.array([i for x in each for i in x], np.uint32))
                sizes.append(np.array([len(x) for x in each], np.int64))
        flat, size = np.concatenate(parts), np.concatenate(sizes)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.known.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.start = np.concatenate([self.start, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used += len(flat)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids end."""
        texts = pc.replace_substring_regex(pc.fill_null(texts, ""), STOP, r"\1 \2\3")
        texts = pc.if_else(pc.match_substring_regex(texts, KEEP_CASE), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        vocabulary = words.dictionary.to_pylist()
        if len(self.known) + len(vocabulary) > CACHE_WORDS:
            self._forget()
        self._learn([w for w in vocabulary if w not in self.known])
        number = np.fromiter(map(self.known.__getitem__, vocabulary), np.int64, len(vocabulary))
        word = number[words.indices.to_numpy()] if len(vocabulary) else np.zeros(0, np.int64)
        size, start = self.size[word], self.start[word]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.repeat(start - ends + size, size) + np.arange(total)]
        bounds = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return flat, np.concatenate([[0], ends])[bounds]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


PIECE = [("pid", T.LongType()), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
         ("ids_crc32", T.LongType()), ("rank", T.LongType())]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, its place in the document, CRC-32 of the
    ids, and its rank among the pieces of that length in its partition."""
    fields = PIECE + ([("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    kind = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields]))

    def make():
        seen = np.zeros(capacity + 1, np.int64)
        pid = TaskContext.get().partitionId()

        def work(texts: pa.Array) -> list:
            words = _word_ids(tokenizer)
            out = []
            for at in range(0, len(texts), 1000):
                flat, ends = words.encode(texts.slice(at, 1000))
                begin = 0
                for end in ends:
                    ids = np.append(flat[begin:end], np.uint32(END)).astype("<u4")
                    begin = end
                    own = []
                    for k, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s:s + capacity]
                        n = len(part)
                        row = {"pid": pid, "piece": k, "start": s, "length": n,
                               "ids_crc32": zlib.crc32(part.tobytes()), "rank": int(seen[n])}
                        seen[n] += 1
                        if with_ids:
                            row["ids"] = part.astype(np.int32)
                        own.append(row)
                    out.append(own)
            return [out]
        return work

    rows = append(docs.select("doc_id", "text"), ["text"], [("__pieces", kind)], make)
    return rows.select("doc_id", F.explode("__pieces").alias("p")).select("doc_id", "p.*")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Of the available lengths, a combination of the largest sum up to ``room``.

    Bit i of ``sums`` says that i can be made; longer lengths are offered
    first, and a length is used no more often than it is available.
    """
    sums, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:                     # binary splitting of the multiplicity
            n = min(take, left)
            steps.append((length, n, sums))
            sums |= (sums << (length * n)) & mask
            left -= n
            take *= 2
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if before >> at & 1:
            continue
        chosen[length] = chosen.get(length, 0) + n
        at -= length * n
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bins as (length -> how many, times the bin is used), until nothing is left."""
    counts = {k: int(v) for k, v in counts.items() if v > 0}
    bins = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        content = fullest(counts, capacity - longest)
        counts[longest] += 1
        content[longest] = content.get(longest, 0) + 1
        times = min(counts[x] // n for x, n in content.items())
        for x, n in content.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        bins.append((content, times))
    return bins


def places(bins: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each length and first rank: first sequence, pieces of it in a bin, offset in the bin."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for content, times in bins:
        offset = 0
        for length in sorted(content, reverse=True):
            n = content[length]
            rows.append((length, used.get(length, 0), sequence, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += length * n
        sequence += times
    rows.sort()
    a = np.array(rows, np.int64).reshape(len(rows), 5)
    return {"key": (a[:, 0] << 48) + a[:, 1], "rank": a[:, 1], "sequence": a[:, 2], "n": a[:, 3], "offset": a[:, 4]}


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` (materialised rows of ``pieces``) with ``sequence_id`` and ``offset``."""
    counts = cut_pieces.groupBy("pid", "length").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("pid", "length", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    found = places(plan(histogram, capacity))       # at most ``capacity`` lengths, whatever the input

    def make():
        def work(length: pa.Array, rank: pa.Array) -> list:
            n, g = length.to_numpy(), rank.to_numpy()
            i = np.searchsorted(found["key"], (n << 48) + g, side="right") - 1
            over = g - found["rank"][i]
            return [found["sequence"][i] + over // found["n"][i],
                    found["offset"][i] + over % found["n"][i] * n]
        return work

    ranked = (cut_pieces.join(offsets, ["pid", "length"])
              .withColumn("__rank", F.col("rank") + F.col("__before")))
    placed = append(ranked, ["length", "__rank"],
                    [("sequence_id", T.LongType()), ("offset", T.LongType())], make)
    return placed.drop("pid", "rank", "__before", "__rank")


def word_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    out = pack(cut(pieces(docs, tokenizer or word_bpe(), capacity)), capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the packed pieces of all documents that are left."""
    return packed(docs)


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
SQL: dict[str, str] = {}
