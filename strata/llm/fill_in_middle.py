"""Fill-in-middle: texts cut into prefix, middle and suffix and put in another order between sentinels.

The cuts and the form come from a keyed digest of the id, in Spark's own
functions.  The texts are rearranged with pyarrow.compute, batch by batch:

* a text becomes a list of its units (code points; the list array shares the
  text's bytes), the lists are flattened with the index of their parent;
* a unit's ordinal in its text, against the two cuts, gives its role;
* per role the units are filtered, rebuilt into lists and joined;
* the joined pieces and the sentinels are joined element by element.

A step works on at most ``STEP_BYTES`` of text.  A longer text is cut into
pieces at code points; every piece goes the same way with the ordinals it has
in the whole text, and a role's pieces are joined last.

Defined results: a null text counts as empty.  Empty texts, and texts that
contain a sentinel, are plain: the output is the text, the counts are null.  A
null id is drawn like an empty one.  Rows that repeat an id are drawn alike;
each keeps its own text.  Extra columns pass through whatever their names are.
An empty table gives no rows.  Texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import append, fresh, table

#: Marks of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Out of 100 drawn documents, those from here on stay plain; of the others, those below this number put the suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20
STEP_BYTES = 4 << 20


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers per id: the first groups of a sha256 digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def split_units(texts: pa.Array) -> pa.ListArray:
    """A list of code points per text; the units share the texts' bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    starts = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
    ends = np.append(starts, np.int32(len(data)))
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, offsets - offsets[0]).astype(np.int32)), units)


def by_role(lists: pa.ListArray, base: int, low: pa.Array, high: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of every list, whose first unit has the ordinal ``base`` in its text."""
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    first = pc.take(pa.array(np.asarray(lists.offsets)[:-1], pa.int64()), parent)
    ordinal = pc.add(pc.subtract(pa.array(np.arange(len(units)), pa.int64()), first), base)
    behind = [pc.cast(pc.greater_equal(ordinal, pc.take(cut, parent)), pa.int8()) for cut in (low, high)]
    role = pc.add(*behind)
    out = []
    for r in range(3):
        mine = pc.equal(role, r)
        counts = np.bincount(np.asarray(pc.filter(parent, mine)), minlength=len(lists))
        rebuilt = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pc.filter(units, mine))
        out.append(pc.binary_join(rebuilt, ""))
    return out


def steps(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together, or of one row."""
    at = 0
    while at < len(sizes):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, side="right")))
        yield at, end
        at = end


def long_parts(text: str, low: pa.Array, high: pa.Array, limit: int) -> list[pa.Array]:
    """``by_role`` of one long text, piece by piece."""
    width = max(1, limit // 4)
    pieces = [by_role(split_units(pa.array([text[at:at + width]], pa.string())), at, low, high) for at in range(0, len(text), width)]
    return [pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pa.concat_arrays([p[r] for p in pieces])), "")
            for r in range(3)]


def rearranged(texts: pa.Array, form: pa.Array, low: pa.Array, high: pa.Array, marks: Sequence[str], limit: int = STEP_BYTES) -> pa.Array:
    """The outputs of texts that are not plain."""
    sizes = np.asarray(pc.binary_length(texts), np.int64)
    p, s, m = (pa.scalar(x) for x in marks)
    done = []
    for a, b in steps(sizes, limit):
        cuts = low.slice(a, b - a), high.slice(a, b - a)
        if sizes[a] > limit:
            parts = long_parts(texts[a].as_py(), *cuts, limit)
        else:
            parts = by_role(split_units(texts.slice(a, b - a)), 0, *cuts)
        prefix, middle, suffix = parts
        psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
        spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
        done.append(pc.if_else(pc.equal(form.slice(a, b - a), "spm"), spm, psm))
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   sentinels: Sequence[str] = SENTINELS, plain_from: int = PLAIN_FROM,
                   suffix_first: int = SUFFIX_FIRST) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with five more columns, and their names by role: n, form, prefix_chars, middle_chars, output."""
    names = {k: fresh(k) for k in ("n", "form", "prefix_chars", "middle_chars", "output")}
    text, low, high = fresh("text"), fresh("low"), fresh("high")
    h = draws(F.col(id_col), seed)
    marked = F.lit(False)
    for mark in sentinels:
        marked = marked | F.contains(F.col(text), F.lit(mark))
    plain = (F.col(names["n"]) == 0) | marked | (h[2] % 100 >= plain_from)
    cuts = [x % (F.col(names["n"]) + 1) for x in h[:2]]
    rows = (docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
            .withColumn(names["n"], F.char_length(text).cast("long"))
            .withColumn(names["form"], F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm"))
            .withColumn(low, F.when(F.col(names["form"]) != "plain", F.least(*cuts)))
            .withColumn(high, F.when(F.col(names["form"]) != "plain", F.greatest(*cuts))))

    def make():
        def work(texts: pa.Array, form: pa.Array, lows: pa.Array, highs: pa.Array) -> list:
            cut = pc.not_equal(form, "plain")
            moved = rearranged(*(pc.filter(x, cut) for x in (texts, form, lows, highs)), sentinels)
            return [pc.replace_with_mask(texts, cut, moved)]
        return work

    out = append(rows, [text, names["form"], low, high], [(names["output"], T.StringType())], make)
    return (out.withColumn(names["prefix_chars"], F.col(low)).withColumn(names["middle_chars"], F.col(high) - F.col(low))
            .drop(text, low, high), names)


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text again, from an output and its form only."""
    part = F.split(output, "|".join(re.sub(r"(.+)", r"\\Q\1\\E", x) for x in sentinels))
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, c = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output, form = F.col(c["output"]), F.col(c["form"])
    return done.select("doc_id", F.col(c["n"]).alias("n"), form.alias("form"), F.col(c["prefix_chars"]).alias("prefix_chars"),
                       F.col(c["middle_chars"]).alias("middle_chars"), F.sha2(output, 256).alias("output_sha256"),
                       F.sha2(restored(output, form), 256).alias("restored_sha256"))


QUERIES = {"op11_fill_in_middle": op11_fill_in_middle}
SQL = {"op11_fill_in_middle": """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM documents),
numbers AS (
  SELECT doc_id, t, n, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4
  FROM drawn),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1, n - b) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts"""}
