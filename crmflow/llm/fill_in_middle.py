"""Fill-in-middle rows: each text is cut at two of its code points, found by select in a Roaring-style set.

The set holds the byte offsets of a text's code point boundaries, its end included. It is kept as containers of 2**16
offsets each: a sorted array, a bitmap or a list of runs, whichever is smallest (an ASCII text is one run a container).
Cumulative cardinalities find the container of the k-th boundary, a select inside it the offset; no text is decoded.

Forms: ``plain`` is the text itself; ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; ``spm`` is ``<S>`` suffix
``<P>`` prefix ``<M>`` middle. A text that holds a marker stays plain, so every output can be taken apart again.

Nulls: a null text is empty, empty texts are plain; a null doc_id draws as the empty name. Very long texts: never cut short,
one text at a time is held beside its output. Repeated rows: one row each, equal ids draw equally. Ties: two equal draws
give an empty middle. No rows: no result. Other columns are ignored.
"""
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts
from crmflow.llm.textgrid import pieces

#: Offsets of a container, and the most that an array container holds.
SPAN = 1 << 16
ARRAY_MOST = 4096

#: Markers of prefix, suffix and middle (fixed by the result's format).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares, in percent: draws from 90 on stay plain; draws below 20 give the form that begins with the suffix.
FORMED, SUFFIX_FIRST = 90, 20


class ArrayContainer:
    def __init__(self, flags):
        self.values = np.flatnonzero(flags).astype(np.uint16)

    def select(self, k):
        return int(self.values[k])


class BitmapContainer:
    """65,536 bits in 1024 words, with the bits before each word."""

    def __init__(self, flags):
        bits = np.zeros(SPAN, bool)
        bits[:len(flags)] = flags
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k):
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits, left = int(self.words[word]), k - int(self.before[word])
        for _ in range(left):
            bits &= bits - 1
        return 64 * word + (bits & -bits).bit_length() - 1


class RunContainer:
    """First offsets of the runs, with the offsets held before each run."""

    def __init__(self, first, lengths):
        self.first = first.astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(lengths)])

    def select(self, k):
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(flags):
    """The smallest container of one span: 2 bytes a value, 4 bytes a run, or 8192 bytes."""
    held = int(np.count_nonzero(flags))
    edges = np.flatnonzero(np.diff(flags, prepend=False, append=False))
    first, end = edges[::2], edges[1::2]
    sizes = {"run": 4 * len(first), "array": 2 * held if held <= ARRAY_MOST else SPAN, "bitmap": SPAN // 8}
    kind = min(sizes, key=sizes.get)
    made = RunContainer(first, end - first) if kind == "run" else ArrayContainer(flags) if kind == "array" else BitmapContainer(flags)
    return made, held


class Boundaries:
    """The code point boundaries of a text: byte offsets at which a code point begins, and the end."""

    def __init__(self, flags):
        self.parts, self.before = [], [0]
        for at in range(0, len(flags), SPAN):
            made, held = container(flags[at:at + SPAN])
            self.parts.append(made)
            self.before.append(self.before[-1] + held)

    def __len__(self):
        return self.before[-1]

    def select(self, k):
        """The k-th smallest offset (from 0)."""
        part = bisect_right(self.before, k) - 1
        return part * SPAN + self.parts[part].select(k - self.before[part])


def boundaries(raw: np.ndarray) -> Boundaries:
    flags = np.ones(len(raw) + 1, bool)
    flags[:-1] = (raw & 0xC0) != 0x80
    return Boundaries(flags)


def _strings(rows):
    """An Arrow string column of UTF-8 bytes."""
    ends = np.cumsum([0, *(len(x) for x in rows)], dtype=np.int64)
    return pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(ends), pa.py_buffer(b"".join(rows))).cast(pa.string())


_NUMBERS = ("n", "prefix_chars", "middle_chars", "prefix_end", "middle_end")
_RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_end long, middle_end long, output string"


def _cut(batches):
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for batch in batches:
        for i, j, data, offsets in pieces(batch.column("text")):
            one, two = (batch.column(x).slice(i, j - i).to_pylist() for x in ("one", "two"))
            formed, reverse = (batch.column(x).slice(i, j - i).to_pylist() for x in ("formed", "suffix_first"))
            rows, forms, output = [], [], []
            for k in range(j - i):
                raw = data[offsets[k]:offsets[k + 1]]
                marks, text = boundaries(raw), raw.tobytes()
                n = len(marks) - 1
                if not n or not formed[k] or p in text or s in text or m in text:
                    rows.append((n, None, None, None, None))
                    forms.append("plain")
                    output.append(text)
                    continue
                low, high = sorted((one[k] % (n + 1), two[k] % (n + 1)))
                a, b = marks.select(low), marks.select(high)
                rows.append((n, low, high - low, a, b))
                forms.append("spm" if reverse[k] else "psm")
                output.append(b"".join((s, text[b:], p, text[:a], m, text[a:b]) if reverse[k] else (p, text[:a], s, text[b:], m, text[a:b])))
            numbers = [pa.array(x, pa.int64()) for x in zip(*rows)]
            columns = [batch.column("doc_id").slice(i, j - i), numbers[0], pa.array(forms), *numbers[1:], _strings(output)]
            yield pa.record_batch(columns, names=[x.split()[0] for x in _RESULT.split(", ")])


def draw(k: int, seed: int = 1) -> Column:
    """Draw number ``k`` (from 0) of a document: 32 bits of the sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n (code points), form, code points of prefix and middle, the two cut offsets in bytes, output.

    The four numbers of the cut are null for plain rows. One pass, no shuffle.
    """
    drawn = texts(docs).select(
        "doc_id", "text", draw(0, seed).alias("one"), draw(1, seed).alias("two"),
        (draw(2, seed) % 100 < FORMED).alias("formed"), (draw(3, seed) % 100 < SUFFIX_FIRST).alias("suffix_first"),
    )
    return drawn.mapInArrow(_cut, _RESULT)


def restored(output: str | Column, form: str | Column) -> Column:
    """The text an output was made from. Each marker's first place is the real one: no text holds a marker."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))

    def between(text, first, last):
        begin = F.locate(first, text) + len(first)
        return F.substring(text, begin, F.locate(last, text) - begin)

    def after(text, mark):
        return F.substring(text, F.locate(mark, text) + len(mark), F.length(text))

    psm = F.concat(between(output, PREFIX, SUFFIX), after(output, MIDDLE), between(output, SUFFIX, MIDDLE))
    spm = F.concat(between(output, PREFIX, MIDDLE), after(output, MIDDLE), between(output, SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the form and cut, and sha256 of the output and of the text rebuilt from it."""
    return transformed(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


#: The same rows in SQL; the text itself is what must be restored.
SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
      ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
      CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
           WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
              ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
