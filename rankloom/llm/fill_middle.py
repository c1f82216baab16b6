"""Fill-in-the-middle transformation: texts cut at two unit ends and put in another order.

A unit is a word with the white space (0x20, 0x09 to 0x0D) before it; white space at the end of a text is a
unit too. Texts lie in a buffer of 64-bit words, eight UTF-8 bytes each. Arithmetic on whole words marks
the bytes that end a unit; ``bitwise_count`` per word and one cumulative sum give the rank of every word. A cut
after unit k is a search for the word that holds the k-th mark and a select inside that word, so no unit is
ever built. Code points are counted the same way, from marks at the bytes that begin one.

Everything is decided by a document's own id and text: a repeated or moved row gives the same result.

Defined results: null text is empty and stays plain, with 0 units; a null id is hashed as an empty one; texts
that contain a marker stay plain, so every output can be read back; other columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.textbatch import passes, prepare, text_buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_U = np.uint64
_ONES = _U(0x0101010101010101)
_TOP = _U(0x8080808080808080)
_LOW = _U(0x7F7F7F7F7F7F7F7F)
FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _at_least(low: np.ndarray, value: int) -> np.ndarray:
    """Top bits of the bytes that are ``value`` or more; all bytes are below 0x80, so no carry leaves its byte."""
    return (low + _U(0x80 - value) * _ONES) & _TOP


def space_marks(words: np.ndarray) -> np.ndarray:
    """Top bits of the bytes 0x20 and 0x09 to 0x0D."""
    low = words & _LOW
    space = ~_at_least(low ^ (_U(0x20) * _ONES), 1)
    control = _at_least(low, 9) & ~_at_least(low, 14)
    return (space | control) & ~words & _TOP


class Marked:
    """The texts of a pass in words of eight bytes, each filled up with spaces (one at least)."""

    def __init__(self, column: pa.Array) -> None:
        data, bounds = text_buffers(column)
        self.size = np.diff(bounds)
        words = self.size // 8 + 1
        self.first = np.concatenate(([0], np.cumsum(words)))  # a text's first word
        buffer = np.full(int(self.first[-1]) * 8, 0x20, np.uint8)
        for at, start, size in zip((self.first[:-1] * 8).tolist(), bounds[:-1].tolist(), self.size.tolist()):
            buffer[at : at + size] = data[start : start + size]
        self.buffer = buffer
        words = buffer.view("<u8")
        space = space_marks(words)
        following = space >> _U(8)
        following[:-1] |= space[1:] << _U(56)
        self.ends = ~space & _TOP & following  # a byte of a word, before white space or the end of the text
        last = self.first[:-1] * 8 + self.size - 1
        last = last[self.size > 0]
        # white space at the end is a unit: its last byte ends it
        np.bitwise_or.at(self.ends, last >> 3, _U(0x80) << ((last & 7) * 8).astype(np.uint64))
        self.rank = np.concatenate(([0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)))
        begins = ~(words & ~(words << _U(1))) & _TOP  # all but the bytes 10xxxxxx
        self.begins = begins
        self.begun = np.concatenate(([0], np.cumsum(np.bitwise_count(begins), dtype=np.int64)))
        self.units = self.rank[self.first[1:]] - self.rank[self.first[:-1]]

    def cut(self, row: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Bytes of each row up to the end of that many units."""
        out = np.zeros(len(row), np.int64)
        some = np.flatnonzero(unit > 0)
        target = self.rank[self.first[row[some]]] + unit[some]
        word = np.searchsorted(self.rank, target, side="left") - 1
        left = target - self.rank[word]
        bits = self.ends[word]
        for _ in range(7):  # the marks before the wanted one go, lowest first
            more = left > 1
            if not more.any():
                break
            bits = np.where(more, bits & (bits - _U(1)), bits)
            left = left - more
        lowest = bits & (~bits + _U(1))
        place = np.bitwise_count(lowest - _U(1)).astype(np.int64) >> 3
        out[some] = (word - self.first[row[some]]) * 8 + place + 1
        return out

    def chars(self, row: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Code points among the first ``byte`` bytes of each row."""
        word, rest = self.first[row] + (byte >> 3), (byte & 7).astype(np.uint64)
        mask = (_U(1) << (rest * _U(8))) - _U(1)
        return self.begun[word] + np.bitwise_count(self.begins[word] & mask) - self.begun[self.first[row]]

    def part(self, row: int, start: int, end: int) -> bytes:
        at = int(self.first[row]) * 8
        return self.buffer[at + start : at + end].tobytes()


def draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four 32-bit numbers per id."""
    found = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(found), ">u4").reshape(-1, 4).astype(np.int64)


def fill_in_middle(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``percent`` of the texts are cut; of these ``spm_percent`` become suffix, prefix, middle, the others
    prefix, suffix, middle. The four numbers of an id choose both cuts, whether to cut, and the form.
    """
    prepare(docs.sparkSession)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def whole(marked: Marked, row: int) -> bytes:
        return marked.part(row, 0, int(marked.size[row]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in passes(batch):
                marked = Marked(rows.column(1))
                h = draws(rows.column(0).to_pylist(), seed)
                n = marked.units
                plain = (marked.size == 0) | (h[:, 2] % 100 >= percent)
                for row in np.flatnonzero(~plain).tolist():
                    value = whole(marked, row)
                    plain[row] = p in value or s in value or m in value
                row = np.arange(len(n))
                units = np.sort(h[:, :2] % (n[:, None] + 1), axis=1)
                first, second = marked.cut(row, units[:, 0]), marked.cut(row, units[:, 1])
                before = marked.chars(row, first)
                middle = marked.chars(row, second) - before
                spm = h[:, 3] % 100 < spm_percent
                out = []
                for i, (a, b) in enumerate(zip(first.tolist(), second.tolist())):
                    if plain[i]:
                        out.append(whole(marked, i))
                        continue
                    x, y, z = marked.part(i, 0, a), marked.part(i, a, b), marked.part(i, b, int(marked.size[i]))
                    out.append(s + z + p + x + m + y if spm[i] else p + x + s + z + m + y)
                form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(before, mask=plain),
                     pa.array(middle, mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, FIELDS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. No text that was cut contains a marker, so each stands once."""
    inner, rest = F.split_part(output, F.lit(PREFIX), F.lit(2)), F.split_part(output, F.lit(SUFFIX), F.lit(2))
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(F.split_part(inner, F.lit(SUFFIX), F.lit(1)), middle, F.split_part(rest, F.lit(MIDDLE), F.lit(1)))
    spm = F.concat(F.split_part(inner, F.lit(MIDDLE), F.lit(1)), middle, F.split_part(rest, F.lit(PREFIX), F.lit(1)))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """The columns of a transformation with the SHA-256 of each output and of the text rebuilt from it."""
    back = restored(F.col("output"), F.col("form"))
    return transformed.withColumns(
        {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(back, 256)}
    ).drop("output")


ORACLE = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS t
  FROM documents
), d AS (
  SELECT doc_id, text, t, CAST(len(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM u
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT doc_id, n, form, text, array_to_string(t[1:a], '') AS prefix, array_to_string(t[a + 1:b], '') AS middle, array_to_string(t[b + 1:], '') AS suffix
  FROM f
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
"""
