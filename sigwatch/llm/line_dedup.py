"""Substring deduplication by hashing lines or paragraphs.

Every unit of every text is normalised (lower case, white space runs to one
space, ends trimmed) and digested to 128 bits. Digests are grouped over the
whole corpus; of equal units the earliest by (rank, doc_id, position) stays,
all others are removed, with their code points in the original text.

Units of fewer than ``min_words`` words are left alone: such lines are equal
by chance, not by copying.

Skew: a digest's first occurrence is a partial aggregate, so a line that a
third of all documents share arrives as one row per map task; the join that
finds its other occurrences is a plain equi-join whose hot keys AQE splits,
with nothing grouped behind it.

Defined results: null and empty texts have no units; repeated rows of one
document hold equal units with equal rank, doc_id and position and count as
one occurrence (none removes the other); ties between documents cannot occur
for distinct doc_ids; a null rank or doc_id sorts first; extra columns are
ignored, or kept by ``remove_repeats``.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_batch, staged, start, utf8

UNITS = {"line": re.compile(r"[^\n]+"), "paragraph": re.compile(r"(?:(?!\n[ \t]*\n).)+", re.S)}
MIN_WORDS = 5

_UNIT = [("rank", pa.int64()), ("doc_id", pa.int64()), ("unit_no", pa.int64()), ("start", pa.int64()),
         ("end", pa.int64()), ("n_words", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64())]
_UNIT_SQL = "rank long, doc_id long, unit_no long, start long, end long, n_words long, hi long, lo long"


def units_of(text: str | None, unit: str = "line", min_words: int = MIN_WORDS) -> list[tuple]:
    """(unit number, start, end, words, digest) of the units with enough words."""
    out = []
    for k, m in enumerate(UNITS[unit].finditer(text or "")):
        words = m[0].lower().split()
        if len(words) >= min_words:
            out.append((k, m.start(), m.end(), len(words), blake2b(utf8(" ".join(words)), digest_size=16).digest()))
    return out


def _units(docs: DataFrame, unit: str, min_words: int, rank: Column | None) -> DataFrame:
    def scan(batches):
        for batch in batches:
            rows, digests = [], []
            for r, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                for k, a, b, n, digest in units_of(text, unit, min_words):
                    rows.append((r, doc_id, k, a, b, n))
                    digests.append(digest)
            pair = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            head = as_batch(rows, _UNIT[:6])
            yield pa.RecordBatch.from_arrays([*head.columns, pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                                             [n for n, _ in _UNIT])

    df = docs.select((F.lit(0) if rank is None else rank).cast("long").alias("rank"),
                     F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return df.mapInArrow(scan, _UNIT_SQL)


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS,
                   rank: Column | None = None) -> DataFrame:
    """One row per unit to remove: doc_id, unit_no, start, end (code points),
    n_words, kept_doc_id and kept_unit_no (its earliest occurrence)."""
    start(docs.sparkSession)
    units = staged(_units(docs, unit, min_words, rank), "units")
    first = (units.groupBy("hi", "lo")
             .agg(F.min(F.struct("rank", "doc_id", "unit_no")).alias("first"),
                  F.max(F.struct("rank", "doc_id", "unit_no")).alias("last"))
             .where(~F.col("first").eqNullSafe(F.col("last")))
             .select("hi", "lo", "first"))
    return (units.join(first, ["hi", "lo"])
            .where(~F.struct("rank", "doc_id", "unit_no").eqNullSafe(F.col("first")))
            .select("doc_id", "unit_no", "start", "end", "n_words",
                    F.col("first.doc_id").alias("kept_doc_id"), F.col("first.unit_no").alias("kept_unit_no")))


def remove_repeats(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS,
                   rank: Column | None = None) -> DataFrame:
    """The documents without their repeated units, plus ``removed``: the
    original [start, end) code points of what was cut. A document's units are
    gathered per document, so a group is at most one text."""
    names = docs.columns
    column = "removed"
    while column in names:
        column += "_"
    key = "_cut_doc"
    while key in names:
        key += "_"
    cut = (repeated_units(docs, unit, min_words, rank).groupBy(F.col("doc_id").alias(key))
           .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(column)))
    joined = docs.join(cut, F.col("doc_id").cast("long").eqNullSafe(F.col(key)), "left").drop(key)
    at, spans_at = names.index("text"), len(names)

    def drop(batches):
        for batch in batches:
            texts = [without(t, [(s["start"], s["end"]) for s in spans or ()])
                     for t, spans in zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist())]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return joined.mapInArrow(drop, joined.schema)


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the spans and the line break behind each."""
    if not spans:
        return text
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:a])
        last = b + (text[b:b + 1] == "\n")
    return "".join(out) + text[last:]
