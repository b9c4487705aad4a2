"""Substring deduplication of passages: units cut by content, not by lines.

Texts are normalised (A-Z lower-cased, words between ASCII white space). Every
run of ``least`` words is a window; a window's unit is named by its smallest
``GRAM``-word hash, and neighbouring windows with one smallest hash form one
unit. Where two texts hold the same window, both have a unit of that name
there, wherever their lines break. Units are digested and grouped over the
whole corpus:

* units of equal content: the earliest by (rank, doc_id, position) stands for
  them; all windows of the others are repeats;
* units of one name but different content (the passage begins or ends inside,
  or a word was edited) are compared window by window, one per content.

So a word is reported if and only if it lies in a window of ``least`` words
that stands earlier in the corpus, up to hash collisions (64 bits a word, 128
a unit or window). Overlapping and touching windows form one passage, with its
code points in the original text.

Skew: the earliest unit of a content is a partial aggregate, and its other
places come by an equi-join whose hot keys AQE splits, so a passage that a
third of all documents hold is spread over the tasks. What is gathered is at
most one document's units. Texts are read again, and moved, only for documents
that hold a unit of ambiguous content.

Defined results: null, empty and short texts have no windows; rows with one
doc_id but different texts are different documents, ordered by a hash of the
text; repeated rows (same id, same text) count once; ties between documents
cannot occur for distinct ids; a null rank or doc_id sorts first; extra
columns are ignored, or kept by ``remove_passages``; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, start
from .line_dedup import without
from .shingles import _IS_WORD, _MIX, mix, word_hashes

LEAST = 50
#: Words of the hashes that name units.
GRAM = 16

_UNIT = [("rank", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("name", pa.int64()), ("at", pa.int64()),
         ("n", pa.int64()), ("again", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("hi", pa.int64()),
         ("lo", pa.int64())]
_UNIT_SQL = ("rank long, doc_id long, th long, name long, at long, n long, again boolean, start long, end long, "
             "hi long, lo long")
_WINDOW = [("uid", pa.int64()), ("nth", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("whi", pa.int64()),
           ("wlo", pa.int64())]
_WINDOW_SQL = "uid long, nth long, start long, end long, whi long, wlo long"


def grams(h: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of ``size`` words, by doubling."""
    out, have, whole = None, 0, h if not salt else mix(h + _MIX[salt])
    span = 1
    while size:
        if size & 1:  # append a run of ``span`` words
            if out is None:
                out, have = whole, span
            else:
                n = min(len(out), len(whole) - have)
                out, have = mix(out[:max(n, 0)] * _MIX[1] + whole[have:have + max(n, 0)]), have + span
        size >>= 1
        if size:
            whole = mix(whole[:-span] * _MIX[0] + whole[span:]) if len(whole) > span else whole[:0]
            span *= 2
    return out


def sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """Least value of every ``size`` neighbours."""
    span = 1
    while 2 * span <= size:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == size else np.minimum(x[:span - size], x[size - span:])


def _powers(n: int) -> list[np.ndarray]:
    """Powers of two odd bases and of their inverses modulo 2^64, up to n."""
    have = _TABLES.get("powers")
    if have is None or len(have[0]) <= n:
        bases = [int(_MIX[k]) | 1 for k in range(2)]
        have = [np.cumprod(np.r_[np.uint64(1), np.full(2 * n + 1024, x, np.uint64)])
                for base in bases for x in (base, pow(base, -1, 1 << 64))]
        _TABLES["powers"] = have
    return have


_TABLES: dict = {}


def _sequence_digests(h: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit polynomials of the words at .. at + size - 1."""
    out, table = [], _powers(len(h))
    for k in range(2):
        total = np.r_[np.uint64(0), np.cumsum(mix(h + _MIX[k + 1]) * table[2 * k][1:len(h) + 1])]
        out.append(mix((total[at + size] - total[at]) * table[2 * k + 1][at] + size.astype(np.uint64)))
    return out


class _Texts:
    """Words of a batch of texts: hashes, and code points of their ends."""

    def __init__(self, raws: list[bytes | None]):
        raws = [r or b"" for r in raws]
        joined = b"\n".join(raws)
        self.hashes, _ = word_hashes(joined.lower())
        data = np.frombuffer(joined, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = _IS_WORD[data]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        bounds = np.cumsum([0] + [len(r) + 1 for r in raws])
        self.cuts = np.searchsorted(edge[::2], bounds).tolist()
        first = points[np.minimum(bounds, len(data))]
        self.starts, self.ends, self.first = points[edge[::2]], points[edge[1::2]], first.tolist()

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.cuts[k], self.cuts[k + 1]
        return self.hashes[a:b], self.starts[a:b] - self.first[k], self.ends[a:b] - self.first[k]


def units_of(h: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...] | None:
    """Name, first window, windows and whether a window may repeat inside, of
    the units of a text given as word hashes; None: too few words."""
    if len(h) < least:
        return None
    g = grams(h, GRAM)
    names = sliding_least(g, least - GRAM + 1)
    at = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    n = np.diff(np.r_[at, len(names)])
    # a window can stand twice in a unit only if the naming hash does
    seen = np.zeros(len(at), np.int64)
    ordered = np.sort(g)
    if (ordered[1:] == ordered[:-1]).any():
        for k in range(len(at)):
            seen[k] = np.count_nonzero(g[at[k]:at[k] + n[k] + least - GRAM] == names[at[k]])
    return names[at], at, n, seen > 1


def _columns(parts: list[tuple], fields: list[tuple]) -> list[pa.Array]:
    """Numpy columns, one tuple a part, laid end to end."""
    columns = list(zip(*parts)) or [()] * len(fields)
    return [pa.array(np.concatenate(c) if c else [], t) for c, (_, t) in zip(columns, fields)]


def _units(docs: DataFrame, least: int) -> DataFrame:
    def scan(batches):
        for batch in batches:
            texts = _Texts(batch.column(3).cast(pa.binary()).to_pylist())
            owner, parts = [], []
            for k in range(batch.num_rows):
                h, starts, ends = texts.of(k)
                units = units_of(h, least)
                if units is None:
                    continue
                names, at, n, again = units
                hi, lo = _sequence_digests(h, at, n + least - 1)
                owner.append(np.full(len(at), k))
                parts.append((names.view(np.int64), at, n, again, starts[at], ends[at + n + least - 2],
                              hi.view(np.int64), lo.view(np.int64)))
            # each unit has the key columns of its text
            rows = pa.array(np.concatenate(owner) if owner else [], pa.int64())
            keys = [batch.column(k).take(rows) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*keys, *_columns(parts, _UNIT[3:])], [x for x, _ in _UNIT])

    return docs.mapInArrow(scan, _UNIT_SQL)


def _windows(docs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """The windows of the units in ``reps``, one row each: uid, number in the
    unit, code points, digest."""
    def scan(batches):
        for batch in batches:
            texts = _Texts(batch.column(0).cast(pa.binary()).to_pylist())
            parts = []
            for k, units in enumerate(batch.column(1).to_pylist()):
                h, starts, ends = texts.of(k)
                one, two = grams(h, least).view(np.int64), grams(h, least, 2).view(np.int64)
                for u in units:
                    nth = np.arange(u["n"])
                    i = u["at"] + nth
                    parts.append((np.full(len(i), u["uid"], np.int64), nth, starts[i], ends[i + least - 1], one[i], two[i]))
            yield pa.RecordBatch.from_arrays(_columns(parts, _WINDOW), [x for x, _ in _WINDOW])

    held = reps.groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).agg(
        F.collect_list(F.struct("at", "n", "uid")).alias("units"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th"))
    return docs.join(held, same).select("text", "units").mapInArrow(scan, _WINDOW_SQL)


def _numbered(live: DataFrame) -> DataFrame:
    """The units that stand for an ambiguous content, with ``uid``: a number
    that rises in their order (rank, doc_id, th, at), so that (uid, number of
    a window) is the order of windows."""
    n = int(live.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = staged(live.where("contents > 1 or again").select("hi", "lo", "n", "rep.*"), "ambiguous")
    order = ["rank", "doc_id", "th", "at"]
    return staged(reps.repartitionByRange(n, *order).sortWithinPartitions(*order)
                  .withColumn("uid", F.monotonically_increasing_id()), "numbered")


def _moved(texts: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Ranges of windows of ``reps`` that stand earlier: the unit's content and
    document, first and last window a and b, code points, the earliest place
    of the first window, and whether that window heads the unit."""
    windows = staged(_windows(texts, reps, least), "windows")
    place = F.struct("uid", "nth")
    first = (windows.groupBy("whi", "wlo").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
             .select("whi", "wlo", "first"))
    moved = windows.join(first, ["whi", "wlo"]).where(place != F.col("first"))
    by = Window.partitionBy("uid").orderBy("nth")
    new = F.when(F.col("nth") - F.lag("nth").over(by) <= 1, 0).otherwise(1)
    ranges = (moved.withColumn("new", new).withColumn("island", F.sum("new").over(by)).groupBy("uid", "island")
              .agg(F.min("nth").alias("from"), F.max("nth").alias("to"), F.min("start").alias("start"),
                   F.max("end").alias("end"), F.min_by("first", F.struct("nth", "first")).alias("first")))
    kept = reps.select(F.col("uid").alias("_uid"), F.col("doc_id").alias("kept_doc_id"), F.col("at").alias("_at"))
    return (ranges.join(reps, "uid").join(kept, F.col("first.uid") == F.col("_uid"))
            .select("hi", "lo", "doc_id", "th", (F.col("at") + F.col("from")).alias("a"), (F.col("at") + F.col("to")).alias("b"),
                    "start", "end", "kept_doc_id", (F.col("_at") + F.col("first.nth")).alias("kept_word"),
                    (F.col("from") == 0).alias("heads")))


def _repeats(docs: DataFrame, least: int, rank: Column | None) -> DataFrame:
    """Passages with the text hash of their document."""
    if least <= GRAM:
        raise ValueError(f"a passage has more than {GRAM} words")
    start(docs.sparkSession)
    texts = docs.select((F.lit(0) if rank is None else rank).cast("long").alias("rank"),
                        F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("th"),
                        F.col("text").cast("string").alias("text")).where("text is not null")
    units = staged(_units(texts, least), "units")
    # the name follows from the content, which is what rows are dealt by
    contents = units.groupBy("hi", "lo").agg(
        F.min(F.struct("rank", "doc_id", "th", "at")).alias("rep"), F.count("*").alias("held"), F.max("n").alias("n"),
        F.max("again").alias("again"), F.max("name").alias("name"))
    names = contents.groupBy("name").agg(F.count("*").alias("contents"), F.sum("held").alias("places"),
                                         F.max("again").alias("any_again")).where("places > 1 or any_again")
    live = staged(contents.join(names.select("name", "contents"), "name"), "contents")
    moved = staged(_moved(texts, _numbered(live), least), "moved")

    range_columns = ["doc_id", "th", "a", "b", "start", "end", "kept_doc_id", "kept_word"]
    own = moved.select(*range_columns)
    heads = moved.where("heads").select("hi", "lo", F.col("kept_doc_id").alias("_doc"), F.col("kept_word").alias("_word"),
                                        F.lit(True).alias("_moved"))
    kept = (live.where("held > 1").join(heads, ["hi", "lo"], "left").select(
        "hi", "lo", F.struct("rep.doc_id", "rep.th", "rep.at").alias("rep"),
        F.when(F.col("_moved"), F.col("_doc")).otherwise(F.col("rep.doc_id")).alias("kept_doc_id"),
        F.coalesce("_word", "rep.at").alias("kept_word")))
    others = (units.select("doc_id", "th", F.col("at").alias("a"), (F.col("at") + F.col("n") - 1).alias("b"), "start", "end", "hi", "lo")
              .join(kept, ["hi", "lo"])
              .where(~F.struct("doc_id", "th", F.col("a").alias("at")).eqNullSafe(F.col("rep"))).select(*range_columns))
    return _joined(own.unionByName(others), least)


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def _joined(ranges: DataFrame, least: int) -> DataFrame:
    """Ranges of windows that overlap or touch as one passage each; at most
    one document's ranges in a group."""
    by = Window.partitionBy("doc_id", "th").orderBy("a", "b")
    reach = F.max("b").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("a") <= reach + least, 0).otherwise(1)
    island = F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    return (ranges.withColumn("new", new).withColumn("island", island).groupBy("doc_id", "th", "island")
            .agg(F.min("a").alias("first_word"), (F.max("b") - F.min("a") + least).alias("n_words"),
                 F.min("start").alias("start"), F.max("end").alias("end"),
                 F.min_by(F.struct("kept_doc_id", "kept_word"), F.struct("a", "b", "kept_doc_id", "kept_word")).alias("kept"))
            .select("doc_id", "th", "first_word", "n_words", "start", "end", "kept.kept_doc_id", "kept.kept_word"))


def repeated_passages(docs: DataFrame, least: int = LEAST, rank: Column | None = None) -> DataFrame:
    """One row per passage of at least ``least`` words all of whose windows
    stand earlier in the corpus: doc_id, first_word (from 0), n_words, start,
    end (code points), and where its first window stands first: kept_doc_id,
    kept_word."""
    return _repeats(docs, least, rank).drop("th")


def remove_passages(docs: DataFrame, least: int = LEAST, rank: Column | None = None) -> DataFrame:
    """The documents without their repeated passages (and the line break
    behind each), plus ``removed``: the original [start, end) code points."""
    names = docs.columns
    column = "removed"
    while column in names:
        column += "_"
    free = "cut"
    while any(n.startswith(free) for n in names):
        free += "_"
    cut = _repeats(docs, least, rank).groupBy(F.col("doc_id").alias(free + "_doc"), F.col("th").alias(free + "_th")).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias(column))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(free + "_doc")) & (_text_hash() == F.col(free + "_th"))
    joined = docs.join(cut, same, "left").drop(free + "_doc", free + "_th")
    at, spans_at = names.index("text"), len(names)

    def drop(batches):
        for batch in batches:
            texts = [without(t, [(s["start"], s["end"]) for s in spans or ()])
                     for t, spans in zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist())]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return joined.mapInArrow(drop, joined.schema)
