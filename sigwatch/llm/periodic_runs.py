"""Periodic runs of words, by Baier grouping and Lyndon roots.

Phase one of Baier's suffix sorter deals the suffixes into groups whose common
prefix is each suffix's longest Lyndon prefix. So it gives the Lyndon array
(the length of that prefix at every position) and, as group numbers, which of
those Lyndon words are equal; phase two, the sorting proper, is not needed.
Every run of period q consists of copies of a Lyndon word of length q under
one of the two orders of the alphabet (its root), and under that order the
root is the longest Lyndon prefix wherever it stands in the run. So the runs
are read off from positions whose next roots, q words apart, are in the same
group, and extended to both sides by longest common extensions.

A run of exponent e or more holds e - 1 whole roots one after the other, and
each of its words at least e times. Words that a text (then a stretch between
such words) holds more seldom therefore part the text; only stretches that
can hold a run are grouped. This leaves every run in place.

Spark deals the documents out; a task works on one Arrow batch of texts at a
time, all stretches of a batch in one grouping.

Defined results: null, empty and blank texts have no words and no runs; very
long texts are one stretch list like others; repeated rows and ties give one
row each; a null doc_id stays null; extra columns are ignored (``collapsed``
keeps them and names its own column anew if it clashes); an empty table gives
an empty result.
"""

from __future__ import annotations

import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch, start

#: The contract's least length and least exponent.
MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Rounds of leaving out rare words; more would only save time.
ROUNDS = 4

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_REPORT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()),
           ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
           ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
_REPORT_SQL = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
               "runs_sha256 string, collapsed_sha256 string")


def lyndon_groups(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position the length of the longest Lyndon prefix of its suffix, and
    a number that is equal where those prefixes are. Zeros are ends of text,
    smaller than all; at them both results mean nothing.

    Groups are ranges of one array and are taken from the largest down. Each
    member's nearest smaller suffix to the left (by groups so far) takes the
    group's word up behind its own, as often as members point to it: it leaves
    its group for a new one right above."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if n else np.empty(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    of = np.empty(n, np.int64)
    of[order] = np.repeat(first, sizes)
    room = np.zeros(n, np.int64)
    room[first] = sizes
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    order, group, size, place = order.tolist(), of.tolist(), room.tolist(), at.tolist()
    left, length = list(range(-1, n - 1)), [1] * n
    low = int(np.count_nonzero(codes == 0))  # the ends are the lowest group, and stay one
    end = n
    while end > low:
        begin = group[order[end - 1]]
        members = sorted(order[begin:end])
        grown = length[members[0]]
        end = begin
        points: dict[int, int] = {}
        for i in members:
            j = left[i]
            while j >= 0 and group[j] >= begin:
                j = left[j]
            left[i] = j
            if j >= 0 and group[j] >= low:
                points[j] = points.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, c in points.items():
            by_count.setdefault(c, []).append(j)
        for c in sorted(by_count, reverse=True):
            moved: dict[int, list[int]] = {}
            for j in by_count[c]:
                g = group[j]
                size[g] -= 1
                last = g + size[g]
                other, was = order[last], place[j]
                order[last], order[was] = j, other
                place[j], place[other] = last, was
                length[j] += c * grown
                moved.setdefault(g, []).append(j)
            for g, js in moved.items():
                fresh = g + size[g]
                size[fresh] = len(js)
                for j in js:
                    group[j] = fresh
    return np.array(length, np.int64), np.array(group, np.int64)


def _extent(a: list[int], i: int, j: int, step: int) -> int:
    """Longest common extension: how many steps a[i] and a[j] go on equal."""
    n = 0
    while a[i] == a[j]:
        i += step
        j += step
        n += 1
    return n


def runs_of_sequence(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple]:
    """(start, length, period) of the runs between the zeros of the sequence,
    sorted by start and period, with length >= max(min_length, min_exponent * period)."""
    whole = max(min_exponent - 1, 1)  # roots that such a run holds whole
    codes = np.r_[0, codes, 0]
    ends = np.flatnonzero(codes == 0)
    words = codes.copy()
    words[ends] = -1 - np.arange(len(ends))  # no two ends are equal
    words = words.tolist()
    found = set()
    for turned in (False, True):
        length, group = lyndon_groups(np.where(codes == 0, 0, codes.max() + 1 - codes) if turned else codes)
        i = np.flatnonzero(codes != 0)
        for k in range(1, whole):
            i = i[i + k * length[i] < len(codes)]
            i = i[group[i + k * length[i]] == group[i]]
        before = i - length[i]
        i = i[(before < 0) | (group[before] != group[i])]  # the first of its row of roots
        for s, p in zip(i.tolist(), length[i].tolist()):
            back = _extent(words, s - 1, s - 1 + p, -1)
            n = back + p + _extent(words, s, s + p, 1)
            if n >= max(min_length, min_exponent * p, 2 * p):
                found.add((s - back - 1, n, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbered(words: list) -> np.ndarray:
    """Words as numbers from 1, equal where the words are."""
    ids: dict = {}
    return np.array([ids.setdefault(w, len(ids) + 1) for w in words], np.int64)


def _stretches(texts: list[np.ndarray], min_length: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and places (in the texts laid end to end) of the words that can
    stand in a run; a zero wherever the text is parted."""
    sizes = [len(t) for t in texts]
    codes = np.concatenate([np.where(np.bincount(t)[t] >= least, t, 0) if len(t) else t for t in texts]
                           or [np.empty(0, np.int64)])
    parted = np.zeros(len(codes) + 1, bool)
    parted[np.cumsum([0] + sizes)] = True  # before each text
    places = np.arange(len(codes))
    for _ in range(ROUNDS):
        keep = codes != 0
        new = parted[:-1] | ~keep
        stretch = np.cumsum(new | np.r_[False, ~keep[:-1]])
        size = np.bincount(stretch, weights=keep) if len(stretch) else np.empty(0)
        keep &= size[stretch] >= min_length
        places, codes, stretch = places[keep], codes[keep], stretch[keep]
        if not len(codes):
            break
        # what is left of a text is parted where the places jump or the stretch ends
        parted = np.r_[True, (stretch[1:] != stretch[:-1]) | (places[1:] != places[:-1] + 1), True]
        stretch = np.cumsum(parted[:-1])
        _, back, seen = np.unique(stretch * (int(codes.max()) + 1) + codes, return_inverse=True, return_counts=True)
        rare = seen[back] < least
        if not rare.any():
            break
        codes = np.where(rare, 0, codes)
    keep = codes != 0
    if not keep.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    jump = parted[:-1] | ~np.r_[True, keep[:-1]]
    codes, places, jump = codes[keep], places[keep], jump[keep]
    at = np.flatnonzero(jump)
    return np.insert(codes, at, 0), np.insert(places, at, -1)


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple]]:
    """Per text (words as numbers from 1) its runs (start, length, period)."""
    out: list[list[tuple]] = [[] for _ in texts]
    codes, places = _stretches(texts, min_length, max(min_exponent, 2))
    if len(codes):
        firsts = np.cumsum([0] + [len(t) for t in texts])
        for a, n, p in runs_of_sequence(codes, min_length, min_exponent):
            place = int(places[a])
            k = int(np.searchsorted(firsts, place, "right")) - 1
            out[k].append((place - int(firsts[k]), n, p))
    for rows in out:
        rows.sort(key=lambda r: (r[0], r[2]))
    return out


def left_over(n: int, runs: list[tuple]) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for a, size, p in runs:
        depth[a + p] += 1
        depth[a + size] -= 1
    return np.cumsum(depth[:n]) == 0


def planted(doc_id: int | None, words: list) -> list:
    """Fixed rule of the contract: of every tenth document (by the id's
    checksum) the tail becomes periodic. A null id is left alone."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


# ---- on tables ------------------------------------------------------------------

def _words(batch: pa.RecordBatch, at: int) -> list[list[bytes]]:
    # bytes.split() parts at exactly the six white space characters of ASCII
    return [t.split() if t else [] for t in batch.column(at).cast(pa.binary()).to_pylist()]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def run_report(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
               change=None) -> DataFrame:
    """One row per document: number of runs, the longest run (ties: smallest
    start, then period), digests of all runs and of the words left over.
    ``change(doc_id, words)`` may alter the words first."""
    start(docs.sparkSession)

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            words = _words(batch, 1)
            if change is not None:
                words = [change(k, w) for k, w in zip(ids, words)]
            rows = []
            for doc_id, text, runs in zip(ids, words, runs_of([numbered(w) for w in words], min_length, min_exponent)):
                best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
                lines = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
                kept = text
                if runs:
                    stays = left_over(len(text), runs)
                    kept = [w for w, s in zip(text, stays.tolist()) if s]
                rows.append((doc_id, len(text), len(runs), *(best or (None, None, None)),
                             1000 * best[1] // best[2] if best else None, sha256(lines.encode()).hexdigest(),
                             sha256(b" ".join(kept)).hexdigest()))
            yield as_batch(rows, _REPORT)

    return _texts(docs).mapInArrow(scan, _REPORT_SQL)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per run: doc_id, first_word, n_words, period, start, end (code
    points in the source) and the root's first period as text."""
    start(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("period", pa.int64()),
              ("start", pa.int64()), ("end", pa.int64()), ("root", pa.string())]

    def scan(batches):
        for batch in batches:
            rows = []
            texts = batch.column(1).to_pylist()
            words = _words(batch, 1)
            for doc_id, text, runs in zip(batch.column(0).to_pylist(), texts,
                                          runs_of([numbered(w) for w in words], min_length, min_exponent)):
                if not runs:
                    continue
                spans = [m.span() for m in _WORD.finditer(text)]
                for a, n, p in runs:
                    root = " ".join(text[x:y] for x, y in spans[a:a + p])
                    rows.append((doc_id, a, n, p, spans[a][0], spans[a + n - 1][1], root))
            yield as_batch(rows, fields)

    return _texts(docs).mapInArrow(
        scan, "doc_id long, first_word long, n_words long, period long, start long, end long, root string")


def collapsed(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """The documents with each run cut down to its first period, plus the cut
    [start, end) code points of the source as ``removed`` (null: nothing). A
    dropped word goes with the white space behind it; other text stays as it is."""
    start(docs.sparkSession)
    column = "removed"
    while column in docs.columns:
        column += "_"
    at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        for batch in batches:
            texts, cuts = batch.column(at).to_pylist(), []
            words = _words(batch, at)
            for k, runs in enumerate(runs_of([numbered(w) for w in words], min_length, min_exponent)):
                if not runs:
                    cuts.append(None)
                    continue
                text = texts[k]
                spans = [m.span() for m in _WORD.finditer(text)]
                gone = np.flatnonzero(~left_over(len(spans), runs))
                heads = gone[np.r_[True, gone[1:] != gone[:-1] + 1]].tolist()
                tails = gone[np.r_[gone[1:] != gone[:-1] + 1, True]].tolist()
                cut = [(spans[a][0], spans[b + 1][0] if b + 1 < len(spans) else spans[b][1]) for a, b in zip(heads, tails)]
                edges = [0, *(x for c in cut for x in c), len(text)]
                texts[k] = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                cuts.append([{"start": a, "end": b} for a, b in cut])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cuts, kind)], [*batch.schema.names, column])

    out = docs.withColumn("text", F.col("text").cast("string"))
    schema = out.withColumn(column, F.lit(None).cast("array<struct<start:long,end:long>>")).schema
    return out.mapInArrow(scan, schema)
