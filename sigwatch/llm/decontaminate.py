"""Benchmark decontamination with one Aho-Corasick automaton.

Every window of ``window`` consecutive words of a benchmark item (an item of
fewer words, but not none, is one window) is looked for. Items and texts are
normalised alike: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``,
each known word a number.

The automaton's patterns are the items' anchors: ``(window + 1) // 2`` words at
every ``window // 2 + 1``-th place (7 words at every 7th for 13), so that each
window holds exactly one anchor. It therefore has about one node per benchmark
word, where one with all windows as patterns has ``window`` times as many. An
anchor found in a text is compared word by word with the words around it in the
item, as far as a window reaches; where anchor and equal neighbours make up a
window, all of them are hit. Short items are patterns as a whole. The word
range is mapped to the original characters through the word positions.

Defined results: null and empty texts have no words and are not contaminated;
items without words have no windows; repeated documents are scanned and
returned once each; repeated items all count; items without an id hit like
others, count as one item together and have no part in ``items_sha256``; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, as_batch, staged, start, utf8

WINDOW = 13
#: Words of benchmark text in one automaton (some 100 bytes each). A larger
#: benchmark is cut into blocks of at most this size; each is one more scan of
#: the texts, one after the other, so that a task holds one automaton.
BLOCK_WORDS = 1_000_000

_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
_HITS_SQL = "array<struct<item_id:bigint,first:bigint,last:bigint>>"
RESULT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
          ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("spans", pa.string())]
RESULT_SQL = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
              "contaminated boolean, spans string")


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text if isinstance(text, bytes) else utf8(text)
    return raw.translate(ALNUM_TABLE).split()


class Automaton:
    """The anchors of (item_id, text) items: word numbers, the automaton over
    them, and per anchor (words, words a window has, places), a place being the
    item words before and behind it and the ids of the items that hold them."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        size, reach = (window + 1) // 2, window // 2
        anchors: dict[tuple, dict] = {}
        for item_id, text in items:
            seq = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            if not seq:
                continue
            short = len(seq) < window
            for at in (0,) if short else range(0, len(seq) - size + 1, reach + 1):
                anchor = seq if short else seq[at:at + size]
                around = ((), ()) if short else (seq[max(0, at - reach):at][::-1], seq[at + size:at + size + reach])
                places = anchors.setdefault((anchor, len(seq) if short else window), {})
                places.setdefault(around, set()).add(item_id)
        # an item as a whole and an anchor of others may be the same words
        owners: dict[tuple, list] = {}
        for (anchor, need), places in anchors.items():
            owners.setdefault(anchor, []).extend(
                (need, before, behind, tuple(ids)) for (before, behind), ids in places.items())
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for anchor, places in owners.items():
            self.found.add_word(anchor, (len(anchor), places))
        if owners:
            self.found.make_automaton()


def automaton(items: list[tuple], window: int = WINDOW) -> Automaton:
    return Automaton(items, window)


def scan_text(known: Automaton, text: str | None) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of words, and (item_id, first word, last word) of the stretches
    whose words are hit; together they cover every occurrence of a window."""
    words = words_of(text)
    if not words or not len(known.found):
        return len(words), []
    number = known.numbers.get
    seq = tuple([number(w, 0) for w in words])
    hits = []
    for last, (size, places) in known.found.iter(seq):
        first = last - size + 1
        for need, before, behind, ids in places:
            a, b = first, last
            for w in before:
                if a == 0 or seq[a - 1] != w:
                    break
                a -= 1
            for w in behind:
                if b + 1 == len(seq) or seq[b + 1] != w:
                    break
                b += 1
            if b - a + 1 >= need:
                hits += [(i, a, b) for i in ids]
    return len(words), hits


_INSIDE = np.frombuffer(bytes(range(256)).translate(ALNUM_TABLE), np.uint8) != 0x20


def char_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points [start, end) of inclusive word ranges, in one pass."""
    data = np.frombuffer(utf8(text), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _INSIDE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    # code points before each byte: bytes that do not continue one
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [(int(points[edge[2 * a]]), int(points[edge[2 * b + 1]])) for a, b in runs]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching inclusive ranges as disjoint ones."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``limit`` words, streamed to the driver
    one partition at a time. An item of more words is cut; the pieces overlap
    by a window less a word, so none is lost."""
    block, size = [], 0
    limit = max(limit, 2 * window)
    for item_id, text in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        words = words_of(text)
        step = limit - window + 1
        for at in range(0, max(1, len(words) - window + 1), step):
            piece = words[at:at + limit]
            if block and size + len(piece) > limit:
                yield block
                block, size = [], 0
            block.append((item_id, b" ".join(piece)))
            size += len(piece)
    yield block


#: The automaton that a Python worker built last, with its broadcast's number.
_BUILT: dict = {}


def _built(items, name: str, window: int) -> Automaton:
    """Tasks that run in one worker after another share the automaton."""
    if _BUILT.get("name") != name:
        _BUILT.clear()
        _BUILT.update(name=name, found=automaton(items.value, window))
    return _BUILT["found"]


def judged(n_words: int, hits: list[tuple], share: tuple[int, int]) -> tuple[list, int, bool]:
    """Disjoint hit ranges, hit words, and whether they reach the share."""
    runs = merged([(a, b) for _, a, b in hits])
    n_hit = sum(b - a + 1 for a, b in runs)
    return runs, n_hit, n_hit > 0 and share[1] * n_hit >= share[0] * n_words


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int, finish, schema) -> DataFrame:
    """Scan every text once per block of items; ``finish`` makes the output of
    a batch from the hits of all blocks. Earlier blocks hand their hits on in
    a column of a table, so no task holds two automata."""
    spark = start(docs.sparkSession)
    column = "_hits"
    while column in docs.columns:
        column += "_"
    names = docs.columns
    df = docs.withColumn(column, F.lit(None).cast(_HITS_SQL))
    text_at = names.index("text")

    def step(block, last: bool):
        items, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def scan(batches):
            found = _built(items, name, window)
            for batch in batches:
                n_words, hits = [], []
                for text, old in zip(batch.column(text_at).to_pylist(), batch.column(len(names)).to_pylist()):
                    n, new = scan_text(found, text)
                    n_words.append(n)
                    hits.append([(h["item_id"], h["first"], h["last"]) for h in old or ()] + new)
                if last:
                    yield finish(batch.select(names), n_words, hits)
                else:
                    rows = [[{"item_id": i, "first": a, "last": b} for i, a, b in h] for h in hits]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, _HITS)], batch.schema.names)
        return scan

    previous = None
    for block in item_blocks(benchmark, block_words, window):
        if previous is not None:
            df = staged(df.mapInArrow(step(previous, False), df.schema), "hits")
        previous = block
    return df.mapInArrow(step(previous, True), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  share: tuple[int, int] = (1, 20), block_words: int = BLOCK_WORDS, spans: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated (hit words are at least ``share`` of all), spans
    (``start:end`` code points of the maximal hit passages, comma-joined; empty
    if not asked for)."""

    def finish(batch, n_words, hits):
        rows = []
        for doc_id, text, n, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), n_words, hits):
            runs, n_hit, bad = judged(n, found, share)
            items = {i for i, _, _ in found}
            ids = sorted(str(i) for i in items if i is not None)
            rows.append((doc_id, n, n_hit, len(items), hashlib.sha256(",".join(ids).encode()).hexdigest(), bad,
                         ",".join("%d:%d" % s for s in char_spans(text, runs)) if spans and runs else ""))
        return as_batch(rows, RESULT)

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _scanned(df, benchmark, window, block_words, finish, RESULT_SQL)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               share: tuple[int, int] = (1, 20), block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that are not contaminated, with all their columns. They
    are dropped during the scan: no join moves the texts."""

    def finish(batch, n_words, hits):
        return batch.filter(pa.array([not judged(n, h, share)[2] for n, h in zip(n_words, hits)], pa.bool_()))

    return _scanned(docs, benchmark, window, block_words, finish, docs.schema)
