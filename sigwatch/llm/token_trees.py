"""Edit-aware token counts.

A byte-level BPE tokenizer first cuts a text into pre-tokens and encodes each
on its own. A document keeps a segment tree over its pre-tokens: a leaf holds
the characters and tokens of ``LEAF`` neighbouring pre-tokens, every inner node
the sums below it. After an edit only the leaves that it touches are cut and
encoded again, plus the context that can move their boundaries:

* in front, from the last leaf that starts at least two characters before the
  edit (the pattern looks at most two characters past a boundary);
* behind, until a boundary of the new text falls on an old leaf's start: from
  there the pattern sees the same text as before.

The first touched leaf takes the region's sums, the others become empty, and
only the sums above them are updated.

Defined results: a null text counts as empty (no tokens); edits are [start,
end) code points of the old text with a replacement (null: none), clipped to
the text; of overlapping edits the first by (start, end, replacement) is
applied; documents without edits keep their tree; repeated rows are treated
alike; edits without a document are ignored.

The trees are kept in a table beside their texts (``keep``), written by one
job and read by the next: after an edit nothing is built anew (``update_kept``),
and a lost executor costs its tasks only.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch, start, work_dir

#: Path of the public vocabulary; a parameter of every operator here.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters past a boundary that the pattern may have looked at.
LOOK_AHEAD = 2
LEAF = 32
#: Pre-tokens whose length a worker remembers, and their longest: longer ones,
#: unspaced text, hardly come again and are counted each time.
KEPT_COUNTS = 500_000
KEPT_LENGTH = 48

Edit = tuple[int, int, str]


class Counter(dict):
    """Tokens of a pre-token, remembered."""

    def __init__(self, ranks: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.cut = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        n = len(self.coding.encode_ordinary(piece))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_COUNTS:
                self.clear()
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(ranks: str = RANKS) -> Counter:
    return Counter(ranks)


class TokenTree:
    """Sums of characters and tokens, a heap of 2 x slots entries each: node 1
    is the root, nodes slots .. 2 slots - 1 are the leaves."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.slots = len(chars) // 2

    @classmethod
    def of(cls, chars: list[int], tokens: list[int]) -> "TokenTree":
        slots = 1 << max(0, len(chars) - 1).bit_length()
        heaps = []
        for values in (chars, tokens):
            heap = np.zeros(2 * slots, np.int64)
            heap[slots:slots + len(values)] = values
            width = slots
            while width > 1:
                heap[width // 2:width] = heap[width:2 * width:2] + heap[width + 1:2 * width:2]
                width //= 2
            heaps.append(heap)
        return cls(*heaps)

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, place: int) -> tuple[int, int]:
        """The last leaf that starts at or before a character, and its start."""
        node, begin = 1, 0
        while node < self.slots:
            node *= 2
            if begin + self.chars[node] <= place and self.chars[node + 1]:
                begin += int(self.chars[node])
                node += 1
        return node - self.slots, begin

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        """Replace a leaf and add the difference to the sums above it."""
        node = leaf + self.slots
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        if more_chars or more_tokens:
            while node:
                self.chars[node] += more_chars
                self.tokens[node] += more_tokens
                node //= 2


def build(text: str | None, count: Counter) -> tuple[TokenTree, int]:
    """A text's tree and its number of pre-tokens."""
    pieces = count.cut.findall(text or "")
    if not pieces:
        return TokenTree.of([0], [0]), 0
    at = np.arange(0, len(pieces), LEAF)
    chars = np.add.reduceat(np.fromiter(map(len, pieces), np.int64, len(pieces)), at)
    tokens = np.add.reduceat(np.fromiter(map(count.__getitem__, pieces), np.int64, len(pieces)), at)
    return TokenTree.of(chars, tokens), len(pieces)


def in_order(edits: list[Edit], size: int) -> list[Edit]:
    """Clipped to the text, sorted, overlapping ones left out."""
    out, last = [], 0
    for a, b, new in sorted((min(max(a, 0), size), min(max(b, a, 0), size), new or "") for a, b, new in edits):
        if a >= last:
            out.append((a, b, new))
            last = max(b, a)
    return out


def edited(text: str, edits: list[Edit]) -> str:
    out, last = [], 0
    for a, b, new in edits:
        out += [text[last:a], new]
        last = b
    return "".join(out) + text[last:]


def update(tree: TokenTree, new_text: str, edits: list[Edit], count: Counter) -> int:
    """Bring the tree of the old text up to date with the new one; returns the
    number of pre-tokens that were encoded again. ``edits`` are in order."""
    starts = np.concatenate([[0], np.cumsum(tree.chars[tree.slots:])])[:-1]
    growth = np.cumsum([len(new) - (b - a) for a, b, new in edits])
    new_end = [int(b + g) for (_, b, _), g in zip(edits, growth)]
    new_start = [e - len(new) for e, (_, _, new) in zip(new_end, edits)]
    changes, again, k, moved = [], 0, 0, 0
    while k < len(edits):
        first, begin = tree.find(max(0, edits[k][0] - LOOK_AHEAD))
        here = end = begin + moved
        last, tokens = tree.slots, 0
        for m in count.cut.finditer(new_text, here):
            tokens += count[m[0]]
            again += 1
            end = m.end()
            # edits that start here, or so close that they can move this boundary
            while k + 1 < len(edits) and new_start[k + 1] < end + LOOK_AHEAD:
                k += 1
            if end >= new_end[k]:
                old = end - int(growth[k])
                leaf = int(np.searchsorted(starts, old))
                if first < leaf < tree.slots and starts[leaf] == old and tree.chars[tree.slots + leaf]:
                    last = leaf
                    break
        else:
            k = len(edits) - 1
        changes.append((first, last, end - here, tokens))
        moved = int(growth[k])
        k += 1
    for first, last, chars, tokens in changes:
        tree.set(first, chars, tokens)
        for leaf in range(first + 1, last):
            tree.set(leaf, 0, 0)
    return again


# ---- on tables --------------------------------------------------------------

_TREE = [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))]
_TREE_SQL = "doc_id long, text_hash long, chars array<long>, tokens array<long>"
_UPDATED = [("doc_id", pa.int64()), ("n_before", pa.int64()), ("n_tokens", pa.int64()), ("n_edits", pa.int64()),
            ("n_encoded_again", pa.int64())]
_UPDATED_SQL = "doc_id long, n_before long, n_tokens long, n_edits long, n_encoded_again long"
_EDITS_SQL = "array<struct<start:bigint,end:bigint,replacement:string>>"


def trees(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """The segment tree of every document: doc_id, a hash of its text, chars
    and tokens (heaps). Null and empty texts have a tree of one empty leaf."""
    start(docs.sparkSession)

    def scan(batches):
        count = counter(ranks)
        for batch in batches:
            built = [build(t, count)[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([t.chars for t in built], _TREE[2][1]),
                 pa.array([t.tokens for t in built], _TREE[3][1])], [n for n, _ in _TREE])

    return _texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(scan, _TREE_SQL)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _gathered(edits: DataFrame) -> DataFrame:
    """The edits (doc_id, start, end, replacement) of a document as one array;
    a group is one document's edits."""
    return (edits.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
                                  F.col("replacement").cast("string").alias("replacement")).alias("e"))
            .groupBy("doc_id").agg(F.collect_list("e").alias("edits")))


def apply_edits(docs: DataFrame, kept: DataFrame, edits: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Trees after the edits, from the kept trees: doc_id, chars, tokens,
    n_before, n_tokens, n_edits, n_encoded_again; one row per document that
    has a tree. Untouched regions are not cut or encoded.

    A tree belongs to a text, so documents that share an id (or have none) take
    the tree of their own text and all edits of their id."""
    start(docs.sparkSession)

    def scan(batches):
        count = counter(ranks)
        for batch in batches:
            heaps, rows = ([], []), []
            for doc_id, text, chars, tokens, own in zip(*(c.to_pylist() for c in batch.columns)):
                tree = TokenTree(np.array(chars, np.int64), np.array(tokens, np.int64))
                before, text = tree.total, text or ""
                own = in_order([(e["start"], e["end"], e["replacement"]) for e in own or ()], len(text))
                again = update(tree, edited(text, own), own, count) if own else 0
                rows.append((doc_id, before, tree.total, len(own), again))
                heaps[0].append(tree.chars)
                heaps[1].append(tree.tokens)
            head = as_batch(rows, _UPDATED)
            yield pa.RecordBatch.from_arrays(
                [head.column(0), *(pa.array(h, pa.list_(pa.int64())) for h in heaps), *head.columns[1:]],
                ["doc_id", "chars", "tokens", *(n for n, _ in _UPDATED[1:])])

    own = (kept.select(F.col("doc_id").alias("_tree_doc"), F.col("text_hash").alias("_tree_text"), "chars", "tokens")
           .dropDuplicates(["_tree_doc", "_tree_text"]))
    texts = _texts(docs).withColumn("text_hash", F.xxhash64("text"))
    rows = texts.join(own, F.col("doc_id").eqNullSafe(F.col("_tree_doc")) & (F.col("text_hash") == F.col("_tree_text")))
    wanted = _gathered(edits).withColumnRenamed("doc_id", "_edit_doc")
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_edit_doc")), "left")
    return rows.select("doc_id", "text", "chars", "tokens", "edits").mapInArrow(
        scan, _TREE_SQL.replace("text_hash long, ", "") + ", " + _UPDATED_SQL.split(", ", 1)[1])


_LONG_DIGITS = regex.compile(r"[0-9]{4,}")


def masking_edits(text: str | None) -> list[Edit]:
    """A usual cleaning pass: digit runs of four and more are masked, and the
    first of several lines, a title in most sources, is cut."""
    text = text or ""
    out = [(m.start(), m.end(), "0") for m in _LONG_DIGITS.finditer(text)]
    head = text.find("\n")
    if 0 <= head < len(text) - 1:
        out.append((0, head + 1, ""))
    return in_order(out, len(text))


_KEPT_SQL = "doc_id long, text string, chars array<long>, tokens array<long>"


def keep(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Writes every document with its tree (doc_id, text, chars, tokens) to a
    table in the shared folder and reads it back. Text and tree lie in one row,
    so an update shuffles neither."""
    spark = start(docs.sparkSession)

    def scan(batches):
        count = counter(ranks)
        for batch in batches:
            built = [build(t, count)[0] for t in batch.column(1).to_pylist()]
            heaps = (pa.array([getattr(t, name) for t in built], pa.list_(pa.int64())) for name in ("chars", "tokens"))
            yield pa.RecordBatch.from_arrays([*batch.columns, *heaps], ["doc_id", "text", "chars", "tokens"])

    path = work_dir(spark, "trees")
    _texts(docs).mapInArrow(scan, _KEPT_SQL).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_KEPT_SQL).parquet(path)


def _slices(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column without nulls, as views."""
    values = column.values.to_numpy()
    bounds = column.offsets.to_numpy().tolist()
    return [values[a:b] for a, b in zip(bounds, bounds[1:])]


def update_kept(kept: DataFrame, make_edits=masking_edits, ranks: str = RANKS) -> DataFrame:
    """Counts before and after the edits that ``make_edits`` gives for a text,
    from the kept trees alone: doc_id, n_before, n_tokens, n_edits,
    n_encoded_again. The text is cut and encoded only around edits."""
    start(kept.sparkSession)

    def scan(batches):
        count = counter(ranks)
        for batch in batches:
            rows = []
            for doc_id, text, chars, tokens in zip(*(c.to_pylist() for c in batch.columns[:2]), *map(_slices, batch.columns[2:])):
                before = after = int(tokens[1])
                edits, again = make_edits(text), 0
                if edits:
                    tree = TokenTree(chars.copy(), tokens.copy())
                    again = update(tree, edited(text or "", edits), edits, count)
                    after = tree.total
                rows.append((doc_id, before, after, len(edits), again))
            yield as_batch(rows, _UPDATED)

    return kept.select("doc_id", "text", "chars", "tokens").mapInArrow(scan, _UPDATED_SQL)


def counted(docs: DataFrame, make_edits=masking_edits, ranks: str = RANKS) -> DataFrame:
    """Counts before and after a cleaning pass: one job keeps the trees, the
    next updates them. One row per document."""
    return update_kept(keep(docs, ranks), make_edits, ranks)
