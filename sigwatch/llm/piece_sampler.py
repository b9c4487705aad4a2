"""SentencePiece encoding by forward filtering and backward sampling.

The lattice of a text has an edge for every vocabulary piece at every place
(and a byte edge where no piece holds a character). Forward filtering sums the
weights of all paths to each node; backward sampling walks from the end and
draws each edge in proportion to the weight of the paths through it, so a
segmentation is drawn with probability proportional to the product of its
pieces' weights. The draws are a counter-based hash of (seed, row key, segment
number, step): the same row gives the same segmentation on any cluster.

Pieces never run on past a space that follows another character, nor over a
character outside the vocabulary, so those places cut the lattice: filtering
and sampling are exact per segment, and equal segments share their filter.
All segments of a batch are filtered and sampled together in numpy.

Piece weights are powers ``alpha`` of a Zipf law over the vocabulary's ranks
(the model is a merge list, it has no probabilities of its own).

Decoding is lossless: a space in front of the text is added and taken off
again, spaces are the pieces' own space mark, and characters without a piece
(also a literal space mark) are byte pieces.

Defined results: a null text has null ids and decodes to null, an empty text
has none and decodes to the empty text; a null row key is key 0 of a seed of
its own; repeated rows are segmented alike; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch, start, utf8
from .shingles import mix

#: Path of the public model; a parameter of every operator here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.4
SEED = 1
BYTE_PENALTY = 4.0
#: Added to a rank before its logarithm: flattens the head of the Zipf law.
RANK_SHIFT = 10.0
#: Lattice nodes (one per character of a segment, some 60 bytes) from which on a
#: Python worker forgets its filters.
KEPT_NODES = 1_000_000

#: Rows whose segments are drawn together, and their characters, unless a
#: single text has more.
ROWS, CHARS = 200, 400_000

_MARK = "▁"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1B54A32D192ED03)
_SPREAD = np.uint64(0xFF51AFD7ED558CCD)
#: Address bits of the first piece table.
SLOT_BITS = 16


class Vocabulary:
    """Pieces of a model, spaces in place of its space mark."""

    def __init__(self, model: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        count = sp.get_piece_size()
        plain = [k for k in range(count) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k))]
        self.byte_ids = np.full(256, -1, np.int64)
        self.text: list[bytes] = [b""] * count
        for k in range(count):
            if sp.is_byte(k):
                value = int(sp.id_to_piece(k)[1:-1], 16)
                self.byte_ids[value] = k
                self.text[k] = bytes([value])
        self.ids = {}
        for rank, k in enumerate(plain):
            piece = sp.id_to_piece(k).replace(_MARK, " ")
            if " " in piece.lstrip(" "):
                raise ValueError("a piece runs over a space: segments would not be independent")
            self.ids[piece] = (k, rank)
            self.text[k] = piece.encode()
        total = np.log(np.sum(1.0 / (np.arange(len(plain)) + RANK_SHIFT)))
        self.log_weight = {p: -np.log(rank + RANK_SHIFT) - total for p, (_, rank) in self.ids.items()}
        self.byte_log_weight = -np.log(len(plain) + RANK_SHIFT) - total - BYTE_PENALTY
        self.longest = max(map(len, self.ids))
        self.single = {p for p in self.ids if len(p) == 1}
        # per piece length a table addressed by the top bits of the hash; pieces
        # that meet in a slot move on to the next table
        self.tables: dict[int, list[tuple]] = {}
        for size in range(1, self.longest + 1):
            pieces = [p for p in self.ids if len(p) == size]
            if pieces:
                codes = np.array([[ord(c) for c in p] for p in pieces], np.uint64)
                h = np.zeros(len(pieces), np.uint64)
                for k in range(size):
                    h = h * _ODD + codes[:, k]
                if len(np.unique(h)) != len(h):
                    raise ValueError("two pieces of one length have the same hash")
                ids = np.array([self.ids[p][0] for p in pieces])
                weights = np.array([self.log_weight[p] for p in pieces])
                left, self.tables[size] = np.arange(len(h)), []
                while len(left):
                    shift = 64 - SLOT_BITS - len(self.tables[size])
                    slots = np.full(1 << (64 - shift), -1, np.int32)
                    at = (h * _SPREAD >> np.uint64(shift)).astype(np.int64)
                    slots[at[left]] = left
                    self.tables[size].append((np.uint64(shift), slots, h, ids, weights))
                    left = left[slots[at[left]] != left]
        inside = "".join(sorted(re.escape(c) for c in self.single if c != " "))
        self.segments = re.compile(rf" *[{inside}]+| +|[^ {inside}]", re.S)


@lru_cache(maxsize=2)
def vocabulary(model: str = MODEL) -> Vocabulary:
    return Vocabulary(model)


class Growing:
    """An array that is appended to."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1 << 12, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data[:self.n], np.empty(self.n // 2 + len(values), self.data.dtype)])
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)


class Lattice:
    """Backward sampling tables of segments, filled batch by batch.

    The segments of one length that are filtered together are a group of n:
    node t (the place behind the t-th character) of the k-th has the number
    base + (t - 1) n + k, so an edge of some size leads n times that number
    back. The edges that end at a node lie together, with their cumulative
    probabilities in ``cut``."""

    def __init__(self, vocab: Vocabulary, alpha: float = ALPHA):
        self.vocab, self.alpha = vocab, alpha
        self.known: dict[str, int] = {}
        self.nodes = 0
        self.last, self.stride, self.length = Growing(np.int64), Growing(np.int64), Growing(np.int64)
        self.first_edge = Growing(np.int64)
        self.cut, self.size, self.piece = Growing(np.float32), Growing(np.int8), Growing(np.int32)

    def add(self, segments: set[str]) -> None:
        """Filter the segments that are not known yet."""
        if self.nodes > KEPT_NODES:
            self.__init__(self.vocab, self.alpha)
        by_length: dict[int, list[str]] = {}
        for s in segments:
            if s not in self.known:
                by_length.setdefault(len(s), []).append(s)
        for length, group in by_length.items():
            step = max(1, 150_000 // length)
            for a in range(0, len(group), step):
                self._filter(group[a:a + step], length)

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """All edges of a group, ordered by end node: (end, segment, size, log weight, piece)."""
        vocab = self.vocab
        n, length = codes.shape
        found: list[tuple] = []
        alone = np.ones(n * length, bool)
        h = np.zeros((n, length), np.uint64)
        for size in range(1, min(length, vocab.longest) + 1):
            places = length - size + 1
            h = h[:, :places] * _ODD
            h += codes[:, size - 1:size - 1 + places]
            flat, spread = h.ravel(), (h * _SPREAD).ravel()
            for shift, slots, hashes, ids, weights in vocab.tables.get(size, ()):
                at = slots[(spread >> shift).view(np.int64)]
                place = np.flatnonzero(at >= 0)
                what = at[place]
                same = hashes[what] == flat[place]  # 64 bits, one length: the piece
                place, what = place[same], what[same]
                row, col = np.divmod(place, places)
                found.append((col + size, row, np.full(len(row), size), self.alpha * weights[what], ids[what]))
                if size == 1:
                    alone[place] = False
        alone = alone.reshape(n, length)
        # characters without a piece: their bytes, one edge; the id is minus the code point
        row, col = np.nonzero(alone)
        if len(row):
            c = codes[row, col].astype(np.int64)
            count = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
            found.append((col + 1, row, np.ones(len(row), np.int64), self.alpha * vocab.byte_log_weight * count,
                          np.where(c < 0x80, vocab.byte_ids[np.minimum(c, 255)], -c)))
        end, seg, size, weight, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort((end * n + seg) * 32 + size)
        return end[order], seg[order], size[order], weight[order], piece[order]

    def _filter(self, group: list[str], length: int) -> None:
        n = len(group)
        codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).astype(np.uint64)
        end, seg, size, weight, piece = self._edges(codes)
        # every node has an edge of size 1, its first: those cut the edges into nodes
        node_edge = np.flatnonzero(size == 1)
        at = np.append(node_edge[::n], len(end))
        forward = np.zeros((length + 1, n))
        cut = np.empty(len(end))
        for t in range(1, length + 1):
            a, b = at[t - 1], at[t]
            who, starts = seg[a:b], node_edge[(t - 1) * n:t * n] - a
            score = weight[a:b] + forward[t - size[a:b], who]
            top = np.maximum.reduceat(score, starts)
            p = np.exp(score - top[who])
            paths = np.add.reduceat(p, starts)
            forward[t] = top + np.log(paths)
            run = np.cumsum(p)
            cut[a:b] = (run - (run[starts] - p[starts])[who]) / paths[who]
        cut[np.append(node_edge[1:], len(end)) - 1] = 2.0  # the last edge takes the rest
        self.first_edge.extend(node_edge + self.cut.n)
        self.cut.extend(cut)
        self.size.extend(size)
        self.piece.extend(piece)
        self.known.update(zip(group, range(self.last.n, self.last.n + n)))
        self.last.extend(self.nodes + (length - 1) * n + np.arange(n))
        self.stride.extend(np.full(n, n))
        self.length.extend(np.full(n, length))
        self.nodes += n * length

    def sample(self, segments: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all segments in a row, and the number of pieces of each.
        ``keys`` seeds the draws of each segment."""
        cut, first_edge = self.cut.data, self.first_edge.data
        active = np.arange(len(segments))
        node, stride, left = (x.data[segments] for x in (self.last, self.stride, self.length))
        key = keys
        drawn, counts = [], np.zeros(len(segments), np.int64)
        while len(active):
            key = key + _STEP
            u = (mix(key) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            edge = first_edge[node]
            behind = np.flatnonzero(cut[edge] <= u)
            while len(behind):
                edge[behind] += 1
                behind = behind[cut[edge[behind]] <= u[behind]]
            drawn.append((active, self.piece.data[edge]))
            counts[active] += 1
            size = self.size.data[edge].astype(np.int64)
            left = left - size
            go = np.flatnonzero(left > 0)
            key, active, left, stride = key[go], active[go], left[go], stride[go]
            node = node[go] - size[go] * stride
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        for step, (who, what) in enumerate(drawn):
            out[ends[who] - 1 - step] = what
        return out, counts


@lru_cache(maxsize=1)
def worker_lattice(model: str = MODEL, alpha: float = ALPHA) -> Lattice:
    """A worker's lattice, shared by the tasks that it runs in turn. What is
    kept in it never changes a result."""
    return Lattice(vocabulary(model), alpha)


def encode_batch(lattice: Lattice, keys: list[int | None], texts: list[str | None], seed: int = SEED) -> list[np.ndarray | None]:
    """Sampled piece ids of each text."""
    find = lattice.vocab.segments.findall
    parts = [find(" " + t) if t else [] for t in texts]
    flat = list(chain.from_iterable(parts))
    lattice.add(set(flat))
    segments = np.fromiter(map(lattice.known.__getitem__, flat), np.int64, len(flat))
    sizes = np.array([len(p) for p in parts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    row = mix(np.array([(k or 0) & (2 ** 64 - 1) for k in keys], np.uint64) * _ODD
              + np.array([seed + (k is None) * 2 ** 32 for k in keys], np.uint64))
    place = (np.arange(len(flat)) - np.repeat(bounds[:-1], sizes)).astype(np.uint64)
    ids, counts = lattice.sample(segments, mix(np.repeat(row, sizes) + place * _ODD))
    ends = np.concatenate([[0], np.cumsum(counts)])[bounds]
    out = []
    for k, t in enumerate(texts):
        own = ids[ends[k]:ends[k + 1]]
        if len(own) and own.min() < 0:  # characters of several bytes without a piece
            byte_ids = lattice.vocab.byte_ids
            own = np.concatenate([byte_ids[list(utf8(chr(-i)))] if i < 0 else [i] for i in own.tolist()])
        out.append(None if t is None else own.astype(np.int32))
    return out


def decode(vocab: Vocabulary, ids) -> str | None:
    """The text of piece ids."""
    if ids is None:
        return None
    spelled = vocab.text
    return b"".join([spelled[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def portions(texts: list[str | None], rows: int = ROWS, chars: int = CHARS) -> Iterator[slice]:
    """Neighbouring texts, at most ``rows`` of them, and of one portion at most
    ``chars`` characters in all or a single text."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        more = len(text or "")
        if k > begin and (k - begin == rows or size + more > chars):
            yield slice(begin, k)
            begin, size = k, 0
        size += more
    if begin < len(texts):
        yield slice(begin, len(texts))


def encoded(docs: DataFrame, key: str = "doc_id", model: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """One row per document: the key, its sampled piece ids, their number, and
    whether they decode to the text."""
    start(docs.sparkSession)

    def scan(batches):
        lattice = worker_lattice(model, alpha)
        for batch in batches:
            keys, texts = (c.to_pylist() for c in batch.columns)
            ids = []
            for part in portions(texts):  # bounds the nodes and draws that are held at once
                ids += encode_batch(lattice, keys[part], texts[part], seed)
            same = [decode(lattice.vocab, None if i is None else i.tolist()) == t for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([0 if i is None else len(i) for i in ids], pa.int64()), pa.array(same, pa.bool_())],
                [key, "ids", "n_tokens", "lossless"])

    df = docs.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))
    return df.mapInArrow(scan, f"`{key}` long, ids array<int>, n_tokens long, lossless boolean")


def decoded(rows: DataFrame, key: str = "doc_id", model: str = MODEL) -> DataFrame:
    """The texts of piece id rows (key, ids)."""
    start(rows.sparkSession)

    def scan(batches):
        vocab = vocabulary(model)
        for batch in batches:
            yield as_batch([(k, decode(vocab, i)) for k, i in zip(*(c.to_pylist() for c in batch.columns))],
                           [(key, pa.int64()), ("text", pa.string())])

    return rows.select(F.col(key).cast("long").alias(key), "ids").mapInArrow(scan, f"`{key}` long, text string")


def digests(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, number of tokens, SHA-256 of the ids as little-endian 32-bit numbers, lossless."""

    def scan(batches):
        for batch in batches:
            ids = batch.column(1)
            sums = [hashlib.sha256(np.asarray(i.values.to_numpy(zero_copy_only=False), "<i4").tobytes()).hexdigest()
                    if i.is_valid else None for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sums, pa.string()), batch.column(3)],
                                             [key, "n_tokens", "ids_sha256", "lossless"])

    return rows.select(key, "ids", "n_tokens", "lossless").mapInArrow(
        scan, f"`{key}` long, n_tokens long, ids_sha256 string, lossless boolean")
