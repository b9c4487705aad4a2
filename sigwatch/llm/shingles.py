"""Hashed word shingle sets and their parity sketches (numpy, inside tasks)."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash

from .common import utf8


class Rule(NamedTuple):
    """Words a shingle, and the similarity: two sets link when num/den of their
    union is shared. From 4/5 on, linked sets are in the same or the next band."""

    words: int = 3
    num: int = 90
    den: int = 100


#: The contract's rule.
CONTRACT = Rule()

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Words up to this many bytes are hashed together, longer ones one by one.
_SHORT = 256
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POWER = np.cumprod(np.full(_SHORT, _MIX[0] | np.uint64(1), np.uint64))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start bytes of the words between ASCII white space: a
    polynomial of random byte values, evaluated for all words at once."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IS_WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
    if size.max() > _SHORT:
        np.minimum(place, _SHORT - 1, out=place)
    out = np.add.reduceat(_BYTE[data[inside[1:-1].view(bool)]] * _POWER[place], first)
    for k in np.flatnonzero(size > _SHORT):
        out[k] = xxhash.xxh64_intdigest(raw[starts[k]:ends[k]])
    return mix(out + size.astype(np.uint64)), starts


def shingle_sets(texts: list[str | None], size: int = CONTRACT.words) -> list[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its word shingles: A-Z
    lower-cased, words between ASCII white space; a text of fewer words is one
    shingle, one without words none. Texts are hashed together, a batch at a time."""
    raws = [utf8(t) for t in texts]
    h, starts = word_hashes(b"\n".join(raws).lower())
    bounds = np.cumsum([0] + [len(r) + 1 for r in raws])
    cuts = np.searchsorted(starts, bounds)
    grams = np.empty(0, np.uint64)
    if len(h) >= size:
        n = len(h) - size + 1
        grams = h[:n] * _MIX[0]
        for k in range(1, size):
            grams = mix(grams) + h[k:n + k] * _MIX[k % 3]
        grams = mix(grams)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= size:
            s = np.sort(grams[a:b - size + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            whole = h[a:a + 1] * _MIX[0]
            for k in range(1, b - a):
                whole = mix(whole) + h[a + k:a + k + 1] * _MIX[k % 3]
            out.append(mix(whole + np.uint64(b - a)))
        else:
            out.append(h[:0])
    return out


def shingle_set(text: str | None, size: int = CONTRACT.words) -> np.ndarray:
    return shingle_sets([text], size)[0]


def linked(a: np.ndarray, b: np.ndarray, rule: Rule = CONTRACT) -> bool:
    """Whether two sets reach the similarity."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or rule.den * len(small) < rule.num * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int(np.count_nonzero(large[at] == small))
    return rule.den * common >= rule.num * (len(a) + len(b) - common)


def difference_limit(a, b, rule: Rule = CONTRACT):
    """Largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (rule.den - rule.num) // (rule.den + rule.num)


# ---- size bands --------------------------------------------------------------

def band_edges(limit: int = 1 << 40) -> list[int]:
    """First sizes of the bands; each band is about a quarter wider than the last."""
    edges = [1]
    while edges[-1] < limit:
        edges.append(edges[-1] * 5 // 4 + 1)
    return edges


EDGES = np.array(band_edges(), dtype=np.int64)


def difference_in(band: int, rule: Rule = CONTRACT) -> int:
    """Largest symmetric difference of two linked sets whose larger one is in
    the band: with J >= t it is at most (a + b)(1 - t)/(1 + t)."""
    return difference_limit(2 * (int(EDGES[band + 1]) - 1), 0, rule)


def shared_in(band: int, rule: Rule = CONTRACT) -> int:
    """Parts that linked sets share at least. More than one, so that sets which
    agree in a part by chance are told from linked ones."""
    return 1 + difference_in(band, rule) // 6


def spared_in(band: int, rule: Rule = CONTRACT) -> int:
    """Empty parts that a set may leave out: fewer than linked sets share."""
    return 3 * shared_in(band, rule) // 4


def needed_in(band: int, rule: Rule = CONTRACT) -> int:
    """Keys that linked sets have in common at least, empty parts left out."""
    return shared_in(band, rule) - spared_in(band, rule)


def parts_of(band: int, rule: Rule = CONTRACT) -> int:
    """Each differing shingle spoils one part, so ``shared_in`` parts are left."""
    return difference_in(band, rule) + shared_in(band, rule)


def own_band(n: int) -> int:
    return max(0, int(np.searchsorted(EDGES, n, "right")) - 1)


def bands_of(n: int, rule: Rule = CONTRACT) -> list[int]:
    """Bands in which a set of n shingles is looked up: its own, and the next
    one if a linked larger set can be there. Linked sets share a band."""
    own = own_band(n)
    bands = [own, own + 1] if rule.den * n >= rule.num * int(EDGES[own + 1]) else [own]
    return [b for b in bands if difference_in(b, rule)]  # no difference: equal sets, found by digest


def sketch(s: np.ndarray, words: int) -> np.ndarray:
    """Parity sketch of ``words`` 64-bit words: every shingle flips one bit, so
    the Hamming distance of two sketches is at most the symmetric difference."""
    h = mix(s ^ _MIX[2])
    # multiply-shift maps the upper half to a word, the lowest six bits to a bit
    word = ((h >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    flips = np.bincount((word << np.uint64(6) | h & np.uint64(63)).astype(np.int64), minlength=64 * words)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.uint64)


def band_sketch(s: np.ndarray, band: int, rule: Rule = CONTRACT) -> np.ndarray:
    """The set's bit sketch for a band: 32 bits a part."""
    return sketch(s, max(2, (parts_of(band, rule) + 1) // 2))


def part_keys(s: np.ndarray, band: int, rule: Rule = CONTRACT) -> np.ndarray:
    """The XOR of the shingles' 32-bit hashes in each part; 0: no key.

    A part that two sets share has one value in both. Empty parts are equal in
    sets that have nothing in common, so a set with few of them leaves them
    out: linked sets share ``shared_in`` parts, of which one of them leaves out
    at most ``spared_in``. A set with more empty parts keeps them, as 1."""
    parts = parts_of(band, rule)
    h = mix(s ^ _MIX[1])
    part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    part, value = part[order], h[order].astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    out = np.zeros(parts, np.uint32)
    out[part[first].astype(np.int64)] = np.bitwise_xor.reduceat(value, first)
    if np.count_nonzero(out == 0) > spared_in(band, rule):
        out[out == 0] = 1
    return out.view(np.int32)
