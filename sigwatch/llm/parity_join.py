"""n-gram Jaccard join by parity sketches.

Every text becomes its set of word shingles (64-bit hashes). A set's parity
sketch is a bit vector in which each shingle flips one bit: the Hamming
distance of two sketches never exceeds the symmetric difference of the sets.
A hash deals the shingles of a size band's set into parts, and a part's key is
the XOR of its shingles' hashes. Linked sets of a band differ in fewer shingles
than there are parts, so by the pigeonhole principle they agree in
``shared_in`` parts or more, and joining on (band, part number, key) loses no
link. A part holds few shingles where the similarity is low, and would often
agree by chance in a few bits; the keys do not, apart from empty parts, which
are left out wherever the other shared parts suffice.

1. Equal sets are linked by a 128-bit digest (a partial aggregate).
2. Documents that share a key are linked to the key's smallest document where
   the sets, recomputed from the texts, are similar enough: each document is
   tried with the smallest document of most of its keys. Verified links are
   joined to components.
3. Only keys whose documents are in different components are left, and of their
   documents those that have as many such keys as linked sets share. Pairs
   are compared sketch against sketch in numpy, in blocks of bounded size; no
   pair is a row unless the Hamming distance admits the link. Those pairs are
   verified on the texts as well.

So every pair that shares a key is either in one component already or has been
compared: the components are those of the full join.

Defined results: null, empty and blank texts have the empty set and link with
nothing; rows that repeat a document give one row each, in one component;
documents with a null id are linked with nothing (component null); extra
columns are ignored, or kept by ``keep_representatives``.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_batch, staged, start
from .components import components
from .shingles import (CONTRACT, EDGES, Rule, band_sketch, bands_of, difference_limit, linked, needed_in, own_band, part_keys,
                       shared_in, shingle_set, shingle_sets)

#: Bits of the filter that spares texts without a candidate the shuffle.
FILTER_BITS = 1 << 23
#: Documents per block of a key's members, and members per group of a verification.
BLOCK = 1024
GROUP = 256

_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("band", pa.int64())]
_SETS_SQL = ("doc_id long, n long, hi long, lo long, band long, own array<int>, next array<int>, "
             "own_sketch array<long>, next_sketch array<long>")


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    bounds = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    flat = np.concatenate(arrays).view(kind) if arrays else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def sketched(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """doc_id, set size n, 128-bit digest of the set (hi, lo), size band, its
    part keys and bit sketch for the band (own) and, if a linked set can be
    there, for the next one (next). Of equal sets in one task only the first
    has them: the digest links equal sets, so a group of copies costs one per task."""

    def scan(batches):
        seen: set[bytes] = set()
        none = np.empty(0, np.int32), np.empty(0, np.uint64)
        for batch in batches:
            rows, made = [], {0: [], 1: []}
            for doc_id, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), rule.words)):
                digest = blake2b(s.tobytes(), digest_size=16).digest()
                hi, lo = np.frombuffer(digest, "<i8").tolist()
                band = own_band(len(s))
                rows.append((doc_id, len(s), hi, lo, band))
                bands = bands_of(len(s), rule) if len(s) and doc_id is not None and digest not in seen else []
                seen.add(digest)
                for up, parts in made.items():
                    parts.append((part_keys(s, band + up, rule), band_sketch(s, band + up, rule)) if band + up in bands else none)
            lists = [_lists([m[k] for m in made[up]], kind) for k, kind in ((0, np.int32), (1, np.int64)) for up in made]
            yield pa.RecordBatch.from_arrays([*as_batch(rows, _HEAD).columns, *lists],
                                             [*(n for n, _ in _HEAD), "own", "next", "own_sketch", "next_sketch"])

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return df.mapInArrow(scan, _SETS_SQL)


def keyed(sets: DataFrame) -> DataFrame:
    """(key, doc_id): one key per band and part. The key's lowest bit is the
    band's, which tells the two bands of a document apart."""
    parts = lambda values, band: F.filter(F.transform(values, lambda x, i: F.when(
        x != 0, F.xxhash64(band, i, x).bitwiseAND(F.lit(-2)).bitwiseOR(band.bitwiseAND(F.lit(1))))), lambda k: k.isNotNull())
    keys = F.concat(parts(F.col("own"), F.col("band")), parts(F.col("next"), F.col("band") + 1))
    return sets.select("doc_id", F.explode(keys).alias("key")).select("key", "doc_id")


_STAR = [("key", pa.int64()), ("pivot", pa.int64()), ("doc_id", pa.int64())]
_STAR_SQL = "key long, pivot long, doc_id long"


def stars(keys: DataFrame) -> DataFrame:
    """From (key, doc_id): per key that several documents share, each but the
    smallest with the smallest (the pivot). One shuffle and a sort; a key's
    rows are streamed, only the last key and pivot are held."""

    def star(batches):
        key = pivot = None
        for batch in batches:
            k, d = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(k):
                continue
            new = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
            p = np.where(first >= 0, d[np.maximum(first, 0)], pivot if pivot is not None else 0)
            key, pivot = k[-1], p[-1]
            keep = p != d
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (k, p, d)], [n for n, _ in _STAR])

    return keys.repartition("key").sortWithinPartitions("key", "doc_id").mapInArrow(star, _STAR_SQL)


# ---- verification on the texts ------------------------------------------------

def _candidate_texts(docs: DataFrame, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text) of the wanted documents and few others: a bit filter of
    fixed size (one hash; at most ``bits`` / 64 rows reach the driver) goes to
    the scan, so texts without a candidate are not shuffled. A filter that is
    too small lets more texts through and loses none."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    words = (ids.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("m")).collect())
    table = np.zeros(bits // 64, np.int64)
    for w, m in words:
        table[w] = m
    flags = docs.sparkSession.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little"))

    def keep(batches):
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            yield batch.select(["doc_id", "text"]).filter(pa.array(flags.value[at].astype(bool)))

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where("doc_id is not null").select("doc_id", "text", place.alias("p")))
    return rows.mapInArrow(keep, "doc_id long, text string")


def verified(docs: DataFrame, pairs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """Of (u, v) pairs the linked ones. Pairs are grouped by u; a u with many
    partners is split into groups of about ``GROUP``, each with a copy of u's
    text. A group's rows are streamed, one set is held."""
    pairs = staged(pairs.select("u", "v").distinct(), "pairs")
    ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v"))
    texts = _candidate_texts(docs, ids)
    sizes = pairs.groupBy("u").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    members = (pairs.join(sizes, "u").select("u", F.pmod(F.xxhash64("v"), F.col("groups")).alias("g"), F.col("v").alias("doc_id"),
                                             F.lit(1).alias("role")))
    heads = sizes.select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g"),
                         F.col("u").alias("doc_id"), F.lit(0).alias("role"))
    rows = members.union(heads).join(texts, "doc_id").select("u", "g", "role", "doc_id", "text")

    def check(batches):
        now, held = None, None
        for batch in batches:
            out = []
            for u, g, role, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if role == 0:
                    if (u, g) != now:
                        now, held = (u, g), shingle_set(text, rule.words)
                elif (u, g) == now and linked(held, shingle_set(text, rule.words), rule):
                    out.append((u, doc_id))
            yield as_batch(out, [("u", pa.int64()), ("v", pa.int64())])

    return staged(rows.repartition("u", "g").sortWithinPartitions("u", "g", "role").mapInArrow(check, "u long, v long"), "links")


# ---- what the first links leave open ------------------------------------------

def _blocks(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """From (key, node, component): (key, p, q, mine, node, component). Of keys
    with equal members one is left. A key's members are dealt into blocks of
    about ``block`` by a hash; every pair of blocks (p, q) is one group."""
    sizes = (members.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                        F.bit_xor(F.xxhash64(F.lit(1), F.col("node"))).alias("y"))
             .groupBy("n", "x", "y").agg(F.min("key").alias("key"))
             .select("key", F.ceil(F.col("n") / block).alias("blocks")))
    return (members.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"),
                    "mine", "node", "component"))


def _block_pairs(rows: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """From the groups' rows with sizes and sketches (n, words): the (u, v) of
    different components whose sizes and sketches admit a link."""

    def admitted(group):
        _, p, q, mine, node, component, n, words = (np.array(c) for c in zip(*group))
        sketch = np.stack([np.asarray(w, np.int64).view(np.uint64) for w in words]) if len(words) else words
        left = np.flatnonzero(mine == p[0])
        right = left if p[0] == q[0] else np.flatnonzero(mine == q[0])
        for i in left:
            other = right[right > i] if p[0] == q[0] else right
            other = other[(component[other] != component[i])
                          & (rule.den * np.minimum(n[other], n[i]) >= rule.num * np.maximum(n[other], n[i]))]
            if len(other):
                distance = np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64)
                for j in other[distance <= difference_limit(n[other], n[i], rule)]:
                    yield int(min(node[i], node[j])), int(max(node[i], node[j]))

    def compare(batches):
        now, group = None, []
        for batch in batches:
            out = []
            for row in zip(*([*c.to_pylist()] if c.type != pa.list_(pa.int64()) else [x.values.to_numpy() for x in c]
                             for c in batch.columns)):
                if row[:3] != now:
                    if group:
                        out += admitted(group)
                    now, group = row[:3], []
                group.append(row)
            yield as_batch(out, [("u", pa.int64()), ("v", pa.int64())])
        if group:
            yield as_batch(list(admitted(group)), [("u", pa.int64()), ("v", pa.int64())])

    return (rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
            .mapInArrow(compare, "u long, v long").distinct())


def _per_band(count, band: Column, rule: Rule) -> Column:
    """A number of parts of each band (``shared_in``, ``needed_in``)."""
    return F.element_at(F.array(*(F.lit(count(b, rule)) for b in range(len(EDGES) - 1))), (band + 1).cast("int"))


def _open(members: DataFrame, holder: DataFrame, rule: Rule) -> DataFrame:
    """The (key, node, component) that can still hold a link: keys of several
    components, and nodes with at least as many of them, in one band, as
    linked sets have in common."""
    span = members.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    mixed = members.join(span.where("a <> b").select("key"), "key", "left_semi").withColumn("odd", F.col("key").bitwiseAND(F.lit(1)))
    enough = (mixed.groupBy("node", "odd").agg(F.count("*").alias("keys")).join(holder.select("node", "band"), "node")
              .where(F.col("keys") >= _per_band(needed_in, F.col("band") + F.when(F.col("odd") == F.col("band").bitwiseAND(F.lit(1)), 0).otherwise(1), rule))
              .select("node", "odd"))
    return mixed.join(enough, ["node", "odd"], "left_semi").select("key", "node", "component")


def _labelled(df: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Adds the component of a node; a node without links is its own."""
    label = labels.select(F.col("node").alias(node), F.col("component").alias("_c"))
    return df.join(label, node, "left").withColumn(name, F.coalesce("_c", node)).drop("_c")


def classes(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links)."""
    if 5 * rule.num < 4 * rule.den or rule.num >= rule.den:
        raise ValueError("the size bands hold similarities from 0.8 to below 1")
    start(docs.sparkSession)
    sets = staged(sketched(docs, rule), "sketches")
    linkable = sets.where("n > 0 and doc_id is not null")
    equal = staged(linkable.groupBy("hi", "lo").agg(F.min("doc_id").alias("node")), "equal-sets")
    # one row per document that has sketches, with the node of its set
    held = linkable.where("size(own) + size(next) > 0")
    nodes = staged(held.select("doc_id", "hi", "lo", "band").join(equal, ["hi", "lo"])
                   .groupBy("doc_id").agg(F.min("node").alias("node"), F.min("band").alias("band")), "nodes")
    star = stars(keyed(sets))
    star = (star.join(nodes.select("doc_id", F.col("node").alias("v"), "band"), "doc_id")
            .join(nodes.select(F.col("doc_id").alias("pivot"), F.col("node").alias("u")), "pivot")
            .where("u <> v").select("key", "u", "v", "band"))
    star = staged(star, "stars")

    # half of what linked sets share: a document's keys may have several pivots
    shared = (star.groupBy("u", "v").agg(F.count("*").alias("keys"), F.min("band").alias("band"))
              .where(2 * F.col("keys") >= _per_band(shared_in, F.col("band"), rule)))
    best = shared.groupBy("v").agg(F.max_by("u", F.struct("keys", -F.col("u"))).alias("u"))
    first = verified(docs, best, rule)
    labels = components(first)

    marked = _labelled(_labelled(star, labels, "u", "cu"), labels, "v", "cv")
    members = (marked.select("key", F.col("u").alias("node"), F.col("cu").alias("component"))
               .union(marked.select("key", "v", "cv")).distinct())
    holder = staged(nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("band").alias("band")), "holders")
    for _ in range(2):  # fewer keys leave documents with too few, and so on
        members = staged(_open(members, holder, rule), "open")
    own = F.col("key").bitwiseAND(F.lit(1)) == F.col("band").bitwiseAND(F.lit(1))
    rows = (_blocks(members).join(holder.select("node", "doc_id"), "node")
            .join(held.select("doc_id", "n", "band", "own_sketch", "next_sketch"), "doc_id")
            .select("key", "p", "q", "mine", "node", "component", "n", F.when(own, F.col("own_sketch")).otherwise(F.col("next_sketch")).alias("words")))
    second = verified(docs, _block_pairs(rows, rule), rule)
    labels = components(first.union(second))
    classed = _labelled(equal, labels, "node", "component_id").select("hi", "lo", "component_id")
    return (sets.select("doc_id", F.col("n").alias("n_shingles"), "hi", "lo").join(classed, ["hi", "lo"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def keep_representatives(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its
    columns. Rows that repeat an id become one; documents with a null id stay.

    Only ids are classed and counted; the texts are filtered by two small
    tables of ids, which the planner broadcasts or shuffles by their size."""
    key = "_id"
    while key in docs.columns:
        key += "_"
    found = staged(classes(docs, rule).select("doc_id", "component_id"), "classes")
    gone = staged(found.where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct(), "gone")
    repeated = staged(found.where("component_id = doc_id").groupBy(F.col("doc_id").alias(key)).count()
                      .where("count > 1").select(key), "repeated")
    same = F.col("doc_id").cast("long") == F.col(key)
    once = docs.join(gone.union(repeated), same, "left_anti")
    return once.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id"]))
