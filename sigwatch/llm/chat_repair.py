"""Conversation structure repair: the cheapest edits that give the roles
``(s?(ua)+)?`` (an optional system turn, then user and assistant in turn).

A conversation becomes a string with one symbol a row (role initial and first
fault). Nodes of the edit graph are pairs of a row and a state (nothing yet,
after system, after user, after assistant); arcs are the edits Delete, Insert,
Keep and Rerole. Costs to the end come from a suffix scan of (min, +) matrices.
Of the optimal arcs, those that start at one node have different letters. Arcs
are ranked by the first 1, 2, 4, ... letters of the audit they begin: the rank
for twice as many letters is that of the pair (own rank, rank of the arc that
a pointer over so many letters leads to), and pointers double with the ranks.
Each node follows its least arc, so the path from the first node is the ASCII
least audit; it is read off by filling 1, 2, 4, ... steps through the pointers.

In Spark: rows are range-sorted by (conversation, turn, role, text), so one
conversation may spread over many tasks, and are written once with their place
in the order. Repeated rows are found by digest, with a partial aggregate.
Symbols are put together by chunks of places and then by conversation: one
byte a row, as the audit itself. Long conversations are solved in blocks. Only
the SHA-256 of the repaired text, which has to be taken in order, streams a
conversation's rows through one task, with no more than a batch in memory.

Defined results: rows of a turn are ordered by role, then text (code points,
nulls as given below); equal rows stay side by side, and a later one is a
duplicate. Rows without conv_id are one conversation. Null role and text are
one space (also in the contract's damage), null turns come first and do not
count in ``gaps``. A role that does not begin with s, u or a, the empty one
included, cannot be kept. An empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_batch, staged, start

# Costs of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Symbols: 4 * role initial (s, u, a, other) + fault (none, blank, duplicate, truncated).
_S, _U, _A, _OTHER = range(4)
_FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
#: State after a user or assistant turn is put in, by state: the turn is
#: the one that the grammar wants next.
_NEXT = [2, 2, 3, 2]
_WANTED = ["user", "user", "assistant", "user"]
#: State after a kept row, by (state, role initial); -1: not allowed there.
_KEPT = [[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]]
_FAR = 1 << 40

#: Rows solved together; a longer conversation takes several blocks.
BLOCK = 1 << 14
#: Places a chunk.
CHUNK = 4096


def _weights() -> tuple[np.ndarray, np.ndarray]:
    """(min, +) matrices: of one row by symbol, and of inserts alone."""
    rows = np.full((16, 4, 4), _FAR, np.int64)
    for symbol in range(16):
        role, fault = divmod(symbol, 4)
        more = TRUNCATED if fault == _TRUNCATED else 0
        for q in range(4):
            rows[symbol, q, q] = DELETE
            if fault in (_FINE, _TRUNCATED):
                rows[symbol, q, _NEXT[q]] = min(rows[symbol, q, _NEXT[q]], REROLE + more)
                if _KEPT[q][role] >= 0:
                    rows[symbol, q, _KEPT[q][role]] = min(rows[symbol, q, _KEPT[q][role]], more)
    inserts = np.full((4, 4), _FAR, np.int64)
    for q in range(4):
        inserts[q, q], one = 0, _NEXT[q]
        inserts[q, one], inserts[q, _NEXT[one]] = INSERT, min(inserts[q, _NEXT[one]], 2 * INSERT)
    return rows, inserts


_ROWS, _INSERTS = _weights()
#: Cost of ending in a state: nothing at all, or after an assistant turn.
_END = np.array([0, _FAR, _FAR, 0], np.int64)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) products of stacks of matrices."""
    return (a[..., :, :, None] + b[..., None, :, :]).min(axis=-2)


def costs_to_end(symbols: np.ndarray, sizes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Least cost from each node to the end. Blocks of ``sizes`` rows lie end
    to end; ``after`` has the costs of the four states behind each block. The
    result has size + 1 rows of four states a block."""
    step = _times(_INSERTS, _ROWS)[symbols]
    ends = np.repeat(np.cumsum(sizes), sizes)
    n, reach = len(symbols), 1
    while reach < (sizes.max() if len(sizes) else 0):
        i = np.flatnonzero(np.arange(n) + reach < ends)
        step[i] = _times(step[i], step[i + reach])
        reach *= 2
    block = np.repeat(np.arange(len(sizes)), sizes)
    out = np.empty((n + len(sizes), 4), np.int64)
    out[np.arange(n) + block] = (step + after[block][:, None, :]).min(axis=-1)
    out[np.cumsum(sizes) + np.arange(len(sizes))] = after
    return np.minimum(out, _FAR)


def optimal_arcs(symbols: np.ndarray, sizes: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, ...]:
    """(from node, letter, to node) of all optimal arcs, a node being 4 * its
    row of ``cost`` + state; sorted by node and letter. A block's last row of
    nodes has no arcs that take a row, only inserts."""
    block = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(symbols)) + block  # cost row of each conversation row
    role, fault = np.divmod(symbols, 4)
    stays = (fault == _FINE) | (fault == _TRUNCATED)
    more = np.where(fault == _TRUNCATED, TRUNCATED, 0)
    kept = np.array(_KEPT)
    parts = []

    def arcs(rows, q, letter, weight, to_rows, to_state):
        good = (cost[rows, q] < _FAR) & (weight + cost[to_rows, to_state] == cost[rows, q])
        parts.append((4 * rows[good] + q, np.full(int(good.sum()), ord(letter)), (4 * to_rows + to_state)[good]))

    every = np.arange(len(cost))
    for q in range(4):
        arcs(at, q, "D", DELETE, at + 1, np.full(len(at), q))
        arcs(every, q, "I", INSERT, every, np.full(len(every), _NEXT[q]))
        to = kept[q][role]
        ok = stays & (to >= 0)
        arcs(at[ok], q, "K", more[ok], at[ok] + 1, to[ok])
        arcs(at[stays], q, "R", REROLE + more[stays], at[stays] + 1, np.full(int(stays.sum()), _NEXT[q]))
    source, letter, target = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((letter, source))
    return source[order], letter[order], target[order]


def least_paths(arcs: tuple[np.ndarray, ...], n_nodes: int, starts: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Per start node the letters of its least path and the node it ends at.

    Ranks by 1, 2, 4, ... letters: at each length the least arc of a node is
    the one of least rank. The arc numbered len(source) is the end of a path,
    of rank 0, and its own successor."""
    source, letter, target = arcs
    end = len(source)
    rank = np.r_[letter, 0]
    while True:
        # the least arc of each node that has any
        order = np.lexsort((rank[:-1], source))
        head = np.r_[True, source[order][1:] != source[order][:-1]] if end else np.empty(0, bool)
        least = np.full(n_nodes, end)
        least[source[order[head]]] = order[head]
        follow = np.r_[least[target], end]
        if end == 0:
            break
        pointers, ranks = [follow], rank
        while not (pointers[-1] == end).all():
            _, ranks = np.unique(ranks * (int(ranks.max()) + 1) + ranks[pointers[-1]], return_inverse=True)
            pointers.append(pointers[-1][pointers[-1]])
        # ranks by whole audits now: done when they leave every node its arc
        order = np.lexsort((ranks[:-1], source))
        head = np.r_[True, source[order][1:] != source[order][:-1]]
        again = np.full(n_nodes, end)
        again[source[order[head]]] = order[head]
        if (again == least).all():
            break
        rank = ranks
    out = []
    if end == 0:
        return [(np.empty(0, np.int64), int(s)) for s in starts]
    # all paths at once: step t + 2^k of a path is 2^k arcs behind its step t
    steps = [least[starts]]
    for jump in pointers:
        steps += [jump[s] for s in steps]
        if (steps[-1] == end).all():
            break
    table = np.array(steps)
    for k, s in enumerate(starts):
        path = table[:, k]
        path = path[path < end]
        out.append((letter[path], int(target[path[-1]]) if len(path) else int(s)))
    return out


def solved(conversations: list[np.ndarray], block: int = BLOCK) -> list[tuple[int, str]]:
    """Cost and audit of conversations given as symbols."""
    out: list[tuple[int, str]] = [(0, "")] * len(conversations)
    group: list[int] = []
    rows = 0

    def close():
        sizes = np.array([len(conversations[k]) for k in group], np.int64)
        symbols = np.concatenate([conversations[k] for k in group])
        after = np.repeat((_INSERTS + _END).min(axis=1)[None], len(group), axis=0)
        cost = costs_to_end(symbols, sizes, after)
        starts = np.cumsum(np.r_[0, sizes[:-1] + 1])
        paths = least_paths(optimal_arcs(symbols, sizes, cost), 4 * len(cost), 4 * starts)
        for k, first, (letters, _) in zip(group, starts, paths):
            out[k] = (int(cost[first, 0]), letters.astype(np.uint8).tobytes().decode())

    # conversations of like length share a table of paths
    for k in sorted(range(len(conversations)), key=lambda k: len(conversations[k])):
        n = len(conversations[k])
        if n > block:
            out[k] = _solved_in_blocks(conversations[k], block)
        elif n:
            if group and rows + n > block:
                close()
                group, rows = [], 0
            group.append(k)
            rows += n
    if group:
        close()
    return out


def _solved_in_blocks(symbols: np.ndarray, block: int) -> tuple[int, str]:
    """One long conversation: costs behind each block from the last to the
    first, then each block's part of the path from the first to the last."""
    cuts = list(range(0, len(symbols), block))
    after = [(_INSERTS + _END).min(axis=1)]
    for a in reversed(cuts[1:]):
        part = symbols[a:a + block]
        after.append(costs_to_end(part, np.array([len(part)]), after[-1][None])[0])
    after.reverse()
    state, audit, total = 0, [], None
    for a, behind in zip(cuts, after):
        part = symbols[a:a + block]
        sizes = np.array([len(part)])
        cost = costs_to_end(part, sizes, behind[None])
        total = int(cost[0, 0]) if total is None else total
        source, letter, target = optimal_arcs(part, sizes, cost)
        inside = source < 4 * len(part)  # inserts behind the last row belong to the next block
        if a == cuts[-1]:
            inside[:] = True
        [(letters, node)] = least_paths((source[inside], letter[inside], target[inside]), 4 * len(cost), np.array([state]))
        audit.append(letters.astype(np.uint8).tobytes().decode())
        state = node % 4
    return total, "".join(audit)


# ---- the contract's damage ------------------------------------------------------

def _space(c: str, kind: str = "string") -> Column:
    return F.coalesce(F.col(c).cast(kind), F.lit(" "))


def as_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone (false) of a table of conversations."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                _space("role").alias("role"), _space("text").alias("text"), F.lit(False).alias("gone"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Fixed rule of the contract: rows are dropped (here: marked ``gone``, so
    that their conversation is not lost), emptied, cut, repeated or given to
    the user by a checksum of their key."""
    rows = as_rows(conversations)
    kind = F.crc32(F.concat_ws(":", _space("conv_id"), _space("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


# ---- on tables ------------------------------------------------------------------

def _placed(rows: DataFrame) -> DataFrame:
    """The rows as a table with ``place``, their rank in (conv_id, turn, role,
    text) with gaps. The range key holds only the beginning of a text."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    key = [*in_order[:3], F.substring("text", 1, 64)]
    # ascending order is also that of the range partitions
    placed = rows.repartitionByRange(n, *key).sortWithinPartitions(*in_order)
    return staged(placed.withColumn("place", F.monotonically_increasing_id()), "conversation-rows")


def _symbols(rows: DataFrame) -> DataFrame:
    """conv_id, place, turn and symbol (-1 for a row that is gone)."""
    bare = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    last = F.substring(bare, -1, 1)
    initial = F.substring("role", 1, 1)
    small = rows.select(
        "conv_id", "place", "turn", "gone",
        F.when(initial == "s", _S).when(initial == "u", _U).when(initial == "a", _A).otherwise(_OTHER).alias("role"),
        F.when(bare == "", _BLANK).when(~last.isin(".", "!", "?"), _TRUNCATED).otherwise(_FINE).alias("fault"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"))
    again = (small.where(~F.col("gone") & (F.col("fault") != _BLANK)).groupBy("conv_id", "digest")
             .agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    fault = F.when((F.col("fault") != _BLANK) & (F.col("place") > F.col("first")), _DUPLICATE).otherwise(F.col("fault"))
    return small.join(again, same, "left").select(
        "conv_id", "place", "turn", F.when(F.col("gone"), -1).otherwise(4 * F.col("role") + fault).alias("symbol"))


def _strings(symbols: DataFrame) -> DataFrame:
    """conv_id, a string of one letter (a to p) a row, and gaps."""
    chunk = F.shiftright("place", int(np.log2(CHUNK)))
    here = F.col("symbol") >= 0
    letters = F.when(here, F.char(F.lit(ord("a")) + F.col("symbol"))).otherwise(F.lit(""))
    pieces = (symbols.groupBy("conv_id", chunk.alias("chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("place", letters.alias("s")))).alias("rows"))
              .select("conv_id", "chunk", F.array_join(F.transform("rows", lambda r: r["s"]), "").alias("s")))
    strings = (pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "s"))).alias("parts"))
               .select("conv_id", F.array_join(F.transform("parts", lambda r: r["s"]), "").alias("s")))
    turns = symbols.groupBy(F.col("conv_id").alias("_conv")).agg(
        F.max(F.when(here, F.col("turn"))).alias("last"), F.min(F.when(here, F.col("turn"))).alias("first"),
        F.count_distinct(F.when(here, F.col("turn"))).alias("turns"))
    gaps = F.coalesce(F.col("last") - F.col("first") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return (strings.join(turns, F.col("conv_id").eqNullSafe(F.col("_conv")))
            .select("conv_id", "s", gaps.alias("gaps")))


_SOLVED = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
           ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
_SOLVED_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of placed rows: faults, cost and audit."""
    legal = {(_S, _U), (_U, _A), (_A, _U)}
    table = np.array([[(a, b) not in legal for b in range(4)] for a in range(4)])

    def scan(batches):
        for batch in batches:
            ids, strings, gaps = (c.to_pylist() for c in batch.columns)
            symbols = [np.frombuffer(s.encode(), np.uint8).astype(np.int64) - ord("a") for s in strings]
            out = []
            for k, gap, x, (cost, audit) in zip(ids, gaps, symbols, solved(symbols)):
                role, fault = np.divmod(x, 4)
                seen = np.bincount(fault, minlength=4).tolist()
                out.append((k, gap, seen[_BLANK], seen[_DUPLICATE], seen[_TRUNCATED],
                            int(table[role[:-1], role[1:]].sum()), cost, audit))
            yield as_batch(out, _SOLVED)

    return _strings(staged(_symbols(rows), "conversation-symbols")).mapInArrow(scan, _SOLVED_SQL)


class _Digest:
    """SHA-256 of a conversation's repaired lines, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.lines, self.hash = audit, 0, 0, 0, sha256()

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._put(_WANTED[self.state], "")
            self.state, self.at = _NEXT[self.state], self.at + 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text)
            self.state = _KEPT[self.state]["sua".index(role[0])]
        elif edit == "R":
            self._put(_WANTED[self.state], text)
            self.state = _NEXT[self.state]

    def done(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def _digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and the digest: each conversation's audit, then its rows in order."""
    heads = found.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"),
                         F.col("audit").alias("text"))
    body = rows.where(~F.col("gone")).select("conv_id", "place", "role", "text")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = heads.union(body).repartition(n, "conv_id").sortWithinPartitions("conv_id", "place")

    def scan(batches):
        key = current = None
        for batch in batches:
            out = []
            for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place < 0:
                    if current is not None:
                        out.append((key, current.done()))
                    key, current = conv_id, _Digest(text)
                else:
                    current.row(role, text)
            yield as_batch(out, [("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
        if current is not None:
            yield as_batch([(key, current.done())], [("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    return dealt.mapInArrow(scan, "conv_id long, repaired_sha256 string")


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``as_rows`` or ``damaged``: conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    start(rows.sparkSession)
    placed = _placed(rows)
    found = staged(audits(placed), "conversation-audits")
    digests = _digests(placed, found).withColumnRenamed("conv_id", "_conv")
    return found.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, line (from 0), edit, role, text and
    the turn of the row it comes from (null: inserted)."""
    start(rows.sparkSession)
    placed = _placed(rows)
    found = audits(placed)
    heads = found.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("long").alias("turn"),
                         F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    body = placed.where(~F.col("gone")).select("conv_id", "place", "turn", "role", "text")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = heads.union(body).repartition(n, "conv_id").sortWithinPartitions("conv_id", "place")
    fields = [("conv_id", pa.int64()), ("line", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
              ("text", pa.string()), ("turn", pa.int64())]

    def scan(batches):
        key, audit, at, state, line = None, "", 0, 0, 0
        for batch in batches:
            out = []

            def inserts():
                nonlocal at, state, line
                while audit[at:at + 1] == "I":
                    out.append((key, line, "I", _WANTED[state], "", None))
                    at, state, line = at + 1, _NEXT[state], line + 1

            for conv_id, place, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place < 0:
                    inserts()
                    key, audit, at, state, line = conv_id, text, 0, 0, 0
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                out.append((key, line, edit, role if edit == "K" else _WANTED[state], text, turn))
                state = _KEPT[state]["sua".index(role[0])] if edit == "K" else _NEXT[state]
                line += 1
            yield as_batch(out, fields)
        out = []
        while audit[at:at + 1] == "I":
            out.append((key, line, "I", _WANTED[state], "", None))
            at, state, line = at + 1, _NEXT[state], line + 1
        if out:
            yield as_batch(out, fields)

    return dealt.mapInArrow(scan, "conv_id long, line long, edit string, role string, text string, turn long")
