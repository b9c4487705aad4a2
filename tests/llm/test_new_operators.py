"""Boosted trees, conversation repair and periodic runs against brute force."""

import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


# ---- op13 -----------------------------------------------------------------------

def plain_lyndon(s):
    def lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))
    return [max(j - i for j in range(i + 1, len(s) + 1) if lyndon(s[i:j])) for i in range(len(s))]


def plain_runs(s, least=6, exponent=4):
    out, n = [], len(s)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and s[j] == s[j + p]:
                j += 1
            size = j - i + p
            if j > i and size >= max(least, exponent * p, 2 * p):
                w = s[i:i + size]
                if not any(w[q:] == w[:-q] for q in range(1, p)):
                    out.append((i, size, p))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_groups_give_the_lyndon_array_under_both_orders():
    from sigwatch.llm.periodic_runs import lyndon_groups
    rng = random.Random(1)
    for _ in range(800):
        k = rng.randint(1, 4)
        s = [rng.randint(1, k) for _ in range(rng.randint(0, 22))]
        for t in (s, [k + 1 - x for x in s]):
            length, group = lyndon_groups(np.array(t, np.int64))
            assert length.tolist() == plain_lyndon(t)
            for i in range(len(t)):
                for j in range(len(t)):
                    same = t[i:i + length[i]] == t[j:j + length[j]]
                    assert (group[i] == group[j]) == same


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (3, 3), (4, 2)])
def test_runs_equal_brute_force(least, exponent):
    from sigwatch.llm.periodic_runs import runs_of
    rng, texts = random.Random(2), []
    for _ in range(700):
        n, k = rng.randint(0, 60), rng.randint(1, 6)
        s = [rng.randint(1, k) for _ in range(n)]
        if n and rng.random() < 0.5:
            p, a = rng.randint(1, 9), rng.randint(0, n - 1)
            for i in range(a + p, rng.randint(a, n)):
                s[i] = s[i - p]
        texts.append(s)
    got = runs_of([np.array(s, np.int64) for s in texts], least, exponent)
    assert got == [plain_runs(s, least, exponent) for s in texts]


def test_long_periodic_texts():
    from sigwatch.llm.periodic_runs import runs_of
    n = 60_000
    i = np.arange(n)
    assert runs_of([np.ones(n, np.int64)]) == [[(0, n, 1)]]
    assert runs_of([i % 15_000 + 1]) == [[(0, n, 15_000)]]
    assert runs_of([i + 1]) == [[]]


def plain_report(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    gone = {i for a, size, q in runs for i in range(a + q, a + size)}
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha256("".join(f"{a},{s},{q}\n" for a, s, q in runs).encode()).hexdigest(),
            sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_registered_runs_equal_brute_force(spark):
    from sigwatch.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 6000").select("doc_id", "text").collect()
    got = {r[0]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    want = [plain_report(*r) for r in docs]
    assert len(want) > 150 and sum(r[1] > 0 for r in want) > 8
    for r in want:
        assert got[r[0]] == r


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 20000), (5, "x a b a b a b a b y"), (6, "x a b a b a b a b y"),
       (5, "x a b a b a b a b y"), (None, "b b b b b b"), (7, "é é é é é é ç"), (8, "a a a a a a")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns(
        {"n": F.lit(1), "removed": F.lit("x"), "runs": F.lit(None).cast("int"), "stats": F.lit(2), "label": F.lit(3),
         "key": F.lit("k")})


def test_runs_of_odd_rows(odd):
    from sigwatch.llm.periodic_runs import collapsed, periodic_runs, planted, run_report
    got = [tuple(r)[:1] + tuple(r)[2:] for r in run_report(odd, change=planted).collect()]
    assert sorted(got, key=str) == sorted((plain_report(*r) for r in ODD), key=str)
    rows = {(r["doc_id"], r["first_word"], r["n_words"], r["period"], r["start"], r["end"], r["root"])
            for r in periodic_runs(odd).collect()}
    assert (5, 1, 8, 2, 2, 17, "a b") in rows and (7, 0, 6, 1, 0, 11, "é") in rows and len(rows) == 5
    cut = {r["doc_id"]: (r["text"], r["removed_"]) for r in collapsed(odd).collect()}
    assert cut[5] == ("x a b y", [(6, 18)]) and cut[1] == (None, None) and cut[4][0] == "a  "[:len(cut[4][0])]
    assert run_report(odd.where("false")).count() == periodic_runs(odd.where("false")).count() == 0
    assert collapsed(odd.where("false")).count() == 0


# ---- op12 -----------------------------------------------------------------------

NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def kept_state(q, c):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((q, c))


def plain_audit(rows):
    """rows: (role initial, fault); least (cost, audit)."""
    @lru_cache(None)
    def best(i, q, inserts):
        found = [(0, "")] if i == len(rows) and q in (0, 3) else []

        def add(cost, letter, rest):
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1]))
        if inserts < 2:
            add(3, "I", best(i, NEXT[q][0], inserts + 1))
        if i < len(rows):
            c, fault = rows[i]
            add(4, "D", best(i + 1, q, 0))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                add(3 + more, "R", best(i + 1, NEXT[q][0], 0))
                if kept_state(q, c) is not None:
                    add(more, "K", best(i + 1, kept_state(q, c), 0))
        return min(found, default=None)
    return best(0, 0, 0)


def plain_conversation(rows):
    """rows after damage: (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = plain_audit(tuple(zip(initials, faults)))
    lines, q, i = [], 0, 0
    for e in audit:
        if e == "I":
            lines.append(NEXT[q][1] + ":")
            q = NEXT[q][0]
            continue
        _, role, text = rows[i]
        i += 1
        if e == "K":
            lines.append(f"{role}:{text}")
            q = kept_state(q, role[:1])
        elif e == "R":
            lines.append(f"{NEXT[q][1]}:{text}")
            q = NEXT[q][0]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        here += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return {conv: plain_conversation(x) for conv, x in out.items()}


def test_audits_equal_brute_force_in_blocks_of_any_size():
    from sigwatch.llm.chat_repair import solved
    rng = random.Random(3)
    kinds = ["", "", "", "blank", "duplicate", "truncated"]
    convs = [tuple((rng.choice("suuaao"), rng.choice(kinds)) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    code = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    symbols = [np.array([4 * "suao".index(c) + code[f] for c, f in x], np.int64) for x in convs]
    want = [plain_audit(x) for x in convs]
    assert solved(symbols) == want
    assert solved(symbols[:300], block=3) == want[:300]
    long = np.random.default_rng(0).integers(0, 16, 20_000)
    assert solved([long], block=1 << 15) == solved([long], block=700)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_repairs_equal_brute_force(spark, sf):
    from sigwatch.llm.queries import QUERIES
    d = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_chat_repair"](spark, d).collect()}
    assert got == plain_damage(rows)


def odd_conversations():
    rng = random.Random(4)
    rows = [(None, 1, "user", "hi."), (None, None, "assistant", None), (None, 2, None, "x."), (1, None, "user", "a."),
            (1, None, "user", "a."), (1, 3, "", "b."), (2, 5, "system", "s."), (3, 0, "user", ""), (4, 1, "User", "q?"),
            (4, 2, "assistant", "é" * 50000 + "!")]
    rows += [(5, t % 40, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", " \t", "d? \n"]))
             for t in range(200)]
    rows += [(k, 0, "user", "x.") for k in range(100, 160)]
    return rows


def test_odd_conversations(spark):
    from sigwatch.llm.chat_repair import as_rows, damaged, repair_report, repaired
    rows = odd_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"place": F.lit("x"), "gone": F.lit("y"), "symbol": F.lit(1), "_conv": F.lit(2), "digest": F.lit(3)})
    got = {r[0]: tuple(r)[1:] for r in repair_report(damaged(df)).collect()}
    assert got == plain_damage(rows)
    whole = {}
    for r in sorted(repaired(as_rows(df)).collect(), key=lambda r: (str(r["conv_id"]), r["line"])):
        whole.setdefault(r["conv_id"], []).append(r["role"])
    for roles in whole.values():
        assert re.fullmatch("s?(ua)+", "".join(x[0] for x in roles))
    none = df.where("false")
    assert repair_report(damaged(none)).count() == repaired(as_rows(none)).count() == 0


def test_a_conversation_spread_over_many_chunks(spark):
    """One conversation holds nearly all rows; its strings come in order from many chunks and partitions."""
    from sigwatch.llm import chat_repair as R
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t}." if t % 7 else f"text {t}") for t in range(15_000)]
    rows += [(k, 0, "user", "x.") for k in range(2, 40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    got = {r[0]: tuple(r)[1:] for r in R.repair_report(R.as_rows(df)).collect()}
    want = R.solved([np.array([4 * (1, 2)[t % 2] + (0 if t % 7 else 3) for t in range(15_000)], np.int64)])[0]
    assert got[1][5:7] == want and got[1][:5] == (0, 0, 0, 2143, 0)
    assert len(got) == 39


# ---- op11 -----------------------------------------------------------------------

def test_flat_trees_equal_a_plain_walk():
    from sigwatch.llm.boosted_quality import margins, train
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4)).round(2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    forest = train(x, y)

    def walk(row):
        total = forest.prior
        for at in forest.roots:
            while forest.split[at] >= 0:
                at = forest.child[at] + (row[forest.split[at]] > forest.threshold[at])
            total += forest.value[at]
        return total
    assert np.allclose(margins(forest, x), [walk(r) for r in x])
    assert ((margins(forest, x) > 0) == (y > 0.5)).mean() > 0.95


def test_first_split_equals_brute_force():
    from sigwatch.llm.boosted_quality import LEAST, RIDGE, train
    rng = np.random.default_rng(6)
    for _ in range(20):
        x = rng.integers(0, 12, (200, 3)).astype(float)
        y = (x[:, int(rng.integers(3))] + rng.normal(0, 3, 200) > 6).astype(float)
        forest = train(x, y, trees=1, depth=1)
        p = 1 / (1 + np.exp(-forest.prior))
        g, h, best = p - y, np.full(200, p * (1 - p)), (0.0, None, None)
        for k in range(3):
            for v in sorted(set(x[:, k]))[:-1]:
                left = x[:, k] <= v
                if min(h[left].sum(), h[~left].sum()) < LEAST:
                    continue
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + RIDGE) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + RIDGE)
                if gain > best[0] + 1e-9:
                    best = (gain, k, v)
        assert forest.split[0] == best[1]
        assert ((x[:, best[1]] <= best[2]) == (x[:, best[1]] <= forest.threshold[0])).all()


def test_quality_of_held_out_documents(spark):
    from sigwatch.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    label = dict(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality").collect())
    got = QUERIES["op11_boosted_quality"](spark, d).collect()
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    right = [r["predicted"] == label[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in label]
    assert len(right) > 100 and np.mean(right) > 0.95


def test_scores_do_not_read_held_out_labels(spark):
    from sigwatch.llm.boosted_quality import fold, scored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(fold(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(scored(docs, labels)) == key(scored(docs.drop("lang", "source"), turned))


def test_scores_of_odd_rows(spark, odd):
    from sigwatch.llm.boosted_quality import scored, training_rows, document_statistics
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (5, 0), (6, None), (None, 1), (7, 5)], "doc_id long, quality int")
    got = scored(odd, labels.withColumn("label", F.lit("x"))).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in scored(odd, labels.where("false")).collect()} == {0.5}
    assert scored(odd.where("false"), labels).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    rows = training_rows(document_statistics(many), many.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")), 200)
    assert rows.count() == 200
