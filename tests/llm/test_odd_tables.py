"""Rows that used to crash or get lost: null and shared ids, clashing names, no labels."""

from pyspark.sql import functions as F


def test_items_without_an_id(spark):
    from sigwatch.llm.decontaminate import decontaminate, keep_clean
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x y"), (3, "p q"), (None, "a b c d")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "a b"), (7, "a b"), (None, "c d"), (8, None), (None, "x y")], "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_hit"], r["n_items"], r["items_sha256"]) for r in decontaminate(docs, bench).collect())
    import hashlib
    seven, none = hashlib.sha256(b"7").hexdigest(), hashlib.sha256(b"").hexdigest()
    assert got == [(0, 4, 2, seven), (1, 4, 2, seven), (2, 2, 1, none), (3, 0, 0, none)]
    assert [r["doc_id"] for r in keep_clean(docs, bench).collect()] == [3]
    assert decontaminate(docs, bench.where("false")).where("contaminated").count() == 0


def test_representatives_beside_a_column_named_like_the_key(spark):
    from sigwatch.llm.parity_join import keep_representatives
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (2, text), (2, text), (5, "b c d e")], "doc_id long, text string") \
        .withColumns({"_id": F.lit(9), "_id_": F.lit("x")})
    left = keep_representatives(df)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 5]


def test_a_corpus_without_labels_stays_whole(spark):
    from sigwatch.llm.byte_gru import identify, keep_identified
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert sorted(map(str, keep_identified(df).collect())) == sorted(map(str, df.collect()))
    assert {r["lang_pred"] for r in identify(df).collect()} == {"und"}


def test_trees_of_documents_that_share_an_id(spark):
    from sigwatch.llm import token_trees as T
    rows = [(1, "one text here"), (1, "one text here"), (1, "quite another text 12345"), (None, "no id"), (3, None), (4, ""),
            (5, "untouched")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    edits = spark.createDataFrame([(1, 0, 3, "two or three"), (None, 2, 2, "x"), (3, 0, 0, "new"), (9, 0, 1, "y")],
                                  "doc_id long, start long, end long, replacement string")
    got = T.apply_edits(docs, T.trees(docs), edits).collect()
    count = T.counter()
    want = []
    for doc_id, text in rows:
        new = T.edited(text or "", T.in_order([e[1:] for e in [(1, 0, 3, "two or three"), (None, 2, 2, "x"), (3, 0, 0, "new")]
                                               if e[0] == doc_id], len(text or "")))
        want.append((str(doc_id), len(count.coding.encode_ordinary(new))))
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted(want)
    assert T.trees(docs.where("false")).count() == 0


def test_licences_of_documents_without_an_id(spark):
    from sigwatch.llm.license_scan import license_report
    docs = spark.createDataFrame([(None, "All rights reserved"), (None, "cc by"), (1, "cc by"), (1, "none here")],
                                 "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["base_labels"], r["n_words"]) for r in license_report(docs).collect())
    assert got == [("1", "", 2), ("1", "cc-by", 2), ("None", "cc-by", 2), ("None", "reserved", 3)]


def test_base_places_and_labels_equal_a_plain_scan(spark):
    import re
    from sigwatch.llm.license_scan import BASE_PHRASES, license_report
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in license_report(docs).collect()}
    found = 0
    for doc_id, text in docs.select("doc_id", "text").collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        places = [(i, label) for label, phrase in BASE_PHRASES for i in range(len(w))
                  if w[i:i + len(phrase.split())] == phrase.split()]
        r = got[doc_id]
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        found += len(places)
    assert found > 5


def test_long_local_parts_and_larger_spans_are_redacted():
    from sigwatch.llm.deobfuscate import find_spans, redacted
    local = " dot ".join(["abcdefgh"] * 60)
    for text in (f"mail {local} at example dot com now", "ip 1​92.168.0.1 x", "call +1 415 555 26 seven one now"):
        base, added = find_spans(text)
        left = redacted(text, base + added)
        assert left.count("<") == 1 and not any(c.isdigit() for c in left) and "abcdefgh" not in left and "seven" not in left, left


def test_kept_trees_of_all_documents(spark):
    from sigwatch.llm import token_trees as T
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(None, None), (None, "a\n12345 b"), (7, ""), (7, "")], "doc_id long, text string"))
    kept = T.keep(docs)
    assert kept.columns == ["doc_id", "text", "chars", "tokens"] and kept.count() == docs.count()
    encode = T.counter().coding.encode_ordinary
    want = []
    for doc_id, text in docs.collect():
        edits = T.masking_edits(text)
        want.append((str(doc_id), len(encode(text or "")), len(encode(T.edited(text or "", edits))), len(edits)))
    for got in (T.update_kept(kept), T.counted(docs)):
        assert sorted((str(r["doc_id"]), r["n_before"], r["n_tokens"], r["n_edits"]) for r in got.collect()) == sorted(want)
    assert T.counted(docs.where("false")).count() == 0


def test_long_pre_tokens_are_not_remembered():
    from sigwatch.llm import token_trees as T
    count = T.Counter(T.RANKS)
    T.build("x" * 5000 + " short " + "y" * T.KEPT_LENGTH, count)
    assert count and max(map(len, count)) <= T.KEPT_LENGTH


def test_lattices_forget_by_their_size():
    import random

    import numpy as np

    from sigwatch.llm import piece_sampler as P
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdefghij", k=5000)) for _ in range(400)] + [None, "", "end"]
    cut = list(P.portions(texts))
    assert [k for part in cut for k in range(len(texts))[part]] == list(range(len(texts)))
    assert all(sum(len(t or "") for t in texts[part]) <= P.CHARS for part in cut)
    assert list(P.portions(["x" * 10, None, "y"], rows=2, chars=5)) == [slice(0, 1), slice(1, 3)] and not list(P.portions([]))
    lattice, held = P.Lattice(P.vocabulary()), []
    for part in cut:
        keys = list(range(len(texts)))[part]
        for ids, text in zip(P.encode_batch(lattice, keys, texts[part]), texts[part]):
            assert P.decode(lattice.vocab, ids) == text
        held.append(sum(getattr(lattice, name).data.nbytes for name in ("first_edge", "cut", "size", "piece", "last")))
    assert lattice.nodes <= P.KEPT_NODES + P.CHARS + len(texts) and max(held) < 200 << 20
    again = P.encode_batch(P.Lattice(P.vocabulary()), [3], texts[3:4])
    assert np.array_equal(again[0], P.encode_batch(lattice, [3], texts[3:4])[0])


def plain_mcd(x, floors, share, spread_start):
    """Concentration steps on exact subsets: mean, covariance, log determinant."""
    import numpy as np

    from sigwatch.llm.outliers import DIM, chi_square_cdf, chi_square_quantile
    n, take = len(x), int(np.ceil(share * len(x)))
    factor = share / chi_square_cdf(chi_square_quantile(share, DIM), DIM + 2)
    q1, mean, q3 = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    spread = ((q3 - q1) / 1.349) ** 2 + floors
    cov, last = np.diag(spread), np.inf
    if not spread_start:
        z = (x - mean) / np.sqrt(spread)
        z /= np.maximum(np.linalg.norm(z, axis=1), 1e-12)[:, None]
        cov = DIM * z.T @ z / n * np.sqrt(np.outer(spread, spread)) + np.diag(floors)
    best = None
    while True:
        d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        near = x[np.argsort(d2)[:take]]
        mean, cov = near.mean(axis=0), factor * np.cov(near.T, bias=True) + np.diag(floors)
        now = np.linalg.slogdet(cov)[1]
        if now >= last - 1e-9:
            return best
        last, best = now, (now, mean, cov)


def test_estimate_equals_a_plain_minimum_covariance_determinant(spark):
    import numpy as np

    from sigwatch.llm import outliers as O
    rng = np.random.default_rng(9)
    rows = []
    for source, n, bad in (("a", 900, 150), ("b", 400, 0), ("c", 300, 70)):
        words = rng.integers(80, 900, n + bad)
        for i, w in enumerate(words.tolist()):
            far = i >= n
            lines = 40
            level = float(rng.normal(0.2, 0.05))
            symbols = abs(level + (0.5 if far else 0.0)) * 0.3
            chars = int(w * rng.normal(5 + 2 * level, 0.2))
            rows.append((len(rows), "en", source, w, chars, int(symbols * chars), int(rng.integers(0, 8) + (20 if far else 0)),
                         int(w * abs(rng.normal(0.1, 0.02) + 0.2 * level)), lines))
    schema = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    df = spark.createDataFrame(rows, schema)
    got = {r["doc_id"]: r for r in O.robust_verdict(df).collect()}
    assert len(got) == len(rows)
    cut = O.chi_square_quantile(O.PROBABILITY, O.DIM)
    for source in "abc":
        own = np.array([[r[0], *r[3:]] for r in rows if r[2] == source], float)
        ids, (w, chars, symbols, dup, rep, lines) = own[:, 0].astype(int), own[:, 1:].T
        x = np.stack([np.log(chars / w), np.log1p(symbols / chars), np.log1p(dup / lines), np.log1p(rep / w)], axis=1)
        floors = np.array([(O.WORD_SPREAD ** 2 / w).mean(), (1 / chars ** 2).mean(), (1 / lines ** 2).mean(), ((O.LEAST_REPEAT / w) ** 2).mean()])
        _, mean, cov = min((plain_mcd(x, floors, O.SHARE, k) for k in (True, False)), key=lambda e: e[0])
        d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        ours = np.array([got[i]["distance"] for i in ids])
        assert np.median(np.abs(ours / d2 - 1)) < 0.1
        clear = np.abs(np.log(d2 / cut)) > 0.25
        assert clear.mean() > 0.9
        assert all(got[i]["kept"] == (d <= cut) for i, d, c in zip(ids, d2, clear) if c)


def test_determinants_never_rise(spark):
    import numpy as np

    from sigwatch.llm import outliers as O
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 4)) @ rng.normal(0, 1, (4, 4))
    x[:90] += 9.0
    rows = spark.createDataFrame([(1, *r, *[1e-4] * 4) for r in x.tolist()], ["g", *O.X, *O.FLOORS])
    by_steps = [O.least_determinant(rows, steps=k).first()["log_det"] for k in (1, 3, 20)]
    assert all(b <= a + 1e-9 for a, b in zip(by_steps, by_steps[1:]))
    assert O.least_determinant(rows.where("false")).count() == 0
