"""Repeated passages against SQL and brute force."""

import random

import pytest
from pyspark.sql import functions as F


def plain_passages(rows, least):
    first, found = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = (text or "").lower().split()
        for i in range(len(w) - least + 1):
            window = tuple(w[i:i + least])
            if window in first:
                found.setdefault(doc_id, []).append((i, first[window]))
            else:
                first[window] = (doc_id, i)
    out = []
    for doc_id, hits in found.items():
        runs = []
        for i, place in hits:
            if runs and i <= runs[-1][1] + least:
                runs[-1][1] = i
            else:
                runs.append([i, i, place])
        out += [(doc_id, a, b - a + least, *place) for a, b, place in runs]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, least", [(1, 17), (1, 33), (2, 20), (3, 20), (4, 33)])
def test_every_window_that_stands_earlier_is_found(spark, seed, least):
    from sigwatch.llm.passages import repeated_passages
    rng = random.Random(seed)
    pool = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(20, 60))] for _ in range(6)]
    pool += [[rng.choice("ab")] * rng.randint(10, 60) for _ in range(3)] + [(["x", "y", "z"] * 30)[:70]]
    rows = []
    for d in range(60):
        w = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(pool)
            a = rng.randint(0, 10)
            w += p[a:rng.randint(a, len(p))] + [str(rng.randint(0, 99)) for _ in range(rng.randint(0, 3))]
        rows.append((d or None, rng.choice([" ", "\n"]).join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r["doc_id"], r["first_word"], r["n_words"], r["kept_doc_id"], r["kept_word"])
           for r in repeated_passages(df, least).collect()]
    assert sorted(got, key=str) == plain_passages(rows, least)


def test_passages_inside_lines_keep_their_offsets(spark):
    from sigwatch.llm.passages import remove_passages, repeated_passages
    shared = [f"wört{i}" for i in range(60)]
    rows = [(1, "ä one " + " ".join(shared) + " end"), (2, "two\n" + "\n".join(shared).upper().replace("Ö", "ö") + "\nown tail"),
            (3, " ".join(shared[:49])), (None, None), (5, ""), (6, "x " * 49), (2, "another text of two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"cut_doc": F.lit(1), "cut_th": F.lit(2), "removed": F.lit("r"), "units": F.lit(3), "th": F.lit(4)})
    [r] = repeated_passages(df).collect()
    assert (r["doc_id"], r["first_word"], r["n_words"], r["kept_doc_id"], r["kept_word"]) == (2, 1, 60, 1, 2)
    assert rows[1][1][r["start"]:r["end"]].lower().split() == shared
    left = remove_passages(df)
    texts = sorted((str(x["doc_id"]), x["text"], x["removed_"]) for x in left.collect() if x["doc_id"] == 2)
    assert texts == [("2", "another text of two", None), ("2", "two\nown tail", [(r["start"], r["end"])])]
    assert left.count() == len(rows) and left.columns == [*df.columns, "removed_"]


def test_repeated_rows_ranks_and_empty_tables(spark):
    from sigwatch.llm.passages import remove_passages, repeated_passages
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, 5), (1, text, 5), (2, "head " + text, 3), (3, text + " w0 w1", None), (4, text * 1, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, r long")
    by_id = {r["doc_id"]: r["kept_doc_id"] for r in repeated_passages(df).collect()}
    assert by_id == {2: 1, 3: 1, 4: 1}
    ranked = {r["doc_id"]: r["kept_doc_id"] for r in repeated_passages(df, rank=F.col("r")).collect()}
    assert ranked == {1: 3, 2: 3, 4: 3}
    assert repeated_passages(df.where("false")).count() == remove_passages(df.where("false")).count() == 0


def test_cut_lines_with_clashing_names(spark):
    from sigwatch.llm.line_dedup import remove_repeats
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e\nx")], "doc_id long, text string").withColumns(
        {"_cut_doc": F.lit(1), "removed": F.lit(2)})
    got = {r["doc_id"]: (r["text"], r["removed_"]) for r in remove_repeats(df).collect()}
    assert got == {1: ("a b c d e", None), 2: ("x", [(0, 9)])}
