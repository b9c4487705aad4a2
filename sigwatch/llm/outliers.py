"""Quality rules: robust multivariate outliers, in DataFrame operations only.

Each text gives counts (words, characters in words, symbols, repeated lines,
words in repeated 3-word windows) and a vector of four transformed shares.
Per (language, source) the minimum-covariance-determinant estimate is found by
concentration steps: the ``share`` of rows with the smallest Mahalanobis
distance gives the next mean and covariance. Two starts are followed, medians
with quartile spreads and the covariance of spatial signs, each until its
determinant stops falling; the one with the smaller determinant is the
group's estimate. Rows beyond a chi-square quantile of the distance to it are
rejected.

A concentration step is one pass: rows join their group's estimate (a small
table), and one aggregate by (group, distance bin) holds the moments; the
subset is cut at a bin's edge by a running count over the bins. So a group of
any size is partially aggregated before the shuffle, nothing is sorted or
collected, and the result does not depend on how rows are partitioned.

Groups under ``min_rows`` share the estimate of their language's small groups;
where even that is under ``min_rows``, that of their whole language, and where
the language is under it too, that of all rows. A variance floor per
statistic and group, the square of what one text can resolve, keeps the
covariance regular where a share is constant (mostly 0).

Defined results: null and empty texts have zero words and fail the base rule;
null language or source is a group of its own; repeated rows count and return
once each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import space_words, staged, start

DIM = 4
SHARE = 0.75
#: Steps of a start at most; a determinant has to fall by more than the factor
#: exp(-LEAST_FALL) for another.
STEPS = 20
LEAST_FALL = 1e-6
MIN_ROWS = 80
#: Deviation of the logarithm of a word's length, and words that the smallest
#: repeat of a 3-word window covers.
WORD_SPREAD, LEAST_REPEAT = 0.5, 6
#: Chi-square probability of the cut-off.
PROBABILITY = 0.999
#: Bins per unit of a statistic (start) and per doubling of a distance (steps).
STAT_BINS, DISTANCE_BINS = 256, 32


def chi_square_cdf(x: float, dim: int) -> float:
    """For an even number of dimensions."""
    return 1.0 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dim // 2))


def chi_square_quantile(p: float, dim: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, dim) < p else (lo, mid)
    return lo


# ---- counts per text --------------------------------------------------------

def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines. All work stays inside the row: nothing is shuffled.

    3-word windows are hashed to 63 bits minus the bits of a position; hash
    and position share one long, so one primitive sort brings equal windows
    together. Neighbours of equal hash are compared word by word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                     F.col("source").cast("string").alias("source"), text.alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select("doc_id", "lang", "source", space_words(F.col("t")).alias("w"),
                   (F.size(F.split("t", r"[#*$%&|<>]")) - 1).alias("n_symbols"), lines.alias("lines"))
    df = df.select("doc_id", "lang", "source", "w", "n_symbols", F.size("w").alias("n"),
                   F.length(F.array_join("w", "")).alias("word_chars"),
                   F.size("lines").alias("n_lines"), F.size(F.array_distinct("lines")).alias("n_distinct"),
                   F.length(F.bin(F.size("w"))).alias("bits"))
    packed = F.transform(
        F.slice("w", 1, F.greatest(F.col("n") - 2, F.lit(0))),
        lambda x, i: F.coalesce(
            F.call_function("shiftleft", F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)), F.col("bits"))
            .bitwiseOR(i.cast("long")), F.lit(0).cast("long")))
    df = df.withColumn("s", F.sort_array(packed))
    df = df.withColumn("mask", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1)

    def alike(x: Column, y: Column) -> Column:
        right = lambda v: F.call_function("shiftright", v, F.col("bits"))
        at = lambda v, k: F.get("w", v.bitwiseAND(F.col("mask")).cast("int") + k)
        return (right(x) == right(y)) & (at(x, 0) == at(y, 0)) & (at(x, 1) == at(y, 1)) & (at(x, 2) == at(y, 2))

    twice = F.filter("s", lambda x, i: F.coalesce(alike(x, F.get("s", i - 1)), F.lit(False))
                     | F.coalesce(alike(x, F.get("s", i + 1)), F.lit(False)))
    df = df.withColumn("twice", twice)
    at = F.sort_array(F.transform("twice", lambda x: F.coalesce(x.bitwiseAND(F.col("mask")), F.lit(0).cast("long"))))
    df = df.withColumn("at", at)
    # a window covers three words, less what the next repeated window covers
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("at", i + 1) - p, F.lit(3).cast("long")))),
        F.lit(0).cast("long"), lambda a, b: a + b)
    return df.select("doc_id", "lang", "source", F.col("n").cast("long").alias("n_words"),
                     F.col("word_chars").cast("long").alias("word_chars"), F.col("n_symbols").cast("long").alias("n_symbols"),
                     (F.col("n_lines") - F.col("n_distinct")).cast("long").alias("n_dup_lines"),
                     F.when(F.size("at") > 0, covered).otherwise(0).alias("n_repeat_words"),
                     F.col("n_lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """Transformed statistics: log of the mean word length, and log(1 + share)
    of symbols, repeated lines and repeated words (shares 0 to 1)."""
    part = lambda a, b: F.log1p(F.least(F.col(a) / F.greatest(F.col(b), F.lit(1)), F.lit(1.0)))
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
            part("n_symbols", "word_chars"), part("n_dup_lines", "n_lines"), part("n_repeat_words", "n_words")]


def resolution() -> list[Column]:
    """Squares of the smallest differences that a text of this length can show:
    the sampling error of its mean word length, and one symbol, one repeated
    line, one repeated window. Their group means are the variance floors."""
    unit = lambda size, b: F.pow(F.lit(float(size)) / F.greatest(F.col(b), F.lit(1)), F.lit(2.0))
    return [F.lit(WORD_SPREAD ** 2) / F.greatest(F.col("n_words"), F.lit(1)), unit(1, "word_chars"), unit(1, "n_lines"),
            unit(LEAST_REPEAT, "n_words")]


# ---- estimates --------------------------------------------------------------

X = [f"x{i}" for i in range(DIM)]
FLOORS = [f"f{i}" for i in range(DIM)]
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


#: An estimate: its group and start, floors, means, Cholesky factor, and the
#: logarithm of the covariance's determinant.
ESTIMATE = ["g", "start", *FLOORS, *(f"m{i}" for i in range(DIM)), *(f"l{i}{j}" for i, j in PAIRS), "log_det"]


def with_factor(df: DataFrame) -> DataFrame:
    """From means m_i, covariances c_ij (floors added) and floors f_i: the
    Cholesky factor l_ij, column by column, and the determinant."""
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        value = F.sqrt(F.greatest(rest, F.col(FLOORS[i]) / 16)) if i == j else rest / F.col(f"l{j}{j}")
        df = df.withColumn(f"l{i}{j}", value)
    return df.withColumn("log_det", 2 * sum((F.log(f"l{i}{i}") for i in range(DIM)), F.lit(0.0))).select(*ESTIMATE)


def with_distance(rows: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    """Squared Mahalanobis distance d2 of every row to its group's estimate."""
    df = rows.drop(*FLOORS).join(estimate, "g", how)
    for i in range(DIM):
        rest = F.col(X[i]) - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIM)), F.lit(0.0)))


def quartile_start(rows: DataFrame) -> DataFrame:
    """Start 0: medians and quartile spreads per group, from exact fixed-width
    bins, and the group's floors."""
    stats = F.explode(F.array(*(F.struct(F.lit(i).alias("stat"), F.floor(F.col(X[i]) * STAT_BINS).alias("bin"))
                                for i in range(DIM))))
    counts = rows.select("g", stats.alias("s")).select("g", "s.*").groupBy("g", "stat", "bin").count()
    by = Window.partitionBy("g", "stat")
    bins = counts.withColumn("run", F.sum("count").over(by.orderBy("bin"))).withColumn("total", F.sum("count").over(by))
    picked = bins.groupBy("g", "stat").agg(
        *(F.min(F.when(F.col("run") >= q * F.col("total"), F.col("bin"))).alias(name)
          for q, name in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))))
    wide = picked.groupBy("g").agg(
        *(F.max(F.when(F.col("stat") == i, (F.col("q2") + 0.5) / STAT_BINS)).alias(f"m{i}") for i in range(DIM)),
        *(F.max(F.when(F.col("stat") == i, F.pow((F.col("q3") - F.col("q1")) / STAT_BINS / 1.349, F.lit(2.0)))).alias(f"c{i}{i}") for i in range(DIM)))
    wide = wide.join(rows.groupBy("g").agg(*(F.avg(f).alias(f) for f in FLOORS)), "g")
    wide = wide.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + F.col(FLOORS[i]) for i in range(DIM)})
    return with_factor(wide.withColumns({f"c{i}{j}": F.lit(0.0) for i, j in PAIRS if i != j}).withColumn("start", F.lit(0)))


def sign_start(rows: DataFrame, quartiles: DataFrame) -> DataFrame:
    """Start 1: the covariance of spatial signs (directions from the medians in
    units of the quartile spreads), which far rows cannot stretch."""
    signs = with_distance(rows, quartiles)
    sign = [F.when(F.col("d2") > 0, F.col(f"y{i}") / F.sqrt("d2")).otherwise(0.0) for i in range(DIM)]
    same = [*FLOORS, *(f"m{i}" for i in range(DIM)), *(f"l{i}{i}" for i in range(DIM))]
    wide = signs.groupBy("g").agg(*(F.max(c).alias(c) for c in same), *(F.avg(sign[i] * sign[j]).alias(f"v{i}{j}") for i, j in PAIRS))
    return with_factor(wide.withColumn("start", F.lit(1)).withColumns({
        f"c{i}{j}": DIM * F.col(f"v{i}{j}") * F.col(f"l{i}{i}") * F.col(f"l{j}{j}") + (F.col(FLOORS[i]) if i == j else F.lit(0.0))
        for i, j in PAIRS}))


def concentrate(rows: DataFrame, estimate: DataFrame, share: float = SHARE) -> DataFrame:
    """One step of each start: mean and covariance of its group's rows in the
    bins of smallest distance that hold ``share`` of them."""
    near = with_distance(rows, estimate)
    moments = (near.withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-6) * DISTANCE_BINS)).groupBy("g", "start", "bin")
               .agg(F.count("*").alias("n"), *(F.max(f).alias(f) for f in FLOORS), *(F.sum(x).alias(f"s{x}") for x in X),
                    *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}{j}") for i, j in PAIRS)))
    by = Window.partitionBy("g", "start")
    kept = (moments.withColumn("before", F.coalesce(F.sum("n").over(
                by.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("total", F.sum("n").over(by)).where(F.col("before") < share * F.col("total")))
    sums = kept.groupBy("g", "start").agg(F.sum("n").alias("n"), *(F.max(f).alias(f) for f in FLOORS), *(F.sum(f"s{x}").alias(f"s{x}") for x in X),
                                 *(F.sum(f"p{i}{j}").alias(f"p{i}{j}") for i, j in PAIRS))
    sums = sums.withColumns({f"m{i}": F.col(f"s{X[i]}") / F.col("n") for i in range(DIM)})
    # the subset is cut at the share's quantile: scale to a normal sample's covariance
    consistency = share / chi_square_cdf(chi_square_quantile(share, DIM), DIM + 2)
    return with_factor(sums.withColumns({
        f"c{i}{j}": consistency * (F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
        + (F.col(FLOORS[i]) if i == j else F.lit(0.0)) for i, j in PAIRS}))


def least_determinant(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """The estimate of each group: of both starts' last subsets that with the
    smaller determinant. A start goes on while its determinant falls; the
    tables here have a row per group and start, the rows of groups that are
    done are not read into another step."""
    quartiles = staged(quartile_start(rows), "estimate")
    starts = quartiles.unionByName(sign_start(rows, quartiles))
    # a start is no subset of the rows yet: its first step always counts
    best = staged(starts.withColumns({"log_det": F.lit(math.inf), "falls": F.lit(True)}), "estimate")
    whole = F.struct(*ESTIMATE, "falls")
    for _ in range(steps):
        stepped = concentrate(rows, best.where("falls").drop("falls"), share).withColumn("falls", F.lit(True))
        both = best.withColumn("falls", F.lit(False)).unionByName(stepped)
        order = F.col("log_det") + F.when(F.col("falls"), LEAST_FALL).otherwise(0.0)
        best = staged(both.groupBy("g", "start").agg(F.min_by(whole, order).alias("e")).select("e.*"), "estimate")
        if not best.where("falls").take(1):
            break
    return (best.groupBy("g").agg(F.min_by(F.struct(*ESTIMATE), F.struct("log_det", "start")).alias("e")).select("e.*"))


def robust_verdict(counts: DataFrame, share: float = SHARE, steps: int = STEPS, min_rows: int = MIN_ROWS,
                   probability: float = PROBABILITY) -> DataFrame:
    """Adds base_failed, kept and distance (null where no row passes the base
    rule) to the counts. Estimates use the rows that pass the base rule."""
    one = F.struct(F.col("lang"), F.col("source"))
    all_rows = counts.withColumn("base_failed", base_failed()).withColumns(dict(zip(X + FLOORS, vector() + resolution())))
    rows = staged(all_rows, "statistics")
    sizes = rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("size"))
    key = lambda name, *c: F.xxhash64(F.lit(name), F.to_json(F.struct(*c)))
    by_language = Window.partitionBy("lang")
    large = F.col("size") >= min_rows
    groups = (sizes.withColumn("pool", F.sum("size").over(Window.partitionBy("lang", large)))
              .withColumn("whole", F.sum("size").over(by_language))
              .withColumn("level", F.when(large, 0).when(F.col("pool") >= min_rows, 1).when(F.col("whole") >= min_rows, 2).otherwise(3))
              .withColumn("widened", F.max(F.col("level") == 2).over(by_language))
              .select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "level", "widened",
                      key("language", "lang").alias("language"), F.lit(0).cast("long").alias("all"),
                      F.when(F.col("level") == 0, F.xxhash64(F.to_json(one)))
                      .when(F.col("level") == 1, key("pooled", "lang")).alias("g")))
    groups = staged(groups.withColumn("g", F.when(F.col("level") == 2, F.col("language"))
                                      .when(F.col("level") == 3, F.col("all")).otherwise(F.col("g"))), "groups")
    all_needed = bool(groups.where("level = 3").take(1))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    grouped = rows.join(groups.select("_lang", "_source", "g"), same, "left").drop("_lang", "_source")
    # a row counts in its own group's estimate and in the wider ones that other rows fall back to
    members = groups.select("_lang", "_source", F.explode(F.array_distinct(F.array_compact(F.array(
        F.col("g"), F.when(F.col("widened"), F.col("language")), F.when(F.lit(all_needed), F.col("all")))))).alias("g"))
    fit = rows.where(~F.col("base_failed")).join(members, same).select("g", *X, *FLOORS)
    estimate = staged(least_determinant(fit, share, steps), "estimate")
    judged = with_distance(grouped, estimate, "left")
    cut = chi_square_quantile(probability, DIM)
    return judged.select(
        *counts.columns, "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cut, F.lit(True))).alias("kept"), F.col("d2").alias("distance"))


def quality(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its counts, base_failed, kept and distance."""
    start(docs.sparkSession)
    return robust_verdict(text_counts(docs), **options)
