"""Forest, autoencoder and ensemble: the reference's own assertions on our API."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigwatch.operators import autoencoder as AE
from sigwatch.operators import features as FT
from sigwatch.operators import forest as IF
from sigwatch.plans import data, pipeline
from sigwatch.schema import AutoencoderParams, ForestParams

SMALL_AE = AutoencoderParams(latent=4, epochs=20, epochs_per_round=10)


@pytest.fixture(scope="module")
def feats(lev):
    base = data.baseline(lev)
    mi = FT.metric_index(base)
    b = FT.autoencoder_features(FT.add_row_index(base, batch_rows=500), mi).select("event_id", *FT.AE_FEATURES)
    s = FT.autoencoder_features(FT.add_row_index(data.stream(lev), batch_rows=500), mi)
    return b, s


@pytest.fixture(scope="module")
def forest(feats):
    return IF.fit_forest(feats[0], FT.FOREST_FEATURES, ForestParams(trees=50))


@pytest.fixture(scope="module")
def ae(feats):
    return AE.fit_autoencoder(feats[0], FT.AE_FEATURES, SMALL_AE)


def test_forest_scores_all_rows(feats, forest):
    b, s = feats
    d = FT.batch_minmax_confidence(IF.decision(s, FT.FOREST_FEATURES, forest), "if_decision", "c")
    r = d.select("c", "if_is_anomaly").toPandas()
    assert len(r) == s.count()
    assert r["c"].between(0, 1).all()


def test_forest_few_flags_on_normal_rows(feats, forest):
    b, _ = feats
    r = IF.decision(b, FT.FOREST_FEATURES, forest).agg(F.avg(F.col("if_is_anomaly").cast("int"))).first()[0]
    assert r <= 0.10


def test_forest_flags_extreme_outlier(feats, forest):
    _, s = feats
    one = s.limit(1).withColumn("f_value", F.lit(99999.0)).withColumn("f_log", F.log1p(F.lit(99999.0)))
    assert IF.decision(one, FT.FOREST_FEATURES, forest).first()["if_is_anomaly"]


def test_forest_independent_of_partitioning(feats):
    b, _ = feats
    f1 = IF.fit_forest(b, FT.FOREST_FEATURES, ForestParams(trees=20))
    f2 = IF.fit_forest(b.repartition(5), FT.FOREST_FEATURES, ForestParams(trees=20))
    assert (f1.feature == f2.feature).all() and (f1.left == f2.left).all()
    assert np.allclose(f1.split, f2.split, rtol=1e-9, atol=1e-12) and abs(f1.offset - f2.offset) < 1e-9


def test_autoencoder_loss_per_epoch_and_falls(ae):
    assert len(ae.losses) == SMALL_AE.epochs
    assert ae.losses[-1] < ae.losses[0]


def test_autoencoder_outlier_has_larger_error(feats, ae):
    _, s = feats
    base = AE.score(s.limit(200), FT.AE_FEATURES, ae).agg(F.max("reconstruction_error")).first()[0]
    one = s.limit(1).withColumn("f_value", F.lit(99999.0)).withColumn("f_sq", F.lit(99999.0 ** 2 / 1e6))
    out = AE.score(one, FT.AE_FEATURES, ae).first()
    assert out["reconstruction_error"] > base and out["ae_is_anomaly"]


def test_ensemble_end_to_end(spark, lev):
    models = pipeline.fit(data.baseline(lev), ForestParams(trees=50), SMALL_AE)
    out = pipeline.score(data.stream(lev), models).toPandas()
    assert len(out) == data.stream(lev).count()
    assert set(out["severity"]) <= {"Normal", "Low", "Medium", "High", "Critical"}
    assert all(set(v) == {"IsolationForest", "Autoencoder", "ControlCharts"} for v in out["votes"])
    assert out["ensemble_confidence"].between(0, 1).all()
    # single-event scoring: IF confidence is 0 for a batch of one (reference behaviour)
    one = pipeline.score(data.stream(lev).limit(50), models, batch_rows=None).toPandas()
    assert (one["if_confidence"] == 0).all()


def _walk(forest, x):
    """Brute force: walk every tree row by row."""
    import math as m
    out = []
    for row in (x - forest.scaler_mean) / forest.scaler_std:
        tot = 0.0
        for t in range(forest.feature.shape[0]):
            node = 0
            while forest.feature[t, node] >= 0:
                f = forest.feature[t, node]
                node = forest.left[t, node] if row[f] < forest.split[t, node] else forest.right[t, node]
            tot += forest.leaf_path[t, node]
        c = IF.avg_path_length(np.array([forest.sample_size]))[0]
        out.append(-m.pow(2.0, -(tot / forest.feature.shape[0]) / c))
    return np.array(out)


def test_forest_scores_equal_brute_force(feats, forest):
    _, s = feats
    pdf = IF.decision(s.limit(150), FT.FOREST_FEATURES, forest) \
        .select(*FT.FOREST_FEATURES, "if_decision").toPandas()
    x = pdf[list(FT.FOREST_FEATURES)].to_numpy()
    want = _walk(forest, x) - forest.offset
    assert np.allclose(pdf["if_decision"].to_numpy(), want, rtol=0, atol=1e-12)


def test_autoencoder_scores_equal_local_numpy(feats, ae):
    _, s = feats
    pdf = AE.score(s.limit(150), FT.AE_FEATURES, ae).select(*FT.AE_FEATURES, "reconstruction_error").toPandas()
    x = (pdf[list(FT.AE_FEATURES)].to_numpy() - ae.mean) / (ae.std + 1e-8)
    h = x
    ws = AE.unflatten(ae.weights, ae.n_in, ae.params)
    for i in range(0, len(ws), 2):
        h = h @ ws[i] + ws[i + 1]
        if i < len(ws) - 2:
            h = np.maximum(h, 0.0)
    err = ((x - h) ** 2).mean(axis=1)
    assert np.allclose(pdf["reconstruction_error"].to_numpy(), np.round(err, 8), atol=1e-8)


def test_training_scores_are_taken_once(spark, monkeypatch):
    """The selection of a threshold reads its rows several times: it gets a
    written table, not the models' scoring."""
    train = spark.range(300).select(F.col("id").cast("string").alias("event_id"), (F.col("id") % 17).cast("double").alias("a"),
                                    F.sin("id").alias("b"))
    seen = []
    for module in (IF, AE):
        real = module.percentiles
        monkeypatch.setattr(module, "percentiles", lambda df, *a, real=real, **k: seen.append(
            df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    IF.fit_forest(train, ("a", "b"), ForestParams(trees=5, sample=32))
    AE.fit_autoencoder(train, ("a", "b"), AutoencoderParams(epochs=2, shards=2))
    assert len(seen) == 2 and not any("EvalPython" in plan for plan in seen), seen


def test_rows_walk_trees_of_any_shape():
    """A tree that is one leaf, one that is a chain, and missing values."""
    import pandas as pd
    rng = np.random.default_rng(2)
    chain = [row for d in range(6) for row in (
        (1, 2 * d, d % 2, 0.5 - 0.1 * d, 2 * d + 1, 2 * d + 2, 9, d), (1, 2 * d + 1, -1, 0.0, -1, -1, 3, d + 1))]
    chain.append((1, 12, -1, 0.0, -1, -1, 2, 6))
    nodes = pd.DataFrame([(0, 0, -1, 0.0, -1, -1, 7, 0), *chain, *IF.grow_tree(rng.normal(0, 1, (64, 2)), 2, 6, 1)],
                         columns=[f.name for f in IF.NODE_SCHEMA])
    forest = IF.Forest.from_nodes(nodes, 64, [0.0, 0.0], [1.0, 1.0])
    x = rng.normal(0, 1, (IF.WALK_ROWS + 50, 2))
    x[3, 0] = np.nan
    c = float(IF.avg_path_length(np.array([64]))[0])
    got = forest.score_samples(x)
    for i in (0, 3, 5, IF.WALK_ROWS - 1, IF.WALK_ROWS, len(x) - 1):
        path = 0.0
        for t in range(3):
            node = 0
            while forest.feature[t, node] >= 0:
                node = int((forest.left if x[i, forest.feature[t, node]] < forest.split[t, node] else forest.right)[t, node])
            path += forest.leaf_path[t, node]
        assert got[i] == -np.power(2.0, -(path / 3) / c)
