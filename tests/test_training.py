import tempfile

import numpy as np
import pandas as pd

from fleetlens.plans import training as TR


def _binary(spark, n=500, seed=42):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 6))
    y = (X[:, 0] + 0.5 * X[:, 1] + rng.normal(0, 0.5, n) > 0.3).astype(int)
    pdf = pd.DataFrame(X, columns=[f"f{i}" for i in range(6)])
    pdf["failure_label"] = y
    pdf["rul"] = np.clip(60 + 30 * X[:, 0] + rng.normal(0, 5, n), 0, 125)
    pdf["unit_id"] = np.repeat(np.arange(10), n // 10)
    pdf["cycle"] = np.tile(np.arange(1, n // 10 + 1), 10)
    return spark.createDataFrame(pdf)


FEATS = [f"f{i}" for i in range(6)]


def test_classifier_leaderboard_and_champion(spark):
    df = _binary(spark)
    board = TR.leaderboard(spark, df, TR.classifier_specs(0.03)[:2], "failure_label", features=FEATS, folds=2, order="unit_id").collect()
    assert [r["rank"] for r in board] == [1, 2]
    assert board[0]["roc_auc"] >= board[1]["roc_auc"]
    for r in board:
        assert 0.0 <= r["roc_auc"] <= 1.0 and 0.0 <= r["f1"] <= 1.0
    assert board[0]["roc_auc"] > 0.8  # the label is learnable
    ranked = spark.createDataFrame([("gbt_xgb_like", 1), ("random_forest", 2)], "name string, rank int")
    assert TR.select_champion(ranked, TR.classifier_specs()).name == "gbt_xgb_like"
    model = TR.fit_champion(df, TR.classifier_specs(0.05)[0], "failure_label", FEATS)
    imp = TR.feature_importance(spark, model).collect()
    assert imp[0]["feature"] == "f0" and abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
    path = tempfile.mkdtemp(prefix="fleetlens-model-")
    TR.save_model(model, path)
    reloaded = TR.load_model(path)
    res = TR.score_fleet(df, reloaded).collect()
    assert len(res) == 10
    assert all(0.0 <= r["failure_probability"] <= 1.0 for r in res)


def test_regressor_leaderboard_and_weights(spark):
    df = _binary(spark)
    board = TR.leaderboard(spark, df, TR.regressor_specs(0.03), "rul", features=FEATS, folds=2, order="unit_id").collect()
    assert len(board) == 2 and all(r["neg_rmse"] <= 0 for r in board)
    w = {r["failure_label"]: r["weight"] for r in TR.with_weights(df, "failure_label", "balanced").select("failure_label", "weight").distinct().collect()}
    y = df.toPandas()["failure_label"]
    assert abs(w[1] - len(y) / (2 * (y == 1).sum())) < 1e-12
    blocks = TR.fold_blocks(df, "unit_id", 4).groupBy("_block").count().collect()
    assert sorted(r["_block"] for r in blocks) == [0, 1, 2, 3, 4]


def test_folds_fit_beside_each_other_on_rows_read_once(spark, monkeypatch):
    import threading

    df, running, most, lock = _binary(spark, 200), set(), [], threading.Lock()
    meet = threading.Barrier(2, timeout=120)
    fit = TR._fit

    def watched(spec, label, rows, n_rows):
        assert rows.columns[:3] == ["failure_label", "_block", "features"] and rows.count() == n_rows
        with lock:
            running.add(threading.get_ident())
            most.append(len(running))
        meet.wait()  # a fit alone would wait in vain
        model = fit(spec, label, rows, n_rows)
        with lock:
            running.discard(threading.get_ident())
        return model

    spec = TR.classifier_specs(0.01)[3:]
    monkeypatch.setattr(TR, "_fit", watched)
    beside = TR.leaderboard(spark, df, spec, "failure_label", features=FEATS, folds=2, order="unit_id", parallel=2).collect()
    assert max(most) == 2 and len(most) == 2
    assert [r["name"] for r in beside] == ["gradient_boosting"] and 0.5 < beside[0]["roc_auc"] <= 1.0 and beside[0]["time_s"] > 0


def test_featured_rows_are_built_once_until_the_table_changes(spark, tmp_path, monkeypatch):
    from fleetlens.operators import series as S
    from fleetlens.plans import analytics_queries as Q

    def write(rows):
        spark.sql(
            f"select id as event_id, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, id) as ts, id % 3 as user_id, 'error' as event_type, "
            f"double(id % 7) as value, concat('{{\"k\":', id % 5, '}}') as props from range({rows})"
        ).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")

    built, build = [], S.feature_matrix
    monkeypatch.setattr(S, "feature_matrix", lambda *a, **k: built.append(1) or build(*a, **k))
    write(90)
    first = Q._featured(spark, str(tmp_path))
    assert Q._featured(spark, str(tmp_path)) is first and len(built) == 1
    n = first.count()
    write(120)
    assert Q._featured(spark, str(tmp_path)).count() == n + 30 and len(built) == 2


def test_registered_queries_fit_the_references_models_in_full(spark, monkeypatch):
    from pyspark.sql import functions as F

    from fleetlens.plans import analytics_queries as Q

    df = _binary(spark, 100).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    seen = []

    def ranked(spark, df, specs, label, *, features, folds, order):
        seen.extend(specs)
        return spark.createDataFrame([(s.name, i + 1) for i, s in enumerate(specs)], "name string, rank int")

    monkeypatch.setattr(Q, "_featured", lambda *a: df)
    monkeypatch.setattr(Q, "_BOARDS", {})
    monkeypatch.setattr("fleetlens.sources.tables.table_version", lambda *a: ())
    monkeypatch.setattr(TR, "leaderboard", ranked)
    Q._leaderboard(spark, "none", "classifier")
    Q._leaderboard(spark, "none", "regressor")
    size = lambda s: s.build().getNumTrees() if s.name.startswith("random") else s.build().getMaxIter()
    full = {"random_forest": 200, "gbt_xgb_like": 300, "gbt_lgbm_like": 300, "gradient_boosting": 200, "gbt_xgb_like_rul": 300, "random_forest_rul": 200}
    assert {s.name: size(s) for s in seen} == full
    # the champion is one of these
    assert Q._leaderboard(spark, "none", "classifier")[1][0].build().getNumTrees() == 200


class _Recorded:
    """An estimator that keeps the number of tasks it is given."""

    def __init__(self, seen):
        self.seen = seen

    def setLabelCol(self, _):
        return self

    setFeaturesCol = setWeightCol = setLabelCol

    def fit(self, rows):
        self.seen.append([n for n in rows.rdd.glom().map(len).collect()])


def test_fits_are_split_no_further_than_their_share_of_the_cores(spark, monkeypatch):
    seen = []
    spec = TR.ModelSpec("recorded", "regressor", lambda: _Recorded(seen))
    rows = TR._assembler(FEATS).transform(_binary(spark, 400)).select("rul", "features").repartition(8)
    # beside other fits: one task, though the table has 8 partitions
    TR._fit(spec, "rul", TR._dealt(rows, 400, 0.4), 400)
    monkeypatch.setattr(TR, "SPREAD_ROWS", 100)
    TR._fit(spec, "rul", TR._dealt(rows, 400, 8), 400)
    monkeypatch.setattr(TR, "FIT_TASK_ROWS", 40)
    # no task holds more than its rows, even of a table with fewer partitions
    TR._fit(spec, "rul", TR._dealt(rows.coalesce(2), 400, 0.4), 400)
    assert [len(s) for s in seen] == [1, 4, 10] and all(sum(s) == 400 for s in seen)
    assert max(seen[2]) <= 60


def test_folds_leave_the_cores_to_each_other(spark, monkeypatch):
    df, seen, fit = _binary(spark, 300), [], TR._fit

    def watched(spec, label, rows, n_rows):
        seen.append(rows.rdd.getNumPartitions())
        return fit(spec, label, rows, n_rows)

    monkeypatch.setattr(TR, "_fit", watched)
    TR.leaderboard(spark, df, TR.regressor_specs(0.01), "rul", features=FEATS, folds=2, order="unit_id").collect()
    assert seen == [1, 1, 1, 1]


def test_champions_are_fitted_once_and_loaded(spark, monkeypatch):
    from pyspark.sql import functions as F

    from fleetlens.plans import analytics_queries as Q

    df, fitted, fit = _binary(spark, 100).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")), [], TR.fit_champion
    board = spark.createDataFrame([("random_forest", 1)], "name string, rank int")
    monkeypatch.setattr(Q, "_featured", lambda *a: df)
    monkeypatch.setattr(Q, "_CHAMPIONS", {})
    monkeypatch.setattr(Q, "_leaderboard", lambda *a: (board, TR.classifier_specs(0.02), "failure_label"))
    monkeypatch.setattr("fleetlens.sources.tables.table_version", lambda *a: ())
    monkeypatch.setattr(TR, "fit_champion", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    found = [Q._champion(spark, "none", "classifier")[1] for _ in range(2)]
    assert len(fitted) == 1
    importances = [TR.feature_importance(spark, m).collect() for m in [*fitted, *found]]
    assert importances[0] == importances[1] == importances[2] and len(importances[0]) == len(FEATS)
