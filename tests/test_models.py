"""Importances on planted links, generated matrices, layers and shapes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.operators import guards, importance, regulons, synthetic


def test_importances_find_planted_links(spark):
    draw = np.random.default_rng(3)
    n, m = 300, 12
    x = draw.poisson(2, (n, m)).astype(float)
    y = {"up": 3 * x[:, 2] + draw.normal(0, 0.5, n) + 20, "down": 50 - 4 * x[:, 7] + draw.normal(0, 0.5, n), "flat": np.full(n, 4.0)}
    features = spark.createDataFrame([(f"r{j}", i, float(x[i, j])) for i in range(n) for j in range(m) if x[i, j]], "feature string, obs_id int, value double")
    targets = spark.createDataFrame([(t, i, float(v[i])) for t, v in y.items() for i in range(n)], "target string, obs_id int, value double")
    pairs = spark.createDataFrame([(t, f"r{j}") for t in [*y, "absent"] for j in range(m)] * 2 + [("up", "never_seen")], "target string, feature string")
    obs = spark.range(n).select(F.col("id").cast("int").alias("obs_id"))
    run = lambda k: {(r["target"], r["feature"]): r for r in importance.importances(pairs, targets, features, obs, blocks=k, trees=80, rate=0.1, tried=0.5).collect()}
    got = run(3)
    assert len(got) == 4 * m + 1
    for t, best, sign in (("up", "r2", 1), ("down", "r7", -1)):
        own = {f: r for (u, f), r in got.items() if u == t}
        assert max(own, key=lambda f: own[f]["importance"]) == best and own[best]["importance"] > 0.8 and own[best]["sign"] == sign
        assert abs(sum(r["importance"] for r in own.values()) - 1) < 1e-9
        assert own[best]["signed"] == pytest.approx(own[best]["importance"] * own[best]["rho"])
    for t in ("flat", "absent"):
        assert all(r["importance"] == 0 and r["rho"] is None and r["sign"] == 0 for (u, _), r in got.items() if u == t)
    assert got["up", "never_seen"]["importance"] == 0 and got["up", "never_seen"]["rho"] is None
    # The blocks' number has no effect.
    assert {k: (r["importance"], r["rho"]) for k, r in run(1).items()} == {k: (r["importance"], r["rho"]) for k, r in got.items()}
    # Average ranks, against their definition.
    v = x[:, 0]
    assert importance._ranks(v).tolist() == [(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v]


def test_importances_of_nothing(spark):
    none = lambda s: spark.createDataFrame([], s)
    got = importance.importances(none("target string, feature string"), none("target string, obs_id int, value double"), none("feature string, obs_id int, value double"), none("obs_id int"))
    assert got.count() == 0 and got.columns == ["target", "feature", "importance", "rho", "sign", "signed"]


def test_synthetic_pairs_agree_only_where_linked(spark):
    def agreement(linked):
        s = synthetic.paired(spark, 400, 4, 6, 2, 0.3, linked=linked).where("feature like '%0'").groupBy("obs_id", "program").pivot("modality", [0, 1]).agg(F.first("value"))
        return s.agg(F.corr("0", "1")).first()[0]

    assert agreement(True) > 0.8 and abs(agreement(False)) < 0.6
    a, b = (sorted(map(tuple, synthetic.paired(spark, 20, 3, 2, 2, 0.3).collect())) for _ in range(2))
    assert a == b and len(a) == 20 * 2 * 2 * 2


def test_layers_and_peek(spark):
    e = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "obs_id int, var_id string, value double")
    got = regulons.layers({"counts": e.withColumnRenamed("var_id", "feature"), "auc": e.select("obs_id", F.lit("s").alias("feature"), "value")})
    assert sorted(map(tuple, got.collect())) == [("auc", 1, "s", 2.0), ("auc", 2, "s", 3.0), ("counts", 1, "a", 2.0), ("counts", 2, "b", 3.0)]
    obs = spark.createDataFrame([(0,), (1,), (2,)], "obs_id int")
    assert tuple(guards.peek(e, obs).first()) == (3, 2, 2, 2, False)
    assert tuple(guards.peek(e, obs.where("obs_id > 0")).first()) == (2, 2, 2, 2, True)
