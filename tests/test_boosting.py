"""Histogram boosting against a plain row-by-row version; sampling, dealing, node table and its SQL."""

import time
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from smogcast.ml import boosting as b

SMALL = b.BoostConfig(rounds=12, step=0.3, max_depth=4, leaves=6, min_rows=3, reg_alpha=0.5, reg_lambda=1.5, row_share=0.7,
                      column_share=0.7, bins=16, rounds_per_job=5)
NAMES = ["a", "b", "c", "d"]


def table(n=300, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[:, 2] = np.round(x[:, 2])                    # ties
    x[rng.random(n) < 0.1, 1] = np.nan
    y = np.sin(2 * x[:, 0]) + np.nan_to_num(x[:, 1]) * 0.5 + rng.normal(size=n) * 0.2
    return x, y


def frame(spark, x, y, w=None):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in x[i]], None if np.isnan(y[i]) else float(y[i]),
             1.0 if w is None else float(w[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, w double")


def plain_tree(cfg, codes, g, h, drawn, columns):
    """Best-first growth by trying every split of every leaf over its rows; the leaf of each row."""
    def shrunk(v):
        return np.sign(v) * max(abs(v) - cfg.reg_alpha, 0.0)

    def worth(rows):
        return shrunk(g[rows].sum()) ** 2 / (h[rows].sum() + cfg.reg_lambda)

    def best(rows):
        out = (0.0, 0, 0)
        for f in columns:
            for cut in range(cfg.bins - 1):
                left, right = rows[codes[rows, f] <= cut], rows[codes[rows, f] > cut]
                if min(len(left), len(right)) < max(cfg.min_rows, 1) or min(h[left].sum(), h[right].sum()) < cfg.min_hessian:
                    continue
                gain = worth(left) + worth(right) - worth(rows)
                if gain > out[0] * (1 + 1e-10):
                    out = (gain, f, cut)
        return out

    every = np.arange(len(codes))
    leaves = [(every, 0, best(every[drawn]))]
    while len(leaves) < cfg.leaves:
        able = [i for i, (_, depth, split) in enumerate(leaves) if depth < cfg.max_depth and split[0] > 0]
        if not able:
            break
        rows, depth, (_, f, cut) = leaves.pop(max(able, key=lambda i: leaves[i][2][0]))
        for part in (rows[codes[rows, f] <= cut], rows[codes[rows, f] > cut]):
            leaves.append((part, depth + 1, best(part[drawn[part]])))
    value = np.zeros(len(codes))
    for rows, _, _ in leaves:
        own = rows[drawn[rows]]
        value[rows] = -cfg.step * shrunk(g[own].sum()) / (h[own].sum() + cfg.reg_lambda)
    return value


def plain_boost(cfg, codes, y, w, key, start):
    f = np.tile(np.array(start), (len(y), 1))
    losses = []
    for r in range(cfg.rounds):
        losses.append(loss(cfg, y, f, w))
        g, h = b.gradients(cfg, y, f, w)
        drawn = b.sampled_rows(cfg, key, r)
        f = f + np.stack([plain_tree(cfg, codes, g[:, c], h[:, c], drawn, b.sampled_columns(cfg, codes.shape[1], r, c))
                          for c in range(f.shape[1])], axis=1)
    return f, losses + [loss(cfg, y, f, w)]


def loss(cfg, y, f, w):
    if cfg.loss == "softmax":
        return -(w * np.log(b.softmax(f)[np.arange(len(y)), y.astype(int)])).sum() / w.sum()
    r = y - f[:, 0]
    return (w * np.where((r > 0) & (cfg.loss == "asymmetric"), cfg.under_weight, 1.0) * r ** 2).sum() / w.sum()


def keys(spark, n):
    return np.array([r[0] for r in spark.range(n).select(F.xxhash64("id"), "id").orderBy("id").collect()])


@pytest.mark.parametrize("kind, rows", [("squared", 10 ** 6), ("asymmetric", 10 ** 6), ("softmax", 10 ** 6), ("softmax", 110)])
def test_equals_the_plain_version(spark, kind, rows):
    x, y = table()
    w = np.random.default_rng(8).uniform(0.5, 2.0, len(y)) if kind != "squared" else np.ones(len(y))
    cfg = replace(SMALL, loss=kind, rows_per_task=rows)
    if kind == "softmax":
        y, cfg = np.digitize(y, [-0.5, 0.5]).astype(float), replace(cfg, classes=4, rounds=6)   # class 3 has no rows
    df = frame(spark, x, y, w)
    m = b.fit_boosted(df, NAMES, "y", cfg, "w", ("id",))
    codes = b._coded(m.edges, list(x.T))
    want, _ = plain_boost(cfg, codes, y, w, keys(spark, len(y)), m.start)
    shown = m.probabilities() if kind == "softmax" else m.score()
    got = np.array([r[0] for r in df.select(shown, "id").orderBy("id").collect()])
    assert np.allclose(got, b.softmax(want) if kind == "softmax" else want[:, 0], atol=1e-9)
    if kind == "softmax":
        assert (got[:, 3] == 0).all()


def test_dealing_and_order_do_not_matter(spark):
    x, y = table(400)
    df = frame(spark, x, y)
    one = b.fit_boosted(df, NAMES, "y", SMALL, None, ("id",))
    many = b.fit_boosted(df.repartition(7).orderBy("a"), NAMES, "y", replace(SMALL, rows_per_task=110, rounds_per_job=3), None, ("id",))
    assert one.edges == many.edges
    shape = ["round", "class", "node", "feature", "bin", "left", "right", "rows"]
    assert one.nodes[shape].equals(many.nodes[shape])
    assert np.allclose(one.nodes["value"], many.nodes["value"], atol=1e-12)


def test_one_task_exchanges_nothing(spark):
    """An exchange takes a barrier stage a second: these 40 rounds would take 40."""
    x, y = table(200)
    cfg = replace(SMALL, loss="softmax", classes=4, rounds=40, rounds_per_job=40)
    df = frame(spark, x, np.digitize(y, [-0.5, 0.5]).astype(float)).transform(b.materialize)
    began = time.monotonic()
    m = b.fit_boosted(df, NAMES, "y", cfg, None, ("id",))
    assert time.monotonic() - began < 25
    assert sorted(set(zip(m.nodes["round"], m.nodes["class"]))) == [(r, c) for r in range(40) for c in range(4)]


def test_leaves_depth_and_sampling_hold(spark):
    x, y = table(400)
    m = b.fit_boosted(frame(spark, x, y), NAMES, "y", replace(SMALL, rounds=8, leaves=5, max_depth=3, min_rows=10), None, ("id",))
    for _, tree in m.nodes.groupby("round"):
        leaves = tree[tree["feature"] < 0]
        assert len(leaves) <= 5 and (leaves["rows"] >= 10).all() and len(set(tree["feature"]) - {-1}) <= 3
        depth = {0: 0}
        for r in tree.sort_values("node").itertuples():
            for kid in (r.left, r.right):
                if kid >= 0:
                    depth[kid] = depth[r.node] + 1
        assert max(depth.values()) <= 3
        assert 0.55 * 400 < tree.loc[tree["node"] == 0, "rows"].iloc[0] < 0.85 * 400


def test_500_rounds_lower_the_asymmetric_loss_every_time(spark):
    x, y = table(400, 5)
    cfg = b.BoostConfig(rounds=500, step=0.02, max_depth=4, leaves=12, min_rows=5, row_share=1.0, column_share=1.0, loss="asymmetric",
                        reg_alpha=0.0, reg_lambda=1.0, bins=16)
    df = frame(spark, x, y)
    m = b.fit_boosted(df, NAMES, "y", cfg, None, ("id",))
    codes = b._coded(m.edges, list(x.T))
    losses, f = [], np.full((len(y), 1), m.start[0])
    nodes = m.nodes
    for r in range(500):
        losses.append(loss(cfg, y, f, np.ones(len(y))))
        f = f + b.leaf_values(codes, b._sorted(nodes[nodes["round"] == r]), 1)
    assert all(z <= a + 1e-12 for a, z in zip(losses, losses[1:])) and losses[-1] < 0.2 * losses[0]
    plan = df.select(m.score())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project") <= 2 and plan.count("EvalPython") == 1      # as flat for 500 trees as for one
    r = y - f[:, 0]
    plain = b.fit_boosted(df, NAMES, "y", replace(cfg, loss="squared"), None, ("id",))
    even = y - np.array([v[0] for v in df.select(plain.score(), "id").orderBy("id").collect()])
    assert r.mean() < even.mean()                                            # it would rather predict too much


def test_sql_over_the_node_table_gives_the_scores(spark, tmp_path):
    x, y = table(250, 9)
    df = frame(spark, x, y)
    m = b.fit_boosted(df, NAMES, "y", SMALL, None, ("id",))
    m.save(f"file://{tmp_path}/m", spark)
    again = b.BoostedModel.load(f"file://{tmp_path}/m", spark)
    got = [r[0] for r in df.select(again.score(), "id").orderBy("id").collect()]
    nodes, rows = m.table(spark).toPandas(), df.toPandas()
    con = duckdb.connect()
    con.register("nodes", nodes)
    con.register("data", rows)
    want = con.sql(f"""
        WITH RECURSIVE x AS (UNPIVOT (SELECT id, a, b, c, d FROM data) ON a, b, c, d INTO NAME feature VALUE v),
        walk AS (SELECT id, n.* FROM data, nodes n WHERE n.node = 0
                 UNION ALL SELECT w.id, n.* FROM walk w LEFT JOIN x ON x.id = w.id AND x.feature = w.feature
                 JOIN nodes n ON n.round = w.round AND n.class = w.class
                      AND n.node = CASE WHEN coalesce(v <= w.threshold, true) THEN w."left" ELSE w."right" END
                 WHERE w.feature IS NOT NULL)
        SELECT id, {m.start[0]!r} + sum(value) AS score FROM walk WHERE feature IS NULL GROUP BY id ORDER BY id""").fetchall()
    assert np.allclose(got, [r[1] for r in want], atol=1e-12)


def test_odd_tables(spark):
    x, y = table(40)
    y[:5] = np.nan                                                            # left out of the fit
    x[:, 3] = 1.0                                                             # never split
    df = frame(spark, x, y)
    m = b.fit_boosted(df, NAMES, "y", replace(SMALL, column_share=1.0), None, ("id",))
    assert 3 not in set(m.nodes["feature"]) and m.nodes.loc[m.nodes["node"] == 0, "rows"].max() <= 35
    assert m.importance()[3] == 0 and m.importance().sum() == pytest.approx(1.0)
    empty = b.fit_boosted(df.where("id < 0"), NAMES, "y", SMALL, None, ("id",))
    assert [r[0] for r in df.select(empty.score()).distinct().collect()] == [0.0]
    classes = b.fit_boosted(df.where("id < 0"), NAMES, "y", replace(SMALL, loss="softmax", classes=3), None, ("id",))
    assert df.select(classes.probabilities()).first()[0] == pytest.approx([1 / 3] * 3)
    lone = b.fit_boosted(df.where("id = 9"), NAMES, "y", SMALL, None, ("id",))
    assert df.select(lone.score()).first()[0] == pytest.approx(y[9])


def test_boosted_classes_beat_the_forest_in_log_loss(spark):
    from smogcast.ml.stage2 import fit_forest, padded_probs
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 4))
    y = np.digitize(x[:, 0] + 0.7 * x[:, 1] * x[:, 2] + rng.normal(size=1500) * 0.2, [-1, -0.3, 0.3, 1]).astype(float)
    df = frame(spark, x, y)
    train, val = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    cfg = b.BoostConfig(rounds=150, step=0.08, max_depth=6, leaves=31, min_rows=15, reg_lambda=2.0, loss="softmax", classes=6)
    m = b.fit_boosted(train, NAMES, "y", cfg, "w", ("id",))
    forest = fit_forest(train, NAMES, "y", "w", trees=100)

    def log_loss(scored):
        p = F.greatest(F.element_at("p", F.col("y").cast("int") + 1), F.lit(1e-6))
        return scored.agg(-F.avg(F.log(p))).first()[0]
    mine = log_loss(val.withColumn("p", m.probabilities()))
    theirs = log_loss(forest.transform(val).withColumn("p", padded_probs("probability")))
    assert mine < theirs
