"""Histogram boosting against plain numpy, and node tables as models."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.plans import boosting, model, trees

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for k in range(3000):
        a, b, c = rng.random(), float(rng.randrange(7)), rng.choice([None, float("nan"), 1.0, 2.0])
        y = int((a > 0.6) ^ (b < 3)) if rng.random() < 0.9 else rng.randrange(2)
        data.append((k, a, b, c, y))
    return spark.createDataFrame(data, "k long, a double, b double, c double, label int").repartition(6).cache()


def plain_boost(x, y, cuts, s):
    """Trees by recursion over the rows; missing values go right."""
    logit, out = np.zeros(len(y)), []
    x = np.where(np.isnan(x), np.inf, x)
    for number in range(s.trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, p * (1 - p)
        nodes, move = [], np.zeros(len(y))

        def grow(node, at, depth):
            best = None
            if depth < s.depth:
                for f, points in enumerate(cuts):
                    for c in points:
                        left = at & (x[:, f] <= c)
                        right = at & ~left
                        if h[left].sum() < s.least_weight or h[right].sum() < s.least_weight:
                            continue
                        gain = sum(g[m].sum() ** 2 / (h[m].sum() + s.penalty) for m in (left, right))
                        gain -= g[at].sum() ** 2 / (h[at].sum() + s.penalty)
                        if gain > s.least_gain and (best is None or gain > best[0] + 1e-7):
                            best = (gain, f, c, left, right)
            if best is None:
                value = -s.rate * g[at].sum() / (h[at].sum() + s.penalty)
                move[at] = value
                nodes.append((number, node, None, None, value))
            else:
                nodes.append((number, node, FEATURES[best[1]], best[2], None))
                grow(2 * node, best[3], depth + 1)
                grow(2 * node + 1, best[4], depth + 1)

        grow(1, np.ones(len(y), dtype=bool), 0)
        logit += move
        out += sorted(nodes)
    return out, logit


def table(nodes):
    got = nodes.orderBy("tree", "node").select("tree", "node", "feature", "threshold", "value").collect()
    return [(t, n, f, c, v if v is None else round(v, 6)) for t, n, f, c, v in got]


@pytest.mark.parametrize("task_rows", [boosting.TASK_ROWS, 500])
def test_boosting_matches_plain_trees(spark, rows, monkeypatch, task_rows):
    monkeypatch.setattr(boosting, "TASK_ROWS", task_rows)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 300)
    monkeypatch.setattr(boosting, "KEPT_EVERY", 2)
    s = boosting.Settings(trees=5, depth=3, least_weight=2.0)
    cuts = boosting.cut_points(rows, FEATURES, 16)
    assert len(cuts[0]) == 15 and cuts[1] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0] and cuts[2] == [1.0]
    found = boosting.boost(rows, FEATURES, "label", s, cuts)
    held = rows.orderBy("k").toPandas()
    want, logit = plain_boost(held[FEATURES].to_numpy(dtype=float), held["label"].to_numpy(), cuts, s)
    assert table(found) == [(t, n, f, c, v if v is None else round(v, 6)) for t, n, f, c, v in want]
    scored = model.score(rows.na.fill(9.0), trees.model_of(found, FEATURES)).orderBy("k").toPandas()
    assert np.allclose(scored["probability"], 1 / (1 + np.exp(-logit)))
    assert (scored["prediction"] == (logit > 0)).all()


def test_trees_do_not_depend_on_partitions(spark, rows, monkeypatch):
    s = boosting.Settings(trees=4, depth=4)
    cuts = boosting.cut_points(rows, FEATURES)
    first = sorted(map(str, boosting.boost(rows, FEATURES, "label", s, cuts).collect()))
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 200)
    for parts in (1, 5):
        other = boosting.boost(rows.repartition(parts, "a"), FEATURES, "label", s, cuts)
        assert sorted(map(str, other.collect())) == first


def test_nothing_to_split(spark, rows):
    same = rows.withColumn("label", F.lit(1)).withColumn("a", F.lit(0.5))
    nodes = boosting.boost(same, ["a"], "label", boosting.Settings(trees=3)).collect()
    # a single leaf of all rows: second derivatives of 3000 / 4
    assert len(nodes) == 1 and nodes[0]["value"] == pytest.approx(0.3 * 1500 / 751)
    assert boosting.cut_points(same, ["a"]) == [[]]
    assert boosting.cut_points(rows.withColumn("a", F.lit(None).cast("double")), ["a"]) == [[]]
    with pytest.raises(ValueError, match="no rows"):
        boosting.boost(rows.limit(0), ["a"], "label")
    with pytest.raises(ValueError, match="at most"):
        boosting.boost(rows, ["a"], "label", cuts=[[float(k) for k in range(256)]])


def test_a_library_model_as_nodes_and_back(spark, rows):
    filled = rows.na.fill(0.0)
    fitted = model.train(filled, FEATURES, method="library", maxIter=4, maxDepth=3)
    nodes = trees.nodes_of(fitted, spark)
    back = trees.model_of(nodes, FEATURES)
    want = model.score(filled, fitted).orderBy("k").toPandas()["probability"]
    assert np.allclose(model.score(filled, back).orderBy("k").toPandas()["probability"], want)
    plain = filled.withColumn("p", trees.probability(nodes)).orderBy("k").toPandas()["p"]
    assert np.allclose(plain, want)
    assert nodes.filter("node = 0").agg(F.min("cover"), F.max("cover")).first() == (3000.0, 3000.0)


def test_kept_nodes(spark, rows, tmp_path):
    nodes = boosting.boost(rows, FEATURES, "label", boosting.Settings(trees=2, depth=2))
    trees.save_nodes(nodes, FEATURES, str(tmp_path / "kept"))
    again, names = trees.load_nodes(spark, str(tmp_path / "kept"))
    assert names == FEATURES and sorted(map(str, again.collect())) == sorted(map(str, nodes.collect()))


FIXED = [
    (0, 5, "a", 0.5, 7, 6, None, 8.0, 10.0),
    (0, 6, None, None, None, None, 0.25, None, 4.0),
    (0, 7, "odd name", 1.0, 9, 8, None, 2.0, 6.0),
    (0, 8, None, None, None, None, -1.0, None, 3.0),
    (0, 9, None, None, None, None, 2.0, None, 3.0),
    (3, 1, None, None, None, None, 0.125, None, 10.0),
]


def test_fixed_nodes(spark):
    nodes = spark.createDataFrame(FIXED, trees.NODES)
    rows = spark.createDataFrame(
        [(0.5, 1.0), (0.5, 1.5), (0.6, 0.0), (float("nan"), 0.0), (0.1, None)], "a double, `odd name` double"
    )
    want = [2.125, -0.875, 0.375, 0.375, -0.875]
    got = rows.select(trees.margin(nodes).alias("m"), trees.probability(nodes).alias("p")).collect()
    assert [r["m"] for r in got] == want
    assert [r["p"] for r in got] == pytest.approx([1 / (1 + math.exp(-m)) for m in want])
    scored = model.score(rows.dropna(), trees.model_of(nodes, ["odd name", "a"])).collect()
    assert [r["probability"] for r in scored] == pytest.approx([1 / (1 + math.exp(-m)) for m in want[:3]])


def test_importance_of_nodes(spark):
    nodes = spark.createDataFrame(FIXED, trees.NODES)
    got = trees.node_importance(nodes, ["a", "odd name", "unused"]).collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, 8.0, 10.0, 8.0, 10.0, 0.8),
        ("odd name", 1, 2.0, 6.0, 2.0, 6.0, 0.2),
        ("unused", 0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    leaf = spark.createDataFrame(FIXED[-1:], trees.NODES)
    assert [r["importance"] for r in trees.node_importance(leaf, ["a"]).collect()] == [0.0]


def test_broken_nodes(spark):
    def made(*rows):
        return spark.createDataFrame(list(rows), trees.NODES)

    with pytest.raises(ValueError, match="twice"):
        trees.model_of(made(FIXED[1], FIXED[1]), ["a"])
    with pytest.raises(ValueError, match="no node"):
        trees.model_of(made(FIXED[0], FIXED[1]), ["a"])
    with pytest.raises(ValueError, match="ancestor"):
        trees.model_of(made((0, 0, "a", 1.0, 0, 0, None, 1.0, 1.0)), ["a"])
    with pytest.raises(ValueError, match="not among"):
        trees.model_of(made(*FIXED), ["a"])
    with pytest.raises(ValueError, match="needs a tree"):
        trees.model_of(made(), ["a"])


def test_a_level_of_few_tasks_is_one_stage(spark):
    y = np.zeros(4, dtype=np.uint8)
    for parts, stages in ((6, 1), (boosting.FEW_TASKS + 1, 2)):
        state = spark.sparkContext.parallelize([(np.zeros((1, 4), dtype=np.uint8), y, np.zeros(4))] * parts, parts)
        spark.sparkContext.setJobGroup(f"level {parts}", "")
        found = boosting._merged(state, boosting._Tree(), [1], 4.0)
        assert found[0, 0, 0].tolist() == [8 * parts, 4 * parts]
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"level {parts}")
        assert [len(spark.sparkContext.statusTracker().getJobInfo(j).stageIds) for j in jobs] == [stages]
