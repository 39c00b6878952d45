"""Tree ensembles as a table of nodes: one form for training, scoring, keeping and ranking features.

A row of the table is a node: ``tree``, ``node``, for an inner node ``feature``, ``threshold``, ``left`` and
``right`` (a value up to the threshold goes left, a larger or missing one right), for a leaf
``value``. Leaf values of all trees add up to the logit of the positive class. ``gain`` is what the split is
worth in all, ``cover`` the weight of the rows that reached the node. The root of a tree is its least node.

A table becomes a pipeline model of Spark ML by way of the files that such a model is stored in, and is read
from them, so that scoring runs in Spark's own trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pelagia.sources.writers import shared_folder

NODES = (
    "tree int, node int, feature string, threshold double, left int, right int, "
    "value double, gain double, cover double"
)

# The layout of a stored model.
_NODE_DATA = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
    "leftChild int, rightChild int, split struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>"
)
_CLASSIFIER = "org.apache.spark.ml.classification.GBTClassificationModel"
_TREE = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
_DEFAULTS = {
    "featuresCol": "features",
    "labelCol": "label",
    "leafCol": "",
    "predictionCol": "prediction",
    "probabilityCol": "probability",
    "rawPredictionCol": "rawPrediction",
    "lossType": "logistic",
    "impurity": "variance",
}


def nodes_of(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted pipeline of an assembler and boosted trees."""
    path = shared_folder(spark)
    model.stages[-1].write().overwrite().save(f"{path}/trees")
    names = F.array(*[F.lit(n) for n in model.stages[0].getInputCols()])
    stored = spark.read.parquet(f"{path}/trees/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/trees/treesMetadata").toDF("treeID", "about", "weight")
    rows = stored.join(F.broadcast(weights), "treeID")
    inner = F.col("leftChild") >= 0
    count = F.col("impurityStats")[0]
    return rows.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        # the library's margin counts twice in its logit
        F.when(~inner, 2 * F.col("weight") * F.col("prediction")).alias("value"),
        F.when(inner, F.col("gain") * count).alias("gain"),
        count.alias("cover"),
    )


def _trees(rows: Iterable[Row]) -> dict[int, dict[int, Row]]:
    out: dict[int, dict[int, Row]] = {}
    for row in rows:
        tree = out.setdefault(row["tree"], {})
        if row["node"] in tree:
            raise ValueError(f"tree {row['tree']} has node {row['node']} twice")
        tree[row["node"]] = row
    if not out:
        raise ValueError("a model needs a tree")
    return dict(sorted(out.items()))


def _in_order(tree: dict[int, Row]) -> list[Row]:
    """The nodes from the root on, each before its children, the left ones first."""
    out, left = [], [min(tree)]
    while left:
        node = tree.get(left.pop())
        if node is None or len(out) == len(tree):
            raise ValueError("a tree has a child that is no node, or a node that is its own ancestor")
        out.append(node)
        if node["feature"] is not None:
            left += [node["right"], node["left"]]
    return out


def model_of(nodes: DataFrame, features: Sequence[str]) -> PipelineModel:
    """The ensemble as a pipeline model with these input columns.

    The table is as large as the model, which every task that scores holds anyway.
    """
    spark = nodes.sparkSession
    index = {name: k for k, name in enumerate(features)}
    data, trees = [], _trees(nodes.collect())
    for number, tree in enumerate(trees.values()):
        order = _in_order(tree)
        place = {row["node"]: k for k, row in enumerate(order)}
        for k, row in enumerate(order):
            inner, cover = row["feature"] is not None, row["cover"] or 0.0
            if inner and row["feature"] not in index:
                raise ValueError(f"the model asks for {row['feature']}, which is not among the features")
            value = 0.0 if inner else row["value"] / 2
            split = (index[row["feature"]], [row["threshold"]], -1) if inner else (-1, [], -1)
            children = (place[row["left"]], place[row["right"]]) if inner else (-1, -1)
            worth = (row["gain"] or 0.0) / cover if inner and cover else -1.0
            stats = [cover, cover * value, cover * value * value]
            data.append((number, (k, value, 0.0, stats, int(cover), worth, *children, split)))

    def about(kind: str, uid: str, **more) -> str:
        head = {"class": kind, "timestamp": 0, "sparkVersion": spark.version, "uid": uid}
        return json.dumps(head | {"paramMap": {}, "defaultParamMap": _DEFAULTS} | more)

    path = f"{shared_folder(spark)}/trees"
    frame = spark.createDataFrame(data, f"treeID int, nodeData struct<{_typed(_NODE_DATA)}>")
    frame.coalesce(1).write.parquet(f"{path}/data")
    plain = {"featuresCol", "labelCol", "leafCol", "predictionCol", "impurity"}
    defaults = {k: v for k, v in _DEFAULTS.items() if k in plain}
    kept = [(k, about(_TREE, f"tree_{k}", defaultParamMap=defaults), 1.0) for k in range(len(trees))]
    spark.createDataFrame(kept, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    text = about(_CLASSIFIER, "trees", numFeatures=len(features), numTrees=len(trees))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")

    from pyspark.ml.classification import GBTClassificationModel

    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return PipelineModel([assembler, GBTClassificationModel.load(path)])


def _typed(schema: str) -> str:
    """Fields of a struct from those of a table."""
    return ", ".join(f.replace(" ", ":", 1) for f in schema.split(", "))


def save_nodes(nodes: DataFrame, features: Sequence[str], path: str) -> None:
    """Keep a model as plain Parquet that any reader understands: its nodes, and its features in order."""
    spark = nodes.sparkSession
    nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    named = spark.createDataFrame(list(enumerate(features)), "position int, feature string")
    named.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_nodes(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Nodes and features of a kept model; ``model_of`` makes it ready to score."""
    named = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    return spark.read.schema(NODES).parquet(f"{path}/nodes"), [r["feature"] for r in named]


def margin(nodes: DataFrame) -> Column:
    """The logit as a plain column expression over the features, for models of a few trees.

    It needs no model object and can be written out as SQL; each tree is a nested CASE. Many deep
    trees make an expression that is slow to plan: take ``model_of`` for these.
    """
    parts = []
    for tree in _trees(nodes.collect()).values():
        text: dict[int, str] = {}
        for row in reversed(_in_order(tree)):
            if row["feature"] is None:
                text[row["node"]] = f"{row['value']!r}D"
            else:
                name = row["feature"].replace("`", "``")
                yes, no = text.pop(row["left"]), text.pop(row["right"])
                text[row["node"]] = f"CASE WHEN `{name}` <= {row['threshold']!r}D THEN {yes} ELSE {no} END"
        parts.append(text.popitem()[1])
    return F.expr(" + ".join(f"({p})" for p in parts))


def probability(nodes: DataFrame) -> Column:
    """Probability of the positive class as a column expression."""
    return 1 / (1 + F.exp(-margin(nodes)))


def node_importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """For every feature its splits, gain and cover in all and for each split, and its importance.

    The importance is the gain of a feature's average split, as a share of that of all features. Features
    that no tree asks for have zeros. The most important one comes first.
    """
    named = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    splits = nodes.filter("feature is not null").groupBy("feature").agg(
        F.count("*").alias("splits"),
        F.sum("gain").alias("total_gain"),
        F.sum("cover").alias("total_cover"),
        F.avg("gain").alias("mean_gain"),
        F.avg("cover").alias("mean_cover"),
    )
    out = named.join(splits, "feature", "left").na.fill(0)
    # one row for each feature
    every = F.sum("mean_gain").over(Window.partitionBy(F.lit(1)))
    share = F.when(every > 0, F.col("mean_gain") / every).otherwise(0.0)
    return out.withColumn("importance", share).orderBy(F.desc("importance"), "feature")
