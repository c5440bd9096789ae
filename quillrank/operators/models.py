"""Hashed sparse features and click models on Spark's ML library."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    FMClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillrank.functions import clip, hash_feature, logit
from quillrank.operators.metrics import auc, average_score, logloss
from quillrank.operators.sampling import fold
from quillrank.operators.vectors import pooled
from quillrank.plans.skew import spread_join
from quillrank.session import run_dir, stage

FEATURE_SIZE = 100_000
# Rows that a task of a fit holds in memory, as objects of some 200 bytes.
ROWS_A_TASK = 1_000_000


def hashed_lines(rows: DataFrame, rid: str, names: str, weights: str, buckets: int = FEATURE_SIZE) -> DataFrame:
    """(row id, bucket, weight) of weighted feature lists, one line per list entry."""
    cells = F.arrays_zip(F.col(names).alias("n"), F.col(weights).alias("w"))
    flat = rows.select(rid, F.explode(cells).alias("c")).filter(F.col("c.n").isNotNull())
    weight = F.coalesce(F.col("c.w").cast("double"), F.lit(0.0))
    return flat.select(rid, hash_feature(F.col("c.n"), buckets).alias("i"), weight.alias("w"))


def hashed_cells(names: str | Column, weights: str | Column, buckets: int) -> Column:
    """The same inside one row: sorted (bucket, weight) cells, without a shuffle."""
    names = F.col(names) if isinstance(names, str) else names
    weights = F.col(weights) if isinstance(weights, str) else weights
    hashed = F.transform(names, lambda n: hash_feature(n, buckets))
    pairs = F.filter(F.arrays_zip(hashed.alias("i"), weights.alias("w")), lambda p: p["i"].isNotNull())
    slots = F.transform(pairs, lambda p: p["i"])

    def total(slot: Column) -> Column:
        same = F.filter(pairs, lambda p: p["i"] == slot)
        return F.aggregate(same, F.lit(0.0), lambda s, p: s + F.coalesce(p["w"].cast("double"), F.lit(0.0)))

    return F.transform(
        F.array_sort(F.array_distinct(slots)), lambda s: F.struct(s.alias("i"), total(s).alias("w"))
    )


def with_sparse(rows: DataFrame, cells: str, out: str, size: int) -> DataFrame:
    """Replace a column of (i, w) cells by a sparse vector, in a written table.

    Spark has no expression for one, but a struct of its fields, once written, is read back as a vector column.
    """
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.transform(cells, lambda c: c["i"]).alias("indices"),
        F.transform(cells, lambda c: c["w"]).alias("values"),
    )
    path = run_dir(rows.sparkSession, "sparse")
    rows.withColumn(out, vector).drop(cells).write.parquet(path)
    kept = [f for f in rows.schema.fields if f.name != cells]
    return rows.sparkSession.read.schema(T.StructType([*kept, T.StructField(out, VectorUDT())])).parquet(path)


def sparse_features(rows: DataFrame, names: str, weights: str, out: str, buckets: int = FEATURE_SIZE) -> DataFrame:
    return with_sparse(rows.withColumn("__cells", hashed_cells(names, weights, buckets)), "__cells", out, buckets)


def pooled_features(
    rows: DataFrame, table: DataFrame, rid: str, names: str, weights: str, out: str, lists: DataFrame | None = None
) -> DataFrame:
    """sqrt(n)-pooled embeddings of a weighted list; ``table``: slot (0..size-1), embedding. Empty lists give zeros.

    ``lists`` has the lists under the row ids, where ``rows`` would be costly to compute twice.
    """
    size = table.count()
    lines = hashed_lines(rows if lists is None else lists, rid, names, weights, size).withColumnRenamed("i", "slot").filter("w <> 0")
    sums = pooled(lines, table, rid, "slot", "w").withColumnRenamed("pooled", out)
    dim = len(table.select("embedding").first()[0])
    zeros = F.array_repeat(F.lit(0.0), dim)
    return rows.join(sums, rid, "left").withColumn(out, F.coalesce(F.col(out), zeros))


def _prob(model_out: DataFrame, name: str) -> DataFrame:
    p = vector_to_array("probability")[1]
    return model_out.withColumn(name, p).drop("probability", "rawPrediction", "prediction")


def fit_wide(
    train: DataFrame, features: str = "wide", label: str = "label", reg: float = 0.01, mix: float = 0.5,
    iterations: int = 20,
):
    """Linear click model with L1 and L2."""
    return LogisticRegression(
        featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=mix, maxIter=iterations
    ).fit(train)


def fit_deep(
    train: DataFrame, inputs: int, features: str = "deep", label: str = "label", hidden=(64, 16),
    iterations: int = 20, seed: int = 0,
):
    """Two hidden layers over pooled embeddings."""
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=label, layers=[inputs, *hidden, 2], maxIter=iterations, seed=seed
    ).fit(train)


class WideDeep:
    """Wide and deep model: both parts fitted, then a logistic regression over their two logits.

    The embeddings are an input and stay fixed, and the hidden units are sigmoids: it stands in for joint training.
    """

    def __init__(self, table: DataFrame, buckets: int = FEATURE_SIZE, iterations: int = 20, hidden=(64, 16)):
        self.table, self.buckets, self.iterations, self.hidden = table, buckets, iterations, hidden
        self.wide = self.deep = self.top = None

    def prepare(self, rows: DataFrame, rid: str = "id") -> DataFrame:
        """``rows``: id, label, user_features, user_weights, ads_features, ads_weights."""
        rows, table = stage(rows, "examples"), stage(self.table, "slots")
        out = rows.withColumn("cells", hashed_cells("ads_features", "ads_weights", self.buckets))
        for side in ("user", "ads"):
            out = pooled_features(out, table, rid, f"{side}_features", f"{side}_weights", f"{side}_pool", lists=rows)
        both = F.concat("user_pool", "ads_pool")
        flat = with_sparse(out.select(rid, "label", "cells", both.alias("pools")), "cells", "wide", self.buckets)
        return flat.select(rid, "label", "wide", array_to_vector("pools").alias("deep"))

    def logits(self, prepared: DataFrame) -> DataFrame:
        scored = _prob(self.wide.transform(prepared), "wide_prob")
        scored = _prob(self.deep.transform(scored), "deep_prob")
        for part in ("wide", "deep"):
            scored = scored.withColumn(f"{part}_logit", logit(clip(f"{part}_prob", 1e-9)))
        return VectorAssembler(inputCols=["wide_logit", "deep_logit"], outputCol="__both").transform(scored)

    def fit(self, prepared: DataFrame) -> WideDeep:
        inputs = prepared.select(F.size(vector_to_array("deep"))).first()[0]
        self.wide = fit_wide(prepared, iterations=self.iterations)
        self.deep = fit_deep(prepared, inputs, hidden=self.hidden, iterations=self.iterations)
        self.top = LogisticRegression(featuresCol="__both", labelCol="label").fit(self.logits(prepared))
        return self

    def predict(self, prepared: DataFrame) -> DataFrame:
        """id, label and the three probabilities."""
        out = _prob(self.top.transform(self.logits(prepared)), "prob")
        return out.drop("wide", "deep", "wide_logit", "deep_logit", "__both")


def evaluate(scored: DataFrame, prob: str = "prob", label: str = "label") -> DataFrame:
    """One row: AUC, logloss, count and average score. The model behind ``scored`` runs once."""
    scored = stage(scored.select(prob, label), "scored")
    ranks = auc(scored, prob, label).select("auc")
    return ranks.select(
        "auc",
        logloss(scored, prob, label).scalar().alias("logloss"),
        average_score(scored, prob).select(F.struct("*")).scalar().alias("s"),
    ).select("auc", "logloss", "s.total_count", "s.average_score")


# Models over plain columns -----------------------------------------------------------------------------------------

CLASSIFIERS = {
    "logistic": lambda **o: LogisticRegression(**o),
    "factorization": lambda **o: FMClassifier(**{"factorSize": 4, "stepSize": 0.05, **o}),
    "boosting": lambda **o: GBTClassifier(**{"maxDepth": 4, **o}),
    "forest": lambda **o: RandomForestClassifier(**{"numTrees": 20, **o}),
}


def evened(train: DataFrame) -> DataFrame:
    """Rows dealt to tasks of at most about ROWS_A_TASK; a smaller table stays as it is.

    Fits keep their rows as objects in memory, a partition of a scan as one block many times the size of the file.
    """
    parts = -(-train.count() // ROWS_A_TASK)
    return train.repartition(max(parts, train.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else train


def fit_classifier(train: DataFrame, kind: str, features: list[str], label: str = "label", **options):
    """Assembled columns and one of CLASSIFIERS as a fitted pipeline."""
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    more = [v for k, v in options.items() if k.endswith("Col") and v in train.columns]
    rows = evened(train.select(*dict.fromkeys([*features, label, *more])))
    return Pipeline(stages=[assemble, CLASSIFIERS[kind](labelCol=label, **options)]).fit(rows)


def class_prob(model, rows: DataFrame, out: str = "prob") -> DataFrame:
    return _prob(model.transform(rows), out).drop("features")


def fit_linear(train: DataFrame, features: list[str], label: str):
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    return Pipeline(stages=[assemble, LinearRegression(labelCol=label)]).fit(train)


def fit_one_vs_rest(train: DataFrame, features: list[str], label: str):
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    return Pipeline(stages=[assemble, OneVsRest(classifier=LogisticRegression(maxIter=10), labelCol=label)]).fit(train)


def leaf_features(train: DataFrame, features: list[str], label: str = "label", trees: int = 5, depth: int = 3):
    """Rows with the leaf each boosted tree puts them in, ready to cross or one-hot."""
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    boost = GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth, seed=0).setLeafCol("leaf")
    out = Pipeline(stages=[assemble, boost]).fit(evened(train.select(*dict.fromkeys([*features, label])))).transform(train)
    leaves = F.transform(vector_to_array("leaf"), lambda x: x.cast("int"))
    return out.withColumn("leaves", leaves).drop("features", "leaf", "rawPrediction", "probability", "prediction")


def feature_weights(train: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """L1 weight and tree importance of each feature."""
    l1 = fit_classifier(train, "logistic", features, label, regParam=0.001, elasticNetParam=1.0, maxIter=20).stages[-1]
    forest = fit_classifier(train, "forest", features, label, seed=0).stages[-1]
    rows = [
        (f, float(w), float(v))
        for f, w, v in zip(features, l1.coefficients.toArray(), forest.featureImportances.toArray())
    ]
    return train.sparkSession.createDataFrame(rows, "feature string, l1_weight double, importance double")


def greedy_features(train: DataFrame, test: DataFrame, features: list[str], keep: int, label: str = "label") -> DataFrame:
    """Forward selection: each round adds the feature with the best test AUC."""
    chosen, rows = [], []
    train, test = stage(train.select(*features, label), "train"), stage(test.select(*features, label), "test")
    for step in range(1, keep + 1):
        tried = []
        for f in features:
            if f not in chosen:
                model = fit_classifier(train, "logistic", [*chosen, f], label, maxIter=10)
                tried.append((auc(class_prob(model, test), "prob", label).first()["auc"] or 0.0, f))
        best = max(tried, key=lambda x: (x[0], x[1]))
        chosen.append(best[1])
        rows.append((step, best[1], float(best[0])))
    return train.sparkSession.createDataFrame(rows, "step int, feature string, auc double")


def stacked(rows: DataFrame, key: str, features: list[str], kinds: list[str], folds: int = 3, label: str = "label") -> DataFrame:
    """Out-of-fold probabilities of several models and a logistic regression over them."""
    base = stage(rows.select(key, label, *features, fold(key, folds, "stack").alias("fold")), "stack_base")
    parts = None
    for i in range(folds):
        held = base.filter(F.col("fold") == i)
        for kind in kinds:
            held = class_prob(fit_classifier(base.filter(F.col("fold") != i), kind, features, label), held, f"p_{kind}")
        parts = held if parts is None else parts.unionByName(held)
    parts = stage(parts, "out_of_fold")
    names = [f"p_{k}" for k in kinds]
    return class_prob(fit_classifier(parts, "logistic", names, label), parts).select(key, label, *names, "prob")


# Naive Bayes -------------------------------------------------------------------------------------------------------


def naive_bayes_table(rows: DataFrame, features: list[str], label: str) -> DataFrame:
    """P(value | label) with one added per value: (n + 1) / (n of label + values of the feature)."""
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])
    flat = rows.select(F.col(label).alias("label"), F.inline(parts))
    counts = flat.groupBy("feature", "value", "label").agg(F.count(F.lit(1)).alias("n"))
    per_label = counts.groupBy("feature", "label").agg(F.sum("n").alias("total"))
    values = counts.select("feature", "value").distinct()
    levels = values.groupBy("feature").agg(F.count(F.lit(1)).alias("levels"))
    # Every value with every label, so that unseen pairs get their share too. Both sides are keyed by the feature.
    grid = values.join(per_label, "feature").join(levels, "feature")
    full = grid.join(counts, ["feature", "value", "label"], "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    return full.select(
        "feature", "value", "label", n.cast("bigint").alias("n"),
        ((n + 1.0) / (F.col("total") + F.col("levels"))).alias("prob"),
    )


def naive_bayes_predict(rows: DataFrame, table: DataFrame, priors: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Best label per row: ln prior plus the ln probabilities of its values. Unknown values are left out.

    Each feature adds one array, an entry per label in label order, so a row is scored where it lies.
    """
    by_label = F.array_sort(F.collect_list(F.struct("label", F.ln("p").alias("lp"))))
    start = priors.select("label", F.col("prior").alias("p")).agg(by_label).scalar()
    scored = rows.select(key, *[F.col(f).cast("string").alias(f"__{f}") for f in features])
    for f in features:
        values = table.filter(F.col("feature") == f).select(F.col("value").alias(f"__{f}"), "label", F.col("prob").alias("p"))
        scored = spread_join(scored, values.groupBy(f"__{f}").agg(by_label.alias(f"__lp_{f}")), f"__{f}", "left")
    scored = scored.withColumn("__sum", start)
    for f in features:
        more = F.zip_with("__sum", f"__lp_{f}", lambda x, y: F.struct(x["label"].alias("label"), (x["lp"] + y["lp"]).alias("lp")))
        scored = scored.withColumn("__sum", F.when(F.col(f"__lp_{f}").isNull(), F.col("__sum")).otherwise(more))
    best = F.array_max(F.transform("__sum", lambda x: F.struct(x["lp"].alias("score"), x["label"].alias("label"))))
    return scored.select(key, best["label"].alias("predicted"), best["score"].alias("score"))


def class_priors(rows: DataFrame, label: str) -> DataFrame:
    """(n + 1) / (rows + labels)."""
    counts = rows.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    both = counts.agg((F.sum("n") + F.count(F.lit(1))).cast("double")).scalar()
    return counts.select("label", ((F.col("n") + 1.0) / both).alias("prior"))


def anomaly_scores(rows: DataFrame, group: str, value: str) -> DataFrame:
    """z-score of a value within its group."""
    v = F.col(value).cast("double")
    stats = rows.groupBy(group).agg(
        F.avg(v).alias("__m"), F.stddev_samp(v).alias("__d"), F.count(F.lit(1)).alias("cnt")
    )
    joined = spread_join(rows, stats.select(group, "__m", "__d"), group, weights=stats, nulls=True)
    return joined.withColumn("z", (v - F.col("__m")) / F.nullif(F.col("__d"), F.lit(0.0))).drop("__m", "__d")
