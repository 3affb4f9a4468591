"""Classifiers, searches and scores; MLlib does the numerics.

Only the interface follows the data work described in the README: MLlib's models
are not the same as those of other libraries and give other scores.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.evaluation import (
    average_precision, confusion_counts, f_betas, fisher_scores)
from loomframe.operators.joins import union_all
from loomframe.operators.relational import exact_quantiles
from loomframe.session import stored

VECTOR = "features"


def assemble(df: DataFrame, features: Sequence[str], out: str = VECTOR) -> DataFrame:
    """Feature vector of numeric columns or, for a single array column, of that."""
    if len(features) == 1 and df.schema[features[0]].dataType.typeName() == "array":
        return df.withColumn(out, array_to_vector(F.col(features[0]).cast("array<double>")))
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def _fit(estimator, df: DataFrame, features: Sequence[str], label: str):
    rows = assemble(df.withColumn(label, F.col(label).cast("double")), features)
    return estimator.setFeaturesCol(VECTOR).setLabelCol(label).fit(rows)


def fit_forest(df: DataFrame, features: Sequence[str], label: str, seed: int = 0, **params):
    return _fit(RandomForestClassifier(seed=seed, **params), df, features, label)


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, seed: int = 0, **params):
    """Boosted trees with logistic loss."""
    return _fit(GBTClassifier(seed=seed, **params), df, features, label)


def fourier_features(df: DataFrame, features: Sequence[str], dim: int, gamma: float,
                     seed: int = 0) -> DataFrame:
    """``rff``: random cosines whose products stand in for exp(-gamma·|x - y|²)."""
    draw = random.Random(seed)
    spread = math.sqrt(2 * gamma)
    # One row of weights per cosine, its shift last; a text literal keeps the plan
    # small and is turned into an array once, when the plan is optimised.
    rows = [[*[draw.gauss(0, spread) for _ in features], draw.uniform(0, 2 * math.pi)]
            for _ in range(dim)]
    weights = F.from_json(F.lit(json.dumps(rows)), "array<array<double>>")
    values = F.array(*[F.col(c).cast("double") for c in features], F.lit(1.0))

    def cosine(row: Column) -> Column:
        products = F.zip_with(row, values, lambda w, v: w * v)
        return F.cos(F.aggregate(products, F.lit(0.0), lambda a, x: a + x)) * math.sqrt(2 / dim)

    return df.withColumn("rff", F.transform(weights, cosine))


def fit_svm(df: DataFrame, features: Sequence[str], label: str, rff_dim: int = 0,
            gamma: float = 1.0, seed: int = 0, **params):
    """Max-margin classifier; with ``rff_dim`` on random Fourier features."""
    if rff_dim:
        df, features = fourier_features(df, features, rff_dim, gamma, seed), ["rff"]
    return _fit(LinearSVC(**params), df, features, label)


def fit_mlp(df: DataFrame, features: Sequence[str], label: str, layers: Sequence[int],
            seed: int = 0, **params):
    """Feed-forward net on (flattened) windows; layers include input and output size."""
    return _fit(MultilayerPerceptronClassifier(layers=list(layers), seed=seed, **params),
                df, features, label)


def predict(model, df: DataFrame, keep: Sequence[str], features: Sequence[str],
            mode: str = "probability") -> DataFrame:
    """The ``keep`` columns with the chance of class 1, the class, or the margin."""
    scored = model.transform(assemble(df, features))
    value = {"probability": lambda: vector_to_array("probability")[1],
             "margin": lambda: vector_to_array("rawPrediction")[1],
             "class": lambda: F.col("prediction").cast("int")}[mode]()
    return scored.select(*keep, value.alias("prediction"))


def feature_importances(model, names: Sequence[str], spark) -> DataFrame:
    """Importance and its std over the trees, largest first (one row per feature)."""
    trees = [t.featureImportances.toArray() for t in model.trees]
    whole = model.featureImportances.toArray()
    rows = []
    for i, name in enumerate(names):
        values = [float(t[i]) for t in trees]
        mean = sum(values) / len(values)
        std = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
        rows.append((name, float(whole[i]), std))
    return spark.createDataFrame(rows, "feature string, importance double, std double").orderBy(
        F.desc("importance"), "feature")


# -- projections and one-class scores -----------------------------------------


def pca(df: DataFrame, features: Sequence[str], k: int, keep: Sequence[str]) -> DataFrame:
    rows = assemble(df, features)
    model = PCA(k=k, inputCol=VECTOR, outputCol="_pc").fit(rows)
    parts = vector_to_array("_pc")
    return model.transform(rows).select(*keep, *[parts[i].alias(f"pc{i + 1}") for i in range(k)])


def reconstruction_error(train: DataFrame, test: DataFrame, features: Sequence[str], k: int,
                         keep: Sequence[str], label: str = "Class") -> DataFrame:
    """Mean squared distance of a row from the k-component plane of class 0."""
    normal = train.filter(F.col(label) == 0)
    means = normal.agg(*[F.avg(c).alias(c) for c in features]).first()
    centred = {c: F.col(c) - F.lit(means[c]) for c in features}
    model = PCA(k=k, inputCol=VECTOR, outputCol="_pc").fit(
        assemble(normal.withColumns(centred), features))
    axes = model.pc.toArray()
    rows = test.select(*keep, *[centred[c].alias(f"_{c}") for c in features])
    scores = [_dot([F.col(f"_{c}") for c in features], axes[:, j]) for j in range(k)]
    back = [_dot(scores, axes[i, :]) for i in range(len(features))]
    errors = [(F.col(f"_{c}") - b) * (F.col(f"_{c}") - b) for c, b in zip(features, back)]
    return rows.select(*keep, (sum(errors[1:], errors[0]) / len(features)).alias("error"))


def _dot(columns: Sequence[Column], weights) -> Column:
    terms = [c * F.lit(float(w)) for c, w in zip(columns, weights)]
    return sum(terms[1:], terms[0])


def one_class_outliers(train: DataFrame, test: DataFrame, cols: Sequence[str], nu: float,
                       keep: Sequence[str], label: str = "Class") -> DataFrame:
    """Flag rows farther from the class-0 centre, in class-0 stds, than a share
    ``1 - nu`` of class 0."""
    normal = train.filter(F.col(label) == 0)
    s = normal.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (
        ("mean", F.avg), ("std", F.stddev_pop))]).first()
    terms = [F.pow((F.col(c) - F.lit(s[f"mean_{c}"])) / F.lit(s[f"std_{c}"] or 1.0), F.lit(2.0))
             for c in cols]
    distance = F.sqrt(sum(terms[1:], terms[0]))
    cut = exact_quantiles(normal.select(distance.alias("d")), ["d"], {"cut": 1 - nu}).first()
    return test.select(*keep, distance.alias("distance"),
                       (distance > F.lit(cut["cut"])).cast("int").alias("outlier"))


# -- searches -----------------------------------------------------------------


def draw_parameters(space: Mapping[str, Sequence | tuple[float, float]], n: int,
                    seed: int = 0) -> list[dict]:
    """n draws; a list gives one of its values, a tuple (a, b) gives 10^U(a, b)."""
    draw = random.Random(seed)
    return [{name: 10 ** draw.uniform(*values) if isinstance(values, tuple)
             else draw.choice(list(values)) for name, values in space.items()}
            for _ in range(n)]


def random_search(df: DataFrame, folds: DataFrame, fit: Callable, space: Mapping, n: int,
                  row_id: str, features: Sequence[str], label: str, seed: int = 0,
                  betas: Sequence[float] = (1, 10, 50)) -> DataFrame:
    """Confusion counts and F measures per (parameters, fold).

    The fits run one after the other, each distributed; the number of fits is the
    caller's n times the folds.  Counts stay on the cluster until read.
    """
    fold_ids = [r[0] for r in folds.select("fold").distinct().orderBy("fold").collect()]
    joined = stored(folds.join(df, row_id))
    results = []
    for model_id, params in enumerate(draw_parameters(space, n, seed)):
        for fold in fold_ids:
            rows = joined.filter(F.col("fold") == fold)
            model = fit(rows.filter(F.col("role") == "train"), features, label, **params)
            guess = predict(model, rows.filter(F.col("role") == "test"), [row_id, label],
                            features, "class")
            counts = confusion_counts(guess, label, "prediction").select(
                F.lit(model_id).alias("model"),
                F.create_map(*[F.lit(str(x)) for kv in params.items() for x in kv])
                .alias("params"), F.lit(fold).alias("fold"), "*")
            results.append(f_betas(counts, betas))
    return union_all(results)


def grid_scores(train: DataFrame, test: DataFrame, fit: Callable, grid: Mapping[str, Sequence],
                features: Sequence[str], label: str, keep: Sequence[str]) -> DataFrame:
    """Average precision for each pair of two parameters: rows by the first, one
    column per value of the second."""
    (row_name, row_values), (col_name, col_values) = grid.items()
    cells = []
    for a in row_values:
        for b in col_values:
            model = fit(train, features, label, **{row_name: a, col_name: b})
            scored = predict(model, test, [*keep, label], features, "margin")
            cells.append(average_precision(scored, "prediction", label).select(
                F.lit(a).alias(row_name), F.lit(str(b)).alias(col_name), "average_precision"))
    return union_all(cells).groupBy(row_name).pivot(
        col_name, [str(b) for b in col_values]).agg(F.first("average_precision"))


def ablation(df: DataFrame, features: Sequence[str], label: str,
             scorer: Callable[[Sequence[str]], DataFrame]) -> DataFrame:
    """Drop features in ascending discriminant order; score what is left each time."""
    order = [r["column"] for r in fisher_scores(df, features, label).collect()]
    steps = []
    for i in range(len(order)):
        left = [c for c in features if c not in order[:i]]
        steps.append(scorer(left).select(
            F.lit(i).alias("step"), F.lit(order[i - 1] if i else None).cast("string")
            .alias("dropped"), F.lit(len(left)).alias("features"), "*"))
    return union_all(steps)
