"""Training, prediction with confidence, explanation and evaluation of classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LinearSVC, LogisticRegression, NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions import text as tx
from broadsheet.functions import wordlists as wl
from broadsheet.operators.features import TfidfModel, fit_tfidf, vector_stages
from broadsheet.operators.relational import confidence_band, top_classes
from broadsheet.plans.sized import with_scalars


def classifiers(trees: int = 100, iterations: int = 100, seed: int = 42) -> dict[str, object]:
    args = {"featuresCol": "features", "labelCol": "_label"}
    return {
        "logistic_regression": LogisticRegression(maxIter=iterations, regParam=0.01, **args),
        "naive_bayes": NaiveBayes(smoothing=1.0, **args),
        "svm": OneVsRest(classifier=LinearSVC(maxIter=iterations, regParam=0.01), **args),
        "random_forest": RandomForestClassifier(numTrees=trees, seed=seed, **args),
    }


def text_pipeline(train: DataFrame, id_col: str, tokens_col: str, label_col: str, estimator, lo: int = 1, hi: int = 1,
                  max_features: int = 5000) -> PipelineModel:
    """Index the label, weigh the tokens, fit the estimator; one saved pipeline."""
    model = fit_tfidf(train, id_col, tokens_col, max_features=max_features, lo=lo, hi=hi)
    index = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep")
    return Pipeline(stages=[index, *vector_stages(model, tokens_col), estimator]).fit(train)


def train_classifiers(train: DataFrame, validation: DataFrame, label_col: str, names: Sequence[str] | None = None, **options) -> dict[str, tuple[PipelineModel, float]]:
    """Fit each model on tables that already carry a `features` vector; model and validation accuracy by name."""
    index = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc").fit(train)
    data, held = index.transform(train).cache(), index.transform(validation)
    score = MulticlassClassificationEvaluator(labelCol="_label", metricName="accuracy")
    out = {}
    try:
        for name, estimator in classifiers(**options).items():
            if names is None or name in names:
                fitted = estimator.fit(data)
                out[name] = (PipelineModel([index, fitted]), score.evaluate(fitted.transform(held)))
    finally:
        data.unpersist()
    return out


def best_model(trained: Mapping[str, tuple[PipelineModel, float]]) -> str:
    return max(sorted(trained), key=lambda n: trained[n][1])


def tune(df: DataFrame, label_col: str, grid: Mapping[str, Sequence] | None = None, folds: int = 5, parallelism: int = 4):
    """Cross-validated logistic regression; (model, mean accuracy, std) of the best grid point."""
    index = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc").fit(df)
    lr = LogisticRegression(labelCol="_label", maxIter=50)
    builder = ParamGridBuilder()
    for name, values in (grid or {"regParam": [0.001, 0.01, 0.1]}).items():
        builder = builder.addGrid(lr.getParam(name), list(values))
    cv = CrossValidator(estimator=lr, estimatorParamMaps=builder.build(), numFolds=folds, parallelism=parallelism, seed=42,
                        evaluator=MulticlassClassificationEvaluator(labelCol="_label", metricName="accuracy"))
    model = cv.fit(index.transform(df))
    best = max(range(len(model.avgMetrics)), key=lambda i: model.avgMetrics[i])
    return PipelineModel([index, model.bestModel]), model.avgMetrics[best], model.stdMetrics[best]


def class_names(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def predict_with_confidence(model: PipelineModel, df: DataFrame, id_col: str, k: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """Class, confidence, band and the k best classes per row."""
    names = class_names(model)
    out = model.transform(df).withColumn("_p", F.slice(vector_to_array("probability"), 1, len(names)))
    top = top_classes(F.col("_p"), names, k)
    return out.withColumn("top", top).select(
        id_col, *keep, F.get("top", F.lit(0))["class"].alias("predicted"), F.get("top", F.lit(0))["probability"].alias("confidence"),
        "top").withColumn("band", confidence_band(F.col("confidence")))


def ensemble_predict(models: Mapping[str, PipelineModel], df: DataFrame, id_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Mean probability of fitted models, all applied in one pass without a join. Models must give probabilities."""
    out, arrays = df, []
    names = class_names(next(iter(models.values())))
    for name, model in models.items():
        fitted = model.stages[-1]
        if not hasattr(fitted, "setProbabilityCol"):
            raise ValueError(f"{name} gives no probabilities; leave it out of the ensemble")
        scored = fitted.copy()
        scored.setPredictionCol(f"_pred_{name}").setRawPredictionCol(f"_raw_{name}").setProbabilityCol(f"_prob_{name}")
        out = scored.transform(out)
        arrays.append(vector_to_array(f"_prob_{name}"))
    mean = arrays[0]
    for a in arrays[1:]:
        mean = F.zip_with(mean, a, lambda x, y: x + y)
    mean = F.transform(mean, lambda x: x / len(arrays))
    out = out.withColumn("_top", top_classes(mean, names, 3))
    best = F.get("_top", F.lit(0))
    return out.select(id_col, *keep, best["class"].alias("predicted"), best["probability"].alias("confidence"))


def coefficient_table(model: PipelineModel, vocabulary: Sequence[str], spark) -> DataFrame:
    """label, term, weight of a linear model: classes x vocabulary numbers."""
    lr = model.stages[-1]
    names = class_names(model)
    m = lr.coefficientMatrix.toArray()
    if m.shape[0] == 1:
        rows = [(names[1], t, float(w)) for t, w in zip(vocabulary, m[0])] + [(names[0], t, -float(w)) for t, w in zip(vocabulary, m[0])]
    else:
        rows = [(names[c], t, float(w)) for c in range(min(len(names), m.shape[0])) for t, w in zip(vocabulary, m[c])]
    return spark.createDataFrame(rows, "predicted string, term string, weight double")


def explain_prediction(predictions: DataFrame, values: DataFrame, coefficients: DataFrame, id_col: str, k: int = 10) -> DataFrame:
    """Terms that push each row most towards its predicted class. values: id, term, value."""
    joined = values.join(predictions.select(id_col, "predicted"), id_col).join(F.broadcast(coefficients), ["predicted", "term"])
    scored = joined.withColumn("contribution", F.col("value") * F.col("weight"))
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy(F.abs("contribution").desc(), "term"))  # one document
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select(id_col, "predicted", "term", "contribution", "rank")


def forest_importances(model: PipelineModel, names: Sequence[str], spark, k: int = 10) -> DataFrame:
    v = model.stages[-1].featureImportances
    rows = sorted(((names[int(i)], float(x)) for i, x in zip(v.indices, v.values)), key=lambda r: (-r[1], r[0]))[:k]
    return spark.createDataFrame(rows, "feature string, importance double")


# ---- evaluation ----------------------------------------------------------------------------------------------

def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(truth).cast("string").alias("truth"), F.col(pred).cast("string").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """class, precision, recall, f1, support for every class, and rows for accuracy, macro and weighted averages."""
    cells = confusion(df, truth, pred)
    hits = cells.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    said = cells.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("said"))
    per = hits.join(said, "class", "full").na.fill(0)
    per = per.withColumns({"precision": tx.ratio(F.col("tp"), F.col("said")), "recall": tx.ratio(F.col("tp"), F.col("support"))})
    per = per.withColumn("f1", tx.ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    cols = ["class", "precision", "recall", "f1", "support"]
    s = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), s.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"), *[(F.sum(F.col(c) * F.col("support")) / s).alias(c) for c in ("precision", "recall", "f1")], s.alias("support"))
    acc = F.sum("tp") / s
    accuracy = per.agg(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), s.alias("support"))
    return per.select(*cols).unionByName(macro.select(*cols)).unionByName(weighted.select(*cols)).unionByName(accuracy.select(*cols))


def calibration_bins(df: DataFrame, probability: str, correct: Column, bins: int = 10) -> DataFrame:
    """Accuracy, mean confidence and rows per equal bin, with the expected calibration error. Probability 1 joins the last bin."""
    b = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1))
    per = df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("rows"), F.avg(correct.cast("int")).alias("accuracy"), F.avg(probability).alias("mean_confidence"))
    ece = per.agg((F.sum(F.abs(F.col("accuracy") - F.col("mean_confidence")) * F.col("rows")) / F.sum("rows")).alias("ece"))
    return with_scalars(per, ece)


def ensemble_agreement(p1: Column, p2: Column) -> Column:
    return F.least(F.lit(1.0), p1 / (p2 + 0.1))


def compare_models(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per class of two reports: F1 of both, absolute and relative difference."""
    x = a.select("class", F.col("f1").alias("f1_model"))
    y = b.select("class", F.col("f1").alias("f1_baseline"))
    d = F.col("f1_model") - F.col("f1_baseline")
    return x.join(y, "class").withColumns({"difference": d, "relative": F.when(F.col("f1_baseline") > 0, d / F.col("f1_baseline"))})


def prediction_rationale(df: DataFrame, text_col: str, label_col: str, confidence_col: str, words: Mapping[str, Sequence[str]] = wl.RATIONALE_WORDS) -> DataFrame:
    """Confidence phrase and up to three indicator words of the predicted class."""
    low = F.lower(text_col)
    found = F.array().cast("array<string>")
    for label, terms in words.items():
        found = F.when(F.col(label_col) == label, F.slice(tx.contained(low, terms), 1, 3)).otherwise(found)
    c = F.col(confidence_col)
    phrase = F.when(c > 0.8, "High confidence").when(c > 0.6, "Moderate confidence").otherwise("Low confidence")
    df = df.withColumn("indicators", found)
    return df.withColumn("rationale", F.concat(phrase, F.lit(" classification as "), F.col(label_col),
                                               F.when(F.size("indicators") > 0, F.concat(F.lit(" based on: "), F.array_join("indicators", ", "))).otherwise("")))


def train_intent(examples: DataFrame, id_col: str, tokens_col: str, label_col: str) -> tuple[PipelineModel, TfidfModel]:
    """TF-IDF of the given n-grams and logistic regression on a labelled example table."""
    model = fit_tfidf(examples, id_col, tokens_col, min_df=1, max_df=1.0, lo=1, hi=1)
    index = StringIndexer(inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc")
    lr = LogisticRegression(labelCol="_label", maxIter=100)
    fitted = Pipeline(stages=[index, *vector_stages(model, tokens_col), lr]).fit(examples)
    return fitted, model


def with_names(model: PipelineModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    return IndexToString(inputCol="prediction", outputCol=out, labels=class_names(model)).transform(df)
