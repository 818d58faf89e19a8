"""Model fitting, search and scoring with Spark ML.

Every fit is a distributed MLlib job; the driver only loops over a bounded
set of configurations (grid points, hierarchy levels).  Inputs are cached
once before multi-model work so each fit does not re-read the sources.
"""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.operators.extratrees import ExtraTreesRegressor
from patchlens.operators.forest import BoostedRegressor, ForestRegressor
from patchlens.operators.textvec import TextTerms
from patchlens.operators.tfidf import TfidfVectorizer


def assembler(cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def to_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bool/int -> double, null -> 0 (what the assembler expects)."""
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


#: Rows that are worth a task of a numeric fit, and the most that one task holds.
SPREAD_ROWS = 25_000
SPREAD_MOST = 250_000


def spread(rows: DataFrame) -> DataFrame:
    """Narrow training rows on the cores that they keep busy; rows that are few, or already on no more tasks, stay where they are.

    For each level of a forest, every task adds up and shuffles sums of all open
    nodes of all trees, so tasks beyond the cores cost time and shuffle without need.
    """
    cores, n = rows.sparkSession.sparkContext.defaultParallelism, rows.count()
    tasks = max(1, min(cores, -(-n // SPREAD_ROWS)))
    if n > cores * SPREAD_MOST:
        tasks = -(-n // (cores * SPREAD_MOST)) * cores
    parts = rows.rdd.getNumPartitions()
    if tasks > parts:
        return rows.repartition(tasks)
    return rows.coalesce(tasks) if parts > cores else rows


def gathered(rows: DataFrame, n: int | None = None, fits: int = 1, least: int = SPREAD_ROWS) -> DataFrame:
    """Rows (``n`` if known) for a fit of many short jobs, one of ``fits`` at once, on the tasks that they keep busy with ``least`` rows each.

    A job of one task needs no second stage to add up the tasks' sums.
    """
    n = rows.count() if n is None else n
    tasks = max(1, min(rows.sparkSession.sparkContext.defaultParallelism // fits, -(-n // least)))
    return rows.coalesce(tasks if fits == 1 else max(tasks, -(-n // SPREAD_MOST)))


def random_forest(label: str = "label", weight: str | None = None, trees: int = 100, depth: int = 10,
                  seed: int = 42, **kw) -> RandomForestClassifier:
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, **kw)
    if weight:
        rf.setWeightCol(weight)
    return rf


def numeric_estimator(cols: list[str], estimator, scale: bool = False) -> Pipeline:
    stages = [assembler(cols, "raw_features" if scale else "features")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=stages + [estimator])


def clean_stage(text: str) -> SQLTransformer:
    """A null or blank text is 'unknown': column ``_known``."""
    return SQLTransformer(statement=f"SELECT *, CASE WHEN {text} IS NULL OR trim({text}) = '' THEN 'unknown' ELSE {text} END AS _known FROM __THIS__")


def text_stages(text: str, bigrams: bool = True) -> list:
    """Clean -> tokens without stop words, with their bigrams -> column ``_terms`` (transformers only)."""
    return [clean_stage(text), TextTerms(inputCol="_known", outputCol="_terms", bigrams=bigrams)]


def text_model_stages(label: str = "label", kind: str = "logistic", vocab_size: int = 10000,
                      max_iter: int = 1000, parts: int = 0, terms: str = "_terms") -> list:
    """Exact smoothed TF-IDF -> classifier over ``terms``, an array of terms or a text; the terms are counted in ``parts`` partitions."""
    clf = (LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter) if kind == "logistic"
           else NaiveBayes(labelCol=label, featuresCol="features", modelType="multinomial"))
    return [TfidfVectorizer(inputCol=terms, outputCol="features", maxFeatures=vocab_size, parts=parts), clf]


def text_estimator(text: str, label: str = "label", kind: str = "logistic", vocab_size: int = 10000,
                  bigrams: bool = True, parts: int = 0) -> Pipeline:
    """Tokenisation + TF-IDF + classifier as one pipeline."""
    if bigrams:  # the vectoriser makes the terms itself
        return Pipeline(stages=[clean_stage(text), *text_model_stages(label, kind, vocab_size, parts=parts, terms="_known")])
    return Pipeline(stages=text_stages(text, bigrams) + text_model_stages(label, kind, vocab_size, parts=parts))


def fit_text(train: DataFrame, text: str, label: str = "label", kind: str = "logistic", vocab_size: int = 10000, parts: int = 0) -> PipelineModel:
    """The fitted ``text_estimator``; the weights are made once, for all passes of the classifier."""
    clean = clean_stage(text)
    tfidf, classifier = text_model_stages(label, kind, vocab_size, parts=parts, terms="_known")
    known = clean.transform(train)
    weigh = tfidf.fit(known)
    weights = weigh.transform(known).select(label, "features").checkpoint(eager=True)
    return PipelineModel(stages=[clean, weigh, classifier.fit(gathered(weights, least=2 * SPREAD_ROWS))])


def positive_probability(pred: DataFrame, out: str = "p") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


def max_probability(pred: DataFrame, out: str = "confidence") -> DataFrame:
    return pred.withColumn(out, F.array_max(vector_to_array("probability")))


def f1_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def random_search(train: DataFrame, pipeline: Pipeline, grid, fold_col: str, n_iter: int = 10,
                  seed: int = 42, label: str = "label", parallelism: int = 2):
    """A seeded subset of the grid, cross-validated on a precomputed fold column."""
    maps = list(grid)
    rnd = random.Random(seed)
    picked = maps if len(maps) <= n_iter else rnd.sample(maps, n_iter)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=picked, evaluator=f1_evaluator(label),
                        foldCol=fold_col, parallelism=parallelism, seed=seed)
    return cv.fit(train)


def traditional_regressor(label: str, trees: int = 300, depth: int = 20, seed: int = 42) -> ForestRegressor:
    """The plain evaluator: one forest."""
    return ForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed)


def regressors(label: str, trees: int = 200, extra_trees: int = 150, iters: int = 150, depth: int = 15, gbt_depth: int = 8,
               extra_depth: int = 15, seed: int = 42) -> dict:
    """The candidates of the attention evaluator (``extra_depth``: levels of the extremely randomised trees)."""
    return {
        "random_forest": ForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed),
        "extra_trees": ExtraTreesRegressor(labelCol=label, numTrees=extra_trees, maxDepth=extra_depth, seed=seed),
        "gbt": BoostedRegressor(labelCol=label, maxIter=iters, maxDepth=gbt_depth, stepSize=0.1, seed=seed),
    }


def select_k_best(df: DataFrame, k: int, label: str = "label") -> UnivariateFeatureSelector:
    sel = UnivariateFeatureSelector(featuresCol="features", labelCol=label, outputCol="selected",
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k)
    return sel


def importances(model, cols: list[str], name: str, spark) -> DataFrame:
    """Feature importances of a fitted tree model as a long table."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(name, i, c, float(v)) for i, (c, v) in enumerate(zip(cols, imp))],
                                 "model string, position int, feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def parallel_fits(fn, items, parallelism: int = 4) -> list:
    """Run independent fits concurrently, as ``CrossValidator(parallelism=...)`` does:
    a few driver threads each submit their own Spark jobs; executors do the work."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(fn, items))


def grid(builder_pairs) -> list:
    b = ParamGridBuilder()
    for param, values in builder_pairs:
        b = b.addGrid(param, values)
    return b.build()
