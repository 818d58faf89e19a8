"""Model fits, searches and model-based generation.

Rows-only checks: the results depend on fitted models.  Invariants are
asserted in tests (probabilities in [0, 1], one prediction per input row,
bounded summaries).  Tree counts, depths, iterations and grids are the
parameters' defaults in ``operators.models``; where those take minutes per fit
the queries pass smaller sizes, named below.  Frames that several fits share
are cached for their time and released after it; results that a query returns
lazily read the split frame from the checkpoint folder instead.
"""

from __future__ import annotations

import random
from decimal import Decimal

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from patchlens import config
from patchlens.operators import boosting as B
from patchlens.operators import features as FE
from patchlens.operators import forest as FO
from patchlens.operators import generate as G
from patchlens.operators import hierarchy as H
from patchlens.operators import labels as L
from patchlens.operators import matrix as M
from patchlens.operators import metrics as MT
from patchlens.operators import models as MD
from patchlens.operators import split as SP
from patchlens.operators import stats as ST
from patchlens.operators import textvec as TV
from patchlens.operators import tuning as TU
from patchlens.functions import rowstats as RS
from patchlens.plans.catalog_prepare import scheduling_features
from patchlens.plans.registry import query
from patchlens.sources.tables import patch_view, table


def _matrix(spark, sf_dir):
    """Feature matrix + split + balanced weights, computed once for multi-model work."""
    feats = scheduling_features(spark, sf_dir)
    m = M.ml_matrix(feats, "patch_id", "accepted")
    cols = [c for c in m.columns if c not in ("patch_id", "accepted")]
    m = MD.to_double(m, cols).withColumn("label", F.col("accepted").cast("double"))
    m = SP.stratified_split(m, "patch_id", "accepted", Decimal("0.2"), Decimal("0.25"))
    m = MT.weight_column(m, "accepted")
    # written once to the checkpoint folder: several fits and the lazy scores read it there
    return m.checkpoint(eager=True), cols


def _score(model, df):
    return MD.positive_probability(model.transform(df)).select("patch_id", "split", "accepted", "prediction", "p")


@query("train_rf")
def train_rf(spark, sf_dir):
    m, cols = _matrix(spark, sf_dir)
    model = MD.numeric_estimator(cols, MD.random_forest(weight="weight")).fit(MD.spread(m.filter("split = 'train'")))
    return _score(model, m.filter("split <> 'train'"))


# two boosted-tree configurations (the analysed tool trains two boosting libraries): level by level, and best leaf first
BOOST_ROUNDS = 100
LEAF_WISE = dict(depth=-1, num_leaves=31, reg_lambda=0.0, min_child_weight=1e-3, min_child_rows=20)
GBT_CONFIGS = {"xgboost": B.Boost(rounds=BOOST_ROUNDS, depth=3), "lightgbm": B.Boost(rounds=BOOST_ROUNDS, **LEAF_WISE)}
BINARY = ["0", "1"]


def fit_boosted(rows, cols, configs) -> B.Boosted:
    """All configurations in one boosting run over the labelled, weighted rows."""
    long = rows.withColumn("_model", F.explode(F.array(*[F.lit(n) for n in configs])))
    return B.fit(long, cols, F.col("accepted").cast("string"), configs, model=F.col("_model"), weight=F.col("weight"),
                 key=F.xxhash64("patch_id"), classes={n: BINARY for n in configs})


#: Beyond so many rows the forest over four columns is fitted on their cells; MLlib keeps a count of each row for each tree.
FOREST_ROWS = 2_000_000


@query("train_rf_volume")
def train_rf_volume(spark, sf_dir):
    """Forest on the largest table: lineitem numerics -> returned flag, stratified 60/20/20, test scores."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
        *[F.col(c).cast("double").alias(c) for c in cols],
        (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    d = SP.stratified_split(li, "line_id", "returned", Decimal("0.2"), Decimal("0.25"))
    d = MT.weight_column(d.withColumn("label", F.col("returned").cast("double")), "returned")
    if li.count() > FOREST_ROWS and (cells := FO.fit_cells(d.filter("split = 'train'"), cols, "label", "weight")):
        # the rows are read again for each step: written out, they take more disk than the table
        return cells.transform(d.filter("split = 'test'")).select("line_id", "returned", "prediction", "p")
    d = d.checkpoint(eager=True)
    model = MD.numeric_estimator(cols, MD.random_forest(weight="weight")).fit(MD.spread(d.filter("split = 'train'")))
    p = MD.positive_probability(model.transform(d.filter("split = 'test'")))
    return p.select("line_id", "returned", "prediction", "p")


@query("train_gbt")
def train_gbt(spark, sf_dir):
    """Both boosted configurations at 100 rounds, fitted in one run and scored in one pass."""
    m, cols = _matrix(spark, sf_dir)
    scored = fit_boosted(m.filter("split = 'train'"), cols, GBT_CONFIGS).score(
        m.filter("split <> 'train'"), {n: n for n in GBT_CONFIGS})
    stack = ", ".join(f"'{n}', {n}" for n in GBT_CONFIGS)
    return scored.selectExpr("patch_id", "split", "accepted", f"stack({len(GBT_CONFIGS)}, {stack}) AS (config, s)").select(
        "patch_id", "split", "accepted", F.col("s.label").cast("double").alias("prediction"), F.col("s.probability")[1].alias("p"), "config")


def _text_split(spark, sf_dir):
    """Subjects with labels and splits, and their partitions; the split itself is fixed on (patch_id, accepted) alone.

    The texts are dealt by id once, to partitions of bounded size, which the label join keeps.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").filter("text IS NOT NULL")
    parts = TV.text_parts(docs, "text")
    pv = patch_view(spark, sf_dir, docs=docs.repartition(parts, "doc_id"))
    pv = L.not_null(pv, "subject").withColumn("label", F.col("accepted").cast("double"))
    return SP.stratified_split(pv, "patch_id", "accepted", Decimal("0.2"), Decimal("0.25")), parts


def _train_text(spark, sf_dir, kind):
    d, parts = _text_split(spark, sf_dir)
    d = MD.clean_stage("subject").transform(d.select("patch_id", "subject", "accepted", "label", "split")).checkpoint(eager=True)
    tfidf, classifier = MD.text_model_stages(kind=kind, vocab_size=5000, parts=parts, terms="_known")
    # the weights are made once, for the fit's passes and the scores
    weights = tfidf.fit(d.filter("split = 'train'")).transform(d).select("patch_id", "accepted", "label", "split", "features").checkpoint(eager=True)
    model = classifier.fit(MD.gathered(weights.filter("split = 'train'")))
    return _score(model, weights.filter("split <> 'train'"))


@query("train_text")
def train_text(spark, sf_dir):
    return _train_text(spark, sf_dir, "logistic")


@query("train_text_bayes")
def train_text_bayes(spark, sf_dir):
    """The same features with multinomial naive Bayes."""
    return _train_text(spark, sf_dir, "naive_bayes")


def _search(spark, sf_dir, estimator, grid_of):
    """10 points of a grid, 3-fold stratified CV on the training split, scored by F1 of the positive class."""
    m, cols = _matrix(spark, sf_dir)
    train = MD.spread(SP.stratified_kfold(m.filter("split = 'train'"), "patch_id", "accepted", k=3).checkpoint(eager=True)).cache()
    cv = MD.random_search(train, MD.numeric_estimator(cols, estimator), MD.grid(grid_of(estimator)), "fold", n_iter=10, parallelism=4)
    train.unpersist()
    rows = [(i, str({p.name: v for p, v in pm.items()}), float(f1))
            for i, (pm, f1) in enumerate(zip(cv.getEstimatorParamMaps(), cv.avgMetrics))]
    return spark.createDataFrame(rows, "candidate int, params string, mean_f1 double")


@query("random_search")
def random_search(spark, sf_dir, trees=(20, 40), depths=(10, 20, 30)):
    """Forest: 10 of 12 points (trees x depth x balanced or unweighted); depth 30, MLlib's largest, stands for unlimited."""
    return _search(spark, sf_dir, MD.random_forest(weight="weight"), lambda rf: [
        (rf.numTrees, list(trees)), (rf.maxDepth, list(depths)), (rf.weightCol, ["weight", ""])])


@query("random_search_boosted")
def random_search_boosted(spark, sf_dir, iters=(20, 40), depths=(3, 6, 9), steps=(0.01, 0.1), n_iter: int = 10, folds: int = 3):
    """Boosted trees with balanced weights: 10 of 12 points (rounds x depth x learning rate), all fits in one boosting run."""
    m, cols = _matrix(spark, sf_dir)
    train = SP.stratified_kfold(m.filter("split = 'train'"), "patch_id", "accepted", k=folds).checkpoint(eager=True)
    points = [(i, d, r) for i in iters for d in depths for r in steps]
    picked = random.Random(42).sample(points, min(n_iter, len(points)))
    configs = {f"{c}-{f}": B.Boost(rounds=i, depth=d, rate=r) for c, (i, d, r) in enumerate(picked) for f in range(folds)}
    name = F.concat(F.col("_c").cast("string"), F.lit("-"), F.col("_f").cast("string"))
    use = train.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(len(picked) - 1)))).withColumn(
        "_f", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).filter(F.col("_f") != F.col("fold"))
    model = B.fit(use, cols, F.col("accepted").cast("string"), configs, model=name, weight=F.col("weight"), key=F.xxhash64("patch_id"),
                  classes={n: BINARY for n in configs})
    # a row is scored by the models of its own fold
    own = {f"c{c}": F.concat(F.lit(f"{c}-"), F.col("fold").cast("string")) for c in range(len(picked))}
    stack = ", ".join(f"{c}, c{c}" for c in range(len(picked)))
    scored = model.score(train.select("patch_id", "accepted", "fold", *cols), own).selectExpr(
        "accepted", "fold", f"stack({len(picked)}, {stack}) AS (candidate, s)").withColumn("_pred", F.col("s.label") == "1")
    f1 = MT.confusion(scored, "accepted", "_pred", by=["candidate", "fold"]).groupBy("candidate").agg(F.avg("f1").alias("mean_f1"))
    params = spark.createDataFrame([(c, str({"rounds": i, "depth": d, "rate": r})) for c, (i, d, r) in enumerate(picked)],
                                   "candidate int, params string")
    return params.join(f1, "candidate").select("candidate", "params", "mean_f1")


@query("grid_search_text")
def grid_search_text(spark, sf_dir):
    """2 x 2 TF-IDF grid (vocabulary 5000 / 10000 x unigrams / +bigrams), scored by F1 on validation."""
    from patchlens.plans.catalog_io import released, scratch

    d, parts = _text_split(spark, sf_dir)
    texts, folder = scratch(spark, "grid-texts"), scratch(spark, "grid-weights")
    d = MD.clean_stage("subject").transform(d.select("patch_id", "subject", "label", "split").filter("split <> 'test'"))
    d.select("_known", "label", "split").write.parquet(texts)
    d = spark.read.parquet(texts)
    points = [(vocab, bigrams) for bigrams in (False, True) for vocab in (5000, 10000)]
    tfidf, classifier = MD.text_model_stages(parts=parts, terms="_known")
    models = tfidf.fit_grid(d.filter("split = 'train'"), points)
    # a text's terms are made once for the weights of all points; the fits' many short jobs then carry no vocabulary
    names = [f"f{i}" for i in range(len(points))]
    models[0].with_all(d, models, names).select("label", "split", *names).write.parquet(folder)
    weights = spark.read.parquet(folder)
    train, val = weights.filter("split = 'train'"), weights.filter("split = 'val'")
    n = train.count()

    def score(i):
        model = classifier.fit(MD.gathered(train.select("label", F.col(names[i]).alias("features")), n, len(points)))
        f1 = MD.f1_evaluator().evaluate(model.transform(val.select("label", F.col(names[i]).alias("features"))))
        return *points[i], float(f1)

    # all points at once
    rows = MD.parallel_fits(score, range(len(points)))
    return released(spark, spark.createDataFrame(rows, "vocab_size int, bigrams boolean, val_f1 double"), texts, folder)


@query("fitted_models")
def fitted_models(spark, sf_dir):
    """Fitted forest and two boosted models -> validation F1 weights -> weighted ensemble; metrics of all on val and test."""
    long, wide, weights = fitted_scores(spark, sf_dir)
    ens = MT.weighted_ensemble(wide, weights).select("patch_id", "split", "accepted", F.lit("ensemble").alias("model"),
                                                     F.col("ens_proba").alias("p"))
    return MT.confusion(long.unionByName(ens).withColumn("_pred", F.col("p") > 0.5), "accepted", "_pred", by=["model", "split"])


def fitted_scores(spark, sf_dir):
    """(patch, split, label, model, p) of three fits, the same in wide form, and the ensemble weights."""
    m, cols = _matrix(spark, sf_dir)
    train, rest = m.filter("split = 'train'"), m.filter("split <> 'train'")
    kinds = ["random_forest", *GBT_CONFIGS]
    fits = MD.parallel_fits(lambda f: f(), [
        lambda: MD.numeric_estimator(cols, MD.random_forest(weight="weight")).fit(MD.spread(train)),
        lambda: fit_boosted(train, cols, GBT_CONFIGS)], parallelism=2)
    wide = rest.select("patch_id", "split", "accepted", *cols)
    wide = MD.positive_probability(fits[0].transform(wide), "random_forest").drop("features", "rawPrediction", "probability", "prediction")
    wide = fits[1].score(wide, {n: n for n in GBT_CONFIGS}).withColumns({n: F.col(f"{n}.probability")[1] for n in GBT_CONFIGS})
    wide = wide.select("patch_id", "split", "accepted", *kinds).checkpoint(eager=True)
    stack = ", ".join(f"'{k}', {k}" for k in kinds)
    long = wide.selectExpr("patch_id", "split", "accepted", f"stack({len(kinds)}, {stack}) AS (model, p)")
    weights = MT.ensemble_weights(long.filter("split = 'val'"), "model", "accepted", "p")
    return long, wide, weights


def _gen_train(spark, sf_dir):
    f = FE.generator_features(patch_view(spark, sf_dir), keyword_sets=config.DOCUMENT_KEYWORDS)
    cols = FE.generator_feature_names()
    # written once: every classifier of the hierarchy and the lazy scores read it there
    return MD.to_double(f, cols).select("patch_id", *[c for c in f.columns if c.startswith("target_")], *cols).checkpoint(eager=True), cols


def _train_target(spark, sf_dir, target):
    f, cols = _gen_train(spark, sf_dir)
    model = B.fit(f, cols, F.col(target), H.boost(), key=F.xxhash64("patch_id"))
    return model.score(f, {"s": "model"}).select("patch_id", target, F.col("s.label").alias("prediction"), F.col("s.confidence").alias("confidence"))


@query("train_subsystem")
def train_subsystem(spark, sf_dir):
    """200 rounds of depth 8 over the subsystem classes, L1 and L2, rows and columns sampled."""
    return _train_target(spark, sf_dir, "target_subsystem")


@query("train_complexity")
def train_complexity(spark, sf_dir):
    """The same booster over the complexity classes."""
    return _train_target(spark, sf_dir, "target_complexity")


def review_targets(spark, sf_dir):
    """Stand-in for reviewed targets from outside the subject: patch_id and one target column each from three tables' columns."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("patch_id"), F.col("source").alias("target_function"),
                                                    F.col("lang").alias("target_condition"))
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("_e"), F.col("event_type").alias("target_action"))
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("_l")).agg(F.max("quality").cast("string").alias("target_primary_variable"))
    return docs.join(ev, F.col("patch_id") == F.col("_e"), "left").join(labels, F.col("patch_id") == F.col("_l"), "left").drop("_e", "_l")


# all models of the hierarchy, each also without the held-out rows, boost at once; the operator's default is 200 rounds
HIERARCHY_ROUNDS = 40


def fitted_hierarchy(spark, sf_dir, rounds: int = HIERARCHY_ROUNDS) -> H.Hierarchy:
    """Both levels on the patch table, level-2 targets from the review table."""
    f, cols = _gen_train(spark, sf_dir)
    return H.fit_hierarchy(H.with_targets(f, review_targets(spark, sf_dir), "patch_id"), cols, "patch_id", H.boost(rounds))


@query("train_hierarchy")
def train_hierarchy(spark, sf_dir):
    """Level 1 (subsystem, complexity) for all rows; level 2 per trainable (group, target); held-out accuracies."""
    return H.summary_table(spark, fitted_hierarchy(spark, sf_dir))


def model_batch(spark, sf_dir):
    """Prompts with labels and confidences of the fitted models of both levels."""
    model = fitted_hierarchy(spark, sf_dir)
    prompts = G.generation_features(G.prompts_from_ids(table(spark, sf_dir, "documents"), "doc_id"))
    missing = [c for c in model.features if c not in prompts.columns]
    prompts = MD.to_double(prompts.withColumns({c: F.lit(0.0) for c in missing}), model.features)
    accs = [a for *_, a in model.summary if a is not None]
    return G.generate(model.predict(prompts), subsystem=F.col("pred_subsystem"), complexity=F.col("pred_complexity"),
                      level1_conf=[F.col("conf_subsystem"), F.col("conf_complexity")],
                      level2={t: (F.col(f"pred_{t}"), F.col(f"conf_{t}")) for t in H.LEVEL2},
                      model_accuracies=F.array(*[F.lit(a) for a in accs]))


@query("generate_model")
def generate_model(spark, sf_dir):
    """Generation with the fitted classifiers of both levels; a target without a model takes the default at confidence 0.3."""
    return model_batch(spark, sf_dir).select("prompt_id", "subsystem", "complexity", *[f"pred_{t}" for t in H.LEVEL2], "code", "confidence",
                                             "accuracy_estimate")


@query("evaluate_model_batch")
def evaluate_model_batch(spark, sf_dir):
    """The generated batch of the fitted models, scored: quality against the models' own confidence."""
    return G.evaluate_batch(model_batch(spark, sf_dir))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Importances of a forest and a boosted model, averaged per feature (D11 on fitted models)."""
    m, cols = _matrix(spark, sf_dir)
    tr = m.filter("split = 'train'")
    rf = MD.numeric_estimator(cols, MD.random_forest()).fit(MD.spread(tr)).stages[-1]
    gb = fit_boosted(tr, cols, {"xgboost": GBT_CONFIGS["xgboost"]}).importances("xgboost")
    boosted = spark.createDataFrame([("gbt", i, c, v) for i, (c, v) in enumerate(zip(cols, gb))],
                                    "model string, position int, feature string, importance double")
    imp = MD.importances(rf, cols, "rf", spark).unionByName(boosted)
    return imp.groupBy("feature").agg(F.avg("importance").alias("mean_importance")).orderBy(F.desc("mean_importance"), "feature")


# ------------------------------------------------------------- meta evaluator

def meta_frame(spark, sf_dir):
    """Meta features per event: per-model score/confidence, ensemble stats, feature-row stats; target = error."""
    # one projection of events gives the scores and the raw feature row (no self-join)
    e = table(spark, sf_dir, "events")
    d = e.select(
        "event_id",
        (F.col("event_type") == "purchase").cast("int").alias("actual"),
        F.try_divide(F.col("value"), F.col("value") + 100).alias("p1"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("p2"),
        (F.hour("ts") / 24.0).alias("p3"),
        "value", F.get_json_object("props", "$.k").cast("double").alias("k"), F.hour("ts").cast("double").alias("hour"),
    )
    arr = F.array("p1", "p2", "p3")
    row = F.array("value", "k", "hour")
    d = d.select("event_id", "actual", "p1", "p2", "p3",
                 *[RS.confidence(m).alias(f"{m}_conf") for m in ("p1", "p2", "p3")],
                 *RS.row_stats(arr), RS.sparsity(row).alias("sparsity"), RS.magnitude(row).alias("magnitude"))
    d = d.withColumn("error", F.abs(F.col("ens_mean") - F.col("actual")))
    d = d.withColumn("sq_error", (F.col("ens_mean") - F.col("actual")) ** 2)
    cols = ["p1", "p2", "p3", "p1_conf", "p2_conf", "p3_conf", "ens_mean", "ens_std", "ens_median", "ens_range",
            "agreement", "variance", "sparsity", "magnitude"]
    return d, cols


def _scaled_attention(frames, cols):
    """Standardise by the first frame, weigh by its attention, and put the target on [0, 1]."""
    train = frames[0]
    fit = ST.fit_moments(train, [*cols, "error"])
    w = {r["feature"]: r["weight"] for r in ST.attention_weights(train, cols, "error").collect()}
    lo, hi = fit["error"]["min"], fit["error"]["max"]
    keep = ["event_id", "error"]
    out = [ST.apply_attention(ST.standard_scale(f, cols, keep, fit), cols, w, keep) for f in frames]
    rng = (hi - lo) if hi != lo else 1.0
    return [f.withColumn("scaled_error", (F.col("error") - F.lit(lo)) / F.lit(rng)) for f in out], lo, hi


def fit_evaluators(train, val, test, cols):
    """MSE and R^2 on ``test`` of both evaluators, at the operators' full sizes: {name: (chosen regressor, mse, r2)}.

    traditional is one forest; attention is the candidate that is best on
    ``val``, fitted on scaled, attention-weighted features and a min-max scaled
    target, with predictions scaled back.
    """
    asm = MD.assembler(cols)
    train = MD.spread(train)
    tr = asm.transform(train).cache()
    frames, lo, hi = _scaled_attention([train, val, test], cols)
    att, va, te = (asm.transform(f).cache() for f in frames)
    kinds = MD.regressors("scaled_error")

    def traditional():
        pred = MD.traditional_regressor("error").fit(tr).transform(asm.transform(test))
        return MT.mse_r2(pred, "error", "prediction").first()

    def candidate(name):
        model = kinds[name].fit(att)
        return name, MT.mse_r2(model.transform(va), "scaled_error", "prediction").first()["mse"], model

    # boosting rounds follow one another, so it begins first
    order = sorted(kinds, key=lambda k: k != "gbt")
    r, *fits = MD.parallel_fits(lambda f: f(), [traditional, *[lambda k=k: candidate(k) for k in order]])
    out = {"traditional": ("random_forest", float(r["mse"]), r["r2"])}
    by_name = {f[0]: f for f in fits}
    best = min((by_name[k] for k in kinds), key=lambda f: f[1])
    back = ST.minmax_inverse(best[2].transform(te), "prediction", lo, hi)
    r = MT.mse_r2(back, "error", "prediction").first()
    for f in (tr, att, va, te):
        f.unpersist()
    out["attention"] = (best[0], float(r["mse"]), r["r2"])
    return out


@query("train_meta")
def train_meta(spark, sf_dir):
    """Both evaluators, fitted on train, the attention one chosen and both scored on validation."""
    d, cols = meta_frame(spark, sf_dir)
    d = SP.stratified_split(d, "event_id", "actual", Decimal("0.2"), Decimal("0.25")).checkpoint(eager=True)
    val = d.filter("split = 'val'")
    got = fit_evaluators(d.filter("split = 'train'"), val, val, cols)
    rows = [(name, model, mse, r2) for name, (model, mse, r2) in got.items()]
    return spark.createDataFrame(rows, "evaluator string, best_model string, val_mse double, val_r2 double")


@query("meta_cv")
def meta_cv(spark, sf_dir):
    """5-fold CV of both evaluators (a fold chooses on a fifth of its training rows); mean and pop std of MSE."""
    d, cols = meta_frame(spark, sf_dir)
    d = SP.kfold(d, "event_id", k=5).checkpoint(eager=True)

    def run(fold):
        inner = SP.stratified_split(d.filter(F.col("fold") != fold), "event_id", "actual", Decimal("0.2"), None, seed=7).checkpoint(eager=True)
        got = fit_evaluators(inner.filter("split = 'train'"), inner.filter("split = 'test'"), d.filter(F.col("fold") == fold), cols)
        return [(name, fold, mse) for name, (_, mse, _) in got.items()]

    rows = [r for part in MD.parallel_fits(run, range(5), parallelism=3) for r in part]
    per = spark.createDataFrame(rows, "evaluator string, fold int, mse double")
    return per.groupBy("evaluator").agg(F.avg("mse").alias("mean_mse"), F.stddev_pop("mse").alias("std_mse"),
                                        F.count(F.lit(1)).alias("n_folds"))


@query("meta_evaluate")
def meta_evaluate(spark, sf_dir):
    """Fit on train, choose on validation, compare on test: MSE, R^2, improvement % and who wins."""
    d, cols = meta_frame(spark, sf_dir)
    d = SP.stratified_split(d, "event_id", "actual", Decimal("0.2"), Decimal("0.25")).checkpoint(eager=True)
    got = fit_evaluators(*[d.filter(F.col("split") == s) for s in ("train", "val", "test")], cols)
    (_, t_mse, t_r2), (_, a_mse, a_r2) = got["traditional"], got["attention"]
    imp = (t_mse - a_mse) / t_mse * 100 if t_mse else None
    return spark.createDataFrame([(t_mse, t_r2, a_mse, a_r2, imp, int(a_mse < t_mse))],
                                 "trad_mse double, trad_r2 double, att_mse double, att_r2 double, "
                                 "improvement_pct double, attention_wins int")


@query("select_k_best")
def select_k_best(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    d = e.select("vec_id", F.col("label").cast("double").alias("label"),
                 *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    cols = [f"e{i}" for i in range(64)]
    v = MD.assembler(cols).transform(d)
    sel = MD.select_k_best(v, config.SELECT_K).fit(v)
    out = sel.transform(v)
    dims = F.array(*[F.lit(i) for i in sel.selectedFeatures])
    return out.select("vec_id", "label", F.lit(len(sel.selectedFeatures)).alias("n_selected"), dims.alias("selected_dims"))


# --------------------------------------------------------------- loop fits

LOOP_START = {TU.RF: {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2},
              TU.XGB: {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1},
              TU.LGB: {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "num_leaves": 31}}
BASELINE_ROWS = 10_000


def _as_text(row: dict) -> dict:
    return {k: None if v is None else str(v) for k, v in row.items()}


PARAM_SCHEMA = ("param_id int, model string, n_estimators string, max_depth string, min_samples_split string, num_leaves string, "
                "learning_rate string, subsample string, reg_alpha string, reg_lambda string")


def _param_rows(spark, params: dict) -> "DataFrame":
    names = [c.split()[0] for c in PARAM_SCHEMA.split(", ")]
    rows = [_as_text({"model": kind} | p) | {"param_id": i} for i, (kind, p) in enumerate(params.items())]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PARAM_SCHEMA)


def _by_kind(rows) -> dict:
    drop = ("param_id", "model", "strategy", "applicable")
    return {r["model"]: {k: v for k, v in r.asDict().items() if k not in drop and v is not None} for r in rows}


def _loop_forest(p: dict, cols: list[str]) -> Pipeline:
    """The forest of a parameter map; ``select_k`` puts the ANOVA selection in front of it."""
    depth = int(p.get("max_depth", -1))
    est = MD.random_forest(weight="weight", trees=int(p["n_estimators"]), depth=depth if depth > 0 else 30,
                           subsamplingRate=min(1.0, float(p.get("subsample") or 1.0)),
                           minInstancesPerNode=max(1, int(p.get("min_samples_split", 2)) // 2))
    if p.get("select_k"):
        sel = MD.select_k_best(None, int(p["select_k"])).setFeaturesCol("all_features").setOutputCol("features")
        return Pipeline(stages=[MD.assembler(cols, "all_features"), sel, est])
    return MD.numeric_estimator(cols, est)


def loop_boost(kind: str, p: dict) -> B.Boost:
    """The booster of a parameter map; unset penalties are the kind's defaults."""
    depth = int(p.get("max_depth", -1))
    base = dict(rounds=int(p["n_estimators"]), depth=depth, rate=float(p.get("learning_rate", 0.1)),
                subsample=min(1.0, float(p.get("subsample") or 1.0)), reg_alpha=float(p.get("reg_alpha") or 0.0))
    if kind == TU.XGB:
        return B.Boost(**base, reg_lambda=float(p.get("reg_lambda", 1.0)))
    return B.Boost(**{**LEAF_WISE, **base, "num_leaves": int(p.get("num_leaves") or 31), "reg_lambda": float(p.get("reg_lambda", 0.0))})


def _loop_scores(tasks: dict, rows, val, cols) -> dict[str, float]:
    """F1 of the positive class on ``val`` of each kind's parameter map, fitted on ``rows``; the boosted kinds in one run."""
    out = {}

    def forest():
        if TU.RF in tasks:
            out[TU.RF] = float(MD.f1_evaluator().evaluate(_loop_forest(tasks[TU.RF], cols).fit(rows).transform(val)))

    def boosted():
        kinds = {k: loop_boost(k, p) for k, p in tasks.items() if k != TU.RF}
        k_best = [int(tasks[k]["select_k"]) for k in kinds if tasks[k].get("select_k")]
        if kinds:
            used = cols
            if k_best:  # the move selects for both kinds alike
                sel = MD.select_k_best(None, max(k_best)).fit(MD.assembler(cols).transform(rows))
                used = [cols[i] for i in sel.selectedFeatures]
            scored = fit_boosted(rows, used, kinds).score(val, {k: k for k in kinds})
            long = scored.selectExpr("accepted", f"stack({len(kinds)}, {', '.join(f"'{k}', {k}" for k in kinds)}) AS (model, s)")
            rates = MT.confusion(long.withColumn("_pred", F.col("s.label") == "1"), "accepted", "_pred", by=["model"])
            out.update({r["model"]: float(r["f1"] or 0.0) for r in rates.collect()})

    MD.parallel_fits(lambda f: f(), [forest, boosted], parallelism=2)
    return out


@query("tuning_loop")
def tuning_loop(spark, sf_dir, cycles: int | None = None, baseline_rows: int = BASELINE_ROWS):
    """Weakened models, a baseline on at most ``baseline_rows`` rows, then accept-if-better cycles with real fits.

    Every cycle applies the next strategy to each of the three kinds that has
    a move for it.  The loop ends after one cycle per strategy (or ``cycles``),
    or when a model's F1 passes the target.  Returns the history.
    """
    m, cols = _matrix(spark, sf_dir)
    train, val = m.filter("split = 'train'"), m.filter("split = 'val'")
    params = _by_kind(TU.weaken(_param_rows(spark, LOOP_START)).collect())
    current = _loop_scores(params, SP.sample_cap(train, "patch_id", baseline_rows), val, cols)
    rows = [(kind, 0, "baseline", current[kind]) for kind in params]
    for it in range(1, (len(config.STRATEGIES) if cycles is None else cycles) + 1):
        if max(current.values()) > config.STOP_F1:
            break
        strategy = config.STRATEGIES[(it - 1) % len(config.STRATEGIES)]
        moved = TU.apply_moves(_param_rows(spark, params), len(cols), [strategy]).filter("applicable = 1").collect()
        tried = _by_kind(moved)
        for kind, f1 in _loop_scores(tried, train, val, cols).items():
            rows.append((kind, it, strategy, f1))
            if f1 - current[kind] > config.ACCEPT_MIN_GAIN:  # same rule as the history fold below
                params[kind], current[kind] = params[kind] | tried[kind], f1
    hist = spark.createDataFrame(rows, "model string, iteration int, strategy string, new_f1 double")
    return TU.accept_moves(hist)
