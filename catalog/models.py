"""Training, validation, saving and batch scoring on the user feature row.

The label is an order after the cut-off; features look back from it. Ensembles have the operators' own numbers of trees. A model is
trained once a session and directory and saved; queries that score load it.
"""

from __future__ import annotations

from functools import cache

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from catalog.features import _tidy, _user_row_sql
from catalog.inputs import view, with_views
from catalog.registry import registry
from propensity.operators import balance, cleaning, model as models
from propensity.plans import scoring, training
from propensity.plans.user_row import user_row
from propensity.session import materialize, scratch_path
from propensity.sources.csv_files import write_audience
from propensity.sources.tables import read_table

QUERIES, ORACLES, query = registry()

TRAIN_CUTOFF = "2024-01-28 00:00:00"
_USERS = f"""(SELECT DISTINCT user_id FROM fx_traffic
   WHERE ad_product_type = 'sponsored_products' AND event_dt_utc < TIMESTAMP '{TRAIN_CUTOFF}')"""


@cache
def labelled_rows(spark, directory):
    """Feature rows with ``high_potential``, written out once a session and directory: all models start from them."""
    rows = user_row(
        view(spark, directory, "fx_traffic"), view(spark, directory, "fx_conversions"), TRAIN_CUTOFF
    )
    label = cleaning.high_potential(
        F.col("total_conversions_after_30d"), F.col("total_revenue_after_30d")
    )
    return materialize(rows.withColumn("high_potential", label), "labelled")


# How each model is trained; all else is the operators' default.
_KINDS = {
    "gbt": {},
    "gbt_weighted": {"balancing": "weights"},
    "rf": {"balancing": "none", "estimator": models.random_forest},
}


@cache
def _trained(spark, directory, kind):
    """Feature rows, what training gave, and where the model is."""
    rows, path = labelled_rows(spark, directory), scratch_path(spark, f"model-{kind}")
    return rows, training.train(rows, "high_potential", save_to=path, **_KINDS[kind]), path


@query()
def model_gbt_scores(spark, directory):
    """Boosted trees on the oversampled training part, evaluated on the test part."""
    return _trained(spark, directory, "gbt")[1].metrics


@query()
def model_gbt_weighted_scores(spark, directory):
    """Boosted trees with balanced class weights in place of oversampling."""
    return _trained(spark, directory, "gbt_weighted")[1].metrics


@query()
def model_rf_scores(spark, directory):
    """A random forest on the training part as it is."""
    return _trained(spark, directory, "rf")[1].metrics


_LABELLED = f""", feature_rows AS ({_user_row_sql(TRAIN_CUTOFF)}),
   labelled AS (SELECT *, CAST(coalesce(total_conversions_after_30d, 0) > 0 OR coalesce(total_revenue_after_30d, 0) > 0 AS INT) AS high_potential
     FROM feature_rows),
   placed AS (SELECT *, row_number() OVER (PARTITION BY high_potential ORDER BY substr(md5(concat(user_id, '-42')), 1, 15), user_id)
       <= round(0.2 * count(*) OVER (PARTITION BY high_potential)) AS is_test FROM labelled)
"""

# Scores by their definitions, from the written scores: counts of the four cases.
_BY_DEFINITION = """
   WITH counts AS (SELECT count_if(y = 1 AND p = 1) AS tp, count_if(y = 0 AND p = 1) AS fp, count_if(y = 1 AND p = 0) AS fn,
       count_if(y = 0 AND p = 0) AS tn, count(*) AS n_test, count_if(y = 1) AS n_positive FROM {scored})
   SELECT n_test, n_positive, (tp + tn) / n_test AS accuracy, coalesce(try_divide(tp, tp + fp), 0) AS precision,
     coalesce(try_divide(tp, tp + fn), 0) AS recall, coalesce(try_divide(2 * tp, 2 * tp + fp + fn), 0) AS f1
   FROM counts"""


def _share_in_order(scored):
    """The share of pairs of a positive and a negative row in the right order, equal scores counted half; 0 without a pair.

    The pairs are counted, not made: per score, in ranges of scores, so that work grows with the rows. A NULL score is in no order.
    """
    counts = scored.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    ranged = materialize(counts.repartitionByRange("s").withColumn("part", F.spark_partition_id()), "ranged")
    known = ranged.where("s is not null")
    # one row a range
    parts = known.groupBy("part").agg(F.sum("neg").alias("own"))
    parts = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    inside = F.sum("neg").over(Window.partitionBy("part").orderBy("s")) - F.col("neg")
    below = known.withColumn("inside", inside).join(parts, "part")
    # doubles: the number of pairs may be beyond a long
    won = F.col("pos").cast("double") * (F.col("before") + F.col("inside") + F.col("neg") / 2)
    pairs = ranged.agg(F.sum("pos").cast("double") * F.sum("neg")).first()[0]
    return (below.agg(F.sum(won)).first()[0] or 0.0) / pairs if pairs else 0.0


@query(with_views(_LABELLED + """SELECT kind, 100 AS trees, count(*) AS n_test, count(*) FILTER (high_potential = 1) AS n_positive,
     TRUE AS scores_agree, TRUE AS in_range FROM placed, (VALUES ('gbt'), ('gbt_weighted'), ('rf')) AS kinds(kind)
   WHERE is_test GROUP BY kind""", "fx_traffic", "fx_conversions"))
def model_facts(spark, directory):
    """Of each model: trees, the test part it is judged on, and whether its scores are those of their definitions."""
    facts = []
    for kind in _KINDS:
        _, trained, path = _trained(spark, directory, kind)
        loaded = PipelineModel.load(path)
        scored = models.score(loaded, trained.test).select(F.col("high_potential").alias("y"), F.col("prediction").alias("p"), F.col("probability").alias("s"))
        scored = materialize(scored, "scored")
        own, told = trained.metrics.first(), spark.sql(_BY_DEFINITION, scored=scored).first()
        agree = all(abs(own[n] - told[n]) < 1e-9 for n in ("accuracy", "precision", "recall", "f1"))
        agree = agree and abs(own["auc"] - _share_in_order(scored)) < 1e-9
        in_range = scored.where(~F.col("s").between(0, 1) | (F.col("p") != (F.col("s") > 0.5).cast("int"))).isEmpty()
        facts.append((kind, len(loaded.stages[-1].trees), told.n_test, told.n_positive, agree, in_range))
    return spark.createDataFrame(facts, "kind string, trees int, n_test long, n_positive long, scores_agree boolean, in_range boolean")


def _folded(spark, directory):
    prepared = training.prepare(labelled_rows(spark, directory), "high_potential")
    fit_on = prepared.where(~F.col("is_test")).drop("is_test")
    return materialize(balance.stratified_folds(fit_on, "high_potential"), "folds", partition_by="fold")


@cache
def _validated(spark, directory):
    """The folds of the training part, a forest, and its F1 in each."""
    df = _folded(spark, directory)
    forest = models.random_forest([n for n in cleaning.features_of(df, "high_potential") if n != "fold"], "high_potential")
    return df, forest, materialize(models.cross_validate(df, forest, "high_potential"), "f1")


@query()
def model_cv_f1(spark, directory):
    """F1 per fold of a five-fold stratified validation."""
    return _validated(spark, directory)[2]


_FOLDS = _LABELLED + """, folds AS (SELECT high_potential,
     ntile(5) OVER (PARTITION BY high_potential ORDER BY substr(md5(concat(user_id, '-42')), 1, 15), user_id) - 1 AS fold
   FROM placed WHERE NOT is_test)
"""


@query(with_views(_FOLDS + """SELECT CAST(fold AS INT) AS fold, count(*) AS n_rows, count(*) FILTER (high_potential = 1) AS n_positive,
     TRUE AS f1_agrees, TRUE AS mean_agrees FROM folds GROUP BY fold""", "fx_traffic", "fx_conversions"))
def model_cv_facts(spark, directory):
    """Rows of each fold; its F1 from a model fitted on the others, by definition; and the mean of all folds."""
    df, forest, told = _validated(spark, directory)
    told, rows = {r.fold: r.f1 for r in told.collect()}, []
    for fold in sorted(told):
        scored = models.score(models.fit(forest, df.where(F.col("fold") != fold)), df.where(F.col("fold") == fold))
        y, p = F.col("high_potential") == 1, F.col("prediction") == 1
        r = scored.agg(F.count("*").alias("n"), F.count_if(y).alias("pos"), F.count_if(y & p).alias("hit"), F.count_if(p).alias("called")).first()
        rows.append((fold, r.n, r.pos, 2 * r.hit / (r.pos + r.called) if r.pos + r.called else 0.0))
    mean = sum(r[3] for r in rows) / len(rows)
    agrees = abs(spark.createDataFrame(list(told.items()), "fold int, f1 double").agg(F.avg("f1")).first()[0] - mean) < 1e-9
    facts = [(fold, n, positive, abs(f1 - told[fold]) < 1e-9, agrees) for fold, n, positive, f1 in rows]
    return spark.createDataFrame(facts, "fold int, n_rows long, n_positive long, f1_agrees boolean, mean_agrees boolean")


_DEPTHS = [2, 4]


@cache
def _searched(spark, directory):
    df, _, _ = _validated(spark, directory)
    forest = models.random_forest([n for n in cleaning.features_of(df, "high_potential") if n != "fold"], "high_potential")
    return models.grid_search(df, forest, "high_potential", {"maxDepth": _DEPTHS})


@query()
def model_grid(spark, directory):
    """Mean F1 of every tree depth tried."""
    found = _searched(spark, directory)
    rows = [(depth, float(f1)) for depth, f1 in zip(_DEPTHS, found.avgMetrics)]
    return spark.createDataFrame(rows, "max_depth int, mean_f1 double")


@query(with_views(_FOLDS + """SELECT depth AS max_depth, count(*) AS n_rows, TRUE AS mean_agrees, TRUE AS best_is_kept
   FROM folds, (VALUES (2), (4)) AS depths(depth) GROUP BY depth""", "fx_traffic", "fx_conversions"))
def model_grid_facts(spark, directory):
    """Of each depth: rows it is validated on, whether its mean F1 is that of a validation of its own, and whether the best one is kept."""
    df, _, _ = _validated(spark, directory)
    found, facts = _searched(spark, directory), []
    features = [n for n in cleaning.features_of(df, "high_potential") if n != "fold"]
    best = max(zip(found.avgMetrics, _DEPTHS), key=lambda x: x[0])[1]
    kept = found.bestModel.stages[-1].getOrDefault("maxDepth") == best
    for depth, mean in zip(_DEPTHS, found.avgMetrics):
        own = models.cross_validate(df, models.random_forest(features, "high_potential", depth=depth), "high_potential")
        facts.append((depth, df.count(), bool(abs(own.agg(F.avg("f1")).first()[0] - mean) < 1e-9), kept))
    return spark.createDataFrame(facts, "max_depth int, n_rows long, mean_agrees boolean, best_is_kept boolean")


@query(with_views(
    f"SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_changed FROM {_USERS}", "fx_traffic"))
def model_save_load(spark, directory):
    """A saved and loaded model gives every user the score it gave before."""
    rows, trained, path = _trained(spark, directory, "gbt")
    before = scoring.score_frame(trained.model, rows).withColumnRenamed("probability", "before")
    after = scoring.score_frame(PipelineModel.load(path), rows).select("user_id", "probability")
    return before.join(after, "user_id").agg(
        F.count("*").alias("n_scored"),
        F.count_if(F.col("before") != F.col("probability")).alias("n_changed"),
    )


@query()
def score_batch(spark, directory):
    """Class and probability of every user, by the saved model."""
    rows, _, path = _trained(spark, directory, "gbt")
    return scoring.score_frame(PipelineModel.load(path), rows)


@query(with_views(
    f"SELECT user_id, TRUE AS in_range, TRUE AS class_fits FROM {_USERS}", "fx_traffic"))
def score_batch_consistent(spark, directory):
    """One score per user, a probability, and a class that agrees with it."""
    scored = score_batch(spark, directory)
    return scored.select(
        "user_id",
        F.col("probability").between(0, 1).alias("in_range"),
        ((F.col("probability") > 0.5).cast("int") == F.col("prediction")).alias("class_fits"),
    )


@query()
def sink_audience(spark, directory):
    """Feature rows with the predicted class and probability, written and read back."""
    rows, trained, _ = _trained(spark, directory, "gbt")
    path = scratch_path(spark, "audience")
    write_audience(scoring.score_audience(trained.model, rows), path)
    return spark.read.parquet(path)


@query(with_views(_LABELLED + """SELECT * EXCLUDE (high_potential), high_potential, high_potential AS label_there, TRUE AS in_range, TRUE AS class_fits
   FROM labelled""", "fx_traffic", "fx_conversions"))
def sink_audience_rows(spark, directory):
    """The written audience: every user once, with the feature row and the label as they were, a probability and its class."""
    written = sink_audience(spark, directory)
    checked = written.withColumns({
        "label_there": F.col("high_potential"),
        "in_range": F.col("predicted_probability").between(0, 1),
        "class_fits": (F.col("predicted_probability") > 0.5).cast("int") == F.col("predicted_high_potential"),
    })
    return _tidy(checked.drop("predicted_probability", "predicted_high_potential"))


# ---------------------------------------------------------------- the contract of a saved model


@cache
def _quality_model(spark, directory):
    """A forest on shape and source of the labelled documents, with scale and codes of its own: rows, and where it is."""
    docs = read_table(spark, directory, "documents").select(
        F.col("doc_id").alias("user_id"), "n_chars", F.length("text").alias("length"), "source", "lang"
    )
    labels = read_table(spark, directory, "labels").select(F.col("doc_id").alias("user_id"), "quality", "toxic")
    rows, path = materialize(labels.join(docs, "user_id"), "labelled"), scratch_path(spark, "model-quality")
    trained = training.train(
        rows, "quality", balancing="none", estimator=models.random_forest, scale=True, encode=["source"], save_to=path
    )
    return rows, trained, path


_QUALITY = """WITH joined AS (SELECT l.doc_id AS user_id, l.quality, l.toxic, d.n_chars, length(d.text) AS length, nullif(trim(d.source), '') AS source
     FROM labels l JOIN documents d USING (doc_id)),
   placed AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY substr(md5(concat(user_id, '-42')), 1, 15), user_id)
       <= round(0.2 * count(*) OVER (PARTITION BY quality)) AS is_test FROM joined),
   fitted AS (SELECT avg(n_chars) AS m, stddev_samp(n_chars) AS s, avg(toxic) AS mt, stddev_samp(toxic) AS st FROM placed WHERE NOT is_test),
   codes AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM placed WHERE NOT is_test AND source IS NOT NULL))
"""


@query(_QUALITY + """SELECT user_id, round((n_chars - m) / s, 6) AS n_chars, round((toxic - mt) / st, 6) AS toxic,
     CAST(coalesce(code, (SELECT count(*) FROM codes)) AS DOUBLE) AS source
   FROM placed LEFT JOIN codes USING (source), fitted WHERE is_test""")
def model_fitted_stages(spark, directory):
    """Scale and codes as fitted on the training part and loaded with the model, applied to the test part."""
    _, trained, path = _quality_model(spark, directory)
    model = PipelineModel.load(path)
    names = [*models.features_of_model(model)]
    values = vector_to_array("features")
    scored = model.transform(trained.test)
    return scored.select(
        "user_id",
        *[F.round(values[names.index(n)], 6).alias(n) for n in ("n_chars", "toxic")],
        values[names.index("source")].alias("source"),
    )


@query("""WITH filled AS (SELECT count(*) FILTER (n_chars <> 0 AND doc_id % 10 <> 0) AS chars, count(*) FILTER (doc_id % 10 = 0) AS lost,
       count(*) FILTER (length(text) > 0) AS longer, count(*) FILTER (source IS NOT NULL) AS sources FROM documents)
     SELECT 'n_chars' AS feature, 'cast' AS status, chars AS n_filled, lost AS n_lost FROM filled
     UNION ALL SELECT 'length', 'matched', longer, 0 FROM filled
     UNION ALL SELECT 'toxic', 'missing', 0, 0 FROM filled
     UNION ALL SELECT 'source', 'matched', sources, 0 FROM filled
     UNION ALL SELECT 'n_words', 'extra', longer, 0 FROM filled""")
def score_align(spark, directory):
    """A table aligned with a saved and loaded model: the state of each feature, rows with a value, and values that are no numbers."""
    told = models.contract(PipelineModel.load(_quality_model(spark, directory)[2]))
    chars = F.when(F.col("doc_id") % 10 == 0, "n/a").otherwise(F.col("n_chars").cast("string"))
    documents = read_table(spark, directory, "documents").select(
        F.col("doc_id").alias("user_id"), chars.alias("n_chars"), F.length("text").alias("length"), "source", F.length("text").alias("n_words")
    )
    states, lost = models.alignment(documents, told), models.lost_values(documents, told)
    aligned = models.align(documents, told, kept=("user_id", "n_words"))
    filled = lambda n: F.col(n).isNotNull() if told.get(n) == models.TEXT else F.col(n) != 0
    entries = [
        F.struct(
            F.lit(n).alias("feature"), F.lit(state).alias("status"), F.count_if(filled(n)).alias("n_filled"),
            F.lit(lost.get(n, 0)).cast("long").alias("n_lost"),
        )
        for n, state in states.items()
    ]
    return aligned.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
