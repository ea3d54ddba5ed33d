"""Evaluation, calibration, features, classifiers and clustering."""

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tonegauge.operators import calibration, cleaning, features, metrics, model_tables, models, splits
from tonegauge.operators import text as token_ops
from tonegauge.plans import profile
from tonegauge.plans import text as text_plans
from tonegauge.plans import views_sql as v
from tonegauge.sources import storage, views

SETTINGS = features.FeatureSettings()


def _rounded(df, digits=6):
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def _pred(spark, folder):
    return views.predictions(spark, folder).select("Id", "label", "Sentiment", "prediction", "probability")


def m7a_apply_thresholds(spark, folder):
    return calibration.apply_thresholds(_pred(spark, folder)).select("Id", "label", "prediction")


def m7b_threshold_scores(spark, folder):
    return _rounded(calibration.threshold_scores(_pred(spark, folder)))


def m7b_calibrate(spark, folder):
    return _rounded(calibration.calibrate(_pred(spark, folder)))


def m7c_compare(spark, folder):
    pred = _pred(spark, folder)
    return _rounded(calibration.compare(pred, calibration.apply_thresholds(pred)))


def m8_metrics(spark, folder):
    return metrics.metrics(_pred(spark, folder))


def m9_confusion(spark, folder):
    return metrics.confusion(_pred(spark, folder))


def m9_confusion_shares(spark, folder):
    return metrics.confusion(_pred(spark, folder), normalise=True)


def m10_hits(spark, folder):
    return metrics.hits(_pred(spark, folder))


def m11_confidence(spark, folder):
    return _rounded(metrics.confidence(_pred(spark, folder)).select("Id", "max_prob", "correct"))


def m11_confidence_histogram(spark, folder):
    return _rounded(metrics.confidence_histogram(_pred(spark, folder)))


def m12_roc(spark, folder):
    """The curves of all classes; the origin's infinite threshold is shown as null."""
    points = metrics.roc_curves(_pred(spark, folder))
    finite = F.when(F.col("threshold") < float("inf"), F.col("threshold"))
    return _rounded(points.withColumn("threshold", finite))


def _confident(pred):
    """Probabilities that all lie within 1e-5 of one."""
    return pred.withColumn("probability", F.transform("probability", lambda p: 1 - (1 - p) * 1e-5))


def m12_roc_confident(spark, folder):
    points = metrics.roc_curves(_confident(_pred(spark, folder)))
    return points.groupBy("class").agg(F.count("*").alias("points"), F.round(F.sum("fpr"), 4).alias("fpr"), F.round(F.sum("tpr"), 4).alias("tpr"))


def m12_auc_confident(spark, folder):
    return _rounded(metrics.aucs(_confident(_pred(spark, folder))))


def m12_auc(spark, folder):
    return _rounded(metrics.aucs(_pred(spark, folder)))


def m17_insight(spark, folder):
    meta = {"model_name": models.MODEL_NAME, "model_version": models.MODEL_VERSION, "dataset": "predictions", "notes": "{rows} rows"}
    doc = metrics.insight(_pred(spark, folder), meta, datetime(2024, 1, 1))
    return doc.select(
        "evaluated_at", "model_name", "trained_at", "notes",
        "metrics.accuracy", "metrics.f1_weighted",
        *[F.col(f"metrics.per_class.{s}.{k}").alias(f"{s}_{k}") for s in ["negative", "neutral"]
          for k in ["precision", "recall", "f1"]],
        F.array_join(F.flatten("confusion_matrix.matrix").cast("array<string>"), ",").alias("matrix"),
    )


def _labelled_docs(spark, folder):
    docs = cleaning.drop_empty_text(views.doc_reviews(spark, folder))
    return cleaning.fixed_weights(cleaning.labelled(docs))


def _featured(spark, folder):
    """Features of the labelled documents by split. Split and features are written once and read by every step."""
    rows = storage.stored(splits.stratified_split(_labelled_docs(spark, folder)), "split")
    _, wide = features.fit_and_transform(rows, SETTINGS)
    saved = storage.stored(wide.select("Id", "Sentiment", "label", "classWeight", "split", "features"), "features")
    return saved.filter(F.col("split") == "train"), saved.filter(F.col("split") != "train")


def _predicted(model, test):
    return model.transform(test).select("Id", "label", "prediction")


def t6_hash_tf(spark, folder):
    model = features.fit_features(views.doc_texts(spark, folder), SETTINGS, idf=False)
    return model.transform(views.doc_texts(spark, folder)).select("Id", "features")


def t10_tf_only(spark, folder):
    """Features without document frequencies, from a saved model that has them: tokens and bigrams counted per row."""
    docs = views.doc_texts(spark, folder)
    path = storage.shared_dir(spark, "tf-only")
    features.fit_features(docs, SETTINGS).save(spark, path)
    counted = features.FeatureModel.load(spark, path, with_weights=False).transform(docs)
    each = model_tables.entries(counted).filter(F.col("feature") != model_tables.BIAS)
    sums = each.groupBy("Id").agg(F.sum("value").cast("bigint").alias("n"))
    return docs.select("Id").join(sums, "Id", "left").select("Id", F.coalesce("n", F.lit(0)).alias("n"))


def t8_fit_features(spark, folder):
    train, rest = _featured(spark, folder)
    return train.unionByName(rest).select("Id", "split", "label", "features")


def _shown(rows, *keep):
    """Non-zero entries of the features, one a row."""
    each = model_tables.entries(rows, keep=keep).filter(F.col("feature") != model_tables.BIAS)
    return each.select("Id", *keep, F.col("feature").cast("int").alias("feature"), F.round("value", 6).alias("value"))


def t6_hashed_counts(spark, folder):
    return _shown(t6_hash_tf(spark, folder))


def t8_feature_entries(spark, folder):
    return _shown(t8_fit_features(spark, folder), "split")


def t9_nonzero_features(spark, folder):
    train, _ = _featured(spark, folder)
    return features.nonzero_summary(train)


def m1_logistic_regression(spark, folder):
    train, test = _featured(spark, folder)
    return _predicted(models.train_lr(train), test)


def m2_linear_svc(spark, folder):
    train, test = _featured(spark, folder)
    return _predicted(models.train_svc(train), test)


def m3_naive_bayes(spark, folder):
    train, test = _featured(spark, folder)
    return _predicted(models.train_nb(train), test)


def m4_random_forest(spark, folder):
    train, test = _featured(spark, folder)
    return _predicted(models.train_rf(train), test)


def _certified(certificate):
    """The share of a class by label beside its share by the model, and whether the gradient is near 0."""
    flat = (F.col("gradient") < FLAT).alias("flat")
    return certificate.select("class", "rows", F.round("share", 3).alias("share"), F.round("predicted", 3).alias("predicted"), flat)


#: Largest derivative of the mean loss by a standardised coefficient that counts as the optimum.
FLAT = 1e-3


def m1_lr_certificate(spark, folder):
    train, _ = _featured(spark, folder)
    table = model_tables.linear_table(spark, models.train_lr(train))
    return _certified(model_tables.lr_certificate(train, table, models.BEST["regParam"], weight="classWeight"))


def m16_lr_certificate(spark, folder):
    """The classifier of the embeddings, whose ten classes are labels of the table."""
    rows = views.vectors(spark, folder)
    table = model_tables.linear_table(spark, models.train_lr(rows))
    return _certified(model_tables.lr_certificate(rows, table, models.BEST["regParam"], classes=10))


def _agreement(scored, by_table):
    """Rows per label, and those that the table decides as the model does."""
    both = scored.select("Id", "label", "prediction").join(
        model_tables.decided(by_table).select("Id", F.col("prediction").alias("_by_table")), "Id")
    same = F.count_if(F.col("prediction") == F.col("_by_table"))
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), same.alias("same"))


def m2_svc_by_table(spark, folder):
    train, test = _featured(spark, folder)
    model = models.train_svc(train)
    table = model_tables.linear_table(spark, model)
    return _agreement(model.transform(test), model_tables.margins(model_tables.entries(test), table))


def m4_forest_by_table(spark, folder):
    train, test = _featured(spark, folder)
    model = models.train_rf(train)
    votes = model_tables.forest_votes(
        test, model_tables.forest_table(spark, model), model.getNumTrees, model.getMaxDepth())
    return _agreement(model.transform(test), votes)


def _word_rows(spark, folder):
    """Word counts of the labelled documents with their split."""
    rows = splits.stratified_split(_labelled_docs(spark, folder))
    found = token_ops.remove_stopwords(token_ops.tokenise(rows))
    return model_tables.word_entries(found, "filtered", keep=["label", "split"])


def _word_table(rows):
    return model_tables.naive_bayes_table(rows.filter(F.col("split") == "train"), bias=model_tables.BIAS_WORD)


def m3_naive_bayes_table(spark, folder):
    table = _word_table(_word_rows(spark, folder))
    return table.select("feature", *[F.round(F.get("weights", F.lit(c)), 6).alias(f"w{c}") for c in range(3)])


def m3_naive_bayes_by_table(spark, folder):
    """Rows that took no part in the fit, decided by the table."""
    rows = storage.stored(_word_rows(spark, folder), "word-rows")
    table = storage.stored(_word_table(rows), "word-weights")
    held_out = rows.filter(F.col("split") != "train")
    scored = model_tables.decided(model_tables.margins(held_out, table))
    return scored.select("Id", "prediction", *[F.round(F.get("margins", F.lit(c)), 3).alias(f"m{c}") for c in range(3)])


def m5_benchmark(spark, folder):
    train, test = _featured(spark, folder)
    results, _ = models.benchmark(
        {"logistic regression": models.logistic_regression(train, **models.BASELINE),
         "naive bayes": models.naive_bayes(), "linear SVM": models.linear_svc(train)},
        train, test,
    )
    return results.drop("train_seconds")


def m6_tune(spark, folder):
    train, _ = _featured(spark, folder)
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    _, table = models.tune_lr(kept, models.SEARCH, parallelism=4)
    kept.unpersist()
    return table


def m13_cluster(spark, folder):
    return models.cluster(views.vectors(spark, folder))[2]


def m13_text_clusters(spark, folder):
    """K-means on the TF-IDF features: rows, rows that are with their nearest centre, and whether the cost is theirs."""
    train, _ = _featured(spark, folder)
    model, placed, quality = models.cluster(train)
    each = model_tables.entries(train)
    found = model_tables.margins(each, model_tables.cluster_table(spark, model))
    squares = each.filter(F.col("feature") != model_tables.BIAS).groupBy("Id").agg(F.sum(F.col("value") * F.col("value")).alias("_xx"))
    sized = placed.select("Id", "cluster").join(found, "Id").join(squares, "Id", "left")
    best, own = F.array_max("margins"), F.get("margins", F.col("cluster"))
    distance = F.coalesce("_xx", F.lit(0.0)) - 2 * best
    totals = sized.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(own >= best - 1e-6).alias("nearest"), F.sum(distance).alias("_cost"))
    cost = quality.select("cost").scalar()
    return totals.select("rows", "nearest", (F.abs(F.col("_cost") - cost) < 1e-6 * cost).alias("same_cost"))


def m14_text_cluster_classifier(spark, folder):
    train, _ = _featured(spark, folder)
    _, placed, _ = models.cluster(train)
    return models.cluster_classifier(placed.select("Id", "features", "cluster"))[1]


def m14_cluster_classifier(spark, folder):
    _, placed, _ = models.cluster(views.vectors(spark, folder))
    return models.cluster_classifier(placed)[1]


def m15_training_history(spark, folder):
    train, _ = _featured(spark, folder)
    return models.training_history(spark, models.train_lr(train))


def m15_history_falls(spark, folder):
    """Size of the model, and whether its objective never rises from one iteration to the next."""
    train, _ = _featured(spark, folder)
    history = models.training_history(spark, models.train_lr(train))
    values = F.transform(F.array_sort(F.collect_list(F.struct("iteration", "objective"))), lambda e: e["objective"])
    listed = history.groupBy("classes", "features").agg(values.alias("v"))
    n = F.size("v")
    steps = F.zip_with(F.slice("v", F.lit(1), n - 1), F.slice("v", F.lit(2), n - 1), lambda a, b: b <= a)
    return listed.select("classes", "features", ((n > 1) & F.forall(steps, lambda s: s)).alias("falls"))


def m16_score(spark, folder):
    rows = views.vectors(spark, folder)
    model = models.train_lr(rows)
    return models.score(model, rows).select("Id", "label", "prediction", "probability")


QUERIES = {
    name: run for name, run in globals().items()
    if callable(run) and name[0] in "mt" and name[1:2].isdigit()
}

_NAMES = ["negative", "neutral", "positive"]


def _metric_columns(digits):
    per_class = []
    for c, name in enumerate(_NAMES):
        hit, true, said = f"h{c}", f"t{c}", f"s{c}"
        per_class += [
            (f"precision_{name}", f"coalesce({hit} / nullif({said}, 0), 0)"),
            (f"recall_{name}", f"coalesce({hit} / nullif({true}, 0), 0)"),
            (f"f1_{name}", f"coalesce(2.0 * {hit} / nullif({true} + {said}, 0), 0)"),
        ]
    found = dict(per_class)

    def weighted(kind):
        return "(" + " + ".join(f"t{c} * {found[f'{kind}_{n}']}" for c, n in enumerate(_NAMES)) + ") / n"

    columns = [("accuracy", "(h0 + h1 + h2) / n")]
    columns += [(f"{k}_weighted", weighted(k)) for k in ["f1", "precision", "recall"]] + per_class
    return ", ".join(f"round(CAST({x} AS DOUBLE), {digits}) AS {name}" for name, x in columns)


def _cells(source, by=""):
    counted = ", ".join(
        f"CAST(count(*) FILTER (label = {c} AND prediction = {c}) AS DOUBLE) AS h{c}, "
        f"CAST(count(*) FILTER (label = {c}) AS DOUBLE) AS t{c}, "
        f"CAST(count(*) FILTER (prediction = {c}) AS DOUBLE) AS s{c}" for c in range(3)
    )
    group = f"GROUP BY {by}" if by else ""
    return f"SELECT {by + ',' if by else ''} CAST(count(*) AS DOUBLE) AS n, {counted} FROM {source} {group}"


def _decide(t0, t1, t2):
    return (
        f"CASE WHEN p0 / {t0} >= p1 / {t1} AND p0 / {t0} >= p2 / {t2} THEN 0.0::DOUBLE "
        f"WHEN p1 / {t1} >= p2 / {t2} THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END"
    )


_DEFAULT = ", decided AS (SELECT * REPLACE (" + _decide(
    "0.35::DOUBLE", "0.35::DOUBLE", "0.45::DOUBLE") + " AS prediction) FROM predictions)"

def _grid_scores():
    # the class totals are called c0..c2 here because t0..t2 are thresholds
    counted = ", ".join(
        f"CAST(count(*) FILTER (label = {c} AND prediction = {c}) AS DOUBLE) AS h{c}, "
        f"CAST(count(*) FILTER (label = {c}) AS DOUBLE) AS c{c}, "
        f"CAST(count(*) FILTER (prediction = {c}) AS DOUBLE) AS s{c}" for c in range(3)
    )
    f1 = [f"coalesce(2.0 * h{c} / nullif(c{c} + s{c}, 0), 0)" for c in range(3)]
    return f""", grid AS (SELECT CAST(row_number() OVER (ORDER BY t0, t1, t2) - 1 AS INT) AS combo, * FROM
      (SELECT unnest([0.25, 0.30, 0.35])::DOUBLE AS t0), (SELECT unnest([0.12, 0.15, 0.18, 0.22])::DOUBLE AS t1),
      (SELECT unnest([0.40, 0.45, 0.50])::DOUBLE AS t2)),
    tried AS (SELECT combo, t0, t1, t2, label, {_decide('t0', 't1', 't2')} AS prediction FROM predictions, grid),
    cells AS (SELECT combo, t0, t1, t2, count(*) AS n, {counted} FROM tried GROUP BY ALL),
    scored AS (SELECT combo, t0, t1, t2, (c0 * {f1[0]} + c1 * {f1[1]} + c2 * {f1[2]}) / n AS f1,
      {f1[1]} AS f1_neutral FROM cells),
    combined AS (SELECT *, 0.70::DOUBLE * f1 + 0.30::DOUBLE * f1_neutral AS combined FROM scored)"""


_METRIC_NAMES = ["accuracy", "f1_weighted", "precision_weighted", "recall_weighted"] + [
    f"{k}_{n}" for n in _NAMES for k in ["precision", "recall", "f1"]
]
_MATRIX = "(VALUES (0), (1), (2)) AS l(label)"
_ROC = """each AS (SELECT 0 AS class, p0 AS score, label FROM predictions UNION ALL SELECT 1, p1, label FROM predictions
    UNION ALL SELECT 2, p2, label FROM predictions),
  scores AS (SELECT class, score, count(*) FILTER (label = class) AS pos, count(*) FILTER (label <> class) AS neg FROM each GROUP BY 1, 2),
  t AS (SELECT class, score, sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS tp,
    sum(neg) OVER (PARTITION BY class ORDER BY score DESC) AS fp,
    sum(pos) OVER (PARTITION BY class) AS p, sum(neg) OVER (PARTITION BY class) AS q FROM scores),
  points AS (SELECT class, score AS threshold, CAST(fp AS DOUBLE) / q AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM t
    UNION ALL SELECT c, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM (VALUES (0), (1), (2)) AS x(c))"""


def _auc(cls):
    return f"""SELECT {cls} AS class, round(sum(neg * (above + pos / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM (
      SELECT *, coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS above FROM (SELECT p{cls} AS score, count(*) FILTER (label = {cls}) AS pos,
          count(*) FILTER (label <> {cls}) AS neg FROM predictions GROUP BY 1))"""

_DOC_SPLIT = f"""{v.DOC_REVIEWS}, scored AS (SELECT *, CASE WHEN Score < 3 THEN 0 WHEN Score = 3 THEN 1 ELSE 2 END AS label
    FROM doc_reviews WHERE Score IS NOT NULL AND Text IS NOT NULL AND Text <> ''),
  placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || Id), Id) AS rn,
    count(*) OVER (PARTITION BY label) AS n FROM scored),
  doc_split AS (SELECT *, CASE label WHEN 0 THEN 3.0 WHEN 1 THEN 8.0 ELSE 0.5 END AS weight,
    CASE WHEN rn <= n * 8 // 10 THEN 'train' WHEN rn <= n * 8 // 10 + n // 10 THEN 'val' ELSE 'test' END AS split
    FROM placed)"""
_WORD_WEIGHTS = f"""WITH {text_plans.TOKENS}, {_DOC_SPLIT},
  words AS (SELECT d.Id, label, split, unnest(list_concat([''], filtered)) AS feature
    FROM doc_split d JOIN filtered f ON f.Id = d.Id),
  counts AS (SELECT Id, label, split, feature, count(*) AS value FROM words GROUP BY ALL),
  sums AS (SELECT feature, {', '.join(f"coalesce(sum(value) FILTER (label = {c}), 0) AS s{c}" for c in range(3))}
    FROM counts WHERE split = 'train' GROUP BY feature),
  totals AS (SELECT count(*) - 1 AS size, {', '.join(f"sum(s{c}) FILTER (feature <> '') AS t{c}" for c in range(3))},
    sum(s0 + s1 + s2) FILTER (feature = '') AS n FROM sums),
  weights AS (SELECT feature, {', '.join(
      f"ln(s{c} + 1.0) - ln(CASE WHEN feature = '' THEN n + 3.0 ELSE t{c} + size * 1.0 END) AS w{c}" for c in range(3))}
    FROM sums, totals)"""
_HELD_OUT_ROWS = f"""WITH {_DOC_SPLIT} SELECT label, count(*) AS rows, count(*) AS same FROM doc_split
  WHERE split <> 'train' GROUP BY label"""


_HASHED_COUNTS = f"""WITH RECURSIVE {text_plans.TOKENS}, {text_plans.VOCABULARY}, {text_plans.lemma_rounds('vocab', 'vocab')},
  {text_plans.lemmatised('filtered')}, {text_plans.hashed('grams', SETTINGS.num_features)}
  SELECT Id, feature, CAST(count(*) AS DOUBLE) AS value FROM grams JOIN places USING (token) GROUP BY ALL"""
_FEATURES = f"""WITH RECURSIVE {_DOC_SPLIT},
  fused AS (SELECT Id, split, concat_ws(' ', {', '.join(["coalesce(Summary, '')"] * SETTINGS.summary_times)}, Text) AS text FROM doc_split),
  {text_plans.tokens_of('fused', 'Id, split')},
  vocab AS (SELECT DISTINCT unnest(filtered) AS token FROM filtered),
  known AS (SELECT DISTINCT unnest(filtered) AS token FROM filtered WHERE split = 'train'),
  {text_plans.lemma_rounds('vocab', 'known')}, {text_plans.lemmatised('filtered')},
  {text_plans.hashed('grams', SETTINGS.num_features)},
  tf AS (SELECT Id, split, feature, count(*) AS tf FROM grams JOIN places USING (token) JOIN doc_split USING (Id) GROUP BY ALL),
  idf AS (SELECT feature, ln(((SELECT count(*) FROM doc_split WHERE split = 'train') + 1.0) / (count(*) + 1)) AS idf
    FROM tf WHERE split = 'train' GROUP BY feature HAVING count(*) >= {SETTINGS.min_doc_freq}),
  entries AS (SELECT Id, split, feature, tf * idf AS value FROM tf JOIN idf USING (feature) WHERE idf <> 0)"""
_BAYES = f"""{_FEATURES},
  sums AS (SELECT label, feature, sum(value) AS s FROM entries JOIN doc_split USING (Id, split) WHERE split = 'train' GROUP BY ALL),
  totals AS (SELECT label, count(*) AS rows, any_value(t) AS t FROM doc_split
    JOIN (SELECT label, sum(s) AS t FROM sums GROUP BY label) USING (label) WHERE split = 'train' GROUP BY label),
  margins AS (SELECT d.Id, d.label, c.label AS class, ln(c.rows + 1.0) + coalesce(sum(e.value * (
      ln(coalesce(s.s, 0) + 1.0) - ln(c.t + {SETTINGS.num_features}))), 0) AS margin
    FROM doc_split d JOIN totals c ON true LEFT JOIN entries e ON e.Id = d.Id
    LEFT JOIN sums s ON s.feature = e.feature AND s.label = c.label
    WHERE d.split <> 'train' GROUP BY d.Id, d.label, c.label, c.rows),
  bayes AS (SELECT Id, label, CAST(arg_max(class, margin) AS DOUBLE) AS prediction FROM margins GROUP BY Id, label)"""


SQL = {
    "t6_hashed_counts": _HASHED_COUNTS,
    "t8_feature_entries": f"{_FEATURES} SELECT Id, split, feature, round(value, 6) AS value FROM entries",
    "m3_naive_bayes": f"{_BAYES} SELECT * FROM bayes",
    "m1_lr_certificate": f"""WITH {_DOC_SPLIT}, shares AS (SELECT label AS class, count(*) AS rows,
        round(CAST(sum(weight) / (SELECT sum(weight) FROM doc_split WHERE split = 'train') AS DOUBLE), 3) AS share
        FROM doc_split WHERE split = 'train' GROUP BY label)
        SELECT *, share AS predicted, true AS flat FROM shares""",
    "m13_text_clusters": f"""WITH {_DOC_SPLIT} SELECT count(*) AS rows, count(*) AS nearest, true AS same_cost
        FROM doc_split WHERE split = 'train'""",
    "m15_history_falls": f"SELECT 3 AS classes, {SETTINGS.num_features} AS features, true AS falls",
    "t10_tf_only": f"""WITH {text_plans.TOKENS} SELECT Id, CAST(len(filtered) + greatest(len(filtered) - 1, 0) AS BIGINT) AS n
        FROM filtered""",
    "m16_lr_certificate": """WITH shares AS (SELECT CAST(label AS INT) AS class, count(*) AS rows,
        round(count(*) / (SELECT count(*) FROM embeddings), 3) AS share FROM embeddings GROUP BY label)
        SELECT *, share AS predicted, true AS flat FROM shares""",
    "m2_svc_by_table": _HELD_OUT_ROWS,
    "m4_forest_by_table": _HELD_OUT_ROWS,
    "m3_naive_bayes_table": f"""{_WORD_WEIGHTS} SELECT feature, round(w0, 6) AS w0, round(w1, 6) AS w1, round(w2, 6) AS w2
        FROM weights""",
    "m3_naive_bayes_by_table": f"""{_WORD_WEIGHTS}, margins AS (SELECT Id, sum(value * w0) AS m0, sum(value * w1) AS m1,
        sum(value * w2) AS m2 FROM counts JOIN weights USING (feature) WHERE split <> 'train' GROUP BY Id)
        SELECT Id, CASE WHEN m0 >= m1 AND m0 >= m2 THEN 0.0::DOUBLE WHEN m1 >= m2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END
          AS prediction, round(m0, 3) AS m0, round(m1, 3) AS m1, round(m2, 3) AS m2 FROM margins""",
    "m7a_apply_thresholds": f"WITH {v.PREDICTIONS} {_DEFAULT} SELECT Id, label, prediction FROM decided",
    "m7b_threshold_scores": f"""WITH {v.PREDICTIONS} {_grid_scores()} SELECT combo, t0, t1, t2, round(f1, 6) AS f1,
        round(f1_neutral, 6) AS f1_neutral, round(combined, 6) AS combined FROM combined""",
    "m7b_calibrate": f"""WITH {v.PREDICTIONS} {_grid_scores()} SELECT t0, t1, t2, round(combined, 6) AS combined
        FROM combined ORDER BY combined.combined DESC, combo LIMIT 1""",
    "m7c_compare": f"""WITH {v.PREDICTIONS} {_DEFAULT}, a AS (SELECT {_metric_columns(15)} FROM
        ({_cells('predictions')})), b AS (SELECT {_metric_columns(15)} FROM ({_cells('decided')})),
        x AS (UNPIVOT a ON {', '.join(_METRIC_NAMES)} INTO NAME metric VALUE before),
        y AS (UNPIVOT b ON {', '.join(_METRIC_NAMES)} INTO NAME metric VALUE after)
        SELECT metric, round(before, 6) AS before, round(after, 6) AS after, round(after - before, 6) AS change
        FROM x JOIN y USING (metric)""",
    "m8_metrics": f"WITH {v.PREDICTIONS} SELECT {_metric_columns(4)} FROM ({_cells('predictions')})",
    "m9_confusion": f"""WITH {v.PREDICTIONS} SELECT l.label, {', '.join(
        f"count(*) FILTER (prediction = {c}) AS predicted_{c}" for c in range(3))}
        FROM {_MATRIX} LEFT JOIN predictions p ON p.label = l.label GROUP BY l.label""",
    "m9_confusion_shares": f"""WITH {v.PREDICTIONS} SELECT l.label, {', '.join(
        f"(200 * count(*) FILTER (prediction = {c}) + count(*)) // (2 * count(*)) / 100.0 AS predicted_{c}"
        for c in range(3))} FROM {_MATRIX} LEFT JOIN predictions p ON p.label = l.label GROUP BY l.label""",
    "m10_hits": f"""WITH {v.PREDICTIONS} SELECT Sentiment, label = prediction AS correct, count(*) AS count
        FROM predictions GROUP BY ALL""",
    "m11_confidence": f"""WITH {v.PREDICTIONS} SELECT Id, round(greatest(p0, p1, p2), 6) AS max_prob,
        label = prediction AS correct FROM predictions""",
    "m11_confidence_histogram": f"""WITH {v.PREDICTIONS}, c AS (SELECT greatest(p0, p1, p2) AS m,
        label = prediction AS correct FROM predictions), {profile.histogram_sql('c', 'm', 'correct', 50, None)}""",
    "m12_roc": f"""WITH {v.PREDICTIONS}, {_ROC}
        SELECT class, round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM points""",
    "m12_roc_confident": f"""WITH {v.PREDICTIONS}, {_ROC} SELECT class, count(*) AS points, round(sum(fpr), 4) AS fpr,
        round(sum(tpr), 4) AS tpr FROM points GROUP BY class""",
    "m12_auc_confident": f"WITH {v.PREDICTIONS} {_auc(0)} UNION ALL {_auc(1)} UNION ALL {_auc(2)}",
    "m12_auc": f"WITH {v.PREDICTIONS} {_auc(0)} UNION ALL {_auc(1)} UNION ALL {_auc(2)}",
    "m17_insight": f"""WITH {v.PREDICTIONS}, m AS (SELECT {_metric_columns(4)} FROM ({_cells('predictions')}))
        SELECT '2024-01-01T00:00:00Z' AS evaluated_at, 'LogisticRegression' AS model_name,
          'Unknown' AS trained_at, (SELECT concat(count(*), ' rows') FROM predictions) AS notes, accuracy, f1_weighted, {', '.join(
            f"{k}_{s} AS {s}_{k}" for s in ['negative', 'neutral'] for k in ['precision', 'recall', 'f1'])},
          (SELECT string_agg(c, ',' ORDER BY l, p) FROM (SELECT l, p, count(predictions.label) AS c
            FROM (SELECT unnest([0, 1, 2]) AS l), (SELECT unnest([0, 1, 2]) AS p)
            LEFT JOIN predictions ON label = l AND prediction = p GROUP BY l, p)) AS matrix FROM m""",
}
