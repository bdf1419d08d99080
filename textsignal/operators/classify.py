"""Text classifiers on MLlib: features, training, ranking, validation, prediction."""
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, NGram, Normalizer, RegexTokenizer,
                                SQLTransformer, StringIndexer)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textsignal import config
from textsignal.functions import text as X, vectors as V
from textsignal.operators import metrics
from textsignal.operators.bounds import bind
from textsignal.operators.forest import SparseForest
from textsignal.operators.splits import stratified_split
from textsignal.operators.svm import SquaredHingeSVM
from textsignal.sources.writers import stored

BOW, TFIDF = "bow", "tfidf"


def fit_counts(train, text, ngram=2, max_features=config.MAX_FEATURES):
    """Pipeline text → `_tf`: counts of the most used terms."""
    steps = [RegexTokenizer(inputCol=text, outputCol="_words", pattern=X.WORD + "{2,}", gaps=False)]
    terms = "_words"
    if ngram > 1:
        steps += [NGram(n=2, inputCol="_words", outputCol="_pairs"),
                  SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__")]
        terms = "_terms"
    steps.append(CountVectorizer(inputCol=terms, outputCol="_tf", vocabSize=max_features))
    return Pipeline(stages=steps).fit(train)


def _weigh(counted, kind):
    """The stages that make `features` of counts."""
    if kind == BOW:
        return [SQLTransformer(statement="SELECT *, _tf AS features FROM __THIS__")]
    # MLlib's idf lacks the +1 of the smooth form, so the weights are applied as an element-wise product.
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf.toArray() + 1.0
    return [ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_raw"),
            Normalizer(p=2.0, inputCol="_raw", outputCol="features")]


def fit_features(train, text, kind=TFIDF, ngram=2, max_features=config.MAX_FEATURES):
    """Pipeline text → `features`: term counts, or smooth-idf weights of unit length."""
    counts = fit_counts(train, text, ngram, max_features)
    return PipelineModel(stages=[*counts.stages, *_weigh(counts.transform(train), kind)])


def logistic_regression(n_rows, strength=1.0, max_iter=1000):
    return LogisticRegression(family="multinomial", maxIter=max_iter, tol=1e-4, regParam=strength / n_rows,
                              standardization=False)


def linear_svm(strength=1.0, max_iter=2000):
    return SquaredHingeSVM(strength=strength, max_steps=max_iter)


def random_forest(trees=200, max_depth=30, seed=config.SEED):
    # Where the fit is left to MLlib, rows remember their nodes; otherwise every pass sends the whole forest out and walks it from the roots.
    return SparseForest(numTrees=trees, maxDepth=max_depth, seed=seed, maxMemoryInMB=1024, cacheNodeIds=True)


def build_models(n_rows, trees=200, max_depth=30):
    """Name → (feature kind, n-gram length, classifier), in the order in which ties are decided."""
    # The names under which the models are reported.
    return {
        "BoW + LogReg": (BOW, 2, logistic_regression(n_rows)),
        "TF-IDF + LogReg": (TFIDF, 2, logistic_regression(n_rows)),
        "TF-IDF + SVM": (TFIDF, 2, linear_svm()),
        "TF-IDF + RF": (TFIDF, 1, random_forest(trees, max_depth)),
    }


def fit_labels(df, label):
    """Alphabetical label codes, as a pipeline stage."""
    return StringIndexer(inputCol=label, outputCol="label_code", stringOrderType="alphabetAsc",
                         handleInvalid="skip").fit(df)


def _decode(labels, code):
    return F.get(F.array(*[F.lit(l) for l in labels]), code.cast("int"))


def predictions(model, df, id_col, label, labels, name):
    """(model, id, y_true, y_pred)."""
    return model.transform(df).select(F.lit(name).alias("model"), id_col, F.col(label).alias("y_true"),
                                      _decode(labels, F.col("prediction")).alias("y_pred"))


def train_and_rank(df, text, label, id_col, test_size=config.TEST_SIZE, models=None, trees=200, max_depth=30):
    """Train every model on a stratified split and rank them by weighted F1 on the rest.

    Returns (scores with position, predictions, fitted models by name, name of the best).
    """
    # The split reads its rows three times, and texts are costly to make: once each, kept until the split is.
    usable = df.select(id_col, text, label).na.drop(subset=[text, label]).persist(StorageLevel.MEMORY_AND_DISK)
    parts = (stratified_split(usable, label, id_col, [("test", test_size)])
             .persist(StorageLevel.MEMORY_AND_DISK))
    parts.count()
    usable.unpersist()
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    indexer = fit_labels(train, label)
    specs = models or build_models(train.count(), trees, max_depth)
    fitted, preds, features = {}, [], {}
    for ngram in dict.fromkeys(spec[1] for spec in specs.values()):
        # Terms are found and counted once for all kinds of features.
        counts = fit_counts(train, text, ngram)
        counted = indexer.transform(counts.transform(train)).select("_tf", "label_code").persist(StorageLevel.MEMORY_AND_DISK)
        for kind in dict.fromkeys(spec[0] for spec in specs.values() if spec[1] == ngram):
            stages = _weigh(counted, kind)
            data = PipelineModel(stages=stages).transform(counted).select("features", "label_code").persist(StorageLevel.MEMORY_AND_DISK)
            data.count()
            features[kind, ngram] = [*counts.stages, *stages], data
        counted.unpersist()
    # A fit is hundreds of short jobs that leave cores idle, so the models are fitted side by side; none depends on another.
    fit = inheritable_thread_target(df.sparkSession)(lambda spec: spec[2].setLabelCol("label_code").fit(features[spec[0], spec[1]][1]))
    with ThreadPool(len(specs)) as pool:
        heads = pool.map(fit, specs.values(), chunksize=1)
    for (name, (kind, ngram, _)), head in zip(specs.items(), heads):
        fitted[name] = PipelineModel(stages=[*features[kind, ngram][0], head])
        preds.append(predictions(fitted[name], test, id_col, label, indexer.labels, name))
    for _, data in features.values():
        data.unpersist()
    every = preds[0]
    for p in preds[1:]:
        every = every.unionByName(p)
    # Kept as a table: the split and the models' work on it are not repeated by those who read the predictions.
    every = stored(every, "predictions")
    position = F.array_position(F.array(*[F.lit(n) for n in specs]), F.col("model"))
    scores = metrics.ranking(every).withColumn("position", position.cast("int"))
    scores = scores.sparkSession.createDataFrame(scores.toArrow(), schema=scores.schema)
    parts.unpersist()
    best = metrics.best_model(scores).head()["model"]
    return scores, every, fitted, best


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(path):
    return PipelineModel.load(path)


def _model_text(text, max_tokens):
    """The words of the whole text, or of its first `max_tokens` words."""
    tokens = X.tokenize(F.col(text))
    return F.array_join(tokens if max_tokens is None else X.head_tokens(tokens, max_tokens), " ")


def fit_with_validation(df, text, label, id_col, strengths=(10.0, 1.0, 0.1, 0.01), patience=2,
                        max_tokens=None):
    """Fit on 70 %, choose the regularisation by weighted F1 on 15 %, report on the last 15 %.

    Candidates run from strong to weak; the search stops after `patience` of them without gain.
    Returns (model, report on the test part, label map, choice table).
    """
    # The split reads its rows three times, and texts are costly to make: once each, kept until the split is.
    usable = bind(df.select(id_col, text, label), _text=_model_text(text, max_tokens)).select(id_col, F.col("_text").alias(text), label) \
        .na.drop(subset=[text, label]).persist(StorageLevel.MEMORY_AND_DISK)
    parts = (stratified_split(usable, label, id_col, [("test", config.TEST_SIZE), ("val", config.VAL_SIZE)])
             .persist(StorageLevel.MEMORY_AND_DISK))
    parts.count()
    usable.unpersist()
    train, val, test = (parts.filter(F.col("split") == s) for s in ("train", "val", "test"))
    indexer = fit_labels(train, label)
    stage = fit_features(train, text)
    data = indexer.transform(stage.transform(train)).select("features", "label_code").persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = data.count()
    best, best_f1, waited, tried = None, -1.0, 0, []
    for strength in strengths:
        head = logistic_regression(n_rows, strength).setLabelCol("label_code").fit(data)
        model = PipelineModel(stages=[*stage.stages, head])
        f1 = metrics.weighted_f1(predictions(model, val, id_col, label, indexer.labels, "candidate")).head()["f1_weighted"]
        tried.append((strength, f1))
        if f1 > best_f1:
            best, best_f1, waited = model, f1, 0
        else:
            waited += 1
            if waited >= patience:
                break
    data.unpersist()
    report = metrics.report(predictions(best, test, id_col, label, indexer.labels, "best"))
    spark = df.sparkSession
    # One row per class and average: taken now, so that the split need not stay cached.
    report = spark.createDataFrame(report.toArrow(), schema=report.schema)
    parts.unpersist()
    label_map = spark.createDataFrame(list(enumerate(indexer.labels)), "id int, label string")
    return best, report, label_map, spark.createDataFrame(tried, "strength double, f1_weighted double")


def predict(model, df, text, labels, id_col, max_tokens=None):
    """(id, label, ranking): top label and all labels with probabilities, for a table of texts.

    Row-wise only, so it also scores a stream.
    """
    cut = df.select(id_col, _model_text(text, max_tokens).alias(text))
    probs = vector_to_array("probability")
    ranked = V.ranked_labels(F.array(*[F.lit(l) for l in labels]), probs)
    return (model.transform(cut).withColumn("ranking", ranked)
            .select(id_col, F.get("ranking", F.lit(0))["label"].alias("label"), "ranking"))
