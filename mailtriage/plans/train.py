"""Training, evaluation, persistence and use of the mail classifier."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailtriage import constants as K
from mailtriage.functions import features as FE
from mailtriage.operators import explain as E, metrics as M, ordering as O, tfidf as T
from mailtriage.schemas import require_columns
from mailtriage.session import staged_table

SOLVER_ROWS = 2000  # rows of a solver partition at least
SOLVER_ROW_GROUP = 128 << 20  # with small row groups an iteration took three times as long
TERMS = "term_weights"  # the vector of all blocks


@dataclass
class TrainedModel:
    """Fitted stages, the names of all features, the vector functions of the blocks and the hold-out metrics."""

    model: PipelineModel
    feature_names: list  # (source, value) per vector position
    metrics: dict = field(default_factory=dict)
    weights: list = field(default_factory=list)  # inverse document frequency per vector position, 1 for numeric ones
    functions: dict = field(default_factory=dict)  # name of the vector function by block


def feature_table(df: DataFrame, keep: Iterable[str], stops: Iterable[str] | None = None,
                  training: bool = True) -> DataFrame:
    """Kept columns, the 15 numeric features and the three texts that terms are cut from."""
    frame = FE.training_features(df) if training else FE.scoring_features(df)
    return T.text_columns(frame, stops).select(*keep, *K.NUMERIC_COLUMNS, *[b.text for b in T.BLOCKS])


def term_table(df: DataFrame, keep: Iterable[str], stops: Iterable[str] | None = None) -> DataFrame:
    """Kept columns and the three term columns, spelt out: for looking at terms, not for training."""
    return T.term_columns(FE.training_features(df), stops).select(*keep, *[b.terms for b in T.BLOCKS])


def _numeric_stages(scaling: list) -> list:
    scaled = ", ".join(f"({r['feature']} - ({r['mean']!r})) / ({r['std']!r}) AS z_{r['feature']}" for r in scaling)
    return [SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
            VectorAssembler(inputCols=[TERMS] + [f"z_{c}" for c in K.NUMERIC_COLUMNS],
                            outputCol="features")]


def feature_stages(spark: SparkSession, train: DataFrame) -> tuple[list, TrainedModel]:
    """(stages that end in ``features``, a model with their names and functions) for a staged feature table.

    What reaches the driver is bounded by the term caps.
    """
    n_train = train.count()
    kept: dict[str, list] = {b.name: [] for b in T.BLOCKS}
    for r in T.block_vocabularies(train).orderBy("block", F.desc("tf"), "term").collect():
        kept[r["block"]].append(r)
    blocks, made, function = [], TrainedModel(None, []), f"{TERMS}_{uuid.uuid4().hex}"
    for block in T.BLOCKS:
        if not kept[block.name]:
            raise ValueError(f"no term of block {block.name} occurs in {K.MIN_DOC_FREQ} mails")
        terms, weights = [r["term"] for r in kept[block.name]], T.block_weights(kept[block.name], n_train)
        made.functions[block.name] = function
        blocks.append((block.words, terms, weights))
        made.feature_names += [(block.name, t) for t in terms]
        made.weights += weights
    T.register_blocks(spark, function, blocks)
    stages = [T.block_stage(T.BLOCKS, function, TERMS), *_numeric_stages(M.scaling(train).collect())]
    made.feature_names += [("numeric", c) for c in K.NUMERIC_COLUMNS]
    made.weights += [1.0] * len(K.NUMERIC_COLUMNS)
    return stages, made


def solver_input(rows: DataFrame) -> DataFrame:
    """label, weight, features as the solver reads them in every iteration: written once, in few partitions."""
    staged = staged_table(rows.select("label", "weight", "features"), "vectors", SOLVER_ROW_GROUP)
    return staged.coalesce(max(1, staged.count() // SOLVER_ROWS))


def fit(corpus: DataFrame, key: str = "email_id", test_size: float = 0.2, seed: int = 42,
        threshold: float = K.MODEL_THRESHOLD, max_iter: int = K.MAX_ITERATIONS,
        stops: Iterable[str] | None = None) -> TrainedModel:
    """Split, select vocabularies, fit a balanced L2 logistic regression, evaluate.

    Texts are staged once and so are the vectors, the solver's only input.  It stops by ``K.SOLVER_TOLERANCE``;
    ``max_iter`` is a ceiling.  What reaches the driver is bounded by the term caps.
    """
    require_columns(corpus, K.REQUIRED_COLUMNS)
    spark = corpus.sparkSession
    labelled = corpus.withColumn("label", F.col("label").cast("int"))
    missing = labelled.where("label is null").count()
    if missing:
        raise ValueError(f"{missing} rows have no label of 0 or 1")
    # the split reads keys and labels only, so it comes before the features
    split = O.stratified_split(labelled, key, "label", test_size, seed)
    rows = staged_table(feature_table(split, [key, "label", "is_test"], stops), "features")
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    weights = M.class_weights(train)
    n_train = int(weights.agg(F.sum("n")).first()[0])
    stages, fitted = feature_stages(spark, train)

    # one row per class
    weighted = train.join(F.broadcast(weights.select("label", "weight")), "label")
    shaped = Pipeline(stages=stages).fit(weighted)
    # loss is averaged over the weights, which add up to the number of training rows
    regression = LogisticRegression(
        labelCol="label", weightCol="weight", regParam=1.0 / (K.REGULARISATION_C * n_train),
        elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=K.SOLVER_TOLERANCE)
    solved = regression.fit(solver_input(shaped.transform(weighted)))
    fitted.model = PipelineModel([*shaped.stages, solved])
    fitted.metrics = evaluate(fitted, test, threshold) | {
        "model_name": K.MODEL_NAME, "threshold": threshold,
        "trained_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        "training_rows": rows.count(), "feature_count": len(fitted.feature_names),
    }
    return fitted


def gradient(fitted: TrainedModel, vectors: DataFrame) -> tuple[np.ndarray, float]:
    """(gradient of the mean penalised loss by coefficient, by intercept) at the fit, over label, weight and features:
    what vanishes at the optimum.  Sums are made per partition; one vector a partition reaches the driver's tree."""
    solved = fitted.model.stages[-1]
    margin = solved.transform(vectors).withColumn("_r", F.col("weight") * (vector_to_array("probability")[1] - F.col("label")))
    total = margin.agg(F.sum("weight"), F.sum("_r")).first()
    entries = margin.select("_r", F.inline(vector_entries("features")))
    sums = {r["i"]: r["g"] for r in entries.groupBy("i").agg(F.sum(F.col("_r") * F.col("x")).alias("g")).collect()}
    coefficients = solved.coefficients.toArray()
    slopes = np.array([sums.get(i, 0.0) for i in range(len(coefficients))]) / total[0]
    return slopes + solved.getRegParam() * coefficients, total[1] / total[0]


def probabilities(fitted: TrainedModel, features: DataFrame) -> DataFrame:
    """Feature table with the probability ``p`` of phishing."""
    scored = fitted.model.transform(features)
    return scored.withColumn("p", vector_to_array("probability")[1])


def evaluate(fitted: TrainedModel, test: DataFrame, threshold: float = K.MODEL_THRESHOLD) -> dict:
    scored = staged_table(probabilities(fitted, test).select("label", "p"), "hold-out")
    return M.rates(M.confusion(scored, threshold)).first().asDict() | M.roc_auc(scored).first().asDict()


def apply(fitted: TrainedModel, mails: DataFrame, key: str = "email_id") -> DataFrame:
    """key, p, features of mails to score, staged: prediction and explanation share it."""
    scored = probabilities(fitted, feature_table(mails, [key], training=False))
    return staged_table(scored.select(key, "p", "features"), "model-output")


def predict(fitted: TrainedModel, mails: DataFrame, key: str = "email_id") -> DataFrame:
    """key, p for mails to score."""
    return probabilities(fitted, feature_table(mails, [key], training=False)).select(key, "p")


def vector_entries(vectors: str) -> Column:
    """array<struct<i, x>>: the entries of a vector column other than 0, without a copy for Python."""
    held = F.unwrap_udt(vectors)
    places = F.when(held["type"] == 0, held["indices"]).otherwise(F.slice(F.sequence(F.lit(0), F.size(held["values"])), 1, F.size(held["values"])))
    entries = F.zip_with(places, held["values"], lambda i, x: F.struct(i.alias("i"), x.alias("x")))
    return F.filter(entries, lambda e: e["x"] != 0)


def _indicators(fitted: TrainedModel, vectors: DataFrame, limit: int, name_numeric: bool) -> DataFrame:
    """``vectors`` with ``model_indicators``.  Products of values and coefficients stay
    sparse; only the strongest reasons leave the task."""
    coefficients = fitted.model.stages[-1].coefficients.toArray()
    spark = vectors.sparkSession
    # as long as the feature vector, whose length the term caps bound
    names = spark.createDataFrame(
        [(i, s, v) for i, (s, v) in enumerate(fitted.feature_names)], "i int, source string, value string")
    named = names.select("i", E.readable_reason(F.col("source"), F.col("value"), name_numeric).alias("r"))
    reasons = [r["r"] for r in named.orderBy("i").collect()]
    # a reason by its place in the order of names, -1 where there is none
    spelt = sorted({r for r in reasons if r is not None}, key=str.encode)
    place = {r: i for i, r in enumerate(spelt)}
    held = spark.sparkContext.broadcast((np.array([place.get(r, -1) for r in reasons], np.int64), spelt))
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(coefficients), inputCol="features", outputCol="_products")

    # sources whose features have reasons, as runs of places: other entries do not leave the vector
    runs = [(min(p), max(p)) for p in ([i for i, (s, _) in enumerate(fitted.feature_names) if s == source and reasons[i] is not None]
                                       for source in dict.fromkeys(s for s, _ in fitted.feature_names)) if p]

    @F.arrow_udf("array<struct<reason:string,impact:double>>")
    def strongest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places, spelt = held.value
        spelt = pa.array(spelt, pa.string())
        for batch in batches:
            found, value = (x.to_numpy(zero_copy_only=False) for x in batch.flatten().flatten())
            row, reason = np.repeat(np.arange(len(batch)), pc.list_value_length(batch).to_numpy(zero_copy_only=False)), places[found]
            known = reason >= 0
            row, reason, value = row[known], reason[known], value[known]
            order = np.lexsort((-value, reason, row))  # of the features of one reason the strongest
            row, reason, value = row[order], reason[order], value[order]
            first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(reason, prepend=-1) != 0))
            row, reason, value = row[first], reason[first], value[first]
            order = np.lexsort((reason, -value, row))
            order = order[np.arange(len(row)) - np.searchsorted(row, row) < limit]
            row, reason, value = row[order], reason[order], value[order]
            entries = pa.StructArray.from_arrays([spelt.take(pa.array(reason)), pa.array(value)], names=["reason", "impact"])
            yield pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)), entries)

    positive = F.filter(vector_entries("_products"), lambda e: (e["x"] > 0) & functools.reduce(
        Column.__or__, [e["i"].between(*run) for run in runs], F.lit(False)))
    rows = scaled.transform(vectors).withColumn("_top", strongest(positive))
    return rows.withColumn("model_indicators", F.transform("_top", lambda x: F.struct(
        x["reason"].alias("reason"), F.bround(x["impact"], 4).alias("impact")))).drop("_top", "_products")


def explain(fitted: TrainedModel, applied: DataFrame, key: str = "email_id", limit: int = 5,
            name_numeric: bool = False) -> DataFrame:
    """key, model_indicators: strongest reasons per mail of an :func:`apply` result."""
    return _indicators(fitted, applied, limit, name_numeric).select(key, "model_indicators")


def annotate(fitted: TrainedModel, mails: DataFrame, limit: int = 5, name_numeric: bool = False) -> DataFrame:
    """``mails`` with the probability ``p`` and ``model_indicators``, row by row: texts stay
    where they are and no feature vector is written."""
    frame = mails.withColumn("_mail", F.struct(*[F.col(f"`{c}`") for c in mails.columns]))
    scored = probabilities(fitted, feature_table(frame, ["_mail"], training=False))
    rows = _indicators(fitted, scored, limit, name_numeric)
    return rows.select("_mail.*", "p", "model_indicators")


# --- persistence -----------------------------------------------------------------

def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Let ``path/current`` name a finished version, by one rename."""
    fresh, files = _path(spark, f"{path}/current-{version}")
    out = files.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(_path(spark, f"{path}/current")[0]), how)


def published(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that readers see, None where no save has ended."""
    pointer, files = _path(spark, f"{path}/current")
    if not files.exists(pointer):
        return None
    return f"{path}/versions/{spark.read.text(f'{path}/current').first()[0].strip()}"


def save(fitted: TrainedModel, spark: SparkSession, path: str) -> None:
    """Model directory, features and a one-row metrics document in a version folder of their own, published when all are
    there.  A save that breaks off leaves the last published version in place."""
    version = uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    fitted.model.write().save(f"{folder}/model")
    rows = [(i, s, v, w, fitted.functions.get(s)) for i, ((s, v), w) in enumerate(zip(fitted.feature_names, fitted.weights))]
    spark.createDataFrame(rows, "i int, source string, value string, weight double, function string").write.parquet(f"{folder}/features")
    spark.createDataFrame([fitted.metrics]).coalesce(1).write.json(f"{folder}/metrics")
    publish(spark, path, version)


def load(spark: SparkSession, path: str) -> TrainedModel:
    """The published version."""
    folder = published(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no model has been published in {path}")
    rows = spark.read.parquet(f"{folder}/features").orderBy("i").collect()
    functions, blocks = {}, {}  # blocks by function: models of earlier versions have one for each block
    for block in T.BLOCKS:
        own = [r for r in rows if r["source"] == block.name]
        functions[block.name] = own[0]["function"]
        blocks.setdefault(own[0]["function"], []).append((block.words, [r["value"] for r in own], [r["weight"] for r in own]))
    for function, held in blocks.items():
        T.register_blocks(spark, function, held)
    model = PipelineModel.load(f"{folder}/model")
    metrics = spark.read.json(f"{folder}/metrics").first().asDict()
    return TrainedModel(model, [(r["source"], r["value"]) for r in rows], metrics, [r["weight"] for r in rows], functions)


def train_or_load(spark: SparkSession, path: str, corpus: DataFrame, force: bool = False, **options) -> TrainedModel:
    """Load the published model; train and save when there is none or when forced."""
    if published(spark, path) is not None and not force:
        return load(spark, path)
    fitted = fit(corpus, **options)
    save(fitted, spark, path)
    return fitted
