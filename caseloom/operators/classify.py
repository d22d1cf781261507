"""Intent classifier: TF-IDF features and multinomial logistic regression."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    IDF,
    IndexToString,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from caseloom import config, schemas
from caseloom.functions import text as X
from caseloom.operators.similarity import default_stop_words


def training_rows(train: DataFrame, text: str = "customer_message", label: str = "intent") -> DataFrame:
    return train.select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("message"), F.col(label).cast("string").alias("intent")
    )


def fit_classifier(
    train: DataFrame,
    cfg: config.TriageConfig = config.DEFAULT,
    stop_words=None,
    text: str = "customer_message",
    label: str = "intent",
    strength: float = 1.0,
) -> PipelineModel:
    """Fit on a training split.

    ``strength`` is the inverse regularisation weight of the summed loss; Spark
    averages the loss, so its parameter is ``1 / (strength * rows)``.
    """
    rows = training_rows(train, text, label).persist(StorageLevel.MEMORY_AND_DISK)
    held = [rows]
    try:
        n = rows.count()
        tokenizer = RegexTokenizer(inputCol="message", outputCol="_words", pattern=X.TOKEN, gaps=False, minTokenLength=2)
        stops = list(default_stop_words() if stop_words is None else stop_words)
        remover = StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=stops)
        kept = remover.transform(tokenizer.transform(rows))
        terms = kept.select(F.explode("_kept").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        top = terms.orderBy(F.desc("n"), "term").limit(cfg.max_features).collect()  # ties at the cut go by term
        counter = CountVectorizerModel.from_vocabulary([r["term"] for r in top] or [""], inputCol="_kept", outputCol="_tf")
        # read by the weights and by the fit: the texts are cut into words twice, once for the terms and once for this;
        # even partitions, as every iteration waits for the largest
        parts = 2 * train.sparkSession.sparkContext.defaultParallelism
        counted = counter.transform(kept).select("_tf", "intent").repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(counted)
        idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted).idf
        weigh = ElementwiseProduct(
            inputCol="_tf", outputCol="_weighted", scalingVec=Vectors.dense(idf.toArray() + 1.0)
        )
        unit = Normalizer(inputCol="_weighted", outputCol="_features", p=2.0)
        names = StringIndexer(inputCol="intent", outputCol="_label", stringOrderType="alphabetAsc").fit(rows)
        data = names.transform(unit.transform(weigh.transform(counted))).select("_features", "_label")
        model = LogisticRegression(
            featuresCol="_features",
            labelCol="_label",
            rawPredictionCol="_raw",
            probabilityCol="_probability",
            predictionCol="_prediction",
            family="multinomial",
            maxIter=cfg.max_iter,
            regParam=1.0 / (strength * max(n, 1)),
            elasticNetParam=0.0,
            standardization=False,
            tol=1e-6,
        ).fit(data)
        back = IndexToString(inputCol="_prediction", outputCol="_intent", labels=names.labels)
        return PipelineModel([tokenizer, remover, counter, weigh, unit, model, back])
    finally:
        for df in held:
            df.unpersist()


def labels_of(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].getLabels())


def ranked_intents(probabilities: Column, labels: list[str]) -> Column:
    """Classes by falling probability, in label order on a tie; probabilities to four places."""
    names = F.array(*[F.lit(x) for x in labels])
    keyed = F.transform(probabilities, lambda p, i: F.struct((-p).alias("k"), i.alias("i"), F.get(names, i).alias("intent")))
    return F.transform(
        F.array_sort(keyed), lambda e: F.struct(e["intent"].alias("intent"), F.round(-e["k"], 4).alias("probability"))
    ).cast(schemas.TOP_INTENTS)


def classification(top_intents: Column) -> Column:
    """``struct<intent, confidence, top_intents>`` of ranked classes."""
    first = F.get(top_intents, F.lit(0))
    return F.struct(
        first["intent"].alias("intent"), first["probability"].alias("confidence"), top_intents.alias("top_intents")
    )


def classify(messages: DataFrame, model: PipelineModel, column: str = "message") -> DataFrame:
    """Add ``classification`` to every message."""
    scratch = messages.withColumn("_message", F.coalesce(F.col(column).cast("string"), F.lit("")))
    stages = [s.copy() for s in model.stages]
    stages[0].setInputCol("_message")
    scored = PipelineModel(stages).transform(scratch)
    top = ranked_intents(vector_to_array("_probability"), labels_of(model))
    return scored.select(*messages.columns, classification(top).alias("classification"))


def predict_golden(golden: DataFrame, model: PipelineModel) -> DataFrame:
    """Golden examples with true and predicted label and confidence, one row each."""
    scored = classify(golden, model, "customer_message")
    return scored.select(
        "example_id",
        "customer_message",
        F.col("intent").alias("true_intent"),
        F.col("classification.intent").alias("predicted_intent"),
        (F.col("intent") == F.col("classification.intent")).alias("correct"),
        F.col("classification.confidence").alias("confidence"),
    )
