"""Documents about cell stations or others: a keyword heuristic, a trained text model, labels and reruns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, NGram, Normalizer, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.relational import last_wins

# Words that tell a station, radio markers and equipment markers.
STATION = ("базовая станци", "базовой станци", "базовую станци")
RADIO = ("gsm", "umts", "lte", "dcs", "wcdma", "imt", "5g", "nr ", "сотовой", "радиотелефон", "прто", "подвижной связи")
EQUIPMENT = ("антенн", "прто", "передатчик")
THRESHOLD = 0.6
LEAST_LABELS = 10


def _any(low: Column, words: tuple[str, ...]) -> Column:
    return low.rlike("|".join(f"\\Q{w}\\E" for w in words))


def heuristic(text: Column) -> Column:
    """Whether keywords tell a station: its name, or a radio marker beside equipment."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return _any(low, STATION) | (_any(low, RADIO) & _any(low, EQUIPMENT))


@dataclass(frozen=True)
class Metrics:
    accuracy: float
    auc: float
    f1: float
    precision: float
    recall: float


def text_pipeline(features: int = 1 << 16) -> Pipeline:
    """Words, pairs of words and grams of three letters, hashed and normalised, to a logistic regression."""
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"(?U)\W+")
    pairs = NGram(n=2, inputCol="words", outputCol="pairs")
    letters = RegexTokenizer(inputCol="text", outputCol="letters", pattern="(?=.)", minTokenLength=1)
    grams = NGram(n=3, inputCol="letters", outputCol="grams")
    hashed = [HashingTF(inputCol=c, outputCol=f"{c}_tf", numFeatures=features) for c in ("words", "pairs", "grams")]
    together = VectorAssembler(inputCols=[f"{c}_tf" for c in ("words", "pairs", "grams")], outputCol="raw")
    return Pipeline(stages=[words, pairs, letters, grams, *hashed, together, Normalizer(p=2.0, inputCol="raw", outputCol="features"), LogisticRegression(maxIter=30, regParam=1e-4)])


def train(labelled: DataFrame, *, trained_on: int | None = None, force: bool = False, features: int = 1 << 16) -> tuple[PipelineModel, Metrics] | None:
    """A model of (text, label) with its figures on a fifth held out, then refit on all. Null if there are as many labels as
    last time; an error with under ten, or without news if forced."""
    n = labelled.count()
    if n < LEAST_LABELS:
        raise ValueError(f"{n} labels; {LEAST_LABELS} are needed")
    if n == trained_on:
        if force:
            raise ValueError("no new labels since the last training")
        return None
    rows = labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("double").alias("label"))
    learn, held = rows.randomSplit([0.8, 0.2], 42)
    scored = text_pipeline(features).fit(learn).transform(held).cache()
    area = BinaryClassificationEvaluator().evaluate(scored)
    one = {m: MulticlassClassificationEvaluator(metricName=m, metricLabel=1.0).evaluate(scored) for m in ("accuracy", "f1", "precisionByLabel", "recallByLabel")}
    scored.unpersist()
    return text_pipeline(features).fit(rows), Metrics(one["accuracy"], area, one["f1"], one["precisionByLabel"], one["recallByLabel"])


def predict(model: PipelineModel | None, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """texts with is_cell and score: the model's margin against the threshold, or the heuristic at 0.5 without a model."""
    if model is None:
        return texts.withColumn("is_cell", heuristic(F.col("text"))).withColumn("score", F.lit(0.5))
    scored = model.transform(texts.withColumn("text", F.coalesce("text", F.lit(""))))
    margin = vector_to_array("rawPrediction")[1]
    return scored.select(*texts.columns, ((F.col("prediction") == 1) & (margin >= threshold)).alias("is_cell"), margin.alias("score"))


def upsert_labels(store: DataFrame, labels: DataFrame) -> DataFrame:
    """The store after new labels (path, sha256, mtime, is_cell): one row per path, the latest."""
    both = store.withColumn("_new", F.lit(0)).unionByName(labels.withColumn("_new", F.lit(1)))
    return last_wins(both, ["path"], ["_new", "mtime", "sha256"]).drop("_new")


def to_classify(files: DataFrame, outputs: DataFrame, store: DataFrame) -> DataFrame:
    """Files (path, mtime, sha256) without output, not done at the same path and time, nor with the same content and time."""
    left = files.join(outputs.select("path").distinct(), "path", "left_anti")
    done = store.filter("processed")
    left = left.join(done.select("path", "mtime").distinct(), ["path", "mtime"], "left_anti")
    return left.join(done.select("sha256", "mtime").distinct(), ["sha256", "mtime"], "left_anti").select(*files.columns)


def routed(texts: DataFrame, path: str) -> None:
    """Writes texts by class, year and month."""
    texts.write.mode("overwrite").partitionBy("is_cell", "year", "month").parquet(path)
