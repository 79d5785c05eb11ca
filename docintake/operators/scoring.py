"""Scoring documents and pages, and ranking likely title pages."""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docintake.functions.scores import PLACES, best_class, logistic, margin

# Bytes of columns that a Python model is given at once, about.
MODEL_BYTES = 4 << 20

# Fixed value: pages tried per document.
TOP_PAGES = 3

# Pages of a document that are ranked in one place before the cut, by number.
PAGE_RUN = 1024


def score_documents(docs: DataFrame, margins: Mapping[int, Column]) -> DataFrame:
    """Class 1, 2 or 3 per document from one margin expression per class."""
    return docs.withColumn("pred", best_class(margins))


def pinned_classifier(
    spark: SparkSession, models: Mapping[int, tuple[Mapping[str, float], float]]
) -> PipelineModel:
    """An ML pipeline with known coefficients: per class the weights of its features and an
    intercept. It assembles the features, applies the multinomial model, and names the class
    by its number; it can be saved and loaded like one that was fitted."""
    classes = sorted(models)
    features = sorted({f for weights, _ in models.values() for f in weights})
    rows = [models[c][0].get(f, 0.0) for c in classes for f in features]
    context = spark.sparkContext
    matrix = DenseMatrix(len(classes), len(features), rows, isTransposed=True)
    intercepts = Vectors.dense([models[c][1] for c in classes])
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "pinned-classes", _py2java(context, matrix), _py2java(context, intercepts), len(classes), True
    )
    numbers = ", ".join(f"{c}D" for c in classes)
    named = f"SELECT * EXCEPT (prediction), array({numbers})[int(prediction)] AS prediction FROM __THIS__"
    return PipelineModel(
        [
            VectorAssembler(inputCols=features, outputCol="features"),
            LogisticRegressionModel(made),
            SQLTransformer(statement=named),
        ]
    )


def score_documents_with_model(docs: DataFrame, model: Transformer | str) -> DataFrame:
    """The same with a fitted ML model, given as an object or as a saved path."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    scored = model.transform(docs)
    return scored.select(*docs.columns, F.col("prediction").cast("int").alias("pred"))


def score_documents_with_function(
    docs: DataFrame,
    load_scorer: Callable[[], Callable[[pd.DataFrame], pd.Series]],
    columns: list[str],
    id_column: str = "doc_id",
) -> DataFrame:
    """The same with any Python model. ``load_scorer`` runs once per task, and only
    the named columns travel to Python. The model gets runs of rows of about ``MODEL_BYTES``,
    however large Arrow's batches are, so that few rows are Python objects at a time; nested
    values come as Arrow gives them, structs as dicts."""
    wanted = docs.select(id_column, *[c for c in columns if c != id_column])
    id_type = docs.schema[id_column].dataType.simpleString()
    most = MODEL_BYTES

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = load_scorer()

        def halves(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            n = rows.num_rows
            if n > 1 and rows.nbytes > most:
                yield from halves(rows.slice(0, n // 2))
                yield from halves(rows.slice(n // 2))
            elif n:
                yield rows

        for batch in batches:
            for rows in halves(batch):
                frame = rows.to_pandas()
                for name in frame.select_dtypes("datetimetz"):  # as in Spark's own frames
                    frame[name] = frame[name].dt.tz_localize(None).astype("datetime64[ns]")
                pred = pd.Series(scorer(frame)).astype("int32")
                kept = [rows.column(id_column), pa.array(pred.values, pa.int32())]
                yield pa.RecordBatch.from_arrays(kept, [id_column, "pred"])

    return wanted.mapInArrow(score, f"{id_column} {id_type}, pred int")


def spread(spark: SparkSession, path: str) -> tuple[str, str]:
    """Hand a model's file to all executors: its checksum, and its name there. ``path`` may lie in
    any store that Spark reads; a model is a file that fits into memory."""
    content = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    checksum = hashlib.sha256(content).hexdigest()
    name = f"docintake-model-{checksum}"
    if not any(known.endswith(name) for known in spark.sparkContext.listFiles):
        local = os.path.join(tempfile.mkdtemp(prefix="docintake-model-"), name)
        with open(local, "wb") as out:
            out.write(content)
        spark.sparkContext.addFile(local)
    return checksum, name


def score_documents_with_artifact(
    docs: DataFrame,
    path: str,
    load: Callable[[str], Callable[[pd.DataFrame], pd.Series]],
    columns: list[str],
    id_column: str = "doc_id",
) -> DataFrame:
    """The same with a Python model in a file. ``load`` gets the file's place on the executor and
    runs once per worker process, however many tasks that works through: models are kept there
    under their checksum."""
    checksum, name = spread(docs.sparkSession, path)

    def load_scorer() -> Callable[[pd.DataFrame], pd.Series]:
        import sys

        from pyspark import SparkFiles

        models = sys.__dict__.setdefault("_docintake_models", {})
        if checksum not in models:
            models[checksum] = load(SparkFiles.get(name))
        return models[checksum]

    return score_documents_with_function(docs, load_scorer, columns, id_column)


def page_scores(pages: DataFrame, weights: Mapping[str, float], intercept: float) -> DataFrame:
    """Probability that a page is the title page, from a logistic model."""
    return pages.withColumn("prob", logistic(margin(weights, intercept)))


def page_scores_with_model(pages: DataFrame, model: Transformer | str) -> DataFrame:
    if isinstance(model, str):
        model = PipelineModel.load(model)
    scored = model.transform(pages)
    positive = F.round(vector_to_array("probability")[1], PLACES)
    return scored.select(*pages.columns, positive.alias("prob"))


def title_page_top3(
    scored: DataFrame, k: int = TOP_PAGES, keep: Sequence[str] = ()
) -> DataFrame:
    """The k likeliest title pages per document; on a tie the later page comes first.

    The rank filter is pushed below the shuffle by document, so each task sends at most
    k pages of a document there. The sort before that cut would hold whatever a task has
    read, a whole row group with its texts; so pages are dealt first, by document and run
    of pages, into portions that adaptive execution cuts by size. Columns named in ``keep``
    ride along, which is cheaper than joining them to the result afterwards.
    """
    best_first = Window.partitionBy("doc_id").orderBy(F.desc("prob"), F.desc("page_num"))
    run = F.floor(F.col("page_num") / PAGE_RUN)
    return (
        scored.select("doc_id", "page_num", "prob", *keep)
        .withColumn("_run", run)
        .hint("rebalance", F.col("doc_id"), F.col("_run"))
        .drop("_run")
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
    )
