"""Human labels and the list of mixed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAW_LABEL = "Presentation?"
MIXED = 3


# Labels and the class each stands for; anything else is 0.
def opinion(raw: Column) -> Column:
    return F.when(raw == "Yes", 1).when(raw == "No", 2).when(raw == "50/50", 3).otherwise(0)


def ingest(raw: DataFrame) -> DataFrame:
    """Label rows with the opinion as a class and the link under its table name."""
    return raw.withColumn("classify_op", opinion(F.col(f"`{RAW_LABEL}`"))).withColumnRenamed(
        "LINK", "pdf_link"
    )


def value_counts(labels: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; rows without a value are not counted."""
    value = F.col(f"`{column}`")
    return (
        labels.where(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def mixed_worklist(dataset: DataFrame, folder: str) -> DataFrame:
    """Paths of the documents labelled as mixed."""
    return dataset.where(F.col("presentation") == MIXED).select(
        "fname", F.concat(F.lit(folder), F.col("fname")).alias("path")
    )
