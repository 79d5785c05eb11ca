"""Joins and running counts that stay balanced when one key holds most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docintake.session import materialize


def key_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join of ``left`` with a ``right`` that is unique on ``on``.

    The plan is the same at every size and nothing runs when it is built. Adaptive
    execution measures both sides once they are there: it broadcasts a side below
    ``spark.sql.autoBroadcastJoinThreshold``, and it splits a partition in which a hot key,
    or rows without a key, pile up. No hint takes that choice away from it.
    """
    for k in on:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise ValueError(f"the sides have different types for {k}")
    return left.join(right, list(on), how)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    label: str,
    counts: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running values per key, up to and including each row.

    ``counts``: how many rows satisfy a condition, as ``name``, and how many do in
    the whole key, as ``name_total``. ``lasts``: the last value that is not NULL.

    ``keys + order`` must be unique; ``keys`` may be empty. A window over the key alone would put a whole
    key into one task, so the rows are range-partitioned on ``keys + order``, which
    cuts a large key into slices; windows run within slices, and each slice starts
    from what the slices before it add up to.
    """
    keys, order = list(keys), list(order)
    counts, lasts = dict(counts or {}), dict(lasts or {})
    inputs = {f"_c_{n}": F.coalesce(c, F.lit(False)).cast("long") for n, c in counts.items()}
    inputs.update({f"_l_{n}": c for n, c in lasts.items()})
    # A struct is never NULL, so rows with NULL keys meet in the join below as well.
    key = F.struct(*keys) if keys else F.lit(0)
    slices = materialize(
        df.withColumns(inputs)
        .repartitionByRange(*keys, *order)
        .withColumn("_slice", F.spark_partition_id()),
        label,
    ).withColumn("_key", key)

    # One row per key and slice: these windows are as small as the number of slices.
    whole = Window.partitionBy("_key")
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    stamped = {n: F.struct(*order, F.col(f"_l_{n}").alias("value")) for n in lasts}
    per_slice = slices.groupBy("_key", "_slice").agg(
        F.count(F.lit(1)),
        *[F.sum(f"_c_{n}").alias(f"_c_{n}") for n in counts],
        *[
            F.max(F.when(F.col(f"_l_{n}").isNotNull(), stamped[n]))["value"].alias(f"_l_{n}")
            for n in lasts
        ],
    )
    starts = per_slice.select(
        "_key",
        "_slice",
        *[F.coalesce(F.sum(f"_c_{n}").over(before), F.lit(0)).alias(f"_c0_{n}") for n in counts],
        *[F.sum(f"_c_{n}").over(whole).alias(f"{n}_total") for n in counts],
        *[F.last(f"_l_{n}", ignorenulls=True).over(before).alias(f"_l0_{n}") for n in lasts],
    )

    so_far = (
        Window.partitionBy("_key", "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = slices.withColumns(
        {
            **{f"_c1_{n}": F.sum(f"_c_{n}").over(so_far) for n in counts},
            **{f"_l1_{n}": F.last(f"_l_{n}", ignorenulls=True).over(so_far) for n in lasts},
        }
    )
    return within.join(starts, ["_key", "_slice"]).select(
        *df.columns,
        *[(F.col(f"_c0_{n}") + F.col(f"_c1_{n}")).alias(n) for n in counts],
        *[f"{n}_total" for n in counts],
        *[F.coalesce(f"_l1_{n}", f"_l0_{n}").alias(n) for n in lasts],
    )
