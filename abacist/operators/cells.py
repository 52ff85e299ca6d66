"""Values of several columns cut into intervals, as one row per column and value."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(df: DataFrame, cuts: Mapping[str, Sequence[float]], keep: Sequence[str] = ()) -> DataFrame:
    """Rows ``(keep..., i, cell, x)``: column number, interval number and value.

    Interval k of a column holds the values from cut k-1 up to, but without, cut k; interval 0 lies
    below the first cut. The interval is found by binary search in the JVM. Missing and NaN values
    have no interval and a null ``x``.
    """
    names = list(cuts)
    inputs = [f"__v{i}" for i in range(len(names))]
    outputs = [f"__b{i}" for i in range(len(names))]
    values = df.select(*keep, *[F.nanvl(F.col(n).cast("double"), F.lit(None)).alias(v) for n, v in zip(names, inputs)])
    split = [i for i, n in enumerate(names) if len(cuts[n])]
    cut = values.fillna(math.nan, subset=inputs)
    if split:
        cut = Bucketizer(
            splitsArray=[[-math.inf, *cuts[names[i]], math.inf] for i in split],
            inputCols=[inputs[i] for i in split], outputCols=[outputs[i] for i in split], handleInvalid="keep",
        ).transform(cut)
    cut = cut.withColumns({b: F.lit(0) for i, b in enumerate(outputs) if i not in split})
    each = F.array(*[
        F.struct(
            F.lit(i).alias("i"),
            F.when(~F.isnan(v), F.col(b).cast("int")).alias("cell"),
            F.when(~F.isnan(v), F.col(v)).alias("x"),
        )
        for i, (v, b) in enumerate(zip(inputs, outputs))
    ])
    return cut.select(*keep, F.explode(each).alias("c")).select(*keep, "c.i", "c.cell", "c.x")
