"""Rows and the bands they lie in: a join on ranges without comparing every row with every band.

The range of the values is cut into equal bins. A band is listed in the bins it touches, a value lies in one bin, so bin and range
together find every band of a value once, and the join is an equi-join that Spark may broadcast, sort or split as it likes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins that the values are cut into; also the most rows a band takes.
BINS = 1024


def band_join(rows: DataFrame, value: str, bands: DataFrame, low: str = "low", high: str = "high", closed: bool = False, bins: int = BINS) -> DataFrame:
    """``rows`` with the columns of every band whose range from ``low`` up to ``high`` (itself only if ``closed``) has the value.

    Bands may overlap, and give several rows then. A null border is none: such a band goes on without end. A value in no band, a null and a NaN
    give no row; a band whose borders are the wrong way round or NaN has no values. Columns of ``bands`` must be named differently from those of ``rows``, except for nothing.
    """
    x = F.col(value)
    least, most = rows.agg(F.min(F.when(~F.isnan(x.cast("double")), x)).cast("double"), F.max(F.when(~F.isnan(x.cast("double")), x)).cast("double")).first()
    if least is None:
        least = most = 0.0
    least, most = max(least, -1e300), min(most, 1e300)
    width = (most - least) / bins
    width = width if width > 0 and math.isfinite(width) else 1.0

    def bin_of(v: Column) -> Column:
        return F.least(F.greatest(F.floor((v.cast("double") - least) / width), F.lit(0)), F.lit(bins)).cast("int")

    first = F.when(F.col(low).isNull(), F.lit(0)).otherwise(bin_of(F.col(low)))
    last = F.when(F.col(high).isNull(), F.lit(bins)).otherwise(bin_of(F.col(high)))
    right_way = F.coalesce(F.col(low) <= F.col(high), F.lit(True))
    listed = bands.where(right_way).withColumn("_bin", F.explode(F.sequence(first, F.greatest(first, last))))
    inside = F.coalesce(x >= F.col(low), F.lit(True))
    inside &= F.coalesce(x <= F.col(high) if closed else x < F.col(high), F.lit(True))
    known = rows.where(x.isNotNull() & ~F.isnan(x.cast("double"))).withColumn("_bin", bin_of(x))
    return known.join(listed, "_bin").where(inside).drop("_bin")
