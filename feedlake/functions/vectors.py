"""Vector columns (array<float>): norms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.text import col_


def l2_norm(v) -> Column:
    return F.sqrt(F.aggregate(col_(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))
