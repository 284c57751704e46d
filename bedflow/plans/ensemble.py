"""Ensemble of model outputs in the common format (U2, L2).

The union is distinct, as ``UNION`` is.  ``ensemble_top_k`` keeps the first k
rows of each model in a fixed order (the original took an unordered
``LIMIT 10``, which is not reproducible); Spark plans it as a distributed
take-ordered, never a full sort on one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedflow.schemas import COMMON_COLUMNS

TOP_K_ORDER = ["stay_key", "stay_key_seq", "stay_start_date", "stay_rate"]


def ensemble_union(*models: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [m.select(*COMMON_COLUMNS) for m in models]).distinct()


def ensemble_top_k(*models: DataFrame, k: int = 10) -> DataFrame:
    heads = [m.select(*COMMON_COLUMNS)
             .orderBy(*[F.col(c).asc_nulls_last() for c in TOP_K_ORDER]).limit(k)
             for m in models]
    return reduce(lambda a, b: a.unionByName(b), heads).distinct()
