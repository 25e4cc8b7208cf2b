"""Business codes to labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.constants import CODES


def code_label(code: Column | str, domain: str) -> Column:
    """Label of a code within its domain; null for unknown codes. A map literal, so no join."""
    pairs = [(c, label) for c, d, label in CODES if d == domain]
    if not pairs:
        raise ValueError(f"unknown code domain: {domain}")
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    return F.try_element_at(table, F.col(code) if isinstance(code, str) else code)


def code_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CODES, "code string, domain string, label string")
