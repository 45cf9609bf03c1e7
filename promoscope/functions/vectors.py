"""Vector columns as arrays."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_values(name: str) -> Column:
    """The vector's values, NULL for NULL (which ``vector_to_array`` rejects)."""
    return F.when(F.col(name).isNotNull(), vector_to_array(F.col(name)))
