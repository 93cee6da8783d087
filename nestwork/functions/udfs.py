"""Small column helpers.

All of them are built-in expressions: no data goes to a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import FILE_STATUS

# Fixed value: kilometres per mile.
KM_PER_MILE = 1.60934


def distance_km(miles) -> Column:
    """X16/U2 as a native expression: NULL in, NULL out."""
    c = F.col(miles) if isinstance(miles, str) else miles
    return (c * F.lit(KM_PER_MILE)).cast("float")


def name_status(path) -> Column:
    """(success, message) of a file name; built-in expressions only."""
    p = F.col(path) if isinstance(path, str) else path
    stem = F.split(F.lower(p), r"\?")[0]
    ok = F.coalesce(stem.endswith(".gz") | stem.endswith(".gzip") | stem.endswith(".json"), F.lit(False))
    message = F.when(ok, "ok").otherwise("Error: The file is not a JSON file")
    return F.struct(ok.alias("success"), message.alias("message")).cast(FILE_STATUS)


def with_name_status(df: DataFrame, source_column: str, out: str = "name_status") -> DataFrame:
    """U4: add the status column (use with ``df.transform``)."""
    return df.withColumn(out, name_status(F.col(source_column)))
