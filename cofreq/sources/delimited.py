"""Delimited files with a header, columns picked by name or position (SRC-5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str] | Mapping[str, int],
                   *, sep: str = ",", header: bool = True,
                   n_columns: int | None = None) -> DataFrame:
    """Read a delimited text file with every column as STRING.

    ``columns`` is a list of header names, or a mapping ``name -> 0-based
    position`` (an include mask); positions need ``n_columns``
    so an explicit schema can be given and nothing is inferred.  Only the
    chosen columns are kept, so the scan is pruned to them.
    """
    reader = (spark.read.option("sep", sep).option("header", header)
              .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))
    if isinstance(columns, Mapping):
        if n_columns is None:
            raise ValueError("positional columns need n_columns")
        by_pos = {pos: name for name, pos in columns.items()}
        schema = StructType([StructField(by_pos.get(i, f"_c{i}"), StringType(), True)
                             for i in range(n_columns)])
        df = reader.schema(schema).option("enforceSchema", True).csv(path)
        return df.select(*[F.col(n) for n in columns.keys()])
    df = reader.option("inferSchema", False).csv(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])
