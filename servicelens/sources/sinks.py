"""Write named result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each table to ``{out_dir}/{name}`` (overwrite); returns the paths.

    Array columns are written as-is for Parquet and joined with " | " for CSV.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        out = df
        if fmt == "csv":
            for f in df.schema.fields:
                if isinstance(f.dataType, T.ArrayType):
                    out = out.withColumn(f.name, F.array_join(F.col(f.name).cast("array<string>"), " | "))
            out.write.mode("overwrite").option("header", True).csv(path)
        else:
            out.write.mode("overwrite").format(fmt).save(path)
        paths[name] = path
    return paths
