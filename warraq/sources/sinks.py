"""Sinks: JSON Lines, tables, batches of fixed size, exports cut at preferred places, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from warraq.operators.slicing import prefix_sums


def write_json_lines(df: DataFrame, path: str) -> None:
    """SNK1."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def rebuild(df: DataFrame, path: str, partition: str, order: list[str]) -> None:
    """SNK4, SNK5: a fresh Parquet table, one folder per partition value, sorted within files for pruning; a large value spreads over several tasks."""
    salted = df.repartition(F.col(partition), F.pmod(F.xxhash64(*order), F.lit(16)))
    salted.sortWithinPartitions(partition, *order).write.mode("overwrite").partitionBy(partition).parquet(path)


def batches(df: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """SNK6, W25: batch_no (from 0) of at most ``size`` rows of one key. The first order column is a number; a key may be large."""
    return prefix_sums(df, [key], order, F.lit(1), "_place").withColumn("batch_no", F.floor(F.col("_place") / size)).drop("_place")


def equal_parts(df: DataFrame, key: str, order: list[str], size: Column, most: int) -> DataFrame:
    """SNK8: parts of about equal size, as few as keep to ``most`` on average; a row belongs where its beginning falls. The first order column is a number; a key may be large."""
    sized = prefix_sums(df, [key], order, size, "_before", "_total")
    n = F.greatest(F.ceil(F.col("_total") / most), F.lit(1))
    part = F.when(F.col("_total") > 0, F.least(F.floor(F.col("_before") * n / F.col("_total")), n - 1)).otherwise(F.lit(0))
    return sized.withColumn("n_parts", n).withColumn("part_no", part).drop("_before", "_total")


def split_export(df: DataFrame, key: str, order: list[str], most: int, soft: float = 0.85, most_bytes: int | None = None) -> DataFrame:
    """SNK7: files of at most about ``most`` words and ``most_bytes`` bytes: a new one begins at a page (n_words, is_start, and n_bytes where bytes are bounded) once ``soft`` of the
    words is reached and the page begins a chapter, or once it is full by either measure.

    Adds file_no and header, the line that a file after the first begins with (null: none). A fold over each book's pages in order.
    """
    import pandas as pd

    columns = df.columns

    def one(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable")
        at, used, size, out = 0, 0, 0, []
        for n, b, start in zip(g["n_words"], g["n_bytes"] if most_bytes else g["n_words"], g["is_start"]):
            full = used >= most or bool(most_bytes) and size >= most_bytes
            if used and (full or used >= soft * most and bool(start)):
                at, used, size = at + 1, 0, 0
            used, size = used + int(n), size + int(b)
            out.append(at)
        return g.assign(file_no=out)[[*columns, "file_no"]]

    files = df.groupBy(key).applyInPandas(one, _with(df, "file_no int"))
    return files.withColumn("header", F.when(F.col("file_no") > 0, F.concat(F.lit("# "), F.col(key), F.lit(", continued, part "), (F.col("file_no") + 1).cast("string"))))


def duplicates(df: DataFrame, keys: list[str], rid: str) -> DataFrame:
    """SNK3: keys under which several rows came: n, first (the row that is kept, the least id), and the other ids in one text."""
    ids = F.array_sort(F.collect_set(rid))
    per = df.groupBy(*keys).agg(ids.alias("_ids")).where("size(_ids) > 1")
    return per.select(*keys, F.size("_ids").alias("n"), F.get("_ids", F.lit(0)).alias("first"), F.array_join(F.transform(F.slice("_ids", F.lit(2), F.size("_ids")), lambda x: x.cast("string")), ",").alias("others"))


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """A18, SNK10: df with counters that are filled while it is written or read whole; observation.get has them then."""
    seen = Observation()
    return df.observe(seen, *(c.alias(k) for k, c in metrics.items())), seen


def _with(df: DataFrame, field: str):
    from pyspark.sql.types import StructType

    return StructType([*df.schema.fields, *StructType.fromDDL(field).fields])


def as_json(df: DataFrame) -> DataFrame:
    """SNK9: each row as one JSON text, nulls included."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
