"""The stored cube kept fresh: sums of new rows are added month by month, and only the months they touch are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import CUBE_KEYS, MEASURES

_MONTH, _BATCH = "ano_mes", "lote"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def refresh_cube(increment: DataFrame, path: str, batch: int) -> list[str | None]:
    """Add the cube of new rows (``additive_cube`` of them) to the cube stored at ``path``; the months written.

    The sums of each batch are kept as parcels (``path/parcelas``, by batch and month). A touched month of the cube
    (``path/fato``) is the sum of its parcels and replaces that month's files alone; other months are neither read nor written. Running a batch again
    replaces its parcels and gives the same months, so a refresh that broke off is simply run again. Flights without a month are a month of
    their own. The months of a batch are few (a calendar bounds them) and are all that comes to the driver.
    """
    spark = increment.sparkSession
    columns = [*CUBE_KEYS, *MEASURES]
    rows = increment.select(*columns)
    schema = T.StructType([*rows.schema.fields, T.StructField(_BATCH, T.IntegerType())])
    parcels = f"{path}/parcelas"
    known = _months(spark, parcels, schema, batch)
    rows.write.mode("overwrite").partitionBy(_MONTH).parquet(f"{parcels}/{_BATCH}={batch}")
    months = sorted(known | _months(spark, parcels, schema, batch), key=lambda m: (m is not None, m))
    if not months:
        return []
    named = [m for m in months if m is not None]
    touched = F.col(_MONTH).isin(*named) if named else F.lit(False)
    if None in months:
        touched = touched | F.col(_MONTH).isNull()
    # One shuffle serves the sums and the files: ranges over month and hash hold all parcels of a key, split a large month, and
    # leave few months to a task.
    others = [k for k in CUBE_KEYS if k != _MONTH]
    ranged = _read(spark, parcels, schema).where(touched).withColumn("_h", F.xxhash64(*others)).repartitionByRange(_MONTH, "_h")
    sums = ranged.groupBy(_MONTH, "_h", *others).agg(*[F.sum(m).alias(m) for m in MEASURES]).select(*columns)
    sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_MONTH).parquet(f"{path}/fato")
    return months


def _months(spark: SparkSession, parcels: str, schema, batch: int) -> set:
    """Months that a batch's parcels have now; none before it was written."""
    try:
        at = _read(spark, parcels, schema).where(F.col(_BATCH) == batch)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return set()
        raise
    return {r[0] for r in at.select(_MONTH).distinct().collect()}


def refreshed_cube(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored cube, with the columns of ``like`` (any ``additive_cube``)."""
    return _read(spark, f"{path}/fato", like.select(*CUBE_KEYS, *MEASURES).schema)
