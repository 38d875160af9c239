"""Tables, comments and tags through the session catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COLUMNS = "table_name string, column_name string, data_type string, comment string, ordinal_position int"


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def save_table(
    df: DataFrame, name: str, comment: str | None = None, path: str | None = None, partition_by: Sequence[str] = (),
    mode: str = "overwrite", properties: Mapping[str, str] | None = None,
) -> None:
    """Create or replace a Parquet table from a query."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{_quote(comment)}'")
    if properties:
        apply_tags(spark, name, properties)


def has_rows(spark: SparkSession, name: str) -> bool:
    """Does the table exist with at least one row?"""
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()


def save_if_empty(df: DataFrame, name: str, **kw) -> bool:
    """Load only when the target has no rows yet; tells whether it loaded."""
    if has_rows(df.sparkSession, name):
        return False
    save_table(df, name, **kw)
    return True


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def apply_comments(spark: SparkSession, table: str, comments: Mapping[str, str], table_comment: str | None = None) -> None:
    """Comment the columns of a table from a dictionary."""
    types = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields}
    for column, text in comments.items():
        spark.sql(f"ALTER TABLE {table} CHANGE COLUMN `{column}` `{column}` {types[column]} COMMENT '{_quote(text)}'")
    if table_comment:
        spark.sql(f"COMMENT ON TABLE {table} IS '{_quote(table_comment)}'")


def apply_tags(spark: SparkSession, table: str, tags: Mapping[str, str]) -> None:
    """Search tags as table properties."""
    pairs = ", ".join(f"'{_quote(k)}' = '{_quote(v)}'" for k, v in tags.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def table_tags(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def catalog_columns(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Column names, types and comments of tables as a frame (metadata only)."""
    rows = []
    for table in tables:
        for i, c in enumerate(spark.catalog.listColumns(table)):
            rows.append((table, c.name, c.dataType, c.description, i + 1))
    return spark.createDataFrame(rows, _COLUMNS)


def _documented():
    return F.col("comment").isNotNull() & (F.col("comment") != "")


def comment_coverage(columns: DataFrame) -> DataFrame:
    """Per table: columns, columns without a comment, percent documented."""
    done = F.sum(F.when(_documented(), 1).otherwise(0))
    total = F.count(F.lit(1))
    return columns.groupBy("table_name").agg(
        total.alias("colunas"), (total - done).alias("sem_comentario"), (F.lit(100.0) * done / total).alias("pct_documentado"))


def undocumented_columns(columns: DataFrame) -> DataFrame:
    return columns.filter(~_documented()).select("table_name", "column_name", "data_type", "ordinal_position")


def layer_summary(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Rows and number of columns per table."""
    out = None
    for label, table in tables.items():
        df = spark.table(table)
        row = df.agg(F.count(F.lit(1)).alias("registros")).select(
            F.lit(label).alias("tabela"), "registros", F.lit(len(df.columns)).cast("long").alias("colunas"))
        out = row if out is None else out.unionByName(row)
    return out
