"""Raw tables from messy files: every column text, nothing dropped but preamble and header lines."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_name
from .quoted import records

PREAMBLE = r"^\W*Atualizado em"
# A character no file contains: with it as the NULL text, no word in a field is read as NULL.
_NO_NULL = "\u0001"


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def with_audit(df: DataFrame, path_column: str = "_metadata.file_path") -> DataFrame:
    """Add the source file and the load time."""
    return df.withColumns({"_source_file": F.col(path_column), "_ingestion_timestamp": F.current_timestamp()})


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def profile_schema(spark: SparkSession, path: str, sep: str = ";", sampling: float = 0.1, **options) -> list[tuple[str, str]]:
    """Names and inferred types of a delimited file, for a first look only."""
    df = spark.read.options(**options).csv(path, header=True, sep=sep, inferSchema=True, samplingRatio=sampling)
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def headers_of(spark: SparkSession, paths: Sequence[str], sep: str = ";", encoding: str = "UTF-8", preamble: str = PREAMBLE) -> dict[str, tuple[str, ...]]:
    """Clean column names of each file: its first line that is neither empty nor preamble, however far down.

    One parallel pass over all files; one line per file comes back. A file without such a line has no row either.
    """
    # A separator no file contains: each line is one field, decoded with the file's own encoding.
    lines = spark.read.schema("value string").csv(list(paths), sep="\u0002", encoding=encoding, header=False, quote="")
    lines = lines.select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    lines = lines.filter(F.col("value").isNotNull() & ~F.col("value").rlike(preamble))
    first = lines.groupBy("file_path").agg(F.min_by("value", F.struct("file_block_start", "n")).alias("line"))
    return {unquote(r["file_path"]): tuple(clean_name(c.strip('"')) for c in r["line"].split(sep)) for r in first.collect()}


def header_of(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8", preamble: str = PREAMBLE) -> list[str]:
    """The one header of a file or of all files of a path."""
    found = set(headers_of(spark, [path], sep, encoding, preamble).values())
    if len(found) != 1:
        raise ValueError(f"{path}: {len(found)} different headers; read_raw_layouts stacks files of several")
    return list(found.pop())


def read_raw_csv(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, sep: str = ";",
    encoding: str = "UTF-8", preamble: str = PREAMBLE, audit: bool = True, quote: str = '"', corrupt: str | None = "_corrupt", multiline: bool = False, escape: str = "\\",
) -> DataFrame:
    """Delimited files as text columns, read in parallel with one scan.

    Lines are dropped by content: a preamble is a line of one field that matches ``preamble``, a
    header repeats the column names. So the rule holds in every split of every file, and a file
    with no line after its header adds no row. Empty fields are ``''``, never NULL. A line with too few or
    too many fields also shows whole in ``corrupt``. ``multiline`` allows quoted line breaks: records are cut in every split
    of every file (``quoted.records``), for encodings whose quotes and line breaks are single bytes.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if columns is None:
        found = set(headers_of(spark, paths, sep, encoding, preamble).values())
        if len(found) != 1:
            raise ValueError(f"{len(found)} different headers; read_raw_layouts stacks files of several")
        columns = found.pop()
    columns = list(columns)
    schema = _text_schema([*columns, corrupt] if corrupt else columns)
    options = {"sep": sep, "quote": quote, "escape": escape, "nullValue": _NO_NULL, "emptyValue": "", "mode": "PERMISSIVE"}
    options |= {"columnNameOfCorruptRecord": corrupt} if corrupt else {}
    if multiline:
        whole = records(spark, paths, sep, quote, encoding, escape)
        df = whole.select(F.from_csv("text", F.lit(schema.toDDL()), options).alias("_p"), "_file").select("_p.*", "_file")
        df = with_audit(df, "_file").drop("_file") if audit else df.drop("_file")
    else:
        df = spark.read.schema(schema).options(encoding=encoding, header="false", enforceSchema="true", **options).csv(paths)
        df = with_audit(df) if audit else df
    cols = [F.col(f"`{c}`") for c in columns]
    alone, header = F.lit(True), F.lit(True)
    for i, (name, c) in enumerate(zip(columns, cols)):
        header = header & (F.coalesce(_clean(c), F.lit("")) == clean_name(name))
        if i:
            alone = alone & c.isNull()
    skip = (alone & F.coalesce(cols[0].rlike(preamble), F.lit(False))) | header
    kept = df.filter(~skip)
    return kept.select(*[F.coalesce(c, F.lit("")).alias(n) for n, c in zip(columns, cols)], *[c for c in kept.columns if c not in columns])


def _clean(c: Column) -> Column:
    """A header field the way column names are cleaned."""
    return F.regexp_replace(F.replace(F.trim(F.replace(c, F.lit("\ufeff"), F.lit(""))), F.lit(" "), F.lit("_")), r"[,;{}()\n\t=]", "")


def read_raw_layouts(spark: SparkSession, files: Sequence[str], sep: str = ";", encoding: str = "UTF-8", preamble: str = PREAMBLE) -> DataFrame:
    """Files of different headers stacked by column name; columns a file lacks are NULL.

    One pass finds every file's header; the files of each header are then one parallel scan.
    """
    groups: dict[tuple, list[str]] = {}
    for f, header in headers_of(spark, files, sep, encoding, preamble).items():
        groups.setdefault(header, []).append(f)
    if not groups:
        raise ValueError("no file has a header")
    out = None
    for header, members in sorted(groups.items()):
        part = read_raw_csv(spark, sorted(members), header, sep, encoding, preamble)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """A malformed file kept line by line with a line id."""
    lines = spark.read.text(path).select(F.col("value").alias("raw_line"), "_metadata.file_path")
    return lines.withColumns({
        "linha_id": F.monotonically_increasing_id(), "_source_file": F.col("file_path"), "_ingestion_timestamp": F.current_timestamp(),
    }).drop("file_path")


def parse_raw_lines(df: DataFrame, columns: Sequence[str], line: str = "raw_line", sep: str = ";", corrupt: str = "_corrupt") -> DataFrame:
    """Split kept lines into text columns; a line with the wrong number of fields also shows in ``_corrupt``."""
    schema = ", ".join(f"`{c}` STRING" for c in [*columns, corrupt])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "nullValue": _NO_NULL, "emptyValue": ""}
    parsed = df.withColumn("_p", F.from_csv(F.col(line), F.lit(schema), options))
    fields = [
        F.when(F.col(f"_p.{corrupt}").isNull(), F.coalesce(F.col(f"_p.`{c}`"), F.lit(""))).otherwise(F.col(f"_p.`{c}`")).alias(c)
        for c in columns
    ]
    rest = [c for c in df.columns if c != line]
    return parsed.select(*fields, F.col(f"_p.{corrupt}").alias(corrupt), *rest)


# --- Files ---------------------------------------------------------------------------------------

def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Every file below ``root``: path, name, folder, size and time. The content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("nome"), F.regexp_replace("path", "/[^/]*$", "").alias("pasta"),
        F.col("length").alias("bytes"), F.col("modificationTime").alias("modificado_em"))


def folder_summary(files: DataFrame) -> DataFrame:
    return files.groupBy("pasta").agg(F.count(F.lit(1)).alias("arquivos"), F.sum("bytes").alias("bytes"))


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger of loaded paths does not list."""
    done = ledger.select(F.col("path").alias("_p")).distinct()
    return files.join(done, files["path"] == done["_p"], "left_anti")


def file_provenance(spark: SparkSession, root: str, pattern: str = "*", digits: int = 16) -> DataFrame:
    """Bytes, short SHA-256 and time per file. A file is one record, so each must stay below 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("arquivo"), F.col("length").alias("bytes"),
        F.substring(F.sha2("content", 256), 1, digits).alias("sha256"), F.col("modificationTime").alias("baixado_em"))


def provenance_total(provenance: DataFrame) -> DataFrame:
    return provenance.agg(F.count(F.lit(1)).alias("arquivos"), F.sum("bytes").alias("bytes"))
