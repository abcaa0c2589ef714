"""Readers and writers for the CSV and JSON file feeds."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopgrain.rules import CORRUPT
from shopgrain.schemas import bind_by_name
from shopgrain.sources.files import exists


def require_files(spark: SparkSession, folder: str, pattern: str) -> None:
    """Fail when a feed folder holds no file of the pattern."""
    try:
        listed = spark.read.option("pathGlobFilter", pattern).text(folder).inputFiles()
    except AnalysisException:
        listed = []
    if not listed:
        raise FileNotFoundError(f"no files matching {pattern} in {folder}")


def read_csv(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    quote_escape: str = "\\",
    base: str | None = None,
    lines: bool = False,
) -> DataFrame:
    """CSV files with a header, every column as text.

    The header of one file gives the columns. Each file's header is then checked against it,
    since binding columns by position would silently mix them up. `lines` is for feeds whose quoted
    fields hold line breaks; their files are not split. `base` is the folder below which partition
    folders begin.
    """
    reader = (
        spark.read.option("header", True)
        .option("pathGlobFilter", pattern)
        .option("quote", '"')
        .option("escape", quote_escape)
        .option("multiLine", lines)
    )
    if base is not None:
        reader = reader.option("basePath", base)
    columns = reader.csv(folder).columns
    text = StructType([StructField(name, StringType()) for name in columns])
    return reader.option("enforceSchema", False).schema(text).csv(folder)


def read_json(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str = "*.json",
    shape: str = "auto",
) -> DataFrame:
    """JSON files that hold one record per line, or one array written over many lines.

    Line files are split and read in parallel. Blank lines and empty files give no rows. An array
    that spans lines can only be parsed as a whole file, so exactly those files are read that way.
    `shape` is "lines" or "arrays" for a feed known to hold only that, which saves a scan; "auto"
    tells the files apart.

    A record that is no JSON object keeps its text in `CORRUPT`, a column the frame has besides
    those of the schema; it is null everywhere else.
    """
    if shape not in ("auto", "lines", "arrays"):
        raise ValueError(f"unknown feed shape: {shape}")
    require_files(spark, folder, pattern)
    if CORRUPT not in schema.names:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    if shape != "auto":
        given = reader.option("pathGlobFilter", pattern).option("multiLine", shape == "arrays")
        return with_file_name(given.json(folder))
    plain, arrays = _by_shape(spark, folder, pattern)
    parts = []
    if plain:
        parts.append(with_file_name(reader.json(plain)))
    if arrays:
        whole = reader.option("multiLine", True)
        parts.append(with_file_name(whole.json(arrays)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _by_shape(spark: SparkSession, folder: str, pattern: str) -> tuple[list[str], list[str]]:
    """Files of line records, files of arrays over many lines.

    A line that opens an array without closing it gives the latter away. The lists are never longer
    than the file listing the driver already has.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    opened = lines.where(F.ltrim("value").startswith("[") & ~F.rtrim("value").endswith("]"))
    found = opened.select(F.col("_metadata.file_path").alias("path")).distinct()
    arrays = {_plain_path(row.path) for row in found.collect()}
    listed = {_plain_path(path) for path in lines.inputFiles()}
    return sorted(listed - arrays), sorted(arrays)


def _plain_path(uri: str) -> str:
    """A listed URI as a path; both spellings of a local file become one."""
    path = unquote(uri)
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def with_file_name(frame: DataFrame) -> DataFrame:
    """Name the input file of every row; `frame` must come straight from a file scan."""
    # The name comes URI-encoded; a plus sign in it is a plus sign, not a blank.
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return frame.withColumn("source_file", F.url_decode(encoded))


def write_json_lines(frame: DataFrame, folder: str) -> None:
    """One JSON record per line; null fields are left out."""
    frame.write.mode("append").json(folder)


def json_lines(frame: DataFrame) -> DataFrame:
    """The frame as one text column `value`, a JSON record per row."""
    return frame.select(F.to_json(F.struct("*")).alias("value"))


def read_csv_tables(
    spark: SparkSession, folder: str, schemas: dict[str, StructType]
) -> dict[str, DataFrame]:
    """One frame per table from `<folder>/<table>.csv`, a file or a folder of files, bound by name."""
    frames = {}
    for name, schema in schemas.items():
        base = f"{folder.rstrip('/')}/{name}"
        path = base if exists(spark, base) else f"{base}.csv"
        if not exists(spark, path):
            raise FileNotFoundError(f"no CSV for {name} in {folder}")
        frames[name] = bind_by_name(read_csv(spark, path), schema)
    return frames


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as a folder of CSV files with a header."""
    for name, frame in tables.items():
        frame.write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}")
