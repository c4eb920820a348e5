"""Folders of files read as one table.

CSV exports differ from file to file in header and encoding. The text is read once into records
(`records.py`); each file's header and encoding are found from those, and a dictionary of headers,
joined in by file, tells where a row has the columns of the united table. Neither the files nor
their headers are listed in the driver, only the distinct headers.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.text import strip
from concord.operators.joins import attach
from concord.session import checkpointed
from concord.sources.records import files_of, read_lines, whole_records
from concord.sources.headers import arrow_header, require_columns, snake_header, unique_names

# Cells pandas reads as missing by default, next to the empty cell.
PANDAS_NULLS = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
FORMATS = ("csv", "json", "parquet")


def _glob(extension: str) -> str:
    """The names of files with the extension; JSON, which is the longest text, may be compressed."""
    return "*.{json,json.gz}" if extension == "json" else f"*.{extension}"


def _files(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """One row for each of the folder's files with the extension; an absent folder has none."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", _glob(extension)).load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "path string")
        raise
    return files.select("path")


def _blank_to_null(df: DataFrame, columns: Iterable[str], null_tokens: Sequence[str]) -> DataFrame:
    tokens = ["", *null_tokens]
    return df.withColumns(
        {c: F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")) for c in columns}
    )


def _place():
    """A sortable place of a row: file, block, line."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def _file_name(path):
    """The name of a file from its path as an address."""
    return F.url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def _styles(records: DataFrame, files: DataFrame) -> DataFrame:
    """file, header, utf8, header_line: the first record of each file that is not blank."""
    first = records.where("block = 0 AND NOT blank").groupBy("file").agg(F.min("line").alias("header_line"))
    known = checkpointed(files.select("file", "utf8").join(first, "file"))
    found = attach(records.where("block = 0"), known, "file", "inner", written=True).where("line = header_line")
    return checkpointed(found.select("file", "utf8", "header_line", F.col("value").cast("binary").alias("header")))


def _dictionary(
    spark: SparkSession, styles: DataFrame, rule: Callable[[str], str], required: Iterable[str]
) -> tuple[list[str], int, DataFrame]:
    """The columns of all headers, the most columns of one, and for each header where it has them.

    What reaches the driver is each distinct header once, whatever the number of files.
    """
    distinct = styles.groupBy("header", "utf8").agg(F.min("file").alias("file")).toLocalIterator()
    names, rows = {}, []
    for header, utf8, path in sorted(distinct, key=lambda r: r["file"]):
        text = bytes(header).decode("UTF-8" if utf8 else "ISO-8859-1").removeprefix("\ufeff")
        cells = next(csv.reader(io.StringIO(text, newline="")))
        label = unquote(path.rsplit("/", 1)[-1])
        own = unique_names((rule(c) for c in cells), label)
        require_columns(own, required, label)
        names.update(dict.fromkeys(own))
        rows.append((header, utf8, own))
    columns, most = list(names), max((len(own) for *_, own in rows), default=0)
    places = [(h, u, len(own), [own.index(c) if c in own else None for c in columns]) for h, u, own in rows]
    return columns, most, spark.createDataFrame(places, "header binary, utf8 boolean, width int, places array<int>")


def read_csv_files(
    spark: SparkSession,
    source: str | list[str],
    rule: Callable[[str], str] = arrow_header,
    null_tokens: Sequence[str] = (),
    required: Iterable[str] = (),
    file_column: str | None = None,
    position: str | None = None,
    glob: str | None = None,
) -> DataFrame:
    """All files as one all-text table, united by normalised header.

    source       a folder, or paths of files
    required     columns every single file must have
    file_column  adds the file name
    position     adds a sortable column giving the row's place: file, block, line
    glob         which files of a folder are read

    The text is read once. Files without a line that is not blank are left out; a row with more cells
    than its file's header raises an error, since no cell is dropped.
    """
    lines = read_lines(spark, source, glob)
    files = checkpointed(files_of(lines))
    records = whole_records(lines, files)
    styles = _styles(records, files)
    names, most, dictionary = _dictionary(spark, styles, rule, required)
    if not names:
        return _empty(spark)
    # A header for each row, and few headers; the files are joined in by their size.
    known = checkpointed(styles.join(F.broadcast(dictionary), ["header", "utf8"]).drop("header"))
    rows = attach(records.where("NOT blank"), known, "file", "inner", written=True).where("block > 0 OR line > header_line")
    text = F.when(F.col("utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    parsed = F.from_csv(text, ", ".join(f"c{i} string" for i in range(most + 1)), {"quote": '"', "escape": '"'})
    rows = rows.select("file", "block", "line", "width", "places", F.explode(F.array(parsed)).alias("_cells"))
    cells = F.array(*[F.col("_cells")[f"c{i}"] for i in range(most + 1)])
    rows = rows.select("file", "block", "line", "width", "places", cells.alias("_cells"))
    wide = F.raise_error(F.concat(F.lit("more cells than columns in a row of "), F.col("file")))
    rows = rows.where(F.when(F.get("_cells", "width").isNull(), True).otherwise(wide.cast("boolean")))
    values = [F.get("_cells", F.get("places", F.lit(k))) for k in range(len(names))]
    extra = []
    if file_column:
        extra.append(_file_name(F.col("file")).alias(file_column))
    if position:
        extra.append(F.struct("file", "block", "line").alias(position))
    frame = rows.select(*[v.alias(n) for v, n in zip(values, names)], *extra)
    return _blank_to_null(frame, names, null_tokens)


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "struct<>")


def read_csv_folder(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Every CSV file of a folder; a folder without any gives a table without columns."""
    if _files(spark, folder, "csv").isEmpty():
        return _empty(spark)
    return read_csv_files(spark, folder, glob="*.csv", **options)


def read_folder(
    spark: SparkSession, folder: str, formats: Sequence[str], position: str | None = None,
    null_tokens: Sequence[str] = (), **options,
) -> DataFrame:
    """The files of the first listed format that has any; later formats are ignored.

    Every format gives text columns, the same missing cells and, if asked for, a position.
    """
    for extension in formats:
        if _files(spark, folder, extension).isEmpty():
            continue
        if extension not in FORMATS:
            raise ValueError(f"unsupported format '{extension}' for folder {folder}")
        glob = _glob(extension)
        if extension == "csv":
            return read_csv_files(spark, folder, position=position, null_tokens=null_tokens, glob=glob, **options)
        frame = spark.read.format(extension).option("pathGlobFilter", glob).load(folder)
        names = unique_names((arrow_header(c) for c in frame.columns), folder)
        cells = [F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(frame.columns, names)]
        frame = frame.select(*cells, *([_place().alias(position)] if position else []))
        return _blank_to_null(frame, names, null_tokens)
    return _empty(spark)


def load_inputs(spark: SparkSession, root: str, folders: dict[str, dict], **options) -> dict[str, DataFrame]:
    """Named tables from a configuration of {name: {"dir": ..., "formats": [...]}}."""
    return {
        name: read_folder(spark, f"{root}/{spec['dir']}", spec["formats"], **options)
        for name, spec in folders.items()
    }


def load_batches(
    spark: SparkSession, folder: str, required: Sequence[str], label: str = "batch_name"
) -> DataFrame:
    """Batches of one table: snake_case headers, every file checked, file name added.

    The required columns are trimmed, missing cells become the empty string.
    """
    if _files(spark, folder, "csv").isEmpty():
        raise FileNotFoundError(f"no CSV batches found in {folder}")
    rows = read_csv_files(
        spark, folder, rule=snake_header, null_tokens=PANDAS_NULLS, required=required, file_column=label, glob="*.csv"
    )
    return rows.withColumns({c: F.coalesce(strip(F.col(c)), F.lit("")) for c in required})


def read_table(spark: SparkSession, path: str, null_tokens: Sequence[str] = PANDAS_NULLS) -> DataFrame:
    """One CSV table as text, headers unchanged."""
    return read_csv_files(spark, path, rule=str, null_tokens=null_tokens)


def read_prior_report(
    spark: SparkSession, folder: str, formats: Sequence[str] = ("parquet", "csv"), null_tokens: Sequence[str] = ()
) -> DataFrame:
    """The prior report: exactly one file must exist over all formats."""
    found = sum(_files(spark, folder, extension).count() for extension in formats)
    if found != 1:
        raise ValueError(f"expected exactly one prior report in {folder}, found {found}")
    return read_folder(spark, folder, formats, position="ord", null_tokens=null_tokens)


def read_mapping(spark: SparkSession, path: str, records: bool = False) -> DataFrame:
    """JSON objects of key to name as (name_key, mapped) rows.

    A file is one object, unless it has one on each line (``records``); then its lines are spread
    over tasks as those of any text.
    """
    objects = spark.read.option("singleVariantColumn", "pairs").option("multiLine", not records).json(path)
    pairs = objects.lateralJoin(spark.tvf.variant_explode(F.col("pairs").outer()))
    return pairs.select(F.col("key").alias("name_key"), F.col("value").cast("string").alias("mapped"))


def preview(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with the row count of the table."""
    columns = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("column_type")
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.inline(F.array(*columns)), "row_count")


def preview_csv(spark: SparkSession, path: str) -> DataFrame:
    """Preview of a CSV file with inferred types."""
    return preview(spark.read.csv(path, header=True, inferSchema=True))


def sample_rows(df: DataFrame, order_by: str, rows: int = 5) -> DataFrame:
    """The first few rows in the order of a column."""
    return df.orderBy(order_by).limit(rows)
