"""CSV text as records, read once and split anywhere.

A file may be cut at any line, so a task cannot know whether its first line begins inside a quoted
cell. Each line therefore says what it does to either state: ``opens``, whether a line that begins
outside ends inside a quoted cell, and ``stays``, whether one that begins inside still ends inside.
The maps of a block's lines are composed in order, then those of a file's blocks, which gives every
line its state; only lines of files where some line opens a cell go through that, and only their
numbers and flags. Lines that begin inside are appended to the record they belong to.

A quote within an unquoted cell is a character like any other. A line break within a cell is read as
a line feed. A cell that is never closed is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.operators.joins import attach
from concord.session import checkpointed

#: Whole cells from where the last one ended, with the comma or the end of the line.
_CELLS = r'\G(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)(?:,|\z)'
#: The rest of a quoted cell that an earlier line has opened.
_REST = r'\A[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+(?:,|\z)'


def _left_open(text: Column) -> Column:
    """Whether text that begins with a cell ends within a quoted one."""
    return F.regexp_replace(text, _CELLS, "") != ""


def read_lines(spark: SparkSession, source: str | list[str], glob: str | None = None) -> DataFrame:
    """The lines of text files, read once and written: file, block, line, value and what each does.

    ``line`` orders the lines of a block. Bytes are kept as they are, also where they are not UTF-8.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    text, quoted = F.col("value"), F.contains(F.col("value"), F.lit('"'))
    rest = F.when(text.rlike(_REST), _left_open(F.regexp_replace(text, _REST, "")))
    return checkpointed(
        reader.text(source).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
            F.is_valid_utf8("value").alias("utf8"),
            (F.trim("value") == "").alias("blank"),
            F.when(quoted, _left_open(text)).otherwise(False).alias("opens"),
            F.when(quoted, F.coalesce(rest, F.lit(True))).otherwise(True).alias("stays"),
        )
    )


def files_of(lines: DataFrame) -> DataFrame:
    """file, utf8, torn: one row for each file, torn if some line opens a cell it does not close."""
    return lines.groupBy("file").agg(F.every("utf8").alias("utf8"), F.some("opens").alias("torn"))


def _composed(maps: DataFrame, within: list[str], order: str, names: tuple[str, str]) -> DataFrame:
    """Add the map of all rows before each one: the state it fixes (null if none) and whether it flips it.

    A map that gives both states the same end fixes the state; one that exchanges them flips it.
    """
    fixed, flipped = names
    rows = Window.partitionBy(*within).orderBy(order)
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("opens") == F.col("stays")
    flips = F.when(F.col("opens") & ~F.col("stays"), 1).otherwise(0)
    counted = maps.withColumn("_flips", F.sum(flips).over(rows))
    counted = counted.withColumn(fixed, F.last(F.when(fixes, F.col("opens")), True).over(before))
    counted = counted.withColumn("_at", F.last(F.when(fixes, F.col("_flips")), True).over(before))
    since = F.col("_flips") - flips - F.coalesce("_at", F.lit(0))
    return counted.withColumn(flipped, since % 2 == 1).drop("_flips", "_at")


def _state(start: Column, fixed: str, flipped: str) -> Column:
    return F.coalesce(F.col(fixed), start) != F.col(flipped)


def line_states(lines: DataFrame) -> DataFrame:
    """file, block, line, and the block and line of the record each line belongs to.

    lines: file, block, line, opens, stays. One block's lines meet in a task, and one file's blocks.
    """
    placed = checkpointed(_composed(lines.select("file", "block", "line", "opens", "stays"), ["file", "block"], "line", ("_fixed", "_flipped")))

    def end(start: bool) -> Column:
        inside = _state(F.lit(start), "_fixed", "_flipped")
        return F.when(inside, F.col("stays")).otherwise(F.col("opens"))

    last = Window.partitionBy("file", "block")
    blocks = (
        placed.withColumn("_last", F.max("line").over(last)).where("line = _last")
        .select("file", "block", end(False).alias("opens"), end(True).alias("stays"))
    )
    blocks = _composed(blocks, ["file"], "block", ("_fixed", "_flipped"))
    start = _state(F.lit(False), "_fixed", "_flipped")
    blocks = checkpointed(
        blocks.select("file", "block", start.alias("_start"), F.when(start, F.col("stays")).otherwise(F.col("opens")).alias("_end"))
    )
    final = blocks.groupBy("file").agg(F.max("block").alias("block"))
    unclosed = blocks.join(final, ["file", "block"], "left_semi").where("_end").select("file").first()
    if unclosed:
        raise ValueError(f"{unclosed[0]}: a quoted cell is never closed")
    inside = attach(placed, blocks.select("file", "block", "_start"), ["file", "block"], written=False)
    inside = inside.withColumn("_inside", _state(F.col("_start"), "_fixed", "_flipped"))
    so_far = Window.partitionBy("file", "block").orderBy("line")
    head = F.last(F.when(~F.col("_inside"), F.col("line")), True).over(so_far)
    headed = checkpointed(inside.select("file", "block", "line", head.alias("_head")))
    # A block's first lines may belong to the last record of a block before.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = headed.groupBy("file", "block").agg(F.max("_head").alias("_last"))
    open_at = F.when(F.col("_last").isNotNull(), F.struct(F.col("block").alias("block"), F.col("_last").alias("line")))
    heads = heads.select("file", "block", F.last(open_at, True).over(earlier).alias("_before"))
    own = F.struct(F.col("block").alias("block"), F.col("_head").alias("line"))
    found = attach(headed, heads, ["file", "block"])
    return found.select("file", "block", "line", F.when(F.col("_head").isNotNull(), own).otherwise(F.col("_before")).alias("head"))


def whole_records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """file, block, line, value, blank: the records of the files, at the place of their first line.

    lines and files are those of read_lines and files_of, both written.
    """
    columns = ["file", "block", "line", "value", "blank"]
    torn = files.where("torn").select("file")
    if torn.isEmpty():
        return lines.select(*columns)
    open_lines = attach(lines, torn, "file", "left_semi")
    heads = checkpointed(line_states(open_lines))
    parts = open_lines.join(heads, ["file", "block", "line"])
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value", "blank")))
    joined = parts.groupBy("file", "head").agg(pieces.alias("parts"))
    joined = joined.select(
        "file", "head.block", "head.line", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
        (F.get("parts", F.lit(0))["blank"] & (F.size("parts") == 1)).alias("blank"),
    )
    return attach(lines, torn, "file", "left_anti").select(*columns).unionByName(joined)
