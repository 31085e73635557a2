"""Raw records: one set of files per source."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import checkpointed, small


def _or_empty(read, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Rows of the path, or no rows where the path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# --- JSON arrays ------------------------------------------------------------------------------------------------
#
# A file is read in pieces that end with a closing brace, so Spark can split it into blocks of bytes like lines of
# text. Whether a piece begins inside a string, and how deep, follows from running sums of quotes and of brackets:
# per block first, then over the blocks of a file (a row each), then inside a block. Where a brace closes an object of
# the array a record ends, and pieces up to there are put together again.


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """file, block, at, text, quotes (unescaped ones), open_even and open_odd (brackets opened less closed in the
    parts between them with even and odd numbers)."""
    lines = spark.read.option("lineSep", "}").text(f"{folder}/*.json")
    bare = F.regexp_replace("value", r"\\.", "")
    without = lambda part, signs: F.length(part) - F.length(F.translate(part, signs, ""))
    opened = lambda part: without(part, "[{") - without(part, "]")
    deeper = lambda odd: F.aggregate(F.filter("parts", lambda p: p["odd"] == odd), F.lit(0), lambda n, p: n + p["n"])
    counted = F.transform(F.split(bare, '"', -1), lambda part, i: F.struct((i % 2 == 1).alias("odd"), opened(part).alias("n")))
    pieces = lines.select(
        F.url_decode("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"), counted.alias("parts"),
    )
    return pieces.select(
        "file", "block", "at", "text", (F.size("parts") - 1).alias("quotes"), deeper(False).alias("open_even"), deeper(True).alias("open_odd")
    )


def _carried(rows: DataFrame, amount: str, alias: str) -> DataFrame:
    """The sum of `amount` over a file's rows before this one."""
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum(amount).alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    joined = rows.join(small(blocks.select("file", "block", "_before")), ["file", "block"])
    return joined.withColumn(alias, F.col("_before") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).drop("_before")


def json_records(spark: SparkSession, folder: str) -> DataFrame:
    """file, pos, text: the objects of the arrays in `<source>.json` files, or folders of files.

    A file with one object is an array of one. A block of a file is a task, so a file of any size is read by many.
    What a file that ends too early holds behind its last whole object is left out.
    """
    pieces = checkpointed(_pieces(spark, folder))
    inside = F.col("quotes_before") % 2 == 1
    outside_after = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    change = F.when(inside, F.col("open_odd")).otherwise(F.col("open_even")) - F.when(outside_after, 1).otherwise(0)
    known = _carried(pieces, "quotes", "quotes_before").withColumn("change", change).withColumn("outside", outside_after)
    known = checkpointed(known.drop("open_even", "open_odd", "quotes", "quotes_before"))
    first = known.where("block = 0").groupBy("file").agg(F.min_by("text", "at").alias("_text"))
    level = F.when(F.ltrim(F.regexp_replace("_text", r"^[\ufeff\s]+", "")).startswith("["), 1).otherwise(0)
    deep = _carried(known, "change", "depth").join(small(first.select("file", level.alias("level"))), "file")
    ends = F.col("outside") & (F.col("depth") + F.col("change") == F.col("level"))
    deep = checkpointed(deep.select("file", "block", "at", "text", ends.cast("int").alias("ends")))  # read by block and by row
    numbered = _carried(deep, "ends", "pos")
    whole = numbered.groupBy("file", "pos").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "text"))).alias("parts"), F.max("ends").alias("ended")
    ).where("ended = 1")  # the pieces of one object
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "}"), F.lit("}"))
    return whole.select("file", F.col("pos").cast("int").alias("pos"), F.regexp_replace(text, r"^[\ufeff\s\[,]+", "").alias("text"))


def _read_records(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    damaged = T.StructType([*schema.fields, T.StructField("_damaged", T.StringType())])
    record = F.from_json("text", damaged, {"columnNameOfCorruptRecord": "_damaged"})
    source = F.regexp_extract("file", r"([^/=]*)\.json(?:/[^/]*)?$", 1)
    return json_records(spark, folder).select(source.alias("source"), "file", "pos", "text", record.alias("r"))


def read_raw_arrays(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """`<source>.json` files, or folders of files, each file one JSON array of objects.

    Adds `source`, `file` and `pos`, the place in the file. Blank files give no rows; objects that cannot be read are
    left out here and listed by `raw_failures`.
    """
    added = [T.StructField("source", T.StringType()), T.StructField("file", T.StringType()), T.StructField("pos", T.IntegerType())]
    read = lambda: _read_records(spark, folder, schema).where("r._damaged is null").select("source", "file", "pos", *[F.col("r")[f.name].alias(f.name) for f in schema])
    return _or_empty(read, spark, T.StructType(added + schema.fields))


def raw_failures(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """source, file, pos, text of the objects that do not fit the schema."""
    layout = T.StructType.fromDDL("source string, file string, pos int, text string")
    return _or_empty(lambda: _read_records(spark, folder, schema).where("r._damaged is not null").select("source", "file", "pos", "text"), spark, layout)


def write_raw(df: DataFrame, path: str) -> None:
    """Replace the rows of the sources in `df` and leave the other sources alone."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_source")
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)


def subset_of_sources(df: DataFrame, names: list[str], column: str = "_source") -> DataFrame:
    """Rows of the named sources, ignoring case: a partition filter. Unknown names are an error only
    if none is known; `unknown_sources` lists them."""
    wanted = [n.lower() for n in names]
    chosen = df.where(F.lower(column).isin(wanted))
    if chosen.isEmpty():
        raise ValueError(f"no source matches {sorted(names)}")
    return chosen


def unknown_sources(df: DataFrame, names: list[str], column: str = "_source") -> DataFrame:
    asked = df.sparkSession.createDataFrame([(n,) for n in names], "asked string")
    known = df.select(F.lower(column).alias("known")).distinct()
    return asked.join(known, F.lower("asked") == F.col("known"), "left_anti")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured web pages: (page_id, url, html)."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_calendars(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar files as (file, ics), one row per file."""
    files = spark.read.text(f"{folder}/*.ics", wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("ics"))
