"""Array documents read in parallel, whatever their size.

A file is cut at every closing brace by the text source, which reads byte ranges of it in many tasks. Whether a piece starts
inside a string, and how deep, follows from sums over all pieces before it: of quotes, then of brackets outside of
strings. Both are taken per byte range first and then over the ranges, so nothing is read in order by one task. A
record ends where a brace leads back to the depth of the array.
"""

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.session import new_folder

RECORD_BYTES = 64 << 20  # a record beyond it is given as its pieces, which are no records
EXTRA, CUT_OFF = "extra_data", "cut_off"

_PLACE = ["file", "block", "at"]
_BLANK = " \t\n\x0b\f\r"  # what \s is in a pattern


def _stored(df: DataFrame) -> DataFrame:
    path = new_folder(df.sparkSession, "pieces")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The text between closing braces, with its file, its byte range in it, and its order there."""
    return spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value",
    )


def by_form(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """The files at ``path`` that begin like an array, and the others; files without text are in neither list."""
    head = _pieces(spark, path).filter((F.col("block") == 0) & F.col("value").rlike(r"\S"))
    begin = F.substring(F.regexp_replace("value", "^[\\s﻿]+", ""), 1, 1)
    first = head.groupBy("file").agg(F.min_by(begin, "at").alias("begin")).collect()
    found = ([], [])
    for r in sorted(first, key=lambda r: r.file):
        found[r.begin != "["].append(unquote(r.file))
    return found


def _count(text: Column, kind: str) -> Column:
    """How often a character is in the text; replacing is several times as fast as translating."""
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(kind), F.lit("")))


def _before(df: DataFrame, value: Column, out: str) -> DataFrame:
    """Adds the sum of ``value`` over all pieces of the file before each one."""
    valued = df.withColumn("_v", value)
    sums = valued.groupBy("file", "block").agg(F.sum("_v").alias("_sum"))
    ranges = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("file", "block", F.coalesce(F.sum("_sum").over(ranges), F.lit(0)).alias("_begin"))
    here = F.col("_begin") + F.coalesce(F.sum("_v").over(within), F.lit(0))
    return valued.join(begins, ["file", "block"]).withColumn(out, here).drop("_v", "_begin")


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value, problem``: the elements of array documents as texts; ``problem`` is null or why a text is no element.

    ``extra_data`` is text behind the array or without a comma before it, ``cut_off`` what is left at the end of a file
    whose array isn't closed.
    """
    # escaped characters end no string; brackets that are not outside of strings when a piece starts outside of one are
    # outside when it starts inside
    clean = F.when(F.col("value").contains("\\"), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    depth = lambda c: _count(F.col(c), "{") + _count(F.col(c), "[") - _count(F.col(c), "]")
    read = _pieces(spark, paths).withColumn("clean", clean).withColumn("outside", F.regexp_replace("clean", r'"[^"]*("|$)', ""))
    read = read.withColumns({"bytes": F.octet_length("value") + 1, "quotes": _count(F.col("clean"), '"') % 2, "d0": depth("outside")})
    pieces = _stored(read.withColumn("d1", depth("clean") - F.col("d0")).drop("clean", "outside"))
    # the last piece of a file has no brace behind it, unless that is the file's last byte; readers skip a byte order mark of 3
    whole = pieces.groupBy("file", "size").agg(F.sum("bytes").alias("all"), F.max(F.struct("block", "at")).alias("last"))
    open_end = whole.filter((F.col("all") - F.col("size")).isin(1, -2)).select("file", "last.block", "last.at", F.lit(False).alias("closed"))
    states = pieces.drop("value", "size").join(open_end, _PLACE, "left").withColumn("closed", F.coalesce("closed", F.lit(True)))
    states = _stored(_before(states, F.col("quotes"), "quoted"))
    inside, ends_inside = F.col("quoted") % 2 == 1, (F.col("quoted") + F.col("quotes")) % 2 == 1
    states = states.withColumn("brace", F.col("closed") & ~ends_inside)
    states = states.withColumn("step", F.when(inside, F.col("d1")).otherwise(F.col("d0")) - F.col("brace").cast("int"))
    states = _stored(_before(states, F.col("step"), "depth").withColumn("after", F.col("depth") + F.col("step")))
    states = states.withColumn("ends", F.col("brace") & (F.col("after") == 1))
    states = _stored(_before(states, F.col("ends").cast("int"), "record").select(*_PLACE, "closed", "ends", "record", "bytes", "after"))

    long = states.groupBy("file", "record").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") > RECORD_BYTES).select("file", "record")
    piece = pieces.select(*_PLACE, "value").join(states, _PLACE).withColumn("value", F.when(F.col("closed"), F.concat("value", F.lit("}"))).otherwise(F.col("value")))
    if any_long := not long.isEmpty():
        parts = piece.join(long, ["file", "record"], "left_semi").select("value", F.lit(CUT_OFF).alias("problem"))
        piece = piece.join(long, ["file", "record"], "left_anti")
    grouped = piece.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"), F.max("ends").alias("ended"),
        F.max_by("after", F.struct("block", "at")).alias("after"))
    # written, as what follows looks at the text in many places and would put it together for each of them
    joined = F.ltrim(F.array_join("parts.value", ""), F.lit(_BLANK + "\ufeff"))
    texts = _stored(grouped.select("record", "ended", "after", F.rtrim(joined, F.lit(_BLANK)).alias("text")))
    first = F.col("record") == 0
    lead = F.substring("text", 1, 1)
    opened = F.when(first, lead == "[").otherwise((lead == ",") | (lead == "]"))
    body = F.when(F.col("ended"), F.expr("substring(text, 2)")).otherwise(F.regexp_replace(F.expr("substring(text, 2)"), r"\]$", ""))
    closes = F.col("text").rlike(r"^\[?\]$") | (~first & F.col("text").rlike(r"^\]$"))
    problem = (
        F.when(~opened | ((lead == "]") & ~closes), EXTRA)
        .when(~F.col("ended") & ((F.col("after") != 0) | ~F.col("text").endswith("]")), CUT_OFF)
    )
    told = texts.filter("text <> ''").filter(~closes).withColumns({"problem": problem, "body": F.trim(body)})
    several = F.from_json(F.concat(F.lit("["), "body", F.lit("]")), "array<string>")
    items = (
        F.when(F.col("problem").isNotNull(), F.array("text"))
        .when(F.col("body").startswith("{"), F.array("body"))
        .otherwise(F.coalesce(F.nullif(F.transform(several, lambda x: F.coalesce(x, F.lit("null"))), F.array().cast("array<string>")), F.array("text")))
    )
    found = told.select(F.explode(items).alias("value"), "problem")
    return found.unionByName(parts) if any_long else found
