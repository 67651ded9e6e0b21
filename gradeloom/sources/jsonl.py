"""JSON Lines tables: strict and ragged reading, writing and reuse."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom import fixed
from gradeloom.functions.whitespace import is_blank, strip
from gradeloom.operators.normalize import RAW_KEYS
from gradeloom.runtime import is_complete

_LINE = "value"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # Only "\n" ends a record, as other line ends may stand inside one.
    return spark.read.option("lineSep", "\n").text(path).where(~is_blank(_LINE))


def _as_list(line: Column) -> Column:
    # Parsers stop after the first value of a line. Inside brackets, whatever else
    # stands on the line becomes either an error or a second element.
    return F.concat(F.lit("["), line, F.lit("]"))


def _starts_object(line: Column) -> Column:
    return F.startswith(strip(line), F.lit("{"))


def _reject(line: Column) -> Column:
    return F.raise_error(
        F.concat(
            F.lit("not a JSON object in "), F.input_file_name(), F.lit(": "), F.substring(line, 1, 200)
        )
    )


def _is_object(line: Column) -> Column:
    """True for a line that is one well-formed JSON object and nothing else."""
    listed = F.try_variant_get(F.try_parse_json(_as_list(line)), "$", "array<variant>")
    return F.coalesce(_starts_object(line) & (F.size(listed) == 1), F.lit(False))


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True
) -> DataFrame:
    """Table of a JSON Lines file or folder with a known schema.

    Blank lines are skipped. ``strict`` fails on a line that is malformed or not an
    object, naming the file and the line's start; :func:`invalid_jsonl_lines` lists
    all of them. Otherwise Spark's own reader is used, which is faster and fails on
    malformed lines but also accepts a line holding an array of objects.
    """
    if not strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    line = F.col(_LINE)
    listed = F.from_json(_as_list(line), T.ArrayType(fields), {"mode": "FAILFAST"})
    one = _starts_object(line) & (F.size("listed") == 1)
    row = F.when(one, F.get("listed", 0)).otherwise(_reject(line))
    return _lines(spark, path).select(_LINE, listed.alias("listed")).select(row.alias("row")).select("row.*")


def read_ragged_jsonl(
    spark: SparkSession,
    path: str,
    text_fields: Sequence[str],
    number_fields: Sequence[str] = (),
    whole_fields: Sequence[str] = (),
    completions: bool = False,
) -> DataFrame:
    """JSON Lines whose objects differ in their fields.

    Each text field becomes a string column that is null unless the object holds a
    string there, so a number is not mistaken for text. Number fields become doubles
    and whole fields 64-bit numbers; text that is no such number fails. The object's
    own field names go along and are what the normalisers record as the row's keys.
    ``completions`` adds the list of that name, whose objects keep their own field names
    too, so that an absent score differs from a null one.
    """
    line = F.col(_LINE)
    listed = F.variant_get("doc", "$", "array<variant>")
    one = _starts_object(line) & (F.size(listed) == 1)
    parsed = (
        _lines(spark, path)
        .select(_LINE, F.parse_json(_as_list(line)).alias("doc"))
        .select("doc", F.when(one, F.json_object_keys(line)).otherwise(_reject(line)).alias(RAW_KEYS))
    )

    def text(doc: Column, at: str, name: str) -> Column:
        member = F.try_variant_get(doc, f"{at}['{name}']", "variant")
        return F.when(
            F.schema_of_variant(member) == "STRING",
            F.try_variant_get(doc, f"{at}['{name}']", "string"),
        ).alias(name)

    def number(doc: Column, at: str, name: str, kind: str) -> Column:
        return F.variant_get(doc, f"{at}['{name}']", kind).alias(name)

    def item(member: Column) -> Column:
        return F.struct(
            *[text(member, "$", name) for name in fixed.COMPLETION_TEXT_FIELDS],
            *[number(member, "$", name, "double") for name in fixed.SCORE_FIELDS],
            F.json_object_keys(F.to_json(member)).alias(RAW_KEYS),
        )

    doc = F.col("doc")
    members = F.try_variant_get(doc, "$[0]['completions']", "array<variant>")
    objects = F.filter(members, lambda member: F.startswith(F.schema_of_variant(member), F.lit("OBJECT")))
    return parsed.select(
        *[text(doc, "$[0]", name) for name in text_fields],
        *[number(doc, "$[0]", name, "double") for name in number_fields],
        *[number(doc, "$[0]", name, "long") for name in whole_fields],
        *([F.transform(objects, item).alias("completions")] if completions else []),
        RAW_KEYS,
    )


def invalid_jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not JSON objects, as ``file, line_number, line``.

    Numbers lines inside each file block first and adds the line counts of the
    blocks before it, so a large file is never counted by one task.
    """
    located = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.when(~is_blank(_LINE) & ~_is_object(F.col(_LINE)), F.col(_LINE)).alias("line"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("place")
    numbered = located.withColumn("at", F.row_number().over(in_block))
    blocks = located.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"))
    before = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = blocks.select(
        "file", "block", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("start")
    )
    return (
        numbered.where(F.col("line").isNotNull())
        .join(starts, ["file", "block"])
        .select("file", (F.col("start") + F.col("at")).alias("line_number"), "line")
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write one object per line, nulls included and text unescaped."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def write_ordered_jsonl(df: DataFrame, path: str, order: Sequence[str | Column], drop: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Write one object per line so that the files, read by name, hold the rows in order.

    Rows are spread by ranges of ``order`` over all tasks and sorted within each; a file's number is
    that of its range. Columns in ``drop`` only tell the order and are not written.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return write_jsonl(ranged.drop(*drop), path, mode)


def numbered_lines(spark: SparkSession, path: str, output: str = "ord") -> DataFrame:
    """Lines of a file, or of a folder's files by name, as ``value`` with their number from 0.

    Lines are numbered inside each file block, of which a task reads a few, and start behind
    the lines of all blocks before it.
    """
    located = spark.read.option("lineSep", "\n").text(path).select(
        _LINE,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__place"),
    )
    in_block = Window.partitionBy("__file", "__block").orderBy("__place")
    blocks = located.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__lines"))
    # One row per block.
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("__start", F.coalesce(F.sum("__lines").over(before), F.lit(0))).drop("__lines")
    numbered = located.withColumn("__at", F.row_number().over(in_block) - 1).join(starts, ["__file", "__block"])
    return numbered.select((F.col("__start") + F.col("__at")).alias(output), _LINE)


def append_jsonl(df: DataFrame, path: str) -> str:
    """Add rows to a JSON Lines folder, which may not exist yet."""
    return write_jsonl(df, path, "append")


def load_if_complete(
    spark: SparkSession, path: str | None, schema: T.StructType | str
) -> DataFrame | None:
    """The table at ``path``, or None when there is none or its write is unfinished."""
    if path is None or not is_complete(spark, path):
        return None
    return read_jsonl(spark, path, schema)


def reuse_or_build(
    spark: SparkSession,
    builders: dict[str, Callable[[], DataFrame]],
    schema: T.StructType | str,
    reuse: bool = True,
) -> dict[str, DataFrame]:
    """Tables by path: reused when every one is complete, else all built and written.

    Reading back what was written also means that later steps do not recompute it.
    Completeness is all that is checked; pass ``reuse=False`` after a change.
    """
    if not (reuse and all(is_complete(spark, path) for path in builders)):
        for path, build in builders.items():
            write_jsonl(build(), path)
    return {path: read_jsonl(spark, path, schema) for path in builders}


def encode_json(*names: str) -> Column:
    """Columns as one JSON object, nulls kept."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def decode_json(text: str | Column, schema: T.StructType | str) -> Column:
    """JSON object to a struct; malformed text fails."""
    return F.from_json(text, schema, {"mode": "FAILFAST"})
