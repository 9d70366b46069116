"""CSV and GeoJSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Column of the text of a record that does not have the header's fields.
RECORD = "_record"


def breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    """Whether some line of the files holds an odd number of quotes, so that a quoted text goes on in the next.

    The lines are read as splittable text, up to the first such line of each task.
    """
    lines = spark.read.text(path)
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    return not lines.where(odd).limit(1).isEmpty()


def _fields(spark: SparkSession, path: str, multi_line: bool | None) -> DataFrame:
    """Every field as text under the header's names, with `RECORD` where a row has more or fewer fields."""
    if multi_line is None:
        multi_line = breaks_in_quotes(spark, path)
    options = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false", "multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in [*names, RECORD]])
    return (
        spark.read.options(**options)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", "false")  # a pruned row is not checked for its number of fields
        .schema(schema)
        .csv(path)
    )


def _typed(raw: DataFrame, contract: StructType) -> list[Column]:
    have = set(raw.columns) - {RECORD}
    return [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in contract.fields
    ]


def read_csv(spark: SparkSession, path: str, contract: StructType, multi_line: bool | None = None) -> DataFrame:
    """Comma-separated text with a header, ``"`` as quote, matched to the contract by name.

    Every field is read as text and then cast, so that one bad value becomes a null in its own
    column. Contract columns the file lacks are null; columns the contract lacks are dropped
    (``contract_diff`` reports both). Compression follows the file ending. A row with too few or too many
    fields keeps the ones that are there; ``read_csv_checked`` sets it apart instead.

    The files of one folder must have one header: where a file names other columns at some place,
    reading it is an error, never a value in the wrong column.

    Quoted texts may hold line breaks. A file with such breaks is one task; others are split. ``multi_line`` says
    which it is; left out, the lines are looked through first.
    """
    raw = _fields(spark, path, multi_line)
    return raw.select(*_typed(raw, contract))


def read_csv_checked(
    spark: SparkSession, path: str, contract: StructType, multi_line: bool | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The good rows as ``read_csv`` gives them, and the others: ``file, reason, record``.

    ``too_few_fields`` and ``too_many_fields`` are counted against the header, outside of quotes;
    ``unclosed_quote`` is a row whose fields do not fit and whose quotes do not pair: with line breaks in
    quotes such a row holds all the text it has swallowed. ``strict`` also sets rows apart in which a value
    is not of its contract type, as ``bad_value:<column>``; their record is the row as JSON. Every row
    of the files is in one of the two frames.
    """
    raw = _fields(spark, path, multi_line)
    names = [n for n in raw.columns if n != RECORD]
    bare = F.regexp_replace(RECORD, r'"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = (
        F.when(F.col(RECORD).isNull(), F.lit(None))
        .when(F.instr(bare, '"') > 0, "unclosed_quote")
        .when(fields < len(names), "too_few_fields")
        .otherwise("too_many_fields")
    )
    row = F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})
    if strict:
        bad = [
            F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), f"bad_value:{f.name}")
            for f in contract.fields
            if f.name in names
        ]
        reason = F.coalesce(reason, *bad)
    judged = raw.select("*", reason.alias("_reason"), F.coalesce(RECORD, row).alias("_text"), F.col("_metadata.file_path").alias("_file"))
    good = judged.where("_reason is null").select(*_typed(raw, contract))
    wrong = judged.where("_reason is not null")
    return good, wrong.select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_text").alias("record"))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of the collections at the path: geometry type, coordinates as JSON text,
    and the properties as columns."""
    features = spark.read.option("multiLine", "true").json(path).select(F.explode("features").alias("f"))
    return features.select(
        F.col("f.geometry.type").alias("geometry_type"),
        F.to_json("f.geometry.coordinates").alias("coordinates"),
        "f.properties.*",
    )
