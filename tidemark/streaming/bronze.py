"""Incremental ingestion of JSON files with Structured Streaming, whatever the shape of their payload.

The file source remembers in its checkpoint which files it has read, so a second run over the same landing folder adds
nothing, and a file counts as new by its name, whatever its modification time. A payload is kept whole as a VARIANT:
a field that is a number in one file, a text in the next and an object in a third stays readable in all of them. Text
that is no JSON is kept beside it. Each micro-batch is written to a folder of its own and replaced as a whole if it is
repeated, so every file is in the table once, and a reader can take the batches since its last look by their number.

The fields of a batch are aggregated by the tasks that write it and merged into those known before; nothing is
inferred beforehand, and no file is read twice.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_FILES_PER_BATCH = 100
SCHEMA = "raw_payload variant, malformed string, source_file string, source_modified timestamp, _ingested_at timestamp, batch_id long, ingestion_date date"
FIELDS_SCHEMA = "batch_id long, schema_json string"
_NUMBERS = [T.IntegerType(), T.LongType(), T.DoubleType()]
_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def merge_types(old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both: structs by field, arrays by element, numbers widened, anything else a variant."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_schemas(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merge_types(old.elementType, new.elementType))
    if old in _NUMBERS and new in _NUMBERS:
        return _NUMBERS[max(_NUMBERS.index(old), _NUMBERS.index(new))]
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType):
        return T.DoubleType()  # decimals of any size with other numbers
    return T.VariantType()


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """Fields of both by name; the order of known fields stays."""
    known = {f.name: f.dataType for f in old.fields}
    fresh = {f.name: f.dataType for f in new.fields}
    fields = [
        T.StructField(name, merge_types(kind, fresh[name]) if name in fresh else kind) for name, kind in known.items()
    ]
    fields += [T.StructField(name, kind) for name, kind in fresh.items() if name not in known]
    return T.StructType(fields)


def as_schema(text: str | None) -> T.StructType:
    """Schema from the text of schema_of_variant_agg; no fields unless it describes objects."""
    if not text or not text.startswith("OBJECT<"):
        return T.StructType([])
    plain = _OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return T.StructType.fromDDL(f"r {plain}").fields[0].dataType


def known_schema(spark: SparkSession, table: str) -> T.StructType:
    """Fields of all payloads ingested so far, with merged types."""
    try:
        row = spark.read.schema(FIELDS_SCHEMA).json(f"{table}/fields").orderBy(F.desc("batch_id")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    return T.StructType.fromJson(json.loads(row.schema_json)) if row else T.StructType([])


def field_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """Path and type of every field, structs by their own fields; an array's elements follow as [*]."""
    found = []
    for f in schema.fields:
        path, kind = f"{prefix}{f.name}", f.dataType
        while isinstance(kind, T.ArrayType):
            path, kind = path + "[*]", kind.elementType
        found += field_paths(kind, f"{path}.") if isinstance(kind, T.StructType) and kind.fields else [(path, kind.simpleString())]
    return found


def known_fields(spark: SparkSession, table: str) -> DataFrame:
    """(path, type) of all fields ingested so far; one row per field, not per payload."""
    return spark.createDataFrame(field_paths(known_schema(spark, table)), "path string, type string")


def payload_rows(texts: DataFrame) -> DataFrame:
    """One row per JSON value; the elements of a list are values of their own. What is no JSON goes to ``malformed``.

    ``_opens`` tells that the text begins as an object does: its payload, if it has one, is an object.
    """
    parsed = texts.where(F.trim("value") != "").withColumn("_v", F.try_parse_json("value"))
    values = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.array("_v"))
    return parsed.select(
        F.explode(values).alias("raw_payload"),
        F.when(F.col("_v").isNull(), F.col("value")).alias("malformed"),
        "source_file",
        "source_modified",
        "_ingested_at",
        F.to_date("_ingested_at").alias("ingestion_date"),
        F.ltrim("value").startswith("{").alias("_opens"),
    )


def ingest(
    spark: SparkSession, landing: str, table: str, multiline: bool = True, max_files: int = MAX_FILES_PER_BATCH
) -> DataFrame:
    """Process all new files of ``landing`` and return the bronze table.

    Data, checkpoint and known fields lie in sibling folders under ``table``. With ``multiline`` a file is one JSON
    value or list, read by one task; otherwise each line is one. One writer per table is assumed.
    """
    reader = spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
    # by default the source skips files a week older than the newest one it has seen
    reader = reader.option("maxFileAge", "36500d")
    try:
        files = reader.option("wholetext", multiline).text(landing)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no files in {landing}") from e
    texts = files.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_modified"),
        F.current_timestamp().alias("_ingested_at"),
    )

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        # the schema of a single payload is only worked out where the text leaves open what the payload is
        is_object = F.col("_opens") | F.schema_of_variant("raw_payload").startswith("OBJECT<")
        fields = F.schema_of_variant_agg(F.when(is_object, F.col("raw_payload"))).alias("fields")
        rows = payload_rows(batch).observe(seen, fields).drop("_opens")
        rows.write.mode("overwrite").partitionBy("ingestion_date").parquet(f"{table}/data/batch_id={number}")
        known = known_schema(batch.sparkSession, table) if number else T.StructType([])
        merged = merge_schemas(known, as_schema(seen.get["fields"]))
        entry = batch.sparkSession.createDataFrame([(merged.json(),)], "schema_json string")
        entry.coalesce(1).write.mode("overwrite").json(f"{table}/fields/batch_id={number}")

    query = texts.writeStream.foreachBatch(write).option("checkpointLocation", f"{table}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return read_bronze(spark, table)


def read_bronze(spark: SparkSession, table: str, after_batch: int | None = None) -> DataFrame:
    """All rows ingested so far, or those of the batches after a number, of which only the folders are read."""
    try:
        rows = spark.read.schema(SCHEMA).option("basePath", f"{table}/data").parquet(f"{table}/data")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"nothing was ingested into {table}") from e
    return rows if after_batch is None else rows.where(F.col("batch_id") > after_batch)
