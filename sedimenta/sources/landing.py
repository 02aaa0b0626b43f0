"""The landing zone: JSON documents, each an object with one array of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


#: Column in which the parser puts a document that it cannot read as declared.
UNREADABLE = "_unreadable"


def read_landing(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    multiline: bool = False,
    streaming: bool = False,
    max_files: int | None = None,
    unreadable: str = "fail",
    with_file: bool = False,
) -> DataFrame:
    """Landed JSON: a file, a glob, or a folder with all that lies below it.

    With a ``schema`` nothing is inferred and unknown fields are skipped by the
    parser. Without one Spark infers it, which reads everything once more.

    A document that is cut short, spread over lines without ``multiline``, or
    holds a value of another type than declared makes the job fail by the name
    of its file. With ``unreadable="skip"`` it is left out as a whole;
    :func:`unreadable_documents` lists those. ``with_file`` adds each document's
    ``file_path`` and ``file_modification_time``.
    """
    if unreadable not in ("fail", "skip"):
        raise ValueError(f"unreadable must be fail or skip, not {unreadable!r}")
    reader = spark.readStream if streaming else spark.read
    reader = reader.option("multiLine", str(multiline).lower())
    reader = reader.option("recursiveFileLookup", "true")
    reader = reader.option("columnNameOfCorruptRecord", UNREADABLE)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if schema is None:
        df = reader.json(path)
        if UNREADABLE not in df.columns:
            return df
        names = [c for c in df.columns if c != UNREADABLE]
        if not names:
            raise ValueError(f"no document below {path} can be read")
    else:
        declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        names = declared.names
        df = reader.schema(StructType([*declared.fields]).add(UNREADABLE, "string")).json(path)
    bad = F.col(UNREADABLE).isNotNull()
    if unreadable == "skip":
        good = ~bad
    else:
        message = F.concat(
            F.lit("unreadable document in "),
            F.col("_metadata.file_path"),
            F.lit(": "),
            F.substring(UNREADABLE, 1, 80),
        )
        good = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    # the parser wants a declared column beside the unreadable text
    present = F.coalesce(F.hash(*names) >= F.lit(-(1 << 31)), F.lit(True))
    file = ["_metadata.file_path", "_metadata.file_modification_time"] if with_file else []
    return df.filter(good & present).select(*names, *file)


def unreadable_documents(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    multiline: bool = False,
) -> DataFrame:
    """``file`` and ``document`` of all that ``read_landing`` cannot read as declared."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    lines = (
        spark.read.option("wholetext", str(multiline).lower())
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("document"))
    )
    parsed = F.from_json(
        "document",
        StructType([*declared.fields]).add(UNREADABLE, "string"),
        {"columnNameOfCorruptRecord": UNREADABLE},
    )
    return (
        lines.filter(F.trim("document") != "")
        .withColumn("parsed", parsed)
        .filter(F.col("parsed").isNull() | F.col(f"parsed.{UNREADABLE}").isNotNull())
        .select("file", "document")
    )


def has_records(df: DataFrame, root: str) -> bool:
    """Does any document hold a record? Stops at the first."""
    return not df.filter(F.size(root) >= 1).isEmpty()


def records(df: DataFrame, root: str, spread: int | str | None = None) -> DataFrame:
    """One row per record, as a struct column named ``root``.

    Documents without records (no array, an empty one, a NULL in it) give no row.
    A large document is a single row that no task can share, so ``spread`` deals
    its records out over that many partitions before anything else is exploded;
    ``"auto"`` lets AQE choose the number by their size.
    """
    out = df.select(F.explode_outer(root).alias(root)).filter(F.col(root).isNotNull())
    if spread == "auto":
        return out.hint("rebalance")
    return out.repartition(spread) if spread else out


def land(df: DataFrame, path: str, key_cols: Sequence[str], root: str) -> None:
    """Write records below ``path``, one folder per request; a rerun replaces its own.

    ``df`` holds the key columns and the fields of one record per row. Each row
    becomes a line ``{"root": [record]}``: the documents' own shape, but files
    that can be split. Folders of requests not in ``df`` are left alone.
    """
    fields = [F.col(c) for c in df.columns if c not in key_cols]
    key = F.concat_ws("_", *[F.col(c).cast("string") for c in key_cols])
    lines = df.select(key.alias("request"), F.array(F.struct(*fields)).alias(root))
    (
        lines.hint("rebalance", "request")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("request")
        .json(path)
    )


def schema_drift(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multiline: bool = False,
    sampling_ratio: float = 1.0,
) -> dict[str, list[str]]:
    """Fields the landed data have and the schema has not, and the reverse."""
    found = (
        spark.read.option("multiLine", str(multiline).lower())
        .option("recursiveFileLookup", "true")
        .option("samplingRatio", str(sampling_ratio))
        .json(path)
        .schema
    )
    have, declared = set(_leaf_paths(found)), set(_leaf_paths(schema))
    return {"unknown": sorted(have - declared), "missing": sorted(declared - have)}


def _leaf_paths(dtype: DataType, prefix: str = "") -> list[str]:
    while isinstance(dtype, ArrayType):
        dtype = dtype.elementType
    if not isinstance(dtype, StructType):
        return [prefix]
    return [
        leaf
        for field in dtype.fields
        for leaf in _leaf_paths(field.dataType, f"{prefix}.{field.name}".lstrip("."))
    ]
