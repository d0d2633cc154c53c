"""Raw landing (S17, K03): files stored as received, by dataset and vintage, and decoded
when they are read back. A file is a row with its name, bytes, length and SHA-256, as
Spark's ``binaryFile`` source delivers it, so one file must fit a task's memory (2 GB at
most); sources land in parts below that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.errors import ValidationError
from almanac.operators.store import stored

RAW_COLUMNS = ["name", "content", "length", "sha256"]
RAW_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType()),
                           T.StructField("length", T.LongType()), T.StructField("sha256", T.StringType()),
                           T.StructField("dataset", T.StringType()), T.StructField("vintage", T.StringType())])
#: Bytes of a UTF-8 mark that may stand before a text.
_MARK = "﻿"


def received(spark: SparkSession, path: str | Sequence[str], under: str | None = None, pattern: str | None = None) -> DataFrame:
    """Files of a folder (or several) as rows (name, content, length, sha256). ``name`` is
    the path below ``under`` (by default the file's own name); ``pattern`` is a glob on
    file names. Files in sub-folders are received too; empty files are not, as Spark's
    listing leaves them out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    path_ = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    name = F.element_at(F.split("path", "/"), -1)
    if under is not None:
        root = F.lit("/" + under.split(":", 1)[-1].strip("/") + "/")
        name = F.when(path_.startswith(root), F.substring(path_, F.length(root) + 1, F.length(path_))).otherwise(name)
    return reader.load(path).select(name.alias("name"), "content", "length", F.sha2("content", 256).alias("sha256"))


def land_raw(files: DataFrame, root: str, dataset: str, vintage: str) -> None:
    """Store the files of one (dataset, vintage) as received. Storing a vintage again
    replaces it and leaves the others alone; a name that comes twice is an error."""
    twice = files.groupBy("name").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValidationError(f"files of one name: {[r.name for r in twice]}")
    (files.select(*RAW_COLUMNS).withColumns({"dataset": F.lit(dataset), "vintage": F.lit(vintage)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "vintage").parquet(root))


def raw_vintages(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, vintage, files, bytes) of all that is stored; contents are not read."""
    return (stored(spark, root, RAW_SCHEMA).groupBy("dataset", "vintage")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def read_raw(spark: SparkSession, root: str, dataset: str, vintage: str) -> DataFrame:
    """The files (name, content, length, sha256) of one vintage; a missing one is an
    error. Only its folder is read, and a file whose bytes are not those that were
    received fails the job."""
    files = stored(spark, root, RAW_SCHEMA).where((F.col("dataset") == dataset) & (F.col("vintage") == vintage))
    if files.select("name").isEmpty():
        raise ValidationError(f"no raw files of {dataset} at {vintage}")
    sound = F.when(F.sha2("content", 256) == F.col("sha256"), F.col("content")).otherwise(
        F.raise_error(F.concat(F.lit("stored bytes differ from those received: "), F.col("name"))).cast("binary"))
    return files.select("name", sound.alias("content"), "length", "sha256")


def raw_text(files: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """(name, text): contents decoded, without a leading byte-order mark."""
    text = F.decode("content", charset)
    return files.select("name", F.when(text.startswith(_MARK), F.substring(text, 2, F.length(text))).otherwise(text).alias("text"))


def raw_lines(files: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """(name, line_no from 0, line) of the files; line ends are LF or CR LF, and the last
    line needs none."""
    body = raw_text(files, charset).select("name", F.regexp_replace("text", r"\r?\n\z", "").alias("text"))
    return body.where(F.length("text") > 0).select("name", F.posexplode(F.split("text", "\r?\n")).alias("line_no", "line"))


def raw_csv(files: DataFrame, schema: T.StructType | str, charset: str = "UTF-8", **options) -> DataFrame:
    """Rows of CSV files with a header line each, by the header's names: (name, line_no,
    the schema's columns). Files may differ in their headers. A value that doesn't parse
    fails the job, a column that a header lacks is null; values don't span lines."""
    st = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = raw_lines(files, charset)
    sep = str(options.get("sep", ","))
    heads = lines.where("line_no = 0").select("name", _cells(sep).alias("head"))
    body = lines.where("line_no > 0 and line <> ''").join(heads, "name").withColumn("cells", _cells(sep))

    def value(f: T.StructField) -> Column:
        at = F.array_position("head", F.lit(f.name)).cast("int")
        text = F.when(at > 0, F.get("cells", at - 1))
        return F.when(text != "", text).cast(f.dataType).alias(f.name)

    return body.select("name", "line_no", *[value(f) for f in st.fields])


def _cells(sep: str) -> Column:
    """The cells of a line; quoted ones may hold the separator and doubled quotes."""
    mark = "".join(c if c.isalnum() else "\\" + c for c in sep)
    found = F.regexp_extract_all(F.concat(F.lit(sep), "line"), F.lit(f'{mark}[ ]*+("(?:[^"]++|"")*+"|(?:(?!{mark}).)*+)'), F.lit(1))
    plain = lambda c: F.replace(F.substring(c, 2, F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda c: F.when(c.startswith('"'), plain(c)).otherwise(F.trim(c)))
