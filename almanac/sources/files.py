"""Landed-file scans and snapshots.

Every reader takes an explicit schema (no inference on production paths).
Snapshots are Parquet partitioned by ``dataset`` and ``snapshot`` (the
vintage text) so a read of
one vintage touches only its folder (partition pruning).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.errors import ContractError, ValidationError

VINTAGE_FORMAT = "yyyy-MM-dd_HH"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             skip_rows: int = 0, by_name: bool = True, **options) -> DataFrame:
    """CSV with a header and an explicit schema. A column typed as string
    keeps leading zeros (FIPS). ``skip_rows`` drops preamble lines first.

    ``by_name`` (default) matches the schema to the header by column name, so
    a source that reorders or adds columns still reads correctly: the columns
    are read as text, selected by name and cast (ANSI: malformed values fail the
    job; a missing column fails up front). Files may differ in their headers:
    those of each layout are read together under that layout's names. One
    header line per file layout reaches the driver, and the file names, which
    Spark's listing holds there anyway.
    """
    if skip_rows:
        return _scan_csv_after_preamble(spark, path, schema, skip_rows)
    if by_name and header:
        st = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
        out = None
        for names, files in _csv_layouts(spark, path, options):
            missing = [f.name for f in st.fields if f.name not in names]
            if missing:
                raise ContractError(f"CSV lacks columns {missing}")
            text = T.StructType([T.StructField(n, T.StringType()) for n in names])
            reader = (spark.read.schema(text).option("header", True).option("mode", "FAILFAST")
                      .option("enforceSchema", False).options(**options))
            raw = reader.csv(files).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields])
            out = raw if out is None else out.unionByName(raw)
        return out if out is not None else spark.createDataFrame([], st)
    reader = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


#: Files whose first lines are read at a time.
HEADS_AT_A_TIME = 8


def _csv_layouts(spark: SparkSession, path, options: Mapping) -> list[tuple[list[str], list[str]]]:
    """The header layouts among the CSV files of a path: (column names, files).

    Spark lists the files, and each one's first line is a read that ends after one row:
    the data behind it are read once, by the scan."""
    import csv
    from concurrent.futures import ThreadPoolExecutor
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(HEADS_AT_A_TIME) as pool:
        heads = list(pool.map(lambda f: spark.read.text(f).head(1), files))
    layouts: dict[str, list[str]] = {}
    for file, head in sorted(zip(files, heads, strict=True)):
        if head:  # an empty file has no rows either
            layouts.setdefault(head[0].value, []).append(file)
    sep = str(options.get("sep", options.get("delimiter", ",")))
    return [([n.strip() if options.get("ignoreLeadingWhiteSpace") else n for n in next(csv.reader([head], delimiter=sep))], found)
            for head, found in sorted(layouts.items())]


def _scan_csv_after_preamble(spark: SparkSession, path: str, schema, skip_rows: int) -> DataFrame:
    """CSV files that start with ``skip_rows`` lines before the header.

    Lines are read as text; the first block of each file holds its first
    lines in order, so the preamble and header are the smallest line ids of
    that block. Only the header lines (one per file) reach the driver, to
    learn the column order; data lines are parsed with ``from_csv`` and the
    schema's columns are selected by name.
    """
    import csv
    import io
    st = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select(
        F.input_file_name().alias("__f"), F.input_file_block_start().alias("__b"),
        F.monotonically_increasing_id().alias("__i"), "value")
    first = lines.filter(F.col("__b") == 0).groupBy("__f").agg(F.min("__i").alias("__i0"))
    marked = lines.join(first, ["__f"], "left").withColumn(
        "__pos", F.when(F.col("__b") == 0, F.col("__i") - F.col("__i0")))
    headers = {r.value for r in marked.filter(F.col("__pos") == skip_rows).select("value").distinct()
               .limit(2).collect()}
    if len(headers) != 1:
        raise ValueError(f"expected one header layout, found {len(headers)}")
    names = next(csv.reader(io.StringIO(headers.pop())))
    types = {f.name: f.dataType for f in st.fields}
    ddl = ", ".join(f"`{n}` string" for n in names)
    body = marked.filter(F.col("__pos").isNull() | (F.col("__pos") > skip_rows))
    parsed = body.select(F.from_csv("value", ddl).alias("r")).select("r.*")
    missing = [n for n in types if n not in names]
    if missing:
        raise ContractError(f"CSV lacks columns {missing}")
    return parsed.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in types.items()])


def scan_multi_file_tagged(spark: SparkSession, groups: Sequence[Mapping]) -> DataFrame:
    """Many files -> one frame. Each group is ``{"path", "schema", "tags":
    {col: literal}, "fill": {col: literal}}``: tag columns are constants
    (e.g. ``location_type``), ``fill`` gives constants for columns a file
    lacks; remaining gaps become null (``unionByName(allowMissingColumns)``)."""
    out = None
    for g in groups:
        df = scan_csv(spark, g["path"], g["schema"])
        adds = {k: F.lit(v) for k, v in {**g.get("fill", {}), **g.get("tags", {})}.items()
                if k not in df.columns or k in g.get("tags", {})}
        df = df.withColumns(adds) if adds else df
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def scan_json_records(spark: SparkSession, path: str, schema: T.StructType | str,
                      row_cap: int | Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """JSON records with column projection (schema pruning) and a truncated-
    read guard: ``row_cap`` is the limit that was sent to the source (a number,
    or a scalar column such as a manifest's count); reaching it means the
    source was cut off, so the job fails (count as a scalar subquery, no collect)."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if columns:
        df = df.select(*columns)
    if row_cap is not None:
        n = df.select(F.count(F.lit(1))).scalar()
        cap = row_cap if isinstance(row_cap, Column) else F.lit(row_cap)
        df = df.filter(F.when(n >= cap, F.raise_error(
            F.concat(F.lit("record read hit the cap of "), cap.cast("string"), F.lit(" rows; data may be truncated"))))
            .otherwise(F.lit(True)))
    return df


def vintage_text(ts: Column) -> Column:
    return F.date_format(ts, VINTAGE_FORMAT)


def write_snapshot(df: DataFrame, root: str, dataset: str, vintage: str) -> str:
    """Store a snapshot under ``root/dataset=<d>/snapshot=<v>`` (dynamic
    overwrite: rewriting one vintage leaves the others alone)."""
    (df.withColumns({"dataset": F.lit(dataset), "snapshot": F.lit(vintage)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dataset", "snapshot").parquet(root))
    return root


def read_snapshot(spark: SparkSession, root: str, dataset: str, vintage: str | None = None,
                  schema: T.StructType | None = None) -> DataFrame:
    """One dataset's snapshot (one vintage, or all); a missing snapshot is an
    error. The partition filter prunes folders before any file is opened."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(root).filter(F.col("dataset") == dataset)
    if vintage is not None:
        df = df.filter(F.col("snapshot") == vintage)
    if df.isEmpty():
        raise ValidationError(f"no snapshot for {dataset} at {vintage}")
    return df.drop("dataset", "snapshot")


def list_vintages(snapshots: DataFrame, start: str | None = None, end: str | None = None,
                  only_last: bool = False, column: str = "vintage") -> DataFrame:
    """Distinct vintages (``YYYY-MM-DD_HH`` text sorts chronologically),
    inclusive start/end, or only the latest."""
    v = snapshots.select(column).distinct()
    if start is not None:
        v = v.filter(F.col(column) >= F.lit(start))
    if end is not None:
        v = v.filter(F.col(column) <= F.lit(end))
    if only_last:
        return v.agg(F.max(column).alias(column))
    return v.orderBy(column)
