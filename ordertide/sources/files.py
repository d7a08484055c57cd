"""Readers for the raw order and product files.

All readers return lazily planned DataFrames; the scans split files across
tasks (fixed-width and delimited text are splittable), so they scale with the
number of executors.  Cleaning and lineage are applied in one projection.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.functions.clean import clean_string, with_lineage
from ordertide.schemas import FIXED_WIDTH_LAYOUT, ORDERS_JSON_SCHEMA, PRODUCTS_XML_SCHEMA, RAW_ORDER_COLUMNS


# Holds the text of a record that can't be read as the reader's schema.
CORRUPT = "_corrupt_record"


def accepted(df: DataFrame) -> DataFrame:
    """The records of a reader's ``keep_rejects`` frame that could be read."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(df: DataFrame) -> DataFrame:
    """The others: the file each came from and its whole text."""
    lineage = [c for c in ("ingest_file_name", "ingested_at") if c in df.columns]
    return df.filter(F.col(CORRUPT).isNotNull()).select(*lineage, F.col(CORRUPT).alias("text"))


def _kept(df: DataFrame, keep_rejects: bool) -> DataFrame:
    return df if keep_rejects else accepted(df)


# Characters of a line that are cut out at once: a field is looked for in its
# block, not from the start of the line.
BLOCK = 80


def read_fixed_width(
    spark: SparkSession,
    path: str | Sequence[str],
    layout: Sequence[tuple[str, int, int]] = FIXED_WIDTH_LAYOUT,
    clean: bool = True,
    lineage: bool = True,
    keep_rejects: bool = False,
) -> DataFrame:
    """Slice each text line into columns by ``(name, 1-based start, length)``.

    A line of another width than the layout's is a rejected record."""
    lines = spark.read.text(path)
    if lineage:
        lines = with_lineage(lines)
    blocks: dict[int, tuple[int, int]] = {}
    for _, start, length in layout:
        first, end = blocks.get((start - 1) // BLOCK, (start, start))
        blocks[(start - 1) // BLOCK] = min(first, start), max(end, start + length)
    cols = []
    for name, start, length in layout:
        block = (start - 1) // BLOCK
        piece = F.substring(f"_block{block}", start - blocks[block][0] + 1, length)
        cols.append((clean_string(piece) if clean else piece).alias(name))
    extra = ["ingest_file_name", "ingested_at"] if lineage else []
    width = max(start + length - 1 for _, start, length in layout)
    corrupt = F.when(F.length("value") != width, F.col("value")).alias(CORRUPT)
    cut = [F.substring("value", first, end - first).alias(f"_block{k}") for k, (first, end) in blocks.items()]
    return _kept(lines.select(*cut, *extra, corrupt).select(*cols, *extra, CORRUPT), keep_rejects)


# A null marker that never occurs in text files.
VERBATIM_NULL = "\u0001"


class HeaderMismatch(ValueError):
    """Files of one read have different headers."""


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, header)``: the first line of every file, found in one job.

    Only a file's first split is looked at; the text is still scanned, so
    pass the header to :func:`read_delimited` where it is known.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))


def common_header(spark: SparkSession, path: str | Sequence[str], sep: str) -> list[str]:
    """The one header of all files; files with another one are named."""
    seen = file_headers(spark, path).groupBy("header").agg(F.min("file").alias("file"), F.count(F.lit(1)).alias("files"))
    rows = seen.orderBy(F.col("files").desc(), "header").limit(5).collect()
    if len(rows) != 1:
        raise HeaderMismatch(f"{path}: {len(rows) or 'no'} headers: {[(r.file, r.files, r.header) for r in rows]}")
    return next(csv.reader([rows[0].header], delimiter=sep))


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    names: Sequence[str] | None = RAW_ORDER_COLUMNS,
    positional: bool = False,
    clean: bool = True,
    lineage: bool = True,
    header: Sequence[str] | None = None,
    keep_rejects: bool = False,
) -> DataFrame:
    """Read delimited files with a header row, every column as a string.

    ``header`` is what the header of every file must be: the names in their
    order.  Spark checks it in each file while it reads it; a file with other
    names, another order or another width fails the read and is named.
    Without ``header`` it is ``names``, or with ``positional=True`` (``names``
    replace the header's names position by position) the one header that all
    files have, found in a job of its own.  A line with too few or too many
    fields is a rejected record.
    """
    if header is None:
        header = names if names is not None and not positional else common_header(spark, path, sep)
    header = list(header)
    if positional and names is not None and len(header) != len(names):
        raise HeaderMismatch(f"{path}: {len(header)} columns in the header, {len(names)} target names")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*header, CORRUPT]])
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        # Keep field text verbatim: by default the reader already turns an
        # empty field into NULL, hiding blanks from the quality checks.  NULL
        # mapping is the cleaner's job (blank and literal "null" alike).
        .option("nullValue", VERBATIM_NULL)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("enforceSchema", False)
        # A pruned read would check, and count, only the fields it parses.
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
    )
    df = reader.csv(path)
    if lineage:
        df = with_lineage(df)
    target = list(names) if (names is not None and positional) else header
    cols = [
        (clean_string(F.col(f"`{src}`")) if clean else F.col(f"`{src}`")).alias(dst)
        for src, dst in zip(header, target)
    ]
    extra = ["ingest_file_name", "ingested_at"] if lineage else []
    # Spark refuses a scan of the corrupt column alone, so it brings the first
    # field's column with it (as the second choice, which is always NULL).
    first = F.col(f"`{header[0]}`")
    corrupt = F.coalesce(F.col(CORRUPT), F.nullif(first, first)).alias(CORRUPT)
    return _kept(df.select(*cols, *extra, corrupt), keep_rejects)


def xml_records(spark: SparkSession, path: str | Sequence[str], row_tag: str) -> DataFrame:
    """``(record)``: the text of every row element, from files of any size.

    The text reader cuts the files at the row's closing tag, so a file larger
    than a split is read by several tasks and a record may span lines or
    splits.  What lies before a closing tag holds at most one element that it
    closes, the last one opened, and any number of empty elements
    (``<product/>``).  Row elements must not nest, and must not be named in
    comments.
    """
    # Possessive, so that a long record can't make the match back up.
    attributes = """(?:\\s(?:[^<>"'/]|/(?!>)|"[^"]*"|'[^']*')*+)?"""
    empty = f"<{row_tag}{attributes}/>"
    opened = f"(?s)^.*(<{row_tag}{attributes}>.*)$"
    cut = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    last = F.regexp_extract("value", opened, 1)
    record = F.when(last != "", F.concat(last, F.lit(f"</{row_tag}>")))
    found = F.concat(F.regexp_extract_all("value", F.lit(empty), F.lit(0)), F.array_compact(F.array(record)))
    return cut.select(F.explode(found).alias("record"))


def read_products_xml(
    spark: SparkSession,
    path: str | Sequence[str],
    infer_schema: bool = False,
    root_tag: str = "products",
    row_tag: str = "product",
    keep_rejects: bool = False,
) -> DataFrame:
    """Scan product XML: attributes come back with the ``_`` prefix and the
    price is a nested struct.  An explicit schema is the default because
    inference turns numeric-looking ids into numbers; it reads the records of
    :func:`xml_records`, so large files are split.  A record that isn't well
    formed, or whose values don't fit the schema, is rejected."""
    if infer_schema:
        reader = spark.read.format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
        return reader.option("inferSchema", True).load(path)
    schema = T.StructType([*PRODUCTS_XML_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"rowTag": row_tag, "columnNameOfCorruptRecord": CORRUPT}
    parsed = xml_records(spark, path, row_tag).select(F.from_xml("record", schema, options).alias("r"))
    return _kept(parsed.select("r.*"), keep_rejects)


# The field of an order document that names it.
ORDER_ID = "orderId"


def parse_orders_json(lines: DataFrame, schema: T.StructType = ORDERS_JSON_SCHEMA, keep_rejects: bool = False) -> DataFrame:
    """Order documents from text lines, static or streaming; blank lines are
    none.  A line that isn't one JSON object of the schema's types, or has no
    order id, is a rejected record."""
    withal = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    some = lines.filter(F.trim("value") != "")
    doc = F.from_json("value", withal, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = some.select(doc.alias("d"), "value")
    corrupt = F.when(F.col(f"d.{CORRUPT}").isNotNull() | F.col(f"d.{ORDER_ID}").isNull(), F.col("value"))
    return _kept(parsed.select(*[F.col(f"d.{n}").alias(n) for n in schema.names], corrupt.alias(CORRUPT)), keep_rejects)


def read_orders_json(
    spark: SparkSession, path: str, schema: T.StructType | None = ORDERS_JSON_SCHEMA, keep_rejects: bool = False
) -> DataFrame:
    """Static read of the order documents (schema inferred when ``None``)."""
    if schema is None:
        return spark.read.json(path)
    return parse_orders_json(spark.read.text(path), schema, keep_rejects)


def stream_orders_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ORDERS_JSON_SCHEMA,
    max_files_per_trigger: int | None = None,
    keep_rejects: bool = False,
) -> DataFrame:
    """Unbounded read of order documents; explicit schema, optional throttle."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return parse_orders_json(reader.text(path), schema, keep_rejects)


def file_inventory(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and bytes per named directory, from file metadata only.

    ``binaryFile`` with only ``path`` and ``length`` selected never reads file
    contents (the content column is pruned), so this lists at any size.
    Directories without files still get a row with zero files.
    """
    frames = []
    for name, path in paths.items():
        frames.append(
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "[!._]*")
            .load(path)
            .select(F.lit(name).alias("source"), "length")
        )
    listed = frames[0]
    for f in frames[1:]:
        listed = listed.unionByName(f)
    # Every named folder contributes a zero row, so empty ones still show up
    # (a union and a sum, no join).
    zeros = spark.createDataFrame([(n, 0, 0) for n in paths], "source string, files bigint, bytes bigint")
    files = listed.select("source", F.lit(1).cast("bigint").alias("files"), F.col("length").cast("bigint").alias("bytes"))
    return zeros.unionByName(files).groupBy("source").agg(
        F.sum("files").cast("bigint").alias("files"), F.sum("bytes").cast("bigint").alias("bytes")
    )


def preview(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First ``n`` raw lines of a text file (a bounded peek, not a scan)."""
    return spark.read.text(path).limit(n)
