"""Cleaning and type-conforming expressions.

Every conforming cast is ``try_cast``: with ANSI mode on (the Spark 4
default) a plain cast of a dirty value such as ``'123-45-6789'`` or ``''``
fails the whole job, while ``try_cast`` yields NULL, which the quality checks
then count.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings that mean "no value" in the raw files.
NULL_TOKENS = ("", "null")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: str | Column) -> Column:
    """Trim; blank and the literal ``null`` become SQL NULL (NULL stays NULL).

    Written as nested ``nullif`` over one ``trim`` (cheaper in generated
    code than a ``CASE`` re-evaluating the trimmed value)."""
    out = F.trim(_col(c))
    for token in NULL_TOKENS:
        out = F.nullif(out, F.lit(token))
    return out


def clean_all(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`clean_string` to ``columns`` (default: every string column)
    in a single projection, keeping column order."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if f.dataType.typeName() == "string"
    }
    return df.select(
        [clean_string(c).alias(c) if c in targets else F.col(c) for c in df.columns]
    )


def with_lineage(df: DataFrame) -> DataFrame:
    """Add ``ingest_file_name`` (the source file) and ``ingested_at``.

    The file name comes from the hidden ``_metadata`` column of file sources,
    which (unlike ``input_file_name()``) survives projections and works in
    streaming reads.  ``ingested_at`` is one timestamp per query.
    """
    return df.withColumns(
        {
            "ingest_file_name": F.col("_metadata.file_path"),
            "ingested_at": F.current_timestamp(),
        }
    )


def try_cast(c: str | Column, type_name: str) -> Column:
    """Cast that yields NULL instead of failing on a malformed value."""
    return _col(c).try_cast(type_name)


def epoch_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds held in a string to a timestamp.

    Parsed as a 64-bit integer first: a 32-bit cast overflows in 2038.
    """
    return F.timestamp_seconds(try_cast(c, "bigint"))


def month_key(c: str | Column) -> Column:
    """``yyyy-MM`` month key of a timestamp (session time zone, UTC)."""
    return F.date_format(_col(c), "yyyy-MM")


def ssn_format_error(c: str | Column) -> Column:
    """True when the SSN was submitted with hyphens; NULL stays NULL."""
    return _col(c).contains("-")


def ssn_to_long(c: str | Column) -> Column:
    """Remove hyphens and read the SSN as a number (NULL when malformed)."""
    return try_cast(F.translate(_col(c), "-", ""), "bigint")


GREATEST_LONG = "9223372036854775807"


@F.pandas_udf(T.LongType())
def _plain_number(texts: pd.Series) -> pd.Series:
    """Digits of hyphenated numbers as 64-bit integers, a batch at a time;
    anything else, and a number too great for 64 bits, is missing."""
    digits = texts.str.replace("-", "", regex=False).str.extract(r"^ *\+?0*([0-9]{1,19}) *$", expand=False)
    # Two numbers of 19 digits compare like their texts.
    fits = digits.notna() & ((digits.str.len() < len(GREATEST_LONG)) | (digits <= GREATEST_LONG))
    out = pd.Series(pd.NA, index=texts.index, dtype="Int64")
    if fits.any():
        out[fits] = digits[fits].to_numpy(dtype="U19").astype("int64")
    return out


def ssn_to_long_in_pandas(c: str | Column) -> Column:
    """:func:`ssn_to_long` over Arrow batches.

    Only for pipelines that ask for pandas; the default stays in the JVM and
    inside whole-stage codegen.
    """
    return _plain_number(_col(c))
