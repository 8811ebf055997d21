"""File sources and sinks with explicit schemas.

* JSON-lines is splittable: one task per file block.  Pass a schema - an
  inferred schema costs a full extra pass over the data.
* ``multiLine`` JSON / CSV is NOT splittable (one task per file).  Writers
  here emit one file per partition, so a multi-line dataset written by
  Spark is read back with one task per written file.
* Sinks write from the executors (``df.write``); nothing goes through
  the driver.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# CSV options that survive text with newlines, commas, quotes and edge blanks.
# Nulls are written as the \N marker so that an empty string stays an empty
# string (a text consisting of exactly \N would read back as null).
CSV_NULL = "\\N"
CSV_WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "quoteAll": "true", "nullValue": CSV_NULL,
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8", "lineSep": "\n",
}
CSV_READ_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true", "nullValue": CSV_NULL,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8", "mode": "FAILFAST",
}


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str,
               mode: str = "PERMISSIVE", corrupt_col: str | None = None) -> DataFrame:
    """JSON-lines scan with a fixed schema (splittable)."""
    r = spark.read.schema(schema).option("mode", mode)
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json_multiline(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Files that each hold one JSON document (an object or an array of objects)."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write each partition as a file holding one JSON array.

    The JSON text is produced by ``to_json`` in the JVM; Python only adds the
    brackets and commas while streaming batches (bounded memory per task).
    """
    # a nested function travels by value, so executors need not have this package
    def array_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Wrap the JSON lines of one partition into one JSON array (one batch lookahead)."""
        prev: pd.DataFrame | None = None
        first = True
        for b in batches:
            if b.empty:
                continue
            lines = b["value"].astype(object).copy()
            if first:
                lines.iloc[0] = "[" + lines.iloc[0]
                first = False
            if prev is not None:
                yield prev
            prev = pd.DataFrame({"value": lines + ","})
        if prev is not None:
            last = prev["value"].copy()
            last.iloc[-1] = last.iloc[-1][:-1] + "]"
            yield pd.DataFrame({"value": last})

    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    # one array is one file: no limit on a file's rows may cut it
    lines.mapInPandas(array_lines, "value string").write.mode(mode).option("maxRecordsPerFile", 0).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    opts = dict(CSV_WRITE_OPTIONS)
    opts.update({k: str(v) for k, v in options.items()})
    df.write.mode(mode).options(**opts).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    opts = dict(CSV_READ_OPTIONS)
    opts.update({k: str(v) for k, v in options.items()})
    return spark.read.schema(schema).options(**opts).csv(path)


def decode_resultset(df: DataFrame, values_col: str, columns: Sequence[str],
                     types: dict[str, str] | None = None, time_col: str = "time") -> DataFrame:
    """Positional value arrays + a column list -> a typed table.

    ``values_col`` holds one record per row as ``array<string>``; element i
    becomes column ``columns[i]``.  ``time_col`` is parsed to TIMESTAMP_NTZ.
    """
    types = types or {}
    out = []
    for i, name in enumerate(columns):
        v = F.try_element_at(F.col(values_col), F.lit(i + 1))
        if name == time_col:
            v = F.to_timestamp_ntz(v)
        elif name in types:
            v = v.cast(types[name])
        out.append(v.alias(name))
    return df.select(*out)


def decode_payload(df: DataFrame, payload_col: str, types: dict[str, str], time_col: str = "time") -> DataFrame:
    """JSON results ``{"columns": [...], "values": [[...], ...]}`` -> a typed table.

    Names and rows both come from the payload, so payloads may order their columns differently.  ``types``
    names the wanted columns; one that a payload lacks is null in its rows.
    """
    doc = F.from_json(payload_col, "columns array<string>, values array<array<string>>")
    rows = df.select(doc.alias("d")).select("d.columns", F.explode("d.values").alias("v"))
    out = []
    for name, kind in types.items():
        at = F.array_position(F.coalesce("columns", F.array().cast("array<string>")), name).cast("int")
        value = F.when(at > 0, F.try_element_at("v", at))
        out.append((F.to_timestamp_ntz(value) if name == time_col else value.try_cast(kind)).alias(name))
    return rows.select(*out)


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant table (lists, lookups) - its size is fixed by the code."""
    return spark.createDataFrame(rows, schema)


def tokenise(df: DataFrame, col: str, sep: str, keep: Sequence[str] = (),
             pos_col: str = "pos", token_col: str = "token") -> DataFrame:
    """One row per token with its position (``posexplode(split())``)."""
    from brisa.functions.text import split_tokens
    return df.select(*keep, F.posexplode(split_tokens(col, sep)).alias(pos_col, token_col)) \
        .withColumn(pos_col, F.col(pos_col).cast("bigint"))
