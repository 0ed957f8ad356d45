"""File sources and sinks for stage hand-offs.

Readers always take an explicit schema when one is known (no inference pass
over the data).  JSON is read as JSON Lines and CSV as one record per line
unless ``multi_line`` is asked for.

CSV written here holds one record a line whatever its text: line breaks and
backslashes of values are written as ``\\n``, ``\\r`` and ``\\\\``, and a mark file in
the folder tells the reader to undo that.  So a record never spans lines, and
the files stay splittable.  A JSON array laid out with one indent (as
``json.dump(indent=2)`` writes it) is split at the line that ends a record; any other array,
text in a compressed file (an array in one is still read record by record)
and a CSV from elsewhere whose quoted fields span lines, is read by one task a file.
"""

from __future__ import annotations

import itertools
import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that pandas' CSV reader takes as a missing value by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

FORMATS = {".json": "json", ".jsonl": "json", ".csv": "csv", ".parquet": "parquet"}


def detect_format(path: str) -> str:
    """Reader for a path by its suffix; anything else is rejected."""
    p = path.rstrip("/")
    for suffix, fmt in FORMATS.items():
        if p.endswith(suffix):
            return fmt
    raise ValueError(f"unsupported input {path!r}: expected .json, .jsonl, .csv or .parquet")


def na_to_null(df: DataFrame, tokens=PANDAS_NA_TOKENS) -> DataFrame:
    """Missing-value text (pandas' default tokens) -> NULL in every string column."""
    toks = [F.lit(t) for t in tokens]
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = F.col(f"`{f.name}`")
            out.append(F.when(c.isin(*toks), F.lit(None)).otherwise(c).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _head(spark: SparkSession, path: str, size: int = 64) -> bytes:
    """The first bytes of the first file with data under a path (a file, folder or glob)."""
    fs, p = _fs(spark, path)
    codecs = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(p) or []:
        files = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        for f in files:
            if f.isFile() and f.getLen() and not f.getPath().getName().startswith(("_", ".")):
                stream, codec = fs.open(f.getPath()), codecs.getCodec(f.getPath())
                if codec is not None:
                    stream = codec.createInputStream(stream)
                try:
                    head = bytes(itertools.takewhile(lambda b: b >= 0, (stream.read() for _ in range(size))))
                finally:
                    stream.close()
                if head:
                    return head
    return b""


def _array_layout(head: bytes) -> tuple[bool, tuple[str, str] | None]:
    """Whether a JSON file starts as an array, and (line break, indent) if every record starts on an indented line of its own."""
    text = head.lstrip(b"\xef\xbb\xbf \t\r\n")
    found = re.match(rb"\[(\r?\n)([ \t]+)\{\r?\n", text)
    return text.startswith(b"["), (found[1].decode(), found[2].decode()) if found else None


def read_json_array(spark: SparkSession, path: str, layout: tuple[str, str], schema=None) -> DataFrame:
    """Records of JSON arrays laid out with an indent, split across tasks.

    The line that ends a record, its indent and "},", is the record separator of a
    text scan: text inside a record cannot hold it, for a line break within a JSON
    string is escaped and what is nested deeper is indented further.  Without a
    schema all values are text, under every key that occurs (one distributed pass).  A
    record that is not valid JSON gives NULLs.
    """
    newline, indent = layout
    text = spark.read.option("lineSep", f"{newline}{indent}}},{newline}").text(path)
    body = F.regexp_replace("value", r"^[\s\x{FEFF}]*\[?\s*(?=\{)", "")       # the array's start
    closed = F.regexp_replace(body, r"\}\s*\]\s*$", "}")                     # its end
    whole = body.rlike(r"\}\s*\]\s*$")
    record = F.when(whole, closed).otherwise(F.concat(body, F.lit("}")))
    rows = text.select(record.alias("_json")).where(F.col("_json").startswith("{"))
    if schema is None:
        keys = rows.select(F.explode(F.json_object_keys("_json")).alias("k")).distinct().orderBy("k").collect()
        schema = T.StructType([T.StructField(r["k"], T.StringType()) for r in keys])
        if not keys:
            return rows.select()
    return rows.select(F.from_json("_json", schema).alias("_r")).select("_r.*")


ESCAPED = "_escaped_line_breaks"


def escape_lines(df: DataFrame) -> DataFrame:
    """Line breaks and backslashes of text columns as two characters each, so that a record is one line."""
    def one(c):
        for raw, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            c = F.replace(c, F.lit(raw), F.lit(written))
        return c
    return df.select(*[one(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def unescape_lines(df: DataFrame) -> DataFrame:
    """Undoes ``escape_lines``: between escaped backslashes, "\\n" and "\\r" are line breaks."""
    def one(name):
        c = F.col(f"`{name}`")
        parts = F.transform(F.split(c, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.when(c.contains("\\"), F.array_join(parts, "\\")).otherwise(c).alias(name)
    return df.select(*[one(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def _marked(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{ESCAPED}")
    return not any(c in path for c in "*?[{") and fs.exists(mark)


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema=None, *,
               multi_line: bool = False, na_tokens: bool = True, text: bool = False, escaped: bool | None = None) -> DataFrame:
    """Read a stage file: JSON Lines (or, with ``multi_line``, one array a file),
    CSV with a header (``multi_line``: quoted fields may span lines; pandas' NA
    text -> NULL) or parquet.  ``text`` reads JSON values as text when no schema
    is given.  ``escaped`` says whether a CSV's line breaks are written as
    ``write_table`` does (default: if the folder holds its mark).

    An indented JSON array is split across tasks when a schema or ``text`` is
    given.  A missing path raises ``FileNotFoundError``; a JSON array that is read
    as JSON Lines raises ``ValueError`` (the first file with data is looked at).
    """
    fmt = fmt or detect_format(path)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    try:
        if fmt == "json":
            array, layout = _array_layout(_head(spark, path))
            if array and not multi_line:
                raise ValueError(f"{path} holds a JSON array: read it with multi_line=True")
            if layout and (schema is not None or text):
                df = read_json_array(spark, path, layout, schema)
            else:
                df = r.option("multiLine", multi_line).option("primitivesAsString", text).json(path)
        elif fmt == "csv":
            df = (r.option("header", True).option("multiLine", multi_line).option("escape", '"')
                  .option("nullValue", None).csv(path))
            if _marked(spark, path) if escaped is None else escaped:
                df = unescape_lines(df)
            if na_tokens:
                df = na_to_null(df)
        elif fmt == "parquet":
            df = r.parquet(path)
        else:
            raise ValueError(f"unsupported format {fmt!r}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"File not found: {path}") from e
        raise
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite", run_ts: str | None = None, compression: str | None = None,
                file_rows: int | None = None) -> str:
    """Write a stage table as a directory of files.

    ``csv``: header, quoted text; ``json``: JSON Lines keeping NULL fields;
    ``parquet``: typed columns.  ``partition_by`` writes one folder per value
    (e.g. platform / category); ``run_ts`` adds a ``run_ts`` partition and
    overwrites only the partitions written (dynamic overwrite), so reruns of
    one run replace that run alone.

    Rows are dealt by ``partition_by`` before they are written, and adaptive
    execution splits or joins what it deals by size: a folder gets as many files
    as its bytes need, a folder of a few rows one file, and a folder that holds a
    third of all rows is written by many tasks.  ``compression`` names a codec and
    ``file_rows`` the most rows of a file: compressed text is read by one task a
    file, so the two go together.
    """
    parts = list(partition_by or [])
    if parts:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in parts])
    if run_ts is not None:
        df = df.withColumn("run_ts", F.lit(run_ts))
        parts = ["run_ts", *parts]
    if fmt == "csv":
        df = escape_lines(df)
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if file_rows:
        w = w.option("maxRecordsPerFile", file_rows)
    if run_ts is not None or parts:
        w = w.option("partitionOverwriteMode", "dynamic")
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "csv":
        # keep surrounding blanks: they are data until the clean stage trims them
        (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
        spark = df.sparkSession
        fs, _ = _fs(spark, path)
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{ESCAPED}")).close()
    elif fmt == "json":
        w.option("ignoreNullFields", False).json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def default_output_path(input_path: str) -> str:
    """Where the clean stage writes when no output is named: beside the input,
    ``_cleaned.csv`` in place of its suffix."""
    p = input_path.rstrip("/")
    suffix = next((x for x in FORMATS if p.endswith(x)), None)
    if suffix is None:
        detect_format(input_path)  # raises
    return f"{p[:-len(suffix)]}_cleaned.csv"


def refuse_overwrite(input_path: str, output_path: str) -> None:
    """Raise when the output is the input, holds it, or lies in it."""
    a, b = (x.removeprefix("file:").rstrip("/") + "/" for x in (input_path, output_path))
    if "://" not in a:
        a, b = (os.path.realpath(x) + "/" for x in (a, b))
    if a.startswith(b) or b.startswith(a):
        raise ValueError(f"output {output_path!r} would overwrite input {input_path!r}")


def array_lines(records: DataFrame) -> DataFrame:
    """The lines of indented JSON arrays, one array a task, from a text column of indented records: brackets around a
    task's records and commas between them, as the rows stream through."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def lines(batches):
        held = None  # the last record so far: whether a comma follows it is not known yet
        row = lambda values: pa.record_batch([values], names=["value"])
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(0).cast(pa.string())
            if held is None:
                yield row(pa.array(["["]))
            else:
                texts = pa.concat_arrays([held, texts])
            held = texts.slice(len(texts) - 1)
            if len(texts) > 1:
                yield row(pc.binary_join_element_wise(texts.slice(0, len(texts) - 1), ",", ""))
        if held is not None:
            yield row(held)
            yield row(pa.array(["]"]))

    return records.mapInArrow(lines, "value string")
