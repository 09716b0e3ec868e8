"""Reader of raw occurrence downloads (tab-separated, 50 columns, header)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexrarity.schemas import RAW_COLUMNS, RAW_FIELDS
from hexrarity.sources.records import find_breaks, read_lines, records

#: Column of rows with a wrong number of fields.
FAULT = "_fault"
QUOTED_FIELD = r'(^|\t)"(?:[^"]|"")*"(?=\t|$)'


def detect_encoding(spark: SparkSession, path: str, encoding: str = "auto") -> str:
    """Spark charset name of a text file; an explicit single-byte or UTF-8 name
    wins. UTF-16 is resolved to its byte order, which splittable line reading
    needs, by the byte-order mark or else by where the NUL of an ASCII letter is.
    """
    name = encoding.strip().lower().replace("_", "-")
    if name not in ("auto", "utf-16", "utf16"):
        return encoding
    first = spark.read.text(path).select(F.col("value").cast("binary")).first()
    head = bytes(first[0][:4]) if first is not None else b""
    if head.startswith(b"\xfe\xff"):
        return "UTF-16BE"
    if head.startswith(b"\xff\xfe"):
        return "UTF-16LE"
    if b"\x00" in head:
        return "UTF-16BE" if head.index(b"\x00") % 2 == 0 else "UTF-16LE"
    return "UTF-8" if name == "auto" else "UTF-16LE"


def read_occurrences(
    spark: SparkSession, path: str, encoding: str = "auto", multi_line: bool | None = None
) -> DataFrame:
    """Raw occurrences with the fixed schema; nothing is inferred.

    A row with an unreadable number or too few fields is dropped, not an error; what a
    row has beyond the last field is ignored. So fields are read as text first: then the
    parser marks just the rows with a wrong number of fields, of which the longer ones
    stay, and numbers are cast one by one. Column pruning is off because a pruned parse
    cannot see missing fields.

    A quoted field may hold line breaks. By default the lines are read once to see whether
    any does (``hexrarity.sources.records``); True skips the question, and False ends a row
    at each line break. Files are split in all cases.
    """
    charset = detect_encoding(spark, path, encoding)
    texts = T.StructType([T.StructField(n, T.StringType()) for n in (*RAW_COLUMNS, FAULT)])
    options = {
        "sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": FAULT,
    }
    maps = None
    if multi_line is not False:
        lines = read_lines(spark, path, charset)
        maps = find_breaks(lines, "\t")
    if maps is not None:
        whole = records(lines, maps, "\t").where(F.trim("value") != "")
        parsed = F.from_csv("value", texts.simpleString(), options | {"multiLine": "true"})
        # Generated, not selected: conditions on the fields stay above it, where they would
        # otherwise parse the text again for each field that they name.
        rows = whole.select(F.inline(F.array(parsed)))
    else:
        reader = spark.read.schema(texts).options(**options).options(
            header=True, columnPruning=False, encoding=charset)
        if charset.upper().startswith("UTF-16"):
            reader = reader.option("lineSep", "\n")
        rows = reader.csv(path)
    # Separators of a marked row: those outside quoted fields.
    plain = F.regexp_replace(FAULT, QUOTED_FIELD, "$1")
    separators = F.length(plain) - F.length(F.replace(plain, F.lit("\t"), F.lit("")))
    raw = rows.where(F.col(FAULT).isNull() | (separators >= len(RAW_COLUMNS)))
    typed = {
        name: F.col(name).try_cast(kind) for name, kind in RAW_FIELDS if kind != "string"
    }
    for name, number in typed.items():
        raw = raw.where(F.col(name).isNull() | number.isNotNull())
    return raw.select(*(typed.get(name, F.col(name)).alias(name) for name in RAW_COLUMNS))
