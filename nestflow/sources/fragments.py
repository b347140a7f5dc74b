"""Read XML files in splits without a stage, also from a stream.

Spark's XML reader gives a whole file to one task. Text with a line separator is
read in splits, so with the closing tag as separator many tasks share one file, and
``from_xml`` turns each piece into a row. A closing tag with white space in it is no
separator for Spark; its piece is cut once more.

The tag must not be nested in itself, nor occur in comments or CDATA, and an element that the
end of its file cuts off passes as whole. ``scan_elements`` knows all of these.
"""

from __future__ import annotations

import re
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from nestflow.functions.paths import quote_path
from nestflow.sources.xml import (
    CORRUPT,
    SOURCE_FILE,
    file_path,
    misfit,
    scan_xml,
    text_attributes,
    typed,
)

# What may follow the name in a start tag: plain text or quoted attribute values.
_INSIDE = r"""(?:[\s/](?:[^"'<>]++|"[^"]*+"|'[^']*+')*+)?+"""
_DECLARED = r"""\A\W{0,3}<\?xml[^>]*?encoding\s*=\s*["']([^"']+)["']"""
# The same in a tag that is not self-closed.
_ATTRIBUTES = r"""(?:\s(?:[^"'<>/]++|"[^"]*+"|'[^']*+')*+)?+"""


def scan_fragments(
    spark: SparkSession,
    paths: str | list[str],
    row_tag: str,
    schema: T.StructType | str,
    *,
    keep_corrupt: bool = False,
    with_file: bool = False,
    ignore_namespace: bool = False,
    recursive: bool = False,
    encoding: str = "UTF-8",
    reader: DataFrameReader | DataStreamReader | None = None,
) -> DataFrame:
    """Rows of ``scan_xml`` with the same tag and schema, read in splits of a file.

    ``keep_corrupt`` adds the text of each element that does not fit the schema. With
    ``ignore_namespace`` the schema's names lack prefixes; ``row_tag`` is written as in the
    files. A file that declares another encoding than ``encoding`` stops the job. ``reader`` may
    bring options, or be a stream's.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if encoding.upper().startswith("UTF-16") or encoding.upper().startswith("UTF-32"):
        raise ValueError(f"{encoding} text cannot be cut at a tag, use scan_xml")
    if not paths:
        nothing = scan_xml(spark, [], row_tag, schema, keep_corrupt=keep_corrupt)
        return nothing.withColumn(SOURCE_FILE, F.lit(None).cast("string")) if with_file else nothing
    kept = [SOURCE_FILE] if with_file else []
    pieces = _pieces(spark, paths, row_tag, recursive, encoding, reader)
    pieces = pieces.select("value", _after_last(row_tag).alias("after"), *kept)
    one = F.array(_whole(row_tag, F.col("after")))
    elements = F.when(_is_one_element(row_tag), one).otherwise(_any_elements(row_tag))
    text_schema, types = text_attributes(schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if ignore_namespace:
        options["ignoreNamespace"] = "true"
    parsed = F.from_xml("element", text_schema.add(CORRUPT, T.StringType()), options)
    rows = pieces.select(F.explode(elements).alias("element"), *kept).select(
        parsed.alias("row"), "element", *kept
    )
    fields = {n: F.col(f"row.{quote_path([n])}") for n in schema.names}
    columns = [typed(c, types[n]).alias(n) if n in types else c for n, c in fields.items()]
    if keep_corrupt:
        text = F.col("element")
        bad = [F.when(misfit(fields[n], t).isNotNull(), text) for n, t in types.items()]
        columns.append(F.coalesce(F.col(f"row.{CORRUPT}"), *bad).alias(CORRUPT))
    return rows.select(*columns, *kept)


def _pieces(spark, paths, row_tag, recursive, encoding, reader) -> DataFrame:
    """The text up to each closing tag, with its file."""
    reader = (reader or spark.read).option("lineSep", f"</{row_tag}>")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    text = reader.text(paths).select(
        decoded_text(encoding).alias("value"), file_path().alias(SOURCE_FILE)
    )
    # A closing tag with white space; also the begin of longer names, which are not cut.
    loose = F.contains(F.col("value"), F.lit(f"</{row_tag}"))
    parts = F.split("value", rf"</{re.escape(row_tag)}\s+>")
    parts = F.when(loose, parts).otherwise(F.array("value"))
    return text.select(F.explode(parts).alias("value"), SOURCE_FILE)


def decoded_text(encoding: str) -> Column:
    """The value of the text reader, read by the encoding; stops at a file of another one."""
    value = F.col("value")
    if encoding.upper() != "UTF-8":
        value = F.decode(value.cast("binary"), encoding)
    known = {encoding.upper(), *(["US-ASCII", "ASCII"] if encoding.upper() == "UTF-8" else [])}
    declared = F.upper(F.regexp_extract(F.substring(value, 1, 200), _DECLARED, 1))
    problem = F.concat(F.lit("encoding "), declared, F.lit(" declared in "), file_path())
    refused = (declared != "") & ~declared.isin(sorted(known))
    # Within a branch, so that the pattern is tried on first pieces only.
    begins = F.col("_metadata.file_block_start") == 0
    begins &= F.instr(F.substring(value, 1, 10), "<?xml") > 0
    checked = F.when(refused, F.raise_error(problem)).otherwise(value)
    return F.when(begins, checked).otherwise(value)


def _after_last(tag: str) -> Column:
    """What follows the last ``<tag`` in a piece of text."""
    return F.substring_index("value", f"<{tag}", -1)


def _whole(tag: str, after: Column) -> Column:
    return F.concat(F.lit(f"<{tag}"), after, F.lit(f"</{tag}>"))


def _is_one_element(tag: str) -> Column:
    """Whether ``<tag`` occurs once in the piece and begins a start tag.

    Nearly all pieces are so, and this is told without a search by pattern through
    the whole text, which costs as much as parsing it.
    """
    before, after = F.substring_index("value", f"<{tag}", 1), F.col("after")
    rest = F.octet_length("value") - F.octet_length(before) - F.octet_length(after)
    head = F.substring_index("after", ">", 1)
    return (rest == len(f"<{tag}".encode())) & head.rlike(rf"\A{_ATTRIBUTES}\z")


def _open_tag(tag: str) -> str:
    """A start tag that is not self-closed, and all that follows it."""
    return rf"(?s)<{re.escape(tag)}({_INSIDE}(?<!/)>.*+)"


def _self_closed(tag: str) -> Column:
    return F.regexp_extract_all("value", F.lit(f"(<{re.escape(tag)}{_INSIDE}(?<=/)>)"), 1)


def _any_elements(tag: str) -> Column:
    """The self-closed elements in a piece of text, then the one it was cut after."""
    opened = F.regexp_extract("value", _open_tag(tag), 1)
    # What follows the last element of a file has no start tag.
    last = F.when(opened != "", F.array(_whole(tag, opened)))
    return F.concat(_self_closed(tag), F.coalesce(last, F.array().cast("array<string>")))
