"""Statement files as one row per markup tag.

A ``<`` cannot occur raw inside an attribute, so reading text with ``<`` as the
record separator yields exactly one tag per row.  Unlike a whole-document read
this splits one large file over many tasks, needs no schema pass, and keeps
attributes nobody declared, which the content fingerprint must include.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAG = (
    r"""(?s)^([^\s/>!?=]+)((?:\s+[^\s=<>/]+\s*=\s*(?:"[^"]*"|'[^']*'))*+)\s*(/?)>.*$"""
)
# U+0001 cannot occur in a document.
_MARK = "\u0001"
_PARTS = _MARK.join(("$1", "$2", "$3"))
_CLOSING = r"^/([^\s>]+)\s*>"
_MARKUP = r"(?s)^(?:\?.*\?>|!--.*-->|!\[CDATA\[.*\]\]>|!DOCTYPE[^\[]*>)"
# A prolog that declares another encoding: the text would be read wrongly.
_FOREIGN = r"""(?is)^\?xml\s.*encoding\s*=\s*["'](?!utf-8|us-ascii)"""
#: The name such a prolog gets; no element can have it.
FOREIGN_TAG = "?foreign"
_MASKED = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_PROBE = "attributes-end"
_ATTRIBUTE_MAP = T.StructType([T.StructField("t", T.MapType(T.StringType(), T.StringType()))])

STATEMENT_FILES = "*.[xX][mM][lL]"

# Directories in order, then names without regard to case, as a sorted folder listing.
FILE_ORDER = "concat_ws('\\u0001', lower(regexp_replace(file, '/[^/]*$', '')), lower(file), file)"


def read_tag_text(
    spark: SparkSession,
    paths: str | list[str],
    whole_files: bool = False,
    pattern: str = STATEMENT_FILES,
) -> DataFrame:
    """Rows of (file, text), one per tag.

    ``whole_files`` reads each file as one value and drops comments and CDATA
    first: the exact way for files whose comments hold markup.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if not whole_files:
        return reader.text(paths, lineSep="<").select(
            F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
        )
    documents = reader.text(paths, wholetext=True)
    return documents.select(
        F.col("_metadata.file_path").alias("file"),
        F.explode(F.split(F.regexp_replace("value", _MASKED, ""), "<")).alias("text"),
    )


def stream_tag_text(
    spark: SparkSession,
    folder: str,
    max_files: int | None = None,
    pattern: str = STATEMENT_FILES,
) -> DataFrame:
    """The same rows from a folder that keeps receiving files."""
    reader = (
        spark.readStream.format("text")
        .option("lineSep", "<")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )


def _attributes(tag_attributes: Column) -> Column:
    """Attribute text to a map; entities are decoded, and faulty text gives NULL."""
    document = F.concat(
        F.lit("<r><t"), tag_attributes, F.lit(f"><{_PROBE}>1</{_PROBE}></t></r>")
    )
    parsed = F.from_xml(
        document, _ATTRIBUTE_MAP, {"ignoreSurroundingSpaces": "false", "attributePrefix": ""}
    )["t"]
    return F.map_filter(parsed, lambda name, _: name != _PROBE)


def split_tags(tag_text: DataFrame, element: str) -> DataFrame:
    """Rows of (file, text, tag, step, whole, is_record, attributes).

    ``step`` is +1 for an opening and -1 for a closing tag, so the steps of a
    complete file add up to zero for every tag name.  ``whole`` is false for a
    tag that is cut off or cannot be read.
    """
    text = F.col("text")
    # One match per tag: name, attribute text and the slash of an empty element.
    shaped = tag_text.where(~text.rlike(r"^[\s\uFEFF]*$")).select(
        "file",
        "text",
        F.split(F.regexp_replace(text, _TAG, _PARTS), _MARK).alias("parts"),
    )
    parts = F.col("parts")
    opened = F.size(parts) == 3
    closed = text.rlike(_CLOSING)
    named = shaped.select(
        "file",
        "text",
        F.when(opened, parts[0])
        .when(closed, F.regexp_extract(text, _CLOSING, 1))
        .when(text.rlike(_FOREIGN), F.lit(FOREIGN_TAG))
        .otherwise(F.lit(""))
        .alias("tag"),
        F.when(opened, F.when(parts[2] == "/", 0).otherwise(1))
        .when(closed, F.lit(-1))
        .otherwise(F.lit(0))
        .alias("step"),
        F.when(opened | closed, F.lit(True))
        .otherwise(text.rlike(_MARKUP) & ~text.rlike(_FOREIGN))
        .alias("whole"),
        F.when(opened, parts[0] == element)
        .otherwise(text.rlike(rf"^{element}(?:[\s/>]|$)"))
        .alias("is_record"),
        F.when(opened & (parts[0] == element), _attributes(parts[1])).alias("attributes"),
    )
    readable = ~F.col("is_record") | F.col("attributes").isNotNull()
    return named.withColumn("whole", F.col("whole") & readable)
