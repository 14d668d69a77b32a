"""JSON decode / encode helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

CORRUPT = "_corrupt_record"


def decode_json(value: str | Column, schema: StructType) -> Column:
    """Bytes/text -> struct. Adds ``_corrupt_record`` so malformed input is
    distinguishable from a record whose fields are all null."""
    c = F.col(value) if isinstance(value, str) else value
    with_corrupt = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    return F.from_json(c.cast("string"), with_corrupt,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def payload_json(*cols, keep_nulls: bool = True) -> Column:
    """``to_json(struct(...))``; explicit nulls kept by default, as consumers of
    the incident, enrichment and DLQ feeds expect every key to be present."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*cols), opts)


def pretty_or_raw(value: str | Column) -> Column:
    """JSON text spaced ``", "`` and ``": "`` when the value parses, else the raw
    text (P13). Key order and the numbers' text stay as they came: the parse is
    only a test, the text is put together from the value's own tokens."""
    c = (F.col(value) if isinstance(value, str) else value).cast("string")
    tokens = F.regexp_extract_all(c, F.lit(r'"(?:[^"\\]|\\.)*"|[,:]|[^",:\s]+'), F.lit(0))
    spaced = F.transform(tokens, lambda t: F.when(t.isin(",", ":"), F.concat(t, F.lit(" "))).otherwise(t))
    return F.when(F.try_parse_json(c).isNotNull(), F.array_join(spaced, "")).otherwise(c)


def with_json_field(fields: Column, name: str, text: Column) -> Column:
    """The JSON object ``fields`` with one more field, whose value is the JSON in
    ``text``; text that doesn't parse becomes a JSON string, null stays null."""
    quoted = F.to_json(F.array(text))
    inner = F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))
    return F.concat(F.substring(fields, F.lit(1), F.length(fields) - 1), F.lit(f',"{name}":'), F.coalesce(inner, F.lit("null")), F.lit("}"))
