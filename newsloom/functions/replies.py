"""JSON on its way to and from a labelling service."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Every character that Unicode counts as white space.
_SPACES = "".join(chr(p) for p in range(0x3001) if chr(p).isspace())


def encode_items(items: Column) -> Column:
    """Array of structs to one JSON text; null fields are written, letters stay unescaped."""
    return F.to_json(items, {"ignoreNullFields": "false"})


def trimmed(body: Column) -> Column:
    return F.btrim(body, F.lit(_SPACES))


def reply_length(body: Column) -> Column:
    """Number of items if the trimmed text is exactly one JSON list, else null.

    Spark's JSON functions stop reading at the end of the first value. Wrapping the text once in a
    list and once in an object makes anything after that value an error in at least one of them.
    """
    text = trimmed(body)
    alone = (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1) & F.try_parse_json(
        F.concat(F.lit('{"r":'), text, F.lit("}"))
    ).isNotNull()
    return F.when(alone, F.json_array_length(text))


def text_field(item: Column, name: str) -> Column:
    """A field as text, whatever scalar it is."""
    return F.try_variant_get(item, f"$.{name}", "string")


def strict_text_field(item: Column, name: str) -> Column:
    """A field only if it is a JSON string: ``true`` is not ``"true"``."""
    kind = F.schema_of_variant(F.try_variant_get(item, f"$.{name}", "variant"))
    return F.when(kind == "STRING", text_field(item, name))


def list_field(item: Column, name: str) -> Column:
    return F.try_variant_get(item, f"$.{name}", "array<string>")
