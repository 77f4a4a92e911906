"""JSON, as text or as VARIANT, to columns and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings a relational database takes for booleans and Spark's cast does not.
TRUE_WORDS = ("on", "tr", "tru", "ye")
FALSE_WORDS = ("of", "off", "fa", "fal", "fals")


def json_text(*columns: Column | str) -> Column:
    """A JSON object of the columns; NULL fields are kept as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def text_fields(document: Column, keys: list[str], lenient: bool = False) -> Column:
    """A struct with the text of each top-level key, parsed in one pass.

    Objects and arrays come back as JSON text, ``null`` and missing keys as NULL.
    A document that is not JSON raises, or gives NULL fields when ``lenient``.
    """
    schema = ", ".join(f"`{key}` STRING" for key in dict.fromkeys(keys))
    return F.from_json(document, schema, {"mode": "PERMISSIVE" if lenient else "FAILFAST"})


def variant_text(document: Column, key: str) -> Column:
    """The text of a top-level key of a VARIANT, as ``text_fields`` gives it for JSON text.

    Numbers come without zeros at their end, and the keys of objects in order of their
    names: a VARIANT does not keep how they were written. NULL for a ``null``, for a
    missing key and for a document that is no object.
    """
    quote = '"' if "'" in key else "'"
    return F.try_variant_get(document, f"$[{quote}{key}{quote}]", "string")


def variant_fields(document: Column, keys: list[str]) -> dict[str, Column]:
    """The text of each top-level key. Nothing is parsed, and a scan brings only those that are used."""
    return {key: variant_text(document, key) for key in keys}


def typed(text: Column, data_type: str, lenient: bool = False) -> Column:
    """Text to ``data_type`` with the empty text as NULL; ``lenient`` turns bad text into NULL."""
    if data_type == "string":
        return text
    # Not ``nullif``, which would bring the whole document along with a field of a VARIANT.
    present = F.when(text != "", text)
    if data_type == "boolean":
        word = F.lower(F.trim(present))
        present = (
            F.when(word.isin(*TRUE_WORDS), F.lit("true"))
            .when(word.isin(*FALSE_WORDS), F.lit("false"))
            .otherwise(present)
        )
    return present.try_cast(data_type) if lenient else present.cast(data_type)


def typed_columns(
    parsed: Column | Mapping[str, Column], columns: Mapping[str, tuple[str, str]], lenient: bool = False
) -> list[Column]:
    """``{name: (key, type)}`` over a struct of ``text_fields`` or ``variant_fields`` as named, typed columns."""
    return [typed(parsed[key], kind, lenient).alias(name) for name, (key, kind) in columns.items()]
