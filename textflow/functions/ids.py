"""Content ids of requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Control characters whose JSON escape contains a hexadecimal letter.
_LETTERED_ESCAPES = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")
_LETTERED_IN_BODY = r"\\u00(?:0[BEF]|1[A-F])"


def text_id(text: Column) -> Column:
    """SHA-256 of the UTF-8 text; the default id."""
    return F.sha2(text, 256)


def json_id(text: Column) -> Column:
    """SHA-256 of the request body `{"text": …}`, so the same text under another type has the same id."""
    return body_id(text=text)


def body_id(**fields: Column) -> Column:
    """SHA-256 of a request body with these fields in this order, as JSON without blanks; its `type` is no part of it.

    Fields that are null are not in the body, and a body without any has a null id.
    """
    body = F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
    # Spark writes \u001F where a request body has \u001f; few texts hold such characters.
    lowered = body
    for code in _LETTERED_ESCAPES:
        lowered = F.regexp_replace(
            lowered, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}"
        )
    some = F.coalesce(*[value.cast("string") for value in fields.values()]).isNotNull()
    return F.when(some, F.sha2(F.when(body.rlike(_LETTERED_IN_BODY), lowered).otherwise(body), 256))
