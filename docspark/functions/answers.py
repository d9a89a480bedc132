"""Reading model answers and message contents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark.functions.text import strip

_FENCED = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"
_BRACED = r"(?s)(\{.*\})"
PARTS_TYPE = "array<struct<type:string,text:string>>"


def json_of_answer(c: Column) -> Column:
    """The JSON object in a model answer, peeling a code fence; null if none parses."""
    body = strip(c)
    tries = [body] + [F.nullif(F.regexp_extract(body, p, 1), F.lit("")) for p in (_FENCED, _BRACED)]
    return F.coalesce(*[F.when(F.try_parse_json(t).isNotNull(), t) for t in tries])


def parts_to_text(parts: Column) -> Column:
    """Concatenate the text parts of a structured message, skipping the others."""
    texts = F.transform(parts, lambda p: p["text"])
    return F.array_join(F.filter(texts, lambda t: t.isNotNull()), "")
