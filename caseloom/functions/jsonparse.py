"""Best-effort extraction of a JSON object from generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.functions.text import let, strip

FENCED = r"(?s)\A```(?:json)?\s*(.*?)\s*```\z"


def json_candidate(raw: Column) -> Column:
    """Text to try first: the body of a code fence if there is one, else everything."""
    return let(
        strip(raw),
        lambda body: F.when(F.rlike(body, F.lit(FENCED)), F.regexp_extract(body, FENCED, 1)).otherwise(body),
    )


def braces_only(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; NULL when there is no such span."""
    start = F.instr(text, "{")
    end = F.length(text) - F.instr(F.reverse(text), "}") + 1
    found = (start > 0) & F.contains(text, F.lit("}")) & (end > start)
    return F.when(found, F.substring(text, start, end - start + 1))


def parse_json(raw: Column) -> Column:
    """VARIANT of the text, or of its brace span; NULL when neither is JSON."""
    return let(
        json_candidate(F.coalesce(raw, F.lit(""))),
        lambda text: F.coalesce(F.try_parse_json(text), F.try_parse_json(braces_only(text))),
    )


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT<")), F.lit(False))


def parse_object(raw: Column) -> Column:
    """The same for a JSON object; NULL for any other JSON."""
    return let(parse_json(raw), lambda v: F.when(is_object(v), v))
