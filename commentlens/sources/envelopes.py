"""JSON payloads of varying shape, flattened to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.text import is_blank, strip

LISTS = ["try_variant_get({v}, '$', 'array<variant>')", *[f"try_variant_get({{v}}, '$.{k}', 'array<variant>')" for k in ("data", "comments")]]


def _inner(v: str) -> str:
    """SQL for the items one level below ``v``; NULL for a record."""
    return f"coalesce({', '.join(x.format(v=v) for x in LISTS)})"


def _all_items(v: str, most: str) -> str:
    """SQL for the records below ``v``: levels are opened until no list is left, which takes ``most`` steps or fewer."""
    opened = f"flatten(transform(level.items, item -> coalesce({_inner('item')}, array(item))))"
    step = (
        f"transform(array({opened}), found -> named_struct('items', found, "
        f"'done', NOT exists(found, item -> {_inner('item')} IS NOT NULL)))[0]"
    )
    start = f"named_struct('items', array({v}), 'done', false)"
    return f"aggregate(sequence(0, {most}), {start}, (level, i) -> if(level.done, level, {step}), level -> level.items)"


END = "␃"  # stands behind a payload while it is parsed


def whole_json(payload: Column) -> Column:
    """The JSON value that takes up the whole payload, as VARIANT; NULL if there is none.

    Spark's parser stops after the first value. So the payload is parsed as the first of two items, of
    which the second is a marker: text behind the value breaks the list or changes its length.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), payload, F.lit(f',"{END}"]')))
    marked = F.try_variant_get(listed, "$[1]", "string") == END
    alone = F.try_variant_get(listed, "$[2]", "variant").isNull()
    return F.when(marked & alone, F.try_variant_get(listed, "$[0]", "variant"))


def malformed_payloads(df: DataFrame, payload: str) -> DataFrame:
    """The rows whose payload is not one whole JSON value. A NULL payload is none either."""
    return df.filter(whole_json(F.col(payload)).isNull())


def json_records(df: DataFrame, payload: str) -> DataFrame:
    """One row per record of each payload, in order, as ``record`` (VARIANT) and ``record_pos``.

    A payload may be a list, an object with a list under ``data`` or else ``comments``, any nesting
    of these, or a single record. Records are numbered within their payload. Payloads that are no
    JSON, or go on behind it, give one row with a NULL record, so that they can be counted.
    """
    brackets = F.length(payload) - F.length(F.replace(F.col(payload), F.lit("["), F.lit("")))
    df = df.withColumns({"_payload": whole_json(F.col(payload)), "_brackets": brackets})
    items = F.expr(f"coalesce({_all_items('_payload', '_brackets')}, array(_payload))")
    records = F.filter(items, lambda item: item.isNull() | ~F.is_variant_null(item))
    return df.select("*", F.posexplode(records).alias("record_pos", "record")).drop("_payload", "_brackets")


def json_text(record: str) -> Column:
    """Text of a record: the first known path that holds a non-blank string.

    The type is checked, since reading a number as text would invent a comment. A record that is
    itself a string is taken as it is.
    """

    def text_at(path: str) -> Column:
        kind = F.expr(f"schema_of_variant(try_variant_get({record}, '{path}', 'variant'))")
        value = F.expr(f"try_variant_get({record}, '{path}', 'string')")
        return F.when((kind == "STRING") & ~is_blank(value), value)

    paths = [strip(text_at(f"$.{path}")) for path in rules.JSON_TEXT_PATHS]
    return F.coalesce(text_at("$"), *paths)
