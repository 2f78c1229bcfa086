"""Typed access to landed JSON kept as VARIANT, so numbers stay numbers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake.functions.text import strip, text_or_empty
from listinglake.functions.times import epoch_text


def _path(name: str) -> str:
    return f"$['{name}']"


def member(value: Column, name: str) -> Column:
    return F.try_variant_get(value, _path(name), "variant")


def field(value: Column, name: str) -> Column:
    """Member ``name`` as text; null when absent or ``value`` is no object."""
    return F.try_variant_get(value, _path(name), "string")


def kind(value: Column, name: str) -> Column:
    """JSON type of member ``name``, such as ``STRING`` or ``BIGINT``."""
    return F.schema_of_variant(member(value, name))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def items(value: Column, name: str | None = None) -> Column:
    """The array at ``name`` (or ``value`` itself) as ``array<variant>``; null if none."""
    return F.try_variant_get(value, _path(name) if name else "$", "array<variant>")


def opened(value: Column, names: Iterable[str], variants: Iterable[str] = ()) -> Column:
    """Members of an object as one struct: ``names`` as text, ``variants`` as they are.

    One walk over the object instead of one per member; null when it is no object.
    """
    fields = [f"`{name}`: string" for name in names] + [f"`{name}`: variant" for name in variants]
    return F.try_variant_get(value, "$", f"struct<{', '.join(fields)}>")


def is_truthy(text: Column, kind_of: Column) -> Column:
    """False for null and for ``""``, 0, false, [] and {}; blanks are true.

    ``kind_of``, the JSON type behind ``text``, is looked at only for the few texts
    that could be such a value.
    """
    could_be_empty = text.rlike(r"^(?:-?0(?:\.0+)?|false|\[\]|\{\})$")
    empty = (text == "") | (could_be_empty & (kind_of != "STRING"))
    return F.coalesce(~empty, F.lit(False))


def _quoted(entry: Column) -> Column:
    single = F.concat(F.lit("'"), F.replace(entry, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), entry, F.lit('"'))
    return F.when(entry.contains("'") & ~entry.contains('"'), double).otherwise(single)


def listed_text(value: Column, name: str, text: Column) -> Column:
    """``text`` of member ``name``; a list of texts reads ``['a', 'b']``."""
    entries = F.try_variant_get(value, _path(name), "array<string>")
    listed = F.concat(F.lit("["), F.array_join(F.transform(entries, _quoted), ", "), F.lit("]"))
    return F.when(text.startswith("[") & (kind(value, name) != "STRING"), listed).otherwise(text)


def first_tag(value: Column, name: str) -> Column:
    """First non-blank entry of a list, or the stripped text of a plain value."""
    entries = F.try_variant_get(value, _path(name), "array<string>")
    tags = F.filter(F.transform(entries, strip), lambda tag: tag != "")
    listed = F.coalesce(F.get(tags, F.lit(0)), F.lit(""))
    return F.when(entries.isNotNull(), listed).otherwise(text_or_empty(field(value, name)))


def publication(value: Column) -> Column:
    """ISO text of a date ``value``; only JSON numbers count as epochs."""
    number = F.when(
        F.schema_of_variant(value) != "STRING", F.try_variant_get(value, "$", "double")
    )
    text = text_or_empty(F.try_variant_get(value, "$", "string"))
    return F.when(number.isNotNull(), F.coalesce(epoch_text(number), F.lit(""))).otherwise(text)
