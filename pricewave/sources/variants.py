"""JSON by its types: a text that reads as a number, a null and an absent member are told apart.

``from_json`` with a schema turns all of them into the schema's type. These
helpers read VARIANT values, whose type is asked for with ``schema_of_variant``.
"""

from pyspark.sql import Column, functions as F

_LIST = "array<variant>"


def parsed(text: str | Column) -> Column:
    """The JSON in a text as a VARIANT; null where it is none."""
    return F.try_parse_json(text)


def member(value: Column, name: str) -> Column:
    """A member of an object as a VARIANT: null where it is absent, VOID where it is null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def elements(value: Column) -> Column:
    """A list's elements as VARIANTs; null for what is no list."""
    return F.try_variant_get(value, "$", _LIST)


def text(value: Column) -> Column:
    """A string as it is, a number as its digits; null for an absent value and for a null."""
    return F.try_variant_get(value, "$", "string")


def written(value: Column) -> Column:
    """Any value as text: a null as "None", truth values as "True" and "False"."""
    return F.when(kind(value) == "VOID", "None").when(kind(value) == "BOOLEAN", F.initcap(text(value))).otherwise(text(value))


def kind(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, ARRAY<..>, OBJECT<..>; null for an absent value."""
    return F.schema_of_variant(value)


def is_text(value: Column) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string, variant>").isNotNull()  # without the kinds of all that it holds


def is_list(value: Column) -> Column:
    return elements(value).isNotNull()


def is_whole(value: Column) -> Column:
    """A number written without a fraction or an exponent."""
    return F.coalesce(kind(value) == "BIGINT", F.lit(False))


def is_number(value: Column) -> Column:
    return F.coalesce(kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def number(value: Column) -> Column:
    """A number, or the number that a string holds, as a double; null for anything else."""
    written = F.when(is_text(value) | is_number(value), F.trim(text(value)))
    return F.when(written.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), written.try_cast("double"))


def filled(value: Column) -> Column:
    """Whether there is something: neither absent, null, false, zero nor empty."""
    empty = (
        F.when(is_text(value), text(value) == "")
        .when(is_number(value), text(value).try_cast("double") == 0)
        .when(kind(value) == "BOOLEAN", text(value) == "false")
        .when(is_list(value), F.size(elements(value)) == 0)
        .otherwise(F.coalesce(kind(value), F.lit("VOID")).isin("VOID", "OBJECT<>"))
    )
    return ~empty


def unwrapped(value: Column, name: str = "items") -> Column:
    """The object under the member of that name, where there is one; else the value."""
    inner = member(value, name)
    return F.when(is_object(inner), inner).otherwise(value)
