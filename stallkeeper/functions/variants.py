"""Small vocabulary for JSON values whose shape is not known in advance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f'$["{name}"]', "variant")


def field_text(value: Column, name: str) -> Column:
    """Field as text: strings as they are, numbers and nested values as JSON text."""
    return F.try_variant_get(value, f'$["{name}"]', "string")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_list(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("ARRAY<"), F.lit(False))


def is_filled_object(value: Column) -> Column:
    shape = kind(value)
    return F.coalesce(shape.startswith("OBJECT<") & (shape != "OBJECT<>"), F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value).startswith("OBJECT<"), F.lit(False))


def as_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def is_filled(value: Column) -> Column:
    """False for null, empty text, zero, false, and empty objects and lists."""
    text = F.try_variant_get(value, "$", "string")
    blank = F.when(kind(value) == "STRING", text == "").otherwise(
        text.rlike(r"\A(?:0|0\.0|false|\{\}|\[\])?\z")
    )
    return ~F.coalesce(blank, F.lit(True))


def objects_of(value: Column) -> Column:
    """An object as a list of one, a list as its objects, anything else as an empty list."""
    return (
        F.when(is_object(value), F.array(value))
        .when(is_list(value), F.filter(as_list(value), is_object))
        .otherwise(F.array().cast("array<variant>"))
    )


def last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def image_text(image: Column, keys: tuple[str, ...]) -> Column:
    """Image address: an object gives its first filled key, a list its first item."""

    def pick(obj: Column) -> Column:
        filled = [F.when(is_filled(field(obj, key)), field(obj, key)) for key in keys]
        return F.coalesce(*filled, obj)

    def unwrap(value: Column) -> Column:
        head = F.try_variant_get(value, "$[0]", "variant")
        return F.when(
            is_list(value) & is_filled(value),
            let(head, lambda h: F.when(is_filled_object(h), pick(h)).otherwise(h)),
        ).otherwise(value)

    return let(
        image,
        lambda i: let(
            F.when(is_filled_object(i), pick(i)).otherwise(i),
            lambda v: F.try_variant_get(unwrap(v), "$", "string"),
        ),
    )
