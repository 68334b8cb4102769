"""What a message's dynamic value contributes to a frame.

A message's `data` is a struct of the shapes a decoder may yield, of which one is set: `numbers`, an array of numbers
with the name of their type, and named scalar or array fields. Extraction follows the type names, as the sizes of
integers decide whether a number counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number types that a vector keeps in frames; others are dropped.
VECTOR_TYPES = ("float32", "float64", "int32", "int64", "uint32", "uint64")
#: Array element types that the buffered aligner keeps.
ALIGNER_ARRAY_TYPES = ("float32", "float64", "uint8")
U32_MAX = 4_294_967_295


def vector_of(numbers: Column, types: Column) -> Column:
    """ARRAY<FLOAT> of the elements whose type counts; null when none does. types runs beside numbers."""
    pairs = F.arrays_zip(numbers.alias("x"), types.alias("t"))
    kept = F.filter(pairs, lambda p: p["t"].isin(*VECTOR_TYPES) & p["x"].isNotNull())
    out = F.transform(kept, lambda p: p["x"].cast("float"))
    return F.when(F.size(out) > 0, out)


def flat_fields(fields: Column) -> Column:
    """All numbers of MAP<STRING, ARRAY<DOUBLE>> fields in field-name order, as ARRAY<FLOAT>; null when there are none."""
    out = F.flatten(F.transform(F.array_sort(F.map_keys(fields)), lambda k: F.transform(F.element_at(fields, k), lambda x: x.cast("float"))))
    return F.when(F.size(out) > 0, out)


def u32(x: Column) -> Column:
    """A whole number in the range of 32-bit unsigned integers, else null."""
    return F.when(x.between(0, U32_MAX) & (x == F.floor(x)), x.cast("long"))


def is_action(feature: Column) -> Column:
    """Executor rule: `action` itself or any name with `.action` in it; all else is state."""
    return (feature == "action") | feature.contains(".action")


def is_action_prefix(feature: Column) -> Column:
    """Aligner rule: names that begin with `action.`."""
    return feature.startswith("action.")


def role(feature: Column, declared: Column) -> Column:
    """state or action: what the mapping declares, else the executor rule."""
    return F.coalesce(F.when(declared.isin("state", "action"), declared), F.when(is_action(feature), F.lit("action")).otherwise(F.lit("state")))


def is_camera_info(keys: Column) -> Column:
    """keys: names of a message's fields."""
    return F.array_contains(keys, "K") & F.array_contains(keys, "D")


def nested_bytes(arrays: Column) -> Column:
    """bytes_of the first of nested arrays that isn't empty."""
    return bytes_of(F.get(F.filter(arrays, lambda a: F.size(a) > 0), F.lit(0)))


def field_exists(fields: Column, name: str) -> Column:
    """fields: MAP of a message's fields."""
    return F.map_contains_key(fields, F.lit(name))


def field_above(fields: Column, name: str, least: int) -> Column:
    """The field is a whole number above `least`; false for what is none."""
    x = F.try_element_at(fields, F.lit(name)).try_cast("bigint")
    return F.coalesce(x > least, F.lit(False))


def field_longer(arrays: Column, name: str, least: int) -> Column:
    """The field is an array of more than `least` elements."""
    return F.coalesce(F.size(F.try_element_at(arrays, F.lit(name))) > least, F.lit(False))


def bytes_of(numbers: Column) -> Column:
    """BINARY of the elements that fit a byte; null when none does."""
    kept = F.filter(numbers, lambda x: x.between(0, 255))
    packed = F.unhex(F.array_join(F.transform(kept, lambda x: F.lpad(F.hex(x.cast("long")), 2, "0")), ""))
    return F.when(F.size(kept) > 0, packed)


def image_kind(format_name: Column, width: Column, height: Column, size: Column) -> Column:
    """encoded or rgb; null for what is no image. A named format means encoded; raw bytes below w*h*3 are encoded too."""
    raw = width * height * 3
    return F.when(format_name.isNotNull() & size.isNotNull(), F.lit("encoded")).when(
        width.isNotNull() & height.isNotNull() & size.isNotNull(), F.when(size < raw, F.lit("encoded")).when(size == raw, F.lit("rgb"))
    )
