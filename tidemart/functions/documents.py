"""JSON objects held as variants, and as ``map<string,variant>`` while they are edited."""

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"


def as_map(doc: Column) -> Column:
    """The members of an object; null when the variant is no object."""
    return doc.try_cast(OBJECT)


def member(doc: Column, path: str, ddl: str = "variant") -> Column:
    """A member by path in the given type; null when absent or of another type."""
    return F.try_variant_get(doc, path, ddl)


def present(doc: Column, key: str) -> Column:
    """Whether a key holds something other than JSON null."""
    value = member(doc, f"$.{key}")
    return value.isNotNull() & ~F.is_variant_null(value)


def put(doc: Column, key: str, value: Column) -> Column:
    """The map with one key set; ``value`` is a variant."""
    return F.map_concat(doc, F.create_map(F.lit(key), value))


def without(doc: Column, *keys: str) -> Column:
    """The map with some keys removed."""
    return F.map_filter(doc, lambda key, _: ~key.isin(*keys)) if keys else doc
