"""Strict reading of JSON: VARIANT keeps the kinds of values that a schema would coerce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    return F.try_parse_json(text)


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def kind(v: Column, key: str) -> Column:
    """VOID, BOOLEAN, STRING, NUMBER, NESTED, or null where the key is missing."""
    k = F.schema_of_variant(F.try_variant_get(v, f"$['{key}']", "variant"))
    return (
        F.when(k.isin("VOID", "BOOLEAN", "STRING"), k)
        .when(k.rlike("^(OBJECT|ARRAY)"), F.lit("NESTED"))
        .when(k.isNotNull(), F.lit("NUMBER"))
    )


def bound(value: Column, use) -> Column:
    """use(value) with the value worked out once, however often it stands in the result."""
    return F.transform(F.array(value), use)[0]


#: The schema of an object whose values aren't nested and whose keys need no quotes.
_FLAT = r"^OBJECT<[A-Za-z0-9_]+: [A-Za-z0-9_:, ()]*>$"


def kinds(v: Column) -> Column:
    """A map from the keys of an object to the kinds of their values: as `kind`, and EMPTY for an empty string.

    A flat object is read by its schema, which is worked out once for all of its values, any other value by value.
    """

    def of(x: Column) -> Column:
        return bound(F.schema_of_variant(x), lambda k: (
            F.when((k == "STRING") & (F.try_variant_get(x, "$", "string") == ""), F.lit("EMPTY")).when(k.isin("VOID", "BOOLEAN", "STRING"), k)
            .when(k.rlike("^(OBJECT|ARRAY)"), F.lit("NESTED")).otherwise(F.lit("NUMBER"))
        ))

    def named(b: Column) -> Column:
        return F.transform_values(b["types"], lambda f, k: F.when((k == "STRING") & F.array_contains(b["empty"], f), F.lit("EMPTY")).when(k.isin("VOID", "BOOLEAN", "STRING"), k).otherwise(F.lit("NUMBER")))

    def read(schema: Column) -> Column:
        types = F.str_to_map(F.substr(schema, F.lit(8), F.length(schema) - 8), F.lit(", "), F.lit(": "))
        empty = F.map_keys(F.map_filter(texts(v), lambda _, x: x == ""))
        each = F.transform_values(F.try_variant_get(v, "$", "map<string,variant>"), lambda _, x: of(x))
        return F.when(schema.rlike(_FLAT), bound(F.struct(types.alias("types"), empty.alias("empty")), named)).otherwise(each)

    return bound(F.schema_of_variant(v), read)


def texts(v: Column) -> Column:
    """A map from the keys of an object to the texts of their values, as `text` has them."""
    return F.try_variant_get(v, "$", "map<string,string>")


def text(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$['{key}']", "string")


def number(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$['{key}']", "double")


def keys(json: Column) -> Column:
    return F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
