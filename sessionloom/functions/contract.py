"""The event contract and its checks, as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The contract's field names in order, their types and the accepted event types.
EVENT_FIELDS: dict[str, T.DataType] = {
    "event_id": T.StringType(),
    "user_id": T.StringType(),
    "session_id": T.StringType(),
    "event_type": T.StringType(),
    "product_id": T.StringType(),
    "price": T.DoubleType(),
    "timestamp": T.DoubleType(),
}
EVENT_TYPES = ("page_view", "add_to_cart", "remove_from_cart", "purchase", "search")

# Texts of the violations.
MISSING_FIELD = "missing required field '%s'"
WRONG_TYPE = "field '%s' has type %s, expected one of %s"
INVALID_EVENT_TYPE = "field 'event_type' has invalid value %s, expected one of %s"
EXTRA_FIELDS = "unexpected extra field(s): %s"
NOT_JSON = "unparseable JSON"
NOT_AN_OBJECT = "not a JSON object"

FIELDS = list(EVENT_FIELDS)

# Type names a value may have, by column type, in the order the message lists them.
_ACCEPTED = {T.StringType(): ["str"], T.DoubleType(): ["int", "float"]}


def event_schema(strict: bool = True, extra: list[T.StructField] | None = None) -> T.StructType:
    """Contract as a StructType: NOT NULL when strict, all nullable otherwise.

    ``extra`` appends nullable fields, which is how the contract grows without breaking data
    already written.
    """
    fields = [T.StructField(name, dtype, not strict) for name, dtype in EVENT_FIELDS.items()]
    grown = [T.StructField(f.name, f.dataType, True) for f in extra or []]
    return T.StructType(fields + grown)


def all_present(fields: dict[str, T.DataType] | None = None) -> Column:
    """True where every field has a value; NaN counts as no value.

    Written per field so that the null checks reach the Parquet scan, which ``na.drop`` does not.
    """
    checks = []
    for name, dtype in (fields or EVENT_FIELDS).items():
        checks.append(F.col(name).isNotNull())
        if isinstance(dtype, T.DoubleType):
            checks.append(~F.isnan(name))
    return reduce(Column.__and__, checks)


def known_type(column: str = "event_type") -> Column:
    """Case-sensitive membership in the accepted event types."""
    return F.col(column).isin(*EVENT_TYPES)


# Type names as the messages spell them, by the head of Spark's description of a JSON value.
_KIND_NAMES = {
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
    "ARRAY": "list",
    "OBJECT": "dict",
}


def _value_kind(value: Column) -> Column:
    """Type name of a JSON value; null when the key is absent."""
    # Integers beyond 64 bits are held as decimals without fraction digits.
    described = F.regexp_replace(
        F.schema_of_variant(value), r"^DECIMAL\((19|2\d|3\d),0\)$", "BIGINT"
    )
    names = F.create_map(*[F.lit(word) for pair in _KIND_NAMES.items() for word in pair])
    return F.try_element_at(names, F.regexp_extract(described, "^[A-Z]+", 0))


def _quoted(text: Column) -> Column:
    """Text in quotes, double quotes only if it holds a single one and no double one."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    has_single, has_double = text.contains("'"), text.contains('"')
    return F.when(has_single & ~has_double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def _listed(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, _quoted), ", "), F.lit("]"))


def _listed_names(names: list[str]) -> str:
    return "[" + ", ".join(f"'{name}'" for name in names) + "]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _field_violation(field: Column, members: Column) -> Column:
    """Breach of one field's entry in the contract; null when the field is sound."""

    def of_kind(kind: Column) -> Column:
        wrong = F.format_string(WRONG_TYPE, field["name"], kind, _listed(field["accepted"]))
        return F.when(kind.isNull(), F.format_string(MISSING_FIELD, field["name"])).when(
            ~F.array_contains(field["accepted"], kind), wrong
        )

    return _let(_value_kind(F.try_element_at(members, field["name"])), of_kind)


def _type_violation(value: Column) -> Column:
    """Breach of the accepted event types; null when the field is absent."""

    def of_kind(kind: Column) -> Column:
        text = F.try_variant_get(value, "$", "string")
        shown = (
            F.when(kind == "str", _quoted(text))
            .when(kind == "bool", F.initcap(text))
            .when(kind == "NoneType", "None")
            .otherwise(F.to_json(value))
        )
        accepted = F.lit(_listed_names(sorted(EVENT_TYPES)))
        return F.when(
            (kind != "str") | ~text.isin(*EVENT_TYPES),
            F.format_string(INVALID_EVENT_TYPE, shown, accepted),
        )

    return _let(_value_kind(value), of_kind)


def _extras_violation(keys: Column) -> Column:
    extras = F.array_sort(F.array_except(keys, F.array(*[F.lit(name) for name in FIELDS])))
    return F.when(F.size(extras) > 0, F.format_string(EXTRA_FIELDS, _listed(extras)))


def _object_violations(members: Column) -> Column:
    fields = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.array(*[F.lit(word) for word in _ACCEPTED[dtype]]).alias("accepted"),
            )
            for name, dtype in EVENT_FIELDS.items()
        ]
    )
    per_field = F.transform(fields, lambda field: _field_violation(field, members))
    overall = F.array(
        _type_violation(F.try_element_at(members, F.lit("event_type"))),
        _extras_violation(F.map_keys(members)),
    )
    return F.array_compact(F.concat(per_field, overall))


def _sound_shape() -> str:
    """Pattern of a sound event as ``schema_of_variant`` describes it: members by name."""
    shapes = {T.StringType(): "STRING", T.DoubleType(): r"(BIGINT|DOUBLE|DECIMAL\(\d+,\d+\))"}
    members = [f"{name}: {shapes[EVENT_FIELDS[name]]}" for name in sorted(EVENT_FIELDS)]
    return f"^OBJECT<{', '.join(members)}>$"


def violations(json_text: str) -> Column:
    """Every breach of the contract in a JSON text, empty when there is none.

    Order: per-field breaches in contract order, the event type's value, unknown keys.
    """

    def of_members(members: Column) -> Column:
        return F.when(members.isNull(), F.array(F.lit(NOT_AN_OBJECT))).otherwise(
            _object_violations(members)
        )

    def of_document(document: Column) -> Column:
        # Sound events, nearly all of them, are settled by one look at the document's shape.
        sound = F.schema_of_variant(document).rlike(_sound_shape()) & F.try_variant_get(
            document, "$.event_type", "string"
        ).isin(*EVENT_TYPES)
        members = F.try_variant_get(document, "$", "map<string,variant>")
        return (
            F.when(sound, F.array().cast("array<string>"))
            .when(document.isNull(), F.array(F.lit(NOT_JSON)))
            .otherwise(_let(members, of_members))
        )

    return _let(F.try_parse_json(json_text), of_document)


def check_contract(df: DataFrame, json_column: str = "raw_value") -> DataFrame:
    """Add ``violations array<string>`` to rows with a JSON text."""
    # Through a generator, so that a later filter on the violations does not repeat the check.
    return df.select("*", F.explode_outer(F.array(violations(json_column))).alias("violations"))


def violation_rows(checked: DataFrame, *keep: str) -> DataFrame:
    """One row per violation."""
    return checked.select(*keep, F.explode("violations").alias("violation"))


def violation_text(column: str = "violations") -> Column:
    """All violations of a row in one message."""
    return F.array_join(column, "; ")
