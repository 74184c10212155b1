"""Column expressions over JSON values and text. No Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that never count as a change of the record.
METADATA_FIELDS = (
    "ingestion_timestamp", "source", "_cdc_event_id", "_cdc_event_type", "_cdc_event_timestamp",
    "_pubsub_message_id", "_processing_timestamp", "system_modstamp",
)
FEED_METADATA_FIELDS = ("ingestion_timestamp", "source", "system_modstamp")

# Extended ISO-8601; the cast alone would also take "2023" or padded text.
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
VARIANT_MAP = "map<string,variant>"


def iso_timestamp(text: Column) -> Column:
    """Timestamp of extended ISO-8601 text, null for anything else."""
    return F.when(text.rlike(ISO_TIMESTAMP), F.translate(text, ",", ".").try_cast("timestamp"))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def present(value: Column) -> Column:
    """True for a value that is there and not JSON null."""
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def member(value: Column, name: str) -> Column:
    """A member of a JSON object as VARIANT: SQL null if absent, JSON null if null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def text_member(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "string")


def chosen(value: Column, types: dict[str, str]) -> Column:
    """Members of a JSON object as a struct, in one walk over it; each as ``member`` or ``text_member`` gives it.

    Every single lookup scans the object, so this is for several members. All are null for other values.
    """
    return F.try_variant_get(value, "$", f"struct<{', '.join(f'{n}: {t}' for n, t in types.items())}>")


def members(value: Column) -> Column:
    """All members of a JSON object as map<string,variant>; null for other values."""
    return value.try_cast(T.MapType(T.StringType(), T.VariantType()))


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row.

    The optimizer copies a column's expression into every filter and expression that uses it; for
    parsed JSON each copy would parse again. Columns that come out of a generator are not copied.
    """
    kept = [c for c in df.columns if c not in columns]
    packed = F.struct(*[c.alias(n) for n, c in columns.items()]).alias("__packed")
    return df.select(*kept, packed).select(*kept, F.inline(F.array("__packed")))


# JSON kinds as the engine names them, by the class a rule asks for.
KINDS = {
    "str": ("STRING",), "num": ("BIGINT", "DECIMAL", "DOUBLE"), "bool": ("BOOLEAN",),
    "list": ("ARRAY",), "obj": ("OBJECT",),
}
PARAMETRIC_KINDS = ("DECIMAL", "ARRAY", "OBJECT")
NULL_KIND = "VOID"


def json_kind(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, ARRAY, OBJECT, VOID (JSON null); null if absent."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def canonical(value: Column) -> Column:
    """Text that is equal for equal JSON values; null for absent and JSON null.

    A double is written like a decimal where a decimal holds it exactly, else as it is.
    """
    double = value.try_cast("double")
    text = F.to_json(value)

    def exact(scale: int) -> Column:
        number = double.try_cast(f"decimal(38,{scale})")
        return F.when(number.cast("double") == double, F.regexp_replace(number.cast("string"), r"\.?0+$", ""))

    plain = F.coalesce(exact(9), exact(20))
    return F.nullif(
        F.when(F.schema_of_variant(value) == "DOUBLE", F.coalesce(plain, text)).otherwise(text), F.lit("null")
    )


def snake_case(name: Column) -> Column:
    """Underscore and lower case before every capital, no leading underscore."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, "([A-Z])", "_$1"), "^_+", ""))


def encode_nested(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Nested columns become JSON text; scalars and nulls stay as they are."""
    out = {}
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.VariantType):
            value = F.col(field.name)
            plain = value.try_cast("string")
            nested = json_kind(value).isin("ARRAY", "OBJECT")
            out[field.name] = F.when(nested, F.to_json(value)).otherwise(plain)
        elif isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType)):
            value = F.col(field.name)
            out[field.name] = F.when(value.isNotNull(), F.to_json(value, {"ignoreNullFields": "false"}))
    return df.withColumns(out) if out else df


def changed_fields(
    df: DataFrame,
    before: str = "before",
    after: str = "after",
    tracked: Iterable[str] | None = None,
    skip: Iterable[str] = METADATA_FIELDS,
) -> Column:
    """Sorted names of the fields that differ; an absent field equals null.

    Struct states are compared column by column inside generated code. VARIANT states may have
    any members, so their canonical member texts are compared.
    """
    skipped = set(skip)
    dtype = df.schema[before].dataType
    if isinstance(dtype, T.StructType):
        sides = {s: set(df.schema[s].dataType.fieldNames()) for s in (before, after)}
        known = sides[before] | sides[after]
        names = sorted((set(tracked) if tracked else known) - skipped)

        def value(side: str, name: str) -> Column:
            return F.col(side)[name] if name in sides[side] else F.lit(None)

        differs = [F.when(~value(before, n).eqNullSafe(value(after, n)), F.lit(n)) for n in names if n in known]
        return F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")
    wanted = set(tracked) - skipped if tracked else None

    def counts(name: Column, differs: Column) -> Column:
        kept = name.isin(*sorted(wanted)) if wanted is not None else ~name.isin(*sorted(skipped))
        return differs & kept

    both = F.map_zip_with(
        _canonical_members(F.col(before)), _canonical_members(F.col(after)), lambda _, b, a: ~b.eqNullSafe(a)
    )
    return F.array_sort(F.map_keys(F.map_filter(both, counts)))


def _canonical_members(value: Column) -> Column:
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.transform_values(members(value), lambda _, v: canonical(v)), empty)


def field_changes(changed: Column, before: Column, after: Column) -> Column:
    """map<field, struct<before, after>> of the canonical texts of changed fields."""
    both = F.map_zip_with(
        _canonical_members(before), _canonical_members(after),
        lambda _, b, a: F.struct(b.alias("before"), a.alias("after")),
    )
    return F.map_filter(both, lambda name, _: F.array_contains(changed, name))
