"""The one registry of CRM objects; every schema, rename and required list derives from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STRING, NUMERIC, BOOLEAN, TIMESTAMP, DATE, JSON = (
    "STRING", "NUMERIC", "BOOLEAN", "TIMESTAMP", "DATE", "JSON",
)

SPARK_TYPES: dict[str, T.DataType] = {
    STRING: T.StringType(),
    NUMERIC: T.DecimalType(38, 9),
    BOOLEAN: T.BooleanType(),
    TIMESTAMP: T.TimestampType(),
    DATE: T.DateType(),
    JSON: T.StringType(),
}

# Names and constants that results must carry unchanged.
SOURCE_BATCH = "salesforce_api"
SOURCE_CDC = "salesforce_cdc"
OBJECT_TYPES = ("Account", "Contact", "Opportunity", "Case")
CHANGE_TYPES = ("INSERT", "UPDATE", "DELETE")
RAW_TABLES = {
    "Account": "raw_accounts",
    "Contact": "raw_contacts",
    "Opportunity": "raw_opportunities",
    "Case": "raw_cases",
}
HISTORY_TABLES = {
    "Account": "accounts_history",
    "Contact": "contacts_history",
    "Opportunity": "opportunities_history",
    "Case": "cases_history",
}
ALERT_TYPE = "data_quality_violation"
ALERT_SEVERITY = "ERROR"


@dataclass(frozen=True)
class Field:
    """One column of an object.

    ``required`` is the record-level requirement, ``cdc_required`` the one for change events;
    ``cdc_class`` names the JSON class a change event must carry (None: not checked).
    """

    name: str
    type: str
    required: bool = False
    cdc_required: bool = False
    cdc_class: str | None = None

    @property
    def api_name(self) -> str:
        return "".join(part.capitalize() for part in self.name.split("_"))


def _required(name: str, type_: str = STRING) -> Field:
    return Field(name, type_, True, True, "str")


def _text(name: str) -> Field:
    return Field(name, STRING, cdc_class="str")


def _unchecked(name: str, type_: str = STRING) -> Field:
    return Field(name, type_)


_STAMPS = [
    _required("created_date", TIMESTAMP),
    _required("last_modified_date", TIMESTAMP),
    Field("system_modstamp", TIMESTAMP, required=True),
]


@dataclass(frozen=True)
class CrmObject:
    name: str
    fields: tuple[Field, ...]
    foreign_keys: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ("id",)

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def cdc_required(self) -> list[str]:
        return [f.name for f in self.fields if f.cdc_required]

    @property
    def api_names(self) -> dict[str, str]:
        return {f.name: f.api_name for f in self.fields}


ACCOUNT = CrmObject(
    "Account",
    (
        _required("id"), _required("name"), _text("type"), _text("industry"),
        Field("annual_revenue", NUMERIC, cdc_class="num"), _text("phone"), _text("website"),
        _unchecked("billing_address", JSON), _unchecked("shipping_address", JSON), *_STAMPS,
    ),
    cluster_by=("id", "type"),
)
CONTACT = CrmObject(
    "Contact",
    (
        _required("id"), _text("account_id"), _required("first_name"), _required("last_name"),
        _text("email"), _text("phone"), _text("title"), _unchecked("lead_source"), *_STAMPS,
    ),
    foreign_keys=("account_id",),
    cluster_by=("id", "account_id"),
)
OPPORTUNITY = CrmObject(
    "Opportunity",
    (
        _required("id"), _text("account_id"), _required("name"), _required("stage_name"),
        _unchecked("type"), _unchecked("lead_source"),
        Field("amount", NUMERIC, cdc_class="num"), Field("probability", NUMERIC, cdc_class="num"),
        Field("close_date", DATE, cdc_class="str"),
        Field("is_won", BOOLEAN, cdc_class="bool"), Field("is_closed", BOOLEAN, cdc_class="bool"),
        *_STAMPS,
    ),
    foreign_keys=("account_id",),
    cluster_by=("id", "account_id", "stage_name"),
)
CASE = CrmObject(
    "Case",
    (
        _required("id"), _text("account_id"), _text("contact_id"), _required("subject"),
        _text("description"), _required("status"), _text("origin"), _text("priority"),
        Field("is_escalated", BOOLEAN, cdc_class="bool"), Field("is_closed", BOOLEAN, cdc_class="bool"),
        _unchecked("closed_date", TIMESTAMP), *_STAMPS,
    ),
    foreign_keys=("account_id", "contact_id"),
    cluster_by=("id", "account_id", "status"),
)
HISTORY = CrmObject(
    "History",
    (
        Field("id", STRING, True), Field("valid_from", TIMESTAMP, True), Field("valid_to", TIMESTAMP),
        Field("is_current", BOOLEAN, True), Field("change_type", STRING, True),
        Field("changed_fields", JSON), Field("record_data", JSON, True),
        Field("ingestion_timestamp", TIMESTAMP, True),
    ),
    cluster_by=("id", "valid_from"),
)

OBJECTS: dict[str, CrmObject] = {o.name: o for o in (ACCOUNT, CONTACT, OPPORTUNITY, CASE)}

# (name, type, required) of the columns every ingested batch row carries besides its own.
BATCH_META = (
    ("ingestion_timestamp", TIMESTAMP, True), ("source", STRING, True), ("object_type", STRING, True),
    ("_is_valid", BOOLEAN, True), ("_validation_errors", "ARRAY", False),
    ("_validation_timestamp", TIMESTAMP, True),
)
CDC_META = (
    ("ingestion_timestamp", TIMESTAMP, True), ("source", STRING, True), ("object_type", STRING, True),
    ("_cdc_event_id", STRING, False), ("_cdc_event_type", STRING, False),
    ("_cdc_event_timestamp", TIMESTAMP, False),
)


def _meta_field(name: str, type_: str, required: bool) -> T.StructField:
    spark_type = T.ArrayType(T.StringType()) if type_ == "ARRAY" else SPARK_TYPES[type_]
    return T.StructField(name, spark_type, not required)


def object_schema(name: str) -> T.StructType:
    """Logical schema of one object; an unknown name has no columns of its own."""
    obj = HISTORY if name == "History" else OBJECTS.get(name)
    fields = obj.fields if obj else ()
    return T.StructType([T.StructField(f.name, SPARK_TYPES[f.type], True) for f in fields])


def sink_schema(name: str, meta=BATCH_META) -> T.StructType:
    """Schema at the raw sink: object columns plus ingestion metadata.

    An unknown object falls back to the columns all objects share.
    """
    obj = OBJECTS.get(name)
    own = obj.fields if obj else (OBJECTS["Account"].fields[0], *_STAMPS)
    columns = [T.StructField(f.name, SPARK_TYPES[f.type], f.name != "id") for f in own]
    return T.StructType(columns + [_meta_field(*m) for m in meta])


def to_api_names(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnsRenamed(OBJECTS[name].api_names)


def from_api_names(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnsRenamed({api: own for own, api in OBJECTS[name].api_names.items()})


def describe_object(spark: SparkSession, name: str) -> DataFrame:
    """The object's columns as rows: what a describe call reports."""
    obj = HISTORY if name == "History" else OBJECTS[name]
    rows = [(i, f.name, f.api_name, f.type, f.required) for i, f in enumerate(obj.fields)]
    return spark.createDataFrame(
        rows, "position int, name string, api_name string, type string, required boolean"
    )


def table_path(base: str, object_type: str, kind: str = "raw") -> str:
    """Path of an object's raw or history table below ``base``."""
    tables = {"raw": RAW_TABLES, "history": HISTORY_TABLES}[kind]
    return f"{base.rstrip('/')}/{tables[object_type]}"
