"""Table schemas and the per-table load settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SOURCE_FILE = "_source_file"
LOADED_AT = "_loaded_at"

# First watermark, lookbacks and the label for a missing pharmacy.
FIRST_WATERMARK = "2000-01-01T00:00:00"
EVENT_LOOKBACK = "6 hours"
TABLE_LOOKBACK = "5 minutes"
UNKNOWN_PHARMACY = "UNKNOWN"


@dataclass(frozen=True)
class TableSpec:
    """How one source is loaded into its bronze table.

    ``columns`` are the business columns, all strings in bronze. ``order_by``
    and ``newest`` say which of two batch rows with one key is kept.
    ``update_on_match`` makes the load an upsert; otherwise a key that is
    already in bronze is left alone. With ``newer_by`` an upsert keeps a stored
    row whose time there is later. ``watermark_column`` is ``None`` for a source
    that keeps no watermark.
    """

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    order_by: str
    newest: bool = True
    update_on_match: bool = False
    source_name: str | None = None
    watermark_column: str | None = None
    inclusive: bool = False
    lookback: str = TABLE_LOOKBACK
    newer_by: str | None = None

    @property
    def bronze_name(self) -> str:
        return f"bronze_{self.name}"

    @property
    def lineage(self) -> tuple[str, ...]:
        return (SOURCE_FILE, LOADED_AT) if SOURCE_FILE in self.key else (LOADED_AT,)

    @property
    def batch_columns(self) -> tuple[str, ...]:
        """Columns a batch brings: all of bronze but the load time."""
        return self.columns + tuple(c for c in self.lineage if c != LOADED_AT)

    @property
    def bronze_schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType()) for c in self.batch_columns]
        return T.StructType(fields + [T.StructField(LOADED_AT, T.TimestampNTZType())])

    @property
    def source_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# Names of tables, columns, keys and watermark sources.
PHARMACY_CLAIMS = TableSpec(
    name="pharmacy_claims",
    columns=(
        "claim_id", "member_id", "ndc_code", "drug_name", "quantity", "days_supply",
        "fill_time", "ingredient_cost", "copay_amount", "pharmacy_npi",
    ),
    key=("claim_id", SOURCE_FILE),
    order_by="fill_time",
    newest=False,
)

ENROLLMENT_EVENTS = TableSpec(
    name="enrollment_events",
    columns=("event_id", "member_id", "event_type", "plan_code", "event_time", "created_at"),
    key=("event_id",),
    order_by="created_at",
    source_name="enrollment_api",
    watermark_column="event_time",
    inclusive=True,
    lookback=EVENT_LOOKBACK,
)

MEDICAL_CLAIMS = TableSpec(
    name="medical_claims",
    columns=(
        "claim_id", "member_id", "provider_id", "diagnosis_code", "procedure_code", "service_date",
        "billed_amount", "allowed_amount", "claim_status", "created_at", "updated_at",
    ),
    key=("claim_id",),
    order_by="updated_at",
    source_name="sqlserver_medical_claims",
    watermark_column="updated_at",
)

MEMBERS = TableSpec(
    name="members",
    columns=(
        "member_id", "first_name", "last_name", "date_of_birth", "gender", "plan_code",
        "state_code", "effective_date", "created_at", "updated_at",
    ),
    key=("member_id",),
    order_by="updated_at",
    update_on_match=True,
    source_name="sqlserver_members",
    watermark_column="updated_at",
)

PROVIDERS = TableSpec(
    name="providers",
    columns=("provider_id", "provider_name", "npi", "specialty", "state_code", "created_at", "updated_at"),
    key=("provider_id",),
    order_by="updated_at",
    update_on_match=True,
    source_name="sqlserver_providers",
    watermark_column="updated_at",
)

TABLES = {s.name: s for s in (PHARMACY_CLAIMS, ENROLLMENT_EVENTS, MEDICAL_CLAIMS, MEMBERS, PROVIDERS)}

#: The tables pulled from operational databases, in load order.
CHANGED_TABLES = (MEDICAL_CLAIMS, MEMBERS, PROVIDERS)

# Fields of an event page, and the watermark table.
EVENT_PAGE_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(ENROLLMENT_EVENTS.source_schema)),
    T.StructField("count", T.LongType()),
    T.StructField("total_matched", T.LongType()),
    T.StructField("next_cursor", T.LongType()),
])

WATERMARK_TABLE = "ingestion_watermarks"
WATERMARK_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("last_watermark", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
