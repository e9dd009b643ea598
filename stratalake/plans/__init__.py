from stratalake.plans.bronze import (
    LoadAudit, Source, audit_frame, bronze_table, load_batch, load_changed_table, load_event_pages, load_pharmacy_drops, read_bronze,
)
from stratalake.plans.gold import GOLD_TABLES, claims_enriched, member_360, schema_versions
from stratalake.plans.models import build_models
from stratalake.plans.refresh import publish_views, refresh
from stratalake.plans.silver import SILVER_MODELS, SilverModel, build_silver

__all__ = [
    "GOLD_TABLES", "LoadAudit", "SILVER_MODELS", "SilverModel", "Source", "audit_frame", "bronze_table", "build_models", "build_silver",
    "claims_enriched", "load_batch", "load_changed_table", "load_event_pages", "load_pharmacy_drops",
    "member_360", "publish_views", "read_bronze", "refresh", "schema_versions",
]
