"""Silver tables: typed and one row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.functions import safe_date, safe_decimal, safe_int, safe_timestamp
from stratalake.operators import latest_by

Parse = Callable[[str], Column]

claim_amount: Parse = partial(safe_decimal, precision=12, scale=2)
drug_amount: Parse = partial(safe_decimal, precision=10, scale=2)


def _npi(column: str) -> Column:
    """Rows from before the column existed get a label."""
    return F.coalesce(F.col(column), F.lit(S.UNKNOWN_PHARMACY))


@dataclass(frozen=True)
class SilverModel:
    """A bronze table, how its text columns are parsed, and which row of a key is newest."""

    bronze: S.TableSpec
    key: str
    newest_by: str
    parse: Mapping[str, Parse] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"silver_{self.bronze.name}"

    @property
    def same_key(self) -> bool:
        """Whether bronze has one row per key of silver already, but for NULL keys, of which each load may add one."""
        return self.bronze.key == (self.key,)


SILVER_MODELS = {
    m.name: m
    for m in (
        SilverModel(
            S.PHARMACY_CLAIMS, "claim_id", S.LOADED_AT,
            {
                "quantity": safe_int, "days_supply": safe_int, "fill_time": safe_timestamp,
                "ingredient_cost": drug_amount, "copay_amount": drug_amount, "pharmacy_npi": _npi,
            },
        ),
        SilverModel(
            S.ENROLLMENT_EVENTS, "event_id", "created_at",
            {"event_time": safe_timestamp, "created_at": safe_timestamp},
        ),
        SilverModel(
            S.MEDICAL_CLAIMS, "claim_id", "updated_at",
            {
                "service_date": safe_date, "billed_amount": claim_amount, "allowed_amount": claim_amount,
                "created_at": safe_timestamp, "updated_at": safe_timestamp,
            },
        ),
        SilverModel(
            S.MEMBERS, "member_id", "updated_at",
            {
                "date_of_birth": safe_date, "effective_date": safe_date,
                "created_at": safe_timestamp, "updated_at": safe_timestamp,
            },
        ),
        SilverModel(
            S.PROVIDERS, "provider_id", "updated_at",
            {"created_at": safe_timestamp, "updated_at": safe_timestamp},
        ),
    )
}


def typed(model: SilverModel, bronze: DataFrame, also: str | None = None) -> DataFrame:
    """The bronze rows with their text parsed; ``also`` is a further column to keep."""
    return bronze.select(*[
        model.parse[c](c).alias(c) if c in model.parse else F.col(c)
        for c in (*model.bronze.batch_columns, S.LOADED_AT, *([also] if also else []))
    ])


def build_silver(model: SilverModel | str, bronze: DataFrame, together: str | None = None) -> DataFrame:
    """Parse the bronze text and keep the newest row of each key.

    ``together`` names a further column of the bronze rows for ``latest_by``.
    """
    if isinstance(model, str):
        model = SILVER_MODELS[model]
    return latest_by(typed(model, bronze, together), [model.key], model.newest_by, together=together)


def silver_of_loads(model: SilverModel, bronze: DataFrame) -> DataFrame:
    """``build_silver`` of rows that loads have merged into bronze: rows whose key is the only one there are not shuffled."""
    if not model.same_key:
        return build_silver(model, bronze)
    known = F.col(model.key).isNotNull()
    return typed(model, bronze.where(known)).unionByName(build_silver(model, bronze.where(~known)))


def add_to_silver(model: SilverModel, silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """Silver rows with more bronze rows added: the newest of old and new is the newest of all."""
    return latest_by(silver.unionByName(typed(model, bronze)), [model.key], model.newest_by)
