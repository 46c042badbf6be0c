"""Column names and orders of extraction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Older and longer headings and the names in use.
OLD_NAMES = {
    "state": "facility_state_abbreviation", "zip": "facility_zip_code", "city": "facility_city", "county": "facility_county", "address": "facility_address",
    "facility": "facility_name", "owner": "owner_operator_name", "naics": "naics_code", "sic": "sic_code", "unit": "unit_id", "description": "unit_description",
    "make": "unit_make", "model": "unit_model", "fuel": "fuel_type", "capacity": "capacity_value",
}


def renamed(df: DataFrame, names: dict[str, str] = OLD_NAMES) -> DataFrame:
    """Columns under their names in use; a name that is there already stays and the older column is left out."""
    drop = [o for o, n in names.items() if o in df.columns and n in df.columns]
    return df.drop(*drop).withColumnsRenamed({o: n for o, n in names.items() if o not in drop})


def aligned(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns in order, those absent as null text, all others after them."""
    extra = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns], *extra)


def inserted_after(df: DataFrame, anchor: str, new: dict) -> DataFrame:
    """New columns behind ``anchor``, in order; an error if one is there already or the anchor is not."""
    there = [c for c in new if c in df.columns]
    if there or anchor not in df.columns:
        raise ValueError(f"columns are there already: {there}" if there else f"no column {anchor}")
    i = df.columns.index(anchor) + 1
    return df.select(*df.columns[:i], *[c.alias(n) for n, c in new.items()], *df.columns[i:])
