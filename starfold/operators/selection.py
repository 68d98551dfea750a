"""Dataset selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_datasets(inventory: DataFrame, mode: str = "all", codes: list[str] | None = None) -> DataFrame:
    """``all``, ``include`` or ``exclude`` by code, in any case; ``all`` ignores codes."""
    mode = (mode or "all").lower()
    if mode not in ("include", "exclude"):
        return inventory
    listed = F.upper("dataset_code").isin([c.upper() for c in codes or []])
    return inventory.where(listed if mode == "include" else ~listed)
