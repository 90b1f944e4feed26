"""Reports over the cleaned table: prepare it, narrow it down, then aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import aggregate as agg
from ..operators.filters import facet_filter, quality_filter
from ..operators.impute import FLAG_IMPUTED, FLAG_NON_IMPUTABLE
from ..operators.repair import ensure_columns
from ..sources.staging import stage
from .sales import prepare_sales

_READ = ["Make", "Body", "SellingPrice", "Odometer", "PriceDiff", "AboveMMR", "VehicleAge", FLAG_IMPUTED, FLAG_NON_IMPUTABLE]


def dashboard_table(cleaned: DataFrame, kinds: list[str] | None = None, **facets) -> DataFrame:
    """The rows the reports look at, with the columns they read, written once.

    `facets` are those of `facet_filter`, `kinds` those of `quality_filter`. A table without
    quality flags counts as clean.
    """
    flags = {FLAG_IMPUTED: False, FLAG_NON_IMPUTABLE: False}
    wanted = [*_READ, "State", "Transmission", "Year"]
    prepared = facet_filter(prepare_sales(ensure_columns(cleaned, flags), columns=wanted), **facets)
    return stage(quality_filter(prepared, kinds).select(*_READ), "dashboard")


def kpis(table: DataFrame) -> DataFrame:
    return agg.sales_kpis(table)


def heatmap(table: DataFrame) -> DataFrame:
    return agg.heatmap(table)


def quality(table: DataFrame) -> DataFrame:
    return agg.quality_median(table)
