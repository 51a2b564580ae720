"""The models and datasets tables, each one lazy plan without a shuffle."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from hubcat import spec
from hubcat.functions.sizes import size_bucket, size_expression
from hubcat.functions.text import organization_of_id, quoted
from hubcat.operators.conform import conform, finalise
from hubcat.operators.flags import with_flags, with_normal_tags


def models_table(raw: DataFrame, downloaded_at, catalog: spec.CatalogSpec = spec.MODELS,
                 keyword_map=None) -> DataFrame:
    """Raw model rows to the finished models table."""
    # A ready-made size column has to come along from the raw rows.
    source = _with_params(catalog) if "params" in raw.columns else catalog
    sized = conform(raw, source, downloaded_at)
    sized = sized.withColumn("params", size_expression(sized.schema))
    enriched = sized.withColumns({
        "organization": organization_of_id(F.col(catalog.key)),
        "size_category": size_bucket(F.col("params")),
    })
    flagged = with_flags(with_normal_tags(enriched), keyword_map or spec.MODEL_FLAGS,
                         task_column="pipeline_tag")
    return finalise(flagged, catalog)


def _with_params(catalog: spec.CatalogSpec) -> spec.CatalogSpec:
    return replace(catalog, source=(*catalog.source, "params"), other=(*catalog.other, "params"))


def datasets_table(raw: DataFrame, downloaded_at, catalog: spec.CatalogSpec = spec.DATASETS,
                   keyword_map=None) -> DataFrame:
    """Raw dataset rows to the finished datasets table: no sizes, no task column."""
    enriched = conform(raw, catalog, downloaded_at).withColumn(
        "organization", organization_of_id(quoted(catalog.key)))
    return finalise(
        with_flags(with_normal_tags(enriched), keyword_map or spec.DATASET_FLAGS), catalog)
