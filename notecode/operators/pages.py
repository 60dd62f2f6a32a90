"""The application's pages: one function each, which gives the frames a page shows by name.

A page is a selection of the serving and quality queries over one set of tables; nothing is
computed until a frame is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import merge, quality, sections, serving


@dataclass
class Tables:
    """``icd`` and ``loinc`` are mappings, ``icd_codes`` and ``loinc_codes`` the codes with their names (see ``serving``)."""

    charts: DataFrame
    sections: DataFrame
    merged: DataFrame
    assertions: DataFrame
    icd: DataFrame
    loinc: DataFrame
    icd_codes: DataFrame
    loinc_codes: DataFrame
    metrics: DataFrame
    patterns: DataFrame

    @property
    def mappings(self) -> DataFrame:
        return serving.both_systems(self.icd, self.loinc)

    @property
    def named(self) -> DataFrame:
        """Entities with a text, which is what a page can show of them."""
        return self.merged.where("entity_text is not null")


def pipeline_overview(t: Tables) -> dict[str, DataFrame]:
    category = merge.source_category(F.col("sources")).alias("category")
    return {
        "kpis": serving.stats(t.charts, t.merged, t.icd, t.loinc), "entity_distribution": serving.entity_types(t.merged), "confidence": serving.confidence_bands(t.mappings), "resolution": serving.resolution_overview(t.mappings),
        "charts_per_day": serving.charts_per_day(t.mappings), "source_categories": t.merged.groupBy(category).agg(F.count("*").alias("n")), "assertions": quality.assertion_kpis(t.assertions), "sections": sections.section_distribution(t.sections),
    }


def review_queue(t: Tables, code_type: str | None = None, status: str | None = None, page: int = 1, page_size: int = 50) -> dict[str, DataFrame]:
    items = serving.review_items(t.mappings, t.named, t.icd_codes, t.loinc_codes, t.charts, code_type, status, page, page_size)
    return {"items": serving.queue_enrichment(items, t.assertions, t.merged), "audit_trail": serving.audit_trail(items), "counts": serving.badge_counts(t.mappings)}


def review_item(t: Tables, mapping_id: str) -> dict[str, DataFrame]:
    return {"item": serving.review_item(mapping_id, t.icd, t.loinc, t.named, t.icd_codes, t.loinc_codes, t.charts)}


def icd10_analytics(t: Tables) -> dict[str, DataFrame]:
    coded = t.icd.withColumn("code_type", F.lit("ICD-10"))
    return {"top_codes": serving.top_codes(coded), "specificity": serving.specificity_split(coded), "recent_mappings": serving.recent_codes(t.icd, t.named, t.icd_codes, "ICD-10")}


def loinc_analytics(t: Tables) -> dict[str, DataFrame]:
    return {"top_codes": serving.top_loinc(t.loinc, t.loinc_codes), "recent_mappings": serving.recent_codes(t.loinc, t.named, t.loinc_codes, "LOINC"), "disambiguation": serving.loinc_disambiguation(t.loinc, t.loinc_codes)}


def chart_lineage(t: Tables, chart_id: str) -> dict[str, DataFrame]:
    return serving.chart_lineage(chart_id, t.charts, t.sections, t.merged, t.mappings)


def pipeline_extended(t: Tables) -> dict[str, DataFrame]:
    return {
        "top_entities": serving.top_entities(t.merged), "providers": serving.providers(t.charts, t.merged), "facilities": serving.facilities(t.charts), "timeline": serving.timeline(t.charts),
        "resolution_summary": serving.resolution_overview(t.mappings), "confidence_histogram": serving.confidence_histogram(t.mappings),
    }


def icd10_extended(t: Tables) -> dict[str, DataFrame]:
    coded = t.icd.withColumn("code_type", F.lit("ICD-10"))
    return {"chapter_distribution": serving.chapter_distribution(coded), "resolution": quality.resolution_paths(t.icd), "top_disputed": serving.low_confidence(t.icd), "confidence_spread": serving.confidence_spread(t.icd)}


def loinc_extended(t: Tables) -> dict[str, DataFrame]:
    of = lambda *a: serving.loinc_distribution(t.loinc, t.loinc_codes, *a)
    return {
        "class_distribution": of("component", None, "Unknown", 15), "method_distribution": of("method", "method", "Not specified", 10), "specimen_distribution": of("system", "specimen_type", "Not specified", 10),
        "resolution": quality.resolution_paths(t.loinc), "top_disputed": serving.low_confidence(t.loinc),
    }


def extraction_layers(t: Tables) -> dict[str, DataFrame]:
    return {"source_categories": quality.source_categories(t.merged), "totals_per_source": quality.totals_per_source(t.merged), "type_by_source": quality.layer_by_type(t.merged)}


def assertions(t: Tables) -> dict[str, DataFrame]:
    shares = {f"{c}_distribution": quality.assertion_shares(t.assertions, c) for c in ("assertion_status", "experiencer", "temporality")}
    return {**shares, "negation_by_section": quality.negation_by_section(t.assertions, t.merged, t.sections), "kpis": quality.assertion_kpis(t.assertions)}


def recall_metrics(t: Tables) -> dict[str, DataFrame]:
    return {"metrics": serving.latest_metrics(t.metrics)}


def error_patterns(t: Tables) -> dict[str, DataFrame]:
    return {"patterns": quality.open_patterns(t.patterns)}


def coding_tiers(t: Tables) -> dict[str, DataFrame]:
    return {"tiers": quality.resolution_paths(t.icd), "shares": serving.tier_shares(t.icd)}
