"""Quality reports over merged entities, assertions, mappings and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.clinical import bins, is_specific


def layer_venn(merged: DataFrame) -> DataFrame:
    """Entities by which layers found them."""
    has = lambda s: F.coalesce(F.array_contains("sources", s), F.lit(False)).alias(f"in_{s}")
    return merged.groupBy(has("dictionary"), has("ner"), has("llm")).agg(F.count("*").alias("n_entities"), F.round(F.round(F.avg("ensemble_confidence"), 10), 4).alias("avg_confidence"))


def _has(layer: str) -> Column:
    return F.coalesce(F.array_contains("sources", layer), F.lit(False))


def _avg(column: Column | str, digits: int = 4) -> Column:
    return F.round(F.round(F.avg(column), 10), digits)


LAYERS = {"dict": "dictionary", "ner": "ner", "llm": "llm"}


def layer_contribution(merged: DataFrame) -> DataFrame:
    """One row: how many entities each layer found, alone and with others, and the confidence by number of layers."""
    d, n, m = _has("dictionary"), _has("ner"), _has("llm")
    k = F.size(F.array_distinct("sources"))
    return merged.agg(
        F.count("*").alias("total_entities"), *[F.count_if(_has(v)).alias(f"{a}_found") for a, v in LAYERS.items()],
        F.count_if(d & ~n & ~m).alias("dict_unique"), F.count_if(n & ~d & ~m).alias("ner_unique"), F.count_if(m & ~d & ~n).alias("llm_unique"),
        F.count_if(d & n & m).alias("all_three"), F.count_if(d & n & ~m).alias("dict_and_ner_only"), F.count_if(d & m & ~n).alias("dict_and_llm_only"), F.count_if(n & m & ~d).alias("ner_and_llm_only"),
        *[_avg(F.when(k == i, F.col("ensemble_confidence")), 6).alias(f"avg_conf_{name}") for i, name in ((1, "single_source"), (2, "two_sources"), (3, "three_sources"))],
    )


def layer_by_type(merged: DataFrame) -> DataFrame:
    d, n, m = _has("dictionary"), _has("ner"), _has("llm")
    alone = {"dict": d & ~n & ~m, "ner": n & ~d & ~m, "llm": m & ~d & ~n}
    return merged.groupBy("entity_type").agg(F.count("*").alias("total"), *[F.count_if(_has(v)).alias(f"{a}_found") for a, v in LAYERS.items()], *[F.count_if(c).alias(f"{a}_unique") for a, c in alone.items()], F.count_if(F.size("sources") >= 2).alias("multi_source"), _avg("ensemble_confidence").alias("avg_confidence"))


def totals_per_source(merged: DataFrame) -> DataFrame:
    """(source, total, unique_count): entities each layer found, and found alone; one pass over the entities."""
    each = merged.select(F.size("sources").alias("k"), F.explode(F.array_distinct("sources")).alias("source"))
    return each.where(F.col("source").isin(*LAYERS.values())).groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("k") == 1).alias("unique_count"))


def source_categories(merged: DataFrame) -> DataFrame:
    kind = F.when(_has("dictionary") & _has("llm"), "both").when(_has("dictionary"), "dictionary_only").when(_has("llm"), "llm_only").otherwise("other")
    return merged.groupBy(kind.alias("source_category")).agg(F.count("*").alias("entity_count"), _avg("ensemble_confidence", 3).alias("avg_confidence"))


def _section_types(sections: DataFrame) -> DataFrame:
    """Sections count once per id."""
    return sections.groupBy("section_id").agg(F.min("section_type").alias("section_type"))


def section_quality(merged: DataFrame, sections: DataFrame) -> DataFrame:
    """Entities, layers, charts and confidence by section type."""
    ids = lambda when: F.countDistinct(F.when(when, F.col("entity_id")))
    g = merged.join(_section_types(sections), "section_id").groupBy("section_type").agg(
        F.countDistinct("entity_id").alias("entities_found"), _avg("ensemble_confidence").alias("avg_confidence"), *[ids(_has(v)).alias(f"{a}_found") for a, v in LAYERS.items()],
        F.countDistinct("chart_id").alias("charts_with_section"), F.count_if(F.col("ensemble_confidence") < 0.7).alias("low_confidence"),
    )
    return g.withColumn("entities_per_chart", F.round(F.col("entities_found") / F.nullif(F.col("charts_with_section"), F.lit(0)), 2))


def confidence_by_section(merged: DataFrame, sections: DataFrame) -> DataFrame:
    band = bins(F.col("ensemble_confidence"), [(0.9, "high (>=0.9)"), (0.7, "medium (0.7-0.9)"), (0.5, "low (0.5-0.7)")], "very_low (<0.5)")
    return merged.join(_section_types(sections), "section_id").groupBy("section_type", band.alias("confidence_bin")).agg(F.count("*").alias("entity_count"))


def note_density(charts: DataFrame, merged: DataFrame) -> DataFrame:
    """Charts by entities per 1,000 characters of their note; a word is taken for five characters."""
    length = charts.groupBy("chart_id").agg(F.max(F.length("raw_text")).alias("chars")).where("chars > 0")
    n = merged.groupBy("chart_id").agg(F.count("entity_id").alias("n"), F.round(F.avg("ensemble_confidence"), 10).alias("c"))
    rows = length.join(n, "chart_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    edges = [(20, "5. very_high (20+/1k chars)"), (10, "4. high (10-20/1k chars)"), (5, "3. medium (5-10/1k chars)"), (2, "2. low (2-5/1k chars)")]
    band = bins(F.col("n") / (F.col("chars") / 1000.0), edges, "1. sparse (<2/1k chars)")
    return rows.groupBy(band.alias("density_bin")).agg(F.count("*").alias("chart_count"), _avg("n", 1).alias("avg_entities"), _avg("c").alias("avg_confidence"), _avg(F.col("chars") / 5.0, 0).alias("avg_word_count"), F.round(F.min("c"), 4).alias("min_confidence"), F.round(F.max("c"), 4).alias("max_confidence"))


def assertion_distribution(assertions: DataFrame) -> DataFrame:
    g = assertions.groupBy("assertion_status", "negation_detected", "temporality", "experiencer", "certainty").agg(F.count("*").alias("entity_count"), _avg("confidence").alias("avg_confidence"))
    return g.withColumn("pct", F.round(F.lit(100.0) * F.col("entity_count") / F.sum("entity_count").over(W.partitionBy()), 2))


def assertion_shares(assertions: DataFrame, column: str) -> DataFrame:
    """(name, count, pct) of one field of the assertions; null is UNKNOWN."""
    g = assertions.groupBy(F.coalesce(column, F.lit("UNKNOWN")).alias("name")).agg(F.count("*").alias("count"))
    return g.withColumn("pct", F.round(F.lit(100.0) * F.col("count") / F.sum("count").over(W.partitionBy()), 1))


def assertion_kpis(assertions: DataFrame) -> DataFrame:
    """One row: assertions in all, and the shares of absent, past and family ones."""
    share = lambda status: F.round(F.count_if(F.col("assertion_status") == status) * 100.0 / F.nullif(F.count("*"), F.lit(0)), 1)
    return assertions.agg(F.count("*").alias("total_classified"), share("ABSENT").alias("negated_pct"), share("HISTORICAL").alias("historical_pct"), share("FAMILY").alias("family_pct"))


def negation_by_section(assertions: DataFrame, entities: DataFrame, sections: DataFrame) -> DataFrame:
    """Assertions by the section of their entity; entities without a known section are UNKNOWN."""
    e = entities.where("section_id is not null").groupBy("entity_id").agg(F.min("section_id").alias("section_id"))
    g = assertions.join(e, "entity_id", "left").join(_section_types(sections), "section_id", "left").groupBy(F.coalesce("section_type", F.lit("UNKNOWN")).alias("section_type"))
    out = g.agg(F.count("*").alias("total_assertions"), F.count_if("negation_detected").alias("negated_count"), _avg(F.when(F.col("negation_detected"), F.col("confidence"))).alias("avg_negation_confidence"))
    return out.withColumn("negation_rate_pct", F.round(F.col("negated_count") * 100.0 / F.nullif(F.col("total_assertions"), F.lit(0)), 2))


def mapping_quality(mappings: DataFrame, code_type: str) -> DataFrame:
    """One row per code system: how much is mapped, to how many codes, how surely and by which path."""
    path = lambda p, name: F.count_if(F.col("resolution_path") == p).alias(name)
    out = mappings.agg(F.count("*").alias("total_mappings"), F.count("code").alias("mapped_count"), F.countDistinct("code").alias("unique_codes_assigned"), _avg("confidence").alias("avg_confidence"), path("ONTOLOGY_DIRECT", "via_ontology"), path("LLM_ASSIGNED", "via_llm"), path("R1_R2_AGREE", "via_multipass"))
    return out.select(F.lit(code_type).alias("code_type"), "*", F.round(F.col("mapped_count") * 100.0 / F.nullif(F.col("total_mappings"), F.lit(0)), 2).alias("mapping_success_pct"))


def resolution_paths(mappings: DataFrame) -> DataFrame:
    """Mappings of one system by the path that resolved them."""
    c = F.col("confidence")
    return mappings.groupBy("resolution_path").agg(F.count("*").alias("count"), _avg(c, 3).alias("avg_confidence"), F.round(F.min(c), 3).alias("min_confidence"), F.round(F.max(c), 3).alias("max_confidence"), F.count_if(is_specific(F.col("code"))).alias("specific_count"))


def tier_totals(icd: DataFrame, loinc: DataFrame) -> DataFrame:
    """One row: codes of both systems by ontology and by model, and the shares of the two."""
    named = {"ONTOLOGY_DIRECT": "tier1", "LLM_ASSIGNED": "tier2"}
    both = icd.select("resolution_path", F.lit("icd10").alias("s")).unionByName(loinc.select("resolution_path", F.lit("loinc").alias("s")))
    out = both.agg(*[F.count_if((F.col("resolution_path") == p) & (F.col("s") == system)).alias(f"{tier}_{system}") for p, tier in named.items() for system in ("icd10", "loinc")])
    total = lambda tier: F.col(f"{tier}_icd10") + F.col(f"{tier}_loinc")
    coded = F.greatest(total("tier1") + total("tier2"), F.lit(1))
    return out.withColumns({f"{t}_pct": F.round(total(t) * 100.0 / coded, 1) for t in ("tier1", "tier2")})


def specificity_levels(mappings: DataFrame, code: str = "code") -> DataFrame:
    """Codes by the level of detail their length (with the dot) stands for."""
    n = F.length(code)
    level = F.when(n <= 4, "category (3-4 char)").when(n <= 5, "subcategory (5 char)").when(n <= 6, "specific (6 char)").otherwise("most_specific (7+ char)")
    g = mappings.where(F.col(code).isNotNull()).groupBy(level.alias("specificity_level")).agg(F.count("*").alias("code_count"), F.round(F.round(F.avg("confidence"), 10), 4).alias("avg_confidence"))
    return g.withColumn("pct_of_total", F.round(F.col("code_count") * 100.0 / F.sum("code_count").over(W.partitionBy()), 2))


def code_validity(mappings: dict[str, DataFrame], references: dict[str, DataFrame]) -> DataFrame:
    """One row per code system: how many assigned codes its reference has."""

    def arm(system: str) -> DataFrame:
        known = references[system].select(F.col("code").alias("_ref")).distinct()
        j = mappings[system].where("code is not null").join(known, F.col("code") == F.col("_ref"), "left")
        out = j.agg(F.count("*").alias("total_assigned"), F.count("_ref").alias("valid_codes"))
        out = out.withColumn("invalid_codes", F.col("total_assigned") - F.col("valid_codes"))
        return out.select(F.lit(system).alias("code_system"), "*", F.round(F.col("valid_codes") * 100.0 / F.nullif(F.col("total_assigned"), F.lit(0)), 2).alias("validity_pct"))

    return reduce(DataFrame.unionByName, map(arm, mappings))


def code_quality(mappings: DataFrame) -> DataFrame:
    """One row per code type: conditional counts of confidence and resolution."""
    c = F.col("confidence")
    return mappings.groupBy("code_type").agg(F.count("*").alias("total"), F.count_if(c >= 0.9).alias("high"), F.count_if((c >= 0.7) & (c < 0.9)).alias("medium"), F.count_if(c < 0.7).alias("low"), F.count_if(F.col("resolution_path") == "ONTOLOGY_DIRECT").alias("direct"), F.countDistinct("code").alias("n_codes"), F.round(F.avg("confidence"), 4).alias("avg_confidence"))


def multipass_agreement(validation: DataFrame) -> DataFrame:
    """Reviews of each round and role by their result."""
    named = [F.count_if(F.col("validation_result") == r).alias(r) for r in ("approved", "rejected", "modified")]
    g = validation.groupBy("validation_round", "validation_role").agg(F.count("*").alias("total_reviews"), *named)
    return g.withColumn("approval_rate_pct", F.round(F.col("approved") * 100.0 / F.nullif(F.col("total_reviews"), F.lit(0)), 2))


def executive_summary(charts: DataFrame, merged: DataFrame, assertions: DataFrame, icd: DataFrame, loinc: DataFrame, metrics: DataFrame, patterns: DataFrame) -> DataFrame:
    """One row over all tables; a metric without rows is null, and so are the parts of missing tables if they are given empty."""
    share = lambda condition, total, digits=1: F.round(F.count_if(condition) * 100.0 / F.nullif(total, F.lit(0)), digits)
    n = F.count("*")
    parts = [
        charts.agg(n.alias("charts_processed")),
        merged.agg(n.alias("total_entities"), *[share(F.coalesce(F.array_contains("sources", k), F.lit(False)), n).alias(f"{a}_pct") for k, a in (("dictionary", "dict"), ("ner", "ner"), ("llm", "llm"))], F.round(F.round(F.avg("ensemble_confidence"), 10) * 100, 1).alias("overall_confidence_pct")),
        assertions.agg(share(F.col("negation_detected"), n).alias("negated_pct"), share(F.col("temporality") == "HISTORICAL", n).alias("historical_pct"), share(F.col("experiencer") == "FAMILY_MEMBER", n).alias("family_pct")),
        icd.where("code is not null").agg(F.countDistinct("code").alias("icd10_count")),
        loinc.where("code is not null").agg(F.countDistinct("code").alias("loinc_count")),
        metrics.where("metric_scope = 'overall'").agg(F.max(F.struct("run_timestamp", "run_id", "recall_score")).alias("_m")).select(F.col("_m.recall_score").alias("latest_recall")),
        top_open_patterns(patterns, 5).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "pattern_type", "pattern_id", "severity"))), lambda p: F.concat(p["pattern_type"], F.lit(" ("), p["severity"], F.lit(")"))), "; ").alias("top_errors")),
    ]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "HIGH", 1).when(severity == "MEDIUM", 2).otherwise(3)


def open_patterns(patterns: DataFrame) -> DataFrame:
    """Unresolved patterns, the gravest first."""
    return patterns.where("resolved_at is null").orderBy(severity_rank(F.col("severity")), "pattern_id")


def top_open_patterns(patterns: DataFrame, k: int) -> DataFrame:
    return patterns.where("resolved_at is null").withColumn("rank", severity_rank(F.col("severity"))).orderBy("rank", "pattern_type", "pattern_id").limit(k)


def quality_trend(metrics: DataFrame) -> DataFrame:
    """Daily averages and sums of each metric scope and value."""
    mean = lambda c: F.round(F.avg(f"{c}_score"), 6).alias(f"avg_{c}")
    return metrics.groupBy(F.to_date("run_timestamp").alias("run_date"), "metric_scope", "scope_value").agg(mean("recall"), mean("precision"), mean("f1"), F.sum("true_positives").alias("total_tp"), F.sum("false_negatives").alias("total_fn"))
