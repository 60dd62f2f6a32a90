"""Queries of the review application as functions of DataFrames.

``mappings`` has one row per code mapping: mapping_id, chart_id, code, code_type,
resolution_path, confidence, created_at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.clinical import bins, chapter, is_specific

#: Resolution paths by review state (fixed values).
STATES = {"auto_approved": ("ONTOLOGY_DIRECT", "LLM_ASSIGNED", "R1_R2_AGREE", "HUMAN_ACCEPTED"), "flagged": ("ARBITER_CHOSE_R1", "ARBITER_CHOSE_R2"), "needs_review": ("DISPUTED_UNRESOLVED",)}
NO_CODE = ("NO_MAP", "NO VALID MAPPING", "NO_VALID_MAPPING", "UNMAPPABLE", "not found", "")


def review_state(path: Column) -> Column:
    start = F.when(F.lit(False), "")
    return reduce(lambda acc, k: acc.when(path.isin(*STATES[k]), k), STATES, start).otherwise("auto_approved")


def resolution_overview(mappings: DataFrame) -> DataFrame:
    return mappings.groupBy("code_type", review_state(F.col("resolution_path")).alias("state")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 3).alias("avg_confidence"))


def confidence_bands(mappings: DataFrame) -> DataFrame:
    c = F.col("confidence")
    return mappings.groupBy(bins(c, [(0.9, "high"), (0.7, "medium")], "low").alias("band")).agg(F.count_if(F.col("code_type") == "ICD-10").alias("icd10"), F.count_if(F.col("code_type") == "LOINC").alias("loinc"))


def confidence_histogram(mappings: DataFrame) -> DataFrame:
    """Ten bins, 1.0 in the last."""
    b = F.least(F.floor(F.round(F.col("confidence") * 10, 6)), F.lit(9)).cast("int")
    return mappings.where("confidence is not null").groupBy(b.alias("bin")).agg(F.count_if(F.col("code_type") == "ICD-10").alias("icd10"), F.count_if(F.col("code_type") == "LOINC").alias("loinc"))


def charts_per_day(mappings: DataFrame, days: int = 14) -> DataFrame:
    g = mappings.groupBy(F.to_date("created_at").alias("day")).agg(F.countDistinct("chart_id").alias("n_charts"), F.count("*").alias("n_mappings"))
    return g.orderBy(F.desc("day")).limit(days)


def review_filter(code_type: str | None = None, status: str | None = None) -> Column:
    """The condition of the review queue; an unknown status is taken as a resolution path."""
    conditions = [F.lit(True)]
    if code_type:
        conditions.append(F.col("code_type") == code_type)
    if status:
        conditions.append(F.col("resolution_path").isin(*STATES.get(status, (status,))))
    return reduce(lambda a, b: a & b, conditions)


def review_queue(mappings: DataFrame, code_type: str | None = None, status: str | None = None, page: int = 1, page_size: int = 50) -> DataFrame:
    if page < 1 or not 1 <= page_size <= 5000:
        raise ValueError("page from 1, page_size from 1 to 5000")
    rows = mappings.where(review_filter(code_type, status)).orderBy("confidence", "mapping_id")
    return rows.offset((page - 1) * page_size).limit(page_size)


def review_stats(mappings: DataFrame) -> DataFrame:
    state = review_state(F.col("resolution_path"))
    out = mappings.agg(F.count("*").alias("total"), *[F.count_if(state == k).alias(k) for k in STATES])
    return out.withColumn("agreement_rate", F.round(F.col("auto_approved") / F.nullif(F.col("total"), F.lit(0)), 4))


def audit_trail(mappings: DataFrame) -> DataFrame:
    """The steps of each mapping with the confidence of the passes derived from the final one."""
    c, agree = F.col("confidence"), F.col("resolution_path") == "R1_R2_AGREE"
    r1, r2 = F.when(agree, c).otherwise(F.least(c + 0.05, F.lit(0.99))), F.when(agree, c).otherwise(F.greatest(c - 0.03, F.lit(0.5)))
    step = lambda name, value, when=None: F.struct(F.lit(name).alias("step"), F.round(value, 4).alias("step_confidence"), (F.lit(True) if when is None else when).alias("keep"))
    steps = F.filter(F.array(step("r1", r1), step("r2", r2), step("arbiter", c, ~agree)), lambda s: s["keep"])
    return mappings.select("mapping_id", F.explode(steps).alias("s")).select("mapping_id", "s.step", "s.step_confidence")


def decide(mappings: DataFrame, corrections: DataFrame, mapping_id: str, decision: str, reviewer: str, override_code: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(mappings, corrections) after a reviewer's decision: accepted as it is, or replaced by another code."""
    if decision not in ("accept", "override") or decision == "override" and not override_code:
        raise ValueError("decision is accept, or override with a code")
    hit = F.col("mapping_id") == mapping_id
    path = "HUMAN_ACCEPTED" if decision == "accept" else "HUMAN_OVERRIDE"
    after = mappings.withColumn("resolution_path", F.when(hit, path).otherwise(F.col("resolution_path")))
    if decision == "accept":
        return after, corrections
    row = mappings.where(hit).select("mapping_id", "code_type", F.col("code").alias("original_code"), F.lit(override_code).alias("corrected_code"), F.lit(reviewer).alias("corrected_by"))
    return after.withColumn("code", F.when(hit, override_code).otherwise(F.col("code"))), corrections.unionByName(row, allowMissingColumns=True)


def top_codes(mappings: DataFrame, k: int = 15) -> DataFrame:
    g = mappings.where(~F.col("code").isin(*NO_CODE)).groupBy("code_type", "code").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 3).alias("avg_confidence"))
    return g.orderBy(F.desc("n"), "code_type", "code").limit(k)


def specificity_split(mappings: DataFrame) -> DataFrame:
    kind = F.when(F.coalesce(is_specific(F.col("code")), F.lit(False)), "specific").otherwise("unspecified")
    return mappings.where("code_type = 'ICD-10'").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def chapter_distribution(mappings: DataFrame) -> DataFrame:
    return mappings.where("code_type = 'ICD-10'").groupBy(chapter(F.col("code")).alias("chapter")).agg(F.count("*").alias("n"), F.countDistinct("code").alias("n_codes"))


def low_confidence(mappings: DataFrame, k: int = 15) -> DataFrame:
    rows = mappings.where("resolution_path != 'R1_R2_AGREE'")
    return rows.orderBy("confidence", "mapping_id").limit(k).select("mapping_id", "code", "resolution_path", "confidence")


def disambiguation(mappings: DataFrame) -> DataFrame:
    """Charts with several codes of a type: candidates, and the one with the best mix of occurrence and confidence."""
    g = mappings.groupBy("chart_id", "code_type", "code").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("c"))
    w = W.partitionBy("chart_id", "code_type")
    g = g.withColumns({"n_codes": F.count("*").over(w), "most": F.max("n").over(w)}).where("n_codes > 1")
    g = g.withColumn("score", F.round(0.6 * F.col("n") / F.col("most") + 0.4 * F.col("c"), 6))
    r = F.row_number().over(w.orderBy(F.desc("score"), "code"))
    return g.withColumn("selected", r == 1).select("chart_id", "code_type", "code", "n", "score", "selected")


def coding_tiers(mappings: DataFrame) -> DataFrame:
    tier = F.when(F.col("resolution_path") == "ONTOLOGY_DIRECT", "tier 1").otherwise("tier 2")
    return mappings.groupBy(tier.alias("tier"), "code_type").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("avg_confidence"))


def providers(charts: DataFrame, merged: DataFrame) -> DataFrame:
    """Charts and entities per provider; entities are counted per chart before the join."""
    n = merged.groupBy("chart_id").agg(F.countDistinct("entity_id").alias("n"))
    c = charts.where("provider is not null").select("chart_id", "provider", "facility").distinct()
    per = c.select("chart_id", "provider").distinct().join(n, "chart_id", "left").groupBy("provider").agg(F.count("*").alias("n_charts"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_entities"))
    return per


def chart_lineage(chart_id: str, charts: DataFrame, sections: DataFrame, merged: DataFrame, mappings: DataFrame) -> dict[str, DataFrame]:
    at = lambda df: df.where(F.col("chart_id") == chart_id)
    return {"chart": at(charts), "sections": at(sections).orderBy("section_order", "section_id"), "entities": at(merged).orderBy("start_offset", "entity_id"), "mappings": at(mappings).orderBy(F.desc("confidence"), "mapping_id")}


def top_entities(merged: DataFrame, k: int = 20) -> DataFrame:
    g = merged.where("entity_text is not null").groupBy("entity_text", "entity_type").agg(F.count("*").alias("n"), F.countDistinct("chart_id").alias("n_charts"))
    return g.orderBy(F.desc("n"), "entity_text", "entity_type").limit(k)


# --- what the application shows, over code mappings of both systems ---
#
# ``icd`` and ``loinc`` have mapping_id, chart_id, entity_id, code, confidence, reasoning, resolution_path and created_at,
# ``loinc`` method and specimen_type besides; ``*_codes`` have code and display_name, those of LOINC component, method and system.


def serving_view(mappings: DataFrame, **renamed: str) -> DataFrame:
    """The mappings under the names the application uses: ``serving_view(m, reasoning="r1_reasoning")``; other columns stay."""
    return mappings.withColumnsRenamed({old: new for new, old in renamed.items()})


def both_systems(icd: DataFrame, loinc: DataFrame) -> DataFrame:
    columns = ["mapping_id", "chart_id", "entity_id", "code", "confidence", "reasoning", "resolution_path", "created_at"]
    return icd.select(*columns, F.lit("ICD-10").alias("code_type")).unionByName(loinc.select(*columns, F.lit("LOINC").alias("code_type")))


def stats(charts: DataFrame, merged: DataFrame, icd: DataFrame, loinc: DataFrame) -> DataFrame:
    """One row of totals."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [charts.agg(F.count("*").alias("total_charts"), F.max("ingested_at").alias("last_refreshed")), n(merged, "total_entities"), n(icd, "total_icd10_mappings"), n(loinc, "total_loinc_mappings")]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each


def latest_stats(snapshots: DataFrame) -> DataFrame:
    """The newest row of a table of totals; zeros if it has none."""
    newest = snapshots.agg(F.max(F.struct("last_refreshed", *[c for c in snapshots.columns if c != "last_refreshed"])).alias("s")).select("s.*")
    return newest.withColumns({c: F.coalesce(c, F.lit(0)) for c in newest.columns if c.startswith("total_")})


def entity_types(merged: DataFrame) -> DataFrame:
    return merged.groupBy(F.col("entity_type").alias("name")).agg(F.count("*").alias("value"))


def _described(mappings: DataFrame, merged: DataFrame, *codes: tuple[str, DataFrame]) -> DataFrame:
    """Mappings with their entity's text and type and their code's name, as far as there are any."""
    e = merged.groupBy(F.col("entity_id").alias("_e")).agg(F.min(F.struct("entity_text", "entity_type")).alias("_x"))
    names = reduce(DataFrame.unionByName, [c.groupBy(F.lit(kind).alias("_kind"), F.col("code").alias("_code")).agg(F.min("display_name").alias("description")) for kind, c in codes])
    j = mappings.join(e, F.col("entity_id") == F.col("_e"), "left").join(names, (F.col("code") == F.col("_code")) & (F.col("code_type") == F.col("_kind")), "left")
    return j.withColumns({"entity_text": F.col("_x.entity_text"), "entity_type": F.col("_x.entity_type")}).drop("_e", "_x", "_code", "_kind")


def _texts(charts: DataFrame) -> DataFrame:
    return charts.groupBy(F.col("chart_id").alias("_chart")).agg(F.max("raw_text").alias("raw_text"))


def review_items(mappings: DataFrame, merged: DataFrame, icd_codes: DataFrame, loinc_codes: DataFrame, charts: DataFrame, code_type: str | None = None, status: str | None = None, page: int = 1, page_size: int = 50) -> DataFrame:
    """A page of the queue, newest first, with descriptions, a preview of the note and the number of all rows that meet the filter.

    The page is cut before anything is joined to it.
    """
    if page < 1 or not 1 <= page_size <= 5000:
        raise ValueError("page from 1, page_size from 1 to 5000")
    chosen = mappings.where(review_filter(code_type, status))
    rows = chosen.orderBy(F.desc("created_at"), "mapping_id").offset((page - 1) * page_size).limit(page_size)
    out = _described(rows, merged, ("ICD-10", icd_codes), ("LOINC", loinc_codes)).join(_texts(charts), F.col("chart_id") == F.col("_chart"), "left")
    path = F.col("resolution_path")
    state = F.when(path == "DISPUTED_UNRESOLVED", "pending").when(path.isin("HUMAN_ACCEPTED", "HUMAN_OVERRIDE"), "reviewed").otherwise("auto_resolved")
    total = chosen.agg(F.count("*").alias("total"))
    return out.withColumns({"status": state, "chart_preview": F.substring("raw_text", 1, 500)}).drop("_chart", "raw_text").crossJoin(F.broadcast(total))  # one row


def badge_counts(mappings: DataFrame) -> DataFrame:
    path = F.col("resolution_path")
    return mappings.agg(F.count_if(path == "R1_R2_AGREE").alias("agreed"), F.count_if(path.startswith("ARBITER")).alias("arbitrated"), F.count_if(path == "DISPUTED_UNRESOLVED").alias("unresolved"))


def queue_enrichment(page: DataFrame, assertions: DataFrame, merged: DataFrame) -> DataFrame:
    """A page of the queue with the assertions on its entities' sources and the layers that found them."""
    found = merged.join(page.select("entity_id").distinct(), "entity_id", "left_semi")
    links = found.select("entity_id", F.explode("source_entity_ids").alias("_source")).distinct()
    said = links.join(assertions.select(F.col("entity_id").alias("_source"), "assertion_status"), "_source").groupBy("entity_id").agg(F.min("assertion_status").alias("assertion_status"))
    layers = found.groupBy("entity_id").agg(F.max("sources").alias("sources"))
    return page.join(said, "entity_id", "left").join(layers, "entity_id", "left").withColumn("assertion_status", F.coalesce("assertion_status", F.lit("PRESENT")))


def review_item(mapping_id: str, icd: DataFrame, loinc: DataFrame, merged: DataFrame, icd_codes: DataFrame, loinc_codes: DataFrame, charts: DataFrame) -> DataFrame:
    """One mapping with its entity, its code's name and the whole note; that of ICD-10 if both systems have the id."""
    rows = both_systems(icd, loinc).where(F.col("mapping_id") == mapping_id).orderBy("code_type").limit(1)
    out = _described(rows, merged, ("ICD-10", icd_codes), ("LOINC", loinc_codes)).join(_texts(charts), F.col("chart_id") == F.col("_chart"), "left")
    return out.withColumnRenamed("raw_text", "chart_text").drop("_chart")


def chart_text(chart_id: str, charts: DataFrame) -> DataFrame:
    return charts.where(F.col("chart_id") == chart_id).select("chart_id", "patient_id", "file_name", "provider", "facility", "chart_date", "raw_text").distinct()


def recent_codes(mappings: DataFrame, merged: DataFrame, codes: DataFrame, code_type: str, k: int = 20) -> DataFrame:
    rows = mappings.withColumn("code_type", F.lit(code_type)).orderBy(F.desc("created_at"), "mapping_id").limit(k)
    extra = [c for c in ("method", "system") if c in codes.columns]
    out = _described(rows, merged, (code_type, codes))
    if extra:
        out = out.drop(*extra).join(codes.groupBy("code").agg(*[F.min(c).alias(c) for c in extra]), "code", "left")
    return out.select("mapping_id", "entity_text", "code", "description", "confidence", "created_at", *extra)


def top_loinc(loinc: DataFrame, codes: DataFrame, k: int = 15) -> DataFrame:
    g = loinc.groupBy("code").agg(F.count("*").alias("n"), F.round(F.round(F.avg("confidence"), 10), 3).alias("avg_confidence"))
    names = codes.groupBy("code").agg(F.min(F.struct("display_name", "component")).alias("_c"))
    return g.orderBy(F.desc("n"), "code").limit(k).join(names, "code", "left").select("code", F.col("_c.display_name").alias("description"), F.col("_c.component").alias("component"), "n", "avg_confidence")


def loinc_distribution(loinc: DataFrame, codes: DataFrame, of: str, own: str | None, missing: str, k: int) -> DataFrame:
    """The k most frequent components, methods or specimens: the code's, else the mapping's own, else ``missing``."""
    names = codes.groupBy(F.col("code").alias("_code")).agg(F.min(of).alias("_of"))
    value = F.coalesce(F.col("_of"), *([F.col(own)] if own else []), F.lit(missing))
    g = loinc.join(names, F.col("code") == F.col("_code"), "left").groupBy(value.alias("name")).agg(F.count("*").alias("n"))
    return g.orderBy(F.desc("n"), "name").limit(k)


def loinc_disambiguation(loinc: DataFrame, codes: DataFrame) -> DataFrame:
    """Analytes with several codes: each code's method and specimen, how often and how surely it was given, and which one is chosen.

    The chosen code has the best mix of occurrence and confidence.
    """
    c = codes.where("component != ''").dropDuplicates(["code"]).select(F.col("code").alias("_code"), "display_name", "component", F.col("method").alias("_m"), "system")
    j = loinc.where(~F.col("code").isin(*NO_CODE)).join(c, F.col("code") == F.col("_code"))
    several = j.groupBy("component").agg(F.countDistinct("code").alias("_k")).where("_k > 1").select("component")
    keys = ["component", "code", "display_name", F.coalesce("_m", "method", F.lit("Not specified")).alias("method"), F.coalesce("system", "specimen_type", F.lit("Not specified")).alias("specimen")]
    g = j.join(several, "component", "left_semi").groupBy(*keys).agg(F.count("*").alias("occurrences"), F.round(F.round(F.avg("confidence"), 10), 3).alias("avg_confidence"), F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"))
    w = W.partitionBy("component")
    g = g.withColumn("score", F.round(0.6 * F.col("occurrences") / F.max("occurrences").over(w) + 0.4 * F.col("avg_confidence"), 6))
    return g.withColumn("selected", F.row_number().over(w.orderBy(F.desc("score"), "code", "method", "specimen")) == 1)


def facilities(charts: DataFrame) -> DataFrame:
    return charts.where("facility is not null").groupBy("facility").agg(F.countDistinct("chart_id").alias("charts"))


def timeline(charts: DataFrame) -> DataFrame:
    return charts.groupBy(F.to_date("ingested_at").alias("date")).agg(F.countDistinct("chart_id").alias("charts"))


def confidence_spread(icd: DataFrame) -> DataFrame:
    """Mappings by confidence rounded to tenths, halves up."""
    tenth = F.floor(F.round(F.col("confidence") * 100, 6) / 10 + 0.5) / 10
    return icd.where("confidence is not null").groupBy(F.round(tenth, 1).alias("bucket")).agg(F.count("*").alias("n"))


def latest_metrics(metrics: DataFrame, k: int = 100) -> DataFrame:
    rows = metrics.orderBy(F.desc("run_timestamp"), "run_id").limit(k)
    return rows.select(F.to_date("run_timestamp").alias("run_date"), "run_id", "metric_scope", "scope_value", "recall_score", "precision_score", "f1_score")


def tier_shares(icd: DataFrame) -> DataFrame:
    """One row: the shares of codes by ontology and by model, and the mean confidence, weighted by the number of codes of each path."""
    per = icd.groupBy("resolution_path").agg(F.count("*").alias("n"), F.round(F.round(F.avg("confidence"), 10), 3).alias("c"))
    total = F.greatest(F.sum("n"), F.lit(1))
    part = lambda path: F.round(F.coalesce(F.sum(F.when(F.col("resolution_path") == path, F.col("n"))), F.lit(0)) * 100.0 / total, 1)
    return per.agg(part("ONTOLOGY_DIRECT").alias("ontology_coverage_pct"), part("LLM_ASSIGNED").alias("llm_coding_pct"), F.round(F.round(F.sum(F.col("c") * F.col("n")) / total * 100, 6), 1).alias("avg_confidence_by_tier"))
