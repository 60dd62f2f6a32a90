"""Queries of the application's pages, metrics and loaders, each with its oracle SQL next to it.

The SQL stands on the tables and the roles alone: it repeats no table of the library.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clinical import stable_id
from ..operators import coding, extraction, feedback, merge, pipeline, quality, sections, serving
from ..sources import ontology
from ..sources.catalog import Catalog, list_files
from ..sources.tables import shared_dir, table
from .roles import role, with_roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, roles: tuple[str, ...] = ()):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = with_roles(sql, *roles) if roles else sql
        return f

    return register


MAPS, CODES = ("icd10_mappings", "loinc_mappings"), ("icd_ref", "loinc_codes")


def _icd_codes(spark, d):
    return role(spark, d, "icd_ref").select("code", F.col("description").alias("display_name"))


def _both(spark, d):
    return serving.both_systems(role(spark, d, MAPS[0]), role(spark, d, MAPS[1]))


# --- pipeline page ---


@query("select (select count(*) from charts) as total_charts, (select max(ingested_at) from charts) as last_refreshed, (select count(*) from merged_entities) as total_entities, (select count(*) from icd10_mappings) as total_icd10_mappings, (select count(*) from loinc_mappings) as total_loinc_mappings", roles=MAPS)
def kpi_row(spark, d):
    return serving.stats(table(spark, d, "charts"), table(spark, d, "merged_entities"), role(spark, d, MAPS[0]), role(spark, d, MAPS[1]))


@query("select cast(sum(value) as bigint) as n, day from (select count(*) as value, cast(ts as date) as day from events group by 2) t group by 2 order by day desc limit 1")
def latest_totals(spark, d):
    daily = table(spark, d, "events").groupBy(F.to_date("ts").alias("last_refreshed")).agg(F.count("*").alias("total_n"))
    return serving.latest_stats(daily).select(F.col("total_n").alias("n"), F.col("last_refreshed").alias("day"))


@query("select entity_type as name, count(*) as value from merged_entities group by 1")
def entity_distribution(spark, d):
    return serving.entity_types(table(spark, d, "merged_entities"))


@query("select cast(ingested_at as date) as date, count(distinct chart_id) as charts from charts group by 1")
def timeline(spark, d):
    return serving.timeline(table(spark, d, "charts"))


@query("select facility, count(distinct chart_id) as charts from charts where facility is not null group by 1")
def facilities(spark, d):
    return serving.facilities(table(spark, d, "charts"))


@query("select case when list_contains(sources, 'dictionary') and (list_contains(sources, 'llm') or list_contains(sources, 'ner')) then 'both' when list_contains(sources, 'dictionary') then 'dictionary_only' when list_contains(sources, 'llm') then 'llm_only' when list_contains(sources, 'ner') then 'ner_only' else 'other' end as category, count(*) as n from merged_entities group by 1")
def source_category(spark, d):
    return table(spark, d, "merged_entities").groupBy(merge.source_category(F.col("sources")).alias("category")).agg(F.count("*").alias("n"))


# --- review pages ---

_ALL = """both_maps as (select mapping_id, chart_id, entity_id, code, confidence, reasoning, resolution_path, created_at, 'ICD-10' as code_type from icd10_mappings
    union all select mapping_id, chart_id, entity_id, code, confidence, reasoning, resolution_path, created_at, 'LOINC' from loinc_mappings),
  names as (select 'ICD-10' as kind, code, min(description) as description from icd_ref group by 2 union all select 'LOINC', code, min(display_name) from loinc_codes group by 2),
  ents as (select entity_id, min({'t': entity_text, 'k': entity_type}) as x from merged_entities where entity_text is not null group by 1),
  notes as (select chart_id, max(raw_text) as raw_text from charts group by 1)"""


def _join(sql: str) -> str:
    """``sql`` with the shared expressions put behind the roles."""
    return with_roles("@@ " + sql, *MAPS, *CODES).replace(" @@ ", ", " + _ALL + " ")


def review_queue_items(spark, d):
    page = serving.review_items(_both(spark, d), table(spark, d, "merged_entities").where("entity_text is not null"), _icd_codes(spark, d), role(spark, d, "loinc_codes"), table(spark, d, "charts"), status="needs_review", page=2, page_size=20)
    return page.select("mapping_id", "chart_id", "code_type", "code", "description", "confidence", "entity_text", "entity_type", "status", "chart_preview", "total")


def review_item(spark, d):
    # The detail pages of all mappings of the greatest id's chart; one page is one id.
    wanted = _both(spark, d).agg(F.max("mapping_id")).head()[0]
    item = serving.review_item(wanted, role(spark, d, MAPS[0]), role(spark, d, MAPS[1]), table(spark, d, "merged_entities").where("entity_text is not null"), _icd_codes(spark, d), role(spark, d, "loinc_codes"), table(spark, d, "charts"))
    return item.select("mapping_id", "chart_id", "code_type", "code", "description", "resolution_path", "entity_text", "entity_type", F.length("chart_text").alias("n_chars"))


def badge_counts(spark, d):
    return serving.badge_counts(_both(spark, d))


def review_enrichment(spark, d):
    page = _both(spark, d).where("resolution_path = 'DISPUTED_UNRESOLVED'")
    rows = serving.queue_enrichment(page, role(spark, d, "assertions"), table(spark, d, "merged_entities"))
    return rows.select("mapping_id", "assertion_status", F.array_join(F.array_sort("sources"), ",").alias("sources"))


QUERIES |= {"review_queue_items": review_queue_items, "review_item": review_item, "badge_counts": badge_counts, "review_enrichment": review_enrichment}
ORACLE |= {
    "review_queue_items": _join("""select mapping_id, m.chart_id, code_type, m.code, n.description, confidence, x.t as entity_text, x.k as entity_type, 'pending' as status, substring(raw_text, 1, 500) as chart_preview, (select count(*) from both_maps where resolution_path = 'DISPUTED_UNRESOLVED') as total
        from (select * from both_maps where resolution_path = 'DISPUTED_UNRESOLVED' order by created_at desc, mapping_id limit 20 offset 20) m left join ents using (entity_id) left join names n on n.kind = code_type and n.code = m.code left join notes c on c.chart_id = m.chart_id"""),
    "review_item": _join("""select mapping_id, m.chart_id, code_type, m.code, n.description, resolution_path, x.t as entity_text, x.k as entity_type, cast(length(raw_text) as int) as n_chars
        from (select * from both_maps where mapping_id = (select max(mapping_id) from both_maps) order by code_type limit 1) m left join ents using (entity_id) left join names n on n.kind = code_type and n.code = m.code left join notes c on c.chart_id = m.chart_id"""),
    "badge_counts": _join("select count(*) filter (where resolution_path = 'R1_R2_AGREE') as agreed, count(*) filter (where resolution_path like 'ARBITER%') as arbitrated, count(*) filter (where resolution_path = 'DISPUTED_UNRESOLVED') as unresolved from both_maps"),
    "review_enrichment": with_roles("""@@ select mapping_id, coalesce(min(a.assertion_status), 'PRESENT') as assertion_status, max(s.s) as sources from both_maps m left join (select entity_id, unnest(source_entity_ids) as source from merged_entities) l using (entity_id) left join assertions a on a.entity_id = l.source
        left join (select entity_id, array_to_string(list_sort(max(sources)), ',') as s from merged_entities group by 1) s on s.entity_id = m.entity_id where resolution_path = 'DISPUTED_UNRESOLVED' group by 1""", *MAPS, *CODES, "assertions").replace(" @@ ", ", " + _ALL + " "),
}


@query("select chart_id, patient_id, file_name, provider, facility, chart_date, raw_text from (select distinct chart_id, patient_id, file_name, provider, facility, chart_date, raw_text from charts where chart_id = (select max(chart_id) from charts)) t")
def chart_text(spark, d):
    charts = table(spark, d, "charts")
    return serving.chart_text(charts.agg(F.max("chart_id")).head()[0], charts)


# --- code pages ---


def recent_icd10(spark, d):
    return serving.recent_codes(role(spark, d, MAPS[0]), table(spark, d, "merged_entities").where("entity_text is not null"), _icd_codes(spark, d), "ICD-10")


def recent_loinc(spark, d):
    return serving.recent_codes(role(spark, d, MAPS[1]), table(spark, d, "merged_entities").where("entity_text is not null"), role(spark, d, "loinc_codes"), "LOINC")


QUERIES |= {"recent_icd10": recent_icd10, "recent_loinc": recent_loinc}
ORACLE |= {
    "recent_icd10": _join("select mapping_id, x.t as entity_text, m.code, n.description, confidence, created_at from (select * from icd10_mappings order by created_at desc, mapping_id limit 20) m left join ents using (entity_id) left join names n on n.kind = 'ICD-10' and n.code = m.code"),
    "recent_loinc": _join("select mapping_id, x.t as entity_text, m.code, n.description, confidence, created_at, c.method, c.system from (select mapping_id, entity_id, code, confidence, created_at from loinc_mappings order by created_at desc, mapping_id limit 20) m left join ents using (entity_id) left join names n on n.kind = 'LOINC' and n.code = m.code left join loinc_codes c on c.code = m.code"),
}
LOINC = ("loinc_mappings", "loinc_codes")


@query("select m.code, c.display_name as description, c.component, n, avg_confidence from (select code, count(*) as n, round(round(avg(confidence), 10), 3) as avg_confidence from loinc_mappings group by 1 order by n desc, code limit 15) m left join loinc_codes c on c.code = m.code", roles=LOINC)
def top_loinc(spark, d):
    return serving.top_loinc(role(spark, d, LOINC[0]), role(spark, d, LOINC[1]))


def _distribution(of: str, own: str | None, missing: str, k: int):
    def run(spark, d):
        return serving.loinc_distribution(role(spark, d, LOINC[0]), role(spark, d, LOINC[1]), of, own, missing, k)

    value = f"coalesce(c.{of}, {f'm.{own}, ' if own else ''}'{missing}')"
    return run, with_roles(f"select {value} as name, count(*) as n from loinc_mappings m left join loinc_codes c on c.code = m.code group by 1 order by n desc, name limit {k}", *LOINC)


for _name, _args in {"loinc_components": ("component", None, "Unknown", 15), "loinc_methods": ("method", "method", "Not specified", 10), "loinc_specimens": ("system", "specimen_type", "Not specified", 10)}.items():
    QUERIES[_name], ORACLE[_name] = _distribution(*_args)


@query("""select component, code, display_name, method, specimen, occurrences, avg_confidence, min_confidence, max_confidence, score, row_number() over (partition by component order by score desc, code, method, specimen) = 1 as selected from (
    select *, round(0.6e0 * occurrences / max(occurrences) over (partition by component) + 0.4e0 * avg_confidence, 6) as score from (
    select c.component, m.code, c.display_name, coalesce(c.method, m.method, 'Not specified') as method, coalesce(c.system, m.specimen_type, 'Not specified') as specimen, count(*) as occurrences, round(round(avg(confidence), 10), 3) as avg_confidence, min(confidence) as min_confidence, max(confidence) as max_confidence
    from loinc_mappings m join loinc_codes c on c.code = m.code where c.component <> '' and c.component in (select c2.component from loinc_mappings m2 join loinc_codes c2 on c2.code = m2.code group by 1 having count(distinct m2.code) > 1) group by 1, 2, 3, 4, 5) g) t""", roles=LOINC)
def loinc_disambiguation(spark, d):
    return serving.loinc_disambiguation(role(spark, d, LOINC[0]), role(spark, d, LOINC[1]))


@query("""select case when confidence >= 0.95 then 1.0e0 when confidence >= 0.85 then 0.9e0 when confidence >= 0.75 then 0.8e0 when confidence >= 0.65 then 0.7e0 when confidence >= 0.55 then 0.6e0 when confidence >= 0.45 then 0.5e0
    when confidence >= 0.35 then 0.4e0 when confidence >= 0.25 then 0.3e0 when confidence >= 0.15 then 0.2e0 when confidence >= 0.05 then 0.1e0 else 0.0e0 end as bucket, count(*) as n from icd10_mappings group by 1""", roles=("icd10_mappings",))
def confidence_spread(spark, d):
    return serving.confidence_spread(role(spark, d, "icd10_mappings"))


@query("""select round(100.0e0 * coalesce(sum(n) filter (where p = 'ONTOLOGY_DIRECT'), 0) / greatest(sum(n), 1), 1) as ontology_coverage_pct,
    round(100.0e0 * coalesce(sum(n) filter (where p = 'LLM_ASSIGNED'), 0) / greatest(sum(n), 1), 1) as llm_coding_pct, round(round(sum(c * n) / greatest(sum(n), 1) * 100, 6), 1) as avg_confidence_by_tier from (select resolution_path as p, count(*) as n, round(round(avg(confidence), 10), 3) as c from icd10_mappings group by 1) per""", roles=("icd10_mappings",))
def tier_shares(spark, d):
    return serving.tier_shares(role(spark, d, "icd10_mappings"))


# --- metrics and error patterns ---


@query("select cast(run_timestamp as date) as run_date, run_id, metric_scope, scope_value, recall_score, precision_score, f1_score from runs order by run_timestamp desc, run_id limit 100", roles=("runs",))
def latest_metrics(spark, d):
    return serving.latest_metrics(role(spark, d, "runs"))


@query("select pattern_id, pattern_type, severity, detected_at from patterns where resolved_at is null", roles=("patterns",))
def open_patterns(spark, d):
    return quality.open_patterns(role(spark, d, "patterns")).select("pattern_id", "pattern_type", "severity", "detected_at")


@query("""select cast(run_timestamp as date) as run_date, metric_scope, scope_value, round(avg(recall_score), 6) as avg_recall, round(avg(precision_score), 6) as avg_precision, round(avg(f1_score), 6) as avg_f1,
    cast(sum(true_positives) as bigint) as total_tp, cast(sum(false_negatives) as bigint) as total_fn from runs group by 1, 2, 3""", roles=("runs",))
def quality_trend(spark, d):
    return quality.quality_trend(role(spark, d, "runs"))


@query("""select (select count(*) from charts) as charts_processed, m.*, a.*, (select count(distinct code) from icd10_mappings) as icd10_count, (select count(distinct code) from loinc_mappings) as loinc_count, (select recall_score from runs where metric_scope = 'overall' order by run_timestamp desc, run_id desc limit 1) as latest_recall,
    (select string_agg(concat(pattern_type, ' (', severity, ')'), '; ' order by r, pattern_type, pattern_id) from (select *, case severity when 'HIGH' then 1 when 'MEDIUM' then 2 else 3 end as r from patterns where resolved_at is null order by r, pattern_type, pattern_id limit 5) p) as top_errors
    from (select count(*) as total_entities, round(100.0e0 * count(*) filter (where list_contains(sources, 'dictionary')) / count(*), 1) as dict_pct, round(100.0e0 * count(*) filter (where list_contains(sources, 'ner')) / count(*), 1) as ner_pct, round(100.0e0 * count(*) filter (where list_contains(sources, 'llm')) / count(*), 1) as llm_pct,
        round(round(avg(ensemble_confidence), 10) * 100, 1) as overall_confidence_pct from merged_entities) m,
    (select round(100.0e0 * count(*) filter (where negation_detected) / count(*), 1) as negated_pct, round(100.0e0 * count(*) filter (where temporality = 'HISTORICAL') / count(*), 1) as historical_pct, round(100.0e0 * count(*) filter (where experiencer = 'FAMILY_MEMBER') / count(*), 1) as family_pct from assertions) a""",
    roles=(*MAPS, "runs", "patterns", "assertions"))
def executive_summary(spark, d):
    return quality.executive_summary(table(spark, d, "charts"), table(spark, d, "merged_entities"), role(spark, d, "assertions"), role(spark, d, MAPS[0]), role(spark, d, MAPS[1]), role(spark, d, "runs"), role(spark, d, "patterns"))


_KEYS = "select distinct chart_id, upper(trim(entity_type, ' ')) as t, lower(trim(entity_text, ' ')) as x from {0} where entity_text is not null"
_SETS = "f as (" + _KEYS.format("merged_entities") + "), g as (" + _KEYS.format("gold_annotations") + " and annotation_round = (select max(annotation_round) from gold_annotations))"
_MISSED = "missed as (select g.* from g where not exists (select 1 from f where f.chart_id = g.chart_id and f.t = g.t and f.x = g.x)), context as (select m.chart_id, t as entity_type, x as text, s.section_type, note_length, coalesce(n, 0) as total_entities_in_chart from missed m left join (select distinct chart_id, section_type from document_sections) s on s.chart_id = m.chart_id left join (select chart_id, max(length(raw_text)) as note_length from charts group by 1) c on c.chart_id = m.chart_id left join (select chart_id, count(*) as n from merged_entities group by 1) e on e.chart_id = m.chart_id)"


def _missed(spark, d):
    merged = table(spark, d, "merged_entities")
    missed = feedback.missed_entities(merged, table(spark, d, "gold_annotations"))
    return feedback.missed_in_context(missed, merged, table(spark, d, "charts"), table(spark, d, "document_sections"))


@query("with " + _SETS + ", " + _MISSED + " select chart_id, entity_type, text, section_type, cast(note_length as int) as note_length, total_entities_in_chart from context")
def missed_in_context(spark, d):
    return _missed(spark, d)


@query("with " + _SETS + ", " + _MISSED + " select section_type, count(*) as n_missed from context group by 1")
def missed_by_section(spark, d):
    return feedback.missed_by(_missed(spark, d), "section_type")


@query("with " + _SETS + ", " + _MISSED + """ select entity_type, text, section_type, chart_id, concat('- [', entity_type, '] "', text, '" (section: ', coalesce(section_type, 'None'), ')') as line from context order by entity_type nulls first, text, section_type nulls first, chart_id limit 100""")
def missed_sample(spark, d):
    return feedback.missed_sample(_missed(spark, d))


@query("with " + _SETS + ", " + _MISSED + """, s as (select * from context order by entity_type nulls first, text, section_type nulls first, chart_id limit 100)
    select concat('missed ', entity_type) as pattern_type, concat(count(*), ' entities of type ', entity_type, ' were missed') as description, case when count(*) >= 30 then 'HIGH' when count(*) >= 10 then 'MEDIUM' else 'LOW' end as severity from s group by entity_type""")
def error_patterns(spark, d):
    return feedback.error_patterns(_missed(spark, d)).select("pattern_type", "description", "severity")


_RATES = "coalesce(round(tp / nullif(tp + fp, 0), 4), 0) as precision_score, coalesce(round(tp / nullif(tp + fn, 0), 4), 0) as recall_score, coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 4), 0) as f1_score"


@query("with " + _SETS + ", k as (select coalesce(f.t, g.t) as t, f.x is not null as f, g.x is not null as g from f full join g on f.chart_id = g.chart_id and f.t = g.t and f.x = g.x), n as (select 'overall' as metric_scope, 'all' as scope_value, count(*) filter (where f and g) as tp, count(*) filter (where f and not g) as fp, count(*) filter (where g and not f) as fn from k union all select 'by_entity_type', t, count(*) filter (where f and g), count(*) filter (where f and not g), count(*) filter (where g and not f) from k group by t) select metric_scope, scope_value, cast(tp as int) as true_positives, cast(fp as int) as false_positives, cast(fn as int) as false_negatives, " + _RATES + ", 'RUN-1' as run_id from n")
def metric_rows(spark, d):
    rows = feedback.metric_rows(table(spark, d, "merged_entities"), table(spark, d, "gold_annotations"), "RUN-1", F.current_timestamp())
    return rows.drop("run_timestamp", "extraction_layer")


# --- stages ---


@query("select chart_id from (select chart_id from dictionary_entities union select chart_id from llm_entities) u where chart_id is not null and chart_id not in (select chart_id from merged_entities where chart_id is not null)")
def charts_to_merge(spark, d):
    return pipeline.charts_to_merge([table(spark, d, "dictionary_entities"), table(spark, d, "llm_entities")], table(spark, d, "merged_entities"))


@query("select source_code, count(*) as n from dictionary_entities where chart_id in (select chart_id from charts where raw_text is not null and extraction_method is null) group by 1")
def entities_of_pinned_charts(spark, d):
    done = table(spark, d, "charts").where("raw_text is null or extraction_method is not null").select("chart_id").distinct()
    todo = table(spark, d, "charts").where("raw_text is not null and extraction_method is null")
    batch = pipeline.pin_batch(todo, done.limit(0))
    return pipeline.of_charts(table(spark, d, "dictionary_entities"), batch).groupBy("source_code").agg(F.count("*").alias("n"))


@query("select count(*) as n_candidates, count(distinct chart_id) as n_charts from charts where raw_text is null or length(raw_text) < 100")
def ocr_candidates(spark, d):
    return sections.ocr_candidates(table(spark, d, "charts")).agg(F.count("*").alias("n_candidates"), F.countDistinct("chart_id").alias("n_charts"))


@query("select c.chart_id, coalesce(c.page_count, s.n) as page_count, count(*) as n from charts c left join (select chart_id, cast(count(*) as int) as n from document_sections group by 1) s on s.chart_id = c.chart_id group by 1, 2")
def page_counts(spark, d):
    return sections.fill_page_count(table(spark, d, "charts"), table(spark, d, "document_sections")).groupBy("chart_id", "page_count").agg(F.count("*").alias("n"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"


@query("select chart_id, max(file_name) as file_name, concat('scan of ', max(file_name), repeat('.', 100)) as raw_text, 'ocr_ai_parse' as extraction_method from charts where (raw_text is null or length(raw_text) < 100) and file_name is not null group by 1")
def ocr_texts(spark, d):
    """The document path end to end: a file for every chart without text, listed, parsed, joined by name and merged into the charts."""
    charts = table(spark, d, "charts").groupBy("chart_id").agg(F.max("file_name").alias("file_name"), F.max("raw_text").alias("raw_text"), F.max("extraction_method").alias("extraction_method"))
    wanted = sections.ocr_candidates(table(spark, d, "charts")).where("file_name is not null").groupBy("chart_id").agg(F.max("file_name").alias("file_name"))
    files = wanted.select("file_name", F.encode(F.concat(F.lit("scan of "), "file_name", F.lit("." * 100)), "utf-8").alias("content")).distinct()
    texts = sections.parse_documents(wanted.withColumn("raw_text", F.lit(None).cast("string")), files)
    return sections.apply_ocr(charts, texts).where("extraction_method = 'ocr_ai_parse'").join(wanted.select("chart_id"), "chart_id", "left_semi")


# --- loaders: files in the distributions' formats, written from the test tables and read back ---


def _rrf(rows: DataFrame, width: int, fields: dict[int, str], path: str) -> str:
    columns = [F.col(fields[i]) if i in fields else F.lit("") for i in range(width)]
    rows.select(F.concat_ws("|", *columns).alias("line")).write.text(path)
    return path


@query("""select cui, preferred_name, case semantic_type when 'Disease or Syndrome' then 'DISO' when 'Pharmacologic Substance' then 'CHEM' when 'Laboratory Procedure' then 'PROC' when 'Clinical Attribute' then 'PHYS' else 'OTHER' end as semantic_group, len(list_distinct(list_concat([preferred_name], coalesce(synonyms, [])))) as n_names from umls_concepts where preferred_name not like '%|%'""")
def load_umls(spark, d):
    u = table(spark, d, "umls_concepts").where("preferred_name not like '%|%'")
    base = u.select("cui", F.lit("ENG").alias("lat"), F.lit("SRC").alias("sab"), "semantic_type", F.col("preferred_name").alias("str"), F.lit("P").alias("ts"), F.lit("PF").alias("stt"), F.lit("Y").alias("pref"))
    more = u.select("cui", F.lit("ENG").alias("lat"), F.lit("SRC").alias("sab"), "semantic_type", F.explode("synonyms").alias("str"), F.lit("S").alias("ts"), F.lit("VO").alias("stt"), F.lit("N").alias("pref"))
    other = base.withColumns({"lat": F.lit("FRE"), "str": F.lit("nom")})
    names = base.unionByName(more).unionByName(other)
    conso = _rrf(names, 19, {0: "cui", 1: "lat", 2: "ts", 4: "stt", 6: "pref", 11: "sab", 14: "str"}, _folder(spark, "mrconso"))
    sty = _rrf(u, 7, {0: "cui", 3: "semantic_type"}, _folder(spark, "mrsty"))
    return ontology.load_umls(spark, conso, sty).select("cui", "preferred_name", "semantic_group", F.size("synonyms").cast("long").alias("n_names"))


@query("""select cast(p_partkey as string) as rxcui, p_name as name, 'IN' as term_type, 2 as n_names from part where p_name not like '%|%'""")
def load_rxnorm(spark, d):
    p = table(spark, d, "part").where("p_name not like '%|%'").select(F.col("p_partkey").cast("string").alias("rxcui"), F.lit("ENG").alias("lat"), F.lit("RXNORM").alias("sab"), F.lit("IN").alias("tty"), F.col("p_name").alias("str"))
    brand = p.withColumns({"tty": F.lit("SBD"), "str": F.concat(F.lit("brand of "), "str")})
    foreign = p.withColumns({"sab": F.lit("OTHER"), "str": F.lit("x")})
    path = _rrf(p.unionByName(brand).unionByName(foreign), 19, {0: "rxcui", 1: "lat", 11: "sab", 12: "tty", 14: "str"}, _folder(spark, "rxnconso"))
    return ontology.load_rxnorm(spark, path).select("rxcui", "name", "term_type", F.size("synonyms").alias("n_names"))


@query("""select concat('N', cast(n_nationkey as string)) as concept_id, n_name as concept_name, concat('R', cast(n_regionkey as string)) as parent_id, r_name as parent_name, 'A00.' || cast(n_nationkey % 7 as string) as icd10_code
    from nation join region on r_regionkey = n_regionkey""")
def load_snomed(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    ids = nation.select(F.concat(F.lit("N"), "n_nationkey").alias("conceptId"), F.col("n_name").alias("term")).unionByName(region.select(F.concat(F.lit("R"), "r_regionkey").alias("conceptId"), F.col("r_name").alias("term")))
    names = ids.withColumns({"active": F.lit("1"), "languageCode": F.lit("en"), "typeId": F.lit("900000000000003001")})
    names = names.unionByName(names.withColumns({"typeId": F.lit("900000000000013009"), "term": F.lit("synonym")})).unionByName(names.withColumns({"active": F.lit("0"), "term": F.lit("A retired name")}))
    edges = nation.select(F.lit("1").alias("active"), F.concat(F.lit("N"), "n_nationkey").alias("sourceId"), F.concat(F.lit("R"), "n_regionkey").alias("destinationId"), F.lit("116680003").alias("typeId"))
    maps = nation.select(F.lit("1").alias("active"), F.concat(F.lit("N"), "n_nationkey").alias("referencedComponentId"), F.concat(F.lit("A00."), F.col("n_nationkey") % 7).alias("mapTarget"), F.lit("1").alias("mapPriority"), F.lit("TRUE").alias("mapRule"), F.lit("1").alias("mapGroup"))
    folder = _folder(spark, "rf2")
    for name, rows in (("sct2_Description_Full.txt", names), ("sct2_Relationship_Full.txt", edges), ("der2_ExtendedMap_Full.txt", maps)):
        rows.coalesce(1).write.option("sep", "\t").option("header", True).csv(f"{folder}/{name}")
    hierarchy, codes = ontology.load_snomed_folder(spark, folder)
    return hierarchy.join(codes.select(F.col("snomed_concept_id").alias("concept_id"), "icd10_code"), "concept_id", "left").select("concept_id", "concept_name", "parent_id", "parent_name", "icd10_code")


@query("""select chart_id, entity_type, entity_text, coalesce(annotator_id, 'unknown') as annotator_id, annotation_round, concat('GOLD-', substring(sha256(concat(coalesce(chart_id, ''), '|', coalesce(entity_type, ''), '|', coalesce(entity_text, ''), '|', coalesce(annotator_id, 'unknown'))), 1, 12)) as annotation_id
    from gold_annotations where annotation_round is not null and entity_text is not null and trim(entity_text) <> '' and not regexp_matches(entity_text, '["\\\\\\s,]{2}|^\\s|\\s$|["\\\\]') group by all""")
def import_gold(spark, d):
    """Annotations written as CSV and JSON files, found by their suffix and imported."""
    g = table(spark, d, "gold_annotations").where("annotation_round is not null and entity_text is not null and trim(entity_text) != ''").where(~F.col("entity_text").rlike(r'["\\\s,]{2}|^\s|\s$|["\\]'))
    g = g.select("chart_id", "entity_type", "entity_text", "start_offset", "end_offset", "annotator_id", "annotation_round")
    folder = _folder(spark, "gold")
    half = F.col("annotation_round") == 1
    g.where(half).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/a.csv")
    g.where(~half).write.json(f"{folder}/b.json")
    found = list_files(spark, folder, (".csv", ".json"))
    rows = feedback.import_gold(spark, found[".csv"], found[".json"], json_lines=True)
    return rows.select("chart_id", "entity_type", "entity_text", "annotator_id", "annotation_round", "annotation_id")


# --- assembling codes ---


@query("""select concat('MAP-ICD-', substring(sha256(concat('=', entity_id, '|=', code)), 1, 16)) as mapping_id, entity_id, code as icd10_code, resolution_path, not (code like '%.9%' or length(replace(code, '.', '')) < 5) as is_specific from icd10_mappings where resolution_path in ('ONTOLOGY_DIRECT', 'LLM_ASSIGNED')""", roles=("icd10_mappings",))
def assemble_icd10(spark, d):
    m = role(spark, d, "icd10_mappings").withColumn("entity_text", F.lit("x"))
    one = m.where("resolution_path = 'ONTOLOGY_DIRECT'").select("entity_id", "chart_id", "entity_text", F.col("code").alias("icd10_code"), F.lit("d").alias("icd10_description"), "confidence", F.lit("exact").alias("tier1_method"), F.lit("ICD10").alias("match_source"), F.lit(None).cast("string").alias("term_cui"))
    two = m.where("resolution_path = 'LLM_ASSIGNED'").select("entity_id", "chart_id", "entity_text", "code", F.lit("d").alias("final_description"), F.col("confidence").alias("final_confidence"), "reasoning")
    return coding.assemble_icd10(one, two).select("mapping_id", "entity_id", "icd10_code", "resolution_path", "is_specific")


@query("""select entity_id, code as loinc_code, resolution_path, min(e.specimen_type) as specimen_type, min(e.method) as method from loinc_mappings m left join (select entity_id, min(specimen_type) as specimen_type, min(method) as method from merged_entities group by 1) e using (entity_id)
    where resolution_path in ('ONTOLOGY_DIRECT', 'LLM_ASSIGNED') group by 1, 2, 3""", roles=LOINC)
def assemble_loinc(spark, d):
    m = role(spark, d, "loinc_mappings").withColumn("entity_text", F.lit("x"))
    one = m.where("resolution_path = 'ONTOLOGY_DIRECT'").select("entity_id", "entity_text", F.col("code").alias("loinc_code"), F.lit("n").alias("long_name"), "confidence")
    two = m.where("resolution_path = 'LLM_ASSIGNED'").select("entity_id", "entity_text", "code", F.lit("n").alias("final_description"), F.col("confidence").alias("final_confidence"))
    meta = table(spark, d, "merged_entities").groupBy("entity_id").agg(*[F.min(c).alias(c) for c in ("specimen_type", "method", "timing")])
    return coding.assemble_loinc(one, two, meta).select("entity_id", "loinc_code", "resolution_path", "specimen_type", "method")


@query("""select distinct entity_id, u.cui from merged_entities m join umls_concepts u on lower(m.entity_text) = lower(u.preferred_name) where not exists (select 1 from icd10_mappings i where i.entity_id = m.entity_id and i.resolution_path = 'HUMAN_ACCEPTED')""", roles=("icd10_mappings",))
def assemble_umls(spark, d):
    u = table(spark, d, "umls_concepts").select(F.lower("preferred_name").alias("_n"), F.col("cui").alias("term_cui"))
    matches = table(spark, d, "merged_entities").join(u, F.lower("entity_text") == F.col("_n")).select("entity_id", "chart_id", "entity_text", "term_cui", F.lit("UMLS").alias("match_source"), F.col("term_cui").alias("source_code"), F.lit("exact").alias("tier1_method"), F.lit(0.98).alias("tier1_confidence"))
    coded = role(spark, d, "icd10_mappings").where("resolution_path = 'HUMAN_ACCEPTED'").select("entity_id").distinct()
    existing = matches.join(coded, "entity_id", "left_semi").select("entity_id", F.col("term_cui").alias("cui"))
    return coding.assemble_umls(matches, role(spark, d, "hierarchy"), existing).select("entity_id", "cui").distinct()


@query("""select m.entity_type, count(distinct m.entity_id) as n_open from merged_entities m where (entity_type = 'DIAGNOSIS' and entity_id not in (select entity_id from icd10_mappings where resolution_path = 'ONTOLOGY_DIRECT'))
    or (entity_type = 'LAB_RESULT' and entity_id not in (select entity_id from loinc_mappings where resolution_path = 'ONTOLOGY_DIRECT')) group by 1""", roles=MAPS)
def unresolved(spark, d):
    direct = lambda name: role(spark, d, name).where("resolution_path = 'ONTOLOGY_DIRECT'")
    return coding.unresolved(table(spark, d, "merged_entities"), direct(MAPS[0]), direct(MAPS[1])).groupBy("entity_type").agg(F.countDistinct("entity_id").alias("n_open"))


@query("""select mapping_id, coalesce(display_name, 'd') as final_description, case when c.code is null then 0.60e0 else confidence end as final_confidence, c.code is not null as code_validated from loinc_mappings m left join loinc_codes c on c.code = m.code""", roles=LOINC)
def validate_loinc(spark, d):
    codes = role(spark, d, "loinc_mappings").select("mapping_id", "code", F.lit("d").alias("description"), "confidence")
    ref = role(spark, d, "loinc_codes").select(F.col("code").alias("loinc_code"), F.col("display_name").alias("long_name"))
    return coding.validate_loinc(codes, ref).select("mapping_id", "final_description", "final_confidence", "code_validated")


@query("""select assertion_status, count(*) as n from (select distinct entity_id, case k when 0 then 'ABSENT' when 1 then 'POSSIBLE' when 2 then 'HISTORICAL' else 'PRESENT' end as assertion_status from
    (select entity_id, case when r is null then 9 else length(r) % 4 end as k from (select entity_id, min(reasoning) as r from llm_entities where entity_text is not null group by 1) a) b) c group by 1""")
def build_assertions(spark, d):
    e = table(spark, d, "llm_entities").where("entity_text is not null").groupBy("entity_id").agg(F.min("reasoning").alias("r"))
    k = F.when(F.col("r").isNull(), 9).otherwise(F.length("r") % 4)
    entities = e.select("entity_id", F.col("entity_id").alias("chart_id"), F.col("entity_id").alias("entity_text"))
    said = F.when(k == 0, "ABSENT").when(k == 1, "POSSIBLE").when(k == 2, "HISTORICAL")
    parsed = e.select(F.col("entity_id").alias("chart_id"), F.col("entity_id").alias("entity_text"), F.lit(0.9).alias("confidence"), said.alias("assertion_status"), F.lit(None).cast("string").alias("negation_trigger"), F.lit("CURRENT").alias("temporality"), F.lit("PATIENT").alias("experiencer"), F.lit("DEFINITE").alias("certainty"))
    return extraction.build_assertions(entities, parsed).groupBy("assertion_status").agg(F.count("*").alias("n"))


# --- the catalog of tables ---


@query("""select resolution_path, count(*) as n from (select case when resolution_path = 'DISPUTED_UNRESOLVED' and confidence >= 0.8 then 'HUMAN_ACCEPTED' when code_type = 'LOINC' and resolution_path = 'LLM_ASSIGNED' then 'ONTOLOGY_DIRECT' else resolution_path end as resolution_path
    from (select resolution_path, confidence, 'ICD-10' as code_type from icd10_mappings union all select resolution_path, confidence, 'LOINC' from loinc_mappings) t) u group by 1 union all select 'ADDED', 1""", roles=MAPS)
def catalog_writes(spark, d):
    """Tables created, filled by a union, updated by condition and by a merge, appended to and read through a view with a parameter."""
    schema = "mapping_id string, code_type string, resolution_path string, confidence double, at timestamp"
    catalog = Catalog(spark, _folder(spark, "catalog"), {"reviews": schema, "gone": schema})
    catalog.bootstrap()
    parts = [role(spark, d, m).select("mapping_id", F.lit(k).alias("k"), "resolution_path", "confidence") for m, k in zip(MAPS, ("ICD-10", "LOINC"))]
    catalog.insert_union("reviews", *parts)
    catalog.update_where("reviews", (F.col("resolution_path") == "DISPUTED_UNRESOLVED") & (F.col("confidence") >= 0.8), {"resolution_path": F.lit("HUMAN_ACCEPTED")})
    source = parts[1].where("resolution_path = 'LLM_ASSIGNED'").select("mapping_id", F.lit("ONTOLOGY_DIRECT").alias("path"))
    catalog.merge_update("reviews", source, "mapping_id", {"resolution_path": F.col("s.path")})
    catalog.insert_values("reviews", id_column="mapping_id", at_column="at", resolution_path="ADDED")
    catalog.create_view("paths", "select resolution_path, count(*) as n from {reviews} group by 1")
    assert catalog.first_of(["gone", "reviews"]) is not None
    return catalog.sql("select * from {paths} where n >= :least", {"least": 1})


@query("""with c as (select max(chart_id) as id from icd10_mappings) select 'chart' as part, count(*) as n from charts, c where chart_id = id union all select 'sections', count(*) from document_sections, c where chart_id = id
    union all select 'entities', count(*) from merged_entities, c where chart_id = id union all select 'mappings', count(*) from icd10_mappings, c where chart_id = id""", roles=("icd10_mappings",))
def chart_lineage(spark, d):
    mappings = role(spark, d, "icd10_mappings")
    parts = serving.chart_lineage(mappings.agg(F.max("chart_id")).head()[0], table(spark, d, "charts"), table(spark, d, "document_sections"), table(spark, d, "merged_entities"), mappings)
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts.items()])


ORACLE["chart_lineage"] = ORACLE["chart_lineage"].replace(" with c as (", ", c as (", 1)


@query()
def section_fallback(spark, d):
    """Sections by a model for the notes the rules give none."""
    charts = table(spark, d, "charts").select("chart_id", "raw_text").distinct()
    ruled = sections.segment_sections(charts)
    return sections.segment_sections_fallback(charts, ruled).groupBy("section_type").agg(F.count("*").alias("n_sections"), F.countDistinct("chart_id").alias("n_charts"))
