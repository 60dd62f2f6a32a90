"""Registered queries of the clinical operators, each with its oracle SQL next to it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clinical import norm_term
from ..operators import coding, dictionary_match, extraction, feedback, merge, quality, sections, serving
from ..operators.pipeline import unprocessed
from ..sources import ontology
from ..sources.tables import table
from ..streaming.jobs import event_rates
from .roles import ROLES, role, with_roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, roles: tuple[str, ...] = ()):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = with_roles(sql, *roles) if roles else sql
        return f

    return register


# --- text layer and sections ---


@query("""select coalesce(extraction_method, case when length(raw_text) >= 100 then 'digital_text_layer' end) as extraction_method,
    coalesce(length(raw_text) > 100 and regexp_matches(raw_text, '[A-Za-z]{4,}'), false) as has_text_layer, count(*) as n_charts, count(distinct chart_id) as n_distinct from charts group by 1, 2""")
def text_layer_triage(spark, d):
    return sections.classify_text_layer(table(spark, d, "charts")).groupBy("extraction_method", "has_text_layer").agg(F.count("*").alias("n_charts"), F.countDistinct("chart_id").alias("n_distinct"))


@query("""select doc_type, count(*) as n, count(*) filter (where coalesce(length(trim(text)) >= 100 and length(regexp_replace(text, '[^\\p{L}]', '', 'g')) / nullif(length(trim(text)), 0) >= 0.4
    and regexp_matches(lower(text), 'patient|history|diagnosis|medication|assessment|exam|allerg|plan|treatment|symptom'), false)) as n_meaningful from documents group by 1""")
def meaningful_text(spark, d):
    return table(spark, d, "documents").groupBy("doc_type").agg(F.count("*").alias("n"), F.count_if(sections.is_meaningful(F.col("text"))).alias("n_meaningful"))


@query()
def section_segmentation(spark, d):
    charts = table(spark, d, "charts").select("chart_id", "raw_text").distinct()
    return sections.segment_sections(charts).select("chart_id", "section_order", "section_type", F.length("section_text").alias("n_chars"))


@query()
def section_segmentation_exact(spark, d):
    charts = table(spark, d, "charts").select("chart_id", "raw_text").distinct()
    return sections.segment_sections_exact(charts).groupBy("section_type").agg(F.count("*").alias("n_sections"))


@query("select section_type, extraction_method, count(*) as n_sections, count(distinct chart_id) as n_charts from document_sections group by 1, 2")
def section_distribution(spark, d):
    return sections.section_distribution(table(spark, d, "document_sections"))


@query("select round(avg(n), 4) as avg_sections, min(n) as min_sections, max(n) as max_sections, round(stddev_samp(n), 4) as std_sections from (select chart_id, count(*) as n from document_sections group by 1) t")
def section_stats(spark, d):
    return sections.sections_per_chart(table(spark, d, "document_sections"))


@query("""with s as (select chart_id, extraction_method as section_method, count(*) as section_count, string_agg(distinct section_type, ',' order by section_type) as section_types from document_sections group by 1, 2)
    select c.chart_id, chart_type, facility, section_method, coalesce(section_count, 0) as section_count, coalesce(section_types, '') as section_types
    from (select distinct chart_id, chart_type, facility from charts) c left join s on c.chart_id = s.chart_id""")
def chart_section_summary(spark, d):
    return sections.chart_section_summary(table(spark, d, "charts"), table(spark, d, "document_sections"))


# --- dictionary ---

_NORM = "trim(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}\\s]', '', 'g'), '\\s+', ' ', 'g'))"
_DICT = (
    "dict as (select distinct trim(s) as term, " + _NORM.format("trim(s)") + " as term_normalized, 'UMLS' as source, case semantic_group when 'DISO' then 'DIAGNOSIS' when 'CHEM' then 'MEDICATION' when 'PROC' then 'PROCEDURE' when 'PHYS' then 'LAB_RESULT' else 'OTHER' end as entity_type, cui as source_code, cui "
    "from (select cui, semantic_group, unnest(list_concat([preferred_name], coalesce(synonyms, []))) as s from umls_concepts) u where trim(s) is not null and " + _NORM.format("trim(s)") + " <> '')"
)


def _dictionary(spark, d):
    return dictionary_match.build_dictionary(umls=table(spark, d, "umls_concepts"))


@query("with " + _DICT + " select source, entity_type, count(*) as n_terms, count(distinct term_normalized) as n_distinct from dict group by 1, 2")
def dictionary_build(spark, d):
    return _dictionary(spark, d).groupBy("source", "entity_type").agg(F.count("*").alias("n_terms"), F.countDistinct("term_normalized").alias("n_distinct"))


_GRAMS = (
    "words as (select chart_id, section_id, list_filter(string_split(" + _NORM.format("section_text") + ", ' '), lambda w: w <> '') as w from document_sections where section_text is not null), "
    "grams as (select distinct chart_id, section_id, array_to_string(list_slice(w, i, i + k - 1), ' ') as ngram from (select chart_id, section_id, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from (select *, unnest(generate_series(1, 5)) as k from words) a where len(w) >= k) b)"
)


@query("with " + _DICT + ", " + _GRAMS + " select chart_id, count(*) as n_matches, count(distinct ngram) as n_terms from (select distinct g.chart_id, g.section_id, g.ngram from grams g join dict on ngram = term_normalized and length(term_normalized) >= 2) m group by 1")
def dict_exact_counts(spark, d):
    grams = dictionary_match.extract_ngrams(table(spark, d, "document_sections"))
    hits = dictionary_match.match_exact(grams, _dictionary(spark, d))
    return hits.select("chart_id", "section_id", "matched_term").distinct().groupBy("chart_id").agg(F.count("*").alias("n_matches"), F.countDistinct("matched_term").alias("n_terms"))


@query("with " + _DICT + ", " + _GRAMS + """, terms as (select distinct term_normalized as t from dict where length(term_normalized) >= 6), texts as (select distinct ngram as x from grams where length(ngram) >= 6 and ngram not in (select t from terms)),
    tt as (select t, unnest(list_distinct(list_filter(string_split(t, ' '), lambda w: length(w) >= 3))) as w from terms), tx as (select x, unnest(list_distinct(list_filter(string_split(x, ' '), lambda w: length(w) >= 3))) as w from texts),
    pairs as (select distinct x, t, levenshtein(regexp_replace(x, '[^\\x00-\\x7f]', '?', 'g'), regexp_replace(t, '[^\\x00-\\x7f]', '?', 'g')) as distance from tx join tt on tx.w = tt.w and abs(length(x) - length(t)) <= 2)
    select x as ngram, t as term_normalized, cast(distance as int) as distance, round(1 - distance / cast(greatest(length(x), length(t)) as double), 6) as score from pairs where distance between 1 and 2 and round(1 - distance / cast(greatest(length(x), length(t)) as double), 6) >= 0.85""")
def dict_fuzzy_pairs(spark, d):
    grams = dictionary_match.extract_ngrams(table(spark, d, "document_sections"))
    return dictionary_match.fuzzy_pairs(grams, _dictionary(spark, d))


_ABBREVIATIONS = [("TEMP", "Body temperature", "lab", None), ("PLT", "Platelet count", "lab", None), ("WBC", "Leukocyte count", "lab", None), ("SpO2", "Oxygen saturation", "lab", None), ("H/T", "Body height", "lab", None)]


@query("with abb as (select * from (values ('TEMP', 'body temperature'), ('PLT', 'platelet count'), ('WBC', 'leukocyte count'), ('SPO2', 'oxygen saturation'), ('HT', 'body height')) v(k, t)), "
    "tok as (select distinct section_id, upper(regexp_replace(t, '[^\\p{L}\\p{N}]', '', 'g')) as k from (select section_id, unnest(regexp_split_to_array(section_text, '\\s+')) as t from document_sections where section_text is not null) x) "
    "select t as matched_term, count(distinct section_id) as n_sections from tok join abb using (k) group by 1")
def abbreviation_expand(spark, d):
    abbreviations = spark.createDataFrame(_ABBREVIATIONS, "abbreviation string, expansion string, category string, context_hint string")
    hits = dictionary_match.match_abbreviation(table(spark, d, "document_sections"), abbreviations, _dictionary(spark, d))
    return hits.groupBy("matched_term").agg(F.countDistinct("section_id").alias("n_sections"))


@query("select match_type, count(*) as n_entities, count(distinct chart_id) as n_charts, round(round(avg(match_score), 10), 4) as avg_score from dictionary_entities group by 1")
def dict_match_types(spark, d):
    return table(spark, d, "dictionary_entities").groupBy("match_type").agg(F.count("*").alias("n_entities"), F.countDistinct("chart_id").alias("n_charts"), F.round(F.round(F.avg("match_score"), 10), 4).alias("avg_score"))


@query("select matched_term, entity_type, count(*) as n, count(distinct chart_id) as n_charts from dictionary_entities group by 1, 2 order by n desc, matched_term, entity_type limit 20")
def dict_top_terms(spark, d):
    g = table(spark, d, "dictionary_entities").groupBy("matched_term", "entity_type").agg(F.count("*").alias("n"), F.countDistinct("chart_id").alias("n_charts"))
    return g.orderBy(F.desc("n"), "matched_term", "entity_type").limit(20)


@query("select (select count(distinct chart_id) from charts) as n_charts, (select count(distinct chart_id) from dictionary_entities) as n_covered, (select count(*) from dictionary_entities) as n_entities")
def dict_coverage(spark, d):
    entities = table(spark, d, "dictionary_entities")
    charts = table(spark, d, "charts").agg(F.countDistinct("chart_id").alias("n_charts"))
    return charts.crossJoin(entities.agg(F.countDistinct("chart_id").alias("n_covered"), F.count("*").alias("n_entities")))  # one row each


# --- merge ---

_NT = "lower(trim(regexp_replace(entity_text, '\\s+', ' ', 'g'), ' '))"
_LAYERS = f"""layers as (
    select entity_id, chart_id, section_id, entity_type, entity_text, {_NT} as nt, 'dictionary' as source, match_score as conf, cui, null as value, null as unit, start_offset, end_offset from dictionary_entities where entity_text is not null
    union all select entity_id, chart_id, section_id, entity_type, entity_text, {_NT}, 'ner', confidence, null, null, null, start_offset, end_offset from llm_entities where extraction_role = 'explicit' and entity_text is not null
    union all select entity_id, chart_id, section_id, entity_type, entity_text, {_NT}, 'llm', confidence, null, value, unit, start_offset, end_offset from llm_entities where extraction_role in ('implicit', 'abbreviation') and entity_text is not null),
  exact as (select chart_id, entity_type, nt, list_sort(list_distinct(list(source))) as sources, list_sort(list_distinct(list(entity_id))) as ids, count(distinct source) as n_sources, max(conf) as conf, max(cui) as cui,
    max({{'n': length(entity_text), 't': entity_text}}).t as entity_text, min(section_id) as section_id, max({{'w': coalesce(conf, -1), 'v': value}}) filter (where value is not null) as bv, max({{'w': coalesce(conf, -1), 'v': unit}}) filter (where unit is not null) as bu,
    max({{'w': coalesce(conf, -1), 'a': -start_offset, 'b': coalesce(end_offset, -1)}}) filter (where start_offset is not null) as span from layers group by 1, 2, 3)"""


def _normalized(spark, d):
    return merge.normalize_layers(table(spark, d, "dictionary_entities"), role(spark, d, "ner"), role(spark, d, "llm"))


@query("with " + _LAYERS + " select chart_id, entity_type, nt as normalized_text, array_to_string(sources, ',') as sources, array_to_string(ids, ',') as source_entity_ids, n_sources as match_count, cui, -span.a as start_offset, nullif(span.b, -1) as end_offset from exact")
def merge_exact(spark, d):
    return merge.merge_exact(_normalized(spark, d)).select("chart_id", "entity_type", "normalized_text", F.array_join("sources", ",").alias("sources"), F.array_join("source_entity_ids", ",").alias("source_entity_ids"), "match_count", "cui", "start_offset", "end_offset")


@query("with " + _LAYERS + """, pairs as (select a.chart_id, a.entity_type, a.nt as long_text, b.nt as short_text, b.sources, b.ids, b.n_sources from exact a join exact b on a.chart_id = b.chart_id and a.entity_type = b.entity_type and length(a.nt) > length(b.nt) and contains(a.nt, b.nt) where b.nt <> ''),
    gone as (select distinct chart_id, entity_type, short_text from pairs), gain as (select chart_id, entity_type, long_text, flatten(list(sources)) as s, sum(n_sources) as m from pairs group by 1, 2, 3)
    select e.chart_id, e.entity_type, e.nt as normalized_text, array_to_string(list_sort(list_distinct(list_concat(e.sources, coalesce(g.s, [])))), ',') as sources, cast(e.n_sources + coalesce(g.m, 0) as int) as match_count
    from exact e left join gain g on g.chart_id = e.chart_id and g.entity_type = e.entity_type and g.long_text = e.nt
    where not exists (select 1 from gone x where x.chart_id = e.chart_id and x.entity_type = e.entity_type and x.short_text = e.nt)""")
def merge_containment(spark, d):
    rows = merge.merge_containment(merge.merge_exact(_normalized(spark, d)))
    return rows.select("chart_id", "entity_type", "normalized_text", F.array_join("sources", ",").alias("sources"), "match_count")


@query("with " + _LAYERS + """ select entity_type, count(*) as n_entities, sum(n_sources) as n_sources from (
    select chart_id, entity_type, cui, sum(n_sources) as n_sources from exact where cui is not null group by 1, 2, 3 union all select chart_id, entity_type, cui, n_sources from exact where cui is null) t group by 1""")
def merge_concept(spark, d):
    rows = merge.merge_concept(merge.merge_exact(_normalized(spark, d)))
    return rows.groupBy("entity_type").agg(F.count("*").alias("n_entities"), F.sum("match_count").alias("n_sources"))


@query("""select entity_id, round(case when n >= 3 then 0.95e0 + (l % 30) / 1000.0e0 when n = 2 then 0.85e0 + (l % 70) / 1000.0e0 when list_contains(sources, 'dictionary') then 0.78e0 + (l % 20) / 1000.0e0
    when list_contains(sources, 'ner') then 0.73e0 + (l % 20) / 1000.0e0 when list_contains(sources, 'llm') then 0.65e0 + (l % 100) / 1000.0e0 else 0.70e0 end, 6) as score
    from (select distinct entity_id, sources, len(list_distinct(sources)) as n, length(entity_text) as l from merged_entities where entity_text is not null) t""")
def ensemble_score(spark, d):
    rows = table(spark, d, "merged_entities").where("entity_text is not null").select("entity_id", "sources", "entity_text").distinct()
    return rows.select("entity_id", "sources", F.length("entity_text").alias("_l"), merge.ensemble_score(F.col("sources"), F.col("entity_text")).alias("score")).distinct().select("entity_id", "score")


@query("with " + _LAYERS + """, pairs as (select a.chart_id, a.entity_type, a.nt as long_text, b.nt as short_text, b.sources from exact a join exact b on a.chart_id = b.chart_id and a.entity_type = b.entity_type and length(a.nt) > length(b.nt) and contains(a.nt, b.nt) where b.nt <> ''),
    gone as (select distinct chart_id, entity_type, short_text from pairs), gain as (select chart_id, entity_type, long_text, flatten(list(sources)) as s from pairs group by 1, 2, 3),
    kept as (select e.* exclude (sources), list_distinct(list_concat(e.sources, coalesce(g.s, []))) as sources from exact e left join gain g on g.chart_id = e.chart_id and g.entity_type = e.entity_type and g.long_text = e.nt
        where not exists (select 1 from gone x where x.chart_id = e.chart_id and x.entity_type = e.entity_type and x.short_text = e.nt)),
    longest as (select *, max({'n': length(entity_text), 't': entity_text, 'x': nt}) over (partition by chart_id, entity_type, cui) as l from kept where cui is not null),
    concepts as (select chart_id, entity_type, cui, max(l).t as entity_text, max(l).x as nt, list_distinct(flatten(list(sources))) as sources, min(section_id) as section_id, max({'w': coalesce(conf, -1), 'v': bv.v}) filter (where bv.v is not null) as bv, max({'w': coalesce(conf, -1), 'v': bu.v}) filter (where bu.v is not null) as bu from longest group by 1, 2, 3
        union all select chart_id, entity_type, cui, entity_text, nt, sources, section_id, bv, bu from kept where cui is null),
    first_text as (select section_id, arg_min(section_text, {'o': coalesce(section_order, 1073741824), 't': section_text}) as t from document_sections where section_text is not null group by 1)
    select concat('ENT-MERGED-', substring(sha256(concat_ws('|', coalesce(concat('=', chart_id), ''), coalesce(concat('=', entity_type), ''), coalesce(concat('=', nt), ''))), 1, 16)) as entity_id, chart_id, entity_type, entity_text, cui, bv.v as value, bu.v as unit, cast(len(sources) as int) as match_count,
        round(case when len(sources) >= 3 then 0.95e0 + (length(entity_text) % 30) / 1000.0e0 when len(sources) = 2 then 0.85e0 + (length(entity_text) % 70) / 1000.0e0 when list_contains(sources, 'dictionary') then 0.78e0 + (length(entity_text) % 20) / 1000.0e0
            when list_contains(sources, 'ner') then 0.73e0 + (length(entity_text) % 20) / 1000.0e0 else 0.65e0 + (length(entity_text) % 100) / 1000.0e0 end, 6) as ensemble_confidence, cast(length(f.t) as int) as context_chars
    from concepts c left join first_text f on f.section_id = c.section_id""")
def merged_entities(spark, d):
    rows = merge.merge_layers(table(spark, d, "dictionary_entities"), role(spark, d, "ner"), role(spark, d, "llm"), table(spark, d, "document_sections"))
    return rows.select("entity_id", "chart_id", "entity_type", "entity_text", "cui", "value", "unit", "match_count", "ensemble_confidence", F.length("entity_context").alias("context_chars"))


@query("""select coalesce(list_contains(sources, 'dictionary'), false) as in_dictionary, coalesce(list_contains(sources, 'ner'), false) as in_ner, coalesce(list_contains(sources, 'llm'), false) as in_llm,
    count(*) as n_entities, round(round(avg(ensemble_confidence), 10), 4) as avg_confidence from merged_entities group by 1, 2, 3""")
def layer_venn(spark, d):
    return quality.layer_venn(table(spark, d, "merged_entities"))


_FLAGS = "(select *, list_contains(sources, 'dictionary') as d, list_contains(sources, 'ner') as n, list_contains(sources, 'llm') as m, len(list_distinct(sources)) as k from merged_entities)"
_FOUND = "count(*) filter (where d) as dict_found, count(*) filter (where n) as ner_found, count(*) filter (where m) as llm_found, count(*) filter (where d and not n and not m) as dict_unique, count(*) filter (where n and not d and not m) as ner_unique, count(*) filter (where m and not d and not n) as llm_unique"


@query(f"""select entity_type, count(*) as total, {_FOUND}, count(*) filter (where len(sources) >= 2) as multi_source, round(round(avg(ensemble_confidence), 10), 4) as avg_confidence from {_FLAGS} group by 1""")
def layer_by_type(spark, d):
    return quality.layer_by_type(table(spark, d, "merged_entities"))


@query(f"""select count(*) as total_entities, {_FOUND}, count(*) filter (where d and n and m) as all_three, count(*) filter (where d and n and not m) as dict_and_ner_only, count(*) filter (where d and m and not n) as dict_and_llm_only, count(*) filter (where n and m and not d) as ner_and_llm_only,
    round(round(avg(ensemble_confidence) filter (where k = 1), 10), 6) as avg_conf_single_source, round(round(avg(ensemble_confidence) filter (where k = 2), 10), 6) as avg_conf_two_sources, round(round(avg(ensemble_confidence) filter (where k = 3), 10), 6) as avg_conf_three_sources from {_FLAGS}""")
def layer_contribution(spark, d):
    return quality.layer_contribution(table(spark, d, "merged_entities"))


@query("select source, count(*) as total, count(*) filter (where k = 1) as unique_count from (select len(sources) as k, unnest(list_distinct(sources)) as source from merged_entities) t where source in ('dictionary', 'ner', 'llm') group by 1")
def totals_per_source(spark, d):
    return quality.totals_per_source(table(spark, d, "merged_entities"))


@query(f"select case when d and m then 'both' when d then 'dictionary_only' when m then 'llm_only' else 'other' end as source_category, count(*) as entity_count, round(round(avg(ensemble_confidence), 10), 3) as avg_confidence from {_FLAGS} group by 1")
def source_categories(spark, d):
    return quality.source_categories(table(spark, d, "merged_entities"))


@query("select array_to_string(list_sort(list_distinct(sources)), ' + ') as source_group, match_count, count(*) as n from merged_entities group by 1, 2")
def source_groups(spark, d):
    return table(spark, d, "merged_entities").groupBy(merge.source_group(F.col("sources")).alias("source_group"), "match_count").agg(F.count("*").alias("n"))


@query("select chart_id, count(*) as n_pending from charts c where chart_id is not null and not exists (select 1 from dictionary_entities e where e.chart_id = c.chart_id) group by 1")
def incremental_second_run(spark, d):
    return unprocessed(table(spark, d, "charts"), table(spark, d, "dictionary_entities")).groupBy("chart_id").agg(F.count("*").alias("n_pending"))


# --- coding ---


def _active(spark, d):
    return coding.active_entities(table(spark, d, "merged_entities"), role(spark, d, "assertions"), role(spark, d, "icd10_mappings").where("resolution_path in ('ONTOLOGY_DIRECT', 'HUMAN_ACCEPTED')"))


_ACTIVE = """active as (select m.* from merged_entities m where not exists (select 1 from (select distinct e from (select entity_id as e, unnest(source_entity_ids) as s from merged_entities) x
    join assertions a on a.entity_id = x.s where a.assertion_status <> 'PRESENT' or a.experiencer <> 'PATIENT' or a.temporality <> 'CURRENT') b where b.e = m.entity_id)
    and m.entity_id not in (select entity_id from icd10_mappings where resolution_path in ('ONTOLOGY_DIRECT', 'HUMAN_ACCEPTED') and entity_id is not null))"""


@query("select * from (select entity_type, count(*) as n, count(distinct entity_id) as n_ids from active group by 1) t", roles=("assertions", "icd10_mappings"))
def active_entities(spark, d):
    return _active(spark, d).groupBy("entity_type").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("n_ids"))


ORACLE["active_entities"] = ORACLE["active_entities"].replace(" select * from (select entity_type", ", " + _ACTIVE + " select * from (select entity_type")


@query("with " + _DICT + " select entity_id, d.cui as source_code, count(*) as n from merged_entities m join dict d on " + _NORM.format("m.entity_text") + " = d.term_normalized group by 1, 2")
def tier1_exact(spark, d):
    rows = coding.tier1_exact(table(spark, d, "merged_entities"), _dictionary(spark, d))
    return rows.groupBy("entity_id", "source_code").agg(F.count("*").alias("n"))


_TIER1 = """terms as (select distinct term_normalized as t from dict), done as (select distinct entity_id from merged_entities m join dict on """ + _NORM.format("m.entity_text") + """ = term_normalized),
    rest as (select distinct entity_id, """ + _NORM.format("entity_text") + """ as key from merged_entities where entity_text is not null and entity_id not in (select entity_id from done)),
    tk as (select distinct key, unnest(list_distinct(list_filter(string_split(key, ' '), lambda w: length(w) >= 3))) as w from rest where key <> ''), tt as (select t, unnest(list_distinct(list_filter(string_split(t, ' '), lambda w: length(w) >= 3))) as w from terms),
    pairs as (select distinct key, t, levenshtein(regexp_replace(key, '[^\\x00-\\x7f]', '?', 'g'), regexp_replace(t, '[^\\x00-\\x7f]', '?', 'g')) as distance from tk join tt on tk.w = tt.w and abs(length(key) - length(t)) <= 5),
    best as (select key, min({'d': distance, 't': t}) as m from pairs where distance <= greatest(floor(length(key) * 0.3e0), 3) group by 1)"""


@query("with " + _DICT + ", " + _TIER1 + " select distinct entity_id, m.t as term_normalized, cast(m.d as int) as edit_distance, round(greatest(0.92e0 - 0.01e0 * m.d, 0.80e0), 3) as tier1_confidence from rest join best using (key)")
def tier1_fuzzy(spark, d):
    merged, dictionary = table(spark, d, "merged_entities"), _dictionary(spark, d)
    rows = coding.tier1_fuzzy(merged, coding.tier1_exact(merged, dictionary), dictionary)
    return rows.select("entity_id", "term_normalized", "edit_distance", "tier1_confidence").distinct()


@query("with " + _DICT + ", " + _TIER1 + " select 'exact' as tier1_method, count(distinct entity_id) as n_entities from done union all select 'fuzzy', count(distinct entity_id) from rest join best using (key)")
def tier1_all(spark, d):
    merged, dictionary = table(spark, d, "merged_entities"), _dictionary(spark, d)
    exact = coding.tier1_exact(merged, dictionary)
    return coding.tier1_all(exact, coding.tier1_fuzzy(merged, exact, dictionary)).groupBy("tier1_method").agg(F.countDistinct("entity_id").alias("n_entities"))


def _part_entities(spark, d):
    """Diagnoses named like reference descriptions, for the code joins."""
    return table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("entity_id"), F.lit("C1").alias("chart_id"), F.lit("DIAGNOSIS").alias("entity_type"), F.col("p_name").alias("entity_text"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("unit"))


_ICD_PATHS = """
    , d as (select description as term, 'ICD10' as source, code as source_code, null as cui from icd_ref where is_billable and description is not null union select concept_name, 'SNOMED', concept_id, cui from snomed_terms),
    hits as (select distinct p_partkey, source, source_code, cui from part join d on """ + _NORM.format("p_name") + " = " + _NORM.format("term") + """),
    first as (select snomed_concept_id, icd10_code from snomed_map where map_priority = 1),
    own as (select p_partkey, code as icd10_code, 1.0e0 as weight, 'ICD10' as match_source from hits join (select min(code) as code, upper(code_raw) as raw from icd_ref where is_billable group by 2) r on upper(replace(source_code, '.', '')) = raw where source = 'ICD10'),
    via as (select p_partkey, f.icd10_code, 0.95e0 as weight, h.source as match_source from hits h join (select distinct cui, concept_id from snomed_terms where cui is not null) t on t.cui = h.cui join first f on f.snomed_concept_id = t.concept_id
        union all select p_partkey, f.icd10_code, 0.96e0, 'SNOMED' from hits h join first f on f.snomed_concept_id = h.source_code where h.source = 'SNOMED'),
    ranked as (select *, row_number() over (partition by p_partkey order by round(0.98e0 * weight, 4) desc, icd10_code, match_source) as r from (select * from own union all select * from via) u)
    select cast(p_partkey as string) as entity_id, icd10_code, round(0.98e0 * weight, 4) as confidence from ranked where r = 1"""


@query("select 1", roles=("icd_ref", "snomed_terms", "snomed_map"))
def resolve_icd10(spark, d):
    terms = role(spark, d, "snomed_terms")
    # Codes of an ontology's own terms, the concepts of those terms, and their map to codes.
    snomed = terms.select(F.col("concept_name").alias("term"), F.lit("SNOMED").alias("source"), F.lit("DIAGNOSIS").alias("entity_type"), F.col("concept_id").alias("source_code"), "cui")
    snomed = snomed.withColumn("term_normalized", norm_term(F.col("term"))).select(*dictionary_match.ENTRY)
    dictionary = dictionary_match.build_dictionary(icd10=role(spark, d, "icd_ref")).unionByName(snomed)
    return coding.resolve_icd10_exact(_part_entities(spark, d), role(spark, d, "icd_ref"), dictionary, role(spark, d, "snomed_map")).select("entity_id", "icd10_code", "confidence")


ORACLE["resolve_icd10"] = ORACLE["resolve_icd10"].removesuffix(" select 1") + _ICD_PATHS


def _labs(spark, d):
    least = lambda c: F.min(c).alias(c)
    return table(spark, d, "merged_entities").where("entity_type = 'LAB_RESULT' and entity_text is not null").groupBy("entity_id").agg(*map(least, ("chart_id", "entity_type", "entity_text", "specimen_type", "method", "timing")))


@query("with labs as (select entity_id, min(entity_text) as entity_text, min(specimen_type) as specimen_type, min(method) as method, min(timing) as timing from merged_entities where entity_type = 'LAB_RESULT' and entity_text is not null group by 1), "
    "ref as (select cui as code, preferred_name as name, string_split(" + _NORM.format("preferred_name") + ", ' ')[1] as word from umls_concepts where semantic_type in ('Laboratory Procedure', 'Clinical Attribute')), "
    "own as (select entity_id, code, 0.98e0 as confidence, 'LOINC' as source from labs join ref on " + _NORM.format("entity_text") + " = " + _NORM.format("name") + "), "
    "axes as (select entity_id, code, contains(lower(name), lower(entity_text)) as a, coalesce(specimen_type <> '' and contains(lower(name), lower(specimen_type)), false) as b, coalesce(l.method <> '' and contains(lower(name), lower(l.method)), false) as c, coalesce(timing <> '' and contains(lower(name), lower(timing)), false) as t "
    "from labs l join ref on string_split(" + _NORM.format("entity_text") + ", ' ')[1] = word where word <> '' and entity_id not in (select entity_id from own)), "
    "every as (select * from own union all select entity_id, code, round(0.88e0 + 0.015e0 * (3 * a::int + 2 * b::int + 2 * c::int + t::int), 3), 'LOINC axes' from axes where a or b or c) "
    "select entity_id, code as loinc_code, confidence from (select *, row_number() over (partition by entity_id order by confidence desc, code, source) as r from every) x where r = 1")
def resolve_loinc(spark, d):
    ref = table(spark, d, "umls_concepts").where("semantic_type in ('Laboratory Procedure', 'Clinical Attribute')").select(F.col("cui").alias("loinc_code"), F.col("preferred_name").alias("long_name"), F.col("preferred_name").alias("component"), F.lit(None).cast("string").alias("system_specimen"), F.lit(None).cast("string").alias("method"))
    labs = _labs(spark, d)
    matches = coding.tier1_exact(labs, dictionary_match.build_dictionary(loinc=ref))
    return coding.resolve_loinc(matches, labs, ref).select("entity_id", "loinc_code", "confidence")


@query("""with t as (select distinct chart_id, entity_id, entity_type, entity_text, value, unit from merged_entities where entity_type = 'LAB_RESULT'), n as (select chart_id, cast(ceil(count(*) / 200.0e0) as bigint) as parts from t group by 1),
    l as (select t.chart_id, cast(('0x' || substring(md5(entity_id), 1, 8))::bigint % parts as int) as part, entity_id, concat('- ', entity_id, ' | ', coalesce(entity_type, ''), ' | ', coalesce(entity_text, ''), ' | ', coalesce(value, ''), ' | ', coalesce(unit, '')) as line from t join n on n.chart_id = t.chart_id)
    select chart_id, part, cast(count(*) as int) as n_entities, string_agg(line, chr(10) order by entity_id, line) as prompt from l group by 1, 2""")
def chart_prompts(spark, d):
    rows = table(spark, d, "merged_entities").where("entity_type = 'LAB_RESULT'").select("chart_id", "entity_id", "entity_type", "entity_text", "value", "unit").distinct()
    return coding.chart_prompts(rows).select("chart_id", "part", "n_entities", "prompt")


def _model_codes(spark, d):
    return role(spark, d, "mappings").where("resolution_path = 'LLM_ASSIGNED'").select("mapping_id", F.col("mapping_id").alias("entity_id"), "chart_id", "code", F.lit(None).cast("string").alias("description"), "confidence")


@query("""select m.mapping_id, r.description as final_description, round(case when r.code is null then 0.6e0 when r.is_billable then m.confidence else greatest(m.confidence - 0.05e0, 0.6e0) end, 4) as final_confidence, r.code is not null as code_validated
    from mappings m left join icd_ref r on r.code = m.code where m.resolution_path = 'LLM_ASSIGNED'""", roles=("mappings", "icd_ref"))
def validate_codes(spark, d):
    return coding.validate_icd10(_model_codes(spark, d), role(spark, d, "icd_ref")).select("mapping_id", "final_description", "final_confidence", "code_validated")


@query("""select chart_id, entity_id, code, confidence from (select chart_id, mapping_id as entity_id, code, case when cast(mapping_id as bigint) % 3 = 0 then 0.75e0 else confidence end as confidence from mappings where resolution_path = 'LLM_ASSIGNED') t""", roles=("mappings",))
def parse_codes(spark, d):
    rows = _model_codes(spark, d)
    answer = F.to_json(F.array(F.struct(F.when(F.col("mapping_id").cast("long") % 2 == 0, F.col("mapping_id")).alias("entity_id"), "code", F.when(F.col("mapping_id").cast("long") % 3 != 0, F.col("confidence").cast("string")).alias("confidence"))))
    raw = rows.select("chart_id", F.array("mapping_id").alias("entity_ids"), F.concat(F.lit("```json\n"), answer, F.lit("\n```")).alias("coding_result"))
    return coding.parse_codes(raw).select("chart_id", "entity_id", "code", "confidence")


@query("""select m.entity_type, count(*) as total_entities, count(i.entity_id) as icd10_coded, count(l.entity_id) as loinc_coded, count(u.entity_id) as umls_mapped, round(100.0e0 * greatest(count(i.entity_id), count(l.entity_id)) / greatest(count(*), 1), 1) as coding_pct
    from (select distinct entity_id, entity_type from merged_entities) m left join (select distinct entity_id from icd10_mappings) i on i.entity_id = m.entity_id left join (select distinct entity_id from loinc_mappings) l on l.entity_id = m.entity_id
    left join (select distinct entity_id from umls_mappings) u on u.entity_id = m.entity_id group by 1""", roles=("icd10_mappings", "loinc_mappings", "umls_mappings"))
def coding_coverage(spark, d):
    return coding.coverage_by_type(table(spark, d, "merged_entities"), role(spark, d, "icd10_mappings"), role(spark, d, "loinc_mappings"), role(spark, d, "umls_mappings"))


@query("""select resolution_path, count(*) as count, round(round(avg(confidence), 10), 3) as avg_confidence, round(min(confidence), 3) as min_confidence, round(max(confidence), 3) as max_confidence, count(*) filter (where not (code like '%.9%' or length(replace(code, '.', '')) < 5)) as specific_count from icd10_mappings group by 1""", roles=("icd10_mappings",))
def icd10_paths(spark, d):
    return quality.resolution_paths(role(spark, d, "icd10_mappings"))


@query("""select resolution_path, count(*) as count, round(round(avg(confidence), 10), 3) as avg_confidence, round(min(confidence), 3) as min_confidence, round(max(confidence), 3) as max_confidence from loinc_mappings group by 1""", roles=("loinc_mappings",))
def loinc_paths(spark, d):
    return quality.resolution_paths(role(spark, d, "loinc_mappings")).drop("specific_count")


@query("""select tier1_icd10, tier1_loinc, tier2_icd10, tier2_loinc, round(100.0e0 * (tier1_icd10 + tier1_loinc) / greatest(tier1_icd10 + tier1_loinc + tier2_icd10 + tier2_loinc, 1), 1) as tier1_pct, round(100.0e0 * (tier2_icd10 + tier2_loinc) / greatest(tier1_icd10 + tier1_loinc + tier2_icd10 + tier2_loinc, 1), 1) as tier2_pct from
    (select (select count(*) from icd10_mappings where resolution_path = 'ONTOLOGY_DIRECT') as tier1_icd10, (select count(*) from loinc_mappings where resolution_path = 'ONTOLOGY_DIRECT') as tier1_loinc, (select count(*) from icd10_mappings where resolution_path = 'LLM_ASSIGNED') as tier2_icd10, (select count(*) from loinc_mappings where resolution_path = 'LLM_ASSIGNED') as tier2_loinc) t""", roles=("icd10_mappings", "loinc_mappings"))
def tier_totals(spark, d):
    return quality.tier_totals(role(spark, d, "icd10_mappings"), role(spark, d, "loinc_mappings"))


# --- feedback ---


@query("select concat('GOLD-', substring(sha256(concat(coalesce(chart_id, ''), '|', coalesce(entity_type, ''), '|', coalesce(entity_text, ''), '|', coalesce(annotator_id, ''))), 1, 12)) as gold_id, count(*) as n from gold_annotations group by 1")
def gold_ids(spark, d):
    g = table(spark, d, "gold_annotations")
    return g.groupBy(feedback.gold_id(*[F.col(c) for c in ("chart_id", "entity_type", "entity_text", "annotator_id")]).alias("gold_id")).agg(F.count("*").alias("n"))


_KEYS = "select distinct chart_id, upper(trim(entity_type, ' ')) as t, lower(trim(entity_text, ' ')) as x from {0} where entity_text is not null"
_SETS = "f as (" + _KEYS.format("merged_entities") + "), g as (" + _KEYS.format("gold_annotations") + " and annotation_round = (select max(annotation_round) from gold_annotations)), k as (select coalesce(f.t, g.t) as entity_type, coalesce(f.chart_id, g.chart_id) as chart_id, coalesce(f.x, g.x) as x, f.x is not null as f, g.x is not null as g from f full join g on f.chart_id = g.chart_id and f.t = g.t and f.x = g.x)"
_PRF = "count(*) filter (where f and g) as true_positives, count(*) filter (where f and not g) as false_positives, count(*) filter (where g and not f) as false_negatives"
_RATES = "round(true_positives / nullif(true_positives + false_positives, 0), 4) as precision_score, round(true_positives / nullif(true_positives + false_negatives, 0), 4) as recall_score, round(2 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 4) as f1_score"


@query("""with s as (select distinct chart_id, upper(trim(entity_type, ' ')) as t, lower(trim(entity_text, ' ')) as x, annotation_round as r from gold_annotations where annotation_round in (1, 2) and entity_text is not null),
    e as (select max(case when r = 1 then 1 else 0 end) as a, max(case when r = 2 then 1 else 0 end) as b from s group by chart_id, t, x), n as (select count(*) as total, cast(sum(a * b) as bigint) as n_both, cast(sum(a) as bigint) as round1, cast(sum(b) as bigint) as round2 from e)
    select total, n_both, round1, round2, round((n_both / total - pe) / (1 - pe), 4) as kappa from (select *, (round1 / total) * (round2 / total) + (1 - round1 / total) * (1 - round2 / total) as pe from n) t""")
def cohen_kappa(spark, d):
    return feedback.cohen_kappa(table(spark, d, "gold_annotations"))


@query("with " + _SETS + " select *, " + _RATES + " from (select " + _PRF + " from k) t")
def prf_overall(spark, d):
    return feedback.prf_overall(table(spark, d, "merged_entities"), table(spark, d, "gold_annotations"))


@query("with " + _SETS + " select *, " + _RATES + " from (select entity_type, " + _PRF + " from k group by 1) t")
def prf_by_type(spark, d):
    return feedback.prf_by_type(table(spark, d, "merged_entities"), table(spark, d, "gold_annotations"))


@query("with " + _SETS + " select chart_id, entity_type, x as text from k where g and not f")
def missed_entities(spark, d):
    return feedback.missed_entities(table(spark, d, "merged_entities"), table(spark, d, "gold_annotations"))


@query("with " + _SETS + ", n as (select chart_id, count(*) as n from merged_entities group by 1) select case when coalesce(n, 0) >= 30 then 'high (30+)' when coalesce(n, 0) >= 10 then 'medium (10-30)' else 'low (<10)' end as density, count(*) as n_missed, count(distinct k.chart_id) as n_charts from k left join n on n.chart_id = k.chart_id where g and not f group by 1")
def missed_density(spark, d):
    merged, gold = table(spark, d, "merged_entities"), table(spark, d, "gold_annotations")
    return feedback.missed_density(feedback.missed_entities(merged, gold), merged)


@query("""with p as (select chart_id, round(avg(ensemble_confidence), 10) as a, round(stddev_samp(ensemble_confidence), 10) as s, count(*) as entity_count,
    max(case when list_contains(sources, 'dictionary') then 1 else 0 end) + max(case when list_contains(sources, 'ner') then 1 else 0 end) + max(case when list_contains(sources, 'llm') then 1 else 0 end) as active_layers from merged_entities where chart_id is not null group by 1)
    select chart_id, round(a, 4) as avg_confidence, round(s, 4) as confidence_variance, entity_count, active_layers, round(0.4e0 * (1 - a) + 0.3e0 * coalesce(s, 0) + 0.3e0 * (1 - active_layers / 3), 4) as annotation_priority
    from p where not exists (select 1 from gold_annotations g where g.chart_id = p.chart_id) order by annotation_priority desc, chart_id limit 50""")
def annotation_queue(spark, d):
    return feedback.annotation_queue(table(spark, d, "merged_entities"), table(spark, d, "gold_annotations"))


@query("select cast(annotated_at as date) as day, annotator_id, count(*) as n_annotations, count(distinct chart_id) as n_charts from gold_annotations group by 1, 2")
def annotation_throughput(spark, d):
    return feedback.annotation_throughput(table(spark, d, "gold_annotations"))


@query("select cast(run_timestamp as date) as run_date, metric_scope, count(*) as n_runs, round(avg(recall_score), 4) as avg_recall, round(avg(f1_score), 4) as avg_f1 from runs group by 1, 2", roles=("runs",))
def recall_trend(spark, d):
    return feedback.recall_trend(role(spark, d, "runs"))


@query("select run_date, avg_recall, avg_f1, round(avg_recall - lag(avg_recall) over (order by run_date), 5) as recall_delta, round(avg_f1 - lag(avg_f1) over (order by run_date), 5) as f1_delta from (select cast(run_timestamp as date) as run_date, round(avg(recall_score), 6) as avg_recall, round(avg(f1_score), 6) as avg_f1 from runs group by 1) t", roles=("runs",))
def cycle_delta(spark, d):
    return feedback.cycle_delta(role(spark, d, "runs"))


@query("select severity, case when resolved_at is null then 'open' else 'resolved' end as status, count(*) as pattern_count, string_agg(distinct pattern_type, ',' order by pattern_type) as pattern_types, max(detected_at) as last_detected from patterns group by 1, 2", roles=("patterns",))
def error_status(spark, d):
    return feedback.error_pattern_status(role(spark, d, "patterns")).withColumn("pattern_types", F.array_join("pattern_types", ","))


# --- quality ---

_SEC = "s as (select section_id, min(section_type) as section_type from document_sections group by 1)"


@query("with " + _SEC + """ select section_type, count(distinct entity_id) as entities_found, round(round(avg(ensemble_confidence), 10), 4) as avg_confidence, count(distinct case when list_contains(sources, 'dictionary') then entity_id end) as dict_found, count(distinct case when list_contains(sources, 'ner') then entity_id end) as ner_found,
    count(distinct case when list_contains(sources, 'llm') then entity_id end) as llm_found, count(distinct m.chart_id) as charts_with_section, count(*) filter (where ensemble_confidence < 0.7) as low_confidence, round(count(distinct entity_id) / cast(count(distinct m.chart_id) as double), 2) as entities_per_chart from merged_entities m join s using (section_id) group by 1""")
def section_quality(spark, d):
    return quality.section_quality(table(spark, d, "merged_entities"), table(spark, d, "document_sections"))


@query("with " + _SEC + " select section_type, case when ensemble_confidence >= 0.9 then 'high (>=0.9)' when ensemble_confidence >= 0.7 then 'medium (0.7-0.9)' when ensemble_confidence >= 0.5 then 'low (0.5-0.7)' else 'very_low (<0.5)' end as confidence_bin, count(*) as entity_count from merged_entities m join s using (section_id) group by 1, 2")
def confidence_by_section(spark, d):
    return quality.confidence_by_section(table(spark, d, "merged_entities"), table(spark, d, "document_sections"))


@query("""with l as (select chart_id, max(length(raw_text)) as chars from charts group by 1 having max(length(raw_text)) > 0), n as (select chart_id, count(entity_id) as n, round(avg(ensemble_confidence), 10) as c from merged_entities group by 1),
    r as (select chars, coalesce(n, 0) as n, c, coalesce(n, 0) / (chars / 1000.0e0) as density from l left join n on l.chart_id = n.chart_id)
    select case when density >= 20 then '5. very_high (20+/1k chars)' when density >= 10 then '4. high (10-20/1k chars)' when density >= 5 then '3. medium (5-10/1k chars)' when density >= 2 then '2. low (2-5/1k chars)' else '1. sparse (<2/1k chars)' end as density_bin,
    count(*) as chart_count, round(round(avg(n), 10), 1) as avg_entities, round(round(avg(c), 10), 4) as avg_confidence, round(round(avg(chars / 5.0e0), 10), 0) as avg_word_count, round(min(c), 4) as min_confidence, round(max(c), 4) as max_confidence from r group by 1""")
def note_density(spark, d):
    return quality.note_density(table(spark, d, "charts"), table(spark, d, "merged_entities"))


@query("select assertion_status, negation_detected, temporality, experiencer, certainty, count(*) as entity_count, round(round(avg(confidence), 10), 4) as avg_confidence, round(100.0e0 * count(*) / sum(count(*)) over (), 2) as pct from assertions group by 1, 2, 3, 4, 5", roles=("assertions",))
def assertion_distribution(spark, d):
    return quality.assertion_distribution(role(spark, d, "assertions"))


@query("select 'status' as field, assertion_status as name, count(*) as count, round(100.0e0 * count(*) / sum(count(*)) over (), 1) as pct from assertions group by 2 union all select 'experiencer', experiencer, count(*), round(100.0e0 * count(*) / sum(count(*)) over (), 1) from assertions group by 2 union all select 'temporality', temporality, count(*), round(100.0e0 * count(*) / sum(count(*)) over (), 1) from assertions group by 2", roles=("assertions",))
def assertion_shares(spark, d):
    a = role(spark, d, "assertions")
    parts = [quality.assertion_shares(a, c).withColumn("field", F.lit(name)) for name, c in (("status", "assertion_status"), ("experiencer", "experiencer"), ("temporality", "temporality"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("select count(*) as total_classified, round(100.0e0 * count(*) filter (where assertion_status = 'ABSENT') / count(*), 1) as negated_pct, round(100.0e0 * count(*) filter (where assertion_status = 'HISTORICAL') / count(*), 1) as historical_pct, round(100.0e0 * count(*) filter (where assertion_status = 'FAMILY') / count(*), 1) as family_pct from assertions", roles=("assertions",))
def assertion_kpis(spark, d):
    return quality.assertion_kpis(role(spark, d, "assertions"))


@query("""select coalesce(section_type, 'UNKNOWN') as section_type, count(*) as total_assertions, count(*) filter (where negation_detected) as negated_count, round(round(avg(case when negation_detected then confidence end), 10), 4) as avg_negation_confidence, round(100.0e0 * count(*) filter (where negation_detected) / nullif(count(*), 0), 2) as negation_rate_pct
    from assertions a left join (select entity_id, min(section_id) as section_id from llm_entities where section_id is not null group by 1) e using (entity_id) left join (select section_id, min(section_type) as section_type from document_sections group by 1) s using (section_id) group by 1""", roles=("assertions",))
def negation_by_section(spark, d):
    return quality.negation_by_section(role(spark, d, "assertions"), table(spark, d, "llm_entities"), table(spark, d, "document_sections"))


_MAPQ = "select '{1}' as code_type, count(*) as total_mappings, count(code) as mapped_count, count(distinct code) as unique_codes_assigned, round(round(avg(confidence), 10), 4) as avg_confidence, count(*) filter (where resolution_path = 'ONTOLOGY_DIRECT') as via_ontology, count(*) filter (where resolution_path = 'LLM_ASSIGNED') as via_llm, count(*) filter (where resolution_path = 'R1_R2_AGREE') as via_multipass, round(100.0e0 * count(code) / nullif(count(*), 0), 2) as mapping_success_pct from {0}"


@query(_MAPQ.format("icd10_mappings", "ICD-10") + " union all " + _MAPQ.format("loinc_mappings", "LOINC"), roles=("icd10_mappings", "loinc_mappings"))
def mapping_quality(spark, d):
    return quality.mapping_quality(role(spark, d, "icd10_mappings"), "ICD-10").unionByName(quality.mapping_quality(role(spark, d, "loinc_mappings"), "LOINC"))


@query("""select case when length(code) <= 4 then 'category (3-4 char)' when length(code) <= 5 then 'subcategory (5 char)' when length(code) <= 6 then 'specific (6 char)' else 'most_specific (7+ char)' end as specificity_level,
    count(*) as code_count, round(round(avg(confidence), 10), 4) as avg_confidence, round(100.0e0 * count(*) / sum(count(*)) over (), 2) as pct_of_total from lengths where code is not null group by 1""", roles=("mappings",))
def specificity_levels(spark, d):
    # Codes of three to seven characters: the test codes all have five.
    rows = role(spark, d, "mappings").withColumn("code", F.expr("concat(code, substring('XA', 1, cast(mapping_id as bigint) % 3))")).withColumn("code", F.expr("substring(code, 1, cast(7 - cast(mapping_id as bigint) % 5 as int))"))
    return quality.specificity_levels(rows)


ORACLE["specificity_levels"] = ORACLE["specificity_levels"].replace(" select case when length", ", lengths as (select substring(concat(code, substring('XA', 1, cast(cast(mapping_id as bigint) % 3 as int))), 1, cast(7 - cast(mapping_id as bigint) % 5 as int)) as code, confidence from mappings) select case when length", 1)


@query("""select 'ICD-10' as code_system, count(*) as total_assigned, count(r.code) as valid_codes, count(*) - count(r.code) as invalid_codes, round(100.0e0 * count(r.code) / nullif(count(*), 0), 2) as validity_pct from icd10_mappings m left join (select distinct code from icd_ref) r on r.code = m.code where m.code is not null
    union all select 'LOINC', count(*), count(r.code), count(*) - count(r.code), round(100.0e0 * count(r.code) / nullif(count(*), 0), 2) from loinc_mappings m left join (select distinct code from loinc_codes) r on r.code = m.code where m.code is not null""", roles=("icd10_mappings", "loinc_mappings", "icd_ref", "loinc_codes"))
def code_validity(spark, d):
    return quality.code_validity({"ICD-10": role(spark, d, "icd10_mappings"), "LOINC": role(spark, d, "loinc_mappings")}, {"ICD-10": role(spark, d, "icd_ref"), "LOINC": role(spark, d, "loinc_codes")})


@query("select code_type, count(*) as total, count(*) filter (where confidence >= 0.9) as high, count(*) filter (where confidence >= 0.7 and confidence < 0.9) as medium, count(*) filter (where confidence < 0.7) as low, count(*) filter (where resolution_path = 'ONTOLOGY_DIRECT') as direct, count(distinct code) as n_codes, round(avg(confidence), 4) as avg_confidence from mappings group by 1", roles=("mappings",))
def code_quality(spark, d):
    return quality.code_quality(role(spark, d, "mappings"))


@query("""select validation_round, validation_role, count(*) as total_reviews, count(*) filter (where validation_result = 'approved') as approved, count(*) filter (where validation_result = 'rejected') as rejected, count(*) filter (where validation_result = 'modified') as modified,
    round(100.0e0 * count(*) filter (where validation_result = 'approved') / nullif(count(*), 0), 2) as approval_rate_pct from validation group by 1, 2""", roles=("validation",))
def multipass_agreement(spark, d):
    return quality.multipass_agreement(role(spark, d, "validation"))


# --- serving ---

_STATE = "case when resolution_path in ('ARBITER_CHOSE_R1', 'ARBITER_CHOSE_R2') then 'flagged' when resolution_path = 'DISPUTED_UNRESOLVED' then 'needs_review' else 'auto_approved' end"


def _serve(f, sql, **parameters):
    def run(spark, d):
        return f(role(spark, d, "mappings"), **parameters)

    return run, with_roles(sql, "mappings")


_SERVING = {
    "resolution_overview": _serve(serving.resolution_overview, f"select code_type, {_STATE} as state, count(*) as n, round(avg(confidence), 3) as avg_confidence from mappings group by 1, 2"),
    "confidence_bands": _serve(serving.confidence_bands, "select case when confidence >= 0.9 then 'high' when confidence >= 0.7 then 'medium' else 'low' end as band, count(*) filter (where code_type = 'ICD-10') as icd10, count(*) filter (where code_type = 'LOINC') as loinc from mappings group by 1"),
    "confidence_histogram": _serve(serving.confidence_histogram, "select cast(least(floor(round(confidence * 10, 6)), 9) as int) as bin, count(*) filter (where code_type = 'ICD-10') as icd10, count(*) filter (where code_type = 'LOINC') as loinc from mappings group by 1"),
    "charts_per_day": _serve(serving.charts_per_day, "select cast(created_at as date) as day, count(distinct chart_id) as n_charts, count(*) as n_mappings from mappings group by 1 order by day desc limit 14"),
    "review_queue_page": _serve(serving.review_queue, "select * from mappings where resolution_path = 'DISPUTED_UNRESOLVED' order by confidence, mapping_id limit 50 offset 50", status="needs_review", page=2),
    "review_stats": _serve(serving.review_stats, f"select *, round(auto_approved / nullif(total, 0), 4) as agreement_rate from (select count(*) as total, count(*) filter (where {_STATE} = 'auto_approved') as auto_approved, count(*) filter (where {_STATE} = 'flagged') as flagged, count(*) filter (where {_STATE} = 'needs_review') as needs_review from mappings) t"),
    "audit_trail": _serve(serving.audit_trail, "select mapping_id, 'r1' as step, round(case when resolution_path = 'R1_R2_AGREE' then confidence else least(confidence + 0.05e0, 0.99e0) end, 4) as step_confidence from mappings union all select mapping_id, 'r2', round(case when resolution_path = 'R1_R2_AGREE' then confidence else greatest(confidence - 0.03e0, 0.5e0) end, 4) from mappings union all select mapping_id, 'arbiter', round(confidence, 4) from mappings where resolution_path <> 'R1_R2_AGREE'"),
    "top_codes": _serve(serving.top_codes, "select code_type, code, count(*) as n, round(avg(confidence), 3) as avg_confidence from mappings group by 1, 2 order by n desc, code_type, code limit 15"),
    "specificity_split": _serve(serving.specificity_split, "select case when code like '%.9%' or length(replace(code, '.', '')) < 5 then 'unspecified' else 'specific' end as kind, count(*) as n from mappings where code_type = 'ICD-10' group by 1"),
    "low_confidence": _serve(serving.low_confidence, "select mapping_id, code, resolution_path, confidence from mappings where resolution_path <> 'R1_R2_AGREE' order by confidence, mapping_id limit 15"),
    "disambiguation": _serve(serving.disambiguation, "select chart_id, code_type, code, n, score, row_number() over (partition by chart_id, code_type order by score desc, code) = 1 as selected from (select *, round(0.6e0 * n / max(n) over (partition by chart_id, code_type) + 0.4e0 * c, 6) as score, count(*) over (partition by chart_id, code_type) as k from (select chart_id, code_type, code, count(*) as n, round(avg(confidence), 6) as c from mappings group by 1, 2, 3) g) t where k > 1"),
    "coding_tiers": _serve(serving.coding_tiers, "select case when resolution_path = 'ONTOLOGY_DIRECT' then 'tier 1' else 'tier 2' end as tier, code_type, count(*) as n, round(avg(confidence), 4) as avg_confidence from mappings group by 1, 2"),
    "chapter_distribution": _serve(serving.chapter_distribution, "select case substring(code, 1, 1) when 'A' then 'A: Infectious diseases' when 'B' then 'B: Infectious diseases' when 'C' then 'C: Neoplasms' when 'D' then 'D: Blood/immune' when 'E' then 'E: Endocrine/metabolic' when 'F' then 'F: Mental/behavioral' when 'G' then 'G: Nervous system' when 'H' then 'H: Eye/ear' when 'I' then 'I: Circulatory' when 'J' then 'J: Respiratory' when 'K' then 'K: Digestive' when 'L' then 'L: Skin' when 'M' then 'M: Musculoskeletal' when 'N' then 'N: Genitourinary' when 'R' then 'R: Symptoms/signs' when 'Z' then 'Z: Health factors' else concat(substring(code, 1, 1), ': Other') end as chapter, count(*) as n, count(distinct code) as n_codes from mappings where code_type = 'ICD-10' group by 1"),
}
for _name, (_run, _sql) in _SERVING.items():
    QUERIES[_name], ORACLE[_name] = _run, _sql


@query("""with n as (select chart_id, count(distinct entity_id) as n from merged_entities group by 1) select provider, count(*) as n_charts, coalesce(cast(sum(n) as bigint), 0) as n_entities from (select distinct chart_id, provider from charts where provider is not null) c left join n on n.chart_id = c.chart_id group by 1""")
def providers(spark, d):
    return serving.providers(table(spark, d, "charts"), table(spark, d, "merged_entities"))


@query("select entity_text, entity_type, count(*) as n, count(distinct chart_id) as n_charts from merged_entities where entity_text is not null group by 1, 2 order by n desc, entity_text, entity_type limit 20")
def top_entities(spark, d):
    return serving.top_entities(table(spark, d, "merged_entities"))


@query("with recursive edges as (HIERARCHY), walk as (select distinct parent_id as concept_id, 0 as depth from edges where parent_id = 'ROOT' union all select e.concept_id, w.depth + 1 from walk w join edges e on e.parent_id = w.concept_id) select concept_id, min(depth) as depth from walk group by 1")
def is_a_depth(spark, d):
    return ontology.hierarchy_depth(role(spark, d, "hierarchy"), "ROOT")


ORACLE["is_a_depth"] = ORACLE["is_a_depth"].replace("HIERARCHY", ROLES["hierarchy"])


@query("select date_trunc('day', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def event_windows(spark, d):
    return event_rates(table(spark, d, "events")).withColumn("total", F.round("total", 4))


@query()
def model_extraction(spark, d):
    names = table(spark, d, "umls_concepts").select("preferred_name", "semantic_group").collect()  # the concept list is fixed
    kinds = {"DISO": "DIAGNOSIS", "CHEM": "MEDICATION", "PROC": "PROCEDURE", "PHYS": "VITAL_SIGN"}
    model = extraction.RuleModel({r.preferred_name: kinds.get(r.semantic_group, "LAB_RESULT") for r in names})
    charts = table(spark, d, "charts").select("chart_id", "raw_text").distinct()
    parsed = extraction.parse_extraction(extraction.model_extract(charts, model))
    return parsed.groupBy("entity_type", "assertion_status").agg(F.count("*").alias("n_entities"), F.countDistinct("chart_id").alias("n_charts"))
