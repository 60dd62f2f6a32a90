"""Queries of the training-data problems and, where SQL can express them, their oracle SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import canonical, consensus, formatting, leakage, privacy, scans, tokenise, truncation


_P2_CONTEXT = ("table_name", *formatting.CONTEXT)


def _p2_encoded(spark: SparkSession, d: str) -> DataFrame:
    names = ("merged_entities", "llm_entities", "dictionary_entities")
    rows = [table(spark, d, t).select(F.lit(t).alias("table_name"), "entity_id", *formatting.CONTEXT, "entity_text") for t in names]
    return formatting.encode(reduce(DataFrame.unionByName, rows), context=_P2_CONTEXT)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return formatting.copy_pairs(_p2_encoded(spark, d), _P2_CONTEXT, keep=("table_name",))


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """One record per class of equal ones, with the number of its rows."""
    return formatting.collapse(_p2_encoded(spark, d), _P2_CONTEXT).drop("form")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenise.encode(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    rows = consensus.consensus(table(spark, d, "gold_annotations")).where("n_types >= 2")
    return rows.select("chart_id", "start_offset", F.col("label").alias("entity_type"))


def p7_reliability(spark: SparkSession, d: str) -> DataFrame:
    return consensus.reliability(table(spark, d, "gold_annotations")).select("annotator", "n_votes", F.round("accuracy", 4).alias("accuracy"))


def p7_agreement(spark: SparkSession, d: str) -> DataFrame:
    return consensus.krippendorff_alpha(table(spark, d, "gold_annotations"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.find_cut(table(spark, d, "documents")).select("doc_id")


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return truncation.cut_share(docs, truncation.find_cut(docs))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    concepts = table(spark, d, "umls_concepts")
    rows = canonical.map_rows(table(spark, d, "merged_entities"), concepts)
    canonical_names = concepts.select(F.col("preferred_name").alias("text")).where("text is not null").distinct()
    return rows.join(canonical_names, "text", "left_anti").select(F.col("id").alias("entity_id"), "cui").distinct()


def _pii_texts(spark: SparkSession, d: str) -> DataFrame:
    sources = (("charts", "chart_id", "raw_text"), ("document_sections", "section_id", "section_text"), ("merged_entities", "entity_id", "entity_context"))
    return reduce(DataFrame.unionByName, [table(spark, d, t).select(F.col(i).alias("record_id"), F.col(c).alias("text")) for t, i, c in sources])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    items = privacy.find_items(_pii_texts(spark, d), privacy.given_names(table(spark, d, "charts")), id_col="record_id", text_col="text")
    return privacy.each_item(items).select("record_id", "pii_type", "start_offset").distinct()


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return privacy.redact(_pii_texts(spark, d), privacy.given_names(table(spark, d, "charts")), id_col="record_id", text_col="text").select("record_id", "redacted").distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.find_noise(table(spark, d, "charts"), table(spark, d, "document_sections"))


def p4_texts(spark: SparkSession, d: str) -> DataFrame:
    return scans.repair_texts(table(spark, d, "charts"), table(spark, d, "document_sections"))


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes, "p8_ids": p8_ids, "p9_found": p9_found, "p9_items": p9_items, "p7_found": p7_found, "p7_reliability": p7_reliability, "p7_agreement": p7_agreement, "p10_found": p10_found, "p10_sources": p10_sources, "p1_found": p1_found, "p5_found": p5_found, "p5_redacted": p5_redacted, "p4_found": p4_found, "p4_texts": p4_texts}

_P2_ROWS = """
        with rows as (
            select 'merged_entities' as table_name, entity_id, chart_id, section_id, entity_type, start_offset, entity_text from merged_entities
            union all select 'llm_entities', entity_id, chart_id, section_id, entity_type, start_offset, entity_text from llm_entities
            union all select 'dictionary_entities', entity_id, chart_id, section_id, entity_type, start_offset, entity_text from dictionary_entities),
        fields as (select distinct entity_text, unnest(string_split_regex(lower(upper(entity_text)), '[;|]')) as f, unnest(generate_series(1, len(string_split_regex(entity_text, '[;|]')))) as i
            from rows where entity_text is not null),
        clean as (select entity_text, i, replace(regexp_replace(regexp_replace(regexp_replace(replace(f, '§', ''), '(\\p{N})\\.(\\p{N})', '\\1§\\2', 'g'), '(\\p{N})\\.(\\p{N})', '\\1§\\2', 'g'), '[^\\p{L}\\p{N}+<>%§]', '', 'g'), '§', '.') as f from fields),
        forms as (select entity_text, string_agg(f, ';' order by f) as form from clean where f <> '' group by entity_text)"""

#: Words of documents and items: runs of letters and digits, without case and accents; twelve of them at every place.
_P9_SHINGLES = """
        with texts as (
            select distinct 'd' as kind, doc_id as id, text from documents where text is not null
            union all select distinct 'i', item_id, text from eval_items where text is not null),
        words as (select kind, id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+') as w from texts),
        shingles as (select kind, id, i, array_to_string(list_slice(w, i, i + 11), ' ') as s from (select *, unnest(generate_series(1, len(w) - 11)) as i from words where len(w) >= 12) x),
        places as (select distinct a.id as doc_id, b.id as item_id, a.i as place, a.i - b.i as diagonal from shingles a join shingles b on a.s = b.s where a.kind = 'd' and b.kind = 'i'),
        runs as (select doc_id, item_id, count(*) + 11 as n_words from (select *, place - row_number() over (partition by doc_id, item_id, diagonal order by place) as island from places) p group by doc_id, item_id, diagonal, island)"""

ORACLE = {
    "p2_found": _P2_ROWS + """,
        recs as (select distinct table_name, entity_id, chart_id, section_id, entity_type, start_offset, form from rows join forms using (entity_text))
        select distinct a.table_name, a.entity_id as entity_id_a, b.entity_id as entity_id_b
        from recs a join recs b on a.form = b.form and a.table_name = b.table_name and a.chart_id is not distinct from b.chart_id
            and a.section_id is not distinct from b.section_id and a.entity_type is not distinct from b.entity_type
            and a.start_offset is not distinct from b.start_offset and a.entity_id < b.entity_id""",
    "p2_classes": _P2_ROWS + """
        select table_name, chart_id, section_id, entity_type, start_offset, min(entity_id) as record_id, max(entity_id) as last_id, count(*) as n_copies
        from rows join forms using (entity_text) where entity_id is not null group by table_name, chart_id, section_id, entity_type, start_offset, form""",
    "p9_found": _P9_SHINGLES + " select distinct doc_id, item_id from places",
    "p9_items": _P9_SHINGLES + " select item_id, count(distinct doc_id) as n_docs, cast(max(n_words) as int) as longest from runs group by 1",
    "p7_agreement": """
        with named as (
            select chart_id, start_offset, annotator_id, annotation_round, annotated_at, list_position(['DIAGNOSIS', 'LABRESULT', 'MEDICATION', 'VITALSIGN', 'PROCEDURE', 'OTHER'], upper(regexp_replace(entity_type, '[^\\p{L}\\p{N}]', '', 'g'))) as label
            from gold_annotations where annotator_id is not null and trim(annotator_id) <> '' and chart_id is not null and start_offset is not null),
        votes as (select chart_id, start_offset, label from named where label > 0
            qualify row_number() over (partition by chart_id, start_offset, annotator_id order by coalesce(annotation_round, -1) desc, annotated_at desc nulls last, label) = 1),
        counts as (select chart_id, start_offset, label, count(*) as n from votes group by 1, 2, 3),
        items as (select chart_id, start_offset, sum(n) as m, sum(n * (n - 1)) as agree from counts group by 1, 2 having sum(n) >= 2),
        labels as (select label, sum(n) as n from counts join items using (chart_id, start_offset) group by 1),
        chance as (select cast(sum(n) as bigint) as total, sum(n * (n - 1)) as expected from labels),
        seen as (select count(*) as n_items, sum(cast(agree as double) / cast(m - 1 as double)) as agreeing from items)
        select n_items, coalesce(total, 0) as n_votes, round(case when expected = total * (total - 1) then 1.0 else 1 - (1 - agreeing / nullif(total, 0)) / (1 - cast(expected as double) / nullif(cast(total as double) * (total - 1), 0)) end, 6) as alpha
        from seen, chance""",
}
