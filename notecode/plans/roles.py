"""Input roles that the test tables lack, as SQL that Spark and the oracle both run.

Real tables are used where there are any (charts, sections, layers, gold). Code mappings
come from orders, reference codes from part, metric runs and error patterns from events,
the hierarchy from nation and region, and the explicit entities of the model stand for
the named-entity layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

ROLES = {
    "mappings": """
        select cast(o_orderkey as string) as mapping_id, cast(o_custkey as string) as chart_id,
            case when o_orderstatus = 'F' then 'ONTOLOGY_DIRECT' when o_orderstatus = 'O' then 'LLM_ASSIGNED' when o_orderpriority = '1-URGENT' then 'DISPUTED_UNRESOLVED'
                when o_orderpriority = '2-HIGH' then 'ARBITER_CHOSE_R1' else 'R1_R2_AGREE' end as resolution_path,
            round(cast(o_orderkey % 101 as double) / 100, 2) as confidence,
            concat(substring('ABCDEFGHIJKLMNRZ', cast(1 + o_custkey % 16 as int), 1), lpad(cast(o_custkey % 100 as string), 2, '0'), '.', cast(o_orderkey % 10 as string)) as code,
            case when o_orderkey % 2 = 0 then 'ICD-10' else 'LOINC' end as code_type, o_orderdate as created_at
        from orders""",
    "icd_ref": """
        select code, replace(code, '.', '') as code_raw, min(description) as description, max(p_size) % 2 = 0 as is_billable from
            (select concat(substring('ABCDEFGHIJKLMNRZ', cast(1 + p_partkey % 16 as int), 1), lpad(cast(p_partkey % 100 as string), 2, '0'), '.', cast(p_partkey % 7 as string)) as code, p_name as description, p_size from part) q group by code""",
    "runs": """
        select concat('RUN-', cast(event_id as string)) as run_id, ts as run_timestamp, case event_type when 'view' then 'overall' else 'by_entity_type' end as metric_scope,
            case event_type when 'view' then 'all' else event_type end as scope_value, round(cast(user_id % 50 as double) / 50, 4) as recall_score, round(cast(event_id % 89 as double) / 89, 4) as precision_score, round(cast(event_id % 97 as double) / 97, 4) as f1_score,
            cast(user_id % 50 as int) as true_positives, cast(event_id % 7 as int) as false_negatives from events""",
    "patterns": """
        select concat('PAT-', cast(event_id as string)) as pattern_id, event_type as pattern_type, case user_id % 3 when 0 then 'HIGH' when 1 then 'MEDIUM' else 'LOW' end as severity,
            ts as detected_at, case when event_id % 2 = 1 then ts end as resolved_at from events""",
    "hierarchy": """
        select concat('N', cast(n_nationkey as string)) as concept_id, n_name as concept_name, concat('R', cast(n_regionkey as string)) as parent_id, r_name as parent_name from nation join region on n_regionkey = r_regionkey
        union all select concat('R', cast(r_regionkey as string)), r_name, 'ROOT', 'root' from region""",
    "validation": """
        select cast(o_orderkey as string) as mapping_id, cast(1 + o_orderkey % 2 as int) as validation_round, case when o_custkey % 3 = 0 then 'auditor' else 'coder' end as validation_role,
            case o_orderstatus when 'F' then 'approved' when 'O' then 'modified' else 'rejected' end as validation_result from orders""",
    "snomed_terms": "select concat('S', cast(p_partkey as string)) as concept_id, p_name as concept_name, concat('C', cast(p_partkey % 500 as string)) as cui from part where p_partkey % 3 = 0",
    "snomed_map": """
        select concat('S', cast(p_partkey as string)) as snomed_concept_id, concat(substring('ABCDEFGHIJKLMNRZ', cast(1 + p_partkey % 16 as int), 1), lpad(cast(p_partkey % 100 as string), 2, '0'), '.', cast(p_partkey % 7 as string)) as icd10_code,
            cast(1 + p_partkey % 2 as int) as map_priority from part where p_partkey % 3 = 0""",
    "loinc_codes": """
        select cui as code, preferred_name as display_name, substring(preferred_name, 1, cast(case when instr(preferred_name, ' ') > 0 then instr(preferred_name, ' ') - 1 else length(preferred_name) end as int)) as component,
            case length(preferred_name) % 3 when 0 then 'Automated count' when 1 then 'Test strip' end as method, case length(preferred_name) % 4 when 0 then 'Serum' when 1 then 'Urine' end as system
        from umls_concepts where semantic_type in ('Laboratory Procedure', 'Clinical Attribute', 'Laboratory or Test Result')""",
    "icd10_mappings": """
        select concat('MAP-ICD-', entity_id) as mapping_id, min(chart_id) as chart_id, entity_id, concat(substring('ABCDEFGHIJKLMNRZ', cast(1 + length(min(entity_text)) % 16 as int), 1), lpad(cast(length(min(entity_text)) * 7 % 100 as string), 2, '0'), '.', cast(length(min(entity_text)) % 7 as string)) as code,
            round(min(ensemble_confidence), 4) as confidence, concat('by ', min(entity_type)) as reasoning,
            case length(min(entity_text)) % 6 when 0 then 'ONTOLOGY_DIRECT' when 1 then 'R1_R2_AGREE' when 2 then 'ARBITER_CHOSE_R1' when 3 then 'DISPUTED_UNRESOLVED' when 4 then 'HUMAN_ACCEPTED' else 'LLM_ASSIGNED' end as resolution_path, min(merged_at) as created_at
        from merged_entities where entity_type = 'DIAGNOSIS' and entity_text is not null and ensemble_confidence is not null group by entity_id""",
    "loinc_mappings": """
        select concat('MAP-LOI-', entity_id) as mapping_id, min(m.chart_id) as chart_id, entity_id, coalesce(min(u.cui), 'NO_MAP') as code, round(min(ensemble_confidence), 4) as confidence, concat('by ', min(m.entity_type)) as reasoning,
            case length(min(m.entity_text)) % 6 when 0 then 'ONTOLOGY_DIRECT' when 1 then 'R1_R2_AGREE' when 2 then 'ARBITER_CHOSE_R2' when 3 then 'DISPUTED_UNRESOLVED' when 4 then 'HUMAN_OVERRIDE' else 'LLM_ASSIGNED' end as resolution_path,
            min(merged_at) as created_at, min(m.method) as method, min(m.specimen_type) as specimen_type
        from merged_entities m left join umls_concepts u on u.preferred_name = m.entity_text where m.entity_type = 'LAB_RESULT' and m.entity_text is not null and ensemble_confidence is not null group by entity_id""",
    "umls_mappings": "select distinct m.entity_id, u.cui from merged_entities m join umls_concepts u on lower(m.entity_text) = lower(u.preferred_name)",
    "ner": "select * from llm_entities where extraction_role = 'explicit'",
    "llm": "select * from llm_entities where extraction_role in ('implicit', 'abbreviation')",
    "assertions": """
        select concat('ASSERT-', entity_id) as assertion_id, entity_id, chart_id,
            case k when 0 then 'ABSENT' when 1 then 'POSSIBLE' when 2 then 'HISTORICAL' when 3 then 'FAMILY' when 4 then 'CONDITIONAL' else 'PRESENT' end as assertion_status,
            k = 0 as negation_detected, case when k = 2 then 'HISTORICAL' else 'CURRENT' end as temporality, case when k = 3 then 'FAMILY_MEMBER' else 'PATIENT' end as experiencer,
            case when k = 1 then 'POSSIBLE' else 'DEFINITE' end as certainty, round(0.5e0 + cast(k as double) / 20, 4) as confidence
        from (select distinct entity_id, chart_id, length(coalesce(reasoning, '')) % 7 as k from llm_entities) t""",
}
TABLES = ("orders", "part", "events", "nation", "region", "llm_entities", "merged_entities", "umls_concepts")


def role(spark: SparkSession, d: str, name: str) -> DataFrame:
    sql = ROLES[name]
    for t in TABLES:
        if t not in sql:
            continue
        table(spark, d, t).createOrReplaceTempView(f"role_{t}")
        sql = _words(sql, t, f"role_{t}")
    return spark.sql(sql)


def _words(sql: str, old: str, new: str) -> str:
    import re

    return re.sub(rf"(?<=from ){old}\b|(?<=join ){old}\b", new, sql)


def with_roles(sql: str, *names: str) -> str:
    """Oracle SQL with the roles it names as common table expressions."""
    return "with " + ", ".join(f"{n} as ({ROLES[n]})" for n in names) + " " + sql
