"""Queries of the general problems (p3, p6) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental, units
from ..sources.tables import table


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    sources = [table(spark, d, t) for t in ("llm_entities", "dictionary_entities")]
    rows = incremental.pending(sources, table(spark, d, "merged_entities"), table(spark, d, "merge_runs"))
    return rows.select(F.col("source_key").alias("entity_id"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return units.scaled(units.convert(table(spark, d, "merged_entities"), table(spark, d, "measure_units")))


QUERIES = {"p3_found": p3_found, "p6_found": p6_found}

ORACLE = {
    "p6_found": """
        with source as (
            select entity_id, max(extracted_at) as version
            from (select entity_id, extracted_at from llm_entities union all select entity_id, extracted_at from dictionary_entities)
            where entity_id is not null group by entity_id),
        done as (
            select k as entity_id, max(merged_at) as made
            from (select unnest(source_entity_ids) as k, merged_at from merged_entities) m
            where exists (select 1 from merge_runs r where r.status = 'SUCCEEDED' and m.merged_at between r.started_at and r.finished_at)
            group by k)
        select s.entity_id from source s left join done d on s.entity_id = d.entity_id
        where not coalesce(d.made >= s.version, false)
    """,
}
