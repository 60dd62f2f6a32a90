"""Readers of ontology distribution files (UMLS and RxNorm RRF, SNOMED RF2) from local or shared paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clinical import semantic_group
from .catalog import find_file


def read_rrf(spark: SparkSession, path: str, fields: dict[str, int], width: int) -> DataFrame:
    """Columns of a pipe-separated file without header by their position; quotes are text."""
    schema = ", ".join(f"_f{i} string" for i in range(width))
    rows = spark.read.schema(schema).option("sep", "|").option("quote", "").csv(path)
    return rows.select(*[F.col(f"_f{i}").alias(name) for name, i in fields.items()])


def load_umls(spark: SparkSession, mrconso: str, mrsty: str) -> DataFrame:
    names = read_rrf(spark, mrconso, {"cui": 0, "lat": 1, "ts": 2, "stt": 4, "ispref": 6, "sab": 11, "str": 14}, 19).where("lat = 'ENG'")
    preferred = (F.col("ts") == "P") & (F.col("stt") == "PF") & (F.col("ispref") == "Y")
    concepts = names.groupBy("cui").agg(F.min(F.when(preferred, F.col("str"))).alias("preferred_name"), F.array_sort(F.collect_set("str")).alias("synonyms"), F.array_sort(F.collect_set("sab")).alias("source_vocabularies"))
    types = read_rrf(spark, mrsty, {"cui": 0, "semantic_type": 3}, 7).groupBy("cui").agg(F.min("semantic_type").alias("semantic_type"))
    return concepts.join(types, "cui", "left").withColumn("semantic_group", semantic_group(F.col("semantic_type")))


def load_rxnorm(spark: SparkSession, rxnconso: str) -> DataFrame:
    rows = read_rrf(spark, rxnconso, {"rxcui": 0, "lat": 1, "sab": 11, "tty": 12, "str": 14}, 19).where("lat = 'ENG' and sab = 'RXNORM'")
    return rows.groupBy("rxcui").agg(F.min(F.struct("tty", "str")).alias("_n"), F.array_sort(F.collect_set("str")).alias("synonyms"), F.array_sort(F.collect_set(F.when(F.col("tty") == "IN", F.col("str")))).alias("ingredients")).select("rxcui", F.col("_n.str").alias("name"), F.col("_n.tty").alias("term_type"), "synonyms", "ingredients")


def read_rf2(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path).where("active = '1'")


def load_snomed(spark: SparkSession, descriptions: str, relationships: str, extended_map: str) -> tuple[DataFrame, DataFrame]:
    """(is-a hierarchy with names, ICD map)."""
    names = read_rf2(spark, descriptions).where("languageCode = 'en'").groupBy("conceptId").agg(F.min(F.struct("typeId", "term"))["term"].alias("name"))
    edges = read_rf2(spark, relationships).where("typeId = '116680003'").select(F.col("sourceId").alias("concept_id"), F.col("destinationId").alias("parent_id"))
    child = names.select(F.col("conceptId").alias("concept_id"), F.col("name").alias("concept_name"))
    parent = names.select(F.col("conceptId").alias("parent_id"), F.col("name").alias("parent_name"))
    hierarchy = edges.join(child, "concept_id", "left").join(parent, "parent_id", "left").withColumn("relationship_type", F.lit("IS_A"))
    maps = read_rf2(spark, extended_map).where("mapTarget is not null and mapTarget != ''")
    maps = maps.select(F.col("referencedComponentId").alias("snomed_concept_id"), F.col("mapTarget").alias("icd10_code"), F.col("mapPriority").cast("int").alias("map_priority"), F.col("mapRule").alias("map_rule"), F.col("mapGroup").cast("int").alias("map_group"))
    return hierarchy, maps.join(names.select(F.col("conceptId").alias("snomed_concept_id"), F.col("name").alias("snomed_name")), "snomed_concept_id", "left")


def load_abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of abbreviation, expansion, category, context_hint; the list itself is a parameter."""
    return spark.read.schema("abbreviation string, expansion string, category string, context_hint string").option("header", True).csv(path)


def hierarchy_depth(hierarchy: DataFrame, root: str) -> DataFrame:
    """(concept_id, depth): the least number of is-a steps to ``root``; concepts that do not reach it are left out."""
    sql = """
        with recursive walk(concept_id, depth) as (
            select distinct parent_id, 0 from {h} where parent_id = {root}
            union all
            select h.concept_id, w.depth + 1 from walk w join {h} h on h.parent_id = w.concept_id where w.depth < 50)
        select concept_id, min(depth) as depth from walk group by concept_id"""
    return hierarchy.sparkSession.sql(sql, h=hierarchy, root=root)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files as (path, file_name, content), to be joined to charts by name."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")


def load_snomed_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``load_snomed`` from the files of a release folder, found by their names."""
    paths = {part: find_file(spark, folder, part) for part in ("description", "relationship", "extendedmap")}
    lost = [k for k, v in paths.items() if v is None]
    if lost:
        raise FileNotFoundError(f"no {', '.join(lost)} file in {folder}")
    return load_snomed(spark, paths["description"], paths["relationship"], paths["extendedmap"])
