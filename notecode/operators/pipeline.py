"""The stages in order, each over what its target does not hold yet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import stage
from . import coding, dictionary_match, extraction, merge, sections
from .incremental import VersionedTarget

#: Folders of a target from which on a run writes them into one.
MAX_FOLDERS = 16


@dataclass
class StageResult:
    name: str
    version: int
    skipped: bool


@dataclass
class Stage:
    """``work`` turns rows of pending keys into rows of the target; its input has ``source_key`` and ``source_version``, its output the key."""

    name: str
    inputs: Callable[[dict[str, VersionedTarget]], DataFrame]
    work: Callable[[DataFrame, dict[str, VersionedTarget]], DataFrame]


def unprocessed(charts: DataFrame, processed: DataFrame) -> DataFrame:
    """Charts whose id is not among the processed ones; null ids are never processed."""
    return charts.where("chart_id is not null").join(processed.select("chart_id").distinct(), "chart_id", "left_anti")


def charts_to_merge(layers: list[DataFrame], merged: DataFrame) -> DataFrame:
    """Charts that stand in any layer but not in the merged entities."""
    ids = layers[0].select("chart_id")
    for layer in layers[1:]:
        ids = ids.union(layer.select("chart_id"))
    return ids.where("chart_id is not null").distinct().join(merged.select("chart_id").distinct(), "chart_id", "left_anti")


def of_charts(rows: DataFrame, charts: DataFrame) -> DataFrame:
    """The rows of the given charts."""
    return rows.join(charts.select("chart_id").distinct(), "chart_id", "left_semi")


def pin_batch(charts: DataFrame, ledger: DataFrame) -> DataFrame:
    """The charts of this run, fixed by writing them out: what arrives meanwhile waits for the next run.

    ``ledger`` has a row for every chart a run has finished, also for those without entities.
    """
    return stage(unprocessed(charts, ledger), "pinned-batch")


def run_stage(name: str, source: DataFrame, target: VersionedTarget, work: Callable[[DataFrame], DataFrame], key: str, version: str) -> StageResult:
    """Run ``work`` over new and changed rows and publish the result; without any, nothing is written.

    Every output row carries the key and version of its source row. Source rows that yield
    no output are kept as rows with nulls, so that they are not processed again.
    """
    base = target.current()
    rows = stage(target.pending_rows(source, key, version), "pending")
    if rows.isEmpty():
        return StageResult(name, base, True)
    made = work(rows)
    keys = rows.select(F.col(key).alias("source_key"), F.col(version).alias("source_version")).distinct()
    out = keys.join(made.withColumnRenamed(key, "source_key"), "source_key", "left")
    published = target.publish(out, base)
    return StageResult(name, target.compact() if len(target.folders(published)) > MAX_FOLDERS else published, False)


def run(stages: list[Stage], targets: dict[str, VersionedTarget]) -> list[StageResult]:
    """All stages in order. A stage reads what the ones before have published, so a run that dies goes on where it stopped."""
    return [run_stage(s.name, s.inputs(targets), targets[s.name], lambda rows, s=s: s.work(rows, targets), "source_key", "source_version") for s in stages]


def clinical_stages(charts: DataFrame, dictionary: DataFrame, model: Callable[[DataFrame], DataFrame] | None = None) -> list[Stage]:
    """Sections, dictionary entities, model entities, merged entities and ontology codes, all keyed by chart.

    ``charts`` has chart_id, raw_text and ingested_at; ``dictionary`` is that of ``build_dictionary``.
    ``model`` turns charts into raw answers (``extraction.model_extract``); without it that layer is empty.
    """
    keyed = lambda df: df.withColumns({"source_key": F.col("chart_id"), "source_version": F.col("ingested_at").cast("string")})
    made = lambda df: df.withColumn("source_key", F.col("chart_id"))

    def inputs_of(*names: str) -> Callable[[dict[str, VersionedTarget]], DataFrame]:
        def read(targets: dict[str, VersionedTarget]) -> DataFrame:
            rows = targets[names[0]].read().select("source_key", "source_version")
            return rows.distinct()

        return read

    def rows_of(targets: dict[str, VersionedTarget], name: str, keys: DataFrame, must: str) -> DataFrame:
        return targets[name].read().where(F.col(must).isNotNull()).join(keys.select("source_key").distinct(), "source_key", "left_semi").drop("source_key", "source_version")

    def to_sections(rows: DataFrame, targets) -> DataFrame:
        return made(sections.segment_sections(rows.select("chart_id", "raw_text")))

    def to_dictionary(rows: DataFrame, targets) -> DataFrame:
        return made(dictionary_match.extract_dictionary_entities(rows_of(targets, "sections", rows, "section_id"), dictionary, None))

    def to_model(rows: DataFrame, targets) -> DataFrame:
        answers = (model or extraction.no_answers)(rows.select("chart_id", "raw_text"))
        return made(extraction.resolve_sections(extraction.parse_extraction(answers), rows_of(targets, "sections", rows, "section_id")))

    def to_merged(rows: DataFrame, targets) -> DataFrame:
        layers = [merge.with_columns(x) for x in (rows_of(targets, "dictionary", rows, "entity_id"), *extraction.split_roles(rows_of(targets, "model", rows, "entity_text")))]
        return made(merge.merge_layers(*layers, rows_of(targets, "sections", rows, "section_id")))

    def to_codes(rows: DataFrame, targets) -> DataFrame:
        active = rows_of(targets, "merged", rows, "entity_id")
        return made(coding.tier1_exact(active, dictionary).select("chart_id", "entity_id", "entity_text", "source_code", "match_source", "tier1_confidence").distinct())

    return [
        Stage("sections", lambda targets: keyed(charts), to_sections),
        Stage("dictionary", inputs_of("sections"), to_dictionary),
        Stage("model", lambda targets: keyed(charts), to_model),
        Stage("merged", inputs_of("dictionary"), to_merged),
        Stage("codes", inputs_of("merged"), to_codes),
    ]


def targets_at(spark: SparkSession, path: str, stages: list[Stage]) -> dict[str, VersionedTarget]:
    return {s.name: VersionedTarget(spark, f"{path}/{s.name}") for s in stages}
