"""Gold annotations, agreement, precision and recall, the annotation queue and trends."""

from __future__ import annotations

import json
import re
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.clinical import bins, stable_id

KEY = ("chart_id", "entity_type", "text")


def gold_id(chart: Column, kind: Column, text: Column, annotator: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (chart, kind, text, annotator)]
    return F.concat(F.lit("GOLD-"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 12))


def import_gold(spark: SparkSession, csv: list[str], json: list[str], existing: DataFrame | None = None, json_lines: bool = False) -> DataFrame:
    """Annotations of CSV and JSON files in one shape, those already there (by id) left out."""
    schema = "chart_id string, entity_type string, entity_text string, start_offset int, end_offset int, annotator_id string, annotation_round int"
    parts = []
    if csv:
        parts.append(spark.read.schema(schema).option("header", True).csv(csv))
    if json:
        parts.append(spark.read.schema(schema).option("multiLine", not json_lines).json(json))
    rows = spark.createDataFrame([], schema)
    for p in parts:
        rows = rows.unionByName(p, allowMissingColumns=True)
    rows = rows.withColumns({"annotator_id": F.coalesce("annotator_id", F.lit("unknown")), "annotation_round": F.coalesce("annotation_round", F.lit(1))})
    rows = rows.withColumn("annotation_id", gold_id(*[F.col(c) for c in ("chart_id", "entity_type", "entity_text", "annotator_id")])).dropDuplicates(["annotation_id", "annotation_round"])
    return rows if existing is None else rows.join(existing.select("annotation_id").distinct(), "annotation_id", "left_anti")


def keys(df: DataFrame) -> DataFrame:
    """Distinct (chart, type, text) without case and outer spaces; null texts are no keys."""
    return df.select("chart_id", F.upper(F.trim("entity_type")).alias("entity_type"), F.lower(F.trim("entity_text")).alias("text")).where("text is not null").distinct()


def latest_round(gold: DataFrame) -> DataFrame:
    newest = gold.agg(F.max("annotation_round").alias("_r"))
    return gold.join(F.broadcast(newest), F.col("annotation_round") == F.col("_r")).drop("_r")


def cohen_kappa(gold: DataFrame) -> DataFrame:
    """One row: agreement of rounds 1 and 2 on the entities either names; kappa is null without any, 1 at full agreement."""
    sides = gold.where("annotation_round in (1, 2)").select("chart_id", F.upper(F.trim("entity_type")).alias("entity_type"), F.lower(F.trim("entity_text")).alias("text"), "annotation_round").where("text is not null").distinct()
    each = sides.groupBy(*KEY).agg(F.max(F.when(F.col("annotation_round") == 1, 1).otherwise(0)).alias("a"), F.max(F.when(F.col("annotation_round") == 2, 1).otherwise(0)).alias("b"))
    s = each.agg(F.count("*").alias("total"), F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("n_both"), F.coalesce(F.sum("a"), F.lit(0)).alias("round1"), F.coalesce(F.sum("b"), F.lit(0)).alias("round2"))
    n = F.nullif(F.col("total"), F.lit(0))
    po, p1, p2 = F.col("n_both") / n, F.col("round1") / n, F.col("round2") / n
    pe = p1 * p2 + (1 - p1) * (1 - p2)
    return s.withColumn("kappa", F.round(F.when(pe == 1, 1.0).otherwise((po - pe) / (1 - pe)), 4))


def _flags(found: DataFrame, gold: DataFrame) -> DataFrame:
    """One row per key with flags: one shuffle instead of two semi joins and two anti joins."""
    both = keys(found).withColumns({"f": F.lit(1), "g": F.lit(0)}).unionByName(keys(latest_round(gold)).withColumns({"f": F.lit(0), "g": F.lit(1)}))
    return both.groupBy(*KEY).agg(F.max("f").alias("f"), F.max("g").alias("g"))


def _scores(df: DataFrame) -> DataFrame:
    tp, fp, fn = F.sum(F.col("f") * F.col("g")), F.sum(F.col("f") * (1 - F.col("g"))), F.sum((1 - F.col("f")) * F.col("g"))
    out = df.agg(F.coalesce(tp, F.lit(0)).alias("true_positives"), F.coalesce(fp, F.lit(0)).alias("false_positives"), F.coalesce(fn, F.lit(0)).alias("false_negatives"))
    t, p, n = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    zero = lambda c: F.nullif(c, F.lit(0))
    return out.withColumns({"precision_score": F.round(t / zero(t + p), 4), "recall_score": F.round(t / zero(t + n), 4), "f1_score": F.round(2 * t / zero(2 * t + p + n), 4)})


def prf_overall(found: DataFrame, gold: DataFrame) -> DataFrame:
    """One row against the latest round; scores without a denominator are null."""
    return _scores(_flags(found, gold).groupBy())


def prf_by_type(found: DataFrame, gold: DataFrame) -> DataFrame:
    return _scores(_flags(found, gold).groupBy("entity_type"))


def missed_entities(found: DataFrame, gold: DataFrame) -> DataFrame:
    """Gold entities of the latest round that were not found."""
    return keys(latest_round(gold)).join(keys(found), list(KEY), "left_anti")


def missed_in_context(missed: DataFrame, found: DataFrame, charts: DataFrame, sections: DataFrame) -> DataFrame:
    """Missed entities with each section type of their chart, the length of its note and the number of entities found in it."""
    n = found.groupBy("chart_id").agg(F.count("*").alias("total_entities_in_chart"))
    length = charts.groupBy("chart_id").agg(F.max(F.length("raw_text")).alias("note_length"))
    kinds = sections.select("chart_id", "section_type").distinct()
    out = missed.join(n, "chart_id", "left").join(length, "chart_id", "left").join(kinds, "chart_id", "left")
    return out.withColumn("total_entities_in_chart", F.coalesce("total_entities_in_chart", F.lit(0)))


def missed_by(missed: DataFrame, column: str) -> DataFrame:
    return missed.groupBy(column).agg(F.count("*").alias("n_missed"))


def missed_density(missed: DataFrame, found: DataFrame) -> DataFrame:
    """Missed entities by the number of entities found in their chart."""
    n = found.groupBy("chart_id").agg(F.count("*").alias("n"))
    rows = missed.join(n, "chart_id", "left").withColumn("density", bins(F.coalesce("n", F.lit(0)), [(30, "high (30+)"), (10, "medium (10-30)")], "low (<10)"))
    return rows.groupBy("density").agg(F.count("*").alias("n_missed"), F.countDistinct("chart_id").alias("n_charts"))


def missed_sample(missed: DataFrame, k: int = 100) -> DataFrame:
    """The first ``k`` missed entities, in order of type, text, section and chart, as lines of a prompt."""
    line = F.concat(F.lit("- ["), F.coalesce("entity_type", F.lit("")), F.lit('] "'), "text", F.lit('" (section: '), F.coalesce("section_type", F.lit("None")), F.lit(")"))
    return missed.orderBy("entity_type", "text", "section_type", "chart_id").limit(k).select("entity_type", "text", "section_type", "chart_id", line.alias("line"))


PATTERN = "array<struct<pattern_type string, description string, affected_entity_types array<string>, example_entities array<string>, suggested_fix string, severity string>>"


class TextModel(Protocol):
    def answer(self, prompts: list[str]) -> list[str]: ...


class CountingModel:
    """A stand-in that needs no network: one pattern per entity type of the listed entities, graver the more there are."""

    def answer(self, prompts: list[str]) -> list[str]:
        return [json.dumps(self._patterns(p)) for p in prompts]

    @staticmethod
    def _patterns(prompt: str) -> list[dict]:
        seen: dict[str, list[str]] = {}
        for kind, text in re.findall(r'^- \[(.*?)\] "(.*)" \(section', prompt, re.M):
            seen.setdefault(kind, []).append(text)
        return [{"pattern_type": f"missed {k}", "description": f"{len(v)} entities of type {k} were missed", "affected_entity_types": [k], "example_entities": sorted(set(v))[:3], "suggested_fix": "add to dictionary", "severity": "HIGH" if len(v) >= 30 else "MEDIUM" if len(v) >= 10 else "LOW"} for k, v in sorted(seen.items())]


def ask(prompts: DataFrame, model: TextModel, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """``prompts`` with the model's answers, in Arrow batches."""

    def run(batches):
        for pdf in batches:
            pdf[answer] = model.answer(pdf[prompt].tolist())
            yield pdf

    return prompts.mapInPandas(run, f"{', '.join(f'`{c}` {t}' for c, t in prompts.dtypes)}, {answer} string")


def salvaged(answer: Column, schema: str) -> Column:
    """The JSON array of an answer: fences taken off, else what stands between its outer brackets; null if unreadable."""
    body = F.regexp_replace(answer, r"^\s*```(?:json)?|```\s*$", "")
    return F.coalesce(F.from_json(body, schema), F.from_json(F.regexp_extract(answer, r"(?s)(\[.*\])", 1), schema))


def error_patterns(missed: DataFrame, model: TextModel | None = None, k: int = 100) -> DataFrame:
    """Patterns a model reads from a sample of the missed entities, as rows of the pattern table."""
    lines = missed_sample(missed, k).agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("_lines"))
    prompt = F.concat(F.lit("Find the systematic patterns among these missed clinical entities. Answer with a JSON array of pattern_type, description, affected_entity_types, example_entities, suggested_fix, severity (HIGH, MEDIUM, LOW).\n\n"), "_lines")
    raw = ask(lines.select(prompt.alias("prompt")), model or CountingModel())
    p = raw.select(F.explode(salvaged(F.col("answer"), PATTERN)).alias("p")).select("p.*")
    return p.select(
        stable_id("PAT-", "pattern_type", "description").alias("pattern_id"), F.coalesce("pattern_type", F.lit("unknown")).alias("pattern_type"), F.coalesce("description", F.lit("")).alias("description"),
        F.substring(F.to_json(F.coalesce("example_entities", F.array().cast("array<string>"))), 1, 500).alias("example_entity_text"), F.lit(1).alias("frequency"), F.coalesce("severity", F.lit("MEDIUM")).alias("severity"), F.coalesce("suggested_fix", F.lit("")).alias("suggested_fix"),
    )


def recommendations(patterns: DataFrame, model: TextModel) -> DataFrame:
    """(pattern_id, recommendation): a model's advice on each pattern."""
    prompt = F.concat_ws("\n", F.lit("Recommend how to mend this extraction pattern."), "pattern_type", "description", "suggested_fix")
    return ask(patterns.select("pattern_id", prompt.alias("prompt")), model).select("pattern_id", F.col("answer").alias("recommendation"))


def metric_rows(found: DataFrame, gold: DataFrame, run_id: str, run_timestamp: Column) -> DataFrame:
    """The rows of a run for the metrics table: overall and by entity type; scores without a denominator are 0."""
    overall = prf_overall(found, gold).select(F.lit("overall").alias("metric_scope"), F.lit("all").alias("scope_value"), "*")
    by_type = prf_by_type(found, gold).select(F.lit("by_entity_type").alias("metric_scope"), F.col("entity_type").alias("scope_value"), "*").drop("entity_type")
    rows = overall.unionByName(by_type)
    scores = {c: F.coalesce(c, F.lit(0.0)) for c in ("precision_score", "recall_score", "f1_score")}
    counts = {c: F.col(c).cast("int") for c in ("true_positives", "false_positives", "false_negatives")}
    return rows.withColumns({**scores, **counts, "run_id": F.lit(run_id), "run_timestamp": run_timestamp, "extraction_layer": F.lit("ensemble")})


def annotation_queue(merged: DataFrame, gold: DataFrame, k: int = 50) -> DataFrame:
    """The k charts without annotations that are least certain: low and uneven confidence, few layers."""
    has = lambda s: F.max(F.when(F.array_contains("sources", s), 1).otherwise(0))
    per = merged.where("chart_id is not null").groupBy("chart_id").agg(F.round(F.avg("ensemble_confidence"), 10).alias("avg_c"), F.round(F.stddev_samp("ensemble_confidence"), 10).alias("std_c"), F.count("*").alias("entity_count"), (has("dictionary") + has("ner") + has("llm")).alias("active_layers"))
    score = 0.4 * (1 - F.col("avg_c")) + 0.3 * F.coalesce("std_c", F.lit(0.0)) + 0.3 * (1 - F.col("active_layers") / 3)
    open_ = per.join(gold.select("chart_id").distinct(), "chart_id", "left_anti").withColumn("annotation_priority", F.round(score, 4))
    return open_.orderBy(F.desc("annotation_priority"), "chart_id").limit(k).select("chart_id", F.round("avg_c", 4).alias("avg_confidence"), F.round("std_c", 4).alias("confidence_variance"), "entity_count", "active_layers", "annotation_priority")


def recall_trend(metrics: DataFrame) -> DataFrame:
    day = F.to_date("run_timestamp").alias("run_date")
    return metrics.groupBy(day, "metric_scope").agg(F.count("*").alias("n_runs"), F.round(F.avg("recall_score"), 4).alias("avg_recall"), F.round(F.avg("f1_score"), 4).alias("avg_f1"))


def cycle_delta(metrics: DataFrame) -> DataFrame:
    """Daily averages and their change; one row per day, so the ordered window is small."""
    daily = metrics.groupBy(F.to_date("run_timestamp").alias("run_date")).agg(F.round(F.avg("recall_score"), 6).alias("avg_recall"), F.round(F.avg("f1_score"), 6).alias("avg_f1"))
    w = W.orderBy("run_date")
    return daily.withColumns({"recall_delta": F.round(F.col("avg_recall") - F.lag("avg_recall").over(w), 5), "f1_delta": F.round(F.col("avg_f1") - F.lag("avg_f1").over(w), 5)})


def error_pattern_status(patterns: DataFrame) -> DataFrame:
    """Patterns by severity and whether they are resolved, the gravest first."""
    state = F.when(F.col("resolved_at").isNull(), "open").otherwise("resolved")
    rank = F.when(F.col("severity") == "HIGH", 1).when(F.col("severity") == "MEDIUM", 2).when(F.col("severity") == "LOW", 3)
    g = patterns.groupBy("severity", state.alias("status")).agg(F.count("*").alias("pattern_count"), F.array_sort(F.collect_set("pattern_type")).alias("pattern_types"), F.max("detected_at").alias("last_detected"))
    return g.orderBy(rank, "status")


def annotation_throughput(gold: DataFrame) -> DataFrame:
    return gold.groupBy(F.to_date("annotated_at").alias("day"), "annotator_id").agg(F.count("*").alias("n_annotations"), F.countDistinct("chart_id").alias("n_charts"))
