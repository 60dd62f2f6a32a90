"""Fusing the extraction layers into one entity set.

Nulls: rows without chart or type form groups of their own; rows without text are left out.
Ties of texts and values go to the greatest string, so that results do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import norm_text, stable_id

META = ("specimen_type", "method", "timing", "value", "unit")
COLUMNS = ("entity_id", "chart_id", "section_id", "entity_type", "entity_text", "normalized_text", "source", "source_confidence", "cui", *META, "start_offset", "end_offset", "extracted_at")


_KINDS = {"match_score": "double", "confidence": "double", "start_offset": "int", "end_offset": "int", "extracted_at": "timestamp"}


def with_columns(layer: DataFrame) -> DataFrame:
    """A layer with nulls for the columns it lacks."""
    names = [c for c in (*COLUMNS, "match_score", "confidence") if c not in ("normalized_text", "source", "source_confidence")]
    return layer.withColumns({c: F.lit(None).cast(_KINDS.get(c, "string")) for c in names if c not in layer.columns})


def normalize_layers(dictionary: DataFrame, ner: DataFrame, llm: DataFrame) -> DataFrame:
    """The three layers in one shape."""
    none = lambda c: F.lit(None).cast("string").alias(c)

    def shape(df: DataFrame, source: str, confidence: str, cui: Column, meta: bool) -> DataFrame:
        extra = [F.col(c) if meta else none(c) for c in META]
        return df.where("entity_text is not null").select("entity_id", "chart_id", "section_id", "entity_type", "entity_text", norm_text(F.col("entity_text")).alias("normalized_text"), F.lit(source).alias("source"), F.col(confidence).alias("source_confidence"), cui.alias("cui"), *extra, "start_offset", "end_offset", "extracted_at")

    layers = [shape(dictionary, "dictionary", "match_score", F.col("cui"), False), shape(ner, "ner", "model_confidence" if "model_confidence" in ner.columns else "confidence", F.lit(None).cast("string"), False), shape(llm, "llm", "confidence", F.lit(None).cast("string"), True)]
    return layers[0].unionByName(layers[1]).unionByName(layers[2])


def _best(value: str, weight: str) -> Column:
    """The value of greatest weight among those that are not null."""
    return F.max(F.when(F.col(value).isNotNull(), F.struct(F.coalesce(F.col(weight), F.lit(-1.0)).alias("w"), F.col(value).alias("v"))))["v"].alias(value)


def merge_exact(entities: DataFrame) -> DataFrame:
    """One row per chart, type and normalised text."""
    longest = F.max(F.struct(F.length("entity_text").alias("n"), F.col("entity_text").alias("t")))["t"].alias("entity_text")
    # Both ends of the span come from one row: the surest that has a span, of those the first.
    surest = F.max(F.when(F.col("start_offset").isNotNull(), F.struct(F.coalesce("source_confidence", F.lit(-1.0)).alias("w"), F.negative("start_offset").alias("a"), "end_offset"))).alias("_span")
    return entities.groupBy("chart_id", "entity_type", "normalized_text").agg(
        longest, F.min("section_id").alias("section_id"), F.sort_array(F.collect_set("source")).alias("sources"), F.sort_array(F.collect_set("entity_id")).alias("source_entity_ids"),
        F.countDistinct("source").cast("int").alias("match_count"), F.max("source_confidence").alias("source_confidence"), F.max("cui").alias("cui"), *[_best(c, "source_confidence") for c in META], surest,
    ).withColumns({"start_offset": F.negative("_span.a"), "end_offset": F.col("_span.end_offset")}).drop("_span")


def contained_texts(groups: DataFrame, within: tuple[str, ...] = ("chart_id", "entity_type"), column: str = "normalized_text") -> DataFrame:
    """(within..., long, short): every text and the other texts of the same chart and type it contains.

    A short text meets only long texts that have its first characters somewhere: each text
    is listed under its first (up to six) characters, and under every place's characters of
    the lengths that such beginnings have in its chart and type.
    """
    t = groups.where("chart_id is not null and entity_type is not null").select(*within, F.col(column).alias("t")).where(F.length("t") > 0).distinct()
    short = t.select(*within, F.col("t").alias("short"), F.substring("t", 1, 6).alias("key"))
    lengths = short.groupBy(*within).agg(F.collect_set(F.length("key")).alias("_k"))  # at most six
    places = t.join(lengths, list(within)).select(*within, F.col("t").alias("long"), F.explode("_k").alias("k"))
    at = F.transform(F.sequence(F.lit(1), F.length("long") - F.col("k") + 1), lambda i: F.substr(F.col("long"), i, F.col("k")))
    keys = places.where(F.length("long") > F.col("k")).select(*within, "long", F.explode(F.array_distinct(at)).alias("key"))
    return keys.join(short, [*within, "key"]).where((F.length("long") > F.length("short")) & F.contains("long", "short")).select(*within, "long", "short").distinct()


def merge_containment(groups: DataFrame) -> DataFrame:
    """Texts contained in a longer text of the same chart and type are absorbed by it."""
    names = ("chart_id", "entity_type")
    pairs = contained_texts(groups)
    small = groups.select(*names, F.col("normalized_text").alias("short"), F.col("sources").alias("_s"), F.col("source_entity_ids").alias("_i"), F.col("match_count").alias("_m"))
    hit = pairs.join(small, [*names, "short"])
    gain = hit.groupBy(*names, F.col("long").alias("normalized_text")).agg(F.flatten(F.collect_list("_s")).alias("_s"), F.flatten(F.collect_list("_i")).alias("_i"), F.sum("_m").alias("_m"))
    gone = hit.select(*names, F.col("short").alias("normalized_text")).distinct()
    kept = groups.join(gone, [*names, "normalized_text"], "left_anti").join(gain, [*names, "normalized_text"], "left")
    union = lambda a, b: F.sort_array(F.array_distinct(F.concat(F.col(a), F.coalesce(F.col(b), F.array().cast("array<string>")))))
    return kept.withColumns({"sources": union("sources", "_s"), "source_entity_ids": union("source_entity_ids", "_i"), "match_count": (F.col("match_count") + F.coalesce("_m", F.lit(0))).cast("int")}).drop("_s", "_i", "_m")


def merge_concept(groups: DataFrame) -> DataFrame:
    """Rows of one concept within a chart and type become one; rows without a concept pass."""
    longest = F.max(F.struct(F.length("entity_text").alias("n"), F.col("entity_text").alias("t"), F.col("normalized_text").alias("x")))
    with_cui = groups.where("cui is not null").groupBy("chart_id", "entity_type", "cui").agg(
        longest.alias("_l"), F.min("section_id").alias("section_id"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("source_entity_ids")))).alias("source_entity_ids"),
        F.sum("match_count").cast("int").alias("match_count"), *[_best(c, "source_confidence") for c in META], F.max("source_confidence").alias("source_confidence"), F.max(F.when(F.col("start_offset").isNotNull(), F.struct(F.coalesce("source_confidence", F.lit(-1.0)).alias("w"), F.negative("start_offset").alias("a"), "end_offset"))).alias("_span"),
    )
    with_cui = with_cui.withColumns({"start_offset": F.negative("_span.a"), "end_offset": F.col("_span.end_offset")}).drop("_span")
    with_cui = with_cui.withColumns({"entity_text": F.col("_l.t"), "normalized_text": F.col("_l.x")}).drop("_l")
    return with_cui.unionByName(groups.where("cui is null").select(*with_cui.columns))


def ensemble_score(sources: Column, text: Column) -> Column:
    """Confidence by number and kind of sources, spread a little by the text's length."""
    n, size = F.size(F.array_distinct(sources)), F.length(text)
    spread = lambda base, mod: F.lit(base) + (size % mod) / F.lit(1000.0)
    one = F.when(F.array_contains(sources, "dictionary"), spread(0.78, 20)).when(F.array_contains(sources, "ner"), spread(0.73, 20)).when(F.array_contains(sources, "llm"), spread(0.65, 100)).otherwise(0.70)
    return F.round(F.when(n >= 3, spread(0.95, 30)).when(n == 2, spread(0.85, 70)).otherwise(one), 6)


def attach_context(groups: DataFrame, sections: DataFrame) -> DataFrame:
    """Merged entities with id, score and the text of their section (its first row by order and text)."""
    first = sections.groupBy("section_id").agg(F.min(F.struct(F.coalesce("section_order", F.lit(1 << 30)).alias("o"), F.col("section_text").alias("t")))["t"].alias("entity_context"))
    scored = groups.withColumn("ensemble_confidence", ensemble_score(F.col("sources"), F.col("entity_text")))
    # Rows without a section have nothing to join and would all meet in one task.
    out = scored.where("section_id is not null").join(first, "section_id", "left").unionByName(scored.where("section_id is null"), allowMissingColumns=True)
    return out.withColumn("match_count", F.size(F.array_distinct("sources"))).withColumn("entity_id", stable_id("ENT-MERGED-", "chart_id", "entity_type", "normalized_text"))


def merge_layers(dictionary: DataFrame, ner: DataFrame, llm: DataFrame, sections: DataFrame) -> DataFrame:
    """All merge steps, end to end."""
    return attach_context(merge_concept(merge_containment(merge_exact(normalize_layers(dictionary, ner, llm)))), sections)


def source_group(sources: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(sources)), " + ")


def source_category(sources: Column) -> Column:
    """Whether an entity comes from the dictionary, from a model, or from both."""
    has = lambda k: F.array_contains(sources, k)
    model = has("llm") | has("ner")
    return F.when(has("dictionary") & model, "both").when(has("dictionary"), "dictionary_only").when(has("llm"), "llm_only").when(has("ner"), "ner_only").otherwise("other")
