"""Coding entities: ontology joins first, a pluggable model for the rest, validation against reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.clinical import is_specific, norm_term, stable_id
from ..functions.skew import hot_keys, lookup_join
from .feedback import ask, salvaged


def active_entities(merged: DataFrame, assertions: DataFrame, coded: DataFrame) -> DataFrame:
    """Entities that are present, current and the patient's own, and not coded yet.

    Assertions are found through ``source_entity_ids``; an entity is active only if all of
    them agree. Entities without assertions are active.
    """
    odd = (F.coalesce("assertion_status", F.lit("PRESENT")) != "PRESENT") | (F.coalesce("experiencer", F.lit("PATIENT")) != "PATIENT") | (F.coalesce("temporality", F.lit("CURRENT")) != "CURRENT")
    barred = assertions.where(odd).select(F.col("entity_id").alias("_source")).distinct()
    links = merged.select("entity_id", F.explode("source_entity_ids").alias("_source")).join(barred, "_source").select("entity_id").distinct()
    return merged.join(links, "entity_id", "left_anti").join(coded.select("entity_id").distinct(), "entity_id", "left_anti")


def _entries(dictionary: DataFrame) -> DataFrame:
    """Entries with a code, under their term as ``key``."""
    d = dictionary.where("source_code is not null").select("term_normalized", F.col("source").alias("match_source"), F.col("entity_type").alias("term_type"), "source_code", F.col("cui").alias("term_cui"))
    return d.withColumn("key", F.col("term_normalized"))


def _as_exact(matches: DataFrame) -> DataFrame:
    return matches.withColumns({"tier1_confidence": F.lit(0.98), "tier1_method": F.lit("exact"), "edit_distance": F.lit(0)})


def tier1_exact(active: DataFrame, dictionary: DataFrame) -> DataFrame:
    rows = active.withColumn("key", norm_term(F.col("entity_text"))).where("key is not null")
    # A frequent text may hold a large share of the rows: it is spread over several tasks.
    hot = hot_keys(rows.groupBy("key").agg(F.count("*").alias("n")), "key")
    return _as_exact(lookup_join(rows, _entries(dictionary), "key", hot))


def tier1_fuzzy(active: DataFrame, exact: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The closest dictionary term that shares a word of three letters, within 30 % of the text's length, three edits at least."""
    d = dictionary.where("source_code is not null").select("term_normalized", F.col("source").alias("match_source"), F.col("entity_type").alias("term_type"), "source_code", F.col("cui").alias("term_cui"))
    rest = active.join(exact.select("entity_id").distinct(), "entity_id", "left_anti").withColumn("key", norm_term(F.col("entity_text")))
    keys = rest.select("key").where(F.length("key") > 0).distinct()  # entities repeat; distances are taken once per text
    words = lambda c: F.explode(F.array_distinct(F.filter(F.split(c, " "), lambda w: F.length(w) >= 3)))
    left = keys.select("key", words("key").alias("token"), F.length("key").alias("size"))
    terms = d.select("term_normalized").distinct()
    right = terms.select("term_normalized", words("term_normalized").alias("token"))
    right = right.withColumn("size", F.explode(F.sequence(F.length("term_normalized") - 5, F.length("term_normalized") + 5)))
    pairs = left.join(right, ["token", "size"]).select("key", "term_normalized").distinct()
    most = F.greatest((F.length("key") * 0.3).cast("int"), F.lit(3))
    pairs = pairs.withColumn("edit_distance", F.levenshtein("key", "term_normalized")).where(F.col("edit_distance") <= most)
    best = pairs.groupBy("key").agg(F.min(F.struct("edit_distance", "term_normalized")).alias("m")).select("key", "m.edit_distance", "m.term_normalized")
    confidence = F.round(F.greatest(0.92 - 0.01 * F.col("edit_distance"), F.lit(0.80)), 3)
    return rest.join(best, "key").join(d, "term_normalized").withColumns({"tier1_confidence": confidence, "tier1_method": F.lit("fuzzy")})


def _best(df: DataFrame, code: str) -> DataFrame:
    w = W.partitionBy("entity_id").orderBy(F.desc("confidence"), "edit_distance", F.asc_nulls_last(code), "match_source")
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def resolve_icd10(matches: DataFrame, icd_ref: DataFrame, dictionary: DataFrame, snomed_map: DataFrame) -> DataFrame:
    """The best ICD-10 code of an entity: by its own dictionary code, through its concept, or through its SNOMED term."""
    ref = icd_ref.where("is_billable").groupBy(F.upper("code_raw").alias("raw")).agg(F.min("code").alias("icd10_code"), F.min_by("description", "code").alias("icd10_description"))
    own = matches.where("match_source = 'ICD10' and entity_type = 'DIAGNOSIS'").withColumn("raw", F.upper(F.regexp_replace("source_code", r"\.", ""))).join(ref, "raw").drop("raw").withColumn("weight", F.lit(1.0))
    names = icd_ref.select(F.col("code").alias("icd10_code"), F.col("description").alias("icd10_description")).dropDuplicates(["icd10_code"])
    # Of the codes that one path gives a match only the least can be its best, so a concept has one code here, however many terms it has.
    first = snomed_map.where("map_priority = 1").groupBy("snomed_concept_id").agg(F.min("icd10_code").alias("icd10_code"))
    cuis = dictionary.where("source = 'SNOMED' and cui is not null").select(F.col("cui").alias("term_cui"), F.col("source_code").alias("snomed_concept_id")).distinct()
    via_cui = cuis.join(first, "snomed_concept_id").groupBy("term_cui").agg(F.min("icd10_code").alias("icd10_code"))
    concept = matches.where("term_cui is not null").join(via_cui, "term_cui").join(names, "icd10_code", "left").withColumn("weight", F.lit(0.95))
    snomed = matches.where("match_source = 'SNOMED'").join(first, F.col("source_code") == F.col("snomed_concept_id")).drop("snomed_concept_id").join(names, "icd10_code", "left").withColumn("weight", F.lit(0.96))
    all_ = own.unionByName(concept.select(*own.columns)).unionByName(snomed.select(*own.columns))
    return _best(all_.withColumn("confidence", F.round(F.col("tier1_confidence") * F.col("weight"), 4)), "icd10_code")


def resolve_icd10_exact(active: DataFrame, icd_ref: DataFrame, dictionary: DataFrame, snomed_map: DataFrame) -> DataFrame:
    """``resolve_icd10`` of the exact matches of ``active``, without a row for every entity and entry that share a text.

    What an exact match leads to depends on the text and on whether it is a diagnosis, on
    nothing else of the entity. So the code is chosen once per such text, and then given to
    the entities; the rows are those of the entities and of the dictionary, not their product.
    """
    kind = F.when(F.col("entity_type") == "DIAGNOSIS", "D").otherwise("-")
    rows = active.withColumn("key", norm_term(F.col("entity_text"))).where("key is not null").withColumn("_text", F.concat(kind, "key"))
    counts = rows.groupBy("_text").agg(F.count("*").alias("n"))
    texts = counts.select(F.col("_text").alias("entity_id"), F.when(F.startswith("_text", F.lit("D")), "DIAGNOSIS").alias("entity_type"), F.substr("_text", F.lit(2)).alias("key"))
    best = resolve_icd10(_as_exact(texts.join(_entries(dictionary), "key")), icd_ref, dictionary, snomed_map)
    best = best.drop("entity_type", "key").withColumnRenamed("entity_id", "_text")
    return _best(lookup_join(rows, best, "_text", hot_keys(counts, "_text")).drop("_text"), "icd10_code")


def resolve_loinc(matches: DataFrame, labs: DataFrame, loinc_ref: DataFrame) -> DataFrame:
    """The best LOINC code of a lab entity: by dictionary code, else by the component's first word and agreeing axes."""
    ref = loinc_ref.select("loinc_code", "long_name", "component", "system_specimen", F.col("method").alias("ref_method"))
    own = matches.where("match_source = 'LOINC' and entity_type = 'LAB_RESULT'").join(ref, F.col("source_code") == F.col("loinc_code")).select("entity_id", "entity_text", "loinc_code", "long_name", F.col("tier1_confidence").alias("confidence"), "edit_distance", "match_source")
    rest = labs.join(own.select("entity_id").distinct(), "entity_id", "left_anti").withColumn("word", F.split_part(norm_term(F.col("entity_text")), F.lit(" "), F.lit(1))).where("word != ''")
    pairs = rest.join(ref.withColumn("word", F.split_part(norm_term(F.col("component")), F.lit(" "), F.lit(1))), "word")
    has = lambda c: F.coalesce(F.contains(F.lower("long_name"), F.lower(c)), F.lit(False)) & (F.coalesce(F.length(c), F.lit(0)) > 0)
    score = F.when(has("entity_text"), 3).otherwise(0) + F.when(has("specimen_type"), 2).otherwise(0) + F.when(has("method"), 2).otherwise(0) + F.when(has("timing"), 1).otherwise(0)
    # Timing adds to the score but does not admit a pair.
    agrees = has("entity_text") | has("specimen_type") | has("method")
    axes = pairs.withColumn("score", score).where(agrees).select("entity_id", "entity_text", "loinc_code", "long_name", F.round(0.88 + 0.015 * F.col("score"), 3).alias("confidence"), F.lit(0).alias("edit_distance"), F.lit("LOINC axes").alias("match_source"))
    return _best(own.unionByName(axes), "loinc_code")


def unresolved(active: DataFrame, icd: DataFrame, loinc: DataFrame) -> DataFrame:
    """Diagnoses without an ICD-10 code and labs without a LOINC code."""
    dx = active.where("entity_type = 'DIAGNOSIS'").join(icd.select("entity_id"), "entity_id", "left_anti")
    labs = active.where("entity_type = 'LAB_RESULT'").join(loinc.select("entity_id"), "entity_id", "left_anti")
    return dx.unionByName(labs)


#: Entities in one prompt, about.
PROMPT_ENTITIES = 200


def chart_prompts(rows: DataFrame) -> DataFrame:
    """Prompts of a chart with a line per entity, in id order; nulls are empty fields, so lines and ids stay aligned.

    A chart with more than ``PROMPT_ENTITIES`` entities has as many prompts as it takes: its
    entities are dealt out by a hash of their id, so that no prompt and no task grows with the chart.
    """
    line = F.concat_ws(" | ", *[F.coalesce(c, F.lit("")) for c in ("entity_id", "entity_type", "entity_text", "value", "unit")])
    counts = rows.where("chart_id is not null").groupBy("chart_id").agg(F.count("*").alias("n"))
    parts = counts.select("chart_id", F.ceil(F.col("n") / PROMPT_ENTITIES).alias("_parts"))
    dealt = F.pmod(F.conv(F.substring(F.md5("entity_id"), 1, 8), 16, 10).cast("long"), F.col("_parts"))
    packed = lookup_join(rows, parts, "chart_id", hot_keys(counts, "chart_id")).withColumn("part", dealt.cast("int")).groupBy("chart_id", "part").agg(F.array_sort(F.collect_list(F.struct("entity_id", line.alias("line")))).alias("p"))
    return packed.select("chart_id", "part", F.transform("p", lambda x: x["entity_id"]).alias("entity_ids"), F.array_join(F.transform("p", lambda x: F.concat(F.lit("- "), x["line"])), "\n").alias("prompt"), F.size("p").alias("n_entities"))


def tier1_all(exact: DataFrame, fuzzy: DataFrame) -> DataFrame:
    """Exact and fuzzy matches in one shape."""
    columns = ["entity_id", "chart_id", "entity_type", "entity_text", "term_normalized", "match_source", "term_type", "source_code", "term_cui", "tier1_confidence", "tier1_method", "edit_distance"]
    return exact.select(*columns).unionByName(fuzzy.select(*columns))


INSTRUCTIONS = "Assign the most specific billable ICD-10-CM code to each diagnosis and the fitting LOINC code to each lab result below. Answer with a JSON array of entity_id, code, description, confidence (0 to 1), reasoning.\n\n"


def model_code(prompts: DataFrame, model) -> DataFrame:
    """(chart_id, part, entity_ids, coding_result): one model call per prompt; ``model.answer`` turns prompts into JSON arrays."""
    asked = ask(prompts.withColumn("prompt", F.concat(F.lit(INSTRUCTIONS), "prompt")), model, answer="coding_result")
    return asked.select("chart_id", "part", "entity_ids", "coding_result")


ANSWER = "array<struct<entity_id string, code string, description string, confidence string, reasoning string>>"


def parse_codes(raw: DataFrame) -> DataFrame:
    """Answers of a model by the entity id they echo, by position where it is missing; unreadable answers give no rows."""
    rows = raw.select("chart_id", "entity_ids", salvaged(F.col("coding_result"), ANSWER).alias("a")).select("chart_id", "entity_ids", F.posexplode("a").alias("pos", "x"))
    asked = F.coalesce(F.when(F.array_contains("entity_ids", F.col("x.entity_id")), F.col("x.entity_id")), F.when(F.col("x.entity_id").isNull(), F.get("entity_ids", F.col("pos"))))
    confidence = F.coalesce(F.expr("try_cast(x.confidence as double)"), F.lit(0.75))
    return rows.select("chart_id", asked.alias("entity_id"), F.col("x.code").alias("code"), F.col("x.description").alias("description"), confidence.alias("confidence"), F.col("x.reasoning").alias("reasoning")).where("entity_id is not null and code is not null")


def validate_icd10(codes: DataFrame, icd_ref: DataFrame) -> DataFrame:
    """A model's codes with the reference's description; unknown or not billable ones lose confidence."""
    ref = icd_ref.groupBy(F.col("code").alias("ref_code")).agg(F.max("description").alias("ref_description"), F.max("is_billable").alias("is_billable"))
    j = codes.join(ref, F.col("code") == F.col("ref_code"), "left")
    final = F.when(F.col("ref_code").isNull(), 0.60).when(F.col("is_billable"), F.col("confidence")).otherwise(F.greatest(F.col("confidence") - 0.05, F.lit(0.60)))
    return j.select(*codes.columns, F.coalesce("ref_description", "description").alias("final_description"), F.round(final, 4).alias("final_confidence"), F.col("ref_code").isNotNull().alias("code_validated"))


def validate_loinc(codes: DataFrame, loinc_ref: DataFrame | None) -> DataFrame:
    if loinc_ref is None:
        return codes.withColumns({"final_description": F.col("description"), "final_confidence": F.col("confidence"), "code_validated": F.lit(False)})
    ref = loinc_ref.groupBy(F.col("loinc_code").alias("ref_code")).agg(F.max("long_name").alias("ref_description"))
    j = codes.join(ref, F.col("code") == F.col("ref_code"), "left")
    return j.select(*codes.columns, F.coalesce("ref_description", "description").alias("final_description"), F.when(F.col("ref_code").isNull(), 0.60).otherwise(F.col("confidence")).alias("final_confidence"), F.col("ref_code").isNotNull().alias("code_validated"))


def assemble_icd10(tier1: DataFrame, tier2: DataFrame) -> DataFrame:
    """Mappings of both tiers in one shape."""
    reason = F.concat_ws(", ", F.concat(F.lit("Ontology "), "tier1_method", F.lit(" match in "), "match_source"), F.concat(F.lit("CUI: "), "term_cui"))
    one = tier1.select("entity_id", "chart_id", "entity_text", "icd10_code", "icd10_description", "confidence", F.lit("ONTOLOGY_DIRECT").alias("resolution_path"), reason.alias("reasoning"))
    two = tier2.select("entity_id", "chart_id", "entity_text", F.col("code").alias("icd10_code"), F.col("final_description").alias("icd10_description"), F.col("final_confidence").alias("confidence"), F.lit("LLM_ASSIGNED").alias("resolution_path"), "reasoning")
    out = one.unionByName(two)
    return out.withColumn("is_specific", is_specific(F.col("icd10_code"))).withColumn("mapping_id", stable_id("MAP-ICD-", "entity_id", "icd10_code"))


def assemble_loinc(tier1: DataFrame, tier2: DataFrame, merged: DataFrame) -> DataFrame:
    meta = merged.select("entity_id", "specimen_type", "method", "timing").dropDuplicates(["entity_id"])
    one = tier1.select("entity_id", "entity_text", "loinc_code", F.col("long_name").alias("loinc_long_name"), "confidence", F.lit("ONTOLOGY_DIRECT").alias("resolution_path"))
    two = tier2.select("entity_id", "entity_text", F.col("code").alias("loinc_code"), F.col("final_description").alias("loinc_long_name"), F.col("final_confidence").alias("confidence"), F.lit("LLM_ASSIGNED").alias("resolution_path"))
    return one.unionByName(two).join(meta, "entity_id", "left").withColumn("mapping_id", stable_id("MAP-LOI-", "entity_id", "loinc_code"))


def assemble_umls(matches: DataFrame, hierarchy: DataFrame, existing: DataFrame) -> DataFrame:
    """Concept mappings of matches with a concept, with the SNOMED name where the match is one."""
    names = hierarchy.select(F.col("concept_id").alias("source_code"), F.col("concept_name").alias("snomed_name")).distinct()
    m = matches.where("term_cui is not null").select("entity_id", "chart_id", "entity_text", F.col("term_cui").alias("cui"), "match_source", "source_code", F.col("tier1_method").alias("mapping_method"), F.col("tier1_confidence").alias("confidence")).distinct()
    out = m.join(names, "source_code", "left").join(existing.select("entity_id", "cui").distinct(), ["entity_id", "cui"], "left_anti")
    return out.withColumn("mapping_id", stable_id("UMLS-", "entity_id", "cui", "source_code"))


def coverage_by_type(active: DataFrame, icd: DataFrame, loinc: DataFrame, umls: DataFrame) -> DataFrame:
    """Entities of each type, and how many of them have a code of each system; a type's share is that of the better code system."""
    marks = [m.select("entity_id").where("entity_id is not null").distinct().select("entity_id", F.lit(k).alias("system")) for k, m in (("icd10_coded", icd), ("loinc_coded", loinc), ("umls_mapped", umls))]
    coded = marks[0].unionByName(marks[1]).unionByName(marks[2]).groupBy("entity_id").agg(F.collect_set("system").alias("_s"))  # at most three
    rows = active.select("entity_id", "entity_type").distinct().join(coded, "entity_id", "left")
    named = ("icd10_coded", "loinc_coded", "umls_mapped")
    out = rows.groupBy("entity_type").agg(F.count("*").alias("total_entities"), *[F.count_if(F.array_contains("_s", k)).alias(k) for k in named])
    return out.withColumn("coding_pct", F.round(F.greatest("icd10_coded", "loinc_coded") * 100.0 / F.greatest("total_entities", F.lit(1)), 1))
