"""Dictionary building and exact, fuzzy and abbreviation matching of section texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.clinical import group_entity_type, ngrams, norm_term, stable_id, words

ENTRY = ("term", "term_normalized", "source", "entity_type", "source_code", "cui")


def _part(df: DataFrame, term, source: str, entity_type, code, cui=None) -> DataFrame:
    cui = F.lit(None).cast("string") if cui is None else cui
    return df.select(F.trim(term).alias("term"), F.lit(source).alias("source"), (F.lit(entity_type) if isinstance(entity_type, str) else entity_type).alias("entity_type"), code.cast("string").alias("source_code"), cui.alias("cui"))


def build_dictionary(*, icd10: DataFrame | None = None, loinc: DataFrame | None = None, rxnorm: DataFrame | None = None, umls: DataFrame | None = None, snomed: DataFrame | None = None, abbreviations: DataFrame | None = None) -> DataFrame:
    """The unified dictionary of whatever sources are given; terms without letters or digits are dropped."""
    parts = []
    if icd10 is not None:
        parts.append(_part(icd10.where("is_billable and description is not null"), F.col("description"), "ICD10", "DIAGNOSIS", F.col("code")))
    if loinc is not None:
        for c in ("long_name", "component"):
            parts.append(_part(loinc, F.col(c), "LOINC", "LAB_RESULT", F.col("loinc_code")))
    if rxnorm is not None:
        parts.append(_part(rxnorm, F.col("name"), "RxNorm", "MEDICATION", F.col("rxcui")))
        parts.append(_part(rxnorm.select("rxcui", F.explode("synonyms").alias("s")), F.col("s"), "RxNorm", "MEDICATION", F.col("rxcui")))
    if umls is not None:
        names = F.explode(F.array_union(F.array("preferred_name"), F.coalesce("synonyms", F.array().cast("array<string>"))))
        u = umls.select("cui", "semantic_group", names.alias("s"))
        parts.append(_part(u, F.col("s"), "UMLS", group_entity_type(F.col("semantic_group")), F.col("cui"), F.col("cui")))
    if snomed is not None:
        parts.append(_part(snomed, F.col("concept_name"), "SNOMED", "DIAGNOSIS", F.col("concept_id")))
    if abbreviations is not None:
        kind = F.when(F.col("category") == "diagnosis", "DIAGNOSIS").when(F.col("category") == "lab", "LAB_RESULT").when(F.col("category") == "medication", "MEDICATION").when(F.col("category") == "procedure", "PROCEDURE").otherwise("OTHER")
        for c in ("abbreviation", "expansion"):
            parts.append(_part(abbreviations, F.col(c), "abbreviation", kind, F.col("abbreviation")))
    d = reduce(DataFrame.unionByName, parts).withColumn("term_normalized", norm_term(F.col("term")))
    return d.where("term is not null and term_normalized != ''").select(*ENTRY).distinct()


def extract_ngrams(sections: DataFrame, most: int = 5) -> DataFrame:
    """(chart_id, section_id, ngram): the distinct n-grams of every section row.

    Nothing is shuffled here: repeated section rows are told apart from nothing else until
    the matches, which are few, are cut to one per section and term.
    """
    split = sections.where("section_text is not null").select("chart_id", "section_id", words(F.col("section_text")).alias("w"))
    return split.select("chart_id", "section_id", F.explode(ngrams(F.col("w"), most)).alias("ngram"))


_ORDER = ("source", "source_code", "cui", "term")


def _one_per_term(df: DataFrame) -> DataFrame:
    w = W.partitionBy("section_id", "matched_term").orderBy(F.desc("match_score"), "match_type", *[F.col(c).asc_nulls_first() for c in (*_ORDER, "entity_text")])
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def match_exact(grams: DataFrame, dictionary: DataFrame) -> DataFrame:
    """N-grams that are dictionary terms; the join is broadcast only if the optimiser knows the dictionary to be small."""
    d = dictionary.where(F.length("term_normalized") >= 2)
    hits = grams.join(d, grams.ngram == d.term_normalized).select("chart_id", "section_id", F.col("ngram").alias("entity_text"), F.col("term_normalized").alias("matched_term"), *ENTRY[:1], *ENTRY[2:], F.lit("exact").alias("match_type"), F.lit(1.0).alias("match_score"))
    return _one_per_term(hits)


def _thirds(size: Column) -> list[tuple[Column, Column]]:
    """(start, length) of the three parts of a text of a size."""
    third = F.floor(size / 3).cast("int")
    return [(F.lit(1), third), (third + 1, third), (2 * third + 1, size - 2 * third)]


def fuzzy_pairs(grams: DataFrame, dictionary: DataFrame, max_distance: int = 2, least: float = 0.85) -> DataFrame:
    """(ngram, term_normalized, distance, score) of distinct n-grams and terms of six characters or more that share a word of three.

    With at most two edits one of three parts of the n-gram is untouched, and stands in the
    term moved by no more than two. An n-gram is listed under its three parts, a term under
    all that such parts can be; so texts meet by a third of their characters at its place, and
    not all that share a frequent word.
    """
    if max_distance > 2:
        raise ValueError("three parts are enough for two edits only")
    shape = lambda df, c: df.select(F.col(c).alias("t")).where(F.length("t") >= 6).distinct()
    terms, texts = shape(dictionary, "term_normalized"), shape(grams, "ngram")
    texts = texts.join(terms, "t", "left_anti")
    size = F.length("t")
    parts = F.array(*[F.struct(F.lit(k).alias("part"), F.substr("t", a, n).alias("piece")) for k, (a, n) in enumerate(_thirds(size))])
    left = texts.select(F.col("t").alias("ngram"), size.alias("size"), F.explode(parts).alias("p")).select("ngram", "size", "p.*")
    moved = F.sequence(F.lit(-max_distance), F.lit(max_distance))
    sized = terms.select("t", F.explode(F.transform(moved, lambda m: F.length("t") + m)).alias("size")).where("size >= 6")

    def could(part: int, at: Column, n: Column) -> Column:
        here = F.filter(moved, lambda m: at + m >= 1)
        return F.transform(here, lambda m: F.struct(F.lit(part).alias("part"), F.substr(F.col("t"), at + m, n).alias("piece")))

    pieces = F.array_distinct(F.concat(*[could(k, a, n) for k, (a, n) in enumerate(_thirds(F.col("size")))]))
    right = sized.select(F.col("t").alias("term_normalized"), "size", F.explode(pieces).alias("p")).select("term_normalized", "size", "p.*")
    long_words = lambda c: F.filter(F.split(c, " "), lambda w: F.length(w) >= 3)
    pairs = left.join(right, ["size", "part", "piece"]).select("ngram", "term_normalized").distinct()
    pairs = pairs.withColumn("distance", F.levenshtein("ngram", "term_normalized", max_distance)).where("distance between 1 and " + str(max_distance))
    pairs = pairs.where(F.arrays_overlap(long_words("ngram"), long_words("term_normalized")))
    score = 1 - F.col("distance") / F.greatest(F.length("ngram"), F.length("term_normalized"))
    return pairs.withColumn("score", F.round(score, 6)).where(F.col("score") >= least)


def match_fuzzy(grams: DataFrame, dictionary: DataFrame, max_distance: int = 2, least: float = 0.85) -> DataFrame:
    pairs = fuzzy_pairs(grams, dictionary, max_distance, least)
    hits = grams.join(pairs, "ngram").join(dictionary, "term_normalized").select("chart_id", "section_id", F.col("ngram").alias("entity_text"), F.col("term_normalized").alias("matched_term"), *ENTRY[:1], *ENTRY[2:], F.lit("fuzzy").alias("match_type"), F.col("score").alias("match_score"))
    return _one_per_term(hits)


def match_abbreviation(sections: DataFrame, abbreviations: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Upper-case tokens that abbreviate a dictionary term; marks do not count on either side."""
    key = lambda c: F.upper(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    tokens = sections.where("section_text is not null").select("chart_id", "section_id", F.explode(F.split("section_text", r"\s+")).alias("token"))
    tokens = tokens.select("chart_id", "section_id", key(F.col("token")).alias("key")).where(F.length("key").between(2, 10)).distinct()
    a = abbreviations.select(key(F.col("abbreviation")).alias("key"), norm_term(F.col("expansion")).alias("term_normalized"))
    hits = tokens.join(a, "key").join(dictionary, "term_normalized").select("chart_id", "section_id", F.col("key").alias("entity_text"), F.col("term_normalized").alias("matched_term"), *ENTRY[:1], *ENTRY[2:], F.lit("abbreviation").alias("match_type"), F.lit(0.95).alias("match_score"))
    return _one_per_term(hits)


def extract_dictionary_entities(sections: DataFrame, dictionary: DataFrame, abbreviations: DataFrame | None = None, most: int = 5) -> DataFrame:
    """All matches of all sections, the best per section and term."""
    grams = extract_ngrams(sections, most)
    hits = match_exact(grams, dictionary).unionByName(match_fuzzy(grams, dictionary))
    if abbreviations is not None:
        hits = hits.unionByName(match_abbreviation(sections, abbreviations, dictionary))
    return _one_per_term(hits).withColumn("entity_id", stable_id("ENT-DICT-", "section_id", "matched_term"))
