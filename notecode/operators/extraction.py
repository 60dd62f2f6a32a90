"""Entity extraction by a pluggable model, role split and assertions.

A model is any object with ``extract(texts) -> list[str]``, one JSON array per text. The
default finds terms of a lexicon and reads negation, history, family and doubt from the
words before them (after Chapman 2001 and Harkema 2009); no network is needed.
"""

from __future__ import annotations

import json
import re
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import norm_text, stable_id

FIELDS = ("entity_text", "entity_type", "extraction_role", "confidence", "reasoning", "specimen_type", "method", "timing", "value", "unit", "section_type", "assertion_status", "negation_trigger", "temporality", "experiencer", "certainty")
SCHEMA = "array<struct<" + ", ".join(f"{f} string" for f in FIELDS) + ">>"


class Model(Protocol):
    def extract(self, texts: list[str]) -> list[str]: ...


class RuleModel:
    """Lexicon terms with cue words in the forty characters before them."""

    CUES = (("ABSENT", r"\b(?:no evidence of|denies|without|negative for|no)\b"), ("FAMILY", r"\b(?:mother|father|sister|brother|family history)\b"), ("HISTORICAL", r"\b(?:history of|previous|prior|status post)\b"), ("CONDITIONAL", r"\b(?:if|in case of|allergic to)\b"), ("POSSIBLE", r"\b(?:possible|probable|likely|differential includes|suspected)\b"))

    def __init__(self, terms: dict[str, str]):
        self.terms = {k.lower(): v for k, v in terms.items() if k}
        self.most = max((len(t.split()) for t in self.terms), default=0)
        self.cues = [(k, re.compile(p)) for k, p in self.CUES]

    def extract(self, texts: list[str]) -> list[str]:
        return [json.dumps(self._one(t or "")) for t in texts]

    def _one(self, text: str) -> list[dict]:
        low, out, used = text.lower(), [], 0
        words = list(re.finditer(r"[^\W_]+(?:-[^\W_]+)*", low))
        for i, w in enumerate(words):
            if w.start() < used:
                continue
            for n in range(min(self.most, len(words) - i), 0, -1):
                term = low[w.start() : words[i + n - 1].end()]
                if term in self.terms:
                    used = words[i + n - 1].end()
                    before = re.split(r"[.;\n]", low[max(0, w.start() - 40) : w.start()])[-1]
                    status, cue = next(((k, m[0]) for k, c in self.cues if (m := c.search(before))), ("PRESENT", None))
                    out.append({"entity_text": text[w.start() : used], "entity_type": self.terms[term], "extraction_role": "explicit", "confidence": "0.9", "assertion_status": status, "negation_trigger": cue if status == "ABSENT" else None, "temporality": "HISTORICAL" if status == "HISTORICAL" else "CURRENT", "experiencer": "FAMILY_MEMBER" if status == "FAMILY" else "PATIENT", "certainty": "POSSIBLE" if status == "POSSIBLE" else "DEFINITE"})
                    break
        return out


def model_extract(charts: DataFrame, model: Model) -> DataFrame:
    """(chart_id, extraction_result): one call per chart that has text."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"chart_id": pdf["chart_id"], "extraction_result": model.extract(pdf["raw_text"].tolist())})

    return charts.where(F.length("raw_text") > 0).select("chart_id", "raw_text").mapInPandas(run, "chart_id string, extraction_result string")


def no_answers(charts: DataFrame) -> DataFrame:
    """The answers of no model: an empty list for every chart."""
    return charts.select("chart_id", F.lit("[]").alias("extraction_result"))


def parse_extraction(raw: DataFrame) -> DataFrame:
    """Entities of readable answers; fences are taken off, texts under two characters dropped."""
    body = F.regexp_replace("extraction_result", r"^\s*```(?:json)?|```\s*$", "")
    rows = raw.select("chart_id", F.explode(F.from_json(body, SCHEMA)).alias("e")).select("chart_id", "e.*")
    return rows.where(F.length(F.trim("entity_text")) >= 2).withColumn("confidence", F.coalesce(F.expr("try_cast(confidence as double)"), F.lit(0.75)))


def resolve_sections(parsed: DataFrame, sections: DataFrame) -> DataFrame:
    """The first section of the named type in the entity's chart; null where there is none."""
    first = sections.groupBy("chart_id", "section_type").agg(F.min(F.struct("section_order", "section_id"))["section_id"].alias("section_id"))
    return parsed.join(first, ["chart_id", "section_type"], "left")


def split_roles(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(explicit entities, implicit and abbreviated ones); other roles are left out."""
    columns = ["chart_id", "entity_type", "entity_text", "confidence", "specimen_type", "method", "timing", "value", "unit", "extraction_role"]
    with_id = lambda df, prefix: df.select(stable_id(prefix, "chart_id", "entity_type", norm_text(F.col("entity_text"))).alias("entity_id"), *columns).dropDuplicates(["entity_id"])
    return with_id(parsed.where("extraction_role = 'explicit'"), "ENT-NER-"), with_id(parsed.where("extraction_role in ('implicit', 'abbreviation')"), "ENT-LLM-")


def build_assertions(entities: DataFrame, parsed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One assertion per entity not asserted yet; the strongest statement of its text in the chart, else the defaults."""
    key = norm_text(F.col("entity_text"))
    stated = parsed.groupBy("chart_id", key.alias("_key")).agg(F.max(F.struct("confidence", "assertion_status", "negation_trigger", "temporality", "experiencer", "certainty")).alias("a"))
    rows = entities if existing is None else entities.join(existing.select("entity_id").distinct(), "entity_id", "left_anti")
    j = rows.withColumn("_key", key).join(stated, ["chart_id", "_key"], "left")
    d = lambda c, v: F.coalesce(f"a.{c}", F.lit(v)).alias(c)
    return j.select(stable_id("ASSERT-", "entity_id").alias("assertion_id"), "entity_id", "chart_id", d("assertion_status", "PRESENT"), (F.coalesce("a.assertion_status", F.lit("PRESENT")) == "ABSENT").alias("negation_detected"), F.col("a.negation_trigger").alias("negation_trigger"), d("temporality", "CURRENT"), d("experiencer", "PATIENT"), d("certainty", "DEFINITE"), d("confidence", 0.85))
