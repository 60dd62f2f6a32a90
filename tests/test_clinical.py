import pytest
from pyspark.sql import functions as F

from notecode.functions import clinical
from notecode.functions.skew import hot_keys, lookup_join
from notecode.operators import coding, dictionary_match, extraction, feedback, merge, sections, serving
from notecode.sources import ontology


def test_text_layer_edges(spark):
    df = spark.createDataFrame([(None,), ("",), ("x" * 100,), ("word " * 30,), ("12 34 " * 30,)], "t string")
    assert [r[0] for r in df.select(sections.has_text_layer(F.col("t"))).collect()] == [False, False, False, True, False]
    assert [r[0] for r in df.select(sections.is_meaningful(F.col("t"))).collect()] == [False] * 5


NOTE = "CHIEF COMPLAINT:\nPain in the left knee since Monday.\n## HPI\nPenicillin was given once.\nMEDICATIONS:\n\nASSESSMENT/PLAN: rest\n"


def test_segmentation(spark):
    charts = spark.createDataFrame([("a", NOTE), ("b", "short"), ("c", None), ("d", "no headings at all " * 10)], "chart_id string, raw_text string")
    got = [(r.section_type, r.section_text) for r in sections.segment_sections(charts).orderBy("section_order").collect()]
    assert got == [("CHIEF_COMPLAINT", "Pain in the left knee since Monday."), ("HPI", "Penicillin was given once."), ("ASSESSMENT_PLAN", "rest")]
    exact = [r.section_type for r in sections.segment_sections_exact(charts).collect()]
    assert "PHYSICAL_EXAM" in exact  # the literal rules read `Pe` at a line's start as a heading
    rest = sections.segment_sections_fallback(charts, sections.segment_sections(charts))
    assert {r.chart_id for r in rest.collect()} == {"b", "d"}


def test_ngrams_against_python(spark):
    texts = ["Left knee, left knee", "", "a-b c", "één twee drie vier"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", clinical.words(F.col("t")).alias("w")).select("t", clinical.ngrams(F.col("w"), 3).alias("g"))
    for r in df.collect():
        import re

        words = re.sub(r"[^\w\s]", "", r.t.lower()).split()
        assert set(r.g) == {" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)}


def test_dictionary_and_matching(spark):
    concepts = spark.createDataFrame([("C1", "Knee pain", "DISO", ["Gonalgia"]), ("C2", "Myocardial infarction", "DISO", None), ("C3", "???", "DISO", [])], "cui string, preferred_name string, semantic_group string, synonyms array<string>")
    d = dictionary_match.build_dictionary(umls=concepts)
    assert {r.term_normalized for r in d.collect()} == {"knee pain", "gonalgia", "myocardial infarction"}
    s = spark.createDataFrame([("c", "s1", "Knee pain; knee pain. Acute miocardial infarction, A.M.I."), ("c", "s2", None)], "chart_id string, section_id string, section_text string")
    abb = spark.createDataFrame([("AMI", "Myocardial infarction", "diagnosis", None)], "abbreviation string, expansion string, category string, context_hint string")
    got = {(r.matched_term, r.match_type) for r in dictionary_match.extract_dictionary_entities(s, d, abb, 3).collect()}
    assert got == {("knee pain", "exact"), ("myocardial infarction", "abbreviation")} or got == {("knee pain", "exact"), ("myocardial infarction", "fuzzy")}


LAYER = "entity_id string, chart_id string, section_id string, entity_type string, entity_text string, match_score double, confidence double, cui string, specimen_type string, method string, timing string, value string, unit string, start_offset int, end_offset int, extracted_at timestamp"


def layer(spark, *rows):
    return spark.createDataFrame([(i, "c", None, "DIAGNOSIS", t, s, s, cui, None, None, None, v, None, None, None, None) for i, t, s, cui, v in rows], LAYER)


def test_merge_keeps_values_and_absorbs(spark):
    d = layer(spark, ("d1", "Knee  pain", 1.0, "C1", None), ("d2", None, 1.0, "C1", None))
    n = layer(spark, ("n1", "knee pain left", 0.8, None, None), ("n2", "100%", 0.8, None, None))
    m = layer(spark, ("l1", "KNEE PAIN", 0.4, None, "7"))
    exact = merge.merge_exact(merge.normalize_layers(d, n, m))
    pain = exact.where("normalized_text = 'knee pain'").head()
    assert pain.sources == ["dictionary", "llm"] and pain.value == "7" and pain.match_count == 2
    kept = {r.normalized_text: r for r in merge.merge_containment(exact).collect()}
    assert set(kept) == {"knee pain left", "100%"} and kept["knee pain left"].match_count == 3
    empty = layer(spark)
    assert merge.merge_containment(merge.merge_exact(merge.normalize_layers(empty, empty, empty))).count() == 0


def test_containment_against_brute_force(spark):
    import random

    rng = random.Random(3)
    texts = sorted({"".join(rng.choice("ab c") for _ in range(rng.randint(1, 10))) for _ in range(120)})
    rows = [(c, "T", t) for c in ("c1", "c2") for k, t in enumerate(texts) if c == "c1" or k % 2]
    got = {(r.chart_id, r.long, r.short) for r in merge.contained_texts(spark.createDataFrame(rows, "chart_id string, entity_type string, normalized_text string")).collect()}
    assert got == {(c, a, b) for c, _, a in rows for d, _, b in rows if c == d and len(a) > len(b) and b in a}


def test_codes(spark):
    raw = spark.createDataFrame([("c", ["e1", "e2"], '```json\n[{"entity_id":"e2","code":"B","confidence":"x"},{"code":"C","confidence":"0.5"},{"entity_id":"e9","code":"D"}]\n```'), ("c2", ["e3"], "garbage")], "chart_id string, entity_ids array<string>, coding_result string")
    assert {(r.entity_id, r.code, r.confidence) for r in coding.parse_codes(raw).collect()} == {("e2", "B", 0.75), ("e2", "C", 0.5)}
    codes = spark.createDataFrame([("e1", "A00.1", "d", 0.9), ("e2", "X", "d", 0.9), ("e3", "A00", "d", 0.62)], "entity_id string, code string, description string, confidence double")
    ref = spark.createDataFrame([("A00.1", "A001", "one", True), ("A00", "A00", "two", False)], "code string, code_raw string, description string, is_billable boolean")
    assert {r.entity_id: (r.final_confidence, r.code_validated) for r in coding.validate_icd10(codes, ref).collect()} == {"e1": (0.9, True), "e2": (0.6, False), "e3": (0.6, True)}


GOLD = "chart_id string, entity_type string, entity_text string, annotation_round int"


def test_kappa(spark):
    k = lambda rows: feedback.cohen_kappa(spark.createDataFrame(rows, GOLD)).head().kappa
    assert k([]) is None
    assert k([("c", "D", "a", 1), ("c", "D", "A ", 2)]) == 1.0
    assert k([("c", "D", "a", 1), ("c", "D", "b", 2)]) < 0


def test_prf(spark):
    found = spark.createDataFrame([("c", "D", "a", 0), ("c", "D", "x", 0), ("c", "D", None, 0)], GOLD)
    gold = spark.createDataFrame([("c", "D", "A", 2), ("c", "D", "b", 2), ("c", "D", "old", 1)], GOLD)
    r = feedback.prf_overall(found, gold).head()
    assert (r.true_positives, r.false_positives, r.false_negatives, r.f1_score) == (1, 1, 1, 0.5)
    assert feedback.prf_overall(found.limit(0), gold.limit(0)).head().recall_score is None


def test_gold_import(spark, tmp_path):
    (tmp_path / "a.csv").write_text("chart_id,entity_type,entity_text,start_offset,end_offset,annotator_id,annotation_round\nc,D,a,1,2,,\nc,D,a,1,2,,\n")
    (tmp_path / "b.json").write_text('[{"chart_id": "c", "entity_type": "D", "entity_text": "b"}]')
    first = feedback.import_gold(spark, [str(tmp_path / "a.csv")], [str(tmp_path / "b.json")])
    assert {(r.entity_text, r.annotator_id, r.annotation_round) for r in first.collect()} == {("a", "unknown", 1), ("b", "unknown", 1)}
    assert feedback.import_gold(spark, [str(tmp_path / "a.csv")], [], first).count() == 0


def test_decide(spark):
    m = spark.createDataFrame([("m1", "c", "A", "ICD-10", "DISPUTED_UNRESOLVED", 0.5)], "mapping_id string, chart_id string, code string, code_type string, resolution_path string, confidence double")
    log = spark.createDataFrame([], "mapping_id string, code_type string, original_code string, corrected_code string, corrected_by string")
    after, log2 = serving.decide(m, log, "m1", "override", "r", "B")
    assert after.head().code == "B" and after.head().resolution_path == "HUMAN_OVERRIDE" and log2.head().original_code == "A"
    with pytest.raises(ValueError):
        serving.decide(m, log, "m1", "override", "r")
    with pytest.raises(ValueError):
        serving.review_queue(m, page=0)


def test_rule_model_and_assertions(spark):
    model = extraction.RuleModel({"Knee pain": "DIAGNOSIS", "Aspirin": "MEDICATION"})
    charts = spark.createDataFrame([("c", "No evidence of knee pain. Mother had knee pain. Aspirin given."), ("d", None)], "chart_id string, raw_text string")
    parsed = extraction.parse_extraction(extraction.model_extract(charts, model))
    assert sorted((r.entity_text, r.assertion_status) for r in parsed.collect()) == [("Aspirin", "PRESENT"), ("knee pain", "ABSENT"), ("knee pain", "FAMILY")]
    ner, llm = extraction.split_roles(parsed)
    assert ner.count() == 2 and llm.count() == 0
    a = extraction.build_assertions(ner, parsed)
    assert a.count() == 2 and extraction.build_assertions(ner, parsed, a).count() == 0


def test_ontology(spark, tmp_path):
    row = lambda cui, lat, ts, stt, pref, sab, s: "|".join([cui, lat, ts, "L", stt, "S", pref, "A", "", "", "", sab, "PT", "", s, "0", "N", "", ""])
    (tmp_path / "conso").write_text("\n".join([row("C1", "ENG", "P", "PF", "Y", "MSH", 'Knee "pain"'), row("C1", "ENG", "S", "PF", "Y", "SNO", "Gonalgia"), row("C1", "SPA", "P", "PF", "Y", "MSH", "Dolor")]))
    (tmp_path / "sty").write_text("C1|T1|A|Disease or Syndrome|AT||\n")
    r = ontology.load_umls(spark, str(tmp_path / "conso"), str(tmp_path / "sty")).head()
    assert (r.preferred_name, r.semantic_group, len(r.synonyms)) == ('Knee "pain"', "DISO", 2)
    h = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("z", "y")], "concept_id string, parent_id string")
    assert {x.concept_id: x.depth for x in ontology.hierarchy_depth(h, "a").collect()} == {"a": 0, "b": 1, "c": 1}


def test_lookup_join_with_hot_key(spark):
    rows = spark.range(1000).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('k', id) end as k")
    lexicon = rows.groupBy("k").agg(F.count("*").alias("n"))
    out = lookup_join(rows, lexicon, "k", hot_keys(lexicon, "k"))
    assert out.count() == 1000 and out.where("k = 'hot'").select("n").distinct().head()[0] == 334


def test_queries_reach_terms_of_five_words(spark, tmp_path):
    from notecode.plans.reference import QUERIES

    concepts = [("C1", "DISO", "fracture of neck of femur", ["pain"])]
    spark.createDataFrame(concepts, "cui string, semantic_group string, preferred_name string, synonyms array<string>").write.parquet(f"{tmp_path}/umls_concepts.parquet")
    parts = [("c", "s", "Seen with fracture of neck of femur today."), ("d", "t", "Old fracture of neck of femor.")]
    spark.createDataFrame(parts, "chart_id string, section_id string, section_text string").write.parquet(f"{tmp_path}/document_sections.parquet")
    assert [tuple(r) for r in QUERIES["dict_exact_counts"](spark, str(tmp_path)).collect()] == [("c", 1, 1)]
    assert [tuple(r)[:2] for r in QUERIES["dict_fuzzy_pairs"](spark, str(tmp_path)).collect()] == [("fracture of neck of femor", "fracture of neck of femur")]


ENTITY = "entity_id string, chart_id string, entity_type string, entity_text string"


def test_icd10_of_exact_matches(spark, rows):
    entities = [("e1", "DIAGNOSIS", "Red Bolt"), ("e2", "OTHER", "red bolt"), ("e3", None, " red  bolt."), ("e4", "DIAGNOSIS", "blue rod"), ("e4", "DIAGNOSIS", "red bolt"), ("e5", "DIAGNOSIS", None), ("e6", "DIAGNOSIS", "brass"), ("e7", "OTHER", "green nut"), ("e8", "DIAGNOSIS", "blue rod")]
    active = spark.createDataFrame([(i, "c", t, x) for i, t, x in entities], ENTITY)
    terms = [("red bolt", "ICD10", "B01.1", None), ("red bolt", "ICD10", "A99.9", None), ("red bolt", "SNOMED", "S1", "C1"), ("red bolt", "SNOMED", "S2", "C2"), ("blue rod", "UMLS", "C2", "C2"), ("green nut", "SNOMED", "S3", "C3"), ("green nut", "SNOMED", "S4", None), ("brass", "ICD10", None, None)]
    dictionary = spark.createDataFrame([(t, t, s, "DIAGNOSIS", code, cui) for t, s, code, cui in terms], "term string, term_normalized string, source string, entity_type string, source_code string, cui string")
    ref = spark.createDataFrame([("B01.1", "B011", "one", True), ("B0.11", "b011", "two", True), ("A99.9", "A999", "three", False), ("C05", "C05", "four", True)], "code string, code_raw string, description string, is_billable boolean")
    codes = spark.createDataFrame([("S1", None, 1), ("S1", "D02", 1), ("S2", "C05", 1), ("S2", "A00", 2), ("S3", None, 1), ("S4", "E07", 1)], "snomed_concept_id string, icd10_code string, map_priority int")
    got = coding.resolve_icd10_exact(active, ref, dictionary, codes)
    own, by_term, by_concept = ("B0.11", "two", 0.98), ("C05", "four", 0.9408), ("C05", "four", 0.931)
    assert rows(got, "entity_id", "icd10_code", "icd10_description", "confidence") == [("e1", *own), ("e2", *by_term), ("e3", *by_term), ("e4", *own), ("e7", "E07", None, 0.9408), ("e8", *by_concept)]
    every = coding.resolve_icd10(coding.tier1_exact(active, dictionary), ref, dictionary, codes)
    assert set(got.columns) == set(every.columns) and rows(got, *every.columns) == rows(every)


def test_icd10_of_a_text_with_many_entities_and_entries(spark, tmp_path):
    import threading

    from notecode.plans.reference import QUERIES

    n = 60_000  # 20,000 terms have the same text as all entities
    spark.range(n).selectExpr("id as p_partkey", "'red bolt' as p_name", "1 as p_size").write.parquet(f"{tmp_path}/part.parquet")
    late = threading.Timer(120, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        got = QUERIES["resolve_icd10"](spark, str(tmp_path)).groupBy("icd10_code", "confidence").agg(F.countDistinct("entity_id"), F.count("*")).collect()
    finally:
        late.cancel()
    assert [tuple(r) for r in got] == [("A00.0", 0.9408, n, n)]
