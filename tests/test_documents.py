from notecode.operators import coding, extraction, feedback, sections

CHARTS = "chart_id string, file_name string, raw_text string, extraction_method string, page_count int"
LONG = "The patient was seen in the clinic. " * 5


def test_documents(spark):
    charts = spark.createDataFrame([("a", "a.pdf", None, None, None), ("b", "b.pdf", "short", None, 3), ("c", "c.pdf", LONG, "x", None), ("d", "gone.pdf", None, None, None), ("e", "e.pdf", "", None, None)], CHARTS)
    files = spark.createDataFrame([("p/a.pdf", "a.pdf", b"text of a"), ("p/b.pdf", "b.pdf", b"\xff\xfe"), ("p/c.pdf", "c.pdf", b"other"), ("p/e.pdf", "e.pdf", b"")], "path string, file_name string, content binary")
    assert {r.chart_id for r in sections.ocr_candidates(charts).collect()} == {"a", "b", "d", "e"}
    texts = sections.parse_documents(charts, files)
    assert [(r.chart_id, r.ocr_text) for r in texts.collect()] == [("a", "text of a")]
    after = {r.chart_id: r for r in sections.apply_ocr(charts, texts).collect()}
    assert after["a"].raw_text == "text of a" and after["a"].extraction_method == "ocr_ai_parse" and after["b"].raw_text == "short" and after["c"].extraction_method == "x"
    parts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "chart_id string")
    assert {r.chart_id: r.page_count for r in sections.fill_page_count(charts, parts).collect()} == {"a": 2, "b": 3, "c": None, "d": None, "e": None}


def test_literal_headings(spark):
    text = "Past history: asthma since childhood.\nMedication list:\naspirin daily\nAdverse reactions: rash\nSocial hx: lives alone\nComments: seen by the team"
    rows = sections.segment_sections_exact(spark.createDataFrame([("c", text), ("n", None), ("s", "Plan: x\nNotes: y")], "chart_id string, raw_text string")).collect()
    assert [(r.section_type, r.section_text) for r in sorted(rows, key=lambda r: r.section_order)] == [("PAST_MEDICAL_HISTORY", "asthma since childhood."), ("MEDICATIONS", "list:\naspirin daily"), ("ALLERGIES", "rash"), ("SOCIAL_HISTORY", "lives alone"), ("OTHER", "seen by the team")]
    native = sections.segment_sections(spark.createDataFrame([("c", text)], "chart_id string, raw_text string")).collect()
    assert {"PAST_MEDICAL_HISTORY", "MEDICATIONS", "ALLERGIES", "SOCIAL_HISTORY", "OTHER"} == {r.section_type for r in native}


def test_runs_of_close_headings_count_once():
    from notecode.operators.sections import HEADINGS

    assert len(HEADINGS) == 16 and all(p.startswith("(?:") for p in HEADINGS.values())


def Fixed(text):
    class Model:  # sent to the workers by value
        def segment(self, texts):
            return [text] * len(texts)

        answer = segment

    return Model()


def test_fallback(spark):
    charts = spark.createDataFrame([("a", "Assessment of the knee.\n\nOther text"), ("b", "x"), ("n", None), ("s", "done")], "chart_id string, raw_text string")
    ruled = spark.createDataFrame([("s",)], "chart_id string")
    rows = {(r.chart_id, r.section_type, r.section_text) for r in sections.segment_sections_fallback(charts, ruled).collect()}
    assert rows == {("a", "ASSESSMENT_PLAN", "Assessment of the knee."), ("a", "OTHER", "Other text"), ("b", "OTHER", "x")}
    answer = '```json\n[{"section_type": "LABS", "section_header": "Labs", "section_text": " t ", "order": 2}, {"section_type": "NEW", "section_text": "u"}, {"section_type": "HPI", "section_text": " "}]\n```'
    rows = sections.segment_sections_fallback(charts.where("chart_id = 'b'"), ruled, Fixed(answer)).collect()
    assert {(r.section_type, r.section_text, r.section_order) for r in rows} == {("LABS", "t", 2), ("OTHER", "u", 0)}
    assert sections.segment_sections_fallback(charts, ruled, Fixed("no JSON")).count() == 0


def test_model_answers(spark):
    prompts = coding.chart_prompts(spark.createDataFrame([(f"e{i}", "c", "LAB_RESULT", "x", None, None) for i in range(900)], "entity_id string, chart_id string, entity_type string, entity_text string, value string, unit string"))
    sizes = [r.n_entities for r in prompts.collect()]
    assert sum(sizes) == 900 and len(sizes) == 5 and max(sizes) < 300
    raw = coding.model_code(prompts, Fixed('Here it is: [{"entity_id": "e7", "code": "A"}] as asked'))
    assert {(r.entity_id, r.code) for r in coding.parse_codes(raw).collect()} == {("e7", "A")}


def test_patterns(spark):
    missed = spark.createDataFrame([("c", "LAB_RESULT", f"t{i:03}", None) for i in range(12)] + [("c", "OTHER", 'quo"te', "HPI")], "chart_id string, entity_type string, text string, section_type string")
    rows = {(r.pattern_type, r.severity) for r in feedback.error_patterns(missed).collect()}
    assert rows == {("missed LAB_RESULT", "MEDIUM"), ("missed OTHER", "LOW")}
    assert feedback.missed_sample(missed, 3).count() == 3 and feedback.error_patterns(missed.limit(0)).count() == 0
    patterns = feedback.error_patterns(missed)
    assert {r.recommendation for r in feedback.recommendations(patterns, Fixed("do this")).collect()} == {"do this"}
    assert feedback.error_patterns(missed, model=Fixed("nothing")).count() == 0


def test_no_model(spark):
    assert extraction.parse_extraction(extraction.no_answers(spark.createDataFrame([("a", "x")], "chart_id string, raw_text string"))).count() == 0
