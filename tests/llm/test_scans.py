import numpy as np
import pytest

from notecode.llm import scans

CLEAN = "The patient was seen with moderate swelling of the left knee. Takes short-acting medicine as needed for pain. Follow-up in clinic. Diagnosis remains stable on current treatment."
NOTE = "Greywater General   Records\nHPI:\nThe patient was seen wlth moderate swel-\nling of the lef+ knee. Takes short-\nacting medicine as needed for pain. Diagn0sis\n- 1 -\nGreywater Gener@l   Records\nremains stable on cur¬\nrent treatment.\n- 2 -"
CHARTS, SECTIONS = "chart_id string, raw_text string, kind string", "chart_id string, section_id string, section_text string, kind string"


def charts_of(spark, texts, kind="x"):
    return spark.createDataFrame([(f"{i}", t, kind) for i, t in enumerate(texts)], CHARTS)


def found(spark, texts, sections=()):
    rows = scans.find_noise(charts_of(spark, texts), spark.createDataFrame(list(sections), SECTIONS)).collect()
    return {(r.record_id, r.line_no, r.kind) for r in rows}


def drop(text):
    return {i + 1 for i in scans.furniture(text.split("\n"), scans.running_lines(text))}


def test_furniture():
    assert scans.running_lines(NOTE) == ["Greywater General   Records"]
    assert drop(NOTE) == {1, 6, 7, 10}
    assert scans.running_lines(CLEAN) == scans.running_lines(None) == scans.running_lines(" \n") == [] and not drop(CLEAN)


def test_running_footer():
    page = "HPI:\nSeen with swelling of the knee {0}.\nTakes medicine as needed {0}.\nWestbrook Clinic Confidential\n"
    assert drop("".join(page.format(k) for k in "abc").strip()) == {4, 8, 12}
    twice = "HPI:\nSeen with swelling.\nWestbrook Clinic Confidential\nPage 1 of 2\nTakes medicine.\nWestbrook Clinic Confidential\nPage 2 of 2"
    assert drop(twice) == {3, 4, 6, 7}
    assert not drop("HPI:\nNo change.\nTakes medicine.\nNo change.")


def test_headers_and_page_numbers_of_any_length():
    head = "Westbrook and Greywater General Hospital Trust, Department of Medicine, Outpatient Records, Second Floor"
    assert len(head) > 80 and drop(f"{head}\nHPI:\nSeen.\n{head}\nstable.") == {1, 4}
    assert scans.is_page_number("- - - - - - -   12   - - - - - - -")


def test_page_numbers():
    assert all(map(scans.is_page_number, ["1", "- 2 -", "Page 1 of 2", "PAGE  1", "pg. 3", "1/2", "Page l of 2"]))
    assert not any(map(scans.is_page_number, ["", "89.5 mg", "on day 5", "stable"]))


@pytest.fixture(scope="module")
def tables(spark):
    charts = spark.createDataFrame([("c1", NOTE, "x")] * 2 + [(f"d{i}", CLEAN, "x") for i in range(60)] + [("n", None, "x"), ("e", "", "x"), ("b", " \n ", "x"), ("long", (CLEAN + "\n") * 500, "x"), (None, CLEAN, "x")], CHARTS)
    part = "\n".join(NOTE.split("\n")[2:8])
    return charts, spark.createDataFrame([("c1", "s1", part, "x"), ("?", "s2", "no noise here", "x"), ("c1", "s3", None, "x"), (None, "s4", "alone", "x")], SECTIONS)


def test_find(tables):
    charts, sections = tables
    got = [(r.record_id, r.line_no, r.kind) for r in scans.find_noise(charts, sections).collect()]
    assert len(got) == len(set(got))
    want = {("c1", k, "furniture") for k in (1, 6, 7, 10)} | {("c1", 3, "hyphen"), ("c1", 8, "hyphen")} | {("c1", k, "misread") for k in (3, 4, 5)}
    assert {x for x in got if x[0] == "c1"} == want
    assert {("s1", 4, "furniture"), ("s1", 5, "furniture"), ("s1", 1, "hyphen"), ("s1", 1, "misread"), ("s1", 2, "misread")} <= set(got)
    assert {r for r, _, _ in got} == {"c1", "s1"}
    assert scans.find_noise(charts.limit(0), sections.limit(0)).count() == 0


def test_repair(tables):
    texts = {r.record_id: r.text for r in scans.repair_texts(*tables).collect()}
    assert texts["c1"] == "HPI:\nThe patient was seen with moderate swelling of the left knee. Takes short-acting medicine as needed for pain. Diagnosis remains stable on current treatment."
    assert texts["d1"] == CLEAN and texts["s2"] == "no noise here" and "n" not in texts


def test_repair_of_misread_words_broken_over_lines(spark):
    from notecode.llm.queries import QUERIES

    broken = "Seen with moderate swcl-\nling of the left knee. Dia-\ngn0sis remains stable."
    rows = scans.repair_texts(charts_of(spark, [CLEAN] * 60 + [broken]), spark.createDataFrame([], SECTIONS)).collect()
    assert {r.record_id: r.text for r in rows}["60"] == "Seen with moderate swelling of the left knee. Diagnosis remains stable."
    assert "p4_texts" in QUERIES


def test_words_are_learned_from_sections_too(spark):
    word = [("?", f"s{i}", "Seen with chondrolithiasis of the knee.", "x") for i in range(30)]
    assert ("0", 1, "misread") in found(spark, ["Seen with chondrolithiasls of the knee."], word)


def test_rows_do_not_change_with_corpus_size(spark):
    texts = [CLEAN] * 60 + [CLEAN.replace("Diagnosis", "Diagn0sis").replace("swelling", "swellmg")] * 2 + [CLEAN.replace("stable", "s+able x-ray SpO2")]
    got = []
    for times in (1, 10):
        rows = scans.find_noise(spark.createDataFrame([(f"{i}-{k}", t) for i, t in enumerate(texts) for k in range(times)], "chart_id string, raw_text string"), spark.createDataFrame([], SECTIONS)).collect()
        got.append({(r.record_id.split("-")[0], r.line_no, r.kind) for r in rows})
    assert got[0] == got[1] == {(str(i), 1, "misread") for i in (60, 61, 62)}


COMPANY = [f"the {a} of {b} shows sterols in {c}" for a in ("serum", "plasma", "blood") for b in ("fasting", "morning", "evening") for c in ("excess", "balance", "deficit")] * 20
OTHER = [f"we heard {a} songs by {b} on {c}" for a in ("old", "new", "loud") for b in ("tenors", "choirs", "bands") for c in ("monday", "sunday", "friday")] * 20
RARE = ["we heard stcrols songs by tenors on monday", "the serum of fasting shows stcrols in excess"]


def test_context_decides_for_long_words_too(spark, monkeypatch):
    """A rare word in its frequent neighbour's company is a misreading of it, in other company it is a word; without vectors both are the same."""
    monkeypatch.setattr(scans, "LEAST_FIT", -1.5)
    n = len(COMPANY + OTHER)
    misread = {i for i, _, kind in found(spark, COMPANY + OTHER + RARE) if kind == "misread"}
    assert misread == {str(n + 1)}
    monkeypatch.setattr(scans, "train", lambda a, b, k, size: (np.zeros((size, 2)), np.zeros((size, 2))))
    assert {i for i, _, kind in found(spark, COMPANY + OTHER + RARE) if kind == "misread"} == {str(n), str(n + 1)}


def test_skip_gram_learns_company():
    a, b = np.array([0, 1, 2, 3]), np.array([1, 0, 3, 2])
    centre, around = scans.train(a, b, np.full(4, 50.0), 4)
    assert (centre[0] @ around[1]) > (centre[0] @ around[3]) + 1
    noise = np.full(4, 0.25)
    fitted = scans.fit_centres(np.array([[0.0, 50.0, 0.0, 0.0]]), around, noise)[0]
    assert (fitted @ around[1]) > (fitted @ around[3]) + 1


def test_links():
    assert scans.edits("stcrol") >= {"sterol"} and scans.edits("rn") >= {"m"}
    assert scans.number_meant("1O5") == "105" and scans.number_meant("105") is None and scans.number_meant("B12") is None


def test_digits_inside_words_without_a_link(spark):
    words = [(w, n) for w, n in (("rehabilitation", 9), ("habitat", 9), ("abilities", 9), ("station", 9), ("rehabil", 9), ("litany", 9), ("citation", 9), ("rehash", 9), ("nation", 9), ("militate", 9), ("militant", 9), ("habilis", 9), ("imitation", 9), ("5feet", 1), ("6feet", 1), ("7feet", 1), ("gfeet", 9))]
    df = spark.createDataFrame([*words, ("militati0n", 1), ("q1zfeet", 1)], "word string, n long")
    got = scans.spelled_links(df, df.limit(0), 5).collect()
    assert [(r.word, r.meant) for r in got] == [("militati0n", "militation")]
