import pytest

from notecode.functions.ngrams import candidates, weighted_distance
from notecode.operators.units import convert, scaled

UNITS = [("C1", "Glucose", "LAB", ["GLU"], "mmol/L", 180.156, 1), ("C2", "Platelet count", "LAB", None, "10*9/L", None, 0), ("C3", "Hemoglobin", "LAB", ["HGB"], "g/L", None, 0), ("C4", "Body height", "V", ["HT"], "cm", None, 0), ("C5", "Body weight", "V", [], "kg", None, 1), ("C6", "Body temperature", "V", ["TEMP"], "Cel", None, 1), ("C7", "Urine volume", "V", [], "mL", None, 0), ("C8", "Calcium", "LAB", [], "mmol/L", 40.078, 2)]
SCHEMA = "cui string, quantity string, entity_type string, synonyms array<string>, common_unit string, molar_mass double, decimals int"
ROWS = "entity_id string, entity_text string, value string, unit string, entity_context string, kind string, key string"

CASES = [
    ("Glucose", "90", "mg/dL", None, 50), ("GLU", "5,1", "MMOL/L", None, 51), ("glucose", " 5.1 ", "mmol/L", None, 51), ("Glucose", "5.1", "mmol/L", None, None), ("Glucose [mg/dL]", "90", "", None, 50), ("GLU, mg/dL", "90", None, None, 50),
    ("Glucose", "90mg/dl", None, None, 50), ("Glucose", "90", None, "On arrival Glucose 90 mg/100 mL.", 50), ("Glucose", "90", None, "Glucose 90, recheck in clinic.", None), ("Glucose", "4-5", "mmol/L", None, None), ("Glucose", ">4", "mg/dL", None, None), ("Glucose", "~4?", "mg/dL", None, None),
    ("Glucose", "5", "parsec", None, None), ("Glucose", "pending", "mg/dL", None, None), ("Glucose", None, "mg/dL", None, None), ("Something", "5", "mg/dL", None, None), (None, "5", "mg/dL", None, None),
    ("Platelet count", "207,000", "/mm3", None, 207), ("Platelet count", "207 G/L", None, None, 207), ("Platelet count", "131e3", "/uL", None, 131), ("Platelet count", "102*10^3", "/µl", None, 102), ("Platelet count", "225x10^3/µL", None, None, 225), ("platelet count (10⁹/L)", "609", "", None, 609),
    ("Hemoglobin", "12.5", "G/L", None, 13), ("HGB", "12.5", "g%", None, 125), ("Body height", "5 ft 11 in", None, None, 180), ("HT", "5'11\"", None, None, 180), ("HT", "1,671", "mm", None, 167), ("Body height", "1,71", "m", None, 171),
    ("Body weight", "11st 3lb", None, None, 712), ("Body weight", "17 stone 5", None, None, 1102), ("Body weight", "64,892", "g", None, 649), ("Body weight", "10,1", "kilogramms", None, 101), ("TEMP", "98.6", "°F", None, 370), ("TEMP", "38,5 ℃", None, None, 385), ("Urine volume", "2 oz fl", None, None, 59), ("Calcium", "5", "mEq/L", None, 250),
]


@pytest.fixture(scope="module")
def found(spark):
    data = [(f"e{i}", t, v, u, c, "x", "k") for i, (t, v, u, c, _) in enumerate(CASES)]
    df = spark.createDataFrame(data + data[:2], ROWS)
    return {r.entity_id: r.value_scaled for r in scaled(convert(df, spark.createDataFrame(UNITS, SCHEMA))).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(found, i):
    assert found.get(f"e{i}") == CASES[i][4], CASES[i]


def test_empty(spark):
    units = spark.createDataFrame(UNITS, SCHEMA)
    assert convert(spark.createDataFrame([], ROWS), units).count() == 0
    assert convert(spark.createDataFrame([("e", "Glucose", "90", "mg/dL", None, "x", "k")], ROWS), units.limit(0)).count() == 0


def test_candidates_against_brute_force(spark):
    import math
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
    texts, entries = sorted({word() for _ in range(60)}), sorted({word() for _ in range(40)})
    grams = lambda s: {f"^{s}$"[i : i + 2] for i in range(len(s) + 1)}
    df = {g: sum(g in grams(e) for e in entries) for e in entries for g in grams(e)}
    w = lambda g: math.log1p(len(entries) / df.get(g, 1))
    norm = lambda s: math.sqrt(sum(w(g) ** 2 for g in grams(s)))
    want = {(t, e) for t in texts for e in entries if sum(w(g) ** 2 for g in grams(t) & grams(e)) / norm(t) / norm(e) >= 0.4}
    got = candidates(spark.createDataFrame([(t,) for t in texts], "t string"), spark.createDataFrame([(e,) for e in entries], "e string"), text="t", entry="e", n=2, least=0.4)
    assert {(r.t, r.e) for r in got.collect()} == want


def test_weighted_distance():
    cost = lambda x, y: 1.0
    assert weighted_distance("abc", "abc", cost) == 0 and weighted_distance("abc", "acb", cost) == 1 and weighted_distance("", "ab", cost) == 2


def test_spellings_of_any_length(spark):
    from notecode.operators.units import convert

    units = spark.createDataFrame([("C1", "Glucose", "LAB_RESULT", ["GLU"], "mmol/L", 180.16, 2)], "cui string, quantity string, entity_type string, synonyms array<string>, common_unit string, molar_mass double, decimals int")
    long = "m i l l i m o l   p e r   l i t r e".replace(" ", "") + "." * 40
    rows = spark.createDataFrame([("a", "Glucose", "5.5", "millimol  per" + " " * 60 + "litre", None), ("b", "Glucose", "5.5 " + long, None, None)], "entity_id string, entity_text string, value string, unit string, entity_context string")
    got = {r.entity_id: r.value_common for r in convert(rows, units).collect()}
    assert got["a"] == 5.5


def test_commas_are_read_by_the_other_values(spark):
    from notecode.operators.units import convert

    units = spark.createDataFrame([("C1", "Platelet count", "LAB_RESULT", [], "10*9/L", None, 0), ("C2", "Body weight", "VITAL_SIGN", [], "kg", None, 1)], "cui string, quantity string, entity_type string, synonyms array<string>, common_unit string, molar_mass double, decimals int")
    rows = [(f"p{i}", "Platelet count", f"{200 + i}", "10*9/L", None) for i in range(5)] + [(f"w{i}", "Body weight", f"{60 + i}", "kg", None) for i in range(5)]
    rows += [("p", "Platelet count", "210,000", "/uL", None), ("w", "Body weight", "61,500", "kg", None), ("g", "Body weight", "61,500", "g", None)]
    got = {r.entity_id: r.value_common for r in convert(spark.createDataFrame(rows, "entity_id string, entity_text string, value string, unit string, entity_context string"), units).collect()}
    assert (got["p"], got["w"], got["g"]) == (210.0, 61.5, 61.5)


def test_candidates_by_broadcast_and_by_shuffle(spark, monkeypatch):
    import math

    from pyspark.sql import functions as F

    from notecode.functions import ngrams

    texts, entries = ["abcdef", "abcxef", "zzz", "abc", ""], ["abcdef", "abcde", "zzzz", "q"]
    grams = lambda t: {f"^{t}$"[i : i + 2] for i in range(len(t) + 1)}
    df = {g: sum(g in grams(e) for e in entries) for e in entries for g in grams(e)}
    w = lambda g: math.log1p(len(entries) / df.get(g, 1)) if g in df else math.log1p(len(entries))
    norm = lambda t: math.sqrt(sum(w(g) ** 2 for g in grams(t)))
    want = {(t, e): sum(w(g) ** 2 for g in grams(t) & grams(e)) / norm(t) / norm(e) for t in texts for e in entries}
    a, b = spark.createDataFrame([(t,) for t in texts], "t string"), spark.createDataFrame([(e,) for e in entries], "e string")
    for most in (300_000, 0):
        monkeypatch.setattr(ngrams, "BROADCAST_POSTINGS", most)
        got = {(r.t, r.e): round(r.cosine, 9) for r in ngrams.candidates(a, b, text="t", entry="e", least=0.3).collect()}
        assert got == {k: round(v, 9) for k, v in want.items() if v >= 0.3}
        sized = ngrams.candidates(a, b, text="t", entry="e", least=0.3, sizes=(F.length("t"), F.length("t"))).collect()
        assert {(r.t, r.e) for r in sized} == {k for k, v in want.items() if v >= 0.3 and len(k[0]) == len(k[1])}
