import pytest

from notecode.llm import canonical
from notecode.llm.canonical import UNMATCHED, map_rows

CONCEPTS = [("C1", "Juvenile phlebectasia", ["JPA-12"]), ("C2", "Tracheotrophy stage 2", None), ("C3", "Tracheotrophy stage 3", []), ("C4", "Daptostavol", ["Glimexol HCl"]), ("C5", "Relapsing laryngosis of the left side", []), ("C6", "Glucose", ["GLU"]), ("C7", "Same name", []), ("C8", "Other", ["Same name"]), (None, "Nobody", []), ("C9", None, [None])]
CASES = [
    ("juvenile phlebectasia", "C1"), ("Juvnile phlebectasia", "C1"), ("phlebectasia, Juvenile", "C1"), ("known Juvenile flebectasia (stable)", "C1"), ("JPA-12", "C1"), ("JUVENILEPHLEBECTASIA", "C1"), ("Juvenile phlebecta…", "C1"), ("Juven1le phl3bectasia", "C1"), ("“Juvenile\tphlebectasia”", "C1"),
    ("Tracheotrophy stage 2", "C2"), ("tracheotrophi stage 3", "C3"), ("Tracheotrophy stage 4", UNMATCHED), ("Tracheotrophy stage", UNMATCHED), ("3, Tracheotrophy stage", "C3"),
    ("Daptostavol; 500 mg; oral; every 8 hours", "C4"), ("IV|Daptostavl|2.5 mg", "C4"), ("mild Daptostavol | 15 mg | SC | at night", "C4"), ("Glimexol HCl; 1.5 g", "C4"), ("side, left, the, of, laryngosis, Relapsing", "C5"),
    ("Glucose [mg/dL]", "C6"), ("GLU in mmol/L", "C6"), ("GLX", UNMATCHED), ("as discussed", UNMATCHED), ("???", UNMATCHED), ("Same name", UNMATCHED), ("z" * 50000, UNMATCHED), ("Senile cheiloparesis", UNMATCHED),
]
SCHEMA = "entity_id string, entity_text string, cui string, n string"


@pytest.fixture(scope="module")
def mapped(spark):
    rows = [(f"e{i}", t, "x", "y") for i, (t, _) in enumerate(CASES)] + [("n", None, "x", "y"), ("b", "  \t", "x", "y"), ("e0", CASES[0][0], "x", "y")]
    got = map_rows(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(CONCEPTS, "cui string, preferred_name string, synonyms array<string>")).collect()
    assert len(got) == len(CASES) + 1
    return {r.id: r.cui for r in got}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(mapped, i):
    assert mapped[f"e{i}"] == CASES[i][1], CASES[i]


def test_empty(spark):
    concepts = spark.createDataFrame(CONCEPTS, "cui string, preferred_name string, synonyms array<string>")
    assert map_rows(spark.createDataFrame([], SCHEMA), concepts).count() == 0
    got = map_rows(spark.createDataFrame([("e", "a name", "x", "y")], SCHEMA), concepts.limit(0)).collect()
    assert [r.cui for r in got] == [UNMATCHED]


def test_short_names_that_sound_alike(spark):
    concepts = spark.createDataFrame([("C1", "GLU", None), ("C2", "Serum potassium", ["K+"])], "cui string, preferred_name string, synonyms array<string>")
    rows = spark.createDataFrame([("a", "G.L.U"), ("b", "GLLU"), ("c", "GLUU"), ("d", "GLA")], "entity_id string, entity_text string")
    assert {r.id: r.cui for r in canonical.map_rows(rows, concepts).collect()} == {"a": "C1", "b": "C1", "c": "C1", "d": "UNMATCHED"}


def test_cosine_decides(spark, monkeypatch):
    concepts = spark.createDataFrame([("C1", "Chondrolithiasis", None), ("C2", "Gingivotomy", None)], "cui string, preferred_name string, synonyms array<string>")
    rows = spark.createDataFrame([("a", "Chondrolithiasys"), ("b", "Cohndrolihtiasis")], "entity_id string, entity_text string")
    assert {r.id: r.cui for r in canonical.map_rows(rows, concepts).collect()}["a"] == "C1"
    monkeypatch.setattr(canonical, "LEAST_COSINE", 0.9)
    assert {r.id: r.cui for r in canonical.map_rows(rows, concepts).collect()} == {"a": "C1", "b": "UNMATCHED"}
