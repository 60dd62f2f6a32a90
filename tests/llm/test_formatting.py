from notecode.llm.formatting import collapse, copy_pairs, encode

SCHEMA = "entity_id string, entity_text string, chart_id string, section_id string, entity_type string, start_offset int, form string, n string"


def pairs(spark, texts, **other):
    rows = [(f"e{i}", t, "c", None, "D", None, "x", "y") for i, t in enumerate(texts)]
    e = encode(spark.createDataFrame(rows + rows[:1], SCHEMA))
    return {(r.entity_id_a, r.entity_id_b) for r in copy_pairs(e).collect()}


def test_forms(spark):
    same = ["Knee pain; 5 mg", " KNEE-pain|5mg;", "5 mg ; knee  pain", "(knee pain); ;5,mg."]
    assert len(pairs(spark, same)) == 6
    assert pairs(spark, ["1.5 mg", "15 mg", "1. 5 mg"]) == {("e1", "e2")}
    assert pairs(spark, ["a+", "a", "A +", "<5", "5", "5%"]) == {("e0", "e2")}
    assert pairs(spark, ["a;b", "a b", "b|a", "a;a", "a"]) == {("e0", "e2")}
    assert pairs(spark, [None, None, "", "", " ;| ", "..."]) == set()
    assert pairs(spark, ["x" * 100000, "X" * 100000]) == {("e0", "e1")}


def test_context_and_copies(spark):
    rows = [("a", "t", "c", None, "D", 1, "", ""), ("b", "T", "c", None, "D", 1, "", ""), ("c", "t", "c", "s", "D", 1, "", ""), ("d", "t", "c", None, "D", None, "", ""), ("b", "t.", "c", None, "D", 1, "", ""), (None, "t", "c", None, "D", 1, "", "")]
    e = encode(spark.createDataFrame(rows, SCHEMA))
    assert {(r.entity_id_a, r.entity_id_b) for r in copy_pairs(e).collect()} == {("a", "b")}
    assert sorted((r.record_id, r.n_copies) for r in collapse(e).collect()) == [("a", 3), ("c", 1), ("d", 1)]


def test_empty(spark):
    assert copy_pairs(encode(spark.createDataFrame([], SCHEMA))).count() == 0


def test_hot_text_against_brute_force(spark):
    import random

    rng = random.Random(2)
    rows = [(f"e{i:03}", rng.choice(["hot", "HOT!", f"t{i % 40}", f"T{i % 40};"]), f"c{i % 5}", None, "D", None, "", "") for i in range(300)]
    got = {(r.entity_id_a, r.entity_id_b) for r in copy_pairs(encode(spark.createDataFrame(rows, SCHEMA))).collect()}
    key = lambda r: (r[1].lower().strip("!;"), r[2])
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and key(a) == key(b)}


def test_classes_are_dealt_to_tasks(spark, monkeypatch):
    from notecode.llm import formatting

    monkeypatch.setattr(formatting, "PER_TASK", 7)
    got = pairs(spark, ["hot"] * 40 + ["cold"])
    assert got == {(a, b) for a in (f"e{i}" for i in range(40)) for b in (f"e{i}" for i in range(40)) if a < b}
