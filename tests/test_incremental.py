from datetime import datetime as dt

import pytest

from notecode.operators.incremental import VersionedTarget, pending
from notecode.operators.pipeline import run_stage, unprocessed

SOURCE = "entity_id string, extracted_at timestamp, processed_at string"
TARGET = "source_entity_ids array<string>, merged_at timestamp, source_key string"
RUNS = "run_id string, started_at timestamp, finished_at timestamp, status string"
T = lambda h, d=1: dt(2025, 1, d, h)


def run(spark, source, target, runs):
    a = spark.createDataFrame(source, SOURCE)
    b = spark.createDataFrame([], SOURCE)
    return sorted((r.source_key, r.source_version) for r in pending([a, b], spark.createDataFrame(target, TARGET), spark.createDataFrame(runs, RUNS)).collect())


def test_versions_failures_and_bounds(spark):
    runs = [("r1", T(2), T(4), "SUCCEEDED"), ("r2", T(2, 2), T(4, 2), "FAILED"), ("r3", T(22, 3), T(2, 4), "SUCCEEDED")]
    source = [
        ("done", T(1), "x"), ("done", T(1), "x"), ("again", T(1), "x"), ("again", T(5), "x"), ("failed", T(1), "x"), ("edge", T(1), "x"),
        ("same", T(4), "x"), ("night", T(1), "x"), (None, T(1), "x"), ("nover", None, "x"), ("never", T(1), "x"),
    ]
    target = [(["done", "again", None], T(3), "k"), (["failed"], T(3, 2), "k"), (["edge", "same"], T(4), "k"), (["night"], T(1, 4), "k"), (["nover"], T(3), "k"), (None, T(3), "k"), (["never"], None, "k")]
    assert [k for k, _ in run(spark, source, target, runs)] == ["again", "failed", "never", "nover"]


def test_empty_tables(spark):
    runs = [("r1", T(2), T(4), "SUCCEEDED")]
    assert run(spark, [], [], runs) == []
    assert [k for k, _ in run(spark, [("a", T(1), "x")], [], [])] == ["a"]


def test_publish_is_whole_and_repeatable(spark, tmp_path):
    target = VersionedTarget(spark, f"file://{tmp_path}/t")
    schema = "source_key string, source_version int, x string"
    assert target.current() == 0 and target.read(schema).count() == 0
    with pytest.raises(ValueError):
        target.read()
    src = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1)], "k string, v int")
    assert sorted(tuple(r) for r in target.pending(src, "k", "v").collect()) == [("a", 1), ("b", 2)]
    assert target.publish(spark.createDataFrame([("a", 1, "p"), ("b", 2, "q")], schema)) == 1
    assert target.pending(src, "k", "v").count() == 0
    (tmp_path / "t" / "data" / "left-by-a-run-that-died").mkdir()
    newer = spark.createDataFrame([("b", 3), ("c", 1)], "k string, v int")
    todo = target.pending(newer, "k", "v")
    assert target.publish(todo.selectExpr("k as source_key", "v as source_version", "'r' as x")) == 2
    assert sorted(tuple(r) for r in target.read().select("source_key", "source_version", "x").collect()) == [("a", 1, "p"), ("b", 3, "r"), ("c", 1, "r")]


def test_stage_runs_once(spark, tmp_path):
    target = VersionedTarget(spark, f"file://{tmp_path}/s")
    charts = spark.createDataFrame([("c1", 1), ("c2", 1)], "chart_id string, v int")
    work = lambda rows: rows.where("chart_id = 'c1'").selectExpr("chart_id", "'found' as what")
    assert not run_stage("s", charts, target, work, "chart_id", "v").skipped
    assert run_stage("s", charts, target, work, "chart_id", "v").skipped
    assert target.read().where("what = 'found'").count() == 1


def test_unprocessed(spark):
    charts = spark.createDataFrame([("a",), ("b",), (None,)], "chart_id string")
    assert [r[0] for r in unprocessed(charts, spark.createDataFrame([("a",), (None,)], "chart_id string")).collect()] == ["b"]


ROWS = "source_key string, source_version int, x string"


def test_two_runs_at_once(spark, tmp_path, monkeypatch):
    """Run B publishes after A has written its rows and before A names them: A fails, nothing of B is lost, A can run again."""
    a, b = (VersionedTarget(spark, f"file://{tmp_path}/t") for _ in range(2))
    a.publish(spark.createDataFrame([("k", 1, "first")], ROWS))
    write = a._write

    def slow(rows):
        folder = write(rows)
        b.publish(spark.createDataFrame([("b", 1, "from b")], ROWS))
        return folder

    monkeypatch.setattr(a, "_write", slow)
    with pytest.raises(RuntimeError):
        a.publish(spark.createDataFrame([("a", 1, "from a")], ROWS))
    assert sorted(r.x for r in a.read().collect()) == ["first", "from b"] and a.current() == 2
    monkeypatch.setattr(a, "_write", write)
    assert a.publish(spark.createDataFrame([("a", 1, "from a")], ROWS)) == 3
    assert sorted(r.x for r in b.read().collect()) == ["first", "from a", "from b"]
    with pytest.raises(RuntimeError):
        b.publish(spark.createDataFrame([("a", 2, "from an older base")], ROWS), base=2)


def size(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_a_run_writes_what_changed(spark, tmp_path):
    target = VersionedTarget(spark, f"file://{tmp_path}/t")
    rows = spark.range(20000).selectExpr("cast(id as string) as source_key", "1 as source_version", "sha2(cast(id as string), 256) as x")
    target.publish(rows.repartition(2))
    before = size(tmp_path)
    target.publish(rows.where("cast(source_key as int) % 100 = 0").selectExpr("source_key", "2 as source_version", "x").coalesce(1))
    assert size(tmp_path) - before < 0.03 * before
    assert target.read().count() == 20000 and target.read().where("source_version = 2").count() == 200
    assert target.compact() == 3 and len(target.folders()) == 1 and target.read().count() == 20000
    assert target.vacuum() == 0 and target.vacuum(keep=1, older_than_seconds=-60) == 2 and target.read().count() == 20000


def test_the_stages_chained(spark, tmp_path):
    from notecode.operators.dictionary_match import build_dictionary
    from notecode.operators.extraction import RuleModel, model_extract
    from notecode.operators.pipeline import clinical_stages, run, targets_at

    note = "CHIEF COMPLAINT:\nSevere {0} of the knee for two days.\nASSESSMENT:\n{0}, plan to review in the clinic."
    umls = spark.createDataFrame([("C1", "chondritis", "DISO", ["chondral swelling"]), ("C2", "itching", "DISO", None)], "cui string, preferred_name string, semantic_group string, synonyms array<string>")
    dictionary = build_dictionary(umls=umls)
    model = RuleModel({"chondritis": "DIAGNOSIS", "itching": "DIAGNOSIS"})

    def once(charts):
        stages = clinical_stages(spark.createDataFrame(charts, "chart_id string, raw_text string, ingested_at timestamp"), dictionary, lambda c: model_extract(c, model))
        targets = targets_at(spark, f"file://{tmp_path}/p", stages)
        return run(stages, targets), targets

    results, targets = once([("c1", note.format("chondritis"), T(1)), ("c2", "no sections", T(1)), (None, "x", T(1))])
    assert not any(r.skipped for r in results)
    merged = targets["merged"].read().where("entity_id is not null").select("chart_id", "normalized_text", "sources").collect()
    assert [tuple(r) for r in merged] == [("c1", "chondritis", ["dictionary", "ner"])]
    assert targets["codes"].read().where("source_code is not null").select("source_code").distinct().collect()[0][0] == "C1"
    results, _ = once([("c1", note.format("chondritis"), T(1)), ("c2", "no sections", T(1))])
    assert all(r.skipped for r in results)
    results, targets = once([("c1", note.format("itching"), T(2)), ("c2", "no sections", T(1)), ("c3", note.format("itching"), T(1))])
    assert not any(r.skipped for r in results)
    assert {(r.chart_id, r.normalized_text) for r in targets["merged"].read().where("entity_id is not null").collect()} == {("c1", "itching"), ("c3", "itching")}
