import random

import pandas as pd
import pyarrow.parquet as pq

from notecode.llm import leakage
from notecode.sources import tables

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
DOCS = "doc_id long, text string, item_id string"


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS)
    e = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.n_words, r.doc_word, r.item_word) for r in leakage.find_leaks(d, e).collect()}


def test_forms_and_bounds(spark):
    docs = [
        (1, "start " + ITEM.upper().replace(" ", "\n> ") + "."), (2, " ".join(ITEM.split()[1:13])), (3, " ".join(ITEM.split()[:11])), (4, None), (5, ""),
        (6, ITEM.replace("five", "fívé")), (7, ITEM.replace("six", "6")), (1, "start " + ITEM), (8, "word " * 20000 + ITEM), (9, " ".join(ITEM.split()[:6])), (10, " ".join(ITEM.split()[6:])),
    ]
    got = run(spark, docs, [(7, ITEM), (7, ITEM), (8, None), (9, "short"), (11, "")])
    assert got == {(1, 7): (14, 1, 0), (2, 7): (12, 0, 1), (6, 7): (14, 0, 0), (8, 7): (14, 20000, 0)}


def test_empty(spark):
    assert run(spark, [], [(1, ITEM)]) == {} and run(spark, [(1, ITEM)], []) == {}


def test_against_brute_force(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items, docs = [(i, text(rng.randint(5, 40))) for i in range(6)], [(i, text(rng.randint(0, 400))) for i in range(30)]
    want = {}
    for d, t in docs:
        for i, s in items:
            a, b = t.split(), s.split()
            best = 0
            for x in range(len(b)):
                for n in range(len(b) - x, 5, -1):
                    if f" {' '.join(b[x:x + n])} " in f" {' '.join(a)} ":
                        best = max(best, n)
                        break
            if best >= 6:
                want[d, i] = best
    df, e = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_words for r in leakage.find_leaks(df, e, min_words=6).collect()}
    assert got == want


def test_blocks_and_reports(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 10)
    d = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, "x")], "doc_id long, text string")
    e = spark.createDataFrame([(1, ITEM), (2, ITEM + " end")], "item_id long, text string")
    leaks = leakage.find_leaks(d, e)
    assert leaks.count() == 4
    assert {(r.item_id, r.n_docs, r.longest) for r in leakage.leaked_items(leaks).collect()} == {(1, 2, 14), (2, 2, 14)}
    assert [r.doc_id for r in leakage.remove_leaked(d, leaks).collect()] == [3]


def test_suffix_arrays(spark):
    import numpy as np

    rng = random.Random(5)
    tokens = np.array([rng.choice([0, 1, 2, 3]) for _ in range(300)] + [0, 0])
    order = leakage.suffix_order(tokens, 300)
    assert sorted(order) == [i for i, t in enumerate(tokens) if t]
    ends = lambda i: tokens[i : i + list(tokens[i:]).index(0)].tolist()
    assert [ends(i) for i in order] == sorted(ends(i) for i in range(len(tokens)) if tokens[i])
    queries = np.array([[a, b] for a in (1, 2, 3, 9) for b in (1, 2, 3)])
    lo, hi = leakage.find_suffixes(tokens, order, queries)
    for q, a, b in zip(queries.tolist(), lo, hi):
        assert sorted(order[a:b]) == [i for i in range(len(tokens) - 1) if tokens[i : i + 2].tolist() == q]
    assert not len(leakage.suffix_order(np.zeros(3, np.int64), 0))


def test_shards_of_any_size_give_the_same(spark, monkeypatch):
    docs = [(i, " ".join(ITEM.split()[i % 4 :]) + f" tail {i}") for i in range(20)] + [(30, "word " * 500 + ITEM)]
    whole = run(spark, docs, [(1, ITEM)])
    monkeypatch.setattr(leakage, "SHARD_WORDS", 40)
    assert run(spark, docs, [(1, ITEM)]) == whole and len(whole) == 16


def test_a_task_holds_one_shard_however_many_there_are(spark, monkeypatch):
    key, stage, staged, limits = "spark.sql.execution.arrow.maxBytesPerBatch", tables.stage, {}, []

    def record(df, name, *options):
        staged[name] = stage(df, name, *options)
        limits.append(int(spark.conf.get(key).rstrip("b")))
        return staged[name]

    monkeypatch.setattr(leakage, "stage", record)
    monkeypatch.setattr(leakage, "SHARD_WORDS", 40)
    monkeypatch.setattr(leakage, "KNOWN_WORDS", 3, raising=False)
    docs = spark.createDataFrame([(i, f"{ITEM} tail {i}", "x") for i in range(30)], DOCS).coalesce(1)
    before = spark.conf.get(key)
    assert leakage.find_leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string")).count() == 30
    shards = staged["suffix-arrays"]
    files = [pq.ParquetFile(p.removeprefix("file://")).metadata for p in shards.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert len(groups) == shards.count() == 15 and all(g.num_rows == 1 for g in groups)
    # the writer keeps the least and largest value of each row group until the end
    assert not any(g.column(c).statistics for g in groups for c in range(g.num_columns))
    assert len(limits) == 2 and max(limits) <= 4_000_000 and spark.conf.get(key) == before

    def sizes(batches):
        for pdf in batches:
            yield pd.DataFrame([{"n": len(pdf)}])

    with tables.small_batches(spark, 1):
        assert {r.n for r in shards.coalesce(1).mapInPandas(sizes, "n int").collect()} == {1}


def test_words():
    assert leakage.words("Fíve, x² ß_a") == ["five", "x²", "ß", "a"]
