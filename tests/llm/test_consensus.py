import math
import random
from datetime import datetime

import pytest

from notecode.llm import consensus as C

SCHEMA = "chart_id string, start_offset int, annotator_id string, annotation_round int, entity_type string, annotated_at timestamp, label string, posterior string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, datetime(2025, 1, 1), "x", "y") if len(r) == 5 else (*r, "x", "y") for r in rows], SCHEMA)


def test_votes(spark):
    rows = [("c", 1, "A", 1, "diagnosis"), ("c", 1, "A", 2, "Lab Result"), ("c", 1, "B", None, "LAB_RESULT "), ("c", 1, None, 1, "OTHER"), ("c", 1, "D", 1, "nonsense"), ("c", None, "A", 1, "OTHER"), ("c", 1, "A", 2, "Lab Result"), ("c", 1, "", 1, "OTHER")]
    got = {(r.annotator, r.label) for r in C.votes(frame(spark, rows)).collect()}
    assert got == {("A", "LAB_RESULT"), ("B", "LAB_RESULT")}


def test_unreliable_majority_is_overruled(spark):
    rng = random.Random(1)
    truth = {i: rng.choice(C.LABELS[:3]) for i in range(400)}
    rows = []
    for i, t in truth.items():
        rows += [("c", i, a, 1, t if rng.random() < 0.95 else rng.choice(C.LABELS)) for a in ("g1", "g2")]
        rows += [("c", i, a, 1, "OTHER" if rng.random() < 0.7 else rng.choice(C.LABELS)) for a in ("b1", "b2", "b3")]
    got = {r.start_offset: r.label for r in C.consensus(frame(spark, rows)).collect()}

    # The best any rule can do: the posterior under the matrices the votes were drawn from.
    def chance(annotator, vote, t):
        main, p = (t, 0.95) if annotator[0] == "g" else ("OTHER", 0.7)
        return p * (vote == main) + (1 - p) / len(C.LABELS)

    def ideal(i):
        own = [(r[2], r[4]) for r in rows if r[1] == i]
        return max(C.LABELS[:3], key=lambda t: math.prod(chance(a, v, t) for a, v in own))

    best = sum(ideal(i) == t for i, t in truth.items())
    assert sum(got[i] == t for i, t in truth.items()) >= best - 8 > 340
    r = {x.annotator: x.accuracy for x in C.reliability(frame(spark, rows)).collect()}
    assert min(r["g1"], r["g2"]) > 0.85 > 0.5 > max(r["b1"], r["b2"], r["b3"])


def test_ties_and_empty(spark):
    one = C.consensus(frame(spark, [("c", 1, "A", 1, "OTHER"), ("c", 1, "B", 1, "DIAGNOSIS")])).head()
    assert one.label == "DIAGNOSIS" and one.n_types == 2
    empty = frame(spark, [])
    assert C.consensus(empty).count() == 0 and C.reliability(empty).count() == 0
    assert C.krippendorff_alpha(empty).head().alpha is None


def test_alpha(spark):
    # Worked by hand: items (a a), (a b), (b b): observed 1/3, expected 1 - (3*2 + 3*2)/(6*5) = 0.6.
    rows = [("c", 1, "A", 1, "OTHER"), ("c", 1, "B", 1, "OTHER"), ("c", 2, "A", 1, "OTHER"), ("c", 2, "B", 1, "DIAGNOSIS"), ("c", 3, "A", 1, "DIAGNOSIS"), ("c", 3, "B", 1, "DIAGNOSIS"), ("c", 4, "A", 1, "OTHER")]
    r = C.krippendorff_alpha(frame(spark, rows)).head()
    assert (r.n_items, r.n_votes) == (3, 6) and r.alpha == pytest.approx(1 - (1 / 3) / 0.6, abs=1e-6)
