"""Problem 7: one label per item from annotators who disagree.

Method: Dawid and Skene (1979). Every annotator has a confusion matrix; item posteriors
and matrices are estimated in turn by expectation-maximisation with smoothing.
Chance-corrected agreement (Krippendorff's alpha, nominal) is reported on its own and
plays no part in the consensus.

The votes of an item are packed into one array of ``annotator * labels + label`` codes,
written once. Each iteration is one pass over the packed items without a shuffle of
items: partitions return sums of annotators x labels x labels cells, and only the model
(one matrix per annotator) is on the driver.

A vote is an annotator's label in their latest round for the item; if that round holds
several, the one given last, then the first by name. Defined results: rows without an
annotator, item or known label are no votes; repeated rows count once; ties of posteriors
go to the first label of the list; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage

#: Entity types (fixed values).
LABELS = ("DIAGNOSIS", "LAB_RESULT", "MEDICATION", "VITAL_SIGN", "PROCEDURE", "OTHER")


def label_of(spelling: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The label a free spelling names: case, spacing and punctuation do not count."""
    key = F.regexp_replace(F.upper(spelling), r"[^\p{L}\p{N}]", "")
    out = F.lit(None).cast("string")
    for name in labels:
        out = F.when(key == name.replace("_", ""), name).otherwise(out)
    return out


def votes(annotations: DataFrame, *, item: tuple[str, ...] = ("chart_id", "start_offset"), annotator: str = "annotator_id", label: str = "entity_type", round_: str = "annotation_round", at: str = "annotated_at", labels: tuple[str, ...] = LABELS) -> DataFrame:
    """(item columns, annotator, label): one row per item and annotator."""
    rows = annotations.select(*item, F.col(annotator).alias("annotator"), label_of(F.col(label), labels).alias("label"), F.col(round_).alias("_round"), F.col(at).alias("_at"))
    ok = F.col("annotator").isNotNull() & (F.trim("annotator") != "") & F.col("label").isNotNull()
    for c in item:
        ok = ok & F.col(c).isNotNull()
    # max() over the negated name picks the first by name among equals, without a sort.
    rank = F.struct(F.coalesce("_round", F.lit(-1)).alias("r"), F.coalesce(F.col("_at").cast("double"), F.lit(-1e18)).alias("t"), F.negative(F.array_position(F.array(*map(F.lit, labels)), F.col("label"))).alias("l"), "label")
    return rows.where(ok).groupBy(*item, "annotator").agg(F.max(rank).alias("m")).select(*item, "annotator", F.col("m.label").alias("label"))


def pack(vote_rows: DataFrame, item: tuple[str, ...], labels: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """(item, codes) written once, and the annotators in order: at most one code per annotator and item."""
    vote_rows = stage(vote_rows, "votes")
    names = [r[0] for r in vote_rows.select("annotator").distinct().orderBy("annotator").collect()]  # one matrix each below
    spark = vote_rows.sparkSession
    index = spark.createDataFrame(list(zip(names, range(len(names)))), "annotator string, a int")
    at = F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1
    coded = vote_rows.join(F.broadcast(index), "annotator").select(*item, (F.col("a") * len(labels) + at).cast("int").alias("code"))
    return stage(coded.groupBy(*item).agg(F.array_sort(F.collect_list("code")).alias("codes")), "packed"), names


def _posterior(codes: list, log_prior: np.ndarray, log_conf: np.ndarray) -> np.ndarray:
    """Row per item; ``log_conf[code]`` holds the log chance of that vote under each true label."""
    sizes = np.array([len(c) for c in codes])
    flat = np.concatenate(codes).astype(int) if len(codes) else np.zeros(0, int)
    score = np.tile(log_prior, (len(codes), 1))
    np.add.at(score, np.repeat(np.arange(len(codes)), sizes), log_conf[flat])
    score -= score.max(axis=1, keepdims=True)
    p = np.exp(score)
    return p / p.sum(axis=1, keepdims=True)


def fit(packed: DataFrame, n_annotators: int, n_labels: int, *, smoothing: float = 3.0, iterations: int = 60, tolerance: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """(log prior, log confusion by code): EM from majority shares to a change of the model below ``tolerance``."""
    spark, size = packed.sparkSession, n_annotators * n_labels
    prior = np.full(n_labels, 1.0 / n_labels)
    conf = None
    for _ in range(iterations):
        shared = None if conf is None else spark.sparkContext.broadcast((np.log(prior), np.log(conf)))

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cells, mass = np.zeros((size, n_labels)), np.zeros(n_labels)
            for pdf in batches:
                codes = [np.asarray(c) for c in pdf["codes"]]
                if shared is None:  # shares of the item's votes
                    p = np.zeros((len(codes), n_labels))
                    for i, c in enumerate(codes):
                        np.add.at(p[i], c % n_labels, 1.0 / len(c))
                else:
                    p = _posterior(codes, *shared.value)
                mass += p.sum(axis=0)
                rows = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
                if len(rows):
                    np.add.at(cells, np.concatenate(codes), p[rows])
            code, label = np.nonzero(cells)
            yield pd.DataFrame({"code": np.r_[code, np.full(n_labels, -1)], "label": np.r_[label, np.arange(n_labels)], "mass": np.r_[cells[code, label], mass]})

        got = packed.select("codes").mapInPandas(sums, "code long, label long, mass double").groupBy("code", "label").agg(F.sum("mass")).collect()
        cells, mass = np.zeros((size, n_labels)), np.zeros(n_labels)
        for code, label, x in sorted(got):
            if code < 0:
                mass[label] = x
            else:
                cells[code, label] = x
        # Smoothing: pseudo-votes that favour the true label a little, so rare types keep a shape.
        base = smoothing * (np.full((n_labels, n_labels), 0.5 / n_labels) + 0.5 * np.eye(n_labels))
        counts = cells.reshape(n_annotators, n_labels, n_labels) + base
        fresh = counts / counts.sum(axis=1, keepdims=True)  # axes: annotator, vote, truth
        new_prior = (mass + smoothing / n_labels) / (mass.sum() + smoothing)
        change = np.inf if conf is None else max(np.abs(fresh.reshape(size, n_labels) - conf).max(), np.abs(new_prior - prior).max())
        conf, prior = fresh.reshape(size, n_labels), new_prior
        if change < tolerance:
            break
    return np.log(prior), np.log(conf)


def consensus(annotations: DataFrame, *, item: tuple[str, ...] = ("chart_id", "start_offset"), labels: tuple[str, ...] = LABELS, smoothing: float = 3.0) -> DataFrame:
    """(item, label, posterior, n_votes, n_types): the best-supported label of every item with a vote."""
    packed, names = pack(votes(annotations, item=item, labels=labels), item, labels)
    k = len(labels)
    kinds = dict(packed.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in item) + ", label string, posterior double, n_votes int, n_types int"
    if not names:
        return packed.sparkSession.createDataFrame([], schema)
    model = packed.sparkSession.sparkContext.broadcast(fit(packed, len(names), k, smoothing=smoothing))

    def decide(batches):
        for pdf in batches:
            codes = [np.asarray(c) for c in pdf["codes"]]
            p = _posterior(codes, *model.value)
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            out = pdf[list(item)].copy()
            out["label"] = [labels[b] for b in best]
            out["posterior"] = p[np.arange(len(p)), best]
            out["n_votes"] = [len(c) for c in codes]
            out["n_types"] = [len(set((c % k).tolist())) for c in codes]
            yield out

    return packed.mapInPandas(decide, schema)


def reliability(annotations: DataFrame, *, item: tuple[str, ...] = ("chart_id", "start_offset"), labels: tuple[str, ...] = LABELS, smoothing: float = 3.0) -> DataFrame:
    """(annotator, n_votes, accuracy): the chance that an annotator names the true label, over the estimated mix of labels."""
    rows = stage(votes(annotations, item=item, labels=labels), "votes")
    packed, names = pack(rows, item, labels)
    spark, k = rows.sparkSession, len(labels)
    if not names:
        return spark.createDataFrame([], "annotator string, n_votes long, accuracy double")
    prior, conf = map(np.exp, fit(packed, len(names), k, smoothing=smoothing))
    right = np.einsum("aii,i->a", conf.reshape(len(names), k, k), prior)
    model = spark.createDataFrame([(n, float(x)) for n, x in zip(names, right)], "annotator string, accuracy double")
    return rows.groupBy("annotator").agg(F.count("*").alias("n_votes")).join(F.broadcast(model), "annotator")


def krippendorff_alpha(annotations: DataFrame, *, item: tuple[str, ...] = ("chart_id", "start_offset"), labels: tuple[str, ...] = LABELS) -> DataFrame:
    """One row (n_items, n_votes, alpha): nominal alpha over items with two votes or more; null without any, 1 if one label only."""
    counts = votes(annotations, item=item, labels=labels).groupBy(*item, "label").agg(F.count("*").alias("n"))
    per_item = counts.groupBy(*item).agg(F.sum("n").alias("m"), F.sum(F.col("n") * (F.col("n") - 1)).alias("agree"))
    pairable = per_item.where("m >= 2")
    kept = counts.join(pairable.select(*item, "m"), list(item))
    by_label = kept.groupBy("label").agg(F.sum("n").alias("n")).agg(F.sum("n").alias("total"), F.sum(F.col("n") * (F.col("n") - 1)).alias("expected"))
    seen = pairable.agg(F.count("*").alias("n_items"), F.sum(F.col("agree") / (F.col("m") - 1)).alias("agreeing"))
    one = seen.crossJoin(by_label)
    observed, chance = F.col("agreeing") / F.nullif(F.col("total"), F.lit(0)), F.col("expected") / F.nullif(F.col("total") * (F.col("total") - 1), F.lit(0))
    alpha = F.when(chance == 1, 1.0).otherwise(1 - (1 - observed) / (1 - chance))
    return one.select("n_items", F.coalesce("total", F.lit(0)).alias("n_votes"), F.round(alpha, 6).alias("alpha"))
