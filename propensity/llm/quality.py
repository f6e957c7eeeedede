"""Document quality by hierarchical empirical Bayes.

Evidence: each text is described by the shape of its words, lines and characters, every figure put into a bin
(``cells``). Counts of bins among good and bad labelled texts give the log-likelihood ratio of a text (naive Bayes, add-one).

Prior: sites differ in their share of good texts. Labels (and, for texts without one, the classifier's probability) are summed
by host and by path. A host's share is shrunk towards the global share and a path's towards its host's, by
pseudo-counts that the method of moments estimates from the spread of the shares: sparse groups stay near their parent.
A text's own contribution is left out of its prior. Posterior odds are prior odds times the likelihood ratio.

All labelled rows are counted; what the driver gets is a few hundred bin counts and four moments.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common
from propensity.session import materialize

BINS = 16
FIGURES = ("words", "word length", "distinct words", "top word", "upper", "digits", "symbols", "marks", "lines", "same lines", "plain words", "line ends")
#: Evidence per figure is held within this many nats: a bin seen once or twice proves little.
MOST = 4.0
#: Bounds of the pseudo-counts of shrinkage.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0

_UPPER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = _DIGIT[48:58] = True
_SYMBOL, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_MARK[[ord(c) for c in "!\"'(),-.:;?"]] = True


def cells(text: str | None) -> list[int]:
    """The bin of each figure; an empty or null text has the lowest bins."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0] * len(FIGURES)
    n, chars = len(words), np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, int(chars[65:91].sum() + chars[97:123].sum() + chars[128:].sum()))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    plain = sum(w.rstrip(b".,").isalpha() or not w.isascii() for w in words)
    shares = [
        math.log2(n) / 16,
        min(1.0, len(raw) / n / 24),
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        chars[_UPPER].sum() / letters,
        min(1.0, 4 * chars[_DIGIT].sum() / letters),
        min(1.0, 4 * chars[_SYMBOL].sum() / letters),
        min(1.0, 4 * chars[_MARK].sum() / letters),
        min(1.0, len(lines) / n * 4),
        1 - len(set(lines)) / len(lines),
        plain / n,
        sum(x.rstrip()[-1:] in b".!?:\"" for x in lines) / len(lines),
    ]
    return [min(BINS - 1, int(s * BINS)) for s in shares]


def _described(docs: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            found = pa.array([cells(t) for t in batch.column(3).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], ["doc_id", "host", "path", "cells"])

    return common.in_batches(docs, run, f"doc_id {kinds['doc_id']}, host string, path string, cells array<int>")


def fit(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """Evidence of each figure's bins, and the share of good texts, from (cells, good)."""
    rows = (
        labelled.where("good is not null")
        .select("good", F.posexplode("cells").alias("figure", "bin"))
        .groupBy("figure", "bin", "good")
        .agg(F.count("*").alias("n"))
        .collect()  # at most 2 x BINS rows a figure
    )
    counts = np.ones((2, len(FIGURES), BINS))
    for r in rows:
        counts[int(r.good), r.figure, r.bin] += r.n
    shares = counts / counts.sum(axis=2, keepdims=True)
    totals = counts[:, 0].sum(axis=1) - BINS + 1
    return np.clip(np.log(shares[1] / shares[0]), -MOST, MOST), float(totals[1] / totals.sum())


def strength(groups: DataFrame, parent: str) -> float:
    """Pseudo-counts of a beta prior around ``parent``, from (good, n) of each group, by the method of moments.

    The weighted spread of the shares beyond that of chance is what groups really differ by; without any, shrink as far as allowed.
    """
    share, p = F.col("good") / F.col("n"), F.col(parent)
    row = groups.where("n > 1").agg(
        F.sum(F.col("n") * (share - p) ** 2).alias("spread"),
        F.sum(p * (1 - p)).alias("chance"),
        F.sum(F.col("n") * p * (1 - p)).alias("scale"),
    ).first()
    if not row.scale:
        return MOST_STRENGTH
    real = (row.spread - row.chance) / row.scale
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / real - 1)) if real > 0 else MOST_STRENGTH


def score(docs: DataFrame, labels: DataFrame, host, path, key: str = "doc_id", text: str = "text", label_key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(doc_id, evidence, host_share, path_share, score, keep) of every row; ``keep`` is a score of 0.5 or more.

    ``host`` and ``path`` are columns over ``docs``; nulls are one group of their own, and a path counts within its host. A key
    labelled more than once has the mean label, good from one half on. Null labels and null keys are no labels. Null texts are
    empty. Without labels the share is one half and nothing is evidence. Other columns are ignored.
    """
    docs = docs.select(F.col(key).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    good = labels.select(F.col(label_key).alias("label_id"), F.col(label).cast("double").alias("label")).where("label is not null")
    good = good.groupBy("label_id").agg((F.avg("label") >= 0.5).alias("good"))
    described = _described(docs)
    described = materialize(described.join(good, described["doc_id"] == good["label_id"], "left").drop("label_id"), "described")
    weights, share = fit(described)
    base = math.log(share / (1 - share))

    def weigh(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = np.array(batch.column(3).to_pylist(), np.int64).reshape(-1, len(FIGURES))
            evidence = weights[np.arange(len(FIGURES)), rows].sum(axis=1)
            chance = 1 / (1 + np.exp(-np.clip(evidence + base, -30, 30)))
            label = [c if g is None else float(g) for g, c in zip(batch.column(4).to_pylist(), chance.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(evidence), pa.array(label, pa.float64())], ["doc_id", "host", "path", "evidence", "own"])

    kind = described.schema["doc_id"].dataType.simpleString()
    rows = common.in_batches(described.select("doc_id", "host", "path", "cells", "good"), weigh, f"doc_id {kind}, host string, path string, evidence double, own double")
    rows = materialize(rows.fillna("", ["host", "path"]), "evidence")
    paths = materialize(rows.groupBy("host", "path").agg(F.sum("own").alias("good"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"), F.lit(share).alias("global"))
    s = strength(hosts, "global")
    hosts = materialize(hosts.select("host", ((F.col("good") + s * F.col("global")) / (F.col("n") + s)).alias("host_share")), "hosts")
    paths = paths.join(hosts, "host")
    t = strength(paths, "host_share")
    own_left_out = (F.col("good") - F.col("own") + t * F.col("host_share")) / (F.col("n") - 1 + t)
    told = rows.join(paths, ["host", "path"]).withColumn("path_share", F.least(F.greatest(own_left_out, F.lit(1e-6)), F.lit(1 - 1e-6)))
    odds = F.log(F.col("path_share") / (1 - F.col("path_share"))) + F.col("evidence")
    told = told.withColumn("score", 1 / (1 + F.exp(-odds)))
    return told.select("doc_id", "evidence", "host_share", "path_share", "score", (F.col("score") >= 0.5).alias("keep"))
