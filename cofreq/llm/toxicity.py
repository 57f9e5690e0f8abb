"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts carry a label; all other texts are unlabelled and
hide toxic ones among them.  With the share of toxic texts (the class prior)
known, the risk of a classifier on clean texts is its risk of calling an
unlabelled text toxic less the prior times that of calling a toxic text toxic.
That difference can't be negative in truth; where it is on the sample, the
classifier has begun to fit single texts, and that part counts as zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofreq.llm.common import small_batches, smallest_hashes
from cofreq.llm.textfeatures import SLOTS, Rows, sigmoid, word_slots
from cofreq.session import materialize

#: Bounds of the training sample, in documents.
MAX_POSITIVE, MAX_UNLABELLED = 2_000, 6_000
#: A score from here on is called toxic.
THRESHOLD = 0.7
#: Words of fewer sampled texts get no weight.
MIN_TEXTS = 4
#: Words as common in either sample get no weight: least difference, in
#: standard errors.
MIN_SIGMA = 5.0


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        slots = word_slots(text)
        return float(sigmoid(self.bias + self.weights[slots].sum(dtype=np.float64)))


def fit(positive: Rows, unlabelled: Rows, prior: float, steps: int = 250, rate: float = 0.05,
        decay: float = 1e-4) -> Model:
    """Linear classifier of the least non-negative PU risk with logistic loss
    (full-batch Adam; no randomness).  Without positive texts or a prior
    everything scores 0."""
    if not len(positive) or not prior:
        return Model(np.zeros(SLOTS), -40.0)
    seen = _telling(positive, unlabelled)
    positive, unlabelled = positive.only(seen), unlabelled.only(seen)
    w = np.zeros(SLOTS + 1)
    w[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        zp = positive.margins(w[:-1]) + w[-1]
        zu = unlabelled.margins(w[:-1]) + w[-1]
        sp, su = sigmoid(zp), sigmoid(zu)
        n_p, n_u = len(positive), max(len(unlabelled), 1)
        on_clean = np.logaddexp(0, zu).sum() / n_u - prior * np.logaddexp(0, zp).mean()
        if on_clean >= 0:
            gp, gu = -prior * (1 - sp) / n_p - prior * sp / n_p, su / n_u
        else:
            gp, gu = -prior * (1 - sp) / n_p, 0 * su
        g = np.zeros_like(w)
        g[:-1] = (positive.gradient(gp, SLOTS) + unlabelled.gradient(gu, SLOTS)) + decay * w[:-1]
        g[-1] = gp.sum() + gu.sum()
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(w[:-1], float(w[-1]))


def _telling(positive: Rows, unlabelled: Rows) -> np.ndarray:
    """Slots whose share of texts differs between the two samples by more than
    ``MIN_SIGMA`` standard errors; the others get no weight."""
    n1, n0 = len(positive), max(len(unlabelled), 1)
    d1 = np.bincount(positive.slot, minlength=SLOTS)
    d0 = np.bincount(unlabelled.slot, minlength=SLOTS)
    share = (d1 + d0) / (n1 + n0)
    error = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0)) + 1e-12
    return (np.abs(d1 / n1 - d0 / n0) > MIN_SIGMA * error) & (d1 + d0 >= MIN_TEXTS)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, prior: float | None = None) -> Model:
    """Model from documents that are not held out: confirmed toxic ones, and
    documents of any kind as unlabelled text (the estimator needs them drawn
    from the whole mixture, so a toxic one may serve as both).

    The sample is bounded: documents of the smallest id hashes, up to
    ``max_positive`` and ``max_unlabelled``.  Ids are picked first, on narrow
    rows; only hashed words of the picked texts reach the driver.  ``prior``:
    by default the share of toxic rows among labelled ones that are not held
    out, less two standard errors (too high a prior would call clean texts
    toxic to reach it).  Null ids and null labels are ignored; of several labels of a document
    the larger counts.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    if prior is None:
        n, n_toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("int"))).first()
        share = (n_toxic or 0) / max(n, 1)
        error = (share * (1 - share) / max(n, 1)) ** 0.5
        prior = max(share - 2 * error, share / 2)
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    ids = materialize(ids.join(known.where("toxic = 1"), "doc_id", "left")
                      .select("doc_id", F.xxhash64("doc_id").alias("h"), F.col("toxic").isNotNull().alias("toxic")), "ids")
    n, n_toxic = ids.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    picked = [smallest_hashes(some, count, most).select("doc_id", F.lit(flag).alias("positive"))
              for some, count, flag, most in ((ids.where("toxic"), n_toxic, True, max_positive),
                                              (ids, n, False, max_unlabelled))]
    small_batches(docs.sparkSession)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([word_slots(t) for t in b.column(2).to_pylist()], pa.list_(pa.int32()))],
                names=["doc_id", "positive", "slots"])

    # at most max_positive + max_unlabelled ids of a few bytes
    chosen = F.broadcast(picked[0].unionAll(picked[1]))
    sample = (docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "positive", "text")
              .mapInArrow(slots, "doc_id bigint, positive boolean, slots array<int>")
              # an id that stands on many rows is one row of the sample
              .groupBy("doc_id", "positive").agg(F.min("slots").alias("slots")).toArrow())
    rows = sorted(zip(sample["doc_id"].to_pylist(), sample["positive"].to_pylist(),
                      (np.asarray(x.values, dtype=np.int32) for x in sample["slots"])),
                  key=lambda r: (r[0], len(r[2])))
    return fit(Rows(x for _, p, x in rows if p), Rows(x for _, p, x in rows if not p), prior)


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: the model's score, 0 to 1, of each
    whole text (null as empty)."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    small_batches(docs.sparkSession)
    docs = docs.drop(name) if name in docs.columns else docs
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for b in batches:
            scores = [own.score(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, a row per row of ``docs``.

    Scores depend on the text only: equal texts, repeated rows included, score
    alike, and a null text scores as an empty one.  An empty table gives an
    empty result; without toxic labels everything scores 0; other columns are
    ignored.
    """
    model = train(docs, labels)
    return with_score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose score is below ``threshold``, unchanged: columns of
    any name, null texts (as empty ones) and repeated rows included.  Without
    toxic labels every row stays; an empty table stays empty."""
    name = "toxicity"
    while name in map(str.lower, docs.columns):
        name += "_"
    return with_score(docs, train(docs, labels), name).where(F.col(name) < threshold).drop(name)
