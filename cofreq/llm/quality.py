"""Quality classifier by co-training two views of a page.

The content view sees words: how varied, long and repetitive they are.  The
metadata view sees what is known about the page: language, source, size, and
its layout (lines and kinds of characters).  Each trains a classifier on few
labels; over some rounds each gives the other the unlabelled documents it is
surest of, as pseudo-labels.  Both are then calibrated on labelled documents
that neither trained on, and the calibrated log-odds are combined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofreq.llm.common import small_batches, smallest_hashes
from cofreq.llm.textfeatures import sigmoid
from cofreq.llm.toxicity import held_out
from cofreq.session import materialize

#: Bounds of the samples, in documents: labelled and unlabelled.
MAX_LABELLED, MAX_UNLABELLED = 6_000, 12_000
#: Rounds of exchange, pseudo-labels that a view gives per round and class as a
#: share of the other's labels of that class, and how sure it must be.
ROUNDS, GIVEN, SURE = 5, 0.25, 0.95
#: Scores from here on are good.
THRESHOLD = 0.5
#: Quantile bins of a number, slots of a hashed name.
BINS, SLOTS = 12, 32

CONTENT = ["log_words", "distinct", "top_share", "second_share", "same_as_last", "word_length", "long_words"]
LAYOUT = ["log_chars", "lines", "line_chars", "repeated_lines", "upper", "lower", "digit", "stop", "mark", "bar", "other"]
NAMES = ["lang", "source"]

_KIND = np.full(256, 6)
_KIND[ord("A"):ord("Z") + 1] = 0
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[128:] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_KIND[[ord(c) for c in ".,;:?'\"-()"]] = 3
_KIND[[ord(c) for c in "!#$%&*@^~=<>{}[]\\/+_`"]] = 4
_KIND[ord("|")] = 5
_KIND[[9, 10, 11, 12, 13, 32]] = 7


def features(text: str | None) -> list[float]:
    """CONTENT and LAYOUT numbers of a whole text; null as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    n = max(len(words), 1)
    common = [c for _, c in Counter(words).most_common(2)] + [0, 0]
    content = [np.log1p(len(words)), len(set(words)) / n, common[0] / n, common[1] / n,
               sum(map(eq, words, words[1:])) / n, sum(map(len, words)) / n,
               sum(len(w) > 12 for w in words) / n]
    lines = data.split(b"\n")
    kinds = np.bincount(_KIND, np.bincount(np.frombuffer(data, np.uint8), minlength=256), 8)
    shares = kinds[:7] / max(len(data), 1)
    return content + [np.log1p(len(data)), float(len(lines)), len(data) / len(lines),
                      1 - len(set(lines)) / len(lines), *shares.tolist()]


@dataclass
class View:
    """Logistic regression on quantile bins of numbers and hashed names."""

    edges: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None

    def bins(self, numbers: np.ndarray) -> None:
        cuts = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, cuts)) if len(c) else np.zeros(0) for c in numbers.T]

    def design(self, numbers: np.ndarray, names: np.ndarray) -> np.ndarray:
        parts = [np.ones((len(numbers), 1))]
        for c, e in zip(numbers.T, self.edges):
            parts.append(np.eye(len(e) + 1)[np.searchsorted(e, c, "right")])
        parts += [np.eye(SLOTS)[c] for c in names.T]
        return np.concatenate(parts, axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        """Newton steps; classes weigh alike."""
        self.weights = np.zeros(x.shape[1])
        share = y.mean() if len(y) else 0.5
        if share in (0, 1) or not len(y):
            self.weights[0] = 0.0 if not len(y) else 3.0 if share else -3.0
            return
        weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
        for _ in range(12):
            p = sigmoid(x @ self.weights)
            h = weight * np.maximum(p * (1 - p), 1e-6)
            gradient = x.T @ (weight * (p - y)) + ridge * self.weights
            self.weights -= np.linalg.solve((x * h[:, None]).T @ x + ridge * np.eye(len(self.weights)), gradient)


@dataclass
class Model:
    content: View
    metadata: View
    #: log-odds = mix[0] + mix[1] * content + mix[2] * metadata
    mix: np.ndarray

    def margins(self, numbers: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, none = len(CONTENT), np.zeros((len(numbers), 0), int)
        return (self.content.design(numbers[:, :k], none) @ self.content.weights,
                self.metadata.design(numbers[:, k:], names) @ self.metadata.weights)

    def scores(self, numbers: np.ndarray, names: np.ndarray) -> np.ndarray:
        a, b = self.margins(numbers, names)
        return sigmoid(self.mix[0] + self.mix[1] * a + self.mix[2] * b)


def _platt(margins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and non-negative slopes that calibrate margins to labels."""
    x = np.column_stack([np.ones(len(y)), *margins])
    view = np.concatenate([[0.0], np.full(len(margins), 1.0 / len(margins))])
    if len(y) < 10 or y.mean() in (0, 1):
        return view
    w = view.copy()
    for _ in range(25):
        p = sigmoid(x @ w)
        h = np.maximum(p * (1 - p), 1e-6)
        w -= np.linalg.solve((x * h[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (p - y) + 0.1 * (w - view))
    w[1:] = np.maximum(w[1:], 0.0)
    return w


def cotrain(numbers: np.ndarray, names: np.ndarray, y: np.ndarray, pool_numbers: np.ndarray,
            pool_names: np.ndarray) -> Model:
    """Both views' classifiers after the exchange.  Every fourth labelled row
    is kept for calibration; nothing is random."""
    k = len(CONTENT)
    views = View(), View()
    every = np.concatenate([numbers, pool_numbers])
    for view, part in zip(views, (every[:, :k], every[:, k:])):
        view.bins(part)
    model = Model(*views, np.array([0.0, 0.5, 0.5]))
    none = np.zeros((len(numbers), 0), int)
    x = (views[0].design(numbers[:, :k], none), views[1].design(numbers[:, k:], names))
    u = (views[0].design(pool_numbers[:, :k], np.zeros((len(pool_numbers), 0), int)),
         views[1].design(pool_numbers[:, k:], pool_names))
    kept = np.arange(len(y)) % 4 == 0
    own = [x[v][~kept] for v in (0, 1)]
    labels = [y[~kept].astype(float)] * 2
    free = [np.ones(len(pool_numbers), bool) for _ in (0, 1)]  # not given to this view yet
    for turn in range(ROUNDS + 1):
        for v in (0, 1):
            views[v].fit(own[v], labels[v])
        if turn == ROUNDS or not len(pool_numbers):
            break
        for v, other in ((0, 1), (1, 0)):
            p = sigmoid(u[v] @ views[v].weights)
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                most = max(1, int(GIVEN * (labels[other] == label).sum()))
                order = np.argsort(-sure, kind="stable")
                order = order[free[other][order] & (sure[order] >= SURE)][:most]
                free[other][order] = False
                own[other] = np.concatenate([own[other], u[other][order]])
                labels[other] = np.concatenate([labels[other], np.full(len(order), label)])
    a, b = model.margins(numbers[kept], names[kept])
    # each view alone first, then both
    pa_, pb = _platt(a[None], y[kept]), _platt(b[None], y[kept])
    both = _platt(np.stack([pa_[0] + pa_[1] * a, pb[0] + pb[1] * b]), y[kept])
    model.mix = np.array([both[0] + both[1] * pa_[0] + both[2] * pb[0], both[1] * pa_[1], both[2] * pb[1]])
    return model


def _names(lang, source) -> list[int]:
    return [crc32(f"{kind}:{value}".encode()) % SLOTS for kind, value in zip(NAMES, (lang, source))]


def _arrays(texts, langs, sources) -> tuple[np.ndarray, np.ndarray]:
    n = len(texts)
    return (np.array([features(t) for t in texts]).reshape(n, len(CONTENT) + len(LAYOUT)),
            np.array([_names(a, b) for a, b in zip(langs, sources)], int).reshape(n, 2))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Model from documents that are not held out: labelled ones, and others
    as the pool.  The samples are bounded, by smallest id hash; only their
    features reach the driver.  Null ids and labels are ignored; of several
    labels of a document the larger counts."""
    able = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    known = labels.where(able & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    ids = materialize(docs.select("doc_id").where(able).distinct().join(known, "doc_id", "left").select(
        "doc_id", F.xxhash64("doc_id").alias("h"), F.coalesce(F.col("quality").cast("int"), F.lit(-1)).alias("label")), "ids")
    n, n_labelled = ids.agg(F.count(F.lit(1)), F.count_if(F.col("label") >= 0)).first()
    picked = [smallest_hashes(some, count, most).select("doc_id", "label") for some, count, most in (
        (ids.where("label >= 0"), n_labelled, max_labelled), (ids.where("label < 0"), n - n_labelled, max_unlabelled))]
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, names = _arrays(*(b.column(k).to_pylist() for k in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(list(numbers), pa.list_(pa.float64())),
                 pa.array(list(names), pa.list_(pa.int64()))], names=["doc_id", "label", "numbers", "names"])

    # at most max_labelled + max_unlabelled ids
    chosen = F.broadcast(picked[0].unionAll(picked[1]))
    sample = (docs.select("doc_id", "text", F.col("lang").cast("string"), F.col("source").cast("string"))
              .join(chosen, "doc_id").select("doc_id", "label", "text", "lang", "source")
              .mapInArrow(run, "doc_id bigint, label int, numbers array<double>, names array<bigint>")
              # an id that stands on many rows is one row of the sample
              .groupBy("doc_id", "label").agg(F.min(F.struct("numbers", "names")).alias("x"))
              .select("doc_id", "label", "x.*").toArrow())
    rows = sorted(zip(sample["doc_id"].to_pylist(), sample["label"].to_pylist(),
                      sample["numbers"].to_pylist(), sample["names"].to_pylist()),
                  key=lambda r: (crc32(str(r[0]).encode()), r))
    n = len(CONTENT) + len(LAYOUT)

    def part(some):
        return np.array([r[2] for r in some]).reshape(-1, n), np.array([r[3] for r in some], int).reshape(-1, 2)

    known_rows, pool = [r for r in rows if r[1] >= 0], [r for r in rows if r[1] < 0]
    return cotrain(*part(known_rows), np.array([r[1] for r in known_rows]), *part(pool))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted, score_content, score_metadata)``,
    a row per row of ``docs``; ``score`` is the probability of good quality and
    ``predicted`` 1 from ``threshold`` on.

    Whole texts are read; a null text counts as empty, a null language or
    source as a name of its own; repeated rows score alike; an empty table
    gives an empty result; without labels everything scores 0.5; other columns
    are ignored.
    """
    model = train(docs, labels)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, names = _arrays(*(b.column(k).to_pylist() for k in (1, 2, 3)))
            one, two = model.margins(numbers, names)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(s, pa.float64()) for s in (model.scores(numbers, names), sigmoid(one), sigmoid(two)))],
                names=["doc_id", "score", "score_content", "score_metadata"])

    schema = "doc_id bigint, score double, score_content double, score_metadata double"
    return (docs.select(F.col("doc_id").cast("bigint"), "text", F.col("lang").cast("string"), F.col("source").cast("string"))
            .mapInArrow(run, schema)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "score_content", "score_metadata"))
