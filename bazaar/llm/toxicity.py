"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words and its words' first letters (prefixes of ``PREFIX`` bytes), hashed into
``SLOTS`` slots. The score is the logistic of w0 + sum w_i + sum over pairs <v_i, v_j> over the distinct slots, so a pair
of terms can count although neither does alone. The machine is fitted on a bounded sample of labelled rows
(``MAX_ROWS``, by a hash of the id) in numpy. Every term of the sample takes part; no term is chosen by its label rate.
Proximal steps (L1) leave at zero what the rows don't support. Vectors start along the linear weights: a term without an
effect of its own starts at zero and moves as soon as its company with a telling term explains what is left over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import textbytes as tb
from bazaar.llm.shared import Shipped, extended

MAX_ROWS = 16_000
SLOTS = 1 << 18
FACTORS = 8
EPOCHS, LINEAR = 30, 8  # passes in all, and those before the pairs join
BATCH = 64
RATE, PAIR_RATE = 0.05, 0.05
SHRINK = 5e-3  # L1 on every weight
START = 0.3  # spread of a vector, times the term's own weight
CALIBRATE = 10  # one row in so many sets slope and offset of the score
PREFIX = 6
THRESHOLD = 0.3


def hashed_terms(buf: np.ndarray, offs: np.ndarray, pw: tb.Powers) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts and each term's text; a term may repeat."""
    low = tb.LOWER[buf]
    starts, ends, woffs = tb.words(low, offs, tb.ALNUM_WORD)
    h = tb.prefix_hash(low, pw)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(woffs))
    long = ends - starts > PREFIX
    cut = tb.span_hash(h, starts[long], starts[long] + PREFIX, pw) ^ tb.U64(0xA5A5A5A5A5A5A5A5)
    return np.concatenate([tb.span_hash(h, starts, ends, pw), cut]), np.concatenate([doc, doc[long]])


def distinct_slots(h: np.ndarray, doc: np.ndarray, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct slots, ascending by text; with ``active`` only slots for which it holds."""
    slot = (h >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)
    if active is not None:
        keep = active[slot]
        slot, doc = slot[keep], doc[keep]
    key = np.unique(doc.astype(np.int64) * SLOTS + slot)
    return (key % SLOTS).astype(np.int32), key // SLOTS


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of the rows values[offs[i]:offs[i + 1]]."""
    out = np.add.reduceat(np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)]), offs[:-1])
    out[offs[1:] == offs[:-1]] = 0
    return out


class _Batch:
    """Rows of the sample: their slots, and what their gradients are added up by."""

    def __init__(self, slots: np.ndarray, offs: np.ndarray, rows: np.ndarray):
        size = offs[rows + 1] - offs[rows]
        self.rows, self.offs = rows, np.concatenate([[0], np.cumsum(size)])
        items = slots[np.repeat(offs[rows] - self.offs[:-1], size) + np.arange(self.offs[-1])]
        self.touched, inv = np.unique(items, return_inverse=True)
        self.inv = inv.astype(np.int32)
        self.order = np.argsort(self.inv, kind="stable").astype(np.int32)
        self.starts = np.searchsorted(self.inv[self.order], np.arange(len(self.touched)))
        self.who = np.repeat(np.arange(len(rows), dtype=np.int32), size)


def _raw(w0: float, weights: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the weights, w0 + linear part + pairs) of texts; ``weights``: a row (w, v) per slot of a text."""
    total = _sums(weights, offs)
    return total, w0 + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(1) - _sums((weights[:, 1:] ** 2).sum(1), offs))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _line(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic regression of ``y`` on ``z``, held near 1 and 0 by a small ridge."""
    x, beta, prior = np.stack([z, np.ones(len(z))], 1), np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(25):
        p = _logistic(x @ beta)
        grad = x.T @ (p - y) + (beta - prior)
        beta = beta - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), grad)
        beta[0] = min(max(beta[0], 0.25), 4.0)
    return float(beta[0]), float(beta[1])


class FactorizationMachine:
    """w0, w and V over the slots; ``fit`` learns them by proximal AdaGrad on the logistic loss."""

    def __init__(self, factors: int = FACTORS, seed: int = 5):
        self.k, self.seed, self.w0 = factors, seed, -4.0
        self._keep(np.zeros((0, factors + 1), np.float32), np.zeros(0, np.int64))

    def _keep(self, weights: np.ndarray, slots: np.ndarray):
        """Only slots with a weight other than zero are stored, and each slot's place among them."""
        self.weights = weights
        self.place = np.full(SLOTS, -1, np.int32)
        self.place[slots] = np.arange(len(slots))

    def fit(self, slots: np.ndarray, offs: np.ndarray, y: np.ndarray, epochs: int = EPOCHS):
        """``slots[offs[i]:offs[i + 1]]`` are the distinct slots of row i. Without both labels: the base rate alone."""
        if not len(y) or y.min() == y.max():
            self.w0 = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else -4.0
            return self
        rng = np.random.default_rng(self.seed)
        weights, seen = np.zeros((SLOTS, self.k + 1), np.float32), np.unique(slots)
        order = rng.permutation(len(y))
        aside, order = np.split(order, [len(order) // CALIBRATE])
        if len(np.unique(y[aside])) < 2 or len(np.unique(y[order])) < 2:
            aside, order = order[:0], np.arange(len(y))
        w0 = float(np.log(y[order].mean() / (1 - y[order].mean())))
        g0, g = 1e-3, np.full_like(weights, 1e-3)
        rate = np.array([RATE] + [PAIR_RATE] * self.k, np.float32)
        batches = [_Batch(slots, offs, order[lo:lo + BATCH]) for lo in range(0, len(order), BATCH)]
        for epoch in range(epochs):
            if epoch == LINEAR:
                weights[seen, 1:] = START * weights[seen, :1] * rng.normal(0, 1, (len(seen), self.k))
            for i in rng.permutation(len(batches)):
                b = batches[i]
                old = weights[b.touched]
                x = old[b.inv]
                total, z = _raw(w0, x, b.offs)
                e = ((_logistic(z) - y[b.rows]) / len(b.rows)).astype(np.float32)
                g0 += float(e.sum()) ** 2
                w0 -= RATE * float(e.sum()) / g0 ** 0.5
                if not len(b.touched):
                    continue
                d = total[b.who] - x
                d[:, 0] = 1
                d *= e[b.who][:, None]
                d = np.add.reduceat(d[b.order], b.starts)
                now = g[b.touched] + d * d
                g[b.touched] = now
                step = rate / np.sqrt(now)
                new = old - step * d
                weights[b.touched] = np.sign(new) * np.maximum(np.abs(new) - SHRINK * step, 0)
        if len(aside):
            b = _Batch(slots, offs, aside)
            slope, offset = _line(_raw(w0, weights[b.touched][b.inv], b.offs)[1].astype(np.float64), y[aside])
            w0 = slope * w0 + offset
            weights *= np.array([slope] + [slope ** 0.5] * self.k, np.float32)
        active = np.flatnonzero(weights.any(1))
        self.w0 = w0
        self._keep(weights[active], active)
        return self

    def score(self, h: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
        """Probability of every text; one without terms that carry a weight has the base rate."""
        slot, doc = distinct_slots(h, doc, self.place >= 0)
        weights = self.weights[self.place[slot]].astype(np.float64)
        return _logistic(_raw(self.w0, weights, np.searchsorted(doc, np.arange(texts + 1)))[1])


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, text and label of at most ``max_rows`` labelled documents, the first by a hash of the id.

    Rows with a null label or id are not used; of several labels for an id the largest counts."""
    picked = (labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label_col).cast("int").alias("_y"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_rows))
    # at most max_rows pairs of numbers: small enough to broadcast at any size of the input
    return docs.select("doc_id", F.col("text").alias("_text")).join(F.broadcast(picked), "doc_id")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_ROWS) -> FactorizationMachine:
    """A machine fitted on the bounded sample. The driver gathers at most ``max_rows`` rows of at most ``SLOTS`` numbers."""
    rows = training_sample(docs, labels, label_col, max_rows).select("_text", "_y", "doc_id")

    def run(batches):
        pw = tb.Powers()
        for batch in batches:
            for lo, buf, offs in tb.slices(batch.column(0)):
                slot, doc = distinct_slots(*hashed_terms(buf, offs, pw))
                n = len(offs) - 1
                edges = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, n), batch.column(2).slice(lo, n), pa.ListArray.from_arrays(pa.array(edges), pa.array(slot))], ["y", "doc_id", "slots"])

    got = rows.mapInArrow(run, "y int, doc_id long, slots array<int>").orderBy("doc_id", "y", "slots").toArrow()
    lists = got.column("slots").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return FactorizationMachine().fit(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), got.column("y").to_numpy().astype(np.float64))


def score_toxicity(docs: DataFrame, model: FactorizationMachine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add toxicity (0 to 1) and toxic_predicted (int) to every row.

    Null and empty texts get the score of a text without terms. Repeated rows score alike. Columns of these
    names are replaced; the others stay. No label, language, source or id is read."""
    added = ("toxicity", "toxic_predicted")
    src = docs.drop(*added)
    at = src.columns.index(text_col)
    shipped = Shipped(docs.sparkSession, model)

    def run(batches):
        m, pw = shipped.load(), tb.Powers()
        for batch in batches:
            scores = [np.zeros(0)]
            for _, buf, offs in tb.slices(batch.column(at)):
                scores.append(m.score(*hashed_terms(buf, offs, pw), len(offs) - 1))
            s = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*batch.schema.names, *added])

    return src.mapInArrow(run, extended(src, toxicity="double", toxic_predicted="int"))
