"""Byte n-gram counts per class, counted by Spark over whole texts.

A text of n bytes gives n n-grams: each byte with the ``order - 1`` bytes before it, where the start
of a text is padded with zero bytes. Tasks count in numpy and merge before they emit, so a shuffle
carries distinct n-grams per task, not occurrences. Models are built from all distinct n-grams, however rare, so a
model grows with their number (of order 5 and 256 byte values), not with the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import textbytes as tb


def gram_keys(buf: np.ndarray, offs: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each byte as a big-endian number (first byte highest); order is at most 7."""
    n = len(buf)
    key = buf.astype(np.uint64)
    for k in range(1, order):
        prev = np.zeros(n, np.uint64)
        prev[k:] = buf[:n - k]
        for j in range(k):  # the first k bytes of each text have no byte k places before
            at = offs[:-1] + j
            prev[at[at < offs[1:]]] = 0
        key |= prev << np.uint64(8 * k)
    return key


def _merge(a: tuple, b: tuple) -> tuple:
    keys, inv = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return keys, np.bincount(inv, np.concatenate([a[1], b[1]]), len(keys)).astype(np.int64)


def count_ngrams(docs: DataFrame, class_col: str, order: int, text_col: str = "text") -> DataFrame:
    """(class, gram long, n long) for every class value that is not null."""
    schema = "class string, gram long, n long"

    def counted(batches):
        held: dict[str, list[tuple]] = {}
        for batch in batches:
            cls = batch.column(0)
            for c in pc.unique(cls).to_pylist():
                rows = batch.filter(pc.equal(cls, c)).column(1)
                for _, buf, offs in tb.slices(rows):
                    part = np.unique(gram_keys(buf, offs, order), return_counts=True)
                    parts = held.setdefault(c, [])
                    parts.append(part)
                    while len(parts) > 1 and len(parts[-1][0]) * 2 >= len(parts[-2][0]):
                        parts.append(_merge(parts.pop(), parts.pop()))
        for c, parts in held.items():
            while len(parts) > 1:
                parts.append(_merge(parts.pop(), parts.pop()))
            keys, n = parts[0]
            for lo in range(0, len(keys), 50_000):
                k = keys[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(k)), pa.array(k.view(np.int64)), pa.array(n[lo:lo + 50_000])], ["class", "gram", "n"])

    rows = docs.where(F.col(class_col).isNotNull()).select(F.col(class_col).cast("string"), text_col)
    return rows.mapInArrow(counted, schema).groupBy("class", "gram").agg(F.sum("n").alias("n"))


def gather_ngrams(counts: DataFrame) -> dict[str, dict]:
    """Per class: all grams (uint64, ascending), n, total, and the number of n-grams counted 1, 2, 3, 4 times.

    ``counts`` is read once per class, so the driver holds one class's rows besides the result."""
    out = {}
    for c in sorted(r["class"] for r in counts.select("class").distinct().collect()):
        part = counts.where(F.col("class") == c).select("gram", "n").toArrow()
        g, n = part.column("gram").to_numpy().view(np.uint64), part.column("n").to_numpy()
        order = np.argsort(g, kind="stable")
        out[c] = {"grams": g[order], "n": n[order], "total": int(n.sum()), "shape": [int((n == k).sum()) for k in (1, 2, 3, 4)]}
    return out
