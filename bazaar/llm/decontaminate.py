"""Benchmark decontamination by winnowing.

A window is ``span`` (10) consecutive words of an item; an item with fewer words is one window. For a window
of n words, k-grams of k = (n + 1) // 2 words are hashed and in every n - k + 1 consecutive k-grams the
smallest hash is kept as a fingerprint. Equal windows keep equal fingerprints, so every shared window
shows up as a shared fingerprint. Fingerprints of documents and items are joined; a hit names an item for a
text. Then the hits are extended in the whole text, word by word to both sides, and every common run that
holds a whole window counts.

Documents and items of any number: the join of fingerprints is planned by Spark, which broadcasts the items'
side only when its size on disk is under spark.sql.autoBroadcastJoinThreshold and shuffles otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import textbytes as tb
from bazaar.llm.shared import extended, free_names, materialise, set_aside

SPAN = 10


def gram_size(n: int) -> int:
    """Words of a k-gram for windows of n words."""
    return (n + 1) // 2


def winnow(wh: np.ndarray, wdoc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams that are the minimum of some window of n words inside one document."""
    k = gram_size(n)
    if len(wh) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = tb.combine(wh, k) ^ np.uint64(n * 0x9E37)
    nw, width = len(wh) - n + 1, n - k + 1
    least = h[:nw].copy()
    for j in range(1, width):
        np.minimum(least, h[j:j + nw], out=least)
    least[wdoc[:nw] != wdoc[n - 1:]] = 0
    top = np.zeros(len(h), np.uint64)
    for j in range(width):
        np.maximum(top[j:j + nw], least, out=top[j:j + nw])
    at = np.flatnonzero((top == h) & (top > 0))
    return at, h[at]


def hashed_words(buf: np.ndarray, offs: np.ndarray, pw: tb.Powers):
    """Lower-cased bytes, word starts and ends, word offsets per document, word hashes and each word's document."""
    low = tb.LOWER[buf]
    starts, ends, woffs = tb.words(low, offs, tb.ALNUM_WORD)
    wh = tb.span_hash(tb.prefix_hash(low, pw), starts, ends, pw)
    return low, starts, ends, woffs, wh, np.repeat(np.arange(len(offs) - 1), np.diff(woffs))


def _fingerprints(table: DataFrame, key: str, text: str, lengths: list[int] | None, span: int) -> DataFrame:
    """(fp, key) of every row. ``lengths``: the window lengths to use; None: each text's own (items)."""

    def run(batches):
        pw = tb.Powers()
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, buf, offs in tb.slices(batch.column(1)):
                _, _, _, woffs, wh, wdoc = hashed_words(buf, offs, pw)
                n_words = np.diff(woffs)
                for n in lengths if lengths is not None else range(1, span + 1):
                    at, fp = winnow(wh, wdoc, n)
                    doc = wdoc[at]
                    if lengths is None:
                        own = np.minimum(n_words[doc], span) == n
                        doc, fp = doc[own], fp[own]
                    for i in range(0, len(fp), 1 << 16):
                        yield pa.RecordBatch.from_arrays([pa.array(fp[i:i + (1 << 16)].view(np.int64)), pa.array(keys[lo + doc[i:i + (1 << 16)]].astype(np.int64))], ["fp", key])

    return table.select(key, text).mapInArrow(run, f"fp long, {key} long")


def _word_lists(table: DataFrame, span: int) -> list[int]:
    """The window lengths that the items have (at most ``span`` numbers)."""
    def run(batches):
        pw = tb.Powers()
        found: set[int] = set()
        for batch in batches:
            for _, buf, offs in tb.slices(batch.column(0)):
                found |= set(np.minimum(np.diff(hashed_words(buf, offs, pw)[3]), span).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], ["n"])
    return sorted(r["n"] for r in table.select("_item_text").mapInArrow(run, "n long").distinct().collect() if r["n"])


def common_runs(dh: np.ndarray, ih: np.ndarray, span: int = SPAN) -> list[tuple[int, int, int]]:
    """Maximal runs (start in document, start in item, length) that hold a window of the item.

    dh and ih are word hashes; runs are found from shared fingerprints and extended to both sides."""
    n = min(len(ih), span)
    if not n or len(dh) < n:
        return []
    k = gram_size(n)
    at_d, fd = winnow(dh, np.zeros(len(dh), np.int64), n)
    at_i, fi = winnow(ih, np.zeros(len(ih), np.int64), n)
    where: dict[int, list[int]] = {}
    for q, f in zip(at_i.tolist(), fi.tolist()):
        where.setdefault(f, []).append(q)
    hit = np.flatnonzero(np.isin(fd, fi))
    d, t = dh.tolist(), ih.tolist()
    done: dict[int, int] = {}  # per diagonal, where the last run ended
    out = []
    for p, f in zip(at_d[hit].tolist(), fd[hit].tolist()):
        for q in where[f]:
            if p < done.get(p - q, -1) or d[p:p + k] != t[q:q + k]:
                continue
            a, b = p, p + k
            while a > 0 and a - p + q > 0 and d[a - 1] == t[a - 1 - p + q]:
                a -= 1
            while b < len(d) and b - p + q < len(t) and d[b] == t[b - p + q]:
                b += 1
            done[p - q] = b
            if b - a >= n:
                out.append((a, a - p + q, b - a))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, text_col: str = "text") -> DataFrame:
    """Add n_words, n_hit (words inside any occurrence of a window), item_ids (strings, sorted) and spans
    (struct(first, last): word ranges that are hit, in order) to every document.

    docs: any columns with ``text_col``; benchmark: item_id, text. Null texts have no words; items without
    words match nothing; a null item_id counts as the empty string; equal items count once; repeated
    documents give repeated results. Columns named like the added ones are replaced. Without documents or
    items the result has no rows or no hits."""
    added = ("n_words", "n_hit", "item_ids", "spans")
    docs = docs.drop(*added)
    key, listed_items = free_names(docs.columns, "_text_key", "_items")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("_item_id"), F.col("text").alias("_item_text")).where("_item_text IS NOT NULL").distinct()
    items = items.withColumn("_item", F.xxhash64("_item_id", "_item_text"))
    lengths = _word_lists(items, span)
    item_prints = materialise(_fingerprints(items, "_item", "_item_text", None, span), "winnow-items")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    prints = _fingerprints(keyed.select(F.col(key).alias("_text_key"), text_col), "_text_key", text_col, lengths, span)
    hits = prints.join(item_prints, "fp").select("_text_key", "_item").distinct()
    # per text: the items to look for, each with its text; as many as share a fingerprint with the text
    named = materialise(hits.join(items, "_item").groupBy("_text_key").agg(F.collect_list(F.struct("_item_id", "_item_text")).alias("_items")), "winnow-hits")
    named = named.select(F.col("_text_key").alias(key), F.col("_items").alias(listed_items))
    src = keyed.join(named, key, "left").select(*docs.columns, listed_items)
    at = docs.columns.index(text_col)

    def run(batches):
        pw = tb.Powers()
        for batch in batches:
            listed = batch.column(len(docs_columns))
            some = listed.is_valid().to_numpy(zero_copy_only=False)
            n_words, n_hit, ids, spans = [], [], [], []
            for lo, buf, offs in tb.slices(batch.column(at)):
                low, starts, ends, woffs, wh, _ = hashed_words(buf, offs, pw)
                for i in range(len(offs) - 1):
                    w0, w1 = woffs[i], woffs[i + 1]
                    n_words.append(int(w1 - w0))
                    if not some[lo + i]:
                        n_hit.append(0), ids.append([]), spans.append([])
                        continue
                    hit, found = np.zeros(w1 - w0 + 2, bool), set()
                    for item in listed[lo + i].as_py():
                        raw = np.frombuffer(item["_item_text"].encode(), np.uint8)
                        il, istart, iend, _, ih, _ = hashed_words(raw, np.array([0, len(raw)]), pw)
                        for a, b, n in common_runs(wh[w0:w1], ih, span):
                            mine = [low[s:e].tobytes() for s, e in zip(starts[w0 + a:w0 + a + n], ends[w0 + a:w0 + a + n])]
                            if mine == [il[s:e].tobytes() for s, e in zip(istart[b:b + n], iend[b:b + n])]:
                                hit[a + 1:a + n + 1] = True
                                found.add(item["_item_id"])
                    edge = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
                    n_hit.append(int(hit.sum())), ids.append(sorted(found))
                    spans.append([{"first": int(a), "last": int(b) - 1} for a, b in edge])
            cols = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(ids, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(docs_columns)], *cols], [*batch.schema.names[:len(docs_columns)], *added])

    docs_columns = docs.columns
    return src.mapInArrow(run, extended(docs, n_words="long", n_hit="long", item_ids="array<string>", spans="array<struct<first:long,last:long>>"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The documents without a window of the benchmark, with their own columns."""
    safe, restore = set_aside(docs, ("text",))
    return restore(find_contamination(safe, benchmark, span).where("n_hit = 0").select(*safe.columns))
