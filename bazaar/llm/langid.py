"""Language identification by prediction by partial matching (PPM).

Per language, a tree of byte contexts up to ``order - 1`` bytes with symbol counts, built from n-gram
counts over all training texts. Escape method C: in a context seen n times with q different
symbols, a symbol seen c times has probability c / (n + q), the escape to the next shorter context
q / (n + q); below the empty context every byte has 1 / 256. With the statistics frozen, the code
length of a byte depends on its context alone, so the trees are flattened: one row per n-gram known
in any language with its complete code length in every language, and one row per context with its escape
costs. A text's code length under each language is a sum of look-ups; the shortest wins, and the
score is its posterior under equal priors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import textbytes as tb
from bazaar.llm.ngrams import count_ngrams, gather_ngrams, gram_keys
from bazaar.llm.shared import Shipped, extended, materialise

ORDER = 5
UNKNOWN = "und"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _tag(key: np.ndarray, order: int) -> np.ndarray:
    return tb.mix(key | (np.uint64(order) << np.uint64(60)))


def _grouped(keys: np.ndarray, n: np.ndarray):
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, n, len(u))


class ContextTrees:
    """Flattened PPM statistics of several languages."""

    def __init__(self, stats: dict[str, dict], order: int = ORDER):
        self.order, self.langs = order, sorted(stats)
        ln = len(self.langs)
        mask = lambda o: np.uint64((1 << (8 * o)) - 1)
        # per language and order: symbol counts and, by context, n and q
        levels: list[list[tuple]] = []
        for o in range(1, order + 1):
            per = []
            for lang in self.langs:
                g, c = _grouped(stats[lang]["grams"] & mask(o), stats[lang]["n"].astype(np.float64))
                ctx, inv = np.unique(g >> np.uint64(8), return_inverse=True)
                n, q = np.bincount(inv, c, len(ctx)), np.bincount(inv, minlength=len(ctx)).astype(np.float64)
                per.append((g, -np.log2(c / (n[inv] + q[inv])), ctx, -np.log2(q / (n + q))))
            levels.append(per)
        self.bytes_cost = np.full((256, ln), 8.0)
        for k, (g, cost, _, esc) in enumerate(levels[0]):
            self.bytes_cost[:, k] += esc[0] if len(esc) else 0.0
            self.bytes_cost[g.astype(np.int64), k] = cost
        below_keys, below = np.arange(256, dtype=np.uint64), self.bytes_cost
        self.tables = {}
        for o in range(2, order + 1):
            per = levels[o - 1]
            grams = np.unique(np.concatenate([p[0] for p in per])) if ln else np.zeros(0, np.uint64)
            ctxs = np.unique(np.concatenate([p[2] for p in per])) if ln else np.zeros(0, np.uint64)
            escape = np.zeros((len(ctxs), ln))
            full = below[np.searchsorted(below_keys, grams & mask(o - 1))].copy() if len(grams) else np.zeros((0, ln))
            at = np.searchsorted(ctxs, grams >> np.uint64(8))
            for k, (g, cost, ctx, esc) in enumerate(per):
                escape[np.searchsorted(ctxs, ctx), k] = esc
                full[:, k] += escape[at, k]
                full[np.searchsorted(grams, g), k] = cost
            self.tables[o] = (*_sorted_rows(_tag(grams, o), full), *_sorted_rows(_tag(ctxs, o + 8), escape))
            below_keys, below = grams, full
        self.bytes_cost = self.bytes_cost.astype(np.float32)

    def code_lengths(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Bits of every text under every language: (texts, languages)."""
        ln = len(self.langs)
        key = gram_keys(buf, offs, self.order)
        cost = np.zeros((len(buf), ln), np.float32)
        todo = None  # positions still to be coded by a shorter context; at first all
        for o in range(self.order, 1, -1):
            k = key & np.uint64((1 << (8 * o)) - 1)
            grams, full, ctxs, escape = self.tables[o]
            at = grams.find(_tag(k, o))
            hit = at >= 0
            if todo is None:
                cost = full[np.maximum(at, 0)] if len(full) else cost
                cost[~hit] = 0
                todo = np.flatnonzero(~hit)
            else:
                cost[todo[hit]] += full[at[hit]]
                todo = todo[~hit]
            k = k[~hit]
            out = ctxs.find(_tag(k >> np.uint64(8), o + 8))
            seen = out >= 0
            cost[todo[seen]] += escape[out[seen]]
            key = key[~hit]
            if not len(todo):
                break
        if len(todo):
            cost[todo] += self.bytes_cost[(key & np.uint64(255)).astype(np.int64)]
        return np.stack([tb.segment_sum(cost[:, j], offs) for j in range(ln)], 1) if ln else np.zeros((len(offs) - 1, 0))


def _sorted_rows(keys: np.ndarray, rows: np.ndarray):
    order = np.argsort(keys, kind="stable")
    return tb.SortedHashes(keys[order]), np.ascontiguousarray(rows[order], np.float32)


def has_letter(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    ascii_letters = tb.segment_sum(_LETTER[buf], offs) > 0
    wide = tb.segment_sum(buf >= 0x80, offs) > 0
    for i in np.flatnonzero(wide & ~ascii_letters):
        ascii_letters[i] = any(ch.isalpha() for ch in bytes(buf[offs[i]:offs[i + 1]]).decode("utf-8", "replace"))
    return ascii_letters


def train(docs: DataFrame, lang_col: str = "lang", order: int = ORDER) -> ContextTrees:
    """Context trees from all n-grams of all rows with a language."""
    counts = materialise(count_ngrams(docs, lang_col, order), "ppm-counts")
    return ContextTrees(gather_ngrams(counts), order)


def identify(docs: DataFrame, trees: ContextTrees, text_col: str = "text") -> DataFrame:
    """Add lang_pred, score (posterior, 0 to 1) and bits_per_byte (double) to every row.

    Null text, text without a letter and a model without languages give ``und``, score 0 and null
    bits. Ties go to the first language in code point order. Columns of these names are replaced."""
    model = Shipped(docs.sparkSession, trees)
    added = [("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
    keep = [c for c in docs.columns if c not in [a for a, _ in added]]
    src = docs.select(*keep)
    at = keep.index(text_col)

    def run(batches):
        t = model.load()
        step = max(1 << 14, tb.SLICE_BYTES * 4 // max(4, len(t.langs)))
        for batch in batches:
            pred, score, bits = [], [], []
            for _, buf, offs in tb.slices(batch.column(at), step):
                total = t.code_lengths(buf, offs)
                ok = has_letter(buf, offs) & bool(t.langs)
                best = total.argmin(1) if t.langs else np.zeros(len(ok), int)
                least = total.min(1) if t.langs else np.zeros(len(ok))
                post = 1 / np.exp2(np.maximum(least[:, None] - total, -1000)).sum(1) if t.langs else np.zeros(len(ok))
                n = np.maximum(np.diff(offs), 1)
                pred += [t.langs[b] if o else UNKNOWN for b, o in zip(best, ok)]
                score.append(np.where(ok, post, 0.0))
                bits.append(np.where(ok, least / n, np.nan))
            cols = [pa.array(pred, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64()),
                    pa.array(np.concatenate(bits) if bits else [], pa.float64(), from_pandas=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *[a for a, _ in added]])

    return src.mapInArrow(run, extended(src, lang_pred="string", score="double", bits_per_byte="double"))
