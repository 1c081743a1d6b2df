"""Quality rules: text statistics and perplexity bands under a modified Kneser-Ney byte n-gram model.

The counts come from Spark over all texts, per language. The model interpolates orders ``order`` to 1
with the three discounts of modified Kneser-Ney; shorter orders use continuation counts (in how many
different left contexts an n-gram occurs). It is stored as sorted arrays of 64-bit hashes: per order
one array with the log probability of every known n-gram and one with the back-off weight of every
known context. Perplexity is per byte. A document is rejected if its log perplexity lies outside its
language's band, ``spread`` interquartile ranges beyond the quartiles of all documents of that language
that pass the base rules.
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
SPREAD = 2.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
UNKNOWN = "und"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_NOT_CONTINUATION = np.ones(256, bool)
_NOT_CONTINUATION[0x80:0xC0] = False


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams counted once to four times."""
    if not (n1 and n2):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(float(np.clip(x, 0.1, k)) for k, x in enumerate(d, 1))


def _key(grams, lang: int, order: int, context: bool) -> np.ndarray:
    """A bijective hash of (n-gram or context, language, order)."""
    return tb.mix(grams | np.uint64(lang << 42 | order << 59 | int(context) << 62))


class KneserNey:
    """Modified Kneser-Ney models of several languages in common sorted hash arrays."""

    def __init__(self, stats: dict[str, dict], order: int = ORDER):
        self.order, self.langs = order, {c: k for k, c in enumerate(sorted(stats))}
        keys: dict[tuple, list] = {}
        vals: dict[tuple, list] = {}
        self.byte_logp = np.full((len(stats) + 1, 256), -np.log(256.0))
        for lang, k in self.langs.items():
            g, c = stats[lang]["grams"], stats[lang]["n"].astype(np.float64)
            levels = [None] * (order + 1)
            levels[order] = (g, c, discounts(*stats[lang]["shape"]))
            for o in range(order - 1, 0, -1):  # continuation counts: distinct n-grams one longer
                g, c = np.unique(g & np.uint64((1 << (8 * o)) - 1), return_counts=True)
                levels[o] = (g, c.astype(np.float64), discounts(*[(c == j).sum() for j in (1, 2, 3, 4)]))
            below_keys, below = np.arange(256, dtype=np.uint64), np.full(256, 1 / 256)
            for o in range(1, order + 1):
                g, c, d = levels[o]
                cut = np.array(d)[np.minimum(c, 3).astype(int) - 1]
                ctx, inv = np.unique(g >> np.uint64(8), return_inverse=True)
                total = np.bincount(inv, c, len(ctx))
                back = np.bincount(inv, cut, len(ctx)) / total
                lower = below[np.searchsorted(below_keys, g & np.uint64((1 << (8 * (o - 1))) - 1))] if o > 1 else below[g.astype(int)]
                p = (c - cut) / total[inv] + back[inv] * lower
                if o == 1:
                    p_all = np.full(256, back[0] / 256 if len(back) else 1 / 256)
                    p_all[g.astype(int)] = p
                    self.byte_logp[k] = np.log(p_all)
                    below_keys, below = np.arange(256, dtype=np.uint64), p_all
                else:
                    for name, ks, vs in (("gram", _key(g, k, o, False), np.log(p)), ("back", _key(ctx, k, o, True), np.log(back))):
                        keys.setdefault((name, o), []).append(ks)
                        vals.setdefault((name, o), []).append(vs)
                    below_keys, below = g, p
        self.tables = {}
        for at in keys:
            ks, vs = np.concatenate(keys[at]), np.concatenate(vals[at])
            by = np.argsort(ks, kind="stable")
            self.tables[at] = (tb.SortedHashes(ks[by]), vs[by].astype(np.float32))

    def log_probability(self, buf: np.ndarray, offs: np.ndarray, langs: np.ndarray) -> np.ndarray:
        """Natural log probability of every text; ``langs`` has each text's language number (-1: none, uniform bytes)."""
        key = gram_keys(buf, offs, self.order)
        lang = np.repeat(langs, np.diff(offs)).astype(np.int64)
        tag = (np.maximum(lang, 0).astype(np.uint64) << np.uint64(42))
        logp = np.zeros(len(buf))
        todo = np.arange(len(buf))
        for o in range(self.order, 1, -1):
            if ("gram", o) not in self.tables:
                continue
            for name in ("gram", "back"):
                k = key[todo] & np.uint64((1 << (8 * o)) - 1)
                if name == "back":
                    k >>= np.uint64(8)
                hashes, values = self.tables[name, o]
                at = hashes.find(tb.mix(k | tag[todo] | np.uint64(o << 59 | (name == "back") << 62)))
                hit = at >= 0
                logp[todo[hit]] += values[at[hit]]
                if name == "gram":
                    todo = todo[~hit]
        logp[todo] += self.byte_logp[lang[todo], buf[todo]]
        return tb.segment_sum(logp, offs)


def _repeats(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items (document, hash) in order: which occur twice or more in their document, which are not the first there."""
    key = tb.mix(h ^ tb.mix(doc.astype(np.uint64) + np.uint64(1)))
    _, first, inv, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return n[inv] > 1, first[inv] != np.arange(len(key))


def text_statistics(buf: np.ndarray, offs: np.ndarray, pw: tb.Powers) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text."""
    nd = len(offs) - 1
    starts, ends, woffs = tb.words(buf, offs, tb.SPACE_WORD)
    in_word = tb.SPACE_WORD[buf]
    h = tb.prefix_hash(buf, pw)
    wh = tb.span_hash(h, starts, ends, pw)
    wdoc = np.repeat(np.arange(nd), np.diff(woffs))
    # 3-word windows inside one document
    win = tb.combine(wh, 3)
    inside = np.flatnonzero(wdoc[:len(win)] == wdoc[2:]) if len(win) else np.zeros(0, np.int64)
    twice, _ = _repeats(wdoc[inside], win[inside])
    cover = np.zeros(len(wh) + 1, np.int64)
    at = inside[twice]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + 3, -1)
    # lines: between line feeds and text ends; only lines with a word count
    lf = np.flatnonzero(buf == 10)
    ls = np.unique(np.concatenate([offs[:-1], lf + 1]))
    ls = ls[ls < len(buf)] if len(buf) else ls[:0]
    stop = np.searchsorted(lf, ls)
    next_lf = np.append(lf, len(buf))[stop]
    ldoc = np.searchsorted(offs, ls, "right") - 1
    le = np.minimum(next_lf, offs[ldoc + 1]) if len(ls) else ls
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, ldoc = ls[has_word], le[has_word], ldoc[has_word]
    _, later = _repeats(ldoc, tb.span_hash(h, ls, le, pw))
    return {"n_words": np.diff(woffs), "word_chars": tb.segment_sum(in_word & _NOT_CONTINUATION[buf], offs), "n_symbols": tb.segment_sum(_SYMBOL[buf], offs),
            "n_dup_lines": np.bincount(ldoc[later], minlength=nd), "n_repeat_words": tb.segment_sum(np.cumsum(cover)[:-1] > 0, woffs)}


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def train(docs: DataFrame, lang_col: str = "lang", order: int = ORDER) -> KneserNey:
    """Models from all n-grams of all rows; rows without a language form the class ``und``."""
    labelled = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("_class"), "text")
    counts = materialise(count_ngrams(labelled, "_class", order), "kn-counts")
    return KneserNey(gather_ngrams(counts), order)


def score_quality(docs: DataFrame, model: KneserNey, lang_col: str = "lang", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, the language, the statistics, base_failed and log_ppl (per byte; null without bytes)."""
    shared = Shipped(docs.sparkSession, model)
    src = docs.select(*carry, F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("_lang"), F.col("text").alias("_text"))

    def run(batches):
        m, pw = shared.load(), tb.Powers()
        for batch in batches:
            lang = np.array([m.langs.get(x, -1) for x in batch.column(len(carry)).to_pylist()], np.int64)
            cols = {k: [] for k in (*STATS, "log_ppl")}
            for lo, buf, offs in tb.slices(batch.column(len(carry) + 1)):
                for k, v in text_statistics(buf, offs, pw).items():
                    cols[k].append(v)
                n = np.diff(offs)
                lp = m.log_probability(buf, offs, lang[lo:lo + len(n)])
                cols["log_ppl"].append(np.where(n > 0, -lp / np.maximum(n, 1), np.nan))
            arrays = [pa.array(np.concatenate(cols[k]).astype(np.int64) if cols[k] else [], pa.int64()) for k in STATS]
            arrays.append(pa.array(np.concatenate(cols["log_ppl"]) if cols["log_ppl"] else [], pa.float64(), from_pandas=True))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carry) + 1], *arrays], [*batch.schema.names[:len(carry) + 1], *STATS, "log_ppl"])

    out = src.mapInArrow(run, extended(src.drop("_text"), **dict.fromkeys(STATS, "long"), log_ppl="double"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def perplexity_bands(scored: DataFrame, spread: float = SPREAD) -> DataFrame:
    """_lang, low, high: bounds of log perplexity from the quartiles of documents that pass the base rules."""
    q = F.percentile_approx("log_ppl", [0.25, 0.75], 10_000)
    return (scored.where(~F.col("base_failed") & F.col("log_ppl").isNotNull()).groupBy("_lang").agg(q.alias("q"))
            .select("_lang", (F.col("q")[0] - spread * (F.col("q")[1] - F.col("q")[0])).alias("low"), (F.col("q")[1] + spread * (F.col("q")[1] - F.col("q")[0])).alias("high")))


def quality_filter(docs: DataFrame, spread: float = SPREAD, model: KneserNey | None = None, lang_col: str = "lang", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``carry``, the statistics, base_failed, log_ppl and kept.

    Null text counts as empty: no words, base_failed. Null languages form a class of their own. Repeated rows are
    judged alike. An empty table gives an empty table. Other columns are not read."""
    scored = materialise(score_quality(docs, model or train(docs, lang_col), lang_col, carry), "kn-scores")
    # a few rows, written: their size is known, so the planner can send them to the scores; a join on the language alone
    # would put all documents of the largest language into one task
    bands = materialise(perplexity_bands(scored, spread), "kn-bands")
    return (scored.join(bands, "_lang", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(False)))
            .select(*carry, *STATS, "base_failed", "kept", "log_ppl", "low", "high"))
