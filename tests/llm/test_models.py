"""Language identification, perplexity rules, toxicity and the attention model."""
import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from bazaar.llm import langid, lm, ngrams, perplexity, toxicity
from bazaar.llm import textbytes as tb
from bazaar.llm.shared import id_remainder, read_table
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.conftest import DOCS, SPACE_WORDS, corpus, lower_ascii, prose

SF_LARGE = "/root/testdata/sf0.1"


def slice_of(texts):
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    return buf, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])


# --- n-grams ---

def naive_grams(t: bytes, order):
    return [int.from_bytes((b"\0" * order + t)[i + 1:i + 1 + order], "big") for i in range(len(t))]


def test_gram_keys_do_not_cross_texts():
    texts = ["abc", "", "é", "xyzabc", "q"]
    buf, offs = slice_of(texts)
    want = [g for t in texts for g in naive_grams(t.encode(), 4)]
    assert ngrams.gram_keys(buf, offs, 4).tolist() == want


def test_counts_cover_whole_texts(spark, docs):
    got = {(r["class"], r["gram"]): r["n"] for r in ngrams.count_ngrams(docs, "lang", 3).collect()}
    want = collections.Counter((lang, g) for _, t, lang, *_ in corpus() if lang for g in naive_grams((t or "").encode(), 3))
    assert got == dict(want)


def test_models_hold_rare_ngrams_of_large_classes(spark):
    """However large the class, an n-gram that occurs once is in the model, and counts add up to the bytes."""
    rows = [("en", 1, 9_000_000), ("en", 2, 1), ("en", 3, 2), ("en", (1 << 40) - 1, 1), ("de", 2, 5)]
    got = ngrams.gather_ngrams(spark.createDataFrame(rows, "class string, gram long, n long").repartition(3))
    assert got["en"]["grams"].tolist() == [1, 2, 3, (1 << 40) - 1] and got["en"]["n"].tolist() == [9_000_000, 1, 2, 1]
    assert got["en"]["total"] == 9_000_004 and got["en"]["shape"] == [2, 1, 0, 0] and got["de"]["n"].tolist() == [5]


# --- prediction by partial matching ---

class SlowTrees:
    """PPM with escape method C, one symbol at a time."""

    def __init__(self, texts, order):
        self.order, self.ctx = order, collections.defaultdict(collections.Counter)
        for t in texts:
            p = b"\0" * order + t
            for i in range(len(t)):
                for o in range(order):
                    self.ctx[p[i + order - o:i + order]][p[i + order]] += 1

    def bits(self, t):
        p, total = b"\0" * self.order + t, 0.0
        for i in range(len(t)):
            for o in range(self.order - 1, -1, -1):
                c = self.ctx.get(p[i + self.order - o:i + self.order])
                if c is None:
                    continue
                n = sum(c.values()) + len(c)
                if p[i + self.order] in c:
                    total -= math.log2(c[p[i + self.order]] / n)
                    break
                total -= math.log2(len(c) / n)
            else:
                total += 8
        return total


def test_code_lengths_match_a_plain_tree():
    rng = random.Random(2)
    train = {"x": [prose(rng, 60).encode() for _ in range(3)], "y": ["ÄÖ äö ßß über das".encode() * 3]}
    stats = {}
    for lang, texts in train.items():
        c = collections.Counter(g for t in texts for g in naive_grams(t, 4))
        g = np.array(sorted(c), np.uint64)
        stats[lang] = {"grams": g, "n": np.array([c[int(k)] for k in g])}
    trees = langid.ContextTrees(stats, 4)
    texts = [prose(rng, 20), "", "über", "zzz 999", "the\x00end"]
    got = trees.code_lengths(*slice_of(texts))
    slow = {k: SlowTrees(v, 4) for k, v in train.items()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx([slow["x"].bits(t.encode()), slow["y"].bits(t.encode())], rel=1e-5, abs=1e-4)


def test_language_of_held_out_documents(spark):
    d = read_table(spark, SF_MID, "documents").withColumn("held", id_remainder(5) == 0)
    out = langid.identify(d, langid.train(d.where("NOT held"))).where("held").select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.98 * len(out) and all(0 <= r["score"] <= 1 for r in out)


def test_language_of_odd_rows(spark, docs, no_docs):
    trees = langid.train(docs)
    extra = docs.selectExpr("*", "'x' AS lang_pred", "1 AS held_out")
    got = langid.identify(extra, trees)
    assert got.columns == [*docs.columns, "held_out", "lang_pred", "score", "bits_per_byte"]
    rows = {r["doc_id"]: r for r in got.collect()}
    for k in (200, 201, 202, 208):
        assert rows[k]["lang_pred"] == "und" and rows[k]["score"] == 0
    assert rows[203]["lang_pred"] == "de" and rows[204]["score"] == rows[205]["score"]
    assert langid.identify(no_docs, trees).count() == 0
    none = langid.train(no_docs)
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}


# --- perplexity ---

def test_kneser_ney_is_a_distribution_and_matches_a_plain_one():
    rng = random.Random(7)
    texts = [prose(rng, 80).encode() for _ in range(4)]
    c = collections.Counter(g for t in texts for g in naive_grams(t, 3))
    g = np.array(sorted(c), np.uint64)
    n = np.array([c[int(k)] for k in g])
    shape = [int((n == k).sum()) for k in (1, 2, 3, 4)]
    model = perplexity.KneserNey({"x": {"grams": g, "n": n, "shape": shape}}, 3)

    # the same by definition, in dictionaries
    levels = {3: {k.to_bytes(3, "big"): v for k, v in c.items()}}
    for o in (2, 1):
        levels[o] = collections.Counter(k[1:] for k in levels[o + 1])

    def disc(o):
        return perplexity.discounts(*(shape if o == 3 else [sum(v == k for v in levels[o].values()) for k in (1, 2, 3, 4)]))

    d = {o: disc(o) for o in levels}
    cut = lambda o, v: d[o][min(v, 3) - 1]

    def p(o, ctx, sym):
        if o == 0:
            return 1 / 256
        inside = {k: v for k, v in levels[o].items() if k[:-1] == ctx}
        if not inside:
            return p(o - 1, ctx[1:], sym)
        total, v = sum(inside.values()), inside.get(ctx + bytes([sym]), 0)
        return (v - cut(o, v) if v else 0) / total + sum(cut(o, x) for x in inside.values()) / total * p(o - 1, ctx[1:], sym)

    for ctx in (b"th", b"zz", b"\0\0", b"e "):
        assert sum(p(3, ctx, s) for s in range(256)) == pytest.approx(1)
    probe = [prose(rng, 12), "zz9 \xff", ""]
    got = model.log_probability(*slice_of(probe), np.zeros(3, int))
    for t, lp in zip(probe, got):
        b = b"\0\0" + t.encode()
        assert lp == pytest.approx(sum(math.log(p(3, b[i:i + 2], b[i + 2])) for i in range(len(t.encode()))), rel=1e-5)


def slow_statistics(t):
    t = t or ""
    w = SPACE_WORDS.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if SPACE_WORDS.search(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), dup, len(hit)


def test_text_statistics_match_brute_force():
    texts = [t or "" for _, t, *_ in corpus()] + ["a b c a b c\nx\n\nx\n y #|<>\n", "\n\n", "x\n", "one\ttwo\x0bthree four", "l\r\nl\r\n"]
    got = perplexity.text_statistics(*slice_of(texts), tb.Powers())
    for i, t in enumerate(texts):
        assert tuple(int(got[k][i]) for k in perplexity.STATS) == slow_statistics(t), t


def test_quality_keeps_clean_and_drops_junk(spark, no_docs):
    rng = random.Random(5)
    rows = [(i, prose(rng, 150), "en", "a", 1) for i in range(120)] + [(500 + i, "".join(rng.choice("0123456789#%qxzj ") for _ in range(900)) + " a" * 60, "en", "a", 1) for i in range(4)]
    rows += [(600, None, "en", "a", None), (601, "", None, "a", 0), (602, "for " * 300, "en", "a", 1), (603, prose(rng, 49), "en", "a", 1), (None, prose(rng, 150), "en", "a", 1)]
    out = {r["doc_id"]: r for r in perplexity.quality_filter(spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS kept", "2 AS n_words")).collect()}
    assert sum(out[i]["kept"] for i in range(120)) >= 115 and not any(out[i]["kept"] for i in range(500, 504))
    assert all(out[i]["base_failed"] and not out[i]["kept"] for i in (600, 601, 602, 603)) and out[None]["n_words"] == 150
    assert perplexity.quality_filter(no_docs).count() == 0


# --- toxicity ---

def fitted(texts, y):
    slot, doc = toxicity.distinct_slots(*toxicity.hashed_terms(*slice_of(texts), tb.Powers()))
    return toxicity.FactorizationMachine().fit(slot, np.searchsorted(doc, np.arange(len(texts) + 1)), y)


def slots_of(text):
    return toxicity.distinct_slots(*toxicity.hashed_terms(*slice_of([text]), tb.Powers()))[0].tolist()


def test_pairs_count_where_single_words_do_not():
    """Insult with group is toxic, either alone is not: no additive score separates these."""
    rng = random.Random(9)
    texts, y = [], []
    for _ in range(1500):
        w = prose(rng, 25).split()
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w += ["insultword"] * a + ["groupword"] * b
        rng.shuffle(w)
        texts.append(" ".join(w)), y.append(float(a and b))
    pw = tb.Powers()
    buf, offs = slice_of(texts)
    model = fitted(texts, np.array(y))
    pw = tb.Powers()
    probe = ["river insultword stone", "river groupword stone", "groupword light insultword river", "river stone", "", "INSULTWORD groupword"]
    s = model.score(*toxicity.hashed_terms(*slice_of(probe), pw), len(probe))
    assert s[2] > 0.3 and s[5] > 0.3 and max(s[0], s[1], s[3], s[4]) < 0.3 and s.shape == (6,)


def test_a_group_word_at_base_rate_is_learnt_with_its_insult():
    """The group word is as common in clean as in toxic texts; what it does depends on its company."""
    rng = random.Random(4)
    texts, y, group = [], [], []
    for _ in range(4000):
        a, o, g = rng.random() < 0.1, rng.random() < 0.1, rng.random() < 0.5
        w = prose(rng, 25).split() + ["insultword"] * a + ["otherword"] * o + ["groupword"] * g
        rng.shuffle(w)
        texts.append(" ".join(w)), y.append(float(a and g or o and not g)), group.append(g)
    y, group = np.array(y), np.array(group)
    n, rate = group.sum(), y.mean()
    assert abs(y[group].sum() - n * rate) / (n * rate * (1 - rate)) ** 0.5 < 2.5
    model = fitted(texts, y)
    probe = ["river insultword stone", "river insultword stone groupword", "river otherword stone", "otherword groupword river", "groupword river", "river"]
    s = model.score(*toxicity.hashed_terms(*slice_of(probe), tb.Powers()), len(probe))
    assert min(s[1], s[2]) > 0.7 and max(s[0], s[3], s[4], s[5]) < 0.3


def test_score_is_the_plain_sum_over_terms_and_pairs():
    rng = random.Random(7)
    texts = [prose(rng, 12) + (" vileword" if i % 3 == 0 else "") for i in range(600)]
    model = fitted(texts, np.array([float(i % 3 == 0) for i in range(600)]))
    probe = texts[:20] + ["", "vileword vileword", "unseen"]
    got = model.score(*toxicity.hashed_terms(*slice_of(probe), tb.Powers()), len(probe))
    for text, p in zip(probe, got):
        rows = [model.weights[model.place[s]].astype(float) for s in slots_of(text) if model.place[s] >= 0]
        z = model.w0 + sum(r[0] for r in rows) + sum(float(rows[i][1:] @ rows[j][1:]) for i in range(len(rows)) for j in range(i))
        assert p == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_toxicity_of_held_out_documents(spark, docs, no_docs):
    d, labels = read_table(spark, SF_LARGE, "documents").select("doc_id", "text"), read_table(spark, SF_LARGE, "labels")
    model = toxicity.train(d, labels.where(id_remainder(4) != 2))
    got = toxicity.score_toxicity(d, model).where(id_remainder(4) == 2).join(labels, "doc_id").toPandas()
    pos, neg = got[got.toxic == 1].toxicity, got[got.toxic == 0].toxicity
    assert np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos]) > 0.9
    odd = toxicity.score_toxicity(docs.selectExpr("*", "1 AS toxicity"), model)
    assert odd.count() == docs.count() and all(0 <= r["toxicity"] <= 1 for r in odd.collect())
    assert toxicity.score_toxicity(no_docs, toxicity.train(no_docs, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


# --- the attention model ---

def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in lm.initial_weights().items()}
    x, y, mask = rng.integers(0, 50, (3, lm.WINDOW)), rng.integers(0, lm.GROUPS * lm.MEMBERS, (3, lm.WINDOW)), rng.random((3, lm.WINDOW)) < 0.7
    _, g = lm.gradients(w, x, y, mask)
    for k in lm.NAMES:
        at = tuple(int(i) for i in np.unravel_index(int(np.abs(g[k]).argmax()), g[k].shape))
        old = w[k][at]
        w[k][at] = old + 1e-5
        up = lm.gradients(w, x, y, mask)[0]
        w[k][at] = old - 1e-5
        down = lm.gradients(w, x, y, mask)[0]
        w[k][at] = old
        assert (up - down) / 2e-5 == pytest.approx(g[k][at], rel=1e-4, abs=1e-9), k


def test_windows_score_every_place_once():
    lengths = np.array([0, 1, 31, 32, 33, 56, 57, 200, 1])
    seen = collections.Counter()
    for s, f, c in zip(*lm.windows(lengths)):
        assert 0 < c and f + c <= lm.WINDOW
        seen.update(range(s + f, s + f + c))
    assert seen == {i: 1 for i in range(lengths.sum())}


def test_scores_depend_on_the_past_alone_and_classes_are_a_distribution():
    rng = np.random.default_rng(3)
    cls, w = lm.Classes(rng.integers(0, 50, 2000).astype(float)), lm.initial_weights()
    ids = rng.integers(0, 2000, 90).astype(np.int32)
    full = lm.sequence_log_probability(w, cls, ids, np.array([90]))
    assert lm.sequence_log_probability(w, cls, ids[:50], np.array([50])) == pytest.approx(full[:50], rel=1e-4)
    two = lm.sequence_log_probability(w, cls, np.concatenate([ids[:7], ids]), np.array([7, 0, 90]))
    assert two[7:] == pytest.approx(full, rel=1e-4)
    # all ids after one context sum to one
    probe = np.array([i for t in range(2000) for i in (5, 6, t)], np.int32)
    lp = lm.sequence_log_probability(w, cls, probe, np.full(2000, 3)).reshape(-1, 3)[:, 2]
    assert np.exp(lp).sum() == pytest.approx(1, rel=1e-3)


def test_subwords_spell_the_words():
    ranks = lm.load_vocabulary()
    back = {v: k for k, v in ranks.items()}
    sub = lm.Subwords(ranks)
    words = ["the", "thhablean", "ñoño,", "a b", "漢字", "x" * 300, "!!", "<|endoftext|>"]
    ids, offs = sub.encode([w.encode() for w in words])
    assert [b"".join(back[i] for i in ids[a:b]).decode() for a, b in zip(offs, offs[1:])] == [" " + w for w in words]


def brute_base(rows, held):
    tokens = [SPACE_WORDS.findall(lower_ascii(t or "")) + [None] for _, t, *_ in rows]
    c = collections.Counter(x for r, ts in zip(rows, tokens) if not held(r) for x in ts)
    n, v = sum(c.values()), len(c)
    return sorted(((r[0], held(r), len(ts), sum(c[x] > 0 for x in ts), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in ts), 6)) for r, ts in zip(rows, tokens)), key=repr)


@pytest.mark.parametrize("batch_bytes", [1 << 23, 3000])
def test_word_model_matches_brute_force(spark, docs, batch_bytes):
    held = lambda r: zlib.crc32(str(r[0]).encode() if r[0] is not None else b"") % 7 == 2
    out = lm.score_texts(docs.withColumn("train", id_remainder(7) != 2), "train", batch_bytes=batch_bytes).collect()
    got = sorted(((r["doc_id"], not r["train"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in brute_base(corpus(), held)]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in brute_base(corpus(), held)], abs=1e-5)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)


def test_subword_counts_cover_all_training_texts(spark):
    """Also those outside of the sample, and each text's end."""
    rows = [(i, f"alpha beta gamma{i}" if i % 3 else None, i % 5 != 0) for i in range(60)]
    ranks = lm.load_vocabulary()
    end_id, shared, sub = max(ranks.values()) + 1, lm.Shipped(spark, ranks), lm.Subwords(ranks)
    keyed = spark.createDataFrame(rows, "doc long, text string, train boolean").selectExpr("CAST(doc % 4 AS int) AS batch", "doc", "train", "text")
    sent = keyed.groupBy("batch").applyInArrow(lm._send_words(2, shared, end_id), "part int, batch int, words binary, counts binary")
    got = lm._all_ids(sent.groupBy("part").applyInArrow(lm._add_words, "batch int, part int, known long, totals binary, size int"), end_id)
    want = np.zeros(end_id + 1)
    for _, t, train in rows:
        if train:
            np.add.at(want, sub.encode([w.encode() for w in (t or "").split()])[0], 1)
            want[end_id] += 1
    assert got.tolist() == want.tolist()


def test_every_training_text_reaches_the_weights(spark):
    """Words in reverse leave all counts as they are, so only the weights can tell; any text's order has to change them."""
    rng = random.Random(5)
    rows = [(i, prose(rng, 60), i % 8 != 0) for i in range(40)]

    def held_out(turned):
        d = [(i, " ".join(t.split()[::-1]) if i == turned else t, train) for i, t, train in rows]
        out = lm.score_texts(spark.createDataFrame(d, "doc_id long, text string, train boolean").coalesce(1), "train")
        return sorted((r["doc_id"], r["base_score"], r["score"]) for r in out.where("NOT train").collect())

    plain = held_out(None)
    assert held_out(None) == plain
    for turned in (1, 13, 39):
        got = held_out(turned)
        assert [g[:2] for g in got] == [p[:2] for p in plain] and all(g[2] != p[2] for g, p in zip(got, plain)), turned


def test_shards_are_averaged_by_their_ids():
    parts = [(1.0, np.array([0, 4], np.float32).tobytes()), (3.0, np.array([4, 0], np.float32).tobytes())]
    batch = pa.RecordBatch.from_arrays([pa.array(["pos", "pos"]), pa.array([n for n, _ in parts]), pa.array([v for _, v in parts], pa.binary())], ["name", "weight", "value"])
    here, = lm._average_here([batch.slice(0, 1), batch.slice(1)])
    assert here.column("weight").to_pylist() == [4.0]
    assert np.frombuffer(here.column("value")[0].as_py(), np.float32).tolist() == [3, 1]
    assert np.frombuffer(lm._average(pa.Table.from_batches([batch])).column("value")[0].as_py(), np.float32).tolist() == [3, 1]


def test_attention_model_learns_and_empty_tables(spark, no_docs):
    d = read_table(spark, SF_SMALL, "documents").withColumn("train", id_remainder(7) != 2)
    out = [r for r in lm.score_texts(d, "train").collect() if not r["train"]]
    sub = lm.Subwords(lm.load_vocabulary())
    flat = math.log10(len(sub.length) + 1)  # a uniform model's cost of an id
    ids = sum(len(sub.encode([w.encode() for w in SPACE_WORDS.findall(lower_ascii(r["text"]))])[0]) + 1 for r in d.where("NOT train").collect())
    assert sum(r["score"] for r in out) > -0.75 * flat * ids
    assert lm.score_texts(no_docs.selectExpr("*", "true AS train"), "train").count() == 0
    none = lm.score_texts(d.limit(3).selectExpr("doc_id", "text", "CAST(NULL AS boolean) AS train"), "train").collect()
    assert {(r["n_known"], r["train_tokens"]) for r in none} == {(0, 0)}
