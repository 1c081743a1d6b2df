"""Scoring of whole texts by a causal self-attention model on subword ids, next to exact word statistics.

Words are lower-cased (A-Z) and joined by single blanks; subword ids come from a public byte-pair vocabulary
(a file named by a parameter) and are found once per distinct word of a batch. The model has one layer of
causal attention over windows of ``WINDOW`` ids. Windows overlap: each scores only the ids that have at least
``OVERLAP`` ids of context (the first one of a text scores all), so every id is scored once. An id's probability is that
of its class under the model times its share of the class; frequent ids are classes of their own. Classes come in
groups, and the model predicts the group and then the class in it.

The model is trained in numpy, data-parallel, on all training documents: they are dealt to ``ROUNDS`` rounds, and in a round to
shards of about ``SHARD_BYTES``. In a round every shard is passed over once from the common weights, and Spark averages
the weights. So the work grows with the input and every training document is seen once.

Counts of words and of subword ids cover all training documents too. Documents are batched by a hash of their id; each batch sends its
distinct words' hashes and counts, packed, and gets the corpus counts back in the same order.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import textbytes as tb
from bazaar.llm.shared import Shipped, materialise

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r" [^ ]+"
WINDOW, OVERLAP, WIDTH, HIDDEN = 32, 8, 16, 32
GROUPS, MEMBERS = 32, 32
OWN_CLASSES, SHARED_CLASSES = 960, 64  # GROUPS * MEMBERS in all
OWN_VECTORS, SHARED_VECTORS = 4096, 256
SHARD_BYTES = 8 << 20  # text that is passed over from the common weights in a round
ROUNDS = 3  # parts of the training documents; weights are averaged after each
PART_BYTES = 256 << 20  # text whose distinct words one group adds up
BATCH_BYTES = 8 << 20
SLICE = 1 << 20
NO_ID = (1 << 63) - 1


def load_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """Ranks of a byte-pair vocabulary: a line per token, base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class Subwords:
    """Ids of distinct words; ``ranks`` is shipped with the task, so executors need no file."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.enc = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length[list(ranks.values())] = [len(k) for k in ranks]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every word with a blank before it, and the words' offsets."""
        ids, counts = [], []
        for lo in range(0, len(words), 20_000):
            part = words[lo:lo + 20_000]
            text = b" " + b" ".join(part)
            try:
                got = np.array(self.enc.encode_ordinary(text.decode("utf-8")), np.int32)
                ends = np.cumsum(self.length[got])
                edges = np.cumsum([len(w) + 1 for w in part])
                n = np.diff(np.searchsorted(ends, edges, "right"), prepend=0)
                if not len(ends) or ends[-1] != len(text) or not np.isin(edges, ends).all():
                    raise ValueError
            except (UnicodeDecodeError, ValueError):  # bytes that are no text
                each = [self.enc._encode_single_piece(b" " + w) for w in part]
                got, n = np.array([i for x in each for i in x], np.int32), np.array([len(x) for x in each])
            ids.append(got), counts.append(n)
        offs = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), offs.astype(np.int64)


# --- the model -----------------------------------------------------------------------------------------------------

class Classes:
    """Classes and vectors of ids by their frequency in all training documents; every id has a share above zero."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        smooth = counts + 0.1
        mass = np.cumsum(smooth[order[OWN_CLASSES:]])
        bins = np.minimum((SHARED_CLASSES * (mass - smooth[order[OWN_CLASSES:]] / 2) / max(mass[-1], 1e-9)).astype(np.int64), SHARED_CLASSES - 1) if n > OWN_CLASSES else np.zeros(0, np.int64)
        self.cls = np.empty(n, np.int32)
        self.cls[order[:OWN_CLASSES]] = np.arange(min(n, OWN_CLASSES))
        self.cls[order[OWN_CLASSES:]] = OWN_CLASSES + bins
        total = np.bincount(self.cls, smooth, OWN_CLASSES + SHARED_CLASSES)
        self.log_share = np.log(smooth / total[self.cls]).astype(np.float32)
        self.vector = np.where(rank < OWN_VECTORS, rank, OWN_VECTORS + np.arange(n) % SHARED_VECTORS).astype(np.int32)


NAMES = ("emb", "pos", "wq", "wk", "wv", "wo", "w1", "b1", "w2", "group", "gbias", "member", "mbias")


def initial_weights(seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    d = WIDTH
    shapes = {"emb": (OWN_VECTORS + SHARED_VECTORS + 1, d), "pos": (WINDOW, d), "wq": (d, d), "wk": (d, d), "wv": (d, d), "wo": (d, d), "w1": (d, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, d),
              "group": (d, GROUPS), "gbias": (GROUPS,), "member": (GROUPS, d, MEMBERS), "mbias": (GROUPS, MEMBERS)}
    scale = {"emb": 0.3, "pos": 0.1, "b1": 0.0, "gbias": 0.0, "mbias": 0.0, "member": 0.7 / np.sqrt(d)}
    return {k: (r.normal(0, 1, s) * scale.get(k, 0.7 / np.sqrt(s[0]))).astype(np.float32) for k, s in shapes.items()}


_CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_BOUND = 60.0  # exp of more overflows float32; trained weights stay far below


def _row_sums(a: np.ndarray) -> np.ndarray:
    """Sums of short rows; a product is faster than a reduction here."""
    return a @ np.ones(a.shape[1], a.dtype)


def _bound(a: np.ndarray) -> None:
    if a.max(initial=0) > _BOUND:
        np.minimum(a, _BOUND, out=a)


def attend(w: dict, x: np.ndarray):
    """The parts of the layer before the classes, for windows ``x`` (windows, WINDOW) of vector numbers."""
    b, d = len(x), WIDTH
    e = w["emb"].take(x, 0)
    e += w["pos"]
    flat = e.reshape(-1, d)
    q, k, v = ((flat @ m).reshape(b, WINDOW, d) for m in (w["wq"] * w["wq"].dtype.type(1 / np.sqrt(d)), w["wk"], w["wv"]))
    a = q @ np.ascontiguousarray(k.transpose(0, 2, 1))
    _bound(a)
    np.exp(a, out=a)
    a *= _CAUSAL
    total = _row_sums(a.reshape(-1, WINDOW)).reshape(b, WINDOW, 1)
    mixed = a @ v
    mixed /= total
    return flat, q, k, v, a, total, mixed.reshape(-1, d)


def predict(w: dict, flat: np.ndarray, mixed: np.ndarray):
    h = mixed @ w["wo"]
    h += flat
    m = h @ w["w1"]
    m += w["b1"]
    np.maximum(m, np.zeros_like(m), out=m)  # a scalar takes four times as long
    return h, m, h + m @ w["w2"]


def _softmax(logits: np.ndarray, want: np.ndarray, divide: bool) -> np.ndarray:
    """Log probability of ``want``; ``logits`` becomes the probabilities' numerators, divided by their sum if asked for."""
    _bound(logits)
    got = logits.take(np.arange(len(want)) * logits.shape[1] + want)
    np.exp(logits, out=logits)
    total = _row_sums(logits)
    if divide:
        logits /= total[:, None]
    return got - np.log(total)


def class_log_probability(w: dict, z: np.ndarray, want: np.ndarray, grad: dict | None = None, weight: float = 1.0) -> np.ndarray:
    """Log probability of the classes ``want``: that of the class's group times that of the member in the group.

    With ``grad`` the gradients of minus the mean are added to it, also that of ``z`` under "z"."""
    order = np.argsort((want // MEMBERS).astype(np.uint8), kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    want = want.take(order)
    group = want // MEMBERS
    member = want - group * MEMBERS
    cuts = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
    n, d = z.shape
    zs = np.ones((n, d + 1), z.dtype)  # the last column is for the biases
    zs[:, :d] = z.take(order, 0)
    p = zs @ np.concatenate([w["group"], w["gbias"][None]])
    inner = np.concatenate([w["member"], w["mbias"][:, None]], 1)
    q = np.empty((n, MEMBERS), z.dtype)
    for g, lo, hi in zip(range(GROUPS), cuts, cuts[1:]):
        np.matmul(zs[lo:hi], inner[g], out=q[lo:hi])
    out = (_softmax(p, group, grad is not None) + _softmax(q, member, grad is not None)).take(back)
    if grad is not None:
        for part, hit in ((p, group), (q, member)):
            part *= weight
            part[np.arange(n), hit] -= weight
        both, dz = zs.T @ p, p @ w["group"].T
        grad["group"], grad["gbias"] = both[:d], both[d]
        both = np.zeros_like(inner)
        for g, lo, hi in zip(range(GROUPS), cuts, cuts[1:]):
            both[g] = zs[lo:hi].T @ q[lo:hi]
            dz[lo:hi] += q[lo:hi] @ w["member"][g].T
        grad["member"], grad["mbias"] = both[:, :d], both[:, d]
        grad["z"] = dz.take(back, 0)
    return out


def gradients(w: dict, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict]:
    """Mean negative log likelihood of the classes ``y`` where ``mask`` holds, and its gradients."""
    b, d = len(x), WIDTH
    kind = w["emb"].dtype.type
    flat, q, k, v, a, total, mixed = attend(w, x)
    a /= total
    h, m, z = predict(w, flat, mixed)
    rows = np.flatnonzero(mask.ravel())
    n = max(1, len(rows))
    out: dict[str, np.ndarray] = {}
    loss = -float(class_log_probability(w, z.take(rows, 0), y.ravel()[rows], out, kind(1 / n)).sum()) / n
    dz = np.zeros_like(z)
    dz[rows] = out.pop("z")
    out["w2"] = m.T @ dz
    dm = dz @ w["w2"].T
    dm *= m > 0
    out["w1"], out["b1"] = h.T @ dm, np.ones(len(dm), dm.dtype) @ dm
    dh = dz + dm @ w["w1"].T
    out["wo"] = mixed.T @ dh
    dmix = dh @ w["wo"].T
    lean = _row_sums(dmix * mixed).reshape(b, WINDOW, 1)
    dmix = dmix.reshape(b, WINDOW, d)
    dv = a.transpose(0, 2, 1) @ dmix
    ds = dmix @ np.ascontiguousarray(v.transpose(0, 2, 1))
    ds -= lean
    ds *= a
    dq, dk = (ds @ k) * kind(1 / np.sqrt(d)), ds.transpose(0, 2, 1) @ q
    both = np.concatenate([g.reshape(-1, d) for g in (dq, dk, dv)], 1)
    out["wq"], out["wk"], out["wv"] = np.split(flat.T @ both, 3, 1)
    de = dh + both @ np.concatenate([w["wq"], w["wk"], w["wv"]], 1).T
    de = de.reshape(b, WINDOW, d)
    out["pos"] = de.sum(0)
    cells = (x.reshape(-1, 1).astype(np.int64) * d + np.arange(d)).ravel()
    out["emb"] = np.bincount(cells, de.ravel(), w["emb"].size).astype(kind).reshape(-1, d)
    return loss, out


def windows(lengths: np.ndarray, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over concatenated sequences: start (absolute), the first place that counts, and how many count.

    Every place of every sequence counts in exactly one window."""
    step = WINDOW - overlap
    more = np.maximum(0, -(-(lengths - WINDOW) // step))
    n = np.where(lengths > 0, 1 + more, 0)
    seq = np.repeat(np.arange(len(lengths)), n)
    j = np.arange(len(seq)) - np.repeat(np.cumsum(n) - n, n)
    first = np.where(j > 0, overlap, 0)
    inner = j * step
    count = np.minimum(WINDOW, lengths[seq] - inner) - first
    base = (np.cumsum(lengths) - lengths)[seq]
    return base + inner, first, count


def window_batches(vec_in: np.ndarray, lengths: np.ndarray, size: int):
    """(absolute places, vector numbers, mask of the places that count) in batches of windows."""
    start, first, count = windows(lengths)
    lane = np.arange(WINDOW)
    last = max(len(vec_in) - 1, 0)
    for lo in range(0, len(start), size):
        s, f, c = start[lo:lo + size], first[lo:lo + size], count[lo:lo + size]
        at = np.minimum(s[:, None] + lane, last)
        yield at, vec_in[at], (lane >= f[:, None]) & (lane < (f + c)[:, None])


def _inputs(cls: Classes, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Vector numbers before every id: those of the id before it, or the beginning's."""
    out = np.empty(len(ids), cls.vector.dtype)
    out[1:] = cls.vector[ids[:-1]]
    out[(np.cumsum(lengths) - lengths)[lengths > 0]] = OWN_VECTORS + SHARED_VECTORS
    return out


def sequence_log_probability(w: dict, cls: Classes, ids: np.ndarray, lengths: np.ndarray, size: int = 64) -> np.ndarray:
    """Natural log probability of every id, given those before it in its sequence."""
    if not len(ids):
        return np.zeros(0)
    vec_in, want = _inputs(cls, ids, lengths), cls.cls[ids]
    out = np.empty(len(ids))
    hold: list[tuple] = []

    def classify():
        place = np.concatenate([p for p, _ in hold])
        out[place] = class_log_probability(w, np.concatenate([z for _, z in hold]), want[place])
        hold.clear()

    for at, x, mask in window_batches(vec_in, lengths, size):
        hit = np.flatnonzero(mask.ravel())
        flat, *_, mixed = attend(w, x)
        hold.append((at.ravel()[hit], predict(w, flat[hit], mixed[hit])[2]))
        if len(hold) == 8:
            classify()
    if hold:
        classify()
    return out + cls.log_share[ids]


def train_pass(w: dict, cls: Classes, ids: np.ndarray, lengths: np.ndarray, seed: int, size: int = 256, rate: float = 8e-3) -> dict:
    """One pass of Adam over a shard, from the weights ``w``; the windows don't overlap, so every id is seen once."""
    values = np.concatenate([w[k].ravel() for k in NAMES])
    cuts = np.cumsum([0, *(w[k].size for k in NAMES)]).tolist()
    w = {k: values[lo:hi].reshape(w[k].shape) for k, lo, hi in zip(NAMES, cuts, cuts[1:])}
    m, s = np.zeros_like(values), np.zeros_like(values)
    vec_in, want = _inputs(cls, ids, lengths), cls.cls[ids]
    start, _, count = windows(lengths, 0)
    order = np.random.default_rng(seed).permutation(len(start))
    lane, last = np.arange(WINDOW), max(len(ids) - 1, 0)
    steps = -(-len(order) // size)
    for t, lo in enumerate(range(0, len(order), size), 1):
        part = order[lo:lo + size]
        at = np.minimum(start[part, None] + lane, last)
        _, grad = gradients(w, vec_in[at], want[at], lane < count[part, None])
        g = np.concatenate([grad[k].ravel() for k in NAMES])
        m += 0.1 * (g - m)
        s += 0.02 * (g * g - s)
        lr = rate * min(1.0, t / 20) * (1 - 0.9 * t / steps)
        values -= (lr / (1 - 0.9 ** t)) * m / (np.sqrt(s / (1 - 0.98 ** t)) + 1e-8)
    return w


# --- texts to ids --------------------------------------------------------------------------------------------------

def word_table(buf: np.ndarray, offs: np.ndarray, pw: tb.Powers):
    """Distinct word hashes, each one's first bytes range, every word's distinct number, and word offsets by text."""
    low = tb.LOWER[buf]
    starts, ends, woffs = tb.words(low, offs, tb.SPACE_WORD)
    h = tb.span_hash(tb.prefix_hash(low, pw), starts, ends, pw)
    u, first, inv = np.unique(h, return_index=True, return_inverse=True)
    return low, u, starts[first], ends[first], inv, woffs


def spelled(ids: np.ndarray, woff: np.ndarray, end_id: int, inv: np.ndarray, woffs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of the words ``inv``, where ids[woff[k]:woff[k + 1]] are those of word k: ids with an end each, and lengths."""
    n = np.diff(woff)[inv]
    total = np.cumsum(np.concatenate([[0], n]))
    lengths = total[woffs[1:]] - total[woffs[:-1]] + 1
    out = np.full(int(lengths.sum()), end_id, np.int32)
    text = np.repeat(np.arange(len(woffs) - 1), np.diff(woffs))
    to = total[:-1] + text  # one end after each earlier text
    spread = np.arange(int(n.sum())) - np.repeat(total[:-1], n)
    out[np.repeat(to, n) + spread] = ids[np.repeat(woff[inv], n) + spread]
    return out, lengths


def _once(make):
    """A function that calls ``make`` the first time only: a task makes what its groups share once."""
    made = []

    def get():
        if not made:
            made.append(make())
        return made[0]
    return get


def _learn(now: Shipped, vocabulary: Shipped, end_id: int, r: int):
    """One shard's pass; its texts in a fixed order, so that reruns agree."""
    model, subwords = _once(now.load), _once(lambda: Subwords(vocabulary.load()))

    def run(key, table):
        cls, w = model()
        u, _, tables, first = _batch_words(table.sort_by([("doc", "ascending"), ("text", "ascending")]), tb.Powers())
        ids_of, n = _batch_ids(subwords(), tables, first)
        woff = np.concatenate([[0], np.cumsum(n)])
        ids, lengths = map(np.concatenate, zip(*(spelled(ids_of, woff, end_id, np.searchsorted(u, mine)[inv], woffs) for _, mine, _, _, inv, woffs in tables)))
        w = train_pass(w, cls, ids, lengths, seed=1000 * r + key[0].as_py())
        return pa.table({"name": list(NAMES), "weight": [float(len(ids))] * len(NAMES), "value": pa.array([w[k].astype(np.float32).tobytes() for k in NAMES], pa.binary())})
    return run


def _mean(parts: list) -> tuple[float, bytes]:
    """Ids in all and the average by ids of (ids, weights) pairs."""
    every = sum(n for n, _ in parts)
    return every, sum(np.frombuffer(v, np.float32).astype(np.float64) * (n / every) for n, v in parts).astype(np.float32).tobytes()


def _average_here(batches):
    """The weights of a partition's shards, averaged while they come, so that few are left to send."""
    now: dict[str, tuple[float, bytes]] = {}
    for batch in batches:
        for name, *part in zip(*(c.to_pylist() for c in batch.columns)):
            now[name] = _mean([now[name], part]) if name in now else tuple(part)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array(list(now)), pa.array([n for n, _ in now.values()]), pa.array([v for _, v in now.values()], pa.binary())], ["name", "weight", "value"])


def _average(table: pa.Table) -> pa.Table:
    """The weights of one name, averaged by the ids they saw."""
    _, value = _mean(sorted(zip(table.column("weight").to_pylist(), table.column("value").to_pylist())))
    return pa.table({"name": [table.column("name")[0].as_py()], "value": pa.array([value], pa.binary())})


def fit(train: DataFrame, counts: np.ndarray, vocabulary: Shipped, shards: int) -> tuple[Classes, dict]:
    """Classes from the ids' ``counts``, weights from all training texts (doc, train, text), each in one pass of one round.

    In a round each of the shards passes over its texts; Spark averages the weights by ids."""
    spark = train.sparkSession
    cls, w = Classes(counts), initial_weights()
    if not counts.any():
        return cls, w
    share = np.bincount(cls.cls, counts + 0.1, OWN_CLASSES + SHARED_CLASSES)
    share = np.maximum(share, 1e-3).reshape(GROUPS, MEMBERS)
    w["gbias"], w["mbias"] = np.log(share.sum(1) / share.sum()).astype(np.float32), np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    w["group"][:], w["member"][:] = 0, 0  # at first the model is the ids' frequencies; few texts leave it near them
    drawn = F.pmod(F.xxhash64("doc", "text"), F.lit(ROUNDS * shards))
    dealt = train.select("doc", "train", "text", (drawn % ROUNDS).alias("round"), F.floor(drawn / ROUNDS).cast("int").alias("shard"))
    kind = "name string, weight double, value binary"
    for r in range(ROUNDS):
        now = Shipped(spark, (cls, w))
        learned = dealt.where(F.col("round") == r).groupBy("shard").applyInArrow(_learn(now, vocabulary, len(counts) - 1, r), kind).mapInArrow(_average_here, kind)
        for row in learned.groupBy("name").applyInArrow(_average, "name string, value binary").collect():
            w[row["name"]] = np.frombuffer(bytes(row["value"]), np.float32).reshape(w[row["name"]].shape).copy()
    return cls, w


# --- word counts ---------------------------------------------------------------------------------------------------

def _batch_words(table: pa.Table, pw: tb.Powers):
    """Distinct word hashes of a batch with their counts in training documents, the word tables of its slices, and where in
    the slices' lists each word is first."""
    kept, tables = [], []
    train = table.column("train").to_numpy(zero_copy_only=False)
    for lo, buf, offs in tb.slices(table.column("text").combine_chunks(), SLICE):
        tables.append(word_table(buf, offs, pw))
        _, u, _, _, inv, woffs = tables[-1]
        mine = np.repeat(train[lo:lo + len(offs) - 1], np.diff(woffs))
        kept.append((u, np.bincount(inv[mine], minlength=len(u))))
    if not kept:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), tables, np.zeros(0, np.int64)
    u, first, inv = np.unique(np.concatenate([k[0] for k in kept]), return_index=True, return_inverse=True)
    return u, np.bincount(inv, np.concatenate([k[1] for k in kept]), len(u)).astype(np.int64), tables, first


def _batch_ids(sub: Subwords, tables: list, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of a batch's distinct words, and how many each has; a word is spelled once, where it occurs first."""
    order, words, lo = np.argsort(first), [], 0
    for low, mine, s, e, _, _ in tables:
        at = first[order[np.searchsorted(first[order], lo):np.searchsorted(first[order], lo + len(mine))]] - lo
        lo += len(mine)
        data = low.tobytes()
        words += [data[a:b] for a, b in zip(s[at].tolist(), e[at].tolist())]
    ids, offs = sub.encode(words)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    n = np.diff(offs)[back]
    to = np.cumsum(n) - n
    return ids[np.repeat(offs[back], n) + np.arange(int(n.sum())) - np.repeat(to, n)], n


def _by_part(u: np.ndarray, parts: int):
    """Hashes are dealt by their top bits, so ascending order keeps a part's together."""
    part = (u >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _send_words(parts: int, vocabulary: Shipped, end_id: int):
    """A batch's distinct words by part; under a part below zero the words' subword ids and the ids' counts in training texts."""
    subwords = _once(lambda: Subwords(vocabulary.load()))

    def run(table: pa.Table) -> pa.Table:
        u, n, tables, first = _batch_words(table, tb.Powers())
        cuts = _by_part(u, parts)
        full = np.flatnonzero(np.diff(cuts))
        batch = table.column("batch")[0].as_py()
        ids, lengths = _batch_ids(subwords(), tables, first)
        seen = np.bincount(ids, np.repeat(n, lengths), end_id + 1).astype(np.int64)
        seen[end_id] += np.count_nonzero(table.column("train").to_numpy(zero_copy_only=False))
        at = np.flatnonzero(seen)
        own = -1 - batch % parts
        part = [*full.tolist(), own, own]
        return pa.table({"part": pa.array(part, pa.int32()), "batch": pa.array([*[batch] * (len(full) + 1), -1], pa.int32()),
                         "words": pa.array([*(u[cuts[p]:cuts[p + 1]].tobytes() for p in full), ids.astype(_narrow(end_id)).tobytes(), at.astype(np.uint64).tobytes()], pa.binary()),
                         "counts": pa.array([*(n[cuts[p]:cuts[p + 1]].astype(np.uint32).tobytes() for p in full), lengths.astype(np.uint32).tobytes(), seen[at].astype(np.uint32).tobytes()], pa.binary())})
    return run


def _narrow(end_id: int):
    """The type that holds every id."""
    return np.uint16 if end_id < 1 << 16 else np.uint32


def _keep_ids(table: pa.Table) -> pa.Table:
    """Ids of the batches' words as they are (lengths behind them), and the ids' counts added up in one row of batch -1."""
    batch = table.column("batch").to_pylist()
    lists, counts = table.column("words").to_pylist(), table.column("counts").to_pylist()
    sums = [k for k, b in enumerate(batch) if b < 0]
    u, inv = np.unique(np.concatenate([np.frombuffer(lists[k], np.uint64) for k in sums]), return_inverse=True)
    total = np.bincount(inv, np.concatenate([np.frombuffer(counts[k], np.uint32) for k in sums]).astype(np.float64), len(u)).astype(np.uint64)
    own = [k for k, b in enumerate(batch) if b >= 0]
    part = table.column("part")[0].as_py()
    return pa.table({"batch": pa.array([-1, *(batch[k] for k in own)], pa.int32()), "part": pa.array([part] * (len(own) + 1), pa.int32()), "known": pa.array([0] * (len(own) + 1)),
                     "totals": pa.array([np.stack([u, total]).tobytes(), *(counts[k] + lists[k] for k in own)], pa.binary()), "size": pa.array([len(u), *(len(counts[k]) // 4 for k in own)], pa.int32())})


def _add_words(table: pa.Table) -> pa.Table:
    """Per batch the corpus counts of its words, in its order; ``known`` (distinct training words here) once per part.

    A part below zero holds subword ids."""
    if table.column("part")[0].as_py() < 0:
        return _keep_ids(table)
    lists = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("words")]
    n = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")]).astype(np.int64)
    u, inv = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(inv, n, len(u)).astype(np.uint64)
    back = np.split(total[inv], np.cumsum([len(x) for x in lists])[:-1])
    known = np.zeros(len(lists), np.int64)
    known[0] = (total > 0).sum()
    return pa.table({"batch": table.column("batch"), "part": table.column("part"), "known": pa.array(known), "totals": pa.array([x.astype(np.uint64).tobytes() if x.max(initial=0) >= 1 << 32 else x.astype(np.uint32).tobytes() for x in back], pa.binary()), "size": pa.array([len(x) for x in back], pa.int32())})


def _all_ids(counted: DataFrame, end_id: int) -> np.ndarray:
    """How often each subword id occurs in all training documents; the driver gets one number per id."""
    def add(batches):
        n = np.zeros(end_id + 1, np.int64)
        for batch in batches:
            for x in batch.column(0):
                at, times = np.frombuffer(x.as_py(), np.uint64).reshape(2, -1)
                n[at.astype(np.int64)] += times.astype(np.int64)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["id", "n"])

    got = counted.where("batch < 0").select("totals").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(end_id + 1)
    out[got.column("id").to_numpy()] = got.column("n").to_numpy()
    return out


_SCORED = "doc long, train boolean, n_tokens long, n_known long, log_counts double, score double"


def _score_batches(model: Shipped, end_id: int):
    load = _once(model.load)

    def run(key, table: pa.Table, counted: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.schema([("doc", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_counts", pa.float64()), ("score", pa.float64())]).empty_table()
        cls, w = load()
        u, _, tables, _ = _batch_words(table, tb.Powers())
        part = counted.column("part").to_numpy()
        spell = int(np.flatnonzero(part < 0)[0])
        data, n_words = counted.column("totals")[spell].as_py(), counted.column("size")[spell].as_py()
        ids_of, woff = np.frombuffer(data, _narrow(end_id), offset=4 * n_words).astype(np.int32), np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint32, n_words).astype(np.int64))])
        order = [int(i) for i in np.argsort(part) if part[i] >= 0]
        back = [np.frombuffer(counted.column("totals")[i].as_py(), np.uint8) for i in order]
        sizes = [counted.column("size")[i].as_py() for i in order]
        c = np.concatenate([x.view(np.uint64 if len(x) == 8 * n else np.uint32).astype(np.float64) for x, n in zip(back, sizes)]) if len(back) else np.zeros(0)
        cols = {k: [] for k in ("n_tokens", "n_known", "log_counts", "score")}
        for _, mine, _, _, inv, woffs in tables:
            at = np.searchsorted(u, mine)[inv]
            own = c[at]
            cols["n_tokens"].append(np.diff(woffs))
            cols["n_known"].append(tb.segment_sum(own > 0, woffs))
            cols["log_counts"].append(tb.segment_sum(np.log10(own + 1), woffs))
            ids, lengths = spelled(ids_of, woff, end_id, at, woffs)
            logp = sequence_log_probability(w, cls, ids, lengths)
            cols["score"].append(tb.segment_sum(logp, np.concatenate([[0], np.cumsum(lengths)])) / np.log(10))
        return pa.table({"doc": table.column("doc"), "train": table.column("train"), **{k: pa.array(np.concatenate(v)) for k, v in cols.items()}})
    return run


def score_texts(docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """id, ``train_col``, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are the words and one end. base_score is the add-one word model over all rows with ``train_col``; score is the
    attention model's log10 probability of the text. Null text counts as empty (the end alone). Repeated rows count
    and score each. A null id comes back null. Without training rows all counts are 0 and the weights are the initial
    ones. An empty table gives an empty table. Other columns are not read."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(train_col), F.lit(False)).alias("train"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = src.agg(F.sum(F.octet_length("text")).alias("b"), F.sum(F.col("train").cast("long")).alias("n")).first()
    total, train_docs = size["b"] or 0, size["n"] or 0
    batches = max(1, -(-total // batch_bytes))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    ranks = load_vocabulary(vocabulary)
    end_id, shared = max(ranks.values()) + 1, Shipped(spark, ranks)
    keyed = src.select(F.pmod(F.hash("doc"), F.lit(batches)).cast("int").alias("batch"), "doc", "train", "text")
    sent = keyed.groupBy("batch").applyInArrow(_send_words(parts, shared, end_id), "part int, batch int, words binary, counts binary")
    counted = materialise(sent.groupBy("part").applyInArrow(_add_words, "batch int, part int, known long, totals binary, size int"), "lm-counts")
    cls, w = fit(src.where("train"), _all_ids(counted, end_id), shared, max(1, total // ROUNDS // SHARD_BYTES))
    model = Shipped(spark, (cls, w))
    counted = counted.where("batch >= 0")
    scored = keyed.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(_score_batches(model, end_id), _SCORED)
    scored = materialise(scored, "lm-scores")
    v = (counted.agg(F.sum("known")).first()[0] or 0) + (1 if train_docs else 0)
    n = (scored.where("train").agg(F.sum("n_tokens")).first()[0] or 0) + train_docs
    end = F.lit(float(np.log10(train_docs + 1)))
    base = F.col("log_counts") + end - (F.col("n_tokens") + 1) * F.lit(float(np.log10(n + v + 1)))
    return scored.select(F.nullif("doc", F.lit(NO_ID)).alias(id_col), F.col("train").alias(train_col), (F.col("n_tokens") + 1).alias("n_tokens"), (F.col("n_known") + int(train_docs > 0)).alias("n_known"),
                         F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
