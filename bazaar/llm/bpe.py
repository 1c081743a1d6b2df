"""BPE encoding and decoding with a published vocabulary, by dynamic programming over prefixes.

Byte pair encoding merges the pair of lowest rank first, left to right. The last token of a prefix's
encoding is unique, and a token ``t`` that ends the prefix is that token exactly if the last token of the
shorter prefix before ``t`` and ``t`` are *compatible*: merging their joint string from scratch never
merges across the border. So a word needs no merging at all:

1. a suffix automaton of all tokens, read along the word, gives every token that ends at a position;
2. the one that is compatible with the last token stored where it starts is stored for this prefix;
3. back-pointers from the end of the word give the ids.

That takes time linear in the word's length (times the few tokens that end at a position), also for one
word of many megabytes. The automaton follows the vocabulary, not the data, and is sent to executors once.
"""

from __future__ import annotations

import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bazaar.llm import textbytes as tb

NEVER = 1 << 40
END = "</w>"
#: distinct words that a worker remembers from batch to batch
CACHE = 200_000
#: bytes of text that are encoded together (a longer text goes alone, whole)
BATCH_BYTES = 4 << 20
#: words up to this length are encoded together, longer ones one by one
SHORT = 48


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """The parts of a tokenizer file that encoding needs, from a path the driver can open. Raises for a file of
    another kind than the one built here: BPE with word ends, NFC, white space to blanks, lower case, one split
    pattern, byte level, special tokens found in the raw text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    steps = [p["type"] for p in pre["pretokenizers"]]
    known = (model["type"] == "BPE" and model["end_of_word_suffix"] == END and not model["continuing_subword_prefix"] and not model["dropout"]
             and not model["byte_fallback"] and not model.get("ignore_merges") and kinds == ["NFC", "Replace", "Lowercase"] and steps == ["Split", "ByteLevel"]
             and pre["pretokenizers"][0]["invert"] and not pre["pretokenizers"][1]["add_prefix_space"] and spec["decoder"] is None
             and not any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"]))
    if not known:
        raise ValueError(f"{path}: not a lower-case byte-level BPE vocabulary with word ends")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "pattern": pre["pretokenizers"][0]["pattern"]["Regex"],
            "special": {a["content"]: a["id"] for a in spec["added_tokens"]}}


def compatible(rank: list, left: list, right: list, merge: dict, a: int, b: int, until: int = NEVER) -> bool:
    """Whether no merge before time ``until`` joins a piece that ends ``a`` with a piece that starts ``b``.

    The pieces at the border change as merges (times: ranks) happen. Going back in time from the finished
    tokens, the younger of the two pieces at the border is taken apart; ``x`` and ``y`` are then both there until
    the earlier of the merges that used them up. A merge of x and y before that would have happened instead."""
    x, y, x_ends, y_ends = a, b, until, until
    while True:
        r = merge.get(x << 20 | y)
        if r is not None and r < x_ends and r <= y_ends:
            # at one rank the leftmost pair goes first: x is used up before, y is not
            return False
        if rank[x] < 0 and rank[y] < 0:
            return True
        if rank[x] > rank[y]:
            x_ends, x = rank[x], right[x]
        else:
            y_ends, y = rank[y], left[y]


class Automaton:
    """Suffix automaton of the symbol strings of all tokens; state 0 is the empty string."""

    def __init__(self):
        self.step, self.link, self.size, self.out = {}, [-1], [0], [[]]

    def _state(self, size: int) -> int:
        self.link.append(0)
        self.size.append(size)
        self.out.append([])
        return len(self.size) - 1

    def _edge(self, state: int, symbol: int, to: int):
        if self.step.get(state << 9 | symbol) is None:
            self.out[state].append(symbol)
        self.step[state << 9 | symbol] = to

    def _split(self, p: int, symbol: int, q: int) -> int:
        """A state for the strings of q that extend p's; the longer ones stay in q."""
        c = self._state(self.size[p] + 1)
        for s in self.out[q]:
            self._edge(c, s, self.step[q << 9 | s])
        self.link[c], self.link[q] = self.link[q], c
        while p >= 0 and self.step.get(p << 9 | symbol) == q:
            self.step[p << 9 | symbol] = c
            p = self.link[p]
        return c

    def extend(self, last: int, symbol: int) -> int:
        q = self.step.get(last << 9 | symbol)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, symbol, q)
        new, p = self._state(self.size[last] + 1), last
        while p >= 0 and self.step.get(p << 9 | symbol) is None:
            self._edge(p, symbol, new)
            p = self.link[p]
        if p >= 0:
            q = self.step[p << 9 | symbol]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, symbol, q)
        return new

    def add(self, symbols: list[int]) -> int:
        state = 0
        for s in symbols:
            state = self.extend(state, s)
        return state


def build_tables(vocabulary: dict) -> dict:
    """Everything encoding needs, as plain arrays and dicts: bytes follow the vocabulary's size."""
    vocab, alphabet = vocabulary["vocab"], byte_alphabet()
    symbol = {c: i for i, c in enumerate(alphabet)} | {c + END: 256 + i for i, c in enumerate(alphabet)}
    n = max([*vocab.values(), *vocabulary["special"].values()]) + 1
    names = [""] * n
    for t, i in [*vocab.items(), *vocabulary["special"].items()]:
        names[i] = t
    rank, left, right, spelt, merge = [-1] * n, [-1] * n, [-1] * n, [None] * n, {}
    for t, s in symbol.items():
        spelt[vocab[t]] = [s]
    good = [s is not None for s in spelt]
    for r, (a, b) in enumerate(vocabulary["merges"]):
        a, b = vocab[a], vocab[b]
        t = vocab[names[a] + names[b]]
        merge[a << 20 | b] = r
        if spelt[t] is None:
            rank[t], left[t], right[t], spelt[t] = r, a, b, spelt[a] + spelt[b]
    for t in sorted((t for t in range(n) if left[t] >= 0), key=rank.__getitem__):
        # a token whose own string is merged in another way never occurs
        good[t] = good[left[t]] and good[right[t]] and compatible(rank, left, right, merge, left[t], right[t], rank[t])
    auto = Automaton()
    token = {auto.add(spelt[t]): t for t in range(n) if good[t]}
    states = len(auto.size)
    up, ids = [0] * states, [-1] * states
    for s, t in token.items():
        ids[s] = t
    for s in sorted(range(1, states), key=auto.size.__getitem__):  # links lead to shorter strings
        up[s] = auto.link[s] if ids[auto.link[s]] >= 0 else up[auto.link[s]]
    return {"step": auto.step, "link": array("i", auto.link), "size": array("i", auto.size), "up": array("i", up), "ids": array("i", ids), "rank": rank, "left": left, "right": right,
            "merge": merge, "names": names, "special": vocabulary["special"], "pattern": vocabulary["pattern"], "fits": {}, "words": {}}


def encode_word(t: dict, word: bytes) -> list[int]:
    """Token ids of one word (its bytes, the last one marked as the end)."""
    step, link, size, up, ids, fits = t["step"], t["link"], t["size"], t["up"], t["ids"], t["fits"]
    n, state, length = len(word), 0, 0
    last, back = array("i", bytes(4 * n + 4)), array("i", bytes(4 * n + 4))
    for i in range(1, n + 1):
        c = word[i - 1] + 256 if i == n else word[i - 1]
        to = step.get(state << 9 | c)
        while to is None:
            state = link[state]
            length = size[state]
            to = step.get(state << 9 | c)
        state, length = to, length + 1
        s = state if ids[state] >= 0 and size[state] == length else up[state]
        while True:  # the tokens that end here, longest first
            b, j = ids[s], i - size[s]
            if not j:
                break
            pair = last[j] << 20 | b
            ok = fits.get(pair)
            if ok is None:
                if len(fits) > CACHE * 4:
                    fits.clear()
                ok = fits[pair] = compatible(t["rank"], t["left"], t["right"], t["merge"], last[j], b)
            if ok:
                break
            s = up[s]
        last[i], back[i] = b, j
    out, i = [], n
    while i:
        out.append(last[i])
        i = back[i]
    return out[::-1]


def compatible_pairs(t: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``compatible`` for many pairs at once."""
    rank, left, right, (merges, ranks) = t["np_rank"], t["np_left"], t["np_right"], t["np_merge"]
    out, at = np.ones(len(a), bool), np.arange(len(a))
    x, y = a.astype(np.int64), b.astype(np.int64)
    x_ends, y_ends = np.full(len(a), NEVER), np.full(len(a), NEVER)
    while len(at):
        r = merges.find(_mixed(x << 20 | y))
        found = r >= 0
        r = np.where(found, ranks[r], NEVER)
        clash = found & (r < x_ends) & (r <= y_ends)
        out[at[clash]] = False
        rx, ry = rank[x], rank[y]
        go = ~clash & ((rx >= 0) | (ry >= 0))
        at, x, y, x_ends, y_ends, rx, ry = at[go], x[go], y[go], x_ends[go], y_ends[go], rx[go], ry[go]
        older = rx > ry
        x_ends, y_ends = np.where(older, rx, x_ends), np.where(older, y_ends, ry)
        x, y = np.where(older, right[x], x), np.where(older, y, left[y])
    return out


def _mixed(keys: np.ndarray) -> np.ndarray:
    return tb.mix(keys.astype(np.uint64) + np.uint64(1))


def _lookup(table: dict):
    keys = _mixed(np.fromiter(table, np.int64, len(table)))
    order = np.argsort(keys)
    return tb.SortedHashes(keys[order]), np.fromiter(table.values(), np.int64, len(table))[order]


def encode_words(t: dict, words: list[bytes]) -> list[bytes]:
    """Token ids (32-bit) of many short words: the recurrence of ``encode_word``, one position of all words at a time."""
    if "np_step" not in t:
        t["np_step"], t["np_merge"] = _lookup(t["step"]), _lookup(t["merge"])
        for k in ("rank", "left", "right", "link", "size", "up", "ids"):
            t[f"np_{k}"] = np.array(t[k], np.int64)
    (edges, targets), link, size, up, ids = t["np_step"], t["np_link"], t["np_size"], t["np_up"], t["np_ids"]
    lens = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-lens, kind="stable")
    lens = lens[order]
    longest = int(lens[0]) if len(lens) else 0
    letters = np.frombuffer(b"".join(words[i].ljust(longest, b"\0") for i in order), np.uint8).reshape(-1, longest).astype(np.int64)
    letters[np.arange(len(lens)), lens - 1] += 256
    last, back = np.zeros((len(lens), longest + 1), np.int32), np.zeros((len(lens), longest + 1), np.int32)
    state, length = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
    for i in range(1, longest + 1):
        m = int(np.searchsorted(-lens, -i, "right"))
        state, length, c = state[:m], length[:m], letters[:m, i - 1]
        todo = np.arange(m)
        while len(todo):
            at = edges.find(_mixed(state[todo] << 9 | c[todo]))
            hit = at >= 0
            state[todo[hit]] = targets[at[hit]]
            todo = todo[~hit]
            state[todo] = link[state[todo]]
            length[todo] = size[state[todo]]
        length = length + 1
        s = np.where((ids[state] >= 0) & (size[state] == length), state, up[state])
        todo = np.arange(m)
        while len(todo):
            b, j = ids[s], i - size[s]
            ok = j == 0
            check = np.flatnonzero(~ok)
            ok[check] = compatible_pairs(t, last[todo[check], j[check]], b[check])
            last[todo[ok], i], back[todo[ok], i] = b[ok], j[ok]
            todo, s = todo[~ok], up[s[~ok]]
    return _follow(last, back, lens, order)


def _follow(last, back, lens, order) -> list[bytes]:
    """Back-pointers from the ends of the words, all words at a time."""
    n, pos, rows = len(lens), lens.copy(), np.arange(len(lens))
    found = np.zeros(last.shape, np.int32)
    count = np.zeros(n, np.int64)
    while len(rows):
        p = pos[rows]
        found[rows, count[rows]] = last[rows, p]
        count[rows] += 1
        pos[rows] = back[rows, p]
        rows = rows[pos[rows] > 0]
    out = [b""] * n
    for k, i in enumerate(order.tolist()):
        out[i] = found[k, count[k] - 1::-1].tobytes() if count[k] == 1 else found[k, :count[k]][::-1].tobytes()
    return out


def _lower(s: str) -> str:
    """Lower case letter by letter: str.lower would write a capital sigma at a word's end in another way."""
    return s.lower() if "Σ" not in s else "".join(c.lower() for c in s)


def _words_of(t: dict, text: str) -> list:
    """The words (str) and special ids (int) of a text."""
    if "word_re" not in t:
        t["word_re"] = regex.compile(t["pattern"])
        t["special_re"] = regex.compile("(" + "|".join(map(regex.escape, sorted(t["special"], key=len, reverse=True))) + ")")
    special, out = t["special"], []
    for part in t["special_re"].split(text) if special and any(s in text for s in special) else [text]:
        if part in special:
            out.append(special[part])
        else:
            out += t["word_re"].findall(_lower(part if part.isascii() else unicodedata.normalize("NFC", part)))
    return out


def encode_texts(t: dict, texts: list[str]) -> list[bytes]:
    """Token ids (32-bit) of every text. A word is encoded once as long as the worker remembers it (``CACHE``)."""
    words = t["words"]
    split = [_words_of(t, s) for s in texts]
    fresh = [w for w in set().union(*split) if w not in words]
    words.update((w, np.int32(w).tobytes()) for w in fresh if not isinstance(w, str))
    fresh = [w for w in fresh if isinstance(w, str)]
    spelt = [w.encode() for w in fresh]
    by_length = sorted(range(len(fresh)), key=lambda i: len(spelt[i]))
    short = sum(len(w) <= SHORT for w in spelt)
    for lo in range(0, short, 1 << 14):
        part = by_length[lo:min(short, lo + (1 << 14))]
        words.update(zip([fresh[i] for i in part], encode_words(t, [spelt[i] for i in part])))
    for i in by_length[short:]:
        words[fresh[i]] = np.array(encode_word(t, spelt[i]), np.int32).tobytes()
    out = [b"".join([words[w] for w in s]) for s in split]
    if len(words) > CACHE:
        words.clear()
    return out


class Tokenizer:
    """Encoder and decoder of one vocabulary on a Spark session."""

    def __init__(self, spark: SparkSession, path: str):
        self.tables = spark.sparkContext.broadcast(build_tables(read_vocabulary(path)))

    def encode(self, docs: DataFrame, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
        """Add the token ids (array<int>) of every whole text.

        Null and empty texts give an empty array; repeated rows are encoded alike; an empty table gives an
        empty one. All other columns stay as they are; one named as ``ids_col`` is replaced. Letters are those of
        the installed Unicode tables (unicodedata, regex)."""
        keep = [c for c in docs.columns if c != ids_col]
        src, shipped, at = docs.select(*[f"`{c}`" for c in keep]), self.tables, keep.index(text_col)

        def run(batches):
            t = shipped.value  # unpickled once a worker: its cache of words serves the next task too
            for batch in batches:
                for lo, _, offs in tb.slices(batch.column(at), BATCH_BYTES):
                    part = batch.slice(lo, len(offs) - 1)
                    got = encode_texts(t, [s or "" for s in part.column(at).to_pylist()])
                    ends = np.cumsum([0, *map(len, got)]) // 4
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(got), np.int32)))
                    yield pa.RecordBatch.from_arrays([*part.columns, ids], [*keep, ids_col])

        return src.mapInArrow(run, _with(src, ids_col, T.ArrayType(T.IntegerType())))

    def decode(self, docs: DataFrame, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
        """Add the text of the ids: the vocabulary has no decoder, so the tokens joined by one blank each, special
        ones and word ends included. A null array gives a null, an empty one an empty text, an id out of the
        vocabulary is left out. All other columns stay; one named as ``text_col`` is replaced."""
        keep = [c for c in docs.columns if c != text_col]
        src, shipped, at = docs.select(*[f"`{c}`" for c in keep]), self.tables, keep.index(ids_col)

        def run(batches):
            names = pa.array(shipped.value["names"], pa.large_string())
            for batch in batches:
                rows = max(1, (1 << 18) // max(1, len(batch.column(at).flatten()) // max(1, batch.num_rows)))
                for lo in range(0, batch.num_rows, rows):
                    part = batch.slice(lo, rows)
                    yield pa.RecordBatch.from_arrays([*part.columns, join_names(names, part.column(at)).cast(pa.string())], [*keep, text_col])

        return src.mapInArrow(run, _with(src, text_col, T.StringType()))


def join_names(names: pa.Array, lists: pa.Array) -> pa.Array:
    """Each list of ids as its tokens joined by one blank."""
    n, ids, null = len(lists), lists.flatten(), np.asarray(lists.is_null())
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64))])
    ids = np.asarray(pc.fill_null(ids, -1), np.int64)
    ok = (ids >= 0) & (ids < len(names))
    ends = np.concatenate([[0], np.cumsum(ok)])[ends]
    texts = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), names.take(pa.array(ids[ok])))
    joined = pc.binary_join(texts, pa.scalar(" ", pa.large_string()))
    return pc.if_else(pa.array(null), pa.scalar(None, pa.large_string()), joined) if n else pa.array([], pa.large_string())


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields] + [T.StructField(name, kind, True)])
