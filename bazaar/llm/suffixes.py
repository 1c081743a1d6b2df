"""Removal of repeated byte strings by suffix sorting.

Every 50-byte string that also starts in a document with a smaller id is removed from the later document.

A corpus has no suffix array in one piece here. Strings are first dealt out so that equal 50-byte windows meet:

1. Documents go to batches by a hash of their id. Every window has an anchor: the smallest hash of
   its 20-byte substrings. Consecutive windows with one anchor form a run, about one per 16 bytes. Each batch sends
   its distinct anchors, packed, to reducers, which send back those that occur in two documents or more.
2. For runs with such an anchor the batch cuts out the bytes that the run's windows cover. Of equal strings in
   one batch only the smallest document's goes on; the others are repeats already. Anchors that very many documents
   have are dealt by window instead of by anchor, so that no group grows with them.
3. Each group's strings are suffix-sorted in two stages: suffixes smaller than their successors are sorted directly,
   the others are induced from them by one scan over the buckets of first bytes. Adjacent common prefixes of 50
   bytes or more mark equal windows; all but the smallest document's are repeats.
4. Repeats return to their batch, where each document's ranges are merged and cut out.

The batches' exchange of the texts is planned once and used three times.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import textbytes as tb

SPAN = 50
GRAM = 20
BATCH_BYTES = 8 << 20
GROUP_BYTES = 2 << 20
SLICE = 1 << 18
#: an anchor is dealt by window if it has more documents than this and than a twentieth of a partition's anchors
HOT_DOCS = 1000
NO_ID = (1 << 63) - 1
_SEPARATOR = 0xFF  # no byte of UTF-8
_GRAM_BASE = np.uint64(0x9FB21C651E98DF25)


# --- suffix sorting in two stages --------------------------------------------------------------------------------

def _words(t: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a big-endian number; ``t`` must have eight bytes of padding."""
    return np.ndarray((len(t) - 7,), ">u8", t, strides=(1,))


def sort_by_prefix(t: np.ndarray, pos: np.ndarray, depth: int) -> np.ndarray:
    """``pos`` ordered by the ``depth`` bytes from there (stage one). ``t`` is padded by depth + 8 bytes."""
    words = _words(t)

    def key(p, r):
        w = words[p + 8 * r].astype(np.uint64)
        rest = depth - 8 * r
        return w if rest >= 8 else w & ~np.uint64((1 << (8 * (8 - rest))) - 1)

    w = key(pos, 0)
    order = np.argsort(w)
    pos, w = pos[order], w[order]
    first = np.ones(len(pos) + 1, bool)
    first[1:-1] = w[1:] != w[:-1]
    for r in range(1, -(-depth // 8)):
        tied = np.flatnonzero(~(first[:-1] & first[1:]))
        if not len(tied):
            break
        group = np.cumsum(first[tied])
        w = key(pos[tied], r)
        order = np.lexsort((w, group))
        pos[tied], w = pos[tied[order]], w[order]
        first[tied[1:]] |= w[1:] != w[:-1]
    return pos


def smaller_than_successor(t: np.ndarray) -> np.ndarray:
    """For every suffix, whether it is smaller than the one after it (the end counts as smallest)."""
    n = len(t)
    ends = np.append(np.flatnonzero(t[:-1] != t[1:]), n - 1)  # last of each run of equal bytes
    up = np.append(t[ends[:-1]] < t[ends[:-1] + 1], False)
    return np.repeat(up, np.diff(np.concatenate([[-1], ends])))


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The positions where ``wanted`` holds, ordered by the suffixes' first ``depth`` bytes (at least).

    Two stages: suffixes smaller than their successors are sorted directly; a suffix larger than its successor
    follows from the order of the successors, by scanning the buckets of first bytes in ascending order."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    t = np.zeros(n + depth + 16, np.uint8)
    t[:n] = text
    small = smaller_than_successor(text)
    # the induced ones need their successors, up to the next suffix that is sorted directly
    at_small = np.append(np.flatnonzero(small), n - 1)
    w = np.flatnonzero(wanted)
    stop = at_small[np.searchsorted(at_small, w)] if len(w) else w
    need = np.cumsum(np.bincount(w, minlength=n + 1) - np.bincount(stop + 1, minlength=n + 1))[:n] > 0
    direct = sort_by_prefix(t, np.flatnonzero(need & small), depth)
    induce = need & ~small
    heads = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if induce[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1]))
    out = []

    def deal(pred):
        c = text[pred]
        order = np.argsort(c, kind="stable")
        pred, c = pred[order], c[order]
        cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
        for part in np.split(pred, cuts):
            waiting[text[part[0]]].append(part)

    def before(pos):
        pred = pos[pos > 0] - 1
        return pred[induce[pred]]

    for c in range(256):
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        while len(front):
            out.append(front)
            pred = before(front)
            same = text[pred] == c
            if not same.all():
                deal(pred[~same])
            front = pred[same]
        part = direct[heads[c]:heads[c + 1]]
        if len(part):
            out.append(part)
            pred = before(part)
            if len(pred):
                deal(pred)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def adjacent_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix length of every suffix in ``order`` with the one before it, at most ``limit``; 0 for the first."""
    t = np.zeros(len(text) + limit + 16, np.uint8)
    t[:len(text)] = text
    words = _words(t)
    lcp = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for r in range(-(-limit // 8)):
        x = words[order[alive] + 8 * r].astype(np.uint64) ^ words[order[alive - 1] + 8 * r].astype(np.uint64)
        differ = x != 0
        first = (x[differ].byteswap().view(np.uint8).reshape(-1, 8) != 0).argmax(1)  # the first different byte
        lcp[alive[differ]] += first
        alive = alive[~differ]
        lcp[alive] += 8
    return np.minimum(lcp, limit)


# --- anchors -----------------------------------------------------------------------------------------------------

def window_anchors(buf: np.ndarray, span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """For every window of ``span`` bytes the smallest hash (48 bits) of its ``gram``-byte substrings."""
    if len(buf) < span:
        return np.zeros(0, np.uint64)
    h, size, acc, done = tb.BYTE_VALUE[buf], 1, None, 0
    base = int(_GRAM_BASE)
    rest = gram
    while rest:
        if rest & 1:  # append the block of this size to what is there
            if acc is None:
                acc, done = h, size
            else:
                n = len(h) - done
                acc = acc[:n] * np.uint64(pow(base, size, 1 << 64)) + h[done:]
                done += size
        rest >>= 1
        if rest:
            h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
            size *= 2
    g = acc[:len(buf) - gram + 1].copy()
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g >>= np.uint64(16)
    width, have = span - gram + 1, 1
    while have * 2 <= width:
        g = np.minimum(g[:-have], g[have:])
        have *= 2
    return np.minimum(g[:len(g) - (width - have)], g[width - have:]) if width > have else g


def anchor_runs(buf: np.ndarray, offs: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """Maximal runs of consecutive windows with one anchor: (anchor, first window, number of windows, text)."""
    a = window_anchors(buf, span, gram)
    n = np.diff(offs)
    last = offs[1:] - span  # last window of each text
    texts = np.flatnonzero(n >= span)
    inside = np.zeros(len(a) + 1, np.int64)
    inside[offs[texts]] += 1
    np.subtract.at(inside, last[texts] + 1, 1)
    ok = np.cumsum(inside[:-1]) > 0
    start = ok.copy()
    start[1:] &= (a[1:] != a[:-1]) | ~ok[:-1]
    start[offs[texts]] = True
    s = np.flatnonzero(start)
    text = np.searchsorted(offs, s, "right") - 1
    end = np.minimum(np.append(s[1:], len(a)), last[text] + 1)
    return a[s], s, end - s, text


def _pack(values: np.ndarray) -> bytes:
    """48-bit numbers, six bytes each."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _slices(table: pa.Table):
    """(first row, bytes, offsets) of a batch's texts."""
    yield from tb.slices(table.column("text").combine_chunks(), SLICE)


# --- the four steps -----------------------------------------------------------------------------------------------

def _send_anchors(parts: int, span: int, gram: int):
    """Per batch and reducer: the distinct anchors in ascending order and in how many documents each is (at most 65,535)."""
    def run(table: pa.Table) -> pa.Table:
        batch = table.column("batch")[0].as_py()
        kept = []
        for _, buf, offs in _slices(table):
            a, _, _, text = anchor_runs(buf, offs, span, gram)
            if len(a):
                order = np.lexsort((text, a))
                a, text = a[order], text[order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
                kept.append(np.unique(a[new], return_counts=True))
        if kept:
            a, inv = np.unique(np.concatenate([k[0] for k in kept]), return_inverse=True)
            n = np.minimum(np.bincount(inv, np.concatenate([k[1] for k in kept]), len(a)), 65535).astype(np.uint16)
        else:
            a, n = np.zeros(0, np.uint64), np.zeros(0, np.uint16)
        part = (a % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        a, n, part = a[order], n[order], part[order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        full = np.flatnonzero(np.diff(cuts))
        return pa.table({"part": pa.array(full, pa.int32()), "batch": pa.array([batch] * len(full), pa.int32()),
                         "anchors": pa.array([_pack(a[cuts[p]:cuts[p + 1]]) for p in full], pa.binary()),
                         "docs": pa.array([n[cuts[p]:cuts[p + 1]].tobytes() for p in full], pa.binary())})
    return run


def _find_shared(hot: int):
    """Per batch: its anchors that two documents or more have, and whether very many have them."""
    def run(table: pa.Table) -> pa.Table:
        lists = [_unpack(x.as_py()) for x in table.column("anchors")]
        a = np.concatenate(lists)
        n = np.frombuffer(b"".join(x.as_py() for x in table.column("docs")), np.uint16).astype(np.int64)
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(a, kind="stable")
        a, n, row = a[order], n[order], row[order]
        first = np.ones(len(a), bool)
        first[1:] = a[1:] != a[:-1]
        at = np.flatnonzero(first)
        docs = np.repeat(np.add.reduceat(n, at), np.diff(np.append(at, len(a))))
        keep = docs >= 2
        a, row, many = a[keep], row[keep], docs[keep] > hot
        order = np.argsort(row, kind="stable")
        a, row, many = a[order], row[order], many[order]
        cuts = np.searchsorted(row, np.arange(len(lists) + 1))
        full = np.flatnonzero(np.diff(cuts))
        return pa.table({"batch": table.column("batch").take(pa.array(full)), "anchors": pa.array([_pack(a[cuts[r]:cuts[r + 1]]) for r in full], pa.binary()),
                         "hot": pa.array([many[cuts[r]:cuts[r + 1]].tobytes() for r in full], pa.binary())})
    return run


def _freeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    raw = np.array([x.nbytes for x in arrays], np.int64).tobytes() + b"".join(x.tobytes() for x in arrays)
    return len(raw).to_bytes(8, "little") + _codec().compress(raw, asbytes=True)


def _thaw(block: bytes, *kinds) -> list[np.ndarray]:
    raw = _codec().decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    at = 8 * len(kinds) + np.cumsum(sizes) - sizes
    return [np.frombuffer(raw, k, n // np.dtype(k).itemsize, a) for k, n, a in zip(kinds, sizes.tolist(), at.tolist())]


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 1)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the spans, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _merge(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Union of ranges as ascending (start, end) pairs; ranges that touch become one."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return np.stack([s[at], e[np.append(at[1:], len(s)) - 1]], 1) if len(s) else np.zeros((0, 2), np.int64)


def _merged_block(row: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, digests: np.ndarray) -> bytes:
    """The union of the ranges of every row as a block: id, digest and number of ranges per row, then the ranges."""
    wide = row.astype(np.int64) << 32
    pairs = _merge(wide + starts, wide + ends)
    row = pairs[:, 0] >> 32
    rows, n = np.unique(row, return_counts=True)
    return _freeze(ids[rows].astype(np.int64), digests[rows].astype(np.int64), n.astype(np.int32), (pairs - (row << 32)[:, None]).astype(np.int32))


#: rows of strings: id and digest per document; per string the document, the number of starts and of windows; starts; bytes
_STRINGS, _STRING_KINDS = "bucket int, batch int, strings binary, ranges binary", (np.int64, np.int64, np.int32, np.int32, np.int32, np.int32, np.uint8)
_RANGES, _RANGE_KINDS = "batch int, ranges binary", (np.int64, np.int64, np.int32, np.int32)


def _cut_strings(groups: int, span: int, gram: int):
    """Per batch: the strings of its runs with shared anchors by group, and the ranges that repeat within the batch."""
    def run(key, table: pa.Table, shared: pa.Table) -> pa.Table:
        batch = key[0].as_py()
        if not table.num_rows or not shared.num_rows:
            return pa.table({k: [] for k in ("bucket", "batch", "strings", "ranges")}, pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("strings", pa.binary()), ("ranges", pa.binary())]))
        anchors = _unpack(b"".join(x.as_py() for x in shared.column("anchors")))
        many = np.frombuffer(b"".join(x.as_py() for x in shared.column("hot")), bool)
        order = np.argsort(tb.mix(anchors))
        known, many = tb.SortedHashes(tb.mix(anchors)[order]), many[order]
        ids, digests = table.column("doc").to_numpy(), table.column("digest").to_numpy()
        pw = tb.Powers()
        cols = {k: [] for k in ("anchor", "start", "windows", "row", "hash", "at")}
        texts, passed = [], 0
        for lo, buf, offs in _slices(table):
            a, s, n, text = anchor_runs(buf, offs, span, gram)
            at = known.find(tb.mix(a))
            hit = np.flatnonzero(at >= 0)
            a, s, n, text, hot = a[hit], s[hit], n[hit], text[hit], many[at[hit]]
            # windows with hot anchors stand alone and are dealt by their own hash
            each = np.where(hot, n, 1)
            row = np.repeat(np.arange(len(a)), each)
            shift = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            a, s, n, text, hot = a[row], s[row] + shift, np.where(hot, 1, n)[row], text[row], hot[row]
            h = tb.span_hash(tb.prefix_hash(buf, pw), s, s + n + span - 1, pw)
            for k, v in (("anchor", np.where(hot, h, tb.mix(a))), ("start", s - offs[text]), ("windows", n), ("row", lo + text), ("hash", h), ("at", passed + s)):
                cols[k].append(v)
            texts.append(buf)
            passed += len(buf)
        c = {k: np.concatenate(v) for k, v in cols.items()}
        whole = np.concatenate(texts)
        doc = ids[c["row"]]
        # equal strings side by side, the smallest document first
        order = np.lexsort((c["start"], c["row"], doc, c["hash"]))
        c, doc = {k: v[order] for k, v in c.items()}, doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = c["hash"][1:] != c["hash"][:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
        local = doc > doc[head]
        out = {"bucket": [batch % groups], "strings": [None], "ranges": [_merged_block(c["row"][local], c["start"][local], c["start"][local] + c["windows"][local] + span - 1, ids, digests)]} if local.any() else {"bucket": [], "strings": [], "ranges": []}
        # one entry per string and row of the smallest document, with all its starts there
        keep = np.flatnonzero(~local)
        lead = np.ones(len(keep), bool)
        lead[1:] = (c["hash"][keep[1:]] != c["hash"][keep[:-1]]) | (c["row"][keep[1:]] != c["row"][keep[:-1]])
        cut = np.append(np.flatnonzero(lead), len(keep))
        one, starts, times = keep[lead], c["start"][keep].astype(np.int32), np.diff(cut)
        bucket = (c["anchor"][one] % np.uint64(groups)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(groups + 1))
        for g in np.flatnonzero(np.diff(edge)).tolist():
            mine = order[edge[g]:edge[g + 1]]
            at = one[mine]
            rows, who = np.unique(c["row"][at], return_inverse=True)
            out["bucket"].append(g), out["ranges"].append(None)
            out["strings"].append(_freeze(ids[rows].astype(np.int64), digests[rows].astype(np.int64), who.astype(np.int32), times[mine].astype(np.int32), c["windows"][at].astype(np.int32),
                                          starts[_spread(cut[mine], times[mine])], whole[_spread(c["at"][at], c["windows"][at] + span - 1)]))
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "batch": pa.array([batch] * len(out["bucket"]), pa.int32()), "strings": pa.array(out["strings"], pa.binary()), "ranges": pa.array(out["ranges"], pa.binary())})
    return run


def _sort_group(span: int):
    """Per group of strings: for every batch the ranges of windows that a smaller document has too."""
    def run(table: pa.Table) -> pa.Table:
        batches, done = [], []
        parts: list[list[np.ndarray]] = []
        for b, strings, ranges in zip(table.column("batch").to_pylist(), table.column("strings"), table.column("ranges")):
            if strings.is_valid:
                parts.append([*_thaw(strings.as_py(), *_STRING_KINDS), b])
            else:
                batches.append(b), done.append(ranges.as_py())
        if parts:
            ids, digests, who, times, n, starts, data = (np.concatenate([p[i] for p in parts]) for i in range(7))
            n, times = n.astype(np.int64), times.astype(np.int64)
            counts = [len(p[0]) for p in parts]
            owner = np.repeat(np.arange(len(parts)), counts)  # of each document its part
            who = who + np.repeat(np.cumsum(counts) - counts, [len(p[2]) for p in parts])
            size = n + span - 1
            base = np.cumsum(size + 1) - size - 1
            text = np.full(int(size.sum()) + len(size), _SEPARATOR, np.uint8)
            text[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data
            mark = np.bincount(base, minlength=len(text) + 1) - np.bincount(base + n, minlength=len(text) + 1)
            order = suffix_order(text, np.cumsum(mark)[:len(text)] > 0, span)
            run_start = np.flatnonzero(adjacent_prefixes(text, order, span) < span)
            string = np.repeat(np.arange(len(size)), size + 1)
            doc = ids[who[string[order]]]
            least = np.repeat(np.minimum.reduceat(doc, run_start), np.diff(np.append(run_start, len(order))))
            again = np.sort(order[doc > least])
            if len(again):
                at = string[again]
                new = np.ones(len(again), bool)
                new[1:] = (again[1:] != again[:-1] + 1) | (at[1:] != at[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(again)) - 1
                at = at[first]
                a, b = again[first] - base[at], again[last] - base[at] + span
                shift = starts[_spread((np.cumsum(times) - times)[at], times[at])].astype(np.int64)
                row = np.repeat(who[at], times[at])
                a, b = shift + np.repeat(a, times[at]), shift + np.repeat(b, times[at])
                part = owner[row]
                by = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[by], np.arange(len(parts) + 1))
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    mine = by[cuts[i]:cuts[i + 1]]
                    batches.append(parts[i][7]), done.append(_merged_block(row[mine], a[mine], b[mine], ids, digests))
        return pa.table({"batch": pa.array(batches, pa.int32()), "ranges": pa.array(done, pa.binary())})
    return run


def _remove(key, table: pa.Table, repeats: pa.Table) -> pa.Table:
    """Per batch: every document's removed ranges and remaining bytes."""
    ranges: dict[tuple, list[np.ndarray]] = {}
    for block in repeats.column("ranges"):
        ids, digests, n, pairs = _thaw(block.as_py(), *_RANGE_KINDS)
        cuts = np.cumsum(2 * n) - 2 * n
        for d, g, c, k in zip(ids.tolist(), digests.tolist(), cuts.tolist(), n.tolist()):
            ranges.setdefault((d, g), []).append(pairs[c:c + 2 * k])
    kept, starts, ends, n = [], [], [], []
    docs, digests = table.column("doc").to_pylist(), table.column("digest").to_pylist()
    for lo, buf, offs in _slices(table):
        data = buf.tobytes()
        for i in range(len(offs) - 1):
            own = data[offs[i]:offs[i + 1]]
            n.append(len(own))
            if found := ranges.get((docs[lo + i], digests[lo + i])):
                pairs = np.concatenate(found).reshape(-1, 2).astype(np.int64)
                pairs = _merge(pairs[:, 0], pairs[:, 1])
                edge = [0, *pairs.ravel().tolist(), len(own)]
                own = b"".join(own[edge[j]:edge[j + 1]] for j in range(0, len(edge), 2))
                starts.append(pairs[:, 0].tolist()), ends.append(pairs[:, 1].tolist())
            else:
                starts.append([]), ends.append([])
            kept.append(own)
    return pa.table({"doc": table.column("doc"), "n_bytes": pa.array(n, pa.int64()), "starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())), "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, group_bytes: int = GROUP_BYTES, hot_docs: int = HOT_DOCS) -> DataFrame:
    """doc_id, n_bytes, starts and ends (removed byte ranges, ascending, not touching) and kept (binary) per row.

    Null text counts as empty. Rows with one id don't make each other's strings repeats; repeated rows give repeated
    results. A null id sorts after all others. An empty table gives an empty table. Other columns are not read.
    ``batch_bytes`` should grow with the cluster's memory (128 MB on large ones): anchors are sent once per batch."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    batches = max(1, -(-total // batch_bytes))
    # a twentieth to a half of all bytes come back in strings; groups of that stay near group_bytes
    groups = max(8, -(-total // (2 * group_bytes)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = max(hot_docs, total // 16 // parts // 20)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.select(F.pmod(F.hash("doc"), F.lit(batches)).cast("int").alias("batch"), "doc", F.xxhash64("text").alias("digest"), "text")
    sent = src.groupBy("batch").applyInArrow(_send_anchors(parts, span, gram), "part int, batch int, anchors binary, docs binary")
    shared = sent.groupBy("part").applyInArrow(_find_shared(hot), "batch int, anchors binary, hot binary")
    strings = src.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(_cut_strings(groups, span, gram), _STRINGS)
    repeats = strings.groupBy("bucket").applyInArrow(_sort_group(span), _RANGES)
    out = src.groupBy("batch").cogroup(repeats.groupBy("batch")).applyInArrow(_remove, "doc long, n_bytes long, starts array<long>, ends array<long>, kept binary")
    return out.select(F.nullif("doc", F.lit(NO_ID)).alias(id_col), "n_bytes", "starts", "ends", "kept")
