"""Near-duplicate groups: MinHash with banding, verification, and connected components by alternating stars.

1. Each text's set of distinct 5-word shingles gets ``BANDS * ROWS`` minima under universal hash functions.
   Texts with the same set share one node (the smallest id), found by grouping on a 128-bit digest of the set.
2. Nodes whose minima agree in a whole band meet in a bucket. Each bucket proposes its smallest node to all
   others, so a bucket of g nodes proposes g - 1 pairs.
3. A pair is verified by the signatures (two bits of every minimum; far below the threshold: dropped) and then on
   full sets.
4. Links are closed to components by alternating large-star and small-star steps.
5. Where a bucket's nodes are in several components, ``ROUNDS`` rounds propose another node of its first component to those
   outside it, which joins dense groups without comparing all their pairs. What is still apart after these
   is compared with all nodes of its buckets on full sets, block by block inside tasks. So every pair that shares
   a band is either verified or already in one component; no cap is set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import textbytes as tb
from bazaar.llm.shared import free_names, materialise

SHINGLE = 5
THRESHOLD = 75  # percent
BANDS, ROWS = 45, 5  # a pair at the threshold misses all bands with a probability of 5e-6
#: pairs with more minima that differ in their two lowest bits go without a look at the sets: at the threshold
#: 42 of 225 differ on average, and this is over five standard deviations more
MOST_DIFFERENT = 74
ROUNDS = 1
BLOCK = 500
NO_ID = (1 << 63) - 1

_rng = np.random.Generator(np.random.PCG64(977))
_A = _rng.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, pw: tb.Powers, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every text, text by text, and the offsets of the texts.

    A text with fewer words than ``size`` has its whole sequence as its one shingle, one without words none."""
    nd = len(offs) - 1
    low = tb.LOWER[buf]
    starts, ends, woffs = tb.words(low, offs, tb.SPACE_WORD)
    wh = tb.span_hash(tb.prefix_hash(low, pw), starts, ends, pw)
    wdoc = np.repeat(np.arange(nd), np.diff(woffs))
    h = tb.combine(wh, size)
    inside = wdoc[:len(h)] == wdoc[size - 1:] if len(h) else np.zeros(0, bool)
    h, doc = h[inside], wdoc[:len(inside)][inside]
    short = np.flatnonzero((np.diff(woffs) > 0) & (np.diff(woffs) < size))
    if len(short):
        n = np.diff(woffs)[short]
        whole = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            more = n > j
            whole[more] = tb.mix(whole[more] * np.uint64(0x9E3779B97F4A7C15) + wh[woffs[short[more]] + j] + np.uint64(j + 1))
        h, doc = np.concatenate([h, whole]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    _, first = np.unique(tb.mix(h ^ tb.mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True)
    first.sort()
    return h[first], np.searchsorted(doc[first], np.arange(nd + 1))


def minima(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The signature of every non-empty set: (sets, BANDS * ROWS) uint32."""
    full = np.flatnonzero(np.diff(offs) > 0)
    out = np.empty((len(full), len(_A)), np.uint32)
    if not len(full):
        return out
    at = offs[:-1][full]
    v, w = np.empty(len(h), np.uint64), np.empty(len(h), np.uint32)
    for j in range(len(_A)):
        np.multiply(h, _A[j], out=v)
        v += _B[j]
        np.right_shift(v, np.uint64(32), out=w, casting="unsafe")
        out[:, j] = np.minimum.reduceat(w, at)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: (sets, BANDS)."""
    keys = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        keys = tb.mix(keys * np.uint64(0x2545F4914F6CDD1D) + sig[:, r::ROWS].astype(np.uint64) + np.uint64(r + 1))
    return tb.mix(keys + (np.arange(BANDS, dtype=np.uint64) << np.uint64(32)))


SKETCH = [f"s{i}" for i in range(-(-BANDS * ROWS // 32))]


def sketches(sig: np.ndarray) -> np.ndarray:
    """The two lowest bits of every minimum, 32 to a word: (sets, len(SKETCH)) int64."""
    two = np.zeros((len(sig), 32 * len(SKETCH)), np.uint64)
    two[:, :sig.shape[1]] = sig & np.uint32(3)
    two = two.reshape(len(sig), len(SKETCH), 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(two, 2).view(np.int64)


def different_minima(x: str, y: str):
    """How many minima differ in their two lowest bits, from the sketch columns of two sides."""
    total = F.lit(0)
    for c in SKETCH:
        d = F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))
        total = total + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _digests(h: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums that depend on the set alone."""
    full = np.flatnonzero(np.diff(offs) > 0)
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        d = np.zeros(len(offs) - 1, np.uint64)
        if len(full):
            d[full] = np.add.reduceat(tb.mix(h ^ np.uint64(salt)), offs[:-1][full])
        out.append(d.view(np.int64))
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """_id, n_shingles, d1, d2 (digest of the set), bands and sketch of every row; docs: _id, _text."""
    def run(batches):
        pw = tb.Powers()
        for batch in batches:
            ids = batch.column(0)
            for lo, buf, offs in tb.slices(batch.column(1)):
                h, so = shingle_sets(buf, offs, pw)
                n = np.diff(so)
                sig = minima(h, so)
                keys = band_keys(sig).view(np.int64)
                sketch = np.zeros((len(n), len(SKETCH)), np.int64)
                sketch[n > 0] = sketches(sig)
                d1, d2 = _digests(h, so)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((n > 0) * BANDS)]).astype(np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, len(n)), pa.array(n.astype(np.int64)), pa.array(d1), pa.array(d2), lists, *[pa.array(x) for x in sketch.T]], ["_id", "n_shingles", "d1", "d2", "bands", *SKETCH])
    return docs.mapInArrow(run, "_id long, n_shingles long, d1 long, d2 long, bands array<long>" + "".join(f", {c} long" for c in SKETCH))


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures may reach the threshold; nodes: node and sketch."""
    x, y = nodes.withColumnRenamed("node", "a").alias("x"), nodes.withColumnRenamed("node", "b").alias("y")
    return pairs.join(x, "a").join(y, "b").where(different_minima("x", "y") <= MOST_DIFFERENT).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; texts: node, _text."""
    def confirm(batches):
        pw = tb.Powers()
        for batch in batches:
            sides = []
            for c in (2, 3):
                sets = []
                for _, buf, offs in tb.slices(batch.column(c)):
                    h, so = shingle_sets(buf, offs, pw)
                    sets += [h[x:y] for x, y in zip(so[:-1], so[1:])]
                sides.append(sets)
            keep = []
            for x, y in zip(*sides):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(list(batch.filter(pa.array(keep, pa.bool_())).columns[:2]), ["a", "b"])

    heads = texts.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
    full = pairs.join(texts.select(F.col("node").alias("b"), F.col("_text").alias("y")), "b").join(heads.select(F.col("node").alias("a"), F.col("_text").alias("x")), "a")
    return full.select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Connect every node's larger neighbours to its smallest one. edges: u, v."""
    around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Connect every node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link. links: a, b.

    Stops when a round changes nothing; then every node is linked to the smallest of its component only."""
    edges = materialise(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "stars")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    seen = None
    while True:
        edges = materialise(small_star(large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        seen = now


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Null and empty texts and texts without words have no shingles and are alone. Rows with one id are one document
    to the links. Null ids count as one id after all others and come back as null. An empty table gives an empty table.
    Other columns are not read."""
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.col(text_col).alias("_text"))
    rows = materialise(signatures(src), "minhash-rows")
    # texts that share their set; written, so that a large group of copies can be split in the join
    first = rows.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("_id").alias("node"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = materialise(first, "minhash-copies")
    member = materialise(rows.join(first, ["d1", "d2"], "left").select("_id", "n_shingles", F.coalesce("node", "_id").alias("node"), F.when(F.coalesce("node", "_id") == F.col("_id"), F.col("bands")).alias("bands"), *SKETCH), "minhash-nodes")
    comp, links = near_links(member, src)
    # several rows under one id with different texts are one document
    several = member.groupBy("_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("_id")
    links = links.union(member.join(several, "_id").where("node <> _id").select(F.col("node").alias("a"), F.col("_id").alias("b")).distinct())
    out = member.select("_id", "n_shingles", "node").join(_joined(comp, links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return out.select(F.nullif("_id", F.lit(NO_ID)).alias(id_col), "n_shingles", F.nullif("component", F.lit(NO_ID)).alias("component_id"), (F.col("_id") == F.col("component")).alias("kept"))


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links between nodes: only components are joined, so the graph stays small."""
    named = comp.withColumnRenamed("component", "c")
    ends = links.join(named.withColumnRenamed("node", "a"), "a", "left").withColumn("u", F.coalesce("c", "a")).drop("c")
    ends = ends.join(named.withColumnRenamed("node", "b"), "b", "left").withColumn("v", F.coalesce("c", "b"))
    onward = components(ends.select(F.col("u").alias("a"), F.col("v").alias("b")))
    moved = comp.withColumnRenamed("component", "old").join(onward.withColumnRenamed("node", "old"), "old", "left").select("node", F.coalesce("component", "old").alias("component"))
    # nodes that had no link before
    return materialise(moved.union(onward.join(comp, "node", "left_anti").select("node", "component")), "minhash-components")


def near_links(member: DataFrame, src: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components (node, component) from verified links between nodes with different sets, and links (a, b) that join them further."""
    spread = member.where("bands IS NOT NULL").select("node", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").select("key", "head")
    bucket = materialise(spread.join(shared, "key"), "minhash-buckets")
    nodes = bucket.select("node").distinct()
    sketch = materialise(member.where("bands IS NOT NULL").select("node", *SKETCH).join(nodes, "node", "left_semi"), "minhash-sketches")
    first = bucket.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    tested = materialise(_likely(first, sketch), "minhash-pairs")
    if tested.isEmpty():
        return tested.select(F.col("a").alias("node"), F.col("b").alias("component")), tested
    texts = materialise(src.withColumnRenamed("_id", "node").join(nodes, "node", "left_semi"), "minhash-texts")
    links = materialise(_verified(tested, texts), "minhash-links")
    comp = materialise(components(links), "minhash-components")
    bucket = bucket.select("key", "node")
    for r in range(ROUNDS):
        mixed = _mixed_buckets(bucket, comp, r)
        apart = mixed.where("comp <> main").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        pairs = materialise(_likely(apart.join(tested, ["a", "b"], "left_anti"), sketch), "minhash-pairs")
        tested = tested.union(pairs)
        comp = _joined(comp, _verified(pairs, texts))
    return comp, _links_by_block(_mixed_buckets(bucket, comp, ROUNDS), texts)


def _mixed_buckets(bucket: DataFrame, comp: DataFrame, r: int) -> DataFrame:
    """The buckets with nodes of several components: key, node, comp, main (the first component) and pivot (one of its nodes, by the round)."""
    placed = bucket.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    pivot = F.min(F.struct("comp", F.xxhash64("node", F.lit(r)).alias("h"), "node"))
    several = placed.groupBy("key").agg(pivot.alias("pivot"), F.max("comp").alias("last")).where("pivot.comp < last")
    return materialise(placed.join(several, "key").select("key", "node", "comp", F.col("pivot.comp").alias("main"), F.col("pivot.node").alias("pivot")), "minhash-placed")


def _links_by_block(mixed: DataFrame, texts: DataFrame) -> DataFrame:
    """All links between a node outside its buckets' main component and any node of these buckets.

    The nodes around a main component are dealt to blocks of about ``BLOCK``, those outside it also to chunks of that size;
    every block meets every chunk in a task of its own and is compared with it on full sets, through a sorted list
    of the block's shingles. Only links leave the task."""
    around = mixed.select("main", "node", "comp").distinct()
    away = F.sum((F.col("comp") != F.col("main")).cast("int"))
    blocks = around.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n"), F.ceil(away / BLOCK).cast("int").alias("m"))
    around = around.join(blocks.where("m > 0"), "main").join(texts, "node")
    dealt = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = around.select("main", dealt("block", "n").alias("block"), every("m").alias("chunk"), "node", "comp", "_text")
    outside = around.where("comp <> main").select(F.col("main").alias("to"), every("n").alias("to_block"), dealt("chunk", "m").alias("of_chunk"),
                                                  F.col("node").alias("u"), F.col("comp").alias("u_comp"), F.col("_text").alias("u_text"))

    def sets_of(column):
        pw, hashes, sizes = tb.Powers(), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, buf, offs in tb.slices(column.combine_chunks()):
            h, so = shingle_sets(buf, offs, pw)
            hashes.append(h), sizes.append(np.diff(so))
        return np.concatenate(hashes), np.concatenate(sizes)

    def compare(key, left, right):
        h, n = sets_of(left.column("_text"))
        owner = np.repeat(np.arange(len(n)), n)
        order = np.argsort(h)
        h, owner = h[order], owner[order]
        ids, comps = left.column("node").to_numpy(), left.column("comp").to_numpy()
        uh, un = sets_of(right.column("u_text"))
        cut = np.concatenate([[0], np.cumsum(un)])
        a, b = [], []
        for i, (u, c) in enumerate(zip(right.column("u").to_pylist(), right.column("u_comp").to_pylist())):
            mine = uh[cut[i]:cut[i + 1]]
            lo, hi = np.searchsorted(h, mine), np.searchsorted(h, mine, "right")
            size = hi - lo
            at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            both = np.bincount(owner[at], minlength=len(n))
            hit = np.flatnonzero((100 * both >= THRESHOLD * (n + un[i] - both)) & (comps != c))
            a += [u] * len(hit)
            b += ids[hit].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    found = here.groupBy("main", "block", "chunk").cogroup(outside.groupBy("to", "to_block", "of_chunk")).applyInArrow(compare, "a long, b long")
    return materialise(found.distinct(), "minhash-links")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all columns.

    Of rows with one id the smallest in column order stays."""
    groups = materialise(near_duplicate_groups(docs, id_col, text_col).select(F.coalesce(F.col(id_col), F.lit(NO_ID)).alias("_doc"), "kept"), "minhash-groups")
    doc, = free_names(docs.columns, "_doc")
    again = groups.groupBy("_doc").count().where("count > 1").select("_doc")
    gone = groups.where("NOT kept").select("_doc").distinct()
    keyed = docs.withColumn(doc, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
    single = keyed.join(gone.union(again).distinct().withColumnRenamed("_doc", doc), doc, "left_anti").select(*docs.columns)
    several = keyed.join(again.join(gone, "_doc", "left_anti").withColumnRenamed("_doc", doc), doc, "left_semi")
    return single.union(several.groupBy(doc).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))
