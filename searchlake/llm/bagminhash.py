"""Operator 4, near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, verified overlap.

A document is a multiset of word 5-shingles. ``signatures`` draws, for every shingle, points of a
Poisson process over (weight, time): the weight axis is cut into dyadic ranges [0,1), [1,2), [2,4), ...;
a range that lies below the shingle's count contributes all its points, the range that holds the
count only the points whose discretised weight lies below it. Each point also draws one of the
``m`` signature components; a component keeps the earliest point over all shingles. Points of
a shingle do not depend on the document, so two documents agree in a component with probability equal to
their weighted Jaccard similarity. Points come in time order, and a shingle stops as soon as its next
point is later than the document's latest component, which costs O(shingles + m log m) instead of their product.

Plan: equal word sequences are one node (md5 of the words), so copies never meet as pairs. Nodes that share
a band (``rows`` components) are candidates. In a band's bucket each node is compared with the smallest node (a star, not
all pairs), and only when the two are not linked already through others:
(1) every node with the hub it shares most bands with; (2) the remaining star edges between different components;
(3) in buckets that still hold several components, all members of different components: in buckets of at most
``SMALL`` as pairs, in larger ones in blocks, where one matrix product counts the overlaps of a chunk of members with another
chunk, and only links that join components come out. So every pair of candidates is either verified or already in one
class, whatever the bucket's size, and no link is lost; chunks bound the memory, and a large bucket is dealt
over many tasks. Verification is exact: multiset overlap of the shingles of both texts.
Pairs whose sizes alone exclude the threshold are not compared. Components are found by label propagation with
pointer jumping over written edge tables.

Words are maximal runs of ASCII letters and digits and of any non-ASCII characters, lower-cased.

Defined results: texts of one to four words have one shingle of all their words; texts without words are
near-duplicates only of equal texts; null counts as empty; null ids sort last; of rows with one id and text exactly one is
kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, release_memory, ship_package, stage, text_or_empty

SHINGLE = 5
BANDS, ROWS = 24, 4
THRESHOLD = (4, 5)  # similarity of at least 4/5
PART_BYTES = 1 << 20
SMALL = 24
CHUNK_DOCS, CHUNK_ITEMS = 512, 400_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE, _BASE_INVERSE = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit scrambler."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _step(turn: int) -> np.uint64:
    return np.uint64(turn * int(_A) & 0xFFFFFFFFFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the text each belongs to."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    word = _WORD[raw]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)), dtype=np.uint64)])
    h = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(raw) + 1)[starts]
    stops = np.cumsum([len(t) + 1 for t in texts])
    return mix(h + (ends - starts).astype(np.uint64) * _A), np.searchsorted(stops, starts, side="right")


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All 5-word shingles, the text each belongs to, and every text's key (md5 of its word sequence)."""
    h, doc = word_hashes(texts)
    n = np.bincount(doc, minlength=len(texts))
    stop = np.cumsum(n)
    keys = []
    for text, a, b in zip(texts, (stop - n).tolist(), stop.tolist(), strict=True):
        keys.append(hashlib.md5(h[a:b].tobytes() if a < b else b"no words:" + text).digest())
    if not len(h):
        return h, doc, keys
    place = np.arange(len(h)) - (stop - n)[doc]
    first = np.flatnonzero((place + SHINGLE <= n[doc]) | ((place == 0) & (n[doc] < SHINGLE)))
    out = np.zeros(len(first), np.uint64)
    for j in range(SHINGLE):
        at = np.minimum(first + j, len(h) - 1)
        inside = (place[first] + j) < n[doc[first]]
        out = mix(out * _A + np.where(inside, h[at], np.uint64(j + 1)))
    return out, doc[first], keys


def counted(items: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, item) with their counts, sorted."""
    order = np.lexsort((items, doc))
    items, doc = items[order], doc[order]
    new = np.ones(len(items), bool)
    new[1:] = (items[1:] != items[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return items[at], doc[at], np.diff(at, append=len(items))


def _ranges(items: np.ndarray, doc: np.ndarray, count: np.ndarray):
    """Cut each item's weight [0, count) into dyadic ranges: seed, doc, width, part below the count."""
    low, width, out = 0, 1, []
    while True:
        here = np.flatnonzero(count > low)
        if not len(here):
            break
        seed = mix(items[here] + _step(low) + _C)
        out.append((seed, doc[here], np.full(len(here), width, np.int64), np.minimum(count[here] - low, width)))
        low, width = low + width, max(1, low + width)
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.uint64)] + [np.zeros(0, np.int64)] * 3


def signatures(items: np.ndarray, doc: np.ndarray, count: np.ndarray, docs: int, m: int, burst: int) -> np.ndarray:
    """BagMinHash signatures [docs, m] of weighted items; rows of texts without items are infinite."""
    seed, doc, width, below = _ranges(items, doc, count)
    sig = np.full(docs * m, np.inf)
    time, turn = np.zeros(len(seed)), 0
    rate = width.astype(float)
    while len(seed):
        for _ in range(burst):  # the next points of every open process
            turn += 1
            h = mix(seed + _step(turn))
            time = time - np.log(((h >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / rate
            pick = mix(h ^ _C)
            part = ((pick >> np.uint64(40)) * np.uint64(m)) >> np.uint64(24)
            ok = ((pick & np.uint64(0xFFFFFF)).astype(np.int64) * width >> 24) < below
            np.minimum.at(sig, doc[ok] * m + part[ok].astype(np.int64), time[ok])
        latest = sig.reshape(docs, m).max(1)
        go = np.flatnonzero(time < latest[doc])
        seed, doc, width, below, time, rate = (a[go] for a in (seed, doc, width, below, time, rate))
    return sig.reshape(docs, m)


def band_keys(texts: list[bytes], bands: int = BANDS, rows: int = ROWS):
    """Per text: key, number of shingles (with repeats), band keys (none without words)."""
    items, doc, keys = shingles(texts)
    size = np.bincount(doc, minlength=len(texts))
    item, owner, count = counted(items, doc)
    sig = np.full((len(texts), bands * rows), np.inf)
    distinct = np.bincount(owner, minlength=len(texts))
    for some, burst in ((distinct >= 64, 1), (distinct < 64, 16)):
        names = np.flatnonzero(some & (distinct > 0))
        if len(names):
            place = np.full(len(texts), -1)
            place[names] = np.arange(len(names))
            mine = some[owner]
            sig[names] = signatures(item[mine], place[owner[mine]], count[mine], len(names), bands * rows, burst)
    parts = np.ascontiguousarray(sig).view(np.uint64).reshape(len(texts), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _A, (len(texts), bands)).copy()
    for r in range(rows):
        out = mix(out * _A + parts[:, :, r])
    return keys, size, [o if n else o[:0] for o, n in zip(out.view(np.int64), size.tolist(), strict=True)]


def signed_docs(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, node, n, bands."""
    def run(batches):
        for b in batches:
            for lo, hi in byte_groups(b.column(1), PART_BYTES):
                texts = [t.encode() for t in b.column(1).slice(lo, hi - lo).to_pylist()]
                keys, size, bands = band_keys(texts)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column(0).slice(lo, hi - lo), "node": pa.array(keys, pa.binary()),
                    "n": pa.array(size, pa.int64()), "bands": pa.array(bands, pa.list_(pa.int64()))})

    return docs.select("doc_id", F.lower("text")).mapInArrow(run, "doc_id long, node binary, n long, bands array<long>")


def bags_of(docs: DataFrame) -> DataFrame:
    """docs(text) -> node, bag: the sorted shingles, the j-th repeat of a shingle as an item of its own."""
    def run(batches):
        for b in batches:
            for lo, hi in byte_groups(b.column(0), PART_BYTES):
                texts = [t.encode() for t in b.column(0).slice(lo, hi - lo).to_pylist()]
                items, doc, keys = shingles(texts)
                item, owner, count = counted(items, doc)
                item, owner = np.repeat(item, count), np.repeat(owner, count)
                nth = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
                item = np.where(nth > 0, mix(item + nth.astype(np.uint64) * _B), item)
                order = np.lexsort((item, owner))
                raw = item[order].tobytes()
                stop = np.cumsum(np.bincount(owner, minlength=hi - lo)) * 8
                bags = [raw[a:z] for a, z in zip([0, *stop.tolist()], stop.tolist(), strict=False)]
                yield pa.RecordBatch.from_pydict({"node": pa.array(keys, pa.binary()), "bag": pa.array(bags, pa.binary())})

    return docs.select(F.lower("text")).mapInArrow(run, "node binary, bag binary")


def verified(pairs: DataFrame, bags: DataFrame, name: str) -> DataFrame:
    """pairs(a, b) -> a, b, linked: whether the multiset overlap reaches the threshold."""
    num, den = THRESHOLD

    def run(batches):
        for b in batches:
            same = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(both * den >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same, pa.bool_())], ["a", "b", "linked"])

    first = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    second = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    met = pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b").select("a", "b", "bag_a", "bag_b")
    return stage(met.mapInArrow(run, "a binary, b binary, linked boolean"), name)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of the overlaps of every left with every right bag, by products of 0/1 matrices."""
    n = np.array([len(x) for x in left + right])
    _, code, count = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(n)), n)
    shared = count[code] > 1  # the others add nothing
    place = np.cumsum(count > 1) - 1
    row, code = row[shared], place[code[shared]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        a, z = np.searchsorted(code, (low, low + 4096))
        ones = np.zeros((len(n), 4096), np.float32)
        ones[row[a:z], code[a:z] - low] = 1
        out += ones[:len(left)] @ ones[len(left):].T
    return out.astype(np.int64)


def block_links(members: DataFrame, bags: DataFrame) -> DataFrame:
    """members(band, node, n, class, size, items) of large buckets -> links (a, b) between different classes."""
    num, den = THRESHOLD

    def run(group: pd.DataFrame) -> pd.DataFrame:
        first, second = (group[group["chunk"] == group[c].iloc[0]] for c in ("i", "j"))
        if group["class"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []})
        x, y = ([np.frombuffer(b, np.uint64) for b in g["bag"]] for g in (first, second))
        both = overlaps(x, y)
        total = np.array([len(b) for b in x])[:, None] + np.array([len(b) for b in y])[None, :]
        cx, cy = first["class"].to_numpy(), second["class"].to_numpy()
        at = np.argwhere(both * den >= num * (total - both))
        del both, total
        release_memory()
        links: dict[tuple, tuple] = {}  # one link for two classes is enough
        for r, s in at.tolist():
            if cx[r] != cy[s]:
                links.setdefault((min(cx[r], cy[s]), max(cx[r], cy[s])), (r, s))
        return pd.DataFrame([(first["node"].iat[r], second["node"].iat[s]) for r, s in links.values()], columns=["a", "b"])

    chunks = F.greatest(F.ceil(F.col("size") / CHUNK_DOCS), F.ceil(F.col("items") / CHUNK_ITEMS)).cast("int")
    placed = members.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    met = (placed.join(bags.hint("merge"), "node")
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .select("band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "node", "class", "bag"))
    return met.groupBy("band", "i", "j").applyInPandas(run, "a binary, b binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """edges(a, b) -> node, class: the smallest node that each node is connected with."""
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    label = stage(both.groupBy("a").agg(F.min("b").alias("c")).select(F.col("a").alias("node"), F.least("a", "c").alias("class")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = (both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("class").alias("near"))
                .select(F.col("a").alias("node"), "near"))
        step = label.join(near, "node").select("node", "class", F.least("class", "near").alias("to"))
        jump = label.select(F.col("node").alias("to"), F.col("class").alias("jump"))
        new = stage(step.join(jump, "to").select("node", F.col("class").alias("old"), F.least("to", "jump").alias("class")), f"{name}-{turn}")
        if not new.where("old != class").limit(1).count():
            return new.select("node", "class")
        label = new.select("node", "class")


def relabel(label: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """label(node, class) after joining the classes that edges(a, b) connect."""
    over = components(_classes(edges, label).select("class_a", "class_b").toDF("a", "b"), name)
    return stage(label.join(over.toDF("class", "to"), "class", "left").select("node", F.coalesce("to", "class").alias("class")), f"{name}-label")


def _classes(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """pairs(a, b) with both ends' classes, where these differ."""
    return (pairs.join(label.toDF("a", "class_a"), "a").join(label.toDF("b", "class_b"), "b").where("class_a != class_b"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), class_size, kept."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    signed = stage(signed_docs(docs.withColumn("doc_id", F.col("doc_id").cast("long"))), "op4-signed")
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    banded = stage(nodes.select("node", "doc_id", "n", F.explode("bands").alias("band")), "op4-banded")
    hub = F.min(F.struct("node", "n"))
    shared = stage(banded.groupBy("band").agg(hub.alias("h"), F.count(F.lit(1)).alias("size")).where("size > 1")
                   .select("band", F.col("h.node").alias("hub"), F.col("h.n").alias("n_hub"), "size"), "op4-shared")
    member = stage(banded.join(shared, "band").select("band", "hub", "n_hub", "node", "doc_id", "n", "size"), "op4-members")

    # a pair is worth a comparison only if the sizes allow the threshold
    num, den = THRESHOLD
    fits = lambda x, y: F.least(x, y) * den >= F.greatest(x, y) * num
    star = stage(member.where("node != hub").where(fits(F.col("n"), F.col("n_hub")))
                 .groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("bands")), "op4-star")
    asked = member.groupBy("node").agg(F.first("doc_id").alias("doc_id"))
    texts = docs.join(asked.select("doc_id").distinct().hint("merge"), docs["doc_id"].eqNullSafe(asked["doc_id"]), "left_semi")
    bags = stage(bags_of(texts).join(asked.select("node"), "node", "left_semi").groupBy("node").agg(F.first("bag").alias("bag")), "op4-bags")

    # 1: each node with its closest hub
    best = star.groupBy("b").agg(F.max_by("a", F.struct("bands", "a")).alias("a")).select("a", "b")
    seen = verified(best, bags, "op4-first")
    label = asked.select("node", F.col("node").alias("class"))
    label = relabel(stage(label, "op4-label"), seen.where("linked"), "op4-1")
    # 2: the other star edges between classes
    rest = _classes(star.select("a", "b"), label).select("a", "b").join(seen, ["a", "b"], "left_anti")
    more = verified(rest, bags, "op4-second")
    seen = seen.unionByName(more)
    label = relabel(label, more.where("linked"), "op4-2")
    # 3: buckets that still hold several classes
    placed = stage(member.select("band", "node", "n", "size").join(label, "node"), "op4-placed")
    largest = (placed.groupBy("band", "class").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("items"))
               .groupBy("band").agg(F.max_by("class", F.struct("k", "class")).alias("main"), F.count(F.lit(1)).alias("classes"),
                                 F.sum("items").alias("items"))
               .where("classes > 1").select("band", "main", "items"))
    mixed = stage(placed.join(largest, "band"), "op4-mixed")
    small = mixed.where(F.col("size") <= SMALL)
    minor = small.where("class != main").select("band", F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("class").alias("class_x"))
    cross = (minor.join(small.drop("main", "items", "size"), "band").where("class != class_x").where(fits(F.col("n"), F.col("n_x")))
             .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
             .join(seen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    last = verified(cross, bags, "op4-third")
    large = stage(block_links(mixed.where(F.col("size") > SMALL), bags), "op4-blocks")
    label = relabel(label, last.where("linked").select("a", "b").unionByName(large), "op4-3")

    grouped = stage(signed.join(label, "node", "left").select("doc_id", F.coalesce("class", "node").alias("class")), "op4-classes")
    classes = stage(grouped.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "op4-sizes")
    rows = grouped.join(classes, "class")
    others = rows.where("not (doc_id <=> class_id)").withColumn("kept", F.lit(False))
    # the rows that carry the class's id: one of them stays
    stays = (rows.where("doc_id <=> class_id").groupBy("class", "doc_id", "class_id", "class_size").agg(F.count(F.lit(1)).alias("m"))
             .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m")))).withColumn("kept", F.col("i") == 1))
    cols = ["doc_id", "class_id", "class_size", "kept"]
    return others.select(cols).unionByName(stays.select(cols))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with the input's columns. Rows equal in id and text count once; where one id stands for
    different texts, all texts of a kept id stay."""
    key = "_kept_key"
    while key in docs.columns:
        key += "_"
    not_null = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1 << 63)).alias(key)
    kept = stage(near_dedup(docs, id_col, text_col).where("kept").select(not_null("doc_id")).distinct(), "op4-kept")
    # one shuffle of the texts by the key serves the join and the removal of equal rows
    rows = docs.select("*", not_null(id_col)).join(kept.hint("merge"), key, "left_semi")
    return rows.dropDuplicates([key, text_col]).select(*docs.columns)
