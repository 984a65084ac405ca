"""Operator 13, benchmark decontamination with a generalised suffix automaton of the test items.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. A window is ``n`` consecutive words of an item;
an item of fewer words, but not none, is one window. A document word inside any occurrence of a window is hit.

1. Items are cut into pieces of at most ``PIECE_WORDS`` words that overlap by ``n - 1`` (so no window is lost), and the pieces
   are dealt to shards of about ``SHARD_WORDS`` words. A task builds one shard's automaton: states with their length and suffix
   link, transitions as sorted arrays, for every state that ends a window of ``n`` words the items that hold it, and
   the whole short items that end in it.
2. Documents are streamed past the automaton, which follows their words and tracks the longest match that ends at each word
   (on a mismatch it falls back along the suffix links). Where the match is at least ``n`` long, the last ``n`` words are hit; where
   a whole short item ends, its words are. Stretches without a chance are skipped: every window of m words is a run of
   m - g + 1 known word g-grams, and a bitmap of the items' g-grams (which errs on one side only) shows the runs that are long
   enough; the automaton decides all of them.

One shard is held by the driver and broadcast at a time, so its size is bounded by ``SHARD_WORDS``; a larger benchmark gives
more shards, and documents pass them one after another, carrying what was found so far (no shuffle, no join; the rows are
written after every ``SHARDS_A_PASS``).

``remove_leaks`` takes spans of at least ``min_span`` hit words out of the texts, and drops documents of which more than
``max_coverage`` is hit.

Defined results: null texts have no words; an item without words has no window; rows of one item id are one item; a null
item id counts as the empty string; equal documents are judged alike and stay separate rows; null document ids stay; an empty
benchmark leaves all documents clean; very long texts are cut into words piece by piece; extra columns stay.
"""

from __future__ import annotations

import pickle
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import byte_groups, release_memory, ship_package, stage, text_or_empty

N = 10
SHARD_WORDS = 200_000
PIECE_WORDS = 20_000
SHARDS_A_PASS = 4
GRAM = 3
CUT = 1 << 20
#: Limits of ``remove_leaks``: hit words in a row, and the share of a document's words.
MIN_SPAN = 10
MAX_COVERAGE = 0.5

# bytes to word bytes: A-Z lower-cased, everything that is not in a word to a space
_WORDS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))
FOUND = "struct<n_words: long, n_hit: long, longest: long, spans: array<struct<from: long, to: long>>, items: array<string>>"


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, some at a time."""
    data = data.translate(_WORDS)
    at = 0
    while at < len(data):
        stop = len(data) if len(data) - at <= CUT else data.rfind(b" ", at, at + CUT)
        if stop < at:  # one word longer than CUT
            stop = data.find(b" ", at)
            stop = len(data) if stop < 0 else stop
        if stop > at:
            yield data[at:stop].split()
        at = stop + 1


def word_ids(data: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The text's words as numbers of the vocabulary, -1 for others."""
    get = vocabulary.get
    parts = [np.fromiter([get(w, -1) for w in some], np.int32, len(some)) for some in words_of(data)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


# --- the automaton ---------------------------------------------------------------------------------

def build_automaton(items: list[tuple[str, list[bytes]]], n: int) -> dict:
    """items (item id, words) -> the generalised suffix automaton as flat arrays."""
    vocabulary: dict[bytes, int] = {}
    texts = [(item, [vocabulary.setdefault(w, len(vocabulary)) for w in words]) for item, words in items if words]
    go: list[dict[int, int]] = [{}]
    length, link = [0], [-1]

    def new_state(size: int, to: dict[int, int], suffix: int) -> int:
        go.append(to)
        length.append(size)
        link.append(suffix)
        return len(go) - 1

    def split(p: int, c: int, q: int) -> int:
        """The state of the longest string of ``p`` and one more ``c``, taken out of ``q``."""
        if length[p] + 1 == length[q]:
            return q
        clone = new_state(length[p] + 1, dict(go[q]), link[q])
        link[q] = clone
        while p >= 0 and go[p].get(c) == q:
            go[p][c] = clone
            p = link[p]
        return clone

    for _, text in texts:
        last = 0
        for c in text:
            if c in go[last]:  # another item has this prefix
                last = split(last, c, go[last][c])
                continue
            state, p = new_state(length[last] + 1, {}, 0), last
            while p >= 0 and c not in go[p]:
                go[p][c] = state
                p = link[p]
            if p >= 0:
                link[state] = split(p, c, go[p][c])
            last = state

    # windows: the state of every n words of an item, and of every whole short item
    holders: dict[int, set[str]] = {}
    whole: dict[int, set[str]] = {}
    for item, text in texts:
        state = size = 0
        for c in text:
            state, size = go[state][c], size + 1
            if size > n:
                size = n
            while length[link[state]] >= size:
                state = link[state]
            if size == n:
                holders.setdefault(state, set()).add(item)
        if len(text) < n:
            whole.setdefault(state, set()).add(item)
    up = _nearest_whole(length, link, whole)
    gram = min([n, GRAM, *(len(t) for _, t in texts)], default=1)
    shortest = min([n, *(len(t) for _, t in texts)], default=1)
    grams = [np.lib.stride_tricks.sliding_window_view(np.array(t, np.int64), gram) for _, t in texts]
    keys, to = [], []
    width = max(1, len(vocabulary))
    for s, t in enumerate(go):
        keys += [s * width + c for c in t]
        to += t.values()
    order = np.argsort(np.array(keys, np.int64))
    return {"vocabulary": list(vocabulary), "width": width, "gram": gram, "shortest": shortest, "n": n,
            "keys": np.array(keys, np.int64)[order], "to": np.array(to, np.int32)[order], "length": np.array(length, np.int32),
            "link": np.array(link, np.int32), "up": up, "holders": {s: sorted(x) for s, x in holders.items()},
            "whole": {s: sorted(x) for s, x in whole.items()},
            "bitmap": _bitmap(np.concatenate(grams) if grams else np.zeros((0, 1), np.int64))}


def _nearest_whole(length: list[int], link: list[int], whole: dict) -> np.ndarray:
    """Per state the nearest state on its path of suffix links, itself included, where a whole short item ends; else -1."""
    up = np.full(len(length), -1, np.int32)
    for s in sorted(range(len(length)), key=length.__getitem__):
        up[s] = s if s in whole else up[link[s]] if s else -1
    return up


def _hash(grams: list[np.ndarray], size: int) -> np.ndarray:
    h = np.zeros(len(grams[0]), np.uint64)
    for g in grams:
        h = (h ^ g.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h & np.uint64(size - 1)).astype(np.int64)


def _bitmap(grams: np.ndarray) -> np.ndarray:
    """Flags, at least 16 per g-gram, addressed by a hash."""
    out = np.zeros(1 << max(10, (16 * len(grams)).bit_length()), bool)
    if len(grams):
        out[_hash(list(grams.T), len(out))] = True
    return out


class Automaton:
    """An automaton ready to be walked."""

    def __init__(self, made: dict):
        self.__dict__.update(made)
        self.words = {w: i for i, w in enumerate(self.vocabulary)}
        self.key_list, self.to_list = array("q", self.keys.tobytes()), array("i", self.to.tobytes())
        self.lengths, self.links, self.ups = self.length.tolist(), self.link.tolist(), self.up.tolist()

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches [a, z) of words that are made of known g-grams and as long as the shortest window."""
        g = self.gram
        m = len(ids) - g + 1
        if m < 1:
            return
        grams = [ids[k:k + m] for k in range(g)]
        fine = self.bitmap[_hash(grams, len(self.bitmap))]
        for x in grams:
            fine &= x >= 0
        edges = np.flatnonzero(np.diff(fine, prepend=False, append=False))
        a, z = edges[::2], edges[1::2] + g - 1
        long = z - a >= self.shortest
        yield from zip(a[long].tolist(), z[long].tolist(), strict=True)

    def walk(self, ids: list[int], at: int, cover: list[tuple[int, int]], items: set[str]) -> None:
        """Follow the words; note hit stretches (from, to) and the items of the windows met."""
        keys, to, length, link, up, n = self.key_list, self.to_list, self.lengths, self.links, self.ups, self.n
        width, count = self.width, len(self.key_list)
        state = size = 0
        for i, c in enumerate(ids, at + 1):
            while True:
                key = state * width + c
                k = bisect_left(keys, key)
                if k < count and keys[k] == key:
                    state, size = to[k], size + 1
                    break
                if not state:
                    size = 0
                    break
                state = link[state]
                size = length[state]
            if size >= n:
                window = state
                while length[link[window]] >= n:
                    window = link[window]
                cover.append((i - n, i))
                items.update(self.holders.get(window, ()))
            short = up[state]
            while short >= 0:
                if length[short] <= size:  # a whole item stands for the longest string of its state
                    cover.append((i - length[short], i))
                    items.update(self.whole[short])
                short = up[link[short]] if short else -1

    def judge(self, data: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, hit stretches (from, to) without overlap, and item ids."""
        ids = word_ids(data, self.words)
        cover: list[tuple[int, int]] = []
        items: set[str] = set()
        for a, z in self.runs(ids):
            self.walk(ids[a:z].tolist(), a, cover, items)
        return len(ids), merged(np.array(cover, np.int64).reshape(-1, 2)), items


def merged(spans: np.ndarray) -> np.ndarray:
    """Stretches (from, to) joined where they touch or overlap."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    head = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[head, 0], np.maximum.reduceat(spans[:, 1], head)], axis=1)


# --- the distributed steps -------------------------------------------------------------------------

def item_pieces(benchmark: DataFrame, n: int, item_col: str, text_col: str) -> DataFrame:
    """item, size, words (joined by spaces): pieces that overlap by n - 1 words."""
    def run(batches):
        for b in batches:
            out = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held: list[bytes] = []
                for some in words_of(text.encode()):
                    held += some
                    while len(held) >= PIECE_WORDS + n:
                        out.append((item, PIECE_WORDS, b" ".join(held[:PIECE_WORDS])))
                        held = held[PIECE_WORDS - n + 1:]
                if held:
                    out.append((item, len(held), b" ".join(held)))
            cols = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                                             ["item", "size", "words"])

    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "item string, size long, words binary")


def build_shards(pieces: DataFrame, shards: int, n: int) -> DataFrame:
    """shard, made: one pickled automaton per shard."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["item", "words"])
        made = build_automaton([(i, w.split()) for i, w in zip(group["item"], group["words"], strict=True)], n)
        release_memory()
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "made": [pickle.dumps(made)]})

    shard = F.pmod(F.xxhash64("item", "words"), F.lit(shards)).cast("int").alias("shard")
    return pieces.select(shard, "item", "words").dropDuplicates().groupBy("shard").applyInPandas(run, "shard int, made binary")


def _found_rows(n_words: list[int], spans: list[np.ndarray], items: list[set]) -> pa.StructArray:
    size = [s[:, 1] - s[:, 0] for s in spans]
    flat = np.concatenate(spans)
    bounds = pa.array(np.cumsum([0, *map(len, spans)]), pa.int32())
    ranges = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["from", "to"])
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array([int(x.sum()) for x in size], pa.int64()),
         pa.array([int(x.max(initial=0)) for x in size], pa.int64()), pa.ListArray.from_arrays(bounds, ranges),
         pa.array([sorted(i) for i in items], pa.list_(pa.string()))], ["n_words", "n_hit", "longest", "spans", "items"])


def _ranges(found: dict) -> np.ndarray:
    return np.array([(s["from"], s["to"]) for s in found["spans"]], np.int64).reshape(-1, 2)


def pass_shard(rows: DataFrame, made: bytes, keep_text: bool) -> DataFrame:
    """rows(row, text, found) -> the same, with what this shard's automaton finds added to ``found``."""
    held = rows.sparkSession.sparkContext.broadcast(made)

    def run(batches):
        automaton = Automaton(pickle.loads(held.value))
        for b in batches:
            for a, z in byte_groups(b.column(1), CUT):
                part = b.slice(a, z - a)
                n_words, hits, items = [], [], []
                for text, before in zip(part.column(1), part.column(2).to_pylist(), strict=True):
                    size, spans, some = automaton.judge(text.as_buffer().to_pybytes())
                    if before:
                        spans = merged(np.concatenate([_ranges(before), spans]))
                        some.update(before["items"])
                    n_words.append(size)
                    hits.append(spans)
                    items.append(some)
                text = part.column(1) if keep_text else pa.nulls(len(part), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), text, _found_rows(n_words, hits, items)], ["row", "text", "found"])

    schema = rows.schema
    return rows.mapInArrow(run, StructType([schema["row"], StructField("text", StringType()), schema["found"]]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = N, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", shard_words: int = SHARD_WORDS, keep_text: bool = False) -> DataFrame:
    """row (the document's columns), text (null unless ``keep_text``), found."""
    ship_package(docs.sparkSession)
    pieces = stage(item_pieces(benchmark, n, item_col, item_text_col), "op13-pieces")
    total = pieces.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    built = stage(build_shards(pieces, shards, n), "op13-shards")
    rows = docs.select(F.struct(*docs.columns).alias("row"), text_or_empty(text_col).alias("text"),
                       F.lit(None).cast(FOUND).alias("found"))
    for k in range(shards):
        made = built.where(F.col("shard") == k).select("made").first()
        last = k + 1 == shards
        rows = pass_shard(rows, made[0] if made else pickle.dumps(build_automaton([], n)), keep_text or not last)
        if (k + 1) % SHARDS_A_PASS == 0 and not last:
            rows = stage(rows, "op13-pass")
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents' columns and last the struct ``leaks`` (with underscores added if the input has such a column):
    ``n_words``, ``n_hit``, ``longest``, ``spans`` (word ranges, from 0, end exclusive), ``items``."""
    name = "leaks"
    while name in docs.columns:
        name += "_"
    found = find_leaks(docs, benchmark, text_col=text_col, **options)
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns], F.col("found").alias(name))


def digest(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    leaks = F.col("leaks")
    # the id alone goes through the pass with the text
    found = find_leaks(slim, benchmark, **options).select(F.col("row.id").alias("doc_id"), F.col("found").alias("leaks"))
    return found.select("doc_id", leaks["n_words"].alias("n_words"), leaks["n_hit"].alias("n_hit"),
                        F.size(leaks["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(leaks["items"], ","), 256).alias("items_sha256"),
                        (leaks["n_hit"] > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE,
                 text_col: str = "text", **options) -> DataFrame:
    """The documents' columns: hit stretches of at least ``min_span`` words taken out of the text, from the first word's
    first byte to the last word's last; documents with a larger hit share than ``max_coverage`` go."""
    found = find_leaks(docs, benchmark, text_col=text_col, keep_text=True, **options)

    def run(batches):
        for b in batches:
            texts = []
            for text, f in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                spans = _ranges(f)
                long = spans[spans[:, 1] - spans[:, 0] >= min_span]
                texts.append(_without(text.as_buffer().to_pybytes(), long).decode() if len(long) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["row", "text"])

    kept = found.where(F.col("found.n_hit") <= max_coverage * F.col("found.n_words"))
    out = kept.mapInArrow(run, StructType([found.schema["row"], StructField("text", StringType())]))
    return out.select(*[(F.coalesce("text", F.col("row")[c]) if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def _without(data: bytes, spans: np.ndarray) -> bytes:
    """The text without the words of the given word ranges and what stands between them."""
    inside = np.frombuffer(data.translate(_WORDS), np.uint8) != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    first, stop = edges[::2], edges[1::2]
    parts, at = [], 0
    for a, z in spans.tolist():
        parts.append(data[at:first[a]])
        at = stop[z - 1]
    return b"".join([*parts, data[at:]])
