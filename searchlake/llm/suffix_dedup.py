"""Operator 8, suffix-array dedup: linear grouping construction.

Removes every byte covered by a 50-byte string that also starts in a document with a smaller id. The
decision comes from suffix arrays built by suffix grouping: suffixes are grouped by their longest Lyndon
prefix, groups are processed in descending order, each handing its previous-smaller pointers' targets on to
refined groups; then every group's order is emitted in one ascending pass, without renaming or
recursion (``suffix_groups``, ``suffix_array``).

One suffix array over a corpus is no distributed job, so the texts that need one are brought together first:

1. Documents are packed into batches of about ``BATCH_BYTES`` (compressed, written once).
2. Every 50-byte window has a key, the smallest hash of its 24-byte substrings. Equal windows have equal
   keys. Batches send their distinct keys (packed) to key ranges, which answer what keys stand in two or more
   documents, and which are hot.
3. Batches send the runs of windows with a shared key: the distinct strings, each with its smallest id, so
   copies inside a batch travel once. Windows of a hot key travel one by one, keyed by their own
   hash, so that a passage in a third of all documents is dealt over all tasks. A row holds a bucket's strings of several
   batches, so that rows stay of one size while buckets and batches both grow with the input.
4. Per key, equal strings collapse to their smallest id (over groups of batches first, in a tree, if there are many). Where a key has several strings, the parts whose
   windows recur are put into suffix arrays; equal neighbouring 50-byte prefixes form a group with the smallest
   id of its documents. The answers go back to the batches as (string, window range, smallest id).
5. Batches mark the windows with a smaller id elsewhere, and merge the marked bytes.

Texts are never joined as rows; packed batches meet their answers by batch number. Keys only propose;
equal windows are decided on the bytes themselves.

Defined results: null text is empty; null ids count as larger than any other; rows with one and the same id do
not remove each other's bytes; an empty table gives an empty result; extra columns are ignored. ``kept_sha256``
is that of the remaining bytes, which need not be valid UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, ship_package, stage, text_or_empty

SPAN = 50
GRAM = 24
GRAMS = SPAN - GRAM + 1
LONGEST_RUN = 64
BATCH_BYTES = 1 << 20
RANGE_BYTES = 8 << 20
BUCKET_BYTES = 3 << 20
HOT = 2000
ARRAY_BYTES = 1 << 16
FAN = 16384
ROW_BYTES = 16 << 10
SEND_BYTES = 32 << 20
NO_ID = (1 << 63) - 1
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)]


# --- suffix arrays by grouping ------------------------------------------------------------------

def suffix_groups(text: list[int]) -> tuple[list[list[int]], list[int]]:
    """Suffixes grouped by their longest Lyndon prefix, in descending order, and previous-smaller pointers.

    ``text`` ends with its unique smallest symbol. The highest group left is final: its members leave
    the list of open positions; the open position before a member is its previous smaller suffix, whose
    group is refined: members of a group that precede as many members of the current one move
    together to a new group just above their old one.
    """
    n = len(text)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    start: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        start.setdefault(c, []).append(i)
    members = [start[c] for c in sorted(start)]
    size = [len(m) for m in members]
    group = [0] * n
    for g, m in enumerate(members):
        for i in m:
            group[i] = g
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    final, previous = [], [-1] * n
    g = len(members) - 1
    while g >= 0:
        rows = members[g]
        if size[g] != len(rows):
            rows = [i for i in rows if group[i] == g]
        if not rows:
            g = below[g]
            continue
        moves = []
        if len(rows) == 1:
            i = rows[0]
            p, r = left[i], right[i]
            previous[i] = p
            if r < n:
                left[r] = p
            if p >= 0:
                right[p] = r
                if size[group[p]] > 1:
                    moves.append((group[p], [p]))
        else:
            rows.sort()
            times: dict[int, int] = {}
            for i in rows:
                p, r = left[i], right[i]
                previous[i] = p
                if r < n:
                    left[r] = p
                if p >= 0:
                    right[p] = r
                    times[p] = times.get(p, 0) + 1
            sets: dict[tuple[int, int], list[int]] = {}
            for p, k in times.items():
                # a position inside the group has left by now, so p is in a lower group
                sets.setdefault((k, group[p]), []).append(p)
            for k, h in sorted(sets, reverse=True) if len(sets) > 1 else sets:
                moves.append((h, sets[k, h]))
        final.append(rows)
        for h, some in moves:
            if size[h] == len(some):
                continue  # the whole group moves: its place stays the same
            new = len(members)
            size[h] -= len(some)
            members.append(some)
            size.append(len(some))
            for p in some:
                group[p] = new
            over = above[h]
            below.append(h)
            above.append(over)
            above[h] = new
            if over < len(below) - 1:
                below[over] = new
        g = below[g]
    return final, previous


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of ``text``, which ends with its unique smallest symbol."""
    final, previous = suffix_groups(text)
    n = len(text)
    place, at = [0] * n, n
    head: list[int] = []
    for number, rows in enumerate(final):
        at -= len(rows)
        head.append(at)
        for i in rows:
            place[i] = number
    out, seen = [0] * n, [False] * n
    out[0], seen[n - 1] = n - 1, True
    for k in range(n):
        i = out[k] - 1
        while i >= 0 and not seen[i]:  # the suffixes whose Lyndon prefix ends where out[k] starts
            g = place[i]
            out[head[g]] = i
            head[g] += 1
            seen[i] = True
            i = previous[i]
    return out


def equal_windows(strings: list[bytes], span: int = SPAN) -> Iterator[list[tuple[int, int]]]:
    """Groups of equal ``span``-byte windows as (string, offset), from one suffix array over the strings."""
    whole = b"".join(strings)
    text, owner, offset, ends = [], [], [], []
    for s, string in enumerate(strings):
        text += [c + 2 for c in string]
        text.append(1)
        owner += [s] * (len(string) + 1)
        offset += range(len(string) + 1)
        ends.append(len(string) - span)
    text.append(0)
    owner.append(-1)
    base = [0]
    for string in strings:
        base.append(base[-1] + len(string))
    last, group = None, []
    for i in suffix_array(text):
        s = owner[i]
        if s < 0 or offset[i] > ends[s]:
            continue
        a = base[s] + offset[i]
        window = whole[a:a + span]
        if window != last:
            if group:
                yield group
            last, group = window, []
        group.append((s, offset[i]))
    if group:
        yield group


# --- windows and keys ---------------------------------------------------------------------------

def _loads(raw: np.ndarray, at: int, n: int) -> np.ndarray:
    """The eight bytes from every position on, as integers."""
    return np.ndarray((n,), "<u8", raw, at, (1,)).copy()


def _slide(a: np.ndarray, width: int, f) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        a = f(a[:-step], a[step:])
        step *= 2
    return f(a[:step - width], a[width - step:]) if width > step else a


def window_keys(raw: np.ndarray) -> np.ndarray:
    """For every 50-byte window of ``raw`` the smallest hash of its 24-byte substrings."""
    n = len(raw) - GRAM + 1
    if n < GRAMS:
        return np.zeros(0, np.uint64)
    h = _loads(raw, 0, n) * _M[0]
    b = _loads(raw, 8, n) * _M[1]
    h ^= b >> np.uint64(7)
    h += b
    h ^= h >> np.uint64(31)
    h += _loads(raw, 16, n) * _M[2]
    h ^= h >> np.uint64(29)
    h *= _M[3]
    h ^= h >> np.uint64(32)
    return _slide(h, GRAMS, np.minimum)


def window_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of every 50-byte window."""
    n = len(raw) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for at in (0, 8, 16, 24, 32, 40, SPAN - 8):
        h = (h ^ (h >> np.uint64(29)) ^ _loads(raw, at, n)) * _M[at // 8 % 3]
    h ^= h >> np.uint64(32)
    h *= _M[3]
    return h ^ (h >> np.uint64(29))


def _mixed(keys: np.ndarray) -> np.ndarray:
    """The keys one to one over all 64 bits evenly: a least of many hashes is small, and ranges are cut from the upper bits."""
    h = (keys ^ (keys >> np.uint64(30))) * _M[3]
    h = (h ^ (h >> np.uint64(27))) * _M[0]
    return h ^ (h >> np.uint64(31))


class Batch:
    """A packed batch: its documents, the windows inside documents, and their runs of equal keys."""

    def __init__(self, doc_ids: list, lens: list[int], data: bytes):
        self.ids = np.array([NO_ID if i is None else i for i in doc_ids], np.int64)
        self.lens = np.array(lens, np.int64)
        self.stops = np.cumsum(self.lens)
        self.data = data
        self.raw = np.frombuffer(data, np.uint8)
        keys = window_keys(self.raw)
        doc = np.repeat(np.arange(len(self.lens)), self.lens)
        inside = np.zeros(len(keys), bool)
        if len(keys):
            inside = doc[:len(keys)] == doc[SPAN - 1:]
        # a run: consecutive windows of one document with one key, LONGEST_RUN at most
        new = inside.copy()
        new[1:] &= ~(inside[:-1] & (keys[1:] == keys[:-1]))
        end = inside.copy()
        end[:-1] &= ~(inside[1:] & (keys[1:] == keys[:-1]))
        first, last = np.flatnonzero(new), np.flatnonzero(end)
        cuts = (last - first) // LONGEST_RUN + 1
        nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        self.first = np.repeat(first, cuts) + nth * LONGEST_RUN
        self.windows = np.minimum(np.repeat(last, cuts) + 1 - self.first, LONGEST_RUN)
        self.keys = _mixed(keys[self.first]) if len(keys) else np.zeros(0, np.uint64)
        self.doc = doc[self.first] if len(keys) else np.zeros(0, np.int64)

    def distinct_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending keys and the number of documents (255 at most) that have each."""
        order = np.lexsort((self.doc, self.keys))
        keys, doc = self.keys[order], self.doc[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
        keys, count = np.unique(keys[fresh], return_counts=True)
        return keys, np.minimum(count, 255).astype(np.uint8)

    def strings(self, flags: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct strings of shared keys with key and smallest id, and per string its places (first windows).

        ``flags``: per distinct key 0 alone, 1 shared, 2 hot (then each window is a string of its own).
        """
        keys, at = np.unique(self.keys, return_inverse=True)
        flag = flags[at] if len(flags) else np.zeros(0, np.uint8)
        run = np.flatnonzero(flag == 1)
        first, size, key, doc = self.first[run], self.windows[run], self.keys[run], self.doc[run]
        hot = np.flatnonzero(flag == 2)
        if len(hot):
            each = np.repeat(self.first[hot], self.windows[hot])
            each += np.arange(len(each)) - np.repeat(np.cumsum(self.windows[hot]) - self.windows[hot], self.windows[hot])
            first = np.concatenate([first, each])
            size = np.concatenate([size, np.ones(len(each), np.int64)])
            key = np.concatenate([key, window_hashes(self.raw)[each]])
            doc = np.concatenate([doc, np.repeat(self.doc[hot], self.windows[hot])])
        names: dict[tuple[int, bytes], int] = {}
        data, number = self.data, np.zeros(len(first), np.int64)
        for j, (a, n, k) in enumerate(zip(first.tolist(), size.tolist(), key.tolist(), strict=True)):
            number[j] = names.setdefault((k, data[a:a + n + SPAN - 1]), len(names))
        least = np.full(len(names), NO_ID, np.int64)
        np.minimum.at(least, number, self.ids[doc])
        order = np.argsort(number, kind="stable")
        places = np.split(first[order], np.cumsum(np.bincount(number, minlength=len(names)))[:-1]) if names else []
        return [c for _, c in names], np.array([k for k, _ in names], np.uint64), least, places


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a record batch, one at a time."""
    for r in range(batch.num_rows):
        yield batch.slice(r, 1).to_pylist()[0]
        release_memory()


def _unpack(row: dict) -> Batch:
    return Batch(row["doc_ids"], row["lens"], zstandard.decompress(row["data"]))


# --- the distributed steps -------------------------------------------------------------------------

def pack_batches(docs: DataFrame, batch_bytes: int) -> DataFrame:
    """docs(doc_id, text) -> batch, doc_ids, lens, data."""
    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def flush():
            return pa.RecordBatch.from_pydict({
                "batch": pa.array([(task << 32) + made], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "lens": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                "data": pa.array([zstandard.compress(b"".join(texts), 3)], pa.binary())})

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t.encode())
                size += len(texts[-1])
                if size >= batch_bytes:
                    yield flush()
                    made, ids, texts, size = made + 1, [], [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, "batch long, doc_ids array<long>, lens array<long>, data binary")


def send_keys(packed: DataFrame, ranges: int) -> DataFrame:
    """Each batch's distinct keys by key range: the key's lower half, and the number of documents."""
    def run(batches):
        for b in batches:
            for row in _each(b):
                keys, count = _unpack(row).distinct_keys()
                part = (keys >> np.uint64(32)).astype(np.int64) * ranges >> 32
                cut = np.searchsorted(part, np.arange(ranges + 1))
                low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
                some = [r for r in range(ranges) if cut[r] < cut[r + 1]]
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array(some, pa.int32()), "batch": pa.array([row["batch"]] * len(some), pa.int64()),
                    "keys": pa.array([low[cut[r]:cut[r + 1]].tobytes() for r in some], pa.binary()),
                    "docs": pa.array([count[cut[r]:cut[r + 1]].tobytes() for r in some], pa.binary())})

    return packed.mapInArrow(run, "range int, batch long, keys binary, docs binary")


def answer_keys(sent: DataFrame, hot: int) -> DataFrame:
    """batch, range, flags: per sent key 0 alone, 1 in several documents, 2 in more than ``hot``."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, "<u4") for k in group["keys"]])
        docs = np.concatenate([np.frombuffer(d, np.uint8) for d in group["docs"]]).astype(np.int64)
        _, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=docs)[at]
        flags = ((total > 1).astype(np.uint8) + (total > hot).astype(np.uint8))
        cut = np.cumsum([len(d) for d in group["docs"]])[:-1]
        del keys, docs, at, total
        release_memory()
        return pd.DataFrame({"batch": group["batch"], "range": group["range"],
                             "flags": [f.tobytes() for f in np.split(flags, cut)]})

    return sent.groupBy("range").applyInPandas(run, "batch long, range int, flags binary")


def _joined_flags(answers: list) -> np.ndarray:
    return np.frombuffer(b"".join(a["flags"] for a in sorted(answers or [], key=lambda a: a["range"])), np.uint8)


def send_strings(met: DataFrame, buckets: int) -> DataFrame:
    """Each batch's distinct strings of shared keys by bucket: number in the batch, key, smallest id, bytes.

    A task's batches are held until a bucket has about ROW_BYTES of them, or all have SEND_BYTES; ``counts``: strings of each of the
    row's batches. With a row for every batch and bucket, the number of rows grew with the square of the input."""
    most = min(SEND_BYTES, ROW_BYTES * buckets)

    def rows(held: list) -> pa.RecordBatch:
        out = []
        for r in range(buckets):
            some = [(h, h["cut"][r], h["cut"][r + 1]) for h in held if h["cut"][r] < h["cut"][r + 1]]
            if some:
                raw = b"".join([h["data"][h["stops"][a]:h["stops"][z]] for h, a, z in some])
                out.append((r, [h["batch"] for h, _, _ in some], [z - a for _, a, z in some],
                            *(b"".join([h[c][a:z].tobytes() for h, a, z in some]) for c in ("numbers", "keys", "least", "lens")),
                            zstandard.compress(raw, 3)))
        kinds = pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 5
        names = "bucket", "batches", "counts", "numbers", "keys", "least", "lens", "data"
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names)

    def run(batches):
        held, size = [], 0
        for b in batches:
            for row in _each(b):
                strings, keys, least, _ = _unpack(row).strings(_joined_flags(row["answers"]))
                part = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                data = [strings[i] for i in order.tolist()]
                lens = np.array([len(x) for x in data], "<u2")
                held.append({"batch": row["batch"], "cut": np.searchsorted(part[order], np.arange(buckets + 1)).tolist(),
                             "numbers": order.astype("<i4"), "keys": keys[order], "least": least[order], "lens": lens,
                             "stops": [0, *np.cumsum(lens, dtype=np.int64).tolist()], "data": b"".join(data)})
                del strings, data
                size += len(held[-1]["data"])
                if size >= most:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    return met.mapInArrow(run, f"bucket int, {_SENT}")


#: The strings of a row: those of its first batch, then those of the next one.
_SENT = "batches array<long>, counts array<int>, numbers binary, keys binary, least binary, lens binary, data binary"


def decide(entries: list[tuple[int, bytes, int]]) -> list[list[tuple[int, int, int]]]:
    """entries (key, string, smallest id) -> per entry (first window, end, smallest id of an entry that has these windows)."""
    least: dict[tuple[int, bytes], int] = {}
    for key, string, doc in entries:
        if doc < least.get((key, string), NO_ID + 1):
            least[key, string] = doc
    by_key: dict[int, list[bytes]] = {}
    for key, string in least:
        by_key.setdefault(key, []).append(string)
    answer = {ks: [(0, len(ks[1]) - SPAN + 1, doc)] for ks, doc in least.items()}

    # parts of the strings of one key whose windows recur in another string of that key
    several = [(key, s) for key, strings in by_key.items() if len(strings) > 1 for s in strings]
    if several:
        raw = np.frombuffer(b"".join(s for _, s in several), np.uint8)
        h = window_hashes(raw)
        lens = np.array([len(s) for _, s in several])
        begin = np.cumsum(lens) - lens
        n = lens - SPAN + 1
        owner = np.repeat(np.arange(len(several)), n)
        at = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        _, same, count = np.unique(h[at], return_inverse=True, return_counts=True)
        recurs = count[same] > 1
        edge = recurs.copy()
        edge[1:] &= ~(recurs[:-1] & (owner[1:] == owner[:-1]))
        stop = recurs.copy()
        stop[:-1] &= ~(recurs[1:] & (owner[1:] == owner[:-1]))
        parts: dict[int, dict[bytes, list]] = {}  # key -> part -> [smallest id, (string, first window), ...]
        local = at - begin[owner]
        for a, z in zip(np.flatnonzero(edge).tolist(), np.flatnonzero(stop).tolist(), strict=True):
            ks, x = several[owner[a]], int(local[a])
            part = ks[1][x:int(local[z]) + SPAN]
            found = parts.setdefault(ks[0], {}).setdefault(part, [NO_ID])
            found[0] = min(found[0], least[ks])
            found.append((ks, x))
        for texts in _array_groups(parts):
            docs = [[found[0]] * (len(part) - SPAN + 1) for part, found in texts]
            for same_window in equal_windows([part for part, _ in texts]) if len(texts) > 1 else ():
                if len(same_window) > 1:
                    low = min(texts[s][1][0] for s, _ in same_window)
                    for s, x in same_window:
                        docs[s][x] = low
            for (_, found), low in zip(texts, docs, strict=True):
                spans, x = [], 0
                for y in range(1, len(low) + 1):
                    if y == len(low) or low[y] != low[x]:
                        spans.append((x, y, low[x]))
                        x = y
                for ks, shift in found[1:]:
                    answer[ks] += [(x + shift, y + shift, doc) for x, y, doc in spans]
    return [answer[key, string] for key, string, _ in entries]


def _array_groups(parts: dict[int, dict[bytes, list]]) -> Iterator[list[tuple[bytes, list]]]:
    """Parts by key: single ones alone, several ones with other keys' up to ARRAY_BYTES (one suffix array)."""
    held, size = [], 0
    for some in parts.values():
        if len(some) == 1:
            yield list(some.items())
            continue
        held += some.items()
        size += sum(map(len, some))
        if size >= ARRAY_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _entries(row) -> list[tuple[int, bytes, int]]:
    """(key, string, smallest id) of a packed row of strings."""
    data, lens = zstandard.decompress(row.data), np.frombuffer(row.lens, "<u2")
    stops = np.cumsum(lens, dtype=np.int64)
    return list(zip(np.frombuffer(row.keys, np.uint64).tolist(), [data[z - n:z] for z, n in zip(stops.tolist(), lens.tolist(), strict=True)],
                    np.frombuffer(row.least, np.int64).tolist(), strict=True))


def _by_batch(row) -> Iterator[tuple[int, list[int], list[tuple[int, bytes, int]]]]:
    """(batch, numbers, entries) of each batch of a packed row of strings."""
    entries, numbers, at = _entries(row), np.frombuffer(row.numbers, "<i4").tolist(), 0
    for batch, n in zip(row.batches, row.counts, strict=True):
        yield int(batch), numbers[at:at + n], entries[at:at + n]
        at += n


def answer_strings(sent: DataFrame, batches: int, lower: bool = True) -> DataFrame:
    """batch, spans (number, first, stop, least): per string the window ranges and the smallest id that is known to hold them.

    Up to FAN batches are decided bucket by bucket. More are combined first: FAN batches of a bucket become one, whose equal strings
    are one with the smallest id, and so on; the answers go down the same tree. A string that stands in every batch is
    so never in more than FAN rows of a task. ``lower``: only ranges with a smaller id than the string's own are told."""
    if batches > FAN:
        return _answer_groups(sent, -(-batches // FAN), lower)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        held = [x for r in group.itertuples(index=False) for x in _by_batch(r)]
        entries = [e for _, _, some in held for e in some]
        spans, out, at = decide(entries), [], 0
        for batch, numbers, some in held:
            rows = [(numbers[j], *s) for j, (_, _, doc) in enumerate(some) for s in spans[at + j] if not lower or s[2] < doc]
            at += len(some)
            if rows:
                out.append((batch, np.array(rows, "<i8").tobytes()))
        del entries, spans, held
        release_memory()
        return pd.DataFrame(out, columns=["batch", "spans"])

    return sent.groupBy("bucket").applyInPandas(run, "batch long, spans binary")


def _answer_groups(sent: DataFrame, groups: int, lower: bool) -> DataFrame:
    """``answer_strings`` by way of groups of batches."""
    def combine(group: pd.DataFrame) -> pd.DataFrame:
        names: dict[tuple[int, bytes], int] = {}
        least: list[int] = []
        members = []
        for batch, numbers, some in (x for r in group.itertuples(index=False) for x in _by_batch(r)):
            at = np.zeros(len(some), "<i4")
            for j, (key, string, doc) in enumerate(some):
                n = at[j] = names.setdefault((key, string), len(names))
                if n == len(least):
                    least.append(doc)
                least[n] = min(least[n], doc)
            members.append({"batch": batch, "numbers": np.array(numbers, "<i4").tobytes(), "at": at.tobytes(),
                            "least": np.array([doc for _, _, doc in some], np.int64).tobytes()})
        bucket, g = group["bucket"].iloc[0], group["g"].iloc[0]
        out = {"bucket": bucket, "batches": [int(bucket) * groups + int(g)], "counts": [len(names)], "numbers": np.arange(len(names), dtype="<i4").tobytes(),
               "keys": np.array([k for k, _ in names], np.uint64).tobytes(), "least": np.array(least, np.int64).tobytes(),
               "lens": np.array([len(s) for _, s in names], "<u2").tobytes(),
               "data": zstandard.compress(b"".join(s for _, s in names), 3), "members": members}
        release_memory()
        return pd.DataFrame([out])

    dealt = sent.withColumn("g", F.pmod(F.xxhash64(F.get("batches", F.lit(0))), F.lit(groups)).cast("int"))
    combined = stage(dealt.groupBy("bucket", "g").applyInPandas(
        combine, f"bucket int, {_SENT}, members array<struct<batch: long, numbers: binary, at: binary, least: binary>>"), "op8-groups")
    upper = answer_strings(combined.drop("members"), groups, lower=False)

    def down(batches):
        for b in batches:
            out = []
            for row in b.to_pylist():
                told: dict[int, list] = {}
                for number, first, stop, doc in np.frombuffer(row["spans"], "<i8").reshape(-1, 4).tolist():
                    told.setdefault(number, []).append((first, stop, doc))
                for m in row["members"]:
                    numbers, own = np.frombuffer(m["numbers"], "<i4").tolist(), np.frombuffer(m["least"], np.int64).tolist()
                    rows = [(numbers[j], *s) for j, n in enumerate(np.frombuffer(m["at"], "<i4").tolist())
                            for s in told.get(n, ()) if not lower or s[2] < own[j]]
                    if rows:
                        out.append((m["batch"], np.array(rows, "<i8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["batch", "spans"])

    return combined.select(F.get("batches", F.lit(0)).alias("batch"), "members").join(upper, "batch").select("members", "spans").mapInArrow(down, "batch long, spans binary")


def finish(met: DataFrame) -> DataFrame:
    """Batches with their answers -> one row per document."""
    def run(batches):
        for b in batches:
            for row in _each(b):
                batch = _unpack(row)
                strings, _, least, places = batch.strings(_joined_flags(row["answers"]))
                own = [(i, 0, len(s) - SPAN + 1, low) for i, (s, low) in enumerate(zip(strings, least.tolist(), strict=True))
                       if len(places[i]) > 1]
                told = [np.frombuffer(s["spans"], "<i8").reshape(-1, 4) for s in row["spans"] or []]
                spans = np.concatenate([np.array(own, np.int64).reshape(-1, 4), *told])
                low = np.full(len(batch.raw), NO_ID, np.int64)  # smallest id that is known to hold the window from here
                _mark(low, places, spans)
                gone = np.flatnonzero(low < np.repeat(batch.ids, batch.lens))
                cover = np.zeros(len(low) + SPAN + 1, np.int64)
                np.add.at(cover, gone, 1)
                np.add.at(cover, gone + SPAN, -1)
                yield _rows(row["doc_ids"], batch, np.cumsum(cover)[:len(low)] > 0)

    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _mark(low: np.ndarray, places: list[np.ndarray], spans: np.ndarray) -> None:
    """Lower ``low`` at every place of the strings' window ranges: spans are (string, first, end, id)."""
    if not len(spans):
        return
    times = np.array([len(p) for p in places], np.int64)
    begin = np.cumsum(times) - times
    flat = np.concatenate(places)
    string, x, y, doc = spans.T
    each = np.repeat(np.arange(len(spans)), times[string])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(times[string]) - times[string], times[string])
    start, size = flat[begin[string[each]] + nth] + x[each], (y - x)[each]
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    np.minimum.at(low, at, np.repeat(doc[each], size))


def _rows(doc_ids: list, batch: Batch, removed: np.ndarray) -> pa.RecordBatch:
    out = []
    for i, z, n in zip(doc_ids, batch.stops.tolist(), batch.lens.tolist(), strict=True):
        gone = removed[z - n:z]
        k = int(gone.sum())
        spans = int(np.count_nonzero(np.diff(gone, prepend=False) & gone)) if k else 0
        kept = batch.raw[z - n:z][~gone].tobytes() if k else batch.data[z - n:z]
        out.append((i, n, k, spans, hashlib.sha256(kept).hexdigest()))
    cols = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 4 + (pa.string(),), strict=True)],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES,
                 hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    packed = stage(pack_batches(docs, batch_bytes), "op8-packed")
    total = packed.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    sent = send_keys(packed, max(1, -(-total // RANGE_BYTES)))
    flags = stage(answer_keys(sent, hot), "op8-flags")
    answers = stage(flags.groupBy("batch").agg(F.collect_list(F.struct("range", "flags")).alias("answers")), "op8-answers")
    met = packed.join(answers.hint("merge"), "batch", "left")
    spans = stage(answer_strings(send_strings(met, max(1, -(-total // BUCKET_BYTES))), packed.count()), "op8-spans")
    spans = stage(spans.groupBy("batch").agg(F.collect_list(F.struct("spans")).alias("spans")), "op8-replies")
    return finish(met.join(spans.hint("merge"), "batch", "left"))
