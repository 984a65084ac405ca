"""Near-dedup and suffix-array dedup against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from searchlake.llm import bagminhash, suffix_dedup


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def edited(rng, ws, k):
    ws = list(ws)
    for _ in range(k):
        ws[rng.randrange(len(ws))] = f"e{rng.randrange(10**6)}"
    return ws


def near_rows():
    rng = random.Random(8)
    rows, i = [], 0
    for group in range(12):
        base = words(rng, rng.choice([6, 30, 80, 200]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            rows.append((i, " ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 30)))))
            i += 1
    loop = words(rng, 7) * 40  # many repeats of few shingles: weights matter
    rows += [(500, " ".join(loop)), (501, " ".join(loop[:-10])), (502, " ".join(loop[:140])), (503, " ".join(loop + ["x"]))]
    rows += [(600, None), (601, ""), (602, ""), (603, "!!! ???"), (604, "one two"), (605, "One, TWO!"), (606, "one two three"),
             (607, "word " * 30_000), (608, "word " * 29_000), (None, "one two"), (609, "ÉTÉ à la mer du nord"), (610, "été à la mer du nord"),
             (611, "same"), (611, "same"), (612, "same")]
    rng.shuffle(rows)
    return rows


def brute_classes(rows):
    """Class of every row index: exact multiset Jaccard of at least 4/5, copies by words, no words: by text."""
    bags = []
    for _, t in rows:
        w = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())
        bags.append(Counter(zip(*[w[j:] for j in range(5)], strict=False)) if len(w) >= 5 else Counter([tuple(w)]) if w else Counter([("no words", t or "")]))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(range(len(rows)), 2):
        if 5 * sum((bags[a] & bags[b]).values()) >= 4 * sum((bags[a] | bags[b]).values()):
            parent[find(a)] = find(b)
    return [find(x) for x in range(len(rows))]


@pytest.mark.parametrize("small, chunk", [(24, 512), (1, 4)])
def test_near_dedup_matches_brute_force(make, monkeypatch, small, chunk):
    monkeypatch.setattr(bagminhash, "SMALL", small)  # 1: all buckets are compared in blocks
    monkeypatch.setattr(bagminhash, "CHUNK_DOCS", chunk)
    rows = near_rows()
    out = bagminhash.near_dedup(make(rows)).collect()
    assert len(out) == len(rows)
    expected = {}
    for (i, _), c in zip(rows, brute_classes(rows), strict=True):
        expected.setdefault(c, []).append(i)
    want = sorted((i if i is not None else -1, min(x for x in ids if x is not None), len(ids)) for ids in expected.values() for i in ids)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.class_id, r.class_size) for r in out) == want
    assert sum(r.kept for r in out) == len(expected)
    assert all(r.doc_id == r.class_id for r in out if r.kept)


def test_near_dedup_keeps_chained_links(make):
    """a~b and b~c link a with c although a and c are below the threshold."""
    rng = random.Random(1)
    base = words(rng, 200)
    chain = [base]
    for k in range(6):  # every step changes another stretch
        nxt = list(chain[-1])
        nxt[25 * k + 5:25 * k + 16] = words(rng, 11)
        chain.append(nxt)
    rows = [(i, " ".join(c)) for i, c in enumerate(chain)]
    assert len(set(brute_classes(rows))) == 1
    assert {r.class_id for r in bagminhash.near_dedup(make(rows)).collect()} == {0}


def test_block_overlaps():
    rng = np.random.default_rng(2)
    bags = [np.unique(rng.integers(0, 9000, rng.integers(0, 6000))).astype(np.uint64) for _ in range(9)]
    got = bagminhash.overlaps(bags[:4], bags[4:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in bags[4:]] for a in bags[:4]]


def test_near_dedup_with_many_unlinked_copies(make):
    """A large bucket of edited copies, most of them below the threshold to each other."""
    rng = random.Random(12)
    base = words(rng, 150)
    rows = [(i, " ".join(edited(rng, base, rng.choice([0, 1, 2, 4, 5, 6, 8])))) for i in range(160)]
    classes = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in bagminhash.near_dedup(make(rows)).collect()}
    assert all(got[i] == min(j for j, c in enumerate(classes) if c == classes[i]) for i in got)


def test_near_dedup_empty_and_stage(make):
    assert bagminhash.near_dedup(make([])).count() == 0
    docs = make(near_rows())
    kept = bagminhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(brute_classes(near_rows())))


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    m, err = 4096, []
    for _ in range(6):
        a = {int(k): int(c) for k, c in zip(rng.integers(0, 40, 25), rng.integers(1, 9, 25), strict=True)}
        b = {int(k): int(c) for k, c in zip(rng.integers(0, 40, 25), rng.integers(1, 9, 25), strict=True)}
        items = np.array([*a, *b], np.uint64)
        doc = np.array([0] * len(a) + [1] * len(b))
        sig = bagminhash.signatures(bagminhash.mix(items), doc, np.array([*a.values(), *b.values()]), 2, m, 4)
        true = sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
        err.append((sig[0] == sig[1]).mean() - true)
    assert max(map(abs, err)) < 0.04 and abs(np.mean(err)) < 0.012


def test_suffix_array_matches_sorting():
    rng = random.Random(6)
    for _ in range(1500):
        t = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 45))] + [0]
        assert suffix_dedup.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def test_lyndon_groups():
    """Groups are the suffixes with equal longest Lyndon prefixes, in descending order."""
    rng = random.Random(7)
    for _ in range(200):
        t = [rng.randint(1, 3) for _ in range(rng.randint(0, 30))] + [0]
        n = len(t)
        word = [next((t[i:j] for j in range(i + 1, n) if t[j:] < t[i:]), t[i:]) for i in range(n)]
        groups, previous = suffix_dedup.suffix_groups(t)
        assert [word[g[0]] for g in groups] == sorted({tuple(w) for w in word}, reverse=True) or \
            [tuple(word[g[0]]) for g in groups] == sorted({tuple(w) for w in word}, reverse=True)
        assert all(len({tuple(word[i]) for i in g}) == 1 for g in groups)
        assert previous == [max((j for j in range(i) if t[j:] < t[i:]), default=-1) for i in range(n)]


def brute_spans(rows):
    data = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, x in data:
        for j in range(len(x) - 49):
            first[x[j:j + 50]] = min(first.get(x[j:j + 50], i), i)
    out = []
    for i, x in data:
        gone = np.zeros(len(x), bool)
        for j in range(len(x) - 49):
            if first[x[j:j + 50]] < i:
                gone[j:j + 50] = True
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        out.append((None if i == float("inf") else i, len(x), int(gone.sum()), int((np.diff(gone, prepend=False) & gone).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def span_rows():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passages = [text(rng.randint(45, 160)) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [text(rng.randint(0, 120))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(0, max(1, len(p) - 50))
            parts += [p[a:] if rng.random() < 0.5 else p, text(rng.randint(0, 60))]
        rows.append((i, "".join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 30, 3)]
    rows += [(300, "a" * 70), (301, "a" * 3000), (302, "a" * 49), (303, "ab" * 400), (304, "ab" * 25), (305, None), (306, ""),
             (None, rows[0][1]), (None, rows[0][1]), (5, rows[0][1]), (307, passages[0][:50]), (308, passages[0][:49]), (309, "\0" * 120), (310, "\0" * 60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("batch_bytes, hot", [(2 << 20, 2000), (500, 2000), (500, 2)])
def test_suffix_dedup_matches_brute_force(make, batch_bytes, hot):
    rows = span_rows()
    out = suffix_dedup.suffix_dedup(make(rows).repartition(3), batch_bytes=batch_bytes, hot=hot)
    assert sorted(map(tuple, out.collect()), key=repr) == brute_spans(rows)


def test_suffix_dedup_empty(make):
    assert suffix_dedup.suffix_dedup(make([])).count() == 0


@pytest.mark.parametrize("fan", [2, 5])
def test_suffix_dedup_through_a_tree_of_groups(make, monkeypatch, fan):
    """Strings of many batches are combined group by group; the result is that of one group."""
    monkeypatch.setattr(suffix_dedup, "FAN", fan)
    rows = span_rows()
    out = suffix_dedup.suffix_dedup(make(rows).repartition(3), batch_bytes=1500)
    assert sorted(map(tuple, out.collect()), key=repr) == brute_spans(rows)


def test_key_ranges_are_even():
    """Keys are least hashes; the ranges that they are dealt to must not be."""
    rng = np.random.default_rng(1)
    batch = suffix_dedup.Batch([1], [400_000], rng.integers(0, 256, 400_000, np.uint8).tobytes())
    keys, _ = batch.distinct_keys()
    size = np.bincount((keys >> np.uint64(32)).astype(np.int64) * 64 >> 32, minlength=64)
    assert size.max() < 1.5 * size.mean() and size.min() > size.mean() / 1.5


def test_rows_of_strings_do_not_grow_with_batches_times_buckets(make, monkeypatch):
    """A row of strings holds several batches; there was one for every batch and bucket."""
    rnd = np.random.default_rng(3)
    passages = ["".join(rnd.choice(list("abcdefgh "), 200)) for _ in range(12)]
    rows = [(i, " ".join(passages[j] for j in rnd.choice(12, 4, replace=False))) for i in range(60)]
    sent, answer = [], suffix_dedup.answer_strings
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(suffix_dedup, "answer_strings", lambda df, *a, **k: sent.append((df.count(), df.rdd.getNumPartitions())) or answer(df, *a, **k))
    out = suffix_dedup.suffix_dedup(make(rows).coalesce(1), batch_bytes=800)
    assert sorted(map(tuple, out.collect()), key=repr) == brute_spans(rows)
    buckets = -(-sum(len(t) for _, t in rows) // 1500)
    assert sent[0][0] <= buckets * sent[0][1] < 20 * buckets
