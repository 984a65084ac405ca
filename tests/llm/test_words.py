"""Spelling variants, source divergence and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from searchlake.llm import decontaminate, divergence, spelling_variants

UPPER, LOWER = spelling_variants.UPPER, spelling_variants.LOWER
DOWN = str.maketrans(UPPER, LOWER)


# --- operator 11 -----------------------------------------------------------------------------------

def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(DOWN)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_forms(n):
    out, form = {}, {}
    for w in n:
        some = [x for x in n if near(w, x)]
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = len(some)
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], out[w], n.get(form[w])))
    return sorted(rows)


def found_forms(words):
    return sorted(tuple(r) for r in spelling_variants.spelling_variants(words).collect())


def test_variants_of_words(spark):
    rng = random.Random(5)
    n = {"".join(rng.choices("abé", k=rng.randint(5, 8))): rng.choice([3, 4, 6, 7, 12, 25, 50]) for _ in range(300)}
    n |= {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "aaaaaaaaa": 48, "solitary": 9, "tiesx": 8, "tiesy": 8, "tiesz": 4}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert found_forms(words) == brute_forms(n)


def test_variants_chain_is_followed_to_the_last(spark):
    n = {"abcdefgh"[:5] + "x" * k: 3 * 2 ** k for k in range(20)}
    got = found_forms(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert got == brute_forms(n) and {r[2] for r in got} == {"abcde" + "x" * 19}


def test_words_of_documents(make):
    rng = random.Random(6)
    vocabulary = ["Étude", "étude", "naïve", "NAIVE", "abc", "words", "Wordes", "x" * 5000, "schön", "a×b÷c", "straße"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=40)) + ",.-_1") for i in range(200)] + [(None, "words words"), (3, None), (4, ""), (5, "words"), (5, "words")]
    docs = make(rows)
    got = {r.word: r.n for r in spelling_variants.word_counts(docs).collect()}
    assert got == brute_words(rows) and any(len(w) == 4999 for w in got)
    assert spelling_variants.spelling_variants(spelling_variants.word_counts(docs.limit(0))).count() == 0


# --- operator 12 -----------------------------------------------------------------------------------

def brute_audit(rows, min_docs=10, top=10):
    """rows of (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(DOWN)) for _, _, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        df, counts, whole = Counter(), defaultdict(Counter), Counter()
        for (lg, s, _), w in zip(rows, words, strict=True):
            if lg == lang:
                df.update(set(w))
                counts[s].update(w)
                whole.update(w)
        kept = sorted(t for t, k in df.items() if k >= min_docs)
        v = len(kept)

        def scaled(c, kept=kept, v=v):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * v) for t in kept}

        p, q = {s: scaled(c) for s, c in counts.items()}, scaled(whole)
        for s in p:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in p if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, some in (("pair", pairs), ("term", terms)):
                some = sorted(some, key=lambda x: (-x[1], x[0].encode()))[:top if part == "term" else None]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(some)]
    return sorted(out)


def audit_rows(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "Über", "über", "naïve", "x1y2", "don't", "日本", "a_b", "—", "z" * 300] + [f"w{c}" for c in "abcdefghijklmnop"]
    rows = []
    for i in range(n):
        source = rng.choice(["a"] * 6 + ["b", "c", "", None, "Ä"])
        rows.append((rng.choice(["en", "en", "en", "de", None]), source, " ".join(rng.choices(words[:12 + len(source or "") * 9], k=rng.randint(0, 30)))))
    return rows + [("xx", "p", "only few"), ("xx", "q", None), ("yy", "lonely", ""), ("en", "silent", "123 !"), ("en", "a", "the " * 50_000)]


@pytest.mark.parametrize("shard_rows,block,cells,held", [(200_000, 256, 1 << 21, 400_000), (7, 2, 12, 5)])
def test_audit(spark, monkeypatch, shard_rows, block, cells, held):
    for name, value in (("SHARD_ROWS", shard_rows), ("SOURCE_BLOCK", block), ("CELLS", cells), ("HELD_ROWS", held)):
        monkeypatch.setattr(divergence, name, value)
    rows = audit_rows(1)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    docs = docs.withColumns({c: F.lit(1) for c in "term n docs part item value rank shard block total df head".split()})
    got = divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == brute_audit(rows)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_audit_partial_counts_and_large_numbers():
    t = divergence.count_terms(pa.array(["e", "e", "d"]), pa.array(["s", "s", "s"]), pa.array(["a b a", "B ", "é a"]))
    assert sorted(zip(*(t[c].to_pylist() for c in t.column_names), strict=True)) == [
        ("d", "s", "a", 1, 1), ("d", "s", "é", 1, 1), ("e", "s", "a", 2, 1), ("e", "s", "b", 2, 2)]
    n, total = np.array([10**13, 5]), np.array([3 * 10**13, 3 * 10**13])
    assert divergence.smoothed(n, total).tolist() == [1 + 10**9 * (10**13 + 2) // (3 * 10**13), 1 + 10**9 * 7 // (3 * 10**13)]


# --- operator 13 -----------------------------------------------------------------------------------

def brute_leaks(text, items, n=10):
    """n_words, hit word positions, item ids."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(DOWN))
    hit, found = set(), set()
    for item, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(DOWN))
        k = min(n, len(w))
        windows = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i:i + k]) in windows:
                hit.update(range(i, i + k))
                found.add("" if item is None else str(item))
    return len(words), hit, sorted(found)


def leak_fixture(seed, alphabet="abcd", n_items=30, n_docs=150):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(alphabet, k=rng.choice([3, 8, 9, 10, 11, 15, 40])))) for i in range(n_items)]
    items += [(98, items[0][1]), (99, None), (100, ""), (101, "?!"), (None, "only once here"), (7, "A second row of item seven")]
    docs = []
    for i in range(n_docs):
        parts = [" ".join(rng.choices(alphabet, k=rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice([t for _, t in items if t]).split()
            a = rng.randint(0, len(w) - 1)
            parts += [", ".join(w[a:a + rng.randint(1, 40)]).upper(), " ".join(rng.choices([*alphabet, "é"], k=rng.randint(0, 20)))]
        docs.append((i, " - ".join(parts)))
    return items, docs + [(1000, None), (1001, ""), (None, "only once  HERE"), (1002, "x" * 3_000_000 + " only once here"), (0, docs[0][1])]


@pytest.mark.parametrize("alphabet,shard_words,piece", [("ab", 200_000, 20_000), ("abcd", 200_000, 20_000), (["ten", "été", "no"], 60, 13)])
def test_leaks(spark, make, monkeypatch, alphabet, shard_words, piece):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
    alphabet = list(alphabet)
    rng = random.Random(1)
    items, rows = leak_fixture(2, alphabet + ["".join(rng.choices("xyz", k=3)) for _ in range(4)])
    docs = make(rows).withColumn("leaks", F.lit(1)).withColumn("found", F.lit(2))
    bench = spark.createDataFrame([(*r, "s", 4) for r in items], "item_id long, text string, words string, size int")
    got = decontaminate.contamination(docs, bench, shard_words=shard_words).collect()
    key = lambda r: repr(r)
    expected = [(i, brute_leaks(t, items)) for i, t in rows]
    found = []
    for r in got:
        x = r["leaks_"]
        words = {w for s in x["spans"] for w in range(s["from"], s["to"])}
        assert len(words) == x["n_hit"] and r["leaks"] == 1
        found.append((r["doc_id"], (x["n_words"], words, x["items"])))
    assert sorted(found, key=key) == sorted(expected, key=key)
    short = decontaminate.digest(docs, bench, shard_words=shard_words).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in short), key=key) == sorted(
        ((i, n, len(h), len(s), hashlib.sha256(",".join(s).encode()).hexdigest(), bool(h)) for i, (n, h, s) in expected), key=key)


def test_leaks_are_removed(spark, make):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item), (2, "tiny item")], "item_id long, text string")
    rows = [(1, "Before it: " + item.upper() + "! " + "and much more text that nobody knows " * 5 + "tiny item."), (2, item), (3, "Clean, tiny."), (4, None), (5, "")]
    got = {r.doc_id: r.text for r in decontaminate.remove_leaks(make(rows), bench).select("doc_id", "text").collect()}
    assert got == {1: "Before it: ! " + "and much more text that nobody knows " * 5 + "tiny item.", 3: "Clean, tiny.", 4: None, 5: ""}
    none = spark.createDataFrame([], bench.schema)
    assert decontaminate.digest(make(rows), none).where("contaminated").count() == 0
    assert decontaminate.digest(make([]), bench).count() == 0


def test_words_are_cut_piece_by_piece(monkeypatch):
    text = ("Ab cé-9 " * 50 + "q" * 40 + " z").encode()
    whole = text.translate(decontaminate._WORDS).split()
    monkeypatch.setattr(decontaminate, "CUT", 11)
    assert [w for some in decontaminate.words_of(text) for w in some] == whole


def test_automaton_follows_the_longest_match():
    rng = random.Random(3)
    items = [(str(i), [c.encode() for c in rng.choices("ab", k=rng.randint(1, 14))]) for i in range(12)]
    machine = decontaminate.Automaton(decontaminate.build_automaton(items, 5))
    ids = [machine.words[c.encode()] for c in rng.choices("ab", k=300)]
    texts = [[machine.words[w] for w in words] for _, words in items]
    cover, found = [], set()
    machine.walk(ids, 0, cover, found)
    expected = set()
    for t in texts:
        k = min(5, len(t))
        windows = {tuple(t[i:i + k]) for i in range(len(t) - k + 1)}
        expected |= {(i, i + k) for i in range(len(ids) - k + 1) if tuple(ids[i:i + k]) in windows}
    assert set(cover) == expected
