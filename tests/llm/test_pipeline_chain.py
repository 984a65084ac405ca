"""The pipeline's run on a fixture, every stage's rows against a brute-force chain."""

import functools
import random
from collections import Counter, defaultdict

from test_dedup import brute_classes
from test_native import brute_lines, fill

import corpus_pipeline
from searchlake.llm import packing

BATCH_TOKENS = 256  # so that buckets have several batches


def fixture_rows():
    """(id, text, source, good). Two lines stand on all twelve sites, one on ten only with the junk, one on eight."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdeilnorst", k=rng.randint(3, 8))) for _ in range(600)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."
    rows = []
    for i in range(240):
        site = f"s{i % 12:02}"
        body = [prose(rng.randint(6, 12)) for _ in range(rng.randint(2, 6))]
        if i // 12 % 3 == 0:
            body.append("Read our terms and the notes of the whole site.")
        if i // 12 % 5 == 0:
            body.insert(0, "  Sign up and get our news every week. ")
        if site < "s09" and i // 12 % 4 == 1:
            body.append("Only the junk takes this line to ten sites.")
        if site < "s08" and i // 12 % 4 == 2:
            body.append("This line stands on fewer sites and stays.")
        rows.append((i, "\n".join(body), site, 1))
    for i in range(240, 270):  # near-duplicates, copies, and pairs that are alike only without the lines of all sites
        text = rows[rng.randrange(200)][1].split("\n")
        text[-1] += " Also this."
        rows.append((i, "\n".join(text), f"s{rng.randrange(12):02}", 1))
    for i in range(270, 290, 2):
        text = prose(9)
        rows.append((i, text + "\nRead our terms and the notes of the whole site.", f"s{i % 12:02}", 1))
        rows.append((i + 1, "Sign up and get our news every week.\n" + text, f"s{(i + 5) % 12:02}", 1))
    for i in range(290, 350):
        junk = " | ".join(rng.choices(["BUY!!!", "$$$ 99", "CLICK", "!!!", "777"], k=rng.randint(6, 20)))
        rows.append((i, junk + "\nOnly the junk takes this line to ten sites.", f"j{i % 3}", 0))
    return rows


def least_padding(lengths, buckets):
    """Fewest padded tokens of at most so many buckets, and the fewest buckets that reach it."""
    counts = sorted(Counter(lengths).items())

    @functools.cache
    def best(first, left):
        if first == len(counts):
            return 0, 0
        if not left:
            return float("inf"), 0
        out = []
        for last in range(first, len(counts)):
            tokens, used = best(last + 1, left - 1)
            out.append((tokens + counts[last][0] * sum(n for _, n in counts[first:last + 1]), used + 1))
        return min(out)
    return best(0, buckets)


def test_run_matches_brute_force_chain(spark, tmp_path, monkeypatch):
    rows = fixture_rows()
    sf = str(tmp_path)
    (spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
     .write.parquet(f"{sf}/documents.parquet"))
    spark.createDataFrame([(i, g) for i, _, _, g in rows], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    monkeypatch.setattr(corpus_pipeline, "scratch_dir", lambda _, name: f"{sf}/{name}")
    monkeypatch.setattr(packing, "pack", functools.partial(packing.pack, batch_tokens=BATCH_TOKENS))
    final = corpus_pipeline.run(spark, sf).collect()

    def written(name):
        return spark.read.parquet(f"{sf}/pipeline-{name}").collect()

    def texts(name):
        return sorted((r.doc_id, r.text, r.source, r.lang, r.n_chars) for r in written(name))

    good = [(i, t, s) for i, t, s, g in rows if g]
    assert texts("quality_classifier") == [(i, t, s, "en", len(t)) for i, t, s in good]

    clean = {i: t for i, _, _, t in brute_lines(good, 10)}
    removed = {i for i, _, n, _ in brute_lines(good, 10) if n}
    assert len(removed) > 90 and any("junk takes" in t for t in clean.values())
    lines = [(i, clean[i], s) for i, _, s in good]
    assert texts("line_dedup") == [(i, t, s, "en", len(t)) for i, t, s in lines]

    classes = brute_classes([(i, t) for i, t, _ in lines])
    first = {}
    for (i, _, _), c in zip(lines, classes, strict=True):
        first[c] = min(i, first.get(c, i))
    kept = [r for r in lines if r[0] in first.values()]
    assert 20 < len(lines) - len(kept) < 60
    assert texts("near_dedup") == [(i, t, s, "en", len(t)) for i, t, s in kept]

    mixed = written("source_mix")
    copies = Counter(r.doc_id for r in mixed)
    by_id = {i: (t, s) for i, t, s in kept}
    assert all((r.text, r.source, r.lang, r.n_chars) == (*by_id[r.doc_id], "en", len(r.text)) for r in mixed)
    assert max(copies.values()) <= 3
    size, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, (t, s) in by_id.items():
        n = len(t.split())
        size[s] += n
        taken[s] += n * copies[i]
        largest[s] = max(largest[s], n)
    target = fill(size, {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}, 3)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in size)
    whole = {s: int(target[s] // size[s]) for s in size}  # every document is taken the target's share of times, rounded either way
    assert all(whole[s] <= copies[i] <= whole[s] + 1 for i, (_, s) in by_id.items())

    length = {i: len(t.split()) + 1 for i, (t, _) in by_id.items()}
    assert Counter(r.doc_id for r in final) == copies
    assert all((r.piece, r.piece_start, r.length) == (0, 0, length[r.doc_id]) for r in final)
    bounds = sorted({r.bucket_len for r in final})
    assert all(r.bucket_len == min(b for b in bounds if b >= r.length) for r in final)
    assert (sum(r.bucket_len for r in final), len(bounds)) == least_padding([r.length for r in final], packing.BUCKETS)
    batch = 0
    for b in bounds:
        left, room = sum(r.bucket_len == b for r in final), max(1, BATCH_TOKENS // b)
        while left:
            here = [r for r in final if r.batch == batch]
            assert all(r.bucket_len == b for r in here)
            assert sorted(r.place for r in here) == list(range(min(room, left)))
            left, batch = left - len(here), batch + 1
    assert batch > len(bounds) and batch == len({r.batch for r in final})
