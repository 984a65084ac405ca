"""Quality classifier, token files, packing, bit-sliced search and the pipeline."""

import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from searchlake.llm import bit_sliced, packing, quality, rans
from searchlake.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGES = [(3, "Hello,  world's 42 ends"), (1, None), (2, ""), (9, "x y z 　 \x1c q"), (None, "null id"), (9, "same id"), (9, "same id"),
         (5, "<|endoftext|> it's ΑΣ ΟΔΟΣ"), (6, "é́ ́a ﬁ İ"), (7, "long " * 50_000), (8, "\n\t "), (4, "x" * 3000)]


def test_chunks_encode_like_the_library():
    lib, mine = Tokenizer.from_file(PATH), rans.ChunkEncoder(PATH, limit=300)
    rng = random.Random(1)
    alphabet = "ab's'tRE'LL 12,.!\n\t\r\x0b\x0c\x1c\x85  éÉßΣσ́ ́中文<|endoftext|>\U0001f600"
    for _ in range(40):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(30)]
        ids, lens = mine.encode(texts)
        want = [lib.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert lens.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_capitals_that_compose_only_in_lower_case():
    """Composing comes before lower-casing in the library; the small letters of these pairs compose, the capitals do not."""
    lib, mine = Tokenizer.from_file(PATH), rans.ChunkEncoder(PATH, limit=300)
    pairs = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"]
    rng = random.Random(2)
    texts = pairs + [p.lower() for p in pairs] + ["J\u0591\u030c", "I\u0307 Plain A\u0301b, \u00c9T\u0308.", "<|endoftext|>J\u030c <|x J\u030c"]
    texts += ["".join(rng.choices([*pairs, *"aJHTWY\u00c9\u00e9\u0301\u030c\u0327 ,.1", " Word "], k=rng.randint(1, 40))) for _ in range(400)]
    ids, lens = mine.encode(texts)
    want = [lib.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert lens.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("n, symbols, lanes", [(1, 1, 1024), (63, 3, 1024), (5000, 40, 16), (70_000, 3000, 64), (200_000, 2, 1024)])
def test_coder_round_trip_and_checkpoints(n, symbols, lanes):
    rng = np.random.default_rng(n)
    s = np.minimum(rng.geometric(2 / (symbols + 1), n) - 1, symbols - 1)
    freq = 1 + np.floor(np.bincount(s, minlength=symbols) / n * ((1 << 16) - symbols)).astype(np.uint64)
    freq[0] += np.uint64((1 << 16) - int(freq.sum()))
    first = np.cumsum(freq) - freq
    slots = np.repeat(np.arange(symbols), freq.astype(np.int64))
    data = rans.encode_block(s, 16, freq, first, lanes=lanes, check=8)
    assert (rans.decode_block(data, slots, freq, first) == s).all()
    _, _, _, used, _, marks, _ = rans.HEADER.unpack_from(data)
    assert n < 5000 or marks > 0
    for m in {0, marks // 2, marks - 1} if marks else ():
        assert (rans.decode_block(data, slots, freq, first, mark=m) == s[8 * (m + 1) * used:]).all()
    if symbols > 2 and n > 1000:
        p = np.bincount(s) / n
        assert len(data) * 8 < n * -(p[p > 0] * np.log2(p[p > 0])).sum() * 1.05 + 64 * (lanes * (marks + 1) + marks) + 500  # states, and each mark's step and word


def test_token_files(make, spark):
    lib = Tokenizer.from_file(PATH)
    path = scratch_dir(spark, "coded")
    out = rans.code_and_read(make(EDGES), PATH, path).collect()
    want = [(i, lib.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in EDGES]
    got = {}
    for r in out:
        got.setdefault((r.start, r.n_tokens), []).append(r)
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.doc_id, ids) in want and len(ids) == r.n_tokens
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids))
    order = sorted(out, key=lambda r: r.start)
    assert [r.start for r in order] == [sum(x.n_tokens for x in order[:k]) for k in range(len(order))]
    assert [r.doc_id for r in order] == sorted((i for i, _ in EDGES), key=lambda i: (i is not None, i))
    blocks = spark.read.parquet(f"{path}/blocks")
    broken = scratch_dir(spark, "broken")
    blocks.withColumn("crc32", F.col("crc32") + 1).write.parquet(f"{broken}/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{broken}/table")
    with pytest.raises(Exception, match="checksum"):
        rans.read_coded(spark, broken).collect()


def test_token_files_small_blocks_and_empty(make, spark):
    rows = [(i, f"text number {i} " * (i % 17)) for i in range(300)]
    docs = make(rows).repartition(5)
    blocks = rans.token_blocks(docs, PATH, block=256).collect()
    assert len(blocks) > 10 and sorted(i for b in blocks for i in b.doc_ids) == list(range(300))
    assert rans.code_and_read(make([]), PATH).count() == 0


def test_boundaries_match_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        sizes = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 20) for _ in sizes]
        k = rng.randint(1, 4)
        padded = lambda bounds: sum(c * min(b for b in bounds if b >= s) for s, c in zip(sizes, counts, strict=True))  # noqa: B023, E731
        best = min(padded([*some, sizes[-1]]) for r in range(k) for some in combinations(sizes[:-1], r))
        got = packing.best_boundaries(sizes, counts, k)
        assert len(got) <= k and got == sorted(got) and padded(got) == best
    assert packing.best_boundaries([], [], 3) == []


def test_packing(make):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([3, 3, 3, rng.randint(0, 300)])) for i in range(900)] + [(901, None), (902, "w " * 5000), (5, "w"), (5, "w"), (None, "w w")]
    out = packing.pack(make(rows), max_len=1000, buckets=4, batch_tokens=2000).collect()
    per_doc = {}
    for r in out:
        per_doc.setdefault(r.doc_id, []).append((r.piece, r.piece_start, r.length))
        assert r.length <= r.bucket_len <= 1000
    assert len({r.bucket_len for r in out}) <= 4
    assert sorted(per_doc[902]) == [(k, 1000 * k, 1000) for k in range(5)] + [(5, 5000, 1)]
    assert per_doc[901] == [(0, 0, 1)] and len(per_doc[5]) == 3 and per_doc[None] == [(0, 0, 3)]
    assert sum(r.length for r in out) == sum(len((t or "").split()) + 1 for _, t in rows)
    batches = {}
    for r in out:
        batches.setdefault(r.batch, []).append(r)
    short = {}
    for rs in batches.values():
        assert len({r.bucket_len for r in rs}) == 1 and sorted(r.place for r in rs) == list(range(len(rs)))
        room = max(1, 2000 // rs[0].bucket_len)
        assert len(rs) <= room
        short[rs[0].bucket_len] = short.get(rs[0].bucket_len, 0) + (len(rs) < room)
    assert max(short.values()) <= 1 and sorted(batches) == list(range(len(batches)))
    assert packing.pack(make([])).count() == 0


def brute_top(rows, k, scale=1024):
    import math
    fine = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in fine:
        if q % 10 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in fine if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def test_bit_sliced_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.3, 9).astype("f4").tolist()) for i in range(230)]
    rows += [(300 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(400, None), (410, [1.0, None] + [0.0] * 7), (420, [float("nan")] * 9), (430, [float("inf")] + [0.0] * 8), (None, [1.0] * 9),
             (440, []), (450, [0.5, -2.5]), (460, [0.0] * 9), (470, [-1.0] * 9), (480, [1e4, -1e4] + [0.0] * 7), (11, [9.0] * 9), (11, [9.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1)).withColumn("id", F.lit(2))
    asked = bit_sliced.top_k(df, lambda i: i % 10 == 0, k=10)
    got = [tuple(r) for r in asked.collect()]
    assert len(got) == len(set((q, r) for q, r, _, _ in got))
    assert set(got) == brute_top(rows, 10)
    assert bit_sliced.top_k(df.limit(0), lambda i: i % 10 == 0).count() == 0
    few = bit_sliced.top_k(df.where("vec_id in (0, 10, 12)"), lambda i: i % 10 == 0)
    assert few.count() == 4


def test_signed_digits():
    q = np.arange(-3000, 3000)
    plus, minus = bit_sliced.signed_digits(q)
    assert (plus - minus == q).all() and not ((plus | minus) & ((plus | minus) << 1)).any()


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r.quality.posterior for r in quality.QualityModel(docs, labels.where("doc_id % 2 = 0")).judged().collect()}
    held = [(got[r.doc_id] >= quality.THRESHOLD, r.quality) for r in labels.where("doc_id % 2 = 1").collect()]
    good = [k for k, q in held if q == 1]
    bad = [k for k, q in held if q == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.15


def test_site_posteriors_match_brute_force(spark):
    rng = random.Random(4)
    rows = [(f"h{i % 7 if i % 3 else 0}", f"p{i % 4}", round(rng.random() * (0.3 if i % 7 == 1 else 1), 6)) for i in range(300)]
    rows.append(("sparse", "only", 0.01))
    df = spark.createDataFrame(rows, "host string, path string, p double").withColumn("odds", F.log(F.col("p") / (1 - F.col("p"))))
    sites, mean = quality.site_table(df)
    one = sites.first()
    assert abs(mean - sum(r[2] for r in rows) / len(rows)) < 1e-12
    for r in quality.posterior(df.withColumn("h", F.col("host")).withColumn("q", F.col("path")), sites, mean).collect():
        host = [x[2] for x in rows if x[0] == r.h]
        path = [x[2] for x in rows if x[:2] == (r.h, r.q)]
        p = r.quality.p
        up = (one.k_host * mean + sum(host) - p) / (one.k_host + len(host) - 1)
        low = (one.k_path * up + sum(path) - p) / (one.k_path + len(path) - 1)
        assert abs(r.quality.host_posterior - up) < 1e-9 and abs(r.quality.path_posterior - low) < 1e-9
        if r.h == "sparse":
            assert abs(low - mean) < 1e-9  # a single document says nothing about its own site


def test_quality_edges(make, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (77, 0), (None, 1), (5, None)], "doc_id long, quality int")
    docs = make([(*e, s) for e, s in zip(EDGES, [None, "a/b", "a/b/c", "", "/", "x"] * 2, strict=True)])
    out = quality.QualityModel(docs, labels).judged().collect()
    assert len(out) == len(EDGES) and all(0 <= r.quality.posterior <= 1 for r in out)
    none = labels.where("false")
    assert quality.keep_good(docs, none).count() == len(EDGES)
    assert quality.keep_good(docs, none).columns == docs.columns
    assert quality.keep_good(docs.limit(0), labels).count() == 0


def test_pipeline_stages_take_edge_cases(make, spark):
    docs = make([(*e, f"s{k % 3}") for k, e in enumerate(EDGES)])
    for some in (docs, docs.limit(0)):
        cur = some
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, cur, "/root/testdata/sf0.001")
            assert out.columns == docs.columns, name
            path = scratch_dir(spark, "t-" + name)
            out.write.parquet(path)
            cur = spark.read.parquet(path)
        assert corpus_pipeline.STAGES[-1][1](spark, cur, "").count() >= cur.count()


def test_pipeline_run(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf).collect()
    ids = {r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert out and {r.doc_id for r in out} <= ids
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "source_mix", "packing"]


def test_bit_sliced_scores_beyond_62_bits_are_an_error(spark):
    rows = lambda *v: spark.createDataFrame([(100 * i, x) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    for bad in (rows([3e6, 3e6], [3e6, 3e6]), rows([1e16], [2e16])):
        with pytest.raises(ValueError, match="62 bits"):
            bit_sliced.top_k(bad, lambda i: i % 100 == 0)
    got = bit_sliced.top_k(rows([1e5, -1e5], [1e5, 1e5], []), lambda i: i % 100 == 0).where("query_id = 0").orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(100, 0), (200, 0)]
