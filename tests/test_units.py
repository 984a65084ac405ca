"""Unit tests from worked examples (tiny inline DataFrames, hand-computed results)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from searchlake.functions import datemath
from searchlake.operators import facets as fc
from searchlake.operators import filters as flt
from searchlake.operators import grouping as grp
from searchlake.operators import index as ix
from searchlake.operators import signatures as sig
from searchlake.operators import textmatch as tm


def test_min_should_match_specs():
    m = flt.min_should_match
    assert m(3, "75%") == 2
    assert m(4, "-25%") == 3
    assert m(5, "2<75% 9<-3") == 3
    assert m(12, "2<75% 9<-3") == 9
    assert m(2, "2<75% 9<-3") == 2
    assert m(5, "-1") == 4 and m(5, "2") == 2 and m(3, "7") == 3


def test_date_math_examples():
    now = dt.datetime(2013, 7, 15, 13, 45, 10)
    r = datemath.resolve
    assert r("NOW/HOUR", now) == dt.datetime(2013, 7, 15, 13)
    assert r("NOW/DAY", now) == dt.datetime(2013, 7, 15)
    assert r("NOW+2YEARS", now) == dt.datetime(2015, 7, 15, 13, 45, 10)
    assert r("NOW-1DAY", now) == dt.datetime(2013, 7, 14, 13, 45, 10)
    assert r("NOW/DAY+6MONTHS+3DAYS", now) == dt.datetime(2014, 1, 18)
    assert r("NOW+6MONTHS+3DAYS/DAY", now) == dt.datetime(2014, 1, 18)
    assert r("2013-01-31T00:00:00Z+1MONTH") == dt.datetime(2013, 2, 28)
    # DST day in a zone: rounding to the local day
    assert r("NOW/DAY", dt.datetime(2013, 3, 31, 12), tz="Europe/Berlin") == dt.datetime(2013, 3, 30, 23)


def test_range_edges_hardend_and_extension():
    lows, highs, end = fc.range_edges(0, 10, 4)
    assert lows == [0, 4, 8] and highs == [4, 8, 12] and end == 12
    lows, highs, end = fc.range_edges(0, 10, 4, hardend=True)
    assert highs[-1] == 10 and end == 10


def test_range_facet_edge_inclusion(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 5, 10, 15, 20, 20]], "v double")
    rows = {r["bucket"]: r["count"] for r in fc.facet_range(df, "v", 0, 20, 10).collect()}
    assert rows == {0: 2, 1: 2}  # lower only: 20 falls outside
    rows = {r["bucket"]: r["count"] for r in fc.facet_range(df, "v", 0, 20, 10, include=["lower", "upper"]).collect()}
    assert rows == {0: 3, 1: 4}  # 10 is counted in both buckets
    other = {r["label"]: r["count"] for r in fc.facet_range(df, "v", 0, 20, 10, other="all").collect()
             if r["bucket"] is None}
    assert other == {"before": 0, "after": 2, "between": 4}


def test_facet_mincount_zero_and_missing(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), (None, 1), ("a", 1)], "k string, m int")
    out = {r["k"]: r["count"] for r in fc.facet_field(df, "k", where=F.col("m") == 1, missing=True).collect()}
    assert out == {"a": 2, "b": 0, None: 1}


def test_pivot_and_grouping(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "p", 3), ("x", "p", 4)], "a string, b string, k int")
    piv = {(r["level"], r["a"], r["b"]): r["count"] for r in fc.facet_pivot(df, ["a", "b"]).collect()}
    assert piv[(1, "x", None)] == 3 and piv[(2, "x", "p")] == 2 and piv[(2, "y", "p")] == 1
    g = grp.group_by_field(df, "a", key="k", sort="k desc", limit=-1, group_limit=1).collect()
    assert {(r["a"], r["k"], r["group_rank"]) for r in g} == {("x", 4, 1), ("y", 3, 2)}


def test_phrase_and_sloppy_phrase(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "a x b"), (3, "b a")], "doc_id long, text string")
    idx = ix.build_index(docs, "doc_id", "text")
    exact = {r["doc_id"]: r["freq"] for r in tm.phrase_freq(idx, ["a", "b"]).collect()}
    assert exact == {1: 1}
    sloppy = {r["doc_id"]: r["freq"] for r in tm.sloppy_phrase_freq(idx, ["a", "b"], 1).collect()}
    # doc 1: a@0 b@1 is distance 0 (freq 1); a@2 with b@1 needs distance 2 > slop
    assert sloppy[1] == 1.0 and abs(sloppy[2] - 0.5) < 1e-12 and 3 not in sloppy


def test_text_profile_signature_ignores_rare_tokens(spark):
    docs = spark.createDataFrame([(1, "alpha beta beta gamma gamma"), (2, "Beta beta GAMMA gamma delta!")],
                                 "doc_id long, text string")
    out = {r["doc_id"]: r["signature"] for r in sig.signature_text_profile(docs, "doc_id", "text").collect()}
    assert out[1] == out[2]  # counts of 1 are below quant 2
    prof = {r["doc_id"]: r["_profile"] for r in
            sig.signature_text_profile(docs, "doc_id", "text", with_profile=True).collect()}
    assert prof[1] == "beta 2\ngamma 2"


def test_geofilt_dateline(spark):
    df = spark.createDataFrame([(1, 10.0, 179.5), (2, 10.0, -179.5), (3, 10.0, 170.0)], "id int, lat double, lon double")
    ids = {r["id"] for r in df.filter(flt.geofilt("lat", "lon", 10.0, 179.9, 100.0)).collect()}
    assert ids == {1, 2}


# ------------------------------------------------------------------ values worked out from the definitions

def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_global_row_number_is_complete(spark):
    from searchlake.operators.sorting import sort_docs
    from searchlake.operators.util import global_row_number
    df = spark.range(0, 40_000, 1, 23).select("id", (F.col("id") * 7919 % 1000).alias("k"), F.repeat(F.lit("wide "), 40).alias("pad"))
    for aqe in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            r = global_row_number(df, [F.col("k").desc(), F.col("id")])
            got = r.agg(F.count(F.lit(1)), F.count_distinct("rank"), F.min("rank"), F.max("rank"), F.count_distinct("id")).first()
            assert tuple(got) == (40_000, 40_000, 1, 40_000, 40_000)
            a, b = (r.select(F.col("rank").alias(f"r{x}"), F.col("k").alias(f"k{x}"), F.col("id").alias(f"i{x}")) for x in "ab")
            wrong = a.join(b, F.col("ra") + 1 == F.col("rb")).where("ka < kb or (ka = kb and ia > ib)")
            assert wrong.count() == 0
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sort_docs(df, "k desc", "id").count() == 40_000


def test_ngram_similarity():
    from searchlake.functions.scalar import _ngram_distance as sim
    for w in ("abc", "contest", "a", "ab", ""):
        assert sim(w, w) == 1.0
    assert sim("abc", "") == 0.0 and sim("a", "b") == 0.0 and sim("ab", "a") == 0.5
    assert sim("abc", "xbc") == pytest.approx(1 - 1.5 / 3) and sim("contest", "context") == pytest.approx(1 - 1 / 7)


def test_german_normalization_and_word_delimiter(spark):
    from searchlake.operators import analysis as an
    words = ["ueber", "oel", "quelle", "straße", "aue", "poesie", "bär", "maenner"]
    got = _one(spark, an.german_normalization()(F.array(*map(F.lit, words))))
    assert got == ["uber", "ol", "quelle", "strasse", "aue", "posie", "bar", "manner"]
    split = _one(spark, an.word_delimiter()(F.array(*map(F.lit, ["ABCDef", "café-Bar", "wiFi500", "O'Neil's", "über2Ñandú"]))))
    assert split == [["ABCDef"], ["café", "Bar"], ["wi", "Fi", "500"], ["O", "Neil"], ["über", "2", "Ñandú"]]


def test_short_tokens_have_no_long_grams(spark):
    from searchlake.operators import analysis as an
    a = F.array(F.lit("a"), F.lit("abcd"), F.lit(""))
    assert _one(spark, an.ngrams_of_tokens(2, 3)(a)) == [[], ["ab", "bc", "cd", "abc", "bcd"], []]
    assert _one(spark, an.edge_ngrams(2, 3)(a)) == [[], ["ab", "abc"], []]
    assert _one(spark, an.edge_ngrams(2, 9, side="back")(a)) == [[], ["cd", "bcd", "abcd"], []]
    assert _one(spark, an.ngram_tokenizer(2, 3)(F.lit("a"))) == []
    assert _one(spark, an.path_hierarchy("/")(F.lit("/a/b"))) == ["/a", "/a/b"]
    assert _one(spark, an.path_hierarchy("/", skip=3)(F.lit("/a"))) == []


def _index_of(spark, rows):
    from searchlake.operators import analysis as an
    from searchlake.operators import index as ix
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return ix.build_index(df, "doc_id", "text", an.Analyzer(an.split_tokenizer()))


def test_positions_of_phrases_and_spans(spark):
    from searchlake.operators import textmatch as tm
    idx = _index_of(spark, [(1, "a x y"), (2, "a a b"), (3, "a b a"), (4, "a b b")])
    sloppy = {r.doc_id: r.freq for r in tm.sloppy_phrase_freq(idx, ["a", "a"], 2).collect()}
    assert 1 not in sloppy and set(sloppy) == {2, 3}
    spans = tm.span_near([tm.span_term(idx, "a"), tm.span_term(idx, "b")], slop=1).collect()
    assert sorted((r.doc_id, r.start, r.end) for r in spans) == [(2, 1, 3), (3, 0, 2), (4, 0, 2)]
    both = tm.span_near([tm.span_term(idx, "b"), tm.span_term(idx, "a")], slop=0, in_order=False).collect()
    assert sorted((r.doc_id, r.start, r.end) for r in both) == [(2, 1, 3), (3, 0, 2), (3, 1, 3), (4, 0, 2)]


def test_two_swaps_are_two_edits(spark):
    from searchlake.operators import textmatch as tm
    idx = _index_of(spark, [(1, "badc abcd acbd abdcx bdca")])
    got = {r.term: r.edits for r in tm.expand_fuzzy(idx, "abcd", 2).collect()}
    assert got["badc"] == 2 and got["abcd"] == 0 and got["acbd"] == 1 and got["abdcx"] == 2


def test_atomic_updates_arrival_and_new_keys(spark):
    from searchlake.operators import mutate
    base = spark.createDataFrame([(1, 1)], "k long, v int")
    ops = spark.createDataFrame([(1, "v", "set", "10"), (1, "v", "inc", "5"), (9, "v", "inc", "3")], "k long, field string, op string, value string").coalesce(1)
    assert sorted(map(tuple, mutate.atomic_update(base, ops, "k").collect())) == [(1, 15), (9, 3)]


def test_streams_survive_a_restart(spark, tmp_path):
    from searchlake.streaming import ingest
    schema = "k long, version long, v string"

    def add(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/{name}")

    def run(start, name):
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/{name}")
        q, current = start(s)
        q.awaitTermination()
        return current()

    ups = lambda s: ingest.stream_upsert(s, f"file://{tmp_path}/t1", "k", f"file://{tmp_path}/c1", order="version")
    ver = lambda s: ingest.stream_versioned(s, f"file://{tmp_path}/t2", "k", "version", f"file://{tmp_path}/c2")
    add([(1, 1, "a"), (2, 1, "b")], "s")
    assert run(ups, "s").count() == 2 and run(ver, "s").count() == 2
    add([(3, 1, "c"), (1, 5, "d"), (2, -7, "gone")], "s")
    assert {r.k: r.v for r in run(ups, "s").collect()} == {1: "d", 2: "b", 3: "c"}
    run(ver, "s")
    add([(2, 6, "late")], "s")
    assert {r.k: r.v for r in ingest.live_rows(run(ver, "s"), "version").collect()} == {1: "d", 3: "c"}


def test_null_facet_values_and_requests_run_twice(spark):
    from searchlake.operators import joins, stats
    df = spark.createDataFrame([("x", [1, 2]), (None, [3]), (None, None), ("y", None)], "f string, a array<int>")
    rows = {r.f: (r["count"], r.missing) for r in stats.stats_field(df, "a", "f").collect()}
    assert rows == {"x": (2, 0), None: (1, 1), "y": (0, 1)}
    docs = spark.createDataFrame([(1, ["p", "q"]), (1, ["p", "q"]), (2, ["z"])], "id int, tags array<string>")
    keys = spark.createDataFrame([("p",), ("q",)], "t string")
    assert [r.id for r in joins.join_filter(docs, "tags", keys, "t").collect()] == [1, 1]


def test_multi_word_synonyms(spark, tmp_path):
    from searchlake.operators import analysis as an
    from searchlake.operators import synonyms as sy
    docs = spark.createDataFrame([(1, "big apple in new york city"), (2, "tv"), (3, ""), (4, None), (5, "new york big")], "id long, text string")
    rules = sy.parse_rules(["new york city => nyc", "new york => ny state", "tv, television set", "# note"])
    got = {}
    for r in sy.synonym_tokens(docs, "id", "text", rules).collect():
        got.setdefault(r.doc_id, set()).add((r.pos, r.term))
    assert got == {1: {(0, "big"), (1, "apple"), (2, "in"), (3, "nyc")}, 2: {(0, "tv"), (0, "television"), (1, "set")},
                   5: {(0, "ny"), (1, "state"), (2, "big")}}
    reduced = sy.parse_rules(["tv, television set"], expand=False)
    assert reduced == [(("tv",), [("tv",)]), (("television", "set"), [("tv",)])]
    path = tmp_path / "wn.pl"
    path.write_text("s(100000001,1,'Woods',n,1,0).\ns(100000001,2,'wood',n,1,0).\ns(100000002,1,'one''s',n,1,0).\n")
    sets = sy.read_wordnet(spark, f"file://{path}")
    assert [(r.synset, r.words) for r in sets.collect()] == [("100000001", ["wood", "woods"])]
    assert sorted(map(tuple, sy.wordnet_pairs(sets, expand=False).collect())) == [("wood", "wood"), ("woods", "wood")]


def test_payload_checks_and_letter_normalization(spark):
    from searchlake.operators import analysis as an
    from searchlake.operators import synonyms as sy
    toks = an.delimited_payloads(spark.createDataFrame([(1, 0, "a|1.5"), (1, 1, "b|2"), (1, 2, "a"), (2, 0, "a|2")], "doc_id long, pos int, term string"))
    assert [tuple(r) for r in sy.span_payload(toks, "a", 1.5).collect()] == [(1, 0, 1)]
    assert [tuple(r) for r in sy.span_payload(toks, "a", None).collect()] == [(1, 2, 3)]
    spans = spark.createDataFrame([(1, 0, 3), (2, 0, 1)], "doc_id long, start int, end int")
    assert sorted((r.doc_id, r.payloads) for r in sy.payloads_of(spans, toks).collect()) == [(1, [1.5, 2.0]), (2, [2.0])]
    words = F.array(F.lit("\u0623\u062d\u0645\u064e\u062f"), F.lit("\u0645\u062f\u0631\u0633\u0629"))
    assert _one(spark, an.arabic_normalization()(words)) == ["\u0627\u062d\u0645\u062f", "\u0645\u062f\u0631\u0633\u0647"]
    assert _one(spark, an.persian_normalization()(F.array(F.lit("\u06a9\u06cc")))) == ["\u0643\u064a"]


def test_word_breaks_whole_matches_brute_force(spark, tmp_path):
    """Words of every language and length, rare terms and query words: all cuts into one, two or three terms."""
    import re
    from collections import Counter

    from searchlake.plans.catalog_more import c13_whole

    path = str(tmp_path)
    texts = [("en", "note book notebooks s data base database under stand understanding ing"), ("de", "Haus tür Haustür schlüssel Haustürschlüssel"),
             ("fr", "porte feuille portefeuille a b ab abc c"), ("es", "para guas paraguas " + "x " + "x" * 120)]
    spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 0, "user", "bookdata haustürbase"), (1, 1, "assistant", "basebook")], "conv_id long, turn int, role string, text string") \
        .write.parquet(f"{path}/conversations.parquet")
    df = Counter(w for _, t in texts for w in set(re.findall(r"\w+", t.lower())))
    want = []
    for w in {*df, "bookdata", "haustürbase"}:
        for i in range(1, len(w)):
            if w[:i] in df:
                want += [(w, (w[:i], w[i:]), 1, min(df[w[:i]], df[w[i:]]))] if w[i:] in df else []
                want += [(w, p, 2, min(df[x] for x in p)) for j in range(i + 1, len(w)) for p in [(w[:i], w[i:j], w[j:])] if all(x in df for x in p)]
    got = [(r.word, tuple(r.parts), r.changes, r.freq) for r in c13_whole(spark, path).collect()]
    assert sorted(got) == sorted(want)
    assert {"haustürschlüssel", "portefeuille", "bookdata", "understanding"} <= {r[0] for r in got}


def test_queries_of_one_language_say_so():
    import __spark_entry__ as entry

    for name, lang in (("t30_stemmer_override_and_keywords", "en"), ("t35_dictionary_decompounding_german", "de"), ("t36_elision_french", "fr"),
                       ("t40_english_minimal_stemming_vocabulary", "en"), ("t37_german_normalization", "de")):
        assert f"lang = '{lang}'" in (entry.queries()[name].__doc__ or ""), name
    assert "20 or more" in entry.queries()["t35_dictionary_decompounding_german"].__doc__


@pytest.mark.parametrize("group", [None, "kind"])
def test_ewma_rates_by_partial_aggregates(spark, group):
    """The recursion tick by tick, with null and single-tick groups; no task gets all ticks of a key."""
    import math
    from collections import Counter, defaultdict

    from searchlake.operators import stats

    rows = [(s, k) for s, k in zip([0, 1, 3, 12, 12, 61, 64, 300, 301, 7, 900], ["a", "a", None, "a", "b", "b", "a", "a", None, None, "one"], strict=True)]
    df = spark.createDataFrame(rows, "s long, kind string").select(F.timestamp_seconds("s").alias("ts"), "kind")
    ticks = defaultdict(Counter)
    for s, k in rows:
        ticks[k if group else None][s // 5] += 1
    want = {}
    for k, x in ticks.items():
        first, last = min(x), max(x)
        rates = []
        for minutes in (1, 5, 15):
            alpha, r = 1 - math.exp(-5 / 60 / minutes), x[first] / 5
            for t in range(first + 1, last + 1):
                r += alpha * (x[t] / 5 - r)
            rates.append(r)
        want[k] = (last - first + 1, *rates)
    out = stats.ewma_rates(df, "ts", 5, group)
    assert "Window" not in out._jdf.queryExecution().toString()
    got = {r[group] if group else None: (r.ticks, r.m1_rate, r.m5_rate, r.m15_rate) for r in out.collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9)
    empty = stats.ewma_rates(df.limit(0), "ts", 5, group).collect()
    assert [tuple(r) for r in empty] == ([] if group else [(None,) * 4])
