"""Steps whose memory must not grow with the input: how texts are dealt, how exploded keys are joined, what is computed once."""

import random
import re

from pyspark.sql import functions as F

from searchlake.operators import analysis as an
from searchlake.operators import components as cp
from searchlake.operators import dismax as dm
from searchlake.operators import fragments as fr
from searchlake.operators import index as ix
from searchlake.operators import morphology as mo
from searchlake.operators import streams as st
from searchlake.operators import synonyms as sy
from searchlake.operators import util


def _docs(spark, n=40):
    return spark.createDataFrame([(i, f"the word{i % 7} of the eau {i} lich") for i in range(n)], "doc_id long, text string")


def test_parts_grow_with_the_bytes_of_text(spark):
    docs = spark.createDataFrame([(1, "a" * 500), (2, None), (3, "ü" * 250)], "doc_id long, text string")
    assert util.parts_of(docs, "text", 10) == 100
    lines = docs.select("doc_id", F.split("text", "x").alias("lines"))
    assert util.parts_of(lines, "lines", 10) == 100
    assert util.parts_of(docs.limit(0), "text") == spark.sparkContext.defaultParallelism


def test_parts_of_tokens_are_not_merged(spark):
    """Adaptive execution merged all parts of these texts into one task."""
    docs = _docs(spark)
    n = util.parts_of(docs, "text")
    assert n > 1
    assert st.token_stream(docs, "doc_id", "text").rdd.getNumPartitions() == n
    assert ix.build_index(docs, "doc_id", "text").postings.rdd.getNumPartitions() == n


def test_index_folders_grow_with_the_bytes(spark, tmp_path, monkeypatch):
    docs = _docs(spark)
    monkeypatch.setattr(ix, "parts_of", lambda *a: 40)
    index = ix.write_term_index(ix.build_index(docs, "doc_id", "text"), str(tmp_path / "ix"), docs, "doc_id", docs_a_file=20, text_col="text")
    assert index.parts == 20  # two files a folder
    for folder in (tmp_path / "ix" / "postings").glob("part=*"):
        assert len(list(folder.glob("*.parquet"))) <= 2
    assert index.terms(["the"]).agg(F.sum("tf")).first()[0] == 80


def test_exploded_keys_are_sorted_not_broadcast(spark):
    big, small = spark.range(1000).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    joined = util.join_keys(big, small, "k", max_rows=10)
    assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" not in plan(joined)
    assert "BroadcastHashJoin" in plan(util.join_keys(big, small, "k", max_rows=50))
    assert joined.count() == 50


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_suggestions_by_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    made = sorted({"".join(rnd.choice("abcü") for _ in range(rnd.randint(1, 8))) for _ in range(300)})
    vocab = spark.createDataFrame([(w, i % 9 + 1) for i, w in enumerate(made)], "term string, df long")
    words = made[::3] + ["abcabca", None]
    asked = spark.createDataFrame([(w,) for w in words], "word string")
    want = {(w, t) for w in words if w and len(w) >= 4 for t in made
            if w != t and w[0] == t[0] and _distance(w, t) <= 2 and 1 - _distance(w, t) / max(len(w), len(t)) >= 0.5}
    near = {(w, t) for w in words if w for t in made if w != t and _distance(w, t) <= int(max(len(w), len(t)) * 0.4 + 1e-9)}
    for limit in (100_000, 3):
        monkeypatch.setattr(cp, "join_keys", lambda big, small, on, n=limit: util.join_keys(big, small, on, n))
        got = [(r.word, r.suggestion) for r in cp.spell_suggest(vocab, asked, count=10_000).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        got = [(r.word, r.term) for r in cp.near_strings(asked, vocab, 0.6).collect()]
        assert len(got) == len(set(got)) and set(got) == near


def test_grams_by_code_points(spark):
    texts = ["", "a", "añ😀b", "héllo wörld", "  x "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string")
    got = {r.i: r.g for r in df.select("i", an.ngram_tokenizer(2, 3)(F.col("t")).alias("g")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [t[k:k + n] for n in (2, 3) for k in range(len(t) - n + 1)]


def test_parts_of_a_token_in_order(spark):
    words = ["banana", "strength", "queue", "xyz", "aeiouxa" * 40]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    for r in df.select("t", st.regex_parts(r"[^aeiou]*[aeiou]+")(F.col("t")).alias("p")).collect():
        assert [(p["term"], p["from"], p["to"]) for p in r.p] == [(m.group(), *m.span()) for m in re.finditer(r"[^aeiou]*[aeiou]+", r.t)]


def test_fragments_read_the_tokens_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(fr, "written", lambda df, name: calls.append(name) or util.written(df, name))
    docs = _docs(spark, 6)
    out = fr.highlight_fragments(docs.select("doc_id"), docs, "doc_id", "text", [fr.clause("of the"), fr.clause("lich")], snippets=2)
    assert out.count() == 6 and calls == ["fragments"]
    assert out.filter("doc_id = 3").first()["snippet"] == "the word3 <em>of</em> <em>the</em> eau 3 <em>lich</em>"


def test_grams_of_a_phrase_are_found_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(dm, "written", lambda df, name: calls.append(name) or util.written(df, name), raising=False)
    docs = spark.createDataFrame([(1, "therin Therin"), (2, "ther in"), (3, None)], "doc_id long, text string")
    idx = ix.build_index(docs, "doc_id", "text", an.Analyzer(an.ngram_tokenizer(2, 2), [an.lowercase()]))
    assert dm.ngram_phrase_freq(idx, ["th", "he", "er", "ri", "in"], 2).collect() == [(1, 2)]
    assert calls == ["phrase-grams"]


def test_places_of_words_do_not_travel(spark):
    """Places inside terms are grouped where their term lies: the terms are dealt, nothing else is."""
    terms, words = (spark.createDataFrame([(w,) for w in some], "term string") for some in (["abcd", "ab", None], ["ab", "cd", None]))
    bitmap = mo._word_bitmap(mo._words(words))
    paths = mo._paths(mo._maybe_words(mo._cuts(mo._dealt_terms(terms), 2, 20, False), bitmap))
    assert paths._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(term") == 1
    assert "SortMergeJoin" not in paths._jdf.queryExecution().executedPlan().toString()
    assert [(r.term, list(r.sizes)) for r in paths.collect()] == [("abcd", [2, 2])]


def test_segments_are_words_whatever_the_bitmap_lets_through(spark, monkeypatch):
    terms = ["abcdef", "abcd", "xabx", "abab", "zz", "ab", "", None]
    table = lambda some: spark.createDataFrame([(w,) for w in some], "term string")
    want = {"abcdef": ["abcd", "ef"], "abcd": ["ab", "cd"], "abab": ["ab", "ab"]}
    for let_through in (mo._maybe_words, lambda cut, bitmap: cut, lambda cut, bitmap: cut.filter("part not in ('abc', 'def')")):
        monkeypatch.setattr(mo, "_maybe_words", let_through)
        got = {r.term: r.parts for r in mo.segment_compounds(table(terms), table(["ab", "cd", "ef", "abcd", None])).collect()}
        assert got == want
        held = mo.parts_of_terms(table(terms), table(["ab", "cd", "ef", "abcd"]))
        assert sorted(tuple(r) for r in held.filter("term = 'abcdef'").collect()) == [("abcdef", 0, 2), ("abcdef", 0, 4), ("abcdef", 2, 4), ("abcdef", 4, 6)]


def _held(df):
    return sorted(((r.term, str(r.doc_id), r.tf, r.dl, list(r.positions)) for r in df.collect()))


def test_index_deals_a_row_for_a_batch_and_term(spark, tmp_path, monkeypatch):
    """A row for each posting was dealt to the folders: here 40 documents of 6 terms each."""
    docs, rows = _docs(spark), []
    kind = type(docs)
    deal = kind.repartitionById
    monkeypatch.setattr(kind, "repartitionById", lambda self, *a: rows.append(self.count()) or deal(self, *a))
    docs.repartition(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    monkeypatch.setattr(ix, "parts_of", lambda *a: 2)
    built = ix.build_index(docs, "doc_id", "text")
    index = ix.write_term_index(built, str(tmp_path / "ix"), docs, "doc_id", least_parts=2, text_col="text")
    assert index.postings.count() == 240 and rows[0] <= 2 * (4 + 7) + 40  # in two parts; the word that comes twice has no other row
    assert _held(index.postings) == _held(built.postings)


def test_index_of_odd_rows(spark, tmp_path, monkeypatch):
    """Null ids and texts, ids that come again with the same and with another length, ids that are strings, removed words, many files."""
    rows = [(1, "b a b"), (1, "b c a"), (1, "b"), (None, "a a"), (None, "x a"), (2, None), (3, ""), (4, "the of stop")] + [(i, f"w{i % 3} a") for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "id long, text string")
    chain = an.Analyzer(an.split_tokenizer(" "), [an.stop_filter(["the", "c"])])
    for k, d in enumerate((docs, docs.withColumn("id", F.concat(F.lit("ü, "), F.col("id").cast("string"))))):
        built = ix.build_index(d, "id", "text", chain)
        index = ix.write_term_index(built, str(tmp_path / f"ix{k}"), d, "id", docs_a_file=10, least_parts=3)
        assert _held(index.postings) == _held(built.postings)
        assert index.postings.drop("part").schema.simpleString() == built.postings.select(index.postings.drop("part").columns).schema.simpleString()
        assert sorted(index.term_stats.collect()) == sorted(built.term_stats.collect())
        assert index.field_stats.collect() == built.field_stats.collect()
    assert ("a", "None", 3, 2, [0, 1, 1]) in _held(ix.build_index(docs, "id", "text", chain).postings)
    read = ix.read_index(spark, str(tmp_path / "ix0"))
    again = ix.write_term_index(read, str(tmp_path / "again"), docs, "id", least_parts=2)
    assert _held(again.postings) == _held(read.postings)


def test_surfaces_by_pieces(spark):
    """A token's surface came from the text's front on: 3 s for this text, and the square of its length in general."""
    text = "é😀 " + " ".join(f"Wort{i}ü" for i in range(4000)) + " " + "x" * 200
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "a\nB")], "doc_id long, text string")
    out = st.surface(st.token_stream(docs, "doc_id", "text"), docs, "doc_id", "text")
    assert "substring(_text" not in out._jdf.queryExecution().optimizedPlan().toString()
    rows = out.orderBy("doc_id", "pos").collect()
    assert len(rows) == 4004 and all(r.surface.lower() == r.term for r in rows)
    assert all(r.surface == (text if r.doc_id == 1 else "a\nB")[r.start:r.end] for r in rows)
    odd = spark.createDataFrame([(1, 64, 64), (1, 60, 200), (2, 0, 3), (3, 0, 1), (4, 2, 90)], "doc_id long, start int, end int")
    assert {r.start: r.surface for r in st.surface(odd, docs.filter("doc_id <> 2"), "doc_id", "text").collect()} == {
        64: "", 60: text[60:200], 0: None, 2: "B"}


def test_outputs_of_sets_travel_once(spark, monkeypatch):
    """A set of k synonyms has k outputs, not k for each of its words, and no match carries them."""
    names = {}
    monkeypatch.setattr(sy, "written", lambda df, name: names.setdefault(name, util.written(df, name)))
    words = [f"w{i}" for i in range(150)]
    sets = spark.createDataFrame([("1", words), ("2", ["w0", "other thing"]), ("3", ["w0", "other thing"])], "synset string, words array<string>")
    docs = spark.createDataFrame([(1, "w3 a w0"), (2, "b w149"), (2, "b w149"), (None, "w7 w7")], "doc_id long, text string")
    out = sy.apply_rule_table(an.token_table(docs, "doc_id", "text", with_length=False), sy.wordnet_rules(sets))
    got = [(r.doc_id, r.pos, r.term) for r in out.collect()]
    want = {(1, 0, w) for w in words} | {(1, 1, "a")} | {(1, 2, w) for w in words} | {(1, 2, "other"), (1, 3, "thing")}
    want |= {(2, 0, "b")} | {(2, 1, w) for w in words} | {(None, p, w) for p in (0, 1) for w in words}
    assert len(got) == len(set(got)) and set(got) == want
    assert names["rule-outputs"].select(F.sum(F.size("outputs"))).first()[0] < 2 * len(words) + 10
    assert "outputs" not in names["rule-matches"].columns and names["rule-blocks"].select(F.max(F.size("p"))).first()[0] == sy.OUTPUT_BLOCK


def test_tokens_are_dealt_once_for_rules(spark):
    """Tokens were shuffled twice more, by position and by all of their columns."""
    docs = spark.createDataFrame([(i, f"a b c{i % 3} d") for i in range(30)] + [(3, "a b c0 d")], "doc_id long, text string")
    tokens = an.token_table(util.dealt(docs, "doc_id", "text"), "doc_id", "text", with_length=False)
    out = sy.apply_rule_table(tokens, sy.rule_table(spark, [(("a", "b"), [("ab",), ("a",)])]))
    assert out.count() == 30 * 4 and not out.filter("pos = 1 or term = 'b'").head(1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and ", pos#" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)


def test_only_words_without_near_terms_are_searched_in_full(spark, monkeypatch):
    """All words met all terms of a like length; few edits answer most of them."""
    rnd = random.Random(12)
    terms = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 8))) for _ in range(150)} | {"xyzxyzxyz", "xyzxyzqqqq", "ü😀ü😀ü😀ü😀"})
    words = [*terms[::4], "xyzxyzxy", "ü😀ü😀ü😀aaa", "", None]
    vocab = spark.createDataFrame([(t, i % 9 + 1) for i, t in enumerate(terms)], "term string, df long")
    full, near = [], cp.near_strings
    monkeypatch.setattr(cp, "near_strings", lambda w, *a: full.append(w.count()) or near(w, *a))
    got = sorted(tuple(r) for r in cp.spell_ngram(vocab, spark.createDataFrame([(w,) for w in words], "word string"), 3, 2, 0.6)
                 .select("word", "suggestion", "freq", "rank").collect())
    grams = lambda t: {t[i:i + 3] for i in range(max(len(t) - 2, 1))}
    want = []
    for w in filter(None, words):
        some = [(-1 + _distance(w, t) / max(len(w), len(t)), -(i % 9 + 1), t) for i, t in enumerate(terms) if t != w and grams(t) & grams(w)]
        want += [(w, t, -n, r) for r, (_, n, t) in enumerate(sorted(x for x in some if -x[0] >= 0.6 - 1e-12)[:2], 1)]
    assert got == sorted(want) and sum(full) <= 5
