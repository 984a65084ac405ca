"""Cases that once came out wrong."""

from searchlake.operators import mutate
from searchlake.operators import components as cp
from searchlake.sources import writers


def test_csv_lines_before_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('junk\nid,name\n1,x\n2,"y,z"\n')
    (tmp_path / "b.csv").write_text("other junk\nid,name\n\n3,\n")
    df = writers.read_csv_docs(spark, str(tmp_path), skip_lines=1)
    assert df.columns == ["id", "name"]
    assert sorted(map(tuple, df.collect())) == [("1", "x"), ("2", "y,z"), ("3", None)]
    named = writers.read_csv_docs(spark, str(tmp_path / "a.csv"), skip_lines=2, fieldnames=["k", "v"])
    assert sorted(map(tuple, named.collect())) == [("1", "x"), ("2", "y,z")]


def test_versions_of_one_key_count_one_after_another(spark):
    base = spark.createDataFrame([(1, 5, "a"), (2, 7, "b")], "id long, version long, v string")
    updates = spark.createDataFrame(
        [(1, 5, "first", 1), (1, 5, "second", 2), (1, 6, "third", 3), (2, -1, "no", 4), (3, 1, "no", 5), (3, -1, "new", 6), (3, 1, "again", 7), (2, 0, "any", 8),
         (2, None, "null", 9)], "id long, version long, v string, seq int")
    out = mutate.upsert_versioned(base.withColumn("seq", base.id.cast("int")), updates, "id", order="seq")
    assert sorted((r.id, r.version, r.v) for r in out["table"].collect()) == [(1, 7, "third"), (2, 9, "null"), (3, 2, "again")]
    assert sorted((r.id, r.v, r.current_version) for r in out["conflicts"].collect()) == [(1, "second", 6), (2, "no", 7), (3, "no", None)]
    assert sorted((r.id, r.v, r.version) for r in out["accepted"].collect()) == [
        (1, "first", 6), (1, "third", 7), (2, "any", 8), (2, "null", 9), (3, "again", 2), (3, "new", 1)]


def test_word_breaks(spark):
    vocab = spark.createDataFrame([("ab", 3), ("c", 2), ("abc", 9), ("a", 1), ("bc", 4)], "term string, df long")
    words = spark.createDataFrame([("abc",), ("xab",), ("c",)], "word string")
    got = sorted((r.word, tuple(r.parts), r.changes, r.freq) for r in cp.word_breaks(vocab, words, 2).collect())
    assert got == [("abc", ("a", "bc"), 1, 1), ("abc", ("ab", "c"), 1, 2)]


def test_files_of_documents(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.xml").write_text('<add>\n<doc><field name="id">01</field><field name="t">a</field><field name="t">b &amp; c</field></doc>\n<doc><field name="id">2</field></doc></add>')
    assert [r.fields for r in writers.read_xml_docs(spark, str(tmp_path / "x")).collect()] == [{"id": ["01"], "t": ["a", "b & c"]}, {"id": ["2"]}]
    (tmp_path / "words").write_text("One\n\n two \none\n")
    assert sorted(r.term for r in writers.read_word_file(spark, str(tmp_path / "words")).collect()) == ["one", "two"]


def test_entities(spark):
    from pyspark.sql import functions as F

    from searchlake.operators.ingest import decode_entities

    rows = [("a &amp;lt; &middot; &#65;&#x1F600; &nope; & &#0; &#55296; &apos;",), (None,), ("",)]
    got = [r.t for r in spark.createDataFrame(rows, "t string").select(decode_entities(F.col("t")).alias("t")).collect()]
    assert got == ["a &lt; · A😀 &nope; & &#0; &#55296; '", None, ""]


def test_more_like_this_without_hot_joins(spark):
    import random

    from searchlake.operators import index as ix

    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, weights=[60 / (j + 1) for j in range(60)], k=40))) for i in range(150)], "id long, text string")
    idx = ix.build_index(docs, "id", "text")
    some = docs.filter("id % 10 = 0").select(docs.id.alias("doc_id"))
    rows = lambda hot: sorted((r.source_id, r["rank"], r.doc_id, round(r.score, 8)) for r in cp.more_like_these(
        idx, some, k=4, hot_df=hot, min_tf=1, min_df=1).collect())
    plain = rows(10_000)
    assert len(plain) == 60 and rows(5) == plain and rows(40) == plain and rows(0) == plain


def test_term_index_opens_only_the_terms_folders(spark, tmp_path):
    from searchlake.operators import index as ix
    from searchlake.operators import scoring

    docs = spark.createDataFrame([(i, "the common words " + f"rare{i}") for i in range(50)], "id long, text string")
    docs.write.parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    idx = ix.session_index(docs, "id", "text")
    assert ix.session_index(docs, "id", "text").postings.inputFiles() == idx.postings.inputFiles()
    plan = idx.terms(["rare7"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: [IsNotNull(term), EqualTo(term,rare7)" in plan
    built = ix.build_index(docs, "id", "text")
    rows = lambda i: sorted((r.doc_id, round(r.score, 9)) for r in scoring.bm25(i, ["the", "rare7"]).collect())
    assert rows(idx) == rows(built) and idx.terms([]).count() == 0
    many = ix.write_term_index(built, f"file://{tmp_path}/idx", docs, "id", docs_a_part=10, docs_a_file=5, least_parts=2)
    assert many.parts == 5 and rows(many) == rows(built)


def test_stream_writes_only_touched_buckets(spark, tmp_path):
    from searchlake.streaming import ingest

    schema = "k long, version long, v string"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")

    def run(buckets=8):
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
        q, table = ingest.stream_upsert(s, f"file://{tmp_path}/t", "k", f"file://{tmp_path}/c", order="version", buckets=buckets)
        q.awaitTermination()
        return table()

    add([(k, 1, "a") for k in range(100)])
    assert run().count() == 100
    add([(3, 2, "b"), (3, 1, "old")])
    assert {r.v for r in run().filter("k = 3").collect()} == {"b"}
    held = ingest._manifest(spark, f"file://{tmp_path}/t", 1)
    assert sorted(held.values()) == [0] * 7 + [1]
    assert run().count() == 100
    # the version before is still whole, and a batch that is run again writes the same
    kind = run().schema
    assert ingest.read_table(spark, f"file://{tmp_path}/t", kind, 0).filter("v = 'a'").count() == 100
    batch = spark.createDataFrame([(3, 2, "b"), (3, 1, "old")], schema)
    from searchlake.operators import mutate
    for _ in range(2):
        ingest._commit(batch, f"file://{tmp_path}/t", 1, "k", 8, lambda a, b: mutate.latest_per_key(a.unionByName(b), "k", "version"))
    assert sorted(map(tuple, run().collect())) == sorted([(k, 1, "a") for k in range(100) if k != 3] + [(3, 2, "b")])
    import pytest
    with pytest.raises(ValueError):
        ingest._commit(batch, f"file://{tmp_path}/t", 2, "k", 4, lambda a, b: b)


def test_letters(spark):
    from pyspark.sql import functions as F

    from searchlake.operators import analysis as an
    from searchlake.operators import letters

    one = lambda step, w: spark.range(1).select(F.get(step(F.array(F.lit(w))), F.lit(0))).first()[0]
    assert one(letters.hindi_normalization(), "हिन्दी") == "हिंदि"
    assert one(letters.hindi_normalization(), "ज़ॄॐ") == "जृॐ"
    rules = letters.indic_rules()
    assert len(rules) > 100 and rules["अा"] == "आ" and rules["ൻ".replace("ൻ", "ന്‍")] == "ൻ"
    import random
    rng = random.Random(12)
    letters_ = "अआाेैॅॉकख़്നന്‍ेு"
    for _ in range(30):
        text = "".join(rng.choices(letters_, k=12))
        out, at = "", 0
        while at < len(text):
            key = next((k for k in sorted(rules, key=len, reverse=True) if text.startswith(k, at)), None)
            out, at = out + (rules[key] if key else text[at]), at + (len(key) if key else 1)
        assert one(letters.indic_normalization(), text) == out
    chain = lambda t: spark.range(1).select(an.preset("cjk").array(F.lit(t))).first()[0]
    assert chain("ＡＢＣ 漢字仮x 名") == ["abc", "漢字", "字仮", "x", "名"]
    wiki = "[[Category:Red Cats]] a [[Link|to it]] [http://x.y/z the site] ==Big Head== ===Sub=== '''bold''' ''it'' '''''both''''' {{cite me}} end"
    got = [(r.term, r.type) for r in spark.range(1).select(F.explode(letters.wiki_tokens(F.lit(wiki))).alias("t")).select("t.*").collect()]
    assert got == [("Red", "c"), ("Cats", "c"), ("a", "word"), ("Link", "il"), ("to", "il"), ("it", "il"), ("http://x.y/z", "elu"), ("the", "el"), ("site", "el"),
                   ("Big", "h"), ("Head", "h"), ("Sub", "sh"), ("bold", "b"), ("it", "i"), ("both", "bi"), ("cite", "ci"), ("me", "ci"), ("end", "word")]


def test_functions_by_name(spark):
    import pytest
    from pyspark.sql import functions as F

    from searchlake.functions import registry as fnr

    fnr.register_function("twice", lambda x: x * 2, 1)
    try:
        assert spark.range(3).select(fnr.call("TWICE", "id").alias("x")).agg(F.sum("x")).first()[0] == 6
        for bad in (lambda: fnr.register_function("twice", lambda x: x), lambda: fnr.call("twice", "id", 2), lambda: fnr.call("unknown")):
            with pytest.raises(ValueError):
                bad()
    finally:
        fnr.unregister_function("twice")
