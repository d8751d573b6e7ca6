"""Extra columns whose names an operator uses itself change none of its rows."""

import pytest
from pyspark.sql import functions as F

from returnscope.llm import decontaminate, hnsw, jaccard, quality, substring, template, tokens, warc

NAMES = (
    "block n place score slot host path row row_key _row_key _null _kept0 word words bucket shard key vector vec token tokens item digest set_id "
    "component_id n_shingles n_words n_removed kept_sha256 held_out quality label labels window windows hash rank part band norm size total cell p w r x "
    "payload payload_bytes payload_digest record_type refers_to url_key timestamp tag salt doc copies n_tokens weight held pages_ members root"
).split()


def widened(df):
    return df.select("*", *(F.lit("x").alias(c) for c in NAMES if c not in df.columns))


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    shared = " ".join(f"common{i}" for i in range(40))
    texts = [f"own{i} text {i} {shared if i % 3 == 0 else ''} tail{i} of words" for i in range(30)]
    texts += [texts[0], texts[1] + " more", "what is the capital city of the old northern kingdom by the sea near here", None, ""]
    table = [(i, t) for i, t in enumerate(texts)] + [(None, texts[2]), (5, texts[5])]
    return spark.createDataFrame(table, "doc_id long, text string").coalesce(2)


@pytest.mark.parametrize(
    "run",
    [
        lambda d: tokens.count_tokens(d),
        lambda d: substring.dedup_substrings(d, k=20),
        lambda d: jaccard.jaccard_components(d.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), k=3, percent=90),
    ],
    ids=["tokens", "substring", "jaccard"],
)
def test_documents(docs, run):
    assert rows(run(widened(docs))) == rows(run(docs))


def test_quality(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    plain = quality.score_quality(docs, quality.learn(docs, labels))
    wide = widened(docs)
    assert rows(quality.score_quality(wide, quality.learn(wide, widened(labels)))) == rows(plain)


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "What is the capital city of the old northern kingdom by the sea near here")], "item_id long, text string")
    plain = decontaminate.contaminated(docs, items)
    assert plain.count() == 1
    assert rows(decontaminate.contaminated(widened(docs), widened(items))) == rows(plain)
    kept = decontaminate.without_contaminated(widened(docs), items)
    assert kept.columns == widened(docs).columns and kept.count() == docs.count() - 1


def test_pages(spark):
    page = "<html><body><div class='menu'>Home</div><article><p>Text number {0} of the page</p></article></body></html>"
    pages = spark.createDataFrame([(i, f"http://h{i % 2}.example/{i}", page.format(i)) for i in range(12)], "page_id long, url string, html string")
    assert rows(template.extract(widened(pages))) == rows(template.extract(pages))
    archived = [rows(warc.placed(warc.archive_pages(p)).select("page_id", "payload_digest", "record_type", "refers_to", "url_key", "place")) for p in (pages, widened(pages))]
    assert archived[0] == archived[1]


def test_vectors(spark):
    table = [(i, [float((i * j) % 7 + 1) for j in range(1, 5)]) for i in range(60)] + [(60, None), (61, [0.0] * 4)]
    vectors = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert rows(hnsw.nearest(widened(vectors), top=5, every=20)) == rows(hnsw.nearest(vectors, top=5, every=20))


def test_kept_columns_may_have_any_name(docs):
    wide = docs.withColumns({"block": F.lit("b"), "n_words": F.lit("n"), "_null": F.col("text").isNull(), "_kept1": F.lit(3)})
    out = substring.dedup_substrings(wide, keep=("block", "n_words", "_null", "_kept1"))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "block", "n_words_kept", "_null", "_kept1"]
    assert {(r.block, r.n_words_kept, r._kept1) for r in out.collect()} == {("b", "n", 3)}
    assert rows(out.select("doc_id", "n_words", "n_removed", "kept_sha256")) == rows(substring.dedup_substrings(docs))


def test_pipeline_stages_keep_clashing_columns(spark, docs, tmp_path):
    import corpus_pipeline

    items = [(1, "What is the capital city of the old northern kingdom by the sea near here")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    wide = widened(docs).withColumn("mine", F.col("doc_id"))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, wide, str(tmp_path))
        assert out.columns == wide.columns, name
        got = [r.asDict() for r in out.collect()]
        assert 0 < len(got) < wide.count() + (name == "substring_dedup"), name
        assert all(r["mine"] == r["doc_id"] and r["_row_key"] == "x" and r["_null"] == "x" for r in got), name
