"""Pages, vectors and the pipeline against brute force, and their odd input."""

import hashlib
import html as entities
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from returnscope.llm import hnsw, template, warc

SF = "/root/testdata/sf0.001"


def test_warc_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    some = pages.collect()
    extra = [(10_000 + i, r.url, r.html) for i, r in enumerate(some[:20])]
    extra += [(20_000, None, None), (20_001, "http://a b/c\nd?é", ""), (20_002, None, "x" * 99), (20_003, None, "x" * 99), (20_004, "u", "é" * 50), (20_005, "u", "é" * 50), (-3, "u", "é" * 50)]
    both = pages.union(spark.createDataFrame(extra, pages.schema))
    got = warc.archive_pages(both, range_records=10, archive_bytes=20_000).collect()
    rows = [(r.page_id, (r.html or "").encode()) for r in both.collect()]
    first = {}
    for i, body in rows:
        first[body] = min(i, first.get(body, i))
    want = {i: (len(b), hashlib.sha256(b).hexdigest(), "revisit" if len(b) >= 100 and first[b] != i else "response", first[b] if len(b) >= 100 and first[b] != i else None) for i, b in rows}
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want and len(got) == len(rows)
    keys = [(r.url_key, r.timestamp, r.page_id) for r in sorted(got, key=lambda r: (r.range, r.position))]
    assert keys == sorted(keys) and len({r.range for r in got}) > 3
    places = sorted((r.place, (r.url_key, r.timestamp, r.page_id)) for r in warc.placed(warc.archive_pages(both, range_records=10, archive_bytes=20_000)).collect())
    assert places == list(enumerate(sorted(keys), 1))  # the global order, across ranges
    assert warc.placed(warc.archive_pages(pages.limit(0))).count() == 0
    ties = spark.createDataFrame([(None, None, "")] * 400 + [(7, "http://a.b/", "q")] * 100, pages.schema).withColumn("range", F.lit(1))
    tied = warc.placed(warc.archive_pages(ties, range_records=50)).collect()  # rows that tie spread over ranges
    assert sorted(r.place for r in tied) == list(range(1, 501)) and len({r.range for r in tied}) > 4
    assert {r.url_key for r in tied if r.place <= 100} == {"b,a)/"}
    repeated = warc.archive_pages(spark.createDataFrame([(1, "u", "z" * 200), (1, "u", "z" * 200), (None, "u", "z" * 200)], pages.schema)).collect()
    assert [r.record_type for r in repeated] == ["response"] * 3
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_loser_tree_merges_any_runs():
    r = random.Random(5)
    for k in range(9):
        runs = [sorted(r.choices(range(30), k=r.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.url_key("https://user@WWW.Example.com:443/A?b=1#c") == "com,example,www)/a?b=1"
    assert warc.url_key("http://a.b:8080") == "b,a:8080)/" and warc.url_key(None) == "" and warc.url_key("http://[x") == "http://[x"


PAGE = (
    "<html><head><title>T</title></head><body><header class=top>Site</header><div id='cookie-notice'><p>We use cookies</p></div>"
    "<nav><a>Home</a></nav><div class='layout'><main><article class=post><h1>Head &amp; line</h1><p>One <b>bold</b>  text<br>next<p>Two{n}"
    "<ul><li>a<li>b</ul><aside>side</aside><table><tr><td>c1<td>c2</table><form><input>x</form><div class='ad-slot'>buy</div>"
    "</article><section class='comments'><p>nice post</p></section></main><div class=sidebar>more</div></div><footer>f</footer>"
    "<script>if (a<b) '</p>'</script></body></html>"
)
WANT = "Head & line\nOne bold text next\nTwo{n}\na\nb\nc1\nc2"


def test_template_extraction(spark):
    plain = "<body><div class=box><p>{t}</p><p>more {t}</p></div><div class=menu><p>menu</p></div></body>"
    rows = [(i, "http://h.example/x", PAGE.format(n=i)) for i in range(4)]
    rows += [(10 + i, "http://p.example/", plain.format(t="words " * (i + 3))) for i in range(3)]
    rows += [(20, None, None), (21, "u", ""), (22, "http://h.example/", "<article><p>cut <a hre"), (23, "http://one.example/", "text &lt;only&gt; <!-- no"), (24, "http://h.example/x", PAGE.format(n=0)), (0, "http://h.example/x", PAGE.format(n=0))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (100_000, 0):  # broadcast hosts, and salted ones
        out = template.extract(pages, broadcast_hosts=limit).collect()
        got = {r.page_id: r.text for r in out}
        assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
        assert all(got[i] == WANT.format(n=i) for i in range(4)) and got[24] == got[0]
        assert got[10] == "words words words\nmore words words words" and got[20] == got[21] == ""
        assert got[22] == "cut" and got[23] == "text <only>"
    assert template.extract(pages.limit(0)).count() == 0


def test_class_words_do_not_drop_the_article(spark):
    side = "<div class='sidebar'><p>side words</p></div><div class='ad-slot'><p>buy</p></div>"
    article = "<p>first words of page {n}</p><p>second words</p>"
    want = "first words of page {n}\nsecond words"
    shapes = [
        f"<body class='page no-sidebar'><article>{article}</article>{side}</body>",
        f"<body class='comments-open post sidebar'><main class='main-content with-sidebar'>{article}{side}</main></body>",
        f"<body><div class='has-sidebar layout'><article class='post category-social tag-search'>{article}</article></div>{side}</body>",
        f"<body><div class='sidebar layout'><article class='post social'>{article}</article></div></body>",
        f"<body><section class='discussion'>{article}</section></body>",
        f"<body><article><div class='entry-header'><p>first words of page {{n}}</p></div><p>second words</p></article>{side}</body>",
        "<body>" + "".join(f"<div class='layer{'x' * 60}{'abcdefghijklmnopqrstuvwxyz'[i]}'>" for i in range(20)) + f"<div class='content'>{article}</div></body>",
        f"<body><article>{article}<div class='comments'><article><p>a comment</p></article></div></article></body>",
    ]
    for pages_a_host in (1, 3):
        rows = [(10 * i + n, f"http://h{i}.example/{n}", html.format(n=n)) for i, html in enumerate(shapes) for n in range(pages_a_host)]
        out = template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        assert {r.page_id: r.text for r in out} == {i: want.format(n=i % 10) for i, _, _ in rows}


def test_template_on_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in template.extract(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        lines = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", inside))]
        assert got[r.page_id] == "\n".join(x for x in lines if x)


def test_hnsw_recall_and_exact_scores(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 16))
    points = np.concatenate([centres[i % 12] + 0.4 * r.normal(size=16) for i in range(900)]).reshape(-1, 16) * r.uniform(0.5, 2, size=(900, 1))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(2000 + i, rows[40][1]) for i in range(50)]
    rows += [(5000, None), (5020, []), (5040, [0.0] * 16), (5060, [None] + [1.0] * 15), (5080, [float("nan")] + [1.0] * 15), (None, rows[0][1]), (6000, [1.0, 2.0]), (6001, [3.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in hnsw.nearest(vectors, shard_size=300).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    good = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and len(v) == 16 and not any(x is None or x != x for x in v) and any(v)]
    ids, matrix = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    hits = total = 0
    for i, v in good:
        if i % 20 == 0:
            score = matrix @ v
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:20]
            mine = sorted(got[i])
            assert [m[0] for m in mine] == list(range(1, 21)) and all(abs(s - float(np.dot(v, matrix[list(ids).index(j)]))) < 1e-9 for _, j, s in mine)
            hits += len({j for _, j, _ in mine} & set(ids[order]))
            total += 20
    assert hits >= 0.95 * total and got[6000] == [(1, 6001, 5.0)] and not {5000, 5020, 5040, 5060, 5080} & set(got)
    assert hnsw.nearest(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("factor", [1.0, 1e4, 1e150])
def test_hnsw_recall_of_a_full_shard_with_skewed_norms(factor):
    r = np.random.default_rng(0)
    vectors = r.normal(size=(4096, 64))
    vectors[[5, 900, 3000]] *= factor
    score = vectors[:100] @ vectors.T
    found = [[] for _ in range(100)]
    band = hnsw.bands(vectors)
    for b in np.unique(band):
        mine = np.flatnonzero(band == b)
        for near, places in zip(found, hnsw.search(vectors[:100], vectors[mine], *hnsw.build(vectors[mine]), 96), strict=True):
            near += mine[places[places >= 0]].tolist()
    hits = sum(len(set(sorted(f, key=lambda j: -s[j])[:20]) & set(np.argsort(-s)[:20].tolist())) for f, s in zip(found, score, strict=True))
    assert hits >= 0.94 * 2000


def test_bands_of_equal_and_extreme_norms():
    r = np.random.default_rng(2)
    unit = r.normal(size=(500, 8))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    assert set(hnsw.bands(unit).tolist()) == {0}
    assert hnsw.bands(np.array([[1e300, 1e300], [1e-300, 0.0], [4.0, 0.0]])).tolist() == [1994, -1993, 4]


@pytest.fixture(scope="module")
def pipeline_rows(spark):
    return {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns and [f.dataType for f in now.schema] == [f.dataType for f in docs.schema]


def test_pipeline_equals_brute_force_after_the_classifier(spark, pipeline_rows):
    from .test_documents import brute_components, brute_substring

    docs = corpus_pipeline.quality_classifier(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    component = brute_components(rows, 5, 80)
    rows = [(i, t) for i, t in rows if component[i][1] == i]
    left = {i: n - gone for i, (n, gone, _) in brute_substring(rows, 20).items()}
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(pipeline_rows) <= set(left)
    for i, t in rows:
        if i in pipeline_rows:
            assert pipeline_rows[i].n_tokens == left[i] and pipeline_rows[i].rate >= 0
        else:
            plain = " ".join(re.findall(r"\w+", t.lower()))
            assert any(" ".join(x.split()[1:13]) in plain for x in items)
