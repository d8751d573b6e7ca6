"""Document operators against brute force, and their defined results on odd input."""

import collections
import hashlib
import itertools
import random
import re
import warnings
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from returnscope.llm import decontaminate, jaccard, language, mixing, pieces, quality, substring, tokens, words
from returnscope.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, texts, schema=SCHEMA):
    rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def corpus():
    """Random texts, exact and near copies, shared passages, repeats, odd texts."""
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(300)]
    line = [r.choice(vocabulary) for _ in range(30)]
    out = []
    for i in range(120):
        w = [r.choice(vocabulary) for _ in range(r.randint(1, 150))]
        if i % 5 == 0:
            w[len(w) // 2 : len(w) // 2] = line
        out.append((i, " ".join(w)))
        if i % 4 == 0:
            out.append((1000 + i, out[-1][1].upper() if i % 8 == 0 else out[-1][1] + "\n"))
        if i % 3 == 0 and len(w) > 40:
            w = list(w)
            for _ in range(r.randint(1, 3)):
                w[r.randrange(len(w))] = "changed"
            out.append((2000 + i, "  ".join(w)))
    copies = [(5000 + i, " ".join(line) + " tail") for i in range(60)]
    odd = [(9000, None), (9001, ""), (9002, " \n\t "), (9003, "one"), (9004, "two words"), (9005, "x " * 5000), (9006, "y" * 3000), (9007, "\x0b a\x0cb \r\n c"), (9008, "One")]
    return out + copies + odd


def brute_substring(rows, k):
    seen, out = set(), {}
    for i, x in sorted(rows):
        w = (x or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            t = tuple(w[j : j + k])
            if t in seen:
                gone[j : j + k] = [True] * k
            seen.add(t)
        kept = [a for a, b in zip(w, gone, strict=True) if not b]
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 3000, "shard_windows": 500}])
def test_substring_dedup_equals_brute_force(spark, corpus, settings):
    docs = make_docs(spark, corpus)
    for k in (3, 20):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_substrings(docs, k=k, **settings).collect()}
        assert got == brute_substring(corpus, k)


def test_substring_dedup_text_and_columns(spark):
    base = " ".join(f"w{i}" for i in range(30))
    docs = make_docs(spark, [(1, base), (2, f"head  {base}\nend"), (3, "kept  as\tit is"), (None, "null id"), (4, None)])
    out = substring.dedup_substrings(docs, k=20, keep=("source",), with_text=True)
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == base and got[3].text == "kept  as\tit is" and got[4].text == ""
    assert got[2].text == "head  end" and got[2].n_removed == 30 and got[2].source == "s" and got[None].n_words == 2
    assert substring.dedup_substrings(docs.limit(0)).count() == 0


def brute_components(rows, k, percent):
    sets = {}
    for i, x in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "").encode().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent", "part"), [(3, 90, 20_000), (5, 80, 4), (2, 50, 7)])
def test_jaccard_components_equal_brute_force(spark, corpus, k, percent, part):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(make_docs(spark, corpus), k, percent, part).collect()}
    assert got == brute_components(corpus, k, percent)


def test_jaccard_odd_rows(spark):
    docs = make_docs(spark, [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "A B C D"), (8, None)])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, None), (7, 2, 5), (8, 0, 8)], key=str)
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_divide_skip_equals_counting():
    r = random.Random(3)
    for _ in range(200):
        query = sorted(r.sample(range(60), r.randint(1, 30)))
        records = [sorted(r.sample(range(60), r.randint(1, 30))) for _ in range(r.randint(1, 12))]
        required = [r.randint(1, 20) for _ in records]
        want = [(i, len(set(query) & set(x))) for i, x in enumerate(records) if len(set(query) & set(x)) >= required[i]]
        assert sorted(jaccard.divide_skip(query, records, required)) == want


def test_components_of_a_long_chain(spark):
    r = random.Random(1)
    ids = r.sample(range(10_000), 300)
    edges = list(zip(ids, ids[1:], strict=False)) + [(4, 4), (ids[0], ids[5])]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(x.u, x.v) for x in got} == {(i, min(ids)) for i in ids if i != min(ids)}


def test_words_and_hashes():
    texts = ["a b", "", "ab  ab\x0b", "é\x85x\x1fy z", "a b"]
    buf, off = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, first = words.split(buf, off)
    got = [[buf[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [t.encode().split(None) for t in texts[:3]] + [["é\x85x\x1fy".encode(), b"z"], [b"a", b"b"]]
    for chunk in (1, 3, 1 << 18):
        h = words.hashes(buf, starts, ends, chunk)
        flat = [w for x in got for w in x]
        assert all((flat[i] == flat[j]) == (h[i] == h[j]) for i in range(len(flat)) for j in range(len(flat)))


# --- decontamination --------------------------------------------------------

ITEM = "the train leaves at 9 in the morning and travels 120 km to a town called Berlin where it waits for 30 minutes before it goes on"


def test_decontamination(spark):
    swapped = ITEM.replace("120 km", "75 miles").replace("Berlin", "Madrid").replace("30 minutes", "4 hours")
    mixed = "if 9 apples cost 9 euros then how many euros do 9 pears cost when 9 pears weigh as much as 9 apples"
    item2 = mixed
    docs = [
        (1, f"some words first. {ITEM} and some after"), (2, ITEM.upper()), (3, swapped), (4, " ".join(ITEM.split()[:10])),
        (5, None), (6, ""), (7, mixed.replace("9", "7")), (8, mixed.replace("9 apples", "3 apples").replace("9 pears", "5 pears")),
        (9, " ".join(f"w{i}" for i in range(60))), (None, ITEM),
    ]
    bench = spark.createDataFrame([(1, ITEM), (2, item2), (3, None), (4, "too short"), (1, ITEM)], "item_id long, text string")
    for limit in (1_000_000, 0):  # broadcast, and the way beyond it
        got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(make_docs(spark, docs), bench, broadcast_rows=limit).collect()}
        assert set(got) == {(1, 1), (2, 1), (3, 1), (7, 2)}
        assert got[1, 1].n_changed == 0 and got[3, 1].n_changed >= 3
    left = decontaminate.without_contaminated(make_docs(spark, docs), bench)
    assert {r.doc_id for r in left.collect()} == {4, 5, 6, 8, 9, None} and left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert decontaminate.contaminated(make_docs(spark, docs), bench.limit(0)).count() == 0


# --- quality, language, tokens, mixing --------------------------------------


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    scored = quality.score_quality(docs, model)
    assert scored.count() == docs.count() and scored.columns == ["doc_id", "held_out", "score", "predicted"]
    marked = scored.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in marked) >= 0.95 * len(marked)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored.collect())
    kept = quality.keep_good(docs, model)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in scored.filter("score >= 0.7").collect()}


def test_quality_odd_rows(spark, corpus):
    docs = make_docs(spark, corpus)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_quality(docs, quality.learn(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(3, None, 0), (None, 0, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, quality.learn(docs, one)).collect()
    assert len(got) == len(corpus) and min(r.score for r in got) > 0.99


def test_flat_trees_equal_walking_one_by_one():
    r = np.random.default_rng(0)
    x = r.normal(size=(500, 5))
    model = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float), trees=40, depth=3)
    assert ((model.score(x) > 0.5) == (x[:, 0] + x[:, 1] * x[:, 2] > 0)).mean() > 0.9
    for row in range(20):
        total = model.base
        for t in range(40):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(x[row, model.feature[t, node]] > model.threshold[t, node])
            total += model.leaf[t, node - 7]
        assert model.raw(x)[row] == pytest.approx(total)


def brute_forward(word, table):
    p = [1.0] + [0.0] * len(word)
    for e in range(1, len(word) + 1):
        p[e] = p[e - 1] * np.exp(language.FLOOR)
        for s in range(e):
            p[e] += p[s] * table.get(word[s:e], 0.0)
    return p[-1]


def test_forward_sums_all_segmentations():
    some = [b"a", b"b", b"ab", b"ba", b"\x01a", b"abb"]
    logp = np.log(np.array([[0.2, 0.1], [0.1, 0.3], [0.3, 0.1], [0.1, 0.2], [0.2, 0.2], [0.1, 0.1]]))
    text = [b"a", b"abab", b"bbabba", b"xx", b"abba"]
    ends = np.cumsum([len(t) for t in text])
    matrix, length = pieces.as_matrix(np.frombuffer(b"".join(text), np.uint8), ends - [len(t) for t in text], ends)
    got = language.Lattice(matrix, length, pieces.Vocabulary(some)).total(logp)
    for j in range(2):
        table = {p: np.exp(logp[i, j]) for i, p in enumerate(some)}
        assert np.exp(got[:, j]) == pytest.approx([brute_forward(b"\x01" + t, table) for t in text])


def long_tokens():
    r = random.Random(3)
    made = ["".join(r.choice("abcdeéß的是中国人") for _ in range(r.randint(1, 300))) for _ in range(40)]
    made += ["的是中国人民在一个有" * 30, "https" * 40, "donaudampfschifffahrtsgesellschaftskapitän" * 3, "a", "\u0416" * 200]
    text = [x.encode() for x in made]
    ends = np.cumsum([len(t) for t in text])
    return np.frombuffer(b"".join(text), np.uint8), ends - [len(t) for t in text], ends, text


@pytest.mark.parametrize("rows, cells", [(2000, 1 << 18), (7, 500), (1, 1)])
def test_long_pre_tokens_are_summed_whole(rows, cells):
    buf, starts, ends, text = long_tokens()
    some = [b"\x01", b"a", b"ab", "的".encode(), "的是".encode(), "中国人民".encode(), b"http", b"https", b"schiff", b"dampfschiff", b"\x01a", "\u0416\u0416".encode()]
    logp = np.log(np.random.default_rng(0).dirichlet(np.ones(len(some)), 3).T)
    got = language.Stream(buf, starts, ends, pieces.Vocabulary(some)).total(logp, rows, cells)
    for j in range(3):
        table = dict(zip(some, logp[:, j], strict=True))
        for x, t in zip(got[:, j], text, strict=True):
            word, p = b"\x01" + t, [0.0]
            for e in range(1, len(word) + 1):
                ways = [p[e - 1] + language.FLOOR] + [p[s] + table[word[s:e]] for s in range(max(0, e - 20), e) if word[s:e] in table]
                p.append(float(np.logaddexp.reduce(ways)))
            assert x == pytest.approx(p[-1])


def test_expected_counts_of_long_and_short_pre_tokens_agree():
    buf, starts, ends, text = long_tokens()
    vocabulary = pieces.Vocabulary(pieces.read_pieces())
    logp = np.log(np.random.default_rng(1).dirichlet(np.ones(vocabulary.size)))
    weight = np.arange(1.0, len(text) + 1)
    want = language.Lattice(*pieces.as_matrix(buf, starts, ends), vocabulary).expected(logp, weight)
    for cells in (1 << 21, 3000, 1):
        assert np.allclose(language.Stream(buf, starts, ends, vocabulary).expected(logp, weight, cells), want)


def test_one_round_of_fitting_equals_all_segmentations():
    some, counts = [b"\x01", b"\x01a", b"a", b"b", b"ab", b"ba", b"aba"], {b"aba": 3, b"ab": 2, b"bbaab": 1, b"ab" * 40: 1}

    def ways(word, table):
        """log of the sum over segmentations and the expected count of each piece, by trying each first part."""
        known = {len(word): (0.0, {})}
        for i in range(len(word) - 1, -1, -1):
            parts = [(language.FLOOR, None, 1)] + [(table[q], q, len(q)) for q in some if word.startswith(q, i)]
            value = [x + known[i + n][0] for x, _, n in parts]
            total = float(np.logaddexp.reduce(value))
            seen = collections.Counter()
            for v, (_, q, n) in zip(value, parts, strict=True):
                for a, c in [*known[i + n][1].items(), *([(q, 1.0)] if q else [])]:
                    seen[a] += c * np.exp(v - total)
            known[i] = total, seen
        return known[0]

    table = dict.fromkeys(some, -np.log(len(some)))
    for _ in range(2):
        seen = {q: language.SMOOTHING for q in some}
        for t, n in counts.items():
            for q, c in ways(b"\x01" + t, table)[1].items():
                seen[q] += n * c
        table = {q: np.log(x / sum(seen.values())) for q, x in seen.items()}
    assert language.fit({"x": counts}, some, rounds=2)[:, 0] == pytest.approx([table[q] for q in some])


def test_language_of_scripts_without_spaces(spark):
    zh, ja = "我们在这里学习中文和历史，今天的天气很好。", "私たちはここで日本語と歴史を学びます。今日は天気がいい。"
    rows = [(i, (zh if i % 2 else ja) * (1 + i % 7), "zh" if i % 2 else "ja", "s", 1) for i in range(60)]
    rows += [(100, zh * 700, None, "s", 1), (101, ja * 700, None, "s", 1), (102, zh * 2000, "zh", "s", 1)]  # 102: beyond sample_chars, not learned from
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = docs.select("*", *(F.lit("x").alias(c) for c in ("held_out", "spoken", "place", "n", "token", "score")))
    for frame in (docs, clashing):
        got = {r.doc_id: r.lang_pred for r in language.predict(frame, *language.learn(frame)).collect()}
        assert (got[100], got[101], got[102]) == ("zh", "ja", "zh") and all(got[i] == ("zh" if i % 2 else "ja") for i in range(60))


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.predict(docs, *language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de's", "s", 1) for i in range(40)]
    rows += [(100, None, "en", "s", 0), (101, "123 !!", "en", "s", 0), (102, "THE DOG", None, "s", 0), (103, "hund " * 2000, None, "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in language.predict(docs, *language.learn(docs)).collect()}
    assert got[100].lang_pred == got[101].lang_pred == "und" and got[100].score == 0
    assert got[102].lang_pred == "en" and got[103].lang_pred == "de's"
    nothing = language.predict(docs, *language.learn(docs.limit(0))).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(rows)


def test_token_counts_equal_brute_force(spark, corpus):
    vocabulary = pieces.read_pieces()
    score, floor = tokens.scores(vocabulary)
    table = dict(zip(vocabulary, score, strict=True))

    def best(word):
        x = bytes([pieces.MARK]) + word
        at = [(0.0, 0)]
        for e in range(1, len(x) + 1):
            found = [(at[e - 1][0] + floor, at[e - 1][1] + 1)]
            found += [(at[s][0] + table[x[s:e]], at[s][1] + 1) for s in range(e) if x[s:e] in table]
            top = max(v for v, _ in found)
            at.append(min(((v, n) for v, n in found if v > top - 1e-9), key=lambda z: z[1]))
        return at[-1][1]

    want = {}
    for i, x in corpus:
        w = (x or "").encode().split()
        want[i] = (len(w), sum(map(best, w)))
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in tokens.count_tokens(make_docs(spark, corpus)).collect()} == want


def test_long_words_are_counted_whole(spark):
    vocabulary = pieces.read_pieces()
    score, floor = tokens.scores(vocabulary)
    table = dict(zip(vocabulary, score, strict=True))

    def best(word):
        x = bytes([pieces.MARK]) + word
        at = [(0.0, 0)]
        for e in range(1, len(x) + 1):
            found = [(at[e - 1][0] + floor, at[e - 1][1] + 1)]
            found += [(at[s][0] + table[x[s:e]], at[s][1] + 1) for s in range(max(0, e - 64), e) if x[s:e] in table]
            top = max(v for v, _ in found)
            at.append(min(((v, n) for v, n in found if v > top - 1e-9), key=lambda z: z[1]))
        return at[-1][1]

    r = random.Random(11)
    texts = ["".join(r.choice(x) for _ in range(n)) for x, n in (("日本語中国文字化的是不了人我在有他这", 500), ("абвгдежзиклмнопрстуя", 660), ("http://example.org/a?b=c&index", 125), ("AZaz09+/", 5000), ("the of in ion er", 300))]
    texts += ["b" * 64, "b" * 65, "é" * 40, "\x01a" * 50]
    docs = [(i, t) for i, t in enumerate([*texts, " ".join(texts), None])]
    want = {i: sum(best(w) for w in (t or "").encode().split()) for i, t in docs}
    assert {x.doc_id: x.n_tokens for x in tokens.count_tokens(make_docs(spark, docs)).collect()} == want
    words_ = [w for t in texts for w in t.encode().split()]
    ends = np.cumsum([len(w) for w in words_])
    model = pieces.Vocabulary(vocabulary)
    for step in (7, 50, 1 << 14):
        got = tokens.stream_counts(np.frombuffer(b"".join(words_), np.uint8), ends - [len(w) for w in words_], ends, model, score, floor, step)
        assert got.tolist() == [best(w) for w in words_]


def test_mixing_reaches_targets(spark):
    good = [(i, "plain words in a row of text " * 5, None, "s", 1) for i in range(60)]
    bad = [(100 + i, "$$$ ### LOUD %%% &&& " * 8, None, "s", 1) for i in range(20)]
    odd = [(900, None, None, "s", 0), (901, "", None, "s", 0), (None, "x", None, "s", 0)]
    docs = spark.createDataFrame(good + bad + odd, SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(15)] + [(None, 1, 1), (77777, 1, 0)], "doc_id long, quality int, toxic int")
    out = mixing.mix_to_targets(docs, labels, {"quality1_toxic0": 3.0, "quality0_toxic0": 1.0}, iterations=100).collect()
    assert len(out) == 83 and all(r.rate >= 0 for r in out) and all(abs(sum(r.domains.values()) - 1) < 1e-9 for r in out)
    total = sum(r.n_tokens for r in out)
    got = collections.Counter()
    for r in out:
        for d, p in r.domains.items():
            got[d] += r.rate * r.n_tokens * p
    assert got["quality1_toxic0"] == pytest.approx(0.75 * total, rel=0.02) and got["quality0_toxic0"] == pytest.approx(0.25 * total, rel=0.02)
    none = mixing.mix_to_targets(docs, labels.limit(0)).collect()
    assert {tuple(r.domains) for r in none} == {("all",)} and {round(r.rate, 6) for r in none} == {1.0}
    assert mixing.mix_to_targets(docs.limit(0), labels).count() == 0


def test_arrow_slices_keep_all_rows():
    from returnscope.llm.common import slices, strings, text_buffers

    texts = ["a" * n for n in (0, 5, 100, 1, 0, 30)] + [None]
    batch = pa.record_batch([pa.array(range(7)), pa.array(texts)], names=["i", "text"])
    parts = list(slices(iter([batch]), "text", 40))
    assert [x for p in parts for x in p.column("i").to_pylist()] == list(range(7)) and len(parts) > 2
    buf, off = text_buffers(parts[-1].column("text"))
    assert strings(buf, off).to_pylist() == [t or "" for t in parts[-1].column("text").to_pylist()]


def test_mixing_totals_are_the_least_squares_optimum(spark):
    r = np.random.default_rng(4)
    for domains, sharp in ((2, 0.3), (3, 0.3), (4, 5.0)):
        for _ in range(2):
            p = r.dirichlet([sharp] * domains, 14)
            n = r.uniform(0, 1, 14) * (r.random(14) < 0.8)
            n /= n.sum()
            goal = r.dirichlet([0.5] * domains)
            best, least = None, np.inf  # an optimum stands on at most as many cells as there are domains
            for size in range(1, domains + 1):
                for some in itertools.combinations(np.flatnonzero(n), size):
                    a = p[list(some)].T * n[list(some)]
                    x = np.linalg.lstsq(a, goal, rcond=None)[0]
                    if (x >= 0).all() and np.sum((a @ x - goal) ** 2) < least:
                        best, least = a @ x, np.sum((a @ x - goal) ** 2)
            cells = spark.createDataFrame([(i, float(n[i]), p[i].tolist()) for i in range(14)], "cell int, w double, p array<double>")
            with warnings.catch_warnings(record=True) as said:  # steps that end early state how far off they may be
                warnings.simplefilter("always")
                got = {x.cell: x.r for x in mixing.fit_rates(cells, goal.tolist(), iterations=120, tolerance=1e-3).collect()}
            bounds = [float(re.search(r"within (\S+)", str(x.message))[1]) for x in said if "domain totals" in str(x.message)]
            rate = np.array([got[i] for i in range(14)])
            assert (rate >= 0).all() and np.linalg.norm(p.T @ (n * rate) - best) <= max([1e-3, *(1.05 * b for b in bounds)])
            assert all(b < 0.05 for b in bounds)


def test_mixing_rates_stay_below_the_bound(spark):
    cells = spark.createDataFrame([(0, 0.99, [0.9, 0.1]), (1, 0.01, [0.0, 1.0])], "cell int, w double, p array<double>")
    got = {x.cell: x.r for x in mixing.fit_rates(cells, [0.5, 0.5], max_rate=10.0).collect()}
    assert got[1] == pytest.approx(10.0) and 0 < got[0] < 1


def test_mixing_posteriors_come_from_words(spark):
    """Equal statistics, other words: a held document of each domain is told apart; clashing columns and repeats change nothing."""
    texts = {0: "alpha bravo delta", 1: "omega sigma kappa"}
    docs = [(i, f"{texts[i % 2]} common words in every text number {i % 7} ", 5, 7.0, "x") for i in range(200)]
    docs = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string, n long, cell double, p string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    out = mixing.mix_to_targets(docs, labels, {"quality0_toxic0": 1.0, "quality1_toxic0": 3.0}).collect()
    assert len(out) == 201 and out[0].__fields__ == ["doc_id", "n_tokens", "domains", "rate"]
    assert all(x.domains[f"quality{x.doc_id % 2}_toxic0"] > 0.9 for x in out)
    assert {x.n_tokens for x in out} == {10}
    repeats = {(tuple(x.domains.items()), x.rate) for x in out if x.doc_id == 0}
    assert len(repeats) == 1
    long = spark.createDataFrame([(1, "omega " * 300_000), (2, None)], "doc_id long, text string")
    got = {x.doc_id: x for x in mixing.mix_to_targets(long, spark.createDataFrame([(1, 1, 0), (2, 0, 0)], labels.schema)).collect()}
    assert got[1].n_tokens == 300_000 and got[2].n_tokens == 0


def test_mixing_of_hardly_separable_domains(spark):
    """Two kinds of text, one domain rare in both: the goal cannot be reached."""
    docs = [(i, "plain words in a row of text " * 5, None, "s", 1) for i in range(60)] + [(100 + i, "$$$ LOUD %%% " * 8, None, "s", 1) for i in range(20)]
    docs = spark.createDataFrame(docs, SCHEMA)
    labels = [(i, 1, int(i < 2)) for i in range(40)] + [(100 + i, 1, int(i < 4)) for i in range(15)]
    rows = mixing.mix_to_targets(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    total = sum(r.n_tokens for r in rows)
    got = [sum(r.rate * r.n_tokens * r.domains[f"quality1_toxic{d}"] for r in rows) for d in (0, 1)]
    ends = np.array(sorted({tuple(r.domains[f"quality1_toxic{d}"] for d in (0, 1)) for r in rows}))
    assert len(ends) == 2
    # totals reach the cone of the two cells' posteriors: the nearest point is on its edge
    best = min(np.sum((p * (p.sum() / 2 / (p @ p)) - 0.5) ** 2) for p in ends)
    assert min(np.linalg.solve(ends.T, [0.5, 0.5])) < 0 and sum((x / total - 0.5) ** 2 for x in got) <= best + 1e-4
