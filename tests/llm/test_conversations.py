"""Conversation operators and toxicity against brute force and SQL, and their defined results on odd input."""

import itertools
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from returnscope.llm import prefix_trie, repair, runs, toxicity
from returnscope.llm.conversation_sql import OP11_SQL, OP13_SQL

SCHEMA = "conv_id long, turn long, role string, text string"


def same_as_sql(df, sql, rows):
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role::VARCHAR AS role, text::VARCHAR AS text FROM conversations")
    want = con.execute(sql)
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    want = want.fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    return want


@pytest.fixture(scope="module")
def odd_rows():
    """Ties, repeats, null values, gaps, odd roles, shared first turns, texts of white space, a long conversation."""
    r = random.Random(3)
    texts = ["Hi there.", "Well?", "no end", "", " \t", "ends. ", "a.b", "é漢!", "x" * 3000 + ".", None, "\x0b"]
    out = []
    for c in [*range(60), *range(200, 290), -5, -100, 10**12]:
        turn = r.choice([0, 0, 1, 5])
        for _ in range(r.randint(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            out.append((c, r.choice([turn, turn, turn, None]), role, r.choice(texts)))
            if r.random() < 0.2:
                out.append(out[-1])
            turn += r.choice([0, 1, 1, 1, 2])
    out += [(77, i // 3, r.choice(["user", "assistant"]), r.choice(texts)) for i in range(400)]
    out += [(300 + i, t, "user", "same start.") for i in range(40) for t in range(3)]
    return out


def test_repair_equals_sql(spark, odd_rows):
    rows = [*odd_rows, (None, 1, "user", "Hi."), (None, None, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for hold in (8 << 20, 0):
        got = same_as_sql(repair.repair(repair.damage(df), hold_bytes=hold), OP11_SQL, rows)
    assert len(got) == len({x[0] for x in rows})


def test_trie_equals_sql(spark, odd_rows, monkeypatch):
    df = spark.createDataFrame([*odd_rows, (None, 1, "user", "Hi.")], SCHEMA)
    same_as_sql(prefix_trie.prefix_trie(df), OP13_SQL, odd_rows)
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)  # sequences of many blocks
    same_as_sql(prefix_trie.prefix_trie(df), OP13_SQL, odd_rows)


def test_clashing_columns_and_empty_tables(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (100, 0, "system", "Be kind."), (101, 0, "user", "No")]
    clash = "conv int, place int, depth int, block int, n int, x int, t int, p1 int, copies int, plan int, cost int, audit int, leaf int, _any int"
    wide = spark.createDataFrame([(*r, *range(14)) for r in rows], f"{SCHEMA}, {clash}")
    narrow = spark.createDataFrame(rows, SCHEMA)
    for op in (lambda d: repair.repair(repair.damage(d)), prefix_trie.prefix_trie):
        assert sorted(map(repr, op(wide).collect())) == sorted(map(repr, op(narrow).collect()))
        assert op(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, "a b", 2, 3.0, 4), (2, None, 1, 1.0, 1)], "doc_id long, text string, toxic int, score double, _rank int")
    labels = spark.createDataFrame([(1, 1, 5, "x"), (2, 0, 5, "y")], "doc_id long, toxic int, held_out int, text string")
    model = toxicity.learn(docs, labels)
    assert toxicity.score_toxicity(docs, model).count() == 2
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_places_of_a_hot_group(spark):
    rows = [(7 if i % 3 else i, i // 50, f"{i % 11}") for i in range(4000)]
    df = spark.createDataFrame(rows, "g long, o long, v string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out, local = runs.numbered(df.repartition(5), "g", [df["o"], df["v"]], ["o", "v"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {}
    for g, o, v, place in map(tuple, out.collect()):
        got.setdefault(g, []).append((place, o, v))
    for g, found in got.items():
        found.sort()
        assert [p for p, _, _ in found] == list(range(1, len(found) + 1))
        assert [x[1:] for x in found] == sorted((o, v) for h, o, v in rows if h == g)
    assert max(map(len, got.values())) > 2600 and local.filter("g = 7").select("_part").distinct().count() > 1


def legal(roles):
    body = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (body and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def brute_audit(rows):
    """Least (cost, audit) over all edits with at most two insertions in a gap."""
    best = None
    gaps = list(itertools.product(["", "I", "II"], repeat=len(rows) + 1))
    for edits in itertools.product("DKR", repeat=len(rows)):
        if any(r[1] and e != "D" for r, e in zip(rows, edits, strict=True)):
            continue
        for gap in gaps:
            plan = gap[0] + "".join(e + g for e, g in zip(edits, gap[1:], strict=True))
            cost = sum({"D": 2, "K": 0, "R": 1, "I": 5}[x] for x in plan) + sum(5 for r, e in zip(rows, edits, strict=True) if r[2] and e != "D")
            if best is not None and (cost, plan) >= best:
                continue
            free = [i for i, x in enumerate(plan) if x in "IR"]
            fixed = iter(rows)
            roles = [None if x == "I" else (next(fixed)[0]) for x in plan]
            out = [None if x == "D" else "?" if x in "IR" else (roles[i] or "-") for i, x in enumerate(plan)]
            for choice in itertools.product("ua", repeat=len(free)):
                for i, c in zip(free, choice, strict=True):
                    out[i] = c
                if legal("".join(x for x in out if x)):
                    best = (cost, plan)
                    break
    return best


@pytest.mark.parametrize("every", [0, 4096])
def test_audit_equals_all_edits(every):
    r = random.Random(every)
    for _ in range(60):
        rows = [(r.choice(["u", "a", "u", "a", "s", "t", ""]), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randint(0, 4))]
        audit = repair.Audit(every)
        for x in rows:
            audit.push(*x)
        assert audit.result() == brute_audit(rows), rows


@pytest.mark.parametrize("prime", [repair.PRIME, 3])
def test_paths_compare_like_strings(prime, monkeypatch):
    monkeypatch.setattr(repair, "PRIME", prime)  # 3: most hashes collide
    r = random.Random(1)
    paths, texts = repair.EditPaths(), {0: ""}
    for _ in range(3000):
        parent = r.choice(list(texts)[-8:])
        code = r.choice([0, 2, 2, 2, 3])
        texts[paths.add(parent, code)] = texts[parent] + repair.EDITS[code]
    nodes = list(texts)
    for _ in range(2000):
        a, b = r.sample(nodes[-200:], 2)
        assert paths.text(a) == texts[a]
        assert paths.less(a, b) == (texts[a] < texts[b])
    live = nodes[-3:]
    new = paths.settle(live)
    assert [paths.settled + paths.text(n) for n in new] == [texts[n] for n in live]


def test_a_long_undecided_conversation():
    audit = repair.Audit(64)
    for _ in range(5000):
        audit.push("u", False, False)
    cost, plan = audit.result()
    assert (cost, plan) == (2500, "KR" * 2500)


def brute_logits(model, text):
    """The window logits of one text, by strings."""
    words = text.lower().split()
    k = max(1, round(len(words) / model.words)) if words else 0
    out = [[] for _ in range(k)]
    for i, w in enumerate(words):
        c = np.array([0, *map(ord, w), 0], np.uint32)
        for at, row in toxicity.ngrams(c, model.bits):
            out[i * k // len(words)] += list(model.weight[row])
    return [sum(x) / max(1, len(x)) for x in out]


def test_scores_equal_a_plain_sum(monkeypatch):
    r = random.Random(5)
    model = toxicity.Subwords(np.random.default_rng(0).normal(size=1 << 10), -0.3, 10, 3, 2, 1.7, 0.4)
    texts = ["", " \n ", "a", "Straße ÉTÉ 漢字 x", "long" * 900, None, "a b c"]
    texts += [" ".join("".join(r.choice("abcé") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 40))) for _ in range(30)]
    want = []
    for t in texts:
        x = sorted(brute_logits(model, t or ""), reverse=True)
        x = x[: -(-len(x) // 2)]
        want.append(1 / (1 + np.exp(-(0.4 + 1.7 * (-0.3 + sum(x) / len(x))))) if x else 0.5)
    assert np.allclose(model.score(pa.array(texts, pa.string())), want)
    monkeypatch.setattr(toxicity, "PIECE", 50)  # texts in many pieces
    assert np.allclose(model.score(pa.array(texts, pa.string())), want)


def test_ngrams_stay_inside_words():
    c, starts = toxicity.code_points(pa.array(["Ab  c", "d"]))
    assert c.tolist() == [0, 97, 98, 0, 0, 99, 0, 100, 0] and starts.tolist() == [0, 6, 8]
    places = {(int(a), n) for n, (at, _) in zip(toxicity.SIZES, toxicity.ngrams(c, 10), strict=True) for a in at}
    assert places == {(0, 3), (1, 3), (4, 3), (6, 3), (0, 4)}


def test_toxicity_learns_and_meets_misspellings(spark):
    r = random.Random(2)
    clean = ["table", "river", "garden", "window", "music", "paper", "orange", "silver", "winter", "bridge"]

    def text(bad):
        w = [r.choice(clean) + r.choice(["", "s", "ed"]) for _ in range(r.randint(5, 200))]
        for _ in range(1 + len(w) // 40 if bad else 0):
            w.insert(r.randrange(len(w)), r.choice(["horrible", "disgusting", "stupid"]))
        return " ".join(w)

    rows = [(i, text(i % 5 == 0), "en", "s") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(1500)] + [(1, None), (2, 7)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = {x["doc_id"]: x for x in toxicity.score_toxicity(docs, model).collect()}
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i in got if got[i]["held_out"])
    score = model.score(pa.array(["river table disgustting garden", "stupidd music paper window", "river table orange garden", None]))
    assert score[0] > 0.7 and score[1] > 0.7 and score[2] < 0.3 and abs(score[3] - 0.2) < 0.05
    assert (toxicity.learn(docs, labels.filter("toxic = 0")).score(pa.array(["x"])) < 1e-9).all()
    assert (toxicity.learn(docs, labels.limit(0)).score(pa.array(["x", None])) == 0.5).all()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.score_toxicity(docs, toxicity.learn(docs, labels)).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id")
    hits = {x["toxic"]: x["p"] for x in out.groupBy("toxic").agg({"predicted": "avg"}).withColumnRenamed("avg(predicted)", "p").collect()}
    assert hits[1] > 0.85 and hits[0] < 0.02  # some toxic labels here stand on texts without a toxic word
