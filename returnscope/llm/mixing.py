"""Operator 6: mixing documents to target domain weights (DataFrame functions only).

Domains are the classes of the labelled table (quality and toxic together).

Posteriors: a hashed naive Bayes over the words of the whole text, with four
statistics of the text (symbols, capitals, word length, length) as further
words.  Words fall into ``buckets`` hash buckets.  A word counts for a domain with
the logarithm of its share of the bucket over the domain's share of all words,
shrunk by ``SHRINK`` words of the mean; buckets that no fitted text holds count
nothing.  The words of a text are not independent, so their sum is scaled by
the factor of ``SCALES`` with the least log loss on every fourth labelled
document, whose words are left out of the counts.  At most ``sample_rows``
labels are fitted; every document is scored, by a broadcast join of its words
with the bucket table and a sum per row, partial before the shuffle.  Weights
are whole multiples of 2^-20, so sums do not depend on order.

Rates: with n_i the tokens of document i and p_i its posteriors, the rates
0 <= r_i <= ``max_rate`` minimise the squared distance between the expected
domain totals sum_i r_i n_i p_i and target weight times all tokens, by
accelerated projected gradient steps r_i <- clip(y_i + p_i . left / p_i . mean), y being
r carried on by its last change, left the goal less the totals at y and mean
the totals of all rates 1 (their product with p_i bounds the curvature, so rare
domains take long steps); carrying on starts anew where the distance grew.  Each step is one aggregate on Spark; the driver sees
the domain totals alone.  Documents whose posteriors agree to 1/``GRID`` get one
rate: the steps run over these cells (their number is bounded by ``GRID`` and the
domains, whatever the corpus), with the exact posterior totals of their
documents.  Steps end once a dual bound proves the totals within ``tolerance`` of
all tokens of the least-squares optimum over such rates, or after ``iterations``
steps, with a warning that gives the bound.

Defined results: null and empty texts have no tokens and are judged by their
statistics; documents without a label, and labels without a document, are
fine; without any label there is one domain, "all"; a document with two
different labels counts for both; rows that repeat a doc_id are rows of their
own; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.llm.common import discard, written

BINS = 8
GRID = 32
SHRINK = 5.0
SCALES = [2.0**-i for i in range(11)]
UNIT = float(1 << 20)
CHAIN = 25  # steps applied in one expression before the rates are written
_SYMBOLS = "#$%&*!|@<>{}[]\\\\/=+~^_"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _bin(value: Column, top: float) -> Column:
    """Bins of equal steps of the logarithm: 0 for nothing, BINS - 1 from ``top`` on."""
    step = F.log2(1 + 63 * F.least(value / top, F.lit(1.0))) / 6 * (BINS - 1)
    return F.ceil(step).cast("int")


def _words(docs: DataFrame, buckets: int, *carried: str) -> DataFrame:
    """row, doc_id, n_tokens, carried columns and one bucket per word or statistic of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"), *carried)
    rows = rows.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    size, n = F.greatest(F.length("text"), F.lit(1)), F.size("words").cast("long")
    bins = [
        _bin(_count(F.col("text"), _SYMBOLS) / size, 0.5),
        _bin(_count(F.col("text"), _UPPER) / size, 0.8),
        _bin(size / F.greatest(n, F.lit(1)), 64.0),
        _bin(F.log2(F.lit(1.0) + n), 20.0),
    ]
    rows = rows.select("row", "doc_id", *carried, n.alias("n_tokens"), "words", *(b.alias(f"b{i}") for i, b in enumerate(bins)))
    extra = F.array(*(F.concat(F.lit(f" {i} "), F.col(f"b{i}").cast("string")) for i in range(len(bins))))  # no word has a space
    rows = rows.select("row", "doc_id", "n_tokens", *carried, F.explode(F.concat("words", extra)).alias("word"))
    return rows.select("row", "doc_id", "n_tokens", *carried, F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int").alias("bucket"))


def _array(v: list[float]) -> str:
    return "array(" + ", ".join(f"{float(x)!r}D" for x in v) + ")"


def _dot(v: str) -> str:
    """p . v as SQL; as v folds to one constant, the compiled code is the same at every step."""
    return f"aggregate(zip_with(p, {v}, (a, b) -> a * b), 0D, (s, x) -> s + x)"


def _softmax(logs: Column) -> Column:
    odds = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))


def _scored(words: DataFrame, weights: DataFrame, domains: int, *carried: str) -> DataFrame:
    """doc_id, n_tokens, carried columns and s, the array of summed word weights, of every row."""
    met = words.join(F.broadcast(weights), "bucket", "left")  # at most ``buckets`` rows
    sums = met.groupBy("row", "doc_id", "n_tokens", *carried).agg(*(F.sum(F.coalesce(f"w{d}", F.lit(0))).alias(f"s{d}") for d in range(domains)))
    return sums.select("doc_id", "n_tokens", *carried, F.array(*(F.col(f"s{d}") / UNIT for d in range(domains))).alias("s"))


def posteriors(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 16, sample_rows: int = 20_000) -> tuple[list[str], DataFrame]:
    """Domain names, and doc_id, n_tokens, p (P(domain | text), in order of the names) of every row."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    marks = marks.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat(F.lit("quality"), F.col("quality").cast("string"), F.lit("_toxic"), F.coalesce("toxic", F.lit(0)).cast("string")).alias("domain"),
    ).distinct()
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(sample_rows)
    marked = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    marked = written(marked.withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0), "marked")  # at most the sampled rows and their repeats
    names = [r["domain"] for r in marked.select("domain").distinct().orderBy("domain").collect()]
    if not names:
        discard(marked)
        scored = _words(docs, buckets).groupBy("row", "doc_id", "n_tokens").agg(F.count(F.lit(1)))
        return ["all"], scored.select("doc_id", "n_tokens", F.array(F.lit(1.0)).alias("p"))
    k = len(names)
    share = {r["domain"]: r["n"] + 1 for r in marked.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = [math.log(share[d] / sum(share.values())) for d in names]
    counts = _words(marked.filter(~F.col("held")), buckets, "domain").groupBy("bucket").agg(*(F.count_if(F.col("domain") == d).alias(f"c{i}") for i, d in enumerate(names)))
    counts = written(counts, "buckets")  # at most ``buckets`` rows
    got = counts.agg(*(F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(k))).first()
    total = [float(got[f"c{i}"]) + 1 for i in range(k)]
    part = [x / sum(total) for x in total]
    inside = sum((F.col(f"c{i}") for i in range(k)), F.lit(0))
    weights = written(counts.select("bucket", *(
        F.round(F.log((F.col(f"c{i}") + SHRINK * part[i]) / ((inside + SHRINK) * part[i])) * UNIT).cast("long").alias(f"w{i}") for i in range(k)
    )), "weights")
    logs = lambda scale: F.array(*(F.get("s", F.lit(d)) * scale + prior[d] for d in range(k)))
    tried = _scored(_words(marked.filter("held"), buckets, "domain"), weights, k, "domain")
    own = F.array_position(F.array(*map(F.lit, names)), F.col("domain")).cast("int") - 1
    loss = [F.sum(-F.log(F.greatest(F.get(_softmax(logs(s)), own), F.lit(1e-12)))).alias(f"t{i}") for i, s in enumerate(SCALES)]
    found = tried.agg(*loss).first()
    scale = min(range(len(SCALES)), key=lambda i: (round(found[f"t{i}"], 6), i)) if found["t0"] is not None else 3
    discard(marked, counts)
    scored = _scored(_words(docs, buckets), weights, k)
    return names, scored.select("doc_id", "n_tokens", _softmax(logs(SCALES[scale])).alias("p"))


def _cell(p: str) -> Column:
    return F.transform(p, lambda x: F.round(x * GRID).cast("int"))


def _after(steps: list[tuple[list[float], float]], mean: str, max_rate: float) -> Column:
    """(r, before): the rate and the one before it after some steps, from the columns r and before."""
    if not steps:
        return F.struct("r", "before")
    moves = ", ".join(f"struct({_array(v)} AS v, {carry!r}D AS carry)" for v, carry in steps)
    new = f"at.r + move.carry * (at.r - at.before) + {_dot('move.v')} / greatest(1e-12D, {_dot(mean)})"
    step = f"struct(least({float(max_rate)!r}D, greatest(0D, {new})) AS r, at.r AS before)"
    return F.expr(f"aggregate(array({moves}), struct(r, before), (at, move) -> {step})")


def fit_rates(cells: DataFrame, goal: list[float], iterations: int = 400, tolerance: float = 1e-4, max_rate: float = 1000.0) -> DataFrame:
    """``cells`` (columns w: share of all tokens, p: posteriors) with r, the least-squares rate of the module's docstring."""
    k, goal = len(goal), np.array(goal)
    state = cells.withColumns({"r": F.lit(1.0), "before": F.lit(1.0)})
    first = state.agg(*(F.sum(F.col("w") * F.get("p", F.lit(d))).alias(f"t{d}") for d in range(k))).first()
    if first["t0"] is None:
        return state.drop("before")
    totals = before = np.array([round(first[f"t{d}"], 14) for d in range(k)])
    mean = _array(totals.tolist())
    steps: list[tuple[list[float], float]] = []
    scratch, pace, bound = [], 1.0, math.inf
    for number in range(iterations + 1):
        left = goal - totals
        pace, last = (1 + math.sqrt(1 + 4 * pace * pace)) / 2, pace
        carry = round((last - 1) / pace, 10)
        slope = goal - totals - carry * (totals - before)
        steps.append(([round(float(x), 14) for x in slope], carry))
        gain = F.expr(_dot(_array(left.tolist())))
        now = _after(steps, mean, max_rate)["r"]
        got = state.select("w", "p", now.alias("r")).agg(
            *(F.sum(F.col("r") * F.col("w") * F.get("p", F.lit(d))).alias(f"t{d}") for d in range(k)),
            F.sum(F.col("w") * F.greatest(F.lit(0.0), gain)).alias("hinge"), F.max(F.when(F.col("w") > 0, gain)).alias("top"),
        ).first()
        low = left - max(0.0, got["top"] or 0.0)  # no cell gains along it
        dual = max(0.0, goal @ left - left @ left / 2 - max_rate * got["hinge"], goal @ low - low @ low / 2)
        bound = math.sqrt(max(0.0, float(left @ left - 2 * dual)))
        if bound <= tolerance or number == iterations:
            steps.pop()
            break
        new = np.array([round(got[f"t{d}"], 14) for d in range(k)])
        if np.sum((new - goal) ** 2) > left @ left:
            pace = 1.0
        before, totals = totals, new
        if len(steps) == CHAIN:
            at = _after(steps, mean, max_rate)
            state = written(state.withColumn("at", at).select(*cells.columns, F.col("at.r").alias("r"), F.col("at.before").alias("before")), "rates")
            discard(*scratch)
            scratch, steps = [state], []
    if bound > tolerance:
        warnings.warn(f"domain totals proven within {bound:.2g} of all tokens of the optimum, not {tolerance}, after {iterations} steps", stacklevel=2)
    return state.select(*cells.columns, _after(steps, mean, max_rate)["r"].alias("r"))


def mix_to_targets(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, iterations: int = 400, tolerance: float = 1e-4, max_rate: float = 1000.0
) -> DataFrame:
    """doc_id, n_tokens, domains (posterior by name), rate of every row.

    ``targets``: weight by domain, scaled to one; equal weights if not given.
    ``iterations``: gradient steps at most.  ``tolerance``: distance of the domain totals from
    the optimum, as a share of all tokens.  ``max_rate``: no document counts more often.
    """
    names, scored = posteriors(docs, labels)
    k = len(names)
    rows = written(scored, "posteriors")
    exact = [F.sum((F.col("n_tokens") * F.get("p", F.lit(d))).cast("decimal(28,9)")).alias(f"m{d}") for d in range(k)]
    cells = written(rows.groupBy(_cell("p").alias("cell")).agg(F.sum("n_tokens").alias("n"), *exact), "cells")
    total = cells.agg(F.sum("n")).first()[0]
    weight = [(targets or dict.fromkeys(names, 1.0)).get(x, 0.0) for x in names]
    mean = [F.when(F.col("n") > 0, F.col(f"m{d}").cast("double") / F.col("n")).otherwise(F.get("cell", F.lit(d)) / GRID) for d in range(k)]
    shares = cells.select("cell", (F.col("n") / float(total or 1)).alias("w"), F.array(*mean).alias("p"))
    rated = shares.withColumn("r", F.lit(1.0))
    if total:
        rated = fit_rates(shares, [x / sum(weight) if sum(weight) > 0 else 0.0 for x in weight], iterations, tolerance, max_rate)
    rates = rated.select("cell", F.col("r").alias("rate"))
    named = F.map_from_arrays(F.array(*map(F.lit, names)), F.col("p"))
    # one row per cell, bounded by GRID and the domains
    return rows.withColumn("cell", _cell("p")).join(F.broadcast(rates), "cell").select("doc_id", "n_tokens", named.alias("domains"), "rate")
