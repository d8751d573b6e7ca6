"""Operator 3: benchmark decontamination by template windows (DataFrame functions only).

Texts and benchmark items are cut into words (runs of letters and digits,
lowered) and canonicalised: numbers, units behind a number and names
(capitalised words inside a sentence) become typed placeholders.  All windows
of ``k`` canonical words are hashed and joined.  Matches of one alignment of a
text and an item form an instance; its slots are the placeholders in its
windows.  An instance is consistent if every value of an item's slots stands
for one value in the text, as in a question whose numbers were replaced
throughout.  A document is contaminated by an item if its consistent instances
cover ``min_windows`` different windows of the item, or all of a shorter one's.

The windows of the benchmark are broadcast as fixed-width rows when they
number at most ``broadcast_rows`` (counted first); a larger benchmark is
joined by shuffle, with the same result.

Windows with fewer than ``min_literal`` words outside placeholders are not
compared.  An item that has no other window (shorter than ``k`` words, or rich in
numbers and names) is compared whole at its own length: its longest
literal word is joined with the words of the texts, and the words around each hit
must agree, by template if the item has ``min_literal`` literal words, else word by word.  In scripts
without spaces each character is a word.  An item's capitalised first word
counts as a literal and as a name, as a text may quote it either way.

Defined results: null or empty texts and items match nothing; rows repeating a
doc_id or item_id count as one in ``contaminated``, while ``without_contaminated``
decides row by row; rows without doc_id pass it unchanged; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returnscope.llm.common import free_name, written

#: Words that are units when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mile miles meter meters metre metres inch inches foot feet "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ton tons ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents usd eur mph kmh hz khz mhz ghz kb mb gb tb w kw v degrees"
).split()
NAME = "\x01"  # marks a name until the words are typed
# Blocks of scripts written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han), as ranges:
# script classes cost several times as much for each character.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
_TYPES = {"number": 1, "unit": 2, "name": 3}


def words(text: Column) -> Column:
    """Words of a text; names keep a mark in front."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # only where there is a character of more than one byte
    spaced = F.regexp_replace(text, rf"([{UNSPACED}])", " $1 ")
    text = F.when(F.octet_length(text) == F.length(text), text).otherwise(spaced)
    text = F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", "")
    text = F.regexp_replace(text, r"(?<=[\p{Ll}\p{N},;] )(\p{Lu}\p{Ll}+)", NAME + "$1")
    text = F.trim(F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{NAME}]+", " "))
    # a CASE on the text's length would run all of the above twice
    return F.array_remove(F.split(F.lower(text), " "), "")


def canonical(of: str) -> Column:
    """64-bit codes of the words in an array column; placeholders are the small codes of _TYPES."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    digit = "({0} >= '0' AND {0} < ':')"  # by the first byte
    return F.expr(
        f"transform({of}, (w, i) -> CASE"
        f" WHEN {digit.format('w')} THEN {_TYPES['number']}L"
        f" WHEN w < '0' THEN {_TYPES['name']}L"  # the mark stands before all letters and digits
        f" WHEN {digit.format(f'get({of}, i - 1)')} AND w IN ({units}) THEN {_TYPES['unit']}L"
        f" ELSE xxhash64(w) END)"
    )


def _windows(of: str, k: int) -> Column:
    return F.expr(f"CASE WHEN size({of}) >= {k} THEN transform(sequence(1, size({of}) - {k - 1}), i -> xxhash64(slice({of}, i, {k}))) END")


def _slots(codes: str, theirs: str, ours: str) -> Column:
    """The slots of a matched window: type, value in the item, value in the text."""
    return F.expr(
        f"filter(transform({codes}, (c, i) -> struct(c AS type, get({theirs}, i) AS theirs, get({ours}, i) AS ours)), x -> x.type BETWEEN 1 AND 3)"
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, k: int = 8, min_windows: int = 6, min_literal: int = 5, broadcast_rows: int = 1_000_000
) -> DataFrame:
    """doc_id, item_id, n_windows, item_windows, n_slots, n_changed of every contaminated pair."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("words"), "text").filter("item_id IS NOT NULL")
    items = items.withColumn("codes", canonical("words")).filter("size(words) > 0")
    # the first word as a name too, if it is capitalised (variant 1)
    first = F.expr(f"concat(array({_TYPES['name']}L), slice(codes, 2, size(codes)))")
    capital = F.col("text").rlike(r"^[^\p{L}\p{N}]*\p{Lu}\p{Ll}")
    items = items.withColumn("variants", F.when(capital, F.array("codes", first)).otherwise(F.array("codes")))
    items = items.select("item_id", "words", F.posexplode("variants").alias("variant", "codes")).withColumn("windows", _windows("codes", k))
    # explode_outer: for a plain explode the optimizer adds a filter that computes the windows twice
    ours = items.select("item_id", "words", "variant", "codes", F.posexplode_outer("windows").alias("item_at", "window"))
    ours = ours.filter("window IS NOT NULL AND (variant = 0 OR item_at = 0)")
    ours = ours.select(
        "item_id", "variant", "item_at", "window",
        F.expr(f"slice(codes, item_at + 1, {k})").alias("codes"), F.expr(f"slice(words, item_at + 1, {k})").alias("item_words"),
    )
    ours = ours.filter(F.expr("size(filter(codes, c -> c NOT BETWEEN 1 AND 3))") >= min_literal)
    ours = written(ours, "items")
    keys = ours.select("item_id", "variant", "item_at", "window").distinct()
    item_windows = keys.groupBy("item_id").agg(F.countDistinct("item_at").alias("item_windows"))

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words")).filter("doc_id IS NOT NULL")
    text = text.withColumn("codes", canonical("words"))
    # one expression over the codes behind each word: compiled, unlike a slice and a hash in a lambda
    text = text.select("doc_id", "words", "codes", F.posexplode_outer("codes").alias("at", "_code")).filter(F.col("at") <= F.size("codes") - k)
    text = text.select("doc_id", "words", "at", F.xxhash64(*(F.get("codes", F.col("at") + i) for i in range(k))).alias("window"))
    window_words = F.expr(f"slice(words, at + 1, {k})").alias("doc_words")
    if keys.limit(broadcast_rows + 1).count() <= broadcast_rows:  # 20 bytes a row
        hits = text.join(F.broadcast(keys), "window").select("doc_id", "at", "item_id", "variant", "item_at", window_words)
    else:
        hits = text.filter("window IS NOT NULL").select("doc_id", "at", "window", window_words).join(keys, "window").drop("window")

    theirs = ours.select("item_id", "variant", "item_at", "codes", "item_words").distinct()
    hits = hits.join(theirs, ["item_id", "variant", "item_at"])
    hits = hits.select(
        "doc_id", "item_id", "item_at", (F.col("at") - F.col("item_at")).alias("shift"),
        _slots("codes", "item_words", "doc_words").alias("slots"),
    )
    hits = written(hits, "hits")  # few rows, read twice
    place = ["doc_id", "item_id", "shift"]
    values = hits.select(*place, F.explode("slots").alias("slot")).select(*place, "slot.type", "slot.theirs", "slot.ours").distinct()
    values = values.groupBy(*place, "type", "theirs").agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("CAST(ours <> theirs AS INT)")).alias("changed"))
    checked = values.groupBy(*place).agg(
        F.max("n").alias("values_a_slot"), F.count(F.lit(1)).alias("n_slots"), F.sum("changed").alias("n_changed")
    )
    held = hits.select(*place, "item_at").join(checked, place, "left").filter("coalesce(values_a_slot, 1) = 1")
    pairs = held.groupBy("doc_id", "item_id").agg(
        F.countDistinct("item_at").cast("long").alias("n_windows"),
        F.coalesce(F.max("n_slots"), F.lit(0)).cast("long").alias("n_slots"),
        F.coalesce(F.max("n_changed"), F.lit(0)).cast("long").alias("n_changed"),
    )
    pairs = pairs.join(item_windows, "item_id").filter(F.col("n_windows") >= F.least(F.lit(min_windows), F.col("item_windows")))
    pairs = pairs.select("doc_id", "item_id", "n_windows", F.col("item_windows").cast("long").alias("item_windows"), "n_slots", "n_changed")
    short = items.join(item_windows.select("item_id"), "item_id", "left_anti").select("item_id", "words", "codes")
    short = written(short, "short-items")
    if short.isEmpty():
        return pairs
    return pairs.unionByName(_whole(docs, short, min_literal, broadcast_rows))


def _whole(docs: DataFrame, short: DataFrame, min_literal: int, broadcast_rows: int) -> DataFrame:
    """Pairs of texts and ``short`` items (item_id, words, codes) that stand in them whole."""
    plain = f"translate(w, '{NAME}', '')"
    short = short.withColumn("raw", F.expr(f"transform(words, w -> {plain})"))
    literal = "transform(codes, c -> CAST(c NOT BETWEEN 1 AND 3 AS INT))"
    short = short.withColumn("by_template", F.expr(f"aggregate({literal}, 0, (a, x) -> a + x) >= {min_literal}"))
    # the longest literal word (of any words, if there is none) leads to the places to look at
    best = "array_max(transform(raw, (w, i) -> struct(codes[i] NOT BETWEEN 1 AND 3 AS literal, length(w) AS n, -i AS i)))"
    short = short.withColumn("anchor_at", F.expr(f"-{best}.i")).withColumn("anchor", F.expr("xxhash64(raw[anchor_at])"))
    short = short.select("item_id", "raw", "codes", "by_template", "anchor_at", "anchor").distinct()
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words")).filter("doc_id IS NOT NULL")
    text = text.withColumn("doc_codes", canonical("words")).withColumn("doc_raw", F.expr(f"transform(words, w -> {plain})"))
    text = text.select("doc_id", "doc_raw", "doc_codes", F.posexplode(F.expr("transform(doc_raw, w -> xxhash64(w))")).alias("at", "anchor"))
    reach = short.agg(F.max(F.size("raw"))).first()[0]
    # only the words that an item can cover go on from a place
    lo = F.greatest(F.col("at") + 2 - reach, F.lit(1))
    near = text.select("doc_id", "anchor", (F.col("at") + 1 - lo).alias("at"), *(F.slice(c, lo, 2 * reach).alias(c) for c in ("doc_raw", "doc_codes")))
    found = near.join(F.broadcast(short) if short.limit(broadcast_rows + 1).count() <= broadcast_rows else short, "anchor")
    found = found.filter("at >= anchor_at").withColumns(
        {c: F.expr(f"slice({c}, at - anchor_at + 1, size(raw))") for c in ("doc_raw", "doc_codes")}
    )
    rest = "slice(doc_codes, 2, size(codes)) = slice(codes, 2, size(codes))"
    same = f"size(doc_codes) = size(codes) AND (doc_raw = raw OR (by_template AND {rest} AND (doc_codes[0] = codes[0] OR doc_raw[0] = raw[0])))"
    found = found.filter(same).withColumn("slots", F.array_distinct(_slots("codes", "raw", "doc_raw")))
    found = found.withColumn("values", F.expr("array_distinct(transform(slots, s -> struct(s.type, s.theirs)))"))
    found = found.filter("size(slots) = size(values)")
    changed = F.expr("size(filter(slots, s -> s.ours <> s.theirs))")
    one = F.lit(1).cast("long")
    return found.groupBy("doc_id", "item_id").agg(
        one.alias("n_windows"), one.alias("item_windows"), F.max(F.size("slots")).cast("long").alias("n_slots"), F.max(changed).cast("long").alias("n_changed")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark item contaminates, each row decided by its own text;
    rows without doc_id stay."""
    key = free_name(docs, "_row_key")
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    bad = contaminated(keyed.filter("doc_id IS NOT NULL").select(F.col(key).alias("doc_id"), "text"), benchmark, **settings)
    return keyed.join(bad.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)
