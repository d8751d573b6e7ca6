"""Operator 13: the prefix trie of rebuilt conversations by whole-sequence collapse.

``rebuild`` gives every conversation c the first h turns of conversation
c - c % 100 (h = crc32 of c in decimal, modulo 6) before its own turns after
the first h.  ``prefix_trie`` describes all nodes of the trie:

1. *Collapse.*  A sequence is the XOR of two 64-bit hashes of (depth, MD5 of
   role and text) over its turns.  Conversations of equal length and hashes are
   one weighted sequence, with the digest of the ids that end there.
2. *Weighted prefixes.*  Running XORs of each distinct sequence name its
   prefixes; blocks of 4,096 turns are run apart and then carry on.
3. *Leaves.*  Sequences that are a proper prefix of another are dropped by
   an anti-join; the others are the childless nodes.
4. *Aggregates.*  One grouping of the weighted prefixes by (depth, hashes)
   gives members, leaves and code points of all nodes.

Saved tokens need no walk over ancestors.  With T the code points of a whole
sequence and B(v) those before node v, all visits below v sum to
sum(weight * T) - n_convs * B(v).  Every node is owned by the least leaf below
it, so the distinct nodes below v sum to sum(T over leaves) - B(v) - the
code points before the first own node of each leaf below v but v's owner; that
last sum is a second grouping over the leaves' prefixes above their own nodes.

Turns, not texts, move after the first shuffle (16 bytes of MD5 and a length).
No group is held in one task: a conversation of any length is numbered over
range partitions and cut into blocks; counts are aggregated map-side.  Two
different prefixes would have to agree in 128 bits to be taken for one.

Defined results: rows without conv_id belong to no conversation; null role or
text is empty; turns sort null first, ties by role, the text's first 100
characters and its MD5; repeated rows are turns of their own; an empty table
has no node, not even the root; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returnscope.llm.common import discard, written
from returnscope.llm.runs import EMPTY_SHA256, numbered, sha256_of_ids

BLOCK = 4096
NODE = ["depth", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """conv, place, x (MD5 of role and text), t (code points) of every turn, written."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.left(text, F.lit(100)).alias("head"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("x"),
        F.length(text).cast("long").alias("t"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("x")]
    out, local = numbered(rows, "conv", order, ["x", "t"])
    out = written(out, "turns")
    discard(local)
    return out


def _blocks(upto: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.floor(F.col(upto) / BLOCK).cast("int"))).alias("block")


def _block(place: str) -> Column:
    return F.floor(F.col(place) / BLOCK).cast("int").alias("block")


def rebuild(conversations: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """conv and n_turns of every rebuilt conversation; conv, depth, x, t of its turns; the written tables both read.

    The parameters are the contract's: the base of c is c - c % ``every``, which
    lends fewer than ``heads`` turns.
    """
    all_turns = turns(conversations)
    lent = all_turns.filter((F.col("conv") % every == 0) & (F.col("place") < heads)).groupBy(F.col("conv").alias("base"))
    lent = lent.agg(F.sort_array(F.collect_list(F.struct("place", "x", "t"))).alias("head"))  # fewer than heads each
    convs = all_turns.groupBy("conv").agg(F.max("place").alias("n")).withColumns(
        {"h": (F.crc32(F.col("conv").cast("string")) % heads).cast("int"), "base": F.col("conv") - F.col("conv") % every}
    )
    k = F.least("h", F.coalesce(F.size("head"), F.lit(0)))
    info = written(convs.join(lent, "base", "left").withColumn("k", k).withColumn("head", F.expr("slice(head, 1, k)")).drop("base"), "rebuilt-info")
    shared = info.filter("k > 0").select("conv", F.inline("head")).withColumnRenamed("place", "depth")
    own = all_turns.withColumn("block", _block("place")).join(info.filter("n > h").select("conv", "h", "k", _blocks("n")), ["conv", "block"])
    own = own.filter("place > h").select("conv", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "x", "t")
    sizes = info.select("conv", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return sizes, shared.unionByName(own), [all_turns, info]


def sequences(sizes: DataFrame, rows: DataFrame) -> DataFrame:
    """conv, length, s1, s2, total: the name of every whole sequence and its code points."""
    sums = rows.groupBy("conv").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"), F.sum("t").alias("total"))
    out = sizes.withColumnRenamed("n_turns", "length").join(sums, "conv", "left")
    return out.na.fill(0, ["s1", "s2", "total"])


def weighted_prefixes(kinds: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per distinct sequence and depth, root included: conv (its least id), node, h1, h2, t,
    before (code points before the node's own turn), length, weight, total."""
    kept = rows.withColumn("block", _block("depth")).join(kinds.select("conv", "length", "weight", "total", _blocks("length")), ["conv", "block"])
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"c1": F.bit_xor("h1"), "c2": F.bit_xor("h2"), "ct": F.sum("t")}
    # blocks before this one, only for sequences of more than one
    carry = kept.filter(F.col("length") >= BLOCK).groupBy("conv", "block").agg(*(v.alias(c) for c, v in sums.items()))
    carry = carry.select("conv", "block", *(f.over(earlier).alias(c) for c, f in {"c1": F.bit_xor("c1"), "c2": F.bit_xor("c2"), "ct": F.sum("ct")}.items()))
    run = kept.withColumns({"p1": F.bit_xor("h1").over(inside), "p2": F.bit_xor("h2").over(inside), "upto": F.sum("t").over(inside)})
    run = run.join(carry, ["conv", "block"], "left").na.fill(0, ["c1", "c2", "ct"])
    out = run.select(
        "conv", "depth", F.col("p1").bitwiseXOR(F.col("c1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("c2")).alias("p2"), "h1", "h2", "t",
        (F.col("upto") + F.col("ct") - F.col("t")).alias("before"), "length", "weight", "total",
    )
    zero = F.lit(0).cast("long")
    return out.unionByName(kinds.select("conv", *(zero.alias(c) for c in ("depth", "p1", "p2", "h1", "h2", "t", "before")), "length", "weight", "total"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    sizes, rebuilt, sources = rebuild(conversations)
    rows = written(rebuilt.select("conv", "depth", "t", F.xxhash64("depth", "x").alias("h1"), F.xxhash64("x", "depth", F.lit(1)).alias("h2")), "rebuilt")
    whole = written(sequences(sizes, rows), "sequences")
    name = ["length", "s1", "s2"]
    kinds = written(whole.groupBy(*name).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"), F.max("total").alias("total")), "kinds")
    prefixes = written(weighted_prefixes(kinds, rows), "prefixes")
    inner = prefixes.filter("depth < length").select(F.col("depth").alias("length"), F.col("p1").alias("s1"), F.col("p2").alias("s2")).distinct()
    leaves = written(kinds.join(inner, name, "left_anti").select("conv", "length"), "leaves")

    blocked = prefixes.withColumn("block", _block("depth"))
    marked = blocked.join(leaves.select("conv", _blocks("length"), F.lit(True).alias("leaf")), ["conv", "block"], "left")
    leaf = F.col("leaf")
    nodes = marked.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.col("weight") * F.col("total")).alias("visits"),
        F.count(leaf).alias("n_leaves"), F.min(F.when(leaf, F.col("conv"))).alias("owner"), F.sum(F.when(leaf, F.col("total"))).alias("paths"),
        F.max("before").alias("before"), F.max("h1").alias("h1"), F.max("h2").alias("h2"),
    )
    nodes = written(nodes, "nodes")
    tops = nodes.groupBy(F.col("owner").alias("conv")).agg(F.min("depth").alias("top"), F.min("before").alias("start"))
    shared = blocked.join(tops.filter("top > 0").select("conv", "top", "start", _blocks("top")), ["conv", "block"]).filter("depth < top")

    # what belongs to a node meets in one aggregate: itself, its children, leaves that start below, its ends
    up = nodes.filter("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("p2"), F.lit(1).cast("long").alias("child")
    )
    ends = sha256_of_ids(whole, name, "conv").withColumnsRenamed({"length": "depth", "s1": "p1", "s2": "p2"})
    parts = nodes.unionByName(up, allowMissingColumns=True)
    parts = parts.unionByName(shared.select(*NODE, "start"), allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
    facts = [c for c in nodes.columns if c not in NODE]
    full = parts.groupBy(*NODE).agg(
        *(F.max(c).alias(c) for c in facts), F.count("child").alias("n_children"), F.coalesce(F.sum("start"), F.lit(0)).alias("others"), F.max("ends_sha256").alias("ends_sha256")
    )
    distinct = F.col("paths") - F.col("before") - F.col("others")
    full = full.withColumn("saved_tokens", F.col("visits") - F.col("n_convs") * F.col("before") - distinct)

    parent = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.col("conv_id").alias("parent_conv_id")
    ).filter("depth > 1")
    keyed = full.withColumns({"u1": F.col("p1").bitwiseXOR(F.col("h1")), "u2": F.col("p2").bitwiseXOR(F.col("h2"))})
    out = keyed.filter("depth > 1").join(parent, ["depth", "u1", "u2"])
    # the root, parent of every first turn, is one row
    root = nodes.filter("depth = 0").select(F.lit(1).cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    top = keyed.filter("depth < 2").join(F.broadcast(root), "depth", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")]
    result = written(out.select(*columns).unionByName(top.select(*columns)), "trie")
    discard(*sources, rows, whole, kinds, prefixes, leaves, nodes)
    return result
