"""Operator 11: conversation structure repair by a persistent audit DP.

``damage`` breaks rows by a hash of their key (the contract's rules), and
``repair`` finds, for every conversation, the cheapest edits that give role
initials ``(s?(ua)+)?`` and among those the ASCII-least audit string:

* a row is kept (0), given another role (1) or deleted (2, the only edit of a
  blank row or a duplicate); an empty user or assistant turn is inserted (5);
  a truncated row that stays adds 5;
* the DP has four states (nothing yet, after s, after u, after a).  Each holds
  a cost and an edit path: a linked node whose prefix is shared with the other
  paths.  A node carries its depth, a rolling hash of its path and its
  ancestors 1, 2, 4, ... above.  Equal costs are compared by a search for the
  longest common prefix over those hashes; the nodes found equal must be one
  node or agree character by character, else (a hash collision) the whole
  paths are compared.  Paths of one state and cost are never prefixes of each
  other: they have one edit per row and the same number of insertions.
* what all live paths share is moved to a string from time to time and dead
  nodes are dropped, so the nodes cover the undecided rows only.

Rows are shuffled once by conversation and stream through their task in order;
no group is collected: a task holds a conversation's audit (a value of the
result), hashes of its rows (16 bytes each, for duplicates) and undecided
nodes.  Its texts are held up to ``hold_bytes``; the repaired digest of a longer
conversation comes from a second stream that replays the audit.  Both values
are sequential by definition, so one conversation is one task's stream.

Defined results: null role or text is one space; a null conv_id is a
conversation of its own; turns sort null first, ties by role, then text, after
damage; the blank, duplicate and truncated counts take each row's first fault;
an empty role has no initial and can't be kept; a conversation without rows
after damage gets zeros, an empty audit and the digest of nothing; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope.llm.common import small_batches, written

SPACES = " \t\n\x0b\x0c\r"
EDITS = "DIKR"  # in ASCII order
DELETE, INSERT, KEEP, REROLE = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by an inserted or re-roled turn
ROLE = {USER: "user", ASSISTANT: "assistant"}
PRIME, BASE = (1 << 61) - 1, 0x1F2E3D4C5B6A798
FAR = 1 << 60


class EditPaths:
    """Edit strings that share prefixes; node 0 is the empty path."""

    def __init__(self) -> None:
        self.settled = ""  # the prefix of every live path that nodes no longer hold
        self._clear()

    def _clear(self) -> None:
        self.code = array("b", [0])
        self.depth = array("q", [0])
        self.hash = array("q", [0])
        self.up = [array("q", [0])]  # up[k][node] is 2**k above it; only read where the depth allows

    def __len__(self) -> int:
        return len(self.code)

    def add(self, parent: int, code: int) -> int:
        """The node of ``parent``'s path and one more edit."""
        node = len(self.code)
        depth = self.depth[parent] + 1
        self.code.append(code)
        self.depth.append(depth)
        self.hash.append((self.hash[parent] * BASE + code + 1) % PRIME)
        if depth >> len(self.up):
            self.up.append(array("q", bytes(8 * node)))
        at = parent
        for k, level in enumerate(self.up):
            level.append(at)
            at = self.up[k][at]
        return node

    def ancestor(self, node: int, depth: int) -> int:
        rest, k = self.depth[node] - depth, 0
        while rest:
            if rest & 1:
                node = self.up[k][node]
            rest, k = rest >> 1, k + 1
        return node

    def common(self, a: int, b: int) -> tuple[int, int]:
        """The ancestors of a and b at the end of their longest common prefix, as the hashes tell it."""
        d = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, d), self.ancestor(b, d)
        if self.hash[a] == self.hash[b]:
            return a, b
        for k in range(len(self.up) - 1, -1, -1):
            if self.depth[a] >> k:
                x, y = self.up[k][a], self.up[k][b]
                if self.hash[x] != self.hash[y]:
                    a, b = x, y
        return self.up[0][a], self.up[0][b]

    def less(self, a: int, b: int) -> bool:
        """Whether a's path sorts before b's."""
        x, y = self.common(a, b)
        i, j, same = x, y, True
        while i != j and same:  # equal hashes of different nodes: verified edit by edit
            same, i, j = self.code[i] == self.code[j], self.up[0][i], self.up[0][j]
        d = self.depth[x]
        if not same:
            return self.text(a) < self.text(b)
        if self.depth[a] == d or self.depth[b] == d:
            return self.depth[a] < self.depth[b]
        return self.code[self.ancestor(a, d + 1)] < self.code[self.ancestor(b, d + 1)]

    def text(self, node: int) -> str:
        """The path's edits since the last ``settle``."""
        out = bytearray()
        while node:
            out.append(ord(EDITS[self.code[node]]))
            node = self.up[0][node]
        return out[::-1].decode()

    def settle(self, live: list[int]) -> list[int]:
        """Moves the common prefix of the live paths to ``settled`` and drops dead nodes; the new nodes of ``live``."""
        top = live[0]
        for node in live[1:]:
            d = min(self.depth[top], self.depth[node])
            top, node = self.ancestor(top, d), self.ancestor(node, d)
            for k in range(len(self.up) - 1, -1, -1):
                if self.depth[top] >> k and self.up[k][top] != self.up[k][node]:
                    top, node = self.up[k][top], self.up[k][node]
            if top != node:
                top = self.up[0][top]
        self.settled += self.text(top)
        kept = set()
        for node in live:
            while node != top and node not in kept:
                kept.add(node)
                node = self.up[0][node]
        order = sorted(kept)  # parents come first
        links = [(self.up[0][n], self.code[n]) for n in order]
        self._clear()
        new = {top: 0}
        for node, (parent, code) in zip(order, links, strict=True):
            new[node] = self.add(new[parent], code)
        return [new[n] for n in live]


class Audit:
    """The DP over one conversation's rows, in order."""

    def __init__(self, every: int = 4096) -> None:
        self.paths = EditPaths()
        self.cost, self.node = [0, FAR, FAR, FAR], [0, 0, 0, 0]
        self.every = self.limit = every
        self._inserts()

    def _best(self, options: list[tuple[int, int, int]]) -> tuple[int, int]:
        """The least (cost, path) of options (cost, parent, edit), as cost and node; edit -1 is the parent itself."""
        least = min((o[0] for o in options), default=FAR)
        if least >= FAR:
            return FAR, 0
        best = -1
        for cost, parent, edit in options:
            if cost == least:
                node = parent if edit < 0 else self.paths.add(parent, edit)
                if best < 0 or self.paths.less(node, best):
                    best = node
        return least, best

    def _inserts(self) -> None:
        """Insertions before the next row: more than two never pay."""
        for state, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            options = [(self.cost[s] + 5, self.node[s], INSERT) for s in sources]
            if min(o[0] for o in options) <= self.cost[state]:
                self.cost[state], self.node[state] = self._best([(self.cost[state], self.node[state], -1), *options])

    def push(self, initial: str, removed: bool, truncated: bool) -> None:
        """One row: its role's initial, whether it must go (blank or duplicate), whether it is truncated."""
        options: list[list[tuple[int, int, int]]] = [[(self.cost[s] + 2, self.node[s], DELETE)] for s in range(4)]
        if not removed:
            extra = 5 if truncated else 0
            for s in range(4):
                to = NEXT[s]
                if self.cost[s] < FAR:
                    options[to].append((self.cost[s] + extra + 1, self.node[s], REROLE))
                    if initial == ("", "s", "u", "a")[to]:
                        options[to].append((self.cost[s] + extra, self.node[s], KEEP))
            if initial == "s":
                options[SYSTEM].append((self.cost[START] + extra, self.node[START], KEEP))
        for s in range(4):
            options[s] = [o for o in options[s] if o[0] < FAR]
        found = [self._best(o) for o in options]
        self.cost, self.node = [c for c, _ in found], [n for _, n in found]
        self._inserts()
        if len(self.paths) > self.limit:
            live = [s for s in range(4) if self.cost[s] < FAR]
            for s, node in zip(live, self.paths.settle([self.node[s] for s in live]), strict=True):
                self.node[s] = node
            self.limit = 2 * len(self.paths) + self.every

    def result(self) -> tuple[int, str]:
        """Cost and audit string of the cheapest way to an accepted end."""
        cost, node = self._best([(self.cost[s], self.node[s], -1) for s in (START, ASSISTANT) if self.cost[s] < FAR])
        return cost, self.paths.settled + self.paths.text(node)


class Replay:
    """The repaired rows of an audit, hashed line by line as original rows come in order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START
        self.digest, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            self._line(ROLE[self.state], "")

    def push(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        self.state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[self.state]
        self._line(role if edit == "K" else ROLE[self.state], text)

    def hexdigest(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


class Conversation:
    """Counts, audit and (within ``hold_bytes`` of text) the repaired digest of one conversation."""

    def __init__(self, hold_bytes: int) -> None:
        self.audit, self.seen = Audit(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.initial = None
        self.held: list[tuple[str, str]] | None = []
        self.room = hold_bytes

    def push(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        black = text.rstrip(SPACES)
        key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        blank, again = not black, key in self.seen
        truncated = not blank and black[-1] not in ".!?"
        self.seen.add(key)
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += truncated and not again
        self.audit.push(initial, blank or again, truncated)
        if self.held is not None:
            self.held.append((role, text))
            self.room -= len(role) + len(text) + 100
            if self.room < 0:
                self.held = None

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        cost, audit = self.audit.result()
        digest = None
        if self.held is not None:
            replay = Replay(audit)
            for role, text in self.held:
                replay.push(role, text)
            digest = replay.hexdigest()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
SCHEMA = f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (0: the row is dropped) after damage by crc32 of ``conv_id:turn`` modulo 20."""
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))) % 20
    return conversations.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind < 2, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    order = ["conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def repair(rows: DataFrame, hold_bytes: int = 8 << 20) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies): SCHEMA."""
    small_batches(rows.sparkSession)
    out_schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key = None, None
        for batch in batches:
            done = []
            for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != key:
                    if now is not None:
                        done.append((key, *now.result()))
                    now, key = Conversation(hold_bytes), conv
                for _ in range(copies):
                    now.push(turn, role, text)
            yield _record(done, out_schema)
        if now is not None:
            yield _record([(key, *now.result())], out_schema)

    ordered = _in_order(rows.select("conv_id", "turn", "role", "text", "copies"))
    audits = written(ordered.mapInArrow(audit, SCHEMA), "audits")
    long = audits.filter("repaired_sha256 IS NULL")

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key = None, None
        schema = pa.schema([("conv_id", pa.int64()), ("replayed", pa.string())])
        for batch in batches:
            done = []
            for conv, plan, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if plan is not None:  # sorted before its conversation's rows
                    if now is not None:
                        done.append((key, now.hexdigest()))
                    now, key = Replay(plan), conv
                else:
                    for _ in range(copies):
                        now.push(role, text)
            yield _record(done, schema)
        if now is not None:
            yield _record([(key, now.hexdigest())], schema)

    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    again = rows.join(long.select(F.col("conv_id").alias("_conv")), same, "left_semi")
    plans = long.select("conv_id", F.col("audit").alias("plan"))
    both = again.select("conv_id", "turn", "role", "text", "copies").unionByName(plans, allowMissingColumns=True)
    both = _in_order(both.withColumn("_kind", F.col("plan").isNull()), "_kind").select("conv_id", "plan", "role", "text", "copies")
    replayed = both.mapInArrow(replay, "conv_id long, replayed string").withColumnRenamed("conv_id", "_conv")
    out = audits.join(replayed, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return out.select("conv_id", *COUNTS, "audit", F.coalesce("repaired_sha256", "replayed").alias("repaired_sha256"))
