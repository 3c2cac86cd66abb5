"""Repair of conversation structure at least cost, by block tables.

A row is a symbol: its role's initial, and whether it must go or ends in the middle of a sentence. The cheapest way to
end well from each of the four states (nothing yet, system, user, assistant) is a cost vector; less its minimum it takes
only a few dozen values. Tables hold, for every such vector and every block of BLOCK symbols, the vector before the
block, the cost between, and the state in which each start state leaves the block when the best edits are taken.

1. Rows are sorted over the whole cluster; a piece is at most PIECE consecutive rows of one conversation.
2. A piece runs through the tables from its last block to its first. What it does to every vector is a small table of
   the same form, so conversations of many pieces are closed by composing these level by level, and each piece then
   knows its end vector and start state.
3. With both, blocks are expanded backward into vectors for each row, and edits are read off forward; at a tie the
   least letter is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import staged

#: Symbols of a table entry, and the bits of a row number inside a piece (and of a piece inside a level above it).
BLOCK, BITS = 4, 12
#: m: must be deleted; role initials of other rows (o: none of s, u, a), in capitals where the text breaks off.
SYMBOLS = "msuaoSUAO"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
DELETE, INSERT, REROLE, TRUNCATED, NEVER = 3, 2, 2, 1, 10**6
_AFTER = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_WHITE = " \t\n\x0b\f\r"


def _next(state: int) -> int:
    """The state after the only row that may be inserted in a state."""
    return ASSISTANT if state == USER else USER


class Step:
    """One symbol, or the end for None: costs before it from costs after it, and the best edits from a state."""

    def __init__(self, symbol: str | None, after: Sequence[int]):
        self.after, self.symbol = after, symbol
        letter = (symbol or "").lower()
        self.cut = TRUNCATED if symbol and symbol.isupper() else 0
        self.may_stay = symbol not in (None, "m")
        self.kept = _AFTER.get(letter, {}) if self.may_stay else {}
        costs = [0 if s in (NOTHING, ASSISTANT) else NEVER for s in range(STATES)] if symbol is None else [
            min([DELETE + after[s], *([self.cut + after[self.kept[s]]] if s in self.kept else []), *([REROLE + self.cut + after[_next(s)]] if self.may_stay else [])])
            for s in range(STATES)
        ]
        for _ in range(STATES):
            costs = [min(costs[s], INSERT + costs[_next(s)]) for s in range(STATES)]
        self.costs = costs

    def edits(self, state: int) -> tuple[str, str, int]:
        """(edits, what comes out, state after) from a state, the least letters among the cheapest.

        Out: U, A inserted user and assistant; k the row as it is; u, a the row with a new role.
        """
        letters = out = ""
        while True:
            rest = self.costs[state]
            if self.symbol is None and rest == 0:
                return letters, out, state
            if self.symbol and DELETE + self.after[state] == rest:
                return letters + "D", out, state
            follower = _next(state)
            if INSERT + self.costs[follower] == rest:
                letters, out, state = letters + "I", out + ("U" if follower == USER else "A"), follower
                continue
            if state in self.kept and self.cut + self.after[self.kept[state]] == rest:
                return letters + "K", out + "k", self.kept[state]
            return letters + "R", out + ("u" if follower == USER else "a"), follower


class Tables:
    """Transitions of normalised vectors over one symbol and over every block of BLOCK symbols."""

    def __init__(self) -> None:
        end = Step(None, ())
        self.vectors: list[tuple[int, ...]] = [tuple(end.costs)]
        known = {self.vectors[0]: 0}
        steps: list[list[Step]] = []
        for vector in self.vectors:  # grows until no symbol gives a new vector
            steps.append([Step(s, vector) for s in SYMBOLS])
            for step in steps[-1]:
                least = min(step.costs)
                before = tuple(c - least for c in step.costs)
                if before not in known:
                    known[before] = len(self.vectors)
                    self.vectors.append(before)
        self.steps, self.end = steps, end
        shape = (len(self.vectors), len(SYMBOLS))
        before = np.array([[known[tuple(c - min(x.costs) for c in x.costs)] for x in row] for row in steps])
        cost = np.array([[min(x.costs) for x in row] for row in steps])
        leaves = np.array([[[x.edits(s)[2] for s in range(STATES)] for x in row] for row in steps])
        assert before.shape == shape
        self.one = (before, cost, leaves)
        self.block = self.one
        for _ in range(BLOCK - 1):
            self.block = self._joined(self.one, self.block)

    @staticmethod
    def _joined(first: tuple, rest: tuple) -> tuple:
        """Tables over a symbol of ``first`` followed by a block of ``rest``, for all pairs of them."""
        vectors, symbols, blocks = first[0].shape[0], first[0].shape[1], rest[0].shape[1]
        between = rest[0]  # vector before the rest: [vector, block]
        before = first[0][between].transpose(0, 2, 1).reshape(vectors, symbols * blocks)
        cost = (first[1][between] + rest[1][:, :, None]).transpose(0, 2, 1).reshape(vectors, symbols * blocks)
        mid = first[2][between]  # [vector, block, symbol, state]
        leaves = np.take_along_axis(np.broadcast_to(rest[2][:, :, None, :], mid.shape), mid, 3)
        return before, cost, leaves.transpose(0, 2, 1, 3).reshape(vectors, symbols * blocks, STATES)

    def blocks(self, symbols: str) -> tuple[list[int], list[int]]:
        """(symbols that fill no block, in front; codes of the blocks that follow)."""
        codes = [SYMBOLS.index(s) for s in symbols]
        head = len(codes) % BLOCK
        out = []
        for at in range(head, len(codes), BLOCK):
            code = 0
            for symbol in codes[at:at + BLOCK]:
                code = code * len(SYMBOLS) + symbol
            out.append(code)
        return codes[:head], out

    @lru_cache(maxsize=100_000)  # noqa: B019  one object in a process
    def expanded(self, block: int, vector: int, state: int) -> tuple[tuple[str, ...], tuple[str, ...], int]:
        """Edits and outcome of each row of a block, from the vector after it and the state before it."""
        codes = [block // len(SYMBOLS) ** (BLOCK - 1 - i) % len(SYMBOLS) for i in range(BLOCK)]
        return self._read(codes, vector, state)

    def _read(self, codes: list[int], vector: int, state: int) -> tuple[tuple[str, ...], tuple[str, ...], int]:
        after = []
        for code in reversed(codes):
            after.append(vector)
            vector = int(self.one[0][vector, code])
        letters, out = [], []
        for code, vector in zip(codes, reversed(after)):
            some, made, state = self.steps[vector][code].edits(state)
            letters.append(some)
            out.append(made)
        return tuple(letters), tuple(out), state

    def solve(self, symbols: str, vector: int, state: int) -> tuple[str, list[str], int, int]:
        """(edits, outcome of each row, cost from the start state less the end vector's, state after)."""
        head, blocks = self.blocks(symbols)
        cost, ends = 0, []
        for block in reversed(blocks):
            ends.append(vector)
            cost += int(self.block[1][vector, block])
            vector = int(self.block[0][vector, block])
        letters, out, first = [], [], state
        some, made, state = self._read(head, vector, state)
        for code in reversed(head):
            cost += int(self.one[1][vector, code])
            vector = int(self.one[0][vector, code])
        cost += self.vectors[vector][first]
        letters += some
        out += made
        for block, end in zip(blocks, reversed(ends)):
            some, made, state = self.expanded(block, end, state)
            letters += some
            out += made
        return "".join(letters), out, cost, state

    def identity(self) -> tuple:
        n = len(self.vectors)
        return np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(STATES), (n, 1))

    @staticmethod
    def before(done: tuple, table: tuple) -> tuple:
        """What ``table`` followed by ``done`` does to each vector; ``table`` has one row per vector."""
        vector, cost, leaves = done
        return table[0][vector], cost + table[1][vector], np.take_along_axis(leaves, table[2][vector], 1)

    def function(self, symbols: str) -> tuple:
        """What a piece does to every vector."""
        head, blocks = self.blocks(symbols)
        done = self.identity()
        for block in reversed(blocks):
            done = self.before(done, tuple(t[:, block] for t in self.block))
        for code in reversed(head):
            done = self.before(done, tuple(t[:, code] for t in self.one))
        return done

    @staticmethod
    def pack(done: tuple) -> bytes:
        return done[0].astype("u1").tobytes() + done[1].astype("<i8").tobytes() + done[2].astype("u1").tobytes()

    def unpack(self, raw: bytes) -> tuple:
        n = len(self.vectors)
        return (
            np.frombuffer(raw, "u1", n).astype(int), np.frombuffer(raw, "<i8", n, n),
            np.frombuffer(raw, "u1", n * STATES, 9 * n).reshape(n, STATES).astype(int),
        )


@cache
def tables() -> Tables:
    return Tables()


def _pieces_solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """symbols, end vector, start state, is last -> edits, outcome of each row, cost."""
    t = tables()
    for batch in batches:
        edits, outs, costs = [], [], []
        for symbols, vector, state, last in zip(*(c.to_pylist() for c in batch.columns[-4:])):
            letters, out, cost, after = t.solve(symbols, vector, state)
            if last:  # rows that have to follow the last one; the end vector's cost is theirs
                more, made, _ = t.end.edits(after)
                letters += more
                out[-1] += made
            else:
                cost -= t.vectors[vector][after]
            edits.append(letters)
            outs.append(out)
            costs.append(cost)
        made = [pa.array(edits, pa.string()), pa.array(outs, pa.list_(pa.string())), pa.array(costs, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-4], *made], names=[*batch.schema.names[:-4], "edits", "outs", "cost"])


def _with_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = tables()
    for batch in batches:
        made = pa.array([t.pack(t.function(s)) for s in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], made], names=["conv_id", "at", "function"])


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = tables()
    for batch in batches:
        out = []
        for members in batch.column(2).to_pylist():
            done = t.identity()
            for member in reversed(members):
                done = t.before(done, t.unpack(member["function"]))
            out.append(t.pack(done))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())], names=["conv_id", "at", "function"])


def _bounds_dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group's end vector and start state -> those of its members."""
    t = tables()
    for batch in batches:
        rows: dict[str, list] = {"conv_id": [], "at": [], "vector": [], "state": [], "last": []}
        for conv, members, vector, state, last in zip(*(c.to_pylist() for c in batch.columns)):
            functions = [t.unpack(m["function"]) for m in members]
            ends = []
            for function in reversed(functions):
                ends.append(vector)
                vector = int(function[0][vector])
            for i, (member, end, function) in enumerate(zip(members, reversed(ends), functions)):
                for name, value in zip(rows, (conv, member["at"], end, state, last and i == len(members) - 1)):
                    rows[name].append(value)
                state = int(function[2][end][state])
        kinds = (batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))


def _conversation(df: DataFrame) -> str:
    return f"conv_id {df.schema['conv_id'].dataType.simpleString()}"


def _bounds(nodes: DataFrame) -> DataFrame:
    """(conv_id, at, vector, state, last) for (conv_id, at, function): pieces in the order of ``at``.

    Nodes meet in groups of at most 2**BITS; groups are nodes of the next level, until each conversation has one.
    """
    members = F.sort_array(F.collect_list(F.struct("at", "function")))
    groups = staged(nodes.groupBy("conv_id", F.shiftright("at", BITS).alias("up")).agg(members.alias("members")), "repair-level")
    levels = groups.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    if levels <= 1:
        bound = groups.select("conv_id", "members", F.lit(0).alias("vector"), F.lit(NOTHING).alias("state"), F.lit(True).alias("last"))
    else:
        above = groups.mapInArrow(_composed_of(groups), f"{_conversation(nodes)}, at long, function binary")
        found = _bounds(above).withColumnRenamed("conv_id", "_conv")
        bound = groups.join(found, groups.conv_id.eqNullSafe(found._conv) & (groups.up == found.at)).select("conv_id", "members", "vector", "state", "last")
    return bound.mapInArrow(_bounds_dealt, f"{_conversation(nodes)}, at long, vector int, state int, last boolean")


def _composed_of(groups: DataFrame):
    """The columns of ``groups`` come as conv_id, up, members."""
    assert groups.columns == ["conv_id", "up", "members"]
    return _composed


def placed(rows: DataFrame) -> DataFrame:
    """Rows in order, each with a number (``row``) that grows along conversations and turns, and its own faults.

    A staged table. Order: conversation, turn (nulls first), role, digest of the text. Rows alike in all of these are
    interchangeable. A conversation of any size is spread over as many tasks as its rows fill.
    """
    text = F.col("text")
    ended = F.rtrim(F.coalesce(text, F.lit("")), F.lit(_WHITE))
    initial = F.substring("role", 1, 1)
    marked = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.sha2(text, 256).alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ordered.withColumn("row", F.monotonically_increasing_id()), "repair-rows")


def _pieces(rows: DataFrame) -> DataFrame:
    firsts = rows.filter(~F.col("blank")).groupBy("conv_id", "role", "digest").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    narrow = rows.select("conv_id", "row", "initial", "blank", "cut").join(firsts, "row", "left")
    again = ~F.col("blank") & F.col("first").isNull()
    symbol = F.when(F.col("blank") | again, "m").when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial"))
    ordered = F.sort_array(F.collect_list(F.struct("row", symbol.alias("symbol"), "initial")))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    found = narrow.groupBy("conv_id", F.shiftright("row", BITS).alias("at")).agg(
        ordered.alias("ordered"), count(F.col("blank")).alias("blank"), count(again).alias("duplicate"),
        count(~F.col("blank") & ~again & F.col("cut")).alias("truncated"),
    )
    initials = F.array_join("ordered.initial", "")
    return staged(found.select(
        "conv_id", "at", F.col("ordered")[0]["row"].alias("row"), F.array_join("ordered.symbol", "").alias("symbols"), initials.alias("initials"),
        "blank", "duplicate", "truncated",
    ), "repair-pieces")


def _illegal(initials: Column) -> Column:
    """Adjacent pairs that are not su, ua or au."""
    legal = F.regexp_count(initials, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    return (F.greatest(F.length(initials) - 1, F.lit(0)) - legal).cast("long")


def solved(rows: DataFrame) -> DataFrame:
    """Each piece with its edits, what comes of each of its rows, its share of the cost, and its counts; staged."""
    pieces = _pieces(rows)
    many = pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("_conv"))
    many = staged(many, "repair-many")
    counts = ["conv_id", "at", "row", "blank", "duplicate", "truncated", "illegal"]
    out = ", ".join([_conversation(pieces), *(f"{c} long" for c in counts[1:]), "edits string, outs array<string>, cost long"])
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    alone = pieces.join(many, same, "left_anti").select(
        *counts[:-1], _illegal(F.col("initials")).alias("illegal"), "symbols", F.lit(0).alias("vector"), F.lit(NOTHING).alias("state"), F.lit(True).alias("last"),
    )
    if many.isEmpty():
        return staged(alone.mapInArrow(_pieces_solved, out), "repair-solved")
    parts = pieces.join(many, same, "left_semi")
    functions = parts.select("conv_id", "at", "symbols").mapInArrow(_with_functions, f"{_conversation(pieces)}, at long, function binary")
    bounds = _bounds(functions).select(F.col("conv_id").alias("_conv"), F.col("at").alias("_at"), "vector", "state", "last")
    # rows of a window are pieces here, one for up to 2**BITS rows of a conversation
    earlier = F.lag(F.right("initials", F.lit(1))).over(Window.partitionBy("conv_id").orderBy("at"))
    seen = parts.withColumn("initials", F.concat(F.coalesce(earlier, F.lit("")), "initials"))
    bound = seen.join(bounds, same & (F.col("at") == F.col("_at"))).select(
        *counts[:-1], _illegal(F.col("initials")).alias("illegal"), "symbols", "vector", "state", "last",
    )
    return staged(alone.unionByName(bound).mapInArrow(_pieces_solved, out), "repair-solved")


def audits(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    spread = rows.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.max("turn").alias("most"), F.min("turn").alias("least"), F.count("turn").alias("different"))
    gaps = F.coalesce(F.expr("try_cast(CAST(most AS DECIMAL(38,0)) - least + 1 - different AS BIGINT)"), F.when(F.col("most").isNull(), F.lit(0)))
    total = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("at", "edits"))).getField("edits"), "")
    summed = pieces.groupBy("conv_id").agg(*total, audit.alias("audit")).withColumnRenamed("conv_id", "_conv")
    return spread.join(summed, spread.conv_id.eqNullSafe(summed._conv)).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, row, part, role, text), in the order of row and part.

    Rows find their outcome by their number, which no two rows share, so a long conversation stays spread.
    """
    outcomes = pieces.select(F.col("row").alias("start"), F.posexplode("outs").alias("i", "out")).filter("out <> ''")
    outcomes = outcomes.select((F.col("start") + F.col("i")).alias("row"), "out")
    each = rows.select("conv_id", "row", "role", "text").join(outcomes, "row").select("*", F.posexplode(F.split("out", "")).alias("part", "code"))
    role = F.when(F.lower("code") == "u", "user").when(F.lower("code") == "a", "assistant").otherwise(F.col("role"))
    return each.select("conv_id", "row", "part", role.alias("role"), F.when(F.col("code").isin("U", "A"), "").otherwise(F.col("text")).alias("text"))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired rows) of rows (conv_id, turn, role, text); other columns are not looked at.

    Faults, the first counts: blank (null or only white space), duplicate (role and text stood before), truncated (last
    character that is not white space is none of ``.!?``). Edits: keep (0), new role user or assistant (2), delete (3,
    a must for blank and duplicate rows), insert an empty user or assistant row (2); a truncated row that stays adds 1.
    The roles that remain start with s?(ua)+ by their initials, or nothing remains. ``audit`` has the initials of the
    cheapest edits in order, at ties the least string by ASCII. Null turns come first; a null role is a role of no
    known initial; null ids are one conversation; repeated rows are duplicates. Ties in turn go by role, then digest
    of the text. No rows give no conversations.
    """
    rows = placed(conversations)
    pieces = solved(rows)
    return audits(rows, pieces), repaired(rows, pieces)
