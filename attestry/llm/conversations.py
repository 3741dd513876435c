"""Conversation structure repair: the cheapest edits that make turns alternate, by Hirschberg's divide and conquer.

A repaired conversation's role initials read ``(s?(ua)+)?``, so after any prefix it is in
one of four states: nothing yet, after ``s``, after ``u``, after ``a``.  A row's effect is a
table of costs from state to state.  Forward costs over the first half and backward costs
over the second meet in the middle; the crossing of least total cost is fixed, ties by the
least audit, and both halves are solved alike, so only four-state vectors are ever held.

Beside each cost the forward vector holds the order of the four best audits.  Audits of one
cost that end with an edit of the same row are never prefixes of each other (only inserts
could follow, and they cost), so the order at a crossing decides the order of the whole.
Inserts belong to the row that they precede.

The same holds for blocks of rows: a long conversation is cut into blocks, each task
reduces blocks to 4 x 4 tables, the tables of one conversation (of groups of blocks, if
there are many) are crossed as rows are, and then every block is solved between its two
known states.  No task holds more than a block of rows or a fan of tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Bits of a block of rows, and of a fan of tables.
BITS = 12
_SPACE = " \t\n\x0b\x0c\r"
_INF = 1 << 60
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
_INSERT = {_START: _AFTER_U, _AFTER_S: _AFTER_U, _AFTER_U: _AFTER_A, _AFTER_A: _AFTER_U}
_KEEP = {"s": {_START: _AFTER_S}, "u": {_START: _AFTER_U, _AFTER_S: _AFTER_U, _AFTER_A: _AFTER_U}, "a": {_AFTER_U: _AFTER_A}, "": {}}
#: Inserts that complete a conversation, by state.
_CLOSING = (0, 2, 1, 0)
_FORCED = 8

# A table has for each state the (next state, cost, key) that a row or a block leads to; keys order the audits from one state.
Table = list[list[tuple]]


def _row_table(initial: str, truncated: int) -> Table:
    table = []
    for state in range(4):
        best = {state: (3, "D")}
        at = state
        for inserts in range(3):
            for letter, to, cost in (("K", _KEEP[initial].get(at), 0), ("R", _INSERT[at], 2)):
                found = (2 * inserts + cost + truncated, "I" * inserts + letter)
                if to is not None and found < best.get(to, (_INF, "")):
                    best[to] = found
            at = _INSERT[at]
        table.append([(to, *found) for to, found in sorted(best.items())])
    return table


_ROWS = [_row_table(initial, truncated) for truncated in (0, 1) for initial in ("s", "u", "a", "")]


def _deleted(times: int) -> Table:
    return [[(state, 3 * times, "D" * times)] for state in range(4)]


def _forward(tables: list[Table], lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Costs of the four states after ``tables[lo:hi]``, and the order of their least audits."""
    cost, rank = [_INF] * 4, [0] * 4
    cost[start] = 0
    for i in range(lo, hi):
        best: list = [None] * 4
        table = tables[i]
        for p in range(4):
            if cost[p] < _INF:
                for q, c, key in table[p]:
                    found = (cost[p] + c, rank[p], key)
                    if best[q] is None or found < best[q]:
                        best[q] = found
        order = sorted((b[1:], q) for q, b in enumerate(best) if b)
        cost, rank = [b[0] if b else _INF for b in best], [0] * 4
        for r, (_, q) in enumerate(order):
            rank[q] = r
    return cost, rank


def _backward(tables: list[Table], lo: int, hi: int, end: int) -> list[int]:
    """Cost of reaching ``end`` through ``tables[lo:hi]`` from each state."""
    cost = [_INF] * 4
    cost[end] = 0
    for i in range(hi - 1, lo - 1, -1):
        cost = [min((c + cost[q] for q, c, _ in row), default=_INF) for row in tables[i]]
    return cost


def last_state(tables: list[Table], start: int = _START) -> tuple[int, int]:
    """State after the last row of the cheapest, audit-least repair, and the repair's cost."""
    cost, rank = _forward(tables, 0, len(tables), start)
    total, _, state = min((cost[q] + 2 * _CLOSING[q], rank[q], q) for q in range(4) if cost[q] < _INF)
    return state, total


def crossings(tables: list[Table], start: int, end: int) -> list[int]:
    """States before the first table, between tables and after the last, on the audit-least of the cheapest ways from ``start`` to ``end``."""
    states = [start] * len(tables) + [end]
    todo = [(0, len(tables))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo > 1:
            mid = (lo + hi) // 2
            cost, rank = _forward(tables, lo, mid, states[lo])
            after = _backward(tables, mid, hi, states[hi])
            states[mid] = min((cost[s] + after[s], rank[s], s) for s in range(4) if cost[s] + after[s] < _INF)[2]
            todo += [(lo, mid), (mid, hi)]
    return states


def _summary(tables: list[Table]) -> list[int]:
    """A block's table as 32 numbers: costs and ranks from each state to each."""
    out = []
    for start in range(4):
        cost, rank = _forward(tables, 0, len(tables), start)
        out += cost + rank
    return out


def _as_table(numbers: list[int]) -> Table:
    return [[(q, numbers[8 * p + q], numbers[8 * p + 4 + q]) for q in range(4) if numbers[8 * p + q] < _INF] for p in range(4)]


def _tables(kinds: list[int], copies: list[int]) -> tuple[list[Table], list[int]]:
    """Tables of rows, with one more for further copies of a row; and for each the row that it belongs to."""
    tables, of = [], []
    for i, (kind, n) in enumerate(zip(kinds, copies, strict=True)):
        further = n
        if kind != _FORCED:
            tables.append(_ROWS[kind])
            of.append(i)
            further = n - 1
        if further:
            tables.append(_deleted(further))
            of.append(i)
    return tables, of


def _runs(convs: list) -> list[tuple[int, int]]:
    """Stretches of equal neighbours."""
    cuts = [0, *[i for i in range(1, len(convs)) if convs[i] != convs[i - 1]], len(convs)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def _inserted(state: int, n: int) -> list[str]:
    roles = []
    for _ in range(n):
        state = _INSERT[state]
        roles.append("user" if state == _AFTER_U else "assistant")
    return roles


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of ``rows`` after damage by the CRC-32 of ``conv_id:turn``; null cells count as one space, null turns stay null.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 removes its sentence marks, 3 repeats it, 4 makes its role ``user``.
    """
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(cell("conv_id"), F.lit(":"), cell("turn"))) % 20
    df = rows.select("conv_id", "turn", cell("role").alias("role"), cell("text").alias("text"), hit.alias("hit")).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return df.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("hit") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies, fault and place (``pos``, in order of conversation, turn, role and text), written to the shared folder.

    Equal rows are summed before they are shuffled, the first of equal role and text is
    a minimum joined by turn, and places come from a range partitioning, so no key,
    however frequent, lands in one task.
    """
    alike = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    each = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("alike", alike))
    when = lambda d: F.struct(d["turn"].isNotNull().alias("has"), d["turn"].alias("turn"))
    first = each.groupBy("conv_id", "alike").agg(F.min(when(each)).alias("f")).select(F.col("conv_id").alias("c"), F.col("alike").alias("k"), F.col("f.turn").alias("t"), F.lit(True).alias("is_first"))
    df = each.join(first, each.conv_id.eqNullSafe(first.c) & (each.alike == first.k) & each.turn.eqNullSafe(first.t), "left").drop("c", "k", "t", "alike")
    bare = F.translate("text", _SPACE, "")
    fault = F.when(bare == "", "blank").when(F.col("is_first").isNull(), "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    order = ["conv_id", "turn", "role", "text"]
    df = df.withColumn("fault", fault).drop("is_first").repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(df.withColumn("pos", F.monotonically_increasing_id()))


def _kind() -> Column:
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.when(F.col("fault").isin("blank", "duplicate"), _FORCED).otherwise(letter + F.when(F.col("fault") == "truncated", 4).otherwise(0)).cast("long")


def _states(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, p, q, last): the states around every block of a conversation that may go beyond one block."""
    spark, conv = blocks.sparkSession, blocks.schema["conv_id"].dataType.simpleString()
    node = f"conv_id {conv}, node long, numbers array<long>"

    def reduce_block(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        convs, kinds, copies = (table.column(c).to_pylist() for c in ("conv_id", "kind", "copies"))
        runs = _runs(convs)
        edge = [runs[0], *runs[1:][-1:]]
        numbers = [_summary(_tables(kinds[a:b], copies[a:b])[0]) for a, b in edge]
        block = table.column("block")[0].as_py()
        return pa.table([pa.array([convs[a] for a, _ in edge], table.schema.field("conv_id").type), pa.array([block] * len(edge), pa.int64()), pa.array(numbers, pa.list_(pa.int64()))], names=["conv_id", "node", "numbers"])

    def reduce_fan(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        numbers = _summary([_as_table(n) for n in table.column("numbers").to_pylist()])
        return pa.table([table.column("conv_id").slice(0, 1), pa.array([table.column("node")[0].as_py() >> BITS], pa.int64()), pa.array([numbers], pa.list_(pa.int64()))], names=["conv_id", "node", "numbers"])

    def cross(table: pa.Table, start: int, end: int, last: bool) -> pa.Table:
        states = crossings([_as_table(n) for n in table.column("numbers").to_pylist()], start, end)
        ends = [False] * (table.num_rows - 1) + [last]
        return pa.table([table.column("conv_id"), table.column("node"), pa.array(states[:-1], pa.int64()), pa.array(states[1:], pa.int64()), pa.array(ends, pa.bool_())], names=["conv_id", "node", "p", "q", "last"])

    def cross_top(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        return cross(table, _START, last_state([_as_table(n) for n in table.column("numbers").to_pylist()])[0], True)

    def cross_fan(children: pa.Table, parent: pa.Table) -> pa.Table:
        p, q, last = (parent.column(c)[0].as_py() for c in ("p", "q", "last"))
        return cross(children.sort_by("node"), p, q, last)

    levels = [stored(blocks.groupBy("block").applyInArrow(reduce_block, node))]
    found = f"conv_id {conv}, node long, p long, q long, last boolean"
    while (levels[-1].groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > 1 << BITS:
        levels.append(stored(levels[-1].groupBy("conv_id", F.shiftright("node", BITS).alias("fan")).applyInArrow(reduce_fan, node)))
    states = stored(levels[-1].groupBy("conv_id").applyInArrow(cross_top, found))
    for level in reversed(levels[:-1]):
        children = level.withColumn("fan", F.shiftright("node", BITS)).groupBy("conv_id", "fan")
        states = stored(children.cogroup(states.withColumnRenamed("node", "fan").groupBy("conv_id", "fan")).applyInArrow(cross_fan, found))
    return spark.createDataFrame([], found).unionByName(states).withColumnRenamed("node", "block")


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every conversation of ``rows`` (conv_id, turn, role, text, copies), one row for each distinct row.

    Returns the row with its ``pos``, ``copies`` and ``fault``; ``edit`` (K keep, R rerole, D
    delete; further copies are deleted too), ``new_role``, ``before`` and ``after`` (roles of
    empty turns inserted around it), ``audit`` (initials of all these edits) and ``cost``.
    Rows of one turn are taken by role and text; null ids are one conversation, null
    turns come first; an empty table gives an empty one.  Roles and texts must not be null.
    """
    all_rows = _faults(rows)
    blocks = all_rows.select("conv_id", "pos", _kind().alias("kind"), "copies", F.shiftright("pos", BITS).alias("block"))
    schema = "pos long, edit string, new_role string, before array<string>, after array<string>, audit string, cost long"

    def solve(table: pa.Table, known: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        convs, places, kinds, copies = (table.column(c).to_pylist() for c in ("conv_id", "pos", "kind", "copies"))
        ways = {r["conv_id"]: (r["p"], r["q"], r["last"]) for r in known.to_pylist()}
        out: dict[str, list] = {c: [] for c in ("pos", "edit", "new_role", "before", "after", "audit", "cost")}
        for a, b in _runs(convs):
            tables, of = _tables(kinds[a:b], copies[a:b])
            start, end, last = ways[convs[a]] if convs[a] in ways else (_START, last_state(tables)[0], True)
            states = crossings(tables, start, end)
            for i, k in enumerate(of):
                _, cost, key = next(x for x in tables[i][states[i]] if x[0] == states[i + 1])
                if i and of[i - 1] == k:  # further copies of the row before
                    out["audit"][-1] += key
                    out["cost"][-1] += cost
                    continue
                n = len(key) - len(key.lstrip("I"))
                edit = key[-1]
                found = (places[a + k], edit, ("user" if states[i + 1] == _AFTER_U else "assistant") if edit == "R" else None, _inserted(states[i], n), [], key, cost)
                for column, value in zip(out.values(), found, strict=True):
                    column.append(value)
            if last:
                n = _CLOSING[end]
                out["after"][-1] = _inserted(end, n)
                out["audit"][-1] += "I" * n
                out["cost"][-1] += 2 * n
        types = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.int64())
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    found = blocks.groupBy("block").cogroup(_states(blocks).groupBy("block")).applyInArrow(solve, schema)
    return all_rows.join(found, "pos")


def _lines() -> Column:
    """Turns that an edited row leaves, as ``role:text``."""
    own = F.when(F.col("edit") == "K", F.array(F.concat_ws(":", "role", "text"))).when(F.col("edit") == "R", F.array(F.concat_ws(":", "new_role", "text"))).otherwise(F.array().cast("array<string>"))
    empty = lambda c: F.transform(c, lambda r: F.concat(r, F.lit(":")))
    return F.concat(empty("before"), own, empty("after"))


def repaired(edited: DataFrame) -> DataFrame:
    """(conv_id, pos, n, role, text) of the turns that :func:`edits` leaves, in order of ``pos`` and ``n``."""
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    empty = lambda c: F.transform(c, lambda r: turn(r, F.lit("")))
    own = F.when(F.col("edit") == "D", F.array().cast("array<struct<role:string,text:string>>")).otherwise(F.array(turn(F.coalesce("new_role", "role"), F.col("text"))))
    return edited.select("conv_id", "pos", F.posexplode(F.concat(empty("before"), own, empty("after"))).alias("n", "t")).select("conv_id", "pos", "n", "t.role", "t.text")


def _texts(edited: DataFrame) -> DataFrame:
    """(conv_id, illegal, audit, repaired_sha256): rows stream through in order, so a conversation of any length takes no more memory than its audit."""
    conv = edited.schema["conv_id"].dataType.simpleString()
    df = edited.select("conv_id", "pos", "copies", "audit", F.substring("role", 1, 1).alias("initial"), F.array_join(_lines(), "\n").alias("piece"), F.size(_lines()).alias("n"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, kind = None, False, None

        def result():
            cells = ([now], [illegal], ["".join(audit)], [sha.hexdigest()])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (kind, pa.int64(), pa.string(), pa.string()), strict=True)], names=["conv_id", "illegal", "audit", "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for c, copies, letters, initial, piece, n in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "copies", "audit", "initial", "piece", "n")), strict=True):
                if not open_ or c != now:
                    if open_:
                        yield result()
                    now, open_, illegal, audit, sha, before, any_ = c, True, 0, [], hashlib.sha256(), None, False
                illegal += copies - 1 + (before is not None and before + initial not in ("su", "ua", "au"))
                before = initial
                audit.append(letters)
                if n:
                    sha.update((("\n" if any_ else "") + piece).encode("utf-8", "surrogatepass"))
                    any_ = True
        if open_:
            yield result()

    return df.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(stream, f"conv_id {conv}, illegal long, audit string, repaired_sha256 string")


def digests(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``, damaged and repaired: gaps, faults, illegal neighbours, cost, audit and hash of the repaired turns.

    Null cells count as one space, null turns come first and aren't gaps, null ids are one
    conversation.  A conversation without rows after damage has zeros, an empty audit and
    the hash of nothing; repeated rows are copies of one turn; an empty table gives an empty one.
    """
    edited = stored(edits(damage(rows)))
    is_ = lambda f: F.col("fault") == f
    duplicate = F.when(is_("duplicate"), F.col("copies")).when(~is_("blank"), F.col("copies") - 1).otherwise(0)
    faults = [F.sum(F.when(is_("blank"), F.col("copies")).otherwise(0)).alias("blank"), F.sum(duplicate).alias("duplicate"), F.count(F.when(is_("truncated"), 1)).alias("truncated")]
    stats = edited.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"), *faults, F.sum("cost").alias("cost"))
    every = rows.select("conv_id").distinct()
    a, b = stats.withColumnRenamed("conv_id", "a"), _texts(edited).withColumnRenamed("conv_id", "b")
    out = every.join(a, every.conv_id.eqNullSafe(a.a), "left").join(b, every.conv_id.eqNullSafe(b.b), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id",
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
