"""Repair of conversation structure by a grammar-compressed dynamic programme.

A row of a conversation is one symbol: the class of its role (s, u, a, o for others), upper case if its
text is truncated, x if it has to be deleted. The cheapest edits that turn the symbols into roles
``(s?(ua)+)?`` follow from the product of one matrix per symbol over the states start, after s, after u, after a:
entry (p, q) is the least cost of getting from p to q, with the edits' initials as a rope. Products take
the least (cost, initials); as no audit of the same rows and cost is the beginning of another one, the least
audit of a product is made of least audits of its parts.

Sequences are cut into pieces of at most PIECE symbols and each distinct piece is solved once for all
conversations that have it. Re-Pair replaces the commonest pairs of symbols over all distinct pieces
by rules (ROUNDS rounds of at most PAIRS pairs without a common symbol); a rule's matrix is the product of its two
symbols' matrices, computed once, bottom up, and its ropes share the ropes of its parts. The driver sees pair
counts only, at most the square of the number of symbols. Conversations of several pieces are multiplied
piece by piece, GROUP at a time, so no task holds a whole conversation's matrices.

Rows are put in order by a range exchange, which may split a conversation; equal rows are counted
instead of listed. The digest of the repaired rows is sequential by nature: one task reads the rows of a
conversation as a stream, after its audit, and keeps none.

Defined results: a null id, turn, role or text reads as one space (the null id is reported as null); rows of one
turn are taken by role, then text; equal rows stand next to each other; turns are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwatch.llm.common import hot_keys, salted_join, stage

PIECE = 1_024
GROUP = 64
ROUNDS = 6
PAIRS = 8
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: State after a role of class s, u, a; the states are 0 start, 1 after s, 2 after u, 3 after a.
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The one role that may follow a state, besides s at the start.
_NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
LEGAL = ("su", "ua", "au")
_SEEN = r"[^\x20\x09-\x0D]"
_FIRST_RULE = 0xE000


# --- matrices ---------------------------------------------------------------------------------


class Rope:
    """Text as a tree of shared parts."""

    __slots__ = ("left", "right")

    def __init__(self, left: Rope | str, right: Rope | str):
        self.left, self.right = left, right

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            part = todo.pop()
            if isinstance(part, Rope):
                todo += [part.right, part.left]
            else:
                out.append(part)
        return "".join(out)


Entry = tuple[int, "Rope | str"]
Matrix = list[list[Entry | None]]


def _less(a: Entry, b: Entry | None) -> bool:
    return b is None or a[0] < b[0] or (a[0] == b[0] and str(a[1]) < str(b[1]))


def product(left: Matrix, right: Matrix) -> Matrix:
    """Least (cost, initials) over all states between."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p, row in enumerate(left):
        for between, first in enumerate(row):
            if first is None:
                continue
            for q, second in enumerate(right[between]):
                if second is not None:
                    cost = first[0] + second[0]
                    if out[p][q] is None or cost <= out[p][q][0]:
                        entry = (cost, Rope(first[1], second[1]) if first[1] and second[1] else first[1] or second[1])
                        if _less(entry, out[p][q]):
                            out[p][q] = entry
    return out


def _insertions() -> Matrix:
    """Any number of inserted rows, none included."""
    one: Matrix = [[(0, "") if p == q else None for q in range(4)] for p in range(4)]
    for p, role in _NEXT.items():
        one[p][_AFTER[role][p]] = (INSERT, "I")
    return product(one, product(one, one))


def _row(symbol: str) -> Matrix:
    """One row kept, reroled or deleted."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        out[p][p] = (DELETE, "D")
        if symbol == "x":
            continue
        more = TRUNCATED if symbol.isupper() else 0
        for cost, initial, role in ((more, "K", symbol.lower()), (more + REROLE, "R", _NEXT[p])):
            q = _AFTER.get(role, {}).get(p)
            if q is not None and _less((cost, initial), out[p][q]):
                out[p][q] = (cost, initial)
    return out


def symbol_matrices() -> dict[str, Matrix]:
    around = _insertions()
    return {s: product(around, product(_row(s), around)) for s in "suaoSUAOx"}


def rule_matrices(rules: list[tuple[str, str]]) -> dict[str, Matrix]:
    """Matrices of all symbols and rules; a rule (symbol, pair) comes after the symbols of its pair."""
    found = symbol_matrices()
    for symbol, pair in rules:
        found[symbol] = product(found[pair[0]], found[pair[1]])
    return found


def solve(sequence: str, matrices: dict[str, Matrix]) -> Matrix:
    out = matrices[sequence[0]]
    for symbol in sequence[1:]:
        out = product(out, matrices[symbol])
    return out


# --- rows and faults --------------------------------------------------------------------------


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text, copies) of the damaged rows; a dropped row has no copies."""
    kind = F.pmod(F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_text("text"), "[.!?]", "")).otherwise(_text("text"))
    return rows.select(
        _text("conv_id").alias("conv"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_text("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(rows: DataFrame) -> DataFrame:
    """The same columns for rows that are judged as they are."""
    return rows.select(
        _text("conv_id").alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"),
        _text("role").alias("role"), _text("text").alias("text"), F.lit(1).alias("copies"),
    )


def with_faults(rows: DataFrame, name: str) -> DataFrame:
    """Equal rows counted as ``n``, with class, ``first`` (not seen earlier), blank and truncated."""
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    counted = rows.filter("copies > 0").groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    counted = stage(counted.withColumn("key", key), f"{name}-rows")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = counted.groupBy("conv", "key").agg(F.min(at).alias("_at"), F.count(F.lit(1)).alias("_times"))
    hot = stage(hot_keys(firsts, ["conv", "key"], "_times"), f"{name}-hot")
    marked = salted_join(counted, firsts.drop("_times"), ["conv", "key"], "inner", hot)
    initial = F.substring("role", 1, 1)
    blank = ~F.col("text").rlike(_SEEN)
    return marked.select(
        "conv", "turn", "role", "text", "n",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("class"),
        (F.col("_at") == at).alias("first"),
        blank.alias("blank"),
        (~blank & ~F.col("text").rlike(rf"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )


def pieces(faulty: DataFrame, most: int = PIECE) -> DataFrame:
    """(conv, piece, seq, head, tail, illegal): symbols of a conversation in order, in pieces."""
    symbol = F.when(F.col("blank") | ~F.col("first"), "x").otherwise(
        F.when(F.col("truncated"), F.upper("class")).otherwise(F.col("class"))
    )
    ordered = faulty.select("conv", "turn", "role", "text", "n", "class", symbol.alias("symbol"))
    ordered = ordered.repartitionByRange("conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "piece", "seq", "head", "tail", "illegal"]
        number = TaskContext.get().partitionId() << 32
        conv, seq, size, head, tail, illegal = None, [], 0, "", "", 0
        out: list[tuple] = []

        def cut() -> None:
            nonlocal number, seq, size, illegal
            if size:
                out.append((conv, number, "".join(seq), head, tail, illegal))
                number += 1
            seq, size, illegal = [], 0, 0

        def flush() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in source:
            for at, n, kind, mark in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at != conv:
                    cut()
                    conv = at
                todo = n
                while todo:
                    if size == most:
                        cut()
                    take = min(todo, most - size)
                    if size:
                        illegal += tail + kind not in LEGAL
                    else:
                        head = kind
                    illegal += take - 1  # equal rows have equal roles, and no role may follow itself
                    seq.append((mark if todo == n else "x") + "x" * (take - 1))
                    size += take
                    todo -= take
                    tail = kind
                    if len(out) >= 2_000:
                        yield flush()
        cut()
        if out:
            yield flush()

    schema = "conv string, piece long, seq string, head string, tail string, illegal long"
    return ordered.select("conv", "n", "class", "symbol").mapInArrow(run, schema)


# --- grammar ----------------------------------------------------------------------------------


def _compressed(rules: list[tuple[str, str]]) -> Column:
    out = F.col("seq")
    for symbol, pair in rules:
        out = F.replace(out, F.lit(pair), F.lit(symbol))
    return out


def grammar(sequences: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> list[tuple[str, str]]:
    """Re-Pair rules over the distinct sequences (seq, n); each round takes pairs that share no symbol."""
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        text = F.col("text")
        starts = F.when(F.length(text) > 1, F.sequence(F.lit(1), F.length(text) - 1))
        pair = F.explode(F.transform(starts, lambda i: text.substr(i, F.lit(2)))).alias("pair")
        counts = sequences.select(_compressed(rules).alias("text")).select(pair).groupBy("pair").agg(
            F.count(F.lit(1)).alias("times")
        )
        used: set[str] = set()
        fresh: list[tuple[str, str]] = []
        for row in counts.filter("times > 1").orderBy(F.desc("times"), "pair").collect():
            if len(fresh) < pairs and used.isdisjoint(row.pair):
                fresh.append((chr(_FIRST_RULE + len(rules) + len(fresh)), row.pair))
                used |= set(row.pair)
        rules += fresh
        if not used:
            break
    return rules


_SOLVED = "costs array<long>, audits array<string>"


def solved(sequences: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(seq, costs, audits): the 16 entries of each sequence's matrix, row by row; null where there is no way."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = rule_matrices(rules)
        for batch in source:
            found = [solve(text, matrices) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_flat(found)], ["seq", "costs", "audits"])

    return sequences.select("seq", _compressed(rules).alias("text")).mapInArrow(run, f"seq string, {_SOLVED}")


def _flat(found: list[Matrix]) -> list[pa.Array]:
    entries = [[e for row in matrix for e in row] for matrix in found]
    return [
        pa.array([[e and e[0] for e in m] for m in entries], pa.list_(pa.int64())),
        pa.array([[e and str(e[1]) for e in m] for m in entries], pa.list_(pa.string())),
    ]


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    """Product of the pieces of one group, in order."""
    group = group.sort_values("piece")
    out, tail, illegal = None, None, 0
    for row in group.itertuples():
        entries = [None if a is None else (int(c), a) for c, a in zip(row.costs, row.audits, strict=True)]
        matrix = [entries[p * 4 : p * 4 + 4] for p in range(4)]
        illegal += row.illegal + (tail is not None and tail + row.head not in LEGAL)
        out, tail = matrix if out is None else product(out, matrix), row.tail
    first = group.iloc[0]
    flat = [e for row in out for e in row]
    return pd.DataFrame(
        {
            "conv": [first.conv], "piece": [first.piece], "head": [first["head"]], "tail": [tail], "illegal": [illegal],
            "costs": [[e and e[0] for e in flat]], "audits": [[e and str(e[1]) for e in flat]],
        }
    )


def whole(parts: DataFrame, group: int = GROUP, name: str = "conversations") -> DataFrame:
    """One row per conversation from its pieces; each level multiplies ``group`` neighbours."""
    done = None
    while True:
        light = parts.groupBy("conv").agg(F.count(F.lit(1)).alias("_pieces"))
        several = stage(light.filter("_pieces > 1").select("conv"), f"{name}-several")
        alone = parts.join(several, "conv", "left_anti")
        done = alone if done is None else done.unionByName(alone)
        if several.isEmpty():
            return done
        split = parts.join(several, "conv")
        order = Window.partitionBy("conv").orderBy("piece")
        places = split.select("conv", "piece").withColumn(
            "_group", F.floor((F.row_number().over(order) - 1) / group)
        )
        names = ["conv", "piece", "head", "tail", "illegal", "costs", "audits"]
        schema = f"conv string, piece long, head string, tail string, illegal long, {_SOLVED}"
        grouped = split.join(places, ["conv", "piece"]).groupBy("conv", "_group")
        parts = stage(grouped.applyInPandas(lambda pdf: _joined(pdf[names]), schema), f"{name}-joined")


# --- result -----------------------------------------------------------------------------------


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): each audit applied to the conversation's rows, as a stream."""
    none = F.lit(None)
    orders = audits.select(
        "conv", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        F.col("audit").alias("text"), F.lit(1).cast("long").alias("n"),
    )
    both = orders.unionByName(rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "n"))
    both = both.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "text")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply, out = None, []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, pa.string()) for c in zip(*out, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", "repaired_sha256"])

        for batch in source:
            for conv, kind, role, text, n in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if kind == 0:
                    if apply:
                        out.append(apply.end())
                    apply = Edits(conv, text)
                    if len(out) >= 2_000:
                        yield flush()
                else:
                    for _ in range(n):
                        apply.row(role, text)
        if apply:
            out.append(apply.end())
        if out:
            yield flush()

    return both.select("conv", "kind", "role", "text", "n").mapInArrow(run, "conv string, repaired_sha256 string")


class Edits:
    """Applies an audit to rows given one by one and digests what is left."""

    def __init__(self, conv: str, audit: str):
        self.conv, self.audit, self.at, self.state = conv, audit, 0, 0
        self.sha, self.written = hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.state = _AFTER[role[0]][self.state]
        self.sha.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written = True

    def _due(self) -> str:
        return {"u": "user", "a": "assistant"}[_NEXT[self.state]]

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(self._due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._write(role if edit == "K" else self._due(), text)

    def end(self) -> tuple[str, str]:
        self._insert()
        return self.conv, self.sha.hexdigest()


def repair(rows: DataFrame, piece: int = PIECE, group: int = GROUP, name: str = "conversations") -> DataFrame:
    """One row per conversation of ``rows`` (as :func:`damage` or :func:`undamaged` gives them)."""
    faulty = stage(with_faults(rows, name), f"{name}-faulty")
    n, dead = F.col("n"), F.col("blank")
    stats = faulty.groupBy("conv", "turn").agg(
        F.sum(F.when(dead, n).otherwise(0)).alias("blank"),
        F.sum(F.when(dead, 0).when(F.col("first"), n - 1).otherwise(n)).alias("duplicate"),
        F.sum(F.when(F.col("truncated") & F.col("first"), 1).otherwise(0)).alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    stats = stats.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    cut = stage(pieces(faulty, piece), f"{name}-pieces")
    sequences = stage(cut.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), f"{name}-sequences")
    table = stage(solved(sequences, grammar(sequences)), f"{name}-solved")
    hot = stage(hot_keys(sequences, ["seq"]), f"{name}-common")
    parts = stage(salted_join(cut, table, ["seq"], "inner", hot).drop("seq"), f"{name}-parts")
    one = whole(parts, group, name)
    empty, full = (F.struct(F.col("costs")[q].alias("cost"), F.col("audits")[q].alias("audit")) for q in (0, 3))
    best = F.when(F.col("costs")[3].isNull() | (empty < full), empty).otherwise(full)
    found = one.select("conv", "illegal", best.alias("_best")).select("conv", "illegal", "_best.*")
    found = stage(found, f"{name}-audits")
    ids = rows.groupBy("conv").agg(F.min("conv_id").alias("conv_id"))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        ids.join(stats, "conv", "left")
        .join(found, "conv", "left")
        .join(repaired(faulty, found), "conv", "left")
        .select(
            "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
        )
    )
