"""Cheapest repair of conversations to the order of turns ``(s?(ua)+)?``, with block tables by the Four Russians' method.

A conversation is a string of symbols, one per row: its role (system, user, assistant, other) and its fault.  The cost
of repairing what follows a row depends only on how far the pattern has got (nothing yet, system, user, assistant), so
it is a vector of four numbers.  Less its smallest entry such a vector is one of a few dozen, since insertions lead from
one state to the next at a bounded price.  For each of them and each block of so many symbols, a table built once says
which vector stands before the block and what it has cost.  A conversation is looked up block by block from its end,
keeping the vector at block borders only; the tracing goes forward, expands one block backward at a time, and takes
the edit with the smallest letter among those of least cost, which settles ties for good.

Spark does the rest: damage and faults are DataFrame functions, positions come from ranges (``positions.positioned``),
earlier copies from an aggregate, and symbols travel as one byte per row, in chunks of bounded size.  The digest of
the repaired text needs its rows in order: they stream by, after a row that carries the conversation's edits, in a
task that keeps one batch.  A conversation's symbols, edits and digest are in one task, since each is one value of the
result; texts are never gathered.

Defined results: NULLs in any column count as one space, for the order too where not said otherwise; rows without a turn
come first; rows of one turn stand by role, then text.  A conversation of which no row is left has zeros, no edits and
the digest of nothing.  NULL is a conversation.  Repeated rows are duplicates.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.positions import positioned
from ordermill.session import materialize

# Costs of edits and of leaving a row truncated; their letters sort as ties are broken.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: The pattern's states: nothing yet, system, user, assistant.  An insertion or a new role leads to:
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
#: Where a kept row of a role leads from each state, if it may stand there.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
AT_END = (0, 2 * INSERT, INSERT, 0)
ROLES, FAULTS = "suao", ("none", "blank", "duplicate", "truncated")
#: A row's code: 4 * role + fault, as a letter from this one on.
FIRST_CODE = ord("A")
#: What matters for costs: rows to be deleted, else the role, whole or truncated.
SYMBOLS = ["x", *itertools.product(ROLES, (False, True))]
BLOCK = 4
CHUNK_ROWS = 65_536
SPACE = r"\x20\x09-\x0D"


def _options(symbol, after: tuple[int, ...], before: list[int] | None, state: int) -> list[tuple[str, int, int, bool]]:
    """(letter, cost to the end, state after, row used) of the edits at a row, in the order of their letters."""
    found = [("D", DELETE + after[state], state, True)]
    if before is not None:
        found.append(("I", INSERT + before[NEXT[state]], NEXT[state], False))
    if symbol != "x":
        role, cut = symbol
        more = TRUNCATED if cut else 0
        if state in KEPT[role]:
            found.append(("K", more + after[KEPT[role][state]], KEPT[role][state], True))
        found.append(("R", REROLE + more + after[NEXT[state]], NEXT[state], True))
    return found


def cost_before(symbol, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs to the end from each state before a row, given those after it."""
    costs = [min(o[1] for o in _options(symbol, after, None, p)) for p in range(4)]
    for _ in range(2):  # an insertion leads from user to assistant and back; two in a row never pay twice
        costs = [min(c, INSERT + costs[NEXT[p]]) for p, c in enumerate(costs)]
    return tuple(costs)


class BlockTables:
    """All normalised cost vectors, and for each with each block of ``BLOCK`` symbols the vector before it and its cost."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = [AT_END]
        self.number = {AT_END: 0}
        one, cost = [], []
        for vector in self.vectors:  # grows as new vectors appear
            one.append([])
            cost.append([])
            for symbol in SYMBOLS:
                costs = cost_before(symbol, vector)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in self.number:
                    self.number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                one[-1].append(self.number[normal])
                cost[-1].append(least)
        self.one, self.one_cost = np.array(one), np.array(cost)
        # A block's symbols are the digits of its number, the first the most significant.
        blocks, price = np.arange(len(self.vectors))[:, None], np.zeros((len(self.vectors), 1), np.int64)
        for _ in range(BLOCK):
            # One more symbol in front of the blocks made so far.
            price = np.concatenate([price + self.one_cost[blocks, s] for s in range(len(SYMBOLS))], 1)
            blocks = np.concatenate([self.one[blocks, s] for s in range(len(SYMBOLS))], 1)
        self.block, self.block_cost = blocks, price

    def costs(self, symbols: np.ndarray) -> tuple[list[int], int, int]:
        """Vectors at the borders of blocks (from the start), the vector at the start, and the whole least cost there.

        The first symbols, if they fill no block, come one by one.
        """
        short = len(symbols) % BLOCK
        digits = symbols[short:].reshape(-1, BLOCK)
        numbers = digits @ (len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1))
        at, total, borders = 0, 0, [0]
        for number in numbers[::-1].tolist():
            total += int(self.block_cost[at, number])
            at = int(self.block[at, number])
            borders.append(at)
        borders.reverse()
        for symbol in symbols[:short][::-1].tolist():
            total += int(self.one_cost[at, symbol])
            at = int(self.one[at, symbol])
        return borders, at, total

    def repair(self, symbols: np.ndarray) -> tuple[int, str]:
        """Least cost and the edits' letters."""
        borders, at, total = self.costs(symbols)
        short, state, letters = len(symbols) % BLOCK, START, []
        pieces = ([symbols[:short]] if short else []) + list(symbols[short:].reshape(-1, BLOCK))
        ends = borders if short else borders[1:]
        for piece, end in zip(pieces, ends, strict=True):
            inside = [end]
            for symbol in piece[::-1].tolist():  # the block again, row by row, from its end
                inside.append(int(self.one[inside[-1], symbol]))
            inside.reverse()
            for i, symbol in enumerate(piece.tolist()):
                after, shift = self.vectors[inside[i + 1]], int(self.one_cost[inside[i + 1], symbol])
                before = [c + shift for c in self.vectors[inside[i]]]
                used = False
                while not used:
                    letter, _, state, used = next(
                        o for o in _options(SYMBOLS[symbol], after, before, state) if o[1] == before[state])
                    letters.append(letter)
        while AT_END[state]:
            letters.append("I")
            state = NEXT[state]
        return total + self.vectors[at][START], "".join(letters)


@lru_cache(maxsize=1)
def tables() -> BlockTables:
    return BlockTables()


#: Symbol of each code.
SYMBOL_OF = np.array([
    0 if fault in ("blank", "duplicate") else 1 + 2 * role + (fault == "truncated")
    for role in range(len(ROLES)) for fault in FAULTS])


def judged(codes: str) -> tuple[int, int, int, int, int, str]:
    """blank, duplicate, truncated, illegal, cost and audit of one conversation's codes."""
    rows = np.frombuffer(codes.encode("ascii"), np.uint8).astype(np.int64) - FIRST_CODE
    faults = np.bincount(rows % 4, minlength=4)
    role = rows // 4
    pair = role[:-1] * 4 + role[1:]
    legal = [ROLES.index(a) * 4 + ROLES.index(b) for a, b in ("su", "ua", "au")]
    illegal = len(pair) - int(np.isin(pair, legal).sum())
    cost, audit = tables().repair(SYMBOL_OF[rows])
    return int(faults[1]), int(faults[2]), int(faults[3]), illegal, cost, audit


JUDGED = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [judged(codes) for codes in batch["codes"].to_pylist()]
        columns = list(zip(*found, strict=True)) if found else [[]] * 6
        kinds = [pa.int64()] * 5 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch["conv"], batch["low"], batch["high"], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            ["conv", "low", "high", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


class Repaired:
    """Digest of a repaired conversation, row by row as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.rows = audit, 0, START, 0
        self.hash = hashlib.sha256()

    def _add(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.rows else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.rows += 1

    def _insert(self) -> None:
        while self.audit[self.at: self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            self._add("user" if self.state == USER else "assistant", "")

    def row(self, role: str, text: str) -> None:
        self._insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = NEXT[self.state]
            self._add("user" if self.state == USER else "assistant", text)
        elif letter == "K":
            self.state = KEPT[role[:1]][self.state]
            self._add(role, text)

    def hexdigest(self) -> str:
        self._insert()
        return self.hash.hexdigest()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by conversation and position; the one at -1 carries the edits."""
    schema = pa.schema([("conv", pa.int64()), ("repaired_sha256", pa.string())])
    current: tuple[int | None, Repaired] | None = None

    def emitted(done: list[tuple[int | None, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], schema=schema)

    for batch in batches:
        done = []
        for conv, pos, role, text in zip(*[batch[c].to_pylist() for c in ("conv", "pos", "role", "text")], strict=True):
            if pos < 0:
                if current:
                    done.append((current[0], current[1].hexdigest()))
                current = conv, Repaired(text)
            else:
                current[1].row(role, text)
        if done:
            yield emitted(done)
    if current:
        yield emitted([(current[0], current[1].hexdigest())])


def or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) with faults planted by a checksum of conversation and turn."""
    what = F.crc32(F.concat(or_space("conv"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    marked = rows.select("conv", "turn", or_space("role").alias("role"), or_space("text").alias("text"), what.alias("what"))
    text = F.when(F.col("what") == 1, "").when(
        F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return marked.filter("what <> 0").select(
        "conv", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        copies).drop("copy")


def repair(conversations: DataFrame, damage=damaged, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of the table: gaps, faults, illegal pairs, cost, audit and digest of its repaired rows.

    ``damage`` is applied to (conv, turn, role, text) first; without (None) NULLs become one space.
    """
    rows = conversations.select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    everyone = rows.select("conv").distinct()
    rows = damage(rows) if damage else rows.select("conv", "turn", or_space("role").alias("role"), or_space("text").alias("text"))
    # A text's beginning and hash stand for it in the order, so that long texts don't become range limits.
    order = ["turn", "role", F.substring("text", 1, 64), F.xxhash64("text")]
    placed = positioned(rows, ["conv"], order, "pos", "turn-rows")

    same = ["conv", "role", "text_1", "text_2"]
    lines = placed.select(
        "conv", "turn", "pos", "role", F.xxhash64("text").alias("text_1"), F.xxhash64(F.lit(1), "text").alias("text_2"),
        F.col("text").rlike(f"[^{SPACE}]").alias("words"),
        F.col("text").rlike(rf"[.!?][{SPACE}]*\z").alias("ended"))
    first = lines.groupBy(*same).agg(F.min("pos").alias("first")).select(*[F.col(c).alias(f"__{c}") for c in same], "first")
    matched = F.col("conv").eqNullSafe(F.col("__conv"))
    for c in same[1:]:
        matched &= F.col(c) == F.col(f"__{c}")
    fault = F.when(~F.col("words"), 1).when(F.col("pos") > F.col("first"), 2).when(~F.col("ended"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    coded = lines.join(first, matched).select(
        "conv", "turn", "pos", F.char(FIRST_CODE + 4 * role + fault).alias("code"))

    def text_of(parts: str, value: str) -> Column:
        return F.array_join(F.transform(F.array_sort(parts), lambda p: p[value]), "")

    chunks = coded.groupBy("conv", F.expr(f"pos div {CHUNK_ROWS}").alias("chunk")).agg(
        F.collect_list(F.struct("pos", "code")).alias("parts"),
        F.min("turn").alias("low"), F.max("turn").alias("high"))
    codes = chunks.select("conv", "chunk", text_of("parts", "code").alias("codes"), "low", "high").groupBy("conv").agg(
        F.collect_list(F.struct("chunk", "codes")).alias("parts"), F.min("low").alias("low"), F.max("high").alias("high"))
    turns = rows.filter("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.count("*").alias("turns"))
    verdicts = materialize(codes.select("conv", "low", "high", text_of("parts", "codes").alias("codes")).mapInArrow(
        _judge, f"conv bigint, low bigint, high bigint, {JUDGED}"), "turn-verdicts")

    audits = verdicts.select("conv", F.lit(-1).cast("bigint").alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text"))
    stream = audits.unionByName(placed.select("conv", "pos", "role", "text"))
    digests = stream.repartition("conv").sortWithinPartitions("conv", "pos").mapInArrow(
        _digest, "conv bigint, repaired_sha256 string")

    result = everyone.select(F.col("conv").alias("id"))
    for part in (turns, verdicts, digests):
        named = part.withColumnRenamed("conv", "__conv")
        result = result.join(named, F.col("id").eqNullSafe(F.col("__conv")), "left").drop("__conv")
    zero = F.lit(0).cast("bigint")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), zero)
    return result.select(
        F.col("id").alias(conv_col), gaps.alias("gaps"),
        *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
