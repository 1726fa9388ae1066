"""Repair of conversations' structure: the cheapest edits, computed once per shared ending.

A conversation's rows become a signature, one letter a row for its role and fault. What the best edits from a
row on are depends on the ending of the signature and on the state of the grammar ``(s?(ua)+)?`` only. So the
different signatures of all conversations, read from the end, form an automaton in which equal endings
are one node; every node has, for each of the four states, its cost-to-go and the first letter of the
best audit, computed once from the node behind it. Signatures are sorted by ranges, so that a task walks its part
of the automaton in order with the nodes from the end to the current row on a stack. As different edits
have different letters, and a letter and a state lead to one state, the least audit among equally cheap ones
follows letter by letter.

States: nothing yet (0), after s (1), after u (2), after a (3); the end is allowed in 0 and 3.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from listlake.llm.common import saved
from listlake.operators.joins import left_join_unique

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
#: The state after an inserted or reroled row, and its role.
NEXT = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: The state after a kept row by its initial, in each state; -1: not allowed.
KEEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1), "o": (-1, -1, -1, -1)}
LEGAL = frozenset(("su", "ua", "au"))
D, I, K, R = b"DIKR"  # noqa: E741


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, present``: rows damaged by crc32 of ``conv:turn`` modulo 20.

    0 drops the row (``present`` is then false), 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats
    it, 4 makes it the user's. A NULL counts as one space, but a conversation's and a turn's stay NULL in the result.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat_ws(":", shown(conv), shown(turn)).cast("binary")) % 20
    said = F.when(case == 1, "").when(case == 2, F.regexp_replace(shown(text), "[.!?]", "")).otherwise(shown(text))
    copies = F.sequence(F.lit(1), F.when(case == 3, 2).otherwise(1))
    return rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.when(case == 4, "user").otherwise(shown(role)).alias("role"),
        said.alias("text"), (case != 0).alias("present"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """``conv, turn, present, initial, fault`` in order; all rows of a conversation lie in one partition.

    A row is a duplicate if its role and text came before; that is a running number in the partition that the
    rows are in anyway, so texts need not be kept in memory.
    """
    rows = rows.repartition("conv")
    again = F.row_number().over(W.partitionBy("conv", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    said = F.rtrim("text", F.lit(SPACE))
    fault = F.when(said == "", "b").when(F.col("again"), "d").when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "t").otherwise("")
    rows = rows.withColumn("again", again).select("*", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    return rows.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "again").select("conv", "turn", "present", "initial", "fault")


def _signatures(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row a conversation: counts, and its signature from the last row to the first."""
    names = ["conv", "ending", "gaps", "blank", "duplicate", "truncated", "illegal"]
    kinds = [kind, pa.string(), *[pa.int64()] * 5]
    done: list[tuple] = []
    conv, open_ = None, False
    letters, turns, counts, illegal, before, low, high = bytearray(), 0, {}, 0, None, None, None

    def finish() -> None:
        gaps = high - low + 1 - turns if turns else 0
        done.append((conv, letters[::-1].decode(), gaps, *(counts.get(f, 0) for f in "bdt"), illegal))

    for batch in batches:
        for c, turn, present, initial, fault in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if not open_ or c != conv:
                if open_:
                    finish()
                conv, open_ = c, True
                letters, turns, counts, illegal, before, low, high = bytearray(), 0, {}, 0, None, None, None
            if not present:
                continue
            if turn is not None and turn != high:
                low, high, turns = turn if low is None else low, turn, turns + 1
            if before is not None and before + initial not in LEGAL:
                illegal += 1
            before = initial
            if fault:
                counts[fault] = counts.get(fault, 0) + 1
            letter = initial if initial in ("s", "u", "a") else "o"
            letters += (b"x" if fault in ("b", "d") else (letter.upper() if fault else letter).encode())
        if len(done) > 5000:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
            done = []
    if open_:
        finish()
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names)


class Automaton:
    """The nodes from the end of a signature to its current row: four costs and four letters each."""

    def __init__(self) -> None:
        self.ending = ""
        # The end itself: in states 1 and 2 the missing rows are inserted.
        self.costs = array("q", (0, 2 * INSERT, INSERT, 0))
        self.moves = bytearray((0, I, I, 0))
        self.nodes = 0

    def _push(self, letter: str) -> None:
        behind = self.costs[-4:]
        best = [(DELETE + behind[q], D) for q in range(4)]
        if letter != "x":
            extra = TRUNCATED if letter.isupper() else 0
            keep = KEEP[letter.lower()]
            for q in range(4):
                if keep[q] >= 0:
                    best[q] = min(best[q], (extra + behind[keep[q]], K))
                best[q] = min(best[q], (REROLE + extra + behind[NEXT[q]], R))
        after_u = min(best[2], (INSERT + best[3][0], I))
        after_a = min(best[3], (INSERT + best[2][0], I))
        best = [*(min(b, (INSERT + after_u[0], I)) for b in best[:2]), after_u, after_a]
        self.costs.extend(c for c, _ in best)
        self.moves.extend(m for _, m in best)
        self.nodes += 1

    def read(self, ending: str) -> tuple[int, str]:
        """Cost and audit of the signature that is ``ending`` from its last row to its first."""
        shared, most = 0, min(len(ending), len(self.ending))
        while shared < most and ending[shared] == self.ending[shared]:
            shared += 1
        del self.costs[4 * (shared + 1) :], self.moves[4 * (shared + 1) :]
        for letter in ending[shared:]:
            self._push(letter)
        self.ending = ending
        audit, at, q = bytearray(), len(ending), 0
        while move := self.moves[4 * at + q]:
            audit.append(move)
            if move == I:
                q = NEXT[q]
                continue
            at -= 1
            if move != D:
                q = NEXT[q] if move == R else KEEP[ending[at].lower()][q]
        return self.costs[-4], audit.decode()


def audits(endings: DataFrame) -> DataFrame:
    """``ending, cost, audit`` for every different ending."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            found = [automaton.read(x) for x in batch.column("ending").to_pylist()]
            costs, texts = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("ending"), pa.array(costs, pa.int64()), pa.array(texts, pa.string())], ["ending", "cost", "audit"])

    ordered = endings.select("ending").distinct().repartitionByRange("ending").sortWithinPartitions("ending")
    return ordered.mapInArrow(work, "ending string, cost long, audit string")


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _apply(batches: Iterator[pa.RecordBatch], texts: bool, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Follows each conversation's audit over its rows, the audit's row coming first.

    ``texts`` gives the repaired rows; otherwise one row a conversation with the hash of its rows, which is
    carried along, so that nothing is kept but the audit.
    """
    audit, at, q, digest, first, head, size = "", 0, 0, None, True, None, 0
    out: list = []

    def say(role: str, text: str) -> None:
        nonlocal first, size
        if texts:
            out.append((head.column("conv")[0].as_py(), size, role, text))
        else:
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        first, size = False, size + 1

    def insert() -> None:
        nonlocal at, q
        while at < len(audit) and audit[at] == "I":
            at, q = at + 1, NEXT[q]
            say(ROLES[q], "")

    def finish() -> None:
        insert()
        if not texts:
            out.append((head, digest.hexdigest()))

    def table() -> pa.RecordBatch:
        if texts:
            convs, places, roles, said = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(places, pa.int64()), pa.array(roles), pa.array(said)], ["conv", "place", "role", "text"])
        heads = pa.Table.from_batches([h for h, _ in out]).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*heads.columns, pa.array([d for _, d in out])], ["conv", *RESULT, "repaired_sha256"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("audit", "role", "text"))
        for i, (plan, role, text) in enumerate(zip(*columns, strict=True)):
            if plan is not None:  # the conversation's own row
                if head is not None:
                    finish()
                head = batch.slice(i, 1).select(["conv", *RESULT])
                audit, at, q, digest, first, size = plan, 0, 0, hashlib.sha256(), True, 0
                continue
            insert()
            move, at = audit[at], at + 1
            if move == "D":
                continue
            q = NEXT[q] if move == "R" else KEEP[role[:1]][q]
            say(ROLES[q] if move == "R" else role, text)
        if len(out) > 5000:
            yield table()
            out = []
    if head is not None:
        finish()
    if out:
        yield table()


def _planned(rows: DataFrame) -> DataFrame:
    """Rows of each conversation behind a row with its counts, cost and audit; in order, in one partition."""
    found = _faults(rows)
    kind = rows.schema["conv"].dataType
    counted = ", ".join(f"{c} long" for c in RESULT[:-2])
    summary = saved(found.mapInArrow(lambda b: _signatures(b, to_arrow_type(kind)), f"conv {kind.simpleString()}, ending string, {counted}"), "signatures")
    planned = left_join_unique(summary, saved(audits(summary), "audits"), "ending").drop("ending")
    both = rows.filter("present").drop("present").unionByName(planned, allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "text")


def repair(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``<conv>, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` per conversation.

    ``rows`` holds ``conv, turn, role, text, present`` without NULL roles and texts, as :func:`damage` gives
    them; rows that are not ``present`` only name their conversation. Rows count in the order of turn (NULL
    first), role and text. A row is blank without a character other than space, else a duplicate if its role and
    text came before, else truncated unless it ends in ``.``, ``!`` or ``?``. ``gaps`` counts turns missing between
    the least and the greatest, ``illegal`` neighbours whose initials are not su, ua or au. ``audit`` has a letter
    per edit: Keep, Rerole (cost 1), Delete (2), Insert (5); a truncated row that stays costs 5 more; of
    the cheapest ones it is the least. ``repaired_sha256`` is that of the repaired ``role:text``, joined by
    newlines. A conversation without rows has zeros, an empty audit and the hash of nothing. Rows without a
    conversation are one. No row at all gives no row.

    A conversation's audit is one string and its hash is running, so that its rows pass through one task in
    order; the task keeps the audit and a row.
    """
    kind = rows.schema["conv"].dataType
    fields = f"conv {kind.simpleString()}, " + ", ".join(f"{c} long" for c in RESULT[:-1]) + ", audit string, repaired_sha256 string"
    return _planned(rows).mapInArrow(lambda b: _apply(b, False, to_arrow_type(kind)), fields).withColumnRenamed("conv", conv)


def repaired_rows(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``<conv>, place, role, text``: the rows after the edits of :func:`repair`, numbered from 0."""
    kind = rows.schema["conv"].dataType
    fields = f"conv {kind.simpleString()}, place long, role string, text string"
    return _planned(rows).mapInArrow(lambda b: _apply(b, True, to_arrow_type(kind)), fields).withColumnRenamed("conv", conv)
