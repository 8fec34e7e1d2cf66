"""Repair of conversations: the cheapest edits that make roles alternate, by a Viterbi search that forgets early.

What is wrong with a row is told by Spark's own functions: copies are counted and
first turns found before any conversation is brought together. Then the rows of a
conversation pass through one task in order, as a stream that holds none of them
for long. The search has four states (what the conversation kept so far ends
with) and keeps the best edits into each. Their last edits form a tree of
backpointers with reference counts; what all of them begin with is decided, is
told at once and is forgotten, together with its rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import sliced
from tallyloom.operators.skew import shuffled_for_join

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: A truncated row that is not deleted costs this more.
TRUNCATED_COST = 3
BLANKS = "\t\n\x0b\x0c\r "
EDITS = "conv_id long, number long, edit string, turn long, role string, text string, fault string, illegal boolean"

# States: nothing kept so far, a system row, a user row, an assistant row.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state after a user or assistant row put in each state: the other one's turn.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
#: (loser, winner, cost): whatever follows the loser's state, edits of at most so much more do the same from the winner's.
_DOMINATED = (
    (_NOTHING, _ASSISTANT, 4), (_SYSTEM, _ASSISTANT, 0), (_SYSTEM, _NOTHING, 0), (_ASSISTANT, _NOTHING, 0),
    (_USER, _ASSISTANT, 3), (_ASSISTANT, _USER, 3), (_NOTHING, _USER, 7), (_SYSTEM, _USER, 3), (_USER, _NOTHING, 3),
)


class _Node:
    """An edit, and the edits before it. ``uses`` counts the edits after it and the survivors that end with it."""

    __slots__ = ("before", "depth", "edit", "next", "state", "uses")

    def __init__(self, before: "_Node | None", edit: str, state: int) -> None:
        self.before, self.edit, self.state, self.uses = before, edit, state, 0
        self.depth = before.depth + 1 if before else 0
        if before:
            before.uses += 1
            before.next = self


def _release(node: _Node | None) -> None:
    """One use less; edits that nothing uses any more go."""
    while node is not None:
        node.uses -= 1
        if node.uses:
            return
        node = node.before


def _less(a: _Node, last_a: str, b: _Node, last_b: str) -> bool:
    """Whether the edits up to ``a`` and then ``last_a`` come before those of b, as texts; back to where both agree."""
    told_a, told_b = [last_a] if last_a else [], [last_b] if last_b else []
    while a is not b:
        if a.depth >= b.depth:
            told_a.append(a.edit)
            a = a.before
        else:
            told_b.append(b.edit)
            b = b.before
    return told_a[::-1] < told_b[::-1]


class Search:
    """The cheapest edits of a row of roles and faults, told as soon as they are certain.

    ``step`` takes a row's initial and faults, ``end`` closes the conversation; both return the
    edits decided since, as (edit, state after it). Of equally cheap edits those
    whose letters come first win.
    """

    def __init__(self) -> None:
        self.root = _Node(None, "", _NOTHING)
        self.root.uses = 1
        self.best: list[tuple[int, _Node] | None] = [(0, self.root), None, None, None]
        self._inserts()

    def _offer(self, into: list, state: int, cost: int, node: _Node, edit: str) -> None:
        old = into[state]
        if old is None or cost < old[0] or (cost == old[0] and _less(node, edit, old[1], old[2])):
            into[state] = (cost, node, edit)

    def _put(self, found: list) -> None:
        """New survivors for old; the old ones' edits that none of them needs go."""
        held = [f and (f[0], _Node(f[1], f[2], s) if f[2] else f[1]) for s, f in enumerate(found)]
        for h in held:
            if h:
                h[1].uses += 1
        for b in self.best:
            if b:
                _release(b[1])
        self.best = held

    def _inserts(self) -> None:
        """Rows put in where they make a state cheaper to reach (two at most: a third would only come round)."""
        for targets in ((_USER,), (_ASSISTANT,)):
            found = [b and (*b, "") for b in self.best]
            for state, b in enumerate(self.best):
                if b and _NEXT[state] in targets:
                    self._offer(found, _NEXT[state], b[0] + COST[INSERT], b[1], INSERT)
            self._put(found)
        costs = [b and b[0] for b in self.best]
        lost = {p for p, q, more in _DOMINATED if costs[p] is not None and costs[q] is not None and costs[p] > costs[q] + more}
        self._put([b and (*b, "") if s not in lost else None for s, b in enumerate(self.best)])

    def _decided(self) -> list[tuple[str, int]]:
        told = []
        while self.root.uses == 1 and not any(b and b[1] is self.root for b in self.best):
            # The only use is one edit: the last made, or an older one whose rivals are gone.
            node = self.root.next
            if node.before is not self.root or not node.uses:
                node = next(b[1] for b in self.best if b)
                while node.before is not self.root:
                    node = node.before
            told.append((node.edit, node.state))
            self.root, node.before = node, None
        return told

    def step(self, initial: str, must_go: bool, truncated: bool) -> list[tuple[str, int]]:
        found: list = [None] * 4
        more = TRUNCATED_COST if truncated else 0
        for state, b in enumerate(self.best):
            if b is None:
                continue
            self._offer(found, state, b[0] + COST[DELETE], b[1], DELETE)
            if must_go:
                continue
            after = _NEXT[state]
            if state == _NOTHING and initial == "s":
                self._offer(found, _SYSTEM, b[0] + more, b[1], KEEP)
            if initial == _ROLES[after][0]:
                self._offer(found, after, b[0] + more, b[1], KEEP)
            else:
                self._offer(found, after, b[0] + COST[REROLE] + more, b[1], REROLE)
        self._put(found)
        self._inserts()
        return self._decided()

    def end(self) -> tuple[int, list[tuple[str, int]]]:
        """The cost, and the edits that were not certain before."""
        found: list = [None]
        for state in (_NOTHING, _ASSISTANT):
            if self.best[state]:
                self._offer(found, 0, *self.best[state], "")
        cost, node = found[0][:2]
        told = []
        while node is not self.root:
            told.append((node.edit, node.state))
            node = node.before
        return cost, told[::-1]


# -- on Spark ---------------------------------------------------------------


def faults(rows: DataFrame) -> DataFrame:
    """Distinct (conv_id, turn, role, text) with ``copies``, ``seen`` (an earlier turn has the same role and text), ``blank`` and ``cut`` (truncated).

    A crowd of equal rows is one row after the first, partial, count. First turns
    come from an aggregate on digests; only what occurs at several turns is joined
    back, by a join that Spark can split at a hot key.
    """
    counted = rows.select("conv_id", "turn", "role", "text").groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    counted = counted.withColumn("digest", digest)
    # Null turns come first: a struct with a null is less than one with a number.
    turns = counted.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")
    )
    again = shuffled_for_join(turns.where("turns > 1").select("c", "d", "first"))
    marked = counted.join(again, counted["conv_id"].eqNullSafe(again["c"]) & (counted["digest"] == again["d"]), "left")
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    return marked.select(
        "conv_id", "turn", "role", "text", "copies",
        (F.col("d").isNotNull() & ~F.col("first").eqNullSafe(F.struct("turn"))).alias("seen"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    )


class _Conversation:
    """Rows in order into edits; rows wait here until the search has decided on them."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.search, self.number, self.last = conv_id, Search(), 0, None
        self.waiting: deque[tuple] = deque()

    def _tell(self, decided: list[tuple[str, int]]) -> Iterator[tuple]:
        for edit, state in decided:
            if edit == INSERT:
                row = (None, _ROLES[state], "", None, None)
            else:
                turn, role, text, fault, illegal = self.waiting.popleft()
                row = (turn, _ROLES[state] if edit == REROLE else role, text, fault, illegal)
            yield (self.conv_id, self.number, edit, *row)
            self.number += 1

    def take(self, turn: int | None, role: str, text: str, copies: int, seen: bool, blank: bool, cut: bool) -> Iterator[tuple]:
        for copy in range(copies):
            fault = "blank" if blank else "duplicate" if seen or copy else "truncated" if cut else None
            illegal = self.last is not None and self.last + role[:1] not in ("su", "ua", "au")
            self.last = role[:1]
            must_go = fault in ("blank", "duplicate")
            self.waiting.append((turn, role, None if must_go else text, fault, illegal))
            yield from self._tell(self.search.step(role[:1], must_go, fault == "truncated"))

    def close(self) -> Iterator[tuple]:
        yield from self._tell(self.search.end()[1])


_ROWS = 512


def repair(rows: DataFrame) -> DataFrame:
    """Edits of all conversations, as ``EDITS`` has it: one row per edit, in order.

    ``rows`` have conv_id, turn (integers), role and text. The edits of a
    conversation lie together and by ``number`` in one partition. ``turn`` and
    ``fault`` are those of the source row; ``role`` and ``text`` are as repaired,
    and a row that had to be deleted (blank, duplicate) has no text. ``illegal``
    says that the source row's role may not follow the one before it. The
    repaired conversation is what is not deleted.

    * A null role or text counts as one blank; null turns come first, and a null
      conv_id is a conversation of its own. Rows of equal turn go by role and text.
    * Repeated rows are duplicates of the first; a conversation of one row is
      treated like any other. An empty table gives no rows.
    * A task holds the rows that are not decided yet: two or three, as a rule, and
      in the worst case those since a run of rows that have to go began.
    * Other columns are not looked at.
    """
    known = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    streams = faults(known).repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in EDITS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        told: list[tuple] = []
        now: _Conversation | None = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in sliced(batches):
            for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    told.extend(now.close() if now else ())
                    now = _Conversation(conv_id)
                for edit in now.take(*row):
                    told.append(edit)
                    if len(told) >= _ROWS:
                        yield batch_of(told)
                        told = []
        told.extend(now.close() if now else ())
        if told:
            yield batch_of(told)

    return streams.mapInArrow(run, EDITS)


DIGESTS = (
    "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def digests(edits: DataFrame) -> DataFrame:
    """One row ``DIGESTS`` per conversation, from edits that lie as ``repair`` returns them.

    ``cost`` is that of the edits, ``audit`` their letters, and ``repaired_sha256`` that of the lines ``role:text`` left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        types = [*[pa.int64()] * 6, pa.string(), pa.string()]
        told: list[tuple] = []
        now: list | None = None  # conv_id, counts, cost, letters, hash, whether a line was hashed

        def close() -> None:
            if now:
                conv_id, counts, cost, letters, digest, _ = now
                told.append((conv_id, *counts.values(), cost, "".join(letters), digest.hexdigest()))

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*told), types)], names)

        for batch in sliced(batches):
            for conv_id, _, edit, _, role, text, fault, illegal in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv_id:
                    close()
                    now = [conv_id, {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}, 0, [], hashlib.sha256(), False]
                if fault:
                    now[1][fault] += 1
                now[1]["illegal"] += bool(illegal)
                now[2] += COST[edit] + (TRUNCATED_COST if fault == "truncated" and edit != DELETE else 0)
                now[3].append(edit)
                if edit != DELETE:
                    now[4].update(f"{chr(10) if now[5] else ''}{role}:{text}".encode())
                    now[5] = True
            if told:
                yield batch_of()
                told = []
        close()
        if told:
            yield batch_of()

    return edits.mapInArrow(run, DIGESTS)


def gaps(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps): turns missing between the least and the greatest of each conversation; null turns don't count."""
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn")).distinct()
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))
