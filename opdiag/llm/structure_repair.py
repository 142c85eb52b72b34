"""Cheapest repair of the turn structure of conversations.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``. Its rows are kept (cost
0), given the role user or assistant (2) or deleted (3); turns with an empty text can be inserted
(2). Blank rows and rows whose role and text were seen before must be deleted; a truncated row that
stays costs 1 more. Of the cheapest edit strings (K, R, D, I in order) the ASCII-least one counts.

Every conversation is read once, in order of its turns, by a Viterbi search over the four states
of that pattern. The survivors are leaves of a backpointer tree whose nodes count their references:
a node that no survivor descends from is freed, and edits are emitted as soon as the survivors
share an ancestor. A survivor that another one can catch up with at less cost is given up. What waits in memory are the unresolved suffixes, a few rows as a rule. Survivors
carry their place in the lexicographic order of their complete edit strings; since two survivors
end in the letter of the same row, neither is a prefix of the other, and one that is less now stays
so whatever follows. That compares tied suffixes as a whole without walking over them. Only where no
row can be kept, and two ways are open to the end, the unresolved rows are as many as the rows.

Rows are ordered by ``turn`` (nulls first), then role and text. Null roles and texts count as one
space. Rows with a null ``conv_id`` form a conversation of their own. An empty table gives no rows;
other columns are ignored. All rows of a conversation pass through one task, one after the other,
since its digest is one; they are sorted by Spark, which spills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opdiag.llm.shipping import ship

SPACES = " \t\n\x0b\f\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
USER, ASSISTANT = "user", "assistant"
START, SYSTEM, ASKED, ANSWERED = range(4)  # nothing yet, after s, after u, after a
#: State after a kept initial.
KEPT = {(START, "s"): SYSTEM, (START, "u"): ASKED, (SYSTEM, "u"): ASKED, (ANSWERED, "u"): ASKED,
        (ASKED, "a"): ANSWERED}
#: State after a turn of the role that is due, and that role.
DUE = {START: (ASKED, USER), SYSTEM: (ASKED, USER), ANSWERED: (ASKED, USER),
       ASKED: (ANSWERED, ASSISTANT)}
#: What a survivor in the second state pays at most to follow one in the first, whatever comes:
#: inserted turns, a system turn deleted. A survivor that is dearer by more can win no longer.
BEHIND = {(START, ANSWERED): 3, (START, ASKED): 5, (SYSTEM, START): 0, (SYSTEM, ANSWERED): 0,
          (SYSTEM, ASKED): 2, (ASKED, ANSWERED): 2, (ANSWERED, ASKED): 2}
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)  # a row's first fault
AT_ONCE = 2048

EDITS = ("conv_id bigint, step bigint, edit string, turn bigint, role string, text string, "
         "in_repair boolean")
SUMMARY = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
           "illegal bigint, cost bigint, audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``; a dropped row stays with ``present`` false.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes its role
    user. Nulls count as one space, in the key too.
    """
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    rows = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), shown("role").alias("role"),
        shown("text").alias("text"), kind.alias("kind"),
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    text = (
        F.when(F.col("kind").isin(0, 1), F.lit(""))
        .when(F.col("kind") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
    )
    return rows.withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("kind") != 0).alias("present"),
    )


def _in_order(turns: DataFrame) -> DataFrame:
    """Rows of every conversation together and in order, with their first fault.

    One shuffle by conversation; the window that finds duplicates needs no other.
    """
    if "present" not in turns.columns:
        turns = turns.withColumn("present", F.lit(True))
    rows = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("present"),
    )
    alike = Window.partitionBy("conv_id", "present", "role", "text").orderBy(
        F.col("turn").asc_nulls_first()
    )
    seen = F.row_number().over(alike) > 1
    trimmed = F.rtrim("text", F.lit(SPACES))
    fault = (
        F.when(trimmed == "", BLANK).when(F.col("seen"), DUPLICATE)
        .when(~F.right(trimmed, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(NONE)
    )
    return (
        rows.repartition("conv_id").withColumn("seen", seen)
        # of equal rows that of the first occurrence comes first
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen")
        .select("conv_id", "turn", "role", "text", "present", fault.alias("fault"))
    )


class Node:
    """An edit of the backpointer tree: letters of inserted turns and of one row."""

    __slots__ = ("parent", "letters", "row", "refs")

    def __init__(self, parent: Node | None, letters: str, row):
        self.parent, self.letters, self.row, self.refs = parent, letters, row, 0
        if parent is not None:
            parent.refs += 1


class Survivor:
    """Cheapest way into a state; ``place`` orders the edit strings of all survivors."""

    __slots__ = ("node", "cost", "place")

    def __init__(self, node: Node, cost: int, place: int):
        self.node, self.cost, self.place = node, cost, place


class Search:
    """Viterbi search over one conversation; ``add`` and ``end`` yield resolved edits."""

    def __init__(self):
        self.root = Node(None, "", None)
        self.root.refs = 1
        self.alive = {START: Survivor(self.root, 0, 0)}
        self.state = START  # state at the root
        self.waiting, self.look_at, self.cost = 0, 8, 0

    def add(self, row: tuple) -> Iterator[tuple]:
        """Takes a row (turn, role, text, fault)."""
        _, role, _, fault = row
        initial, best = role[:1], {}

        def offer(state: int, cost: int, place: int, letters: str, base: Node) -> None:
            key = (cost, place, letters)
            if state not in best or key < best[state][:3]:
                best[state] = (*key, base)

        stays = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, survivor in self.alive.items():
            cost, place, base = survivor.cost, survivor.place, survivor.node
            offer(state, cost + COST[DELETE], place, DELETE, base)
            if fault in (BLANK, DUPLICATE):
                continue
            # two inserted turns are of use only before the first question
            for inserted in range(3 if state in (START, SYSTEM) else 2):
                before = cost + COST[INSERT] * inserted + stays
                kept = KEPT.get((state, initial))
                if kept is not None:
                    offer(kept, before, place, INSERT * inserted + KEEP, base)
                state_due, _ = DUE[state]
                offer(state_due, before + COST[REROLE], place, INSERT * inserted + REROLE, base)
                state = state_due
        best = {
            state: way for state, way in best.items()
            if all(way[0] <= other[0] + BEHIND.get((state, at), way[0]) for at, other in best.items())
        }
        ranked = sorted(best, key=lambda state: best[state][1:3])
        old = [survivor.node for survivor in self.alive.values()]
        self.alive = {}
        for place, state in enumerate(ranked):
            cost, _, letters, base = best[state]
            node = Node(base, letters, row)
            node.refs = 1
            self.alive[state] = Survivor(node, cost, place)
        for node in old:
            self._release(node)
        self.waiting += 1
        if self.waiting >= self.look_at:
            yield from self._resolved()
            self.look_at = 2 * self.waiting + 8

    @staticmethod
    def _release(node: Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            node.parent, node = None, node.parent

    def _resolved(self) -> Iterator[tuple]:
        """Edits above the lowest node that all survivors descend from."""
        path, node = [], next(iter(self.alive.values())).node
        while node is not self.root:
            path.append(node)
            node = node.parent
        while path and self.root.refs == 1:
            node = path.pop()
            yield from self._edits(node.letters, node.row)
            node.parent, self.root = None, node
            self.waiting -= 1

    def _edits(self, letters: str, row: tuple | None) -> Iterator[tuple]:
        """Edits as (letter, turn, role, text, whether the repaired conversation has it)."""
        for letter in letters:
            if letter == DELETE:
                yield (DELETE, *row[:3], False)
            elif letter == KEEP:
                self.state = KEPT[self.state, row[1][:1]]
                yield (KEEP, *row[:3], True)
            else:
                self.state, role = DUE[self.state]
                turn, text = (None, "") if letter == INSERT else (row[0], row[2])
                yield (letter, turn, role, text, True)

    def end(self) -> Iterator[tuple]:
        """Chooses the way out; inserted turns may come last."""
        ways = []
        for state, survivor in self.alive.items():
            inserted = {START: 0, SYSTEM: 2, ASKED: 1, ANSWERED: 0}[state]
            ways.append((survivor.cost + COST[INSERT] * inserted, survivor.place, inserted, state))
        self.cost, _, inserted, state = min(ways)
        for other, survivor in self.alive.items():
            if other != state:
                self._release(survivor.node)
        self.alive = {state: self.alive[state]}
        # the chosen leaf is the only way left
        yield from self._resolved()
        yield from self._edits(INSERT * inserted, None)


class Counts:
    """Faults of one conversation, row by row."""

    def __init__(self):
        self.faults, self.illegal, self.distinct = [0, 0, 0, 0], 0, 0
        self.least = self.most = self.before = None

    def add(self, row: tuple) -> None:
        turn, role, _, fault = row
        self.faults[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.distinct = turn, self.distinct + 1

    @property
    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.distinct


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator]]:
    """Conversations of a sorted stream, each with an iterator over its present rows."""
    names = ("conv_id", "turn", "role", "text", "fault", "present")
    flat = (
        row for batch in batches for start in range(0, batch.num_rows, AT_ONCE)
        for row in zip(*(batch.column(name).slice(start, AT_ONCE).to_pylist() for name in names))
    )
    ahead = next(flat, None)

    def rows(conv) -> Iterator[tuple]:
        nonlocal ahead
        while ahead is not None and ahead[0] == conv:
            row, ahead = ahead, next(flat, None)
            if row[5]:
                yield row[1:5]

    while ahead is not None:
        conv = ahead[0]
        own = rows(conv)
        yield conv, own
        for _ in own:  # rows that the caller left
            pass


def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per conversation its id, counts, search and an iterator over its edits."""
    for conv, rows in _conversations(batches):
        counts, search = Counts(), Search()

        def edits(rows=rows, counts=counts, search=search) -> Iterator[tuple]:
            for row in rows:
                counts.add(row)
                yield from search.add(row)
            yield from search.end()

        yield conv, counts, search, edits()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, AT_ONCE)):
        arrays = [pa.array(values, field.type) for values, field in zip(zip(*part), schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(","))])


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (
        (conv, step, *edit)
        for conv, _, _, edits in repairs(batches) for step, edit in enumerate(edits)
    )
    yield from _batches(rows, _schema(EDITS))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for conv, counts, search, edits in repairs(batches):
            letters, digest, first = [], hashlib.sha256(), True
            for letter, _, role, text, stays in edits:
                letters.append(letter)
                if stays:
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            _, blank, duplicate, truncated = counts.faults
            yield (conv, counts.gaps, blank, duplicate, truncated, counts.illegal, search.cost,
                   "".join(letters), digest.hexdigest())

    yield from _batches(rows(), _schema(SUMMARY))


def edits(turns: DataFrame) -> DataFrame:
    """The edits of every conversation in order, with the turns of the repaired conversation.

    ``role`` and ``text`` are those after the edit; ``in_repair`` is false for deleted rows. A
    column ``present``, if there is one, is false for rows that only name a conversation.
    """
    ship(turns.sparkSession)
    return _in_order(turns).mapInArrow(_edit_rows, EDITS)


def summaries(turns: DataFrame) -> DataFrame:
    """Per conversation its faults, the cost and letters of its edits, and the repair's digest."""
    ship(turns.sparkSession)
    return _in_order(turns).mapInArrow(_summaries, SUMMARY)
