"""Chat formatting: the cheapest repair of a conversation's roles, then its text in message markup."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import shared_folder

ROLES = ("system", "user", "assistant")
#: States of the automaton: before the first message, and the role of the message that is open.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# Legal next messages: a system message only first, users and assistants in turn.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# What a repair costs; a legal turn that stays as it is costs nothing.
MERGE, INSERT, RELABEL = 1, 2, 3
FAR = 1 << 30

OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"


@dataclass(frozen=True)
class Choice:
    """One way to take a turn in a state."""

    cost: int
    state: int
    action: str
    inserted: tuple[int, ...] = field(default=())


def _paths() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest run of messages that leads from one state to another."""
    paths = {(state, state): () for state in range(STATES)}
    for _ in range(STATES):
        for (start, end), path in list(paths.items()):
            for after in LEGAL[end]:
                if (start, after) not in paths or len(path) + 1 < len(paths[start, after]):
                    paths[start, after] = (*path, after)
    return paths


PATHS = _paths()


def _choices(role: int | None, state: int) -> list[Choice]:
    """All ways to take a turn of ``role`` (None: an unknown one), the preferred first among equal costs."""
    found = []
    for (start, before), path in PATHS.items():
        if start != state:
            continue
        for after in LEGAL[before]:
            kept = after == role
            cost = INSERT * len(path) + (0 if kept else RELABEL)
            found.append(Choice(cost, after, "keep" if kept else "relabel", path))
    if state != START:
        same = state == role
        found.append(Choice(MERGE + (0 if same else RELABEL), state, "merge" if same else "relabel_merge"))
    order = ("keep", "merge", "relabel", "relabel_merge")
    return sorted(found, key=lambda c: (c.cost, order.index(c.action), len(c.inserted), c.state))


CHOICES = {role: [_choices(role, state) for state in range(STATES)] for role in (None, SYSTEM, USER, ASSISTANT)}
#: The cheapest cost from state to state of one turn.
STEP = {
    role: np.array([[min([c.cost for c in ways if c.state == to], default=FAR) for to in range(STATES)] for ways in by_state])
    for role, by_state in CHOICES.items()
}
#: The end is legal after an assistant's message; empty messages lead there.
END = [INSERT * len(PATHS[state, ASSISTANT]) for state in range(STATES)]


def role_of(name: str | None) -> int | None:
    name = (name or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else None


def transfer(roles: list[int | None]) -> np.ndarray:
    """Cheapest cost of a run of turns from each state to each: the min-plus product of its steps."""
    total = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    for role in roles:
        total = np.minimum((total[:, :, None] + STEP[role][None]).min(axis=1), FAR)
    return total


def decide(roles: list[int | None], end: list[int]) -> list[list[Choice]]:
    """For each turn, the best choice in each state, if the run's end in a state costs ``end`` more. Backwards."""
    later, decided = list(end), []
    for role in reversed(roles):
        best = []
        for ways in CHOICES[role]:
            best.append(min(ways, key=lambda way: way.cost + later[way.state]))  # the first of equals
        later = [way.cost + later[way.state] for way in best]
        decided.append(best)
    return decided[::-1]


def through(decided: list[list[Choice]], state: int) -> int:
    for best in decided:
        state = best[state].state
    return state


def repaired(roles: list[str | None]) -> tuple[int, list[Choice], tuple[int, ...]]:
    """(cost, the choice for each turn, roles of empty messages at the end) of one conversation."""
    state, chosen = START, []
    for best in decide([role_of(role) for role in roles], END):
        chosen.append(best[state])
        state = best[state].state
    ending = PATHS[state, ASSISTANT] if roles else ()
    return sum(way.cost for way in chosen) + INSERT * len(ending), chosen, ending


def plain(text: str | None) -> str:
    """Text that cannot be taken for markup."""
    return (text or "").replace("<|im_", "<| im_")


def _empty(states: tuple[int, ...]) -> str:
    return "".join(OPEN.format(ROLES[state - 1]) + CLOSE for state in states)


def piece(way: Choice, state: int, text: str | None, ending: tuple[int, ...] | None) -> str:
    """What a turn adds to its conversation's text; ``ending`` is given with the last turn."""
    if way.action.endswith("merge"):
        out = "\n" + plain(text)
    else:
        out = ("" if state == START else CLOSE) + _empty(way.inserted) + OPEN.format(ROLES[way.state - 1]) + plain(text)
    return out if ending is None else out + CLOSE + _empty(ending)


REPAIRED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("source_role", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("inserted_before", T.ArrayType(T.StringType())),
        T.StructField("inserted_after", T.ArrayType(T.StringType())),
        T.StructField("cost", T.IntegerType()),
        T.StructField("piece", T.StringType()),
    ]
)


@dataclass
class _Edge:
    """A conversation at the first or last row of a partition, and what is known of it elsewhere."""

    end: list[int] = field(default_factory=lambda: list(END))
    start: int = START
    last: bool = True


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[pa.RecordBatch]]]:
    """Each conversation with its slices of the batches: what a task holds of a long one stays in Arrow's form."""
    conversation, held = None, []
    for batch in batches:
        ids, first = batch.column("conv_id").to_pylist(), 0
        for end in range(1, len(ids) + 1):
            if end < len(ids) and ids[end] == ids[first]:
                continue
            if held and ids[first] != conversation:
                yield conversation, held
                held = []
            conversation = ids[first]
            held.append(batch.slice(first, end - first))
            first = end
    if held:
        yield conversation, held


def _part(slices: list[pa.RecordBatch]) -> int:
    return slices[0].column("part")[0].as_py()


def _roles(slices: list[pa.RecordBatch]) -> list[int | None]:
    return [role_of(name) for held in slices for name in held.column("role").to_pylist()]


def _turns(slices: list[pa.RecordBatch]) -> Iterator[tuple]:
    for held in slices:
        yield from zip(*[held.column(name).to_pylist() for name in ("turn", "role", "text")])


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per turn with the repair chosen for it and the text it adds; the pieces in order are the conversation.

    Turns are ordered by (turn, role, text), NULL first. The automaton allows a
    system message first, then users and assistants in turn, and ends after an
    assistant. A turn stays as it is, is merged into the message before it,
    takes another role, or both, and empty messages are inserted before it or at
    the end; the sum of costs is the least there is, and of equal choices the
    first turn's simplest wins. Unknown and NULL roles need a new one; a NULL
    text is empty, and ``<|im_`` in a text is written ``<| im_``, for good, so that
    no text can pass for a mark. Rows equal in all of conv_id, turn, role and text count once.
    A NULL conv_id is a conversation of its own. Other columns are ignored; no
    rows give no rows.

    A conversation may be longer than any task should hold: rows are dealt in
    ranges of (conv_id, turn, role, text), and a conversation that crosses a
    boundary is solved in parts. Each part gives its cost from state to state,
    one 4 x 4 matrix; from these follow the costs behind each part, then the
    state before it, and the parts are decided on their own. Only the first and
    last conversation of a partition can cross, so what the driver sees is two
    small rows per partition, however many conversations there are. Costs are
    found from the roles alone; texts are read once, when they are written.
    """
    spark = conversations.sparkSession
    order = ["conv_id", "turn", "role", "text"]
    rows = (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
        )
        .distinct()
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), *order)
    )
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    rows = rows.checkpoint()  # the three passes below must see the same partitions

    costs = T.ArrayType(T.IntegerType())
    edge = [T.StructField("part", T.IntegerType()), T.StructField("conv_id", T.LongType()), T.StructField("found", costs)]

    def edges(look) -> list:
        """(part, conv_id, whether it is the partition's first, what ``look`` finds) at both ends of each partition."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = last = None
            for last in _runs(batches):
                first = first or last
            seen = [] if first is None else [first] if first is last else [first, last]
            found = [(_part(held), conversation, look(_part(held), conversation, _roles(held))) for conversation, held in seen]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int64()),
                 pa.array([x[2] for x in found], pa.list_(pa.int32()))], ["part", "conv_id", "found"],
            )

        return sorted(rows.drop("text").mapInArrow(run, T.StructType(edge)).collect(), key=lambda row: row.part)

    parts: dict[int | None, dict[int, list[int]]] = {}
    for row in edges(lambda part, conversation, roles: transfer(roles).ravel().tolist()):
        parts.setdefault(row.conv_id, {})[row.part] = row.found
    crossing = {conversation: found for conversation, found in parts.items() if len(found) > 1}
    known: dict[tuple[int, int | None], _Edge] = {}
    for conversation, found in crossing.items():
        later, last = np.array(END), True
        for part in sorted(found, reverse=True):
            known[part, conversation] = _Edge(end=later.tolist(), last=last)
            later, last = (np.array(found[part]).reshape(STATES, STATES) + later).min(axis=1), False
    if known:

        def exits(part, conversation, roles):
            at = known.get((part, conversation))
            decided = decide(roles, at.end) if at else []
            return [through(decided, state) for state in range(STATES)] if at else []

        state_before: dict[int | None, int] = {}
        for row in edges(exits):
            if row.found:
                known[row.part, row.conv_id].start = state_before.get(row.conv_id, START)
                state_before[row.conv_id] = row.found[known[row.part, row.conv_id].start]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for conversation, slices in _runs(batches):
            at = known.get((_part(slices), conversation)) or _Edge()
            state, decided = at.start, decide(_roles(slices), at.end)
            for n, (turn, role, text) in enumerate(_turns(slices)):
                way = decided[n][state]
                ending = PATHS[way.state, ASSISTANT] if at.last and n == len(decided) - 1 else None
                text = piece(way, state, text, ending)
                after = [ROLES[s - 1] for s in ending or ()]
                cost = way.cost + INSERT * len(after)
                before = [ROLES[s - 1] for s in way.inserted]
                out.append((conversation, turn, role, ROLES[way.state - 1], way.action, before, after, cost, text))
                held += len(text)
                state = way.state
                if held >= 1 << 20:
                    yield _batch(out)
                    out, held = [], 0
        yield _batch(out)

    return rows.mapInArrow(write, REPAIRED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(REPAIRED)
    names = pa.list_(pa.string())
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), names, names, pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], REPAIRED.names)
