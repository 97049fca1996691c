"""Packing documents into few sequences by bin completion.

A document longer than a sequence is cut into full sequences and a first piece with what is left, so at most one
piece of a document shares a sequence with others. Texts are tokenised once, in place; a few integers per piece are
all that moves. Pieces that share are spread over groups of bounded size, whatever the documents they
come from, and each group is packed by itself, at the cost of at most one sequence that is not full per group.

In a group only the number of pieces of each length matters. The longest length left is completed to a full sequence
by one of the undominated fillings of the room beside it, and a filling is used as often as its lengths allow.
Fillings are tried by the room they waste; branches whose waste so far cannot lead to fewer sequences than wanted are
cut. Best fit decreasing gives the first solution and the search looks for one with fewer sequences, down to a lower
bound. The search stops after a number of steps, in which case the best solution so far is used.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.llm.tables import stored
from grantweave.llm.token_ids import TextIds

LENGTH = 1024
#: id that ends each document
END = 2
#: pieces packed together; what a task holds
GROUP_PIECES = 32_000
#: steps of the search for a number of sequences
MAX_STEPS = 4_000
#: fillings tried at one place
MAX_BRANCHES = 12

#: how often a filling is used, and its lengths, the longest first
Use = tuple[int, tuple[int, ...]]


def lower_bound(counts: np.ndarray) -> int:
    """Sequences needed at least: pieces too long to share, and what the others cannot fit beside them."""
    length = len(counts) - 1
    sizes = np.arange(length + 1)
    number = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    volume = np.concatenate([np.cumsum((counts * sizes)[::-1])[::-1], [0]])
    half = length // 2 + 1
    best = -(-int(volume[0]) // length)
    for k in range(1, half):
        # Pieces above length - k share with none of at least k; those above a half share with none of each other.
        alone = int(number[length - k + 1])
        wide = int(number[half] - number[length - k + 1])
        room = wide * length - int(volume[half] - volume[length - k + 1])
        rest = int(volume[k] - volume[half]) - room
        best = max(best, alone + wide + max(0, -(-rest // length)))
    return best


def best_fit(counts: np.ndarray) -> list[Use]:
    """Best fit decreasing, for all pieces of a length and all sequences with equal contents at once."""
    length = len(counts) - 1
    #: sequences by the room left: how many, and their contents
    open_at: dict[int, list[Use]] = {}
    rooms: list[int] = []
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        fitting = sorted(r for r in rooms if r >= size)
        heap = list(fitting)
        while left:
            if not heap:
                per = length // size
                if left >= per:
                    _open(open_at, rooms, length - per * size, (left // per, (size,) * per))
                if left % per:
                    _open(open_at, rooms, length - left % per * size, (1, (size,) * (left % per)))
                break
            room = heapq.heappop(heap)
            n, held = open_at[room].pop()
            if not open_at[room]:
                del open_at[room]
                rooms.remove(room)
            elif room >= size:
                heapq.heappush(heap, room)
            used = min(n, left)
            if used < n:
                _open(open_at, rooms, room, (n - used, held))
            _open(open_at, rooms, room - size, (used, (*held, size)))
            if room - size >= size and open_at[room - size][:-1] == []:
                heapq.heappush(heap, room - size)
            left -= used
    return [use for uses in open_at.values() for use in uses]


def _open(open_at: dict[int, list[Use]], rooms: list[int], room: int, use: Use) -> None:
    if room not in open_at:
        open_at[room] = []
        rooms.append(room)
    open_at[room].append(use)


def _holds(filling: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces of ``other`` can be put inside those of ``filling``, which then dominates it."""
    if not other:
        return True
    piece, rest = other[0], other[1:]
    tried = set()
    for i, room in enumerate(filling):
        if room >= piece and room not in tried:
            tried.add(room)
            if _holds((*filling[:i], room - piece, *filling[i + 1 :]), rest):
                return True
    return False


def _greedy(counts: np.ndarray, room: int) -> tuple[int, ...]:
    """The longest piece that fits, again and again."""
    taken: list[int] = []
    used: dict[int, int] = {}
    sizes = np.flatnonzero(counts[: room + 1])
    at = len(sizes) - 1
    while at >= 0 and room:
        size = int(sizes[at])
        if size > room or counts[size] <= used.get(size, 0):
            at -= 1
            continue
        taken.append(size)
        used[size] = used.get(size, 0) + 1
        room -= size
    return tuple(taken)


def fillings(counts: np.ndarray, room: int, most_waste: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the pieces of ``counts`` that waste at most ``most_waste``, least
    waste first, then fewer pieces, then those of most equal length: the shortest fit last and are kept longest.

    Looked at are one piece, two and three pieces, and the longest pieces that fit one after the other.
    One piece that fits exactly dominates all others.
    """
    if not room:
        return [()]
    if room < len(counts) and counts[room]:
        return [(room,)]
    sizes = np.flatnonzero(counts[: room + 1])
    found = {_greedy(counts, room)}
    if len(sizes):
        found.add((int(sizes[-1]),))
        # Beside a first piece the longest second one that fits dominates shorter ones.
        at = np.searchsorted(sizes, room - sizes, "right") - 1
        second = np.where(at >= 0, sizes[np.maximum(at, 0)], 0)
        ok = (at >= 0) & (second <= sizes) & ((second < sizes) | (counts[sizes] > 1))
        waste = room - sizes - second
        firsts = np.flatnonzero(ok & (waste <= most_waste))
        firsts = firsts[np.lexsort((-second[firsts], waste[firsts]))][: 2 * MAX_BRANCHES]
        found.update((int(sizes[i]), int(second[i])) for i in firsts)
        exact = sum(1 for f in found if sum(f) == room)
        if exact < MAX_BRANCHES:
            # Three pieces that fill the room, those of most equal length first.
            have = np.zeros(room + 1, bool)
            have[sizes] = True
            for a in sizes[np.searchsorted(sizes, -(-room // 3)) :].tolist():
                if exact >= MAX_BRANCHES:
                    break
                rest = room - a
                b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
                b = b[have[b] & have[rest - b]]
                for x in b[:2].tolist():
                    three = (a, x, rest - x)
                    if all(counts[s] >= three.count(s) for s in three):
                        found.add(three)
                        exact += 1
    kept: list[tuple[int, ...]] = []
    for filling in sorted(found, key=lambda f: (room - sum(f), len(f), -min(f, default=0))):
        if room - sum(filling) > most_waste or len(kept) == MAX_BRANCHES:
            break
        if len(filling) > 3 or not any(len(k) <= 3 and _holds(k, filling) for k in kept):
            kept.append(filling)
    return kept


def _uses(counts: np.ndarray, longest: int, filling: tuple[int, ...]) -> int:
    """How often the longest piece can be completed by ``filling``."""
    whole = (longest, *filling)
    return min(int(counts[s]) // whole.count(s) for s in set(whole))


def complete(counts: np.ndarray, target: int, max_steps: int = MAX_STEPS) -> list[Use] | None:
    """A solution with at most ``target`` sequences, or None if the search ends without one."""
    length = len(counts) - 1
    counts = counts.copy()
    budget = target * length - int(counts @ np.arange(length + 1))
    if budget < 0:
        return None

    def choices(waste: int) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        options = fillings(counts, length - longest, budget - waste)
        counts[longest] += 1
        for filling in options:
            n, lost = _uses(counts, longest, filling), length - longest - sum(filling)
            if lost:
                n = min(n, (budget - waste) // lost)
            if n:
                yield n, lost, (longest, *filling)

    path: list[tuple[int, int, tuple[int, ...]]] = []
    waste, steps, stack = 0, 0, []
    while counts.any():
        stack.append(choices(waste))
        while stack and (step := next(stack[-1], None)) is None:
            stack.pop()
            if not path:
                return None
            n, lost, whole = path.pop()
            waste -= n * lost
            for size in whole:
                counts[size] += n
        if not stack or steps == max_steps:
            return None
        n, lost, whole = step
        for size in whole:
            counts[size] -= n
        waste += n * lost
        path.append(step)
        steps += 1
    return [(n, whole) for n, _, whole in path]


def bins(counts: np.ndarray, max_steps: int = MAX_STEPS) -> list[Use]:
    """Contents of sequences that hold ``counts[s]`` pieces of each length ``s``, in as few as are found."""
    best = best_fit(counts)
    have, least = sum(n for n, _ in best), lower_bound(counts)
    # From the bound upwards in growing steps, then between the last two.
    low, step = least, 1
    while low < have:
        target = min(low + step - 1, have - 1)
        found = complete(counts, target, max_steps)
        if found is None:
            low, step = target + 1, 2 * step
            continue
        best, have = found, sum(n for n, _ in found)
        step = 1
    return best


PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
PLACE = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def pieces(docs: DataFrame, id_column: str, text_column: str, length: int, ranks: str | None) -> DataFrame:
    """Id, ``PIECE`` columns and a row number that repeats in no other row, of every piece."""
    schema = T.StructType([docs.schema[id_column], *PIECE.fields, T.StructField("_row", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TextIds(ranks)
        end = np.array([END], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1)):
                raw = ids_of.encode(text.as_py() or "") + end
                n = len(raw) // 4
                begin, piece = 0, 0
                stop = n % length or min(n, length)
                while begin < n:
                    part = raw[4 * begin : 4 * stop]
                    at.append(i)
                    rows.append((piece, begin, stop - begin, zlib.crc32(part), row))
                    begin, stop, piece, row = stop, stop + length, piece + 1, row + 1
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int32(), *[pa.int64()] * 4]
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, types))], schema.names)

    return docs.select(f"`{id_column}`", docs[text_column].cast("string")).mapInArrow(run, schema)


def places(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece of a group."""
    order = np.argsort(-sizes, kind="stable")
    taken = {int(s): int(i) for s, i in zip(*np.unique(-sizes[order], return_index=True))}
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    first = 0
    for n, whole in bins(np.bincount(sizes, minlength=length + 1)):
        at = 0
        for size in whole:
            begin = taken[-size]
            rows = order[begin : begin + n]
            sequence[rows] = np.arange(first, first + n)
            offset[rows] = at
            taken[-size] = begin + n
            at += size
        first += n
    return sequence, offset


def bin_packed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    ranks: str | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Every piece with its place: the id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and
    ``offset``.

    Null texts count as empty; an empty text is its end id alone. Each row is a document of its own, also if ids
    repeat or are null. An empty table gives no pieces. Other columns are not read. Sequence ids are unique but
    not consecutive: even ones hold one full piece, odd ones shared pieces.
    """
    table = stored(pieces(docs, id_column, text_column, length, ranks), "pieces")
    schema = T.StructType([docs.schema[id_column], *PIECE.fields, *PLACE.fields])
    full = table.filter(F.col("length") == length).select(
        *[F.col(f"`{c}`") for c in schema.names[:5]],
        F.shiftleft("_row", 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    shared = table.filter(F.col("length") < length)
    groups = max(1, -(-shared.count() // group_pieces))

    def run(group: pa.Table) -> pa.Table:
        # In one order, whatever the order in which a shuffle delivers the rows.
        group = group.sort_by("_row")
        sequence, offset = places(group.column(3).to_numpy(), length)
        number = group.column("_group")[0].as_py() if group.num_rows else 0
        sequence = ((number << 33) + sequence) * 2 + 1
        return pa.Table.from_arrays([*group.columns[:5], pa.array(sequence), pa.array(offset)], schema.names)

    grouped = shared.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    return full.unionByName(grouped.groupBy("_group").applyInArrow(run, schema))
