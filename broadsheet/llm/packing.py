"""Best-fit packing of documents into sequences by bin completion."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import spread, stored
from broadsheet.llm.minhash import parts
from broadsheet.llm.tokens import Encoder, default_vocabulary
from broadsheet.plans.ordered import with_position

CAPACITY = 2048
#: Partial fillings looked at for one bin, and fillings tried in the whole search after the first solution.
FILLING_NODES, SEARCH_NODES = 60, 3000


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing needs: the volume bound, raised by items over half a bin that no small item can join."""
    cap = len(counts) - 1
    sizes = np.arange(cap + 1)
    total = int((counts * sizes).sum())
    best = -(-total // cap)
    for small in range(1, cap // 2 + 1):  # items under `small` are left out
        large = int(counts[cap - small + 1:].sum())
        middle = int(counts[cap // 2 + 1:cap - small + 1].sum())
        rest = int((counts * sizes)[small:cap // 2 + 1].sum())
        room = middle * cap - int((counts * sizes)[cap // 2 + 1:cap - small + 1].sum())
        best = max(best, large + middle + max(0, -(-(rest - room) // cap)))
    return best


def fillings(counts: np.ndarray, gap: int, most: int = 3) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Undominated fillings of a gap, best first: (waste, ((length, uses), ...)).

    Lengths are tried from the largest down, as often as they fit (the first filling is the best-fit one); a branch ends
    when even its whole remaining gap could not beat the waste found. A filling is dominated, and left out, if an item
    that is left over could join it or take the place of a smaller one.
    """
    sizes = (np.flatnonzero(counts[1:gap + 1]) + 1)[::-1]
    smaller = [*np.cumsum((counts[sizes] * sizes)[::-1])[::-1].tolist(), 0]  # volume of the sizes from here on
    have, sizes = counts[sizes].tolist(), sizes.tolist()
    found: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    worst, nodes = gap + 1, 0
    # (size, uses still to try of it or -1 for all, gap left, uses so far); the largest use is tried first
    stack: list[tuple[int, int, int, tuple[tuple[int, int], ...]]] = [(0, -1, gap, ())]
    while stack and nodes < FILLING_NODES:
        i, uses, left, used = stack.pop()
        nodes += 1
        while i < len(sizes) and sizes[i] > left:
            i, uses = i + 1, -1
        if left == 0 or i == len(sizes):
            if left < worst and not _dominated(counts, used, left):
                found = sorted([*found, (left, used)])[:most]
                worst = found[-1][0] if len(found) == most else worst
                if worst == 0 or left == 0 and nodes > FILLING_NODES // 4:
                    break
            continue
        if left - smaller[i] >= worst:
            continue
        if uses < 0:
            uses = min(have[i], left // sizes[i])
        if uses:
            stack.append((i, uses - 1, left, used))
        stack.append((i + 1, -1, left - uses * sizes[i], (*used, (sizes[i], uses)) if uses else used))
    if found:
        return found
    left, greedy = gap, []  # the nodes did not suffice for any leaf, or nothing fits
    for size, n in zip(sizes, have):
        if uses := min(n, left // size):
            greedy.append((size, uses))
            left -= uses * size
    return [(left, tuple(greedy))]


def _dominated(counts: np.ndarray, used: tuple[tuple[int, int], ...], waste: int) -> bool:
    if not waste:
        return False
    taken = dict(used)

    def free(a: int, b: int) -> bool:
        return any(counts[s] > taken.get(s, 0) for s in np.flatnonzero(counts[a:b + 1]) + a)

    return free(1, waste) or any(free(s + 1, s + waste) for s, _ in used)


def complete(counts: np.ndarray) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns (times, ((length, uses), ...)) that hold every item, in as few bins as the search finds.

    counts[s] items have the length s. Depth first: the largest item left gets a filling, for as many bins at once as the
    counts allow. The best-fit solution is the first incumbent; a branch whose waste could not lead to fewer bins
    than the incumbent is cut; a solution at the lower bound ends the search. The work depends on the capacity, not on the number of items.
    """
    cap = len(counts) - 1
    total = int((counts * np.arange(cap + 1)).sum())
    if not total:
        return []
    bound = lower_bound(counts)
    best: list | None = None
    bins_best = 1 << 62
    nodes = 0
    # frames: counts before, bins, waste, options not tried yet, largest item
    left = counts.copy()
    path: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    frames: list[tuple[np.ndarray, int, int, list, int]] = []
    bins = waste = 0
    top = cap
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            if bins < bins_best:
                best, bins_best = list(path), bins
                if bins_best <= bound:
                    break
            options = []
        else:
            left[top] -= 1
            options = fillings(left, cap - top)
            left[top] += 1
            nodes += best is not None
        frames.append((left, bins, waste, options[::-1], top))
        moved = False
        while frames:
            before, b, w, options, t = frames[-1]
            if best is not None and nodes > SEARCH_NODES:
                return best
            if options:
                lost, filling = options.pop()
                uses = dict(filling)
                uses[t] = uses.get(t, 0) + 1
                times = min(int(before[s]) // k for s, k in uses.items())
                if best is None or w + times * lost <= (bins_best - 1) * cap - total:
                    left = before.copy()
                    for s, k in uses.items():
                        left[s] -= times * k
                    path = path[:len(frames) - 1]
                    path.append((times, tuple(sorted(uses.items(), reverse=True))))
                    bins, waste, top, moved = b + times, w + times * lost, t, True
                    break
            else:
                frames.pop()
        if not moved:
            break
    return best or []


def pieces_of(docs: DataFrame, capacity: int, end_id: int, vocabulary: str, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the token ids of each text with the end id, cut at `capacity`."""
    narrow = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "id")
    schema = T.StructType([T.StructField("doc_id", narrow.schema["id"].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        for batch in batches:
            for part in parts(batch):
                ids, at = encoder.encode(part.column(1))
                full = np.diff(at) + 1
                n = -(-full // capacity)
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, full[row] - start)
                flat = np.insert(ids, at[1:], end_id).astype("<u4")
                cut = np.cumsum(length)
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(cut - length, cut)]
                columns = [part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc, pa.int64())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], cut]).astype(np.int32)), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         keep_ids: bool = False) -> DataFrame:
    """Place every document in sequences of at most `capacity` tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Only documents longer than a sequence are cut. The pieces are counted by length, at most `capacity` numbers, whatever
    the size of the corpus; bin completion over these counts gives patterns with multiplicities; the pieces
    of a length are numbered by a range partitioning (a length that a third of all pieces share is numbered by many tasks)
    and take their places in the patterns by number. A null text counts as empty and is one piece, the end id; null and
    repeated identifiers are documents of their own. An empty table gives no rows; other columns are ignored.
    """
    pieces = stored(pieces_of(docs, capacity, end_id, vocabulary or default_vocabulary(), id_col, text_col, keep_ids), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[r["length"]] = r["count"]
    keys, per_bin, first_bin, slot_at, offsets = _places(complete(counts))
    numbered = with_position(pieces, ["doc_id", "piece", "ids_crc32"], ["length"], "number")
    schema = T.StructType([f for f in pieces.schema.fields if f.name != "ids"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
                          + [f for f in pieces.schema.fields if f.name == "ids"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, length = b.column("number").to_numpy(), b.column("length").to_numpy()
            slot = np.searchsorted(keys, (length << 44) + number, "right") - 1
            inside = number - (keys[slot] & ((1 << 44) - 1))
            sequence = first_bin[slot] + inside // per_bin[slot]
            offset = offsets[slot_at[slot] + inside % per_bin[slot]]
            out = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([out[c] if c in out else b.column(c) for c in schema.names], names=schema.names)

    return numbered.mapInArrow(place, schema)


def _places(patterns: list[tuple[int, tuple[tuple[int, int], ...]]]):
    """Per pattern and length: the first number it takes (with the length above it), uses per bin, first bin, offsets in the bin.

    At most about capacity * ln(capacity) patterns exist, since each uses up a length or the number of its uses.
    """
    taken: dict[int, int] = {}
    rows, offsets, bins = [], [], 0
    for times, uses in patterns:
        at = 0
        for length, k in uses:
            rows.append(((length << 44) + taken.get(length, 0), k, bins, len(offsets)))
            offsets.extend(at + i * length for i in range(k))
            at += k * length
            taken[length] = taken.get(length, 0) + times * k
        bins += times
    rows.sort()
    a = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return a[:, 0].copy(), a[:, 1].copy(), a[:, 2].copy(), a[:, 3].copy(), np.array(offsets, dtype=np.int64)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, from `pack(..., keep_ids=True)`; a sequence holds at most its capacity."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
