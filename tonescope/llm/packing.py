"""Operator 1, packing: documents of all lengths into training sequences of a few context sizes.

Every document belongs to a tier, the smallest context size that holds it; what exceeds the largest
is cut into whole windows first. The windows of a tier start with one of its documents each, longest
first, and their gaps are filled from the shorter tiers: with whole pieces that fit best, at last
with a cut one. Only when the shorter tiers are used up are pieces of the same tier cut. So windows
come out full. Sequences then go to step groups of about equal tokens and attention cost.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .tokens import Encoder, default_tokenizer, slices

TIERS = (256, 512, 1024, 2048)
#: Tokens a task gathers before it packs them: bounds its memory, not what is packed.
BLOCK = 2_000_000
#: Tokens of a step group.
STEP = 65_536

SCHEMA = ("sequence_id long, offset long, doc_id long, start long, length long, doc_tokens long, "
          "tier int, step_group long, ids binary")

Piece = tuple[int, int, int]  # document, start, length


class Pool:
    """Pieces by length. The set bits of ``mask`` are the lengths there are."""

    def __init__(self):
        self.mask, self.by_length = 0, {}

    def put(self, piece: Piece) -> None:
        self.by_length.setdefault(piece[2], []).append(piece)
        self.mask |= 1 << piece[2]

    def take(self, length: int) -> Piece:
        found = self.by_length[length]
        piece = found.pop()
        if not found:
            self.mask ^= 1 << length
            del self.by_length[length]
        return piece

    def longest(self, at_most: int, above: int = 0) -> int:
        """The greatest length in (above, at_most], or 0."""
        length = (self.mask & ((1 << (at_most + 1)) - 1)).bit_length() - 1
        return length if length > above else 0


def pack_block(lengths: list[int], carried: list[Piece], tiers: tuple[int, ...],
               last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of the block's documents, and the pieces left for the next block.

    ``last`` leaves none: the rest, less than one window, is cut into powers of two.
    """
    top, windows, pool = tiers[-1], [], Pool()
    for piece in carried:
        pool.put(piece)
    for document, n in enumerate(lengths):
        whole = n - n % top
        windows += [[(document, at, top)] for at in range(0, whole, top)]
        if n > whole:
            pool.put((document, whole, n - whole))

    def fill(window: list[Piece], gap: int, shorter: int) -> int:
        while gap:
            if length := pool.longest(min(gap, shorter)) or pool.longest(gap):
                piece = pool.take(length)
            elif pool.mask:
                # Nothing fits: cut, of the shorter tiers if they have anything.
                length = pool.longest(shorter) or pool.longest(top)
                document, start, n = pool.take(length)
                piece = document, start, gap
                pool.put((document, start + gap, n - gap))
            else:
                return gap
            window.append(piece)
            gap -= piece[2]
        return 0

    rest: list[Piece] = []
    for i in range(len(tiers) - 1, -1, -1):
        tier, shorter = tiers[i], tiers[i - 1] if i else 0
        while length := pool.longest(tier, shorter):
            window = [pool.take(length)]
            if fill(window, tier - length, shorter):
                rest = window  # the pool is empty now
                break
            windows.append(window)
    if last:
        total = sum(piece[2] for piece in rest)
        while total:
            gap, window = 1 << (total.bit_length() - 1), []
            total -= gap
            while gap:
                document, start, n = rest[0]
                taken = min(n, gap)
                window.append((document, start, taken))
                rest[0] = document, start + taken, n - taken
                gap -= taken
                if taken == n:
                    del rest[0]
            windows.append(window)
    return windows, rest


def step_groups(windows: list[list[Piece]], step: int) -> list[int]:
    """A group for each window: the costliest first, each to the group of least cost so far."""
    sizes = [sum(piece[2] for piece in window) for window in windows]
    heap = [(0, 0, group) for group in range(max(1, round(sum(sizes) / step)))]
    groups = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -sizes[i]):
        cost, tokens, group = heap[0]
        heapq.heapreplace(heap, (cost + sizes[i] ** 2, tokens + sizes[i], group))
        groups[i] = group
    return groups


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1,
         tiers: tuple[int, ...] = TIERS, doc_id: str = "doc_id", text: str = "text",
         block: int = BLOCK, step: int = STEP) -> DataFrame:
    """One row per piece: ``sequence_id, offset, doc_id, start, length, doc_tokens, tier,
    step_group, ids`` (unsigned 32-bit little-endian ids of the piece).

    ``tiers`` are powers of two. Each task packs what it scans, in blocks of bounded size, without a
    shuffle; sequence ids carry the number of the task. A null or empty text is its end id alone. A
    null ``doc_id`` stays null. Rows that repeat are packed as often. An empty table gives no rows.
    Columns besides the two named ones are not read, so their names cannot clash. A text is encoded
    whole, so a task holds its longest text.
    """
    tokenizer = tokenizer or default_tokenizer()
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must be ascending powers of two")

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        encoder = Encoder(tokenizer)
        task = TaskContext.get().partitionId() << 40
        sequences = groups = 0
        held: list[tuple[int | None, np.ndarray, int]] = []  # id, its ids or what is left, before
        carried: list[Piece] = []
        gathered = 0

        def packed(last: bool):
            nonlocal sequences, groups, held, carried, gathered
            # Pieces carried over come first and keep their start.
            fresh = [0] * len(carried) + [len(h[1]) for h in held[len(carried):]]
            windows, rest = pack_block(fresh, carried, tiers, last)
            columns: dict[str, list] = {name: [] for name in (
                "sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", "tier",
                "step_group", "ids")}
            group_of = step_groups(windows, step)
            for window, group in zip(windows, group_of, strict=True):
                size, offset = sum(p[2] for p in window), 0
                tier = next((t for t in tiers if t >= size), tiers[-1])
                for document, start, n in window:
                    name, ids, whole = held[document]
                    for column, value in zip(columns.values(), (
                            task + sequences, offset, name, start, n, whole, tier,
                            task + groups + group, ids[start:start + n].tobytes()), strict=True):
                        column.append(value)
                    offset += n
                sequences += 1
            groups += max(group_of, default=-1) + 1
            held = [held[p[0]] for p in rest]
            carried = [(i, p[1], p[2]) for i, p in enumerate(rest)]
            gathered = 0
            types = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
            for at in range(0, len(columns["ids"]), 2000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v[at:at + 2000], t)
                     for v, t in zip(columns.values(), types, strict=True)], names=list(columns))

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(texts):
                ids, bounds = encoder.encode(texts.slice(a, b - a), end_id)
                for i in range(b - a):
                    own = ids[bounds[i]:bounds[i + 1]]
                    held.append((names[a + i], own, len(own)))
                    gathered += len(own)
                if gathered >= block:
                    yield from packed(False)
        yield from packed(True)

    chosen = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return chosen.mapInArrow(run, SCHEMA)
