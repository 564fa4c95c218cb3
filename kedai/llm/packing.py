"""Hierarchical multi-length packing of documents into training sequences."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import small_batches, text_or_empty
from kedai.llm.tokens import TABLE_BYTES, encoder

CONTEXT = 1024
SHORTEST = 64
POOL = 4096
STEP_GROUPS, STEP_SIZE = 8, 16

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, "
    "sequence_id long, offset long, tier int, step_group long"
)
_NAMES = [part.split()[0] for part in PIECES.split(", ")]
_TYPES = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def tiers_of(context: int, shortest: int) -> list[int]:
    """Context sizes from the longest to the shortest, each half of the one before."""
    out = [context]
    while out[-1] // 2 >= shortest:
        out.append(out[-1] // 2)
    return out


class Tiers:
    """Pieces waiting in a tier for each context size, sorted by length.

    Every other piece of a tier is its own, the rest is its surplus: the own ones open windows of the
    tier's length, the surplus fills gaps of longer windows. The longest tier has no surplus.
    """

    def __init__(self, sizes: list[int]):
        self.sizes = sizes
        self.own: list[list[tuple]] = [[] for _ in sizes]
        self.spare: list[list[tuple]] = [[] for _ in sizes]
        self._added = [0] * len(sizes)
        self.pieces = self.ids = 0

    def tier(self, length: int) -> int:
        """The shortest tier whose context holds the length."""
        return max(k for k, size in enumerate(self.sizes) if size >= length)

    def add(self, piece: tuple) -> None:
        k = self.tier(piece[0])
        self._added[k] += 1
        bisect.insort((self.spare if k and self._added[k] % 2 else self.own)[k], piece)
        self.pieces += 1
        self.ids += piece[0]

    def _take(self, held: list[tuple], at: int) -> tuple:
        piece = held.pop(at)
        self.pieces -= 1
        self.ids -= piece[0]
        return piece

    def filling(self, gap: int, lists: list[list[tuple]]) -> tuple | None:
        """The longest piece of some lists that fits into the gap, else the shortest one, which is cut."""
        fits = [(held[at - 1], held, at - 1) for held in lists if (at := bisect.bisect_left(held, (gap + 1,)))]
        if fits:
            _, held, at = max(fits, key=lambda one: one[0][:2])
            return self._take(held, at)
        left = [held for held in lists if held]
        if not left:
            return None
        shortest = min(left, key=lambda held: held[0][:2])
        length, number, doc, start, total, ids = self._take(shortest, 0)
        self.add((length - gap, number, doc, start + gap, total, ids[gap:]))
        return gap, number, doc, start, total, ids[:gap]

    def window(self, k: int) -> list[tuple]:
        """A full window of a tier's length, opened by its longest own piece: gaps take the surplus of
        shorter tiers, then what this tier and shorter ones keep for themselves, then anything. So many
        ids have to be waiting."""
        window = [self._take(self.own[k], -1)]
        gap = self.sizes[k] - window[0][0]
        sources = (self.spare[k + 1 :], self.own[k:] + self.spare[: k + 1], self.own)
        while gap:
            piece = next(found for lists in sources if (found := self.filling(gap, lists)))
            window.append(piece)
            gap -= piece[0]
        return window


def pack_tiers(tiers: Tiers, least: int) -> Iterator[tuple[int, list[tuple]]]:
    """Full windows of every tier's own length, while more than ``least`` pieces wait: each tier in turn,
    the longest first, turns half of its own pieces into windows."""
    packed = True
    while packed:
        packed = False
        for k, size in enumerate(tiers.sizes):
            for _ in range(-(-len(tiers.own[k]) // 2)):
                if not tiers.own[k] or tiers.pieces <= least or tiers.ids < size:
                    break
                packed = True
                yield size, tiers.window(k)


def pack_rest(tiers: Tiers) -> Iterator[tuple[int, list[tuple]]]:
    """What waits at the end goes to full windows, of the longest tier that it can fill; less than the
    shortest tier is left for one padded sequence."""
    lists = tiers.own + tiers.spare
    for size in tiers.sizes:
        while tiers.ids >= size:
            window, gap = [], size
            while gap:
                piece = tiers.filling(gap, lists)
                window.append(piece)
                gap -= piece[0]
            yield size, window
    rest = [piece for held in lists for piece in held]
    if rest:
        yield tiers.sizes[0], rest


def pack(
    docs: DataFrame,
    tokenizer: str,
    context: int = CONTEXT,
    shortest: int = SHORTEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """Pack all documents into sequences of at most ``context`` ids; one row per piece.

    A document's whole windows become sequences of their own. Its rest is routed to the shortest
    context tier that holds it. Each tier is packed into full windows of its own length, opened by its
    longest pieces; gaps are filled from the surplus of shorter tiers, every other piece of theirs,
    cutting the last piece where nothing fits. Tiers are powers of two, so such windows need no padding.
    What is left at the end of a partition fills windows of the longest tiers that it can, so that each
    partition pads at most one sequence. Sequences are dealt to step groups in the order of their attention cost, forth and
    back, so that groups of a step cost about the same.

    Each input partition is packed where it is read, without a shuffle; a task holds at most
    ``POOL`` rests, and ids of units met before in tables of ``table_bytes`` bytes. Null and empty texts are one end id. Repeated rows and ids stay separate
    documents; null ids are kept; other columns are ignored; an empty table has no pieces.
    ``sequence_id`` is unique over partitions; ``offset`` counts from 0 in a sequence without gaps.
    """
    small_batches(docs.sparkSession)
    sizes = tiers_of(context, shortest)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, table_bytes).documents
        base = TaskContext.get().partitionId() << 36
        waiting: list[tuple[int, list[tuple]]] = []
        made, groups = 0, 0

        def emit() -> pa.RecordBatch:
            """Deal the waiting sequences to step groups and write their pieces."""
            nonlocal made, groups
            order = sorted(
                range(len(waiting)), key=lambda k: (-sum(p[0] ** 2 for p in waiting[k][1]), k)
            )
            n = min(STEP_GROUPS, -(-len(waiting) // STEP_SIZE))
            group = {}
            for rank, k in enumerate(order):
                lap, place = divmod(rank, n)
                group[k] = base + groups + (n - 1 - place if lap % 2 else place)
            columns: list[list] = [[] for _ in _NAMES]
            for k, (size, window) in enumerate(waiting):
                offset = 0
                for length, _, doc, start, total, ids in window:
                    row = (doc, start, length, total, ids.tobytes(), base + made + k, offset, size, group[k])
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
            made, groups = made + len(waiting), groups + n
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, _TYPES, strict=True)], names=_NAMES
            )

        tiers = Tiers(sizes)
        encoded = (
            row
            for batch in batches
            for row in zip(batch.column("id").to_pylist(), encode(batch.column("text")), strict=True)
        )
        for number, (doc, ids) in enumerate(encoded):
            whole = len(ids) // context * context
            for at in range(0, whole, context):
                waiting.append(
                    (context, [(context, number, doc, at, len(ids), ids[at : at + context])])
                )
                if len(waiting) == STEP_GROUPS * STEP_SIZE:
                    yield emit()
            if whole < len(ids):
                tiers.add((len(ids) - whole, number, doc, whole, len(ids), ids[whole:].copy()))
            if tiers.pieces >= POOL:
                for window in pack_tiers(tiers, POOL // 2):
                    waiting.append(window)
                    if len(waiting) == STEP_GROUPS * STEP_SIZE:
                        yield emit()
        for part in (pack_tiers(tiers, 0), pack_rest(tiers)):
            for window in part:
                waiting.append(window)
                if len(waiting) == STEP_GROUPS * STEP_SIZE:
                    yield emit()
        if waiting:
            yield emit()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(pieces, PIECES)
