"""Sum-of-squares packing of documents into training windows of fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import slices
from .tables import text_of
from .tokens import default_path, shared

#: Windows a task keeps open before it levels them out.
OPEN_WINDOWS = 4096

Piece = tuple[int, int, np.ndarray, int]  # row, first id, ids, ids of the document


class Windows:
    """Windows of one task, filled online.

    ``level[h]`` counts the open windows filled up to ``h``. A piece of ``n`` ids goes to the level for which the sum of
    ``level[h] ** 2`` grows least; opening a window is level 0. Documents longer than a window are cut into full windows
    and a rest, and the rest is placed. At the end, or when ``open_windows`` are open, the emptiest windows are dissolved
    and their pieces cut to fill the others, so at most one window of a task stays unfilled.
    """

    def __init__(self, window: int, open_windows: int = OPEN_WINDOWS) -> None:
        self.window, self.most = window, open_windows
        self.level = np.zeros(window + 1, np.int64)
        self.held: dict[int, list[list[Piece]]] = {}
        self.count = 0

    def add(self, row, ids: np.ndarray) -> Iterator[list[Piece]]:
        """Place a document; gives the windows that became full."""
        n = len(ids)
        for start in range(0, n, self.window):
            yield from self._place((row, start, ids[start: start + self.window], n))
        if self.count > self.most:
            yield from self.level_out(keep_last=True)

    def _place(self, piece: Piece) -> Iterator[list[Piece]]:
        n, w, level = len(piece[2]), self.window, self.level
        if n == w:
            yield [piece]
            return
        # growth of the sum of squares, halved and without what all choices share
        growth = level[n: w + 1] - level[: w + 1 - n] + 1
        growth[0] = level[n]  # a new window leaves no level
        growth[-1] = -level[w - n]  # a full window is no longer counted
        growth[1:][level[1: w + 1 - n] == 0] = 1 << 60
        # of equal growth the fullest window
        at = len(growth) - 1 - int(np.argmin(growth[::-1]))
        if at:
            pieces = self.held[at].pop()
            level[at] -= 1
            self.count -= 1
        else:
            pieces = []
        pieces.append(piece)
        if at + n == w:
            yield pieces
        else:
            self.held.setdefault(at + n, []).append(pieces)
            level[at + n] += 1
            self.count += 1

    def level_out(self, keep_last: bool = False) -> Iterator[list[Piece]]:
        """Fill the fullest open windows with cut pieces of the emptiest."""
        rest = [(h, pieces) for h in sorted(self.held) for pieces in self.held[h]]
        self.held, self.count = {}, 0
        self.level[:] = 0
        supply: list[Piece] = []
        low = 0
        while rest[low:]:
            filled, pieces = rest.pop()
            while filled < self.window and (supply or low < len(rest)):
                if not supply:
                    supply = rest[low][1]
                    low += 1
                row, start, ids, n = supply.pop()
                take = min(self.window - filled, len(ids))
                pieces.append((row, start, ids[:take], n))
                filled += take
                if take < len(ids):
                    supply.append((row, start + take, ids[take:], n))
            yield from self._close(filled, pieces, keep_last)
        if supply:
            yield from self._close(sum(len(p[2]) for p in supply), supply, keep_last)

    def _close(self, filled: int, pieces: list[Piece], keep: bool) -> Iterator[list[Piece]]:
        if filled == self.window or not keep:
            yield pieces
        else:
            self.held.setdefault(filled, []).append(pieces)
            self.level[filled] += 1
            self.count += 1


def pack(
    docs: DataFrame, window: int = 2048, end_id: int = 1, tokenizer: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", open_windows: int = OPEN_WINDOWS, with_ids: bool = False,
) -> DataFrame:
    """Pack the token ids of every document, each closed by ``end_id``, into sequences of ``window`` ids.

    One row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids_crc32`` (of the ids as
    little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence); ``with_ids`` adds the
    ids. The input partitions are packed side by side without a shuffle; a task keeps its open windows only, at most
    ``open_windows``, and leaves at most one window unfilled. ``sequence_id`` is the partition number times 2**40 plus a
    count. ``tokenizer`` is a file of the tokenizers library that splits at white space and between letters and signs.

    A null or empty text has only ``end_id``; long texts are cut; repeated rows and null ids are packed like others,
    each row on its own; no rows give no pieces. Other columns of ``docs`` are not read.
    """
    path = tokenizer or default_path()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, windows = shared(path), Windows(window, open_windows)
        base, closed = TaskContext.get().partitionId() << 40, 0
        doc_type = None

        def table(done: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal closed
            names, numbers, held = [], [], []
            for pieces in done:
                offset = 0
                for row, start, ids, n in pieces:
                    ids = np.ascontiguousarray(ids, "<u4")
                    names.append(row)
                    numbers.append((start, len(ids), zlib.crc32(ids), n, base + closed, offset))
                    held.append(ids)
                    offset += len(ids)
                closed += 1
            out = [pa.array(names, doc_type)] + [pa.array(c, pa.int64()) for c in zip(*numbers)]
            if with_ids:
                out.append(pa.array(held, pa.list_(pa.int64())))
            return pa.record_batch(out, ["doc_id", *columns, *["ids"] * with_ids])

        for batch in slices(batches, 1):
            doc_type = batch.schema.field(0).type
            ids, bounds = words.of(batch.column(1))
            ids = ids.astype(np.uint32)
            done: list[list[Piece]] = []
            for i, row in enumerate(batch.column(0).to_pylist()):
                done += windows.add(row, np.append(ids[bounds[i]: bounds[i + 1]], np.uint32(end_id)))
            if done:
                yield table(done)
        if done := list(windows.level_out()):
            yield table(done)

    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in columns) + ", ids array<bigint>" * with_ids)
