"""Packing documents into sequences by the sum-of-squares rule.

Each task packs the documents it reads, in their order. Full sequences are cut off a long
document first; what remains is placed in the fill level that minimises the sum over
levels of the squared number of sequences filled to it, which a level array tracks.
Sequences still open at the end of a task are closed by topping up: the fullest stay as the rule
made them and are filled with pieces cut off the emptiest. The very last one is split into
lengths that are powers of two, so nothing is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import lists, slices
from .encoding import crc, encoded, vocabulary, with_end

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
Piece = tuple[int | None, int, np.ndarray, int]  # doc_id, start, ids, doc_tokens


class SumOfSquares:
    """Open sequences by fill level. ``closed`` collects finished ones, each a list of pieces."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.closed: list[list[Piece]] = []
        self.moved = 0

    def level_for(self, size: int) -> int:
        """The fill level whose sequence takes the piece; 0 starts a new one. Ties go to the fullest."""
        top = self.capacity - size
        if not top:
            return 0
        n = self.count
        # Moving one sequence from level g to g + size changes the sum of squares by this; a full sequence is no longer counted.
        change = 2 * n[size : self.capacity + 1]
        change = change + 1
        change[-1] = 0
        change[1:] -= 2 * n[1 : top + 1] - 1
        change[1:][n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(change[::-1].argmin())

    def add(self, piece: Piece) -> None:
        doc_id, start, ids, total = piece
        while len(ids) >= self.capacity:
            self.closed.append([(doc_id, start, ids[: self.capacity], total)])
            start, ids = start + self.capacity, ids[self.capacity :]
        if not len(ids):
            return
        level = self.level_for(len(ids))
        sequence = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        sequence.append((doc_id, start, ids, total))
        level += len(ids)
        if level == self.capacity:
            self.closed.append(sequence)
        else:
            self.count[level] += 1
            self.open.setdefault(level, []).append(sequence)

    def finish(self) -> None:
        """Close all open sequences without padding; ``moved`` counts the tokens that leave the place the rule gave them."""
        left = [s for level in sorted(self.open, reverse=True) for s in self.open[level]]
        self.open, self.count[:] = {}, 0
        size = [sum(len(p[2]) for p in s) for s in left]
        i, j = 0, len(left) - 1
        while i < j:
            if size[i] == self.capacity:
                self.closed.append(left[i])
                i += 1
            elif not left[j]:
                j -= 1
            else:
                doc_id, start, ids, total = left[j].pop()
                rest = max(0, len(ids) - (self.capacity - size[i]))
                if rest:
                    left[j].append((doc_id, start, ids[:rest], total))
                left[i].append((doc_id, start + rest, ids[rest:], total))
                size[i] += len(ids) - rest
                self.moved += len(ids) - rest
        if i == j:
            self._powers(left[i])

    def _powers(self, pieces: list[Piece]) -> None:
        """Split one sequence into sequences whose lengths are powers of two."""
        left = sum(len(p[2]) for p in pieces)
        first = room = 1 << (left.bit_length() - 1) if left else 0
        sequence: list[Piece] = []
        for doc_id, start, ids, total in pieces:
            while len(ids):
                take = min(room, len(ids))
                sequence.append((doc_id, start, ids[:take], total))
                start, ids, room, left = start + take, ids[take:], room - take, left - take
                if not room:
                    self.closed.append(sequence)
                    room = 1 << (left.bit_length() - 1) if left else 0
                    sequence = []
        self.moved += sum(len(p[2]) for p in pieces) - first


def _rows(sequences: list[list[Piece]], first_id: int) -> pa.RecordBatch:
    rows: list[list] = [[] for _ in range(8)]
    for sequence_id, sequence in enumerate(sequences, first_id):
        offset = 0
        for doc_id, start, ids, total in sequence:
            for column, value in zip(rows, (doc_id, start, len(ids), crc(ids), total, sequence_id, offset, ids.astype(np.int32))):
                column.append(value)
            offset += len(ids)
    return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in rows[:7]), lists(rows[7], pa.int32())], [*COLUMNS, "ids"])


def pack(documents: DataFrame, tokenizer: str | None = None, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and the ids themselves as ``ids``.

    A null text is empty and packs its end id alone. Ids of documents may be null or
    repeated; each row is a document of its own, also where rows are equal. An empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    tokenizer = tokenizer or vocabulary("word_bpe_49k.json")
    schema = ", ".join(f"{c} long" for c in COLUMNS) + ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sequence_id = SumOfSquares(capacity), TaskContext.get().partitionId() << 40

        def flush(most: int = 256) -> Iterator[pa.RecordBatch]:
            nonlocal sequence_id
            done, packer.closed = packer.closed, []
            for a in range(0, len(done), most):
                yield _rows(done[a : a + most], sequence_id + a)
            sequence_id += len(done)

        for batch, found in encoded(slices(batches, "text"), 1, tokenizer):
            for doc_id, ids in zip(batch.column(0).to_pylist(), found):
                ids = with_end(ids, end_id)
                packer.add((doc_id, 0, ids, len(ids)))
            yield from flush()
        packer.finish()
        yield from flush()

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)
