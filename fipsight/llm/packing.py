"""Sum-of-squares online packing of token sequences into fixed windows.

A document's ids (plus a closing id) fill whole windows first; what remains is one item. Each item
goes to the fill level that makes the sum of the squared counts of partially filled windows
smallest; only an array of counts by level and the open windows are kept. When a task's rows end,
the open windows are closed: the emptiest are cut up to fill the fullest, and what is left (less
than one window) is cut at powers of two, lengths that need no padding.

Every task packs its own rows, so nothing is shuffled, a task keeps at most its open windows, and a
lost task is simply packed again.

Cases: null text = empty text (one piece holding the closing id); empty table = no rows; repeated
rows are packed each by itself; null ids stay null; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fipsight.llm.pretokens import TextEncoder
from fipsight.llm.text import chunks

#: One piece: a run of a document's ids in a window. ``ids`` holds little-endian unsigned 32-bit ids.
PIECE = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Open windows by fill level, and the pieces of the windows that are complete."""

    def __init__(self, window: int, first_sequence: int = 0):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)  # open windows by level
        self.open: list[list] = [[] for _ in range(window)]  # level -> windows, each a list of pieces
        self.next = first_sequence
        self.done: list[tuple] = []

    def best_level(self, size: int) -> int:
        """Level whose window should take an item of ``size`` ids; 0 opens a window.

        Moving a window from level h to h + size changes the sum of squares by
        2 (count[h + size] - count[h] + 1); filling it by 1 - 2 count[h]; a new one by
        2 count[size] + 1. Ties go to the fullest level.
        """
        c, top = self.count, self.window - size
        change = 2 * (c[size:self.window + 1] - c[:top + 1] + 1)
        change[top] = 1 - 2 * c[top]
        change[0] = 2 * c[size] + 1
        usable = c[:top + 1] > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        return int(top - np.argmin(change[::-1]))

    def close(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, ids, total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        n, w = len(ids), self.window
        whole = n - n % w
        for a in range(0, whole, w):
            self.close([(doc, a, ids[a:a + w], n)])
        size = n - whole
        if not size:
            return
        piece = (doc, whole, ids[whole:], n)
        h = self.best_level(size)
        held = self.open[h].pop() if h else []
        if h:
            self.count[h] -= 1
        held.append(piece)
        if h + size == w:
            self.close(held)
        else:
            self.open[h + size].append(held)
            self.count[h + size] += 1

    def finish(self) -> None:
        """Close all open windows without padding."""
        left = [(level, held) for level in range(self.window - 1, 0, -1) for held in self.open[level]]
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0
        i, spare = 0, []  # spare: pieces of the emptiest window, being cut up
        while i < len(left):
            fill, held = left[i]
            i += 1
            while fill < self.window:
                if not spare:
                    if i == len(left):
                        break
                    spare = left.pop()[1]
                doc, start, ids, total = spare.pop()
                take = min(len(ids), self.window - fill)
                held.append((doc, start, ids[:take], total))
                fill += take
                if take < len(ids):
                    spare.append((doc, start + take, ids[take:], total))
            self.cut(held, fill)
        if spare:
            self.cut(spare, sum(len(p[2]) for p in spare))

    def cut(self, pieces: list, fill: int) -> None:
        """Close a window, split at powers of two if it isn't full."""
        pieces = pieces[::-1]
        size = self.window if fill == self.window else 1 << (fill.bit_length() - 1)
        while fill:
            part, need = [], size
            while need:
                doc, start, ids, total = pieces.pop()
                take = min(len(ids), need)
                part.append((doc, start, ids[:take], total))
                need -= take
                if take < len(ids):
                    pieces.append((doc, start + take, ids[take:], total))
            self.close(part)
            fill -= size
            size = 1 << (fill.bit_length() - 1) if fill else 0


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 1024, closing_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces (``PIECE``) of all texts of ``docs`` encoded by the tokenizer file at ``tokenizer``.

    The file must be readable at that path on every executor. ``docs`` should be a table scan or
    otherwise deterministic, as for any Spark job whose tasks may run twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 33)
        encoder = TextEncoder(tokenizer)
        end = np.array([closing_id], np.int32)

        def out():
            rows, packer.done = packer.done, []
            cols = list(zip(*rows))
            longs = [pa.array(cols[k], pa.int64()) for k in (0, 1, 3, 4, 5)]
            ids = pa.array([x.astype("<u4").tobytes() for x in cols[2]], pa.binary())
            return pa.RecordBatch.from_arrays([longs[0], longs[1], ids, *longs[2:]],
                                              ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j, data, off in chunks(batch.column(1)):
                for doc, ids in zip(doc_ids[i:j], encoder.encode_rows(data, off)):
                    packer.add(doc, np.append(ids, end))
                if len(packer.done) >= 2000:
                    yield out()
        packer.finish()
        if packer.done:
            yield out()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, PIECE))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Replace the ids of each piece by their count and CRC-32."""
    return pieces.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
