"""Packing token ids into rows of fixed length: best fit decreasing.

Documents are encoded, ended by the end-of-document id and split, where they are longer
than a row, into full rows and a rest: no token is lost. Pieces are then placed, longest
first, into the open row that they fill best. Rows are kept by their free places, and a
segment tree over the free places finds the smallest that is large enough.

Every task packs groups of GROUP tokens as they come, so memory is bounded whatever the
partition's size, a lost task packs the same rows again, and nothing is shuffled.

A packed row holds its ids (uint16, padded with PAD), the ends of its segments
(cumulative, from 0), positions that restart at 0 in every segment, and for each segment
the document and the place of its first token there.

Defined results: a null or empty text is one end-of-document id; null ids are kept as
nulls in ``doc_ids``; repeated rows are packed each; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import saved, ship, table
from anemoi.llm.tokens import EOD, VOCABULARY, encode

LENGTH = 2048
GROUP = 1 << 21        # tokens packed together
PAD = EOD

SCHEMA = ("part int, row long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
          "doc_ids array<long>, starts array<long>")


class FreePlaces:
    """Open rows by free places; a segment tree says which numbers of places occur."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _count(self, free: int, by: int) -> None:
        i = free + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def put(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._count(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, row) with the fewest free places that hold ``need``, taken out."""
        i = need + self.size
        if not self.tree[i]:
            # up until a right neighbour has rows, then down to its smallest
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        free = i - self.size
        row = self.rows[free].pop()
        self._count(free, -1)
        return free, row


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers: best fit decreasing of pieces up to ``length``."""
    rows: list[list[int]] = []
    open_rows = FreePlaces(length)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        got = open_rows.take(lengths[i])
        if got is None:
            got = length, len(rows)
            rows.append([])
        free, row = got
        rows[row].append(i)
        if free > lengths[i]:
            open_rows.put(free - lengths[i], row)
    return rows


def _rows(pieces: list[tuple], length: int, part: int, first: int) -> pa.RecordBatch:
    """pieces: (doc_id, start, ids as uint16 bytes)."""
    rows = best_fit([len(p[2]) // 2 for p in pieces], length)
    cols: list[list] = [[] for _ in range(8)]
    for k, row in enumerate(rows):
        sizes = [len(pieces[i][2]) // 2 for i in row]
        used = sum(sizes)
        ids = b"".join(pieces[i][2] for i in row) + PAD.to_bytes(2, "little") * (length - used)
        positions = np.concatenate([np.arange(n, dtype="<u2") for n in sizes] + [np.zeros(length - used, dtype="<u2")])
        for col, x in zip(cols, (part, first + k, used, ids, np.cumsum([0, *sizes]).tolist(), positions.tobytes(),
                                 [pieces[i][0] for i in row], [pieces[i][1] for i in row]), strict=True):
            col.append(x)
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(),
             pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=[x.split()[0] for x in SCHEMA.split(", ")])


def packed(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, group: int = GROUP,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows (SCHEMA); (part, row) is unique."""
    def pack(batches):
        part, first, pieces, held = TaskContext.get().partitionId(), 0, [], 0
        end = EOD.to_bytes(2, "little")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encode(text.as_py(), vocabulary) + end
                for at in range(0, len(data), 2 * length):
                    pieces.append((doc_id, at // 2, data[at:at + 2 * length]))
                    held += len(pieces[-1][2]) // 2
                    if held >= group:
                        out = _rows(pieces, length, part, first)
                        yield out
                        first, pieces, held = first + out.num_rows, [], 0
        if pieces:
            yield _rows(pieces, length, part, first)

    ship(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(pack, SCHEMA))


def op10_packing(spark, sf_dir):
    """The packed rows, written as files; each row's ids and positions by their digests."""
    rows = saved(packed(table(spark, sf_dir, "documents")), "packed")
    return rows.select("part", "row", "n_tokens", F.size("doc_ids").alias("n_segments"), "doc_ids", "starts", "cu_seqlens",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"))
