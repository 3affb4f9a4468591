"""Best-fit packing of documents into sequences, improved by a swap-based local search.

Documents become pieces of at most ``capacity`` ids; only longer ones are cut. Pieces are
dealt evenly into shards of about ``SHARD_TOKENS`` ids, each packed by one task:

1. Best fit in descending order of length.
2. Local search. The emptiest bin gives its pieces away: a piece is *moved* into a bin with
   room, or *exchanged* one for one, two for one, or one for two, against shorter pieces of
   a fuller bin. Every step makes the sum of squared fills larger, so the search ends; a bin
   that becomes empty is gone. A bin that no step improves is left, and the next is tried,
   until the bound of the summed lengths is reached or ``PATIENCE`` bins in a row were left.
   Pairs to give away come from a bin's eight longest pieces, pairs to take are a bin's two
   shortest; so more sequences may remain than a full search would leave.

A shard wastes at most what its own rest bins leave over, less than a thousandth of it.
Null text is empty and has only the end id. Repeated rows are packed as separate documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm import tokens
from loomframe.llm.shared import only, stored

CAPACITY, END_ID = 2048, 0
SHARD_TOKENS = 16 << 20
#: Bins in a row that no step improves before the search of a shard ends.
PATIENCE = 200


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID, apart: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    vocabulary = vocabulary or tokens.default_vocabulary()
    end = np.array([end_id], tokens.ID_TYPE).tobytes()

    def run(batches):
        encode = tokens.encoder(vocabulary, apart)
        step = 4 * capacity
        for batch in batches:
            for first, last in tokens.batches(batch.column(1)):
                part = batch.slice(first, last - first)
                rows = []
                for row, ids in enumerate(encode(part.column(1))):
                    ids += end
                    rows += [(row, k, k * capacity, len(ids[k * step:(k + 1) * step]) // 4,
                              zlib.crc32(ids[k * step:(k + 1) * step])) for k in range(-(-len(ids) // step))]
                row, piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     *[pa.array(c, pa.int64()) for c in (start, length, crc)]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return only(docs, doc_id="doc_id", text="text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece: into the fullest bin with room, longest pieces first."""
    bins = np.zeros(len(lengths), np.int64)
    with_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps, opened = 0, 0  # bit g of ``gaps``: a bin with gap g is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            b = with_gap[gap].pop()
            if not with_gap[gap]:
                gaps &= ~(1 << gap)
        else:
            gap, b, opened = capacity, opened, opened + 1
        bins[i] = b
        left = gap - size
        if left:
            with_gap[left].append(b)
            gaps |= 1 << left
    return bins


class Search:
    """Local search on the pieces of one shard."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, capacity: int):
        self.lengths, self.bins = lengths.astype(np.int64), bins.copy()
        self.fill = np.bincount(bins, lengths).astype(np.int64)
        self.capacity = capacity
        self.contents: list[list[int]] = [[] for _ in self.fill]
        for i, b in enumerate(bins.tolist()):
            self.contents[b].append(i)
        self.open = np.flatnonzero((self.fill < capacity)[bins])  # pieces of underfull bins
        # Two shortest pieces of every bin, as one exchange partner.
        self.pair = np.full(len(self.fill), capacity + 1, np.int64)
        for b in range(len(self.fill)):
            self._paired(b)

    def _paired(self, b: int) -> None:
        two = sorted(self.lengths[i] for i in self.contents[b])[:2]
        self.pair[b] = sum(two) if len(two) == 2 else self.capacity + 1

    def _put(self, i: int, b: int) -> None:
        old = self.bins[i]
        self.contents[old].remove(i)
        self.contents[b].append(i)
        self.fill[old] -= self.lengths[i]
        self.fill[b] += self.lengths[i]
        self.bins[i] = b

    def _exchange(self, out: list[int], back: list[int], victim: int, b: int) -> None:
        for i in out:
            self._put(i, b)
        for i in back:
            self._put(i, victim)
        self._paired(b)
        self._paired(victim)

    def step(self, victim: int) -> bool:
        """One move or exchange that takes ids out of ``victim`` into a bin at least as full."""
        gap = self.capacity - self.fill
        usable = (gap > 0) & (self.fill >= self.fill[victim]) & (self.fill > 0)
        usable[victim] = False
        mine = sorted(self.contents[victim], key=lambda i: -self.lengths[i])
        bins = np.flatnonzero(usable)
        if not len(bins):
            return False
        for i in mine:
            room = bins[gap[bins] >= self.lengths[i]]
            if len(room):
                b = room[np.argmin(gap[room])]
                self._exchange([i], [], victim, b)
                return True
        self.open = self.open[gap[self.bins[self.open]] > 0]
        others = self.open[usable[self.bins[self.open]]]
        size, room = self.lengths[others], gap[self.bins[others]]
        offers = [[i] for i in mine] + [[i, j] for k, i in enumerate(mine[:8]) for j in mine[k + 1:8]]
        best = (0, 0)
        for offer in offers:
            given = sum(int(self.lengths[i]) for i in offer)
            gain = given - size
            fits = (gain > 0) & (gain <= room)
            if fits.any():
                value = np.where(fits, gain * self.capacity - (room - gain), -1)
                k = int(value.argmax())
                best = max(best, (int(value[k]), 1, offer, [int(others[k])]), key=lambda x: x[0])
            if len(offer) == 1:
                gain = given - self.pair[bins]
                fits = (gain > 0) & (gain <= gap[bins])
                if fits.any():
                    value = np.where(fits, gain * self.capacity - (gap[bins] - gain), -1)
                    k = int(value.argmax())
                    if value[k] > best[0]:
                        two = sorted(self.contents[bins[k]], key=lambda i: self.lengths[i])[:2]
                        best = (int(value[k]), 2, offer, two)
        if not best[0]:
            return False
        self._exchange(best[2], best[3], victim, int(self.bins[best[3][0]]))
        return True

    def run(self, patience: int = PATIENCE) -> np.ndarray:
        least = -(-int(self.lengths.sum()) // self.capacity)
        used, stuck, tried = int((self.fill > 0).sum()), 0, np.zeros(len(self.fill), bool)
        while used > least and stuck < patience:
            able = (self.fill > 0) & (self.fill < self.capacity) & ~tried
            if not able.any():
                break
            victim = int(np.where(able, self.fill, self.capacity + 1).argmin())
            while self.fill[victim] and self.step(victim):
                pass
            if self.fill[victim]:
                tried[victim], stuck = True, stuck + 1
            else:
                used, stuck = used - 1, 0
        return self.bins


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin (numbered from 0) and place in it of each piece."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bins = Search(lengths, best_fit(lengths, capacity), capacity).run()
    bins = np.unique(bins, return_inverse=True)[1]
    order = np.argsort(bins, kind="stable")
    size = lengths[order]
    before = np.cumsum(size) - size
    first = np.concatenate([[True], np.diff(bins[order]) > 0])
    offset = np.empty(len(lengths), np.int64)
    offset[order] = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(order))))
    return bins, offset


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
         shard_tokens: int = SHARD_TOKENS, **settings) -> DataFrame:
    """The pieces of all documents with sequence_id and offset."""
    cut = stored(pieces(docs, vocabulary, capacity, **settings))
    total = cut.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    shards = max(1, round(total / shard_tokens))

    def run(batches):
        rows = [b for b in batches if len(b)]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        bins, offset = pack_lengths(table["length"].to_numpy(), capacity)
        shard = TaskContext.get().partitionId() << 32
        yield from table.append_column("sequence_id", pa.array(bins + shard, pa.int64())) \
            .append_column("offset", pa.array(offset, pa.int64())).to_batches(10_000)

    return cut.repartition(shards).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
