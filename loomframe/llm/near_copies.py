"""Exact Jaccard self-join of documents on word n-grams with a token-group matrix.

Documents with the same set of n-grams are one *node*. The join runs in these steps, all of
which read whole texts and whose results do not depend on any limit below:

1. Global order of n-grams: every Arrow batch reports its most used words and its most
   repeated n-grams; n-grams with most uncommon words come first, those with the largest
   sums last. This only decides how much work is done.
2. Groups: nodes that share their smallest n-gram under a hash (taken among the frequent
   ones if those are half of the set) form a group, so similar nodes mostly meet in one.
3. Token-group matrix: for each n-gram in the prefix of some node, the groups whose union of
   prefixes has it. The number of prefix n-grams that a query node has in a group's union,
   and the sizes of the members that have them, bound what it can share with any member.
4. Opening: only groups with enough of them are opened. Query and members meet with their
   full sets; the overlap with the members' full union is the second bound, then members are
   compared by bit counts. Each opened block reports a spanning forest of its links.
5. Connected components of the links.

Groups larger than ``GROUP`` are opened as pairs of blocks, spread over tasks.

Null text and text without words have an empty set and are linked with nothing, not even
with each other. Documents with fewer words than the n-gram's are one n-gram of all of
them. Repeated rows are in one component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm import arrow_text as at
from loomframe.llm.components import components
from loomframe.llm.shared import only, stored

WORDS, PERCENT = 5, 75
#: Prefixes are longer than need be by this many n-grams, or by this part of the set.
SHARED, SHARED_PART = 4, 16
#: Frequent n-grams: most reported per batch, least repetitions there and in sum, most kept.
BATCH_MOST, BATCH_LEAST, TOTAL_LEAST, KEPT = 100_000, 2, 6, 500_000
#: Common words.
COMMON = 30_000
#: Members opened together.
GROUP = 2048
HITS = ("node", "grp", "hits", "n", "least", "most")
#: Prefix entries in one task of the matrix.
PART_ROWS = 1 << 20


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int, common: np.ndarray | None = None):
    """Distinct n-gram hashes of each row in ascending order, the rows' first places, and how
    many words of each n-gram are not ``common``."""
    starts, stops, first = at.word_bounds(data, offsets, at.SPACED_LOWER)
    h = at.word_hashes(data, starts, stops, at.SPACED_LOWER)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    runs = at.run_hashes(h, words)
    inside = row[:len(runs)] == row[words - 1:] if len(runs) else np.zeros(0, bool)
    # Words of each run that are not common.
    rare = np.zeros(len(h), np.int64) if common is None else ~_among(h, common)
    upto = np.concatenate([[0], np.cumsum(rare)])
    strange = upto[words:][:len(runs)] - upto[:-words][:len(runs)] if len(runs) else np.zeros(0, np.int64)
    grams, owner, rarity = [runs[inside]], [row[:len(runs)][inside]], [strange[inside]]
    for short in range(1, words):
        rows = np.flatnonzero(count == short)
        if len(rows):
            grams.append(at.run_hashes(h, short)[first[rows]])
            owner.append(rows)
            rarity.append(upto[first[rows] + short] - upto[first[rows]])
    gram, owner, rarity = np.concatenate(grams), np.concatenate(owner), np.concatenate(rarity)
    order = np.lexsort((gram, owner))
    gram, owner, rarity = gram[order], owner[order], rarity[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner, rarity = gram[new], owner[new], rarity[new]
    return gram, np.searchsorted(owner, np.arange(len(count) + 1)), rarity


def _among(values: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)] == values


def node_of(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each row's set (wrapping sum of mixed members, with its size)."""
    mixed = at.mix(gram ^ np.uint64(0x5851F42D4C957F2D))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return at.mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64))


class Order:
    """Global order of n-grams: those with most uncommon words first, frequent ones last.

    An n-gram with uncommon words hardly occurs twice by chance, so prefixes hold what only
    copies share. Ties go by hash.
    """

    def __init__(self, frequent: dict[int, int], words: int, percent: int, common: np.ndarray | None = None):
        self.common = np.zeros(0, np.uint64) if common is None else common
        keys = np.array(sorted(frequent), np.uint64)
        self.keys, self.words, self.percent = keys, words, percent
        self.counts = np.array([frequent[int(k)] for k in keys], np.int64)

    def count(self, gram: np.ndarray) -> np.ndarray:
        """0 for ordinary n-grams."""
        if not len(self.keys):
            return np.zeros(len(gram), np.int64)
        spot = np.minimum(np.searchsorted(self.keys, gram), len(self.keys) - 1)
        return np.where(self.keys[spot] == gram, self.counts[spot], 0)

    def groups(self, gram: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Group of each row (0 for empty sets)."""
        n = np.diff(first)
        often = at.per_row(count > 0, first)
        row = np.repeat(np.arange(len(n)), n)
        by_frequent = 2 * often >= n
        value = at.mix(gram * np.uint64(0xD6E8FEB86659FD93))
        value[by_frequent[row] & (count == 0)] = np.uint64(0xFFFFFFFFFFFFFFFF)
        out = np.zeros(len(n), np.uint64)
        filled = np.flatnonzero(n)
        if len(filled):
            out[filled] = np.minimum.reduceat(value, first[:-1][filled])
        return out

    def prefixes(self, gram: np.ndarray, first: np.ndarray, count: np.ndarray, rarity: np.ndarray):
        """n-grams of all prefixes, their counts, and their rows."""
        n = np.diff(first)
        size = prefix_size(n, self.percent)
        row = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((gram, -rarity, count, row))
        kept = order[np.arange(len(gram)) - first[row] < size[row]]
        return gram[kept], count[kept], row[kept]


def prefix_size(n, percent: int, least=np.minimum, most=np.maximum):
    """Length of the prefix of a set of n, for arrays or (with other functions) columns."""
    share = (n * percent + 99) // 100 if least is np.minimum else F.floor((n * percent + 99) / 100)
    part = n // SHARED_PART if least is np.minimum else F.floor(n / SHARED_PART)
    floor = SHARED if least is np.minimum else F.lit(SHARED)
    return least(n, n - share + least(share, most(floor, part)))


def needed(n: Column, least: Column, most: Column, percent: int) -> Column:
    """Prefix n-grams that a set of n shares with a set of ``least`` to ``most``, if they link.

    Linked sets share o = t (n + m) / (1 + t) n-grams. Of these at most n - prefix (or, where
    the other's prefix ends first, m - its prefix) lie behind the prefixes. The difference
    is smallest at one end of the range; 2 make up for the rounding in between.
    """
    def at_size(m: Column) -> Column:
        shared = F.ceil(percent * (n + m) / (100 + percent))
        behind = F.greatest(n - prefix_size(n, percent, F.least, F.greatest),
                            m - prefix_size(m, percent, F.least, F.greatest))
        return shared - behind
    return F.greatest(F.lit(1), F.least(at_size(least), at_size(most)) - 2)


def _pieces(batch: pa.RecordBatch, column: int, words: int, common: np.ndarray | None = None):
    """(rows from, to, n-grams, first, uncommon words) of an Arrow batch, piece by piece."""
    data, offsets = at.utf8(batch.column(column))
    for i, j in at.pieces(offsets):
        yield i, j, *sets_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words, common)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def frequent_grams(docs: DataFrame, words: int = WORDS) -> dict[int, int]:
    """Often repeated n-grams and a lower bound of the nodes that have each."""
    def run(batches):
        for batch in batches:
            seen: set[int] = set()
            parts = []
            for _, _, gram, first, _ in _pieces(batch, 0, words):
                node = node_of(gram, first).tolist()
                fresh = np.zeros(len(node), bool)
                for k, x in enumerate(node):
                    fresh[k] = x not in seen
                    seen.add(x)
                parts.append(gram[np.repeat(fresh, np.diff(first))])
            gram, count = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            often = np.flatnonzero(count >= BATCH_LEAST)
            often = often[np.argsort(-count[often], kind="stable")[:BATCH_MOST]]
            yield pa.RecordBatch.from_arrays([_longs(gram[often]), _longs(count[often])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= TOTAL_LEAST).orderBy(F.desc("n"), "gram").limit(KEPT).collect()
    return {r[0] % (1 << 64): r[1] for r in rows}


def common_words(docs: DataFrame) -> np.ndarray:
    """Hashes of the most used words: sums of what every batch uses most."""
    def run(batches):
        for batch in batches:
            data, offsets = at.utf8(batch.column(0))
            parts = [np.zeros(0, np.uint64)]
            counts = [np.zeros(0, np.int64)]
            for i, j in at.pieces(offsets):
                starts, stops, _ = at.word_bounds(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], at.SPACED_LOWER)
                word, n = np.unique(at.word_hashes(data[offsets[i]:offsets[j]], starts, stops, at.SPACED_LOWER),
                                    return_counts=True)
                parts.append(word[n > 1])
                counts.append(n[n > 1])
            word, where = np.unique(np.concatenate(parts), return_inverse=True)
            total = np.bincount(where, np.concatenate(counts), len(word)).astype(np.int64)
            most = np.argsort(-total, kind="stable")[:BATCH_MOST]
            yield pa.RecordBatch.from_arrays([_longs(word[most]), _longs(total[most])], names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "word").limit(COMMON).collect()
    return np.array(sorted(r[0] % (1 << 64) for r in rows), np.uint64)


def describe(docs: DataFrame, order: Order) -> DataFrame:
    """doc_id, text_hash, n, node, grp of every document."""
    def run(batches):
        for batch in batches:
            out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for _, _, gram, first, _ in _pieces(batch, 2, order.words):
                out[0].append(np.diff(first))
                out[1].append(node_of(gram, first))
                out[2].append(order.groups(gram, first, order.count(gram)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[_longs(np.concatenate(c)) for c in out]],
                                             names=["doc_id", "text_hash", "n", "node", "grp"])
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, n long, node long, grp long")


def _entries(docs: DataFrame, order: Order, frequent: bool) -> Iterator:
    """Function over batches that yields (n-gram, node, group, size of set) of prefix entries."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, gram, first, rarity in _pieces(batch, 0, order.words, order.common):
                count = order.count(gram)
                group, node = order.groups(gram, first, count), node_of(gram, first)
                fresh = np.zeros(len(node), bool)
                for k, x in enumerate(node.tolist()):
                    fresh[k] = x not in seen
                    seen.add(x)
                n = np.diff(first)
                prefix, often, row = order.prefixes(gram, first, count, rarity)
                kept = fresh[row] & ((often > 0) == frequent)
                prefix, row = prefix[kept], row[kept]
                yield prefix, node[row], group[row], n[row]
    return run


def ordinary_hits(docs: DataFrame, order: Order, parts: int) -> DataFrame:
    """node, grp, hits, n, least, most: prefix n-grams, not frequent ones, that a node (of n) has
    in a group's union, and the sizes of the members that have them.

    Entries travel in packed form, by the hash of their n-gram.
    """
    entries, percent = _entries(docs, order, False), order.percent

    def pack(batches):
        for prefix, node, group, n in entries(batches):
            part = (at.mix(prefix) % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            used, begin = np.unique(part[by], return_index=True)
            # Column by column, so that repeated nodes and groups compress.
            blobs = [b"".join(c[rows].tobytes() for c in (prefix, node, group, n.astype(np.uint32)))
                     for rows in np.split(by, begin[1:])] if len(used) else []
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(blobs, pa.binary())],
                                             names=["part", "entries"])

    def meet(batches):
        blobs: dict[int, list] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blobs.setdefault(part, []).append(blob)
        for part in list(blobs):
            table = [[], [], [], []]
            for blob in blobs.pop(part):
                n = len(blob) // 28
                for k in range(3):
                    table[k].append(np.frombuffer(blob, np.uint64, n, 8 * n * k))
                table[3].append(np.frombuffer(blob, np.uint32, n, 24 * n).astype(np.uint64))
            table = np.stack([np.concatenate(c) for c in table], axis=1)
            for columns in _matrix(table, percent):
                yield pa.RecordBatch.from_arrays([_longs(c) for c in columns], names=HITS)

    return docs.select("text").mapInArrow(pack, "part long, entries binary").repartition(parts, "part") \
        .mapInArrow(meet, ", ".join(f"{c} long" for c in HITS))


def _matrix(table: np.ndarray, percent: int, limit: int = 1 << 20):
    """Columns ``HITS`` of a part, summed over n-grams in slices of the work."""
    gram, node = table[:, 0], table[:, 1]
    order = np.lexsort((node, gram))
    table = table[order]
    new = np.ones(len(table), bool)
    new[1:] = (table[1:, 0] != table[:-1, 0]) | (table[1:, 1] != table[:-1, 1])
    table = table[new]
    # Only n-grams of two nodes or more.
    begin = np.flatnonzero(np.concatenate([[True], table[1:, 0] != table[:-1, 0]])) if len(table) else np.zeros(0, int)
    size = np.diff(np.append(begin, len(table)))
    table = table[np.repeat(size > 1, size)]
    if not len(table):
        return
    table = table[np.lexsort((table[:, 2], table[:, 0]))]
    gram, node, group, n = table.T
    n = n.astype(np.int64)
    new_cell = np.concatenate([[True], (gram[1:] != gram[:-1]) | (group[1:] != group[:-1])])
    cell_at = np.flatnonzero(new_cell)
    cell_size = np.diff(np.append(cell_at, len(table)))
    cell_group = group[cell_at]
    cell_least, cell_most = np.minimum.reduceat(n, cell_at), np.maximum.reduceat(n, cell_at)
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    gram_no = np.cumsum(new_gram) - 1
    cell_gram = gram_no[cell_at]
    first_cell = np.searchsorted(cell_gram, np.arange(gram_no[-1] + 2))
    cells = np.diff(first_cell)[gram_no]  # groups met by each entry
    work = np.cumsum(cells)
    start = 0
    while start < len(table):
        stop = max(start + 1, int(np.searchsorted(work, (work[start - 1] if start else 0) + limit, "right")))
        entry = np.repeat(np.arange(start, stop), cells[start:stop])
        inner = np.arange(len(entry)) - np.repeat(np.cumsum(cells[start:stop]) - cells[start:stop], cells[start:stop])
        cell = first_cell[gram_no[entry]] + inner
        kept = ((cell_group[cell] != group[entry]) | (cell_size[cell] > 1)) \
            & (100 * cell_most[cell] >= percent * n[entry]) & (percent * cell_least[cell] <= 100 * n[entry])
        entry, cell = entry[kept], cell[kept]
        if len(entry):
            pair = np.lexsort((cell_group[cell], node[entry]))
            entry, cell = entry[pair], cell[pair]
            x, g = node[entry], cell_group[cell]
            new = np.concatenate([[True], (x[1:] != x[:-1]) | (g[1:] != g[:-1])])
            at_new = np.flatnonzero(new)
            yield (x[at_new], g[at_new], np.diff(np.append(at_new, len(x))), n[entry[at_new]],
                   np.minimum.reduceat(cell_least[cell], at_new), np.maximum.reduceat(cell_most[cell], at_new))
        start = stop


def frequent_hits(docs: DataFrame, order: Order) -> DataFrame:
    """As ``ordinary_hits`` for the frequent n-grams, by joins that split hot keys."""
    entries = _entries(docs, order, True)

    def run(batches):
        for columns in entries(batches):
            yield pa.RecordBatch.from_arrays([_longs(c) for c in columns], names=["gram", "node", "grp", "n"])
    rows = stored(docs.select("text").mapInArrow(run, "gram long, node long, grp long, n long").distinct())
    matrix = rows.groupBy("gram", "grp").agg(
        F.count(F.lit(1)).alias("members"), F.min("n").alias("least"), F.max("n").alias("most"))
    return rows.withColumnRenamed("grp", "own").join(matrix, "gram") \
        .filter((F.col("grp") != F.col("own")) | (F.col("members") > 1)) \
        .filter((100 * F.col("most") >= order.percent * F.col("n")) & (order.percent * F.col("least") <= 100 * F.col("n"))) \
        .groupBy("node", "grp").agg(F.count(F.lit(1)).alias("hits"), F.max("n").alias("n"),
                                    F.min("least").alias("least"), F.max("most").alias("most"))


def qualifying(hits: DataFrame, percent: int) -> DataFrame:
    """node, grp of the groups to open: enough prefix n-grams in the group's union."""
    n = F.col("n")
    met = hits.groupBy("node", "grp").agg(F.sum("hits").alias("hits"), F.max("n").alias("n"),
                                          F.min("least").alias("least"), F.max("most").alias("most"))
    least = F.greatest("least", F.ceil(percent * n / 100))
    most = F.least("most", F.floor(100 * n / percent))
    return met.filter(F.col("hits") >= needed(n, least, most, percent)).select("node", "grp")


def _linked(sizes: np.ndarray, bits: np.ndarray, k: int, others: np.ndarray, percent: int) -> np.ndarray:
    both = np.bitwise_count(bits[others] & bits[k]).sum(axis=1, dtype=np.int64)
    return others[100 * both >= percent * (sizes[others] + sizes[k] - both)]


def open_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """Spanning forest (pairs of places) of the links between queries (left) and members (right)."""
    sizes = np.array([len(s) for s in sets])
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    gram, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    mine = count[inverse] > 1
    column, owner = shared[inverse[mine]], owner[mine]
    bits = np.zeros((len(sets), (int((count > 1).sum()) + 63) // 64 * 8), np.uint8)
    np.bitwise_or.at(bits, (owner, column >> 3), (1 << (column & 7)).astype(np.uint8))
    bits = bits.view(np.uint64)
    union = np.bitwise_or.reduce(bits[right], axis=0)
    least = sizes[right].min()
    root = np.arange(len(sets))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for x in left.tolist():
        # Overlap with any member is at most that with the union of all members.
        most = int(np.bitwise_count(bits[x] & union).sum())
        if most * (100 + percent) < percent * (sizes[x] + least):
            continue
        fitting = right[(100 * np.minimum(sizes[right], sizes[x]) >= percent * np.maximum(sizes[right], sizes[x]))
                        & (right != x)]
        for y in _linked(sizes, bits, x, fitting, percent).tolist() if len(fitting) else ():
            a, b = find(x), find(y)
            if a != b:
                root[a] = b
                edges.append((x, y))
    return edges


#: Bits of the filter that keeps texts nobody asks for out of the shuffle (1 MB, whatever the data).
FILTER_BITS = 1 << 23


def asked_for(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is in ``ids``, and a few others: a bit map of hashed ids, of fixed size."""
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = stored(ids.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("_bucket"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("_bits")))
    place = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = docs.join(F.broadcast(bits), F.bitmap_bucket_number(spot) == F.col("_bucket"))
    return near.filter(F.floor(byte / F.pow(F.lit(2.0), place % 8)) % 2 == 1).select(*docs.columns)


_TASK = "array<struct<grp:long,low:int,high:int,member:boolean,block:int>>"


def links(docs: DataFrame, described: DataFrame, candidates: DataFrame, order: Order, group: int = GROUP) -> DataFrame:
    """Edges (a, b) between nodes that span the links found in all opened groups."""
    nodes = described.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("grp").alias("own"))
    opened = candidates.select(F.col("grp").alias("own")).distinct()
    members = nodes.join(opened, "own", "left_semi").select("node", "doc_id", F.col("own").alias("grp"))
    queries = candidates.select("node", "grp").join(nodes, "node").filter("grp <> own").select("node", "doc_id", "grp")
    roles = stored(members.withColumn("member", F.lit(True)).unionByName(queries.withColumn("member", F.lit(False))))
    # Each group is cut into blocks; every pair of blocks is one piece of work.
    sizes = roles.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("blocks"))
    work = roles.join(sizes, "grp").withColumn("block", F.pmod(F.hash("node"), "blocks").cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .groupBy("doc_id", "node").agg(F.collect_list(F.struct(
            "grp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "member", "block")).cast(_TASK).alias("work"))
    words, percent = order.words, order.percent

    def fetch(batches):
        for batch in batches:
            node, work = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for i, j, gram, first, _ in _pieces(batch, 1, words):
                same = node_of(gram, first).view(np.int64) == node[i:j]  # ids may repeat with other texts
                rows = [(k, t) for k in np.flatnonzero(same).tolist() for t in work[i + k].as_py()]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t[c] for _, t in rows], kind) for c, kind in
                         (("grp", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("member", pa.bool_()),
                          ("block", pa.int32()))]
                        + [pa.array([node[i + k] for k, _ in rows], pa.int64()),
                           pa.array([gram[first[k]:first[k + 1]].tobytes() for k, _ in rows], pa.binary())],
                        names=["grp", "low", "high", "member", "block", "node", "grams"])

    def compare(batches):
        for key, rows in _runs(batches):
            place = [np.array([k for k, r in enumerate(rows) if test(r)], int) for test in (
                lambda r: r[4] == key[1], lambda r: r[4] == key[2] and r[3],
                lambda r: r[4] == key[2] and not r[3], lambda r: r[4] == key[1] and r[3])]
            sets = [np.frombuffer(r[6], np.uint64) for r in rows]
            edges = []
            for left, right in [place[:2], place[2:]][:1 if key[1] == key[2] else 2]:
                if len(left) and len(right):
                    edges += open_block(sets, left, right, percent)
            if edges:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[k][5] for k in side], pa.int64()) for side in zip(*edges)], names=["a", "b"])

    texts = asked_for(docs.select("doc_id", "text"), roles).join(work, "doc_id").select("node", "text", "work")
    sets = texts.mapInArrow(fetch, "grp long, low int, high int, member boolean, block int, node long, grams binary")
    return sets.repartition("grp", "low", "high").sortWithinPartitions("grp", "low", "high", "node") \
        .mapInArrow(compare, "a long, b long")


def _runs(batches):
    """((grp, low, high), rows) of sorted batches, each node once."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != key:
                if len(rows) > 1:
                    yield key, rows
                key, rows = row[:3], []
            if not rows or rows[-1][5] != row[5]:
                rows.append(row)
    if len(rows) > 1:
        yield key, rows


def find(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, root of every document.

    component_id is the smallest doc_id reachable by links; documents with the same root are
    one component. Rows with an empty set or without doc_id have no root.
    """
    slim = only(docs, doc_id="doc_id", text="text")
    known = slim.filter("doc_id IS NOT NULL")
    order = Order(frequent_grams(known, words), words, percent, common_words(known))
    described = stored(describe(slim, order))
    usable = described.filter("doc_id IS NOT NULL")
    total = described.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-total * (100 - percent) // (100 * PART_ROWS)))
    candidates = stored(qualifying(
        ordinary_hits(known, order, parts).unionByName(frequent_hits(known, order)), percent))
    roots = components(links(known, usable, candidates, order))
    nodes = usable.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    component = labelled.join(least, "root").select("node", "component_id", "root")
    found = usable.filter("n > 0").join(component, "node").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", "root")
    alone = described.filter("n = 0 OR doc_id IS NULL").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(None).cast("long").alias("root"))
    return found.unionByName(alone)


def first_of_each(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id.

    Rows without doc_id or words stay. Of rows with the same doc_id and text one stays.
    """
    found = stored(find(docs, **settings))
    key = ["doc_id", "text_hash"]
    kept = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(*key)).alias("k")).select("k.*") \
        .unionByName(found.filter("root IS NULL AND doc_id IS NOT NULL").select(*key).distinct())
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    chosen = hashed.filter("doc_id IS NOT NULL").join(kept, key, "left_semi")
    if not found.filter("doc_id IS NOT NULL").groupBy(*key).count().filter("count > 1").isEmpty():
        chosen = chosen.dropDuplicates(key)
    return chosen.unionByName(hashed.filter("doc_id IS NULL")).drop("text_hash")


#: The same in DuckDB.
SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT r, doc_id, gram FROM (SELECT r, doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram FROM d)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS met FROM g a JOIN g b ON a.gram = b.gram AND a.r < b.r
    AND a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * met >= 75 * (x.n + y.n - met)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT r, r AS t FROM d UNION SELECT reach.r, e.b FROM reach JOIN e ON e.a = reach.t),
c AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n USING (r) LEFT JOIN c USING (r)
"""
