"""Benchmark decontamination with suffix arrays of the training text.

Each shard of documents (a few megabytes of an Arrow batch) gets the sorted array of its
suffixes, as sequences of benchmark word numbers. A suffix can only match a window if that
many words from it on are benchmark words, so others are left out of the array. Every
benchmark suffix is then searched by bisection: its neighbours in the array hold all places
that share its first words. Runs of consecutive windows in document and item make up the
longest verbatim matches, reported with item, place and length.

The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text; documents meet one
block at a time. Null text has no words. Items without id or words are no part of a
benchmark; items that share an id count once. Repeated documents are judged alike.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm import arrow_text as at
from loomframe.llm.shared import only, stored

WINDOW = 10
BLOCK_BYTES = 32 << 20
STATE = ("_text", "_hits", "_items", "_longest", "_longest_at", "_longest_item")
OUT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
       "longest long, longest_at long, longest_item string")


class Suffixes:
    """The benchmark side: word numbers of all items and their distinct windows."""

    def __init__(self, items: list[tuple[str | None, str]], width: int = WINDOW):
        items = sorted(items, key=lambda i: (i[0] is None, i[0] or "", i[1]))
        column = pa.array([t for _, t in items], pa.string())
        data, offsets = at.utf8(column)
        starts, stops, first = at.word_bounds(data, offsets, at.ALNUM_LOWER)
        h = at.word_hashes(data, starts, stops, at.ALNUM_LOWER)
        self.width = width
        self.vocabulary = np.unique(h)
        number = np.searchsorted(self.vocabulary, h).astype(">u4") + 1
        self.names = [name for name, _ in items]
        counts = np.diff(first)
        tests = []  # (key, words needed, item, place in item): every suffix as long as a window
        for item, n in enumerate(counts):
            need = min(width, int(n))
            for place in range(n - need + 1 if n else 0):
                key = np.zeros(width, ">u4")
                key[:need] = number[first[item] + place:first[item] + place + need]
                tests.append((key.tobytes(), need, item, place))
        tests.sort()
        #: Distinct windows and, for each, who has it: owners[begin[k]:begin[k + 1]].
        self.keys, self.needs, self.begin, owners, last = [], [], [], [], None
        for key, need, item, place in tests:
            if (key, need) != last:
                last = (key, need)
                self.begin.append(len(owners))
                self.keys.append(key)
                self.needs.append(need)
            owners.append((item, place))
        self.begin.append(len(owners))
        self.owners = np.array(owners, np.int64).reshape(-1, 2)
        self.begin, self.needs = np.array(self.begin), np.array(self.needs, np.int64)
        text = f"S{4 * width}"
        self.low = np.array(self.keys, text)
        self.high = np.array([k[:4 * n] + b"\xff" * (4 * (width - n)) for k, n in zip(self.keys, self.needs)], text)
        self.shortest = int(self.needs.min()) if len(self.needs) else width
        bits = np.zeros(1 << 20, bool)
        bits[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True
        self.maybe = bits

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Benchmark word number of each word, 0 for others."""
        out = np.zeros(len(h), np.uint32)
        hit = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.vocabulary, h[hit]), len(self.vocabulary) - 1)
        good = self.vocabulary[spot] == h[hit]
        out[hit[good]] = spot[good] + 1
        return out

    def search(self, number: np.ndarray, first: np.ndarray):
        """Matches in a shard: arrays of document row, word of the shard, words, item, place."""
        n = len(number)
        none = np.zeros((5, 0), np.int64)
        if not n or not len(self.keys):
            return none
        # Words from each place on until a strange word or the end of the document.
        stop = number == 0
        borders = np.zeros(n + 1, bool)
        borders[first] = True
        places = np.arange(n)
        next_stop = np.where(stop, places, n)
        next_stop = np.minimum.accumulate(next_stop[::-1])[::-1]
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        reach = np.minimum(next_stop, first[row + 1]) - places
        kept = np.flatnonzero(reach >= self.shortest)
        if not len(kept):
            return none
        key = np.zeros((len(kept), self.width), ">u4")
        for k in range(self.width):
            inside = reach[kept] > k
            key[inside, k] = number[kept[inside] + k]
        suffixes = key.view(f"S{4 * self.width}").reshape(-1)
        order = np.argsort(suffixes, kind="stable")
        array, where = suffixes[order], kept[order]
        begin = np.searchsorted(array, self.low, "left")
        end = np.searchsorted(array, self.high, "right")
        found = np.flatnonzero(end > begin)
        if not len(found):
            return none
        out = []
        for test in found:
            spots = where[begin[test]:end[test]]
            own = self.owners[self.begin[test]:self.begin[test + 1]]
            out.append(np.stack([
                np.repeat(row[spots], len(own)), np.repeat(spots, len(own)),
                np.full(len(spots) * len(own), self.needs[test]),
                np.tile(own[:, 0], len(spots)), np.tile(own[:, 1], len(spots))]))
        return np.concatenate(out, axis=1)


def longest(matches: np.ndarray) -> dict[int, tuple[int, int, int]]:
    """Row -> (words, first word, item) of its longest verbatim match."""
    row, word, need, item, place = matches
    order = np.lexsort((word, word - place, item, row))
    row, word, need, item, place = matches[:, order]
    diagonal = word - place
    new = np.ones(len(row), bool)
    new[1:] = ((row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])
               | (word[1:] > word[:-1] + 1))
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(row)) - 1
    best: dict[int, tuple[int, int, int]] = {}
    for r, size, at_word, i in zip(row[begin].tolist(), (word[last] + need[last] - word[begin]).tolist(),
                                   word[begin].tolist(), item[begin].tolist()):
        if r not in best or (size, -at_word, -i) > (best[r][0], -best[r][1], -best[r][2]):
            best[r] = (size, at_word, i)
    return best


def _union(old: bytes | None, words: np.ndarray) -> tuple[bytes, int]:
    """Runs of hit words (pairs of 32-bit start and stop) with more words, and their words."""
    if old:
        pairs = np.frombuffer(old, "<u4").reshape(-1, 2).astype(np.int64)
        words = np.concatenate([words, *[np.arange(a, b) for a, b in pairs]])
    words = np.unique(words)
    cut = np.flatnonzero(np.diff(words) > 1)
    starts = words[np.append(0, cut + 1)] if len(words) else words
    stops = words[np.append(cut, len(words) - 1)] + 1 if len(words) else words
    return np.stack([starts, stops], axis=1).astype("<u4").tobytes(), len(words)


def _before(a: tuple, b: tuple) -> bool:
    """Whether match a (words, place, item) is the one to report rather than b."""
    key = [(-size, place, name is None, name or "") for size, place, name in (a, b)]
    return key[0] < key[1]


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items in parts whose text fits the limit in expectation."""
    items = only(benchmark, item_id="item_id", text="text").filter("text IS NOT NULL") \
        .select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // limit)) if total > limit else 1
    if n == 1:
        return [items]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [items.filter(part == k) for k in range(n)]


def _meet(docs: DataFrame, suffixes: Suffixes) -> DataFrame:
    """Search one block: rows with the columns ``STATE`` to the same with more found."""
    def run(batches):
        for batch in batches:
            text, old_hits, old_items, old_size, old_at, old_item = (batch.column(names.index(k)) for k in STATE)
            data, offsets = at.utf8(text)
            hits, items = old_hits.to_pylist(), old_items.to_pylist()
            size, place, name = old_size.to_pylist(), old_at.to_pylist(), old_item.to_pylist()
            n_words = np.zeros(len(hits), np.int64)
            for i, j in at.pieces(offsets):
                part, local = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, stops, first = at.word_bounds(part, local, at.ALNUM_LOWER)
                n_words[i:j] = np.diff(first)
                number = suffixes.numbers(at.word_hashes(part, starts, stops, at.ALNUM_LOWER))
                found = suffixes.search(number, first)
                if not found.shape[1]:
                    continue
                best = longest(found)
                found = found[:, np.argsort(found[0], kind="stable")]
                rows, begin = np.unique(found[0], return_index=True)
                for r, a, b in zip(rows.tolist(), begin, np.append(begin[1:], found.shape[1])):
                    words, runs = np.unique(found[1:3, a:b], axis=1)
                    hit = np.unique(np.concatenate([np.arange(w, w + m) for w, m in zip(words, runs)])) - first[r]
                    hits[i + r] = _union(hits[i + r], hit)[0]
                    seen = {suffixes.names[k] for k in np.unique(found[3, a:b])} - {None}
                    items[i + r] = sorted(seen.union(items[i + r] or ()))
                    new = (best[r][0], int(best[r][1] - first[r]), suffixes.names[best[r][2]])
                    if not size[i + r] or _before(new, (size[i + r], place[i + r], name[i + r])):
                        size[i + r], place[i + r], name[i + r] = new
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(carried))]
                + [text, pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())),
                   pa.array(size, pa.int64()), pa.array(place, pa.int64()), pa.array(name, pa.string()),
                   pa.array(n_words)], names=names + ["_n_words"])

    carried = [c for c in docs.columns if c not in (*STATE, "_n_words")]
    names = [*carried, *STATE]
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*carried).schema)
    return docs.select(*names).mapInArrow(
        run, f"{kept}_text string, _hits binary, _items array<string>, _longest long, _longest_at long, "
             "_longest_item string, _n_words long")


def searched(docs: DataFrame, benchmark: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with what each text shares with the benchmark, in the columns ``STATE``.

    The text itself travels once, as the first of them.
    """
    state = docs.withColumnRenamed("text", "_text").select(
        "*", F.lit(None).cast("binary").alias("_hits"),
        F.lit(None).cast("array<string>").alias("_items"), F.lit(0).cast("long").alias("_longest"),
        F.lit(None).cast("long").alias("_longest_at"), F.lit(None).cast("string").alias("_longest_item"))
    for k, block in enumerate(blocks(benchmark, limit)):
        suffixes = Suffixes([(r[0], r[1]) for r in block.collect()])
        state = _meet(stored(state) if k else state, suffixes)
    return state


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark.

    The other columns travel in one, so none of them can clash with the search's own.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("_row"), "text")
    return searched(packed, benchmark, **settings).filter("_hits IS NULL") \
        .select(*[F.col("_text" if c == "text" else f"_row.`{c}`").alias(c) for c in docs.columns])


def find(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """What each document shares with the benchmark (columns ``OUT``)."""
    state = searched(only(docs, doc_id="doc_id", text="text"), benchmark, **settings)

    def finish(batches):
        for batch in batches:
            hits, items = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n_hit = [_union(h, np.zeros(0, np.int64))[1] if h else 0 for h in hits]
            digest = [hashlib.sha256(",".join(i or ()).encode()).hexdigest() for i in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(n_hit, pa.int64()),
                 pa.array([len(i or ()) for i in items], pa.int64()), pa.array(digest),
                 pa.array([n > 0 for n in n_hit]), *batch.columns[4:]],
                names=[c.split()[0] for c in OUT.split(", ")])

    return state.select("doc_id", "_hits", "_items", "_n_words", "_longest", "_longest_at", "_longest_item") \
        .mapInArrow(finish, OUT)


#: The same in DuckDB.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, coalesce(item_id::VARCHAR, chr(0) || row_number() OVER ()) AS own, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
bw AS (SELECT item, own, l, array_to_string(w[i:i + l - 1], ' ') AS s FROM (SELECT item, own, w, least(10, len(w)) AS l,
    unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS s FROM (SELECT r, w, l,
    unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw))),
m AS (SELECT r, i, l, item, own FROM dw JOIN bw USING (l, s)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM m WHERE item IS NOT NULL) GROUP BY r),
c AS (SELECT DISTINCT r, item, own, ip - i AS k, i, l FROM (SELECT m.r, m.item, m.own, m.i, m.l, p.ip FROM m JOIN dw USING (r, i, l)
    JOIN (SELECT own, i AS ip, l, array_to_string(w[i:i + l - 1], ' ') AS s FROM (SELECT own, w, least(10, len(w)) AS l,
        unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)) p
        ON p.own = m.own AND p.l = m.l AND p.s = dw.s)),
g AS (SELECT *, i - row_number() OVER (PARTITION BY r, own, k ORDER BY i) AS run FROM c),
e AS (SELECT r, item, min(i) - 1 AS at_word, max(i + l) - min(i) AS size FROM g GROUP BY r, item, own, k, run),
x AS (SELECT r, size, at_word, item FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY size DESC, at_word, item) AS o
    FROM e) WHERE o = 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
    coalesce(size, 0)::BIGINT AS longest, at_word::BIGINT AS longest_at, item AS longest_item
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r) LEFT JOIN x USING (r)
"""
