"""Token ids as files of canonical length-limited Huffman codes, and back.

The code is built from the counts of the ids over the whole corpus (package-merge, at most
``LONGEST`` bits), so both tables are as small as the vocabulary. A file is a row of frames;
a frame holds whole documents in ascending order::

    header   magic "LFHC", then as u64: bits, ids, documents, blocks
    bits     the codes of all ids in a row, most significant bit first, padded to 8 bytes
    blocks   u64 per block of BLOCK ids: the bit at which it starts (checkpoint)
    doc ids  i64, then u8 whether the id is null; u32 number of ids per document

Every block can be decoded by itself: a table of 2**LONGEST entries gives id and length for
the next bits. All blocks of a frame are decoded side by side.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomframe.llm import tokens
from loomframe.llm.shared import new_folder, only, open_new, open_old, stored

LONGEST, BLOCK = 16, 512
END_ID = 2
#: Ids in a frame before it is closed, and bytes in a file before the next one is begun.
FRAME, FILE_BYTES = 1 << 20, 128 << 20
_HEAD = struct.Struct("<4sQQQQ")


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each symbol's code (0: does not occur), by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << longest:
        raise ValueError("more symbols than codes of this length")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    packages, taken = np.zeros(0, np.int64), []
    for _ in range(longest):
        merged = np.concatenate([leaves, packages])
        place = np.argsort(merged, kind="stable")
        taken.append(place < len(leaves))  # which of the sorted list are leaves
        merged = merged[place]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    want = 2 * len(leaves) - 2
    for is_leaf in reversed(taken):
        n = int(is_leaf[:want].sum())
        lengths[order[:n]] += 1
        want = 2 * (want - n)
    return lengths


class Code:
    """Canonical code: symbols by length, then number, get ascending codes."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        used = np.flatnonzero(lengths)
        order = used[np.argsort(lengths[used], kind="stable")]
        size = lengths[order].astype(np.int64)
        left = np.concatenate([[0], np.cumsum(1 << (LONGEST - size))])[:-1]  # left-justified
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (left >> (LONGEST - size)).astype(np.uint64)
        self.symbol = np.repeat(order, 1 << (LONGEST - size)).astype(np.uint32)
        self.step = np.repeat(size, 1 << (LONGEST - size)).astype(np.uint8)
        missing = (1 << LONGEST) - len(self.symbol)
        self.symbol = np.concatenate([self.symbol, np.zeros(missing, np.uint32)])
        self.step = np.concatenate([self.step, np.ones(missing, np.uint8)])

    def encode(self, ids: np.ndarray) -> tuple[bytes, int, np.ndarray]:
        """Bit string, its length, and the first bit of every block."""
        size = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(size)
        bits = int(ends[-1]) if len(ids) else 0
        begins = ends - size
        words = np.zeros(bits // 64 + 2, np.uint64)
        if len(ids):
            word, room = begins >> 6, 64 - (begins & 63)
            shift = room - size
            code = self.codes[ids]
            here = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64),
                            code >> np.maximum(-shift, 0).astype(np.uint64))
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            words[word[first]] |= np.bitwise_or.reduceat(here, first)
            spill = np.flatnonzero(shift < 0)  # at most one code crosses into each word
            words[word[spill] + 1] |= code[spill] << (64 + shift[spill]).astype(np.uint64)
        return words.astype(">u8").tobytes(), bits, begins[::BLOCK]

    def decode(self, string: bytes, n: int, checkpoints: np.ndarray) -> np.ndarray:
        """The ``n`` ids; all blocks advance together, one id at a time."""
        data = np.frombuffer(string, np.uint8)
        data = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
        at = checkpoints.astype(np.int64).copy()
        out = np.zeros((min(BLOCK, n), len(at)), np.uint32)
        left = np.minimum(BLOCK, n - BLOCK * np.arange(len(at)))
        full = len(at) - (len(at) > 0 and left[-1] < BLOCK)
        for k in range(len(out)):
            if k >= left[-1]:
                at = at[:full]
            byte = at >> 3
            window = (data[byte] << 16) | (data[byte + 1] << 8) | data[byte + 2]
            key = (window >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
            out[k, :len(at)] = self.symbol[key]
            at = at + self.step[key]
        return out.T.reshape(-1)[:n] if len(out) == BLOCK else out.T.reshape(-1)


def write_frame(out, code: Code, docs: list[tuple[int | None, np.ndarray]]) -> int:
    """Append a frame; gives its ids."""
    ids = np.concatenate([d[1] for d in docs])
    string, bits, checkpoints = code.encode(ids)
    out.write(_HEAD.pack(b"LFHC", bits, len(ids), len(docs), len(checkpoints)))
    out.write(string)
    out.write(checkpoints.astype("<u8").tobytes())
    out.write(np.array([d[0] or 0 for d in docs], "<i8").tobytes())
    out.write(np.array([d[0] is None for d in docs], np.uint8).tobytes())
    out.write(np.array([len(d[1]) for d in docs], "<u4").tobytes())
    return len(ids)


def read_frames(source, code: Code) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a file in order."""
    while head := source.read(_HEAD.size):
        magic, bits, n, docs, blocks = _HEAD.unpack(head)
        if magic != b"LFHC":
            raise ValueError("not a frame")
        string = source.read((bits // 64 + 2) * 8)
        checkpoints = np.frombuffer(source.read(8 * blocks), "<u8")
        doc_id = np.frombuffer(source.read(8 * docs), "<i8").tolist()
        null = source.read(docs)
        size = np.frombuffer(source.read(4 * docs), "<u4")
        ids = code.decode(string, n, checkpoints)
        for d, is_null, part in zip(doc_id, null, np.split(ids, np.cumsum(size)[:-1])):
            yield None if is_null else d, part


def token_ids(docs: DataFrame, vocabulary: str, end_id: int = END_ID, apart: bool = True) -> DataFrame:
    """doc_id, ids (little-endian 32-bit, with the end id), crc (of the ids) of whole texts."""
    end = np.array([end_id], tokens.ID_TYPE).tobytes()

    def run(batches):
        encode = tokens.encoder(vocabulary, apart)
        for batch in batches:
            for first, last in tokens.batches(batch.column(1)):
                part = batch.slice(first, last - first)
                ids = [x + end for x in encode(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_narrow(x) for x in ids], pa.binary()),
                     pa.array([zlib.crc32(x) for x in ids], pa.int64())], names=["doc_id", "ids", "crc"])
    return only(docs, doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, ids binary, crc long")


def _narrow(ids: bytes) -> bytes:
    """First byte 2 or 4: bytes per id that follow."""
    wide = np.frombuffer(ids, tokens.ID_TYPE)
    if len(wide) and wide.max() > 0xFFFF:
        return b"\4" + ids
    return b"\2" + wide.astype("<u2").tobytes()


def _widen(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, f"<u{ids[0]}", offset=1).astype(np.uint32)


def count_ids(encoded: DataFrame) -> np.ndarray:
    """Occurrences of each id; as long as the vocabulary."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            held = {2: [], 4: []}  # by bytes per id
            for x in batch.column(0).to_pylist():
                held[x[0]].append(x[1:])
            for wide, parts in held.items():
                part = np.bincount(np.frombuffer(b"".join(parts), f"<u{wide}"), minlength=len(total))
                part[:len(total)] += total
                total = part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())],
                                         names=["id", "n"])
    rows = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r[0] for r in rows), default=0) + 1, np.int64)
    for i, n in rows:
        counts[i] = n
    return counts


def write(encoded: DataFrame, code: Code, folder: str, parts: int) -> DataFrame:
    """Write the files below ``folder`` in ascending doc_id order; gives the list of files.

    The list is a stored table (part, seq, path, ids), so files of tasks that were lost or
    ran twice are never read.
    """
    def run(batches):
        part, seq, open_file, frame, held, written = None, 0, None, [], 0, 0

        def close():
            out, path, _ = open_file
            out.__exit__(None, None, None)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([path]),
                 pa.array([written], pa.int64())], names=["part", "seq", "path", "ids"])

        for batch in batches:
            for p, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                part = p
                if open_file is None:
                    path = f"{folder}/{part:06d}-{seq:04d}-{uuid.uuid4().hex}.lfh"
                    out = open_new(path)
                    open_file = (out, path, out.__enter__())
                frame.append((doc, _widen(ids.as_py())))
                held += len(frame[-1][1])
                if held >= FRAME:
                    written += write_frame(open_file[2], code, frame)
                    frame, held = [], 0
                    if open_file[2].tell() >= FILE_BYTES:
                        yield close()
                        seq, open_file, written = seq + 1, None, 0
        if frame:
            written += write_frame(open_file[2], code, frame)
        if open_file:
            yield close()

    ranged = encoded.repartitionByRange(parts, "doc_id", "crc").sortWithinPartitions("doc_id", "crc") \
        .select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "ids")
    return stored(ranged.mapInArrow(run, "part long, seq long, path string, ids long"))


def read(files: DataFrame, code: Code) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the listed files."""
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = files.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                with open_old(path) as source:
                    for doc, ids in read_frames(source, code):
                        rows.append((doc, base, len(ids), zlib.crc32(ids.astype(tokens.ID_TYPE).tobytes())))
                        base += len(ids)
                        if len(rows) == 5000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)
    n = max(1, files.count())
    return based.select("path", "base").repartition(n).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None,
               folder: str | None = None, rows_each: int = 8000) -> DataFrame:
    """Encode whole texts, write them as coded files, and report what the files hold.

    Null text is empty and has only the end id. Documents with a null id come first; equal
    ids are ordered by the checksum of their ids. An empty table gives no files and no rows.
    More than 2 ** ``LONGEST`` distinct ids have no code of that length, and raise ValueError.
    """
    encoded = token_ids(docs, vocabulary or tokens.default_vocabulary())
    path = new_folder(spark, "ids")
    encoded.write.option("compression", "zstd").parquet(path)
    encoded = spark.read.schema(encoded.schema).parquet(path)
    code = Code(code_lengths(count_ids(encoded)))
    parts = max(1, -(-encoded.count() // rows_each))
    return read(write(encoded, code, folder or new_folder(spark, "huffman"), parts), code)
