"""Centroid clustering on dictionary-encoded subvectors, exact in integers.

The dimensions are cut into blocks. The distinct subvectors of each block form a dictionary,
and a vector becomes one code per block; nothing is lost. Each round computes the squared
distance of every dictionary entry to every centroid's part once, on the driver, and ships
that table; a vector's distance to a centroid is the sum of the table's entries at its
codes. Sums for the new centroids are counts of codes times entries, again in integers.

Blocks are as wide as the dictionaries allow: of ``WIDTHS`` the widest with at most ``CELLS``
distances in the table (entries times centroids), found by one pass that stops collecting a
width once a task has seen too many of its subvectors. If even single dimensions have more
distinct values, every Arrow batch builds dictionaries of its own; the sums are the same.
So the driver and each task hold ``CELLS`` numbers and one batch at most.

Vectors with another number of components, null or non-finite ones, and null vectors are
left out. Values may be up to 2**26 in size; beyond that distances could leave 64 bits, and
an error says so. Null ids are never starts, unless too few others are there; of equal ids
the smaller vector starts. Repeated rows are vectors of their own. With fewer vectors than
centroids there is one centroid per vector; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.shared import Batches, map_batches, only, stored

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, 2
#: Widths of blocks that are tried, and numbers a distance table has at most.
WIDTHS, CELLS = (8, 4, 2, 1), 1 << 21
LARGEST = 1 << 26
#: Vectors looked at together.
CHUNK = 8192


def whole_numbers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and components as integers, of the complete vectors."""
    own = only(vectors, vec_id="vec_id", v="embedding").filter(F.size("v") == dimensions)
    fine = own.filter(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    number = F.transform("v", lambda x: F.when(
        F.abs(x.cast("double") * scale) <= LARGEST, F.floor(x.cast("double") * scale)).otherwise(F.raise_error(
            F.lit(f"a component is beyond {LARGEST} / {scale}"))))
    return fine.select("vec_id", number.cast("array<int>").alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _chunks(batches: Batches):
    """Arrow batches cut to rows that are looked at together."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def _keys(part: np.ndarray) -> np.ndarray:
    """One sortable value per subvector of 32-bit numbers."""
    part = np.ascontiguousarray(part, np.int32)
    kind = {1: np.int32, 2: np.int64}.get(part.shape[1], np.dtype((np.void, 4 * part.shape[1])))
    return part.view(kind).ravel()


class Dictionary:
    """The distinct subvectors of each block; codes count on from block to block."""

    def __init__(self, width: int, entries: list[np.ndarray]):
        self.width = width
        self.entries = [e[np.argsort(_keys(e))] for e in entries]
        self.first = np.concatenate([[0], np.cumsum([len(e) for e in entries])]).astype(np.int64)

    @classmethod
    def of(cls, vectors: np.ndarray, width: int) -> Dictionary:
        parts = [vectors[:, at:at + width] for at in range(0, vectors.shape[1], width)]
        return cls(width, [part[np.unique(_keys(part), return_index=True)[1]] for part in parts])

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        codes = np.empty((len(vectors), len(self.entries)), np.int64)
        for block, known in enumerate(self.entries):
            part = _keys(vectors[:, block * self.width:(block + 1) * self.width])
            codes[:, block] = np.searchsorted(_keys(known), part) + self.first[block]
        return codes

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([known[codes[:, block] - self.first[block]]
                               for block, known in enumerate(self.entries)], axis=1)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of each entry to each centroid's part."""
        table = np.zeros((self.first[-1], len(centroids)), np.int64)
        for block, known in enumerate(self.entries):
            rows = table[self.first[block]:self.first[block + 1]]
            for d in range(known.shape[1]):
                gap = known[:, d, None].astype(np.int64) - centroids[None, :, block * self.width + d]
                rows += gap * gap
        return table


def nearest(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (the smaller number of equal ones) and its distance."""
    total = np.zeros((len(codes), table.shape[1]), np.int64)
    for block in range(codes.shape[1]):
        total += table[codes[:, block]]
    best = total.argmin(1)
    return best, total[np.arange(len(total)), best]


def dictionary(vectors: DataFrame, dimensions: int, most: int) -> Dictionary | None:
    """With the widest blocks that need no more than ``most`` entries; None if none do."""
    def collect(batches: Batches):
        found = {w: [set() for _ in range(0, dimensions, w)] for w in WIDTHS}
        for batch in _chunks(batches):
            whole = _matrix(batch.column("v"))
            for w in [w for w in WIDTHS if found[w] is not None]:
                for seen, entries in zip(found[w], Dictionary.of(whole, w).entries):
                    seen.update(row.tobytes() for row in entries)
                if sum(map(len, found[w])) > most:
                    found[w] = None
        for w, blocks in found.items():
            listed = [(-1, b"")] if blocks is None else [(b, e) for b, es in enumerate(blocks) for e in es]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w] * len(listed), pa.int32()), pa.array([b for b, _ in listed], pa.int32()),
                 pa.array([e for _, e in listed], pa.binary())], ["width", "block", "entry"])

    seen = stored(map_batches(vectors.select("v"), collect, "width int, block int, entry binary").distinct())
    counts = seen.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("least")).collect()
    fits = [r["width"] for r in counts if r["least"] >= 0 and r["n"] <= most]
    if not fits:
        return None
    width = max(fits)
    blocks: list[list[bytes]] = [[] for _ in range(0, dimensions, width)]
    for r in seen.filter(F.col("width") == width).collect():
        blocks[r["block"]].append(bytes(r["entry"]))
    return Dictionary(width, [np.frombuffer(b"".join(es), np.int32).reshape(len(es), -1) for es in blocks])


class Encoded:
    """Stored vectors as codes of one dictionary, or as they are where none is small enough."""

    def __init__(self, vectors: DataFrame, dimensions: int, most: int):
        self.known = known = dictionary(vectors, dimensions, most)

        def encode(batches: Batches):
            for batch in _chunks(batches):
                codes = known.encode(_matrix(batch.column("v"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.FixedSizeListArray.from_arrays(
                    pa.array(codes.ravel()), codes.shape[1]).cast(pa.list_(pa.int32()))], ["vec_id", "v"])

        id_type = vectors.schema["vec_id"].dataType.simpleString()
        self.id_type = id_type
        self.rows = vectors if known is None else stored(
            map_batches(vectors, encode, f"vec_id {id_type}, v array<int>"))

    def scan(self, centroids: np.ndarray):
        """A function from batches to (ids, dictionary, codes, clusters, distances) of each chunk."""
        known = self.known
        table = None if known is None else known.distances(centroids)

        def look(batches: Batches):
            for batch in _chunks(batches):
                row = _matrix(batch.column("v"))
                own = Dictionary.of(row, 1) if known is None else known
                codes = own.encode(row) if known is None else row
                best, distance = nearest(codes, own.distances(centroids) if known is None else table)
                yield batch.column("vec_id"), own, codes, best, distance
        return look

    def sums(self, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
        """Vectors and componentwise sum of each centroid's vectors."""
        look, k, width = self.scan(centroids), len(centroids), centroids.shape[1]

        def add(batches: Batches):
            total = np.zeros((k, width + 1), np.int64)
            for _, own, codes, best, _ in look(batches):
                vectors = own.decode(codes).astype(np.int64)
                for c in np.unique(best):
                    chosen = vectors[best == c]
                    total[c, :width] += chosen.sum(0)
                    total[c, width] += len(chosen)
            c, d = np.nonzero(np.repeat(total[:, width:] > 0, width + 1, 1))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()),
                                              pa.array(total[c, d])], ["cluster", "d", "total"])

        out: dict[int, list[int]] = {}
        for r in map_batches(self.rows, add, "cluster int, d int, total long").groupBy("cluster", "d") \
                .agg(F.sum("total").alias("total")).collect():  # centroids times components
            out.setdefault(r["cluster"], [0] * (width + 1))[r["d"]] = r["total"]
        return {c: (v[width], v[:width]) for c, v in out.items()}

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        look = self.scan(centroids)

        def label(batches: Batches):
            for ids, _, _, best, distance in look(batches):
                yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance)],
                                                 ["vec_id", "cluster", "distance"])
        return map_batches(self.rows, label, f"vec_id {self.id_type}, cluster int, distance long")


def starts(vectors: DataFrame, centroids: int, seed: int) -> np.ndarray | None:
    """The vectors whose ids have the smallest hashes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(centroids).collect()
    return np.array([r["v"] for r in rows], np.int64) if rows else None


def cluster(embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            seed: int = SEED, cells: int = CELLS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance of every complete vector, and the final centroids."""
    vectors = stored(whole_numbers(embeddings, dimensions))
    at = starts(vectors, centroids, seed)
    if at is None:
        none = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none, np.zeros((0, dimensions), np.int64)
    encoded = Encoded(vectors, dimensions, max(1, cells // len(at)))
    for _ in range(rounds):
        at = at.copy()
        for c, (n, total) in encoded.sums(at).items():
            at[c] = [x // n for x in total]
    return encoded.assigned(at), at


def report(embeddings: DataFrame, **parameters) -> DataFrame:
    """The assignment with inertias and a hash of the vector's centroid."""
    rows, at = cluster(embeddings, **parameters)
    rows = stored(rows)
    inertia = {r["cluster"]: r["inertia"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    listed = [(c, inertia.get(c, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
              for c, v in enumerate(at.tolist())]
    clusters = rows.sparkSession.createDataFrame(
        listed, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(clusters), "cluster").select(  # one row per centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The same in DuckDB, one assignment and one update after another."""
    parts = [f"""WITH w AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x:
    CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {DIMENSIONS}
    AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS}),
x AS MATERIALIZED (SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM w),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM (SELECT v, row_number() OVER (
    ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) - 1 AS c FROM w) WHERE c < {CENTROIDS})"""]
    for k in range(ROUNDS + 1):
        parts.append(f"""a{k} AS MATERIALIZED (SELECT n, arg_min(c, (s, c)) AS c, min(s) AS s FROM (
    SELECT n, c, CAST(sum((x.x - c{k}.x) * (x.x - c{k}.x)) AS BIGINT) AS s FROM x JOIN c{k} USING (d) GROUP BY n, c) GROUP BY n)""")
        if k < ROUNDS:
            parts.append(f"""c{k + 1} AS MATERIALIZED (SELECT c, d, coalesce(m.x, c{k}.x) AS x FROM c{k} LEFT JOIN (
    SELECT c, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM a{k} JOIN x USING (n) GROUP BY c, d)) m USING (c, d))""")
    last = f"a{ROUNDS}"
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, s AS distance, CAST(sum(s) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(s) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM {last} JOIN w USING (n) JOIN (SELECT c, sha256(string_agg(x, ',' ORDER BY d)) AS h FROM c{ROUNDS} GROUP BY c) USING (c)
"""


SQL = _sql()
