"""Manifest, mixture and centroid clustering: awkward rows, brute force, split groups."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from compare import compare, connect
from conftest import SMALL
from pyspark.sql import functions as F

from loomframe.llm import centroids, manifest, mixing, places
from loomframe.llm.shared import ready, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, "   \n\t ", "en", None, 5), (4, "One Two three", "en", "a", 1),
    (5, "One Two three", "en", "a", 1), (5, "One Two three", "en", "a", 1), (6, "w " * 3_000, "en", "b", 1),
    (7, "éé ßß 日本語 ÄÖ", "fr", "é", 1), (8, "one", None, None, 3), (9, "x" * 50_000, "de", "", 1),
    (None, "No Id", "en", "a", 1), (None, "No Id", "en", "a", 1), (10, "\x00 odd \x1c \x85 here", "en", "\U0001f600", 1)]
CLASHING = ["part", "at", "copy", "size", "leaf", "tree", "words", "key", "place", "v", "item", "path"]


@pytest.fixture(scope="module")
def docs(spark):
    ready(spark)
    return spark.createDataFrame(AWKWARD, DOCS).withColumns({c: F.lit("mine") for c in CLASHING}).repartition(3)


def rows(df):
    return [tuple(r) for r in df.collect()]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def plain_tree(leaves, fanout):
    """The top, and each leaf's (left, right) by level."""
    paths, level, owner = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, owners = [], []
        for first in range(0, len(level), fanout):
            run = level[first:first + fanout]
            for k in range(len(run)):
                for leaf in owner[first + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(sha(*run))
            owners.append([x for o in owner[first:first + fanout] for x in o])
        level, owner = above, owners
    return level[0], paths


def plain_manifest(docs, fanout):
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars in docs:
        groups[source].append(((doc_id is not None, doc_id), plain_leaf(doc_id, source, lang, n_chars, text),
                               (doc_id, text, lang, source, n_chars)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    low = [plain_tree([leaf for _, leaf, _ in sorted(groups[s], key=lambda x: x[:2])], fanout) for s in order]
    root, high = plain_tree([top for top, _ in low], fanout)
    out = []
    for s, (top, paths), upper in zip(order, low, high):
        for (_, leaf, (doc_id, text, lang, source, n_chars)), path in zip(sorted(groups[s], key=lambda x: x[:2]), paths):
            path = path + upper
            changed = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
                low_text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
                changed = plain_leaf(doc_id, source, lang, n_chars, low_text)
            for left, right in path:
                changed = sha(left, changed, right)
            out.append((doc_id, leaf, top, root, sha(*[left + right for left, right in path]), changed, changed == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest_of_awkward_rows(docs, fanout):
    assert sorted(rows(manifest.verify(docs, fanout=fanout)), key=repr) == plain_manifest(AWKWARD, fanout)


def test_manifest_of_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "Abc", "en", "a", 3)], DOCS)
    assert rows(manifest.verify(one)) == plain_manifest([(5, "Abc", "en", "a", 3)], 16)
    assert rows(manifest.verify(one.filter("false"))) == []


def test_manifest_of_a_large_group(spark):
    """Three levels in one source, beside sources of one row; partitions cut the source."""
    data = [(i, f"T {i * i}", "en", "hot" if i % 4 else f"s{i}", i) for i in range(700)]
    got = sorted(rows(manifest.verify(spark.createDataFrame(data, DOCS).repartition(5))), key=repr)
    assert got == plain_manifest(data, 16)


def test_manifest_paths_lead_to_the_root_only_from_their_leaf(spark):
    docs = table(spark, SMALL, "documents")
    own = docs.select("doc_id", "source", manifest.leaf(F.col("doc_id"), F.col("text")).alias("leaf"))
    made = manifest.manifest(own, "source", ["doc_id"], 4)
    got = made.leaves.select(manifest.fold(F.col("leaf"), F.col("path")).alias("a"),
                             manifest.fold(F.reverse("leaf"), F.col("path")).alias("b")).collect()
    assert {r.a for r in got} == {made.root} and made.root not in {r.b for r in got}
    assert made.groups.count() == docs.select("source").distinct().count()


def test_places_of_rows(spark):
    rng = random.Random(3)
    data = [(rng.choice("aab") if rng.random() < .9 else None, rng.randrange(50), i) for i in range(2_000)]
    df = spark.createDataFrame(data, "g string, x long, i long").repartition(7)
    ranged, pieces = places.sorted_parts(df, ["g"], ["x", "i"], rows_each=100)
    assert ranged.groupBy("part").count().agg(F.max("count")).first()[0] < 400
    got = {(r.g, r.x, r.i): (r.place, r.size) for r in places.join_pieces(ranged, pieces, ["g"]).select(
        "g", "x", "i", (F.col("at") + F.col("shift")).alias("place"), "size").collect()}
    for g in ("a", "b", None):
        own = sorted((x, i) for h, x, i in data if h == g)
        assert [got[g, x, i] for x, i in own] == [(k, len(own)) for k in range(len(own))]


def plain_targets(sizes, weights, most):
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(w for s, w in weights.items() if s not in capped)
        above = {s for s in sizes if s not in capped and left * weights[s] >= most * sizes[s] * free}
        if not above:
            return {s: most * sizes[s] if s in capped else left * weights[s] / free for s in sizes}
        capped |= above


def check_mix(data, got, weights=(5, 2, 1), most=3):
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for _, text, *_ in data]
    sizes = collections.Counter()
    for n, (_, _, _, source, _) in zip(words, data):
        sizes[source] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = plain_targets(sizes, {s: weights[i % len(weights)] for i, s in enumerate(order)}, most)
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted(
        (d[0], n) for d, n in zip(data, words) if d[0] is not None)
    assert len(got) == len(data)
    source_of = {d[0]: d[3] for d in data}
    by_source = collections.defaultdict(list)
    for r in got:
        s = source_of[r.doc_id]
        by_source[s].append(r)
        assert r.source_size == sizes[s] and math.isclose(r.target, targets[s], rel_tol=1e-12, abs_tol=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= most
    for s, own in by_source.items():
        if not sizes[s]:
            continue
        # The rates are of the dual's form, meet the target, and the copies come near it.
        mean = sizes[s] / len(own)
        duals = [math.log(r.rate) * mean / r.size for r in own if r.size and r.rate < most]
        assert not duals or max(duals) - min(duals) < 1e-6 * max(1, abs(max(duals)))
        assert abs(sum(r.rate * r.size for r in own) - targets[s]) < 0.3
        gap = round(targets[s]) - sum(r.taken for r in own)
        movable = [r.size for r in own if r.size and (r.copies < most if gap > 0 else r.copies > 0)]
        assert gap == 0 or not movable or min(movable) > abs(gap)
    return by_source


def test_mixture_of_the_small_table(spark):
    docs = table(spark, SMALL, "documents")
    got = mixing.mix(docs).collect()
    data = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    check_mix(data, got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))


def test_mixture_of_awkward_rows(docs):
    got = mixing.mix(docs).collect()
    check_mix(AWKWARD, got)
    assert {(1, 0), (2, 0), (3, 0)} <= {(r.doc_id, r.taken) for r in got}
    assert rows(mixing.mix(docs.filter("false"))) == []
    assert {r.taken for r in mixing.mix(docs.filter("doc_id < 4")).collect()} == {0}


def test_mixture_spreads_a_class_over_partitions(spark):
    """Copies of one text are a third of all rows; their extra copies go by hash, not by order."""
    rng = random.Random(5)
    data = [(i, "same text here" if i % 3 == 0 else "w " * rng.randrange(1, 60), "en", "abcd"[i % 4], 0) for i in range(900)]
    got = mixing.mix(spark.createDataFrame(data, DOCS)).collect()
    by_source = check_mix(data, got)
    for own in by_source.values():
        same = {r.copies for r in own if r.size == 3}
        assert max(same) - min(same) <= 1
        for a in own:  # per class, copies follow rates up to rounding and the filled gap
            assert abs(a.copies - a.rate) <= 1 + 1e-9 or a.size <= max(r.size for r in own)


def test_words_are_counted_as_runs(spark):
    texts = ["", " ", "a", " a", "a ", "a\x0bb\x0c c\r\nd", "\x1ca\x1fb c", "é ü", None, "a" * 70_000 + " b"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string") \
        .select("i", mixing.word_count(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in got} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}


def plain_clusters(data, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in data
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    at = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        at = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(at)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = collections.Counter()
    for _, c, s in out:
        sums[c] += s
    return sorted(((i, c, s, sums[c], sum(sums.values()), sha(",".join(map(str, at[c])))) for i, c, s in out), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows(dims, n=80):
    rng = random.Random(dims)
    # Few distinct values: ties between centroids, empty centroids, repeated vectors.
    data = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.004, 2.0]) for _ in range(dims)]) for i in range(n)]
    inf, nan = float("inf"), float("nan")
    data += [(0, data[1][1]), (None, data[2][1]), (500, None), (501, []), (502, [0.5] * (dims - 1)), (503, [0.5] * (dims + 1)),
             (504, [None] + [0.5] * (dims - 1)), (505, [nan] + [0.5] * (dims - 1)), (506, [inf] * dims), (507, [-inf] * dims),
             (508, [2e5] * dims), (509, [-2e5] * dims)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data]


@pytest.mark.parametrize("dims, cells", [(64, centroids.CELLS), (64, 4_000), (64, 40), (6, 900), (1, 1 << 20)])
def test_clusters_against_brute_force(spark, dims, cells):
    """Few cells take narrow blocks, and a dictionary per batch where none is small enough."""
    data = vector_rows(dims)
    df = spark.createDataFrame([(i, v, 1) for i, v in data], VECTORS).withColumns({c: F.lit(1) for c in CLASHING})
    got = centroids.report(df.repartition(4), dimensions=dims, centroids=7, cells=cells)
    assert sorted(rows(got), key=repr) == plain_clusters(data, 7, centroids.ROUNDS, dims)


def test_clusters_of_few_vectors_and_none(spark):
    few = spark.createDataFrame([(i, [float(i)] * 64, 0) for i in range(3)], VECTORS)
    assert sorted(r.distance for r in centroids.report(few).collect()) == [0, 0, 0]
    assert rows(centroids.report(few.filter("false"))) == []
    with pytest.raises(Exception, match="beyond"):
        centroids.report(spark.createDataFrame([(1, [3e38] * 64, 0)], VECTORS)).collect()


@pytest.mark.parametrize("width", [1, 2, 4, 8, 5])
def test_dictionaries_lose_nothing(width):
    vectors = np.random.default_rng(width).integers(-5, 5, (1_000, 64)).astype(np.int32)
    known = centroids.Dictionary.of(vectors, width)
    codes = known.encode(vectors)
    assert (known.decode(codes) == vectors).all() and known.first[-1] <= 64 // width * 1_000 + 1_000
    at = vectors[:9].astype(np.int64)
    full = ((vectors[:, None].astype(np.int64) - at[None]) ** 2).sum(2)
    best, distance = centroids.nearest(codes, known.distances(at))
    assert (best == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_new_sql_on_awkward_rows(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(str(tmp_path / "documents"))
    vectors = spark.createDataFrame([(i, v, 1) for i, v in vector_rows(64) if i != 506], VECTORS)
    vectors.coalesce(1).write.parquet(str(tmp_path / "embeddings"))
    con = connect(str(tmp_path))
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}/*.parquet')")
    assert compare(spark, con, "", lambda *_: manifest.verify(docs), manifest.SQL) is None
    assert compare(spark, con, "", lambda *_: centroids.report(vectors), centroids.SQL) is None
