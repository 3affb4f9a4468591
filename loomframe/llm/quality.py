"""Quality rules: fixed base rules, and fences from quantile sketches per language and source.

``measures`` counts what the rules look at, over whole texts, in Arrow batches. ``sketches``
summarises each measured ratio, and what it is a ratio of, per (lang, source) as counts in
buckets whose width grows with the value (relative error 1/16). Two sketches are merged by
adding their counts, which is what the map-side aggregate does, and what joins small groups
into their language's sketch. ``judge`` joins the fences derived from them to every document.

A fence lies ``STEPS`` quartile distances outside a group's quartiles. Most documents have no
symbol, no repeated line and no repeated words, so those quartiles are often all 0; there the
fence is what ``EVENTS`` occurrences make up in a document of the group's median size. So a
source of long documents gets lower fences than one of short ones. Mean word length has a
fence on either side; there, an occurrence is a word of twice the usual length, and where
both quartiles are one (copies may fill a source) the fence is as far away as the language's.

Null text has no words and fails the base rules. A null language or source is a group of
its own. Repeated rows are judged one by one, alike. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.llm import arrow_text as at
from loomframe.llm.shared import stored

SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))

#: Groups with fewer documents use their language's sketch, and languages that of all.
LEAST_GROUP = 50
#: Quartile distances, and occurrences in a document of median size, that a fence lies away.
STEPS, EVENTS = 4, 4
#: Words that one occurrence of a repeated run makes up at least: both of its places.
REPEAT = 10

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_lines long")


def repeated_words(h: np.ndarray, first: np.ndarray, width: int = 5) -> np.ndarray:
    """For each row, words inside runs of ``width`` words that the row has at least twice."""
    n, rows = len(h), len(first) - 1
    runs = at.run_hashes(h, width)
    if not len(runs):
        return np.zeros(rows, np.int64)
    row = np.repeat(np.arange(rows), np.diff(first))
    runs = at.mix(runs + row[:len(runs)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    inside = row[:len(runs)] == row[width - 1:]
    where = np.flatnonzero(inside)
    order = np.argsort(runs[where], kind="stable")
    ordered = runs[where][order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(where), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(n + 1, np.int64)
    step[where[twice]] += 1
    step[where[twice] + width] -= 1
    return at.per_row(np.cumsum(step)[:n] > 0, first)


def _measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    starts, stops, first = at.word_bounds(data, offsets, at.SPACED)
    h = at.word_hashes(data, starts, stops, at.SPACED)
    in_word = at.SPACED[0][data].view(bool) & at.code_points(data)
    dup, lines = [], []
    for a, b in zip(offsets[:-1], offsets[1:]):
        worded = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
        lines.append(len(worded))
        dup.append(len(worded) - len(set(worded)))
    return [np.diff(first), at.per_row(in_word, offsets), at.per_row(_IS_SYMBOL[data], offsets),
            np.array(dup, np.int64), repeated_words(h, first), np.array(lines, np.int64)]


def measures(docs: DataFrame, carry: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The named columns and the counts of every document (columns in ``MEASURES``)."""
    def run(batches):
        for batch in batches:
            text = batch.num_columns - 1
            data, offsets = at.utf8(batch.column(text))
            parts = [_measure(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                     for i, j in at.pieces(offsets)]
            if parts:
                yield pa.RecordBatch.from_arrays(
                    batch.columns[:text] + [pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)],
                    names=names)
    names = [*carry, *[m.split()[0] for m in MEASURES.split(", ")]]
    slim = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_measured"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema[:-1])
    return slim.mapInArrow(run, f"{kept}, {MEASURES}")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ratios() -> dict[str, Column]:
    def of(top: Column, bottom: str) -> Column:
        return F.floor(top / F.greatest(F.col(bottom), F.lit(1))).cast("long")
    return {"symbols": of(1000 * F.col("n_symbols"), "word_chars"),
            "dup_lines": of(1000 * F.col("n_dup_lines"), "n_lines"),
            "repeats": of(1000 * F.col("n_repeat_words"), "n_words"),
            "word_length": of(10 * F.col("word_chars"), "n_words")}


def sizes() -> dict[str, Column]:
    """How many occurrences would make up a whole document, by ratio."""
    return {"symbols": F.col("word_chars"), "dup_lines": F.col("n_lines"),
            "repeats": F.floor(F.col("n_words") / REPEAT).cast("long"), "word_length": F.col("n_words")}


def bucket(value: Column) -> Column:
    """Bucket of a whole number from 0: itself below 32, then 16 buckets for each doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return (16 * shift + F.floor(value / F.pow(F.lit(2.0), shift))).cast("int")


def bucket_top(index: Column) -> Column:
    """Largest number of a bucket."""
    shift = F.greatest(F.floor(index / 16) - 1, F.lit(0))
    return ((index - 16 * shift + 1) * F.pow(F.lit(2.0), shift)).cast("long") - 1


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, ratio, bucket, n: the sketch of every ratio and size of every group.

    One row per group, ratio and occupied bucket (some hundred each), however many documents.
    """
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("ratio"), bucket(value).alias("bucket"))
                               for name, value in [*ratios().items(), *[
                                   (f"size_{k}", v) for k, v in sizes().items()]]])).alias("r")
    return (measured.filter(~base_failed()).select("lang", "source", each)
            .groupBy("lang", "source", "r.ratio", "r.bucket").agg(F.count(F.lit(1)).alias("n")))


#: Ratio and side of every fence.
FENCES = ("most_symbols", "most_dup_lines", "most_repeats", "most_word_length", "least_word_length")


def fences(sketch: DataFrame, least_group: int = LEAST_GROUP, steps: int = STEPS,
           events: int = EVENTS) -> DataFrame:
    """lang, source and the fences (``FENCES``, accepted themselves) of every group."""
    merged = [sketch.withColumn("level", F.lit(0)),
              sketch.withColumns({"source": F.lit(None).cast("string"), "level": F.lit(1)}),
              sketch.withColumns({"source": F.lit(None).cast("string"),
                                  "lang": F.lit(None).cast("string"), "level": F.lit(2)})]
    every = merged[0].unionByName(merged[1]).unionByName(merged[2])
    counted = every.groupBy("level", "lang", "source", "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("level", "lang", "source", "ratio")
    ranked = counted.select("*", F.sum("n").over(group).alias("total"),
                            F.sum("n").over(group.orderBy("bucket")).alias("upto"))
    def quartile(part: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= part * F.col("total"), F.col("bucket")))

    names = [*ratios(), *[f"size_{k}" for k in sizes()]]
    quartiles = F.struct(F.max("total").alias("total"), F.max("low").alias("low"),
                         F.max("middle").alias("middle"), F.max("high").alias("high"), F.max("even").alias("even"))
    wide = (ranked.groupBy("level", "lang", "source", "ratio")
            .agg(F.max("total").alias("total"), quartile(1).alias("q1"), quartile(2).alias("q2"), quartile(3).alias("q3"))
            .select("*", (bucket_top(F.col("q1") - 1) + 1).alias("low"), bucket_top(F.col("q2")).alias("middle"),
                    bucket_top(F.col("q3")).alias("high"), (F.col("q1") == F.col("q3")).alias("even"))
            .groupBy("level", "lang", "source").pivot("ratio", names).agg(quartiles))

    def away(name: str) -> Column:
        occurrence = F.col("word_length.high") if name == "word_length" else F.lit(1000)
        occurring = F.floor(events * occurrence / F.greatest(F.col(f"size_{name}.middle"), F.lit(1)))
        return F.greatest(steps * (F.col(f"{name}.high") - F.col(f"{name}.low")), occurring).cast("long")

    fence = stored(wide.select(
        "level", "lang", "source", F.col("symbols.total").alias("total"),
        *[(F.col(f"{name}.high") + away(name)).alias(f"most_{name}") for name in ratios() if name != "word_length"],
        F.col("word_length.low").alias("low"), F.col("word_length.high").alias("high"), F.col("word_length.even").alias("even"),
        away("word_length").alias("away")))
    overall = fence.filter(F.col("level") == 2).first()  # one row, or none of an empty table
    level = [fence.filter(F.col("level") == k).alias(f"l{k}") for k in range(2)]
    both = level[0].join(level[1], F.col("l0.lang").eqNullSafe(F.col("l1.lang")), "left")

    def pick(name: str) -> Column:
        return F.when(F.col("l0.total") >= least_group, F.col(f"l0.{name}")) \
            .when(F.col("l1.total") >= least_group, F.col(f"l1.{name}")) \
            .otherwise(F.lit(overall and overall[name]).cast(fence.schema[name].dataType))
    far = F.greatest(pick("away"), F.when(pick("even"), F.col("l1.away")))
    lengths = {"most_word_length": pick("high") + far, "least_word_length": pick("low") - far}
    return both.select("l0.lang", "l0.source", *[(lengths[name] if name in lengths else pick(name)).alias(name)
                                                 for name in FENCES])


def _held_to(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Measured documents with the fences of their group, base_failed and kept."""
    m, f = measured.alias("m"), limits.alias("f")
    joined = m.join(f, F.col("m.lang").eqNullSafe(F.col("f.lang"))
                    & F.col("m.source").eqNullSafe(F.col("f.source")), "left")
    within = ratios()["word_length"] >= F.col("least_word_length")
    for name, value in ratios().items():
        within = within & (value <= F.col(f"most_{name}"))
    failed = base_failed()
    return joined.select("m.*", *FENCES, failed.alias("base_failed"),
                         F.when(failed, False).otherwise(within).alias("kept"))


def judge(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the fences each document was held to.

    Kept: passes the base rules and no ratio lies outside its group's fences.
    """
    measured = stored(measures(docs))
    limits = fences(stored(sketches(measured)), **settings)
    return _held_to(measured, limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *FENCES)


def passed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps; measured twice rather than joined by id.

    A row travels in one column, so its columns can't clash with what is measured.
    """
    limits = stored(fences(stored(sketches(measures(docs, ("lang", "source")))), **settings))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    measured = measures(docs.select(row, "lang", "source", "text"), ("_row", "lang", "source"))
    return _held_to(measured, limits).filter("kept").select("_row.*")


#: The same in DuckDB.
SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
runs AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS run
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT r, doc_id, lang, source, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines FROM w LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
    1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 10 * word_chars // greatest(n_words, 1) AS word_length FROM m),
b AS (SELECT lang, source, u.ratio, u.v FROM (SELECT lang, source, unnest([
    {ratio: 'symbols', v: symbols}, {ratio: 'dup_lines', v: dup_lines}, {ratio: 'repeats', v: repeats},
    {ratio: 'word_length', v: word_length}, {ratio: 'size_symbols', v: word_chars}, {ratio: 'size_dup_lines', v: n_lines},
    {ratio: 'size_repeats', v: n_words // 10}, {ratio: 'size_word_length', v: n_words}]) AS u FROM v WHERE NOT base_failed)),
s AS (SELECT lang, source, ratio, 16 * greatest(length(bin(v)) - 5, 0)
    + (v >> greatest(length(bin(v)) - 5, 0)::BIGINT) AS bucket FROM b),
c AS (SELECT level, lang, source, ratio, bucket, count(*) AS n FROM (SELECT 0 AS level, * FROM s
    UNION ALL SELECT 1, lang, NULL, ratio, bucket FROM s UNION ALL SELECT 2, NULL, NULL, ratio, bucket FROM s) GROUP BY ALL),
k AS (SELECT *, sum(n) OVER g AS total, sum(n) OVER (g ORDER BY bucket) AS upto FROM c
    WINDOW g AS (PARTITION BY level, lang, source, ratio)),
q AS (SELECT level, lang, source, ratio, max(total) AS total, min(bucket) FILTER (4 * upto >= total) - 1 AS b1,
    min(bucket) FILTER (4 * upto >= 2 * total) AS b2, min(bucket) FILTER (4 * upto >= 3 * total) AS b3 FROM k GROUP BY ALL),
t AS (SELECT *, b1 + 1 = b3 AS even, (b1 - 16 * greatest(b1 // 16 - 1, 0) + 1) * power(2, greatest(b1 // 16 - 1, 0))::BIGINT AS low,
    (b2 - 16 * greatest(b2 // 16 - 1, 0) + 1) * power(2, greatest(b2 // 16 - 1, 0))::BIGINT - 1 AS middle,
    (b3 - 16 * greatest(b3 // 16 - 1, 0) + 1) * power(2, greatest(b3 // 16 - 1, 0))::BIGINT - 1 AS high FROM q),
f AS (SELECT a.level, a.lang, a.source, a.ratio, a.total, a.low, a.high, a.even, greatest(4 * (a.high - a.low),
    4 * CASE a.ratio WHEN 'word_length' THEN a.high ELSE 1000 END // greatest(z.middle, 1)) AS away
    FROM t a JOIN t z ON z.level = a.level AND z.lang IS NOT DISTINCT FROM a.lang
        AND z.source IS NOT DISTINCT FROM a.source AND z.ratio = 'size_' || a.ratio),
o AS (SELECT a.lang, a.source, a.ratio, l.away AS of_lang, CASE WHEN a.total >= 50 THEN a WHEN l.total >= 50 THEN l
    ELSE g END AS f FROM f a JOIN f l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM a.lang AND l.ratio = a.ratio
    JOIN f g ON g.level = 2 AND g.ratio = a.ratio WHERE a.level = 0),
p AS (SELECT lang, source, ratio, (f.high + far)::BIGINT AS fence, (f.low - far)::BIGINT AS least
    FROM (SELECT *, CASE WHEN ratio = 'word_length' AND f.even THEN greatest(f.away, of_lang) ELSE f.away END AS far FROM o)),
x AS (SELECT lang, source, max(fence) FILTER (ratio = 'symbols') AS most_symbols,
    max(fence) FILTER (ratio = 'dup_lines') AS most_dup_lines, max(fence) FILTER (ratio = 'repeats') AS most_repeats,
    max(fence) FILTER (ratio = 'word_length') AS most_word_length,
    max(least) FILTER (ratio = 'word_length') AS least_word_length FROM p GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    CASE WHEN base_failed THEN false ELSE symbols <= most_symbols AND dup_lines <= most_dup_lines
        AND repeats <= most_repeats AND word_length BETWEEN least_word_length AND most_word_length END AS kept,
    most_symbols, most_dup_lines, most_repeats, most_word_length, least_word_length
FROM v LEFT JOIN x ON v.lang IS NOT DISTINCT FROM x.lang AND v.source IS NOT DISTINCT FROM x.source
"""
