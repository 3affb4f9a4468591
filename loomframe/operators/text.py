"""Bag-of-words features in long form: one row per (document, term)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.joins import skew_join
from loomframe.operators.ordered import groups_fit
from loomframe.session import spread, stored

# Fixed value: words of two or more letters, digits or underscores of any script.
WORD = r"[\p{L}\p{N}_]{2,}"

#: Base forms that are sent to all tasks; bytes of text in a block of documents, about.
SENT_ROWS, BLOCK_BYTES = 100_000, 8 << 20


def tokens(text: Column, lowercase: bool = True) -> Column:
    return F.regexp_extract_all(F.lower(text) if lowercase else text, F.lit(WORD), F.lit(0))


def term_counts(df: DataFrame, doc: str, text: str, stop: Sequence[str] | DataFrame = (),
                lexicon: DataFrame | None = None, lowercase: bool = True) -> DataFrame:
    """``(doc, term, tf)`` of all tokens, after stop words and the lexicon
    ``(token, base)``; a token without an entry stays as it is."""
    words = spread(df.select(doc, text)).select(doc, F.explode(tokens(F.col(text), lowercase)).alias("term"))
    if not isinstance(stop, DataFrame) and stop:
        words = words.filter(~F.col("term").isin(*stop))
    counts = words.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))
    if isinstance(stop, DataFrame):
        counts = counts.join(stop.select("term"), "term", "left_anti")
    if lexicon is None:
        return counts
    # Counted first: the lexicon meets each word of a document once.
    counts = stored(counts)
    table = lexicon.select(F.col("token").alias("term"), "base")
    based = skew_join(counts, table, ["term"], "left").withColumn(
        "term", F.coalesce("base", "term"))
    return based.groupBy(doc, "term").agg(F.sum("tf").alias("tf"))


def bag_of_words(df: DataFrame, doc: str, text: str, stop: Sequence[str] | DataFrame = (),
                 min_df: int = 2, lexicon: DataFrame | None = None,
                 lowercase: bool = True) -> DataFrame:
    """Term counts of the terms found in at least ``min_df`` documents.

    Documents are dealt out in blocks; what moves besides their text are the terms of each
    block with their counts, not the terms of each document. Where that is not possible
    (an id with very many rows, large tables of stop words or base forms) the counts are
    written once, since both the vocabulary and the result read them.
    """
    table = None if lexicon is None else stored(lexicon.select(F.col("token").alias("term"), "base"))
    few = table is None or table.limit(SENT_ROWS + 1).count() <= SENT_ROWS
    if min_df > 1 and few and not isinstance(stop, DataFrame) and groups_fit(df, [doc]):
        size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
        n = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // BLOCK_BYTES))
        return _known_in_blocks(_block_counts(df, doc, text, stop, table, lowercase, n), doc, min_df, n)
    counts = term_counts(df, doc, text, stop, lexicon, lowercase)
    if min_df <= 1:
        return counts
    counts = stored(counts)
    vocabulary = document_frequency(counts).filter(F.col("df") >= min_df)
    return skew_join(counts, vocabulary.select("term"), ["term"], "left_semi")


def _block_counts(df: DataFrame, doc: str, text: str, stop: Sequence[str], table: DataFrame | None,
                  lowercase: bool, n: int) -> DataFrame:
    """``(_block, doc, term, tf)`` with all rows of a block in one partition."""
    rows = df.select(doc, text)
    # Numbers that are dealt out to one partition each, so that no partition holds several blocks.
    own = F.pmod(F.hash("number"), F.lit(n))
    numbers = rows.sparkSession.range(32 * n).select(F.col("id").cast("int").alias("number")).groupBy(own).agg(
        F.min("number").alias("number")).collect()
    numbers = sorted(x["number"] for x in numbers)
    place = F.pmod(F.xxhash64(doc), F.lit(len(numbers))).cast("int")
    rows = rows.withColumn("_block", F.get(F.lit(numbers), place)).repartition(n, "_block")
    words = rows.select("_block", doc, F.explode(tokens(F.col(text), lowercase)).alias("term"))
    if stop:
        words = words.filter(~F.col("term").isin(*stop))
    counts = words.groupBy("_block", doc, "term").agg(F.count(F.lit(1)).alias("tf"))
    if table is None:
        return counts
    based = counts.join(F.broadcast(table), "term", "left").withColumn("term", F.coalesce("base", "term"))
    return based.groupBy("_block", doc, "term").agg(F.sum("tf").alias("tf"))


def _known_in_blocks(counts: DataFrame, doc: str, min_df: int, n: int) -> DataFrame:
    """The rows of terms with at least ``min_df`` rows."""
    own = counts.groupBy("_block", "term").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy("term"))  # at most one row per block
    known = own.withColumn("_df", total).filter(F.col("_df") >= min_df)
    known = known.repartition(n, "_block").select("_block", F.lit(None).cast(counts.schema[doc].dataType).alias(doc),
                                                  "term", F.lit(None).cast("long").alias("tf"))
    # A null count marks the row that says a term of the block is known.
    seen = F.bool_or(F.col("tf").isNull()).over(Window.partitionBy("_block", "term"))
    return counts.unionByName(known).withColumn("_seen", seen).filter(
        F.col("_seen") & F.col("tf").isNotNull()).select(doc, "term", "tf")


def document_frequency(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _l2(tf: DataFrame, doc: str, value: str) -> Column:
    """The value over the length of its document's vector (at most one row per term)."""
    own = Window.partitionBy(doc)
    return F.try_divide(F.col(value), F.sqrt(F.sum(F.col(value) * F.col(value)).over(own)))


def tf_l2(tf: DataFrame, doc: str) -> DataFrame:
    counts = tf.withColumn("tf", F.col("tf").cast("double"))
    return counts.select(doc, "term", _l2(counts, doc, "tf").alias("weight"))


def tfidf_l2(tf: DataFrame, doc: str, n: int | Column, strict: bool = False) -> DataFrame:
    """tf · idf, scaled to length 1 per document; idf = ln(n/df) + 1, or without
    the 1 when ``strict``, so that a term of all documents weighs nothing."""
    n = n if isinstance(n, Column) else F.lit(n)
    tf = stored(tf)
    idf = F.ln(n / F.col("df")) + (0 if strict else 1)
    # Written once, so that plans know how small the table is.
    weights = stored(document_frequency(tf).select("term", idf.alias("idf")))
    scored = skew_join(tf, weights, ["term"]).withColumn("weight", F.col("tf") * F.col("idf"))
    return scored.select(doc, "term", _l2(scored, doc, "weight").alias("weight"))


def doc_vectors(tf: DataFrame, vectors: DataFrame, doc: str, docs: DataFrame, size: int,
                unit: bool = True) -> DataFrame:
    """Sum of count · term vector per document of ``docs``; terms without a vector are
    skipped, and a document without a known term has the zero vector of ``size``."""
    known = skew_join(stored(tf), vectors.select("term", "vector"), ["term"])
    long = known.select(doc, "tf", F.posexplode("vector").alias("pos", "v"))
    sums = long.groupBy(doc, "pos").agg(F.sum(F.col("tf") * F.col("v")).alias("v"))
    # A document's list has one entry per vector component.
    found = sums.groupBy(doc).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"])
        .alias("vector"))
    zero = F.array_repeat(F.lit(0.0), size)
    whole = docs.select(doc).join(found, doc, "left").withColumn("vector", F.coalesce("vector", zero))
    if not unit:
        return whole
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))
    return whole.withColumn("vector", F.transform(
        "vector", lambda v: F.coalesce(F.try_divide(v, length), F.lit(0.0))))
