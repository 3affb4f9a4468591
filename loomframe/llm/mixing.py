"""Mixing sources to target weights by entropy balancing.

Sources share all words by weight; no source gives more than ``MOST`` times its words, and
what it leaves is shared by the others, until none is above. A document's rate is what
changes the rates least (in relative entropy to one copy each) while every source meets its
target: ``min(MOST, exp(l * words / mean))`` with one dual variable ``l`` per source. The
convex dual is solved by Newton steps on the logarithm of the words taken, kept inside a
bracket that each step narrows.

Documents with the same source and words have the same rate, so all sums run over a table
of these classes with their numbers of documents. It is aggregated once; a source has at
most sqrt(2 * its words) classes, as k classes hold at least k * k / 2 words. A Newton step
is one aggregate by source. Sums are exact decimals, so a rerun takes the same steps.

Copies per class are rounded along each source's classes from long to short, so rounding
leaves at most half the longest document open. That gap is then filled with documents that
fit into it, longest first, in passes until none fits. In a class the extra copies go to the
first documents by a hash of their ids; places in classes come from range partitions, as a
class may hold a third of all rows. Only DataFrame functions are used.

Null texts have no words. Documents without words are taken once, which adds nothing. Null
sources are one source, the last. Repeated rows are documents of their own. An empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.llm.places import join_pieces, ranked, sorted_parts, unrolled
from loomframe.llm.shared import only, stored

WEIGHTS, MOST = (5, 2, 1), 3
#: Words by which a solved source may miss its target before rounding, and that as a share of it.
LOOSE, LOOSE_SHARE = 0.25, 1e-12
_SUM = "decimal(28,6)"
_SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; each word becomes one letter, with its spaces."""
    lead = F.concat(F.lit("x "), text)  # so that there is a word at all
    return F.coalesce(F.length(F.regexp_replace(lead, f"[^{_SPACE}]+[{_SPACE}]*", "x")) - 1, F.lit(0)).cast("long")


def shared_out(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to sources with ``source_size`` and ``weight``.

    Every pass gives what capped sources leave to the others; a capped one stays so.
    """
    exact = "decimal(38,0)"
    total, weights = sources.agg(F.sum(F.col("source_size").cast(exact)), F.sum(F.col("weight").cast(exact))).first()
    words, free, capped = total, weights, 0

    def above(words, free):
        return F.col("source_size").cast("decimal(18,0)") * most * int(free) <= F.col("weight").cast("decimal(9,0)") * F.lit(words).cast(exact)

    while free:
        full, full_weights, n = sources.filter(above(words, free)).agg(
            F.sum((F.col("source_size") * most).cast(exact)), F.sum(F.col("weight").cast(exact)), F.count(F.lit(1))).first()
        if n == capped:
            break
        words, free, capped = total - full, weights - full_weights, n
    limit = (F.col("source_size") * most).cast("double")
    if not free:
        return sources.withColumn("target", limit)
    share = F.col("weight").cast("double") * float(words) / float(free)
    return sources.withColumn("target", F.when(above(words, free), limit).otherwise(share))


def rate(lam: Column, words: Column, mean: Column, most: int = MOST) -> Column:
    return F.when(lam * words / mean >= math.log(most), F.lit(float(most))).otherwise(F.exp(lam * words / mean))


def solve(classes: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds the dual variable ``lam`` to sources (place, source_size, documents, shortest, target).

    ``classes`` has place, words and n (documents); ``shortest`` is the least words above 0.
    """
    size, target = F.col("source_size").cast("double"), F.col("target")
    mean = size / F.col("documents")
    least = F.col("shortest") / mean
    fixed = F.when((size == 0) | (target == size), F.lit(0.0)) \
        .when(target >= most * size, 2 * math.log(most) / least)  # all documents as often as may be
    state = stored(sources.filter("source_size > 0").select(
        "place", "target", mean.alias("mean"), F.coalesce(fixed, F.lit(0.0)).alias("lam"),
        F.when(target < size, F.log(target / size) / least).otherwise(F.lit(0.0)).alias("low"),
        F.when(target < size, F.lit(0.0)).otherwise(math.log(most) / least).alias("high"),
        fixed.isNotNull().alias("done")))
    while not state.filter("NOT done").isEmpty():
        open_ = state.filter("NOT done")
        r = rate(F.col("lam"), F.col("words"), F.col("mean"), most)
        each = classes.filter("words > 0").join(open_, "place").select("place", (F.col("n") * F.col("words") * r).alias("taken"),
                                            F.when(r < most, F.col("words") / F.col("mean")).otherwise(0.0).alias("tilt"))
        sums = each.groupBy("place").agg(F.sum(F.col("taken").cast(_SUM)).cast("double").alias("taken"),
                                         F.sum((F.col("taken") * F.col("tilt")).cast(_SUM)).cast("double").alias("slope"))
        over = F.col("taken") > F.col("target")
        narrowed = open_.join(sums, "place").withColumns({
            "high": F.when(over, F.col("lam")).otherwise(F.col("high")),
            "low": F.when(over, F.col("low")).otherwise(F.col("lam")),
            "newton": F.col("lam") - F.col("taken") * F.log(F.col("taken") / F.col("target")) / F.nullif("slope", F.lit(0.0))})
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        middle = (F.col("low") + F.col("high")) / 2
        met = F.abs(F.col("taken") - F.col("target")) <= F.greatest(F.lit(LOOSE), F.col("target") * LOOSE_SHARE)
        stuck = (middle <= F.col("low")) | (middle >= F.col("high"))  # neighbouring numbers
        state = stored(state.filter("done").unionByName(narrowed.select(
            "place", "target", "mean", F.when(met | stuck, F.col("lam")).when(inside, F.col("newton")).otherwise(middle).alias("lam"),
            "low", "high", (met | stuck).alias("done"))))
    return state.select("place", "target", "mean", "lam")


def whole_copies(classes: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """place, words, n and ``copies`` of each class: rates to whole numbers, gaps filled."""
    down = Window.partitionBy("place").orderBy(F.desc("words"))
    rated = classes.join(solved, "place", "left").withColumn(
        "rate", F.when(F.col("words") > 0, rate(F.col("lam"), F.col("words"), F.col("mean"), most)).otherwise(F.lit(1.0)))
    marked = rated.withColumn("mark", F.floor(F.sum(F.col("n") * F.col("rate")).over(
        down.rowsBetween(Window.unboundedPreceding, 0)) + 0.5))
    copies = F.least(F.col("n") * most, F.col("mark") - F.lag("mark", 1, 0).over(down))
    now = stored(marked.select("place", "words", "n", "rate", "target",
                               F.when(F.col("words") == 0, F.col("n")).otherwise(copies).alias("copies")))
    while True:
        gap = now.groupBy("place").agg((F.round(F.first("target")).cast("long") - F.sum(
            F.col("copies") * F.col("words"))).alias("gap")).filter("gap <> 0")
        room = F.when(F.col("gap") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
        open_ = now.join(gap, "place").withColumn("room", room) \
            .filter((F.col("words") > 0) & (F.col("room") > 0) & (F.col("words") <= F.abs("gap")))
        before = F.coalesce(F.sum((F.col("room") * F.col("words")).cast("decimal(38,0)")).over(
            down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        fits = F.floor((F.abs("gap") - before) / F.col("words")).cast("long")
        moves = stored(open_.select("place", "words", "gap", F.least("room", fits).alias("move")).filter("move > 0")
                       .select("place", "words", (F.signum("gap") * F.col("move")).cast("long").alias("move")))
        if moves.isEmpty():
            return now
        now = stored(now.join(moves, ["place", "words"], "left")
                     .withColumn("copies", F.col("copies") + F.coalesce("move", F.lit(0))).drop("move"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target (the source's), taken (words), copies and rate of every document."""
    own = only(docs, doc_id="doc_id", source="source", text="text")
    rows = unrolled(own.select("doc_id", "source", word_count(F.col("text")).alias("words")), "doc_id", "source", "words")
    key = ["source", "words"]
    ranged, pieces = sorted_parts(rows.withColumn("key", F.xxhash64("doc_id", "copy")), key, ["key", "doc_id", "copy"])
    named = stored(pieces.groupBy(*key).agg(F.max("size").alias("n")))
    sources = named.groupBy("source").agg(
        F.sum(F.col("words") * F.col("n")).alias("source_size"), F.sum("n").alias("documents"),
        F.min(F.when(F.col("words") > 0, F.col("words"))).alias("shortest"))
    # Nulls sort first; a flag in front puts them last.
    placed = ranked(sources.withColumn("last", F.col("source").isNull()), "last", "source")
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(placed.withColumn("weight", cycle))
    if sources.isEmpty():
        nothing = F.lit(0).cast("long")
        return docs.select("doc_id", nothing.alias("size"), nothing.alias("source_size"), F.lit(0.0).alias("target"),
                           nothing.alias("taken"), nothing.alias("copies"), F.lit(0.0).alias("rate")).filter("false")
    sources = stored(shared_out(sources, most))
    by_source = sources.select(F.col("source").alias("_source"), "place", "source_size", F.col("target").alias("wanted"))
    classes = stored(named.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    done = whole_copies(classes.select("place", "words", "n"), solve(classes.select("place", "words", "n"), sources, most), most)
    with_copies = classes.join(done.select("place", "words", "rate", "copies"), ["place", "words"])
    known = with_copies.select(F.col("source").alias("_source"), F.col("words").alias("_words"), "n", "rate", "copies",
                               "source_size", "wanted")
    told = pieces.join(known, pieces["source"].eqNullSafe(known["_source"]) & (pieces["words"] == known["_words"])) \
        .drop("_source", "_words")
    per = join_pieces(ranged, told, key)
    extra = (F.col("at") + F.col("shift") < F.col("copies") % F.col("n")).cast("long")
    each = F.floor(F.col("copies") / F.col("n")) + extra
    return per.select("doc_id", F.col("words").alias("size"), "source_size", F.col("wanted").alias("target"),
                      (each * F.col("words")).alias("taken"), each.alias("copies"), "rate")
