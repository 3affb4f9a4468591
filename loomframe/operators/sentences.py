"""Sentence ends learnt from the texts themselves, without a word list.

One scan counts words, how often each stands with a full stop behind it, and what follows.
A word that has its full stop nearly always, is short or has stops inside is taken for an
abbreviation; a word that follows sure sentence ends far more often than it would by chance
is taken for a sentence starter. Both are decided by likelihood ratios over the counts
(Kiss and Strunk, Unsupervised Multilingual Sentence Boundary Detection, 2006). Then each
text is cut: ``!`` and ``?`` end a sentence; a full stop does unless its word is an
abbreviation or a single letter, and even then if a starter with a capital follows; dots in
a row do before a capital. Stops inside a token ("3.14") never end one.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.session import stored

#: Fixed values of the method: least scores, and the chance of a stop behind an abbreviation.
ABBREVIATION, STARTER, STOPPED = 0.3, 30.0, 0.99
SPACE = r"[\x09-\x0D\x20]+"
OPENING, CLOSING = r"^[\"'(\[{«“„]+", r"[\"')\]}»”,;:!?]+$"
#: How a token ends that may end a sentence, closing marks behind it allowed.
STRONG, DOTS, STOP = (rf"{end}[\"')\]}}»”]*$" for end in (r"[!?]", r"\.\.+|…", r"\."))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda t: t != "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value worked out once; inside a lambda an expression would be anew for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def with_next(words: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of each token and the one behind it (null behind the last)."""
    return bound(words, lambda w: F.zip_with(w, F.slice(w, 2, F.size(w)), use))


def core(token: Column) -> Column:
    """Without marks around it, but with a full stop at its end."""
    return F.regexp_replace(F.regexp_replace(token, OPENING, ""), CLOSING, "")


def stopped(token: Column) -> Column:
    c = core(token)
    return F.endswith(c, F.lit(".")) & ~F.endswith(c, F.lit(".."))


def word_type(token: Column) -> Column:
    """What is counted: lower case, one full stop at the end removed, numbers all alike."""
    word = F.lower(F.regexp_replace(core(token), r"\.$", ""))
    return F.when(F.regexp_like(word, F.lit(r"^[0-9][0-9.,]*$")), "##").otherwise(word)


@dataclass
class Rules:
    """``abbreviations`` and ``starters``: word and score (every word, with whether it counts)."""

    abbreviations: DataFrame
    starters: DataFrame

    def words(self) -> tuple[list[str], list[str]]:
        """The chosen words; a vocabulary's worth of text, not the texts'."""
        return tuple(sorted(r["word"] for r in t.filter("chosen").select("word").collect())
                     for t in (self.abbreviations, self.starters))


def _log_likelihood(hits: Column, n: Column, p: Column) -> Column:
    """Of so many hits in n trials with chance p; none and all are sure where p says so."""
    return F.when(hits > 0, hits * F.ln(p)).otherwise(0.0) + F.when(n > hits, (n - hits) * F.ln(1 - p)).otherwise(0.0)


def learn(df: DataFrame, text: str) -> Rules:
    """Abbreviations and sentence starters of the texts (nulls have no words)."""
    pairs = df.select(F.explode(with_next(tokens(F.col(text)), lambda t, following: F.struct(
        t.alias("token"), F.when(F.contains(t, F.lit(".")), following).alias("next")))).alias("t")).select("t.*")
    # Tokens are counted as they are first, so that patterns run once per distinct one.
    raw = pairs.groupBy("token", "next").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(raw.select(word_type(F.col("token")).alias("word"), stopped(F.col("token")).alias("stop"), F.when(
        stopped(F.col("token")), word_type(F.col("next"))).alias("next"), "n").filter("word <> ''")
        .groupBy("word", "stop", "next").agg(F.sum("n").alias("n")))
    total, stops = counts.agg(F.sum("n"), F.sum(F.when(F.col("stop"), F.col("n")))).first()
    total, stops = float(total or 0), float(stops or 0)
    with_stop = F.coalesce(F.sum(F.when(F.col("stop"), F.col("n"))), F.lit(0)).cast("double")
    each = counts.groupBy("word").agg(F.sum("n").cast("double").alias("n"), with_stop.alias("k"))
    n, k, word = F.col("n"), F.col("k"), F.col("word")
    inner = F.length(word) - F.length(F.replace(word, F.lit("."), F.lit("")))
    length = F.length(word) - inner + 1.0
    usual = F.lit(stops / total if total else 0.0)
    ratio = -2 * (_log_likelihood(k, n, usual) - _log_likelihood(k, n, F.lit(STOPPED)))
    score = ratio * F.exp(-length) * (inner + 1) * F.pow(length, k - n)
    fine = (k > 0) & F.regexp_like(word, F.lit(r"[\p{L}#]")) & F.lit(stops < total)
    rated = each.select("word", "n", "k", F.when(fine, score).alias("score"))
    abbreviations = stored(rated.select("word", "score", F.coalesce(F.col("score") >= ABBREVIATION, F.lit(False)).alias("chosen")))

    short = abbreviations.filter("chosen").select("word")
    sure = counts.filter(F.col("stop") & ~F.regexp_like("word", F.lit(r"^\p{L}$"))).join(short, "word", "left_anti")
    after = stored(sure.filter("next IS NOT NULL AND next <> ''").groupBy(F.col("next").alias("word")).agg(F.sum("n").cast("double").alias("both")))
    breaks = after.agg(F.sum("both")).first()[0] or 0.0
    both, b, t = F.col("both"), F.lit(breaks), F.lit(total)
    rest = F.greatest(n - both, F.lit(0.0))
    alone, there, else_ = n / t, both / b, rest / (t - b)
    gain = 2 * (_log_likelihood(both, b, there) + _log_likelihood(rest, t - b, else_)
                - _log_likelihood(both, b, alone) - _log_likelihood(rest, t - b, alone))
    known = after.join(each, "word").select("word", F.when(there > alone, gain).alias("score")) if 0 < breaks < total \
        else after.select("word", F.lit(None).cast("double").alias("score"))
    starters = stored(known.select("word", "score", F.coalesce(
        (F.col("score") >= STARTER) & F.regexp_like("word", F.lit(r"^\p{L}")), F.lit(False)).alias("chosen")))
    return Rules(abbreviations, starters)


def _among(value: Column, words: Collection[str]) -> Column:
    return value.isin(list(words)) if words else F.lit(False)


def sentences(text: Column, abbreviations: Collection[str], starters: Collection[str]) -> Column:
    """Array of sentences, each an array of tokens; null for null."""
    def ends(token: Column, following: Column) -> Column:
        capital = F.regexp_like(F.regexp_replace(following, OPENING, ""), F.lit(r"^\p{Lu}"))
        kind = word_type(token)
        held = _among(kind, abbreviations) | F.regexp_like(kind, F.lit(r"^\p{L}$"))
        stop = ~held | (capital & _among(word_type(following), starters))
        return following.isNull() | F.regexp_like(token, F.lit(STRONG)) | F.when(
            F.regexp_like(token, F.lit(DOTS)), capital).when(F.regexp_like(token, F.lit(STOP)), stop).otherwise(False)

    def cut(words: Column) -> Column:
        # The number of tokens up to each end, and up to the one before.
        flagged = F.transform(with_next(words, ends), lambda e, i: F.when(e, i + 1))
        return bound(F.filter(flagged, lambda e: e.isNotNull()), lambda lasts: F.zip_with(
            lasts, F.slice(F.concat(F.array(F.lit(0)), lasts), 1, F.size(lasts)),
            lambda last, before: F.slice(words, before + 1, last - before)))

    return bound(tokens(text), cut)


def split_sentences(df: DataFrame, text: str, keep: list[str], rules: Rules | None = None) -> DataFrame:
    """keep, sentence (from 0) and its words (runs of letters, digits and apostrophes).

    Sentences without a word are left out. Without rules they are learnt from these texts.
    """
    abbreviations, starters = (rules or learn(df, text)).words()
    own = F.transform(sentences(F.col(text), abbreviations, starters), lambda s: F.regexp_extract_all(
        F.array_join(s, " "), F.lit(r"[\p{L}\p{N}']+"), F.lit(0)))
    return df.select(*keep, F.posexplode(F.filter(own, lambda w: F.size(w) > 0)).alias("sentence", "words"))
