"""E-mail queries: threads, weekend share, contact traffic, blind-copy names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.relational import has_field, top


def mail_date(text: Column) -> Column:
    """Time of an RFC 822 date; the day name and a bracketed zone name are ignored."""
    plain = F.regexp_replace(F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", ""),
                             r"\s*\([^)]*\)\s*$", "")
    return F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z"))


def is_weekend(text: Column) -> Column:
    """Saturday and Sunday are the day names that begin with S."""
    return text.startswith("S")


def emails_in_thread(df: DataFrame, subject: str, subject_col: str = "subject",
                     date_col: str = "date", tie: str = "id") -> DataFrame:
    """Replies and forwards of a subject, oldest first.

    One or more re/fwd/fw prefixes in any case are needed, so the first mail of
    the thread is not found; the rest of the subject must match exactly.
    """
    pattern = r"^(?:(?i:re|fwd|fw): )+" + re.escape(subject) + "$"
    found = df.filter(F.col(subject_col).rlike(pattern))
    return found.withColumn("sent", mail_date(F.col(date_col))).orderBy("sent", tie)


def weekend_share(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.agg(F.avg(F.coalesce(is_weekend(F.col(date_col)).cast("double"), F.lit(0.0)))
                  .alias("share"))


def split_bcc(df: DataFrame, col: str = "bcc") -> DataFrame:
    """Distinct raw entries of the blind-copy header, sorted."""
    entries = F.explode(F.split(F.col(col), ">, ")).alias("entry")
    named = has_field(df, col).select(entries).select(
        F.get(F.split("entry", " <"), F.lit(0)).alias("entry"))
    parts = named.select(F.explode(F.split("entry", "', ")).alias("name"))
    return parts.distinct().orderBy("name")


def _cleaned(text: Column) -> Column:
    """Addresses and names in an entry, as an array.

    The text is read character by character as a fold over its characters.  An
    item with an @ ends at a comma or quote.  Of other commas every second one
    ends an item ("Last, First"); an address in between does not reset that.
    """
    chars = F.split(F.concat(text, F.lit(",")), "")
    start = F.struct(F.lit("").alias("item"), F.lit(False).alias("mail"),
                     F.lit(False).alias("half"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, c: Column) -> Column:
        skip = (s["item"] == "") & c.isin("'", " ", ",")
        mail = s["mail"] | (c == "@")
        comma = c == ","
        ends_mail = s["mail"] & (comma | (c == "'"))
        ends_name = ~s["mail"] & comma & s["half"]
        ends = ~skip & (ends_mail | ends_name)
        return F.struct(
            F.when(skip | ends, "").otherwise(F.concat(s["item"], c)).alias("item"),
            (mail & ~ends).alias("mail"),
            F.when(skip | ~(~s["mail"] & comma), s["half"]).otherwise(~s["half"]).alias("half"),
            F.when(ends, F.concat(s["done"], F.array(s["item"]))).otherwise(s["done"])
            .alias("done"))

    def finish(s: Column) -> Column:
        rest = s["item"]  # still holds the comma put at the end
        left = F.when(F.length(rest) > 0, F.array(F.substring(rest, F.lit(1), F.length(rest) - 1)))
        return F.concat(s["done"], F.coalesce(left, F.array().cast("array<string>")))

    return F.aggregate(chars, start, step, finish)


def clean_names(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-empty names and addresses in a text column."""
    items = df.select(F.explode(_cleaned(F.col(col))).alias("name"))
    return items.filter(F.col("name") != "").distinct()


def contact_traffic(df: DataFrame, address: str, limit: int | None = None) -> DataFrame:
    """Mails from and to each contact of an address, most first.

    An address counts as receiver when a receiver header contains its text.
    """
    out = F.col("sender").eqNullSafe(F.lit(address))
    match = out | F.col("rcpt").contains(address) | F.col("cc").contains(address)
    everyone = F.concat("rcpt", F.coalesce(F.concat(F.lit(", "), "cc"), F.lit("")))
    mails = df.filter(match).select(
        "id", "sender", out.alias("outgoing"),
        F.when(out, everyone).otherwise(F.lit(address)).alias("to"))
    lines = mails.select("id", "sender", "outgoing",
                         F.explode(F.split("to", ", \r\n\t")).alias("to"))
    each = lines.select("id", "sender", "outgoing", F.explode(F.split("to", ", ")).alias("to"))
    each = each.dropDuplicates(["id", "to", "sender", "outgoing"])
    counts = each.groupBy(F.when(F.col("outgoing"), F.col("to")).otherwise(F.col("sender"))
                          .alias("contact")).agg(
        F.count_if(~F.col("outgoing")).alias("from"), F.count_if("outgoing").alias("to"),
        F.count(F.lit(1)).alias("total"))
    return top(counts, ["total"], limit, tie=["contact"])
