"""Scalar column functions."""

from __future__ import annotations

import math
from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_else(condition: Column, yes, no) -> Column:
    """``yes`` where the condition holds, ``no`` where it is false or null."""
    return F.when(condition, yes).otherwise(no)


def mapped(value: Column, mapping: Mapping) -> Column:
    """Look the value up in a small dictionary; null when it is not there."""
    pairs = [F.lit(x) for x in chain.from_iterable(mapping.items())]
    return F.try_element_at(F.create_map(*pairs), value)


def log_amount(amount: Column) -> Column:
    """Natural log, with 0 replaced by 0.01 (the value itself, not its log)."""
    return F.when(amount == 0, F.lit(0.01)).otherwise(F.ln(amount))


def radial_time(seconds: Column) -> tuple[Column, Column]:
    """Sine and cosine of the time of day."""
    angle = seconds * F.lit(2 * math.pi / 86400)
    return F.sin(angle), F.cos(angle)


def time_parts(seconds: Column) -> dict[str, Column]:
    hour = F.pmod(F.floor(seconds / 3600), F.lit(24))
    return {
        "Day": F.floor(seconds / 86400),
        "Hour": hour,
        "Min": F.pmod(F.floor(seconds / 60), F.lit(60)),
        "Second": F.pmod(seconds, F.lit(60)),
        "PartOfDay": F.floor(hour / 3),
    }


def hours(seconds: Column) -> Column:
    return seconds / 3600


def frac(value: Column) -> Column:
    """Part after the decimal point, counted from the next lower whole number."""
    return value - F.floor(value)


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 when undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    """Weighted harmonic mean of precision and recall, 0 when both are 0."""
    b2 = float(beta) ** 2
    return safe_ratio((1 + b2) * precision * recall, b2 * precision + recall)


def mixed_key(row_id: Column, seed: int) -> Column:
    """Hex text that orders rows as if shuffled, the same on every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def mixed_draw(key: Column, digits: int = 8) -> Column:
    """A number in [0, 1) from the first hex digits (at most 13) of a mixed key."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long") / F.lit(float(16 ** digits))


def title_label(name: Column) -> Column:
    """``NN - title`` from ``n - title - author - year``."""
    parts = F.split(name, " - ")
    number = F.get(parts, F.lit(0))
    padded = F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)
    return F.concat_ws(" - ", padded, F.get(parts, F.lit(1)))


def std_method_label(text: Column) -> Column:
    """Standardisation method named in a free-text parameter list; first match wins."""
    unnamed = ~text.contains("standardisation_method':")
    label = F.when(text.contains("standardisation_method': 'minmax'"), "minmax")
    for method, old_flag in (("meanstd", "False"), ("ranked", "True")):
        named = text.contains(f"standardisation_method': '{method}'")
        old = unnamed & text.contains(f"ranked_standardisation': {old_flag}")
        label = label.when(named | old, method)
    return label


def sentence_tokens(text: Column) -> Column:
    """Words per sentence.  A sentence ends with full stops, question or exclamation
    marks; words are runs of letters, digits and apostrophes.  Sentences without a
    word are left out."""
    sentences = F.regexp_extract_all(text, F.lit(r"[^.!?]+[.!?]*"), F.lit(0))
    words = F.transform(sentences, lambda s: F.regexp_extract_all(s, F.lit(r"[\p{L}\p{N}']+"), F.lit(0)))
    return F.filter(words, lambda w: F.size(w) > 0)
