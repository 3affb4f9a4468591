"""Column scaling by statistics of a reference frame, a class or a subject.

Whole-table statistics are one-row scalar subqueries; per-subject statistics are
a small table joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.joins import skew_join

TIME_COMPONENTS = ("TimeComponent1", "TimeComponent2")


def _stats(df: DataFrame, cols: Sequence[str], **functions) -> Column:
    """One struct with a field ``{name}_{column}`` per statistic."""
    fields = [f(F.col(c)).alias(f"{name}_{c}") for c in cols for name, f in functions.items()]
    return df.agg(F.struct(*fields).alias("stats")).scalar()


def _scaled(df: DataFrame, cols: Sequence[str], stats: Column) -> DataFrame:
    return df.withColumns({c: F.try_divide(
        F.col(c) - stats.getField(f"mean_{c}"), stats.getField(f"std_{c}")) for c in cols})


def normalise(df: DataFrame, ref: DataFrame | None = None, exclude: Sequence[str] = ("Class",),
              time_components: bool = False) -> DataFrame:
    """z-score of every column by mean and sample std of the reference frame."""
    ref = df if ref is None else ref
    if set(df.columns) != set(ref.columns):
        raise ValueError("the frame and its reference have different columns")
    left_out = set(exclude) | (set() if time_components else set(TIME_COMPONENTS))
    cols = [c for c in ref.columns if c not in left_out]
    return _scaled(df, cols, _stats(ref, cols, mean=F.avg, std=F.stddev_samp))


def class_scaler(df: DataFrame, cols: Sequence[str], ignored: Sequence[str] = (),
                 fit_class: int | None = None, label: str = "Class") -> DataFrame:
    """z-score with population std, fitted on one class only when asked; the
    ignored columns are dropped.  A constant column is only centred."""
    fit = df if fit_class is None else df.filter(F.col(label) == fit_class)
    cols = [c for c in cols if c not in ignored]

    def spread(c):
        std = F.stddev_pop(c)
        return F.when(std == 0, F.lit(1.0)).otherwise(std)

    return _scaled(df, cols, _stats(fit, cols, mean=F.avg, std=spread)).drop(*ignored)


def subject_zscore(df: DataFrame, part: str, cols: Sequence[str]) -> DataFrame:
    """z-score (sample std) within each subject."""
    stats = df.groupBy(part).agg(*[f(c).alias(f"_{n}_{c}") for c in cols for n, f in (
        ("mean", F.avg), ("std", F.stddev_samp))])
    out = skew_join(df, stats, [part], "left")
    return out.withColumns({c: F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}"))
                            for c in cols}).select(*df.columns)


def _without(df: DataFrame, part: str, holdout: Sequence) -> DataFrame:
    return df.filter(~F.col(part).isin(*holdout)) if holdout else df


def population_zscore(df: DataFrame, part: str, cols: Sequence[str],
                      holdout: Sequence = ()) -> DataFrame:
    """z-score (sample std) over all subjects but the held-out ones."""
    return _scaled(df, cols, _stats(_without(df, part, holdout), cols,
                                    mean=F.avg, std=F.stddev_samp))


def population_minmax(df: DataFrame, part: str, cols: Sequence[str],
                      holdout: Sequence = ()) -> DataFrame:
    """Scale to [-1, 1] by the range over all subjects but the held-out ones."""
    stats = _stats(_without(df, part, holdout), cols, low=F.min, high=F.max)
    return df.withColumns({c: 2 * F.try_divide(
        F.col(c) - stats.getField(f"low_{c}"),
        stats.getField(f"high_{c}") - stats.getField(f"low_{c}")) - 1 for c in cols})


def scale_by_std(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    stats = _stats(df, cols, std=F.stddev_samp)
    return df.withColumns({c: F.try_divide(F.col(c), stats.getField(f"std_{c}")) for c in cols})
