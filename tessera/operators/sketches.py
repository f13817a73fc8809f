"""Quantiles that roll up: one sketch for each stored group, merged into those of any coarser groups.

Exact quantiles (:func:`tessera.operators.traces.latency`) need the values again for every grouping. A KLL
sketch of bounded size is stored for each day, say, and months, quarters or all days are answered from the
sketches alone. What it returns for a quantile is a value of the data whose rank is off by at most
:func:`rank_error` of the count, at 99 % confidence, however many sketches were merged; the lowest and the
highest value are exact.

Null and NaN values are not counted; a group without others has n = 0 and null quantiles. Null keys are
groups like any other. No keys at all give one row, an empty table with keys gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.catalog import refresh_model, save_model

#: A sketch of this size is at most some 20 KB, and off by 0.18 % of the count.
SIZE = 1600

SKETCH, COUNT = "sketch", "n"


def rank_error(size: int = SIZE) -> float:
    """How far a rank may be off, as a share of the count, at 99 % confidence (published with the sketch)."""
    return 2.296 / size**0.9723


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sketches(rows: DataFrame, keys: Mapping[str, Column | str], value: Column | str, size: int = SIZE) -> DataFrame:
    """One sketch for each group: (*keys, n, sketch). Partial sketches are merged, no value is shuffled."""
    given = _col(value).cast("double")
    counted = F.when(~F.isnan(given), given)
    grouped = rows.select(*[_col(c).alias(name) for name, c in keys.items()], counted.alias("__value"))
    return grouped.groupBy(*keys).agg(
        F.count("__value").alias(COUNT), F.kll_sketch_agg_double("__value", F.lit(size)).alias(SKETCH)
    )


def store(
    rows: DataFrame, keys: Mapping[str, Column | str], value: Column | str, path: str, partition: str | None = None, size: int = SIZE
) -> DataFrame:
    """Keep the sketches under ``path``, by partitions of the key named ``partition``."""
    return save_model(sketches(rows, keys, value, size), path, [partition] if partition else [])


def refresh(
    rows: DataFrame, keys: Mapping[str, Column | str], value: Column | str, path: str, partition: str, values: Iterable,
    size: int = SIZE,
) -> DataFrame:
    """Sketch these partitions anew and leave all others alone."""
    values = list(values)
    held = [v for v in values if v is not None]
    key = _col(keys[partition])
    wanted = key.isin(held) if held else F.lit(False)
    if None in values:
        wanted = F.coalesce(wanted, F.lit(False)) | key.isNull()
    return refresh_model(sketches(rows.where(wanted), keys, value, size), path, partition, values)


def merge(stored: DataFrame, keys: Mapping[str, Column | str]) -> DataFrame:
    """The sketches of coarser groups, told from the stored keys; can be stored and merged again."""
    grouped = stored.select(*[_col(c).alias(name) for name, c in keys.items()], F.col(COUNT), F.col(SKETCH))
    return grouped.groupBy(*keys).agg(
        F.coalesce(F.sum(COUNT), F.lit(0)).alias(COUNT), F.kll_merge_agg_double(SKETCH).alias(SKETCH)
    )


def quantiles(merged: DataFrame, wanted: Sequence[float], prefix: str = "p") -> DataFrame:
    """The sketch of each row replaced by its quantiles, named as percentages: 0.95 is ``p95``."""
    names = [f"{prefix}{q * 100:g}" for q in wanted]
    if len(set(names)) < len(names):
        raise ValueError("a quantile is asked for twice")
    if any(not 0 <= q <= 1 for q in wanted):
        raise ValueError("quantiles lie between 0 and 1")
    filled = F.when(F.col(COUNT) > 0, F.col(SKETCH))
    return merged.withColumns(
        {name: F.kll_sketch_get_quantile_double(filled, F.lit(float(q))) for name, q in zip(names, wanted, strict=True)}
    ).drop(SKETCH)
