"""Ranks and shares within groups that stay distributed when one group is very large.

A window over a group sorts the whole group in one task. Here only groups of up to ``hot_rows``
rows do that. A larger group is cut into slices of equal or close values: every slice is ranked by
itself, and the number of rows in the slices before it is added. Both ways give the same ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
_LAST_BAND = -(2**62)  # rows without a value rank last


def rank_in_groups(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    ties: Sequence[str],
    rank: str,
    total: str,
    share: str,
    share_total: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add to each row, within its group: ROW_NUMBER of ``value`` descending, the sum of ``value``,
    the rounded share of that sum, and on request the sum of the rounded shares.

    Equal values are ordered by a three-digit hash of ``ties``, then by ``ties``; ``groups`` and
    ``ties`` together must identify a row. The hash cuts a long run of equal values into slices.
    """
    keys = [f"_key{i}" for i in range(len(groups))]
    keyed = df.withColumns({key: _as_key(name) for key, name in zip(keys, groups)})

    # At most rows / hot_rows groups are hot; mostly there is none.
    sizes = keyed.groupBy(*keys).agg(F.sum(value).alias("_total"), F.count("*").alias("_n"))
    hot_groups = sizes.filter(F.col("_n") > hot_rows).select(*keys, "_total", F.lit(True).alias("_hot"))
    # Both parts read all columns of ``flagged``, so that its shuffles are made once for both.
    flagged = keyed.join(_bounded(hot_groups, hot_rows), keys, "left")
    hot = flagged.filter("_hot").withColumn(total, F.col("_total"))

    of_group = Window.partitionBy(*keys)
    ordered = _ordered(of_group, value, ties, groups)
    whole_group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = flagged.filter("_hot is null").withColumns(
        {
            "_place": F.row_number().over(ordered),
            total: F.coalesce("_total", F.sum(value).over(whole_group)),
        }
    ).withColumn(share, ratio(value, total))
    extra = [share]
    if share_total is not None:
        extra.append(share_total)
        whole = whole.withColumn(share_total, F.sum(_exact(share)).over(of_group).cast("double"))
    sliced = _ranked_in_slices(hot, keys, value, ties, groups, total, share, share_total)

    ranked = [*df.columns, total, F.col("_place").cast("bigint").alias(rank), *extra]
    return whole.select(*ranked).union(sliced.select(*ranked))


def _ordered(within: Window, value: str, ties: Sequence[str], groups: Sequence[str]) -> Window:
    """Within a group ``groups`` decide nothing; they are named so that every part reads the same columns."""
    return within.orderBy(F.desc_nulls_last(value), tie_hash(ties), *[F.asc_nulls_last(name) for name in (*ties, *groups)])


def _ranked_in_slices(
    hot: DataFrame, keys: Sequence[str], value: str, ties: Sequence[str], groups: Sequence[str],
    total: str, share: str, share_total: str | None,
) -> DataFrame:
    """Rows of hot groups, which know their group's total, with ``_place``, the share and on request the sum of shares."""
    piece = [*keys, "_band", "_level", "_slice"]
    sliced = hot.withColumns(
        {
            "_band": F.coalesce(_band(F.col(value)), F.lit(_LAST_BAND)),
            "_level": F.coalesce(F.col(value).cast("string"), F.lit("")),
            "_slice": tie_hash(ties),
        }
    ).repartition(*piece)  # a join by the keys leaves all slices of a group in one task
    within = Window.partitionBy(*piece)
    placed = sliced.withColumns(
        {"_in_slice": F.row_number().over(_ordered(within, value, ties, groups)), "_n": F.count("*").over(within)}
    ).withColumn(share, ratio(value, total))
    # Counted where the slices are numbered, so that the rows are shuffled once for both.
    before = _rows_before(placed.filter("_in_slice = 1"), keys, value, total, share)
    ranked = placed.join(before, piece).withColumn("_place", F.col("_in_slice") + F.col("_before"))
    return ranked if share_total is None else ranked.withColumn(share_total, F.col("_shares").cast("double"))


def _exact(share: str) -> Column:
    """Shares are added up in decimals, so the order is no matter."""
    return F.col(share).cast("decimal(18,4)")


def _bounded(hot: DataFrame, hot_rows: int) -> DataFrame:
    """Broadcast one row per hot group where each has at least ``HOT_ROWS`` rows.

    Below, the list is dealt anew, so that adaptive execution knows its size before the rows meet it: it broadcasts
    a short list, and without any hot group the steps for those are left out.
    """
    return F.broadcast(hot) if hot_rows >= HOT_ROWS else hot.hint("rebalance")


def _as_key(name: str) -> Column:
    """A group value as text that is never NULL, so that NULL is a group in equality joins too."""
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit(""))


def tie_hash(ties: Sequence[str]) -> Column:
    text = F.concat_ws("|", *[F.col(name).cast("string") for name in ties])
    return F.substring(F.md5(text), 1, 3)


def _band(value: Column) -> Column:
    """Logarithmic value band: never falls as the value rises, and about 0.05 % of a value wide."""
    number = value.cast("double")
    return (F.signum(number) * F.floor(F.log1p(F.abs(number)) * 2000)).cast("bigint")


def _rows_before(slices: DataFrame, keys: Sequence[str], value: str, total: str, share: str) -> DataFrame:
    """For each slice of the hot groups: the number of rows of its group that rank before it, and the group's sum of shares.

    All rows of a slice have the same value, so the same share. ``total`` is one per group; it is named so that
    both sides of the join read the same columns.
    """
    counts = slices.select(*keys, "_band", "_level", "_slice", "_n", value, total, (F.col("_n") * _exact(share)).alias("_shares"))
    earlier = (Window.unboundedPreceding, -1)

    of_group = Window.partitionBy(*keys)
    by_band = of_group.orderBy(F.desc("_band")).rowsBetween(*earlier)
    bands = counts.groupBy(*keys, "_band", total).agg(F.sum("_n").alias("_n"), F.sum("_shares").alias("_shares")).select(
        *keys, "_band", F.coalesce(F.sum("_n").over(by_band), F.lit(0)).alias("_before_band"),
        F.sum("_shares").over(of_group).alias("_shares"),
    )
    in_band = (
        Window.partitionBy(*keys, "_band")
        .orderBy(F.desc_nulls_last(value), F.asc("_slice"), F.asc(total))
        .rowsBetween(*earlier)
    )
    sliced = counts.drop("_shares").withColumn("_before_slice", F.coalesce(F.sum("_n").over(in_band), F.lit(0)))
    before = (F.col("_before_band") + F.col("_before_slice")).alias("_before")
    return sliced.join(bands, [*keys, "_band"]).select(*keys, "_band", "_level", "_slice", before, "_shares")


def ratio(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """Rounded ratio. Both sides go to double: a decimal ratio would keep six digits only."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)
