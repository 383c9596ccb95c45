"""Running balance with an anchored first period (WN-03..WN-05, SO-01).

Windows are always partitioned by the entity. The balance is computed at the
(entity, period) grain: ``pre_aggregate`` sums movements to that grain first,
so even an entity holding a third of all rows contributes only one row per
period to its window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake.operators.aggregate import first_non_null


def running_balance(df: DataFrame, entity: str, date: str, movement: str, opening: str,
                    out: str = "saldo", anchor_first: bool = True,
                    pre_aggregate: bool = False) -> DataFrame:
    """``out = opening0 - cumsum(coalesce(movement, 0))`` per entity by date.

    ``opening0`` is the first non-NULL opening of the entity in date order.
    With ``anchor_first`` the January row shows its own opening value
    (possibly NULL) and its movement is deducted from February on.
    """
    if pre_aggregate:
        df = df.groupBy(entity, date).agg(F.sum(movement).alias(movement),
                                          first_non_null(opening, date).alias(opening))
    ordered = Window.partitionBy(entity).orderBy(date)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opening0 = F.first(F.col(opening), ignorenulls=True).over(whole)
    cum = F.sum(F.coalesce(F.col(movement), F.lit(0))).over(running)
    calc = opening0 - cum
    balance = F.when(F.month(F.col(date)) == 1, F.col(opening)).otherwise(calc) if anchor_first else calc
    return df.withColumn(out, balance)
