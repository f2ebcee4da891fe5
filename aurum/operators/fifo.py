"""E-04 FIFO valuation of stock on hand.

The reference declares "daily inventory position snapshots with FIFO
costing" and a ``total_cost`` column, with no computation and no cost data.
Semantics built here:

* a cost layer is one day's receipts of one item (all receipts of that day,
  at their total cost); issues consume the oldest layers first;
* on each day the value on hand is the cost of every unit received so far
  minus the cost of the first ``min(issued, received)`` units on the receipt
  axis (issues beyond stock consume later receipts first: a backlog);
* a partially consumed layer is valued pro rata, HALF_UP to the cent, in
  exact integer arithmetic.

Plan: three running sums per item in one window over its day rows (one row
per item and day — the bound the running-stock window already relies on),
then one as-of lookup of each day's consumed position among the layer
starts: every day row also emits its layer row (one ``explode``), and
``last(..., ignorenulls)`` over the same item partitioning carries the
latest layer at or before each position.  No join of receipts against
issues, so no pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LAYER = "struct<start:bigint,qty:bigint,cost:bigint,cost_before:bigint>"


def fifo_value(daily: DataFrame, keys, day: str, in_qty: str, in_cost: str, out_qty: str,
               value_col: str = "fifo_value") -> DataFrame:
    """Add ``_received``, ``_issued`` (running totals) and ``value_col`` (FIFO
    value on hand, same unit as ``in_cost``) to one row per (keys, day).

    ``in_qty`` / ``out_qty`` are non-negative integers, ``in_cost`` the
    integer total cost (e.g. cents) of that day's receipts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    run_w = (Window.partitionBy(*keys).orderBy(day)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = daily.select(
        "*",
        F.sum(in_qty).over(run_w).alias("_received"),
        F.sum(in_cost).over(run_w).alias("_received_cost"),
        F.sum(out_qty).over(run_w).alias("_issued"),
    )
    # Each day row becomes its own lookup row (kind 1, at its consumed
    # position) and, when it received goods, a layer row (kind 0, at the
    # layer's start; starts strictly rise).  One generator over one input:
    # the day rows are computed once and stay partitioned by ``keys``, so
    # the lookup window below needs a local sort only.
    start = (F.col("_received") - F.col(in_qty)).cast("bigint")
    layer = F.struct(
        start.alias("start"),
        F.col(in_qty).cast("bigint").alias("qty"),
        F.col(in_cost).cast("bigint").alias("cost"),
        (F.col("_received_cost") - F.col(in_cost)).cast("bigint").alias("cost_before"),
    )
    lookup = F.struct(F.lit(1).alias("kind"), F.least("_issued", "_received").cast("bigint").alias("pos"),
                      F.lit(None).cast(_LAYER).alias("layer"))
    laid = F.struct(F.lit(0).alias("kind"), start.alias("pos"), layer.alias("layer"))
    rows = F.when(F.col(in_qty) > 0, F.array(lookup, laid)).otherwise(F.array(lookup))
    both = run.select("*", F.explode(rows).alias("_e"))
    # at an equal position the layer sorts first (its start <= the position)
    look_w = (Window.partitionBy(*keys).orderBy("_e.pos", "_e.kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = both.select("*", F.last("_e.layer", ignorenulls=True).over(look_w).alias("_in")) \
        .filter(F.col("_e.kind") == 1)

    # cost of the first d units of a layer (q units, cost k), HALF_UP:
    # (k div q)*d + round(((k mod q)*d) / q), all integer — no overflow
    # for d <= q < 2^31 and exact for any total cost
    consumed = F.expr(
        "_in.cost_before + (_in.cost div _in.qty) * (_e.pos - _in.start)"
        " + (2 * pmod(_in.cost, _in.qty) * (_e.pos - _in.start) + _in.qty) div (2 * _in.qty)")
    out = hit.withColumn(value_col, F.col("_received_cost") - F.coalesce(consumed, F.lit(0)))
    return out.drop("_e", "_in", "_received_cost")

