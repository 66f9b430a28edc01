"""Exact hash-ordered top-n without funnelling n rows through one task.

``df.orderBy(h).limit(n)`` plans a TakeOrderedAndProject whose final merge
holds n rows in a single task; for a cohort cap of tens of millions that is a
single-task bottleneck.  Instead:

1. every row gets a 60-bit ordering key ``_h`` (md5 prefix of seed + key) and a
   16-bit prefix ``_p = _h >> 44``;
2. a histogram of ``_p`` (at most 65,536 rows, a proven bound) is aggregated
   with map-side combine and turned into running counts;
3. rows whose whole prefix bucket lies below n are kept as they are;
4. only the single boundary bucket (about N / 65,536 rows) is ranked with a
   window to take the remaining ``n - before`` rows.

The result is exactly the first n rows in (md5, tie-break key) order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortix.functions.hashing import hash60

PREFIX_BITS = 16


def hash_top_n(df: DataFrame, n: int, order_hex: F.Column, tiebreak: list[str]) -> DataFrame:
    """First ``n`` rows of ``df`` ordered by the hex string ``order_hex`` then
    ``tiebreak`` columns.  Lazy; no driver round trip."""
    cols = df.columns
    shift = 60 - PREFIX_BITS
    keyed = df.withColumn("_hx", order_hex).withColumn("_h", hash60(F.col("_hx"))).withColumn(
        "_p", F.shiftright(F.col("_h"), shift)
    )
    hist = keyed.groupBy("_p").agg(F.count(F.lit(1)).alias("_cnt"))
    # <= 65,536 rows: the running sum over one partition is bounded work.
    running = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = (
        hist.withColumn("_cum", F.sum("_cnt").over(running))
        .withColumn("_before", F.col("_cum") - F.col("_cnt"))
        .filter(F.col("_before") < F.lit(n))
        .select("_p", "_cum", "_before")
    )
    tagged = keyed.join(F.broadcast(hist), "_p")
    whole = tagged.filter(F.col("_cum") <= F.lit(n))
    edge = tagged.filter(F.col("_cum") > F.lit(n))
    rank_w = Window.partitionBy("_p").orderBy(F.col("_hx"), *[F.col(c) for c in tiebreak])
    edge = edge.withColumn("_rn", F.row_number().over(rank_w)).filter(
        F.col("_rn") <= F.lit(n) - F.col("_before")
    )
    return whole.select(*cols).unionByName(edge.select(*cols))
