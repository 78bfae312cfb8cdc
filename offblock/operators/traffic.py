"""Traffic around each departure.

Meaning: for a departure at second t, the number of OTHER departures whose
off-block second lies in [t - w, t + w], for w = 30 and 10 minutes.

Spark has no band-join strategy, and ``count().over(orderBy(t).rangeBetween)``
without ``partitionBy`` runs in ONE task. The scalable form:

1. pre-aggregate to distinct seconds: ``groupBy(t).count()`` (map-side combine;
   one hot second becomes one row with a large count);
2. copy each second into its own bucket ``floor(t / W)`` and the two neighbours
   (W = widest window), so every bucket partition holds all seconds within W
   of its own seconds — at most 3 * (W + 1) rows, whatever the skew;
3. range-framed window sums partitioned by bucket; keep each second's home copy;
4. join the per-second counts back to the departures on t.

No pairs are emitted and no partition grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offblock.constants import PLANES_10MIN, PLANES_30MIN, TRAFFIC_WINDOWS_MIN
from offblock.functions.datetime import epoch_seconds
from offblock.operators.schema import q

_T = "_t_sec"


def band_counts(df: DataFrame, ts_col: str, widths_s: dict[str, int]) -> DataFrame:
    """Per distinct second ``_t_sec``, the count of departures within each width, self excluded."""
    per_sec = (df.select(epoch_seconds(q(ts_col)).alias(_T)).where(F.col(_T).isNotNull())
               .groupBy(_T).agg(F.count(F.lit(1)).alias("_c")))
    span = max(widths_s.values())
    home = F.floor(F.col(_T) / F.lit(span))
    copies = per_sec.select(_T, "_c", home.alias("_home"),
                            F.explode(F.array(home - 1, home, home + 1)).alias("_part"))
    cols = []
    for name, w in widths_s.items():
        win = Window.partitionBy("_part").orderBy(_T).rangeBetween(-w, w)
        cols.append((F.sum("_c").over(win) - F.lit(1)).alias(name))
    return copies.select(_T, "_home", "_part", *cols).where(F.col("_home") == F.col("_part")).drop("_home", "_part")


def planes_in_window(df: DataFrame, ts_col: str,
                     widths_min: tuple[int, ...] = TRAFFIC_WINDOWS_MIN,
                     names: tuple[str, ...] = (PLANES_30MIN, PLANES_10MIN)) -> DataFrame:
    """Add the traffic counts (as double, NULL when the time is missing) to every row."""
    widths = {n: m * 60 for n, m in zip(names, widths_min, strict=True)}
    counts = band_counts(df, ts_col, widths)
    keyed = df.withColumn(_T, epoch_seconds(q(ts_col)))
    # rows without a time have no counts: they go round the join, where they would be one hot key
    out = keyed.where(F.col(_T).isNotNull()).join(counts, _T, "left").drop(_T)
    none = keyed.where(F.col(_T).isNull()).drop(_T).withColumns({n: F.lit(None).cast("long") for n in names})
    out = out.unionByName(none)
    return out.withColumns({n: F.col(n).cast("double") for n in names})
