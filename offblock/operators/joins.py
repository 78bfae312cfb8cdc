"""Joins (R20-R22, R24, R26).

Point tables are broadcast only if their bytes, summed over the whole side in one
aggregate, are at most BROADCAST_BYTES; beyond it the join is a shuffle join that
AQE re-plans at run time. Keys that hold very many rows are salted (R22).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.constants import (
    DISTANCE, LAT_RUNWAY, LAT_STAND, LNG_RUNWAY, LNG_STAND, LOG_DISTANCE, RUNWAY, RUNWAY_BASE_DEFAULT,
    RUNWAY_BASE_MINUTES, STAND,
)
from offblock.functions.geo import haversine_m, log_distance
from offblock.operators.schema import cast_keys_to_text, q

#: A side of at most so many bytes (values and 32 a row) is broadcast, after it is measured.
BROADCAST_BYTES = 32 << 20
#: Keys with more rows on the left are salted; so many rows share a salt.
HEAVY_ROWS = 1_000_000
#: Keys that the sketch of heavy keys tracks: a key with a share of 1/TRACKED of the rows is found.
TRACKED = 10_000


def distinct_points(geo: DataFrame, kind: str) -> DataFrame:
    """Distinct (name, lat, lng) of runways or stands.

    A name with two coordinates keeps both rows, so the distance join fans out as in the reference.
    """
    if kind == RUNWAY:
        return geo.select(q(RUNWAY), q(LAT_RUNWAY).alias("lat"), q(LNG_RUNWAY).alias("lng")).distinct()
    if kind == STAND:
        return geo.select(q(STAND), q(LAT_STAND).alias("lat"), q(LNG_STAND).alias("lng")).distinct()
    raise ValueError(f"kind must be '{RUNWAY}' or '{STAND}'")


def _with_distance(df: DataFrame) -> DataFrame:
    d = haversine_m(F.col("_r_lat"), F.col("_r_lng"), F.col("_s_lat"), F.col("_s_lng"))
    return (df.withColumn(DISTANCE, d).withColumn(LOG_DISTANCE, log_distance(F.col(DISTANCE)))
            .drop("_r_lat", "_r_lng", "_s_lat", "_s_lng"))


def sized_broadcast_many(sides: list[DataFrame], max_bytes: int = BROADCAST_BYTES, max_rows: int | None = None) -> list[DataFrame]:
    """Each side with a broadcast hint if its measured bytes (and rows, where given) allow it; one job for all."""
    tagged = None
    for i, df in enumerate(sides):
        size = F.lit(32)
        for f in df.schema.fields:
            size = size + (F.coalesce(F.octet_length(q(f.name)), F.lit(0)) if f.dataType.simpleString() == "string" else F.lit(8))
        t = df.select(F.lit(i).alias("_side"), size.cast("long").alias("_bytes"))
        tagged = t if tagged is None else tagged.unionByName(t)
    found = {r["_side"]: r for r in tagged.groupBy("_side").agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("bytes")).collect()}
    fits = lambda i: i not in found or (found[i]["bytes"] <= max_bytes and (max_rows is None or found[i]["n"] <= max_rows))
    return [F.broadcast(df) if fits(i) else df for i, df in enumerate(sides)]


def _point_sides(geo: DataFrame, max_rows: int | None) -> tuple[DataFrame, DataFrame]:
    runways = distinct_points(geo, RUNWAY).withColumnsRenamed({"lat": "_r_lat", "lng": "_r_lng"})
    stands = distinct_points(geo, STAND).withColumnsRenamed({"lat": "_s_lat", "lng": "_s_lng"})
    rw, st = sized_broadcast_many([runways, stands], max_rows=max_rows)
    return rw, st


def runway_stand_distances(geo: DataFrame, pairs: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Distance and log-distance for the (runway, stand) pairs asked for.

    The reference tabulates every runway x stand pair; here the pairs come from
    the data (``pairs``, e.g. the distinct pairs of the departures), which gives
    the same rows wherever R21 can use them and no all-pairs product.
    """
    runways, stands = _point_sides(geo, max_rows)
    demand = pairs.select(RUNWAY, STAND).distinct()
    return _with_distance(demand.join(runways, RUNWAY, "inner").join(stands, STAND, "inner"))


def join_distance(airport: DataFrame, geo: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Left join of distance/log-distance on (runway, stand).

    Both point tables are broadcast (size-checked), so the departures are not
    shuffled; the distance is computed in the same codegen stage as the scan.
    """
    runways, stands = _point_sides(geo, max_rows)
    out = airport.join(runways, RUNWAY, "left").join(stands, STAND, "left")
    return _with_distance(out).select(*[q(c) for c in airport.columns], q(DISTANCE), q(LOG_DISTANCE))


def heavy_keys(df: DataFrame, keys: list[str], rows: int = HEAVY_ROWS) -> list[tuple[str, int]]:
    """(key text, rows) of the keys with more than `rows` rows, from one sketch pass; keys are text.

    The sketch counts TRACKED keys; a key it misses is only not salted.
    """
    key = _key_text(keys)
    top = df.select(key.alias("k")).agg(F.expr(f"approx_top_k(k, 1000, {TRACKED})").alias("top")).first()["top"] or []
    return [(r["item"], r["count"]) for r in top if r["count"] > rows]


def _key_text(keys: list[str]):
    """One text for a tuple of text keys; lengths keep different tuples apart."""
    return F.concat(*[F.concat(F.length(q(k)).cast("string"), F.lit(":"), q(k)) for k in keys])


def join_weather(airport: DataFrame, weather: DataFrame, keys: list[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Left join on text keys (R11); duplicate right keys fan out.

    Large-large: a shuffle join on the keys. Keys that one sketch of the left
    side finds in more than heavy_rows rows (such as 'nan' in all of them) are
    salted: their rows on the left are spread over ceil(rows / heavy_rows) salts,
    and those on the right copied to each. All others have salt 0 only.
    """
    left = cast_keys_to_text(airport, keys)
    right = cast_keys_to_text(weather, keys)
    heavy = heavy_keys(left, keys, heavy_rows)
    if not heavy:
        return left.join(right, keys, "left")
    # at most 1000 keys: a literal map
    salts = F.create_map(*[x for k, n in heavy for x in (F.lit(k), F.lit(-(-n // heavy_rows)))])
    ways = F.coalesce(F.try_element_at(salts, _key_text(keys)), F.lit(1))
    spread = left.withColumn("__salt", F.pmod(F.xxhash64(*[q(c) for c in left.columns]), ways).cast("int"))
    copied = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), ways - 1)))
    return spread.join(copied, [*keys, "__salt"], "left").drop("__salt")


def lookup_default(df: DataFrame, col: str = "Runway", out: str = "base_minutes",
                   table: dict[str, int] | None = None, default: int = RUNWAY_BASE_DEFAULT) -> DataFrame:
    """Map a runway to base minutes; unknown -> default. The lookup is a literal map expression."""
    table = table if table is not None else RUNWAY_BASE_MINUTES
    pairs = []
    for k, v in table.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    return df.withColumn(out, F.coalesce(F.try_element_at(m, q(col)), F.lit(default)))
