"""Enrichment joins: precedence, ranked as-of, nearest sites, calendars, audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import haversine_km, ratio
from .frames import as_of
from .skew import attach


def prefer(df: DataFrame, fallback: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Left join where ``columns`` keep the left value and take the fallback only when null."""
    other = fallback.select(on, *[F.col(c).alias("_fb_" + c) for c in columns])
    joined = df.join(other, on, "left")
    filled = {c: F.coalesce(F.col(c), F.col("_fb_" + c)) for c in columns}
    return joined.withColumns(filled).drop(*["_fb_" + c for c in columns])


def role(dimension: DataFrame, prefix: str) -> DataFrame:
    """Copy of a dimension under a role: every column gets the prefix."""
    return dimension.select([F.col(c).alias(prefix + c) for c in dimension.columns])


def aggregate_back(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Group statistics attached to every row.

    The aggregate combines map-side and the join splits hot keys, where a window over the
    keys would buffer a whole group in one task.
    """
    return attach(df, df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()]), keys)


def ranked_as_of(
    facts: DataFrame, bridge: DataFrame, observations: DataFrame, *, fact_id: str, place: str,
    site: str, rank: str, at: str, obs_time: str, lookback: int, payload: Sequence[str], tie: str,
) -> DataFrame:
    """Best observation for each fact among its ranked candidate sites.

    Sites without an observation inside the look-back are passed over, so a farther site
    is used when the nearest one is silent. Returns one narrow row per fact.
    """
    candidates = facts.select(fact_id, place, at).join(bridge.select(place, site, rank), place, "left")
    seen = as_of(candidates, observations, [site], at, obs_time, lookback, payload, tie)
    kept = [site, rank, obs_time, *payload]
    order = F.struct(F.col(obs_time).isNull(), F.col(rank).isNull(), F.col(rank))
    best = seen.groupBy(fact_id).agg(F.min_by(F.struct(*kept), order).alias("_best"))
    return best.select(fact_id, *[F.col("_best." + c).alias(c) for c in kept])


# Cube edge lengths on the unit sphere, fine to coarse, halving; the last one covers the sphere.
GRID_EDGES = tuple(2.0 / 2**level for level in range(11, -1, -1))


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    a, b = F.radians(F.col(lat)), F.radians(F.col(lon))
    return df.withColumns({"_x": F.cos(a) * F.cos(b), "_y": F.cos(a) * F.sin(b), "_z": F.sin(a)})


def _around() -> Column:
    """The 27 offsets of a cube and its neighbours."""
    steps = (-1, 0, 1)
    entries = [f"named_struct('dx', {x}, 'dy', {y}, 'dz', {z})" for x in steps for y in steps for z in steps]
    return F.expr(f"array({', '.join(entries)})")


def _at_levels(df: DataFrame) -> DataFrame:
    """One row per cube size."""
    cube = "named_struct('_level', {i}, '_cx', int(floor(_x / {e}D)), '_cy', int(floor(_y / {e}D)), '_cz', int(floor(_z / {e}D)))"
    entries = [cube.format(i=i, e=repr(edge)) for i, edge in enumerate(GRID_EDGES)]
    return df.select("*", F.inline(F.expr(f"array({', '.join(entries)})")))


def nearest_k(
    points: DataFrame, sites: DataFrame, k: int, *, point_id: str, site_id: str,
    lat: str = "lat", lon: str = "lon",
) -> DataFrame:
    """The ``k`` closest sites of every point by great-circle distance, without a product.

    Both sides live on the unit sphere in cubes of several sizes. Each point takes the
    finest size at which its 27 surrounding cubes already hold ``k`` sites; those lie
    within ``2 * sqrt(3)`` edges. The 27 cubes two sizes up (edge times four) are therefore
    sure to hold the true nearest ``k``, and sites beyond that distance are passed over
    before any trigonometry. Equal coordinates are answered once, and at one coordinate
    only the first ``k`` sites can matter.
    """
    cube = ["_level", "_cx", "_cy", "_cz"]
    stacked = W.partitionBy(lat, lon).orderBy(site_id)
    located = sites.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(site_id, lat, lon)
    useful = located.withColumn("_n", F.row_number().over(stacked)).filter(F.col("_n") <= k).drop("_n")
    site_cubes = _at_levels(_on_sphere(useful, lat, lon)).select(
        F.col(site_id), F.col(lat).alias("_slat"), F.col(lon).alias("_slon"),
        *[F.col(c).alias("_s" + c) for c in ("_x", "_y", "_z")], *cube,
    )
    shift = {"_cx": F.col("_cx") + F.col("dx"), "_cy": F.col("_cy") + F.col("dy"), "_cz": F.col("_cz") + F.col("dz")}
    reach = (
        site_cubes.groupBy(*cube).agg(F.count(F.lit(1)).alias("_n"))
        .select("*", F.inline(_around())).withColumns(shift)
        .groupBy(*cube).agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= k)
    )
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(lat, lon).distinct()
    spots = _on_sphere(spots.repartition(parts, lat, lon), lat, lon)  # a few rows here become much work
    coarsest = len(GRID_EDGES) - 1
    covered = (
        _at_levels(spots).join(reach, cube, "left").groupBy(lat, lon, "_x", "_y", "_z")
        .agg(F.min(F.when(F.col("_n").isNotNull(), F.col("_level"))).alias("_cover"))
    )
    edges = F.array(*[F.lit(e) for e in GRID_EDGES])
    chosen = covered.withColumns({
        "_level": F.least(F.coalesce("_cover", F.lit(coarsest)) + 2, F.lit(coarsest)),
        "_reach2": F.lit(12.0001) * F.get(edges, F.col("_cover")) * F.get(edges, F.col("_cover")),
    })
    edge = F.get(edges, F.col("_level"))
    search = (
        chosen.withColumns({n: F.floor(F.col(a) / edge).cast("int") for n, a in
                            (("_cx", "_x"), ("_cy", "_y"), ("_cz", "_z"))})
        .select("*", F.inline(_around())).withColumns(shift).drop("dx", "dy", "dz", "_cover")
    )
    chord2 = F.lit(0.0)
    for axis in ("_x", "_y", "_z"):
        chord2 = chord2 + (F.col(axis) - F.col("_s" + axis)) * (F.col(axis) - F.col("_s" + axis))
    close = F.col("_reach2").isNull() | (chord2 <= F.col("_reach2"))
    km = haversine_km(F.col(lat), F.col(lon), F.col("_slat"), F.col("_slon"))
    # millimetre rounding makes equal distances tie, so that the site id decides
    near = search.join(site_cubes, cube).filter(close).select(lat, lon, site_id, F.round(km, 6).alias("dist_km"))
    order = W.partitionBy(lat, lon).orderBy("dist_km", site_id)
    top = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    top = top.withColumn("rank", F.col("rank").cast("long"))
    return points.select(point_id, lat, lon).join(top, [lat, lon]).select(point_id, site_id, "dist_km", "rank")


def calendar_window(spark, marks: Sequence[str], buffer_days: int) -> DataFrame:
    """Days within ``buffer_days`` of any marked date, one row each. ``marks`` is configuration."""
    base = spark.createDataFrame([(m,) for m in marks], "mark string").select(F.col("mark").cast("date"))
    span = F.sequence(F.date_sub("mark", buffer_days), F.date_add("mark", buffer_days))
    return base.select(F.explode(span).alias("day")).distinct()


def flag_by_calendar(df: DataFrame, day: Column, calendar: DataFrame, name: str) -> DataFrame:
    marked = calendar.select(F.col("day").alias("_day"), F.lit(1).alias("_hit"))
    out = df.withColumn("_own", day).join(marked, F.col("_own") == F.col("_day"), "left")
    return out.withColumn(name, F.coalesce("_hit", F.lit(0))).drop("_own", "_day", "_hit")


def reattach(df: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str], suffix: str) -> DataFrame:
    """Bring dropped columns back by composite key, marked with a suffix."""
    extra = source.select(*on, *[F.col(c).alias(c + suffix) for c in columns])
    return df.join(extra, list(on), "left")


def missing_keys(df: DataFrame, dimension: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Fact keys absent from the dimension, with the number of rows they carry."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(dimension.select(F.col(dim_key).alias(key)).distinct(), key, "left_anti")


def key_coverage(df: DataFrame, dimension: DataFrame, key: str, dim_key: str) -> DataFrame:
    """One row: rows, matched rows, distinct keys, matched keys and coverage in percent."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dimension.select(F.col(dim_key).alias(key)).distinct().withColumn("_hit", F.lit(1))
    hit = F.col("_hit").isNotNull()
    return counts.join(known, key, "left").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("matched_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count("_hit").alias("matched_keys"),
        F.round(100 * ratio(F.sum(F.when(hit, F.col("n"))), F.sum("n")), 6).alias("coverage_pct"),
    )
