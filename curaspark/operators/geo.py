"""Places: points in polygons, distances to borders, coordinate checks. Edges are a table of segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.operators.shared import stored

KM_PER_DEGREE = 111.32
#: Edges of a latitude band, about.
EDGES = 64


def rectangles_to_edges(boxes: DataFrame) -> DataFrame:
    """(admin, x1, y1, x2, y2) of boxes (admin, west, south, east, north), four edges each."""
    corners = F.array(*[F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2")) for a, b, c, d in (("west", "south", "east", "south"), ("east", "south", "east", "north"), ("east", "north", "west", "north"), ("west", "north", "west", "south"))])
    return boxes.select("admin", F.explode(corners).alias("e")).select("admin", "e.*")


def polygons_to_edges(features: DataFrame) -> DataFrame:
    """Edges of (admin, rings): an array of closed rings, each an array of (lon, lat)."""
    rings = features.select("admin", F.posexplode("rings").alias("ring", "points"))
    pairs = rings.select("admin", F.explode(F.zip_with(F.slice("points", F.lit(1), F.size("points") - 1), F.slice("points", F.lit(2), F.size("points") - 1), lambda p, q: F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")))).alias("e"))
    return pairs.select("admin", "e.*")


@dataclass
class EdgeIndex:
    """Edges by latitude bands of their polygon: ``bands`` (admin, south, height, n_bands) and ``edges`` with the band of each row, an
    edge in every band that it touches. A polygon has as many bands as it takes to have some ``EDGES`` edges in each."""

    bands: DataFrame
    edges: DataFrame


def edge_index(edges: DataFrame, in_band: int | None = None) -> EdgeIndex:
    in_band = in_band or EDGES
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    span = edges.groupBy("admin").agg(F.min(low).alias("south"), F.max(high).alias("north"), F.count("*").alias("n"))
    n = F.ceil(F.col("n") / in_band).cast("int")
    bands = stored(span.select("admin", "south", F.when(F.col("north") > F.col("south"), (F.col("north") - F.col("south")) / n).otherwise(1.0).alias("height"), n.alias("n_bands")))
    placed = edges.join(_small(bands), "admin").withColumn("band", F.explode(F.sequence(_band(low), _band(high))))
    return EdgeIndex(bands, stored(placed.select("admin", "band", "x1", "y1", "x2", "y2")))


def _small(table: DataFrame, rows: int = 100_000) -> DataFrame:
    """A broadcast hint behind a count."""
    return F.broadcast(table) if table.count() <= rows else table


def _band(lat: Column) -> Column:
    """The band of a latitude; what lies beyond the polygon belongs to its outermost bands. Rising with latitude."""
    return F.greatest(F.lit(0), F.least(F.col("n_bands") - 1, F.floor((lat - F.col("south")) / F.col("height")).cast("int")))


def point_in_polygon(points: DataFrame, edges: DataFrame | EdgeIndex, name: str = "site") -> DataFrame:
    """(site, admin) of points (site, admin, lon, lat) inside their own polygon: odd crossings, holes included.

    A point meets the edges of its own latitude band only: an edge that its parallel crosses is there too.
    """
    index = edges if isinstance(edges, EdgeIndex) else edge_index(edges)
    placed = points.join(_small(index.bands), "admin").withColumn("band", _band(F.col("lat"))).select(name, "admin", "lon", "lat", "band")
    joined = placed.join(index.edges, ["admin", "band"]).filter((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat")))
    right = F.col("lon") < (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    crossed = joined.groupBy(name, "admin").agg(F.sum(right.cast("long")).alias("n"))
    return crossed.filter("n % 2 = 1").select(name, "admin")


def _to_edge() -> Column:
    """Kilometres from (lon, lat) to the edge (x1, y1, x2, y2), on a plane at the point."""
    scale = F.cos(F.radians("lat")) * KM_PER_DEGREE
    ax, ay = (F.col("x1") - F.col("lon")) * scale, (F.col("y1") - F.col("lat")) * KM_PER_DEGREE
    dx, dy = (F.col("x2") - F.col("x1")) * scale, (F.col("y2") - F.col("y1")) * KM_PER_DEGREE
    size = dx * dx + dy * dy
    t = F.when(size == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / size)))
    return F.hypot(ax + t * dx, ay + t * dy)


def distance_to_polygon(points: DataFrame, edges: DataFrame | EdgeIndex, name: str = "site") -> DataFrame:
    """(site, admin, km) to the nearest border of the point's own polygon, 0 inside.

    Points outside look at their own band, then at one more on either side, then at two more, four more and so on, until the nearest
    edge found is nearer than the next band. A round is a table, so plans don't grow; there are as many as the logarithm of the bands.
    """
    index = edges if isinstance(edges, EdgeIndex) else edge_index(edges)
    inside = point_in_polygon(points, index, name).withColumn("_in", F.lit(True))
    known = points.join(_small(index.bands), "admin")
    state = stored(known.join(inside, [name, "admin"], "left").withColumn("km", F.when(F.col("_in"), F.lit(0.0))).drop("_in").withColumn("band", _band(F.col("lat"))))
    done = state.filter("km is not null").select(name, "admin", "km")
    state, seen, reach = state.filter("km is null"), -1, 0
    while not state.isEmpty():
        new = F.filter(F.sequence(F.greatest(F.col("band") - reach, F.lit(0)), F.least(F.col("band") + reach, F.col("n_bands") - 1)), lambda b: F.abs(b - F.col("band")) > seen)  # noqa: B023
        asked = state.select(name, "admin", "lon", "lat", F.explode(new).alias("band"))
        near = asked.join(index.edges, ["admin", "band"]).groupBy(name, "admin").agg(F.min(_to_edge()).alias("_km"))
        known = state.join(near, [name, "admin"], "left").withColumn("km", F.least("km", "_km")).drop("_km")
        # how far the nearest band not yet looked at is
        below = F.when(F.col("band") - reach > 0, F.col("lat") - (F.col("south") + (F.col("band") - reach) * F.col("height")))
        above = F.when(F.col("band") + reach < F.col("n_bands") - 1, F.col("south") + (F.col("band") + reach + 1) * F.col("height") - F.col("lat"))
        gap = F.least(below, above) * KM_PER_DEGREE
        known = stored(known.withColumn("_settled", F.coalesce(F.col("km") <= gap, gap.isNull())))
        done = done.unionByName(known.filter("_settled").select(name, "admin", "km"))
        state, seen, reach = known.filter("not _settled").drop("_settled"), reach, max(1, 2 * reach)
    return done


def check_site(points: DataFrame, edges: DataFrame | EdgeIndex, tolerance_km: float = 10.0, name: str = "site") -> DataFrame:
    """(site, verdict, fix): inside, near, outside or unknown; for outside the single edit that lands inside.

    A border that does not count as inside (``point_in_polygon``) is near, although its distance is 0.
    """
    edges = edges if isinstance(edges, EdgeIndex) else edge_index(edges)
    variants = F.array(
        F.struct(F.lit("as given").alias("edit"), F.col("lon").alias("x"), F.col("lat").alias("y")),
        F.struct(F.lit("latitude sign").alias("edit"), F.col("lon").alias("x"), (-F.col("lat")).alias("y")),
        F.struct(F.lit("longitude sign").alias("edit"), (-F.col("lon")).alias("x"), F.col("lat").alias("y")),
        F.struct(F.lit("both signs").alias("edit"), (-F.col("lon")).alias("x"), (-F.col("lat")).alias("y")),
        F.struct(F.lit("swapped").alias("edit"), F.col("lat").alias("x"), F.col("lon").alias("y")),
    )
    tried = points.select(name, "admin", F.posexplode(variants).alias("turn", "v")).select(F.struct(name, "turn").alias("key"), "admin", F.col("v.x").alias("lon"), F.col("v.y").alias("lat"), "v.edit")
    hit = point_in_polygon(tried.select("key", "admin", "lon", "lat"), edges, "key").join(tried.select("key", "edit"), "key")
    best = hit.groupBy(F.col(f"key.{name}").alias(name)).agg(F.min_by("edit", "key.turn").alias("edit"))
    far = distance_to_polygon(points, edges, name).select(name, "km")
    rows = points.select(name).join(far, name, "left").join(best, name, "left")
    verdict = F.when(F.col("km").isNull(), "unknown").when(F.col("edit") == "as given", "inside").when(F.col("km") <= tolerance_km, "near").otherwise("outside")
    return rows.select(name, verdict.alias("verdict"), F.when(verdict == "outside", F.col("edit")).alias("fix"))
