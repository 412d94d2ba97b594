"""check_site on the borders of a box: west and south count as inside, east and north do not and are near, as in point_in_polygon."""

from curaspark.operators import geo


def test_check_site_on_borders(spark):
    edges = geo.rectangles_to_edges(spark.createDataFrame([("A", 10.0, -60.0, 50.0, 60.0)], "admin string, west double, south double, east double, north double"))
    places = {"west": (10.0, 0.0), "south": (20.0, -60.0), "east": (50.0, 12.0), "north": (20.0, 60.0), "middle": (20.0, 0.0), "beyond": (50.01, 12.0), "far": (-20.0, 5.0), "east only": (50.0, -12.0)}
    points = spark.createDataFrame([(k, "A", x, y) for k, (x, y) in places.items()] + [("none", "B", 0.0, 0.0)], "site string, admin string, lon double, lat double")
    inside = {r.site for r in geo.point_in_polygon(points, edges).collect()}
    told = {r.site: (r.verdict, r.fix) for r in geo.check_site(points, edges).collect()}
    assert inside == {"west", "south", "middle"} == {k for k, (verdict, _) in told.items() if verdict == "inside"}
    assert {k: told[k] for k in ("east", "east only", "north", "beyond")} == {k: ("near", None) for k in ("east", "east only", "north", "beyond")}
    assert told["far"] == ("outside", "longitude sign") and told["none"] == ("unknown", None)
