"""Search in a table of satellite scenes, and colour composites from their bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Band numbers shown as red, green and blue, and the display range.
COMBINATIONS = {
    "vegetation": (5, 4, 3),
    "natural_color": (4, 3, 2),
    "agriculture": (6, 5, 2),
    "land_water": (5, 6, 4),
    "urban": (7, 6, 4),
    "atmospheric": (7, 5, 4),
}
PLACE = ("lon", "lat")
FOOTPRINT = ("xmin", "ymin", "xmax", "ymax")
DISPLAY_MIN = 0.0
DISPLAY_MAX = 0.3


def scenes_at(df: DataFrame, lon: float, lat: float) -> DataFrame:
    """Scenes whose rectangular footprint contains a point, border included."""
    point_inside = F.lit(lon).between(F.col("xmin"), F.col("xmax")) & F.lit(lat).between(
        F.col("ymin"), F.col("ymax")
    )
    return df.where(point_inside)


def _cells(low: Column, high: Column, size: float) -> Column:
    """Numbers of the grid rows or columns from ``low`` to ``high``."""
    return F.sequence(F.floor(low / size).cast("int"), F.floor(high / size).cast("int"))


def scenes_of_points(
    points: DataFrame, scenes: DataFrame, point_columns: list[str], scene_columns: list[str], cell: float = 5.0
) -> DataFrame:
    """Each point (``lon, lat``) with every scene whose footprint contains it, border included.

    A footprint with ``xmin`` above ``xmax`` lies over the date line. Points and footprints meet by
    the cells of a grid, ``cell`` degrees wide: a point is in one cell, a footprint is sent to each
    cell it reaches into, once for its part on either side of the date line, and the exact test
    follows. So no point is compared with scenes far away. Points without a scene and anything with
    a null coordinate are left out; clashing names are up to the two lists of columns.
    """
    x = F.struct(F.col("xmin").alias("low"), F.col("xmax").alias("high"))
    east = F.struct(F.col("xmin").alias("low"), F.lit(180.0).alias("high"))
    west = F.struct(F.lit(-180.0).alias("low"), F.col("xmax").alias("high"))
    sides = F.when(F.col("xmin") <= F.col("xmax"), F.array(x)).otherwise(F.array(east, west))
    known = scenes.where("xmin IS NOT NULL AND xmax IS NOT NULL AND ymin <= ymax")
    parts = known.select(
        *scene_columns, F.col("ymin").alias("_ymin"), F.col("ymax").alias("_ymax"), F.explode(sides).alias("_x"))
    parts = parts.where("_x.low <= _x.high")
    columns = parts.withColumn("_cx", F.explode(_cells(F.col("_x.low"), F.col("_x.high"), cell)))
    reached = columns.withColumn("_cy", F.explode(_cells(F.col("_ymin"), F.col("_ymax"), cell)))
    placed = points.select(
        *point_columns, F.col("lon").alias("_lon"), F.col("lat").alias("_lat"),
        F.floor(F.col("lon") / cell).cast("int").alias("_cx"), F.floor(F.col("lat") / cell).cast("int").alias("_cy"))
    inside = F.col("_lon").between(F.col("_x.low"), F.col("_x.high")) & F.col("_lat").between(F.col("_ymin"), F.col("_ymax"))
    # All points of a cell follow each of its scenes: columnar files keep such a row in a byte or less, where the
    # longer run of scenes would come with each point.
    return reached.join(placed, ["_cx", "_cy"]).where(inside).select(*point_columns, *scene_columns)


def footprints_of_points(
    points: DataFrame, scenes: DataFrame, point_columns: list[str], scene_columns: list[str], cell: float = 5.0
) -> DataFrame:
    """The links of ``scenes_of_points``, each place and each footprint once, and what lies there.

    ``part`` tells the rows apart: a ``pair`` links a place and a footprint, a ``point`` or ``scene``
    says which place or footprint it has. Scenes of one footprint are not multiplied by the points
    under it; joined by their coordinates the three parts give every pair of point and scene, as often
    as it is there. Points without a scene are kept, what has a null coordinate is left out.
    """
    placed = points.where("lon IS NOT NULL AND lat IS NOT NULL")
    known = scenes.where("xmin IS NOT NULL AND xmax IS NOT NULL AND ymin <= ymax")
    pairs = scenes_of_points(
        placed.select(*PLACE).distinct(), known.select(*FOOTPRINT).distinct(), [*PLACE], [*FOOTPRINT], cell)
    parts = {
        "point": placed.select(*point_columns, *PLACE),
        "scene": known.select(*scene_columns, *FOOTPRINT),
        "pair": pairs,
    }
    out = None
    for part, rows in parts.items():
        rows = rows.select(F.lit(part).alias("part"), "*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select("part", *point_columns, *PLACE, *scene_columns, *FOOTPRINT)


def acquired_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """Scenes acquired from ``start`` up to, not including, ``end``."""
    return df.where(
        (F.col("acquired") >= F.lit(start).cast("date"))
        & (F.col("acquired") < F.lit(end).cast("date"))
    )


def scene_search(
    df: DataFrame, lon: float, lat: float, start: str, end: str, n: int = 1
) -> DataFrame:
    """The ``n`` least cloudy scenes over a point in a range of days."""
    found = acquired_between(scenes_at(df, lon, lat), start, end)
    return found.orderBy("cloud_cover", "scene_id").limit(n)


def scene_bands(df: DataFrame, *keep: str, col: str = "bands") -> DataFrame:
    """One row per band of a scene, numbered from 1."""
    numbered = df.select(*keep, F.posexplode(col).alias("_at", "value"))
    band = (F.col("_at") + 1).cast("bigint")
    return numbered.select(*keep, band.alias("band"), "value")


def _stretch(value: Column, low: float, high: float) -> Column:
    share = (value.cast("double") - F.lit(low)) / (F.lit(high) - F.lit(low))
    # greatest and least skip NULL, a missing band has to stay NULL.
    return F.when(share.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def _colours(combination: str, col: str, low: float, high: float) -> list[Column]:
    return [
        _stretch(F.get(col, F.lit(band - 1)), low, high).alias(colour)
        for colour, band in zip(("red", "green", "blue"), COMBINATIONS[combination])
    ]


def band_composite(
    df: DataFrame,
    combination: str,
    *keep: str,
    col: str = "bands",
    low: float = DISPLAY_MIN,
    high: float = DISPLAY_MAX,
) -> DataFrame:
    """``red, green, blue`` in 0..1 for one band combination; NULL for a missing band."""
    return df.select(*keep, *_colours(combination, col, low, high))


def band_composites(
    df: DataFrame,
    *keep: str,
    col: str = "bands",
    low: float = DISPLAY_MIN,
    high: float = DISPLAY_MAX,
) -> DataFrame:
    """Every band combination from one scan: a row for each, named in ``combination``."""
    shown = F.array(*[
        F.struct(*_colours(name, col, low, high), F.lit(name).alias("combination"))
        for name in COMBINATIONS
    ])
    return df.select(*keep, F.explode(shown).alias("shown")).select(*keep, "shown.*")
