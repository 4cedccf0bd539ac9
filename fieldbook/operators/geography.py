"""County codes and county outlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F


def set_other_county_na(
    cust: DataFrame, county_map: DataFrame, observation: Observation | None = None
) -> DataFrame:
    """``county_fips`` becomes NULL when the outline table (column ``fips``) does not have it.

    With an ``observation`` the number changed is reported as ``other_state``.
    """
    known = county_map.select(F.col("fips").alias("county_fips")).distinct().withColumn("_known", F.lit(True))
    out = cust.join(known, "county_fips", "left")
    if observation is not None:
        changed = F.col("county_fips").isNotNull() & F.col("_known").isNull()
        out = out.observe(observation, F.count_if(changed).alias("other_state"))
    return out.withColumn("county_fips", F.when(F.col("_known"), F.col("county_fips"))).select(*cust.columns)


def set_nonres_county_na(history: DataFrame) -> DataFrame:
    """``county_fips`` becomes NULL for nonresidents and unknown residency."""
    home = F.when(F.col("res").isNotNull() & (F.col("res") != 0), F.col("county_fips"))
    return history.withColumn("county_fips", home)


def county_from_zip(cust: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Fill a missing ``county_fips`` from a ``zip, county_fips`` crosswalk with one row per zip."""
    by_zip = crosswalk.select("zip", F.col("county_fips").alias("_zip_fips"))
    return (
        cust.join(by_zip, "zip", "left")
        .withColumn("county_fips", F.coalesce("county_fips", "_zip_fips"))
        .select(*cust.columns)
    )


def outline_cells(county_map: DataFrame, cell: float) -> DataFrame:
    """Grid cells that outlines reach into: ``ix, iy, counties``, with the edges that can decide a point of the cell.

    A cell lists the counties whose bounding box covers it; of each outline it holds the edges in the cell's
    band of latitude, which are all that a ray along the latitude can cross.  The last vertex joins the first.
    ``cell`` (degrees) trades the number of cells for the number of edges and counties in one; a cell's arrays
    are bounded by the outlines that overlap there.
    """
    def index(value: Column) -> Column:
        return F.floor(value / F.lit(float(cell))).cast("long")

    ring = Window.partitionBy("county_fips").orderBy("seq")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = county_map.filter(F.col("county_fips").isNotNull()).select(
        "county_fips",
        F.col("long").alias("x1"),
        F.col("lat").alias("y1"),
        F.coalesce(F.lead("long").over(ring), F.first("long").over(whole)).alias("x2"),
        F.coalesce(F.lead("lat").over(ring), F.first("lat").over(whole)).alias("y2"),
    )
    band = F.explode(F.sequence(index(F.least("y1", "y2")), index(F.greatest("y1", "y2")))).alias("iy")
    edge = F.struct("x1", "y1", "x2", "y2")
    bands = edges.filter("y1 <> y2").select("county_fips", band, edge.alias("edge")).groupBy("county_fips", "iy").agg(F.collect_list("edge").alias("edges"))
    boxes = edges.groupBy("county_fips").agg(F.min("x1").alias("west"), F.max("x1").alias("east"))
    across = F.explode(F.sequence(index(F.col("west")), index(F.col("east")))).alias("ix")
    return (
        bands.join(boxes, "county_fips")
        .select(across, "iy", F.struct("county_fips", "edges").alias("county"))
        .groupBy("ix", "iy")
        .agg(F.sort_array(F.collect_list("county")).alias("counties"))
    )


def county_of_point(points: DataFrame, county_map: DataFrame, cell: float = 0.5) -> DataFrame:
    """``points`` (with ``long``, ``lat``) and the ``county_fips`` whose outline holds them.

    Points meet outlines on their grid cell, an equi-join; the exact test then counts the edges that a ray
    to the east crosses.  An edge counts from its lower end up to, not including, its upper one, so a point on
    a shared border belongs to one side.  In several outlines: the smallest code; in none, or without a
    coordinate: NULL.  A cell has one row, so points are never multiplied and a crowded cell is an ordinary
    skewed key.  A column ``county_fips`` of ``points`` is replaced.
    """
    kept = [c for c in points.columns if c != "county_fips"]
    lng, lat = F.col("long").cast("double"), F.col("lat").cast("double")

    def crossed(e: Column) -> Column:
        meets = (e["y1"] > lat) != (e["y2"] > lat)
        return F.when(meets, lng < (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]).otherwise(False)

    def holds(county: Column) -> Column:
        return F.size(F.filter(county["edges"], crossed)) % 2 == 1

    found = F.filter("counties", holds)
    size = F.lit(float(cell))
    return (
        points.select(*kept, F.floor(lng / size).cast("long").alias("ix"), F.floor(lat / size).cast("long").alias("iy"))
        .join(outline_cells(county_map, cell), ["ix", "iy"], "left")
        .select(*kept, F.try_element_at(found, F.lit(1))["county_fips"].alias("county_fips"))
    )


def _county_rows(dashboard: DataFrame, county_census: DataFrame) -> DataFrame:
    census = county_census.select(F.col("county").alias("category"), "county_fips")
    return dashboard.filter(F.lower("segment") == "county").join(census, "category", "left")


def join_county_map(dashboard: DataFrame, county_map: DataFrame, county_census: DataFrame) -> DataFrame:
    """The dashboard with ``county_fips`` and ``outline`` on its county rows; one row per dashboard row.

    ``outline`` is the array of a county's vertices in drawing order; whoever draws explodes it.  The
    census table links county names to codes, which link to outlines.  Rows of other segments, and
    counties without either, have NULLs.  Segments are lower case in the result.
    """
    census = county_census.select(F.col("county").alias("category"), F.lit("county").alias("segment"), "county_fips")
    return (
        dashboard.withColumn("segment", F.lower("segment"))
        .join(census, ["segment", "category"], "left")
        .join(county_outlines(county_map), "county_fips", "left")
        .select(*dashboard.columns, "county_fips", "outline")
    )


def county_outlines(county_map: DataFrame) -> DataFrame:
    """One row per county: ``county_fips`` and ``outline``, its vertices ``seq, long, lat`` in order.

    An outline has some hundred vertices, which bounds the array.
    """
    vertex = F.struct("seq", "long", "lat")
    return county_map.groupBy("county_fips").agg(F.sort_array(F.collect_list(vertex)).alias("outline"))


def county_map_missing(dashboard: DataFrame, county_map: DataFrame, county_census: DataFrame) -> DataFrame:
    """QA row: county rows without a code, and distinct codes without an outline."""
    drawn = county_map.select("county_fips").distinct().withColumn("_drawn", F.lit(True))
    per_code = (
        _county_rows(dashboard, county_census)
        .groupBy("county_fips")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(drawn, "county_fips", "left")
    )
    code = F.col("county_fips")
    return per_code.agg(
        F.coalesce(F.sum(F.when(code.isNull(), F.col("n"))), F.lit(0)).alias("rows_without_fips"),
        F.count_if(code.isNotNull() & F.col("_drawn").isNull()).alias("fips_without_outline"),
    )
