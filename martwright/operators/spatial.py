"""Distance joins and nearest points by equi-joins on grid cells."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions import EARTH_RADIUS_KM
from martwright.operators.joins import broadcast_if_small, exclude
from martwright.operators.ranking import number_rows
from martwright.session import land, materialize

# Cells with more rows than this are split into pieces that are joined by separate tasks.
HOT_CELL_ROWS = 20_000
# People who may pair are cut into groups of about so many rows, and into so many groups at most,
# as a row is sent to a task for each group; small tables into a few groups.
GROUP_ROWS = 400_000
MOST_GROUPS, LEAST_GROUPS = 40, 6
# Tags that are compared as bits of a long.
BITS = 63
# No cell is reached from more cells than this: three bands with at most twelve cells each.
_REACHED_FROM = 36
# Up to this many points are compared with each row in one expression, without a join.
INLINE_POINTS = 200
# Radii at which the search for nearest points may begin, and the points a cell may then hold.
RADII_KM = tuple(100.0 / 4**i for i in range(9))
CELL_POINTS = 4


class _Grid:
    """Latitude bands as high as the distance, each cut into cells at least as wide as the distance.

    Cell widths follow the band's smallest parallel, so the grid holds at the
    poles (one cell) and wraps at the antimeridian.
    """

    def __init__(self, km: float):
        # A little slack keeps points at exactly the distance inside the searched cells.
        self.reach = min(math.pi, (km * (1 + 1e-9) + 1e-6) / EARTH_RADIUS_KM)
        self.square_chord = (2 * math.sin(self.reach / 2)) ** 2
        self.height = math.degrees(self.reach)
        self.bands = max(1, math.ceil(180.0 / self.height))

    def band(self, lat: Column) -> Column:
        index = F.floor((lat + 90.0) / self.height)
        return F.greatest(F.lit(0), F.least(index, F.lit(self.bands - 1))).cast("int")

    def cells_in(self, band: Column) -> Column:
        low = band * self.height - 90.0
        edge = F.least(F.lit(90.0), F.greatest(F.abs(low), F.abs(low + self.height)))
        return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(edge)) / self.height)).cast("long")

    def own_cell(self, lon: Column, cells: Column) -> Column:
        return F.pmod(F.floor((lon + 180.0) / 360.0 * cells), cells)

    def half_width(self, lat: Column) -> Column:
        """Largest longitude difference within the distance, in degrees."""
        near_pole = F.abs(lat) + self.height >= 90.0
        ratio = F.least(F.lit(1.0), math.sin(min(self.reach, math.pi / 2)) / F.cos(F.radians(lat)))
        return F.when(near_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)) * (1 + 1e-9) + 1e-9)

    def spread(self, df: DataFrame, lat: Column, lon: Column) -> DataFrame:
        """A row for each of the ``searched_cells``, as ``__band`` and ``__cell``; compiled, as it has no lambda."""
        own, cells, span = self.band(lat), self.cells_in(F.col("__band")), self.half_width(lat)
        df = df.withColumn("__band", F.explode(F.array(own - 1, own, own + 1))).where((F.col("__band") >= 0) & (F.col("__band") < self.bands))
        df = df.withColumn("__cells", cells).withColumn("__first", F.floor((lon - span + 180.0) / 360.0 * F.col("__cells")))
        last = F.least(F.floor((lon + span + 180.0) / 360.0 * F.col("__cells")), F.col("__first") + F.col("__cells") - 1)
        df = df.withColumn("__cell", F.explode(F.sequence("__first", last)))
        return df.withColumn("__cell", F.pmod("__cell", "__cells")).drop("__cells", "__first")

    def searched_cells(self, lat: Column, lon: Column) -> Column:
        """Array of the (band, cell) pairs that can hold points within the distance."""
        own = self.band(lat)
        span = self.half_width(lat)

        def in_band(band: Column) -> Column:
            cells = self.cells_in(band)
            first = F.floor((lon - span + 180.0) / 360.0 * cells)
            last = F.floor((lon + span + 180.0) / 360.0 * cells)
            last = F.least(last, first + cells - 1)
            return F.transform(
                F.sequence(first, last),
                lambda c: F.struct(band.cast("int").alias("__band"), F.pmod(c, cells).alias("__cell")),
            )

        near = F.filter(
            F.array(own - 1, own, own + 1), lambda b: (b >= 0) & (b < self.bands)
        )
        return F.flatten(F.transform(near, in_band))


def grid_join(
    a: DataFrame,
    b: DataFrame,
    km: float,
    same: Sequence[str] = (),
    a_at: tuple[str, str] = ("lat", "lon"),
    b_at: tuple[str, str] = ("lat_b", "lon_b"),
    hot_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """All pairs within ``km`` that agree on the ``same`` columns, with ``distance_km``.

    Every row of ``a`` has one cell and every row of ``b`` is sent to the cells
    it can reach, so each pair meets once. Rows of ``a`` and ``b`` must be
    distinct; rows without a position are left out. A crowded cell is cut into k x k pieces: each side is cut by its
    hash and repeated for the pieces of the other side, so no task gets more
    than about ``hot_rows`` rows of either side and no pair is lost.
    """
    found = _pairs_within(a, b, km, same, a_at, b_at, hot_rows)
    return found.select(*dict.fromkeys([*a.columns, *b.columns]), "distance_km")


def _pairs_within(a, b, km, same, a_at, b_at, hot_rows=HOT_CELL_ROWS) -> DataFrame:
    """``grid_join`` with the squared chord of each pair as ``__square``."""
    a, b = a.dropna(subset=list(a_at)), b.dropna(subset=list(b_at))
    grid = _Grid(km)
    lat, lon = F.col(a_at[0]), F.col(a_at[1])
    band = grid.band(lat)
    placed = a.withColumn("__band", band).withColumn("__cell", grid.own_cell(lon, grid.cells_in(F.col("__band"))))
    # Unit vectors are made once per row, so that a pair costs a few multiplications.
    placed = _with_vector(placed, a_at, "__a")
    reach = _with_vector(b, b_at, "__b").withColumn("__at", F.explode(grid.searched_cells(F.col(b_at[0]), F.col(b_at[1]))))
    reach = reach.withColumn("__band", F.col("__at.__band")).withColumn("__cell", F.col("__at.__cell")).drop("__at")

    keys = cell = [*same, "__band", "__cell"]
    b_lat, b_lon = F.col(b_at[0]), F.col(b_at[1])
    b_band = grid.band(b_lat)
    b_own = [*same, b_band.alias("__band"), grid.own_cell(b_lon, grid.cells_in(b_band)).alias("__cell")]
    # A cell can only be reached from few cells, so without a fairly full cell none is crowded.
    if not (_crowded(placed, cell, hot_rows).isEmpty() and _crowded(b, b_own, hot_rows // _REACHED_FROM).isEmpty()):
        crowd = _crowded(placed, cell, hot_rows).unionByName(_crowded(reach, cell, hot_rows))
        parts = F.ceil(F.max("__n") / hot_rows).cast("int").alias("__k")
        hot = materialize(crowd.groupBy(*cell).agg(parts))
        keys = [*cell, "__piece_a", "__piece_b"]
        placed = _pieces(placed, hot, cell, a.columns, "__piece_a", "__piece_b")
        reach = _pieces(reach, hot, cell, b.columns, "__piece_b", "__piece_a")
    # Size estimates ignore that the rows were repeated per cell, hence the measure.
    reach = broadcast_if_small(reach, otherwise="merge")
    square = sum(_square(F.col(f"__a{i}") - F.col(f"__b{i}")) for i in "xyz")
    met = placed.join(reach, keys).withColumn("__square", square).where(F.col("__square") <= grid.square_chord)
    return met.withColumn("distance_km", _chord_km(F.col("__square"))).where(F.col("distance_km") <= km)


class PairBlocks:
    """Deals rows of people so that all rows of two people are in one task, once.

    People are cut in their order into groups of about ``rows`` rows; block (i, j)
    gets the left rows of group i and the right rows of group j, i <= j. What is
    joined or aggregated per block and pair needs no further shuffle, so pairs of
    rows, which grow with the square of a place, are never written.
    """

    column = "__pairs"

    def __init__(self, people: DataFrame, person: str, rows: int = GROUP_ROWS):
        """``people`` has a row for each row that is dealt later."""
        self.person = person
        starts = number_rows(people.select(person).dropna(), [F.col(person)], "__n").groupBy(person).agg(F.min("__n").alias("__n"), F.count("*").alias("__rows"))
        starts = land(starts)
        total = starts.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
        self.groups = min(MOST_GROUPS, max(math.ceil(total / rows), min(LEAST_GROUPS, math.ceil(total / 1000)), 1))
        self.people = starts.select(person, F.floor((F.col("__n") - 1) * self.groups / max(total, 1)).cast("int").alias("__group"))

    def _block(self, i: Column, j: Column) -> Column:
        # Numbers from 0 without gaps, as they are task numbers.
        return (i * self.groups - F.floor(i * (i - 1) / 2) + j - i).cast("int")

    def left(self, df: DataFrame) -> DataFrame:
        """Rows with ``__group``, in all blocks of which they are the left side."""
        return self._deal(df.withColumn("__j", F.explode(F.sequence(F.col("__group"), F.lit(self.groups - 1)))), F.col("__group"), F.col("__j"))

    def right(self, df: DataFrame) -> DataFrame:
        """Rows with ``__group``, in all blocks of which they are the right side."""
        return self._deal(df.withColumn("__j", F.explode(F.sequence(F.lit(0), F.col("__group")))), F.col("__j"), F.col("__group"))

    def pairs(self, df: DataFrame) -> DataFrame:
        """Rows of <person>_left and <person>_right in the block of the pair; pairs of people without rows go."""
        one, two = (self.people.toDF(f"{self.person}_{side}", name) for side, name in (("left", "__group"), ("right", "__j")))
        return self._deal(df.join(one, f"{self.person}_left").join(two, f"{self.person}_right").where(F.col("__group") <= F.col("__j")), F.col("__group"), F.col("__j"))

    def _deal(self, df: DataFrame, i: Column, j: Column) -> DataFrame:
        dealt = df.withColumn(self.column, self._block(i, j)).drop("__group", "__j")
        return dealt.repartitionById(self.groups * (self.groups + 1) // 2, F.col(self.column))


def _tags(members: DataFrame, people: DataFrame, person: str, tag: str) -> tuple[DataFrame, bool]:
    """Tags of the people with places, and whether two people share one or more on average.

    If they do, people meet by place alone: the most frequent tags are bits of ``__bits``,
    all others the list ``__rare``. Else they meet tag by tag of the list ``__tags``.
    """
    members = materialize(members.select(person, tag).dropna().distinct().join(people.select(person), person))
    counts = members.groupBy(tag).agg(F.count("*").alias("__n"))
    shared = counts.agg(F.sum(F.col("__n").cast("double") * F.col("__n"))).first()[0] or 0.0
    held = members.groupBy(person)
    if shared < float(members.select(person).distinct().count()) ** 2:
        return held.agg(F.array_sort(F.collect_list(tag)).alias("__tags")), False
    # A bounded list: as many tags as a long has bits.
    most = counts.orderBy(F.col("__n").desc(), tag).limit(BITS).collect()
    kind = members.schema[tag].dataType
    bit = reduce(lambda found, x: found.when(F.col(tag) == F.lit(x[1][tag]).cast(kind), F.lit(1 << x[0])), enumerate(most), F.when(F.lit(False), F.lit(0)))
    bits = members.withColumn("__bit", bit.cast("long")).groupBy(person)
    rare = F.collect_list(F.when(F.col("__bit").isNull(), F.col(tag)))
    held = bits.agg(F.coalesce(F.bit_or("__bit"), F.lit(0)).cast("long").alias("__bits"), rare.alias("__rare"))
    return held.withColumn("__rare", F.when(F.size("__rare") > 0, F.col("__rare"))), True


def _sharing(left: DataFrame, right: DataFrame, members: DataFrame, person: str, tag: str, cell: Sequence[str], blocks: PairBlocks, ready: Sequence[Callable[[DataFrame], DataFrame]] = ()) -> DataFrame:
    """Pairs of rows of ``left`` and ``right`` in one cell, the person on the left being the smaller one, who share a tag.

    Rows have the columns of both sides and ``blocks.column``, by which they stay dealt.
    ``ready`` makes columns of the left and of the right rows after dealing, so that they are not shuffled.
    """
    tags, by_place = _tags(members, blocks.people, person, tag)
    tags = land(tags.join(blocks.people, person))
    one, two = f"{person}_left", f"{person}_right"
    # Whatever their size: rows of places are joined to the tags of their people without going through the driver.
    held = [tags.withColumnRenamed(person, p).hint("merge") for p in (one, two)]
    a, b = blocks.left(left.join(held[0], one)), blocks.right(right.join(held[1], two))
    if ready:
        a, b = ready[0](a), ready[1](b)
    keys = [blocks.column, *cell]
    if by_place:
        a, b = (df.withColumnsRenamed({"__bits": f"__bits_{x}", "__rare": f"__rare_{x}"}) for df, x in ((a, "a"), (b, "b")))
        shares = (F.col("__bits_a").bitwiseAND(F.col("__bits_b")) != 0) | F.coalesce(F.arrays_overlap("__rare_a", "__rare_b"), F.lit(False))
    else:
        # A pair counts by the first of the tags that it shares.
        a, b = (df.select("*", F.posexplode("__tags").alias("__at", "__tag")).withColumn(f"__before_{x}", F.slice("__tags", F.lit(1), F.col("__at"))).drop("__tags", "__at") for df, x in ((a, "a"), (b, "b")))
        keys, shares = [*keys, "__tag"], ~F.arrays_overlap("__before_a", "__before_b")
    # Spark sorts by the first bytes of the first key, which are to tell most cells apart.
    a, b = (df.withColumn("__hash", F.xxhash64(*keys[1:])) for df in (a, b))
    met = a.join(b.hint("merge"), ["__hash", *keys]).where((F.col(one) < F.col(two)) & shares)
    return met.drop("__hash", "__tag", *(f"__{name}_{x}" for name in ("bits", "rare", "before") for x in "ab"))


def sharing_pairs(
    left: DataFrame, right: DataFrame, members: DataFrame, person: str, tag: str, cell: Sequence[str], hot_rows: int = GROUP_ROWS
) -> DataFrame:
    """Distinct (<person>_left, <person>_right, *cell) of people with places in a cell who share a tag.

    People meet through the list of a cell, or of (cell, tag) where tags are
    narrow, so people without a common tag never meet, however crowded the cell
    is. They are dealt by ``PairBlocks`` in groups of about ``hot_rows`` rows.
    """
    sides = [df.select(person, *cell).distinct() for df in (left, right)]
    blocks = PairBlocks(sides[0].select(person).unionByName(sides[1].select(person)), person, hot_rows)
    one, two = (df.withColumnRenamed(person, f"{person}_{side}") for df, side in zip(sides, ("left", "right"), strict=True))
    return _sharing(one, two, members, person, tag, cell, blocks).select(f"{person}_left", f"{person}_right", *cell)


def close_pairs(
    spots: DataFrame,
    members: DataFrame,
    km: float,
    person: str,
    tag: str,
    same: Sequence[str] = (),
    at: tuple[str, str] = ("lat", "lon"),
    without: DataFrame | None = None,
    hot_rows: int = GROUP_ROWS,
    blocks: PairBlocks | None = None,
) -> DataFrame:
    """Spots of two people within ``km`` who agree on ``same`` and share a tag, with ``distance_km``.

    ``members`` has the tags of each person, ``without`` pairs (<person>_left,
    <person>_right) to leave out. Spots meet in the task of their pair of people and
    a distance is taken only for people who share a tag; pairs are never shuffled.
    Rows have the columns of the left person's spot, whose person is the smaller one,
    and <person>_right. With ``blocks`` of the spots they keep its column too, and
    stay dealt by it for what is done per pair.
    """
    grid = _Grid(km)
    lat, lon = F.col(at[0]), F.col(at[1])
    spots = spots.dropna(subset=[person, *at])
    dealt = blocks
    if blocks is None:
        spots = land(spots)
        dealt = PairBlocks(spots, person, hot_rows)
    one, two = f"{person}_left", f"{person}_right"
    right_at = tuple(f"__right_{c}" for c in at)
    right = spots.select(F.col(person).alias(two), *same, *(F.col(c).alias(name) for c, name in zip(at, right_at, strict=True)))

    # Unit vectors are made once per row, so that a pair costs a few multiplications.
    def placed(df: DataFrame) -> DataFrame:
        df = df.withColumn("__band", grid.band(lat)).withColumn("__cell", grid.own_cell(lon, grid.cells_in(F.col("__band"))))
        return _with_vector(df, at, "__a")

    def reach(df: DataFrame) -> DataFrame:
        return grid.spread(_with_vector(df, right_at, "__b"), *map(F.col, right_at)).drop(*right_at)

    met = _sharing(spots.withColumnRenamed(person, one), right, members, person, tag, [*same, "__band", "__cell"], dealt, (placed, reach))
    if without is not None:
        met = exclude(met, dealt.pairs(without), [dealt.column, one, two])
    met = met.withColumn("__square", sum(_square(F.col(f"__a{i}") - F.col(f"__b{i}")) for i in "xyz")).where(F.col("__square") <= grid.square_chord)
    # Well inside, the distance itself need not be asked.
    sure = (2 * math.sin(min(math.pi, km * (1 - 1e-9) / EARTH_RADIUS_KM) / 2)) ** 2
    met = met.withColumn("distance_km", _chord_km(F.col("__square"))).where((F.col("__square") <= sure) | (F.col("distance_km") <= km))
    return met.select(*([dealt.column] if blocks else []), *(c if c != person else one for c in spots.columns), two, "distance_km")


def _with_vector(df: DataFrame, at: tuple[str, str], name: str) -> DataFrame:
    """Add the unit vector of a position as ``<name>x``, ``<name>y`` and ``<name>z``."""
    phi, lam = F.radians(F.col(at[0])), F.radians(F.col(at[1]))
    vector = {"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)}
    return df.withColumns({f"{name}{axis}": value for axis, value in vector.items()})


def _square(value: Column) -> Column:
    return value * value


def _chord_km(square: Column) -> Column:
    """Great-circle distance from the squared chord of two unit vectors."""
    half = F.sqrt(square) / 2
    return 2 * EARTH_RADIUS_KM * F.asin(F.when(half > 1.0, 1.0).otherwise(half))


def _crowded(df: DataFrame, cell: Sequence[Column | str], rows: int) -> DataFrame:
    """Cells with more rows than allowed; counts combine before the shuffle."""
    return df.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows)


def _pieces(
    df: DataFrame, hot: DataFrame, cell: Sequence[str], cols: Sequence[str], own: str, other: str
) -> DataFrame:
    """Number the row's own piece of a hot cell and repeat it for every piece of the other side."""
    parts = F.coalesce(F.col("__k"), F.lit(1))
    return (
        df.join(hot, list(cell), "left")
        .withColumn(own, F.pmod(F.xxhash64(*cols), parts).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("__k")
    )


def nearest(
    df: DataFrame,
    points: DataFrame,
    id_col: str,
    attrs: Sequence[str],
    at: tuple[str, str] = ("lat", "lon"),
    points_at: tuple[str, str] = ("lat", "lon"),
    inline_points: int = INLINE_POINTS,
) -> DataFrame:
    """Add the attributes of the nearest point and ``distance_km``; equal distances go to the lower id.

    A counted small set of points becomes one expression per row: no join, no
    shuffle. A larger set is searched by growing grid joins over the distinct
    positions. Both ways compare the squared chord of unit vectors that Spark
    has made with the same functions. Rows without a position (NULL or NaN) get NULL.
    """
    kept = [c for c in dict.fromkeys([id_col, *attrs]) if c not in df.columns]
    located = points.select(*dict.fromkeys([id_col, *attrs, *points_at])).dropna(subset=list(points_at))
    few = _with_vector(located, points_at, "__").orderBy(id_col).limit(inline_points + 1).collect()
    if 0 < len(few) <= inline_points:
        return _nearest_inline(df, located, few, kept, at)
    return _nearest_grid(df, located, id_col, kept, at, points_at)


def _nearest_inline(df, points, few, kept, at) -> DataFrame:
    """Compare squared chords between unit vectors, which grow with the great-circle distance."""
    placed = _with_vector(df, at, "__v")
    chords = [sum(_square(F.col(f"__v{i}") - F.lit(row[f"__{i}"])) for i in "xyz") for row in few]
    somewhere = ~(F.isnan(at[0]) | F.isnan(at[1]))
    measured = placed.withColumn("__all", F.when(somewhere, F.array(*chords))).withColumn("__least", F.array_min("__all"))
    # The first of equal distances has the lowest id because the points are in id order.
    found = measured.withColumn("__n", F.array_position("__all", F.col("__least")).cast("int") - 1)
    types = {f.name: f.dataType for f in points.schema.fields}
    values = [
        F.get(F.array(*[F.lit(row[c]).cast(types[c]) for row in few]), F.col("__n")).alias(c) for c in kept
    ]
    return found.select(*df.columns, *values, _chord_km(F.col("__least")).alias("distance_km"))


def _first_radius(targets: DataFrame, at: tuple[str, str]) -> float:
    """The largest of the search radii at which no grid cell holds more than CELL_POINTS points."""
    lat, lon = F.col(at[0]), F.col(at[1])
    cells = []
    for km in RADII_KM:
        grid = _Grid(km)
        band = grid.band(lat)
        cells.append(F.struct(F.lit(km).alias("km"), band.alias("band"), grid.own_cell(lon, grid.cells_in(band)).alias("cell")))
    counts = targets.select(F.inline(F.array(*cells))).groupBy("km", "band", "cell").count()
    # One row per radius.
    crowd = {r["km"]: r["most"] for r in counts.groupBy("km").agg(F.max("count").alias("most")).collect()}
    return max((km for km in RADII_KM if crowd.get(km, 0) <= CELL_POINTS), default=min(RADII_KM))


def _nearest_grid(df, points, id_col, kept, at, points_at) -> DataFrame:
    """Search the distinct positions in growing radii; a hit within the radius is exact.

    The first radius follows the densest place of the points, and only positions
    without a hit go on, so a position meets few points however dense they are.
    """
    spots = land(df.select(F.col(at[0]).alias("__lat"), F.col(at[1]).alias("__lon")).dropna().distinct())
    named = [f"__p_{c}" for c in dict.fromkeys([id_col, *kept])]
    targets = points.select(
        *[F.col(c).alias(f"__p_{c}") for c in dict.fromkeys([id_col, *kept])],
        F.col(points_at[0]).alias("__plat"),
        F.col(points_at[1]).alias("__plon"),
    )
    # Of points at one place only the lowest id can win.
    best = F.min(F.struct(*named)).alias("__best")
    targets = land(targets.groupBy("__plat", "__plon").agg(best).select("__plat", "__plon", "__best.*"))
    order = F.struct("__square", *named, "distance_km")
    found, radius, half_way = None, _first_radius(targets, ("__plat", "__plon")), math.pi * EARTH_RADIUS_KM
    while True:
        radius = min(radius, half_way)
        pairs = _pairs_within(spots, targets, radius, (), ("__lat", "__lon"), ("__plat", "__plon"))
        hits = land(pairs.groupBy("__lat", "__lon").agg(F.min(order).alias("__hit")))
        found = hits if found is None else found.unionByName(hits)
        if radius >= half_way:
            break
        spots = land(spots.join(hits, ["__lat", "__lon"], "left_anti"))
        if spots.isEmpty():
            break
        radius *= 4
    joined = df.join(found, (df[at[0]] == found["__lat"]) & (df[at[1]] == found["__lon"]), "left")
    return joined.select(
        *df.columns, *[F.col(f"__hit.__p_{c}").alias(c) for c in kept], F.col("__hit.distance_km").alias("distance_km")
    )
