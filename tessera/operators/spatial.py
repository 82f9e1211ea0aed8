"""Grid adjacency and radius joins."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.stats import average_rank

#: The half of the eight offsets that finds each unordered pair of neighbours once.
HALF = ((1, 0), (0, 1), (1, 1), (1, -1))
#: Fixed letters of the eight neighbours; y + 1 is up.
LETTERS = {"A": (-1, 1), "B": (0, 1), "C": (1, 1), "D": (-1, 0), "E": (1, 0), "F": (-1, -1), "G": (0, -1), "H": (1, -1)}


def first_occupants(tiles: DataFrame, slide: str = "slides", x: str = "grid_col", y: str = "grid_row", order: str = "slide_tile") -> DataFrame:
    """Of tiles in one cell the first by name."""
    w = Window.partitionBy(slide, x, y).orderBy(order)
    return tiles.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


#: Side of a block of cells; a block holds at most a tile a cell, its own and those of a rim of one.
SIDE = 128
#: Tiles of a task that makes blocks of them, about: by it the number of tasks grows with the tiles, and their memory doesn't.
TILES_A_TASK = 250_000


def _by_block(tiles: DataFrame, around, schema: str, slide: str, x: str, y: str, label: str, name: str | None, first: str | None = None) -> DataFrame:
    """What ``around`` makes of the blocks of tiles that are alone in their cells, or of each cell's first tile by the column
    ``first``: it gets a block's table and, for an offset, the row of the tile that lies there from each own tile, or -1. Only
    tiles on a rim go to several blocks. Tiles are shuffled and sorted once: a block is where its cells are."""
    held = [F.col(label).alias("label")] + ([F.col(name).alias("tile")] if name else []) + ([F.col(first).alias("_first")] if first and first != name else [])
    t = tiles.select(F.col(slide).alias("slide"), F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y"), *held)
    block = lambda c: F.floor((c + SIDE // 2) / SIDE)  # noqa: E731  (cells count from 0, which should be no rim)
    near = lambda c: F.sequence(F.coalesce(block(F.col(c) - 1), F.lit(0)), F.coalesce(block(F.col(c) + 1), F.lit(0)))
    sent = t.withColumn("bx", F.explode(near("x"))).withColumn("by", F.explode(near("y")))
    sent = sent.withColumn("own", F.coalesce((F.col("bx") == block(F.col("x"))) & (F.col("by") == block(F.col("y"))), F.lit(True)))
    sent = sent.repartition(1 + tiles.count() // TILES_A_TASK, "slide", "bx", "by")
    if first:
        w = Window.partitionBy("slide", "bx", "by", "x", "y").orderBy("tile" if first == name else "_first")
        sent = sent.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth", "_first")

    def one(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own = np.flatnonzero(table.column("own").to_numpy())
        if table.column("x").null_count or table.column("y").null_count or table.column("slide").null_count:
            known = np.logical_and.reduce([table.column(c).is_valid().to_numpy() for c in ("slide", "x", "y")])
        else:
            known = np.ones(table.num_rows, bool)
        px, py = (table.column(c).fill_null(0).to_numpy() for c in ("x", "y"))
        x0, y0 = (table.column(c)[0].as_py() * SIDE - SIDE // 2 - 2 for c in ("bx", "by"))
        cells = np.full((SIDE + 4, SIDE + 4), -1)
        cells[px[known] - x0, py[known] - y0] = np.flatnonzero(known)
        own_x, own_y = np.where(known, px - x0, 1)[own], np.where(known, py - y0, 1)[own]
        at = lambda dx, dy: np.where(known[own], cells[own_x + dx, own_y + dy], -1)
        return around(table, own, at)

    return sent.groupBy("slide", "bx", "by").applyInArrow(one, schema)


def grid_pairs(tiles: DataFrame, slide: str = "slides", x: str = "grid_col", y: str = "grid_row", label: str = "hpc_id", name: str | None = "slide_tile", first: str | None = None) -> DataFrame:
    """Pairs of 8-neighbours, each once, of tiles that are alone in their cells, or of each cell's first tile by the column
    ``first``. Tiles meet in blocks of cells, to which they are sent once, without a join. With ``name`` None only labels go on."""
    kind = dict(tiles.dtypes)
    held = {"a": ("label", 0), "b": ("label", 1)} | ({"tile_a": ("tile", 0), "tile_b": ("tile", 1)} if name else {})

    def around(table: pa.Table, own: np.ndarray, at) -> pa.Table:
        met = [at(-dx, -dy) for dx, dy in HALF]
        ends = np.concatenate([m[m >= 0] for m in met]), np.concatenate([own[m >= 0] for m in met])
        return pa.table({"slide": table.column("slide").take(pa.array(ends[1])), **{n: table.column(c).take(pa.array(ends[e])) for n, (c, e) in held.items()}})

    schema = f"slide {kind[slide]}, " + ", ".join(f"{n} {kind[label if c == 'label' else name]}" for n, (c, _) in held.items())
    return _by_block(tiles, around, schema, slide, x, y, label, name, first)


def edge_counts(pairs: DataFrame) -> DataFrame:
    """Edges of each unordered pair of labels by slide; null labels are dropped."""
    p = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    return p.groupBy("slide", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("edges"))


def touching(pairs: DataFrame) -> DataFrame:
    """How many tiles of a label touch another label, by slide."""
    p = pairs.where("a <> b")
    side = lambda label, other, tile: F.struct(F.col(label).alias("label"), F.col(other).alias("other"), F.col(tile).alias("tile"))
    both = p.select("slide", F.explode(F.array(side("a", "b", "tile_a"), side("b", "a", "tile_b"))).alias("s")).select("slide", "s.*")
    return both.groupBy("slide", "label", "other").agg(F.countDistinct("tile").alias("tiles"))


def letter_neighbours(tiles: DataFrame, slide: str = "slides", x: str = "grid_col", y: str = "grid_row", label: str = "hpc_id", name: str = "slide_tile", first: str | None = None) -> DataFrame:
    """The label of each of the eight neighbours in a column of its own, null where there is none."""
    kind = dict(tiles.dtypes)

    def around(table: pa.Table, own: np.ndarray, at) -> pa.Table:
        met = {k: at(*d) for k, d in LETTERS.items()}
        return pa.table({"tile": table.column("tile").take(pa.array(own)), **{k: table.column("label").take(pa.array(m, mask=m < 0)) for k, m in met.items()}})

    schema = f"tile {kind[name]}, " + ", ".join(f"{k} {kind[label]}" for k in LETTERS)
    return _by_block(tiles, around, schema, slide, x, y, label, name, first)


def touching_tiles(tiles: DataFrame, slide: str = "slides", x: str = "grid_col", y: str = "grid_row", label: str = "hpc_id", first: str | None = None) -> DataFrame:
    """What ``touching`` counts, of tiles that are alone in their cells: each has all its neighbours in its block, so
    other labels are told apart there, and names need not travel."""
    kind = dict(tiles.dtypes)

    def around(table: pa.Table, own: np.ndarray, at) -> pa.Table:
        met = [at(*d) for d in LETTERS.values()]
        pairs = pa.table({"me": np.concatenate([own[m >= 0] for m in met]), "other": table.column("label").take(pa.array(np.concatenate([m[m >= 0] for m in met])))})
        each = pairs.group_by(["me", "other"], use_threads=False).aggregate([])
        out = pa.table({"slide": table.column("slide").take(each["me"]), "label": table.column("label").take(each["me"]), "other": each["other"]})
        return out.filter(pc.not_equal(out["label"], out["other"])).group_by(["slide", "label", "other"], use_threads=False).aggregate([([], "count_all")]).select(["slide", "label", "other", "count_all"]).rename_columns(["slide", "label", "other", "tiles"])

    found = _by_block(tiles, around, f"slide {kind[slide]}, label {kind[label]}, other {kind[label]}, tiles long", slide, x, y, label, None, first)
    return found.groupBy("slide", "label", "other").agg(F.sum("tiles").alias("tiles"))


def interactions(pairs: DataFrame, by: str = "slide") -> DataFrame:
    """Directed counts of neighbouring labels as shares, of the slide or of the label."""
    found = pairs.groupBy("slide", "a", "b").agg(F.count("*").alias("n"))  # counted once, then both ways round
    way = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    n = found.select("slide", F.explode(F.array(way("a", "b"), way("b", "a"))).alias("w"), "n").groupBy("slide", "w.a", "w.b").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("slide") if by == "slide" else Window.partitionBy("slide", "a")
    return n.withColumn("share", F.col("n") / F.sum("n").over(w))


def _near(dx: Column, dy: Column, r: float) -> Column:
    return dx * dx + dy * dy <= r * r


def radius_pairs(a: DataFrame, b: DataFrame, r: float, group: str = "core", cell: str = "cell") -> DataFrame:
    """Pairs within r of each other in a group. Points of b go to the squares of side r around theirs, so candidates
    are an equi-join; no pair of points further than two squares apart is made."""
    square = lambda c: F.floor(F.col(c) / r)
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("o")
    left = a.select(F.col(group).alias("g"), F.col(cell).alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("phenotype").alias("pa"), square("x").alias("sx"), square("y").alias("sy"))
    right = b.select(F.col(group).alias("g"), F.col(cell).alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("phenotype").alias("pb"), around, square("x").alias("qx"), square("y").alias("qy"))
    right = right.select("g", "b", "bx", "by", "pb", (F.col("qx") + F.col("o.i")).alias("sx"), (F.col("qy") + F.col("o.j")).alias("sy"))
    j = left.join(right, ["g", "sx", "sy"]).where((F.col("a") != F.col("b")) & _near(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"), r))
    return j.select(F.col("g").alias(group), "a", "b", "pa", "pb", F.sqrt((F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2).alias("d"))


def layers(pairs: DataFrame, radii: tuple[float, ...], group: str = "core") -> DataFrame:
    """Neighbours of each phenotype within each radius, from one join at the largest."""
    return pairs.groupBy(group, "pa", "pb").agg(*(F.count_if(F.col("d") <= r).alias(f"within_{r:g}") for r in radii))


def kth_nearest(pairs: DataFrame, k: int, group: str = "core") -> DataFrame:
    """The k-th nearest other point within the radius of the pairs; ties go to the smaller id."""
    w = Window.partitionBy(group, "a").orderBy("d", "b")
    return pairs.withColumn("k", F.row_number().over(w)).where(F.col("k") == k).select(group, "a", "b", "d")


def density(pairs: DataFrame, group: str = "core") -> DataFrame:
    """One over the mean distance to the nearest other point, by phenotype."""
    near = pairs.groupBy(group, "a", "pa").agg(F.min("d").alias("d"))
    return near.groupBy("pa").agg(F.round(1 / F.nullif(F.avg("d"), F.lit(0.0)), 6).alias("density"), F.count("*").alias("n"))


def density_correlation(cells: DataFrame, a: str, b: str, r: float, group: str = "core") -> DataFrame:
    """Spearman's correlation, over all cells of a core, of how many cells of two phenotypes lie nearer than r, the
    cell itself included; null where either count is the same everywhere."""
    near = radius_pairs(cells, cells, r, group).where(F.col("d") < r).groupBy(group, F.col("a").alias("cell"))
    near = near.agg(F.count_if(F.col("pb") == a).alias("na"), F.count_if(F.col("pb") == b).alias("nb"))
    own = lambda n, p: (F.coalesce(n, F.lit(0)) + (F.col("phenotype") == p).cast("int")).alias(n)
    n = cells.join(near, [group, "cell"], "left").select(group, own("na", a), own("nb", b))
    ranked = average_rank(average_rank(n, "na", group, out="ra"), "nb", group, out="rb")
    varied = (F.min("ra") < F.max("ra")) & (F.min("rb") < F.max("rb"))
    return ranked.groupBy(group).agg(F.count("*").alias("n"), F.round(F.when(varied, F.corr("ra", "rb")), 6).alias("rho"))


def tessellation(cells: DataFrame, tile: float, group: str = "core") -> DataFrame:
    """Cells of each phenotype in each square of a grid: each point is in one, so no join is needed."""
    sq = lambda c: F.floor(F.col(c) / tile).cast("int")
    return cells.groupBy(group, sq("x").alias("tx"), sq("y").alias("ty"), "phenotype").agg(F.count("*").alias("n"))


def buffer(cells: DataFrame, by: float, group: str = "core") -> DataFrame:
    """Points strictly inside the bounding box of their group by a distance."""
    box = cells.groupBy(group).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    inside = (F.col("x") > F.col("x0") + by) & (F.col("x") < F.col("x1") - by) & (F.col("y") > F.col("y0") + by) & (F.col("y") < F.col("y1") - by)
    return cells.join(box, group).where(inside).select(*cells.columns)


def _mean_of_pairs(cells: DataFrame, a: str, b: str, group: str = "core") -> DataFrame:
    """J24 where coordinates form no grid. Points that share a place are one before the join."""
    at = lambda p, n: cells.where(F.col("phenotype") == p).select(group, F.col("x").alias(f"x{n}"), F.col("y").alias(f"y{n}")).distinct()
    d = F.sqrt((F.col("x1") - F.col("x2")) ** 2 + (F.col("y1") - F.col("y2")) ** 2).alias("d")
    return at(a, 1).join(at(b, 2), group).select(group, d).where("d > 0").distinct().groupBy(group).agg(F.round(F.avg("d"), 6).alias("mean_distance"))

#: Side of a tile of places, and products of two tiles' places up to which they are taken one by one.
TILE, FEW_PAIRS = 256, 50_000


def _displacements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, d2: the squared lengths of all displacements from one tile's places to another's, each once. Where the tiles hold
    many, both become grids of zeros and ones, and their correlation, by Fourier transforms, counts each displacement."""
    for b in batches:
        for i in range(b.num_rows):
            (x0, y0), (x1, y1) = ((b.column(f"tx{s}")[i].as_py() * TILE, b.column(f"ty{s}")[i].as_py() * TILE) for s in (0, 1))
            p, q = (np.asarray(b.column(f"at{s}")[i].values, np.int64) for s in (0, 1))
            if len(p) * len(q) <= FEW_PAIRS:
                dx = (q // TILE)[None] - (p // TILE)[:, None] + (x1 - x0)
                dy = (q % TILE)[None] - (p % TILE)[:, None] + (y1 - y0)
            else:
                grids = np.zeros((2, 2 * TILE, 2 * TILE))
                grids[0].ravel()[(p // TILE) * 2 * TILE + p % TILE] = 1
                grids[1].ravel()[(q // TILE) * 2 * TILE + q % TILE] = 1
                f, g = np.fft.rfft2(grids)
                n = np.fft.irfft2(np.conj(f) * g, s=(2 * TILE, 2 * TILE))  # whole numbers of at most TILE * TILE, far apart from rounding
                dx, dy = np.nonzero(n > 0.5)
                dx, dy = (np.where(d >= TILE, d - 2 * TILE, d) + off for d, off in ((dx, x1 - x0), (dy, y1 - y0)))
            d2 = np.unique(dx * dx + dy * dy)
            grp = b.column("grp").slice(i, 1).take(pa.array(np.zeros(len(d2), np.int64)))
            yield pa.RecordBatch.from_arrays([grp, pa.array(d2)], ["grp", "d2"])


def mean_distance(cells: DataFrame, a: str, b: str, group: str = "core") -> DataFrame:
    """Mean of the distinct nonzero distances between two phenotypes, whose coordinates are whole numbers.

    Places form tiles of TILE by TILE; of each pair of tiles the displacements that occur are found by correlating
    occupancies, so work goes with tiles of the grid and not with pairs of cells, and a tile pair of whatever content is
    bounded. Lengths are whole numbers until they have met. With other coordinates places are paired up one by one.
    """
    own = cells.where(F.col("phenotype").isin(a, b) & F.col("x").isNotNull() & F.col("y").isNotNull())
    if not own.where((F.col("x") != F.floor("x")) | (F.col("y") != F.floor("y"))).isEmpty():
        return _mean_of_pairs(own, a, b, group)
    whole = lambda c: F.floor(c).cast("long")

    def tiles(p: str, n: int) -> DataFrame:
        at = own.where(F.col("phenotype") == p).select(F.col(group).alias("grp"), whole("x").alias("x"), whole("y").alias("y")).distinct()
        tx, ty = (F.floor(F.col(c) / TILE).cast("long") for c in "xy")
        place = (F.col("x") - tx * TILE) * TILE + F.col("y") - ty * TILE
        return at.groupBy("grp", tx.alias(f"tx{n}"), ty.alias(f"ty{n}")).agg(F.collect_list(place).alias(f"at{n}"))  # TILE * TILE at most

    kind = cells.schema[group].dataType.simpleString()
    d2 = tiles(a, 0).join(tiles(b, 1), "grp").mapInArrow(_displacements, f"grp {kind}, d2 long").where("d2 > 0").distinct()
    return d2.groupBy(F.col("grp").alias(group)).agg(F.round(F.avg(F.sqrt("d2")), 6).alias("mean_distance"))


def q_statistic(cells: DataFrame, quadrats: int = 10, group: str = "core") -> DataFrame:
    """Chi-square of counts in quadrats of the bounding box against an even spread."""
    box = cells.groupBy(group).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("all"))
    part = lambda c: F.least(F.floor((F.col(c) - F.col(f"{c}0")) * quadrats / F.nullif(F.col(f"{c}1") - F.col(f"{c}0"), F.lit(0))), F.lit(quadrats - 1))
    n = cells.join(box, group).groupBy(group, "all", F.coalesce(part("x"), F.lit(0)).alias("i"), F.coalesce(part("y"), F.lit(0)).alias("j")).agg(F.count("*").alias("n"))
    mean = F.col("all") / float(quadrats * quadrats)
    return n.groupBy(group, "all").agg((F.sum((F.col("n") - mean) ** 2 / mean) + (quadrats * quadrats - F.count("*")) * mean).alias("q")).select(group, F.round("q", 6).alias("q"))


def dbscan_noise(cells: DataFrame, eps: float = 10.0, least: int = 4, group: str = "core") -> DataFrame:
    """Cells and noise cells of each core: those with no dense cell within eps, where a dense one has ``least`` cells
    there, itself included. Pairs come from the radius join, so a large core is as many tasks' work as any."""
    pairs = radius_pairs(cells, cells, eps, group).select(group, "a", "b")
    dense = pairs.groupBy(group, F.col("a").alias("b")).agg(F.count("*").alias("n")).where(F.col("n") + 1 >= least).select(group, "b")
    if least <= 1:
        dense = cells.select(group, F.col("cell").alias("b"))
    reached = pairs.join(dense, [group, "b"], "left_semi").select(group, F.col("a").alias("cell")).unionAll(dense.select(group, F.col("b").alias("cell"))).distinct()
    j = cells.select(group, "cell").join(reached.withColumn("_in", F.lit(True)), [group, "cell"], "left")
    return j.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col("_in").isNull()).alias("noise"))


def coarse(df: DataFrame, by: int, x: str, y: str, *values: str, group: str = "slides") -> DataFrame:
    """Sums of a finer grid on one ``by`` times coarser."""
    sq = lambda c: F.floor(F.col(c) / by).cast("int").alias(c)
    return df.groupBy(group, sq(x), sq(y)).agg(F.count("*").alias("n_tiles"), *(F.sum(v).alias(v) for v in values))


