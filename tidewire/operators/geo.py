"""Two-dimensional Gaussian kernel density on a grid.

Bandwidth: the sample covariance times the square of n^(-1/6). The grid reaches ``cut`` bandwidths beyond the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _points(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull()
    )


def _extent(points: DataFrame) -> Column:
    return points.select(
        F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    ).scalar()


def bin_points(df: DataFrame, x: str, y: str, bins: int = 128) -> DataFrame:
    """Points per cell of a ``bins`` x ``bins`` grid, with the mean position in the cell.

    The kernel then runs over at most bins^2 rows, however many points there are.
    """
    points = _points(df, x, y)

    def cell(value: str, low: Column, high: Column) -> Column:
        width = (high - low) / F.lit(float(bins))
        index = F.floor((F.col(value) - low) / width).cast("int")
        return F.when(width > 0, F.least(index, F.lit(bins - 1))).otherwise(F.lit(0))

    extent = F.col("e")
    celled = points.withColumn("e", _extent(points)).select(
        "x", "y", cell("x", extent.x0, extent.x1).alias("cx"), cell("y", extent.y0, extent.y1).alias("cy")
    )
    return celled.groupBy("cx", "cy").agg(
        F.count("*").alias("weight"), F.avg("x").alias("mean_x"), F.avg("y").alias("mean_y")
    )


def kde_grid(
    df: DataFrame, x: str, y: str, gridsize: int = 64, bins: int | None = 128, cut: float = 3
) -> DataFrame:
    """(ix, iy, x, y, density). ``bins=None`` evaluates every point: exact, at gridsize^2 steps per point.

    All statistics come from the points themselves, in one pass; binning only moves points to their cell's mean.
    """
    points = _points(df, x, y)
    stats = points.select(
        F.struct(
            F.count("*").cast("double").alias("n"),
            F.min("x").alias("x0"),
            F.max("x").alias("x1"),
            F.min("y").alias("y0"),
            F.max("y").alias("y1"),
            F.var_samp("x").alias("vx"),
            F.var_samp("y").alias("vy"),
            F.covar_samp("x", "y").alias("vxy"),
        )
    ).scalar()
    if bins is None:
        weighted = points.select("x", "y", F.lit(1e0).alias("w"))
    else:
        # The cells are few rows but carry all the work: given a number, Spark does not merge them into one task.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cells = bin_points(df, x, y, bins).repartition(tasks, "cx", "cy")
        weighted = cells.select(
            F.col("mean_x").alias("x"), F.col("mean_y").alias("y"), F.col("weight").cast("double").alias("w")
        )

    s = F.col("s")
    last = F.lit(float(gridsize - 1))
    scale = F.pow(s.n, F.lit(-2e0 / 6e0))
    hx, hy, hxy = s.vx * scale, s.vy * scale, s.vxy * scale
    det = hx * hy - hxy * hxy
    pad_x, pad_y = F.sqrt(hx) * F.lit(float(cut)), F.sqrt(hy) * F.lit(float(cut))

    # Grid and kernel are plain numbers per query; `g` keeps them in one struct next to each row.
    grid = F.struct(
        (s.x0 - pad_x).alias("gx"),
        ((s.x1 + pad_x - (s.x0 - pad_x)) / last).alias("sx"),
        (s.y0 - pad_y).alias("gy"),
        ((s.y1 + pad_y - (s.y0 - pad_y)) / last).alias("sy"),
        (hy / det).alias("axx"),
        (hx / det).alias("ayy"),
        (-hxy / det).alias("axy"),
        (s.n * F.lit(2e0) * F.pi() * F.sqrt(det)).alias("norm"),
    )
    placed = weighted.withColumn("s", stats).where(det > 0).select("x", "y", "w", grid.alias("g"))
    return _by_points(placed, gridsize) if bins is None else _by_cells(placed, gridsize)


def _by_cells(placed: DataFrame, gridsize: int) -> DataFrame:
    """The kernel of at most bins^2 rows, each spread over the grid."""
    g = F.col("g")
    steps = F.sequence(F.lit(0), F.lit(gridsize - 1))
    px, py = g.gx + F.col("ix") * g.sx, g.gy + F.col("iy") * g.sy
    columns = placed.withColumn("ix", F.explode(steps)).select(
        "y", "w", "g", "ix", px.alias("px"), (px - F.col("x")).alias("dx")
    )
    cells = columns.withColumn("iy", F.explode(steps)).select(
        "w", "g", "ix", "iy", "px", "dx", py.alias("py"), (py - F.col("y")).alias("dy")
    )
    dx, dy = F.col("dx"), F.col("dy")
    distance = g.axx * dx * dx + F.lit(2e0) * g.axy * dx * dy + g.ayy * dy * dy
    kernel = F.col("w") * F.exp(F.lit(-0.5e0) * distance) / g.norm
    return cells.groupBy("ix", "iy").agg(
        F.max("px").alias("x"), F.max("py").alias("y"), F.sum(kernel).alias("density")
    )


def _by_points(placed: DataFrame, gridsize: int) -> DataFrame:
    """The kernel of any number of points: each task sums its points on one grid, and only grids are shuffled."""
    names = ["gx", "sx", "gy", "sy", "axx", "ayy", "axy", "norm"]
    rows = placed.select("x", "y", "w", *[F.col(f"g.{name}").alias(name) for name in names])

    def partial_sums(batches):
        total, numbers = None, None
        for batch in batches:
            for low in range(0, len(batch), 1024):
                part = batch.iloc[low : low + 1024]
                numbers = part[names].iloc[0]
                steps = np.arange(gridsize, dtype=float)
                dx = (numbers.gx + steps * numbers.sx)[None, :] - part["x"].to_numpy()[:, None]
                dy = (numbers.gy + steps * numbers.sy)[None, :] - part["y"].to_numpy()[:, None]
                weight = part["w"].to_numpy() / numbers.norm
                for i in range(gridsize):
                    distance = (
                        (numbers.axx * dx[:, i] ** 2)[:, None]
                        + 2 * numbers.axy * dx[:, i][:, None] * dy
                        + numbers.ayy * dy**2
                    )
                    total = np.zeros((gridsize, gridsize)) if total is None else total
                    total[i] += weight @ np.exp(-0.5 * distance)
        if total is not None:
            ix, iy = np.divmod(np.arange(gridsize * gridsize), gridsize)
            yield pd.DataFrame({
                "ix": ix.astype(np.int32), "iy": iy.astype(np.int32), "x": numbers.gx + ix * numbers.sx,
                "y": numbers.gy + iy * numbers.sy, "density": total.ravel(),
            })

    sums = rows.mapInPandas(partial_sums, "ix int, iy int, x double, y double, density double")
    return sums.groupBy("ix", "iy").agg(F.max("x").alias("x"), F.max("y").alias("y"), F.sum("density").alias("density"))


def density_levels(grid: DataFrame, thresh: float = 0.05, levels: int = 10) -> DataFrame:
    """Contour levels: ``levels`` shares of the mass from ``thresh`` to 1, each with its density.

    Level for share q: the density at which the mass, summed from the densest cell down, reaches 1 - q. Cells below
    the first level are not drawn. The running sum sees the gridsize^2 cells only.
    """
    down = Window.orderBy(F.col("density").desc(), "ix", "iy")
    running = grid.withColumn("upto", F.sum("density").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    total = F.sum("density").over(Window.partitionBy(F.lit(1)))
    shares = [thresh + i * (1.0 - thresh) / (levels - 1) for i in range(levels)]
    mass = running.select("density", (F.col("upto") / total).alias("mass"))
    reached = [
        F.coalesce(F.max(F.when(F.col("mass") >= F.lit(1.0 - q), F.col("density"))), F.min("density")) for q in shares
    ]
    entries = [
        F.struct(F.lit(i).alias("level"), F.lit(q).alias("share"), value.alias("density"))
        for i, (q, value) in enumerate(zip(shares, reached))
    ]
    return mass.agg(F.array(*entries).alias("entries")).select(F.inline("entries")).where(F.col("density").isNotNull())
