"""A user's function over dense cells with a halo, as inference by a network needs it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.operators.select import AXES

Size = tuple[int, int, int]


def apply_cells(vol: DataFrame, size: Size, halo: Size, kernel: Callable[[np.ndarray], np.ndarray], background: float = 0) -> DataFrame:
    """x, y, z and v (double) of what the kernel makes of each cell, without the background.

    The kernel gets a dense array (x, y, z) of a cell and its halo and gives one of the same shape; the halo is cropped
    off again. Absent voxels are the background, beyond the volume too. Cells without a voxel in reach are not visited. A
    voxel goes to the cells whose halo it lies in; a group is one cell with its halo. Where places repeat the last value counts.
    """
    if any(h >= s for h, s in zip(halo, size, strict=True)):
        raise ValueError("a halo is smaller than its cell")
    sent = vol.select(*AXES, F.col("v").cast("double").alias("v"))
    for a, s, h in zip(AXES, size, halo, strict=True):
        low, high = (F.floor((F.col(a) + d) / s).cast("bigint") for d in (-h, h))
        sent = sent.withColumn(f"c{a}", F.explode(F.sequence(low, high)))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        cell = group[["cx", "cy", "cz"]].to_numpy()[0]
        corner = cell * np.array(size) - np.array(halo)
        dense = np.full(np.array(size) + 2 * np.array(halo), background, float)
        dense[tuple((group[list(AXES)].to_numpy() - corner).T)] = group["v"].to_numpy()
        made = kernel(dense)[tuple(slice(h, h + s) for h, s in zip(halo, size, strict=True))]
        at = np.argwhere(made != background)
        out = pd.DataFrame(at + cell * np.array(size), columns=list(AXES))
        return out.assign(v=made[tuple(at.T)].astype(float))

    return sent.groupBy("cx", "cy", "cz").applyInPandas(one, "x long, y long, z long, v double")
