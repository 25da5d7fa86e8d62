"""The sales cube: de-duplicate -> cells -> roll-ups, 25 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators.cells import cells_with_tenths
from tillroll.operators.dedup import dedup_full_row
from tillroll.operators.rollups import add_rollups
from tillroll.schemas import CELL_MEASURES, CUBE_KEYS, DIMENSIONS, rollup_columns
from tillroll.session import stored


def sales_cube(sales: DataFrame, dims: list[str] | None = None, dedup: bool = True,
               folder: str | None = None) -> DataFrame:
    """The cube of the weekly job, in the stored column order.

    ``dims`` limits the roll-ups to the dimensions a caller needs (the top-k
    queries need only ``product_id``); the default builds all three.
    ``dedup=False`` is for inputs whose primary key was enforced on write.

    Two jobs run when it is called: one stores the cells, one the roll-ups, in ``folder`` (by
    default the application's below ``spark.checkpoint.dir``). The result joins the two, so
    no cell is shuffled again, and a lost executor costs a re-read of the cells, not a
    re-run of the de-duplication.
    """
    dims = [d for d in DIMENSIONS if dims is None or d in dims]
    rows = dedup_full_row(sales) if dedup else sales
    cells = stored(cells_with_tenths(rows), "cells", folder)
    cube = add_rollups(cells, dims, folder) if dims else cells
    return cube.select(*CUBE_KEYS, *CELL_MEASURES, *(c for d in dims for c in rollup_columns(d)))
