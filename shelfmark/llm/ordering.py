"""Rows dealt to partitions by ranges of their id, so that neighbours meet without a global sort."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def id_bounds(rows: DataFrame, id_col: str) -> np.ndarray:
    """The largest id of each range, ascending; ranges hold about equally many rows.

    Bounds are ids that occur, and there are at most as many as shuffle
    partitions: all that reaches the driver. An empty table has none.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [(i + 1) / parts for i in range(parts)]
    found, most = rows.agg(F.percentile_approx(id_col, shares, 20 * parts), F.max(id_col)).first()
    return np.unique(np.array([*(found or []), *([] if most is None else [most])], np.int64))


def _parted(batches: Iterable[pa.RecordBatch], bounds: np.ndarray, ahead: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        part = np.searchsorted(bounds, ids)
        no = np.zeros(len(ids), bool)
        names = ["part", "guest", *batch.schema.names]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(no), *batch.columns], names)
        if ahead and (heads := np.flatnonzero(bounds[part] == ids)).size:
            to = (part[heads] + 1) % len(bounds)
            rows = batch.take(pa.array(heads))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(~no[heads]), *rows.columns], names)


def by_id_ranges(rows: DataFrame, bounds: np.ndarray, ahead: bool = False) -> DataFrame:
    """Rows (id in the first column) in one partition for each range, with columns ``part`` and ``guest``.

    With ``ahead`` the rows of each range's largest id are also guests in the
    range above (those of the last in the first): what follows a range's last
    row when ids descend.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    parted = rows.mapInArrow(lambda b: _parted(b, bounds, ahead), f"part int, guest boolean, {kinds}")
    return parted.repartitionById(max(1, len(bounds)), F.col("part"))
