"""Write an intermediate result once and read it back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Folders of local sessions that name none, by application.
_OWN: dict[str, str] = {}
#: Frames or tables written at the same time, so that small ones don't wait for one another.
WRITERS = 8


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local session without one gets its own."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = tempfile.mkdtemp(prefix="shelfmark-")
        folder = _OWN[context.applicationId]
    return folder.rstrip("/")


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder.

    Unlike ``checkpoint()`` the files are columnar, so later readers still
    prune columns and push filters down, and a lost executor costs no rerun.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(made: dict[str, Callable[[], object]]) -> dict[str, object]:
    """What each function makes, some at a time; for work that doesn't read one another's."""
    with ThreadPoolExecutor(WRITERS) as pool:
        return dict(zip(made, pool.map(lambda make: make(), made.values())))


def settle_all(made: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Make and settle frames, some at a time."""
    return side_by_side({name: lambda name=name, make=make: settle(make(), name) for name, make in made.items()})
