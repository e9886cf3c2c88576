"""Session helpers: where intermediate tables go, how wide a shuffle is, and the package on the workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    missing setting is an error, because a driver-local folder would not be
    visible to the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="riskweave-")
    return _own_dirs[app]


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used before operators that pass over the same rows several times: later
    passes prune columns and push filters into the file scan, and a lost
    executor costs a file read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Functions that run in workers refer to the package, which is on the driver's
    path only; an installed package needs no shipping but isn't harmed by it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="riskweave-package-")) / "riskweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
