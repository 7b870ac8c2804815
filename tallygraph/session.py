"""Session settings and the shared work folder."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the plans rely on; a cluster may raise the sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; on a cluster the session is given."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("tallygraph")
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """New folder for one job under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallygraph-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read back.

    Cuts the lineage like a checkpoint and survives the loss of executors, but
    computes the rows once, keeps columns apart and gives the planner a size.
    """
    path = work_dir(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """A join side of about as many rows as the other: both are shuffled, whatever size the planner expects.

    Written tables are encoded and compressed far below what their rows take in memory, and texts made of
    short rows are expected to be as short; a broadcast chosen by such sizes fills the driver.
    """
    return df.hint("merge")


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """The columns of a schema, without rows; the optimizer drops it from a union."""
    cells = F.from_json(F.lit("{}"), schema)
    return spark.range(1).filter(F.lit(False)).select(cells.alias("o")).select("o.*")


def union_all(parts: list[DataFrame], allow_missing: bool = False, empty: DataFrame | None = None) -> DataFrame:
    """Union by name, pairwise, so that a long list is analysed in few levels.

    ``empty`` is the result for no parts, as a scope or a base may lack a kind of table.
    """
    if not parts and empty is not None:
        return empty
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1], allow_missing) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few metadata rows as a literal inside the plan; no Python worker is involved."""
    names = [part.split()[0] for part in _top_level(schema)]
    text = json.dumps([dict(zip(names, row)) for row in rows], ensure_ascii=False)
    cells = F.from_json(F.lit(text), f"array<struct<{','.join(_typed(schema))}>>")
    return spark.range(1).select(F.inline(cells))


def _top_level(schema: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            parts.append(schema[start:i].strip())
            start = i + 1
    return [*parts, schema[start:].strip()]


def _typed(schema: str) -> list[str]:
    return [":".join(part.split(None, 1)) for part in _top_level(schema)]
