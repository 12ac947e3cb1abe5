"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Arrow batches between the JVM and Python workers while an intermediate table is written: both sides hold whole ones.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only with a local master (tests, a laptop) a local folder may take its place.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="tidepanel-")
        shared_dir.own = found
    return found.rstrip("/")


def shared_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/tidepanel-{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Ends the lineage in a way that outlives executors; columns are still pruned
    and Spark knows the size of what it reads, so its own size-checked choice of
    join strategy applies.
    """
    spark = df.sparkSession
    path = shared_path(spark, what)
    before = {key: spark.conf.get(key, None) for key in BATCHES}
    try:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def arrow_schema(ddl: str) -> pa.Schema:
    """To be called on the driver: the JVM parses the text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def arrow_rows(df: DataFrame, step: Callable[[dict[str, list]], dict[str, list] | None], schema: str) -> DataFrame:
    """``mapInArrow`` for functions from columns (lists) to columns (lists or arrays).

    Batches are handed over in slices of about 4 MB of text, so that one batch of
    long documents doesn't grow a Python worker.
    """
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            size = max(1, int(rows * 4_000_000 / max(batch.nbytes, 1)))
            for at in range(0, rows, size):
                part = batch.slice(at, size)
                out = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def gather(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All batches of one partition, for reducers over hash partitions."""
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None


def fresh_names(df: DataFrame, n: int) -> list[str]:
    """Names that no column of ``df`` has."""
    taken, out, k = {c.lower() for c in df.columns}, [], 0
    while len(out) < n:
        if (name := f"own_{k}") not in taken:
            out.append(name)
        k += 1
    return out


def row_order(df: DataFrame) -> Column:
    """A number by which rows that differ in any column have the same order in every run."""
    from pyspark.sql.types import AtomicType, StringType

    plain = [f.name for f in df.schema if isinstance(f.dataType, (AtomicType, StringType))]
    nested = [f.name for f in df.schema if f.name not in plain]
    return F.xxhash64(*[df[f"`{n}`"] for n in plain], *[F.to_json(F.struct(df[f"`{n}`"])) for n in nested])


def text_of(df: DataFrame, name: str = "text") -> Column:
    return F.coalesce(df[name].cast("string"), F.lit(""))
