"""Scans of mixed files, and sinks that can be resumed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidepanel.functions.columns import shard_of


def _listed(spark: SparkSession, path: str, what: str) -> list[str]:
    """Paths that a glob matches, or files below a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if what == "glob":
        return sorted(str(f.getPath()) for f in system.globStatus(where) or [])
    if not system.exists(where):
        raise FileNotFoundError(f"{path} does not exist")
    if not system.getFileStatus(where).isDirectory():
        return [path]
    files, out = system.listFiles(where, True), []
    while files.hasNext():
        name = str(files.next().getPath())
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            out.append(name)
    return sorted(out)


def expand(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files, folders, globs or a list of them; an empty glob is an error."""
    out = []
    for one in [path] if isinstance(path, str) else path:
        if any(c in one for c in "*?["):
            if not (names := _listed(spark, one, "glob")):
                raise FileNotFoundError(f"nothing matches {one}")
            out += names
        else:
            out.append(one)
    return out


def kind_of(path: str) -> str:
    low = path.lower()
    if low.endswith(".zip"):
        raise ValueError(f"{path}: zip can't be split or streamed; unpack it or use gz or bz2")
    return "csv" if low.endswith((".csv", ".csv.gz", ".csv.bz2")) else "parquet"


def _csv(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One frame per different header, so columns go by name and not by place."""
    heads: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        for file in _listed(spark, path, "folder"):
            heads.setdefault(tuple(spark.read.csv(file, header=True).columns), []).append(file)
    return [spark.read.csv(files, header=True, inferSchema=True) for files in heads.values()]


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """All rows; what one part lacks is null; types that differ become double if all are numbers, else text."""
    kinds: dict[str, list] = {}
    for part in parts:
        for f in part.schema:
            kinds.setdefault(f.name, []).append(f.dataType)
    wide = {n: "double" if all(isinstance(k, NumericType) for k in found) else "string" for n, found in kinds.items() if len(set(found)) > 1}
    parts = [part.withColumns({n: F.col(f"`{n}`").cast(k) for n, k in wide.items() if n in part.columns}) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, mixed: bool = True) -> DataFrame:
    """Union by name of all files; what one of them lacks is null."""
    files: dict[str, list[str]] = {}
    for p in expand(spark, path):
        files.setdefault(kind_of(p), []).append(p)
    if len(files) > 1 and not mixed:
        raise ValueError("csv and parquet files can't be mixed here")
    parts = [spark.read.option("mergeSchema", "true").parquet(*files["parquet"])] if "parquet" in files else []
    out = union_by_name(parts + _csv(spark, files.get("csv", [])))
    if columns is not None:
        if missing := [c for c in columns if c not in out.columns]:
            raise ValueError(f"columns not found: {', '.join(missing)}")
        out = out.select(*columns)
    return out


def only_series(rows: DataFrame, wanted: DataFrame, key: str = "series_id") -> DataFrame:
    """Rows of the wanted series; Spark broadcasts their ids while they are small."""
    return rows.join(wanted.select(key).distinct(), key, "left_semi")


def only_shard(rows: DataFrame, shard: int, shards: int, by: list[Column] | None = None) -> DataFrame:
    """Rows of one shard, by series or by the columns that keep series together."""
    return rows.where(shard_of(shards, *(by or [F.col("series_id")])) == shard)


def write_forecast(df: DataFrame, path: str, shards: int, key: str = "series_id", mode: str = "overwrite") -> None:
    """One folder per shard. Spark's committer makes each write all or nothing; overwriting replaces only the shards written."""
    sharded = df.withColumn("shard", shard_of(shards, F.col(key))) if "shard" not in df.columns else df
    sharded.repartition("shard").sortWithinPartitions(key).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
