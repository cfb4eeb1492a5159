"""Table sources: CSV with a fixed schema, Parquet, role lookup in folders, sweeps over datasets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fitmesh.operators.columns import align_xy, first_column_target

# fixed values: file name patterns of the two roles
ROLE_PATTERNS = {"predictors": "[Pp]redictors*Full_*.csv", "target": "targets_Hold 1 Full_*.csv"}


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def resolve(spark: SparkSession, path: str, role: str | None = None) -> str:
    """The one file behind ``path``: itself, or the single match of the role's pattern in a folder."""
    jpath, fs = _fs(spark, path)
    if not fs.exists(jpath):
        raise FileNotFoundError(f"{role or 'table'} not found: {path}")
    name = jpath.getName()
    if not fs.getFileStatus(jpath).isDirectory() or name.endswith((".csv", ".parquet")) or role is None:
        return path
    found = [s.getPath().toString() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(jpath, ROLE_PATTERNS[role]))]
    if len(found) != 1:
        raise FileNotFoundError(f"expected exactly one {role} file in {path}, found {len(found)}")
    return found[0]


def _is_number(cell: str) -> bool:
    try:
        float(cell)
        return True
    except ValueError:
        return False


def csv_schema(spark: SparkSession, path: str, header: bool = True) -> T.StructType:
    """Schema from every line, inferred in one distributed pass; whole numbers stay whole (bigint), fractions are doubles."""
    head = spark.read.text(path).first()
    if head is None:
        raise ValueError(f"empty file: {path}")
    if header:
        cells = spark.read.csv(spark.sparkContext.parallelize([head["value"]], 1)).first()
        if cells is not None and all(c is not None and _is_number(c) for c in cells):
            raise ValueError(f"{path} seems to have no header row (every cell is a number); pass header=False")
    found = spark.read.options(header=header, inferSchema=True).csv(path).schema
    return T.StructType([
        T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType, True) for f in found.fields])


def load_table(spark: SparkSession, path: str, role: str | None = None, header: bool = True,
               schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV or Parquet table. CSV is read with the given schema, or one inferred from the whole file; malformed cells are errors, not nulls."""
    path = resolve(spark, path, role)
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if name.endswith(".parquet"):
        return spark.read.parquet(path)
    if not name.endswith(".csv"):
        raise ValueError(f"unsupported file format: {name}")
    return spark.read.schema(schema or csv_schema(spark, path, header)).options(header=header, mode="FAILFAST").csv(path)


def load_pair(spark: SparkSession, predictors: str, target: str, key: Sequence[str] | None = None, header: bool = True,
              check: bool = True) -> DataFrame:
    """Features and the single target column in one table, paired by key or by row position."""
    x = load_table(spark, predictors, "predictors", header)
    y = load_table(spark, target, "target", header)
    if key:
        return align_xy(x, first_column_target(y, strict=True, keep=key), key, check)
    if len(y.columns) > 1:
        raise ValueError("Target file must contain a single target column.")
    return align_xy(x, y.withColumnRenamed(y.columns[0], "label"), None, check)


def dataset_sweep(spark: SparkSession, jobs: dict[str, Callable[[], DataFrame]], parallelism: int = 1) -> DataFrame:
    """``(dataset, status, error)`` plus the columns of each job's one-row result, with their types; a failing dataset, a second row or
    columns unlike those of the first dataset that ended are that dataset's failure and do not stop the rest."""
    from fitmesh.plans.parallel import run_limited

    names = list(jobs)
    outcomes = run_limited(spark, [lambda n=n: jobs[n]().limit(2).toArrow() for n in names], parallelism)
    done = {n: o.value for n, o in zip(names, outcomes) if o.status == "ok"}
    fields = next(([f.with_nullable(True) for f in t.schema] for t in done.values()), [])
    rows: list[dict] = []
    for n, o in zip(names, outcomes):
        status, error, values = o.status, o.error, {}
        if n in done:
            if len(done[n]) > 1:
                status, error = "failed", "the job returns more than one row"
            elif [f.with_nullable(True) for f in done[n].schema] != fields:
                status, error = "failed", f"the job returns other columns: {', '.join(f'{f.name} {f.type}' for f in done[n].schema)}"
            elif len(done[n]):
                values = done[n].to_pylist()[0]
        rows.append({"dataset": n, "status": status, "error": error, **values})
    schema = pa.schema([("dataset", pa.string()), ("status", pa.string()), ("error", pa.string()), *fields])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
