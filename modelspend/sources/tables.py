"""Reading source tables, creating and appending to the tracking tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelspend import schemas as S
from modelspend.functions.expressions import lit_date
from modelspend.sources.commits import committed_rows, has_plain_files

#: How far a row's day folder may be from the day of its naive UTC time.
DAY_SLACK = timedelta(days=1)


@dataclass(frozen=True)
class Dated:
    """A table with a column that holds the day of each row's time, such as its partition folders' name.

    The column is a date, or text as ``yyyy-MM-dd``.  Lower bounds on the rows' time are then also put on the
    day, which prunes whole folders.  The day may be of any time zone.
    """

    table: Union[DataFrame, str]
    day: str


TableRef = Union[DataFrame, str, Dated]


def is_path(ref: str) -> bool:
    return "/" in ref


def load_table(spark: SparkSession, ref: TableRef, schema: T.StructType, since: datetime | None = None) -> DataFrame:
    """A DataFrame, a catalog table, or Parquet files, with its columns checked.

    ``since`` says that the caller will use no rows before it; only a :class:`Dated` table makes use of it.
    """
    if isinstance(ref, Dated):
        return since_day(load_table(spark, ref.table, schema), ref.day, since)
    if isinstance(ref, DataFrame):
        df = ref
    elif is_path(ref):
        df = read_folder(spark, ref, schema)
    else:
        df = spark.table(ref)
    return require_columns(df, schema)


def since_day(df: DataFrame, day: str, since: datetime | None) -> DataFrame:
    """Rows from the day before ``since`` on; rows without a day stay."""
    kind = df.schema[day].dataType
    if not isinstance(kind, (T.DateType, T.StringType)):
        raise ValueError(f"column {day} has to be a date or text, not {kind.simpleString()}")
    if since is None:
        return df
    bound = lit_date((since - DAY_SLACK).date())
    return df.filter(F.col(day).isNull() | (F.col(day) >= (bound if isinstance(kind, T.DateType) else bound.cast("string"))))


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files of a folder, its partition folders as columns, and the batches committed to it."""
    if any(c in path for c in "*?[{"):
        return read_partitioned(spark, path, schema)
    batches = committed_rows(spark, path)
    if batches is None:
        return read_partitioned(spark, path, schema)
    if not has_plain_files(spark, path):
        return batches
    return union_tables([read_partitioned(spark, path, schema), batches], schema)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Partition columns that the schema names get its types instead of those guessed from the folders' names."""
    df = spark.read.parquet(path)
    guessed = [f for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    if guessed:
        stored = spark.read.option("recursiveFileLookup", "true").parquet(path).columns
        types = {f.name: f.dataType for f in guessed if f.name not in stored}
        if types:
            wanted = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in df.schema.fields])
            df = spark.read.schema(wanted).parquet(path)
    return df


# Types that hold every value of another one.
WIDER = (
    ("tinyint", "smallint", "int", "bigint"),
    ("float", "double"),
    ("tinyint", "smallint", "int", "double"),
    ("date", "timestamp_ntz"),
)


def fits(have: T.DataType, want: T.DataType) -> bool:
    """May a column of type ``have`` stand where ``want`` is expected?  Narrower types may."""
    if isinstance(want, T.StructType):
        return isinstance(have, T.StructType) and all(
            f.name in have.names and fits(have[f.name].dataType, f.dataType) for f in want.fields
        )
    if isinstance(have, T.NullType) or have == want:
        return True
    if isinstance(have, (T.StringType, T.CharType, T.VarcharType)) and isinstance(want, T.StringType):
        return True
    if {type(have), type(want)} == {T.TimestampType, T.TimestampNTZType}:
        return True  # scans turn both into naive UTC
    if isinstance(have, T.DecimalType) and isinstance(want, (T.DoubleType, T.DecimalType)):
        return True
    if isinstance(have, T.DecimalType) and isinstance(want, T.LongType):
        return have.scale == 0
    names = have.simpleString(), want.simpleString()
    return any(a in group and b in group and group.index(a) < group.index(b) for group in WIDER for a, b in [names])


def require_columns(df: DataFrame, schema: T.StructType, prefix: str = "") -> DataFrame:
    """Fail early, naming the missing columns (nested fields included) and those of a type that does not fit."""

    def missing(have: T.StructType, want: T.StructType, path: str):
        for field in want.fields:
            name = path + field.name
            if field.name not in have.names:
                yield name
            elif isinstance(field.dataType, T.StructType):
                found = have[field.name].dataType
                if isinstance(found, T.StructType):
                    yield from missing(found, field.dataType, name + ".")
                else:
                    yield name

    absent = list(missing(df.schema, schema, prefix))
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    wrong = [
        f"{prefix}{f.name} is {df.schema[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}"
        for f in schema.fields
        if not fits(df.schema[f.name].dataType, f.dataType)
    ]
    if wrong:
        raise ValueError(f"columns of another type: {'; '.join(wrong)}")
    return df


def reconciled(df: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with exactly the schema's columns and types: absent ones NULL, narrower types widened."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    present = T.StructType([f for f in schema.fields if f.name in df.columns])
    require_columns(df, present)
    columns = [
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns)


def union_tables(tables: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Tables one below the other by name; columns beyond the schema stay where any table has them."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def create_tracking_tables(
    spark: SparkSession,
    namespace: str,
    executions: str = S.EXECUTIONS_TABLE,
    job_runs: str = S.JOB_RUNS_TABLE,
) -> tuple[str, str]:
    """Create the namespace and both append-only tables unless they exist.

    ``namespace`` is a database name, or a base path for plain Parquet folders.
    Returns the references to pass to :func:`append` and :class:`Sources`.
    """
    tables = {executions: S.EXECUTIONS, job_runs: S.JOB_RUNS}
    if is_path(namespace):
        refs = [f"{namespace.rstrip('/')}/{name}" for name in tables]
        for ref, schema in zip(refs, tables.values()):
            spark.createDataFrame([], schema).write.mode("ignore").parquet(ref)
    else:
        refs = [f"{namespace}.{name}" for name in tables]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
        for ref, schema in zip(refs, tables.values()):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {ref} ({columns}) USING parquet")
    return refs[0], refs[1]


def append(df: DataFrame, ref: str) -> None:
    """Append rows to a tracking table or folder, matching columns by name.

    A folder to which a stream writes directly is refused: readers of such a folder see the
    stream's files only.
    """
    if is_path(ref):
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{ref.rstrip('/')}/_spark_metadata")
        if path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).exists(path):
            raise ValueError(f"{ref} is a stream's own folder; append to another one")
        df.write.mode("append").parquet(ref)
    else:
        columns = df.sparkSession.table(ref).columns
        df.select(*columns).write.mode("append").insertInto(ref)


def publish(df: DataFrame, name: str) -> DataFrame:
    """Expose a result under the view name its consumers query."""
    df.createOrReplaceTempView(name)
    return df
