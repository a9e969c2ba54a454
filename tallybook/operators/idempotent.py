"""Writes and checks that make a rerun give the same table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tallybook.functions import as_list
from tallybook.operators.facts import unique_dimension
from tallybook.sources.shared import shared_folder


# The scope of an overwrite that replaces the whole table.
ALL = "all"


def overwrite_period(
    df: DataFrame,
    path: str,
    period_col: str,
    periods: Sequence | str,
    rebalance: bool = True,
) -> None:
    """Replace ``periods`` at ``path`` by the rows of ``df``, leaving all others alone.

    ``periods`` is the scope: a list, or ``ALL`` for every period of the table; None stands for
    the NULL period. Rows of other periods are left out, and a period in scope that has no rows
    now is cleared, so that a rerun gives the same table whatever an earlier run wrote. Columns
    are stored by name. The mode is set on the writer, as a static overwrite would delete the
    other periods and even the input of a job that reads the same table. A period that ``df``
    itself reads from ``path`` is refused before anything is written: each rerun would start from
    its own result (see ``replace_periods``).

    The rows are computed once. A stored period was replaced if its folder has other files after
    the write than before, so no value is compared with a folder's name there; the names in scope
    are written by Spark's own cast.
    """
    spark = df.sparkSession
    names = None
    if periods != ALL:
        values = [p for p in periods if p is not None]
        wanted = F.col(period_col).isin(values)
        df = df.filter(wanted if len(values) == len(periods) else wanted | F.col(period_col).isNull())
        names = _folder_values(spark, df.schema[period_col].dataType, periods)
    stored = _stored_periods(spark, path, period_col)
    in_scope = {p: at for p, at in stored.items() if names is None or p in names}
    own = read_partitions(df, path)
    clash = sorted(set(in_scope) & {_value(at, period_col) for at in own})
    if clash:
        raise ValueError(f"the rows for {period_col} {clash} are read from {path} themselves")
    before = {p: _files(spark, at) for p, at in in_scope.items()}
    write_partitioned(df, path, [period_col], rebalance)
    for p, folder in in_scope.items():
        if _files(spark, folder) == before[p]:
            _file_system(spark, path).delete(folder, True)


def replace_periods(
    df: DataFrame, path: str, period_col: str, periods: Sequence | str, rebalance: bool = True
) -> None:
    """``overwrite_period`` for rows that read the very periods they replace.

    The rows are written to a folder of their own first, so a failure while they are computed
    leaves the table as it was, and then moved in from there. Use it where the rows come out the
    same when built again from the result, as a replay of corrections does.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "staged")
    df.write.parquet(folder)
    staged = spark.read.schema(df.schema).parquet(folder)
    overwrite_period(staged, path, period_col, periods, rebalance)
    _file_system(spark, folder).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder), True)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


# The folder of NULL periods, and of empty texts.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _value(folder: str, period_col: str) -> str:
    """The period of a partition's path."""
    head, _, rest = folder.partition(f"/{period_col}=")
    return unquote(rest.split("/")[0]) if rest else ""


def _folder_values(spark: SparkSession, kind: DataType, periods: Sequence) -> set[str]:
    """The periods as their folders are named."""
    named = F.array(*[F.lit(p).cast(kind).cast("string") for p in periods])
    rows = spark.range(1).select(F.explode(named)).collect() if periods else []
    return {r[0] or NO_VALUE for r in rows}


def _stored_periods(spark: SparkSession, path: str, period_col: str) -> dict:
    """The partitions at ``path``: period as text, and its folder. A listing, no job."""
    files = _file_system(spark, path)
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not files.exists(top):
        return {}
    folders = [x.getPath() for x in files.listStatus(top) if x.isDirectory()]
    return {_value(f.toString(), period_col): f for f in folders if _value(f.toString(), period_col)}


def _files(spark: SparkSession, folder) -> set[str]:
    """Names of a partition's files, which every write makes anew."""
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {x.getPath().getName() for x in files.listStatus(folder)} if files.exists(folder) else set()


def read_partitions(df: DataFrame, path: str) -> list[str]:
    """Folders below ``path`` that the plan of ``df`` scans, after partition pruning."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    top = _file_system(spark, path).makeQualified(jvm.org.apache.hadoop.fs.Path(path)).toString()
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    found = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        parts = leaf.selectedPartitions().filePartitionIterator()
        while parts.hasNext():
            files = parts.next().files()
            if files.hasNext():
                folder = files.next().getPath().getParent().toString()
                if f"{folder}/".startswith(f"{top.rstrip('/')}/"):
                    found.add(folder)
    return sorted(found)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], rebalance: bool = True
) -> None:
    """Dynamic overwrite by ``columns``.

    Rebalancing puts a partition's rows together, but in several tasks and files where one
    partition holds much of the data. It shuffles the rows once more. Leave it out where every
    task already has a good share of every partition, as after a backfill, whose histories are
    the larger part of the data.
    """
    rows = df.hint("rebalance", *columns) if rebalance else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def overwrite_period_bucketed(
    df: DataFrame, table: str, period_col: str, key: str, buckets: int, location: str
) -> None:
    """``overwrite_period`` for a catalogue table that is also bucketed by ``key``.

    A step that joins such a snapshot to the next period on the key reads it bucket by bucket:
    only the new period's rows are shuffled, not the histories. Rows are spread by the same
    hash before the write, so that a period has one file per bucket. The overwrite mode is an
    option of the table, as inserts do not take it from the writer.
    """
    spark = df.sparkSession
    name = ".".join(quoted(part) for part in table.split("."))
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
        folder = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"""create table {name} ({columns}) using parquet
                options ('partitionOverwriteMode' = 'dynamic')
                partitioned by ({quoted(period_col)})
                clustered by ({quoted(key)}) sorted by ({quoted(key)}) into {buckets} buckets
                location '{folder}'"""
        )
    in_order = spark.table(table).columns
    df.select(*in_order).repartition(buckets, key).write.insertInto(table, overwrite=True)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with the same key, or are added.

    Only the keys of ``source`` meet the target: a batch below Spark's broadcast threshold
    leaves the target unshuffled. A whole row is taken from one side, so a NULL of ``source``
    replaces a value. A key that ``source`` holds twice fails the query.
    """
    source = unique_dimension(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source)


def bounded_window(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows with start <= col < end. Both bounds are needed: an open side makes the result
    depend on the day of the run. Bounds are taken as the column's own type, dates and times
    without a zone as UTC, so the session's time zone does not matter."""
    if start is None or end is None:
        raise ValueError("bounded_window needs a start and an end")
    if not start < end:
        raise ValueError("start must lie before end")
    kind = df.schema[col].dataType

    def bound(value) -> Column:
        if not isinstance(value, date):
            return F.lit(value)
        text = value.isoformat()
        if kind.typeName() == "timestamp" and not (isinstance(value, datetime) and value.tzinfo):
            text += "+00:00" if isinstance(value, datetime) else "T00:00:00+00:00"
        return F.lit(text).cast(kind)

    return df.filter((F.col(col) >= bound(start)) & (F.col(col) < bound(end)))


def missing_partitions(
    sources: Mapping[str, DataFrame], period_col: str, first, last, min_rows: int = 1
) -> DataFrame:
    """(source, period) from ``first`` to ``last`` with fewer than ``min_rows`` rows.

    Periods are whole numbers or, with dates as bounds, days. Each source is reduced to a row
    per period first; only those counts are joined.
    """
    counted = [
        df.groupBy(F.col(period_col).alias("period"))
        .count()
        .select(F.lit(name).alias("source"), "period", "count")
        for name, df in sources.items()
    ]
    present = reduce(DataFrame.unionByName, counted).filter(F.col("count") >= min_rows)
    spark = counted[0].sparkSession
    kind = present.schema["period"].dataType
    periods = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("period"))
    expected = periods.select(
        F.explode(F.array(*[F.lit(n) for n in sources])).alias("source"),
        F.col("period").cast(kind).alias("period"),
    )
    return expected.join(present, ["source", "period"], "left_anti")


def depends_on_past(df: DataFrame, period_col: str, step=1) -> DataFrame:
    """Periods whose previous one is absent, the first included.

    ``step`` is what is added to a period to get the next one: a number, or days for dates.
    """
    periods = df.select(period_col).distinct()
    following = periods.select((F.col(period_col) + step).alias(period_col))
    return periods.join(following, period_col, "left_anti")


def snapshot_asof(
    facts: DataFrame,
    snapshots: DataFrame,
    key: str | Sequence[str],
    period: str,
    snapshot: str,
    col: str,
) -> DataFrame:
    """Facts whose ``col`` in the snapshot of their own period differs from the latest one.

    The latest value is set beside every snapshot row first, so facts are joined once.
    """
    keys = as_list(key)
    latest = F.max_by(col, snapshot).over(Window.partitionBy(*keys))
    both = snapshots.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.col(snapshot).alias("_period"),
        F.col(col).alias(f"own_{col}"),
        latest.alias(f"latest_{col}"),
    ).filter(~F.col(f"own_{col}").eqNullSafe(F.col(f"latest_{col}")))
    own = [F.col(k) == F.col(f"_of_{k}") for k in keys] + [F.col(period) == F.col("_period")]
    return facts.join(both, own).drop("_period", *[f"_of_{k}" for k in keys])
