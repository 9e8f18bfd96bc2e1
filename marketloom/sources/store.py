"""The table store: typed Parquet, replaced as a whole, and the session's view of it."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.quality.constraints import key_text
from marketloom.schema import DROP_ORDER, INT, LOAD_ORDER, TABLES, TEXT
from marketloom.session import side_by_side
from marketloom.sources.files import conform

# Large tables are clustered on the key the analyses restrict and group by.
CLUSTERED = {
    "Security": ["ticker_key"],
    "Price": ["security_id", "trade_date"],
    "Financial_Snapshot": ["security_id", "snapshot_date"],
    "Corporate_Action": ["security_id", "action_date"],
    "Holding": ["portfolio_id", "security_id"],
}
# Price is also split by year, so that a date range skips whole folders.
YEARLY = {"Price": "trade_date"}
# Look-ups ignore case, so the store keeps the upper-case form as a column of its own. The rows lie in its
# order and it has a Bloom filter: a look-up reads the row groups that can hold the ticker.
SEARCHED = {"Security": ("ticker_key", "ticker")}


def year_column(date: str) -> str:
    return f"{date}_year"


def _write(rows: DataFrame, name: str, path: str, **options: str) -> None:
    rows = conform(rows, TABLES[name])
    order = CLUSTERED.get(name)
    if name in SEARCHED:
        key, column = SEARCHED[name]
        rows = rows.withColumn(key, F.upper(column))
        options[f"parquet.bloom.filter.enabled#{key}"] = "true"
    if order is not None:
        split = []
        if name in YEARLY:
            date = YEARLY[name]
            split = [year_column(date)]
            rows = rows.withColumn(split[0], F.year(date))
        # Range partitioning on year and key gives each task one stretch of one
        # year: few files, and a heavy year or key is spread over many tasks.
        rows = rows.repartitionByRange(*split, *order).sortWithinPartitions(*split, *order)
        rows.write.options(**options).mode("overwrite").partitionBy(*split).parquet(path)
    else:
        rows.write.options(**options).mode("overwrite").parquet(path)


def _versions(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("version long, tables map<string,string>").json(f"{root}/versions")


def _latest(spark: SparkSession, root: str):
    """The last committed version with the folder of each table, None before the first."""
    try:
        return _versions(spark, root).orderBy(F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the last committed version, 0 before the first."""
    latest = _latest(spark, root)
    return latest["version"] if latest else 0


def _commit(spark: SparkSession, root: str, version: int, folders: Mapping[str, str]) -> int:
    """Records a version. Its file may not exist yet, so of two writers one fails."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/versions/{version:09d}.json")
    try:
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    except Py4JJavaError as error:
        raise ValueError(f"version {version} was committed by another writer") from error
    out.write(bytearray(json.dumps({"version": version, "tables": dict(folders)}).encode()))
    out.close()
    return version


def _first(check, tables: Mapping[str, DataFrame]):
    return check(tables).first()


def commit_tables(
    spark: SparkSession, changed: Mapping[str, DataFrame], root: str, check=None, based_on: int | None = None
) -> int:
    """Replaces some tables of the store and returns the new version; the files of the others stay.

    The new tables are written next to the current ones. Only when every one is
    complete, and ``check`` (if given, one or several) finds no violating row, is the
    version recorded; readers see the previous one until then, also after a failure
    half-way. ``based_on`` names the version that the changes were made from: the
    commit fails if another one has come in between.
    """
    latest = _latest(spark, root)
    current = latest["version"] if latest else 0
    version = (current if based_on is None else based_on) + 1
    attempt = spark.range(1).select(F.expr("uuid()")).first()[0]
    folders = dict(latest["tables"]) if latest else {}
    folders |= {name: f"{root}/load-{version:06d}-{attempt}/{name}" for name in changed}
    side_by_side(spark, [partial(_write, rows, name, folders[name]) for name, rows in changed.items()])
    if check is not None:
        written = _open(spark, folders)
        checks = [check] if callable(check) else check
        for bad in filter(None, side_by_side(spark, [partial(_first, each, written) for each in checks])):
            raise ValueError(f"load {version} rejected, current load stays: {bad.asDict()}")
    return _commit(spark, root, version, folders)


def full_refresh(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, check=None) -> int:
    """Replaces the content of the store as a whole and returns the new version."""
    return commit_tables(spark, {name: tables[name] for name in LOAD_ORDER}, root, check)


def drop_old_loads(spark: SparkSession, root: str) -> list[str]:
    """Deletes the folders that the last version doesn't name, of earlier, refused and staged loads, and returns them.

    Readers of an earlier version lose their files, and so does a load that has
    not committed yet: run it when there are none.
    """
    latest = _latest(spark, root)
    used = {folder.rsplit("/", 1)[0].rsplit("/", 1)[1] for folder in latest["tables"].values()} if latest else set()
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for entry in files.listStatus(path) if latest else ():
        name = entry.getPath().getName()
        if name.startswith(("load-", "stage-")) and name not in used:
            files.delete(entry.getPath(), True)
            gone.append(name)
    return sorted(gone)


def stage(spark: SparkSession, root: str) -> Callable[[DataFrame, str], DataFrame]:
    """Returns a function that writes rows under a name beside the loads, and gives back what it wrote.

    The folder is one of its own; ``drop_old_loads`` deletes it.
    """
    folder = f"{root}/stage-{spark.range(1).select(F.expr('uuid()')).first()[0]}"

    def keep(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("errorifexists").parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    return keep


def load_days(spark: SparkSession, root: str, rows: DataFrame, name: str = "Price") -> list[int]:
    """Merges rows into a table split by year, by key, and returns the years rewritten; other years keep their files.

    The years that the rows touch are read, merged and staged, and then replace
    the old ones by dynamic partition overwrite: a daily run costs a year, not
    the history. The version stays: each year is old until it is new, and a run
    that fails can be repeated.
    """
    latest = _latest(spark, root)
    if latest is None:
        raise ValueError(f"nothing loaded under {root}")
    folder, date, key = latest["tables"][name], YEARLY[name], list(TABLES[name].key)
    rows = conform(rows, TABLES[name])
    years = sorted(r[0] for r in rows.select(F.year(date)).distinct().collect())
    if not years:
        return years
    held = _open(spark, latest["tables"])[name].filter(F.col(year_column(date)).isin(*years))
    merged = held.join(rows.select(*key), key, "left_anti").select(*rows.columns).unionByName(rows)
    staged = f"{root}/stage-{spark.range(1).select(F.expr('uuid()')).first()[0]}/{name}"
    merged.write.parquet(staged)
    _write(spark.read.schema(TABLES[name].struct).parquet(staged), name, folder, partitionOverwriteMode="dynamic")
    return years


def _open(spark: SparkSession, folders: Mapping[str, str]) -> dict[str, DataFrame]:
    found = {}
    for name in LOAD_ORDER:
        struct = TABLES[name].struct
        if name in YEARLY:
            struct = struct.add(year_column(YEARLY[name]), INT)
        if name in SEARCHED:
            struct = struct.add(SEARCHED[name][0], TEXT)
        found[name] = spark.read.schema(struct).parquet(folders[name])
    return found


def open_store(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Tables of the last committed version."""
    latest = _latest(spark, root)
    if latest is None:
        raise ValueError(f"nothing loaded under {root}")
    return _open(spark, latest["tables"])


def create_tables(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None, prefix: str = "") -> list[str]:
    """Registers the thirteen typed relations for SQL, empty where no rows are given."""
    names = []
    for name in LOAD_ORDER:
        given = tables[name] if tables is not None and name in tables else None
        rows = spark.createDataFrame([], TABLES[name].struct) if given is None else conform(given, TABLES[name])
        rows.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


def save_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], database: str = "default", buckets: int = 200,
    path: str | None = None, only: list[str] | None = None,
) -> list[str]:
    """Saves the relations as catalog tables, security-keyed ones bucketed and sorted by security.

    Windows, aggregations and joins on the security then need no shuffle. A
    bucket holds whole securities, and a security at most one row per day, so
    buckets stay even. ``buckets`` should grow with the data. ``path`` names a
    folder for the files, the catalog's own otherwise; ``only`` some of the tables.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table in only or LOAD_ORDER:
        rows, order = conform(tables[table], TABLES[table]), CLUSTERED.get(table)
        name = f"{database}.{table.lower()}"
        writer = rows.write
        if order is not None and set(order) <= set(rows.columns):
            # One task per bucket keeps it to one sorted file per bucket.
            writer = rows.repartition(buckets, order[0]).write.bucketBy(buckets, order[0]).sortBy(*order)
        if path is not None:
            writer = writer.option("path", f"{path}/{table}")
        writer.mode("overwrite").saveAsTable(name)
        names.append(name)
    return names


def saved_tables(spark: SparkSession, database: str = "default", only: list[str] | None = None) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name.lower()}") for name in only or LOAD_ORDER}


def drop_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    """Unregisters the relations, children first; absent ones are passed over."""
    return [name for name in DROP_ORDER if spark.catalog.dropTempView(f"{prefix}{name}")]


def drop_saved_tables(spark: SparkSession, database: str = "default") -> None:
    """Drops the catalog tables of ``save_tables``, children first; absent ones are passed over."""
    for name in DROP_ORDER:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name.lower()}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as one report."""
    report = None
    for name in LOAD_ORDER:
        line = tables[name].agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        report = line if report is None else report.unionByName(line)
    return report


def digests(tables: Mapping[str, DataFrame], only: list[str] | None = None) -> DataFrame:
    """Rows and digest per table: equal for tables with the same rows, in whatever order and files.

    The digest is the sum of 60-bit hashes of the rows as text, so it combines
    before the shuffle, and repeated rows count. Both halves of the hashes are
    added as whole numbers: they hold more than eight billion rows, and decimals
    are made of the sums only.
    """
    half = 1 << 30
    report = None
    for name in only or LOAD_ORDER:
        text = key_text(TABLES[name].columns)
        number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
        summed = conform(tables[name], TABLES[name]).select(number.alias("number")).agg(
            F.count("*").alias("n_rows"),
            F.sum(F.shiftright("number", 30)).cast("decimal(20,0)").alias("high"),
            F.sum(F.col("number").bitwiseAND(F.lit(half - 1))).cast("decimal(20,0)").alias("low"),
        )
        digest = F.coalesce(F.col("high") * F.lit(half).cast("decimal(10,0)") + F.col("low"), F.lit(0))
        line = summed.select(F.lit(name).alias("table_name"), "n_rows", digest.cast("string").alias("digest"))
        report = line if report is None else report.unionByName(line)
    return report
