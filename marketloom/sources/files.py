"""File sources and sinks: tab-separated, CSV and JSON rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.schema import TABLES, Table

# The text format of landed tables.
NULL_MARKER = "\\N"
CONSTITUENT_COLUMNS = ("symbol", "security", "sector", "sub_industry")

_TSV = {"sep": "\t", "header": True, "nullValue": NULL_MARKER, "escape": '"', "dateFormat": "yyyy-MM-dd"}
# A value that does not fit its type, and a header that does not name the fields, fail the load.
_STRICT = {"mode": "FAILFAST", "enforceSchema": False}


def with_defaults(rows: DataFrame, table: str) -> DataFrame:
    """Fills declared defaults for columns the rows lack; a given NULL stays NULL."""
    for c in TABLES[table].cols:
        if c.default is not None and c.name not in rows.columns:
            rows = rows.withColumn(c.name, F.lit(c.default).cast(c.type))
    return rows


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """Columns of a table in declared order and type.

    An absent column gets its declared default, or NULL if it may be missing; a
    required column without a default must be there.
    """
    rows = with_defaults(rows, table.name)
    present = set(rows.columns)
    absent = [c.name for c in table.cols if c.name not in present and (c.required or c.name in table.key)]
    if absent:
        raise ValueError(f"{table.name} lacks {', '.join(absent)}")
    return rows.selectExpr(*[
        f"CAST({f'`{c.name}`' if c.name in present else 'NULL'} AS {c.type.simpleString()}) AS `{c.name}`" for c in table.cols
    ])


def read_tsv(
    spark: SparkSession, path: str, schema, columns: list[str] | None = None, quoted: bool = True
) -> DataFrame:
    """Typed rows of tab-separated files with a header line.

    ``schema`` is a table name or a struct; ``columns`` names the fields in file
    order when it differs. The marker ``\\N`` reads as NULL, an empty field as
    empty text. ``quoted=False`` takes quote characters literally. A value of
    another type, or a header that names other fields, fails the load.
    """
    struct = TABLES[schema].struct if isinstance(schema, str) else schema
    order = columns or struct.fieldNames()
    reader = spark.read.options(**_TSV, **_STRICT).schema(type(struct)([struct[c] for c in order]))
    if not quoted:
        reader = reader.option("quote", "")
    return reader.csv(path).select(*struct.fieldNames())


def read_tsv_with_rejects(
    spark: SparkSession, path, table: str, columns: list[str] | None = None, quoted: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows that a table can take from tab-separated files, and the lines it can't.

    Rejects are (table_name, file, line, reason): lines whose fields don't fit in
    number or type, and lines without a value for a key or required column. Both
    come from one plan over the lines, so every line but headers and blank ones is
    in exactly one of them. ``path`` may be a list.
    """
    relation = TABLES[table]
    order = columns or relation.columns
    fields = [f"`{c}` {relation.struct[c].dataType.simpleString()}" for c in order]
    options = {k: str(v) for k, v in _TSV.items() if k != "header"} | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__unread"}
    if not quoted:
        options["quote"] = ""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    lines = lines.filter(~F.col("line").isin(_TSV["sep"].join(order), ""))
    # A line is parsed once, whatever is asked of its fields: a generated row is not copied into each expression that uses it.
    row = F.from_csv("line", ", ".join([*fields, "__unread string"]), options)
    parsed = lines.select("line", "file", F.explode(F.array(row)).alias("row"))
    needed = [c.name for c in relation.cols if c.name in order and (c.required or c.name in relation.key)]
    missing = F.concat_ws(", ", *[F.when(F.col(f"row.{c}").isNull(), F.lit(c)) for c in needed])
    reason = F.when(F.col("row.__unread").isNotNull(), F.lit("fields do not fit")).when(
        missing != "", F.concat(F.lit("no value for "), missing)
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).select(*[F.col(f"row.{c}").alias(c) for c in relation.columns if c in order])
    bad = judged.filter(F.col("reason").isNotNull()).select(F.lit(table).alias("table_name"), "file", "line", "reason")
    return conform(good, relation), bad


def write_tsv(rows: DataFrame, path: str) -> None:
    """Header and rows, tab-separated, NULL as ``\\N``; one file per partition."""
    rows.write.options(**_TSV).mode("errorifexists").csv(path)


def read_constituents(spark: SparkSession, path: str) -> DataFrame:
    """Index members from CSV files with a header and quoted commas, columns found by name.

    ``ordinal`` orders the rows by file and place in the file.
    """
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    at = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(*CONSTITUENT_COLUMNS, at.alias("ordinal"))


def write_constituents(rows: DataFrame, path: str) -> None:
    rows.select(*CONSTITUENT_COLUMNS).write.option("header", True).option("escape", '"').csv(path)


def first_available(*candidates: DataFrame | None) -> DataFrame:
    """The first source that exists and holds a row; an error when none does."""
    for rows in candidates:
        if rows is not None and not rows.isEmpty():
            return rows
    raise ValueError("no constituent list available")


def write_json_rows(rows: DataFrame, path: str) -> None:
    """One JSON object per row, keeping NULL fields."""
    rows.write.option("ignoreNullFields", False).mode("errorifexists").json(path)


def json_rows(rows: DataFrame) -> DataFrame:
    """Result rows as one text column of JSON objects, for handing to a caller."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))


def read_json_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
