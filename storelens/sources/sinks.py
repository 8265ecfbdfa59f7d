"""Writers: quoted and plain CSV, JSON lines, tables whose content is swapped in one change."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from storelens.functions.timewin import as_utc

#: ending of the folder that holds a table's replaced and present content
VERSIONS = "__versions"


def dated_name(name: str, as_of: datetime) -> str:
    return f"{name}_{as_of:%Y%m%d}"


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """UTF-8, header, CRLF, every value quoted, an existing export replaced."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("lineSep", "\r\n")
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_plain_csv(df: DataFrame, path: str) -> None:
    """Header, CRLF, NULL written as the word NULL, quotes only where needed."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "NULL")
        .option("escape", '"')
        .option("lineSep", "\r\n")
        .csv(path)
    )


def write_json_lines(df: DataFrame, path: str, as_of: datetime, mode: str = "append") -> None:
    """One JSON object per row with the load time as ``time``."""
    stamped = df.select(F.lit(int(as_utc(as_of).timestamp())).alias("time"), *df.columns)
    stamped.write.mode(mode).option("ignoreNullFields", False).json(path)


def replace_table(df: DataFrame, name: str, home: str | None = None) -> str:
    """New content for a table that readers may look up at any time; returns its folder.

    The rows are written to a folder of their own below ``home`` (the warehouse, if not given), then the
    catalog's location of the table is set to it, in one change. A reader meets the old rows or the new
    ones, never none and never a mixture; a failed write leaves the table as it was. ``df`` may read the table itself. Folders
    of former content stay, for readers that still use them, until ``drop_former`` removes them. The table keeps its
    columns: those of ``df`` must have the same names (in any order) and are cast to the table's types.
    """
    spark = df.sparkSession
    home = (home or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    path = f"{home}/{name}{VERSIONS}/{uuid.uuid4().hex}"
    if not spark.catalog.tableExists(name):
        df.write.parquet(path)
        spark.catalog.createTable(name, path, "parquet")
        return path
    columns = spark.table(name).schema
    if sorted(df.columns) != sorted(columns.names):
        raise ValueError(f"{name} has the columns {columns.names}, the new rows {df.columns}")
    rows = df.select(*[F.col(f"`{c.name}`").cast(c.dataType).alias(c.name) for c in columns])
    rows.write.parquet(path)
    spark.sql(f"alter table {name} set location '{path}'")
    return path


def table_folder(spark: SparkSession, name: str) -> str:
    """The folder that holds a table's rows now."""
    told = spark.sql(f"describe table extended {name}").filter("col_name = 'Location'").first()
    return told["data_type"].removeprefix("file:")


def drop_former(spark: SparkSession, name: str, home: str | None = None) -> int:
    """Removes the folders of former content of a table; call it when no reader uses them any more."""
    home = (home or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{home}/{name}{VERSIONS}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    now = table_folder(spark, name).rsplit("/", 1)[-1]
    former = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName() != now]
    for path in former:
        files.delete(path, True)
    return len(former)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def deliver(payload: DataFrame, send, batch_no: str = "batch_no") -> None:
    """Hands each batch of a payload to ``send(batch_no, rows)`` inside a task.

    Rows of one batch are kept together by a repartition on its number; a batch
    is bounded by the batch size. ``send`` must be safe to repeat, because a lost
    task runs again.
    """

    def run(rows) -> None:
        batch, current = [], None
        for row in rows:
            if current is not None and row[batch_no] != current:
                send(current, batch)
                batch = []
            current = row[batch_no]
            batch.append(row.asDict())
        if batch:
            send(current, batch)

    payload.repartition(batch_no).sortWithinPartitions(batch_no).foreachPartition(run)
