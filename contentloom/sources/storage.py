"""Reading and writing named tables: a folder of files, a catalog database, or JDBC.

Writers keep the parallelism of the plan. A refresh to JDBC limits its connections with
``write_connections`` instead of pulling everything through one task.

A refresh of a folder or catalog table writes a new version beside the old one and then switches in
one step. Until then, and if the refresh dies, readers find the old rows; the version before stays
for readers that have begun with it, until the refresh after the next one.
"""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentloom.schemas import LAYOUT, defaults, is_known, laid_out, read_schema, schema, table_ddl
from contentloom.session import shared_folder
from contentloom.sources.files import SharedFiles


#: Texts and token arrays take about half the space of the default codec's in files of these formats.
CODEC = "zstd"
CODEC_FORMATS = ("parquet", "orc")


def _packed(writer: DataFrameWriter, file_format: str = "parquet") -> DataFrameWriter:
    writer = writer.format(file_format)
    return writer.option("compression", CODEC) if file_format in CODEC_FORMATS else writer


class TableStore(ABC):
    """Named tables with full refresh, append, and creation on demand."""

    spark: SparkSession

    @abstractmethod
    def exists(self, table: str) -> bool: ...

    @abstractmethod
    def read(self, table: str) -> DataFrame: ...

    def read_laid_out(self, table: str) -> DataFrame:
        """The table with the columns it is laid out by, whose filters choose folders."""
        return laid_out(self.read(table), table)

    def _lay_out(self, table: str) -> None:
        """Give a table from before its layout that layout, as a refresh of itself."""
        rows = laid_out(self.read(table), table)
        self.overwrite(table, rows.hint("rebalance", *map(F.col, _layout(table))), _layout(table))

    @abstractmethod
    def _save(self, table: str, writer: DataFrameWriter) -> None: ...

    def staging_folder(self) -> str | None:
        """Where intermediate tables go; None leaves it to the session's shared folder."""
        return None

    def overwrite(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """Replace the whole table; its columns become those of ``df``."""
        self._save(table, _partitioned(df.write.mode("overwrite"), partition_by))

    def append(self, table: str, df: DataFrame) -> None:
        self._save(table, df.write.mode("append"))

    def replace_parts(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """Replace those partitions of the table that ``df`` has rows in; the others stay as they are.

        By default the partitions are those of the table's layout. A table that does not exist yet is
        created.
        """
        raise NotImplementedError(f"{type(self).__name__} has no partitions")

    def _swap_folder(self) -> str:
        return self.staging_folder() or shared_folder(self.spark)

    def swap_parts(self, table: str, df: DataFrame, partition_by: tuple[str, ...]) -> None:
        """``replace_parts`` by rows that are written beside the table first, so ``df`` may read it.

        A note tells where they are until all partitions are in place. If a run dies before, the table
        lacks no row that ``finish_swap`` does not bring back.
        """
        self.finish_swap(table)
        folder = f"{self._swap_folder()}/swap-{table}-{uuid.uuid4().hex}"
        files, note = SharedFiles(self.spark), f"{self._swap_folder()}/swap-{table}"
        try:
            _packed(df.write).save(folder)
        except BaseException:
            files.delete(folder)
            raise
        files.replace(note, f"{folder}\n{' '.join(partition_by)}")
        self.finish_swap(table)

    def finish_swap(self, table: str) -> None:
        """Put those partitions in place that a note is left of; without one there is nothing to do."""
        files, note = SharedFiles(self.spark), f"{self._swap_folder()}/swap-{table}"
        found = files.read(note)
        if found is None:
            return
        folder, names = found.split("\n")
        self.replace_parts(table, self.spark.read.parquet(folder), tuple(names.split()))
        files.delete(note)
        files.delete(folder)

    def create_if_absent(self, table: str, columns: T.StructType | None = None) -> None:
        """An empty table of the given columns, by default those the package knows."""
        if not self.exists(table):
            empty = self.spark.createDataFrame([], columns or schema(table))
            self.append(table, empty)

    def add_missing_columns(self, table: str) -> list[str]:
        """Give a stored table the declared columns it lacks; returns their names.

        Rows stored before show the declared default, without being rewritten.
        """
        return []

    def register(self, table: str) -> DataFrame:
        """Make the table known to SQL text of this session under its own name."""
        df = self.read(table)
        df.createOrReplaceTempView(table)
        return df


def _partitioned(writer: DataFrameWriter, partition_by: tuple[str, ...]) -> DataFrameWriter:
    return writer.partitionBy(*partition_by) if partition_by else writer


def _layout(table: str) -> tuple[str, ...]:
    return tuple(LAYOUT.get(table, ()))


@dataclass
class FolderStore(TableStore):
    """One sub-folder per table.

    Known tables are read with their declared columns, so no file has to be opened to plan, and
    files written before a column existed show its declared default, or NULL. ``merge_schema``
    instead looks into every file and keeps columns the declaration does not have.

    Tables that were refreshed live in ``_versions``; a file in ``_current`` names the version that
    counts and the one before, and replacing that file is the switch.
    """

    spark: SparkSession
    root: str
    file_format: str = "parquet"
    merge_schema: bool = False

    def _below(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _versions(self, table: str) -> list[str]:
        """The version that counts and the one before, as paths below the root."""
        return (SharedFiles(self.spark).read(self._below(f"_current/{table}")) or "").split()

    def path(self, table: str) -> str:
        """Where the rows of the table are now."""
        return self._below((self._versions(table) or [table])[0])

    def staging_folder(self) -> str:
        """A folder beside the tables, which all executors reach."""
        return self._below("_staging")

    def exists(self, table: str) -> bool:
        return SharedFiles(self.spark).exists(self.path(table))

    def read(self, table: str) -> DataFrame:
        found = self.read_laid_out(table)
        if self.merge_schema or not is_known(table):
            return found.drop(*_layout(table))
        return found.select(*schema(table).fieldNames())

    def _is_flat(self, table: str) -> bool:
        """Whether a table that has a layout was stored without it."""
        if table not in LAYOUT:
            return False
        names = SharedFiles(self.spark).names(self.path(table))
        return any(not name.startswith(("_", ".")) and "=" not in name for name in names)

    def read_laid_out(self, table: str) -> DataFrame:
        reader, flat = self.spark.read.format(self.file_format), self._is_flat(table)
        if self.merge_schema:
            reader = reader.option("mergeSchema", "true")
        elif is_known(table):
            reader = reader.schema(read_schema(table, with_layout=not flat))
        found = reader.load(self.path(table))
        return laid_out(found, table) if flat else found

    def append(self, table: str, df: DataFrame) -> None:
        if self._is_flat(table):
            self._lay_out(table)
        self._save(table, _partitioned(laid_out(df, table).write.mode("append"), _layout(table)))

    def overwrite(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        files = SharedFiles(self.spark)
        before = self._versions(table)
        if not before and files.exists(self._below(table)):
            before = [table]
        version = f"_versions/{table}/{uuid.uuid4().hex}"
        try:
            writer = _partitioned(df.write.mode("errorifexists"), partition_by)
            _packed(writer, self.file_format).save(self._below(version))
        except BaseException:
            files.delete(self._below(version))
            raise
        files.replace(self._below(f"_current/{table}"), " ".join([version, *before[:1]]))
        for old in before[1:]:
            files.delete(self._below(old))

    def replace_parts(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        if self._is_flat(table):
            self._lay_out(table)
        writer = laid_out(df, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        self._save(table, writer.partitionBy(*(partition_by or _layout(table))))

    def _save(self, table: str, writer: DataFrameWriter) -> None:
        _packed(writer, self.file_format).save(self.path(table))


#: Properties of a view that stands for the versions of a catalog table.
CURRENT, PREVIOUS = "contentloom.current", "contentloom.previous"


@dataclass
class CatalogStore(TableStore):
    """Tables of a catalog database.

    A refreshed table is a view on its newest version, a table of its own; replacing the view is the
    switch. A table that was made by other means is renamed when it is refreshed for the first time, and
    for that moment readers find nothing.
    Known tables are created with the declared widths and defaults of their columns.
    """

    spark: SparkSession
    database: str = "default"
    file_format: str = "parquet"

    def _named(self, table: str) -> str:
        return f"{self.database}.{table}"

    def _property(self, table: str, key: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._named(table)}").collect()
        return {row[0]: row[1] for row in rows}.get(key)

    def _stored(self, table: str) -> str:
        """The table that holds the rows: itself, or the version that its view shows."""
        return self._property(table, CURRENT) or table if self.exists(table) else table

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self._named(table))

    def read(self, table: str) -> DataFrame:
        return self.read_laid_out(table).drop(*_layout(table))

    def _is_flat(self, table: str) -> bool:
        """Whether a table that has a layout was stored without it."""
        names = self.spark.table(self._named(table)).columns if table in LAYOUT and self.exists(table) else None
        return names is not None and not set(_layout(table)) <= set(names)

    def read_laid_out(self, table: str) -> DataFrame:
        found = self.spark.table(self._named(table))
        return laid_out(found, table) if self._is_flat(table) else found

    def append(self, table: str, df: DataFrame) -> None:
        if self._is_flat(table):
            self._lay_out(table)
        self._save(table, _partitioned(laid_out(df, table).write.mode("append"), _layout(table)))

    def create_if_absent(self, table: str, columns: T.StructType | None = None) -> None:
        if columns is not None or not is_known(table):
            super().create_if_absent(table, columns)
            return
        parts = f" PARTITIONED BY ({', '.join(_layout(table))})" if table in LAYOUT else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._named(table)} ({table_ddl(table)}) USING {self.file_format}{parts}"
        )

    def add_missing_columns(self, table: str) -> list[str]:
        name = self._named(self._stored(table))
        present = set(self.spark.table(name).columns)
        known = defaults(table)
        missing = [f for f in schema(table).fields if f.name not in present]
        if missing:
            ddl = ", ".join(
                f"{f.name} {f.dataType.simpleString()}" + (f" DEFAULT {known[f.name]}" if f.name in known else "")
                for f in missing
            )
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl})")
        return [f.name for f in missing]

    def overwrite(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        version = f"{table}__{uuid.uuid4().hex}"
        writer = _partitioned(df.write.mode("errorifexists"), partition_by)
        try:
            _packed(writer, self.file_format).saveAsTable(self._named(version))
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._named(version)}")
            raise
        before, old = "", None
        if self.exists(table):
            before, old = self._property(table, CURRENT), self._property(table, PREVIOUS)
            if before is None:
                before = f"{table}__{uuid.uuid4().hex}"
                self.spark.sql(f"ALTER TABLE {self._named(table)} RENAME TO {self._named(before)}")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._named(table)} "
            f"TBLPROPERTIES ('{CURRENT}' = '{version}', '{PREVIOUS}' = '{before}') "
            f"AS SELECT * FROM {self._named(version)}"
        )
        if old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._named(old)}")

    def replace_parts(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        if self._is_flat(table):
            self._lay_out(table)
        rows = laid_out(df, table)
        if not self.exists(table):
            self._save(table, rows.write.partitionBy(*(partition_by or _layout(table))))
            return
        name = self._named(self._stored(table))
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            rows.select(*self.spark.table(name).columns).write.insertInto(name, overwrite=True)
        finally:
            self.spark.conf.set(setting, before)

    def _save(self, table: str, writer: DataFrameWriter) -> None:
        _packed(writer, self.file_format).saveAsTable(self._named(self._stored(table)))


@dataclass
class JdbcStore(TableStore):
    """Tables of a relational database.

    Reads are split when a range of the key is given; without one the whole table would go
    through a single connection, so ``key_range`` belongs to every large table.
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_rows: int = 10_000
    write_connections: int = 16
    read_connections: int = 64
    key: str = "id"
    key_ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)

    def read_options(self, table: str) -> dict[str, str]:
        options = {
            **self.properties,
            "url": self.url,
            "dbtable": table,
            "fetchsize": str(self.fetch_rows),
        }
        if table in self.key_ranges:
            low, high = self.key_ranges[table]
            options |= {
                "partitionColumn": self.key,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(self.read_connections),
            }
        return options

    def write_options(self, table: str) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": table,
            "numPartitions": str(self.write_connections),
            "batchsize": "10000",
        }

    def exists(self, table: str) -> bool:
        """Unknown without asking the database; appending an empty frame creates only when
        there is no table."""
        return False

    def overwrite(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """File layout does not apply, so ``partition_by`` is not passed on."""
        super().overwrite(table, df)

    def replace_parts(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """A database has no partitions to replace: rows are appended, a repeated run's as well."""
        self.append(table, df)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.read_options(table)).load()

    def _save(self, table: str, writer: DataFrameWriter) -> None:
        writer.format("jdbc").options(**self.write_options(table)).save()


@contextmanager
def staged(df: DataFrame, folder: str | None = None) -> Iterator[DataFrame]:
    """``df`` as a table written once to a shared folder, for results used more than once.

    Readers start from the files, so losing an executor repeats no earlier work. The files go
    when the block ends. Without ``folder`` the session has to name one.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/contentloom-staged-{uuid.uuid4().hex}"
    _packed(df.write).save(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        SharedFiles(spark).delete(path)


def number_rows(df: DataFrame, first: int = 1, name: str = "id") -> DataFrame:
    """Contiguous ids from ``first`` for the rows of a table in Parquet files, such as a staged one.

    A row's place is its file and its position there. Rows are ranked inside their file, so a task
    handles what one task wrote, and the files' sizes, a row each, give the offsets.
    """
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_file").orderBy("_row")) - 1
    return (
        placed.withColumn("_rank", rank)
        .join(offsets, "_file")
        .withColumn(name, F.lit(first) + F.col("_before") + F.col("_rank"))
        .drop("_file", "_row", "_rank", "_before")
    )


def last_id(df: DataFrame, name: str = "id") -> int:
    """Greatest id in use, 0 for an empty table. Reads the whole column."""
    return df.agg(F.max(name)).first()[0] or 0
