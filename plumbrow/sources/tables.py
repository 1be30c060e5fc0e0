"""Named tables and Parquet paths."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbrow.sources.staging import delete_path

#: The table property that names the version before the current one.
_FORMER = "plumbrow.former_version"


@dataclass(frozen=True)
class TableRef:
    """A table whose catalog, schema and name can each be overridden for a run."""

    identifier: str
    schema: str | None = None
    catalog: str | None = None

    @property
    def name(self) -> str:
        parts = [self.catalog, self.schema, self.identifier]
        return ".".join(f"`{p}`" for p in parts if p)

    def beside(self, identifier: str) -> TableRef:
        """Another table in the same place."""
        return TableRef(identifier, self.schema, self.catalog)


def mart_ref(
    sector: str,
    schema: str | None = None,
    catalog: str | None = None,
    identifier: str | None = None,
) -> TableRef:
    """A sector's mart, by default `<sector>_mart` in the schema named after the sector."""
    return TableRef(identifier or f"{sector}_mart", schema or sector, catalog)


def read_table(spark: SparkSession, source: TableRef | str) -> DataFrame:
    """A table by reference, or Parquet files by path."""
    if isinstance(source, TableRef):
        return spark.table(source.name)
    return spark.read.parquet(source)


def table_exists(spark: SparkSession, ref: TableRef) -> bool:
    return spark.catalog.tableExists(ref.name)


def append_table(df: DataFrame, ref: TableRef) -> None:
    df.write.mode("append").format("parquet").saveAsTable(ref.name)


def write_table(df: DataFrame, ref: TableRef) -> None:
    """Replace a table by the rows of `df`, which may come from that table, or make it.

    The rows go to a folder of their own first; then the table's location is changed, which is one step
    of the catalog. If writing fails, that folder is deleted and the table stays as it is. The version
    before the current one is kept for those who are still reading it, older ones are deleted. A table
    with other columns takes the old one's place by a drop and a rename once its rows are written. A
    catalog of its own (`ref.catalog`) replaces tables by its own means.
    """
    spark = df.sparkSession
    if ref.catalog and ref.catalog != "spark_catalog":
        df.writeTo(ref.name).createOrReplace()
        return
    folder = f"{_schema_folder(spark, ref)}/{ref.identifier}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(folder)
    except BaseException:
        delete_path(spark, folder)
        raise
    if not table_exists(spark, ref):
        _register(df, ref, folder)
        return
    former, before_that = _location(spark, ref), _properties(spark, ref).get(_FORMER)
    if spark.table(ref.name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {ref.name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(ref.name)
        spark.sql(f"ALTER TABLE {ref.name} SET TBLPROPERTIES ('{_FORMER}' = '{former}')")
        if before_that:
            delete_path(spark, before_that)
    else:
        new = ref.beside(f"{ref.identifier}_{uuid.uuid4().hex}")
        _register(df, new, folder)
        spark.sql(f"DROP TABLE {ref.name}")
        spark.sql(f"ALTER TABLE {new.name} RENAME TO {ref.name}")
        for path in (former, before_that):
            if path:
                delete_path(spark, path)


def _register(df: DataFrame, ref: TableRef, folder: str) -> None:
    columns = df._jdf.schema().toDDL()
    df.sparkSession.sql(f"CREATE TABLE {ref.name} ({columns}) USING parquet LOCATION '{folder}'")


def _schema_folder(spark: SparkSession, ref: TableRef) -> str:
    name = ref.schema or spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(name).locationUri.rstrip("/")


def _described(spark: SparkSession, ref: TableRef, field: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {ref.name}").where(f"col_name = '{field}'")
    found = rows.first()
    return found["data_type"] if found else None


def _location(spark: SparkSession, ref: TableRef) -> str | None:
    return _described(spark, ref, "Location")


def _properties(spark: SparkSession, ref: TableRef) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ref.name}").collect()}
