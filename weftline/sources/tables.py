"""Reading, building and appending tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


class Tables:
    """Parquet tables of one folder, read lazily by attribute: ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def stream(self, name: str, **options: str) -> DataFrame:
        """The table as a file stream. The trailing wildcard lets one file stand for a folder of files."""
        reader = self.spark.readStream.schema(getattr(self, name).schema).options(**options)
        return reader.parquet(self.path(name) + "*")


def inline_rows(spark: SparkSession, schema: str | T.StructType, rows: Iterable[tuple]) -> DataFrame:
    """A small literal table, for labels and lookups written in the program."""
    return spark.createDataFrame(list(rows), schema)


def number_series(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "n") -> DataFrame:
    """Integers from ``start`` to ``stop`` inclusive, generated in parallel on the executors."""
    return spark.range(start, stop + (1 if step > 0 else -1), step).withColumnRenamed("id", name)


def cyclic_products(numbers: DataFrame, n: str, categories: int, prices: int, lowest_price: int) -> DataFrame:
    """One product per number, walking through categories 1..``categories`` and ``prices`` prices in turn."""
    return numbers.select(
        F.col(n).alias("id"),
        F.concat(F.lit("Product "), F.col(n).cast("string")).alias("name"),
        cyclic(F.col(n), categories, 1).alias("category_id"),
        cyclic(F.col(n), prices, lowest_price).alias("price"),
    )


def cyclic(n: Column, length: int, first: int) -> Column:
    """first, first + 1, .., first + length - 1, first, .. as ``n`` counts up."""
    return F.pmod(n, F.lit(length)) + first


def like_schema(df: DataFrame) -> DataFrame:
    """An empty table with the same columns."""
    return df.sparkSession.createDataFrame([], df.schema)


def append_rows(table: DataFrame, rows: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Append ``rows``, matched by name. Columns the rows lack take their default, or NULL."""
    defaults = defaults or {}
    types = {f.name: f.dataType for f in table.schema.fields}
    unknown = set(rows.columns) - set(types)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    filled = [
        (F.col(c) if c in rows.columns else defaults.get(c, F.lit(None))).cast(types[c]).alias(c) for c in table.columns
    ]
    return table.unionByName(rows.select(*filled))


def list_relations(spark: SparkSession, pattern: str = "*", temporary: bool | None = None) -> list[tuple[str, str]]:
    """(name, type) of catalog tables and views that match ``pattern``, sorted by name."""
    found = spark.catalog.listTables(pattern=pattern)
    return sorted((t.name, t.tableType) for t in found if temporary is None or t.isTemporary == temporary)


def first_or_raise(df: DataFrame, condition: Column, order: list[str]) -> dict:
    """The first row that meets the condition, as a dict; LookupError when there is none."""
    row = df.where(condition).orderBy(*order).first()
    if row is None:
        raise LookupError("no row meets the condition")
    return row.asDict()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of any shape: the text, the parsed variant ``v``, and ``malformed`` for lines that are not JSON."""
    lines = spark.read.text(path).withColumnRenamed("value", "doc")
    parsed = lines.withColumn("v", F.try_parse_json("doc"))
    return parsed.withColumn("malformed", F.col("v").isNull() & (F.trim("doc") != ""))


def write_clustered(df: DataFrame, path: str, folders: list[str], sort_by: list[str], files: int) -> None:
    """Write for filters on ``folders`` (equality) and ``sort_by`` (ranges).

    Readers skip whole folders by the first and row groups by the second. Rows are spread over ``files`` tasks by range
    over both, so a folder that holds much of the table is written by many tasks, and a small one gives one file.
    """
    columns = [*folders, *sort_by]
    spread = df.repartitionByRange(files, *columns).sortWithinPartitions(*columns)
    spread.write.partitionBy(*folders).mode("overwrite").parquet(path)
