"""Source readers (SRC1-SRC5).

* ``load`` / ``load_all``: warehouse-table scans over Parquet (SRC5).
* ``read_topic``, ``read_topic_by_name``: every export file of one topic in a folder (SRC1).
* ``canonicalise``: raw header -> canonical name + type (SRC2).
* ``read_positional``: header row ignored, names and types imposed (SRC3/4).

All readers are lazy; column pruning and filters written later reach the
Parquet scan (``ReadSchema`` / ``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIXTURE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

_TYPES = {
    "string": T.StringType(), "text": T.StringType(),
    "long": T.LongType(), "bigint": T.LongType(),
    "int": T.IntegerType(), "integer": T.IntegerType(),
    "double": T.DoubleType(), "numeric": T.DoubleType(),
    "boolean": T.BooleanType(), "logical": T.BooleanType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One base table (SRC5)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A warehouse table registered in the session catalog (SRC5)."""
    return spark.table(name)


def load_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              num_partitions: int, properties: dict | None = None) -> DataFrame:
    """A warehouse table read over JDBC in ``num_partitions`` parallel range
    reads on ``partition_column`` (SRC5); filters on the result are pushed
    into the remote query."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})


def load_all(spark: SparkSession, sf_dir: str,
             names: Iterable[str] = FIXTURE_TABLES) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in names}


def schema_of(columns: Iterable[tuple[str, str]]) -> T.StructType:
    """``[(name, type_name), ...]`` -> StructType (all nullable: blanks are NA)."""
    return T.StructType([T.StructField(n, _TYPES[t.lower()], True) for n, t in columns])


def read_topic(spark: SparkSession, folder: str, topic: str, schema: T.StructType | None = None,
               fmt: str = "csv", header: bool = True) -> DataFrame:
    """Every export of one topic in ``folder`` (SRC1): files *or* sub-folders
    whose name contains ``topic`` (a path glob, resolved by the file lister,
    so other topics are never opened).  Give a schema on large folders --
    inference reads the data twice; raw exports are best read as text and
    typed by :func:`canonicalise`.  A file whose header is not the schema's,
    name by name, is an error, not a silent shift of columns.
    """
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", str(header).lower())
        if schema is None:
            r = r.option("inferSchema", "true")
    if schema is not None:
        r = r.schema(schema)
        if fmt == "csv" and header:
            r = r.option("enforceSchema", "false")
    return r.load(f"{folder.rstrip('/')}/*{topic}*")


def read_topic_by_name(spark: SparkSession, folder: str, topic: str, schema: T.StructType) -> DataFrame:
    """Every CSV export of one topic, whatever the order of its columns (SRC1, SRC2).

    Files are grouped by their header line and each group is read with the
    header's own column order; the columns of ``schema`` are then taken by
    name and the groups stacked.  A column that a file lacks is NULL in its
    rows, one that the schema lacks is not returned; a file that has no column
    of the schema, or one of them twice, is an error.  Empty files give no rows.

    The header lines come from one distributed pass over the first blocks; the
    driver sees one line per file, as it does when it lists them.
    """
    path = f"{folder.rstrip('/')}/*{topic}*"
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    heads = (lines.filter("block = 0").groupBy("path").agg(F.min_by("value", "id").alias("head"))
             .groupBy("head").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("head").collect())
    kinds = {f.name: f.dataType for f in schema.fields}
    out = spark.createDataFrame([], schema)
    for h in heads:
        names = [n.strip() for n in next(csv.reader([h["head"].removeprefix("\ufeff")]), [])]
        known = [n for n in names if n in kinds]
        if not known or len(known) != len(set(known)):
            raise ValueError(f"header {h['head']!r} of {h['paths'][0]}: no column of the schema, or one of them twice")
        own = T.StructType([T.StructField(n if n in kinds else f"__{i}", kinds.get(n, T.StringType()))
                            for i, n in enumerate(names)])
        part = spark.read.schema(own).option("header", "true").option("enforceSchema", "true").csv(h["paths"])
        out = out.unionByName(part.select(*[F.col(f"`{n}`") for n in known]), allowMissingColumns=True)
    return out


def canonicalise(df: DataFrame, mapping: Mapping[str, tuple[str, str] | str],
                 extras: Mapping[str, str] | None = None) -> DataFrame:
    """Rename and cast raw columns to canonical names (SRC2).

    ``mapping``: canonical -> raw name, or canonical -> (raw name, type).
    Casts use ``try_cast`` so bad numbers become NULL, as in the tidy layer.
    ``extras``: further canonical -> raw names kept as text.
    """
    cols: list[Column] = []
    for canon, spec in {**mapping, **(extras or {})}.items():
        raw, typ = (spec, None) if isinstance(spec, str) else spec
        c = F.col(f"`{raw}`")
        if typ is not None:
            c = c.try_cast(_TYPES[typ])
        cols.append(c.alias(canon))
    return df.select(*cols)


def read_positional(spark: SparkSession, path: str, columns: Iterable[tuple[str, str]],
                    skip_header: bool = True, fmt: str = "csv") -> DataFrame:
    """Ignore the file's header names and impose names *and* types by position
    (SRC3/SRC4).  Blank cells become NULL; text that does not parse as the
    declared type becomes NULL as well (PERMISSIVE mode)."""
    schema = schema_of(columns)
    return (spark.read.format(fmt)
            .schema(schema)
            .option("header", str(skip_header).lower())
            .option("enforceSchema", "true")
            .option("mode", "PERMISSIVE")
            .load(path))
