"""CSV and Parquet files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartframes.columns import col
from chartframes.sources.sketches import sketches
from chartframes.sources.tables import mapping_table

#: A finished cache has this file with its schema and number of rows, and perhaps a folder of sketches.
MARKER = "_CACHED.json"
SKETCH = "_SKETCH"


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, **options) -> DataFrame:
    """CSV with a header line; every column is text unless a schema is given.

    Quotes are doubled inside quoted fields, as most tools write them.
    """
    reader = spark.read.options(header=True, escape='"', **options)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_lenient(spark: SparkSession, path: str | list[str], kinds: dict[str, str], lost: Observation | None = None, **options) -> DataFrame:
    """CSV in which a cell that does not parse becomes null and its row stays.

    ``lost`` counts such cells by column while the rows are read by whatever reads them: its ``get`` has
    the counts of the first action on the whole result, without another pass.
    """
    text = read_csv(spark, path, **options)
    parsed = {n: col(n).try_cast(kinds[n]) for n in text.columns if n in kinds}
    if lost is None or not parsed:
        return text.select(*[parsed[n].alias(n) if n in kinds else col(n) for n in text.columns])
    both = text.select(*[F.struct(parsed[n].alias("to"), (col(n).isNotNull() & parsed[n].isNull()).alias("lost")).alias(n) if n in kinds else col(n) for n in text.columns])
    seen = both.observe(lost, *[F.count_if(col(n)["lost"]).alias(n) for n in parsed])
    return seen.select(*[col(n)["to"].alias(n) if n in kinds else col(n) for n in text.columns])


def read_tagged(
    spark: SparkSession, paths: dict[str, str], tag: str, prepare: Callable[[DataFrame], DataFrame] | None = None, **options
) -> DataFrame:
    """CSV files of one layout, prepared alike and marked with their labels; ``paths`` names a file or folder for each label.

    All are read by one scan, however many there are, and a row's label is looked up by the file it comes from. The first
    file's header holds for all. ``prepare`` must keep the rows apart from each other (no aggregates).
    """
    places = {label: _qualified(spark, path) for label, path in paths.items()}
    if len(set(places.values())) < len(places):
        raise ValueError("two labels name the same path")
    text = read_csv(spark, list(paths.values()), **options)
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    marked = text.select("*", _plain_path(file).alias("__file"), _plain_path(F.regexp_replace(file, "/[^/]*$", "")).alias("__folder"))
    prepared = prepare(marked) if prepare else marked
    names = mapping_table(spark, {place: label for label, place in places.items()}, "__place", tag)
    out = prepared.drop("__file", "__folder").columns
    # a file is listed itself, or its folder is
    prepared = prepared.withColumn("__place", F.when(F.col("__file").isin(list(places.values())), F.col("__file")).otherwise(F.col("__folder")))
    return prepared.join(F.broadcast(names), "__place").select(*[col(n) for n in out], col(tag))


def _plain_path(path):
    """A path without the empty authority that some writers put after the scheme."""
    return F.regexp_replace(path, "^([a-z0-9]+):///?", "$1:/")


def _qualified(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    scheme, _, rest = full.partition(":")
    return f"{scheme}:{rest.replace('///', '/', 1) if rest.startswith('///') else rest}".replace("://", ":/", 1).rstrip("/")


def read_two_row_header(
    spark: SparkSession, path: str, kinds: dict[str, str], default: str = "double", more: list[str] | None = None
) -> DataFrame:
    """One CSV file whose header line is followed by a row of units and a row of codes.

    A column is named ``code units``, or by its header where it has no code. Cells that do not parse
    become null. ``more`` lists further files of the same columns that have the header line only.
    Only the two rows reach the driver.
    """
    text = read_csv(spark, path)
    marked = text.select(
        *[col(n) for n in text.columns],
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__line"),
    )
    is_header = (F.col("__block") == 0) & (F.col("__line") < 2)
    units, codes = marked.where(is_header).orderBy("__line").drop("__block", "__line").collect()
    names = [n if codes[n] is None else f"{codes[n]} {units[n]}" for n in text.columns]
    body = marked.where(~is_header).drop("__block", "__line")
    if more:
        body = body.unionByName(read_csv(spark, more))
    return body.select(
        *[col(o).try_cast(kinds.get(n, default)).alias(n) for o, n in zip(text.columns, names)]
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def cached_source(spark: SparkSession, path: str, build: Callable[[], DataFrame], sketch: bool = False) -> DataFrame:
    """Read ``path`` if an earlier run has finished it, otherwise build the table and keep it there.

    A table is written to a folder of its own beside ``path``, gets a marker with its schema and number of rows, and is renamed
    as a whole; so a folder with a marker is complete, and of two builders the first wins and both read its
    table. A folder without a marker is taken as it is, and one that cannot be read as a table is an error and is left alone;
    but one that a job is known to have left half-written (``_temporary``) is set aside under another name and built
    anew. ``sketch`` keeps sketches of the columns with the table (``cached_sketches``).
    """
    files, place = _files(spark, path)
    if files.exists(_inside(spark, path, MARKER)):
        return _read_cached(spark, path)
    if files.exists(_inside(spark, path, "_temporary")):
        _rename(spark, path, f"{path.rstrip('/')}.unfinished.{uuid.uuid4().hex}")
    elif files.exists(place):
        return spark.read.parquet(path)
    staging = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    counted = Observation()
    table = build()
    table.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(staging)
    if sketch:
        sketches(spark.read.schema(table.schema).parquet(staging)).write.parquet(f"{staging}/{SKETCH}")
    marker = json.dumps({"schema": json.loads(table.schema.json()), "rows": counted.get["rows"]})
    out = files.create(_inside(spark, staging, MARKER))
    out.write(bytearray(marker.encode()))
    out.close()
    _publish(spark, staging, path)
    return _read_cached(spark, path)


def cached_rows(spark: SparkSession, path: str) -> int:
    """The number of rows of a finished cache, without reading them."""
    return _marker(spark, path)["rows"]


def cached_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches that are kept with a cache."""
    return spark.read.parquet(f"{path.rstrip('/')}/{SKETCH}")


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _inside(spark: SparkSession, path: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path, name)


def _marker(spark: SparkSession, path: str) -> dict:
    files, _ = _files(spark, path)
    stream = files.open(_inside(spark, path, MARKER))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _read_cached(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(_marker(spark, path)["schema"])).parquet(path)


def _rename(spark: SparkSession, source: str, to: str) -> None:
    """Rename a folder, never into another one or over it."""
    jvm = spark._jvm.org.apache.hadoop.fs
    files, _ = _files(spark, source)
    context = jvm.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(jvm.Path(source), jvm.Path(to), spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0))


def _publish(spark: SparkSession, staging: str, path: str) -> None:
    """Rename a finished folder to ``path``; if another builder was first, its folder stays and this one goes."""
    files, _ = _files(spark, path)
    try:
        _rename(spark, staging, path)
    except Exception:
        if not files.exists(_inside(spark, path, MARKER)):
            raise
        files.delete(_files(spark, staging)[1], True)
