"""Readers: stored tables, database tables, CSV exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions.scalars import epoch_seconds, numeric_coerce
from murmur.sources.csv import RANGE_BYTES, read_csv


def expose_json_fields(frame: DataFrame, fields: dict, data_col: str = "data") -> DataFrame:
    """Adds typed columns for members of the JSON column.

    `fields` maps a column to ((member, ...), type); the first member present is
    taken. Type is string, int, double or epoch (whole seconds). Malformed
    values are null. The JSON is parsed once for all members. Extracting at load
    lets every later query prune the JSON and push filters on the typed columns
    down to the scan.
    """
    members = dict.fromkeys(m for names, _ in fields.values() for m in names)
    record = F.from_json(F.col(data_col), ", ".join(f"`{m}` string" for m in members))
    return (
        frame.withColumn("_json", record)
        .withColumns({name: _typed(names, kind) for name, (names, kind) in fields.items()})
        .drop("_json")
    )


def _typed(members: tuple[str, ...], kind: str) -> Column:
    text = F.coalesce(*[F.col(f"_json.`{m}`") for m in members])
    if kind == "epoch":
        return epoch_seconds(text)
    if kind == "double":
        return numeric_coerce(text)
    return text if kind == "string" else text.try_cast(kind)


def load_posts_table(
    spark: SparkSession,
    path: str,
    fields: dict,
    fmt: str = "parquet",
    schema: str | None = None,
    data_col: str = "data",
) -> DataFrame:
    """A stored post or comment table with its JSON members as typed columns."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    return expose_json_fields(reader.load(path), fields, data_col)


# Rows of a file of the layout, about; a busy day has several files.
FILE_ROWS = 1_000_000


def write_posts_layout(
    frame: DataFrame,
    path: str,
    fields: dict,
    key: str = "post_id",
    community: str = "subreddit",
    time_col: str = "created",
    data_col: str = "data",
    mode: str = "append",
    file_rows: int = FILE_ROWS,
    row_group_bytes: int | None = None,
    per: str = "day",
) -> None:
    """Stores a post or comment table so that scans can skip most of it.

    The JSON is typed once (`fields` as in `expose_json_fields`). Days are folders (or, of a
    table with few posts a day, `per` "month" or "year"); inside a folder rows are sorted by community and key, so that row groups have narrow ranges of both,
    and files carry Bloom filters on the key. Rows are dealt by ranges of day, community and
    key, so that a busy day or community is spread over tasks. Rows without a time are in
    the folder of the null day.
    """
    typed = expose_json_fields(frame, fields, data_col)
    order = ["day", community, key]
    files = max(1, -(-frame.count() // file_rows))
    rows = typed.withColumn("day", _folder(F.col(time_col), per)).repartitionByRange(files, *order).sortWithinPartitions(*order)
    writer = (
        rows.write.mode(mode)
        .partitionBy("day")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(file_rows))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def _folder(epoch: Column, per: str) -> Column:
    """The first day of the day, month or year."""
    day = F.to_date(F.timestamp_seconds(epoch))
    return day if per == "day" else F.trunc(day, per)


def load_posts_layout(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    start: int | None = None,
    end: int | None = None,
    communities: list[str] | None = None,
    keys: list[str] | None = None,
    key: str = "post_id",
    community: str = "subreddit",
    time_col: str = "created",
    per: str = "day",
) -> DataFrame:
    """What `write_posts_layout` stored, with its filters where scans can use them.

    `start` and `end` are epoch seconds, both included; the folders of other days are not
    opened. `communities` and `keys` skip files and row groups by their ranges and Bloom
    filters. `schema` spares a look into a file.
    """
    reader = spark.read.schema(f"{schema}, day date") if schema else spark.read
    frame = reader.parquet(path)
    for bound, op in ((start, "__ge__"), (end, "__le__")):
        if bound is not None:
            day = _folder(F.lit(bound), per)
            frame = frame.where(getattr(F.col("day"), op)(day) & getattr(F.col(time_col), op)(bound))
    if communities is not None:
        frame = frame.where(F.col(community).isin(communities))
    if keys is not None:
        frame = frame.where(F.col(key).isin(keys))
    return frame.drop("day")


def load_posts_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    fields: dict,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
    data_col: str = "data",
) -> DataFrame:
    """The same from a database, read in parallel over ranges of a numeric column."""
    frame = (
        spark.read.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
    return expose_json_fields(frame, fields, data_col)


def load_export_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    columns: list[str] | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """A CSV export with a header, quoted JSON cells and line breaks inside cells.

    A large file is read in ranges of `range_bytes`, see `murmur.sources.csv`.
    """
    frame = read_csv(spark, path, schema, range_bytes=range_bytes)
    return frame.select(*columns) if columns else frame
