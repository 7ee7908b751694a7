"""Dated file feeds: listing, selection and scans (S4-S8).

A feed entry is named ``<prefix><ddMMyyyy>.<ext>``; the date is the text
after the prefix up to the first dot.  An entry may be a single file or a
folder of part files, as Spark writes them.  Every field is read as text
(no inference: ids keep leading zeros, empty cells become NULL, not 'NaN')
and typed later in staging.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cardwatch.schemas import FEED_DATE_FORMAT, FEED_TERMINALS_RAW, FEED_TRANSACTIONS_RAW

INTENDED, LITERAL = "intended", "literal"


def _re_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?{}[]\|()" else ch)
    return "".join(out)


class FeedEntries(DataSource):
    """``spark.read.format("feed_entries").load(folder)``: (name, file_dt, folder, modified) of
    each entry of a feed folder, without its contents.  Only the folder's top level is
    listed, by one task; ``file_dt`` is the date after the last ``_`` of the name up to its
    first dot, NULL where there is none.  An entry is a file, or a folder of part files;
    names that begin with ``_`` or ``.`` are none."""

    #: Stores that a task can list without Spark's file systems.
    SCHEMES = ("file", "s3", "gs")

    @classmethod
    def name(cls) -> str:
        return "feed_entries"

    def schema(self) -> str:
        return "name string, file_dt date, folder boolean, modified timestamp"

    def reader(self, schema) -> DataSourceReader:
        return _FeedEntriesReader(self.options["path"])


class _FeedEntriesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.path)]

    def read(self, partition: InputPartition):
        from pyarrow import fs

        where = partition.value
        if where.startswith("file:"):
            where = "/" + where[len("file:"):].lstrip("/")
        store, path = fs.FileSystem.from_uri(where)
        for f in sorted(store.get_file_info(fs.FileSelector(path)), key=lambda f: f.base_name):
            if f.base_name.startswith(("_", ".")):
                continue
            yield f.base_name, entry_date(f.base_name), f.type == fs.FileType.Directory, f.mtime


def entry_date(name: str) -> dt.date | None:
    """The date in an entry's name."""
    text = name.split(".")[0].rsplit("_", 1)[-1]
    try:
        return dt.datetime.strptime(text, "%d%m%Y").date() if len(text) == 8 else None
    except ValueError:
        return None


def list_entries(spark: SparkSession, root: str) -> DataFrame:
    """Names in a feed folder: one listing of its top level, so part files below an entry
    aren't listed and no content is read.  One name per delivered entry: metadata.  Stores that
    only Spark's own file systems know are listed by the driver."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = fs.makeQualified(path)  # with the scheme of the default file system if ``root`` has none
    if whole.toUri().getScheme() in FeedEntries.SCHEMES:
        spark.dataSource.register(FeedEntries)
        return spark.read.format(FeedEntries.name()).load(whole.toString()).select("name")
    names = [(s.getPath().getName(),) for s in fs.listStatus(path)]
    return spark.createDataFrame(names, "name string")


def parse_entries(names: DataFrame, prefix: str) -> DataFrame:
    """(name) -> (name, file_dt) for names with the prefix; a name whose date can't be read
    fails the job."""
    date_text = F.regexp_extract(F.col("name"), "^" + _re_escape(prefix) + r"([^.]*)", 1)
    bad = F.raise_error(F.concat(F.lit("feed entry with an unreadable date: "), F.col("name")))
    return (names.where(F.col("name").startswith(prefix))
            .select("name", F.coalesce(F.try_to_date(date_text, FEED_DATE_FORMAT),
                                       bad.cast("date")).alias("file_dt")))


def pick_feeds(names: DataFrame, watermarks: DataFrame, prefixes: dict[str, str],
               mode: str = INTENDED) -> DataFrame:
    """One pick per feed: (feed, name, file_dt).  ``watermarks`` holds
    (source_name, max_update_dt); ``prefixes`` maps source name -> prefix."""
    parts = [parse_entries(names, p).withColumn("feed", F.lit(src)) for src, p in prefixes.items()]
    cand = parts[0]
    for p in parts[1:]:
        cand = cand.unionByName(p)
    wm = watermarks.select(F.col("source_name").alias("feed"), "max_update_dt")
    cand = cand.join(wm, "feed").where(F.col("file_dt") > F.col("max_update_dt"))
    rank = F.struct("file_dt", "name") if mode == INTENDED else F.col("name")
    best = cand.groupBy("feed").agg(F.min_by(F.struct("name", "file_dt"), rank).alias("b"))
    return best.select("feed", "b.name", "b.file_dt")


def _read_text(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """All columns as text, named by the header; a part file with another header, or a
    row with more or fewer fields than it, fails the read."""
    head = spark.read.option("header", "true").option("sep", sep).csv(path).schema
    return (spark.read.schema(head).option("header", "true").option("sep", sep)
            .option("enforceSchema", "false").option("mode", "FAILFAST").csv(path))


def _by_name(df: DataFrame, names: list[str], path: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {df.columns}")
    return df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names])


def _is_parquet(path: str, fmt: str | None) -> bool:
    return (fmt or "").lower() == "parquet" or path.rstrip("/").endswith(".parquet")


def read_transactions(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """S4: ``;``-separated text, columns selected by header name in any order; further
    columns are ignored, a missing one fails the read."""
    return _by_name(_read_text(spark, path, sep), [f.name for f in FEED_TRANSACTIONS_RAW.fields], path)


def read_blacklist(spark: SparkSession, path: str, fmt: str | None = None,
                   sep: str = ";") -> DataFrame:
    """S5: two columns taken by position (entry date, passport number)."""
    if _is_parquet(path, fmt):
        df = spark.read.parquet(path)
    else:
        df = _read_text(spark, path, sep)
    if len(df.columns) < 2:
        raise ValueError(f"{path}: two columns are needed, the header has {df.columns}")
    return df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns[:2]]).toDF("enty_dt", "passport_num")


def read_terminals(spark: SparkSession, path: str, fmt: str | None = None,
                   sep: str = ";") -> DataFrame:
    """S6: columns selected by header name."""
    names = [f.name for f in FEED_TERMINALS_RAW.fields]
    df = spark.read.parquet(path) if _is_parquet(path, fmt) else _read_text(spark, path, sep)
    return _by_name(df, names, path)


def write_text_feed(df: DataFrame, path: str, sep: str = ";") -> None:
    """Write a feed entry as delimited text with a header (a part folder)."""
    (df.write.mode("errorifexists").option("header", "true").option("sep", sep)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def write_text_entries(lines: DataFrame, root: str) -> None:
    """Write a folder of text entries in one job: ``lines`` holds (name, value), a line each.  Every
    entry is a folder of part files."""
    spark = lines.sparkSession
    part = f"{root}/_entries"
    lines.select("name", "value").write.mode("errorifexists").partitionBy("name").text(part)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path(part)):  # one folder per entry
        folder = status.getPath().getName()
        if folder.startswith("name="):
            fs.rename(status.getPath(), path(f"{root}/{folder[len('name='):]}"))
