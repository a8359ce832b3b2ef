"""Inputs of the jobs as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions.text import strip
from threadloom.session import configure
from threadloom.sources.csv_records import charset_of, csv_records, file_lines


def read_keywords(
    spark: SparkSession, path: str, site: str | None = None, skip_comments: bool = False
) -> DataFrame:
    """One keyword per line, stripped, blank lines dropped.

    A first line that starts with ``#`` is a keyword like any other unless ``skip_comments``.
    ``ord`` rises with the line number inside each split of the file.
    """
    lines = _load(spark.read.format("text"), path).select(
        F.lit(site).cast("string").alias("site"),
        F.monotonically_increasing_id().alias("ord"),
        strip(F.col("value")).alias("keyword"),
    )
    kept = lines.filter(F.col("keyword") != "")
    return kept.filter(~F.col("keyword").startswith("#")) if skip_comments else kept


def keyword_list(keywords: DataFrame, limit: int | None = None) -> list[str]:
    """The keywords on the driver, where the search pattern is built: a hand-written list.

    A caller that cannot trust the file may set a ``limit`` in bytes, above which it is refused.
    """
    if limit is not None:
        total = keywords.agg(F.coalesce(F.sum(F.octet_length("keyword")), F.lit(0))).first()[0]
        if total > limit:
            raise ValueError(f"{total} bytes of keywords do not make a usable pattern (limit {limit})")
    return [row.keyword for row in keywords.orderBy("ord").collect()]


def read_seeds(spark: SparkSession, path: str, site: str, multi_line: bool = True) -> DataFrame:
    """Seed forums from a JSON array of name, url and (optional) description.

    Without ``multi_line`` each line holds an array of its own, and large files are split.
    """
    reader = spark.read.schema(schemas.SEED_FILE)
    reader = reader.option("multiLine", multi_line).option("mode", "FAILFAST")
    return _load(reader.format("json"), path).select(
        F.lit(site).alias("site"),
        F.monotonically_increasing_id().alias("ord"),
        "name",
        "url",
        "description",
    )


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table of fetched pages. Partition it by site (and fetch day) so runs prune by folder."""
    return _load(spark.read.format(fmt), path)


def read_page_files(spark: SparkSession, pattern: str, site: str, seed_url: str) -> DataFrame:
    """Saved page files, one HTML document each, numbered by nothing but their path."""
    files = _load(spark.read.format("binaryFile"), pattern)
    return files.select(
        F.lit(site).alias("site"),
        F.lit(seed_url).alias("seed_url"),
        F.try_to_number(F.regexp_extract("path", r"(\d{1,18})\D*$", 1), F.lit("9" * 18))
        .cast("bigint")
        .alias("page_no"),
        F.col("path").alias("url"),
        F.col("content").cast("string").alias("html"),
    )


def latest_output(spark: SparkSession, pattern: str, folder: bool = False) -> str:
    """Path of the most recently modified file that matches ``pattern``.

    With ``folder`` the pattern names files inside output folders and the folder is returned.
    Only file metadata is read. Equal times are settled by the path.
    """
    files = _load(spark.read.format("binaryFile"), pattern).select("path", "modificationTime")
    if folder:
        files = files.withColumn("path", F.regexp_replace("path", "/[^/]*$", ""))
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no file matches {pattern}")
    return newest


def latest_committed(spark: SparkSession, pattern: str) -> str:
    """Path of the output folder matching ``pattern`` that was finished last.

    A folder counts from the mark on that ``write_rows`` and ``write_checked`` leave when all tasks are done, so
    one still being written, or left by a run that died, is passed over. Equal times are settled by the path.
    """
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern.rstrip('/')}/{schemas.COMMIT_MARK}")
    found = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(mark)
    done = [(f.getModificationTime(), f.getPath().getParent().toString()) for f in found or []]
    if not done:
        raise FileNotFoundError(f"no finished output matches {pattern}")
    return max(done)[1]


def file_charsets(spark: SparkSession, path: str) -> DataFrame:
    """Header line and charset of every file: utf-8 when all its bytes are, else utf-16 with a
    byte order mark, else gbk. The lines are checked in parallel, splits of one file too."""
    lines = file_lines(_load(spark.read.format("text"), path))
    return lines.groupBy("path").agg(
        F.min_by("value", F.struct("block", "line")).alias("header"),
        charset_of(F.every("utf8"), F.some("bom16")).alias("charset"),
    )


def read_worklist(
    spark: SparkSession, path: str, charset: str | None = None, fmt: str | None = None
) -> DataFrame:
    """Work-list CSV files as thread_title, thread_link, thread_date, whatever the file calls them.

    Quoted fields may hold line breaks and quotes. Charset and header may differ from file to file; give
    ``charset`` when all files agree on it. All tasks read a large file together, unless it is in UTF-16: such
    files are read one task each, and their paths pass through the driver. ``ord`` keeps the order of rows inside a file.

    A work list between jobs is Parquet (``fmt``), as ``write_rows`` leaves it, folders with
    partitions too; it is read in parallel and needs no look at charsets. By default the names of
    the files decide.
    """
    configure(spark)
    if fmt is None:
        names = _load(spark.read.format("binaryFile").option("recursiveFileLookup", True), path)
        parquet = F.col("_metadata.file_path").endswith(".parquet")
        fmt = "parquet" if not names.filter(parquet).select("path").isEmpty() else "csv"
    if fmt == "parquet":
        return _worklist(_load(spark.read.format("parquet"), path))
    if fmt != "csv":
        raise ValueError(f"work lists are csv or parquet, not {fmt}")
    if charset and charset.lower().replace("-", "").startswith("utf16"):
        return _worklist_csv(spark, [path], charset)
    older = {new: old for old, new in schemas.WORKLIST_NAMES.items()}
    wanted = {f.name: [f.name, older[f.name]] for f in schemas.WORKLIST}
    rows, wide = csv_records(_load(spark.read.format("text"), path), wanted, "thread_link", charset)
    rows = rows.select(*wanted, "ord")
    paths = sorted(row.path for row in wide.collect())
    return rows.unionByName(_worklist_csv(spark, paths, "utf-16")) if paths else rows


def _worklist_csv(spark: SparkSession, paths: list[str], charset: str) -> DataFrame:
    rows = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", charset)
        .csv(paths)
    )
    return _worklist(rows)


def _worklist(rows: DataFrame) -> DataFrame:
    rows = rows.withColumnsRenamed(schemas.WORKLIST_NAMES)
    if "thread_link" not in rows.columns:
        raise ValueError(f"no thread_link or post_link among {rows.columns}")
    fields = [
        F.col(f.name) if f.name in rows.columns else F.lit(None).cast("string").alias(f.name)
        for f in schemas.WORKLIST
    ]
    return rows.select(*fields, F.monotonically_increasing_id().alias("ord"))


def _load(reader, path: str) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no file at {path}") from e
        raise
