"""CSV records of files that are read in parallel, whatever line breaks their quoted fields hold.

A task reads the lines of its split without knowing whether it begins inside a quoted field, so each line
is kept as what it does to either state. Running these along the lines of a split, and then along the splits of a
file, tells where every record begins; lines of a record meet by that place, across splits too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions.binding import let
from threadloom.session import stored

# Quoted text up to its closing quote; whole fields with their commas; a field that stays open.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_WHOLE = rf'(?:"{_INSIDE}"[^,]*+,|[^",][^,]*+,|,)*+'
_OPEN = rf'"{_INSIDE}\z'
#: Lines that end inside a quoted field, begun outside of one and begun inside.
_OPENS = rf"\A{_WHOLE}{_OPEN}"
_STAYS_OPEN = rf'\A{_INSIDE}(?:\z|"[^,]*+,{_WHOLE}{_OPEN})'
OPTIONS = {"quote": '"', "escape": '"'}


def file_lines(text: DataFrame) -> DataFrame:
    """Lines of the text files that ``text`` reads, with ``path``, the first byte of their split (``block``), ``line`` that rises inside
    it, and what tells the charset of the file."""
    raw = F.col("value").cast("binary")
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        F.is_valid_utf8("value").alias("utf8"),
        F.substring(raw, 1, 2).isin(F.unhex(F.lit("FFFE")), F.unhex(F.lit("FEFF"))).alias("bom16"),
    )


def charset_of(utf8: Column, bom16: Column) -> Column:
    """utf-8 when all bytes are, else utf-16 with a byte order mark, else gbk."""
    return F.when(utf8, "utf-8").when(bom16, "utf-16").otherwise("gbk")


def _states(rows: DataFrame, closed: str, opened: str, window) -> DataFrame:
    """``rows`` with the state after each of them (1 inside a quoted field): ``after0`` if the window begins
    outside, ``after1`` if inside. A row takes outside to ``closed`` and inside to ``opened``."""
    turns = F.sum((F.col(closed) > F.col(opened)).cast("int")).over(window)
    # A row with one outcome forgets all before it; from there on only the turns count.
    known = F.when(F.col(closed) == F.col(opened), F.col(closed) + F.col("_turns"))
    rows = rows.withColumn("_turns", turns).withColumn("_known", F.last(known, ignorenulls=True).over(window))
    after = ((F.col("_turns") + F.coalesce("_known", F.lit(start))) % 2 for start in (0, 1))
    return rows.withColumns(dict(zip(("after0", "after1"), after))).drop("_turns", "_known")


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their record number in the split (0: it began in an earlier one), for either start of the split."""
    quotes = F.contains("value", F.lit('"'))
    lines = lines.withColumns({
        "_closed": (quotes & F.rlike("value", F.lit(_OPENS))).cast("int"),
        "_opened": (~quotes | F.rlike("value", F.lit(_STAYS_OPEN))).cast("int"),
    })
    here = Window.partitionBy("path", "block").orderBy("line")
    lines = _states(lines, "_closed", "_opened", here).drop("_closed", "_opened")
    for start in (0, 1):
        lines = lines.withColumn(f"before{start}", F.coalesce(F.lag(f"after{start}").over(here), F.lit(start)))
    number = {f"n{s}": F.sum(1 - F.col(f"before{s}")).over(here) for s in (0, 1)}
    return lines.withColumns(number)


def _splits(lines: DataFrame, charset: str | None) -> DataFrame:
    """One row a split: whether it begins inside a quoted field, the record that it goes on with, the file's
    charset and the place of its first record that is not empty."""
    ends = lines.groupBy("path", "block").agg(
        F.max_by("after0", "line").alias("closed"),
        F.max_by("after1", "line").alias("opened"),
        F.max("n0").alias("n0"),
        F.max("n1").alias("n1"),
        F.every("utf8").alias("utf8"),
        F.some("bom16").alias("bom16"),
        F.min(F.when(F.col("value") != "", F.col("n0"))).alias("first"),
    )
    along = Window.partitionBy("path").orderBy("block")
    earlier, file = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("path")
    ends = _states(ends, "closed", "opened", along)
    ends = ends.withColumn("start", F.coalesce(F.lag("after0").over(along), F.lit(0)))
    count = F.when(F.col("start") == 0, F.col("n0")).otherwise(F.col("n1"))
    last = F.last(F.when(count > 0, F.struct("block", count.alias("n"))), ignorenulls=True).over(earlier)
    return ends.select(
        "path",
        "block",
        "start",
        last.alias("goes_on"),
        # Before the first line with text no quote can be open, so its number is that for a start outside.
        F.min(F.when(F.col("first").isNotNull(), F.struct("block", F.col("first").alias("n")))).over(file).alias("head_at"),
        (F.lit(charset) if charset else charset_of(F.every("utf8").over(file), F.some("bom16").over(file))).alias("charset"),
    )


def _records(lines: DataFrame, splits: DataFrame, charset: str) -> DataFrame:
    """Text of every record that is not empty, with the split and number where it begins.

    Most lines are a record each and stay where they are; only those of longer records are shuffled.
    """
    begun = lambda name: F.when(F.col("start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    text = F.when(F.col("charset") == "utf-8", F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), charset))
    begins = F.when(begun("n") > 0, F.struct("block", begun("n").alias("n"))).otherwise(F.col("goes_on"))
    placed = lines.join(splits, ["path", "block"])
    alone = (begun("before") == 0) & (begun("after") == 0)
    whole = placed.filter(alone).select("path", begins.alias("at"), "head_at", text.alias("record"))
    part = F.struct("block", "line", text.alias("text"))
    meeting = placed.filter(~alone).groupBy("path", begins.alias("at"), "head_at")
    parts = meeting.agg(F.sort_array(F.collect_list(part)).alias("parts"))
    joined = parts.select("path", "at", "head_at", F.array_join("parts.text", "\n").alias("record"))
    return whole.unionByName(joined).filter(F.col("record") != "")


def _heads(records: DataFrame) -> DataFrame:
    """The first record of every file."""
    first = records.filter(F.col("at") == F.col("head_at"))
    return first.select("path", F.regexp_replace("record", "\\A\ufeff", "").alias("record"))


def _fields(record: Column, width: int) -> Column:
    """The first ``width`` fields of a record, null where it has fewer or leaves them empty."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    return let(F.from_csv(record, schema, OPTIONS), lambda row: F.array(*(row[f"c{i}"] for i in range(width))))


def csv_records(
    text: DataFrame, wanted: dict[str, list[str]], required: str, charset: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Columns ``wanted`` of the CSV files that ``text`` reads as lines, and the paths of files that are left out.

    ``wanted`` gives the header names, best first, of each column; one that a file lacks is null, but for the
    ``required`` one. Returned are ``path``, ``ord``, which rises with the records of a file, and the columns. Headers
    and charsets may differ from file to file, unless ``charset`` names the one of all; files in UTF-16, where a line
    break is no single byte, are left out and named in the second table. A quoted field that is never closed runs to
    the end of its file, as in any CSV reader, and that record is one value in one task. Line breaks inside
    quotes come out as line feeds, empty fields as null, empty records not at all.

    The lines are stored once; after that a split or a file is one narrow row.
    """
    lines = stored(_numbered(file_lines(text)), "lines")
    splits = stored(_splits(lines, charset and charset.lower()), "splits")
    left_out = splits.filter("charset = 'utf-16'").select("path").distinct()
    records = _records(lines, splits.filter("charset <> 'utf-16'"), charset or "GBK")
    heads = stored(_heads(records), "heads")
    commas = F.length("record") - F.length(F.replace("record", F.lit(","), F.lit("")))
    width = heads.agg(F.coalesce(F.max(commas), F.lit(0)) + 1).first()[0]

    def place(names: list[str]) -> Column:
        places = (F.nullif(F.array_position("head", F.lit(n)), F.lit(0).cast("bigint")) for n in names)
        return (F.coalesce(*places) - 1).cast("int")

    heads = heads.select("path", F.transform(_fields(F.col("record"), width), F.lower).alias("head"))
    heads = heads.select("*", *(place(names).alias(f"_{c}") for c, names in wanted.items()))
    lacking = heads.filter(F.col(f"_{required}").isNull()).select("path", "head").first()
    if lacking:
        raise ValueError(f"no {' or '.join(wanted[required])} among {lacking.head} in {lacking.path}")
    rows = records.join(heads.drop("head"), "path").filter(F.col("at") != F.col("head_at"))
    order = (F.col("at.block") + F.col("at.n")).alias("ord")
    rows = rows.select("path", order, _fields(F.col("record"), width).alias("_row"), *(f"_{c}" for c in wanted))
    return rows.select("path", "ord", *(F.get("_row", F.col(f"_{c}")).alias(c) for c in wanted)), left_out
