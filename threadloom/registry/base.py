"""Registration, table access and the stand-in page table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.links import host
from threadloom.profiles import ARTICLES
from threadloom.session import configure
from threadloom.sources.readers import read_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-02-01 00:00:00"
KEYWORDS = ["the", "tion", "über", "q[eu]"]
KEYWORD_SQL = "(?:the|tion|über|q[eu])"
ORIGIN = r"^(https?://[^/?#]+)"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows of the given tables, which are single files of one split, over all cores."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows cost CPU time, over all cores even when it is one small file."""
    return spread(table(spark, sf_dir, name))


def page_table(spark: SparkSession, sf_dir: str, site: str = ARTICLES.site) -> DataFrame:
    """The raw pages as fetched pages: the host is the forum, the page id the page number."""
    return spread(read_pages(spark, f"{sf_dir}/pages.parquet")).select(
        F.lit(site).alias("site"),
        F.concat(F.lit("https://"), host(F.col("url")), F.lit("/")).alias("seed_url"),
        F.col("page_id").alias("page_no"),
        "url",
        "html",
    )


def seed_table(pages: DataFrame) -> DataFrame:
    """One seed forum per host, named by the host; every other one lacks a description."""
    return (
        pages.select("site", F.col("seed_url").alias("url"))
        .distinct()
        .select(
            "site",
            F.lit(0).cast("bigint").alias("ord"),
            F.regexp_extract("url", "^https://(.*)/$", 1).alias("name"),
            "url",
            F.when(F.length("url") % 2 == 0, F.concat(F.lit("Pages of "), "url")).alias("description"),
        )
    )


def origin():
    return F.regexp_extract("url", ORIGIN, 1)


# ---- SQL pieces shared by the oracles (RE2 patterns, whole tables) ----

HOST_SQL = r"regexp_extract(url, '^https?://([^/?#:]+)', 1)"
ORIGIN_SQL = r"regexp_extract(url, '^(https?://[^/?#]+)', 1)"
SPACES_SQL = r"concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(160), chr(12288))"


def decoded(x: str) -> str:
    """The references that occur in the test pages, the ampersand last."""
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def stripped(x: str) -> str:
    return f"trim({x}, {SPACES_SQL})"


MARKUP_SQL = (
    r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[/!?a-zA-Z][^>]*>"
)


def bare_decoded(x: str) -> str:
    """As ``decoded``, for cleaned text, where a reference may also end without a semicolon."""
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        x = rf"regexp_replace({x}, '&{name}(?:;|\b)', '{char}', 'g')"
    return x


def inline(x: str) -> str:
    text = f"regexp_replace({x}, '{MARKUP_SQL}', ' ', 'g')"
    return rf"trim(regexp_replace({bare_decoded(text)}, '\s+', ' ', 'g'))"


def first_pages(n: int) -> str:
    """The first pages of every host."""
    rank = f"row_number() OVER (PARTITION BY {HOST_SQL} ORDER BY page_id)"
    return f"(SELECT * FROM pages QUALIFY {rank} <= {n})"


def absolute(href: str, base: str) -> str:
    return f"""CASE WHEN {href} = '' THEN NULL
        WHEN regexp_matches({href}, '^https?://') THEN {href}
        WHEN {href} LIKE '//%' THEN 'https:' || {href}
        ELSE {base} || '/' || ltrim({href}, '/') END"""


def unnested(array: str, extra: str = "", source: str = "pages") -> str:
    """One row (page_no, item_no, x, ...) per element of a page's array."""
    return f"""SELECT page_no, CAST(i AS INTEGER) AS item_no, xs[i] AS x {", " + extra if extra else ""}
        FROM (SELECT page_id AS page_no, *, {array} AS xs FROM {source}),
             unnest(range(1, len(xs) + 1)) AS t(i)"""


NAV_SQL = r"""regexp_extract_all(html, '(<li><a href="[^"]*">[^<]*</a></li>)', 1)"""
# All paragraphs, closed or not: what stands behind each start tag, up to the first tag that ends one.
PARAGRAPHS_SQL = """list_transform(string_split(html, '<p>')[2:],
    lambda x: regexp_extract(x, '(?s)^(.*?)(?:</p>|</article>|$)', 1))"""
