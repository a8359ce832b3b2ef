"""Column layout of the tables that pass between jobs."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols])


_STR, _INT, _LONG, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()

# One forum to collect from, as the seed file lists it.
SEED_FILE = _schema(("name", _STR), ("url", _STR), ("description", _STR))
SEEDS = _schema(
    ("site", _STR), ("ord", _LONG), ("name", _STR), ("url", _STR), ("description", _STR)
)

KEYWORDS = _schema(("site", _STR), ("ord", _LONG), ("keyword", _STR))

# A fetched page. seed_url is the forum (listing run) or the thread link (content run); fetched_at
# is "now" for the dates it shows.
PAGES = _schema(
    ("site", _STR),
    ("seed_url", _STR),
    ("page_no", _LONG),
    ("url", _STR),
    ("html", _STR),
    ("fetched_at", _TS),
)

THREADS = _schema(
    ("site", _STR),
    ("thread_title", _STR),
    ("thread_link", _STR),
    ("thread_date", _STR),
    ("thread_ts", _TS),
    ("forum_name", _STR),
    ("forum_url", _STR),
    ("page_no", _LONG),
    ("item_no", _INT),
)

WORKLIST = _schema(("thread_title", _STR), ("thread_link", _STR), ("thread_date", _STR))

POSTS = _schema(
    ("site", _STR),
    ("author_id", _STR),
    ("date", _STR),
    ("position", _STR),
    ("text", _STR),
    ("thread_title", _STR),
    ("thread_link", _STR),
    ("page_no", _LONG),
    ("item_no", _INT),
)

FORUM_STATS = _schema(
    ("site", _STR), ("forum_name", _STR), ("pages", _LONG), ("crawled", _LONG), ("yielded", _LONG)
)

# Header names found in work-list files, and the one naming used here.
WORKLIST_NAMES = {
    "post_title": "thread_title",
    "post_link": "thread_link",
    "post_date": "thread_date",
}

# Left in an output folder by Spark's committer when all of its files are in place.
COMMIT_MARK = "_SUCCESS"
