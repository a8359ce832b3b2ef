"""Secret scans with a trigram inverted index, in built-in column functions only.

Each rule's regular expression gives a Boolean trigram query. The index holds, for the trigrams that
some query names, the texts that hold them; intersecting its postings leaves the candidates of a rule,
and only those are matched against the regular expression. Rules without mandatory trigrams are
matched against every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.arrow import quoted, without
from threadloom.llm.trigrams import trigram_query


def either(word: str) -> str:
    """A pattern for the word in upper, lower or mixed case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose ``group`` has fewer than ``least`` characters are dropped
    after matching, so they still use up their text."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


KEYWORDS = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
BASE = [
    Rule("assign", rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE = [
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE + MORE
SPAN = "array<struct<kind:string,start:int,end:int>>"
#: Positions are summed up in runs of this many matches, so that long lists are not copied for each.
RUN = 256


def postings(docs: DataFrame, key: Column, text: Column, names: list[str]) -> DataFrame:
    """The inverted index: (trigram, key) for each of the trigrams that a text holds in any case."""
    low = F.lower(text)
    held = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(n)), n) for n in names)))
    return docs.select(F.explode(held).alias("trigram"), key.alias("key"))


def candidates(docs: DataFrame, key: Column, text: Column, rules: list[Rule]) -> DataFrame:
    """(key, mask): a bit for each rule whose trigram query the text meets."""
    queries = [(i, q) for i, r in enumerate(rules) for q in trigram_query(r.pattern) or []]
    rows = [
        (trigram, term, 1 << bit, (1 << len(query)) - 1, 1 << rule)
        for term, (rule, query) in enumerate(queries)
        for bit, trigram in enumerate(sorted(query))
    ]
    names = sorted({r[0] for r in rows})
    if not rows:
        return docs.select(key.alias("key"), F.lit(0).cast("long").alias("mask")).limit(0)
    fields = ("trigram", "term", "bit", "need", "rule")
    terms = docs.sparkSession.range(1).select(
        F.inline(F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(fields, r))) for r in rows)))
    )
    # As many rows as the rules have trigrams, whatever the input.
    met = (
        postings(docs, key, text, names)
        .join(F.broadcast(terms), "trigram")
        .groupBy("key", "term", "need", "rule")
        .agg(F.bit_or("bit").alias("got"))
        .filter("got = need")
    )
    return met.groupBy("key").agg(F.bit_or(F.col("rule").cast("long")).alias("mask"))


def _running(sizes: Column) -> Column:
    """Sums before each element, as an array."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(
        sizes, start, lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["all"], a["at"]).alias("all"))
    )["all"]


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of the leftmost non-overlapping matches of one rule, in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.least else found
    steps = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("size")))
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / RUN).cast("int")),
        lambda i: F.slice(steps, i * RUN + 1, F.lit(RUN)),
    )
    length = lambda run: F.aggregate(run, F.lit(0), lambda a, s: a + s["gap"] + s["size"])
    placed = F.zip_with(
        runs,
        _running(F.transform(runs, length)),
        lambda run, base: F.zip_with(
            run,
            _running(F.transform(run, lambda s: s["gap"] + s["size"])),
            lambda s, at: F.struct(
                F.lit(rule.kind).alias("kind"),
                (base + at + s["gap"]).alias("start"),
                (base + at + s["gap"] + s["size"]).alias("end"),
            ),
        ),
    )
    spans = F.slice(F.flatten(placed), 1, F.size(found))
    if rule.least:
        pairs = F.zip_with(spans, tested, lambda s, g: F.struct(s.alias("s"), g.alias("g")))
        spans = F.transform(F.filter(pairs, lambda p: F.length(p["g"]) >= rule.least), lambda p: p["s"])
    return F.when(F.rlike(text, pattern), spans).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with the secrets of each whole text in ``out``, by start and then by rule.

    Null and empty texts have no secrets; spans of different rules may overlap; a repeated row gets
    the same spans again. A column named ``out`` is replaced, other columns stay. The index knows a row
    by a hash of its numbers and texts, so copies of one text are spread out; rows of the same hash only
    share candidates, and those are verified.
    """
    keep = without(docs, [out])
    whole = F.coalesce(F.col(quoted(text)), F.lit(""))
    plain = [F.col(quoted(f.name)) for f in docs.schema if f.dataType.typeName() in ("long", "integer", "string")]
    key = F.xxhash64(*plain)
    # The build side has a hash and a mask for each row, far less than the text beside it.
    marked = docs.select(*(F.col(quoted(c)) for c in keep), key.alias("__key")).join(
        candidates(docs, key, whole, rules).withColumnsRenamed({"key": "__key", "mask": "__mask"}).hint("shuffle_hash"),
        "__key",
        "left",
    )
    mask = F.coalesce(F.col("__mask"), F.lit(0))
    none = F.array().cast(SPAN)
    found = [
        spans_of(whole, r)
        if trigram_query(r.pattern) is None
        else F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, spans_of(whole, r)).otherwise(none)
        for i, r in enumerate(rules)
    ]
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)))
    ranked = F.transform(
        F.concat(*found), lambda s: F.struct(s["start"], order[s["kind"]].alias("rank"), s["end"], s["kind"])
    )
    ordered = F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return marked.select(*(F.col(quoted(c)) for c in keep), ordered.alias(out))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, spans: str = "spans", text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of the text replaced by a mark; overlapping spans share one."""
    whole, found = F.col(quoted(text)), F.col(quoted(spans))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    cut = F.aggregate(
        found,
        start,
        lambda a, s: F.when(
            s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["parts"].alias("parts"))
        ).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["parts"], F.array(whole.substr(a["at"] + 1, s["start"] - a["at"]), F.lit(mark))
                ).alias("parts"),
            )
        ),
    )
    rest = whole.substr(cut["at"] + 1, F.length(whole))
    clean = F.when(F.size(found) > 0, F.concat(F.array_join(cut["parts"], ""), rest)).otherwise(whole)
    return docs.select(
        *(clean.alias(c) if c.lower() == text.lower() else F.col(quoted(c)) for c in docs.columns)
    )


# ---- SQL ----

def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(rules: list[Rule] = RULES) -> str:
    """DuckDB SQL for the query's rows."""
    parts = []
    for i, r in enumerate(rules):
        p = _sql(r.pattern)
        parts.append(
            f"""SELECT doc_id, {i} AS rank, '{r.kind}' AS kind, tested[i] AS tested, {r.least} AS least,
            CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start, length(found[i]) AS size
            FROM (SELECT doc_id, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}, 0) AS found,
              regexp_extract_all(text, {p}, {r.group}) AS tested FROM docs WHERE regexp_matches(text, {p})),
              unnest(range(1, len(found) + 1)) AS t(i)"""
        )
    names = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    spans AS (SELECT *, kind || ':' || start || ':' || (start + size) AS label
      FROM ({" UNION ALL ".join(parts)}) WHERE length(tested) >= least),
    lists AS (SELECT doc_id, {counts},
        coalesce(string_agg(label, ',' ORDER BY start, rank) FILTER (kind IN ({names})), '') AS base,
        string_agg(label, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN lists USING (doc_id)"""
