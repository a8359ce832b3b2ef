import re

import pytest
from edges import edge_docs, empty_docs
from pyspark.sql import functions as F

from threadloom.llm import secret_scan as S
from threadloom.llm.trigrams import trigram_query

KEY = "AKIA" + "Z9" * 8
TEXTS = [
    f"password = 'hunter2hunter2' and {KEY} end",
    "secret=token:abcdefgh",
    "PaSsWd:short1 Api_Key=\"abc.def/ghi\" APIKEY=x",
    "é漢😀 token: " + "f0" * 12,
    "AKIA" + "Z" * 15 + " " + "0" * 23,
    "token token=token=token=abcdef",
    "ghp_" + "a1" * 18 + " xoxb-1234567890 -----BEGIN RSA PRIVATE KEY-----",
    " ".join(f"secret={i:08d}" for i in range(700)),
]


def plain(text):
    found = []
    for rank, rule in enumerate(S.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), rank, m.end(), rule.kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def test_equals_plain_matching(spark):
    docs = edge_docs(spark, [(i, t, None, 0) for i, t in enumerate(TEXTS)] + [(9, None, None, 0), (9, "", "", 0)])
    rows = S.scan(docs.union(edge_docs(spark))).collect()
    assert len(rows) == len(TEXTS) + 2 + edge_docs(spark).count()
    for r in rows:
        assert [tuple(s) for s in r.spans] == plain(r.text or ""), r.text
        assert r.key == "old" and r.matches == "old"
    assert sum(len(r.spans) for r in rows) > 700


def test_native_plan(spark):
    plan = S.scan(edge_docs(spark).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("toArrow", "")


def test_empty_table_and_no_indexed_rule(spark):
    assert S.scan(empty_docs(spark)).count() == 0
    rows = S.scan(edge_docs(spark, [(1, "f" * 30, "", 0)]), [S.BASE[2]]).collect()
    assert [tuple(s) for s in rows[0].spans] == [("hex", 0, 30)]


def test_redaction(spark):
    docs = S.scan(edge_docs(spark, [(1, f"a {KEY} b token={'0f' * 12}", "", 0), (2, None, "", 0), (3, "clean", "", 0)]))
    made = {r.doc_id: r.text for r in S.redact(docs).collect()}
    assert made == {1: "a [secret] b [secret]", 2: None, 3: "clean"}


@pytest.mark.parametrize(
    "pattern, query",
    [
        ("abcd", [{"abc", "bcd"}]),
        ("ab?cd", [{"abc", "bcd"}, {"acd"}]),
        ("(foo|bar)x+", [{"foo"}, {"bar"}]),
        ("[0-9]+abc", [{"abc"}]),
        ("[0-9a-f]{24,}", None),
        ("ab", None),
        ("(?:abc)*", None),
        ("[Aa][Bb][Cc]", [{"abc"}]),
    ],
)
def test_trigram_queries(pattern, query):
    found = trigram_query(pattern)
    assert (found and sorted(map(set, found), key=sorted)) == (query and sorted(query, key=sorted))


def test_queries_hold_in_every_match(spark):
    for rule in S.RULES:
        query = trigram_query(rule.pattern)
        for m in (m for t in TEXTS for m in re.finditer(rule.pattern, t)):
            low = m.group(0).lower()
            assert query is None or any(all(g in low for g in term) for term in query)
    assert spark.range(1).select(F.lit(1)).count() == 1
