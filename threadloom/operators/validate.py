"""Clean-and-validate: ordered field rules, first failing rule named as the reject reason."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.dates import iso_date_ts, offset_date_ts, utc_text
from threadloom.functions.text import WHITESPACE, clean_block, clean_inline, clean_position, strip

REASON = "reject_reason"


@dataclass(frozen=True)
class Check:
    """One field's rule. ``kind`` is inline, block, plain, date, strict_date or position."""

    field: str
    kind: str
    required: bool = True
    min_length: int = 3

    def cleaned(self, c: Column) -> Column:
        if self.kind == "inline":
            return clean_inline(c)
        if self.kind == "block":
            return clean_block(c)
        if self.kind == "position":
            return clean_position(c)
        return strip(c) if self.kind == "plain" else c

    def instant(self, c: Column, zone: str) -> Column | None:
        if self.kind == "date":
            return iso_date_ts(c, zone)
        return offset_date_ts(c) if self.kind == "strict_date" else None


# Which fields each pipeline checks, in order.
LISTING_RULES = (
    Check("thread_title", "inline"),
    Check("thread_link", "plain"),
    Check("thread_date", "date"),
    Check("forum_name", "plain"),
    Check("forum_url", "plain"),
)
POST_RULES = (
    Check("thread_title", "inline"),
    Check("thread_link", "plain"),
    Check("date", "date"),
    Check("text", "inline"),
    Check("position", "position"),
)
QUOTED_POST_RULES = (
    Check("text", "block", min_length=10),
    Check("position", "position", required=False),
    Check("date", "strict_date", required=False),
)


def is_missing(c: Column) -> Column:
    return c.isNull() | (c == "")


def is_long_enough(c: Column, n: int) -> Column:
    """Not blank and at least ``n`` code points; null counts as too short."""
    return F.coalesce((F.length(c) >= n) & (F.btrim(c, F.lit(WHITESPACE)) != ""), F.lit(False))


def ts_name(field: str) -> str:
    return "date_ts" if field == "date" else field.removesuffix("_date") + "_ts"


def _reason(check: Check, raw: Column, clean: Column, ts: Column | None) -> Column:
    if check.kind in ("inline", "block"):
        valid = is_long_enough(clean, check.min_length)
    elif check.kind == "position":
        valid = F.coalesce(clean != "", F.lit(False))
    elif ts is not None:
        valid = ts.isNotNull()
    else:
        valid = F.lit(True)
    missing = F.lit(f"Missing {check.field}") if check.required else F.lit(None).cast("string")
    return F.when(is_missing(raw), missing).when(~valid, F.lit(f"Invalid {check.field}"))


def clean_validate(df: DataFrame, rules: Iterable[Check], zone: str = "UTC") -> DataFrame:
    """All rows of ``df`` with checked fields cleaned, date instants and ``reject_reason`` added.

    The reason is null for accepted rows. A reason that is there already (from an earlier
    stage) stays. Rejected rows keep their fields as they came in.
    """
    rules = tuple(rules)
    prior = F.col(REASON) if REASON in df.columns else F.lit(None).cast("string")
    values = []
    for check in rules:
        raw = F.col(check.field)
        values.append(check.cleaned(raw).alias(check.field))
        ts = check.instant(raw, zone)
        if ts is not None:
            values.append(ts.alias(ts_name(check.field)))
    # The cleaned values go through a one-element generator. Behind a plain projection Catalyst
    # would copy every cleaning expression into each later filter on the reason.
    work = df.select("*", F.explode_outer(F.array(F.struct(*values))).alias("_clean"))

    reasons, final, instants = [prior], {}, []
    for check in rules:
        raw, clean = F.col(check.field), F.col(f"_clean.{check.field}")
        has_ts = check.kind in ("date", "strict_date")
        ts = F.col(f"_clean.{ts_name(check.field)}") if has_ts else None
        reasons.append(_reason(check, raw, clean, ts))
        if ts is not None:
            clean = utc_text(raw, ts)
            instants.append(ts.alias(ts_name(check.field)))
        final[check.field] = clean
    judged = work.withColumn(REASON, F.coalesce(*reasons))
    accepted = F.col(REASON).isNull()
    columns = [
        F.when(accepted, final[c]).otherwise(F.col(c)).alias(c)
        if c in final
        else F.col(c)
        for c in df.columns
        if c != REASON and c not in {ts_name(r.field) for r in rules}
    ]
    return judged.select(*columns, *instants, REASON)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejects(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())
