"""Regions of an HTML text, found with regular expressions and array functions.

A page is never turned into a tree. ``Tag`` describes a start tag; ``regions`` cuts a text into
the elements such a tag opens, each ended at its own end tag by counting tags of the same name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.binding import let, runs, sums_before
from threadloom.functions.entities import decode_entities

# Elements that have no end tag.
VOID = "area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr"
# Elements without content end a text but open nothing.
_EMPTY = rf"(?i)^<(?:(?:{VOID})[\s>/]|[^>]*/>)"


@dataclass(frozen=True)
class Tag:
    """A start tag: element name, class tokens it must carry, optional id."""

    name: str
    classes: tuple[str, ...] = ()
    id: str | None = None

    @property
    def pattern(self) -> str:
        tokens = "".join(
            rf"""(?=[^>]*\sclass\s*=\s*["'](?:[^"'>]*\s)?{re.escape(cls)}[\s"'])"""
            for cls in self.classes
        )
        ident = rf"""(?=[^>]*\sid\s*=\s*["']?{re.escape(self.id)}["'\s>])""" if self.id else ""
        return rf"<(?i:{self.name})(?=[\s>/]){tokens}{ident}[^>]*>"


@dataclass(frozen=True)
class OwnText:
    """Text nodes that are children of the last tag of ``path``, wherever other elements stand before them."""

    path: tuple[Tag, ...]
    strict: bool = False


def text_in(*path: Tag, strict: bool = False) -> OwnText:
    """Text nodes that are children of the last tag of ``path``.

    With ``strict`` each step must come before the end tag of the step above it.
    """
    return OwnText(path, strict)


def attr_in(attr: str, *path: Tag, strict: bool = False) -> str:
    """Pattern of an attribute value of the last tag of ``path``."""
    steps = _steps(path, strict)
    return steps.removesuffix("[^>]*>") + rf"""[^>]*?\s{re.escape(attr)}\s*=\s*["']([^"'>]*)["']"""


def _steps(path: tuple[Tag, ...], strict: bool) -> str:
    out = "(?s)" + path[0].pattern
    for above, tag in zip(path, path[1:]):
        out += (rf"(?:(?!</{above.name}[\s>]).)*?" if strict else ".*?") + tag.pattern
    return out


def firsts(c: Column, *fields: str | OwnText | None) -> Column:
    """First match of each one-group pattern or text node, with entities decoded, as an array.

    A field that is absent, or finds nothing or an empty text, gives null.
    """
    found = [_first_text(c, f) if isinstance(f, OwnText) else F.regexp_extract(c, f, 1) if f else F.lit("") for f in fields]
    return F.transform(F.array(*found), lambda x: F.when(x != "", decode_entities(x)))


def first(c: Column, field: str | OwnText) -> Column:
    return F.element_at(firsts(c, field), 1)


def every(c: Column, field: str | OwnText) -> Column:
    """All matches of a one-group pattern, or all text nodes, in document order, entities decoded."""
    found = _own_texts(c, field) if isinstance(field, OwnText) else F.regexp_extract_all(c, F.lit(field), F.lit(1))
    return F.transform(found, lambda x: decode_entities(x))


def _first_text(c: Column, field: OwnText) -> Column:
    """The first of ``_own_texts``; without a fold where it follows the first start tag at once."""
    at_once = F.regexp_extract(c, rf"(?s)^(?>.*?{_steps(field.path, field.strict)[4:]})([^<]*)(?=</?[a-zA-Z]|$)", 1)
    return let(at_once, lambda x: F.when(x != "", x).otherwise(F.try_element_at(_own_texts(c, field, 1), F.lit(1))))


def _own_texts(c: Column, field: OwnText, most: int | None = None) -> Column:
    """Text nodes that are children of elements ``field`` names, in document order, at most ``most``.

    One fold over the tags with the elements open inside such an element, the innermost first. An end
    tag closes the innermost element of its name and all inside it; one without such an element is passed over.
    Tags are folded in runs, so that texts are added to the short list of a run only.
    """
    *above, last = field.path
    none = F.array().cast("array<struct<name:string,own:boolean>>")

    def state(inside: list[Column], opened: Column, out: Column) -> Column:
        return F.struct(*(x.alias(f"in{i}") for i, x in enumerate(inside)), opened.alias("opened"), out.alias("out"))

    def step(acc: Column, tok: Column) -> Column:
        ends = tok.startswith("</")
        inside, on = [], F.lit(True)
        for i, tag in enumerate(above):
            was = acc[f"in{i}"]
            left = tok.rlike(rf"^</{tag.name}[\s>]") if field.strict else F.lit(False)
            inside.append(F.when(left, False).otherwise(was | (on & tok.rlike("^" + tag.pattern))))
            on = was
        own = on & tok.rlike("^" + last.pattern)

        def after(name: Column) -> Column:
            at = F.array_position(F.transform(acc["opened"], lambda x: x["name"]), name)
            closed = F.when(at > 0, F.slice(acc["opened"], at.cast("int") + 1, F.lit(1 << 30))).otherwise(acc["opened"])
            begun = F.concat(F.array(F.struct(name.alias("name"), own.alias("own"))), acc["opened"])
            return (
                F.when(ends, closed)
                .when(tok.rlike(_EMPTY) | ((F.size(acc["opened"]) == 0) & ~own), acc["opened"])
                .otherwise(begun)
            )

        def moved(opened: Column) -> Column:
            text = F.substring(tok, F.instr(tok, ">") + 1, F.length(tok))
            hit = F.coalesce(F.try_element_at(opened, F.lit(1))["own"], F.lit(False)) & (text != "")
            return state(inside, opened, F.when(hit, F.array_append(acc["out"], text)).otherwise(acc["out"]))

        name = F.lower(F.regexp_extract(tok, r"^</?([^\s>/]+)", 1))
        # Outside of such elements end tags matter to ``inside`` only.
        made = F.when(ends & (F.size(acc["opened"]) == 0), state(inside, acc["opened"], acc["out"])).otherwise(
            let(let(name, after), moved)
        )
        return F.when(F.size(acc["out"]) >= most, acc).otherwise(made) if most else made

    empty = F.array().cast("array<string>")
    begin = state([F.lit(False) for _ in above], none, empty)
    tokens = _cut(without_hidden(c), "</?[a-zA-Z]")
    if most:
        return F.aggregate(tokens, begin, step, lambda acc: acc["out"])

    def run(acc: Column, part: Column) -> Column:
        was = acc["now"]
        fresh = state([was[f"in{i}"] for i in range(len(above))], was["opened"], empty)
        return F.struct(F.aggregate(part, fresh, step).alias("now"), _with_run(acc).alias("all"))

    whole = F.struct(begin.alias("now"), F.array().cast("array<array<string>>").alias("all"))
    return F.flatten(F.aggregate(runs(tokens, _RUN), whole, run, _with_run))


def _with_run(acc: Column) -> Column:
    """What all runs before found, and the last one. A ``let`` here would copy it all for each run."""
    return F.array_append(acc["all"], acc["now"]["out"])


# Tags folded at once: their finds are copied with each find, and the finds of all runs with each run.
_RUN = 1024

# Stands in front of each tag of interest while a text is cut, and is taken out of the text
# before. It is no character of any text, and a one-character separator spares ``split`` a
# look-ahead at every position.
_CUT = "\uffff"


def _cut(text: Column, pattern: str) -> Column:
    """The text in pieces that begin where ``pattern`` matches; what comes before the first match is dropped."""
    clean = F.translate(text, _CUT, "")
    return F.slice(F.split(F.regexp_replace(clean, pattern, _CUT + "$0"), _CUT, -1), 2, 1 << 30)


# Elements whose end tag may be left out, and the elements that end them.
_LISTS = {"li": "ul|ol"}


def _found(tokens: Column, tag: Tag) -> Column:
    """(first, last, closed) of the outermost elements that ``tag`` opens, as places in ``tokens``.

    One pass with a depth: that of elements of the same name inside an open one, or of lists
    inside an open list item, which also ends where the next item or the end of its list comes.
    Tags are folded in runs, so that places are added to the short list of a run only.
    """
    lists = _LISTS.get(tag.name)

    def spot(first: Column, last: Column, closed: bool) -> Column:
        return F.array(F.struct(first.alias("first"), last.alias("last"), F.lit(closed).alias("closed")))

    def state(at: Column, first: Column, depth: Column, out: Column) -> Column:
        return F.struct(at.alias("at"), first.alias("first"), depth.alias("depth"), out.alias("out"))

    def step(acc: Column, tok: Column) -> Column:
        at, first, depth, out = acc["at"] + 1, acc["first"], acc["depth"], acc["out"]
        ends, none = tok.startswith("</"), F.lit(0)
        opened = F.when(tok.rlike("^" + tag.pattern), at).otherwise(none)
        idle = state(at, opened, F.when(opened > 0, 1).otherwise(0), out)
        done = F.concat(out, spot(first, at, True))
        same = state(at, first, depth + F.when(ends, -1).otherwise(1), out)
        if not lists:
            inside = F.when(ends & (depth == 1), state(at, none, none, done)).otherwise(same)
            return F.when(first == 0, idle).otherwise(inside)
        item = tok.rlike(rf"^</?(?i:{tag.name})(?=[\s>/])")
        cut = F.concat(out, spot(first, at - 1, False))
        inside = (
            F.when(item & (depth > 1), state(at, first, depth, out))
            .when(item & ends, state(at, none, none, done))
            .when(item, state(at, opened, F.when(opened > 0, 1).otherwise(0), cut))
            .when(ends & (depth == 1), state(at, none, none, cut))
            .otherwise(same)
        )
        return F.when(first == 0, idle).otherwise(inside)

    places = F.array().cast(_PLACES)

    def run(acc: Column, part: Column) -> Column:
        was = acc["now"]
        now = F.aggregate(part, state(was["at"], was["first"], was["depth"], places), step)
        return F.struct(now.alias("now"), _with_run(acc).alias("all"))

    def finish(acc: Column) -> Column:
        # An element that is never closed runs to the end.
        now = acc["now"]
        rest = F.when(now["first"] > 0, spot(now["first"], now["at"], False)).otherwise(places)
        return F.concat(F.flatten(_with_run(acc)), rest)

    zero = state(F.lit(0), F.lit(0), F.lit(0), places)
    begin = F.struct(zero.alias("now"), F.array().cast(f"array<{_PLACES}>").alias("all"))
    return F.aggregate(runs(tokens, _RUN), begin, run, finish)


_PLACES = "array<struct<first:int,last:int,closed:boolean>>"


def without_hidden(html: Column) -> Column:
    """A page without comments and scripts, where tags mean nothing."""
    return F.regexp_replace(html, r"(?s)<(?:!--.*?--|(?i:script)\b.*?</(?i:script)\s*)>", "")


def regions(c: Column, tag: Tag) -> Column:
    """Outer HTML of every outermost element ``tag`` opens, in document order (array of strings)."""
    names = "|".join(n for n in (tag.name, _LISTS.get(tag.name)) if n)

    def pieces(tokens: Column) -> Column:
        def piece(r: Column) -> Column:
            last = F.element_at(tokens, r["last"])
            end = F.when(r["closed"], F.concat(F.substring_index(last, ">", 1), F.lit(">"))).otherwise(last)
            front = F.array_join(F.slice(tokens, r["first"], r["last"] - r["first"]), "")
            return F.concat(front, end)

        return F.transform(_found(tokens, tag), piece)

    return let(_cut(c, rf"</?(?i:{names})(?=[\s>/])"), pieces)


def nested_regions(c: Column, path: tuple[Tag, ...]) -> Column:
    """Elements of the last tag inside elements of the tags before it."""
    if len(path) == 1:
        return regions(c, path[0])
    outer, inner = path[0], path[1:]
    return F.flatten(F.transform(regions(c, outer), lambda x: nested_regions(x, inner)))


def outer_html(c: Column, tag: Tag) -> Column:
    """The first element ``tag`` opens, with its tags; null when there is none."""
    return F.try_element_at(regions(c, tag), F.lit(1))


def inner_html(c: Column, tag: Tag) -> Column:
    """The first element ``tag`` opens, without its tags; null when there is none."""

    def body(region: Column) -> Column:
        start = F.instr(region, ">") + 1
        end_tag = F.substring_index(region, "</", -1)
        closed = F.length(region) - F.length(end_tag) - 1 - start
        left = F.when(end_tag.rlike(rf"(?i)^{tag.name}\s*>$"), closed).otherwise(F.length(region))
        return F.substring(region, start, left)

    return let(outer_html(c, tag), body)


def direct_texts(region: Column) -> Column:
    """Text nodes that are children of the region's own element, not of elements inside it.

    The region comes out of a page without comments.
    """
    def change(tok: Column) -> Column:
        return F.when(tok.startswith("</"), -1).when(tok.rlike(_EMPTY), 0).otherwise(1)

    def texts(tokens: Column) -> Column:
        def at_top(changes: Column) -> Column:
            return F.zip_with(
                F.zip_with(sums_before(changes), changes, lambda a, b: a + b),
                tokens,
                lambda depth, tok: F.when(depth == 1, F.substring(tok, F.instr(tok, ">") + 1, F.length(tok))),
            )

        return let(F.transform(tokens, change), at_top)

    found = F.filter(let(_cut(region, "</?[a-zA-Z]"), texts), lambda x: x != "")
    return F.transform(found, lambda x: decode_entities(x))


def all_texts(region: Column) -> Column:
    """Text nodes at any depth, in document order, with references decoded."""
    found = F.filter(F.split(region, "<[/!?a-zA-Z][^>]*>", -1), lambda x: x != "")
    return F.transform(found, lambda x: decode_entities(x))
