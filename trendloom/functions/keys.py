"""Trend keys: one string per (metric, tags), built so that it can be read back.

The key is ``metric,name=value,name=value`` with tags in name order. The three characters that
would make it ambiguous are percent-escaped, so two definitions never share a key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with a meaning inside a key, and what stands for them. '%' goes first.
ESCAPES = (("%", "%25"), (",", "%2C"), ("=", "%3D"), ("\x01", "%01"))


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _escape_literal(text: str) -> str:
    for raw, code in ESCAPES:
        text = text.replace(raw, code)
    return text


def trend_key(metric: Column, tags: Column) -> Column:
    """Key of a point whose tags are a map column."""
    entries = F.sort_array(F.map_entries(tags))
    pairs = F.transform(
        entries, lambda e: F.concat(escape(e["key"]), F.lit("="), escape(F.coalesce(e["value"], F.lit(""))))
    )
    return F.when(metric.isNotNull(), F.concat_ws(",", escape(metric), pairs))


def known_tags_key(metric: Column, tags: Mapping[str, Column | str]) -> Column:
    """Same key when the tag names are known up front: plain string concatenation, inside codegen."""
    parts: list[Column] = [escape(metric)]
    pending = ""
    for name in sorted(tags):
        value = tags[name]
        pending += f",{_escape_literal(name)}="
        if isinstance(value, str):
            pending += _escape_literal(value)
        else:
            parts += [F.lit(pending), escape(value)]
            pending = ""
    if pending:
        parts.append(F.lit(pending))
    return F.concat(*parts)


#: Between a key of a point's own and the one that describes it; the second never holds it unescaped.
DESCRIBED_BY = "\x01"


def describing_key(own: Column, metric: Column, tags: Column) -> Column:
    """The own key, with the key of metric and tags appended where that is another one; null without an own key.

    Streams group by it, as they have no place for a dictionary: points of one own key and one description are one trend.
    """
    derived = trend_key(metric, tags)
    return F.when(own == derived, own).when(own.isNotNull(), F.concat(own, F.lit(DESCRIBED_BY), F.coalesce(derived, F.lit(""))))


def description(key: Column) -> Column:
    """The part of a key that describes its trend."""
    return F.substring_index(key, DESCRIBED_BY, -1)


def key_metric(key: Column) -> Column:
    return unescape(F.substring_index(key, ",", 1))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, however often ``use`` names it, also inside functions over arrays."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def key_entries(key: Column) -> Column:
    """The tags of a key as an array of names and values. A key that was not made here may name a tag twice: the first one counts."""

    def entries(pairs: Column, text: Callable[[Column], Column]) -> Column:
        return F.transform(
            pairs, lambda p: F.struct(text(F.substring_index(p, "=", 1)).alias("key"), text(F.substring_index(p, "=", -1)).alias("value"))
        )

    def once(tags: Column, names: Column) -> Column:
        firsts = F.filter(tags, lambda e, i: F.array_position(names, e["key"]) == i + 1)
        return F.when(F.size(F.array_distinct(names)) == F.size(names), tags).otherwise(firsts)

    def of_parts(parts: Column) -> Column:
        pairs = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        # Few keys hold an escaped character.
        return F.when(F.contains(key, F.lit("%")), entries(pairs, unescape)).otherwise(entries(pairs, lambda t: t))

    return _bound(
        _bound(F.split(key, ","), of_parts), lambda tags: _bound(F.transform(tags, lambda e: e["key"]), lambda names: once(tags, names))
    )


def key_tags(key: Column) -> Column:
    """The tag map of a key."""
    return F.map_from_entries(key_entries(key))


def flat_tags(tags: Column) -> Column:
    """Tags as one sorted ``k=v`` text, for comparing and printing."""
    return F.array_join(
        F.transform(F.sort_array(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
    )
