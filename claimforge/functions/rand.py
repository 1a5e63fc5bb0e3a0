"""Randomness from keys: every draw is an md5 of what it is for, so results don't depend on partitioning.

md5 is used, not a faster hash, because every SQL engine has it: a plain SQL query can draw the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key(*parts: Column | str | int) -> Column:
    """md5 of the parts, joined by ``|``; strings are literals."""
    return F.md5(joined(*parts))


def joined(*parts: Column | str | int) -> Column:
    return F.concat_ws("|", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))


def uniform(*parts: Column | str | int) -> Column:
    """A double in [0, 1)."""
    return F.conv(F.substring(key(*parts), 1, 13), 16, 10).cast("double") / float(16**13)


def integer(low: Column | int, high: Column | int, *parts: Column | str | int) -> Column:
    """An int between ``low`` and ``high``, both included; ``low`` where the range is empty."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return (low + F.floor(uniform(*parts) * F.greatest(high - low + 1, F.lit(1)))).cast("int")


def shuffled(items: Column, *parts: Column | str | int) -> Column:
    """The array in a random order. Equal items keep their places' own draws."""
    return sample(items, None, *parts)


def places(size: Column, *parts: Column | str | int) -> Column:
    """0 ... size - 1 in a random order, each as text behind its key of 32 letters: what is sorted stays small, whatever the items are."""
    # what all keys begin with is joined once, not for each item
    keyed = lambda p: F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.concat(F.md5(F.concat(p, i.cast("string"))), i.cast("string")))
    begin = F.concat(joined(*parts), F.lit("|"))
    sorted_keys = F.sort_array(F.get(F.transform(F.array(begin), keyed), F.lit(0)))
    return F.when(size > 0, sorted_keys).when(size == 0, F.array().cast("array<string>"))


def at_places(items: Column, keys: Column) -> Column:
    """The items at places()."""
    return F.transform(keys, lambda s: F.get(items, F.substring(s, 33, 10).cast("int")))


def sample(items: Column, n: Column | int, *parts: Column | str | int) -> Column:
    """``n`` items without replacement, all where there are fewer."""
    first = (lambda keys: keys) if n is None else (lambda keys: F.slice(keys, 1, F.greatest(n if isinstance(n, Column) else F.lit(n), F.lit(0))))
    drawn = lambda v: at_places(v, first(places(F.size(v), *parts)))
    return F.get(F.transform(F.array(items), drawn), F.lit(0))


def pick(items: Column, *parts: Column | str | int) -> Column:
    """One item, or null of an empty array."""
    return F.get(items, integer(0, F.size(items) - 1, *parts))


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strings(values) -> Column:
    """A literal array of strings; one expression to parse, where a call for each value would be slow to build."""
    return F.expr(f"cast(array({', '.join(map(quoted, values))}) as array<string>)")


def table(entries: dict) -> Column:
    """A literal map from strings to strings or arrays of strings."""
    value = lambda v: quoted(v) if isinstance(v, str) else f"cast(array({', '.join(map(quoted, v))}) as array<string>)"
    return F.expr(f"map({', '.join(f'{quoted(k)}, {value(v)}' for k, v in entries.items())})")
