"""Text as words: the small vocabulary of column helpers that the parsers are written in."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts a text where labels were marked; no printed line holds it.
MARK = "\u0001"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapsed(text: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def blank_as_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def edges_off(text: Column, characters: str) -> Column:
    """Without any of the characters at either end."""
    klass = "".join("\\" + c if c in r"-\]^[" else c for c in characters)
    return F.regexp_replace(text, rf"^[{klass}]+|[{klass}]+$", "")


def literal(value: str | int) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def lookup(table: dict, key: Column) -> Column:
    """The table as one constant: a lookup, and no join."""
    return F.try_element_at(F.expr(f"map({', '.join(literal(x) for x in chain.from_iterable(table.items()))})"), key)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value worked out once however often `then` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(collapsed(text), " "), lambda w: w != "")


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters, digits and slashes."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}/]+"), lambda w: w != "")


def places(items: Column) -> Column:
    """0, 1, ... for each element."""
    return F.slice(F.sequence(F.lit(0), F.size(items)), F.lit(1), F.size(items))


def joined(items: Column, start: Column | int, count: Column | int) -> Column:
    """`count` elements from place `start`, spaced; none for a count below one, NULL for a NULL one."""
    count = F.lit(count) if isinstance(count, int) else count
    start = F.lit(start) if isinstance(start, int) else start
    return F.when(count.isNotNull(), F.array_join(F.slice(items, start + 1, F.greatest(count, F.lit(0))), " "))


def from_place(items: Column, start: Column | int) -> Column:
    return joined(items, start, F.size(items))


def first_where(items: Column, test: Callable[[Column], Column]) -> Column:
    """The first place for which test(place) holds, or NULL."""
    return F.get(F.filter(places(items), test), F.lit(0))


def among(values) -> Callable[[Column], Column]:
    """A test for membership that takes NULL as no member."""
    return lambda x: F.coalesce(x.isin(*values), F.lit(False))


def spaced(text: Column) -> Column:
    """Words of a text between single spaces, with one at either end: ' a b ' holds ' a '."""
    return F.concat(F.lit(" "), F.array_join(plain_words(text), " "), F.lit(" "))


def labelled(text: Column, *labels: str, colon: str = r"\s*:?") -> Column:
    """Struct (label, body) for each stretch of text that one of the labels begins; the first has label ''."""
    marked = F.regexp_replace(text, rf"(?i)\b({'|'.join(labels)})\b{colon}", f"{MARK}$1{MARK}")
    pairs = lambda parts: F.sequence(F.lit(0), F.size(parts) - 1, F.lit(2))
    return let(F.concat(F.array(F.lit("")), F.split(marked, MARK)), lambda parts: F.transform(pairs(parts), lambda i: F.struct(F.lower(F.get(parts, i)).alias("label"), collapsed(F.get(parts, i + 1)).alias("body"))))
