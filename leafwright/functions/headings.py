"""Section types from @sec-type and titles, as plain Python for the parser and as a column for tables."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafwright.functions.vocabulary import NOTES_TYPES, SEC_TYPES, TITLE_NUMBER, title_patterns

_COMPILED = [(re.compile(p), kind, strong) for p, kind, strong in title_patterns()]
_NUMBER = re.compile(TITLE_NUMBER)


@lru_cache(maxsize=4096)
def section_type(title: str | None, sec_type: str | None, level: int, parent: str | None) -> str:
    """@sec-type first, then the title's first rule, then the parent's type below level 1."""
    if sec_type and (known := SEC_TYPES.get(sec_type.strip().lower())):
        return known
    below = level > 1 and parent is not None
    if title:
        bare = _NUMBER.sub("", title).strip()
        for pattern, kind, strong in _COMPILED:
            if (strong or not below) and pattern.search(bare):
                return kind
    return parent if below and parent else "other"


def notes_type(value: str | None) -> str | None:
    return NOTES_TYPES.get(value.strip().lower()) if value else None


def _mapped(value: Column, pairs: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.try_element_at(table, F.lower(F.trim(value)))


def section_type_column(title: Column, sec_type: Column | None = None, level: Column | None = None, parent: Column | None = None) -> Column:
    """The same decision as one native expression."""
    none = F.lit(None).cast("string")
    level, parent = F.lit(1) if level is None else level, none if parent is None else parent
    below = (level > 1) & parent.isNotNull()
    bare = F.trim(F.regexp_replace(title, TITLE_NUMBER, ""))
    rules = F.when(F.lit(False), none)
    for pattern, kind, strong in title_patterns():
        hit = bare.rlike(pattern)
        rules = rules.when(hit if strong else hit & ~below, F.lit(kind))
    known = none if sec_type is None else _mapped(sec_type, SEC_TYPES)
    return F.coalesce(known, rules, F.when(below, parent), F.lit("other"))


def notes_type_column(value: Column) -> Column:
    return _mapped(value, NOTES_TYPES)
