"""Text columns: trimming, ordered keyword rules, name tokens."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed


def strip(text: Column) -> Column:
    """Trim every kind of white space; Spark's trim() takes spaces only."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def mentions(text: Column, words: list[str], word_boundary: bool = False) -> Column:
    """True where the lower-cased text holds any of the words, as a substring or as a whole word."""
    lowered = F.lower(text)
    if word_boundary:
        pattern = "|".join(re.escape(w.strip().lower()) for w in words)
        return lowered.rlike(rf"\b(?:{pattern})\b")
    return reduce(lambda a, b: a | b, [lowered.contains(w.lower()) for w in words])


def first_rule(text: Column, rules: list[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first (condition, value) pair that holds, in list order."""
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, value)
    return chain.otherwise(default) if rules else default


def category_of(name: Column, rules=None, default=fixed.DEFAULT_CATEGORY,
                word_boundary: bool = False) -> tuple[Column, Column]:
    """(category, subcategory) by ordered keyword rules over the product name."""
    rules = fixed.CATEGORY_RULES if rules is None else rules
    hits = [(mentions(name, words, word_boundary), cat, sub) for cat, sub, words in rules]
    category = first_rule(name, [(h, F.lit(c)) for h, c, _ in hits], F.lit(default[0]))
    subcategory = first_rule(name, [(h, F.lit(s)) for h, _, s in hits], F.lit(default[1]))
    return category, subcategory


def brand_of(name: Column, lexicon=None, default: str = fixed.HOUSE_BRAND) -> Column:
    """First brand of the lexicon, in lexicon order, found anywhere in the name."""
    lexicon = fixed.BRAND_LEXICON if lexicon is None else lexicon
    return first_rule(name, [(mentions(name, [b]), F.lit(b)) for b in lexicon], F.lit(default))


def audience_of(name: Column) -> Column:
    """Audience named by the first word (case matters), else the default."""
    first = F.substring_index(name, " ", 1)
    rules = [(first == alias, F.lit(target)) for alias, target in fixed.AUDIENCE_ALIASES.items()]
    rules.append((first.isin(fixed.AUDIENCES), first))
    return first_rule(first, rules, F.lit(fixed.DEFAULT_AUDIENCE))


def color_options(raw: Column) -> Column:
    """Every quoted token, trimmed and pipe-joined; null where there is none."""
    tokens = F.regexp_extract_all(raw, F.lit("'([^']+)'"), 1)
    return F.when(F.size(tokens) > 0, F.array_join(F.transform(tokens, strip), "|"))
