"""Text steps as Column functions. All of them run in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from folianta.fixed_values import (
    CLASS_DOMAIN,
    CONTROL_CHARS,
    CONTROL_TOKENS,
    LANGUAGE_PRIORITY,
    META_PREFIXES,
    TOKEN_GAPS,
    UNCLASSIFIED,
    VALUE_SEPARATOR,
    WHITESPACE,
    WORD_CHARS,
)

TextStep = Callable[[Column], Column]

SPACES = f"[{WHITESPACE}]+"
TOKEN = f"[{WORD_CHARS}]+|[^{WORD_CHARS}{TOKEN_GAPS}]+"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used.

    Calls through `reflect` are exempt from Spark's common-subexpression elimination.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def _icu(method: str, text: Column) -> Column:
    # Spark has no SQL function for Unicode normal forms but ships ICU; `reflect` calls it
    # in place, which spares the trip through a Python worker.
    call = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit(method), text, F.lit(False)
    )
    return F.when(text.isNotNull(), call)


def compose(text: Column) -> Column:
    """Unicode NFC."""
    return _icu("compose", text)


def decompose(text: Column) -> Column:
    """Unicode NFD."""
    return _icu("decompose", text)


def collapse_spaces(text: Column) -> Column:
    """Runs of white space become one space; none is left at either end."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL_CHARS, "")


def clean_text(text: Column) -> Column:
    """White space collapsed; null becomes the empty string."""
    return collapse_spaces(F.coalesce(text, F.lit("")))


def text_steps(*steps: TextStep) -> TextStep:
    """One step that applies ``steps`` in the order given."""
    return lambda text: reduce(lambda done, step: step(done), steps, text)


normalize_nfc = text_steps(compose, drop_controls, collapse_spaces)


def drop_marks(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{M}+", "")


def lower_each(text: Column) -> Column:
    """Lower case of each character by itself: a capital sigma at a word's end is no exception."""
    return F.lower(F.translate(text, "Σ", "σ"))


fold_text = text_steps(decompose, lower_each, drop_marks)


def normalize_label(label: Column) -> Column:
    """Lower case, no outer white space, no nonspacing marks; stays decomposed."""
    edges = f"^{SPACES}|{SPACES}$"
    bare = F.regexp_replace(F.lower(label), edges, "")
    return F.regexp_replace(decompose(bare), r"\p{Mn}+", "")


def extract_category(
    text: Column, classes: Sequence[str] = CLASS_DOMAIN, fallback: str = UNCLASSIFIED
) -> Column:
    """The first of ``classes`` that the normalized text contains, anywhere in a word."""

    def first_found(folded: Column) -> Column:
        found = [F.when(folded.contains(name), F.lit(name)) for name in classes]
        return F.coalesce(*found, F.lit(fallback))

    return bind(normalize_label(text), first_found)


def split_list(cell: Column, separator: str = VALUE_SEPARATOR) -> Column:
    """Clean, non-empty parts of a multi-value cell; null becomes an empty array."""
    if re.search(r"\s", separator):
        parts = F.transform(F.split(F.coalesce(cell, F.lit("")), re.escape(separator)), clean_text)
    else:  # the cell's spaces are collapsed at once; no separator goes or comes by that
        parts = F.transform(F.split(clean_text(cell), re.escape(separator)), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def merge_lists(*lists: Column) -> Column:
    """All values of several arrays, each kept where it was first seen."""
    return F.array_distinct(F.flatten(F.array(*lists)))


def best_by_language(
    names: Sequence[str], languages: Sequence[str] = LANGUAGE_PRIORITY
) -> Column:
    """First non-empty clean value: by language, then by header order, else ``''``."""
    ordered = [name for lang in languages for name in names if lang in name]
    ordered += [name for name in names if name not in ordered]
    cells = [F.col(f"`{name}`") for name in ordered]
    filled = [F.when(cell.rlike(f"[^{WHITESPACE}]"), cell) for cell in cells]
    return clean_text(F.coalesce(*filled, F.lit("")))  # only the value taken is cleaned


def first_line(text: Column) -> Column:
    """What stands before the first newline of the stripped text, stripped itself."""
    edges = f"^{SPACES}|{SPACES}$"
    begun = F.regexp_replace(text, f"^{SPACES}", "")  # what follows the line need not be stripped
    return F.regexp_replace(F.substring_index(begun, "\n", 1), edges, "")


def strip_control_tokens(text: Column, tokens: Sequence[str] = CONTROL_TOKENS) -> Column:
    return F.regexp_replace(text, "|".join(re.escape(token) for token in tokens), "")


def pre_tokenize(text: Column) -> Column:
    """Runs of word characters, or of other visible characters, in text order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_positions(text: Column, target: str) -> Column:
    """0-based positions at which ``target`` stands among the tokens."""
    # `array_compact` over indexes keeps the work inside the row: only hits are exploded
    hits = F.transform(
        pre_tokenize(text), lambda token, at: F.when(token == target, at)
    )
    found = F.array_compact(hits)
    # a text that does not hold the target anywhere is not cut
    return F.when(~text.contains(target), F.array().cast("array<int>")).otherwise(found)


def strip_prefix(name: Column, prefixes: Sequence[str] = META_PREFIXES) -> Column:
    return F.regexp_replace(name, "|".join(re.escape(prefix) for prefix in prefixes), "")


def scalar_or_list(values: Column) -> Column:
    """JSON form of a field: ``""`` for none, a string for one value, else a list."""
    # to_json takes no bare string: a one-element list minus its brackets is the scalar
    listed = F.to_json(values)
    scalar = F.substring(listed, F.lit(2), F.length(listed) - 2)
    return (
        F.when(F.size(values) < 1, F.lit('""'))
        .when(F.size(values) == 1, scalar)
        .otherwise(listed)
    )


def default_label(label: Column, default: str) -> Column:
    return F.coalesce(F.nullif(label, F.lit("")), F.lit(default))


def collapse_classes(label: Column, listed: Sequence[str], target: str) -> Column:
    return F.when(label.isin(*listed), F.lit(target)).otherwise(label)


def any_matches(values: Column, pattern: str) -> Column:
    """Whether any element matches, ignoring case for all of Unicode."""
    return F.exists(values, lambda value: value.rlike(f"(?iu){pattern}"))
