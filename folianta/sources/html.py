"""Meta tags and links of raw HTML pages, which need not be well-formed."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folianta.fixed_values import ITEM_LINK_NEEDLE, LINK_DENY_LIST, META_PREFIXES
from folianta.functions.text import SPACES, bind, strip_prefix

# a tag runs to the first '>' outside quotes
IN_TAG = r"""[^'">]*(?:"[^"]*"[^'">]*|'[^']*'[^'">]*)*"""
TAG = r"(?is)<{tag}(?=[\s/>])" + IN_TAG + ">"
ANY_TAG = rf"(?is)</?[a-z]{IN_TAG}>"
TAG_IN_VALUE = r"""=\s*(?:"[^"]*<|'[^']*<)"""
# comments and elements whose content is text; each is looked for from where the last one ended,
# so a comment inside a script, or a script inside a comment, belongs to what began first
TEXT_ELEMENTS = "script|style|textarea"
NO_MARKUP = rf"(?is)<!--.*?(?:-->|\z)|<({TEXT_ELEMENTS})(?=[\s/>]){IN_TAG}>.*?(?:</\1(?=[\s/>])|\z)"
MAY_HIDE = rf"(?i)<!--|<(?:{TEXT_ELEMENTS})[\s/>]"
HIERARCHICAL = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)(/[^?#]*)"
# an attribute's name and value, the quotes still on
ATTRIBUTE = r"""([^\s"'=<>/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


@F.pandas_udf(T.ArrayType(T.StringType()))
def _unescape_all(values: pd.Series) -> pd.Series:
    return values.map(
        lambda texts: [html.unescape(text) for text in texts], na_action="ignore"
    )


def unescape(values: Column) -> Column:
    """Character references resolved in an array of texts.

    Only rows that contain a reference cross into Python; the others send a null.
    """
    escaped = F.exists(values, lambda text: text.contains("&"))
    return F.coalesce(_unescape_all(F.when(escaped, values)), values)


def markup(page: Column) -> Column:
    """The page without comments and without scripts, styles and text areas."""
    return F.when(page.rlike(MAY_HIDE), F.regexp_replace(page, NO_MARKUP, "<")).otherwise(page)


def without_dots(url: Column) -> Column:
    """The address with ``.`` and ``..`` steps of its path taken."""
    site, path = (F.regexp_extract(url, HIERARCHICAL, at) for at in (1, 2))
    steps = F.split(F.substring(path, F.lit(2), F.length(path)), "/", -1)
    taken = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda kept, step: F.when(step == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(step == ".", kept)
        .otherwise(F.concat(kept, F.array(step))),
    )
    folder = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(taken, F.array(F.lit("")))).otherwise(taken)
    rest = F.substring(url, F.length(site) + F.length(path) + 1, F.length(url))
    cleaned = F.concat(site, F.lit("/"), F.array_join(folder, "/"), rest)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), cleaned).otherwise(url)


def absolute(href: Column, base: Column) -> Column:
    """``href`` as seen from the page at ``base``, without dot segments; spaces around it go."""
    href = F.regexp_replace(href, r"^[ \t\n\f\r]+|[ \t\n\f\r]+$", "")
    base = F.regexp_replace(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)(?=[?#]|$)", "$1/")  # no path is the root
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*/(?:.*/)?)", 1)
    folder = F.when(folder != "", folder).otherwise(F.concat(site, F.lit("/")))
    joined = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )
    return without_dots(joined)


def base_address(page: Column, address: Column) -> Column:
    """What references of a page at ``address`` start from: its first base element with a reference."""
    named = F.transform(tags(page, "base"), lambda tag: attributes(tag, "href")["href"])
    first = F.get(F.filter(named, lambda href: href != ""), F.lit(0))
    return F.when(page.rlike(r"(?i)<base[\s/>]") & first.isNotNull(), absolute(first, address)).otherwise(address)


def tags(page: Column, tag: str) -> Column:
    """Start tags of one name, in page order; text in an attribute is none."""
    alone = F.regexp_extract_all(page, F.lit(TAG.format(tag=tag)), F.lit(0))
    every = F.regexp_extract_all(page, F.lit(ANY_TAG), F.lit(0))
    named = F.filter(every, lambda found: found.rlike(rf"(?i)^<{tag}[\s/>]"))
    return F.when(page.rlike(TAG_IN_VALUE), named).otherwise(alone)


def attributes(tag: Column, *names: str) -> Column:
    """``struct`` of the named attributes, unquoted; ``''`` where one is absent."""
    def unquoted(raw: Column) -> Column:
        quoted = raw.startswith('"') | raw.startswith("'")
        return F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)

    def picked(found: Column) -> Column:
        values = [
            F.get(found["values"], (F.array_position(found["names"], name) - 1).cast("int"))
            for name in names
        ]
        return F.struct(
            *[
                bind(F.coalesce(value, F.lit("")), unquoted).alias(name)
                for name, value in zip(names, values)
            ]
        )

    # scanning whole attributes keeps text inside a quoted value from passing for one
    listed = F.struct(
        F.transform(
            F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), lambda name: F.lower(name)
        ).alias("names"),
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2)).alias("values"),
    )
    return bind(listed, picked)


def meta_values(
    pages: DataFrame, key: str, page: str = "html", prefixes: Sequence[str] = META_PREFIXES
) -> DataFrame:
    """``(key, name, values)``: distinct contents of each meta name in first-seen order.

    Names must start with one of ``prefixes``, which is then removed; blank contents are
    dropped. Everything happens inside the row, so nothing is shuffled.
    """
    def wanted(meta: Column) -> Column:
        starts = F.lit(False)
        for prefix in prefixes:
            starts = starts | meta["name"].startswith(prefix)
        return starts

    edges = f"^{SPACES}|{SPACES}$"
    metas = F.transform(tags(markup(F.col(page)), "meta"), lambda t: attributes(t, "name", "content"))
    found = pages.select(key, F.filter(metas, wanted).alias("metas"))
    # the page itself is gone here: only the kept contents travel to Python
    found = found.select(
        key,
        F.transform("metas", lambda m: strip_prefix(m["name"], prefixes)).alias("names"),
        unescape(F.transform("metas", lambda m: m["content"])).alias("contents"),
    )
    pairs = F.filter(
        F.transform(
            F.arrays_zip("names", "contents"),
            lambda pair: F.struct(
                pair["names"].alias("name"),
                F.regexp_replace(pair["contents"], edges, "").alias("value"),
            ),
        ),
        lambda pair: pair["value"] != "",
    )
    found = found.select(key, pairs.alias("pairs"))
    names = F.array_distinct(F.transform("pairs", lambda pair: pair["name"]))
    return found.select(key, "pairs", F.explode(names).alias("name")).select(
        key,
        "name",
        F.array_distinct(
            F.transform(
                F.filter("pairs", lambda pair: pair["name"] == F.col("name")),
                lambda pair: pair["value"],
            )
        ).alias("values"),
    )


def page_links(
    pages: DataFrame,
    key: str | None = None,
    page: str = "html",
    needle: str = ITEM_LINK_NEEDLE,
    deny: Sequence[str] = LINK_DENY_LIST,
    base: str | None = None,
) -> DataFrame:
    """Distinct ``href`` values that contain ``needle`` and none of ``deny``.

    With ``key`` they are distinct per page, inside the row; without it, over all pages.
    Character references are resolved; comments, scripts, styles and text areas skipped. With
    ``base``, the column of the page's own address, links are made absolute first, from the
    page's base element if it has one.
    """
    def wanted(href: Column) -> Column:
        ok = href.contains(needle)
        for word in deny:
            ok = ok & ~href.contains(word)
        return ok

    hrefs = F.transform(tags(F.col("_page"), "a"), lambda tag: attributes(tag, "href")["href"])
    kept = [key] if key else []
    address = [base_address(F.col("_page"), F.col(base)).alias("_base")] if base else []
    found = pages.withColumn("_page", markup(F.col(page))).select(*kept, *address, unescape(hrefs).alias("_hrefs"))
    hrefs = F.filter("_hrefs", lambda href: href != "")
    if base:
        hrefs = F.transform(hrefs, lambda href: absolute(href, F.col("_base")))
    links = found.select(*kept, F.explode(F.array_distinct(F.filter(hrefs, wanted))).alias("href"))
    return links if key else links.distinct()
