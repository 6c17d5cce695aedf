"""Raw web pages to blank-line separated paragraphs, with built-in functions per row.

The tags of a page are read in their order. One expression matches a comment, a script or
style element, or a tag with its quoted attributes, whichever comes first, so that a
comment sign in a script, markup in a comment or a ``>`` in an attribute is part of what
holds it. Elements that hide their content nest, so a fold over their tags keeps the stack of
those still open; text between them stays where the stack is empty.
"""

from __future__ import annotations

import json
import zlib
from functools import reduce
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from marea.functions.text import let

# --- Fixed values -----------------------------------------------------------
# Elements whose content is raw text up to their own end tag, and elements that hide what they
# hold; without an end tag both last to the end of the page.
RAW = ("script", "style")
HIDDEN = ("nav", "template", "noscript")
# Elements that stand apart as paragraphs of their own, and those on lines of their own.
BLOCKS = ("address article aside blockquote body details dialog div dl fieldset figcaption figure footer form "
          "h[1-6] head header hr html legend li main ol option p pre section select summary table tbody tfoot "
          "thead title tr ul").split()
LINES = "caption dd dt td th".split()
# ----------------------------------------------------------------------------

# What follows a tag's name: attributes, in which quotes may hold any character. A quote that
# is never closed does not count.
ATTRIBUTES = r"""(?=[\s/>])(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)"""
COMMENT = r"<!--(?s:.*?)(?:-->|\z)"
RAW_ELEMENT = "|".join(rf"<{name}{ATTRIBUTES}(?s:.*?)(?:</{name}(?=[\s/>])[^>]*+>|\z)" for name in RAW)
ANY_TAG = rf"</?[a-z][^\s/>]*+{ATTRIBUTES}"
HIDING_TAG = rf"</?(?:{'|'.join(HIDDEN)}){ATTRIBUTES}"

# (regular expression, replacement), applied in this order.
MARKUP_RULES = (
    (rf"(?i)<br{ATTRIBUTES}", "\n"),
    (rf"(?i)</?(?:{'|'.join(LINES)}){ATTRIBUTES}", "\n"),
    (rf"(?i)</?(?:{'|'.join(BLOCKS)}){ATTRIBUTES}", "\n\n"),
    (rf"(?i){ANY_TAG}|<[^>]*>", ""),
)
SPACE_RULES = (
    ("\u00a0", " "),
    (r"[ \t\r]*\n[ \t\r]*", "\n"),
    (r"\n\n+", "\n\n"),
    (r"^\n+|\n+$", ""),
)
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});?"


NAME_BUCKETS = 512      # of the table of named references, so that a lookup sees a few names


def code_point(number: Column) -> Column:
    """The character of a code point; null for a number that is none."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number)), 8, "0")), "UTF-32")


def referred(reference: Column) -> Column:
    """What a character reference stands for; an unknown one stands for itself. Names
    may lack the semicolon only where the standard's table has them without."""
    buckets: list[dict[str, str]] = [{} for _ in range(NAME_BUCKETS)]
    for name, value in html5.items():
        buckets[zlib.crc32(f"&{name}".encode()) % NAME_BUCKETS][f"&{name}"] = value
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")    # folded to a constant
    names = F.get(table, (F.crc32(reference.cast("binary")) % NAME_BUCKETS).cast("int"))
    decimal = F.regexp_extract(reference, "^&#([0-9]+)", 1)
    hexadecimal = F.regexp_extract(reference, "^&#[xX]([0-9a-fA-F]+)", 1)
    return F.coalesce(
        F.when(decimal != "", code_point(decimal.cast("long")))
        .when(hexadecimal != "", code_point(F.conv(hexadecimal, 16, 10).cast("long")))
        .otherwise(F.try_element_at(names, reference)), reference)


def unescaped(text: Column) -> Column:
    """All character references of a text replaced in one pass, so that what one of them
    stands for is never read as part of another."""
    between = F.split(text, REFERENCE, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), referred)
    joined = F.array_join(F.zip_with(between, found, lambda before, new: F.concat(before, F.coalesce(new, F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def visible(html: Column) -> Column:
    """The page without comments, scripts, styles and hidden elements."""
    shown = F.regexp_replace(html, rf"(?i){COMMENT}|{RAW_ELEMENT}|({ANY_TAG})", "$1")

    def without_hidden(page: Column) -> Column:
        pieces = F.split(page, f"(?i){HIDING_TAG}", -1)
        tags = F.transform(F.regexp_extract_all(page, F.lit(f"(?i){HIDING_TAG}"), F.lit(0)), F.lower)
        start = F.struct(F.array().cast("array<string>").alias("open"), F.array(F.lit(0)).alias("depths"))

        def step(state: Column, tag: Column) -> Column:
            name = F.regexp_extract(tag, "[a-z]+", 0)
            opened = state["open"]
            above = F.array_position(F.reverse(opened), name).cast("int")     # 0: nothing of that name is open
            now = F.when(~F.startswith(tag, F.lit("</")), F.array_append(opened, name)) \
                .when(above > 0, F.slice(opened, F.lit(1), F.size(opened) - above)).otherwise(opened)
            return let(now, lambda open_: F.struct(open_.alias("open"), F.array_append(state["depths"], F.size(open_))
                                                   .alias("depths")))

        depths = F.aggregate(tags, start, step, lambda state: state["depths"])
        kept = let(depths, lambda d: F.filter(pieces, lambda _, i: F.get(d, i) == 0))
        return F.when(F.rlike(page, F.lit(f"(?i)</?(?:{'|'.join(HIDDEN)})[\\s/>]")), F.array_join(kept, "")).otherwise(page)

    return let(shown, without_hidden)


def html_text(html: Column) -> Column:
    """Visible text with blank lines between blocks and line breaks between table cells."""
    text = reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), MARKUP_RULES, visible(html))
    return reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), SPACE_RULES, let(text, unescaped))


def html_to_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    return pages.select(id_col, html_text(F.col(html_col)).alias("text"))
