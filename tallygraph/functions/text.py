"""Pattern and markup helpers: ``Column -> Column``, no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygraph import fixed as fx


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def strip(col: Column) -> Column:
    """Trim every whitespace character, the no-break space included."""
    return F.btrim(col, F.lit(fx.WS_CHARS))


def has_text(col: Column) -> Column:
    """Any character that is not whitespace; stops at the first one."""
    return col.rlike(fx.NOT_WS)


def squeeze(col: Column) -> Column:
    return strip(F.regexp_replace(col, rf"{fx.WS}+", " "))


def extract(col: Column, pattern: str, group: int = 1, flags: str = "iu") -> Column:
    """Group of the first match, null when there is no match or it is empty."""
    rx = f"(?{flags}){pattern}" if flags else pattern
    return blank_to_null(F.regexp_extract(col, rx, group))


def first_match(col: Column, patterns: list[str], flags: str = "iu") -> Column:
    """First of several patterns that matches, stripped."""
    return F.coalesce(*[strip(extract(col, p, 1, flags)) for p in patterns])


def extract_all(col: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    rx = f"(?{flags}){pattern}" if flags else pattern
    return F.regexp_extract_all(col, F.lit(rx), F.lit(group))


def contains_any(col: Column, words: list[str]) -> Column:
    cond = F.lit(False)
    for word in words:
        cond = cond | col.contains(word)
    return cond


def unescape(col: Column, nbsp: bool = False) -> Column:
    """Five named entities, the ampersand first; ``nbsp`` adds the sixth."""
    pairs = [("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&gt;", ">"), ("&lt;", "<")]
    if nbsp:
        pairs.append(("&nbsp;", " "))
    for name, char in pairs:
        col = F.replace(col, F.lit(name), F.lit(char))
    return col


def title(html: Column) -> Column:
    text = squeeze(F.regexp_extract(html, f"(?is){fx.TITLE}", 1))
    return F.left(text, F.lit(fx.TITLE_CAP))


def without_hidden(html: Column) -> Column:
    """Drop script, style, noscript and svg elements with their content."""
    return F.regexp_replace(html, r"(?is)<(script|style|noscript|svg)\b[^>]*>.*?</\1\s*>", " ")


def clean_text(html: Column, cap: int | None = None, decode: bool = False) -> Column:
    """Visible text: hidden elements and tags removed, whitespace squeezed.

    Tags are found by pattern; entities stay as written unless ``decode``.
    """
    text = F.regexp_replace(without_hidden(html), r"<[^>]+>", " ")
    if decode:
        text = unescape(text, nbsp=True)
    text = squeeze(text)
    return F.left(text, F.lit(cap)) if cap else text


def visible_text(html: Column, cap: int | None = None) -> Column:
    """Visible text for profile pages: line breaks stay, other blanks are squeezed."""
    text = F.regexp_replace(without_hidden(html), r"<[^>]+>", " ")
    text = strip(F.regexp_replace(text, fx.BLANKS, " "))
    return F.left(text, F.lit(cap)) if cap else text


def _quoted(prop: str) -> str:
    return rf"""["']{prop.replace('.', chr(92) + '.')}["']"""


def meta_patterns(prop: str) -> list[str]:
    name, value = _quoted(prop), r"""["']([^"']+)["']"""
    return [rf"<meta[^>]+property={name}[^>]+content={value}",
            rf"<meta[^>]+content={value}[^>]+property={name}",
            rf"<meta[^>]+name={name}[^>]+content={value}"]


def meta_property(html: Column, prop: str, nbsp: bool = False) -> Column:
    """Content of a property or name meta tag, in three attribute orders."""
    return unescape(first_match(html, meta_patterns(prop)), nbsp)


def about_field(html: Column, field: str) -> Column:
    """Value of one labelled item of a public company page."""
    raw = extract(html, rf'data-test-id="about-us__{field}".*?<dd[^>]*>(.*?)</dd>', 1, "s")
    text = unescape(F.regexp_replace(raw, r"<[^>]+>", " "), nbsp=True)
    return blank_to_null(squeeze(text))


def page_lang(html: Column) -> Column:
    return F.lower(extract(html, fx.PAGE_LANG, 1, ""))


def meta_description(html: Column) -> Column:
    text = squeeze(extract(html, fx.META_DESCRIPTION, 1, "is"))
    own = F.coalesce(blank_to_null(text), squeeze(extract(html, fx.OG_DESCRIPTION, 1, "is")))
    return F.left(F.coalesce(own, F.lit("")), F.lit(fx.DESCRIPTION_CAP))


def favicon(html: Column) -> Column:
    return extract(html, fx.FAVICON, 1, "i")


def head_and_tail(text: Column, cap: int = fx.FILE_MAX_CHARS) -> Column:
    """Whole text up to the cap, else 60 % head, a marker and 35 % tail."""
    head, tail = int(cap * fx.TEXT_HEAD_SHARE), int(cap * fx.TEXT_TAIL_SHARE)
    cut = F.concat(F.left(text, F.lit(head)), F.lit(fx.TEXT_GAP), F.right(text, F.lit(tail)))
    return F.when(F.char_length(text) <= cap, text).otherwise(cut)
