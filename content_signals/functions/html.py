"""Anchors of a raw HTML page, without a document tree."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from content_signals.functions.text import trim_ws


def _hidden(group: int) -> str:
    """Parts of a page that hold no links: comments, scripts, styles; uses the group of that number."""
    return rf"<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\{group}\s*>|\z)"


#: An opening tag, whose quoted values may hold ``>``; with a stray quote, up to the next ``>``.
_TAG = r"(?:<a\s(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>|<a\s[^>]*>)"
#: What a page is cut into: hidden parts, and anchors up to their end, the next anchor's beginning or that of
#: the page's. Possessive loops are walked without recursion, however long the page is.
_TOKEN = rf"(?is){_hidden(1)}|{_TAG}(?:[^<]++|{_hidden(2)}|<(?!/a\s*>|a\s))*+"
_HIDDEN = rf"(?is){_hidden(1)}"
_MARKUP = rf"(?is)^{_TAG}|\s*<[^>]*>\s*"
_HAS_HIDDEN = r"(?i)<(?:!--|script|style)"
_VALUE = r"\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
_OTHERS = r"(?:[^\s=>\"']+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+))?\s*)*?"
_HREF = rf"(?is)^<a\s+{_OTHERS}(?<![\w-])href{_VALUE}"
_TITLE = rf"(?is)^<a\s+{_OTHERS}(?<![\w-])title{_VALUE}"
#: Named characters; fixed values.
_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\xa0", "hellip": "…", "ndash": "–", "mdash": "—",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "copy": "©", "reg": "®",
    "agrave": "à", "ccedil": "ç", "egrave": "è", "eacute": "é", "ecirc": "ê", "euml": "ë", "icirc": "î",
    "ocirc": "ô", "ugrave": "ù", "ucirc": "û", "ntilde": "ñ", "auml": "ä", "ouml": "ö", "uuml": "ü", "szlig": "ß",
    "amp": "&",
}
_NAME = r"^(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[a-z]+);"


def decode_entities(col: Column) -> Column:
    """Named and numbered characters, each decoded once; names and numbers of no character stay.

    The text is split where one may begin, and each part's name looked up.
    """
    known = F.create_map(*[F.lit(x) for pair in _ENTITIES.items() for x in pair])

    def one(part: Column, place: Column) -> Column:
        name = F.regexp_extract(part, _NAME, 1)
        hexed = name.startswith("#x") | name.startswith("#X")
        digits = F.when(hexed, F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7))
        code = digits.try_cast("bigint")
        sound = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        numbered = F.when(sound, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        char = F.when(name.startswith("#"), numbered).otherwise(F.try_element_at(known, name))
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        whole = F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part))
        return F.when(place == 0, part).otherwise(whole)

    decoded = F.array_join(F.transform(F.split(col, "&", -1), one), "")
    return F.when(col.contains("&"), decoded).otherwise(col)


def _unquote(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def anchors(html: Column, part: str = "") -> Column:
    """``(href, title)`` of every anchor that holds ``part``, in page order.

    The title is the title attribute, else the anchor's text without markup. The page is
    cut into hidden parts and anchors in one pass. Each further step is an array of its
    own, so that an element is worked out only once.
    """
    tokens = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))
    wanted = F.filter(tokens, lambda t: F.lower(F.left(t, F.lit(2))).eqNullSafe("<a") & t.contains(part))
    shown = F.transform(wanted, lambda a: F.when(a.rlike(_HAS_HIDDEN), F.regexp_replace(a, _HIDDEN, "")).otherwise(a))
    raw = F.transform(
        shown,
        lambda a: F.struct(
            F.regexp_extract(a, _HREF, 1).alias("href"),
            F.when(F.lower(a).contains("title"), F.regexp_extract(a, _TITLE, 1)).otherwise("").alias("title"),
            a.alias("whole"),
        ),
    )
    bare = F.transform(
        raw,
        lambda x: F.struct(
            _unquote(x["href"]).alias("href"),
            F.when(F.length(x["title"]) > 2, _unquote(x["title"])).alias("title"),
            F.when(F.length(x["title"]) <= 2, F.regexp_replace(x["whole"], _MARKUP, "")).alias("text"),
        ),
    )
    return F.transform(
        bare,
        lambda x: F.struct(
            decode_entities(x["href"]).alias("href"),
            F.coalesce(decode_entities(x["title"]), trim_ws(decode_entities(x["text"]))).alias("title"),
        ),
    )
