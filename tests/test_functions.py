"""Column functions on hand-picked cases."""

from __future__ import annotations

import re
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from content_signals.constants import STOPWORDS, WATCH_PREFIX
from content_signals.functions import html, keywords, text, urls


def test_trim_strips_unicode_blanks(column):
    values = ["\t a\xa0", " b　", " \n ", "c d", None, "\x1f e \x85"]
    want = [None if v is None else v.strip() for v in values]
    assert column(text.trim_ws, values) == want


def test_plain_number(column):
    values = ["92", " 92 ", "92f", "0x1p3", "NaN", "inf", "1e12", "-5", ".5", "5.", "abc", "", None]
    assert column(text.plain_number, values) == [
        92.0, 92.0, None, None, None, None, 1e12, -5.0, 0.5, 5.0, None, None, None,
    ]


def test_count_or_zero(column):
    values = ["15", " 7 ", "-1", "1.5", "many", "", None, "99999999999999999999", "1_000", "1__0", "_1"]
    assert column(text.count_or_zero, values) == [15, 7, -1, 0, 0, 0, 0, 0, 1000, 0, 0]


def test_title_case(column):
    values = ["SELF-HELP", "O'NEIL STORY", "A1B", "ÉTÉ", "", "HEALTH"]
    assert column(text.title_case, values) == [v.title() for v in values]


def test_json_text(column):
    values = ['a"b\\c\nd\te/é', "", "  "]
    assert column(text.json_text, values) == ['"a\\"b\\\\c\\nd\\te/é"', '""', '"  "']


@pytest.mark.parametrize(
    ("href", "video_id"),
    [
        ("", None),
        (None, None),
        ("/watch?v=abc123", "abc123"),
        ("https://anything.example/watch?v=abc123&t=3", "abc123"),
        ("https://x.example/watch?t=3&v=abc123#v=no", "abc123"),
        ("https://x.example/watch?v=", None),
        ("https://x.example/watch?v=&v=second", "second"),
        ("https://x.example/watch?xv=abc", None),
        ("https://x.example/watch?v=a%20b+c", "a b c"),
        ("https://x.example/watch?v=%zz+x", "%zz x"),
        ("https://youtu.be/abcdef", "abcdef"),
        ("https://youtu.be/abc", None),
        ("https://x.example/shorts/abcdef?a=1", "abcdef"),
        ("https://x.example/embed/abcdef", None),
        ("https://x.example/watch/?v=abcdef", None),
        ("//host/watch?v=abcdef", None),
    ],
)
def test_video_id(column, href, video_id):
    assert column(urls.extract_video_id, [href]) == [video_id]


def test_canonical_watch_url(column):
    values = ["abc", "", None, "/shorts/abcdef", "http://x.example/", " "]
    assert column(urls.canonical_watch_url, values) == [
        WATCH_PREFIX + "abc", None, None, WATCH_PREFIX + "abcdef", None, WATCH_PREFIX + " ",
    ]


def test_canonical_watch_url_is_idempotent(column):
    values = ["abcdef", "/watch?v=abcdef&t=1", "https://youtu.be/abcdef"]
    once = column(urls.canonical_watch_url, values)
    assert column(urls.canonical_watch_url, once) == once


def test_search_url(column):
    values = ["python automation", "a*b~c&d/é"]
    prefix = "https://www.youtube.com/results?search_query="
    assert column(urls.search_url, values) == [prefix + quote_plus(v) for v in values]


def test_source_ids(column):
    values = [" UC1 ", "https://x.example/channel/UC_2/about", "https://x.example/@name", "  "]
    assert column(urls.channel_id, values) == ["UC1", "UC_2", None, None]
    values = ["PL1", "https://x.example/playlist?list=PL2&x=1", "https://x.example/playlist"]
    assert column(urls.playlist_id, values) == ["PL1", "PL2", values[2]]
    values = ["https://x.example/@a//", "https://x.example/@a/videos/"]
    assert column(urls.channel_videos_url, values) == ["https://x.example/@a/videos"] * 2


def _plain_keywords(value):
    found = re.findall(r"[a-zA-Z0-9]+", value.lower())
    return [w for w in found if len(w) > 2 and w not in STOPWORDS]


def test_keywords(column):
    values = [
        "The video of THE cat, cats & cat-3d",
        "https://www.youtube.com/watch?v=x1",
        "a an of",
        "",
        "été 2024 forthe the",
        "-- watch4 --",
    ]
    want = [_plain_keywords(v) for v in values]
    values = [v.lower() for v in values]
    assert column(keywords.keywords, values) == want
    assert column(keywords.first_keyword, values) == [w[0] if w else None for w in want]


def test_anchors(column):
    page = (
        "<a href='/watch?v=one1' title=\"First &amp; best\">x</a>"
        '<A class=c HREF="/watch?v=two2">\n <b> Bold </b> text </A>'
        "<a href=/watch?v=three3>  </a><a name=n>no link</a>"
    )
    found = column(lambda c: F.to_json(html.anchors(c, "/watch")), [page])[0]
    assert found == (
        '[{"href":"/watch?v=one1","title":"First & best"},'
        '{"href":"/watch?v=two2","title":"Boldtext"},'
        '{"href":"/watch?v=three3","title":""}]'
    )
