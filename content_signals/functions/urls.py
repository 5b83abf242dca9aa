"""Video URLs: find the id, write the canonical watch URL, derive source ids.

Path and query are cut out with patterns, not with Spark's URL parser: crawled
links hold blanks and non-ASCII letters, on which that parser gives up.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from content_signals.constants import SITE_BASE, WATCH_PREFIX
from content_signals.functions.text import trim_ws

# The shapes of watch, short and channel links, of which an id has at least six characters.
_WATCH_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?/watch(?:;[^/?#]*)?(?:[?#]|$)"
_SHORT_LINK = r"(?:youtu\.be/|/shorts/)([A-Za-z0-9_-]{6,})"
_CHANNEL = r"/channel/([A-Za-z0-9_-]+)"


def query_value(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, decoded; null if there is none."""
    raw = F.regexp_extract(url, r"^[^?#]*\?(?:[^#]*?&)?" + name + r"=([^&#]+)", 1)
    plain = F.replace(raw, F.lit("+"), F.lit(" "))
    return F.nullif(F.coalesce(F.try_url_decode(raw), plain), F.lit(""))


def extract_video_id(href: Column) -> Column:
    """Video id of a link, else null. The host is not looked at."""
    url = F.when(href.startswith("/"), F.concat(F.lit(SITE_BASE), href)).otherwise(href)
    short = F.nullif(F.regexp_extract(url, _SHORT_LINK, 1), F.lit(""))
    return F.when(url.rlike(_WATCH_PATH), query_value(url, "v")).otherwise(short)


def canonical_watch_url(link: Column) -> Column:
    """Watch URL of a link or of a bare id; null when no id can be found."""
    is_link = link.startswith("http") | link.startswith("/")
    video_id = F.when(is_link, extract_video_id(link)).otherwise(F.nullif(link, F.lit("")))
    return F.concat(F.lit(WATCH_PREFIX), video_id)


def search_url(query: Column) -> Column:
    """Search page URL of a query text."""
    encoded = F.replace(F.url_encode(query), F.lit("*"), F.lit("%2A"))
    encoded = F.replace(encoded, F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(SITE_BASE + "/results?search_query="), encoded)


def channel_id(source: Column) -> Column:
    """Channel id given as it is or inside a channel URL; null when unresolved."""
    text = trim_ws(source)
    found = F.when(text.startswith("http"), F.regexp_extract(text, _CHANNEL, 1)).otherwise(text)
    return F.nullif(found, F.lit(""))


def channel_videos_url(source: Column) -> Column:
    """Address of a channel's video list."""
    url = F.rtrim(source, F.lit("/"))
    return F.when(url.endswith("/videos"), url).otherwise(F.concat(url, F.lit("/videos")))


def playlist_id(source: Column) -> Column:
    """Playlist id out of a playlist URL, else the text itself."""
    return F.coalesce(query_value(source, "list"), source)
