"""Names, enumerations and fixed texts shared by every module."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must be exactly as written for results to be right.
# ---------------------------------------------------------------------------

REQUIRED_SOURCE_COLUMNS = ["source_url", "niche", "lang", "rights", "usage_strategy"]
REQUIRED_QUERY_COLUMNS = ["query", "priority", "max_results", "min_views"]
MASTER_COLUMNS = REQUIRED_SOURCE_COLUMNS + ["origin_platform"]
URL_COLUMNS = ["source_url", "link", "url"]
DATE_COLUMNS = ["publication_date", "published_at", "date"]

READY_COLUMNS = [
    "source_url",
    "content_url",
    "niche",
    "usage_strategy",
    "lang",
    "rights",
    "origin_platform",
    "prompt_template",
    "processed",
    "notes",
    "source_file",
    "priority_score",
    "manual_score",
    "manual_priority_score",
    "blended_priority_score",
    "reviewer_decision",
    "reviewer_notes",
    "status",
    "prompt_generated",
    "prompt_quality_score",
    "content_ready",
    "title_seed",
    "caption_seed",
    "ai_status",
]
PROMPTS_COLUMNS = READY_COLUMNS + [
    "final_prompt",
    "prompt_quality_flags",
    "raw_text",
    "ai_enhancement_payload",
]
READY_REQUIRED = [
    "manual_score",
    "manual_priority_score",
    "blended_priority_score",
    "reviewer_decision",
    "prompt_quality_score",
    "ai_status",
]
PROMPTS_REQUIRED = ["final_prompt", "prompt_quality_flags", "ai_enhancement_payload"]

# Cell spellings a source CSV uses for "no value".
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

TEXT_DEFAULTS = {
    "niche": "MOTIVATION",
    "lang": "FR",
    "rights": "REWRITE_REQUIRED",
    "usage_strategy": "viral",
    "origin_platform": "",
    "notes": "",
}

RIGHTS = ["FREE_REPOST", "REWRITE_REQUIRED", "INSPIRE_ONLY", "AVOID"]
STRATEGIES = ["viral", "education", "inspiration"]
RIGHTS_TO_LEVEL = {
    "FREE_REPOST": "repost",
    "REWRITE_REQUIRED": "rewrite",
    "INSPIRE_ONLY": "inspire",
    "AVOID": "avoid",
}
LEGACY_RIGHTS_TO_LEVEL = {
    "rewrite_required": "rewrite",
    "summary_only": "summary",
    "original_allowed": "none",
}

# Tried in order; a row takes the first platform one of whose marks its URL holds.
PLATFORM_MARKS = [
    ("YOUTUBE", ["youtube", "youtu.be"]),
    ("TIKTOK", ["tiktok"]),
    ("FACEBOOK", ["facebook", "fb.watch"]),
]
# Tried in order; a row takes the first niche one of whose words its text holds.
NICHE_WORDS = [
    ("BUSINESS", ["business", "money", "entrepreneur"]),
    ("HEALTH", ["health", "fitness", "wellness"]),
    ("STORY", ["story", "emotion", "histoire"]),
    ("EDUCATION", ["education", "learn", "tutorial"]),
]
PREFERRED_NICHES = ["MOTIVATION", "BUSINESS"]
PREFERRED_LANG = "FR"

STOPWORDS = [
    "the",
    "and",
    "for",
    "with",
    "this",
    "that",
    "from",
    "youtube",
    "watch",
    "video",
    "www",
    "com",
    "https",
    "http",
]
TREND_WEIGHTS = {"recency_score": 0.4, "frequency_score": 0.3, "multi_source_score": 0.3}

SITE_BASE = "https://www.youtube.com"
WATCH_PREFIX = SITE_BASE + "/watch?v="

DEFAULT_ROLE = "You are a professional short-form content creator."
DEFAULT_RULES = ["No plagiarism", "High value rewrite", "Strong hook (3s)"]
DEFAULT_FORMAT = "Short-form script (30 to 60 seconds)"
DEFAULT_OBJECTIVE = "Create viral content"
DEFAULT_TONE = "Energetic"
DEFAULT_TRANSFORMATION = "Rewrite content."
DEFAULT_HINT = "Improve hook + CTA"
LEGACY_BASE_PROMPT = "You are a professional content creator."
LEGACY_GOALS = {
    "viral": "Create highly engaging content designed to maximize reach.",
    "education": "Create clear and structured educational content.",
}
LEGACY_LEVELS = {
    "rewrite": "Rewrite the source with significant transformation.",
    "summary": "Summarize the source clearly.",
    "none": "Keep structure but improve clarity.",
}
LEGACY_FORMAT = "Structured, platform-ready, optimized for engagement."
PAYLOAD_GOAL = "Improve hook quality, clarity, and call-to-action while preserving meaning."
PAYLOAD_CONSTRAINTS = ["No plagiarism", "Keep source attribution", "Keep language consistency"]

DEFAULT_MAX_RESULTS = 30
DEFAULT_MAX_PAGES = 3
PAGE_SIZE = 50
SEARCH_PAGE_QUOTA = 100
CACHE_TTL_SECONDS = 900
MINIMUM_RESULTS = 10

# Every character a text strip removes at either end.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ---------------------------------------------------------------------------
# Names of our own
# ---------------------------------------------------------------------------

# Stable input order of a row; the smaller value came first. See plans/order.py.
ORD = "_ord"
