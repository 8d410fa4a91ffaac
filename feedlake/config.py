"""Settings and fixed values.

Everything in the FIXED VALUES block must stay as written: the outputs (brief text layout,
insight wording, sitemap fields, cut lengths, default feed list, static feature cards) are
compared against the original tool's output byte for byte.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------------------------
# FIXED VALUES (must equal the original tool's output format)
# ---------------------------------------------------------------------------------------------

# Default feed list, in this order; a user source file is appended after it.
DEFAULT_SOURCES = [
    "https://feeds.bbci.co.uk/news/rss.xml",
    "https://www.ft.com/rss/home",
    "https://news.google.com/rss/search?q=technology&hl=en-US&gl=US&ceid=US:en",
    "https://rsshub.app/twitter/trending",
    "https://www.reddit.com/r/news/top/.json?limit=5&t=day",
    "https://www.reddit.com/r/technology/top/.json?limit=5&t=day",
    "https://rsshub.app/instagram/tag/ai",
    "https://trends.google.com/trends/trendingsearches/daily/rss?geo=US",
]

ENTRIES_PER_FEED = 3          # RSS entries kept per feed, in document order
RSS_SUMMARY_CHARS = 1000      # RSS entry summary cut
JSON_SUMMARY_CHARS = 500      # JSON (reddit-style) selftext cut
JSON_LINK_PREFIX = "https://reddit.com"
JSON_SOURCE_NAME = "Reddit"
ARTICLE_TEXT_CHARS = 6000     # page text returned to the summariser
FEED_SUMMARY_MIN_CHARS = 200  # a feed summary longer than this is used as the article text
SUMMARY_BODY_CHARS = 3600     # 450 words * 8 chars
STORED_SUMMARY_CHARS = 800    # articles.summary
FRONT_MATTER_SUMMARY_CHARS = 200
SEO_SUMMARY_CHARS = 300
DESCRIPTION_MAX = 155         # description longer than this is clipped ...
DESCRIPTION_CUT = 152         # ... to this many chars, back to the last space, plus "..."
TITLE_SNIPPET_CHARS = 60      # duplicate-title check
EVIDENCE_SUMMARY_CHARS = 220
INSIGHT_CLIP_CHARS = 200
HOME_FEED_SIZE = 9
TOP_INSIGHTS = 3
RECENT_SLICE = 7
SIMILAR_K_SEARCH = 5
SIMILAR_K_INSIGHT = 6
KEYWORD_MIN_LEN = 5           # title words longer than 4 chars
KEYWORDS_PER_TITLE = 4
TAG_MIN_LEN = 4               # tags: title words longer than 3 chars
TAGS_PER_TITLE = 6
BULLET_MIN_WORDS = 8
BULLET_MAX_WORDS = 40
MENTION_BIN_DAYS = 7
INSIGHT_BIN_DAYS = 30
EMBED_DIM = 384
READ_TIME_EMPTY = 3
READ_TIME_MIN = 2
READ_TIME_MAX = 8
WORDS_PER_MINUTE = 200

SUMMARY_HIGHLIGHTS = "\n\nHighlights:\n"
SUMMARY_BODY = "\n\nSummary:\n"
SUMMARY_WHY = "\n\nWhy it matters: "
BULLET_PREFIX = "- "
UNTITLED = "(untitled)"

INSIGHT_BULLET_1 = "This mirrors patterns in our archive."
INSIGHT_BULLET_3 = "If mentions rise in the next week, trend is accelerating."
INSIGHT_PREDICTION = "If signals continue, expect follow-ups in the coming weeks."
INSIGHT_PREDICTION_HEADER = "\n\nPrediction:\n"
INSIGHT_NO_KEYWORDS = "n/a"

# Older archive-analysis variant of the heuristic insight (and its evidence cut).
ARCHIVE_INSIGHT_BULLET_1 = "Trend appears consistent with past coverage."
ARCHIVE_INSIGHT_BULLET_2_PREFIX = "Mentions of "
ARCHIVE_INSIGHT_BULLET_2_SUFFIX = " increased recently."
ARCHIVE_INSIGHT_BULLET_3 = "Watch for follow-up in next 2 weeks."
ARCHIVE_INSIGHT_PREDICTION = "This topic may continue to rise if further events occur."

INSIGHT_PROMPT_SYSTEM = (
    "You are a journalist-analyst. Use evidence and counts to produce a short insight "
    "connecting past patterns to near-future implications."
)
INSIGHT_PROMPT_ASK = (
    "Write: 1) TL;DR (one line), 2) 3 bullet points of pattern, "
    "3) One 1-sentence prediction (what to watch next)."
)

# Prompt of the archive-analysis variant.
ARCHIVE_EVIDENCE_SUMMARY_CHARS = 250
ARCHIVE_PROMPT_SYSTEM = (
    "You are an analytics journalist. Use evidence to produce a concise insight (3-6 sentences) that explains "
    "how the current story connects to past patterns and suggests near-future implications."
)
ARCHIVE_PROMPT_SERIES = "\n\nKeyword time-series (last windows):\n"
ARCHIVE_PROMPT_ASK = (
    "\n\nWrite: 1) TL;DR (one line), 2) 3 bullets about pattern, "
    "3) 1 short prediction (what to watch next).\n"
)

SITEMAP_CHANGEFREQ = "daily"
SITEMAP_PRIORITY = "0.6"
PREVIEWS_PREFIX = "previews/"


# Title of a card without one on the pages.
UNTITLED_BRIEF = "Untitled brief"

# Sitemap XML.
SITEMAP_HEAD = "<?xml version='1.0' encoding='UTF-8'?>\n<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>\n"
SITEMAP_END = "\n</urlset>\n"
SITEMAP_INDEX_HEAD = "<?xml version='1.0' encoding='UTF-8'?>\n<sitemapindex xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>\n"
SITEMAP_INDEX_END = "\n</sitemapindex>\n"

# Static feature cards of the home feed, in this order.
STATIC_FEATURES = [
    {
        "title": "The Quiet Revolution: How 10 Mobile Apps Are Rewriting Everyday Life in 2025",
        "summary": "The mobile apps that quietly restructured daily behaviour in 2025 — predictive "
                   "simplicity, ambient intelligence and the disappearance of 'app' as a concept.",
        "date": "Nov 1, 2025",
        "read_time": 10,
        "url": "/page1.html",
    },
    {
        "title": "Startup Strategy for an AI-First World",
        "summary": "A practical playbook for founders: what changes when models can replace entire "
                   "teams, and where human leverage still compounds.",
        "date": "Oct 20, 2025",
        "read_time": 12,
        "url": "/page1.html",
    },
]

# ---------------------------------------------------------------------------------------------
# Site settings (deployment configuration, not output format)
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Site:
    name: str = "feedlake"
    url: str = "https://example.com"
    twitter: str = "feedlake"
    og_image: str = "/assets/og-default.jpg"
    logo_path: str = "/assets/og-default.jpg"
    author: str = "feedlake"


@dataclass(frozen=True)
class Limits:
    """Size guards for broadcast sides. Above a bound the job takes its shuffle form instead."""
    broadcast_rows: int = 1_000_000  # short rows: a keyword, a run of letters
    similarity_block_rows: int = 4096  # vectors of a cell's block in the memory of a task
    keyword_chunk_rows: int = 50_000


SITE = Site()
LIMITS = Limits()
