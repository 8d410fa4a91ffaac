"""String column expressions: hashes and keys, trimming, sentences, extractive summary,
word counts, keywords, search text, prefix cuts, JSON string quoting.

All of them are built-in Spark SQL expressions (no Python UDF), so they stay inside
whole-stage codegen and run on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import config as C

# Unicode-aware whitespace: Python's str.split()/strip() treat Unicode spaces as whitespace,
# Java regex does so only under (?U).
WS_RUN = r"(?U)\s+"
EDGE_WS = r"(?U)^\s+|\s+$"
SENTENCE_BREAK = r"(?U)(?<=[.!?])\s+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c) -> Column:
    """'' behaves like NULL (the original code chains values with `a or b`)."""
    return F.nullif(col_(c), F.lit(""))


def first_truthy(*cs) -> Column:
    return F.coalesce(*[truthy(c) for c in cs])


def full_trim(c) -> Column:
    """Strip leading/trailing Unicode whitespace (Spark's trim only strips spaces)."""
    return F.regexp_replace(col_(c), EDGE_WS, "")


def cut(c, n: int) -> Column:
    """Prefix of n code points (Python slice s[:n]); NULL stays NULL."""
    return F.substring(col_(c), 1, n)


def short_hash(c, n: int = 40) -> Column:
    """Hex SHA-1 of the UTF-8 text ('' for NULL), first n hex digits.

    n=8 reproduces the original 8-digit ids; the default keeps the full digest because
    32-bit ids collide at archive scale (a collision would mark a new article as seen)."""
    return F.substring(F.sha1(F.coalesce(col_(c), F.lit("")).cast("binary")), 1, n)


def url_key(url) -> Column:
    return F.concat(F.lit("url:"), short_hash(url, 16))


def summary_key(content_hash) -> Column:
    return F.concat(F.lit("summary:"), cut(F.coalesce(col_(content_hash), F.lit("")), 32))


def words(c) -> Column:
    """Python str.split(): whitespace runs, no empty tokens."""
    return F.filter(F.split(F.coalesce(col_(c), F.lit("")), WS_RUN), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(words(c))


def sentences(c) -> Column:
    """Split after . ! ? followed by whitespace; drop empty pieces.

    The text is trimmed first and every break consumes its whole whitespace run, so each
    piece is already trimmed (a per-piece strip would be a no-op)."""
    parts = F.split(full_trim(F.coalesce(col_(c), F.lit(""))), SENTENCE_BREAK)
    return F.filter(parts, lambda s: s != "")


def summary_from_sentences(s, text, body_chars: int = C.SUMMARY_BODY_CHARS) -> Column:
    """Extractive brief from a precomputed sentence array `s` (see extractive_summary)."""
    s, text = col_(s), col_(text)
    tldr = F.array_join(F.slice(s, 1, 2), " ")
    # sentences 3..8 with their word counts (each sentence is trimmed: split gives no empties)
    window = F.transform(F.slice(s, 3, 6), lambda x: F.struct(x.alias("s"), F.size(F.split(x, WS_RUN)).alias("n")))
    bullets = F.slice(F.transform(
        F.filter(window, lambda x: (x["n"] >= C.BULLET_MIN_WORDS) & (x["n"] <= C.BULLET_MAX_WORDS)), lambda x: x["s"]), 1, 3)
    body = F.substring(F.array_join(s, " "), 1, body_chars)
    why = F.when(F.size(bullets) > 0, F.element_at(bullets, 1)).otherwise(tldr)
    out = F.concat(
        tldr, F.lit(C.SUMMARY_HIGHLIGHTS),
        F.array_join(F.transform(bullets, lambda b: F.concat(F.lit(C.BULLET_PREFIX), b)), "\n"),
        F.lit(C.SUMMARY_BODY), body, F.lit(C.SUMMARY_WHY), why)
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("string")).otherwise(out)


def extractive_summary(c, body_chars: int = C.SUMMARY_BODY_CHARS) -> Column:
    """Deterministic brief: TL;DR (first two sentences), up to three highlight bullets
    (sentences 3-8 with 8..40 words), the joined body cut to `body_chars`, and a
    "why it matters" line (first bullet, else the TL;DR). NULL for NULL/'' input.

    As a single expression the sentence split is repeated; in a DataFrame prefer
    with_summary(), which splits once."""
    return summary_from_sentences(sentences(c), c, body_chars)


def with_summary(df, text_col: str, out_col: str, body_chars: int = C.SUMMARY_BODY_CHARS):
    """Adds `out_col` = extractive summary of `text_col`, splitting the text once (the split
    is a separate projection that Catalyst keeps, since its result is used several times)."""
    return (df.withColumn("_sent", sentences(text_col))
              .withColumn(out_col, summary_from_sentences("_sent", text_col, body_chars))
              .drop("_sent"))


def read_time(c) -> Column:
    """Minutes: 3 for NULL/'', else clamp(floor(words/200)+1, 2, 8)."""
    text = col_(c)
    est = F.greatest(F.lit(C.READ_TIME_MIN),
                     F.least(F.lit(C.READ_TIME_MAX),
                             (F.floor(word_count(text) / C.WORDS_PER_MINUTE) + 1).cast("int")))
    return F.when(text.isNull() | (text == ""), F.lit(C.READ_TIME_EMPTY)).otherwise(est).cast("int")


def title_words(title, min_len: int, n: int) -> Column:
    """First n whitespace tokens longer than min_len-1 code points; case and punctuation kept."""
    return F.slice(F.filter(words(title), lambda w: F.length(w) >= min_len), 1, n)


def title_keywords(title) -> Column:
    return title_words(title, C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)


def title_tags(title) -> Column:
    return title_words(title, C.TAG_MIN_LEN, C.TAGS_PER_TITLE)


def search_text(title, summary, content) -> Column:
    """lower(title + ' ' + summary + ' ' + content) with NULL as ''."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(col_(x), F.lit("")) for x in (title, summary, content)]))


def embedding_text(summary, content) -> Column:
    return F.concat(F.coalesce(col_(summary), F.lit("")), F.lit("\n\n"), F.coalesce(col_(content), F.lit("")))


def first_line(c) -> Column:
    return F.substring_index(col_(c), "\n", 1)


def json_quote_ascii(c) -> Column:
    """JSON string literal with ASCII-only output (\\uXXXX, surrogate pairs above U+FFFF),
    the form Python's json.dumps writes by default. NULL -> null.

    The text is cut into runs of printable ASCII and single other code points; a run only needs
    its backslashes and double quotes escaped, each other code point is mapped on its own."""
    def enc(tok):
        run = F.regexp_replace(F.regexp_replace(tok, r"\\", r"\\\\"), '"', r'\\"')
        return (F.when((F.ascii(tok) >= 32) & (F.ascii(tok) <= 126), run)
                .when(tok == "\n", F.lit("\\n"))
                .when(tok == "\r", F.lit("\\r"))
                .when(tok == "\t", F.lit("\\t"))
                .when(tok == "\b", F.lit("\\b"))
                .when(tok == "\f", F.lit("\\f"))
                .otherwise(F.regexp_replace(F.lower(F.hex(F.encode(tok, "UTF-16BE"))), "(.{4})", r"\\u$1")))
    toks = F.regexp_extract_all(col_(c), F.lit("([ -~]+|[^ -~])"), 1)
    quoted = F.concat(F.lit('"'), F.array_join(F.transform(toks, enc), ""), F.lit('"'))
    return F.when(col_(c).isNull(), F.lit("null")).otherwise(quoted)


def py_str_repr(c) -> Column:
    """repr() of a Python str for plain text: single quotes unless the text has a single
    quote and no double quote; backslash and the chosen quote escaped."""
    s = col_(c)
    esc = F.regexp_replace(s, r"\\", r"\\\\")
    dq = F.concat(F.lit('"'), esc, F.lit('"'))
    sq = F.concat(F.lit("'"), F.regexp_replace(esc, "'", r"\\'"), F.lit("'"))
    return F.when(s.contains("'") & ~s.contains('"'), dq).otherwise(sq)
