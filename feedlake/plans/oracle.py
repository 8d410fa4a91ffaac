"""Independent SQL (DuckDB dialect) for each registered query, over the raw driver views.

The SQL is written from the operator semantics, not from the Spark plans: published times
come from their defining arithmetic (the Spark side parses the rendered text), sentence
breaks are marked with a control character instead of a look-behind split, and so on.
Helper functions below only assemble repeated SQL fragments.
"""

from __future__ import annotations

from feedlake import config as C

NL = "chr(10)"
AS_OF = "TIMESTAMP '2024-04-01 00:00:00'"
RUN_TS = "TIMESTAMP '2024-04-01 06:30:00'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def wc(x: str) -> str:
    return f"len(list_filter(string_split_regex(coalesce({x}, ''), '\\s+'), lambda w: w <> ''))"


def sentences(x: str) -> str:
    marked = f"regexp_replace({trim_ws(f"coalesce({x}, '')")}, '([.!?])\\s+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {trim_ws('s')}), lambda s: s <> '')"


def summary(s: str, x: str) -> str:
    bul = f"list_slice(list_filter(list_slice({s}, 3, 8), lambda b: {wc('b')} BETWEEN 8 AND 40), 1, 3)"
    tldr = f"array_to_string(list_slice({s}, 1, 2), ' ')"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE "
            f"{tldr} || {NL} || {NL} || 'Highlights:' || {NL} || "
            f"array_to_string(list_transform({bul}, lambda b: '- ' || b), {NL}) || {NL} || {NL} || 'Summary:' || {NL} || "
            f"substr(array_to_string({s}, ' '), 1, {C.SUMMARY_BODY_CHARS}) || {NL} || {NL} || 'Why it matters: ' || "
            f"CASE WHEN len({bul}) > 0 THEN ({bul})[1] ELSE {tldr} END END")


def json_q(x: str) -> str:
    ch = ("CASE WHEN c = '\"' THEN '\\\"' WHEN c = '\\' THEN '\\\\' WHEN c = chr(10) THEN '\\n' "
          "WHEN c = chr(13) THEN '\\r' WHEN c = chr(9) THEN '\\t' WHEN c = chr(8) THEN '\\b' WHEN c = chr(12) THEN '\\f' "
          "WHEN unicode(c) BETWEEN 32 AND 126 THEN c "
          "WHEN unicode(c) < 65536 THEN printf('\\u%04x', unicode(c)) "
          "ELSE printf('\\u%04x\\u%04x', 55296 + ((unicode(c) - 65536) >> 10), 56320 + ((unicode(c) - 65536) & 1023)) END")
    return (f"CASE WHEN {x} IS NULL THEN 'null' ELSE "
            f"'\"' || array_to_string(list_transform(string_split({x}, ''), lambda c: {ch}), '') || '\"' END")


def py_repr(x: str) -> str:
    return (f"CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"' || replace({x}, '\\', '\\\\') || '\"' "
            f"ELSE '''' || replace(replace({x}, '\\', '\\\\'), '''', '\\''') || '''' END")


def html_esc(x: str) -> str:
    s = f"replace({x}, '&', '&amp;')"
    for a, b in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = f"replace({s}, {q(a)}, {q(b)})"
    return s


def paragraphs(x: str) -> str:
    parts = f"list_filter(list_transform(string_split(coalesce({x}, ''), {NL} || {NL}), lambda p: {trim_ws('p')}), lambda p: p <> '')"
    return (f"array_to_string(list_transform({parts}, lambda p: '<p>' || replace({html_esc('p')}, {NL}, '<br/>') || '</p>'), "
            f"{NL} || {NL})")


def words(x: str) -> str:
    return f"list_filter(string_split_regex(coalesce({x}, ''), '\\s+'), lambda w: w <> '')"


def title_words(x: str, min_len: int, n: int) -> str:
    return f"list_slice(list_filter({words(x)}, lambda w: length(w) >= {min_len}), 1, {n})"


def read_time(x: str) -> str:
    return (f"CAST(CASE WHEN {x} IS NULL OR {x} = '' THEN 3 ELSE "
            f"greatest(2, least(8, CAST(floor({wc(x)} / 200) AS BIGINT) + 1)) END AS BIGINT)")


NUMERIC_REF = r"&#([xX][0-9a-fA-F]+|[0-9]+);?"

# The page-text SQL has patterns and tables of its own.
DROPPED = [
    r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->", r"(?is)<nav\b.*?</nav\s*>",
    r'(?is)<div class="ad".*?</div\s*>', r"(?is)<aside\b.*?</aside\s*>",
]
# The named references that the tables hold.
HTML_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0",
    "&copy;": "©", "&reg;": "®", "&middot;": "·", "&ndash;": "–",
    "&mdash;": "—", "&hellip;": "…", "&lsquo;": "‘", "&rsquo;": "’",
    "&ldquo;": "“", "&rdquo;": "”", "&amp;": "&",
}

# Numeric character references that HTML decodes to another character (the HTML standard's
# replacement table: NUL, CR and the Windows-1252 meanings of 0x80-0x9F), code point -> text.
CHARREF_REPLACEMENTS = {
    0x00: "\ufffd", 0x0D: "\r",
    0x80: "\u20ac", 0x81: "\x81", 0x82: "\u201a", 0x83: "\u0192", 0x84: "\u201e", 0x85: "\u2026",
    0x86: "\u2020", 0x87: "\u2021", 0x88: "\u02c6", 0x89: "\u2030", 0x8A: "\u0160", 0x8B: "\u2039",
    0x8C: "\u0152", 0x8D: "\x8d", 0x8E: "\u017d", 0x8F: "\x8f", 0x90: "\x90", 0x91: "\u2018",
    0x92: "\u2019", 0x93: "\u201c", 0x94: "\u201d", 0x95: "\u2022", 0x96: "\u2013", 0x97: "\u2014",
    0x98: "\u02dc", 0x99: "\u2122", 0x9A: "\u0161", 0x9B: "\u203a", 0x9C: "\u0153", 0x9D: "\x9d",
    0x9E: "\u017e", 0x9F: "\u0178",
}



def numeric_refs(t: str) -> str:
    """Decode numeric character references the way HTML does."""
    pat = q(NUMERIC_REF)
    cp = "(CASE WHEN lower(r[1]) = 'x' THEN TRY_CAST('0x' || r[2:] AS BIGINT) ELSE TRY_CAST(r AS BIGINT) END)"
    table = " ".join(f"WHEN {k} THEN chr({ord(v)})" for k, v in CHARREF_REPLACEMENTS.items())
    ch = (f"CASE WHEN {cp} IS NULL THEN chr(65533) WHEN {cp} IN ({', '.join(str(k) for k in CHARREF_REPLACEMENTS)}) "
          f"THEN (CASE {cp} {table} END) "
          f"WHEN {cp} BETWEEN 55296 AND 57343 OR {cp} > 1114111 THEN chr(65533) "
          f"WHEN {cp} BETWEEN 1 AND 8 OR {cp} = 11 OR {cp} BETWEEN 14 AND 31 OR {cp} BETWEEN 127 AND 159 "
          f"OR {cp} BETWEEN 64976 AND 65007 OR {cp} % 65536 >= 65534 THEN '' ELSE chr(CAST({cp} AS INTEGER)) END")
    chars = f"list_transform(regexp_extract_all({t}, {pat}, 1), lambda r: {ch})"
    pieces = f"string_split_regex({t}, {pat})"
    return (f"array_to_string(list_transform(range(1, len({pieces}) + 1), "
            f"lambda i: ({pieces})[i] || coalesce(({chars})[i], '')), '')")


def page_text(h: str) -> str:
    s = f"coalesce({h}, '')"
    for pat in DROPPED:
        s = f"regexp_replace({s}, {q(pat)}, '', 'g')"
    art = f"regexp_extract({s}, {q(r"(?is)<article\b[^>]*>(.*)</article\s*>")}, 1)"
    body = f"regexp_extract({s}, {q(r"(?is)<body\b[^>]*>(.*)</body\s*>")}, 1)"
    main = f"CASE WHEN {art} <> '' THEN {art} WHEN {body} <> '' THEN {body} ELSE {s} END"
    t = f"regexp_replace({main}, {q("(<[^>]*>)+")}, {NL}, 'g')"
    for ent, ch in HTML_ENTITIES.items():
        if ent != "&amp;":
            t = f"replace({t}, {q(ent)}, {q(ch)})"
    t = numeric_refs(t)
    t = f"regexp_replace({t}, '&amp;?', '&', 'g')"
    return trim_ws(t)


def display_short(ts: str) -> str:
    return f"strftime({ts}, '%b') || ' ' || lpad(CAST(day({ts}) AS VARCHAR), 2, ' ') || ', ' || strftime({ts}, '%Y')"


def clip_desc(x: str) -> str:
    d = f"replace(replace({trim_ws(f'coalesce({x}, {chr(39)}{chr(39)})')}, {NL}, ' '), '\"', '''')"
    return (f"CASE WHEN length({d}) > {C.DESCRIPTION_MAX} THEN "
            f"regexp_replace(substr({d}, 1, {C.DESCRIPTION_CUT}), ' [^ ]*$', '') || '...' ELSE {d} END")


# ---------------------------------------------------------------- shared views

ARTICLES = f"""
articles_v AS (
  SELECT doc_id AS id, substr(split_part(text, chr(10), 1), 1, 80) AS title,
         'https://' || source || '.example/' || CAST(doc_id AS VARCHAR) AS url,
         source, lang, text AS content, substr(text, 1, 800) AS summary,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((doc_id * 7919) % 129600 AS BIGINT)) AS published_ts
  FROM documents),
articles AS (
  SELECT *,
    CASE WHEN lang = 'en' THEN strftime(published_ts, '%a, %d %b %Y %H:%M:%S') || ' GMT'
         WHEN lang = 'fr' THEN strftime(published_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
         WHEN lang = 'de' THEN strftime(published_ts + INTERVAL 1 HOUR, '%a, %d %b %Y %H:%M:%S') || ' +0100'
         ELSE strftime(published_ts, '%Y-%m-%dT%H:%M:%S') END AS published,
    sha1(url) AS url_hash
  FROM articles_v),
seen_t AS (
  SELECT sha1(url) AS url_hash, url, published_ts + INTERVAL 1 DAY AS first_seen
  FROM articles WHERE id IN (SELECT doc_id FROM labels)),
memo_t AS (
  SELECT 'url:' || substr(sha1(url), 1, 16) AS cache_key, content AS value, 'article_text' AS content_type,
         published_ts AS created_at
  FROM articles WHERE id IN (SELECT doc_id FROM labels WHERE quality = 1)),
unseen AS (SELECT * FROM articles WHERE url_hash NOT IN (SELECT url_hash FROM seen_t))"""


def W(*ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return "WITH " + ARTICLES.strip() + extra + "\n"


SUMM_T = f"""summ_base AS (
  SELECT url, content, {sentences('content')} AS s FROM articles WHERE id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
summ_t AS (SELECT 'summary:' || substr(sha1(url), 1, 32) AS cache_key, {summary('s', 'content')} AS value FROM summ_base)"""

PAGES_T = f"""pages_t AS (
  SELECT a.url, {page_text('p.html')} AS full_text FROM pages p JOIN articles a ON p.page_id = a.id)"""

VEC = """vec AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
unit AS (
  SELECT id, CASE WHEN sqrt(list_sum(list_transform(v, lambda x: x * x))) > 0
             THEN list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y))))
             ELSE list_transform(v, lambda x: 0.0) END AS u FROM vec)"""


def topk_sql(k: int) -> str:
    return f"""hits AS (
  SELECT qid, id, score, rank FROM (
    SELECT q.id AS qid, a.id AS id, list_dot_product(q.u, a.u) AS score,
           row_number() OVER (PARTITION BY q.id ORDER BY list_dot_product(q.u, a.u) DESC, a.id) AS rank
    FROM unit q, unit a) WHERE rank <= {k})"""


def hashed_tfidf_sql(dim: int) -> str:
    """Unit tf-idf vectors of the articles, terms hashed by 32-bit MurmurHash3 (seed 42, as a signed number) modulo dim."""
    mul = lambda a, c: f"((({a})::UBIGINT * {c}::UBIGINT) & 4294967295::UBIGINT)"
    rotl = lambda a, r: f"(((({a})::UBIGINT << {r}) & 4294967295::UBIGINT) | (({a})::UBIGINT >> {32 - r}))"
    mixed = lambda k: mul(rotl(mul(k, 3432918353), 15), 461845907)
    step = f"(({mul(rotl('xor(h, k)', 13), 5)} + 3864292196::UBIGINT) & 4294967295::UBIGINT)"
    text = f"lower(coalesce(summary, '') || {NL} || {NL} || coalesce(content, ''))"
    return f"""term AS (SELECT id, unnest(regexp_extract_all({text}, '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}]+')) AS t FROM articles),
octets AS (
  SELECT t, len(x) AS n, x FROM (
    SELECT t, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS UBIGINT)) AS x
    FROM (SELECT t, hex(encode(t)) AS h FROM (SELECT DISTINCT t FROM term)))),
words4 AS (
  SELECT t, n, list_transform(range(0, n // 4), lambda i: x[4 * i + 1] + x[4 * i + 2] * 256 + x[4 * i + 3] * 65536 + x[4 * i + 4] * 16777216) AS ks,
         list_sum(list_transform(range(n // 4 * 4, n), lambda i: x[i + 1] * (1::UBIGINT << (8 * (i % 4)))))::UBIGINT AS tail FROM octets),
body AS (
  SELECT t, n, tail, list_reduce(list_transform(ks, lambda k: {mixed('k')}), lambda h, k: {step}, 42::UBIGINT) AS h FROM words4),
ended AS (SELECT t, xor(CASE WHEN tail IS NULL THEN h ELSE xor(h, {mixed('tail')}) END, n::UBIGINT) AS h FROM body),
fin1 AS (SELECT t, {mul('xor(h, h >> 16)', 2246822507)} AS h FROM ended),
fin2 AS (SELECT t, {mul('xor(h, h >> 13)', 3266489909)} AS h FROM fin1),
place AS (SELECT t, ((CASE WHEN z >= 2147483648 THEN z - 4294967296 ELSE z END) % {dim} + {dim}) % {dim} AS b FROM (SELECT t, xor(h, h >> 16)::BIGINT AS z FROM fin2)),
tf AS (SELECT id, b, count(*) AS c FROM term JOIN place USING (t) GROUP BY id, b),
idf AS (SELECT b, ln((n + 1)::DOUBLE / (count(*) + 1)) AS g FROM tf, (SELECT count(*) AS n FROM articles) GROUP BY b, n),
heavy AS (SELECT id, b, c * g AS x FROM tf JOIN idf USING (b) WHERE g > 0),
weight AS (SELECT id, b, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM heavy)"""


def md5_tfidf_sql(dim: int) -> str:
    """Unit tf-idf vectors of the articles, terms hashed by the first 32 bits of their MD5 modulo dim."""
    text = f"lower(coalesce(summary, '') || {NL} || {NL} || coalesce(content, ''))"
    return f"""term AS (SELECT id, unnest(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+')) AS t FROM articles),
tf AS (SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {dim} AS b, count(*) AS c FROM term GROUP BY ALL),
idf AS (SELECT b, ln((n + 1)::DOUBLE / (count(*) + 1)) AS g FROM tf, (SELECT count(*) AS n FROM articles) GROUP BY b, n),
heavy AS (SELECT id, b, c * g AS x FROM tf JOIN idf USING (b) WHERE g > 0),
weight AS (SELECT id, b, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM heavy)"""


def own_hits_sql(k: int) -> str:
    """The k most similar articles of each unseen one, by tf-idf of the hashed terms of summary and content."""
    text = f"lower(coalesce(summary, '') || {NL} || {NL} || coalesce(content, ''))"
    return f"""term AS (SELECT id, unnest(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+')) AS t FROM articles),
place AS (SELECT t, CAST('0x' || substr(md5(t), 1, 5) AS INTEGER) AS b FROM (SELECT DISTINCT t FROM term)),
tf AS (SELECT id, b, count(*) AS c FROM term JOIN place USING (t) GROUP BY id, b),
idf AS (SELECT b, ln((n + 1)::DOUBLE / (count(*) + 1)) AS g FROM tf, (SELECT count(*) AS n FROM articles) GROUP BY b, n),
heavy AS (SELECT id, b, c * g AS x FROM tf JOIN idf USING (b) WHERE g > 0),
weight AS (SELECT id, b, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM heavy),
hits AS (
  SELECT qid, id, score, rank FROM (
    SELECT q.id AS qid, a.id AS id, round(sum(q.x * a.x), 9) AS score,
           row_number() OVER (PARTITION BY q.id ORDER BY round(sum(q.x * a.x), 9) DESC, a.id) AS rank
    FROM weight q JOIN weight a USING (b) WHERE q.id IN (SELECT id FROM unseen) GROUP BY q.id, a.id) WHERE rank <= {k})"""


def evidence_sql(chars: int) -> str:
    return (f"ev AS (SELECT h.qid, string_agg('- ' || coalesce(a.published, 'None') || ': ' || coalesce(a.title, 'None') || "
            f"' (' || coalesce(a.source, 'None') || ')' || {NL} || '  ' || substr(coalesce(a.summary, ''), 1, {chars}) || {NL} || {NL}, '' "
            f"ORDER BY h.rank) AS evidence FROM hits h JOIN articles a ON a.id = h.id GROUP BY h.qid)")


def kw_counts_sql(batch: str) -> str:
    """per (id, pos, keyword) of `batch` titles: archive articles containing lower(keyword)."""
    return f"""kw AS (
  SELECT id, CAST(generate_subscripts(k, 1) - 1 AS BIGINT) AS pos, unnest(k) AS keyword
  FROM (SELECT id, {title_words('title', C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)} AS k FROM {batch})),
arch AS (SELECT lower(coalesce(title, '') || ' ' || coalesce(summary, '') || ' ' || coalesce(content, '')) AS text FROM articles),
kwd AS (SELECT DISTINCT lower(keyword) AS kw FROM kw),
kwc AS (SELECT kwd.kw, (SELECT count(*) FROM arch WHERE contains(arch.text, kwd.kw)) AS n FROM kwd),
counts AS (SELECT kw.id, kw.pos, kw.keyword, CAST(kwc.n AS BIGINT) AS mentions FROM kw JOIN kwc ON lower(kw.keyword) = kwc.kw)"""


def mention_sql(n_kw: int, days: int) -> str:
    return f"""kws AS (SELECT DISTINCT keyword FROM (
  SELECT unnest(k) AS keyword, generate_subscripts(k, 1) AS p
  FROM (SELECT {title_words('title', C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)} AS k FROM unseen)) WHERE p <= {n_kw}),
arch AS (SELECT lower(coalesce(title, '') || ' ' || coalesce(summary, '') || ' ' || coalesce(content, '')) AS text,
                published_ts AS ts FROM articles),
bounds AS (SELECT date_trunc('day', min(ts)) AS origin, max(ts) AS mx FROM arch),
binned AS (SELECT text, origin + to_seconds(CAST(floor(epoch(ts - origin) / {days * 86400}) AS BIGINT) * {days * 86400}) AS bin_start
           FROM arch, bounds),
spine AS (SELECT kws.keyword, unnest(generate_series(b.origin,
            b.origin + to_seconds(CAST(floor(epoch(b.mx - b.origin) / {days * 86400}) AS BIGINT) * {days * 86400}),
            INTERVAL {days} DAY)) AS bin_start FROM kws, bounds b),
cnt AS (SELECT kws.keyword, binned.bin_start, count(*) AS n FROM kws JOIN binned ON contains(binned.text, lower(kws.keyword))
        GROUP BY ALL)"""


def feed_sql() -> str:
    return """entries AS (
  SELECT id, source, lang, content, published_ts, substr(split_part(content, chr(10), 1), 1, 80) AS e_title, url AS e_link,
         CAST(floor(id / 100) AS BIGINT) AS g,
         row_number() OVER (PARTITION BY source, CAST(floor(id / 100) AS BIGINT) ORDER BY id) - 1 AS entry_pos,
         row_number() OVER (PARTITION BY source, CAST(floor(id / 100) AS BIGINT), coalesce(lang, '') IN ('en', 'de')
                            ORDER BY id) - 1 AS kind_pos
  FROM articles),
rss AS (
  SELECT 'https://' || source || '.example/feed/' || CAST(g AS VARCHAR) || '.xml' AS feed_url, CAST(entry_pos AS BIGINT) AS entry_pos,
         CAST(kind_pos AS BIGINT) AS kind_pos,
         trim(e_title) AS title, e_link AS link, substr(content, 1, 1000) AS summary,
         strftime(published_ts, '%a, %d %b %Y %H:%M:%S') || ' GMT' AS published, source, lang
  FROM entries),
js AS (
  SELECT 'https://www.reddit.com/r/' || source || '/' || CAST(g AS VARCHAR) || '.json' AS feed_url, CAST(entry_pos AS BIGINT) AS entry_pos,
         CAST(kind_pos AS BIGINT) AS kind_pos,
         e_title AS title, 'https://reddit.com/r/' || source || '/comments/' || CAST(id AS VARCHAR) AS link,
         substr(content, 1, 500) AS summary, strftime(published_ts, '%Y-%m-%dT%H:%M:%S') AS published, 'Reddit' AS source, lang
  FROM entries)"""


def _sources_values() -> str:
    return ", ".join(f"({i}, {q(u)})" for i, u in enumerate(C.DEFAULT_SOURCES))


ITEM_COLS = "feed_url, entry_pos, title, link, summary, published, source"


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["archive_scan"] = W() + "SELECT CAST(id AS BIGINT) AS id, title, url, source, published, published_ts, summary, content FROM articles"
    o["embedding_scan"] = ("SELECT CAST(vec_id AS BIGINT) AS id, CAST(len(embedding) AS BIGINT) AS dim, "
                           "round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 4) AS norm "
                           "FROM embeddings WHERE embedding IS NOT NULL")
    o["rss_ingest"] = W(feed_sql()) + f"SELECT {ITEM_COLS} FROM rss WHERE entry_pos < {C.ENTRIES_PER_FEED}"
    o["json_feed_normalise"] = W(feed_sql()) + f"SELECT {ITEM_COLS} FROM js"
    kind_cols = ITEM_COLS.replace("entry_pos", "kind_pos AS entry_pos")
    o["feed_union"] = W(feed_sql()) + (f"SELECT {kind_cols} FROM rss WHERE coalesce(lang, '') IN ('en', 'de') AND kind_pos < {C.ENTRIES_PER_FEED} "
                                       f"UNION ALL SELECT {kind_cols} FROM js WHERE coalesce(lang, '') NOT IN ('en', 'de')")
    o["stream_feed_ingest"] = o["feed_union"]
    o["feed_rejects"] = W(feed_sql()) + (
        "SELECT f.feed_url, f.kind, CASE g % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN if(f.kind = 'json', 'malformed', 'not a feed') "
        "WHEN 2 THEN 'empty' ELSE 'no entries' END AS reason "
        "FROM (SELECT DISTINCT feed_url, g, kind FROM (SELECT feed_url, 'rss' AS kind FROM rss WHERE coalesce(lang, '') IN ('en', 'de') "
        "UNION ALL SELECT feed_url, 'json' FROM js WHERE coalesce(lang, '') NOT IN ('en', 'de')) "
        "CROSS JOIN LATERAL (SELECT CAST(regexp_extract(feed_url, '/([0-9]+)[.][a-z]+$', 1) AS BIGINT) AS g)) f WHERE g % 5 < 4")
    o["source_list_dedup"] = W() + (
        f"SELECT CAST(min(pos) AS BIGINT) AS pos, url FROM ("
        f"SELECT * FROM (VALUES {_sources_values()}) d(pos, url) "
        f"UNION ALL SELECT id + {len(C.DEFAULT_SOURCES)} AS pos, 'https://' || source || '.example/rss.xml' AS url FROM articles) "
        f"WHERE url IS NOT NULL GROUP BY url")
    o["seen_import"] = W() + (f"SELECT url_hash, url, first_seen FROM seen_t UNION ALL "
                              f"SELECT DISTINCT url_hash, CAST(NULL AS VARCHAR) AS url, {AS_OF} AS first_seen FROM articles "
                              f"WHERE url_hash NOT IN (SELECT url_hash FROM seen_t)")
    o["page_text"] = (f"SELECT CAST(page_id AS BIGINT) AS page_id, url, substr(t, 1, {C.ARTICLE_TEXT_CHARS}) AS page_text, "
                      f"CAST(length(t) AS BIGINT) AS full_chars FROM (SELECT page_id, url, {page_text('html')} AS t FROM pages)")
    o["markdown_brief"] = W(f"b AS (SELECT id, title, url, summary, content, {sentences('content')} AS s FROM unseen)") + (
        f"SELECT CAST(id AS BIGINT) AS id, strftime({RUN_TS}, '%Y-%m-%d') || '-' || CAST(id AS VARCHAR) || '.md' AS md_name, "
        f"'---' || {NL} || 'title: ' || {json_q('title')} || {NL} || 'date: ' || "
        f"{json_q(f'strftime({RUN_TS}, {q(chr(37) + 'Y-' + chr(37) + 'm-' + chr(37) + 'dT' + chr(37) + 'H:' + chr(37) + 'M:' + chr(37) + 'S')}) || {q('+00:00')}')}"
        f" || {NL} || 'sources: [' || {json_q('url')} || ']' || {NL} || 'summary: ' || {json_q('substr(coalesce(summary, ' + q('') + '), 1, 200)')} || "
        f"{NL} || '---' || {NL} || {NL} || coalesce({summary('s', 'content')}, '') AS markdown FROM b")
    card_cols = (f"CAST(pos AS BIGINT) AS pos, coalesce(nullif(title, ''), '(untitled)') AS title, "
                 f"{trim_ws('coalesce(summary, ' + q('') + ')')} AS summary, {display_short('published_ts')} AS date, "
                 f"{read_time('coalesce(summary, ' + q('') + ')')} AS read_time, "
                 f"'/previews/' || strftime(published_ts, '%Y-%m-%d') || '-' || CAST(id AS VARCHAR) || '.html' AS url, "
                 f"coalesce(source, '') AS source")
    o["home_feed"] = W(
        f"top AS (SELECT * FROM articles ORDER BY published_ts DESC NULLS LAST, id LIMIT {C.HOME_FEED_SIZE})",
        "ranked AS (SELECT *, row_number() OVER (ORDER BY published_ts DESC NULLS LAST, id) - 1 AS pos FROM top)") + (
        f"SELECT 'briefs' AS section, {card_cols} FROM ranked UNION ALL "
        f"SELECT 'top_insights' AS section, {card_cols} FROM ranked WHERE pos < {C.TOP_INSIGHTS} "
        + "".join(f"UNION ALL SELECT 'features', {i}, {q(f['title'])}, {q(f['summary'])}, {q(f['date'])}, {f['read_time']}, {q(f['url'])}, NULL "
                  for i, f in enumerate(C.STATIC_FEATURES)))
    o["seo_metadata"] = W() + (
        f"SELECT CAST(id AS BIGINT) AS id, {trim_ws('CASE WHEN title IS NULL OR title = ' + q('') + ' THEN ' + q(C.Site().name) + ' ELSE title END')} AS seo_title, "
        f"{clip_desc('substr(summary, 1, 300)')} AS seo_description, "
        f"{q(C.Site().url.rstrip('/') + '/')} || 'previews/' || strftime({RUN_TS}, '%Y-%m-%d') || '-' || CAST(id AS VARCHAR) || '.html' AS canonical_url, "
        f"{q(C.Site().og_image)} AS og_image, coalesce(nullif(published, ''), 'now') AS date_published, "
        f"CASE WHEN len({title_words('title', C.TAG_MIN_LEN, C.TAGS_PER_TITLE)}) > 0 "
        f"THEN array_to_string({title_words('title', C.TAG_MIN_LEN, C.TAGS_PER_TITLE)}, ',') END AS keywords FROM unseen")
    base = C.Site().url.rstrip("/") + "/"
    fields = o["seo_metadata"]
    ld = ("json_object('@context', 'https://schema.org', '@type', 'Article', 'mainEntityOfPage', json_object('@type', 'WebPage', '@id', canonical_url), "
          "'headline', seo_title, 'description', seo_description, 'image', json_array(og_image), 'datePublished', date_published, 'dateModified', date_published, "
          f"'author', json_object('@type', 'Person', 'name', coalesce(source, {q(C.Site().author)})), 'publisher', json_object('@type', 'Organization', 'name', {q(C.Site().name)}, "
          f"'logo', json_object('@type', 'ImageObject', 'url', {q(base + C.Site().logo_path.lstrip('/'))}))")
    ld = f"CASE WHEN keywords IS NULL THEN {ld}) ELSE {ld}, 'keywords', keywords) END"
    o["seo_metadata"] = (f"SELECT s.*, '<script type=\"application/ld+json\">' || CAST({ld} AS VARCHAR) || '</script>' AS json_ld "
                         f"FROM ({fields}) s JOIN (SELECT doc_id, source FROM documents) d ON d.doc_id = s.id")
    names = W("p AS (SELECT strftime(a.published_ts, '%Y-%m-%d') || '-' || CAST(page_id AS VARCHAR) || '.html' AS name, a.published_ts AS ts "
              "FROM pages JOIN articles a ON a.id = page_id)")
    entry = (f"name, {q(base + 'previews/')} || name AS loc, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS lastmod, 'daily' AS changefreq, '0.6' AS priority")
    o["sitemap_entries"] = names + f"SELECT {entry} FROM p"
    head = "'<?xml version=''1.0'' encoding=''UTF-8''?>' || chr(10) || "
    o["sitemap_documents"] = names + (
        f"SELECT 'sitemap-' || CAST(part AS VARCHAR) || '.xml' AS name, {head}'<urlset xmlns=''http://www.sitemaps.org/schemas/sitemap/0.9''>' || chr(10) || "
        "string_agg('  <url>' || chr(10) || '    <loc>' || loc || '</loc>' || chr(10) || '    <lastmod>' || lastmod || '</lastmod>' || chr(10) || '    <changefreq>daily</changefreq>' || chr(10) || "
        "'    <priority>0.6</priority>' || chr(10) || '  </url>', chr(10) ORDER BY name) || chr(10) || '</urlset>' || chr(10) AS value "
        f"FROM (SELECT {entry}, (row_number() OVER (ORDER BY name) - 1) // 50000 AS part FROM p) GROUP BY part UNION ALL "
        f"SELECT 'sitemap.xml', {head}'<sitemapindex xmlns=''http://www.sitemaps.org/schemas/sitemap/0.9''>' || chr(10) || "
        f"string_agg('  <sitemap>' || chr(10) || '    <loc>' || {q(base)} || 'sitemap-' || CAST(k AS VARCHAR) || '.xml</loc>' || chr(10) || '  </sitemap>', chr(10) ORDER BY k) || chr(10) || '</sitemapindex>' || chr(10) "
        "FROM (SELECT unnest(range(0, (count(*) + 49999) // 50000)) AS k FROM p)")
    short, long_ = display_short("published_ts"), "strftime(published_ts, '%B %d, %Y')"
    o["card_aliases"] = W() + (
        "SELECT CAST(id AS BIGINT) AS id, coalesce(nullif(CASE WHEN id % 7 <> 0 THEN title END, ''), 'Untitled brief') AS title, "
        "coalesce(nullif(CASE WHEN lang = 'en' THEN summary END, ''), nullif(substr(content, 1, 40), ''), '') AS summary, "
        f"coalesce(CASE WHEN lang = 'fr' THEN {long_} END, CASE WHEN coalesce(lang, '') <> 'es' THEN nullif(published, '') END, '') AS date_long, "
        f"coalesce(CASE WHEN lang = 'en' THEN {short} WHEN lang = 'fr' THEN {long_} END, CASE WHEN coalesce(lang, '') <> 'es' THEN nullif(published, '') END, '') AS date_short, "
        "coalesce(CASE WHEN id % 2 = 0 THEN nullif(url, '') END, CASE WHEN id % 3 = 0 THEN '/p/' || CAST(id AS VARCHAR) END, '#') AS link FROM articles")
    o["paragraph_markup"] = W(f"b AS (SELECT id, content, {sentences('content')} AS s FROM articles)") + (
        f"SELECT CAST(id AS BIGINT) AS id, {paragraphs(summary('s', 'content'))} AS content_html FROM b")
    o["run_metrics"] = W(
        SUMM_T, PAGES_T,
        f"cand AS (SELECT a.*, sm.value AS cached_summary, mm.value AS memo_text, pt.full_text AS page_full FROM unseen a "
        f"LEFT JOIN summ_t sm ON sm.cache_key = 'summary:' || substr(a.url_hash, 1, 32) "
        f"LEFT JOIN memo_t mm ON mm.cache_key = 'url:' || substr(sha1(a.url), 1, 16) "
        f"LEFT JOIN pages_t pt ON pt.url = a.url)",
        f"txt AS (SELECT *, CASE WHEN cached_summary IS NOT NULL THEN coalesce(nullif(memo_text, ''), summary) "
        f"WHEN length(summary) > {C.FEED_SUMMARY_MIN_CHARS} THEN summary "
        f"ELSE coalesce(nullif(substr(coalesce(nullif(memo_text, ''), nullif(page_full, '')), 1, {C.ARTICLE_TEXT_CHARS}), ''), summary) END AS article_text FROM cand)",
        f"sb AS (SELECT *, {sentences('article_text')} AS s FROM txt)",
        f"br AS (SELECT id, cached_summary, coalesce(cached_summary, {summary('s', 'article_text')}) AS content FROM sb)",
        kw_counts_sql("unseen"),
        f"kvd AS (SELECT id, keyword, min(pos) AS pos, max(mentions) AS n FROM counts GROUP BY id, keyword)",
        f"kvs AS (SELECT id, '{{' || string_agg({py_repr('keyword')} || ': ' || CAST(n AS VARCHAR), ', ' ORDER BY pos) || '}}' AS d FROM kvd GROUP BY id)",
        f"ins AS (SELECT u.id, substr(coalesce(u.summary, ''), 1, 200) || {NL} || {NL} || 'Highlights:' || {NL} || "
        f"'- {C.INSIGHT_BULLET_1}' || {NL} || '- Keywords: ' || coalesce(nullif(array_to_string({title_words('u.title', C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)}, ', '), ''), 'n/a') || "
        f"'. Counts: ' || coalesce(kvs.d, '{{}}') || '.' || {NL} || '- {C.INSIGHT_BULLET_3}' || {NL} || {NL} || 'Prediction:' || {NL} || "
        f"{q(C.INSIGHT_PREDICTION)} AS insight FROM unseen u LEFT JOIN kvs ON u.id = kvs.id)") + (
        "SELECT CAST((SELECT count(*) FROM articles) AS BIGINT) AS items, CAST((SELECT count(*) FROM unseen) AS BIGINT) AS candidates, "
        "CAST(count(content) AS BIGINT) AS summaries, CAST(count(*) FILTER (WHERE cached_summary IS NULL AND content IS NOT NULL) AS BIGINT) AS fallback_used, "
        "CAST(count(cached_summary) AS BIGINT) AS cache_reused, CAST(sum(length(content)) AS BIGINT) AS content_chars, "
        "CAST((SELECT sum(length(insight)) FROM ins) AS BIGINT) AS insight_chars FROM br")
    ev = "ev AS (SELECT user_id, event_id, CAST(ts AS TIMESTAMP) AS ts, event_type, value FROM events)"
    o["seen_keep_first"] = (
        f"WITH {ev}, ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r "
        f"FROM ev WHERE event_type = 'view') WHERE r = 1), "
        f"nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r "
        f"FROM ev WHERE event_type <> 'view') WHERE r = 1 AND user_id NOT IN (SELECT user_id FROM ex)) "
        f"SELECT CAST(user_id AS BIGINT) AS user_id, CAST(event_id AS BIGINT) AS event_id, ts, event_type FROM ex "
        f"UNION ALL SELECT CAST(user_id AS BIGINT), CAST(event_id AS BIGINT), ts, event_type FROM nb")
    o["upsert_keep_last"] = (
        f"WITH {ev}, ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r "
        f"FROM ev WHERE event_type = 'view') WHERE r = 1), "
        f"nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r "
        f"FROM ev WHERE event_type <> 'view') WHERE r = 1) "
        f"SELECT CAST(user_id AS BIGINT) AS user_id, CAST(event_id AS BIGINT) AS event_id, ts, event_type, value FROM nb "
        f"UNION ALL SELECT CAST(user_id AS BIGINT), CAST(event_id AS BIGINT), ts, event_type, value FROM ex "
        f"WHERE user_id NOT IN (SELECT user_id FROM nb)")
    o["memo_upsert"] = (
        "WITH u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r "
        "FROM conversations WHERE role = 'user') WHERE r = 1), "
        "a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r "
        "FROM conversations WHERE role = 'assistant') WHERE r = 1) "
        "SELECT 'summary:' || CAST(conv_id AS VARCHAR) AS cache_key, text AS value, 'summary' AS content_type, "
        "TIMESTAMP '2024-02-01 00:00:00' AS created_at FROM a UNION ALL "
        "SELECT 'summary:' || CAST(conv_id AS VARCHAR), text, 'summary', TIMESTAMP '2024-01-01 00:00:00' FROM u "
        "WHERE conv_id NOT IN (SELECT conv_id FROM a)")
    o["memo_delete"] = W() + (
        "SELECT cache_key, value, content_type, created_at FROM memo_t WHERE cache_key NOT IN ("
        "SELECT 'url:' || substr(sha1(url), 1, 16) FROM articles WHERE id IN (SELECT doc_id FROM labels WHERE toxic = 1))")
    o["snapshot_delete"] = o["memo_delete"]
    cols = "CAST(user_id AS BIGINT) AS user_id, CAST(event_id AS BIGINT) AS event_id, ts, event_type, value"
    o["snapshot_merge"] = (
        f"WITH {ev}, ranked AS (SELECT *, event_type = 'view' AS old, row_number() OVER (PARTITION BY user_id, event_type = 'view' ORDER BY ts, event_id) AS first, "
        f"row_number() OVER (PARTITION BY user_id, event_type = 'view' ORDER BY ts DESC, event_id DESC) AS last FROM ev), "
        f"had AS (SELECT DISTINCT user_id FROM ranked WHERE old), got AS (SELECT DISTINCT user_id FROM ranked WHERE NOT old) "
        f"SELECT {cols} FROM ranked WHERE old AND last = 1 AND (user_id % 2 = 0 OR user_id NOT IN (SELECT user_id FROM got)) "
        f"UNION ALL SELECT {cols} FROM ranked WHERE NOT old AND user_id % 2 = 0 AND first = 1 AND user_id NOT IN (SELECT user_id FROM had) "
        f"UNION ALL SELECT {cols} FROM ranked WHERE NOT old AND user_id % 2 = 1 AND last = 1")
    o["feed_recency_sort"] = W() + "SELECT CAST(id AS BIGINT) AS id, published, published_ts FROM articles"
    o["newest_unseen"] = W() + ("SELECT CAST(id AS BIGINT) AS id, url_hash, published_ts FROM unseen "
                                "ORDER BY published_ts DESC NULLS LAST, id LIMIT 10")
    o["latest_n"] = W() + (f"SELECT CAST(id AS BIGINT) AS id, title, published_ts FROM articles "
                           f"ORDER BY published_ts DESC NULLS LAST, id LIMIT {C.HOME_FEED_SIZE}")
    o["top_insights"] = W() + (f"SELECT CAST(row_number() OVER (ORDER BY published_ts DESC NULLS LAST, id) - 1 AS BIGINT) AS pos, title "
                               f"FROM articles ORDER BY published_ts DESC NULLS LAST, id LIMIT {C.TOP_INSIGHTS}")
    o["recent_slice"] = W() + (
        f"SELECT CASE WHEN pos = 0 THEN 'latest' ELSE 'recent' END AS slot, pos, id, title FROM ("
        f"SELECT CAST(row_number() OVER (ORDER BY published_ts DESC NULLS LAST, id) - 1 AS BIGINT) AS pos, CAST(id AS BIGINT) AS id, title "
        f"FROM articles) WHERE pos <= {C.RECENT_SLICE}")
    o["seen_history"] = ("SELECT sha1('evt:' || CAST(event_id AS VARCHAR)) AS url_hash, "
                         "'https://events.example/' || CAST(event_id AS VARCHAR) AS url, CAST(ts AS TIMESTAMP) AS first_seen FROM events")
    o["unseen_anti"] = W() + "SELECT CAST(id AS BIGINT) AS id, url_hash FROM unseen"
    o["seen_semi"] = W() + "SELECT CAST(id AS BIGINT) AS id, url_hash FROM articles WHERE url_hash IN (SELECT url_hash FROM seen_t)"
    o["memo_lookup"] = W() + ("SELECT CAST(a.id AS BIGINT) AS id, 'url:' || substr(sha1(a.url), 1, 16) AS cache_key, "
                              "nullif(m.value, '') AS cached FROM articles a LEFT JOIN memo_t m ON m.cache_key = 'url:' || substr(sha1(a.url), 1, 16)")
    o["text_fallback_chain"] = W(
        SUMM_T, PAGES_T,
        f"cand AS (SELECT a.*, nullif(sm.value, '') AS cached_summary, nullif(mm.value, '') AS memo_text, nullif(pt.full_text, '') AS page_full FROM articles a "
        f"LEFT JOIN summ_t sm ON sm.cache_key = 'summary:' || substr(a.url_hash, 1, 32) "
        f"LEFT JOIN memo_t mm ON mm.cache_key = 'url:' || substr(sha1(a.url), 1, 16) "
        f"LEFT JOIN pages_t pt ON pt.url = a.url)") + (
        f"SELECT CAST(id AS BIGINT) AS id, "
        f"CASE WHEN cached_summary IS NOT NULL AND memo_text IS NOT NULL THEN 'summary_hit_memo_text' "
        f"WHEN cached_summary IS NOT NULL THEN 'summary_hit_feed_summary' "
        f"WHEN length(summary) > {C.FEED_SUMMARY_MIN_CHARS} THEN 'feed_summary' "
        f"WHEN memo_text IS NOT NULL THEN 'memo_text' WHEN page_full IS NOT NULL THEN 'page_text' ELSE 'feed_fallback' END AS text_path, "
        f"CASE WHEN cached_summary IS NOT NULL THEN coalesce(memo_text, summary) "
        f"WHEN length(summary) > {C.FEED_SUMMARY_MIN_CHARS} THEN summary "
        f"ELSE coalesce(nullif(substr(coalesce(memo_text, page_full), 1, {C.ARTICLE_TEXT_CHARS}), ''), summary) END AS article_text FROM cand")
    o["title_dup_anti"] = W("ot AS (SELECT DISTINCT lower(substr(text, 1, 80)) AS t FROM benchmark)") + (
        "SELECT CAST(id AS BIGINT) AS id, title FROM articles a WHERE NOT EXISTS ("
        "SELECT 1 FROM ot WHERE contains(ot.t, lower(substr(coalesce(a.title, ''), 1, 60))))")
    o["url_keys"] = W() + ("SELECT CAST(id AS BIGINT) AS id, substr(sha1(url), 1, 8) AS short_id, sha1(url) AS url_hash, "
                           "'url:' || substr(sha1(url), 1, 16) AS url_key, 'summary:' || substr(sha1(url), 1, 32) AS summary_key FROM articles")
    o["sentence_split"] = W(f"b AS (SELECT id, {sentences('content')} AS s FROM articles)") + (
        "SELECT CAST(id AS BIGINT) AS id, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS pos, unnest(s) AS sentence FROM b")
    o["extractive_summary"] = W(f"b AS (SELECT id, content, {sentences('content')} AS s FROM articles)") + (
        f"SELECT CAST(id AS BIGINT) AS id, {summary('s', 'content')} AS summary FROM b")
    o["read_time"] = W() + (f"SELECT CAST(id AS BIGINT) AS id, {read_time('summary')} AS summary_minutes, "
                            f"{read_time('content')} AS content_minutes FROM articles")
    o["title_keywords"] = W(
        f"b AS (SELECT id, {title_words('title', C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)} AS k, "
        f"{title_words('title', C.TAG_MIN_LEN, C.TAGS_PER_TITLE)} AS t FROM articles)") + (
        "SELECT CAST(id AS BIGINT) AS id, 'keyword' AS kind, CAST(generate_subscripts(k, 1) - 1 AS BIGINT) AS pos, unnest(k) AS word FROM b "
        "UNION ALL SELECT CAST(id AS BIGINT), 'tag', CAST(generate_subscripts(t, 1) - 1 AS BIGINT), unnest(t) FROM b")
    o["published_parse"] = W() + (f"SELECT CAST(id AS BIGINT) AS id, published, published_ts, {display_short('published_ts')} AS date_short, "
                                  f"strftime(published_ts, '%B %d, %Y') AS date_long FROM articles")
    o["home_cards"] = W() + (
        f"SELECT CAST(id AS BIGINT) AS id, coalesce(nullif(title, ''), '(untitled)') AS title, "
        f"{trim_ws('coalesce(summary, ' + q('') + ')')} AS summary, {display_short('published_ts')} AS date, "
        f"{read_time('coalesce(summary, ' + q('') + ')')} AS read_time, "
        f"'/previews/' || strftime(published_ts, '%Y-%m-%d') || '-' || CAST(id AS VARCHAR) || '.html' AS url, coalesce(source, '') AS source FROM articles")
    res = ("CASE WHEN raw IS NULL OR raw = '' THEN '#' WHEN starts_with(raw, 'http') THEN raw "
           "WHEN starts_with(raw, base) THEN raw WHEN starts_with(raw, '/') THEN base || raw ELSE base || '/' || raw END")
    o["link_resolve"] = W(
        "l AS (SELECT id, 'card' AS kind, '/previews/' || CAST(id AS VARCHAR) || '.html' AS raw FROM articles "
        "UNION ALL SELECT id, 'absolute', url FROM articles "
        "UNION ALL SELECT id, 'relative', 'previews/' || CAST(id AS VARCHAR) || '.html' FROM articles "
        "UNION ALL SELECT id, 'empty', '' FROM articles)",
        "lb AS (SELECT l.*, b.base FROM l, (VALUES (''), ('/site')) b(base))") + (
        f"SELECT CAST(id AS BIGINT) AS id, kind, base, {res} AS resolved FROM lb")
    o["similar_topk"] = f"WITH {VEC}, {topk_sql(C.SIMILAR_K_SEARCH)} " + (
        "SELECT CAST(qid AS BIGINT) AS qid, CAST(rank AS BIGINT) AS rank, CAST(id AS BIGINT) AS id, round(score, 4) AS score FROM hits")
    o["keyword_counts"] = W(kw_counts_sql("unseen")) + (
        "SELECT CAST(id AS BIGINT) AS id, pos, keyword, mentions FROM counts")
    o["keyword_counts_regex"] = W(
        kw_counts_sql("unseen"),
        "both_kw AS (SELECT id, pos * 2 AS pos, keyword FROM kw UNION ALL SELECT id, pos * 2 + 1, substr(keyword, 1, 1) || '.' || substr(keyword, 3) FROM kw)",
        "pattern AS (SELECT kw, TRY(regexp_matches('', kw)) IS NOT NULL AS ok FROM (SELECT DISTINCT lower(keyword) AS kw FROM both_kw))",
        "found AS (SELECT kw, count(*) FILTER (WHERE regexp_matches(arch.text, kw)) AS n FROM (SELECT kw FROM pattern WHERE ok) p, arch GROUP BY kw)") + (
        "SELECT CAST(id AS BIGINT) AS id, CAST(pos AS BIGINT) AS pos, keyword, CAST(found.n AS BIGINT) AS mentions FROM both_kw LEFT JOIN found ON found.kw = lower(keyword)")
    o["mention_series"] = W(mention_sql(1, C.MENTION_BIN_DAYS)) + (
        "SELECT s.keyword, s.bin_start, CAST(coalesce(c.n, 0) AS BIGINT) AS mentions FROM spine s "
        "LEFT JOIN cnt c ON c.keyword = s.keyword AND c.bin_start = s.bin_start")
    o["mention_index_series"] = o["mention_series"]
    o["mention_series_multi"] = W(mention_sql(C.KEYWORDS_PER_TITLE, C.INSIGHT_BIN_DAYS)) + (
        "SELECT s.keyword, s.bin_start, CAST(coalesce(c.n, 0) AS BIGINT) AS mentions FROM spine s "
        "LEFT JOIN cnt c ON c.keyword = s.keyword AND c.bin_start = s.bin_start")
    o["stream_keyword_mentions"] = W(mention_sql(C.KEYWORDS_PER_TITLE, C.MENTION_BIN_DAYS)) + (
        "SELECT s.keyword, s.bin_start, CAST(coalesce(c.n, 0) AS BIGINT) AS mentions FROM spine s "
        "LEFT JOIN cnt c ON c.keyword = s.keyword AND c.bin_start = s.bin_start")
    o["evidence_text"] = W(VEC, topk_sql(C.SIMILAR_K_INSIGHT)) + (
        f"SELECT CAST(h.qid AS BIGINT) AS qid, string_agg('- ' || coalesce(a.published, 'None') || ': ' || coalesce(a.title, 'None') || "
        f"' (' || coalesce(a.source, 'None') || ')' || {NL} || '  ' || substr(coalesce(a.summary, ''), 1, {C.EVIDENCE_SUMMARY_CHARS}) || {NL} || {NL}, '' "
        f"ORDER BY h.rank) AS evidence FROM hits h JOIN articles a ON a.id = h.id GROUP BY h.qid")
    o["insight_fallback"] = W(
        kw_counts_sql("unseen"),
        "kvd AS (SELECT id, keyword, min(pos) AS pos, max(mentions) AS n FROM counts GROUP BY id, keyword)",
        f"kvs AS (SELECT id, '{{' || string_agg({py_repr('keyword')} || ': ' || CAST(n AS VARCHAR), ', ' ORDER BY pos) || '}}' AS d FROM kvd GROUP BY id)") + (
        f"SELECT CAST(u.id AS BIGINT) AS id, substr(coalesce(u.summary, ''), 1, 200) || {NL} || {NL} || 'Highlights:' || {NL} || "
        f"'- {C.INSIGHT_BULLET_1}' || {NL} || '- Keywords: ' || coalesce(nullif(array_to_string({title_words('u.title', C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)}, ', '), ''), 'n/a') || "
        f"'. Counts: ' || coalesce(kvs.d, '{{}}') || '.' || {NL} || '- {C.INSIGHT_BULLET_3}' || {NL} || {NL} || 'Prediction:' || {NL} || "
        f"{q(C.INSIGHT_PREDICTION)} AS insight FROM unseen u LEFT JOIN kvs ON u.id = kvs.id")
    o["insight_archive"] = W() + (
        f"SELECT CAST(id AS BIGINT) AS id, substr(coalesce(summary, ''), 1, 200) || {NL} || {NL} || 'Highlights:' || {NL} || "
        f"{q('- ' + C.ARCHIVE_INSIGHT_BULLET_1)} || {NL} || {q('- ' + C.ARCHIVE_INSIGHT_BULLET_2_PREFIX)} || "
        f"array_to_string({title_words('title', C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)}, ', ') || {q(C.ARCHIVE_INSIGHT_BULLET_2_SUFFIX)} || "
        f"{NL} || {q('- ' + C.ARCHIVE_INSIGHT_BULLET_3)} || {NL} || {NL} || 'Prediction:' || {NL} || {q(C.ARCHIVE_INSIGHT_PREDICTION)} AS insight "
        f"FROM unseen")
    o["insight_prompt"] = W(
        kw_counts_sql("unseen"),
        "kvd AS (SELECT id, keyword, min(pos) AS pos, max(mentions) AS n FROM counts GROUP BY id, keyword)",
        f"kvj AS (SELECT id, '{{' || string_agg({json_q('keyword')} || ': ' || CAST(n AS VARCHAR), ', ' ORDER BY pos) || '}}' AS d FROM kvd GROUP BY id)",
        own_hits_sql(C.SIMILAR_K_INSIGHT), evidence_sql(C.EVIDENCE_SUMMARY_CHARS)) + (
        f"SELECT CAST(u.id AS BIGINT) AS id, {q(C.INSIGHT_PROMPT_SYSTEM)} AS system, "
        f"'Article:' || {NL} || coalesce(u.title, 'None') || {NL} || {NL} || 'Summary:' || {NL} || coalesce(u.summary, 'None') || "
        f"{NL} || {NL} || 'Similar past items:' || {NL} || coalesce(ev.evidence, '') || {NL} || {NL} || 'Keyword counts:' || {NL} || "
        f"coalesce(kvj.d, '{{}}') || {NL} || {NL} || {q(C.INSIGHT_PROMPT_ASK)} AS user "
        f"FROM unseen u LEFT JOIN ev ON ev.qid = u.id LEFT JOIN kvj ON kvj.id = u.id")
    o["similar_articles"] = W(own_hits_sql(C.SIMILAR_K_INSIGHT)) + (
        "SELECT CAST(qid AS BIGINT) AS qid, CAST(rank AS BIGINT) AS rank, CAST(id AS BIGINT) AS id, round(score, 6) AS score FROM hits")
    o["insight_archive_prompt"] = W(
        mention_sql(C.KEYWORDS_PER_TITLE, C.INSIGHT_BIN_DAYS),
        f"lists AS (SELECT keyword, '[' || string_agg(CAST(coalesce(n, 0) AS VARCHAR), ', ' ORDER BY bin_start) || ']' AS counts "
        f"FROM spine LEFT JOIN cnt USING (keyword, bin_start) GROUP BY keyword)",
        f"kw AS (SELECT id, keyword, min(p) AS p FROM (SELECT id, unnest(k) AS keyword, generate_subscripts(k, 1) AS p FROM ("
        f"SELECT id, {title_words('title', C.KEYWORD_MIN_LEN, C.KEYWORDS_PER_TITLE)} AS k FROM unseen)) GROUP BY id, keyword)",
        f"kvj AS (SELECT id, '{{' || string_agg({json_q('keyword')} || ': ' || counts, ', ' ORDER BY p) || '}}' AS d FROM kw JOIN lists USING (keyword) GROUP BY id)",
        own_hits_sql(C.SIMILAR_K_INSIGHT), evidence_sql(C.ARCHIVE_EVIDENCE_SUMMARY_CHARS)) + (
        f"SELECT CAST(u.id AS BIGINT) AS id, {q(C.ARCHIVE_PROMPT_SYSTEM)} AS system, "
        f"'Article:' || {NL} || coalesce(u.title, 'None') || {NL} || {NL} || 'Summary:' || {NL} || coalesce(u.summary, 'None') || "
        f"{NL} || {NL} || 'Similar past items:' || {NL} || coalesce(ev.evidence, '') || {q(C.ARCHIVE_PROMPT_SERIES)} || "
        f"coalesce(kvj.d, '{{}}') || {q(C.ARCHIVE_PROMPT_ASK)} AS user "
        f"FROM unseen u LEFT JOIN ev ON ev.qid = u.id LEFT JOIN kvj ON kvj.id = u.id")
    for name, sql in (("text_vectors", hashed_tfidf_sql), ("model_vectors", md5_tfidf_sql)):
        o[name] = W(sql(C.EMBED_DIM)) + (
            f"SELECT CAST(a.id AS BIGINT) AS id, CAST({C.EMBED_DIM} AS BIGINT) AS dim, coalesce(round(sqrt(sum(x * x)), 4), 0.0) AS norm, count(x) AS taken, "
            "coalesce(round(sum(x * (b + 1)), 3), 0.0) AS sum_by_place, coalesce(round(sum(x * x * (b + 1)), 3), 0.0) AS squares_by_place "
            "FROM articles a LEFT JOIN (SELECT id, b, CAST(CAST(x AS FLOAT) AS DOUBLE) AS x FROM weight) w ON w.id = a.id GROUP BY a.id")
    o["stream_ingest"] = ("SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, event_type, "
                          "CAST(ts AS TIMESTAMP) AS ts FROM events")
    o["stream_seen"] = ("SELECT CAST(user_id AS BIGINT) AS user_id, CAST(event_id AS BIGINT) AS event_id, CAST(ts AS TIMESTAMP) AS ts FROM ("
                        "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
    o["stream_first_seen"] = (
        "SELECT CAST(user_id AS BIGINT) AS user_id, CAST(arg_min(event_id, (ts, event_id)) AS BIGINT) AS event_id, CAST(min(ts) AS TIMESTAMP) AS ts "
        "FROM events GROUP BY user_id HAVING min(ts) <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
    o["stream_closed_windows"] = (
        "WITH b AS (SELECT date_trunc('day', min(ts)) AS o, max(ts) AS m FROM events), "
        "e AS (SELECT event_type, o + to_days(CAST(floor(epoch(ts - o) / 604800) AS INTEGER) * 7) AS bin_start, event_id % 10 = 0 AND ts < o + INTERVAL 7 DAY AS late, m FROM events, b) "
        "SELECT event_type, CAST(bin_start AS TIMESTAMP) AS bin_start, CAST(count(*) AS BIGINT) AS n, (SELECT CAST(count(*) AS BIGINT) FROM e WHERE late) AS late_rows "
        "FROM e WHERE NOT late AND bin_start + INTERVAL 7 DAY <= m - INTERVAL 1 DAY GROUP BY ALL")
    o["stream_mentions"] = (
        "WITH b AS (SELECT date_trunc('day', min(ts)) AS origin FROM events) "
        "SELECT event_type, origin + to_seconds(CAST(floor(epoch(ts - origin) / 604800) AS BIGINT) * 604800) AS bin_start, "
        "CAST(count(*) AS BIGINT) AS n FROM events, b GROUP BY ALL")
    return o
