"""SQL for DuckDB that states the expected result of each registered query.

Written from the rules, not from the Spark plans: extraction results are computed from the test
tables directly, without building or parsing any XML, JSON or HTML listing.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong constant of the package shows.
AS_OF = "2024-01-30"
FETCHED_AT = "2024-01-30 06:00:00"
CATEGORY_RULES = (
    ("programming", ("code", "programming", "developer", "software", "git")),
    ("technology", ("ai", "tech", "computer", "app", "digital")),
    ("science", ("science", "research", "study", "physics", "biology")),
    ("business", ("startup", "business", "money", "finance", "market")),
)
DEFAULT_CATEGORY = "general"
FORUM_LINK_PREFIX = "https://reddit.com"
NEWS_CONTENT_DEFAULT = "No content preview available"
POSITIVE_DESCRIPTION = "This content has a very positive sentiment score"
STORY_LINK_PREFIX = "https://news.ycombinator.com/item?id="
BRIEFING_CLOSING = "\nAsk me for more details on any topic!"
BRIEFING_HEADING = "*DAILY BRIEFING*\n\nHere's your summary of today's most relevant content:\n\n"
TRENDING_HEADING = "📊 *TRENDING TOPICS* 📊\n\nHere's what's generating buzz across platforms:\n\n"
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()
_GENERATED_AT = "2024-01-30 12:00:00"
_W = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}"
)


def _text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_W}]+|[{_W}]+$', '', 'g')"


def _clean(x: str) -> str:
    return _strip(f"lower(regexp_replace({x}, '[^a-zA-Z{_W}]', '', 'g'))")


def _tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[{_W}]+'), lambda w: length(w) > 2)"


def _first_line(x: str) -> str:
    return f"string_split({x}, chr(10))[1]"


def _clock(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _days_ago(x: str) -> str:
    return f"DATE '{AS_OF}' - CAST({x} % 30 AS INTEGER)"


def _label(x: str) -> str:
    return f"lower(trim({x}, ' '))"


def _gaps(number: str, modulus: int, x: str) -> str:
    return f"CASE ({number}) % {modulus} WHEN 7 THEN '' WHEN 8 THEN NULL ELSE {x} END"


_VARIED = "((id * 37) % 101) / 100.0"
_PAPER = "conv_id * 1000 + turn"

_RAW = f"""
raw_news AS (
  SELECT doc_id AS id, '  ' || upper(source) || ' ' AS source,
         CASE WHEN doc_id % 37 <> 5 THEN upper(lang) END AS category,
         {_gaps("doc_id", 41, _first_line("text"))} AS title,
         {_gaps("doc_id", 43, "text")} AS content,
         'http://example.com/doc/' || doc_id AS url, {_days_ago("doc_id")} AS published_date
  FROM documents),
raw_posts AS (
  SELECT event_id AS id, ' ' || upper(event_type[1]) || event_type[2:] AS subreddit,
         {_gaps("event_id", 41, "event_type || ' ' || props")} AS title, 'user' || user_id AS author,
         'http://example.com/post/' || event_id AS url,
         CAST(floor(value * 10) AS INTEGER) AS score, CAST(ts AS DATE) AS created_date
  FROM events),
raw_papers AS (
  SELECT {_PAPER} AS id, ' Journal of ' || role || '  ' AS source,
         upper(role[1]) || role[2:] AS category,
         {_gaps(_PAPER, 41, _first_line("text"))} AS title,
         CASE WHEN ({_PAPER}) % 37 <> 5 THEN string_split(text, '.')[1] END AS authors,
         {_gaps(_PAPER, 43, "text")} AS abstract,
         'http://example.com/paper/' || ({_PAPER}) AS url,
         {_days_ago("(" + _PAPER + ")")} AS published_date
  FROM conversations)
"""


def _unified(sentiment: str = "0.0") -> str:
    return f"""{_RAW},
unified AS (
  SELECT id, {_label("source")} AS source, {_label("category")} AS category,
         {_clean("title")} AS title, {_clean("content")} AS content, url, published_date,
         CAST({sentiment} AS DOUBLE) AS sentiment_score, 'news' AS content_type,
         'news_' || id AS unified_id
  FROM raw_news WHERE title <> '' AND content <> ''
  UNION ALL
  SELECT id, 'reddit', {_label("subreddit")}, {_clean("title")}, NULL, url, created_date,
         CAST({sentiment} AS DOUBLE), 'social_media', 'social_media_' || id
  FROM raw_posts WHERE title <> ''
  UNION ALL
  SELECT id, {_label("source")}, {_label("category")}, {_clean("title")}, {_clean("abstract")},
         url, published_date, CAST({sentiment} AS DOUBLE), 'academic', 'academic_' || id
  FROM raw_papers WHERE title <> '' AND abstract IS NOT NULL)
"""


def _trending(days: int) -> str:
    return f"""
  SELECT category, count(*) AS "count", avg(sentiment_score) AS avg_sentiment FROM unified
  WHERE date_diff('day', published_date, DATE '{AS_OF}') <= {days} GROUP BY category"""


_TOP_TRENDING = f"""{_trending(3)}
  ORDER BY count(*) DESC, avg(sentiment_score) DESC, category LIMIT 10"""
_POSITIVE = f"""
  SELECT unified_id, title, source, sentiment_score, url FROM unified
  WHERE sentiment_score > 0.7 AND date_diff('day', published_date, DATE '{AS_OF}') <= 5
  ORDER BY sentiment_score DESC, unified_id LIMIT 15"""

_STOP = ", ".join(_text(word) for word in ENGLISH_STOP_WORDS)
_WORDS = f"""{_unified()},
corpus AS (
  SELECT unified_id,
         list_filter(string_split_regex(
             lower(regexp_replace(content, '[^a-zA-Z{_W}]', '', 'g')), '[{_W}]+'),
           lambda w: w <> '' AND w NOT IN ({_STOP})) AS words
  FROM unified WHERE content IS NOT NULL)
"""
_TERMS = f"""{_WORDS},
terms AS (
  SELECT term, count(*) AS term_count, count(DISTINCT unified_id) AS document_count
  FROM (SELECT unified_id, unnest(words) AS term FROM corpus) GROUP BY term)
"""

_INSIGHTS = """
stored AS (
  SELECT event_id AS id,
         CASE WHEN event_type IN ('click', 'view') THEN 'trending_topic'
              WHEN event_type = 'purchase' THEN 'positive_content'
              ELSE 'discovered_topic' END AS insight_type,
         event_type || ' ' || event_id AS title, 'seen by user ' || user_id AS description,
         [event_type, 'feed', 'page', 'archive'][1:event_id % 4 + 1] AS sources,
         value AS score, ts AS generated_at
  FROM events)
"""
_SERVED = f"id, insight_type, title, description, score, {_clock('generated_at')} AS generated_at"
_TODAY = f"generated_at >= DATE '{AS_OF}'"
_SINCE_YESTERDAY = f"generated_at >= DATE '{AS_OF}' - INTERVAL '1 day'"
_BEST = "ORDER BY score DESC, id"
_NEWEST = "ORDER BY generated_at DESC, score DESC, id"

_LINES = """
lines AS (
  SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents)
"""
_EMPTY_FIRST = "CASE WHEN doc_id % 6 IN (1, 2) THEN 1 ELSE 0 END"
_READ = f"doc_id % 13 <> 4 AND i + {_EMPTY_FIRST} < 10"
_FETCHED_AND_READ = f"doc_id % 17 <> 2 AND {_READ}"
_TRIMMED = r"regexp_replace(line, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_MORNING = "make_timestamp(2024, 1, i % 28 + 1, 10, 0, 0.0)"
_FETCHED = f"TIMESTAMP '{FETCHED_AT}'"


def _feed_time(dc_date: str, zone_name: str) -> str:
    return _clock(
        f"""CASE i % 5 WHEN 0 THEN {_MORNING} WHEN 1 THEN {_MORNING} + INTERVAL 5 HOUR
            WHEN 2 THEN {dc_date} WHEN 3 THEN {zone_name} ELSE {_FETCHED} END"""
    )


def _absolute(link: str, prefix: str) -> str:
    return f"""CASE WHEN {link} LIKE 'http://%' OR {link} LIKE 'https://%' THEN {link}
                    WHEN {link} LIKE '/%' THEN {prefix} || {link}
                    ELSE {prefix} || '/' || {link} END"""


def _decoded(x: str) -> str:
    """Entities as HTML reads them, the final semicolon being optional."""
    for entity, char in (
        ("lt", "<"),
        ("gt", ">"),
        ("quot", '"'),
        ("copy", "©"),
        ("middot", "·"),
        ("amp", "&"),
    ):
        x = f"regexp_replace({x}, '&{entity};?', '{char}', 'g')"
    return x


def _guess(title: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({title}), '{k}')" for k in keywords) + f" THEN '{c}'"
        for c, keywords in CATEGORY_RULES
    )
    return f"CASE {cases} ELSE '{DEFAULT_CATEGORY}' END"


_ROOT = "nullif(regexp_extract(url, '^(https?://[^/]+)', 1), '')"

_STORIES = f"""
SELECT doc_id AS story_id, {_guess("text")} AS subreddit, text AS title,
       CASE WHEN doc_id % 4 = 1 THEN 'anonymous' ELSE source END AS author,
       CASE WHEN doc_id % 5 = 2 THEN '{STORY_LINK_PREFIX}' || doc_id
            ELSE 'http://example.com/story/' || doc_id END AS url,
       CAST(CASE WHEN doc_id % 6 = 3 THEN 0 ELSE n_chars END AS INTEGER) AS score,
       {_clock('''CASE WHEN doc_id % 7 = 4 THEN TIMESTAMP '1970-01-01'
         ELSE TIMESTAMP '2024-01-01' + to_minutes(doc_id) END''')} AS created_utc
FROM documents WHERE doc_id % 60 < 50 AND doc_id % 10 <> 0"""

ORACLES: dict[str, str] = {
    "q_clean_text": f"SELECT doc_id, {_clean('text')} AS clean FROM documents",
    "q_tokenize": f"""
SELECT conv_id, turn, CAST(len(tokens) AS INTEGER) AS token_count,
       array_to_string(tokens, ' ') AS tokens
FROM (SELECT conv_id, turn, {_tokens("text")} AS tokens FROM conversations)""",
    "q_truncate": f"""
SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, left({_strip("text")}, 500) AS preview,
       left({_strip("text")}, 1000) AS abstract
FROM documents""",
    "q_rule_category": f"SELECT doc_id, {_guess('text')} AS category FROM documents",
    "q_popularity": f"""
WITH {_RAW}
SELECT id, score, CASE WHEN score > 1000 THEN 'high' WHEN score > 100 THEN 'medium' ELSE 'low' END
       AS popularity_level
FROM raw_posts""",
    "q_absolute_url": f"""
WITH links AS (
  SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN '/p/' || page_id
                       WHEN 2 THEN 'p?id=' || page_id ELSE '' END AS link FROM pages)
SELECT page_id, {_absolute("link", _ROOT)} AS site_link, {_absolute("link", "''")} AS bare_link,
       {_absolute("link", "'https://example.org'")} AS prefixed_link,
       CASE WHEN link LIKE 'http://%' OR link LIKE 'https://%' OR link = '' THEN link
            ELSE '{FORUM_LINK_PREFIX}' || link END AS forum_link
FROM links""",
    "q_score_parse": """
SELECT event_id, CAST(CASE WHEN event_id % 8 <= 2 THEN event_id
                           WHEN event_id % 8 = 3 THEN -event_id ELSE 0 END AS INTEGER) AS score
FROM events""",
    "q_dates": f"""
WITH seconds AS (SELECT event_id, date_trunc('second', ts) AS t FROM events)
SELECT event_id,
  {_clock(f'''CASE event_id % 7 WHEN 0 THEN t WHEN 1 THEN t + INTERVAL 5 HOUR
    WHEN 2 THEN t - INTERVAL 2 HOUR WHEN 3 THEN t WHEN 6 THEN date_trunc('day', t)
    ELSE {_FETCHED} END''')} AS feed_time,
  {_clock(f'''CASE event_id % 7 WHEN 1 THEN t + INTERVAL 5 HOUR WHEN 2 THEN t - INTERVAL 2 HOUR
    WHEN 5 THEN {_FETCHED} WHEN 6 THEN date_trunc('day', t) ELSE t END''')} AS news_time,
  {_clock(f'''CASE event_id % 7 WHEN 6 THEN date_trunc('day', t)
    ELSE {_FETCHED} END''')} AS page_time,
  {_clock("t")} AS epoch_time, CAST(t AS DATE) AS "day"
FROM seconds""",
    "q_markup_text": f"""
SELECT page_id, {_strip(_decoded(
    "regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', '', 'g')"
))} AS text
FROM pages""",
    "q_transform_news": f"""
WITH {_RAW},
cleaned AS (SELECT *, {_clean("title")} AS clean_title, {_clean("content")} AS clean_content
            FROM raw_news WHERE title <> '' AND content <> '')
SELECT *, array_to_string({_tokens("clean_title")}, ' ') AS title_tokens,
       array_to_string({_tokens("clean_content")}, ' ') AS content_tokens,
       CAST(length(content) AS INTEGER) AS content_length,
       {_label("source")} AS source_normalized, {_label("category")} AS category_normalized,
       published_date AS published_date_normalized, CAST(0.0 AS DOUBLE) AS sentiment_score
FROM cleaned""",
    "q_transform_posts": f"""
WITH {_RAW},
cleaned AS (SELECT *, {_clean("title")} AS clean_title FROM raw_posts WHERE title <> '')
SELECT *, array_to_string({_tokens("clean_title")}, ' ') AS title_tokens,
       {_label("subreddit")} AS subreddit_normalized,
       CASE WHEN score > 1000 THEN 'high' WHEN score > 100 THEN 'medium' ELSE 'low' END
         AS popularity_level,
       CAST(0.0 AS DOUBLE) AS sentiment_score
FROM cleaned""",
    "q_transform_scholarly": f"""
WITH {_RAW},
cleaned AS (SELECT *, {_clean("title")} AS clean_title, {_clean("abstract")} AS clean_abstract
            FROM raw_papers WHERE title <> '' AND abstract IS NOT NULL)
SELECT * EXCLUDE (published_date), array_to_string({_tokens("clean_title")}, ' ') AS title_tokens,
       array_to_string({_tokens("clean_abstract")}, ' ') AS abstract_tokens,
       CAST(length(abstract) AS INTEGER) AS abstract_length,
       CAST(len(string_split(authors, ',')) AS INTEGER) AS author_count,
       {_label("source")} AS source_normalized, {_label("category")} AS category_normalized,
       published_date AS published_date_normalized, CAST(0.0 AS DOUBLE) AS sentiment_score
FROM cleaned""",
    "q_unify": f"WITH {_unified()} SELECT * FROM unified",
    "q_duplicate_ids": f"""
WITH {_unified()}
SELECT unified_id, 2 * count(*) AS "rows" FROM unified GROUP BY unified_id""",
    "q_language_default": f"""
WITH {_RAW}
SELECT id, title, authors, 'en' AS language FROM raw_papers
UNION ALL SELECT doc_id, text, NULL, lang FROM documents""",
    "q_stored_language": f"""
WITH {_RAW}
SELECT id, title, CASE id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'he' END AS language FROM raw_papers""",
    "q_window_refresh": f"WITH {_unified()} SELECT * FROM unified",
    "q_load_stamps": f"""
WITH {_unified()}
SELECT content_type AS loaded, id, '2024-01-30 18:00:00' AS stamp FROM unified
UNION ALL
SELECT 'unified ' || content_type, id, '2024-01-30 19:00:00' FROM unified""",
    "q_trending_of_days": f"WITH {_unified()} {_TOP_TRENDING}",
    "q_trending_topics": f"WITH {_unified()} {_TOP_TRENDING}",
    "q_trending_by_sentiment": f"""
WITH {_unified(_VARIED)}, top AS ({_TOP_TRENDING})
SELECT category, "count", round(avg_sentiment, 6) AS avg_sentiment FROM top""",
    "q_category_counts": f"""
WITH {_unified()} SELECT category, count(*) AS "count" FROM unified
WHERE published_date IS NOT NULL GROUP BY category""",
    "q_positive_content": f"WITH {_unified(_VARIED)} {_POSITIVE}",
    "q_scholarly_recent": f"""
WITH {_unified(_VARIED)}
SELECT unified_id, title, source, sentiment_score, content_type, url FROM unified
WHERE content_type = 'academic' AND date_diff('day', published_date, DATE '{AS_OF}') <= 14
ORDER BY sentiment_score DESC, published_date DESC, unified_id LIMIT 10""",
    "q_insights": f"""
WITH {_unified(_VARIED)}, top AS ({_TOP_TRENDING}), positive AS ({_POSITIVE})
SELECT 'trending_topic' AS insight_type, category AS title,
       'This category has ' || "count" || ' recent articles with an average sentiment of '
         || printf('%.2f', avg_sentiment) AS description,
       'multiple sources' AS sources, '' AS related_content_ids,
       CAST("count" AS DOUBLE) AS score, '{_GENERATED_AT}' AS generated_at
FROM top WHERE category IS NOT NULL
UNION ALL
SELECT 'positive_content', title, {_text(POSITIVE_DESCRIPTION)}, source, unified_id,
       sentiment_score, '{_GENERATED_AT}'
FROM positive""",
    "q_insight_ids": f"""
WITH {_unified(_VARIED)}
SELECT 'positive_content' AS insight_type, count(*) AS "rows",
       count(DISTINCT unified_id) AS ids FROM unified""",
    "q_corpus_words": f"""
WITH {_WORDS}
SELECT unified_id, CAST(len(words) AS INTEGER) AS word_count,
       array_to_string(words, ' ') AS words FROM corpus""",
    "q_term_counts": f"WITH {_TERMS} SELECT term, term_count, document_count FROM terms",
    "q_vocabulary": f"""
WITH {_TERMS}
SELECT term, term_count, document_count FROM terms WHERE document_count >= 2
ORDER BY term_count DESC, term LIMIT 1000""",
    "q_frequent_words": f"""
WITH {_TERMS}
SELECT term, term_count, document_count FROM terms WHERE document_count >= 2
ORDER BY term_count DESC, term LIMIT 1000""",
    "q_topic_coherence": f"""
WITH {_WORDS},
counted AS (
  SELECT category, term, count(*) AS n
  FROM (SELECT category, unnest(words) AS term FROM corpus JOIN unified USING (unified_id))
  GROUP BY category, term),
ranked AS (
  SELECT category, term, row_number() OVER (PARTITION BY category ORDER BY n DESC, term) AS rank,
         dense_rank() OVER (ORDER BY category NULLS FIRST) - 1 AS topic FROM counted),
best AS (SELECT topic, term, rank FROM ranked WHERE rank <= 10),
held AS (
  SELECT DISTINCT unified_id, term FROM (SELECT unified_id, unnest(words) AS term FROM corpus)
  WHERE term IN (SELECT term FROM best)),
alone AS (SELECT term, count(*) AS documents FROM held GROUP BY term),
together AS (
  SELECT x.term AS a, y.term AS b, count(*) AS documents
  FROM held x JOIN held y USING (unified_id) WHERE x.term <> y.term GROUP BY ALL)
SELECT CAST(p.topic AS INTEGER) AS topic, count(*) AS pairs,
       round(avg(ln((coalesce(t.documents, 0) + 1) / greatest(coalesce(o.documents, 0), 1))), 6) AS coherence
FROM best p JOIN best q ON q.topic = p.topic AND q.rank > p.rank
LEFT JOIN alone o ON o.term = p.term LEFT JOIN together t ON t.a = p.term AND t.b = q.term
GROUP BY p.topic""",
    "q_count_vectors": f"""
WITH {_TERMS},
ranks AS (
  SELECT term, row_number() OVER (ORDER BY term_count DESC, term) - 1 AS rank FROM terms
  WHERE document_count >= 2 QUALIFY rank < 1000),
occurrences AS (SELECT unified_id, unnest(words) AS term FROM corpus),
counted AS (
  SELECT unified_id, rank, count(*) AS n FROM occurrences JOIN ranks USING (term)
  GROUP BY unified_id, rank),
listed AS (
  SELECT unified_id, string_agg(rank || ':' || n, ' ' ORDER BY rank) AS counts FROM counted
  GROUP BY unified_id)
SELECT unified_id, coalesce(counts, '') AS counts FROM corpus LEFT JOIN listed USING (unified_id)
""",
    "q_topic_insights": f"""
WITH {_WORDS},
counted AS (
  SELECT category, term, count(*) AS n
  FROM (SELECT category, unnest(words) AS term FROM corpus JOIN unified USING (unified_id))
  GROUP BY category, term),
ranked AS (
  SELECT category, term, n / sum(n) OVER (PARTITION BY category) AS share,
         row_number() OVER (PARTITION BY category ORDER BY n DESC, term) AS rank FROM counted),
listed AS (
  SELECT dense_rank() OVER (ORDER BY category NULLS FIRST) AS number,
         list(term ORDER BY rank) AS terms, list(share ORDER BY rank) AS shares
  FROM ranked WHERE rank <= 10 GROUP BY category)
SELECT 'discovered_topic' AS insight_type,
       'Topic ' || number || ': ' || array_to_string(terms[1:3], ', ') AS title,
       'Discovered topic with key terms: ' || array_to_string(terms, ', ') AS description,
       'topic modeling' AS sources, 0 AS related,
       round(list_sum(shares[1:5]), 6) AS score, '{_GENERATED_AT}' AS generated_at
FROM listed""",
    "q_topic_properties": """
SELECT CAST(i AS INTEGER) AS topic, 10 AS distinct_terms, 10 AS known_terms, true AS falling,
       true AS shares
FROM range(5) t(i)""",
    "q_digest": f"WITH {_INSIGHTS} SELECT {_SERVED} FROM stored WHERE {_TODAY} {_BEST} LIMIT 10",
    "q_digest_by_day": f"""
WITH {_INSIGHTS}, daily AS (SELECT * REPLACE (date_trunc('day', generated_at) AS generated_at) FROM stored)
SELECT {_SERVED} FROM daily WHERE {_TODAY} {_BEST} LIMIT 10""",
    "q_latest": f"""
WITH {_INSIGHTS} SELECT {_SERVED} FROM stored WHERE {_SINCE_YESTERDAY} {_BEST} LIMIT 5""",
    "q_trending_served": f"""
WITH {_INSIGHTS}, newest AS (
  SELECT * FROM stored WHERE insight_type = 'trending_topic' {_NEWEST} LIMIT 5)
SELECT {_SERVED} FROM newest""",
    "q_briefing": f"WITH {_INSIGHTS} SELECT {_SERVED} FROM stored WHERE {_TODAY} {_BEST} LIMIT 7",
    "q_messages": f"""
WITH {_INSIGHTS},
day AS (SELECT * FROM stored WHERE {_TODAY} {_BEST} LIMIT 10),
days AS (SELECT * FROM stored WHERE {_SINCE_YESTERDAY} {_BEST} LIMIT 5)
SELECT 'digest' AS kind, id,
       chr(10) || '*' || upper(insight_type) || '*: ' || title || chr(10) || chr(10)
       || description || chr(10) || chr(10) || 'Sources: ' || array_to_string(sources[1:3], ', ')
       || chr(10) || 'Relevance Score: ' || printf('%.2f', score) || chr(10) || '        '
       AS message
FROM day
UNION ALL
SELECT 'latest', id,
       chr(10) || '*' || upper(insight_type) || '*: ' || title || chr(10) || chr(10)
       || description || chr(10) || chr(10) || 'Relevance Score: ' || printf('%.2f', score)
       || chr(10) || '        '
FROM days""",
    "q_list_messages": f"""
WITH {_INSIGHTS},
newest AS (SELECT * FROM stored WHERE insight_type = 'trending_topic' {_NEWEST} LIMIT 5),
day AS (SELECT * FROM stored WHERE {_TODAY} {_BEST} LIMIT 7)
SELECT 'trending' AS kind,
       {_text(TRENDING_HEADING)} || string_agg(
         '• *' || title || '*: ' || description || chr(10) || chr(10), '' {_NEWEST}) AS message
FROM newest
UNION ALL
SELECT 'briefing',
       {_text(BRIEFING_HEADING)} || string_agg(
         '• *' || title || '*: ' || description || chr(10) || chr(10), '' {_BEST})
       || {_text(BRIEFING_CLOSING)}
FROM day""",
    "q_story_items": _STORIES,
    "q_repeated_windows": f"""
WITH stories AS ({_STORIES})
SELECT url, subreddit, author, score, md5(title) AS title_md5, created_utc, count(*) AS rows, count(*) AS ids,
       true AS beyond_reserved
FROM stories GROUP BY ALL""",
    "q_news_feed_items": f"""
WITH {_LINES}
SELECT 'http://example.com/feed/' || doc_id AS feed_url, CAST(i + {_EMPTY_FIRST} AS INTEGER) AS position,
       'Feed ' || source AS source, 'feeds' AS category, {_TRIMMED} AS title,
       CASE i % 4 WHEN 1 THEN '<p class=''x''>'
                    || replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
                    || '<br/> <i>more</i></p>'
                  WHEN 3 THEN 'No content' ELSE {_TRIMMED} END AS content,
       CASE WHEN (doc_id + i) % 11 = 5 AND i % 2 = 1 THEN 'No URL'
            ELSE 'http://example.com/doc/' || doc_id || '/' || i END AS url,
       {_feed_time(_FETCHED, _MORNING)} AS published_date
FROM lines WHERE {_READ}
UNION ALL
SELECT 'http://example.com/feed/' || doc_id, 0, 'Feed ' || source, 'feeds', 'No title', 'No content', 'No URL',
       {_clock(_FETCHED)}
FROM documents WHERE doc_id % 13 <> 4 AND doc_id % 6 IN (1, 2)""",
    "q_feed_items": f"""
WITH {_LINES}
SELECT 'http://example.com/feed/' || doc_id AS feed_url, CAST(i + {_EMPTY_FIRST} AS INTEGER) AS position, source,
       'feeds' AS category, {_strip("line")} AS title,
       CASE i % 5 WHEN 2 THEN 'Unknown author - ' || source WHEN 0 THEN 'A. Writer'
                  WHEN 3 THEN 'A. Writer' ELSE 'C, D' END AS authors,
       left(CASE i % 4 WHEN 1 THEN {_strip("line || ' more'")}
                       WHEN 3 THEN 'No abstract available - ' || source
                       ELSE {_strip("line")} END, 1000) AS abstract,
       'http://example.com/doc/' || doc_id || '/' || i AS url, lang AS language,
       {_feed_time(_MORNING, _FETCHED)} AS published_date
FROM lines WHERE {_FETCHED_AND_READ} AND {_strip("line")} <> '' AND (doc_id + i) % 11 <> 5""",
    "q_rejects": """
SELECT 'feeds' AS kind, CASE WHEN doc_id % 17 = 2 THEN 'not fetched'
         WHEN doc_id % 13 = 4 THEN 'malformed' ELSE 'stored' END AS reject_reason,
       count(*) AS "rows"
FROM documents GROUP BY ALL
UNION ALL
SELECT 'stories', CASE WHEN doc_id % 19 IN (3, 5) THEN 'malformed'
         WHEN doc_id % 10 = 0 THEN 'no title' ELSE 'stored' END, count(*)
FROM documents WHERE doc_id % 60 < 50 GROUP BY ALL
UNION ALL
SELECT 'pages', CASE WHEN page_id % 7 IN (1, 2) THEN 'unknown profile' ELSE 'not fetched' END,
       count(*)
FROM pages WHERE page_id % 7 IN (1, 2) OR page_id % 5 = 0 GROUP BY ALL""",
    "q_page_links": f"""
WITH found AS (SELECT url, regexp_extract_all(html, '(?s)<li>.*?</li>')[1:10] AS items FROM pages),
items AS (SELECT url, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS i FROM found),
parts AS (
  SELECT url, i, {_strip(_decoded("regexp_replace(item, '<[^>]*>', '', 'g')"))} AS title,
         {_decoded("regexp_extract(item, 'href=\"([^\"]*)\"', 1)")} AS link
  FROM items)
SELECT url AS page_url, CAST(i AS INTEGER) AS position, 'list pages' AS source,
       'links' AS category, title, '{NEWS_CONTENT_DEFAULT}' AS content,
       {_absolute("link", _ROOT)} AS url
FROM parts WHERE length(title) >= 10 AND link <> ''""",
    "q_page_articles": f"""
WITH parts AS (
  SELECT url, {_strip(_decoded("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS title,
         {_decoded("regexp_extract(html, '<a href=\"([^\"]*)\"', 1)")} AS link,
         {_strip(_decoded("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)"))} AS authors,
         {_strip(_decoded("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)"))} AS ad
  FROM pages)
SELECT url AS page_url, 'article pages' AS source, 'articles' AS category, title, authors,
       left(CASE WHEN ad = '' THEN 'No abstract available - article pages' ELSE ad END, 1000)
         AS abstract,
       {_absolute("link", "'https://example.org'")} AS url, 'xx' AS language,
       '{FETCHED_AT}' AS published_date
FROM parts WHERE title <> '' AND link <> ''""",
    "q_forum_items": f"""
WITH {_LINES}
SELECT 'http://forum.example.com/' || doc_id AS page_url, CAST(i AS INTEGER) AS position,
       'science' AS subreddit, line AS title,
       CASE WHEN i % 5 = 3 THEN 'Unknown' ELSE source END AS author,
       CASE WHEN i % 3 = 1 THEN 'https://example.com' ELSE '{FORUM_LINK_PREFIX}' END
         || '/r/' || doc_id || '/' || i AS url,
       CAST(CASE WHEN i % 4 = 2 THEN 0 ELSE doc_id - i * 7 END AS INTEGER) AS score
FROM lines WHERE i < 10""",
}
