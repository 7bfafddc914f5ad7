"""DuckDB statements of the corpus queries that SQL can express; constants are written out."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_LETTERED = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT reach.doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(other) AS component_id,
       reach.doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes ON sizes.doc_id = reach.doc_id
GROUP BY reach.doc_id
"""

OP9 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT doc_id, line, place,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, line, place, coalesce(keeper <> doc_id, false) AS dropped
  FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP10 = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_LETTERED}) AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, {_LETTERED}) AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM items WHERE len(w) > 0)
), runs AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS run
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT doc_id, item_id, i, runs.size FROM runs JOIN windows ON windows.run = runs.run AND windows.size = runs.size
), hits AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS place FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT docs.doc_id, len(w) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_COMMON = {
    "de": "der die und in den von zu das mit sich des auf ist im ein nicht",
    "en": "the of and to in a is that for it with as was on be at",
    "es": "de la que el en y a los se del las un por con una su",
    "fr": "de la le et les des en un du que est pour dans qui par sur",
}
_LISTED = ", ".join(f"('{lang}', '{w}')" for lang, words in _COMMON.items() for w in words.split())


def _count(characters: str) -> str:
    return f"length(t) - length(regexp_replace(t, '[{characters}]', '', 'g'))"


def _jensen_shannon(counts: str, sums: str) -> str:
    """doc_id and the distance of its histogram (doc_id, lang, bin, n) from its language's."""
    return f"""
  SELECT doc_id, sqrt(greatest(sum(
           CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS distance
  FROM (SELECT doc_id, n / sum(n) OVER (PARTITION BY doc_id) AS p,
               total / sum(total) OVER (PARTITION BY doc_id) AS q
        FROM {counts} JOIN {sums} USING (lang, bin))
  GROUP BY doc_id"""


OP4 = rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_SPACED})) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS run
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM texts WHERE len(w) > 7)
), repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(generate_series(i, i + 7)) AS place
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS times FROM windows) WHERE times > 1)
  GROUP BY doc_id
), base AS (
  SELECT doc_id, lang, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         {_count("#*$%&|<>")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(w) < 20 OR 100 * coalesce(n, 0) > 30 * len(w) AS base_failed
  FROM texts LEFT JOIN repeats USING (doc_id)
), counted AS (
  SELECT *, [{_count("A-Z")}, {_count("0-9")}, {_count(".,;:")}, {_count("!?")}, n_symbols,
             strlen(t) - length(t), length(t) - word_chars] AS c FROM base
), classes AS (
  SELECT doc_id, lang, base_failed, unnest(generate_series(1, 8)) AS bin,
         unnest(list_append(c, length(t) - (list_sum(c) - c[6]))) AS n FROM counted
), class_sums AS (
  SELECT lang, bin, sum(n) AS total FROM classes WHERE NOT base_failed GROUP BY lang, bin
), listed(lang, word) AS (VALUES {_LISTED}
), tokens AS (
  SELECT doc_id, lang, unnest(w) AS token FROM base
), words AS (
  SELECT doc_id, coalesce(listed.word, '') AS bin, count(*) AS n
  FROM tokens LEFT JOIN listed
    ON listed.lang = tokens.lang AND token IN (word, upper(word[1]) || word[2:])
  GROUP BY doc_id, coalesce(listed.word, '')
), bins AS (
  SELECT base.doc_id, base.lang, base_failed, l.word AS bin, coalesce(n, 0) AS n
  FROM base JOIN (SELECT * FROM listed UNION ALL SELECT DISTINCT lang, '' FROM listed) l USING (lang)
  LEFT JOIN words ON words.doc_id = base.doc_id AND words.bin = l.word
  WHERE n_words > 0
), word_sums AS (
  SELECT lang, bin, sum(n) AS total FROM bins WHERE NOT base_failed GROUP BY lang, bin
), class_distances AS ({_jensen_shannon("(SELECT * FROM classes WHERE doc_id IN (SELECT doc_id FROM base WHERE t <> ''))", "class_sums")}
), word_distances AS ({_jensen_shannon("bins", "word_sums")}
)
SELECT base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT (word_chars >= 300 AND coalesce(x.distance, 0) > 0.26)
       AND NOT (n_words >= 100 AND coalesce(y.distance, 0) > 0.1 + 2.8 / sqrt(n_words)) AS kept
FROM base LEFT JOIN class_distances x USING (doc_id) LEFT JOIN word_distances y USING (doc_id)
"""

OP12 = rf"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS text FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM split, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k
), counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= 10
), cuts AS (
  SELECT lang, k, phrase, a, w, unnest(generate_series(1, k - 1)) AS cut FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, p.f AS l, r.f AS r, cut,
         ((1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c
  JOIN counts p ON p.lang = c.lang AND p.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
), lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), covers AS (
  SELECT lang, a AS f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
  FROM candidates WHERE k = 3
), whole AS (
  SELECT * FROM lowest x
  WHERE NOT EXISTS (
    SELECT 1 FROM covers y WHERE y.lang = x.lang AND y.phrase = x.phrase AND 100 * y.f >= 50 * x.a
  )
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM whole
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, 1 + no % 3 AS weight, 3 * source_size AS cap FROM sums
), tested AS (
  SELECT *, cap * sum(weight) OVER onward
            <= (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) * weight AS capped
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), aimed AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE ((sum(source_size) OVER () - coalesce(sum(cap) FILTER (capped) OVER (), 0)) * weight)::DOUBLE
                   / nullif(sum(weight) FILTER (NOT capped) OVER (), 0)::DOUBLE END AS target
  FROM tested
), lined AS (
  SELECT doc_id, size, source, coalesce(sum(size) OVER (
           PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized
), placed AS (
  SELECT doc_id, size, l.source, source_size, target, start,
         least(round(target)::BIGINT, 3 * source_size) AS words, greatest(source_size, 1) AS line
  FROM lined l JOIN aimed a ON l.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source, source_size, target,
       (words // line * size + greatest(0, least(start + size, words % line) - start))::BIGINT AS taken
FROM placed
"""
