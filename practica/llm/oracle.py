"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from practica.llm.queries import LINK, MOST_LINKS
from practica.llm.url_filter import RULES


def op8_sql() -> str:
    """Rules by a VALUES table, the list by exact membership."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return rf"""
    WITH cut AS (
        SELECT page_id, url, length(html) - length(replace(html, '{LINK}', '')) <= {MOST_LINKS * len(LINK)} AS dead_end,
               CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    part AS (
        SELECT page_id, dead_end, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
               regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
        FROM cut),
    plain AS (
        SELECT *, regexp_replace(regexp_replace(query, '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS asked FROM part),
    named AS (
        SELECT *, CASE WHEN host <> '' THEN
                   regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
                   || regexp_replace(path, '/+$', '')
                   || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END END AS canonical
        FROM plain),
    listed AS (SELECT DISTINCT canonical FROM named WHERE dead_end),
    rules(verdict, rule_host, rule_path) AS (VALUES {rules}),
    best AS (
        SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               max_by(r.verdict, length(rule_host || rule_path)) AS verdict
        FROM named JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host))
             AND starts_with(path, rule_path)
        GROUP BY page_id)
    SELECT n.page_id, host, path, rule,
           coalesce(verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
           rule IS NULL AND l.canonical IS NOT NULL AS listed
    FROM named n LEFT JOIN best USING (page_id) LEFT JOIN listed l ON n.canonical = l.canonical
    """


def op3_sql() -> str:
    """All links by an exact join on shingles of different texts, components by
    reachability."""
    return r"""
    WITH RECURSIVE texts AS (
        SELECT coalesce(text, '') AS text, min(doc_id) AS id, count(*) AS copies FROM documents GROUP BY ALL),
    words AS (SELECT id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
    shingles AS (
        SELECT DISTINCT id, array_to_string(w[s:s + 4], ' ') AS shingle
        FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(s) WHERE len(w) > 0),
    sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
    meets AS (SELECT a.id AS a, b.id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
              WHERE a.id <> b.id GROUP BY a.id, b.id),
    links AS (SELECT a, b FROM meets m JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
              WHERE m.n >= 0.8 * (x.n + y.n - m.n) - 1e-9),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    class AS (SELECT a AS id, least(min(b), a) AS class_id FROM reach GROUP BY a),
    linked AS (SELECT a AS id, sum(copies) AS n FROM links JOIN texts ON texts.id = b GROUP BY a)
    SELECT d.doc_id, coalesce(class_id, t.id) AS class_id, t.id AS copy_of,
           CAST(coalesce(l.n, 0) + t.copies - 1 AS BIGINT) AS n_links
    FROM documents d JOIN texts t ON t.text = coalesce(d.text, '')
    LEFT JOIN class c ON c.id = t.id LEFT JOIN linked l ON l.id = t.id
    """


def op12_sql() -> str:
    """All words, pairs and triples of all pieces, counted; scores in 128 bits."""
    return r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    counted AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM worded, unnest([1, 2, 3]) AS size(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS place(i)
        GROUP BY ALL),
    total AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang),
    candidate AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= 10),
    inside AS (
        SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidate WHERE k = 3
            UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidate WHERE k = 3) GROUP BY ALL),
    cut AS (
        SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r,
               (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
        FROM candidate c, unnest(range(1, c.k)) AS places(cut)
        JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
        JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')
        LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
        WHERE i.longer IS NULL OR c.k = 3 OR 100 * i.longer < 50 * c.a),
    lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """


def llm_oracle_sql() -> dict[str, str]:
    return {"op3_lsh_forest": op3_sql(), "op8_url_bloom": op8_sql(), "op12_phrase_parse": op12_sql()}
