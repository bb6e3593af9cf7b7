"""The queries in DuckDB's SQL, for those that SQL can express."""

from __future__ import annotations

from kinrate.llm import licences

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUBSTRING = f"""
WITH docs AS (
  SELECT doc_id, coalesce({WORDS.format(text="text")}, []) AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM docs WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, s, array_to_string(words[s : s + 49], ' ') AS content FROM starts
), repeated AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, min(doc_id) OVER (PARTITION BY content) AS first_id FROM windows
  ) WHERE first_id < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM repeated
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept, count(*) AS n
  FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words,
  (len(d.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(line: str) -> str:
    low = f"lower({line})"
    kept = f"CASE WHEN regexp_matches({low}, {_quoted(licences.COPYRIGHT_LINE)}) THEN '' ELSE {low} END"
    words = f"' ' || trim(regexp_replace({kept}, '[^a-z0-9]+', ' ', 'g')) || ' '"
    for other, one in licences.SPELLINGS:
        words = f"replace({words}, ' {other} ', ' {one} ')"
    return f"trim({words})"


def _lines(text: str) -> str:
    split = rf"regexp_split_to_array({text}, '\r\n|\r|\n')"
    return f"list_filter(list_transform({split}, lambda l: {_canonical('l')}), lambda w: w <> '')"


LICENCES = f"""
WITH known AS (
  SELECT DISTINCT licence, array_to_string({_lines("t")}, ' ') AS words FROM (VALUES
    {", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licences.KNOWN)}
  ) AS k(licence, t)
), docs AS (
  SELECT doc_id, {_lines("text")} AS lines FROM documents
), units AS (
  SELECT doc_id, unnest(lines) AS words, 1 AS line FROM docs
  UNION ALL SELECT doc_id, array_to_string(lines, ' '), 0 FROM docs WHERE len(lines) > 0
)
SELECT doc_id, licence, sum(line)::BIGINT AS n_lines, min(line) = 0 AS whole_text
FROM units JOIN known USING (words) GROUP BY doc_id, licence
"""

JACCARD = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce({WORDS.format(text=f"translate(text, '{UPPER}', '{LOWER}')")}, []) AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS shingle FROM (
    SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM docs WHERE len(words) > 0
  )
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.least AS component_id,
  coalesce(l.n, 0)::BIGINT AS n_links
FROM docs d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM edges GROUP BY a) l USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) r USING (doc_id)
"""

SEARCH = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""

LINES = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(
    trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed
  WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (first < doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first IS NULL OR first >= doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (key) GROUP BY doc_id
"""

ORACLE = {
    "op1_substring_dedup": SUBSTRING,
    "op3_license_scan": LICENCES,
    "op5_jaccard_join": JACCARD,
    "op10_topk_search": SEARCH,
    "op12_line_dedup": LINES,
}
