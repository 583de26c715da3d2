"""What SQL can say about these operators, by brute force and at small sizes."""

from __future__ import annotations

from newsrisk.llm.licences import scan_sql
from newsrisk.llm.mixing import MIX_SQL

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

REPEATED_WORDS = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
least AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, i + j AS i
  FROM win JOIN least USING (s), unnest(range(0, 50)) AS t(j) WHERE least < doc_id
),
word AS (SELECT doc_id, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT doc_id, b FROM reach JOIN link ON a = other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""

REPEATED_BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, h[2 * i + 1:2 * i + 400] AS s FROM d, unnest(range(0, len(h) // 2 - 199)) AS t(i)),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win SEMI JOIN twice USING (s)),
-- Runs of hits whose windows touch or overlap.
mark AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 200, true) AS new FROM hit),
run AS (SELECT doc_id, i, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM mark),
cut AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM run GROUP BY doc_id, r),
edge AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM cut),
left_over AS (
  SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed,
         string_agg(h[2 * before + 1:2 * a], '' ORDER BY a) || any_value(h)[2 * max(b) + 1:] AS kept
  FROM edge JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

ORACLE = {
    "op2_repeated_words": REPEATED_WORDS,
    "op5_mixing": MIX_SQL,
    "op7_jaccard_join": JACCARD_JOIN,
    "op8_licences": scan_sql(),
    "op10_repeated_bytes": REPEATED_BYTES,
}

COLLOCATIONS = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
tot AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, w[i:i + m - 1] AS ph FROM w, unnest(range(1, len(w) + 1)) AS t(i), unnest(range(1, 6)) AS u(m)
  WHERE i + m - 1 <= len(w)
),
f AS (SELECT lang, ph, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY lang, ph HAVING count(*) >= 100),
c AS (SELECT lang, ph, f AS a FROM f WHERE len(ph) BETWEEN 2 AND 5),
inside AS (
  SELECT DISTINCT s.lang, s.ph
  FROM c s JOIN c q ON s.lang = q.lang AND len(q.ph) > len(s.ph) AND q.a >= s.a
  WHERE EXISTS (SELECT 1 FROM unnest(range(1, len(q.ph) - len(s.ph) + 2)) AS o(o) WHERE q.ph[o:o + len(s.ph) - 1] = s.ph)
),
cut AS (
  SELECT c.lang, c.ph, c.a, tot.n, k, fl.f AS l, fr.f AS r,
         CAST((CAST(1000 AS HUGEINT) * c.a * tot.n) // (CAST(fl.f AS HUGEINT) * fr.f) AS BIGINT) AS score
  FROM c JOIN tot USING (lang) JOIN (SELECT unnest(range(1, 5)) AS k) ks ON ks.k < len(c.ph)
  JOIN f fl ON fl.lang = c.lang AND fl.ph = c.ph[1:k]
  JOIN f fr ON fr.lang = c.lang AND fr.ph = c.ph[k + 1:len(c.ph)]
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.ph = c.ph)
),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS pick FROM cut),
ranked AS (
  SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank
  FROM best WHERE pick = 1
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
ORACLE["op12_collocations"] = COLLOCATIONS
