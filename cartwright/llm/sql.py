r"""SQL for DuckDB of the corpus queries that SQL can express."""

from __future__ import annotations

TWINS: dict[str, str] = {}

_TERMS = r"""
    SELECT {key}, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM {source}"""

TWINS["op12_pair_maxscore"] = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS q, item_id, text FROM benchmark),
tokens AS ({_TERMS.format(key="d", source="docs")}),
wanted AS (SELECT DISTINCT q, term FROM ({_TERMS.format(key="q", source="items")})),
tf AS (SELECT d, term, count(*)::bigint AS tf FROM tokens GROUP BY ALL),
sizes AS (SELECT d, sum(tf)::bigint AS n FROM tf GROUP BY d),
total AS (SELECT count(*)::bigint AS n_docs, sum(n)::bigint AS n_terms FROM sizes),
df AS (SELECT term, count(*)::bigint AS df FROM tf GROUP BY term),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint AS w
           FROM df, total),
lengths AS (SELECT d, 50 + (50 * n * n_docs) // n_terms AS m FROM sizes, total),
scores AS (
    SELECT q, d, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint AS score
    FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN lengths USING (d)
    GROUP BY q, d),
ranked AS (
    SELECT q, doc_id, score,
           row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank
    FROM scores JOIN docs USING (d) WHERE score > 0)
SELECT item_id, rank::integer AS rank, doc_id, score
FROM ranked JOIN items USING (q) WHERE rank <= 50"""

# The level of the targets by sources in the order in which they reach their limits: the
# first k are at their limit, and the next one is not.
TWINS["op13_repetition_rates"] = r"""
WITH docs AS (
    SELECT doc_id, text, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size
    FROM documents),
sources AS (SELECT source, sum(size)::bigint AS source_size FROM docs GROUP BY source),
weighted AS (
    SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::double
           AS w, source_size * 2.0::double AS most FROM sources),
ordered AS (
    SELECT *, coalesce(sum(most) OVER before, 0.0) AS taken,
           sum(w) OVER () - coalesce(sum(w) OVER before, 0.0) AS open_w,
           1.5::double * sum(source_size) OVER () AS total,
           row_number() OVER (ORDER BY most / w, source) AS place
    FROM weighted WINDOW before AS (ORDER BY most / w, source
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((total - taken) / open_w, place) AS l
          FROM ordered WHERE w * ((total - taken) / open_w) <= most),
targets AS (SELECT source, source_size, least(w * l, most) AS target FROM weighted, level),
rated AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::double END AS rate,
           cast('0x' || substr(md5(concat_ws('|', '13', 'mix', doc_id::varchar, md5(text))), 1, 13)
                AS bigint) / 4503599627370496.0::double AS draw
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::bigint
           AS taken
FROM rated"""
