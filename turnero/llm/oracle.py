"""DuckDB SQL with the results of the corpus queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(column: str) -> str:
    """The words of a text: digits, letters and characters beyond ASCII, A-Z lower-cased."""
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


OP11 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
item AS (SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT item_id, {_words("text")} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
        FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM item)),
gram AS (SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
         FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT r, i, m, item_id FROM gram JOIN win USING (g, m)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP12 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
token AS (SELECT r, unnest(w) AS term FROM doc),
tf AS (SELECT r, term, count(*) AS tf FROM token GROUP BY r, term),
total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM doc WHERE len(w) > 0),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
ask AS (SELECT DISTINCT item_id, unnest({_words("text")}) AS term FROM benchmark),
score AS (SELECT item_id, r, CAST(sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len(doc.w) * docs) // terms))))) AS BIGINT) AS score
          FROM ask JOIN tf USING (term) JOIN weight USING (term) JOIN doc USING (r), total GROUP BY item_id, r),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
           FROM score JOIN doc USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

OP13 = """
WITH v AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS y
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.y, b.y) AS BIGINT) AS score
         FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pair WHERE same
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negative AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
                    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
             FROM positive JOIN pair USING (anchor_id)
             WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""

STATEMENTS = {"op11_decontamination": OP11, "op12_lexical": OP12, "op13_negatives": OP13}
