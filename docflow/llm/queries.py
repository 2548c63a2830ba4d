"""The registered queries of the corpus operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from docflow.llm.decontaminate import op2_decontaminate
from docflow.llm.html_extract import op6_html_text
from docflow.llm.language import op7_language_id
from docflow.llm.mpeg_audio import op8_mpeg_audio
from docflow.llm.near_duplicates import op10_near_duplicates
from docflow.llm.secrets import op4_secret_scan
from docflow.llm.sentencepiece_bpe import op3_sentencepiece
from docflow.llm.token_counts import op5_token_counts
from docflow.llm.url_filter import op9_url_filter
from docflow.llm.warc import op1_warc

QUERIES = {f.__name__: f for f in (op1_warc, op2_decontaminate, op3_sentencepiece, op4_secret_scan, op5_token_counts, op6_html_text, op7_language_id, op8_mpeg_audio, op9_url_filter, op10_near_duplicates)}

ORACLES = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER w AS first_id, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS k FROM d WINDOW w AS (PARTITION BY payload_digest))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND (page_id <> first_id OR (page_id IS NULL AND k > 1)) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND (page_id <> first_id OR (page_id IS NULL AND k > 1)) THEN first_id END AS refers_to
FROM f""",
    "op2_decontaminate": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0) x),
dw AS (SELECT rid, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM bw) s) x),
m AS (SELECT rid, k, dw.n, item FROM dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
h AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT rid, k, n FROM m) y) z GROUP BY rid),
i AS (SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN i USING (rid)""",
}
