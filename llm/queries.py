"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from llm._ship import shipped
from llm.decontaminate import op5_decontamination
from llm.fill_middle import op13_wavelet_fill_middle
from llm.jaccard_join import op9_jaccard_join
from llm.language_id import op6_language_id
from llm.license_scan import op1_license_scan
from llm.line_dedup import op4_line_dedup
from llm.nearest import op2_collision_counting
from llm.packing import op8_best_fit_packing
from llm.pii import op7_pii_surrogates
from llm.suffix_dedup import op3_suffix_array_dedup
from llm.token_counts import op11_rank_synchronous_counts
from llm.toxicity import op10_toxicity
from llm.whitening import op12_polarised_whitening

QUERIES = {f.__name__: shipped(f) for f in (
    op1_license_scan, op2_collision_counting, op3_suffix_array_dedup, op4_line_dedup, op5_decontamination, op6_language_id,
    op7_pii_surrogates, op8_best_fit_packing, op9_jaccard_join, op10_toxicity, op11_rank_synchronous_counts, op12_polarised_whitening, op13_wavelet_fill_middle,
)}

ORACLES: dict[str, str] = {
    # chunks: a full line with the next full one, or alone if it has 50 words; all but a chunk's first occurrence lose their lines
    "op4_line_dedup": """
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i FROM docs),
full_lines AS (SELECT *, lead(line) OVER w AS line2, lead(i) OVER w AS i2 FROM lines WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
units AS (SELECT doc_id, i AS a, i2 AS b, line || chr(10) || line2 AS body FROM full_lines WHERE line2 IS NOT NULL
          UNION ALL SELECT doc_id, i, i, line FROM full_lines WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 50),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, a) > 1 AS again FROM units),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM ranked WHERE again),
marked AS (SELECT l.*, g.i IS NOT NULL AS goes FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT goes), '') AS text
         FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, CASE WHEN d.text IS NOT NULL THEN k.text END AS text
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
""",
    # h1 to h4: groups of 8 hex digits of the digest; a text that is whole in its form restores to itself
    "op13_wavelet_fill_middle": """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
hashed AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
                  ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM docs),
cuts AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                     WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
}
