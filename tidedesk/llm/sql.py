"""DuckDB twins of the operator queries."""

from __future__ import annotations

from tidedesk.llm import licenses

TWINS: dict[str, str] = {}

TWINS["op1_warc_transactions"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

MIX_CTES = """
WITH RECURSIVE weights(source, weight) AS (
  SELECT 'src' || i, CASE WHEN i = 0 THEN 15.0::DOUBLE ELSE (2 + 2 * (i % 3))::DOUBLE END FROM range(20) r(i)
), grouped AS (
  SELECT d.* EXCLUDE (source), d.source AS own, coalesce(w.source, '(others)') AS source, coalesce(w.weight, 2.0::DOUBLE) AS weight
  FROM {docs} d LEFT JOIN weights w USING (source)
), mass AS (
  SELECT source, sum(length(coalesce(text, '')))::BIGINT AS mass, any_value(weight) AS weight FROM grouped GROUP BY source
), weighed AS (
  SELECT sum(weight) AS total FROM mass WHERE mass > 0
), rates AS (
  SELECT source, CASE WHEN mass > 0
    THEN weight / (SELECT total FROM weighed) * (SELECT sum(mass)::BIGINT FROM mass)::DOUBLE * 1.0::DOUBLE / mass
    ELSE 0.0::DOUBLE END AS rate FROM mass
), chunked AS (
  SELECT source, rate, greatest(ceil(rate / 8), 1)::INTEGER AS n, rate / greatest(ceil(rate / 8), 1) AS mean FROM rates
), terms(source, k, p, c, mean) AS (
  SELECT source, 0, exp(-mean), exp(-mean), mean FROM chunked
  UNION ALL
  SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean FROM terms WHERE k < 47
), draws AS (
  SELECT d.*, coalesce(CAST(d.doc_id AS VARCHAR), 'null:' || md5(coalesce(d.text, ''))) AS k, row_number() OVER () AS rid, c.n, c.rate
  FROM grouped d JOIN chunked c USING (source)
), hashed AS (
  SELECT x.rid, x.source,
         ('0x' || substr(md5('17:' || x.k || ':' || g.i), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS u
  FROM draws x, unnest(range(1, x.n + 1)) g(i)
  WHERE x.rate > 0
), counted AS (
  SELECT h.rid, count(t.k) AS cnt FROM hashed h LEFT JOIN terms t ON t.source = h.source AND t.c <= h.u GROUP BY h.rid
), mixed AS (
  SELECT x.doc_id, x.text, x.lang, x.own AS source, x.n_chars, CAST(g.i AS INTEGER) AS copy,
         ('0x' || substr(md5('17:order:' || x.k || ':' || g.i), 1, 13))::BIGINT AS shuffle_key
  FROM draws x JOIN counted n USING (rid), unnest(range(1, n.cnt + 1)) g(i)
)
"""

TWINS["op3_mix_sources"] = MIX_CTES.format(docs="documents") + "SELECT * FROM mixed"

CONTAMINATION_CTES = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {docs}
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bwin AS (
  SELECT DISTINCT item_id, w[t.i:t.i + 9] AS win FROM bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0
), lens AS (
  SELECT DISTINCT len(win) AS n FROM bwin
), dwin AS (
  SELECT doc_id, t.i AS start, n, w[t.i:t.i + n - 1] AS win FROM dw, lens, unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n
), hits AS (
  SELECT d.doc_id, d.start, d.n, b.item_id, b.win FROM dwin d JOIN bwin b ON d.win = b.win
), pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(start, start + n)) t(p) GROUP BY doc_id
), wt AS (
  SELECT win, len(win) AS n, unnest(list_distinct(win)) AS term, CAST(ceil(len(list_distinct(win)) * 0.8::DOUBLE) AS INTEGER) AS needed
  FROM (SELECT DISTINCT win FROM bwin) x
), tok AS (
  SELECT doc_id, t.p, w[t.p] AS term FROM dw, unnest(range(1, len(w) + 1)) t(p)
), met AS (
  SELECT tok.doc_id, wt.win, wt.n, wt.needed, tok.p, tok.term FROM tok JOIN wt USING (term)
  JOIN (SELECT doc_id, win FROM (SELECT DISTINCT doc_id, term FROM tok) a JOIN wt USING (term) GROUP BY doc_id, win HAVING count(*) >= any_value(needed)) b
    ON b.doc_id = tok.doc_id AND b.win = wt.win
), close AS (
  SELECT a.doc_id, a.win FROM met a JOIN met b ON b.doc_id = a.doc_id AND b.win = a.win AND b.p >= a.p AND b.p < a.p + a.n + 5
  GROUP BY a.doc_id, a.win, a.p, a.needed HAVING count(DISTINCT b.term) >= a.needed
), only_near AS (
  SELECT doc_id, count(*) AS n_near FROM (
    SELECT DISTINCT doc_id, win FROM close EXCEPT SELECT DISTINCT doc_id, win FROM hits) x GROUP BY doc_id
), its AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS l FROM hits GROUP BY doc_id
)
"""

TWINS["op6_decontaminate"] = CONTAMINATION_CTES.format(docs="documents") + """
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(l), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN only_near USING (doc_id)
"""

NEAR_CTES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM {docs}
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[t.i:t.i + 4], ' ') AS g
  FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(id, reach) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.reach
), component AS (
  SELECT id AS doc_id, min(reach) AS component_id FROM r GROUP BY id
)
"""

TWINS["op5_ngram_join"] = NEAR_CTES.format(docs="documents") + """
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM w LEFT JOIN n USING (doc_id) JOIN component USING (doc_id)
"""

TWINS["op7_cross_entropy"] = r"""
WITH tok AS (
  SELECT 't' AS model, item_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark
  UNION ALL
  SELECT 'b', doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM documents
), vocab AS (
  SELECT DISTINCT unnest(w) AS word FROM tok
), width AS (
  SELECT count(*) + 2 AS v FROM vocab
), sym AS (
  SELECT t.model, t.id, g.i, t.w[g.i] AS s FROM tok t, unnest(range(1, len(t.w) + 1)) g(i)
), steps AS (
  SELECT model, id, i, s, coalesce(lag(s) OVER (PARTITION BY model, id ORDER BY i), '<edge> ') AS h FROM sym
  UNION ALL
  SELECT model, id, max(i) + 1, '<edge> ', arg_max(s, i) FROM sym GROUP BY model, id
), big AS (
  SELECT model, h, s, count(*) AS c FROM steps GROUP BY ALL
), hist AS (
  SELECT model, h, sum(c) AS c FROM big GROUP BY ALL
), uni AS (
  SELECT model, s, sum(c) AS c FROM big GROUP BY ALL
), n AS (
  SELECT model, sum(c) AS c FROM big GROUP BY ALL
), cell AS (
  SELECT DISTINCT h, s FROM steps WHERE model = 'b'
), loss AS (
  SELECT m.model, cell.h, cell.s,
    -ln(CASE WHEN hist.c IS NULL THEN 0 ELSE 0.6::DOUBLE * coalesce(big.c, 0)::DOUBLE / hist.c::DOUBLE END
        + (1::DOUBLE - CASE WHEN hist.c IS NULL THEN 0::DOUBLE ELSE 0.6::DOUBLE END)
          * ((coalesce(uni.c, 0) + 1)::DOUBLE / (coalesce(n.c, 0) + width.v)::DOUBLE)) AS x
  FROM cell CROSS JOIN (VALUES ('t'), ('b')) m(model) CROSS JOIN width
  LEFT JOIN big ON big.model = m.model AND big.h = cell.h AND big.s = cell.s
  LEFT JOIN hist ON hist.model = m.model AND hist.h = cell.h
  LEFT JOIN uni ON uni.model = m.model AND uni.s = cell.s
  LEFT JOIN n ON n.model = m.model
), sums AS (
  SELECT steps.id, count(*) FILTER (loss.model = 't') AS k, sum(x) FILTER (loss.model = 't') AS t, sum(x) FILTER (loss.model = 'b') AS b
  FROM steps JOIN loss USING (h, s) WHERE steps.model = 'b' GROUP BY steps.id
)
SELECT d.doc_id, CAST(coalesce(k - 1, 0) AS BIGINT) AS n_tokens, round(t / k, 6) AS target_loss, round(b / k, 6) AS background_loss,
       round(t / k - b / k, 6) AS score
FROM documents d LEFT JOIN sums ON sums.id = d.doc_id
"""

TWINS["op2_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, t.i, array_to_string(w[t.i:t.i + 12], ' ') AS g FROM w, unnest(range(1, len(w) - 11)) t(i) WHERE len(w) >= 13
), f AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM win
), gone AS (
  SELECT DISTINCT doc_id, p FROM f, unnest(range(i, i + 13)) t(p) WHERE first < doc_id
), kept AS (
  SELECT w.doc_id, string_agg(w.w[t.i], ' ' ORDER BY t.i) AS k, count(*) AS n
  FROM w, unnest(range(1, len(w) + 1)) t(i) LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.p = t.i
  WHERE gone.p IS NULL GROUP BY w.doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

def _license_rows() -> str:
    listed = [(t, label, "true") for t, label in licenses.PHRASES] + [(t, label, "false") for t, label in licenses.MORE]
    return ", ".join(f"({i}, '{t}', '{label}', {base})" for i, (t, label, base) in enumerate(listed))


TWINS["op11_license_scan"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), t(template, words, label, base) AS (
  VALUES """ + _license_rows() + r"""
), tw AS (
  SELECT template, label, base, string_split(words, ' ') AS w FROM t
), tg AS (
  SELECT *, array_to_string(w[p + 1:p + k], ' ') AS gram FROM (
    SELECT template, label, base, w, len(w) AS size, CASE WHEN len(w) < 5 THEN 2 ELSE 5 END AS k FROM tw), unnest(range(len(w) - k + 1)) g(p)
), dg AS (
  SELECT doc_id, p, k, array_to_string(w[p + 1:p + k], ' ') AS gram FROM dw, (VALUES (2), (5)) x(k), unnest(range(len(w) - k + 1)) g(p)
), hits AS (
  SELECT doc_id, template, label, base, size, k, dg.p AS pos, tg.p AS tpos FROM dg JOIN tg USING (k, gram)
), diag AS (
  SELECT doc_id, template, label, base, size, k, pos - tpos AS diagonal, count(*) AS votes, min(pos) AS first, max(pos) AS last
  FROM hits GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= 3 THEN 0 ELSE 1 END AS new FROM diag WHERE size >= 5
  WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)
), parts AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS part FROM marked
), covered AS (
  SELECT p.doc_id, p.template, p.part, count(DISTINCT h.tpos + c.i) AS reached
  FROM parts p JOIN hits h ON h.doc_id = p.doc_id AND h.template = p.template AND h.pos - h.tpos = p.diagonal, unnest(range(h.k)) c(i)
  GROUP BY ALL
), merged AS (
  SELECT doc_id, template, part, label, base, size, min(first) AS start, max(last + k) AS stop FROM parts GROUP BY ALL
), spans AS (
  SELECT doc_id, label, base, diagonal AS start, 1.0::DOUBLE AS cover FROM diag WHERE size < 5 AND votes = size - k + 1
  UNION ALL
  SELECT doc_id, label, base, start, reached::DOUBLE / size FROM merged JOIN covered USING (doc_id, template, part)
  WHERE reached::DOUBLE / size >= 0.75 AND stop - start <= 1.5 * size
), found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(cover) AS score
  FROM spans GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0::DOUBLE) AS score
FROM dw LEFT JOIN found USING (doc_id)
"""

TWINS["op13_fill_in_middle"] = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents
), h AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t
), c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), o AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM o
"""
