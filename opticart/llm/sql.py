"""DuckDB SQL of the native operators, for the tables of a data folder."""

from __future__ import annotations

from opticart.llm import quality_rules as qr

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality_counts(source: str) -> str:
    """CTE body: one row per row of ``source`` with its integer counts."""
    return rf"""
    base AS (
      SELECT row_number() OVER () AS rid, * FROM {source}
    ), worded AS (
      SELECT rid, {WORDS} AS ws FROM base
    ), grams AS (
      SELECT rid, unnest(range(1, len(ws) - {qr.WINDOW - 2})) AS p, ws FROM worded
      WHERE len(ws) >= {qr.WINDOW}
    ), gram_text AS (
      SELECT rid, p, array_to_string(ws[p:p + {qr.WINDOW - 1}], ' ') AS g FROM grams
    ), twice AS (
      SELECT rid, p FROM gram_text
      QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
    ), covered AS (
      SELECT rid, count(DISTINCT w) AS n_repeat_words
      FROM (SELECT rid, unnest(range(p, p + {qr.WINDOW})) AS w FROM twice) GROUP BY rid
    ), lined AS (
      SELECT rid, count(*) AS n_lines, count(DISTINCT line) AS n_distinct
      FROM (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM base)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
    ), counted AS (
      SELECT b.*, coalesce(b.lang, '') AS g_lang, coalesce(b.source, '') AS g_source,
             len(w.ws)::BIGINT AS n_words,
             length(regexp_replace(coalesce(b.text, ''), '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(coalesce(b.text, ''), '{qr.SYMBOLS}'))::BIGINT AS n_symbols,
             len(regexp_extract_all(coalesce(b.text, ''), '\p{{Lu}}'))::BIGINT AS n_upper,
             coalesce(l.n_lines, 0)::BIGINT AS n_lines,
             coalesce(l.n_lines - l.n_distinct, 0)::BIGINT AS n_dup_lines,
             coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM base b JOIN worded w USING (rid) LEFT JOIN lined l USING (rid)
      LEFT JOIN covered c USING (rid)
    ), flagged AS (
      SELECT *, n_words < {qr.MIN_WORDS}
                OR n_repeat_words * 100 > n_words * {qr.MAX_REPEAT_PCT} AS base_failed,
             [{', '.join(f'(({m.numerator} * {m.scale}) // greatest({m.denominator}, 1))'
                         for m in qr.MEASURES)}] AS vals
      FROM counted
    ), vals AS (
      SELECT g_lang, g_source, unnest(range({len(qr.MEASURES)})) AS measure, unnest(vals) AS v
      FROM flagged WHERE NOT base_failed
    ), buckets AS (
      SELECT g_lang, g_source, measure,
             v // (1::BIGINT << greatest(length(bin(v)) - {qr.SUB_BITS}, 0))
               * (1::BIGINT << greatest(length(bin(v)) - {qr.SUB_BITS}, 0)) AS bucket
      FROM vals
    ), levels AS (
      SELECT 0 AS lv, g_lang, g_source, measure, bucket FROM buckets
      UNION ALL SELECT 1, g_lang, '', measure, bucket FROM buckets
      UNION ALL SELECT 2, '', '', measure, bucket FROM buckets
    ), run AS (
      SELECT *, row_number() OVER (PARTITION BY lv, g_lang, g_source, measure ORDER BY bucket) AS r,
             count(*) OVER (PARTITION BY lv, g_lang, g_source, measure) AS n
      FROM levels
    ), quart AS (
      SELECT lv, g_lang, g_source, measure, min(n) AS n,
             min(bucket) FILTER (r * 4 >= n) AS q1, min(bucket) FILTER (r * 4 >= n * 3) AS q3
      FROM run GROUP BY ALL
    ), fence AS (
      SELECT lv, g_lang, g_source, measure, n,
             q1 - greatest((q3 - q1) * {qr.FENCE}, slack) AS lo,
             q3 + greatest((q3 - q1) * {qr.FENCE}, slack) AS hi
      FROM (SELECT *, [{', '.join(str(m.slack) for m in qr.MEASURES)}][measure + 1] AS slack
            FROM quart)
    ), each AS (
      SELECT rid, g_lang, g_source, unnest(range({len(qr.MEASURES)})) AS measure,
             unnest(vals) AS v FROM flagged
    ), chosen AS (
      SELECT e.rid, bool_and(coalesce(
        v <= (CASE WHEN o.n >= {qr.MIN_GROUP} THEN o.hi WHEN l.n >= {qr.MIN_GROUP} THEN l.hi
              WHEN o.n IS NULL THEN NULL ELSE a.hi END)
        AND (NOT [{', '.join(str(m.lower) for m in qr.MEASURES)}][e.measure + 1]
             OR v >= (CASE WHEN o.n >= {qr.MIN_GROUP} THEN o.lo WHEN l.n >= {qr.MIN_GROUP} THEN l.lo
                      WHEN o.n IS NULL THEN NULL ELSE a.lo END)), false)) AS inside
      FROM each e
      LEFT JOIN fence o ON o.lv = 0 AND o.g_lang = e.g_lang AND o.g_source = e.g_source
                       AND o.measure = e.measure
      LEFT JOIN fence l ON l.lv = 1 AND l.g_lang = e.g_lang AND l.measure = e.measure
      LEFT JOIN fence a ON a.lv = 2 AND a.measure = e.measure
      GROUP BY e.rid
    ), judged AS (
      SELECT f.*, NOT base_failed AND inside AS kept FROM flagged f JOIN chosen USING (rid)
    )"""


OP5 = f"""WITH {quality_counts('documents')}
SELECT doc_id, {', '.join(qr.COUNTS)}, base_failed, kept FROM judged"""

from opticart.llm import decontaminate as dc  # noqa: E402

_UNITS = ", ".join(f"'{u}'" for u in dc.UNITS)


def _template(source: str, key: str, id_col: str) -> str:
    """CTE bodies: typed words (key, pos, word, token, slot) of the distinct rows of ``source``."""
    return rf"""
    {key}_src AS (
      SELECT DISTINCT {id_col}, text FROM {source}
    ), {key}_base AS (
      SELECT row_number() OVER () AS {key}, * FROM {key}_src
    ), {key}_words AS (
      SELECT {key}, {id_col}, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (
        SELECT {key}, {id_col}, regexp_extract_all(
          regexp_replace(coalesce(text, ''), '[^\p{{L}}\p{{N}}\x20\x09-\x0D]+', '', 'g'),
          '[^\x20\x09-\x0D]+') AS ws FROM {key}_base)
    ), {key}_typed AS (
      SELECT *, token <> w OR token IN ('#', '^', '~') AS slot FROM (
        SELECT {key}, {id_col}, w, pos, CASE WHEN regexp_matches(w, '^\p{{Lu}}') THEN '^'
          WHEN regexp_matches(w, '^\p{{N}}') THEN '#' WHEN w IN ({_UNITS}) THEN '~' ELSE w END
          AS token FROM {key}_words)
    ), {key}_win AS (
      SELECT *, array_to_string(list(token) OVER win, ' ') AS g, list(slot) OVER win AS sl,
             count(*) OVER win AS n
      FROM {key}_typed WINDOW win AS (PARTITION BY {key} ORDER BY pos
                                      ROWS BETWEEN CURRENT ROW AND {dc.WINDOW - 1} FOLLOWING)
    )"""


def leak_ctes(source: str) -> str:
    return rf"""{_template(source, 'dk', 'doc_id')},
    {_template('benchmark', 'ik', 'item_id')}, bw AS (
      SELECT * , count(*) OVER (PARTITION BY ik) AS n_windows FROM ik_win
      WHERE n = {dc.WINDOW} AND len(list_filter(sl, lambda s: NOT s)) >= {dc.MIN_LITERAL}
    ), hits AS (
      SELECT d.dk, d.doc_id, b.ik, b.item_id, b.pos AS ipos, d.pos AS pos, b.n_windows
      FROM dk_win d JOIN bw b ON d.g = b.g AND d.n = {dc.WINDOW}
    ), slots AS (
      SELECT h.dk, h.ik, h.pos - h.ipos AS diagonal, h.ipos, i.pos AS place, i.w AS iw, t.w AS dw
      FROM hits h, range({dc.WINDOW}) r(k)
      JOIN ik_typed i ON i.ik = h.ik AND i.pos = h.ipos + k AND i.slot
      JOIN dk_typed t ON t.dk = h.dk AND t.pos = h.pos + k
    ), votes AS (
      SELECT dk, ik, diagonal, iw, dw, count(DISTINCT place) AS n FROM slots GROUP BY ALL
    ), stands_for AS (
      SELECT dk, ik, diagonal, iw, dw AS most FROM votes
      QUALIFY row_number() OVER (PARTITION BY dk, ik, diagonal, iw
                                 ORDER BY n DESC, iw <> dw, dw) = 1
    ), judged_windows AS (
      SELECT dk, ik, diagonal, ipos, bool_and(dw = most) AS agrees, bool_and(dw = iw) AS same
      FROM slots JOIN stands_for USING (dk, ik, diagonal, iw) GROUP BY ALL
    ), covered AS (
      SELECT h.dk, h.doc_id, h.ik, h.item_id, h.n_windows, h.ipos,
             bool_or(coalesce(r.same, true)) AS same
      FROM hits h LEFT JOIN judged_windows r
        ON r.dk = h.dk AND r.ik = h.ik AND r.diagonal = h.pos - h.ipos AND r.ipos = h.ipos
      WHERE coalesce(r.agrees OR r.same, true) GROUP BY ALL
    ), half AS (
      SELECT dk, doc_id, item_id, n_windows, count(*) AS n_found, bool_and(same) AS exact
      FROM covered GROUP BY dk, doc_id, ik, item_id, n_windows
      HAVING count(*) * {dc.MIN_SHARE[1]} >= n_windows * {dc.MIN_SHARE[0]}
    ), ik_low AS (
      SELECT ik, item_id, list(lower(w) ORDER BY pos) AS ws, least(count(*), {dc.RUN}) AS n
      FROM ik_words GROUP BY ik, item_id HAVING count(*) >= {dc.WINDOW}
    ), dk_low AS (
      SELECT dk, doc_id, list(lower(w) ORDER BY pos) AS ws FROM dk_words GROUP BY dk, doc_id
    ), ik_run AS (
      SELECT ik, item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS p FROM ik_low)
    ), dk_run AS (
      SELECT dk, doc_id, n, array_to_string(ws[p:p + n - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS p
            FROM dk_low, (SELECT DISTINCT n FROM ik_low) WHERE len(ws) >= n)
    ), verbatim_runs AS (
      SELECT DISTINCT dk, doc_id, ik, item_id FROM dk_run JOIN ik_run USING (n, g)
    ), leaking AS (
      SELECT dk, doc_id, item_id, n_windows, n_found, exact, false AS verbatim FROM half
      UNION ALL
      SELECT dk, doc_id, v.item_id, coalesce(b.n_windows, 0), 0, NULL, true
      FROM verbatim_runs v LEFT JOIN (SELECT DISTINCT ik, n_windows FROM bw) b USING (ik)
    )"""


OP9 = f"""WITH {leak_ctes('documents')}
SELECT doc_id, item_id, max(n_windows)::BIGINT AS n_windows, max(n_found)::BIGINT AS n_found,
       coalesce(bool_or(exact), true) AS exact, bool_or(verbatim) AS verbatim
FROM leaking GROUP BY dk, doc_id, item_id"""


def line_ctes(source: str) -> str:
    """CTE bodies: ``kept_docs`` has each row of ``source`` with the text that stays.

    The order of tokens (exact document frequency) differs from the operator's.
    """
    return rf"""
    ld AS (
      SELECT row_number() OVER () AS rid, *, coalesce(doc_id, -9223372036854775808) AS dk
      FROM {source}
    ), lln AS (
      SELECT rid, dk, hash(text) AS mk, unnest(range(len(ls))) AS line, unnest(ls) AS value
      FROM (SELECT rid, dk, text, string_split(text, chr(10)) AS ls FROM ld)
    ), lset AS (
      SELECT rid, dk, mk, line, list_sort(list(w || ' ' || nth)) AS k
      FROM (SELECT *, row_number() OVER (PARTITION BY rid, line, w) AS nth
            FROM (SELECT rid, dk, mk, line,
                         unnest(regexp_extract_all(value, '[^\x20\x09-\x0D]+')) AS w FROM lln))
      GROUP BY rid, dk, mk, line
    ), lfirst AS (
      SELECT row_number() OVER () AS lid, k, min({{'d': dk, 'l': line, 'm': mk}}) AS p, len(k) AS n
      FROM lset GROUP BY k
    ), lfreq AS (
      SELECT w, row_number() OVER (ORDER BY count(*), w) AS r
      FROM (SELECT unnest(k) AS w FROM lfirst) GROUP BY w
    ), lpre AS (
      SELECT lid, n, p, r FROM (
        SELECT lid, n, p, r, row_number() OVER (PARTITION BY lid ORDER BY r) AS i
        FROM (SELECT lid, n, p, unnest(k) AS w FROM lfirst) JOIN lfreq USING (w))
      WHERE i <= n - (n * 4 + 4) // 5 + 1
    ), lcand AS (
      SELECT DISTINCT y.lid AS y, x.lid AS x FROM lpre y JOIN lpre x
      ON x.r = y.r AND x.p < y.p AND least(x.n, y.n) * 5 >= greatest(x.n, y.n) * 4
    ), lsim AS (
      SELECT DISTINCT c.y FROM lcand c JOIN lfirst a ON a.lid = c.y JOIN lfirst b ON b.lid = c.x
      WHERE len(list_intersect(a.k, b.k)) * 9 >= (a.n + b.n) * 4
    ), lgone AS (
      SELECT s.rid, s.line FROM lset s JOIN lfirst f ON s.k = f.k
      WHERE {{'d': s.dk, 'l': s.line, 'm': s.mk}} <> f.p OR f.lid IN (SELECT y FROM lsim)
    ), lkept AS (
      SELECT l.rid, count(*) FILTER (regexp_matches(value, '[^\x20\x09-\x0D]')) AS n_lines,
             count(g.line) AS n_removed,
             string_agg(value, chr(10) ORDER BY l.line) FILTER (g.line IS NULL) AS body
      FROM lln l LEFT JOIN lgone g ON g.rid = l.rid AND g.line = l.line GROUP BY l.rid
    ), kept_docs AS (
      SELECT d.* EXCLUDE (text), d.text AS old_text, coalesce(k.n_lines, 0) AS n_lines,
             coalesce(k.n_removed, 0) AS n_removed,
             CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.body, '') END AS text
      FROM ld d LEFT JOIN lkept k USING (rid)
    )"""


OP2 = f"""WITH {line_ctes('documents')}
SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, text FROM kept_docs"""
