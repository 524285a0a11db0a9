"""SQL for DuckDB that checks the queries of ``question_queries``, which are written with DataFrame operators.

``rr``, ``rc`` and ``rl`` (replace all, count, match of a regular expression), ``<q>`` and ``<first>`` (the latest and the
first delivery of each question) are spelt out by ``dual``.
"""

from __future__ import annotations

from stemforge.plans.dual import duck_sql

_BLANKS = r"[\s\p{Z}\x{85}\x{b}]+"
_WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_NARROW = "".join(chr(0x21 + i) for i in range(94)).replace("'", "''") + " "


def squeeze(c: str) -> str:
    return f"rr({c}, '{_BLANKS}', '')"


def paper(prefix: str = "") -> str:
    return f"regexp_extract({prefix}qid, '^(.*)_[0-9]+$', 1)"


def _key(c: str) -> str:
    return f"nullif(lower(regexp_replace(translate({c}, '{_WIDE}', '{_NARROW}'), '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')), '')"


def full_width(c: str) -> str:
    for half, full in ((",", "，"), (";", "；"), (":", "："), ("!", "！"), ("\\?", "？")):
        c = f"regexp_replace({c}, '([一-鿿]){half}', '\\1{full}', 'g')"
    for _ in range(2):  # a point before a sign that the last match took
        c = f"regexp_replace({c}, '([一-鿿])\\.([^.]|$)', '\\1。\\2', 'g')"
    return c


def _fields(rows: str) -> str:
    return " UNION ALL ".join(f"SELECT qid, row_id, '{f}' AS field, {f} AS v FROM {rows} x" for f in ("stem", "answer", "passage", "figure"))


_FURNITURE = "rl(x, '考科|試題|題本|卷別|翻頁|^ *第[ 0-9]+頁[ \r]*$')"
_CONTENT = f"{squeeze('stem')} || chr(1) || array_to_string(list_sort(list_transform(coalesce(map_values(options), []), lambda o: {squeeze("coalesce(o, '')")})), chr(1))"
_FULL = f"concat_ws(chr(2), {_CONTENT}, coalesce(answer, ''), {squeeze("coalesce(passage, '')")})"
_ODD = "(VALUES ('攺', '改'), ('攄', '據'), ('堍', '境'), ('碓', '確'), ('宄', '先')) c(odd, true_form)"
_PAPER = "nullif(regexp_extract(qid, '^(.*)_[0-9]+$', 1), '')"
_TRUE = "length(stem) - length(replace(stem, true_form, ''))"

#: name: statement. Counts are BIGINT and doubles rounded, so that both engines give equal values.
STATEMENTS: dict[str, str] = {
    "agg01_year_profile": "SELECT year, count(*) AS n, CAST(sum(CASE WHEN type = '單選' THEN 1 ELSE 0 END) AS BIGINT) AS single, CAST(sum(CASE WHEN answer <> '' THEN 1 ELSE 0 END) AS BIGINT) AS answered, CAST(sum(CASE WHEN needs_figure THEN 1 ELSE 0 END) AS BIGINT) AS figures, count(DISTINCT group_id) AS groups_ FROM <q> q GROUP BY year",
    "agg06_status_rollup": "SELECT qid, status, kept_by FROM (SELECT qid, parse AS status, row_id AS kept_by, row_number() OVER (PARTITION BY qid ORDER BY CASE parse WHEN 'ok' THEN 0 WHEN 'review' THEN 1 ELSE 2 END, parse NULLS FIRST, row_id) AS k FROM bank) x WHERE k = 1",
    "agg09_finding_routes": "SELECT route, count(*) AS n, CAST(count(*) AS DOUBLE) / max(total) AS share FROM (SELECT CASE WHEN t IS NULL THEN 'input_gap' WHEN c IN ('high', 'med', 'low') THEN 'publish' WHEN c IS NULL THEN 'review' ELSE 'remap' END AS route, (SELECT count(*) FROM explanations) AS total FROM explanations) x GROUP BY route",
    "agg10_failures_by_chunk": "SELECT *, round(max(low) OVER () / nullif(CAST(sum(low) OVER () AS DOUBLE), 0), 6) AS top_share FROM (SELECT CAST(floor(expl_id / 30) AS BIGINT) AS chunk, count(*) AS n, count(*) FILTER (c = 'low') AS low FROM explanations GROUP BY 1) x",
    "agg11_two_arm_union": "SELECT count(*) AS either, CAST(sum(a * b) AS BIGINT) AS both_, CAST(sum(a) AS BIGINT) AS arm_a, CAST(sum(b) AS BIGINT) AS arm_b FROM (SELECT qid, max(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) AS a, max(CASE WHEN user_id % 2 = 1 THEN 1 ELSE 0 END) AS b FROM answer_events WHERE qid IS NOT NULL AND NOT correct GROUP BY qid) x",
    "agg12_arm_overlap": "SELECT subject, round(avg(CASE WHEN a = 0 THEN CAST(1 - b AS DOUBLE) END), 6) AS b_misses_given_a, round(avg(CAST(1 - b AS DOUBLE)), 6) AS b_misses FROM (SELECT q.subject, e.qid, max(CASE WHEN user_id % 2 = 0 AND NOT correct THEN 1 ELSE 0 END) AS a, max(CASE WHEN user_id % 2 = 1 AND NOT correct THEN 1 ELSE 0 END) AS b FROM answer_events e JOIN <q> q ON e.qid = q.qid WHERE correct IS NOT NULL GROUP BY q.subject, e.qid) x GROUP BY subject",
    "agg13_wilson": "SELECT subject, k, n, low, high, k >= 4 AND raw >= 0.0395 AS escalate FROM (SELECT subject, k, n, round(mid - half, 6) AS low, round(mid + half, 6) AS high, mid - half AS raw FROM (SELECT *, (p + 1.920729410347062 / n) / (1 + 3.841458820694124 / n) AS mid, 1.959963984540054 * sqrt(p * (1 - p) / n + 0.960364705173531 / (n * n)) / (1 + 3.841458820694124 / n) AS half FROM (SELECT *, k / CAST(n AS DOUBLE) AS p FROM (SELECT subject, count(*) FILTER (parse = 'review') AS k, count(*) AS n FROM <q> q GROUP BY subject) x) y) z) w",
    "agg17_medians": "SELECT subject, count(*) AS n, median(CAST(length(stem) AS DOUBLE)) AS mid FROM <q> q WHERE stem IS NOT NULL GROUP BY subject HAVING count(*) >= 12",
    "agg18_kappa": "SELECT CASE WHEN pe = 1 THEN NULL ELSE round((po - pe) / (1 - pe), 6) END AS kappa, round(po, 6) AS agreement FROM (SELECT avg(CASE WHEN a = b THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS po, avg(a) * avg(b) + (1 - avg(a)) * (1 - avg(b)) AS pe FROM (SELECT qid, CAST(max(CASE WHEN user_id % 2 = 0 AND correct THEN 1 ELSE 0 END) AS DOUBLE) AS a, CAST(max(CASE WHEN user_id % 2 = 1 AND correct THEN 1 ELSE 0 END) AS DOUBLE) AS b FROM answer_events WHERE qid IS NOT NULL GROUP BY qid) x) y",
    "agg20_batch_sizes": "SELECT subject, CASE WHEN count(*) FILTER (answer_src = 'key_pdf') > 0 THEN CAST(ceil(4.0 * count(*) / greatest(count(DISTINCT year), 1)) AS BIGINT) ELSE 1 END AS batch FROM <q> q GROUP BY subject",
    "agg25_artifact_sizes": "SELECT count(*) AS files, CAST(sum(n_bytes) AS BIGINT) AS bytes, round(avg(n_bytes), 4) AS mean FROM (SELECT filename, max(n_bytes) AS n_bytes FROM figure_files WHERE deleted_at IS NULL GROUP BY filename) x",
    "agg26_reasons": "SELECT coalesce(parse, '(all)') AS parse, coalesce(reason, '(all)') AS reason, n FROM (SELECT parse, reason, count(*) AS n FROM (SELECT parse, unnest(review_reasons) AS reason FROM bank WHERE parse IS NOT NULL) x WHERE reason IS NOT NULL GROUP BY ROLLUP (parse, reason)) y",
    "agg27_sensitivity": "SELECT count(*) AS rows, CAST(sum(CASE WHEN length(stem) < 13 THEN 1 ELSE 0 END) AS BIGINT) AS strict, CAST(sum(CASE WHEN length(stem) < 14 THEN 1 ELSE 0 END) AS BIGINT) AS looser FROM bank WHERE stem IS NOT NULL",
    "drv03_grading": "SELECT q.subject, count(*) AS scored, count(*) FILTER (e.correct) AS right_, count(*) FILTER (len(list_distinct(list_concat(regexp_extract_all(translate(coalesce(q.answer, ''), 'ＡＢＣＤＥＦＧＨＩＪ', 'ABCDEFGHIJ'), '[A-J]'), coalesce(q.accept, [])))) > 1) AS several_letters FROM answer_events e JOIN <q> q ON e.qid = q.qid WHERE q.answer_status IN ('official', 'multi', 'free') AND e.correct IS NOT NULL GROUP BY q.subject",
    "drv06_true_holes": "SELECT q.qid FROM <q> q WHERE q.parse = 'ok' AND q.answer_status <> 'free' AND NOT EXISTS (SELECT 1 FROM explanations e WHERE e.qid = q.qid)",
    "drv07_displayed_count": "SELECT q.subject, count(DISTINCT q.qid) AS shown FROM <q> q JOIN explanations e ON e.qid = q.qid WHERE e.t IS NOT NULL AND q.answer_status IN ('official', 'multi', 'free') GROUP BY q.subject",
    "drv08_release_diff": "SELECT count(*) AS keys, CAST(sum(CASE WHEN n.stem IS DISTINCT FROM o.stem THEN 1 ELSE 0 END) AS BIGINT) AS changed, CAST(sum(CASE WHEN length(n.stem) < length(o.stem) THEN 1 ELSE 0 END) AS BIGINT) AS shorter, CAST(sum(CASE WHEN rl(n.stem, '^[，。、；]') THEN 1 ELSE 0 END) AS BIGINT) AS leading_marks, CAST(sum(CASE WHEN n.stem IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS empty FROM <q> n JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at, row_id) AS k FROM bank) x WHERE k = 1) o ON n.qid = o.qid",
    "drv10_masked_marks": "SELECT masked, min(row_id) AS lead_row, count(*) AS rows, count(DISTINCT stem) AS stems FROM (SELECT row_id, stem, rr(stem, '[①-⑩]', '○') AS masked FROM bank WHERE rl(stem, '[①-⑩]')) x GROUP BY masked",
    "drv11_control_group": "SELECT row_id, rl_ AS odd, n FROM (SELECT row_id, regexp_extract(stem, '([攺攄堍碓宄])', 1) AS rl_, count(*) OVER (PARTITION BY subject, regexp_extract(stem, '([攺攄堍碓宄])', 1)) AS n FROM bank WHERE stem IS NOT NULL) x WHERE rl_ <> ''",
    "drv11_sibling_control": f"SELECT s.row_id, s.paper, s.odd, s.true_form, s.times, CAST(s.own + coalesce(p.n, 0) - coalesce(o.n, 0) AS BIGINT) AS siblings, s.own + coalesce(p.n, 0) - coalesce(o.n, 0) > 0 AS accepted FROM (SELECT row_id, qid, {_PAPER} AS paper, odd, true_form, CAST(length(stem) - length(replace(stem, odd, '')) AS BIGINT) AS times, CAST({_TRUE} AS BIGINT) AS own FROM bank CROSS JOIN {_ODD} WHERE contains(stem, odd)) s LEFT JOIN (SELECT {_PAPER} AS paper, odd, CAST(sum({_TRUE}) AS BIGINT) AS n FROM <q> q CROSS JOIN {_ODD} WHERE contains(stem, true_form) GROUP BY 1, 2) p ON p.paper = s.paper AND p.odd = s.odd LEFT JOIN (SELECT qid, odd, CAST({_TRUE} AS BIGINT) AS n FROM <q> q CROSS JOIN {_ODD} WHERE qid IS NOT NULL AND contains(stem, true_form)) o ON o.qid = s.qid AND o.odd = s.odd AND s.paper IS NOT NULL",
    "drv13_error_tally": "SELECT user_id, qid, count(*) AS mistakes FROM answer_events WHERE NOT correct AND qid IS NOT NULL GROUP BY user_id, qid HAVING count(*) > 1",
    "drv17_sentinel": "SELECT q.qid FROM <q> q WHERE EXISTS (SELECT 1 FROM <q> p WHERE p.parse = 'review' AND p.subject IS NOT DISTINCT FROM q.subject AND p.year IS NOT DISTINCT FROM q.year)",
    "drv20_judged_by": "SELECT CASE WHEN a > 0 AND b > 0 THEN 'both' WHEN a > 0 THEN 'a_only' ELSE 'b_only' END AS side, count(*) AS n FROM (SELECT qid, sum(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN user_id % 2 = 1 THEN 1 ELSE 0 END) AS b FROM answer_events WHERE qid IS NOT NULL GROUP BY qid) x GROUP BY 1",
    "drv22_digit_tails": "SELECT row_id FROM bank WHERE figure IS NOT NULL AND rc(right(stem, 30), '[0-9]') >= 5",
    "drv28_started_prefixes": f"SELECT DISTINCT {paper()} AS paper FROM bank WHERE {paper()} <> '' AND {paper()} NOT IN (SELECT {paper()} FROM explanations WHERE qid IS NOT NULL)",
    "dup01_fingerprints": f"SELECT row_id, length({squeeze('stem')}) < 8 OR row_number() OVER (PARTITION BY {_CONTENT} ORDER BY year DESC NULLS LAST, row_id) = 1 AS keep FROM bank WHERE stem IS NOT NULL",
    "dup02_session_exclusion": f"SELECT user_id, qid, k = 1 AS shown FROM (SELECT e.user_id, e.qid, row_number() OVER (PARTITION BY e.user_id, {squeeze('q.stem')} ORDER BY e.qid) AS k FROM (SELECT DISTINCT user_id, qid FROM answer_events WHERE qid IS NOT NULL) e JOIN <q> q ON e.qid = q.qid WHERE length({squeeze('q.stem')}) >= 13) x",
    "dup03_document_copies": "SELECT min(doc_id) AS lead_doc, count(*) AS copies, count(DISTINCT source) AS sources FROM documents WHERE text IS NOT NULL GROUP BY sha256(text) HAVING count(*) > 1",
    "dup03_extended_fingerprints": f"SELECT min(row_id) AS lead_row, count(*) AS rows, count(DISTINCT qid) AS qids FROM bank WHERE stem IS NOT NULL GROUP BY {_FULL} HAVING count(*) > 1",
    "dup05_shared_files": "SELECT sha1, count(DISTINCT filename) AS names FROM figure_files GROUP BY sha1 HAVING count(DISTINCT filename) > 1",
    "dup06_first_by_number": f"SELECT {paper()} AS paper, no, min(row_id) AS first_row FROM bank WHERE no IS NOT NULL GROUP BY 1, 2",
    "geo10_band_outliers": "SELECT regexp_extract(filename, '^([^_]*)', 1) AS prefix, count(*) FILTER (height < 70) AS short_, count(*) FILTER (height > 730) AS tall, count(*) AS files FROM figure_files GROUP BY 1",
    "join01_semi_filter": f"SELECT q.row_id, q.qid FROM <q> q WHERE EXISTS (SELECT 1 FROM bank k WHERE k.answer_src = 'key_pdf' AND {paper('k.')} = {paper('q.')} AND k.no = q.no)",
    "join02_group_passages": "SELECT q.row_id, g.members, g.first_no FROM <q> q LEFT JOIN (SELECT group_id, count(*) AS members, min(no) AS first_no FROM <q> p WHERE group_id IS NOT NULL GROUP BY group_id) g ON q.group_id = g.group_id",
    "join04_number_gaps": f"SELECT qid, no, nxt FROM (SELECT qid, no, lead(no) OVER (PARTITION BY {paper()} ORDER BY no NULLS FIRST, qid) AS nxt FROM <q> q) x WHERE nxt > no + 1",
    "join08_parity_grid": "SELECT g.arm, g.subject, coalesce(l.n, 0) AS n, coalesce(l.hits, 0) AS hits, CASE WHEN l.n IS NULL THEN 'missing' ELSE 'present' END AS state FROM (SELECT a.arm, s.subject FROM (SELECT 0 AS arm UNION ALL SELECT 1) a CROSS JOIN (SELECT DISTINCT subject FROM bank WHERE subject IS NOT NULL) s) g LEFT JOIN (SELECT CAST(e.user_id % 2 AS INT) AS arm, q.subject, count(*) AS n, CAST(sum(CASE WHEN e.correct THEN 1 ELSE 0 END) AS BIGINT) AS hits FROM answer_events e JOIN <q> q ON e.qid = q.qid GROUP BY 1, 2) l ON g.arm = l.arm AND g.subject = l.subject",
    "join09_figure_both_ways": "WITH f AS (SELECT " + _key("filename") + " AS name, sha1 FROM figure_files), b AS (SELECT DISTINCT " + _key("figure") + " AS name FROM bank) SELECT 'file_without_row' AS side, count(DISTINCT name) AS n FROM f WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM b WHERE name IS NOT NULL) UNION ALL SELECT 'row_without_file', count(*) FROM b WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM f WHERE name IS NOT NULL) UNION ALL SELECT 'shared_content', count(*) FROM (SELECT sha1 FROM f WHERE name IS NOT NULL GROUP BY sha1 HAVING count(DISTINCT name) > 1) s",
    "join12_stale_stamps": "SELECT CASE WHEN e.src_fp IS NULL THEN 'unstamped' WHEN q.qid IS NULL THEN 'no_source' WHEN e.src_fp = substr(sha256(coalesce(q.stem, '')), 1, 12) THEN 'current' ELSE 'stale' END AS state, count(*) AS n FROM explanations e LEFT JOIN <q> q ON e.qid = q.qid GROUP BY 1",
    "join13_manifest_parity": f"SELECT field, state, count(*) AS n FROM (SELECT o.field, CASE WHEN o.v IS NULL AND n.v IS NULL THEN 'both_null' WHEN o.v IS NULL OR n.v IS NULL THEN 'missing_field' WHEN o.v = n.v THEN 'same' ELSE 'hash_differs' END AS state FROM ({_fields('<first>')}) o JOIN ({_fields('<q>')}) n ON o.qid = n.qid AND o.field = n.field AND o.row_id <> n.row_id) x GROUP BY ALL",
    "join15_subject_overlap": "SELECT n.*, coalesce(e.exams, 0) AS exams FROM (SELECT subject, exam, count(*) AS n FROM <q> q GROUP BY subject, exam) n LEFT JOIN (SELECT subject, count(DISTINCT exam) AS exams FROM <q> p GROUP BY subject) e ON n.subject IS NOT DISTINCT FROM e.subject",
    "join20_name_suffixes": "SELECT a.law AS longer, b.law AS shorter FROM (SELECT DISTINCT law FROM anchor_packs) a JOIN (SELECT DISTINCT law FROM anchor_packs) b ON length(a.law) > length(b.law) AND b.law <> '' AND suffix(a.law, b.law)",
    "join21_top_relations": "SELECT user_id, qid, CAST(pos AS BIGINT) AS pos, n FROM (SELECT user_id, qid, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, qid) AS pos FROM (SELECT user_id, qid, count(*) AS n FROM answer_events WHERE qid IS NOT NULL GROUP BY user_id, qid) c) x WHERE pos <= 4",
    "join22_shared_explanations": f"SELECT row_id, lead_row, members FROM (SELECT row_id, min(row_id) OVER (PARTITION BY fp) AS lead_row, count(*) OVER (PARTITION BY fp) AS members FROM (SELECT row_id, {_FULL} AS fp FROM bank WHERE stem IS NOT NULL AND group_id IS NULL) x) y WHERE members > 1",
    "nrm04_squeezed_length": "SELECT row_id, CAST(length(" + squeeze("stem") + ") AS BIGINT) AS n FROM bank WHERE stem IS NOT NULL",
    "nrm07_answer_width": "SELECT row_id, translate(answer, 'ＡＢＣＤＥＦＧＨＩＪ０１２３４５６７８９', 'ABCDEFGHIJ0123456789') AS answer_key FROM bank WHERE answer IS NOT NULL",
    "nrm11_line_ends": "SELECT expl_id, " + full_width("rr(rr(replace(t, '\\n', chr(10)), '\r\n?', chr(10)), '\n+', chr(10) || chr(10))") + " AS t FROM explanations WHERE t IS NOT NULL",
    "nrm18_roc_years": "SELECT row_id, year, CAST(year + 1911 AS BIGINT) AS ce_year FROM bank WHERE year IS NOT NULL",
    "nrm19_safe_names": "SELECT pack_row, trim(rr(law, '[^0-9A-Za-z_一-鿿]+', '_'), '_') AS safe FROM anchor_packs",
    "nrm20_visible_text": "SELECT expl_id, rr(rr(chr(10) || t || chr(10) || '&' || chr(10) || '<end>', '[ \t]*\n\\s*', chr(10)), '^\\s+|\\s+$', '') AS text FROM explanations WHERE t IS NOT NULL AND NOT contains(t, '<') AND NOT contains(t, '&')",
    "nrm23_term_mapping": "SELECT expl_id, CASE c WHEN 'medium' THEN 'med' WHEN 'MED' THEN 'med' WHEN 'HIGH' THEN 'high' WHEN 'LOW' THEN 'low' ELSE c END AS c FROM explanations",
    "nrm24_text_digest": "SELECT doc_id, substr(sha256(array_to_string(list_transform(string_split(trim(replace(text, 'HB-CORE', '<OUT>'), ' '), chr(10)), lambda x: rtrim(x, ' ')), chr(10))), 1, 16) AS digest FROM documents WHERE text IS NOT NULL",
    "par03_group_spans": "SELECT *, coalesce(span <= 10 AND members = span, FALSE) AS sane FROM (SELECT group_id, CAST(max(no) - min(no) + 1 AS BIGINT) AS span, count(*) AS members, count(DISTINCT passage) AS passages FROM <q> q WHERE group_id IS NOT NULL GROUP BY group_id) x",
    "par09_question_types": "SELECT subject, kind, count(*) AS n FROM (SELECT subject, CASE WHEN a = '／' OR (a = '' AND coalesce(cardinality(options), 0) = 0) THEN '非選' WHEN len(regexp_extract_all(a, '[A-J]')) > 1 THEN '多選' ELSE '單選' END AS kind FROM (SELECT *, translate(coalesce(answer, ''), 'ＡＢＣＤＥＦＧＨＩＪ', 'ABCDEFGHIJ') AS a FROM <q> y) q) x GROUP BY subject, kind",
    "par10_domain_words": "SELECT doc_id, CASE WHEN a > b AND a > c THEN 'law' WHEN b > a AND b > c THEN 'history' WHEN c > a AND c > b THEN 'geography' ELSE '' END AS domain FROM (SELECT doc_id, rc(text, '契約|時效|抗告|損害賠償') AS a, rc(text, '王朝|條約|編年史|族譜') AS b, rc(text, '流域|季風|盆地|海岸線') AS c FROM documents WHERE text IS NOT NULL) x",
    "prd01_furniture_lines": f"SELECT row_id, CAST(len(list_filter(string_split(stem, chr(10)), lambda x: {_FURNITURE})) AS BIGINT) AS dropped, array_to_string(list_filter(string_split(stem, chr(10)), lambda x: NOT {_FURNITURE}), chr(10)) AS text FROM bank WHERE stem IS NOT NULL",
    "prd03_figure_flag": "SELECT qid, needs_figure, rl(concat_ws(' ', stem, passage), '如圖|下圖|附圖|圖中|圖一|圖二|圖示|右圖|左圖|下表|附表') OR (n > 0 AND n < 4) OR (n > 0 AND filled = 0) AS needs FROM (SELECT *, coalesce(cardinality(options), 0) AS n, coalesce(len(list_filter(map_values(options), lambda o: trim(coalesce(o, ''), ' ') <> '')), 0) AS filled FROM <q> x) q",
    "prd07_anomalous_signs": "SELECT * FROM (SELECT row_id, rc(concat_ws(chr(1), stem, passage, array_to_string(map_values(options), chr(1)), table_md), '[\\x{e000}-\\x{f8ff}\\x{f900}-\\x{faff}]') AS signs FROM bank) x WHERE signs > 0",
    "prd08_structure": "SELECT * FROM (SELECT expl_id, concat_ws(',', CASE WHEN len(p) <> 3 THEN 'sections' END, CASE WHEN NOT starts_with(p[1], '正解：') THEN 'head' END, CASE WHEN NOT starts_with(p[-1], '本題考點：') THEN 'tail' END) AS faults FROM (SELECT expl_id, string_split_regex(replace(t, chr(13) || chr(10), chr(10)), '\n{2,}') AS p FROM explanations WHERE t IS NOT NULL) x) y WHERE faults <> ''",
    "prd10_conclusion": "SELECT * FROM (SELECT e.expl_id, q.answer, coalesce(nullif(regexp_extract(e.t, '故選[ 　]*[(（]?([A-J]+)', 1), ''), regexp_extract(e.t, '^正解：[(（]([A-J]+)[)）]', 1)) AS said FROM explanations e JOIN <q> q ON e.qid = q.qid WHERE e.t IS NOT NULL AND q.answer IS NOT NULL) x WHERE said <> '' AND said <> translate(answer, 'ＡＢＣＤＥＦＧＨＩＪ', 'ABCDEFGHIJ')",
    "prd11_boilerplate": "SELECT expl_id, rr(t, '[^。\nA-Za-z0-9第]{0,40}(?:僅供參考|以上解析|如有疑義|請以官方)[^。\nA-Za-z0-9第]{0,40}。?\\s*$', '') AS t FROM explanations WHERE rl(t, '僅供參考|以上解析|如有疑義|請以官方')",
    "prd13_half_marks": "SELECT row_id, rc(stem, '[一-鿿][,;:?!]') AS marks FROM bank WHERE rl(stem, '[一-鿿][,;:?!]')",
    "prd15_repeated_marks": "SELECT row_id FROM bank WHERE rl(stem, '" + "|".join(f"{c}[^①-⑩]*{c}" for c in "①②③④⑤⑥⑦⑧⑨⑩") + "')",
    "prd16_open_stems": "SELECT row_id FROM <q> q WHERE stem IS NOT NULL AND NOT rl(stem, '[。？！?!:：」][\\s　]*$')",
    "prd17_text_after_mark": "SELECT row_id FROM <q> q WHERE rl(stem, '？[^？\n）」 　\r]')",
    "prd19_quote_balance": "SELECT row_id, letter FROM (SELECT row_id, unnest(map_keys(options)) AS letter, unnest(map_values(options)) AS o FROM bank) x WHERE rc(o, '「') <> rc(o, '」')",
    "prd25_follow_ups": "SELECT row_id, standalone FROM bank WHERE rl(stem, '承上題|承前題|上題中|前題')",
    "prd26_audit_gaps": "SELECT * FROM (SELECT qid, concat_ws(',', CASE WHEN coalesce(answer, '') = '' THEN 'no_answer' END, CASE WHEN answer_src IS NULL THEN 'no_source' END, CASE WHEN stem IS NULL THEN 'no_stem' END, CASE WHEN subject IS NULL THEN 'no_subject' END) AS gaps FROM <q> q) x WHERE gaps <> ''",
    "prd27_answerable": "SELECT subject, count(*) AS rows, CAST(sum(CASE WHEN answer_status IN ('official', 'multi', 'free') THEN 1 ELSE 0 END) AS BIGINT) AS answerable FROM <q> q GROUP BY subject",
    "prd28_status_domain": "SELECT coalesce(answer_status, '(none)') AS status, count(*) AS n, CAST(sum(CASE WHEN answer_status IN ('none_published', 'not_applicable', 'unread') AND rl(answer, '^[A-J]+$') THEN 1 ELSE 0 END) AS BIGINT) AS legal_looking FROM bank GROUP BY 1",
    "prd34_negative_stems": "SELECT row_id FROM bank WHERE rl(stem, '何者錯誤|何者有誤|何者不正確|何者不適當|不正確的是|錯誤的是')",
    "set03_validated": "SELECT CASE WHEN t IS NULL OR trim(t, ' ') = '' THEN 'no_text' WHEN c IS NULL OR c NOT IN ('high', 'med', 'low') THEN 'bad_level' ELSE 'ok' END AS state, count(*) AS n FROM explanations GROUP BY 1",
    "set04_untouched": "WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at DESC, row_id DESC) AS k FROM bank WHERE loaded_at < TIMESTAMP '2024-07-01') x WHERE k = 1), n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at DESC, row_id DESC) AS k FROM bank WHERE loaded_at >= TIMESTAMP '2024-07-01') x WHERE k = 1) SELECT CASE WHEN n.qid IS NULL THEN 'kept' ELSE 'replaced' END AS state, count(*) AS keys, count(*) FILTER (n.qid IS NOT NULL AND n.stem IS DISTINCT FROM o.stem) AS touched FROM o LEFT JOIN n ON o.qid = n.qid GROUP BY 1",
    "set11_real_proposals": "SELECT p.row_id FROM proof_stems p JOIN bank b ON p.row_id = b.row_id WHERE p.stem IS DISTINCT FROM b.stem",
    "set12_work_list": "SELECT q.qid FROM <q> q WHERE q.parse = 'ok' AND NOT EXISTS (SELECT 1 FROM explanations e WHERE e.qid = q.qid AND e.t IS NOT NULL)",
    "smp02_laplace_weights": "SELECT user_id, subject, round(1 - CAST(ok + 1 AS DOUBLE) / (n + 2) + CAST(0.15 AS DOUBLE), 6) AS weight FROM (SELECT e.user_id, q.subject, count(*) AS n, CAST(sum(CASE WHEN e.correct THEN 1 ELSE 0 END) AS BIGINT) AS ok FROM answer_events e JOIN <q> q ON e.qid = q.qid WHERE e.correct IS NOT NULL GROUP BY e.user_id, q.subject) x",
    "smp03_quota": "SELECT c, expl_id FROM (SELECT e.c, e.expl_id, row_number() OVER (PARTITION BY e.c ORDER BY sha256(CAST(e.expl_id AS VARCHAR)), e.expl_id) AS k, d.n FROM explanations e JOIN (SELECT c, count(*) AS n FROM explanations WHERE contains(t, chr(13)) GROUP BY c) d ON e.c = d.c WHERE NOT contains(e.t, chr(13))) x WHERE k <= n",
    "smp05_least_mastered": "SELECT user_id, subject, ok FROM (SELECT user_id, subject, ok, rank() OVER (PARTITION BY user_id ORDER BY ok, subject) AS k FROM (SELECT e.user_id, q.subject, round(avg(CASE WHEN e.correct THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS ok FROM answer_events e JOIN <q> q ON e.qid = q.qid WHERE e.correct IS NOT NULL AND q.subject IS NOT NULL GROUP BY e.user_id, q.subject) x) y WHERE k = 1",
    "snk05_safe_json": "SELECT doc_id, replace(CAST(json_object('doc_id', doc_id, 'text', text || '</script>') AS VARCHAR), '</', '<\\/') AS safe FROM documents WHERE text IS NOT NULL",
    "snk07_bundle": "SELECT q.exam, count(*) AS questions, CAST(sum(coalesce(e.n, 0)) AS BIGINT) AS explanations, count(DISTINCT nullif(trim(q.figure, ' '), '')) AS figures FROM <q> q LEFT JOIN (SELECT qid, count(*) AS n FROM explanations WHERE t IS NOT NULL AND qid IS NOT NULL GROUP BY qid) e ON q.qid = e.qid WHERE q.exam IS NOT NULL GROUP BY q.exam",
    "snk09_figure_collector": "SELECT DISTINCT figure FROM (SELECT figure FROM bank UNION ALL SELECT unnest(regexp_extract_all(concat_ws(' ', passage, table_md), '\\{img:([^}]*)\\}|!\\[[^\\]]*\\]\\(([^)]*)\\)', 1)) FROM bank) x WHERE figure IS NOT NULL AND trim(figure, ' ') <> ''",
    "src12_newest_hit": "SELECT qid, expl_id FROM (SELECT qid, expl_id, row_number() OVER (PARTITION BY qid ORDER BY merged_at DESC, expl_id DESC) AS k FROM explanations WHERE t IS NOT NULL AND qid IS NOT NULL) x WHERE k = 1",
    "srt02_sorted_sets": "SELECT subject, coalesce(array_to_string(list_sort(list(DISTINCT year) FILTER (year IS NOT NULL)), ','), '') AS years FROM bank GROUP BY subject",
    "srt04_listing_with_rest": "SELECT subject, qid, CAST(k AS BIGINT) AS k, hidden FROM (SELECT subject, qid, row_number() OVER (PARTITION BY subject ORDER BY qid) AS k, greatest(count(*) OVER (PARTITION BY subject) - 10, 0) AS hidden FROM <q> q WHERE parse <> 'ok') x WHERE k <= 10",
    "win01_anchor_fill": f"SELECT qid, last_value(CASE WHEN NOT rl(stem, '承上題|承前題|上題中|前題') THEN no END IGNORE NULLS) OVER (PARTITION BY {paper()} ORDER BY no, qid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor FROM <q> q WHERE stem IS NOT NULL AND no IS NOT NULL",
    "win03_cooldown": f"WITH s AS (SELECT e.user_id, e.qid, max(e.ts) AS last_ts, any_value({squeeze('q.stem')}) AS fp FROM answer_events e JOIN <q> q ON e.qid = q.qid WHERE q.stem IS NOT NULL GROUP BY e.user_id, e.qid), r AS (SELECT DISTINCT user_id, fp FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_ts DESC NULLS LAST, qid) AS k FROM s) x WHERE k <= 30), p AS (SELECT s.*, EXISTS (SELECT 1 FROM r WHERE r.user_id = s.user_id AND r.fp = s.fp) AS hot FROM s), o AS (SELECT user_id, count(*) FILTER (NOT hot) AS open_n FROM p GROUP BY user_id) SELECT user_id, qid, open_n = 0 AS fallback FROM p JOIN o USING (user_id) WHERE NOT hot OR open_n = 0",
    "win05_chunks": "SELECT qid, CAST(floor((k - 1) / CASE WHEN fig THEN 12 ELSE 20 END) AS BIGINT) AS chunk FROM (SELECT qid, coalesce(needs_figure, FALSE) AS fig, row_number() OVER (PARTITION BY subject, coalesce(needs_figure, FALSE) ORDER BY year NULLS LAST, no NULLS LAST, qid) AS k FROM <q> q) x",
    "win06_last_ten_years": "SELECT subject, year, count(*) AS n FROM (SELECT subject, year, dense_rank() OVER (PARTITION BY subject ORDER BY year DESC) AS k FROM <q> q WHERE year IS NOT NULL) x WHERE k <= 10 GROUP BY subject, year",
    "win07_interleave": "SELECT arm, qid, CAST(2 * (k - 1) + arm AS BIGINT) AS slot FROM (SELECT CAST(no % 2 AS INT) AS arm, qid, row_number() OVER (PARTITION BY subject, CAST(no % 2 AS INT) ORDER BY year NULLS LAST, no, qid) AS k FROM <q> q WHERE no IS NOT NULL) x",
    "win08_next_item": f"SELECT qid, lead(no) OVER (PARTITION BY {paper()} ORDER BY no NULLS FIRST, qid) AS next_no FROM <q> q",
    "win10_freshness": "SELECT expl_id, CASE WHEN merged_at < (SELECT max(merged_at) FROM explanations) - INTERVAL 180 DAY THEN 'unknown' ELSE c END AS c FROM explanations",
}
SQL = {k: duck_sql(s) for k, s in STATEMENTS.items()}
