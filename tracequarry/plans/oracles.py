"""DuckDB SQL of the catalogue's queries."""

from __future__ import annotations

from tracequarry.functions.text import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _identifiers(text: str) -> str:
    return (
        f"list_filter(string_split_regex(coalesce({text}, ''), '[^\\p{{L}}\\p{{N}}_]+'), "
        f"lambda w: regexp_full_match(w, '[A-Za-z_][A-Za-z0-9_]{{2,}}') AND lower(w) NOT IN ({_STOP}))"
    )


_TOKENS = f"""
doc_tokens AS (SELECT doc_id, list_sort(list_distinct({_identifiers('text')})) AS toks FROM documents),
post AS (SELECT doc_id, lower(t) AS token, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS t FROM doc_tokens) GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM post GROUP BY token)
"""

_TOOLS = ", ".join(f"'src{i}'" for i in range(10))
_ITEMS = f"""
items AS (
  SELECT item_id, item_id % 7 = 3 AS silent, CASE WHEN item_id % 7 = 3 THEN [] ELSE {_identifiers('text')} END AS kws,
    CASE WHEN lower(text[1]) < 'i' THEN ['en', 'fr'] WHEN lower(text[1]) < 'p' THEN ['en'] END AS wish,
    CASE WHEN item_id % 3 = 0 THEN [{_TOOLS}] END AS tools, CASE WHEN item_id % 4 = 1 THEN true END AS checked
  FROM benchmark),
cand AS (
  SELECT item_id, doc_id FROM documents, items
  WHERE (wish IS NULL OR list_contains(wish, lang)) AND (tools IS NULL OR list_contains(tools, source))
    AND (checked IS NULL OR checked = regexp_matches(text, '(?i)(test|check|pytest|run|verify|build)')))
"""

_RECALL = f"""{_TOKENS}, {_ITEMS},
kw AS (SELECT item_id, lower(k) AS token, count(*) AS times FROM (SELECT item_id, unnest(kws) AS k FROM items) GROUP BY ALL),
bm AS (
  SELECT item_id, doc_id, sum(floor(times * ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2) * 1e12::DOUBLE + 0.5)::BIGINT)::DOUBLE / 1e12::DOUBLE AS s
  FROM post JOIN df USING (token) JOIN kw USING (token) CROSS JOIN (SELECT count(*) AS n FROM documents)
  GROUP BY ALL HAVING s > 0),
qv AS (
  SELECT item_id, embedding::DOUBLE[] AS v FROM items JOIN embeddings ON vec_id = item_id WHERE NOT silent
  UNION ALL SELECT item_id, list_reverse(embedding)::DOUBLE[] FROM items JOIN embeddings ON vec_id = item_id + 1 WHERE NOT silent AND item_id % 2 = 0),
vs AS (
  SELECT item_id, doc_id, max(list_cosine_similarity(v, de.embedding::DOUBLE[])) AS s
  FROM qv CROSS JOIN documents d JOIN embeddings de ON de.vec_id = d.doc_id GROUP BY ALL HAVING s > 0),
r1 AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS r1 FROM bm SEMI JOIN cand USING (item_id, doc_id)),
r2 AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS r2 FROM vs SEMI JOIN cand USING (item_id, doc_id)),
fused AS (
  SELECT item_id, doc_id, r1, r2,
    CASE WHEN max(coalesce(r1, r2)) OVER (PARTITION BY item_id) IS NULL THEN 1.0
      ELSE coalesce(1.0 / (60 + r1), 0) + coalesce(1.0 / (60 + r2), 0) END AS rrf
  FROM cand LEFT JOIN r1 USING (item_id, doc_id) LEFT JOIN r2 USING (item_id, doc_id)),
hits AS (
  SELECT item_id, doc_id, rrf, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rrf DESC, r1 NULLS LAST, r2 NULLS LAST, doc_id) AS rank FROM fused)
  WHERE rank <= 20)
"""

_SCORED = f"""{_RECALL},
scored AS (
  SELECT h.item_id, h.doc_id, h.rrf, h.rank, coalesce(l.quality = 1, false) AS m, CASE WHEN l.toxic = 1 THEN 0.6 ELSE 0.9 END AS confidence,
    h.rrf * CASE WHEN coalesce(l.quality = 1, false) THEN 1.0 ELSE 0.3 END AS relevance, h.item_id * 1000 + h.rank AS seq,
    (d.n_chars // 1000) AS span_end, d.lang, d.source
  FROM hits h JOIN documents d ON d.doc_id = h.doc_id LEFT JOIN labels l ON l.doc_id = h.doc_id),
merged AS (
  SELECT doc_id, string_agg(item_id::VARCHAR, ',' ORDER BY seq) AS sub_problems, max(relevance) AS relevance, sum(relevance) AS total,
    min(seq) AS seq, any_value(span_end) AS span_end, any_value(lang) AS lang, any_value(source) AS source
  FROM scored WHERE m GROUP BY doc_id),
chosen AS (SELECT doc_id, total, row_number() OVER (ORDER BY total DESC, seq) - 1 AS pick FROM merged QUALIFY pick < 10)
"""

_STEPS = """
st AS (
  SELECT user_id AS trajectory_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step_index,
    CASE event_type WHEN 'signup' THEN 'user' WHEN 'error' THEN 'tool' ELSE 'assistant' END AS role,
    CASE event_type WHEN 'view' THEN 'Read' WHEN 'click' THEN 'Edit' WHEN 'purchase' THEN 'Bash' END AS tool,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END AS kind
  FROM events),
sc AS (
  SELECT *, CASE WHEN step_index = 0 THEN 0 ELSE
      CASE WHEN role = 'user' THEN 10 ELSE 0 END
      + CASE WHEN kind <> last_value(kind IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY step_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 5 ELSE 0 END
      + CASE WHEN tool = 'Bash' THEN 3 ELSE 0 END END AS score
  FROM st)
"""

_SLICES = f"""{_STEPS},
len AS (SELECT trajectory_id, count(*) AS n FROM st GROUP BY 1),
cuts AS (
  SELECT trajectory_id, 0::BIGINT AS pos FROM len
  UNION ALL
  SELECT trajectory_id, nxt FROM (
    SELECT c.trajectory_id, coalesce(
        arg_max(sc.step_index, sc.score * 1000000 - sc.step_index) FILTER (sc.score > 0),
        CASE WHEN c.pos + 10 < any_value(l.n) THEN c.pos + 10 END) AS nxt
    FROM cuts c JOIN len l ON l.trajectory_id = c.trajectory_id
      LEFT JOIN sc ON sc.trajectory_id = c.trajectory_id AND sc.step_index BETWEEN c.pos + 4 AND least(c.pos + 10, l.n)
    WHERE l.n > 10 GROUP BY c.trajectory_id, c.pos) WHERE nxt IS NOT NULL),
sl AS (
  SELECT c.trajectory_id, row_number() OVER w - 1 AS slice_index, pos AS start_step, coalesce(lead(pos) OVER w, n) - 1 AS end_step
  FROM cuts c JOIN len USING (trajectory_id) WINDOW w AS (PARTITION BY c.trajectory_id ORDER BY pos))
"""

_OUTCOMES = """
oc AS (
  SELECT event_id, user_id, ts, event_type,
    CASE event_type WHEN 'error' THEN 'timeout' WHEN 'purchase' THEN 'overload' WHEN 'click' THEN 'abnormal_response' ELSE 'success' END AS outcome
  FROM events)
"""

_CENTROIDS = """
cent AS (
  SELECT label, list(x ORDER BY i) AS vector FROM (
    SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL)
  GROUP BY label)
"""

_PLACES = """
places AS (
  SELECT r_name AS label, NULL::VARCHAR AS parent FROM region
  UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
"""

_PAIRS = f"""{_TOKENS},
reps AS (SELECT toks, min(doc_id) AS first FROM doc_tokens WHERE len(toks) > 0 GROUP BY toks),
tk AS (SELECT first, len(toks) AS n, unnest(toks) AS t FROM reps),
pairs AS (
  SELECT a.first AS a, b.first AS b FROM tk a JOIN tk b ON a.t = b.t AND a.first < b.first AND least(a.n, b.n) >= 0.9 * greatest(a.n, b.n) - 1e-9
  GROUP BY a.first, b.first, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= 0.9)
"""

_ROUTES = """
rows AS (SELECT source AS case_id, CASE WHEN quality = 1 THEN 'pass' ELSE 'drop' END AS want, CASE WHEN n_chars >= 300 THEN 'pass' ELSE 'drop' END AS got
  FROM labels JOIN documents USING (doc_id)),
w AS (SELECT case_id, want AS route, count(*) AS n FROM rows GROUP BY ALL),
g AS (SELECT case_id, got AS route, count(*) AS n FROM rows GROUP BY ALL),
scores AS (SELECT w.case_id, sum(least(w.n, coalesce(g.n, 0)))::BIGINT AS agreed, sum(w.n)::BIGINT AS expected FROM w LEFT JOIN g USING (case_id, route) GROUP BY 1)
"""

_MARKER = "chr(10) || chr(10) || '[... content truncated ...]' || chr(10) || chr(10)"


def _cut(text: str, limit: str) -> str:
    usable = f"greatest({limit} - 31, 0)"
    head = f"greatest(floor({usable} * 0.3), 1)::INT"
    tail = f"greatest({usable} - {head}, 1)::INT"
    return f"CASE WHEN length({text}) <= {limit} THEN {text} ELSE left({text}, {head}) || {_MARKER} || right({text}, {tail}) END"


def _short(text: str, limit: int) -> str:
    flat = f"replace(coalesce({text}, ''), chr(10), '\\n')"
    return f"CASE WHEN length({flat}) > {limit} THEN left({flat}, {limit}) || '...' ELSE {flat} END"


SQL = {
    "steps_from_conversations": """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS step_index, role, md5(coalesce(text, '')) AS content_md5
FROM conversations WHERE role IN ('user', 'assistant', 'tool', 'system')""",
    "turn_and_step_counts": """
SELECT conv_id, count(*) AS step_count, count(*) FILTER (role = 'user') AS turn_count FROM conversations GROUP BY conv_id""",
    "text_flags": r"""
SELECT doc_id, regexp_matches(text, '(?i)(test|check|pytest|run|verify|build)') AS verifies,
  regexp_matches(text, '(?i)(Traceback \(most recent call last\)|SyntaxError:|Error:|Exception:|FAILED|panic:)') AS has_error,
  regexp_matches(text, '(?i)(file created|file edited|successfully|\d+ passed)') OR regexp_matches(text, '(?m)(PASSED|OK$)') AS has_success,
  CASE WHEN len(found) = 0 THEN 'other' ELSE array_to_string(found, ',') END AS languages
FROM (SELECT *, list_filter([
  CASE WHEN regexp_matches(text, '(?i)(\.py\b|python|import\s|def\s|class\s)') THEN 'python' END,
  CASE WHEN regexp_matches(text, '(?i)(\.js\b|\.ts\b|node|require\(|import.*from)') THEN 'javascript' END,
  CASE WHEN regexp_matches(text, '(?i)(\.sh\b|bash|#!/bin)') THEN 'bash' END,
  CASE WHEN regexp_matches(text, '(?i)(\.java\b|public\s+class)') THEN 'java' END,
  CASE WHEN regexp_matches(text, '(?i)(\.(cpp|cc|h)\b|#include)') THEN 'cpp' END,
  CASE WHEN regexp_matches(text, '(?i)(\.go\b|package\s+main|func\s+main)') THEN 'go' END,
  CASE WHEN regexp_matches(text, '(?i)(\.html\b|<html|<div)') THEN 'html' END], lambda x: x IS NOT NULL) AS found FROM documents)""",
    "bm25_tokens": f"WITH {_TOKENS} SELECT doc_id, len(toks) AS n_tokens, md5(array_to_string(toks, ' ')) AS tokens_md5 FROM doc_tokens",
    "boundary_scores": f"WITH {_STEPS} SELECT trajectory_id, step_index, score::BIGINT AS boundary_score FROM sc",
    "greedy_slices": f"WITH RECURSIVE {_SLICES} SELECT trajectory_id, slice_index, start_step, end_step FROM sl",
    "slice_signatures": f"""
WITH RECURSIVE {_SLICES}
SELECT sl.trajectory_id, slice_index, count(*) AS step_count, count(*) FILTER (role = 'user') AS turn_count,
  coalesce(string_agg(DISTINCT tool, ',' ORDER BY tool), '') AS tools_used, bool_or(role = 'tool') AS has_error_pattern,
  false AS has_success_pattern, coalesce(bool_or(tool = 'Bash'), false) AS has_verification_step
FROM sl JOIN st ON st.trajectory_id = sl.trajectory_id AND step_index BETWEEN start_step AND end_step GROUP BY sl.trajectory_id, slice_index""",
    "summary_lines": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(text, '') AS said, CASE WHEN turn % 4 = 3 THEN 'tool' WHEN turn = 6 THEN 'critic' ELSE role END AS role,
    role = 'assistant' AND turn % 2 = 0 AS calls FROM conversations)
SELECT conv_id, turn, CASE role
  WHEN 'assistant' THEN 'Step ' || turn || ': [assistant] ' || {_short('said', 150)} || CASE WHEN calls THEN ' → call Edit("' || {_short('reverse(said)', 200)} || '")' ELSE '' END
  WHEN 'tool' THEN 'Step ' || turn || ': [result] ' || CASE WHEN turn = 3 THEN {_short("'result' || chr(10) || said", 300)} ELSE {_short('said', 300)} END
  WHEN 'critic' THEN NULL ELSE 'Step ' || turn || ': [' || role || '] ' || {_short('said', 150)} END AS line
FROM t""",
    "problem_ids": r"""
SELECT doc_id, left(sha1(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')), 16) AS problem_id
FROM documents""",
    "document_frequency": f"""
WITH {_TOKENS} SELECT token, df, round(ln((n - df + 0.5) / (df + 0.5) + 1), 6) AS idf FROM df CROSS JOIN (SELECT count(*) AS n FROM documents)""",
    "structured_filter_overlap": f"""
WITH {_ITEMS} SELECT item_id AS sub_problem_id, count(*) AS candidates, max(doc_id) AS last_doc FROM cand GROUP BY item_id""",
    "bm25_topn": f"""
WITH {_RECALL} SELECT item_id AS sub_problem_id, doc_id, rank, bm25 FROM (
  SELECT item_id, doc_id, round(s, 6) AS bm25, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS rank FROM bm) WHERE rank <= 20""",
    "vector_topn": f"""
WITH {_RECALL} SELECT item_id AS sub_problem_id, doc_id, rank, cosine FROM (
  SELECT item_id, doc_id, round(s, 5) AS cosine, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS rank FROM vs) WHERE rank <= 20""",
    "rrf_recall_multi": f"WITH {_RECALL} SELECT item_id AS sub_problem_id, doc_id, rank, round(rrf, 6) AS rrf FROM hits",
    "cache_hits": f"""
WITH {_RECALL} SELECT item_id AS sub_problem_id, h.doc_id AS trajectory_id, rank, quality::BIGINT AS quality FROM hits h JOIN labels l ON l.doc_id = h.doc_id WHERE item_id % 2 = 0""",
    "cache_misses": f"""
WITH {_RECALL} SELECT item_id AS sub_problem_id, doc_id AS trajectory_id, rank FROM hits h
WHERE item_id % 2 <> 0 OR NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = h.doc_id)""",
    "soft_rerank": f"""
WITH {_SCORED} SELECT item_id AS sub_problem_id, doc_id AS trajectory_id,
  row_number() OVER (PARTITION BY item_id ORDER BY relevance DESC, rank) AS local_rank, round(relevance, 6) AS relevance FROM scored""",
    "hard_filter_group": f"""
WITH {_SCORED} SELECT doc_id AS trajectory_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY seq) AS sub_problems
FROM scored WHERE m AND confidence >= 0.7 GROUP BY doc_id""",
    "inherit_rerank": """
WITH lab AS (SELECT n_name AS label, n_regionkey FROM nation), t AS (SELECT min(label) AS target, arg_min(n_regionkey, label) AS rk FROM lab),
w AS (SELECT s_suppkey, s_acctbal * CASE WHEN n_name = target THEN 1.0 WHEN n_regionkey = rk THEN 0.3 ELSE 1.0 END AS weighted
  FROM supplier JOIN nation ON s_nationkey = n_nationkey CROSS JOIN t)
SELECT s_suppkey, row_number() OVER (ORDER BY weighted DESC, s_suppkey) AS rank, round(weighted, 4) AS weighted FROM w""",
    "trainable_filter": f"WITH {_SCORED} SELECT item_id AS sub_problem_id, doc_id AS trajectory_id, 1::BIGINT AS n_spans FROM scored WHERE m",
    "merge_by_slice": f"""
WITH {_SCORED} SELECT doc_id AS trajectory_id, sub_problems, round(relevance, 6) AS relevance, '0-' || span_end AS spans, lang || ',' || source AS capability FROM merged""",
    "dedup_token_pairs": f"WITH {_PAIRS} SELECT a, b FROM pairs",
    "dedup_cosine_pairs": """
SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.40""",
    "dedup_greedy": f"""
WITH RECURSIVE {_PAIRS},
nb AS (SELECT b, list(a) AS prev, row_number() OVER (ORDER BY b) AS i FROM pairs GROUP BY b),
walk AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS gone
  UNION ALL
  SELECT nb.i, CASE WHEN len(list_filter(prev, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, b) ELSE gone END
  FROM walk JOIN nb ON nb.i = walk.i + 1),
fin AS (SELECT arg_max(gone, i) AS gone FROM walk),
sv AS (SELECT b AS first, min(a) AS survivor FROM pairs, fin WHERE list_contains(gone, b) AND NOT list_contains(gone, a) GROUP BY b)
SELECT doc_id, coalesce(sv.survivor, reps.first) AS survivor FROM doc_tokens JOIN reps USING (toks) LEFT JOIN sv USING (first)""",
    "select_budget": f"WITH {_SCORED} SELECT doc_id AS trajectory_id, pick, round(total, 6) AS total FROM chosen",
    "select_coverage": f"""
WITH RECURSIVE {_SCORED},
pr AS (SELECT merged.seq, item_id, max(scored.relevance) AS r FROM scored JOIN merged USING (doc_id) WHERE m GROUP BY ALL),
vec AS (SELECT seq, embedding::DOUBLE[] AS v FROM merged JOIN embeddings ON vec_id = doc_id),
sel AS (
  SELECT 0 AS k, []::BIGINT[] AS chosen, NULL::BIGINT AS pick
  UNION ALL
  SELECT k + 1, list_append(chosen, best), best FROM (
    SELECT k, chosen, arg_max(seq, {{'gain': gain + 0.1 * spread, 'first': -seq}}) AS best FROM (
      SELECT c.k, c.chosen, c.seq, c.gain, coalesce((SELECT sum(list_distance(a.v, b.v)) FROM vec a, vec b WHERE a.seq = c.seq AND list_contains(c.chosen, b.seq)), 0) AS spread
      FROM (
        SELECT s.k, s.chosen, pr.seq, sum(greatest(least(coalesce(h.cov, 0) + pr.r, 0.05) - coalesce(h.cov, 0), 0)) AS gain, max(coalesce(h.n, 0)) AS full_n
        FROM sel s JOIN pr ON NOT list_contains(s.chosen, pr.seq)
          LEFT JOIN LATERAL (SELECT sum(x.r) AS cov, count(*) AS n FROM pr x WHERE x.item_id = pr.item_id AND list_contains(s.chosen, x.seq)) h ON true
        WHERE s.k < 12 GROUP BY s.k, s.chosen, pr.seq) c
      WHERE full_n < 3)
    GROUP BY k, chosen))
SELECT 'run' AS run_id, pick AS seq, (k - 1)::INT AS pick FROM sel WHERE k > 0""",
    "compose_manifest": f"""
WITH {_SCORED} SELECT count(*) AS targeted_count, 0::BIGINT AS general_count, count(*) AS total_count, 0.3::DOUBLE AS general_ratio FROM chosen""",
    "nearest_question": f"""
WITH {_CENTROIDS}, sims AS (
  SELECT item_id, c.label::BIGINT AS problem, list_cosine_similarity(e.embedding::DOUBLE[], c.vector) AS s
  FROM benchmark JOIN embeddings e ON e.vec_id = item_id CROSS JOIN cent c WHERE item_id % 7 <> 3)
SELECT item_id, problem, round(s, 5) AS cosine, s >= 0.90 AS reuse FROM sims QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY s DESC, problem) = 1""",
    "resolve_labels": f"""
WITH {_CENTROIDS}, lab AS (
  SELECT 'root-' || label AS label, NULL AS parent, vector, label AS ord FROM cent
  UNION ALL SELECT 'leaf-' || label, 'root-' || label, arg_min(embedding, vec_id)::DOUBLE[], label + 100 FROM embeddings GROUP BY label),
sims AS (SELECT vec_id AS proposal, l.label, l.parent, l.ord, list_cosine_similarity(e.embedding::DOUBLE[], l.vector) AS s FROM embeddings e CROSS JOIN lab l),
anyl AS (SELECT * FROM sims QUALIFY row_number() OVER (PARTITION BY proposal ORDER BY s DESC, ord) = 1),
root AS (SELECT * FROM sims WHERE parent IS NULL QUALIFY row_number() OVER (PARTITION BY proposal ORDER BY s DESC, ord) = 1)
SELECT a.proposal, CASE WHEN a.s > 0.85 THEN 'duplicate' WHEN r.s >= 0.50 THEN 'new_leaf' ELSE 'new_root' END AS kind,
  CASE WHEN a.s > 0.85 THEN a.label WHEN r.s >= 0.50 THEN r.label END AS target, round(a.s, 5) AS any_cos, round(r.s, 5) AS root_cos
FROM anyl a JOIN root r USING (proposal)""",
    "leaf_labels": f"WITH {_PLACES} SELECT label, parent FROM places p WHERE NOT EXISTS (SELECT 1 FROM places c WHERE c.parent = p.label)",
    "label_family": f"""
WITH {_PLACES} SELECT p.label, CASE WHEN p.parent IS NULL THEN '' ELSE (
  SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT p.parent AS x UNION SELECT c.label FROM places c WHERE c.parent = p.parent AND c.label <> p.label)) END AS family
FROM places p""",
    "label_merge": """
WITH f AS (SELECT doc_id, list_filter([CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, 'en'], lambda x: x IS NOT NULL) AS n FROM labels)
SELECT doc_id, array_to_string(list_concat([lang, source], list_filter(coalesce(n, []), lambda x: x <> lang AND x <> source)), ',') AS labels
FROM documents LEFT JOIN f USING (doc_id)""",
    "backfill_candidates": f"""
WITH {_CENTROIDS}, sims AS (
  SELECT c.label::BIGINT AS sub_problem_id, e.vec_id, e.label AS own, list_cosine_similarity(e.embedding::DOUBLE[], c.vector) AS s
  FROM embeddings e CROSS JOIN (SELECT label, vector FROM cent) c WHERE list_cosine_similarity(e.embedding::DOUBLE[], c.vector) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY sub_problem_id ORDER BY s DESC, vec_id) AS rank FROM sims)
SELECT sub_problem_id, vec_id, rank FROM r WHERE rank <= 200 AND own <> sub_problem_id""",
    "queue_priority": """
WITH j AS (SELECT o_orderpriority AS label, count(DISTINCT o_custkey) AS priority, min(o_orderkey) AS job_id FROM orders GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY priority DESC, job_id) AS claim_order FROM j""",
    "outcome_window_rates": f"""
WITH {_OUTCOMES}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM oc),
w AS (SELECT a.event_id, b.outcome FROM n a JOIN n b ON b.user_id = a.user_id AND b.i BETWEEN a.i - 49 AND a.i AND b.ts >= a.ts - INTERVAL 20 SECOND)
SELECT event_id, count(*) AS total, round(avg((outcome = 'timeout')::INT), 6) AS timeout_rate,
  round(avg((outcome IN ('overload', 'server_error'))::INT), 6) AS overload_rate, round(avg((outcome = 'abnormal_response')::INT), 6) AS abnormal_rate,
  round(avg((outcome IN ('timeout', 'overload', 'server_error', 'abnormal_response', 'transient_error'))::INT), 6) AS infra_rate
FROM w GROUP BY event_id""",
    "failure_streaks": """
WITH o AS (SELECT user_id, (event_type = 'error')::INT AS bad, row_number() OVER w AS i, sum((event_type = 'error')::INT) OVER w AS k
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT user_id, i - k AS island, count(*) AS n FROM o WHERE bad = 1 GROUP BY ALL)
SELECT user_id, max(n) AS longest_streak, count(*) AS n_streaks FROM r GROUP BY user_id""",
    "http_stats": f"""
WITH {_OUTCOMES} SELECT outcome, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS percent FROM oc GROUP BY outcome""",
    "outcome_classes": """
WITH s AS (SELECT p_partkey, 200 + p_size * 7 AS status, lower(p_type || ' Moderation') AS err, p_retailprice > 1000 AS bad FROM part)
SELECT p_partkey, CASE WHEN status BETWEEN 200 AND 299 THEN CASE WHEN bad THEN 'abnormal_response' ELSE 'success' END
  WHEN status IN (401, 402) THEN 'auth_error' WHEN status = 429 THEN 'overload' WHEN status IN (500, 502, 503, 504) THEN 'server_error'
  WHEN status = 400 THEN CASE WHEN contains(err, 'moderation') THEN 'content_filtered' ELSE 'transient_error' END
  WHEN status = 403 THEN 'transient_error' WHEN status BETWEEN 400 AND 499 THEN 'input_error' ELSE 'transient_error' END AS outcome
FROM s""",
    "truncate_text": f"SELECT doc_id, length(c) AS n, md5(c) AS cut_md5 FROM (SELECT doc_id, {_cut('t', '400')} AS c FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))",
    "truncate_conversations": f"""
WITH a AS (
  SELECT conv_id, turn, role, text, role = 'system' AS sys, sum(CASE WHEN role <> 'system' THEN length(text) ELSE 0 END) OVER c AS total,
    800 - sum(CASE WHEN role = 'system' THEN length(text) ELSE 0 END) OVER c AS free0,
    sum((role <> 'system')::INT) OVER c AS n, sum((role <> 'system')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS pos
  FROM conversations WINDOW c AS (PARTITION BY conv_id)),
b AS (SELECT *, greatest(free0, 0) AS free FROM a),
d AS (SELECT *, floor(free * 0.35) AS f, floor(free * 0.30) AS l FROM b),
e AS (SELECT *, (CASE WHEN pos = 1 THEN f WHEN pos = n THEN l ELSE least(floor((free - f - l) / greatest(n - 2, 1)), floor(free * 0.35)) END)::BIGINT AS budget FROM d),
g AS (SELECT conv_id, turn, CASE WHEN sys OR total <= free0 THEN text ELSE {_cut('text', 'budget')} END AS c FROM e)
SELECT conv_id, turn, length(c) AS n, md5(c) AS text_md5 FROM g""",
    "drift_mode": """
WITH r AS (SELECT conv_id, count(*) AS n_steps, string_agg(role, '>' ORDER BY turn) AS sig FROM conversations GROUP BY 1),
c AS (SELECT n_steps, sig, count(*) AS n FROM r GROUP BY ALL)
SELECT n_steps, round(max(n) / sum(n), 3) AS mode_share FROM c GROUP BY n_steps""",
    "route_scores": f"WITH {_ROUTES} SELECT case_id, agreed, expected FROM scores",
    "label_accuracy": f"""
WITH {_ROUTES} SELECT sum(agreed)::BIGINT AS agreed, sum(expected)::BIGINT AS expected, round(sum(agreed)::DOUBLE / greatest(sum(expected), 1), 3) AS accuracy FROM scores""",
    "label_hits": """
SELECT doc_id FROM documents e WHERE doc_id % 3 = 0 AND EXISTS (
  SELECT 1 FROM documents a WHERE a.doc_id % 3 = 1 AND a.n_chars = e.n_chars
    AND CASE WHEN e.doc_id % 4 = 0 THEN a.doc_id % 5 = 0 ELSE a.source IN (e.lang, e.source) END)""",
    "retained_runs": """
SELECT o_orderkey AS run_id FROM orders WHERE o_orderstatus = 'O'
UNION ALL (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O' ORDER BY o_orderdate DESC, o_orderkey LIMIT 50)""",
    "label_colors": "SELECT label, (dense_rank() OVER (ORDER BY label) - 1) % 10 AS color FROM (SELECT DISTINCT source AS label FROM documents WHERE source IS NOT NULL)",
    "inspector_view": f"""
WITH {_SCORED} SELECT item_id AS sub_problem_id, s.doc_id AS trajectory_id, round(s.relevance, 6) AS relevance, s.confidence::DOUBLE AS confidence,
  c.doc_id IS NOT NULL AS selected FROM scored s LEFT JOIN chosen c USING (doc_id) WHERE m""",
    "span_step_join": """
WITH sp AS (SELECT conv_id, min(turn) AS start_step, max(turn) AS end_step FROM conversations WHERE role = 'assistant' GROUP BY 1)
SELECT conv_id, turn AS step_index, role, start_step, end_step FROM conversations JOIN sp USING (conv_id) WHERE turn BETWEEN start_step AND end_step""",
    "trajectory_index": "SELECT conv_id AS trajectory_id, md5(arg_max(text, turn)) AS steps, max(turn) AS ingest_seq FROM conversations GROUP BY 1",
    "capability_hits": f"""
WITH {_SCORED} SELECT doc_id AS trajectory_id, CASE WHEN lang < source THEN lang || ',' || source ELSE source || ',' || lang END AS labels, 1::BIGINT AS n_spans FROM merged""",
}
