"""The queries of :mod:`.queries` in SQL for DuckDB."""

from __future__ import annotations

from ..functions.grading import AUTO, PRESETS
from ..operators.compose import CAPTION_STYLE, LOUDNESS, TONE_MAP
from ..operators.sessions import FILLERS, HEAD, NO_SPEECH

#: Tokens of conversations.
TOKENS = r"""
words AS (
  SELECT conv_id, turn, role, list_filter(string_split_regex(text, '[ \t-\r]+'), lambda w: w <> '') AS ws FROM conversations),
each AS (
  SELECT conv_id AS source, turn, role AS speaker, unnest(ws) AS text, unnest(range(len(ws))) AS i FROM words),
steps AS (
  SELECT *, 60 * length(text) AS len, 60 * length(text) + CASE WHEN right(text, 1) IN ('.', '!', '?') THEN 600 WHEN right(text, 1) IN (',', ';', ':') THEN 250 ELSE 40 END AS step FROM each),
begun AS (
  SELECT *, CAST(coalesce(sum(step) OVER (PARTITION BY source ORDER BY turn, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
    CAST(row_number() OVER (PARTITION BY source ORDER BY turn, i) AS INT) AS pos FROM steps),
tokens AS (
  SELECT source, pos, 'word' AS type, text, start, start + len AS stop, speaker, turn FROM begun)"""

EVENT_TOKENS = """
tokens AS (
  SELECT user_id AS source, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
    CASE event_type WHEN 'error' THEN 'spacing' WHEN 'signup' THEN 'audio_event' ELSE 'word' END AS type, event_type AS text,
    epoch_us(ts) AS start,
    epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) * CASE event_type WHEN 'error' THEN 1000000 ELSE 1000 END AS stop,
    CASE CAST(json_extract_string(props, '$.k') AS INT) % 3 WHEN 1 THEN 'A' WHEN 2 THEN 'B' END AS speaker
  FROM events)"""


def _phrases(gap: int) -> str:
    return f"""
marked AS (
  SELECT *, type <> 'spacing' AND start IS NOT NULL AS spoken,
    last_value(CASE WHEN type <> 'spacing' AND start IS NOT NULL THEN coalesce(stop, start) END IGNORE NULLS) OVER (PARTITION BY source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM tokens),
islands AS (
  SELECT *, sum(CASE WHEN type = 'spacing' AND stop - start >= {gap} THEN 1 WHEN spoken AND start - ended >= {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY pos) AS island FROM marked),
spoke AS (
  SELECT *, first_value(speaker) OVER (PARTITION BY source, island ORDER BY pos) AS lead_speaker,
    last_value(speaker IGNORE NULLS) OVER (PARTITION BY source, island ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_speaker
  FROM islands WHERE spoken),
parts AS (
  SELECT *, sum(CASE WHEN lead_speaker IS NOT NULL AND speaker <> prev_speaker THEN 1 ELSE 0 END) OVER (PARTITION BY source, island ORDER BY pos) AS part FROM spoke),
pieces AS (
  SELECT *, CASE WHEN type = 'audio_event' AND NOT starts_with(trim(text), '(') THEN '(' || trim(text) || ')' ELSE nullif(trim(text), '') END AS piece FROM parts),
grouped AS (
  SELECT source, min(pos) AS first_pos, arg_min(start, pos) AS start, arg_max(coalesce(stop, start), pos) AS stop, CASE WHEN min(lead_speaker) IS NOT NULL THEN min(speaker) END AS speaker,
    string_agg(piece, ' ' ORDER BY pos) AS joined FROM pieces GROUP BY source, island, part HAVING count(piece) > 0),
phrases AS (
  SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY first_pos) AS INT) AS phrase_no, start, stop, speaker,
    replace(replace(replace(replace(joined, ' ,', ','), ' .', '.'), ' ?', '?'), ' !', '!') AS text FROM grouped)"""


SUMMARY = """
summary AS (
  SELECT c.source, coalesce(p.duration, 0) AS duration, coalesce(p.n, 0) AS n_phrases
  FROM (SELECT DISTINCT conv_id AS source FROM conversations) c
  LEFT JOIN (SELECT source, arg_max(stop, phrase_no) - arg_min(start, phrase_no) AS duration, count(*) AS n FROM phrases GROUP BY source) p ON p.source = c.source)"""

TURNS = """
turns AS (SELECT source, turn, speaker, min(start) AS start, max(stop) AS stop FROM tokens GROUP BY ALL),
ranges AS (
  SELECT source AS edl_id, CAST(row_number() OVER (PARTITION BY source ORDER BY turn) - 1 AS INT) AS ord, source, start + 137 AS start, stop - 211 AS stop
  FROM turns WHERE speaker = 'assistant' AND stop - 211 > start + 137),
placed AS (
  SELECT *, CAST(coalesce(sum(stop - start) OVER (PARTITION BY edl_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM ranges),
overlays AS (SELECT source AS edl_id, turn AS z, start, CAST(1500 AS BIGINT) AS duration FROM turns WHERE speaker = 'user')"""

INSIDE = """
inside AS (
  SELECT r.edl_id, r.ord, r.source, r.start, r.stop, r."offset", t.pos, t.type, t.text, t.start AS token_start, t.stop AS token_stop
  FROM placed r JOIN tokens t ON t.source = r.source AND t.stop > r.start AND t.start < r.stop)"""

CUES = r"""
runs AS (
  SELECT *, coalesce(sum(CASE WHEN regexp_matches(text, '[.,!?;:]$') THEN 1 ELSE 0 END) OVER (PARTITION BY edl_id, ord ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM inside),
chunked AS (
  SELECT *, (row_number() OVER (PARTITION BY edl_id, ord, run ORDER BY pos) - 1) // 2 AS part FROM runs),
joined AS (
  SELECT edl_id, ord, min(pos) AS first_pos, min(start) AS start, min(stop) AS stop, min("offset") AS "offset", arg_min(token_start, pos) AS b, arg_max(token_stop, pos) AS e,
    upper(replace(rtrim(string_agg(text, ' ' ORDER BY pos), ',;:'), 'ß', 'SS')) AS text FROM chunked GROUP BY edl_id, ord, run, part),
timed AS (
  SELECT *, greatest(0, greatest(start, b) - start) + "offset" AS out_start, greatest(0, least(stop, e) - start) + "offset" AS out_end FROM joined),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY edl_id, ord ORDER BY first_pos) AS INT) AS chunk FROM timed),
cues AS (
  SELECT edl_id, ord, chunk, CAST(row_number() OVER (PARTITION BY edl_id ORDER BY out_start, ord, chunk) AS INT) AS cue_no, out_start,
    CASE WHEN out_end <= out_start THEN out_start + 400 ELSE out_end END AS out_stop, text FROM numbered)"""

#: False starts: from left to right the longest run of words that is said again at once.
SLIPS = r"""
bare AS (SELECT source, pos, text, lower(rtrim(text, '.,!?;:')) AS w FROM tokens WHERE rtrim(text, '.,!?;:') <> ''),
ahead AS (SELECT source, pos, row_number() OVER o AS k, list(w) OVER f AS ws, list(text) OVER f AS said FROM bare
  WINDOW o AS (PARTITION BY source ORDER BY pos), f AS (PARTITION BY source ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
longest AS (SELECT *, CAST(list_max(list_filter([1, 2, 3, 4], lambda n: len(ws) >= 2 * n AND ws[1:n] = ws[n + 1 : 2 * n])) AS INT) AS n FROM ahead),
walk AS (
  SELECT source, k, n FROM longest WHERE k = 1
  UNION ALL
  SELECT l.source, l.k, l.n FROM walk w JOIN longest l ON l.source = w.source AND l.k = w.k + coalesce(w.n, 1)),
slips AS (SELECT l.* FROM walk JOIN longest l USING (source, k) WHERE l.n IS NOT NULL)"""

#: The user's turns, 2 s longer on both sides (a), and overlays of a minute (b), in one sweep.
SWEPT = """
ends AS (
  SELECT source, start - 2000 AS start, 1 AS ca, 0 AS cb FROM turns WHERE speaker = 'user' UNION ALL SELECT source, stop + 2000, -1, 0 FROM turns WHERE speaker = 'user'
  UNION ALL SELECT edl_id, start, 0, 1 FROM overlays UNION ALL SELECT edl_id, start + 60000, 0, -1 FROM overlays),
pieces AS (
  SELECT source, start, lead(start) OVER w AS stop, sum(ca) OVER w AS a, sum(cb) OVER w AS b FROM (SELECT source, start, sum(ca) AS ca, sum(cb) AS cb FROM ends GROUP BY ALL)
  WINDOW w AS (PARTITION BY source ORDER BY start))"""

_AIMS = ":".join(f"{k}={v:g}" for k, v in LOUDNESS.items())


def _passes() -> list[str]:
    """Three passes of repair over ranges1 and shown1, to ranges4 and shown4, with the faults of each."""
    parts = [
        "lengths AS (SELECT source, max(stop) AS length FROM tokens GROUP BY source)",
        "ranges1 AS (SELECT edl_id, ord, source, start - CASE WHEN ord % 5 = 0 THEN 20000 ELSE 0 END AS start, stop + CASE WHEN ord % 5 = 4 THEN 90000 ELSE 0 END AS stop FROM ranges)",
        "shown1 AS (SELECT edl_id, z, start, 9000 AS duration FROM overlays)",
    ]
    words = "ASOF LEFT JOIN tokens t ON t.source = e.source AND e.at > t.start"
    for k in (1, 2, 3, 4):
        parts += [
            f"free{k} AS (SELECT *, max(start + duration) OVER (PARTITION BY edl_id ORDER BY start, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS free FROM shown{k})",
            f"edges{k} AS (SELECT edl_id, ord, source, start AS at FROM ranges{k} UNION ALL SELECT edl_id, ord, source, stop FROM ranges{k})",
            f"totals{k} AS (SELECT edl_id, sum(greatest(stop - start, 0)) AS total FROM ranges{k} GROUP BY edl_id)",
            f"""faults{k} AS (
  SELECT edl_id, 'range' AS part, ord AS no, 'outside' AS kind, greatest(-start, 0) + greatest(stop - length, 0) AS amount FROM ranges{k} JOIN lengths USING (source) WHERE start < 0 OR stop > length
  UNION ALL SELECT edl_id, 'range', ord, 'empty', 1 FROM ranges{k} WHERE stop <= start
  UNION ALL SELECT e.edl_id, 'range', ord, 'inside_word', count(*) FROM edges{k} e {words} WHERE t.stop > e.at GROUP BY e.edl_id, ord
  UNION ALL SELECT edl_id, 'overlay', z, 'covered', free - start FROM free{k} WHERE free > start
  UNION ALL SELECT edl_id, 'overlay', z, 'late', start + duration - coalesce(total, 0) FROM shown{k} LEFT JOIN totals{k} USING (edl_id) WHERE start + duration > coalesce(total, 0))""",
        ]
        if k < 4:
            near = lambda end: f"CASE WHEN {end}.low IS NULL THEN {end}.at WHEN {end}.at - {end}.low <= {end}.high - {end}.at THEN {end}.low ELSE {end}.high END"
            held = lambda c: f"(SELECT e.*, CASE WHEN t.stop > e.at THEN t.start END AS low, CASE WHEN t.stop > e.at THEN t.stop END AS high FROM (SELECT edl_id, ord, source, {c} AS at FROM clamped{k}) e {words})"
            parts += [
                f"clamped{k} AS (SELECT edl_id, ord, source, greatest(least(start, length), 0) AS start, greatest(least(stop, length), 0) AS stop FROM ranges{k} JOIN lengths USING (source))",
                f"ranges{k + 1} AS (SELECT a.edl_id, a.ord, a.source, {near('a')} AS start, {near('b')} AS stop FROM {held('start')} a JOIN {held('stop')} b USING (edl_id, ord))",
                f"shown{k + 1} AS (SELECT edl_id, z, greatest(start, coalesce(free, start)) AS start, duration FROM free{k})",
            ]
    return parts


_SECONDS = "printf('%06.2f', {0} / 1000.0)"
_DURATION = "CASE WHEN duration < 60000 THEN printf('%.1fs', duration / 1000.0) ELSE printf('%dm %04.1fs', duration // 60000, duration / 1000.0 - (duration // 60000) * 60) END"


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


def _x(at: str) -> str:
    return f"CAST(trunc(50 + ({at} - start) / greatest(1e-6, CAST(stop - start AS DOUBLE)) * 1100) AS INT)"


_SPOKEN = _with(TOKENS, TURNS, INSIDE)
_GRADE = "CASE " + " ".join(f"WHEN g = '{name}' THEN '{value.replace(chr(39), chr(39) * 2)}'" for name, value in PRESETS.items()) + f" WHEN g = 'auto' THEN '{AUTO}' ELSE g END"

SQL: dict[str, str] = {
    "phrases": _with(TOKENS, _phrases(500)) + " SELECT * FROM phrases",
    "phrases_events": _with(EVENT_TOKENS, _phrases(6 * 3600 * 1_000_000)) + " SELECT * FROM phrases",
    "explode_tokens": _with(TOKENS) + " SELECT * FROM tokens",
    "source_summary": _with(TOKENS, _phrases(500), SUMMARY) + f" SELECT *, {_DURATION} AS duration_text FROM summary",
    "pack_totals": _with(TOKENS, _phrases(500), SUMMARY) + " SELECT count(*) AS n_sources, CAST(sum(n_phrases) AS BIGINT) AS n_phrases, CAST(sum(duration) AS BIGINT) AS duration FROM summary",
    "pack_lines": _with(TOKENS, _phrases(500), SUMMARY)
    + f""" SELECT CAST(NULL AS BIGINT) AS source, CAST(n AS INT) AS line_no, line FROM (VALUES {", ".join(f"({i + 1}, '{x.format(gap=0.5)}')" for i, x in enumerate(HEAD))}) h(n, line)
UNION ALL SELECT source, 1, '## ' || source || '  (duration: ' || {_DURATION} || ', ' || n_phrases || ' phrases)' FROM summary
UNION ALL SELECT source, 2, '{NO_SPEECH}' FROM summary WHERE n_phrases = 0
UNION ALL SELECT source, CASE WHEN n_phrases = 0 THEN 3 ELSE CAST(n_phrases + 2 AS INT) END, '' FROM summary
UNION ALL SELECT source, phrase_no + 1, '  [' || {_SECONDS.format("start")} || '-' || {_SECONDS.format("stop")} || '] S' || speaker || ' ' || text FROM phrases""",
    "silence_class": _with(TOKENS)
    + """, gaps AS (SELECT source, start - lag(stop) OVER (PARTITION BY source ORDER BY pos) AS gap FROM tokens)
SELECT source, CASE WHEN gap >= 400 THEN 'clean' WHEN gap >= 150 THEN 'check' ELSE 'unsafe' END AS class, count(*) AS n FROM gaps WHERE gap IS NOT NULL GROUP BY ALL""",
    "handoffs": _with(TOKENS)
    + """, l AS (SELECT source, pos, lag(speaker) OVER w AS before, speaker, start - lag(stop) OVER w AS air FROM tokens WINDOW w AS (PARTITION BY source ORDER BY pos))
SELECT *, air BETWEEN 400 AND 600 AS typical FROM l WHERE before <> speaker""",
    "filler_flags": _with(TOKENS) + f""" SELECT source, count(*) AS n_tokens, count(*) FILTER (lower(rtrim(text, '.,!?;:')) IN ({", ".join(f"'{w}'" for w in FILLERS)})) AS n_fillers FROM tokens GROUP BY source""",
    "explode_ranges": _with(TOKENS, TURNS) + " SELECT * FROM ranges",
    "edl_offsets": _with(TOKENS, TURNS) + " SELECT * FROM placed",
    "silences": _SPOKEN
    + """, reached AS (SELECT edl_id, ord, greatest(start, max(token_stop) OVER (PARTITION BY edl_id, ord ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS gap_start, greatest(start, token_start) AS gap_stop FROM inside
UNION ALL SELECT edl_id, ord, greatest(min(start), max(token_stop)), min(stop) FROM inside GROUP BY edl_id, ord)
SELECT * FROM reached WHERE gap_stop - gap_start >= 400""",
    "offsets_missing_source": _with(TOKENS, TURNS, INSIDE, CUES) + " SELECT edl_id, ord, count(*) AS n_cues, min(out_start) AS first_start FROM cues WHERE (edl_id + ord) % 7 <> 0 GROUP BY edl_id, ord",
    "range_join": _SPOKEN + ' SELECT * EXCLUDE ("offset") FROM inside',
    "cues": _with(TOKENS, TURNS, INSIDE, CUES) + " SELECT * FROM cues",
    "srt_lines": _with(TOKENS, TURNS, INSIDE, CUES)
    + """ SELECT edl_id, cue_no, cue_no || chr(10) || printf('%02d:%02d:%02d,%03d --> %02d:%02d:%02d,%03d', out_start // 3600000, out_start // 60000 % 60, out_start // 1000 % 60, out_start % 1000, out_stop // 3600000, out_stop // 60000 % 60, out_stop // 1000 % 60, out_stop % 1000) || chr(10) || text || chr(10) AS block FROM cues""",
    "runtime_check": _with(TOKENS, TURNS)
    + """, said AS (SELECT source AS edl_id, CAST(sum(stop - start) AS BIGINT) AS declared FROM turns WHERE speaker = 'assistant' GROUP BY source),
run AS (SELECT edl_id, count(*) AS n_ranges, CAST(sum(stop - start) AS BIGINT) AS runtime FROM ranges GROUP BY edl_id)
SELECT run.*, declared, abs(runtime - declared) <= 1000 AS ok FROM run JOIN said USING (edl_id)""",
    "boundary_windows": _with(TOKENS, TURNS)
    + """, whole AS (SELECT *, max("offset" + stop - start) OVER (PARTITION BY edl_id) AS total FROM placed)
SELECT edl_id, ord, "offset" AS at, greatest(0, "offset" - 1500) AS low, least(total, "offset" + 1500) AS high FROM whole WHERE ord > 0""",
    "snap_asof": _with(TOKENS, TURNS)
    + """, edges AS (SELECT source, ord, 0 AS edge, start AS at FROM ranges UNION ALL SELECT source, ord, 1, stop FROM ranges),
marks AS (SELECT DISTINCT source, start AS mark FROM tokens UNION SELECT DISTINCT source, stop FROM tokens)
SELECT e.source, e."at", e.ord, CAST(e.edge AS INT) AS edge, arg_min(mark, abs(mark - e."at") * 2 + CASE WHEN mark > e."at" THEN 1 ELSE 0 END) AS snapped FROM edges e JOIN marks m ON m.source = e.source GROUP BY e.source, e."at", e.ord, e.edge""",
    "pad_edges": _with(TOKENS, TURNS) + " SELECT edl_id, ord, source, greatest(start - 50, 0) AS start, stop + 80 AS stop, true AS allowed FROM ranges",
    "rms_envelope": """WITH levels AS (SELECT vec_id, unnest(range(10)) AS i, embedding FROM embeddings),
l AS (SELECT vec_id, CAST(i AS INT) AS i, sqrt(list_sum(list_transform(embedding[i * 6 + 1 : i * 6 + 6], lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) / 6) AS level FROM levels),
t AS (SELECT *, max(level) OVER (PARTITION BY vec_id) AS top FROM l)
SELECT vec_id, i, round(CASE WHEN top > 0 THEN level / top ELSE level END, 6) AS value FROM t""",
    "frame_stats": """SELECT l_orderkey AS clip, round(avg(round(l_quantity * 4)) / 255, 9) AS y_mean, round((avg(round(l_discount * 100) + 120) - avg(round(l_discount * 100))) / 255, 9) AS y_range, round(avg(round(l_tax * 1000)) / 255, 9) AS sat_mean FROM lineitem GROUP BY l_orderkey""",
    "auto_grade": """WITH sums AS (SELECT l_orderkey AS clip, count(*) AS n, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS q, CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS d, CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS t FROM lineitem GROUP BY l_orderkey),
clips AS (SELECT clip, q / (50 * n) AS y, CAST(0.45 AS DOUBLE) + 4 * d / (100 * n) AS r, 6 * t / (100 * n) AS s FROM sums),
c AS (SELECT clip,
  CASE WHEN r < 0.65 THEN CAST(1.08 AS DOUBLE) - CAST(0.05 AS DOUBLE) * greatest(0.0, least(1.0, (r - CAST(0.50 AS DOUBLE)) / CAST(0.15 AS DOUBLE))) ELSE CAST(1.03 AS DOUBLE) END AS contrast,
  CASE WHEN y < 0.42 THEN CAST(1.10 AS DOUBLE) - CAST(0.08 AS DOUBLE) * greatest(0.0, least(1.0, (y - CAST(0.30 AS DOUBLE)) / CAST(0.12 AS DOUBLE))) WHEN y > 0.60 THEN CAST(0.97 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS gamma,
  CASE WHEN s < 0.18 THEN 1.04 WHEN s > 0.38 THEN 0.96 ELSE 0.98 END AS saturation FROM clips)
SELECT clip, 'eq=' || concat_ws(':', CASE WHEN abs(contrast - 1) > 0.005 THEN printf('contrast=%.3f', contrast) END, CASE WHEN abs(gamma - 1) > 0.005 THEN printf('gamma=%.3f', gamma) END, CASE WHEN abs(saturation - 1) > 0.005 THEN printf('saturation=%.3f', CAST(saturation AS DOUBLE)) END) AS grade FROM c""",
    "resolve_grade": f"""WITH named AS (SELECT o_orderkey, ['', 'auto', 'subtle', 'warm_cinematic', 'none', 'unknown_name', 'eq=gamma=1.1'][o_orderkey % 7 + 1] AS g FROM orders) SELECT o_orderkey, {_GRADE} AS grade FROM named""",
    "frame_times": _with(TOKENS, TURNS) + ", r AS (SELECT *, unnest(range(5)) AS i FROM ranges) SELECT edl_id, ord, CAST(i AS INT) AS i, start + i * ((stop - start) / 4) AS at FROM r",
    "ruler_ticks": _with(TOKENS, TURNS) + ", r AS (SELECT *, unnest(range(7)) AS i FROM ranges) SELECT edl_id, ord, CAST(i AS INT) AS i, round(start + (i / 6) * (stop - start), 3) AS at, CAST(50 + trunc(i / 6 * 1100) AS INT) AS x FROM r",
    "label_thin": _SPOKEN
    + f""", spots AS (SELECT edl_id, ord, pos, text, CAST(floor(({_x("token_start")} + {_x("token_stop")}) / 2) AS INT) AS x FROM inside WHERE token_stop - token_start >= 50),
lined AS (SELECT *, row_number() OVER (PARTITION BY edl_id, ord ORDER BY pos) AS n FROM spots),
walk AS (
  SELECT edl_id, ord, pos, text, x, n, true AS kept, x AS last FROM lined WHERE n = 1
  UNION ALL
  SELECT l.edl_id, l.ord, l.pos, l.text, l.x, l.n, l.x - w.last >= 28, CASE WHEN l.x - w.last >= 28 THEN l.x ELSE w.last END FROM walk w JOIN lined l ON l.edl_id = w.edl_id AND l.ord = w.ord AND l.n = w.n + 1)
SELECT edl_id, ord, pos, x, text FROM walk WHERE kept""",
    "overlay_active": _with(TOKENS, TURNS) + " SELECT t.source AS edl_id, t.start AS at, z, t.start - o.start AS local FROM tokens t JOIN overlays o ON o.edl_id = t.source AND t.start BETWEEN o.start AND o.start + o.duration",
    "top_layer": _with(TOKENS, TURNS) + " SELECT t.source AS edl_id, t.start AS at, max(z) AS z, arg_max(t.start - o.start, z) AS local FROM tokens t LEFT JOIN overlays o ON o.edl_id = t.source AND t.start BETWEEN o.start AND o.start + o.duration GROUP BY t.source, t.start",
    "overlay_conflicts": _with(TOKENS, TURNS) + " SELECT a.edl_id, a.z, b.z AS other, greatest(a.start, b.start) AS low, least(a.start, b.start) + 60000 AS high FROM overlays a JOIN overlays b ON a.edl_id = b.edl_id AND a.z < b.z AND a.start <= b.start + 60000 AND b.start <= a.start + 60000",
    "filter_graph": _with(TOKENS, TURNS)
    + f""", l AS (SELECT *, row_number() OVER (PARTITION BY edl_id ORDER BY z) AS k FROM overlays),
g AS (SELECT edl_id, count(*) AS n, string_agg('[' || k || ':v]setpts=PTS-STARTPTS+' || CAST(start / 1000.0 AS DOUBLE) || '/TB[a' || k || ']', ';' ORDER BY k) AS shifts,
  string_agg(CASE WHEN k = 1 THEN '[0:v]' ELSE '[v' || (k - 1) || ']' END || '[a' || k || ']overlay=enable=''between(t,' || printf('%.3f,%.3f', start / 1000.0, start / 1000.0 + 1.5) || ')''[v' || k || ']', ';' ORDER BY k) AS lays FROM l GROUP BY edl_id)
SELECT c.edl_id, coalesce(shifts || ';' || lays || ';[v' || n || ']', '[0:v]') || 'subtitles=''/edit/master\\''s.srt'':force_style=''{CAPTION_STYLE}''[outv]' AS graph FROM (SELECT DISTINCT conv_id AS edl_id FROM conversations) c LEFT JOIN g ON g.edl_id = c.edl_id""",
    "concat_manifest": _with(TOKENS, TURNS) + " SELECT edl_id, string_agg(printf('file ''/edit/clips_graded/seg_%02d_%d.mp4''', ord, source) || chr(10), '' ORDER BY ord) AS text FROM ranges GROUP BY edl_id",
    "render_plan": _with(TOKENS, TURNS)
    + f""" SELECT edl_id, ord, CASE WHEN ord % 3 = 0 THEN 'hook' WHEN ord % 2 = 0 THEN 'turn ' || ord ELSE '' END AS note, CASE WHEN source % 11 <> 0 THEN '/media/' || source || '.mp4' END AS path, printf('seg_%02d_%d.mp4', ord, source) AS segment, printf('%.3f', start / 1000.0) AS seek, printf('%.3f', (stop - start) / 1000.0) AS length,
  CASE WHEN source % 11 <> 0 AND source % 3 = 0 THEN '{TONE_MAP},' ELSE '' END || CASE WHEN source % 11 <> 0 AND source % 2 = 0 THEN 'scale=-2:1920' ELSE 'scale=1920:-2' END || ',{PRESETS["subtle"]}' AS video,
  'afade=t=in:st=0:d=0.03,afade=t=out:st=' || printf('%.3f', greatest(0.0, CAST((stop - start) / 1000.0 AS DOUBLE) - CAST(0.03 AS DOUBLE))) || ':d=0.03' AS sound, 'fast' AS preset, '20' AS rate FROM ranges""",
    "payoff_sync": _with(TOKENS, TURNS) + " SELECT source AS edl_id, turn AS z, greatest(0, max(start) - 800) AS start, max(stop) - min(start) + 1000 AS least, greatest(0, max(stop) - min(start) + 1000 - 1500) AS held, max(stop) - min(start) + 1000 <= 1500 AS enough FROM tokens WHERE speaker = 'user' GROUP BY source, turn",
    "best_take": "SELECT beat, event_id, value FROM (SELECT event_type || '/' || strftime(ts, '%Y-%m-%d') AS beat, event_id, value FROM events) QUALIFY row_number() OVER (PARTITION BY beat ORDER BY value DESC, event_id) = 1",
    "easing": "SELECT p_partkey, round(1 - pow(1 - p_size / 50, 3.0), 6) AS ease_out, round(CASE WHEN p_size / 50 < 0.5 THEN 4 * pow(p_size / 50, 3.0) ELSE 1 - pow(-2 * (p_size / 50) + 2, 3.0) / 2 END, 6) AS ease_in_out FROM part",
    "cdl_transform": "SELECT p_partkey, round(pow(greatest(p_size / 50 * CAST(1.1 AS DOUBLE) - CAST(0.03 AS DOUBLE), 0.0), CAST(0.9 AS DOUBLE)), 6) AS value FROM part",
    "cache_hits": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "cache_pending": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "scan_filter_ext": r"SELECT page_id, url, regexp_extract(url, '([^/]*)\.[^./]+$', 1) AS stem FROM pages WHERE regexp_matches(url, '[^/]\.(html|htm|mp4|MP4|mov|MOV|mkv|MKV|avi|AVI|m4v)$')",
    "event_sessions": """WITH m AS (SELECT user_id, ts, ts - lag(ts) OVER w >= INTERVAL 6 HOUR AS far FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN far THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM m)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS stop_us, count(*) AS n FROM s GROUP BY user_id, session""",
    "line_stats": """WITH lines AS (SELECT l_orderkey AS clip, pow(2, 8 + l_orderkey % 2 * 2) - 1 AS scale, round(l_quantity * 4) AS yavg, round(l_discount * 100) AS d, l_linenumber AS n FROM lineitem)
SELECT clip, round(avg(yavg) / min(scale), 9) AS y_mean, round(coalesce((avg(d + 120) - avg(d) FILTER (n <> 3)) / min(scale), 0.7), 9) AS y_range, CAST(0.25 AS DOUBLE) AS sat_mean FROM lines GROUP BY clip""",
    "range_errors": _with(TOKENS, TURNS)
    + """, faulty AS (SELECT edl_id, ord, source, CASE WHEN ord % 5 = 2 THEN NULL ELSE start END AS start, CASE WHEN ord % 3 = 1 THEN start ELSE stop END AS stop FROM ranges),
known AS (SELECT DISTINCT edl_id, unnest([source, source + 1]) AS source FROM ranges),
names AS (SELECT edl_id, string_agg(CAST(source AS VARCHAR), ', ' ORDER BY CAST(source AS VARCHAR)) AS known, list(source) AS ids FROM known WHERE source % 7 <> 0 GROUP BY edl_id)
SELECT edl_id, ord, 'start is missing' AS error FROM faulty WHERE start IS NULL
UNION ALL SELECT edl_id, ord, 'stop must be after start' FROM faulty WHERE stop <= start
UNION ALL SELECT f.edl_id, ord, 'unknown source ' || source || ', known: ' || coalesce(known, '') FROM faulty f LEFT JOIN names n ON n.edl_id = f.edl_id WHERE NOT coalesce(list_contains(ids, source), false)""",
    "failure_counts": """SELECT source, count(*) AS n, count(*) FILTER (length(text) > 900) AS n_failed, substr(min(text) FILTER (length(text) > 900), 1, 500) || '...' AS first_error FROM documents GROUP BY source""",
    "covered_cues": _with(TOKENS, TURNS, INSIDE, CUES) + " SELECT c.edl_id, cue_no, z, least(out_stop, o.start + duration) - greatest(out_start, o.start) AS covered FROM cues c JOIN overlays o ON o.edl_id = c.edl_id AND out_start < o.start + duration AND o.start < out_stop",
    "inspection_windows": _with(TOKENS, TURNS)
    + """, whole AS (SELECT edl_id, CAST(max("offset" + stop - start) AS DOUBLE) AS total FROM placed GROUP BY edl_id)
SELECT edl_id, 'start' AS kind, 0 AS n, CAST(0 AS DOUBLE) AS low, least(total, 2000) AS high FROM whole
UNION ALL SELECT edl_id, 'end', 0, greatest(0, total - 2000), total FROM whole
UNION ALL SELECT edl_id, 'middle', CAST(i AS INT), total * (i + 1) / 4, total * (i + 1) / 4 FROM (SELECT *, unnest(range(3)) AS i FROM whole)
UNION ALL SELECT p.edl_id, 'cut', ord, greatest(0, "offset" - 1500), least(total, "offset" + 1500) FROM placed p JOIN whole w ON w.edl_id = p.edl_id WHERE ord > 0""",
    "strip_layout": _with(TOKENS, TURNS)
    + """, f AS (SELECT edl_id, ord, i, CAST(trunc(180 * (CAST(160 + (ord * 37 + i * 53) % 400 AS DOUBLE) / (90 + source % 200))) AS BIGINT) AS w FROM (SELECT *, unnest(range(5)) AS i FROM ranges)),
g AS (SELECT edl_id, ord, sum(w) + 16 AS total FROM f GROUP BY edl_id, ord),
s AS (SELECT f.*, CASE WHEN total <= 1820 THEN 1.0::DOUBLE ELSE 1820::DOUBLE / total END AS scale FROM f JOIN g ON g.edl_id = f.edl_id AND g.ord = f.ord),
t AS (SELECT edl_id, ord, i, CAST(trunc(w * scale) AS BIGINT) AS width, CAST(trunc(180 * scale) AS BIGINT) AS height, CASE WHEN scale = 1 THEN 4 ELSE greatest(2, CAST(trunc(4 * scale) AS BIGINT)) END AS gap FROM s)
SELECT edl_id, ord, 1920 AS canvas, CAST(sum(width + gap) OVER (PARTITION BY edl_id, ord) AS BIGINT) AS drawn, CAST(i AS INT) AS i, CAST(50 + coalesce(sum(width + gap) OVER (PARTITION BY edl_id, ord ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS x, 50 + (180 - height) // 2 AS y, width, height FROM t""",
    "media_info": """SELECT p_partkey AS source, '/media/' || p_partkey AS path, 'bt709' AS transfer, p_partkey % 5 <> 0 AND 1080 > p_size * 40 AS portrait, CASE WHEN p_partkey % 3 = 0 THEN CAST(10 AS DOUBLE) ELSE p_partkey % 90 + CAST(0.5 AS DOUBLE) END AS seconds FROM part""",
    "sampling_rate": _with(TOKENS, TURNS) + " SELECT edl_id, ord, round(greatest(0.5, least(10.0, 10 / greatest(CAST((stop - start) / 1000.0 AS DOUBLE), CAST(0.1 AS DOUBLE)))), 6) AS rate FROM ranges",
    "saturation": """WITH c AS (SELECT p_partkey, list_transform([50, 60, 80], lambda b: pow(greatest(p_size / b * CAST(1.1 AS DOUBLE) - CAST(0.03 AS DOUBLE), 0.0), CAST(0.9 AS DOUBLE))) AS v FROM part),
g AS (SELECT *, v[1] * CAST(0.2126 AS DOUBLE) + v[2] * CAST(0.7152 AS DOUBLE) + v[3] * CAST(0.0722 AS DOUBLE) AS grey FROM c)
SELECT p_partkey, round(grey + (v[1] - grey) * CAST(0.88 AS DOUBLE), 6) AS red, round(grey + (v[2] - grey) * CAST(0.88 AS DOUBLE), 6) AS green, round(grey + (v[3] - grey) * CAST(0.88 AS DOUBLE), 6) AS blue FROM g""",
    "latest_entry": "SELECT user_id, event_id, epoch_us(ts) AS at, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "default_paths": """SELECT doc_id, '/takes/' || doc_id % 10 || '/' || doc_id || '.v1.mp4' AS path, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN '/takes/' || doc_id % 10 || '/edit/transcripts/' || doc_id || '.v1.json' END AS transcript FROM documents""",
    "resolved_paths": "SELECT p_partkey, ['/abs/a.mp4', '/edit/one/a.mp4', '/edit/one/b/a.mp4', '/edit/a.mp4', '/edit/c/a.mp4'][p_partkey % 5 + 1] AS path FROM part",
    "false_starts": _with(TOKENS, SLIPS) + " SELECT source, pos, n AS length, array_to_string(said[1:n], ' ') AS said FROM slips",
    "slip_counts": _with(TOKENS, SLIPS)
    + f""", again AS (SELECT source, count(*) AS n_false_starts, CAST(sum(n) AS BIGINT) AS n_said_again FROM slips GROUP BY source)
SELECT source, count(*) AS n_words, count(*) FILTER (w IN ({", ".join(f"'{w}'" for w in FILLERS)})) AS n_fillers, coalesce(any_value(n_false_starts), 0) AS n_false_starts, coalesce(any_value(n_said_again), 0) AS n_said_again
FROM bare LEFT JOIN again USING (source) GROUP BY source""",
    "interval_sets": _with(TOKENS, TURNS, SWEPT)
    + """, held AS (SELECT source, kind, start, stop FROM (SELECT source, start, stop, unnest([CASE WHEN a > 0 OR b > 0 THEN 'union' END, CASE WHEN a > 0 AND b > 0 THEN 'intersection' END, CASE WHEN a > 0 AND b = 0 THEN 'difference' END, CASE WHEN (a > 0) <> (b > 0) THEN 'exclusion' END]) AS kind FROM pieces) WHERE kind IS NOT NULL),
opened AS (SELECT *, CASE WHEN lag(stop) OVER (PARTITION BY source, kind ORDER BY start) = start THEN 0 ELSE 1 END AS fresh FROM held),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY source, kind ORDER BY start) AS g FROM opened)
SELECT source, kind, min(start) AS start, max(stop) AS stop FROM grouped GROUP BY source, kind, g""",
    "peak_depth": _with(TOKENS, TURNS, SWEPT) + """, depth AS (SELECT source, start, sum(c) OVER (PARTITION BY source ORDER BY start) AS d FROM (SELECT source, start, sum(cb) AS c FROM ends WHERE cb <> 0 GROUP BY ALL))
SELECT source, CAST(max(d) AS BIGINT) AS peak, arg_min(start, (-d, start)) AS at, max(d) <= 6 AS fits FROM depth GROUP BY source""",
    "block_envelope": """WITH levels AS (SELECT vec_id, unnest(range(10)) AS i, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) * 1000)) AS v FROM embeddings),
l AS (SELECT vec_id AS source, CAST(i AS INT) AS i, sqrt(list_sum(list_transform(v[i * 6 + 1 : i * 6 + 6], lambda x: x * x)) / 6) AS level FROM levels),
t AS (SELECT *, max(level) OVER (PARTITION BY source) AS top FROM l)
SELECT source, i, round(CASE WHEN top > 0 THEN level / top ELSE level END, 6) AS value FROM t""",
    "repair_log": _with(TOKENS, TURNS, *_passes()) + " " + " UNION ALL ".join(f"SELECT edl_id, part, no, kind, amount, {k} AS pass FROM faults{k}" for k in (1, 2, 3, 4)),
    "repaired_ranges": _with(TOKENS, TURNS, *_passes()) + " SELECT edl_id, ord, source, start, stop FROM ranges4",
    "trails": """WITH p AS (SELECT user_id, event_id, epoch_us(ts) AS at, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
SELECT *, count(*) OVER w AS n, min("at") OVER w AS oldest, CAST(sum(cents) OVER w AS BIGINT) AS total FROM p WINDOW w AS (PARTITION BY user_id ORDER BY "at" RANGE BETWEEN 172800000000 PRECEDING AND CURRENT ROW)""",
    "lagged_starts": _with(TOKENS, TURNS)
    + """, l AS (SELECT source, turn, stop - start AS length, (stop - start) * 30 // 100 AS share FROM turns),
b AS (SELECT source, turn, length, CAST(coalesce(sum(share) OVER (PARTITION BY source ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "begin" FROM l)
SELECT *, "begin" + length AS "end" FROM b""",
    "squished": "SELECT p_partkey, round(greatest(0.0, least(1.0, (CAST(p_size AS DOUBLE) / 50 - 0.25) / 0.5)), 6) AS progress FROM part",
    "matched_parts": r"""WITH RECURSIVE u AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(regexp_replace(text, '[.,!?;:]', '', 'g')), '[ \t-\r]+'), lambda w: w <> '') AS a FROM conversations WHERE role = 'user'),
pairs AS (SELECT * FROM (SELECT conv_id || '/' || turn AS take, a, lead(a) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM u) WHERE b IS NOT NULL),
lines AS (
  SELECT take, a, b, 0 AS i, list_transform(range(len(b) + 1), lambda j: CAST(0 AS BIGINT)) AS row FROM pairs
  UNION ALL
  SELECT take, a, b, i + 1, list_transform(range(1, len(b) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(row[k], CASE WHEN k > 1 AND a[i + 1] = b[k - 1] THEN row[k - 1] + 1 ELSE 0 END)))) FROM lines WHERE i < len(a)),
lcs AS (SELECT take, row[len(b) + 1] AS n FROM lines WHERE i = len(a)),
l AS (SELECT take, w, count(*) AS n FROM (SELECT take, unnest(a) AS w FROM pairs) GROUP BY ALL), r AS (SELECT take, w, count(*) AS n FROM (SELECT take, unnest(b) AS w FROM pairs) GROUP BY ALL),
common AS (SELECT take, CAST(sum(least(l.n, r.n)) AS BIGINT) AS n FROM l JOIN r USING (take, w) GROUP BY take)
SELECT take, lcs.n AS n_matched, coalesce(c.n, 0) - lcs.n AS n_moved, len(b) - coalesce(c.n, 0) AS n_added, len(a) - coalesce(c.n, 0) AS n_dropped FROM pairs JOIN lcs USING (take) LEFT JOIN common c USING (take) WHERE len(a) + len(b) > 0""",
    "reactive_values": """WITH RECURSIVE needs AS (
  SELECT p_partkey AS name, p_partkey // 2 AS need, 1 AS weight FROM part WHERE p_partkey > 1 UNION ALL SELECT p_partkey, p_partkey // 10, 2 FROM part WHERE p_partkey % 5 = 0 AND p_partkey > 9 UNION ALL SELECT p_partkey, p_partkey * 2, 1 FROM part WHERE p_partkey % 97 = 0),
reached AS (
  SELECT p_partkey AS name, p_partkey AS at, CAST(1 AS BIGINT) AS weight, 0 AS level, [p_partkey] AS seen, false AS cyclic FROM part
  UNION ALL
  SELECT r.name, n.need, r.weight * n.weight, r.level + 1, list_append(r.seen, n.need), list_contains(r.seen, n.need) FROM reached r JOIN needs n ON n.name = r.at WHERE NOT r.cyclic),
found AS (SELECT r.name, sum(weight * p_size) AS value, max(level) AS level, bool_or(cyclic) AS cyclic, bool_or(p_partkey IS NULL) AS missing FROM reached r LEFT JOIN part ON p_partkey = r.at GROUP BY r.name)
SELECT CAST(name AS VARCHAR) AS name, CAST(CASE WHEN NOT (cyclic OR missing) THEN value END AS BIGINT) AS value, CASE WHEN NOT cyclic THEN level END AS level, cyclic, missing FROM found""",
    "loudness_plan": f"""SELECT o_orderkey, 'loudnorm={_AIMS}' || CASE WHEN o_orderkey % 5 < 2 THEN '' ELSE ':measured_I=' || o_orderkey % 17 || '.5:measured_TP=' || o_orderkey % 18 || '.5:measured_LRA=' || o_orderkey % 19 || '.5:measured_thresh=' || o_orderkey % 20 || '.5:offset=' || o_orderkey % 21 || '.5:linear=true' END AS step FROM orders""",
}

# the same rows, however a source is dealt to tasks
SQL |= {"long_phrases": SQL["phrases_events"], "long_snap": SQL["snap_asof"], "long_cues": SQL["cues"]}
