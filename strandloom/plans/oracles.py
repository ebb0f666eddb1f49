"""SQL of the registered queries, written for themselves: brute force where the engine joins on keys."""

from __future__ import annotations

from strandloom.sources.synthetic import FEATURES, PLAN


def _letters(number: str, n: int) -> str:
    return " || ".join(f"substr('ACGT', CAST((({number}) // {4**k}) % 4 AS INT) + 1, 1)" for k in range(n))


_FB = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEATURES.items()) + " END"
_READS = f"""
base AS (SELECT event_id AS e, {_letters('user_id * 37', 8)} AS cell, {_letters('(event_id * 7919) % 24 * 3', 6)} AS umi, {_FB} AS fb FROM events),
hurt AS (
    SELECT e, CASE WHEN e % 11 = 0 THEN substr(cell, 1, e % 8) || translate(substr(cell, e % 8 + 1, 1), 'ACGT', 'CGTA') || substr(cell, e % 8 + 2) ELSE cell END AS cell,
           CASE WHEN e % 19 = 0 THEN 'N' || substr(umi, 2) ELSE umi END AS umi,
           CASE WHEN e % 23 = 0 THEN substr(fb, 1, 5) || translate(substr(fb, 6, 1), 'ACGT', 'CGTA') ELSE fb END AS fb,
           CASE WHEN e % 13 = 0 THEN 'N' ELSE '' END AS pad, CASE WHEN e % 17 = 0 THEN 'ANNTC' ELSE 'AGGTC' END AS linker
    FROM base),
reads AS (
    SELECT 'S' || (e % 2) AS sample, 'r' || e AS read_id, CASE WHEN e % 29 = 0 THEN substr(pad || cell || linker, 1, 6) ELSE pad || cell || linker END AS r1_seq,
           umi || fb AS r2_seq
    FROM hurt),
cells AS (SELECT DISTINCT {_letters('user_id * 37', 8)} AS known FROM events),
features AS (SELECT unnest([{', '.join(f"'{v}'" for v in FEATURES.values())}]) AS known),
names AS (SELECT unnest([{', '.join(f"'{v}'" for k, v in FEATURES.items() if k != 'signup')}]) AS sequence,
                 unnest([{', '.join(f"'{k.upper()}'" for k in FEATURES if k != 'signup')}]) AS name)"""

_LINKED = "CASE WHEN pos = 0 THEN '' ELSE substr(r1_seq, greatest(1, pos - 8), least(8, pos - 1)) END"
_CUT = f""",
found AS (SELECT *, strpos(r1_seq, 'AGGTC') AS pos FROM reads),
linked AS (SELECT *, {_LINKED} AS raw_l, CASE WHEN pos = 0 THEN 'right_linker_not_found' WHEN pos < 9 THEN 'unexpected_length:' || (pos - 1) ELSE '' END AS why FROM found),
cut AS (
    SELECT sample, read_id, r1_seq, r2_seq, pos, why, raw_l,
           CASE WHEN why = '' THEN raw_l WHEN length(r1_seq) >= 8 THEN substr(r1_seq, 1, 9) ELSE '' END AS raw,
           CASE WHEN why = '' THEN 'linker' WHEN length(r1_seq) >= 8 THEN 'fixed' ELSE 'failed' END AS method,
           CASE WHEN why = '' OR length(r1_seq) >= 8 THEN '' ELSE 'linker_failed:' || why || ';fixed_failed:coordinate_out_of_range:0:8' END AS reason,
           substr(r2_seq, 7, 6) AS fb, substr(r2_seq, 1, 6) AS umi
    FROM linked)"""


def _fix(name: str, raws: str, known: str, length: int, shifts: tuple[int, ...], most: int) -> str:
    """CTEs that correct ``raws`` (raw, anchor) by brute force, into table ``name``."""
    turns = ", ".join(f"({k}, {s})" for k, s in enumerate(shifts))
    return f""",
{name}_w AS (
    SELECT raw, anchor, turn, shift, substr(raw, anchor + shift + 1, {length}) AS w
    FROM (SELECT DISTINCT raw, anchor FROM {raws}) CROSS JOIN (VALUES {turns}) AS t(turn, shift)
    WHERE anchor + shift >= 0 AND length(raw) >= anchor + shift + {length}),
{name}_d AS (SELECT w, known, hamming(w, known) AS mm FROM (SELECT DISTINCT w FROM {name}_w) CROSS JOIN (SELECT DISTINCT known FROM {known})),
{name}_c AS (SELECT w, known, mm FROM {name}_d QUALIFY mm = min(mm) OVER (PARTITION BY w) AND mm <= {most}),
{name}_s AS (
    SELECT raw, anchor, turn, shift, w, known, mm,
           row(CAST(shift <> 0 AS INT) + CAST(mm > 0 AS INT), abs(shift) + mm, mm, abs(shift)) AS score
    FROM {name}_w JOIN {name}_c USING (w)),
{name}_b AS (SELECT * FROM {name}_s QUALIFY score = min(score) OVER (PARTITION BY raw, anchor)),
{name}_g AS (
    SELECT raw, anchor, count(DISTINCT known) AS n, arg_min(known, row(turn, known)) AS known, arg_min(w, row(turn, known)) AS w,
           arg_min(shift, row(turn, known)) AS shift, arg_min(mm, row(turn, known)) AS mm
    FROM {name}_b GROUP BY raw, anchor),
{name} AS (
    SELECT r.raw, r.anchor, coalesce(g.w, substr(r.raw, r.anchor + 1, {length})) AS shifted, CASE WHEN n = 1 THEN known ELSE '' END AS corrected,
           CASE WHEN n IS NULL THEN 'failed' WHEN n = 1 THEN 'valid' ELSE 'ambiguous' END AS status, coalesce(shift, 0) AS shift, coalesce(mm, -1) AS mismatch,
           CASE WHEN n IS NULL OR n > 1 THEN 'failed' WHEN shift = 0 AND mm = 0 THEN 'exact' WHEN shift <> 0 AND mm > 0 THEN 'shift_and_mismatch'
                WHEN shift <> 0 THEN 'shift_only' ELSE 'mismatch_only' END AS kind
    FROM (SELECT DISTINCT raw, anchor FROM {raws}) r LEFT JOIN {name}_g g ON r.raw = g.raw AND r.anchor = g.anchor)"""


_GOOD = """,
good AS (SELECT *, 0 AS anchor FROM cut WHERE method <> 'failed'),
cell_raws AS (SELECT raw, anchor FROM good), fb_raws AS (SELECT fb AS raw, 0 AS anchor FROM good)"""
_CELL = _fix("cell_fix", "cell_raws", "cells", 8, (0, -1, 1), 1)
_FEATURE = _fix("fb_fix", "fb_raws", "features", 6, (0,), 1)
_FIXED = _GOOD + _CELL + _FEATURE
_JOINED = """,
joined AS (
    SELECT g.sample, g.read_id, c.corrected AS barcode1, f.corrected AS barcode2, coalesce(n.name, '') AS barcode2_name, g.umi
    FROM good g JOIN cell_fix c ON g.raw = c.raw AND g.anchor = c.anchor JOIN fb_fix f ON g.fb = f.raw LEFT JOIN names n ON n.sequence = f.corrected),
valid AS (SELECT * FROM joined WHERE barcode1 <> '' AND barcode2_name <> '' AND umi NOT LIKE '%N%'),
counts AS (SELECT sample, barcode1, barcode2_name, umi, count(*) AS n FROM valid GROUP BY ALL)"""


def _leaders(name: str, condition: str) -> str:
    return f""",
{name}_e AS (
    SELECT a.sample, a.barcode1, a.barcode2_name, a.umi AS x, b.umi AS y
    FROM counts a JOIN counts b ON a.sample = b.sample AND a.barcode1 = b.barcode1 AND a.barcode2_name = b.barcode2_name AND a.umi <> b.umi
    WHERE hamming(a.umi, b.umi) = 1 AND {condition}),
{name}_r AS (
    SELECT sample, barcode1, barcode2_name, umi AS x, umi AS y FROM counts
    UNION SELECT r.sample, r.barcode1, r.barcode2_name, r.x, e.y FROM {name}_r r
          JOIN {name}_e e ON r.sample = e.sample AND r.barcode1 = e.barcode1 AND r.barcode2_name = e.barcode2_name AND r.y = e.x),
{name} AS (
    SELECT t.sample, t.barcode1, t.barcode2_name, t.umi, t.n, arg_min(r.x, row(-s.n, r.x)) AS leader
    FROM {name}_r r JOIN counts s ON r.sample = s.sample AND r.barcode1 = s.barcode1 AND r.barcode2_name = s.barcode2_name AND r.x = s.umi
    JOIN counts t ON r.sample = t.sample AND r.barcode1 = t.barcode1 AND r.barcode2_name = t.barcode2_name AND r.y = t.umi
    GROUP BY ALL)"""


_DIRECTIONAL = _leaders("directional", "a.n >= 2 * b.n - 1")
_CLUSTER = _leaders("clustered", "TRUE")
_MOLECULES = _DIRECTIONAL + """,
molecules AS (SELECT sample, barcode1, barcode2_name, leader AS corrected_umi, CAST(sum(n) AS BIGINT) AS reads_count, count(*) AS raw_umi_count FROM directional GROUP BY ALL),
matrix AS (SELECT sample, barcode1, barcode2_name, count(*) AS molecules FROM molecules GROUP BY ALL)"""

_TO_VALID = _READS + _CUT + _FIXED + _JOINED
_ALL = _TO_VALID + _MOLECULES

_PAIRS = """,
parts AS (SELECT sample, substr(r1_seq, 1, 8) AS pb, substr(r2_seq, 1, 6) AS cb, substr(r2_seq, 7, 6) AS u, count(*) AS n FROM reads WHERE length(r1_seq) >= 8 GROUP BY ALL),
pairs AS (SELECT sample, pb, cb, count(*) AS molecule_count, CAST(sum(n) AS BIGINT) AS reads_count FROM parts GROUP BY ALL),
cbs AS (SELECT sample, cb, CAST(sum(reads_count) AS BIGINT) AS reads, length(cb) - length(replace(cb, 'N', '')) AS ns FROM pairs GROUP BY ALL),
options AS (
    SELECT c.sample, c.cb, c.reads, c.ns, p.cb AS parent, p.reads AS parent_reads
    FROM cbs c JOIN cbs p ON c.sample = p.sample AND c.cb <> p.cb AND p.ns = 0 AND p.reads >= 5 AND p.reads >= c.reads * 10 AND c.ns <= 1 AND hamming(c.cb, p.cb) = 1),
alias AS (
    SELECT sample, cb AS raw_cb, min(parent) AS corrected_cb, reads AS raw_reads_count, min(parent_reads) AS parent_reads_count,
           CASE WHEN ns > 0 THEN 'n_wildcard' ELSE 'hamming_1' END AS correction_type
    FROM options GROUP BY sample, cb, reads, ns HAVING count(DISTINCT parent) = 1),
resolved AS (
    SELECT p.sample, pb, coalesce(corrected_cb, cb) AS cb, CAST(sum(molecule_count) AS BIGINT) AS molecule_count, CAST(sum(reads_count) AS BIGINT) AS reads_count
    FROM pairs p LEFT JOIN alias a ON p.sample = a.sample AND p.cb = a.raw_cb GROUP BY ALL),
placed AS (
    SELECT *, CAST(sum(molecule_count) OVER (PARTITION BY sample, pb) AS BIGINT) AS total_molecule_count, CAST(sum(reads_count) OVER (PARTITION BY sample, pb) AS BIGINT) AS total_reads_count,
           row_number() OVER (PARTITION BY sample, pb ORDER BY reads_count DESC, cb) AS place
    FROM resolved),
kept AS (
    SELECT sample, pb, cb, molecule_count, reads_count, total_molecule_count, total_reads_count, round(CAST(reads_count AS DOUBLE) / total_reads_count, 6) AS dominant_ratio
    FROM placed WHERE place = 1 AND CAST(reads_count AS DOUBLE) / total_reads_count > 0.05),
per_cb AS (SELECT sample, cb, count(DISTINCT pb) AS pb_count FROM kept GROUP BY ALL)"""

_PI = """,
marked AS (
    SELECT *, row_number() OVER k AS place, count(*) OVER (PARTITION BY sample, barcode2_name, corrected_umi) AS barcodes,
           sum(reads_count) OVER (PARTITION BY sample, barcode2_name, corrected_umi) AS total
    FROM molecules WINDOW k AS (PARTITION BY sample, barcode2_name, corrected_umi ORDER BY reads_count DESC, barcode1)),
pi AS (SELECT *, place = 1 AND (barcodes = 1 OR CAST(reads_count AS DOUBLE) / total > 0.02) AS kept FROM marked)"""

_INNER = ", ".join(f"CAST({r} AS DOUBLE)" for r in PLAN.ratios)
_THIN = f""",
draws AS (
    SELECT m.*, repeat, read, CAST(CAST('0x' || substr(md5(concat_ws(':', '{PLAN.seed}', repeat, sample, barcode1, barcode2_name, corrected_umi, read)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS u
    FROM (SELECT *, unnest(range(1, {PLAN.repeats + 1})) AS repeat, range(1, reads_count + 1) AS reads FROM molecules) m, unnest(m.reads) AS t(read)),
thinned AS (
    SELECT sample, barcode1, barcode2_name, corrected_umi, CAST(1 AS DOUBLE) AS ratio, 0 AS repeat, reads_count AS reads FROM molecules
    UNION ALL
    SELECT sample, barcode1, barcode2_name, corrected_umi, ratio, repeat, count(*) AS reads
    FROM draws CROSS JOIN (SELECT unnest([{_INNER}]) AS ratio) WHERE u < ratio GROUP BY ALL),
points AS (
    SELECT DISTINCT sample, ratio, repeat FROM molecules CROSS JOIN (
        SELECT CAST(0 AS DOUBLE) AS ratio, 0 AS repeat UNION ALL SELECT CAST(1 AS DOUBLE), 0
        UNION ALL SELECT unnest([{_INNER}]), r FROM range(1, {PLAN.repeats + 1}) AS t(r))),
sums AS (SELECT sample, ratio, repeat, CAST(sum(reads) AS BIGINT) AS reads_sampled, count(*) AS umi_types, count(*) FILTER (reads = 1) AS umi_detected_once FROM thinned GROUP BY ALL),
metrics AS (
    SELECT p.sample, p.ratio, p.repeat, coalesce(reads_sampled, 0) AS reads_sampled, coalesce(umi_types, 0) AS umi_types, coalesce(umi_detected_once, 0) AS umi_detected_once,
           coalesce(round((reads_sampled - umi_types) / CAST(reads_sampled AS DOUBLE) * 100, 6), 0) AS duplication_ratio,
           coalesce(round((1 - umi_detected_once / CAST(umi_types AS DOUBLE)) * 100, 6), 0) AS sequencing_saturation
    FROM points p LEFT JOIN sums s ON p.sample = s.sample AND p.ratio = s.ratio AND p.repeat = s.repeat),
best AS (SELECT * FROM metrics QUALIFY row_number() OVER (PARTITION BY sample ORDER BY sequencing_saturation DESC, ratio, repeat) = 1),
chosen AS (SELECT t.sample, barcode1, barcode2_name, corrected_umi, reads AS reads_count FROM thinned t JOIN best b ON t.sample = b.sample AND t.ratio = b.ratio AND t.repeat = b.repeat)"""

_PIVOT = ", ".join(f"CAST(coalesce(sum(molecules) FILTER (barcode2_name = '{k.upper()}'), 0) AS BIGINT) AS \"{k.upper()}\"" for k in sorted(FEATURES) if k != "signup")


def _segment(raw: str, why: str, method: str, failure: str, left: str = "0", right: str = "0", pairs: str = "0", gap: str = "-1") -> str:
    return (
        f"SELECT sample, read_id, {raw} AS raw, {why} = '' AS success, {why} AS reason, {method} AS method, {failure} AS linker_failure, "
        f"CAST({left} AS INT) AS left_matches, CAST({right} AS INT) AS right_matches, CAST({pairs} AS INT) AS pairs, CAST({gap} AS INT) AS gap"
    )


def _places(linker: str, most: int) -> str:
    n = len(linker)
    return f"list_filter(range(0, length(r1_seq) - {n - 1}), lambda p: hamming(substr(r1_seq, CAST(p + 1 AS INT), {n}), '{linker}') <= {most})"


def _trace(table: str, name: str, raw: str) -> str:
    return f"""SELECT g.sample, g.read_id, '{name}' AS segment_name, '{name}' AS target_type, g.{raw} AS raw_sequence, c.shifted AS shifted_sequence, c.corrected AS corrected_sequence,
        c.status = 'valid' AS whitelist_hit, c.status AS correction_status, c.shift AS shift_distance, c.mismatch AS mismatch_distance, c.kind AS correction_type,
        {'g.method' if name == 'CELL' else "'fixed'"} AS method
        FROM good g JOIN {table} c ON g.{raw} = c.raw"""


_TRACE = f", trace AS ({_trace('cell_fix', 'CELL', 'raw')} UNION ALL {_trace('fb_fix', 'FB', 'fb')})"


def _alone(shifts: tuple[int, ...], most: int) -> str:
    raws = ", raws AS (SELECT raw, CASE WHEN length(raw) > 8 THEN 1 ELSE 0 END AS anchor FROM cut WHERE method <> 'failed')"
    return f"WITH {_READS}{_CUT}{raws}{_fix('fixed', 'raws', 'cells', 8, shifts, most)} SELECT * FROM fixed"


def _stats(name: str, target: str, read: str, mode: str, linked: bool) -> str:
    """The row of one segment; only CELL has a linker here."""
    n = "count(*)"
    lost = "count(*) FILTER (why <> '')"
    won = f"{n} - {lost}"
    rescued = "count(*) FILTER (method = 'fixed')"
    final = "count(*) FILTER (method <> 'failed')"
    pick = lambda a, b: a if linked else b
    rate = lambda a, b: f"round(CAST({a} AS DOUBLE) / ({b}), 6)"
    return f"""SELECT sample, '{name}' AS segment, '{target}' AS target, '{read}' AS read, '{mode}' AS configured_mode, {n} AS total_reads,
        {pick(n, '0')} AS linker_attempted, {pick(won, '0')} AS linker_success, {pick(lost, '0')} AS linker_failed, 0 AS left_linker_not_found,
        {pick("count(*) FILTER (why = 'right_linker_not_found')", '0')} AS right_linker_not_found, {pick("count(*) FILTER (why LIKE 'unexpected_length%')", '0')} AS unexpected_length,
        0 AS reads_with_multiple_left_matches, 0 AS reads_with_multiple_right_matches, 0 AS reads_with_multiple_candidate_pairs, 0 AS linker_candidate_pairs_total,
        CAST(NULL AS INT) AS selected_gap_min, CAST(NULL AS INT) AS selected_gap_max, {pick(lost, n)} AS fixed_attempted, {pick(rescued, n)} AS fixed_success,
        {pick(f'{lost} - {rescued}', '0')} AS fixed_failed, {pick(final, n)} AS final_success, {pick(rate(won, n), 'CAST(NULL AS DOUBLE)')} AS linker_success_rate,
        {pick(rate(rescued, lost), 'CAST(NULL AS DOUBLE)')} AS fixed_rescue_rate, {pick(rate(final, n), 'CAST(1 AS DOUBLE)')} AS final_success_rate
        FROM cut GROUP BY sample"""


_COUNTED = {
    "extracted_reads": "TRUE", "valid_reads": "whitelist_hit", "invalid_reads": "NOT whitelist_hit",
    **{f"{k}_count": f"correction_type = '{k}'" for k in ("exact", "mismatch_only", "shift_only", "shift_and_mismatch", "failed", "disabled")},
    **{f"{m}_extracted_count": f"method = '{m}'" for m in ("linker", "fixed")},
    **{f"{m}_barcode_valid_count": f"method = '{m}' AND whitelist_hit" for m in ("linker", "fixed")},
    **{f"mismatch_{i}_count": f"mismatch_distance = {i}" for i in range(3)}, **{f"shift_{i}_count": f"abs(shift_distance) = {i} AND whitelist_hit" for i in range(3)},
    **{f"shift_{side}_{i}_count": f"shift_distance = {sign * i} AND whitelist_hit" for i in (1, 2) for side, sign in (("left", -1), ("right", 1))},
}
_RATES = [f"{m}_barcode_valid_rate" for m in ("linker", "fixed")]
_NULLS = ", ".join(f"CAST(NULL AS BIGINT) AS {k}" for k in _COUNTED if k != "valid_reads") + "".join(f", CAST(NULL AS DOUBLE) AS {k}" for k in _RATES)
_CORRECTION_STATS = f"""WITH {_READS}{_CUT}{_FIXED}{_JOINED}{_TRACE},
totals AS (SELECT sample, count(*) AS total_reads FROM reads GROUP BY sample),
one AS (
    SELECT sample, segment_name AS scope, target_type, {', '.join(f'count(*) FILTER ({c}) AS {k}' for k, c in _COUNTED.items())},
           {', '.join(f"round(CAST(count(*) FILTER (method = '{m}' AND whitelist_hit) AS DOUBLE) / nullif(count(*) FILTER (method = '{m}'), 0), 6) AS {m}_barcode_valid_rate" for m in ('linker', 'fixed'))}
    FROM trace GROUP BY sample, segment_name, target_type),
final AS (
    SELECT sample, 'final_CELL' AS scope, 'CELL' AS target_type, count(*) FILTER (barcode1 <> '') AS valid_reads, {_NULLS} FROM joined GROUP BY sample
    UNION ALL SELECT sample, 'final_FB', 'FB', count(*) FILTER (barcode2_name <> ''), {_NULLS} FROM joined GROUP BY sample
    UNION ALL SELECT sample, 'combined', 'all', count(*) FILTER (barcode1 <> '' AND barcode2_name <> '' AND umi NOT LIKE '%N%'), {_NULLS} FROM joined GROUP BY sample)
SELECT b.*, total_reads, round(CAST(valid_reads AS DOUBLE) / total_reads, 6) AS valid_rate
FROM (SELECT * FROM one UNION ALL BY NAME SELECT * FROM final) b JOIN totals USING (sample)"""

_PAIR_AT = f""",
ends AS (SELECT *, {_places('AG', 0)} AS ls, {_places('TC', 0)} AS rs FROM reads),
combos AS (SELECT read_id, l, r FROM ends, unnest(ls) AS a(l), unnest(rs) AS b(r) WHERE r >= l + 2),
closest AS (SELECT read_id, count(*) AS pairs, min(row(r - l - 2, l, r)) AS p FROM combos GROUP BY read_id),
given AS (
    SELECT e.*, coalesce(pairs, 0) AS pairs, coalesce(p[1], -1) AS gap, CASE WHEN p IS NULL THEN '' ELSE substr(r1_seq, CAST(p[2] + 3 AS INT), CAST(p[1] AS INT)) END AS raw
    FROM ends e LEFT JOIN closest c USING (read_id)),
judged AS (
    SELECT *, CASE WHEN len(ls) = 0 THEN 'left_linker_not_found' WHEN pairs = 0 THEN 'right_linker_not_found_after_left'
                   WHEN length(raw) <> 1 THEN 'unexpected_length:' || length(raw) ELSE '' END AS why
    FROM given)"""
_LEFT_AT = f""",
hits AS (SELECT *, {_places('AGG', 1)} AS ps FROM reads),
first AS (SELECT *, list_min(list_transform(ps, lambda p: row(hamming(substr(r1_seq, CAST(p + 1 AS INT), 3), 'AGG'), p)))[2] AS p FROM hits),
judged AS (
    SELECT *, CASE WHEN p IS NULL THEN '' ELSE substr(r1_seq, CAST(p + 4 AS INT), 2) END AS raw,
           CASE WHEN p IS NULL THEN 'left_linker_not_found' WHEN length(substr(r1_seq, CAST(p + 4 AS INT), 2)) <> 2 THEN 'unexpected_length:' || length(substr(r1_seq, CAST(p + 4 AS INT), 2)) ELSE '' END AS why
    FROM first)"""
_OUT = "CASE WHEN length(r1_seq) < 10 THEN 'coordinate_out_of_range:2:10' ELSE '' END"
_N = "length({0}) - length(replace({0}, 'N', ''))"
_LENGTHS = f""",
l AS (SELECT sample, length(r1_seq) AS a, length(r2_seq) AS b, {_N.format('r1_seq')} + {_N.format('r2_seq')} AS ns FROM reads),
ma AS (SELECT sample, a, row_number() OVER (PARTITION BY sample ORDER BY count(*) DESC, a) AS k FROM l GROUP BY sample, a),
mb AS (SELECT sample, b, row_number() OVER (PARTITION BY sample ORDER BY count(*) DESC, b) AS k FROM l GROUP BY sample, b),
lengths AS (
    SELECT l.sample, count(*) AS reads, min(l.a) AS r1_min, max(l.a) AS r1_max, min(l.b) AS r2_min, max(l.b) AS r2_max, any_value(ma.a) AS r1_mode, any_value(mb.b) AS r2_mode,
           round(CAST(sum(ns) AS DOUBLE) / sum(l.a + l.b), 8) AS n_base_rate
    FROM l JOIN ma ON l.sample = ma.sample AND ma.k = 1 JOIN mb ON l.sample = mb.sample AND mb.k = 1 GROUP BY l.sample)"""


ORACLES = {
    "reads_synth": f"WITH {_READS} SELECT * FROM reads",
    "hamming_distance": f"WITH {_READS} SELECT read_id, hamming(substr(r2_seq, 1, 6), substr(r2_seq, 7, 6)) AS distance, CASE WHEN length(r1_seq) <> length(r2_seq) THEN greatest(length(r1_seq), length(r2_seq)) ELSE hamming(r1_seq, r2_seq) END AS whole FROM reads",
    "linker_positions": f"WITH {_READS} SELECT read_id, array_to_string({_places('AGG', 0)}, ',') AS exact, array_to_string({_places('AGG', 1)}, ',') AS close FROM reads",
    "extract_fixed": f"WITH {_READS} {_segment(f'CASE WHEN length(r1_seq) < 10 THEN chr(0) ELSE substr(r1_seq, 2, 10) END', _OUT, chr(39) + 'fixed' + chr(39), chr(39) * 2)} FROM reads".replace("chr(0)", "''"),
    "extract_linker_right": f"WITH {_READS}{_CUT} {_segment('raw_l', 'why', chr(39) + 'linker' + chr(39), 'why', right='pos > 0')} FROM linked",
    "extract_linker_left": f"WITH {_READS}{_LEFT_AT} {_segment('raw', 'why', chr(39) + 'linker' + chr(39), 'why', left='p IS NOT NULL')} FROM judged",
    "extract_linker_pair": f"WITH {_READS}{_PAIR_AT} {_segment('raw', 'why', chr(39) + 'linker' + chr(39), 'why', 'len(ls)', 'len(rs)', 'pairs', 'gap')} FROM judged",
    "extract_fallback": f"WITH {_READS}{_CUT} {_segment('raw', 'reason', 'method', 'why', right='pos > 0')} FROM cut",
    "extract_reads": f"""WITH {_READS}{_CUT}
        SELECT sample, read_id, raw AS "CELL_segments", fb AS "FB_segments", umi AS "UMI_segments", CASE method WHEN 'linker' THEN 'L' WHEN 'fixed' THEN 'F' ELSE 'X' END || 'FF' AS methods,
               CASE WHEN method = 'failed' THEN 'failed' ELSE 'success' END AS status, CASE WHEN method = 'failed' THEN 'CELL:' || reason ELSE '' END AS failure_reason FROM cut""",
    "extraction_preview": f"""WITH {_READS}{_CUT}
        SELECT sample, read_id, raw AS "CELL_segments", fb AS "FB_segments", umi AS "UMI_segments", CASE method WHEN 'linker' THEN 'L' WHEN 'fixed' THEN 'F' ELSE 'X' END || 'FF' AS methods,
               CASE WHEN method = 'failed' THEN 'failed' ELSE 'success' END AS status, CASE WHEN method = 'failed' THEN 'CELL:' || reason ELSE '' END AS failure_reason
        FROM cut QUALIFY row_number() OVER (PARTITION BY sample ORDER BY CAST(substr(read_id, 2) AS BIGINT)) <= 1000""",
    "extraction_stats": f"WITH {_READS}{_CUT} {_stats('CELL', 'CELL', 'R1', 'linker_fixed', True)} UNION ALL {_stats('FB', 'FB', 'R2', 'fixed', False)} UNION ALL {_stats('UMI', 'UMI', 'R2', 'fixed', False)}",
    "correct_exact": _alone((0,), 0),
    "correct_mismatch": _alone((0,), 1),
    "correct_mismatch_two": _alone((0,), 2),
    "correct_shift": _alone((0, -1, 1), 0),
    "correct_full": _alone((0, -1, 1), 1),
    "correct_ambiguous": _alone((0, -1, 1), 1) + " WHERE status = 'ambiguous'",
    "correct_disabled": f"""WITH {_READS}{_CUT}, raws AS (SELECT DISTINCT raw, CASE WHEN length(raw) > 8 THEN 1 ELSE 0 END AS anchor FROM cut WHERE method <> 'failed')
        SELECT raw, anchor, substr(raw, anchor + 1, 8) AS shifted, substr(raw, anchor + 1, 8) AS corrected, 'disabled' AS status, 0 AS shift, 0 AS mismatch, 'disabled' AS kind FROM raws""",
    "correction_trace": f"WITH {_READS}{_CUT}{_FIXED}{_TRACE} SELECT * EXCLUDE (method) FROM trace",
    "correction_stats": _CORRECTION_STATS,
    "valid_reads": f"WITH {_TO_VALID} SELECT *, 'valid' AS correction_summary FROM valid",
    "annotation_gap": f"""WITH {_READS}{_CUT}{_FIXED}
        SELECT g.sample, c.corrected AS barcode2_sequence, count(*) AS reads_count FROM good g JOIN fb_fix c ON g.fb = c.raw
        WHERE c.status = 'valid' AND c.corrected NOT IN (SELECT sequence FROM names) GROUP BY ALL""",
    "raw_umi_counts": f"WITH {_TO_VALID} SELECT * FROM counts",
    "group_counts": f"WITH {_TO_VALID} SELECT sample, count(DISTINCT row(barcode1, barcode2_name)) AS groups, CAST(sum(n) AS BIGINT) AS reads, count(*) AS raw_umis FROM counts GROUP BY sample",
    "umi_unique": f"WITH {_TO_VALID} SELECT *, umi AS leader FROM counts",
    "umi_cluster": f"WITH RECURSIVE {_TO_VALID}{_CLUSTER} SELECT * FROM clustered",
    "umi_adjacency": f"""WITH RECURSIVE {_TO_VALID}{_CLUSTER},
        r AS (SELECT *, row_number() OVER (PARTITION BY sample, barcode1, barcode2_name ORDER BY n DESC, umi) AS k FROM clustered),
        c AS (
            SELECT a.sample, a.barcode1, a.barcode2_name, a.umi, a.n, a.leader, a.k, least(a.k, coalesce(min(b.k) FILTER (hamming(a.umi, b.umi) = 1), a.k)) AS cover
            FROM r a JOIN r b ON a.sample = b.sample AND a.barcode1 = b.barcode1 AND a.barcode2_name = b.barcode2_name
            GROUP BY a.sample, a.barcode1, a.barcode2_name, a.umi, a.n, a.leader, a.k),
        l AS (SELECT *, max(cover) OVER (PARTITION BY sample, barcode1, barcode2_name, leader) AS last FROM c)
        SELECT l.sample, l.barcode1, l.barcode2_name, l.umi, l.n, CASE WHEN l.k <= l.last THEN l.umi ELSE o.umi END AS leader
        FROM l JOIN r o ON l.sample = o.sample AND l.barcode1 = o.barcode1 AND l.barcode2_name = o.barcode2_name AND l.cover = o.k""",
    "umi_directional": f"WITH RECURSIVE {_TO_VALID}{_DIRECTIONAL} SELECT * FROM directional",
    "umi_components": f"WITH RECURSIVE {_TO_VALID}{_CLUSTER} SELECT sample, barcode1, barcode2_name, leader AS first_umi, count(*) AS members, CAST(sum(n) AS BIGINT) AS reads FROM clustered GROUP BY ALL",
    "molecules": f"WITH RECURSIVE {_ALL} SELECT * FROM molecules",
    "matrix_long": f"WITH RECURSIVE {_ALL} SELECT * FROM matrix",
    "matrix_dense": f"WITH RECURSIVE {_ALL} SELECT sample, barcode1, {_PIVOT} FROM matrix GROUP BY sample, barcode1",
    "matrix_summary": f"WITH RECURSIVE {_ALL} SELECT sample, count(DISTINCT barcode1) AS barcode1_count, count(DISTINCT barcode2_name) AS feature_count, count(*) AS nonzero_count FROM matrix GROUP BY sample",
    "feature_totals": f"WITH RECURSIVE {_ALL} SELECT sample, barcode2_name, CAST(sum(molecules) AS BIGINT) AS molecules, count(*) AS barcodes FROM matrix GROUP BY ALL",
    "bulk_counts": f"WITH RECURSIVE {_ALL} SELECT sample, {_PIVOT} FROM matrix GROUP BY sample",
    "top_features": f"""WITH RECURSIVE {_ALL}, sums AS (SELECT sample, barcode2_name, CAST(sum(molecules) AS BIGINT) AS molecules, count(*) AS barcodes FROM matrix GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY sample ORDER BY molecules DESC, barcode2_name) AS rank FROM sums QUALIFY rank <= 25""",
    "pair_mapping": f"WITH {_READS}{_PAIRS} SELECT * FROM pairs",
    "cb_aliases": f"WITH {_READS}{_PAIRS} SELECT * FROM alias",
    "pb_cb_resolved": f"WITH {_READS}{_PAIRS} SELECT * FROM resolved",
    "pb_cb_map": f"WITH {_READS}{_PAIRS} SELECT * FROM kept",
    "cb_pb_counts": f"WITH {_READS}{_PAIRS} SELECT * FROM per_cb",
    "cb_pb_distribution": f"WITH {_READS}{_PAIRS} SELECT sample, pb_count, count(*) AS cb_count FROM per_cb GROUP BY ALL",
    "pi_seq_filter": f"WITH RECURSIVE {_ALL}{_PI} SELECT sample, barcode1, barcode2_name, corrected_umi, reads_count, raw_umi_count FROM pi WHERE kept",
    "pi_seq_qc": f"""WITH RECURSIVE {_ALL}{_PI}, q AS (
            SELECT sample, count(*) AS total_molecules, count(*) FILTER (place = 1) AS total_fb_umis, count(*) FILTER (place = 1 AND barcodes > 1) AS multi_pi_fb_umis,
                   count(*) FILTER (kept AND barcodes > 1) AS dominant_multi_pi_fb_umis, count(*) FILTER (kept) AS retained_molecules FROM pi GROUP BY sample)
        SELECT *, total_fb_umis - retained_molecules AS removed_fb_umis, round(coalesce(CAST(multi_pi_fb_umis AS DOUBLE) / nullif(total_fb_umis, 0), 0), 6) AS multi_pi_ratio,
               round(coalesce(CAST(dominant_multi_pi_fb_umis AS DOUBLE) / nullif(multi_pi_fb_umis, 0), 0), 6) AS dominant_ratio,
               round(coalesce(CAST(total_fb_umis - retained_molecules AS DOUBLE) / nullif(total_fb_umis, 0), 0), 6) AS mp_ratio, CAST(0.02 AS DOUBLE) AS dominance_threshold FROM q""",
    "downsample_counts": f"WITH RECURSIVE {_ALL}{_THIN} SELECT * FROM thinned",
    "downsample_metrics": f"WITH RECURSIVE {_ALL}{_THIN} SELECT * FROM metrics",
    "optimal_point": f"WITH RECURSIVE {_ALL}{_THIN} SELECT * FROM best",
    "optimal_detail": f"WITH RECURSIVE {_ALL}{_THIN} SELECT * FROM chosen",
    "optimal_matrix": f"WITH RECURSIVE {_ALL}{_THIN} SELECT sample, barcode1, barcode2_name, count(*) AS molecules FROM chosen GROUP BY ALL",
    "quick_test_lengths": f"WITH {_READS}{_LENGTHS} SELECT * FROM lengths",
    "quick_test_metrics": f"""WITH RECURSIVE {_ALL}{_LENGTHS},
        v AS (SELECT sample, count(*) AS valid_reads FROM valid GROUP BY sample),
        m AS (SELECT sample, count(*) AS deduplicated_molecules, round(CAST(sum(reads_count) - count(*) AS DOUBLE) / sum(reads_count), 8) AS duplication_ratio FROM molecules GROUP BY sample)
        SELECT lengths.*, coalesce(valid_reads, 0) AS valid_reads, round(coalesce(valid_reads, 0) / CAST(reads AS DOUBLE), 6) AS valid_rate, coalesce(deduplicated_molecules, 0) AS deduplicated_molecules, duplication_ratio
        FROM lengths LEFT JOIN v USING (sample) LEFT JOIN m USING (sample)""",
    "summary_meta": f"""WITH RECURSIVE {_ALL}{_TRACE}{_THIN},
        total AS (SELECT sample, count(*) AS total_reads FROM reads GROUP BY sample),
        hits AS (SELECT sample, count(*) FILTER (segment_name = 'CELL' AND whitelist_hit) AS cell, count(*) FILTER (segment_name = 'FB' AND whitelist_hit) AS fb,
                        count(*) FILTER (segment_name = 'FB' AND whitelist_hit AND corrected_sequence IN (SELECT sequence FROM names)) AS named FROM trace GROUP BY sample)
        SELECT t.sample, total_reads, round(cell / CAST(total_reads AS DOUBLE), 6) AS "CELL_valid_rate", round(fb / CAST(total_reads AS DOUBLE), 6) AS "FB_valid_rate",
               round(coalesce(named / CAST(nullif(fb, 0) AS DOUBLE), 0), 6) AS annotated_rate, b.ratio AS optimal_downsample_ratio, b.sequencing_saturation, b.reads_sampled, b.umi_types, b.umi_detected_once, b.duplication_ratio
        FROM total t JOIN hits USING (sample) LEFT JOIN best b USING (sample)""",
    "summary_counts": f"WITH RECURSIVE {_ALL}{_THIN}, matrix2 AS (SELECT sample, barcode1, barcode2_name, count(*) AS molecules FROM chosen GROUP BY ALL) SELECT sample, {_PIVOT} FROM matrix2 GROUP BY sample",
    "top_barcodes": f"""WITH {_TO_VALID}, t AS (SELECT sample, barcode1, count(*) AS reads FROM valid GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY sample ORDER BY reads DESC, barcode1) AS rank FROM t QUALIFY rank <= 10""",
}
