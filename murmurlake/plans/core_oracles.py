"""SQL of the core queries, built from shared common table expressions.

Not given: the whole pipeline run, which is tested on small fixtures instead.
"""

from __future__ import annotations

from murmurlake.config import BUCKETS, MINED_BUCKETS, TUNED
from murmurlake.plans.core_queries import PROMOTING
from murmurlake.plans.data_queries import CLOCK
from murmurlake.sources.messages import TYPES

S = TUNED
CJK = "[\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}]+"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}\\x1c-\\x1f]+|[\\s\\p{{Z}}\\x1c-\\x1f]+$', '', 'g')"


def _elements(x: str) -> str:
    return f"array_to_string(list_filter(list_transform({x}, lambda e: e.data.text), lambda v: coalesce(v, '') <> ''), chr(10))"


def _types() -> str:
    return "CASE coalesce(raw_type, 'type_1') " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPES.items()) + " ELSE 'other' END"


MSG = f"""
{CLOCK},
msg AS (SELECT row_id, coalesce(c.source_file, '') AS source_file, coalesce(msg_idx, 0) AS msg_idx, coalesce(t, 0) AS ts,
    coalesce(nullif(uid, ''), nullif(sender.uid, ''), '') AS u, coalesce(nullif(sender.uin, ''), '') AS uin,
    coalesce(nullif(sender.name, ''), nullif(sender.nickname, ''), '') AS name, coalesce(sender.nickname, '') AS nickname,
    coalesce(nullif(text, ''), nullif(content.text, ''), nullif({_elements("content.elements")}, ''), nullif({_elements("elements")}, ''), '') AS tx,
    coalesce(is_system, false) AS sys, coalesce(recalled, false) AS rec,
    CASE WHEN coalesce(is_system, false) THEN 'system' ELSE {_types()} END AS mt
  FROM clock c),
own AS (SELECT source_file AS sf, max(self_uid) AS self_uid FROM chat_files GROUP BY source_file),
mm AS (SELECT msg.*, {strip("tx")} AS st, coalesce(u = self_uid AND u <> '', false) AS me FROM msg LEFT JOIN own ON sf = msg.source_file)
"""

TURNS = f"""
{MSG},
ord AS (SELECT *, lag(me) OVER w AS lme, lag(u) OVER w AS lu, lag(ts) OVER w AS lts, row_number() OVER w AS pos FROM mm WHERE NOT rec
  WINDOW w AS (PARTITION BY source_file ORDER BY ts, msg_idx, row_id)),
cut AS (SELECT *, sum(CASE WHEN coalesce((lme = me OR (u <> '' AND lu = u)) AND ts - lts < {S.turn_gap_seconds * 1000}, false) THEN 0 ELSE 1 END)
    OVER (PARTITION BY source_file ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS turn_no FROM ord),
turns AS (SELECT source_file, CAST(turn_no AS BIGINT) AS turn_no, arg_min(me, pos) AS is_me, count(*) FILTER (WHERE st <> '') AS n_fragments,
    CAST(sum(length(st)) AS INTEGER) AS char_count, min(ts) AS start_ms, max(ts) AS end_ms, arg_min(sys, pos) AS is_system, arg_min(mt, pos) AS msg_type,
    coalesce(string_agg(st, chr(10) ORDER BY pos) FILTER (WHERE st <> ''), '') AS text,
    coalesce(list(st ORDER BY pos) FILTER (WHERE st <> ''), []) AS fr FROM cut GROUP BY source_file, turn_no)
"""

_BACK = " OR ".join(
    f"coalesce(lead(is_me, {k}) OVER w AND lead(start_ms, {k}) OVER w - end_ms <= {S.my_block_continue_seconds * 1000}"
    + "".join(
        f" AND lead(start_ms, {i}) OVER w - " + ("end_ms" if i == 1 else f"lead(end_ms, {i - 1}) OVER w") + f" <= {S.session_gap_minutes * 60_000}"
        for i in range(1, k + 1)
    )
    + ", false)"
    for k in range(1, 5)
)

SESSIONS = f"""
{TURNS},
gaps AS (SELECT *, start_ms - lag(end_ms) OVER w AS gap, {_BACK} AS back FROM turns WINDOW w AS (PARTITION BY source_file ORDER BY turn_no)),
ses AS (SELECT *, CAST(sum(CASE WHEN gap IS NULL OR gap > {S.session_gap_minutes * 60_000} THEN 1 ELSE 0 END)
    OVER (PARTITION BY source_file ORDER BY turn_no ROWS UNBOUNDED PRECEDING) - 1 AS INTEGER) AS session_no FROM gaps)
"""

_WAIT = S.my_block_continue_seconds * 1000
# What turn s does to the state r that the turn before left, as one step of the recursion.
_OPEN = "(r.open AND r.session_no = s.session_no)"
_LIGHT = f"(s.char_count <= {S.light_interruption_chars} AND r.light < {S.max_light_interruptions})"
_TAKE = (
    f"({_OPEN} AND CASE WHEN s.is_me THEN s.gap <= {_WAIT} WHEN s.char_count >= {S.hard_interruption_chars} THEN false "
    f"WHEN {_LIGHT} THEN true ELSE s.gap <= {_WAIT} AND s.back END)"
)
_BEGIN = f"(NOT {_TAKE} AND s.is_me AND NOT s.is_system)"
_MEDIUM = f"({_TAKE} AND NOT s.is_me AND NOT {_LIGHT})"
_FULL = f"({_MEDIUM} AND (r.frags + s.n_fragments > {S.max_fragment_count} OR r.chars + s.char_count > {S.max_block_chars}))"

BLOCKS = f"""
{SESSIONS},
fold AS (
  SELECT source_file, CAST(-1 AS BIGINT) AS turn_no, CAST(-1 AS INTEGER) AS session_no, false AS open, -1 AS block_no, 0 AS light,
    CAST(0 AS BIGINT) AS chars, CAST(0 AS BIGINT) AS frags, false AS inside FROM (SELECT DISTINCT source_file FROM turns)
  UNION ALL
  SELECT s.source_file, s.turn_no, s.session_no, {_BEGIN} OR ({_TAKE} AND NOT {_FULL}),
    CASE WHEN r.session_no = s.session_no THEN r.block_no ELSE -1 END + CASE WHEN {_BEGIN} THEN 1 ELSE 0 END,
    CASE WHEN {_BEGIN} THEN 0 WHEN {_TAKE} AND NOT s.is_me AND {_LIGHT} THEN r.light + 1 ELSE r.light END,
    CASE WHEN {_TAKE} THEN r.chars ELSE 0 END + s.char_count, CASE WHEN {_TAKE} THEN r.frags ELSE 0 END + s.n_fragments,
    {_BEGIN} OR {_TAKE}
  FROM fold r JOIN ses s ON s.source_file = r.source_file AND s.turn_no = r.turn_no + 1),
part AS (SELECT s.*, f.block_no, f.light FROM fold f JOIN ses s ON s.source_file = f.source_file AND s.turn_no = f.turn_no WHERE f.inside),
blk AS (SELECT source_file, session_no, block_no, printf('session_%05d', session_no) AS session_id,
    printf('session_%05d_block_%03d', session_no, block_no) AS block_id, min(turn_no) AS first_turn, max(turn_no) AS last_turn,
    CAST(coalesce(sum(n_fragments) FILTER (WHERE is_me), 0) AS BIGINT) AS my_msg_count, CAST(coalesce(sum(char_count) FILTER (WHERE is_me), 0) AS BIGINT) AS my_char_count,
    CAST(sum(char_count) AS BIGINT) AS total_char_count, count(*) FILTER (WHERE is_me) AS my_turn_count, count(*) FILTER (WHERE NOT is_me) AS other_turn_count,
    CAST(max(light) AS BIGINT) AS interruption_count, CAST(coalesce(sum(char_count) FILTER (WHERE NOT is_me), 0) AS BIGINT) AS interruption_chars,
    CAST(coalesce(sum(len(list_filter(fr, lambda x: length(x) <= {S.short_fragment_chars}))) FILTER (WHERE is_me), 0) AS BIGINT) AS short_fragment_count,
    coalesce(string_agg(text, chr(10) ORDER BY turn_no) FILTER (WHERE is_me AND text <> ''), '') AS my_text, CAST(sum(n_fragments) AS INTEGER) AS n_fragments
  FROM part GROUP BY source_file, session_no, block_no),
why AS (SELECT *, CASE WHEN total_char_count > 0 THEN my_char_count / total_char_count ELSE 0 END AS ratio FROM blk)
"""
BLOCKS = BLOCKS.strip()

LEX = f"""
lex AS (SELECT * FROM (SELECT kind, {strip("phrase")} AS phrase, label, severity, risk, status, entry_no,
    row_number() OVER (PARTITION BY kind, {strip("phrase")} ORDER BY entry_no DESC) AS k FROM lexicon WHERE length({strip("phrase")}) > 0)
  WHERE k = 1 AND coalesce(status, 'active') <> 'archived'),
bank AS (SELECT phrase, coalesce(label, 'unlabeled') AS label FROM lex WHERE kind = 'phrase_bank' AND phrase NOT IN (SELECT phrase FROM lex WHERE kind = 'manual_drop')
  UNION ALL SELECT phrase, coalesce(label, 'manual_keep') FROM lex WHERE kind = 'manual_keep'),
words AS (SELECT label AS k, phrase FROM bank UNION ALL
  SELECT severity, phrase FROM lex WHERE kind = 'chaos_lexicon' UNION ALL
  SELECT risk, phrase FROM lex WHERE kind = 'privacy_lexicon')
"""

DOCS = f"""
doc AS (SELECT doc_id, coalesce(source_file, '') AS source_file, bucket AS given, {strip("coalesce(text, '')")} AS t FROM documents),
dd AS (SELECT *, list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip("x")}), lambda x: x <> '') AS f FROM doc),
d AS (SELECT *, len(f) AS n, coalesce(list_sum(list_transform(f, lambda x: length(x))), 0) AS c, len(list_filter(f, lambda x: length(x) <= 3)) AS sh FROM dd),
dm AS (SELECT *, CASE WHEN n > 0 THEN round(sh / n, 4) ELSE 0 END AS sr, CASE WHEN c > 0 THEN 1.0 ELSE 0.0 END AS ratio FROM d)
"""


def _hits(k: str, fold: bool = False) -> str:
    test = "contains(lower(t), lower(w.phrase))" if fold else "contains(t, w.phrase)"
    return f"(SELECT count(*) FROM words w WHERE w.k = '{k}' AND {test})"


def _if(test: str, value: float) -> str:
    return f"CASE WHEN {test} THEN {value} ELSE 0.0 END"


_STYLE = " + ".join(
    [
        f"CASE WHEN c >= {S.good_my_block_chars} THEN 2.0 WHEN c >= {S.min_my_block_chars} THEN 1.0 ELSE 0.0 END",
        _if("n >= 3", 1.0),
        _if("n >= 5", 0.5),
        f"least({_hits('analysis_marker')} * 2.0, 6.0)",
        f"least({_hits('tone_marker')} * 1.0, 3.0)",
        _if("regexp_matches(t, '不是[^。]*而是')", 2.0),
        _if("regexp_matches(t, '先[^。]*再[^。]*')", 1.5),
        _if("regexp_matches(t, '主要是|关键是|本质上|说白了')", 1.5),
        _if("regexp_matches(t, '我感觉|我个人|我认为|我觉得')", 1.0),
        _if(f"len(list_filter(regexp_split_to_array(t, '[。！？\\n]'), lambda x: {strip('x')} <> '')) >= 3", 1.0),
        _if("n >= 5 AND c >= 100", 1.5),
    ]
)
_PRIVACY = " + ".join(
    [
        f"{_hits('high', True)} * 3.0",
        f"{_hits('medium', True)} * 1.5",
        _if("regexp_matches(t, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}')", 4.0),
        _if("regexp_matches(t, '1[3-9]\\p{Nd}{9}')", 4.0),
        _if("regexp_matches(t, '[1-9]\\p{Nd}{5}(?:19|20)\\p{Nd}{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\\p{Nd}|3[01])\\p{Nd}{3}[\\p{Nd}Xx]')", 5.0),
        _if("regexp_matches(t, '(?i)https?://[^\\s()<>\"'']+|www\\.[^\\s()<>\"'']+')", 2.0),
        "len(list_filter(regexp_extract_all(t, '[\\p{L}\\p{N}\\p{M}\\p{Pc}]+'), lambda x: regexp_full_match(x, '[1-9]\\p{Nd}{7,10}'))) * 2.0",
    ]
)
_LIGHT_HITS = "(SELECT coalesce(sum((length(t) - length(replace(t, w.phrase, ''))) // length(w.phrase)), 0) FROM words w WHERE w.k = 'light_interruption')"
_JUNK = " + ".join(
    [
        _if("regexp_full_match(t, '[^\\p{L}\\p{N}\\p{M}\\p{Pc}\\s\\p{Z}一-鿿]+')", 5.0),
        _if(f"sr > {S.max_short_fragment_ratio}", 3.0),
        _if("length(t) >= 10 AND len(list_distinct(string_split(t, ''))) / length(t) < 0.2", 4.0),
        _if(f"c > {S.max_block_chars}", 3.0),
        f"CASE WHEN {_LIGHT_HITS} >= 3 THEN least({_LIGHT_HITS} * 0.5, 3.0) ELSE 0.0 END",
    ]
)
_CHAOS = " + ".join(
    [
        f"least({_hits('mild', True)} * 1.0, 3.0)",
        f"least({_hits('strong', True)} * 2.0, 6.0)",
        _if("len(string_split(t, chr(10))) >= 5 AND len(list_distinct(string_split(t, chr(10)))) / len(string_split(t, chr(10))) < 0.5", 2.0),
    ]
)

SCORED = f"""
{LEX}, {DOCS},
sc AS (SELECT *, CASE WHEN t = '' THEN 0.0 ELSE round(least(CAST({_STYLE} AS DOUBLE), 15), 1) END AS style,
    CASE WHEN t = '' THEN 0.0 ELSE round(least(CAST({_PRIVACY} AS DOUBLE), 15), 1) END AS privacy,
    CASE WHEN t = '' THEN 0.0 ELSE round(least(CAST({_JUNK} AS DOUBLE), 10), 1) END AS junk,
    CASE WHEN t = '' THEN 0.0 ELSE round(least(CAST({_CHAOS} AS DOUBLE), 10), 1) END AS chaos FROM dm)
"""


SCORED_MESSAGES = SCORED.replace("bucket AS given", "NULL AS given").replace("SELECT doc_id, coalesce(source_file", "SELECT row_id AS doc_id, coalesce(source_file").replace(
    "FROM documents)", "FROM messages)"
)


def _num(c: str) -> str:
    return f"(CASE WHEN t = '' THEN '0' ELSE CAST(CAST({c} AS DOUBLE) AS VARCHAR) END)"


_STYLED = f"style >= {S.need_anonymize_min_style_score}"
_GATES = (
    f"concat_ws(',', CASE WHEN chaos >= {S.max_chaos_ratio_for_candidate * 10} THEN 'chaos' END, CASE WHEN junk >= 3 THEN 'junk' END, "
    f"CASE WHEN ratio < {1 - S.max_other_char_ratio_inside_my_block} THEN 'ratio' END)"
)
_RULES = [
    (f"privacy >= 8 AND {_STYLED}", "need_anonymize", "'high_privacy_but_has_style'"),
    ("privacy >= 8", "rejected", "'high_privacy_no_style'"),
    (f"junk >= {S.junk_reject_score}", "rejected", f"'junk_score_too_higher:' || {_num('junk')}"),
    (f"privacy >= {S.privacy_medium_threshold} AND {_STYLED}", "need_anonymize", "'medium_privacy_with_style'"),
    (f"chaos >= {S.chaos_separate_score} AND style >= 2 AND junk < 4", "chaos_style", "'chaotic_but_has_style'"),
    (f"chaos >= {S.chaos_separate_score} AND junk >= {S.junk_reject_score * 0.5}", "rejected", "'chaos_and_junk'"),
    (f"chaos >= {S.chaos_separate_score}", "chaos_style", "'chaos_separated'"),
    (
        f"style >= {S.candidate_min_style_score} AND c >= {S.candidate_min_chars_when_style_high} AND {_GATES} <> '' AND style >= {S.debatable_min_style_score}",
        "debatable",
        f"'debatable_gate_failures:' || {_GATES}",
    ),
    (f"style >= {S.candidate_min_style_score} AND c >= {S.candidate_min_chars_when_style_high}", "candidates", "'high_style_score'"),
    (f"style >= {S.candidate_min_style_score}", "micro_style", "'short_but_high_style'"),
    (f"style >= {S.micro_style_min_style_score}", "micro_style", "'low_style_but_has_tone'"),
]
_FALLBACK = (
    f"'rejected_fallback:' || concat_ws('|', CASE WHEN style < {S.micro_style_min_style_score} THEN 'style_too_low:' || {_num('style')} END, "
    f"CASE WHEN junk >= {S.junk_reject_score * 0.4} THEN 'elevated_junk:' || {_num('junk')} END, "
    f"CASE WHEN chaos >= {S.chaos_separate_score * 0.5} THEN 'elevated_chaos:' || {_num('chaos')} END)"
)


def _decided(cap: int) -> str:
    bucket = "CASE " + " ".join(f"WHEN {c} THEN '{b}'" for c, b, _ in _RULES) + " ELSE 'rejected' END"
    reason = "CASE " + " ".join(f"WHEN {c} THEN {r}" for c, _, r in _RULES) + f" ELSE {_FALLBACK} END"
    return f"""{SCORED},
    ca AS (SELECT *, {bucket} AS b0, {reason} AS r0 FROM sc),
    cb AS (SELECT *, row_number() OVER (PARTITION BY b0 ORDER BY style DESC, junk, chaos, ratio DESC, c DESC, doc_id) AS place FROM ca),
    dec AS (SELECT *, CASE WHEN b0 = 'debatable' AND place > {cap} THEN 'rejected' ELSE b0 END AS bucket,
      r0 || CASE WHEN b0 = 'debatable' AND place > {cap} THEN '|debatable_overflow_prioritized' ELSE '' END AS reasons FROM cb)"""


def _tags() -> str:
    any_of = lambda k: f"{_hits(k)} > 0"
    tags = [
        (any_of("analysis_tag_marker"), "analysis_explaining"),
        ("regexp_matches(t, '不是[^。]*而是')", "not_x_but_y_pattern"),
        ("n >= 4 AND c >= 200", "qq_fragmented_long_speech"),
        ("c <= 30 AND style >= 2", "short_reaction"),
        ("chaos >= 3 AND style >= 3", "joke_abstract"),
        (f"n >= 3 AND {any_of('argument_marker')}", "argument"),
        ("style < 2 AND junk < 3", "low_signal"),
    ]
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in tags) + ")"


def _masked() -> str:
    """Words masked one after the other: a recursion over the list."""
    return f"""WITH RECURSIVE {LEX}, {DOCS},
    mw AS (SELECT phrase, row_number() OVER (ORDER BY entry_no) AS k FROM lex WHERE kind = 'mask_words'),
    go AS (SELECT doc_id, t, CAST(0 AS BIGINT) AS k, [] :: VARCHAR[] AS why FROM doc UNION ALL
      SELECT doc_id, regexp_replace(t, '(?i)' || regexp_escape(phrase), '[MASKED]', 'g'), mw.k,
        CASE WHEN contains(lower(t), lower(phrase)) THEN list_append(why, 'masked_word:' || len(regexp_extract_all(t, '(?i)' || regexp_escape(phrase)))) ELSE why END
      FROM go JOIN mw ON mw.k = go.k + 1)
    SELECT doc_id, md5(t) AS text_md5, array_to_string(why, '|') AS reasons FROM go WHERE k = (SELECT count(*) FROM mw) AND len(why) > 0"""


DECISIONS = f"""
rd AS (SELECT kind, key, decision, reason FROM (SELECT kind, {strip("decision_key")} AS key, decision, reason,
    row_number() OVER (PARTITION BY kind, {strip("decision_key")} ORDER BY line_no DESC) AS k FROM review_decisions
  WHERE kind IN ('phrase', 'block') AND length({strip("decision_key")}) > 0 AND decision IN ('keep', 'drop')) WHERE k = 1)
"""

_CLASSES = f"""
cl AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\s\\p{{Z}}\\x1c-\\x1f]+', '', 'g') AS t FROM documents),
rep AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS rep FROM cl),
gr AS (SELECT DISTINCT doc_id, substr(t, CAST(i AS BIGINT), 2) AS g FROM (SELECT doc_id, t, unnest(generate_series(1, length(t) - 1)) AS i FROM rep WHERE rep = doc_id AND length(t) >= 2)),
sz AS (SELECT doc_id, count(*) AS n FROM gr GROUP BY doc_id),
cand AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM sz x JOIN sz y ON x.doc_id < y.doc_id AND least(x.n, y.n) >= 0.8 * greatest(x.n, y.n) - 1e-9),
com AS (SELECT a, b, na, nb, count(*) AS k FROM cand JOIN gr p ON p.doc_id = a JOIN gr q ON q.doc_id = b AND q.g = p.g GROUP BY a, b, na, nb),
pr AS (SELECT a, b, k / (na + nb - k) AS similarity FROM com WHERE k / (na + nb - k) >= 0.8)
"""

_BUCKET_RANK = "CASE bucket " + " ".join(f"WHEN '{b}' THEN {i + 1}" for i, b in enumerate(MINED_BUCKETS)) + " END"
_IN = "(" + ", ".join(f"'{b}'" for b in MINED_BUCKETS) + ")"

GRAMS = f"""
tx AS (SELECT bucket, doc_id, text, {_BUCKET_RANK} AS br FROM documents WHERE bucket IN {_IN} AND text <> ''),
rl AS (SELECT bucket, br, doc_id, regexp_extract_all(text, '{CJK}') AS rr FROM tx),
ru AS (SELECT bucket, br, doc_id, rr[i] AS run, i AS ak FROM (SELECT *, unnest(generate_series(1, len(rr))) AS i FROM rl)),
gg AS (SELECT bucket, br, doc_id, ak, n, p, substr(run, CAST(p AS BIGINT), n) AS phrase,
    CASE WHEN p > 1 THEN substr(run, CAST(p AS BIGINT) - 1, 1) END AS l, nullif(substr(run, CAST(p AS BIGINT) + n, 1), '') AS r
  FROM (SELECT *, unnest(generate_series(1, length(run) - n + 1)) AS p FROM ru, (VALUES (2), (3), (4)) v(n))),
cnt AS (SELECT n, phrase, count(*) AS freq, min((br, doc_id, ak, p)) AS seen, {", ".join(f"count(*) FILTER (WHERE bucket = '{b}') AS {b}" for b in MINED_BUCKETS)} FROM gg GROUP BY n, phrase)
"""

LEAD = f"""
{GRAMS},
led AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY freq DESC, seen) AS place FROM cnt WHERE freq >= {S.min_freq})
  WHERE place <= {3 * S.top_k_each_length}),
ch AS (SELECT c, count(*) AS k FROM (SELECT unnest(string_split(run, '')) AS c FROM ru) GROUP BY c),
pi AS (SELECT phrase, CASE WHEN freq < 2 THEN 0.0 ELSE greatest(0.0, log2((freq / (SELECT sum(freq) FROM cnt WHERE n = 2)) /
    ((coalesce(x.k, 1) / (SELECT sum(k) FROM ch)) * (coalesce(y.k, 1) / (SELECT sum(k) FROM ch))))) END AS pmi
  FROM cnt LEFT JOIN ch x ON x.c = substr(phrase, 1, 1) LEFT JOIN ch y ON y.c = substr(phrase, 2, 1) WHERE n = 2),
inner_ AS (SELECT phrase, n, unnest(generate_series(1, n - 1)) AS i FROM led),
inf AS (SELECT inner_.phrase, avg(coalesce(pi.pmi, 0)) AS pmi FROM inner_ LEFT JOIN pi ON pi.phrase = substr(inner_.phrase, CAST(i AS BIGINT), 2) GROUP BY inner_.phrase),
nb AS (SELECT phrase, side, c, count(*) AS k FROM (SELECT phrase, 'l' AS side, l AS c FROM gg WHERE l IS NOT NULL UNION ALL SELECT phrase, 'r', r FROM gg WHERE r IS NOT NULL)
  WHERE phrase IN (SELECT phrase FROM led) GROUP BY phrase, side, c),
hs AS (SELECT phrase, side, greatest(0.0, log2(sum(k)) - sum(k * log2(k)) / sum(k)) AS h FROM nb GROUP BY phrase, side),
ent AS (SELECT led.phrase, coalesce(max(h) FILTER (WHERE side = 'l'), 0) AS le, coalesce(max(h) FILTER (WHERE side = 'r'), 0) AS re FROM led LEFT JOIN hs USING (phrase) GROUP BY led.phrase)
"""

_LISTED = "(SELECT DISTINCT phrase, substr(kind, 8) AS listed FROM lex WHERE kind IN ('manual_keep', 'manual_drop'))"
MANUAL = f"""{LEX}, {DECISIONS},
mp AS (SELECT DISTINCT coalesce(a.phrase, b.key) AS phrase, coalesce(b.decision, a.listed) AS decision
  FROM {_LISTED} a FULL JOIN (SELECT key, decision FROM rd WHERE kind = 'phrase') b ON a.phrase = b.key)"""

# Weights as doubles: a plain 1.2 would be a decimal, and halves would round otherwise than in the operator.
_W = {k: f"{abs(v)}::DOUBLE" for k, v in dict(S.bucket_weight).items()}
_KEY = (
    f"((candidates * {_W['candidates']} + micro_style * {_W['micro_style']} + 0.5) / "
    f"(chaos_style * {_W['chaos_style']} + need_anonymize * {_W['need_anonymize']} + rejected * {_W['rejected']} + 0.5))"
)
_ALL = "greatest(1, candidates + micro_style + chaos_style + need_anonymize + rejected)"

MINED = f"""
{MANUAL}, {LEAD},
mk AS (SELECT led.*, pmi, le, re, least(le, re) AS me, CAST({_KEY} AS DOUBLE) AS kn, chaos_style / {_ALL} AS cr, need_anonymize / {_ALL} AS pr,
    led.phrase IN (SELECT phrase FROM mp WHERE decision = 'keep') AS mk
  FROM led JOIN inf USING (phrase) JOIN ent USING (phrase)
  WHERE led.phrase NOT IN (SELECT phrase FROM lex WHERE kind = 'phrase_stoplist') AND led.phrase NOT IN (SELECT phrase FROM mp WHERE decision = 'drop')
    AND pmi >= CASE n WHEN 2 THEN {S.min_pmi_2gram} WHEN 3 THEN {S.min_pmi_3gram} ELSE {S.min_pmi_4gram} END AND least(le, re) >= {S.min_entropy}),
mj AS (SELECT *, CASE WHEN cr > 0.5 AND kn < 2 THEN 'chaos_phrase' WHEN pr > 0.3 THEN 'privacy_phrase' WHEN kn >= {S.min_keyness} THEN 'candidate_style_phrase'
      ELSE 'ambiguous_phrase' END AS suggested_label,
    CASE WHEN mk THEN 'manual_keep' WHEN cr > 0.7 OR (rejected > candidates AND freq < 10) THEN 'skip' WHEN pr > 0.4 THEN 'privacy_review'
      WHEN kn >= {S.min_keyness} AND cr < 0.3 THEN 'review' ELSE 'review_low_keyness' END AS suggested_action,
    concat_ws('|', CASE WHEN mk THEN 'manual_phrase_keep' END, CASE WHEN candidates > 0 AND rejected = 0 THEN 'high_candidate_frequency' END,
      CASE WHEN candidates > rejected * 2 AND rejected > 0 THEN 'low_rejected_frequency' END, CASE WHEN pmi > {S.min_pmi_2gram * 2} THEN 'stable_ngram' END,
      CASE WHEN me > 1.5 THEN 'high_entropy' END, CASE WHEN cr < 0.1 THEN 'low_chaos' END) AS reasons FROM mk),
mined AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY round(kn, 2) DESC, freq DESC, place) AS rank FROM mj) WHERE rank <= {S.top_k_each_length})
"""

_CATEGORY = """CASE kind WHEN 'phrase_bank' THEN 'style_markers.' || coalesce(label, 'unknown') WHEN 'chaos_lexicon' THEN 'chaos.' || coalesce(severity, 'unknown')
  WHEN 'privacy_lexicon' THEN 'privacy.' || coalesce(risk, 'unknown') WHEN 'drop_sentence_words' THEN 'filter.drop_sentence' WHEN 'mask_words' THEN 'filter.mask'
  WHEN 'phrase_candidates' THEN 'phrase_mining.candidates' WHEN 'phrase_stoplist' THEN 'phrase_mining.stoplist' WHEN 'manual_keep' THEN 'manual.keep'
  WHEN 'manual_drop' THEN 'manual.drop' ELSE 'unknown' END"""
_KIND_RANK = """CASE kind WHEN 'phrase_bank' THEN 1 WHEN 'chaos_lexicon' THEN 2 WHEN 'privacy_lexicon' THEN 3 WHEN 'drop_sentence_words' THEN 4 WHEN 'mask_words' THEN 5
  WHEN 'phrase_candidates' THEN 6 WHEN 'manual_keep' THEN 7 WHEN 'manual_drop' THEN 8 WHEN 'phrase_stoplist' THEN 9 ELSE 0 END"""


def _first_seen(value: str) -> str:
    """Distinct values in order of first sight, as text."""
    return f"(SELECT coalesce(string_agg(v, '|' ORDER BY o), '') FROM (SELECT {value} AS v, min((kr, entry_no)) AS o FROM ar y WHERE y.term = x.term AND {value} <> '' GROUP BY {value}))"


TERMS = f"""
ar AS (SELECT {strip("phrase")} AS term, entry_no, {_KIND_RANK} AS kr, {_CATEGORY} AS cat, kind || CASE WHEN kind = 'phrase_stoplist' THEN '.txt' ELSE '.jsonl' END AS sf,
    coalesce(label, severity, risk, '') AS lb FROM lexicon WHERE length({strip("phrase")}) > 0),
te AS (SELECT term, arg_min(cat, (kr, entry_no)) AS old_category, arg_min(sf, (kr, entry_no)) AS source_file FROM ar GROUP BY term)
"""

AUDIT = f"""
{TERMS},
bt AS (SELECT bucket, text FROM documents WHERE text <> ''),
co AS (SELECT term, {", ".join(f"count(*) FILTER (WHERE bucket = '{b}') AS {b}" for b in MINED_BUCKETS)}, count(*) AS my_block_count FROM te JOIN bt ON contains(text, term) GROUP BY term),
au AS (SELECT term, old_category, source_file, {", ".join(f"coalesce({b}, 0) AS {b}" for b in MINED_BUCKETS)}, coalesce(my_block_count, 0) AS my_block_count FROM te LEFT JOIN co USING (term)),
av AS (SELECT *, candidates + micro_style + need_anonymize + chaos_style + rejected AS f, candidates + micro_style AS good, rejected + chaos_style + need_anonymize AS bad FROM au),
aw AS (SELECT *, good / greatest(f, 1) AS cr, rejected / greatest(f, 1) AS rr,
    CASE WHEN bad <= 0 THEN good / greatest(1.0, greatest(f, 1) * 0.1) * 2.0 ELSE good / greatest(1, bad) END AS kn FROM av),
ax AS (SELECT *, CASE
    WHEN f = 0 THEN 'demote_or_remove:zero_frequency'
    WHEN old_category LIKE 'privacy.%' AND f >= 8 THEN 'keep_in_privacy_lexicon:verified_privacy_term'
    WHEN old_category LIKE 'privacy.%' THEN 'demote_or_remove:low_frequency_privacy_term'
    WHEN contains(old_category, 'strong') THEN 'keep_in_chaos_lexicon:strong_chaos_isolated'
    WHEN old_category LIKE 'filter.%' AND f >= 8 THEN 'promote_to_active:verified_filter_word'
    WHEN old_category LIKE 'filter.%' AND f >= 2 THEN 'keep_as_candidate:low_frequency_filter_word'
    WHEN old_category LIKE 'filter.%' THEN 'demote_or_remove:unused_filter_word'
    WHEN old_category LIKE 'phrase_mining.stoplist%' AND f >= 10 THEN 'keep_in_stoplist:high_frequency_stopword'
    WHEN old_category LIKE 'phrase_mining.stoplist%' THEN 'demote_or_remove:low_impact_stopword'
    WHEN f >= 8 AND cr >= 0.4 AND rr <= 0.2 THEN 'promote_to_active:high_frequency|high_candidate_presence|low_rejected_presence'
    WHEN f >= 2 AND rr > 0.35 THEN 'demote_or_remove:high_rejected_presence' || CASE WHEN cr < 0.4 THEN '|low_candidate_ratio' ELSE '' END
    WHEN f >= 2 THEN 'keep_as_candidate:moderate_frequency' || CASE WHEN cr < 0.4 THEN '|low_candidate_ratio' ELSE '' END
    ELSE 'demote_or_remove:' || CASE WHEN rr > 0.35 THEN 'high_rejected_presence|' ELSE '' END || 'very_low_frequency' END AS v FROM aw),
aud AS (SELECT term, old_category, source_file, f AS freq_total, my_block_count, round(cr, 4) AS candidate_rate, round(rr, 4) AS rejected_rate, kn,
    CASE WHEN length(term) <= 1 THEN 'demote_or_remove' ELSE split_part(v, ':', 1) END AS suggested_status,
    CASE WHEN length(term) <= 1 THEN 'single_character_noise' ELSE split_part(v, ':', 2)
      || CASE WHEN kn > 2.0 AND split_part(v, ':', 1) <> 'promote_to_active' THEN '|notable_style_keyness_despite_other_factors' ELSE '' END
      || CASE WHEN cr > 0.5 THEN '|strong_candidate_signal' ELSE '' END END AS reasons FROM ax)
"""

_SUMMARY = " UNION ALL ".join(
    f"SELECT '{n}' AS metric, '' AS item, CAST({e} AS BIGINT) AS value FROM aud"
    for n, e in (
        ("total_terms_audited", "count(*)"),
        ("total_occurrences", "coalesce(sum(freq_total), 0)"),
        ("promote_to_active", "count(*) FILTER (WHERE suggested_status = 'promote_to_active')"),
        ("keep_as_candidate", "count(*) FILTER (WHERE suggested_status = 'keep_as_candidate')"),
        ("demote_or_remove", "count(*) FILTER (WHERE suggested_status = 'demote_or_remove')"),
        ("privacy_terms", "count(*) FILTER (WHERE contains(suggested_status, 'privacy'))"),
        ("chaos_terms", "count(*) FILTER (WHERE contains(suggested_status, 'chaos'))"),
        ("filter_terms", "count(*) FILTER (WHERE old_category LIKE 'filter.%')"),
        ("zero_frequency_terms", "count(*) FILTER (WHERE freq_total = 0)"),
    )
)
_LISTS = (
    ("review_privacy_terms", "suggested_action = 'privacy_review'", "round(pr, 4)"),
    ("review_chaos_terms", "suggested_action <> 'privacy_review' AND round(cr, 4) > 0.5", "round(cr, 4)"),
    ("review_phrases_top", "suggested_action <> 'privacy_review' AND round(cr, 4) <= 0.5", "round(kn, 2)"),
    ("review_stopword_candidates", f"freq > {S.min_freq * 5} AND round(pmi, 2) < {S.min_pmi_2gram * 0.6} AND round(me, 4) < 0.8", "freq"),
)
_NORM = (
    "(SELECT string_agg(c, '' ORDER BY i) FROM (SELECT i, string_split(phrase, '')[i] AS c, CASE WHEN i > 1 THEN string_split(phrase, '')[i - 1] END AS b "
    "FROM (SELECT unnest(generate_series(1, length(phrase))) AS i)) WHERE b IS NULL OR b <> c)"
)


def _links(phrases: str) -> str:
    return f"""
ph AS (SELECT phrase, {_NORM} AS nm FROM ({phrases})),
bg AS (SELECT DISTINCT phrase, substr(nm, CAST(i AS BIGINT), 2) AS g FROM (SELECT phrase, nm, unnest(generate_series(1, length(nm) - 1)) AS i FROM ph WHERE length(nm) >= 2)),
bn AS (SELECT phrase, count(*) AS k FROM bg GROUP BY phrase),
bo AS (SELECT p.phrase AS a, q.phrase AS b, count(*) AS k FROM bg p JOIN bg q ON p.g = q.g AND p.phrase < q.phrase GROUP BY 1, 2),
li AS (SELECT x.phrase AS a, y.phrase AS b, CASE WHEN x.nm = y.nm THEN 'normalised_variant'
    WHEN length(x.nm) >= 2 AND (contains(x.nm, y.nm) OR contains(y.nm, x.nm)) THEN 'contained_phrase'
    WHEN bo.k / (p.k + q.k - bo.k) >= 0.5 THEN 'surface_overlap' END AS link
  FROM ph x JOIN ph y ON x.phrase < y.phrase LEFT JOIN bo ON bo.a = x.phrase AND bo.b = y.phrase LEFT JOIN bn p ON p.phrase = x.phrase LEFT JOIN bn q ON q.phrase = y.phrase)
"""


_MODE = lambda test, bucket, reason: (
    f"WITH {SCORED_MESSAGES} SELECT doc_id, '{bucket}' AS bucket, '{reason}:score=' || CAST(CAST(privacy AS DOUBLE) AS VARCHAR) AS reasons FROM sc WHERE {test}"
)

ORACLES: dict[str, str] = {
    "scan_messages": f"""WITH {MSG} SELECT row_id, source_file, ts AS timestamp_ms, u AS uid, uin, name, nickname, mt AS msg_type, sys AS is_system, rec AS is_recalled FROM msg""",
    "first_present_field": f"WITH {MSG} SELECT row_id, tx AS text FROM msg",
    "message_type_map": f"WITH {MSG} SELECT mt AS msg_type, sys AS is_system, count(*) AS n FROM msg GROUP BY 1, 2",
    "text_strip": f"WITH {MSG} SELECT row_id, length(st) AS n_chars FROM mm",
    "own_message_counts": f"""WITH {MSG} SELECT source_file, count(*) AS n_messages, count(*) FILTER (WHERE me) AS n_own, count(*) FILTER (WHERE rec) AS n_recalled FROM mm GROUP BY 1""",
    "identity_by_name": f"""WITH {MSG}, le AS (SELECT self_uid, count(DISTINCT source_file) AS n, min(self_name) AS nm FROM chat_files WHERE self_uid IS NOT NULL
        GROUP BY 1 ORDER BY n DESC, self_uid LIMIT 5), fi AS (SELECT lower(nm) AS nm FROM le ORDER BY n DESC, self_uid LIMIT 1)
        SELECT row_id FROM msg WHERE u IN (SELECT self_uid FROM le) OR uin IN (SELECT self_uid FROM le) OR lower(name) IN (SELECT nm FROM fi) OR lower(nickname) IN (SELECT nm FROM fi)""",
    "turn_merge": f"""WITH {TURNS} SELECT source_file, turn_no, is_me, n_fragments, char_count, start_ms, end_ms, is_system, msg_type FROM turns""",
    "turn_texts": f"WITH {TURNS} SELECT source_file, turn_no, md5(text) AS text_md5 FROM turns",
    "session_split": f"""WITH {SESSIONS} SELECT source_file, session_no, count(*) AS n_turns, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM ses GROUP BY 1, 2""",
    "block_extract": f"WITH RECURSIVE {BLOCKS} SELECT source_file, session_id, block_id, first_turn, last_turn FROM blk",
    "block_metrics": f"""WITH RECURSIVE {BLOCKS} SELECT source_file, block_id, my_msg_count, my_char_count, total_char_count, my_turn_count, other_turn_count,
        interruption_count, interruption_chars, short_fragment_count FROM blk""",
    "block_texts": f"WITH RECURSIVE {BLOCKS} SELECT source_file, block_id, md5(my_text) AS text_md5, n_fragments FROM blk",
    "block_reject_reasons": f"""WITH RECURSIVE {BLOCKS}, rs AS (SELECT source_file, block_id, concat_ws('|',
          CASE WHEN my_char_count < {S.min_my_block_chars} THEN 'too_few_chars:' || my_char_count || '<{S.min_my_block_chars}' END,
          CASE WHEN my_msg_count < {S.min_my_msg_count} THEN 'too_few_msgs:' || my_msg_count || '<{S.min_my_msg_count}' END,
          CASE WHEN ratio < {S.min_my_char_ratio} THEN 'low_my_ratio:' || printf('%.2f', round(ratio, 2)) || '<{S.min_my_char_ratio}' END) AS reasons FROM why)
        SELECT * FROM rs WHERE reasons <> ''""",
    "block_context": f"""WITH RECURSIVE {BLOCKS} SELECT blk.source_file, block_id, count(*) AS n_context FROM blk JOIN ses ON ses.source_file = blk.source_file
        AND ses.session_no = blk.session_no AND turn_no BETWEEN first_turn - 3 AND last_turn + 3 GROUP BY 1, 2""",
    "block_numbers": f"""WITH RECURSIVE {BLOCKS}, nr AS (SELECT source_file, row_number() OVER (ORDER BY source_file) - 1 AS i FROM (SELECT DISTINCT source_file FROM msg))
        SELECT blk.source_file, printf('source_%04d_%s', i, block_id) AS block_id FROM blk JOIN nr USING (source_file)""",
    "pre_bucket_structural": f"""WITH {DOCS} SELECT doc_id, CASE WHEN c >= {S.good_my_block_chars} AND n >= 3 AND sr <= {S.max_short_fragment_ratio} THEN 'candidates'
        WHEN c >= {S.min_my_block_chars} THEN 'micro_style' WHEN c < 10 OR sr > 0.8 THEN 'rejected' ELSE 'need_anonymize' END AS bucket FROM dm""",
    "score_documents": f"WITH {SCORED} SELECT doc_id, style AS style_score, privacy AS privacy_score, junk AS junk_score, chaos AS chaos_score FROM sc",
    "score_messages": f"WITH {SCORED_MESSAGES} SELECT doc_id, style AS style_score, privacy AS privacy_score, junk AS junk_score, chaos AS chaos_score FROM sc",
    "classify_documents": f"WITH {_decided(S.debatable_max_per_run)} SELECT doc_id, bucket, reasons FROM dec",
    "debatable_cap": f"WITH {_decided(10)} SELECT doc_id, bucket FROM dec WHERE b0 = 'debatable'",
    "bucket_counts": f"""WITH {_decided(S.debatable_max_per_run)} SELECT b AS bucket, (SELECT count(*) FROM dec WHERE dec.bucket = v.b) AS n
        FROM (VALUES {", ".join(f"('{b}')" for b in BUCKETS)}) v(b)""",
    "top_reasons": f"""WITH {_decided(S.debatable_max_per_run)} SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN reasons LIKE 'rejected_fallback:%' THEN [reasons] ELSE string_split(reasons, '|') END) AS reason FROM dec)
        GROUP BY reason ORDER BY n DESC, reason LIMIT 20""",
    "tuning_ratios": f"""WITH {_decided(S.debatable_max_per_run)}, ct AS (SELECT b AS bucket, (SELECT count(*) FROM dec WHERE dec.bucket = v.b) AS n
        FROM (VALUES {", ".join(f"('{b}')" for b in BUCKETS)}) v(b)) SELECT bucket, n, round(n / (SELECT sum(n) FROM ct), 6) AS ratio FROM ct""",
    "style_tags": f"WITH {SCORED} SELECT doc_id, {_tags()} AS style_tags FROM sc",
    "privacy_strict": _MODE("privacy > 3", "rejected", "strict_privacy"),
    "privacy_recall": _MODE("privacy >= 5 AND privacy < 10 AND style >= 2", "need_anonymize", "recall_privacy"),
    "mask_words": _masked(),
    "drop_words": f"""WITH {LEX}, {DOCS}, dw AS (SELECT doc_id, arg_min(phrase, entry_no) AS w FROM doc JOIN lex ON kind = 'drop_sentence_words' AND contains(lower(t), lower(phrase)) GROUP BY doc_id)
        SELECT doc_id, 'dropped_by_sentence_word:' || w AS reasons FROM dw""",
    "exact_dedup_keep2": f"""WITH {DOCS}, k AS (SELECT doc_id, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS k FROM doc)
        SELECT doc_id, 'exact_duplicate:kept_2_already' AS reasons FROM k WHERE k > 2""",
    "near_dup_pairs": f"WITH {_CLASSES} SELECT a, b, round(similarity, 6) AS similarity FROM pr",
    "near_dup_classes": "SELECT doc_id, min(doc_id) OVER (PARTITION BY regexp_replace(coalesce(text, ''), '[\\s\\p{Z}\\x1c-\\x1f]+', '', 'g')) AS class_id FROM documents",
    "near_dup_greedy": f"""WITH RECURSIVE {_CLASSES},
        nd AS (SELECT id, row_number() OVER (ORDER BY id) AS i, (SELECT list(a) FROM pr WHERE b = id) AS nb FROM (SELECT a AS id FROM pr UNION SELECT b FROM pr)),
        go AS (SELECT CAST(0 AS BIGINT) AS i, [] :: BIGINT[] AS kept UNION ALL
          SELECT nd.i, CASE WHEN list_has_any(kept, coalesce(nb, [])) THEN kept ELSE list_append(kept, id) END FROM go JOIN nd ON nd.i = go.i + 1),
        fin AS (SELECT kept FROM go ORDER BY i DESC LIMIT 1),
        gone AS (SELECT b AS id, max(similarity) AS s FROM pr, fin WHERE list_contains(kept, a) AND NOT list_contains(kept, b) GROUP BY b)
        SELECT doc_id, round(coalesce(s, 1.0), 4) AS similarity FROM rep LEFT JOIN gone ON gone.id = rep.rep WHERE s IS NOT NULL OR doc_id <> rep.rep""",
    "stratified_sample": f"""WITH {_decided(S.debatable_max_per_run)},
        st AS (SELECT doc_id, t, substr(sha256(CASE WHEN source_file = '' THEN 'unknown-source' ELSE source_file END || chr(0) || 'session_00000' || chr(0) || t), 1, 24) AS review_id,
          unnest(list_filter([CASE WHEN bucket = 'candidates' AND style >= 8 THEN 'candidates_high_score' END, CASE WHEN bucket = 'candidates' AND style > 0 AND style < 8 THEN 'candidates_low_score' END,
            CASE WHEN bucket = 'rejected' AND style >= 4 THEN 'rejected_high_style_score' END, CASE WHEN bucket IN ('chaos_style', 'need_anonymize', 'debatable') THEN bucket END], lambda x: x IS NOT NULL)) AS stratum FROM dec),
        rk AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('{S.sample_seed}:' || review_id), review_id, t) AS k FROM st)
        SELECT stratum, review_id, count(*) AS n FROM rk WHERE k <= CASE WHEN stratum LIKE 'candidates%' THEN 10 ELSE 20 END GROUP BY 1, 2""",
    "review_ids": f"""WITH {DOCS} SELECT doc_id, substr(sha256(CASE WHEN source_file = '' THEN 'unknown-source' ELSE source_file END || chr(0) || 'session_00000' || chr(0) || t), 1, 24) AS review_id FROM doc""",
    "review_decisions": f"WITH {DECISIONS} SELECT kind, key, decision, reason FROM rd",
    "review_apply": f"""WITH {DOCS}, {DECISIONS}, k AS (SELECT doc_id, row_number() OVER (PARTITION BY t ORDER BY doc_id) > 1 AS dup FROM doc),
        j AS (SELECT doc_id, dup, decision FROM k LEFT JOIN (SELECT * FROM rd WHERE kind = 'block') b ON b.key = CAST(doc_id AS VARCHAR))
        SELECT doc_id, CASE WHEN dup OR decision = 'drop' THEN 'rejected' END AS bucket, coalesce(decision = 'keep', false) AND NOT dup AS manual_keep,
          concat_ws('|', CASE WHEN dup THEN 'exact_duplicate:kept_1_already' END, CASE WHEN decision = 'drop' THEN 'manual_review_drop'
            WHEN decision = 'keep' AND dup THEN 'manual_review_keep_blocked_by_prior_filter' WHEN decision = 'keep' THEN 'manual_review_keep_requested' END) AS reasons
        FROM j WHERE dup OR decision IS NOT NULL""",
    "ngram_freq": f"WITH {GRAMS} SELECT n, phrase, freq FROM cnt WHERE n >= 2",
    "ngram_bucket_freq": f"WITH {GRAMS} SELECT n, phrase, {', '.join(MINED_BUCKETS)} FROM cnt WHERE n >= 2",
    "ngram_pmi": f"WITH {LEAD} SELECT phrase, round(pmi, 4) AS pmi FROM inf",
    "ngram_entropy": f"WITH {LEAD} SELECT phrase, round(le, 4) AS left_entropy, round(re, 4) AS right_entropy FROM ent",
    "ngram_mined": f"WITH {MINED} SELECT phrase, n AS length, freq, suggested_label, suggested_action, reasons, round(round(kn, 2), 1) AS style_keyness FROM mined",
    "ngram_candidates": f"WITH {MINED} SELECT n AS length, rank, phrase FROM mined WHERE suggested_action IN ('review', 'manual_keep')",
    "review_lists": f"WITH {MINED}, rv AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS list, row_number() OVER (ORDER BY {by} DESC, n, rank) AS place, phrase FROM mined WHERE {c}" for n, c, by in _LISTS)
    + ") SELECT list, place, phrase FROM rv WHERE place <= 100",
    "auto_promote": f"""WITH {MINED} SELECT n AS length, rank, phrase FROM mined WHERE suggested_action IN ('review', 'manual_keep') AND round(kn, 2) >= 1.0 AND round(pmi, 2) >= 2.0
        AND round(me, 4) >= {PROMOTING.promote_min_entropy} AND freq >= {PROMOTING.promote_min_freq} AND round(cr, 4) <= {PROMOTING.promote_max_chaos_rate} AND round(pr, 4) <= {PROMOTING.promote_max_privacy_rate}
        AND phrase NOT IN (SELECT phrase FROM bank WHERE label IN ('analysis_marker', 'tone_marker')) ORDER BY n, rank LIMIT {PROMOTING.promote_max_per_run}""",
    "candidate_append": f"""WITH {MINED} SELECT phrase, n AS length FROM mined WHERE suggested_action IN ('review', 'manual_keep') AND phrase NOT IN (SELECT trim(phrase) FROM ngram_stats WHERE phrase IS NOT NULL)""",
    "phrase_links": f"""WITH {_links("SELECT DISTINCT trim(phrase) AS phrase FROM ngram_stats WHERE length(trim(phrase)) >= 2")} SELECT a, b, link FROM li WHERE link IS NOT NULL""",
    "phrase_clusters": f"""WITH RECURSIVE {MINED}, {_links("SELECT phrase FROM mined WHERE suggested_action IN ('review', 'manual_keep')")},
        lk AS (SELECT a, b, link FROM li WHERE link IS NOT NULL), un AS (SELECT a, b FROM lk UNION SELECT b, a FROM lk),
        re AS (SELECT a AS id, a AS r FROM un UNION SELECT un.b, re.r FROM re JOIN un ON un.a = re.id),
        ro AS (SELECT id, min(r) AS root FROM re GROUP BY id),
        ki AS (SELECT id, link FROM (SELECT a AS id, link FROM lk UNION SELECT b, link FROM lk))
        SELECT 'cluster_' || substr(sha256(string_agg(id, chr(0) ORDER BY id)), 1, 12) AS cluster_id, arg_min(id, (-freq, length(id), id)) AS canonical_phrase, count(*) AS size,
          (SELECT string_agg(DISTINCT link, '|' ORDER BY link) FROM ki JOIN ro r2 ON r2.id = ki.id WHERE r2.root = ro.root) AS link_types
        FROM ro JOIN mined ON mined.phrase = ro.id GROUP BY root""",
    "lexicon_lists": f"WITH {LEX} SELECT kind, phrase, label, severity, risk FROM lex",
    "manual_phrases": f"WITH {MANUAL} SELECT phrase, decision FROM mp",
    "stoplist_diagnostics": """WITH st AS (SELECT phrase FROM lexicon WHERE kind = 'phrase_stoplist' AND phrase <> ''), c AS (SELECT phrase, count(*) AS n FROM st GROUP BY phrase),
        lb AS (SELECT phrase, coalesce(arg_max(label, entry_no), 'unlabeled') AS label FROM lexicon WHERE kind = 'phrase_bank' AND phrase <> '' GROUP BY phrase), cf AS (SELECT * FROM c JOIN lb USING (phrase))
        SELECT 'total_entries' AS metric, '' AS item, coalesce(sum(n), 0) :: BIGINT AS value FROM c UNION ALL SELECT 'unique_entries', '', count(*) FROM c
        UNION ALL SELECT 'duplicate', phrase, n FROM c WHERE n > 1 UNION ALL SELECT 'conflict', phrase || ':' || label, 1 FROM cf
        UNION ALL SELECT 'conflict_category', label, count(*) FROM cf GROUP BY label
        UNION ALL SELECT 'length', CASE WHEN length(phrase) >= 5 THEN '5plus' ELSE CAST(length(phrase) AS VARCHAR) END, count(*) FROM st GROUP BY 2""",
    "archive_terms": f"WITH {TERMS} SELECT term, old_category, {_first_seen('cat')} AS all_categories, source_file, {_first_seen('lb')} AS labels FROM te x",
    "audit_terms": f"""WITH {AUDIT} SELECT term, old_category, freq_total, my_block_count, candidate_rate, rejected_rate, round(round(kn, 2), 1) AS style_keyness, suggested_status, reasons FROM aud""",
    "audit_summary": f"""WITH {AUDIT} {_SUMMARY} UNION ALL SELECT 'by_source_file', source_file, count(*) FROM aud GROUP BY 2 UNION ALL SELECT 'by_old_category', old_category, count(*) FROM aud GROUP BY 2""",
    "active_lexicon": f"""WITH {MINED}, {AUDIT},
        ca AS (SELECT {strip("phrase")} AS term, list({_CATEGORY}) AS cats FROM lexicon GROUP BY 1),
        en AS (SELECT l.kind, l.phrase, l.label, l.severity, l.risk, l.entry_no, a.*, cats,
            coalesce(suggested_status IN ('promote_to_active', 'keep_in_privacy_lexicon', 'keep_in_chaos_lexicon', 'keep_in_stoplist')
              OR (suggested_status = 'keep_as_candidate' AND freq_total >= 3 AND candidate_rate >= 0.15), false) AS up,
            coalesce(freq_total >= 3 AND candidate_rate >= 0.15, false) AS seen, coalesce(suggested_status IN ('keep_in_privacy_lexicon', 'promote_to_active'), false) AS po
          FROM lexicon l LEFT JOIN (SELECT aud.*, ax.good FROM aud JOIN ax USING (term)) a ON a.term = l.phrase LEFT JOIN ca ON ca.term = l.phrase),
        na AS (
          SELECT kind AS file, phrase, label, severity, risk, CASE WHEN kind = 'privacy_lexicon' AND NOT po THEN 'frequency_verified_low' ELSE 'frequency_verified' END AS source,
            'active_verified' AS status, CAST(entry_no AS HUGEINT) AS o FROM en
          WHERE CASE WHEN kind = 'phrase_bank' THEN up AND seen AND len(list_filter(cats, lambda c: starts_with(c, 'style_markers.'))) > 0
            WHEN kind IN ('chaos_lexicon', 'drop_sentence_words', 'mask_words') THEN up WHEN kind = 'privacy_lexicon' THEN po OR coalesce(freq_total >= 1, false)
            WHEN kind = 'phrase_stoplist' THEN coalesce(suggested_status = 'keep_in_stoplist' OR (freq_total >= 10 AND round(kn, 2) < 1.0), false)
            ELSE kind IN ('manual_keep', 'manual_drop') END
          UNION ALL SELECT 'chaos_lexicon', phrase, NULL, CASE WHEN round(cr, 4) > 0.8 THEN 'strong' ELSE 'mild' END, NULL, 'phrase_mining_auto', 'auto_candidate', 1e12 :: HUGEINT FROM mined WHERE round(cr, 4) > 0.5 AND freq >= 3
          UNION ALL SELECT 'privacy_lexicon', phrase, NULL, NULL, 'medium', 'phrase_mining_auto', 'auto_candidate', 1e12 :: HUGEINT FROM mined WHERE round(pr, 4) > 0.3 AND freq >= 3
          UNION ALL SELECT 'phrase_stoplist', phrase, NULL, NULL, NULL, 'phrase_mining_auto', 'auto_candidate', 1e12 :: HUGEINT FROM mined WHERE freq >= 10 AND round(pmi, 2) < 1.5 AND round(kn, 2) < 1.0
          UNION ALL SELECT 'phrase_candidates', phrase, NULL, NULL, NULL, 'phrase_mining_auto', 'auto_candidate', 1e12 :: HUGEINT FROM mined
            WHERE round(kn, 2) >= 2.0 AND freq >= 5 AND candidates / greatest(freq, 1) >= 0.15 AND round(pr, 4) <= 0.30 AND round(cr, 4) <= 0.50
          UNION ALL SELECT 'phrase_candidates', term, NULL, NULL, NULL, 'frequency_audit_demotion', 'demoted_from_archive', 2e12 :: HUGEINT FROM aud WHERE suggested_status = 'keep_as_candidate'
          UNION ALL SELECT 'lexicon_removed_or_demoted', term, NULL, NULL, NULL, source_file, 'demoted', 0 :: HUGEINT FROM aud WHERE suggested_status = 'demote_or_remove')
        SELECT file, phrase, label, severity, risk, source, status FROM (SELECT *, row_number() OVER (PARTITION BY file, phrase ORDER BY o DESC) AS k FROM na) WHERE k = 1""",
    "event_sessions": """WITH a AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
        b AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) <= 43200000 THEN 0 ELSE 1 END AS f FROM a),
        c AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS g FROM b)
        SELECT user_id, min(t) AS start_ms, max(t) AS end_ms, max(t) - min(t) AS duration_ms, count(*) AS events FROM c GROUP BY user_id, g""",
    "event_types_map": """SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS last_type, count(*) AS n FROM events GROUP BY user_id""",
}
