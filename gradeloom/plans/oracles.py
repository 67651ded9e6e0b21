"""The registered queries as SQL for another engine, written from their meaning.

Where the library works by ranges, ends or hashes, the SQL here sorts, numbers and
joins, so agreement of the two is evidence and not repetition.
"""

from __future__ import annotations

from gradeloom import fixed
from gradeloom.functions.whitespace import BLANKS, LINE_ENDS
from gradeloom.plans import inputs

NL = "chr(10)"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WS = quote(BLANKS)
_LE_CLASS = quote(f"[{LINE_ENDS}]")


def strip(text: str) -> str:
    return f"trim({text}, {_WS})"


def lines_of(text: str) -> str:
    parts = f"string_split_regex({text}, {_LE_CLASS})"
    return f"list_filter(list_transform({parts}, lambda l: {strip('l')}), lambda l: l <> '')"


def _boxes(text: str, flags: str = "") -> str:
    return f"regexp_extract_all({text}, '{flags}" + r"\\boxed\{([^}]*)\}'" + ", 1)"


def _heading(text: str) -> str:
    return f"nullif(regexp_extract({text}, {quote(f'答案[:：][{BLANKS}]*([^' + chr(10) + ']+)')}, 1), '')"


def _final(text: str) -> str:
    return f"nullif(regexp_extract({text}, {quote(f'(?i)final answer[:：]?[{BLANKS}]*([^' + chr(10) + ']+)')}, 1), '')"


def final_answer(text: str) -> str:
    caught = f"coalesce({_heading(text)}, {_final(text)})"
    return f"""CASE WHEN len({_boxes(text)}) > 0 THEN {strip(f"list_extract({_boxes(text)}, -1)")}
        WHEN {caught} IS NOT NULL THEN coalesce(list_extract({lines_of(caught)}, 1), '')
        ELSE coalesce(trim(list_extract({lines_of(text)}, -1), '。.'), '') END"""


def source_answer(text: str) -> str:
    boxes = _boxes(text, "(?i)")
    caught = f"coalesce({_heading(text)}, {_final(text)})"
    return f"""CASE WHEN len({boxes}) > 0 THEN trim({strip(f"list_extract({boxes}, 1)")}, '。.')
        WHEN {caught} IS NOT NULL THEN trim({strip(caught)}, '。.')
        ELSE coalesce(list_extract({lines_of(text)}, -1), '') END"""


def normal_form(text: str) -> str:
    bare = text
    for mark in ("$", "\\(", "\\[", "\\)", "\\]"):
        bare = f"replace({bare}, '{mark}', '')"
    plain = f"regexp_replace(replace({bare}, ',', ''), {quote(f'[{BLANKS}]')}, '', 'g')"
    return f"lower(trim(replace(replace({plain}, '−', '-'), '．', '.'), '。.'))"


def number(normal: str) -> str:
    """Number of a normal form, for digits that are ASCII or full-width."""
    narrow = f"translate({normal}, '０１２３４５６７８９', '0123456789')"
    bare = f"replace({narrow}, '_', '')"
    decimal = r"'[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|[+-]?inf(inity)?|[+-]?nan'"
    ratio = r"'[+-]?[0-9]+/[0-9]+'"
    top, bottom = f"split_part({narrow}, '/', 1)", f"split_part({narrow}, '/', 2)"
    return f"""CASE WHEN regexp_full_match({bare}, {decimal}) THEN TRY_CAST(regexp_replace({bare}, '^[+]', '') AS DOUBLE)
        WHEN regexp_full_match({narrow}, {ratio}) AND CAST({bottom} AS DOUBLE) <> 0
        THEN CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE) END"""


def matches(predicted: str, target: str, source: str, keep: str) -> str:
    """Query with ``matches`` (0/1) for two columns of ``source``."""
    return f"""SELECT {keep}, CASE WHEN p = t THEN 1
            WHEN pn IS NULL OR tn IS NULL OR isnan(pn) OR isnan(tn) THEN 0
            WHEN pn = tn THEN 1
            WHEN isinf(pn) OR isinf(tn) THEN 0
            WHEN abs(pn - tn) <= 1e-6::DOUBLE OR abs(pn - tn) <= 1e-6::DOUBLE * abs(pn)
              OR abs(pn - tn) <= 1e-6::DOUBLE * abs(tn) THEN 1 ELSE 0 END AS matches
        FROM (SELECT *, {number("p2")} AS pn, {number("t2")} AS tn
          FROM (SELECT *, {normal_form("p")} AS p2, {normal_form("t")} AS t2
            FROM (SELECT *, {normal_form(predicted)} AS p, {normal_form(target)} AS t FROM {source})))"""


def tutor(solution: str, answer: str) -> str:
    lines = lines_of(solution)
    shown = f"coalesce(nullif({answer}, ''), nullif({source_answer(solution)}, ''), '{fixed.PENDING_ANSWER}')"
    return f"""concat({quote(fixed.TUTOR_OVERVIEW + fixed.TUTOR_THOUGHT_HEADING)},
        coalesce(list_extract({lines}, 1), {quote(fixed.DEFAULT_THOUGHT)}),
        {quote(chr(10) * 2 + fixed.TUTOR_STEPS_HEADING)},
        coalesce(nullif(array_to_string({lines}, {NL}), ''), {quote(fixed.DEFAULT_STEPS)}),
        {quote(chr(10) * 2 + fixed.TUTOR_ANSWER_HEADING)}, {shown},
        {quote(chr(10) * 2 + fixed.TUTOR_SUMMARY)})"""


def words(text: str) -> str:
    pieces = f"string_split_regex({text}, {quote(f'[{BLANKS}]+')})"
    return f"len(list_filter({pieces}, lambda w: w <> ''))"


def derived(source: str, expressions: dict[str, str], *keep: str) -> str:
    columns = [*keep, *[f"{text} AS {name}" for name, text in expressions.items()]]
    return f"(SELECT {', '.join(columns)} FROM {source})"


LINES = derived("lineitem", inputs.LINES)
COMPLETIONS = derived(LINES, inputs.COMPLETIONS)
FORMS = derived(LINES, inputs.ANSWER_FORMS)
SCORED = derived("events", inputs.SCORED_RESPONSES)
LOG = derived("events", inputs.METRICS_LOG)
TALKS = """(SELECT ord, text AS question, next_text AS solution
    FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ord, lead(text) OVER w AS next_text, lead(role) OVER w AS next_role
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    WHERE role = 'user' AND next_role = 'assistant')"""
REQUESTS = """(SELECT doc_id, text, lang, value AS latency_sec
    FROM events LEFT JOIN documents ON event_id = doc_id)"""

KEY = "l_orderkey, l_linenumber"


def section_share(text: str, names: tuple[str, ...]) -> str:
    hits = " + ".join(f"CAST(contains({text}, '{n}') AS INT)" for n in dict.fromkeys(names))
    return f"(({hits}) / {len(names)}::DOUBLE)"


_FORMAT = section_share("response", fixed.REQUIRED_SECTIONS)
_MATCHED = f"({matches('predicted_answer', 'gold', f'(SELECT *, {final_answer('response')} AS predicted_answer FROM {COMPLETIONS})', '*')})"
_PARTS = f"""(SELECT *, CASE WHEN gold <> '' THEN matches ELSE 0 END::DOUBLE AS c, {_FORMAT} AS f,
    ((length(prompt) + 2 * length(response)) % 10) / 10::DOUBLE AS m FROM {_MATCHED})"""

# Three tables side by side, each numbered in its own order.
_RESPONSES = f"(SELECT row_number() OVER (ORDER BY event_id DESC) - 1 AS position, response FROM {derived('events', inputs.ZIPPED_RESPONSES, 'event_id')})"
_ANSWERS = f"(SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, answer FROM {derived('orders', inputs.ZIPPED_ANSWERS, 'o_orderkey')})"
_ZIPPED_TWO = f"(SELECT *, {final_answer('response')} AS predicted_answer FROM {_RESPONSES} JOIN {_ANSWERS} USING (position))"
_ZIPPED = f"""(SELECT * FROM {_ZIPPED_TWO} JOIN
    (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, concat(lang, ' ', source) AS prompt FROM documents) USING (position))"""

# Reward records, one shape at a time.
_ITEMS = " UNION ALL ".join(
    f"SELECT event_id, event_type, {i} AS pos, {strip(text)} AS item_text, coalesce({score}, 0) AS item_score FROM events"
    for i, (text, score) in enumerate(inputs.PREFERENCE_ITEMS)
)
_ENDS = f"""(SELECT b.event_id AS item_event, b.event_type AS item_type, b.item_text AS best, b.item_score AS best_score,
        w.item_text AS worst, w.item_score AS worst_score
    FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY item_score DESC, pos) AS r,
        count(*) OVER (PARTITION BY event_id) AS n FROM ({_ITEMS}) WHERE item_text <> '') w
    JOIN (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY item_score DESC, pos) AS r FROM ({_ITEMS})
        WHERE item_text <> '') b
    ON b.event_id = w.event_id AND b.r = 1 AND w.r = w.n AND w.n >= 2)"""
_RAW_PREFERENCES = derived("events", inputs.PREFERENCE_FIELDS, "event_id", "event_type")
RECORDS = f"""(SELECT ord, picked AS prompt,
        CASE shape WHEN 'pair' THEN {strip('chosen')} WHEN 'list' THEN best ELSE {strip('response')} END AS chosen,
        CASE shape WHEN 'pair' THEN {strip('rejected')} WHEN 'list' THEN worst ELSE '' END AS rejected,
        coalesce({strip('answer')}, '') AS answer,
        CASE shape WHEN 'list' THEN best_score WHEN 'single' THEN given END::DOUBLE AS score_chosen,
        CASE shape WHEN 'list' THEN worst_score END::DOUBLE AS score_rejected,
        'mixed' AS source
    FROM (SELECT *, CASE WHEN chosen IS NOT NULL AND rejected IS NOT NULL THEN 'pair'
          WHEN event_type = 'view' THEN 'list'
          WHEN picked <> '' AND response <> '' AND given IS NOT NULL THEN 'single' END AS shape
        FROM (SELECT *, coalesce(nullif({strip('prompt')}, ''), {strip('question')}) AS picked,
            coalesce(score, rating) AS given FROM {_RAW_PREFERENCES}) raw
        LEFT JOIN {_ENDS} ends ON item_event = ord)
    WHERE shape IS NOT NULL)"""


def ranked_pairs(records: str, default_source: str = fixed.DEFAULT_PAIR_SOURCE) -> str:
    return f"""SELECT f.first_ord AS ord, b.prompt, b.chosen, w.chosen AS rejected,
            CASE WHEN b.answer <> '' THEN b.answer ELSE w.answer END AS answer,
            b.score_chosen, w.score_chosen AS score_rejected, coalesce(b.source, '{default_source}') AS source
        FROM (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY score_chosen DESC, ord) AS r
            FROM {records} WHERE score_chosen IS NOT NULL) b
        JOIN (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY score_chosen, ord DESC) AS r,
            count(*) OVER (PARTITION BY prompt) AS n
            FROM {records} WHERE score_chosen IS NOT NULL) w ON b.prompt = w.prompt AND b.r = 1 AND w.r = 1 AND w.n >= 2
        JOIN (SELECT prompt, min(ord) AS first_ord FROM {records} GROUP BY prompt) f ON f.prompt = b.prompt"""


def latest(metric: str) -> str:
    if metric not in inputs.METRICS_LOG:
        return "NULL::DOUBLE"
    return f"arg_max({metric}, ord) FILTER (WHERE {metric} IS NOT NULL)::DOUBLE"


LATEST = f"""SELECT run, {', '.join(f'{latest(m)} AS {m}' for m in fixed.SUMMARY_METRICS)}
    FROM {LOG} WHERE step IS NOT NULL GROUP BY run"""
COMPARED = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{m}' AS metric,
        (SELECT {m} FROM latest WHERE run = 'click') AS run_a, (SELECT {m} FROM latest WHERE run = 'view') AS run_b"""
    for i, m in enumerate(fixed.SUMMARY_METRICS)
)
COMPARED = f"WITH latest AS ({LATEST}) SELECT * FROM ({COMPARED}) WHERE run_a IS NOT NULL OR run_b IS NOT NULL"


def summary(rows: str, by: str, tags: str, threshold: float = 1.0) -> str:
    return f"""SELECT {tags} count(*) AS samples, round(coalesce(avg(matches), 0), 6) AS final_answer_accuracy,
        round(coalesce(avg(CAST({_FORMAT} >= {threshold} AS INT)), 0), 6) AS format_pass_rate FROM {rows} {by}"""


def latency(source: str, tags: str = "", by: str = "") -> str:
    return f"""SELECT {tags} count(*) AS repeats, round(avg(latency_sec), 6) AS avg_latency_sec,
        round(median(latency_sec), 6) AS p50_latency_sec,
        round(CASE WHEN avg(latency_sec) <> 0 THEN avg({words('text')}) / avg(latency_sec) ELSE 0 END, 6)
          AS approx_tokens_per_sec
        FROM {source} {by}"""


def curve(metric: str, run: str) -> str:
    return f"arg_max({metric}, ord) FILTER (WHERE run = '{run}' AND {metric} IS NOT NULL)"


_TALK_ANSWER = source_answer("strip_solution")
UNIFIED = f"""(SELECT ord, {strip('question')} AS prompt, {tutor('worked', 'answer')} AS response, answer
    FROM (SELECT *, CASE WHEN strip_solution <> '' THEN strip_solution ELSE answer END AS worked
        FROM (SELECT *, {_TALK_ANSWER} AS answer
            FROM (SELECT *, {strip('solution')} AS strip_solution FROM {TALKS}))))"""
_SYSTEM = "你是数学老师。"
_RL_DOCS = f"concat({quote(fixed.RL_PROMPT_LEAD)}, {strip('text')})"

ORACLES: dict[str, str] = {
    "extract_final_answer": f"SELECT {KEY}, {final_answer('response')} AS predicted FROM {COMPLETIONS}",
    "extract_final_answer_documents": f"SELECT doc_id, {final_answer('text')} AS predicted FROM documents",
    "extract_source_answer": f"SELECT {KEY}, {source_answer('response')} AS answer FROM {COMPLETIONS}",
    "extract_source_answer_pages": f"SELECT page_id, {source_answer('html')} AS answer FROM pages",
    "normalize_answer": f"SELECT {KEY}, {normal_form('form')} AS normalized FROM {FORMS}",
    "normalize_answer_documents": f"SELECT doc_id, {normal_form('text')} AS normalized FROM documents",
    "to_number": f"""SELECT {KEY}, CASE WHEN n IS NULL THEN 'none' WHEN isnan(n) THEN 'nan' WHEN NOT isinf(n) THEN 'finite'
        WHEN n > 0 THEN 'inf' ELSE '-inf' END AS kind,
        CASE WHEN isfinite(n) THEN n END AS number
        FROM (SELECT {KEY}, {number('f')} AS n FROM (SELECT {KEY}, {normal_form('form')} AS f FROM {FORMS}))""",
    "answers_match": matches("form", "target", FORMS, KEY),
    "exact_match": f"SELECT {KEY}, matches::DOUBLE AS exact_match FROM {_MATCHED}",
    "section_flags": f"""SELECT {KEY}, {', '.join(
        f"CAST(contains(response, '{n}') AS INT) AS has_{i}" for i, n in enumerate(fixed.REQUIRED_SECTIONS))}
        FROM {COMPLETIONS}""",
    "format_reward": f"""SELECT {KEY}, round({_FORMAT}, 6) AS standard, round({_FORMAT}, 6) AS no_sections,
        round({section_share('response', ('思路', '思路', '答案', 'boxed'))}, 6) AS own_sections FROM {COMPLETIONS}""",
    "format_threshold": f"""SELECT {KEY}, CAST({_FORMAT} >= 1.0 AS INT) AS passes,
        CAST({_FORMAT} >= 0.3 AS INT) AS passes_low FROM {COMPLETIONS}""",
    "score_completions": f"""SELECT {KEY}, predicted_answer, c AS correctness_reward, 0.0::DOUBLE AS rlaif_reward,
        round(f, 6) AS format_reward,
        round(0.5::DOUBLE * c + 0.3::DOUBLE * 0 + 0.2::DOUBLE * f, 6) AS combined_reward FROM {_PARTS}""",
    "reward_values": f"""SELECT {KEY}, round(1.0::DOUBLE * matches + 0.5::DOUBLE * f, 6) AS reward
        FROM (SELECT *, {_FORMAT} AS f FROM ({matches('p0', 't0',
            f"(SELECT *, {final_answer('response')} AS p0, '17' AS t0 FROM {COMPLETIONS})", '*')}))""",
    "scorer_text": f"SELECT {KEY}, concat('问题：', prompt, {NL}, {NL}, '回答：', response) AS text FROM {COMPLETIONS}",
    "model_scores": f"""SELECT {KEY}, round(m, 6) AS rlaif_reward,
        round(0.5::DOUBLE * c + 0.3::DOUBLE * m + 0.2::DOUBLE * f, 6) AS combined_reward FROM {_PARTS}""",
    "row_scorer": f"""SELECT {KEY}, round(m, 6) AS rlaif_reward FROM {_PARTS}""",
    "generated_completions": f"""SELECT doc_id, source AS question, '' AS reference,
        concat('思路：a', {NL}, '答案：', length({_RL_DOCS})) AS prediction,
        CAST(length({_RL_DOCS}) AS VARCHAR) AS predicted_answer FROM documents""",
    "chat_template": f"""SELECT ord, concat({quote('[system]' + fixed.TRAINING_SYSTEM_PROMPT)}, '[user]', question,
        '[assistant]', solution) AS text FROM {TALKS}""",
    "completion_text": f"""SELECT {KEY}, response AS plain, response AS one,
        CASE WHEN response = '' THEN prompt ELSE concat(response, {NL}, prompt) END AS many,
        CAST(l_linenumber AS VARCHAR) AS number FROM {COMPLETIONS}""",
    "eval_rows": f"""SELECT {KEY}, prompt AS question, gold AS reference, response AS prediction,
        {final_answer('response')} AS predicted_answer FROM {COMPLETIONS}""",
    "eval_summary": summary(_MATCHED, "GROUP BY l_returnflag", "'lines' AS dataset, l_returnflag AS split,"),
    "eval_summary_total": summary(_MATCHED, "", "", 0.3),
    "summary_file": summary(_MATCHED, "", "'lines' AS dataset, 'all' AS split,"),
    "join_predictions": matches(
        "predicted_answer", "reference",
        """(SELECT d.doc_id, source AS question, CAST(quality AS VARCHAR) AS reference, CAST(n_chars % 2 AS VARCHAR)
            AS predicted_answer FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""",
        "doc_id, question, reference, predicted_answer",
    ).replace("END AS matches", "END::DOUBLE AS exact_match"),
    "clean_lines": f"""SELECT doc_id, len(ls)::INT AS n_lines, array_to_string(ls, {NL}) AS joined
        FROM (SELECT doc_id, {lines_of('text')} AS ls FROM documents)""",
    "word_count": f"SELECT doc_id, {words('text')}::INT AS words FROM documents",
    "tutor_response": f"""SELECT doc_id, {tutor('text', 'answer')} AS response
        FROM (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS answer FROM documents)""",
    "rl_prompts": f"""SELECT doc_id AS ord, {_RL_DOCS} AS prompt, {strip('lang')} AS answer,
        'answer,problem,question,target' AS raw_keys FROM documents""",
    "user_prompts": f"""SELECT doc_id, concat({quote(fixed.USER_PROMPT_LEAD)}, {strip('text')}) AS prompt,
        concat({quote(fixed.TUTOR_SYSTEM_PROMPT)}, {NL}, {NL}, {quote(fixed.USER_PROMPT_LEAD)}, {strip('text')})
          AS full_prompt FROM documents""",
    "sft_unified": f"SELECT *, 'talks' AS source, 'question,solution' AS raw_keys FROM {UNIFIED}",
    "pick_first": f"""SELECT ord, coalesce(nullif({strip('prompt')}, ''), {strip('question')}) AS picked,
        'none' AS not_text FROM {_RAW_PREFERENCES}""",
    "sft_chat": f"""SELECT ord, 0 AS position, 'system' AS role, '{_SYSTEM}' AS content FROM {UNIFIED}
        UNION ALL SELECT ord, 1, 'user', prompt FROM {UNIFIED}
        UNION ALL SELECT ord, 2, 'assistant', response FROM {UNIFIED}""",
    "sft_text": f"""SELECT ord, concat('<|system|>', {NL}, {quote(fixed.TRAINING_SYSTEM_PROMPT)}, {NL}, '<|user|>', {NL},
        question, {NL}, '<|assistant|>', {NL}, solution) AS text FROM {TALKS}""",
    "flatten_chat": f"""SELECT conv_id, string_agg(concat(upper(role), ':', {NL}, text), {quote(chr(10) * 2)} ORDER BY turn)
        || {quote(chr(10) * 2 + 'ASSISTANT:' + chr(10))} AS prompt FROM conversations GROUP BY conv_id""",
    "flatten_messages": f"""SELECT ord, concat('SYSTEM:', {NL}, {quote(fixed.TRAINING_SYSTEM_PROMPT)}, {NL}, {NL}, 'USER:', {NL},
        question, {NL}, {NL}, 'ASSISTANT:', {NL}, solution, {NL}, {NL}, 'ASSISTANT:', {NL}) AS prompt FROM {TALKS}""",
    "reward_records": f"SELECT * FROM {RECORDS}",
    "score_fallback": f"SELECT ord, coalesce(score, rating)::DOUBLE AS score FROM {_RAW_PREFERENCES}",
    "completions_array_pair": f"""SELECT item_event AS ord, item_type AS prompt, best AS chosen, worst AS rejected,
        best_score::DOUBLE AS score_chosen, worst_score::DOUBLE AS score_rejected FROM {_ENDS}""",
    "pairs_from_scores": ranked_pairs(SCORED),
    "stream_pairs": ranked_pairs(SCORED),
    "rank_responses": f"""SELECT ord, prompt, score_chosen,
        row_number() OVER (PARTITION BY prompt ORDER BY score_chosen DESC, ord) AS rank
        FROM {SCORED} WHERE score_chosen IS NOT NULL""",
    "reward_mode_switch": f"WITH records AS (SELECT * FROM {RECORDS}) {ranked_pairs('records')}",
    "reward_complete_pairs": f"""SELECT doc_id AS ord, {strip('source')} AS prompt, {strip('text')} AS chosen,
        {strip('lang')} AS rejected, '' AS answer, NULL::DOUBLE AS score_chosen, NULL::DOUBLE AS score_rejected,
        'docs' AS source FROM documents""",
    "reward_per_row": f"""WITH records AS (SELECT * FROM {RECORDS}), open_records AS (SELECT * FROM records WHERE rejected = '')
        SELECT * FROM records WHERE rejected <> '' UNION ALL BY NAME ({ranked_pairs('open_records')})""",
    "latest_metric": LATEST,
    "append_log": LATEST,
    "stream_latest_metrics": LATEST,
    "last_known_metric": f"""SELECT run, ord,
        last_value(mean_reward IGNORE NULLS) OVER w AS last_mean_reward,
        last_value(tokens_per_sec IGNORE NULLS) OVER w AS last_tokens_per_sec
        FROM {LOG} WHERE step IS NOT NULL
        WINDOW w AS (PARTITION BY run ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "compare_runs": COMPARED,
    "report_lines": f"""SELECT CAST(position + 6 AS INT) AS position, concat('| ', metric, ' | ',
            coalesce(CAST(run_a AS VARCHAR), 'N/A'), ' | ', coalesce(CAST(run_b AS VARCHAR), 'N/A'), ' |') AS line
        FROM ({COMPARED})
        UNION ALL VALUES (0, '# click vs view Report'), (1, ''), (2, '## Summary'), (3, ''),
            (4, '| Metric | click | view |'), (5, '| --- | ---: | ---: |')""",
    "curves": f"""SELECT step, {curve('mean_reward', 'click')} AS mean_reward_a, {curve('mean_reward', 'view')} AS mean_reward_b,
        {curve('tokens_per_sec', 'click')} AS tokens_per_sec_a, {curve('tokens_per_sec', 'view')} AS tokens_per_sec_b
        FROM {LOG} WHERE step IS NOT NULL AND run IN ('click', 'view') GROUP BY step""",
    "curve_points": f"SELECT run, step, ord, mean_reward AS value FROM {LOG} WHERE step IS NOT NULL",
    "reward_means": f"""SELECT l_returnflag AS run, l_linenumber AS step,
        round(avg(0.5::DOUBLE * c + 0.2::DOUBLE * f), 6) AS mean_reward, round(avg(c), 6) AS mean_correctness_reward,
        0.0::DOUBLE AS mean_rlaif_reward, round(avg(f), 6) AS mean_format_reward FROM {_PARTS} GROUP BY ALL""",
    "group_advantage": f"""SELECT {KEY}, prompt, round(mu, 6) AS group_mean, round((r - mu) / (sd + 1e-4::DOUBLE), 4) AS advantage
        FROM (SELECT *, avg(r) OVER (PARTITION BY prompt) AS mu, stddev_pop(r) OVER (PARTITION BY prompt) AS sd
        FROM (SELECT *, 0.5::DOUBLE * c + 0.2::DOUBLE * f AS r FROM {_PARTS}))""",
    "prompt_difficulty": f"""SELECT prompt, count(*) AS completions, round(1 - avg(c), 6) AS difficulty FROM {_PARTS} GROUP BY prompt""",
    # Strata in the order in which they fill up; what rounding leaves goes to the last open ones.
    "harder_subset": f"""WITH prompts AS (
            SELECT concat(prompt, ' ', l_returnflag) AS prompt, 1 - avg(c) AS difficulty FROM {_PARTS} GROUP BY ALL
        ), placed AS (
            SELECT *, CASE WHEN difficulty > 0.6::DOUBLE THEN 3 WHEN difficulty > 0.5::DOUBLE THEN 2 WHEN difficulty > 0.4::DOUBLE THEN 1 ELSE 0 END AS stratum,
                row_number() OVER (PARTITION BY stratum ORDER BY CAST('0x' || substr(md5('harder:' || prompt), 1, 15) AS BIGINT), prompt) AS place FROM prompts
        ), sizes AS (
            SELECT stratum, stratum + 1 AS w, count(*) AS size FROM placed GROUP BY ALL
        ), filling AS (
            SELECT *, sum(size) OVER f - size AS before, (SELECT sum(w) FROM sizes) - sum(w) OVER f + w AS open_w,
                least((SELECT count(*) FROM part), (SELECT sum(size) FROM sizes)) AS n
            FROM sizes WINDOW f AS (ORDER BY size / w, stratum)
        ), judged AS (
            SELECT *, (n - before) * w >= size * open_w AS whole FROM filling
        ), shared AS (
            SELECT *, n - (SELECT coalesce(sum(size), 0) FROM judged WHERE whole) AS rest,
                (SELECT sum(w) FROM judged WHERE NOT whole) AS weight FROM judged
        ), floored AS (
            SELECT *, CASE WHEN whole THEN size ELSE rest * w // weight END AS part,
                CASE WHEN whole THEN 0 ELSE row_number() OVER (PARTITION BY whole ORDER BY stratum DESC) END AS turn FROM shared
        ), quotas AS (
            SELECT stratum, part + CASE WHEN turn > 0 AND turn <= n - sum(part) OVER () THEN 1 ELSE 0 END AS quota FROM floored
        )
        SELECT prompt, CAST(stratum AS INT) AS stratum, round(difficulty, 6) AS difficulty FROM placed JOIN quotas USING (stratum) WHERE place <= quota""",
    "zip_scores": f"""SELECT position, prompt, answer, predicted_answer, c AS correctness_reward, round(0.5::DOUBLE * c + 0.2::DOUBLE * f, 6) AS combined_reward
        FROM (SELECT *, CASE WHEN answer IS NOT NULL AND matches = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS c, {_FORMAT} AS f
        FROM ({matches("predicted_answer", "coalesce(answer, '')", _ZIPPED, "position, prompt, answer, response, predicted_answer")}))""",
    "zip_accuracy": f"""SELECT count(*) AS samples, round(avg(matches), 6) AS final_answer_accuracy
        FROM ({matches("predicted_answer", "coalesce(answer, '')", _ZIPPED_TWO, "position")})""",
    "zip_report": """WITH t AS (SELECT 'prompt' AS "table", count(*) AS rows FROM documents UNION ALL SELECT 'response', count(*) FROM events
            UNION ALL SELECT 'answer', count(*) FROM orders)
        SELECT "table", rows, (SELECT min(rows) FROM t) AS paired, rows - (SELECT min(rows) FROM t) AS unpaired FROM t""",
    "latency_summary": latency(REQUESTS),
    "latency_by_language": latency(REQUESTS, "lang,", "GROUP BY lang"),
    "latency_events": latency(
        "(SELECT event_type, value AS latency_sec, props AS text FROM events)", "event_type,", "GROUP BY event_type"
    ),
    "safe_rate": f"""SELECT {KEY}, CASE WHEN l_quantity - 25 > 0 THEN l_extendedprice / (l_quantity - 25) ELSE 0 END AS rate
        FROM lineitem""",
    "prefix_limit": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 4000",
    "eval_sample": "SELECT doc_id AS ord, text FROM documents ORDER BY doc_id LIMIT 200",
    "split_slice": "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 500 OFFSET 200",
    "calibration_sample": f"SELECT {_RL_DOCS} AS prompt FROM documents ORDER BY doc_id LIMIT 128",
    "input_ordinal": """SELECT doc_id, lang, row_number() OVER (ORDER BY lang DESC, doc_id) - 1 AS ord FROM documents""",
    "registry_upsert": """WITH nations AS (SELECT n_name AS name, n_regionkey AS region FROM nation)
        SELECT name, region FROM nations c WHERE region < 3
          AND NOT EXISTS (SELECT 1 FROM nations n WHERE n.region > 1 AND n.name = c.name)
        UNION ALL SELECT name, region + 100 FROM nations WHERE region > 1""",
    "unified_sources": f"""SELECT ord, prompt, answer, response, 'talks' AS source FROM {UNIFIED}
        UNION ALL SELECT doc_id, {strip('source')}, {strip('lang')},
        {tutor(strip('text'), strip('lang'))}, 'docs' FROM documents""",
    "hash_split": """SELECT doc_id,
        CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 200 AS INT) AS validation
        FROM documents""",
    "jsonl_round_trip": f"SELECT ord, question, answer, chosen, rating FROM {_RAW_PREFERENCES}",
    "ragged_jsonl": f"""SELECT ord, concat({quote(fixed.RL_PROMPT_LEAD)},
        {strip('question')}) AS prompt,
        coalesce({strip('answer')}, '') AS answer,
        array_to_string(list_filter(['answer', 'chosen', 'ord', 'prompt', 'question', 'rating'], lambda k:
          NOT (k = 'answer' AND answer IS NULL) AND NOT (k = 'chosen' AND chosen IS NULL)
          AND NOT (k = 'rating' AND rating IS NULL)), ',') AS raw_keys FROM {_RAW_PREFERENCES}""",
    "ragged_rewards": """WITH e AS (SELECT event_id, concat('user ', user_id) AS prompt, event_id % 4 AS kind,
            floor(value) AS s1, (user_id % 6)::DOUBLE AS s2, (user_id % 10)::DOUBLE AS given FROM events),
        b AS (SELECT *, greatest(s1, s2, 0) AS high, least(s1, s2, 0) AS low FROM e)
        SELECT 9007199254740992 + event_id AS ord, prompt,
          CASE kind WHEN 0 THEN CASE WHEN s1 = high THEN 'a' || event_id WHEN s2 = high THEN 'b' ELSE 'c' END
            WHEN 2 THEN 'two' ELSE 'three' END AS chosen,
          CASE WHEN kind > 0 THEN '' WHEN low = 0 THEN 'c' WHEN s2 = low THEN 'b' ELSE 'a' || event_id END AS rejected,
          CASE kind WHEN 3 THEN 'x' ELSE '' END AS answer,
          CASE kind WHEN 0 THEN high WHEN 2 THEN given ELSE s1 + 0.5 END::DOUBLE AS score_chosen,
          CASE kind WHEN 0 THEN low END::DOUBLE AS score_rejected, 'ragged' AS source
        FROM b WHERE kind <> 1""",
    "records_source": """SELECT event_type, weight, ord, events
        FROM (VALUES ('view', 0::BIGINT, 0::BIGINT), ('click', 1, 1), ('absent', 2, 2)) r(event_type, weight, ord)
        LEFT JOIN (SELECT event_type, count(*) AS events FROM events GROUP BY event_type) c USING (event_type)""",
    "registry_entries": """WITH last AS (SELECT source, arg_max(doc_id, doc_id) AS doc_id FROM documents WHERE doc_id % 3 = 0 AND source < 'src5' GROUP BY source)
        SELECT DISTINCT d.source || '_train' AS name, CASE WHEN l.doc_id IS NULL THEN d.source || '.jsonl' ELSE d.source || '_' || l.doc_id END AS file_name,
        CASE WHEN l.doc_id IS NULL THEN 'sharegpt' ELSE 'alpaca' END AS formatting, CAST(l.doc_id IS NOT NULL AS INT) AS ranking
        FROM documents d LEFT JOIN last l ON d.source = l.source""",
    "invalid_lines": f"""SELECT line, 1 AS numbered FROM (SELECT event_id, {inputs.MIXED_LINES} AS line FROM events)
        WHERE event_id % 23 IN (0, 1, 3)""",
    "export_in_order": f"SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, prompt, chosen, rejected FROM ({ranked_pairs(SCORED)})",
    "reuse_or_build": f"""SELECT doc_id AS ord, concat({quote(fixed.RL_PROMPT_LEAD)}, {strip('source')}) AS prompt,
        {strip('lang')} AS answer, 'docs' AS source FROM documents""",
    "csv_round_trip": f"SELECT run, ord, step, mean_reward FROM {LOG}",
    "export_chat": f"""SELECT 'system|user|assistant' AS roles, concat('{_SYSTEM}', '|', prompt, '|', response) AS contents,
        answer, 'talks' AS source FROM {UNIFIED}""",
    "export_preference": f"""SELECT prompt, chosen, rejected, answer, '{{"source":"' || source || '"}}' AS metadata FROM ({ranked_pairs(SCORED)})""",
    "export_instruction": f"""SELECT {_RL_DOCS} AS instruction, '' AS input, '' AS output, {strip('lang')} AS answer,
        'docs' AS source FROM documents""",
    "json_codec": """SELECT event_id, k, '{"k":' || k || ',"absent":null}' AS encoded
        FROM (SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) AS k FROM events)""",
    "stream_scores": f"""SELECT {KEY}, predicted_answer,
        round(0.5::DOUBLE * c + 0.2::DOUBLE * f, 6) AS combined_reward FROM {_PARTS}""",
}

ORACLES["report_file"] = f"""SELECT CAST(row_number() OVER (ORDER BY position) - 1 AS INT) AS position, line
    FROM ({ORACLES["report_lines"]})"""
ORACLES["compare_job_curves"] = ORACLES["curves"]
