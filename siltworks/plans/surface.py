"""Further core queries: functions and operators one by one, and the SQL of rules that takes more than an expression."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import runtime, schema
from siltworks.functions import rules, text
from siltworks.functions.regex import SPACE
from siltworks.operators import clean, decontaminate, dedup, evaluate, inference, relational
from siltworks.operators.clean import col
from siltworks.plans import runner, sqltext as q
from siltworks.plans.catalog import _CHAIN, _CLEANED, _GRAMS, _N, _V, ORACLES, PIPELINE, ROUTED, _tier_lists, query, records
from siltworks.sources import readers, writers
from siltworks.streaming import streams

_Q, _A = "question", "raw_dataset_answer"
_NORMAL_Q = q.normal(_Q)


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- functions of texts ----

_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))


def _half(c: str) -> str:
    return f"translate({c}, {_literal(chr(0x3000) + _WIDE)}, {_literal(' ' + ''.join(chr(ord(x) - 0xFEE0) for x in _WIDE))})"


def _visible(c: str) -> str:
    listed = "".join(f"\\x{{{x:04x}}}" for x in rules.INVISIBLE)
    return f"regexp_replace({c}, '[{listed}\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]', '', 'g')"


def _punctuation(c: str) -> str:
    one = [(a, b) for a, b in rules.PUNCTUATION if len(b) == 1]
    c = f"translate({c}, {_literal(''.join(a for a, _ in one))}, {_literal(''.join(b for _, b in one))})"
    for a, b in rules.PUNCTUATION:
        if len(b) > 1:
            c = f"replace({c}, {_literal(a)}, {_literal(b)})"
    return c


def _normalized(c: str) -> str:
    return q.formatted(_punctuation(_half(_visible(f"nfc_normalize({c})"))))


def _of_question(name: str, f, sql: str):
    query(name, f"SELECT record_id, {sql} AS text FROM {q.RECORDS}")(lambda s, d: records(s, d).select("record_id", f(F.col(_Q)).alias("text")))


_of_question("f01_newlines", text.normalize_newlines, "replace(replace(question, chr(13) || chr(10), chr(10)), chr(13), chr(10))")
_of_question("f02_halfwidth", text.fullwidth_to_halfwidth, _half(_Q))
_of_question("f03_invisible", text.strip_invisible, _visible(_Q))
_of_question("f04_punctuation", text.normalize_punctuation, _punctuation(_Q))
ORACLES["f05_normalize_text"] = f"SELECT record_id, {_normalized(_Q)} AS question, {_normalized(_A)} AS raw_dataset_answer FROM {q.RECORDS}"
ORACLES["c01_text_normalize"] = f"SELECT record_id, {_normalized(_Q)} AS question FROM {q.RECORDS}"


@query("f08_other_scripts", f"SELECT record_id, {q.has(_Q, rules.CJK[1])} AS cjk, {q.has(_Q, rules.OTHER_SCRIPT[1])} AS other, {q.has(_Q, rules.CJK[1])} OR {q.has(_Q, rules.OTHER_SCRIPT[1])} AS non_english FROM {q.RECORDS}")
def other_scripts(spark, d):
    c = F.col(_Q)
    return records(spark, d).select("record_id", text.contains_cjk(c).alias("cjk"), text.contains_other_script(c).alias("other"), (text.contains_cjk(c) | text.contains_other_script(c)).alias("non_english"))


def _options(c: str = _Q) -> str:
    """List of {letter, value}: each label begins a piece; by lines, or else by LaTeX labels.

    A piece that goes on over lines is no line option; a LaTeX option ends with its line or the next label.
    """
    text_of = f"replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    piece = lambda value: f"{{'letter': upper(split_part(p, chr(2), 1)), 'value': {q.strip(value)}}}"
    line = q.sql(r"^[\(\[]?\s*([A-F])[\)\].:-]\s*", "im")
    lines = f"list_filter(list_transform(string_split(regexp_replace({text_of}, {line}, chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:], lambda p: {piece('split_part(p, chr(2), 2)')}), lambda o: o.value <> '' AND NOT contains(o.value, chr(10)))"
    latex = q.sql(_LATEX_LABEL, "i")
    value = f"regexp_extract(split_part(p, chr(2), 2), '^([^\\n]+?)(?:\\\\textbf|\\\\text\\s*\\{{|\\n|$)', 1)"
    others = f"list_filter(list_transform(string_split(regexp_replace({c}, {latex}, chr(1) || '\\1\\2' || chr(2), 'g'), chr(1))[2:], lambda p: {piece(value)}), lambda o: o.value <> '')"
    return f"CASE WHEN len({lines}) > 0 THEN {lines} ELSE {others} END"


#: The label of a LaTeX option, without what follows it.
_LATEX_LABEL = rules.LATEX_OPTION[1][: rules.LATEX_OPTION[1].index("(.+?)")]


def _stripped(c: str = _Q) -> str:
    """The question without its option lines."""
    label = q.sql(r"^[\(\[]?\s*([A-F])[\)\].:-]\s*", "im")
    text_of = f"replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    pieces = f"string_split(regexp_replace({text_of}, {label}, chr(1) || '\\0', 'g'), chr(1))"
    body = f"regexp_replace(p, {q.sql('^' + r'[\(\[]?\s*([A-F])[\)\].:-]\s*', 'i')}, '')"
    kept = f"list_filter({pieces}, lambda p, i: i = 1 OR {q.strip(body)} = '' OR contains({q.strip(body)}, chr(10)))"
    lines = f"list_filter(list_transform(string_split(array_to_string({kept}, ''), chr(10)), lambda x: {q.strip('x')}), lambda x: x <> '')"
    return f"array_to_string({lines}, chr(10))"


_LETTER = f"upper(regexp_extract({q.strip(_A)}, '(?:^|[^\\p{{L}}\\p{{N}}_])([A-Fa-f])(?:$|[^\\p{{L}}\\p{{N}}_])', 1))"
_BY_LETTER = f"list_filter({_options()}, lambda o: o.letter = {_LETTER})[-1].value"


@query("f11_options", f"SELECT record_id, len({_options()})::BIGINT AS options, CASE WHEN len({_options()}) > 0 THEN {_stripped()} END AS stripped, {_BY_LETTER} AS value FROM {q.RECORDS}")
def options(spark, d):
    o = text.options(F.col(_Q))
    return records(spark, d).select("record_id", F.size(o).cast("long").alias("options"), F.when(F.size(o) > 0, text.strip_option_lines(F.col(_Q))).alias("stripped"), text.option_value(o, text.answer_letter(F.col(_A))).alias("value"))


@query("f15_answers", f"SELECT record_id, {q.normal(_A)} AS normal, {q.normal(_A)} = {q.normal('confirmed_answer')} AS same FROM {q.RECORDS}")
def normal_answers(spark, d):
    return records(spark, d).select("record_id", text.normalize_answer(F.col(_A)).alias("normal"), evaluate.equivalent(F.col(_A), F.col("confirmed_answer")).alias("same"))


def _grams(t: str) -> str:
    return f"CASE WHEN {t} = '' THEN [] ELSE list_distinct(list_transform(range(1, greatest(length({t}) - 1, 2)), lambda i: substring({t}, i, 3))) END"


@query("f18_jaccard", f"SELECT left_id, right_id, round(CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0 WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END, 9)::DOUBLE AS jaccard FROM (SELECT left_id, right_id, {_grams('l')} AS a, {_grams('r')} AS b FROM (SELECT left_id, right_id, {q.minhash('coalesce(left_question, chr(32))')} AS l, {q.minhash('coalesce(right_question, chr(32))')} AS r FROM dedup_pairs))")
def jaccard(spark, d):
    # one projection a step: a text is normalised once, not once a place, and its substrings are listed once
    plain = lambda c: text.minhash_text(text.or_blank(F.col(c)))
    pairs = runtime.fit_partitions(runtime.table(spark, d, "dedup_pairs").select("left_id", "right_id", "left_question", "right_question"))
    pairs = pairs.select("left_id", "right_id", plain("left_question").alias("a"), plain("right_question").alias("b"))
    pairs = pairs.select("left_id", "right_id", text.char_ngrams(F.col("a")).alias("a"), text.char_ngrams(F.col("b")).alias("b"))
    return pairs.select("left_id", "right_id", F.round(text.jaccard(F.col("a"), F.col("b")), 9).alias("jaccard"))


def _words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '[{SPACE}]+'), lambda w: w <> '')"


def _agreeing(w: str, n: int) -> str:
    """Where each word equals the one n words on, as text of ones and noughts."""
    return f"array_to_string(list_transform(range(1, len({w}) - {n} + 1), lambda i: CASE WHEN {w}[i] = {w}[i + {n}] THEN '1' ELSE '0' END), '')"


@query("f23_repetition", f"SELECT record_id, (coalesce(list_max(list_transform(regexp_extract_all({_agreeing('w', 4)}, '1+'), lambda x: length(x) // 4)), 0) + 1)::INTEGER AS repetition FROM (SELECT record_id, {_words(_Q)} AS w FROM {q.RECORDS})")
def repetition(spark, d):
    return records(spark, d).select("record_id", text.ngram_repetition()(F.col(_Q)).alias("repetition"))


def _boxed(c: str) -> str:
    """The last boxed expression: up to where braces first balance behind its name."""
    rest = f"list_reverse(string_split({c}, '\\boxed{{'))[1]"
    open_at = lambda p: f"(length({p}) - length(replace({p}, '{{', '')) + 1)"
    shut_at = lambda p: f"(length({p}) - length(replace({p}, '}}', '')))"
    end = f"list_filter(range(1, length({rest}) + 1), lambda i: {open_at(f'substring({rest}, 1, i)')} = {shut_at(f'substring({rest}, 1, i)')})[1]"
    return f"CASE WHEN contains({c}, '\\boxed{{') THEN coalesce({q.strip(f'substring({rest}, 1, {end} - 1)')}, '') ELSE '' END"


def _parsed(c: str) -> str:
    found = f"regexp_extract_all({c}, {q.sql('^(?:final answer|answer)' + r'\s*[:：]\s*(.+)$', 'im')}, 1)"
    last = f"list_reverse(string_split(regexp_replace({c}, '\\n+$', ''), chr(10)))[1]"
    return f"CASE WHEN len({found}) > 0 THEN {q.strip(f'list_reverse({found})[1]')} WHEN {q.strip(c)} = '' THEN '' ELSE {q.strip(last)} END"


ORACLES["f25_boxed"] = f"SELECT record_id, {_boxed(_A)} AS boxed, {_parsed(_A)} AS parsed FROM {q.RECORDS}"


@query("f28_sample_answers", f"SELECT record_id, i AS index, coalesce(list_filter([b, CASE WHEN r IS DISTINCT FROM s THEN c ELSE '' END, g], lambda x: {q.has('x', r'[^\W_]')})[1], '') AS answer FROM (SELECT record_id, i, s, r, {_boxed('coalesce(s, chr(32))')} AS b, {_boxed('coalesce(r, chr(32))')} AS c, {q.strip('coalesce(g, chr(32))')} AS g FROM (SELECT record_id, (x.i - 1)::INTEGER AS i, json_extract_string(x.e, '$.solution') AS s, json_extract_string(x.e, '$.reasoning') AS r, json_extract_string(x.e, '$.answer') AS g FROM (SELECT record_id, unnest(list_transform(json_extract(v, '$.samples[*]'), lambda e, i: {{'i': i, 'e': e}})) AS x FROM {_V} WHERE json_type(v, '$.samples') = 'ARRAY')))")
def sample_answers(spark, d):
    s = schema.decode(records(spark, d).select("record_id", "verification"), "verification").select("record_id", F.posexplode("verification.samples").alias("index", "s"))
    return s.select("record_id", "index", evaluate.sample_answer(F.col("s.solution"), F.col("s.reasoning"), F.col("s.answer")).alias("answer"))


@query("f30_l2", "SELECT vec_id, round(embedding[1]::DOUBLE / n, 6) AS first, round(list_sum(list_transform(embedding, lambda x: (x::DOUBLE / n) * (x::DOUBLE / n))), 6) AS length FROM (SELECT *, greatest(sqrt(list_sum(list_transform(embedding, lambda x: (x::DOUBLE) * x::DOUBLE))), 1e-12) AS n FROM embeddings)")
def l2(spark, d):
    v = text.l2_normalize(F.col("embedding"))
    return runtime.table(spark, d, "embeddings").select("vec_id", F.round(v[0], 6).alias("first"), F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x), 6).alias("length"))


@query("f31_json", "SELECT record_id, coalesce(CASE WHEN json_valid(trace) AND json_type(trace) = 'ARRAY' THEN json_array_length(trace) END, 0)::BIGINT AS events, coalesce(CASE WHEN json_valid(meta) AND json_type(meta) = 'OBJECT' THEN len(json_keys(meta)) END, 0)::BIGINT AS meta_keys, coalesce(CASE WHEN json_valid(distillation) AND json_type(distillation) = 'OBJECT' THEN array_to_string(list_sort(json_keys(distillation)), ',') END, '') AS models FROM canonical_records")
def nested(spark, d):
    r = schema.encode(schema.decode(records(spark, d)))  # there and back
    r = schema.decode(r, "trace", "meta", "distillation")
    n = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    return r.select("record_id", n("trace").alias("events"), n(F.map_keys("meta")).alias("meta_keys"), F.coalesce(F.array_join(F.array_sort(F.map_keys("distillation")), ","), F.lit("")).alias("models"))


# every text of a record: of the models, then of the samples; solution before reasoning
_MODEL_TEXTS = "CASE WHEN json_valid(distillation) AND json_type(distillation) = 'OBJECT' THEN flatten(list_transform(json_extract(distillation, '$.*'), lambda e: [coalesce(json_extract_string(e, '$.solution'), ''), coalesce(json_extract_string(e, '$.reasoning'), '')])) ELSE [] END"
_SAMPLE_TEXTS = "CASE WHEN json_valid(verification) AND json_type(verification, '$.samples') = 'ARRAY' THEN flatten(list_transform(json_extract(verification, '$.samples[*]'), lambda e: [coalesce(json_extract_string(e, '$.solution'), ''), coalesce(json_extract_string(e, '$.reasoning'), '')])) ELSE [] END"
_TEXTS = f"list_concat({_MODEL_TEXTS}, {_SAMPLE_TEXTS})"


@query("f32_resolve_text", f"SELECT record_id, md5(CASE WHEN t = '' THEN question ELSE t END) AS md5 FROM (SELECT record_id, coalesce(question, '') AS question, array_to_string(list_filter({_TEXTS}, lambda x: x <> ''), chr(10)) AS t FROM canonical_records)")
def resolve_text(spark, d):
    r = records(spark, d)
    return r.select("record_id", F.md5(clean.resolve_text(r, "cot_text")).alias("md5"))


@query("f33_shingles", f"SELECT record_id, CASE WHEN t = '' THEN 0 ELSE len(list_distinct(list_transform(range(1, greatest(len(w), 2)), lambda i: array_to_string(w[i:i + 1], ' ')))) END::BIGINT AS shingles FROM (SELECT record_id, t, regexp_split_to_array(t, '[{SPACE}]+') AS w FROM (SELECT record_id, {_NORMAL_Q} AS t FROM {q.RECORDS}))")
def shingles(spark, d):
    return records(spark, d).select("record_id", F.size(text.word_shingles(text.normalize_answer(F.col(_Q)))).cast("long").alias("shingles"))


@query("f34_difficulty", f"SELECT record_id, coalesce(try_cast(nullif(regexp_extract(question, '(?:^|[^0-9])(10|[1-9])(?:[^0-9]|$)', 1), '') AS DOUBLE), 0) AS score FROM {q.RECORDS}")
def difficulty_scores(spark, d):
    return records(spark, d).select("record_id", text.difficulty_score(F.col(_Q)).alias("score"))


# ---- record operators ----


def _unwrapped() -> str:
    """The fixpoint of the wrappers, round by round; a settled text stays as it is in later rounds."""
    def wrapped(c: str) -> str:
        for f, p in rules.WRAPPERS:
            p = p[:-1] + r"(?:\n?\Z)" if p.endswith("$") else p  # the end, or before a last line end
            c = f"regexp_replace({c}, {q.sql(p, f)}, '', 'g')"
        return c

    noise = " OR ".join(q.has("x", p, f) for f, p in rules.NOISE_LINES)
    sql = f"WITH r0 AS MATERIALIZED (SELECT record_id, question, question AS t FROM {q.RECORDS})"
    for i in range(1, rules.WRAPPER_ROUNDS + 1):
        lines = "regexp_split_to_array(regexp_replace(w, '\\n$', ''), '\\n')"
        sql += f""",
w{i} AS MATERIALIZED (SELECT record_id, question, {wrapped('t')} AS w FROM r{i - 1}),
n{i} AS MATERIALIZED (SELECT record_id, question, {lines} AS l, list_transform({lines}, lambda x: {noise}) AS noisy FROM w{i}),
r{i} AS MATERIALIZED (SELECT record_id, question, CASE WHEN list_position(noisy, false) IS NULL OR list_position(noisy, false) = 0 THEN '' ELSE {q.strip("array_to_string(l[list_position(noisy, false):len(l) + 1 - list_position(list_reverse(noisy), false)], chr(10))")} END AS t FROM n{i})"""
    return f"{sql} SELECT record_id, CASE WHEN t = {q.strip(_Q)} THEN question ELSE t END AS question FROM r{rules.WRAPPER_ROUNDS}"


ORACLES["c02_instruction_wrapper_cleaner"] = _unwrapped()


def _math() -> str:
    """The verdict of the mathematics filter over question and reasoning ``c``."""
    has = lambda t: q.has("c", t[1], t[0])
    role = []
    for f, p in rules.ROLES:
        groups = re.compile(p).groups
        found = f"regexp_extract(c, {q.sql(p, f)}, {groups if groups == 1 else 1})"
        role.append(f"({q.has('c', p, f)} AND NOT {q.has(found, rules.MATH_ROLE[1], rules.MATH_ROLE[0])})")
    sure = " OR ".join([*(q.has("c", p, "i") for p in rules.TRANSLATION), has(rules.STRONG_CODE), *(f"starts_with(c, {_literal(p)})" for p in rules.PROGRAMMING_PREFIXES)])
    flags = f"SELECT record_id, {has(rules.MATH_INSTRUCTION)} AND {has(rules.MATH_OBJECT)} AS deep, {' OR '.join(role)} AS role, {has(clean.VOCABULARIES['stem'])} AS stem, {has((clean.VOCABULARIES['code'][0], clean.VOCABULARIES['code'][1].replace(r'\bjava\b(?!script)', r'\bjava\b')))} OR {has(clean.VOCABULARIES['general'])} OR {has(rules.CHAT_TRANSCRIPT)} AS plain, {sure} AS sure FROM t"
    reasoning = "CASE WHEN json_valid(distillation) AND json_type(distillation) = 'OBJECT' THEN array_to_string(list_transform(json_extract(distillation, '$.*'), lambda e: coalesce(json_extract_string(e, '$.reasoning'), '')), chr(10)) ELSE '' END"
    both = q.strip(f"coalesce(question, '') || chr(10) || {reasoning}")
    hit = "sure OR role OR ((plain OR role) AND NOT deep) OR (stem AND NOT deep) OR (stem AND (plain OR role))"
    return f"WITH t AS MATERIALIZED (SELECT coalesce(record_id, '') AS record_id, {both} AS c FROM canonical_records), f AS ({flags}) SELECT record_id, CASE WHEN {hit} THEN 'drop' ELSE '' END AS training_phase, CASE WHEN {hit} THEN 'non_math_signal' ELSE '' END AS filter_tag FROM f"


ORACLES["c08_math_filter"] = _math()


def _mcq() -> str:
    has = lambda t, c=_Q: q.has(c, t[1], t[0])
    n, o = _NORMAL_Q, q.normal("value")
    which = f"({has(rules.WHICH_OF, n)} OR {has(rules.WHICH_OF_THESE, n)})"
    unconvertible = [f"{which} AND NOT contains({n}, 'such that')", has(rules.SELECT_ALL, n), has(rules.NEGATIVE_CHOICE, n), f"{has(rules.ROMAN_MARKER)} AND {which}", has(rules.NONE_OR_ALL, o), has(rules.CROSS_OPTION, o), has(rules.INDETERMINATE, o)]
    # labels followed by a label or the end; RE2 has no lookahead, so pieces are counted
    marks = f"len(regexp_extract_all(replace(replace(question, chr(13) || chr(10), chr(10)), chr(13), chr(10)), {q.sql(rules.COMPACT_MARKER[1], rules.COMPACT_MARKER[0])}))"
    detected = " OR ".join([has(rules.INLINE_OPTION), q.has(_Q, _LATEX_LABEL + ".", "i"), f"{marks} >= 3", has(rules.OPTIONS_HEADER), has(rules.WHICH_OF), has(rules.WHICH_OF_THESE)])
    failed = " OR ".join(["letter = ''", "coalesce(value, '') = ''", *unconvertible, "length(stripped) < 10"])
    base = f"SELECT record_id, question, raw_dataset_answer, confirmed_answer, len({_options()}) AS n, {_LETTER} AS letter, {_BY_LETTER} AS value, {_stripped()} AS stripped FROM {q.RECORDS}"
    return f"WITH b AS MATERIALIZED ({base}), v AS (SELECT *, CASE WHEN n = 0 THEN {detected} ELSE {failed} END AS bad FROM b) SELECT record_id, CASE WHEN n > 0 AND NOT bad THEN stripped ELSE question END AS question, CASE WHEN n > 0 AND NOT bad THEN {q.strip('value')} ELSE raw_dataset_answer END AS raw_dataset_answer, CASE WHEN bad THEN 'midtrain' ELSE '' END AS training_phase, CASE WHEN bad THEN 'boolean_and_mcq' ELSE '' END AS filter_tag FROM v"


query("c11_mcq_converter", _mcq())(lambda s, d: clean.mcq_converter(records(s, d, True)).select("record_id", "question", "raw_dataset_answer", "training_phase", "filter_tag"))

_ENTRY = "FROM (SELECT coalesce(record_id, '') AS record_id, unnest(json_keys(distillation)) AS model, distillation AS j FROM (SELECT DISTINCT record_id, distillation FROM canonical_records WHERE json_valid(distillation) AND json_type(distillation) = 'OBJECT'))"
_FIELD = lambda name: f"coalesce(json_extract_string(j, '$.\"' || model || '\".{name}'), '')"
_SAID = lambda name: q.formatted(q.urls(_FIELD(name)))
_TAGGED = "list_filter(coalesce(from_json(json_extract(j, '$.\"' || model || '\".quality_tags'), '[\"VARCHAR\"]'), []), lambda x: trim(x) <> '')"


@query("c16_cot_cleaning", f"WITH e AS MATERIALIZED (SELECT record_id, model, {_SAID('solution')} AS solution, {_SAID('reasoning')} AS reasoning, {_TAGGED} AS old {_ENTRY}), f AS (SELECT *, {q.has('solution || chr(10) || reasoning', f'{rules.CJK[1]}|{rules.OTHER_SCRIPT[1]}')} AS foreign_text, CASE WHEN contains(lower(model), 'gpt-oss') THEN solution = '' ELSE reasoning <> '' AND NOT contains(reasoning, '</think>') END AS cut FROM e), t AS (SELECT *, list_concat(old, list_concat(CASE WHEN foreign_text AND NOT list_contains(old, 'non_english') THEN ['non_english'] ELSE [] END, CASE WHEN cut AND NOT list_contains(old, 'truncated') THEN ['truncated'] ELSE [] END)) AS tags FROM f) SELECT record_id, model, md5(solution) AS solution, md5(reasoning) AS reasoning, CASE WHEN len(tags) > 0 THEN 'invalid' ELSE 'valid' END AS quality_status, array_to_string(tags, ',') AS quality_tags FROM t")
def cot_cleaning(spark, d):
    r = clean.cot_cleaning(records(spark, d).select("record_id", "distillation").distinct())
    e = schema.decode(r, "distillation").select("record_id", F.explode("distillation").alias("model", "e"))
    return e.select("record_id", "model", F.md5("e.solution").alias("solution"), F.md5("e.reasoning").alias("reasoning"), "e.quality_status", F.array_join("e.quality_tags", ",").alias("quality_tags"))


def _last_event(df: DataFrame) -> DataFrame:
    """The event that an operator left in the trace."""
    e = F.element_at("trace", -1)
    return df.select("record_id", e["processor"].alias("processor"), e["status"].alias("status"), e["reason_code"].alias("reason_code"))


def _plain_answer(c: str) -> str:
    for p, by in ((r"\$|\\(?:left|right|displaystyle)\b|\\[,;:! ]", ""), (r"\\(?:boxed|text|mathrm)\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}", r"\1"), (r"\\[dt]?frac\{([^{}]*)\}\{([^{}]*)\}", r"\1/\2"), (f"[{SPACE}]+", ""), (r"^[a-z]=|\.$", "")):
        c = f"regexp_replace({c if c != _A and c != 'confirmed' else f'lower({q.strip(c)})'}, '{p}', '{by}', 'g')"
    return f"(SELECT CASE WHEN regexp_full_match(x, '[-+]?\\d{{1,3}}(?:,\\d{{3}})+(?:\\.\\d+)?') THEN replace(x, ',', '') ELSE x END FROM (SELECT {c} AS x))"


def _value(p: str) -> str:
    n = r"[-+]?(?:\d+(?:\.\d*)?|\.\d+)"
    number = f"CASE WHEN regexp_full_match({p}, '{n}') THEN try_cast({p} AS DOUBLE) WHEN regexp_full_match({p}, '{n}/{n}') AND try_cast(split_part({p}, '/', 2) AS DOUBLE) <> 0 THEN try_cast(split_part({p}, '/', 1) AS DOUBLE) / try_cast(split_part({p}, '/', 2) AS DOUBLE) WHEN regexp_full_match({p}, '{n}\\\\?%') THEN try_cast(regexp_replace({p}, '\\\\?%', '') AS DOUBLE) / 100 END"
    return f"coalesce((round({number}, 10) + 0.0)::VARCHAR, {p})"


def _canonical(c: str) -> str:
    """An answer's canonical form: bracketed lists part by part, sets sorted."""
    inner = f"string_split(regexp_replace(regexp_extract({c}, '^\\\\?[\\[({{](.+)[\\])}}]$', 1), '\\\\$', ''), ',')"
    parts = f"list_transform({inner}, lambda p: {_value('p')})"
    kind = f"replace(regexp_extract({c}, '^\\\\?(.)', 1) || substring({c}, -1, 1), '\\', '')"
    return f"CASE WHEN regexp_full_match({c}, '\\\\?[\\[({{].+,.+[\\])}}]') THEN {kind} || array_to_string(CASE WHEN regexp_matches({c}, '^\\\\?\\{{') THEN list_sort({parts}) ELSE {parts} END, ',') ELSE {_value(c)} END"


query("c17_rule_correctness", f"WITH a AS MATERIALIZED (SELECT record_id, raw_dataset_answer, CASE WHEN confirmed_answer = '' THEN raw_dataset_answer ELSE confirmed_answer END AS confirmed FROM {q.RECORDS}), p AS MATERIALIZED (SELECT record_id, {_plain_answer('confirmed')} AS l, {_plain_answer(_A)} AS r FROM a), e AS (SELECT record_id, {_canonical('l')} = {_canonical('r')} AS ok FROM p) SELECT record_id, 'rule_based_correctness' AS processor, CASE WHEN ok THEN 'kept' ELSE 'dropped' END AS status, CASE WHEN ok THEN '' ELSE 'rule_verify_failed' END AS reason_code FROM e")(lambda s, d: _last_event(clean.rule_correctness(records(s, d))))
_RUNS = f"len(list_filter({_TEXTS}, lambda t: contains({_agreeing(_words('t'), 4)}, repeat('1', 60)))) > 0"
query("c18_ngram_repetition_filter", f"SELECT coalesce(record_id, '') AS record_id, 'ngram_repetition_filter' AS processor, CASE WHEN {_RUNS} THEN 'dropped' ELSE 'kept' END AS status, CASE WHEN {_RUNS} THEN 'ngram_repetition' ELSE '' END AS reason_code FROM canonical_records")(lambda s, d: _last_event(clean.ngram_repetition_filter(records(s, d))))

# ---- the routing pipeline with the trace it writes ----


@query("o01_route_trace", f"WITH v AS (SELECT {_CHAIN} AS v FROM {_CLEANED}) SELECT processor, status, reason, count(*) AS events FROM (SELECT 'filter_short_question_text' AS processor, CASE WHEN v = 'drop/short_question' THEN 'dropped' ELSE 'rest' END AS status, CASE WHEN v = 'drop/short_question' THEN 'short_question' ELSE '' END AS reason FROM v UNION ALL SELECT 'language_filter', CASE WHEN v IN ('drop/other_non_english', 'midtrain/chinese') THEN 'dropped' ELSE 'rest' END, CASE WHEN v IN ('drop/other_non_english', 'midtrain/chinese') THEN split_part(v, '/', 2) ELSE '' END FROM v UNION ALL SELECT 'boolean_answer_filter', CASE WHEN v = 'midtrain/boolean_and_mcq' THEN 'routed' ELSE 'rest' END, CASE WHEN v = 'midtrain/boolean_and_mcq' THEN 'boolean_answer' ELSE '' END FROM v) GROUP BY ALL")
def route_trace(spark, d):
    """The events that the routing pipeline leaves: of three of its operators, by status and reason."""
    df = records(spark, d, True).withColumn("trace", F.lit("[]"))
    out = schema.decode(runner.run(df, {"processors": [{"name": n} for n in PIPELINE]}), "trace")
    e = out.select(F.explode("trace").alias("e")).where(F.col("e.processor").isin("filter_short_question_text", "language_filter", "boolean_answer_filter"))
    moved = F.col("e.status").isin("dropped", "routed")
    return e.select("e.processor", F.when(moved, F.col("e.status")).otherwise("rest").alias("status"), F.when(moved, F.col("e.reason_code")).otherwise("").alias("reason")).groupBy("processor", "status", "reason").agg(F.count("*").alias("events"))


# ---- sources and sinks ----

query("s03_adapter", ORACLES["s04_same_format"])(lambda s, d: readers.load_source(s, {"adapter": "same_format", "input_path": [f"{d}/incoming_records.parquet"], "dataset_name": "incoming"}).select("record_id", "question", "raw_dataset_answer", "confirmed_answer", "dataset_name"))


@query("s06_conversation_files", "SELECT sha256(question) AS record_id, question, coalesce(ground_truth, '') AS raw_dataset_answer, n AS copies FROM benchmark_questions, (VALUES (1), (2)) v(n)")
def conversation_files(spark, d):
    """Two files with a list of conversations each, and the same as a conversation a line, through the adapter."""
    t = runtime.table(spark, d, "benchmark_questions")
    turn = lambda role, said, truth: F.struct(F.lit(role).alias("from"), said.alias("value"), F.struct(truth.alias("value")).alias("ground_truth"))
    none = F.lit(None).cast("string")
    talk = F.array(turn("system", F.lit("Think."), none), turn("human", F.col("question"), none), turn("assistant", F.lit("..."), F.col("ground_truth")))
    path = runtime.scratch(spark, "conversations")
    half = F.pmod(F.xxhash64("uid"), F.lit(2))
    for k in (0, 1):
        t.where(half == k).agg(F.to_json(F.collect_list(talk)).alias("value")).write.text(f"{path}/list{k}")
    t.select(F.to_json(talk).alias("value")).write.text(f"{path}/lines")
    read = lambda where, **o: readers.load_source(spark, {"adapter": "openreasoning", "input_path": where, **o})
    lists = read([f"{path}/list0", f"{path}/list1"]).withColumn("copies", F.lit(1))
    lines = read(f"{path}/lines", lines=True).withColumn("copies", F.lit(2))
    return lists.unionByName(lines).select("record_id", "question", "raw_dataset_answer", "copies")


@query("k01_write_canonical", f"SELECT record_id, question, raw_dataset_answer, dataset_name FROM {q.RECORDS}")
def write_and_read(spark, d):
    path = runtime.scratch(spark, "canonical")
    writers.write_canonical(schema.decode(records(spark, d)), path)
    return readers.read_canonical(spark, path).select("record_id", "question", "raw_dataset_answer", "dataset_name")


@query("k02_shard_sizes", "SELECT true AS all_rows, true AS several, true AS even")
def shard_sizes(spark, d):
    """Whether shards hold all rows, are several, and none has more rows than its share."""
    path = runtime.scratch(spark, "shards")
    r = records(spark, d)
    target = 1 << 18
    writers.write_shards(r, path, target)
    size = schema.encode(r).agg(F.count("*").alias("n"), F.avg(sum((F.length(c) for c in schema.COLUMNS), F.lit(0))).alias("mean"))
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("rows"))
    return files.agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.max("rows").alias("most")).crossJoin(size).select((F.col("rows") == F.col("n")).alias("all_rows"), (F.col("files") > 1).alias("several"), (F.col("most") <= F.floor(target / F.col("mean"))).alias("even"))


@query("k04_pairs_file", ORACLES["d01_exact_pairs"])
def pairs_file(spark, d):
    path = runtime.scratch(spark, "pairs")
    writers.write_pairs(dedup.exact_pairs(records(spark, d)), path)
    return spark.read.parquet(path)


@query("k05_rollouts", f"SELECT record_id, coalesce(json_extract_string(v, '$.majority_answer'), NULL) AS majority_answer, {_N}::BIGINT AS samples, json_extract_string(v, '$.majority_matches_gt') = 'true' AS is_correct FROM {_V} WHERE {_N} > 0")
def rollouts_file(spark, d):
    path = runtime.scratch(spark, "rollouts")
    writers.write_rollouts(records(spark, d), path)
    return spark.read.parquet(path).select("record_id", "majority_answer", F.size(F.from_json("parsed_answers", "array<string>")).cast("long").alias("samples"), "is_correct")


@query("k08_checkpoint", f"SELECT record_id, split_part(coalesce(v, '/'), '/', 1) AS training_phase, split_part(coalesce(v, '/'), '/', 2) AS filter_tag FROM (SELECT record_id, CASE WHEN {q.short(_Q)} THEN 'drop/short_question' WHEN {q.strip(_A)} = '' THEN 'midtrain/empty_ground_truth' END AS v FROM {q.RECORDS})")
def checkpointed(spark, d):
    """A pipeline that left its steps in a folder, finished by a second run that reads nothing else."""
    path = runtime.scratch(spark, "steps")
    config = {"processors": [{"name": "length_filter"}, {"name": "empty_answer_tagger"}]}
    r = records(spark, d, True)
    runner.run(r, config, path)
    return runner.run(r.limit(0), config, path).select(*ROUTED)


# ---- deduplication ----

_KEYED_Q = f"SELECT DISTINCT record_id, lower({q.strip(_Q)}) AS k FROM {q.RECORDS}"
query("t01_exact_order", f"SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS position FROM (SELECT min(record_id) AS record_id FROM ({_KEYED_Q}) GROUP BY k)")(lambda s, d: relational.positions(dedup.exact_dedup(records(s, d), ordered=True).select("record_id"), "record_id"))
query("t03_first_rows", f"SELECT record_id, position FROM (SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS position FROM (SELECT DISTINCT record_id FROM {q.RECORDS})) WHERE position < 20")(lambda s, d: relational.positions(records(s, d).select("record_id").distinct(), "record_id").where("position < 20"))

def _classes(where: str = "") -> str:
    """Each record's normal text."""
    return f"n AS MATERIALIZED (SELECT id, min(t) AS t FROM (SELECT record_id AS id, {q.minhash(_Q)} AS t FROM {q.RECORDS} {where}) GROUP BY 1)"


_NEAR = f"""c AS MATERIALIZED (SELECT min(id) AS id, t FROM n WHERE t <> '' GROUP BY t), g AS MATERIALIZED (SELECT id, unnest({_GRAMS}) AS gram FROM c), z AS (SELECT id, count(*) AS size FROM g GROUP BY 1),
p AS MATERIALIZED (SELECT i.l AS left_id, i.r AS right_id, i.n::DOUBLE / (a.size + b.size - i.n) AS s FROM (SELECT x.id AS l, y.id AS r, count(*) AS n FROM g x JOIN z u ON u.id = x.id JOIN g y ON x.gram = y.gram AND x.id < y.id JOIN z w ON w.id = y.id AND w.size BETWEEN 0.8 * u.size AND u.size / 0.8 GROUP BY 1, 2) i JOIN z a ON a.id = l JOIN z b ON b.id = r WHERE i.n::DOUBLE / (a.size + b.size - i.n) >= 0.8)"""
_ALL_PAIRS = f"WITH {_classes()}, {_NEAR} SELECT left_id, right_id, round(s, 6) AS similarity FROM p"
ORACLES["d02_canonical_jaccard_pairs"] = ORACLES["d02_canonical_lsh_pairs"] = _ALL_PAIRS
ORACLES["d02_lsh_pairs"] = ORACLES["d02_jaccard_pairs"]
_FUZZY = f"""WITH RECURSIVE {_classes("WHERE training_phase <> 'drop'")}, {_NEAR}, e AS MATERIALIZED (SELECT left_id a, right_id b FROM p UNION SELECT m, id FROM (SELECT id, min(id) OVER (PARTITION BY t) AS m FROM n) WHERE m <> id),
y AS MATERIALIZED (SELECT a x, b y FROM e UNION SELECT b, a FROM e), v AS (SELECT id AS x, id AS y FROM n UNION SELECT v.x, y.y FROM v JOIN y ON v.y = y.x), gone AS (SELECT x AS id FROM v GROUP BY 1 HAVING min(y) <> x)
SELECT DISTINCT record_id FROM {q.RECORDS} WHERE record_id NOT IN (SELECT id FROM gone)"""
ORACLES["d04_canonical_fuzzy_dedup"] = _FUZZY
query("t02_fuzzy_order", f"SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS position FROM ({_FUZZY})")(lambda s, d: relational.positions(dedup.fuzzy_dedup(records(s, d), ordered=True).select("record_id").distinct(), "record_id"))
query("d02_lsh_recall", "SELECT s AS similarity, round(1 - pow(1 - pow(s, 320 // 40), 40), 9)::DOUBLE AS recall FROM (VALUES (0.7::DOUBLE), (0.8::DOUBLE), (0.9::DOUBLE)) v(s)")(lambda s, d: s.createDataFrame([(x, round(dedup.lsh_recall(x, dedup.PERMUTATIONS, dedup.BANDS), 9)) for x in (0.7, 0.8, 0.9)], "similarity double, recall double"))


def _component_sql(edges: str) -> str:
    """Vertices of the edges with the smallest of their component."""
    return f"e AS MATERIALIZED ({edges}), y AS MATERIALIZED (SELECT a x, b y FROM e UNION SELECT b, a FROM e), u AS (SELECT DISTINCT x, x AS y FROM y UNION SELECT u.x, y.y FROM u JOIN y ON u.y = y.x), m AS (SELECT x AS id, min(y) AS root FROM u GROUP BY 1)"


ORACLES["a11_thresholds"] = " UNION ALL ".join(f"SELECT {t}::DOUBLE AS threshold, (WITH RECURSIVE {_component_sql(f'SELECT DISTINCT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b FROM dedup_pairs WHERE left_id IS NOT NULL AND right_id IS NOT NULL AND NOT isnan(similarity) AND similarity >= {t} AND left_id <> right_id')} SELECT count(*) FROM m WHERE id <> root) AS dropped" for t in (0.7, 0.8, 0.9))


def _even(prompt: str) -> str:
    """A stand-in judge of pairs: decides by the length of the prompt."""
    return f"Decision: {'YES' if len(prompt) % 2 == 0 else 'NO'}"


_ASK_PAIR = "'Do the two questions ask for the same? End with ''Decision: YES'' or ''Decision: NO''.' || chr(10) || 'A: ' || coalesce(left_question, '') || chr(10) || 'B: ' || coalesce(right_question, '')"
_NAMED_PAIRS = "left_id IS NOT NULL AND right_id IS NOT NULL"
query("d05_judged_pairs", f"SELECT left_id, right_id, length({_ASK_PAIR}) % 2 = 0 AS is_duplicate FROM dedup_pairs WHERE {_NAMED_PAIRS}")(lambda s, d: inference.judged_pairs(runtime.table(s, d, "dedup_pairs").where(_NAMED_PAIRS), _even).select("left_id", "right_id", "is_duplicate"))


def _judge_sql(which: str) -> str:
    return f"WITH RECURSIVE {_component_sql(f'SELECT DISTINCT least(left_id, right_id) AS a, greatest(left_id, right_id) AS b FROM dedup_pairs WHERE {_NAMED_PAIRS} AND left_id <> right_id AND {which}')} SELECT record_id FROM {q.RECORDS} WHERE record_id NOT IN (SELECT id FROM m WHERE id <> root)"


for _name, _veto in (("d06_dedup_judge", False), ("d06_dedup_judge_vetoes", True)):
    query(_name, _judge_sql(f"length({_ASK_PAIR}) % 2 = 0" if _veto else "true"))(lambda s, d, v=_veto: dedup.dedup_judge(records(s, d), runtime.table(s, d, "dedup_pairs").where(_NAMED_PAIRS), _even, v).select("record_id"))

_PLAIN_IDS = f"SELECT record_id AS id, min({_NORMAL_Q}) AS t FROM {q.RECORDS}"
_SHINGLED = f"CASE WHEN t = '' THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(regexp_split_to_array(t, '[{SPACE}]+')), 2)), lambda i: array_to_string(regexp_split_to_array(t, '[{SPACE}]+')[i:i + 1], ' '))) END"


@query("j12_boundary", f"WITH k AS MATERIALIZED (SELECT id, {_SHINGLED} AS s FROM ({_PLAIN_IDS} WHERE training_phase <> 'drop' GROUP BY 1)), g AS MATERIALIZED (SELECT id, {_SHINGLED} AS s FROM (SELECT * FROM ({_PLAIN_IDS} GROUP BY 1) WHERE id NOT IN (SELECT id FROM k) ORDER BY md5('42:' || id), id LIMIT 50)), p AS (SELECT a.id, b.id AS kept_id, count(*) AS n FROM (SELECT id, unnest(s) AS w FROM g) a JOIN (SELECT id, unnest(s) AS w FROM k) b USING (w) GROUP BY 1, 2), t AS (SELECT p.*, n::DOUBLE / (len(g.s) + len(k.s) - n) AS similarity FROM p JOIN g ON g.id = p.id JOIN k ON k.id = p.kept_id QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY n DESC, kept_id) <= 50) SELECT g.id AS record_id, kept_id, round(similarity, 9) AS similarity FROM g LEFT JOIN (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY id ORDER BY similarity DESC, kept_id) = 1) x USING (id)")
def boundary(spark, d):
    r = records(spark, d)
    return dedup.boundary_report(r, r.where("training_phase <> 'drop'"), 50).withColumn("similarity", F.round("similarity", 9))


# ---- decontamination ----


def _letters(texts: list[str]) -> list[list[float]]:
    """A stand-in embedder: counts of letters."""
    return [[float(t.lower().count(c)) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]


def _letter_vectors(source: str) -> str:
    counts = "[" + ", ".join(f"(length(l) - length(replace(l, '{c}', '')))::DOUBLE" for c in "abcdefghijklmnopqrstuvwxyz") + "]"
    return f"SELECT id, question, list_transform(v, lambda x: (x / greatest(sqrt(list_sum(list_transform(v, lambda y: y * y))), 1e-12))::FLOAT) AS e FROM (SELECT id, question, {counts} AS v FROM (SELECT *, lower(question) AS l FROM ({source})))"


def _nearest_sql(targets: str, k: int) -> str:
    """Each benchmark question's k nearest target rows."""
    return f"""b AS MATERIALIZED ({_letter_vectors(f"SELECT coalesce(uid, '') AS id, {q.strip('question')} AS question FROM benchmark_questions WHERE {q.strip('question')} <> ''")}),
t AS MATERIALIZED ({_letter_vectors(targets)}), f AS MATERIALIZED (SELECT id, min(question) AS question FROM t GROUP BY 1),
s AS (SELECT b.id AS uid, b.question AS asked, t.id, round(list_dot_product(b.e::DOUBLE[], t.e::DOUBLE[]), 12) AS similarity FROM b, t QUALIFY row_number() OVER (PARTITION BY b.id ORDER BY round(list_dot_product(b.e::DOUBLE[], t.e::DOUBLE[]), 12) DESC, t.id) <= {k})"""


ORACLES["x02_decontamination"] = f"WITH {_nearest_sql(f'SELECT record_id AS id, question FROM {q.RECORDS}', 5)} SELECT record_id, '' AS training_phase, coalesce(n, 0)::INTEGER AS candidates FROM {q.RECORDS} LEFT JOIN (SELECT id, count(*) AS n FROM s GROUP BY 1) ON id = record_id"
_ASKED = "length('Is the training question the benchmark question?' || chr(10) || 'Benchmark: ' || asked || chr(10) || 'Training: ' || f.question || chr(10) || chr(10) || 'Reply {\"decision\": \"yes\" or \"no\", \"reason\": ...}.')"


@query("x03_decontamination_steps", f"WITH {_nearest_sql(f'SELECT record_id AS id, question FROM {q.RECORDS} WHERE training_phase IN ({chr(39)}posttrain{chr(39)}, {chr(39)}midtrain{chr(39)})', 3)}, j AS (SELECT s.uid, {_ASKED} % 3 = 0 AS yes FROM s JOIN f ON f.id = s.id), d AS (SELECT coalesce(dataset_name, '') AS benchmark_source, yes FROM j JOIN benchmark_questions USING (uid)) SELECT benchmark_source, count(*) AS judged, count(*) FILTER (WHERE yes) AS contaminated, round(count(*) FILTER (WHERE yes)::DOUBLE / count(*), 4) AS drop_rate FROM d GROUP BY 1")
def decontamination_steps(spark, d):
    """Load, embed and search in three steps over a folder, embedded a second time from what is there."""
    path = runtime.scratch(spark, "decontamination")
    r = records(spark, d)
    decontaminate.decontam_load(r, runtime.table(spark, d, "benchmark_questions"), path)
    decontaminate.decontam_embed(r, _letters, path, "letters")

    def never(texts: list[str]) -> list[list[float]]:
        raise RuntimeError("embedded already")

    decontaminate.decontam_embed(r, never, path, "letters")
    yes = lambda p: '{"decision": "yes", "reason": ""}' if len(p) % 3 == 0 else '{"decision": "no", "reason": ""}'
    runtime.materialize(decontaminate.decontam_search(r, yes, checkpoint_dir=path, model="letters", top_k=3), "searched")
    return spark.read.json(f"{path}/benchmark_drop_stats").select("benchmark_source", "judged", "contaminated", "drop_rate")


# ---- evaluation ----

_SAMPLES = "CASE WHEN json_type(v, '$.samples') = 'ARRAY' THEN list_transform(json_extract(v, '$.samples[*]'), lambda e: coalesce(json_extract_string(e, '$.answer'), '')) ELSE [] END"
_RAW = f"(SELECT record_id, coalesce(raw_dataset_answer, '') AS raw, coalesce(question, '') AS question, coalesce(confirmed_answer, '') AS confirmed_answer, coalesce(training_phase, '') AS training_phase, coalesce(filter_tag, '') AS filter_tag, {_SAMPLES} AS a, v FROM (SELECT *, CASE WHEN json_valid(verification) THEN verification END AS v FROM canonical_records))"


def _voted(rows: str) -> str:
    """Majority, match and pass ratio over lists of answers ``a``; columns of ``rows`` pass."""
    best = "list_transform(list_distinct(list_filter(a, lambda x: x <> '')), lambda x: {'n': len(list_filter(a, lambda y: y = x)), 'first': -list_position(a, x), 'v': x})"
    normal = q.normal("x")
    return f"SELECT *, greatest(len(a), 1) AS num_samples, coalesce(m.v, '') AS majority_answer, coalesce(m.n, 0) AS majority_count, {q.normal('coalesce(m.v, chr(32))')} = {q.normal('raw')} AS majority_matches_gt, round(len(list_filter(a, lambda x: {normal} = {q.normal('raw')}))::DOUBLE / greatest(len(a), 1), 6) AS pass_ratio FROM (SELECT *, list_sort({best}, 'DESC')[1] AS m FROM {rows})"


ORACLES["e01_verification"] = f"SELECT record_id, num_samples::INTEGER AS num_samples, majority_answer, majority_count::INTEGER AS majority_count, majority_matches_gt, pass_ratio FROM ({_voted(_RAW)})"


def _sampler(prompt: str) -> str:
    """A stand-in model: one of three answers, by the characters of the prompt."""
    return f"So \\boxed{{{sum(map(ord, prompt)) // 2 % 3}}}"


_PROMPTED = "question || chr(10) || chr(10) || 'Put the final answer within \\boxed{}.' || ' (attempt ' || i || ')'"
_ROLLED = f"(SELECT record_id, question, raw, CASE WHEN length(question) <= 6000 THEN list_transform(range(0, 3), lambda i: (list_sum(list_transform(string_split({_PROMPTED}, ''), lambda c: unicode(c))) // 2 % 3)::BIGINT::VARCHAR) END AS a FROM {_RAW})"


@query("e01_rollout", f"SELECT record_id, CASE WHEN a IS NOT NULL THEN num_samples END::INTEGER AS num_samples, CASE WHEN a IS NOT NULL THEN majority_answer END AS majority_answer, CASE WHEN a IS NOT NULL THEN majority_count END::INTEGER AS majority_count, CASE WHEN a IS NOT NULL THEN pass_ratio END AS pass_ratio, CASE WHEN a IS NULL THEN '' WHEN majority_matches_gt THEN '' ELSE 'gt_suspect' END AS reason_code FROM ({_voted(_ROLLED)})")
def rollout(spark, d):
    """Three samples of every question, asked in two waves that are kept; a second run asks nothing."""
    r = records(spark, d, True).withColumns({"verification": F.lit("{}"), "trace": F.lit("[]")})
    path = runtime.scratch(spark, "replies")

    def down(prompt: str) -> str:
        raise RuntimeError("asked already")

    runtime.materialize(schema.encode(evaluate.rollout_correctness(r, _sampler, n=3, cache_dir=path, waves=2)), "first-run")
    out = evaluate.rollout_correctness(r, down, n=3, cache_dir=path)
    v = F.col("verification")
    return out.select("record_id", v["num_samples"].alias("num_samples"), v["majority_answer"].alias("majority_answer"), v["majority_count"].alias("majority_count"), F.round(v["pass_ratio"], 6).alias("pass_ratio"), F.element_at("trace", -1)["reason_code"].alias("reason_code"))


_JUDGE_PROMPT = "length('Judge the reference answer against the samples. Reply {\"gt_quality\":..., \"judgement\":..., \"majority_answer\":..., \"majority_count\":...}.' || chr(10) || question || chr(10) || raw || chr(10) || array_to_string(a, chr(10)))"
_DUE = "training_phase = 'posttrain' AND coalesce(json_extract_string(v, '$.majority_matches_gt') = 'false', false) AND json_extract_string(v, '$.llm_judge_gt_quality') IS NULL"
ORACLES["e02_answer_judge"] = f"SELECT record_id, coalesce(split_part(x, '/', 1), training_phase) AS training_phase, coalesce(split_part(x, '/', 2), filter_tag) AS filter_tag FROM (SELECT *, CASE WHEN NOT ({_DUE}) THEN NULL WHEN len(a) = 0 THEN 'midtrain/answer_uncertain' WHEN {_JUDGE_PROMPT} % 2 = 1 THEN 'posttrain/equivalent_rescued' ELSE 'midtrain/answer_mismatch' END AS x FROM {_RAW})"
_REFERENCE = "coalesce(" + ", ".join(f"nullif({q.strip(c)}, '')" for c in ("confirmed_answer", "json_extract_string(v, '$.confirmed_answer')", "json_extract_string(v, '$.majority_answer')", "raw")) + ", '')"
_RIGHT = f"length('Is the answer right? Reply YES or NO.' || chr(10) || question || chr(10) || 'Reference: ' || {_REFERENCE} || chr(10) || 'Answer: ' || coalesce(json_extract_string(e, '$.answer'), '')) % 2 = 0"
_JUDGED_SAMPLES = f"len(list_filter(json_extract(v, '$.samples[*]'), lambda e: coalesce(CASE json_extract_string(e, '$.judge_correct') WHEN 'true' THEN true WHEN 'false' THEN false END, {_RIGHT})))"


@query("e03_judged_samples", f"SELECT record_id, round(CASE WHEN n > 0 THEN {_JUDGED_SAMPLES}::DOUBLE / coalesce(nullif(TRY_CAST(json_extract_string(v, '$.num_samples') AS INTEGER), 0), n) ELSE TRY_CAST(json_extract_string(v, '$.pass_ratio') AS DOUBLE) END, 6) AS pass_ratio, CASE WHEN low THEN 'midtrain' ELSE training_phase END AS training_phase FROM (SELECT *, len(a) AS n, training_phase = 'posttrain' AND len(a) > 0 AND coalesce(TRY_CAST(json_extract_string(v, '$.majority_count') AS INTEGER), 0) < 2 AS low FROM {_RAW})")
def judged_samples(spark, d):
    out = evaluate.sample_answer_judge(records(spark, d), lambda p: "YES" if len(p) % 2 == 0 else "NO")
    return out.select("record_id", F.round("verification.pass_ratio", 6).alias("pass_ratio"), "training_phase")


ORACLES["e04_difficulty"] = f"SELECT record_id, (length('Rate the difficulty from 1 to 10: ' || question) % 10 + 1)::DOUBLE AS score FROM {q.RECORDS}"


@query("e05_pass_ratio_tags", f"SELECT record_id, CASE WHEN r < 0.2 THEN 'too_hard' ELSE 'too_easy' END AS filter_tag FROM (SELECT record_id, CASE WHEN json_valid(verification) THEN coalesce(TRY_CAST(json_extract_string(verification, '$.pass_ratio') AS DOUBLE), 0) ELSE 0 END AS r FROM canonical_records) WHERE r NOT BETWEEN 0.2 AND 0.9")
def pass_ratio_tags(spark, d):
    return evaluate.pass_ratio_rejects(records(spark, d), 0.2, 0.9).select("record_id", "filter_tag")


_NUM = "coalesce(TRY_CAST(json_extract_string(v, '$.num_samples') AS INTEGER), 0)"
query("a14_cleanup_counts", f"SELECT count(*) AS total, count(*) FILTER (WHERE NOT none AND s >= 3 AND n >= 3) AS complete, count(*) FILTER (WHERE NOT none AND NOT (s >= 3 AND n >= 3) AND (s > 0 OR n > 0)) AS incomplete, count(*) FILTER (WHERE none) AS no_verification FROM (SELECT {_N} AS s, {_NUM} AS n, v IS NULL OR json_type(v) <> 'OBJECT' OR len(json_keys(v)) = 0 AS none FROM {_V})")(lambda s, d: evaluate.cleanup_counts(records(s, d), 3))

# ---- model calls ----

_CONTENT = "length(question || chr(10) || 'Answer: ' || raw_dataset_answer)"
ORACLES["l01_classifier"] = f"SELECT record_id, CASE WHEN {_CONTENT} < 200 THEN 'drop' ELSE '' END AS training_phase, CASE WHEN {_CONTENT} < 200 THEN 'short' ELSE '' END AS filter_tag FROM {q.RECORDS}"


@query("l02_cache_folder", ORACLES["l02_cache"])
def cache_folder(spark, d):
    """Every request once; a second run with a client that is down finds all replies."""
    prompts = runtime.table(spark, d, "benchmark_questions").select(col("question").alias("prompt"))
    path = runtime.scratch(spark, "replies")

    def down(prompt: str) -> str:
        raise RuntimeError("asked already")

    runtime.materialize(inference.infer(prompts, lambda p: str(len(p)), path, waves=3), "first-run")
    return inference.infer(prompts, down, path).select("key", "reply")


query("l05_vectors", f"SELECT record_id, length(question)::DOUBLE AS first, 2 AS dims FROM {q.RECORDS}")(lambda s, d: inference.embed(records(s, d).select("record_id", "question"), "question", lambda ts: [[float(len(t)), 1.0] for t in ts]).select("record_id", F.col("embedding")[0].cast("double").alias("first"), F.size("embedding").alias("dims")))
ORACLES["l05_embed"] = "SELECT uid, 2 AS dims FROM benchmark_questions"

# ---- orchestration and streams ----

_NEW = f"(SELECT coalesce(nullif(trim(uid), ''), sha256(coalesce(question, ''))) AS record_id, {q.formatted(q.urls('coalesce(question, chr(32))'))} AS question, coalesce(ground_truth, '') AS raw_dataset_answer, coalesce(nullif(trim(dataset_name), ''), 'incoming') AS dataset_name FROM incoming_records)"
ORACLES["o04_add_dataset"] = f"""WITH n AS MATERIALIZED (SELECT * FROM {_NEW}), r AS MATERIALIZED (SELECT record_id, question, dataset_name FROM {q.RECORDS}),
k AS (SELECT record_id, lower({q.strip('min(question)')}) AS k FROM (SELECT record_id, question FROM r UNION ALL SELECT record_id, question FROM n) GROUP BY 1), s AS (SELECT min(record_id) AS record_id FROM k GROUP BY k)
SELECT record_id, dataset_name FROM r UNION ALL SELECT record_id, dataset_name FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY question, raw_dataset_answer, dataset_name) AS o FROM n WHERE record_id IN (SELECT record_id FROM s) AND record_id NOT IN (SELECT record_id FROM r)) WHERE o = 1"""


@query("o02_stages", "SELECT * FROM (VALUES (0, 'text_cleaning'), (1, 'language_filter'), (2, 'length_filter'), (3, 'mcq_converter'), (4, 'rule_correctness'), (5, 'exact_dedup'), (6, 'fuzzy_dedup'), (7, 'pass_ratio_filter')) v(step, processor)")
def stages(spark, d):
    """What older stage names stand for, in order."""
    steps = runner.steps_of({"stages": [{"name": "stage1_non_cot"}, {"name": "stage2_dedup"}, {"name": "stage4_cot", "enabled": False}, {"name": "stage5_pass_ratio"}]})
    return spark.createDataFrame([(i, s["name"]) for i, s in enumerate(steps)], "step int, processor string")


@query("o05_phases", "SELECT * FROM (VALUES (1, 'text_cleaning'), (1, 'length_filter'), (2, 'exact_dedup'), (2, 'fuzzy_dedup'), (3, 'pass_ratio_filter')) v(phase, processor)")
def phases(spark, d):
    """A pipeline split for incremental addition."""
    parts = runner.phases_of([{"name": n} for n in ("text_cleaning", "exact_dedup", "length_filter", "fuzzy_dedup", "pass_ratio_filter")])
    return spark.createDataFrame([(i + 1, s["name"]) for i, p in enumerate(parts) for s in p], "phase int, processor string")


def _stream(spark, d, name: str = "canonical_records") -> DataFrame:
    return streams.read(spark, f"{d}/{name[:-1]}[{name[-1]}].parquet", spark.read.parquet(f"{d}/{name}.parquet").schema)


@query("z02_stream_dedup", f"SELECT count(DISTINCT lower({q.strip('coalesce(question, chr(32))')})) AS records FROM canonical_records")
def stream_dedup(spark, d):
    """First arrivals of each text over a stream of files, within a watermark as wide as the table."""
    path = runtime.scratch(spark, "stream")
    s = _stream(spark, d).select("record_id", "question", "ingested_at").withColumn("ingested_at", F.coalesce("ingested_at", F.lit("2000-01-01").cast("timestamp")))
    streams.write(streams.deduplicate(s, within="36500 days"), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out").agg(F.count("*").alias("records"))


@query("z03_stream_counts", "SELECT epoch(time_bucket(INTERVAL '1 hour', ts::TIMESTAMP))::BIGINT AS start, event_type AS dataset_name, count(*) AS records FROM events GROUP BY 1, 2")
def stream_counts(spark, d):
    """Windowed counts over a stream; the closing batch ends when the watermark passes the last window."""
    path = runtime.scratch(spark, "stream")
    s = _stream(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ingested_at"), F.col("event_type").alias("dataset_name"))
    streams.counts(s).writeStream.outputMode("complete").format("memory").queryName((name := "counts_" + path[-12:])).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).withColumn("start", F.unix_timestamp("start"))


query("o03_registry", "SELECT unnest(['answer_judge', 'answer_quality_filter', 'boolean_answer_filter', 'broken_question_filter', 'cot_cleaning', 'decontam_embed', 'decontam_load', 'decontam_search', 'decontamination', 'dedup_judge', 'difficulty_annotation', 'empty_answer_tagger', 'exact_dedup', 'fuzzy_dedup', 'gzip_ratio_annotator', 'instruction_wrapper_cleaner', 'language_filter', 'length_filter', 'llm_classifier', 'math_filter', 'mcq_converter', 'meta_task_filter', 'missing_context_filter', 'ngram_repetition_filter', 'pass_ratio_filter', 'phantom_reference_filter', 'prompt_contamination_filter', 'rollout_correctness', 'rule_correctness', 'sample_answer_judge', 'text_cleaning', 'text_normalize', 'token_count_annotator']) AS processor")(lambda s, d: s.createDataFrame([(n,) for n in sorted(clean.PROCESSORS)], "processor string"))


@query("o10_resources", "SELECT true AS measured")
def resources(spark, d):
    """Whether the memory of this process and of its children is read."""
    m = runtime.resources()
    return spark.createDataFrame([(min(m.values()) >= 0 and m["rss"] > 0 and m["child_rss"] > 0,)], "measured boolean")


query("d08_tiers", "SELECT dataset_name, tier FROM (SELECT dataset_name, min(tier) AS tier FROM dataset_tiers WHERE dataset_name IS NOT NULL GROUP BY 1) UNION ALL SELECT 'new-dataset', 9")(lambda s, d: s.createDataFrame([(n, t) for t, names in dedup.augment_tiers(_tier_lists(s, d), 9, ["new-dataset", *(x for ns in _tier_lists(s, d).values() for x in ns)]).items() for n in names], "dataset_name string, tier int"))
query("f35_event_time", "SELECT count(*) AS events, count(*) AS with_time FROM canonical_records")(lambda s, d: clean.length_filter(records(s, d).withColumn("trace", F.lit("[]"))).select(F.element_at("trace", -1)["created_at"].alias("t")).agg(F.count("*").alias("events"), F.count_if(F.col("t").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}(?:Z|[+-]\d{2}:\d{2})$")).alias("with_time")))
