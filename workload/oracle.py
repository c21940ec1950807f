"""SQL for the checking database, written from the operator definitions.

RE2 has no lookaround. Tests for existence consume the neighbouring characters
instead; counts with context first double every character, so that neighbouring
matches do not compete for a shared one.
"""

from pairloom.functions import text as tx
from workload import queries as wq
from workload.fixtures import PAIRS, TEXTS

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LATIN = "".join("-".join(rf"\x{{{bound}}}" for bound in item.split("-")) for item in tx.LATIN_RANGES.split())
WORD = r"\p{L}\p{N}_"
ALNUM = r"\p{L}\p{N}"
QUOTES = "\"'„“”‚‘’«»"
OPENERS, CLOSERS, PARTNERS = "([{«‹“„‘‚", ")]}»›”’", "([{«‹“‘"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace_all(x: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(by)}, '{flags}')"


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)})"


# --- changes ------------------------------------------------------------------


def strip(x):
    return f"trim({x}, {lit(tx.WHITESPACE)})"


def spacing(x):
    # Twice: a match consumes the word character that the next match may need.
    pattern = f"([{WORD}])['’][{WS}]+([{WORD}])"
    return replace_all(replace_all(x, pattern, r"\1'\2"), pattern, r"\1'\2")


CHANGES = {
    "strip_edges": strip,
    "remove_control_chars": lambda x: replace_all(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""),
    "collapse_whitespace": lambda x: replace_all(x, f"[{WS}]+", " "),
    "normalize_unicode_quotes": lambda x: f"translate({x}, {lit('’‘‚‛‹›“”„‟«»')}, {lit(chr(39) * 6 + chr(34) * 6)})",
    "fix_apostrophe_spacing": spacing,
}

# --- predicates ---------------------------------------------------------------


def url(x):
    domain = (
        rf"(?:(?:^|[^{WORD}])[A-Za-z0-9]|[{WORD}]-)[A-Za-z0-9-]*\.(?:[A-Za-z0-9-]+\.)*[A-Za-z]{{2,}}"
    )
    return matches(x, rf"(?:https?|ftp)://|www\.|{domain}")


def email(x):
    return matches(
        x,
        rf"(?:(?:^|[^{WORD}])[A-Za-z0-9_]|[{WORD}][.%+-])[A-Za-z0-9._%+-]*"
        rf"@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}(?:$|[^{WORD}])",
    )


def odd_quotes(x):
    doubled = replace_all(x, "(.)", r"\1\1", "gs")
    mark = "(?:''|’’)"
    apostrophe = f"[sS]{mark}(?:[^{ALNUM}]|$)|[{ALNUM}]{mark}(?:[{ALNUM}]|[{WS}][{WS}][sS])"
    quotes = f"length({replace_all(x, f'[^{QUOTES}]', '')})"
    return f"(({quotes} - len(regexp_extract_all({doubled}, {lit(apostrophe)}))) % 2 = 1)"


def unbalanced(x):
    both = "[" + "".join("\\" + c if c in "()[]{}" else c for c in OPENERS + CLOSERS) + "]"
    step = (
        "lambda s, c: CASE WHEN s = '!' THEN s "
        f"WHEN contains({lit(OPENERS)}, c) THEN s || c "
        f"WHEN right(s, 1) = translate(c, {lit(CLOSERS)}, {lit(PARTNERS)}) THEN left(s, length(s) - 1) "
        "ELSE '!' END"
    )
    return f"(list_reduce(regexp_extract_all({x}, {lit(both)}), {step}, '') <> '')"


def not_latin(x):
    letters = f"length({replace_all(x, r'[^\p{L}]', '')})"
    latin = f"length({replace_all(x, f'[^{LATIN}]', '')})"
    return f"({letters} >= 20 AND {latin} / greatest({letters}, 1)::DOUBLE < 0.6::DOUBLE)"


PREDICATES = {
    "is_too_short": lambda x: f"(length({x}) < 10)",
    "is_too_long": lambda x: f"(length({x}) > 5000)",
    "is_blank": lambda x: f"({strip(x)} = '')",
    "contains_german_chars": lambda x: matches(x, "[äöüÄÖÜß]"),
    "contains_email": email,
    "contains_control_chars": lambda x: matches(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{80}-\x{9f}]"),
    "contains_invisible_format_chars": lambda x: matches(x, r"\p{Cf}"),
    "contains_url": url,
    "has_odd_number_of_quotes": odd_quotes,
    "has_unbalanced_brackets": unbalanced,
    "target_not_latin_like": not_latin,
}


def bad_ratio(x, y):
    ratio = f"(length({x})::DOUBLE / greatest(length({y}), 1)::DOUBLE)"
    return f"(length({x}) = 0 OR length({y}) = 0 OR {ratio} < 0.33::DOUBLE OR {ratio} > 3::DOUBLE)"


def equal(x, y):
    return f"(lower({x}) = lower({y}))"


def rejected(key):
    digest = f"substr(md5(concat('reject:{wq.REJECT['seed']}:', CAST({key} AS VARCHAR))), 1, 8)"
    return f"(CAST('0x' || {digest} AS BIGINT) / 4294967296.0::DOUBLE < {wq.REJECT['prob']}::DOUBLE)"


# --- stages as common table expressions ---------------------------------------

NAMES = ("de", "en")


def _norm_ctes() -> str:
    """n0 (raw) to n4 (all changes), each with the texts of the steps before."""
    ctes = [f"pairs AS ({PAIRS})", "n0 AS (SELECT id, de AS de0, en AS en0 FROM pairs)"]
    for k, name in enumerate(wq.CHAIN, start=1):
        steps = ", ".join(f"{CHANGES[name](f'{s}{k - 1}')} AS {s}{k}" for s in NAMES)
        ctes.append(f"n{k} AS (SELECT *, {steps} FROM n{k - 1})")
    changed = ", ".join(
        "concat_ws('|', "
        + ", ".join(f"CASE WHEN {s}{k} <> {s}{k - 1} THEN '{name}' END" for k, name in enumerate(wq.CHAIN, start=1))
        + f") AS {s}_changes"
        for s in NAMES
    )
    last = len(wq.CHAIN)
    ctes.append(f"normed AS (SELECT id, de0, en0, de{last} AS de, en{last} AS en, {changed} FROM n{last})")
    return "WITH " + ",\n".join(ctes)


NORM = _norm_ctes()


def _label(entry) -> tuple[str, str]:
    if isinstance(entry, str):
        return entry, entry
    name, options = entry
    return name, f"{name}({', '.join(f'{k}={v}' for k, v in options.items())})"


def _flaw_cte() -> str:
    columns = []
    for s in NAMES:
        tests = [_label(entry) for entry in wq.TEXT_FLAWS]
        cases = ", ".join(f"CASE WHEN {PREDICATES[name](s)} THEN '{label}' END" for name, label in tests)
        columns.append(f"concat_ws('|', {cases}) AS {s}_flaws")
    pair = [(bad_ratio, wq.PAIR_FLAWS[0]), (equal, wq.PAIR_FLAWS[1])]
    cases = ", ".join(f"CASE WHEN {f('de', 'en')} THEN '{_label(entry)[1]}' END" for f, entry in pair)
    columns.append(f"concat_ws('|', {cases}) AS pair_flaws")
    return f"flawed AS (SELECT id, de, en, {', '.join(columns)} FROM normed)"


CLEAN = "clean AS (SELECT id, de, en FROM flawed WHERE de_flaws = '' AND en_flaws = '' AND pair_flaws = '')"
FLAWS = f"{NORM},\n{_flaw_cte()}"
KEPT = f"{FLAWS},\n{CLEAN}"


def words(x: str) -> str:
    return (
        f"list_transform(list_filter(regexp_split_to_array({x}, {lit(f'[{WS}]+')}), lambda w: w <> ''), "
        "lambda w: length(w))"
    )


def encoded(source: str, limit: int | None = None) -> str:
    cut = "" if limit is None else f"[1:{limit}]"
    columns = ", ".join(f"({words(s)}){cut} AS {s}_ids" for s in NAMES)
    return f"encoded AS (SELECT *, {columns} FROM {source})"


def ids(x: str) -> str:
    return f"array_to_string({x}, ' ')"


TOKENS = f"SELECT id, {ids('de_ids')} AS de_ids, {ids('en_ids')} AS en_ids, CAST(len(de_ids) AS INT) AS de_mask, CAST(len(en_ids) AS INT) AS en_mask FROM encoded"
SHORT = f"len(de_ids) <= {wq.MAX_SEQ_LEN} AND len(en_ids) < {wq.MAX_SEQ_LEN}"


def marked(x: str, bos: int, eos: int) -> str:
    first = f"(CASE WHEN len({x}) > 0 AND {x}[1] = {bos} THEN {x} ELSE list_concat([{bos}], {x}) END)"
    return f"(CASE WHEN len({first}) > 0 AND {first}[-1] = {eos} THEN {first} ELSE list_concat({first}, [{eos}]) END)"


def counts(table: str, suffix: str) -> str:
    """Per label the occurrences on each side, from joined label columns."""
    parts = " UNION ALL ".join(
        f"SELECT unnest(string_split({s}_{suffix}, '|')) AS label, '{s}' AS side FROM {table} WHERE {s}_{suffix} <> ''"
        for s in NAMES
    )
    sides = ", ".join(f"count(*) FILTER (WHERE side = '{s}') AS {s}" for s in NAMES)
    return f"SELECT label, {sides}, count(*) AS total FROM ({parts}) GROUP BY label"


def histogram(source: str, max_bins: int) -> str:
    """``source`` selects the columns de and en."""
    return f"""lengths AS ({source}),
both_sides AS (SELECT 'de' AS side, de AS v FROM lengths UNION ALL SELECT 'en', en FROM lengths),
span AS (SELECT min(v) AS low, max(v) - min(v) + 1 AS span FROM both_sides),
width AS (SELECT low, span, greatest(1, CAST(ceil(span / {max_bins}.0) AS BIGINT)) AS w FROM span),
bins AS (SELECT unnest(range(CAST(ceil(span / CAST(w AS DOUBLE)) AS BIGINT))) AS bin FROM width),
hits AS (SELECT (v - low) // w AS bin, side FROM both_sides, width)
SELECT b.bin, low - 0.5::DOUBLE + b.bin * w AS lower, low - 0.5::DOUBLE + b.bin * w + w AS upper,
  count(*) FILTER (WHERE side = 'de') AS de, count(*) FILTER (WHERE side = 'en') AS en
FROM bins b CROSS JOIN width LEFT JOIN hits h ON h.bin = b.bin GROUP BY b.bin, low, w"""


def shuffled(key: str) -> str:
    return f"md5(concat('{wq.SEED}:', CAST({key} AS VARCHAR)))"


def membership(ratios: dict[str, float], columns: str = "doc_id AS id") -> str:
    """Splits by position in the seeded order."""
    ends, share = [], 0.0
    for ratio in list(ratios.values())[:-1]:
        share += ratio
        ends.append(f"round_even(total * {share!r}::DOUBLE, 0)")
    names = list(ratios)
    cases = " ".join(f"WHEN place <= {end} THEN '{name}'" for name, end in zip(names, ends))
    return (
        f"members AS (SELECT * EXCLUDE (place, total), CASE {cases} ELSE '{names[-1]}' END AS split FROM "
        f"(SELECT {columns}, row_number() OVER (ORDER BY {shuffled('doc_id')}, doc_id) AS place, "
        "count(*) OVER () AS total FROM documents))"
    )


TRAINING = f"{KEPT}, {encoded('clean')}, training AS (SELECT id, de_ids AS src_ids, {marked('en_ids', 1, 0)} AS tgt_ids FROM encoded WHERE {SHORT})"
TRAINING_ROWS = f"{TRAINING} SELECT id, {ids('src_ids')} AS src_ids, {ids('tgt_ids')} AS tgt_ids FROM training"


def _decoded(x: str) -> str:
    real = f"list_filter({x}, lambda i: i <> 0)"
    return f"array_to_string(list_transform({real}, lambda i: repeat('x', i)), ' ')"


def _stage_counts() -> str:
    parts = {
        "load": "SELECT count(*) FROM pairs",
        "norm": "SELECT count(*) FROM pairs",
        "filter": "SELECT count(*) FROM clean",
        "tokenize": "SELECT count(*) FROM training",
        "map": "SELECT count(*) FROM training",
        "dataset": "SELECT count(*) FROM training",
        "norm_report": "SELECT count(*) FROM normed WHERE de_changes <> '' OR en_changes <> ''",
        "filter_report": "SELECT count(*) FROM flawed WHERE de_flaws <> '' OR en_flaws <> '' OR pair_flaws <> ''",
        "tokenize_report": "SELECT count(*) FROM clean",
    }
    rows = " UNION ALL ".join(f"SELECT '{stage}' AS stage, ({sql}) AS row_count" for stage, sql in parts.items())
    return f"{TRAINING} {rows}"


def _stage_contents() -> str:
    def digest(*values):
        return "md5(concat_ws('/', " + ", ".join(f"coalesce(CAST({v} AS VARCHAR), '-')" for v in values) + "))"

    lengths = [f"CASE WHEN {SHORT} THEN len({s}_ids) END" for s in NAMES] + [f"CASE WHEN NOT ({SHORT}) THEN id END"]
    flawed = "de_flaws <> '' OR en_flaws <> '' OR pair_flaws <> ''"
    parts = {
        "load": f"SELECT id, {digest('de0', 'en0')} AS content FROM normed",
        "norm": f"SELECT id, {digest('de', 'en')} FROM normed",
        "filter": f"SELECT id, {digest('de', 'en')} FROM clean",
        "tokenize": f"SELECT id, {digest(ids('de_ids'), ids('en_ids'))} FROM encoded WHERE {SHORT}",
        "map": f"SELECT id, {digest(ids('src_ids'), ids('tgt_ids'))} FROM training",
        "norm_report": f"SELECT id + 1, {digest('de_changes', 'en_changes')} FROM normed WHERE de_changes <> '' OR en_changes <> ''",
        "filter_report": f"SELECT id + 1, {digest('de_flaws', 'en_flaws', 'pair_flaws')} FROM flawed WHERE {flawed}",
        "tokenize_report": f"SELECT row_number() OVER (ORDER BY id), {digest(*lengths)} FROM encoded",
    }
    return f"{TRAINING} " + " UNION ALL ".join(f"SELECT '{stage}' AS stage, * FROM ({sql})" for stage, sql in parts.items())


def _page_flaws() -> str:
    labels = {name: _label([name, wq.OPTIONS[name]] if name in wq.OPTIONS else name)[1] for name in PREDICATES}
    cases = ", ".join(f"CASE WHEN {PREDICATES[name]('html')} THEN '{labels[name]}' END" for name in PREDICATES)
    return f"SELECT page_id AS id, concat_ws('|', {cases}) AS flaws FROM pages"


def _page_norm() -> str:
    ctes = ["n0 AS (SELECT page_id AS id, html AS t0 FROM pages)"]
    for k, sql in enumerate(CHANGES.values(), start=1):
        ctes.append(f"n{k} AS (SELECT *, {sql(f't{k - 1}')} AS t{k} FROM n{k - 1})")
    changed = ", ".join(f"CASE WHEN t{k} <> t{k - 1} THEN '{name}' END" for k, name in enumerate(CHANGES, start=1))
    last = len(CHANGES)
    return f"WITH {', '.join(ctes)} SELECT id, t{last} AS html, concat_ws('|', {changed}) AS changes FROM n{last}"


PAIRS_CTE = f"WITH pairs AS ({PAIRS})"
REPORT = "SELECT id + 1 AS seq_no"
CHANGED = "FROM normed WHERE de_changes <> '' OR en_changes <> ''"

# Rows of the slices, numbered one after the other.
SLICED = """WITH placed AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents),
  bounds AS (SELECT *, CAST(round_even(n * 10 / 100, 0) AS BIGINT) AS low, CAST(round_even(n * 35 / 100, 0) AS BIGINT) AS high FROM placed),
  sliced AS (SELECT *, r AS id FROM bounds WHERE r < 40
    UNION ALL SELECT *, 40 + r - low AS id FROM bounds WHERE r >= low AND r < high
    UNION ALL SELECT *, 40 + high - low + r - (n - 7) AS id FROM bounds WHERE r >= n - 7)"""
_TAIL = "CASE doc_id % 6 WHEN 0 THEN chr(1) WHEN 1 THEN chr(228) WHEN 2 THEN chr(10) WHEN 3 THEN chr(8232) WHEN 4 THEN chr(917505) ELSE '\\U0001f600' END"

ORACLE: dict[str, str] = {
    **{
        f"norm_{name}": f"WITH texts AS ({TEXTS}) SELECT id, after AS text, after <> text AS changed "
        f"FROM (SELECT id, text, {sql('text')} AS after FROM texts)"
        for name, sql in CHANGES.items()
    },
    "norm_chain": f"{NORM} SELECT id, de, en, de_changes, en_changes FROM normed",
    "norm_report": f"{NORM} {REPORT}, de_changes, en_changes {CHANGED}",
    "norm_report_debug": f"{NORM} {REPORT}, de0 AS de_before, de AS de_after, en0 AS en_before, en AS en_after {CHANGED}",
    "norm_change_counts": f"{NORM} {counts('normed', 'changes')}",
    **{
        f"flaw_{name}": f"WITH texts AS ({TEXTS}) SELECT id, {sql('text')} AS flawed FROM texts"
        for name, sql in PREDICATES.items()
    },
    "pair_bad_length_ratio": f"{PAIRS_CTE} SELECT id, {bad_ratio('de', 'en')} AS flawed FROM pairs",
    "pair_are_equal": f"{PAIRS_CTE} SELECT id, {equal('de', 'en')} AS flawed FROM pairs",
    "pair_reject_hash": f"{PAIRS_CTE} SELECT id, {rejected('id')} AS flawed FROM pairs",
    "filter_keep": f"{KEPT} SELECT id, de, en FROM clean",
    "filter_keep_labelled": f"{KEPT} SELECT id, de, en FROM clean",
    "flaw_report": f"{FLAWS} {REPORT}, de_flaws, en_flaws, pair_flaws FROM flawed "
    "WHERE de_flaws <> '' OR en_flaws <> '' OR pair_flaws <> ''",
    "flaw_counts": f"{FLAWS} {counts('flawed', 'flaws')}",
    "report_read": f"{FLAWS} {counts('flawed', 'flaws')}",
    "pair_flaw_counts": f"{FLAWS} SELECT label, count(*) AS total FROM (SELECT unnest(string_split(pair_flaws, '|')) "
    "AS label FROM flawed WHERE pair_flaws <> '') GROUP BY label",
    "page_flaws": _page_flaws(),
    "page_norm": _page_norm(),
    "load_ids": "SELECT 99 + row_number() OVER (ORDER BY n_chars DESC, doc_id) AS id, doc_id, n_chars FROM documents",
    "load_ids_overwrite": "SELECT row_number() OVER (ORDER BY source, doc_id) - 1 AS id, source, lang, doc_id AS old FROM documents",
    "load_file_order": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id, lang FROM documents",
    "load_first_n": "SELECT id, doc_id FROM (SELECT row_number() OVER (ORDER BY doc_id) + 4 AS id, doc_id FROM documents) "
    f"WHERE id < {wq.FIRST_N + 5}",
    "load_first_n_ordered": " UNION ALL ".join(
        f"SELECT {n} AS n, id, doc_id FROM (SELECT row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS id, doc_id FROM documents) WHERE id < {n}"
        for n in wq.FIRST_NS
    ),
    "load_split_range": f"{SLICED} SELECT id, doc_id, lang FROM sliced",
    "load_json_slices": f"{SLICED} SELECT id, doc_id, md5(text) AS de_md5 FROM sliced",
    "load_json_order": "SELECT row_number() OVER (ORDER BY doc_id) AS id, doc_id, text AS de, source AS en FROM documents",
    "load_json": f"{PAIRS_CTE} SELECT row_number() OVER (ORDER BY id DESC) - 1 AS id, id AS position, de, en FROM pairs",
    "load_json_columns": "SELECT doc_id AS id, lang, n_chars, text AS de, source AS en FROM documents",
    "load_json_flat": "SELECT row_number() OVER (ORDER BY doc_id DESC) - 1 AS id, doc_id AS old, lang AS de, source AS en FROM documents",
    "load_json_flat_text": "SELECT row_number() OVER (ORDER BY doc_id DESC) - 1 AS id, doc_id AS old, text AS de, text || source AS en FROM documents",
    "staged_contents": _stage_contents(),
    "staged_kept_ids": f"{FLAWS}, placed AS (SELECT *, row_number() OVER (ORDER BY id) AS seq_no FROM flawed JOIN "
    "(SELECT id, de_changes, en_changes FROM normed) USING (id)) "
    "SELECT 'norm' AS report, seq_no FROM placed WHERE de_changes <> '' OR en_changes <> '' UNION ALL "
    "SELECT 'filter', seq_no FROM placed WHERE de_flaws <> '' OR en_flaws <> '' OR pair_flaws <> '' "
    f"OR {rejected(wq.ROW_KEY)}",
    "report_read_debug": f"SELECT doc_id AS seq_no, CASE WHEN text IS NULL THEN NULL WHEN doc_id % 2 = 0 THEN text || {_TAIL} "
    "ELSE 'it''s ' || text END AS text, doc_id % 2 = 0 AS kept, CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS removed_id FROM documents",
    "report_read_whole": "SELECT doc_id AS seq_no, text || chr(92) || 'n' || chr(9) || chr(39) || chr(34) || chr(13) || chr(10) AS text FROM documents",
    "tokenize_words": f"{PAIRS_CTE}, {encoded('pairs')} {TOKENS}",
    "tokenize_external": f"{PAIRS_CTE}, {encoded('pairs')} {TOKENS}",
    "tokenize_truncated": f"{PAIRS_CTE}, {encoded('pairs', 12)} {TOKENS}",
    "tokenize_overlong": f"{PAIRS_CTE}, {encoded('pairs')} {TOKENS} WHERE {SHORT}",
    "tokenize_report": f"{KEPT}, {encoded('clean')} SELECT row_number() OVER (ORDER BY id) AS seq_no, "
    + ", ".join(f"CASE WHEN {SHORT} THEN CAST(len({s}_ids) AS INT) END AS {s}_length" for s in NAMES)
    + f", CASE WHEN NOT ({SHORT}) THEN id END AS removed_id FROM encoded",
    "map_training": f"{PAIRS_CTE}, {encoded('pairs')} SELECT id, {ids('en_ids')} AS src_ids, {ids('de_ids')} AS tgt_ids, "
    "en AS src_text, de AS tgt_text FROM encoded",
    "map_bos_eos": f"{PAIRS_CTE}, {encoded('pairs')} SELECT id, {ids('de_ids')} AS src_ids, "
    f"{ids(marked('en_ids', wq.BOS, wq.EOS))} AS tgt_ids FROM encoded",
    "preprocess_plan": TRAINING_ROWS,
    "preprocess_stream": TRAINING_ROWS,
    "preprocess_staged": _stage_counts(),
    "text_export": f"{TRAINING} SELECT {_decoded('src_ids')} AS src, {_decoded('tgt_ids')} AS ref, count(*) AS row_count "
    "FROM training GROUP BY ALL",
    "manifest": f"{TRAINING} SELECT CAST(1 AS INT) AS schema_version, 'word-length' AS tokenizer_model_name, 'de' AS src_lang, "
    "'en' AS tgt_lang, 'id' AS id_field, 'src_ids' AS src_field, 'tgt_ids' AS tgt_field, CAST(1 AS BIGINT) AS base_vocab_size, "
    "CAST(1 AS BIGINT) AS src_vocab_size, CAST(2 AS BIGINT) AS tgt_vocab_size, CAST(0 AS BIGINT) AS src_pad_id, "
    "CAST(0 AS BIGINT) AS tgt_pad_id, CAST(1 AS BIGINT) AS tgt_bos_id, CAST(0 AS BIGINT) AS tgt_eos_id, "
    f"count(*) AS num_examples, CAST({wq.MAX_SEQ_LEN} AS BIGINT) AS configured_max_seq_len FROM training",
    "shuffle_order": f"SELECT doc_id AS id, row_number() OVER (ORDER BY {shuffled('doc_id')}, doc_id) - 1 AS position FROM documents",
    "split_membership": f"WITH {membership(wq.RATIOS)} SELECT id, split FROM members",
    "split_counts": f"WITH {membership(wq.SMALL_RATIOS)} SELECT split, count(*) AS row_count FROM members GROUP BY split",
    "split_written_repeated_ids": f"WITH {membership(wq.SMALL_RATIOS)} SELECT split, count(*) AS row_count FROM members GROUP BY split "
    "UNION ALL SELECT 'distinct', count(*) FROM documents",
    "split_written": f"WITH {membership(wq.RATIOS, 'doc_id AS id, doc_id, n_chars')} SELECT id, n_chars, split AS split_name, "
    f"CAST({wq.SEED} AS BIGINT) AS split_seed, count(*) OVER (PARTITION BY split) AS num_examples, "
    "CAST(1024 AS BIGINT) AS base_vocab_size FROM members",
    "read_located": f"{PAIRS_CTE} SELECT id, de, en FROM pairs",
    "snapshot_json": f"{PAIRS_CTE} SELECT id, de, en FROM pairs",
    "snapshot_parquet": f"{PAIRS_CTE} SELECT id, de, en FROM pairs",
    "char_length_pairs": f"{PAIRS_CTE} SELECT CAST(length(de) AS INT) AS de, CAST(length(en) AS INT) AS en, count(*) AS row_count "
    "FROM pairs GROUP BY ALL",
    "char_length_hist": f"{PAIRS_CTE}, {histogram('SELECT length(de) AS de, length(en) AS en FROM pairs', 60)}",
    "token_length_hist": f"{PAIRS_CTE}, {encoded('pairs')}, {histogram('SELECT len(de_ids) AS de, len(en_ids) AS en FROM encoded', 40)}",
}
