"""The same results in plain SQL, one statement per query, for an independent engine."""

from __future__ import annotations

from wordloom import constants as K

WORD = r"\p{L}\p{N}_"
BLANK = r"\t-\r\x1C-\x20\x{85}\p{Z}"

SQL: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(items) -> str:
    return "(" + ", ".join(q(i) for i in items) + ")"


# --- text ---------------------------------------------------------------------------

def sub(x: str, pattern: str, new: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(new)}, '{flags}')"


STEPS = {
    "cl_template": lambda x: sub(x, r"\{\{.*?\}\}", "", "gs"),
    "cl_link_piped": lambda x: sub(x, r"\[\[[^\n]*?\|([^\n]+?)\]\]", r"\1"),
    "cl_link_plain": lambda x: sub(x, r"\[\[([^\n]+?)\]\]", r"\1"),
    "cl_heading": lambda x: sub(x, r"==+[^\n]*?==+", " "),
    "cl_tag": lambda x: sub(x, r"<[^>]+>", " "),
    "cl_url": lambda x: sub(x, rf"http[^{BLANK}]+", " "),
    "cl_charset": lambda x: sub(x, rf"[^{WORD}{BLANK}.,!?;:'-]", " "),
    "cl_space": lambda x: f"trim({sub(x, rf'[{BLANK}]+', ' ')})",
}


def clean(x: str) -> str:
    x = f"coalesce({x}, '')"
    for step in STEPS.values():
        x = step(x)
    return x


def english(x: str) -> str:
    return f"list_filter(regexp_extract_all(lower({x}), '[{WORD}]+'), lambda w: regexp_full_match(w, '[a-z]{{2,}}'))"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '[{WORD}]+|[^{WORD}{BLANK}]')"


def strip(x: str) -> str:
    return sub(sub(x, rf"^[{BLANK}]+", ""), rf"[{BLANK}]+$", "")


def checkable(t: str) -> str:
    return rf"(regexp_full_match({t}, '\p{{L}}+') AND {t} NOT IN ('a', 'i', 'A', 'I'))"


def rejoin(tokens_list: str) -> str:
    return sub(f"array_to_string({tokens_list}, ' ')", rf"[{BLANK}]+([.,!?;:])", r"\1")


# --- common table expressions -------------------------------------------------------------

ARTICLES = "articles AS (SELECT doc_id, source || ' ' || doc_id AS title, text FROM documents)"

WIKI = """wiki AS (
  SELECT doc_id,
    CASE source WHEN 'src0' THEN 'File:' || doc_id WHEN 'src1' THEN 'Category:' || doc_id
      WHEN 'src2' THEN 'Template:' || doc_id WHEN 'src3' THEN 'Wikipedia:' || doc_id
      WHEN 'src4' THEN 'Help:' || doc_id WHEN 'src5' THEN 'MediaWiki:' || doc_id
      WHEN 'src6' THEN '' ELSE source || ' ' || doc_id END AS title,
    CASE source WHEN 'src7' THEN '#REDIRECT [[' || lang || ']]' WHEN 'src8' THEN NULL
      ELSE '{{box|x' || chr(10) || 'y}} == Head == [[a]] and [[src|' || lang || ']] <b>' || text
        || '</b> http://x.y/' || doc_id END AS text
  FROM documents)"""

NAMESPACES = " OR ".join(f"starts_with(title, {q(p)})" for p in K.NAMESPACE_PREFIXES)
GATES = f"title <> '' AND text <> '' AND NOT starts_with(text, '#REDIRECT') AND NOT ({NAMESPACES})"


def accepted(source: str) -> str:
    return f"""cleaned AS MATERIALIZED (SELECT doc_id, {clean('text')} AS clean FROM {source} WHERE {GATES}),
accepted AS MATERIALIZED (SELECT doc_id, words FROM (SELECT doc_id, {english('clean')} AS words FROM cleaned WHERE length(clean) > {K.MIN_CLEAN_CHARS})
  WHERE len(words) > {K.MIN_ARTICLE_WORDS})"""


VOCAB = f"""{ARTICLES}, {accepted('articles')},
vocab AS MATERIALIZED (SELECT word, count(*) AS freq FROM (SELECT unnest(words) AS word FROM accepted) GROUP BY word)"""

DICTIONARY = f"""dictionary AS MATERIALIZED (SELECT word, CASE WHEN count >= {K.TABLE_MIN_FREQ} THEN count ELSE 0 END AS freq, rank FROM
  (SELECT word, freq AS count, row_number() OVER (ORDER BY freq DESC, word) AS rank FROM vocab) WHERE rank <= {K.DICTIONARY_SIZE})"""
DICT = f"{VOCAB}, {DICTIONARY}"

CANDIDATES = f"""{DICT},
candidates AS MATERIALIZED (SELECT row_number() OVER (ORDER BY freq DESC, word) - 1 AS idx, word, freq FROM vocab
  WHERE freq >= {K.TABLE_MIN_FREQ} AND length(word) BETWEEN {K.MIN_WORD_LENGTH} AND {K.MAX_WORD_LENGTH} QUALIFY idx < {K.CANDIDATE_WORDS}),
sizes AS MATERIALIZED (SELECT count(*) AS n, {K.ERROR_SAMPLES} AS errors, {K.CORRECT_SAMPLES} AS correct FROM candidates)"""


def u(key: str, index: int, seed: int = K.SEED) -> str:
    block, slot = divmod(index, 4)
    return f"('0x' || substr(md5({key} || ':{seed}:{block}'), {slot * 8 + 1}, 8))::BIGINT"


def chance(draw: str, p: float) -> str:
    return f"({draw} < {int(p * (1 << 32))})"


def case_of(letter: str, table: dict[str, str]) -> str:
    return f"CASE {letter} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + " END"


# Draw numbers, as agreed: type, position, branch, choice, second branch, letter, candidate.
def insertion(w: str, key: str) -> str:
    n, pos = f"length({w})", f"({u(key, 1)} % length({w}) + 1)"
    letter = f"substr({q(K.ALPHABET)}, {u(key, 5)} % 26 + 1, 1)"
    added = f"CASE WHEN {chance(u(key, 2), K.P_DOUBLE_LETTER)} AND {pos} < {n} THEN substr({w}, {pos} + 1, 1) ELSE {letter} END"
    return f"CASE WHEN {n} >= 3 THEN substr({w}, 1, {pos}) || {added} || substr({w}, {pos} + 1) END"


def deletion(w: str, key: str) -> str:
    vowels = f"list_filter(range(1, length({w}) + 1), lambda i: substr({w}, i, 1) IN {in_list(K.VOWELS)})"
    pos = (
        f"CASE WHEN len({vowels}) > 0 AND {chance(u(key, 2), K.P_DROP_VOWEL)} "
        f"THEN {vowels}[{u(key, 3)} % greatest(len({vowels}), 1) + 1] ELSE {u(key, 1)} % greatest(length({w}) - 2, 1) + 2 END"
    )
    return f"CASE WHEN length({w}) >= 4 THEN substr({w}, 1, ({pos}) - 1) || substr({w}, ({pos}) + 1) END"


def substitution(w: str, key: str) -> str:
    pos = f"({u(key, 1)} % greatest(length({w}) - 1, 1) + 2)"
    old = f"lower(substr({w}, {pos}, 1))"
    near, mixed = f"({case_of(old, K.KEYBOARD_NEIGHBOURS)})", f"({case_of(old, K.LETTER_CONFUSIONS)})"
    others = f"replace({q(K.ALPHABET)}, {old}, '')"
    new = (
        f"CASE WHEN {near} IS NOT NULL AND {chance(u(key, 2), K.P_KEYBOARD)} THEN substr({near}, {u(key, 3)} % length({near}) + 1, 1) "
        f"WHEN {mixed} IS NOT NULL AND {chance(u(key, 4), K.P_CONFUSION)} THEN {mixed} "
        f"ELSE substr({others}, {u(key, 5)} % length({others}) + 1, 1) END"
    )
    return f"CASE WHEN length({w}) >= 3 THEN substr({w}, 1, {pos} - 1) || {new} || substr({w}, {pos} + 1) END"


def transposition(w: str, key: str) -> str:
    pos = f"({u(key, 1)} % greatest(length({w}) - 1, 1) + 1)"
    return (
        f"CASE WHEN length({w}) >= 3 THEN substr({w}, 1, {pos} - 1) || substr({w}, {pos} + 1, 1) "
        f"|| substr({w}, {pos}, 1) || substr({w}, {pos} + 2) END"
    )


GENERATORS = {
    "insertion": insertion, "deletion": deletion, "substitution": substitution, "transposition": transposition,
}


def drawn_type(key: str) -> str:
    return f"[{', '.join(q(t) for t in K.ERROR_TYPES)}][{u(key, 0)} % 4 + 1]"


def misspell(w: str, kind: str, key: str) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN {q(t)} THEN {g(w, key)}" for t, g in GENERATORS.items()) + " END"


PAIRS = f"""{VOCAB},
typed AS (SELECT word AS correct_word, freq, {drawn_type('word')} AS error_type FROM vocab
  WHERE length(word) BETWEEN {K.MIN_WORD_LENGTH} AND {K.MAX_WORD_LENGTH}),
pairs AS MATERIALIZED (SELECT *, length(correct_word)::INTEGER AS word_length FROM
  (SELECT *, {misspell('correct_word', 'error_type', 'correct_word')} AS incorrect_word FROM typed)
  WHERE incorrect_word IS NOT NULL)"""


def gate(source: str, words: str) -> str:
    return (
        f"SELECT * FROM {source} WHERE incorrect_word IS NOT NULL AND incorrect_word <> correct_word "
        f"AND levenshtein(correct_word, incorrect_word) = 1 AND incorrect_word NOT IN (SELECT word FROM {words})"
    )


DRAWS = f"""{CANDIDATES},
attempts AS (SELECT unnest(range((SELECT errors * {K.ATTEMPTS_PER_SAMPLE} FROM sizes))) AS attempt),
draws AS MATERIALIZED (SELECT a.attempt, c.word, c.freq FROM
  (SELECT attempt, {u('attempt', 6)} % (SELECT n FROM sizes) AS idx FROM attempts) a JOIN candidates c USING (idx))"""

ROW = """correct_word, incorrect_word, error_type, edit_distance::INTEGER AS edit_distance,
  length(correct_word)::INTEGER AS word_length, word_frequency::BIGINT AS word_frequency"""

ERRORS = f"""{DRAWS},
tried AS (SELECT attempt, word AS correct_word, freq AS word_frequency, {drawn_type('attempt')} AS error_type FROM draws),
made AS (SELECT *, {misspell('correct_word', 'error_type', 'attempt')} AS incorrect_word FROM tried),
errors AS MATERIALIZED (SELECT id, {ROW} FROM (SELECT *, 1 AS edit_distance, row_number() OVER (ORDER BY attempt) AS id FROM ({gate('made', 'dictionary')}))
  WHERE id <= (SELECT errors FROM sizes))"""

CHOSEN = f"""chosen AS MATERIALIZED (SELECT word, freq, row_number() OVER (ORDER BY md5('sample:{K.SEED}:' || word), word) AS pick
  FROM candidates QUALIFY pick <= (SELECT correct FROM sizes))"""

CORRECT = f"""{CHOSEN},
correct AS (SELECT 0::BIGINT AS id, {ROW} FROM (SELECT word AS correct_word, word AS incorrect_word, 'correct' AS error_type,
  0 AS edit_distance, freq AS word_frequency FROM chosen))"""


def shuffled(source: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY md5('order:{K.SEED}:' || id || ':' || correct_word || ':' || incorrect_word),
  id, correct_word, incorrect_word) AS id, * EXCLUDE (id) FROM {source}"""


DATASET = f"""{ERRORS}, {CORRECT},
everything AS (SELECT * FROM errors UNION ALL SELECT * FROM correct),
dataset AS MATERIALIZED ({shuffled('everything')})"""


# --- features ---------------------------------------------------------------------------------

def vowels_in(w: str) -> str:
    return f"len(regexp_extract_all(lower({w}), '[aeiou]'))"


def doubles(w: str) -> str:
    return f"len(list_filter(range(1, length({w})), lambda i: substr({w}, i, 1) = substr({w}, i + 1, 1)))"


def syllables(w: str) -> str:
    return f"greatest(1, len(regexp_extract_all(lower({w}), '[aeiou]+')) - (CASE WHEN lower({w}) LIKE '%e' THEN 1 ELSE 0 END))"


def longest(w: str, cls: str) -> str:
    return f"coalesce(list_max(list_transform(regexp_extract_all(lower({w}), '{cls}+'), lambda r: length(r))), 0)"


def distinct(w: str, cls: str) -> str:
    return f"len(list_distinct(regexp_extract_all(lower({w}), '{cls}')))"


def repeated(w: str) -> str:
    return f"regexp_matches(regexp_replace(lower({w}), '[^aeiou]', '', 'g'), 'aa|ee|ii|oo|uu')"


def alternating(w: str) -> str:
    return f"(length({w}) >= 3 AND regexp_full_match(lower({w}), '[aeiou]?([^aeiou][aeiou])*[^aeiou]?'))"


def vowel_flag(letter: str) -> str:
    return f"(lower({letter}) IN {in_list(K.VOWELS)})::INTEGER"


def features(w: str, n: str, first=K.FIRST_BIGRAMS, last=K.LAST_BIGRAMS) -> dict[str, str]:
    middle = f"substr({w}, length({w}) // 2 + 1, 1)"
    return {
        "num_vowels": f"{vowels_in(w)}::INTEGER",
        "num_consonants": f"(length({w}) - {vowels_in(w)})::INTEGER",
        "vowel_ratio": f"round({vowels_in(w)}::DOUBLE / {n}, 6)",
        "consonant_ratio": f"round((length({w}) - {vowels_in(w)})::DOUBLE / {n}, 6)",
        "first_char": f"left({w}, 1)", "last_char": f"right({w}, 1)",
        "first_bigram": f"left({w}, 2)", "last_bigram": f"right({w}, 2)",
        "first_trigram": f"left({w}, 3)", "last_trigram": f"right({w}, 3)",
        "first_bigram_common": f"(left({w}, 2) IN {in_list(first)})::INTEGER",
        "last_bigram_common": f"(right({w}, 2) IN {in_list(last)})::INTEGER",
        "has_double_letters": f"({doubles(w)} > 0)::INTEGER",
        "num_double_letters": f"{doubles(w)}::INTEGER",
        "has_repeated_vowels": f"{repeated(w)}::INTEGER",
        "is_alternating": f"{alternating(w)}::INTEGER",
        "syllable_count": f"{syllables(w)}::INTEGER",
        "syllable_ratio": f"round({syllables(w)}::DOUBLE / {n}, 6)",
        "max_consonant_cluster": f"{longest(w, '[^aeiou]')}::INTEGER",
        "max_vowel_cluster": f"{longest(w, '[aeiou]')}::INTEGER",
        "char_diversity": f"round(len(list_distinct(string_split({w}, '')))::DOUBLE / length({w}), 6)",
        "unique_vowels": f"{distinct(w, '[aeiou]')}::INTEGER",
        "unique_consonants": f"{distinct(w, '[^aeiou]')}::INTEGER",
        "starts_with_vowel": vowel_flag(f"left({w}, 1)"),
        "ends_with_vowel": vowel_flag(f"right({w}, 1)"),
        "middle_char": middle,
        "middle_is_vowel": vowel_flag(middle),
    }


def listed(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {name}" for name, e in exprs.items())


FEATURED = f"""{DATASET},
featured AS MATERIALIZED (SELECT *, {listed(features('incorrect_word', 'word_length'))} FROM dataset)"""

ENCODED_COLUMNS = ("error_type",) + K.CATEGORICAL
ENCODED = f"""{FEATURED},
encoded AS MATERIALIZED (SELECT *, {', '.join(f'(dense_rank() OVER (ORDER BY {c}) - 1)::INTEGER AS {c}_encoded' for c in ENCODED_COLUMNS)} FROM featured)"""

# The features once more without rounding, for results that build on them.
_RAW = {k: v for k, v in features("incorrect_word", "word_length").items()}
for _k in ("vowel_ratio", "consonant_ratio", "syllable_ratio", "char_diversity"):
    _RAW[_k] = _RAW[_k].removeprefix("round(").removesuffix(", 6)")
RAW_ENCODED = f"""{DATASET},
featured AS MATERIALIZED (SELECT *, {listed(_RAW)} FROM dataset),
encoded AS MATERIALIZED (SELECT *, {', '.join(f'(dense_rank() OVER (ORDER BY {c}) - 1)::INTEGER AS {c}_encoded' for c in ENCODED_COLUMNS)} FROM featured)"""

GROUPS = f"""groups AS MATERIALIZED (SELECT correct_word, row_number() OVER (ORDER BY md5('split:{K.SEED}:' || correct_word), correct_word) AS r,
  count(*) OVER () AS g FROM (SELECT DISTINCT correct_word FROM dataset)),
split AS MATERIALIZED (SELECT d.*, CASE WHEN r <= ceil(ceil(g * {K.HELD_OUT_SHARE}::DOUBLE) * {K.TEST_SHARE_OF_HELD_OUT}::DOUBLE) THEN 'test'
  WHEN r <= ceil(g * {K.HELD_OUT_SHARE}::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM dataset d JOIN groups USING (correct_word))"""
SPLIT = f"{DATASET}, {GROUPS}"

CLASSES = ("correct", "deletion", "insertion", "substitution")
RULES = ("length_rule", "noisy_rule", "double_rule")


def rule(name: str) -> str:
    def length_rule(tie: str) -> str:
        return f"CASE WHEN length(incorrect_word) > length(correct_word) THEN 'insertion' WHEN length(incorrect_word) < length(correct_word) THEN 'deletion' ELSE {tie} END"

    plain = length_rule(f"CASE WHEN {u('incorrect_word', 0, 7)} % 2 = 0 THEN 'substitution' ELSE 'correct' END")
    if name == "length_rule":
        return plain
    if name == "noisy_rule":
        other = f"[{', '.join(q(c) for c in CLASSES)}][{u('incorrect_word', 2, 7)} % 4 + 1]"
        return f"CASE WHEN {chance(u('incorrect_word', 1, 7), 0.2)} THEN {other} ELSE {plain} END"
    return length_rule(f"CASE WHEN {doubles('incorrect_word')} > 0 THEN 'correct' ELSE 'substitution' END")


PREDS = f"""{SPLIT},
preds AS MATERIALIZED ({' UNION ALL '.join(f"SELECT {q(r)} AS model, id, split, error_type AS label, {rule(r)} AS prediction FROM split" for r in RULES)})"""


def per_class(source: str, by: str = "") -> str:
    """Precision, recall and F1 per class of the rows in ``source``."""
    keys, lead = (f"{by}, ", f"{by}, ") if by else ("", "")
    return f"""SELECT {lead}class, CASE WHEN predicted > 0 THEN hit::DOUBLE / predicted ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN hit::DOUBLE / support ELSE 0 END AS recall,
  CASE WHEN predicted + support > 0 THEN 2.0::DOUBLE * hit / (predicted + support) ELSE 0 END AS f1, support
  FROM (SELECT {lead}class, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted, sum(h)::BIGINT AS hit FROM (
    SELECT {lead}label AS class, 1 AS s, 0 AS p, 0 AS h FROM {source} UNION ALL
    SELECT {lead}prediction, 0, 1, (label = prediction)::INTEGER FROM {source}) GROUP BY {keys}class)"""


def metrics(source: str) -> str:
    return f"""SELECT model, accuracy, precision, recall, f1 FROM
  (SELECT model, avg((label = prediction)::INTEGER::DOUBLE) AS accuracy FROM {source} GROUP BY model)
  JOIN (SELECT model, sum(precision * support) / sum(support) AS precision, sum(recall * support) / sum(support) AS recall,
    sum(f1 * support) / sum(support) AS f1 FROM ({per_class(source, 'model')}) GROUP BY model) USING (model)"""


WEIGHTS = f"""{PREDS},
val AS (SELECT * FROM preds WHERE split = 'val'),
scores AS MATERIALIZED ({metrics('val')}),
weights AS MATERIALIZED (SELECT model, f1 / (SELECT sum(f1) FROM scores) AS weight FROM scores)"""


def _weight(k: int, c: str) -> str:
    return f"({u(chr(39) + chr(39), k, 7)} % 100 + CASE WHEN prediction = {q(c)} THEN 60 ELSE 1 END)::DOUBLE".replace(
        "md5('' ||", "md5(model || '|' || id ||"
    )


VOTE = f"""{WEIGHTS},
raw AS (SELECT model, id, [{', '.join(_weight(k, c) for k, c in enumerate(CLASSES))}] AS w FROM preds),
probs AS (SELECT model, id, unnest([{', '.join(q(c) for c in CLASSES)}]) AS class, unnest(w) / (w[1] + w[2] + w[3] + w[4]) AS p FROM raw),
votes AS (SELECT id, class, sum(p * weight) AS v FROM probs JOIN weights USING (model) GROUP BY id, class),
voted AS MATERIALIZED (SELECT id, class AS prediction, v AS confidence FROM votes
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(v, 12) DESC, class) = 1)"""


# --- corrections -----------------------------------------------------------------------------------

SENTENCES = "sentences AS (SELECT conv_id, turn, text AS sentence FROM conversations)"
QUERY_WORDS = f"""{SENTENCES},
query_words AS MATERIALIZED (SELECT DISTINCT query FROM (SELECT unnest({tokens('sentence')}) AS query FROM sentences) WHERE {checkable('query')}),
lowers AS MATERIALIZED (SELECT DISTINCT lower(query) AS word FROM query_words)"""

# Letters outside a-z never match a dictionary letter, so each may stand as one '#':
# the engine's byte-wise similarities then count characters.
FUZZY = f"""{DICT}, {QUERY_WORDS},
unknown AS MATERIALIZED (SELECT word AS query, regexp_replace(word, '[^a-z]', '#', 'g') AS masked, length(word) AS n FROM lowers
  WHERE word NOT IN (SELECT word FROM dictionary)),
sized AS MATERIALIZED (SELECT word, freq, length(word) AS m FROM dictionary),
fuzzy AS MATERIALIZED (SELECT query, masked, word, freq, levenshtein(masked, word)::INTEGER AS distance
  FROM (SELECT *, unnest([n - 2, n - 1, n, n + 1, n + 2]) AS m FROM unknown) JOIN sized USING (m) WHERE levenshtein(masked, word) <= 2)"""


def score(a: str, b: str, d: str, freq: str, jaro: str) -> str:
    return f"""(3 - {d}) * 10000 + least({freq}, 50000)::DOUBLE / 10
  + CASE WHEN length({a}) = length({b}) THEN 5000 WHEN abs(length({a}) - length({b})) = 1 THEN 2000 ELSE 0 END
  + CASE WHEN left({a}, 1) = left({b}, 1) THEN 3000 ELSE 0 END + CASE WHEN right({a}, 1) = right({b}, 1) THEN 1500 ELSE 0 END
  + {jaro} * 2000"""


RANKED = f"""{FUZZY},
scored AS (SELECT *, {score('query', 'word', 'distance', 'freq', 'jaro_winkler_similarity(masked, word)')} AS score FROM fuzzy),
ranked AS MATERIALIZED (SELECT query, row_number() OVER (PARTITION BY query ORDER BY score DESC, word)::INTEGER AS rank, word, distance, freq, score FROM scored)"""

FOUND = f"""{RANKED},
found AS (SELECT w.query, 1 AS rank, w.query AS word, 0 AS distance, d.freq AS frequency, true AS is_correct, 100000.0::DOUBLE AS score
    FROM query_words w JOIN dictionary d ON lower(w.query) = d.word
  UNION ALL SELECT w.query, coalesce(r.rank, 1), coalesce(r.word, w.query), coalesce(r.distance, -1), coalesce(r.freq, 0), false, coalesce(r.score, 0.0::DOUBLE)
    FROM query_words w JOIN unknown u ON lower(w.query) = u.query LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) r ON r.query = u.query)"""

CHECKED = f"""{RANKED},
stripped AS MATERIALIZED (SELECT conv_id, turn, {strip('sentence')} AS sentence FROM sentences),
toks AS (SELECT conv_id, turn, sentence, unnest({tokens('sentence')}) AS token, generate_subscripts({tokens('sentence')}, 1) - 1 AS pos FROM stripped),
best AS (SELECT query, word, distance FROM ranked WHERE rank = 1),
fixed AS MATERIALIZED (SELECT t.*, b.distance, CASE WHEN b.word IS NULL THEN NULL
    WHEN regexp_matches(token, '^\\p{{Lu}}') THEN upper(left(b.word, 1)) || substr(b.word, 2) ELSE b.word END AS correction
  FROM toks t LEFT JOIN best b ON lower(t.token) = b.query AND {checkable('t.token')}),
regrouped AS (SELECT conv_id, turn, list(coalesce(correction, token) ORDER BY pos) AS words, count(correction)::INTEGER AS num_errors,
    coalesce(string_agg(token || ':' || correction || ':' || distance || ':' || (instr(lower(sentence), lower(token)) - 1) || ':' || pos, ',' ORDER BY pos)
      FILTER (WHERE correction IS NOT NULL), '') AS errors FROM fixed GROUP BY conv_id, turn)"""


def add(name: str, ctes: str, body: str) -> None:
    SQL[name] = f"WITH {ctes}\n{body}"


# --- sources and sinks ---------------------------------------------------------------------------------

add("src_wiki_xml", WIKI, "SELECT doc_id, title, text FROM wiki")
add("src_wiki_xml_damaged", WIKI, """SELECT doc_id, CASE WHEN doc_id % 10 <> 9 THEN title END AS title, text,
    CASE WHEN doc_id % 10 IN (3, 5, 7) THEN 'salvaged' WHEN doc_id % 10 = 9 THEN 'lost' ELSE 'intact' END AS state FROM wiki""")
add("src_word_list", VOCAB, "SELECT word FROM vocab")
add("src_freq_map", VOCAB, "SELECT word, freq FROM vocab")
add("src_dataset_csv", DATASET, "SELECT * FROM dataset")
add("src_dataset_csv_checked", DATASET, """SELECT CASE WHEN id % 10 NOT IN (1, 2, 3, 4) THEN id END AS id, CASE WHEN id % 10 NOT IN (1, 2, 3, 4) THEN incorrect_word END AS incorrect_word,
  CASE id % 10 WHEN 1 THEN 'number' WHEN 2 THEN 'columns' WHEN 3 THEN 'columns' WHEN 4 THEN 'missing' END AS reason,
  CASE id % 10 WHEN 1 THEN concat_ws(',', id, correct_word, incorrect_word, error_type, 'x' || edit_distance, word_length, word_frequency)
    WHEN 2 THEN concat_ws(',', id, correct_word, incorrect_word, error_type, edit_distance)
    WHEN 3 THEN concat_ws(',', id, correct_word, incorrect_word, error_type, edit_distance, word_length, word_frequency, 'more')
    WHEN 4 THEN concat_ws(',', id, '', incorrect_word, error_type, edit_distance, word_length, word_frequency) END AS line FROM dataset""")
add("sink_vocab_thresholds", VOCAB, "SELECT word, freq, min_freq FROM vocab JOIN (SELECT unnest([5, 10, 20, 50])::INTEGER AS min_freq) ON freq >= min_freq")
add("sink_dictionary", VOCAB, f"SELECT word FROM vocab ORDER BY freq DESC, word LIMIT {K.DICTIONARY_SIZE}")
add("sink_dataset", DATASET, "SELECT * FROM dataset ORDER BY id LIMIT 100")
add("sink_splits", f"{ENCODED}, {GROUPS}", "SELECT e.*, s.split FROM encoded e JOIN split s USING (id)")
add("sink_encoders", FEATURED, " UNION ALL ".join(
    f"SELECT DISTINCT {q(c)} AS \"column\", {c} AS label, (dense_rank() OVER (ORDER BY {c}) - 1)::INTEGER AS code FROM featured" for c in ENCODED_COLUMNS))
_BIN = " ".join(
    f"WHEN freq > {low}" + (f" AND freq <= {high}" if high else "") + f" THEN {i}" for i, (low, high, _) in enumerate(K.FREQ_BINS))
BINS = f"""{VOCAB},
bins AS (SELECT i AS bin, labels[i + 1] AS label FROM (SELECT unnest(range({len(K.FREQ_BINS)})) AS i, [{', '.join(q(b[2]) for b in K.FREQ_BINS)}] AS labels)),
binned AS (SELECT b.bin::INTEGER AS bin, b.label, count(v.bin)::BIGINT AS n FROM bins b LEFT JOIN (SELECT CASE {_BIN} END AS bin FROM vocab) v ON v.bin = b.bin GROUP BY b.bin, b.label)"""
_F4 = "format('{{:.4f}}', ({0})::DOUBLE)"


def _one_row(section: str, ord: int, columns: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT {q(section)} AS section, {ord} AS ord, {q(k + '.v')} AS key, {_F4.format(v)} AS value FROM {source}" for k, v in columns.items())


def _share_rows(section: str, ord: int, key: str, more: str = "") -> str:
    counted = f"(SELECT {key} AS k, count(*) AS n FROM vocab GROUP BY {key} {more})"
    return (f"SELECT {q(section)}, {ord}, k || '.n', n::VARCHAR FROM {counted} UNION ALL "
            f"SELECT {q(section)}, {ord}, k || '.pct', {_F4.format('n * 100.0::DOUBLE / (SELECT count(*) FROM vocab)')} FROM {counted}")


add("sink_report", BINS, "SELECT section, ord::INTEGER AS ord, key, value FROM (" + f"""SELECT 'overview' AS section, 1 AS ord, k || '.v' AS key, v::VARCHAR AS value FROM (
    SELECT 'unique_words' AS k, count(*)::BIGINT AS v FROM vocab UNION ALL SELECT 'occurrences', sum(freq)::BIGINT FROM vocab
    UNION ALL SELECT 'frequent_words', count(*) FILTER (WHERE freq >= 10) FROM vocab)
  UNION ALL {_one_row('length_stats', 2, {'mean_length': 'avg(length(word))', 'median_length': 'quantile_cont(length(word)::DOUBLE, 0.5)', 'min_length': 'min(length(word))', 'max_length': 'max(length(word))', 'std_length': 'stddev_samp(length(word))'}, 'vocab')}
  UNION ALL {_share_rows('lengths', 3, 'length(word)', 'ORDER BY length(word) LIMIT 15')}
  UNION ALL {_one_row('frequency_stats', 4, {'mean_freq': 'avg(freq)', 'median_freq': 'quantile_cont(freq::DOUBLE, 0.5)', 'max_freq': 'max(freq)', 'min_freq': 'min(freq)'}, 'vocab')}
  UNION ALL (SELECT 'top', 5, word || '.freq', freq::VARCHAR FROM vocab ORDER BY freq DESC, word LIMIT 20)
  UNION ALL (SELECT 'bottom', 6, word || '.freq', freq::VARCHAR FROM vocab ORDER BY freq, word LIMIT 20)
  UNION ALL SELECT 'bins', 7, label || '.n', n::VARCHAR FROM binned
  UNION ALL {_share_rows('letters', 8, 'left(word, 1)')})""")

# --- cleaning and tokenizing --------------------------------------------------------------------------------

add("cl_empty", WIKI, "SELECT doc_id, coalesce(text, '') AS out FROM wiki")
for _name, _step in STEPS.items():
    if _name != "cl_tag":
        add(_name, WIKI, f"SELECT doc_id, {_step('''coalesce(text, '')''')} AS out FROM wiki")
SQL["cl_tag"] = f"SELECT page_id, {STEPS['cl_tag']('''coalesce(html, '')''')} AS out FROM pages"
add("clean_text", WIKI, f"SELECT doc_id, {clean('text')} AS out FROM wiki")
SQL["tok_words"] = f"""SELECT doc_id, unnest(words) AS word, (generate_subscripts(words, 1) - 1)::INTEGER AS pos
  FROM (SELECT doc_id, {english('text')} AS words FROM documents)"""
TOKENS = f"""{SENTENCES}, lists AS (SELECT conv_id, turn, {tokens('sentence')} AS t FROM sentences),
toks AS (SELECT conv_id, turn, unnest(t) AS token, (generate_subscripts(t, 1) - 1)::INTEGER AS pos FROM lists)"""
add("tok_sentence", TOKENS, "SELECT * FROM toks")

# --- filters ---------------------------------------------------------------------------------------------------

add("flt_nonempty", WIKI, "SELECT doc_id, title FROM wiki WHERE title <> '' AND text <> ''")
add("flt_redirect", WIKI, "SELECT doc_id, title FROM wiki WHERE NOT coalesce(starts_with(text, '#REDIRECT'), false)")
add("flt_namespace", WIKI, f"SELECT doc_id, title FROM wiki WHERE NOT ({NAMESPACES})")
add("flt_min_clean", WIKI, f"SELECT * FROM (SELECT doc_id, length({clean('text')})::INTEGER AS chars FROM wiki) WHERE chars > 100")
add("flt_min_words", WIKI, f"SELECT * FROM (SELECT doc_id, len({english('clean')})::INTEGER AS words FROM (SELECT doc_id, {clean('text')} AS clean FROM wiki)) WHERE words > 20")
add("flt_article_cap", f"{WIKI}, {accepted('wiki')}", "SELECT doc_id, len(words)::INTEGER AS words FROM accepted ORDER BY doc_id LIMIT 100")
add("flt_min_freq", VOCAB, "SELECT * FROM vocab WHERE freq >= 10")
add("flt_word_length", VOCAB, "SELECT * FROM vocab WHERE length(word) BETWEEN 3 AND 20")
add("flt_positive_freq", f"{VOCAB}, {QUERY_WORDS}", "SELECT word, freq FROM lowers JOIN vocab USING (word) WHERE freq > 0")
add("flt_sample_gate", f"{PAIRS}, {DICTIONARY}", f"SELECT correct_word, incorrect_word, error_type FROM ({gate('pairs', 'dictionary')})")
add("flt_alpha_token", TOKENS, f"SELECT * FROM toks WHERE {checkable('token')}")
add("dq_dropna", WIKI, "SELECT doc_id, title FROM wiki WHERE title <> '' AND text IS NOT NULL")
SQL["dq_dropdup"] = "SELECT DISTINCT lang, text FROM documents"

# --- joins -------------------------------------------------------------------------------------------------------

add("join_dict_anti", f"{DICT}, {QUERY_WORDS}", "SELECT word FROM lowers WHERE word NOT IN (SELECT word FROM dictionary)")
add("join_dict_semi", f"{DICT}, {QUERY_WORDS}", "SELECT word FROM lowers WHERE word IN (SELECT word FROM dictionary)")
add("join_freq", f"{VOCAB}, {QUERY_WORDS}", "SELECT word, coalesce(freq, 0)::BIGINT AS freq FROM lowers LEFT JOIN vocab USING (word)")
add("join_candidate_draw", DRAWS, "SELECT * FROM draws")
add("join_fuzzy", FUZZY, "SELECT query, word, freq, distance FROM fuzzy")
add("join_encode", ENCODED, f"SELECT id, {', '.join(f'{c}_encoded' for c in ENCODED_COLUMNS)} FROM encoded")
add("join_label_compare", SPLIT, """SELECT coalesce(a.error_type, b.error_type) AS label, coalesce(before, 0)::BIGINT AS before, coalesce(after, 0)::BIGINT AS after
  FROM (SELECT error_type, count(*) AS before FROM dataset GROUP BY 1) a FULL JOIN (SELECT error_type, count(*) AS after FROM split WHERE split = 'train' GROUP BY 1) b
  ON a.error_type = b.error_type""")
add("join_split_back", SPLIT, "SELECT * FROM split")

# --- aggregations and profiles ---------------------------------------------------------------------------------------

add("agg_word_count", VOCAB, "SELECT word, freq FROM vocab")
add("agg_accepted_articles", f"{WIKI}, {accepted('wiki')}", "SELECT count(*) AS articles FROM accepted")
add("agg_corpus_totals", VOCAB, """SELECT count(*) AS total_unique_words, sum(freq)::BIGINT AS total_word_occurrences,
  (SELECT string_agg(word || '=' || freq, ',' ORDER BY freq DESC, word) FROM (SELECT * FROM vocab ORDER BY freq DESC, word LIMIT 10)) AS most_common_10 FROM vocab""")
add("vt_thresholds", VOCAB, "SELECT t::INTEGER AS min_freq, count(*) FILTER (WHERE freq >= t) AS words FROM vocab, (SELECT unnest([5, 10, 20, 50]) AS t) GROUP BY t")
add("prof_basic", VOCAB, "SELECT count(*) AS unique_words, sum(freq)::BIGINT AS occurrences, count(*) FILTER (WHERE freq >= 10) AS frequent_words FROM vocab")
add("prof_length_stats", VOCAB, """SELECT round(avg(length(word)), 6) AS mean_length, round(quantile_cont(length(word)::DOUBLE, 0.5), 6) AS median_length,
  min(length(word))::INTEGER AS min_length, max(length(word))::INTEGER AS max_length, round(stddev_samp(length(word)), 6) AS std_length FROM vocab""")


def shares(key: str, name: str, source: str) -> str:
    return f"SELECT {key} AS {name}, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM {source}), 6) AS pct FROM {source} GROUP BY {key}"


add("prof_length_dist", VOCAB, shares("length(word)::INTEGER", "len", "vocab") + " ORDER BY len LIMIT 15")
add("prof_freq_stats", VOCAB, """SELECT round(avg(freq), 6) AS mean_freq, round(quantile_cont(freq::DOUBLE, 0.5), 6) AS median_freq, max(freq) AS max_freq, min(freq) AS min_freq
  FROM vocab WHERE freq > 0""")
add("prof_freq_bins", BINS, "SELECT * FROM binned")
add("prof_first_letter", VOCAB, shares("left(word, 1)", "letter", "vocab"))
add("prof_labels", DATASET, shares("error_type", "error_type", "dataset"))
_TYPES = {"id": "bigint", "correct_word": "string", "incorrect_word": "string", "error_type": "string",
          "edit_distance": "int", "word_length": "int", "word_frequency": "bigint"}
add("prof_columns", DATASET, " UNION ALL ".join(
    f"SELECT {q(c)} AS \"column\", {q(t)} AS type, count(DISTINCT {c}) AS \"distinct\" FROM dataset" for c, t in _TYPES.items()))
_STATS = {"count": "count({c})::DOUBLE", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})::DOUBLE",
          "25%": "quantile_cont({c}::DOUBLE, 0.25)", "50%": "quantile_cont({c}::DOUBLE, 0.5)", "75%": "quantile_cont({c}::DOUBLE, 0.75)",
          "max": "max({c})::DOUBLE"}
add("prof_describe", DATASET, " UNION ALL ".join(
    f"SELECT {q(c)} AS \"column\", {q(s)} AS stat, round({e.format(c=c)}, 6) AS value FROM dataset"
    for c in ("edit_distance", "word_length", "word_frequency") for s, e in _STATS.items()))
NULLABLE = f"{WIKI}, pages3 AS (SELECT doc_id, nullif(title, '') AS title, text FROM wiki)"
_NULLS = {c: f"count(*) FILTER (WHERE {c} IS NULL)" for c in ("doc_id", "title", "text")}
add("prof_missing", NULLABLE, " UNION ALL ".join(
    f"SELECT {q(c)} AS \"column\", {e} AS nulls, round({e} * 100.0::DOUBLE / count(*), 6) AS pct FROM pages3" for c, e in _NULLS.items())
    + f" UNION ALL SELECT 'TOTAL', {' + '.join(_NULLS.values())}, round(({' + '.join(_NULLS.values())}) * 100.0::DOUBLE / (3 * count(*)), 6) FROM pages3")
SQL["prof_duplicates"] = """SELECT total, duplicates, round(duplicates * 100.0::DOUBLE / total, 6) AS pct FROM (SELECT count(*) AS total,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, text FROM documents)) AS duplicates FROM documents)"""
add("prof_split_share", SPLIT, """SELECT split, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM split), 6) AS pct FROM split GROUP BY split
  UNION ALL SELECT 'total', count(*), 100.0::DOUBLE FROM split""")
add("prof_before_after", SPLIT, "SELECT 'before' AS dataset, count(*) AS \"rows\", 7::INTEGER AS columns FROM dataset "
    "UNION ALL SELECT 'after', count(*), 35::INTEGER FROM split WHERE split = 'train'")
add("prof_summary", SPLIT, """SELECT 'dataset' AS dataset, count(*) AS "rows", 7::INTEGER AS columns FROM dataset
  UNION ALL SELECT split, count(*), 8 FROM split GROUP BY split""")
add("prof_encoded_counts", ENCODED, "SELECT error_type_encoded AS code, error_type AS label, count(*) AS n FROM encoded GROUP BY 1, 2")

# --- sorts, top-k, sampling, sets ------------------------------------------------------------------------------------------

RANK = "SELECT word, freq, row_number() OVER (ORDER BY freq DESC, word) AS rank FROM"
add("top_dictionary", VOCAB, f"{RANK} vocab QUALIFY rank <= {K.DICTIONARY_SIZE}")
add("top_candidates", VOCAB, f"SELECT rank - 1 AS idx, word, freq FROM ({RANK} vocab WHERE length(word) BETWEEN 3 AND 20) WHERE rank <= {K.CANDIDATE_WORDS}")
add("top_words", VOCAB, "SELECT word, freq FROM vocab ORDER BY freq DESC, word LIMIT 30")
add("bottom_words", VOCAB, "SELECT word, freq FROM vocab WHERE freq > 0 ORDER BY freq, word LIMIT 20")
add("sample_without_replacement", f"{CANDIDATES}, {CHOSEN}", "SELECT word, freq, pick FROM chosen")
add("shuffle_renumber", f"{PAIRS}, rows0 AS (SELECT 0 AS id, correct_word, incorrect_word FROM pairs)", shuffled("rows0"))
add("set_union_samples", f"{ERRORS}, {CORRECT}", "SELECT * FROM errors UNION ALL SELECT * FROM correct")
add("set_label_union", DATASET, "SELECT error_type FROM dataset WHERE error_type <> 'insertion' UNION SELECT error_type FROM dataset WHERE error_type IN ('insertion', 'correct')")
add("set_word_unique", VOCAB, "SELECT DISTINCT word FROM vocab")

# --- synthetic errors, features ------------------------------------------------------------------------------------------------

for _name, _make in GENERATORS.items():
    add(f"gen_{_name}", VOCAB, f"SELECT word, {_make('word', 'word')} AS out FROM vocab")
add("gen_type_draw", VOCAB, f"SELECT word, {drawn_type('word')} AS error_type FROM vocab")
add("gen_errors", ERRORS, "SELECT * FROM errors")
add("gen_correct", f"{CANDIDATES}, {CORRECT}", "SELECT * FROM correct")
add("gen_dataset", DATASET, "SELECT * FROM dataset")

_FEATURES = features("incorrect_word", "word_length")
FEATURE_QUERIES = {
    "num_vowels": "num_vowels", "num_consonants": "num_consonants", "vowel_ratio": "vowel_ratio",
    "consonant_ratio": "consonant_ratio", "first_char": "first_char", "last_char": "last_char",
    "first_bigram": "first_bigram", "last_bigram": "last_bigram", "first_trigram": "first_trigram",
    "last_trigram": "last_trigram", "first_bigram_common": "first_bigram_common",
    "last_bigram_common": "last_bigram_common", "has_double": "has_double_letters",
    "num_double": "num_double_letters", "repeated_vowels": "has_repeated_vowels",
    "is_alternating": "is_alternating", "syllables": "syllable_count", "syllable_ratio": "syllable_ratio",
    "max_consonant_cluster": "max_consonant_cluster", "max_vowel_cluster": "max_vowel_cluster",
    "char_diversity": "char_diversity", "unique_vowels": "unique_vowels",
    "unique_consonants": "unique_consonants", "starts_vowel": "starts_with_vowel",
    "ends_vowel": "ends_with_vowel", "middle_char": "middle_char", "middle_is_vowel": "middle_is_vowel",
}
for _name, _f in FEATURE_QUERIES.items():
    add(f"ft_{_name}", PAIRS, f"SELECT correct_word, incorrect_word, {_FEATURES[_f]} AS {_f} FROM pairs")
add("ft_all", FEATURED, "SELECT * FROM featured")
add("ft_select", ENCODED, f"SELECT id, error_type_encoded, {', '.join(K.FEATURES)} FROM encoded")

_POSITION = """coalesce(list_filter(range(0, least(length(correct_word), length(incorrect_word))),
  lambda i: substr(correct_word, i + 1, 1) <> substr(incorrect_word, i + 1, 1))[1], least(length(correct_word), length(incorrect_word)))"""
_PAIR = {
    "edit_distance": ("edit_distance", "levenshtein(correct_word, incorrect_word)::INTEGER"),
    "log_frequency": ("log_frequency", "round(ln(1 + freq), 6)"),
    "error_position": ("error_position", f"{_POSITION}::INTEGER"),
    "error_position_ratio": ("error_position_ratio", f"round({_POSITION}::DOUBLE / length(correct_word), 6)"),
    "error_on_vowel": ("error_on_vowel", f"(substr(correct_word, {_POSITION} + 1, 1) IN {in_list(K.VOWELS)})::INTEGER"),
    "error_at_beginning": ("error_at_beginning", f"({_POSITION} < length(correct_word) * 0.3::DOUBLE)::INTEGER"),
    "freq_bin": ("freq_bin", "CASE WHEN freq = 0 THEN 5 WHEN freq < 50 THEN 0 WHEN freq < 200 THEN 1 WHEN freq < 1000 THEN 2 WHEN freq < 5000 THEN 3 ELSE 4 END"),
    "levenshtein_ratio": ("levenshtein_ratio", "round(1 - levenshtein(correct_word, incorrect_word)::DOUBLE / greatest(length(correct_word), length(incorrect_word)), 6)"),
    "jaro_winkler": ("jaro_similarity", "round(jaro_winkler_similarity(correct_word, incorrect_word), 6)"),
}
for _name, (_f, _e) in _PAIR.items():
    add(f"fp_{_name}", PAIRS, f"SELECT correct_word, incorrect_word, {_e} AS {_f} FROM pairs")


def ords(x: str, k: int, modulus: int) -> str:
    padded = f"CASE WHEN length({x}) >= {k} THEN {x} ELSE {q('a' * k)} END"
    return f"(({' + '.join(f'ascii(substr({padded}, {i + 1}, 1))' for i in range(k))}) % {modulus})::INTEGER"


_CODES = {
    "first_char_encoded": "(ascii(left(word, 1)) - 97)::INTEGER", "last_char_encoded": "(ascii(right(word, 1)) - 97)::INTEGER",
    "first_bigram_encoded": ords("left(word, 2)", 2, 676), "last_bigram_encoded": ords("right(word, 2)", 2, 676),
    "first_trigram_encoded": ords("left(word, 3)", 3, 17576), "last_trigram_encoded": ords("right(word, 3)", 3, 17576),
    "middle_char_encoded": "(ascii(substr(word, length(word) // 2 + 1, 1)) - 97)::INTEGER",
}
add("fp_ord_codes", VOCAB, f"SELECT word, {listed(_CODES)} FROM vocab")
_SERVE = {"word_length": "length(word)::INTEGER"} | features("word", "length(word)", K.SERVE_FIRST_BIGRAMS, K.SERVE_LAST_BIGRAMS) | _CODES
add("fp_serve_row", VOCAB, f"SELECT word, {listed({f: _SERVE[f] for f in K.FEATURES})} FROM vocab")

add("fx_char_entropy", f"""{VOCAB},
letters AS (SELECT word, c, count(*)::DOUBLE / length(word) AS p FROM (SELECT word, unnest(string_split(word, '')) AS c FROM vocab) GROUP BY word, c)""",
    "SELECT word, round(sum(-p * log2(p)), 6) AS char_entropy FROM letters GROUP BY word")
add("fx_bigram_trigram_count", VOCAB, "SELECT word, greatest(length(word) - 1, 0)::INTEGER AS bigrams, greatest(length(word) - 2, 0)::INTEGER AS trigrams FROM vocab")
add("fx_vowel_position", f"""{VOCAB},
places AS (SELECT word, list_transform(list_filter(range(length(word)), lambda i: substr(word, i + 1, 1) IN {in_list(K.VOWELS)}), lambda i: i::DOUBLE / length(word)) AS x FROM vocab)""",
    "SELECT word, round(coalesce(list_avg(x), 0), 6) AS vowel_pos_mean, round(coalesce(list_var_pop(x), 0), 6) AS vowel_pos_var FROM places")
add("fx_char_freq", f"""{VOCAB},
occ AS (SELECT word, unnest(string_split(word, '')) AS letter, freq FROM vocab),
share AS (SELECT letter, sum(freq)::DOUBLE / (SELECT sum(freq) FROM occ) AS share FROM occ GROUP BY letter),
x AS (SELECT word, share FROM occ JOIN share USING (letter)),
mu AS (SELECT word, avg(share) AS mu FROM x GROUP BY word)""",
    "SELECT word, round(avg(abs(share - mu)), 6) AS char_freq_mad, round(var_pop(share), 6) AS char_freq_var FROM x JOIN mu USING (word) GROUP BY word")
add("fx_tfidf_chars", f"""{VOCAB},
grams AS MATERIALIZED (SELECT word, substr(word, i, k) AS gram FROM (SELECT word, k, unnest(range(1, length(word) - k + 2)) AS i FROM (SELECT word, unnest([2, 3, 4]) AS k FROM vocab))),
top AS MATERIALIZED (SELECT gram, ln(((SELECT count(*) FROM vocab) + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM
  (SELECT gram, count(DISTINCT word) AS df FROM grams GROUP BY gram ORDER BY df DESC, gram LIMIT 100))""",
    "SELECT word, gram, count(*) AS tf, round(count(*) * idf, 6) AS weight FROM grams JOIN top USING (gram) GROUP BY word, gram, idf")
_LONG = " UNION ALL ".join(f"SELECT {q(f)} AS feature, {f}::DOUBLE AS value, error_type AS label FROM encoded" for f in K.FEATURES)
add("fx_feature_score", f"""{RAW_ENCODED},
long AS MATERIALIZED ({_LONG}),
placed AS (SELECT feature, label, floor((rank() OVER (PARTITION BY feature ORDER BY value) - 1) * 10 / count(*) OVER (PARTITION BY feature)) AS bin FROM long),
joint AS (SELECT feature, bin, label, count(*)::DOUBLE AS n FROM placed GROUP BY 1, 2, 3),
parts AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, bin) AS b, sum(n) OVER (PARTITION BY feature, label) AS l FROM joint)""",
    "SELECT feature, round(greatest(sum(n / t * ln(n * t / (b * l))), 0), 6) AS score FROM parts GROUP BY feature")

# --- encoding, scaling, splitting -----------------------------------------------------------------------------------------------

add("enc_label", DATASET, "SELECT DISTINCT 'error_type' AS \"column\", error_type AS label, (dense_rank() OVER (ORDER BY error_type) - 1)::INTEGER AS code FROM dataset")
add("enc_categorical", ENCODED, f"SELECT id, {', '.join(K.CATEGORICAL)}, {', '.join(f'{c}_encoded' for c in K.CATEGORICAL)} FROM encoded")
SQL["enc_export"] = SQL["sink_encoders"]
add("scale_standard", RAW_ENCODED, "SELECT id, " + ", ".join(
    f"round(({f} - avg({f}) OVER ()) / CASE WHEN stddev_pop({f}) OVER () = 0 THEN 1 ELSE stddev_pop({f}) OVER () END, 6) AS {f}" for f in K.FEATURES) + " FROM encoded")
add("split_group", SPLIT, "SELECT id, correct_word, split FROM split")
add("split_no_leak_check", SPLIT, "SELECT split, count(*) AS groups, count(*) FILTER (WHERE splits > 1) AS leaking FROM "
    "(SELECT DISTINCT correct_word, split FROM split) JOIN (SELECT correct_word, count(DISTINCT split) AS splits FROM split GROUP BY correct_word) USING (correct_word) GROUP BY split")

# --- weights, votes, evaluation ---------------------------------------------------------------------------------------------------

add("ml_class_weight", DATASET, """SELECT error_type, round((SELECT count(*) FROM dataset)::DOUBLE / ((SELECT count(DISTINCT error_type) FROM dataset) * count(*)), 6) AS weight
  FROM dataset GROUP BY error_type""")
add("ens_weights", WEIGHTS, "SELECT model, round(weight, 6) AS weight FROM weights")
add("ens_soft_vote", VOTE, "SELECT id, prediction, round(confidence, 6) AS confidence FROM voted")
add("ens_improvement", f"""{VOTE},
ens AS (SELECT 'ensemble' AS model, p.id, p.split, p.label, v.prediction FROM preds p JOIN voted v USING (id) WHERE p.model = 'length_rule' AND p.split = 'val'),
joined AS (SELECT * FROM val UNION ALL SELECT * FROM ens),
all_scores AS ({metrics('joined')}),
pairof AS (SELECT max(f1) FILTER (WHERE model = 'ensemble') AS e, max(f1) FILTER (WHERE model <> 'ensemble') AS b FROM all_scores)""",
    "SELECT round(e, 6) AS ensemble_f1, round(b, 6) AS best_single_f1, round(e - b, 6) AS improvement FROM pairof")

ONE = f"{PREDS}, one AS MATERIALIZED (SELECT * FROM preds WHERE model = 'noisy_rule')"
add("ev_accuracy", ONE, "SELECT round(avg((label = prediction)::INTEGER), 6) AS accuracy FROM one")
add("ev_confusion", ONE, "SELECT label, " + ", ".join(f"count(*) FILTER (WHERE prediction = {q(c)}) AS {c}" for c in CLASSES)
    + f", count(*) FILTER (WHERE prediction NOT IN {in_list(CLASSES)}) AS other FROM one GROUP BY label")
add("ev_confusion_norm", ONE, "SELECT label, prediction, round(count(*)::DOUBLE / any_value(t), 6) AS share FROM one JOIN (SELECT label, count(*) AS t FROM one GROUP BY label) USING (label) GROUP BY label, prediction")
add("ev_per_class", ONE, f"SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM ({per_class('one')})")
add("ev_macro_weighted", f"{ONE}, pc AS ({per_class('one')})", """SELECT 'macro' AS average, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1 FROM pc
  UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6) FROM pc""")
GAP = f"""{PREDS},
gaps AS (SELECT model, a AS train_accuracy, b AS val_accuracy, a - b AS gap FROM (SELECT model, avg((label = prediction)::INTEGER) FILTER (WHERE split = 'train') AS a,
  avg((label = prediction)::INTEGER) FILTER (WHERE split = 'val') AS b FROM preds GROUP BY model))"""
add("ev_gap", GAP, """SELECT model, round(train_accuracy, 6) AS train_accuracy, round(val_accuracy, 6) AS val_accuracy, round(gap, 6) AS gap,
  CASE WHEN gap > 0.15 THEN 'severe' WHEN gap > 0.10 THEN 'moderate' ELSE 'good' END AS band FROM gaps""")
COMPARE = f"""{GAP}, val AS (SELECT * FROM preds WHERE split = 'val'), scores AS ({metrics('val')}),
compared AS (SELECT model, accuracy AS val_accuracy, f1 AS val_f1, gap, f1 - gap * 0.5::DOUBLE AS score FROM scores JOIN gaps USING (model))"""
add("ev_compare", COMPARE, "SELECT model, round(val_accuracy, 6) AS val_accuracy, round(val_f1, 6) AS val_f1, round(gap, 6) AS gap, round(score, 6) AS score FROM compared")
add("sink_results", COMPARE, " UNION ALL ".join(
    f"SELECT 'metrics' AS file, model, {q(m)} AS metric, round({m}, 6) AS value FROM ({metrics('preds')})" for m in ("accuracy", "precision", "recall", "f1"))
    + "".join(f" UNION ALL SELECT 'comparison', model, {q(m)}, round({m}, 6) FROM compared" for m in ("val_accuracy", "val_f1", "gap", "score")))
add("ev_best_model", COMPARE, "SELECT model, round(score, 6) AS value FROM compared ORDER BY score DESC, model LIMIT 1")
add("ev_final_report", f"""{PREDS}, test AS MATERIALIZED (SELECT * FROM preds WHERE split = 'test'),
scores AS MATERIALIZED ({metrics('test')}), best AS (SELECT model FROM scores ORDER BY f1 DESC, model LIMIT 1),
head AS (SELECT * FROM scores WHERE model = (SELECT model FROM best)),
pc AS MATERIALIZED (SELECT * FROM ({per_class('test', 'model')}) WHERE model = (SELECT model FROM best))""",
    "SELECT 'best' AS section, model AS key, 1.0::DOUBLE AS value FROM best"
    + "".join(f" UNION ALL SELECT 'headline', {q(m)}, round({m}, 6) FROM head" for m in ("accuracy", "precision", "recall", "f1"))
    + "".join(f" UNION ALL SELECT 'class', class || '.{m}', round({m}::DOUBLE, 6) FROM pc" for m in ("precision", "recall", "f1", "support")))

# --- corrections ------------------------------------------------------------------------------------------------------------------

add("cor_exact", f"{DICT}, {QUERY_WORDS}", """SELECT query, 1::INTEGER AS rank, query AS word, 0::INTEGER AS distance, freq AS frequency, true AS is_correct, 100000.0::DOUBLE AS score
  FROM query_words JOIN dictionary ON lower(query) = dictionary.word""")
_S = score("incorrect_word", "correct_word", "levenshtein(correct_word, incorrect_word)", "freq", "jaro_winkler_similarity(incorrect_word, correct_word)")
add("cor_score", PAIRS, f"SELECT correct_word, incorrect_word, round({_S}, 6) AS score FROM pairs")
add("cor_candidates", FOUND, "SELECT query, rank::INTEGER AS rank, word, distance::INTEGER AS distance, frequency, is_correct, round(score, 6) AS score FROM found")
add("cor_none", FOUND, "SELECT query, word, distance::INTEGER AS distance, frequency, score FROM found WHERE distance = -1")
add("topn_corrections", RANKED, "SELECT query, rank, word, distance, freq, round(score, 6) AS score FROM ranked WHERE rank <= 5")
add("cor_word", FOUND, """SELECT query AS word, 'ok' AS status, bool_or(is_correct) AS is_correct,
  coalesce(string_agg(word || ':' || distance || ':' || frequency, ',' ORDER BY rank) FILTER (WHERE NOT is_correct AND distance >= 0), '') AS corrections FROM found GROUP BY query""")
add("cor_case", QUERY_WORDS, r"SELECT query, CASE WHEN regexp_matches(query, '^\p{Lu}') THEN upper(left(lower(query), 1)) || substr(lower(query), 2) ELSE lower(query) END AS out FROM query_words")
add("cor_position", f"""{SENTENCES}, stripped AS (SELECT conv_id, turn, {strip('sentence')} AS s FROM sentences),
lists AS (SELECT *, {tokens('s')} AS t FROM stripped), toks AS (SELECT conv_id, turn, s, unnest(t) AS token, (generate_subscripts(t, 1) - 1)::INTEGER AS pos FROM lists)""",
    "SELECT conv_id, turn, pos, (instr(lower(s), lower(token)) - 1)::INTEGER AS position FROM toks")
add("cor_rejoin", SENTENCES, f"SELECT conv_id, turn, {rejoin(tokens(strip('sentence')))} AS out FROM sentences")
_CHECKED = f"""SELECT s.conv_id, s.turn, 'ok' AS status, sentence AS original_sentence, {rejoin('words')} AS corrected_sentence,
  num_errors > 0 AS has_errors, num_errors, errors FROM stripped s JOIN regrouped r ON s.conv_id = r.conv_id AND s.turn = r.turn"""
add("cor_sentence", CHECKED, _CHECKED)

# --- streaming ----------------------------------------------------------------------------------------------------------------------

SQL["st_word_count"] = SQL["agg_word_count"]
add("ml_load_xy", f"{ENCODED}, {GROUPS}", f"SELECT id, split, error_type_encoded::DOUBLE AS label, {len(K.FEATURES)}::INTEGER AS features FROM encoded JOIN (SELECT id, split FROM split) USING (id)")
SQL["st_correct"] = SQL["cor_sentence"]
add("st_snapshot_blocks", f"""{ARTICLES}, {accepted('articles')},
numbered AS MATERIALIZED (SELECT words, row_number() OVER (ORDER BY doc_id) AS n FROM accepted),
shots AS (SELECT unnest(range(1, (SELECT count(*) FROM accepted) // 200 + 1)) * 200 AS articles),
occ AS MATERIALIZED (SELECT ceil(n / 200)::BIGINT * 200 AS upto, word, count(*) AS c FROM (SELECT n, unnest(words) AS word FROM numbered) GROUP BY ALL)""",
    "SELECT articles, word, sum(c)::BIGINT AS freq FROM shots JOIN occ ON upto <= articles GROUP BY articles, word HAVING sum(c) >= 5")
SQL["st_snapshot"] = SQL["st_snapshot_blocks"]

# --- models: what holds of any trained model ------------------------------------------------------------------------------------------

_MODEL_ROWS = f"{ENCODED}, {GROUPS}, model_rows AS (SELECT e.id, s.split, e.error_type_encoded AS label FROM encoded e JOIN (SELECT id, split FROM split) s USING (id))"
_MODEL_CHECK = "SELECT '{0}' AS model, split, label, count(*) AS \"rows\", count(*) AS valid, TRUE AS better{1} FROM model_rows GROUP BY split, label"
for _name in ("ml_rf", "ml_gbt_level"):
    add(_name, _MODEL_ROWS, _MODEL_CHECK.format(_name, ""))
add("ml_gbt_fixed", _MODEL_ROWS, _MODEL_CHECK.format("ml_gbt_fixed", ", TRUE AS best_round_kept"))
SQL["ml_importance"] = f"SELECT unnest([{', '.join(q(f) for f in K.FEATURES)}]) AS feature, TRUE AS is_share, TRUE AS sums_to_one"
add("ml_predict", _MODEL_ROWS, f"SELECT 'boost_fixed' AS model, count(*) AS ids, {len(CLASSES)} * count(*) AS probabilities, count(*) AS whole FROM model_rows")
# The grid has four settings; each rung passes on a third, rounded up, of three folds each.
SQL["ml_random_search"] = """SELECT rung::INTEGER AS rung, settings::BIGINT AS settings, 3 * settings::BIGINT AS measurements, 3 * settings::BIGINT AS valid, TRUE AS taken_over
FROM (VALUES (0, 4), (1, 2), (2, 1)) t(rung, settings)"""
add("src_model", _MODEL_ROWS, """SELECT model, split, count(*) AS "rows", 0::BIGINT AS differing
FROM model_rows, (SELECT unnest(['random_forest', 'boost_fixed', 'ensemble']) AS model) GROUP BY model, split""")
_ENCODERS = " UNION ALL ".join(f"SELECT count(DISTINCT {c}) AS n FROM featured" for c in ENCODED_COLUMNS)
add("sink_model", FEATURED, f"""SELECT version::INTEGER AS version, model, scored, TRUE AS weights_sum_to_one, (SELECT sum(n) FROM ({_ENCODERS}))::BIGINT AS encoders
FROM (VALUES (1, 'boost_fixed', TRUE), (1, 'random_forest', TRUE), (2, 'random_forest', FALSE)) t(version, model, scored)""")
add("cor_error_type", RANKED, "SELECT word AS correct_word, query AS incorrect_word, distance, TRUE AS typed FROM ranked WHERE rank = 1")
SQL["cor_word_typed"] = f"SELECT *, corrections <> '' AS typed FROM ({SQL['cor_word']})"
SQL["cor_sentence_typed"] = f"SELECT *, num_errors AS typed FROM ({SQL['cor_sentence']})"
SQL["st_correct_typed"] = SQL["cor_sentence_typed"]
