"""For each named query the SQL that gives the same rows, in DuckDB's dialect."""

from __future__ import annotations

from textflow.functions.stop_words import ENGLISH
from textflow.functions.text import BLANKS, PUNCTUATION, TOKEN, TOKEN_OR_BLANKS
from textflow.plans import lookups


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


DOCS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents)"
LABELLED = "labelled AS (SELECT * FROM docs WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))"
HELD = "held AS (SELECT DISTINCT sha256(text) AS id FROM labelled)"
CALLS = "calls AS (SELECT sha256(text) AS id, lang AS type, text, doc_id FROM documents)"
FIRSTS = (
    "firsts AS (SELECT id, type, text, doc_id FROM "
    "(SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id, type) AS place FROM calls) "
    "WHERE place = 1)"
)


def _json(value: str) -> str:
    return f"CAST(to_json({value}) AS VARCHAR)"


def _total(text: str) -> str:
    """Words of a text by the rule of the total-words enricher."""
    cut = f"regexp_replace({text}, '\\s+$', '')"
    return (
        f"CASE WHEN {text} = '' THEN 1 WHEN {cut} = '' THEN 0 "
        f"ELSE len(string_split_regex({cut}, '\\s+')) END"
    )


def _blank_split(text: str) -> str:
    cut = f"regexp_replace(lower({text}), '\\s+$', '')"
    return (
        f"CASE WHEN {text} <> '' AND {cut} = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split_regex({cut}, '\\s') END"
    )


def _words(source: str = "docs") -> str:
    """One row per word: `id, word, place`."""
    return (
        f"listed AS (SELECT id, list_filter(string_split_regex(text, {_quoted(BLANKS)}), "
        f"lambda w: w <> '') AS ws FROM {source}), "
        "words AS (SELECT id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM listed)"
    )


def _word_counts(stop: bool) -> str:
    """`counted(id, prediction)`."""
    kept = "SELECT * FROM words WHERE word NOT IN (SELECT word FROM stop_words)" if stop else "SELECT * FROM words"
    return (
        f"kept AS ({kept}), "
        "tallies AS (SELECT id, word, count(*) AS n, min(place) AS place FROM kept GROUP BY id, word), "
        f"lists AS (SELECT id, '[' || string_agg('{{' || {_json('word')} || ':' || n || '}}', ',' "
        "ORDER BY place) || ']' AS prediction FROM tallies GROUP BY id), "
        "counted AS (SELECT docs.id, coalesce(prediction, '[]') AS prediction "
        "FROM docs LEFT JOIN lists ON docs.id = lists.id)"
    )


def _bayes(learned: str) -> str:
    """Naive Bayes with one added to each count, over the words of at least five of the documents that it learns from,
    weighted by their inverse document frequency: `answers(id, label)`."""
    return (
        "parts AS (SELECT id, unnest(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]')) AS term FROM docs), "
        "counts AS (SELECT id, term, count(*) AS n FROM parts GROUP BY id, term), "
        "labelled_all AS (SELECT docs.id, CAST(quality AS DOUBLE) AS label FROM docs "
        "JOIN labels ON docs.id = CAST(labels.doc_id AS VARCHAR) WHERE text IS NOT NULL AND quality IS NOT NULL), "
        f"known AS (SELECT * FROM labelled_all WHERE {learned}), "
        "size AS (SELECT count(*) AS m FROM known), "
        "lexicon AS (SELECT term, ln((m + 1.0) / (count(*) + 1.0)) AS idf FROM counts "
        "JOIN known ON known.id = counts.id, size GROUP BY term, m HAVING count(*) >= 5), "
        "features AS (SELECT id, counts.term, n * idf AS v FROM counts JOIN lexicon ON counts.term = lexicon.term), "
        "priors AS (SELECT label, ln(count(*) + 1.0) AS prior FROM known GROUP BY label), "
        "seen AS (SELECT label, term, sum(v) AS v FROM known JOIN features ON known.id = features.id GROUP BY label, term), "
        "totals AS (SELECT priors.label, coalesce(sum(v), 0) AS v FROM priors "
        "LEFT JOIN seen ON priors.label = seen.label GROUP BY priors.label), "
        "weights AS (SELECT totals.label, lexicon.term, ln(coalesce(seen.v, 0) + 1.0) - "
        "ln(totals.v + (SELECT count(*) FROM lexicon)) AS weight FROM totals CROSS JOIN lexicon "
        "LEFT JOIN seen ON seen.label = totals.label AND seen.term = lexicon.term), "
        "likely AS (SELECT id, label, sum(v * weight) AS likelihood FROM features "
        "JOIN weights ON features.term = weights.term GROUP BY id, label), "
        "answers AS (SELECT docs.id, CAST(arg_max(priors.label, prior + coalesce(likelihood, 0)) AS VARCHAR) AS label "
        "FROM docs CROSS JOIN priors LEFT JOIN likely ON likely.id = docs.id AND likely.label = priors.label "
        "GROUP BY docs.id)"
    )


def _scores(name: str, lexicon: str, source: str = "docs") -> str:
    """`<name>(id, prediction)` by a lexicon."""
    signs = _quoted(PUNCTUATION)
    bare = f"trim(lower(word), {signs})"
    term = f"CASE WHEN length({bare}) <= 2 THEN lower(word) ELSE {bare} END"
    return (
        f"{name} AS (SELECT d.id, CASE WHEN coalesce(score, 0) > 0 THEN 'positive' ELSE 'negative' END "
        f"AS prediction FROM {source} d LEFT JOIN (SELECT w.id, "
        "sum(CAST(valence AS DECIMAL(18, 6))) AS score FROM "
        f"(SELECT id, {term} AS term FROM words) w JOIN {lexicon} l ON w.term = l.term "
        "GROUP BY w.id) s ON d.id = s.id)"
    )


def _typed(source: str, label: str) -> str:
    return (
        f"SELECT docs.id, {_quoted(label)} AS type, docs.text, p.prediction "
        f"FROM docs JOIN {source} p ON docs.id = p.id"
    )


TOKENS = (
    f"token_lists AS (SELECT id, regexp_extract_all(text, {_quoted(TOKEN)}) AS ts FROM docs), "
    "tokens AS (SELECT id, unnest(ts) AS token, generate_subscripts(ts, 1) AS place FROM token_lists)"
)


def _mentions(values: str) -> str:
    """`mentions(id, i, n, name, …)`: the longest runs of up to three tokens in `phrases`."""
    spelled = f"array_to_string(regexp_extract_all(phrase, {_quoted(TOKEN)}), ' ')"
    return (
        f"phrases AS (SELECT DISTINCT {spelled} AS phrase, {values} FROM given), "
        "nexts AS (SELECT id, place, token AS a, lead(token, 1) OVER w AS b, lead(token, 2) OVER w AS c "
        "FROM tokens WINDOW w AS (PARTITION BY id ORDER BY place)), "
        "runs AS (SELECT id, place AS i, 1 AS n, a AS name FROM nexts "
        "UNION ALL SELECT id, place, 2, a || ' ' || b FROM nexts WHERE b IS NOT NULL "
        "UNION ALL SELECT id, place, 3, a || ' ' || b || ' ' || c FROM nexts WHERE c IS NOT NULL), "
        "hits AS (SELECT * FROM runs WHERE name IN (SELECT phrase FROM phrases)), "
        "mentions AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.id = h.id "
        "AND o.n > h.n AND o.i <= h.i AND o.i + o.n >= h.i + h.n))"
    )


NAMES = (
    f"{_mentions('label')}, named AS (SELECT id, i, n, name, label FROM mentions m "
    "JOIN phrases p ON m.name = p.phrase), "
    f"name_lists AS (SELECT id, '[' || string_agg('{{\"name\":' || {_json('name')} || ',\"label\":' || "
    f"{_json('label')} || '}}', ',' ORDER BY i, n, label) || ']' AS found FROM named GROUP BY id), "
    "answers AS (SELECT docs.id, coalesce(found, '[]') AS prediction FROM docs "
    "LEFT JOIN name_lists ON docs.id = name_lists.id)"
)
GAZETTEER = lookups.GAZETTEER.sql("given")

LINKS = ", ".join(
    [
        f"piece_lists AS (SELECT id, regexp_extract_all(text, {_quoted(TOKEN_OR_BLANKS)}) AS ps FROM docs)",
        "pieces AS (SELECT id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS k FROM piece_lists)",
        "placed AS (SELECT id, piece, k, sum(length(piece)) OVER (PARTITION BY id ORDER BY k) AS past "
        "FROM pieces)",
        "spots AS (SELECT id, piece AS token, past - length(piece) AS opening, past AS closing, "
        "row_number() OVER (PARTITION BY id ORDER BY k) AS place FROM placed "
        "WHERE NOT regexp_matches(piece, '^\\s'))",
        "tokens AS (SELECT id, token, place FROM spots)",
        _mentions("entity_id, entity_name, entity_type, prior"),
        "totals AS (SELECT phrase, sum(CAST(prior AS DECIMAL(20, 10))) AS total FROM phrases GROUP BY phrase)",
        "spans AS (SELECT m.id, m.name, a.opening, b.closing FROM mentions m "
        "JOIN spots a ON a.id = m.id AND a.place = m.i "
        "JOIN spots b ON b.id = m.id AND b.place = m.i + m.n - 1)",
        'annotations AS (SELECT s.id AS passage_id, CAST(s.opening AS INTEGER) AS "start", '
        'CAST(s.closing AS INTEGER) AS "end", substr(docs.text, CAST(s.opening AS BIGINT) + 1, '
        "CAST(s.closing - s.opening AS BIGINT)) AS mention, entity_id, entity_name, entity_type, "
        "CAST(prior AS DOUBLE) AS rho, CAST(prior AS DOUBLE) / CAST(total AS DOUBLE) AS confidence "
        "FROM spans s JOIN docs ON docs.id = s.id JOIN phrases p ON p.phrase = s.name "
        "JOIN totals t ON t.phrase = s.name)",
        "link_lists AS (SELECT passage_id AS id, '[' || string_agg(CAST(to_json({'start': \"start\", "
        "'end': \"end\", 'mention': mention, 'entity_id': entity_id, 'entity_name': entity_name, "
        "'entity_type': entity_type, 'rho': rho, 'confidence': confidence}) AS VARCHAR), ',' "
        'ORDER BY "start", "end", mention, entity_id) || \']\' AS found FROM annotations GROUP BY 1)',
        "answers AS (SELECT docs.id, coalesce(found, '[]') AS prediction FROM docs "
        "LEFT JOIN link_lists ON docs.id = link_lists.id)",
    ]
)
ENTITIES = lookups.ENTITIES.sql("given")

TAGGED = (
    "tagged AS (SELECT id, place AS position, 'key' || place AS key, token AS text, "
    "coalesce(pos, 'X') AS pos, coalesce(tag, 'X') AS tag FROM tokens LEFT JOIN tags ON token = word)"
)
TAG_OBJECT = (
    f"answers AS (SELECT docs.id, coalesce(found, '{{}}') AS prediction FROM docs LEFT JOIN "
    f"(SELECT id, '{{' || string_agg('\"' || key || '\":{{\"text\":' || {_json('text')} || ',\"pos\":' || "
    f"{_json('pos')} || ',\"tag\":' || {_json('tag')} || '}}', ',' ORDER BY position) || '}}' AS found "
    "FROM tagged GROUP BY id) f ON docs.id = f.id)"
)

UPDATES = ", ".join(
    [
        DOCS,
        LABELLED,
        lookups.LEXICON.sql("lexicon"),
        _words(),
        _scores("scored", "lexicon"),
        f"updates AS (SELECT id, 'Words' AS type, CAST({_total('text')} AS VARCHAR) AS prediction, 1 AS seq "
        "FROM docs UNION ALL SELECT id, 'Sentiment', prediction, 1 FROM scored "
        f"UNION ALL SELECT id, 'Words', CAST(len(regexp_extract_all(text, {_quoted(TOKEN)})) AS VARCHAR), 2 "
        "FROM labelled "
        f"UNION ALL SELECT 'c' || conv_id, 'Words', CAST({_total('text')} AS VARCHAR), turn "
        "FROM conversations)",
        "latest AS (SELECT id, type, arg_max(prediction, seq) AS prediction, count(*) AS updates "
        "FROM updates GROUP BY id, type)",
    ]
)
MAPS = (
    f"'{{' || string_agg({_json('type')} || ':' || {_json('prediction')}, ',' ORDER BY type) || '}}'"
)
ENGLISH_LIST = "[" + ", ".join(_quoted(word) for word in ENGLISH) + "]"
RIVALS = ", ".join(
    [
        DOCS,
        lookups.LEXICON.sql("lexicon"),
        lookups.OTHER_LEXICON.sql("other_lexicon"),
        _words(),
        _scores("first_answers", "lexicon"),
        _scores("second_answers", "other_lexicon"),
        "even_answers AS (SELECT id, CASE WHEN length(text) % 2 = 0 THEN 'positive' ELSE 'negative' END "
        "AS prediction FROM docs)",
        "rivals AS (SELECT id, 1 AS place, 'First' AS type, prediction FROM first_answers "
        "UNION ALL SELECT id, 2, 'Second', prediction FROM second_answers "
        "UNION ALL SELECT id, 3, 'Even', prediction FROM even_answers)",
    ]
)
AGREEMENT = _with(RIVALS) + (
    "SELECT a.type AS type_a, b.type AS type_b, count(*) AS documents, "
    "count(*) FILTER (WHERE a.prediction = b.prediction) AS agreeing "
    "FROM rivals a JOIN rivals b ON a.id = b.id AND a.place < b.place GROUP BY a.type, b.type"
)
WORD_COUNT = _with(DOCS, lookups.STOP_WORDS.sql("stop_words"), _words(), _word_counts(True)) + _typed(
    "counted", "WordCount"
)
SENTIMENT = _with(DOCS, lookups.LEXICON.sql("lexicon"), _words(), _scores("scored", "lexicon")) + _typed(
    "scored", "Sentiment"
)
ENTITY_NAMES = _with(DOCS, GAZETTEER, TOKENS, NAMES) + _typed("answers", "OpenNER")
ENTITY_LINKS = _with(DOCS, ENTITIES, LINKS) + _typed("answers", "EntityLinks")
TOKEN_TAGS = _with(DOCS, lookups.TAGS.sql("tags"), TOKENS, TAGGED) + "SELECT * FROM tagged"
TOTAL = f"CAST({_total('text')} AS VARCHAR)"
LISTED_TOKENS = f"list_filter({_blank_split('text')}, lambda w: NOT list_contains({ENGLISH_LIST}, w))"

DOCUMENT_LEXICON = (
    "lexicon AS (SELECT DISTINCT lower(token) AS term, (length(lower(token)) % 7 - 3) / 10 AS valence FROM tokens)"
)
DOCUMENT_SENTIMENT = _with(DOCS, TOKENS, DOCUMENT_LEXICON, _words(), _scores("scored", "lexicon")) + _typed(
    "scored", "Sentiment"
)

SQL: dict[str, str] = {
    "request_ids_text": "SELECT doc_id, sha256(text) AS id FROM documents",
    "request_ids_json": f"""SELECT doc_id, sha256('{{"text":' || {_json('text')} || '}}') AS id FROM documents""",
    "request_ids_body": f"""SELECT doc_id, sha256('{{"lang":' || {_json('lang')} || ',"text":' || {_json('text')} || """
    f"""CASE WHEN doc_id % 3 <> 0 THEN ',"source":' || {_json('source')} ELSE '' END || ',"size":' || n_chars || '}}') AS id FROM documents""",
    "message_filter": "SELECT CAST(NULL AS VARCHAR) AS type, text, conv_id, turn FROM conversations "
    "WHERE text NOT LIKE '/%'",
    "intake_first_wins": _with(CALLS, FIRSTS) + "SELECT id, type, text FROM firsts",
    "intake_accepted": _with(DOCS, LABELLED, HELD, CALLS, FIRSTS)
    + "SELECT id, type, text FROM firsts WHERE id NOT IN (SELECT id FROM held)",
    "intake_status": _with(DOCS, LABELLED, HELD, CALLS)
    + "SELECT doc_id, id, CASE WHEN id NOT IN (SELECT id FROM held) "
    "AND row_number() OVER (PARTITION BY id ORDER BY doc_id) = 1 "
    "THEN 'inserted' ELSE 'exists' END AS resp FROM calls",
    "intake_already_stored": _with(DOCS, LABELLED, HELD, CALLS)
    + "SELECT doc_id, id FROM calls WHERE id IN (SELECT id FROM held)",
    "envelope_roundtrip": _with(DOCS) + "SELECT id, text FROM docs",
    "prediction_roundtrip": _with(DOCS)
    + f"SELECT id, 'TotalWords' AS type, text, {TOTAL} AS prediction FROM docs",
    "preprocess": "SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents WHERE lang <> 'es'",
    "preprocess_with_tokens": _with(DOCS)
    + f"SELECT id, {_json(LISTED_TOKENS)} AS filtered FROM docs",
    "tokens": _with(DOCS) + f"SELECT id, {_json(_blank_split('text'))} AS tokens FROM docs",
    "tokens_no_stop": _with(DOCS) + f"SELECT id, {_json(LISTED_TOKENS)} AS filtered FROM docs",
    "token_count": _with(DOCS) + f"SELECT id, len({_blank_split('text')}) AS n FROM docs",
    "class_tokens": _with(DOCS)
    + f"SELECT id, {_json(f'regexp_extract_all(text, {_quoted(TOKEN)})')} AS tokens FROM docs",
    "json_check": _with(DOCS)
    + "SELECT id, 1 AS list, CAST(json_valid(text) AND regexp_matches(text, '^\\s*[\\[{]') AS INTEGER) "
    "AS plain, 0 AS quoted FROM docs",
    "total_words": _with(DOCS)
    + f"SELECT id, 'TotalWords' AS type, text, {TOTAL} AS prediction FROM docs",
    "word_count": WORD_COUNT,
    "word_count_english": _with(DOCS, lookups.ENGLISH_STOP_WORDS.sql("stop_words"), _words(), _word_counts(True))
    + _typed("counted", "WordCount"),
    "word_count_all_words": _with(DOCS, _words(), _word_counts(False)) + _typed("counted", "WordCount"),
    "word_count_stop_table": WORD_COUNT,
    "word_count_large_stop_table": WORD_COUNT,
    "sentiment": SENTIMENT,
    "sentiment_large_lexicon": SENTIMENT,
    "entity_names": ENTITY_NAMES,
    "entity_names_wrapped": _with(DOCS, GAZETTEER, TOKENS, NAMES)
    + "SELECT docs.id, 'OpenNER' AS type, docs.text, '{\"OpenNER\":' || prediction || '}' AS prediction "
    "FROM docs JOIN answers ON docs.id = answers.id",
    "entity_names_large_gazetteer": ENTITY_NAMES,
    "entity_links": ENTITY_LINKS,
    "entity_links_large_table": ENTITY_LINKS,
    "entity_links_ready": ENTITY_LINKS,
    "entity_annotations": _with(DOCS, ENTITIES, LINKS) + "SELECT * FROM annotations",
    "typed_links": _with(DOCS, ENTITIES, LINKS) + "SELECT * FROM annotations",
    "typed_tags": _with(DOCS, lookups.TAGS.sql("tags"), _words(), TOKENS, TAGGED)
    + "SELECT t.id, coalesce(n, 0) AS words, key, text, pos, tag FROM tagged t "
    "LEFT JOIN (SELECT id, count(DISTINCT word) AS n FROM words GROUP BY id) w ON w.id = t.id",
    "annotated_only": _with(DOCS, ENTITIES, LINKS)
    + "SELECT docs.id, docs.text, found AS prediction FROM docs JOIN link_lists ON docs.id = link_lists.id",
    "token_tags": TOKEN_TAGS,
    "token_tags_large_lexicon": TOKEN_TAGS,
    "token_tags_json": _with(DOCS, lookups.TAGS.sql("tags"), TOKENS, TAGGED, TAG_OBJECT)
    + _typed("answers", "Tags"),
    "custom_predictor": _with(DOCS)
    + "SELECT id, 'LongestLine' AS type, text, CAST(list_max(list_transform(string_split(text, chr(10)), "
    "lambda line: length(line))) AS VARCHAR) AS prediction FROM docs",
    "fitted_model_tokens": _with(DOCS)
    + f"SELECT id, 'Tokens' AS type, text, {_json(LISTED_TOKENS)} AS prediction FROM docs",
    "fitted_model_held_out": _with(DOCS, _bayes("CAST(id AS BIGINT) % 5 <> 0"))
    + "SELECT CAST(l.id AS BIGINT) % 5 = 0 AS held_out, count(*) AS documents, "
    "count(*) FILTER (WHERE CAST(a.label AS DOUBLE) = l.label) AS correct, "
    "greatest(count(*) FILTER (WHERE l.label = 1), count(*) FILTER (WHERE l.label = 0)) AS majority "
    "FROM labelled_all l JOIN answers a ON a.id = l.id GROUP BY 1",
    "fitted_model_quality": _with(DOCS, _bayes("true"))
    + "SELECT docs.id, 'Quality' AS type, text, CASE WHEN text IS NOT NULL THEN label END AS prediction "
    "FROM docs JOIN answers ON docs.id = answers.id",
    "side_by_side_enrichers": _with(
        DOCS, lookups.LEXICON.sql("lexicon"), GAZETTEER, _words(), _scores("scored", "lexicon"),
        _word_counts(False), TOKENS, NAMES,
    )
    + 'SELECT docs.id, docs.text, scored.prediction AS "Sentiment", counted.prediction AS "WordCount", '
    'answers.prediction AS "OpenNER" FROM docs JOIN scored ON docs.id = scored.id '
    "JOIN counted ON docs.id = counted.id JOIN answers ON docs.id = answers.id",
    "merged_predictions": _with(UPDATES)
    + f"SELECT id, {MAPS} AS predictions FROM latest WHERE id IN (SELECT id FROM docs) GROUP BY id",
    "merged_increment": _with(UPDATES)
    + f"SELECT id, {MAPS} AS predictions FROM latest GROUP BY id",
    "rejected_updates": _with(UPDATES)
    + "SELECT id, type, prediction, updates, 'no document with this id' AS reason FROM latest "
    "WHERE id NOT IN (SELECT id FROM docs)",
    "prediction_bodies": _with(
        DOCS, lookups.LEXICON.sql("lexicon"), _words(), _scores("scored", "lexicon"), _word_counts(False)
    )
    + "SELECT id, 'WordCount' AS type, '{\"predictions\":{\"WordCount\":' || prediction || '}}' AS body "
    "FROM counted UNION ALL SELECT id, 'Sentiment', '{\"predictions\":{\"Sentiment\":\"' || prediction || "
    "'\"}}' FROM scored UNION ALL SELECT id, 'Echo \"text\"', "
    f"'{{\"predictions\":{{\"Echo \\\"text\\\"\":' || {_json('text')} || '}}}}' FROM docs",
    "enriched_view": _with(UPDATES)
    + "SELECT docs.id, docs.text, s.prediction AS \"Sentiment\", w.prediction AS \"Words\" FROM docs "
    "LEFT JOIN latest s ON s.id = docs.id AND s.type = 'Sentiment' "
    "LEFT JOIN latest w ON w.id = docs.id AND w.type = 'Words'",
    "documents_with_type": _with(DOCS, LABELLED)
    + "SELECT id, text, '{\"Lines\":\"' || len(string_split(text, chr(10))) || '\",\"Words\":\"' || "
    f"{TOTAL} || '\"}}' AS predictions FROM labelled",
    "parent_child": _with(UPDATES)
    + "SELECT docs.id, docs.text, u.type, u.prediction FROM docs LEFT JOIN latest u ON u.id = docs.id",
    "typed_predictions": _with(DOCS, GAZETTEER, TOKENS, NAMES)
    + "SELECT id, row_number() OVER (PARTITION BY id ORDER BY i, n, label) - 1 AS place, name, label FROM named",
    "agreement": AGREEMENT,
    "agreement_of_predictions": AGREEMENT,
    "accuracy": _with(RIVALS)
    + "SELECT type, count(*) AS documents, count(*) FILTER (WHERE prediction = "
    "CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END) AS correct FROM rivals "
    "JOIN labels ON rivals.id = CAST(doc_id AS VARCHAR) GROUP BY type",
    "stream_intake": _with(CALLS, FIRSTS) + "SELECT id, text, type FROM firsts",
    "stream_dispatch": _with(DOCS) + "SELECT id, text FROM docs",
    "stream_enrich": WORD_COUNT,
    "stream_enrich_rows": SENTIMENT,
    "stream_tags": _with(DOCS, lookups.TAGS.sql("tags"), TOKENS, TAGGED, TAG_OBJECT)
    + _typed("answers", "Tags"),
    "stream_dispatch_by_type": _with(CALLS, FIRSTS)
    + f"SELECT id, type, CASE WHEN type IN ('en', 'de') THEN {_json(LISTED_TOKENS)} END AS filtered FROM firsts",
    "stream_tag_view": _with(DOCS, lookups.TAGS.sql("tags"), TOKENS, TAGGED)
    + "SELECT sha256(docs.text) AS text_id, key, tagged.text, pos, tag FROM tagged JOIN docs ON docs.id = tagged.id",
    "stream_dispatch_tokens": _with(DOCS) + f"SELECT id, {_json(LISTED_TOKENS)} AS filtered FROM docs",
    "stream_bodies": _with(DOCS, _words(), _word_counts(False))
    + "SELECT '{\"id\":\"' || id || '\",\"doc\":{\"predictions\":{\"WordCount\":' || prediction || '}}}' AS value "
    "FROM counted",
    "stream_merge_batches": _with(DOCS, LABELLED)
    + f"SELECT id, 'Words' AS type, CAST(CASE WHEN id IN (SELECT id FROM labelled) "
    f"THEN len(regexp_extract_all(text, {_quoted(TOKEN)})) ELSE length(text) END AS VARCHAR) AS prediction FROM docs",
    "store_compacted": _with(DOCS, LABELLED)
    + f"SELECT id, text, 'Tokens' AS answer, CAST(len(regexp_extract_all(text, {_quoted(TOKEN)})) AS VARCHAR) "
    f"AS prediction FROM docs UNION ALL SELECT id, text, 'Words', {TOTAL} FROM labelled",
    "stream_merge": _with(DOCS, LABELLED)
    + f"SELECT id, 'Words' AS type, {TOTAL} AS prediction, CASE WHEN id IN (SELECT id FROM labelled) "
    "THEN '' ELSE 'no document with this id' END AS reason FROM docs",
    "store_levels": _with(DOCS)
    + f"SELECT id, 'Words' AS type, (CAST(id AS BIGINT) % 10) || ':' || {TOTAL} AS prediction, "
    "CAST(id AS BIGINT) % 10 + 1 AS updates, text FROM docs",
    "store_failed_batch": _with(DOCS, LABELLED)
    + f"SELECT id, {TOTAL} AS prediction, CASE WHEN id IN (SELECT id FROM labelled) "
    "THEN '' ELSE 'no document with this id' END AS reason, 0 AS seen FROM docs",
    "stream_enrich_replay": _with(DOCS)
    + f"SELECT '{{\"id\":\"' || id || '\",\"doc\":{{\"predictions\":{{\"Words\":\"' || {TOTAL} || '\"}}}}}}' AS value "
    "FROM docs",
    "sentiment_document_lexicon": DOCUMENT_SENTIMENT,
    "stream_enrich_document_lexicon": DOCUMENT_SENTIMENT,
    "word_count_document_stop_words": _with(
        DOCS, _words(), "stop_words AS (SELECT DISTINCT word FROM words WHERE length(word) % 2 = 0)", _word_counts(True)
    )
    + _typed("counted", "WordCount"),
    "token_tags_document_lexicon": _with(
        DOCS, TOKENS, "tags AS (SELECT DISTINCT token AS word, 'P' || length(token) AS pos, 'T' || length(token) AS tag "
        "FROM tokens WHERE length(token) % 4 <> 0)", TAGGED,
    )
    + "SELECT * FROM tagged",
    "entity_names_document_gazetteer": _with(
        DOCS, TOKENS, "given AS (SELECT DISTINCT token || ' ' || next AS phrase, 'pair' AS label FROM (SELECT token, place, "
        "lead(token) OVER (PARTITION BY id ORDER BY place) AS next FROM tokens) WHERE place % 5 = 0 AND next IS NOT NULL)", NAMES,
    )
    + _typed("answers", "OpenNER"),
    "stream_two_legs": _with(DOCS, LABELLED)
    + f"SELECT docs.id, CASE WHEN docs.id IN (SELECT id FROM labelled) THEN {TOTAL} END AS prediction, 1 AS failures FROM docs",
    "stream_from_time": _with(DOCS, LABELLED) + "SELECT id, text FROM docs WHERE id NOT IN (SELECT id FROM labelled)",
}
