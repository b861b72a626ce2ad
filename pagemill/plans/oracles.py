"""The registered queries in SQL for another engine, to check the results against."""

from __future__ import annotations

from ..functions import classify, parse, pii, text, textlayer
from ..functions.crypto import OVERHEAD
from ..operators import detect, evaluate
from ..schemas import CATEGORIES
from .queries import DIM, LINES_PER_PAGE, OTHER_SUFFIX, PDF_LINES, SOURCE_SUFFIX, TOP_K


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def any_of(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


# --- shared steps ---------------------------------------------------------------------------

SUFFIX = (
    "CASE " + " ".join(f"WHEN source IN {any_of(s)} THEN {q(e)}" for e, s in SOURCE_SUFFIX.items())
    + f" ELSE {q(OTHER_SUFFIX)} END"
)
KIND = (
    "CASE "
    + " ".join(f"WHEN source IN {any_of(SOURCE_SUFFIX['_' + c])} THEN {q(c)}" for c in CATEGORIES if "_" + c in SOURCE_SUFFIX)
    + f" WHEN source IN {any_of(SOURCE_SUFFIX['_tax_audit'])} THEN 'finance' END"
)
PATH = f"('/landing/' || source || '/' || doc_id || {SUFFIX} || '.enc')"
FILES = (
    f"files AS (SELECT doc_id, lang, source, text, {PATH} AS file_path, "
    f"regexp_extract({PATH}, '[^/]+$') AS file_name, {KIND} AS document_type FROM documents)"
)
LINES = f"""{FILES}, lines AS (
    SELECT file_name, file_path, document_type, line, i, i // {LINES_PER_PAGE} AS page_id,
           CASE WHEN i = 0 THEN 'title' ELSE 'text' END AS kind
    FROM (SELECT *, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM files))"""
PAGES = f"""{LINES}, pages_ AS (
    SELECT file_name, file_path, document_type, page_id,
           string_agg(shaped, chr(10) || chr(10) ORDER BY i) AS page_content,
           count(*) AS element_count,
           string_agg(DISTINCT kind, ', ' ORDER BY kind) AS element_types,
           file_path || '#page=' || page_id AS image_uri
    FROM (SELECT *, CASE WHEN i = 0 THEN '# ' || line ELSE line END AS shaped FROM lines)
    WHERE trim(shaped, ' ') <> '' GROUP BY ALL)"""

STARS = q(text.LETTERS_DIGITS)


def category(hit: str, classes=pii.ORDER) -> str:
    cases = " ".join(
        f"WHEN regexp_matches({hit}, {q(pii.full(pii.pattern_of(c)))}) THEN {q(c)}" for c in pii.ORDER if c in classes
    )
    return f"CASE {cases} END"


def value(hit: str, kind: str) -> str:
    cases = " ".join(
        f"WHEN {q(c)} THEN regexp_extract({hit}, {q('(?:' + pii.value_pattern(c) + ')$')})" for c in pii.CUES
    )
    return f"CASE {kind} {cases} ELSE {hit} END"


TAIL = f"regexp_extract(original, {q(pii.LAST_FOUR)})"
HEAD = f"left(original, length(original) - length({TAIL}))"


def starred(x: str) -> str:
    return f"regexp_replace({x}, {STARS}, '*', 'g')"


SAME_LENGTH = (
    f"CASE WHEN category IN {any_of(pii.KEEP_LAST_FOUR)} THEN {starred(HEAD)} || regexp_replace({TAIL}, {q(pii.LETTERS)}, '*', 'g') "
    f"WHEN category = 'EMAIL' THEN {starred('string_split(original, chr(64))[1]')} || '@' || string_split(original, chr(64))[2] "
    f"WHEN category = 'ADDRESS' THEN {starred('regexp_extract(original, ' + q('^[0-9]+') + ')')} || regexp_replace(original, '^[0-9]+', '') "
    f"ELSE {starred('original')} END"
)
REPLACED = (
    "CASE category WHEN 'PERSON_NAME' THEN '[[NAME]]' WHEN 'EMAIL' THEN '***@' || string_split(original, chr(64))[2] "
    f"WHEN 'PHONE_NUMBER' THEN regexp_replace({HEAD}, '[0-9]', '*', 'g') || {TAIL} WHEN 'SSN' THEN '<<SSN>>' "
    "WHEN 'CREDIT_CARD' THEN regexp_replace(original, '[0-9]', '*', 'g') WHEN 'ADDRESS' THEN '[ADDRESS]' ELSE original END"
)

_ALL = q(pii.alternation())
ENTITIES = f"""hits AS (
    SELECT doc_id, unnest(regexp_extract_all(text, {_ALL})) AS hit,
           generate_subscripts(regexp_extract_all(text, {_ALL}), 1) - 1 AS ord FROM documents),
  kinds AS (SELECT *, {category('hit')} AS category FROM hits),
  originals AS (SELECT doc_id, ord, category, {value('hit', 'category')} AS original FROM kinds),
  entities AS (SELECT doc_id, ord, original, {SAME_LENGTH} AS masked, category FROM originals)"""


def masked(source: str, keys: str, column: str, classes, mask: str) -> str:
    """CTEs ending in ``masked_(keys, masked)``: the text cut at the matches and joined again."""
    pattern = q(pii.alternation(classes))
    return f"""cut_ AS (
    SELECT {keys}, regexp_split_to_array({column}, {pattern}) AS gaps, regexp_extract_all({column}, {pattern}) AS found FROM {source}),
  pieces AS (SELECT {keys}, unnest(gaps) AS gap, generate_subscripts(gaps, 1) AS n, found FROM cut_),
  hit_ AS (SELECT {keys}, n, gap, found[n] AS hit FROM pieces),
  kind_ AS (SELECT *, {category('hit', classes)} AS category FROM hit_),
  value_ AS (SELECT *, {value('hit', 'category')} AS original FROM kind_),
  masked_ AS (SELECT {keys}, string_agg(gap || CASE WHEN hit IS NULL THEN ''
      ELSE left(hit, length(hit) - length(original)) || ({mask}) END, '' ORDER BY n) AS masked
    FROM value_ GROUP BY ALL)"""


def masked_documents(classes, mask: str) -> str:
    return f"WITH {masked('documents', 'doc_id', 'text', classes, mask)} SELECT doc_id, masked FROM masked_"


_WORD = q(text.WORD)
_NOISE = q(text.TOKEN_NOISE)


def token_key(x: str) -> str:
    return f"lower(regexp_replace({x}, {_NOISE}, '', 'g'))"


# The m-th listing of an entity takes the m-th run of its words.
MAPPED = f"""{ENTITIES},
  words AS (SELECT doc_id, unnest(regexp_extract_all(text, {_WORD})) AS word,
                   generate_subscripts(regexp_extract_all(text, {_WORD}), 1) - 1 AS pos FROM documents
            WHERE doc_id IN (SELECT doc_id FROM entities)),
  word_keys AS (SELECT doc_id, pos, word, {token_key('word')} AS key FROM words),
  parts AS (SELECT *, regexp_extract_all(original, {_WORD}) AS tokens FROM entities),
  listed AS (SELECT *, list_transform(tokens, lambda t: {token_key('t')}) AS keys FROM parts),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, keys ORDER BY ord) AS nth FROM listed),
  wanted AS (SELECT DISTINCT doc_id, keys FROM listed),
  tokens_ AS (SELECT doc_id, keys, unnest(keys) AS key, generate_subscripts(keys, 1) - 1 AS j FROM wanted),
  starts AS (SELECT t.doc_id, t.keys, w.pos - t.j AS start FROM tokens_ t JOIN word_keys w ON w.doc_id = t.doc_id AND w.key = t.key
             GROUP BY ALL HAVING count(*) = len(t.keys)),
  runs AS (SELECT *, row_number() OVER (PARTITION BY doc_id, keys ORDER BY start) AS nth FROM starts),
  placed AS (SELECT n.doc_id, n.ord, n.category, n.masked, r.start, len(n.keys) AS k
             FROM numbered n JOIN runs r ON r.doc_id = n.doc_id AND r.keys = n.keys AND r.nth = n.nth),
  covered AS (SELECT p.*, w.pos, w.word FROM placed p JOIN word_keys w
              ON w.doc_id = p.doc_id AND w.pos >= p.start AND w.pos < p.start + p.k),
  mapped AS (SELECT doc_id, ord AS ent, pos, word AS original_word,
                    regexp_extract_all(masked, {_WORD})[pos - start + 1] AS masked, category FROM covered)"""
REDACTED = f"""{MAPPED},
  joined AS (SELECT w.doc_id, string_agg(coalesce(m.masked, w.word), ' ' ORDER BY w.pos) AS redacted, count(m.pos) AS n
             FROM word_keys w LEFT JOIN mapped m ON m.doc_id = w.doc_id AND m.pos = w.pos GROUP BY w.doc_id),
  redacted AS (SELECT d.doc_id, CASE WHEN j.n > 0 THEN j.redacted ELSE d.text END AS redacted
               FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id)"""


def folded(x: str) -> str:
    return f"lower(array_to_string(regexp_extract_all({x}, {_WORD}), ' '))"


def leaks(table: str, column: str) -> str:
    return f"""SELECT e.doc_id, e.original, e.category FROM entities e
      JOIN (SELECT doc_id, {folded(column)} AS shown FROM {table}
            WHERE doc_id IN (SELECT doc_id FROM entities)) t ON t.doc_id = e.doc_id
      WHERE length({folded('e.original')}) > 2 AND contains(t.shown, {folded('e.original')})"""


def language(column: str) -> str:
    tokens = f"regexp_split_to_array(lower({column}), {q('[^' + chr(92) + 'p{L}]+')})"
    labels = sorted(classify.LANGUAGE_WORDS)
    counts = ", ".join(
        f"len(list_filter({tokens}, lambda t: t IN {any_of(classify.LANGUAGE_WORDS[c])})) AS n_{c}" for c in labels
    )
    best = "greatest(" + ", ".join(f"n_{c}" for c in labels) + ")"
    cases = " ".join(f"WHEN n_{c} = {best} THEN {q(c)}" for c in labels)
    return counts, f"CASE WHEN {best} = 0 THEN NULL {cases} END"


_LANG_COUNTS, _LANG = language("text")
LANGUAGE = f"scores AS (SELECT doc_id, lang, {_LANG_COUNTS} FROM documents), told AS (SELECT doc_id, lang, {_LANG} AS predicted FROM scores)"


# HTML, step by step as in the parser.
def _html() -> str:
    cut, tag = "chr(1)", "chr(2)"
    s = f"translate(html, chr(1) || chr(2), '  ')"
    hidden = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<nav\b.*?</nav\s*>|<meta\b[^>]*>"
    s = f"regexp_replace({s}, {q(hidden)}, '', 'g')"
    s = f"regexp_replace({s}, '(?is)</t[dh]\\s*>\\s*<t[dh]\\b[^>]*>', ' | ', 'g')"
    s = f"regexp_replace({s}, '(?is)</tr\\s*>\\s*<tr\\b[^>]*>', chr(10), 'g')"
    s = f"regexp_replace({s}, '(?is)<({parse._BLOCKS})\\b([^>]*)>', {cut} || '\\1' || {tag}, 'g')"
    s = f"regexp_replace({s}, '(?is)</({parse._BLOCKS})\\s*>', {cut} || {tag}, 'g')"
    s = f"regexp_replace({s}, '(?is)<img\\b[^>]*\\balt=\"([^\"]*)\"[^>]*>', {tag} || '\\1' || {tag}, 'g')"
    return f"regexp_replace({s}, '(?s)<[^<>]*>', '', 'g')"


def _decoded(x: str) -> str:
    for reference, char in parse._REFERENCES:
        x = f"replace({x}, {q(reference)}, {q(char)})"
    return f"regexp_replace(regexp_replace({x}, '[ \\t\\r\\n]+$', ''), '^[ \\t\\r\\n]+', '')"


_DECODED_CONTENT = _decoded("concat(p[2], p[4])")
HTML = f"""blocks AS (
    SELECT page_id, unnest(string_split(clean, chr(1))) AS piece, generate_subscripts(string_split(clean, chr(1)), 1) AS n
    FROM (SELECT page_id, {_html()} AS clean FROM pages)),
  split_ AS (SELECT page_id, n, string_split(piece, chr(2)) AS p FROM blocks),
  texts AS (SELECT page_id, n, lower(p[1]) AS tag, {_DECODED_CONTENT} AS content, {_decoded("p[3]")} AS description FROM split_),
  kept AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS element_id FROM texts
           WHERE regexp_matches(content, {_WORD}) OR (tag = 'figure' AND regexp_matches(description, {_WORD}))),
  html_elements AS (SELECT page_id, element_id, content, description,
      CASE WHEN tag = 'title' THEN 'title' WHEN regexp_matches(tag, '^h[1-6]$') THEN 'section_header'
           WHEN tag = 'header' THEN 'page_header' WHEN tag = 'footer' THEN 'page_footer' WHEN tag = 'li' THEN 'list_item'
           WHEN tag IN ('table', 'figure') THEN tag ELSE 'text' END AS element_type FROM kept)"""

PDF_LINE = f"""pdf_lines AS (
    SELECT doc_id, i, i // {PDF_LINES} AS page_id, line
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents))"""


def _advance(x: str) -> str:
    tables = [t.replace(" ", ", ") for t in (textlayer.HELVETICA_BOLD, textlayer.HELVETICA)]
    width = (
        f"coalesce(CASE WHEN i = 0 THEN [{tables[0]}]::INT[] ELSE [{tables[1]}]::INT[] END"
        f"[unicode(c) - 31], {textlayer.OTHER_WIDTH})"
    )
    # string_split on '' gives the characters
    return f"coalesce(list_sum(list_transform(list_filter(string_split({x}, ''), lambda c: c <> ''), lambda c: {width})), 0)"


PDF_WORDS = f"""{PDF_LINE},
  pieces AS (SELECT *, unnest(regexp_extract_all(line, '[ \\t\\n\\f\\r\\v]*[^ \\t\\n\\f\\r\\v]+')) AS piece,
                    generate_subscripts(regexp_extract_all(line, '[ \\t\\n\\f\\r\\v]*[^ \\t\\n\\f\\r\\v]+'), 1) AS n FROM pdf_lines),
  sized AS (SELECT *, CASE WHEN i = 0 THEN 18 ELSE 10 END AS size, {_advance('piece')} AS w,
                   regexp_extract(piece, '[^ \\t\\n\\f\\r\\v]+') AS word FROM pieces),
  ended AS (SELECT *, {_advance('word')} AS word_w, sum(w) OVER (PARTITION BY doc_id, i ORDER BY n) AS upto FROM sized)"""


def pages_of(kind: str) -> str:
    return f"WITH {PAGES} SELECT {kind} FROM pages_"


_PAGE_COLUMNS = "file_name, file_path, document_type, page_id, page_content, element_count, element_types"

EMBEDDED = """tokens_ AS (SELECT key, unnest(regexp_extract_all(lower(body), '[\\p{L}\\p{N}]+')) AS t FROM source_),
  counts AS (SELECT key, ('0x' || substr(md5(t), 1, 8))::BIGINT %% %d AS place, count(*) AS n FROM tokens_ GROUP BY ALL),
  norms AS (SELECT key, sqrt(sum(n * n)) AS norm FROM counts GROUP BY key),
  weights AS (SELECT c.key, c.place, (c.n / norm)::FLOAT::DOUBLE AS weight FROM counts c JOIN norms USING (key))""" % DIM

CENTROIDS = """cells AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS place FROM embeddings),
  means AS (SELECT label, place, avg(v) AS m FROM cells GROUP BY ALL),
  centroids AS (SELECT label, list(m ORDER BY place) AS center FROM means GROUP BY label)"""
KNN = f"""WITH {CENTROIDS},
  scores AS (SELECT label AS query_id, vec_id AS id, round(list_dot_product(center, embedding::DOUBLE[]), 10) AS s FROM centroids, embeddings_),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM scores)
  SELECT query_id, id, round(s, 6) AS score, rank FROM ranked WHERE rank <= {TOP_K}""".replace(
    "embeddings_", "(SELECT vec_id, embedding FROM embeddings)"
)

PAIRS = """pairs AS (SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u
    JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"""


def _vocabulary(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+'))"


def _coverage(part: str, whole: str) -> str:
    return (
        f"CASE WHEN len({part}) > 0 AND len(list_intersect({part}, {whole}))::DOUBLE / len({part}) >= 0.5 "
        "THEN 'yes' ELSE 'no' END"
    )


def _scores() -> str:
    counts, best = language("answer")
    evades = " OR ".join(f"contains(flat, {q(p)})" for p in evaluate.EVASIVE)
    columns = {
        "correctness_proxy": _coverage("vq", "va"),
        "retrieval_sufficiency_proxy": _coverage("vq", "vc"),
        "retrieval_groundedness_proxy": _coverage("va", "vc"),
        "relevance_to_query_proxy": _coverage("vq", "va"),
        "global_style_english": f"CASE WHEN ({best}) = 'en' THEN 'yes' ELSE 'no' END",
        "global_style_not_evasive": f"CASE WHEN {evades} THEN 'no' ELSE 'yes' END",
        "concise_response": f"CASE WHEN len(regexp_extract_all(answer, {_WORD})) <= {evaluate.CONCISE_WORDS} THEN 'yes' ELSE 'no' END",
    }
    rows = " UNION ALL ".join(f"SELECT conv_id, turn, {q(n)} AS scorer, {c} AS value FROM ready" for n, c in columns.items())
    return f"""{PAIRS}, ready AS (
    SELECT p.*, {_vocabulary('question')} AS vq, {_vocabulary('answer')} AS va, {_vocabulary("coalesce(c.text, '')")} AS vc,
           {folded("replace(answer, '’', '''')")} AS flat, {counts}
    FROM pairs p LEFT JOIN conversations c ON c.conv_id = p.conv_id AND c.turn = p.turn - 1),
  long AS ({rows})"""


SCORES = _scores()


def _mixed() -> str:
    """The same measures over rows whose expected answers, contexts and answers differ from the question."""
    counts, best = language("answer")
    evades = " OR ".join(f"contains(flat, {q(p)})" for p in evaluate.EVASIVE)
    columns = {
        "correctness_proxy": _coverage("ve", "va"),
        "retrieval_sufficiency_proxy": _coverage("ve", "vc"),
        "retrieval_groundedness_proxy": _coverage("va", "vc"),
        "relevance_to_query_proxy": _coverage("vq", "va"),
        "global_style_english": f"CASE WHEN ({best}) = 'en' THEN 'yes' ELSE 'no' END",
        "global_style_not_evasive": f"CASE WHEN {evades} THEN 'no' ELSE 'yes' END",
        "concise_response": f"CASE WHEN len(regexp_extract_all(answer, {_WORD})) <= {evaluate.CONCISE_WORDS} THEN 'yes' ELSE 'no' END",
    }
    rows = " UNION ALL ".join(f"SELECT conv_id, turn, {q(n)} AS scorer, {c} AS value FROM ready" for n, c in columns.items())
    return f"""{PAIRS}, mixed AS (
    SELECT p.conv_id, p.turn, p.question,
           CASE (p.conv_id + p.turn) % 3 WHEN 0 THEN p.question WHEN 1 THEN p.answer ELSE o.question END AS expected,
           CASE WHEN p.conv_id % 2 = 0 THEN concat_ws(' ', p.question, p.answer, o.question) ELSE o.question END AS context,
           CASE WHEN p.conv_id % 5 = 0 THEN 'I cannot help. ' || p.question ELSE p.answer END AS answer
    FROM pairs p LEFT JOIN pairs o ON o.conv_id = p.conv_id - 1 AND o.turn = p.turn),
  ready AS (SELECT *, {_vocabulary('question')} AS vq, {_vocabulary('answer')} AS va, {_vocabulary("coalesce(context, '')")} AS vc,
           {_vocabulary("coalesce(expected, '')")} AS ve, {folded("replace(answer, '’', '''')")} AS flat, {counts} FROM mixed),
  long AS ({rows})"""


MIXED = _mixed()

_FOUR = "lpad((doc_id % 10000)::VARCHAR, 4, '0')"
# The documents with the record that the query appends to each.
RECORDS = f"""documents AS (
    SELECT doc_id, text || chr(10) || 'Contact: Ann Lee' || chr(10) || 'Mobile 415-555-' || {_FOUR} || ', SSN 219-09-' || {_FOUR} || ', mail u' || doc_id
      || '@post.example.net, host 10.0.0.' || (doc_id % 250) || chr(10) || 'DOB:     1/2/1977, age ' || (doc_id % 70 + 20) || ', passport no. K'
      || lpad(doc_id::VARCHAR, 7, '3') || 'XY, driver licence no. D-' || lpad(doc_id::VARCHAR, 6, '8') || chr(10) || 'Account number:' || chr(10)
      || lpad(doc_id::VARCHAR, 20, '7') || ', MRN: Q' || doc_id || ', national id N' || doc_id || chr(10) || 'Company: Nordic Lamp' || chr(10)
      || 'card 5105 1051 0510 ' || {_FOUR} || ', at 6 Mill Lane, Portland, OR 97205 with Ann Lee' AS text
    FROM main.documents)"""

ORACLES: dict[str, str] = {
    "file_names": "SELECT page_id, regexp_extract(url, '[^/]+$') AS file_name FROM pages",
    "crypto_roundtrip": f"SELECT doc_id, strlen(text) AS plain_bytes, strlen(text) + {OVERHEAD} AS encrypted_bytes, true AS same FROM documents",
    "input_size_summary": f"SELECT count(*) AS n_files, sum(strlen(text))::BIGINT AS plain_bytes, sum(strlen(text) + {OVERHEAD})::BIGINT AS encrypted_bytes FROM documents",
    "tampered_quarantine": f"WITH {FILES} SELECT file_path, file_name, CASE lang WHEN 'es' THEN 'authentication failed' ELSE 'shorter than nonce and tag' END AS reason FROM files WHERE lang IN ('es', 'fr')",
    "encrypted_files_roundtrip": f"WITH {FILES} SELECT file_name, strlen(text) + {OVERHEAD} AS file_size, document_type, len(string_split(text, chr(10))) AS n_elements FROM files",
    "json_props": "SELECT event_id, regexp_extract(props, '\"k\": *([0-9]+)', 1)::INT AS k FROM events",
    "bronze_docs": f"""WITH {FILES} SELECT file_name, file_path, strlen(text) + {OVERHEAD} AS file_size, document_type,
        (len(string_split(text, chr(10))) + {LINES_PER_PAGE - 1}) // {LINES_PER_PAGE} AS n_pages, len(string_split(text, chr(10))) AS n_elements FROM files""",
    "elements_text": f"""WITH {LINES} SELECT file_name, file_path, document_type, i AS element_id, kind AS element_type, line AS content, page_id,
        file_path || '#page=' || page_id AS image_uri,
        '[{{"coord":[0,' || (i % {LINES_PER_PAGE}) || ',' || length(line) || ',' || (i % {LINES_PER_PAGE} + 1) || '],"page_id":' || page_id || '}}]' AS bbox_json FROM lines""",
    "elements_html": f"WITH {HTML} SELECT page_id::VARCHAR AS file_path, element_id, element_type, content, 0 AS page_id FROM html_elements",
    "page_image_lookup": f"WITH {LINES} SELECT file_path, i AS element_id, page_id, file_path || '#page=' || page_id AS image_uri FROM lines",
    "empty_documents": """SELECT conv_id || '/' || turn AS file_path, CASE WHEN role = 'assistant' THEN turn END AS element_id,
        CASE WHEN role = 'assistant' THEN 'text' END AS element_type, CASE WHEN role = 'assistant' THEN text END AS content,
        CASE WHEN role = 'assistant' THEN 0 END AS page_id FROM conversations""",
    "classify_by_name": f"WITH {FILES} SELECT doc_id, file_name, document_type FROM files",
    "classify_language": f"WITH {LANGUAGE} SELECT doc_id, lang, predicted FROM told",
    "classify_confusion": f"WITH {LANGUAGE} SELECT lang, predicted, count(*) AS n FROM told GROUP BY ALL",
    "pdf_elements": f"""WITH {PDF_LINE}, blocks AS (
        SELECT doc_id, page_id, CASE WHEN i = 0 THEN 'title' ELSE 'text' END AS element_type,
               string_agg(line, chr(10) ORDER BY i) AS content, min(i) AS first FROM pdf_lines GROUP BY ALL)
        SELECT doc_id, page_id, element_type, content, row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1 AS element_id FROM blocks""",
    "pdf_text_state": f"""WITH {PDF_LINE} SELECT doc_id, page_id, i % {PDF_LINES} AS line_no, 82.0::DOUBLE AS x,
        (750 - 14 * (i % {PDF_LINES}))::DOUBLE AS y, 10.0::DOUBLE AS size, line AS shown FROM pdf_lines""",
    "pdf_words": f"""WITH {PDF_WORDS} SELECT doc_id, page_id, word,
        row_number() OVER (PARTITION BY doc_id ORDER BY i, n) - 1 AS pos,
        round(CASE WHEN i = 0 THEN 72 ELSE 82 END + (upto - word_w) * size / 1000.0, 3)::DOUBLE AS x0,
        round(CASE WHEN i = 0 THEN 72 ELSE 82 END + upto * size / 1000.0, 3)::DOUBLE AS x1,
        round(792 - (750 - (i % {PDF_LINES}) * 14) + 0.207 * size - size, 3)::DOUBLE AS y0,
        round(792 - (750 - (i % {PDF_LINES}) * 14) + 0.207 * size, 3)::DOUBLE AS y1,
        CASE WHEN i = 0 THEN 'Helvetica-Bold' ELSE 'Helvetica' END AS fontname FROM ended""",
    "format_elements": f"""WITH {HTML}, shaped AS (SELECT page_id::VARCHAR AS file_path, element_id,
        CASE WHEN element_type = 'title' THEN '# ' || content WHEN contains(element_type, 'header') THEN '## ' || content
             WHEN element_type IN ('table', 'figure') THEN '[' || upper(element_type) || ']' || chr(10) || content
               || CASE WHEN trim(description, ' ') <> '' THEN chr(10) || '[Description: ' || description || ']' ELSE '' END
             ELSE content END AS formatted_content FROM html_elements)
        SELECT * FROM shaped WHERE trim(formatted_content, ' ') <> ''""",
    "silver_pages": pages_of(_PAGE_COLUMNS + ", image_uri"),
    "silver_pages_fused": pages_of(_PAGE_COLUMNS + ", image_uri"),
    "stream_pages": pages_of(_PAGE_COLUMNS),
    "stream_view": pages_of(_PAGE_COLUMNS + ", image_uri"),
    "pages_in_order": pages_of("file_name, page_id, true AS in_order"),
    "detection_inputs": f"""SELECT doc_id, md5({q(detect.RULES.format(classes=", ".join(pii.ORDER)))} || text) AS prompt_md5,
        (length(text) + {len(detect.RULES.format(classes=", ".join(pii.ORDER)))})::INTEGER AS prompt_chars FROM documents WHERE lang <> 'es' AND regexp_matches(text, '\\S')""",
    "pii_entities": f"WITH {ENTITIES} SELECT doc_id, ord, original, masked, category FROM entities",
    "pii_all_classes": f"WITH {RECORDS}, {ENTITIES} SELECT doc_id, ord, original, masked, category FROM entities",
    "pii_forms": f"""SELECT doc_id, o.ord AS ord, o.original AS original, o.masked AS masked, o.category AS category FROM (SELECT doc_id, unnest([
            {{'ord': 0, 'original': 'jörg' || doc_id || '@müller.example.de', 'masked': repeat('*', 4 + length(doc_id::VARCHAR)) || '@müller.example.de', 'category': 'EMAIL'}},
            {{'ord': 1, 'original': 'Okoro', 'masked': '*****', 'category': 'PERSON_NAME'}},
            {{'ord': 2, 'original': '+44 20 7946 ' || {_FOUR}, 'masked': '+** ** **** ' || {_FOUR}, 'category': 'PHONE_NUMBER'}},
            {{'ord': 3, 'original': doc_id || '234567 Oak Tree Hill Park View Street, New Port Saint Mary Bay, ME 04101',
              'masked': repeat('*', 6 + length(doc_id::VARCHAR)) || ' Oak Tree Hill Park View Street, New Port Saint Mary Bay, ME 04101', 'category': 'ADDRESS'}},
            {{'ord': 4, 'original': '412 55 ' || {_FOUR}, 'masked': '*** ** ' || {_FOUR}, 'category': 'SSN'}},
            {{'ord': 5, 'original': '3056 930902 ' || {_FOUR}, 'masked': '**** ****** ' || {_FOUR}, 'category': 'CREDIT_CARD'}}]) AS o FROM documents)""",
    "pii_all_by_category": f"WITH {RECORDS}, {ENTITIES} SELECT category, count(*) AS n_entities FROM entities GROUP BY category",
    "leak_check_many": f"""WITH parts AS (SELECT page_id, html, unnest(range(length(html) // 24)) AS n FROM pages),
        e AS (SELECT DISTINCT page_id, substr(html, 24 * n + 1, 7) AS original FROM parts),
        t AS (SELECT page_id, {folded("regexp_replace(html, '[0-9]', '#', 'g')")} AS shown FROM pages),
        j AS (SELECT e.page_id, length({folded('e.original')}) > 2 AND contains(t.shown, {folded('e.original')}) AS leaks FROM e JOIN t USING (page_id))
        SELECT page_id, count(*) AS n_entities, count(*) FILTER (leaks) AS n_leaks FROM j GROUP BY page_id""",
    "leak_check_records": f"WITH {RECORDS}, {REDACTED} {leaks('redacted', 'redacted')}",
    "stream_files_archived": f"WITH {FILES} SELECT file_name, strlen(text) + {OVERHEAD} AS file_size, document_type, doc_id % 3 = 2 AS left_in_inbox FROM files",
    "stream_files": f"WITH {FILES} SELECT file_name, strlen(text) + {OVERHEAD} AS file_size, document_type, len(string_split(text, chr(10))) AS n_elements FROM files",
    "model_masked_gold": f"""WITH {PAGES} SELECT sha256(file_path || '#' || page_id) AS chunk_id, regexp_replace(page_content, '[0-9]', '#', 'g') AS page_content_masked
        FROM pages_ WHERE document_type IS NOT NULL""",
    "model_entities": """SELECT doc_id, 0 AS ord, n AS original, repeat('*', length(n)) AS masked, 'NUMBER' AS category
        FROM (SELECT doc_id, regexp_extract(text, '[0-9]+') AS n FROM documents) WHERE n <> ''""",
    "model_requests": """WITH r AS (SELECT doc_id, lang, lang || ' ' || length(text) AS request FROM documents)
        SELECT doc_id, upper(request) AS answer, NULL::VARCHAR AS error, CASE WHEN lang = 'fr' THEN (SELECT count(DISTINCT request) FROM r WHERE lang = 'fr') END AS failed,
               CASE WHEN lang = 'fr' THEN (SELECT count(DISTINCT request) FROM r) END AS n_requests FROM r""",
    "model_judged": f"""WITH {PAIRS} SELECT conv_id, turn, CASE WHEN length(answer) > 2000 THEN NULL WHEN length(answer) > length(question) THEN 'yes' ELSE 'no' END AS longer FROM pairs""",
    "model_classified": f"WITH {FILES} SELECT doc_id, file_name, CASE WHEN contains(file_name, '_hr.') THEN 'hr' WHEN contains(file_name, '_support.') THEN 'support' END AS document_type FROM files",
    "model_embedded": f"""WITH {FILES}, now AS (SELECT file_path, text || CASE lang WHEN 'de' THEN ' (revised)' ELSE '' END AS t FROM files WHERE lang <> 'es')
        SELECT sha256(file_path || '#0') AS chunk_id, length(t)::FLOAT AS chars, len(string_split(t, ' '))::FLOAT AS words FROM now""",
    "gold_tables": f"WITH {PAGES} SELECT 'gold_' || document_type AS name, count(*) AS n_pages, document_type FROM pages_ WHERE document_type IS NOT NULL GROUP BY ALL",
    "gold_file_names": f"""WITH named AS (
            SELECT doc_id, lang, source, text, 'Zara Quill' || translate(doc_id::VARCHAR, '0123456789', 'abcdefghij') AS name FROM main.documents),
        documents AS (SELECT doc_id, lang, source, 'Contact: ' || name || chr(10) || text || chr(10) || 'as ' || name || ' said' AS text, name FROM named),
        {PAGES}, routed AS (SELECT * FROM pages_ WHERE document_type IS NOT NULL),
        {masked('routed', 'file_path, page_id', 'page_content', pii.PUBLISHED, REPLACED)}
        SELECT sha256(m.file_path || '#' || m.page_id) AS chunk_id, m.page_id, replace(m.masked, name, '[[NAME]]') AS page_content_masked
        FROM masked_ m JOIN named ON named.doc_id = regexp_extract(m.file_path, '/([0-9]+)_', 1)::BIGINT""",
    "gold_incremental": f"""WITH {PAGES}, routed AS (
            SELECT p.* REPLACE (CASE WHEN lang = 'de' THEN 'support' ELSE p.document_type END AS document_type) FROM pages_ p JOIN files f ON f.file_path = p.file_path
            WHERE (p.document_type IS NOT NULL OR lang = 'de') AND lang <> 'es'),
        {masked('routed', 'file_path, page_id', 'page_content', pii.PUBLISHED, REPLACED)}
        SELECT sha256(r.file_path || '#' || r.page_id) AS chunk_id, r.file_name, r.file_path, r.document_type, r.page_id,
               m.masked AS page_content_masked, r.element_count, r.element_types, r.image_uri
        FROM routed r JOIN masked_ m ON m.file_path = r.file_path AND m.page_id = r.page_id""",
    "index_synced_buckets": f"""WITH {FILES} SELECT sha256(file_path || '#0') AS chunk_id, 'insert' AS action, 0 AS version FROM files WHERE lang <> 'fr'
        UNION ALL SELECT sha256(file_path || '#0'), CASE lang WHEN 'fr' THEN 'insert' WHEN 'es' THEN 'delete' ELSE 'update' END, 1 FROM files WHERE lang IN ('fr', 'es', 'de')""",
    "index_precondition": f"""WITH {PAGES}, found AS (SELECT DISTINCT document_type FROM pages_)
        SELECT c AS document_type, CASE WHEN c IN (SELECT document_type FROM found WHERE document_type IS NOT NULL) THEN 'ready'
            ELSE c || ' is missing or empty, no index can be built from it' END AS state FROM (SELECT unnest([{", ".join(q(c) for c in CATEGORIES)}]) AS c)""",
    "index_synced_nulls": f"""WITH {FILES} SELECT sha256(file_path || '#0') AS chunk_id,
        CASE WHEN lang NOT IN ('en', 'de') THEN sha256(text) END AS content_hash, {DIM} AS dim FROM files""",
    "eval_scores_mixed": f"WITH {MIXED} SELECT conv_id, turn, scorer, value FROM long",
    "eval_metrics_mixed": f"""WITH {MIXED} SELECT scorer, count(*) AS n_answers, count(*) FILTER (value = 'yes') AS n_yes,
        round(count(*) FILTER (value = 'yes') / count(*), 6) AS share_yes FROM long GROUP BY scorer""",
    "pii_counts": f"WITH {ENTITIES} SELECT doc_id, count(*) AS n_entities FROM entities GROUP BY doc_id",
    "pii_by_category": f"WITH {ENTITIES} SELECT category, count(*) AS n_entities FROM entities GROUP BY category",
    "documents_with_pii": f"WITH {ENTITIES} SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM entities)",
    "mask_replace": masked_documents(pii.PUBLISHED, REPLACED),
    "mask_emails": masked_documents(("EMAIL",), REPLACED),
    "mask_cards": masked_documents(("CREDIT_CARD",), REPLACED),
    "mask_phones": masked_documents(("PHONE_NUMBER",), REPLACED),
    "mask_same_length": masked_documents(pii.ORDER, SAME_LENGTH),
    "parse_response": """SELECT doc_id, 0 AS ord, CASE lang WHEN 'en' THEN source ELSE doc_id::VARCHAR END AS original,
        CASE lang WHEN 'en' THEN (CASE WHEN length(source) = 4 THEN '****' ELSE repeat('*', length(source)) END)
                  ELSE repeat('*', length(doc_id::VARCHAR)) END AS masked,
        CASE lang WHEN 'en' THEN 'CODE' ELSE 'UNKNOWN' END AS category FROM documents WHERE lang IN ('en', 'de')""",
    "map_words": f"WITH {MAPPED} SELECT * FROM mapped",
    "split_mask": f"""WITH {MAPPED}, lengths AS (
        SELECT *, length(word) AS n, coalesce(sum(length(word)) OVER (PARTITION BY doc_id, ord ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
               replace(masked, ' ', '') AS chars FROM covered)
        SELECT doc_id, ord AS ent, pos, word AS original_word, category,
               CASE WHEN k = 1 THEN chars ELSE rpad(substr(chars, (before + 1)::INT, n), n::INT, '*') END AS masked FROM lengths""",
    "redacted_text": f"WITH {REDACTED} SELECT doc_id, redacted FROM redacted",
    "redaction_total": f"WITH {MAPPED} SELECT count(*) AS n_redactions FROM mapped",
    "leak_check": f"WITH {REDACTED} {leaks('redacted', 'redacted')}",
    "leak_check_safe": f"WITH {ENTITIES} SELECT doc_id, count(*) AS n_entities, 0 AS n_leaks FROM entities GROUP BY doc_id",
    "leak_control": f"WITH {ENTITIES} {leaks('documents', 'text')}",
    "model_batches": "SELECT doc_id, length(text) AS n_chars, true AS answered FROM documents",
    "gold_pages": f"""WITH {PAGES}, routed AS (SELECT * FROM pages_ WHERE document_type IS NOT NULL),
        {masked('routed', 'file_path, page_id', 'page_content', pii.PUBLISHED, REPLACED)}
        SELECT sha256(r.file_path || '#' || r.page_id) AS chunk_id, r.file_name, r.file_path, r.document_type, r.page_id,
               m.masked AS page_content_masked, r.element_count, r.element_types, r.image_uri
        FROM routed r JOIN masked_ m ON m.file_path = r.file_path AND m.page_id = r.page_id""",
    "gold_summary": f"WITH {PAGES} SELECT document_type, count(*) AS n_pages, count(DISTINCT file_name) AS n_documents FROM pages_ WHERE document_type IS NOT NULL GROUP BY ALL",
    "gold_unrouted": f"WITH {PAGES} SELECT document_type, count(*) AS n_pages FROM pages_ WHERE document_type IS NULL GROUP BY ALL",
    "gold_published": f"WITH {PAGES} SELECT document_type, count(*) AS n_pages, count(DISTINCT file_name) AS n_documents FROM pages_ WHERE document_type IS NOT NULL GROUP BY ALL",
    "index_diff": f"""WITH {FILES} SELECT sha256(file_path || '#0') AS chunk_id,
        CASE lang WHEN 'fr' THEN 'insert' WHEN 'es' THEN 'delete' ELSE 'update' END AS action FROM files WHERE lang IN ('fr', 'es', 'de')""",
    "index_synced": f"""WITH {FILES} SELECT sha256(file_path || '#0') AS chunk_id,
        sha256(text || CASE lang WHEN 'de' THEN ' (revised)' ELSE '' END) AS content_hash, {DIM} AS dim FROM files WHERE lang <> 'es'""",
    "embed_hashed": f"""WITH source_ AS (SELECT doc_id AS key, text AS body FROM documents), {EMBEDDED}
        SELECT key AS doc_id, place, round(weight, 5) AS weight FROM weights""",
    "knn_topk": KNN,
    "knn_topk_blocks": KNN,
    "retrieve_documents": f"""WITH source_ AS (SELECT 'd' || doc_id AS key, text AS body FROM documents
            UNION ALL SELECT 'q' || item_id, text FROM benchmark), {EMBEDDED},
        scores AS (SELECT substr(b.key, 2)::BIGINT AS query_id, substr(a.key, 2)::BIGINT AS id, round(sum(a.weight * b.weight), 10) AS s
                   FROM weights a JOIN weights b ON a.place = b.place WHERE a.key LIKE 'd%' AND b.key LIKE 'q%' GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM scores)
        SELECT query_id, id, round(s, 6) AS score, rank FROM ranked WHERE rank <= {TOP_K}""",
    "eval_pairs": f"WITH {PAIRS} SELECT conv_id, turn, 'user' AS role, question, answer AS expected FROM pairs",
    "eval_csv_roundtrip": f"WITH {PAIRS} SELECT conv_id || '-' || turn AS filename, question, answer FROM pairs",
    "concise_response": f"""SELECT conv_id, turn, CASE WHEN len(regexp_extract_all(text, {_WORD})) <= {evaluate.CONCISE_WORDS} THEN 'yes' ELSE 'no' END AS concise_response
        FROM conversations WHERE role = 'assistant'""",
    "eval_scores": f"WITH {SCORES} SELECT conv_id, turn, scorer, value FROM long",
    "eval_metrics": f"""WITH {SCORES} SELECT scorer, count(*) AS n_answers, count(*) FILTER (value = 'yes') AS n_yes,
        round(count(*) FILTER (value = 'yes') / count(*), 6) AS share_yes FROM long GROUP BY scorer""",
}
