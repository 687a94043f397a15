"""The SQL that states what each query must return, for DuckDB over the same tables."""

from __future__ import annotations

from corpusloom.functions.text import BYTELEVEL_REPAIRS, WHITESPACE
from corpusloom.operators.bpe import SPECIAL_TOKENS
from corpusloom.operators.pieces import CONTROL_SYMBOLS, MAX_PIECE, USER_SYMBOLS
from corpusloom.plans.queries import (
    BROKEN_SOURCE,
    PAD_ID,
    PAD_LEFT,
    PAD_RIGHT,
    PADDED_LENGTH,
    PIECE_VOCAB_SIZE,
    VOCAB_SIZE,
)

ORACLES: dict[str, str] = {}

_WORDS = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]+"


def _chars(text: str) -> str:
    """A SQL string literal written as code points."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in text) + ")"


_WS = _chars(WHITESPACE)
_LEFT, _RIGHT = _chars(PAD_LEFT), _chars(PAD_RIGHT)
_WS_CLASS = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"
_LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}])"

# --- scans and sources

_BROKEN = f"source = '{BROKEN_SOURCE}'"
ORACLES["scan_jsonl"] = f"""
SELECT CASE WHEN {_BROKEN} THEN NULL ELSE doc_id END AS doc_id,
       CASE WHEN {_BROKEN} THEN NULL ELSE text END AS content,
       NOT {_BROKEN} AS is_valid
FROM documents"""
ORACLES["scan_jsonl_typed"] = f"SELECT doc_id, text AS content FROM documents WHERE NOT {_BROKEN}"
ORACLES["scan_manifest"] = "SELECT md5(CAST(doc_id AS VARCHAR)) AS blob_id FROM documents"
ORACLES["list_inputs"] = "SELECT DISTINCT source FROM documents"
ORACLES["path_predicate"] = """
SELECT page_id, url FROM pages WHERE starts_with(url, 'https://') AND ends_with(url, '.html')
ORDER BY url, page_id"""
ORACLES["scan_csv"] = """
SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM labels"""
ORACLES["scan_csv_text"] = "SELECT doc_id, text FROM documents"
ORACLES["scan_tokens"] = f"""
SELECT CAST(len(ids) AS BIGINT) AS n_ids, md5(array_to_string(ids, ' ')) AS ids
FROM (SELECT list_transform(regexp_extract_all(text, '{_WORDS}'), lambda w: length(w)) AS ids FROM documents)"""
ORACLES["hydrate_blobs"] = """
SELECT blob_id,
       CASE WHEN contains(blob_id, 'casino') THEN NULL ELSE '<' || blob_id || '>' END AS content,
       CAST(CASE WHEN contains(blob_id, 'casino') THEN 4 WHEN contains(blob_id, 'page=') THEN 3 ELSE 1 END AS BIGINT)
         AS attempts,
       CASE WHEN contains(blob_id, 'casino') THEN 'FileNotFoundError: gone' END AS error
FROM (SELECT CAST(page_id AS VARCHAR) || '|' || url AS blob_id FROM pages)"""
ORACLES["hydrate_resumable"] = """
SELECT page_id, coalesce(html, '') AS content, CAST(1 AS BIGINT) AS attempts, CAST(NULL AS VARCHAR) AS error FROM pages"""
_STORED = "text IN (SELECT text FROM documents SEMI JOIN labels USING (doc_id))"
ORACLES["join_blob_store"] = f"""
SELECT doc_id, CASE WHEN {_STORED} THEN text END AS content, CASE WHEN NOT {_STORED} THEN 'missing' END AS error
FROM documents"""
ORACLES["manifest_to_corpus"] = f"""
SELECT trim(text, {_WS}) AS content FROM documents WHERE {_STORED} AND trim(text, {_WS}) <> ''"""
_LISTING = """
SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS id, event_type AS name,
       CASE WHEN event_type = 'view' THEN 'E' ELSE 'H' END AS shared,
       CASE WHEN event_type = 'error' THEN 'unknown' WHEN event_type = 'signup' THEN ''
            ELSE strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') || ' +03' END AS modified
FROM events"""
ORACLES["list_catalog"] = f"SELECT * FROM ({_LISTING}) WHERE shared = 'E' ORDER BY id LIMIT 100"
ORACLES["catalog_local_time"] = _LISTING

# --- sinks

ORACLES["write_jsonl"] = "SELECT conv_id, turn, role, text FROM conversations"


def _single_line(text: str) -> str:
    body = f"regexp_replace({text}, '{_LINE_END}$', '')"
    return f"regexp_replace({body}, '{_LINE_END}', ' ', 'g')"


ORACLES["write_text"] = f"SELECT {_single_line('text')} AS content FROM documents"
ORACLES["corpus_files"] = f"""
SELECT source, CAST(sum(octet_length(encode({_single_line('text')})) + 1) AS BIGINT) AS n_bytes, count(*) AS n_lines
FROM documents GROUP BY source"""
ORACLES["write_modes"] = "SELECT text FROM benchmark"
ORACLES["append_run_state"] = """
SELECT 'run-' || user_id AS run_id, event_id AS step, CASE WHEN event_type <> 'error' THEN value END AS loss,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type AS model_path
FROM events"""
_CUT = f"""
SELECT left(line, CAST(length(line) - 1 AS BIGINT)) AS raw
FROM (SELECT '{{"doc_id":' || doc_id || ',"content":' || to_json(text) || '}}' AS line FROM documents WHERE {_BROKEN})"""
ORACLES["dead_letters"] = _CUT

# --- projections, filters, predicates

ORACLES["filter_valid_json"] = f"SELECT doc_id FROM documents WHERE NOT {_BROKEN}"
ORACLES["filter_content"] = f"""
SELECT conv_id, turn, text AS content FROM conversations WHERE role <> 'user' AND trim(text, {_WS}) <> ''"""
ORACLES["content_of_lines"] = f"""
SELECT text AS content FROM conversations WHERE role <> 'user' AND trim(text, {_WS}) <> ''"""
ORACLES["drop_empty_blob"] = f"""
SELECT doc_id, trim({_LEFT} || text || {_RIGHT}, {_WS}) AS content FROM documents
WHERE lang NOT IN ('de', 'fr') AND trim(text, {_WS}) <> ''"""
_PAIRS = """
SELECT a.conv_id, a.turn, a.text AS question, b.text AS response,
       CAST(NULL AS BIGINT) AS item_id, CAST(NULL AS VARCHAR) AS content
FROM (SELECT * FROM conversations WHERE role = 'user') a
LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') b ON a.conv_id = b.conv_id AND a.turn = b.turn - 1
UNION ALL
SELECT NULL, NULL, NULL, NULL, item_id, text FROM benchmark"""
_IS_PAIR = "(question IS NOT NULL AND response IS NOT NULL)"
ORACLES["qa_inline"] = f"""
SELECT conv_id, turn, item_id, CASE WHEN NOT {_IS_PAIR} THEN question END AS question,
       CASE WHEN NOT {_IS_PAIR} THEN response END AS response,
       CASE WHEN {_IS_PAIR} THEN question || ' ' || response ELSE content END AS content
FROM ({_PAIRS})"""
ORACLES["qa_fan_out"] = f"""
WITH p AS ({_PAIRS})
SELECT question || ' ' || response AS content, CAST(NULL AS BIGINT) AS conv_id, CAST(NULL AS BIGINT) AS turn,
       CAST(NULL AS BIGINT) AS item_id FROM p WHERE {_IS_PAIR}
UNION ALL SELECT content, conv_id, turn, item_id FROM p WHERE {_IS_PAIR}
UNION ALL SELECT content, conv_id, turn, item_id FROM p WHERE NOT {_IS_PAIR} AND content IS NOT NULL"""
ORACLES["qa_inline_lines"] = ORACLES["qa_inline"]
ORACLES["qa_fan_out_lines"] = f"""
SELECT *, CAST(NULL AS VARCHAR) AS question, CAST(NULL AS VARCHAR) AS response FROM ({ORACLES["qa_fan_out"]})"""
ORACLES["drop_fields"] = "SELECT doc_id, lang, n_chars FROM documents"
ORACLES["harmonize_union"] = """
SELECT conv_id, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS BIGINT) AS item_id, text AS content FROM conversations
UNION ALL SELECT NULL, doc_id, NULL, text FROM documents
UNION ALL SELECT NULL, NULL, item_id, text FROM benchmark"""
ORACLES["wrap_content"] = "SELECT text AS content FROM benchmark"
ORACLES["shared_flag"] = f"SELECT id, shared AS flag FROM ({_LISTING})"
ORACLES["default_value"] = """
SELECT 'run-' || user_id AS run_id, event_id AS step, CASE WHEN event_type <> 'error' THEN value ELSE 0.0 END AS loss
FROM events"""

# --- joins

_POSITIONAL = """
SELECT row_pos, d.doc_id, d.lang, CASE WHEN l.row_pos IS NULL THEN d.n_chars ELSE l.quality END AS quality,
       l.toxic{extra}
FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS row_pos FROM documents) d
LEFT JOIN (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS row_pos FROM labels) l USING (row_pos)"""
ORACLES["positional_join"] = _POSITIONAL.format(extra=", l.doc_id AS label_id")
ORACLES["positional_join_files"] = _POSITIONAL.format(extra="")
ORACLES["compare_resume"] = """
WITH s AS (
  SELECT 'run-' || user_id AS run_id, arg_max(event_id, (ts, event_id)) AS step FROM events
  WHERE event_type IN ('view', 'click', 'signup') GROUP BY user_id),
c AS (SELECT 'run-' || user_id AS run_id, max(event_id) AS checkpoint FROM events
      WHERE event_type = 'purchase' GROUP BY user_id)
SELECT run_id, step, checkpoint,
       CASE WHEN checkpoint IS NOT NULL THEN 'checkpoint-' || checkpoint ELSE 'state' END AS resume_from,
       coalesce(step < checkpoint, false) AS state_is_older
FROM s FULL JOIN c USING (run_id)"""

# --- aggregations

ORACLES["count_json"] = f"""
SELECT count(*) FILTER (WHERE NOT {_BROKEN}) AS n_json, count(*) FILTER (WHERE {_BROKEN}) AS n_malformed FROM documents"""
ORACLES["extra_keys"] = """
SELECT event_id, array_to_string(list_filter(json_keys(props), lambda k: k <> 'content'), ',') AS extra_keys FROM events
WHERE len(list_filter(json_keys(props), lambda k: k <> 'content')) > 0"""
ORACLES["key_profile"] = """
SELECT key, 'BIGINT' AS json_type, count(*) AS n_rows FROM (SELECT unnest(json_keys(props)) AS key FROM events)
GROUP BY key"""
ORACLES["key_profile_records"] = f"""
SELECT * FROM (
  SELECT unnest(['conv_id', 'turn', 'item_id', 'question', 'response', 'content']) AS key,
         unnest(['BIGINT', 'BIGINT', 'BIGINT', 'STRING', 'STRING', 'STRING']) AS json_type,
         unnest([count(conv_id), count(turn), count(item_id), count(question), count(response), count(content)]) AS n_rows
  FROM ({_PAIRS})) WHERE n_rows > 0"""
ORACLES["corpus_stats"] = f"""
SELECT lang, count(*) AS n_rows, count(*) FILTER (WHERE trim(text, {_WS}) <> '') AS n_texts,
       CAST(sum(strlen(text)) AS BIGINT) AS n_bytes, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM documents GROUP BY lang"""
ORACLES["observed_counts"] = "SELECT count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents"
_ALL_WORDS = f"SELECT doc_id, unnest(regexp_extract_all(text, '{_WORDS}')) AS word FROM documents"
_COUNTED = f"SELECT word, count(*) AS n FROM ({_ALL_WORDS}) GROUP BY word"
ORACLES["word_counts"] = f"SELECT * FROM ({_COUNTED}) WHERE n >= 2"
ORACLES["word_counts_topk"] = f"SELECT * FROM ({_COUNTED}) WHERE n >= 3 ORDER BY n DESC, word LIMIT 200"
ORACLES["term_postings"] = f"SELECT word, doc_id, count(*) AS n_in_row FROM ({_ALL_WORDS}) GROUP BY word, doc_id"
ORACLES["term_rows"] = f"""
SELECT word, count(DISTINCT doc_id) AS n_rows, count(*) AS n FROM ({_ALL_WORDS}) GROUP BY word HAVING count(*) >= 2"""
ORACLES["pair_counts"] = f"""
SELECT CAST(unicode(substr(word, i, 1)) AS BIGINT) AS left_code,
       CAST(unicode(substr(word, i + 1, 1)) AS BIGINT) AS right_code, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT word, n, unnest(range(1, length(word))) AS i FROM ({_COUNTED})) GROUP BY ALL"""
ORACLES["newest_checkpoint"] = """
SELECT user_id, max(event_id) AS checkpoint FROM events WHERE event_type NOT IN ('error', 'view') GROUP BY user_id"""

# --- windows

_NEWEST = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)"
ORACLES["retain_last_n"] = f"SELECT user_id, event_id FROM events QUALIFY {_NEWEST} <= 5"
ORACLES["latest_per_key"] = f"SELECT user_id, event_id, value FROM events QUALIFY {_NEWEST} = 1"
ORACLES["row_position"] = """
SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS row_pos FROM documents"""
ORACLES["batch_of_n"] = """
SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 64 AS batch FROM events"""
ORACLES["sample_every_n_steps"] = f"""
SELECT * FROM ({ORACLES["default_value"]}) WHERE step % 500 = 0 AND step > 0"""

# --- sorts, limits

ORACLES["sorted_listing"] = """
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events ORDER BY stamp DESC, event_id"""
ORACLES["page"] = "SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 100"
ORACLES["peek"] = "SELECT doc_id, substr(text, 1, 500) AS content FROM documents ORDER BY doc_id LIMIT 1"

# --- scalar functions

ORACLES["py_strip"] = f"SELECT doc_id, trim({_LEFT} || text || {_RIGHT}, {_WS}) AS content FROM documents"
_ENDS = _chars("".join(chr(c) for c in (0x0D, 0x0A, 0x85, 0x78, 0x0A)))
ORACLES["single_line"] = f"""
SELECT doc_id, {_single_line(f"replace(text, ', ', chr(8232)) || {_ENDS}")} AS content FROM documents"""


def _collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_WS_CLASS}+', ' ', 'g'))"


ORACLES["collapse_ws"] = f"""
SELECT doc_id, {_collapse(f"replace(text, ', ', {_LEFT}) || {_RIGHT}")} AS content FROM documents"""
ORACLES["gunzip_decode"] = "SELECT doc_id, text AS content FROM documents"
ORACLES["decode_lossy"] = "SELECT doc_id, text AS content FROM documents"
ORACLES["decode_as"] = "SELECT doc_id, CASE WHEN lang <> 'de' THEN text END AS content FROM documents"
# The byte alphabet by its rule: visible Latin-1 bytes stay, the others count up from 256.
_BYTE_MAP = """
(SELECT list(CASE WHEN visible THEN chr(b) ELSE chr(CAST(255 + hidden AS INTEGER)) END ORDER BY b) FROM (
   SELECT b, visible, sum(CASE WHEN visible THEN 0 ELSE 1 END) OVER (ORDER BY b) AS hidden FROM (
     SELECT CAST(b AS INTEGER) AS b, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b BETWEEN 174 AND 255 AS visible
     FROM range(256) t(b))))"""
# Byte text of single characters, to be looked up when a text is mapped character by character.
_CHAR_BYTES = f"""
SELECT ch, list_aggregate(list_transform(range(1, CAST(length(hex(encode(ch))) // 2 + 1 AS BIGINT)),
         lambda i: m[CAST('0x' || substr(hex(encode(ch)), CAST(2 * i - 1 AS BIGINT), 2) AS INTEGER) + 1]), 'string_agg', '')
       AS shown
FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents), (SELECT {_BYTE_MAP} AS m)"""
_BYTE_DICT = f"(SELECT map_from_entries(list((ch, shown))) AS d FROM ({_CHAR_BYTES}))"
_TO_BYTES = "array_to_string(list_transform(string_split({text}, ''), lambda c: d[c]), '')"


def _repaired(text: str) -> str:
    for old, new in BYTELEVEL_REPAIRS:
        text = f"replace({text}, {_chars(old)}, {_chars(new)})"
    return text


ORACLES["repair_bytelevel"] = f"""
SELECT doc_id, {_repaired(_TO_BYTES.format(text="text"))} AS content FROM documents, {_BYTE_DICT}"""
_PROMPT = f"substr({_collapse('text')}, 1, 7)"
_CLEANED = _collapse(_repaired("replace(text, ' ', chr(288)) || ' ' || chr(195) || chr(182) || chr(10)"))
ORACLES["clean_generated"] = f"""
SELECT conv_id, turn, prompt || trim(substr(cleaned, CAST(length(prompt) + 1 AS BIGINT)), {_WS}) AS content
FROM (SELECT conv_id, turn, {_PROMPT} AS prompt, {_CLEANED} AS cleaned FROM conversations)"""
ORACLES["to_json_lines"] = """
SELECT '{"doc_id":' || doc_id || ',"note":' || CASE WHEN lang <> 'en' THEN '"' || lang || '"' ELSE 'null' END
       || ',"source":"' || source || '","n_chars":' || n_chars || '}' AS line
FROM documents"""
ORACLES["qa_concat"] = f"""
SELECT conv_id, turn, coalesce(question, 'None') || ' ' || coalesce(response, 'None') AS content
FROM ({_PAIRS}) WHERE question IS NOT NULL"""
ORACLES["parse_stamp_text"] = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts FROM events"""

# --- tokenizer

ORACLES["pretokenize_words"] = f"""
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, md5(array_to_string(words, ' ')) AS words
FROM (SELECT doc_id, regexp_extract_all(text, '{_WORDS}') AS words FROM documents)"""
# No look-ahead in DuckDB: a mark between the last two white spaces of a run that precedes a word
# splits the run in the same place.
_BYTE_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
_MARKED = r"regexp_replace(spaced, '(\s)(\s\S)', '\1' || chr(1) || '\2', 'g')"
_BYTE_LEVEL = f"""
SELECT doc_id, list_transform(flatten(list_transform(string_split({_MARKED}, chr(1)),
         lambda p: regexp_extract_all(p, '{_BYTE_WORDS.replace("'", "''")}'))), lambda w: {_TO_BYTES.format(text="w")}) AS words
FROM (SELECT doc_id, CASE WHEN starts_with(text, ' ') THEN text ELSE ' ' || text END AS spaced FROM documents), {_BYTE_DICT}"""
ORACLES["pretokenize_byte_level"] = f"""
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, md5(array_to_string(words, ' ')) AS words FROM ({_BYTE_LEVEL})"""

_SPECIAL = ", ".join(f"({i}, '{t}')" for i, t in enumerate(SPECIAL_TOKENS))
_N_SPECIAL = len(SPECIAL_TOKENS)


def _training(words: str) -> str:
    """Byte-pair training as a recursion over the word counts, one merge a step.

    A symbol is one character: itself at first, then a private-use character per merge, so that the
    order of symbols is the order of their ids and a merge is a text replacement.
    """
    return f"""
WITH RECURSIVE words AS (SELECT word AS w, count(*) AS n FROM ({words}) GROUP BY word),
chars AS (SELECT ch, row_number() OVER (ORDER BY ch) + {_N_SPECIAL} - 1 AS id
          FROM (SELECT DISTINCT unnest(string_split(w, '')) AS ch FROM words)),
merging AS (
  SELECT 0 AS step, CAST(NULL AS VARCHAR) AS pair, w, w AS s, n FROM words
  UNION ALL
  SELECT merging.step + 1, best.pair, merging.w, replace(merging.s, best.pair, chr(983040 + merging.step)), merging.n
  FROM merging, (
    SELECT pair FROM (
      SELECT substr(s, CAST(i AS BIGINT), 2) AS pair, n
      FROM (SELECT s, n, unnest(range(1, length(s))) AS i FROM merging))
    GROUP BY pair HAVING sum(n) >= 2 ORDER BY sum(n) DESC, pair LIMIT 1) best
  WHERE merging.step < {VOCAB_SIZE - _N_SPECIAL} - (SELECT count(*) FROM chars)),
steps AS (SELECT step, any_value(pair) AS pair FROM merging WHERE step > 0 GROUP BY step),
symbols AS (
  SELECT ch, id FROM chars
  UNION ALL
  SELECT chr(983039 + step), {_N_SPECIAL} - 1 + step + (SELECT count(*) FROM chars) FROM steps)"""


_MERGES = f"""
{_training(_ALL_WORDS)}
SELECT CAST(step - 1 AS BIGINT) AS rank, a.id AS left_id, b.id AS right_id, c.id AS id
FROM steps JOIN symbols a ON a.ch = substr(pair, 1, 1) JOIN symbols b ON b.ch = substr(pair, 2, 1)
     JOIN symbols c ON c.ch = chr(983039 + step)"""
ORACLES["bpe_merges"] = _MERGES
ORACLES["save_load_tokenizer"] = _MERGES
ORACLES["alphabet"] = f"""
SELECT column1 AS token, CAST(column0 AS BIGINT) AS id FROM (VALUES {_SPECIAL}) t(column0, column1)
UNION ALL
SELECT ch, row_number() OVER (ORDER BY ch) + {_N_SPECIAL} - 1
FROM (SELECT DISTINCT unnest(string_split(word, '')) AS ch FROM ({_ALL_WORDS}))"""
ORACLES["special_tokens"] = f"""
SELECT t.token, CAST(t.id AS BIGINT) AS id, (SELECT count(*) FROM documents d WHERE contains(d.text, t.token)) AS n_rows
FROM (VALUES {_SPECIAL}) t(id, token)"""
# Token texts: the pieces of a merge are spelled out step by step.
_BYTE_ROWS = f"SELECT doc_id, unnest(words) AS word FROM ({_BYTE_LEVEL})"
_SPELLED = """,
texts AS (
  SELECT 0 AS step, map_from_entries(list((ch, ch))) AS t FROM chars
  UNION ALL
  SELECT texts.step + 1, map_concat(t, map([chr(983040 + texts.step)], [t[substr(pair, 1, 1)] || t[substr(pair, 2, 1)]]))
  FROM texts JOIN steps ON steps.step = texts.step + 1),
spelled AS (SELECT t FROM texts ORDER BY step DESC LIMIT 1)"""
ORACLES["bpe_vocab_bytes"] = f"""
{_training(_BYTE_ROWS)}{_SPELLED}
SELECT token, CAST(id AS BIGINT) AS id FROM (VALUES {_SPECIAL}) t(id, token)
UNION ALL SELECT t[ch], id FROM symbols, spelled"""


def _encoding(rows: str, words: str) -> str:
    """Ids of each row's words in order; ``rows`` gives doc_id and the word list."""
    return f"""
{_training(words)},
done AS (SELECT w, s FROM merging WHERE step = (SELECT max(step) FROM merging)),
id_of AS (SELECT map_from_entries(list((ch, id))) AS m FROM symbols),
coded AS (SELECT w, list_transform(string_split(s, ''), lambda c: m[c]) AS ids FROM done, id_of),
placed AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM ({rows})),
encoded AS (
  SELECT r.doc_id, coalesce(e.ids, []) AS input_ids FROM ({rows}) r LEFT JOIN (
    SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM placed JOIN coded USING (w) GROUP BY doc_id) e USING (doc_id))"""


_WORD_ROWS = f"SELECT doc_id, regexp_extract_all(text, '{_WORDS}') AS words FROM documents"
_ENCODED = _encoding(_WORD_ROWS, _ALL_WORDS)
_SUMMED = "CAST(len(ids) AS BIGINT) AS n_ids, md5(array_to_string(ids, ' ')) AS ids"
ORACLES["encode_truncate"] = f"{_ENCODED} SELECT doc_id, {_SUMMED} FROM (SELECT doc_id, input_ids[1:8192] AS ids FROM encoded)"
ORACLES["stream_tokens"] = f"""{_ENCODED}
SELECT {_SUMMED} FROM (SELECT input_ids[1:8192] AS ids FROM encoded JOIN documents USING (doc_id)
                       WHERE NOT {_BROKEN} AND trim(text, {_WS}) <> '')"""
ORACLES["encode_bytes"] = f"""
{_encoding(_BYTE_LEVEL, _BYTE_ROWS)} SELECT doc_id, {_SUMMED} FROM (SELECT doc_id, input_ids AS ids FROM encoded)"""
ORACLES["encode_tolerant"] = f"""{_ENCODED}
SELECT doc_id, CASE WHEN lang <> 'de' THEN CAST(len(input_ids) AS BIGINT) END AS n_ids,
       CASE WHEN lang = 'de' THEN 'no text' END AS error
FROM encoded JOIN documents USING (doc_id)"""


def _padded(ids: str, width: str) -> str:
    return f"list_concat({ids}, list_transform(range(CAST(greatest({width} - len({ids}), 0) AS BIGINT)), lambda i: {PAD_ID}))"


ORACLES["pad_to"] = f"""{_ENCODED}
SELECT doc_id, md5(array_to_string({_padded(f"input_ids[1:{PADDED_LENGTH}]", str(PADDED_LENGTH))}, ' ')) AS ids FROM encoded"""
ORACLES["causal_batch"] = f"""{_ENCODED},
cut AS (SELECT doc_id, input_ids[1:8192] AS ids FROM encoded),
numbered AS (SELECT doc_id, ids, (row_number() OVER (ORDER BY doc_id) - 1) // 4 AS batch FROM cut),
sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS width FROM numbered),
padded AS (SELECT *, {_padded("ids", "width")} AS full_ids FROM sized)
SELECT doc_id, batch, md5(array_to_string(full_ids, ' ')) AS ids,
       md5(repeat('1 ', CAST(greatest(len(ids) - 1, 0) AS BIGINT)) || CASE WHEN len(ids) > 0 THEN '1' ELSE '' END
           || CASE WHEN len(ids) > 0 THEN repeat(' 0', CAST(width - len(ids) AS BIGINT))
                   ELSE trim(repeat(' 0', CAST(width AS BIGINT))) END) AS mask,
       md5(array_to_string(list_transform(full_ids, lambda x: CASE WHEN x = {PAD_ID} THEN -100 ELSE x END), ' ')) AS labels
FROM padded"""
ORACLES["decode_tokens"] = f"""{_ENCODED}{_SPELLED},
token_of AS (SELECT map_from_entries(list((id, t[ch]))) AS m FROM symbols, spelled)
SELECT doc_id, array_to_string(list_transform(input_ids, lambda i: m[i]), ' ') AS content FROM encoded, token_of"""

# The piece vocabulary: marked words, covered characters, runs of one script (the documents are in
# Latin script), then a recursion with symbols in brackets of two control characters. One row of the
# recursion keeps the pieces made so far, since a text is made only once.
_FIXED = [*CONTROL_SYMBOLS, *USER_SYMBOLS]
_PIECE_CHARS = rf"""
words AS (
  SELECT chr(9601) || w AS w, count(*) AS n
  FROM (SELECT unnest(string_split_regex({_single_line('text')}, '\s+')) AS w FROM documents) WHERE w <> '' GROUP BY w),
counted AS (SELECT ch, sum(n) AS n FROM (SELECT unnest(string_split(w, '')) AS ch, n FROM words) GROUP BY ch),
ranked AS (
  SELECT ch, n, row_number() OVER (ORDER BY n DESC, ch) - 1 AS rank,
         coalesce(sum(n) OVER (ORDER BY n DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           / (SELECT sum(n) FROM counted) AS share
  FROM counted),
chars AS (SELECT ch, n, rank FROM ranked WHERE CAST(share AS FLOAT) < CAST(0.9995 AS FLOAT))"""
ORACLES["piece_characters"] = f"""
WITH {_PIECE_CHARS} SELECT ch AS symbol, CAST(n AS BIGINT) AS n, rank FROM chars"""
ORACLES["piece_vocab"] = rf"""
WITH RECURSIVE {_PIECE_CHARS},
runs AS (
  SELECT unnest(regexp_extract_all(w, '[0-9]|' || chr(9601) || '?(?:\p{{Latin}}+|[^\p{{Latin}}0-9' || chr(9601) || ']+)|'
                                      || chr(9601))) AS run, n FROM words),
cut AS (
  SELECT unnest(string_split(array_to_string(list_transform(string_split(run, ''),
           lambda c: CASE WHEN list_contains(known, c) THEN c ELSE chr(1) END), ''), chr(1))) AS part, n
  FROM runs, (SELECT list(ch) AS known FROM chars)),
merging AS (
  SELECT 0 AS step, 0 AS kind, chr(2) || array_to_string(string_split(part, ''), chr(3) || chr(2)) || chr(3) AS s,
         sum(n) AS n FROM cut WHERE length(part) > 1 GROUP BY part
  UNION ALL SELECT 0, 1, chr(4), 0
  UNION ALL
  SELECT merging.step + 1, kind,
         CASE WHEN kind = 1 THEN s || best.l || best.r || chr(4)
              ELSE replace(s, chr(2) || l || chr(3) || chr(2) || r || chr(3), chr(2) || l || r || chr(3)) END, merging.n
  FROM merging, (
    SELECT l, r FROM (
      SELECT symbols[i] AS l, symbols[i + 1] AS r, n FROM (
        SELECT symbols, n, unnest(range(1, len(symbols))) AS i FROM (
          SELECT string_split(substr(s, 2, CAST(length(s) - 2 AS BIGINT)), chr(3) || chr(2)) AS symbols, n
          FROM merging WHERE kind = 0))),
      (SELECT s AS made FROM merging WHERE kind = 1)
    WHERE length(l || r) <= {MAX_PIECE} AND NOT contains(made, chr(4) || l || r || chr(4))
    GROUP BY l, r ORDER BY sum(n) DESC, length(l || r), l || r, l LIMIT 1) best
  WHERE merging.step < {PIECE_VOCAB_SIZE} - {len(_FIXED) + 256} - (SELECT count(*) FROM chars)),
made AS (
  SELECT string_split(substr(s, 2, CAST(length(s) - 2 AS BIGINT)), chr(4)) AS pieces FROM merging WHERE kind = 1
  ORDER BY step DESC LIMIT 1)
SELECT piece, CAST(id AS BIGINT) AS id FROM (VALUES {", ".join(f"({i}, '{t}')" for i, t in enumerate(_FIXED))}) t(id, piece)
UNION ALL SELECT printf('<0x%02X>', b), b + {len(_FIXED)} FROM range(256) t(b)
UNION ALL SELECT pieces[i], i + {len(_FIXED) + 255}
FROM (SELECT pieces, unnest(range(1, len(pieces) + 1)) AS i FROM made)
UNION ALL SELECT ch, rank + {len(_FIXED) + 256} + (SELECT len(pieces) FROM made) FROM chars"""

# The texts hold nothing that normalization changes but repeated spaces.
ORACLES["piece_round_trip"] = f"""
SELECT doc_id, trim(regexp_replace({_single_line('text')}, ' +', ' ', 'g')) AS content FROM documents"""

# --- streaming

_KEPT = f"NOT {_BROKEN} AND trim(text, {_WS}) <> ''"
ORACLES["stream_corpus"] = f"""
SELECT text AS content FROM documents WHERE {_KEPT} UNION ALL SELECT text FROM documents WHERE {_KEPT}"""
ORACLES["stream_dead_letters"] = _CUT

# --- user functions

ORACLES["map_rows"] = "SELECT conv_id, turn, role || ': ' || text AS content FROM conversations"
ORACLES["map_batches"] = "SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS n_chars FROM conversations"
ORACLES["lazy_map"] = "SELECT item_id, reverse(text) AS content FROM benchmark"
