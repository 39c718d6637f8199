"""SQL of those named queries that SQL can express."""

from __future__ import annotations

from clickledger.llm.licences import SIGNS, SPELLINGS, TERMS, TITLE, known_texts

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Lines of signs only, owner lines and titles as the operator has them, in patterns that look nowhere ahead:
#: where "copyright" speaks of the terms a mark, which later becomes a space, is put behind it first.
_EDGE = r"[ \t\r*#/;!-]*"
_SIGN = r"(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|[\[{<(]y)|\(c\)|©)"
_OF_TERMS = rf"(\n{_EDGE}copyright)([ \t]+(?:{TERMS})(?:[^a-z]|\z))"
_OWNER = rf"\n{_EDGE}(?:{_SIGN}|copyright[ \t])[^\n]*"
_TITLES = rf"(?:[\s\x0B*#/;!.,:()\"'-]*(?:{TITLE})\b)*"
_HEAD = rf"\A((?:{_TITLES}(?:[ \t\r\f\x0B.*#/;!)-]*\n)*[ \t\r\f\x0B.*#/;!)-]*{_OWNER})*)"
_TAIL = rf"(?:\n{_EDGE}(?:{_SIGN}[^\n]*)?)+"


def _marked(text: str) -> str:
    return rf"regexp_replace({text}, {_quoted(_OF_TERMS)}, '\1' || chr(1) || '\2', 'g')"


def _level(text: str) -> str:
    text = f"(regexp_replace({text}, {_quoted(SIGNS)}, ' ', 'g') || ' ')"
    for other, one in SPELLINGS:
        text = f"replace({text}, '{other}', '{one}')"
    return text


_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known_texts())
_APPENDIX, _LICENSED = " third party archives copyright ", " licensed under the apache license version 2 0 "

_WORD = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _small(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


ORACLE: dict[str, str] = {
    "op3_zstandard_archives": """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages
), named AS (
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM payloads
), copied AS (
    SELECT payload_digest, min(page_id) AS first
    FROM named WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1
), joined AS (
    SELECT named.*, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM named LEFT JOIN copied USING (payload_digest)
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM joined
""",
    "op5_canonical_digests": f"""
WITH known (license_id, text) AS (VALUES {_KNOWN}), texts AS (
    SELECT NULL AS doc_id, license_id, text, TRUE AS listed FROM known
    UNION ALL SELECT doc_id, NULL, text, FALSE FROM documents
), marked AS (
    SELECT doc_id, license_id, listed,
        {_marked(_marked("chr(10) || translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + "')"))} AS t
    FROM texts
), parted AS (
    SELECT *, regexp_extract(t, {_quoted(_HEAD)}, 1) AS head FROM marked
), begun AS (
    SELECT doc_id, license_id, listed,
        regexp_replace(head, {_quoted(_OWNER)}, chr(10), 'g') || substr(t, length(head) + 1) AS t
    FROM parted
), ended AS (
    SELECT doc_id, license_id, listed,
        CASE WHEN regexp_full_match(t, {_quoted(_TAIL)}) THEN t
            ELSE regexp_replace(t, {_quoted(_TAIL + chr(92) + "z")}, '') END AS t
    FROM begun
), level AS (
    SELECT doc_id, license_id, listed, {_level("t")} AS t FROM ended
), owned AS (
    SELECT *, strpos(t, '{_APPENDIX}') + length(' third party archives ') AS first,
        strpos(substr(t, strpos(t, '{_APPENDIX}') + length('{_APPENDIX}') - 1), '{_LICENSED}') AS further
    FROM level
), canonical AS (
    SELECT doc_id, license_id, listed, CASE WHEN contains(t, '{_APPENDIX}') AND further > 0
        THEN substr(t, 1, first - 1) || substr(t, first + length('copyright ') + further - 2) ELSE t END AS t
    FROM owned
), digests AS (
    SELECT doc_id, license_id, listed, sha256(trim(replace(t, ' all rights reserved ', ' '))) AS license_digest
    FROM canonical
), named AS (
    SELECT license_digest, min(license_id) AS license_id FROM digests
    WHERE listed AND license_digest <> sha256('') GROUP BY license_digest
)
SELECT doc_id, license_digest, named.license_id FROM digests LEFT JOIN named USING (license_digest) WHERE NOT listed
""",
    "op8_rule_cascade": rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
    SELECT *,
        regexp_extract_all(text, '{_WORD}') AS words,
        list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '{_WORD}')) AS lines
    FROM texts
), placed AS (
    SELECT row_no, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM cut
), windows AS (
    SELECT row_no, place, word,
        lead(word, 1) OVER seq AS second, lead(word, 2) OVER seq AS third
    FROM placed WINDOW seq AS (PARTITION BY row_no ORDER BY place)
), again AS (
    SELECT row_no, unnest([place, place + 1, place + 2]) AS place
    FROM (
        SELECT *, count(*) OVER (PARTITION BY row_no, word, second, third) AS n
        FROM windows WHERE third IS NOT NULL
    ) WHERE n > 1
), repeated AS (
    SELECT row_no, count(DISTINCT place) AS n FROM again GROUP BY row_no
), commonest AS (
    SELECT row_no, max(n) AS n
    FROM (SELECT row_no, word, count(*) AS n FROM placed GROUP BY row_no, word) GROUP BY row_no
), counted AS (
    SELECT doc_id,
        len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
        coalesce(commonest.n, 0) AS n_commonest,
        length(text) - length(replace(text, '!', '')) AS n_bangs,
        length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
        length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS n_digits
    FROM cut LEFT JOIN repeated USING (row_no) LEFT JOIN commonest USING (row_no)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed
        OR word_chars < 3 * n_words OR word_chars > 10 * n_words
        OR 10 * n_symbols > n_words
        OR 2 * n_bangs > n_words
        OR 10 * n_capitals > 3 * word_chars
        OR 5 * n_digits > word_chars
        OR 2 * n_dup_lines > n_lines
        OR 10 * n_commonest > 3 * n_words
        OR 5 * n_repeat_words > 2 * n_words) AS kept
FROM judged
""",
    "op12_segment_resampling": rf"""
WITH crc AS MATERIALIZED (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS steps
), base AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all({_small("text")}, '{_LETTERS}') AS words
    FROM documents
), placed AS MATERIALIZED (
    SELECT row_no, unnest(words) AS word FROM base
), aimed AS MATERIALIZED (
    SELECT unnest(regexp_extract_all({_small("text")}, '{_LETTERS}')) AS word FROM benchmark
), spelled AS (
    SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM placed UNION SELECT word FROM aimed)
), hashed AS MATERIALIZED (
    SELECT word, xor(list_reduce(
        list_transform(range(strlen(word)), lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM spelled, crc
), all_docs AS (
    SELECT bucket, count(*) AS s FROM placed JOIN hashed USING (word) GROUP BY bucket
), all_aimed AS (
    SELECT bucket, count(*) AS t FROM aimed JOIN hashed USING (word) GROUP BY bucket
), sums AS (
    SELECT (SELECT count(*) FROM placed) AS all_s, (SELECT count(*) FROM aimed) AS all_t
), gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE)
        / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
    FROM all_docs LEFT JOIN all_aimed USING (bucket), sums
), weights AS (
    SELECT row_no, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM placed JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row_no
), scored AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM base LEFT JOIN weights USING (row_no)
), ranked AS (
    SELECT *, n_features >= 20 AND doc_id IS NOT NULL AS fit,
        row_number() OVER (PARTITION BY n_features >= 20 AND doc_id IS NOT NULL ORDER BY score DESC, doc_id) AS place,
        count(*) OVER (PARTITION BY n_features >= 20 AND doc_id IS NOT NULL) AS n_fit
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 10 * n_fit // 100 THEN place END AS rank
FROM ranked
""",
    "op13_prefix_tree_join": rf"""
WITH RECURSIVE cut AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all({_small("text")}, '{_WORD}') AS words
    FROM documents
), sets AS MATERIALIZED (
    SELECT row_no, doc_id, list_distinct(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS items
    FROM cut
), placed AS MATERIALIZED (
    SELECT row_no, doc_id, len(items) AS n, unnest(items) AS item FROM sets WHERE doc_id IS NOT NULL
), links AS MATERIALIZED (
    SELECT DISTINCT a, b FROM (
        SELECT one.doc_id AS a, two.doc_id AS b
        FROM placed AS one JOIN placed AS two ON one.item = two.item AND one.row_no <> two.row_no
        GROUP BY one.row_no, two.row_no, one.doc_id, two.doc_id, one.n, two.n
        HAVING 100 * count(*) >= 85 * (one.n + two.n - count(*)))
), reach AS (
    SELECT DISTINCT doc_id, doc_id AS other FROM placed
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), lowest AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(items)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN lowest USING (doc_id)
""",
}
