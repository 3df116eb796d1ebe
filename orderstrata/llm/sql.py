"""DuckDB SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from orderstrata.llm.licenses import TEMPLATES
from orderstrata.llm.queries import CONTROL_TEXT

# Two backslashes in the pattern stand for one; \1 is what was between the two characters.
_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"
_BODY, _ROLE = _ESCAPED.format("text"), _ESCAPED.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")

_CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
    UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
),
placed AS (
    SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
    FROM turns
),
stepped AS (
    SELECT *, (before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'),
        ('user', 'assistant'), ('assistant', 'user')) AS allowed
    FROM placed
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
        ORDER BY turn, role, text)) AS loss_sha256,
    sum(length('<|im_start|>') + length({_ROLE}) + length({_BODY})
        + length('<|im_end|>') + 2)::BIGINT AS formatted_chars,
    bool_and(allowed) AND arg_max(role, (turn, role, text)) = 'assistant' AS valid
FROM stepped
GROUP BY conv_id
"""

_WORDS = r"list_filter(string_split(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"


def _shingles(source: str, key: str, text: str, least: int) -> str:
    """Distinct runs of five words with the place of the first; shorter texts as one run."""
    words = _WORDS.format(text)
    return f"""
    SELECT {key}, s, min(k) AS k FROM (
        SELECT {key}, k - 1 AS k, array_to_string(w[k : k + 4], ' ') AS s FROM (
            SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k
            FROM (SELECT {key}, {words} AS w FROM {source}) WHERE len(w) >= {least}
        )
    ) GROUP BY {key}, s"""


_LEAKS = f"""
WITH items AS ({_shingles("benchmark", "item_id", "text", 1)}),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
runs AS ({_shingles("documents", "doc_id", "text", 5)})
SELECT doc_id, item_id, n AS item_shingles, count(*) AS shared, count(*) / n AS containment
FROM runs JOIN items USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n
HAVING count(*) >= 0.8 * n - 1e-9
"""

_TEMPLATES = ", ".join(f"('{key}', '{text}')" for key, text in TEMPLATES)
_LICENSES = f"""
WITH templates(license_id, text) AS (VALUES {_TEMPLATES}),
wanted AS ({_shingles("templates", "license_id", "text", 5)}),
sizes AS (SELECT license_id, count(*) AS n FROM wanted GROUP BY license_id),
runs AS ({_shingles("documents", "doc_id", "text", 5)})
SELECT doc_id, license_id, n AS template_shingles, count(*) AS shared,
    count(*) / n AS containment, min(runs.k) AS first_word
FROM runs JOIN wanted USING (s) JOIN sizes USING (license_id)
GROUP BY doc_id, license_id, n
HAVING count(*) >= 0.8 * n - 1e-9
"""

_NEAREST = """
WITH usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]),
            lambda total, x: total + x) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_WARC = """
WITH records AS (
    SELECT page_id, url, coalesce(html, '') AS html, encode(coalesce(html, '')) AS bytes
    FROM pages
),
held AS (
    SELECT page_id, coalesce(url, '') AS url, octet_length(bytes) AS payload_bytes,
        sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS holder,
        row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place
    FROM records
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND place > 1 AND holder IS NOT NULL
        THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND place > 1 THEN holder END AS refers_to,
    replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS url
FROM held
"""

# The check sum of a decimal number, bit by bit; DuckDB has no function for it.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split({0}::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], range(8)),
        lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""

_TRIE = f"""
WITH turns AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        role, sha256(length(role)::VARCHAR || ':' || role || text)) AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS head, {_CRC32.format("conv_id")} % 4 AS taken
    FROM (SELECT DISTINCT conv_id FROM turns)
),
rebuilt AS (
    SELECT c.conv_id, place, role, text FROM convs c JOIN turns t ON t.conv_id = head AND place <= taken
    UNION ALL SELECT conv_id, place, role, text FROM turns JOIN convs USING (conv_id) WHERE place > taken
),
paths AS (
    SELECT conv_id, coalesce(path, []) AS path FROM convs LEFT JOIN (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS path
        FROM rebuilt GROUP BY conv_id) USING (conv_id)
),
nodes AS (
    SELECT prefix, len(prefix) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        bool_and(ends) AS leaf, (count(*) - 1) * coalesce(len(regexp_extract_all(prefix[-1].text,
            '[^\x20\x09-\x0D]+')), 0) AS saved
    FROM (SELECT conv_id, path[1:d] AS prefix, d = len(path) AS ends
          FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths))
    GROUP BY prefix
),
sums AS (
    SELECT prefix[1:d] AS prefix, sum(leaf::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM nodes) GROUP BY ALL
),
children AS (
    SELECT prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
),
ends AS (
    SELECT path AS prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest
    FROM paths GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
    n_leaves, saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
JOIN sums s ON s.prefix = n.prefix
LEFT JOIN children c ON c.prefix = n.prefix
LEFT JOIN ends e ON e.prefix = n.prefix
"""

# Bytes as two hexadecimal digits each; every string of 50 bytes by its digest.
_REPEATS = """
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
        hex(encode(coalesce(text, ''))) AS digits
    FROM documents
),
strings AS (
    SELECT doc, id, place, md5(substr(digits, 2 * place + 1, 100)) AS string
    FROM (SELECT doc, id, digits, unnest(range(length(digits) // 2 - 49)) AS place FROM docs)
),
firsts AS (SELECT string, min(id) AS first FROM strings GROUP BY string HAVING min(id) < max(id)),
gone AS (SELECT doc, place FROM strings JOIN firsts USING (string) WHERE first < id),
spans AS (
    SELECT doc, min(place) AS low, max(place) + 50 AS high FROM (
        SELECT doc, place, sum(opens) OVER (PARTITION BY doc ORDER BY place) AS span FROM (
            SELECT doc, place, (coalesce(place - lag(place) OVER
                (PARTITION BY doc ORDER BY place), 51) > 50)::INTEGER AS opens FROM gone))
    GROUP BY doc, span
),
pieces AS (
    SELECT doc, string_agg(substr(digits, 2 * past + 1, 2 * (low - past)), '' ORDER BY low) AS kept,
        sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS last
    FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY doc ORDER BY low), 0) AS past FROM spans)
    JOIN docs USING (doc) GROUP BY doc
)
SELECT doc_id, (length(digits) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(kept || substr(digits, 2 * last + 1), digits))) AS kept_sha256
FROM docs LEFT JOIN pieces USING (doc)
"""

_SPANS = """
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, w FROM (SELECT doc_id,
        coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents)
),
windows AS (
    SELECT doc, place, sha256(array_to_string(w[place : place + 34], ' ')) AS run
    FROM (SELECT doc, w, unnest(range(1, len(w) - 33)) AS place FROM docs)
),
repeated AS (SELECT run FROM windows GROUP BY run HAVING count(*) > 1),
gone AS (
    SELECT doc, list(DISTINCT word) AS words
    FROM (SELECT doc, unnest(range(place, place + 35)) AS word FROM windows JOIN repeated USING (run))
    GROUP BY doc
),
words AS (
    SELECT doc, string_agg(word, ' ' ORDER BY place) AS kept
    FROM (SELECT doc, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs)
    ANTI JOIN (SELECT doc, unnest(words) AS place FROM gone) USING (doc, place)
    GROUP BY doc
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(words), 0)::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (doc) LEFT JOIN words USING (doc)
"""

_FOLDED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_FOLDED.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_SEARCH = f"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, w FROM (SELECT doc_id, {_TERMS} AS w FROM documents)
    WHERE len(w) > 0
),
sizes AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS total FROM docs),
uses AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM uses, sizes GROUP BY term, n
),
asked AS (
    SELECT DISTINCT item, item_id, unnest(w) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS w FROM benchmark)
),
scores AS (
    SELECT item, item_id, doc, doc_id,
        sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * n) // total))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN uses USING (term) JOIN docs USING (doc), sizes
    GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scores WHERE score > 0)
WHERE rank <= 10
"""

ORACLE_SQL = {
    "op1_chat_format": _CHAT,
    "op2_suffix_array_dedup": _REPEATS,
    "op4_benchmark_decontamination": _LEAKS,
    "op6_nearest_neighbours": _NEAREST,
    "op8_license_scan": _LICENSES,
    "op10_warc": _WARC,
    "op11_prefix_trie": _TRIE,
    "op12_substring_dedup": _SPANS,
    "op13_ranked_search": _SEARCH,
}
