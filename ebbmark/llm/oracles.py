"""DuckDB SQL for the queries that SQL can express, apart from the code it tests."""

from __future__ import annotations

_PRIVATE = r"""
WITH kinds(place, name, pattern, prior, near, far) AS (VALUES
    (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+', 0.9, 'email|e-mail|mail|contact|correo|courriel', 'example|sample|dummy|test'),
    (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)', 0.5, 'ip|address|host|server|login|adresse', 'version|release|section|chapter'),
    (2, 'card', '[0-9]([\x20-]?[0-9])+', 0.7, 'card|credit|debit|visa|karte|tarjeta|carte', 'isbn|order|test|example'),
    (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]', 0.6, 'phone|call|tel|mobile|fax|telefon|teléfono|téléphone', 'example|sample|dummy|test'),
    (4, 'iban', '[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?', 0.75, 'iban|account|konto|bank|cuenta|compte', 'example|sample|dummy|test'),
    (5, 'ssn', '[0-9]+(-[0-9]+)+', 0.35, 'ssn|social|security', 'example|sample|dummy|test')),
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT doc_id, place, name, prior, near, far,
        regexp_extract_all(text, pattern) AS found, string_split_regex(text, pattern) AS gaps
    FROM texts, kinds),
placed AS (
    SELECT doc_id, place, name, prior, near, far, found[i] AS value,
        coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0) AS start,
        translate(right(gaps[i], 48) || ' ' || left(gaps[i + 1], 24), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS around
    FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM split)),
checked AS (
    SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits, replace(value, ' ', '') AS plain FROM placed),
passed AS (
    SELECT * FROM checked WHERE CASE name
        WHEN 'email' THEN true
        WHEN 'ip' THEN len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(right(p, 3) AS INTEGER), 0) > 255)) = 0
        WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND
            list_sum(list_transform(range(1, length(digits) + 1), lambda k:
                CASE WHEN k % 2 = 1 THEN CAST(reverse(digits)[k] AS INTEGER)
                     WHEN CAST(reverse(digits)[k] AS INTEGER) > 4 THEN CAST(reverse(digits)[k] AS INTEGER) * 2 - 9
                     ELSE CAST(reverse(digits)[k] AS INTEGER) * 2 END)) % 10 = 0
        WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
        WHEN 'iban' THEN length(plain) BETWEEN 15 AND 34 AND
            list_reduce(list_concat([0], list_transform(string_split(substr(plain, 5) || substr(plain, 1, 4), ''), lambda c: ascii(c) - CASE WHEN c >= 'A' THEN 55 ELSE 48 END)),
                lambda n, v: (n * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1
        ELSE regexp_full_match(value, '[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}') AND NOT regexp_matches(value, '^(000|666)|-00-|-0000$') END),
scored AS (
    SELECT *, start + length(value) AS stop, round(least(1.0, greatest(0.0, CAST(prior AS DOUBLE)
        + CASE WHEN regexp_matches(around, '(^|[^a-z0-9])(' || near || ')([^a-z0-9]|$)') THEN 0.3 ELSE 0 END
        - CASE WHEN regexp_matches(around, '(^|[^a-z0-9])(' || far || ')([^a-z0-9]|$)') THEN 0.3 ELSE 0 END)), 2) AS score
    FROM passed),
kept AS (SELECT *, name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM scored WHERE place < 4 OR score >= 0.6)
SELECT t.doc_id,
    count(*) FILTER (k.name = 'email') AS n_email, count(*) FILTER (k.name = 'ip') AS n_ip,
    count(*) FILTER (k.name = 'card') AS n_card, count(*) FILTER (k.name = 'phone') AS n_phone,
    sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (place < 4), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans,
    coalesce(string_agg(CAST(CAST(score AS DOUBLE) AS VARCHAR), ',' ORDER BY start, place), '') AS span_scores
FROM texts t LEFT JOIN kept k USING (doc_id) GROUP BY t.doc_id
"""

_PREFIX_TRIE = """
WITH ordered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM ordered GROUP BY conv_id),
numbered AS (
    -- The crc32 of the decimal text, a bit at a time.
    SELECT *, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda v, ignored: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 9 AS h
    FROM own),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(o.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM numbered c LEFT JOIN own o ON o.conv_id = c.conv_id - (c.conv_id % 5 + 5) % 5),
prefixes AS (
    SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) = d AS ends, coalesce(strlen(turns[d].text), 0) AS bytes
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, prefix),
children AS (SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, prefix)),
below AS (
    SELECT over AS depth, prefix[1:over] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS over FROM whole) GROUP BY ALL)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN below b USING (depth, prefix) LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.prefix = w.prefix[1:w.depth - 1]
"""

_HARD_NEGATIVES = """
WITH taking_part AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS components
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.components, b.components) AS BIGINT) AS score
    FROM taking_part a JOIN taking_part b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLES: dict[str, str] = {
    "op11_prefix_trie": _PREFIX_TRIE,
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_pii": _PRIVATE,
}
