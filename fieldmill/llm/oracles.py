"""SQL for those results of this package that SQL can express; for small tables, since it spells every window out."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTER_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

DECONTAMINATE = f"""
    WITH items AS (SELECT item_id, {_LETTER_WORDS} AS w FROM benchmark),
    sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0),
    wanted AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
    sizes AS (SELECT DISTINCT n FROM wanted),
    docs AS (SELECT doc_id, {_LETTER_WORDS} AS w FROM documents),
    windows AS (
        SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
    hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN wanted USING (n, win)),
    hit_words AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
    hit_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(20 * n_hit >= len(w), false) AS contaminated
    FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

SUBSTRING_DEDUP = f"""
    WITH docs AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
    windows AS (
        SELECT doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)),
    firsts AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
        FROM windows JOIN firsts USING (win) WHERE first < doc_id),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
        FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (doc_id)"""

NEAR_VECTORS = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    normed AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM usable),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM normed a JOIN normed b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE CASE WHEN len(a.v) = len(b.v) THEN list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98 END),
    reached(a, b) AS (
        SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
    SELECT vec_id, coalesce(n, 0) AS n_links, component AS component_id, vec_id = component AS kept
    FROM embeddings JOIN (SELECT a, min(b) AS component FROM reached GROUP BY 1) r ON vec_id = r.a
    LEFT JOIN counts c ON vec_id = c.a"""

HARD_NEGATIVES = """
    WITH usable AS (
        SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.id AS anchor, b.id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.q) = len(b.q)),
    positives AS (
        SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
    SELECT p.anchor AS anchor_id, p.id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
           n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n
      ON p.anchor = n.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
    QUALIFY rank <= 5"""

_EDITS = ", ".join(
    f"""list_min(list_filter([
            {{'c': 2 + v[{q + 1}].c, 'a': 'D' || v[{q + 1}].a}},
            {{'c': CASE WHEN fault < 2 {keep} END, 'a': 'K' || {kept}}},
            {{'c': CASE WHEN fault < 2 THEN 1 + 5 * fault + v[{due}].c END, 'a': 'R' || v[{due}].a}}],
            lambda x: x.c IS NOT NULL))"""
    for q, due, keep, kept in [
        (
            0,
            3,
            "AND initial = 's' THEN 5 * fault + v[2].c WHEN fault < 2 AND initial = 'u' THEN 5 * fault + v[3].c",
            "CASE initial WHEN 's' THEN v[2].a ELSE v[3].a END",
        ),
        (1, 3, "AND initial = 'u' THEN 5 * fault + v[3].c", "v[3].a"),
        (2, 4, "AND initial = 'a' THEN 5 * fault + v[4].c", "v[4].a"),
        (3, 3, "AND initial = 'u' THEN 5 * fault + v[3].c", "v[3].a"),
    ]
)
_INSERTS = ", ".join(
    f"least(w[{q + 1}], {{'c': 5 + w[{due}].c, 'a': 'I' || w[{due}].a}}, {{'c': 10 + w[{then}].c, 'a': 'II' || w[{then}].a}})"
    for q, due, then in [(0, 3, 4), (1, 3, 4), (2, 4, 3), (3, 3, 4)]
)
_WHITE = r"\x20\x09-\x0D"

CONVERSATION_REPAIR = f"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n)) AS t),
    named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(4294967295, list_reduce(list_transform(string_split(
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                   lambda ch: CAST(ascii(ch) AS BIGINT)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) % 20 AS damage
        FROM conversations, crc),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
               CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN damage = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM named WHERE damage <> 0),
    placed AS (
        SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
               lag(role) OVER w AS before
        FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
    coded AS (
        SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial,
               CASE WHEN NOT regexp_matches(text, '[^{_WHITE}]') THEN 2 WHEN seen > 1 THEN 3
                    WHEN NOT regexp_matches(text, '[.!?][{_WHITE}]*$') THEN 1 ELSE 0 END AS fault
        FROM placed),
    facts AS (
        SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate,
               count(*) FILTER (fault = 1) AS truncated,
               count(*) FILTER (i > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
        FROM coded GROUP BY conv_id),
    dp(conv_id, i, v) AS (
        SELECT conv_id, n, [{{'c': CAST(0 AS BIGINT), 'a': ''}}, {{'c': 10, 'a': 'II'}}, {{'c': 5, 'a': 'I'}}, {{'c': 0, 'a': ''}}] FROM facts
        UNION ALL
        SELECT conv_id, i, [{_INSERTS}] FROM (
            SELECT dp.conv_id, dp.i - 1 AS i, [{_EDITS}] AS w
            FROM dp JOIN coded ON dp.conv_id IS NOT DISTINCT FROM coded.conv_id AND dp.i = coded.i)),
    audits AS (SELECT conv_id, v[1].c AS cost, v[1].a AS audit FROM dp WHERE i = 0),
    letters AS (
        SELECT conv_id, k, substr(audit, k, 1) AS edit
        FROM (SELECT *, unnest(range(1, len(audit) + 1)) AS k FROM audits)),
    edits AS (
        SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS said
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
    lines AS (
        SELECT e.conv_id, e.k, e.edit, e.said, c.role, CASE WHEN e.edit = 'I' THEN '' ELSE c.text END AS text,
               max(CASE WHEN e.said = 1 AND e.edit = 'K' AND c.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
        FROM edits e LEFT JOIN coded c ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.i = c.i AND e.edit <> 'I'
        WHERE e.edit <> 'D'),
    said AS (
        SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (said - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                   || ':' || text, chr(10) ORDER BY k) AS text
        FROM lines GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(s.text, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
    LEFT JOIN audits a ON c.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN said s ON c.conv_id IS NOT DISTINCT FROM s.conv_id"""

SUFFIX_DEDUP = """
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (
        SELECT r, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 800)) AS win
        FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM docs WHERE len(h) >= 800)),
    again AS (
        SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before
        FROM windows JOIN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1) USING (win)),
    numbered AS (
        SELECT r, i, sum(CASE WHEN before >= i - 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS span FROM again),
    spans AS (SELECT r, span, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY r, span),
    pieces AS (
        SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS done FROM spans),
    cut AS (
        SELECT docs.r, sum(b - a) AS n_removed, count(*) AS n_spans,
               string_agg(substr(h, CAST(2 * done + 1 AS BIGINT), CAST(2 * (a - done) AS BIGINT)), '' ORDER BY a)
                   || substr(any_value(h), CAST(2 * max(b) + 1 AS BIGINT)) AS kept
        FROM docs JOIN pieces USING (r) GROUP BY docs.r)
    SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM docs LEFT JOIN cut USING (r)"""
