"""The queries' equivalents in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(separators: str) -> str:
    return f"list_filter(string_split_regex({_LOWER}, '[{separators}]+'), lambda w: w <> '')"


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, by the table of its reflected polynomial."""
    codes = []
    for code in range(256):
        for _ in range(8):
            code = (code >> 1) ^ (0xEDB88320 if code & 1 else 0)
        codes.append(code)
    data = f"regexp_extract_all(hex(encode(coalesce({text}, ''))), '..')"
    data = f"list_transform({data}, lambda x: ('0x' || x)::BIGINT)"
    step = f"xor(c >> 8, ({codes}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {step}), 4294967295)"


REPEATS = """
    WITH t AS (
      SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n, hex(encode(coalesce(text, ''))) AS h
      FROM documents),
    w AS (
      SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS bytes
      FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM t WHERE n >= 50)),
    gone AS (
      SELECT doc_id, p
      FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY bytes) AS first_doc FROM w)
      WHERE first_doc < doc_id),
    marked AS (
      SELECT doc_id, p, CASE WHEN p <= lag(p) OVER x + 50 THEN 0 ELSE 1 END AS starts
      FROM gone WINDOW x AS (PARTITION BY doc_id ORDER BY p)),
    numbered AS (
      SELECT doc_id, p,
             sum(starts) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS span
      FROM marked),
    spans AS (
      SELECT doc_id, span, min(p) AS a, max(p) + 50 AS e FROM numbered GROUP BY doc_id, span),
    gaps AS (
      SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since
      FROM spans),
    kept AS (
      SELECT doc_id, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last_end,
             string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS front
      FROM gaps JOIN t USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed,
           coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last_end, 0) + 1)))
             AS kept_sha256
    FROM t LEFT JOIN kept USING (doc_id)
"""

_LETTER_WORDS = _words(r"\x00-\x2F\x3A-\x60\x7B-\x7F")

CONTAMINATION = f"""
    WITH d AS (SELECT doc_id, {_LETTER_WORDS} AS words FROM documents),
    b AS (SELECT item_id, {_LETTER_WORDS} AS words FROM benchmark),
    w AS (
      SELECT DISTINCT item_id, least(len(words), 13) AS n,
             array_to_string(list_slice(words, s, s + 12), ' ') AS phrase
      FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s
            FROM b WHERE len(words) > 0)),
    sizes AS (SELECT DISTINCT n FROM w),
    p AS (
      SELECT doc_id, n, s, array_to_string(list_slice(words, s, s + n - 1), ' ') AS phrase
      FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
            FROM d, sizes WHERE len(words) >= n)),
    found AS (SELECT doc_id, item_id, s, n FROM p JOIN w USING (n, phrase)),
    hit AS (
      SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
    items AS (
      SELECT doc_id, count(DISTINCT item_id) AS n_items,
             sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ','
                               ORDER BY CAST(item_id AS VARCHAR))) AS items_sha256
      FROM found GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ARCHIVES = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    m AS (
      SELECT page_id, payload, min(page_id) OVER (PARTITION BY payload) AS first_page,
             sha1(payload) AS digest FROM p)
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST(((('0x' || substr(digest, CAST(i // 4 * 5 + 1 AS INTEGER), 5))::BIGINT
                      >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '')
             AS payload_digest,
           CASE WHEN page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id > first_page THEN first_page END AS refers_to
    FROM m
"""

_BLANK_WORDS = _words(r"\x20\x09-\x0D")

SIMILAR = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_BLANK_WORDS} AS words FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 2), ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i
            FROM d WHERE len(words) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
    links AS (
      SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
      WHERE 100 * both_have >= 90 * (x.n + y.n - both_have)),
    reach AS (
      SELECT doc_id, doc_id AS other FROM documents
      UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
    SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
    FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


# Words one edit apart agree when one letter is left out of one of them (or masked in both), so
# neighbours meet on those texts.  Five rounds of doubling follow chains of up to 32 forms; a
# chain has at most 19, as every form is ten times as frequent as its word.
SPELLING = f"""
    WITH runs AS (
      SELECT doc_id, run, count(*) AS n, {crc32("(doc_id::VARCHAR || ':' || run)")}::BIGINT AS h
      FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents)
      WHERE length(run) >= 7 GROUP BY doc_id, run),
    cut AS (
      SELECT n, CASE WHEN h % 31 = 0
                     THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
                     ELSE run END AS word FROM runs),
    v AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7
          GROUP BY word HAVING sum(n) >= 2),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v),
    less AS (SELECT DISTINCT word, n, substr(word, 1, p - 1) || substr(word, p + 1) AS key FROM places),
    masked AS (SELECT word, n, substr(word, 1, p - 1) || '*' || substr(word, p + 1) AS key FROM places),
    near AS (
      SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN v b ON a.key = b.word
      UNION ALL SELECT b.word, a.word, a.n FROM less a JOIN v b ON a.key = b.word
      UNION ALL SELECT a.word, b.word, b.n FROM masked a JOIN masked b ON a.key = b.key AND a.word <> b.word),
    best AS (
      SELECT word, count(*) AS n_near, max(near_n) AS often,
             min(encode(near)) FILTER (near_n = most) AS first_near
      FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word),
    f AS (
      SELECT word, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN often >= 10 * n THEN decode(first_near) END AS form,
             CASE WHEN often >= 10 * n THEN often END AS form_n
      FROM v LEFT JOIN best USING (word)),
    r0 AS (SELECT word, coalesce(form, word) AS root FROM f),
    r1 AS (SELECT a.word, b.root FROM r0 a JOIN r0 b ON a.root = b.word),
    r2 AS (SELECT a.word, b.root FROM r1 a JOIN r1 b ON a.root = b.word),
    r3 AS (SELECT a.word, b.root FROM r2 a JOIN r2 b ON a.root = b.word),
    r4 AS (SELECT a.word, b.root FROM r3 a JOIN r3 b ON a.root = b.word),
    r5 AS (SELECT a.word, b.root FROM r4 a JOIN r4 b ON a.root = b.word)
    SELECT word, form, root, n, n_near, form_n FROM f JOIN r5 USING (word)
"""

_FLOOR_MEAN = "((total - ((total % members) + members) % members) // members)::BIGINT"


def _clustered(rounds: int) -> str:
    steps = [
        "e AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v"
        " FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64)",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v AS c"
        " FROM (SELECT v, sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h FROM e ORDER BY h, v LIMIT 16))",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, v, unnest(best) FROM (SELECT n, any_value(vec_id) AS vec_id,"
            f" any_value(v) AS v, min({{'distance': d, 'cluster': cluster}}) AS best FROM (SELECT n, vec_id, v, cluster,"
            f" list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d"
            f" FROM (SELECT *, row_number() OVER () AS n FROM e) CROSS JOIN c{i}) GROUP BY n))"
        )
        if i < rounds:
            steps.append(
                f"m{i} AS (SELECT cluster, list({_FLOOR_MEAN} ORDER BY place) AS c FROM ("
                f"SELECT cluster, place, sum(x) AS total, count(*) AS members FROM (SELECT cluster,"
                f" unnest(v) AS x, unnest(range(64)) AS place FROM a{i}) GROUP BY cluster, place) GROUP BY cluster)"
            )
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c"
                f" FROM c{i} LEFT JOIN m{i} USING (cluster))"
            )
    last = f"a{rounds}", f"c{rounds}"
    return f"""
    WITH {", ".join(steps)}
    SELECT vec_id, a.cluster::INTEGER AS cluster, distance,
           (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
           (sum(distance) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM {last[0]} a JOIN {last[1]} USING (cluster)
    """


CLUSTERED = _clustered(3)
