"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from cardflow.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

SQL: dict[str, str] = {
    "op4_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html,
                   octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(encode(coalesce(html, ''))) AS payload_digest
            FROM pages
        ), g AS (
            SELECT *, CASE WHEN payload_bytes >= 100
                THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM g
    """,
    "op9_pivots": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op2_substrings": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), starts AS (
            SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35
        ), windows AS (
            SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts
        ), repeated AS (
            SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1
        ), gone AS (
            SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM repeated
        ), words AS (
            SELECT r, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM d
        ), kept AS (
            SELECT words.r, string_agg(word, ' ' ORDER BY words.k) AS text
            FROM words ANTI JOIN gone ON words.r = gone.r AND words.k = gone.k GROUP BY words.r
        ), removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(removed.n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.r = kept.r LEFT JOIN removed ON d.r = removed.r
    """,
    "op8_quality_rules": rf"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), starts AS (
            SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5
        ), windows AS (
            SELECT r, i, md5(array_to_string(w[i:i + 4], ' ')) AS h FROM starts
        ), repeated AS (
            SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, h) > 1
        ), covered AS (
            SELECT r, count(DISTINCT k) AS n
            FROM (SELECT r, unnest(range(i, i + 5)) AS k FROM repeated) GROUP BY r
        ), m AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
                   len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper,
                   len(list_intersect(w, [{_STOP}])) AS stop_words_seen
            FROM d LEFT JOIN covered ON d.r = covered.r
        ), b AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND word_chars BETWEEN 2 * n_words AND 25 * n_words
               AND 2 * n_symbols <= n_words AND 2 * n_dup_lines <= n_lines
               AND (n_words < 30 OR 10 * n_upper <= 6 * word_chars)
               AND (n_words < 80 OR stop_words_seen >= 1) AS kept
        FROM b
    """,
    "op12_phrases": r"""
        WITH texts AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), pieces AS (
            SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts
        ), words AS (
            SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces
        ), totals AS (
            SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
        ), starts AS (
            SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS m) AS sizes
        ), f AS (
            SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
            FROM starts GROUP BY ALL HAVING count(*) >= 30
        ), cuts AS (
            SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m >= 2
        ), scored AS (
            SELECT c.lang, c.m, c.phrase, c.f AS a, c.k, l.f AS l, r.f AS r,
                   CAST((CAST(2000000 AS HUGEINT) * c.f) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
            FROM cuts c
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.k], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
        ), inner_sizes AS (
            SELECT lang, f, m, string_split(phrase, ' ') AS w, unnest(range(2, m)) AS s FROM f WHERE m >= 3
        ), inner_phrases AS (
            SELECT lang, f, w, s, unnest(range(1, m - s + 2)) AS i FROM inner_sizes
        ), holders AS (
            SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS holder FROM inner_phrases GROUP BY ALL
        ), kept AS (
            SELECT scored.* FROM scored LEFT JOIN holders USING (lang, phrase)
            WHERE holder IS NULL OR CAST(100 AS HUGEINT) * holder < CAST(80 AS HUGEINT) * a
        )
        SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept JOIN totals ON totals.lang = kept.lang
        QUALIFY rank <= 2000
    """,
}
