"""The operators over their whole tables, with the parameters meant for production."""

from __future__ import annotations

from reviewloom.llm import (
    chat,
    decontamination,
    exact,
    mixing,
    repeats,
    repetition,
    secret_scan,
    sharding,
    simhash,
    site_text,
    spelling,
    tokens,
    whitening,
)
from reviewloom.llm.common import table


def _conversations(spark, sf_dir):
    """All turns, and a conversation -7 that is full of another template's control strings."""
    text = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"'{text}' AS text"
    )
    return turns.unionByName(own)


QUERIES = {
    "op1_secret_scan": lambda spark, d: secret_scan.secrets(table(spark, d, "documents")),
    "op2_site_text": lambda spark, d: site_text.main_texts(table(spark, d, "pages")),
    "op3_mixing": lambda spark, d: mixing.mix(table(spark, d, "documents")),
    "op4_simhash": lambda spark, d: simhash.near_duplicates(table(spark, d, "documents")),
    "op5_suffix_repeats": lambda spark, d: repeats.without_repeats(table(spark, d, "documents")),
    "op6_quality_rules": lambda spark, d: repetition.quality(table(spark, d, "documents")),
    "op7_token_counts": lambda spark, d: tokens.token_counts(table(spark, d, "documents")),
    "op9_decontamination": lambda spark, d: decontamination.contaminated(
        table(spark, d, "documents"), table(spark, d, "benchmark")
    ),
    "op10_chat_formatting": lambda spark, d: chat.digests(
        chat.formatted_turns(_conversations(spark, d))
    ),
    "op8_sharding": lambda spark, d: sharding.shards_of(table(spark, d, "documents")),
    "op11_spelling_variants": lambda spark, d: spelling.variants(table(spark, d, "documents")),
    "op12_whitening": lambda spark, d: whitening.whitened(table(spark, d, "embeddings")),
    "op13_exact_dedup": lambda spark, d: exact.duplicates(table(spark, d, "documents")),
}

SQL: dict[str, str] = {
    # U+FDD0 to U+FDD2 mark where a match, its body and the rest begin
    "op1_secret_scan": r"""
        WITH kinds(place, kind, head, body, least) AS (VALUES
            (0, 'assign', '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?', '[A-Za-z0-9+/_.=-]+', 12),
            (1, 'access', 'AKIA', '[A-Z0-9]+', 14),
            (2, 'hex', '', '[0-9a-f]+', 16),
            (3, 'private_key', '', '-----BEGIN\x20(?:[A-Z]+\x20)?PRIVATE\x20KEY-----', 1),
            (4, 'github', 'gh[opsur]_', '[A-Za-z0-9]+', 36),
            (5, 'gitlab', 'glpat-', '[A-Za-z0-9_-]+', 20),
            (6, 'google', 'AIza', '[A-Za-z0-9_-]+', 35),
            (7, 'npm', 'npm_', '[A-Za-z0-9]+', 36),
            (8, 'slack', 'xox[abeprs]-', '[A-Za-z0-9-]+', 20),
            (9, 'stripe', '[rs]k_(?:live|test)_', '[A-Za-z0-9]+', 24),
            (10, 'json_web_token', 'eyJ[A-Za-z0-9_-]+\.', 'eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', 1)
        ), docs AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        ), marked AS (
            SELECT row, place, kind, least, string_split(regexp_replace(text, '(' || head || ')(' || body || ')',
                   chr(64976) || '\1' || chr(64977) || '\2' || chr(64978), 'g'), chr(64976)) AS parts
            FROM docs, kinds
        ), cut AS (
            SELECT row, place, kind, least, unnest(parts) AS part, unnest(range(len(parts))) AS number FROM marked
        ), measured AS (
            SELECT *, sum(length(part) - CASE WHEN number > 0 THEN 2 ELSE 0 END) OVER (
                       PARTITION BY row, place ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low,
                   strpos(part, chr(64977)) AS middle, strpos(part, chr(64978)) AS close
            FROM cut
        ), spans AS (
            SELECT row, place, low, kind || ':' || low || ':' || low + close - 2 AS span
            FROM measured WHERE number > 0 AND close - middle - 1 >= least
        ), joined AS (
            SELECT row, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
                   count(*) FILTER (place = 2) AS n_hex,
                   string_agg(span, ',' ORDER BY low, place) FILTER (place < 3) AS base,
                   string_agg(span, ',' ORDER BY low, place) AS spans
            FROM spans GROUP BY row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN joined USING (row)
    """,
    "op6_quality_rules": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), placed AS (
            SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs
        ), ahead AS (
            SELECT row, place, length(word) AS chars,
                   list(word) OVER (PARTITION BY row ORDER BY place ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS next
            FROM placed
        ), grams AS (
            SELECT row, n, place, chars, CASE WHEN len(next) >= n THEN array_to_string(next[:n], ' ') END AS gram
            FROM ahead, (VALUES (3), (5), (6), (7), (8), (9), (10)) AS lengths(n)
        ), compared AS (
            SELECT row, n, place, chars,
                   CASE WHEN gram IS NULL THEN false WHEN n = 3 THEN count(*) OVER same > 1
                        ELSE row_number() OVER (same ORDER BY place) > 1 END AS repeated
            FROM grams WINDOW same AS (PARTITION BY row, n, gram)
        ), covered AS (
            SELECT row, n, chars, coalesce(max(place) FILTER (repeated) OVER (
                       PARTITION BY row, n ORDER BY place ROWS UNBOUNDED PRECEDING) > place - n, false) AS inside
            FROM compared
        ), shares AS (
            SELECT row, n, count(*) FILTER (inside) AS n_words, coalesce(sum(chars) FILTER (inside), 0) / sum(chars) AS share
            FROM covered GROUP BY row, n
        ), grouped AS (
            SELECT row, max(n_words) FILTER (n = 3) AS n_repeat_words, max(share) FILTER (n = 5) AS five,
                   bool_and(share <= [0.15, 0.14, 0.13, 0.12, 0.11, 0.10][n - 4]) FILTER (n > 3) AS varied
            FROM shares GROUP BY row
        ), lines AS (
            SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs
        ), alike AS (
            SELECT row, length(line) AS chars, count(*) AS copies FROM lines
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row, line
        ), in_lines AS (
            SELECT row, sum(copies - 1) AS n_dup_lines, sum(chars * (copies - 1)) / sum(chars * copies) AS line_share
            FROM alike GROUP BY row
        ), measured AS (
            SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, length(array_to_string(words, '')) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(line_share, 0) AS line_share, coalesce(five, 0) AS five_gram_share, coalesce(varied, true) AS varied
            FROM docs LEFT JOIN grouped USING (row) LEFT JOIN in_lines USING (row)
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND line_share <= 0.20 AND varied AS kept, line_share, five_gram_share
        FROM judged
    """,
    # the checksum bit by bit; words of one edit agree in what is left without a code point
    "op11_spelling_variants": r"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents
        ), counted AS (
            SELECT run, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS data, count(*) AS n
            FROM runs GROUP BY doc_id, run
        ), checked AS (
            SELECT run, n, xor(list_reduce(
                list_transform(range(8 * octet_length(data)), lambda k: CAST(get_bit(CAST(data AS BIT), CAST(k + 7 - 2 * (k % 8) AS INT)) AS BIGINT)),
                lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295) AS h
            FROM counted
        ), spelt AS (
            SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM checked
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ), cut AS (
            SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)
        ), pairs AS (
            SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (rest, place) WHERE a.word <> b.word
            UNION SELECT cut.word, cut.n, words.word, words.n FROM cut JOIN words ON rest = words.word
            UNION SELECT words.word, words.n, cut.word, cut.n FROM cut JOIN words ON rest = words.word
        ), largest AS (
            SELECT word, count(*) AS n_near, max(near_n) AS near_n, arg_min(near, (-near_n, encode(near))) AS near
            FROM pairs GROUP BY word
        ), formed AS (
            SELECT words.word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
            FROM words LEFT JOIN largest USING (word)
        ), chains AS (
            SELECT word, word AS root, form AS next FROM formed
            UNION ALL
            SELECT chains.word, formed.word, formed.form FROM chains JOIN formed ON chains.next = formed.word
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN chains USING (word) WHERE next IS NULL
    """,
    # every window of 100 bytes; the oldest of equal ones stays
    "op5_suffix_repeats": r"""
        WITH docs AS (
            SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(0, octet_length(data) - 99)) AS place, data FROM docs
        ), cut AS (
            SELECT doc_id, place, CAST(doc_id AS HUGEINT) * 4294967296 + place AS age,
                   array_slice(data, place + 1, place + 100) AS part
            FROM windows
        ), repeated AS (
            SELECT part, min(age) AS oldest FROM cut GROUP BY part HAVING count(*) > 1
        ), later AS (
            SELECT doc_id, place FROM cut JOIN repeated USING (part) WHERE age <> oldest
        ), marked AS (
            SELECT doc_id, place, coalesce(place > lag(place) OVER in_doc + 100, true) AS fresh
            FROM later WINDOW in_doc AS (PARTITION BY doc_id ORDER BY place)
        ), numbered AS (
            SELECT doc_id, place, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM marked
        ), runs AS (
            SELECT doc_id, min(place) AS low, max(place) + 100 AS high FROM numbered GROUP BY doc_id, run
        ), pieces AS (
            SELECT doc_id, low, high,
                   coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS kept_from
            FROM runs
        ), parts AS (
            SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS tail,
                   string_agg(hex(array_slice(data, kept_from + 1, low)), '' ORDER BY low) AS head
            FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, octet_length(data) AS n_bytes,
               CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head, '') || hex(array_slice(data, coalesce(tail, 0) + 1, octet_length(data))))) AS kept_sha256
        FROM docs LEFT JOIN parts USING (doc_id)
    """,
    # a control string is escaped by one character; in roles backslashes and ends of lines too
    "op10_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                             (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), measured AS (
            SELECT *, md5(role || chr(10) || text) AS tie,
                   len(regexp_extract_all(role, '[<\[]\\*(\||/s>|s>|INST\]|/INST\])')) AS role_signs,
                   len(regexp_extract_all(text, '[<\[]\\*(\||/s>|s>|INST\]|/INST\])')) AS text_signs,
                   length(role) - length(replace(replace(role, '\', ''), chr(10), '')) AS role_more
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, tie)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, tie) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<|im_start|>' || role || text || '<|im_end|>') + 2
                        + 2 * role_signs + role_more + text_signs) AS BIGINT) AS formatted_chars
        FROM measured GROUP BY conv_id
    """,
    # the schedules' integrals are inverted piece by piece, as the operator does
    "op3_mixing": r"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS digest
            FROM documents
        ), sized AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS place
            FROM docs GROUP BY source
        ), weighed AS (
            SELECT *, [5, 2, 1][place + 1] AS weight, 3 * source_size AS most,
                   CAST(sum(source_size) OVER () AS BIGINT) AS total
            FROM sized
        ), levels AS (
            SELECT *, sum(most) OVER (ORDER BY most / weight, place, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS used,
                   sum(weight) OVER (ORDER BY most / weight, place, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unfilled
            FROM weighed
        ), cut AS (
            SELECT *, coalesce(used, 0) + most / weight * unfilled < total AS filled FROM levels
        ), targets AS (
            SELECT source, source_size, place,
                   CASE WHEN filled THEN CAST(most AS DOUBLE)
                        ELSE weight * CAST(total - coalesce(sum(most) FILTER (filled) OVER (), 0) AS DOUBLE)
                             / sum(weight) FILTER (NOT filled) OVER () END AS target
            FROM cut
        ), placed AS (
            SELECT docs.doc_id, size, source_size, target, place,
                   sum(size) OVER (PARTITION BY docs.source ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before,
                   least(coalesce(floor(target / nullif(source_size, 0)), 0), 3) AS whole
            FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
        ), taken AS (
            SELECT *, CAST(least(whole + CAST(before + size / 2 < target - whole * source_size AS INT), 3) AS BIGINT) AS copies,
                   (before + size / 2) / nullif(target, 0) * 2 AS spent,
                   [[1.5, 1.0, 0.5], [1.0, 1.0, 1.0], [0.5, 1.0, 1.5]][place + 1]::DOUBLE[] AS s
            FROM placed
        ), pieces AS (
            SELECT *, spent > (s[1] + s[2]) / 2 AS later FROM taken
        ), solved AS (
            SELECT *, CASE WHEN later THEN spent - (s[1] + s[2]) / 2 ELSE spent END AS rest,
                   CASE WHEN later THEN s[2] ELSE s[1] END AS a, CASE WHEN later THEN s[3] ELSE s[2] END AS b
            FROM pieces
        )
        SELECT doc_id, size, source_size, target, copies * size AS taken,
               CASE WHEN copies > 0 THEN coalesce(CASE WHEN spent > 2 THEN 1 ELSE least(
                   (CAST(later AS INT) + coalesce(2 * rest / nullif(a + sqrt(greatest(a * a + 2 * (b - a) * rest, 0)), 0), 0)) / 2, 1) END, 0)
               END AS position
        FROM solved
    """,
    "op13_exact_dedup": r"""
        WITH normal AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), grouped AS (
            SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
            FROM normal GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM normal JOIN grouped USING (text_sha256)
    """,
}
