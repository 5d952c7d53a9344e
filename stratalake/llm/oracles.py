"""DuckDB SQL of the registered queries that SQL can express."""

# CRC-32 of the bytes of ``w``, by the table of the reflected polynomial 0xEDB88320.
CRC_TABLE = """
    crc_steps AS (
        SELECT i, i AS c, 0 AS bit FROM range(256) t(i)
        UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, bit + 1 FROM crc_steps WHERE bit < 8
    ), crc_table AS (SELECT list(c ORDER BY i) AS crc_of FROM crc_steps WHERE bit = 8)
"""


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text expression, beside the column ``crc_of`` of ``crc_table``."""
    code = f"CAST('0x' || substr(hex(encode({text})), place, 2) AS BIGINT)"
    codes = f"list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2), lambda place: {code})"
    step = "xor(c >> 8, crc_of[CAST((xor(c, b) & 255) + 1 AS INTEGER)])"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


ORACLE: dict[str, str] = {
    "op9_chat_formatting": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), sized AS (
            SELECT *, length('<|im_start|>' || role || chr(10) || '<|im_end|>' || chr(10))
                + length(regexp_replace(text, '([<[])(\\\\*)(\\||/?s>|/?INST\\]|/?SYS>)', '\\1\\\\\\2\\3', 'g')) AS size
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(size) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op12_importance_resampling": f"""
        WITH RECURSIVE {CRC_TABLE}, lowered AS (
            SELECT 's' AS side, doc_id, coalesce(text, '') AS text FROM documents
            UNION ALL SELECT 't', NULL, coalesce(text, '') FROM benchmark
        ), found AS (
            SELECT side, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
            FROM lowered
        ), counted AS (SELECT side, doc_id, word, count(*) AS n FROM found GROUP BY ALL),
        hashed AS (
            SELECT word, {crc32_sql("word")} % 10000 AS bucket
            FROM (SELECT DISTINCT word FROM counted), crc_table
        ), sums AS (
            SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 's'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 't'), 0) AS t
            FROM counted JOIN hashed USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln(
                CAST((t + 1) * (SELECT sum(s) + 10000 FROM sums) AS DOUBLE) / CAST((s + 1) * (SELECT sum(t) + 10000 FROM sums) AS DOUBLE)
            )) AS BIGINT) AS gain
            FROM sums
        ), weighed AS (
            SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight
            FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
                    (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM documents LEFT JOIN weighed USING (doc_id)
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score,
            CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM ranked) THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE {CRC_TABLE}, values_of AS (
            SELECT row_number() OVER (ORDER BY doc_id) AS row, doc_id, source, text,
                coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
                || coalesce(octet_length(encode(source)) || ':' || source, '-')
                || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
                || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS others
            FROM documents
        ), leaves AS (
            SELECT row, doc_id, coalesce('=' || source, '-') AS tree,
                sha256(others || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256(others || coalesce(octet_length(encode(text)) || ':'
                    || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
            FROM values_of, crc_table
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
            FROM leaves
        ), low(tree, level, idx, n, digest) AS (
            SELECT tree, 0, idx, n, leaf FROM placed
            UNION ALL
            SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
            FROM low WHERE n > 1 GROUP BY tree, level, idx // 16, n
        ), subroots AS (
            SELECT tree, level, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n
            FROM low WHERE n = 1
        ), high(level, idx, n, digest) AS (
            SELECT 0, idx, n, digest FROM subroots
            UNION ALL
            SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
            FROM high WHERE n > 1 GROUP BY level, idx // 16, n
        ), nodes AS (
            SELECT tree, level, idx, digest, n FROM low WHERE n > 1
            UNION ALL SELECT s.tree, s.level + h.level, h.idx, h.digest, h.n
            FROM subroots s JOIN high h ON h.n > 1 AND h.idx = s.idx // CAST(16 ** h.level AS BIGINT)
            UNION ALL SELECT s.tree, s.level + h.level, h.idx, h.digest, h.n
            FROM subroots s JOIN high h ON h.n > 1
                AND h.idx // 16 = s.idx // CAST(16 ** (h.level + 1) AS BIGINT) AND h.idx <> s.idx // CAST(16 ** h.level AS BIGINT)
        ), steps AS (
            SELECT p.row, g.level,
                coalesce(string_agg(g.digest, '' ORDER BY g.idx) FILTER (WHERE g.idx < own), '') AS before,
                coalesce(string_agg(g.digest, '' ORDER BY g.idx) FILTER (WHERE g.idx > own), '') AS after
            FROM (
                SELECT p.row, p.tree, l.level, p.idx // CAST(16 ** l.level AS BIGINT) AS own
                FROM placed p JOIN (SELECT DISTINCT tree, level FROM low WHERE n > 1) l USING (tree)
                UNION ALL
                SELECT p.row, p.tree, s.level + h.level, s.idx // CAST(16 ** h.level AS BIGINT)
                FROM placed p JOIN subroots s USING (tree) CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) h
            ) p JOIN nodes g ON g.tree = p.tree AND g.level = p.level AND g.idx // 16 = own // 16
            GROUP BY p.row, g.level
        ), folds(row, level, digest) AS (
            SELECT row, 0, coalesce(tampered, leaf) FROM placed
            UNION ALL
            SELECT f.row, f.level + 1, sha256(s.before || f.digest || s.after)
            FROM folds f JOIN steps s ON s.row = f.row AND s.level = f.level
        ), last AS (SELECT row, arg_max(digest, level) AS folded_root FROM folds GROUP BY row),
        proofs AS (SELECT row, string_agg(before || after, '' ORDER BY level) AS proof FROM steps GROUP BY row),
        top AS (SELECT digest AS root FROM high WHERE n = 1)
        SELECT p.doc_id, p.leaf, s.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
            folded_root = root AS verified
        FROM placed p JOIN subroots s USING (tree) JOIN last USING (row) LEFT JOIN proofs USING (row), top
    """,
}
