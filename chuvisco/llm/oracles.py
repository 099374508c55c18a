"""SQL for DuckDB that gives the rows of the newer queries from the same tables."""

from __future__ import annotations


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(_field(f) for f in fields)})"


#: Unsigned CRC-32 of a decimal number: each byte, then its eight shifts (-1).
_CRC32 = """4294967295 - list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, CAST(4294967295 AS BIGINT))"""


def _tree(name: str, start: str) -> str:
    return f"""{name} AS (
    {start}
    UNION ALL
    SELECT part, any_value(level) + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos))
    FROM {name} WHERE n > 1 GROUP BY part, pos // 3
), {name}_runs AS (
    SELECT part, level, pos // 3 AS run, list(h ORDER BY pos) AS held FROM {name} WHERE n > 1 GROUP BY ALL
)"""


def _folded(name: str, runs: str, start: str) -> str:
    return f"""{name} AS (
    {start}
    UNION ALL
    SELECT w.row, w.part, w.level + 1, w.pos // 3,
           sha256(array_to_string(list_transform(r.held, lambda h, i: CASE WHEN i = 1 + w.pos % 3 THEN w.h ELSE h END), '')),
           w.proof || array_to_string(list_filter(r.held, lambda h, i: i <> 1 + w.pos % 3), '')
    FROM {name} AS w JOIN {runs} AS r ON r.part IS NOT DISTINCT FROM w.part AND r.level = w.level AND r.run = w.pos // 3
), {name}_ends AS (
    SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1
)"""


OP11 = f"""WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS row, doc_id, source AS part, {_leaf('text')} AS leaf,
           CASE WHEN ({_CRC32}) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS changed
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY part) AS n
    FROM leaves
), {_tree("lower_nodes", "SELECT part, 0 AS level, pos, n, leaf AS h FROM placed")}, tops AS (
    SELECT part, h, row_number() OVER (ORDER BY part NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lower_nodes WHERE n = 1
), {_tree("upper_nodes", "SELECT 'all' AS part, 0 AS level, pos, n, h FROM tops")
}, {_folded("inner_ways", "lower_nodes_runs", "SELECT row, part, 0 AS level, pos, coalesce(changed, leaf) AS h, '' AS proof FROM placed")
}, {_folded("outer_ways", "upper_nodes_runs", "SELECT row, 'all' AS part, 0 AS level, tops.pos, e.h, proof "
            "FROM inner_ways_ends AS e JOIN tops ON tops.part IS NOT DISTINCT FROM e.part")}
SELECT doc_id, leaf, tops.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM placed JOIN tops ON tops.part IS NOT DISTINCT FROM placed.part JOIN outer_ways_ends AS e USING (row)
JOIN (SELECT h FROM upper_nodes WHERE n = 1) AS root ON true"""


OP12 = """WITH held AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), '')
           AS payload_digest,
       CASE WHEN coalesce(first = page_id, first IS NULL) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT coalesce(first = page_id, first IS NULL) THEN first END AS refers_to
FROM held"""


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

OP13 = f"""WITH numbered AS (
    SELECT row_number() OVER () AS row, doc_id, text FROM documents
), counts AS (
    SELECT row, doc_id, term, count(*) AS tf FROM (SELECT row, doc_id, {_TERMS} AS term FROM numbered) GROUP BY ALL
), lengths AS (
    SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row
), whole AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM lengths
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, whole GROUP BY term, n_docs
), asked AS (
    SELECT DISTINCT item_id, text, {_TERMS} AS term FROM benchmark
), scored AS (
    SELECT item_id, a.text, row, any_value(doc_id) AS doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // total))))) AS BIGINT) AS score
    FROM asked AS a JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (row), whole
    WHERE doc_id IS NOT NULL GROUP BY item_id, a.text, row
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""
