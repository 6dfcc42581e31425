"""SQL twins of the queries that SQL can express, for DuckDB."""

# Bit i of a byte adds the CRC-32 of 1 << i; eight shifts of the polynomial make these.
def _crc_of_bits() -> list[int]:
    out = []
    for bit in range(8):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def _crc_step() -> str:
    low = "(xor(c, b) & 255)"
    out = "(c >> 8)"
    for bit, value in enumerate(_crc_of_bits()):
        out = f"xor({out}, (({low} >> {bit}) & 1) * {value})"
    return out


_OP3 = f"""
WITH sized AS (
  SELECT doc_id, coalesce(text, '') AS body, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents
), coded AS (
  SELECT doc_id, size::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, size - 1),
      lambda i: ('0x' || substr(hex(encode(body)), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: {_crc_step()}), 4294967295::BIGINT) AS text_crc32
  FROM sized
), laid AS (
  SELECT *, sum(size) OVER o - size AS before, sum(size) OVER () AS everything,
    row_number() OVER o AS place
  FROM coded
  WINDOW o AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
), cut AS (
  SELECT *, least(7, ((2 * before + size) * 8) // (2 * everything))::INTEGER AS shard FROM laid
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP6 = rf"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded
), classes AS (
  SELECT list_sort(s) AS s, len(s) AS n, min(r) AS c, min(doc_id) AS least, count(*) AS copies
  FROM sets WHERE len(s) > 0 GROUP BY ALL
), members AS (
  SELECT r, doc_id, len(sets.s) AS n, c FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s
), grams AS (SELECT c, n, copies, unnest(s) AS g FROM classes
), shared AS (
  SELECT a.c AS a, b.c AS b, a.n + b.n AS both_n, b.copies, count(*) AS o
  FROM grams a JOIN grams b ON a.g = b.g AND a.c <> b.c GROUP BY ALL
), linked AS (SELECT a, b, copies FROM shared WHERE 100 * o >= 80 * (both_n - o)
), reach(a, b) AS (
  SELECT c, c FROM classes UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
), component AS (
  SELECT reach.a AS c, min(classes.least) AS component_id FROM reach JOIN classes ON classes.c = reach.b GROUP BY 1
), degree AS (
  SELECT classes.c, any_value(classes.copies) - 1 + coalesce(sum(linked.copies), 0) AS n_links
  FROM classes LEFT JOIN linked ON linked.a = classes.c GROUP BY 1
)
SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id,
  coalesce(n_links, 0)::BIGINT AS n_links
FROM members LEFT JOIN component USING (c) LEFT JOIN degree USING (c)
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), items AS (SELECT item_id, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS s
  FROM items WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows
), runs AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS place, w FROM docs, lengths WHERE len(w) >= n
), found AS (
  SELECT r, place, windows.n, item_id FROM runs
  JOIN windows ON windows.n = runs.n AND windows.s = array_to_string(w[place:place + runs.n - 1], ' ')
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(place, place + n)) AS p FROM found) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS items
  FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

_OP11 = """
WITH given AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), vectors AS (SELECT DISTINCT vec_id, label, v FROM given
), anchors AS (SELECT row_number() OVER () AS a, vec_id, label, v FROM vectors WHERE vec_id % 100 = 0
), scores AS (
  SELECT a, anchors.vec_id AS anchor_id, anchors.label AS anchor_label, vectors.vec_id, vectors.label,
    list_inner_product(anchors.v, vectors.v)::BIGINT AS score,
    anchors.vec_id = vectors.vec_id AND anchors.label = vectors.label AND anchors.v = vectors.v AS itself
  FROM anchors, vectors
), positives AS (
  SELECT a, anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE label = anchor_label AND NOT itself
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5
)
SELECT positives.anchor_id, positive_id,
  row_number() OVER (PARTITION BY a, positive_id, positive_score ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (a)
WHERE label <> positives.anchor_label AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op3_byte_shards": _OP3,
    "op6_ngram_jaccard": _OP6,
    "op10_decontamination": _OP10,
    "op11_str_negatives": _OP11,
}
