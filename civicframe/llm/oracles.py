"""DuckDB texts for the queries of this package that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 33, 1))) AS i, w FROM d),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(list_slice(w, i, i + 34), ' ')) AS n FROM starts),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS p FROM windows WHERE n > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS text
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

EXACT_TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 1, 1))) AS i, w FROM d),
triples AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM starts),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM triples WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
base AS (SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
                CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
         FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS k FROM judged GROUP BY source),
moments AS (SELECT sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2
                   - sum(k) / sum(n) * (1 - sum(k) / sum(n)) * (count(*) - 1) / sum(n) AS spread FROM hosts),
prior AS (SELECT mean, CASE WHEN spread > 0 THEN greatest(mean * (1 - mean) / spread - 1, 0) END AS strength FROM moments),
verdict AS (SELECT source, CASE WHEN strength IS NULL THEN mean ELSE (k + mean * strength) / (n + strength) END > 0.8 AS bad
            FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM judged JOIN verdict ON judged.source IS NOT DISTINCT FROM verdict.source
"""

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS body, unnest(range(0, len(string_split(text, chr(10))))) AS line
           FROM documents WHERE text IS NOT NULL),
tokens AS (SELECT doc_id, line, list_transform(regexp_extract_all(body, '[^\x20\x09-\x0D]+'),
                  lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS t FROM l),
p AS (SELECT doc_id, line, t AS exact, len(t) AS n, [CAST(len(t) AS VARCHAR)] || t[1:3] AS leaf, least(len(t), 8) AS many FROM tokens WHERE len(t) > 0),
different AS (SELECT leaf, exact, n, many, unnest(range(0, many)) AS field FROM (SELECT DISTINCT leaf, exact, n, many FROM p)),
cells AS (SELECT leaf, exact, field, exact[CAST(floor(field * n / many) AS INT) + 1 : CAST(floor((field + 1) * n / many) AS INT)] AS value
          FROM different WHERE floor((field + 1) * n / many) > 3),
size AS (SELECT leaf, count(DISTINCT exact) AS lines FROM p GROUP BY leaf),
constant AS (SELECT leaf, field, value FROM cells JOIN size USING (leaf) WHERE lines > 1
             GROUP BY leaf, field, value, lines HAVING count(*) > 1 AND 2 * count(*) > lines),
alike AS (SELECT cells.leaf, exact FROM cells LEFT JOIN constant USING (leaf, field, value) JOIN size ON size.leaf = cells.leaf WHERE lines > 1
          GROUP BY cells.leaf, exact HAVING 2 * count(constant.field) >= count(*)),
placed AS (SELECT p.doc_id, line, CASE WHEN alike.exact IS NULL THEN ['exact'] || p.exact ELSE ['leaf'] || p.leaf END AS template
           FROM p LEFT JOIN alike ON alike.exact = p.exact),
ranked AS (SELECT doc_id, line, row_number() OVER (PARTITION BY template ORDER BY doc_id, line) AS k,
                  min(doc_id) OVER (PARTITION BY template) <> max(doc_id) OVER (PARTITION BY template) AS shared FROM placed),
gone AS (SELECT doc_id, line FROM ranked WHERE shared AND k > 1),
kept AS (SELECT doc_id, string_agg(body, chr(10) ORDER BY line) AS text FROM l ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id),
dropped AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_dropped,
       md5(coalesce(kept.text, '')) AS text_md5
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN dropped USING (doc_id)
"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
                  CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR) || ':' || md5(text)), 1, 12) AS BIGINT) / 281474976710656.0 AS u
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source),
ranked AS (SELECT *, 3 * source_size / weight AS bound, sum(source_size) OVER () AS total,
                  coalesce(sum(3 * source_size) OVER before, 0) AS spent, sum(weight) OVER rest AS rest
           FROM s WINDOW before AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                         rest AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT arg_min((total - spent) / rest, bound) FILTER (WHERE (total - spent) / rest <= bound) AS level FROM ranked),
plan AS (SELECT source, source_size,
                CAST(CASE WHEN weight * level > 3 * source_size THEN 3 * source_size ELSE weight * level END AS DOUBLE) AS target
         FROM s, level),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM plan),
rows AS (SELECT doc_id, size, source_size, target, CAST(floor(ratio) AS BIGINT) AS whole, ratio - floor(ratio) AS f, u, d.source
         FROM d JOIN parts ON d.source IS NOT DISTINCT FROM parts.source),
keyed AS (SELECT *, (u / (1 - u)) / (f / (1 - f)) AS q FROM rows WHERE f > 0 AND size > 0),
cut AS (SELECT doc_id, 2 * sum(size) OVER (PARTITION BY source ORDER BY floor(q / (1 + q) * 281474976710656), doc_id) - size
               <= 2 * (target - whole * source_size) AS extra FROM keyed)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN coalesce(extra, FALSE) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM rows LEFT JOIN cut USING (doc_id)
"""


def _product_codes(rounds: int = 6) -> str:
    nearest = """
a{k} AS MATERIALIZED (SELECT vec_id, label, p, x, min((d, e)) AS near FROM (
         SELECT vec_id, label, parts.p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
         FROM parts JOIN b{k} ON parts.p = b{k}.p) GROUP BY vec_id, label, p, x)"""
    moved = """
m{k} AS (SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (
         SELECT p, near[2] AS e, i, sum(x[i]) AS s, count(*) AS n FROM a{k}, range(1, len(x) + 1) r(i) GROUP BY ALL) GROUP BY p, e),
b{next} AS MATERIALIZED (SELECT b{k}.p, b{k}.e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (p, e))"""
    steps = ",".join(nearest.format(k=k) + "," + moved.format(k=k, next=k + 1) for k in range(rounds))
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) r(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
                    QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 16),{steps},{nearest.format(k=rounds)},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', near[2]), '' ORDER BY p) AS code, CAST(sum(near[1]) AS BIGINT) AS error
          FROM a{rounds} GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books
"""


PRODUCT_CODES = _product_codes()

RESAMPLING = r"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
raw AS (SELECT doc_id, 0 AS aimed, text FROM documents UNION ALL SELECT item_id, 1, text FROM benchmark),
texts AS (SELECT doc_id, aimed, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM raw),
words AS (SELECT doc_id, aimed, unnest(w) AS word FROM texts),
bytes AS (SELECT word, list_transform(range(0, CAST(len(h) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b
          FROM (SELECT DISTINCT word, hex(encode(word)) AS h FROM words)),
crcs AS (SELECT word, xor(list_reduce([4294967295] || b, lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS BIGINT) + 1])), 4294967295) % 10000 AS bucket
         FROM bytes, t),
found AS (SELECT doc_id, aimed, bucket, count(*) AS n FROM words JOIN crcs USING (word) GROUP BY ALL),
counts AS (SELECT bucket, CAST(coalesce(sum(n) FILTER (aimed = 0), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (aimed = 1), 0) AS DOUBLE) AS t
           FROM found GROUP BY bucket),
totals AS (SELECT sum(s) AS ss, sum(t) AS tt FROM counts),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000)))) AS BIGINT) AS gain FROM counts, totals),
weights AS (SELECT doc_id, CAST(sum(n * gain) AS BIGINT) AS weight FROM found JOIN gain USING (bucket) WHERE aimed = 0 GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                  (CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
           FROM texts LEFT JOIN weights USING (doc_id) WHERE aimed = 0),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN drawn USING (doc_id)
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (SELECT doc_id, c, substr(h, 1000 * c + 1, 1198) AS part FROM d, unnest(range(0, CAST(len(h) / 1000 AS BIGINT) + 1)) r(c)),
starts AS (SELECT doc_id, 500 * c + i AS i, substr(part, 2 * i + 1, 200) AS string FROM chunks, unnest(range(0, 500)) r(i) WHERE 2 * i + 200 <= len(part)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY md5_number(string) ORDER BY doc_id, i) AS k FROM starts),
later AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM ranked WHERE k > 1),
spans AS (SELECT doc_id, min(i) AS low, max(i) + 100 AS high
          FROM (SELECT *, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM later)
          GROUP BY doc_id, span),
edges AS (SELECT doc_id, low, high, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) AS after FROM spans),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
                string_agg(substr(h, 2 * after + 1, 2 * (low - after)), '' ORDER BY low) AS parts
         FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(parts || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
