"""SQL for the queries that hash with CRC-32, which DuckDB has no function for."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _nibble_table():
    out = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ 0xEDB88320 * (value & 1)
        out.append(value)
    return ", ".join(map(str, out))


def crc32(text):
    """CRC-32 of the UTF-8 bytes of the expression ``text``: four bits at a time, the lower ones of a byte first."""
    hexed = f"hex(encode({text}))"
    nibble = (
        f"instr('0123456789ABCDEF', substr({hexed}, CAST(CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END AS BIGINT), 1)) - 1"
    )
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
        f"list_transform(range(1, length({hexed}) + 1), lambda i: CAST({nibble} AS BIGINT))), "
        f"lambda a, b: xor([{_nibble_table()}][(xor(a, b) & 15) + 1]::BIGINT, a >> 4)), CAST(4294967295 AS BIGINT))"
    )


_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
df AS (
  SELECT rid, unnest(w) AS f FROM d
  UNION ALL
  SELECT rid, w[s] || ' ' || w[s + 1] FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 1)) AS s FROM d)
),
bf AS (
  SELECT unnest(w) AS f FROM b
  UNION ALL
  SELECT w[s] || ' ' || w[s + 1] FROM (SELECT w, unnest(generate_series(1, len(w) - 1)) AS s FROM b)
),
known AS (
  SELECT f, {crc32("f")} % 10000 AS k FROM (SELECT f FROM df UNION SELECT f FROM bf)
),
s AS (SELECT k, count(*) AS n FROM df JOIN known USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bf JOIN known USING (f) GROUP BY k),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM df) + 10000.0::DOUBLE)
    / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bf) + 10000.0::DOUBLE)))) AS g
  FROM (SELECT DISTINCT k FROM known) LEFT JOIN s USING (k) LEFT JOIN t USING (k)
),
w AS (
  SELECT rid, count(*) AS n_features, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight
  FROM df JOIN known USING (f) JOIN gain USING (k) GROUP BY rid
),
sc AS (
  SELECT doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (rid)
),
r AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS spot, count(*) FILTER (able) OVER () AS n FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND spot <= 25 * n // 100 THEN spot END AS rank FROM r
"""

OP12_SQL = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{_UPPER}', '{_LOWER}') AS run
  FROM documents
),
c AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY doc_id, run),
h AS (SELECT run, n, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM c),
m AS (
  SELECT n, CASE WHEN h % 97 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM h
),
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM m WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM v)
),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.k = b.k AND a.word <> b.word
  UNION SELECT less.word, v.word, v.n FROM less JOIN v ON less.k = v.word
  UNION SELECT v.word, less.word, less.n FROM less JOIN v ON less.k = v.word
),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS near_n, arg_min(other, (-n, other)) AS other FROM near GROUP BY word
),
f AS (
  SELECT v.word, CASE WHEN near_n >= 2 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS root FROM f
  UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON chain.root = f.word WHERE f.form IS NOT NULL
),
ends AS (SELECT chain.word, root FROM chain JOIN f ON chain.root = f.word WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""
