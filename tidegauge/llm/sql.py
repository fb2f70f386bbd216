"""DuckDB SQL for the results of the text operators that SQL can express."""

from __future__ import annotations

from .fingerprints import BITS, EMPTY, HIGH, LEVELS, LISTS, LOW, MAX_LEVEL, factor


def _crc_digits() -> str:
    """crc32 by half bytes: the effect of each of the sixteen values."""
    out = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(f"{value}::UBIGINT")
    return "[" + ", ".join(out) + "]"


#: Half bytes of the text in the order that crc32 takes them: low half first.
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents),
counted AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM counted WHERE length(run) >= 5),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(length(x)),
         lambda i: CAST(instr('0123456789ABCDEF', x[i + 2 - 2 * (i % 2)]) - 1 AS UBIGINT))),
         lambda crc, half: xor(crc >> 4, ({_crc_digits()})[CAST(xor(crc, half) & 15 AS INTEGER) + 1])), 4294967295::UBIGINT) AS h FROM hexed),
spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS MATERIALIZED (
  SELECT word, left(word, i) || '*' || substr(word, i + 2) AS replaced, left(word, i) || substr(word, i + 2) AS deleted
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
shorter AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cut c JOIN words w ON c.deleted = w.word),
near AS (
  SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.replaced = y.replaced AND x.word <> y.word
  UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter),
ranked AS (
  SELECT a AS word, b, w.n AS b_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place
  FROM near JOIN words w ON w.word = b),
forms AS MATERIALIZED (
  SELECT w.word, CASE WHEN r.b_n >= 2 * w.n THEN r.b END AS form, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.b_n >= 2 * w.n THEN r.b_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chain AS (
  SELECT word, word AS last FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.last FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NULL)
SELECT f.word, f.form, e.last AS root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e USING (word)"""


def _likeness(a: str, b: str) -> str:
    return f"""(SELECT CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {a}[1] = '-' OR {b}[1] = '-' THEN 0.0::DOUBLE
      ELSE coalesce(sum(CASE WHEN x = y THEN 1 ELSE 0 END)::DOUBLE / nullif(count(*), 0), 0.0) END
    FROM (SELECT substr({a}, 3 + 4 * ({LISTS} * (level - try_cast({a}[1:2] AS INTEGER)) + k), 4) AS x,
                 substr({b}, 3 + 4 * ({LISTS} * (level - try_cast({b}[1:2] AS INTEGER)) + k), 4) AS y
          FROM (SELECT unnest(range({LISTS})) AS k) ks, levels
          WHERE level BETWEEN greatest(try_cast({a}[1:2] AS INTEGER), try_cast({b}[1:2] AS INTEGER))
                AND least(try_cast({a}[1:2] AS INTEGER), try_cast({b}[1:2] AS INTEGER)) + {LEVELS - 1})
    WHERE x <> '{EMPTY}' OR y <> '{EMPTY}')"""


FINGERPRINTS = f"""
WITH levels AS (SELECT unnest(range({MAX_LEVEL + LEVELS})) AS level),
own AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS pos, count(*) OVER () AS total FROM documents),
edits AS (
  SELECT o.doc_id, o.pos, s.pos AS next_at, o.text, length(o.text) AS n_chars,
         left(o.text, length(o.text) - length(o.text) // 2) || left(s.text, length(o.text) // 2) AS edited
  FROM own o JOIN own s ON s.pos = o.pos % o.total + 1),
texts AS (SELECT pos, 0 AS kind, text AS t FROM edits UNION ALL SELECT pos, 1, edited FROM edits),
terms AS MATERIALIZED (
  SELECT DISTINCT pos, kind, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+')) AS term FROM texts),
named AS MATERIALIZED (SELECT term, md5(term)[1:{BITS // 4}] AS bucket FROM (SELECT DISTINCT term FROM terms)),
counts AS (SELECT bucket, count(DISTINCT pos) AS df FROM terms JOIN named USING (term) WHERE kind = 0 GROUP BY bucket),
lexicon AS MATERIALIZED (
  SELECT term, CAST(CAST('0x' || md5(term)[17:32] AS UBIGINT) AS HUGEINT) AS x
  FROM named JOIN counts USING (bucket) WHERE ln((SELECT count(*) FROM own) / df) BETWEEN {LOW!r} AND {HIGH!r}),
drawn AS (
  SELECT term, k, CAST(x * factor % 18446744073709551616 // 4294967296 AS BIGINT) AS number
  FROM lexicon, (SELECT unnest(range({LISTS})) AS k, unnest({[factor(k) for k in range(LISTS)]}) AS factor)),
sizes AS (SELECT pos, kind, least(CAST(floor(log2(count(*))) AS INTEGER), {MAX_LEVEL}) AS middle FROM terms JOIN lexicon USING (term) GROUP BY pos, kind),
listed AS (
  SELECT s.pos, s.kind, l.level, d.k, md5(string_agg(d.term, ' ' ORDER BY d.term))[1:4] AS h
  FROM sizes s JOIN terms t ON t.pos = s.pos AND t.kind = s.kind JOIN drawn d ON d.term = t.term
  JOIN levels l ON l.level BETWEEN s.middle AND s.middle + {LEVELS - 1} AND d.number < 1::BIGINT << (32 - l.level) GROUP BY ALL),
places AS (
  SELECT s.pos, s.kind, s.middle, l.level, ks.k FROM sizes s, levels l, (SELECT unnest(range({LISTS})) AS k) ks WHERE l.level BETWEEN s.middle AND s.middle + {LEVELS - 1}),
marked AS (
  SELECT pos, kind, format('{{:02d}}', middle) || string_agg(coalesce(h, '{EMPTY}'), '' ORDER BY level, k) AS mark
  FROM places LEFT JOIN listed USING (pos, kind, level, k) GROUP BY pos, kind, middle),
bare AS (
  SELECT x.pos, x.kind, '--' || md5(coalesce(string_agg(t.term, ' ' ORDER BY t.term), '')) AS mark
  FROM texts x LEFT JOIN terms t USING (pos, kind) ANTI JOIN sizes s USING (pos, kind) GROUP BY x.pos, x.kind),
marks AS MATERIALIZED (SELECT * FROM marked UNION ALL SELECT * FROM bare),
beside AS (
  SELECT b.doc_id, b.n_chars, sha256(b.edited) AS edited_sha256, m.mark AS fingerprint, e.mark AS edited_fingerprint, s.mark AS following
  FROM edits b JOIN marks m ON m.pos = b.pos AND m.kind = 0 JOIN marks e ON e.pos = b.pos AND e.kind = 1 JOIN marks s ON s.pos = b.next_at AND s.kind = 0)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       {_likeness('fingerprint', 'edited_fingerprint')} AS near_edited, {_likeness('fingerprint', 'following')} AS near_next
FROM beside"""


def _centroids(k: int, rounds: int) -> str:
    """One pair of tables per round: assignments, then means."""
    parts = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS pos, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x) AND abs(CAST(x AS DOUBLE)) <= 100000)) = 64),
x AS MATERIALIZED (SELECT pos, unnest(range(64)) AS d, unnest(v) AS x FROM kept),
starts AS (SELECT pos, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c FROM kept QUALIFY c < {k}),
m0 AS MATERIALIZED (SELECT c, d, x FROM starts JOIN x USING (pos))"""]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS (SELECT x.pos, m.c, CAST(sum((x.x - m.x) * (x.x - m.x)) AS BIGINT) AS distance FROM x JOIN m{i} m USING (d) GROUP BY x.pos, m.c),
a{i} AS MATERIALIZED (SELECT pos, c, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY pos ORDER BY distance, c) = 1)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT a.c, x.d, CAST(sum(x.x) AS BIGINT) AS s, count(*) AS n FROM a{i} a JOIN x USING (pos) GROUP BY a.c, x.d),
m{i + 1} AS MATERIALIZED (SELECT m.c, m.d, coalesce((s - ((s % n) + n) % n) // n, m.x) AS x FROM m{i} m LEFT JOIN s{i} s ON s.c = m.c AND s.d = m.d)""")
    parts.append(f"hashes AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM m{rounds} GROUP BY c)")
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (pos) JOIN hashes USING (c)"""


CENTROIDS = _centroids(8, 10)
