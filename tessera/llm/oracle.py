"""DuckDB SQL of the training-data queries that SQL can express."""

from tessera.llm.mixing import FACTOR, MIDDLE, PRIME, ROUNDS, SHARD_SLOTS
from tessera.llm.secret_scan import BASE, KINDS, NAMES, PATTERNS, SCOPE

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
i AS (
  SELECT item_id, ws, least(10, len(ws)) AS w FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark) WHERE len(ws) > 0),
g AS (
  SELECT DISTINCT item_id, w, array_to_string(ws[k:k + w - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(ws) - w + 2)) AS k FROM i)),
p AS (
  SELECT r, k, w, array_to_string(ws[k:k + w - 1], ' ') AS gram
  FROM (SELECT d.r, d.ws, ww.w, unnest(range(1, len(d.ws) - ww.w + 2)) AS k FROM d, (SELECT DISTINCT w FROM g) ww)),
h AS (SELECT p.r, p.k, p.w, g.item_id FROM p JOIN g USING (w, gram)),
hit AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(k, k + w)) AS word FROM h) GROUP BY r),
it AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""

ORACLE = {"op2_decontamination": DECONTAMINATE}



def _mixing_sql() -> str:
    """The draw as the module words it: md5 keys a source and turn, swap-or-not rounds as nested selects."""
    def hashed(parts: str) -> str:
        return f"('0x' || substr(md5(concat_ws('#', {parts})), 1, 13))::BIGINT"

    x = "SELECT rank, turn, i, blocks, i AS x FROM j"
    for r in range(1, ROUNDS + 1):
        x = f"""SELECT rank, turn, i, blocks, CASE WHEN ((u * u) % {PRIME}) // {MIDDLE} % 2 = 1 THEN y ELSE x END AS x FROM (
          SELECT *, ((greatest(x, y) % {PRIME}) * {FACTOR} + greatest(x, y) // {PRIME} + k % {PRIME}) % {PRIME} AS u FROM (
          SELECT a.*, k.k, ((k.k - x) % blocks + blocks) % blocks AS y
          FROM ({x}) a JOIN k ON k.rank = a.rank AND k.turn = a.turn AND k.r = {r}))"""
    return MIXING.replace("<keys>", hashed("11, rank, turn, r")).replace("<draw>", hashed("'11:shard', rank, turn, i")).replace(
        "<rounds>", str(ROUNDS)).replace("<permuted>", x).replace("<shard_slots>", str(SHARD_SLOTS))


MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM t),
w AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (rank - 1) % 3] AS w, 2 * size::DOUBLE AS "full" FROM r),
l AS (
  SELECT *, "full" / w AS ratio, row_number() OVER (ORDER BY "full" / w, rank) AS place,
    (1.5::DOUBLE * sum(size) OVER ()
      - coalesce(sum("full") OVER (ORDER BY "full" / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY "full" / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w),
f AS (SELECT *, min(CASE WHEN ratio >= level THEN place END) OVER () AS first FROM l),
g AS (SELECT *, max(CASE WHEN place = first THEN level END) OVER () AS water FROM f),
s AS (
  SELECT source, rank, size, CASE WHEN place < coalesce(first, 1000000000) THEN "full" ELSE water * w END AS target,
    (size + 63) // 64 AS blocks FROM g),
q AS (
  SELECT *, CASE WHEN size > 0 THEN least(2 * blocks, floor(target * blocks / size + 0.5)::BIGINT) ELSE 0 END AS slots FROM s),
n AS (SELECT greatest(1, ceil(sum(slots) / <shard_slots>))::BIGINT AS shards FROM q),
u AS (
  SELECT rank, blocks, turn, least(blocks, slots - turn * blocks) AS here
  FROM (SELECT rank, blocks, slots, unnest(range((slots + blocks - 1) // blocks)) AS turn FROM q WHERE slots > 0)),
k AS (SELECT rank, turn, r, <keys> AS k FROM (SELECT rank, turn, unnest(range(1, <rounds> + 1)) AS r FROM u)),
j AS (SELECT rank, turn, blocks, unnest(range(here)) AS i FROM u),
b AS (
  SELECT rank, x AS block, count(*) AS times, min(<draw> % shards) AS shard FROM (<permuted>), n GROUP BY rank, x),
o AS (
  SELECT d.doc_id, d.size, s.rank, s.size AS source_size, s.target,
    sum(d.size) OVER (PARTITION BY s.rank ORDER BY d.doc_id NULLS FIRST, d.size) - d.size AS start
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
p AS (
  SELECT doc_id, rank, start, size, unnest(range((start // 64)::BIGINT, ((start + size - 1) // 64)::BIGINT + 1)) AS block
  FROM o WHERE size > 0),
z AS (
  SELECT doc_id, sum((least(start + size, (block + 1) * 64) - greatest(start, block * 64)) * times) AS taken, min(shard) AS shard
  FROM p JOIN b USING (rank, block) GROUP BY doc_id)
SELECT o.doc_id, o.size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, coalesce(shard, -1)::INTEGER AS first_shard
FROM o LEFT JOIN z USING (doc_id)
"""

ORACLE["op7_mixing"] = _mixing_sql()

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT r, array_to_string(ws[k:k + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS k FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (
  SELECT a, b FROM o JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE c >= 0.8::DOUBLE * (x.n + y.n - c) - 1e-9::DOUBLE),
reach AS (SELECT r, r AS t FROM d UNION SELECT reach.r, l.b FROM reach JOIN l ON reach.t = l.a),
least AS (SELECT reach.r, min(d.doc_id) AS class_id FROM reach JOIN d ON d.r = reach.t GROUP BY reach.r),
k AS (SELECT a AS r, count(*) AS links FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(links, 0)::BIGINT AS n_links FROM d JOIN least USING (r) LEFT JOIN k USING (r)
"""


def _secret_sql() -> str:
    """Matches by splitting, as the query does; links by comparing candidates of a document with each other."""
    def quoted(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    found = "\n  UNION ALL ".join(
        f"SELECT r, {n} AS kind, regexp_extract_all(text, {quoted(p)}) AS m, string_split_regex(text, {quoted(p)}) AS s "
        f"FROM d WHERE regexp_matches(text, {quoted(p)})" for n, (p, _, _) in enumerate(PATTERNS.values()))
    long = " ".join(f"WHEN {n} THEN length(regexp_extract(x, {quoted(p)}, 1)) >= {least}"
                    for n, (p, least, _) in enumerate(PATTERNS.values()))
    name = " ".join(f"WHEN {n} THEN '{NAMES.get(k, k)}'" for n, k in enumerate(KINDS))
    at = {k: n for n, k in enumerate(KINDS)}
    base = f"({', '.join(str(at[k]) for k in BASE)})"
    ids, secrets = f"({at['access']}, {at['identifier']})", f"({at['assign']}, {at['hex']}, {at['named']}, {at['bare']})"

    def near(kinds: str) -> str:
        return (f"EXISTS (SELECT 1 FROM v o WHERE o.r = v.r AND o.kind IN {kinds} AND (o.start, o.\"end\", o.kind) <> "
                f"(v.start, v.\"end\", v.kind) AND greatest(o.start - v.\"end\", v.start - o.\"end\") <= {SCOPE})")

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({found}),
e AS (SELECT r, kind, i, m[i] AS x, length(s[i]) AS gap FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM m)),
f AS (SELECT *, (sum(gap + length(x)) OVER (PARTITION BY r, kind ORDER BY i))::BIGINT AS "end" FROM e),
c AS (
  SELECT r, kind, "end" - length(x) AS start, "end" FROM f
  WHERE CASE kind {long} END AND (kind <> {at['bare']} OR (
    regexp_matches(x, '[a-z]') AND regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[0-9]')))),
v AS (
  SELECT * FROM c WHERE kind IN {base} OR NOT EXISTS (
    SELECT 1 FROM c o WHERE o.r = c.r AND (o.start, o."end", o.kind) <> (c.start, c."end", c.kind)
      AND o.start < c."end" AND c.start < o."end"
      AND (o.kind IN {base} OR (c.kind = {at['bare']} AND o.kind IN ({at['identifier']}, {at['named']}))))),
w AS (
  SELECT *, (CASE kind {name} END) || ':' || start || ':' || "end" AS span FROM v
  WHERE kind IN {base} OR (kind = {at['identifier']} AND {near(secrets)})
    OR (kind IN ({at['named']}, {at['bare']}) AND {near(ids)})
    OR (kind = {at['endpoint']} AND {near(ids)} AND {near(secrets)})),
g AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b, count(*) FILTER (WHERE kind = 2) AS h,
    string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind IN {base}) AS base,
    string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM w GROUP BY r)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


ORACLE |= {"op4_ngram_jaccard_join": NEAR_DUPLICATES, "op8_topk_search": TOP_K, "op9_secret_scan": _secret_sql()}

#: crc32 of UTF-8 bytes by its table, which is made of the polynomial.
_CRC_TABLE = """
crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crc_table
  FROM (SELECT unnest(range(256)) AS b))"""


def _crc(text: str) -> str:
    of = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: ('0x' || x)::BIGINT)"
    return (f"xor(list_reduce({of}, lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), "
            "4294967295)")


SPELLING = rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
h AS (SELECT run, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r, crc),
w AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
    FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
e AS (SELECT word, n, i, substring(word, 1, i - 1) AS a, substring(word, i + 1) AS b FROM p),
near AS (
  SELECT x.word, y.word AS near, y.n AS m FROM e x JOIN e y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT e.word, w.word, w.n FROM e JOIN w ON w.word = a || b
  UNION SELECT w.word, e.word, e.n FROM e JOIN w ON w.word = a || b),
best AS (SELECT word, count(*) AS n_near, min((-m, near)) AS f, max(m) AS m FROM near GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 5 * n THEN f[2] END AS form,
    CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM w LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.next)
SELECT word, f.form, root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, root FROM way WHERE next IS NULL) USING (word)
"""

SHARDING = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
z AS (SELECT r, doc_id, strlen(text)::BIGINT + 1 AS size, md5(text) AS k, text FROM d),
g AS (SELECT k, min(doc_id) AS first, sum(size)::BIGINT AS bytes FROM z GROUP BY k),
o AS (
  SELECT k, bytes, row_number() OVER (ORDER BY first NULLS LAST, k) AS i,
    (sum(bytes) OVER (ORDER BY first NULLS LAST, k ROWS UNBOUNDED PRECEDING))::BIGINT AS "end" FROM g),
l AS (SELECT list_concat([0::BIGINT], list("end" ORDER BY i)) AS ends, max("end") AS total, max(bytes) AS largest FROM o),
s AS (
  SELECT greatest(largest, (total + 15) // 16)::BIGINT AS low, total AS high FROM l
  UNION ALL
  SELECT CASE WHEN ok THEN low ELSE middle + 1 END, CASE WHEN ok THEN middle ELSE high END FROM (
    SELECT low, high, middle, list_reduce(range(16), lambda pos, k: list_max(list_filter(ends, lambda e: e <= pos + middle)), 0::BIGINT) = total AS ok
    FROM (SELECT low, high, (low + high) // 2 AS middle FROM s WHERE low < high), l)),
c AS (SELECT low AS capacity FROM s WHERE low >= high),
back AS (
  SELECT 16 AS k, total AS least FROM l
  UNION ALL SELECT k - 1, list_min(list_filter(ends, lambda e: e >= least - capacity)) FROM back, l, c WHERE k > 1),
cut AS (
  SELECT 0 AS k, 0::BIGINT AS pos
  UNION ALL
  SELECT cut.k + 1, greatest(least, list_max(list_filter(ends, lambda e: e <= pos + (total - pos) // (16 - cut.k))),
      coalesce(list_min(list_filter(ends, lambda e: e > pos)), total))
  FROM cut JOIN back ON back.k = cut.k + 1, l WHERE cut.k < 15),
p AS (SELECT k, i, (SELECT count(*) FROM cut WHERE cut.k > 0 AND pos <= "end" - bytes)::INTEGER AS shard FROM o)
SELECT doc_id, size, {_crc("text")} AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY i, doc_id NULLS LAST, r) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM z JOIN p USING (k), crc
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor, c.vec_id AS id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS nth FROM s WHERE same) WHERE nth <= 5),
n AS (
  SELECT p.anchor, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor AS anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE |= {"op11_spelling_variants": SPELLING, "op12_sharding": SHARDING, "op13_hard_negatives": HARD_NEGATIVES}
