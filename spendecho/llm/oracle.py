"""DuckDB SQL for the registered corpus queries that SQL can express."""

from __future__ import annotations

from . import chats, codes, decontaminate, merkle, mixing, quality_rules, urls

WORD = r"[^\x20\x09-\x0D]+"


def mix_sql(docs: str = "documents") -> str:
    """The seats are listed one by one here, up to the most that a source can use."""
    b, m = mixing.BLOCK_WORDS, mixing.MAX_REPEATS
    digits = " + ".join(
        f"(instr('{mixing.HEX}', substr(o, {i}, 1)) - 1) * {f}" for i, f in ((1, 256), (2, 16), (3, 1))
    )
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         md5('{mixing.SEED}' || coalesce('|' || CAST(doc_id AS VARCHAR), '')) AS o
  FROM {docs}),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
-- one source is closed a round, the one with the least room for its weight
rounds AS (
  SELECT 0 AS step, (SELECT CAST(sum(source_size) AS BIGINT) FROM sources) AS left_,
         (SELECT CAST(sum(weight) AS BIGINT) FROM sources) AS over_
  UNION ALL
  SELECT step + 1, CAST(left_ - {m} * c.source_size AS BIGINT), CAST(over_ - c.weight AS BIGINT)
  FROM rounds JOIN (SELECT *, row_number() OVER (ORDER BY {m} * source_size / weight, source NULLS LAST) AS place FROM sources) c
    ON c.place = step + 1
  WHERE over_ > 0 AND {m} * c.source_size <= c.weight * CAST(left_ AS DOUBLE) / CAST(over_ AS DOUBLE)),
level AS (SELECT * FROM rounds ORDER BY step DESC LIMIT 1),
aims AS (
  SELECT source, source_size,
         CASE WHEN over_ = 0 THEN CAST({m} * source_size AS DOUBLE)
              ELSE least(CAST({m} * source_size AS DOUBLE), weight * CAST(left_ AS DOUBLE) / CAST(over_ AS DOUBLE)) END AS target
  FROM sources, level),
seats AS (
  SELECT source, target / (2 * k - 1) AS quotient, k
  FROM (SELECT source, target, unnest(generate_series(1, CAST(ceil(target / {b}) AS BIGINT) + 2)) AS k FROM aims WHERE target > 0)),
won AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST, k) AS place FROM seats)
  WHERE place <= (SELECT (2 * sum(source_size) + {b}) // {2 * b} FROM sources) GROUP BY source),
dealt AS (
  SELECT s.*, a.source_size, a.target, coalesce(w.quota, 0) AS quota,
         ({digits}) % least(greatest(CAST(ceil(a.source_size / {mixing.SHARD_WORDS}) AS BIGINT), 1), {mixing.MAX_SHARDS}) AS shard
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
  LEFT JOIN won w ON s.source IS NOT DISTINCT FROM w.source),
shards AS (SELECT source, shard, quota, CAST(sum(size) AS BIGINT) AS words FROM dealt GROUP BY source, shard, quota),
shard_seats AS (
  SELECT source, shard, quota, row_number() OVER (PARTITION BY source ORDER BY words / (2 * k - 1) DESC, shard, k) AS place
  FROM (SELECT *, unnest(generate_series(1, quota)) AS k FROM shards WHERE words > 0)),
blocks AS (SELECT source, shard, count(*) AS n FROM shard_seats WHERE place <= quota GROUP BY source, shard),
laid AS (
  SELECT d.*, s.words, least(coalesce(b.n, 0) * {b}, s.words * {m}) AS take,
         CAST(sum(d.size) OVER (PARTITION BY d.source, d.shard ORDER BY d.o, d.doc_id NULLS LAST, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS end_
  FROM dealt d JOIN shards s ON d.source IS NOT DISTINCT FROM s.source AND d.shard = s.shard
  LEFT JOIN blocks b ON d.source IS NOT DISTINCT FROM b.source AND d.shard = b.shard),
cut AS (
  SELECT *, CASE WHEN words > 0 THEN take // words ELSE 0 END AS repeats,
         greatest(least(end_, CASE WHEN words > 0 THEN take % words ELSE 0 END) - (end_ - size), 0) AS extra_words
  FROM laid)
SELECT doc_id, size, source_size, target, CAST(repeats AS BIGINT) AS repeats,
       CAST(extra_words AS BIGINT) AS extra_words, CAST(repeats * size + extra_words AS BIGINT) AS taken
FROM cut"""


def quality_sql(docs: str = "documents") -> str:
    rules = quality_rules.RULES
    base = " OR ".join(f"({rules[r]})" for r in quality_rules.BASE_RULES)
    counts = ", ".join(f"count(*) FILTER ({sql}) AS {rule}" for rule, sql in rules.items())
    rates = " UNION ALL ".join(f"SELECT source, n, '{rule}' AS rule, {rule} AS failed FROM hosts" for rule in rules)
    return f"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM {docs}),
counted AS (
  SELECT row_number() OVER () AS r, doc_id, source, t, w, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines
  FROM split),
windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM counted WHERE len(w) >= 3)),
found AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM found) GROUP BY r),
measured AS (
  SELECT counted.*, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM counted LEFT JOIN covered ON counted.r = covered.r),
based AS (SELECT *, ({base}) AS base_failed FROM measured),
hosts AS (SELECT source, count(*) AS n, {counts} FROM based WHERE source IS NOT NULL GROUP BY source),
rates AS ({rates}),
prior AS (
  SELECT rule, mean, CASE WHEN spread <= 0 THEN 1e6 ELSE least(greatest(mean * (1 - mean) / spread - 1, 1), 1e6) END AS strength
  FROM (SELECT rule, sum(failed) / sum(n) AS mean,
               (sum(n * (failed / n - m) * (failed / n - m)) - any_value(m) * (1 - any_value(m)) * (count(*) - 1)) / sum(n) AS spread
        FROM (SELECT *, sum(failed) OVER (PARTITION BY rule) / sum(n) OVER (PARTITION BY rule) AS m FROM rates) GROUP BY rule)),
shrunk AS (SELECT source, mean, n + strength AS seen, (failed + mean * strength) / (n + strength) AS rate FROM rates JOIN prior USING (rule)),
bad AS (
  SELECT DISTINCT source FROM shrunk
  WHERE rate > {quality_rules.HOST_LIMIT}
     OR rate - {quality_rules.HOST_SURE} * sqrt(rate * (1 - rate) / (seen + 1)) > greatest({quality_rules.HOST_FLOOR}, {quality_rules.HOST_FACTOR} * mean))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM based"""


def url_sql() -> str:
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in urls.RULES)
    return f"""
WITH rules(action, host, path) AS (VALUES {rules}),
split AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split),
fits AS (
  SELECT r, u.host || u.path AS rule, u.action,
         row_number() OVER (PARTITION BY r ORDER BY length(u.host || u.path) DESC, length(u.host) DESC) AS place
  FROM cut JOIN rules u ON (cut.host = u.host OR ends_with(cut.host, '.' || u.host)) AND starts_with(cut.path, u.path))
SELECT page_id, cut.host, cut.path, rule, coalesce(action, 'allow') AS verdict
FROM cut LEFT JOIN fits ON cut.r = fits.r AND place = 1"""


def decontaminate_sql(docs: str = "documents", items: str = "benchmark") -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '{word}') AS w FROM {docs}),
item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({lower}, '{word}') AS w FROM {items}),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS line
  FROM (SELECT item, w, least({decontaminate.WINDOW}, len(w)) AS n,
               unnest(generate_series(1, len(w) - least({decontaminate.WINDOW}, len(w)) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS line
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM split, sizes WHERE len(w) >= n)),
found AS (SELECT d.r, d.i, d.n, x.item FROM doc_windows d JOIN item_windows x ON d.n = x.n AND d.line = x.line),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS j FROM found) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS line FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(line, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit ON split.r = hit.r LEFT JOIN ids ON split.r = ids.r"""


CRC_BYTE = "list_reduce(list_prepend(xor(c, CAST(b AS UBIGINT)), [CAST(0 AS UBIGINT) FOR i IN range(8)]), lambda x, y: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1)))"


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte."""
    codes = f"[CAST(ord(d) AS UBIGINT) FOR d IN string_split({text}, '') IF d <> '']"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {codes}), lambda c, b: {CRC_BYTE}), CAST(4294967295 AS UBIGINT))"


def _leaf_sql(text: str) -> str:
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree_sql(name: str, base: str) -> str:
    """Levels of a tree, and of each node what stands before and after it in its run."""
    k = merkle.FAN
    return f"""
{name}(gid, level, pos, digest, n) AS (
  {base}
  UNION ALL
  SELECT gid, level + 1, pos // {k}, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + {k} - 1) // {k})
  FROM {name} WHERE n > 1 GROUP BY gid, level, pos // {k}),
{name}_steps AS (
  SELECT x.gid, x.level, x.pos, x.n, coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS before_,
         coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS after_
  FROM {name} x JOIN {name} y ON x.gid = y.gid AND x.level = y.level AND x.pos // {k} = y.pos // {k}
  WHERE x.n > 1 GROUP BY ALL)"""


def merkle_sql(docs: str = "documents") -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 5 = 0 THEN {_leaf_sql(lowered)} ELSE {_leaf_sql("text")} END AS claimed
  FROM {docs}),
placed AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS BIGINT) AS gid, count(*) OVER (PARTITION BY source) AS n,
         CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS pos
  FROM hashed),
{_tree_sql("tree", "SELECT gid, 0, pos, leaf, n FROM placed")},
subroots AS (SELECT gid, digest FROM tree WHERE n = 1),
{_tree_sql("tops", "SELECT CAST(-1 AS BIGINT), 0, gid, digest, (SELECT count(*) FROM subroots) FROM subroots")},
steps AS (SELECT * FROM tree_steps UNION ALL SELECT * FROM tops_steps),
walk(gid, pos, tier, level, here, proof, folded) AS (
  SELECT gid, pos, gid, 0, pos, '', claimed FROM placed
  UNION ALL
  SELECT w.gid, w.pos, coalesce(s.gid, -1), CASE WHEN s.gid IS NULL THEN 0 ELSE w.level + 1 END,
         CASE WHEN s.gid IS NULL THEN w.gid ELSE w.here // {merkle.FAN} END,
         proof || coalesce(s.before_ || s.after_, ''), CASE WHEN s.gid IS NULL THEN folded ELSE sha256(s.before_ || folded || s.after_) END
  FROM walk w LEFT JOIN steps s ON s.gid = w.tier AND s.level = w.level AND s.pos = w.here
  WHERE s.gid IS NOT NULL OR w.tier >= 0),
ends AS (SELECT gid, pos, arg_max(proof, (tier < 0, level)) AS proof, arg_max(folded, (tier < 0, level)) AS folded FROM walk GROUP BY gid, pos)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM placed p JOIN ends e ON p.gid = e.gid AND p.pos = e.pos JOIN subroots s ON p.gid = s.gid JOIN tops t ON t.n = 1"""


def codes_sql(vectors: str = "embeddings") -> str:
    """Every distance of every round; whole numbers."""
    k, size, most = codes.PARTS, codes.ENTRIES, float(codes.LARGEST)
    near = "SELECT i, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT p.i, p.part, b.entry, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p.v, b.v)]) AS d FROM parts p JOIN {0} b ON p.part = b.part) GROUP BY i, part"
    rounds = ""
    for r in range(codes.ROUNDS):
        rounds += f"""
near{r} AS ({near.format(f"book{r}")}),
sums{r} AS (
  SELECT part, entry, list(CAST(floor_ AS BIGINT) ORDER BY j) AS v FROM (
    SELECT n.part, n.entry, j, (sum(p.v[j]) - ((sum(p.v[j]) % count(*)) + count(*)) % count(*)) / count(*) AS floor_
    FROM near{r} n JOIN parts p ON n.i = p.i AND n.part = p.part, (SELECT unnest(generate_series(1, (SELECT max(len(v)) FROM parts))) AS j) WHERE j <= len(p.v)
    GROUP BY n.part, n.entry, j) GROUP BY part, entry),
book{r + 1} AS (SELECT b.part, b.entry, coalesce(s.v, b.v) AS v FROM book{r} b LEFT JOIN sums{r} s ON b.part = s.part AND b.entry = s.entry),"""
    last = codes.ROUNDS
    return f"""
WITH whole AS (
  SELECT vec_id, label, [CAST(floor(greatest(least(CAST(x AS DOUBLE) * {codes.SCALE}, {most}), -{most})) AS BIGINT) FOR x IN embedding] AS v
  FROM {vectors} WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
numbered AS (
  SELECT *, CAST(row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS BIGINT) AS i
  FROM whole WHERE len(v) = (SELECT len(v) FROM whole ORDER BY vec_id NULLS LAST, v LIMIT 1)),
parts AS (
  SELECT i, part, v[len(v) * part // {k} + 1 : len(v) * (part + 1) // {k}] AS v
  FROM numbered, (SELECT unnest(range({k})) AS part)),
book0 AS (SELECT part, i AS entry, v FROM parts WHERE i < {size}),{rounds}
near_ AS ({near.format(f"book{last}")}),
coded AS (
  SELECT n.vec_id, n.label, string_agg(lower(printf('%02x', c.entry)), '' ORDER BY c.part) AS code, CAST(sum(c.d) AS BIGINT) AS error
  FROM numbered n JOIN near_ c ON n.i = c.i GROUP BY n.i, n.vec_id, n.label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book{last}) AS codebooks_sha256
FROM coded"""


def chats_sql(turns: str = "conversations") -> str:
    longer = " + ".join(f"(length({{0}}) - length(replace({{0}}, '{x}', ''))) // {len(x)}" for x in ("\\", chats.OPEN, chats.CLOSE))
    marks = len(chats.OPEN) + len(chats.CLOSE) + 2
    said = "'\\### Assistant: </turn> ok'"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {turns}
  UNION ALL VALUES (-7, 0, 'user', {said}), (-7, 1, '{chats.LOSS_ROLE}', {said}))
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{chats.LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{chats.LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum({marks} + length(role) + length(text) + {longer.format("role")} + {longer.format("text")}
                + length(role) - length(replace(role, chr(10), ''))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


ORACLE_SQL = {
    "op1_mix": mix_sql(),
    "op2_quality": quality_sql(),
    "op4_decontaminate": decontaminate_sql(),
    "op9_urls": url_sql(),
    "op11_codes": codes_sql(),
    "op12_merkle": merkle_sql(),
    "op13_chats": chats_sql(),
}
