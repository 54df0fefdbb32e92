"""DuckDB SQL of the registered queries whose results SQL can express.

Written from the contracts, by other routes than the operators: windows are
compared as joined strings, repeated windows by grouping, and so on.
"""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

OP5 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS.format('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ITEM_WORDS.format('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS span,
              array_to_string(w[s + 1 : s + least(10, len(w))], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(0, greatest(0, len(w) - 10) + 1)) AS s FROM b WHERE len(w) > 0)),
spans AS (SELECT DISTINCT span FROM bw),
dw AS (SELECT doc_id, span, s, array_to_string(w[s + 1 : s + span], ' ') AS win
       FROM (SELECT doc_id, w, span, unnest(range(0, len(w) - span + 1)) AS s FROM d, spans WHERE len(w) >= span)),
m AS (SELECT dw.doc_id, bw.item_id, dw.s, dw.span FROM dw JOIN bw ON dw.win = bw.win AND dw.span = bw.span),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + span)) AS p FROM (SELECT DISTINCT doc_id, s, span FROM m)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

#: kind, pattern of the spans, least length, pattern of what the length does not count.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""
_SPANS = [("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", 6, _ASSIGN), ("access", "AKIA[A-Z0-9]+", 20, ""),
          ("hex", "[0-9a-f]{24,}", 24, ""), ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, ""),
          ("forge_token", "gh[opsur]_[A-Za-z0-9]+", 40, ""), ("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 20, ""),
          ("cloud_key", "AIza[A-Za-z0-9_-]+", 39, ""),
          ("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40, "")]


def _spans_sql(i: int) -> str:
    """Matches and the pieces between them give the places."""
    kind, pattern, least, before = _SPANS[i]
    skip = f"length(regexp_extract(m[k], '^{before}'))" if before else "0"
    return f"""SELECT r, {i} AS n, '{kind}' AS kind, a, a + length(m[k]) AS b FROM (
  SELECT r, m, k, coalesce(list_sum(list_transform(s[1:k], lambda x: length(x))), 0)
                  + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT r, m, s, unnest(range(1, len(m) + 1)) AS k
        FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS s FROM d)))
 WHERE length(m[k]) - {skip} >= {least}"""


OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
x AS ({' UNION ALL '.join(_spans_sql(i) for i in range(len(_SPANS)))}),
g AS (SELECT r, count(*) FILTER (WHERE n = 0) AS n_assign, count(*) FILTER (WHERE n = 1) AS n_access,
             count(*) FILTER (WHERE n = 2) AS n_hex,
             string_agg(concat(kind, ':', CAST(a AS BIGINT), ':', CAST(b AS BIGINT)), ',' ORDER BY a, n) FILTER (WHERE n < 3) AS base,
             string_agg(concat(kind, ':', CAST(a AS BIGINT), ':', CAST(b AS BIGINT)), ',' ORDER BY a, n) AS spans
      FROM x GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.r = g.r
"""

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, p, ls[p] AS line,
             {_LOWER.format(r"regexp_replace(ls[p], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS k
      FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS p FROM d)),
g AS (SELECT k, max(doc_id) AS last_doc FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
x AS (SELECT l.*, g.k IS NOT NULL AND l.doc_id <> g.last_doc AS gone FROM l LEFT JOIN g ON l.k = g.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM x GROUP BY r, doc_id
"""

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS.format('text')} AS w FROM documents),
x AS (SELECT r, p, w[p] AS c, CASE WHEN p > 1 THEN w[p - 1] END AS b, CASE WHEN p > 2 THEN w[p - 2] END AS a
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
one AS (SELECT c, count(*) AS n FROM x GROUP BY c),
two AS (SELECT b, c, count(*) AS n FROM x WHERE b IS NOT NULL GROUP BY b, c),
three AS (SELECT a, b, c, count(*) AS n FROM x WHERE a IS NOT NULL GROUP BY a, b, c),
total AS (SELECT count(*) AS n FROM x),
s AS (SELECT x.r, CASE WHEN three.n >= 2 THEN 0 WHEN two.n >= 2 THEN (x.a IS NOT NULL)::INT
                       ELSE (x.a IS NOT NULL)::INT + (x.b IS NOT NULL)::INT END AS steps,
             CASE WHEN three.n >= 2 THEN ln(three.n) - ln(pair.n) WHEN two.n >= 2 THEN ln(two.n) - ln(word.n)
                  ELSE ln(one.n) - ln(total.n) END AS v
      FROM x JOIN one ON x.c = one.c LEFT JOIN two ON x.b = two.b AND x.c = two.c
      LEFT JOIN three ON x.a = three.a AND x.b = three.b AND x.c = three.c
      LEFT JOIN two AS pair ON pair.b = x.a AND pair.c = x.b LEFT JOIN one AS word ON word.c = x.b, total),
g AS (SELECT r, sum(steps) AS n_backoff, sum(v + steps * ln(0.4)) AS v FROM s GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_backoff, 0) AS BIGINT) AS n_backoff,
       round(v / len(w), 6) AS score
FROM d LEFT JOIN g ON d.r = g.r
"""

_RULES = ["n_words < 50", "100 * n_repeat_words > 50 * n_words", "10 * n_symbols > n_words",
          "5 * n_exclaim > n_words", "2 * n_capitals > word_chars", "2 * n_dup_lines > n_lines"]
_F = ", ".join(f"({r}) AS f{i}" for i, r in enumerate(_RULES))
_K = ", ".join(f"CAST(count(*) FILTER (WHERE f{i}) AS DOUBLE) / count(*) AS r{i}" for i in range(len(_RULES)))
_M = ", ".join(f"avg(r{i}) AS m{i}, var_pop(r{i}) AS v{i}" for i in range(len(_RULES)))
_S = ", ".join(f"CASE WHEN NOT (m{i} > 0 AND m{i} < 1) THEN 1.0 WHEN v{i} > 0 THEN "
               f"least(greatest(m{i} * (1 - m{i}) / v{i} - 1, 1.0), 1e6) ELSE 1e6 END AS s{i}" for i in range(len(_RULES)))
_MAX = "greatest(" + ", ".join(f"(r{i} * n_docs + m{i} * s{i}) / (n_docs + s{i})" for i in range(len(_RULES))) + ")"

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
                  {_SPACE_WORDS.format('text')} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
           FROM documents),
win AS (SELECT r, p, w[p + 1] AS a, w[p + 2] AS b, w[p + 3] AS c
        FROM (SELECT r, w, unnest(range(0, len(w) - 2)) AS p FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, a, b, c FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT q) AS n_repeat_words
        FROM (SELECT win.r, unnest([p, p + 1, p + 2]) AS q FROM win JOIN twice USING (r, a, b, c)) GROUP BY r),
s AS (SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_exclaim,
             CAST(len(regexp_extract_all(text, '[A-Z]')) AS BIGINT) AS n_capitals,
             CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN rep ON rep.r = d.r),
f AS (SELECT *, {_F} FROM s),
h AS (SELECT source, count(*) AS n_docs, {_K} FROM f GROUP BY source),
m AS (SELECT {_M} FROM h),
pr AS (SELECT *, {_S} FROM m),
v AS (SELECT source, {_MAX} <= 0.5 AS host_kept FROM h, pr)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f0 OR f1) AS base_failed,
       (NOT ({' OR '.join(f'f{i}' for i in range(len(_RULES)))}) AND host_kept) AS kept, host_kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

#: CRC-32 by a table of 256 values (``crc.t``) over the bytes of a text, read from its hexadecimal form.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(CAST(length(hex({0})) / 2 AS BIGINT)),
          lambda i: CAST('0x' || substr(hex({0}), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])))"""

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format('text')}, '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT run, h % length(run) AS pos, h % 199 = 0 AS loses, k
            FROM (SELECT run, k, {_CRC.format("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h
                  FROM (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL), crc)),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n
      FROM (SELECT CASE WHEN loses THEN substr(run, 1, pos) || substr(run, pos + 2) ELSE run END AS word, k FROM counted)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT less.word, v.word, v.n FROM less JOIN v ON less.rest = v.word
         UNION SELECT v.word, less.word, less.n FROM less JOIN v ON less.rest = v.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most,
                arg_min(near, (-near_n, encode(near))) AS near FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * v.n THEN near END AS form,
             CASE WHEN most >= 5 * v.n THEN most END AS form_n FROM v LEFT JOIN best USING (word)),
way AS (SELECT word, word AS stop FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = way.stop WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.stop AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN way USING (word) JOIN f AS fin ON fin.word = way.stop AND fin.form IS NULL
"""

#: Levels of 16 children that the SQL goes up in a source, and over the sources (16 ** 7 rows, 16 ** 4 sources).
_LEVELS, _TOPS = 7, 4


def _field(c: str) -> str:
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _levels(name: str, n: int) -> str:
    """CTEs ``name1`` .. ``name<n>``: the nodes of each level; a lone node of a tree stays as it is."""
    return ",\n".join(f"""{name}{i} AS (SELECT tree, r // 16 AS r, CASE WHEN max(n) = 1 THEN any_value(x) ELSE sha256(string_agg(x, '' ORDER BY r)) END AS x,
       (max(n) + 15) // 16 AS n, max(n) > 1 AS raised FROM {name}{i - 1} GROUP BY tree, r // 16)""" for i in range(1, n + 1))


def _proofs(name: str, start: str, n: int) -> str:
    """CTEs ``<name>p1`` ..: what stands left and right of each row's node in its run, level by level."""
    return ",\n".join(f"""{name}p{i} AS (SELECT c.tree, c.r, coalesce(string_agg(s.x, '' ORDER BY s.r) FILTER (WHERE s.r < c.r), '') AS a,
       coalesce(string_agg(s.x, '' ORDER BY s.r) FILTER (WHERE s.r > c.r), '') AS b
       FROM {name}{i} c JOIN {name}{i} s ON s.tree = c.tree AND s.r // 16 = c.r // 16 GROUP BY c.tree, c.r)""" for i in range(n))


def _fold(x: str, n: int, name: str) -> str:
    for i in range(n):
        x = f"CASE WHEN {name}n{i} > 1 THEN sha256({name}a{i} || {x} || {name}b{i}) ELSE {x} END"
    return x


def _op13() -> str:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    own = " || ".join(map(_field, fields))
    other = " || ".join(_field(c if c != "text" else "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") for c in fields)
    sides = lambda name, n, row: ", ".join(
        f"{name}p{i}.a AS {name}a{i}, {name}p{i}.b AS {name}b{i}, {name}{i}.n AS {name}n{i}" for i in range(n))
    joins = lambda name, n, tree, r: " ".join(
        f"JOIN {name}p{i} ON {name}p{i}.tree = {tree} AND {name}p{i}.r = {r} // {16 ** i} "
        f"JOIN {name}{i} ON {name}{i}.tree = {tree} AND {name}{i}.r = {r} // {16 ** i}" for i in range(n))
    # one step a statement, so that no expression doubles in length
    steps = []
    for k, (name, n) in enumerate((("l", _LEVELS), ("t", _TOPS))):
        steps += [(name, i) for i in range(n)]
    folds, before = [], "w"
    for j, (name, i) in enumerate(steps):
        folds.append(f"""f{j} AS (SELECT * REPLACE (CASE WHEN {name}n{i} > 1 THEN sha256({name}a{i} || y || {name}b{i}) ELSE y END AS y,
       proof || {name}a{i} || {name}b{i} AS proof) FROM {before})""")
        before = f"f{j}"
    return f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, source, sha256({own}) AS x,
             CASE WHEN coalesce({_CRC.format("CAST(doc_id AS VARCHAR)")} % 5 = 0, false) THEN sha256({other}) ELSE sha256({own}) END AS y
      FROM documents, crc),
s AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, count(*) AS n FROM d GROUP BY source),
ranked AS (SELECT doc_id, y, tree, n, x, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, x) - 1 AS r
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
l0 AS (SELECT tree, r, x, n FROM ranked),
{_levels('l', _LEVELS)},
t0 AS (SELECT 0 AS tree, tree AS r, x, (SELECT count(*) FROM s) AS n FROM l{_LEVELS}),
{_levels('t', _TOPS)},
{_proofs('l', 'ranked', _LEVELS)},
{_proofs('t', 'ranked', _TOPS)},
w AS (SELECT ranked.doc_id, ranked.x AS leaf, ranked.y, l{_LEVELS}.x AS subroot, t{_TOPS}.x AS root, '' AS proof,
             {sides('l', _LEVELS, 'ranked')}, {sides('t', _TOPS, 'ranked')}
      FROM ranked {joins('l', _LEVELS, 'ranked.tree', 'ranked.r')} {joins('t', _TOPS, '0', 'ranked.tree')}
      JOIN l{_LEVELS} ON l{_LEVELS}.tree = ranked.tree, t{_TOPS}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, y AS folded_root, y = root AS verified FROM {before}
"""


OP13 = _op13()

ORACLE = {"op3_secrets": OP3, "op6_lm_score": OP6, "op4_line_dedup": OP4, "op5_decontamination": OP5, "op8_host_rules": OP8, "op12_spelling": OP12,
          "op13_merkle": OP13}
