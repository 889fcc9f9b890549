"""DuckDB SQL of the operators that SQL can express, over whole tables."""

from __future__ import annotations

from sparkprep.functions.hashing import hash_uniform_sql

_CUT = r"'[\x20\x09-\x0D]+'"


def url_filter_sql() -> str:
    def draw(what: str, n: int) -> str:
        return f"CAST(floor({hash_uniform_sql('domain', seed=what)} * {n}) AS INT)"

    return rf"""
WITH cap AS (
    SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 366 AS INT) AS fetched_on,
           nullif(rtrim(translate(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.'), '') AS host
    FROM pages),
dom AS (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS domain FROM cap),
listed AS (
    SELECT domain, CASE WHEN {draw('kind', 2)} = 0 THEN 'spam' ELSE 'malware' END AS category,
           {draw('first', 200)} AS f, {draw('pause', 60)} AS p, {draw('again', 60)} AS a
    FROM dom WHERE domain <> '' AND {hash_uniform_sql('domain', seed='listed')} < 1.0 / 3),
act AS (
    SELECT domain, category, DATE '2024-01-01' + f AS valid_from,
           DATE '2024-01-01' + (f + 20 + p) AS valid_to FROM listed
    UNION ALL
    SELECT domain, category, DATE '2024-01-01' + (f + 100 + a), NULL FROM listed)
SELECT page_id, url, fetched_on, host, act.domain IS NOT NULL AS blocked, act.domain AS list_domain,
       category, valid_from AS listed_on
FROM cap LEFT JOIN act ON (host = act.domain OR ends_with(host, '.' || act.domain))
    AND fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(act.domain) DESC NULLS LAST,
                           valid_from DESC, category) = 1
"""


def quality_sql() -> str:
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce('=' || source, '-') AS host, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
win AS (
    SELECT doc_id, i, [words[i], words[i+1], words[i+2], words[i+3], words[i+4]] AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
cov AS (
    SELECT doc_id, sum(g) AS n_repeat_words FROM (
        SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS g
        FROM rep) GROUP BY doc_id),
ln AS (
    SELECT doc_id, host, md5(text) AS t, raw,
           regexp_replace(lower(trim(regexp_replace(raw, {_CUT}, ' ', 'g'), ' ')), '[0-9]', '0', 'g') AS line
    FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS raw FROM d)),
held AS (SELECT host, line, count(DISTINCT t) AS n FROM ln WHERE line <> '' GROUP BY host, line),
hosts AS (SELECT host, count(DISTINCT t) AS n_docs FROM
              (SELECT coalesce('=' || source, '-') AS host, md5(text) AS t FROM documents WHERE text IS NOT NULL)
          GROUP BY host),
bad AS (SELECT host, line FROM held JOIN hosts USING (host)
        WHERE held.n > 40 OR held.n > 5 AND held.n > n_docs * CAST(0.05 AS DOUBLE)),
lft AS (
    SELECT doc_id, sum(len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'))) AS words_left
    FROM ln WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.host = ln.host AND bad.line = ln.line)
    GROUP BY doc_id),
base AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, {_CUT}, '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(words_left, 0) AS BIGINT) AS words_left
    FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN lft USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
           AND words_left >= n_words * CAST(0.3 AS DOUBLE) AS kept,
       words_left
FROM base
"""


def mixing_sql() -> str:
    from sparkprep.llm.mixing import Mix, segments

    mix = Mix()

    def position(q: str) -> str:
        kinds = []
        for k, knots in enumerate(mix.schedules):
            here = None
            for t0, q0, m0, slope in segments(knots):
                t0, q0, m0, slope = (f"CAST({x!r} AS DOUBLE)" for x in (t0, q0, m0, slope))
                d = f"({q} - {q0})"
                t = (f"({t0} + CAST(2.0 AS DOUBLE) * {d} / ({m0} + sqrt({m0} * {m0}"
                     f" + CAST(2.0 AS DOUBLE) * {slope} * {d})))")
                here = t if here is None else f"CASE WHEN {q} >= {q0} THEN {t} ELSE {here} END"
            kinds.append(f"WHEN rank % {len(mix.schedules)} = {k} THEN {here}")
        return f"CASE {' '.join(kinds)} END"

    return rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)
                  AS BIGINT) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':{mix.seed}:' || md5(coalesce(text, ''))) AS key
           FROM documents),
src AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
cap AS (SELECT *, [{', '.join(map(str, mix.weights))}][rank % {len(mix.weights)} + 1] AS weight,
               source_size * {mix.max_repeats} AS cap FROM src),
run AS (
    SELECT *, (CAST({mix.budget} AS DOUBLE) * (SELECT sum(source_size)::BIGINT FROM cap) - coalesce(sum(cap) OVER b, 0)::BIGINT)
              / ((SELECT sum(weight) FROM cap) - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
    FROM cap WINDOW b AS (ORDER BY cap / weight, rank
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT level FROM run WHERE cap >= weight * level ORDER BY cap / weight, rank LIMIT 1),
tgt AS (SELECT source, source_size, rank, least(cap::DOUBLE, weight * lev.level) AS target FROM run, lev),
ord AS (
    SELECT d.*, rank, source_size, target,
           coalesce(sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM d JOIN tgt ON d.source IS NOT DISTINCT FROM tgt.source),
mid AS (SELECT *, start + size / 2.0::DOUBLE AS m0, start + source_size + size / 2.0::DOUBLE AS m1 FROM ord)
SELECT doc_id, size, source_size, target,
       CAST(size * (CASE WHEN size > 0 AND m0 < target THEN 1 ELSE 0 END
                    + CASE WHEN size > 0 AND m1 < target THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND m0 < target THEN {position('(m0 / target)')} END AS position
FROM mid
"""


def merkle_sql() -> str:
    def part(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(n_chars: str) -> str:
        return f"sha256({' || '.join(map(part, ('doc_id', 'source', 'lang', n_chars, 'text')))})"

    def grown(name: str, rows: str) -> str:
        return rf"""
{name} AS (
    SELECT grp, 0 AS lvl, pos, n, h FROM {rows}
    UNION ALL
    SELECT grp, lvl + 1, pos // 2, max((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos))
    FROM {name} WHERE n > 1 GROUP BY grp, lvl, pos // 2)"""

    def walked(name: str, rows: str, tree: str) -> str:
        return rf"""
{name} AS (
    SELECT doc_id, leaf, grp, 0 AS lvl, pos, n, h, proof FROM {rows}
    UNION ALL
    SELECT doc_id, leaf, w.grp, w.lvl + 1, w.pos // 2, (w.n + 1) // 2,
           sha256(CASE WHEN w.pos % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END),
           proof || coalesce(s.h, '')
    FROM {name} w LEFT JOIN {tree} s ON s.grp = w.grp AND s.lvl = w.lvl AND s.pos = xor(w.pos, 1)
    WHERE w.n > 1)"""

    # the checksum bit by bit: each character is taken before the first of its eight shifts
    x = "(CASE WHEN v < 0 THEN c ELSE xor(c, v) END)"
    crc = rf"""xor(list_reduce(list_concat([4294967295], flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda a: [ord(a), -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, v: xor({x} >> 1, CASE WHEN {x} & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""
    return rf"""
WITH RECURSIVE d AS (
    SELECT *, coalesce('=' || lang, '-') AS grp, {leaf('n_chars')} AS leaf,
           CASE WHEN {crc} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS changed FROM documents),
leaves AS (
    SELECT doc_id, grp, leaf, leaf AS h, {leaf('changed')} AS now, count(*) OVER (PARTITION BY grp) AS n,
           row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{grown('tree', 'leaves')},
subroots AS (SELECT grp, h FROM tree WHERE n = 1),
tops AS (SELECT '*' AS grp, grp AS own, h, count(*) OVER () AS n, row_number() OVER (ORDER BY grp) - 1 AS pos
         FROM subroots),
{grown('upper', 'tops')},
start AS (SELECT doc_id, leaf, grp, pos, n, now AS h, '' AS proof FROM leaves),
{walked('below', 'start', 'tree')},
turn AS (SELECT doc_id, leaf, '*' AS grp, t.pos, t.n, b.h, b.proof FROM below b JOIN tops t ON t.own = b.grp
         WHERE b.n = 1),
{walked('above', 'turn', 'upper')},
own AS (SELECT doc_id, leaf, h, proof, n FROM above),
root AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, root, sha256(a.proof) AS proof_sha256, a.h AS folded_root,
       a.h = root AS verified
FROM leaves l JOIN subroots s USING (grp) JOIN own a ON a.doc_id = l.doc_id AND a.leaf = l.leaf AND a.n = 1, root
"""
