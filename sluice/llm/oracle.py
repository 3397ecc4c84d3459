"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from sluice.llm.quality_rules import BASE_RULES, RULES, STOP_WORDS, Rule
from sluice.llm.url_filter import TRACKING
from sluice.llm.url_filter import Rule as UrlRule

QUALITY = r"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
win AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
step AS (SELECT doc_id, least(3, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 3)) AS n FROM twice),
covered AS (SELECT doc_id, sum(n) AS n FROM step GROUP BY doc_id),
c AS (
    SELECT w.doc_id, len(words) AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
           len(list_filter(words, lambda x: list_contains([STOP], x))) AS n_stop_words
    FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id),
f AS (SELECT *, list_filter([BASE], lambda x: x IS NOT NULL) AS failed_base,
             list_filter([RULES], lambda x: x IS NOT NULL) AS failed_rules FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, len(failed_base) > 0 AS base_failed,
       len(failed_base) + len(failed_rules) = 0 AS kept,
       array_to_string(list_concat(failed_base, failed_rules), ',') AS failed
FROM f"""


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def broken(rules: Sequence[Rule]) -> str:
    out = []
    for rule in rules:
        value = rule.numerator + "::DOUBLE"
        if rule.denominator:
            value = f"({value} / greatest({rule.denominator}, 1)::DOUBLE)"
        sides = [f"{value} < {rule.least!r}::DOUBLE"] if rule.least is not None else []
        sides += [f"{value} > {rule.most!r}::DOUBLE"] if rule.most is not None else []
        out.append(f"CASE WHEN {' OR '.join(sides)} THEN {text(rule.name)} END")
    return ", ".join(out)


def quality(rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> str:
    stop = ", ".join(text(w) for w in sorted({w for group in STOP_WORDS.values() for w in group}))
    return QUALITY.replace("STOP", stop).replace("BASE", broken(base)).replace("RULES", broken(rules))


WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest,
             max(page_id) OVER (PARTITION BY html) AS original FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND original <> page_id THEN original END AS refers_to
FROM d"""

#: Parts of a URL: what follows `://`, host, path, query, and the canonical form.
URLS = r"""
u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
                                   lambda x: x <> '' AND NOT regexp_matches(x, '^TRACKING(=|$)'))) AS args
      FROM u),
canonical AS (
    SELECT *, CASE WHEN contains(url, '://') THEN
           regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '')
           || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS place
    FROM v)"""


def urls(rules: Sequence[UrlRule]) -> str:
    ordered = sorted(rules, key=lambda r: (len(r.name), r.name), reverse=True)
    fits = [(r, f"(host = {text(r.host)} OR ends_with(host, {text('.' + r.host)})) AND starts_with(path, {text(r.path)})") for r in ordered]
    rule = "CASE " + " ".join(f"WHEN {fit} THEN {text(r.name)}" for r, fit in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fit} THEN {text(r.verdict)}" for r, fit in fits) + " WHEN listed THEN 'block' ELSE 'allow' END"
    return f"""
WITH {URLS.replace("TRACKING", TRACKING)},
list AS (SELECT DISTINCT place FROM canonical WHERE page_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND place IS NOT NULL),
judged AS (SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
                  place IS NOT NULL AND place IN (SELECT place FROM list) AS listed FROM canonical)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict, listed FROM judged"""


EMBEDDINGS = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e, list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS n FROM embeddings),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / sqrt(a.n) / sqrt(b.n) >= 0.9),
reach(vec_id, other) AS (
    SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.other = l.a),
component AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT c.vec_id, count(l.b) AS n_links, component_id, c.vec_id = component_id AS kept
FROM component c LEFT JOIN link l ON l.a = c.vec_id GROUP BY ALL"""


#: CRC-32 byte by byte: its table of 256 entries is worked out from the polynomial.
SHARDING = r"""
WITH RECURSIVE bits AS (
    SELECT i AS n, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
    UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
steps AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE step = 8),
d AS (
    SELECT doc_id, source, coalesce(strlen(text), 0)::BIGINT + 1 AS size,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                           lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS text_crc32,
           md5(concat_ws(':', '0', doc_id)) AS key
    FROM documents, steps),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, doc_id) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n FROM d),
s AS (SELECT *, row_number() OVER (ORDER BY (2 * rank + 1) / (2 * n), source NULLS FIRST, key, doc_id) - 1 AS pos, count(*) OVER () AS total FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, ((pos * SHARDS) // total)::INT AS shard,
       pos - (((pos * SHARDS) // total) * total + SHARDS - 1) // SHARDS AS slot, NULL::INT AS grown_shard
FROM s"""


def sharding(shards: int) -> str:
    return SHARDING.replace("SHARDS", str(shards))


SEARCH = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[TERM]+') AS terms, row_number() OVER () AS row
    FROM documents),
i AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[TERM]+') AS terms
    FROM benchmark),
e AS (SELECT count(*) AS documents, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
tf AS (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
f AS (SELECT row, doc_id, n, term, count(*) AS tf FROM tf GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, e GROUP BY term, documents),
q AS (SELECT item_id, term, count(*) AS many FROM (SELECT item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
s AS (
    SELECT item_id, row, doc_id, sum(many * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // total))))::BIGINT AS score
    FROM q JOIN f USING (term) JOIN w USING (term), e GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""".replace("[TERM]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
