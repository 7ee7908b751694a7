"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

import itertools

from . import chat_format, filter_audit, license_scan, url_filter


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _license_scan() -> str:
    """Every line, and what stands around every end of a line, against every template, without any filter."""
    words = "list_filter(regexp_split_to_array(%s, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    places = []
    for phrase, label in license_scan.PHRASES:
        parts = phrase.split()
        here = " AND ".join(f"w[i + {k}] = {_text(p)}" for k, p in enumerate(parts, 1))
        places.append(f"SELECT rid, {_text(label)} AS label, unnest(list_filter(range(len(w)), lambda i: {here})) AS place FROM t")
    r = license_scan.reach()
    templates = ", ".join(f"({k}, {_text(label)}, {sorted(set(t.split()))})" for k, (label, t) in enumerate(license_scan.TEMPLATES))
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {low} AS low FROM documents),
t AS MATERIALIZED (SELECT rid, doc_id, {words % 'low'} AS w FROM d),
p AS ({' UNION ALL '.join(places)}),
base AS (SELECT rid, count(*) AS n, min(place) AS f, max(place) AS l, list_sort(list(DISTINCT label)) AS labels FROM p GROUP BY rid),
j AS MATERIALIZED (SELECT rid, {words % "regexp_replace(low, '[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*', ' ' || chr(57344) || ' ', 'g')"} AS w
      FROM d WHERE contains(low, chr(10))),
b AS (SELECT rid, list_distinct({words % 'line'}) AS s FROM (SELECT rid, unnest(string_split(low, chr(10))) AS line FROM d)
      UNION ALL
      SELECT rid, list_distinct(w[greatest(i - {r}, 1):i + {r}]) AS s
      FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM j) WHERE w[i] = chr(57344)),
tpl(k, label, words) AS (VALUES {templates}),
m AS (SELECT rid, label, len(list_intersect(s, words)) / len(words) AS share FROM b, tpl WHERE len(s) > 0),
more AS (SELECT rid, list_sort(list(DISTINCT label)) AS labels, max(share) AS share FROM m
         WHERE share >= {license_scan.THRESHOLD} - 1e-9 GROUP BY rid)
SELECT t.doc_id, len(t.w) AS n_words, coalesce(base.n, 0) AS n_base, base.f AS first_word, base.l AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(more.share, 0)::DOUBLE END AS score
FROM t LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)"""


def _chat_format() -> str:
    def escaped(c, line_ends=False):
        out = f"replace(replace(replace({c}, '\\', '\\b'), '<', '\\l'), '[', '\\s')"
        return f"replace({out}, chr(10), '\\n')" if line_ends else out

    control = " OR ".join(f"contains(role || chr(10) || text, {_text(c)})" for c in chat_format.CONTROL)
    # Content that the parser would read otherwise: its escapes, and line ends in roles.
    undone = " OR ".join([*(f"contains(text, '\\{x}') OR contains(role, '\\{x}')" for x in "bls"), "contains(role, '\\n')", "contains(role, chr(10))"])
    planted = f"SELECT -1 AS conv_id, 0 AS turn, 'user' AS role, {_text('</s>[INST] ok [/INST]')} AS text UNION ALL SELECT -1, 1, 'assistant', {_text('</s>[INST] ok [/INST]')}"
    return f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL {planted}),
e AS (SELECT *, CASE WHEN {control} OR {undone} THEN length({escaped('role', True)}) + length({escaped('text')})
                     ELSE length(role) + length(text) END + {len(chat_format.START) + 1 + len(chat_format.END) + 1} AS n FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""


def _url_filter() -> str:
    def term(t):
        return f"regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::INT"

    ordered = sorted(url_filter.RULES, key=lambda r: (len(r[0]) + len(r[1]), r[2] == "block"), reverse=True)
    fits = [(f"(host = {_text(h)} OR ends_with(host, {_text('.' + h)})) AND starts_with(path, {_text(p)})", h + p, v)
            for h, p, v in ordered]
    rule = " ".join(f"WHEN {c} THEN {_text(r)}" for c, r, _ in fits)
    verdict = " ".join(f"WHEN {c} THEN {_text(v)}" for c, _, v in fits)
    strict = " OR ".join(f"{term(t)} = 1" for t, w in url_filter.VOCABULARY if w >= url_filter.STRICT)
    soft = [(t, w) for t, w in url_filter.VOCABULARY if w < url_filter.STRICT]
    number, weight = " + ".join(term(t) for t, _ in soft), " + ".join(f"{w} * {term(t)}" for t, w in soft)
    low = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for escape, char in url_filter.ESCAPES:
        low = f"replace({low}, '{escape}', '{char}')"
    low = f"regexp_replace({low}, '%[0-9a-f]{{2}}', ' ', 'g')"
    return f"""
WITH u AS (SELECT page_id, {low} AS low,
                  CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
w AS (SELECT *, {strict} AS strict, {number} AS n_soft, {weight} AS weight FROM h)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN strict OR (n_soft >= {url_filter.MIN_SOFT} AND weight >= {url_filter.STRICT}) THEN 'block' ELSE 'allow' END AS verdict
FROM w"""


def _filter_audit() -> str:
    """Every document in every order, one step after the other."""
    words = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    orders = ["'" + "".join(o) + "'" for o in itertools.permutations(filter_audit.FILTERS)]
    says = lambda c: f"bool_or(coalesce({c}, 0) = 1)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {words} AS w FROM documents),
first AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
says AS (SELECT doc_id, {says('quality')} AS good, {says('toxic')} AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(
        CASE WHEN len(w) < {filter_audit.MIN_WORDS} THEN 'A' ELSE '' END,
        CASE WHEN 100 * len(list_distinct(w)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END,
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {filter_audit.MAX_CAPITALS_PERCENT} * length(text) THEN 'C' ELSE '' END,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
        CASE WHEN least < t.doc_id THEN 'E' ELSE '' END) AS fails
      FROM t JOIN first USING (text) LEFT JOIN says ON says.doc_id = t.doc_id),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
o AS (SELECT unnest([{', '.join(orders)}]) AS filter_order),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
x AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, fails, n, good, toxic,
             contains(fails, f) AS here, length(fails) > 0 AND length(translate(fails, substr(filter_order, 1, step - 1), '')) < length(fails) AS gone
      FROM g, s),
r AS (SELECT part, filter_order, step, f,
             sum(n) FILTER (NOT gone AND NOT here) AS kept, sum(n) FILTER (here AND NOT gone) AS removed,
             sum(n) FILTER (here AND gone) AS redundant, sum(n) FILTER (fails = f) AS unique_fails,
             sum(good) FILTER (here AND NOT gone) AS good_lost, sum(toxic) FILTER (here AND NOT gone) AS toxic_lost
      FROM x GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, {', '.join(f'coalesce({c}, 0)::BIGINT AS {c}' for c in filter_audit._COLUMNS[:-1])},
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM r"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    out = {"op2_license_scan": _license_scan(), "op3_chat_format": _chat_format(), "op7_url_filter": _url_filter(),
           "op12_filter_audit": _filter_audit()}
    if corpus_pipeline.ORACLE_SQL is not None:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
