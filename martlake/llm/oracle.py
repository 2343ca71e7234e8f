"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from martlake.llm.audit import step_orders as audit_orders
from martlake.llm.licenses import CONTAINMENT, K, TEMPLATES, template_words, tier

_PAGES = """SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages"""

#: The 32 characters of a SHA-1 in base32, from five hexadecimal digits at a time.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, {5 * g + 1}, 5))::INT >> {s}) & 31) + 1)::INT, 1)"
    for g in range(8) for s in (15, 10, 5, 0))

_OP9_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

#: Near duplicates by comparing all documents that share a shingle: words of a shingle, and the columns wanted.
def _near(words: int, columns: str) -> str:
    return rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(len(w), {words}) - 1), ' ') AS sh
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - {words - 1}))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (sh) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(doc_id, other) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
m AS (SELECT doc_id, min(other) AS least_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, {columns}
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def _levels(name: str, leaves: str, levels: int) -> str:
    """Levels of the trees of fan 8 over ``leaves`` (part, pos, h, n): of each node (l, r) the other digests of its run,
    on its left and right.  A part that has come down to one node keeps it."""
    sql, below = "", leaves
    for k in range(levels):
        sql += f"""
{name}{k} AS (SELECT x.part, x.pos, any_value(x.h) AS h, any_value(x.n) AS n,
    coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
    FROM {below} x JOIN {below} y ON x.part = y.part AND x.pos // 8 = y.pos // 8 GROUP BY x.part, x.pos),
{name}{k}_up AS (SELECT part, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h,
    (any_value(n) + 7) // 8 AS n FROM {name}{k} GROUP BY part, pos // 8),"""
        below = f"{name}{k}_up"
    return sql


def _folds(name: str, first: str, levels: int) -> str:
    """The rows of ``first`` (row, part, pos, f, sib) folded level by level."""
    sql, rows = "", first
    for k in range(levels):
        sql += f"""
{rows}_{name} AS (SELECT d.row, d.part, d.pos // 8 AS pos, CASE WHEN x.n = 1 THEN f ELSE sha256(x.l || f || x.r) END AS f,
    sib || x.l || x.r AS sib FROM {rows} d JOIN {name}{k} x ON d.part = x.part AND d.pos = x.pos),"""
        rows = f"{rows}_{name}"
    return sql


_MERKLE_LEVELS, _MERKLE_PARTS = 7, 3


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


_MERKLE_DONE = "f0" + "_t" * _MERKLE_LEVELS
_MERKLE_ALL = "g0" + "_u" * _MERKLE_PARTS
_MERKLE = f"""
WITH crc_table AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) g(i)),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS part,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS chosen,
    {" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head, {_field("text")} AS body,
    {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered
    FROM documents, crc_table),
h AS (SELECT row, doc_id, part, sha256(head || body) AS h, sha256(head || CASE WHEN chosen THEN lowered ELSE body END) AS f FROM d),
leaf AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, h, row) - 1 AS pos, count(*) OVER (PARTITION BY part) AS n FROM h),
{_levels("t", "leaf", _MERKLE_LEVELS)}
sub AS (SELECT part AS of, '' AS part, h, row_number() OVER (ORDER BY part) - 1 AS pos, count(*) OVER () AS n FROM t{_MERKLE_LEVELS - 1}_up),
{_levels("u", "sub", _MERKLE_PARTS)}
f0 AS (SELECT row, part, pos, f, '' AS sib FROM leaf),
{_folds("t", "f0", _MERKLE_LEVELS)}
g0 AS (SELECT row, '' AS part, s.pos, f, sib FROM {_MERKLE_DONE} x JOIN sub s ON s.of = x.part),
{_folds("u", "g0", _MERKLE_PARTS)}
last AS (SELECT h AS root FROM u{_MERKLE_PARTS - 1}_up)
SELECT doc_id, leaf.h AS leaf, sub.h AS subroot, root, sha256(x.sib) AS proof_sha256, x.f AS folded_root, x.f = root AS verified
FROM leaf JOIN {_MERKLE_ALL} x USING (row) JOIN sub ON sub.of = leaf.part, last
"""

_ORDERS = ", ".join(f"('{name}', {step}, {1 << k}, {before})" for _, name, step, k, before in audit_orders())

_TEMPLATES = ", ".join(f"({n}, '{name}', {tier(len(w))}, {w!r})"
                       for n, (name, text) in enumerate(TEMPLATES) for w in [template_words(text)])

ORACLE: dict[str, str] = {
    "op3_licenses": rf"""
WITH t AS (SELECT template, license, size, p.s AS sh FROM (VALUES {_TEMPLATES}) v(template, license, size, w),
           LATERAL (SELECT DISTINCT array_to_string(list_slice(w, i, i + {K - 1}), ' ') AS s
                    FROM generate_series(1, len(w) - {K - 1}) g(i)) p),
n AS (SELECT template, count(*) AS n FROM t GROUP BY template),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
p AS (SELECT doc_id, i - 1 AS pos, array_to_string(list_slice(w, i, i + {K - 1}), ' ') AS sh
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {K - 1})) AS i FROM d WHERE len(w) >= {K})),
hit AS (SELECT doc_id, template, license, size, pos, sh, unnest([pos // size, pos // size - 1]) AS j FROM p JOIN t USING (sh)),
win AS (SELECT doc_id, license, size, j, template, count(DISTINCT sh) / any_value(n) AS share, min(pos) AS a, max(pos) + {K - 1} AS z
        FROM hit JOIN n USING (template) WHERE j >= 0 GROUP BY ALL HAVING share >= {CONTAINMENT}),
one AS (SELECT doc_id, license, size, j, max(share) AS share, min(a) AS a, max(z) AS z FROM win GROUP BY ALL)
SELECT doc_id, license, max(share) AS containment, min(a)::BIGINT AS first_word, max(z)::BIGINT AS last_word,
       count(*) AS n_windows
FROM one GROUP BY doc_id, license
""",
    "op1_warc": f"""
WITH p AS ({_PAGES}),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
""",
    "op6_near_duplicates": _near(3, "least(doc_id, least_id) AS component_id, doc_id = least(doc_id, least_id) AS kept"),
    "op9_decontamination": f"""
WITH d AS (SELECT doc_id, {_OP9_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_OP9_WORDS} AS w FROM benchmark),
phrase AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS p
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM i WHERE len(w) > 0)),
place AS (
    SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS p
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
          FROM d, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, s, n FROM place JOIN phrase USING (n, p)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS pos FROM found) GROUP BY doc_id),
item AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
         FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
""",
    "op11_merkle_manifest": _MERKLE,
    "op12_filter_audit": rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, (len(w) < 50)::INT + 2 * (100 * list_unique(w) < 65 * len(w))::INT
          + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
          + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask, good, toxic
      FROM w LEFT JOIN g USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
r AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
          coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
          coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
          coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
          coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
          coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
      FROM c, (VALUES {_ORDERS}) o(filter_order, step, bit, before) GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
""",
    "op13_ngram_join": _near(4, "least(doc_id, least_id) AS component_id"),
}
