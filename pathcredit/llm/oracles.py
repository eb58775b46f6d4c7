"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

import itertools

from pathcredit.llm.mixing import BLOCK_ROWS, OTHER, TARGETS
from pathcredit.llm.url_filter import DIGIT, END, ORDER, OTHER as OTHER_SYMBOL, RULES, START, SYMBOLS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

_CRC_TABLE = """tbl AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n))"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text."""
    return f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(length({text})), lambda i: ascii(substr({text}, i + 1, 1))::BIGINT)),
      lambda c, b: xor(c >> 8, tbl.t[(xor(c, b) & 255) + 1])))"""


def _crc32_of_bytes(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes."""
    return f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(strlen({text})), lambda i: (instr('123456789ABCDEF', substr(hex(encode({text})), 2 * i + 1, 1)) * 16
        + instr('123456789ABCDEF', substr(hex(encode({text})), 2 * i + 2, 1)))::BIGINT)),
      lambda c, b: xor(c >> 8, tbl.t[(xor(c, b) & 255) + 1])))"""


# CRC-32 (reflected polynomial 0xEDB88320), byte by byte over the text's UTF-8 bytes.
BYTE_SHARDS = """
WITH tbl AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
raw AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hexed AS (SELECT doc_id, strlen(text) AS n, hex(encode(text)) AS h, strlen(text) + 1 AS size FROM raw),
crc AS (
  SELECT doc_id, size, xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(n), lambda i:
        (instr('123456789ABCDEF', h[2 * i + 1]) * 16 + instr('123456789ABCDEF', h[2 * i + 2]))::BIGINT)),
      lambda c, b: xor(c >> 8, tbl.t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM hexed, tbl),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32) - size AS start, sum(size) OVER () AS total FROM crc),
cut AS (SELECT *, least(7, ((2 * start + size) * 8) // (2 * total))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
w AS (SELECT *, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM n WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w"""

DECONTAMINATION = rf"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ds AS (SELECT doc_id, unnest(list_distinct(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')))) AS s
       FROM dw WHERE len(w) >= 5),
bs AS (SELECT item_id, unnest(list_distinct(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' ')))) AS s
       FROM bw WHERE len(w) >= 5),
size AS (SELECT item_id, count(*) AS shingles FROM bs GROUP BY 1),
hit AS (SELECT doc_id, item_id, count(*) AS found FROM ds JOIN bs USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, found::INTEGER AS found, shingles::INTEGER AS shingles, found / shingles AS containment
FROM hit JOIN size USING (item_id) WHERE found >= 0.8 * shingles - 1e-9"""

def _each(*parts: str) -> list[str]:
    """All wordings of parts in order; a part is a choice between alternatives divided by ``|``, maybe an empty one."""
    return [" ".join(" ".join(p).split()) for p in itertools.product(*(part.split("|") for part in parts))]


_GIVEN, _TERMS = "licensed under|released under|distributed under", "the|the terms of the"
#: Every wording of the short notices, spelled out.
_NOTICES = {
    "apache-2.0": _each(_GIVEN, _TERMS, "apache license", "|version", "2 0"),
    "mit": _each(_GIVEN, _TERMS, "mit license"),
    "bsd": _each(_GIVEN, _TERMS, "|2 clause|3 clause", "bsd license"),
    "mpl-2.0": _each("subject to the terms of the mozilla public license", "v|version", "2 0"),
    "gpl-3.0": _each(_GIVEN, _TERMS, "gnu general public license", "v|version", "3"),
    "gpl-2.0": _each(_GIVEN, _TERMS, "gnu general public license", "v|version", "2"),
    "cc-by-4.0": _each("licensed under", "|a|the", "cc by|creative commons attribution", "4 0"),
    "cc-by-sa-4.0": _each("licensed under", "cc by sa|creative commons attribution sharealike|creative commons attribution share alike|"
                          "a creative commons attribution sharealike|a creative commons attribution share alike", "4 0"),
    "cc-by-nc-4.0": _each("licensed under", "cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial|"
                          "a creative commons attribution noncommercial|a creative commons attribution non commercial", "4 0"),
}


def _stands(wordings: list[str]) -> str:
    return "(" + " OR ".join(f"contains(line, ' {w} ')" for w in wordings) + ")"


def _places(word: str) -> str:
    return f"list_filter(range(len(w)), lambda i: w[i + 1] = '{word}')"


# "copyright", at most a "c" and eight more words, then "all rights reserved".
_COPYRIGHT = f"""len(list_filter(res, lambda r: len(list_filter(list_concat({_places('copyright')}, {_places('copr')}),
    lambda c: c < r AND (r - c - 1 <= 8 OR (r - c - 1 = 9 AND w[c + 2] = 'c')))) > 0)) > 0"""


def _in_order(*parts: str) -> str:
    """Whether long mandatory passages of a licence text stand in this order."""
    at = [f"strpos(line, ' {p} ')" for p in parts]
    return " AND ".join(f"{x} > 0" for x in at) + "".join(f" AND {x} < {y}" for x, y in zip(at, at[1:]))


_TEXTS = {
    "mit-text": _in_order("permission is hereby granted free of charge to any person obtaining a copy of this",
                          "and to permit persons to whom the software is furnished to do so subject to the following conditions",
                          "the software is provided as is without warranty of any kind express or implied",
                          "or the use or other dealings in the software"),
    "bsd-text": _in_order("redistribution and use in source and binary forms with or without modification are permitted",
                          "redistributions in binary form must reproduce the above copyright notice",
                          "are disclaimed in no event shall", "even if advised of the possibility of such damage"),
    "isc-text": _in_order("distribute this software for any purpose with or without fee is hereby granted",
                          "appear in all copies the software is provided as is and", "with the use or performance of this software"),
}
_FOUND = ", ".join([f"CASE WHEN {_stands(w)} THEN '{label}' END" for label, w in _NOTICES.items()]
                   + [f"CASE WHEN {_COPYRIGHT} THEN 'copyright-line' END"]
                   + [f"CASE WHEN {e} THEN '{label}' END" for label, e in _TEXTS.items()])


def _starts(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words, 1))
    return f"list_filter(range(len(w)), lambda i: {same})"


LICENSES = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS line,
             {_starts('cc by')} AS cc, {_starts('general public license')} AS gpl,
             {_starts('all rights reserved')} AS res FROM d),
l AS (SELECT *, list_concat(list_concat(cc, gpl), res) AS base,
             list_filter([CASE WHEN len(cc) > 0 THEN 'cc-by' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END,
                          CASE WHEN len(res) > 0 THEN 'reserved' END], lambda x: x IS NOT NULL) AS bl,
             list_filter([{_FOUND}], lambda x: x IS NOT NULL) AS found FROM p)
SELECT doc_id, n_words, len(base) AS n_base, list_min(base) AS first_word, list_max(base) AS last_word,
       array_to_string(list_sort(bl), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(bl, found))), ',') AS labels,
       CASE WHEN len(found) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM l"""

_SHARES = ", ".join(f"{a}" for a in TARGETS.values())
_NAMES = ", ".join(f"'{n}'" for n in TARGETS)

# One period by earliest deadline first, over the sources that have rows; positions by a plain sort.
MIXING = f"""
WITH RECURSIVE named AS (
  SELECT doc_id, source, CASE WHEN list_contains([{_NAMES}], source) THEN source ELSE '{OTHER}' END AS stream FROM documents),
target AS (SELECT unnest([{_NAMES}]) AS stream, unnest([{_SHARES}])::BIGINT AS share, unnest(range({len(TARGETS)})) AS rank),
live AS (SELECT stream, share, row_number() OVER (ORDER BY rank) AS i FROM target
         WHERE share > 0 AND stream IN (SELECT stream FROM named)),
cfg AS (SELECT list(share ORDER BY i) AS shares, list(stream ORDER BY i) AS streams, sum(share)::BIGINT AS period FROM live),
edf AS (
  SELECT -1::BIGINT AS slot, NULL::STRUCT(deadline BIGINT, i BIGINT, turn BIGINT, release BIGINT) AS best,
         list_transform(shares, lambda s: 0::BIGINT) AS turns FROM cfg
  UNION ALL
  SELECT slot + 1, best, list_transform(range(1, len(turns) + 1), lambda i: turns[i] + (i = best.i)::BIGINT)
  FROM (SELECT slot, turns, list_min(list_filter(list_transform(range(1, len(shares) + 1), lambda i: {{
           'deadline': ((turns[i] + 1) * period + shares[i] - 1) // shares[i], 'i': i, 'turn': turns[i],
           'release': turns[i] * period // shares[i]}}), lambda x: x.release <= slot + 1)) AS best
        FROM edf, cfg WHERE slot + 1 < period)),
sched AS (SELECT e.slot, c.streams[e.best.i] AS stream, e.best.turn AS turn, e.best.release AS release,
                 e.best.deadline AS deadline, c.period FROM edf e, cfg c WHERE e.slot >= 0),
ranked AS (SELECT n.*, share, row_number() OVER (PARTITION BY n.stream ORDER BY doc_id) - 1 AS rank
           FROM named n JOIN live USING (stream)),
blocks AS (SELECT *, rank // {BLOCK_ROWS} AS block, rank // {BLOCK_ROWS} // share AS round FROM ranked),
dry AS (SELECT min(n // {BLOCK_ROWS} // share) AS until FROM (SELECT stream, share, count(*) AS n FROM ranked GROUP BY 1, 2)),
placed AS (SELECT b.*, s.release + round * period AS release, s.deadline + round * period AS deadline,
                  s.slot + round * period AS slot
           FROM blocks b JOIN sched s ON s.stream = b.stream AND s.turn = b.block - b.round * b.share)
SELECT doc_id, source, stream, block, release, deadline, slot, row_number() OVER (ORDER BY slot, rank) - 1 AS position,
       round < until AS on_target
FROM placed, dry"""

_KEPT = ("'connection','content-encoding','content-length','content-md5','content-range','content-type','keep-alive',"
         "'proxy-authenticate','proxy-authorization','proxy-connection','te','trailer','transfer-encoding','upgrade'")

WARC_REVISITS = f"""
WITH {_CRC_TABLE},
page AS (
  SELECT page_id, coalesce(html, '') AS html, split_part(url, '://', 1) AS scheme,
         regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS rest,
         1700000000 + page_id * 60 AS sec, '"' || left(md5(coalesce(html, '')), 16) || '"' AS tag FROM pages),
timed AS (SELECT *, CASE WHEN page_id % 15 = 0 THEN sec - 7200 ELSE sec + 3600 * (1 + page_id % 5) END AS seen FROM page),
rec AS (
  SELECT page_id * 4 AS record_id, 'response' AS warc_type,
         scheme || '://' || host || CASE WHEN rest[1] = '/' THEN '' ELSE '/' END || rest AS url, sec AS t,
         ['Content-Type: text/html; charset=utf-8', 'Content-Length: ' || strlen(html), 'ETag: ' || tag,
          'Last-Modified: ' || strftime(make_timestamp((sec - 86400) * 1000000), '%a, %d %b %Y %H:%M:%S GMT'),
          'Cache-Control: max-age=60', 'X-Cache: MISS'] AS lines,
         tag AS etag, strftime(make_timestamp((sec - 86400) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS modified, html AS payload
  FROM timed
  UNION ALL
  SELECT page_id * 4 + 1, 'revisit', scheme || '://' || host || CASE WHEN rest[1] = '/' THEN '' ELSE '/' END || rest, seen,
         ['Date: ' || strftime(make_timestamp(seen * 1000000), '%a, %d %b %Y %H:%M:%S GMT'),
          'etag: ' || CASE WHEN page_id % 9 = 0 THEN '"changed"' ELSE 'W/' || tag END,
          'Cache-Control: max-age=120', 'Content-Length: 0', 'Connection: close'],
         CASE WHEN page_id % 9 = 0 THEN '"changed"' ELSE tag END, NULL, NULL
  FROM timed WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 4 + 2, 'response', scheme || '://' || host || '/robots.txt', sec,
         ['Content-Type: text/plain', 'Last-Modified: ' || strftime(make_timestamp((sec - sec % 86400) * 1000000), '%a, %d %b %Y %H:%M:%S GMT')],
         NULL, strftime(make_timestamp((sec - sec % 86400) * 1000000), '%a, %d %b %Y %H:%M:%S GMT'),
         'User-agent: *' || chr(10) || 'Crawl-delay: ' || ((page_id // 50) % 7) FROM timed WHERE page_id % 50 = 0
  UNION ALL
  SELECT page_id * 4 + 3, 'revisit', scheme || '://' || host || '/robots.txt', sec,
         ['Last-Modified: ' || strftime(make_timestamp((sec - sec % 86400) * 1000000), '%a, %d %b %Y %H:%M:%S GMT'),
          'Date: ' || strftime(make_timestamp(sec * 1000000), '%a, %d %b %Y %H:%M:%S GMT')],
         NULL, strftime(make_timestamp((sec - sec % 86400) * 1000000), '%a, %d %b %Y %H:%M:%S GMT'), NULL
  FROM timed WHERE page_id % 2 = 1),
earlier AS (
  SELECT *, last_value(CASE WHEN warc_type = 'response' THEN record_id END IGNORE NULLS) OVER (
      PARTITION BY url ORDER BY t, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base_id FROM rec),
judged AS (
  SELECT a.*, b.lines AS old_lines, b.payload AS old_payload,
         CASE WHEN a.warc_type = 'response' THEN 'full' WHEN b.record_id IS NULL THEN 'missing'
              WHEN CASE WHEN a.etag IS NOT NULL AND b.etag IS NOT NULL THEN a.etag = b.etag
                        WHEN a.modified IS NOT NULL AND b.modified IS NOT NULL THEN a.modified = b.modified ELSE false END
              THEN 'resolved' ELSE 'changed' END AS status
  FROM earlier a LEFT JOIN rec b ON b.record_id = a.base_id),
merged AS (
  SELECT *, list_filter(lines, lambda x: NOT list_contains([{_KEPT}], lower(split_part(x, ':', 1)))) AS fresh FROM judged)
SELECT record_id, warc_type, url, status, CASE WHEN status = 'resolved' THEN base_id END AS resolved_from,
       CASE WHEN status = 'full' THEN array_to_string(lines, chr(10)) WHEN status = 'resolved' THEN array_to_string(list_concat(
         list_filter(old_lines, lambda x: NOT list_contains(list_transform(fresh, lambda y: lower(split_part(y, ':', 1))), lower(split_part(x, ':', 1)))),
         fresh), chr(10)) END AS headers,
       CASE status WHEN 'full' THEN strlen(payload) WHEN 'resolved' THEN strlen(old_payload) END AS payload_bytes,
       CASE status WHEN 'full' THEN {_crc32_of_bytes('coalesce(payload, {0})'.format("''"))}
                   WHEN 'resolved' THEN {_crc32_of_bytes('coalesce(old_payload, {0})'.format("''"))} END AS payload_crc32
FROM merged, tbl"""


_HOST = "translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOWER_URL = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULE_ROWS = ", ".join(f"('{says}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for says, rule in RULES)


def _level(k: int) -> str:
    """Both classes' probability of a gram's last character after its last ``k`` characters."""
    pair, context = f"substring(gram, {ORDER + 1 - k}, {k + 1})", f"substring(gram, {ORDER + 1 - k}, {k})"
    lower = f"{1 / SYMBOLS}" if k == 0 else "{c}_p"
    of = ", ".join(
        f"CASE WHEN {c}_all > 0 THEN ({c}_n + {c}_kinds * {lower.format(c=c)}) / ({c}_all + {c}_kinds) ELSE {lower.format(c=c)} END AS {c}_p"
        for c in ("allow", "block"))
    return f"""
seen{k} AS (SELECT {pair} AS pair, {context} AS context, sum(allow) AS allow_n, sum(block) AS block_n FROM counted GROUP BY 1, 2),
after{k} AS (SELECT context, sum(allow_n) AS allow_all, sum(block_n) AS block_all, count(*) FILTER (allow_n > 0) AS allow_kinds,
                    count(*) FILTER (block_n > 0) AS block_kinds FROM seen{k} GROUP BY 1),
p{k} AS (SELECT gram, {of}
         FROM {"counted" if k == 0 else f"p{k - 1}"} g JOIN seen{k} s ON s.pair = {pair} JOIN after{k} a USING (context)),"""


# Characters with their contexts counted by class, probabilities level by level, the cut from the held-out fifth.
URL_FILTER = rf"""
WITH page AS (
  SELECT row_number() OVER () AS r, page_id, {_HOST} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_replace(regexp_replace({_LOWER_URL}, '[0-9]', '{DIGIT}', 'g'), '[^a-z0/.\-]', '{OTHER_SYMBOL}', 'g') AS symbols
  FROM pages),
rules(says, rule, name, start) AS (VALUES {_RULE_ROWS}),
fits AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says
         FROM page JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY r),
ruled AS (SELECT page.*, rule, says, ('0x' || substr(md5(symbols), 1, 8))::BIGINT % 5 = 0 AS held FROM page LEFT JOIN fits USING (r)),
grams AS (SELECT r, says, held, substring('{START * ORDER}' || symbols || '{END}', i::INTEGER, {ORDER + 1}) AS gram
          FROM (SELECT *, unnest(range(1, length(symbols) + 2)) AS i FROM ruled)),
counted AS (SELECT gram, count(*) FILTER (says = 'allow' AND NOT held) AS allow, count(*) FILTER (says = 'block' AND NOT held) AS block
            FROM grams GROUP BY gram),{"".join(_level(k) for k in range(ORDER + 1))}
ratios AS (SELECT gram, (ln(allow_p) - ln(block_p))::FLOAT AS ratio FROM p{ORDER}),
scored AS (SELECT r, avg(ratio::DOUBLE) AS ratio FROM grams JOIN ratios USING (gram) GROUP BY r),
moments AS (
  SELECT count(*) FILTER (says = 'allow') AS n1, count(*) FILTER (says = 'block') AS n0, avg(ratio) FILTER (says = 'allow') AS m1,
         avg(ratio) FILTER (says = 'block') AS m0, var_pop(ratio) FILTER (says = 'allow') AS v1, var_pop(ratio) FILTER (says = 'block') AS v0
  FROM ruled JOIN scored USING (r) WHERE held AND says IS NOT NULL),
cut AS (SELECT CASE WHEN n1 > 0 AND n0 > 0 AND m1 > m0
               THEN (m1 + m0) / 2 + (n1 * v1 + n0 * v0) / (n1 + n0) / (m1 - m0) * ln(n0 / n1) ELSE 0.0 END AS cut FROM moments)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN ratio - cut >= 0 THEN 'allow' ELSE 'block' END) AS verdict,
       round(ratio - cut, 6) + 0.0 AS ratio
FROM ruled JOIN scored USING (r), cut"""


# Levels of a tree as lists of digests; a row's path takes one sibling from each.
_LEVELS_UP = """SELECT part, l + 1, list_transform(range((len(ds) + 1) // 2), lambda i:
    sha256(ds[2 * i + 1] || coalesce(ds[2 * i + 2], ''))) FROM {0} WHERE len(ds) > 1"""
_FIELDS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
                      for c in ("doc_id", "source", "lang", "{0}", "text"))
MERKLE = f"""
WITH RECURSIVE tbl AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
hashed AS (
  SELECT doc_id, lang, sha256({_FIELDS.format('n_chars')}) AS leaf, sha256({_FIELDS.format('(n_chars + 1)')}) AS changed,
         xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)),
           lambda c, b: xor(c >> 8, tbl.t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS tampered
  FROM documents, tbl),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS part FROM hashed),
low(part, l, ds) AS (
  SELECT part, 0, list(leaf ORDER BY place) FROM leaves GROUP BY part UNION ALL {_LEVELS_UP.format('low')}),
subroots AS (SELECT part, ds[1] AS subroot FROM low WHERE len(ds) = 1),
top(part, l, ds) AS (
  SELECT 0, 0, list(subroot ORDER BY part) FROM subroots UNION ALL {_LEVELS_UP.format('top')}),
steps AS (
  SELECT row_number() OVER (PARTITION BY doc_id, place, part ORDER BY tier, l) AS step, * FROM (
    SELECT doc_id, v.part, v.place, 0 AS tier, l, (place >> l) & 1 AS odd, ds[xor(place >> l, 1) + 1] AS sibling
    FROM leaves v JOIN low USING (part) WHERE len(ds) > 1
    UNION ALL
    SELECT doc_id, v.part, v.place, 1, l, (v.part >> l) & 1, ds[xor(v.part >> l, 1) + 1] FROM leaves v, top WHERE len(ds) > 1)),
folds(doc_id, part, place, step, h) AS (
  SELECT doc_id, part, place, 0, CASE WHEN tampered THEN changed ELSE leaf END FROM leaves
  UNION ALL
  SELECT f.doc_id, f.part, f.place, f.step + 1, sha256(CASE WHEN s.odd = 1 THEN s.sibling || f.h ELSE f.h || coalesce(s.sibling, '') END)
  FROM folds f JOIN steps s ON f.part = s.part AND f.place = s.place AND s.step = f.step + 1),
folded AS (SELECT part, place, arg_max(h, step) AS folded_root FROM folds GROUP BY part, place),
proofs AS (SELECT part, place, string_agg(sibling, '' ORDER BY step) AS proof FROM steps GROUP BY part, place)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM leaves JOIN subroots USING (part) JOIN folded USING (part, place) LEFT JOIN proofs USING (part, place),
     (SELECT ds[1] AS root FROM top WHERE len(ds) = 1)"""


# ------------------------------------------------------------------ conversations

_TURN = (2, 2, 3, 2)  # states: start, after s, after u, after a


def _cheaper(options: list[str]) -> str:
    return f"list_min([{', '.join(options)}])"


def _step(cost: str, letter: str, state: str) -> str:
    return f"{{'c': {cost} + {state}.c, 'a': '{letter}' || {state}.a}}"


def _row_options(q: int) -> str:
    keep = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[q]
    keeps = [f"CASE WHEN stay AND initial = '{r}' THEN {_step('late', 'K', f's{to}')} ELSE {_step('3', 'D', f's{q}')} END"
             for r, to in keep.items()]
    rerole = f"CASE WHEN stay THEN {_step('2 + late', 'R', f's{_TURN[q]}')} ELSE {_step('3', 'D', f's{q}')} END"
    return _cheaper([_step("3", "D", f"s{q}"), *keeps, rerole])


_W = ", ".join(f"{_row_options(q)} AS w{q}" for q in range(4))
_V = ", ".join(_cheaper([f"w{q}", _step("2", "I", f"w{_TURN[q]}"), _step("4", "II", f"w{_TURN[_TURN[q]]}")]) + f" AS s{q}"
               for q in range(4))
_LAST = r"[^\x20\x09-\x0D]"
CONVERSATIONS = rf"""
WITH RECURSIVE {_CRC_TABLE},
base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT b.*, {_crc32('k')} % 20 AS kind FROM base b, tbl),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE kind <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         substr(role, 1, 1) AS initial, NOT regexp_matches(text, '{_LAST}') AS blank FROM damaged),
marked AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS repeated,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), FALSE) AS bad
  FROM ordered),
faults AS (
  SELECT *, NOT blank AND NOT repeated AS stay,
         (NOT blank AND NOT repeated AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$'))::INT AS late FROM marked),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         sum(blank::INT) AS blank, sum(repeated::INT) AS duplicate, sum(late) AS truncated, sum(bad::INT) AS illegal,
         list(role ORDER BY i) AS roles, list(text ORDER BY i) AS texts FROM faults GROUP BY conv_id),
dp(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, n, {{'c': 0, 'a': ''}}, {{'c': 4, 'a': 'II'}}, {{'c': 2, 'a': 'I'}}, {{'c': 0, 'a': ''}} FROM sums
  UNION ALL
  SELECT conv_id, i, {_V} FROM (
    SELECT dp.conv_id, dp.i - 1 AS i, {_W}
    FROM dp JOIN faults f ON dp.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = dp.i)),
best AS (SELECT conv_id, s0.c AS cost, s0.a AS audit FROM dp WHERE i = 0),
walk(conv_id, pos, i, q, line) AS (
  SELECT conv_id, 0, 0, 0, NULL::VARCHAR FROM best
  UNION ALL
  SELECT conv_id, pos + 1, i + (letter <> 'I')::INT,
         CASE WHEN letter = 'D' THEN q WHEN letter = 'K' THEN CASE substr(role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
              WHEN q = 2 THEN 3 ELSE 2 END,
         CASE letter WHEN 'D' THEN NULL WHEN 'K' THEN role || ':' || text
              WHEN 'R' THEN CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || text
              ELSE CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END END
  FROM (SELECT w.*, substr(b.audit, w.pos + 1, 1) AS letter, s.roles[w.i + 1] AS role, s.texts[w.i + 1] AS text
        FROM walk w JOIN best b ON w.conv_id IS NOT DISTINCT FROM b.conv_id
        JOIN sums s ON w.conv_id IS NOT DISTINCT FROM s.conv_id WHERE w.pos < length(b.audit))),
lines AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY pos) AS repaired FROM walk GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sums s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN lines l ON c.conv_id IS NOT DISTINCT FROM l.conv_id"""


# Windows of 50 bytes as 100 hex digits, each with the smallest id that has it.
PASSAGES = """
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, strlen(coalesce(text, '')) AS n,
                  hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, r, p, substr(h, 2 * p + 1, 100) AS s FROM d, unnest(range(n - 49)) AS u(p) WHERE n >= 50),
f AS (SELECT *, min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY s) AS first FROM w),
c AS (SELECT r, p, p + 50 AS q FROM f WHERE first < coalesce(doc_id, 9223372036854775807)),
e AS (SELECT *, coalesce(p > max(q) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS new FROM c),
g AS (SELECT *, sum(new::INT) OVER (PARTITION BY r ORDER BY p) AS span FROM e),
spans AS (SELECT r, min(p) AS a, max(q) AS b FROM g GROUP BY r, span),
edges AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (
  SELECT r, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head, max(b) AS last,
         sum(b - a) AS n_removed, count(*) AS n_spans FROM edges JOIN d USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
