"""DuckDB SQL with the results of the operators that SQL can express."""

from __future__ import annotations

from tiffin.llm import licenses, urls
from tiffin.llm.mixing import HASH_BITS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP10 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP8 = """
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS whole, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS body
  FROM (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS pos FROM split)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) AS occurrence FROM windows),
gone AS (
  SELECT doc_id, list(DISTINCT line) AS covered
  FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS line FROM ranked WHERE occurrence > 1) GROUP BY doc_id)
SELECT s.doc_id,
       CASE WHEN covered IS NULL THEN whole ELSE array_to_string(
         [lines[k + 1] FOR k IN range(len(lines)) IF NOT list_contains(covered, k)], chr(10)) END AS text,
       len(lines) AS n_lines, coalesce(len(covered), 0) AS n_removed
FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id
"""


def op4(weights: list[float], share: float, cap: float) -> str:
    return f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5(concat_ws(chr(10), coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))),
                         1, {HASH_BITS // 4}))::BIGINT AS h
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, {[float(w) for w in weights]}[(row_number() OVER (ORDER BY source IS NULL, source) - 1)
            % {len(weights)} + 1]::DOUBLE AS weight FROM sources),
-- targets: at the level of each source's fullness, what all sources hold together is known
levels AS (
  SELECT a.source, ({share} * (SELECT sum(source_size) FROM sources)
            - coalesce(sum({cap} * b.source_size) FILTER (b.source_size / b.weight < a.source_size / a.weight), 0))
         / sum(b.weight) FILTER (b.source_size / b.weight >= a.source_size / a.weight) AS level,
         any_value({cap} * a.source_size / a.weight) AS full_at
  FROM weighed a, weighed b GROUP BY a.source),
final AS (SELECT max(level) AS level FROM levels WHERE level <= full_at),
targets AS (
  SELECT source, source_size,
         least({cap} * source_size, coalesce((SELECT level FROM final) * weight, {cap} * source_size))::DOUBLE AS target
  FROM weighed),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM targets),
sums AS (
  SELECT source, h, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
  FROM docs GROUP BY source, h),
cuts AS (
  SELECT s.source, s.h, (s.upto <= b.target - b.passes * b.source_size)
         OR (s.upto - s.words <= b.target - b.passes * b.source_size
             AND 2 * (b.target - b.passes * b.source_size - (s.upto - s.words)) >= s.words) AS more
  FROM sums s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size::BIGINT AS size, b.source_size, b.target, d.size * (b.passes + c.more::BIGINT) AS taken
FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""


def op9(rules: list[tuple[str, str, str]]) -> str:
    cases = {"rule": [], "verdict": []}
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = (f"WHEN (host = {_quoted(host)} OR ends_with(host, {_quoted('.' + host)})) "
                f"AND starts_with(path, {_quoted(path)}) THEN ")
        cases["rule"].append(fits + _quoted(host + path))
        cases["verdict"].append(fits + _quoted(verdict))

    def hits(terms):
        free, out = r"[^\p{L}\p{N}]", []
        for t in terms:
            found = f"regexp_matches(u, '(^|{free}){t}({free}|$)')"
            if t in urls.IN_HOST:
                found = f"({found} OR regexp_matches(h, '(^|{free}){t}|{t}({free}|$)'))"
            out.append(f"{found}::INT")
        return " + ".join(out)

    def readable(column):
        one = "CASE WHEN length(x) = 3 THEN lower(decode(unhex(substr(x, 2)))) ELSE x END"
        return (f"array_to_string(list_transform(regexp_extract_all(lower({column}), '%[2-7][0-9a-f]|.', 0, 's'), "
                f"lambda x: {one}), '')")
    return rf"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
words AS (SELECT page_id, host, path, {readable('url')} AS u, {readable('host')} AS h FROM parts)
SELECT page_id, host, path, CASE {' '.join(cases['rule'])} END AS rule,
       CASE {' '.join(cases['verdict'])}
            WHEN {hits(urls.STRICT)} >= 1 OR {hits(urls.SOFT)} >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM words
"""


def _canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), {_quoted(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
    for spelling, same in licenses.EQUIVALENT:
        out = f"replace({out}, {_quoted(spelling)}, {_quoted(same)})"
    return rf"trim(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def op3() -> str:
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licenses.KNOWN_TEXTS)
    return f"""
WITH known AS (
  SELECT {_canonical('body')} AS body, min(name) AS name FROM (VALUES {known}) AS t(name, body) GROUP BY 1),
whole AS (SELECT doc_id, coalesce(text, '') AS text, {_canonical("coalesce(text, '')")} AS body FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM whole),
notices AS (
  SELECT doc_id, list_sort(list(DISTINCT name)) AS names, count(*) AS n
  FROM (SELECT doc_id, {_canonical('line')} AS body FROM lines) l JOIN known k ON l.body = k.body AND l.body <> ''
  GROUP BY doc_id)
SELECT w.doc_id, sha256(w.body) AS digest, k.name AS license,
       coalesce(array_to_string(n.names, ','), '') AS line_licenses, coalesce(n.n, 0) AS n_notice_lines
FROM whole w LEFT JOIN known k ON w.body = k.body AND w.body <> '' LEFT JOIN notices n ON w.doc_id = n.doc_id
"""


def op6(width: int) -> str:
    def words(column: str) -> str:
        return (f"regexp_extract_all(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, w, least({width}, len(w)) AS n
  FROM (SELECT item_id, {words('text')} AS w FROM benchmark) WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[p + 1:p + n], ' ') AS body
  FROM (SELECT *, unnest(range(len(w) - n + 1)) AS p FROM items)),
docs AS (SELECT doc_id, {words('text')} AS w FROM documents),
doc_windows AS (
  SELECT doc_id, p, n, array_to_string(w[p + 1:p + n], ' ') AS body
  FROM (SELECT doc_id, w, n, unnest(range(greatest(0, len(w) - n + 1))) AS p
        FROM docs, (SELECT DISTINCT n FROM item_windows))),
found AS (SELECT d.doc_id, d.p, d.n, i.item FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.body = i.body),
hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS spot FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(len(n.ids), 0) AS n_items,
       sha256(coalesce(array_to_string(n.ids, ','), '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""


def op11(conv_id: int, roles: list[str], text: str) -> str:
    """The turns and their mask from the source; lengths by whether a text holds control strings or an escaping backslash."""
    own = ", ".join(f"({conv_id}, {i}, {_quoted(r)}, {_quoted(text)})" for i, r in enumerate(roles))
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {own}) AS t(conv_id, turn, role, text)),
sized AS (
  SELECT *, replace(replace(text, '### ', '##\# '), '</turn>', '<\/turn>') AS marked,
         replace(replace(replace(text, '\', '\\'), '### ', '##\# '), '</turn>', '<\/turn>') AS doubled,
         regexp_matches(text, '\\.', 's') AS escapes,
         CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
              ELSE 1 + length(replace(replace(replace(replace(role, '\', '\\'), '### ', '##\# '), '</turn>', '<\/turn>'), ': ', ':\ ')) END AS head
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(14 + head + length(CASE WHEN escapes THEN doubled ELSE marked END))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", n_chars, "text"])) + ")"


#: Unsigned CRC-32 of a decimal number, bit by bit: the divisor is a fixed value of the checksum.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
             lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP13 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS claim
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
trees AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')) FOR i IN range((len(nodes) + 1) // 2)]
  FROM trees WHERE len(nodes) > 1),
subroots AS (
  SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM trees WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY tree) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')) FOR i IN range((len(nodes) + 1) // 2)]
  FROM tops WHERE len(nodes) > 1),
roots AS (SELECT nodes[1] AS root, level AS above FROM tops WHERE len(nodes) = 1),
steps AS (
  SELECT p.lang, p.place, t.level, (p.place >> t.level) % 2 AS is_right, t.nodes[xor(p.place >> t.level, 1) + 1] AS sibling
  FROM placed p JOIN trees t ON p.lang IS NOT DISTINCT FROM t.lang JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
  WHERE t.level < s.height
  UNION ALL
  SELECT p.lang, p.place, s.height + t.level, (s.tree >> t.level) % 2, t.nodes[xor(s.tree >> t.level, 1) + 1]
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN tops t CROSS JOIN roots r WHERE t.level < r.above),
proofs AS (
  SELECT lang, place, list({{'is_right': is_right, 'sibling': coalesce(sibling, '')}} ORDER BY level) AS proof
  FROM steps GROUP BY lang, place),
folds AS (
  SELECT p.lang, p.place, 0 AS level, claim AS node, coalesce(proof, []) AS proof
  FROM placed p LEFT JOIN proofs f ON p.lang IS NOT DISTINCT FROM f.lang AND p.place = f.place
  UNION ALL
  SELECT lang, place, level + 1, sha256(CASE WHEN proof[level + 1].is_right = 1 THEN proof[level + 1].sibling || node
                                             ELSE node || proof[level + 1].sibling END), proof
  FROM folds WHERE level < len(proof))
SELECT p.doc_id, p.leaf, s.subroot, r.root,
       sha256(coalesce(array_to_string([x.sibling FOR x IN f.proof], ''), '')) AS proof_sha256, f.node AS folded_root,
       f.node = r.root AS verified
FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN roots r
JOIN folds f ON p.lang IS NOT DISTINCT FROM f.lang AND p.place = f.place AND f.level = len(f.proof)
"""
