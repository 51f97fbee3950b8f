"""SQL twins of the operators of this subpackage that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

import re

from tallybeat.llm import urls


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _as_regex(glob: str) -> str:
    """A glob over canonical URLs as a regular expression."""
    parts = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    return "(?s)" + "".join(parts.get(t) or re.escape(t[-1]) for t in re.findall(r"\*\*|\\.|.", glob, re.DOTALL))


def _fits(rule: urls.Rule) -> str:
    host, path = _quoted(rule.host), _quoted(rule.path)
    return f"(host = {host} OR ends_with(host, '.' || {host})) AND starts_with(path, {path})"


_RANKED = sorted(urls.RULES, key=lambda r: -len(r.name))
_RULE = " ".join(f"WHEN {_fits(r)} THEN {_quoted(r.name)}" for r in _RANKED)
_VERDICT = " ".join(
    [
        *(f"WHEN {_fits(r)} THEN '{r.verdict}'" for r in _RANKED),
        *(
            f"WHEN regexp_full_match('.' || host || path, {_quoted(_as_regex(g.pattern))}) THEN '{g.verdict}'"
            for g in sorted(urls.GLOBS, key=lambda g: -len(g.pattern))
        ),
    ]
)

URLS = f"""WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), {_quoted(urls.PARTS)}, 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), {_quoted(urls.PARTS)}, 2) AS path
  FROM pages)
SELECT page_id, host, path, CASE {_RULE} END AS rule, CASE {_VERDICT} ELSE '{urls.ALLOW}' END AS verdict
FROM parts"""


def _field(value: str) -> str:
    text = f"cast({value} AS varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: The check sum of the id's digits, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id AS varchar), ''), lambda c: ascii(c)::bigint)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (grp, place, n, hash), and each with its siblings."""
    return f"""{name}_nodes(grp, level, place, n, hash) AS (
  SELECT grp, 0, place, n, hash FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
  FROM {name}_nodes WHERE n > 1 GROUP BY grp, level, place // 3, n),
{name} AS (
  SELECT grp, level, place, n, hash,
         coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
         coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
  FROM {name}_nodes WINDOW run AS (PARTITION BY grp, level, place // 3 ORDER BY place))"""


MANIFEST = f"""WITH RECURSIVE digests AS (
  SELECT doc_id, coalesce('+' || source, '') AS grp, {_leaf("text")} AS hash,
         CASE WHEN doc_id IS NOT NULL AND {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")}
              ELSE {_leaf("text")} END AS claim
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, hash) - 1 AS place,
         count(*) OVER (PARTITION BY grp) AS n FROM digests),
{_tree("inside", "leaves")},
heads AS (
  SELECT '' AS grp, grp AS source_group, hash, row_number() OVER (ORDER BY encode(grp)) - 1 AS place,
         count(*) OVER () AS n FROM inside WHERE n = 1),
{_tree("outside", "heads")},
climbs(doc_id, grp, leaf, level, place, folded, proof) AS (
  SELECT doc_id, grp, hash, 0, place, claim, '' FROM leaves
  UNION ALL
  SELECT doc_id, c.grp, leaf, c.level + 1, c.place // 3, sha256(lefts || folded || rights), proof || lefts || rights
  FROM climbs c JOIN inside i ON c.grp = i.grp AND c.level = i.level AND c.place = i.place WHERE i.n > 1),
climbed AS (
  SELECT c.*, i.hash AS subroot, h.place AS head
  FROM climbs c JOIN inside i ON c.grp = i.grp AND c.level = i.level AND c.place = i.place AND i.n = 1
  JOIN heads h ON h.source_group = c.grp),
ends(doc_id, leaf, subroot, level, place, folded, proof) AS (
  SELECT doc_id, leaf, subroot, 0, head, folded, proof FROM climbed
  UNION ALL
  SELECT doc_id, leaf, subroot, e.level + 1, e.place // 3, sha256(lefts || folded || rights), proof || lefts || rights
  FROM ends e JOIN outside o ON e.level = o.level AND e.place = o.place WHERE o.n > 1)
SELECT doc_id, leaf, subroot, o.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = o.hash AS verified
FROM ends e JOIN outside o ON e.level = o.level AND e.place = o.place AND o.n = 1"""

TWINS: dict[str, str] = {"op12_urls": URLS, "op13_manifest": MANIFEST}
