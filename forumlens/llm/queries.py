"""The operators as queries over whole tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlens.llm import (
    alignment,
    conversation_trie,
    graph_search,
    jaccard_join,
    licences,
    line_dedup,
    mixing,
    packing,
    pseudonyms,
    quartile_digest,
    sharding,
    toxicity,
    url_aliases,
)
from forumlens.session import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_aliases.RULES, "host string, path string, verdict string")
    return url_aliases.judge(table(spark, sf_dir, "pages"), rules)


@query
def op2_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), tokenizer())
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(materialise(pieces, "pieces"))


@query
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = pseudonyms.key_of(spark, pseudonyms.TRIAL_KEY)
    made = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), key)
    return made.select("doc_id", "text", F.size("spans").alias("n_found"), F.to_json("spans").alias("spans"))


@query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.recognise(table(spark, sf_dir, "documents"))
    columns = [F.array_join(c, ",").alias(c) for c in ("identifiers", "licences", "unknown")]
    return found.select("doc_id", *columns)


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_aliases.RULES)


def _address(url: str) -> str:
    rest = f"substr({url}, instr({url}, '://') + 3)"
    return (
        f"CASE WHEN contains({url}, '://') THEN translate(regexp_extract({rest}, '^([^/?#]*)', 1), "
        f"'{_UPPER}', '{_LOWER}') || regexp_extract({rest}, '^[^/?#]*([^#]*)', 1) END"
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _path(url: str) -> str:
    rest = f"substr({url}, instr({url}, '://') + 3)"
    return f"CASE WHEN contains({url}, '://') THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END"


def _undotted(target: str) -> str:
    found = f"regexp_extract({target}, '^([^?#]*)', 1)"
    parts = rf"string_split(substr(regexp_replace({found}, '/(\.\.?)$', '/\1/'), 2), '/')"
    step = r"CASE y WHEN '..' THEN regexp_replace(x, '/[^/]*$', '') WHEN '.' THEN x ELSE x || '/' || y END"
    return f"list_reduce({parts}, lambda x, y: {step}, '') || substr({target}, length({found}) + 1)"


def _elements(tag: str, kind: str, value: str) -> str:
    some = f"list_filter(regexp_extract_all(html, {_quoted(tag)}), lambda e: regexp_matches(e, {_quoted(kind)}))"
    ends = "'\"'' ' || chr(9) || chr(10) || chr(12) || chr(13)"
    return f"list_transform({some}, lambda e: replace(trim(regexp_extract(e, {_quoted(value)}, 1), {ends}), '&amp;', '&'))"


_SITE = f"regexp_extract(url, {_quoted(url_aliases.SITE)}, 1)"
_LINKS = rf"""
links AS (SELECT address AS a, {_address("t")} AS b FROM (SELECT address, CASE
    WHEN regexp_matches(t, '{url_aliases.SCHEME}//') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
    WHEN regexp_matches(t, '{url_aliases.SCHEME}') OR starts_with(t, '#') OR t = '' THEN NULL
    WHEN starts_with(t, '?') THEN {_SITE} || path || t WHEN starts_with(t, '/') THEN {_SITE} || {_undotted("t")}
    ELSE {_SITE} || {_undotted("f")} END AS t
  FROM (SELECT *, CASE WHEN contains(path, '/') THEN regexp_extract(path, '(?s)^(.*/)', 1) ELSE '/' END || t AS f
    FROM (SELECT address, url, {_path("url")} AS path, unnest(list_concat(
      {_elements(url_aliases.LINK, url_aliases.REL, url_aliases.HREF)},
      {_elements(url_aliases.META, url_aliases.REFRESH, url_aliases.TARGET)})) AS t FROM n)))),"""

ORACLES["op1_url_aliases"] = rf"""
WITH RECURSIVE u AS (
  SELECT page_id, html, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
    {_address("url")} AS address FROM pages),
n AS (SELECT page_id, html, url, address,
    translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rhost, rpath, verdict) AS (VALUES {_RULES}),
{_LINKS}
e AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
sites AS (SELECT DISTINCT address, host, path FROM n WHERE address IS NOT NULL UNION
  SELECT a, regexp_extract(a, '^([^/?#]*)', 1), regexp_extract(a, '^[^/?#]*([^?#]*)', 1) FROM e),
fit AS (SELECT s.host, s.path, max_by([rhost || rpath, verdict], length(rhost || rpath) * 1000 + length(rhost)) AS best
  FROM (SELECT DISTINCT host, path FROM sites) s JOIN rules
    ON (s.host = rhost OR ends_with(s.host, '.' || rhost)) AND starts_with(s.path, rpath) GROUP BY 1, 2),
r AS (SELECT a AS address, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.address),
roots AS (SELECT address, min(m) AS alias_of FROM r GROUP BY 1),
g AS (SELECT alias_of, min(best[2]) AS by_alias FROM roots JOIN sites USING (address) JOIN fit USING (host, path) GROUP BY 1)
SELECT page_id, n.host, n.path, best[1] AS rule, coalesce(best[2], by_alias, 'allow') AS verdict, alias_of
FROM n LEFT JOIN fit ON n.host = fit.host AND n.path = fit.path
LEFT JOIN roots ON n.address = roots.address LEFT JOIN g USING (alias_of)
"""

ORACLES["op3_jaccard_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
many AS (SELECT g, row_number() OVER () AS k FROM x GROUP BY g HAVING count(*) > 1),
y AS (SELECT doc_id, k FROM x JOIN many USING (g)),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM y a JOIN y b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
h AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n_shingles + q.n_shingles - c)),
l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r AS (SELECT doc_id, doc_id AS m FROM n UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.doc_id)
SELECT r.doc_id, n_shingles, min(m) AS component_id FROM r JOIN n USING (doc_id) GROUP BY 1, 2
"""


def _licence_sql() -> str:
    """The same sentences, names and rules. RE2 cannot look ahead, so that breaks are doubled."""
    known, names = dict(licences.ALL_KNOWN), licences.NAMED
    pattern = licences.pattern(licences.ALL_KNOWN, list(names), r"(?: |\n\n)", r"\|\|")
    sentences = ", ".join(f"'{s.replace(';', '')}': {i.split(' ')}" for s, i in known.items())
    by_name = ", ".join(f"'{s}': '{i}'" for s, i in names.items())
    steps, last = [], "b"
    for k, (name, seq) in enumerate(licences.ALL_RULES):
        words = "".join(f"<{x}>" for x in seq)
        steps.append(
            f"r{k} AS MATERIALIZED (SELECT doc_id, identifiers, replace(l, '{words}', '|') AS l, CASE WHEN contains(l, '{words}') "
            f"AND NOT list_contains(f, '{name}') THEN list_append(f, '{name}') ELSE f END AS f FROM {last})"
        )
        last = f"r{k}"
    return rf"""
WITH a AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}|', '{_LOWER} ') AS t FROM documents),
p AS (SELECT doc_id, regexp_replace(regexp_replace(t, 'software:[ \t\r\n]', 'software|' || chr(10), 'g'), '[.!?;][ \t\r\n]', '|' || chr(10), 'g') AS t FROM a),
q AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[^a-z0-9|\n]+', ' ', 'g'), '\n[ \n]*\n', '|', 'g') AS t FROM p),
d AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[ \n|]*\|[ \n|]*', '||', 'g'), ' ?\n ?', chr(10) || chr(10), 'g') AS t FROM q),
s AS (SELECT doc_id, list_transform(regexp_extract_all(t, '(?:^ ?|[\n|])({pattern})(?: ?$|[\n|])', 1),
  lambda x: replace(replace(x, chr(10) || chr(10), ' '), '||', ' ')) AS s FROM d),
m AS (SELECT MAP {{{sentences}}} AS m, MAP {{{by_name}}} AS w),
i AS (SELECT doc_id, coalesce(flatten(list_transform(s, lambda x: coalesce(m[x], list_transform(
  regexp_extract_all(regexp_replace(x, '{licences.AFTER}', ''), '{licences.names_pattern(list(names))}', 1), lambda n: w[n])))), []) AS identifiers FROM s, m),
b AS (SELECT doc_id, identifiers, array_to_string(list_transform(identifiers, lambda t: '<' || t || '>'), '') AS l,
  CAST([] AS VARCHAR[]) AS f FROM i),
{", ".join(steps)}
SELECT doc_id, array_to_string(identifiers, ',') AS identifiers, array_to_string(f, ',') AS licences,
  array_to_string(regexp_extract_all(l, '<([^>]*)>', 1), ',') AS unknown FROM {last}
"""


ORACLES["op6_licences"] = _licence_sql()


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op13_line_dedup"] = rf"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM l),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key FROM x),
m AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) - count(stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (stays), '')) AS kept_sha256
FROM (SELECT k.*, CASE WHEN last IS NULL OR last = doc_id THEN true END AS stays FROM k LEFT JOIN m USING (key)) GROUP BY 1
"""


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return alignment.align(documents, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


# DuckDB has no crc32, so that each conversation's number of borrowed turns is worked out bit by bit
ORACLES["op12_conversation_trie"] = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
table_of AS (SELECT n, n AS v, 0 AS k FROM range(256) r(n) UNION ALL
  SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM table_of WHERE k < 8),
crc AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s, 4294967295 AS v, 1 AS k FROM t UNION ALL
  SELECT conv_id, s, xor(crc.v >> 8, table_of.v), crc.k + 1 FROM crc JOIN table_of
  ON table_of.k = 8 AND table_of.n = xor(crc.v, ascii(s[crc.k])) & 255 WHERE crc.k <= length(s)),
h AS (SELECT conv_id AS c, conv_id - conv_id % 100 AS base, xor(v, 4294967295) % 6 AS h FROM crc WHERE k = length(s) + 1),
b AS (SELECT h.c, h.h, count(t.i) AS m FROM h LEFT JOIN t ON t.conv_id = h.base AND t.i <= h.h GROUP BY 1, 2),
r AS (SELECT h.c, t.i AS d, role, text FROM h JOIN t ON t.conv_id = h.base AND t.i <= h.h
  UNION ALL SELECT b.c, t.i - b.h + b.m, role, text FROM b JOIN t ON t.conv_id = b.c AND t.i > b.h),
p AS (SELECT c, CAST(0 AS BIGINT) AS d, '' AS p, CAST(NULL AS VARCHAR) AS q, CAST(0 AS BIGINT) AS chars FROM h UNION ALL
  SELECT r.c, r.d, md5(p.p || length(role) || '/' || role || text), p.p, length(text)
  FROM p JOIN r ON r.c = p.c AND r.d = p.d + 1),
n AS (SELECT d, p, min(c) AS conv_id, any_value(q) AS q, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY 1, 2),
kids AS (SELECT d - 1 AS d, q AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, p)),
up AS (SELECT p.d, p.p, CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END AS leaf, (w.n_convs - 1) * w.chars AS saved
  FROM w JOIN p ON p.c = w.conv_id AND p.d <= w.d),
sums AS (SELECT d, p, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY 1, 2),
last AS (SELECT c, max(d) AS d, max_by(p, d) AS p FROM p GROUP BY 1),
ends AS (SELECT d, p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS e FROM last GROUP BY 1, 2)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, w.n_convs, w.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(e, sha256('')) AS ends_sha256
FROM w JOIN sums USING (d, p) LEFT JOIN n above ON above.d = w.d - 1 AND above.p = w.q LEFT JOIN ends ON ends.d = w.d AND ends.p = w.p
"""
