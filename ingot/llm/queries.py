"""The operators' registered queries: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, remove_path
from . import (
    bytebpe,
    chat,
    decontam,
    langid,
    licenses,
    merkle,
    packing,
    pii,
    prefixtrie,
    simhash,
    tokenfile,
    topk,
    toxicity,
)
from .common import remainder, ship, table, written

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def _query(fn: QueryFn) -> QueryFn:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.train_profiles(docs, remainder("doc_id", 5) != 0)
    return langid.identify(docs, profiles).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@_query
def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-file")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path,
                           public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        max_pieces=1_000_000).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


@_query
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@_query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


@_query
def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def _joined(spans: str):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@_query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@_query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, tau=3).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return toxicity.score(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@_query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    altered = F.crc32(docs.doc_id.cast("string").cast("binary")) % 2 == 0
    claim = [F.when(altered, F.replace(docs.text, F.lit("\n"), F.lit(""))).otherwise(docs.text)
             if c == "text" else docs[c] for c in MANIFEST_FIELDS]
    path = fresh_path(spark, "manifest")
    merkle.build(docs, MANIFEST_FIELDS, path, claim=claim)
    proofs = merkle.prove(spark, path)
    remove_path(spark, path)

    def text(digest: str):
        return F.lower(F.hex(digest))

    return proofs.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"),
        text("root").alias("root"), F.sha2(text("siblings"), 256).alias("proof_sha256"),
        text("folded_root").alias("folded_root"), "verified")


@_query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bytebpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bytebpe.decode(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = written(prefixtrie.turn_paths(table(spark, sf_dir, "conversations")), "paths")
    own = F.col("conv_id")
    heads = paths.where(own % 100 == 0)
    return prefixtrie.trie(prefixtrie.graft(
        paths, heads, own - own % 100, F.crc32(own.cast("string").cast("binary")) % 6, 5))


ORACLES["op4_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score FROM r WHERE rn <= 5"""


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_form(text: str, between: str) -> str:
    form = f"regexp_replace(coalesce({text}, ''), {_sql_text(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
    form = f"regexp_replace(lower({form}), {_sql_text(between)}, ' ', 'g')"
    form = f"'  ' || replace(replace({form}, chr(10), ' ' || chr(10) || ' '), ' ', '  ') || '  '"
    for old, new in licenses.SPELLINGS:
        old, new = (x.replace(" ", "  ") for x in (old, new))
        form = f"replace({form}, ' {old} ', ' {new} ')"
    return form


def _sql_single(form: str) -> str:
    return f"trim(regexp_replace({form}, ' +', ' ', 'g'))"


def _sql_canonical(text: str) -> str:
    return _sql_single(_sql_form(text, licenses.WHOLE))


def _sql_known(pairs: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, t in pairs)
    return (f"SELECT sha256({_sql_canonical('body')}) AS digest, min(license) AS license "
            f"FROM (VALUES {rows}) AS t(license, body) GROUP BY 1")


ORACLES["op5_license_scan"] = f"""
WITH known AS ({_sql_known(licenses.known_texts())}),
notices AS ({_sql_known(licenses.NOTICES)}),
own AS (SELECT row_number() OVER () AS r, doc_id, text,
               sha256({_sql_canonical('text')}) AS digest FROM documents),
line AS (SELECT r, unnest(string_split({_sql_form('text', licenses.LINES)}, chr(10))) AS l FROM own),
hit AS (SELECT DISTINCT r, n.license
        FROM (SELECT r, sha256({_sql_single('l')}) AS digest FROM line) JOIN notices n USING (digest)),
hits AS (SELECT r, string_agg(license, ',' ORDER BY license) AS line_licenses FROM hit GROUP BY r)
SELECT own.doc_id, own.digest, known.license,
       coalesce(hits.line_licenses, '') AS line_licenses
FROM own LEFT JOIN known USING (digest) LEFT JOIN hits ON own.r = hits.r"""

ORACLES["op6_chat_rotation"] = """
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS author, coalesce(text, '') AS words
  FROM conversations WHERE conv_id IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, author AS speaker FROM raw),
view AS (
  SELECT r.conv_id, s.speaker, r.turn, r.author, r.words, r.author = s.speaker AS own,
         CASE WHEN r.author = s.speaker THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || r.author || '|>' || chr(10) END AS head
  FROM raw r JOIN speakers s USING (conv_id)),
full_text AS (SELECT *, head || words || '<|end|>' || chr(10) AS text FROM view),
placed AS (
  SELECT *, coalesce(sum(length(text)) OVER (
    PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, author, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM full_text)
SELECT conv_id, speaker, turn, author, CASE WHEN own THEN 'assistant' ELSE 'user' END AS role,
       text, CAST(place AS BIGINT) AS start, CAST(place + length(head) AS BIGINT) AS mask_start,
       CAST(place + length(head) + length(words) AS BIGINT) AS mask_end,
       CAST(own AS INTEGER) AS masked
FROM placed"""


def _sql_seeds(table: str, key: str) -> str:
    parts = (f"SELECT {key}, p, {m} AS m, concat_ws(' ', "
             + ", ".join(f"words[p + {o}]" for o in mask) + f") AS seed FROM {table}"
             for m, mask in enumerate(decontam.MASKS))
    return " UNION ALL ".join(parts)


def _sql_words(text: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), "
            "'[^\\p{L}\\p{N}]+'), lambda w: w <> '')")


# The best stretch of a diagonal is the highest rise of the running sum (+1 for a matching
# word, -2 else) over its lowest point so far; its matches count from that point on.
ORACLES["op9_decontamination"] = f"""
WITH dw AS (SELECT doc_id, {_sql_words('text')} AS words FROM documents WHERE doc_id IS NOT NULL),
items AS (SELECT DISTINCT item_id, {_sql_words('text')} AS words FROM benchmark
          WHERE item_id IS NOT NULL),
iw AS (SELECT * FROM items WHERE len(words) > {decontam.SHORT}),
dp AS (SELECT doc_id, words, unnest(range(1, len(words) - {decontam.SPAN - 2})) AS p FROM dw),
ip AS (SELECT item_id, words, unnest(range(1, len(words) - {decontam.SPAN - 2})) AS p FROM iw),
ds AS ({_sql_seeds('dp', 'doc_id')}),
si AS ({_sql_seeds('ip', 'item_id')}),
hits AS (SELECT DISTINCT doc_id, item_id, ds.p - si.p AS diagonal FROM ds JOIN si USING (m, seed)),
laid AS (
  SELECT h.doc_id, h.item_id, h.diagonal, dw.words AS d, iw.words AS i,
         unnest(range(1, len(iw.words) + 1)) AS k
  FROM hits h JOIN dw USING (doc_id) JOIN iw USING (item_id)),
cells AS (
  SELECT doc_id, item_id, diagonal, k, len(i) AS n,
         CASE WHEN k + diagonal >= 1 AND d[k + diagonal] = i[k] THEN 1 ELSE -2 END AS s FROM laid),
sums AS (
  SELECT *, sum(s) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY k) AS up FROM cells),
rises AS (
  SELECT *, up - least(0, min(up) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY k)) AS rise
  FROM sums),
tops AS (
  SELECT *, max(rise) OVER (PARTITION BY doc_id, item_id, diagonal) AS best FROM rises),
ends AS (
  SELECT doc_id, item_id, diagonal, min(k) AS stop FROM tops WHERE rise = best AND best > 0
  GROUP BY ALL),
starts AS (
  SELECT e.doc_id, e.item_id, e.diagonal, e.stop,
         coalesce(max(k) FILTER (WHERE rise = 0 AND k < e.stop), 0) AS start
  FROM ends e JOIN rises USING (doc_id, item_id, diagonal) GROUP BY ALL),
matches AS (
  SELECT c.doc_id, c.item_id, c.diagonal, max(c.n) AS n,
         count(*) FILTER (WHERE s = 1 AND k > start AND k <= stop) AS matched
  FROM cells c JOIN starts USING (doc_id, item_id, diagonal) GROUP BY ALL)
SELECT doc_id, item_id, CAST(max(matched) AS INTEGER) AS matched, CAST(max(n) AS INTEGER) AS item_words
FROM (SELECT doc_id, item_id, n, matched FROM matches
      UNION ALL
      SELECT DISTINCT doc_id, item_id, len(i.words), len(i.words)
      FROM items i JOIN dw ON dw.words = i.words
      WHERE len(i.words) BETWEEN 1 AND {decontam.SHORT}) all_matches
GROUP BY doc_id, item_id
HAVING max(matched) >= least(13, 0.8 * max(n))"""


def _sql_crc32(number: str) -> str:
    """Unsigned crc32 of a decimal number's text, bit by bit."""
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform("
            f"string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))), "
            "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
            "lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))))")


def _sql_digest(text: str) -> str:
    def field(c: str) -> str:
        return f"coalesce(strlen({c}) || ':' || {c}, '-')"
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(field(c) for c in fields)})"


# Levels of a tree are built run by run; a node names its place, level and group.
_SQL_TREE = """
{name}(grp, level, place, digest, total) AS (
  {leaves}
  UNION ALL
  SELECT grp, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)),
         (max(total) + 2) // 3
  FROM {name} WHERE total > 1 GROUP BY grp, level, place // 3)"""


def _sql_siblings(tree: str, alias: str) -> str:
    return (f"coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM {tree} s WHERE "
            f"s.grp = {alias}.grp AND s.level = {alias}.level AND s.place // 3 = {alias}.place // 3 "
            f"AND s.place < {alias}.place), '')",
            f"coalesce((SELECT string_agg(s.digest, '' ORDER BY s.place) FROM {tree} s WHERE "
            f"s.grp = {alias}.grp AND s.level = {alias}.level AND s.place // 3 = {alias}.place // 3 "
            f"AND s.place > {alias}.place), '')")


def _sql_climb(name: str, start: str, tree: str) -> str:
    before, after = _sql_siblings(tree, "c")
    return f"""
{name}(r, grp, level, place, total, folded, proof) AS (
  {start}
  UNION ALL
  SELECT r, grp, level + 1, place // 3, (total + 2) // 3, sha256({before} || folded || {after}),
         proof || {before} || {after}
  FROM {name} c WHERE total > 1)"""


_START = ("SELECT r, grp, 0 AS level, place, total, claim AS folded, '' AS proof FROM own")
_NEXT = ("SELECT c.r, 'all' AS grp, 0 AS level, s.place, s.total, c.folded, c.proof "
         "FROM low c JOIN sources s ON s.of = c.grp WHERE c.total = 1")
ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE raw AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce('+' || source, '-') AS grp,
         {_sql_digest('text')} AS digest,
         {_sql_digest("CASE WHEN crc_even THEN replace(text, chr(10), '') ELSE text END")} AS claim
  FROM (SELECT *, {_sql_crc32('doc_id')} % 2 = 0 AS crc_even FROM documents)),
own AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest, claim) - 1
         AS place, count(*) OVER (PARTITION BY grp) AS total FROM raw),
{_SQL_TREE.format(name='tree', leaves='SELECT grp, 0 AS level, place, digest, total FROM own')},
tops AS (SELECT grp, digest FROM tree WHERE total = 1),
sources AS (
  SELECT grp AS of, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, digest,
         count(*) OVER () AS total
  FROM tops JOIN (SELECT DISTINCT grp, source FROM own) USING (grp)),
{_SQL_TREE.format(name='above',
                  leaves="SELECT 'all' AS grp, 0 AS level, place, digest, total FROM sources")},
{_sql_climb('low', _START, 'tree')},
{_sql_climb('high', _NEXT, 'above')}
SELECT own.doc_id, own.digest AS leaf, tops.digest AS subroot, root.digest AS root,
       sha256(high.proof) AS proof_sha256, high.folded AS folded_root,
       high.folded = root.digest AS verified
FROM own JOIN tops USING (grp) JOIN high ON high.r = own.r AND high.total = 1
CROSS JOIN (SELECT digest FROM above WHERE total = 1) root"""

ORACLES["op13_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id AS c, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')
         AS said, length(coalesce(text, '')) AS size, row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT c, c - c % 100 AS base, {_sql_crc32('c')} % 6 AS h FROM t),
laid AS (
  SELECT c.c, 0 AS own, t.p, t.said, t.size FROM c JOIN t ON t.c = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.c, 1, t.p, t.said, t.size FROM c JOIN t ON t.c = c.c AND t.p > c.h),
turn AS (
  SELECT c, size, row_number() OVER w AS d,
         sha256(string_agg(length(said) || ':' || said, '') OVER w) AS node
  FROM laid WINDOW w AS (PARTITION BY c ORDER BY own, p)),
member AS (SELECT c, 0 AS d, 'root' AS node, 0 AS size FROM c
           UNION ALL SELECT c, d, node, size FROM turn),
node AS (SELECT node, any_value(d) AS d, min(c) AS low, count(*) AS n, any_value(size) AS size
         FROM member GROUP BY node),
link AS (SELECT DISTINCT b.node, a.node AS up FROM member b JOIN member a
         ON a.c = b.c AND a.d = b.d - 1),
kids AS (SELECT up AS node, count(*) AS kids FROM link GROUP BY up),
below AS (
  SELECT m.node, sum(CASE WHEN k.kids IS NULL THEN 1 ELSE 0 END) AS leaves,
         sum((u.n - 1) * u.size) AS saved
  FROM node u JOIN member own ON own.node = u.node AND own.c = u.low
  JOIN member m ON m.c = u.low AND m.d <= own.d LEFT JOIN kids k ON k.node = u.node
  GROUP BY m.node),
ends AS (
  SELECT m.node, string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) AS ends
  FROM member m WHERE m.d = (SELECT max(x.d) FROM member x WHERE x.c = m.c) GROUP BY m.node)
SELECT n.low AS conv_id, n.d AS depth, p.low AS parent_conv_id, n.n AS n_convs,
       coalesce(kids.kids, 0) AS n_children, CAST(below.leaves AS BIGINT) AS n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends.ends, '')) AS ends_sha256
FROM node n JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN ends USING (node)
LEFT JOIN link USING (node) LEFT JOIN node p ON p.node = link.up"""
