"""Registered queries of this subpackage: thin callers of its operators with
production parameters, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.shared import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tablewright.llm.bpe import decode, encode, load_ranks

    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = decode(encode(read(spark, folder, "documents"), ranks), ranks)
    return ids.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def byte_bpe_encoder():
    """Encoder of ``byte_bpe_50k.json``: the rank file holds the same vocabulary,
    and its one special string in a text gives the special id."""
    import public_tokenizers

    from tablewright.llm.pretokens import Encoder, encoding

    special = {"<|endoftext|>": 50256}
    return Encoder(encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special),
                   frozenset(special))


def pack_documents(docs: DataFrame) -> DataFrame:
    from tablewright.llm.pack_bins import pack

    return pack(docs, byte_bpe_encoder, capacity=1024, end_id=2)


@query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read(spark, folder, "documents"))


@query
def op9_packed_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.pack_sequences import pack

    return pack(read(spark, folder, "documents"), byte_bpe_encoder, capacity=1024, end_id=50256, vocabulary=50257)


@query
def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.embeddings import near_embeddings

    return near_embeddings(read(spark, folder, "embeddings"), cosine=0.98)


SQL["op6_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, to_id) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.to_id = l.a),
component AS (SELECT vec_id, min(to_id) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT c.vec_id, coalesce(n, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM component c LEFT JOIN counted ON a = c.vec_id
"""


@query
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.minhash import near_duplicates

    return near_duplicates(read(spark, folder, "documents"), width=3, percent=85)


SQL["op10_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS shared FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
link AS (SELECT a, b FROM common WHERE 100 * shared >= 85 * (n + m - shared)),
reach(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.to_id = l.a),
component AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM component c JOIN sets USING (doc_id)
"""


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm import secrets

    found = secrets.scan(read(spark, folder, "documents"), ["doc_id"])

    def many(kind: str):
        number = secrets.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", many("assign"), many("access"), many("hex"),
                        F.sha2(secrets.digest(F.col("base")), 256).alias("base_sha256"),
                        secrets.digest(F.col("spans")).alias("spans"))


@query
def op5_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.syncmers import fingerprints

    return fingerprints(read(spark, folder, "documents"))


@query
def op7_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.warc import round_trip

    return round_trip(read(spark, folder, "pages"))


SQL["op7_warc_round_trip"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
w AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS chosen
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> chosen THEN chosen END AS refers_to FROM w
"""

#: The rules of the url filter (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.urls import judge

    return judge(read(spark, folder, "pages"), URL_RULES)


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm import toxicity

    docs = read(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, folder, "labels")))


@query
def op11_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tablewright.llm.trie_bpe import decode, encode

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = decode(encode(read(spark, folder, "documents"), path), path)
    return ids.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.merkle import manifest, proof_digest

    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(read(spark, folder, "documents"), tampered=third).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def _merkle_sql(levels: int = 7, group_levels: int = 4) -> str:
    """For at most 8 ** levels rows of a group and 8 ** group_levels groups."""
    def part(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({part('doc_id')} || {part('source')} || {part('lang')} || {part('n_chars')} || {part(text)})"

    def tree(name: str, key: str, depth: int) -> list[str]:
        """Tables ``name``0.. (key, pos, h) by level, and ``name``_s0.. with the
        siblings of each node and the number of nodes of its key."""
        out = []
        for k in range(depth):
            run = f"PARTITION BY {key}, pos // 8 ORDER BY pos ROWS BETWEEN"
            out.append(f"""{name}_s{k} AS (SELECT {key}, pos, h, count(*) OVER (PARTITION BY {key}) AS n,
  coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {name}{k})""")
            out.append(f"""{name}{k + 1} AS (SELECT {key}, pos // 8 AS pos,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}_s{k} GROUP BY ALL)""")
        return out

    def fold(of: str, first: str, name: str, key: str, place: str, depth: int) -> list[str]:
        """``of``_f: the node that the siblings give, and the siblings' text."""
        out = []
        for k in range(depth):
            held = f"{of}_f{k - 1}" if k else first
            out.append(f"""{of}_f{k} AS (SELECT x.* EXCLUDE (node, proof), CASE WHEN s.n > 1 THEN sha256(a || node || b) ELSE node END AS node,
  proof || a || b AS proof FROM {held} x JOIN {name}_s{k} s ON x.{key} IS NOT DISTINCT FROM s.{key} AND x.{place} // {8**k} = s.pos)""")
        return out

    crc = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [CAST(ascii(c) AS BIGINT), 256, 256, 256, 256, 256, 256, 256, 256]))),
  lambda x, y: CASE WHEN y < 256 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295)"""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""d AS (SELECT doc_id, lang, {leaf('text')} AS h, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS changed FROM documents)""",
        "e AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d)",
        "l0 AS (SELECT lang, pos, h FROM e)", *tree("l", "lang", levels),
        f"g AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, 1 AS one FROM l{levels})",
        "t0 AS (SELECT one, place AS pos, subroot AS h FROM g)", *tree("t", "one", group_levels),
        "x AS (SELECT e.*, coalesce(changed, h) AS node, '' AS proof FROM e)", *fold("x", "x", "l", "lang", "pos", levels),
        f"y AS (SELECT x.*, subroot, place, one FROM x_f{levels - 1} x JOIN g ON x.lang IS NOT DISTINCT FROM g.lang)",
        *fold("y", "y", "t", "one", "place", group_levels)]
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, y.h AS leaf, subroot, t{group_levels}.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = t{group_levels}.h AS verified
FROM y_f{group_levels - 1} y JOIN t{group_levels} ON y.one = t{group_levels}.one"""


SQL["op13_merkle_manifest"] = _merkle_sql()


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from tablewright.llm.hard_negatives import hard_negatives

    rows = read(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
