"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendmill.llm.ann_tree import nearest_neighbours
from lendmill.llm.chat import conversations, digests
from lendmill.llm.columns import table
from lendmill.llm.merkle import fold, manifest, path_digest, row_digest
from lendmill.llm.mixing import mix
from lendmill.llm.packing import pack
from lendmill.llm.pivot_search import top_inner_products
from lendmill.llm.quality_rules import judge
from lendmill.llm.sharding import place
from lendmill.llm.simhash import hex_fingerprint, simhash_components
from lendmill.llm.substring_dedup import substring_dedup
from lendmill.llm.token_counts import count_tokens
from lendmill.llm.url_filter import ALLOW, BLOCK, filter_urls
from lendmill.llm.whitening import fit, whole

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query(r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 34], ' ')) AS win
  FROM w, range(1, len(words) - 33) AS t(i)
), repeated AS (
  SELECT doc_id, i FROM windows
  WHERE win IN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1)
), covered AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM repeated, range(0, 35) AS t(k)
), gone AS (
  SELECT doc_id, list(pos) AS cut FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(cut), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(
         list_transform(list_filter(range(1, len(words) + 1), lambda p: cut IS NULL OR NOT list_contains(cut, p)),
                        lambda p: words[p]), ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query()
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash_components(docs, "doc_id", "text").select(
        "doc_id", hex_fingerprint().alias("fingerprint"), "component_id"
    )


@query()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, keep_text=False)


@query()
def op5_mixing_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix(docs, keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies, not only equal texts, are kept out of a bin."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    docs = docs.withColumn("near", F.xxhash64("doc_id", "text"))  # a repeated doc_id is no key
    near = simhash_components(docs, "near", "text").select("near", "component_id").dropDuplicates(["near"])
    docs = docs.join(near, "near", "left").drop("near")
    return pack(docs, cluster="component_id").drop("component_id")


@query(r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + length(regexp_replace(replace(role, chr(10), '12345'), '<(\\*)\|', '<\1\\|', 'g')) + 1
                + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 11) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
""")
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's conversations are chains: each turn answers the one before."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    made = {"conv_id": F.lit(-1), "turn": F.col("id"), "role": role, "text": F.lit(probe)}
    probes = spark.range(2).select(*[c.cast(said.schema[n].dataType).alias(n) for n, c in made.items()])
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = said.union(probes).withColumn("number", F.row_number().over(order))
    previous = F.when(F.col("number") > 1, F.col("number") - 1)
    rows = rows.withColumn("previous", previous)
    return digests(conversations(rows, "conv_id", "number", "previous"))


#: Host, path, verdict.
URL_RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)

#: Where none of those fits: pages that hold no prose on any host.
NO_PROSE = ("*/wp-admin/", "*/wp-login", "*/cgi-bin/", "*/cart/", "*/checkout/", "*/login/", "*/signin/")


def url_rules(spark: SparkSession) -> DataFrame:
    rows = [(h + p, h, p, v, 1) for h, p, v in URL_RULES]
    rows += [(p, "", p, BLOCK, 0) for p in NO_PROSE]
    names = ("rule", "host", "path", "verdict", "priority")
    structs = [F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


@query(r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), judged AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
               WHEN rule IS NULL AND regexp_matches(path, '/(wp-admin/|wp-login|cgi-bin/|cart/|checkout/|login/|signin/)')
               THEN 'block' ELSE 'allow' END AS verdict
FROM judged
""")
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    named = F.when(F.col("priority") == 1, F.col("rule")).alias("rule")
    return filter_urls(pages, url_rules(spark)).select("page_id", "host", "path", named, "verdict")


SHARDS = 40


@query()
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return place(docs, SHARDS, keep_text=False).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line, of documents encoded whole."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select(
        "doc_id", F.col("section").cast("long").alias("line"), "start", "end", "n_tokens", "n_crossing"
    )


@query()
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


@query(r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS tag, doc_id, source, lang, n_chars, text,
         list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                                  list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
           lambda c, byte: list_reduce(list_prepend(xor(c, byte), range(8)),
             lambda r, bit: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS crc
  FROM documents
), said AS (
  SELECT tag, doc_id, source, text,
         CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS bent,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS front
  FROM docs
), leaves AS (
  SELECT tag, doc_id, source, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(front || coalesce(strlen(bent) || ':' || bent, '-')) AS bent_leaf
  FROM said
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, tag) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), nodes AS (
  SELECT 0 AS level, g, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT any_value(level) + 1, g, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY g, i // 3
), subroots AS (
  SELECT g, h, level FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, g AS i, (SELECT count(*) FROM subroots) AS n, h FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM tops WHERE n > 1 GROUP BY i // 3
), siblings AS (
  SELECT a.level, a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM nodes a JOIN nodes b ON a.level = b.level AND a.g = b.g AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY ALL
), top_siblings AS (
  SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM tops a JOIN tops b ON a.level = b.level AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY ALL
), inside AS (
  SELECT tag, 0 AS level, g, i, bent_leaf AS own, '' AS proof FROM placed
  UNION ALL
  SELECT f.tag, f.level + 1, f.g, f.i // 3, sha256(s.before || f.own || s.after), f.proof || s.before || s.after
  FROM inside f JOIN siblings s ON f.level = s.level AND f.g = s.g AND f.i = s.i
), over AS (
  SELECT f.tag, 0 AS level, f.g AS i, f.own, f.proof FROM inside f JOIN subroots r ON f.g = r.g AND f.level = r.level
  UNION ALL
  SELECT f.tag, f.level + 1, f.i // 3, sha256(s.before || f.own || s.after), f.proof || s.before || s.after
  FROM over f JOIN top_siblings s ON f.level = s.level AND f.i = s.i
), top AS (
  SELECT level, h FROM tops WHERE n = 1
)
SELECT p.doc_id, p.leaf, r.h AS subroot, top.h AS root, sha256(f.proof) AS proof_sha256, f.own AS folded_root,
       f.own = top.h AS verified
FROM placed p JOIN subroots r ON p.g = r.g JOIN over f ON p.tag = f.tag JOIN top ON f.level = top.level
""")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree over runs of three per source; half the rows are checked with their line breaks gone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    before = ("doc_id", "source", "lang", "n_chars")
    leaves = docs.select(
        "doc_id", "source", row_digest(*before, "text").alias("leaf"), row_digest(*before, text).alias("tampered")
    )
    found = manifest(leaves, "leaf", "source", "doc_id")
    folded = fold(F.col("tampered"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query(r"""
WITH vectors AS (
  SELECT row_number() OVER () AS tag, vec_id,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.tag, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM vectors q JOIN vectors v ON q.tag <> v.tag WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY tag ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
""")
def op12_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_inner_products(vectors, F.col("vec_id") % 50 == 0)


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector and component."""
    vectors = table(spark, sf_dir, "embeddings")
    whole_numbers = whole("embedding", 64, 1_000_000)
    rows = vectors.select("vec_id", whole_numbers.alias("x")).where("x IS NOT NULL")
    fitted = fit(rows, "x")
    if fitted is None:
        kinds = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, {kinds}")
    shares = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.eigenvalues])
    each = fitted.transform(rows, "x").select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, "at").cast("double").alias("explained"),
        F.lit(fitted.identity_error).alias("identity_error"),
    )
