"""The corpus operators over the given tables: thin queries, and DuckDB SQL
where SQL can state the result."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, convrepair, covertree, decontam, filteraudit, htmltext, langid, linededup, pii, quality, sharding, simhash, toxicity
from .common import id_fold, read_table, with_columns

SHINGLE, MAX_BITS = 3, 2
TOXIC_FROM = 0.7


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def held_out(col: str, folds: int, fold: int):
    return F.coalesce(id_fold(col, folds) == fold, F.lit(False))


# ----------------------------------------------------------- 1: language ID

def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(id_fold("doc_id", 4) != 2))
    out = langid.identify(docs.select("doc_id", "text"), model, reject=False)
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")


# ------------------------------------------------------------------- 2: BPE

def token_digests(docs: DataFrame) -> DataFrame:
    """``docs`` with ids, decoded, n_tokens, ids_sha256 and decoded_sha256."""
    return with_columns(bpe.round_trip(docs, vocabulary_path()), {
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256),
        "decoded_sha256": F.sha2(F.col("decoded"), 256)})


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


# ------------------------------------------------------------ 3: line dedup

def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


# -------------------------------------------------------------- 4: sharding

def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, sharding.even_tree(40), sharding.even_tree(41, base=40))


# -------------------------------------------------------------- 5: toxicity

def learned_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = read_table(spark, sf_dir, "labels").where(id_fold("doc_id", 3) != 1)
    return toxicity.fit(docs, labels)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, learned_toxicity(spark, docs, sf_dir), threshold=TOXIC_FROM)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted",
                         F.size("spans").alias("n_spans"))


# --------------------------------------------------------------- 6: SimHash

def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_groups(docs, shingle=SHINGLE, max_bits=MAX_BITS)


# -------------------------------------------------------- 7: near embeddings

def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(read_table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND list_dot_product(a.e, b.e) >= 0.93 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE a = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id)) AS component_id,
       least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id)) = e.vec_id AS kept
FROM embeddings e"""


# --------------------------------------------------------------- 8: quality

def graded(labels: DataFrame) -> DataFrame:
    """0: poor; 1: good but toxic; 2: good."""
    return labels.withColumn("grade", F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(
        F.col("toxic") == 1, 1).otherwise(2)))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = graded(read_table(spark, sf_dir, "labels").where(id_fold("doc_id", 4) != 2))
    out = quality.score(docs, quality.fit(docs, ratings), from_grade=1)
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "expected_grade",
                      F.col("tail_probability").alias("score"), "selected")


# ------------------------------------------------------- 9: decontamination

def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# ------------------------------------------------------------------- 10: PII

def pseudonym_key(spark: SparkSession) -> str:
    """The session's ``spark.fieldlens.pii.key``; without one a fresh key, under
    which values are linked within this result and nowhere else."""
    return spark.conf.get("spark.fieldlens.pii.key", None) or secrets.token_hex(32)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymize(docs, pseudonym_key(spark))
    return out.select("doc_id", "text", F.size("findings").cast("long").alias("n_findings"),
                      F.array_join(F.col("findings.kind"), ",").alias("kinds"))


# --------------------------------------------------------- 11: HTML extraction

def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages).select("page_id", "url", "text", "n_chars", "n_repeated")


# --------------------------------------------- 12: conversation structure

def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the query repairs."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("fate"))
    return rows.where("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def text_digests(turns: DataFrame, id_col: str) -> DataFrame:
    """(id, repaired_sha256) over the lines ``role:text`` of each id by place.
    A task reads the sorted lines as a stream and holds one of them."""
    conv_type = turns.schema[id_col].dataType
    lines = turns.select(F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")).alias("of"), "place",
                         F.concat("role", F.lit(":"), "text").alias("line"))

    def digest(batches):
        import hashlib
        import pyarrow as pa
        of, sha = None, None
        for batch in batches:
            done = []
            for o, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                if o != of:
                    done += [(of, sha.hexdigest())] if sha else []
                    of, sha = o, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(line.as_py().encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names=["of", "repaired_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([of]), pa.array([sha.hexdigest()])], names=["of", "repaired_sha256"])

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = (lines.repartition(parts, "of").sortWithinPartitions("of", "place").select("of", "line")
           .mapInArrow(digest, "of string, repaired_sha256 string"))
    return out.select(F.when(F.col("of") != "", F.substr(F.col("of"), F.lit(2)).cast(conv_type)).alias(id_col), "repaired_sha256")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = convrepair.repair(damaged(turns))
    texts = text_digests(done.turns, "conv_id").withColumnRenamed("conv_id", "of")
    every = turns.select(F.col("conv_id").alias("id")).distinct()
    found = every.join(done.summary, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    out = found.join(texts, F.col("id").eqNullSafe(F.col("of")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP12_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           [unicode(c)::BIGINT FOR c IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')], lambda b: b)),
           lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
             lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS h
  FROM conversations),
fate AS (SELECT *, xor(h, 4294967295) % 20 AS f FROM raw),
dmg AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM fate WHERE f <> 0),
ord AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         regexp_replace(text, '[ 	-
]+$', '') AS bare FROM dmg),
fault AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         left(role, 1) AS init, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ord),
step(p, l, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins AS (
  SELECT p, p AS q, 0 AS k, '' AS lines FROM (SELECT DISTINCT p FROM step)
  UNION ALL
  SELECT ins.p, step.q, k + 1, lines || chr(10) || CASE l WHEN 'u' THEN 'user:' ELSE 'assistant:' END
  FROM ins JOIN step ON step.p = ins.q AND l <> 's' WHERE k < 2),
edit AS (
  SELECT (SELECT list({'p': p, 'q': q, 'c': 5 * k + 2, 'a': repeat('I', k) || 'D', 'lines': lines}) FROM ins) AS dels,
         (SELECT list({'p': ins.p, 'q': step.q, 'c': 5 * k + 1, 'a': repeat('I', k) || 'R',
                       'lines': lines || chr(10) || CASE l WHEN 'u' THEN 'user:' ELSE 'assistant:' END})
          FROM ins JOIN step ON step.p = ins.q AND l <> 's') AS rers,
         (SELECT list({'p': ins.p, 'q': step.q, 'l': l, 'c': 5 * k, 'a': repeat('I', k) || 'K', 'lines': lines || chr(10)})
          FROM ins JOIN step ON step.p = ins.q) AS keeps),
conv(conv_id, i, st) AS (
  SELECT conv_id, 0::BIGINT, [{'c': 0, 'a': '', 'r': ''}, {'c': 1000000000, 'a': '', 'r': ''}, {'c': 1000000000, 'a': '', 'r': ''},
         {'c': 1000000000, 'a': '', 'r': ''}] FROM fault GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, list_transform([0, 1, 2, 3], lambda w: coalesce(list_sort(list_filter(cand, lambda e: e.q = w))[1].v,
         {'c': 1000000000, 'a': '', 'r': ''})) FROM (
    SELECT c.conv_id, f.i, list_concat(
      list_transform(e.dels, lambda x: {'q': x.q, 'v': {'c': c.st[x.p + 1].c + x.c, 'a': c.st[x.p + 1].a || x.a, 'r': c.st[x.p + 1].r || x.lines}}),
      CASE WHEN f.fault IN ('b', 'd') THEN [] ELSE list_concat(
        list_transform(e.rers, lambda x: {'q': x.q, 'v': {'c': c.st[x.p + 1].c + x.c + CASE f.fault WHEN 't' THEN 5 ELSE 0 END,
                       'a': c.st[x.p + 1].a || x.a, 'r': c.st[x.p + 1].r || x.lines || f.text}}),
        list_transform(list_filter(e.keeps, lambda x: x.l = f.init), lambda x: {'q': x.q, 'v': {
                       'c': c.st[x.p + 1].c + x.c + CASE f.fault WHEN 't' THEN 5 ELSE 0 END,
                       'a': c.st[x.p + 1].a || x.a, 'r': c.st[x.p + 1].r || x.lines || f.role || ':' || f.text}})) END) AS cand
    FROM conv c JOIN fault f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.i + 1, edit e)),
fin AS (
  SELECT c.conv_id, list_sort(list({'c': st[p + 1].c + 5 * k, 'a': st[p + 1].a || repeat('I', k), 'r': st[p + 1].r || lines}))[1] AS v
  FROM conv c JOIN (SELECT conv_id, max(i) AS n FROM fault GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM c.conv_id AND n = i, ins
  WHERE ins.q IN (0, 3) GROUP BY c.conv_id),
stat AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i > 1 AND before || init NOT IN ('su', 'ua', 'au')) AS illegal
  FROM fault GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.c, 0)::BIGINT AS cost,
       coalesce(v.a, '') AS audit, sha256(coalesce(substr(v.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stat s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM o.conv_id"""


# ------------------------------------------------- 13: filter interaction

def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filteraudit.audit(docs, read_table(spark, sf_dir, "labels"))


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dwin AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM dwin JOIN win USING (n, g)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""


QUERIES = {
    "op1_langid": op1_langid,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_sharding": op4_sharding,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_pii": op10_pii,
    "op11_html_text": op11_html_text,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}
ORACLE_SQL = {"op3_line_dedup": linededup.oracle(), "op7_embedding_dedup": OP7_SQL, "op9_decontamination": OP9_SQL,
              "op12_conversation_repair": OP12_SQL, "op13_filter_audit": filteraudit.ORACLE}
