"""Queries of this package on the given tables, and their results in DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    bitplanes,
    chat_grammar,
    conversation_repair,
    cross_parse,
    decontaminate,
    exact_dedup,
    importance,
    jaccard_join,
    license_scan,
    nbsvm,
    piece_viterbi,
    setsketch,
    surrogates,
)
from rollcall.llm.common import cut, shared_dir, table

#: Generations that the table of documents is dealt into: two snapshots and one incoming batch.
GENERATIONS = 3


#: Key of the surrogates in the registered query; a real run brings its own.
KEY = b"registered query"


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, KEY)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = exact_dedup.mark(docs, exact_dedup.by_range(docs, GENERATIONS), with_text=False)
    return marked.select("doc_id", "dedup.*")


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op4_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = nbsvm.fold(F.col("doc_id"), 4) == 2
    sample = cross_parse.learn(docs.filter(~held_out))
    return cross_parse.predict(docs.select("doc_id", "text"), sample).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-ids/{uuid.uuid4().hex}"
    bitplanes.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return bitplanes.digests(spark, path)


def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_viterbi.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


#: Score from which a document counts as good.
GOOD = 0.3


def op8_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = nbsvm.fold(F.col("doc_id"), 5) == 0
    model = nbsvm.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return nbsvm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def op9_chat_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    turns = chat_grammar.parse(F.col("formatted"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return (
        chat_grammar.format_conversations(rows)
        .select("conv_id", turns.alias("turns"), F.length("formatted").cast("long").alias("formatted_chars"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(flat, 256).alias("turns_sha256"),
            F.length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss, 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *,
    CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 3 WHEN 'system' THEN 3 ELSE 5 + 2 * strlen(role) END AS tag,
    CASE WHEN regexp_matches(text, '([<\[])(/?(?:s>|INST\]|SYS\]|ANS\]|ROLE:))') OR regexp_matches(text, '(?s)\\.')
      THEN length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(?:s>|INST\]|SYS\]|ANS\]|ROLE:))', '\1\\\2', 'g'))
      ELSE length(text) END AS body
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(body + 2 * tag + 14)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


SHINGLES_SQL = r"""
words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM words
)"""

OP10_SQL = f"""
WITH RECURSIVE {SHINGLES_SQL}, sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.b
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON r.a = d.doc_id
"""

def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


OP1_SQL = f"""
WITH {SHINGLES_SQL}, item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM benchmark
), items AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS s
  FROM item_words WHERE len(w) >= 5
), sizes AS (SELECT item_id, count(*)::INT AS n_item FROM items GROUP BY item_id)
SELECT d.doc_id, i.item_id, z.n_item, count(*)::INT AS n_shared, count(*) / z.n_item AS containment
FROM items i JOIN shingles d ON d.s = i.s JOIN sizes z ON z.item_id = i.item_id
GROUP BY d.doc_id, i.item_id, z.n_item HAVING 4 * count(*) >= 3 * z.n_item
"""

def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    fixed = conversation_repair.repair(conversation_repair.damage(rows))
    edits = cut(fixed.edits)
    found = fixed.facts.join(conversation_repair.digests(edits), "key").drop("key", "n", "first")
    asked = rows.select(F.col("conv_id").alias("asked")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return asked.join(found, F.col("asked").eqNullSafe(F.col("conv")), "left").select(
        F.col("asked").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _least_edits(q: int) -> str:
    """Cheapest first edit before state ``q``, and the rest: (cost, letters, text)."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}[q]
    role = "assistant" if after == 3 else "user"
    keep = lambda v: f"struct_pack(c := v{v}.c + late, l := 'K' || v{v}.l, t := role || ':' || text || chr(10) || v{v}.t)"
    ways = [f"struct_pack(c := v{q}.c + 3, l := 'D' || v{q}.l, t := v{q}.t)"]
    other = f"struct_pack(c := v{after}.c + 2 + late, l := 'R' || v{after}.l, t := '{role}:' || text || chr(10) || v{after}.t)"
    stay = [other, f"CASE WHEN i = '{role[0]}' THEN {keep(after)} END"]
    if q == 0:
        stay.append(f"CASE WHEN i = 's' THEN {keep(1)} END")
    ways += [f"CASE WHEN fault NOT IN (1, 2) THEN {x} END" for x in stay]
    return f"list_min([{', '.join(ways)}])"


def _with_inserts(q: int) -> str:
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    one, two = after[q], after[after[q]]
    name = {2: "user", 3: "assistant"}
    return (
        f"list_min([w{q}, struct_pack(c := w{one}.c + 2, l := 'I' || w{one}.l, t := '{name[one]}:' || chr(10) || w{one}.t),"
        f" struct_pack(c := w{two}.c + 4, l := 'II' || w{two}.l, t := '{name[one]}:' || chr(10) || '{name[two]}:' || chr(10) || w{two}.t)])"
    )


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({0}))),
    lambda i: ('0x' || substr(hex(encode({0})), (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, x: xor(list_extract(crc_table, (xor(c, x) & 255) + 1), c >> 8)), 4294967295)"""
_CRC_TABLE = """bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS crc_table FROM bits WHERE k = 8)"""
_INK = r"[^\x20\x09-\x0D]"
_ENDS = [f"struct_pack(c := {c}::BIGINT, l := '', t := '')" for c in (0, 1000000000, 1000000000, 0)]

#: The dynamic program row after row from the end, with the letters and the text of each state.
OP11_SQL = fr"""
WITH RECURSIVE {_CRC_TABLE}, keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), fates AS (SELECT *, {_CRC32.format("k")} % 20 AS fate FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fates
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS r, left(role, 1) AS i FROM damaged
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{_INK}') THEN 1
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY r) > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
    lag(i) OVER (PARTITION BY conv_id ORDER BY r) AS before FROM placed
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
), ended AS (
  SELECT conv_id, n AS r, {", ".join(f"{x} AS w{q}" for q, x in enumerate(_ENDS))} FROM facts
), steps AS (
  SELECT conv_id, r, {", ".join(f"{_with_inserts(q)} AS v{q}" for q in range(4))} FROM ended
  UNION ALL
  SELECT conv_id, r, {", ".join(f"{_with_inserts(q)} AS v{q}" for q in range(4))} FROM (
    SELECT s.conv_id, s.r - 1 AS r, {", ".join(f"{_least_edits(q)} AS w{q}" for q in range(4))}
    FROM steps s JOIN (SELECT *, (fault = 3)::INT AS late FROM judged) j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.r = s.r
  )
), done AS (SELECT conv_id, v0 FROM steps WHERE r = 0)
SELECT a.conv_id, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
  coalesce(v0.c, 0)::BIGINT AS cost, coalesce(v0.l, '') AS audit,
  sha256(coalesce(left(v0.t, length(v0.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id
"""

#: Share of the documents that is drawn, in percent, and the seed of the noise.
DRAWN, SEED = 25, 7


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), DRAWN, SEED)
    return found.withColumnRenamed("id", "doc_id")


OP12_SQL = fr"""
WITH RECURSIVE {_CRC_TABLE},
texts AS (SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT side, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), runs AS (
  SELECT side, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
), counted AS MATERIALIZED (SELECT side, doc_id, f, count(*) AS n FROM runs GROUP BY side, doc_id, f),
buckets AS MATERIALIZED (SELECT f, {_CRC32.format("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM counted), crc
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM counted JOIN buckets USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000)))) AS gain
  FROM sums
), weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
  FROM counted JOIN buckets USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id
), ranked AS (
  SELECT *, n_features >= 39 AS able, row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id) AS r FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND r <= 25 * (SELECT count(*) FROM ranked WHERE able) // 100 THEN r END AS rank
FROM ranked
"""

def op13_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP13_SQL = (
    OP10_SQL.replace("100 * c >= 75 *", "100 * c >= 85 *")
    .replace("r.component_id\nFROM documents", "r.component_id, d.doc_id = r.component_id AS kept\nFROM documents")
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_surrogates": op2_surrogates,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_cross_parse": op4_cross_parse,
    "op5_license_scan": op5_license_scan,
    "op6_bitplanes": op6_bitplanes,
    "op7_piece_viterbi": op7_piece_viterbi,
    "op8_quality_nbsvm": op8_quality_nbsvm,
    "op9_chat_grammar": op9_chat_grammar,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_importance": op12_importance,
    "op13_setsketch": op13_setsketch,
}

_SQL = {"op1_decontaminate": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op9_chat_grammar": OP9_SQL, "op10_jaccard_join": OP10_SQL, "op11_conversation_repair": OP11_SQL, "op12_importance": OP12_SQL, "op13_setsketch": OP13_SQL}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
