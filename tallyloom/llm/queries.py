"""The registered queries of the operators in this folder, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    bpe, chat, decontaminate, exact_dedup, jaccard_join, language, lloyd, packing, pii, quality, repair, substring, toxicity,
)
from tallyloom.llm.common import id_remainder, text_of
from tallyloom.sources.tables import table

CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text").withColumn("held_out", id_remainder(5) == 0)
    model = toxicity.fit_toxicity(docs.where("NOT held_out"), table(spark, sf, "labels").where(id_remainder(5) != 0))
    tagged = toxicity.tag_toxic(docs, model, keep=["doc_id", "held_out"])
    return tagged.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text").withColumn("held_out", id_remainder(5) == 0)
    model = quality.fit_quality(docs.where("NOT held_out"), table(spark, sf, "labels").where(id_remainder(5) != 0))
    scored = quality.score_quality(docs, model, keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf, "documents"))


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(text_of(), 256))
    return exact_dedup.mark_copies(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf, "documents"))


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit_pii(docs), keep=["doc_id"])
    base = F.filter("pii", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").withColumn("held_out", id_remainder(4) == 2)
    model = language.fit_language(docs.where("NOT held_out"))
    return language.identify(docs, model, keep=["doc_id", "held_out"])


def op9_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast("long").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"),
    )
    nodes = chat.turns_as_trees(rows.unionByName(added))
    shown = chat.format_paths(nodes, branches=1)
    turns = chat.read_turns(F.col("formatted"))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chat.read_loss(F.col("formatted"), F.col("loss"))
    return shown.select(
        F.col("tree").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    files = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    return packing.pack(table(spark, sf, "documents"), *files, public_tokenizers.PATTERN)


def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes, books = lloyd.compress(table(spark, sf, "embeddings"), "embedding", "vec_id", keep=["vec_id", "label"])
    summed = lloyd.with_group_error(codes, "label", "label_error")
    shown = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return summed.select("vec_id", shown.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, bpe.fit_lexicon(docs, path), keep=["doc_id"])
    told = bpe.decode(coded, path, keep=["doc_id", "ids"])
    return told.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _damaged(rows: DataFrame) -> DataFrame:
    """One of twenty rows each dropped, emptied, without its sentence ends, repeated, or said by the user."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    damaged = _damaged(rows)
    found = rows.select("conv_id").distinct()
    for part in (repair.gaps(damaged), repair.digests(repair.repair(damaged))):
        part = part.withColumnRenamed("conv_id", "of")
        found = found.join(part, found["conv_id"].eqNullSafe(part["of"]), "left").drop("of")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def queries() -> dict:
    found = {q.__name__: q for q in (
        op1_decontaminate, op2_toxicity, op3_quality, op4_jaccard_join, op5_exact_dedup, op6_substring_dedup, op7_pii, op8_language,
        op9_chat_format, op10_packing, op11_vector_codes, op12_bpe, op13_conversation_repair,
    )}
    return found | {"pipeline": corpus_pipeline.run}


_OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 75 * (p.n + q.n - common)),
reach AS (SELECT x AS doc_id, x AS y FROM (SELECT DISTINCT x FROM links) UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.y),
least AS (SELECT doc_id, min(y) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(least.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)"""

_OP5 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""

_OP9 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')) v),
r AS (
  SELECT *, replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\n') AS shown_role,
         replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS shown FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('{chat.START}') + length(shown_role) + 1 + length(shown) + {len(chat.END)}) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""


def _op11(rounds: int = lloyd.ROUNDS) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (
  SELECT rid, p, e, CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) AS d
  FROM parts JOIN c{i} USING (p)),
a{i} AS MATERIALIZED (SELECT rid, p, arg_min(e, {{'d': d, 'e': e}}) AS e, min(d) AS d FROM d{i} GROUP BY rid, p)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT p, e, list(m ORDER BY i) AS m FROM (
    SELECT p, e, i, floor(sum(x[i]) / count(*)) AS m FROM parts JOIN a{i} USING (rid, p), range(1, len(x) + 1) r(i) GROUP BY p, e, i) s
  GROUP BY p, e),
c{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM c{i} LEFT JOIN m{i} USING (p, e))""")
    return f"""
WITH base AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {lloyd.SCALE})) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rid FROM base),
parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // {lloyd.PARTS}) + 1:(p + 1) * (len(v) // {lloyd.PARTS})] AS x FROM numbered, range({lloyd.PARTS}) r(p)),
c0 AS (SELECT p, rid - 1 AS e, x AS c FROM parts WHERE rid <= {lloyd.ENTRIES}),
{", ".join(steps)},
told AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS books
  FROM (SELECT p, e, i, c[i] AS y FROM c{rounds}, range(1, len(c) + 1) r(i)) s),
coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, books AS codebooks_sha256
FROM numbered JOIN coded USING (rid), told"""


_STATES = ("s0", "s1", "s2", "s3")


def _edited(state: str, cost: str, letter: str, line: str = "") -> str:
    """A state after one more edit; ``line`` is what it leaves of the repaired text."""
    lines = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
    return f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'lines': {lines}}}"


def _least(*found: str) -> str:
    return f"list_sort([{', '.join(found)}])[1]"


def _op13() -> str:
    insert = repair.COST[repair.INSERT]
    users = [_edited(s, str(insert), "I", "'user:'") for s in ("s0", "s1", "s3")]
    helpers = _edited("s2", str(insert), "I", "'assistant:'")

    def closed(rows: str) -> str:
        """The states with rows put in where that makes one cheaper."""
        users_in = f"SELECT conv_id, n, s0, s1, {_least('s2', *users)} AS s2, s3 FROM ({rows}) a"
        return f"SELECT conv_id, n, s0, s1, s2, {_least('s3', helpers)} AS s3 FROM ({users_in}) b"

    never = "{'cost': CAST(1000000000 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}"
    keep, rerole = "more", f"more + {repair.COST[repair.REROLE]}"

    def became(target: int, initial: str, role: str, sources: tuple[str, ...]) -> str:
        ways = [_edited(f"s{target}", str(repair.COST[repair.DELETE]), "D")]
        ways += [_edited(s, f"(CASE WHEN initial = '{initial}' THEN {keep} ELSE 1000000000 END)", "K", "line") for s in sources]
        ways += [_edited(s, f"({rerole})", "R", f"'{role}:' || text") for s in sources if role]
        return f"{_least(*ways)} AS s{target}"

    step = "SELECT v.conv_id, r.n, " + ", ".join([
        became(0, "", "", ()), became(1, "s", "", ("s0",)), became(2, "u", "user", ("s0", "s1", "s3")), became(3, "a", "assistant", ("s2",)),
    ]) + " FROM v JOIN steps r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.n = v.n + 1"
    blanks = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    return f"""
WITH RECURSIVE crc AS (
  SELECT [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) FOR n IN range(256)] AS t),
told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    [CAST(ord(x) AS BIGINT) FOR x IN string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), '')] AS k
  FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], k), lambda c, b: xor(t[CAST(xor(c, b) % 256 AS INTEGER) + 1], c // 256)), 4294967295) % 20 AS h
  FROM told, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR h = 3 WHERE h <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, rtrim(text, {blanks}) AS bare
  FROM damaged),
faulted AS (
  SELECT conv_id, n, turn, role, text, left(role, 1) AS initial, role || ':' || text AS line,
    CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY n), 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
  FROM ordered),
steps AS (
  SELECT *, CAST(CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN {repair.TRUNCATED_COST} ELSE 0 END AS BIGINT) AS more
  FROM faulted),
v AS (
  SELECT * FROM ({closed(f"SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM conversations")}) start
  UNION ALL SELECT * FROM ({closed(step)}) next),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faulted GROUP BY conv_id),
ends AS (
  SELECT v.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
    coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, {_least("s0", "s3")} AS best
  FROM v LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id WHERE v.n = coalesce(c.n, 0))
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
  sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ends"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_jaccard_join": _OP4, "op5_exact_dedup": _OP5, "op9_chat_format": _OP9,
        "op11_vector_codes": _op11(), "op13_conversation_repair": _op13(),
    }
