"""The queries opN_* and their SQL; each derives its columns from its operator's output."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, hilbert_search, jaccard_join, lm_scoring, packing, piece_codec, prefix_trie,
    quality_rules, records, secret_scan, toxicity, turn_repair, warc,
)
from .store import map_batches, read_table, scratch_folder, staged


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(read_table(spark, sf_dir, "documents"), size=3, percent=90)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what is labelled as good and not toxic."""
    good = read_table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return lm_scoring.score(read_table(spark, sf_dir, "documents"), good)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_codec.encode_and_decode(read_table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    number = {k.name: i for i, k in enumerate(secret_scan.KINDS)}
    of_kind = lambda name: F.size(F.filter("spans", lambda x: x["number"] == number[name]))
    base = F.filter("spans", lambda x: x["number"] < number["owned"])
    judged = lambda word: F.size(F.filter("spans", lambda x: x["verdict"] == word))
    return found.select(
        "doc_id",
        *(of_kind(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
        judged("live").cast("long").alias("n_live"),
        judged("example").cast("long").alias("n_example"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.score(docs, toxicity.fit(docs, labels)).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write_records(
        read_table(spark, sf_dir, "documents"), scratch_folder(spark, "records")
    )
    return records.read_records(spark, manifest).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return hilbert_search.search(vectors, F.col("vec_id") % 50 == 0)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], chats.schema)
    return chat.read_back(chat.format_chats(chats.union(added)))


def damaged(chats: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of conv_id and turn; nulls are one space."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return (
        chats.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), code.alias("code"))
        .where("code <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("code") == 1, "").when(
                F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("col")
    )


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of ``role:text`` lines, fed turn by turn; turns come in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, sha = [], None, None
        for batch in batches:
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if sha is None or conv_id != current:
                    if sha is not None:
                        done.append((current, sha.hexdigest()))
                    current, sha = conv_id, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in done], schema)
            done = []
        if sha is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (current, sha.hexdigest())))], schema)

    return map_batches(turns.select("conv_id", "role", "text"), run, "conv_id LONG, repaired_sha256 STRING")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read_table(spark, sf_dir, "conversations"))


def repair_damaged(chats: DataFrame) -> DataFrame:
    faulty = damaged(chats)
    plans = staged(turn_repair.plan_edits(faulty), "plans")
    repaired = turn_digests(turn_repair.repaired_turns(faulty, plans))
    same = lambda one, two: one["conv_id"].eqNullSafe(two["conv_id"])
    every = chats.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        every.join(plans, same(every, plans), "left").join(repaired, same(every, repaired), "left")
        .select(
            every["conv_id"], *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_of(read_table(spark, sf_dir, "conversations"))


def trie_of(chats: DataFrame, band: int = 16) -> DataFrame:
    members, turns = prefix_trie.shared_prefixes(prefix_trie.turns_of(chats))
    return prefix_trie.build_trie(members, turns, band)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(read_table(spark, sf_dir, "pages"))


def archived(pages: DataFrame, **options) -> DataFrame:
    spark = pages.sparkSession
    manifest = warc.write_archives(pages, scratch_folder(spark, "warc"), **options)
    return warc.read_archives(spark, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op6_secrets": _op6_sql(), "op10_chat": OP10_SQL, "op11_turn_repair": OP11_SQL,
            "op12_prefix_trie": OP12_SQL, "op13_warc": OP13_SQL}


def _op6_sql() -> str:
    """The scan in DuckDB: places by the lengths of what stands between matches."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    kinds = " UNION ALL ".join(f"""
      SELECT doc_id, owner, {i} AS number, '{k.name}' AS kind, {k.least} AS least,
        string_split_regex(t, {quoted(k.pattern)}) AS gaps,
        regexp_extract_all(t, {quoted(k.pattern)}) AS matches,
        regexp_extract_all(t, {quoted(k.pattern)}, {k.group}) AS found
      FROM texts""" for i, k in enumerate(secret_scan.KINDS))
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
    raw AS ({kinds}),
    places AS (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM raw),
    spans AS (
      SELECT doc_id, owner, number, kind, found[i] AS value,
        list_sum(list_transform(gaps[1:i], lambda x: length(x)))::BIGINT
          + coalesce(list_sum(list_transform(matches[1:i-1], lambda x: length(x))), 0)::BIGINT AS a,
        length(matches[i]) AS size
      FROM places WHERE length(found[i]) >= least),
    looks AS (SELECT *, a + size AS z,
        length(regexp_replace(value, '[^0-9]', '', 'g')) >= 3
        AND length(regexp_replace(value, '[^A-Za-z]', '', 'g')) >= 3
        AND len(list_distinct(string_split(value, ''))) >= 8 AS mixed FROM spans),
    kept AS (SELECT * FROM looks s WHERE number < 3 OR mixed AND NOT EXISTS (
        SELECT 1 FROM spans b WHERE b.doc_id = s.doc_id AND b.number < 3
          AND b.a < s.z AND s.a < b.a + b.size)),
    owners AS (SELECT value, count(DISTINCT owner) AS n FROM kept GROUP BY value),
    judged AS (SELECT k.*, CASE WHEN n >= 3 THEN 'example' WHEN mixed THEN 'live' ELSE 'weak' END AS verdict
      FROM kept k JOIN owners USING (value)),
    final AS (SELECT * FROM judged WHERE number < 3 OR verdict = 'live')
    SELECT d.doc_id,
      count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access,
      count(*) FILTER (number = 2) AS n_hex,
      sha256(coalesce(string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, number)
        FILTER (number < 3), '')) AS base_sha256,
      coalesce(string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, number), '') AS spans,
      count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
    FROM documents d LEFT JOIN final f ON d.doc_id = f.doc_id GROUP BY d.doc_id
    """


#: The segments' marks take 10 + 8 characters for a user, 0 + 4 for an assistant, 18 + 21 for a
#: system turn; in texts, escape characters and control strings take one more each.
OP10_SQL = r"""
WITH chats AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prior,
    length(text) + (length(text) - length(replace(text, chr(92), '')))
      + len(regexp_extract_all(text, '</?s>|\[/?INST\]|<</?SYS>>'))
      + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 4 ELSE 39 END AS formatted
  FROM chats
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(formatted)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN prior IS NULL THEN role IN ('system', 'user')
    WHEN prior = 'user' THEN role = 'assistant' ELSE role = 'user' END) AS valid
FROM turns GROUP BY conv_id
"""


#: crc32 of short ASCII texts: the table of its 256 steps, and the checksum of ``{key}``.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i))"""
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT],
    list_transform(string_split({key}, ''), lambda x: ascii(x)::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(1 + (xor(c, b) & 255))::BIGINT])), 4294967295)"""

#: The repair as a table of costs and audits, turn by turn: t0 to t3 after a turn, then s0 to
#: s3 with what may be inserted behind it.
OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format(key="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code
  FROM conversations, crc_table),
faulty AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE code WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE code <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS kept FROM faulty),
judged AS (SELECT *, kept = '' AS blank,
    kept <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM numbered),
signs AS (SELECT *, blank OR twice AS gone, role[1] AS initial,
    CASE WHEN kept[-1] IN ('.', '!', '?') THEN 0 ELSE 3 END AS more FROM judged),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 1000000, 'a': ''}} AS s1,
    {{'c': 3, 'a': 'I'}} AS s2, {{'c': 6, 'a': 'II'}} AS s3 FROM (SELECT DISTINCT conv_id FROM signs)
  UNION ALL
  SELECT conv_id, i, t0, t1, u2, list_min([t3, {{'c': u2.c + 3, 'a': u2.a || 'I'}}]) FROM (
    SELECT *, list_min([t2, {{'c': t0.c + 3, 'a': t0.a || 'I'}}, {{'c': t1.c + 3, 'a': t1.a || 'I'}},
        {{'c': t3.c + 3, 'a': t3.a || 'I'}}]) AS u2 FROM (
      SELECT g.conv_id, g.i,
        {{'c': s0.c + 4, 'a': s0.a || 'D'}} AS t0,
        list_min([{{'c': s1.c + 4, 'a': s1.a || 'D'}},
          {{'c': s0.c + more + CASE WHEN gone OR initial <> 's' THEN 1000000 ELSE 0 END, 'a': s0.a || 'K'}}]) AS t1,
        list_min(list_concat([{{'c': s2.c + 4, 'a': s2.a || 'D'}}], list_concat(
          list_transform([s0, s1, s3], lambda s: {{'c': s.c + more
            + CASE WHEN gone OR initial <> 'u' THEN 1000000 ELSE 0 END, 'a': s.a || 'K'}}),
          list_transform([s0, s1, s3], lambda s: {{'c': s.c + more + 3
            + CASE WHEN gone THEN 1000000 ELSE 0 END, 'a': s.a || 'R'}})))) AS t2,
        list_min([{{'c': s3.c + 4, 'a': s3.a || 'D'}},
          {{'c': s2.c + more + CASE WHEN gone OR initial <> 'a' THEN 1000000 ELSE 0 END, 'a': s2.a || 'K'}},
          {{'c': s2.c + more + 3 + CASE WHEN gone THEN 1000000 ELSE 0 END, 'a': s2.a || 'R'}}]) AS t3
      FROM walk w JOIN signs g ON g.conv_id = w.conv_id AND g.i = w.i + 1))),
best AS (SELECT conv_id, list_min([s0, s3]) AS b FROM walk
  WHERE (conv_id, i) IN (SELECT conv_id, max(i) FROM signs GROUP BY conv_id)),
letters AS (SELECT conv_id, unnest(string_split(b.a, '')) AS letter, unnest(range(1, length(b.a) + 1)) AS k
  FROM best WHERE b.a <> ''),
places AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS j FROM letters),
turned AS (SELECT p.*, g.role, g.text,
    max(CASE WHEN j = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS ahead
  FROM places p LEFT JOIN signs g ON p.conv_id = g.conv_id AND p.i = g.i AND letter <> 'I' WHERE letter <> 'D'),
repaired AS (SELECT conv_id, sha256(string_agg(CASE letter WHEN 'K' THEN role
      ELSE CASE (j - ahead) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END || ':' || coalesce(text, ''),
      chr(10) ORDER BY j)) AS sha FROM turned GROUP BY conv_id),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (twice) AS duplicate,
    count(*) FILTER (NOT gone AND more = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM signs GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sums USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""

OP12_SQL = f"""
WITH {_CRC_TABLE},
placed AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC.format(key="conv_id::VARCHAR")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM placed), crc_table),
joined AS (
  SELECT ids.conv_id, 0 AS own, p, role, text FROM ids JOIN placed b ON b.conv_id = base AND p <= h
  UNION ALL SELECT ids.conv_id, 1, p, role, text FROM ids JOIN placed USING (conv_id) WHERE p > h),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS depth FROM joined),
whole AS (SELECT i.conv_id, coalesce(list([role, text] ORDER BY depth) FILTER (depth IS NOT NULL), []) AS said
  FROM ids i LEFT JOIN turns USING (conv_id) GROUP BY i.conv_id),
steps AS (SELECT conv_id, len(said) AS n, unnest(range(len(said) + 1)) AS depth, said FROM whole),
paths AS (SELECT conv_id, n, depth, md5(said[:depth]::VARCHAR || said[:depth]::JSON::VARCHAR) AS node,
    CASE WHEN depth > 0 THEN md5(said[:depth - 1]::VARCHAR || said[:depth - 1]::JSON::VARCHAR) END AS parent,
    CASE WHEN depth > 0 THEN length(said[depth][2]) ELSE 0 END AS chars FROM steps),
nodes AS (SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, node),
counted AS (SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.parent = n.node) AS n_children
  FROM nodes n),
sums AS (SELECT a.depth, a.node, count(*) FILTER (c.n_children = 0) AS n_leaves, sum(c.saved) AS saved_tokens
  FROM counted c JOIN paths a ON a.conv_id = c.conv_id AND a.depth <= c.depth GROUP BY a.depth, a.node)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums USING (depth, node)
LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.node = c.parent
"""

OP13_SQL = """
WITH digests AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size,
    sha1(coalesce(html, '')) AS hex, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
SELECT page_id, size::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + i * 5 // 4, 2))::INT >> (3 - i * 5 % 4)::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digests
"""
