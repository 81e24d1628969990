"""The registered query of each operator, with its SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm import (
    best_fit,
    chat_format,
    conversation_repair,
    embedding_dedup,
    fingerprints,
    language,
    line_dedup,
    near_dedup,
    packed_output,
    sampled_pieces,
    secrets,
    token_counts,
    whitening,
)
from betaloom.llm.places import named, ordered_sha256, unnamed
from betaloom.tables import checkpoint_root, materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sampled_pieces.encode(table(spark, sf_dir, "documents"), digests=True)
    return found.select(F.col("key").cast("long").alias("doc_id"), "n_pieces", "ids_crc32", "lossless")


@query
def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [kind for kind, *_ in secrets.BASE]
    spans = F.col("spans")

    def listed(of):
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(listed(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), width=3, share=(85, 100))


SQL["op6_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM words
), flat AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b USING (shingle) WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"))


SQL["op7_line_dedup"] = """
WITH split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents
), counted AS (
    SELECT doc_id, i, trim(line) AS line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos
    FROM split WHERE trim(line) <> ''
), triples AS (
    SELECT doc_id, pos, [line, lead(line) OVER w, lead(line, 2) OVER w] AS key, lead(line, 2) OVER w AS third
    FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), placed AS (
    SELECT doc_id, pos, first_value(doc_id) OVER w AS first_doc, first_value(pos) OVER w AS first_pos
    FROM triples WHERE third IS NOT NULL WINDOW w AS (PARTITION BY key ORDER BY doc_id, pos)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = first_doc THEN greatest(pos, first_pos + 3) ELSE pos END, pos + 3)) AS pos
    FROM placed WHERE doc_id <> first_doc OR pos <> first_pos
), marked AS (
    SELECT s.doc_id, s.i, s.line, c.pos IS NOT NULL AS counts, g.pos IS NOT NULL AS gone
    FROM split s LEFT JOIN counted c USING (doc_id, i) LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.pos = c.pos
), built AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS text,
        count(*) FILTER (counts) AS n_lines, count(*) FILTER (gone) AS n_removed
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(b.text, '') END AS text,
    coalesce(b.n_lines, 0) AS n_lines, coalesce(b.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN built b USING (doc_id)
"""


@query
def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written matrices, each row as checksums of its ids and positions, with its segments."""
    rows = materialize(packed_output.packed_rows(table(spark, sf_dir, "documents")), "packed-ids")
    return rows.select(
        F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"), "n_ids", "cu_seqlens", "segments"
    )


@query
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.links(table(spark, sf_dir, "embeddings"))


SQL["op9_embedding_near_dedup"] = """
WITH RECURSIVE sound AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b USING (label)
    WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degrees AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN degrees USING (vec_id)
"""


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as flat token files, then the tokens of each document from the files alone."""
    path = f"{checkpoint_root(spark)}/betaloom/tokens-{uuid.uuid4().hex}"
    token_counts.write_token_files(table(spark, sf_dir, "documents"), path)
    found = token_counts.counted(spark, path)
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    return found.select(number.alias("file_number"), "ordinal", "n_tokens")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversation_repair.repaired(conversation_repair.damaged(rows))
    text = F.concat("role", F.lit(":"), "text")
    digests = ordered_sha256(found.turns, "conv", ["start", "position"], text, "\n").withColumnRenamed("key", "conv")
    every = rows.select("conv_id", named("conv_id").alias("conv")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found.report.drop("conv_id"), "conv", "left").join(digests, "conv", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


SQL["op11_conversation_repair"] = r"""
WITH RECURSIVE tables AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes
    FROM conversations
), drawn AS (
    SELECT * EXCLUDE (bytes, crc),
        xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS draw
    FROM named, tables
), damaged AS (
    SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
        CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE draw WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM drawn WHERE draw <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS seq FROM damaged
), seen AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY seq) > 1 AS again,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY seq) || left(role, 1) AS pair
    FROM ordered
), faults AS (
    SELECT conv_id, turn, role, text, seq, left(role, 1) AS initial, pair NOT IN ('su', 'ua', 'au') AS illegal,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
    FROM seen
), inserts AS (
    SELECT s, 0 AS m, s AS t, '' AS letters, []::VARCHAR[] AS pieces FROM (VALUES (0), (1), (2), (3)) v(s)
    UNION ALL
    SELECT s, m + 1, CASE t WHEN 2 THEN 3 ELSE 2 END, letters || 'I', list_append(pieces, CASE t WHEN 2 THEN 'assistant:' ELSE 'user:' END)
    FROM inserts WHERE m < 3
), best AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {'c': 0, 'a': '', 'o': []::VARCHAR[]} AS v FROM faults
    UNION ALL
    SELECT conv_id, i, s, min(v) FROM (
        SELECT b.conv_id, b.i + 1 AS i,
            CASE WHEN letter = 'D' THEN t WHEN t = 2 THEN 3 WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 2 END AS s,
            {'c': (b.v.c + 5 * m + CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END)::INTEGER,
             'a': b.v.a || letters || letter,
             'o': list_concat(list_concat(b.v.o, pieces), CASE letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
                ELSE [CASE t WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END)} AS v
        FROM best b JOIN inserts n ON n.s = b.s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.seq = b.i + 1, (VALUES ('D'), ('K'), ('R')) e(letter)
        WHERE letter = 'D' OR (fault NOT IN ('blank', 'duplicate')
            AND (letter = 'R' OR (initial = 's' AND t = 0) OR (initial = 'u' AND t <> 2) OR (initial = 'a' AND t = 2)))
    ) GROUP BY conv_id, i, s
), sizes AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM faults GROUP BY conv_id
), done AS (
    SELECT b.conv_id, min({'c': b.v.c + 5 * m, 'a': b.v.a || letters, 'o': list_concat(b.v.o, pieces)}) AS v
    FROM best b JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM b.conv_id AND z.n = b.i JOIN inserts n ON n.s = b.s WHERE n.t IN (0, 3) GROUP BY b.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(v.c, 0)::BIGINT AS cost, coalesce(v.a, '') AS audit,
    sha256(coalesce(array_to_string(v.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's control strings, formatted, written, and read back."""
    rows = table(spark, sf_dir, "conversations")
    text = F.lit("\\### Assistant: </turn> ok").alias("text")
    ends = [spark.range(1).select(F.lit(-7).alias("conv_id"), F.lit(turn).alias("turn"), F.lit(role).alias("role"), text) for turn, role in enumerate(("user", "assistant"))]
    for end in ends:
        rows = rows.select("conv_id", "turn", "role", "text").unionByName(end)
    parts = materialize(chat_format.conversations(chat_format.as_replies(rows)), "formatted")
    found = chat_format.read_back(parts)
    kind = rows.schema["conv_id"].dataType.simpleString()
    digests = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return found.select(unnamed("conv", kind).alias("conv_id"), *digests)


SQL["op13_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), written AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
        length(regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g')) + length(replace(replace(role, '\', '\\'), chr(10), '\n')) + 15 AS size
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""
