"""The queries of the text operators, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from hearthline.llm.common import documents
from hearthline.llm.conversation_repair import repair_damaged
from hearthline.llm.embedding_dedup import embedding_dedup
from hearthline.llm.fingerprints import edited_likeness
from hearthline.llm.jaccard_join import jaccard_components
from hearthline.llm.kd_shards import kd_shards
from hearthline.llm.language import identify
from hearthline.llm.mixing import mix_sources
from hearthline.llm.packing import pack
from hearthline.llm.pii import digests
from hearthline.llm.secrets import scan_secrets
from hearthline.llm.substring_dedup import substring_dedup
from hearthline.llm.toxicity import toxicity
from hearthline.llm.vector_codes import compress

TEXT_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TEXT_ORACLES: dict[str, str] = {}


PACKING_TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def register(fn):
        TEXT_QUERIES[name] = fn
        if sql is not None:
            TEXT_ORACLES[name] = sql
        return fn
    return register


@query("op4_jaccard_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id
    WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN r ON r.a = d.doc_id GROUP BY d.doc_id""")
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, similarity 0.85."""
    return jaccard_components(documents(spark, folder), n=4, percent=85)


@query("op3_substring_dedup", """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w WHERE len(words) >= 13),
k AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k FROM g),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM k),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM m WHERE least < doc_id GROUP BY doc_id),
c AS (SELECT w.doc_id, words, coalesce(gone, []) AS gone FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id)
SELECT doc_id, len(words) AS n_words, len(gone) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256 FROM c""")
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Remove every 13-word window that also begins in an earlier document, over all documents."""
    return substring_dedup(documents(spark, folder), window=13, texts=False)


@query("op1_pack")
def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers
    return pack(documents(spark, folder), public_tokenizers.path(PACKING_TOKENIZER), length=2048, end=1)


@query("op9_mix_sources")
def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, mixed by source with weights 1, 2, 3."""
    return mix_sources(documents(spark, folder), sources="source").select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op7_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n ON c.vec_id = n.a""")
def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return embedding_dedup(spark.read.parquet(f"{folder}/embeddings.parquet"), least=0.9)


@query("op8_fingerprint")
def op8_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_likeness(documents(spark, folder))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from two thirds of the labels."""
    return toxicity(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op2_scan_secrets")
def op2_scan_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents; a source is an owner, and what it has in a language a repository."""
    docs = documents(spark, folder).withColumn("repository", F.concat_ws("/", F.coalesce("source", F.lit("")), "lang"))
    found = scan_secrets(docs, owner="source", repository="repository")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
                        "n_live", "n_example")


@query("op5_language")
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learned from four fifths of them."""
    return identify(documents(spark, folder))


@query("op6_pii")
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all documents."""
    return digests(documents(spark, folder))


def _vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The rounds one after another, every part measured against every entry."""
    steps = [f"""x AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, k, c[1 + k * len(c) // {parts}:(k + 1) * len(c) // {parts}] AS c
    FROM x, (SELECT unnest(range({parts})) AS k)),
b0 AS MATERIALIZED (SELECT k, e, c FROM (SELECT k, c, row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS e FROM p) WHERE e < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT vec_id, k, e, d FROM (SELECT vec_id, p.k, e,
    list_sum(list_transform(list_zip(p.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN b{r} b ON p.k = b.k)
    QUALIFY row_number() OVER (PARTITION BY vec_id, k ORDER BY d, e) = 1)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT k, e, i, CAST(floor(sum(v)::DOUBLE / count(*)) AS BIGINT) AS v FROM (
    SELECT d.k, e, unnest(c) AS v, unnest(range(len(c))) AS i FROM d{r} d JOIN p ON d.vec_id = p.vec_id AND d.k = p.k) GROUP BY k, e, i),
b{r + 1} AS MATERIALIZED (SELECT b.k, b.e, coalesce(any_value(n.c), b.c) AS c FROM b{r} b LEFT JOIN
    (SELECT k, e, list(v ORDER BY i) AS c FROM s{r} GROUP BY k, e) n ON b.k = n.k AND b.e = n.e GROUP BY b.k, b.e, b.c)""")
    return f"""WITH {", ".join(steps)},
o AS (SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY k) AS code, CAST(sum(d) AS BIGINT) AS error FROM d{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY k, e)) AS h FROM b{rounds})
SELECT o.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM o JOIN x ON o.vec_id = x.vec_id, h"""


@query("op11_vector_codes", _vector_codes_sql())
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings as 16 codes of 64 entries, after two rounds."""
    return compress(spark.read.parquet(f"{folder}/embeddings.parquet"), parts=16, entries=64, rounds=2)


def _crc32_steps() -> list[int]:
    """What each byte adds: the remainder of dividing by the reflected polynomial, bit after bit."""
    out = list(range(256))
    for _ in range(8):
        out = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in out]
    return out


# of a text as hexadecimal digits
_CRC32_SQL = f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, len({{0}}), 2),
  lambda i: CAST('0x' || {{0}}[i + 1:i + 2] AS BIGINT))), lambda c, b: xor(c >> 8, {_crc32_steps()}[1 + (xor(c, b) & 255)])))"""


def _repair_sql() -> str:
    """Row after row from the last one back: for each state of the grammar the least (cost, audit) and its text."""
    nothing = "{'c': 9999999, 'a': '', 't': ''}"
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def arc(to: str, cost: str, letter: str, text: str) -> str:
        return f"{{'c': {to}.c + {cost}, 'a': '{letter}' || {to}.a, 't': {text}}}"

    def row(s: int) -> str:
        own = [arc(f"r.s{s}", "4", "D", f"r.s{s}.t")]
        for initial, to in after[s].items():
            line = "chr(10) || n.role || ':' || n.text || "
            own.append(f"CASE WHEN NOT n.gone AND n.role[1] = '{initial}' THEN {arc(f'r.s{to}', '3 * n.cut', 'K', line + f'r.s{to}.t')} ELSE {nothing} END")
            if initial in "ua":
                line = f"chr(10) || '{'user' if initial == 'u' else 'assistant'}:' || n.text || "
                own.append(f"CASE WHEN NOT n.gone THEN {arc(f'r.s{to}', '3 + 3 * n.cut', 'R', line + f'r.s{to}.t')} ELSE {nothing} END")
        return f"list_min([{', '.join(own)}]) AS s{s}"

    def insert(s: int) -> str:
        to = after[s].get("u", 3)
        line = f"chr(10) || '{'user:' if to == 2 else 'assistant:'}' || s{to}.t"
        return f"list_min([s{s}, {arc(f's{to}', '3', 'I', line)}]) AS s{s}"
    states = range(4)
    level = f"SELECT conv_id, i, {', '.join(row(s) for s in states)} FROM r JOIN n ON n.conv_id = r.conv_id AND n.i = r.i - 1"
    level = level.replace("SELECT conv_id, i,", "SELECT n.conv_id, n.i,")
    for _ in range(2):
        level = f"SELECT conv_id, i, {', '.join(insert(s) for s in states)} FROM ({level})"
    end = ", ".join(f"{{'c': {c}, 'a': '{a}', 't': '{t}'}} AS s{s}" for s, (c, a, t) in enumerate(
        [(0, "", ""), (6, "II", "\nuser:\nassistant:"), (3, "I", "\nassistant:"), (0, "", "")]))
    solid = "[^\\x20\\x09-\\x0D]"
    return f"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations),
f AS (SELECT conv_id, turn, role, text, {_CRC32_SQL.format("h")} % 20 AS fate FROM k),
w AS (SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN ''
    WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM f WHERE fate <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) AS i FROM w),
m AS (SELECT *, NOT regexp_matches(text, '{solid}') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
n AS MATERIALIZED (SELECT conv_id, i, role, text, turn, blank, NOT blank AND again AS duplicate, blank OR again AS gone,
    CASE WHEN open AND NOT blank AND NOT again THEN 1 ELSE 0 END AS cut, coalesce(pair NOT IN ('su', 'ua', 'au'), false) AS illegal FROM m),
r AS (SELECT conv_id, max(i) + 1 AS i, {end} FROM n GROUP BY conv_id UNION ALL {level}),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, sum(cut) AS truncated, count(*) FILTER (illegal) AS illegal FROM n GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost,
  coalesce(s0.a, '') AS audit, sha256(coalesce(s0.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN (SELECT * FROM r WHERE i = 1) r ON c.conv_id IS NOT DISTINCT FROM r.conv_id"""


@query("op12_conversation_repair", _repair_sql())
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations damaged by a checksum and repaired at least cost."""
    return repair_damaged(spark.read.parquet(f"{folder}/conversations.parquet"))


def _shards_sql(leaves: int = 8) -> str:
    """A level of the tree after another; a node is split where its widest dimension's running sum of sizes passes the half."""
    dims = ("d_size", "d_place", "d_source", "d_lang")
    steps = [f"""h AS (SELECT doc_id, source, lang, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) + 1 AS size FROM documents),
n0 AS MATERIALIZED (SELECT doc_id, size, {_CRC32_SQL.format("h")} AS text_crc32, size AS d_size,
    row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS d_place, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS d_source,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS d_lang, 0 AS node FROM h),
a AS (SELECT {", ".join(f"max({d}) - min({d}) AS {d}" for d in dims)} FROM n0)"""]
    level = leaves
    for r in range(leaves.bit_length() - 1):
        wide = ", ".join(f"CASE WHEN a.{d} = 0 THEN 0 ELSE (max(n.{d}) - min(n.{d}))::DOUBLE / a.{d} END" for d in dims)
        values = " ".join(f"WHEN {k + 1} THEN {d}" for k, d in enumerate(dims))
        group = ", ".join(f"a.{d}" for d in dims)
        steps.append(f"""w{r} AS (SELECT node, sum(size) AS total, [{wide}] AS w FROM n{r} n, a GROUP BY node, {group}),
c{r} AS (SELECT n.*, total, sum(size) OVER (PARTITION BY n.node ORDER BY CASE list_position(w, list_max(w)) {values} END, d_place
    ROWS UNBOUNDED PRECEDING) AS upto FROM n{r} n JOIN w{r} w ON n.node = w.node),
n{r + 1} AS MATERIALIZED (SELECT doc_id, size, text_crc32, {", ".join(dims)},
    CASE WHEN 2 * upto - size <= total THEN node ELSE node + {level // 2} END AS node FROM c{r})""")
        level //= 2
    return f"""WITH {", ".join(steps)} SELECT doc_id, size, text_crc32, 'bytes' AS law, node AS shard,
  row_number() OVER (PARTITION BY node ORDER BY d_place) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM n{leaves.bit_length() - 1}"""


@query("op13_kd_shards", _shards_sql())
def op13_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    return kd_shards(documents(spark, folder), shards=8)


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
