"""The operators of this subpackage applied to their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import find_duplicates
from .language_id import predict_language
from .language_model import score_texts
from .line_dedup import drop_repeated_lines
from .mixing import sample_copies
from .near_dedup import near_duplicates
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .quality import score_quality
from .structure_repair import damaged, repair_report
from .token_counts import count_tokens
from .topk import quantised, top_k
from .toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", quantised("embedding").alias("vector"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op2_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _labels(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").select("doc_id", F.col(name).alias("label"))


def op4_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _labels(spark, sf_dir, "quality"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_duplicates(_table(spark, sf_dir, "documents"))


def op6_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = sample_copies(_table(spark, sf_dir, "documents"), ["doc_id"])
    return drawn.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op7_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op8_bitmask_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(_table(spark, sf_dir, "documents"))


def op9_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _labels(spark, sf_dir, "toxic"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair_report(conversations, damaged(conversations))


QUERIES = {
    f.__name__: f
    for f in (
        op1_norm_bucket_topk,
        op2_probminhash_dedup,
        op3_best_fit_packing,
        op4_attention_quality,
        op5_exact_dedup,
        op6_systematic_mixing,
        op7_recurrent_lm,
        op8_bitmask_language,
        op9_chain_toxicity,
        op10_token_counts,
        op11_prefix_trie,
        op12_line_dedup,
        op13_structure_repair,
    )
}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda r, k:
            CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END)), 4294967295::BIGINT)"""


_SYMBOL = "md5(length(role) || ':' || role || length(text) || ':' || text)"

ORACLES = {
    "op1_norm_bucket_topk": """
        WITH usable AS (
            SELECT e.vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings e
            WHERE e.vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM usable q, usable c
            WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op5_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_FOLDED} AS x FROM documents)
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(x) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY x)
    """,
    "op6_systematic_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, '')) AS h
            FROM documents
        ), per AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::INT + 1] AS w
            FROM sized GROUP BY source
        ), running AS (
            SELECT *, 2 * source_size AS ceiling, 2 * source_size / w AS ratio,
                   (sum(source_size) OVER ()) * 1.5::DOUBLE AS wanted,
                   sum(2 * source_size) OVER up_to AS closed,
                   (sum(w) OVER ()) - (sum(w) OVER up_to) AS open
            FROM per
            WINDOW up_to AS (ORDER BY 2 * source_size / w, source ASC NULLS LAST
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        ), level AS (
            SELECT coalesce(max(closed) FILTER (closed + ratio * open <= wanted), 0)::DOUBLE AS closed,
                   coalesce(min(open) FILTER (closed + ratio * open <= wanted), sum(w))::DOUBLE AS open,
                   max(wanted) AS wanted
            FROM running
        ), targets AS (
            SELECT r.source, source_size,
                   CASE WHEN l.open > 0 THEN least(ceiling::DOUBLE, (l.wanted - l.closed) / l.open * w)
                        ELSE ceiling::DOUBLE END AS target,
                   ('0x' || substr(md5('mix' || coalesce(r.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
            FROM running r, level l
        ), placed AS (
            SELECT doc_id, size, source_size, target, u,
                   CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                   row_number() OVER (PARTITION BY s.source ORDER BY size, h, doc_id) AS place
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
               ((floor(place * rate + u) - floor((place - 1) * rate + u)) * size)::BIGINT AS taken
        FROM placed
    """,
    "op12_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
        ), lines AS (
            SELECT doc_id, r, unnest(range(len(ls))) AS place, unnest(ls) AS line FROM split
        ), keyed AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines
        ), keys AS (
            SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10 GROUP BY k
            HAVING count(DISTINCT doc_id) >= 2
        ), judged AS (
            SELECT a.*, keys.k IS NULL OR a.doc_id = first_id AS kept FROM keyed a LEFT JOIN keys USING (k)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (kept), '')) AS kept_sha256
        FROM judged GROUP BY doc_id, r
    """,
    "op11_prefix_trie": f"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL
        ), symbols AS (
            SELECT conv_id, turn, {_SYMBOL} AS s, strlen(text)::BIGINT AS size FROM said
        ), whole AS (
            SELECT conv_id, list({{'s': s, 'size': size}} ORDER BY turn NULLS FIRST, s) AS turns,
                   {_crc32("conv_id::VARCHAR")} % 9 AS h
            FROM symbols GROUP BY conv_id
        ), built AS (
            SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
            FROM whole a LEFT JOIN whole b ON b.conv_id = a.conv_id - a.conv_id % 5
        ), steps AS (
            SELECT conv_id, list_transform(turns, lambda x: x.s) AS ids, turns,
                   unnest(range(len(turns) + 1)) AS depth
            FROM built
        ), nodes AS (
            SELECT ids[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   count(*) FILTER (len(ids) > depth) = 0 AS leaf,
                   (count(*) - 1) * coalesce(any_value(turns[depth].size), 0) AS worth,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ids) = depth), ''))
                       AS ends_sha256
            FROM steps GROUP BY 1, 2
        ), below AS (
            SELECT path[1:k] AS path, sum(leaf::BIGINT)::BIGINT AS n_leaves, sum(worth)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS k FROM nodes) GROUP BY 1
        ), children AS (
            SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
               n_leaves, saved_tokens, n.ends_sha256
        FROM nodes n JOIN below USING (path) LEFT JOIN children c USING (path)
        LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
    """,
    "op13_structure_repair": f"""
        WITH RECURSIVE read AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                   CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
            FROM read WHERE k <> 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, {_SYMBOL}) AS rank,
                   rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed,
                   CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS kind
            FROM damaged
        ), seen AS (
            SELECT *, trimmed = '' AS blank,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rank) > 1 AS again,
                   right(trimmed, 1) NOT IN ('.', '!', '?') AS short,
                   lag(kind) OVER (PARTITION BY conv_id ORDER BY rank) AS before
            FROM ranked
        ), judged AS (
            SELECT *, blank OR again AS gone, CASE WHEN short THEN 3 ELSE 0 END AS extra FROM seen
        ), found AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
                   count(*) FILTER (short AND NOT gone) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before * 10 + kind NOT IN (12, 23, 32)) AS illegal
            FROM judged GROUP BY conv_id
        ), go AS (
            SELECT conv_id, n AS i, [{{'c': 0, 'a': ''}}, {{'c': 6, 'a': 'II'}}, {{'c': 3, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS v,
                   [3, 3, 4, 3] AS nxt, [[0, 2, 3, 0], [0, 0, 3, 0], [0, 0, 0, 4], [0, 0, 3, 0]] AS kept
            FROM found
            UNION ALL
            SELECT conv_id, i - 1, list_transform([1, 2, 3, 4], lambda s: list_min([
                       base[s],
                       {{'c': base[nxt[s]].c + 3, 'a': 'I' || base[nxt[s]].a}},
                       {{'c': base[nxt[nxt[s]]].c + 6, 'a': 'II' || base[nxt[nxt[s]]].a}}])), nxt, kept
            FROM (
                SELECT go.conv_id, i, nxt, kept, list_transform([1, 2, 3, 4], lambda s: list_min([
                           {{'c': v[s].c + 4, 'a': 'D' || v[s].a}},
                           CASE WHEN NOT gone THEN {{'c': v[nxt[s]].c + 3 + extra, 'a': 'R' || v[nxt[s]].a}} END,
                           CASE WHEN NOT gone AND kept[s][kind + 1] > 0 THEN
                               {{'c': v[kept[s][kind + 1]].c + extra, 'a': 'K' || v[kept[s][kind + 1]].a}} END])) AS base
                FROM go JOIN judged j ON j.conv_id IS NOT DISTINCT FROM go.conv_id AND j.rank = go.i
            )
        ), best AS (
            SELECT conv_id, v[1].c::BIGINT AS cost, v[1].a AS audit FROM go WHERE i = 0
        ), letters AS (
            SELECT conv_id, unnest(range(1, len(audit) + 1)) AS p, audit FROM best
        ), placed AS (
            SELECT conv_id, p, audit[p:p] AS letter,
                   length(replace(audit[1:p], 'D', '')) AS nth,
                   length(replace(audit[1:p], 'I', '')) AS rank
            FROM letters
        ), kept_rows AS (
            SELECT l.*, j.role, j.text, j.kind FROM placed l LEFT JOIN judged j
            ON l.letter <> 'I' AND j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.rank = l.rank
            WHERE letter <> 'D'
        ), headed AS (
            SELECT *, max((nth = 1 AND letter = 'K' AND kind = 1)::INT) OVER (PARTITION BY conv_id) AS head FROM kept_rows
        ), repaired AS (
            SELECT conv_id, sha256(string_agg(
                CASE WHEN letter = 'K' THEN role WHEN (nth - head) % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY nth)) AS hash
            FROM headed GROUP BY conv_id
        ), ids AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
        FROM ids LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id
        LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id
        LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM ids.conv_id
    """,
}
