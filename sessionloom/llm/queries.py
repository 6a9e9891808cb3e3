"""Queries of this package, (spark, sf_dir) -> DataFrame, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm import (
    collocations,
    decontaminate,
    fill_middle,
    line_dedup,
    lm_scoring,
    near_dedup,
    packing,
    passage_dedup,
    quality_rules,
    secrets,
    sharding,
    substring_dedup,
    topk_search,
)
from sessionloom.llm.common import ship, table

SHARDS = 16


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "row.doc_id", F.col("row.source").alias("host"), "n_lines", "n_removed", "clean_text"
    )


OP1_SQL = f"""
WITH l AS (
  SELECT doc_id, source, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents)
), k AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l
), p AS (
  SELECT source, count(DISTINCT text) + count(DISTINCT CASE WHEN text IS NULL THEN 0 END) AS pages
  FROM documents GROUP BY source
), o AS (
  SELECT source, text, min(doc_id) AS doc_id FROM documents GROUP BY source, text
), b AS (
  SELECT k.source, k.bare
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source
  WHERE k.bare <> '' AND k.doc_id IN (SELECT doc_id FROM o)
  GROUP BY k.source, k.bare, p.pages
  HAVING count(DISTINCT k.doc_id) > {line_dedup.MAX_RATIO} * p.pages
    AND count(DISTINCT k.doc_id) >= {line_dedup.MIN_WITH}
), m AS (
  SELECT k.*, b.bare IS NOT NULL AS dropped
  FROM k LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.bare = b.bare
), g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '') AS clean_text
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, d.source AS host, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, g.clean_text
FROM documents d LEFT JOIN g USING (doc_id)
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.dedup(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + {near_dedup.SHINGLE - 1}), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {near_dedup.SHINGLE - 1}, 1) + 1)) AS i
        FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= {near_dedup.PERCENT} * (na.n + nb.n - c)
), r(a, b) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a AS doc_id, min(b) AS least_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
  coalesce(least_id, d.doc_id) AS component_id, coalesce(least_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({_LOWERED},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT DISTINCT item_id, regexp_extract_all({_LOWERED},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), q AS (
  SELECT item_id, list_slice(ws, s, s + {decontaminate.WINDOW - 1}) AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {decontaminate.WINDOW - 1}, 1) + 1)) AS s
        FROM b WHERE len(ws) > 0)
), n AS (SELECT DISTINCT len(win) AS n FROM q), f AS (
  SELECT doc_id, s, n, list_slice(ws, s, s + n - 1) AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM w, n WHERE len(ws) >= n)
), h AS (
  SELECT DISTINCT f.doc_id, f.s, f.n, q.item_id FROM f JOIN q ON f.win = q.win
), c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id
), i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT w.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def joined(spans: str):
        return F.expr(
            f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
        )

    def count(kind: str):
        return F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint)")

    return found.withColumn(
        "base", F.expr("filter(spans, s -> s.kind in ('assign', 'access', 'hex'))")
    ).select(
        "row.doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


OP9_SQL = f"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents
), v AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + {substring_dedup.WINDOW - 1}), ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {substring_dedup.WINDOW - 1} + 1)) AS i
        FROM w WHERE len(ws) >= {substring_dedup.WINDOW})
), m AS (SELECT win, min(doc_id) AS first_id FROM v GROUP BY win), h AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {substring_dedup.WINDOW})) AS i
  FROM v JOIN m USING (win) WHERE first_id < doc_id
), t AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), k AS (
  SELECT t.doc_id, count(h.i) AS n_removed,
    string_agg(word, ' ' ORDER BY t.i) FILTER (WHERE h.i IS NULL) AS kept
  FROM t LEFT JOIN h ON h.doc_id = t.doc_id AND h.i = t.i GROUP BY t.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("broken", ",").alias("broken"),
    )


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where(F.col("vec_id") % topk_search.QUERY_EVERY == 0))


OP11_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({topk_search.SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % {topk_search.QUERY_EVERY} = 0) q JOIN v c ON c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {topk_search.K}
"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH p AS (
  SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang,
    unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), z AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, range(1, {collocations.LONGEST + 1}) AS r(k) WHERE len(ws) >= k)
), f AS (
  SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS ws FROM g
  GROUP BY lang, k, phrase HAVING count(*) >= {collocations.MIN_COUNT}
), x AS (
  SELECT lang, k, phrase, f AS a, cut, array_to_string(list_slice(ws, 1, cut), ' ') AS pre,
    array_to_string(list_slice(ws, cut + 1, k), ' ') AS suf
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1)
), s AS (
  SELECT x.lang, x.phrase, x.a, l.f AS l, r.f AS r, x.cut,
    CAST(({collocations.MILLIONTHS}::HUGEINT * x.a) // (l.f::HUGEINT + r.f) AS BIGINT) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.pre JOIN f r ON r.lang = x.lang AND r.phrase = x.suf
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), o AS (
  SELECT DISTINCT lang, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS phrase, f AS longer
  FROM (SELECT lang, ws, f, m, unnest(range(1, k - m + 2)) AS i
        FROM f, range(2, {collocations.LONGEST}) AS r(m) WHERE k > m)
), c AS (SELECT lang, phrase, max(longer) AS longer FROM o GROUP BY lang, phrase), t AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN c USING (lang, phrase)
  WHERE 100::HUGEINT * coalesce(longer, 0) < {collocations.COVERED}::HUGEINT * a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, n, score
FROM t JOIN z USING (lang) WHERE rank <= {collocations.TOP}
"""


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.cut(fill_middle.framed(table(spark, sf_dir, "documents")), with_frames=False)
    return found.withColumn("doc_id", F.col("doc_id").cast("long")).drop("frames")


OP13_SQL = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
    sha256('{fill_middle.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hx,
    regexp_extract_all(coalesce(text, ''),
      '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), h AS (
  SELECT *, len(u) AS n, CAST('0x' || hx[1:8] AS BIGINT) AS h1, CAST('0x' || hx[9:16] AS BIGINT) AS h2,
    CAST('0x' || hx[17:24] AS BIGINT) AS h3, CAST('0x' || hx[25:32] AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= {fill_middle.PLAIN} THEN 'plain'
      WHEN h4 % 100 < {fill_middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS pre,
    array_to_string(list_slice(u, a + 1, b), '') AS mid, array_to_string(list_slice(u, b + 1, n), '') AS suf
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
    ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def _shipping(query: Callable[[SparkSession, str], DataFrame]):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _shipping(query)
    for query in (
        op1_line_dedup,
        op2_suffix_dedup,
        op3_packing,
        op4_near_dedup,
        op5_decontaminate,
        op6_sharding,
        op7_secrets,
        op8_lm_scoring,
        op9_substring_dedup,
        op10_quality_rules,
        op11_topk_search,
        op12_collocations,
        op13_fill_middle,
    )
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op4_near_dedup": OP4_SQL,
    "op5_decontaminate": OP5_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op11_topk_search": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_fill_middle": OP13_SQL,
}
