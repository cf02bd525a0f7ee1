"""Registered queries of the operators in this folder, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyshelf.llm import bpe, chunks, collocations, embedding_codes, licenses, line_runs, mixture, pii, shared, sharding, simhash, suffix_arrays, toxicity, vector_codes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_embedding_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors that link at a cosine of 0.95 or more, and their groups."""
    return embedding_codes.near_duplicates(shared.table(spark, sf_dir, "embeddings"))


EMBEDDINGS_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, [x::DOUBLE for x in embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)
    AND len([x for x in embedding if x <> 0]) > 0
), pairs AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT reach.u, pairs.v FROM reach JOIN pairs ON reach.v = pairs.u
)
SELECT e.vec_id, (SELECT count(*) FROM pairs p WHERE p.u = e.vec_id)::BIGINT AS n_links, min(r.v) AS component_id,
  e.vec_id = min(r.v) AS kept
FROM embeddings e JOIN reach r ON r.u = e.vec_id GROUP BY e.vec_id
"""


def op2_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of strings of 100 bytes that also start earlier leave every text."""
    found = suffix_arrays.remove_repeats(shared.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


REPEATS_SQL = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS w
  FROM (SELECT doc_id, h, unnest(range(greatest(0, len(h) // 2 - 99))) AS p FROM docs)
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1
), runs AS (
  SELECT doc_id, p, sum(CASE WHEN p <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) AS before FROM repeated)
), spans AS (
  SELECT doc_id, min(p) AS lo, max(p) + 100 AS hi FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS kept_from FROM spans
), cut AS (
  SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
    string_agg(substr(h, 2 * kept_from + 1, 2 * (lo - kept_from)), '' ORDER BY lo) AS kept
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every text."""
    return licenses.scan(shared.table(spark, sf_dir, "documents"))


def _licenses_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({pairs!r}, '{label}')" for label, pairs in licenses.template_sets(licenses.TEMPLATES))
    stride = licenses.stride_of(licenses.TEMPLATES)
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({low.format("coalesce(text, '')")}, '{word}') AS w FROM documents
), phrases(p, label) AS (VALUES {phrases}
), templates(t, label) AS (VALUES {templates}
), starts AS (
  SELECT doc_id, w, unnest(range(len(w))) AS i FROM words
  WHERE list_has_any(w, ['gnu', 'apache', 'cc', 'mit'])
), base AS (
  SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels
  FROM starts, phrases WHERE w[i + 1:i + len(p)] = p GROUP BY doc_id
), pairs AS (
  SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] AS pair FROM (SELECT doc_id, w, unnest(range(len(w) - 1)) AS i FROM words)
), blocks AS (
  SELECT doc_id, win, list(DISTINCT pair) AS b FROM (
    SELECT doc_id, pair, unnest([i // {stride}, i // {stride} - 1]) AS win FROM pairs
    WHERE pair IN (SELECT unnest(t) FROM templates)
  ) WHERE win >= 0 GROUP BY doc_id, win
), met AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(len(list_intersect(t, b)) / len(t)) AS share
  FROM blocks, templates WHERE len(list_intersect(t, b)) >= ceil(0.8 * len(t) - 1e-9) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN met USING (doc_id)
"""


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the ids; digests of both."""
    docs = shared.table(spark, sf_dir, "documents")
    decoded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    return decoded.select(
        "doc_id", "n_tokens", bpe.sha256_of("ids").alias("ids_sha256"), bpe.sha256_of("decoded").alias("decoded_sha256")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from labelled rows that are not held out."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = toxicity.learnable(F.col("doc_id"))
    found = toxicity.scored(docs, shared.table(spark, sf_dir, "labels"), learn)
    return found.select(
        "doc_id",
        (~toxicity.learnable(F.col("doc_id"))).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more leave every document."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_runs.drop_frequent_lines(docs, least_docs=10)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, i, line,
    translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.k)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (k) GROUP BY doc_id
"""


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base patterns, and spans that the trained span classifier adds."""
    return pii.report(shared.table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 4-word shingles and the groups that link at 4 differing bits or fewer."""
    docs = shared.table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, width=4, rule=simhash.Bits(4))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk fingerprints of every text and of its edited text, and likeness to that and to the next text."""
    return chunks.next_document_likeness(shared.table(spark, sf_dir, "documents"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes from every document."""
    docs = shared.table(spark, sf_dir, "documents")
    plan, _ = mixture.mix(docs)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


MIXTURE_SQL = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(concat('mix-', doc_id)) AS k
  FROM documents
), sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM sums
), running AS (
  SELECT *, 2.0::DOUBLE * source_size / w AS full_at, 1.5::DOUBLE * sum(source_size) OVER () AS everything,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left, coalesce(2 * sum(source_size) OVER before, 0) AS limited
  FROM weighed WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), unit AS (
  SELECT max((everything - limited) / w_left) AS u FROM running WHERE (everything - limited) / w_left <= full_at
), goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, u * w) AS target FROM running, unit
), placed AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS wanted,
    (sum(size) OVER (PARTITION BY base.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT - size AS start
  FROM base JOIN goals ON base.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, wanted) - start) + greatest(0, least(start + size, wanted - source_size) - start))::BIGINT AS taken
FROM placed
"""


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two to five words of each language."""
    return collocations.collocations(shared.table(spark, sf_dir, "documents"))


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang
), counts AS MATERIALIZED (
  SELECT lang, m, array_to_string(g, ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, m, w[i:i + m - 1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) AS t(m)))
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, m, f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS one, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS two
  FROM (SELECT *, unnest(range(1, m)) AS k FROM counts WHERE m > 1)
), weighed AS (
  SELECT c.*, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f), k) AS place
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = one JOIN counts y ON y.lang = c.lang AND y.phrase = two JOIN totals t ON t.lang = c.lang
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, m, string_split(phrase, ' ') AS w, k, unnest(range(1, m - k + 2)) AS i FROM counts, range(2, 5) AS t(k) WHERE k < m)
  GROUP BY ALL
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM weighed w LEFT JOIN inner_phrases i ON i.lang = w.lang AND i.phrase = w.phrase WHERE place = 1 AND (longer IS NULL OR 100 * longer < 100 * a)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four parts of every vector, their errors, and a digest of the codebooks."""
    found, books = vector_codes.compress(shared.table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256")
    )


def _vector_codes_sql() -> str:
    distance = "(list_inner_product(p.v, p.v) + e.n - 2 * list_inner_product(p.v, e.v))::BIGINT"
    best = f"""SELECT p.vec, p.part, min({distance} * 256 + e.entry) AS best
  FROM points p JOIN {{book}} e USING (part) GROUP BY p.vec, p.part"""
    rounds = "".join(
        f""", near{r} AS MATERIALIZED ({best.format(book=f"book{r}")}
), means{r} AS (
  SELECT n.part, (n.best % 256)::INTEGER AS entry, p.i, floor(sum(p.x)::DOUBLE / count(*)) AS x
  FROM near{r} n JOIN flat p USING (vec, part) GROUP BY ALL
), book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v, list_inner_product(coalesce(m.v, b.v), coalesce(m.v, b.v)) AS n
  FROM book{r} b LEFT JOIN (SELECT part, entry, list(x ORDER BY i) AS v FROM means{r} GROUP BY part, entry) m USING (part, entry)
)"""
        for r in range(4)
    )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS vec, vec_id, label, [floor(x::DOUBLE * 1024) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), points AS MATERIALIZED (
  SELECT vec, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS v FROM kept, range(4) AS t(part)
), flat AS MATERIALIZED (
  SELECT vec, part, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM points
), book0 AS MATERIALIZED (
  SELECT part, (vec - 1)::INTEGER AS entry, v, list_inner_product(v, v) AS n FROM points WHERE vec <= 256
){rounds}, near4 AS MATERIALIZED ({best.format(book="book4")}
), coded AS (
  SELECT vec, string_agg(printf('%02x', (best % 256)::INTEGER), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error
  FROM near4 GROUP BY vec
), digest AS (
  SELECT sha256(string_agg(array_to_string([x::BIGINT FOR x IN v], ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book4
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (vec), digest
"""


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 of all documents by the smallest capacity, copies together, and places within them."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sharding.sharded(docs, shards=24, keep_text=False)
    return found.select(
        shared.unpacked(docs, but=["text"])["doc_id"],
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


SHARDING_SQL = """
WITH RECURSIVE table_of(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) AS t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM table_of WHERE k < 8
), remainders AS (SELECT list(c ORDER BY i) AS r FROM table_of WHERE k = 8
), docs AS MATERIALIZED (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS key,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS turn,
    xor(list_reduce(list_prepend(4294967295, [('0x' || b)::BIGINT FOR b IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
      lambda c, b: xor(c >> 8, r[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
  FROM documents, remainders
), groups AS MATERIALIZED (
  SELECT key, (sum(sum(size)) OVER (ORDER BY key))::BIGINT AS upto, (sum(sum(size)) OVER ())::BIGINT AS everything FROM docs GROUP BY key
), search(low, high, k, filled) AS (
  SELECT (max(everything) + 23) // 24, max(everything), 0, 0::BIGINT FROM groups
  UNION ALL
  SELECT CASE WHEN n < everything AND k = 23 THEN (low + high) // 2 + 1 ELSE low END, CASE WHEN n = everything THEN (low + high) // 2 ELSE high END,
    CASE WHEN n = everything OR k = 23 THEN 0 ELSE k + 1 END, CASE WHEN n = everything OR k = 23 THEN 0 ELSE n END
  FROM (
    SELECT low, high, k, (SELECT max(everything) FROM groups) AS everything,
      coalesce((SELECT max(upto) FROM groups WHERE upto <= filled + (low + high) // 2), 0) AS n
    FROM search WHERE low < high
  )
), capacity AS (SELECT min(high) AS c FROM search
), cuts(shard, filled) AS (
  SELECT 0, 0::BIGINT
  UNION ALL
  SELECT shard + 1, (SELECT max(upto) FROM groups WHERE upto <= filled + (SELECT c FROM capacity)) FROM cuts WHERE shard < 23
), placed AS (
  SELECT docs.*, (SELECT max(shard) FROM cuts WHERE cuts.filled < upto)::INTEGER AS shard FROM docs JOIN groups USING (key)
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY key, turn, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""


QUERIES = {
    "op1_embedding_codes": op1_embedding_codes,
    "op2_suffix_arrays": op2_suffix_arrays,
    "op3_licenses": op3_licenses,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_line_runs": op6_line_runs,
    "op7_pii": op7_pii,
    "op8_simhash": op8_simhash,
    "op9_chunks": op9_chunks,
    "op10_mixture": op10_mixture,
    "op11_collocations": op11_collocations,
    "op12_vector_codes": op12_vector_codes,
    "op13_sharding": op13_sharding,
}
SQL = {
    "op1_embedding_codes": EMBEDDINGS_SQL,
    "op2_suffix_arrays": REPEATS_SQL,
    "op3_licenses": _licenses_sql(),
    "op6_line_runs": LINES_SQL,
    "op10_mixture": MIXTURE_SQL,
    "op11_collocations": COLLOCATIONS_SQL,
    "op12_vector_codes": _vector_codes_sql(),
    "op13_sharding": SHARDING_SQL,
}
