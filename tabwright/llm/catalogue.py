"""Queries over the text tables, one for each operator, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import (
    collocations,
    decontaminate,
    licenses,
    lm_scores,
    manifest,
    near_dup,
    packing,
    pu_quality,
    quality_rules,
    secrets,
    sharding,
    substring_dedup,
    suffix_dedup,
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(documents(spark, folder), path, with_ids=False)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(documents(spark, folder)).drop("kept_bytes")


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    trusted = labels(spark, folder).where("quality = 1 and toxic = 0")
    return lm_scores.cross_entropy_difference(documents(spark, folder), trusted)


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_notices(documents(spark, folder))
    place = F.transform("notices", lambda n: F.concat_ws(":", n["family"], n["start"], n["end"]))
    return found.select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.col("notices.family")))).alias("families"),
        F.concat_ws(",", place).alias("spans"),
        F.array_max(F.col("notices.probability")).alias("best_probability"),
        F.array_max(F.col("notices.overlap")).alias("best_overlap"),
    )


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeated_runs(documents(spark, folder)).drop("kept_text")


def op7_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, folder), size=4)


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, folder))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return pu_quality.classify(documents(spark, folder), labels(spark, folder))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(documents(spark, folder))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    without_breaks = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return manifest.manifest(documents(spark, folder), without_breaks, chosen)


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.shuffled(documents(spark, folder), 40)
    text = F.col("row.text")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        sharding.record_size(text).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_license_scan": op5_license_scan,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_manifest": op12_manifest,
    "op13_sharding": op13_sharding,
}
_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {
    "op3_suffix_dedup": """
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM t WHERE octet_length(b) >= 200),
h AS (SELECT doc_id, i, md5(b[i:i + 199]) AS s FROM p),
r AS (SELECT doc_id, i FROM h JOIN (SELECT s FROM h GROUP BY s HAVING count(*) > 1) USING (s)),
m AS (SELECT doc_id, i, (i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -999) > 200)::INT AS new FROM r),
q AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m),
z AS (SELECT doc_id, min(i) AS a, max(i) + 199 AS e FROM q GROUP BY doc_id, k),
y AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS f, a - 1 AS l FROM z
  UNION ALL SELECT doc_id, max(e) + 1, 2000000000 FROM z GROUP BY doc_id),
x AS (SELECT doc_id, unhex(coalesce(string_agg(hex(b[f:l]), '' ORDER BY f) FILTER (WHERE l >= f), '')) AS kept
  FROM y JOIN t USING (doc_id) GROUP BY doc_id),
v AS (SELECT doc_id, sum(e - a + 1)::BIGINT AS gone, count(*) AS spans FROM z GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(coalesce(kept, b)) AS kept_sha256
FROM t LEFT JOIN v USING (doc_id) LEFT JOIN x USING (doc_id)""",
    "op6_substring_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM p),
r AS (SELECT doc_id, i FROM h JOIN (SELECT s FROM h GROUP BY s HAVING count(*) > 1) USING (s)),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
a AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM w),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS kept, count(*) AS n FROM a ANTI JOIN g USING (doc_id, j) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""",
    "op7_minhash_dedup": f"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 4 THEN range(1, len(w) - 2) WHEN len(w) > 0 THEN [1] ELSE [] END) AS i FROM w),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.x, r.c FROM r JOIN e ON e.y = r.doc_id)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op11_collocations": r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS g FROM w, (VALUES (1), (2), (3)) AS v(k)),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS x FROM f WHERE k > 1 AND f >= 10),
m AS (SELECT lang, g, max(a) AS within FROM (
  SELECT lang, a, unnest([x[1] || ' ' || x[2], x[2] || ' ' || x[3]]) AS g FROM c WHERE k = 3) GROUP BY 1, 2),
o AS (SELECT c.* FROM c LEFT JOIN m USING (lang, g) WHERE k = 3 OR within IS NULL OR 100 * within < 50 * a),
u AS (SELECT lang, g, a, k AS words, x, unnest(range(1, k)) AS cut FROM o),
s AS (SELECT u.lang, u.g, u.a, cut, l.f AS l, r.f AS r, ((1000000::HUGEINT * u.a * u.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.g = array_to_string(x[1:cut], ' ')
  JOIN f r ON r.lang = u.lang AND r.g = array_to_string(x[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM b JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op12_manifest": r"""
WITH RECURSIVE
crc AS (SELECT doc_id, list_reduce(list_prepend(4294967295::UBIGINT, flatten([[ascii(x)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]
    FOR x IN string_split(doc_id::VARCHAR, '')])),
  lambda h, y: CASE WHEN y < 256 THEN xor(h, y) WHEN h % 2 = 1 THEN xor(h >> 1, 3988292384::UBIGINT) ELSE h >> 1 END) AS h FROM documents),
d AS (SELECT doc_id, source, lang, n_chars, text, h % 2 = 1 AS chosen FROM documents JOIN crc USING (doc_id)),
v AS (SELECT *, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
  || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
  || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
  || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head, replace(text, chr(10), '') AS cut FROM d),
l AS (SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
  CASE WHEN chosen THEN sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(cut) || ':' || cut END) END AS new,
  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM v),
t(source, level, pos, h) AS (SELECT source, 0, pos, leaf FROM l UNION ALL
  (SELECT source, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM
    (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM t) WHERE n > 1 GROUP BY source, level, pos // 3)),
top AS (SELECT source, max(level) AS height FROM t GROUP BY source),
sub AS (SELECT t.source, h AS subroot, height, row_number() OVER (ORDER BY t.source NULLS FIRST) - 1 AS place
  FROM t JOIN top ON top.source IS NOT DISTINCT FROM t.source AND level = height),
r(level, pos, h) AS (SELECT 0, place, subroot FROM sub UNION ALL
  (SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS n FROM r) WHERE n > 1 GROUP BY level, pos // 3)),
root AS (SELECT h AS root FROM r ORDER BY level DESC LIMIT 1),
sib AS (SELECT a.source, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS le,
  coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS ri
  FROM t a JOIN top ON top.source IS NOT DISTINCT FROM a.source AND a.level < height
  JOIN t b ON b.source IS NOT DISTINCT FROM a.source AND b.level = a.level AND b.pos // 3 = a.pos // 3 GROUP BY 1, 2, 3),
rsib AS (SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS le,
  coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS ri
  FROM r a JOIN r b ON b.level = a.level AND b.pos // 3 = a.pos // 3 WHERE a.level < (SELECT max(level) FROM r) GROUP BY 1, 2),
up(doc_id, source, step, pos, proof, h) AS (SELECT doc_id, source, 0, pos, '', coalesce(new, leaf) FROM l UNION ALL
  SELECT up.doc_id, up.source, step + 1, up.pos // 3, proof || le || ri, sha256(le || h || ri) FROM up JOIN sib ON sib.source IS NOT DISTINCT FROM up.source
  AND sib.level = step AND sib.pos = up.pos),
half AS (SELECT up.*, place, subroot FROM up JOIN sub ON sub.source IS NOT DISTINCT FROM up.source AND step = height),
top_up(doc_id, step, pos, proof, h) AS (SELECT doc_id, 0, place, proof, h FROM half UNION ALL
  SELECT doc_id, step + 1, top_up.pos // 3, proof || le || ri, sha256(le || h || ri) FROM top_up JOIN rsib ON level = step AND rsib.pos = top_up.pos)
SELECT l.doc_id, l.leaf, subroot, root, sha256(p.proof) AS proof_sha256, p.h AS folded_root, p.h = root AS verified
FROM l JOIN half USING (doc_id) JOIN top_up p ON p.doc_id = l.doc_id AND p.step = (SELECT max(level) FROM r), root""",
}
