"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from weekcast.llm import bpe, decontaminate, lattice, linededup, merkle, mixing, pii, ppm, quality, simhash, spelling, tokencount, wavelet
from weekcast.llm.common import ascii_lower, table


def op1_mix_sources(spark, sf):
    """Mix all documents to source weights 1, 2, 3, repeating, by at most three epochs."""
    return mixing.mix(table(spark, sf, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_simhash_near_dedup(spark, sf):
    """SimHash groups of all documents: 4-word shingles, at most 4 differing bits."""
    got = simhash.near_duplicates(table(spark, sf, "documents"), k=4, radius=4)
    return got.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op2_line_dedup(spark, sf):
    """Blocks of lines that repeat an earlier document, deleted from all documents."""
    got = linededup.dedup(table(spark, sf, "documents"))
    return got.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                      F.sha2("text", 256).alias("text_sha256"))


def op3_token_counts(spark, sf):
    """Tokens of every text under the 32k sentencepiece model."""
    return tokencount.token_counts(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_quality(spark, sf):
    """Quality score of every document by boosted trees, learned outside the held-out fifth."""
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_personal_data(spark, sf):
    """Personal data in every text: base matches and what their contexts discover."""
    got = pii.find(table(spark, sf, "documents"))
    count = [F.size(F.expr(f"filter(base, s -> s.kind = {i})")).cast("long").alias(f"n_{k}")
             for i, k in enumerate(pii.KINDS)]
    return got.select("doc_id", *count, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
                      pii.spans_text(F.col("spans")).alias("spans"))


def op7_lattice_near_dedup(spark, sf):
    """Links and components of all embeddings at cosine 0.95 or more."""
    return lattice.near_duplicates(table(spark, sf, "embeddings"), least=0.95)


def op8_ppm_scores(spark, sf):
    """log10 probability of every text by a byte PPM model, beside a unigram one."""
    return ppm.score(table(spark, sf, "documents"))


def op9_token_files(spark, sf):
    """All texts encoded, written as wavelet shards and read back."""
    return wavelet.token_files(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_decontaminate(spark, sf):
    """Windows of 10 benchmark words found in all documents."""
    got = decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"), n=10)
    ids = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda i: i.cast("string")))
    return got.select("doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op11_merkle_manifest(spark, sf):
    """Manifest of all documents; a fifth of them is presented with its capitals lowered."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle.audit(table(spark, sf, "documents"), presented={"text": text}) \
        .select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op12_spelling_variants(spark, sf):
    """Words of all documents, the more frequent spelling each is a variant of, and where that leads."""
    return spelling.variants(table(spark, sf, "documents"))


def op13_byte_bpe(spark, sf):
    """All texts encoded by the ranks of a local file, and decoded again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = bpe.decode(bpe.encode(table(spark, sf, "documents"), ranks), ranks)
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("bytes", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_line_dedup, op3_token_counts, op4_simhash_near_dedup, op5_quality, op6_personal_data,
    op7_lattice_near_dedup, op8_ppm_scores, op9_token_files, op10_decontaminate, op11_merkle_manifest,
    op12_spelling_variants, op13_byte_bpe)}

SQL: dict[str, str] = {}

SQL["op1_mix_sources"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, CASE WHEN text IS NULL THEN 0
         ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         CASE WHEN coalesce(length(text), 0) = 0 THEN 1.0 ELSE greatest(
           pow(length(translate(text, '<>{}[]|#$%^&*_=+~\/', ''))::DOUBLE / length(text), 2), 0.05) END AS w,
         (('0x' || substr(md5('7:' || doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / w AS es_key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM k GROUP BY source),
r AS (  -- sources fill up in the order of size over weight
  SELECT *, 3 * source_size AS cap,
         sum(3 * source_size) OVER f - 3 * source_size AS caps_before,
         sum(weight) OVER () - (sum(weight) OVER f - weight) AS weight_left, sum(source_size) OVER () AS total
  FROM s WINDOW f AS (ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min((total - caps_before)::DOUBLE / weight_left, caps_before + cap) FILTER (
        (total - caps_before)::DOUBLE / weight_left <= cap::DOUBLE / weight) AS level FROM r),
t AS (SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target FROM r, l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS epochs FROM t),
o AS (SELECT k.doc_id, k.source, k.size, p.source_size, p.target, p.epochs::BIGINT AS epochs,
             p.target - p.epochs * p.source_size AS rest,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY es_key, k.doc_id ROWS UNBOUNDED PRECEDING)
               - k.size / 2.0 AS middle
      FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken, source,
       epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END AS copies
FROM o"""

SQL["op10_decontaminate"] = r"""
WITH i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT item_id, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p, w
      FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM g),
sizes AS (SELECT DISTINCT n FROM win),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
dp AS (SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS p, w FROM d, sizes WHERE len(w) >= n),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM dp),
hit AS (SELECT dw.doc_id, dw.p, dw.n, win.item_id FROM dw JOIN win USING (n, win)),
cover AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + n - 1)) AS p FROM hit),
c AS (SELECT doc_id, count(*) AS n_hit FROM cover GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(m.n_items, 0)::BIGINT AS n_items, sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)"""

#: CRC-32 of a list of byte values: the usual table by a recursion over eight bits, then one step a byte.
_CRC = r"""crc_bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) AS r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crc_t FROM crc_bits WHERE k = 8)"""


def _crc(codes: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            "lambda c, x: xor(c >> 8, crc_t[(xor(c, x) & 255) + 1])), 4294967295)")


def _ascii(text: str) -> str:
    return f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i, 1))::BIGINT)"


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


SQL["op11_merkle_manifest"] = rf"""
WITH RECURSIVE {_CRC},
d AS (SELECT *, row_number() OVER () AS id,
             CASE WHEN {_crc(_ascii("doc_id::VARCHAR"))} % 5 = 0 THEN {_LOW.format("text")} ELSE text END AS seen
      FROM documents, crc_table),
s AS (SELECT source AS src, row_number() OVER (ORDER BY source ASC NULLS FIRST) - 1 AS sid FROM (SELECT DISTINCT source FROM documents)),
l AS (SELECT d.id, d.doc_id, s.sid, {_leaf("text")} AS leaf, {_leaf("seen")} AS given
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.src),
p AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY doc_id ASC NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY sid) AS n FROM l),
lev AS (
  SELECT sid, 0 AS k, pos, leaf AS h, n FROM p
  UNION ALL
  SELECT sid, k + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM lev WHERE n > 1 GROUP BY sid, k, pos // 16, n),
sub AS (SELECT sid, h AS subroot FROM lev WHERE n = 1),
top AS (
  SELECT 0 AS k, sid AS pos, subroot AS h, (SELECT count(*) FROM sub) AS n FROM sub
  UNION ALL
  SELECT k + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY k, pos // 16, n),
run AS (SELECT sid, k, pos // 16 AS parent, list(h ORDER BY pos) AS hs FROM lev WHERE n > 1 GROUP BY sid, k, pos // 16),
top_run AS (SELECT k, pos // 16 AS parent, list(h ORDER BY pos) AS hs FROM top WHERE n > 1 GROUP BY k, pos // 16),
up AS (
  SELECT id, sid, 0 AS k, pos, given AS node, '' AS proof FROM p
  UNION ALL
  SELECT id, up.sid, up.k + 1, pos // 16,
         sha256(array_to_string(list_transform(hs, lambda x, i: CASE WHEN i = pos % 16 + 1 THEN node ELSE x END), '')),
         proof || array_to_string(list_filter(hs, lambda x, i: i <> pos % 16 + 1), '')
  FROM up JOIN run ON run.sid = up.sid AND run.k = up.k AND run.parent = up.pos // 16),
mid AS (SELECT id, max(sid) AS sid, arg_max(node, k) AS node, arg_max(proof, k) AS proof FROM up GROUP BY id),
over_top AS (
  SELECT id, 0 AS k, sid AS pos, node, proof FROM mid
  UNION ALL
  SELECT id, over_top.k + 1, pos // 16,
         sha256(array_to_string(list_transform(hs, lambda x, i: CASE WHEN i = pos % 16 + 1 THEN node ELSE x END), '')),
         proof || array_to_string(list_filter(hs, lambda x, i: i <> pos % 16 + 1), '')
  FROM over_top JOIN top_run ON top_run.k = over_top.k AND top_run.parent = over_top.pos // 16),
done AS (SELECT id, arg_max(node, k) AS folded_root, arg_max(proof, k) AS proof FROM over_top GROUP BY id)
SELECT p.doc_id, p.leaf, sub.subroot, r.h AS root, sha256(done.proof) AS proof_sha256, done.folded_root,
       done.folded_root = r.h AS verified
FROM p JOIN sub USING (sid) JOIN done USING (id) CROSS JOIN (SELECT h FROM top WHERE n = 1) r"""

SQL["op12_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC},
r AS (SELECT doc_id, {_LOW.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS w FROM documents),
g AS (SELECT coalesce(doc_id::VARCHAR, '') AS key, w, count(*) AS n FROM r GROUP BY 1, 2),
h AS (SELECT w, n, {_crc("list_concat(" + _ascii("(key || ':')") + ", flatten(list_transform(range(1, length(w) + 1), "
                         "lambda i: CASE WHEN ord(substr(w, i, 1)) < 128 THEN [ord(substr(w, i, 1))::BIGINT] "
                         "ELSE [(192 + ord(substr(w, i, 1)) // 64)::BIGINT, (128 + ord(substr(w, i, 1)) % 64)::BIGINT] END)))")} AS crc
      FROM g, crc_table),
e AS (SELECT CASE WHEN crc % 97 = 0 THEN substr(w, 1, crc % length(w)) || substr(w, crc % length(w) + 2) ELSE w END AS word, n FROM h),
words AS (SELECT word, sum(n)::BIGINT AS n FROM e GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
hole AS (SELECT DISTINCT word, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS k FROM places),
less AS (SELECT DISTINCT word, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM places),
near AS (SELECT a.word, b.word AS other FROM hole a JOIN hole b ON a.k = b.k AND a.word <> b.word
         UNION SELECT less.word, words.word FROM less JOIN words ON less.k = words.word
         UNION SELECT words.word, less.word FROM less JOIN words ON less.k = words.word),
best AS (SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
                row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS k
         FROM near JOIN words o ON o.word = near.other),
f AS (SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * words.n THEN other END AS form,
             CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
      FROM words LEFT JOIN best ON best.word = words.word AND best.k = 1),
walk AS (SELECT word, word AS root, form AS next FROM f
         UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.next)
SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL"""
