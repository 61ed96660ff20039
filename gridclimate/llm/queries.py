"""The registered queries of this folder, with the SQL that DuckDB can run for them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .class_model import fit_class_model, score_texts
from .collocations import collocations
from .content_sort import content_groups
from .cover_tree import near_vectors
from .crf_pii import KINDS, find_personal_data
from .golden_mix import mix
from .labelled import id_remainder
from .learned_partitions import nearest_vectors
from .neighbour_quality import fit_quality, score_quality
from .parity_join import near_duplicates
from .periodic_runs import find_runs
from .piece_encoding import encode_pieces
from .shipping import send_package
from .sentence_toxicity import fit_toxicity, score_toxicity
from .token_files import read_token_files, write_token_files
from ..sinks.scratch import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_labels(spark, sf_dir, column, held_out):
    rows = table(spark, sf_dir, "labels").where(~held_out)
    return rows.select(F.col("doc_id").alias("label_id"), F.col(column).alias("label"))


def op1_neighbour_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    model = fit_quality(docs, training_labels(spark, sf_dir, "quality", held_out))
    scored = score_quality(docs, model, keep=["doc_id"]).select("row.doc_id", "score", "predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_piece_encoding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(docs, model, keep=["doc_id"])
    return encoded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_sentence_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    model = fit_toxicity(docs, training_labels(spark, sf_dir, "toxic", held_out))
    scored = score_toxicity(docs, model, keep=["doc_id"]).select("row.doc_id", "score", "predicted", "sentences")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", "predicted",
        F.size("sentences").alias("n_sentences"),
    )


def op4_token_files(spark, sf_dir):
    folder = f"{shared_folder(spark)}/tokens"
    docs = table(spark, sf_dir, "documents")
    write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op5_golden_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))[1].drop("source")


def op6_class_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 1, F.lit(False))
    model, others = fit_class_model(docs.where(~held_out))
    keep = {"doc_id": F.col("doc_id"), "held_out": held_out}
    return score_texts(docs, model, others, keep=keep)


def op7_parity_join(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op8_content_sort(spark, sf_dir):
    groups = content_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_cover_tree(spark, sf_dir):
    found = near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op10_crf_pii(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.begin, s.end)), ","
    )
    return found.select(
        "row.doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op11_stripes(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def planted_runs(doc_id, text):
    """The words of a text with a periodic end for a tenth of the identifiers, else the text."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    rest = n - a
    p = (1 + F.floor(rest / (3 + g % 8))).cast("int")
    times = F.ceil(rest / p).cast("int")
    end = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), end), " ")
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(text)


def op12_diagonal_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = planted_runs(F.col("doc_id"), F.coalesce("text", F.lit("")))
    found = find_runs(docs, keep=["doc_id"], column=text)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    # The greatest of (length, -start, -period).
    order = F.transform(
        "runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("p"))
    )
    found = found.select("*", F.array_max(order).alias("best"))
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.col("best.n") * 1000 / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_learned_partitions(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_vectors(vectors, vectors.where("vec_id % 100 = 0"), k=10)


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1),
                             lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2]))) END AS s
  FROM words
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS n
  FROM members a JOIN members b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (SELECT a, b FROM common WHERE 100 * n >= 90 * (na + nb - n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT s.doc_id, len(s.s) AS n_shingles, component_id
FROM sets s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)"""


OP8_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
),
placed AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM placed"""


OP9_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)"""


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM pieces
),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
places AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
  FROM words, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m
),
frequent AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM places GROUP BY ALL HAVING count(*) >= 100
),
cuts AS (
  SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k
  FROM frequent WHERE m > 1
),
parts AS (
  SELECT lang, m, phrase, f, k, array_to_string(w[1 : k], ' ') AS x,
         array_to_string(w[k + 1 : m], ' ') AS y
  FROM cuts
),
scored AS (
  SELECT p.lang, p.m, p.phrase, p.f AS a, x.f AS l, y.f AS r, n, k,
         CAST(1000 AS HUGEINT) * p.f * n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM parts p JOIN frequent x ON x.lang = p.lang AND x.phrase = p.x
  JOIN frequent y ON y.lang = p.lang AND y.phrase = p.y JOIN totals t ON t.lang = p.lang
),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM frequent f WHERE f.lang = s.lang AND f.m > s.m AND 100 * f.f >= 100 * s.a
    AND contains(concat(' ', f.phrase, ' '), concat(' ', s.phrase, ' ')))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000"""


OP12_SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS w,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(
             string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: list_reduce(
             list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT)
                               ELSE x >> 1 END))) AS h
  FROM documents
),
numbered AS (SELECT *, len(w) AS n, h // 10 AS g FROM split),
placed AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM numbered),
planted AS (
  SELECT doc_id, n,
         CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
                w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
              ELSE w END AS w
  FROM placed
),
tokens AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM planted),
grams AS (
  SELECT doc_id, n, i, list(word) OVER (PARTITION BY doc_id ORDER BY i
                                        ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS gram
  FROM tokens
),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y
  ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND 4 * (y.i - x.i) <= x.n
  WHERE x.i + 5 <= x.n AND y.i + 5 <= y.n
),
islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
  FROM pairs
),
stretches AS (
  SELECT doc_id, min(i) AS start, count(*) + 4 + q AS length, q AS period
  FROM islands GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)
),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.doc_id = s.doc_id AND t.period < s.period
    AND t.start <= s.start AND t.start + t.length >= s.start + s.length)
),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)
           AS lines,
         first(struct_pack(start, length, period) ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM tokens
  WHERE NOT EXISTS (
    SELECT 1 FROM runs WHERE runs.doc_id = tokens.doc_id
    AND tokens.i >= runs.start + runs.period AND tokens.i < runs.start + runs.length)
  GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS "start", best.length AS "length",
       best.period AS "period", 1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def queries():
    return {
        q.__name__: q
        for q in (op1_neighbour_quality, op2_piece_encoding, op3_sentence_toxicity, op4_token_files, op5_golden_mix, op6_class_model, op7_parity_join, op8_content_sort, op9_cover_tree, op10_crf_pii, op11_stripes, op12_diagonal_runs, op13_learned_partitions)
    }


def oracle_sql():
    return {"op7_parity_join": OP7_SQL, "op8_content_sort": OP8_SQL, "op9_cover_tree": OP9_SQL, "op11_stripes": OP11_SQL, "op12_diagonal_runs": OP12_SQL}
