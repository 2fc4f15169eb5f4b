"""The registered queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WORDS = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score

    return score(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_wrapper import extract

    return extract(table(spark, sf_dir, "pages"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_decode_digests

    return encode_decode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .winnow import fingerprint

    return fingerprint(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .variants import variants

    return variants(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_lm_scoring, op2_packing, op3_html_extraction, op4_nearest_neighbours, op5_token_counts,
        op6_bpe, op7_language_id, op8_near_duplicates, op9_quality, op10_winnowing,
        op11_spelling_variants, op12_collocations, op13_toxicity,
    )
    return {f.__name__: f for f in found}


_NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents WHERE text IS NOT NULL),
keyed AS (SELECT doc_id, ws, CASE WHEN len(ws) > 0 THEN array_to_string(ws, ' ') ELSE chr(10) || text END AS key FROM words),
texts AS (SELECT min(doc_id) AS id, key, any_value(ws) AS ws FROM keyed GROUP BY key),
grams AS (SELECT DISTINCT id, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM texts WHERE len(ws) > 0)),
sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
common AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.id < y.id GROUP BY x.id, y.id),
links AS (SELECT a, b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (SELECT id, id FROM texts UNION SELECT reach.id, w.b FROM reach JOIN both_ways w ON w.a = reach.other),
roots AS (SELECT id, min(other) AS class_id FROM reach GROUP BY id)
SELECT k.doc_id, r.class_id, t.id AS text_id FROM keyed k JOIN texts t ON t.key = k.key JOIN roots r ON r.id = t.id
UNION ALL SELECT doc_id, doc_id, doc_id FROM documents WHERE text IS NULL
"""


_COLLOCATIONS = r"""
WITH cut AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w, count(*) AS m FROM cut GROUP BY ALL),
total AS (SELECT lang, sum(m * len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, w, m, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, s, sum(m)::HUGEINT AS f FROM starts, (SELECT unnest(range(1, 6)) AS s) WHERE i + s - 1 <= len(w) GROUP BY ALL HAVING sum(m) >= 100),
cuts AS (SELECT lang, phrase, f AS a, s, string_split(phrase, ' ') AS w, unnest(range(1, s)) AS k FROM grams WHERE s > 1),
scores AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, 1000 * a * n // (x.f * y.f) AS score FROM cuts c JOIN total USING (lang)
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ') JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.s], ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (SELECT DISTINCT x.lang, x.phrase FROM cuts x JOIN cuts y ON x.lang = y.lang AND y.s > x.s AND 100 * y.a >= 100 * x.a AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') WHERE x.k = 1 AND y.k = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest ANTI JOIN held USING (lang, phrase))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """Near-duplicates by comparing all pairs, collocations by counting all phrases; the other operators hold trained
    models, libraries' tokenizers or checksums, which SQL cannot express."""
    return {"op8_near_duplicates": _NEAR_DUPLICATES, "op12_collocations": _COLLOCATIONS}
