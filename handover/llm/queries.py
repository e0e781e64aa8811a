"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import os
import zipfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handover.llm import bpe, decontam, filteraudit, langid, lengths, linededup, lm, pii, quality, simhash, toxicity, urls, veccodes

#: Key of the registered query; a real run passes its own secret.
PSEUDONYM_KEY = b"pseudonym key of the registered query"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(spark.sparkContext._temp_dir, "handover.zip")  # kept as long as the driver's context
    with zipfile.ZipFile(path, "w") as z:
        for base, _, names in os.walk(os.path.join(root, "handover")):
            for name in names:
                if name.endswith(".py"):
                    z.write(full := os.path.join(base, name), os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's log10 probability under the mixing model and under the unigram base, by document."""
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's language, or und, by document."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every whole text and whether the base rules and the learned cutoffs keep it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = quality.scratch.write(quality.measure(docs).drop("text"), "measured")
    cutoffs = quality.choose_cutoffs(measured, _table(spark, sf_dir, "labels"))
    return quality.judge(measured, quality.scratch.write(cutoffs, "chosen")).drop("lang")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best window of each document and benchmark item from a similarity of 0.8 on.

    Candidates are found by shared shingles; SimHash fingerprints only verify, before the exact
    similarity (README says why blocks of a radius of some 30 bits can't find).
    """
    return decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix sums of the exact histogram of encoded lengths, a row for each length."""
    return lengths.suffix_sums(lengths.histogram(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's toxicity score, by document."""
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every whole text's token ids, and the digest of what they decode to."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded="decoded")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text with its numbers, dates and addresses replaced by pseudonyms of their format."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise_documents(docs, PSEUDONYM_KEY).select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"), F.to_json("pii").alias("replaced"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the digest of what is left of every text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.remove_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: four-word shingles, four bits."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.components(docs, keep_text=False).select("doc_id", "fingerprint", "component_id")


#: Fixed values of the query: verdict, host and path.
URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: by rule, else by trees learned from the ruled URLs."""
    return urls.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every embedding: 4 parts, 256 entries, 4 rounds."""
    return veccodes.code_vectors(_table(spark, sf_dir, "embeddings"))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the filters A to E removes, step by step in all 120 orders, by language."""
    return filteraudit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_ALL = (
    op1_lm_scores,
    op2_language_id,
    op3_quality_rules,
    op4_benchmark_decontamination,
    op5_token_counts,
    op6_toxicity,
    op7_bpe_encoding,
    op8_pii_pseudonyms,
    op9_line_dedup,
    op10_simhash_near_dedup,
    op11_url_filter,
    op12_vector_codes,
    op13_filter_interactions,
)
QUERIES = {f.__name__: f for f in _ALL}


def _vector_codes_sql(rounds: int) -> str:
    """Every round compares all parts with all entries."""
    assign = """
near{r} AS MATERIALIZED (
  SELECT id, p, any_value(x) AS x, min([d, e]) AS best
  FROM (SELECT id, p, part.x, e, list_sum(list_transform(list_zip(part.x, book{r}.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM part JOIN book{r} USING (p))
  GROUP BY id, p),"""
    update = """
mean{r} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
  FROM (SELECT p, best[2] AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM near{r}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY p, e, i)
  GROUP BY p, e),
book{next} AS MATERIALIZED (SELECT p, e, coalesce(mean{r}.x, book{r}.x) AS x FROM book{r} LEFT JOIN mean{r} USING (p, e)),"""
    steps = "".join(assign.format(r=r) + (update.format(r=r, next=r + 1) if r < rounds else "") for r in range(rounds + 1))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT id, p, v[len(v) // 4 * p + 1:len(v) // 4 * (p + 1)] AS x FROM kept, (SELECT unnest(range(4)) AS p)),
book0 AS MATERIALIZED (SELECT p, id - 1 AS e, x FROM part WHERE id <= 256),{steps}
coded AS (
  SELECT id, string_agg(lpad(lower(hex(best[2])), 2, '0'), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM near{rounds} GROUP BY id),
digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id), digest"""


ORACLE: dict[str, str] = {
    "op9_line_dedup": """
WITH line AS (
  SELECT doc_id, text, a AS place, list[a + 1] AS raw,
         regexp_replace(list[a + 1], '^[ \\x09-\\x0D]+|[ \\x09-\\x0D]+$', '', 'g') AS line
  FROM (SELECT doc_id, text, list, unnest(range(len(list))) AS a
        FROM (SELECT doc_id, text, string_split(text, chr(10)) AS list FROM documents))),
counted AS (
  SELECT doc_id, place, line AS x, lead(line) OVER w AS y, lead(line, 2) OVER w AS z, lead(place) OVER w AS place2, lead(place, 2) OVER w AS place3
  FROM line WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
later AS (
  SELECT doc_id, place, place2, place3 FROM (
    SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, place) AS nth FROM counted WHERE z IS NOT NULL)
  WHERE nth > 1),
gone AS (SELECT doc_id, place FROM later UNION SELECT doc_id, place2 FROM later UNION SELECT doc_id, place3 FROM later)
SELECT l.doc_id, count(*) AS n_lines, count(g.place) AS n_removed,
       sha256(CASE WHEN count(g.place) = 0 THEN any_value(l.text)
              ELSE coalesce(string_agg(l.raw, chr(10) ORDER BY l.place) FILTER (WHERE g.place IS NULL), '') END) AS text_sha256
FROM line l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.place = g.place
GROUP BY l.doc_id""",
    "op13_filter_interactions": """
WITH body AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
tested AS (
  SELECT doc_id, part, t, list_filter(string_split_regex(t, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS first
  FROM body),
failing AS (
  SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS f,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
  FROM tested),
combination AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM failing GROUP BY part, f),
letter AS (SELECT unnest(range(1, 6)) AS i),
ordering AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
step AS (SELECT o, i AS step, o[i] AS own, o[1:i - 1] AS before FROM ordering, letter),
state AS (
  SELECT part, o, step, own, n, good, toxic, f[own] AS fails, len(list_filter(before, lambda x: f[x])) > 0 AS gone,
         len(list_filter(f, lambda x: x)) AS failed
  FROM combination, step),
counted AS (
  SELECT part, o, step, own,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM state GROUP BY part, o, step, own)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, step::INTEGER AS step, kept::BIGINT AS kept,
       removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted""",
    "op12_vector_codes": _vector_codes_sql(4),
}
