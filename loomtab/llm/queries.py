"""The p1, p6, p7, p8 and p9 queries, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.llm import canonical, duplicates, mixing, tokens, toxicity
from loomtab.session import read_table

HEADINGS = ("section_h2", "section_h3", "section_h4")
#: Size of the mixes by characters.
CHARACTERS = 500_000


def _runs(spark: SparkSession, d: str) -> duplicates.DuplicateRuns:
    rows = read_table(spark, d, "a_master_equipment")
    return duplicates.DuplicateRuns(duplicates.canonical_records(rows, ("equip_type", "variant"), ("table_name",)))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d).copies()


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """Each record once, with the exact number of rows that stated it."""
    return _runs(spark, d).representatives()


def _mapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    headings = canonical.named_columns(read_table(spark, d, "a_meta_table"), "meta_id", HEADINGS)
    names = canonical.reference_names(read_table(spark, d, "taxonomy_nodes"))
    return headings, canonical.map_to_reference(headings, names)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    headings, mapped = _mapped(spark, d)
    return headings.join(mapped, "value").select("meta_id", "heading_field", "node_id")


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that name no entry, with how often they stand."""
    headings, mapped = _mapped(spark, d)
    return headings.join(mapped.where("node_id = 0"), "value").groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(read_table(spark, d, "documents"))


def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Documents, tokens, and texts that don't come back from their ids, by language."""
    docs = read_table(spark, d, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    ids = tokens.encode_corpus(docs)
    back = tokens.decode_corpus(ids).select("doc_id", F.xxhash64("text").alias("back"))
    joined = docs.select("doc_id", "lang", F.xxhash64("text").alias("sent")).join(back, "doc_id")
    counted = joined.join(ids.select("doc_id", F.size("ids").alias("n_tokens")), "doc_id")
    return counted.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.count_if(F.col("sent") != F.col("back")).alias("n_lost")
    )


def p7_restored(spark: SparkSession, d: str) -> DataFrame:
    """Every text as it comes back from its ids."""
    return tokens.decode_corpus(tokens.encode_corpus(read_table(spark, d, "documents")))


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.Mix(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).emitted()


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).report()


def _mix_by_characters(spark: SparkSession, d: str) -> mixing.Mix:
    """The same operator over sizes that SQL can count: characters in place of tokens, and a mix of a fixed size."""
    docs = read_table(spark, d, "documents").select("doc_id", "source", F.col("n_chars").alias("n_tokens"))
    return mixing.Mix.of_sizes(docs, read_table(spark, d, "mix_targets"), size=CHARACTERS)


def p8_mix_by_characters(spark: SparkSession, d: str) -> DataFrame:
    return _mix_by_characters(spark, d).emitted()


def p8_shares_by_characters(spark: SparkSession, d: str) -> DataFrame:
    report = _mix_by_characters(spark, d).report()
    return report.withColumns({c: F.round(c, 9) for c in ("rate", "actual_share")})


_CHAINS: dict[tuple[str, str], toxicity.Chain] = {}


def _chain(spark: SparkSession, d: str) -> toxicity.Chain:
    """Fitted once for each application and folder of tables; the three queries share it."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _CHAINS:
        _CHAINS[key] = toxicity.fit_on_labels(read_table(spark, d, "documents"), read_table(spark, d, "doc_labels"))
    return _CHAINS[key]


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the score of each link of the chain."""
    return toxicity.score_documents(read_table(spark, d, "documents"), _chain(spark, d), ("source",))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_scores(spark, d).where(F.col("unfit") >= toxicity.THRESHOLD).select("doc_id")


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """Each source with its documents and its rate of unfit ones; a NULL source is one of its own."""
    unfit = F.col("unfit") >= toxicity.THRESHOLD
    return p9_scores(spark, d).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(unfit).alias("n_unfit"),
        F.avg(unfit.cast("double")).alias("unfit_rate"),
        *[F.count_if(F.col(k) >= toxicity.THRESHOLD).alias(f"n_{k}") for k in toxicity.CATEGORIES],
    )


QUERIES = {f.__name__: f for f in (p1_found, p1_records, p6_found, p6_unmatched, p7_ids, p7_roundtrip, p7_restored, p8_mix, p8_shares, p8_mix_by_characters, p8_shares_by_characters, p9_found, p9_scores, p9_rates)}

_RECORDS = r"""WITH parts AS (
  SELECT row_id, table_name, unnest(string_split(coalesce(equip_type, '') || ';' || coalesce(variant, ''), ';')) AS v FROM a_master_equipment),
vals AS (SELECT row_id, table_name, regexp_replace(lower(v), '[^\p{L}\p{M}\p{N}]', '', 'g') AS v FROM parts),
recs AS (SELECT row_id, table_name, list_sort(list(DISTINCT v)) AS r FROM vals WHERE v <> '' GROUP BY 1, 2),
firsts AS (SELECT row_id, min(row_id) OVER (PARTITION BY table_name, r) AS first_row_id FROM recs)
"""

_MIX = f"""WITH docs AS (SELECT doc_id, source, n_chars AS n FROM documents WHERE source IS NOT NULL AND n_chars > 0),
held AS (SELECT source, sum(n)::BIGINT AS source_tokens FROM docs GROUP BY 1),
wanted AS (SELECT mix_name, source, sum(target_share) AS target_share, min(max_repeats) AS max_repeats FROM mix_targets WHERE source IS NOT NULL GROUP BY 1, 2),
told AS (SELECT w.*, h.source_tokens, coalesce(source_tokens > 0 AND target_share > 0 AND max_repeats > 0, false) AS usable FROM wanted w LEFT JOIN held h USING (source)),
scaled AS (SELECT *, target_share / sum(target_share) FILTER (usable) OVER (PARTITION BY mix_name) AS share FROM told),
rates AS (SELECT *, CASE WHEN usable THEN least(share * {float(CHARACTERS)} / source_tokens, max_repeats::DOUBLE) END AS rate FROM scaled),
drawn AS (SELECT mix_name, source, doc_id, n, max_repeats, rate, ('0x' || substr(md5(concat_ws(chr(1), '17', mix_name, doc_id::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM docs JOIN rates USING (source) WHERE rate IS NOT NULL),
counted AS (SELECT *, least(floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, max_repeats) AS copies FROM drawn)
"""

ORACLES = {
    "p7_restored": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p8_mix_by_characters": _MIX + "SELECT mix_name, source, doc_id, unnest(range(1, copies + 1))::INT AS copy_no FROM counted WHERE copies > 0",
    "p8_shares_by_characters": _MIX + """, got AS (SELECT mix_name, source, sum(copies * n)::BIGINT AS mixed_tokens, count(*) AS used_docs, max(copies)::BIGINT AS most_repeats
  FROM counted WHERE copies > 0 GROUP BY 1, 2)
SELECT mix_name, source, target_share, max_repeats, coalesce(source_tokens, 0) AS source_tokens, round(coalesce(rate, 0), 9) AS rate, coalesce(mixed_tokens, 0) AS mixed_tokens,
  coalesce(used_docs, 0) AS used_docs, coalesce(most_repeats, 0) AS most_repeats, round(coalesce(mixed_tokens / sum(mixed_tokens) OVER (PARTITION BY mix_name), 0), 9) AS actual_share
FROM rates LEFT JOIN got USING (mix_name, source)""",
    "p1_found": _RECORDS + "SELECT first_row_id, row_id FROM firsts WHERE row_id <> first_row_id",
    "p1_records": _RECORDS + "SELECT first_row_id, count(*) AS n_copies FROM firsts GROUP BY 1",
}
