"""Sources mixed to target shares of all tokens, with capped repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.llm.tokens import VOCABULARY, count_tokens
from loomtab.session import cut_lineage

#: Hexadecimal signs of the hash that make a draw, and how many values they have.
_SIGNS, _UNIT = 13, float(1 << 52)


class Mix:
    """Documents of several sources combined to the shares of each mix.

    ``targets`` has ``mix_name, source, target_share, max_repeats``. With tokens
    ``n`` of a source, its rate is ``share * total / n``, at most its
    ``max_repeats``. ``total`` is ``size``, the tokens wanted of each mix; then
    a source too small for its share gives what its cap allows, the others keep
    their amounts, and the report shows the shares reached. Without ``size`` a
    mix is as large as it can be with every share exact: the largest total at
    which no rate passes its cap, so the scarcest source decides it. Each
    document comes out ``floor(rate)`` times and once more with probability
    ``rate - floor(rate)``, decided by a hash (MD5) of ``seed``, mix and
    document, so a rerun gives the same copies.

    A listed source without tokens can't have its share: the other shares are
    scaled to sum to 1 and the report shows it with 0. Documents of unlisted or
    NULL sources, and those without tokens, are in no mix. Targets with a NULL,
    zero or negative share or cap take nothing. Repeated targets of a source in
    a mix add up their shares under the smallest cap. Repeated documents count
    each time. Empty inputs give empty results.
    """

    def __init__(self, docs: DataFrame, targets: DataFrame, seed: int = 17, path: str = VOCABULARY, size: float | None = None) -> None:
        # narrow, tokenised once, kept for both results
        self._set(cut_lineage(count_tokens(docs, ("source",), path).where(self._USED)), targets, seed, size)

    _USED = "source IS NOT NULL AND n_tokens > 0"

    @classmethod
    def of_sizes(cls, sized: DataFrame, targets: DataFrame, seed: int = 17, size: float | None = None) -> Mix:
        """A mix of documents whose sizes are known: ``doc_id, source, n_tokens``, in whatever unit."""
        mix = cls.__new__(cls)
        mix._set(sized.select("doc_id", "source", "n_tokens").where(cls._USED), targets, seed, size)
        return mix

    def _set(self, sized: DataFrame, targets: DataFrame, seed: int, size: float | None) -> None:
        self.sized, self.seed, self.size = sized, seed, size
        self.rates = self._rates(targets)

    def _rates(self, targets: DataFrame) -> DataFrame:
        wanted = targets.where("source IS NOT NULL").groupBy("mix_name", "source").agg(
            F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats")
        )
        held = self.sized.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"), F.count(F.lit(1)).alias("source_docs"))
        usable = (F.col("source_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
        joined = wanted.join(held, "source", "left").withColumn("usable", F.coalesce(usable, F.lit(False)))
        mix = W.partitionBy("mix_name")  # rows of the target list, not of the corpus
        share = F.when(F.col("usable"), F.col("target_share") / F.sum(F.when(F.col("usable"), F.col("target_share"))).over(mix))
        scaled = joined.withColumn("share", share)
        total = F.min(F.when(F.col("usable"), F.col("max_repeats") * F.col("source_tokens") / F.col("share"))).over(mix) if self.size is None else F.lit(float(self.size))
        return scaled.withColumn("total", total).select(
            "mix_name", "source", "target_share", "share", "max_repeats", "source_tokens", "source_docs", "total",
            F.when(F.col("usable"), F.least(F.col("share") * F.col("total") / F.col("source_tokens"), F.col("max_repeats").cast("double"))).alias("rate"),
        )

    def _counted(self) -> DataFrame:
        rates = self.rates.where("rate IS NOT NULL").select("mix_name", "source", "rate", "max_repeats")
        drawn = self.sized.join(rates, "source")
        drawn_by = F.md5(F.concat_ws("\u0001", F.lit(str(self.seed)), "mix_name", F.col("doc_id").cast("string")).cast("binary"))
        u = F.conv(F.substring(drawn_by, 1, _SIGNS), 16, 10).cast("bigint") / F.lit(_UNIT)
        whole = F.floor("rate")
        copies = F.least(whole + F.when(u < F.col("rate") - whole, 1).otherwise(0), F.col("max_repeats").cast("bigint"))
        return drawn.select("mix_name", "source", "doc_id", "n_tokens", copies.alias("copies")).where("copies > 0")

    def emitted(self) -> DataFrame:
        """``mix_name, source, doc_id, copy_no``: one row per copy, numbered from 1."""
        return self._counted().select("mix_name", "source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_no"))

    def report(self) -> DataFrame:
        """The share each source of each mix really reached, and how."""
        got = self._counted().groupBy("mix_name", "source").agg(
            F.sum(F.col("copies") * F.col("n_tokens")).alias("mixed_tokens"), F.count(F.lit(1)).alias("used_docs"), F.max("copies").alias("most_repeats")
        )
        all_ = F.sum("mixed_tokens").over(W.partitionBy("mix_name"))
        joined = self.rates.join(got, ["mix_name", "source"], "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
        return joined.select(
            "mix_name", "source", "target_share", "max_repeats",
            F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"),
            F.coalesce("rate", F.lit(0.0)).alias("rate"),
            "mixed_tokens",
            F.coalesce("used_docs", F.lit(0)).alias("used_docs"),
            F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
            F.coalesce(F.col("mixed_tokens") / F.nullif(all_, F.lit(0)), F.lit(0.0)).alias("actual_share"),
        )
