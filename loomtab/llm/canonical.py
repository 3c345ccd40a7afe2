"""Freely written values mapped to a reference list by a character n-gram inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtab.llm.fold import halfwidth, strip_accents
from loomtab.session import cut_lineage

#: Decorations around a heading (Java patterns, applied to the folded text until nothing changes; fixed values).
LEADING = (
    r"[\s•*·‣▪#>=–—-]+",
    r"(?:table|tab\.|section|figure) \d+ ?[:.)-] ?",
    r"\(?\d+(?:\.\d+)*[.):]? +",
    r"(?:list of|lists of|the|active|all) +",
)
TRAILING = (
    r"[\s*:;.,=†‡-]++",
    r" ?\[[^\[\]]*\]",
    r" ?\((?:\d+|current|in service|active)\)",
    r" ?(?:- )?(?:in service|since \d{4})",
)


def fold_value(c: Column) -> Column:
    """Lower case ASCII-like letters, one kind of space and dash."""
    c = F.lower(strip_accents(halfwidth(c)))
    c = F.regexp_replace(c, r"\p{Cf}", "")
    c = F.regexp_replace(c, r"[‐‑‒–—―−]", "-")
    return F.trim(F.regexp_replace(c, r"[_\s\p{Z}]+", " "))


def strip_decorations(c: Column) -> Column:
    # a run of decorations is taken whole; one that ends before the text does stays with the sign behind it, so each is read once
    run = f"(?:{'|'.join(TRAILING)})++"
    c = F.regexp_replace(c, f"(?s)({run}(?!$).)|{run}$", "$1")
    return F.trim(F.regexp_replace(c, f"^(?:{'|'.join(LEADING)})++", ""))


def readings(c: Column) -> Column:
    """The texts a value may stand for: as it is, and turned round where it is inverted (``tugs, harbour``)."""
    inverted = r"^([^,()]+?)(?: ?, ?| - )([^,()]+)$"
    bracket = r"^([^()]+?) ?\(([^()]+)\)$"
    ways = F.array(
        c,
        F.when(c.rlike(inverted), F.regexp_replace(c, inverted, "$2 $1")),
        F.when(c.rlike(bracket), F.regexp_replace(c, bracket, "$2 $1")),
    )
    return F.array_distinct(F.filter(ways, lambda w: w.isNotNull()))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "")


def words(c: Column) -> Column:
    """Words of letters and digits; ``a/c`` is one word, a hyphen parts two."""
    return F.filter(F.transform(F.split(c, r"[\s-]+"), squeeze), lambda w: w != "")


#: What each kind of n-gram weighs in the cosine: single letters tell a typing error from another word, longer grams tell words apart (fixed values).
FACTORS = {1: 6.0, 2: 1.0, 3: 0.5}
#: Letters that may differ in the exact check, by the length of the name: none up to the first bound, one up to the second, two beyond (fixed values).
SHORT, MIDDLE = 4, 8
MOST_LETTERS = 2
#: Names of a reference list that is sent to all executors: five index rows each, of a few kilobytes.
MOST_BROADCAST = 5_000
#: Words of the reference from this length on abbreviate nothing (fixed value); shorter ones may, as in ``sub``.
WHOLE = 4
#: An edit spoils at most two 2-grams of a text, so texts that differ by MOST_LETTERS share one of this many rarest ones.
RAREST = 2 * MOST_LETTERS + 1


def grams(c: Column) -> Column:
    """Distinct character 1-, 2- and 3-grams of a squeezed text; the longer ones see its two ends, the single letters are numbered by occurrence."""
    s = F.concat(F.lit("^"), c, F.lit("$"))

    def of(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(s) - k + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substr(s, i, F.lit(k)))

    def letter(i: Column) -> Column:
        one, upto = F.substr(c, i, F.lit(1)), F.substr(c, F.lit(1), i)
        return F.concat(one, F.lit("#"), (F.length(upto) - F.length(F.replace(upto, one, F.lit("")))).cast("string"))

    return F.array_distinct(F.concat(F.transform(F.sequence(F.lit(1), F.length(c)), letter), of(2), of(3)))


def _plurals(c: Column) -> Column:
    return F.array_distinct(
        F.array(c, F.concat(c, F.lit("s")), F.regexp_replace(c, "y$", "ies"), F.regexp_replace(c, "fe?$", "ves"))
    )


def _letters(form: Column, target: Column) -> Column:
    """The letters in which a form differs from a name or its plural."""
    return F.array_min(F.transform(_plurals(target), lambda p: F.levenshtein(p, form)))


def _written_out(asked: DataFrame, names: DataFrame) -> DataFrame:
    """``text, form``: readings with their abbreviations written out as words of one name.

    A token abbreviates a longer word with the same first letter if its letters
    stand in that word in order and it is no word of :data:`WHOLE` letters or
    more itself. Words are found by the token's first two
    letters. There is at most one form per reading and name, so nothing grows
    with the product of what each token may mean.
    """
    listed = names.select("name", F.posexplode(words(F.col("name"))).alias("at", "word"))
    known = listed.select(F.col("word").alias("token")).distinct()
    tokens = asked.select(F.explode(words(F.col("reading"))).alias("token")).where("length(token) >= 2").distinct()
    stems = tokens.withColumn("stem", F.regexp_replace("token", "(?<=...)s$", ""))
    whole = known.where(F.length("token") >= WHOLE)
    unknown = stems.join(whole, "token", "left_anti").join(whole.withColumnRenamed("token", "stem"), "stem", "left_anti")
    later = F.array_distinct(F.split(F.substring("word", 2, 1 << 30), ""))
    keyed = known.select(F.col("token").alias("word")).select("word", F.explode(F.filter(later, lambda x: x != "")).alias("second"))
    keyed = keyed.select("word", F.concat(F.substring("word", 1, 1), "second").alias("key"))
    pairs = unknown.withColumn("key", F.substring("stem", 1, 2)).join(keyed, "key").where(F.length("word") * 2 >= F.length("stem") * 3)
    short = pairs.where(F.rlike("word", F.array_join(F.split("stem", ""), ".*"))).select("token", "word")
    placed = asked.select("text", "reading", F.posexplode(words(F.col("reading"))).alias("i", "token"))
    hits = placed.join(short, "token").join(listed, "word").groupBy("text", "reading", "name", "i").agg(
        F.min(F.struct((F.col("at") != F.col("i")).alias("elsewhere"), "at", "word")).alias("w")  # the word in the same place before others
    )
    swaps = hits.groupBy("text", "reading", "name").agg(F.map_from_entries(F.collect_list(F.struct("i", F.col("w.word")))).alias("swaps"))
    form = F.array_join(F.transform(words(F.col("reading")), lambda t, i: F.coalesce(F.try_element_at("swaps", i), t)), "")
    return swaps.select("text", form.alias("form"))


def map_to_reference(
    values: DataFrame, reference: DataFrame, threshold: float = 0.68, margin: float = 0.01, written_out: float = 0.95
) -> DataFrame:
    """``value, node_id, score`` of each distinct non-blank value; 0 where it names no entry.

    ``values`` has one column ``value``; ``reference`` has ``node_id, name`` and
    may hold several names for an entry. Steps: deduplicate; fold, strip
    decorations, turn inverted readings round; write out abbreviations; find
    candidates through an inverted index of rare character 2-grams; score the
    weighted cosine of 1-, 2- and 3-grams (inverse document frequency over the
    reference, plural forms included; forms written out count ``written_out``
    of it); the best entry holds if its score reaches ``threshold`` and beats
    every other candidate entry by ``margin``. An exact check follows on that
    entry alone: spelling may differ by at most two letters (one for names up
    to eight letters, none for names up to four), so a value that only shares
    words with an entry names none. A value equal to one entry's name names it
    whatever the margin.

    The index holds the five rarest 2-grams of each name and value. Two edits
    spoil at most four of them, so no entry that the exact check would pass is
    missed.

    NULL and blank values give no row; ties name no entry. Values longer than
    the longest name of the reference by more than the letters that may differ
    name no entry, and get their row without a search. An empty reference maps
    all values to 0.
    """
    distinct = values.select("value").where(F.trim(F.regexp_replace("value", r"[\s\p{Z}\p{Cf}]+", " ")) != "").distinct()
    folded = distinct.select("value", strip_decorations(fold_value(F.col("value"))).alias("text"))
    names = reference.select("node_id", fold_value(F.col("name")).alias("name")).where("name <> ''").distinct()
    entry = names.select("node_id", squeeze(F.col("name")).alias("target")).where("target <> ''").distinct()
    # two small facts about the reference list; a longer reading can't be one of its names
    total, longest = entry.agg(F.count_distinct("target"), F.max(F.length("target"))).first()
    longest = (longest or 0) + MOST_LETTERS + 2  # a plural ending has two letters at most
    texts = folded.select("text").where((F.col("text") != "") & (F.length(squeeze(F.col("text"))) <= longest)).distinct()
    asked = texts.select("text", F.explode(readings(F.col("text"))).alias("reading"))
    plain = asked.select("text", squeeze(F.col("reading")).alias("form"), F.lit(1.0).alias("factor"))
    forms = plain.unionByName(_written_out(asked, names).withColumn("factor", F.lit(written_out)))
    # few bytes that turn into much work: kept once and spread over all cores, whatever their size
    spark = values.sparkSession
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    forms = cut_lineage(forms.where("form <> ''").groupBy("text", "form").agg(F.max("factor").alias("factor")))

    counts = entry.select("target").distinct().select(F.explode(grams(F.col("target"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    size = F.when(F.col("gram").contains("#"), 1).otherwise(F.length("gram"))
    factor = F.element_at(F.create_map(*[F.lit(x) for kv in FACTORS.items() for x in kv]), size)
    # a gram that no name holds weighs as one held once; single letters, which all names share, keep a floor
    weight = factor * (F.log(F.lit(total + 1) / F.coalesce("df", F.lit(1))) + 0.2 + F.when(size == 1, 1.0).otherwise(0.0))

    def vectors(of: DataFrame, name: str) -> DataFrame:
        """``<name>, norm, ids, weights, rarest``: the weighted grams of each distinct text."""
        weighed = of.select(name).distinct().repartition(spread).select(name, F.explode(grams(F.col(name))).alias("gram")).join(counts, "gram", "left")
        weighed = weighed.select(name, F.xxhash64("gram").alias("id"), weight.alias("w"), F.when(size == 2, F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("two"))
        return weighed.groupBy(name).agg(
            F.sum("w").alias("norm"), F.collect_list("id").alias("ids"), F.map_from_entries(F.collect_list(F.struct("id", "w"))).alias("weights"),
            F.transform(F.slice(F.array_sort(F.collect_list("two")), 1, RAREST), lambda g: g["gram"]).alias("rarest"),
        )

    index = vectors(entry.select(F.explode(_plurals(F.col("target"))).alias("variant")), "variant").withColumnsRenamed({"norm": "v_norm", "ids": "v_ids", "weights": "v_weights"})
    asks = vectors(forms, "form").drop("weights")
    # a pair is met by its first common rare gram only, so it comes up once
    asked_for = asks.repartition(spread).select("form", "norm", "ids", "rarest", F.explode("rarest").alias("gram"))
    offered = index.select("variant", "v_norm", "v_ids", "v_weights", F.col("rarest").alias("v_rarest"), F.explode("rarest").alias("gram"))
    # a list of a checked size goes to where the values are; a longer one is joined as Spark sees fit
    scored = asked_for.join(F.broadcast(offered) if total <= MOST_BROADCAST else offered, "gram").where(F.get(F.array_intersect("rarest", "v_rarest"), F.lit(0)) == F.col("gram"))
    common = F.array_intersect("ids", "v_ids")
    dot = F.aggregate(common, F.lit(0.0), lambda acc, g: acc + F.element_at("v_weights", g))
    scored = scored.select("form", "variant", (dot / F.sqrt(F.col("norm") * F.col("v_norm"))).alias("cosine"))
    owners = entry.select("node_id", "target", F.explode(_plurals(F.col("target"))).alias("variant"))
    per_entry = scored.join(owners, "variant").groupBy("form", "node_id").agg(F.max(F.struct("cosine", "target")).alias("best"))
    per_text = forms.join(per_entry, "form").groupBy("text", "node_id").agg(
        F.max(F.struct((F.col("best.cosine") * F.col("factor")).alias("score"), F.col("best.target").alias("target"), "form")).alias("best")
    )
    # at most one row per entry of the reference
    ranked = per_text.groupBy("text").agg(F.sort_array(F.collect_list(F.struct(F.col("best.score").alias("score"), "node_id", F.col("best.target").alias("target"), F.col("best.form").alias("form"))), asc=False).alias("best"))
    first, second = F.get("best", F.lit(0)), F.get("best", F.lit(1))
    decided = ranked.select("text", first.alias("a"), second.alias("b")).where(F.col("a.score") >= threshold)
    letters, other = _letters(F.col("a.form"), F.col("a.target")), _letters(F.col("b.form"), F.col("b.target"))
    clear = F.col("b").isNull() | (F.col("a.score") - F.col("b.score") >= margin) | ((letters == 0) & (other > 0))
    allowed = F.when(F.length("a.target") <= SHORT, 0).when(F.length("a.target") <= MIDDLE, 1).otherwise(MOST_LETTERS)
    won = decided.where(clear & (letters <= allowed)).select("text", F.col("a.node_id").alias("node_id"), F.round("a.score", 6).alias("score"))
    return folded.join(won, "text", "left").select("value", F.coalesce("node_id", F.lit(0)).alias("node_id"), "score", F.col("text").alias("folded"))


def named_columns(rows: DataFrame, id_: str, columns: tuple[str, ...]) -> DataFrame:
    """``id, heading_field, value`` of each non-NULL value of several columns."""
    long = rows.select(id_, F.inline(F.array(*[F.struct(F.lit(c).alias("heading_field"), F.col(c).alias("value")) for c in columns])))
    return long.where("value IS NOT NULL")


def reference_names(nodes: DataFrame) -> DataFrame:
    """``node_id, name`` of each name and other name (parted by ``;``) of the entries."""
    parts = F.concat(F.array("name"), F.split(F.coalesce("other_names", F.lit("")), r"\s*;\s*"))
    return nodes.select("node_id", F.explode(parts).alias("name")).where("name IS NOT NULL AND trim(name) <> ''")
