"""Tables classified against the taxonomy: by rules on their headings, then by similarity of profiles."""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loomtab.session import cut_lineage

#: Scores a table must reach in each round (fixed values; what repeated subtraction of 0.2 from 1.0 gives).
CUTS = (1.0, 0.8, 0.6000000000000001, 0.4000000000000001, 0.20000000000000007)
HEADINGS = ("section_h4", "section_h3", "section_h2")


def leaf_header(*headings):
    """The first non-empty heading, deepest first; NULL if there is none."""
    return F.coalesce(*[F.nullif(h, F.lit("")) for h in headings])


def classify_by_headings(
    tables: DataFrame, matches: DataFrame, paths: DataFrame, root: str = "Equipment", collapse: str = "none", key: str = "table_name"
) -> DataFrame:
    """``<key>, equipment_class, other_classes, confidence, leaf_header, class_path``.

    ``matches`` has ``text, entity`` of the rules that hit a distinct heading.
    A table whose headings hit exactly one class under ``root`` has that class
    with confidence 1; else it has none, with 0, and keeps all its classes as
    others. ``collapse="leaf"`` first drops classes that are ancestors of other
    hits. Tables without headings come out without a class.
    """
    long = tables.select(key, F.explode(F.array(*HEADINGS)).alias("text")).where("text IS NOT NULL AND text <> ''")
    known = matches.select("text", "entity").join(paths.select(F.col("name").alias("entity"), "root", "path"), "entity")
    hits = long.join(known, "text").select(key, "entity", "root", "path").distinct()
    found = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("entity", "root", "path"))).alias("hits"))
    if collapse == "leaf":
        leaf = F.filter(
            "hits", lambda h: ~F.exists("hits", lambda g: (F.size(g["path"]) > F.size(h["path"])) & (F.slice(g["path"], F.lit(1), F.size(h["path"])) == h["path"]))
        )
        found = found.withColumn("hits", leaf)
    under = F.filter("hits", lambda h: h["root"] == root)
    one = F.when(F.size(under) == 1, F.element_at(under, 1))
    named = found.select(key, F.transform("hits", lambda h: h["entity"]).alias("all"), one["entity"].alias("equipment_class"), one["path"].alias("path"))
    joined = tables.join(named, key, "left")
    none = F.array().cast("array<string>")
    return joined.select(
        key,
        "equipment_class",
        F.when(F.col("equipment_class").isNotNull(), F.array_remove("all", F.col("equipment_class"))).otherwise(F.coalesce("all", none)).alias("other_classes"),
        F.when(F.col("equipment_class").isNotNull(), 1.0).otherwise(0.0).alias("confidence"),
        leaf_header(*[F.col(h) for h in HEADINGS]).alias("leaf_header"),
        F.array_join("path", ">").alias("class_path"),
    )


def table_features(classified: DataFrame, columns: DataFrame, nodes: DataFrame, rules: DataFrame | None = None, key: str = "table_name") -> DataFrame:
    """``<key>, kind, feature``: classes, their direct parents, children of the table's own class, raw columns, leaf header, and rules of the classes."""
    classes = classified.select(key, F.explode(F.array_union(F.coalesce("other_classes", F.array().cast("array<string>")), F.array_compact(F.array("equipment_class")))).alias("feature"))
    parent = nodes.where("parent IS NOT NULL").select(F.col("name").alias("feature"), "parent")
    parts = [
        classes.select(key, F.lit("classes").alias("kind"), "feature"),
        classes.join(parent, "feature").select(key, F.lit("parent").alias("kind"), F.col("parent").alias("feature")),
        classified.select(key, F.col("equipment_class").alias("parent")).join(parent, "parent").select(key, F.lit("children").alias("kind"), "feature"),
        columns.select(key, F.lit("raw_cols").alias("kind"), F.col("column_name").alias("feature")),
        classified.where("leaf_header IS NOT NULL").select(key, F.lit("leaf_headers").alias("kind"), F.col("leaf_header").alias("feature")),
    ]
    if rules is not None:
        parts.append(classes.join(rules.select(F.col("entity").alias("feature"), "pattern"), "feature").select(key, F.lit("regex").alias("kind"), F.col("pattern").alias("feature")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.where("feature IS NOT NULL").distinct()


def starter_groups(nodes: DataFrame, paths: DataFrame, root: str = "Equipment", rules: DataFrame | None = None) -> DataFrame:
    """``grp, kind, feature``: for each class under ``root``, but not itself: its name, parent, children and rules."""
    inside = paths.where((F.col("root") == root) & (F.col("name") != root)).select(F.col("name").alias("grp"))
    edges = nodes.where("parent IS NOT NULL").select("name", "parent")
    parts = [
        inside.select("grp", F.lit("classes").alias("kind"), F.col("grp").alias("feature")),
        inside.join(edges, F.col("grp") == F.col("name")).select("grp", F.lit("parent").alias("kind"), F.col("parent").alias("feature")),
        inside.join(edges, F.col("grp") == F.col("parent")).select("grp", F.lit("children").alias("kind"), F.col("name").alias("feature")),
    ]
    if rules is not None:
        parts.append(inside.join(rules, F.col("grp") == F.col("entity")).select("grp", F.lit("regex").alias("kind"), F.col("pattern").alias("feature")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.distinct()


def group_frequencies(features: DataFrame, members: DataFrame, key: str = "table_name") -> DataFrame:
    """``grp, kind, feature, frequency``: the share of a group's tables that have each feature; ``members`` has ``<key>, grp``."""
    sizes = members.groupBy("grp").agg(F.count_distinct(key).alias("n"))
    held = features.select(key, "kind", "feature").distinct().join(members.select(key, "grp").distinct(), key)
    return held.groupBy("grp", "kind", "feature").agg(F.count(F.lit(1)).alias("k")).join(sizes, "grp").select("grp", "kind", "feature", (F.col("k") / F.col("n")).alias("frequency"))


def profile_cosine(features: DataFrame, groups: DataFrame, key: str = "table_name") -> DataFrame:
    """``<key>, grp, score`` of each table and group that share a feature.

    A table's vector is 1 for each of its features; a group's counts in how
    many kinds it holds a feature. Only shared features meet, by an equi-join;
    the lengths of the vectors come from each side alone. At most one row per
    table and class of the taxonomy.
    """
    t = features.select(key, "feature").distinct()
    g = groups.groupBy("grp", "feature").agg(F.count_distinct("kind").alias("w"))
    t_norm = t.groupBy(key).agg(F.sqrt(F.count(F.lit(1))).alias("t_norm"))
    g_norm = g.groupBy("grp").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("g_norm"))
    dots = t.join(g, "feature").groupBy(key, "grp").agg(F.sum("w").alias("dot"))
    return dots.join(t_norm, key).join(g_norm, "grp").select(key, "grp", (F.col("dot") / (F.col("t_norm") * F.col("g_norm"))).alias("score"))


def best_group(scores: DataFrame, key: str = "table_name") -> DataFrame:
    """``<key>, grp, score``: the highest score; of equal ones the first name."""
    rounded = scores.withColumn("r", F.round("score", 12))
    best = rounded.groupBy(key).agg(F.min(F.struct(F.negative("r").alias("n"), "grp", "score")).alias("b"))
    return best.select(key, F.col("b.grp").alias("grp"), F.col("b.score").alias("score"))


def classify_by_profile(classified: DataFrame, features: DataFrame, groups: DataFrame, cuts: tuple[float, ...] = CUTS, key: str = "table_name") -> DataFrame:
    """The classification with classes for tables that the headings left open.

    In each round every waiting table is scored against the groups as they
    stand at its start; those whose best score reaches the round's cut join
    their group, whose features then grow by theirs. Confident tables join in
    the first round without being scored. The number of rounds is fixed. Where
    tables are taken one by one, with groups growing in between, results can
    differ.
    """
    fresh = classified.where("confidence = 1.0").select(key, F.col("equipment_class").alias("grp"), F.col("confidence").alias("score"))
    waiting = cut_lineage(features)  # read again in every round
    found = []
    for i, cut in enumerate(cuts):
        fresh = cut_lineage(fresh)
        found.append(fresh)
        # groups grow by the tables that have just joined, and only tables still waiting are scored
        joined = waiting.join(fresh.select(key, "grp"), key).select("grp", "kind", "feature")
        groups = cut_lineage(groups.unionByName(joined).distinct())
        waiting = waiting.join(fresh.select(key), key, "left_anti")
        fresh = best_group(profile_cosine(waiting, groups, key), key).where(F.col("score") >= cut)
    assigned = fresh
    for part in found:
        assigned = assigned.unionByName(part)
    return _with_new_classes(classified, assigned.select(key, F.col("grp").alias("new_class"), F.col("score").alias("new_score")), key)


def classify_one_by_one(
    classified: DataFrame, features: DataFrame, groups: DataFrame, order: DataFrame, cuts: tuple[float, ...] = CUTS,
    key: str = "table_name", max_features: int = 5_000_000,
) -> DataFrame:
    """As :func:`classify_by_profile`, but tables are taken one by one in ``order`` (``<key>, seq``) and groups grow in between.

    That order is a chain of decisions, which runs on the driver here, for
    catalogues of a checked size (``max_features`` rows of features);
    :func:`classify_in_order` takes any. Tables without a ``seq`` come last, by
    key. Ties go to the first name.
    """
    features, groups = cut_lineage(features), cut_lineage(groups)
    if max(features.count(), groups.count()) > max_features:  # counted before anything comes to the driver
        raise ValueError(f"more than {max_features} features; use classify_in_order")
    rows = features.join(order.select(key, "seq"), key, "left").select(key, "seq", "kind", "feature").collect()
    starters = groups.collect()
    profiles: dict[str, set[tuple[str, str]]] = {}
    place: dict[str, tuple] = {}
    for r in rows:
        profiles.setdefault(r[key], set()).add((r["kind"], r["feature"]))
        place[r[key]] = (r["seq"] is None, r["seq"] if r["seq"] is not None else 0, r[key])
    held: dict[str, dict[str, set[str]]] = {}
    for r in starters:
        held.setdefault(r["grp"], {}).setdefault(r["feature"], set()).add(r["kind"])
    sure = {r[key]: r["equipment_class"] for r in classified.where("confidence = 1.0").select(key, "equipment_class").collect()}
    norms = {g: sum(len(kinds) ** 2 for kinds in fs.values()) for g, fs in held.items()}
    waiting, found = sorted(profiles, key=place.__getitem__), {}

    def best(table: str) -> tuple[float, str | None]:
        own = {f for _, f in profiles[table]}
        scores = ((sum(len(fs.get(f, ())) for f in own) / ((len(own) * norms[g]) ** 0.5), g) for g, fs in held.items() if own and norms[g])
        return min(((-s, g) for s, g in scores if s > 0), default=(0.0, None))

    for cut in cuts:
        left = []
        for table in waiting:
            score, group = (-1.0, sure[table]) if table in sure else best(table)
            if group is None or -score < cut:
                left.append(table)
                continue
            found[table] = (group, -score)
            mine = held.setdefault(group, {})
            for kind, f in profiles[table]:
                mine.setdefault(f, set()).add(kind)
            norms[group] = sum(len(kinds) ** 2 for kinds in mine.values())
        waiting = left
    kind = classified.schema[key].dataType.simpleString()
    new = classified.sparkSession.createDataFrame([(t, g, s) for t, (g, s) in found.items()], f"`{key}` {kind}, new_class string, new_score double")
    return _with_new_classes(classified, new, key)


class _Groups:
    """Groups that grow. Memory: the distinct features, and for each group the kinds and features it holds."""

    def __init__(self) -> None:
        self.pairs: dict[tuple, int] = {}  # of kind and feature, numbered
        self.features: dict[str | None, int] = {}
        self.feature_of: list[int] = []
        self.names: list[str] = []
        self.at: dict[str, int] = {}
        self.held: list[set[int]] = []  # pairs of each group
        self.norms = np.zeros(0, np.int64)
        self.by_feature: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # its groups, and in how many kinds each holds it

    def numbers(self, kinds: list, features: list) -> np.ndarray:
        """The number of each pair."""
        out = np.empty(len(kinds), np.int32)
        for i, pair in enumerate(zip(kinds, features)):
            if (k := self.pairs.get(pair)) is None:
                k = self.pairs[pair] = len(self.pairs)
                self.feature_of.append(self.features.setdefault(pair[1], len(self.features)))
            out[i] = k
        return out

    def join(self, name: str, pairs: list[int]) -> None:
        if name not in self.at:
            self.at[name] = len(self.names)
            self.names.append(name)
            self.held.append(set())
            self.norms = np.append(self.norms, 0)
        g = self.at[name]
        for pair in set(pairs) - self.held[g]:
            f = self.feature_of[pair]
            groups, weights = self.by_feature.get(f, (np.zeros(0, np.int64), np.zeros(0)))
            here = (groups == g).nonzero()[0]
            if len(here):
                self.norms[g] += 2 * int(weights[here[0]]) + 1
                weights[here[0]] += 1
            else:
                self.norms[g] += 1
                self.by_feature[f] = np.append(groups, g), np.append(weights, 1.0)
        self.held[g].update(pairs)

    def best(self, pairs: list[int]) -> tuple[str | None, float]:
        own = {self.feature_of[p] for p in pairs}
        met = [self.by_feature[f] for f in own if f in self.by_feature]
        if not met:
            return None, 0.0
        dots = np.bincount(np.concatenate([g for g, _ in met]), np.concatenate([w for _, w in met]), len(self.names))
        scores = dots / np.sqrt(len(own) * self.norms)
        top = scores.max()
        near = (scores >= top * (1 - 1e-12)).nonzero()[0]
        if len(near) > 1:  # ties are told from near ones by whole numbers
            first = min(near, key=lambda g: (-Fraction(int(dots[g]) ** 2, int(self.norms[g])), self.names[g]))
        else:
            first = near[0]
        return self.names[first], float(scores[first])


def _profiles(batches: Iterator[pa.RecordBatch], grown: _Groups) -> Iterator[list[tuple]]:
    """``(key, sure, class, pairs)`` of the tables of each batch; starters join their group on the way."""
    for batch in batches:
        profile = batch.column("profile")
        ends = np.asarray(profile.offsets) - profile.offsets[0].as_py()
        pairs = grown.numbers(*(c.to_pylist() for c in profile.flatten().flatten()))
        tables = []
        columns = (batch.column(c).to_pylist() for c in ("key", "starter", "sure", "grp"))
        for i, (key, starter, sure, grp) in enumerate(zip(*columns)):
            own = pairs[ends[i] : ends[i + 1]]
            if starter:
                grown.join(grp, own.tolist())
            else:
                tables.append((key, sure, grp, own.tobytes()))
        yield tables


def _again(file) -> Iterator[list[tuple]]:
    with file:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def classify_in_order(
    classified: DataFrame, features: DataFrame, groups: DataFrame, order: DataFrame, cuts: tuple[float, ...] = CUTS, key: str = "table_name",
) -> DataFrame:
    """What :func:`classify_one_by_one` gives, for catalogues of any number of tables.

    The chain of decisions is one task, which nothing can divide, but the
    profiles are made and sorted before it by all. It gets the groups first,
    then the tables in order. Those that wait for a later round lie in a file
    of the task meanwhile, so its memory grows by distinct features alone, and
    nothing comes to the driver.
    """
    profile = F.collect_set(F.struct("kind", "feature")).alias("profile")
    places = order.groupBy(F.col(key).alias("key")).agg(F.min("seq").alias("seq"))
    sure = classified.where("confidence = 1.0").groupBy(F.col(key).alias("sure_key")).agg(F.lit(True).alias("sure"), F.min("equipment_class").alias("grp"))
    tables = features.groupBy(F.col(key).alias("key")).agg(profile).join(places, "key", "left")
    tables = tables.join(sure, F.col("key").eqNullSafe(F.col("sure_key")), "left").select(F.lit(False).alias("starter"), "key", "seq", "sure", "grp", "profile")
    starters = groups.groupBy("grp").agg(profile).withColumn("starter", F.lit(True))
    line = tables.unionByName(starters, allowMissingColumns=True).repartition(1)
    line = line.sortWithinPartitions(F.desc("starter"), F.asc_nulls_last("seq"), F.asc_nulls_last("key")).drop("seq")
    kind = classified.schema[key].dataType
    types = to_arrow_type(kind), pa.string(), pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = _Groups()
        turn = _profiles(batches, grown)
        for cut in cuts:
            waiting = tempfile.TemporaryFile()
            for tables in turn:
                found, left = [], []
                for table in tables:
                    name, sure, grp, own = table
                    pairs = np.frombuffer(own, np.int32).tolist()
                    group, score = (grp, 1.0) if sure else grown.best(pairs)
                    if group is None or score < cut:
                        left.append(table)
                        continue
                    grown.join(group, pairs)
                    found.append((name, group, score))
                if left:
                    pickle.dump(left, waiting)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=[key, "new_class", "new_score"])
            turn = _again(waiting)

    return _with_new_classes(classified, line.mapInArrow(run, f"`{key}` {kind.simpleString()}, new_class string, new_score double"), key)


def _with_new_classes(classified: DataFrame, new: DataFrame, key: str) -> DataFrame:
    joined = classified.join(new, key, "left")
    return joined.select(
        *[c for c in classified.columns if c not in ("equipment_class", "other_classes", "confidence")],
        F.coalesce("equipment_class", "new_class").alias("equipment_class"),
        F.coalesce(F.array_except("other_classes", F.array("new_class")), "other_classes").alias("other_classes"),
        F.coalesce("new_score", "confidence").alias("confidence"),
    )


def unclassified(classified: DataFrame) -> DataFrame:
    """Tables no round could place: candidates for new classes."""
    return classified.where("equipment_class IS NULL")
