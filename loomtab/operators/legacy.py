"""Older ways of grouping tables: weighted set similarity, rule lists, and cluster labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of the parts of a profile (fixed values).
WEIGHTS = {"header": 0.40, "parent": 0.10, "category": 0.40, "column": 0.10}


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def profile_similarity(a: str, b: str, weights: dict[str, float] = WEIGHTS) -> Column:
    """Weighted sum of the Jaccard indices of two struct columns' array fields."""
    total = F.lit(0.0)
    for part, w in weights.items():
        total = total + F.lit(w) * jaccard(F.col(f"{a}.{part}"), F.col(f"{b}.{part}"))
    return total


def classify_titles(titles: DataFrame, rules: DataFrame, title: str = "section_title", key: str = "table_name") -> DataFrame:
    """``<key>, <one column per rule type>`` from rules ``pos, category, type, pattern``: per type the last match wins; a match of type ``ignore`` drops the table.

    Rules are a short literal list of the caller, held in the expression.
    """
    listed = rules.orderBy("pos").collect()
    types = sorted({r["type"] for r in listed if r["type"] != "ignore"})
    low = F.lower(F.coalesce(F.col(title), F.lit("")))
    ignored = F.lit(False)
    found = {t: F.lit(None).cast("string") for t in types}
    for r in listed:
        hit = low.rlike(f"(?iuU){r['pattern']}")
        if r["type"] == "ignore":
            ignored = ignored | hit
        else:
            found[r["type"]] = F.when(hit, F.lit(r["category"])).otherwise(found[r["type"]])
    return titles.where(~ignored).select(key, *[c.alias(t) for t, c in found.items()])


def map_columns(columns: DataFrame, mapping: DataFrame) -> DataFrame:
    """``table_name, column_name, super_col`` by a listed raw-to-canonical map; unlisted columns have NULL."""
    return columns.join(mapping.select(F.col("raw").alias("column_name"), "super_col"), "column_name", "left").select("table_name", "column_name", "super_col")


def label_and_strength(members: DataFrame, cluster: str = "cluster", label: str = "leaf_header") -> DataFrame:
    """``<cluster>, label, strength, size``: the most frequent label of a cluster and its share; of equal ones the first."""
    counts = members.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy(cluster).agg(F.sum("n").alias("size"), F.min(F.struct(F.negative(F.when(F.col(label).isNotNull(), F.col("n")).otherwise(0)).alias("k"), F.col(label).alias("l"))).alias("b"))
    return sums.select(cluster, F.col("b.l").alias("label"), (F.negative("b.k") / F.col("size")).alias("strength"), "size")


def confidence_to_representative(tables: DataFrame, representatives: DataFrame, cluster: str = "cluster", profile: str = "profile") -> DataFrame:
    """Each table with its similarity to the profile of its cluster's representative."""
    reps = representatives.select(cluster, F.col(profile).alias("rep"))
    return tables.join(reps, cluster, "left").withColumn("confidence", F.coalesce(profile_similarity(profile, "rep"), F.lit(0.0))).drop("rep")


def recategorise(nested: DataFrame, column: str = "mapping") -> DataFrame:
    """``table_name, raw_col, super_col`` from a map of canonical names to lists of raw ones."""
    return nested.select("table_name", F.explode(column).alias("super_col", "raws")).select("table_name", F.explode("raws").alias("raw_col"), "super_col")


#: Similarity that sets a table aside for an earlier seed, and the least one for joining a cluster (fixed values).
STRICT, LOOSE = 0.50, 0.35


def greedy_clusters(
    profiles: DataFrame, key: str = "table_name", order: str = "seq", strict: float = STRICT, loose: float = LOOSE, max_tables: int = 20_000
) -> DataFrame:
    """``<key>, cluster, is_seed, similarity`` by seeds taken in ``order``.

    ``profiles`` has a struct ``profile`` of the arrays in :data:`WEIGHTS`. The
    first table that is not set aside is a seed and sets aside all later ones
    that reach ``strict``. Tables set aside then join, in order, the cluster
    whose united profile is most alike, if it reaches ``loose``, and found one
    otherwise; a cluster grows by each of its tables. Every step depends on the
    ones before, so this runs on the driver, for at most ``max_tables`` tables.
    A cluster is named by its first table.
    """
    if profiles.count() > max_tables:
        raise ValueError(f"more than {max_tables} tables")
    rows = profiles.select(key, order, "profile").collect()
    rows.sort(key=lambda r: (r[order] is None, r[order], r[key]))
    sets = {r[key]: {part: frozenset(r["profile"][part] or ()) for part in WEIGHTS} for r in rows}

    def alike(a: dict, b: dict) -> float:
        return sum(w * (len(a[p] & b[p]) / len(a[p] | b[p]) if a[p] | b[p] else 0.0) for p, w in WEIGHTS.items())

    out, aside, joined = [], [], {}
    taken: set = set()
    for t in sets:
        if t in taken:
            continue
        joined[t] = dict(sets[t])
        out.append((t, t, True, 1.0))
        later = [u for u in sets if u not in taken and u != t and u not in joined and alike(sets[t], sets[u]) >= strict]
        aside += later
        taken.update((t, *later))
    for t in aside:
        score, best = max(((alike(sets[t], fp), -i, c) for i, (c, fp) in enumerate(joined.items())), default=(0.0, 0, None))[::2]
        if best is None or score < loose:
            joined[t] = dict(sets[t])
            out.append((t, t, True, 1.0))
        else:
            joined[best] = {p: joined[best][p] | sets[t][p] for p in WEIGHTS}
            out.append((t, best, False, score))
    kind = profiles.schema[key].dataType.simpleString()
    return profiles.sparkSession.createDataFrame(out, f"`{key}` {kind}, cluster {kind}, is_seed boolean, similarity double")


def leaf_and_parent(h2: Column, h3: Column, h4: Column) -> tuple[Column, Column]:
    """(leaf, parent) names of a table's headings: the leaf is the topmost heading there is, the parent the one above the deepest."""
    from loomtab.functions.text import singularize

    def name(h: Column) -> Column:
        return singularize(F.translate(F.lower(F.trim(h)), " ", "_"))

    def there(h: Column) -> Column:
        return F.coalesce(h != "", F.lit(False))

    leaf = F.when(there(h2), name(h2)).when(there(h3), name(h3)).when(there(h4), name(h4))
    parent = F.when(there(h4) & there(h3), name(h3)).when(there(h2), name(h2))
    return leaf, parent


def fingerprints(tables: DataFrame, categories: DataFrame, columns: DataFrame, key: str = "table_name") -> DataFrame:
    """``<key>, profile``: the sets that tables are compared by (see :data:`WEIGHTS`).

    ``tables`` has the three headings, ``categories`` ``<key>, category`` and
    ``columns`` ``<key>, column_name``. Headings and columns are singular names
    in lower case with underscores; a part without values is an empty set.
    """
    from loomtab.functions.text import singularize

    leaf, parent = leaf_and_parent(F.col("section_h2"), F.col("section_h3"), F.col("section_h4"))
    none = F.array().cast("array<string>")
    one = lambda c: F.array_compact(F.array(c))
    named = singularize(F.translate(F.lower(F.trim("column_name")), " ", "_"))
    kinds = categories.where("category IS NOT NULL").groupBy(key).agg(F.array_sort(F.collect_set("category")).alias("category"))
    listed = columns.where("column_name IS NOT NULL").groupBy(key).agg(F.array_sort(F.collect_set(named)).alias("column"))
    joined = tables.select(key, one(leaf).alias("header"), one(parent).alias("parent")).join(kinds, key, "left").join(listed, key, "left")
    return joined.select(key, F.struct("header", "parent", F.coalesce("category", none).alias("category"), F.coalesce("column", none).alias("column")).alias("profile"))


def cluster_hierarchy(clusters: DataFrame, max_nodes: int = 100_000) -> DataFrame:
    """``name, parent, n_tables`` of a tree over clusters ``name, parent, n_tables``.

    Clusters of equal name and parent are one; of several parents of a name the
    most frequent by tables holds, then the first. Parents without a cluster
    become nodes of their own. No node is its own parent; a node without tables
    and with a single child gives way to it; nodes of a cycle become roots. The
    clusters of a catalogue are few, which is checked, and the tree is shaped
    on the driver.
    """
    sums = clusters.groupBy("name", "parent").agg(F.sum("n_tables").alias("n")).limit(max_nodes + 1).collect()
    if len(sums) > max_nodes:
        raise ValueError(f"more than {max_nodes} clusters")
    tables: dict[str, int] = {}
    parent: dict[str, str | None] = {}
    for r in sorted(sums, key=lambda r: (-r["n"], r["parent"] or "")):
        tables[r["name"]] = tables.get(r["name"], 0) + r["n"]
        parent.setdefault(r["name"], r["parent"] if r["parent"] != r["name"] else None)
    for p in [p for p in parent.values() if p is not None and p not in parent]:
        parent[p], tables[p] = None, 0
    for node in sorted(parent):  # cycles first, so that pruning ends
        seen, at = [], node
        while at is not None and at not in seen:
            seen.append(at)
            at = parent[at]
        if at is not None:
            parent[min(seen[seen.index(at) :])] = None
    while True:
        children: dict[str, list[str]] = {}
        for n, p in parent.items():
            if p is not None:
                children.setdefault(p, []).append(n)
        lone = next((n for n in sorted(parent) if not tables[n] and len(children.get(n, ())) == 1), None)
        if lone is None:
            break
        parent[children[lone][0]] = parent[lone]
        del parent[lone], tables[lone]
    rows = [(n, parent[n], tables[n]) for n in sorted(parent)]
    return clusters.sparkSession.createDataFrame(rows, "name string, parent string, n_tables bigint")
