"""A class tree with rules: paths, ancestors, nearest common ancestors, and rule matching."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A taxonomy is a hand-made list; more nodes than this are refused, as the tree is walked on the driver.
MAX_NODES = 100_000


def paths(nodes: DataFrame, name: str = "name", parent: str = "parent", max_nodes: int = MAX_NODES) -> DataFrame:
    """``name, root, depth, path``: the chain from the root to each node.

    The edges are few by nature, which is checked, and the closure is walked
    once on the driver, so plans that use it hold a literal list and no chain
    of self-joins. Nodes under an unknown parent and nodes of a cycle have no
    path. A name with two parents keeps the smaller one.
    """
    edges = nodes.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(parent).alias("parent")).limit(max_nodes + 1).collect()
    if len(edges) > max_nodes:
        raise ValueError(f"more than {max_nodes} nodes")
    above = {e["name"]: e["parent"] for e in edges}
    rows = []
    for node in sorted(above):
        chain, at = [node], above[node]
        while at in above and at not in chain:
            chain.append(at)
            at = above[at]
        if at is None:
            rows.append((node, chain[-1], len(chain) - 1, chain[::-1]))
    return nodes.sparkSession.createDataFrame(rows, "name string, root string, depth int, path array<string>")


def path_text(path: Column) -> Column:
    return F.array_join(path, ">")


def ancestor(path: Column, depth: int) -> Column:
    """The node of a path at a depth from the root, counting from 0; NULL beyond its end."""
    return F.get(path, F.lit(depth))


def entities(nodes: DataFrame, kind: str | None = None) -> DataFrame:
    """All named entities, or those of one kind."""
    return nodes.where(F.col("name").isNotNull() if kind is None else F.col("kind") == kind)


def descendants(paths_: DataFrame, name: str) -> DataFrame:
    """The paths that lead to or through an entity; empty for an unknown one."""
    return paths_.where(F.array_contains("path", name))


def properties_of_classes(domains: DataFrame, paths_: DataFrame) -> DataFrame:
    """``entity, property, super_col``: each class with its own properties and those of its ancestors.

    ``domains`` has ``property, entity, super_col``: the class that a property is
    declared for. Properties of unknown classes stay with these alone.
    """
    lines = paths_.select("name", F.explode("path").alias("entity"))
    own = domains.select("property", "entity", "super_col").where("entity IS NOT NULL")
    climbed = own.join(lines, "entity", "left").select(F.coalesce("name", "entity").alias("entity"), "property", "super_col")
    return climbed.distinct()


def common_prefix(paths_: Column) -> Column:
    """The longest common beginning of an array of paths."""
    first = F.element_at(paths_, 1)

    def shared(acc: Column, p: Column) -> Column:
        same = F.sequence(F.lit(1), F.least(F.size(acc), F.size(p)))
        differ = F.filter(same, lambda i: F.element_at(acc, i) != F.element_at(p, i))
        upto = F.coalesce(F.array_min(differ) - 1, F.least(F.size(acc), F.size(p)))
        return F.when((F.size(acc) == 0) | (F.size(p) == 0), F.slice(acc, 1, 0)).otherwise(F.slice(acc, F.lit(1), upto))

    return F.aggregate(paths_, first, shared)


def nearest_common_ancestor(paths_: Column) -> Column:
    """The last node of the common beginning; NULL if even the roots differ or there is no path."""
    prefix = common_prefix(paths_)
    return F.when(F.size(paths_) > 0, F.when(F.size(prefix) > 0, F.element_at(prefix, -1)))


def leafmost(paths_: Column) -> Column:
    """The paths that no other path goes on from: the documented intent of collapsing to leaves."""
    return F.filter(
        paths_, lambda p: ~F.exists(paths_, lambda q: (F.size(q) > F.size(p)) & (F.slice(q, F.lit(1), F.size(p)) == p))
    )


def rules_of(entities: DataFrame) -> DataFrame:
    """``entity, kind, pattern, super_col`` from rows with a list of patterns; a ``regex:`` prefix in any case is cut off."""
    return entities.select(
        "entity", "kind", F.explode("patterns").alias("pattern"), "super_col"
    ).select("entity", "kind", F.trim(F.regexp_replace("pattern", "(?i)^regex:", "")).alias("pattern"), "super_col").where("pattern <> ''")


def match_rules(texts: DataFrame, rules: DataFrame, text: str = "text", max_rules: int = 10_000) -> DataFrame:
    """``text, entity, kind, super_col``: each rule whose pattern occurs in a distinct lower-cased text.

    Texts are deduplicated first and matched once; join the result back. The
    rule list is a parameter of fixed size (checked against ``max_rules``), so
    it is held as literals in one generated expression and no pairs are made.
    Patterns match without regard to case, with Unicode classes.
    """
    listed = rules.select("entity", "kind", "pattern", "super_col").limit(max_rules + 1).collect()
    if len(listed) > max_rules:
        raise ValueError(f"more than {max_rules} rules")
    distinct = texts.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    if not listed:
        return distinct.select("text", *[F.lit(None).cast("string").alias(c) for c in ("entity", "kind", "super_col")]).where("false")
    low = F.lower("text")

    def hit(r) -> Column:
        told = F.struct(F.lit(r["entity"]).alias("entity"), F.lit(r["kind"]).alias("kind"), F.lit(r["super_col"]).cast("string").alias("super_col"))
        return F.when(low.rlike(f"(?iuU){r['pattern']}"), told)

    # rules whose matches must hold some plain text are asked only where that text stands
    groups: dict[str, list] = {}
    for r in listed:
        groups.setdefault(literal_of(r["pattern"]), []).append(r)
    empty = F.array().cast("array<struct<entity:string,kind:string,super_col:string>>")
    parts = [
        tried if not text_ else F.when(F.contains(low, F.lit(text_)), tried).otherwise(empty)
        for text_, tried in ((t, F.array_compact(F.array(*map(hit, rs)))) for t, rs in sorted(groups.items()))
    ]
    return distinct.select("text", F.flatten(F.array(*parts)).alias("hits")).select("text", F.inline_outer("hits")).where("entity IS NOT NULL")


def literal_of(pattern: str) -> str:
    """A plain ASCII text that every match of a simple pattern holds; empty if the pattern is not simple.

    Only whole words between ``\\b`` with at most one final optional sign are
    read (as :func:`name_rules` writes them); the first word is enough. Signs
    that have other forms of the same letter without regard to case are not read.
    """
    simple = re.match(r"^\\b([a-hj-rt-z0-9 is]+?)(?:s\?)?\\b$", pattern)
    if simple is None:
        return ""
    # i, k and s have look-alikes in other alphabets that match without regard to case
    words = [w for w in re.split(r"[iks]", simple.group(1)) if w.strip()]
    return max(words, key=len).strip() if words else ""


def name_rules(nodes: DataFrame) -> DataFrame:
    """Rules from the taxonomy's own names: each name, singular, as a whole word or with a plural ending."""
    escaped = F.regexp_replace(F.lower("name"), r"([.()\[\]^$*+?|\\{}-])", r"\\$1")
    return nodes.select(
        F.col("name").alias("entity"), "kind", F.concat(F.lit(r"\b"), F.regexp_replace(escaped, "s$", ""), F.lit(r"s?\b")).alias("pattern"),
        F.lit(None).cast("string").alias("super_col"),
    )
