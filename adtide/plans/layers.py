"""Which stored tables a query reads, and the rule that metric queries read gold and ops only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame

from adtide.sources.tables import LAYERS

#: Layers that metric queries and reviews may read.
SERVED = ("gold", "ops", "users")


class LayerViolation(ValueError):
    """A query reads a table of a layer that is closed to it."""


def _plans(plan) -> Iterator:
    """A plan and those of its subqueries."""
    yield plan
    below = plan.subqueriesAll()
    for at in range(below.size()):
        yield below.apply(at)


def read_paths(df: DataFrame) -> list[str]:
    """Folders and files that the leaf relations of the analysed plan read, in order of their names.

    The plan is only looked at: nothing runs and no files are listed.
    """
    found = set()
    for plan in _plans(df._jdf.queryExecution().analyzed()):
        leaves = plan.collectLeaves()
        for at in range(leaves.size()):
            leaf = leaves.apply(at)
            if leaf.nodeName() != "LogicalRelation":
                continue
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots = relation.location().rootPaths()
                found.update(roots.apply(i).toUri().getPath() for i in range(roots.size()))
    return sorted(found)


def read_tables(df: DataFrame, root: str) -> list[tuple[str, str]]:
    """Layer and name of the stored tables below ``root`` that a query reads."""
    base = root.partition("://")[2] or root
    base = "/" + base.partition("/")[2] if "://" in root else base
    found = set()
    for path in read_paths(df):
        rest = path.removeprefix(base.rstrip("/") + "/")
        layer, _, name = rest.partition("/")
        if rest != path and layer in LAYERS:
            found.add((layer, name.partition("/")[0]))
    return sorted(found)


def refuse_layers(df: DataFrame, root: str, allowed: Sequence[str] = SERVED) -> DataFrame:
    """The query itself, if it reads tables of the allowed layers alone."""
    closed = [f"{layer}.{name}" for layer, name in read_tables(df, root) if layer not in allowed]
    if closed:
        raise LayerViolation(f"reads {', '.join(closed)}; open are {', '.join(allowed)}")
    return df
