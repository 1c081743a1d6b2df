"""Normal forms from given functional dependencies (N2, N3): closure, minimal cover, synthesis, split and check.

Dependencies are a short list of (left columns, right columns); what is computed from them is metadata on the driver.
The rows are only ever split (distinct projections), checked (one aggregate a relation) and joined by Spark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

C = F.col
Dependency = tuple[tuple[str, ...], tuple[str, ...]]


@dataclass(frozen=True)
class Relation:
    """Columns of a relation, its key first."""

    key: tuple[str, ...]
    columns: tuple[str, ...]


def closure(columns, dependencies: list[Dependency]) -> frozenset[str]:
    """All columns that ``columns`` determine."""
    known = set(columns)
    waiting = {i: set(left) - known for i, (left, _) in enumerate(dependencies)}
    ready = [i for i, w in waiting.items() if not w]
    while ready:
        i = ready.pop()
        del waiting[i]
        for c in set(dependencies[i][1]) - known:
            known.add(c)
            for j, w in waiting.items():
                if c in w:
                    w.discard(c)
                    if not w and j not in ready:
                        ready.append(j)
    return frozenset(known)


def minimal_cover(dependencies: list[Dependency]) -> list[tuple[tuple[str, ...], str]]:
    """Equivalent dependencies with one column on the right, none superfluous on the left, none that follows from the others."""
    cover = list(dict.fromkeys((tuple(left), c) for left, right in dependencies for c in right if c not in left))

    def as_given():
        return [(left, (c,)) for left, c in cover]
    for i, (left, c) in enumerate(cover):
        for x in left:
            less = tuple(y for y in cover[i][0] if y != x)
            if less and c in closure(less, as_given()):
                cover[i] = (less, c)
    cover = list(dict.fromkeys(cover))
    for dep in list(cover):
        rest = [(left, (c,)) for left, c in cover if (left, c) != dep]
        if dep[1] in closure(dep[0], rest):
            cover.remove(dep)
    return cover


def candidate_key(columns, dependencies: list[Dependency]) -> tuple[str, ...]:
    """A key of the whole table: columns are left out from the last on as long as the rest determines all."""
    key = list(columns)
    for c in reversed(list(columns)):
        rest = [k for k in key if k != c]
        if rest and closure(rest, dependencies) >= set(columns):
            key = rest
    return tuple(key)


def synthesise(columns, dependencies: list[Dependency]) -> list[Relation]:
    """Third normal form by synthesis: lossless and dependency-preserving relations, in the order of the dependencies.

    Dependencies whose left sides determine each other share a relation. If no relation holds a key of the whole table,
    one with a key and nothing else is added. A relation within another is left out."""
    columns = tuple(columns)
    unknown = {c for left, right in dependencies for c in (*left, *right)} - set(columns)
    if unknown:
        raise ValueError(f"dependencies name columns that the table has not: {sorted(unknown)}")
    cover = minimal_cover(dependencies)
    plain = [(left, (c,)) for left, c in cover]
    groups: list[tuple[tuple[str, ...], list[str]]] = []
    for left, c in cover:
        found = next((g for g in groups if closure(g[0], plain) >= set(left) and closure(left, plain) >= set(g[0])), None)
        if found is None:
            groups.append((left, [c]))
        else:
            found[1].extend(x for x in (*left, c) if x not in found[0] and x not in found[1])
    relations = [Relation(key, (*key, *(c for c in columns if c in rest))) for key, rest in groups]
    relations = [r for r in relations if not any(set(r.columns) < set(o.columns) for o in relations)]
    if not any(closure(r.columns, plain) >= set(columns) for r in relations):
        key = candidate_key(columns, plain)
        relations.append(Relation(key, key))
    return relations


def split(df: DataFrame, relations: list[Relation]) -> list[DataFrame]:
    """The table's rows projected to every relation, duplicates combined map-side."""
    return [df.select(*r.columns).distinct() for r in relations]


def key_violations(parts: list[DataFrame], relations: list[Relation]) -> list[DataFrame]:
    """Per relation the keys with more than one row: where the data contradict the dependencies."""
    return [p.groupBy(*r.key).agg(F.count(F.lit(1)).alias("rows")).filter(C("rows") > 1) for p, r in zip(parts, relations)]


def rejoin(parts: list[DataFrame], relations: list[Relation], dependencies: list[Dependency]) -> DataFrame:
    """The table put together again: from the relation that holds a key of all columns outward, along keys (nulls equal)."""
    every = {c for r in relations for c in r.columns}
    start = next(i for i, r in enumerate(relations) if closure(r.columns, dependencies) >= every)
    out, left = parts[start], [i for i in range(len(parts)) if i != start]
    while left:
        i = next((i for i in left if set(relations[i].key) <= set(out.columns)), None)
        if i is None:
            raise ValueError("no relation left whose key is known")
        left.remove(i)
        r = relations[i]
        new = [c for c in r.columns if c not in out.columns]
        side = parts[i].select(*[C(k).alias(f"_j_{k}") for k in r.key], *new)
        on = None
        for k in r.key:
            same = C(k).eqNullSafe(C(f"_j_{k}"))
            on = same if on is None else on & same
        out = out.join(side, on, "left").drop(*[f"_j_{k}" for k in r.key])
    return out
