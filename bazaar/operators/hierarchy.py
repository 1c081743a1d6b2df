"""Hierarchy operators.

The reference walks a tree level by level with a recursive CTE: anchor = active roots, recursive member =
active children of the current frontier. Here the tree is folded by **pointer doubling**: every node keeps
a pointer to an ancestor and what lies between (names, ids, depth, sums). In a round each open node takes
over its pointer's pointer and puts that node's stretch in front of its own, so stretches double and a tree
of depth d takes log2(d) + 2 rounds instead of d. A round is one join on the pointer plus one reliable
``checkpoint()``; nodes that have reached their root leave the rounds.

A round in which no node gets through leaves only nodes on or below a cycle: they never reach a root and are
absent, the same as in the reference. ``parent_cycles`` reports them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.session import ensure_checkpoint_dir

C = F.col


def _double(state: DataFrame, merge, rounds: list | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(nodes that reached a root, nodes that never do) of ``state``: (_id, _up, columns), _up null at roots.

    ``merge(above, own)`` gives the merged columns of a node from those of the node it points to (aliases ``a`` and
    ``o``). Nodes whose pointer is no node at all are dropped, and so is what hangs on them. ``rounds`` collects the
    number of open nodes after every round."""
    ensure_checkpoint_dir(state.sparkSession)
    columns = state.columns[2:]
    state = state.checkpoint(eager=True)
    done, open_ = [state.filter(C("_up").isNull())], state.filter(C("_up").isNotNull())
    n_open = open_.count()
    while n_open:
        known = reduce(DataFrame.unionByName, done, open_)
        new = (open_.alias("o").join(known.alias("a"), C("o._up") == C("a._id"))
               .select(C("o._id").alias("_id"), C("a._up").alias("_up"), *[m.alias(c) for c, m in zip(columns, merge("a", "o"))]))
        new = new.checkpoint(eager=True)
        through, left = new.agg(F.count(F.when(C("_up").isNull(), 1)), F.count("_up")).first()
        if rounds is not None:
            rounds.append(left)
        done.append(new.filter(C("_up").isNull()))
        open_ = new.filter(C("_up").isNotNull())
        if not through and left == n_open:
            return reduce(DataFrame.unionByName, done), open_
        n_open = left
    return reduce(DataFrame.unionByName, done), None


def lineage(nodes: DataFrame, id_col: str, parent_col: str, texts: dict[str, tuple[str, str]] | None = None,
            sums: dict[str, str] | None = None, keep: tuple[str, ...] = (), max_depth: int | None = None, rounds: list | None = None) -> DataFrame:
    """(id, parent, keep, Depth, RootID, texts, sums) for every node that reaches a root (null parent).

    ``texts``: output → (column, separator): the column's values from the root down to the node, joined.
    ``sums``: output → column: their sum (null counts as 0). Without texts a row stays narrow however deep the tree.
    ``max_depth``: raises RecursionError for a deeper tree (default: any depth). Ids are unique and not null."""
    texts, sums = texts or {}, sums or {}
    state = nodes.select(C(id_col).alias("_id"), C(parent_col).alias("_up"), C(parent_col).alias("_parent"),
                         F.when(C(parent_col).isNull(), 0).otherwise(1).cast("bigint").alias("_depth"),
                         F.when(C(parent_col).isNull(), C(id_col)).alias("_root"),
                         *[C(k).alias(f"_k_{k}") for k in keep], *[C(c).cast("string").alias(f"_t_{o}") for o, (c, _) in texts.items()],
                         *[F.coalesce(C(c), F.lit(0)).cast("bigint").alias(f"_s_{o}") for o, c in sums.items()])

    def merge(a, o):
        return [C(f"{o}._parent"), C(f"{a}._depth") + C(f"{o}._depth"), C(f"{a}._root"), *[C(f"{o}._k_{k}") for k in keep],
                *[F.concat(C(f"{a}._t_{t}"), F.lit(sep), C(f"{o}._t_{t}")) for t, (_, sep) in texts.items()],
                *[C(f"{a}._s_{s}") + C(f"{o}._s_{s}") for s in sums]]

    reached, _ = _double(state, merge, rounds)
    if max_depth is not None and (reached.agg(F.max("_depth")).first()[0] or 0) > max_depth:
        raise RecursionError(f"the tree has more than {max_depth} levels below its roots")
    return reached.select(C("_id").alias(id_col), C("_parent").alias(parent_col), *[C(f"_k_{k}").alias(k) for k in keep], C("_depth").alias("Depth"), C("_root").alias("RootID"),
                          *[C(f"_t_{t}").alias(t) for t in texts], *[C(f"_s_{s}").alias(s) for s in sums])


def parent_cycles(nodes: DataFrame, id_col: str, parent_col: str, rounds: list | None = None) -> DataFrame:
    """(id, OnCycle) of the nodes whose parents never end: those on a cycle, and those that hang below one.

    After enough doublings every pointer of such a node lies on a cycle, and every node of a cycle is some pointer.
    The set of pointers only shrinks, and it shrinks in every doubling until that is so."""
    state = nodes.select(C(id_col).alias("_id"), C(parent_col).alias("_up"))
    _, open_ = _double(state, lambda a, o: [], rounds)
    if open_ is None:
        return nodes.select(C(id_col), F.lit(True).alias("OnCycle")).limit(0)
    ends = open_.select(C("_up").alias("_e")).distinct()
    size = ends.count()
    while True:
        further = open_.alias("o").join(open_.alias("a"), C("o._up") == C("a._id")).select(C("o._id").alias("_id"), C("a._up").alias("_up"))
        open_ = further.checkpoint(eager=True)
        ends, before = open_.select(C("_up").alias("_e")).distinct(), size
        size = ends.count()
        if rounds is not None:
            rounds.append(size)
        if size == before:
            return open_.join(ends, C("_id") == C("_e"), "left").select(C("_id").alias(id_col), C("_e").isNotNull().alias("OnCycle"))


def tree_walk(nodes: DataFrame, id_col: str = "CategoryID", parent_col: str = "ParentCategoryID",
              name_col: str = "CategoryName", active_col: str | None = "IsActive", max_depth: int | None = None,
              path_sep: str = " > ", id_sep: str = ".", rounds: list | None = None) -> DataFrame:
    """H1: (id, parent, name, Depth, BreadcrumbPath, IDPath) for every node reachable from an
    active root through active nodes."""
    base = nodes.filter(C(active_col)) if active_col else nodes
    base = base.select(C(id_col), C(parent_col), C(name_col))
    out = lineage(base, id_col, parent_col, {"BreadcrumbPath": (name_col, path_sep), "IDPath": (id_col, id_sep)}, keep=(name_col,),
                  max_depth=max_depth, rounds=rounds)
    return out.select(id_col, parent_col, name_col, C("Depth").cast("int").alias("Depth"), "BreadcrumbPath", "IDPath")


def tree_display(tree: DataFrame, name_col: str = "CategoryName", indent: str = "  ") -> "F.Column":
    """H2: REPLICATE('  ', Depth) + name."""
    return F.concat(F.repeat(F.lit(indent), C("Depth")), C(name_col))


def parent_breadcrumb(nodes: DataFrame, id_col="CategoryID", parent_col="ParentCategoryID",
                      name_col="CategoryName") -> DataFrame:
    """One-level breadcrumb ``COALESCE(parent + ' > ', '') + name`` via a left self join."""
    parent = nodes.select(C(id_col).alias("_pid"), C(name_col).alias("_pname"))
    return (nodes.join(parent, C(parent_col) == C("_pid"), "left")
            .select(*[C(c) for c in nodes.columns],
                    F.concat(F.coalesce(F.concat(C("_pname"), F.lit(" > ")), F.lit("")), C(name_col))
                    .alias("CategoryPath")))
