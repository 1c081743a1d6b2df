"""Data-quality operators (Q1–Q5): declarative constraint audit, defaults, document validation,
unique-key enforcement, null counts.

The audit evaluates every row-level rule of a table in **one pass** (one aggregate with one
``sum(when(violated))`` per rule); UNIQUE rules are a grouped count, FK rules a left anti join.
Rules are data, not SQL text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.operators.relational import hint_if_few
from bazaar.session import ensure_checkpoint_dir

C = F.col


@dataclass
class Rule:
    name: str
    kind: str                      # NOT_NULL | CHECK | MAX_LENGTH | UNIQUE | FK
    columns: list[str]
    predicate: Column | None = None  # CHECK: condition that must hold (NULL counts as pass, like SQL)
    max_length: int | None = None
    parent: DataFrame | None = field(default=None, repr=False)
    parent_columns: list[str] | None = None


def not_null(col: str) -> Rule:
    return Rule(f"NN_{col}", "NOT_NULL", [col])


def check(name: str, predicate: Column, *cols: str) -> Rule:
    return Rule(name, "CHECK", list(cols), predicate=predicate)


def max_length(col: str, n: int) -> Rule:
    return Rule(f"LEN_{col}_{n}", "MAX_LENGTH", [col], max_length=n)


def unique(*cols: str) -> Rule:
    return Rule("UQ_" + "_".join(cols), "UNIQUE", list(cols))


def foreign_key(cols: list[str], parent: DataFrame, parent_cols: list[str] | None = None) -> Rule:
    return Rule("FK_" + "_".join(cols), "FK", list(cols), parent=parent, parent_columns=parent_cols or list(cols))


def _violated(r: Rule) -> Column:
    if r.kind == "NOT_NULL":
        return C(r.columns[0]).isNull()
    if r.kind == "CHECK":
        return F.coalesce(~r.predicate, F.lit(False))  # UNKNOWN passes a CHECK constraint
    if r.kind == "MAX_LENGTH":
        return F.coalesce(F.length(C(r.columns[0])) > r.max_length, F.lit(False))
    raise ValueError(r.kind)


def audit(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Q1: (table, rule, kind, violations) for every rule. UNIQUE counts the surplus rows (rows
    beyond the first per key, NULLs equal); FK counts child rows whose non-NULL key has no parent."""
    parts = []
    row_rules = [r for r in rules if r.kind in ("NOT_NULL", "CHECK", "MAX_LENGTH")]
    if row_rules:
        one = df.agg(*[F.sum(F.when(_violated(r), 1).otherwise(0)).alias(f"r{i}") for i, r in enumerate(row_rules)])
        stack = ", ".join(f"'{r.name}', '{r.kind}', r{i}" for i, r in enumerate(row_rules))
        parts.append(one.selectExpr(f"stack({len(row_rules)}, {stack}) as (rule, kind, violations)"))
    for r in rules:
        if r.kind == "UNIQUE":
            dup = (df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_n")).filter(C("_n") > 1)
                   .agg(F.coalesce(F.sum(C("_n") - 1), F.lit(0)).alias("violations")))
            parts.append(dup.select(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), "violations"))
        elif r.kind == "FK":
            parent = r.parent.select(*[C(p).alias(c) for p, c in zip(r.parent_columns, r.columns)]).distinct()
            child = df.select(*r.columns).filter(F.greatest(*[C(c).isNotNull() for c in r.columns])
                                                 if len(r.columns) > 1 else C(r.columns[0]).isNotNull())
            orphans = child.join(parent, r.columns, "left_anti").agg(F.count(F.lit(1)).alias("violations"))
            parts.append(orphans.select(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table"), "rule", "kind", C("violations").cast("bigint").alias("violations"))


def rejected_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows failing any row-level rule, with the names of the failed rules."""
    reasons = F.filter(F.array(*[F.when(_violated(r), F.lit(r.name)) for r in rules
                                 if r.kind in ("NOT_NULL", "CHECK", "MAX_LENGTH")]), lambda x: x.isNotNull())
    return df.withColumn("failed_rules", reasons).filter(F.size("failed_rules") > 0)


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Q2: column DEFAULTs on ingest — NULL → default (typed like the column)."""
    out = df
    for col_name, value in defaults.items():
        out = out.withColumn(col_name, F.coalesce(C(col_name), F.lit(value).cast(df.schema[col_name].dataType)))
    return out


def validate_documents(docs: DataFrame, required: list[str], rules: list[Rule]) -> DataFrame:
    """Q3: $jsonSchema validation (required fields, type/range/length rules) → every document with
    ``rejection`` = first failed rule, or NULL when valid (validationAction "error" rejects it)."""
    checks = [(f"required:{c}", C(c).isNull()) for c in required] + [(r.name, _violated(r)) for r in rules]
    reason = None
    for name, bad in checks:
        reason = F.when(bad, F.lit(name)) if reason is None else reason.when(bad, F.lit(name))
    return docs.withColumn("rejection", reason)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q4: key values occurring more than once. NULLs count as equal, as in the unique constraints and indexes of
    both sources."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(C("copies") > 1)


def enforce_unique(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Q4: keep one row per key — the first by ``order`` (deterministic, unlike dropDuplicates)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(C("_r") == 1).drop("_r")


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q5: rows with a NULL in any of ``cols`` and per-column NULL counts, in one pass."""
    any_null = F.greatest(*[C(c).isNull() for c in cols]) if len(cols) > 1 else C(cols[0]).isNull()
    return df.agg(F.sum(F.when(any_null, 1).otherwise(0)).cast("bigint").alias("rows_with_nulls"),
                  *[F.sum(F.when(C(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"nulls_{c}") for c in cols])


def compare_by_range(a: DataFrame, b: DataFrame, key: str, width: int) -> DataFrame:
    """(range, left_rows, right_rows, equal) for every range of ``width`` values of the whole-number column ``key``:
    whether both tables hold the same rows as often there, in any order.

    Rows are never sorted, joined or moved: each side is digested per range by the row count and the sums of two independent
    64-bit hashes of its rows, in one map-side aggregate over both. Different contents have equal digests with a probability
    of about 2**-128. Columns are those of ``a``, cast to its types in ``b``; a null key has a range of its own (null)."""
    def hashed(df, left):
        cols = [C(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in a.schema.fields]
        flags = [C(f"`{f.name}`").isNull() for f in a.schema.fields]
        # the halves of a 64-bit hash are summed on their own: their sums stay whole numbers of 64 bits
        h, g = F.xxhash64(*cols, *flags), F.xxhash64(F.lit("second"), *flags, *reversed(cols))
        halves = {"_h0": F.shiftrightunsigned(h, 32), "_h1": h.bitwiseAND(0xFFFFFFFF), "_g0": F.shiftrightunsigned(g, 32), "_g1": g.bitwiseAND(0xFFFFFFFF)}
        return df.select(F.floor(C(key) / width).cast("bigint").alias("range"), F.lit(left).alias("_l"), *[(v * left).alias(n) for n, v in halves.items()])
    both = hashed(a, 1).unionByName(hashed(b, -1))
    sums = ["_h0", "_h1", "_g0", "_g1"]
    g = both.groupBy("range").agg(F.count(F.when(C("_l") == 1, 1)).alias("left_rows"), F.count(F.when(C("_l") == -1, 1)).alias("right_rows"), *[F.sum(n).alias(n) for n in sums])
    same = C("left_rows") == C("right_rows")
    for n in sums:
        same = same & (C(n) == 0)
    return g.select("range", "left_rows", "right_rows", same.alias("equal"))


def differing_rows(a: DataFrame, b: DataFrame, key: str, width: int) -> DataFrame:
    """The rows of one side that the other has less often, with ``_side`` (left_only, right_only). Only the ranges whose digests
    differ (``compare_by_range``) are looked at again, by the digests of their single keys, and only the rows of keys that differ
    are shuffled and compared row by row. Each side is read three times: hand over tables that are materialised."""
    ensure_checkpoint_dir(a.sparkSession)
    cols = [C(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in a.schema.fields]
    a, b = a.select(*cols), b.select(*cols)
    near = [a, b]
    for w in (width, 1):
        bad = compare_by_range(*near, key, w).filter(~C("equal")).select(C("range").alias("_r"))
        # its size is known before the rows are read, which are only shuffled for it if it is long
        bad = hint_if_few(bad.checkpoint(eager=True), 250_000)
        near = [x.join(bad, F.floor(C(key) / w).cast("bigint").eqNullSafe(C("_r")), "left_semi") for x in (a, b)]
    signed = near[0].withColumn("_n", F.lit(1)).unionByName(near[1].withColumn("_n", F.lit(-1)))
    n = signed.groupBy(*[C(f"`{f.name}`") for f in a.schema.fields]).agg(F.sum("_n").alias("_n")).filter(C("_n") != 0)
    side = F.when(C("_n") > 0, "left_only").otherwise("right_only")
    n = n.withColumn("_side", side).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))))
    return n.select(*[C(f"`{f.name}`") for f in a.schema.fields], "_side")
