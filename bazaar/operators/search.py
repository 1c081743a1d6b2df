"""Dynamic search, sorting and paging."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions.expr import and_all

C = F.col

# Page size default / bounds and the whitelisted sort keys of the search procedure.
DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE = 25, 500
SORT_WHITELIST = ("PlacedAt", "TotalAmount", "OrderStatus", "CustomerID")


def optional_eq(column: str, value) -> Column | None:
    """``@p IS NULL OR col = @p`` — no predicate at all when the argument is None.

    Text compares without regard to case, as under the reference's collation (M4)."""
    if value is None:
        return None
    return F.lower(C(column)) == value.lower() if isinstance(value, str) else C(column) == F.lit(value)


def fold_predicates(preds: list[Column | None]) -> Column:
    """AND of the provided predicates (the reference concatenates SQL text instead)."""
    return and_all(preds)


def clamp_page(page: int | None, size: int | None) -> tuple[int, int]:
    """S5 clamps: page ≥ 1; size < 1 → 25; size > 500 → 500."""
    page = 1 if page is None or page < 1 else page
    if size is None or size < 1:
        size = DEFAULT_PAGE_SIZE
    return page, min(size, MAX_PAGE_SIZE)


def sort_spec(sort_by: str | None, sort_dir: str | None, key: str) -> list[Column]:
    """Whitelisted sort key with fallback to PlacedAt DESC; ``key`` appended as tie-breaker."""
    sb = sort_by if sort_by in SORT_WHITELIST else "PlacedAt"
    sd = (sort_dir or "").upper()
    sd = sd if sd in ("ASC", "DESC") else "DESC"
    first = C(sb).asc() if sd == "ASC" else C(sb).desc()
    return [first, C(key).asc()]


def page(df: DataFrame, order: list[Column], page_number: int, page_size: int) -> DataFrame:
    """ORDER BY … OFFSET (p-1)*n ROWS FETCH NEXT n ROWS ONLY."""
    return df.orderBy(*order).offset((page_number - 1) * page_size).limit(page_size)


def total_pages(total: int, size: int) -> int:
    return -(-total // size) if size else 0


@dataclass
class KeysetCursor:
    """Keyset pagination (the variant the reference names): next page = rows strictly after the
    last (sort value, key) of the previous page. No OFFSET scan."""

    sort_col: str
    key: str
    descending: bool = True

    def next_page(self, df: DataFrame, last_value, last_key, size: int) -> DataFrame:
        if last_value is None:
            cond = F.lit(True)
        elif self.descending:
            cond = (C(self.sort_col) < F.lit(last_value)) | ((C(self.sort_col) == F.lit(last_value)) & (C(self.key) > F.lit(last_key)))
        else:
            cond = (C(self.sort_col) > F.lit(last_value)) | ((C(self.sort_col) == F.lit(last_value)) & (C(self.key) > F.lit(last_key)))
        first = C(self.sort_col).desc() if self.descending else C(self.sort_col).asc()
        return df.filter(cond).orderBy(first, C(self.key).asc()).limit(size)
