"""Sort, page and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley import catalog as K
from parley.schemas import CAMEL_TO_SNAKE


def _page(page: int | None, limit: int | None) -> tuple[int, int]:
    page = K.PAGE_DEFAULT if page is None or page < 1 else int(page)
    limit = K.PAGE_LIMIT_DEFAULT if limit is None else int(limit)
    if not 1 <= limit <= K.PAGE_LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {K.PAGE_LIMIT_MAX}")
    return page, limit


def _order(sort: str, order: str, key: str) -> list[Column]:
    if order not in ("asc", "desc"):
        raise ValueError("order must be 'asc' or 'desc'")
    if order == "desc":
        return [F.col(sort).desc_nulls_last(), F.col(key).desc()]
    return [F.col(sort).asc_nulls_first(), F.col(key).asc()]   # the store sorts missing values lowest


def paginate(df: DataFrame, page: int = 1, limit: int = 20, sort: str = "created_at",
             order: str = "desc", key: str = "conversation_id", after=None) -> DataFrame:
    """One page plus ``page``, ``limit``, ``total`` and ``pages`` columns.

    ``total`` is a scalar subquery (one aggregate, no join). The page itself is
    a top-(offset+limit) (``TakeOrderedAndProject``): each task keeps only that
    many rows. For deep pages pass ``after=(sort_value, key_value)`` of the
    last row seen: a keyset cursor that filters instead of skipping.
    A limit outside 1..100 is an error; pages below 1 become 1.
    """
    page, limit = _page(page, limit)
    sort = CAMEL_TO_SNAKE.get(sort) or sort        # the documented API spells it createdAt
    total = df.select(F.count(F.lit(1))).scalar()
    rows = df
    offset = (page - 1) * limit
    if after is not None:
        sort_v, key_v = after
        s, k = F.col(sort), F.col(key)
        if order == "desc":
            # missing values come last, among themselves by key
            cond = (s.isNull() & (k < F.lit(key_v))) if sort_v is None else (
                (s < F.lit(sort_v)) | ((s == F.lit(sort_v)) & (k < F.lit(key_v))) | s.isNull())
        else:
            # missing values come first
            cond = ((s.isNull() & (k > F.lit(key_v))) | s.isNotNull()) if sort_v is None else (
                (s > F.lit(sort_v)) | ((s == F.lit(sort_v)) & (k > F.lit(key_v))))
        rows, offset = rows.filter(cond), 0
    ordered = rows.orderBy(*_order(sort, order, key))
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(limit).select(
        "*", F.lit(page).alias("page"), F.lit(limit).alias("limit"),
        total.alias("total"), F.ceil(total / F.lit(limit)).cast("long").alias("pages"))


def recent_conversations(c: DataFrame, k: int) -> DataFrame:
    """The k most recent conversations of every user (``rank`` 1..k).

    ``row_number() <= k`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so at most k rows per user leave each map task and a
    user with millions of conversations does not overload one reducer.
    """
    w = Window.partitionBy("user_id").orderBy(F.col("last_message_at").desc_nulls_last(),
                                              F.col("conversation_id"))
    return (c.withColumn("rank", F.row_number().over(w).cast("long"))
             .filter(F.col("rank") <= k))
