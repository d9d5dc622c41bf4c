"""0/1 flags of an event. A null page or level sets no flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playtrail.schema import PAGE_FLAGS, PAID_LEVEL


def page_flag(page: str) -> Column:
    return F.expr(f"int(page <=> '{page}')")


def paid_flag() -> Column:
    return F.expr(f"int(level <=> '{PAID_LEVEL}')")


def flag_columns() -> dict[str, Column]:
    flags = {name: page_flag(page) for name, page in PAGE_FLAGS.items()}
    flags["payingUser"] = paid_flag()
    return flags


def flag_sum(flag: str, alias: str) -> Column:
    """Aggregate: how many events set the flag."""
    return F.expr(f"sum(int(page <=> '{PAGE_FLAGS[flag]}')) AS {alias}")
