"""A sale's duration and residency as one long, so that picking the best is a hash aggregation.

Duration takes the high 32 bits and the residency code the low ones: a longer license wins, then the larger code
(resident over nonresident).  NULL is held as the least int and ranks last; all other values come back as they went in.
"""

_NULL = -2147483648
_LOW = 4294967295

RANK_KEY = f"""
    shiftleft(cast(coalesce(duration, {_NULL}) as bigint), 32)
    + (cast(coalesce(res, {_NULL}) as bigint) - cast({_NULL} as bigint))
"""

#: of ``rank`` (the above) and ``month``: larger for a higher rank, then for an earlier month; NULL ranks last
RANK_MONTH = "cast(rank as decimal(20)) * 8589934592 + coalesce(2147483648 - cast(month as bigint), 0)"


def duration_of(key: str) -> str:
    return f"nullif(cast(shiftright({key}, 32) as int), {_NULL})"


def res_of(key: str) -> str:
    return f"nullif(cast(({key} & {_LOW}L) + cast({_NULL} as bigint) as int), {_NULL})"


def years_of(key: str) -> str:
    """License years a sale covers: a missing duration or one below 1 counts as one year; NULL without a sale."""
    return f"if({key} is null, null, greatest(coalesce({duration_of(key)}, 1), 1))"
