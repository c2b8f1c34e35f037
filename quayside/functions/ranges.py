"""Arithmetic of pages and offset ranges."""

from __future__ import annotations

MIN_PAGE_SIZE = 2


def check_page_size(page_size: int) -> None:
    if page_size < MIN_PAGE_SIZE:
        raise ValueError(f"a page holds at least {MIN_PAGE_SIZE} records, not {page_size}")


def range_size(count: int, ranges: int) -> int:
    """Offsets per range when 0 … count (both included) are split into contiguous ranges of equal size."""
    if ranges < 1:
        raise ValueError("offsets are split into at least one range")
    return -((count + 1) // -ranges)


def offset_ranges(count: int, ranges: int) -> list[range]:
    """The ranges themselves. The offset `count` is in the plan though no record stands there."""
    size = range_size(count, ranges)
    return [range(low, min(low + size, count + 1)) for low in range(0, count + 1, size)]
