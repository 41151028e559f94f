"""Lookups and string forms."""

from __future__ import annotations

from collections.abc import Mapping

from waybill.functions.numeric import text


def lookup_or_key(key: str, mapping: Mapping[str, str]) -> str:
    """The label of ``key``, or the key itself where it has none."""
    pairs = ", ".join(f"{text(k)}, {text(v)}" for k, v in mapping.items())
    return f"coalesce(try_element_at(map({pairs}), {key}), {key})"


def month_of_file(path: str, stem: str) -> str:
    """``<stem>_YYYY_MM...`` -> ``YYYY-MM``; NULL for other names."""
    pattern = text(rf"{stem}_(\d{{4}}_\d{{2}})")
    return f"nullif(replace(regexp_extract({path}, {pattern}, 1), '_', '-'), '')"
