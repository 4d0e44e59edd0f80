"""Derived scalars as Spark SQL text: identifiers, label text, presence flags, object members."""

from __future__ import annotations

from collections.abc import Callable

from . import variant as V
from .variant import Node

# Entity prefixes of change-log ids, and stat-id markers in test order.
ENTITY_PREFIXES = ("ord", "cust", "pay", "lead", "lds", "sub", "del")
STAT_MARKERS = (("SALES-STATS", "sales"), ("PICKING-STATS", "picking"), ("STATS", "business"))
AGENT_LIST_MARKER = "AVAILABLE-AGENTS"


def _plain_text(node: Node) -> str:
    """The unwrapped value where it is real text, not an object id or a number."""
    value = node.value()
    if node.text:
        # Text that opens with a letter is text: numbers, containers and flags do not.
        letter = f"lower(substring({node.text}, 1, 1)) BETWEEN 'a' AND 'z' AND {node.text} NOT IN ('true', 'false')"
        return f"CASE WHEN {letter} THEN {node.text} WHEN {V.kind_of(value)} = 'STRING' THEN {V.text_of(value)} END"
    return f"if({V.kind_of(value)} = 'STRING', {V.text_of(value)}, NULL)"


def _where_present(node: Node, then: str) -> str:
    return f"if({node.present()}, {then}, NULL)"


def entity_type(node: Node) -> str:
    text = _plain_text(node)
    pattern = "^(" + "|".join(ENTITY_PREFIXES) + ")_"
    prefix = f"regexp_extract({text}, '{pattern}', 1)"
    return _where_present(node, f"coalesce(coalesce(nullif({prefix}, ''), if({text} IS NULL, NULL, 'other')), 'unknown')")


def stat_type(node: Node) -> str:
    text = _plain_text(node)
    arms = " ".join(f"WHEN contains({text}, '{mark}') THEN '{name}'" for mark, name in STAT_MARKERS)
    return _where_present(node, f"CASE {arms} ELSE 'unknown' END")


def stat_agent(node: Node) -> str:
    return f"get(split({_plain_text(node)}, '-'), 2)"


def has_agent_list(node: Node) -> str:
    return _where_present(
        node, f"coalesce(contains({V.text_of(node.value())}, '{AGENT_LIST_MARKER}'), false)"
    )


def is_present(node: Node) -> str:
    """True for any filled value, false for an empty one, NULL when the slot is absent."""
    return _where_present(node, node.filled())


def has_object(node: Node) -> str:
    return _where_present(
        node, f"coalesce(startswith({V.kind_of(node.value())}, 'OBJECT'), false)"
    )


def has_text(node: Node) -> str:
    return _where_present(node, f"{node.read('string')} IS NOT NULL")


def text_length(node: Node) -> str:
    return _where_present(node, f"CAST(coalesce(length({node.read('string')}), 0) AS bigint)")


def member_text(node: Node, key: str) -> str:
    return node.child(key).read("string")


def member_time(node: Node, key: str) -> str:
    return node.child(key).read("timestamp")


def member_real(node: Node, key: str) -> str:
    return node.child(key).read("double")


def member_integer(node: Node, key: str) -> str:
    """A whole-number member, 0 where the object lacks it."""
    return _where_present(node, f"coalesce({node.child(key).read('bigint')}, 0L)")


def member_count(node: Node, key: str) -> str:
    """Size of an array member, 0 where the object lacks it."""
    items = node.child(key).raw("array<variant>")
    return _where_present(node, f"CAST(coalesce(array_size({items}), 0) AS bigint)")


def count_always(node: Node) -> str:
    """Array size, 0 where the slot is absent (document-level measure)."""
    return f"CAST(coalesce(array_size({node.raw('array<variant>')}), 0) AS bigint)"


def has_items(node: Node) -> str:
    """Whether an array, object or text has anything in it; false where absent."""
    return f"coalesce({V.truth_of(node.raw())}, false)"


# Functions of plain values: their slot's text is read along with the plain fields.
OF_PLAIN_VALUES = ("entity_type", "stat_type", "stat_agent", "has_agent_list", "has_text", "text_length")

# Functions of a slot's members.
OF_MEMBERS = ("member_text", "member_time", "member_real", "member_integer", "member_count")

DERIVED: dict[str, Callable[..., str]] = {
    "entity_type": entity_type,
    "stat_type": stat_type,
    "stat_agent": stat_agent,
    "has_agent_list": has_agent_list,
    "is_present": is_present,
    "has_object": has_object,
    "has_text": has_text,
    "text_length": text_length,
    "member_text": member_text,
    "member_time": member_time,
    "member_real": member_real,
    "member_integer": member_integer,
    "member_count": member_count,
    "count_always": count_always,
    "has_items": has_items,
}
