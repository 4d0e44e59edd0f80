"""Array and map measures of a document, as Spark SQL expression text.

Each family first reads its array once into a small typed array of structs (a ``Stage``);
the mapping compiler projects that column ahead of the measures, so eleven measures over the
same log read the document once.  A slot that is absent gives NULL, a slot
that is present but not an array gives the measure's ``default``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from . import variant as V
from .variant import Node

SEPARATOR = ", "
# JSON of an object whose one member, ``category``, is text without escapes (a pattern within SQL text).
PLAIN_CATEGORY = r'\\A\\{"category":"([^"\\\\\\x00-\\x1f]*)"\\}\\z'


# --- staged arrays ---------------------------------------------------------------------


@dataclass(frozen=True)
class Stage:
    """Two projections that turn an array slot into typed structs.

    ``texts`` reads every element's fields as text in one cast.  ``typed`` converts them; where
    a value's text does not decide, that value is read again by its type.  ``of_members`` says that the slot is
    an object and its members are read.
    """

    name: str
    texts: Callable[[Node], str]
    typed: Callable[[Node, str], str]
    of_members: bool = False


def _structs(name: str, /, **fields: str) -> Stage:
    """Array of objects with each named field unwrapped and read as its type."""

    def texts(node: Node) -> str:
        return node.raw("array<struct<" + ",".join(f"{f} string" for f in fields) + ">>")

    def listed(field: str) -> str:
        """The text of a list's first filled element in place of the list's; ``l`` holds what is a list."""
        first = f"get(filter(l.{field}, c -> c <> ''), 0)"
        return f"if(startswith(e.{field}, '[') AND l.{field} IS NOT NULL, {first}, e.{field})"

    def typed(node: Node, staged: str) -> str:
        read = {f: t for f, t in fields.items() if t != "json"}
        lists = node.raw("array<struct<" + ",".join(f"{f} array<string>" for f in read) + ">>")
        items = node.raw("array<struct<" + ",".join(f"{f} variant" for f in read) + ">>")
        opened = ", ".join(f"'{f}', {listed(f) if f in read else f'e.{f}'}" for f in fields)
        by_text = ", ".join(f"'{f}', {V.direct(f'e.{f}', t)}" for f, t in fields.items())
        by_type = ", ".join(
            f"'{f}', if({V.undecided(f'e.{f}', t)}, {V.bound(V.unwrap(f'v.{f}'), V.READERS[t])}, {V.direct(f'e.{f}', t)})"
            if f in read
            else f"'{f}', e.{f}"
            for f, t in fields.items()
        )
        has_list = " OR ".join(f"startswith(e.{f}, '[')" for f in read)
        unclear = " OR ".join(V.undecided(f"e.{f}", t) for f, t in read.items())
        # A list always counts as unclear, so only rows with an unclear value are searched for lists.  What the lists'
        # texts leave unclear is read as VARIANTs, which is many times dearer.
        without_lists = f"if(exists({staged}, e -> {has_list}), zip_with({staged}, {lists}, (e, l) -> named_struct({opened})), {staged})"
        return (
            f"if(exists({staged}, e -> {unclear}), "
            + V.bound(
                without_lists,
                lambda rows: f"if(exists({rows}, e -> {unclear}), "
                f"zip_with({rows}, {items}, (e, v) -> named_struct({by_type})), "
                f"transform({rows}, e -> named_struct({by_text})))",
                "o",
            )
            + f", transform({staged}, e -> named_struct({by_text})))"
        )

    return Stage(name, texts, typed)


def _items_typed(node: Node, staged: str) -> str:
    """Plain values: the text of every element that counts as true."""
    one = V.unwrap("e")
    by_type = f"transform({node.raw('array<variant>')}, e -> if({V.truth_of(one)}, {V.text_of(one)}, NULL))"
    unclear = f"{V.opens_container('e')} OR substring(e, 1, 1) IN ('0', '-', '.') OR e = 'false'"
    return f"if(exists({staged}, e -> {unclear}), {by_type}, transform({staged}, e -> nullif(e, '')))"


def _bags_typed(node: Node, staged: str) -> str:
    """bagList as size -> meat -> count."""
    bags, shape = node.child("bagList"), "map<string,map<string,variant>>"
    by_size = f"coalesce({bags.raw(shape)}, {V.cast_to(bags.value(), shape)})"
    # A list is no number, so what casts at once needs no unwrapping.
    count = f"coalesce({V.cast_to('n', 'bigint')}, {V.integer_of(V.unwrap('n'))}, 0L)"
    by_type = f"transform_values({by_size}, (s, meats) -> transform_values(meats, (m, n) -> {count}))"
    unclear = lambda counts: f"exists(map_values({counts}), m -> m IS NULL OR exists(map_values(m), n -> n IS NULL))"
    # Counts in a list are read from the text of its first filled element; only what that leaves open is read as VARIANTs,
    # which is many times dearer.
    listed = "try_cast(get(array_except(l, array('', CAST(NULL AS string))), 0) AS bigint)"
    meats = f"map_from_arrays(map_keys(m), zip_with(map_values(m), map_values(ls), (n, l) -> coalesce(n, {listed})))"
    lists = node.raw("map<string,map<string,array<string>>>", "bagList")
    by_text = f"map_from_arrays(map_keys({staged}), zip_with(map_values({staged}), map_values({lists}), (m, ls) -> {meats}))"
    by_lists = V.bound(by_text, lambda counts: f"if(NOT {unclear(counts)}, {counts}, {by_type})")
    return (
        f"CASE WHEN NOT {unclear(staged)} THEN {staged} WHEN {staged} IS NOT NULL THEN {by_lists} "
        f"WHEN {node.opened or node.raw()} IS NOT NULL THEN {by_type} END"
    )


STAGES = {
    "items": Stage("items", lambda node: node.raw("array<string>"), _items_typed),
    "dogs": _structs("dogs", name="string", weight="double"),
    "comments": _structs("comments", date="timestamp"),
    "lines": _structs("lines", qty="bigint", unitGrams="bigint", unitAmount="double", product="string"),
    "refunds": _structs("refunds", amount="double", createdAt="timestamp", status="string", reason="json"),
    "contacts": _structs(
        "contacts",
        eventType="string",
        direction="string",
        status="string",
        agent="string",
        startedAt="timestamp",
        duration="bigint",
    ),
    "changes": _structs("changes", key="string", updatedBy="string", createdAt="timestamp"),
    "bags": Stage(
        "bags", lambda node: node.raw("map<string,map<string,bigint>>", "bagList"), _bags_typed, of_members=True
    ),
}


# --- measures over staged arrays -------------------------------------------------------


def _total(items: str, value: str, zero: str) -> str:
    """Sum of ``value`` (in terms of element ``e``), leaving out NULL and overflowing terms."""
    return f"aggregate({items}, {zero}, (a, e) -> coalesce(try_add(a, {value}), a))"


def size_of(items: str) -> str:
    return f"CAST(array_size({items}) AS bigint)"


def joined(items: str, field: str | None = None) -> str:
    texts = f"transform({items}, e -> e.{field})" if field else items
    return f"array_join(filter({texts}, t -> t IS NOT NULL), '{SEPARATOR}')"


def weight_sum(items: str) -> str:
    total = _total(items, "e.weight", "0D")
    return f"if({total} > 0, {total}, NULL)"


def newest(items: str, field: str) -> str:
    return f"array_max(transform({items}, e -> e.{field}))"


def quantity(items: str) -> str:
    return _total(items, "e.qty", "0L")


def grams(items: str) -> str:
    return _total(items, "try_multiply(e.qty, e.unitGrams)", "0L")


def line_amount(items: str) -> str:
    return _total(items, "e.qty * e.unitAmount", "0D")


def refund_amount(items: str) -> str:
    return _total(items, "e.amount", "0D")


def _latest(items: str, field: str, untimed: str) -> str:
    """Field of the element with the greatest time; ties go to the earlier position."""
    ranked = (
        f"transform({items}, (e, i) -> named_struct("
        f"'newest_first', -unix_micros(e.createdAt), 'position', i, 'entry', e))"
    )
    if untimed == "skip":
        ranked = f"filter({ranked}, r -> r.newest_first IS NOT NULL)"
    else:
        ranked = (
            f"transform({ranked}, r -> named_struct('untimed', r.newest_first IS NULL, "
            f"'newest_first', r.newest_first, 'position', r.position, 'entry', r.entry))"
        )
    return f"array_min({ranked}).entry.{field}"


def latest_refund(items: str, field: str) -> str:
    return _latest(items, field, untimed="skip")


def latest_refund_category(items: str) -> str:
    """Category of the latest refund's reason object; only that one reason is looked at, and parsed where it holds more."""
    text = latest_refund(items, "reason")
    # An object of this one plain text: its JSON decides without being parsed.
    plain = f"nullif(regexp_extract({text}, '{PLAIN_CATEGORY}', 1), '')"
    parsed = V.bound(
        f"try_parse_json({text})",
        lambda r: V.bound(V.unwrap(r), lambda c: V.bound(Node(c, "category").value(), V.text_of, "t"), "c"),
        "r",
    )
    return f"coalesce({plain}, {parsed})"


def latest_change(items: str, field: str) -> str:
    return _latest(items, field, untimed="last")


def last_entry(items: str, field: str) -> str:
    return f"try_element_at({items}, -1).{field}"


def duration_sum(items: str) -> str:
    return _total(items, "e.duration", "0L")


def matching(items: str, field: str, wanted: str) -> str:
    return size_of(f"filter({items}, e -> e.{field} = '{wanted}')")


def other_actors(items: str, *actors: str) -> str:
    """Entries made by anyone but the named actors."""
    named = ", ".join(f"'{a}'" for a in actors)
    return size_of(f"filter({items}, e -> coalesce(e.updatedBy NOT IN ({named}), true))")


def _keys(items: str) -> str:
    return f"filter(transform({items}, e -> e.key), k -> k IS NOT NULL)"


def distinct_keys(items: str) -> str:
    return size_of(f"array_distinct({_keys(items)})")


def top_keys(items: str, n: int = 3) -> str:
    """Most frequent keys; ties go to the key seen first.

    Keys are sorted with their positions and counted as runs: a run starts where the key
    differs from its left neighbour and ends where the next run starts.  Neighbours are
    paired with ``zip_with``, so no lambda re-reads the whole array.
    """
    keys = (
        f"array_sort(filter(transform({items}, (e, i) -> named_struct('key', e.key, 'position', i)), "
        f"e -> e.key IS NOT NULL))"
    )
    nothing = "CAST(NULL AS struct<key:string,position:int>)"
    paired = (
        f"zip_with({keys}, concat(array({nothing}), {keys}), "
        f"(e, l) -> named_struct('e', e, 'left', l.key))"
    )
    starts = (
        f"filter(transform({paired}, (p, i) -> named_struct('at', i, 'e', p.e, 'left', p.left)), "
        f"p -> p.left IS NULL OR p.e.key IS NULL OR p.left <> p.e.key)"
    )
    # The padded last pair has no key of its own: it marks the end of the last run.
    following = f"slice({starts}, 2, greatest(array_size({starts}), 1))"
    runs = (
        f"zip_with({starts}, {following}, (r, f) -> named_struct("
        f"'most_first', r.at - f.at, 'position', r.e.position, 'key', r.e.key))"
    )
    best = f"slice(array_sort(filter({runs}, r -> r.key IS NOT NULL)), 1, {n})"
    return f"array_join(transform({best}, r -> r.key), '{SEPARATOR}')"


def _add_up(counts: str) -> str:
    return f"aggregate({counts}, 0L, (b, c) -> coalesce(try_add(b, c), b))"


def bag_total(bags: str) -> str:
    return _add_up(f"transform(map_values({bags}), m -> {_add_up('map_values(m)')})")


def bag_meat(bags: str, meat: str) -> str:
    return _add_up(f"transform(map_values({bags}), m -> try_element_at(m, '{meat}'))")


def bag_size(bags: str, size: str) -> str:
    counts = f"coalesce(map_values(try_element_at({bags}, '{size}')), CAST(array() AS array<bigint>))"
    return f"if({bags} IS NOT NULL, {_add_up(counts)}, NULL)"


@dataclass(frozen=True)
class Measure:
    """How to stage an array, how to measure it, and what an unusable slot gives."""

    stage: str
    measure: Callable[..., str]
    default: str | None = None

    def text(self, node: Node, staged: str, *args: str) -> str:
        found = self.measure(staged, *args)
        if self.default is None:
            return found
        return f"coalesce({found}, if({node.present()}, {self.default}, NULL))"


MEASURES: dict[str, Measure] = {
    "count": Measure("items", size_of, "0L"),
    "join": Measure("items", joined, "''"),
    "dog_count": Measure("dogs", size_of, "0L"),
    "dog_names": Measure("dogs", lambda a: joined(a, "name"), "''"),
    "dog_weight": Measure("dogs", weight_sum),
    "comment_count": Measure("comments", size_of, "0L"),
    "newest_comment": Measure("comments", lambda a: newest(a, "date")),
    "line_count": Measure("lines", size_of, "0L"),
    "line_qty": Measure("lines", quantity, "0L"),
    "line_grams": Measure("lines", grams, "0L"),
    "line_amount": Measure("lines", line_amount, "0D"),
    "line_products": Measure("lines", lambda a: joined(a, "product"), "''"),
    "refund_count": Measure("refunds", size_of, "0L"),
    "refund_amount": Measure("refunds", refund_amount, "0D"),
    "latest_refund": Measure("refunds", latest_refund),
    "latest_refund_category": Measure("refunds", latest_refund_category),
    "log_count": Measure("contacts", size_of, "0L"),
    "log_duration": Measure("contacts", duration_sum, "0L"),
    "log_kind": Measure("contacts", lambda a, kind: matching(a, "eventType", kind), "0L"),
    "last_log": Measure("contacts", last_entry),
    "change_count": Measure("changes", size_of, "0L"),
    "changes_by": Measure("changes", lambda a, who: matching(a, "updatedBy", who), "0L"),
    "changes_by_others": Measure("changes", other_actors, "0L"),
    "latest_change": Measure("changes", latest_change),
    "top_keys": Measure("changes", top_keys, "''"),
    "distinct_keys": Measure("changes", distinct_keys, "0L"),
    "bag_total": Measure("bags", bag_total, "0L"),
    "bag_meat": Measure("bags", bag_meat, "0L"),
    "bag_size": Measure("bags", bag_size, "0L"),
}
