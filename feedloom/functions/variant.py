"""Reading polymorphic values out of VARIANT documents.

A document field may hold a scalar, an array of candidates or an extended-JSON wrapper
(``$oid``, ``$date``, ``$numberLong`` ...).  Every function here takes and returns Spark SQL
expression text that yields NULL instead of failing, so one bad document never stops a job.
Text keeps plan building cheap: a collection of 60 fields is 60 parsed expressions rather
than thousands of single Column calls.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

# Extended-JSON number wrappers.
WHOLE_WRAPPERS = ("$numberLong", "$numberInt")
REAL_WRAPPERS = ("$numberDouble", "$numberDecimal")


def key_path(*keys: str) -> str:
    """A VARIANT path with every key quoted, so digits, ``$`` and dashes are safe."""
    return "$" + "".join(f'["{key}"]' for key in keys)


def get_keys(doc: str, *keys: str, as_type: str = "variant") -> str:
    return f"try_variant_get({doc}, '{key_path(*keys)}', '{as_type}')"


def get_path(doc: str, path: str, as_type: str = "variant") -> str:
    """Value at a dotted path, NULL where any level is absent."""
    return get_keys(doc, *path.split("."), as_type=as_type)


def cast_to(value: str, as_type: str) -> str:
    return f"try_variant_get({value}, '$', '{as_type}')"


def is_null(value: str) -> str:
    """SQL NULL or JSON null."""
    return f"({value} IS NULL OR is_variant_null({value}))"


def is_filled(value: str) -> str:
    """Neither null nor empty text."""
    return f"(NOT {is_null(value)} AND coalesce({cast_to(value, 'string')}, ' ') <> '')"


def first_filled(items: str) -> str:
    """First element of an ``array<variant>`` that is neither null nor empty text."""
    return f"get(filter({items}, c -> {is_filled('c')}), 0)"


def unwrap(value: str) -> str:
    """An array gives its first filled element; anything else stays as it is."""
    items = cast_to(value, "array<variant>")
    return f"if({items} IS NOT NULL, {first_filled(items)}, {value})"


def bound(value: str, then: Callable[[str], str], name: str = "b") -> str:
    """``then`` of a value that it names several times, evaluated once."""
    return f"get(transform(array({value}), {name} -> {then(name)}), 0)"


def kind_of(value: str) -> str:
    return f"schema_of_variant({value})"


def text_of(value: str) -> str:
    """Text; an object id gives its hex digits, empty text gives NULL."""
    return f"nullif(coalesce({get_keys(value, '$oid', as_type='string')}, {cast_to(value, 'string')}), '')"


def integer_of(value: str) -> str:
    """Whole number; fractions are cut, whole-number text is read, other text is NULL."""
    wrapped = [get_keys(value, w, as_type="bigint") for w in WHOLE_WRAPPERS]
    return f"coalesce({', '.join([cast_to(value, 'bigint'), *wrapped])})"


def real_of(value: str) -> str:
    wrapped = [get_keys(value, w, as_type="double") for w in WHOLE_WRAPPERS + REAL_WRAPPERS]
    return f"coalesce({', '.join([cast_to(value, 'double'), *wrapped])})"


def iso_time(text: str) -> str:
    """ISO-8601 text to an instant; text that does not start with a full date is NULL."""
    return (
        f"if(substring({text}, 5, 1) = '-' AND substring({text}, 8, 1) = '-', "
        f"try_cast({text} AS timestamp), NULL)"
    )


def time_of(value: str) -> str:
    """ISO text, ``{"$date": text}`` or ``{"$date": {"$numberLong": ms}}``."""
    millis = get_keys(value, "$date", "$numberLong", as_type="bigint")
    text = f"coalesce({get_keys(value, '$date', as_type='string')}, {cast_to(value, 'string')})"
    return f"coalesce(timestamp_millis({millis}), {iso_time(text)})"


def truth_of(value: str) -> str:
    """Truthiness: non-empty text and containers are true, numbers when not zero."""
    kind = kind_of(value)
    return (
        f"CASE WHEN {kind} = 'STRING' THEN {cast_to(value, 'string')} <> '' "
        f"WHEN startswith({kind}, 'OBJECT') THEN {kind} <> 'OBJECT<>' "
        f"WHEN startswith({kind}, 'ARRAY') THEN array_size({cast_to(value, 'array<variant>')}) > 0 "
        f"ELSE {cast_to(value, 'boolean')} END"
    )


READERS: dict[str, Callable[[str], str]] = {
    "string": text_of,
    "bigint": integer_of,
    "double": real_of,
    "timestamp": time_of,
    "boolean": truth_of,
    "json": lambda value: cast_to(value, "string"),
}


def opens_container(text: str) -> str:
    """Whether JSON text may stand for an array or an object."""
    return f"(startswith({text}, '[') OR startswith({text}, '{{'))"


def date_text(text: str) -> str:
    """ISO text out of ``{"$date":"..."}``; other text stays as it is."""
    return f"if(startswith({text}, '{{\"$date\":\"'), substring({text}, 11, length({text}) - 12), {text})"


def direct(text: str, as_type: str) -> str:
    """A plain scalar's typed value from its text; NULL where the text alone does not tell."""
    if as_type == "string":
        return f"nullif({text}, '')"
    if as_type == "json":
        return text
    if as_type == "timestamp":
        return iso_time(date_text(text))
    return f"try_cast({text} AS {as_type})"


def undecided(text: str, as_type: str) -> str:
    """Whether the text of a value is not enough to read it (array, wrapper, fraction, flag)."""
    if as_type == "string":
        return opens_container(text)
    if as_type == "json":
        return "false"
    unread = f"({text} IS NOT NULL AND {direct(text, as_type)} IS NULL)"
    # A failed number cast is costly, so text that cannot be a number is not tried.
    return unread if as_type == "timestamp" else f"({opens_container(text)} OR {unread})"


@dataclass(frozen=True)
class Node:
    """A named slot of a document: the object that holds it and its key there.

    ``text`` names a column with the slot's text, read together with its neighbours by one
    struct cast of the holder.  Plain scalars are read from that text alone; only a row whose
    text does not decide (an array, an extended-JSON wrapper, a fraction in a whole-number
    field, a flag that is no boolean) goes back to the VARIANT and looks at the value's type.
    ``opened`` names a column with the slot's ``value()``, where one is staged: members are read from that, as
    every ``value()`` copies the whole object out of its holder.
    ``first`` names a column with ``first_text()``, where one is staged: most lists are decided by it without a lambda,
    which Spark does not compile.
    """

    parent: str
    key: str
    text: str | None = None
    opened: str | None = None
    first: str | None = None

    def raw(self, as_type: str = "variant", *below: str) -> str:
        return get_keys(self.parent, self.key, *below, as_type=as_type)

    def _candidates(self) -> str:
        """The slot as a list: its elements, or itself alone."""
        return f"coalesce({self.raw('array<variant>')}, array({self.raw()}))"

    def careful(self, as_type: str) -> str:
        """First filled candidate, read by its type; skipped where the slot is absent."""
        chosen = f"slice(filter({self._candidates()}, c -> {is_filled('c')}), 1, 1)"
        read = READERS[as_type]("c")
        return f"if({self.raw()} IS NOT NULL, get(transform({chosen}, c -> {read}), 0), NULL)"

    def value(self) -> str:
        """The slot with arrays unwrapped to their first filled element."""
        items = self.raw("array<variant>")
        return f"if({items} IS NOT NULL, {first_filled(items)}, {self.raw()})"

    def _wrapped(self, as_type: str, text: str) -> str:
        """Value of an extended-JSON wrapper, one lookup per wrapper the type knows."""
        if as_type == "string":
            return f"coalesce({self.raw('string', '$oid')}, {text})"
        if as_type == "timestamp":
            return f"timestamp_millis({self.raw('bigint', '$date', '$numberLong')})"
        kinds = WHOLE_WRAPPERS if as_type == "bigint" else REAL_WRAPPERS + WHOLE_WRAPPERS
        return f"coalesce({', '.join(self.raw(as_type, w) for w in kinds)})"

    def first_text(self) -> str:
        """Text of a list's first filled element, NULL where the slot is no list or has none."""
        listed = f"get(array_except({self.raw('array<string>')}, array('', CAST(NULL AS string))), 0)"
        return f"if(startswith({self.text}, '['), {listed}, NULL)"

    def _is_text(self) -> str:
        """Whether a slot that is no container holds a JSON string: of the JSON values, only text casts to bytes."""
        return f"{self.raw('binary')} IS NOT NULL"

    def _truth_of_list(self) -> str:
        """Truth of the first filled element; its text tells unless it may be a number or a container."""
        if not self.first:
            return self.careful("boolean")
        place = f"CAST(array_position({self.raw('array<string>')}, 'false') AS int) - 1"
        is_text = f"get({self.raw('array<binary>')}, {place}) IS NOT NULL"
        return (
            f"CASE WHEN {self.first} = 'true' THEN true WHEN {self.first} = 'false' THEN {is_text} "
            f"ELSE {self.careful('boolean')} END"
        )

    def _first_of_list(self, as_type: str) -> str:
        """First filled element where its own text decides it, else by its type."""
        if self.first:
            plain = direct(self.first, as_type)
            if as_type not in ("json", "timestamp"):
                plain = f"if({opens_container(self.first)}, NULL, {plain})"
            return f"coalesce({plain}, {self.careful(as_type)})"
        filled = f"slice(filter({self.raw('array<string>')}, e -> e <> ''), 1, 1)"
        plain = f"if({undecided('e', as_type)}, NULL, {direct('e', as_type)})"
        return f"coalesce(get(transform({filled}, e -> {plain}), 0), {self.careful(as_type)})"

    def read(self, as_type: str) -> str:
        text = self.text or self.raw("string")
        if as_type == "boolean":
            return (
                f"CASE WHEN {text} IS NULL OR {text} = '' THEN NULL WHEN {text} = 'true' THEN true "
                f"WHEN {text} = 'false' THEN {self._is_text()} WHEN startswith({text}, '[') THEN {self._truth_of_list()} "
                f"WHEN startswith({text}, '{{') THEN {self.careful(as_type)} "
                f"ELSE if({self._is_text()}, true, {self.raw('boolean')}) END"
            )
        last = direct(text, "string")
        if as_type == "timestamp":
            last = self.careful(as_type)
        elif as_type != "string":
            last = f"coalesce({direct(text, as_type)}, {self.careful(as_type)})"
        read = (
            f"CASE WHEN {text} IS NULL THEN NULL "
            f"WHEN startswith({text}, '{{') THEN {self._wrapped(as_type, text)} "
            f"WHEN startswith({text}, '[') THEN {self._first_of_list(as_type)} ELSE {last} END"
        )
        return f"coalesce({direct(text, as_type)}, {read})" if as_type == "timestamp" else read

    def present(self) -> str:
        """False for an absent slot, JSON null and an empty object."""
        if self.text:  # a staged text tells an absent slot without a look at the document
            filled = f"coalesce({self.text} <> '{{}}' OR {kind_of(self.raw())} = 'STRING', false)"
            return f"({self.text} IS NOT NULL AND {filled})"
        # Members are counted, not printed: the text of an object costs many times as much.
        return f"coalesce(array_size(map_keys({self.raw('map<string,binary>')})) > 0, {self.raw('string')} IS NOT NULL)"

    def filled(self) -> str:
        """Whether any candidate is more than null or empty text."""
        text = self.text or self.raw("string")
        several = f"coalesce(exists({self._candidates()}, c -> {is_filled('c')}), false)"
        return f"if(startswith({text}, '['), {several}, coalesce({text} <> '', false))"

    def child(self, key: str) -> "Node":
        return Node(self.opened or self.value(), key)


def nested(doc: str, path: str) -> Node:
    """Walk a dotted path, unwrapping arrays at every level above the last."""
    *above, last = path.split(".")
    current = doc
    for key in above:
        current = Node(current, key).value()
    return Node(current, last)


def path_exists(doc: str, path: str) -> str:
    return nested(doc, path).filled()
