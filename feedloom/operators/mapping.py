"""Declarative field mapping: a collection's text table compiled to one chain of projections.

A table line is ``target [source] [function [arguments]]``.

* The target's prefix fixes its type (``ts_`` timestamp, ``val_`` bigint ...); a suffix such as
  ``:double`` overrides it.
* Without a source, the source is the camelCase form of the target without its prefix:
  ``flg_is_trial`` reads ``isTrial``.
* Source ``-`` declares a target that nothing fills.
* Without a function the value is read as the target type, unwrapping arrays at every level.
* After a line ``dropped`` come fields that are mapped but not part of the target schema.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import variant as V
from ..functions.arrays import MEASURES, STAGES
from ..functions.derived import DERIVED, OF_MEMBERS, OF_PLAIN_VALUES
from ..functions.variant import Node

TYPE_BY_PREFIX = {
    "pk": "string",
    "fk": "string",
    "des": "string",
    "txt": "string",
    "cod": "string",
    "ts": "timestamp",
    "imp": "double",
    "pct": "double",
    "val": "bigint",
    "flg": "boolean",
}
ORIGIN_LABEL = "mongo"
SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
}


def camel_case(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(part.capitalize() for part in rest)


@dataclass(frozen=True)
class Field:
    target: str
    as_type: str
    source: str | None
    function: str | None = None
    arguments: tuple[str, ...] = ()

    @classmethod
    def parse(cls, line: str) -> "Field":
        name, *rest = line.split()
        target, _, override = name.partition(":")
        prefix, _, stem = target.partition("_")
        source = rest[0] if rest else camel_case(stem)
        return cls(
            target,
            override or TYPE_BY_PREFIX[prefix],
            None if source == "-" else source,
            rest[1] if len(rest) > 1 else None,
            tuple(rest[2:]),
        )


@dataclass(frozen=True)
class Collection:
    """A collection: its name, its target fields in order and its mapped-but-dropped fields."""

    name: str
    fields: tuple[Field, ...]
    dropped: tuple[Field, ...] = ()

    @classmethod
    def parse(cls, name: str, table: str) -> "Collection":
        lines = [line.strip() for line in table.strip().splitlines() if line.strip()]
        cut = lines.index("dropped") if "dropped" in lines else len(lines)
        return cls(
            name,
            tuple(Field.parse(line) for line in lines[:cut]),
            tuple(Field.parse(line) for line in lines[cut + 1 :]),
        )

    @property
    def mapped(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields + self.dropped if f.source)

    @property
    def mapped_columns(self) -> list[str]:
        """Columns that mapping makes, in order."""
        first, *rest = [f.target for f in self.mapped]
        return [first, "pk_yearmonth", "des_data_origin", *rest, "des_source"]

    @property
    def target_columns(self) -> list[tuple[str, str]]:
        """(name, type) in target order, with the columns every collection carries."""
        first, *rest = self.fields
        return (
            [(first.target, first.as_type)]
            + [("pk_yearmonth", "string"), ("des_data_origin", "string")]
            + [(f.target, f.as_type) for f in rest]
            + [("des_source", "string")]
        )

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, SPARK_TYPES[t], True) for name, t in self.target_columns]
        )


def _slug(path: str) -> str:
    return re.sub(r"[^A-Za-z0-9]", "_", path)


def _parents(paths: list[str]) -> list[str]:
    """Every proper prefix of the dotted paths, shallow first."""
    found = {".".join(p.split(".")[:n]) for p in paths for n in range(1, p.count(".") + 1)}
    return sorted(found, key=lambda p: (p.count("."), p))


class Compiler:
    """Turns a collection's fields into staged columns and one final projection.

    Objects on the way to a field (``subscription``, ``address``), objects whose members are measured (``content``)
    and measured arrays are projected first, each once per row; Catalyst keeps such a projection apart from the next
    one because its columns are used many times.
    """

    def __init__(self, collection: Collection, document: str = "document"):
        self.collection = collection
        self.document = document
        self.staged = self._objects()

    @staticmethod
    def _is_plain(field: Field) -> bool:
        return field.function is None or field.function in OF_PLAIN_VALUES

    @staticmethod
    def _is_opened(field: Field) -> bool:
        """Whether members of the field's own slot are read."""
        if field.function in MEASURES:
            return STAGES[MEASURES[field.function].stage].of_members
        return field.function in OF_MEMBERS

    def _objects(self) -> list[str]:
        """Paths of the objects that are staged: those on the way to a field, and slots whose members are read."""
        fields = self.collection.mapped
        opened = {f.source for f in fields if self._is_opened(f)}
        return sorted(opened.union(_parents([f.source for f in fields])), key=lambda p: (p.count("."), p))

    def _object(self, path: str) -> str:
        """Column of the object at a path (the document itself for the empty path)."""
        return f"_o_{_slug(path)}" if path else self.document

    def _node(self, path: str, with_text: bool = False) -> Node:
        above, _, key = path.rpartition(".")
        text, first = (f"_{kind}_{_slug(above)}.`{key}`" if with_text else None for kind in "tf")
        return Node(self._object(above), key, text, self._object(path) if path in self.staged else None, first)

    def stages(self) -> list[list[str]]:
        """Projections ahead of the final one: objects by depth, then texts, then lists' first texts and typed arrays."""
        fields = self.collection.mapped
        by_depth: dict[int, list[str]] = {}
        for path in self.staged:
            text = f"{self._node(path).value()} AS {self._object(path)}"
            by_depth.setdefault(path.count("."), []).append(text)
        keys: dict[str, dict[str, None]] = {}
        for f in fields:
            if self._is_plain(f):
                above, _, key = f.source.rpartition(".")
                keys.setdefault(above, {})[key] = None
        texts, typed = [], []
        for above, names in keys.items():
            shape = ",".join(f"`{name}` string" for name in names)
            texts.append(f"{V.cast_to(self._object(above), f'struct<{shape}>')} AS _t_{_slug(above)}")
            nodes = [(name, self._node(f"{above}.{name}" if above else name, with_text=True)) for name in names]
            typed.append("named_struct(" + ", ".join(f"'{n}', {node.first_text()}" for n, node in nodes) + f") AS _f_{_slug(above)}")
        arrays = {self._array_name(f): f for f in fields if f.function in MEASURES}
        for name, f in arrays.items():
            stage = STAGES[MEASURES[f.function].stage]
            texts.append(f"{stage.texts(self._node(f.source))} AS _s{name}")
            typed.append(f"{stage.typed(self._node(f.source), f'_s{name}')} AS {name}")
        return [by_depth[d] for d in sorted(by_depth)] + [x for x in (texts, typed) if x]

    @staticmethod
    def _array_name(field: Field) -> str:
        return f"_a_{_slug(field.source)}_{MEASURES[field.function].stage}"

    def expression(self, field: Field) -> str:
        node = self._node(field.source, with_text=self._is_plain(field))
        if field.function is None:
            built = node.read(field.as_type)
        elif field.function in MEASURES:
            built = MEASURES[field.function].text(node, self._array_name(field), *field.arguments)
        else:
            built = DERIVED[field.function](node, *field.arguments)
        return f"{built} AS {field.target}"

    def losses(self) -> str:
        """Names of the targets that stayed NULL although their slot is filled, beside the targets themselves.

        Only a value read as a number, a time or a flag can be lost: text takes anything, and a measure of an
        unusable value has its default.
        """
        read = [f for f in self.collection.mapped if f.function is None and f.as_type not in ("string", "json")]
        tests = []
        for f in read:
            node = self._node(f.source, with_text=True)
            tests.append(f"if({f.target} IS NULL AND {node.present()} AND {node.filled()}, '{f.target}', NULL)")
        # Unlike array_compact this is no lambda, so the tests are compiled; each name is there once.
        return f"array_except(CAST(array({', '.join(tests)}) AS array<string>), array(CAST(NULL AS string)))"


def map_documents(
    df: DataFrame,
    collection: Collection,
    document: str = "document",
    as_of: Column | None = None,
    keep: tuple[str, ...] = (),
    losses: str | None = None,
) -> DataFrame:
    """Every mapped field of a VARIANT ``document`` column, dropped fields included.

    ``as_of`` is the processing time behind ``pk_yearmonth``; ``keep`` names columns carried
    along unchanged.  ``losses`` names a further column with the targets whose values could not be read.
    """
    compiler = Compiler(collection, document)
    first, *rest = collection.mapped
    staged = df.select(document, *keep)
    for texts in compiler.stages():
        staged = staged.selectExpr("*", *texts)
    processed = F.current_timestamp() if as_of is None else as_of
    targets = [
        F.expr(compiler.expression(first)),
        F.date_format(processed, "yyyyMM").alias("pk_yearmonth"),
        F.lit(collection.name).alias("des_data_origin"),
        *[F.expr(compiler.expression(f)) for f in rest],
        F.lit(ORIGIN_LABEL).alias("des_source"),
    ]
    if losses is None:
        return staged.select(*targets, *keep)
    return staged.select("*", *targets).select(*collection.mapped_columns, *keep, F.expr(compiler.losses()).alias(losses))


def flatten_columns(df: DataFrame, separator: str = ".") -> DataFrame:
    """A struct-typed table with every nested struct field as its own dot-named column; arrays stay."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for field in schema.fields:
            here = path + (field.name,)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                out.append(F.col(quoted).alias(separator.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))
