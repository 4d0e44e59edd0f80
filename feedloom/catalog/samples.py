"""Sample documents of a collection, derived row by row from the driver tables.

A ``Sample`` says which table rows become documents.  Values of plain fields follow a rule
(type and position of the field, key of the row), and each value is written in one of several
encodings chosen by the row: plain, wrapped in an array behind empty entries, as number text,
or as extended JSON.  The expected table is plain SQL over the same rows, so it knows
nothing of documents, messages or encodings.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mapping import Collection, Field
from ..plans.collections import REGISTRY
from ..session import spread, table

DATABASE = "shop"
AS_OF = "2024-01-31 00:00:00"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def tables_in(sql: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run SQL whose table names are written ``{orders}`` over the driver tables."""
    names = [
        n
        for n in (
            "region nation customer supplier part orders lineitem events documents embeddings "
            "pages benchmark labels conversations"
        ).split()
        if "{" + n + "}" in sql
    ]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def plain_tables(sql: str) -> str:
    """The same SQL with bare table names, for the oracle."""
    return sql.replace("{", "").replace("}", "")


@dataclass
class Sample:
    """Documents of one collection.

    base      portable SQL giving k (bigint), id, t (whole-second time), s (text), x (double)
              and whatever the entries below use
    spark     builds the same base where the documents hold arrays (else ``base`` is run)
    values    path -> portable SQL, for plain fields that should not follow the rule
    raw       path -> Spark SQL giving JSON text (NULL: absent), for fields with a function
    expect    target -> DuckDB SQL, for fields with a function
    """

    collection: str
    base: str
    spark: Callable[[SparkSession, str], DataFrame] | None = None
    values: dict[str, str] = field(default_factory=dict)
    raw: dict[str, str] = field(default_factory=dict)
    expect: dict[str, str] = field(default_factory=dict)

    @property
    def spec(self) -> Collection:
        return REGISTRY[self.collection]

    # --- values ------------------------------------------------------------------------

    def plain_fields(self) -> dict[str, tuple[int, Field]]:
        """Source path -> (position, field) of every field read without a function."""
        found: dict[str, tuple[int, Field]] = {}
        for f in self.spec.mapped:
            if f.function is None and f.source not in found and f.source != "_id":
                if not any(f.source.startswith(p + ".") or f.source == p for p in self.raw):
                    found[f.source] = (len(found) + 1, f)
        return found

    def value_sql(self, path: str, position: int, as_type: str) -> str:
        if path in self.values:
            return f"CAST({self.values[path]} AS {as_type.replace('string', 'STRING')})"
        leaf = path.split(".")[-1]
        rule = {
            "string": f"s || '-{leaf}-' || CAST(k % 97 AS STRING)",
            "bigint": f"(k * 7 + {position}) % 1000",
            "double": f"CAST((k * 13 + {position}) % 4096 AS DOUBLE) / 4",
            "boolean": f"(k + {position}) % 3 = 0",
            "timestamp": f"t + INTERVAL '{position}' HOUR",
        }[as_type]
        return f"CASE WHEN (k + {position}) % 7 = 0 THEN NULL ELSE {rule} END"

    # --- documents ---------------------------------------------------------------------

    @staticmethod
    def _encoded(value: str, position: int, as_type: str, is_key: bool) -> str:
        plain = {
            "string": f"concat('\"', {value}, '\"')",
            "bigint": f"CAST({value} AS string)",
            "double": f"CAST({value} AS string)",
            "boolean": f"CAST({value} AS string)",
            "timestamp": f"concat('\"', date_format({value}, \"{ISO_SECONDS}\"), '\"')",
        }[as_type]
        third, fifth = {
            "string": (plain, f"concat('{{\"$oid\":', {plain}, '}}')" if is_key else plain),
            "bigint": (f"concat('\"', {value}, '\"')", f"concat('{{\"$numberLong\":\"', {value}, '\"}}')"),
            "double": (f"concat('\"', {value}, '\"')", f"concat('{{\"$numberDouble\":\"', {value}, '\"}}')"),
            "boolean": (plain, f"if({value}, '1', '0')"),
            "timestamp": (
                f"concat('{{\"$date\":', {plain}, '}}')",
                f"concat('{{\"$date\":{{\"$numberLong\":\"', unix_millis({value}), '\"}}}}')",
            ),
        }[as_type]
        return (
            f"CASE (k + {position}) % 5 WHEN 2 THEN {third} "
            f"WHEN 3 THEN concat('[\"\",null,', {plain}, ']') WHEN 4 THEN {fifth} ELSE {plain} END"
        )

    def _tree(self) -> dict:
        tree: dict = {}

        def put(path: str, text: str) -> None:
            *above, last = path.split(".")
            here = tree
            for key in above:
                here = here.setdefault(key, {})
            here[last] = text

        put("_id", "_id_json")
        for path, (position, f) in self.plain_fields().items():
            is_key = f.target.split("_")[0] in ("fk", "cod")
            value = f"v_{position}"
            put(path, f"if({value} IS NULL, NULL, {self._encoded(value, position, f.as_type, is_key)})")
        for path, text in self.raw.items():
            put(path, text)
        return tree

    def _object(self, tree: dict, depth: int = 0) -> str:
        members = []
        for key, item in tree.items():
            text = self._object(item, depth + 1) if isinstance(item, dict) else item
            members.append(f"concat('\"{key}\":', {text})")
        inside = "concat_ws(',', " + ", ".join(members) + ")"
        if depth == 0:
            return "concat('{', " + inside + ", '}')"
        # Every sixth row wraps its sub-objects in a one-element array.
        return f"concat(if(k % 6 = 5, '[{{', '{{'), {inside}, if(k % 6 = 5, '}}]', '}}'))"

    def documents(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """k, id, t and the document's JSON text."""
        base = self.spark(spark, sf_dir) if self.spark else tables_in(self.base, spark, sf_dir)
        base = spread(base, table(spark, sf_dir, re.search(r"\{(\w+)\}", self.base).group(1)))
        uses_text = any(f.source == "_id" and f.function for f in self.spec.mapped)
        id_json = "concat('\"', id, '\"')"
        if not uses_text:
            id_json = f"if(k % 2 = 0, {id_json}, concat('{{\"$oid\":', {id_json}, '}}'))"
        values = [
            f"{self.value_sql(path, position, f.as_type)} AS v_{position}"
            for path, (position, f) in self.plain_fields().items()
        ]
        return base.selectExpr("*", f"{id_json} AS _id_json", *values).selectExpr(
            "k", "id", "t", f"{self._object(self._tree())} AS document"
        )

    def messages(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return wrap(self.documents(spark, sf_dir), self.collection)

    # --- expectation -------------------------------------------------------------------

    def expected_sql(self) -> str:
        plain = self.plain_fields()
        values = ", ".join(
            f"{self.value_sql(path, position, f.as_type)} AS v_{position}"
            for path, (position, f) in plain.items()
        )
        types = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
        columns = [
            f"'{AS_OF[:4]}{AS_OF[5:7]}' AS pk_yearmonth",
            f"'{self.collection}' AS des_data_origin",
            "'mongo' AS des_source",
        ]
        for f in self.spec.fields:
            if f.target in self.expect:
                text = self.expect[f.target]
            elif f.source is None:
                text = "NULL"
            elif f.source == "_id" and f.function is None:
                text = "id"
            elif f.source in plain:
                text = f"v_{plain[f.source][0]}"
            else:
                raise KeyError(f"{self.collection}.{f.target} has no expectation")
            text = f"CAST({text} AS {types[f.as_type]})"
            if f.as_type == "double":
                text = f"round({text}, 2)"
            columns.append(f"{text} AS {f.target}")
        columns += ["CASE k % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'replace' END AS _operation"]
        return (
            f"WITH base AS ({plain_tables(self.base)}), "
            f"filled AS (SELECT *{', ' if values else ''}{values} FROM base) "
            f"SELECT {', '.join(columns)} FROM filled"
        )


def wrap(documents: DataFrame, collection: str) -> DataFrame:
    """Document rows (k, id, t, document JSON) as base64 topic messages."""
    envelope = (
        "concat('{\"operation\":\"', operation, '\",\"collection\":\"', collection, "
        f"'\",\"database\":\"{DATABASE}\",\"document\":', document, "
        f"',\"timestamp\":\"', date_format(t, \"{ISO_SECONDS}\"), "
        "'\",\"correlation_id\":\"c-', id, '\",\"resume_token\":\"', k, '\"}')"
    )
    return (
        documents.selectExpr(
            "*",
            "CASE k % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'replace' END AS operation",
            f"'{collection}' AS collection",
        )
        .selectExpr(
            f"base64(CAST({envelope} AS binary)) AS body",
            f"map('operation', operation, 'collection', collection, 'database', '{DATABASE}', "
            "'correlation_id', concat('c-', id)) AS attrs",
            "md5(concat(collection, id)) AS mid",
            "t",
        )
        .selectExpr(
            "named_struct('data', body, 'attributes', attrs, 'messageId', mid, "
            "'message_id', CAST(NULL AS string)) AS message",
            "CAST(NULL AS string) AS data",
            "CAST(NULL AS map<string,string>) AS attributes",
            "CAST(NULL AS string) AS messageId",
            "t AS publishTime",
            "1 AS delivery_attempt",
        )
    )


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def rounded(df: DataFrame) -> DataFrame:
    """Double columns rounded to cents, so sums may be added up in any order."""
    doubles = {f.name: F.round(f.name, 2) for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.withColumns(doubles) if doubles else df
