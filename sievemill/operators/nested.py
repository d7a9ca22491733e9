"""Deeply nested semi-structured records.

JSON lines are parsed to VARIANT, so no schema has to be given. Each level is
exploded as the data shows it: every field that holds a list or an object
becomes child rows with their own surrogate key, the key of their parent row
and the place in the whole list, and so on down to the deepest level. The
merged schema of each level follows from all of its rows and gives the columns
of its flat table. Lists may be delivered in several shapes: an array, a
single object, pages of rows, an object with items, or any of these as a JSON
string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.functions.text import strip_blanks
from sievemill.session import cut


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def parse_record(line: Column, envelopes: tuple[str, ...] = ("case", "record")) -> Column:
    """The record of a JSON line as VARIANT, taken out of its envelope.

    Outer white space and byte order marks are ignored. A line broken off, a
    line of another kind than an object, and a null or blank line give null.
    An envelope may hold the record itself or its JSON text.
    """
    def out(whole: Column) -> Column:
        return F.coalesce(*(_unstring(F.try_variant_get(whole, f"$.{e}", "variant")) for e in envelopes), whole) if envelopes else whole

    parsed = _let(F.try_parse_json(strip_blanks(line)), out)
    return _let(parsed, lambda v: F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), v))


def _unstring(value: Column) -> Column:
    """A variant, or what its JSON text holds. Arrays and objects are told first: naming their type would read them whole."""
    nested = F.try_variant_get(value, "$", "map<string,variant>").isNotNull() | F.try_variant_get(value, "$", "array<variant>").isNotNull()
    return F.when(nested, value).when(F.schema_of_variant(value) == "STRING", F.try_parse_json(F.try_variant_get(value, "$", "string"))).otherwise(value)


def list_elements(value: Column) -> Column:
    """The elements of a list, whatever its shape, as ARRAY<VARIANT>.

    Pages are put in the order of their number. Null and empty elements keep
    their place. Null, an empty string and an empty object are empty lists.
    """
    return _elements(value)["items"]


def _elements(value: Column) -> Column:
    """struct(shape, items) of a value: shape is list, object or null (neither)."""
    none = F.array().cast("array<variant>")

    def numbered(pages: Column) -> Column:
        each = F.transform(pages, lambda p, i: F.struct(F.coalesce(F.try_variant_get(p, "$.page", "bigint"), i.cast("bigint")).alias("n"), i.alias("i"), _inner_list(p, "$.rows").alias("rows")))
        order = F.array_sort(F.transform(each, lambda x: F.struct(x["n"], x["i"])))
        return _let(each, lambda e: F.flatten(F.transform(order, lambda o: F.coalesce(F.element_at(e, (o["i"] + 1).cast("int"))["rows"], none))))

    def of_object(v: Column, fields: Column) -> Column:
        pages, items = F.try_variant_get(v, "$.pages", "array<variant>"), F.try_element_at(fields, F.lit("items"))
        listed = _let(_unstring(items), lambda x: F.try_variant_get(x, "$", "array<variant>"))
        single = F.struct(F.lit("object").alias("shape"), F.array(v).alias("items"))
        paged = F.struct(F.lit("list").alias("shape"), numbered(pages).alias("items"))
        return F.when(F.map_contains_key(fields, "pages") & pages.isNotNull(), paged).when(
            F.map_contains_key(fields, "items"), _let(listed, lambda x: F.when(x.isNotNull(), F.struct(F.lit("list").alias("shape"), x.alias("items"))).otherwise(single))
        ).when(F.size(fields) > 0, single)

    def of_value(v: Column) -> Column:
        return _let(
            F.struct(F.try_variant_get(v, "$", "array<variant>").alias("a"), F.try_variant_get(v, "$", "map<string,variant>").alias("m")),
            lambda k: F.when(k["a"].isNotNull(), F.struct(F.lit("list").alias("shape"), k["a"].alias("items"))).when(k["m"].isNotNull(), of_object(v, k["m"])),
        )

    found = _let(_unstring(value), of_value)
    return F.coalesce(found, F.struct(F.lit(None).cast("string").alias("shape"), none.alias("items")))


def _inner_list(value: Column, path: str) -> Column:
    return F.try_variant_get(_unstring(F.try_variant_get(value, path, "variant")), "$", "array<variant>")


def has_fields(element: Column) -> Column:
    """True for an object with at least one field."""
    return F.coalesce(F.size(F.try_variant_get(element, "$", "map<string,variant>")) > 0, F.lit(False))


def has_values(element: Column) -> Column:
    """True for an object with at least one field that isn't null."""
    fields = F.map_values(F.try_variant_get(element, "$", "map<string,variant>"))
    return F.coalesce(F.exists(fields, lambda v: v.isNotNull() & ~F.is_variant_null(v)), F.lit(False))


def child_rows(records: DataFrame, key: str, record: str, only: list[str] | None = None, most_levels: int = 32) -> DataFrame:
    """The child rows of all levels: ``key, path, shape, parent_id, parent_ordinal, ordinal, row_id, element``.

    ``record`` is a VARIANT column. ``path`` names the level by the fields
    that lead to it, joined by dots. ``row_id`` is the surrogate key (the
    parent's key, the field and the ordinal); the root's is its ``key`` as
    text. ``shape`` is list, or object for a value that is one object. Rows
    are the objects with at least one field: null and empty elements, and
    elements of other kinds, keep their place but don't come out.

    Levels are found in the data; ``only`` keeps the named paths and reads
    nothing else. Each level is written once and read for the next; there are
    as many rounds as levels. More than ``most_levels`` are an error. Records
    of null give no rows, repeated records give repeated rows.
    """
    level = records.where(F.col(record).isNotNull()).select(
        F.col(key).alias("__key"), F.lit("").alias("path"), F.col(key).cast("string").alias("row_id"), F.lit(None).cast("int").alias("ordinal"), F.col(record).alias("element")
    )
    out = []
    for depth in range(1, most_levels + 2):
        named = None if only is None else {p for o in only for p in [".".join(o.split(".")[:depth])] if len(o.split(".")) >= depth}
        if named is not None and not named:
            break
        path = lambda e: F.when(F.col("path") == "", e["key"]).otherwise(F.concat_ws(".", "path", e["key"]))
        fields = F.map_entries(F.try_variant_get("element", "$", "map<string,variant>"))
        if named is not None:
            fields = F.filter(fields, lambda e: path(e).isin(*sorted(named)))
        found = F.transform(fields, lambda e: F.struct(path(e).alias("path"), e["key"].alias("name"), _elements(e["value"]).alias("l")))
        each = level.select("__key", F.col("row_id").alias("parent_id"), F.col("ordinal").alias("parent_ordinal"), F.explode(F.filter(found, lambda f: f["l"]["shape"].isNotNull())).alias("f"))
        rows = each.select(
            "__key", F.col("f.path").alias("path"), F.col("f.l.shape").alias("shape"), "parent_id", "parent_ordinal", F.col("f.name").alias("__name"),
            F.posexplode("f.l.items").alias("ordinal", "element"),
        ).where(has_fields(F.col("element")))
        rows = rows.withColumn("row_id", F.concat_ws("/", "parent_id", "__name", F.col("ordinal").cast("string"))).drop("__name")
        level = cut(rows)
        if level.isEmpty():
            break
        if depth > most_levels:
            raise ValueError(f"records are nested deeper than {most_levels} levels")
        out.append(level)
    if not out:
        out.append(level)
    whole = reduce(DataFrame.unionByName, out)
    if only is not None:
        whole = whole.where(F.col("path").isin(*only))
    return whole.select(F.col("__key").alias(key), "path", "shape", "parent_id", "parent_ordinal", "ordinal", "row_id", "element")


def merged_schema(children: DataFrame, by: str = "path", element: str = "element") -> DataFrame:
    """The merged schema of all elements of each level, as DDL text."""
    return children.groupBy(by).agg(F.schema_of_variant_agg(element).alias("schema"))


def level_tables(children: DataFrame, key: str, most_paths: int = 1000) -> dict[str, DataFrame]:
    """The flat table of each level: ``key, parent_id, ordinal, row_id`` and its scalar fields, typed by its merged schema.

    Fields whose values don't agree on a type stay VARIANT; lists and objects
    have tables of their own. Names that clash get the suffix ``_``. The
    number of levels is bounded by the records' make, not their number; more
    than ``most_paths`` are an error.
    """
    schemas = merged_schema(children).limit(most_paths + 1).collect()
    if len(schemas) > most_paths:
        raise ValueError(f"more than {most_paths} levels: field names seem to be data")
    out, paths = {}, {r["path"] for r in schemas}
    for r in schemas:
        merged = T._parse_datatype_string(r["schema"].replace("OBJECT<", "STRUCT<"))
        kept = [f for f in merged.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType)) and f"{r['path']}.{f.name}" not in paths]
        taken, columns = {key.lower(), "parent_id", "ordinal", "row_id"}, []
        for f in kept:
            label = f.name
            while label.lower() in taken:
                label += "_"
            taken.add(label.lower())
            kind = "string" if isinstance(f.dataType, T.NullType) else f.dataType.simpleString()
            value = F.try_element_at(F.try_variant_get("element", "$", "map<string,variant>"), F.lit(f.name))
            columns.append((value if kind == "variant" else F.try_variant_get(value, "$", kind)).alias(label))
        out[r["path"]] = children.where(F.col("path") == r["path"]).select(key, "parent_id", "ordinal", "row_id", *columns)
    return out


def flatten_tables(df: DataFrame, key: str, name: str = "root") -> dict[str, DataFrame]:
    """Turn a DataFrame with arrays of structs into related flat tables.

    The root keeps all scalar columns, with structs flattened to
    ``outer_inner``. Each array column, at any depth, becomes a table named
    by its path with the columns ``parent_id`` (the surrogate key of its
    parent row), ``ordinal`` (place in the list, from 0), ``row_id`` (its own
    surrogate key: parent's key and ordinal, so children of children link to
    it) and the element's fields. Null elements are left out and keep their
    ordinal; null and empty arrays give no rows. Names that clash get the
    suffix ``_``. An array of scalars has the field ``value``.
    """
    out: dict[str, DataFrame] = {}

    def walk(frame: DataFrame, path: str, ids: list[str]) -> None:
        scalars: list[Column] = []
        arrays: list[tuple[str, Column, T.ArrayType]] = []
        taken = {i.lower() for i in ids}

        def fields(schema: T.StructType, prefix: str, at: Column | None) -> None:
            for f in schema.fields:
                if at is None and f.name in ids:
                    continue
                col = F.col(f"`{f.name}`") if at is None else at.getField(f.name)
                label = f"{prefix}{f.name}"
                if isinstance(f.dataType, T.StructType):
                    fields(f.dataType, f"{label}_", col)
                elif isinstance(f.dataType, T.ArrayType):
                    arrays.append((label, col, f.dataType))
                else:
                    while label.lower() in taken:
                        label += "_"
                    taken.add(label.lower())
                    scalars.append(col.alias(label))

        fields(frame.schema, "", None)
        out[path] = frame.select(*ids, *scalars)
        for label, col, kind in arrays:
            exploded = frame.select(F.col(ids[-1]).cast("string").alias("parent_id"), F.posexplode(col).alias("ordinal", "__e")).where("__e is not null")
            row_id = F.concat_ws("/", "parent_id", F.lit(label), "ordinal").alias("row_id")
            if isinstance(kind.elementType, T.StructType):
                child = exploded.select("parent_id", "ordinal", row_id, *(F.col("__e").getField(f.name).alias(f.name if f.name.lower() not in ("parent_id", "ordinal", "row_id") else f"{f.name}_") for f in kind.elementType.fields))
            else:
                child = exploded.select("parent_id", "ordinal", row_id, F.col("__e").alias("value"))
            walk(child, f"{path}_{label}", ["parent_id", "ordinal", "row_id"])

    walk(df, name, [key])
    return out
