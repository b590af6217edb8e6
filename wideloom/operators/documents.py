"""Mapping of schemaless JSON documents onto a declared, partitioned table.

A mapping is declared as two comma-separated lists of ``name type`` pairs of
equal length: source fields (a dotted ``list.key`` addresses a key inside a
list of objects) and target columns.  Documents are parsed once into a
VARIANT; every target column is one ``try_variant_get``.  Source fields that
are not declared are dropped, declared fields that are missing become null,
and the partition column comes last.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import format_epoch_millis, reformat_date_text

# Accepted type names of a mapping.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class FieldMap:
    source: str
    source_type: str
    target: str
    target_type: str


@dataclass(frozen=True)
class Mapping:
    fields: tuple[FieldMap, ...]
    partition: str

    @property
    def schema(self) -> T.StructType:
        cols = [T.StructField(f.target, TYPE_NAMES[f.target_type], True) for f in self.fields]
        return T.StructType(cols + [T.StructField(self.partition, T.StringType(), True)])


def _pairs(text: str) -> list[tuple[str, str]]:
    out = []
    for item in text.split(","):
        item = item.strip()
        if not item:
            continue
        parts = item.split()
        if len(parts) != 2:
            raise ValueError(f"expected 'name type', got {item!r}")
        out.append((parts[0], parts[1]))
    return out


def parse_mapping(source_list: str, target_list: str, partition: str) -> Mapping:
    """Driver-side metadata only: validate the two lists and build the schema."""
    src, tgt = _pairs(source_list), _pairs(target_list)
    if len(src) != len(tgt):
        raise ValueError("source and target column lists differ in length")
    fields = []
    for (s_name, s_type), (t_name, t_type) in zip(src, tgt):
        for name, typ in ((s_name, s_type), (t_name, t_type)):
            if typ not in TYPE_NAMES:
                raise ValueError(f"unsupported type {name}:{typ}")
        fields.append(FieldMap(s_name, s_type, t_name, t_type))
    return Mapping(tuple(fields), partition)


def list_last(arr: Column, key: str) -> Column:
    """From a list of objects, the value of ``key`` in the last object that has
    the key (an explicit null there wins); null for an empty/missing list."""
    having = F.filter(arr, lambda m: F.map_contains_key(m, F.lit(key)))
    return F.element_at(F.try_element_at(having, F.lit(-1)), F.lit(key))


def _path(*names: str) -> str:
    return "$" + "".join("['" + n.replace("'", "\\'") + "']" for n in names)


def field_value(v: Column, source: str, target_type: str) -> Column:
    """Value of a declared source field from a VARIANT document."""
    if "." not in source:
        return F.try_variant_get(v, _path(source), target_type)
    head, sub = source.split(".", 1)
    as_list = F.try_variant_get(v, _path(head), "array<map<string,string>>")
    from_list = list_last(as_list, sub).try_cast(target_type)
    from_object = F.try_variant_get(v, _path(head, sub), target_type)
    return F.when(as_list.isNotNull(), from_list).otherwise(from_object)


def partition_value(value_text: Column, kind: str, out_format: str, in_format: str | None = None,
                    zone: str = "UTC") -> Column:
    """Partition text from a document field: ``timestamp`` = epoch milliseconds,
    anything else = date/time text parsed with ``in_format`` (default
    'yyyy-MM-dd HH:mm:ss')."""
    if kind == "timestamp":
        return format_epoch_millis(value_text.try_cast("long"), out_format, zone)
    return reformat_date_text(value_text, in_format or "yyyy-MM-dd HH:mm:ss", out_format)


def field_ignore_case(doc: Column, name: str, parsed: bool = False) -> Column:
    """Top-level field matched case-insensitively, as text.  ``doc`` is JSON
    text, or (``parsed=True``) an already parsed VARIANT document."""
    if parsed:
        m = F.try_variant_get(doc, "$", "map<string,string>")
    else:
        m = F.from_json(doc, T.MapType(T.StringType(), T.StringType()))
    hit = F.map_filter(m, lambda k, _v: F.lower(k) == F.lit(name.lower()))
    return F.try_element_at(F.map_values(hit), F.lit(1))


def readable(doc_col: str) -> Column:
    """The text is a JSON object, whole and well formed."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(doc_col))).startswith("OBJECT"), F.lit(False))


def project_documents(docs: DataFrame, doc_col: str, mapping: Mapping,
                      partition_source: str, partition_kind: str, partition_format: str,
                      partition_in_format: str | None = None,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Documents (JSON text column) -> rows of the mapping's schema (plus
    ``keep`` columns in front).  Row-local: no shuffle.

    The document is parsed once into a VARIANT in its own projection (Catalyst
    keeps it separate because several fields read it) and every field is a
    path lookup into that value."""
    parsed = docs.select(*keep, F.col(doc_col).alias("__doc"), F.try_parse_json(F.col(doc_col)).alias("__v"))
    v = F.col("__v")
    cols = [F.col(k) for k in keep]
    for f in mapping.fields:
        cols.append(field_value(v, f.source, f.target_type).cast(TYPE_NAMES[f.target_type]).alias(f.target))
    # a plain map parse of the text is cheaper here than casting the VARIANT
    part = partition_value(field_ignore_case(F.col("__doc"), partition_source), partition_kind,
                           partition_format, partition_in_format)
    cols.append(part.alias(mapping.partition))
    return parsed.select(*cols)


def last_with_key(rows: DataFrame, keys: Sequence[str], order_col: str, value_cols: Sequence[str],
                  names: Sequence[str] | None = None) -> DataFrame:
    """Grouped form of ``list_last`` for lists stored one element per row:
    per key, each value of the highest-ordered element.  Every row carries all
    columns, so an explicit null in the last element wins, as in ``list_last``.
    ``max_by`` is partially aggregated, so a very long list (a hot key) never
    has to be gathered into one task."""
    names = names or value_cols
    aggs = [F.max_by(c, order_col).alias(n) for c, n in zip(value_cols, names)]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("N_ITEMS"), *aggs)
