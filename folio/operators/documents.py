"""Documents of books as JSON, both ways: {"nodes": [...], "relationships": [...]}, nodes told apart by their type.

Out, each node is written by the keys of its type; in, a document is a VARIANT, whose nodes are typed one by one, so a document with a node
that isn't as it should be says which, and the others can be read.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.evidence import MARKER_TYPE, REGION_TYPE, TYPOGRAPHY_TYPE

FRAGMENT_TYPE = "struct<page_id:string,block_id:string,span_ids:array<string>>"
SPAN_TYPE = f"struct<span_id:string,text:string,language:string,source_typography:{TYPOGRAPHY_TYPE},semantic_marks:array<string>,provenance:array<{FRAGMENT_TYPE}>>"
CHILD_TYPE = f"struct<node_id:string,node_type:string,ordinal:int,marker:{MARKER_TYPE},spans:array<{SPAN_TYPE}>,provenance:array<{FRAGMENT_TYPE}>>"
NODE = ("book_id", "node_pos", "node_id", "node_type", "role", "level", "list_kind", "label", "region", "children", "spans", "provenance")
RELATIONSHIP = ("relationship_id", "kind", "source_id", "target_id", "confidence", "reasons")
# Fixed keys and values of the format.
PLAIN_TYPES = ("paragraph", "heading", "footnote", "attribution")
CHILDREN_KEY = {"list": "items", "verse": "lines", "quotation": "children"}
CHILD_OF = {"list": "list_item", "verse": "verse_line", "quotation": "paragraph"}
LIST_KINDS = ("ordered", "unordered")
_NULLS = {"ignoreNullFields": "false"}


def _object(**fields: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(k) for k, c in fields.items())), _NULLS)


def _joined(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _with(head: Column, *more: tuple[str, Column]) -> Column:
    """A JSON object with further keys, whose values are JSON."""
    return _joined(F.substring(head, F.lit(1), F.length(head) - 1), *(x for key, value in more for x in (f',"{key}":', value)), "}")


def _list(items: Column) -> Column:
    return _joined("[", F.array_join(items, ","), "]")


def node_json(nodes: DataFrame) -> Column:
    """The JSON of a row of nodes; null for a type that has none."""
    head = _object(type=F.col("node_type"), node_id=F.col("node_id"))
    spans, origin = F.to_json("spans", _NULLS), F.to_json("provenance", _NULLS)
    text = lambda **own: _with(head, *((k, F.coalesce(F.to_json(F.array(c), _NULLS).substr(F.lit(2), F.length(F.to_json(F.array(c), _NULLS)) - 2), F.lit("null"))) for k, c in own.items()), ("spans", spans), ("provenance", origin))
    ends = lambda c: {"spans": c["spans"], "provenance": c["provenance"]}
    item = lambda c: _object(node_id=c["node_id"], marker=c["marker"], ordinal=c["ordinal"], **ends(c))
    line = lambda c: _object(node_id=c["node_id"], **ends(c))
    inner = lambda c: _object(type=F.lit("paragraph"), node_id=c["node_id"], **ends(c))
    kids = lambda f: _list(F.transform("children", f))
    of = lambda kind: F.get(F.filter("children", lambda c: c["node_type"] == kind), F.lit(0))
    image, caption = of("image"), of("caption")
    picture = _object(node_id=image["node_id"], source_region=F.col("region"), asset_id=F.lit(None).cast("string"), provenance=image["provenance"])
    under = F.when(caption["node_id"].isNull(), "null").otherwise(_object(node_id=caption["node_id"], **ends(caption)))
    kind = F.col("node_type")
    return (
        F.when(kind == "heading", text(role=F.col("role"), level=F.col("level")))
        .when(kind == "footnote", text(label=F.col("label")))
        .when(kind.isin("paragraph", "attribution"), text())
        .when(kind == "list", _with(head, ("kind", F.to_json(F.array("list_kind")).substr(F.lit(2), F.length("list_kind") + 2)), ("items", kids(item)), ("provenance", origin)))
        .when(kind == "verse", _with(head, ("lines", kids(line)), ("provenance", origin)))
        .when(kind == "quotation", _with(head, ("children", kids(inner)), ("provenance", origin)))
        .when(kind == "figure", _with(head, ("image", picture), ("caption", under), ("provenance", origin)))
    )


def document_json(nodes: DataFrame, relationships: DataFrame) -> DataFrame:
    """(book_id, document) of analysed books, nodes in reading order and relationships by their id. A book is one row, as it is one file.
    The format has no text for the image of a figure.
    Raises ValueError for nodes of a type that has no JSON."""
    rows = nodes.select("book_id", "node_pos", "node_type", node_json(nodes).alias("json"))
    bad = rows.where("json is null").select("book_id", "node_type").limit(5).collect()
    if bad:
        raise ValueError(f"nodes without a JSON form: {[tuple(r) for r in bad]}")
    whole = lambda df, order: df.groupBy("book_id").agg(_list(F.transform(F.sort_array(F.collect_list(F.struct(order, "json"))), lambda x: x["json"])).alias("json"))
    links = relationships.select("book_id", "relationship_id", F.to_json(F.struct(*RELATIONSHIP), _NULLS).alias("json"))
    both = whole(rows, "node_pos").withColumnRenamed("json", "n").join(whole(links, "relationship_id").withColumnRenamed("json", "r"), "book_id", "full_outer")
    return both.select("book_id", _joined('{"nodes":', F.coalesce("n", F.lit("[]")), ',"relationships":', F.coalesce("r", F.lit("[]")), "}").alias("document"))


def canonical(text: Column) -> Column:
    """JSON with sorted keys and no white space; null for what is no JSON."""
    return F.to_json(F.try_parse_json(text))


def indented(rows: DataFrame, column: str = "document") -> DataFrame:
    """rows with the JSON of a column as files have it: sorted keys, two blanks a level, a line feed at the end."""

    @F.pandas_udf("string")
    def laid_out(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=2, sort_keys=True) + "\n")

    return rows.withColumn(column, laid_out(F.col(column)))


def _text(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _typed(v: Column) -> Column:
    """The fields of a node by the types of the format; null for what is missing or of another type."""
    kind, get = _text(v, "$.type"), lambda path, type_: F.try_variant_get(v, path, type_)
    items = lambda t: get(f"$.{CHILDREN_KEY[t]}", f"array<{CHILD_TYPE}>")
    part = lambda key: F.struct(_text(v, f"$.{key}.node_id").alias("node_id"), get(f"$.{key}.spans", f"array<{SPAN_TYPE}>").alias("spans"), get(f"$.{key}.provenance", f"array<{FRAGMENT_TYPE}>").alias("provenance"))
    fields = {
        "kind": kind,
        "node_id": _text(v, "$.node_id"),
        "provenance": get("$.provenance", f"array<{FRAGMENT_TYPE}>"),
        "spans": F.when(kind.isin(*PLAIN_TYPES), get("$.spans", f"array<{SPAN_TYPE}>")),
        "parts": reduce(lambda c, t: F.when(kind == t, items(t)).otherwise(c), CHILDREN_KEY, F.lit(None)),
        "list_kind": F.when(kind == "list", _text(v, "$.kind")),
        "role": F.when(kind == "heading", _text(v, "$.role")),
        "level": F.when(kind == "heading", get("$.level", "int")),
        "label": F.when(kind == "footnote", _text(v, "$.label")),
        "image": F.when(kind == "figure", part("image")),
        "caption": F.when(kind == "figure", part("caption")),
        "region": F.when(kind == "figure", get("$.image.source_region", REGION_TYPE)),
    }
    return F.struct(*(c.alias(k) for k, c in fields.items()))


def _problem(n: Column) -> Column:
    """What is wrong with a node (_typed); null if nothing is."""
    kind = n["kind"]
    known = F.coalesce(kind.isin(*PLAIN_TYPES, *CHILDREN_KEY, "figure"), F.lit(False))
    spans = F.when(kind.isin(*PLAIN_TYPES) & n["spans"].isNull(), "no spans")
    parts = [F.when((kind == t) & n["parts"].isNull(), f"no {k}") for t, k in CHILDREN_KEY.items()]
    listed = F.when((kind == "list") & ~F.coalesce(n["list_kind"].isin(*LIST_KINDS), F.lit(False)), "unknown kind of list")
    role = F.when((kind == "heading") & n["role"].isNull(), "no role")
    image = F.when((kind == "figure") & (n["image"]["node_id"].isNull() | n["region"].isNull()), "no image")
    return F.coalesce(F.when(~known, F.concat(F.lit("unknown type "), F.coalesce(kind, F.lit("null")))), F.when(n["node_id"].isNull(), "no node_id"), F.when(n["provenance"].isNull(), "no provenance"), spans, *parts, listed, role, image)


def _opened(rows: DataFrame, key: str) -> DataFrame:
    """(book_id, place from 0, v) of the items of a list in (book_id, document)."""
    parsed = rows.select("book_id", F.try_variant_get(F.try_parse_json("document"), f"$.{key}", "array<variant>").alias("_all"))
    return parsed.select("book_id", F.posexplode("_all").alias("place", "v"))


def _nodes(rows: DataFrame) -> DataFrame:
    """(book_id, place, n) of the nodes of (book_id, document). As a list of one item n is made once, and not again for each step that reads it."""
    return _opened(rows, "nodes").select("book_id", "place", F.explode(F.array(_typed(F.col("v")))).alias("n"))


def document_problems(rows: DataFrame) -> DataFrame:
    """(book_id, place, problem) of documents (book_id, document): place null for what is wrong with the whole."""
    v = F.try_parse_json("document")
    missing = F.when(v.isNull(), "not JSON").when(F.try_variant_get(v, "$.nodes", "array<variant>").isNull(), "no nodes").when(F.try_variant_get(v, "$.relationships", "array<variant>").isNull(), "no relationships")
    whole = rows.select("book_id", F.lit(None).cast("int").alias("place"), missing.alias("problem"))
    links = F.when(reduce(Column.__or__, (_text(F.col("v"), f"$.{k}").isNull() for k in RELATIONSHIP[:4])), "relationship without an end").when(_text(F.col("v"), "$.confidence", "double").isNull(), "relationship without confidence")
    each = _nodes(rows).select("book_id", "place", _problem(F.col("n")).alias("problem"))
    return whole.unionByName(each).unionByName(_opened(rows, "relationships").select("book_id", "place", links.alias("problem"))).where("problem is not null")


def document_nodes(rows: DataFrame) -> DataFrame:
    """NODE of documents (book_id, document); nodes with a problem are left out."""
    n = F.col("n")
    kind = n["kind"]
    typed = lambda child, name: F.struct(child["node_id"].alias("node_id"), name.alias("node_type"), child["ordinal"].alias("ordinal"), child["marker"].alias("marker"), child["spans"].alias("spans"), child["provenance"].alias("provenance"))
    name = reduce(lambda c, t: F.when(kind == t, CHILD_OF[t]).otherwise(c), CHILDREN_KEY, F.lit(None))
    part = lambda key: F.struct(n[key]["node_id"].alias("node_id"), F.lit(key).alias("node_type"), F.lit(None).cast("int").alias("ordinal"), F.lit(None).cast(MARKER_TYPE).alias("marker"), F.coalesce(n[key]["spans"], F.array().cast(f"array<{SPAN_TYPE}>")).alias("spans"), n[key]["provenance"].alias("provenance"))
    figure = F.filter(F.array(part("image"), part("caption")), lambda c: c["node_id"].isNotNull())
    children = F.when(kind == "figure", figure).otherwise(F.transform(n["parts"], lambda c: typed(c, name)))
    own = ("role", "level", "list_kind", "label", "region")
    return (
        _nodes(rows)
        .where(_problem(n).isNull())
        .select("book_id", (F.col("place") + 1).alias("node_pos"), n["node_id"].alias("node_id"), kind.alias("node_type"), *(n[k].alias(k) for k in own), children.alias("children"), n["spans"].alias("spans"), n["provenance"].alias("provenance"))
    )


def document_relationships(rows: DataFrame) -> DataFrame:
    """(book_id, RELATIONSHIP) of documents (book_id, document)."""
    v = F.col("v")
    kinds = {"confidence": "double", "reasons": "array<string>"}
    return _opened(rows, "relationships").select("book_id", *(F.try_variant_get(v, f"$.{k}", kinds.get(k, "string")).alias(k) for k in RELATIONSHIP))
