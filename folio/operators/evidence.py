"""Page evidence: strict contracts, deterministic ids, canonical round trip, flat views.

A contract is a table of fields (Field); one small checker reads it and reports every violation with its path. JSON has
to be judged before it is typed, as types coerce, so contracts are checked on the raw text in Arrow batches; everything
after that is DataFrame operations on the typed page.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import block_id, span_id

# Fixed values of the contracts.
PAGE_KINDS = ("cover", "title", "copyright", "toc", "chapter_title", "text", "illustration", "blank", "other")
BLOCK_ROLES = ("paragraph", "heading", "quote", "list_item", "verse", "attribution", "footnote", "image", "caption", "table", "page_header", "page_footer", "page_number", "other", "unknown")
HEADING_ROLES = ("chapter_label", "chapter_title", "section_title", "subsection_title", "subtitle", "genre_label", "scenario_label", "scenario_title", "unknown")
MARKER_KINDS = ("bullet", "numeric", "alphabetic", "dash", "graphic", "unknown")
ALIGNMENTS = ("left", "center", "right", "justify")
POSTURES, WEIGHTS = ("roman", "italic", "unknown"), ("normal", "bold", "unknown")
VERTICALS, CAPS = ("baseline", "superscript", "subscript", "unknown"), ("normal", "small_caps", "unknown")
DECORATIONS = ("underline",)
OLD_BLOCK_TYPES = ("heading", "paragraph", "quote", "list", "image", "image_caption", "footnote", "table", "page_header", "page_footer", "page_number", "other")
#: Role of each block type of the earlier contract.
ROLE_OF_TYPE = {t: {"image_caption": "caption"}.get(t, t) for t in OLD_BLOCK_TYPES}

TYPOGRAPHY_TYPE = "struct<posture:string,weight:string,vertical_position:string,caps_style:string,decorations:array<string>>"
SPAN_TYPE = f"struct<span_id:string,text:string,language:string,source_typography:{TYPOGRAPHY_TYPE},semantic_line_break_after:boolean>"
MARKER_TYPE = "struct<kind:string,raw_text:string,ordinal:int>"
REGION_TYPE = "struct<x:double,y:double,width:double,height:double>"
BLOCK_TYPE = f"struct<block_id:string,sequence_index:int,role_hint:string,content:array<{SPAN_TYPE}>,dominant_language:string,heading_level_hint:int,heading_role_hint:string,marker:{MARKER_TYPE},region:{REGION_TYPE},alignment:string>"
PAGE_TYPE = f"struct<page_id:string,page_kind_hint:string,dominant_language:string,printed_page_number:string,blocks:array<{BLOCK_TYPE}>,warnings:array<string>>"

#: Rows of a batch that are judged together.
SLICE = 64

Check = Callable[[Any, str], Iterator[str]]


@dataclass(frozen=True)
class Field:
    """What a value must be. kind: text, flag, whole, number, object or list; several may be named, and null."""

    kinds: frozenset[str]
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    filled: bool = False
    distinct: bool = False
    keys: dict[str, Field] = field(default_factory=dict)
    items: Field | None = None
    more: Check | None = None
    strict: bool = True


def _kind(value: Any) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "flag"
    if isinstance(value, int):
        return "whole"
    return {str: "text", float: "number", dict: "object", list: "list"}[type(value)]


def problems(value: Any, want: Field, path: str) -> Iterator[str]:
    """Every way in which a value breaks its contract."""
    kind = _kind(value)
    if kind not in want.kinds and not (kind == "whole" and "number" in want.kinds):
        yield f"{path}: {kind} instead of {' or '.join(sorted(want.kinds))}"
        return
    if kind == "text" and want.values and value not in want.values:
        yield f"{path}: unsupported value {value!r}"
    if kind == "text" and want.filled and not value:
        yield f"{path}: empty"
    if kind in ("whole", "number"):
        if not math.isfinite(value):
            yield f"{path}: not finite"
        elif (want.low is not None and value < want.low) or (want.high is not None and value > want.high):
            yield f"{path}: out of range"
    if kind == "object" and want.keys:
        yield from (f"{path}: missing {k}" for k in sorted(want.keys.keys() - value.keys()) if want.strict)
        yield from (f"{path}: extra {k}" for k in sorted(value.keys() - want.keys.keys()) if want.strict)
        for k in want.keys:
            if k in value or not want.strict:
                yield from problems(value.get(k), want.keys[k], f"{path}.{k}")
    if kind == "list" and want.items:
        for i, v in enumerate(value):
            yield from problems(v, want.items, f"{path}[{i}]")
        if want.distinct and len({json.dumps(v) for v in value}) < len(value):
            yield f"{path}: repeated value"
    if want.more and kind != "null":
        yield from want.more(value, path)


def _of(*kinds: str, **rules: Any) -> Field:
    return Field(frozenset(kinds), **rules)


def _inside(region: dict, path: str) -> Iterator[str]:
    for at, size in (("x", "width"), ("y", "height")):
        a, b = region.get(at), region.get(size)
        if all(_kind(v) in ("whole", "number") for v in (a, b)) and a + b > 1:
            yield f"{path}: {at} + {size} over 1"


def _headings_only(block: dict, path: str) -> Iterator[str]:
    if block.get("role_hint") != "heading":
        if block.get("heading_level_hint") is not None:
            yield f"{path}: heading level of a block that is no heading"
        if block.get("heading_role_hint") not in ("unknown", None):
            yield f"{path}: heading role of a block that is no heading"


def _old_headings_only(block: dict, path: str) -> Iterator[str]:
    if block.get("type") != "heading" and block.get("level") is not None:
        yield f"{path}: level of a block that is no heading"


_TEXT, _MAYBE = _of("text"), _of("text", "null")
_TYPOGRAPHY = _of("object", keys={"posture": _of("text", values=POSTURES), "weight": _of("text", values=WEIGHTS), "vertical_position": _of("text", values=VERTICALS), "caps_style": _of("text", values=CAPS), "decorations": _of("list", items=_of("text", values=DECORATIONS), distinct=True)})
_SPAN = _of("object", keys={"text": _TEXT, "language": _MAYBE, "source_typography": _TYPOGRAPHY, "semantic_line_break_after": _of("flag")})
_MARKER = _of("object", "null", keys={"kind": _of("text", values=MARKER_KINDS), "raw_text": _MAYBE, "ordinal": _of("whole", "null", low=1)})
_UNIT = _of("number", low=0, high=1)
_REGION = _of("object", "null", keys={"x": _UNIT, "y": _UNIT, "width": _UNIT, "height": _UNIT}, more=_inside)
_BLOCK = _of("object", keys={"role_hint": _of("text", values=BLOCK_ROLES), "content": _of("list", items=_SPAN), "dominant_language": _MAYBE, "heading_level_hint": _of("whole", "null", low=1, high=6), "heading_role_hint": _of("text", values=HEADING_ROLES), "marker": _MARKER, "region": _REGION, "alignment": _of("text", "null", values=ALIGNMENTS)}, more=_headings_only)
#: A page as a provider returns it.
PAGE = _of("object", keys={"page_kind_hint": _of("text", values=PAGE_KINDS), "dominant_language": _MAYBE, "printed_page_number": _MAYBE, "blocks": _of("list", items=_BLOCK), "warnings": _of("list", items=_TEXT)})
#: Where a page comes from, in a stored page.
SOURCE = _of("object", keys={"source_id": _of("text", filled=True), "uri": _of("text", filled=True), "sha256": _MAYBE, "media_type": _MAYBE, "metadata": _of("object")})
_OLD_SPAN = _of("object", strict=False, keys={"text": _TEXT, "typography": _TYPOGRAPHY})
_OLD_BLOCK = _of("object", strict=False, keys={"type": _of("text", values=OLD_BLOCK_TYPES), "content": _of("list", items=_OLD_SPAN), "language": _MAYBE, "level": _of("whole", "null", low=1, high=6), "alignment": _of("text", "null", values=ALIGNMENTS)}, more=_old_headings_only)
#: A page of the earlier contract, whose keys may be missing (then null) or more.
OLD_PAGE = _of("object", strict=False, keys={"page_kind": _of("text", values=PAGE_KINDS), "language": _MAYBE, "printed_page_number": _MAYBE, "blocks": _of("list", items=_OLD_BLOCK), "warnings": _of("list", items=_TEXT)})


def _block_ids(page_id: str, i: int) -> str:
    return f"{page_id}:block:{i + 1:04d}"


def _span_ids(block: str, i: int) -> str:
    return f"{block}:span:{i + 1:04d}"


def identified(page_id: str, page: dict) -> dict:
    """A page that keeps its contract, with ids and positions."""
    blocks = []
    for i, b in enumerate(page["blocks"]):
        bid = _block_ids(page_id, i)
        region = b["region"] and {k: float(v) for k, v in b["region"].items()}
        blocks.append(b | {"block_id": bid, "sequence_index": i, "region": region, "content": [s | {"span_id": _span_ids(bid, j)} for j, s in enumerate(b["content"])]})
    return page | {"page_id": page_id, "blocks": blocks}


def adapted(page: dict) -> dict:
    """A page of the earlier contract in the present one: types become roles, a block's language is its spans'; nothing
    is concluded from texts, so markers, regions and line breaks stay unknown."""
    blocks = []
    for b in page["blocks"]:
        role = ROLE_OF_TYPE[b["type"]]
        spans = [{"text": s["text"], "language": b.get("language"), "source_typography": s["typography"], "semantic_line_break_after": False} for s in b["content"]]
        blocks.append({"role_hint": role, "content": spans, "dominant_language": b.get("language"), "heading_level_hint": b.get("level"), "heading_role_hint": "unknown", "marker": None, "region": None, "alignment": b.get("alignment")})
    return {"page_kind_hint": page["page_kind"], "dominant_language": page.get("language"), "printed_page_number": page.get("printed_page_number"), "blocks": blocks, "warnings": page["warnings"]}


def _parsed(raw: str | None) -> tuple[Any, str | None]:
    try:
        return json.loads(raw or ""), None
    except ValueError:
        return None, "page: not JSON"


def _judge(page_id: str, raw: str | None, version: int) -> tuple[list[str], dict | None]:
    value, bad = _parsed(raw)
    found = [bad] if bad else list(problems(value, PAGE if version == 5 else OLD_PAGE, "page"))
    if found:
        return found, None
    return [], identified(page_id, value if version == 5 else adapted(value))


def _judge_stored(raw: str | None) -> tuple[list[str], dict | None]:
    """A stored page: its source keeps its contract, and it equals what its own content normalises to."""
    value, bad = _parsed(raw)
    if bad or _kind(value) != "object":
        return [bad or "page: no object"], None
    content = {k: v for k, v in value.items() if k not in ("page_id", "source")}
    found = list(problems(value.get("source"), SOURCE, "page.source"))
    if not isinstance(value.get("page_id"), str) or not value["page_id"]:
        found.append("page.page_id: empty")
    bare = json.loads(json.dumps(content))
    for b in bare["blocks"] if isinstance(bare.get("blocks"), list) else []:
        if isinstance(b, dict):
            b.pop("block_id", None), b.pop("sequence_index", None)
            for s in b["content"] if isinstance(b.get("content"), list) else []:
                if isinstance(s, dict):
                    s.pop("span_id", None)
    found += problems(bare, PAGE, "page")
    if found:
        return found, None
    again = identified(value["page_id"], bare)
    return ([], again) if again == content | {"page_id": value["page_id"]} else (["page: not canonical"], None)


def _with_judgement(rows: DataFrame, columns: list[str], judge: Callable[..., tuple[list[str], dict | None]]) -> DataFrame:
    keep = [f for f in rows.schema.fields if f.name not in ("violations", "page_json")]
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Pages become Python objects a few at a time.
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            got = [judge(*args) for args in zip(*(batch.column(n + i).to_pylist() for i in range(len(columns))), strict=True)]
            extra = [pa.array([v for v, _ in got], pa.list_(pa.string())), pa.array([None if p is None else json.dumps(p, ensure_ascii=False) for _, p in got], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *extra], [*batch.schema.names[:n], "violations", "page_json"])

    args = [F.col(c).alias(f"_arg{i}") for i, c in enumerate(columns)]
    out = rows.select(*(f.name for f in keep), *args).mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "violations array<string>", "page_json string"]))
    return out.withColumn("page", F.from_json("page_json", PAGE_TYPE)).drop("page_json")


def normalized(rows: DataFrame, raw: str = "raw", page_id: str = "page_id", version: int = 5) -> DataFrame:
    """rows with violations (all of them; empty if none) and page, the typed evidence with its ids, null if there are any."""
    return _with_judgement(rows, [page_id, raw], lambda i, r: _judge(i, r, version))


def reloaded(rows: DataFrame, stored: str = "stored") -> DataFrame:
    """rows with violations and page of stored pages; a page that isn't what it would be stored as is a violation."""
    return _with_judgement(rows, [stored], _judge_stored)


def stored_page(page: Column, source: Column) -> Column:
    """The JSON of a page with its source, as reloaded() reads it. Nulls are written."""
    fields = [page[f.strip()].alias(f.strip()) for f in ("page_kind_hint", "dominant_language", "printed_page_number", "blocks", "warnings")]
    return F.to_json(F.struct(page["page_id"].alias("page_id"), source.alias("source"), *fields), {"ignoreNullFields": "false"})


def accepted(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages that keep the contract, and the others, for quarantine."""
    return judged.where(F.size("violations") == 0), judged.where(F.size("violations") > 0)


def block_text(block: Column) -> Column:
    return F.array_join(F.transform(block["content"], lambda s: s["text"]), "")


def flat_blocks(pages: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """A row for each block, with its text; pages without blocks give none."""
    b = F.col("block")
    rows = pages.select(*keys, F.col(f"{page}.page_id").alias("page_id"), F.posexplode(f"{page}.blocks").alias("seq", "block"))
    return rows.select(*keys, "page_id", "seq", "block", b["block_id"].alias("block_id"), b["role_hint"].alias("role"), block_text(b).alias("text"), b["dominant_language"].alias("language"))


def flat_spans(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each span of flat blocks."""
    return blocks.select(*keys, "page_id", "block_id", "role", F.posexplode("block.content").alias("span_pos", "span")).select(*keys, "page_id", "block_id", "role", "span_pos", "span.*")


def provenance(page_id: Column, block: Column) -> Column:
    """Where a block's content comes from: page, block, spans."""
    return F.struct(page_id.alias("page_id"), block["block_id"].alias("block_id"), F.transform(block["content"], lambda s: s["span_id"]).alias("span_ids"))


def document_spans(page_id: Column, block: Column) -> Column:
    """A block's spans as logical text: no semantic marks, each with its own provenance."""
    none = F.array().cast("array<string>")
    return F.transform(
        block["content"],
        lambda s: F.struct(s["span_id"].alias("span_id"), s["text"].alias("text"), s["language"].alias("language"), s["source_typography"].alias("source_typography"), none.alias("semantic_marks"), F.array(F.struct(page_id.alias("page_id"), block["block_id"].alias("block_id"), F.array(s["span_id"]).alias("span_ids"))).alias("provenance")),
    )


def page_of_lines(page_id: Column, roles: Column, lines: Column, language: Column) -> Column:
    """A page whose blocks are lines of plain text with given roles, each of one span of unknown typography."""
    plain = F.struct(F.lit("unknown").alias("posture"), F.lit("unknown").alias("weight"), F.lit("unknown").alias("vertical_position"), F.lit("unknown").alias("caps_style"), F.array().cast("array<string>").alias("decorations"))

    def block(pair: Column, i: Column) -> Column:
        bid = block_id(page_id, i)
        span = F.struct(span_id(bid, F.lit(0)).alias("span_id"), pair["line"].alias("text"), language.alias("language"), plain.alias("source_typography"), F.lit(False).alias("semantic_line_break_after"))
        return F.struct(bid.alias("block_id"), i.cast("int").alias("sequence_index"), pair["role"].alias("role_hint"), F.array(span).alias("content"), language.alias("dominant_language"), F.lit(None).cast("int").alias("heading_level_hint"), F.lit("unknown").alias("heading_role_hint"), F.lit(None).cast(MARKER_TYPE).alias("marker"), F.lit(None).cast(REGION_TYPE).alias("region"), F.lit(None).cast("string").alias("alignment"))

    return F.transform(F.zip_with(roles, lines, lambda r, x: F.struct(r.alias("role"), x.alias("line"))), block).cast(f"array<{BLOCK_TYPE}>")
