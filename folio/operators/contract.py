"""Strict JSON contracts: violations are found on the raw text, before anything is coerced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(raw: Column, kinds: dict[str, str]) -> Column:
    """Array of messages: missing and extra keys, and values whose JSON type isn't the one of kinds (regular expressions)."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    want = F.array(*map(F.lit, sorted(kinds)))
    v = F.try_parse_json(raw)
    missing = F.transform(F.array_except(want, keys), lambda k: F.concat(F.lit("missing "), k))
    extra = F.transform(F.array_sort(F.array_except(keys, want)), lambda k: F.concat(F.lit("extra "), k))
    wrong = [F.when(F.array_contains(keys, k) & ~F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")), F.lit("VOID")).rlike(f"^({t})"), F.lit(f"type {k}")) for k, t in sorted(kinds.items())]
    return F.when(v.isNull(), F.array(F.lit("not an object"))).otherwise(F.concat(missing, extra, F.array_compact(F.array(*wrong))))


def quarantined(rows: DataFrame, raw: str, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and the others with their violations."""
    judged = rows.withColumn("violations", violations(F.col(raw), kinds))
    return judged.where(F.size("violations") == 0).drop("violations"), judged.where(F.size("violations") > 0)
