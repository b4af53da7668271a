"""Summaries as a model returns them: answer text, fence, validation against the fixed keys, list fields as lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions import text
from sheafline.schemas import LINE_KEYS, SUMMARY_KEYS


def answer(response: Column) -> Column:
    """Content of a model's answer in its known shapes (message with content, plain text), from JSON."""
    at = lambda p: F.get_json_object(response, p)
    return F.coalesce(at("$.choices[0].message.content"), text.filled(at("$.choices[0].text")), at("$.choices[0].message"), text.filled(at("$.output_text")))


def validated(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``summary`` (struct, null if invalid) and ``error``. All keys must be there, may be null, and must have their type."""
    v = F.try_parse_json(text.unfenced(F.col(raw)))
    df = df.withColumn("_v", v).withColumn("_json", F.to_json("_v"))
    keys = F.json_object_keys("_json")
    missing = F.array_except(F.array(*[F.lit(k) for k in SUMMARY_KEYS]), F.coalesce(keys, F.array().cast("array<string>")))
    kind = lambda k: F.schema_of_variant(F.try_variant_get("_v", f"$.{k}", "variant"))
    field = lambda k: F.try_variant_get("_v", f"$.{k}", "string")
    bad, parts = [], []
    for k in SUMMARY_KEYS:
        t = F.coalesce(kind(k), F.lit("VOID"))
        if k == "authors":
            ok = t.isin("VOID", "ARRAY<STRING>", "ARRAY<VOID>")
            parts.append(F.try_variant_get("_v", "$.authors", "array<string>").alias(k))
        elif k in LINE_KEYS:
            ok = t.isin("VOID", "STRING") | t.startswith("ARRAY") | (F.lit(k == "key_findings"))
            lines = F.array_join(F.try_variant_get("_v", f"$.{k}", "array<string>"), "\n")
            parts.append(F.when(t.startswith("ARRAY"), lines).otherwise(field(k)).alias(k))
        else:
            ok = t.isin("VOID", "STRING")
            parts.append(field(k).alias(k))
        bad.append(F.when(~ok, F.lit(k)))
    tokens = [F.try_variant_get("_v", f"$.{k}", "int").alias(k) for k in ("input_token", "output_token")]
    wrong = F.array_compact(F.array(*bad))
    error = (
        F.when(F.col("_v").isNull() | keys.isNull(), "no JSON object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
        .when(F.size(wrong) > 0, F.concat(F.lit("wrong type: "), F.array_join(wrong, ", ")))
    )
    df = df.withColumn("error", error)
    return df.withColumn("summary", F.when(F.col("error").isNull(), F.struct(*parts, *tokens))).drop("_v", "_json")


def overridden(summary: Column, title: Column, doi: Column, published: Column) -> Column:
    """The summary with what the caller knows better."""
    out = summary
    for name, c in (("title", title), ("doi", doi), ("published_date", published)):
        out = out.withField(name, F.coalesce(text.filled(c), summary[name]))
    return F.when(summary.isNotNull(), out)
