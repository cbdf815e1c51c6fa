"""Catalogues of text generators: filtering by abilities and price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.functions.text import number_or_infinite

SCHEMA = "data array<struct<id string, pricing struct<prompt string, completion string>, supported_parameters array<string>, architecture struct<input_modalities array<string>, output_modalities array<string>>, expiration_date string>>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each entry of catalogue files, JSON objects with a list `data`."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path).select(F.inline("data"))


def is_chat_model(r: str = "") -> Column:
    """Text in and out, no audio out, a token limit can be set, no expiry, no embedding model, no alias."""
    has = lambda column, value: F.coalesce(F.array_contains(column, value), F.lit(False))
    return (
        ~F.col(f"{r}id").startswith("~")
        & ~F.lower(f"{r}id").contains("embed")
        & has(f"{r}supported_parameters", "max_tokens")
        & has(f"{r}architecture.output_modalities", "text")
        & ~has(f"{r}architecture.output_modalities", "audio")
        & has(f"{r}architecture.input_modalities", "text")
        & F.col(f"{r}expiration_date").isNull()
    )


def is_affordable(free_only: bool = False, most_prompt: float | None = None, most_completion: float | None = None) -> Column:
    """Within the caps, where given; or free by name or by both prices."""
    prompt, completion = number_or_infinite(F.col("pricing.prompt")), number_or_infinite(F.col("pricing.completion"))
    if free_only:
        return F.col("id").contains(":free") | ((prompt == 0) & (completion == 0))
    caps = F.lit(True)
    for price, most in ((prompt, most_prompt), (completion, most_completion)):
        caps = caps if most is None else caps & (price <= most)
    return caps


def cost(prompt_tokens: Column, completion_tokens: Column, prompt_price: Column, completion_price: Column) -> Column:
    return prompt_tokens * prompt_price + completion_tokens * completion_price


def listed(spark: SparkSession, names: str) -> DataFrame:
    """Names from a comma-separated setting, blanks dropped."""
    return spark.range(1).select(F.explode(F.split(F.lit(names), ",")).alias("id")).select(F.trim("id").alias("id")).where("id <> ''")
