"""Canonical JSON and the content hashes built on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


def to_json(col: Column) -> Column:
    """JSON text with nulls kept."""
    return F.to_json(col, KEEP_NULLS)


def canonical_json(json_text: Column) -> Column:
    """Keys sorted on every level, no blanks, nulls kept, non-ASCII as it is.

    Parsing into a variant sorts the keys. Invalid JSON gives NULL.
    """
    return F.to_json(F.try_parse_json(json_text), KEEP_NULLS)


def cache_key(kind: Column, model: Column, params_json: Column, prompt: Column, input_json: Column) -> Column:
    """sha256 over (kind, model, params, prompt, input); parser versions stay out on purpose."""
    parts = F.array(
        to_json_string(kind),
        to_json_string(model),
        canonical_json(params_json),
        to_json_string(prompt),
        canonical_json(input_json),
    )
    return F.sha2(F.concat(F.lit("["), F.array_join(parts, ",", "null"), F.lit("]")), 256)


def to_json_string(text: Column) -> Column:
    """A JSON string literal, or NULL."""
    wrapped = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(wrapped, F.lit(2), F.length(wrapped) - 2))


def stage_fingerprint(
    upstream: Column, config_json: Column, prompt_version: Column, prompt_hash: Column, parser_version: Column
) -> Column:
    """sha256 over (sorted upstream hashes, config, prompt version, prompt hash, parser version)."""
    parts = F.array(
        F.to_json(F.array_sort(upstream)),
        canonical_json(config_json),
        to_json_string(prompt_version),
        to_json_string(prompt_hash),
        to_json_string(parser_version),
    )
    return F.sha2(F.concat(F.lit("["), F.array_join(parts, ",", "null"), F.lit("]")), 256)


def row_digest(*cols: Column) -> Column:
    """A 32-bit number from the row's key text; NULL counts as empty text."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint")


def digest_xor(digest: Column) -> Column:
    return F.coalesce(F.bit_xor(digest), F.lit(0).cast("bigint"))


def digest_sum(digest: Column) -> Column:
    """XOR cancels pairs of equal rows, so a sum goes with it."""
    return F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
