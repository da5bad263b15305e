"""Scalar functions over text, all returning Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space and line breaks as the host language's strip() and splitlines() see them.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """`fn` of a value that is computed once, however often `fn` names it; inside lambdas Spark computes every mention."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def strip(col: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(col, F.lit(SPACES))


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def _fold_table() -> dict[str, str]:
    """Characters whose case folding is not their lower case."""
    chars = (chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF)
    return {c: c.casefold() for c in chars if c.casefold() != c.lower()}


def _char_class(chars: list[str]) -> str:
    """A regex class of the characters, neighbours joined into ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


INNER_SPACE = _char_class(list(SPACES))
_FOLDS = _fold_table()
# Capital sigma and dotted capital I lower-case differently inside a word than alone.
_NEEDS_FOLD = _char_class([*_FOLDS, "Σ", "İ"])


def casefold(col: Column) -> Column:
    """Full case folding: native lower() unless the text holds one of the special characters.

    ASCII text, told by its byte length, does not even look for them, and only special characters
    are looked up, since a map is read from end to end.
    """
    table = F.create_map(*[F.lit(x) for pair in _FOLDS.items() for x in pair])
    special = lambda c: (F.octet_length(c) > 1) & c.rlike(_NEEDS_FOLD)
    spelled = F.array_join(
        F.transform(F.split(col, ""), lambda c: F.when(special(c), F.coalesce(F.try_element_at(table, c), F.lower(c))).otherwise(F.lower(c))), ""
    )
    ascii_only = F.octet_length(col) == F.char_length(col)
    return F.when(~ascii_only & col.rlike(_NEEDS_FOLD), spelled).otherwise(F.lower(col))


def is_blank(col: Column) -> Column:
    return col.rlike(f"^{INNER_SPACE}*$")


def with_normalized(df: DataFrame, raw: str, name: str = "normalized_form", type_name: str = "type") -> DataFrame:
    """Add the trimmed, case-folded form (NULL when blank) and its type.

    Three projections, so that each step is computed once. To leave blank rows out, filter
    with `is_blank(raw)` before: a filter on the result would be pushed down and fold twice.
    """
    return (
        df.withColumn("_stripped", blank_to_null(strip(F.col(raw))))
        .withColumn(name, casefold(F.col("_stripped")))
        .drop("_stripped")
        .withColumn(type_name, form_type(F.col(name)))
    )


def form_type(normalized: Column) -> Column:
    """1 for a word, 2 for a phrase (white space inside)."""
    return F.when(normalized.rlike(INNER_SPACE), 2).when(normalized.isNotNull(), 1).cast("smallint")


def split_lines(text: Column) -> Column:
    """Lines of a text; the empty piece after a final break does not count."""
    parts = F.split(text, LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def source_tag(provider: Column, model: Column, stage: Column, parser_version: Column) -> Column:
    return F.concat(F.lit("pipeline:"), provider, F.lit(":"), model, F.lit(":"), stage, F.lit("_v"), parser_version)


def short_model_tag(model: Column) -> Column:
    """The part after the last dot, without its last hyphenated piece."""
    tail = F.substring_index(model, ".", -1)
    return F.regexp_replace(tail, r"-[^-]*$", "")


def source_origin(source: Column) -> Column:
    return F.split_part(source, F.lit(":"), F.lit(1))


def strip_markup(col: Column) -> Column:
    """Drop bold tags and outer white space; nothing left is NULL."""
    def bare(text: Column) -> Column:
        # Few texts hold a tag; the others are not searched for one.
        return strip(F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, r"(?i)</?b>", "")).otherwise(text))

    return let(let(col, bare), blank_to_null)


def split_gloss(col: Column) -> Column:
    """Pieces between full or half width semicolons, trimmed, blanks dropped."""
    pieces = F.transform(F.split(F.coalesce(col, F.lit("")), "[；;]"), strip)
    return F.filter(pieces, lambda p: p != "")


# Gloss-line prefixes, and the words that mark an inflected form.
GLOSS_POS = ("n", "v", "vt", "vi", "adj", "adv", "prep", "conj", "pron", "interj", "abbr", "aux", "art")
FORM_KINDS = ("现在分词", "过去式", "过去分词", "比较级", "最高级", "名词", "动词", "形容词", "副词")

_GLOSS_PREFIX = r"^(" + "|".join(GLOSS_POS) + r")\.(?U)\s*"
_FORM_NOTE = r"（([^）]{1,40})的(" + "|".join(FORM_KINDS) + r")[^）]*）"


def parse_gloss_line(line: Column) -> Column:
    """`v. text；text` as an array of (pos, cn); a line without a known prefix gives no items.

    A note such as （see的过去式） turns into the tag `[see 过去式] ` before each part.
    """
    text = strip(line)
    pos = F.regexp_extract(text, _GLOSS_PREFIX, 1)
    pos = F.when(pos.isin("vt", "vi"), F.lit("v")).otherwise(pos)
    body = strip(F.regexp_replace(text, _GLOSS_PREFIX, ""))
    # The base form ends at the first 的 of the note, the kind is the one the pattern settles on.
    base = strip(F.regexp_replace(F.split_part(F.regexp_extract(body, _FORM_NOTE, 0), F.lit("的"), F.lit(1)), "^（+", ""))
    kind = F.regexp_extract(body, _FORM_NOTE, 2)
    tag = F.when(kind != "", F.concat(F.lit("["), base, F.lit(" "), kind, F.lit("] "))).otherwise(F.lit(""))
    rest = strip(F.regexp_replace(body, _FORM_NOTE, ""))
    parts = F.filter(F.transform(F.split(rest, "；"), strip), lambda p: p != "")
    items = F.transform(parts, lambda p: F.struct(pos.alias("pos"), F.concat(tag, p).alias("cn")))
    return F.when(text.rlike(_GLOSS_PREFIX), items).otherwise(F.slice(items, 1, 0))


def compose_url(base: str, suffix: Column) -> Column:
    return F.when(suffix != "", F.concat(F.lit(base), suffix))


# How many characters each text may bring into a prompt or a ledger.
CUTS = {
    "meanings_json": 2500,
    "reference_examples_json": 3000,
    "dict_summary": 3500,
    "rerank_json": 3500,
    "en_paraphrase": 180,
    "blob": 5500,
    "issues": 3000,
    "fix_error": 400,
    "error": 500,
    "parse_error": 200,
    "error_line": 80,
}


def truncate_text(col: Column, kind: str) -> Column:
    return F.left(col, F.lit(CUTS[kind]))


def is_truncated(col: Column, kind: str) -> Column:
    return F.length(col) > CUTS[kind]


def render_prompt(template: Column, values: dict[str, Column]) -> Column:
    """Literal replacement of {name} by its value, one after the other in the given order."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def error_summary(error: Column) -> Column:
    """First line, cut for a listing."""
    return truncate_text(F.split_part(error, F.lit("\n"), F.lit(1)), "error_line")


