"""Fixed dimension values: parts of speech and model prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Part-of-speech names as stages write them, and the codes as tables store them.
POS_CODES = {
    "n": 1,
    "v": 2,
    "adj": 3,
    "adv": 4,
    "prep": 5,
    "conj": 6,
    "pron": 7,
    "interj": 8,
    "num": 9,
    "art": 10,
    "phrasal_verb": 201,
}

# Display text per code, English then Chinese.
POS_LABELS = {
    1: ("n.", "名词"),
    2: ("v.", "动词"),
    3: ("adj.", "形容词"),
    4: ("adv.", "副词"),
    5: ("prep.", "介词"),
    6: ("conj.", "连词"),
    7: ("pron.", "代词"),
    8: ("interj.", "感叹词"),
    9: ("num.", "数词"),
    10: ("art.", "冠词"),
    201: ("phrase", "短语动词"),
}

# US dollars per million tokens, in and out, by a part of the model name.
MODEL_PRICES = [
    ("claude-opus-4-7", 15.0, 75.0),
    ("claude-opus-4-6", 15.0, 75.0),
    ("claude-opus-4-5", 15.0, 75.0),
    ("claude-opus-4-1", 15.0, 75.0),
    ("claude-sonnet-4-6", 3.0, 15.0),
    ("claude-sonnet-4-5", 3.0, 15.0),
    ("claude-sonnet-4-2025", 3.0, 15.0),
    ("claude-haiku-4-5", 1.0, 5.0),
    ("gemini-3.1-pro-preview", 2.0, 12.0),
    ("gemini-3-pro-preview", 2.0, 12.0),
    ("gemini-3-flash-preview", 0.50, 3.0),
    ("gemini-3.1-flash-lite-preview", 0.25, 1.50),
    ("gemini-2.5-pro", 1.25, 5.0),
    ("gemini-2.5-flash", 0.075, 0.30),
    ("gemini-2.5-flash-lite", 0.05, 0.20),
    ("qwen-max", 2.0, 6.0),
    ("qwen3-max", 2.0, 6.0),
    ("qwen3.5-flash", 0.3, 1.2),
    ("gpt-5-pro", 15.0, 120.0),
    ("gpt-5.1-codex", 5.0, 15.0),
    ("gpt-5.1", 5.0, 15.0),
    ("gpt-5-mini", 0.5, 2.0),
    ("gpt-5-nano", 0.10, 0.40),
    ("gpt-5", 5.0, 15.0),
    ("gpt-4o-mini", 0.15, 0.60),
    ("gpt-4o", 2.5, 10.0),
    ("gpt-4.1", 3.0, 12.0),
    ("o3-mini", 1.10, 4.40),
    ("deepseek.v3.2", 0.5, 2.0),
    ("deepseek.r1", 1.0, 4.0),
    ("deepseek-v4-flash", 0.14, 0.28),
    ("deepseek-v4-pro", 0.435, 0.87),
    ("deepseek-chat", 0.14, 0.28),
    ("deepseek-reasoner", 0.14, 0.28),
]
DEFAULT_PRICE = (3.0, 15.0)


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def pos_code(name: Column) -> Column:
    return F.try_element_at(_map(POS_CODES), name).cast("smallint")


def pos_display(code: Column) -> Column:
    """struct(pos_en, pos_cn); empty strings when NULL or unknown."""
    def text(i: int) -> Column:
        labels = _map({k: v[i] for k, v in POS_LABELS.items()})
        return F.coalesce(F.try_element_at(labels, code.cast("int")), F.lit(""))

    return F.struct(text(0).alias("pos_en"), text(1).alias("pos_cn"))


def price_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_PRICES, "model_part string, price_in double, price_out double")


def with_cost(calls: DataFrame, model: str = "model", tokens_in: str = "tokens_input",
              tokens_out: str = "tokens_output", name: str = "cost_usd") -> DataFrame:
    """Add the dollars billed per call; `price_known` is false where the default price was used.

    The longest table entry contained in the model name applies. Names repeat, so prices are
    looked up once per distinct name as literals inside one expression, with no join.
    """
    def entry(price_in: float, price_out: float) -> Column:
        money = "decimal(9,4)"
        return F.struct(F.lit(str(price_in)).cast(money).alias("price_in"), F.lit(str(price_out)).cast(money).alias("price_out"))

    fallback = entry(*DEFAULT_PRICE)
    best = F.when(F.lit(False), fallback)
    for part, price_in, price_out in sorted(MODEL_PRICES, key=lambda p: len(p[0])):
        best = F.when(F.col(model).contains(part), entry(price_in, price_out)).otherwise(best)
    priced = calls.withColumn("_price", best)
    price = F.coalesce(F.col("_price"), fallback)

    def part_cost(tokens: str, rate: Column) -> Column:
        return F.coalesce(F.col(tokens), F.lit(0)).cast("decimal(18,0)") * rate

    # Exact decimals, rounded once at the end.
    per_million = part_cost(tokens_in, price["price_in"]) + part_cost(tokens_out, price["price_out"])
    cost = per_million * F.lit("0.000001").cast("decimal(7,6)")
    return (
        priced.withColumn(name, cost.cast("decimal(10,6)"))
        .withColumn("price_known", F.col("_price").isNotNull())
        .drop("_price")
    )
