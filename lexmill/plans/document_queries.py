"""Nested documents over customer / orders / lineitem as word / meaning / sentence."""

from pyspark.sql import functions as F

from lexmill.functions.hashing import to_json
from lexmill.operators import documents as D
from lexmill.operators.numbering import position_in_parent
from lexmill.plans.registry import query

NESTED_SENTENCES = """
s AS (SELECT meaning_id, list({item} ORDER BY line_no, part_no_key, supp_key, cents) AS sentences
      FROM dom_sentences GROUP BY meaning_id)"""

FIRST_MNEMONIC = """
f AS (SELECT word_id, arg_min({item}, mnemonic_id) AS mnemonic FROM dom_mnemonics GROUP BY word_id)"""

POS_EN = "coalesce(map {1: 'n.', 2: 'v.', 3: 'adj.', 4: 'adv.', 5: 'prep.'}[CAST(pos AS INTEGER)], '')"
POS_CN = "coalesce(map {1: '名词', 2: '动词', 3: '形容词', 4: '副词', 5: '介词'}[CAST(pos AS INTEGER)], '')"


SERVING_SQL = (
    "WITH "
    + NESTED_SENTENCES.replace("{item}", "{'sentence_id': sentence_id, 'en': form, 'cn': translation}")
    + ","
    + FIRST_MNEMONIC.replace("{item}", "{'content': {'kind': kind, 'text': text}, 'type': type}")
    + """,
    m AS (SELECT word_id, list({'meaning_id': meaning_id, 'pos': pos, 'pos_sub': pos_sub, 'cn': cn_paraphrase,
                 'en': en_paraphrase, 'synonyms': synonyms, 'sentences': coalesce(sentences, [])} ORDER BY meaning_id) AS meanings
          FROM dom_meanings LEFT JOIN s USING (meaning_id) GROUP BY word_id),
    p AS (SELECT owner_word_id AS word_id, list({'phrase_id': phrase_id, 'en': form, 'meaning': meaning} ORDER BY phrase_id) AS phrases
          FROM dom_phrases GROUP BY 1),
    k AS (SELECT word_id, list({'package_id': package_id, 'unit_id': unit_id, 'sort_order': sort_order,
                 'importance': importance} ORDER BY package_id, sort_order) AS packages
          FROM dom_packages GROUP BY 1)
    SELECT word_id, form, type,
           CAST(to_json({'form': form, 'type': type, 'status': status, 'quality_flag': quality_flag,
              'phonetic': {'us': phonetic_us, 'uk': phonetic_uk, 'audio_us': audio_us, 'audio_uk': audio_uk},
              'meanings': coalesce(meanings, []), 'mnemonic': mnemonic, 'phrases': coalesce(phrases, []),
              'packages': coalesce(packages, [])}) AS VARCHAR) AS payload,
           CAST(1 AS INTEGER) AS payload_schema_version
    FROM dom_words LEFT JOIN m USING (word_id) LEFT JOIN f USING (word_id) LEFT JOIN p USING (word_id)
         LEFT JOIN k USING (word_id)
    WHERE status = 1"""
)


@query("serving_payload", SERVING_SQL)
def serving_payload(t):
    return D.serving_payload(
        t.dom_words, t.dom_meanings, t.dom_sentences, t.dom_mnemonics, t.dom_phrases, t.dom_packages, t.sentence_order
    )


@query(
    "serving_removals",
    """SELECT o_custkey AS word_id, count(*) AS n_rows FROM orders
       WHERE o_custkey NOT IN (SELECT word_id FROM dom_words WHERE status = 1) GROUP BY 1""",
)
def serving_removals(t):
    served = t.read("orders").select(F.col("o_custkey").alias("word_id"))
    return D.serving_removals(served, t.dom_words).groupBy("word_id").agg(F.count("*").alias("n_rows"))


@query(
    "review_blob",
    "WITH "
    + NESTED_SENTENCES.replace("{item}", "{'en': form, 'cn': translation}")
    + ","
    + FIRST_MNEMONIC.replace("{item}", "{'kind': kind, 'text': text}")
    + f""",
    m AS (SELECT word_id, list({{'meaning_id': meaning_id, 'pos': pos, 'pos_name': {POS_EN}, 'cn_paraphrase': cn_paraphrase,
                 'en_paraphrase': left(coalesce(en_paraphrase, ''), 180), 'examples': coalesce(sentences, [])}}
                 ORDER BY meaning_id) AS meanings
          FROM dom_meanings LEFT JOIN s USING (meaning_id) GROUP BY word_id),
    b AS (SELECT word_id, form, CAST(to_json({{'word_id': word_id, 'type': type, 'form': form, 'phonetic_us': phonetic_us,
                 'phonetic_uk': phonetic_uk, 'audio_us': audio_us, 'audio_uk': audio_uk, 'source': source,
                 'status': status, 'quality_flag': quality_flag,
                 'meanings': coalesce(meanings, []), 'mnemonic': mnemonic}}) AS VARCHAR) AS blob
          FROM dom_words LEFT JOIN m USING (word_id) LEFT JOIN f USING (word_id))
    SELECT word_id, form, left(blob, 5500) AS blob, length(blob) > 5500 AS truncated FROM b""",
)
def review_blob(t):
    words = t.dom_words.drop("c_nationkey")
    return D.review_blob(words, t.dom_meanings, t.dom_sentences, t.dom_mnemonics, t.sentence_order)


PACKAGE_SQL = (
    "WITH "
    + NESTED_SENTENCES.replace(
        "{item}",
        "{'id': sentence_id, 'user_group': 0, 'form': form, 'meaning': translation, 'audio': '', 'is_collected': 0}",
    )
    + f""",
    g AS (SELECT word_id, list({{'id': mnemonic_id, 'type': type, 'user_group': 0, 'creator': MAP([]::VARCHAR[], []::VARCHAR[]),
                 'is_pinned': 0, 'content': text}} ORDER BY mnemonic_id) AS mnemonics FROM dom_mnemonics GROUP BY 1),
    h AS (SELECT word_id, {{'form': coalesce(phonetic_us, ''), 'audio': coalesce(audio_us, '')}} AS us,
                 {{'form': coalesce(phonetic_uk, ''), 'audio': coalesce(audio_uk, '')}} AS uk FROM dom_words),
    m AS (SELECT word_id, list({{'id': meaning_id, 'user_group': 0, 'pos_en': {POS_EN}, 'pos_cn': {POS_CN},
                 'phonetic_us': us, 'phonetic_uk': uk, 'pos_meanings': string_split(cn_paraphrase, '；'),
                 'sentences': coalesce(sentences, [])}} ORDER BY meaning_id) AS meanings
          FROM dom_meanings LEFT JOIN s USING (meaning_id) JOIN h USING (word_id) GROUP BY word_id),
    d AS (SELECT word_id, CAST(to_json({{'id': word_id, 'type': type, 'form': form, 'phonetic_us': us, 'phonetic_uk': uk,
                 'meanings': coalesce(meanings, []), 'mnemonics': coalesce(mnemonics, [])}}) AS VARCHAR) AS word_json
          FROM dom_words JOIN h USING (word_id) LEFT JOIN m USING (word_id) LEFT JOIN g USING (word_id))
    """
)


@query("package_entry", PACKAGE_SQL + "SELECT word_id, word_json FROM d")
def package_entry(t):
    return D.package_entry(t.dom_words, t.dom_meanings, t.dom_sentences, t.dom_mnemonics, t.sentence_order)


@query(
    "word_detail",
    """WITH w AS (SELECT word_id FROM dom_words WHERE status = 2),
    m AS (SELECT * FROM dom_meanings WHERE word_id IN (SELECT word_id FROM w))
    SELECT 'words' AS row_set, CAST(word_id AS VARCHAR) AS id, form AS label FROM dom_words WHERE word_id IN (SELECT word_id FROM w)
    UNION ALL SELECT 'meanings', CAST(meaning_id AS VARCHAR), cn_paraphrase FROM m
    UNION ALL SELECT 'mnemonics', CAST(mnemonic_id AS VARCHAR), text FROM dom_mnemonics WHERE word_id IN (SELECT word_id FROM w)
    UNION ALL SELECT 'sentences', sentence_id, form FROM dom_sentences WHERE meaning_id IN (SELECT meaning_id FROM m)
    UNION ALL SELECT 'phrases', CAST(phrase_id AS VARCHAR), form FROM dom_phrases
              WHERE owner_word_id IN (SELECT word_id FROM w)""",
)
def word_detail(t):
    wanted = t.dom_words.where("status = 2")
    sets = D.word_detail(wanted, t.dom_words, t.dom_meanings, t.dom_mnemonics, t.dom_sentences, t.dom_phrases)
    columns = {
        "words": ("word_id", "form"), "meanings": ("meaning_id", "cn_paraphrase"), "mnemonics": ("mnemonic_id", "text"),
        "sentences": ("sentence_id", "form"), "phrases": ("phrase_id", "form"),
    }
    out = None
    for name, (key, label) in columns.items():
        rows = sets[name].select(
            F.lit(name).alias("row_set"), F.col(key).cast("string").alias("id"), F.col(label).alias("label")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "collect_child_ids",
    """SELECT word_id, CAST(0 AS INTEGER) AS part_no,
              CAST(to_json(list({'id': meaning_id} ORDER BY meaning_id)) AS VARCHAR) AS ids
       FROM dom_meanings GROUP BY word_id""",
)
def collect_child_ids(t):
    return D.collect_child_ids(t.dom_meanings, "word_id", "meaning_id")


@query(
    "sentences_with_word",
    """SELECT sentence_id, m.word_id, s.meaning_id, s.form, s.translation
       FROM dom_sentences s JOIN dom_meanings m ON s.meaning_id = m.meaning_id""",
)
def sentences_with_word(t):
    joined = D.sentences_with_word(t.dom_sentences, t.dom_meanings)
    return joined.select("sentence_id", "word_id", "meaning_id", "form", "translation")


@query(
    "first_child",
    """SELECT word_id, CAST(to_json(arg_min({'id': mnemonic_id, 'text': text}, mnemonic_id)) AS VARCHAR) AS mnemonic
       FROM dom_mnemonics GROUP BY word_id""",
)
def first_child(t):
    value = F.struct(F.col("mnemonic_id").alias("id"), "text")
    first = D.first_child(t.dom_mnemonics, "word_id", "mnemonic_id", value, "mnemonic")
    return first.withColumn("mnemonic", to_json(F.col("mnemonic")))


@query(
    "position_in_parent",
    """SELECT sentence_id, meaning_id,
              row_number() OVER (PARTITION BY meaning_id ORDER BY line_no, part_no_key, supp_key, cents) - 1 AS position
       FROM dom_sentences""",
)
def position(t):
    rows = position_in_parent(t.dom_sentences, ["meaning_id"], t.sentence_order)
    return rows.select("sentence_id", "meaning_id", "position")
