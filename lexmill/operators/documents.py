"""Nested documents assembled bottom-up: serving payload, review blob, package entry.

Sentences are joined under meanings, then everything that belongs to a word is joined in a
single shuffle on word_id. Children are JSON text before they are collected, and are put
together in two levels (see nesting.py), so a word is one document whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lookups
from lexmill.functions import text as T
from lexmill.functions.hashing import to_json
from lexmill.operators.nesting import FRAGMENTS, PART_SIZE, joined_children, nest_children
from lexmill.operators.numbering import HOT_FLOOR, join_to_parent
from lexmill.session import by_rows

PAYLOAD_SCHEMA_VERSION = 1
# Marks inside the text of a package's meanings.
START, SOUNDS = "\x02", "\x01"


def first_child(children: DataFrame, parent: str, child_id: str, value: Column, name: str) -> DataFrame:
    """(parent, name): the child with the lowest id; partially aggregated, no sort."""
    return children.groupBy(parent).agg(F.min_by(value, child_id).alias(name))


def sentences_with_word(sentences: DataFrame, meanings: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Each sentence with the word that it belongs to through its meaning."""
    parents = meanings.select("meaning_id", "word_id")
    return join_to_parent(sentences, parents, ["meaning_id"], "inner", floor)


def _object(head: Column, **lists: Column) -> Column:
    """JSON of a struct, to which lists are added whose members are JSON already; NULL is the empty list."""
    text = to_json(head)
    opened = F.left(text, F.length(text) - 1)
    return F.concat(opened, *[F.concat(F.lit(f',"{name}":['), F.coalesce(members, F.lit("")), F.lit("]")) for name, members in lists.items()], F.lit("}"))


def _members(head: Column) -> Column:
    """The members of a struct as JSON, without the braces."""
    text = to_json(head)
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _meanings_with_sentences(
    meanings: DataFrame, sentences: DataFrame, sentence_order: Sequence[Column | str], sentence: Column, fragments_at_once: int, floor: int,
    weigh: DataFrame | None = None,
) -> DataFrame:
    """Meanings with `_sentences`: their sentences as JSON, in order and joined by commas."""
    nested = joined_children(sentences, ["meaning_id"], sentence_order, {"_sentences": to_json(sentence)}, fragments_at_once, floor, weigh)
    return meanings.join(by_rows(nested), "meaning_id", "left")


def _attach_children(
    words: DataFrame, kinds: dict[str, tuple[DataFrame, list[Column], Column]], fragments_at_once: int, floor: int,
    weights: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Words with one text per kind of child: the children's JSON in order, joined by commas.

    All kinds travel in one union and one shuffle. Each kind gives its rows (with word_id),
    up to three numeric order columns, and the JSON of a row. Hot words are found by a count of
    all kinds' rows, or of `weights` (with word_id) where they are cheaper to count, and get their
    texts by broadcast.
    """
    union, weigh = None, None
    for rows in weights or [rows for rows, _, _ in kinds.values()]:
        weigh = rows.select("word_id") if weigh is None else weigh.unionByName(rows.select("word_id"))
    for rank, (kind, (rows, order, fragment)) in enumerate(kinds.items()):
        keys = [o.cast("double") if i else o.cast("bigint") for i, o in enumerate(order)]
        keys += [F.lit(0.0)] * (3 - len(keys))
        branch = rows.select("word_id", F.lit(rank).alias("_kind"), *[k.alias(f"_o{i}") for i, k in enumerate(keys)], fragment.alias(f"_f_{kind}"))
        union = branch if union is None else union.unionByName(branch, allowMissingColumns=True)
    fragments = {f"_f_{kind}": F.col(f"_f_{kind}") for kind in kinds}
    nested = joined_children(union, ["word_id"], ["_kind", "_o0", "_o1", "_o2"], fragments, fragments_at_once, floor, weigh)
    return words.join(by_rows(nested), "word_id", "left")


def serving_payload(
    words: DataFrame,
    meanings: DataFrame,
    sentences: DataFrame,
    mnemonics: DataFrame,
    phrases: DataFrame,
    packages: DataFrame,
    sentence_order: Sequence[Column | str] = ("sentence_id",),
    fragments_at_once: int = FRAGMENTS,
    floor: int = HOT_FLOOR,
    whole: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(word_id, form, type, payload, payload_schema_version): one row per published word, whatever its size.

    Words of another status, or no longer there, simply have no row. Where the tables given are parts of
    larger ones, `whole` names those, by which parents with many rows are told without another join.
    """
    sentence = F.struct("sentence_id", F.col("form").alias("en"), F.col("translation").alias("cn"))
    deep = _meanings_with_sentences(meanings, sentences, sentence_order, sentence, fragments_at_once, floor, whole and whole["sentences"])
    lists = [c for c in ("equivalents", "synonyms", "antonyms") if c in meanings.columns]
    meaning = F.struct(
        "meaning_id", "pos", "pos_sub", F.col("cn_paraphrase").alias("cn"), F.col("en_paraphrase").alias("en"), *lists
    )
    content = F.struct(F.struct("kind", "text").alias("content"), "type")
    first = first_child(mnemonics, "word_id", "mnemonic_id", content, "mnemonic")
    phrase = F.struct("phrase_id", F.col("form").alias("en"), "meaning")
    package = F.struct("package_id", "unit_id", "sort_order", "importance")
    kinds = {
        "meanings": (deep, [F.col("meaning_id")], _object(meaning, sentences=F.col("_sentences"))),
        "mnemonic": (first, [F.lit(0)], to_json(F.col("mnemonic"))),
        "phrases": (phrases.withColumnRenamed("owner_word_id", "word_id"), [F.col("phrase_id")], to_json(phrase)),
        "packages": (packages, [F.col("package_id"), F.col("sort_order"), F.col("unit_id")], to_json(package)),
    }
    weights = whole and [
        whole["meanings"], whole["mnemonics"], whole["phrases"].withColumnRenamed("owner_word_id", "word_id"), whole["packages"]
    ]
    entries = _attach_children(words.where(F.col("status") == 1), kinds, fragments_at_once, floor, weights)
    head = F.struct(
        "form", "type", "status", F.coalesce("quality_flag", F.lit("none")).alias("quality_flag"),
        F.struct(
            F.col("phonetic_us").alias("us"), F.col("phonetic_uk").alias("uk"), "audio_us", "audio_uk"
        ).alias("phonetic"),
    )
    text = _object(head, meanings=F.col("_f_meanings"))
    told = F.concat(F.lit(',"mnemonic":'), F.coalesce("_f_mnemonic", F.lit("null")))
    rest = F.concat(
        F.lit(',"phrases":['), F.coalesce("_f_phrases", F.lit("")), F.lit('],"packages":['), F.coalesce("_f_packages", F.lit("")), F.lit("]}")
    )
    return entries.select(
        "word_id", "form", "type", F.concat(F.left(text, F.length(text) - 1), told, rest).alias("payload"),
        F.lit(PAYLOAD_SCHEMA_VERSION).alias("payload_schema_version"),
    )


def serving_removals(serving: DataFrame, words: DataFrame) -> DataFrame:
    """Rows to take out of serving: their word is unpublished or gone."""
    return serving.join(words.where(F.col("status") == 1).select("word_id"), "word_id", "left_anti")


def review_blob(
    words: DataFrame,
    meanings: DataFrame,
    sentences: DataFrame,
    mnemonics: DataFrame,
    sentence_order: Sequence[Column | str] = ("sentence_id",),
    fragments_at_once: int = FRAGMENTS,
    floor: int = HOT_FLOOR,
    whole: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(word_id, form, blob, truncated): what a reviewer model sees of a word; its positions are those of the whole word.

    `whole` names the tables of which those given are parts, as in `serving_payload`.
    """
    example = F.struct(F.col("form").alias("en"), F.col("translation").alias("cn"))
    deep = _meanings_with_sentences(meanings, sentences, sentence_order, example, fragments_at_once, floor, whole and whole["sentences"])
    label = lookups.pos_display(F.col("pos"))["pos_en"]
    name = F.when(label != "", label).otherwise(F.coalesce(F.col("pos").cast("string"), F.lit("None")))
    english = T.truncate_text(F.coalesce("en_paraphrase", F.lit("")), "en_paraphrase")
    meaning = F.struct("meaning_id", "pos", name.alias("pos_name"), "cn_paraphrase", english.alias("en_paraphrase"))
    first = first_child(mnemonics, "word_id", "mnemonic_id", F.struct("kind", "text"), "mnemonic")
    kinds = {
        "meanings": (deep, [F.col("meaning_id")], _object(meaning, examples=F.col("_sentences"))),
        "mnemonic": (first, [F.lit(0)], to_json(F.col("mnemonic"))),
    }
    entries = _attach_children(words, kinds, fragments_at_once, floor, whole and [whole["meanings"], whole["mnemonics"]])
    skip = {"created_at", "updated_at", "derivatives"}
    whole = _object(F.struct(*[c for c in words.columns if c not in skip]), meanings=F.col("_f_meanings"))
    blob = F.concat(F.left(whole, F.length(whole) - 1), F.lit(',"mnemonic":'), F.coalesce("_f_mnemonic", F.lit("null")), F.lit("}"))
    return entries.withColumn("_blob", blob).select(
        "word_id", "form", T.truncate_text(F.col("_blob"), "blob").alias("blob"), T.is_truncated(F.col("_blob"), "blob").alias("truncated"),
    )


def package_entry(
    words: DataFrame,
    meanings: DataFrame,
    sentences: DataFrame,
    mnemonics: DataFrame,
    sentence_order: Sequence[Column | str] = ("sentence_id",),
    fragments_at_once: int = FRAGMENTS,
    floor: int = HOT_FLOOR,
    ranged: bool = False,
) -> DataFrame:
    """(word_id, word_json): the document that the app package ships.

    Words travel in one union with their children, and their sounds are put into the meanings where
    all of a word meets, so sentences are shuffled once by themselves and once inside their meaning. With `ranged`
    that last shuffle is by ranges of word_id, and a sort by word_id shuffles no document.
    """
    zero = F.lit(0)
    sentence = F.struct(
        F.col("sentence_id").alias("id"), zero.alias("user_group"), "form", F.col("translation").alias("meaning"),
        F.lit("").alias("audio"), zero.alias("is_collected"),
    )

    def sound(region: str) -> Column:
        return F.struct(
            F.coalesce(f"phonetic_{region}", F.lit("")).alias("form"),
            F.coalesce(f"audio_{region}", F.lit("")).alias("audio"),
        )

    sounds = (sound("us").alias("phonetic_us"), sound("uk").alias("phonetic_uk"))
    deep = _meanings_with_sentences(meanings, sentences, sentence_order, sentence, fragments_at_once, floor)
    labels = lookups.pos_display(F.col("pos"))
    before = F.struct(F.col("meaning_id").alias("id"), zero.alias("user_group"), labels["pos_en"].alias("pos_en"), labels["pos_cn"].alias("pos_cn"))
    after = F.struct(T.split_gloss(F.col("cn_paraphrase")).alias("pos_meanings"))
    # JSON holds no raw control characters, so they can mark a meaning's start and the place of the sounds.
    meaning = F.concat(
        F.lit(f"{START}{{"), _members(before), F.lit(f",{SOUNDS},"), _members(after), F.lit(',"sentences":['), F.coalesce("_sentences", F.lit("")), F.lit("]}")
    )
    mnemonic = F.struct(
        F.col("mnemonic_id").alias("id"), "type", zero.alias("user_group"), F.create_map().cast("map<string,string>").alias("creator"),
        zero.alias("is_pinned"), F.coalesce("text", F.lit("")).alias("content"),
    )
    place = [F.lit(None).cast("bigint").alias("_at")]
    head = F.struct(F.col("word_id").alias("id"), "type", "form", *sounds)
    word = F.struct(_members(head).alias("head"), _members(F.struct(*sounds)).alias("sounds"))
    union = words.select("word_id", F.lit(0).alias("_kind"), *place, word.alias("_words"))
    # A child without a word belongs to no word, not to those without an id.
    union = union.unionByName(
        deep.where("word_id IS NOT NULL").select("word_id", F.lit(1).alias("_kind"), F.col("meaning_id").cast("bigint").alias("_at"), meaning.alias("_f_meanings")),
        allowMissingColumns=True,
    ).unionByName(
        mnemonics.where("word_id IS NOT NULL").select("word_id", F.lit(2).alias("_kind"), F.col("mnemonic_id").cast("bigint").alias("_at"), to_json(mnemonic).alias("_f_mnemonics")),
        allowMissingColumns=True,
    )
    weigh = deep.select("word_id").unionByName(mnemonics.select("word_id"))
    fragments = {name: F.col(name) for name in ("_f_meanings", "_f_mnemonics")}
    nested = joined_children(union, ["word_id"], ["_kind", "_at"], fragments, fragments_at_once, floor, weigh, "_words", ranged)
    once = F.replace(F.replace("_f_meanings", F.lit(START), F.lit("")), F.lit(SOUNDS), F.col("_words")[0]["sounds"])
    # Of words with one id each lists every meaning with the sounds of each of them.
    single = F.split(F.substr("_f_meanings", F.lit(2)), f",{START}")
    each = F.transform(single, lambda m: F.transform("_words", lambda w: F.replace(m, F.lit(SOUNDS), w["sounds"])))
    told = F.when(F.size("_words") > 1, F.array_join(F.flatten(each), ",")).otherwise(once)
    listed = nested.select("word_id", told.alias("_told"), "_f_mnemonics", F.explode_outer("_words").alias("_word")).where("_word IS NOT NULL")
    text = F.concat(
        F.lit("{"), F.col("_word.head"), F.lit(',"meanings":['), F.coalesce("_told", F.lit("")),
        F.lit('],"mnemonics":['), F.coalesce("_f_mnemonics", F.lit("")), F.lit("]}"),
    )
    return listed.select("word_id", text.alias("word_json"))


def word_detail(
    wanted: DataFrame, words: DataFrame, meanings: DataFrame, mnemonics: DataFrame, sentences: DataFrame, phrases: DataFrame
) -> dict[str, DataFrame]:
    """The five row sets of the wanted words (a DataFrame with word_id)."""
    ids = wanted.select("word_id").distinct()
    mine = meanings.join(ids, "word_id", "left_semi")
    return {
        "words": words.join(ids, "word_id", "left_semi"),
        "meanings": mine,
        "mnemonics": mnemonics.join(ids, "word_id", "left_semi"),
        "sentences": sentences.join(mine.select("meaning_id"), "meaning_id", "left_semi"),
        "phrases": phrases.join(ids.withColumnRenamed("word_id", "owner_word_id"), "owner_word_id", "left_semi"),
    }


def collect_child_ids(
    children: DataFrame, parent: str, child_id: str, key: str = "id",
    order: Sequence[Column | str] | None = None, part_size: int = PART_SIZE, floor: int = HOT_FLOOR,
) -> DataFrame:
    """(parent, part_no, ids): child ids in order as JSON `[{"id":1},...]`."""
    item = F.struct(F.col(child_id).alias(key))
    nested = nest_children(children, [parent], order or [child_id], item, "_ids", part_size, floor)
    return nested.select(parent, F.col("part_no").cast("int").alias("part_no"), F.to_json("_ids").alias("ids"))
