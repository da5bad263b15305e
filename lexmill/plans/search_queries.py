"""Search, paging and the audit trail."""

from pyspark.sql import functions as F

from lexmill.operators import search as S
from lexmill.plans.registry import query
from lexmill.session import fresh_path

COUNTED = "(SELECT count(*) FROM dom_meanings m WHERE m.word_id = w.word_id) AS meaning_count"


@query(
    "search_words",
    f"""SELECT word_id, form, type, status, quality_flag, updated_at, {COUNTED} FROM dom_words w
        WHERE form ILIKE '%CUSTOMER#00_0%' AND status = 1 AND quality_flag = 'none' AND type = 1
          AND EXISTS (SELECT 1 FROM dom_meanings m WHERE m.word_id = w.word_id AND m.pos = 2)""",
)
def search_words(t):
    rows = S.add_meaning_count(S.search_words(t.dom_words, t.dom_meanings, "CUSTOMER#00_0", 1, "none", 1, 2), t.dom_meanings)
    return rows.select("word_id", "form", "type", "status", "quality_flag", "updated_at", "meaning_count")


@query(
    "search_substring",
    "SELECT sentence_id, form FROM dom_sentences WHERE form ILIKE '%af 16%' OR form ILIKE '%O 1_4%' OR form ILIKE '%9_9%'",
)
def search_substring(t):
    """Patterns looked up in a trigram index of all sentences; the last has no three characters in a row."""
    rows = t.dom_sentences.select("sentence_id", "form")
    index = S.TrigramIndex(t.spark, fresh_path(t.spark, "trigrams"), 32)
    index.write(rows, "sentence_id")
    found = [S.search_substring(rows, index, q, "sentence_id") for q in ("af 16", "O 1_4", "9_9")]
    return found[0].unionByName(found[1]).unionByName(found[2]).distinct()


@query(
    "top_n",
    f"""SELECT word_id, form, {COUNTED} FROM dom_words w ORDER BY 3 DESC, word_id LIMIT 50""",
)
def top_n(t):
    rows = S.add_meaning_count(S.search_words(t.dom_words, t.dom_meanings), t.dom_meanings).select("word_id", "form", "meaning_count")
    return S.top_n(rows, [F.col("meaning_count").desc(), F.col("word_id")], 50, 200)


@query(
    "keyset_page",
    f"""SELECT word_id, updated_at, {COUNTED} FROM dom_words w
        WHERE updated_at < TIMESTAMP '2024-01-15' OR (updated_at = TIMESTAMP '2024-01-15' AND word_id < 700)
        ORDER BY updated_at DESC, word_id DESC LIMIT 101""",
)
def keyset_page(t):
    page = S.keyset_page(S.search_words(t.dom_words, t.dom_meanings), "updated_at", "word_id", 100, ("2024-01-15", 700))
    return S.add_meaning_count(page, t.dom_meanings).select("word_id", "updated_at", "meaning_count")


@query(
    "search_audit",
    """SELECT a.id, a.word_id, a.field_path, a.target_id, a.op, a.created_at, a.editor_id, e.display_name AS editor_display_name
       FROM audit a JOIN editors e ON e.id = a.editor_id
       WHERE a.created_at >= TIMESTAMP '2024-01-05' AND a.created_at <= TIMESTAMP '2024-01-20' AND a.word_id = 42""",
)
def search_audit(t):
    rows = S.search_audit(
        t.audit, t.editors, word_id=42, since=F.lit("2024-01-05").cast("timestamp_ntz"), until=F.lit("2024-01-20").cast("timestamp_ntz")
    )
    return rows.drop("new_value")


@query(
    "audit_with_editor",
    """SELECT a.id, a.word_id, a.field_path, a.created_at, a.editor_id, e.display_name AS editor_display_name
       FROM audit a JOIN editors e ON e.id = a.editor_id""",
)
def audit_with_editor(t):
    rows = S.audit_with_editor(t.audit, t.editors)
    return rows.select("id", "word_id", "field_path", "created_at", "editor_id", "editor_display_name")


@query(
    "audit_page",
    """SELECT id, editor_id, created_at FROM audit WHERE created_at < TIMESTAMP '2024-01-10' OR (created_at = TIMESTAMP '2024-01-10' AND id < 50)
       ORDER BY created_at DESC, id DESC LIMIT 101""",
)
def audit_page(t):
    return S.keyset_page(t.audit.select("id", "editor_id", "created_at"), "created_at", "id", 100, ("2024-01-10", 50), 500)
