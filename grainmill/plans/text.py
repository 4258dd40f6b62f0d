"""Queries over the text functions: T01 to T34, tags and templates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from ..functions import text as t, tokens
from .registry import query, table

WS = r"[ \t\n\r\f\x0B]"
END = t.TERMINAL.replace("'", "''")
WORD = t.WORD.replace("'", "''")
#: Own rules of the document opener classifier and of the chat sentence classifier: name, pattern.
_B = r"([^\p{L}\p{N}_]|\z)"
OPENERS = [("the-x-of", r"(?i)^the\s+[\p{L}\p{N}_]+\s+of" + _B), ("as-a", r"(?i)^as\s+(the|we|our)" + _B), ("prefixed", r"(?i)^(un|der|die|das|la|le|el)" + _B), ("number", r"^[0-9]")]
STOP_CARD = ("the", "a", "of", "and", "to", "in", "is")
KEYWORDS = [("en", ["the ", "and "]), ("de", ["der", "und"]), ("fr", ["les "])]


def _over(name: str, column: Callable[[], Column], sql: str, source: str = "documents", key: str = "doc_id") -> None:
    """One row for each text, its value in `value`."""

    def run(spark, sf_dir):
        rows = table(spark, sf_dir, source)
        return rows.select(key, column().alias("value"))

    query(f"SELECT {key}, {sql} AS value FROM {source}", name)(run)


STRIP = lambda x: f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+\\z', '')"
RSTRIP = lambda x: f"regexp_replace({x}, '{WS}+\\z', '')"
COLLAPSE = lambda x: f"regexp_replace({x}, '{WS}+', ' ', 'g')"
TRAIL = RSTRIP(f"regexp_replace({RSTRIP('text')}, '(?:(?:^|\\n)[ \\t\\r\\f\\x0B=*_~#\\-]+)+\\z', '')")
CLEAN = lambda x: f"list_filter(string_split_regex(regexp_replace(lower({x}), '[^a-z'' ]', ' ', 'g'), ' +'), lambda w: w <> '')"
FIRST_LINE = STRIP(f"regexp_extract(text, '([^\\n\\r]*[^ \\t\\n\\r\\f\\x0B][^\\n\\r]*)', 1)")
FIRST = f"CASE WHEN regexp_extract({FIRST_LINE}, '^([^.!?]*[.!?])', 1) <> '' THEN regexp_extract({FIRST_LINE}, '^([^.!?]*[.!?])', 1) ELSE substring({FIRST_LINE}, 1, 160) END"
CHAT = f"replace(regexp_replace({STRIP('text')}, '^#+{WS}*', ''), '*', '')"
CHAT_FIRST = STRIP(f"CASE WHEN regexp_extract({CHAT}, '(?s)^(.*?[.!?](?:{WS}|\\z))', 1) <> '' THEN regexp_extract({CHAT}, '(?s)^(.*?[.!?](?:{WS}|\\z))', 1) ELSE substring({CHAT}, 1, 200) END")
LAST = f"list_extract(string_split(regexp_replace({STRIP('text')}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), -1)"
COUNT = lambda p: f"len(regexp_extract_all(text, '{p}'))"
PER_MILLE = lambda p: f"({COUNT(p)} * 1000.0 / greatest({COUNT('[\\p{L}\\p{N}_]+')}, 1))"
SQL = lambda p: p.replace("'", "''")

_over("t01_trim_unfinished", lambda: t.trim_unfinished("text"), f"""CASE WHEN {RSTRIP('text')} = '' OR contains('{END}', right({RSTRIP('text')}, 1)) THEN {RSTRIP('text')}
  WHEN length(regexp_extract({RSTRIP('text')}, '(?s)^(.*[.!?\\n])', 1)) - 1 > length({RSTRIP('text')}) * 0.5 THEN {RSTRIP(f"regexp_extract({RSTRIP('text')}, '(?s)^(.*[.!?{chr(92)}n])', 1)")} ELSE {RSTRIP('text')} END""")
_over("t02_strip_trailing_separators", lambda: t.strip_trailing_separators("text"), TRAIL)
_over("t03_ends_mid_sentence", lambda: t.ends_mid_sentence("text"), f"{TRAIL} <> '' AND NOT contains('{END}', right({TRAIL}, 1))")
_over("t04_has_trailing_separator", lambda: t.has_trailing_separator("text"), f"{RSTRIP('text')} <> '' AND {RSTRIP('text')} <> {TRAIL}")
_over("t05_normalize_for_match", lambda: t.normalize("text"), f"lower(trim({COLLAPSE('text')}))")
_over("t06_word_tokens", lambda: F.size(t.words("text")).cast("long"), f"len(regexp_extract_all(lower(text), '{WORD}'))")
_over("t07_ascii_tokens", lambda: F.array_join(t.ascii_words("text"), " "), "array_to_string(regexp_extract_all(lower(text), '[a-z'']+'), ' ')")
_over("t08_clean_tokens", lambda: F.array_join(t.clean_words("text"), " "), f"array_to_string({CLEAN('text')}, ' ')")
_over("t09_soft_normalize", lambda: t.soft("text"), f"lower({COLLAPSE("translate(text, '’-', ''' ')")})")
_over("t10_first_sentence", lambda: t.first_sentence("text"), FIRST)
_over("t11_first_chat_sentence", lambda: t.first_chat_sentence("text"), CHAT_FIRST)
_over("t12_last_sentence", lambda: t.last_sentence("text"), LAST)
_over("t13_first_words", lambda: t.first_words("text"), f"array_to_string(list_slice({CLEAN('text')}, 1, 3), ' ')")
_over("t14_opener_stem", lambda: t.stem(t.first_sentence("text")), f"array_to_string(list_slice(list_filter(string_split_regex(lower({FIRST}), '{WS}+'), lambda w: w <> ''), 1, 5), ' ')")
_over("t15_markdown_classes", lambda: F.concat_ws(",", *[F.when(t.markdown("text", k), k) for k in t.MARKDOWN]), "concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(text, '{SQL(p)}') THEN '{k}' END" for k, p in t.MARKDOWN.items()) + ")")
_N = f"len(list_filter(string_split_regex(text, '\\n{WS}*\\n'), lambda p: regexp_matches(p, '[^ \\t\\n\\r\\f\\x0B]')))"
_over("t16_structural_shape", lambda: t.shape("text"), f"""concat_ws(' · ', CASE WHEN {_N} <= 2 THEN '1-2' WHEN {_N} <= 5 THEN '3-5' WHEN {_N} <= 9 THEN '6-9' ELSE '10+' END || ' paras',
  CASE WHEN regexp_matches(text, '(?m)^{WS}*[-*•] ') THEN 'bullets' END, CASE WHEN regexp_matches(text, '(?m)^{WS}*[0-9]+[.)] ') THEN 'numbered' END,
  CASE WHEN regexp_matches(text, '(?m)^#{{1,4}} |^\\*\\*[^*\\n]{{2,60}}\\*\\*:?[ \\t]*$') THEN 'headed' END, CASE WHEN right({RSTRIP('text')}, 1) = '?' THEN 'ends-question' END)""")
_over("t17_rule_classifier", lambda: t.classify(t.first_sentence("text"), OPENERS), "CASE " + " ".join(f"WHEN regexp_matches({FIRST}, '{SQL(p)}') THEN '{n}'" for n, p in OPENERS) + " ELSE 'other' END")
#: RE2 has no Unicode word boundary, so letters beyond ASCII become digits, which are no letters of names but of words.
_NAME = r"\b([A-Z][a-z]{2,}(?:[ \t\n\r\f\x0B]+[A-Z][a-z]{2,}){1,2})\b"
_NAMES = f"list_filter(list_transform(regexp_extract_all(regexp_replace(text, '[ªµºÀ-ÖØ-öø-ɏ]', '0', 'g'), '{_NAME}', 1), lambda n: trim(regexp_replace(n, '^The ', ''))), lambda n: n <> '' AND n NOT IN ('United States') AND NOT contains(n, 'Declaration'))"
_over("t18_candidate_names", lambda: F.array_join(F.array_sort(t.candidate_names("text", ("United States",), ("Declaration",))), "|"), f"array_to_string(list_sort(list_distinct({_NAMES})), '|')")
_over("t19_reads_personal", lambda: t.reads_personal("text"), f"{PER_MILLE(SQL(t.FIRST_PERSON))} >= 5 AND {PER_MILLE(SQL(t.CONTRACTION))} >= 2")
_over("t20_transcript_echo", lambda: t.echoes_transcript("text"), f"regexp_matches(substring(text, 1, 40), '^{WS}*(?:USER|ASSISTANT|HUMAN){WS}*:')")
_over("t21_snippet", lambda: t.snippet("text"), f"substring({COLLAPSE(STRIP('text'))}, 1, 80)")
_over("t22_truncate", lambda: F.length(t.truncated("text")).cast("long"), "length(substring(text, 1, 7000))")
_TITLE = f"regexp_replace(regexp_extract({STRIP('text')}, '^([^\\n\\r]*)', 1), '^[#* ]+|[#* ]+$', '', 'g')"
_over("t23_title", lambda: t.title("text"), f"CASE WHEN {_TITLE} = '' THEN '(untitled)' ELSE substring({_TITLE}, 1, 90) END")
_over("t24_goal_label", lambda: F.coalesce(F.nullif(t.tag("text", "goal"), F.lit("")), t.title("text")), f"coalesce(nullif({STRIP("regexp_extract(text, '(?s)<goal>(.*?)</goal>', 1)")}, ''), CASE WHEN {_TITLE} = '' THEN '(untitled)' ELSE substring({_TITLE}, 1, 90) END)")
_over("t31_whitespace_key", lambda: t.key("text"), f"trim({COLLAPSE('text')})")


@query("""WITH w AS (SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b
  ON contains(lower(trim(regexp_replace(d.text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'))), lower(trim(regexp_replace(b.text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')))))
SELECT item_id, count(*) AS n_docs, min(doc_id) AS first_doc FROM w GROUP BY item_id""")
def t25_verbatim_containment(spark, sf_dir):
    """Quotes that stand in documents word for word. The quotes, a fixed reference set, are small; documents stay put."""
    from ..operators.quotes import containment

    hits = containment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query(f"""WITH a AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS card FROM conversations),
w AS (SELECT conv_id, turn, {CLEAN('text')} AS s, {CLEAN('card')} AS c FROM a WHERE card IS NOT NULL),
g AS (SELECT conv_id, turn, list_filter(list_transform(range(1, len(c) - 1), lambda i: list_slice(c, i, i + 2)), lambda x: len(list_filter(x, lambda v: v NOT IN ('the', 'a', 'of', 'and', 'to', 'in', 'is'))) > 0) AS cg,
  list_transform(range(1, len(s) - 1), lambda i: list_slice(s, i, i + 2)) AS sg FROM w)
SELECT conv_id, turn, list_has_any(cg, sg) AS value FROM g""")
def t26_card_echo(spark, sf_dir):
    from pyspark.sql import Window

    turns = table(spark, sf_dir, "conversations")
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    return turns.withColumn("card", before).where("card is not null").select("conv_id", "turn", t.echoes_card("text", "card", STOP_CARD).alias("value"))


@query("""SELECT doc_id, CASE lang WHEN 'en' THEN contains(lower(text), 'the ') OR contains(lower(text), 'and ') WHEN 'de' THEN contains(lower(text), 'der') OR contains(lower(text), 'und')
  WHEN 'fr' THEN contains(lower(text), 'les ') END AS value FROM documents""")
def t27_keyword_realisation(spark, sf_dir):
    from ..operators.rules import keyword_lists

    docs = table(spark, sf_dir, "documents")
    return docs.join(F.broadcast(keyword_lists(spark, KEYWORDS)), "lang", "left").select("doc_id", t.realised("text", F.col("keywords")).alias("value"))


@query("SELECT doc_id, CASE WHEN lang = 'en' AND contains(text, 'ç') THEN true WHEN lang = 'de' AND contains(text, 'ñ') THEN true ELSE false END AS value FROM documents")
def t28_rule_pairs(spark, sf_dir):
    """Pairs of a category and a substring that don't go together, from a table of rules."""
    from ..operators.rules import pair_rules

    docs = table(spark, sf_dir, "documents")
    rules = pair_rules(spark, [("en", "ç"), ("de", "ñ")])
    return docs.join(F.broadcast(rules), "lang", "left").select("doc_id", F.exists(F.coalesce("parts", F.array()), lambda p: F.contains(F.col("text"), p)).alias("value"))




_LABELS = ["click here", "view", "purchase order", "search box"]


@query("""WITH axis(pos, label) AS (VALUES (0, 'click here'), (1, 'view'), (2, 'purchase order'), (3, 'search box')),
m AS (SELECT event_type, min(pos) AS pos FROM (SELECT DISTINCT event_type FROM events), axis WHERE starts_with(lower(label), lower(event_type)) OR starts_with(lower(event_type), lower(label)) GROUP BY event_type)
SELECT e.event_type AS raw, coalesce(a.label, e.event_type) AS label, count(*) AS n FROM events e LEFT JOIN m USING (event_type) LEFT JOIN axis a ON a.pos = m.pos GROUP BY 1, 2""")
def t30_label_canonical(spark, sf_dir):
    """A label's axis value: the first of which one is a prefix of the other, whatever the case."""
    from ..operators.rules import canonical_labels

    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("raw"))
    return canonical_labels(events, "raw", _LABELS).groupBy("raw", "label").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT conv_id, coalesce('turns: ' || count(*) || chr(10), '') || 'user: ' || coalesce(nullif(min(CASE WHEN role = 'user' THEN substring(text, 1, 20) END), ''), '—') || chr(10) || 'system: ' || coalesce(nullif(min(CASE WHEN role = 'system' THEN substring(text, 1, 20) END), ''), '—') AS value FROM conversations GROUP BY conv_id""")
def t32_scope_lines(spark, sf_dir):
    """A record's axes as lines in a fixed order, a dash for a blank one."""
    first = lambda role: F.coalesce(F.nullif(F.min(F.when(F.col("role") == role, F.substring("text", 1, 20))), F.lit("")), F.lit("—"))
    lines = [("turns", F.count(F.lit(1)).cast("string")), ("user", first("user")), ("system", first("system"))]
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), v) for k, v in lines]).alias("value"))


@query("SELECT event_id, coalesce(event_type, '') AS kind, [coalesce(CAST(user_id AS VARCHAR), '')] AS who, coalesce(event_type, '') || ' · ' || coalesce(CAST(user_id AS VARCHAR), '') AS card FROM events")
def t33_card_projection(spark, sf_dir):
    """A deal as a flat card: scalars become lists where lists are wanted, nulls become empty."""
    e = table(spark, sf_dir, "events")
    who = F.coalesce(F.col("user_id").cast("string"), F.lit(""))
    kind = F.coalesce("event_type", F.lit(""))
    return e.select("event_id", kind.alias("kind"), F.array(who).alias("who"), F.concat_ws(" · ", kind, who).alias("card"))


@query("""WITH r AS (SELECT l.doc_id, list_filter([CASE WHEN quality = 0 THEN 'low quality' END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS reasons FROM labels l)
SELECT doc_id, CASE WHEN len(reasons) = 0 THEN '' ELSE 'Fix these:' || chr(10) || array_to_string(list_transform(reasons, lambda x: '- ' || x), chr(10)) END AS value FROM r""")
def t34_feedback_block(spark, sf_dir):
    """Reasons as a bulleted block, empty where there are none."""
    reasons = F.filter(F.array(F.when(F.col("quality") == 0, "low quality"), F.when(F.col("toxic") == 1, "toxic")), lambda x: x.isNotNull())
    block = F.concat(F.lit("Fix these:\n"), F.array_join(F.transform("reasons", lambda x: F.concat(F.lit("- "), x)), "\n"))
    return table(spark, sf_dir, "labels").select("doc_id", reasons.alias("reasons")).select("doc_id", F.when(F.size("reasons") == 0, "").otherwise(block).alias("value"))


@query()
def t22_token_cap(spark, sf_dir):
    """Every text cut to 512 tokens of a public vocabulary, with how many it has."""
    import public_tokenizers

    cut = tokens.capped("text", 512, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = table(spark, sf_dir, "documents").select("doc_id", cut.alias("c"))
    return rows.select("doc_id", "c.n_tokens", "c.kept_tokens", F.length("c.text").cast("long").alias("kept_chars"), F.md5("c.text").alias("kept_md5"))
