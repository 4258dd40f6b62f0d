"""Text functions, Column -> Column. Built-in expressions only, so they stay in generated code.

White space is the ASCII one everywhere (space and \\t to \\r), words are runs of letters, digits, _ and '.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

WS = r"[ \t\n\r\f\x0B]"
WORD = r"[\p{L}\p{N}_']+"
# Fixed values, which results depend on: the characters that end a sentence (closing quotes, brackets and other scripts'
# stops included), and the patterns of markdown classes, structural elements, the first person and contractions.
TERMINAL = ".!?\"'”’)…]:" + "。！？」』】）׃।॥۔؟"
MARKDOWN = {"headings": r"(?m)^#{1,4} ", "bold": r"\*\*[^*\n]+\*\*", "bullets": r"(?m)^[-*] ", "tables": r"(?m)^\|.+\|[ \t]*$"}
BULLET = rf"(?m)^{WS}*[-*•] "
NUMBERED = rf"(?m)^{WS}*[0-9]+[.)] "
HEADED = r"(?m)^#{1,4} |^\*\*[^*\n]{2,60}\*\*:?[ \t]*$"
FIRST_PERSON = r"(?i)\b(?:i|i'm|i've|i'd|my|mine)\b"
CONTRACTION = r"(?i)\b[a-z]+n't\b|\b[a-z]+'(?:ll|re|ve|d|s)\b"


def _c(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def rstrip(x: Column | str) -> Column:
    return F.regexp_replace(_c(x), rf"{WS}+\z", "")


def strip(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(x), f"^{WS}+", ""), rf"{WS}+\z", "")


def collapse(x: Column | str) -> Column:
    return F.regexp_replace(_c(x), f"{WS}+", " ")


def _ends_well(x: Column) -> Column:
    return F.instr(F.lit(TERMINAL), F.right(x, F.lit(1))) > 0


def trim_unfinished(x: Column | str) -> Column:
    """A cut-off text up to its last sentence end or line, if that lies in its second half."""
    t = F.regexp_replace(_c(x), rf"{WS}+\z", "")
    # the last sentence end counts from 0, its length is one more
    head = F.regexp_extract(t, r"(?s)^(.*[.!?\n])", 1)
    cut = F.length(head) - 1
    return F.when((t == "") | _ends_well(t), t).when(cut > F.length(t) * 0.5, F.regexp_replace(head, rf"{WS}+\z", "")).otherwise(t)


def strip_trailing_separators(x: Column | str) -> Column:
    """Without closing lines that hold only separators."""
    t = F.regexp_replace(_c(x), rf"{WS}+\z", "")
    t = F.regexp_replace(t, r"(?:(?:^|\n)[ \t\r\f\x0B=*_~#\-]+)+\z", "")
    return F.regexp_replace(t, rf"{WS}+\z", "")


def ends_mid_sentence(x: Column | str) -> Column:
    t = strip_trailing_separators(x)
    return (t != "") & ~_ends_well(t)


def has_trailing_separator(x: Column | str) -> Column:
    t = F.regexp_replace(_c(x), rf"{WS}+\z", "")
    return (t != "") & (t != strip_trailing_separators(x))


def normalize(x: Column | str) -> Column:
    """For verbatim containment: one space for each run of white space, lower case."""
    return F.lower(F.trim(collapse(x)))


def words(x: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_c(x)), F.lit(WORD), F.lit(0))


def ascii_words(x: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_c(x)), F.lit("[a-z']+"), F.lit(0))


def clean_words(x: Column | str) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(_c(x)), "[^a-z' ]", " "), " +"), lambda w: w != "")


def soft(x: Column | str) -> Column:
    """Straight quotes, spaces for hyphens, white space collapsed, lower case; ends stay."""
    return F.lower(collapse(F.translate(_c(x), "’-", "' ")))


def first_sentence(x: Column | str) -> Column:
    """Of the first line that isn't blank, up to the first end mark, or 160 characters."""
    line = strip(F.regexp_extract(_c(x), r"([^\n\r]*[^ \t\n\r\f\x0B][^\n\r]*)", 1))
    found = F.regexp_extract(line, r"^([^.!?]*[.!?])", 1)
    return F.when(found != "", found).otherwise(F.substring(line, 1, 160))


def first_chat_sentence(x: Column | str) -> Column:
    """Without heading marks and asterisks, up to an end mark before white space or the end, or 200 characters."""
    t = F.regexp_replace(F.regexp_replace(strip(x), rf"^#+{WS}*", ""), r"\*", "")
    found = F.regexp_extract(t, rf"(?s)^(.*?[.!?](?:{WS}|\z))", 1)
    return strip(F.when(found != "", found).otherwise(F.substring(t, 1, 200)))


def last_sentence(x: Column | str) -> Column:
    """What follows the last end mark that white space follows; the whole text if none does."""
    t = strip(x)
    return F.element_at(F.split(t, rf"(?<=[.!?]){WS}+"), -1)


def first_words(x: Column | str, k: int = 3) -> Column:
    return F.array_join(F.slice(clean_words(x), 1, k), " ")


def stem(x: Column | str, k: int = 5) -> Column:
    return F.array_join(F.slice(F.filter(F.split(F.lower(_c(x)), f"{WS}+"), lambda w: w != ""), 1, k), " ")


def markdown(x: Column | str, kind: str) -> Column:
    return F.regexp_like(_c(x), F.lit(MARKDOWN[kind]))


def paragraphs(x: Column | str) -> Column:
    parts = F.split(_c(x), rf"\n{WS}*\n")
    return F.size(F.filter(parts, lambda p: F.regexp_like(p, F.lit(r"[^ \t\n\r\f\x0B]"))))


def shape(x: Column | str) -> Column:
    """Bucket of the paragraph count and the structural elements that are used."""
    n = paragraphs(x)
    has = lambda pattern, name: F.when(F.regexp_like(_c(x), F.lit(pattern)), name)
    bucket = F.when(n <= 2, "1-2").when(n <= 5, "3-5").when(n <= 9, "6-9").otherwise("10+")
    return F.concat_ws(" · ", F.concat(bucket, F.lit(" paras")), has(BULLET, "bullets"), has(NUMBERED, "numbered"), has(HEADED, "headed"), F.when(F.right(rstrip(x), F.lit(1)) == "?", "ends-question"))


def classify(x: Column, rules: Sequence[tuple[str, str]], other: str = "other") -> Column:
    """The name of the first rule (name, pattern) that the text matches."""
    out = None
    for name, pattern in rules:
        hit = F.regexp_like(x, F.lit(pattern))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(other) if out is None else out.otherwise(other)


_IN, _OUT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
NAME = rf"{_IN}([A-Z][a-z]{{2,}}(?:[ \t\n\r\f\x0B]+[A-Z][a-z]{{2,}}){{1,2}}){_OUT}"


def candidate_names(x: Column | str, stop: Sequence[str] = (), banned: Sequence[str] = ()) -> Column:
    """Distinct runs of two or three capitalised words; a leading "The " goes, stop names and banned parts too."""
    found = F.transform(F.regexp_extract_all(_c(x), F.lit(NAME), F.lit(1)), lambda n: F.trim(F.regexp_replace(n, "^The ", "")))
    keep = lambda n: (n != "") & ~n.isin(list(stop)) & ~F.coalesce(F.greatest(F.lit(False), F.lit(False), *[F.contains(n, F.lit(b)) for b in banned]), F.lit(False))
    return F.array_distinct(F.filter(found, keep))


def per_thousand_words(x: Column | str, pattern: str) -> Column:
    n = F.greatest(F.regexp_count(_c(x), F.lit(r"[\p{L}\p{N}_]+")), F.lit(1))
    return F.regexp_count(_c(x), F.lit(pattern)) * 1000.0 / n


def reads_personal(x: Column | str) -> Column:
    return (per_thousand_words(x, FIRST_PERSON) >= 5) & (per_thousand_words(x, CONTRACTION) >= 2)


def echoes_transcript(x: Column | str) -> Column:
    """Whether the text starts, in its first 40 characters, with a speaker's mark."""
    return F.regexp_like(F.substring(_c(x), 1, 40), F.lit(rf"^{WS}*(?:USER|ASSISTANT|HUMAN){WS}*:"))


def snippet(x: Column | str, width: int = 80) -> Column:
    return F.substring(collapse(strip(x)), 1, width)


def title(x: Column | str, width: int = 90) -> Column:
    line = F.regexp_replace(F.regexp_extract(strip(x), r"^([^\n\r]*)", 1), r"^[#* ]+|[#* ]+$", "")
    return F.when(line == "", "(untitled)").otherwise(F.substring(line, 1, width))


def truncated(x: Column | str, chars: int = 7000) -> Column:
    return F.substring(_c(x), 1, chars)


def key(x: Column | str) -> Column:
    return F.trim(collapse(x))


def contains_quote(text: Column | str, quote: Column | str) -> Column:
    return F.contains(normalize(text), normalize(quote))


def trigrams(x: Column | str) -> Column:
    w = clean_words(x)
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: F.array_join(F.slice(w, i, 3), " "))


def echoes_card(sentence: Column | str, card: Column | str, stop: Sequence[str]) -> Column:
    """Whether both share a run of three words that aren't all stop words. Words are split once and runs are strings, which
    are met by hash."""

    def runs(words: Column, less: Sequence[str] = ()) -> Column:
        def of(w: Column) -> Column:
            three = lambda i: [F.get(w, i + k) for k in range(3)]
            every = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", *three(i)))
            if less:
                dull = lambda i: three(i)[0].isin(list(less)) & three(i)[1].isin(list(less)) & three(i)[2].isin(list(less))
                every = F.transform(F.filter(F.sequence(F.lit(0), F.size(w) - 3), lambda i: ~dull(i)), lambda i: F.concat_ws(" ", *three(i)))
            return F.when(F.size(w) >= 3, every).otherwise(F.array().cast("array<string>"))

        return F.element_at(F.transform(F.array(words), of), 1)

    return F.arrays_overlap(runs(clean_words(card), stop), runs(clean_words(sentence)))


def realised(text: Column | str, keywords: Column) -> Column:
    """Whether any keyword stands in the text; null where there is no keyword list."""
    low = F.lower(_c(text))
    return F.when(keywords.isNull(), None).otherwise(F.exists(keywords, lambda k: F.contains(low, F.lower(k))))


def tag(x: Column | str, name: str) -> Column:
    """What a pair of tags holds, stripped; null if there is none or it is empty."""
    return F.nullif(strip(F.regexp_extract(_c(x), rf"(?s)<{name}>(.*?)</{name}>", 1)), F.lit(""))


def tag_tail(x: Column | str, name: str, ended: Column) -> Column:
    """As tag(); for a text that ended by itself, an unclosed last tag holds the rest."""
    rest = F.when(F.contains(_c(x), F.lit(f"<{name}>")) & ended, F.nullif(strip(F.substring_index(_c(x), f"<{name}>", -1)), F.lit("")))
    return F.coalesce(tag(x, name), rest)


def incoherent(x: Column | str, name: str) -> Column:
    return F.regexp_like(F.coalesce(tag(x, name), F.substring(_c(x), 1, 2000)), F.lit(r"\bINCOHERENT\b"))


def template_parts(x: Column | str, marker: str = "===USER===") -> tuple[Column, Column]:
    """(before, after) a line that is the marker; without one, ("", whole)."""
    at = rf"(?m)^{marker}[ \t]*$\n?"
    whole = F.regexp_like(_c(x), F.lit(at))
    cut = F.split(_c(x), at, 2)
    return F.when(whole, strip(F.get(cut, 0))).otherwise(""), F.when(whole, strip(F.get(cut, 1))).otherwise(_c(x))


def placeholders(x: Column | str) -> Column:
    """Names of {slots} in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(_c(x), F.lit(r"\{([A-Za-z_][A-Za-z0-9_]*)\}"), F.lit(1)))


def language_of(culture: Column | str, default: str = "English") -> Column:
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(_c(culture), "written in ([^,]+)", 1)), F.lit("")), F.lit(default))
