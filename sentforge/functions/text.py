"""Column-level text functions (all JVM built-ins, codegen friendly).

Each function takes and returns a ``Column``; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Normal form of a sentence: lower-case, then delete every run of characters
# outside ASCII letters, digits and the blank.  The same set as [^a-zA-Z0-9 ],
# but java.util.regex walks a negated set of ranges many times slower.
NORMAL_FORM_DROP = r"[^\p{Alnum} ]+"
# "Has a letter" filter; the strict variant keeps the reference's class, which
# also accepts a lone comma.
LETTER_CLASS = "[A-Za-z]"
LETTER_CLASS_STRICT = "[A-Z,a-z]"
# Characters deleted anywhere / trimmed from both ends of a response line.
STRIP_DELETE = '"“”'
STRIP_TRIM = "'<>() "
# Inline tags removed from a layout line.
INLINE_TAGS = ["<br/>", "<i>", "<i/>", "</i>", "<b>", "</b>", "<b/>"]
# Layout-line regexes.
END_OF_SENTENCE = r"""(([\"|”|,|a-zA-Z|0-9|.]{3,}[.|?|!|\"|”|:|;]|([:][ ][-]))$)"""
STYLE_RULE = r""".(.*){(.*)font-size:([0-9]*)px;(.*)font-family:(.*);(.*)color:(.*);(.*)"""
TOP_VALUE = r"""(.*)(top:)([0-9]*)(.*)"""
LEFT_VALUE = r"""(.*)(left:)([0-9]*)(.*)"""
# The CSS-rule pattern above has a bare "{" after a group, which Python and
# RE2 read as a literal brace but java.util.regex rejects ("illegal
# repetition"); this is the same pattern with that brace escaped.
STYLE_RULE_ESCAPED = STYLE_RULE.replace("){(", r")\{(")
PAGE_NUMBER_FORMAT = r"""(Page|page)(\s)([0-9]*)(\s)(of)(\s)([0-9]*)"""
# Abbreviations that stop a line from ending a sentence, compared
# case-sensitively against the last 4 / 5 / 6 / 7 characters of the line.
ABBREVIATIONS_4 = [" no.", " mr.", " ft.", " kg.", " dr.", " ms.", " st.", " pp.", " co.", " rs.", " sh.", " vs.", " ex."]
ABBREVIATIONS_5 = [" pvt.", " nos.", " smt.", " sec.", " spl.", " kgs.", " ltd.", " pty.", " vol.", " pty.", " m/s.",
                   " mrs.", " i.e.", " etc.", " (ex.", " o.s.", " anr.", " ors.", " c.a."]
ABBREVIATIONS_6 = [" assn."]
ABBREVIATIONS_7 = [" w.e.f."]
# File-name patterns: page HTML "<dir>/<name>--<n>.html", page image "<id>-<0..><n>.png".
HTML_PAGE_NAME = r"(.*/)(.*)(--[0-9]*)(\.html)"
IMAGE_PAGE_NAME = r"(.*)(-)(0*)(.*)(\.png)"
# Extension routing of the scheduler.
UNIMPLEMENTED_EXTENSIONS = ["txt", "pdf", "docx"]
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normal_form(col: Column | str) -> Column:
    """lower-case and keep only ``[a-z0-9 ]`` (non-ASCII letters vanish)."""
    return F.regexp_replace(F.lower(_c(col)), NORMAL_FORM_DROP, "")


def has_letter(col: Column | str, strict: bool = False) -> Column:
    """True when the text contains an ASCII letter (NULL stays NULL -> filtered)."""
    return _c(col).rlike(LETTER_CLASS_STRICT if strict else LETTER_CLASS)


def word_count(col: Column | str) -> Column:
    """Pieces of a split on single blanks: ``''`` -> 1, ``'a  b'`` -> 3, NULL -> NULL."""
    c = _c(col)
    # blanks + 1 == number of pieces of a split on " " (no array is built)
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def strip_chars(col: Column | str) -> Column:
    """Delete straight and curly double quotes, then trim ``'<>()`` and blanks."""
    return F.btrim(F.translate(_c(col), STRIP_DELETE, ""), F.lit(STRIP_TRIM))


def squeeze_spaces(col: Column | str) -> Column:
    """Collapse whitespace runs to one blank and trim."""
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def strip_inline_tags(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), "|".join(INLINE_TAGS), "")


def sha256_hex(col: Column | str) -> Column:
    return F.sha2(_c(col), 256)


def memory_key(target_language: Column | str, source_sentence: Column | str) -> Column:
    """Translation-memory row key: ``<target language>_<hex sha-256 of the source>``."""
    return F.concat_ws("_", _c(target_language), F.sha2(_c(source_sentence), 256))


def html_page_basename(col: Column | str) -> Column:
    """``/x/ex1--25.html`` -> ``ex1`` ('' when the path has another shape)."""
    return F.regexp_extract(_c(col), HTML_PAGE_NAME, 2)


def file_name(col: Column | str) -> Column:
    """Last path component."""
    return F.element_at(F.split(_c(col), "/"), -1)


def parent_and_name(col: Column | str) -> Column:
    """``a/b/c.csv`` -> ``c.csv`` via the last two components (the writer's partition value)."""
    two = F.regexp_extract(_c(col), r"[\/]([^\/]+[\/][^\/]+)$", 1)
    return F.get(F.split(two, "/"), 1)


def image_name_part(col: Column | str, group: int) -> Column:
    """Group 1 = file id, group 4 = page number without leading zeros."""
    return F.regexp_extract(_c(col), IMAGE_PAGE_NAME, group)


def extension(col: Column | str) -> Column:
    return F.lower(F.regexp_extract(_c(col), r"\.([^./]+)$", 1))


def route_by_extension(col: Column | str) -> Column:
    """txt/pdf/docx -> ``<ext>_processing``; csv -> token extraction; else txt."""
    ext = extension(col)
    return (
        F.when(ext.isin(*UNIMPLEMENTED_EXTENSIONS), F.concat(ext, F.lit("_processing")))
        .when(ext == "csv", F.lit("csv_token_extractor"))
        .otherwise(F.lit("txt_processing"))
    )


def sentence_end(text: Column | str) -> Column:
    """Layout rule: a line ends a sentence (regex, case-insensitive) unless its
    last 4/5/6/7 characters are one of the fixed abbreviations."""
    t = _c(text)
    ends = t.rlike("(?i)" + END_OF_SENTENCE)
    abbrev = (
        F.right(t, F.lit(4)).isin(*ABBREVIATIONS_4)
        | F.right(t, F.lit(5)).isin(*ABBREVIATIONS_5)
        | F.right(t, F.lit(6)).isin(*ABBREVIATIONS_6)
        | F.right(t, F.lit(7)).isin(*ABBREVIATIONS_7)
    )
    return F.coalesce(ends & ~abbrev, F.lit(False))


def is_page_number_text(text: Column | str, page_no: Column | str) -> Column:
    """Header/footer text that is only a page number: ``Page n of m`` at the
    start, the page number itself, or blank."""
    t = _c(text)
    return (
        t.rlike("^" + PAGE_NUMBER_FORMAT)
        | (F.trim(t) == F.trim(_c(page_no).cast("string")))
        | (F.trim(t) == "")
    )


def css_int(style: Column | str, which: str) -> Column:
    """``top:`` / ``left:`` pixel value from an inline style; -1 when absent."""
    pattern = TOP_VALUE if which == "top" else LEFT_VALUE
    v = F.regexp_extract(_c(style), "(?i)" + pattern, 3)
    return F.coalesce(F.when(v != "", v.try_cast("int")), F.lit(-1))


def ml_tokens(col: Column | str) -> Column:
    """Tokenizer semantics: lower-case then split on each single whitespace."""
    return F.split(F.lower(_c(col)), r"\s")


def bigram_ids(col) -> Column:
    """The distinct character bigrams of a lower-cased text as numbers (both code points), in one pass over its characters."""
    points = F.transform(F.split(F.lower(col), ""), lambda c: F.ascii(c).cast("bigint"))
    pairs = F.transform(F.array(points), lambda p: F.zip_with(
        F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: a * F.lit(1 << 21) + b))
    return F.array_distinct(F.element_at(pairs, 1))


def char_bigrams(col: Column | str) -> Column:
    """Set of lower-cased character bigrams (blanks included); empty for < 2 chars.

    Linear in the text: split into characters once, then pair each character
    with its successor (``substring`` by position would rescan the UTF-8
    string for every bigram)."""
    chars = F.split(F.lower(_c(col)), "")
    n = F.size(chars)
    return F.when(
        n >= 2,
        F.array_distinct(F.zip_with(F.slice(chars, 1, n - 1), F.slice(chars, 2, n - 1), lambda x, y: F.concat(x, y))),
    ).otherwise(F.array().cast("array<string>"))
