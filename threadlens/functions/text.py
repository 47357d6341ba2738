"""Text expressions: every function maps columns to a column.

Word characters are letters, digits and the underscore in any script, and
whitespace is Unicode whitespace.  Both are spelled out as explicit character
classes, so results do not depend on the regex defaults of the Java version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens import params as P

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NON_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What is removed from a message, in this order.
URL = rf"(?iu)https?://{NON_SPACE}+|www\.{NON_SPACE}+"
RETWEET_PREFIX = rf"(?iu)^RT{SPACE}+@{WORD}+:?{SPACE}*"
LEADING_MENTIONS = rf"^(?:@{WORD}+{SPACE}*)+"
NEWLINES = r"[\n\r]+"
SPACE_RUN = rf"{SPACE}{{2,}}"

ALPHA_WORD = rf"(?<!{WORD})[a-z]{{2,}}(?!{WORD})"
TERM = rf"{WORD}{{2,}}"
EMOJI = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in P.EMOJI_RANGES) + "]"


def ustrip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    return ustrip(F.coalesce(text, F.lit(""))) == ""


def clean_text(text: Column, p: P.Params) -> Column:
    """Remove URLs, a retweet prefix and leading mentions; tidy whitespace."""
    steps = [
        (p.remove_urls, URL, ""),
        (p.remove_rt_prefix, RETWEET_PREFIX, ""),
        (p.strip_leading_mentions, LEADING_MENTIONS, ""),
        (True, NEWLINES, " "),
        (p.normalize_whitespace, SPACE_RUN, " "),
    ]
    out = F.coalesce(text, F.lit(""))
    for enabled, pattern, replacement in steps:
        if enabled:
            out = F.regexp_replace(out, pattern, replacement)
    if p.lowercase:
        out = F.lower(out)
    return ustrip(out)


def once(value: Column) -> Column:
    """Evaluate an expensive expression once per row.

    Used as ``df.select("*", once(x).alias("y"))``.  Filters on a plain column are
    pushed down by repeating its expression; a generated row is not inlined.
    """
    return F.explode(F.array(value))


def contains_any(text: Column, needles: list[str]) -> Column:
    """True when ``text`` contains one of the substrings."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needles])


def alpha_words(text: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-case words of two or more plain letters, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(ALPHA_WORD), F.lit(0))
    stop = P.STOP_WORDS if stop_words is None else stop_words
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def terms(text: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-case runs of two or more word characters."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(stop_words)) if stop_words else words


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring words, joined by a space."""
    if n == 1:
        return words
    size = F.size(words) - (n - 1)
    out = F.slice(words, 1, F.greatest(size, F.lit(0)))
    for i in range(1, n):
        # pairwise zip of equally long slices: linear in the number of words
        tail = F.slice(words, i + 1, F.greatest(size, F.lit(0)))
        out = F.zip_with(out, tail, lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def caps_heavy(text: Column) -> Column:
    """More than ten characters, more than half of them upper case."""
    upper = F.regexp_count(text, F.lit(r"\p{IsUppercase}"))
    return (F.length(text) > 10) & (upper / F.length(text) > 0.5)


def emoji_chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(EMOJI), F.lit(0))


def role_tag(role: Column) -> Column:
    return F.when(role == "customer", F.lit("[CUSTOMER]")).otherwise(F.lit("[BRAND]"))


def brand_line(transcript: Column, brand: str) -> Column:
    """First brand line of a transcript, null when there is none.

    A line counts when it starts with the brand tag (which is removed) or when
    it mentions the brand name.
    """
    lines = F.transform(F.split(transcript, "\n"), ustrip)
    tag = F.lit("[BRAND]")
    hits = F.filter(lines, lambda x: F.startswith(x, tag) | F.contains(x, F.lit(brand)))
    hit = F.get(hits, F.lit(0))
    return F.when(F.startswith(hit, tag), ustrip(F.replace(hit, tag, F.lit("")))).otherwise(hit)


def label_key(value: Column) -> Column:
    """Label spelling: stripped, lower case, blanks and hyphens as underscores."""
    return F.translate(F.lower(ustrip(value)), " -", "__")


def normalize_intent(value: Column) -> Column:
    key = label_key(value)
    return F.when(key.isin(P.INTENTS), key)


def normalize_confidence(value: Column, short_forms: bool = True) -> Column:
    key = F.lower(ustrip(value))
    out = F.when(key.isin(P.CONFIDENCE_LEVELS), key)
    if short_forms:
        for short, level in P.CONFIDENCE_SHORT_FORMS.items():
            out = out.when(key == short, F.lit(level))
    return out


def normalize_reason(value: Column) -> Column:
    key = label_key(value)
    return F.when(key.isin("", "n/a", "na"), F.lit("none")).when(
        key.isin(P.ESCALATION_REASONS), key
    )


def title_of(key: str) -> str:
    """A key as it is shown: words with capitals instead of underscores."""
    return key.replace("_", " ").title()


def is_escalation(value: Column) -> Column:
    """Truth value of an escalation label given as boolean or text."""
    key = F.upper(ustrip(value.cast("string")))
    return F.coalesce(key.isin("TRUE", "YES", "1", "ESCALATE", "HUMAN REQUIRED"), F.lit(False))


def truncate_text(text: Column, max_length: int) -> Column:
    cut = F.concat(F.substring(text, 1, max_length - 3), F.lit("..."))
    return F.when(F.length(text) <= max_length, text).otherwise(cut)


def snippet(text: Column, n: int = 40) -> Column:
    """First ``n`` characters, marked when cut, with double quotes replaced."""
    cut = F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)
    return F.replace(cut, F.lit('"'), F.lit("'"))


def percentage(part: Column, total: Column, digits: int = 1) -> Column:
    """100 * part / total, zero when the total is zero."""
    return F.coalesce(
        F.round(part.cast("double") * 100.0 / F.nullif(total.cast("double"), F.lit(0.0)), digits),
        F.lit(0.0),
    )


def grouped_number(n: Column) -> Column:
    """Thousands separators; fractional numbers have two decimals."""
    kind = F.typeof(n)
    fractional = kind.isin("double", "float") | F.startswith(kind, F.lit("decimal"))
    return F.call_function("format_number", n, F.when(fractional, F.lit(2)).otherwise(F.lit(0)))


def utc_iso(at: Column) -> Column:
    """A timestamp as ISO 8601 text in UTC, to the microsecond."""
    utc = F.to_utc_timestamp(at, F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
