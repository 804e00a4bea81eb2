"""Text scalars; all are built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

INGEST_MIN, UPLOAD_GAP_MIN, UPLOAD_MIN, ANALYSIS_MIN, V1_MIN = 200, 50, 100, 200, 300


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def or_else(*values: Column) -> Column:
    """The first value that is neither null nor an empty string."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def clean(x: Column) -> Column:
    """White space, of Unicode too, to one space each, trimmed."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def normalize_text(x: Column) -> Column:
    """Lower case, one space, and no space or sentence mark at either end: the key of text dedup."""
    return F.btrim(F.regexp_replace(F.lower(x), r"(?U)\s+", " "), F.lit(" .,:;!?"))


def post_clean(x: Column) -> Column:
    """At most one empty line, runs of blanks to one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"\n{3,}", "\n\n"), r"[ \t]{2,}", " "))


def looks_like_pdf(x: Column) -> Column:
    head = F.substring(x, 1, 300)
    return head.contains("PAGE") & head.contains("=" * 60)


def normalize_input(content: Column, kind: Column, html_to_text) -> Column:
    """By type: PDF text is collapsed, HTML is stripped, anything else only tidied; PDF text is also told by its look."""
    pdf = kind.isin("pdf_text", "pdf_file") | looks_like_pdf(content)
    return F.when(pdf, clean(content)).when(kind == "html", html_to_text(content)).otherwise(post_clean(content))


def tokens(x: Column) -> Column:
    """A token estimate: a quarter of the characters."""
    return F.floor(F.length(x) / 4).cast("long")


def at_least(x: Column, n: int) -> Column:
    return F.length(F.coalesce(x, F.lit(""))) >= n


def first_tier(tiers: list[tuple[Column, str]], least: int, strict: bool = False, strict_from: int = 0) -> Column:
    """The first content that is long enough, with its tag; boundaries may be strict from some tier on."""
    found = []
    for i, (content, tag) in enumerate(tiers):
        n = F.length(F.trim(content))
        ok = n > least if strict and i >= strict_from else n >= least
        found.append(F.when(ok, F.struct(content.alias("content"), F.lit(tag).alias("content_type"))))
    return F.coalesce(*found)


def bad_page(x: Column) -> Column:
    """Under 200 characters, or under 30 words of over 3 letters, or over half digits, or no run of three letters."""
    x = F.coalesce(x, F.lit(""))
    n = F.length(x)
    words = F.regexp_count(x, F.lit(r"[^ \t\n\r\f\x0B]{4,}"))
    digits = n - F.length(F.regexp_replace(x, "[0-9]", ""))
    return (F.length(F.trim(x)) < 200) | (words < 30) | (digits * 2 > n) | ~x.rlike("[A-Za-z]{3}")


def broken_text(x: Column) -> Column:
    """Garbled: under 70 percent printable in the first 500 characters, or over 15 escapes ``\\u``."""
    head = F.substring(x, 1, 500)
    printable = F.length(F.regexp_replace(head, r"[^\p{L}\p{M}\p{N}\p{P}\p{S} \n\r\t]", ""))
    escapes = (F.length(x) - F.length(F.replace(x, F.lit("\\u"), F.lit("")))) / 2
    return F.coalesce((printable < 0.7 * F.length(head)) | (escapes > 15), F.lit(False))


def blocked(x: Column, terms: list[str]) -> Column:
    """Any of the terms occurs, whatever the case."""
    return F.exists(F.array(*map(F.lit, terms)), lambda t: F.contains(F.lower(x), t))


def link_wanted(x: Column, include: str, exclude: str) -> Column:
    return x.rlike(include) & ~x.rlike(exclude)


def is_annexure(title: Column) -> Column:
    t = clean(title)
    return F.startswith(F.lower(t), F.lit("annex")) & (F.size(F.split(t, " ")) <= 3)


def complete(*fields: Column) -> Column:
    """All required fields hold something."""
    out = F.lit(True)
    for f in fields:
        out = out & F.coalesce(F.length(f) > 0, F.lit(False))
    return out


def one_of(x: Column, allowed: tuple[str, ...], default: str) -> Column:
    return F.when(x.isin(*allowed), x).otherwise(F.lit(default))


def null_string(x: Column) -> Column:
    """'' and 'null' mean nothing."""
    return F.when(F.lower(F.trim(x)).isin("", "null"), None).otherwise(F.trim(x))


def truncated(x: Column, n: int, mark: str = "...") -> Column:
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit(mark))).otherwise(x)


def sanitize_name(x: Column, most: int = 200) -> Column:
    """A file name: characters that file systems refuse become ``_``."""
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(x, r'[\\/*?:"<>|\x00-\x1F]', "_"), r" +", " ")), 1, most)


def filename_title(x: Column) -> Column:
    return clean(F.translate(F.regexp_replace(x, r"\.[A-Za-z0-9]{1,5}$", ""), "_-", "  "))


def collapse_code(x: Column) -> Column:
    """A rule code given twice at the start of a title is given once."""
    return F.regexp_replace(clean(x), r"^([A-Z]{1,5}-[0-9A-Z.]+)[ :-]+\1\b", "$1")


def reference_number(x: Column) -> Column:
    """Resolution number and year, notification number, or chapter, the first that is there."""
    patterns = (r"(?i)resolution\s+no\.?\s*\(?(\d+)\)?\s*(?:of|/)\s*\d{4}", r"(?i)no\.?\s*([A-Z0-9]+[/-][0-9/-]+)", r"(?i)chapter\s+([0-9]+[A-Z]?)")
    return F.coalesce(*(F.nullif(F.regexp_extract(x, p, 1), F.lit("")) for p in patterns))


def url_host(u: Column) -> Column:
    return F.nullif(F.regexp_extract(u, r"^[a-z]+://([^/?#]+)", 1), F.lit(""))


def url_path(u: Column) -> Column:
    return F.regexp_extract(u, r"^(?:[a-z]+://[^/?#]+)?([^?#]*)", 1)


def url_extension(u: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url_path(u), r"\.([A-Za-z0-9]+)$", 1)), F.lit(""))


def absolute_link(u: Column, base: Column) -> Column:
    return F.when(u.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), u).when(F.startswith(u, F.lit("/")), F.concat(base, u)).when(u.isNotNull(), F.concat_ws("/", base, u))


def classify_url(u: Column, rules: list[tuple[str, str]], default: str) -> Column:
    out = F.lit(default)
    for pattern, name in reversed(rules):
        out = F.when(u.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def content_hash(text: Column, title: Column) -> Column:
    """MD5 of the text, or of the title if there is none."""
    return F.md5(or_else(text, title))


def arabic_share(x: Column) -> Column:
    """Share of Arabic letters among the non-blank characters of the first 500."""
    head = F.regexp_replace(F.substring(x, 1, 500), r"\s", "")
    return (F.length(head) - F.length(F.regexp_replace(head, "[\\u0600-\\u06FF]", ""))) / F.greatest(F.length(head), F.lit(1))


def contains_arabic(x: Column) -> Column:
    return x.rlike("[\\u0600-\\u06FF]")


# Common words that tell four languages apart.
MARKERS = {"en": ("the", "and", "of", "that"), "fr": ("le", "les", "est", "une"), "de": ("der", "und", "die", "ist"), "es": ("el", "los", "que", "una")}


def language(x: Column) -> Column:
    """Under 20 characters unknown; over a fifth Arabic ``ar``; else the language with most marker words, ``en`` first."""
    w = F.split(F.lower(x), " ")
    count = lambda m: F.size(F.filter(w, lambda t: t.isin(*m)))
    hits = [F.struct(count(m).alias("n"), F.lit(-i).alias("first"), F.lit(lang).alias("lang")) for i, (lang, m) in enumerate(MARKERS.items())]
    return F.when(F.length(F.trim(F.coalesce(x, F.lit("")))) < 20, "unknown").when(arabic_share(x) > 0.2, "ar").otherwise(F.greatest(*hits)["lang"])


def line_kind(x: Column) -> Column:
    """Heading, list item or paragraph."""
    t = F.trim(x)
    return (
        F.when(t.rlike(r"^([-*•]|[0-9]+[.)])\s"), "list")
        .when((F.length(t) < 80) & ((F.upper(t) == t) | ~t.rlike(r"[.,;:!?]$")) & t.rlike("[A-Za-z]"), "heading")
        .otherwise("paragraph")
    )


LANGUAGES = ("en", "ar")


def language_code(name: str | None) -> str:
    """A language parameter, ``en`` if none is given; an error if it is not supported."""
    code = (name or "en").lower().strip()
    if code not in LANGUAGES:
        raise ValueError(f"language {code!r} is not one of {', '.join(LANGUAGES)}")
    return code


def language_param(x: Column) -> Column:
    """A language parameter as a column: ``en`` if none is given, null if it is not supported."""
    code = F.lower(F.trim(F.when(F.length(x) > 0, x).otherwise("en")))
    return F.when(code.isin(*LANGUAGES), code)


def csv_ids(x: Column) -> Column:
    """The whole numbers in a comma-separated list."""
    return F.filter(F.transform(F.split(x, ","), lambda v: F.trim(v).try_cast("long")), lambda v: v.isNotNull())


def clock(hour: Column, minute: Column) -> Column:
    return F.format_string("%02d:%02d", hour, minute)
