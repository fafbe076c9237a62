"""Scalar functions as Column expressions; only similarity() needs Python, as an Arrow-batched UDF.

Every function takes a Column or a name and runs in the JVM, in batch and in streams. NFC and character references, which have no
built-in expression, call the Unicode and text libraries that come with Spark by reflection, on the rows that need them only; such a
column has to be made before it is the key of a join or a group. Text functions read null as stated in each docstring.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import mappings as M

#: White space of any kind.
WHITE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(x: Column, f) -> Column:
    """f of x, with x computed once however often f names it: an expression that stands in several branches is computed in each."""
    return F.transform(F.array(x), lambda v: f(v))[0]


def strip(x) -> Column:
    """Both ends without white space of any kind, no-break space included; in linear time, as a pattern that ends in white space is not:
    it is tried anew at every place of a run."""
    return F.trim(_c(x), F.lit(WHITE))


def squeeze(x) -> Column:
    """Runs of white space as one space, ends stripped."""
    return strip(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def blank_to_null(x) -> Column:
    return F.nullif(_c(x), F.lit(""))


def clean_text(x) -> Column:
    """Squeezed; null when nothing is left."""
    return blank_to_null(squeeze(x))


def _accents() -> tuple[str, str]:
    """The precomposed Latin letters and their base letters, by decomposition."""
    out = {}
    for k in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        d = unicodedata.normalize("NFD", chr(k))
        if len(d) > 1 and all(unicodedata.category(m) == "Mn" for m in d[1:]):
            out[chr(k)] = d[0]
    return "".join(out), "".join(out.values())


_FROM, _TO = _accents()


def strip_accents(x, strip_dbar: bool = False) -> Column:
    """Letters without accents; the letter with a bar stays unless strip_dbar."""
    plain = F.regexp_replace(F.translate(_c(x), _FROM, _TO), r"\p{Mn}+", "")
    return F.translate(plain, "đĐ", "dD") if strip_dbar else plain


def nfc(x) -> Column:
    """Unicode NFC. Texts of ASCII alone are passed on as they are."""

    def composed(x: Column) -> Column:
        whole = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(x, F.lit("")), F.lit(False))
        return F.when(x.rlike(r"[^\x00-\x7F]"), whole).otherwise(x)

    return let(_c(x), composed)


def strip_accents_compat(x, strip_dbar: bool = False) -> Column:
    """As strip_accents, but by compatible decomposition: ligatures, full-width and circled letters become plain ones too."""
    x = _c(x)
    apart = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), F.coalesce(x, F.lit("")), F.lit(True))
    plain = F.when(x.rlike(r"[^\x00-\x7F]"), F.regexp_replace(apart, r"\p{Mn}+", "")).otherwise(x)
    return F.translate(plain, "đĐ", "dD") if strip_dbar else plain


def unescape(x) -> Column:
    """Character references by name and number, decoded once."""

    def decoded(x: Column) -> Column:
        plain = F.replace(F.coalesce(x, F.lit("")), F.lit("&apos;"), F.lit("&#39;"))
        return F.when(F.contains(x, F.lit("&")), F.reflect(F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4"), plain)).otherwise(x)

    return let(_c(x), decoded)


# Prefixes of a programme's name, in the order in which they are removed, and a group in brackets.
_PREFIXES = [r"ngành[:\s]+", r"chuyên ngành[:\s]+", r"chương trình[:\s]+", r"hệ[:\s]+", r"bộ môn[:\s]+", r"khoa\s+(?!học\b)"]
_OPEN, _CLOSE = r"(\[（【", r")\]）】"


def without_brackets(x: Column, opened: str = _OPEN, closed: str = _CLOSE, last: bool = False) -> Column:
    """Without bracket groups, each from the first opening bracket after a closing one to the next that closes; with `last` only without
    one at the very end. A search begins at the start and after closing brackets alone, so time is linear."""
    group = rf"(?<![^{closed}])([^{opened}{closed}]*+)[{opened}][^{closed}]*+[{closed}]"
    return F.regexp_replace(x, group + ("$" if last else ""), "$1")


def major_name(x) -> Column:
    """A programme name: numbering, known prefixes (each once, in order) and every bracket group removed, words capitalised. Null is empty."""
    t = strip(nfc(unescape(strip(F.coalesce(_c(x), F.lit(""))))))
    t = F.regexp_replace(t, r"^\d+[.)\-\s]+", "")
    for p in _PREFIXES:
        t = F.regexp_replace(t, f"(?iu)^{p}", "")
    t = F.trim(without_brackets(t), F.lit(" -:"))
    return F.initcap(F.lower(squeeze(t)))


def raw_name(x) -> Column:
    """A name for lookup: named references as spaces, a trailing bracket group, one prefix and numbering removed."""
    t = squeeze(F.regexp_replace(nfc(strip(F.coalesce(_c(x), F.lit("")))), r"&[a-zA-Z]+;", " "))
    t = strip(without_brackets(t, last=True))
    # Prefixes of a name.
    t = F.regexp_replace(t, r"(?iuU)^(?:ngành|chuyên ngành|bộ môn|khoa|chương trình|hệ)\s*[:\-]?\s*", "")
    return squeeze(F.regexp_replace(t, r"(?U)^\d+[.)]\s*", ""))


def name_key(x) -> Column:
    """Lower case, NFC, squeezed: names that differ in these only are one key."""
    return squeeze(nfc(F.lower(_c(x))))


def keyword(x) -> Column:
    """A name without bracket groups and a leading prefix; null when empty."""
    t = without_brackets(nfc(x))
    # Prefixes of a name.
    t = F.regexp_replace(strip(t), r"(?iuU)^(?:ngành|chuyên ngành|chương trình|hệ|bộ môn)[:\s]+", "")
    return blank_to_null(squeeze(t))


def code(x, size: int = 20) -> Column:
    """An institution code: upper case, letters A-Z, digits and hyphens only, cut to size. Null is empty."""
    return F.substring(F.regexp_replace(nfc(F.upper(strip(F.coalesce(_c(x), F.lit(""))))), "[^A-Z0-9-]", ""), 1, size)


def scan_code(x) -> Column:
    """The page scan's form of a code: word characters of any script and hyphens."""
    return F.regexp_replace(F.upper(strip(_c(x))), r"(?U)[^\w-]", "")


def seven_digits(x) -> Column:
    return blank_to_null(F.regexp_extract(_c(x), r"\d{7}", 0))


_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def in_range(x: Column, low: float, high: float) -> Column:
    """x within bounds, else null; also null for NaN."""
    return F.when(x.between(F.lit(low), F.lit(high)), x)


def score(x, low: float = 0, high: float = 100) -> Column:
    """A score from text as decimal(5,2): placeholders, signs of comparison, a decimal comma and units are understood."""
    t = strip(_c(x))
    t = F.when(~F.lower(t).isin(M.NO_SCORE), t)
    t = F.regexp_replace(t, r"(?U)^[≥≤><~≈±\s]+", "")
    t = F.replace(t, F.lit(","), F.lit("."))
    t = strip(F.regexp_replace(t, r"(?iuU)(?<!\s)\s*+(điểm|đ|pts|points?)$", ""))
    number = F.when(t.rlike(_NUMBER), t).otherwise(F.regexp_extract(t, r"\d+(?:\.\d+)?", 0))
    return F.round(in_range(number.try_cast("double"), low, high), 2).cast("decimal(5,2)")


def quota(x) -> Column:
    """The first run of digits, when positive; a sign is not read."""
    n = let(strip(_c(x)), lambda t: F.when(~F.lower(t).isin(M.NO_QUOTA), F.regexp_extract(t, r"\d+", 0)).try_cast("bigint"))
    return let(n, lambda n: F.when(n > 0, n))


def to_int(x) -> Column:
    """A whole number written as such; anything else is null."""
    return F.when(strip(_c(x)).rlike(r"^[+-]?\d+$"), strip(_c(x))).try_cast("bigint")


def opt_int(x) -> Column:
    """A number truncated to an integer, when positive."""
    t = strip(_c(x).cast("string"))
    n = F.when(t.rlike(_NUMBER), t).try_cast("double").try_cast("bigint")
    return F.when(n > 0, n)


def opt_text(x, size: int) -> Column:
    return blank_to_null(F.substring(strip(_c(x)), 1, size))


def field(x, size: int) -> Column:
    """Free text: control characters deleted but for line ends, each line squeezed, empty lines dropped, cut to size. Null is empty."""
    t = F.regexp_replace(nfc(F.coalesce(_c(x), F.lit(""))), r"[\p{Cc}&&[^\n]]", "")
    lines = F.filter(F.transform(F.split(t, "\n"), lambda s: strip(F.regexp_replace(s, " +", " "))), lambda s: s != "")
    return F.rtrim(F.substring(F.array_join(lines, "\n"), 1, size), F.lit(WHITE))


def is_url(x) -> Column:
    return F.coalesce(strip(_c(x)).rlike("^https?://"), F.lit(False))


def label(x, labels: dict[str, str], default: str | None = None) -> Column:
    """A label by its lower-case text; an unknown one is the default."""
    table = F.create_map(*[F.lit(v) for kv in labels.items() for v in kv])
    return F.coalesce(F.try_element_at(table, F.lower(strip(_c(x)))), F.lit(default))


def first_keyword(x: Column, rules: list[tuple[list[str] | str, str]], default: str | None, *also: Column) -> Column:
    """The value of the first rule whose keyword, or one of them, stands in x or in one of the other forms of it."""
    out = F.lit(None).cast("string")
    for words, value in reversed(rules):
        words = [words] if isinstance(words, str) else words
        hit = reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for t in (x, *also) for w in words])
        out = F.when(hit, F.lit(value)).otherwise(out)
    return F.coalesce(out, F.lit(default))


def method(x) -> Column:
    """The admission method of a label or a text that names one; THPT when none is named."""

    def told(low: Column) -> Column:
        return F.coalesce(label(low, M.METHOD_LABELS), let(strip_accents(low), lambda plain: first_keyword(low, M.METHOD_KEYWORDS, "THPT", plain)))

    return let(strip(F.coalesce(_c(x), F.lit(""))), lambda t: F.when(t == "", F.lit("THPT")).when(t.isin(list(M.METHODS)), t).otherwise(let(F.lower(t), told)))


def title_method(x) -> Column:
    return let(strip_accents(F.lower(F.coalesce(_c(x), F.lit(""))), True), lambda t: first_keyword(t, M.TITLE_KEYWORDS, "THPT"))


def set_key(items: Column) -> Column:
    """A key that is the same for any order of the items."""
    return F.array_join(F.array_sort(F.array_distinct(items)), "+")


def combo(x) -> Column:
    """The code of a subject combination, by code, alias, set of three subjects, or a code within the text; KHAC for others."""
    subjects = F.create_map(*[F.lit(v) for kv in M.SUBJECTS.items() for v in kv])
    plain = {k: v for k, v in M.COMBO_ALIASES.items()}
    bare = {"".join(c for c in unicodedata.normalize("NFD", k) if unicodedata.category(c) != "Mn").replace("đ", "d"): v for k, v in plain.items()}
    sets = {k.lower(): v for k, v in M.SUBJECT_SETS.items()}

    def key(low: Column) -> Column:
        parts = F.filter(F.transform(F.split(low, r"(?U)[,\-/；;、]+\s*|\s+và\s+|\s+"), strip), lambda p: p != "")
        codes = F.transform(parts, lambda p: F.try_element_at(subjects, p))
        return let(codes, lambda c: F.when((F.size(c) == 3) & ~F.exists(c, lambda x: x.isNull()), set_key(c)))

    def found(t: Column) -> Column:
        inside = blank_to_null(F.upper(F.regexp_extract(t, r"(?i)\b([A-DX]\d{2})\b", 1)))
        return let(F.lower(t), lambda low: F.coalesce(label(low, plain), label(strip_accents(low, True), bare), label(key(low), sets), inside))

    return let(nfc(strip(F.coalesce(_c(x), F.lit("")))), lambda t: F.when(t.rlike(r"(?i)^[A-DX]\d{2}$"), F.upper(t)).otherwise(F.coalesce(found(t), F.lit("KHAC"))))


def combos(x) -> Column:
    """All combinations that a text lists, in order, each once, without KHAC."""
    t = F.coalesce(_c(x), F.lit(""))
    parts = F.split(t, r"[;\n]+")
    inside = F.regexp_extract_all(t, F.lit(r"(?i)\b([A-DX]\d{2})\b"), F.lit(1))
    listed = F.when(F.size(parts) > 1, parts).when(F.size(inside) > 0, inside).otherwise(F.split(t, ","))
    return F.array_distinct(F.filter(F.transform(listed, combo), lambda c: c != "KHAC"))


def scan_combo(x) -> Column:
    """The page scan's combination: an alias within the text, else the first letter with two digits."""
    low = strip_accents(F.lower(F.coalesce(_c(x), F.lit(""))), True)
    code_ = blank_to_null(F.regexp_extract(F.upper(F.coalesce(_c(x), F.lit(""))), r"[A-Z]\d{2}", 0))
    return F.coalesce(let(low, lambda t: first_keyword(t, list(M.SCAN_COMBO_ALIASES.items()), None)), code_, F.lit("KHAC"))


def texts(x) -> Column:
    """A list's texts stripped, without empty ones, each once in order; null is an empty list."""
    a = F.coalesce(_c(x), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(a, strip), lambda s: s.isNotNull() & (s != "")))


def csv_list(x, sep: str = ",") -> Column:
    return texts(F.split(F.coalesce(_c(x), F.lit("")), sep))


def short_name(x, size: int = 50) -> Column:
    t = strip(_c(x))
    return F.substring(F.when(t.rlike("^[A-Za-z]+$"), F.upper(t)).otherwise(t), 1, size)


def slug(x) -> Column:
    return blank_to_null(F.regexp_extract(_c(x), r"/diem-chuan[/-](.+?)(?:\.html|$)", 1))


def slug_code(x) -> Column:
    return F.upper(F.try_element_at(F.split(_c(x), "-"), F.lit(-1)))


def fingerprint(*parts) -> Column:
    """16 hex digits over the lower-case stripped parts; null is the word none."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(strip(F.lower(_c(p).cast("string"))), F.lit("none")) for p in parts]), 256), 1, 16)


def _json_text(x: Column) -> Column:
    """A text as JSON writes it: quotes, backslashes and control characters escaped, other letters as they are."""
    t = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for k in range(32):
        short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}.get(k, f"\\u{k:04x}")
        t = F.replace(t, F.lit(chr(k)), F.lit(short))
    control = x.rlike(r"[\x00-\x1F]")
    return F.concat(F.lit('"'), F.when(control, t).otherwise(F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))), F.lit('"'))


def record_fingerprint(**parts) -> Column:
    """SHA-256 over the named parts as JSON with sorted keys and a space after separators."""
    named = [F.concat(F.lit(f'"{k}": '), F.when(v.isNull(), F.lit("null")).otherwise(_json_text(v.cast("string")))) for k, v in sorted((k, _c(v)) for k, v in parts.items())]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *named), F.lit("}")), 256)


def is_placeholder(x) -> Column:
    """Whether a raw score stands for none. Null is a placeholder."""
    return F.coalesce(F.lower(strip(x)), F.lit("")).isin(M.PLACEHOLDERS)


def key_id(*parts) -> Column:
    """A reproducible surrogate key of a business key."""
    return F.substring(F.sha2(F.concat_ws("\u0001", *[F.coalesce(_c(p).cast("string"), F.lit("\u0000")) for p in parts]), 256), 1, 32)


def auto_code(x) -> Column:
    """A code for a name that has none: AUTO- and six letters or digits of its hash. Of two thousand million codes, so two names may
    share one; a name's identity is its key_id, not this code."""
    digits = F.conv(F.substring(F.sha2(name_key(x), 256), 1, 12), 16, 36)
    return F.concat(F.lit("AUTO-"), F.lpad(F.right(digits, F.lit(6)), 6, "0"))


def utc(x, as_of) -> Column:
    """A timestamp from text; one that can't be read is as_of."""
    return F.coalesce(F.try_to_timestamp(_c(x).cast("string")), F.lit(as_of).cast("timestamp"))


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2), F.lit(0.0))


def bar(share: Column, width: int = 20) -> Column:
    n = F.floor(share / 100 * width).cast("int")
    return F.concat(F.repeat(F.lit("#"), n), F.repeat(F.lit("."), F.lit(width) - n))


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; call it on distinct pairs only."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in zip(a, b, strict=True)])
